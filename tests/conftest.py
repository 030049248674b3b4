import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from quayside.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "quayside-tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def evaluate(spark):
    """Evaluate an expression over a list of texts bound to column ``x``."""

    def run(expression, values, kind="string"):
        rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
        return [r["y"] for r in rows.select("i", expression.alias("y")).orderBy("i").collect()]

    return run
