"""Run registered queries against their SQL: ``python tests/check_contract.py <sf_dir> [name ...]``."""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from contract import ORACLES, QUERIES  # noqa: E402
from tests.oracle import compare, connect  # noqa: E402


def main(sf_dir: str, names: list[str]) -> int:
    # a session without this library's settings, as a caller may have it
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = 0
    for name in names or QUERIES:
        start = time.time()
        try:
            df = QUERIES[name](spark, sf_dir)
            problems = compare(df, con, ORACLES[name]) if name in ORACLES else [] if df.count() else ["no rows"]
        except Exception as e:  # noqa: BLE001
            problems = [f"{type(e).__name__}: {str(e)[:600]}"]
        failed += bool(problems)
        mode = "sql" if name in ORACLES else "rows only"
        print(f"{'FAIL' if problems else 'ok  '} {name} ({mode}) {time.time() - start:.1f}s", *problems, sep="\n     ")
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
