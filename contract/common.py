from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def when_text(c: str, cases: dict[str, str], default: str) -> Column:
    out = F.lit(default)
    for key, value in cases.items():
        out = F.when(F.col(c) == key, value).otherwise(out)
    return out


def stamp(c) -> Column:
    """Timestamp as text, so both engines are compared on the same form."""
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")
