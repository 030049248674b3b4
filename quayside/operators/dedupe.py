"""Duplicate and uniqueness operators; all are one partial aggregation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with how often."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")


def occurring_once(df: DataFrame) -> DataFrame:
    """Rows without any copy (all members of a repeated group are dropped)."""
    columns = df.columns
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n")).where("_n = 1").select(*columns)


def missing_references(df: DataFrame, column: str, allowed: DataFrame) -> DataFrame:
    """Distinct values of ``column`` that the one-column table ``allowed`` lacks."""
    values = df.select(F.col(column).alias("value")).where(F.col(column).isNotNull()).distinct()
    known = allowed.toDF("value").distinct()
    return values.join(known, "value", "left_anti")
