"""Reconcile two versions of a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.operators.merge import AUDIT


def compare_tables(
    base: DataFrame, other: DataFrame, base_name: str, other_name: str, ignore: Sequence[str] = tuple(AUDIT)
) -> DataFrame:
    """Rows that one side has more often than the other, tagged with that side and
    repeated as often as they are in surplus. Both sides go through one aggregation,
    so copies collapse before the shuffle."""
    columns = [c for c in base.columns if c not in ignore]
    both = base.select(*columns, F.lit(1).alias("_n")).unionByName(other.select(*columns, F.lit(-1).alias("_n")))
    surplus = both.groupBy(*columns).agg(F.sum("_n").alias("_n")).where("_n <> 0")
    side = F.when(F.col("_n") > 0, base_name).otherwise(other_name)
    copies = F.explode(F.array_repeat(side, F.abs("_n").cast("int"))).alias("side")
    return surplus.select(copies, *columns).select("side", *columns)


def compare_cells(
    base: DataFrame, other: DataFrame, keys: Sequence[str], ignore: Sequence[str] = tuple(AUDIT)
) -> DataFrame:
    """One row per differing cell of rows matched by key; a row that exists on one
    side only shows each of its filled cells against NULL."""
    cells = [c for c in base.columns if c not in ignore and c not in keys]
    joined = base.alias("b").join(other.alias("o"), list(keys), "full")
    diffs = [
        F.when(
            ~F.col(f"b.{c}").eqNullSafe(F.col(f"o.{c}")),
            F.struct(
                F.lit(c).alias("column_name"),
                F.col(f"b.{c}").cast("string").alias("base_value"),
                F.col(f"o.{c}").cast("string").alias("other_value"),
            ),
        )
        for c in cells
    ]
    return joined.select(*keys, F.explode(F.array_compact(F.array(*diffs))).alias("d")).select(*keys, "d.*")
