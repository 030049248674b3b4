"""Filter funnel and filter choices of an exploration screen."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def filter_funnel(df: DataFrame, filters: Sequence[tuple[str, Column]]) -> DataFrame:
    """Rows left after each successive filter, from one pass over the table:
    ``(step, label, n_rows)``, step 0 being the unfiltered table."""
    steps = [("Original data", F.lit(True))]
    kept = F.lit(True)
    for label, predicate in filters:
        kept = kept & F.coalesce(predicate, F.lit(False))
        steps.append((f"Filter: '{label}'", kept))
    counts = df.agg(*[F.count_if(cond).alias(f"_{i}") for i, (_, cond) in enumerate(steps)])
    rows = F.array(
        *[
            F.struct(F.lit(i).alias("step"), F.lit(label).alias("label"), F.col(f"_{i}").alias("n_rows"))
            for i, (label, _) in enumerate(steps)
        ]
    )
    return counts.select(F.inline(rows))


def apply_filters(df: DataFrame, filters: Sequence[tuple[str, Column]]) -> DataFrame:
    for _, predicate in filters:
        df = df.where(predicate)
    return df


def filter_choices(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct values of several columns in one pass: ``(column_name, value)``."""
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns]
    )
    return df.select(F.inline(pairs)).distinct()


def filter_limits(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Maximum of each column, one row."""
    return df.agg(*[F.max(c).alias(f"max_{c}") for c in columns])
