"""Exact ranks inside groups of any size.

A window over one group would put the whole group into one task. Here equal
values are counted first (partial aggregation collapses repeats), the distinct
values of a group are cut into value-ordered buckets, and ranks are running
counts inside a bucket plus the counts of the buckets before it. The limits of the
buckets are quantiles of the group's own distinct values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Buckets of a group; their limits are quantiles of the group's distinct values.
BUCKETS = 128


def _bucketed(counted: DataFrame, group: list[str], value: str) -> DataFrame:
    """``counted`` with an order-preserving ``_bucket``; NULL has the last one. The buckets of a group hold about
    equally many distinct values, wherever these lie."""
    number = F.col(value).cast("double")
    shares = [i / BUCKETS for i in range(1, BUCKETS)]
    limits = counted.groupBy(*group).agg(F.percentile_approx(number, shares, 20 * BUCKETS).alias("_limits"))
    limits = limits.withColumnsRenamed({g: f"_g_{g}" for g in group})
    same = F.lit(True)
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"_g_{g}"))
    place = F.size(F.filter(F.array_distinct(F.coalesce("_limits", F.array().cast("array<double>"))), lambda x: x < number))
    bucket = F.when(number.isNull(), BUCKETS).otherwise(place)
    return counted.join(limits, same, "left").withColumn("_bucket", bucket).drop("_limits", *[f"_g_{g}" for g in group])


def value_ranks(df: DataFrame, group: Sequence[str], value: str, weight: str | None = None) -> DataFrame:
    """One row per group and distinct value: ``n_at_value`` rows hold ranks
    ``first_rank .. last_rank`` of ``group_rows``, ascending, NULL last. With ``weight`` a row
    stands for as many."""
    group = list(group)
    counted = df.groupBy(*group, value).agg((F.sum(weight) if weight else F.count(F.lit(1))).alias("n_at_value"))
    counted = _bucketed(counted, group, value)
    inside = (
        Window.partitionBy(*group, "_bucket")
        .orderBy(F.col(value).asc_nulls_last())
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    whole = Window.partitionBy(*group)
    earlier = whole.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = (
        counted.groupBy(*group, "_bucket")
        .agg(F.sum("n_at_value").alias("_n"))
        .select(
            *group,
            "_bucket",
            F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
            F.sum("_n").over(whole).alias("group_rows"),
        )
    )
    on = F.lit(True)
    for g in [*group, "_bucket"]:
        on = on & F.col(f"v.{g}").eqNullSafe(F.col(f"b.{g}"))
    ranked = counted.withColumn("_running", F.sum("n_at_value").over(inside)).alias("v").join(buckets.alias("b"), on)
    last = F.col("_before") + F.col("_running")
    return ranked.select(
        *[F.col(f"v.{g}") for g in group],
        F.col(f"v.{value}"),
        "n_at_value",
        (last - F.col("n_at_value") + 1).alias("first_rank"),
        last.alias("last_rank"),
        "group_rows",
    )


def ntile_of(rank: Column, rows: Column, tiles: int) -> Column:
    """Tile number of a rank, larger tiles first (as NTILE numbers them)."""
    base, extra = F.floor(rows / tiles), rows % tiles
    in_large = rank <= extra * (base + 1)
    return F.when(in_large, F.ceil(rank / (base + 1))).otherwise(
        extra + F.ceil((rank - extra * (base + 1)) / F.greatest(base, F.lit(1)))
    )
