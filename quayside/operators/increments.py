"""Row-count bounds kept up to date from new loads only.

What a dataset's bounds depend on is how often each row count occurs. These counts add up, so each nightly increment stores
those of its own loads under its own name, and bounds are computed from the sums. Writing an increment again replaces it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.operators.loads import bounds_of_counts, refresh_bounds
from quayside.sources.sinks import path_exists

INCREMENT = "increment"


def count_values(loads: DataFrame) -> DataFrame:
    """``(dataset_name, rows_loaded, n)`` of the successful loads."""
    good = loads.where(F.col("process_status") == "SUCCESS")
    return good.groupBy("dataset_name", "rows_loaded").agg(F.count(F.lit(1)).alias("n"))


def merge_counts(*counts: DataFrame) -> DataFrame:
    """Counts of several increments added up."""
    every = counts[0]
    for other in counts[1:]:
        every = every.unionByName(other)
    return every.groupBy("dataset_name", "rows_loaded").agg(F.sum("n").alias("n"))


def write_increment(loads: DataFrame, path: str, name: str) -> None:
    """Store the counts of one increment's loads."""
    count_values(loads).write.mode("overwrite").parquet(f"{path}/{INCREMENT}={name}")


def read_counts(spark: SparkSession, path: str) -> DataFrame | None:
    """All increments added up; None before the first."""
    return merge_counts(spark.read.parquet(path).drop(INCREMENT)) if path_exists(spark, path) else None


def refresh_from_increment(spark: SparkSession, path: str, name: str, current: DataFrame | None = None) -> DataFrame:
    """New bounds for the datasets of one increment, the others keep those of ``current``."""
    touched = spark.read.parquet(f"{path}/{INCREMENT}={name}").select("dataset_name").distinct()
    fresh = bounds_of_counts(read_counts(spark, path).join(touched, "dataset_name", "left_semi"))
    return fresh if current is None else refresh_bounds(current, fresh)

