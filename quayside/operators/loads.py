"""Load log: totals, latest status, row-count outlier bounds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.functions.text import lit_or_col, thousands
from quayside.operators.merge import merge_upsert
from quayside.operators.ranks import ntile_of, value_ranks

BOUND_COLUMNS = ["q_three", "q_one", "outlier_range", "lower_bound", "upper_bound", "bounds"]


def array_sum(items, field: str) -> Column:
    """Sum of a field over an array of structs; NULL when nothing can be added."""
    return F.aggregate(
        lit_or_col(items),
        F.lit(None).cast("bigint"),
        lambda total, x: F.coalesce(total + x[field].cast("bigint"), x[field].cast("bigint"), total),
    )


def with_load_totals(log: DataFrame, results: str = "process_result.msg_copy_result") -> DataFrame:
    """Add ``rows_loaded`` and ``rows_parsed``, summed inside each log row. Log
    ids are unique, so nothing has to be exploded, grouped or joined back."""
    return log.withColumns(
        {"rows_loaded": array_sum(results, "rows_loaded"), "rows_parsed": array_sum(results, "rows_parsed")}
    )


def load_totals(log: DataFrame, results: str = "process_result.msg_copy_result") -> DataFrame:
    """``(id, rows_loaded, rows_parsed)`` of the loads that report results."""
    return with_load_totals(log.where(F.size(results) > 0), results).select("id", "rows_loaded", "rows_parsed")


def latest_log(entries: DataFrame, logged_at: str = "logged_at") -> DataFrame:
    """Current row of each load from an append-only log (RUNNING, then the end
    state). ``max_by`` keeps one row per task, however many entries an id has."""
    rest = [c for c in entries.columns if c not in ("id", logged_at)]
    newest = F.max_by(F.struct(*rest), F.col(logged_at)).alias("_row")
    return entries.groupBy("id").agg(newest).select("id", "_row.*")


def outlier_bounds(loads: DataFrame) -> DataFrame:
    """Row-count bounds per dataset from its successful loads.

    ``loads`` holds ``dataset_name, rows_loaded, process_status``. The quartiles
    are the values at rank floor(0.75 n) and floor(0.25 n); with three loads or
    fewer there is no lower quartile and the bounds are NULL.
    """
    counts = loads.where(F.col("process_status") == "SUCCESS").select("dataset_name", "rows_loaded", F.lit(1).alias("n"))
    return bounds_of_counts(counts)


def bounds_of_counts(counts: DataFrame) -> DataFrame:
    """Bounds from ``(dataset_name, rows_loaded, n)``: how many loads had how many rows."""
    counts = counts.select("dataset_name", F.col("rows_loaded").cast("double").alias("n"), F.col("n").alias("_times"))
    ranks = value_ranks(counts, ["dataset_name"], "n", "_times")

    def at(share):
        rank = F.floor(F.col("group_rows") * share)
        return F.max(F.when(rank.between(F.col("first_rank"), F.col("last_rank")), F.col("n")))

    quartiles = ranks.groupBy("dataset_name").agg(at(0.75).alias("q_three"), at(0.25).alias("q_one"))
    q_one, q_three, width = F.col("q_one"), F.col("q_three"), F.col("outlier_range")
    lower = F.when(q_one - width < 0, F.lit(0.0)).otherwise(q_one - width)
    return (
        quartiles.withColumn("outlier_range", F.round(1.5 * (q_three - q_one), 0))
        .withColumn("lower_bound", lower)
        .withColumn("upper_bound", q_three + width)
        .withColumn(
            "bounds",
            F.concat(F.lit("["), thousands("lower_bound"), F.lit(" - "), thousands("upper_bound"), F.lit("]")),
        )
        .select("dataset_name", *BOUND_COLUMNS)
    )


def refresh_bounds(current: DataFrame, fresh: DataFrame) -> DataFrame:
    """Nightly refresh: datasets that no longer report keep their old bounds."""
    return merge_upsert(current, fresh, ["dataset_name"])


def row_count_ranks(loads: DataFrame) -> DataFrame:
    """How the row counts of a dataset are spread: rank range and quarter (of
    four equal tiles) for each distinct row count of its successful loads."""
    counts = loads.where(F.col("process_status") == "SUCCESS").select("dataset_name", "rows_loaded")
    ranks = value_ranks(counts, ["dataset_name"], "rows_loaded")
    rows = F.col("group_rows")
    return ranks.select(
        "*",
        ntile_of(F.col("first_rank"), rows, 4).cast("int").alias("first_quarter"),
        ntile_of(F.col("last_rank"), rows, 4).cast("int").alias("last_quarter"),
    )
