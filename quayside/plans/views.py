"""All reports as temporary views over the stored tables, for SQL users."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.operators import loads, usage
from quayside.operators.status import load_status
from quayside.operators.unstaged import unstaged_files
from quayside.plans.catalog import feed_rollup, field_catalog, overall_config
from quayside.plans.expected import dataset_catalog, expected_datasets

# Stored tables a view reads.
TABLES = [
    "source_file", "source_field", "stage_me_parameters", "calendar", "load_log", "file_listing", "outlier_bounds",
    "pipe_history", "storage_usage", "compute_history", "query_history", "accounts",
]


# COBs of how many days the reports look back on, and days of the date dimension.
COB_DAYS = 180
DIMENSION_DAYS = 730


def build_views(tables: Mapping[str, DataFrame], database: str, as_of: Column, is_production: bool = False) -> dict[str, DataFrame]:
    """Every view whose tables are given. Names carry the prefix ``vw_``."""
    t, out = dict(tables), {}

    def have(*names: str) -> bool:
        return all(n in t for n in names)

    if have("source_file", "source_field"):
        out["vw_field_catalog"] = catalog = field_catalog(t["source_file"], t["source_field"], database)
        out["vw_feed_rollup"] = rollup = feed_rollup(catalog)
        if have("stage_me_parameters"):
            out["vw_overall_config"] = overall_config(catalog, t["stage_me_parameters"])
        if have("stage_me_parameters", "calendar"):
            expected = expected_datasets(t["stage_me_parameters"], rollup, t["calendar"], as_of, COB_DAYS)
            out["vw_expected_datasets"] = expected
            if have("load_log", "outlier_bounds"):
                datasets = dataset_catalog(t["stage_me_parameters"], rollup)
                out["vw_load_status"] = load_status(t["load_log"], t["calendar"], datasets, t["outlier_bounds"], as_of, COB_DAYS)
            if have("load_log", "file_listing"):
                out["vw_unstaged_files"] = unstaged_files(t["file_listing"], expected, t["load_log"], as_of, is_production)
    if have("load_log"):
        finished = loads.with_load_totals(t["load_log"]).select("dataset_name", "rows_loaded", "process_status")
        out["vw_outlier_bounds"] = loads.outlier_bounds(finished)
        today = t["load_log"].sparkSession.range(1).select(as_of.cast("date").alias("today"))
        out["vw_date_dimension"] = usage.date_dimension(today, DIMENSION_DAYS)
    reports = {
        "pipe_history": [("vw_pipe_usage", usage.pipe_usage)],
        "storage_usage": [("vw_storage_monthly", usage.storage_monthly)],
        "compute_history": [("vw_compute_metering", usage.compute_metering), ("vw_compute_clusters", usage.compute_clusters)],
        "query_history": [("vw_credit_estimate", usage.credit_estimate)],
        "accounts": [("vw_users", usage.users)],
    }
    for table, views in reports.items():
        if have(table):
            out.update({name: build(t[table]) for name, build in views})
    return out


def register_views(spark: SparkSession, tables: Mapping[str, DataFrame], database: str, as_of: Column | None = None) -> list[str]:
    """Create the views in the session; ``as_of`` defaults to the current time."""
    views = build_views(tables, database, F.current_timestamp() if as_of is None else as_of)
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return list(views)
