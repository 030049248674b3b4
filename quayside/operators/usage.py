"""Usage reports over platform history tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.functions.dates import boundaries, day_parts
from quayside.functions.text import split_part

# Credits per hour by compute size.
CREDITS_PER_HOUR = {
    "X-Small": 1,
    "Small": 2,
    "Medium": 4,
    "Large": 8,
    "X-Large": 16,
    "2X-Large": 32,
    "3X-Large": 64,
    "4X-Large": 128,
}

# Size suffix of a compute name.
SIZE_SUFFIXES = {
    "XS": "X-Small",
    "S": "Small",
    "M": "Medium",
    "L": "Large",
    "XL": "X-Large",
    "2XL": "2X-Large",
    "3XL": "3X-Large",
    "4XL": "4X-Large",
}

# Label of an unreadable size suffix.
UNKNOWN_SIZE = "Unknow"

_TIB = float(1024**4)


def date_dimension(as_of: DataFrame, days: int) -> DataFrame:
    """The ``days`` days up to and including a date. ``as_of`` is a one-row,
    one-column DataFrame holding that date."""
    last = F.col(as_of.columns[0])
    dates = as_of.select(F.explode(F.sequence(F.date_sub(last, days - 1), last)).alias("date"))
    return dates.select("date", *[c.alias(n) for n, c in day_parts("date").items()])


def pipe_usage(history: DataFrame) -> DataFrame:
    return history.select(
        "pipe_id",
        "pipe_name",
        "start_time",
        "end_time",
        "credits_used",
        "bytes_inserted",
        "files_inserted",
        F.to_date("start_time").alias("start_date"),
        boundaries("hour", "start_time", "end_time").alias("operation_hours"),
        F.hour("start_time").alias("time_of_day"),
    )


def compute_metering(history: DataFrame) -> DataFrame:
    return history.select(
        "start_time",
        "end_time",
        "warehouse_id",
        "warehouse_name",
        "credits_used",
        F.to_date("start_time").alias("start_date"),
        F.to_date("end_time").alias("end_date"),
        boundaries("hour", "start_time", "end_time").alias("operation_hours"),
        F.date_format("start_time", "HH:mm:ss").alias("time_of_day"),
    )


def storage_monthly(usage: DataFrame) -> DataFrame:
    """Average stored bytes per month in TiB, in total and by kind."""

    def mean_tib(total: Column) -> Column:
        # integer sums are exact, so the result does not depend on row order
        return F.sum(total).cast("double") / F.count(total) / _TIB

    parts = {k: F.col(f"{k}_bytes").cast("bigint") for k in ("storage", "stage", "failsafe")}
    month = F.trunc(F.to_date("usage_date"), "month").alias("usage_month")
    return usage.groupBy(month).agg(
        mean_tib(parts["storage"] + parts["stage"] + parts["failsafe"]).alias("total_tb"),
        *[mean_tib(c).alias(f"{k}_tb") for k, c in parts.items()],
    )


def credit_estimate(queries: DataFrame) -> DataFrame:
    """Estimated credits per user, compute and month: seconds of work times the
    hourly weight of the size. Unknown sizes weigh nothing."""
    weight = F.lit(0)
    for size, credits in CREDITS_PER_HOUR.items():
        weight = F.when(F.col("warehouse_size") == size, credits).otherwise(weight)
    millis = F.col("total_elapsed_time").cast("bigint")
    month = F.trunc(F.to_date("start_time"), "month").alias("month_date")
    return queries.groupBy(
        F.upper("user_name").alias("user_name"), "warehouse_size", "warehouse_id", "warehouse_name", month
    ).agg(
        F.count(F.lit(1)).alias("count_execution"),
        # the weighted milliseconds are summed as integers, then scaled once
        (F.sum(millis * weight).cast("double") / 3600000.0).alias("estimated_credits"),
        F.sum("credits_used_cloud_services").alias("credits_used_cloud_services"),
    )


def users(accounts: DataFrame) -> DataFrame:
    """One row per login without regard to case, plus the system account."""
    login = F.upper("login_name")
    known = accounts.groupBy(login.alias("user_name")).agg(
        F.max("display_name").alias("display_name"),
        F.max("default_role").alias("default_role"),
        F.max("last_success_login").alias("last_success_login"),
    )
    known = known.withColumn("display_name", F.coalesce("display_name", "user_name"))
    system = accounts.sparkSession.range(1).select(F.lit("SYSTEM").alias("user_name"), F.lit("System").alias("display_name"))
    return known.unionByName(system, allowMissingColumns=True).distinct()


def compute_clusters(history: DataFrame, sized_families: tuple[str, ...] = ()) -> DataFrame:
    """Distinct compute names with environment, database and size read from the
    name. Names of ``sized_families`` that end in ``WH`` get the suffix ``_XS``."""
    name = F.col("warehouse_name")
    suffix = split_part(name, "_", -1)
    in_family = F.lit(False)
    for family in sized_families:
        in_family = in_family | F.contains(name, F.lit(family))
    code = F.when(suffix == "WH", "XS").otherwise(suffix)
    size = F.lit(UNKNOWN_SIZE)
    for key, label in SIZE_SUFFIXES.items():
        size = F.when(code == key, label).otherwise(size)
    return (
        history.select("warehouse_id", "warehouse_name")
        .distinct()
        .select(
            "warehouse_id",
            name.alias("warehouse_name_original"),
            F.when(in_family & (suffix == "WH"), F.concat(name, F.lit("_XS"))).otherwise(name).alias("warehouse_name"),
            split_part(name, "_", 1).alias("warehouse_environment"),
            split_part(name, "_", 2).alias("warehouse_database"),
            size.alias("warehouse_size"),
            F.substring(name, 1, 4).alias("environment_code"),
        )
    )
