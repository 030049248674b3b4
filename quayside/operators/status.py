"""Load status report: durations, lateness, row-count verdict and progress."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.functions.dates import STATIC_COB, boundaries, cob_of, parse_http_date
from quayside.functions.paths import leaf, without_leaf
from quayside.operators.loads import array_sum, with_load_totals
from quayside.plans.expected import at_cob, latest_cobs

# Label of a load without any of the known states.
UNKNOWN_PROGRESS = "Unknow progress status"


def with_blob_summary(log: DataFrame, files: str = "blob_file.file_list") -> DataFrame:
    """Location, last change and total size of the files of a load, per row."""
    listed = F.col(files)
    return log.withColumns(
        {
            "blob_location": F.array_max(F.transform(listed, lambda x: without_leaf(x["name"]))),
            "blob_last_modified": parse_http_date(F.array_max(F.transform(listed, lambda x: x["last_modified"]))),
            "blob_bytes": array_sum(files, "size"),
        }
    )


def copy_text(command: Column) -> Column:
    """Load command laid out for reading."""
    for old, new in [('\\"', ""), ('",', '",\n'), ("FROM", "\n FROM \n")]:
        command = F.replace(command, F.lit(old), F.lit(new))
    return command


def load_status(
    log: DataFrame,
    calendar: DataFrame,
    catalog: DataFrame,
    bounds: DataFrame,
    as_of: Column,
    horizon: int,
) -> DataFrame:
    """One row per load whose COB is a calendar day.

    ``catalog`` is :func:`quayside.plans.expected.dataset_catalog`. Its paths are
    expanded for the COB of each load after the join, instead of joining with
    every (dataset, COB) pair; COBs outside the horizon get no dataset columns.
    """
    start, end = F.col("start_timestamp"), F.col("end_timestamp")
    cob = F.when(F.col("cob_id") == STATIC_COB, cob_of(start)).otherwise(F.col("cob_id").try_cast("int"))
    stage_file = F.col("process_parameters.file_stage_me")
    loads = with_blob_summary(with_load_totals(log))
    result = log.schema["process_result"].dataType.names
    command = copy_text(F.col("process_result.cmd_copy")) if "cmd_copy" in result else F.lit(None).cast("string")
    loads = loads.select(
        F.col("id").alias("staging_log_id"),
        cob.alias("cob_id"),
        F.col("process_status").alias("stage_status"),
        "dataset_name",
        without_leaf(stage_file).alias("log_file_path"),
        leaf(stage_file).alias("log_file_name"),
        "start_timestamp",
        "end_timestamp",
        boundaries("second", start, end).alias("staging_duration_seconds"),
        command.alias("copy_command"),
        "blob_last_modified",
        "blob_bytes",
        (F.col("blob_bytes") / 1024).alias("blob_kib"),
        "blob_location",
        boundaries("second", "blob_last_modified", F.coalesce(start, as_of)).alias("wait_for_staging_seconds"),
        "rows_loaded",
        "rows_parsed",
    )
    days = calendar.select("cob_id", "next_business_day")
    cobs = latest_cobs(calendar, as_of, horizon)
    oldest, newest = cobs.agg(F.min("cob_id")).scalar(), cobs.agg(F.max("cob_id")).scalar()
    within = F.col("cob_id").between(oldest, newest) & F.col("dataset_name").isNotNull()

    report = (
        loads.join(days, "cob_id")
        .withColumn("_dataset", F.when(within, F.col("dataset_name")))
        .join(catalog.withColumnRenamed("dataset_name", "_dataset"), "_dataset", "left")
        .drop("_dataset")
        .join(bounds.select("dataset_name", "lower_bound", "upper_bound", "bounds"), "dataset_name", "left")
    )
    report = at_cob(report, "cob_id")

    expected = F.try_to_timestamp(
        F.concat_ws(" ", F.col("next_business_day").cast("string"), F.col("expected_stage_time"))
    )
    expected = F.when(F.col("expected_stage_time").isNotNull(), expected)
    late = F.col("minutes_past_expected")
    verdict = (
        F.when(F.upper("stage_status") != "SUCCESS", F.lit(None).cast("string"))
        .when(F.col("rows_loaded").between(F.col("lower_bound"), F.col("upper_bound")), F.concat(F.lit("OK "), "bounds"))
        .otherwise(F.concat(F.lit("Out of bounds "), "bounds"))
    )
    progress = (
        F.when(start.isNotNull() & end.isNull(), "Staging started")
        .when(end.isNotNull(), "Staging finished")
        .when(F.col("blob_location").isNull(), "File not received")
        .when(start.isNull() & F.col("blob_location").isNotNull(), "Staging not started")
        .otherwise(UNKNOWN_PROGRESS)
    )
    return (
        report.withColumn("expected_staging_timestamp", expected)
        .withColumn(
            "minutes_past_expected", boundaries("minute", "expected_staging_timestamp", F.coalesce(end, as_of))
        )
        .withColumn("expected_rows_status", verdict)
        .withColumn("kpi_expected_end", F.when(late.isNull(), "N/A").when(late <= 0, "On Time").otherwise("Overdue"))
        .withColumn("staging_progress", progress)
    )
