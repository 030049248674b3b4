"""Files that arrived but were never staged."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.functions.paths import container_from_url

# Failures that a retry cannot mend (LIKE patterns).
KNOWN_FAILURES = [
    "%There is no metadata for the folder/file%",
    "%Object%does not exist or not authorized%",
    "%SQL compilation error%",
    "%File Format not found%",
]


def flat(path) -> Column:
    return F.replace(path, F.lit("/"), F.lit(""))


def unstaged_files(
    listing: DataFrame,
    expected: DataFrame,
    log: DataFrame,
    as_of: Column,
    is_production: bool = False,
    grace_minutes: int = 30,
    expanded_names: bool = False,
) -> DataFrame:
    """Latest listed files of an expected dataset that were not processed since
    their last change, did not fail for a known configuration reason, and are
    older than the grace period.

    The log is reduced to one row per file (last start that did not fail, and
    whether a known failure exists) before it is joined, so a file that was
    retried very often costs one row. ``expanded_names`` compares with the file
    name for the COB instead of its template.
    """
    files = listing.where(F.col("flag_last_version") & F.col("name").isNotNull())
    file_path = F.replace("name", F.col("stage_url"), F.lit(""))
    files = files.withColumns(
        {
            "container_name": container_from_url("stage_url", is_production),
            "external_file_path": file_path,
            "file_name": F.split_part(file_path, F.lit("/"), F.lit(-1)),
            "path_key": flat(file_path),
        }
    ).where(F.col("last_modified") + F.make_dt_interval(mins=F.lit(grace_minutes)) < as_of)

    name = F.col("file_name_cob") if expanded_names else F.col("file_name")
    wanted = expected.select(
        "cob_id", "stage_name", "file_extension", flat(F.concat("folder_path_cob", name)).alias("path_key")
    )
    failed = F.col("process_status") == "FAILED"
    known = failed & F.col("process_result.exception").like(KNOWN_FAILURES[0])
    for pattern in KNOWN_FAILURES[1:]:
        known = known | (failed & F.col("process_result.exception").like(pattern))
    history = log.groupBy(
        flat(F.col("process_parameters.file_stage_me")).alias("path_key"),
        F.col("process_parameters.container_name").alias("container_name"),
    ).agg(
        F.max(F.when(~failed, F.col("start_timestamp"))).alias("_last_start"),
        F.bool_or(known).alias("_hopeless"),
    )
    open_files = (
        files.join(wanted, ["cob_id", "stage_name", "file_extension", "path_key"])
        .join(history, ["path_key", "container_name"], "left")
        .where(
            (F.col("_last_start").isNull() | (F.col("_last_start") <= F.col("last_modified")))
            & ~F.coalesce("_hopeless", F.lit(False))
        )
    )
    folder = F.replace("external_file_path", F.col("file_name"), F.lit(""))
    return open_files.select(
        "cob_id",
        "stage_name",
        "container_name",
        folder.alias("folder_path"),
        "file_name",
        "folder",
        "file_extension",
        "stage_url",
        "external_file_path",
        "process_timestamp",
        "last_modified",
        F.concat(
            F.replace(folder, F.lit("/"), F.lit("_")), F.split_part("file_name", F.lit("."), F.lit(1)), "cob_id"
        ).alias("task_name"),
    )


def last_cobs(df: DataFrame, k: int) -> DataFrame:
    """The ``k`` latest distinct COBs."""
    return df.select("cob_id").distinct().orderBy(F.desc("cob_id")).limit(k)


def cob_range(df: DataFrame, k: int) -> DataFrame:
    """First and last of the ``k`` latest COBs, one row."""
    return last_cobs(df, k).agg(F.min("cob_id").alias("cob_start"), F.max("cob_id").alias("cob_end"))


def retry_set(unstaged: DataFrame, listing: DataFrame, k: int) -> DataFrame:
    """Unstaged files of the ``k`` latest listed COBs, as staging arguments."""
    span = cob_range(listing.where("flag_last_version"), k)
    first, last = span.select("cob_start").scalar(), span.select("cob_end").scalar()
    return unstaged.where(F.col("cob_id").between(first, last)).select(
        "cob_id", "file_name", F.col("folder_path"), F.col("container_name").alias("container"), "external_file_path"
    )
