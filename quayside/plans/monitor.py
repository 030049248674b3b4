"""Monitoring loop: list storage, find unstaged files, stage them again. A
scheduler calls :func:`list_and_retry`; each step is a batch job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.operators.unstaged import cob_range, retry_set, unstaged_files
from quayside.plans.log import current_log
from quayside.plans.stage import StageOptions, stage_files
from quayside.sources.listing import list_storage, list_wanted


def list_latest(
    spark: SparkSession, root: str, expected: DataFrame, log: DataFrame, as_of: Column, k: int
) -> DataFrame:
    """List the folders expected for the ``k`` latest loaded COBs; other folders are not opened."""
    span = cob_range(log, k)
    first, last = span.select("cob_start").scalar(), span.select("cob_end").scalar()
    wanted = expected.where(F.col("cob_id").between(first, last))
    files = list_wanted(spark, root, wanted).withColumn("stage_url", F.lit(root))
    return list_storage(files, wanted, F.col("stage_url"), as_of).withColumn("stage_url", F.lit(root))


def list_and_retry(
    spark: SparkSession, listing: DataFrame, expected: DataFrame, options: StageOptions, as_of: Column, k: int
) -> DataFrame:
    """Stage the unstaged files of the ``k`` latest listed COBs again."""
    log = current_log(spark, options.log_path)
    open_files = unstaged_files(listing, expected, log, as_of, expanded_names=True)
    again = retry_set(open_files, listing, k)
    details = listing.where("flag_last_version").select(
        F.replace("name", F.col("stage_url"), F.lit("")).alias("external_file_path"),
        F.col("name").alias("path"),
        "size",
        "last_modified",
    )
    manifest = again.join(details.distinct(), "external_file_path").select(
        "path", "folder_path", "file_name", "container", "size", "last_modified"
    )
    return stage_files(spark, manifest.distinct(), expected, options, as_of)
