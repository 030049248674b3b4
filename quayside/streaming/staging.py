"""Continuous staging: every micro-batch of arriving files is a staging run.

The stream carries file names, not rows: matching, typed projection, lineage, error policy and log are those of
:func:`quayside.plans.stage.stage_files`. Rows are loaded by file into the (COB, dataset) partitions of the target,
so the batches of one load add up, whichever batch a file came with.

A ledger holds two entries for each batch: when it began and that it is done. A batch that is run again after it was done
does nothing. One that was interrupted is staged again under its first start time: its rows replace what the
interrupted attempt may have written, and its log entries have the same ids, so the log keeps one state of each load.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quayside.plans.stage import StageOptions, manifest_of, stage_files
from quayside.sources.sinks import path_exists

ARRIVALS = "path string, modificationTime timestamp, length bigint, content binary"
LEDGER = "at timestamp, files bigint, batch bigint, state string"


def file_arrivals(spark: SparkSession, root: str, glob: str = "*", files_per_batch: int | None = None) -> DataFrame:
    """Stream of the files that arrive below ``root``: ``(name, size, last_modified)``. Their content is not read."""
    reader = spark.readStream.format("binaryFile").schema(ARRIVALS)
    reader = reader.option("recursiveFileLookup", True).option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(root).select(
        F.col("path").alias("name"), F.col("length").alias("size"), F.col("modificationTime").alias("last_modified")
    )


class BatchLedger:
    """Start and end of each batch of one stream, as a table partitioned by batch and state."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _entry(self, batch: int, state: str) -> str:
        return f"{self.path}/batch={batch}/state={state}"

    def has(self, batch: int, state: str) -> bool:
        return path_exists(self.spark, f"{self._entry(batch, state)}/_SUCCESS")

    def write(self, batch: int, state: str, at: dt.datetime, files: int) -> None:
        row = self.spark.createDataFrame([(at, files)], "at timestamp, files bigint")
        row.write.mode("overwrite").parquet(self._entry(batch, state))

    def begin(self, batch: int, files: int) -> dt.datetime:
        """The batch's first start time; an interrupted batch keeps its own."""
        if not self.has(batch, "begun"):
            now = self.spark.range(1).select(F.current_timestamp()).first()[0]
            self.write(batch, "begun", now, files)
        return self.spark.read.parquet(self._entry(batch, "begun")).first()["at"]

    def entries(self) -> DataFrame:
        if not path_exists(self.spark, self.path):
            return self.spark.createDataFrame([], LEDGER)
        return self.spark.read.schema(LEDGER).parquet(self.path)


Stage = Callable[[SparkSession, DataFrame, DataFrame, StageOptions, object], DataFrame]


def stage_arrivals(
    arrivals: DataFrame,
    expected: DataFrame,
    options: StageOptions,
    checkpoint: str,
    ledger: str,
    container: str = "",
    available_now: bool = True,
    every: str = "1 minute",
    stage: Stage = stage_files,
) -> StreamingQuery:
    """Stage arriving files (:func:`file_arrivals`) batch by batch.

    ``expected`` is evaluated anew for every batch, so new COBs and configuration are seen. A failing dataset is logged
    and does not stop the stream. A batch without files leaves a ledger entry only."""
    spark = arrivals.sparkSession
    book = BatchLedger(spark, ledger)
    by_file = replace(options, by_file=True)

    def run(batch: DataFrame, number: int) -> None:
        if book.has(number, "done"):
            return
        manifest = manifest_of(batch, options.stage_root, container)
        files = manifest.count()
        begun = book.begin(number, files)
        if files:
            stage(spark, manifest, expected, by_file, F.lit(begun))
        book.write(number, "done", spark.range(1).select(F.current_timestamp()).first()[0], files)

    writer = arrivals.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=every)
    return writer.start()
