"""Continuous ingest of arriving files."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quayside.sources.scan import CORRUPT

BATCH = "ingest_batch"


def widen_path(path: str) -> str:
    """Path whose all-digit folders (COB parts) match any folder."""
    return "/".join("*" if part.isdigit() else part for part in path.split("/"))


def file_stream(spark: SparkSession, path: str, schema: str, kind: str = "csv", **options) -> DataFrame:
    """Stream of the rows of arriving files with the path they came from."""
    reader = spark.readStream.format(kind).schema(schema).options(**options)
    return reader.load(path).withColumn("file_name", F.col("_metadata.file_path"))


def drop_recent(files: DataFrame, modified: str, as_of, minutes: int = 30) -> DataFrame:
    """Leave files out that changed within the grace period before ``as_of``."""
    return files.where(F.col(modified) + F.make_dt_interval(mins=F.lit(minutes)) < as_of)


def ingest(
    stream: DataFrame,
    target: str,
    checkpoint: str,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    partitions: Sequence[str] = (),
    available_now: bool = True,
) -> StreamingQuery:
    """Append each micro-batch to the target under its own batch number.

    A batch that is run again after a failure overwrites exactly the partitions
    it wrote before, so every file is loaded once.
    """
    keys = [BATCH, *partitions]

    def load(batch: DataFrame, number: int) -> None:
        rows = transform(batch) if transform else batch
        (
            rows.withColumn(BATCH, F.lit(number))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*keys)
            .parquet(target)
        )

    writer = stream.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def split_corrupt(batch: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good and malformed rows of a batch read with a ``_corrupt`` column."""
    if CORRUPT not in batch.columns:
        return batch, batch.limit(0)
    return batch.where(F.col(CORRUPT).isNull()).drop(CORRUPT), batch.where(F.col(CORRUPT).isNotNull())
