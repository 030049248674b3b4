"""Counts of a stream by event-time window, kept in the state store until the watermark has passed them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

LATE = "30 minutes"
BATCH = "window_batch"


def windowed_counts(
    stream: DataFrame, at: str, keys: Sequence[str] = (), length: str = "1 hour", late: str = LATE,
    slide: str | None = None, measures: Mapping[str, Column] | None = None,
) -> DataFrame:
    """``(window_start, window_end, keys, n_events, measures)`` per window and key.

    Events up to ``late`` behind the latest event time are counted, later ones are dropped and their windows are removed from
    the state. Works on batch tables as well, where nothing is late. Events without a time are in no window."""
    window = F.window(at, length, slide) if slide else F.window(at, length)
    grouped = stream.withWatermark(at, late).groupBy(window, *keys)
    counted = grouped.agg(F.count(F.lit(1)).alias("n_events"), *[c.alias(n) for n, c in (measures or {}).items()])
    return counted.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *[c for c in counted.columns if c != "window"])


def keep_windows(counts: DataFrame, target: str, checkpoint: str, available_now: bool = True, every: str = "1 minute") -> StreamingQuery:
    """Write the windows that a batch has changed under the batch's number; a batch that is run again overwrites its own
    rows. :func:`read_windows` gives the current state of every window, open ones included."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/{BATCH}={number}")

    writer = counts.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=every)
    return writer.start()


def closed_windows(counts: DataFrame, target: str, checkpoint: str, available_now: bool = True, every: str = "1 minute") -> StreamingQuery:
    """Append each window once, when the watermark has passed its end."""
    writer = counts.writeStream.outputMode("append").format("parquet").option("path", target).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=every)
    return writer.start()


def read_windows(spark: SparkSession, target: str, keys: Sequence[str] = ()) -> DataFrame:
    """The latest row of each window and key."""
    rows = spark.read.parquet(target)
    own = ["window_start", "window_end", *keys]
    rest = [c for c in rows.columns if c not in (*own, BATCH)]
    latest = rows.groupBy(*own).agg(F.max_by(F.struct(*rest), F.col(BATCH)).alias("_row"))
    return latest.select(*own, "_row.*")
