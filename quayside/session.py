"""Session settings the library relies on, and the shared scratch location."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # splits of a file depend on its size only, not on the executors that happen to be registered
    "spark.sql.files.minPartitionNum": "200",
    # windows-1252 files need the JVM charset list
    "spark.sql.legacy.javaCharsets": "true",
}


def build_session(app: str = "quayside", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, beside: str, label: str) -> str:
    """A fresh path on shared storage: under ``spark.checkpoint.dir`` when the
    cluster names one, otherwise next to ``beside`` (the table being written)."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    unique = f"{label}-{uuid.uuid4().hex}"
    if base:
        return f"{base.rstrip('/')}/{unique}"
    return f"{beside.rstrip('/')}__work/{unique}"
