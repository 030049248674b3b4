"""File listings and the versioned listing log."""

from __future__ import annotations

import re
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.functions.paths import ancestors, depth, folder_parts, slash_wrapped
from quayside.sources.sinks import path_exists

LISTING_KEYS = ["cob_id", "stage_name", "folder", "file_extension"]


def list_files(
    spark: SparkSession,
    root: str | Sequence[str],
    regex: str | None = None,
    with_md5: bool = False,
    include_empty: bool = False,
) -> DataFrame:
    """``(name, size, last_modified[, md5])`` of the files below ``root`` (one or
    several folders). Contents are read only when the checksum is asked for. Spark's
    file scan leaves empty files out; ``include_empty`` (for folders with empty
    trigger files) adds them from a walk over the folders."""
    roots = [root] if isinstance(root, str) else list(root)
    return _listed(spark, roots, roots, regex, with_md5, include_empty)


def _listed(spark: SparkSession, roots: list[str], scanned: list[str], regex, with_md5: bool, include_empty: bool) -> DataFrame:
    columns: list[Column] = [
        F.col("path").alias("name"),
        F.col("length").alias("size"),
        F.col("modificationTime").alias("last_modified"),
    ]
    if with_md5:
        columns.append(F.md5("content").alias("md5"))
    if scanned:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(scanned)
    else:
        files = spark.createDataFrame([], "path string, modificationTime timestamp, length bigint, content binary")
    files = files.select(*columns)
    if include_empty and roots:
        files = files.unionByName(_empty_files(spark, roots), allowMissingColumns=True)
    return files.where(F.rlike("name", F.lit(regex))) if regex else files


def top_folders(folders: DataFrame, column: str = "folder_path_cob") -> DataFrame:
    """Distinct folders (``/a/b/``) of a column that lie in no other folder of it."""
    every = folders.select(slash_wrapped(column).alias("folder")).distinct()
    above = every.withColumn("_above", F.explode(ancestors(folder_parts("folder")))).where(F.col("_above") != F.col("folder"))
    inner = above.join(every.select(F.col("folder").alias("_above")), "_above", "left_semi").select("folder")
    return every.join(inner.distinct(), "folder", "left_anti")


def list_wanted(
    spark: SparkSession, root: str, expected: DataFrame, regex: str | None = None, with_md5: bool = False, include_empty: bool = False
) -> DataFrame:
    """As :func:`list_files`, of the expected folders below ``root`` only: the walk starts at these folders, so nothing
    beside them is opened, and Spark hands it to executors once it has more folders than
    ``spark.sql.sources.parallelPartitionDiscovery.threshold``. The driver holds the expected folders of the COBs asked
    for (configuration, not files) and asks for each whether it exists."""
    heads = [root.rstrip("/") + r["folder"] for r in top_folders(expected).toLocalIterator()]
    with ThreadPoolExecutor(LOOKUPS) as pool:
        there = [h for h, found in zip(heads, pool.map(lambda h: path_exists(spark, h), heads), strict=True) if found]
    return _listed(spark, there, [_literally(h) for h in there], regex, with_md5, include_empty)


def _literally(path: str) -> str:
    """A path whose letters that a scan would read as a pattern stand for themselves."""
    return re.sub(r"([{}\[\]*?\\])", r"\\\1", path)


#: Folders whose existence is asked for at once.
LOOKUPS = 16


def _empty_files(spark: SparkSession, roots: list[str]) -> DataFrame:
    found = []
    for root in roots:
        path = spark._jvm.org.apache.hadoop.fs.Path(root)
        walk = path.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(path, True)
        while walk.hasNext():
            f = walk.next()
            if f.getLen() == 0:
                found.append((f.getPath().toString(), 0, f.getModificationTime()))
    rows = spark.createDataFrame(found, "name string, size bigint, ms bigint")
    return rows.select("name", "size", F.timestamp_millis("ms").alias("last_modified"))


def list_storage(listing: DataFrame, expected: DataFrame, stage_url, as_of: Column) -> DataFrame:
    """Match one listing against every expected folder and extension.

    ``listing`` holds ``name`` below ``stage_url``; ``expected`` holds
    ``cob_id, stage_name, folder_path_cob, file_extension``. Every expected folder
    gives one row without a file (it stands for the listing itself, so that a
    folder that has become empty replaces its earlier listing) and one row per
    file. Both are an inner join and a union: a folder with very many files can be
    split over tasks, which an outer join could not do.
    """
    wanted = expected.select(
        "cob_id",
        "stage_name",
        slash_wrapped("folder_path_cob").alias("_folder"),
        F.regexp_replace("folder_path_cob", "^/", "").alias("folder"),
        "file_extension",
    ).distinct()
    below = F.replace(F.col("name"), F.lit(stage_url) if isinstance(stage_url, str) else stage_url, F.lit(""))
    files = (
        listing.withColumn("file_path", below)
        .withColumn("_parts", folder_parts(F.regexp_extract("file_path", "^(.*/)?[^/]*$", 1)))
        .withColumn("_folder", F.explode(ancestors("_parts")))
    )
    # only ancestors of a depth that some expected folder has are shuffled, so the root is not a hot key
    depths = wanted.agg(F.collect_set(depth("_folder"))).scalar()
    files = files.where(F.array_contains(depths, depth("_folder"))).select("_folder", *listing.columns, "file_path")
    # the listing pattern is <folder>.*.<extension>: one more character, then the extension
    reaches = (
        F.endswith(F.col("file_path"), F.col("file_extension"))
        & (F.length("file_path") > F.length("folder") + F.length("file_extension"))
    )
    found = wanted.join(files.withColumnRenamed("_folder", "_f"), (F.col("_folder") == F.col("_f")) & reaches)
    both = found.drop("_folder", "_f").unionByName(wanted.drop("_folder"), allowMissingColumns=True)
    return both.withColumn("process_timestamp", as_of)


def flag_latest(log: DataFrame, keys: Sequence[str], version: str, into: str = "flag_last_version") -> DataFrame:
    """Flag the rows of the latest version of each key. The latest version is
    aggregated first (partial sums per task), so a key with very many rows is
    never gathered in one window partition."""
    latest = log.groupBy(*keys).agg(F.max(version).alias("_latest"))
    same = F.coalesce(F.col(version) == F.col("_latest"), F.col(version).isNull())
    return log.join(latest, list(keys), "left").withColumn(into, same).drop("_latest")


def append_listing(log: DataFrame, fresh: DataFrame, keys: Sequence[str] = LISTING_KEYS) -> DataFrame:
    """Add a listing to the log: earlier versions of a listed key lose the flag."""
    listed = fresh.select(*keys).distinct().withColumn("_listed", F.lit(True))
    older = (
        log.join(listed, list(keys), "left")
        .withColumn("flag_last_version", F.col("flag_last_version") & F.col("_listed").isNull())
        .drop("_listed")
    )
    return older.unionByName(fresh.withColumn("flag_last_version", F.lit(True)), allowMissingColumns=True)
