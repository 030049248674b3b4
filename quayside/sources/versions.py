"""Tables as a sequence of complete versions: create, swap, drop.

A version is written to a folder of its own and becomes current by one marker file that names the folder. The marker is moved to
its place whole, and only if there is none yet: that move is the swap, so readers see the old version or the new one, never a
part, and of two writers one fails. A reader that has opened a version keeps reading it until it is dropped. The file system must
move a file in one step, as HDFS and local ones do.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.operators.merge import conform, schema_changes
from quayside.sources.sinks import path_exists, remove_path

MARKERS = "versions"


class VersionConflict(RuntimeError):
    """Another writer has published the version that this one was going to."""


def _markers(spark: SparkSession, root: str) -> dict[int, str]:
    """Data folder of each version; :func:`drop_versions` bounds their number."""
    if not path_exists(spark, f"{root}/{MARKERS}"):
        return {}
    rows = spark.read.text(f"{root}/{MARKERS}", wholetext=True).select(F.col("_metadata.file_name"), "value")
    return {int(name): folder.strip() for name, folder in rows.collect() if name.isdigit()}


def current_version(spark: SparkSession, root: str) -> int | None:
    return max(_markers(spark, root), default=None)


def read_version(spark: SparkSession, root: str, version: int | None = None) -> DataFrame | None:
    """The rows of a version, of the current one by default; None where there is none."""
    markers = _markers(spark, root)
    if not markers:
        return None
    wanted = max(markers) if version is None else version
    if wanted not in markers:
        raise ValueError(f"version {wanted} of {root} does not exist or was dropped")
    return spark.read.parquet(f"{root}/{markers[wanted]}")


def _place(spark: SparkSession, root: str, version: int, folder: str) -> bool:
    """Put the marker of a version in its place; False if there is one already."""
    fs = spark._jvm.org.apache.hadoop.fs
    conf = spark._jsc.hadoopConfiguration()
    made, place = fs.Path(f"{root}/.marker-{uuid.uuid4().hex}"), fs.Path(f"{root}/{MARKERS}/{version}")
    system = made.getFileSystem(conf)
    system.mkdirs(place.getParent())
    out = system.create(made)
    out.write(bytearray(folder.encode()))
    out.close()
    context = fs.FileContext.getFileContext(system.getUri(), conf)
    try:
        context.rename(made, place, spark.sparkContext._gateway.new_array(getattr(fs, "Options$Rename"), 0))
    except Py4JJavaError as e:
        system.delete(made, False)
        if "FileAlreadyExistsException" in str(e.java_exception):
            return False
        raise
    return True


def publish_version(df: DataFrame, root: str, after: int | None = None) -> int:
    """Write ``df`` as the version that follows ``after`` (the current one by default) and make it current. VersionConflict
    if another writer was first; its version stays and nothing of this one does."""
    spark = df.sparkSession
    after = current_version(spark, root) if after is None else after
    version = (after or 0) + 1
    folder = f"v{version}-{uuid.uuid4().hex}"
    df.write.parquet(f"{root}/{folder}")
    if not _place(spark, root, version, folder):
        remove_path(spark, f"{root}/{folder}")
        raise VersionConflict(f"version {version} of {root} exists")
    return version


def drop_versions(spark: SparkSession, root: str, keep: int = 1) -> list[int]:
    """Remove all but the latest ``keep`` versions; returns the dropped ones."""
    markers = _markers(spark, root)
    gone = sorted(markers)[: max(0, len(markers) - max(1, keep))]
    for version in gone:
        remove_path(spark, f"{root}/{MARKERS}/{version}")
        remove_path(spark, f"{root}/{markers[version]}")
    return gone


def swap_schema(
    spark: SparkSession, root: str, schema: Mapping[str, str], keep: int = 2
) -> list[tuple[str, str, str | None, str | None]]:
    """Rebuild the current version under ``schema`` if that differs, and return the changes.

    Shared columns are cast (values that cannot be cast become NULL), new ones are NULL, columns that are gone are left out.
    The old version stays readable until ``keep`` newer ones exist. Without a version an empty table is created."""
    table = read_version(spark, root)
    if table is None:
        empty = spark.range(0).select(*[F.lit(None).cast(kind).alias(name) for name, kind in schema.items()])
        publish_version(empty, root)
        return schema_changes({}, schema)
    kinds = {n: spark.range(0).select(F.lit(None).cast(k)).dtypes[0][1] for n, k in schema.items()}
    changes = schema_changes(dict(table.dtypes), kinds)
    if changes:
        publish_version(conform(table, schema), root, current_version(spark, root))
        drop_versions(spark, root, keep)
    return changes
