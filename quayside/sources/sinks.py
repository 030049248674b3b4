"""Load targets: partitioned Parquet tables, reloads, exports, snapshots."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.session import scratch_path

LOAD_PARTITIONS = ["cob_id", "dataset_name"]


def _hadoop_path(spark: SparkSession, path: str):
    jvm = spark._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _hadoop_path(spark, path)
    return fs.exists(hadoop_path)


def read_table(spark: SparkSession, path: str, empty: str | None = None) -> DataFrame | None:
    """The stored rows with all columns ever loaded. Before the first row (a load whose files were all left out stores
    none) an empty table of the columns ``empty``, None if they are not given."""
    before = None if empty is None else spark.createDataFrame([], empty)
    if not path_exists(spark, path):
        return before
    try:
        return spark.read.option("mergeSchema", True).parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "UNABLE_TO_INFER_SCHEMA":
            return before
        raise


def _write(df: DataFrame, path: str, mode: str, partitions: Sequence[str]) -> None:
    # rebalance: small partitions are written by one task, a hot one by several
    (
        df.hint("rebalance", *[F.col(p) for p in partitions])
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partitions)
        .parquet(path)
    )


def append_load(df: DataFrame, path: str, partitions: Sequence[str] = LOAD_PARTITIONS) -> None:
    _write(df, path, "append", partitions)


def reload_by_dataset(df: DataFrame, path: str, partitions: Sequence[str] = LOAD_PARTITIONS) -> None:
    """Replace exactly the (COB, dataset) partitions present in ``df``."""
    _write(df, path, "overwrite", partitions)


def clear_partitions(spark: SparkSession, path: str, values: Iterable[tuple[int, str]]) -> None:
    """Remove the earlier load of (COB, dataset) pairs that received no rows."""
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    for cob, dataset in values:
        fs, part = _hadoop_path(spark, f"{path}/cob_id={cob}/dataset_name={escape(str(dataset))}")
        if fs.exists(part):
            fs.delete(part, True)


def reload_by_file(
    df: DataFrame, path: str, partitions: Sequence[str] = LOAD_PARTITIONS, file_key: str = "file_key"
) -> None:
    """Replace the rows of the files in ``df`` inside the partitions they touch.

    A file is found by ``(cob_id, file name without slashes)``, whatever dataset
    it was loaded under. Spark writes dynamic partitions to a staging folder and
    moves them when all are written, so the rows are read from the table and
    written to it once; the incoming rows and the touched partitions are written
    beside it first, because they are read more than once.
    """
    spark = df.sparkSession
    table = read_table(spark, path)
    if table is None:
        return append_load(df, path, partitions)

    def keyed(d):
        return d.withColumn(file_key, F.replace("file_name", F.lit("/"), F.lit("")))

    work = scratch_path(spark, path, "reload")
    incoming_path, touched_path = f"{work}/incoming", f"{work}/touched"
    df.write.parquet(incoming_path)
    incoming = keyed(spark.read.parquet(incoming_path))
    keys = ["cob_id", file_key]
    new_files = incoming.select(*keys).distinct()
    # a file lies in partitions of its COB only; no more are read
    stored = keyed(table)
    if "cob_id" in partitions:
        cobs = [r[0] for r in new_files.select("cob_id").distinct().collect()]
        stored = stored.where(F.col("cob_id").isin(cobs))
    # partitions to rewrite: where the files lie now, and where their new rows go
    lies = stored.join(new_files, keys, "left_semi").select(*partitions)
    touched = lies.unionByName(incoming.select(*partitions)).distinct()
    touched.write.parquet(touched_path)
    touched = spark.read.schema(touched.schema).parquet(touched_path)
    kept = stored.join(touched, list(partitions), "left_semi").join(new_files, keys, "left_anti")
    filled = kept.select(*partitions).unionByName(incoming.select(*partitions)).distinct()
    emptied = touched.join(filled, list(partitions), "left_anti").collect()
    merged = kept.unionByName(incoming, allowMissingColumns=True).drop(file_key)
    _write(merged, path, "overwrite", partitions)
    clear_partitions(spark, path, [tuple(r) for r in emptied])
    remove_path(spark, work)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder that this run made."""
    fs, folder = _hadoop_path(spark, path)
    fs.delete(folder, True)


def not_yet_loaded(manifest: DataFrame, log: DataFrame, keys: Sequence[str], status: str = "process_status") -> DataFrame:
    """Files of the manifest that have no successful load in the log."""
    done = log.where(F.col(status) == "SUCCESS").select(*keys).distinct()
    return manifest.join(done, list(keys), "left_anti")


def export_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def publish(df: DataFrame, name: str, version: str) -> str:
    """Write ``df`` as a new version of a table and point the view ``name`` at it.
    The old version stays readable until the view has been switched."""
    spark = df.sparkSession
    table = f"{name}__v{version}"
    df.write.mode("overwrite").format("parquet").saveAsTable(table)
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {table}")
    return table


def seed_csv(spark: SparkSession, path: str, schema: str, view: str) -> DataFrame:
    """Configuration CSV with header to a temporary view (replaced each time)."""
    df = spark.read.schema(schema).option("header", True).csv(path)
    df.createOrReplaceTempView(view)
    return df
