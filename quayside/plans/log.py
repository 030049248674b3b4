"""Append-only load log: one entry per state change of a (file, dataset) load."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.operators.loads import latest_log
from quayside.sources.sinks import path_exists

LOG_SCHEMA = """
    id bigint, cob_id bigint, dataset_name string,
    process_parameters struct<container_name:string, event_trigger:map<string,string>, file_stage_me:string,
        file_name:string, folder_path:string, database_target:string, flag_create_table:boolean,
        flag_create_csv_mapping:boolean>,
    process_result struct<msg_copy_result:array<struct<file:string, status:string, rows_parsed:bigint,
        rows_loaded:bigint, errors_seen:bigint>>, target_table:string, target_columns:string,
        create_table_result:string, exception:string, is_error:boolean>,
    process_status string, start_timestamp timestamp, end_timestamp timestamp,
    blob_file struct<file_list:array<struct<name:string, size:bigint, md5:string, last_modified:string>>,
        file_count:int>,
    logged_at timestamp
"""

_RESULT = (
    "struct<msg_copy_result:array<struct<file:string,status:string,rows_parsed:bigint,rows_loaded:bigint,"
    "errors_seen:bigint>>,target_table:string,target_columns:string,create_table_result:string,exception:string,"
    "is_error:boolean>"
)


def load_id(*parts) -> Column:
    """Id of a load from start time, COB, file, folder and dataset."""
    return F.xxhash64(*parts)


def http_date(c) -> Column:
    return F.concat(F.date_format(c, "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" GMT"))


def result_of(**values: Column | None) -> Column:
    """``process_result`` with the given members; the others are NULL."""
    names = ["msg_copy_result", "target_table", "target_columns", "create_table_result", "exception", "is_error"]
    members = [values.get(n) if values.get(n) is not None else F.lit(None) for n in names]
    return F.struct(*[m.alias(n) for m, n in zip(members, names)]).cast(_RESULT)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """Every entry; an empty log where none has been written yet."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], LOG_SCHEMA)
    return spark.read.schema(LOG_SCHEMA).parquet(path)


def current_log(spark: SparkSession, path: str) -> DataFrame:
    """Latest state of each load."""
    return latest_log(read_log(spark, path))


def append_log(entries: DataFrame, path: str) -> None:
    entries.write.mode("append").parquet(path)
