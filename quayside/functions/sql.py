"""Path functions for SQL users, as temporary SQL functions of a session."""

from __future__ import annotations

from pyspark.sql import SparkSession

_FUNCTIONS = {
    "find_cob(file_path STRING) RETURNS STRING": (
        r"replace(regexp_substr(file_path, '(^|[^\\w]|\\s)\\d{8}([^\\w]|\\s|$)'), '/', '')"
    ),
    "replace_cob_pattern(file_path STRING, cob_id BIGINT) RETURNS STRING": (
        "replace(replace(replace(file_path, '|:YYYY:|', left(cast(cob_id AS STRING), 4)), "
        "'|:YYYYMM:|', left(cast(cob_id AS STRING), 6)), '|:YYYYMMDD:|', cast(cob_id AS STRING))"
    ),
    "strip_empty(string_in STRING, delimiter_in STRING) RETURNS STRING": (
        r"array_join(filter(split(string_in, concat('\\Q', delimiter_in, '\\E')), p -> p <> ''), delimiter_in)"
    ),
}


def register_functions(spark: SparkSession) -> list[str]:
    """Create the functions in the session; they are plain SQL expressions, so
    they are optimised with the query that calls them."""
    for signature, body in _FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURN {body}")
    return [s.split("(", 1)[0] for s in _FUNCTIONS]
