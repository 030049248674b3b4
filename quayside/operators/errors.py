"""File-level error policy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.functions.text import lit_or_col


def file_errors(df: DataFrame, file: str, bad) -> DataFrame:
    """Rows and bad rows per file, ``(file, rows_parsed, rows_bad)``."""
    return df.groupBy(file).agg(F.count(F.lit(1)).alias("rows_parsed"), F.count_if(lit_or_col(bad)).alias("rows_bad"))


def skipped_files(errors: DataFrame, limit) -> Column:
    """Whether a file has at least ``limit`` bad rows."""
    return (lit_or_col(limit) > 0) & (F.col("rows_bad") >= lit_or_col(limit))


def parsed_once(df: DataFrame, path: str) -> DataFrame:
    """Parsed rows, written to the scratch folder ``path`` and read from there: counting bad rows and loading good ones
    are then scans of a few columns and of typed values, and no cell is parsed twice."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def apply_error_policy(df: DataFrame, file: str, bad, limit: int, work: str | None = None) -> DataFrame:
    """``limit`` > 0: drop files with that many bad rows, and the bad rows of the
    others. ``limit`` = 0: the job fails on the first bad row. Bad rows are
    counted per file by partial aggregation; only the names of skipped files are
    joined back. With a scratch folder ``work`` (which the caller removes) ``df`` is
    computed once, without it once for counting and once for the result."""
    bad = lit_or_col(bad)
    if limit <= 0:
        stop = F.raise_error(F.concat(F.lit("bad row in file "), F.col(file).cast("string")))
        return df.where(F.when(bad, stop.cast("boolean")).otherwise(F.lit(True)))
    if work:
        df, bad = parsed_once(df.withColumn("_is_bad", bad), work), F.col("_is_bad")
    dropped = file_errors(df, file, bad).where(F.col("rows_bad") >= limit).select(file)
    return df.where(~bad).join(dropped, file, "left_anti").drop("_is_bad")
