"""Checks on configuration before it is synchronised."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.operators.dedupe import duplicate_keys, missing_references
from quayside.plans.catalog import FEED_KEYS


def metadata_problems(
    files: DataFrame, fields: DataFrame, parameters: DataFrame, formats: DataFrame, stages: DataFrame
) -> DataFrame:
    """All problems at once: ``(check, key, n_rows)``. Unknown file formats and
    stages, and duplicate keys of the four key sets."""

    def duplicates(label: str, df: DataFrame, keys: list[str]) -> DataFrame:
        return duplicate_keys(df, keys).select(
            F.lit(label).alias("check"), F.to_json(F.struct(*keys)).alias("key"), "n_rows"
        )

    def unknown(label: str, column: str, allowed: DataFrame) -> DataFrame:
        return missing_references(files, column, allowed).select(
            F.lit(label).alias("check"), F.col("value").alias("key"), F.lit(1).cast("bigint").alias("n_rows")
        )

    return reduce(
        DataFrame.unionByName,
        [
            unknown("file format", "file_format", formats),
            unknown("stage", "stage_name", stages),
            duplicates("source file", files, FEED_KEYS),
            duplicates("source field", fields, [*FEED_KEYS, "source_field_name"]),
            duplicates("target field", fields, [*FEED_KEYS, "target_field_name"]),
            duplicates("dataset", parameters, ["dataset_name"]),
        ],
    )


def validate_metadata(*tables: DataFrame) -> str:
    """Raise with every problem listed, or confirm."""
    problems = metadata_problems(*tables).orderBy("check", "key").collect()
    if problems:
        raise ValueError("Metadata not valid:\n" + "\n".join(f"{p['check']}: {p['key']}" for p in problems))
    return "Metadata was successfully verified."
