"""Synchronise the stored configuration with its seed tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.functions.paths import slash_wrapped
from quayside.functions.text import split_tags
from quayside.operators.merge import merge_sync
from quayside.plans.catalog import FEED_KEYS

KEYS = {
    "source_file": FEED_KEYS,
    "source_field": [*FEED_KEYS, "source_field_name"],
    "stage_me_parameters": ["dataset_name"],
}


def prepare_parameters(seed: DataFrame) -> DataFrame:
    """Seed rows as stored: slashes around the path, inference on by default,
    tags as an array."""
    return seed.withColumns(
        {
            "file_path": slash_wrapped(F.trim("file_path")),
            "allow_infer_schema": F.coalesce("allow_infer_schema", F.lit(True)),
            "tags": split_tags("tags"),
        }
    )


def sync_table(name: str, stored: DataFrame, seed: DataFrame, as_of: Column) -> DataFrame:
    """New content of one configuration table."""
    if name == "stage_me_parameters":
        # a row without a path takes the dataset out
        seed = prepare_parameters(seed.where("file_path is not null"))
    if name == "source_field":
        seed = seed.withColumn("source_field_name", F.trim("source_field_name"))
    # keys match without case; the seed's spelling is stored
    keys = KEYS[name]
    folded = [f"_key_{k}" for k in keys]

    def fold(df: DataFrame) -> DataFrame:
        return df.withColumns({f: F.upper(F.trim(F.col(k).cast("string"))) for f, k in zip(folded, keys, strict=True)})

    return merge_sync(fold(stored), fold(seed), folded, as_of).select(*stored.columns)
