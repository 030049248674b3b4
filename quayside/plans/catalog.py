"""Configuration views: field catalogue, feed roll-up, overall configuration."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.functions.paths import file_extension
from quayside.functions.text import split_part
from quayside.functions.types import frame_type, sized_type

# Time zone of feeds that name none.
DEFAULT_TIMEZONE = "Europe/London"

FEED_KEYS = ["source_system_code", "source_feed_code"]

_FILE_COLUMNS = [
    "stage_name", "source_file_path", "source_file_name_pattern", "destination_schema_name",
    "destination_table_name", "destination_full_table_name", "is_enabled", "delete_stage_by_file_name",
    "file_format", "date_input_format", "timestamp_input_format", "skip_row_on_error", "timezone",
]

_FIELD_COLUMNS = [
    "source_field_name", "target_field_name", "field_ordinal", "data_type_name", "data_type_length",
    "data_type_precision", "data_type_scale", "is_in_source", "is_in_target", "is_deleted", "derived_expression",
]

# what a field's struct in ``fields`` holds
_FIELD_MEMBERS = [c for c in _FIELD_COLUMNS if c != "is_deleted"]


def field_catalog(files: DataFrame, fields: DataFrame, database: str) -> DataFrame:
    """Every feed with its live fields (feeds without fields stay), full table
    name, sized type and DataFrame type. Field keys match without case.

    The rows of a feed are dealt by its keys without case (:func:`_feed_groups`); grouping by them needs no second shuffle."""
    schema = F.col("destination_schema_name")
    table = F.when(
        F.contains(schema, F.lit("STAGING")),
        F.concat(schema, F.lit("."), "source_system_code", F.lit("_"), "destination_table_name"),
    ).otherwise(F.concat(schema, F.lit("."), "destination_table_name"))
    feeds = files.withColumns(
        {
            "destination_full_table_name": table,
            "timezone": F.coalesce("timezone", F.lit(DEFAULT_TIMEZONE)),
        }
    ).select(*FEED_KEYS, *_FILE_COLUMNS)
    own = [f"_{c}" for c in FEED_KEYS]
    live = fields.where(~F.col("is_deleted")).select(*[F.lower(c).alias(k) for c, k in zip(FEED_KEYS, own, strict=True)], *_FIELD_COLUMNS)
    args = ("data_type_name", "data_type_precision", "data_type_scale")
    same = [c == F.col(f"_{k}") for k, c in _feed_groups().items()]
    return (
        feeds.join(live, same, "left")
        .drop(*own)
        .withColumnRenamed("is_deleted", "is_deleted_field")
        .withColumn("data_type_size", sized_type(args[0], "data_type_length", *args[1:]))
        .withColumn("frame_data_type", frame_type(*args))
        .withColumn("current_database_name", F.lit(database))
        .withColumn("environment", F.lit(database.split("_")[0]))
    )


def _feed_groups() -> dict[str, Column]:
    """The keys of a feed without case. The code comes first: it tells more feeds apart, so sorting compares less."""
    return {k: F.lower(k) for k in reversed(FEED_KEYS)}


def source_reference(unknown_position: bool = False, member: Callable[[str], Column] = F.col) -> Column:
    """How a field is addressed in its file: by name or by position."""
    by_name = F.contains(member("file_format"), F.lit("PARQUET")) | F.contains(member("file_format"), F.lit("JSON"))
    position = F.lit("|:REPLACE_POSITION:|") if unknown_position else F.concat(F.lit("$"), member("field_ordinal"))
    return F.when(by_name, F.concat(F.lit("$1:"), member("source_field_name"))).otherwise(position)


def _field_lists(field: Column) -> dict[str, Column]:
    """What one field adds to each list of its feed, NULL where it adds nothing."""
    in_source = field["is_in_source"]
    target = F.upper(F.concat(F.lit('"'), field["target_field_name"], F.lit('"')))
    derived = F.when(F.length(field["derived_expression"]) > 0, field["derived_expression"])
    extra = ~in_source & derived.isNotNull()
    declared = F.concat(target, F.lit(" "), field["data_type_size"])
    return {
        "list_data_type_name": field["data_type_size"],
        "list_column_name_source": F.when(in_source, field["source_field_name"]),
        "list_column_position_source": F.when(in_source, field["field_ordinal"]),
        "list_column_name_target": F.when(in_source, target),
        "list_create_column_name_target": declared,
        "list_create_column_name_target_in_source": F.when(in_source, declared),
        "list_frame_field_type": F.when(in_source, field["frame_data_type"]),
        "list_frame_struct_field": F.when(in_source, F.concat(target, F.lit("#"), field["frame_data_type"])),
        "list_source_reference": F.when(in_source, source_reference(False, field.getField)),
        "list_source_reference_unknown_position": F.when(in_source, source_reference(True, field.getField)),
        "list_derived_expression": F.when(in_source, F.coalesce(derived, F.lit(""))),
        "list_extra_field_name": F.when(extra, target),
        "list_extra_derived_expression": F.when(extra, derived),
        "list_extra_create_field": F.when(extra, declared),
        "fields": F.when(field["source_field_name"].isNotNull(), F.struct(*[field[c].alias(c) for c in _FIELD_MEMBERS])),
    }


def feed_rollup(catalog: DataFrame) -> DataFrame:
    """One row per feed: its settings and its fields as arrays in field order.

    The name arrays list the fields found in the file; derived-only fields are in
    the ``extra`` arrays. ``fields`` holds the complete field structs, from which
    the staging run builds its projection.
    """
    rows = catalog.withColumns(
        {"field_ordinal": F.coalesce("field_ordinal", F.lit(1)), "is_in_target": F.coalesce("is_in_target", F.lit(True))}
    ).where((F.col("field_ordinal") >= 0) & F.col("is_in_target"))
    settings = [c for c in _FILE_COLUMNS if c != "is_enabled"] + ["current_database_name", "environment"]
    # only what was declared is collected; the lists are derived from a feed's whole array, sorted once. The group is
    # the declared field list of one feed, so its size is bounded by the width of a file
    declared = F.struct(*_FIELD_MEMBERS, "data_type_size", "frame_data_type", "file_format")
    names = list(_field_lists(declared))

    def entry(field: Column) -> Column:
        lists = [v.alias(k) for k, v in _field_lists(field).items()]
        return F.struct(field["field_ordinal"].alias("field_ordinal"), field["source_field_name"].alias("n"), *lists)

    grouped = rows.groupBy(*[c.alias(f"_{k}") for k, c in _feed_groups().items()], *FEED_KEYS).agg(
        *[F.max(c).alias(c) for c in settings],
        F.array_sort(F.transform(F.collect_list(declared), entry)).alias("_fields"),
        (F.count("is_in_source") > 0).alias("has_field_data"),
    )
    lists = [F.expr(f"filter(_fields.{k}, x -> x IS NOT NULL)").alias(k) for k in names]
    return grouped.select(*FEED_KEYS, *settings, *lists, "has_field_data")


def overall_config(catalog: DataFrame, parameters: DataFrame) -> DataFrame:
    """Field catalogue and dataset parameters side by side, either may be missing."""
    sp = parameters.select(
        *FEED_KEYS,
        "dataset_name", "container_name", "file_path", "file_name", "is_trigger_file", "is_cloud_copy",
        F.col("is_enabled").alias("parameters_is_enabled"), "last_modified", "first_time_inserted",
    ).alias("sp")
    fl = catalog.alias("fl")
    on = (F.col("fl.source_system_code") == F.col("sp.source_system_code")) & (
        F.col("fl.source_feed_code") == F.col("sp.source_feed_code")
    )
    extension = file_extension("sp.file_name")
    stage = split_part("fl.stage_name", ".", -1)
    text = ["dataset_name", "container_name", "file_path", "file_name"]
    flags = ["is_trigger_file", "is_cloud_copy", "parameters_is_enabled"]
    return fl.join(sp, on, "full").select(
        *[F.col(f"fl.{c}") for c in catalog.columns if c not in ("is_enabled", "timezone")],
        F.coalesce("fl.is_enabled", F.lit(False)).alias("source_file_is_enabled"),
        *[F.coalesce(F.col(f"sp.{c}"), F.lit("N/A")).alias(c) for c in text],
        extension.alias("file_extension"),
        F.upper(F.concat(F.lit("TASK_"), stage, F.lit("_"), extension)).alias("task_list_name"),
        *[F.coalesce(F.col(f"sp.{c}"), F.lit(False)).alias(c) for c in flags],
        "sp.last_modified",
        "sp.first_time_inserted",
    )
