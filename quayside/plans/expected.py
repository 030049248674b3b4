"""Expected datasets per COB, file matching and upload plan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.functions.dates import STATIC_COB
from quayside.functions.paths import (
    ancestors,
    cob_from_path,
    container_name,
    depth,
    expand_source_path,
    expand_template,
    file_extension,
    file_name_for_cob,
    folder_parts,
    folder_pattern,
    join_path,
    literal_anchor,
    slash_wrapped,
    template_pattern,
    tidy_path,
)
from quayside.functions.text import glob_head, glob_like, head_layout, key_of_layout
from quayside.plans.catalog import FEED_KEYS

_SCOPE = ["entity_code", "department_code", "region", "market"]


def latest_cobs(calendar: DataFrame, as_of: Column, days: int) -> DataFrame:
    """The ``days`` latest calendar COBs up to a date."""
    return (
        calendar.where(F.col("my_date") <= as_of.cast("date")).select("cob_id").orderBy(F.desc("cob_id")).limit(days)
    )


def dataset_catalog(parameters: DataFrame, rollup: DataFrame) -> DataFrame:
    """Enabled datasets joined with their feed, before any COB is applied."""
    feeds = rollup.select(
        *FEED_KEYS,
        "stage_name",
        F.col("source_file_name_pattern").alias("_pattern"),
        F.struct(*[c for c in rollup.columns if c not in FEED_KEYS]).alias("feed"),
    )
    p = parameters.where("is_enabled")
    return p.join(feeds, FEED_KEYS).select(
        "dataset_name",
        "stage_name",
        *FEED_KEYS,
        "container_name",
        "file_path",
        "file_name",
        F.regexp_replace("file_name", F.concat(F.lit("\\Q."), file_extension("file_name"), F.lit("\\E")), F.lit(""))
        .alias("file_name_no_extension"),
        file_extension("file_name").alias("file_extension"),
        F.when(F.col("_pattern") != "", F.col("_pattern")).otherwise(F.col("file_name"))
        .alias("source_file_name_pattern"),
        "is_enabled",
        "is_trigger_file",
        "allow_reload",
        "is_cloud_copy",
        "allow_infer_schema",
        "expected_stage_time",
        "warehouse_size",
        "tags",
        F.struct(*_SCOPE).alias("scope"),
        "feed",
    )


def at_cob(datasets: DataFrame, cob: str = "cob_id") -> DataFrame:
    """Add the folder, pattern and file name of each dataset for its COB."""
    return (
        datasets.withColumn("folder_pattern_cob", template_pattern("file_path", cob))
        .withColumn("folder_path_cob", expand_template("file_path", cob))
        .withColumn("file_name_cob", file_name_for_cob("file_name", cob))
        .withColumn("folder_pattern", folder_pattern("file_path", "folder_pattern_cob", "folder_path_cob"))
    )


def with_cobs(catalog: DataFrame, calendar: DataFrame, as_of: Column, days: int) -> DataFrame:
    """Each dataset once per latest COB and once for the static COB. The COB list
    (at most ``days`` + 1 numbers) is a scalar subquery, so there is no join."""
    cobs = latest_cobs(calendar, as_of, days).agg(F.array_agg("cob_id").alias("c")).scalar()
    listed = F.array_append(F.coalesce(cobs, F.array().cast("array<int>")), F.lit(STATIC_COB))
    return catalog.withColumn("cob_id", F.explode(listed))


def expected_datasets(
    parameters: DataFrame, rollup: DataFrame, calendar: DataFrame, as_of: Column, days: int
) -> DataFrame:
    """Every enabled dataset with its expected folder and file for each COB."""
    return at_cob(with_cobs(dataset_catalog(parameters, rollup), calendar, as_of, days))


def enrich_manifest(manifest: DataFrame) -> DataFrame:
    """Add COB, bare container and tidy folder to ``(folder_path, file_name,
    container)`` rows; column expressions only, one pass over any number of files."""
    return manifest.withColumns(
        {
            "cob_id": cob_from_path(join_path("folder_path", "file_name")),
            "container_name": container_name("container"),
            "source_folder": tidy_path("folder_path"),
        }
    )


def name_candidates(files: DataFrame, expected: DataFrame) -> DataFrame:
    """Pairs of enriched files and datasets that agree in COB, container, folder and the head of the file name.

    A folder that starts with the dataset's folder has it among its ancestors, so the prefix test becomes an equality
    with the leading wildcard-free part of the dataset's folder. The head of a name pattern, up to its first ``*``, has a
    fixed length and literal letters at fixed places. Its layout says which places these are; a file gets one key for each
    layout of its folder (never more than the folder has datasets), so many datasets of one folder are told apart by a hash
    and not by LIKE. The columns ``_folder``, ``_below`` and ``_name`` are for the tests that remain.
    """
    keyed = (
        files.withColumn("_folder", F.upper(slash_wrapped("source_folder")))
        .withColumn("_parts", folder_parts("_folder"))
        .withColumn("_anchor", F.explode(ancestors("_parts")))
        .withColumn("_container", F.coalesce("container_name", F.lit("")))
    )
    below = F.upper("folder_path_cob")
    datasets = expected.select(
        F.col("cob_id").cast("bigint").alias("_cob"),
        F.coalesce("container_name", F.lit("")).alias("_c"),
        literal_anchor(below).alias("_a"),
        # only a folder with a wildcard needs LIKE, the others are proven by the key
        F.when(F.rlike(below, F.lit("[%_]")), F.concat(below, F.lit("%"))).alias("_below"),
        F.col("file_name_cob").alias("_name"),
        glob_head("file_name_cob").alias("_head"),
        *[F.col(c) for c in expected.columns if c not in files.columns],
    ).withColumn("_l", head_layout("_head"))
    # only ancestors of a depth that some dataset's folder has are shuffled, so the root is not a hot key
    keyed = keyed.where(F.array_contains(datasets.agg(F.collect_set(depth("_a"))).scalar(), depth("_anchor")))
    layouts = datasets.groupBy("_cob", "_c", "_a").agg(F.collect_set("_l").alias("_layouts"))
    in_folder = (F.col("cob_id") == F.col("_cob")) & (F.col("_container") == F.col("_c")) & (F.col("_anchor") == F.col("_a"))
    keyed = (
        keyed.join(layouts, in_folder)
        .drop("_cob", "_c", "_a")
        .withColumn("_layout", F.explode("_layouts"))
        .withColumn("_key", key_of_layout("file_name", "_layout"))
    )
    same_head = (F.col("_layout") == F.col("_l")) & (F.col("_key") == F.col("_head"))
    helpers = ["_parts", "_anchor", "_container", "_layouts", "_layout", "_key", "_cob", "_c", "_a", "_l", "_head"]
    return keyed.join(datasets, in_folder & same_head).drop(*helpers)


def match_datasets(files: DataFrame, expected: DataFrame) -> DataFrame:
    """Match enriched files with expected datasets: same COB and container, file name LIKE the dataset's (``*`` as
    wildcard), folder below the dataset's folder. The join is hashed (see :func:`name_candidates`); LIKE remains as a
    residual. A file may match several datasets."""
    fits = (F.col("_below").isNull() | F.like("_folder", F.col("_below"))) & glob_like("file_name", "_name")
    return name_candidates(files, expected).where(fits).drop("_folder", "_below", "_name")


def _upload_files(files: DataFrame, expected: DataFrame, cob: int, environment: str) -> DataFrame:
    """``(source_file_path, destination_file_path, file_name)`` of one COB. Feeds without a source path drop out."""
    sources = files.where("is_enabled").select(
        *FEED_KEYS, expand_source_path("source_file_path", F.lit(cob), environment).alias("source_file_path")
    )
    wanted = expected.where(F.col("cob_id") == cob).select(
        *FEED_KEYS, F.col("file_name_cob").alias("file_name"), F.col("folder_path_cob").alias("destination_file_path")
    )
    return sources.where("source_file_path <> ''").join(wanted, FEED_KEYS).select(*_ROUTE, "file_name")


_ROUTE = ["source_file_path", "destination_file_path"]


def upload_plan(files: DataFrame, expected: DataFrame, cob: int, environment: str) -> DataFrame:
    """Files to upload per source and destination folder for one COB, as JSON.
    Feeds without a source path drop out. The file array of a row lists one
    folder of one COB; :func:`upload_chunks` cuts it for very large folders."""
    plan = (
        _upload_files(files, expected, cob, environment)
        .groupBy(*_ROUTE)
        .agg(F.array_sort(F.collect_list("file_name")).alias("file_list"))
    )
    return plan.select(*_ROUTE, F.size("file_list").alias("n_files"), F.to_json(F.struct(*_ROUTE, "file_list")).alias("file_detail"))


#: Files of one folder that one task numbers, on average.
NUMBERED_TOGETHER = 100_000


def upload_chunks(
    files: DataFrame, expected: DataFrame, cob: int, environment: str, limit: int, together: int = NUMBERED_TOGETHER
) -> DataFrame:
    """The upload plan in JSON chunks of at most ``limit`` files; the chunks of a folder hold the files of its row in
    :func:`upload_plan`. Files are numbered in the order of the MD5 of their names: these are spread evenly, so a folder
    is cut into as many slices as its size needs, a slice is numbered by itself and goes on where those before it end.
    A name that occurs several times is one row with a count until it is numbered."""
    names = _upload_files(files, expected, cob, environment).groupBy(*_ROUTE, "file_name").agg(F.count(F.lit(1)).alias("_n"))
    names = names.withColumn("_md5", F.md5("file_name"))
    sizes = names.groupBy(*_ROUTE).agg(F.sum("_n").alias("_all"), F.count(F.lit(1)).alias("_names"))
    # the first 32 bits of the MD5, times the number of slices
    place = F.conv(F.substring("_md5", 1, 8), 16, 10).cast("bigint")
    sliced = names.join(sizes, _ROUTE).withColumn("_slice", F.shiftrightunsigned(place * F.ceil(F.col("_names") / together), 32))
    slices = sliced.groupBy(*_ROUTE, "_slice").agg(F.sum("_n").alias("_in_slice"))
    over = Window.partitionBy(*_ROUTE).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = slices.select(*_ROUTE, "_slice", F.coalesce(F.sum("_in_slice").over(over), F.lit(0)).alias("_start"))
    inside = Window.partitionBy(*_ROUTE, "_slice").orderBy("_md5", "file_name").rowsBetween(Window.unboundedPreceding, -1)
    numbered = (
        sliced.withColumn("_before", F.coalesce(F.sum("_n").over(inside), F.lit(0)))
        .join(starts, [*_ROUTE, "_slice"])
        .withColumn("_copy", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_n") - 1)))
        .withColumn("chunk", F.floor((F.col("_start") + F.col("_before") + F.col("_copy")) / limit) + 1)
    )
    chunks = numbered.groupBy(*_ROUTE, "chunk", F.ceil(F.col("_all") / limit).alias("n_chunks")).agg(
        F.array_sort(F.collect_list("file_name")).alias("file_list")
    )
    return chunks.select(
        *_ROUTE,
        "chunk",
        "n_chunks",
        F.size("file_list").alias("n_files"),
        F.to_json(F.struct(*_ROUTE, "chunk", "n_chunks", "file_list")).alias("file_detail"),
    )


def upload_request(plan: DataFrame, cob: int, environment: str) -> DataFrame:
    """Rows of an upload plan with the COB and environment they were made for."""
    return plan.select("file_detail", F.lit(cob).alias("cob_id"), F.lit(environment).alias("environment"))
