"""Staging run: match files to datasets, read, cast, check, load and log.

Rows never reach the driver. It holds configuration (the declared fields of the
datasets being staged) and the file paths a scan is given, and starts one scan
per dataset, not per file.
"""

from __future__ import annotations

import re
import uuid
from collections import defaultdict
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from functools import reduce
from threading import Lock

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from quayside.functions.names import header_name, inferred_name
from quayside.functions.paths import cob_from_path
from quayside.functions.text import trigger_map
from quayside.operators.errors import parsed_once, skipped_files
from quayside.operators.headers import header_cells
from quayside.operators.merge import conform
from quayside.operators.profile import infer_types
from quayside.operators.project import BAD, Field, Formats, loadable, typed_projection
from quayside.plans.expected import enrich_manifest, match_datasets
from quayside.plans.log import append_log, current_log, http_date, load_id, result_of
from quayside.session import scratch_path
from quayside.sources.formats import FileFormat, get_format
from quayside.sources.scan import (
    BLOCK,
    CORRUPT,
    PATH,
    ROW,
    SEQ,
    header_lines,
    matching,
    number_rows,
    read_delimited,
    read_lines,
    read_named,
    split_stats,
)
from quayside.sources.sinks import (
    clear_partitions,
    not_yet_loaded,
    read_table,
    reload_by_dataset,
    reload_by_file,
    remove_path,
)

# Text of the failures a retry cannot mend.
NO_METADATA = "There is no metadata for the folder/file: "
COMPILATION = "SQL compilation error:"
NO_TABLE = "Object '{}' does not exist or not authorized."

# The environment in which tables may be created or widened.
DEVELOPMENT = "DVLP"
NOT_PERMITTED = "Staging table creation requested, but creation is only permitted in the DVLP environment."

LINEAGE = ["cob_id", "scope", "file_name", "file_row_number", "staged_at", "dataset_name"]


@dataclass(frozen=True)
class StageOptions:
    """Switches of a staging run.

    ``allow_create`` asks for missing tables and columns to be created, which is
    done for databases of the development environment only. ``header_mapping`` reads field positions from the
    file header where there is one. ``side_by_side`` datasets are loaded at once. ``by_file`` replaces
    earlier rows file by file, whatever the feed asks for.
    """

    stage_root: str
    target_root: str
    log_path: str
    header_mapping: bool = True
    allow_create: bool = False
    event_trigger: str | None = None
    database_target: str = ""
    side_by_side: int = 4
    by_file: bool = False


def manifest_of(listing: DataFrame, stage_root: str, container: str = "") -> DataFrame:
    """Listed files as staging arguments: folder and name below the stage root."""
    inner = F.regexp_extract("name", f"\\Q{_bare(stage_root)}\\E/(.*)$", 1)
    return listing.where(inner != "").select(
        F.col("name").alias("path"),
        F.regexp_extract(inner, "^(.*/)?[^/]*$", 1).alias("folder_path"),
        F.regexp_extract(inner, "([^/]*)$", 1).alias("file_name"),
        F.lit(container).alias("container"),
        "size",
        "last_modified",
    )


def _bare(uri: str) -> str:
    """Path of a location without scheme and authority."""
    rest = uri.split("://", 1)
    path = "/" + rest[1].split("/", 1)[1] if len(rest) == 2 else uri.removeprefix("file:")
    return path.rstrip("/")


def table_path(options: StageOptions, table: str) -> str:
    return f"{options.target_root.rstrip('/')}/{table}"


# ------------------------------------------------------------------ reading


def _delimited(spark, paths, fmt: FileFormat, fields: list[Field], formats: Formats, options, known) -> DataFrame:
    """Typed rows of delimited files, by header where one is used."""
    keep = [PATH, BLOCK, SEQ]
    if not (options.header_mapping and fmt.has_header):
        width = max((f.ordinal for f in fields if f.in_source), default=1)
        return typed_projection(read_delimited(spark, paths, fmt, width), fields, formats, keep=keep)
    heads = header_lines(spark, paths, fmt.encoding)
    # files with the same header are read by the same scan
    layouts = heads.groupBy("header").agg(F.collect_list("path").alias("paths")).collect()
    parts = [_by_header(spark, r["paths"], r["header"], fmt, fields, formats, options, known) for r in layouts]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def _by_header(spark, paths, header, fmt, fields, formats, options, known) -> DataFrame:
    one = spark.createDataFrame([("", header)], "path string, header string")
    cells = (
        header_cells(one, fmt.delimiter)
        .withColumn("target", inferred_name("cell") if fields else header_name("cell"))
        .orderBy("position")
        .collect()
    )
    raw = read_delimited(spark, paths, fmt, len(cells))
    upper = [c["cell"].upper() for c in cells]
    positions = {}
    for f in fields:
        name = f.source_name.strip().upper()
        if f.in_source and upper.count(name) == 1:
            positions[f.source_name] = f"c{upper.index(name) + 1}"
    declared = {f.source_name.strip().upper() for f in fields}
    loose = [c for c in cells if upper.count(c["cell"].upper()) == 1 and c["cell"].upper() not in declared]
    if known is not None and not options.allow_create:
        loose = [c for c in loose if c["target"].lower() in known]
    types = {}
    if loose and fields:
        columns = [f"c{c['position']}" for c in loose]
        types = {r["column_name"]: r["type_name"] for r in infer_types(raw, columns).collect()}
    extra = [
        Field(c["cell"], c["target"], 10_000 + c["position"], types.get(f"c{c['position']}", "STRING"), precision=38)
        for c in loose
    ]
    for f in extra:
        positions[f.source_name] = f"c{f.ordinal - 10_000}"
    return typed_projection(raw, [*fields, *extra], _iso_for(formats, extra), positions, keep=[PATH, BLOCK, SEQ])


def _undeclared(raw: DataFrame, fields: list[Field], known: set[str] | None, options: StageOptions) -> list[Field]:
    """Columns of a JSON or Parquet scan that no field declares: text is typed by all its rows, other types stay."""
    declared = {f.source_name.strip().upper() for f in fields}
    loose = [c for c in raw.columns if c not in (PATH, BLOCK, SEQ, ROW, CORRUPT) and c.strip().upper() not in declared]
    targets = raw.sparkSession.range(1).select(*[inferred_name(F.lit(c)).alias(f"n{i}") for i, c in enumerate(loose)]).first()
    named = list(zip(loose, targets, strict=True))
    if known is not None and not options.allow_create:
        named = [(c, n) for c, n in named if n.lower() in known]
    kinds = dict(raw.dtypes)
    text = [c for c, _ in named if kinds[c] == "string"]
    types = {r["column_name"]: r["type_name"] for r in infer_types(raw, text).collect()} if text else {}
    out = []
    for i, (c, name) in enumerate(named):
        if c in types:
            out.append(Field(c, name, 20_000 + i, types[c], precision=38))
        else:
            out.append(Field(c, name, 20_000 + i, "STRING", in_source=False, derived=f"`{c}`"))
    return out


def _iso_for(formats: Formats, extra: list[Field]) -> Formats:
    # inferred dates were recognised in ISO form only
    return replace(formats, date="YYYY-MM-DD") if any(f.type_name == "DATE" for f in extra) else formats


def read_feed(spark, paths: Sequence[str], feed: Row, options: StageOptions, known: set[str] | None) -> DataFrame:
    """Typed rows of one feed's files with ``_bad`` and file lineage helpers."""
    fmt = get_format(feed["file_format"])
    fields = loadable(Field.from_row(r) for r in feed["fields"] or [])
    formats = Formats(
        feed["date_input_format"] or Formats.date,
        feed["timestamp_input_format"] or Formats.timestamp,
        feed["timezone"] or Formats.timezone,
    )
    keep = [PATH, BLOCK, SEQ]
    if fmt.kind == "parquet":
        keep.append(ROW)
    if fmt.kind == "csv":
        df = _delimited(spark, paths, fmt, fields, formats, options, known)
    elif fmt.kind == "text":
        lines = read_lines(spark, paths, fmt.encoding).withColumnRenamed("value", "c1")
        if fmt.has_header:
            lines = number_rows(lines, "_n").where("_n > 1").drop("_n")
        df = typed_projection(lines, fields, formats, keep=keep)
    else:
        names = {f.source_name: f.source_name for f in fields if f.in_source}
        loose, schema = options.header_mapping, None
        if fmt.kind == "json":
            # every record is looked at for further columns
            seen = spark.read.option("columnNameOfCorruptRecord", CORRUPT).json(list(paths)).columns if loose else []
            declared = {n.strip().upper() for n in names}
            columns = [*names, *(c for c in seen if c != CORRUPT and c.strip().upper() not in declared)]
            schema = ", ".join(f"`{c}` string" for c in columns)
        raw = read_named(spark, paths, fmt, schema)
        if fmt.kind == "parquet" and loose:
            # fields that the files lack are left out, as they are by header
            present = {c.strip().upper(): c for c in raw.columns}
            names = {n: present[n.strip().upper()] for n in names if n.strip().upper() in present}
        extra = _undeclared(raw, fields, known, options) if loose else []
        names |= {f.source_name: f.source_name for f in extra if f.in_source}
        df = typed_projection(raw, [*fields, *extra], _iso_for(formats, extra), names, keep=keep)
    return df


# ------------------------------------------------------------------ staging


def _below_root(options: StageOptions) -> Column:
    return F.regexp_extract(PATH, f"\\Q{_bare(options.stage_root)}\\E/(.*)$", 1)


def _with_lineage(df: DataFrame, dataset: Row, options: StageOptions, as_of: Column) -> DataFrame:
    scope = F.struct(*[F.lit(v).cast("string").alias(n) for n, v in dataset["scope"].asDict().items()])
    inner = _below_root(options)
    return df.withColumns(
        {
            "cob_id": cob_from_path(inner).try_cast("int"),
            "scope": scope,
            "file_name": inner,
            "staged_at": as_of,
            "dataset_name": F.lit(dataset["dataset_name"]),
        }
    ).drop(PATH)


def _shape_to_table(df: DataFrame, path: str, table: str, options: StageOptions) -> tuple[DataFrame, str]:
    """Fit the rows to the target's columns, creating or widening it if allowed."""
    spark = df.sparkSession
    helpers = [PATH, BLOCK, SEQ, ROW, BAD]
    fresh = [c for c in df.columns if c not in helpers]
    stored = read_table(spark, path)
    if stored is None:
        if not options.allow_create:
            raise ValueError(NO_TABLE.format(table))
        if not fresh:
            raise ValueError(f"No columns to create staging table {table}")
        return df, "Table created"
    have = {k.lower(): v for k, v in stored.dtypes}
    new = [c for c in fresh if c.lower() not in have]
    shape = {c: have.get(c.lower(), k) for c, k in df.dtypes if c in fresh and (options.allow_create or c not in new)}
    fitted = conform(df, {**shape, **{c: k for c, k in df.dtypes if c in helpers}})
    if new and options.allow_create:
        return fitted, "Alter table executed"
    if options.allow_create:
        return fitted, "Table already exists"
    return fitted, "Staging table creation not requested."


def _stage_dataset(spark, dataset: Row, paths: list[str], cobs: list[int], options, as_of, scratch: str):
    """Load one dataset; returns ``(per-file results, target table, columns, message)``. The results lie in ``scratch``."""
    feed = dataset["feed"]
    table = feed["destination_full_table_name"]
    path = table_path(options, table)
    stored = read_table(spark, path)
    known = None if stored is None else {c.lower() for c in stored.columns}
    rows = read_feed(spark, paths, feed, options, known)
    shaped, message = _shape_to_table(rows, path, table, options)

    # the files are parsed once; counts and load read what was parsed
    shaped = parsed_once(shaped, f"{scratch}/rows")
    # row and error counts, one row per split of the files
    stats_path = f"{scratch}/stats"
    split_stats(shaped, rows_bad=F.count_if(F.col(BAD))).write.parquet(stats_path)
    splits = spark.read.parquet(stats_path)
    errors = splits.groupBy(PATH).agg(F.sum("_n").alias("rows_parsed"), F.sum("rows_bad").alias("rows_bad"))
    limit = int(feed["skip_row_on_error"] or 0)
    if limit <= 0:
        worst = errors.where("rows_bad > 0").orderBy(PATH).first()
        if worst:
            raise ValueError(f"{worst['rows_bad']} bad rows in file {worst[PATH]}")
    errors = errors.withColumn("skipped", skipped_files(errors, F.lit(limit))).withColumn(
        "file_name", _below_root(options)
    )

    # the good rows of the files that stay
    good = number_rows(shaped, splits=splits).where(~F.col(BAD)).drop(BAD, BLOCK, SEQ)
    good = good.join(errors.where("skipped").select(PATH), PATH, "left_anti")
    good = _with_lineage(good, dataset, options, as_of)
    if options.by_file or feed["delete_stage_by_file_name"]:
        reload_by_file(good, path)
    else:
        reload_by_dataset(good, path)
        # files that loaded nothing still replace the earlier load of their COB
        loaded = errors.where(~F.col("skipped") & (F.col("rows_parsed") > F.col("rows_bad")))
        filled = {r[0] for r in loaded.select(cob_from_path("file_name").try_cast("int")).distinct().collect()}
        clear_partitions(spark, path, [(c, dataset["dataset_name"]) for c in cobs if c not in filled])
    loaded = F.when(F.col("skipped"), 0).otherwise(F.col("rows_parsed") - F.col("rows_bad"))
    results = errors.select(
        F.col("file_name").alias("_file"),
        F.array(
            F.struct(
                F.col("file_name").alias("file"),
                F.when(F.col("skipped"), "LOAD_SKIPPED").otherwise("LOADED").alias("status"),
                "rows_parsed",
                loaded.alias("rows_loaded"),
                F.col("rows_bad").alias("errors_seen"),
            )
        ).alias("_results"),
    )
    columns = ",".join(c for c in good.columns if c not in LINEAGE)
    return results, table, columns, message


def stage_files(
    spark: SparkSession, manifest: DataFrame, expected: DataFrame, options: StageOptions, as_of: Column
) -> DataFrame:
    """Stage the files of ``manifest`` (see :func:`manifest_of`) and return the
    state of their loads. A file may load into several datasets; files of one run
    and dataset are one load. A failing dataset is logged and does not stop the
    others; files without a dataset are logged as FAILED.
    """
    work = scratch_path(spark, options.target_root, "stage")
    log_lock, table_locks = Lock(), defaultdict(Lock)
    # one start time for the whole run, also when the caller passes the clock
    as_of = F.lit(spark.range(1).select(as_of.cast("timestamp")).first()[0])
    files = enrich_manifest(manifest)
    matched = match_datasets(files, expected)
    inner = F.concat(F.col("source_folder"), F.when(F.col("source_folder") != "", "/").otherwise(""), "file_name")
    ids = load_id(as_of, "cob_id", "file_name", "source_folder", "dataset_name")
    base = {
        "process_parameters": F.struct(
            "container_name",
            trigger_map(F.lit(options.event_trigger).cast("string")).alias("event_trigger"),
            inner.alias("file_stage_me"),
            "file_name",
            F.col("source_folder").alias("folder_path"),
            F.lit(options.database_target).alias("database_target"),
            F.lit(options.allow_create).alias("flag_create_table"),
            F.lit(options.header_mapping).alias("flag_create_csv_mapping"),
        ),
        "blob_file": F.struct(
            F.array(
                F.struct(
                    F.col("path").alias("name"), "size", F.lit(None).cast("string").alias("md5"),
                    http_date("last_modified").alias("last_modified"),
                )
            ).alias("file_list"),
            F.lit(1).alias("file_count"),
        ),
        "start_timestamp": as_of,
    }

    # matching is done once: later steps read the written table
    matched.withColumns({**base, "id": ids, "_file": inner}).write.parquet(f"{work}/matched")
    every = spark.read.parquet(f"{work}/matched")
    done = current_log(spark, options.log_path).select(
        "dataset_name", F.col("process_parameters.file_stage_me").alias("_file"), "process_status"
    )
    due = every.where("allow_reload").unionByName(
        not_yet_loaded(every.where("NOT allow_reload"), done, ["dataset_name", "_file"])
    )
    due.write.parquet(f"{work}/due")
    todo = spark.read.schema(due.schema).parquet(f"{work}/due")

    def log(df: DataFrame, status: str, result: Column, ended: bool = True) -> None:
        out = df.withColumns(
            {
                "process_result": result,
                "process_status": F.lit(status),
                "end_timestamp": F.current_timestamp() if ended else F.lit(None).cast("timestamp"),
                "logged_at": F.current_timestamp(),
            }
        )
        columns = ["id", "cob_id", "dataset_name", "process_parameters", "process_result", "process_status",
                   "start_timestamp", "end_timestamp", "blob_file", "logged_at"]
        # one writer at a time: appends share the folder's commit directory
        with log_lock:
            append_log(out.select(*columns), options.log_path)

    orphans = files.join(every.select("path").distinct(), "path", "left_anti")
    orphans = orphans.withColumns({**base, "dataset_name": F.lit(None).cast("string"), "_file": inner})
    orphans.withColumn("id", ids).write.parquet(f"{work}/orphans")
    orphans = spark.read.schema(due.select(*orphans.columns, "id").schema).parquet(f"{work}/orphans")
    log(
        orphans,
        "FAILED",
        result_of(exception=F.concat(F.lit(NO_METADATA), "_file"), is_error=F.lit(True)),
    )
    log(todo, "RUNNING", result_of(), ended=False)

    def stage_one(dataset: Row) -> None:
        scratch = f"{work}/dataset-{uuid.uuid4().hex}"
        try:
            load_one(dataset, scratch)
        finally:
            remove_path(spark, scratch)

    def load_one(dataset: Row, scratch: str) -> None:
        mine = todo.where(F.col("dataset_name") == dataset["dataset_name"])
        given = mine.select("path", "cob_id").distinct().collect()
        paths, cobs = sorted({r[0] for r in given}), sorted({r[1] for r in given})
        if dataset["is_trigger_file"]:
            paths = _folder_files(spark, paths, dataset["source_file_name_pattern"])
        database = options.database_target or dataset["feed"]["current_database_name"]
        creating = options.allow_create and database.split("_")[0].upper() == DEVELOPMENT
        mapping = options.header_mapping and bool(dataset["allow_infer_schema"])
        run = replace(options, allow_create=creating, header_mapping=mapping)
        try:
            # one writer at a time for a table: a reload by file rewrites partitions that other datasets may share
            with table_locks[dataset["feed"]["destination_full_table_name"]]:
                results, table, columns, message = _stage_dataset(spark, dataset, paths, cobs, run, as_of, scratch)
        except Exception as e:  # noqa: BLE001 - any failure of a dataset is logged
            failure = result_of(exception=F.lit(_told(e)), is_error=F.lit(True))
            return log(mine, "FAILED", failure)
        if options.allow_create and not creating:
            message = NOT_PERMITTED
        copied = _all_results(results) if dataset["is_trigger_file"] else F.col("_results")
        success = result_of(
            msg_copy_result=copied,
            target_table=F.lit(table),
            target_columns=F.lit(columns),
            create_table_result=F.lit(message),
            is_error=F.lit(False),
        )
        log(mine.join(results, "_file", "left"), "SUCCESS", success)

    config = ["dataset_name", "feed", "scope", "is_trigger_file", "source_file_name_pattern", "allow_infer_schema"]
    datasets = todo.select(*config).dropDuplicates(["dataset_name"]).collect()
    # a table that does not exist yet is created by its first dataset alone
    with ThreadPoolExecutor(options.side_by_side) as pool:
        first, rest = _first_per_table(datasets)
        for batch in (first, rest):
            list(pool.map(inheritable_thread_target(spark)(stage_one), batch))
    run_ids = orphans.select("id").unionByName(todo.select("id"))
    return current_log(spark, options.log_path).join(run_ids, "id", "left_semi")


def _told(e: Exception) -> str:
    """The whole text of a failure. An analysis error, which no retry mends, is named as such."""
    return f"{COMPILATION} {e}" if isinstance(e, AnalysisException) else str(e)


def _first_per_table(datasets: list[Row]) -> tuple[list[Row], list[Row]]:
    first: dict[str, Row] = {}
    for d in datasets:
        first.setdefault(d["feed"]["destination_full_table_name"], d)
    return list(first.values()), [d for d in datasets if d not in first.values()]


def _all_results(results: DataFrame) -> Column:
    """Results of every file of a trigger-file load: totals in one entry."""
    total = results.select(F.explode("_results").alias("r")).select("r.*")
    return total.agg(
        F.array(
            F.struct(
                F.lit(None).cast("string").alias("file"),
                F.lit("LOADED").alias("status"),
                F.sum("rows_parsed").alias("rows_parsed"),
                F.sum("rows_loaded").alias("rows_loaded"),
                F.sum("errors_seen").alias("errors_seen"),
            )
        )
    ).scalar()


def _folder_files(spark: SparkSession, triggers: list[str], pattern: str) -> list[str]:
    """Files a trigger file stands for: those beside it that match the pattern."""
    folders = sorted({t.rsplit("/", 1)[0] for t in triggers})
    listing = spark.read.format("binaryFile").load(folders).select(F.col("path").alias(PATH))
    # the whole file name must match; everything but * stands for itself
    name = "[^/]*".join(re.escape(part) for part in pattern.split("*"))
    return [r[0] for r in matching(listing, f"(^|/){name}$").collect()]
