"""Scans that keep file lineage: delimited, text, JSON and Parquet."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quayside.functions.text import strip_bom
from quayside.sources.formats import FileFormat

# Lineage helper columns every scan carries.
PATH, BLOCK, SEQ, CORRUPT = "_path", "_block", "_seq", "_corrupt"
# the row's place in its file, where the reader knows it (Parquet)
ROW = "_row"

_CHARSETS = "spark.sql.legacy.javaCharsets"
_PLAIN_CHARSETS = {"UTF-8", "US-ASCII", "ISO-8859-1"}


def _allow_charset(spark: SparkSession, encoding: str) -> None:
    """Line ends are looked for as single bytes, which charsets of two- and four-byte units do not have; other charsets
    of the JVM need a session setting, which build_session makes and a reader does not change."""
    if encoding.upper().startswith(("UTF-16", "UTF-32")):
        raise ValueError(f"files in {encoding} cannot be split into lines; convert them to UTF-8")
    if encoding.upper() not in _PLAIN_CHARSETS and spark.conf.get(_CHARSETS, "false") != "true":
        raise ValueError(f"reading {encoding} needs {_CHARSETS}=true in the session")


def _with_lineage(df: DataFrame, rows: bool = False) -> DataFrame:
    return df.select(
        "*",
        *([F.col("_metadata.row_index").alias(ROW)] if rows else []),
        F.col("_metadata.file_path").alias(PATH),
        F.col("_metadata.file_block_start").alias(BLOCK),
        F.monotonically_increasing_id().alias(SEQ),
    )


def read_lines(spark: SparkSession, paths: str | Sequence[str], encoding: str = "UTF-8", **options) -> DataFrame:
    """One row per line, blank lines included, in any charset the JVM knows."""
    _allow_charset(spark, encoding)
    lines = spark.read.options(**options).text(paths)
    if encoding.upper() != "UTF-8":
        # the text source keeps the raw bytes, so they can be decoded afterwards
        lines = lines.withColumn("value", F.decode(F.col("value").cast("binary"), encoding))
    return _with_lineage(lines)


def read_delimited(
    spark: SparkSession, paths: str | Sequence[str], fmt: FileFormat, width: int, **options
) -> DataFrame:
    """Positional scan ``c1 .. c<width>``, all text. Rows with another number of
    cells keep their text in ``_corrupt``."""
    _allow_charset(spark, fmt.encoding)
    schema = ", ".join([f"c{i} string" for i in range(1, width + 1)] + [f"{CORRUPT} string"])
    reader = (
        spark.read.schema(schema)
        .option("sep", fmt.delimiter)
        .option("header", fmt.has_header)
        .option("quote", fmt.quote)
        # a doubled quote inside a quoted cell; no escape character otherwise
        .option("escape", fmt.quote)
        .option("encoding", fmt.encoding)
        # a quoted cell may hold line ends; such files are not split
        .option("multiLine", fmt.multiline)
        .option("columnNameOfCorruptRecord", CORRUPT)
        # empty cells stay empty text here, the projection turns them to NULL
        .option("emptyValue", "")
        # every pass must parse whole rows, or it would find other rows malformed
        .option("columnPruning", False)
        .options(**options)
    )
    rows = reader.csv(paths)
    # the reader refuses to serve this column alone, so it is tied to a data column
    corrupt = F.when(F.col(CORRUPT).isNotNull(), F.col(CORRUPT)).when(F.length("c1") < 0, F.col("c1"))
    return _with_lineage(rows.withColumn(CORRUPT, corrupt))


def read_named(
    spark: SparkSession, paths: str | Sequence[str], fmt: FileFormat, schema: str | None = None, **options
) -> DataFrame:
    """Scan whose columns are addressed by name: JSON or Parquet. A JSON record that cannot be parsed, or not to
    the schema, keeps its text in ``_corrupt``."""
    reader = spark.read.options(**options)
    if fmt.kind == "json":
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
        reader = reader.schema(", ".join(filter(None, [schema, f"{CORRUPT} string"])))
    elif schema:
        reader = reader.schema(schema)
    df = reader.format(fmt.kind).load(paths)
    if fmt.kind == "json" and len(df.columns) > 1:
        # the reader refuses to serve this column alone, so it is tied to a data column
        other = next(c for c in df.columns if c != CORRUPT)
        df = df.withColumn(CORRUPT, F.when(F.col(CORRUPT).isNotNull(), F.col(CORRUPT)).when(F.length(f"`{other}`") < 0, F.col(f"`{other}`")))
    return _with_lineage(df, rows=fmt.kind == "parquet")


def matching(df: DataFrame, regex: str) -> DataFrame:
    """Keep rows of files whose path matches (evaluated on file metadata)."""
    return df.where(F.rlike(F.col(PATH), F.lit(regex)))


def split_stats(df: DataFrame, **measures) -> DataFrame:
    """One row per split of a scan: rows, sequence range and further aggregates."""
    return df.groupBy(PATH, BLOCK).agg(
        F.count(F.lit(1)).alias("_n"),
        F.min(SEQ).alias("_first"),
        F.max(SEQ).alias("_last"),
        *[c.alias(n) for n, c in measures.items()],
    )


def number_rows(df: DataFrame, into: str = "file_row_number", splits: DataFrame | None = None) -> DataFrame:
    """1-based row number within each file, in file order, however large a file is.
    Parquet knows its row numbers; for lines they come from the splits.

    The sequence number of a row counts the rows its task has read, so its place
    in a split is the distance to the first sequence number of that split; the
    rows of earlier splits are added. Both come from ``splits``
    (:func:`split_stats`, one row per split), computed by an earlier pass over the
    same scan. Should the two passes be cut into tasks differently, some row of a
    moved split falls outside its recorded range and the job fails.
    """
    if ROW in df.columns:
        return df.withColumn(into, F.col(ROW) + 1).drop(ROW)
    before = Window.partitionBy(PATH).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (splits if splits is not None else split_stats(df)).select(
        PATH, BLOCK, "_first", "_last", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")
    )
    numbered = df.join(offsets, [PATH, BLOCK], "left")
    moved = F.raise_error(F.lit("file splits changed between passes; set spark.sql.files.minPartitionNum"))
    place = F.col("_before") + F.col(SEQ) - F.col("_first") + 1
    inside = F.col(SEQ).between(F.col("_first"), F.col("_last"))
    return numbered.withColumn(into, F.when(inside, place).otherwise(moved.cast("bigint"))).drop(
        "_first", "_last", "_before"
    )


def header_lines(spark: SparkSession, paths: str | Sequence[str], encoding: str = "UTF-8") -> DataFrame:
    """First line of each file, byte-order mark removed: ``(path, header)``."""
    lines = read_lines(spark, paths, encoding).where(F.col(BLOCK) == 0)
    return lines.groupBy(F.col(PATH).alias("path")).agg(strip_bom(F.min_by("value", SEQ)).alias("header"))


def marked_lines(lines: DataFrame) -> DataFrame:
    """Every line as ``(path, is_header, line)``; a file's header is its first line. The place of the header comes from
    one small aggregate per file."""
    first = lines.where(F.col(BLOCK) == 0).groupBy(PATH).agg(F.min(SEQ).alias("_first"))
    is_header = (F.col(BLOCK) == 0) & (F.col(SEQ) == F.col("_first"))
    return lines.join(first, PATH, "left").select(
        F.col(PATH).alias("path"), F.coalesce(is_header, F.lit(False)).alias("is_header"), F.col("value").alias("line")
    )


def sample_rows(df: DataFrame, n: int, seed: int | None = None) -> DataFrame:
    """``n`` rows: any, or a seeded random choice."""
    return df.limit(n) if seed is None else df.orderBy(F.rand(seed)).limit(n)
