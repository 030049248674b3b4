"""Propose field metadata from the lines of delimited files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.functions.names import profiled_name
from quayside.functions.text import csv_cells, strip_bom, unquoted

# Delimiters tried, in order of preference on a tie.
DELIMITERS = [",", "|", ";", "\t"]

# Cell texts that count as missing.
MISSING = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
           "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]

_INTEGER = r"^\s*[+-]?[0-9]+\s*$"
_NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
_TRUTH = ["True", "TRUE", "true", "False", "FALSE", "false"]


def delimiter_of(header: Column) -> Column:
    """The most frequent candidate in a header line; the earlier one on a tie."""
    best, most = F.lit(DELIMITERS[0]), None
    for d in DELIMITERS:
        n = F.length(header) - F.length(F.replace(header, F.lit(d), F.lit("")))
        if most is None:
            most = n
        else:
            best, most = F.when(n > most, F.lit(d)).otherwise(best), F.greatest(most, n)
    return best


def split_cells(line: Column, delimiter: Column) -> Column:
    """Cells of a line; a delimiter inside double quotes does not split."""
    cells = None
    for d in DELIMITERS:
        here = csv_cells(line, d)
        cells = F.when(delimiter == d, here) if cells is None else cells.when(delimiter == d, here)
    return F.transform(cells, unquoted)


def profile_delimited(lines: DataFrame) -> DataFrame:
    """Field metadata of each file from all its lines ``(path, is_header, line)``.

    A column is NUMERIC(38,0) when every cell is an integer,
    NUMERIC(38,18) when every filled cell is a number (blanks turn integers into
    this type), VARCHAR(1000) for other text. Columns of another kind, such as
    truth values, are left out.
    """
    heads = lines.where("is_header").select("path", strip_bom("line").alias("header"))
    heads = heads.withColumn("delimiter", delimiter_of(F.col("header")))
    names = heads.select(
        "path", F.posexplode(split_cells(F.col("header"), F.col("delimiter"))).alias("_p", "source_field_name")
    )
    cells = (
        lines.where("NOT is_header")
        .join(heads.select("path", "delimiter"), "path")
        .select("path", F.posexplode(split_cells(F.col("line"), F.col("delimiter"))).alias("_p", "cell"))
    )
    blank = F.col("cell").isin(MISSING)
    stats = cells.groupBy("path", "_p").agg(
        F.count_if(blank).alias("blanks"),
        F.bool_and(blank | F.rlike("cell", F.lit(_INTEGER))).alias("integers"),
        F.bool_and(blank | F.rlike("cell", F.lit(_NUMBER))).alias("numbers"),
        (F.bool_and(blank | F.col("cell").isin(_TRUTH)) & (F.count_if(~blank) > 0)).alias("truths"),
    )
    kind = (
        F.when(F.col("integers") & (F.col("blanks") == 0), "integer")
        .when(F.col("numbers"), "floating")
        .when(~F.col("truths"), "string")
    )
    typed = names.join(stats, ["path", "_p"]).withColumn("kind", kind).where(F.col("kind").isNotNull())
    numeric = F.col("kind") != "string"
    return typed.select(
        "path",
        "source_field_name",
        profiled_name("source_field_name").alias("target_field_name"),
        (F.col("_p") + 1).alias("field_ordinal"),
        F.when(numeric, "NUMERIC").otherwise("VARCHAR").alias("data_type_name"),
        F.when(numeric, 0).otherwise(1000).alias("data_type_length"),
        F.when(numeric, 38).otherwise(0).alias("data_type_precision"),
        F.when(F.col("kind") == "floating", 18).otherwise(0).alias("data_type_scale"),
        F.lit("TRUE").alias("is_in_source"),
        F.lit("TRUE").alias("is_in_target"),
        F.lit("FALSE").alias("is_deleted"),
        F.lit(None).cast("string").alias("derived_expression"),
    )


def infer_types(df: DataFrame, columns: list[str]) -> DataFrame:
    """Narrowest type of each text column over the given rows, in one
    aggregation: ``(column_name, type_name, precision, scale)``."""
    ladder = [("BOOLEAN", "boolean"), ("NUMERIC", "decimal(38,0)"), ("DOUBLE", "double"),
              ("DATE", "date"), ("TIMESTAMP", "timestamp")]

    def fits(c: str, spark_type: str) -> Column:
        cell = F.when(F.col(c) != "", F.col(c))
        ok = cell.isNull() | cell.try_cast(spark_type).isNotNull()
        if spark_type == "decimal(38,0)":
            ok = cell.isNull() | F.rlike(cell, F.lit(_INTEGER))
        elif spark_type == "boolean":
            ok = cell.isNull() | F.lower(cell).isin("true", "false")
        elif spark_type == "date":
            ok = cell.isNull() | F.rlike(cell, F.lit(r"^\d{4}-\d{2}-\d{2}$")) & cell.try_cast("date").isNotNull()
        elif spark_type == "double":
            ok = cell.isNull() | F.rlike(cell, F.lit(_NUMBER))
        return F.bool_and(ok)

    aggs = [F.array(*[fits(c, t) for _, t in ladder]).alias(f"_{i}") for i, c in enumerate(columns)]
    aggs += [F.count_if(F.col(c) != "").alias(f"_n{i}") for i, c in enumerate(columns)]
    flags = df.agg(*aggs)

    def pick(i: int) -> Column:
        name = F.lit("STRING")
        for pos, (label, _) in reversed(list(enumerate(ladder))):
            name = F.when(F.get(F.col(f"_{i}"), F.lit(pos)), label).otherwise(name)
        return F.when(F.col(f"_n{i}") > 0, name).otherwise("STRING")

    rows = F.array(
        *[F.struct(F.lit(i + 1).alias("position"), F.lit(c).alias("column_name"), pick(i).alias("type_name"))
          for i, c in enumerate(columns)]
    )
    return flags.select(F.inline(rows))
