"""Match declared fields to the header cells of delimited files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.functions.names import header_name
from quayside.functions.text import csv_cells, strip_bom


def header_cells(headers: DataFrame, delimiter: str = ",") -> DataFrame:
    """``(path, position, cell)`` from ``(path, header)``, position from 1. A delimiter
    inside double quotes belongs to the cell, as it does in the rows."""
    cells = csv_cells(strip_bom("header"), delimiter)
    return headers.select("path", F.posexplode(cells).alias("_p", "cell")).select(
        "path",
        (F.col("_p") + 1).alias("position"),
        F.trim(F.replace(F.trim("cell"), F.lit('"'), F.lit(""))).alias("cell"),
    )


def header_map(headers: DataFrame, fields: DataFrame, delimiter: str = ",") -> DataFrame:
    """``(path, source_field_name, position)`` of the fields that match exactly
    one header cell, ignoring case, quotes and surrounding blanks."""
    cells = header_cells(headers, delimiter).withColumn("_k", F.upper("cell"))
    wanted = fields.select("source_field_name", F.upper(F.trim("source_field_name")).alias("_k"))
    return (
        cells.join(wanted, "_k")
        .groupBy("path", "source_field_name")
        .agg(F.count(F.lit(1)).alias("_n"), F.min("position").alias("position"))
        .where("_n = 1")
        .select("path", "source_field_name", "position")
    )


def header_columns(headers: DataFrame, delimiter: str = ",") -> DataFrame:
    """Without declared fields every header cell becomes a text column."""
    cells = header_cells(headers, delimiter)
    return cells.select("path", "position", F.col("cell").alias("source_field_name"),
                        header_name("cell").alias("target_field_name"))
