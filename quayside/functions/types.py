"""Configured field types: text rendering and the Spark type used to cast."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quayside.functions.text import lit_or_col

# Type names that never carry a size.
UNSIZED = ["DOUBLE", "FLOAT", "BOOLEAN", "DATE", "DATETIME", "STRING", "TIME", "TIMESTAMP"]

# Type name -> DataFrame type label; NUMERIC depends on its precision.
FRAME_TYPES = {
    "DATE": "DateType()",
    "TIME": "TimeType()",
    "DATETIME": "TimestampType()",
    "TIMESTAMP": "TimestampType()",
    "STRING": "StringType()",
    "VARCHAR": "StringType()",
    "BOOLEAN": "BooleanType()",
}

_SPARK = {
    "DATE": "date",
    "DATETIME": "timestamp",
    "TIMESTAMP": "timestamp",
    "BOOLEAN": "boolean",
    "DOUBLE": "double",
    "FLOAT": "double",
    "INT": "bigint",
    "INTEGER": "bigint",
    "BIGINT": "bigint",
}


def sized_type(name, length, precision, scale) -> Column:
    """``VARCHAR(20)``, ``NUMERIC(38)``, ``NUMERIC(18,2)``, ``DATE`` ..."""
    name, length, precision, scale = map(lit_or_col, (name, length, precision, scale))

    def wrap(*parts):
        return F.concat(F.lit("("), *parts, F.lit(")"))

    size = (
        F.when(name.isin(UNSIZED), "")
        .when(length > 0, wrap(length.cast("string")))
        .when((precision > 0) & (scale == 0), wrap(precision.cast("string")))
        .when((precision == 0) & (scale == 0), "(38)")
        .when((precision > 0) & (scale > 0), wrap(precision.cast("string"), F.lit(","), scale.cast("string")))
        .otherwise("")
    )
    return F.concat(name, size)


def frame_type(name, precision, scale) -> Column:
    """DataFrame type label of a field; names without a rule are strings."""
    name, precision, scale = map(lit_or_col, (name, precision, scale))
    out = F.when(name.isNull(), "StringType()")
    for key, label in FRAME_TYPES.items():
        out = out.when(name == key, label)
    return (
        out.when((name == "NUMERIC") & (precision == 0), "IntegerType()")
        .when(
            (name == "NUMERIC") & (precision > 0),
            F.concat(F.lit("DecimalType("), precision.cast("string"), F.lit(","), scale.cast("string"), F.lit(")")),
        )
        .otherwise("StringType()")
    )


def spark_type(name: str, precision: int | None = 0, scale: int | None = 0) -> str:
    """Spark type a staged field is cast to. TIME stays text (``HH:MM:SS``)."""
    name = (name or "STRING").upper()
    if name in ("NUMERIC", "NUMBER", "DECIMAL"):
        return f"decimal({precision or 38},{scale or 0})"
    return _SPARK.get(name, "string")
