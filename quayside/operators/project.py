"""Typed projection of a scan from the declared fields of a feed."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from quayside.functions.dates import java_format, local_to_utc
from quayside.functions.text import null_if_empty
from quayside.functions.types import spark_type
from quayside.sources.scan import CORRUPT

BAD = "_bad"


@dataclass(frozen=True)
class Field:
    source_name: str
    target_name: str
    ordinal: int = 1
    type_name: str = "STRING"
    length: int = 0
    precision: int = 0
    scale: int = 0
    in_source: bool = True
    in_target: bool = True
    derived: str | None = None

    @classmethod
    def from_row(cls, row: Row | Mapping) -> Field:
        r = row.asDict() if isinstance(row, Row) else dict(row)
        return cls(
            source_name=r["source_field_name"],
            target_name=r["target_field_name"],
            ordinal=1 if r.get("field_ordinal") is None else r["field_ordinal"],
            type_name=r.get("data_type_name") or "STRING",
            length=r.get("data_type_length") or 0,
            precision=r.get("data_type_precision") or 0,
            scale=r.get("data_type_scale") or 0,
            in_source=bool(r.get("is_in_source")),
            in_target=True if r.get("is_in_target") is None else bool(r["is_in_target"]),
            derived=r.get("derived_expression") or None,
        )


@dataclass(frozen=True)
class Formats:
    date: str = "DD/MM/YYYY"
    timestamp: str = "DD/MM/YYYY HH24:MI:SS.FF3"
    timezone: str = "Europe/London"


def loadable(fields: Iterable[Field]) -> list[Field]:
    """Target fields in load order (a negative ordinal takes a field out)."""
    kept = [f for f in fields if f.ordinal >= 0 and f.in_target]
    return sorted(kept, key=lambda f: (f.ordinal, f.source_name or ""))


def cast_cell(cell: Column, field: Field, formats: Formats) -> tuple[Column, Column]:
    """``(value, has_text)``. Empty text is NULL; a cell that has text but no
    value could not be converted."""
    filled = null_if_empty(cell)
    kind = field.type_name.upper()
    if kind == "DATE":
        value = F.try_to_timestamp(filled, F.lit(java_format(formats.date))).cast("date")
    elif kind == "DATETIME":
        local = F.try_to_timestamp(filled, F.lit(java_format(formats.timestamp)))
        value = local_to_utc(local.cast("timestamp_ntz"), formats.timezone).cast("timestamp")
    else:
        target = spark_type(kind, field.precision, field.scale)
        if target == "string":
            # the length is a check: longer text is a bad cell, it is never cut
            value = filled if not field.length else F.when(F.length(filled) <= field.length, filled)
        else:
            value = filled.try_cast(target)
    return value, filled.isNotNull()


def _derived(field: Field, reference: str) -> Column:
    """Derived expression with the field name standing for its source cell."""
    name = re.escape(field.source_name.replace('"', ""))
    cell = f"nullif({reference}, '')"
    return F.expr(re.sub(rf"(?<!\w){name}(?!\w)", lambda _: cell, field.derived))


def typed_projection(
    df: DataFrame,
    fields: Sequence[Field],
    formats: Formats = Formats(),
    source_columns: Mapping[str, str] | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Cast and rename the declared fields; ``keep`` columns pass through.

    ``source_columns`` maps a source field to its column in ``df``; fields it
    lacks are left out. By default field *n* is read from column ``c<n>``. The
    flag ``_bad`` marks rows with a cell that could not be converted or with a
    wrong number of cells.
    """
    values, filled, out = [], [], []
    ordered = loadable(fields)
    for i, field in enumerate(f for f in ordered if f.in_source):
        if source_columns is None:
            reference = f"`c{field.ordinal}`"
        elif field.source_name in source_columns:
            reference = f"`{source_columns[field.source_name]}`"
        else:
            continue
        if field.derived:
            values.append(_derived(field, reference).alias(f"_v{i}"))
        else:
            value, has_text = cast_cell(F.expr(reference).cast("string"), field, formats)
            values += [value.alias(f"_v{i}"), has_text.alias(f"_f{i}")]
            filled.append(i)
        out.append(F.col(f"_v{i}").alias(field.target_name))
    extra = [f for f in ordered if not f.in_source and f.derived]
    values += [F.expr(f.derived).alias(f"_x{i}") for i, f in enumerate(extra)]
    out += [F.col(f"_x{i}").alias(f.target_name) for i, f in enumerate(extra)]

    # the values are converted in a projection of their own, so that the flag
    # looks at results instead of converting every cell a second time
    malformed = F.col(CORRUPT).isNotNull() if CORRUPT in df.columns else F.lit(False)
    converted = df.select(*values, *keep, malformed.alias("_malformed"))
    bad = F.col("_malformed")
    for i in filled:
        bad = bad | (F.col(f"_f{i}") & F.col(f"_v{i}").isNull())
    return converted.select(*out, *keep, bad.alias(BAD))
