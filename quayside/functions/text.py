"""Small text expressions shared by the other modules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Byte-order marks as they look after single-byte decoding.
BOM_TEXTS = ["ï»¿", "þÿ", "ÿþ"]

# Entry that stands for a missing trigger text.
DEFAULT_TRIGGER = ("Adf", "none")


def lit_or_col(value) -> Column:
    return value if isinstance(value, Column) else F.col(value)


def null_if_empty(c) -> Column:
    c = lit_or_col(c)
    return F.when(c != "", c)


def same_or_both_empty(a, b) -> Column:
    """Equality in which NULL and the empty text are one value."""
    return F.coalesce(lit_or_col(a), F.lit("")) == F.coalesce(lit_or_col(b), F.lit(""))


def split_part(c, delimiter: str, index: int) -> Column:
    """1-based part, negative from the end; index 0 means the first part."""
    return F.split_part(lit_or_col(c), F.lit(delimiter), F.lit(index or 1))


def strip_empty(c, delimiter: str) -> Column:
    """Drop the empty pieces of a delimited text and join the rest again."""
    pieces = F.split(lit_or_col(c), f"\\Q{delimiter}\\E")
    return F.array_join(F.filter(pieces, lambda p: p != ""), delimiter)


def split_tags(c, delimiter: str = "#") -> Column:
    """Delimited text to an array without empty pieces; repeats are kept."""
    return F.filter(F.split(lit_or_col(c), f"\\Q{delimiter}\\E"), lambda p: p != "")


def trigger_map(c) -> Column:
    """``k:v,k:v`` to a map. A value ends at its first colon; no text at all
    gives the default entry."""
    c = lit_or_col(c)
    pairs = F.transform(
        F.split(c, ","),
        lambda p: F.struct(
            F.split_part(p, F.lit(":"), F.lit(1)).alias("k"),
            F.split_part(p, F.lit(":"), F.lit(2)).alias("v"),
        ),
    )
    default = F.create_map(*[F.lit(v) for v in DEFAULT_TRIGGER])
    # a repeated key keeps its last value, as a dictionary literal would
    keys = F.array_distinct(F.transform(pairs, lambda p: p["k"]))
    parsed = F.map_from_entries(
        F.transform(
            keys,
            lambda k: F.struct(
                k.alias("key"),
                F.element_at(F.filter(pairs, lambda p: p["k"] == k), -1)["v"].alias("value"),
            ),
        )
    )
    return F.when(c.isNull() | (F.split_part(F.split_part(c, F.lit(","), F.lit(1)), F.lit(":"), F.lit(1)) == ""),
                  default).otherwise(parsed)


def strip_bom(c) -> Column:
    c = F.replace(lit_or_col(c), F.lit("﻿"), F.lit(""))
    for mark in BOM_TEXTS:
        c = F.replace(c, F.lit(mark), F.lit(""))
    return c


def thousands(c) -> Column:
    """Rounded number with comma separators, e.g. ``1,234``."""
    return F.format_number(F.round(lit_or_col(c), 0), 0)


def glob_like(name, pattern) -> Column:
    """Case-insensitive LIKE whose pattern comes from data, ``*`` standing for ``%``."""
    as_like = F.replace(F.upper(lit_or_col(pattern)), F.lit("*"), F.lit("%"))
    return F.like(F.upper(lit_or_col(name)), as_like)


def glob_head(pattern) -> Column:
    """Upper-case head of a name pattern of :func:`glob_like`: its places up to the first wildcard of any length."""
    return F.regexp_extract(F.upper(lit_or_col(pattern)), r"^([^*%\\]*)", 1)


def head_layout(head) -> Column:
    """Places of a pattern's head: ``x`` for a literal letter, ``_`` for any letter."""
    return F.regexp_replace(lit_or_col(head), "(?s)[^_]", "x")


def key_of_layout(name, layout) -> Column:
    """Letters of a name at the literal places of a layout, ``_`` at the others. Names shorter than the layout give a
    shorter key. A name fits the head of a pattern exactly if this key equals the head."""
    name, layout = F.upper(lit_or_col(name)), lit_or_col(layout)
    letters = F.transform(
        F.sequence(F.lit(1), F.length(layout)),
        lambda i: F.when((F.substr(layout, i, F.lit(1)) == "_") & (i <= F.length(name)), "_").otherwise(F.substr(name, i, F.lit(1))),
    )
    return F.when(F.contains(layout, F.lit("_")), F.array_join(letters, "")).otherwise(F.substr(name, F.lit(1), F.length(layout)))


def csv_cells(line: Column, delimiter: str) -> Column:
    """Cells of a line as they stand, quotes included; a delimiter inside double quotes does not split. Every cell is
    found as a delimiter and what follows it, so the search is linear and needs no look-ahead."""
    d, other = f"\\Q{delimiter}\\E", f"[^\\Q{delimiter}\\E]"
    quoted = r'\x20*+"[^"]*+(?:""[^"]*+)*+"'
    cell = f"{d}({quoted}{other}*+|{other}*+)"
    return F.regexp_extract_all(F.concat(F.lit(delimiter), line), F.lit(cell), F.lit(1))


def unquoted(cell: Column) -> Column:
    """A cell without the quotes around it; doubled quotes inside are single ones."""
    return F.replace(F.regexp_replace(cell, '(?s)^"(.*)"$', "$1"), F.lit('""'), F.lit('"'))
