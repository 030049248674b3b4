"""The three column-name normalisers (inferred, profiled, header)."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from quayside.functions.text import lit_or_col

# Characters removed from inferred column names.
SPECIAL_CHARACTERS = [
    "@", "#", "$", "*", "&", "-", "(", ")", "[", "]", "+", "/", "\\", "|", "{", "}",
    "<", ">", "?", "!", "~", "ï", "Ï", "»", "¿", "þ", "ÿ", "'",
]

_SPECIAL_CLASS = "[" + "".join(re.escape(ch) if ord(ch) < 128 else ch for ch in SPECIAL_CHARACTERS) + "]"


def inferred_name(name) -> Column:
    """Specials dropped, spaces to ``_``, words split before capitals, upper."""
    name = lit_or_col(name)
    text = F.regexp_replace(name, _SPECIAL_CLASS, "")
    text = F.regexp_replace(text, " +", "_")
    text = F.upper(F.regexp_replace(text, "([^A-Z])([A-Z])", "$1_$2"))
    text = F.regexp_replace(F.regexp_replace(text, "_+", "_"), "^_", "")
    return F.when(F.upper(name) == "COBID", F.lit("COBID")).otherwise(text)


def profiled_name(name) -> Column:
    """Non-word characters dropped, ``_`` before capitals after the first, upper."""
    text = F.regexp_replace(lit_or_col(name), r"(?U)\W", "")
    rest = F.regexp_replace(F.substr(text, F.lit(2)), "([A-Z])", "_$1")
    return F.upper(F.concat(F.substring(text, 1, 1), rest))


def header_name(name) -> Column:
    """Upper case, runs of other characters to one ``_``."""
    return F.regexp_replace(F.upper(lit_or_col(name)), "[^A-Za-z0-9]+", "_")
