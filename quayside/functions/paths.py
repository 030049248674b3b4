"""Expressions over file paths, containers and path templates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quayside.functions.dates import STATIC_COB, render_token
from quayside.functions.text import lit_or_col, split_part

# Environment prefixes that a container name may carry.
ENVIRONMENT_PREFIXES = ["int_", "dvlp", "test", "rlse"]


def join_path(folder, name) -> Column:
    return F.concat(F.rtrim(lit_or_col(folder), F.lit("/")), F.lit("/"), lit_or_col(name))


def tidy_path(path) -> Column:
    """Drop leading, trailing and doubled slashes."""
    return F.array_join(F.filter(F.split(lit_or_col(path), "/"), lambda p: p != ""), "/")


def slash_wrapped(path) -> Column:
    """Exactly as given, plus a slash at either end where one is missing."""
    path = lit_or_col(path)
    head = F.when(F.startswith(path, F.lit("/")), path).otherwise(F.concat(F.lit("/"), path))
    return F.when(F.endswith(head, F.lit("/")), head).otherwise(F.concat(head, F.lit("/")))


def cob_from_path(path) -> Column:
    """First all-digit piece (pieces end at ``_ - / .``) above 19000100,
    otherwise the static COB."""
    numbers = F.transform(
        F.filter(F.split(lit_or_col(path), "[-_/.]"), lambda p: F.rlike(p, F.lit("^[0-9]+$"))),
        lambda p: p.try_cast("bigint"),
    )
    first = F.get(F.filter(numbers, lambda n: n > STATIC_COB - 1), F.lit(0))
    return F.coalesce(first, F.lit(STATIC_COB).cast("bigint"))


def find_cob(path) -> Column:
    """Eight digits between non-word characters, slashes removed; else NULL.
    An underscore is a word character, so ``f_20240131.csv`` gives NULL."""
    found = F.regexp_substr(lit_or_col(path), F.lit(r"(^|[^\w]|\s)\d{8}([^\w]|\s|$)"))
    return F.replace(found, F.lit("/"), F.lit(""))


def _pieces(path) -> Column:
    return F.filter(F.split(path, "[|]"), lambda p: p != "")


def expand_template(path, cob) -> Column:
    """Folder template to a concrete folder for a COB: ``/in/|:YYYYMM:|/``."""
    return F.array_join(
        F.transform(
            _pieces(slash_wrapped(path)),
            lambda p: F.when(F.like(p, F.lit(":%:")), render_token(F.replace(p, F.lit(":"), F.lit("")), cob)).otherwise(p),
        ),
        "",
    )


def template_pattern(path, cob) -> Column:
    """As :func:`expand_template`, every fixed piece becoming ``.*/``."""
    return F.array_join(
        F.transform(
            _pieces(slash_wrapped(path)),
            lambda p: F.when(
                F.like(p, F.lit(":%:")), render_token(F.replace(p, F.lit(":"), F.lit("")), cob)
            ).otherwise(F.lit(".*/")),
        ),
        "",
    )


def folder_pattern(path, pattern_cob, folder_cob) -> Column:
    """Search pattern of a folder: dated templates search by date only."""
    folder_cob = lit_or_col(folder_cob)
    dated = F.concat(F.lit(".*"), F.substr(lit_or_col(pattern_cob), F.lit(4)))
    fixed = F.concat(F.lit(".*"), F.when(F.instr(folder_cob, "/") == 1, F.substr(folder_cob, F.lit(2))).otherwise(folder_cob))
    return F.when(F.contains(lit_or_col(path), F.lit("YYYY")), dated).otherwise(fixed)


def file_name_for_cob(name, cob) -> Column:
    """Replace the three date tokens a file name may carry."""
    digits = lit_or_col(cob).cast("string")
    out = lit_or_col(name)
    for token, length in [("|:YYYY:|", 4), ("|:YYYYMM:|", 6)]:
        out = F.replace(out, F.lit(token), F.substring(digits, 1, length))
    return F.replace(out, F.lit("|:YYYYMMDD:|"), digits)


def expand_source_path(path, cob, environment: str) -> Column:
    """Upload-side template: date tokens as above, and ``:ENVIRONMENT:`` stands
    for the first ``_`` part of the environment, in lower case."""
    part = environment.split("_")[0]

    def piece(p):
        with_env = F.replace(p, F.lit(":ENVIRONMENT:"), F.lit(part))
        return F.when(
            F.like(with_env, F.lit(":%:")), render_token(F.replace(p, F.lit(":"), F.lit("")), cob)
        ).otherwise(F.replace(p, F.lit(":ENVIRONMENT:"), F.lit(part.lower())))

    return F.array_join(F.transform(_pieces(lit_or_col(path)), piece), "")


def container_name(container) -> Column:
    """Container without its environment prefix (``test3-sales`` -> ``sales``)."""
    container = lit_or_col(container)
    first = split_part(container, "-", 1)
    is_environment = F.contains(first, F.lit("int")) | F.substring(first, 1, 4).isin(ENVIRONMENT_PREFIXES)
    return F.when(is_environment, F.replace(container, F.concat(first, F.lit("-")), F.lit(""))).otherwise(container)


def container_from_url(url, is_production: bool) -> Column:
    """Container part of a storage location; other locations have none."""
    url = lit_or_col(url)
    last = split_part(url, "/", -1)
    bare = last if is_production else F.replace(last, F.concat(split_part(last, "-", 1), F.lit("-")), F.lit(""))
    return F.when(F.contains(url, F.lit("azure")), bare).otherwise(F.lit(""))


def file_extension(name) -> Column:
    return split_part(name, ".", -1)


def leaf(path) -> Column:
    return split_part(path, "/", -1)


def without_leaf(path) -> Column:
    """Path with every occurrence of its last part removed (text replacement)."""
    path = lit_or_col(path)
    name = leaf(path)
    return F.when(name == "", path).otherwise(F.replace(path, name, F.lit("")))


def folder_parts(folder) -> Column:
    """``/a/b/`` -> ``[a, b]``."""
    return F.filter(F.split(lit_or_col(folder), "/"), lambda p: p != "")


def ancestors(parts) -> Column:
    """``[a, b]`` -> ``[/, /a/, /a/b/]``. Takes a column of :func:`folder_parts`,
    so that the path is split once and not again for every level."""
    parts = lit_or_col(parts)
    return F.transform(
        F.sequence(F.lit(0), F.size(parts)),
        lambda n: F.when(n == 0, F.lit("/")).otherwise(
            F.concat(F.lit("/"), F.array_join(F.slice(parts, F.lit(1), n), "/"), F.lit("/"))
        ),
    )


def literal_anchor(folder) -> Column:
    """Longest leading run of whole folders that holds no LIKE wildcard."""
    folder = lit_or_col(folder)
    return F.when(
        ~F.rlike(folder, F.lit("[%_]")), folder
    ).otherwise(F.regexp_extract(folder, "^((?:/|[^%_/]+/)*)", 1))


def depth(path) -> Column:
    """Slashes in a path: how deep a folder lies."""
    path = F.col(path) if isinstance(path, str) else path
    return F.length(path) - F.length(F.replace(path, F.lit("/"), F.lit("")))
