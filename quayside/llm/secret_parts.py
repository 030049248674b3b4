r"""Secret scan: parts of a credential found by regular expressions and linked by an interval join.

Three kinds are reported on their own: ``assign`` (a secret word, = or :, and a value), ``access`` (an access
identifier) and ``hex`` (a long lower-case hexadecimal run). Three weak kinds mean little alone: ``identity`` (a user or
client name that is assigned), ``opaque`` (a long mixed token) and ``endpoint`` (a url). A weak part is reported only
when complementary parts stand in its scope, the ``scope`` code points around it: for an identity a secret (assign, hex,
opaque), for an opaque token an identifier (access, identity), for an endpoint both an identifier and a secret.

DataFrame functions only. ``split`` gives the gaps between the matches of a pattern, so running sums over gaps and
matches are the places in code points. Gaps and matches become rows that are shuffled by the number of their document,
without its text; the interval join is a range frame over their starts (a part's start against the reach of the parts
before and behind it), so no pairs are made, however many parts a document has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# kinds in the order in which spans with one start are listed
KINDS = ("assign", "access", "hex", "identity", "opaque", "endpoint")
BASE = 3
#: Code points around a weak part that are searched for complementary parts.
SCOPE = 200

_ASSIGN = r"""((?i)(?:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
# A longest run that is long enough is what a match of the run filtered by length gives, so the length is in the
# pattern where a match that fails cannot hide another.
PATTERNS = {
    "assign": _ASSIGN,
    "access": r"AKIA[A-Z0-9]{16,}+",
    "hex": r"[0-9a-f]{24,}+",
    "identity": r"""(?i)\b(?:access_?key_?id|client_?id|user_?name|user|login|account)["']?\x20*[:=]\x20*["']?[A-Za-z0-9_.@-]{3,}""",
    "opaque": r"(?<![A-Za-z0-9+/=_-])(?=[A-Za-z+/=_-]*[0-9])(?=[a-z0-9+/=_-]*[A-Z])(?=[A-Z0-9+/=_-]*[a-z])[A-Za-z0-9+/=_-]{32,}+",
    "endpoint": r"""(?i)\b(?:https?|jdbc:[a-z]+|postgres(?:ql)?|mysql|mongodb|redis|amqp|s3)://[^\s"'<>]+""",
}
# what a text must hold before its kind is searched; plain tests that the scan can do fast
_HINT = {
    "assign": r"(?i)(?:passw|secret|token|api_?key)",
    "access": "AKIA",
    "hex": r"[0-9a-f]{24}",
    "identity": r"(?i)(?:access_?key_?id|client_?id|user|login|account)",
    "opaque": r"[A-Za-z0-9+/=_-]{32}",
    "endpoint": "://",
}


def _hits(text: Column, kind: str) -> Column:
    """(gap, hit) for each match of a kind: the code points before it since the last match, and the match."""
    pattern, hint = PATTERNS[kind], _HINT[kind]
    gaps = F.transform(F.split(text, pattern, -1), lambda g: F.length(g))
    found = F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(1))
    zipped = F.arrays_zip(F.slice(gaps, F.lit(1), F.size(found)).alias("gap"), found.alias("hit"))
    none = F.array().cast("array<struct<gap:int,hit:string>>")
    test = text.contains(hint) if hint.isalnum() or hint == "://" else text.rlike(hint)
    return F.when(test, zipped.cast("array<struct<gap:int,hit:string>>")).otherwise(none)


def _labelled(k: int, kind: str) -> Column:
    def row(x: Column, i: Column) -> Column:
        return F.struct(F.lit(k).alias("kind"), i.alias("i"), x["gap"].alias("gap"), x["hit"].alias("hit"))

    return F.transform(_hits(F.col("_text"), kind), row)


def find_secrets(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope: int = SCOPE) -> DataFrame:
    """(id_col, spans), one row for each row of ``df``.

    ``spans`` is an array of (start, kind, end, linked) by start, then kind as in KINDS: code points, end exclusive;
    ``linked`` is true where complementary parts stand in scope. A null or empty text has no spans. Repeated rows and
    null ids are kept; other columns are ignored; an empty table gives an empty result. One document's parts are
    sorted in one task (they spill), documents are dealt by their row number, so no source or copy is a hot key."""
    text = F.col(text_col).cast("string")
    kinds = [_labelled(k, kind) for k, kind in enumerate(KINDS)]
    rows = df.select(F.monotonically_increasing_id().alias("_row"), F.col(id_col).alias("_id"), text.alias("_text"))
    rows = rows.select("_row", "_id", F.explode_outer(F.concat(*kinds)).alias("x")).select("_row", "_id", "x.*")
    value = F.regexp_extract("hit", _ASSIGN, 2)
    rows = rows.select(
        "_row", "_id", "kind", "i", F.coalesce("gap", F.lit(0)).alias("gap"), F.coalesce(F.length("hit"), F.lit(0)).alias("size"),
        F.when(F.col("kind") == 0, F.length(value) >= 6).otherwise(F.col("kind").isNotNull()).alias("holds"),
    ).repartition("_row")

    sums = Window.partitionBy("_row", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = rows.withColumn("end", F.sum(F.col("gap") + F.col("size")).over(sums))
    placed = placed.withColumn("start", F.col("end") - F.col("size"))

    # interval join: a part reaches from start - scope to end + scope
    identifier = F.col("holds") & F.col("kind").isin(1, 3)
    secret = F.col("holds") & F.col("kind").isin(0, 2, 4)
    strong_secret = F.col("holds") & F.col("kind").isin(0, 2)
    by_start = Window.partitionBy("_row").orderBy("start")
    before = by_start.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    behind = by_start.rangeBetween(Window.currentRow, Window.unboundedFollowing)

    def near(part: Column) -> Column:
        """A part of that role ends at most scope before this start, or starts at most scope behind this end."""
        last = F.max(F.when(part, F.col("end"))).over(before)
        following = F.min(F.when(part, F.col("start"))).over(behind)
        return F.coalesce(last >= F.col("start") - scope, F.lit(False)) | F.coalesce(
            following <= F.col("end") + scope, F.lit(False)
        )

    kind = F.col("kind")
    linked = (
        F.when(kind.isin(1, 3), near(secret))
        .when(kind.isin(0, 2, 4), near(identifier))
        .otherwise(near(identifier) & near(secret | strong_secret))
    )
    judged = placed.withColumn("linked", linked)
    reported = F.col("holds") & ((kind < BASE) | F.col("linked"))
    span = F.struct(F.col("start").cast("long").alias("start"), kind.alias("kind"), F.col("end").cast("long").alias("end"), "linked")
    names = F.array(*[F.lit(k) for k in KINDS])
    out = judged.groupBy("_row").agg(
        F.max("_id").alias("_id"), F.array_sort(F.collect_list(F.when(reported, span))).alias("s")
    )
    return out.select(
        F.col("_id").alias(id_col),
        F.transform(
            "s",
            lambda s: F.struct(
                s["start"].alias("start"), F.element_at(names, s["kind"] + 1).alias("kind"), s["end"].alias("end"), s["linked"].alias("linked")
            ),
        ).alias("spans"),
    )
