"""URL filter: rules on host and path prefix, found by a sorted sweep over canonical keys.

A rule's canonical key is its host with the labels reversed, then its path (``org.example/es/``). A url gets one key
for its host and one for each parent host, each followed by its path. A rule fits a url exactly when its key is a
prefix of one of these, so it covers an interval of the sorted keys. Rules and url keys are dealt into key ranges, a
rule into every range that its interval touches; inside a range they are sorted together and swept once with a stack
of the rules that are open. Rules nest, so the stack's top is the longest one that fits.

Range bounds come from a bounded sample of keys (``BOUNDS_SAMPLE``); they steer the balance only, never the result.
A key that many urls share appears in the sample as several equal bounds, and its rows are dealt among all ranges
between them, so no single key fills a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import arrow_map

BOUNDS_SAMPLE = 2000
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def url_host(url: Column) -> Column:
    """Between the first ``://`` and ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without one."""
    host = F.coalesce(F.regexp_extract(url, _URL, 1), F.lit(""))
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def canonical_host(host: Column) -> Column:
    return F.array_join(F.reverse(F.split(host, r"\.")), ".")


def _parents(host: Column) -> Column:
    """The canonical host and its parents: a.b.c gives c.b.a, c.b and c."""
    labels = F.reverse(F.split(host, r"\."))
    return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda n: F.array_join(F.slice(labels, F.lit(1), n), "."))


def _bounds(keys: DataFrame, parts: int) -> list[str]:
    """parts - 1 sorted bounds of about equal shares, from at most BOUNDS_SAMPLE keys."""
    total = keys.count()
    if not total or parts < 2:
        return []
    share = min(1.0, 1.5 * BOUNDS_SAMPLE / total)
    rows = keys.sample(share, seed=7).limit(BOUNDS_SAMPLE).collect()
    sample = sorted(r[0] for r in rows)
    if not sample:
        return []
    return [sample[len(sample) * i // parts] for i in range(1, parts)]


def _place(key: Column, bounds: Column) -> tuple[Column, Column]:
    """The first and the last range a key may go to."""
    first = F.size(F.filter(bounds, lambda b: b < key))
    last = F.size(F.filter(bounds, lambda b: b <= key))
    return first, last


_SWEPT = "row long, rule string, action string, size int"


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by range, key, kind (a rule before the urls with its key). Memory: one batch and the open rules."""
    here, stack = None, []
    for batch in batches:
        rows, rules, actions, sizes = [], [], [], []
        for part, key, row, rule, action in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
            if part != here:
                here, stack = part, []
            while stack and not key.startswith(stack[-1][0]):
                stack.pop()
            if row is None:
                stack.append((key, rule, action))
            elif stack:
                rows.append(row)
                rules.append(stack[-1][1])
                actions.append(stack[-1][2])
                sizes.append(len(stack[-1][0]))
        columns = [pa.array(rows, pa.int64()), pa.array(rules, pa.string()), pa.array(actions, pa.string())]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(sizes, pa.int32())], ["row", "rule", "action", "size"])


def judge_urls(df: DataFrame, rules: DataFrame, id_col: str, url_col: str, default: str = "allow") -> DataFrame:
    """(id_col, host, path, rule, verdict), one row for each row of ``df``; other columns of ``df`` are ignored.

    ``rules`` has host, path and action. The longest fitting rule decides; of equal rules a block goes first. Without
    a fitting rule ``rule`` is null and ``verdict`` is ``default``. A null url, or one without ``://``, has an empty
    host and path; a rule with a null host, path or action, or a path that does not start with ``/``, is left out.
    Empty tables give empty results; repeated rows are judged each."""
    spark = df.sparkSession
    urls = df.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("_id"),
        url_host(F.col(url_col)).alias("host"), url_path(F.col(url_col)).alias("path"),
    )
    rules = rules.where("host is not null and action is not null and startswith(path, '/')").select(
        F.concat(canonical_host(F.col("host")), "path").alias("key"),
        F.concat("host", "path").alias("rule"), "action",
    )
    rules = rules.groupBy("key").agg(F.max(F.struct("action", "rule")).alias("r")).select("key", "r.rule", "r.action")
    points = urls.where("startswith(path, '/')").select("row", F.explode(_parents(F.col("host"))).alias("h"), "path")
    points = points.select(F.concat("h", "path").alias("key"), "row")

    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    bounds = F.array(*[F.lit(b) for b in _bounds(points.select("key"), min(parts, 200))]).cast("array<string>")
    first, last = _place(F.col("key"), bounds)
    dealt = points.select(
        (first + F.pmod(F.col("row"), last - first + 1)).alias("part"), "key", "row",
        F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("action"),
    )
    top = _place(F.concat("key", F.lit("\U0010ffff")), bounds)[1]
    copies = rules.select(
        F.explode(F.sequence(first, top)).alias("part"), "key", F.lit(None).cast("long").alias("row"), "rule", "action"
    )
    ordered = dealt.unionByName(copies).repartition(parts, "part").sortWithinPartitions("part", "key", F.col("row"))
    swept = arrow_map(ordered, _sweep, _SWEPT)

    best = swept.select("row", F.struct("size", "rule", "action").alias("best"))
    every = urls.select("row", "_id", "host", "path", F.lit(None).cast(best.schema["best"].dataType).alias("best"))
    found = best.select("row", F.lit(None).cast(urls.schema["_id"].dataType).alias("_id"),
                        F.lit(None).cast("string").alias("host"), F.lit(None).cast("string").alias("path"), "best")
    one = every.unionByName(found).groupBy("row").agg(
        F.max("_id").alias("_id"), F.max("host").alias("host"), F.max("path").alias("path"), F.max("best").alias("best")
    )
    return one.select(
        F.col("_id").alias(id_col), "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce("best.action", F.lit(default)).alias("verdict"),
    )
