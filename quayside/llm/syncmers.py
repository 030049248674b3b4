"""Document fingerprints of closed syncmers, and a comparison of each document with an edit of itself and its successor.

A run of K characters is an anchor if the smallest hash among its runs of S characters stands at its first or last
place. Whether it is one depends on these K characters alone, so a passage has the same anchors wherever it stands and
an edit changes only the anchors it touches. An anchor equal to the one before it (a repeated character) is left out.
A fingerprint is the anchors' places and hashes in order; two fingerprints are compared by the anchors they share whose
displacement at least one other shared anchor has too. Texts of all lengths use the same runs, so that any two
fingerprints can be compared; they are short, because few anchors of long ones fit in a short text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import arrow_map, constants, mix, powers, _BASE_INVERSE

K = 16
S = 6
#: Longer runs, for fewer anchors; no fingerprint uses them.
LONG_K = 64
LONG_S = 16
#: Id ranges for each shuffle partition, and in all; the first id of each range goes to the driver.
RANGES = 16
MOST_RANGES = 100_000

_SALT = constants(47, 2)


def anchors(text: str, short: bool = True) -> np.ndarray:
    """Rows (place, 32-bit hash); a text shorter than a run is one anchor as a whole, an empty one has none.
    short: the runs of fingerprints, else the longer ones."""
    k, s = (K, S) if short else (LONG_K, LONG_S)
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    n = len(points)
    if not n:
        return np.zeros((0, 2), np.uint32)
    prefix = np.zeros(n + 1, np.uint64)
    np.cumsum(mix(points.astype(np.uint64) + _SALT[:1]) * powers(n), out=prefix[1:])
    back = powers(n + 1, _BASE_INVERSE)
    if n < k:
        whole = mix(prefix[n:] + np.array([n], np.uint64) * _SALT[1:])
        return np.array([[0, int(whole[0]) >> 32]], np.uint32)
    inner = mix((prefix[s:] - prefix[: n - s + 1]) * back[: n - s + 1])
    w = k - s + 1
    least, have = inner, 1
    while have < w:
        step = min(have, w - have)
        least = np.minimum(least[: len(least) - step], least[step:])
        have += step
    at = np.flatnonzero((least == inner[: n - k + 1]) | (least == inner[w - 1 :]))
    value = (mix((prefix[at + k] - prefix[at]) * back[at]) >> np.uint64(32)).astype(np.uint32)
    new = np.ones(len(at), bool)
    new[1:] = value[1:] != value[:-1]
    return np.stack([at[new].astype(np.uint32), value[new]], axis=1)


def written(marks: np.ndarray) -> str:
    """Sixteen hexadecimal digits for each anchor: place, then hash."""
    return marks.astype(">u4").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """0 to 1: twice the matched anchors by the different anchors of both; 1 for two empty texts."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    _, at = np.unique(a[:, 1], return_index=True)
    _, bt = np.unique(b[:, 1], return_index=True)
    _, ia, ib = np.intersect1d(a[at, 1], b[bt, 1], assume_unique=True, return_indices=True)
    shift = a[at[ia], 0].astype(np.int64) - b[bt[ib], 0].astype(np.int64)
    _, counts = np.unique(shift, return_counts=True)
    support = 1 if min(len(at), len(bt)) < 4 else 2
    return float(2 * counts[counts >= support].sum() / (len(at) + len(bt)))


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_chars, fingerprint), one row for each row of ``df``, no shuffle. A null counts as empty."""
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            n, prints = [len(t) for t in texts], [written(anchors(t)) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(prints, pa.string())], ["id", "n_chars", "fingerprint"]
            )

    texts = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return arrow_map(texts, run, f"id {kind}, n_chars long, fingerprint string").withColumnRenamed("id", id_col)


def with_successors(df: DataFrame) -> DataFrame:
    """The rows (id long, text) dealt by ranges of ids and sorted, each range ended by a copy of the row that follows
    it (``last`` true): (range, last, id, text). The row after the last one is the first.

    Range bounds are approximate quantiles, so ranges have similar shares; the first id of each range (at most
    MOST_RANGES numbers) is all that the driver sees. A null id comes first."""
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    count = min(MOST_RANGES, RANGES * parts)
    cuts = df.approxQuantile("id", [i / count for i in range(1, count)], 0.25 / count) if count > 1 else []
    splits = [-float("inf"), *(sorted(set(cuts)) or [0.0]), float("inf")]
    keyed = df.withColumn("place", F.coalesce(F.col("id").cast("double"), F.lit(-1.7e308)))
    ranged = Bucketizer(splits=splits, inputCol="place", outputCol="b").transform(keyed)
    ranged = ranged.select(F.col("b").cast("int").alias("range"), "id", "text")
    first = ranged.select("range", "id").groupBy("range").agg(F.min(F.struct(F.col("id").isNotNull().alias("x"), "id")).alias("f"))
    heads = sorted((r["range"], r["f"]["id"]) for r in first.collect())
    before = [(heads[i - 1][0], head) for i, (_, head) in enumerate(heads)]
    ends = F.broadcast(spark.createDataFrame(before, "range int, head long"))
    tail = ranged.drop("range").join(ends, F.col("id").eqNullSafe(F.col("head")))
    rows = ranged.select("range", F.lit(False).alias("last"), "id", "text")
    rows = rows.unionByName(tail.select("range", F.lit(True).alias("last"), "id", "text"))
    return rows.repartition(parts, "range").sortWithinPartitions("range", "last", "id", "text")


def compare_with_edits(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next), one row for each row.

    A text's edit has its last floor(n / 2) code points replaced by as many of the next document's first (or all), in
    the order of ids, after the last the first. A null text counts as empty; rows with equal ids follow each other by
    text; a null id comes first; a table of one row is its own successor. Ids are whole numbers; other columns are
    ignored. Texts are shuffled once and read in order: a task holds one batch and the row before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here = row = None
        for batch in batches:
            out: list[list] = [[] for _ in range(7)]
            for part, last, i, text in zip(*(batch.column(c).to_pylist() for c in range(4)), strict=True):
                text = text or ""
                marks = anchors(text)
                if row is not None and part == here:
                    own, t, m = row
                    half = len(t) // 2
                    edited = t[: len(t) - half] + text[:half]
                    e = anchors(edited)
                    sha = hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest()
                    near = [likeness(m, e), likeness(m, marks)]
                    result = (own, len(t), sha, written(m), written(e), *near)
                    for column, value in zip(out, result, strict=True):
                        column.append(value)
                here, row = part, None if last else (i, text, marks)
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            names = ["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds, strict=True)], names)

    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = "id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string"
    out = arrow_map(with_successors(rows), run, schema + ", near_edited double, near_next double")
    return out.withColumnRenamed("id", id_col)
