"""Removal of bytes covered by a long string that also starts elsewhere.

A string of ``LENGTH`` bytes belongs to an anchor: of the 16-byte grams that start at its first ``REACH`` places, the one
with the smallest hash (of equal ones the first). The anchor depends on the string alone, so equal strings have equal
anchors at equal distance. Consecutive strings mostly share their anchor; such a run of starts is one row, about
2 / REACH rows for each byte. Intervals of strings are then refined in three passes over ever fewer rows, with a name (a
64-bit hash of bytes) in place of a rank:

1. the LENGTH - REACH + 1 bytes from the anchor on, which all strings of a run contain. A run whose name is alone holds no
   repeat;
2. the whole run with all its strings. If two runs agree, all of their strings are repeated;
3. what is left are the runs at the ends of repeated passages, one beside each kind of whole run: their strings are named
   one by one.

The README says why this replaces the merge of Burrows-Wheeler transforms. Every pass is a partial count by name and a
join back, so a name that very many runs share is neither collected nor held by one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import arrow_map, chunks, mix, prefix_hash, range_hash, stored, text_bytes, with_id

LENGTH = 400
REACH = 64
GRAM = 16
#: Bytes of a text that are looked at together; a place in them fits 28 bits.
WINDOW = 1 << 25

_PLACE = np.uint64((1 << 28) - 1)


def runs(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, reach: int = REACH):
    """(text, first start, last start, anchor) of the runs of strings with one anchor, places in ``data``; and the
    running hash of ``data``. Strings do not cross texts (offsets from 0)."""
    prefix = prefix_hash(data)
    none = np.zeros(0, np.int64)
    n = len(data) - GRAM + 1
    if len(data) < length:
        return none, none, none, none, prefix
    at = np.arange(n)
    gram = range_hash(prefix, at, at + GRAM)
    least, have = (gram & ~_PLACE) | at.astype(np.uint64), 1
    while have < reach:
        step = min(have, reach - have)
        least = np.minimum(least[: len(least) - step], least[step:])
        have += step
    start = np.arange(len(data) - length + 1)
    text = np.searchsorted(offsets, start, "right") - 1
    inside = start + length <= offsets[text + 1]
    start, text = start[inside], text[inside]
    anchor = (least[start] & _PLACE).astype(np.int64)
    if not len(start):
        return none, none, none, none, prefix
    new = np.ones(len(start), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])
    new = np.flatnonzero(new)
    last = np.concatenate([new[1:], [len(start)]]) - 1
    return text[new], start[new], start[last], anchor[new], prefix


def pieces(offsets: np.ndarray, length: int):
    """(first text, end of texts, first byte, last byte exclusive): texts together, or windows of a long one that hold each
    string whole once. A run that a window cuts is two runs, which are refined like any others."""
    for lo, hi in chunks(offsets):
        begin, end = int(offsets[lo]), int(offsets[hi])
        if end - begin <= WINDOW:
            yield lo, hi, begin, end
            continue
        for at in range(begin, max(begin + 1, end - length + 1), WINDOW):
            yield lo, hi, at, min(end, at + WINDOW + length - 1)


def _named(length: int, reach: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(2))
            for lo, hi, begin, end in pieces(offsets, length):
                own = np.clip(offsets[lo : hi + 1], begin, end) - begin
                text, first, last, anchor, prefix = runs(data[begin:end], own, length, reach)
                core = range_hash(prefix, anchor, anchor + (length - reach + 1))
                whole = mix(range_hash(prefix, first, last + length) + (anchor - first).astype(np.uint64))
                at = ((first + begin - offsets[lo + text]) << 24) | ((last - first) << 12) | (anchor - first)
                who = pa.array(lo + text)
                arrays = [batch.column(0).take(who), batch.column(1).take(who)]
                arrays += [pa.array(core.view(np.int64)), pa.array(whole.view(np.int64)), pa.array(at, pa.int64())]
                yield pa.RecordBatch.from_arrays(arrays, ["id", "salt", "core", "whole", "at"])

    return run


def _single(length: int):
    """From (id, salt, text, runs): the name of each string of the runs, (id, salt, name, start, lone)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(2))
            for k, places in enumerate(batch.column(3).to_pylist()):
                prefix = prefix_hash(data[offsets[k] : offsets[k + 1]])
                first = np.array([p["at"] >> 24 for p in places])
                count = np.array([(p["at"] >> 12 & 4095) + 1 for p in places])
                start = np.repeat(first - np.cumsum(count) + count, count) + np.arange(count.sum())
                lone = np.repeat(np.array([p["lone"] for p in places]), count)
                who = pa.array(np.full(len(start), k))
                arrays = [batch.column(0).take(who), batch.column(1).take(who)]
                arrays += [pa.array(range_hash(prefix, start, start + length).view(np.int64)), pa.array(start), pa.array(lone)]
                yield pa.RecordBatch.from_arrays(arrays, ["id", "salt", "name", "start", "lone"])

    return run


def _removed(length: int):
    """From (id, text, starts): what is left, and the removed runs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            out: list[list] = [[], [], [], [], []]
            for k, starts in enumerate(batch.column(2).to_pylist()):
                text = data[offsets[k] : offsets[k + 1]]
                edge = np.zeros(len(text) + 1, np.int64)
                for s in starts or []:
                    edge[s["lo"]] += 1
                    edge[min(s["hi"] + length, len(text))] -= 1
                gone = np.cumsum(edge[:-1]) > 0
                change = np.diff(np.concatenate([[0], gone.astype(np.int8), [0]]))
                lo, hi = np.flatnonzero(change == 1), np.flatnonzero(change == -1)
                left = text[~gone].tobytes()
                spans = [{"lo": int(a), "hi": int(b)} for a, b in zip(lo, hi, strict=True)]
                values = (len(text), int(gone.sum()), len(lo), hashlib.sha256(left).hexdigest(), spans)
                for column, value in zip(out, values, strict=True):
                    column.append(value)
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())]))]
            arrays = [batch.column(0), *(pa.array(c, t) for c, t in zip(out, kinds, strict=True))]
            yield pa.RecordBatch.from_arrays(arrays, ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "removed"])

    return run


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, reach: int = REACH) -> DataFrame:
    """(id_col, n_bytes, n_removed, n_spans, kept_sha256, removed), one row for each row of ``df``.

    ``removed`` lists the maximal removed runs of bytes (lo, hi exclusive) of the UTF-8 text: the bytes covered by a
    string of ``length`` bytes that also starts anywhere else, in the same text or another. A null text counts as
    empty; a shorter text has no such string. Repeated rows are documents of their own, so each repeats the other.
    Null ids are kept; other columns are ignored; an empty table gives an empty result."""
    docs = df.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    docs = docs.select("id", F.xxhash64("text").alias("salt"), "text")  # the salt tells texts apart that share an id
    key = "id long, salt long"
    named = arrow_map(docs, _named(length, reach), f"{key}, core long, whole long, at long")
    cores = named.groupBy("core").count().where("count > 1").select("core")
    live = stored(named.join(cores, "core"), "byte-repeats-runs")

    wholes = live.groupBy("core", "whole").agg(F.count("*").alias("n"), F.min(F.struct("id", "salt", "at")).alias("r"))
    wholes = stored(wholes, "byte-repeats-wholes")
    sure = live.join(wholes.where("n > 1").select("core", "whole"), ["core", "whole"])
    first = F.shiftright("at", 24)
    sure = sure.select("id", "salt", first.alias("lo"), (first + F.shiftright("at", 12).bitwiseAND(4095)).alias("hi"))

    lone = wholes.where("n = 1")
    beside = wholes.where("n > 1").join(lone.select("core").distinct(), "core", "left_semi")
    probe = lone.select("r.*", F.lit(True).alias("lone")).unionByName(beside.select("r.*", F.lit(False).alias("lone")))
    probe = probe.groupBy("id", "salt").agg(F.collect_list(F.struct("at", "lone")).alias("runs"))
    probe = probe.withColumnsRenamed({"id": "_id", "salt": "_salt"})
    same = F.col("id").eqNullSafe(F.col("_id")) & (F.col("salt") == F.col("_salt"))
    # one row for each text, also where rows are repeated
    texts = docs.join(probe, same).groupBy("id", "salt").agg(F.min("text").alias("text"), F.min("runs").alias("runs"))
    single = stored(arrow_map(texts, _single(length), f"{key}, name long, start long, lone boolean"), "byte-repeats-strings")
    names = single.groupBy("name").agg(F.count("*").alias("n"), F.max("lone").alias("any")).where("n > 1 and any").select("name")
    found = single.where("lone").join(names, "name").select("id", "salt", F.col("start").alias("lo"), F.col("start").alias("hi"))

    starts = sure.unionByName(found).distinct().groupBy("id", "salt").agg(F.collect_list(F.struct("lo", "hi")).alias("starts"))
    starts = starts.withColumnsRenamed({"id": "_id", "salt": "_salt"})
    out = docs.join(starts, same, "left").select("id", "text", "starts")
    result = arrow_map(
        out, _removed(length),
        with_id(out, "n_bytes long, n_removed long, n_spans long, kept_sha256 string, removed array<struct<lo:long,hi:long>>"),
    )
    return result.withColumnRenamed("id", id_col)
