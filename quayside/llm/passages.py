"""Near-duplicate passages by compact windows.

A text is a sequence of five-word shingles, and of each shingle several hash functions are taken. For one function, the
Cartesian tree over a document's values (its root the smallest value, its subtrees the parts on both sides) groups all
subsequences by the value they have as MinHash: those between the ends of a node's subtree that contain the node. Such
a group is a compact window (left end, node, right end). Only windows of at least ``WINDOW`` shingles matter; they are
the nodes that are the smallest of some run of WINDOW shingles, so one sliding minimum finds them with both ends, about
2 / WINDOW of all shingles for each function.

The windows of FUNCTIONS functions are intersected inside the document (an interval join of runs along the text), so
that what is left has the same smallest values for all of them, and meet other documents' windows with these values by a
shuffle. Windows of equal content form a class first: if it has several documents they are exact repeats as a whole, and
one window stands for it. Of the classes in such a group the first in the order of ids is the hub and every other one is
laid over it at the node (the intervals must overlap by WINDOW shingles), then over the first 8 and HUBS. Of the pairs left in
larger groups those meet that can be near: two pieces that share at least PERCENT share one of the few rarest shingles of
either (a prefix filter, exact for any common order of the shingles; here the rarest of the group come first). A pair is left
out only if it can add nothing: the same region was verified before, or no piece
of the overlap can be near that lies outside the passages of either side or links two components. Whether a piece can
be near is read from two bytes of each shingle, which all windows carry: equal shingles have equal bytes, so this rules
out no piece that the shingles would confirm. Of the overlaps that would join the same components or add the same place
to a document the likeliest goes first; the others wait and are dropped only when passages and links found meanwhile
leave them nothing to add. Overlaps are verified on the shingles: a
passage is a run of WINDOW-shingle pieces that each share at least ``PERCENT`` of their shingles with the other
document's piece beside it; a shingle that a piece repeats counts as often as both pieces have it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quayside.llm.common import (
    _BASE_INVERSE, ONE_TASK, arrow_map, chunks, components, constants, discard, mix, powers, release, shingles, small, stored, text_bytes, words,
)

SHINGLE = 5
#: Shingles of the shortest passage; 46 five-word shingles are 50 words.
WINDOW = 46
#: Groups of functions, and functions in each, that must agree in one group. Pieces of similarity 0.8 agree in none
#: with probability 0.047, of 0.9 with 0.007; a passage has a chance at each of its places, exact repeats always agree.
BANDS = 3
FUNCTIONS = 2
PERCENT = 80
#: Runs that are taken together when the smallest value of each is looked for.
BLOCK = 1 << 23
#: Shingles that two near pieces share at least, and the prefixes of pieces of which near ones share a shingle.
NEED = -(-2 * PERCENT * WINDOW // (100 + PERCENT))
PREFIX = WINDOW - NEED + 1
#: Classes of a group over which all others are laid.
HUBS = 64
#: Pieces that are sorted together.
SORTED = 1 << 14
#: Classes of a group that one task lays over the hubs.
SLICE = 512
#: Pairs that are compared by bytes together.
COMPARED = 1024
#: An overlap of two texts: places lo to hi of a, and those before them by shift of b.
REGION = ["a", "b", "shift", "lo", "hi"]

_SEED = constants(53, BANDS * FUNCTIONS).reshape(BANDS, FUNCTIONS)
_TERM = constants(59, FUNCTIONS)


def sequences(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For chunks of texts: the first text's number, all shingle hashes, and where each text's shingles begin."""
    for lo, hi in chunks(offsets):
        word, doc, _, _ = words(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
        shingle, at = shingles(word, doc, SHINGLE)
        yield lo, shingle, np.searchsorted(doc[at], np.arange(hi - lo + 1))


def smallest(shingle: np.ndarray, seed: np.uint64, window: int = WINDOW, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """The hash values, and for each run of ``window`` shingles the place of its smallest one, of equal ones the first.
    Runs are taken in blocks of ``block``, so that a place in a block and its end fits below the value's upper bits."""
    value = mix(shingle ^ seed)
    found = [_smallest(value[i : i + block + window - 1], window) + i for i in range(0, len(value) - window + 1, block)]
    return value, np.concatenate(found) if found else np.zeros(0, np.int64)


def _smallest(value: np.ndarray, window: int) -> np.ndarray:
    # the value's upper bits with the place below them
    least, have = (value & np.uint64(0xFFFFFFFFFF000000)) | np.arange(len(value), dtype=np.uint64), 1
    while have < window:
        step = min(have, window - have)
        least = np.minimum(least[: len(least) - step], least[step:])
        have += step
    return (least & np.uint64(0xFFFFFF)).astype(np.int64)


def compact_windows(shingle: np.ndarray, begin: np.ndarray, seeds: np.ndarray, window: int = WINDOW):
    """(text, key, left, node, right) of the compact windows that all functions of a band share: the subsequences of at
    least ``window`` shingles whose smallest values are the same nodes. Places count from the text's first shingle,
    ``node`` is the first function's."""
    none = np.zeros(0, np.int64)
    if len(shingle) < window:
        return none, np.zeros(0, np.uint64), none, none, none
    found = [smallest(shingle, seed, window) for seed in seeds]
    start = np.arange(len(shingle) - window + 1)
    text = np.searchsorted(begin, start, "right") - 1
    whole = start + window <= begin[text + 1]
    start, text = start[whole], text[whole]
    if not len(start):
        return none, np.zeros(0, np.uint64), none, none, none
    nodes = [node[whole] for _, node in found]
    new = np.ones(len(start), bool)
    new[1:] = text[1:] != text[:-1]
    for node in nodes:
        new[1:] |= node[1:] != node[:-1]
    new = np.flatnonzero(new)
    last = np.concatenate([new[1:], [len(start)]]) - 1
    key = np.zeros(len(new), np.uint64)
    for (value, _), node, term in zip(found, nodes, _TERM, strict=False):
        key += mix(value[node[new]] * term)
    base = begin[text[new]]
    return text[new], mix(key), start[new] - base, nodes[0][new] - base, start[last] + window - 1 - base


def content(prefix: np.ndarray, start: np.ndarray, end: np.ndarray, node: np.ndarray) -> np.ndarray:
    """A hash of the shingles from start to end (exclusive), of how many they are and of the node's place among them."""
    back = powers(len(prefix), _BASE_INVERSE)
    shape = (end - start).astype(np.uint64) * _TERM[0] + node.astype(np.uint64) * _TERM[1]
    return mix(mix((prefix[end] - prefix[start]) * back[start]) + shape).view(np.int64)


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        for lo, shingle, begin in sequences(*text_bytes(batch.column(1))):
            out = []
            prefix = np.zeros(len(shingle) + 1, np.uint64)
            np.cumsum(mix(shingle) * powers(len(shingle)), out=prefix[1:])
            for band in range(BANDS):
                text, key, left, node, right = compact_windows(shingle, begin, _SEED[band])
                key = (key & np.uint64(0xFFFFFFFFFFFFFFF8)) | np.uint64(band)
                at = begin[text] + left
                same = content(prefix, at, at + right - left + 1, node - left)
                out.append((ids[lo + text], key.view(np.int64), left, node, right, same))
            columns = [pa.array(np.concatenate(c).astype(np.int64)) for c in zip(*out, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, ["id", "key", "left", "node", "right", "same"])


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, key) of what ``_windows`` gives, each once for a text."""
    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        for lo, shingle, begin in sequences(*text_bytes(batch.column(1))):
            for band in range(BANDS):
                text, key = compact_windows(shingle, begin, _SEED[band])[:2]
                key = (key & np.uint64(0xFFFFFFFFFFFFFFF8)) | np.uint64(band)
                new = np.ones(len(key), bool)  # a run of equal shingles has the same key at each of its places
                new[1:] = (key[1:] != key[:-1]) | (text[1:] != text[:-1])
                yield pa.RecordBatch.from_arrays([pa.array(ids[lo + text[new]].astype(np.int64)), pa.array(key[new].view(np.int64))], ["id", "key"])


def _sequences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From (id, text): the shingles of each text, and two bytes of each."""
    for batch in batches:
        for lo, shingle, begin in sequences(*text_bytes(batch.column(1))):
            parts = [shingle[i:j] for i, j in zip(begin, begin[1:], strict=False)]
            arrays = [pa.array([x.astype("<u2").tobytes() for x in parts], pa.binary()), pa.array([x.tobytes() for x in parts], pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, len(parts)), *arrays], ["id", "marks", "shingles"])


def may_add(x: list[bytes], y: list[bytes], start: np.ndarray, first: np.ndarray, last: np.ndarray, window: int = WINDOW):
    """(first place, last place, most shingles in common) of the pieces of each overlap that can add something, places
    within the overlap; 0 in common if there are none. x, y: two bytes of each of its shingles on both sides; start: its first
    place on either side; pieces from place first to last on both sides (each 2 x n) are passages already."""
    size = np.array([len(t) // 2 for t in x])
    width = int(size.max())
    own, other = np.zeros((2, len(x), width), np.uint16)
    inside = np.arange(width) < size[:, None]
    own[inside], other[inside] = np.frombuffer(b"".join(x), "<u2"), np.frombuffer(b"".join(y), "<u2")
    own, other = np.where(inside, own, own[:, :1]), np.where(inside, other, other[:, :1])
    common = _standing(own, other, window)
    place = np.arange(common.shape[1])
    common[place + window > size[:, None]] = 0
    # the other side's as well: one shingle there may stand for many repeated ones here
    rows = np.flatnonzero((100 * common >= PERCENT * (2 * window - common)).any(axis=1))
    common[rows] = np.minimum(common[rows], _standing(other[rows], own[rows], window))
    near = 100 * common >= PERCENT * (2 * window - common)
    at = start[:, :, None] + place
    known = (first[:, :, None] <= at) & (at + window - 1 <= last[:, :, None])
    new = near & ~known.all(axis=0)
    return new.argmax(axis=1), common.shape[1] - 1 - new[:, ::-1].argmax(axis=1) + window - 1, np.where(new, common, 0).max(axis=1)


def _standing(own: np.ndarray, other: np.ndarray, window: int) -> np.ndarray:
    """How many shingles of each piece of ``own`` stand in the row of ``other``, no matter where."""
    have = np.zeros(own.shape, bool)
    for j in range(own.shape[1]):
        have |= own == other[:, j : j + 1]
    total = np.zeros((len(own), own.shape[1] + 1), np.int64)
    np.cumsum(have, axis=1, out=total[:, 1:])
    return total[:, window:] - total[:, :-window]


def numbered(pieces: np.ndarray) -> np.ndarray:
    """The shingles of each piece (numbers below 2 ** 32, one row each), in order, with how many equal ones the piece has before
    each in the lower 16 bits: no number is twice in a row."""
    value = np.sort(pieces.astype(np.int64), axis=1)
    place = np.arange(value.shape[1])
    first = np.zeros(value.shape, np.int64)
    first[:, 1:] = np.where(value[:, 1:] != value[:, :-1], place[1:], 0)
    return value << 16 | (place - np.maximum.accumulate(first, axis=1))


def _pieces(marks: list[bytes], window: int = WINDOW) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, numbered shingles) of the pieces of all rows, about SORTED pieces together."""
    size = np.array([len(t) // 2 for t in marks], np.int64)
    data, begin = np.frombuffer(b"".join(marks), "<u2"), np.cumsum(size) - size
    count = np.maximum(size - window + 1, 0)
    row = np.repeat(np.arange(len(marks)), count)
    start = np.arange(len(row)) - (np.cumsum(count) - count)[row] + begin[row]
    for i in range(0, len(row), SORTED):
        yield row[i : i + SORTED], numbered(data[start[i : i + SORTED, None] + np.arange(window)])


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From (key, r, marks): the numbered shingles of all pieces of each row, (key, r, token). Of a long row some may come
    twice, which only changes the order in which prefixes are taken, for the whole group alike."""
    for batch in batches:
        for row, token in _pieces(batch.column(2).to_pylist()):
            both = np.unique(row[:, None] << 32 | token)
            who = pa.array(both >> 32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(who), batch.column(1).take(who), pa.array(both & 0xFFFFFFFF)], ["key", "r", "token"]
            )


def _rarest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From (key, r, component, open, marks, frequent): the tokens among the PREFIX rarest of a piece that other rows of the
    group have as well. ``frequent`` lists those tokens and how many rows have each."""
    for batch in batches:
        frequent, size = batch.column(5).flatten(), batch.column(5).value_lengths().to_numpy()
        have, n = (frequent.field(c).to_numpy(zero_copy_only=False) for c in ("token", "n"))
        have = np.repeat(np.arange(len(size)), size) << 32 | have
        order = np.argsort(have)
        have, n = have[order], n[order]
        for row, token in _pieces(batch.column(4).to_pylist()):
            both = row[:, None] << 32 | token
            at = np.minimum(np.searchsorted(have, both), len(have) - 1)
            often = np.where(have[at] == both, n[at], 1)
            least = np.argsort(often << 32 | token, axis=1)[:, :PREFIX]
            both, often = np.take_along_axis(both, least, axis=1), np.take_along_axis(often, least, axis=1)
            both = np.unique(both[often > 1])
            who = pa.array(both >> 32)
            arrays = [*(batch.column(c).take(who) for c in range(4)), pa.array(both & 0xFFFFFFFF)]
            yield pa.RecordBatch.from_arrays(arrays, ["key", "r", "component", "open", "token"])


def _possible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of (a, b, shift, lo, hi, bytes and known places of both sides) the rows that can add something, with the first and
    last place in a that they can add and how many shingles a piece has in common."""
    for batch in batches:
        for i in range(0, batch.num_rows, COMPARED):
            part = batch.slice(i, COMPARED)
            shift, lo, a_lo, a_hi, b_lo, b_hi = (part.column(c).to_numpy() for c in ("shift", "lo", "a_lo", "a_hi", "b_lo", "b_hi"))
            x, y = part.column("x").to_pylist(), part.column("y").to_pylist()
            p, q, common = may_add(x, y, np.stack([lo, lo - shift]), np.stack([a_lo, b_lo]), np.stack([a_hi, b_hi]))
            arrays = [*(part.column(c) for c in REGION), *(pa.array(v, pa.int64()) for v in (lo + p, lo + q, common))]
            yield pa.RecordBatch.from_arrays(arrays, [*REGION, "p", "q", "common"]).filter(pa.array(common > 0))


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From (a, b, regions, shingles of a, shingles of b): one row for each passage, (a, b, places in a, places in b)."""
    for batch in batches:
        regions = batch.column(2).to_pylist()
        left, right = ([np.frombuffer(t, np.uint64) for t in batch.column(c).to_pylist()] for c in (3, 4))
        out: list[tuple] = []
        for a, b, own, x, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), regions, left, right, strict=True):
            out += [(a, b, p, q, p - shift, q - shift) for p, q, shift in _verify(x, y, own)]
        columns = list(zip(*out, strict=True)) or [()] * 6
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["a", "b", "a_lo", "a_hi", "b_lo", "b_hi"])


def _split(column: pa.Array) -> list[np.ndarray]:
    out = []
    for _, shingle, begin in sequences(*text_bytes(column)):
        out += [shingle[i:j] for i, j in zip(begin, begin[1:], strict=False)]
    return out


def _merged(regions: list[dict]) -> list[tuple[int, int, int]]:
    """Overlapping regions of one displacement as one."""
    out: list[list[int]] = []
    for r in sorted(regions, key=lambda r: (r["shift"], r["lo"])):
        if out and out[-1][2] == r["shift"] and r["lo"] <= out[-1][1] + 1:
            out[-1][1] = max(out[-1][1], r["hi"])
        else:
            out.append([r["lo"], r["hi"], r["shift"]])
    return [tuple(r) for r in out]


def near_pieces(own: np.ndarray, other: np.ndarray, same: np.ndarray, window: int) -> np.ndarray:
    """Whether the pieces of both sides that begin at a place are near; ``same`` tells where both have one shingle."""

    def standing(have: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(have)])
        return total[window:] - total[:-window]

    def enough(common: np.ndarray) -> np.ndarray:
        return 100 * common >= PERCENT * (2 * window - common)

    near = enough(standing(same))
    least = np.minimum(standing(np.isin(own, other)), standing(np.isin(other, own)))
    open_ = np.flatnonzero(enough(least) & ~near)
    value = np.unique(np.concatenate([own, other]), return_inverse=True)[1].reshape(2, -1)
    for i in range(0, len(open_), SORTED):
        at = open_[i : i + SORTED]
        both = np.concatenate([numbered(v[at[:, None] + np.arange(window)]) for v in value], axis=1)
        both.sort(axis=1)
        near[at] = enough((both[:, 1:] == both[:, :-1]).sum(axis=1))
    return near


def passages(x: np.ndarray, y: np.ndarray, lo: int, hi: int, shift: int, window: int = WINDOW) -> list[tuple[int, int]]:
    """Runs of places lo..hi of x (ends included) whose pieces are near-duplicates of y's pieces ``shift`` before. Pieces
    of equal length w that have c places in common have the similarity c / (2 w - c)."""
    lo, hi = max(lo, 0, shift), min(hi, len(x) - 1, len(y) - 1 + shift)
    if hi - lo + 1 < window:
        return []
    own, other = x[lo : hi + 1], y[lo - shift : hi + 1 - shift]
    same = own == other
    if same.all():
        return [(lo, hi)]
    starts = np.flatnonzero(near_pieces(own, other, same, window))
    if not len(starts):
        return []
    runs = np.split(starts, np.flatnonzero(np.diff(starts) > 1) + 1)
    return [(lo + int(r[0]), lo + int(r[-1]) + window - 1) for r in runs]


def _verify(x: np.ndarray, y: np.ndarray, regions: list[dict]) -> list[tuple[int, int, int]]:
    """(first, last, shift) of the passages in all regions, each with WINDOW places more at both ends. The longest region goes
    first; one that lies in a passage already, in both texts, can add nothing."""
    out: list[tuple[int, int, int]] = []
    wider = [{"lo": r["lo"] - WINDOW, "hi": r["hi"] + WINDOW, "shift": r["shift"]} for r in regions]
    for lo, hi, shift in sorted(_merged(wider), key=lambda r: r[0] - r[1]):
        lo, hi = max(lo, 0, shift), min(hi, len(x) - 1, len(y) - 1 + shift)
        known = any(p <= lo and hi <= q for p, q, _ in out) and any(p - s <= lo - shift and hi - shift <= q - s for p, q, s in out)
        if not known:
            out += [(p, q, shift) for p, q in passages(x, y, lo, hi, shift)]
    return out


def repeated_passages(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Passages of at least 50 words that occur nearly the same in another document: (spans, links).

    spans: (id, lo, hi), the passages of each document that have one, by the places of their first and last shingle,
    united where they overlap. links: (a, b) with a > b, the pairs that were verified. Rows with a null id or text are
    left out; rows that share an id are one document whose first text counts. Texts of fewer words have no passage.
    Other columns are ignored; an empty table gives empty results."""
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.where("id is not null and text is not null")
    spark = df.sparkSession
    repeated = stored(rows.groupBy("id").count().where("count > 1").select("id"), "passages-repeated")
    if not repeated.isEmpty():
        several = rows.join(small(repeated), "id", "left_semi").groupBy("id").agg(F.min("text").alias("text"))
        rows = rows.join(small(repeated), "id", "left_anti").unionByName(several)
    windows = arrow_map(rows, _windows, "id long, key long, left long, node long, right long, same long")
    shared = arrow_map(rows, _keys, "id long, key long").groupBy("key").agg(F.min("id").alias("x"), F.max("id").alias("y")).where("x < y")
    member = stored(windows.join(shared.select("key"), "key"), "passages-windows")
    release(spark)

    # windows of equal content: exact repeats if they are in several documents
    classes = member.groupBy("key", "same").agg(F.min(F.struct("id", "left", "node", "right")).alias("r"), F.max("id").alias("y"))
    classes = stored(classes.select("key", "same", "r.*", (F.col("y") > F.col("r.id")).alias("several")), "passages-classes")
    release(spark)  # the shuffle of all windows, if the first call came before Spark let go of it
    copies = member.join(classes.where("several").select("key", "same", F.col("id").alias("hub")), ["key", "same"])
    spans = stored(_united(copies.select("id", F.col("left").alias("lo"), F.col("right").alias("hi"))), "passages-copies")
    links = copies.where("id <> hub").select(F.col("id").alias("a"), F.col("hub").alias("b")).distinct()
    links = stored(links, "passages-copy-links")
    # other windows of the one document of a class, for what is found for the first
    alike = classes.where("not several").select("key", "same", F.col("id").alias("d"), F.col("left").alias("from"), "right")
    alike = member.select("key", "same", "id", "left").join(alike, ["key", "same"]).where("left <> from")
    alike = stored(alike.select("id", "from", "right", (F.col("left") - F.col("from")).alias("by")).distinct(), "passages-alike")
    discard(member)

    order = Window.partitionBy("key").orderBy("id", "left", "node", "same")
    ranked = classes.withColumn("r", F.row_number().over(order))
    groups = ranked.groupBy("key").agg(F.max("r").alias("m")).where("m > 1").select("key", "m")
    grouped = stored(ranked.join(groups, "key"), "passages-grouped")
    discard(classes)
    largest = grouped.agg(F.max("m")).first()[0] or 0
    nodes = small(grouped.select("id").distinct())
    texts = arrow_map(rows.join(nodes, "id", "left_semi"), _sequences, "id long, marks binary, shingles binary")
    texts = stored(texts, "passages-texts")
    marks = F.expr("substring(marks, int(2 * left + 1), int(2 * (right - left + 1)))")
    ranked = stored(grouped.join(texts.select("id", "marks"), "id").withColumn("marks", marks), "passages-ranked")
    discard(grouped)
    release(spark)

    own = texts.select("id", "shingles")
    tried, waiting, before, hubs = None, None, 0, 1
    while before < largest - 1 or waiting is not None:
        labels = stored(components(links).withColumnRenamed("node", "id"), "passages-labels")
        whole = before >= largest - 1  # all classes have met: one pass takes what is left
        if not whole:
            fresh = _laid(ranked.where(F.col("m") > before + 1), spans, labels, before, hubs)
            waiting = fresh if waiting is None else waiting.unionByName(fresh)
            before, hubs = (hubs, 8 * hubs) if hubs <= HUBS else (largest, hubs)
        still = _open(waiting, tried, spans, labels)
        still = stored(still, "passages-open")
        left = still.count()
        whole = whole or left <= ONE_TASK
        chosen = still.select(*REGION) if whole else stored(_likeliest(still), "passages-chosen")
        waiting = None if whole else still.select(*REGION, "p", "q", "common").join(chosen, REGION, "left_anti")
        if left:
            tried = chosen if tried is None else tried.unionByName(chosen)
            pairs = chosen.groupBy("a", "b").agg(F.collect_list(F.struct("lo", "hi", "shift")).alias("regions"))
            one = own.join(small(pairs, F.size("regions")), F.col("id") == F.col("a")).select("a", "b", "regions", F.col("shingles").alias("x"))
            two = one.join(own, F.col("id") == F.col("b")).select("a", "b", "regions", "x", "shingles")
            new = stored(arrow_map(two, _verified, "a long, b long, a_lo long, a_hi long, b_lo long, b_hi long"), "passages-found")
            found = _both_sides(new)
            same = found.join(alike, "id").select(
                "id", (F.greatest("lo", "from") + F.col("by")).alias("lo"), (F.least("hi", "right") + F.col("by")).alias("hi")
            )
            found = found.unionByName(same.where(F.col("hi") - F.col("lo") + 1 >= WINDOW))
            old, spans = spans, stored(_united(spans.unionByName(found)), "passages-spans")
            discard(old)
            old, links = links, stored(links.unionByName(new.where("a <> b").select("a", "b")).distinct(), "passages-links")
            discard(old)
            discard(new)
        discard(labels)
        release(spark)
    discard(texts)
    discard(ranked)
    return spans, links


def _laid(ranked: DataFrame, spans: DataFrame, labels: DataFrame, before: int, hubs: int) -> DataFrame:
    """(a, b, shift, lo, hi, p, q, common): the overlaps of the classes with those of ranks ``before`` + 1 to ``hubs``, or with
    all of higher ranks if ``hubs`` is more than HUBS, that can add something, see ``_possible``."""
    # each class with its document's component and the span that covers most of it
    part = F.least("hi", "right") - F.greatest("lo", "left") + 1
    most = ranked.select("key", "same", "id", "left", "right").join(spans, "id").where(part > 0).groupBy("key", "same")
    most = most.agg(F.max_by(F.struct("lo", "hi"), part).alias("c"))
    now = ranked.join(most, ["key", "same"], "left").join(labels, "id", "left")
    side = F.struct("id", "left", "node", "right", "several", "c", F.coalesce("component", "id").alias("component"), "marks")
    now = stored(now.select("key", "r", "m", side.alias("d")), "passages-now")
    pairs = _all_hubs(now, before, hubs) if hubs <= HUBS else _sharing(now.where(F.col("r") > before))
    # ids are in order, so d has the larger one
    laid = pairs.select("d", "h", (F.col("d.node") - F.col("h.node")).alias("shift")).where(
        "d.id <> h.id or (shift <> 0 and d.several <> h.several)"
    )
    lo = F.greatest("d.left", F.col("h.left") + F.col("shift"))
    hi = F.least("d.right", F.col("h.right") + F.col("shift"))
    laid = laid.withColumn("lo", lo).withColumn("hi", hi).where(F.col("hi") - F.col("lo") + 1 >= WINDOW)
    covered = "d.c.lo <= lo and hi <= d.c.hi and h.c.lo <= lo - shift and hi - shift <= h.c.hi"
    laid = laid.where(f"d.component <> h.component or not coalesce({covered}, false)")
    # what two documents of one component have already; of two components nothing
    known = (("d.c.lo", "a_lo", 1), ("d.c.hi", "a_hi", 0), ("h.c.lo", "b_lo", 1), ("h.c.hi", "b_hi", 0))
    laid = laid.select(
        F.col("d.id").alias("a"), F.col("h.id").alias("b"), "shift", "lo", "hi",
        F.expr("substring(d.marks, int(2 * (lo - d.left) + 1), int(2 * (hi - lo + 1)))").alias("x"),
        F.expr("substring(h.marks, int(2 * (lo - shift - h.left) + 1), int(2 * (hi - lo + 1)))").alias("y"),
        *[F.coalesce(F.when(F.expr("d.component = h.component"), F.col(c)), F.lit(none)).cast("long").alias(e) for c, e, none in known],
    )
    schema = ", ".join(f"{c} long" for c in (*REGION, "p", "q", "common"))
    out = stored(_once(arrow_map(laid, _possible, schema)), "passages-regions")
    discard(now)
    return out


def _all_hubs(now: DataFrame, before: int, hubs: int) -> DataFrame:
    """(d, h): each class with those of its group of ranks ``before`` + 1 to ``hubs`` and below its own."""
    # every slice of a group meets all hubs
    slices = F.explode(F.sequence(F.lit(0), F.floor(F.col("m") / SLICE).cast("int")))
    hub = now.where((F.col("r") > before) & (F.col("r") <= hubs))
    hub = hub.select("key", slices.alias("slice"), F.col("r").alias("hub_r"), F.col("d").alias("h"))
    laid = now.where(F.col("r") > before + 1).withColumn("slice", F.floor(F.col("r") / SLICE).cast("int"))
    return laid.join(hub, ["key", "slice"]).where("r > hub_r").select("d", "h")


def _sharing(now: DataFrame) -> DataFrame:
    """(d, h): the classes of a group that share a token of their prefixes, unless they have one component and passages cover
    both."""
    tokens = stored(arrow_map(now.select("key", "r", "d.marks"), _tokens, "key long, r int, token long"), "passages-tokens")
    counts = tokens.groupBy("key", "token").agg(F.count("*").alias("n")).where("n > 1")
    listed = tokens.join(counts, ["key", "token"]).groupBy("key", "r").agg(F.collect_list(F.struct("token", "n")).alias("frequent"))
    covered = F.coalesce(F.expr("d.c.lo <= d.left and d.right <= d.c.hi"), F.lit(False))
    some = now.select("key", "r", "d.component", (~covered).alias("open"), "d.marks").join(listed, ["key", "r"])
    schema = "key long, r int, component long, open boolean, token long"
    rare = stored(arrow_map(some, _rarest, schema), "passages-rare")
    other = rare.select("key", "token", F.col("r").alias("hub_r"), F.col("component").alias("hub_component"), F.col("open").alias("hub_open"))
    met = rare.join(other, ["key", "token"]).where("r > hub_r and (open or hub_open or component <> hub_component)")
    met = stored(met.select("key", "r", "hub_r").distinct(), "passages-met")
    discard(tokens)
    discard(rare)
    hub = now.select("key", F.col("r").alias("hub_r"), F.col("d").alias("h"))
    return met.join(now.select("key", "r", "d"), ["key", "r"]).join(hub, ["key", "hub_r"]).select("d", "h")


def _once(regions: DataFrame) -> DataFrame:
    return regions.groupBy(*REGION).agg(F.min("p").alias("p"), F.max("q").alias("q"), F.max("common").alias("common"))


def _open(waiting: DataFrame, tried: DataFrame | None, spans: DataFrame, labels: DataFrame) -> DataFrame:
    """The overlaps that can still add something: they were not tried, and either their documents are in two components (u, v)
    or a passage of a (in_a) or b (in_b) does not hold all that they could add."""
    out = _once(waiting)
    if tried is not None:
        out = out.join(tried, REGION, "left_anti")
    for side, number, at in (("a", "u", F.lit(0)), ("b", "v", F.col("shift"))):
        label = labels.select(F.col("id").alias(side), F.col("component").alias(number))
        out = out.join(label, side, "left").withColumn(number, F.coalesce(number, side))
        holds = spans.select(F.col("id").alias("_id"), F.col("lo").alias("_lo"), F.col("hi").alias("_hi"))
        within = (F.col(side) == F.col("_id")) & (F.col("_lo") <= F.col("p") - at) & (F.col("q") - at <= F.col("_hi"))
        out = out.join(holds, within, "left").withColumn(f"in_{side}", F.col("_id").isNotNull()).drop("_id", "_lo", "_hi")
    return out.where("u <> v or not (in_a and in_b)")


def _likeliest(still: DataFrame) -> DataFrame:
    """Of the overlaps that would join the same two components, or add the same place to a document, the one with most shingles
    in common."""
    aims = F.array(
        F.when(F.expr("u <> v"), F.struct(F.lit(0).alias("kind"), F.least("u", "v").alias("i"), F.greatest("u", "v").alias("j"))),
        F.when(~F.col("in_a"), F.struct(F.lit(1).alias("kind"), F.col("a").alias("i"), F.floor(F.col("p") / WINDOW).alias("j"))),
        F.when(~F.col("in_b"), F.struct(F.lit(1).alias("kind"), F.col("b").alias("i"), F.floor((F.col("p") - F.col("shift")) / WINDOW).alias("j"))),
    )
    aimed = still.select(*REGION, "common", F.explode(F.array_compact(aims)).alias("aim"))
    return aimed.groupBy("aim").agg(F.max(F.struct("common", *REGION)).alias("r")).select(*[f"r.{c}" for c in REGION]).distinct()


def _both_sides(found: DataFrame) -> DataFrame:
    """(id, lo, hi) of the passages of both documents of each pair."""
    a = found.select(F.col("a").alias("id"), F.col("a_lo").alias("lo"), F.col("a_hi").alias("hi"))
    return a.unionByName(found.select(F.col("b").alias("id"), F.col("b_lo").alias("lo"), F.col("b_hi").alias("hi"))).distinct()


def _united(spans: DataFrame) -> DataFrame:
    """Spans of one document, united where they overlap or touch; a document's different spans are first made distinct."""
    distinct = spans.distinct()
    ordered = F.array_sort(F.collect_list(F.struct("lo", "hi")))
    step = """aggregate(s, cast(array() as array<struct<lo:bigint,hi:bigint>>), (r, x) ->
        if(size(r) > 0 and x.lo <= element_at(r, -1).hi + 1,
           concat(slice(r, 1, size(r) - 1), array(named_struct('lo', element_at(r, -1).lo, 'hi', greatest(element_at(r, -1).hi, x.hi)))),
           concat(r, array(x))))"""
    return distinct.groupBy("id").agg(ordered.alias("s")).select("id", F.explode(F.expr(step)).alias("r")).select("id", "r.lo", "r.hi")


def passage_classes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_passages, n_links, component_id, spans), one row for each row of ``df``: the document's repeated
    passages as first:last shingle, how many other documents it was verified with, and the smallest id reachable
    over such links (its own without one)."""
    spans, links = repeated_passages(df, id_col, text_col)
    links = stored(links, "passages-links")
    labels = components(links).withColumnRenamed("node", "id")
    both = links.select(F.col("a").alias("id")).unionByName(links.select(F.col("b").alias("id")))
    degree = both.groupBy("id").agg(F.count("*").alias("n_links"))
    text = F.transform(F.array_sort(F.collect_list(F.struct("lo", "hi"))), lambda s: F.concat_ws(":", s["lo"], s["hi"]))
    listed = spans.groupBy("id").agg(F.count("*").alias("n_passages"), F.array_join(text, ",").alias("spans"))
    out = df.select(F.col(id_col).cast("long").alias("id"))
    out = out.join(listed, "id", "left").join(degree, "id", "left").join(labels, "id", "left")
    zero = F.lit(0).cast("long")
    return out.select(
        F.col("id").alias(id_col), F.coalesce("n_passages", zero).alias("n_passages"), F.coalesce("n_links", zero).alias("n_links"),
        F.coalesce("component", "id").alias("component_id"), F.coalesce("spans", F.lit("")).alias("spans"),
    )
