"""Near-duplicate documents by min-max hashing, confirmed on full shingle sets, grouped by connected components.

Each document's set of word shingles gets PERMUTATIONS hash permutations, and of each both the smallest and the largest
value are kept, so one evaluation gives two nearly independent signature values. A band takes both values of
``ROWS`` permutations. At a similarity of 0.8 a pair shares none of the ``BANDS`` bands with a probability below
1e-5 (3e-7 for large sets), and every shared band makes it a candidate; nothing else is dropped.

Documents with equal sets form a class first and one of them stands for it. Inside a bucket (the documents that share a
band) not all pairs are made. The weight of a document is the size of its buckets, summed; the original of many copies
is the heaviest, because the copies share more bands with it than with each other. First each document is held against
the heaviest document of its buckets, then each bucket whose documents are in several components against its heaviest
one, then against its 8, 64, ... heaviest ones, always leaving out pairs that are in one component already, were judged,
or cannot be similar enough by what each has in common with the same hub. This goes on until no pair is left, so every link between components is found, while a bucket of thousands of
copies costs one pair for each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.llm.common import arrow_map, checkpointed, chunks, components, constants, discard, mix, release, shingles, small, stored, text_bytes, words

BANDS = 50
ROWS = 3
PERMUTATIONS = BANDS * ROWS
#: So many shingles beyond a hub are listed for the bounds; with more the bounds are wider, nothing else changes.
BEYOND = 128

_FACTOR = constants(23, PERMUTATIONS)[:, None]
_SHIFT = constants(29, PERMUTATIONS)[:, None]
_MIN_TERM = constants(31, ROWS)
_MAX_TERM = constants(37, ROWS)
_BAND = constants(41, BANDS)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> Iterator[np.ndarray]:
    """The sorted set of shingle hashes of each text; a text of fewer words has one shingle, one without words none."""
    for lo, hi in chunks(offsets):
        own = offsets[lo : hi + 1] - offsets[lo]
        word, doc, _, _ = words(data[offsets[lo] : offsets[hi]], own)
        first = np.searchsorted(doc, np.arange(hi - lo + 1))
        shingle, at = shingles(word, doc, size)
        begin = np.searchsorted(at, first)
        for k in range(hi - lo):
            here = shingle[begin[k] : begin[k + 1]]
            if not len(here) and first[k + 1] > first[k]:
                short = word[first[k] : first[k + 1]]
                here = mix(np.cumsum(short * constants(43, len(short)))[-1:] + np.uint64(len(short)))
            yield np.unique(here)


def signature(own: np.ndarray) -> np.ndarray:
    """A hash for each band."""
    low = np.full(PERMUTATIONS, np.iinfo(np.uint64).max, np.uint64)
    high = np.zeros(PERMUTATIONS, np.uint64)
    for i in range(0, len(own), 2048):
        value = own[None, i : i + 2048] * _FACTOR + _SHIFT
        np.minimum(low, value.min(axis=1), out=low)
        np.maximum(high, value.max(axis=1), out=high)
    low, high = low.reshape(BANDS, ROWS), high.reshape(BANDS, ROWS)
    return mix((mix(low * _MIN_TERM) + mix(high * _MAX_TERM)).sum(axis=1, dtype=np.uint64) + _BAND)


def _sketch(df: DataFrame, size: int) -> DataFrame:
    """(id, n, hi, lo, bands): set size, a 128-bit hash of the set, band hashes (none for an empty set)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, hi, lo, bands = [], [], [], []
            for own in shingle_sets(*text_bytes(batch.column(1)), size):
                n.append(len(own))
                hi.append(mix(own * _FACTOR[0, 0]).sum(dtype=np.uint64).astype(np.int64))
                lo.append(mix(own ^ _FACTOR[1, 0]).sum(dtype=np.uint64).astype(np.int64))
                bands.append(signature(own).view(np.int64) if len(own) else np.zeros(0, np.int64))
            flat = np.concatenate(bands) if bands else np.zeros(0, np.int64)
            ends = np.cumsum([0, *map(len, bands)]).astype(np.int32)
            arrays = [batch.column(0), *(pa.array(x, pa.int64()) for x in (n, hi, lo))]
            arrays.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)))
            yield pa.RecordBatch.from_arrays(arrays, ["id", "n", "hi", "lo", "bands"])

    return arrow_map(df, run, "id long, n long, hi long, lo long, bands array<long>")


def _beyond(own: np.ndarray, other: np.ndarray) -> np.ndarray | None:
    """The shingles of one set that the other lacks, as 32-bit hashes; None for more than BEYOND or where two are equal."""
    rest = np.setdiff1d(own, other, assume_unique=True)
    if len(rest) > BEYOND:
        return None
    short = np.unique((rest >> np.uint64(32)).astype(np.uint32).view(np.int32))
    return short if len(short) == len(rest) else None


def _judge(pairs: DataFrame, texts: DataFrame, size: int, percent: int, beyond: bool = False) -> DataFrame:
    """(a, b, common, linked[, a_beyond, b_beyond]) of the pairs (a, b): common shingles, whether the sets are similar enough,
    and what each has beyond the other. The texts
    come by two joins on an id, those of no pair left out before they are shuffled; a document that many pairs hold is a
    skewed key of the left side, which Spark splits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left = shingle_sets(*text_bytes(batch.column(2)), size)
            right = shingle_sets(*text_bytes(batch.column(3)), size)
            common, linked, more = [], [], ([], [])
            for x, y in zip(left, right, strict=True):
                if beyond:  # y is the text of a
                    more[0].append(_beyond(y, x))
                    more[1].append(_beyond(x, y))
                both = len(np.intersect1d(x, y, assume_unique=True))
                common.append(both)
                linked.append(both > 0 and 100 * both >= percent * (len(x) + len(y) - both))
            arrays = [*batch.columns[:2], pa.array(common, pa.int64()), pa.array(linked, pa.bool_())]
            if beyond:
                arrays += [pa.array(m, pa.list_(pa.int32())) for m in more]
            yield pa.RecordBatch.from_arrays(arrays, names)

    one = texts.join(small(pairs), F.col("id") == F.col("b")).select("a", "b", F.col("text").alias("t"))
    needed = small(pairs.select(F.col("a").alias("id")).distinct())
    two = one.join(texts.join(needed, "id", "left_semi"), F.col("id") == F.col("a")).select("a", "b", "t", "text")
    names = ["a", "b", "common", "linked"] + ["a_beyond", "b_beyond"] * beyond
    every = arrow_map(two, run, "a long, b long, common long, linked boolean" + ", a_beyond array<int>, b_beyond array<int>" * beyond)
    return every.groupBy("a", "b").agg(F.max("common").alias("common"), F.max("linked").alias("linked"), *[F.first(c).alias(c) for c in names[4:]])


def _possible(x: Column, y: Column, percent: int) -> Column:
    """Whether two documents of different components can be similar enough, by exact bounds: their sizes, and if they
    were held against the same hub, what they have in common with it. Shingles they share are in the hub (no more than
    either has there) or outside of it: those both have there, or where these are not listed no more than either has."""
    sizes = 100 * F.least(x["n"], y["n"]) >= percent * F.greatest(x["n"], y["n"])
    listed = x["out"].isNotNull() & y["out"].isNotNull()
    beyond = F.when(listed, F.size(F.array_intersect(x["out"], y["out"]))).otherwise(F.least(x["n"] - x["o"], y["n"] - y["o"]))
    common = F.least(x["o"], y["o"]) + beyond
    bound = 100 * common >= percent * (x["n"] + y["n"] - common)
    return (x["c"] != y["c"]) & sizes & F.coalesce((x["hub"] != y["hub"]) | bound, F.lit(True))


def near_duplicates(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words_in_shingle: int = 5, percent: int = 80
) -> DataFrame:
    """(id_col, n_shingles, component_id, kept), one row for each row of ``df``.

    Two documents are linked if 100 * common shingles >= percent * all shingles of both. ``component_id`` is the
    smallest id reachable over links, ``kept`` says whether it is the own one. A null text, an empty one and one
    without words has no shingles and no links. Ids are whole numbers; rows that share an id are
    judged each by its own text, and where such an id stands for a group it joins the groups of its texts. A row with
    a null id is not linked and has a null component. Other columns are ignored; an empty table gives an empty
    result."""
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    sketch = stored(_sketch(rows, words_in_shingle), "near-dup-sketch")
    # equal sets: one document for the class
    classes = sketch.where("n > 0 and id is not null").groupBy("n", "hi", "lo")
    classes = stored(classes.agg(F.min("id").alias("node"), F.min_by("bands", "id").alias("bands")), "near-dup-classes")
    member = classes.select("node", "n", F.explode("bands").alias("band"))
    shared = member.groupBy("band").agg(F.min("node").alias("x"), F.max("node").alias("y"), F.count("*").alias("m"))
    buckets = stored(member.join(shared.where("x < y").select("band", "m"), "band"), "near-dup-buckets")
    weight = buckets.groupBy("node").agg(F.sum("m").alias("weight"))
    member = stored(buckets.join(weight, "node").select("band", "node", "n", "weight"), "near-dup-members")
    discard(buckets)
    nodes = small(member.select(F.col("node").alias("id")).distinct())
    texts = stored(rows.join(nodes, "id", "left_semi"), "near-dup-texts")

    place = F.struct("weight", -F.col("node"))  # the heaviest, of equal ones the smallest id
    hub = member.groupBy("band").agg(F.max(place).alias("h"))
    first = member.join(hub, "band").where(F.col("node") != -F.col("h.col2")).groupBy("node").agg(F.max("h").alias("h"))
    first = checkpointed(first.select("node", (-F.col("h.col2")).alias("hub")))
    pairs = checkpointed(first.select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct())
    judged, links, labels, hubs = pairs, None, None, 0
    while True:
        if not pairs.isEmpty():
            result = checkpointed(_judge(pairs, texts, words_in_shingle, percent, beyond=hubs == 0))
            linked = result.where("linked").select("a", "b")
            links = linked if links is None else links.unionByName(linked)
            if hubs == 0 or not linked.isEmpty():
                labels = checkpointed(components(links))
        if labels is None:
            break
        if hubs == 0:
            # what each document has in common with its hub; not for an id with several texts
            single = classes.groupBy("node").count().where("count = 1").select("node")
            same = (F.col("a") == F.least("node", "hub")) & (F.col("b") == F.greatest("node", "hub"))
            out = F.when(F.col("node") == F.col("a"), F.col("a_beyond")).otherwise(F.col("b_beyond"))
            base = checkpointed(first.join(result, same).join(single, "node").select("node", "hub", F.col("common").alias("o"), out.alias("out")))
        # buckets whose documents are in several components
        here = member.join(labels, "node", "left").withColumn("c", F.coalesce("component", "node"))
        several = here.groupBy("band").agg(F.min("c").alias("x"), F.max("c").alias("y"), F.count("*").alias("m")).where("x < y")
        here = here.join(several.select("band", "m"), "band").join(base, "node", "left")
        largest = several.agg(F.max("m")).first()[0] or 0
        if hubs and hubs >= largest:
            break
        before, hubs = hubs, min(8 * hubs, hubs + 512) or 1
        ranked = here.withColumn("r", F.row_number().over(Window.partitionBy("band").orderBy(F.desc("weight"), "node", "n")))
        ranked = ranked.select("band", "r", F.struct("node", "c", "n", "hub", "o", "out").alias("d"))
        new = ranked.where((F.col("r") > before) & (F.col("r") <= hubs)).groupBy("band").agg(F.collect_list("d").alias("hubs"))
        # the possible hubs of a document's buckets, each once; what is impossible goes before the shuffle
        able = F.transform(F.filter("hubs", lambda h: _possible(F.col("d"), h, percent)), lambda h: h["node"])
        met = ranked.join(new, "band").select(F.col("d.node").alias("node"), able.alias("hubs")).where(F.size("hubs") > 0)
        met = met.groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("hubs"))).alias("hubs"))
        met = met.select("node", F.explode("hubs").alias("h"))
        fresh = met.select(F.least("node", "h").alias("a"), F.greatest("node", "h").alias("b")).distinct()
        pairs = checkpointed(fresh.join(judged, ["a", "b"], "left_anti"))
        judged = judged.unionByName(pairs)
        release(df.sparkSession)
    discard(member)
    discard(texts)
    of_class = classes.select("n", "hi", "lo", "node")
    out = sketch.join(of_class, ["n", "hi", "lo"], "left").select("id", "n", F.coalesce("node", "id").alias("node"))
    if labels is not None:
        out = out.join(labels, "node", "left").withColumn("node", F.coalesce("component", "node"))
    out = out.withColumn("node", F.when(F.col("id").isNotNull(), F.col("node")))
    return out.select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.col("node").alias("component_id"),
        F.coalesce(F.col("id") == F.col("node"), F.lit(True)).alias("kept"),
    )
