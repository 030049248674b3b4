"""Language-model scores from a log-frequency Bloom filter of word pairs.

A pair that occurs n times is entered once for each of the levels 1 ... q whose least count (``LEVELS``) n reaches. A
pair's count is read back by probing level after level until one is missing; the last one found gives a lower bound of
the count, so that the pairs of a context never promise more than the context has. A filter may find what was never
entered, therefore a pair counts no more than either of its words. Probabilities are smoothed with the exact ones of single words:
p(w | v) = (n(v, w) + MASS * p(w)) / (n(v) + MASS).

The filter is of fixed size, whatever the corpus, and is broadcast. It is built by segments of the hash range, each in
one task; its finished bits are stored and pass the driver file by file, not all at once. When all pairs would fill one filter beyond ``ENTRY_BITS`` bits an
entry, pairs are dealt by hash over as many filters as needed; each is broadcast in its turn and scores the tokens whose
pair it holds, so no pair is left out at any size.

Exact counts of single words are never broadcast: a task replaces the words of a block of documents by numbers, and
the block's dictionary is joined with the counts and comes back to the block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quayside.llm.common import BLOCK_BYTES, arrow_map, blocks, chunks, constants, discard, from_planes, mix, planes, release, ship, stored, text_bytes, with_id, words

#: Bits of a filter (64 MB), always all of them.
FILTER_BITS = 1 << 29
#: Bits for each entry at least; with four probes 6 % of the questions to a full filter find what was not entered.
ENTRY_BITS = 6
PROBES = 4
#: Probes of one entry stay within so many bits.
BLOCK_BITS = 512
SEGMENTS = 256
#: Pairs with a hash divisible by this are counted first, to know how many filters are needed.
SAMPLE = 1024
#: Weight of the single-word probability, in counts.
MASS = 8.0
ALPHA = 0.1
#: Documents of a block that are scored together.
SCORED = 512


def _levels() -> np.ndarray:
    """Least counts of the levels: each half as large again, at least by one."""
    out = [1]
    while out[-1] < 1 << 50:
        out.append(max(out[-1] + 1, out[-1] * 3 // 2))
    return np.array(out, np.int64)


LEVELS = _levels()
_C = constants(31, len(LEVELS) + 4)
#: Stands for the end of a text, which is also the context of its first word.
END = _C[0]
_SIX = np.uint64((1 << 48) - 1)


def pair_hash(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    return mix(mix(before + _C[1]) ^ (word * _C[2]))


def places(h: np.ndarray, level: int, bits: int) -> Iterator[np.ndarray]:
    """The bits of an entry in a segment of ``bits``, all within one block of the pair."""
    h = h & _SIX
    base = (mix(h + _C[3]) % np.uint64(max(1, bits // BLOCK_BITS))).astype(np.int64) * min(bits, BLOCK_BITS)
    inner = mix(h ^ _C[3 + level])
    for k in range(PROBES):
        yield base + ((inner >> np.uint64(12 * k)) % np.uint64(min(bits, BLOCK_BITS))).astype(np.int64)


def segment_of(h: np.ndarray, segments: int) -> np.ndarray:
    return ((h >> np.uint64(32)) * np.uint64(segments) >> np.uint64(32)).astype(np.int64)


def _tokens(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts and the number of words of each."""
    data, offsets = text_bytes(column)
    hashes, sizes = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for lo, hi in chunks(offsets):
        h, doc, _, _ = words(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
        hashes.append(h)
        sizes.append(np.bincount(doc, minlength=hi - lo))
    return np.concatenate(hashes), np.concatenate(sizes)


def _ended(values: np.ndarray, size: np.ndarray, end) -> tuple[np.ndarray, np.ndarray]:
    """The values with an end after each text, and where each text starts."""
    start = np.concatenate([[0], np.cumsum(size + 1)])
    out = np.empty(start[-1], values.dtype)
    word = np.ones(start[-1], bool)
    word[start[1:] - 1] = False
    out[word], out[~word] = values, end
    return out, start[:-1]


def _training_pairs(rows: pa.Table) -> np.ndarray:
    """Hashes of the pairs in the training texts of a block."""
    h, size = _tokens(rows.column(1).filter(rows.column(2)))
    tok, _ = _ended(h, size, END)
    return pair_hash(np.concatenate([[END], tok[:-1]]), tok) if len(tok) else tok


def _sampled(docs: DataFrame, block_bytes: int) -> DataFrame:
    """(hash, n) of the pairs whose hash SAMPLE divides."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in blocks(batches, block_bytes):
            pair = _training_pairs(rows)
            h, n = np.unique(pair[pair % np.uint64(SAMPLE) == 0], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n, pa.int64())], ["hash", "n"])

    return arrow_map(docs, run, "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n"))


def _pairs(docs: DataFrame, segments: int, block_bytes: int) -> DataFrame:
    """(segment, hashes, counts): the pairs of a block that lie in a segment, six bytes for a hash, four for its count."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in blocks(batches, block_bytes):
            h, n = np.unique(_training_pairs(rows), return_counts=True)
            if not len(h):
                continue
            some, first = np.unique(segment_of(h, segments), return_index=True)
            six = h.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]
            n = n.astype("<u4")
            ends = [*first[1:].tolist(), len(h)]
            runs = list(zip(first.tolist(), ends, strict=True))
            arrays = [pa.array([x[lo:hi].tobytes() for lo, hi in runs], pa.binary()) for x in (six, n)]
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), *arrays], ["segment", "hashes", "counts"])

    return arrow_map(docs, run, "segment int, hashes binary, counts binary")


def _filter(pairs: DataFrame, bits: int) -> DataFrame:
    """(segment, bits): pairs are dealt by segment; a segment's counts are summed and entered, one segment after the other."""

    def entered(segment: int, hashes: list[bytes], counts: list[bytes]) -> pa.RecordBatch:
        six = np.frombuffer(b"".join(hashes), np.uint8).reshape(-1, 6)
        eight = np.zeros((len(six), 8), np.uint8)
        eight[:, :6] = six
        h, at = np.unique(eight.view("<u8").ravel(), return_inverse=True)
        n = np.bincount(at, np.frombuffer(b"".join(counts), "<u4")).astype(np.int64)
        level, out = np.searchsorted(LEVELS, n, "right"), np.zeros(bits // 8, np.uint8)
        for q in range(1, int(level.max()) + 1):
            for place in places(h[level >= q], q, bits):
                np.bitwise_or.at(out, place >> 3, np.left_shift(1, place & 7).astype(np.uint8))
        return pa.RecordBatch.from_arrays([pa.array([segment], pa.int32()), pa.array([out.tobytes()], pa.binary())], ["segment", "bits"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, hashes, counts = None, [], []
        for batch in batches:
            for segment, h, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if segment != now and hashes:
                    yield entered(now, hashes, counts)
                    hashes, counts = [], []
                now = segment
                hashes.append(h)
                counts.append(n)
        if hashes:
            yield entered(now, hashes, counts)

    return arrow_map(pairs.repartition("segment").sortWithinPartitions("segment"), run, "segment int, bits binary")


def counts_of(bits: np.ndarray, h: np.ndarray, first: int, segments: int, segment_bits: int) -> np.ndarray:
    """Lower bounds of the pairs' counts, by probing levels until one is missing; -1 for pairs of another filter."""
    segment = segment_of(h, segments) - first
    out = np.where((segment >= 0) & (segment < len(bits) * 8 // segment_bits), 0, -1)
    for lo in range(0, len(h), 1 << 20):
        at = lo + np.flatnonzero(out[lo : lo + (1 << 20)] == 0)
        for q in range(1, len(LEVELS) + 1):
            found = np.ones(len(at), bool)
            for place in places(h[at], q, segment_bits):
                place += segment[at] * segment_bits
                found &= (bits[place >> 3] >> (place & 7).astype(np.uint8) & 1).astype(bool)
            at = at[found]
            if not len(at):
                break
            out[at] = LEVELS[q - 1]
    return out


def _blocks(docs: DataFrame, block_bytes: int) -> DataFrame:
    """Rows of two kinds: "text" (block, id, train, size, low, high: the numbers of its words), and "word", one of a block's
    dictionary (block, code, hash, n in training texts)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, rows in blocks(batches, block_bytes):
            h, size = _tokens(rows.column(1))
            word, code, n = np.unique(h, return_inverse=True, return_counts=True)
            rank = np.empty(len(word), np.int64)
            rank[np.argsort(-n, kind="stable")] = np.arange(len(word))  # frequent words have small numbers
            train = rows.column(2).to_numpy()
            seen = np.bincount(code[np.repeat(train, size)], minlength=len(word))
            some = rows.num_rows
            number = pa.array(np.full(some, block), pa.int64())
            nothing = [pa.nulls(some, t) for t in (pa.int32(), pa.int64(), pa.int64())]
            own = [rows.column(0).combine_chunks(), rows.column(2).combine_chunks(), pa.array(size, pa.int64()), *planes(rank[code], size)]
            yield pa.RecordBatch.from_arrays([pa.array(["text"] * some), number, *own, *nothing], names)
            some = len(word)
            nothing = [pa.nulls(some, t.type) for t in own]
            own = [pa.array(rank, pa.int32()), pa.array(word.view(np.int64)), pa.array(seen, pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array(["word"] * some), pa.array(np.full(some, block), pa.int64()), *nothing, *own], names)

    schema = StructType(
        StructType.fromDDL("kind string, block long").fields + with_id(docs, "train boolean, size long, low binary, high binary, code int, hash long, n long").fields
    )
    names = schema.names
    return arrow_map(docs, run, schema)


def score_texts(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", filter_bits: int = FILTER_BITS, block_bytes: int = BLOCK_BYTES, folds: int = 10
) -> DataFrame:
    """(id_col, held_out, n_tokens, n_known, train_tokens, base_score, score), one row for each row of ``df``.

    Texts whose CRC-32 of the id is divisible by ``folds`` are held out, the others are learned from. Tokens are the
    words, A-Z lower-cased, and one end; ``base_score`` is the sum of log10 of the smoothed single-word probabilities, ``score``
    that of the pair model. A null or empty text has the end as its only token; a null id counts as an empty one; repeated
    rows count again; no rows give no rows; other columns are ignored. Words are told apart by 64-bit hashes."""
    spark = df.sparkSession
    owner = F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")
    docs = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), (F.crc32(owner) % folds != 0).alias("train"))
    parts = stored(_blocks(docs, block_bytes), "scoring-blocks", "kind")
    units = parts.where("kind = 'text'").select("block", "id", "train", "size", "low", "high")
    entries = parts.where("kind = 'word'").select("block", "code", "hash", "n")
    # a word has one row in each block
    word = Window.partitionBy("hash")
    counted = entries.select("block", "code", "hash", F.sum("n").over(word).alias("c"), (F.row_number().over(word.orderBy("block")) == 1).alias("first"))
    dictionary = stored(counted, "scoring-dictionary")
    seen = dictionary.where("first and c > 0").agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    ends = units.where("train").count()
    total, distinct = seen[0] + ends, seen[1] + (ends > 0)
    discard(parts, "kind=word")

    level = sum(F.when(F.col("n") >= int(least), 1).otherwise(0) for least in LEVELS[:40])
    expected = (_sampled(docs, block_bytes).agg(F.sum(level)).first()[0] or 0) * SAMPLE
    filters = max(1, -(-expected * ENTRY_BITS * 11 // 10 // filter_bits))
    each = max(1, min(SEGMENTS, filter_bits // BLOCK_BITS))
    segment_bits = filter_bits // each

    pairs = _pairs(docs, filters * each, block_bytes)
    schema = with_id(units, "held_out boolean, n_tokens long, n_known long, base_score double, score double, block long, place int")
    scores = []
    for i in range(filters):
        mine = pairs if filters == 1 else pairs.where(F.col("segment").between(i * each, (i + 1) * each - 1))
        finished = stored(_filter(mine, segment_bits), "scoring-filter")
        release(spark)
        bits = np.zeros(filter_bits // 8, np.uint8)
        for row in finished.toLocalIterator():
            at = (row["segment"] - i * each) * (segment_bits // 8)
            bits[at : at + segment_bits // 8] = np.frombuffer(row["bits"], np.uint8)
        discard(finished)
        sent = spark.sparkContext.broadcast(bits)
        del bits
        release(spark)
        run = _scorer(sent, i * each, filters * each, segment_bits, total, distinct, ends, schema.names)
        ship(spark)
        scored = units.groupBy("block").cogroup(dictionary.groupBy("block")).applyInArrow(run, schema)
        if filters > 1:  # written, so that one filter at a time is in memory
            scored = stored(scored, "scoring-part")
            sent.unpersist()
        scores.append(scored)
    out = scores[0].drop("block", "place")
    if filters > 1:
        every = scores[0]
        for other in scores[1:]:
            every = every.unionByName(other)
        firsts = [F.first(c).alias(c) for c in ("id", "held_out", "n_tokens", "n_known", "base_score")]
        out = every.groupBy("block", "place").agg(*firsts, F.sum("score").alias("score"))
    out = out.withColumn("train_tokens", F.lit(total).cast("long"))
    return out.select(F.col("id").alias(id_col), "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


def _scorer(sent, first: int, segments: int, segment_bits: int, total: int, distinct: int, ends: int, names: list[str]):
    """The scores of a block's documents from its dictionary with counts and one of the filters."""

    def run(units: pa.Table, dictionary: pa.Table) -> pa.Table:
        n = dictionary.num_rows
        h, c = np.full(n + 1, END), np.full(n + 1, ends, np.int64)
        code = dictionary["code"].to_numpy()
        h[code], c[code] = dictionary["hash"].to_numpy().view(np.uint64), dictionary["c"].to_numpy()
        single = (c + ALPHA) / (total + ALPHA * (distinct + 1))
        parts = []
        for lo in range(0, units.num_rows, SCORED):
            part = units.slice(lo, SCORED)
            size = part["size"].to_numpy()
            tok, start = _ended(from_planes(part["low"], part["high"]), size, n)
            before = np.concatenate([[n], tok[:-1]])
            count = counts_of(sent.value, pair_hash(h[before], h[tok]), first, segments, segment_bits)
            mine = count >= 0
            count = np.minimum(count, np.minimum(c[before], c[tok]))
            p = np.where(mine, (count + MASS * single[tok]) / (c[before] + MASS), 1.0)
            parts.append([size + 1] + [np.add.reduceat(x, start) for x in ((c[tok] > 0).astype(np.int64), np.log10(single[tok]), np.log10(p))])
        sums = [pa.array(np.concatenate(x)) for x in zip(*parts, strict=True)]
        places = pa.array(np.arange(units.num_rows), pa.int32())
        return pa.Table.from_arrays([units["id"], pa.array(~units["train"].to_numpy()), *sums, units["block"], places], names)

    return run
