"""Alignment of two tokenizers over the bytes of a text.

Where a token of either tokenizer ends at the same byte, the tokens before it form a closed group. A stretch of a text
is a fragment: what comes before its first common end (open, because the group may have begun earlier), the closed
groups between, and what comes after its last common end. Fragments of neighbouring stretches compose: the open ends that
meet are joined and searched for common ends. Composition is associative, so the fragments of a very long text, which
are made by different tasks, are reduced in a tree; closed groups stay where they were found.

A stretch is a byte range. Each tokenizer starts at its own first place from there on at which it always cuts, so
that both give the tokens they would give for the whole text. A text of at most ``RANGE_BYTES`` is one stretch.

How many documents hold an id pair is counted by pairs of whole blocks of documents: the block's dictionary of pairs is
joined with the counts and comes back to the block, so neither counts nor pairs are broadcast.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from sentencepiece import SentencePieceProcessor

from quayside.llm.common import BLOCK_BYTES, arrow_map, blocks, chunks, from_planes, kept_model, planes, ship, stored, with_id
from quayside.llm.piece_bpe import BYTE, NORMAL, SPACE, read_pieces

#: Bytes of a stretch, and the most that may be asked for: a pair's links in a stretch then fit 32 bits.
RANGE_BYTES = 1 << 16
#: Fragments composed by one task at a time.
FAN = 16
#: Groups with more links than this are counted by ids before their links are listed.
WIDE = 256

# How byte-level BPE vocabularies of this kind split a text before merging; a fixed value of the public vocabulary.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

# Letters and marks whose Unicode class no tokenizer's table disputes; between them a byte-level tokenizer always cuts.
_LETTER = "A-Za-zÀ-ÖØ-öø-ɏА-яぁ-ゖァ-ヺ一-龥가-힣"
_MARK = '!"#$%&()*+,./:;<=>?@[\\\\\\]^_`{|}~\\-‐-‧、。，．：；？！'
_CUT_A = regex.compile(f"(?<=[{_LETTER}{_MARK}0-9])(?=[ \n])|(?<=[{_LETTER}])(?=[0-9{_MARK}])|(?<=[0-9])(?=[{_LETTER}{_MARK}])|(?<=[{_MARK}])(?=[{_LETTER}0-9])")


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in a byte-level vocabulary: printable Latin-1 for itself, the other
    bytes in ascending order from U+0100."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def read_byte_bpe(path: str) -> dict[bytes, int]:
    """Token bytes and ids, without special tokens; read on the driver, a vocabulary is of fixed size. Ids must be the
    order of merging, else ValueError."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    vocab, before = spec["model"]["vocab"], spec.get("pre_tokenizer") or {}
    if spec["model"]["type"] != "BPE" or before.get("type") != "ByteLevel" or before.get("add_prefix_space") or spec.get("normalizer"):
        raise ValueError("only byte-level BPE without normalisation and prefix space is supported")
    letters, special = byte_letters(), {t["content"] for t in spec.get("added_tokens", [])}
    merged = ["".join(m if isinstance(m, list) else m.split(" ")) for m in spec["model"]["merges"]]
    at = [vocab[m] for m in merged]
    if any(a >= b for a, b in zip(at, at[1:], strict=False)) or any(len(t) > 1 and vocab[t] < 256 for t in vocab):
        raise ValueError("ids do not follow the order of merging")
    return {bytes(letters[c] for c in t): i for t, i in vocab.items() if t not in special}


def read_piece_model(path: str) -> tuple[bytes, list[tuple[str, float, int]]]:
    with open(path, "rb") as f:
        return f.read(), read_pieces(path)


class TwoTokenizers:
    """Built once in a worker from the broadcast vocabularies."""

    def __init__(self, ranks: dict[bytes, int], model: bytes, pieces: list[tuple[str, float, int]]):
        self.a = tiktoken.Encoding("a", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
        self.b = SentencePieceProcessor(model_proto=model)
        self.n_a, self.n_b = max(ranks.values()) + 1, len(pieces)
        self.a_bytes = [b""] * self.n_a
        for token, i in ranks.items():
            self.a_bytes[i] = token
        self.b_bytes = [bytes([int(p[3:5], 16)]) if kind == BYTE else p.replace(SPACE, " ").encode() for p, _, kind in pieces]
        self.a_size, self.b_size = (np.array([len(t) for t in x], np.int64) for x in (self.a_bytes, self.b_bytes))
        self.space = next(i for i, (p, _, kind) in enumerate(pieces) if p == SPACE and kind == NORMAL)
        # characters that no longer piece holds are always cut off, and a space after another character is
        joined = "".join(map(regex.escape, sorted({c for p, _, kind in pieces if kind == NORMAL and len(p) > 1 for c in p} - {SPACE})))
        self.cut_b = regex.compile(f"(?<=[^ ])(?= )|(?=[^ {joined}])")
        self.names = [f"{i}{mark}" for n, mark in ((self.n_a, ","), (self.n_a, "|"), (self.n_b, ","), (self.n_b, ";")) for i in range(n)]

    def encode_a(self, text: str) -> list[int]:
        return self.a.encode_ordinary(text)

    def encode_b(self, texts: list[str]) -> list[list[int]]:
        """The ids of texts that are the whole text with its leading space, or start where this tokenizer cuts."""
        spaced = [t[:1] == " " for t in texts]
        found = self.b.encode([t[1:] if s else t for t, s in zip(texts, spaced, strict=True)], num_threads=1)
        return [(ids or [self.space]) if s else ids[1:] for ids, s in zip(found, spaced, strict=True)]


@dataclass
class Tokens:
    """Ids and the byte at which each token ends."""

    ids: np.ndarray
    ends: np.ndarray

    def part(self, after: int, to: int) -> Tokens:
        """The tokens that end after the one byte and not after the other."""
        lo, hi = np.searchsorted(self.ends, [after, to], "right")
        return Tokens(self.ids[lo:hi], self.ends[lo:hi])

    def __add__(self, other: Tokens) -> Tokens:
        return Tokens(np.concatenate([self.ids, other.ids]), np.concatenate([self.ends, other.ends]))


NONE = Tokens(np.zeros(0, np.int64), np.zeros(0, np.int64))
FAR = np.iinfo(np.int64).max


@dataclass
class Fragment:
    """Open tokens of both tokenizers at the head and the tail of a stretch. Without a common end (``cut`` is False) all of
    its tokens are the head and there is no tail."""

    cut: bool
    head: tuple[Tokens, Tokens]
    tail: tuple[Tokens, Tokens]


def fragment(a: Tokens, b: Tokens, first: bool) -> tuple[Fragment, tuple[Tokens, Tokens]]:
    """The fragment of a stretch's tokens and those in its closed groups; the first stretch starts with a common end."""
    common = np.intersect1d(a.ends, b.ends, assume_unique=True)
    if first:
        common = np.concatenate([[0], common])
    if not len(common):
        return Fragment(False, (a, b), (NONE, NONE)), (NONE, NONE)
    lo, hi = common[0], common[-1]
    head, tail = (a.part(-1, lo), b.part(-1, lo)), (a.part(hi, FAR), b.part(hi, FAR))
    return Fragment(True, head, tail), (a.part(lo, hi), b.part(lo, hi))


def compose(left: Fragment, right: Fragment) -> tuple[Fragment, tuple[Tokens, Tokens]]:
    """The fragment of two neighbouring stretches and the tokens in the groups that close where they meet."""
    a, b = (x + y for x, y in zip(left.tail if left.cut else left.head, right.head, strict=True))
    met, closed = fragment(a, b, first=False)
    if not met.cut:  # no common end in between, so at most one side has any
        if left.cut:
            return Fragment(True, left.head, met.head), closed
        return met, closed
    if left.cut:  # the last common end on the left is where these tokens start
        closed = tuple(h + c for h, c in zip(met.head, closed, strict=True))
    head = left.head if left.cut else met.head
    return Fragment(True, head, right.tail if right.cut else met.tail), closed


@dataclass
class Groups:
    """What closed groups hold, for several units (documents, or stretches) at once; links as distinct id pairs."""

    groups: np.ndarray
    links: np.ndarray
    texts: list[bytes]
    pair: np.ndarray
    times: np.ndarray
    pairs: np.ndarray


def closed_groups(two: TwoTokenizers, a: Tokens, b: Tokens, count_a: np.ndarray, count_b: np.ndarray) -> Groups:
    """For units of count_a[u] and count_b[u] tokens, whose ends run on from unit to unit and are common at unit ends."""
    units = len(count_a)
    start = min((int(t.ends[0] - size[t.ids[0]]) for t, size in ((a, two.a_size), (b, two.b_size)) if len(t.ids)), default=0)
    mark = np.zeros((int(a.ends[-1]) - start if len(a.ends) else 0) + 1, np.uint8)
    mark[a.ends - start] = 1
    mark[b.ends - start] += 2
    both = mark == 3
    before = np.cumsum(both) - both
    in_a, in_b = before[a.ends - start], before[b.ends - start]
    n = int(both.sum())
    many_a, many_b = np.bincount(in_a, minlength=n), np.bincount(in_b, minlength=n)
    first_a, first_b = np.cumsum(many_a) - many_a, np.cumsum(many_b) - many_b
    unit_a = np.repeat(np.arange(units), count_a)
    unit = unit_a[first_a]  # of each group
    # texts: the tokens of a group stand together, with the mark that follows each
    order = np.empty(len(in_a) + len(in_b), np.int64)
    last_a, last_b = np.zeros(len(in_a), bool), np.zeros(len(in_b), bool)
    last_a[first_a + many_a - 1], last_b[first_b + many_b - 1] = True, True
    order[np.arange(len(in_a)) + first_b[in_a]] = a.ids + two.n_a * last_a
    order[np.arange(len(in_b)) + (first_a + many_a)[in_b]] = b.ids + 2 * two.n_a + two.n_b * last_b
    names, at, texts = two.names, 0, []
    for size in (count_a + count_b).tolist():
        texts.append("".join(map(names.__getitem__, order[at : at + size].tolist()))[:-1].encode())
        at += size
    # links
    span = two.n_a * two.n_b
    wide = many_a * many_b > WIDE
    times = np.where(wide[in_a], 0, many_b[in_a])
    other = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times - first_b[in_a], times)
    key, many = np.unique(np.repeat(unit_a * span + a.ids * two.n_b, times) + b.ids[other], return_counts=True)
    if wide.any():
        keys, counts = [key], [many]
        for g in np.flatnonzero(wide).tolist():
            one, n_one = np.unique(a.ids[first_a[g] : first_a[g] + many_a[g]], return_counts=True)
            two_, n_two = np.unique(b.ids[first_b[g] : first_b[g] + many_b[g]], return_counts=True)
            keys.append((unit[g] * span + one[:, None] * two.n_b + two_).ravel())
            counts.append((n_one[:, None] * n_two).ravel())
        key, inverse = np.unique(np.concatenate(keys), return_inverse=True)
        many = np.bincount(inverse, np.concatenate(counts).astype(np.float64)).astype(np.int64)
    return Groups(
        np.bincount(unit, minlength=units), np.bincount(unit, many_a * many_b, minlength=units).astype(np.int64), texts,
        key % span, many, np.bincount(key // span, minlength=units),
    )


def _two(sent) -> TwoTokenizers:
    key, ranks, model, pieces = sent.value
    return kept_model(key, lambda: TwoTokenizers(ranks, model, pieces))


def _valid(two: TwoTokenizers, a: list[int], b: list[int], data: bytes) -> bool:
    """Whether both tokenizers give back the bytes."""
    return b"".join(map(two.a_bytes.__getitem__, a)) == data and b"".join(map(two.b_bytes.__getitem__, b)) == data


# ---------------------------------------------------------------- texts of one stretch


def _block_groups(two: TwoTokenizers, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, Groups]:
    """The groups of a few texts; those without tokens have none."""
    spaced = [" " + t if t else "" for t in texts]
    ids_a = [two.encode_a(t) if t else [] for t in spaced]
    ids_b = two.encode_b(spaced)
    for i, text in enumerate(spaced):
        if not text or not _valid(two, ids_a[i], ids_b[i], text.encode()):
            ids_a[i], ids_b[i] = [], []
    flat_a, flat_b = (np.fromiter((i for ids in x for i in ids), np.int64) for x in (ids_a, ids_b))
    count_a, count_b = (np.array([len(ids) for ids in x], np.int64) for x in (ids_a, ids_b))
    a, b = Tokens(flat_a, np.cumsum(two.a_size[flat_a])), Tokens(flat_b, np.cumsum(two.b_size[flat_b]))
    return count_a, count_b, closed_groups(two, a, b, count_a, count_b)


def _short(docs: DataFrame, sent, block_bytes: int) -> DataFrame:
    """Rows of two kinds: a document with its counts and the block's numbers of its pairs, and a pair of a block with the number of
    documents of the block that hold it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        two = _two(sent)
        for block, rows in blocks(batches, block_bytes):
            texts = rows.column(1).to_pylist()
            offsets = np.concatenate([[0], np.cumsum([len(t or "") for t in texts])])
            counts_a, counts_b, parts, hashes = [], [], [], []
            for lo, hi in chunks(offsets):
                count_a, count_b, found = _block_groups(two, texts[lo:hi])
                counts_a.append(count_a)
                counts_b.append(count_b)
                hashes += [hashlib.sha256(t).hexdigest() if t else "" for t in found.texts]
                found.texts.clear()
                parts.append(found)
            joined = lambda name: np.concatenate([getattr(p, name) for p in parts])
            pair, code, holders = np.unique(joined("pair"), return_inverse=True, return_counts=True)
            rank = np.empty(len(pair), np.int64)
            rank[np.argsort(-holders, kind="stable")] = np.arange(len(pair))
            some = len(texts)
            nothing = [pa.nulls(some, t) for t in (pa.int32(), pa.int32(), pa.int32(), pa.int64())]
            sizes = joined("pairs")
            own = [
                rows.column(0).combine_chunks(), *(pa.array(x, pa.int64()) for x in (np.concatenate(counts_a), np.concatenate(counts_b), joined("groups"), joined("links"))),
                pa.array(hashes, pa.string()), pa.array(sizes, pa.int64()), *planes(rank[code], sizes), *planes(joined("times"), sizes),
            ]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(some, block), pa.int64()), *own, *nothing], names)
            some = len(pair)
            nothing = [pa.nulls(some, t.type) for t in own]
            own = [pa.array(rank, pa.int32()), pa.array(pair // two.n_b, pa.int32()), pa.array(pair % two.n_b, pa.int32()), pa.array(holders, pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(some, block), pa.int64()), *nothing, *own], names)

    columns = with_id(docs, f"{COUNTS}, groups_sha256 string, size long, low binary, high binary, times_low binary, times_high binary, code int, a int, b int, n long")
    schema = StructType(StructType.fromDDL("block long").fields + columns.fields)
    names = schema.names
    return arrow_map(docs, run, schema, keeps=True)


COUNTS = "n_a long, n_b long, n_groups long, n_links long"


def _block_sums(units: pa.Table, dictionary: pa.Table) -> pa.Table:
    """A block's documents with n_best and count_sum, from its dictionary with corpus-wide counts."""
    n = dictionary.num_rows
    count, best = np.zeros(n, np.int64), np.zeros(n, np.int64)
    code = dictionary["code"].to_numpy()
    count[code], best[code] = dictionary["count"].to_numpy(), dictionary["best"].to_numpy(zero_copy_only=False)
    size = units["size"].to_numpy()
    which, times = from_planes(units["low"], units["high"]), from_planes(units["times_low"], units["times_high"])
    ends = np.concatenate([[0], np.cumsum(size)])

    def sums(values: np.ndarray) -> pa.Array:
        total = np.concatenate([[0], np.cumsum(values[which] * times)])
        return pa.array(total[ends[1:]] - total[ends[:-1]], pa.int64())

    kept = units.select(["id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"])
    return kept.append_column("n_best", sums(best)).append_column("count_sum", sums(count))


# ---------------------------------------------------------------- texts of several stretches


def stretches(two: TwoTokenizers, text: str, range_bytes: int) -> Iterator[tuple[str, int, int, int, int, int]]:
    """(part, its first byte, and the bytes between which it has tokens of the first and of the second tokenizer)."""
    size = len(text.encode())
    at_char = at_byte = 0  # a known place: character and byte
    cut = (0, 0)
    place = {0: 0}  # characters of the bytes in use
    target = range_bytes
    while min(cut) < size:
        # the first character at or after the target byte
        while at_char < len(text) and at_byte < target:
            step = max(1, (target - at_byte) // 4)
            at_byte += len(text[at_char : at_char + step].encode())
            at_char += step
        if at_char >= len(text):
            at_char, at_byte = len(text), size
        after = []
        for pattern in (_CUT_A, two.cut_b):
            found = pattern.search(text, at_char) if at_char < len(text) else None
            char = found.start() if found else len(text)
            byte = at_byte + len(text[at_char:char].encode())
            place[byte] = char
            after.append(byte)
        lo, hi = min(cut), max(after)
        yield text[place[lo] : place[hi]], lo, cut[0], after[0], cut[1], after[1]
        cut = (after[0], after[1])
        target = (max(cut) // range_bytes + 1) * range_bytes
        at_byte, at_char = max(cut), place[max(cut)]


OPEN = "cut boolean, " + ", ".join(f"{end}_{side} array<int>, {end}_{side}_ends array<long>" for end in ("head", "tail") for side in "ab")
CLOSED = f"start long, {COUNTS}, groups binary, a array<int>, b array<int>, times array<long>"
LONG = f"kind string, row long, chunk long, bad boolean, {OPEN}, {CLOSED}"
_KEYS = [f"{end}_{side}" for end in ("head", "tail") for side in "ab"]


def _open_row(row: int, chunk: int, bad: bool, f: Fragment) -> dict:
    out = {"kind": "open", "row": row, "chunk": chunk, "bad": bad, "cut": f.cut}
    for key, t in zip(_KEYS, (*f.head, *f.tail), strict=True):
        out[key], out[key + "_ends"] = t.ids, t.ends
    return out


def _closed_row(two: TwoTokenizers, row: int, a: Tokens, b: Tokens) -> dict:
    found = closed_groups(two, a, b, np.array([len(a.ids)]), np.array([len(b.ids)]))
    return {
        "kind": "closed", "row": row, "bad": False, "start": int(a.ends[0]), "n_a": len(a.ids), "n_b": len(b.ids), "n_groups": int(found.groups[0]),
        "n_links": int(found.links[0]), "groups": found.texts[0], "a": found.pair // two.n_b, "b": found.pair % two.n_b, "times": found.times,
    }


def _cut_texts(docs: DataFrame, sent, range_bytes: int) -> DataFrame:
    """(row, id, chunk, part, ...): the stretches of each text, with a number for the text. A text with U+2581 has no tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        two = _two(sent)
        for block, rows in blocks(batches, 1):
            text = " " + rows.column(1)[0].as_py()
            some = [("", 0, 0, 0, 0, 0)] if SPACE in text else stretches(two, text, range_bytes)
            for chunk, (part, *places) in enumerate(some):
                numbers = [pa.array([v], pa.int64()) for v in (block, chunk, *places)]
                arrays = [*numbers[:2], rows.column(0).combine_chunks(), pa.array([part], pa.string()), *numbers[2:]]
                yield pa.RecordBatch.from_arrays(arrays, names)

    schema = StructType(StructType.fromDDL("row long, chunk long").fields + with_id(docs, "part string, at long, a0 long, a1 long, b0 long, b1 long").fields)
    names = schema.names
    return arrow_map(docs, run, schema, keeps=True)


def _fragments(parts: DataFrame, sent, schema: StructType) -> DataFrame:
    """An open row for each stretch and a closed one for its closed groups."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        two, arrow = _two(sent), to_arrow_schema(schema)
        for batch in batches:
            for r in batch.to_pylist():
                data = r["part"].encode()
                of_a, of_b = (data[r[f"{s}0"] - r["at"] : r[f"{s}1"] - r["at"]] for s in "ab")
                ids_a = two.encode_a(of_a.decode()) if of_a else []
                ids_b = two.encode_b([of_b.decode()])[0] if of_b else []
                bad = not data or b"".join(map(two.a_bytes.__getitem__, ids_a)) != of_a or b"".join(map(two.b_bytes.__getitem__, ids_b)) != of_b
                if bad:
                    ids_a = ids_b = []
                a, b = (np.array(ids, np.int64) for ids in (ids_a, ids_b))
                a, b = Tokens(a, r["a0"] + np.cumsum(two.a_size[a])), Tokens(b, r["b0"] + np.cumsum(two.b_size[b]))
                part, closed = fragment(a, b, r["chunk"] == 0)
                out = [_open_row(r["row"], r["chunk"], bad, part)]
                if len(closed[0].ids):
                    out.append(_closed_row(two, r["row"], *closed))
                yield pa.RecordBatch.from_pylist([{"id": r["id"], **o} for o in out], arrow)

    return arrow_map(parts, run, schema, keeps=True)


def to_arrow_schema(schema: StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema as to_arrow

    return to_arrow(schema)


def _composed(open_rows: DataFrame, sent, schema: StructType) -> DataFrame:
    """One open row for up to FAN neighbouring ones of a text, and closed rows for the groups that close between them."""

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        two, arrow = _two(sent), to_arrow_schema(schema)
        now, out, bad, owner = None, [], False, None
        for r in sorted(rows.to_pylist(), key=lambda r: r["chunk"]):
            ends = [Tokens(np.array(r[k], np.int64), np.array(r[k + "_ends"], np.int64)) for k in _KEYS]
            part = Fragment(r["cut"], tuple(ends[:2]), tuple(ends[2:]))
            bad, owner = bad or r["bad"], r["id"]
            if now is None:
                now = part
                continue
            now, closed = compose(now, part)
            if len(closed[0].ids) and not bad:
                out.append(_closed_row(two, r["row"], *closed))
        out.append(_open_row(key[0].as_py(), key[1].as_py(), bad, now))
        return pa.Table.from_pylist([{"id": owner, **o} for o in out], arrow)

    grouped = open_rows.withColumn("parent", F.floor(F.col("chunk") / FAN).cast("long")).groupBy("row", "parent")
    ship(open_rows.sparkSession)
    return grouped.applyInArrow(run, schema)


def _digests(closed: DataFrame) -> DataFrame:
    """(row, groups_sha256): the groups' texts of each row in order, hashed as they stream by."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, h = None, None
        for batch in batches:
            for row, text in zip(batch.column(0).to_pylist(), batch.column(2), strict=True):
                if row != now:
                    if h is not None:
                        yield digest(now, h)
                    now, h = row, hashlib.sha256()
                else:
                    h.update(b";")
                h.update(text.as_py())
        if h is not None:
            yield digest(now, h)

    def digest(row, h) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([row], pa.int64()), pa.array([h.hexdigest()], pa.string())], ["row", "groups_sha256"])

    ordered = closed.select("row", "start", "groups").repartition("row").sortWithinPartitions("row", "start")
    return arrow_map(ordered, run, "row long, groups_sha256 string")


def _long(docs: DataFrame, sent, range_bytes: int) -> tuple[DataFrame, DataFrame]:
    """(row, id, bad) of the texts of several stretches, and their closed rows."""
    parts = _cut_texts(docs, sent, range_bytes)
    schema = StructType(parts.select("id").schema.fields + StructType.fromDDL(LONG).fields)
    made = stored(_fragments(parts.repartition("row", "chunk"), sent, schema), "alignment-fragments")
    open_rows, closed = made.where("kind = 'open'"), made.where("kind = 'closed'")
    most = open_rows.agg(F.max("chunk")).first()[0] or 0
    while most > 0:
        level = stored(_composed(open_rows, sent, schema), "alignment-fragments")
        open_rows, closed = level.where("kind = 'open'"), closed.unionByName(level.where("kind = 'closed'"))
        most //= FAN
    rows = open_rows.select("row", "id", "bad")
    return rows, closed.join(rows.where("not bad").select("row"), "row", "left_semi")


# ---------------------------------------------------------------- all texts


def align_tokens(
    df: DataFrame, byte_bpe_path: str, piece_path: str, id_col: str = "doc_id", text_col: str = "text", range_bytes: int = RANGE_BYTES,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """(id_col, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256), one row for each row of ``df``.

    Both tokenizers read a space and the text. All tokens of a group are linked with each other; the count of an id
    pair is the number of rows that hold it linked; ``n_best`` are the links whose count is the highest of their first id.
    A text that is null, empty, or that the tokenizers do not give back (one with U+2581) has no tokens: zeros and an empty
    digest. Repeated rows and null ids are rows of their own; no rows give no rows; other columns are ignored. A very long text
    is cut into stretches for several tasks; one without any place where a tokenizer always cuts is one stretch. Both
    vocabularies (of fixed size) are broadcast."""
    if not 0 < range_bytes <= RANGE_BYTES:
        raise ValueError(f"range_bytes must be 1 to {RANGE_BYTES}")
    spark = df.sparkSession
    ranks, (model, pieces) = read_byte_bpe(byte_bpe_path), read_piece_model(piece_path)
    key = hashlib.sha256(model + repr(sorted(ranks.items())).encode()).hexdigest()
    sent = spark.sparkContext.broadcast((key, ranks, model, pieces))
    docs = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    is_long = F.octet_length("text") + 1 > range_bytes
    short = stored(_short(docs.where(~F.coalesce(is_long, F.lit(False))), sent, block_bytes), "alignment-blocks")
    rows, closed = _long(docs.where(is_long), sent, range_bytes)
    spread = closed.select("row", F.explode(F.arrays_zip("a", "b", "times")).alias("p"))
    spread = spread.groupBy("row", F.col("p.a").alias("a"), F.col("p.b").alias("b")).agg(F.sum("p.times").alias("times"))

    entries = short.where("code is not null").select("block", "code", "a", "b", "n")
    held = entries.select("a", "b", "n").unionByName(spread.select("a", "b", F.lit(1).cast("long").alias("n")))
    counts = stored(held.groupBy("a", "b").agg(F.sum("n").alias("count")), "alignment-counts")
    # one row for each id of a vocabulary at most
    highest = F.broadcast(counts.groupBy("a").agg(F.max("count").alias("highest")))
    counts = counts.join(highest, "a").select("a", "b", "count", (F.col("count") == F.col("highest")).cast("int").alias("best"))

    dictionary = entries.join(counts, ["a", "b"]).select(F.col("block").alias("of"), "code", "count", "best")
    units = short.where("size is not null").drop("code", "a", "b", "n")
    names = ["id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum"]
    schema = StructType(units.select("id").schema.fields + StructType.fromDDL(f"{COUNTS}, groups_sha256 string, n_best long, count_sum long").fields)
    ship(spark)
    of_short = units.groupBy("block").cogroup(dictionary.groupBy("of")).applyInArrow(_block_sums, schema)

    sums = spread.join(counts, ["a", "b"]).groupBy("row").agg(F.sum(F.col("best") * F.col("times")).alias("n_best"), F.sum(F.col("count") * F.col("times")).alias("count_sum"))
    totals = closed.groupBy("row").agg(*[F.sum(c).alias(c) for c in ("n_a", "n_b", "n_groups", "n_links")])
    of_long = rows.join(totals, "row", "left").join(_digests(closed), "row", "left").join(sums, "row", "left")
    zero = lambda c: F.coalesce(c, F.lit("" if c == "groups_sha256" else 0)).alias(c)
    of_long = of_long.select("id", *[zero(c) if c == "groups_sha256" else zero(c).cast("long").alias(c) for c in names[1:]])
    out = of_short.unionByName(of_long)
    return out.select(F.col("id").alias(id_col), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
