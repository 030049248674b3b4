"""SentencePiece BPE encoding and decoding without a merge queue over the text.

Encoding a chunk walks it left to right: from each place the longest piece (all pieces come from one Aho-Corasick pass)
that can stand beside the piece before it; two pieces can stand side by side exactly when merging their joined text
again, by piece score and leftmost first, gives the same two pieces. Where no piece fits, the place is marked in a
bitfield as failed and the walk steps back to the next shorter piece of the place before.

Texts are cut into chunks where no piece can span the cut, and the result of a chunk is kept for the next time it
occurs (at most twice ``CACHE`` chunks), because words repeat.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import arrow_map, kept_model, with_id

CACHE = 150_000
#: Texts of about so many characters make one output batch.
BATCH_CHARS = 1 << 20
SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


def read_pieces(model_path: str) -> list[tuple[str, float, int]]:
    """(piece, score, kind) by id, read on the driver: a vocabulary is of fixed size. The model must be BPE with byte
    fallback, identity normalisation and a leading space, else ValueError."""
    from sentencepiece import SentencePieceProcessor
    from sentencepiece import sentencepiece_model_pb2 as proto

    model = proto.ModelProto()
    with open(model_path, "rb") as f:
        model.ParseFromString(f.read())
    norm, train = model.normalizer_spec, model.trainer_spec
    if train.model_type != 2 or not train.byte_fallback or norm.precompiled_charsmap or norm.remove_extra_whitespaces:
        raise ValueError("only BPE models with byte fallback and identity normalisation are supported")
    if not norm.add_dummy_prefix or not norm.escape_whitespaces or train.treat_whitespace_as_suffix:
        raise ValueError("only models that put a space before the text are supported")
    pieces = [(p.piece, p.score, p.type) for p in model.pieces]
    if any(kind in (USER, UNUSED) for _, _, kind in pieces):
        raise ValueError("user-defined and unused pieces are not supported")
    SentencePieceProcessor(model_proto=model.SerializeToString())  # the library accepts it
    return pieces


class _Kept(dict):
    """Results by chunk in two generations: when the young one (this dict) is full it becomes the old one, and what is
    used again moves over, so frequent chunks stay. Chunks of over 64 characters are not kept."""

    def __init__(self, make):
        self.make, self.old = make, {}

    def __missing__(self, chunk):
        found = self.old.get(chunk)
        if found is None:
            found = self.make(chunk)
        if len(chunk) <= 64:
            if len(self) >= CACHE:
                self.old = dict(self)
                self.clear()
            self[chunk] = found
        return found


class PieceBpe:
    def __init__(self, pieces: list[tuple[str, float, int]]):
        self.pieces = pieces
        self.ids = {p: i for i, (p, _, kind) in enumerate(pieces) if kind == NORMAL}
        self.score = {p: s for p, s, kind in pieces if kind == NORMAL}
        self.byte = {int(p[3:5], 16): i for i, (p, _, kind) in enumerate(pieces) if kind == BYTE}
        self.automaton = ahocorasick.Automaton()
        for p in self.ids:
            self.automaton.add_word(p, (self.ids[p], len(p) - 1))
        self.automaton.make_automaton()
        if any(SPACE in p.lstrip(SPACE) for p in self.ids):
            raise ValueError("a piece has a space inside")
        joined = {c for p in self.ids if len(p) > 1 for c in p} - {SPACE}
        # characters of longer pieces stay together, each other one is a chunk, and a space starts a chunk
        inside = "".join(map(re.escape, sorted(joined)))
        self.chunk = re.compile(f"{SPACE}*[{inside}]+|{SPACE}+|[^{inside}{SPACE}]" if joined else "(?s:.)")
        self.names = [f"{i}," for i in range(len(pieces))]
        self.bytes = [self.piece_bytes(i) for i in range(len(pieces))]
        self.fits: dict[int, bool] = {}
        self.size = [len(p) for p, _, _ in pieces]
        self.shorter = [self._shorter(p) for p, _, _ in pieces]
        self.cache = _Kept(self.known)

    def _shorter(self, piece: str) -> int:
        """The longest piece that starts this one, or -1."""
        return next((self.ids[piece[:n]] for n in range(len(piece) - 1, 0, -1) if piece[:n] in self.ids), -1)

    def merged(self, text: str) -> list[str]:
        """Plain merging, for the short texts of two pieces: best score first, of equal ones the leftmost."""
        parts = list(text)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = self.score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if at < 0:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def beside(self, left: int, right: int) -> bool:
        """Whether merging gives these two pieces again; a left of -1 is the chunk's start or a character alone."""
        if len(self.fits) >= CACHE:
            self.fits.clear()
        two = [self.pieces[i][0] for i in (left, right) if i >= 0]
        known = self.fits[left * len(self.pieces) + right] = self.merged("".join(two)) == two
        return known

    def chunk_ids(self, chunk: str) -> list[int]:
        n, fits, size, shorter, many = len(chunk), self.fits, self.size, self.shorter, len(self.pieces)
        longest = [-1] * n
        for end, (i, before) in self.automaton.iter(chunk):
            longest[end - before] = i  # of the matches from one place the longest comes last
        failed = bytearray(n + 1)
        ids: list[int] = []
        at, left, i = 0, -1, longest[0]
        while at < n:
            if i == -1 and longest[at] == -1:  # a character without a piece stands alone
                ids.append(-1)
                at, left = at + 1, -1
                i = longest[at] if at < n else -1
                continue
            while i >= 0:
                end = at + size[i]
                if not failed[end]:
                    fit = fits.get(left * many + i)
                    if fit or fit is None and self.beside(left, i):
                        break
                i = shorter[i]
            if i >= 0:
                ids.append(i)
                at, left = end, i
                i = longest[at] if at < n else -1
                continue
            failed[at] = 1
            if not ids or ids[-1] < 0:
                raise ValueError(f"no encoding of {chunk[:50]!r}")
            i = ids.pop()
            at -= size[i]
            left, i = (ids[-1] if ids else -1), shorter[i]
            if i < 0:
                i = -2  # nothing shorter: this place fails as well
        if -1 in ids:
            out, at = [], 0
            for i in ids:
                out += [i] if i >= 0 else [self.byte[b] for b in chunk[at].encode()]
                at += size[i] if i >= 0 else 1
            return out
        return ids

    def chunks(self, text: str) -> list[str]:
        return self.chunk.findall(SPACE + text.replace(" ", SPACE)) if text else []

    def encode(self, text: str | None) -> list[int]:
        return [i for c in self.chunks(text or "") for i in self.chunk_ids(c)]

    def piece_bytes(self, i: int) -> bytes:
        piece, _, kind = self.pieces[i]
        if kind == BYTE:
            return bytes([int(piece[3:5], 16)])
        if kind == CONTROL:
            return b""
        return " ⁇ ".encode() if kind == UNKNOWN else piece.replace(SPACE, " ").encode()

    def decode(self, ids: list[int]) -> str:
        """The text of the ids, without the leading space that encoding adds. A byte that is not part of a
        character becomes U+FFFD, each on its own."""
        skip = next((i for i in ids if self.pieces[i][2] != CONTROL), None)
        out, run = [], bytearray()
        for i in ids:
            if self.pieces[i][2] == BYTE:
                run += self.piece_bytes(i)
                continue
            out.append(_utf8(run))
            run.clear()
            out.append(self.piece_bytes(i).decode())
        out.append(_utf8(run))
        text = "".join(out)
        lead = skip is not None and self.pieces[skip][0].startswith(SPACE) and self.pieces[skip][2] == NORMAL
        return text[1:] if lead else text

    def known(self, chunk: str) -> tuple[str, bytes]:
        """The chunk's ids, each followed by a comma, and the bytes they stand for."""
        ids = self.chunk_ids(chunk)
        return "".join([self.names[i] for i in ids]), b"".join([self.bytes[i] for i in ids])

    def both(self, text: str | None) -> tuple[str, int, str]:
        """(ids joined by commas, their number, the decoded text)."""
        if not text:
            return "", 0, ""
        ids, back = zip(*map(self.cache.__getitem__, self.chunks(text)), strict=True)
        joined = "".join(ids)
        # chunks end between characters, so the bytes of a text are whole
        return joined[:-1], joined.count(","), b"".join(back).decode()[1:]


def _utf8(run: bytearray) -> str:
    out, i = [], 0
    while i < len(run):
        for size in (1, 2, 3, 4):
            try:
                out.append(bytes(run[i : i + size]).decode())
                i += size
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            i += 1
    return "".join(out)


def encode_texts(df: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", ids: bool = True) -> DataFrame:
    """(id_col, n_tokens, ids_sha256, decoded_sha256, decoded[, token_ids]), one row for each row of ``df``, no shuffle.

    ``token_ids`` is the array of ids, left out with ``ids=False``. A null text counts as empty: no ids, empty decoded
    text. Repeated rows and null ids are kept; other columns are ignored. The vocabulary (of fixed size) is broadcast;
    a worker builds its tables once."""
    spark = df.sparkSession
    pieces = spark.sparkContext.broadcast(read_pieces(model_path))
    key = hashlib.sha256(repr(pieces.value).encode()).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = kept_model(key, lambda: PieceBpe(pieces.value))
        for batch in batches:
            lo = size = 0
            for hi, value in enumerate(batch.column(1), 1):
                size += len(value.as_py() or "")
                if size >= BATCH_CHARS or hi == batch.num_rows:
                    yield encoded(model, batch.slice(lo, hi - lo))
                    lo, size = hi, 0

    def encoded(model: PieceBpe, batch: pa.RecordBatch) -> pa.RecordBatch:
        n, hashes, decoded_hashes, decoded, out = [], [], [], [], [np.zeros(0, np.int32)]
        for value in batch.column(1):
            joined, count, back = model.both(value.as_py())
            n.append(count)
            hashes.append(hashlib.sha256(joined.encode()).hexdigest())
            decoded_hashes.append(hashlib.sha256(back.encode()).hexdigest())
            if ids:
                decoded.append(back)
                out.append(np.array(joined.split(",") if joined else [], np.int32))
        arrays = [batch.column(0), pa.array(n, pa.int64()), pa.array(hashes, pa.string()), pa.array(decoded_hashes, pa.string())]
        if ids:
            ends = pa.array(np.cumsum([0, *n]), pa.int32())
            arrays += [pa.array(decoded, pa.string()), pa.ListArray.from_arrays(ends, pa.array(np.concatenate(out)))]
        names = ["id", "n_tokens", "ids_sha256", "decoded_sha256", "decoded", "token_ids"]
        return pa.RecordBatch.from_arrays(arrays, names[: len(arrays)])

    schema = "n_tokens long, ids_sha256 string, decoded_sha256 string"
    schema += ", decoded string, token_ids array<int>" if ids else ""
    texts = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return arrow_map(texts, run, with_id(texts, schema), keeps=True).withColumnRenamed("id", id_col)
