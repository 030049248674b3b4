"""Language identification by cross-parsing: how many phrases of a language's sample spell a text.

For each language a suffix automaton of a sample of labelled text is built. A text is parsed against it greedily: the
longest string that occurs in the sample is one phrase, then the next phrase begins. Few phrases mean that the text
resembles the sample; the count times the logarithm of the sample's length, per character, estimates the cross entropy.
The language with the fewest normalised phrases wins.

Texts are read as lower-case letters with one space for each run of other characters, and parsed in blocks of ``BLOCK``
symbols (a phrase ends with its block), so that many blocks advance together, one numpy step for each symbol. The most
frequent letters of the samples are one symbol each, every other letter is a few.

The sample is bounded: ``SAMPLE_DOCS`` labelled documents and ``SAMPLE_CHARS`` characters a language, chosen by a hash of
the document's id. Everything else reads all documents.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.llm.common import arrow_map, chunks, kept_model, text_bytes, with_id

#: Labelled documents of one language that its sample is taken from.
SAMPLE_DOCS = 400
#: Characters of one language's sample, and of all samples together, which bounds the tables of a worker.
SAMPLE_CHARS = 40_000
SAMPLE_TOTAL = 320_000
#: Languages that can be learned; more is an error, so that the broadcast stays bounded.
MOST_LANGUAGES = 200
#: Characters in a block of the parse.
BLOCK = 512
#: Symbols: the space, the listed letters, the digits that spell any other letter, and the filling of a block.
SYMBOLS = 64
SPACE, FILL = 0, SYMBOLS - 1
#: A letter that is not listed is spelled by its code point in PLACES digits of base DIGITS, so all letters differ.
DIGITS, PLACES = 17, 5
OTHER = FILL - DIGITS

#: Phrases that a text of any length may have, so that short texts are not judged by a single one.
FREE_PHRASES = 2

UNDETERMINED = "und"


def held_out(doc_id: Column) -> Column:
    """Whether a document's label is kept from learning."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def sample_texts(df: DataFrame, id_col: str, text_col: str, lang_col: str) -> dict[str, str]:
    """At most SAMPLE_CHARS characters of text for each label, from documents that are not held out.

    Labels are counted first; then about four times the wanted documents are kept by a hash threshold, and the
    SAMPLE_DOCS smallest hashes among those are taken. Only these few go to the driver."""
    rows = df.select(F.col(id_col).alias("i"), F.col(text_col).alias("t"), F.col(lang_col).cast("string").alias("l"))
    rows = rows.where("l is not null and t is not null and i is not null").where(~held_out(F.col("i")))
    rows = rows.withColumn("h", F.pmod(F.xxhash64(F.lit(7), F.col("i")), F.lit(1 << 40)))
    counts = rows.groupBy("l").count().limit(MOST_LANGUAGES + 1).collect()
    if len(counts) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    if not counts:
        return {}
    limit = F.create_map(
        *[x for r in counts for x in (F.lit(r["l"]), F.lit(int((1 << 40) * min(1.0, 4 * SAMPLE_DOCS / r["count"]))))]
    )
    best = Window.partitionBy("l").orderBy("h", "i", "t")
    kept = rows.where(F.col("h") < limit[F.col("l")]).withColumn("t", F.substring("t", 1, SAMPLE_CHARS))
    kept = kept.withColumn("n", F.row_number().over(best)).where(F.col("n") <= SAMPLE_DOCS)
    # a document's share is its start; long documents do not crowd out the others
    share = F.substring("t", 1, max(200, 4 * SAMPLE_CHARS // SAMPLE_DOCS))
    taken = kept.select("l", "n", share.alias("t")).collect()
    out: dict[str, list[str]] = {}
    for r in sorted(taken, key=lambda r: (r["l"], r["n"])):
        out.setdefault(r["l"], []).append(r["t"])
    return {k: " ".join(v) for k, v in out.items()}


class Model:
    """Parsing tables of all languages in one array: entry state * SYMBOLS + symbol holds the next state's row in its
    upper bits and in the lowest bit whether a phrase ended."""

    def __init__(self, samples: tuple[tuple[str, str], ...]):
        self.languages = [k for k, _ in samples]
        known = Counter(c for _, t in samples for c in t.lower() if c.isalpha())
        listed = sorted(known, key=lambda c: (-known[c], c))[: OTHER - 1]
        self.symbol = np.zeros(0x110000, np.uint8)
        self.low = np.arange(0x110000, dtype=np.uint32)
        self._letters(dict(zip(listed, range(1, OTHER), strict=False)))
        size = min(SAMPLE_CHARS, SAMPLE_TOTAL // max(1, len(samples)))
        tables, self.start, self.weight, self.sample = [], [], [], []
        for _, text in samples:
            codes = self.codes(text, size).tolist()
            self.start.append(sum(map(len, tables)))
            tables.append(_table(codes, self.start[-1]))
            self.weight.append(float(np.log2(len(codes) + 2)))
            self.sample.append(codes)
        self.table = np.concatenate(tables) if tables else np.zeros(0, np.int32)

    def _letters(self, listed: dict[str, int]) -> None:
        for point in range(0x110000):
            if 0xD800 <= point < 0xE000:
                continue
            c = chr(point)
            if c.isalpha():
                low = c.lower()
                self.symbol[point] = listed.get(low[0], OTHER)
                self.low[point] = ord(low[0])

    def codes(self, text: str, most: int | None = None) -> np.ndarray:
        """The symbols of the text, or of its first ``most`` characters, runs of spaces counting as one."""
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        kept = _one_space(self.symbol[points])
        points = points[kept][:most]
        codes = self.symbol[points]
        rare = codes == OTHER
        if rare.any():
            codes = np.repeat(codes, np.where(rare, PLACES, 1))
            at, low = np.flatnonzero(codes == OTHER).reshape(-1, PLACES), self.low[points[rare]]
            for k in range(PLACES):
                codes[at[:, k]] = OTHER + low // DIGITS**k % DIGITS
        return codes

    def phrases(self, blocks: np.ndarray) -> np.ndarray:
        """Phrases by language and block. blocks: a row of BLOCK symbols for each."""
        return _phrases(self.table, self.start, blocks)

    @cached_property
    def needs(self) -> np.ndarray:
        """Bits for each symbol that text of each language needs: the second half of its sample, by the first half."""
        out = []
        for codes in self.sample:
            first, second = codes[: len(codes) // 2], codes[len(codes) // 2 :]
            blocks = np.full((-(-len(second) // BLOCK), BLOCK), FILL, np.uint8)
            blocks.reshape(-1)[: len(second)] = second
            count = _phrases(_table(first, 0), [0], blocks).sum() if second else 1
            out.append(float(count * np.log2(len(first) + 2) / max(1, len(second))))
        return np.array(out)


def _phrases(table: np.ndarray, start: list[int], blocks: np.ndarray) -> np.ndarray:
    steps = np.ascontiguousarray(blocks.T).astype(np.int32)
    roots = np.array(start, np.int32)[:, None]
    state = np.repeat(roots, len(blocks), axis=1)
    count = np.zeros(state.shape, np.int32)
    for symbols in steps:
        found = table[state + symbols]
        ended = found & 1
        count += ended
        state = found - ended
    return count + (state != roots)


def _one_space(codes: np.ndarray) -> np.ndarray:
    """Where no space follows another one."""
    blank = codes == SPACE
    kept = np.ones(len(codes), bool)
    kept[1:] = ~(blank[1:] & blank[:-1])
    return kept


def _table(codes: list[int], base: int) -> np.ndarray:
    """Suffix automaton of the codes (states by their longest string, linked by suffix), as a parsing table."""
    edges: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in codes:
        new = len(edges)
        edges.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in edges[p]:
            edges[p][c] = new
            p = link[p]
        if p >= 0:
            q = edges[p][c]
            if length[p] + 1 == length[q]:
                link[new] = q
            else:
                copy = len(edges)
                edges.append(edges[q].copy())
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and edges[p].get(c) == q:
                    edges[p][c] = copy
                    p = link[p]
                link[q] = link[new] = copy
        last = new
    root = np.full(SYMBOLS, base | 1, np.int32)  # a symbol that never occurs is a phrase of its own
    for c, t in edges[0].items():
        root[c] = base + t * SYMBOLS
    # no edge: the phrase ends, and the next one begins with the symbol
    table = np.tile(root | 1, (len(edges), 1))
    table[0] = root
    at = [(s, c, t) for s, own in enumerate(edges) for c, t in own.items()]
    if at:
        s, c, t = np.array(at, np.int64).T
        table[s, c] = base + t * SYMBOLS
    table[:, FILL] = base | 1
    table[0, FILL] = base
    return table.reshape(-1).astype(np.int32)


def _predict(model: Model, data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[list[str], list[float], list[float]]]:
    for lo, hi in chunks(offsets):
        texts = [bytes(data[a:b]).decode("utf-8", "replace") for a, b in zip(offsets[lo:hi], offsets[lo + 1 : hi + 1], strict=True)]
        codes = [model.codes(t) for t in texts]
        letters = np.array([int((c != SPACE).sum()) for c in codes])
        sizes = np.array([-(-len(c) // BLOCK) for c in codes])
        blocks = np.full((int(sizes.sum()), BLOCK), FILL, np.uint8)
        flat, first = blocks.reshape(-1), np.concatenate([[0], np.cumsum(sizes)])
        for c, at in zip(codes, first, strict=False):
            flat[at * BLOCK : at * BLOCK + len(c)] = c
        names, scores, fits = [], [], []
        total = np.zeros((len(model.languages), len(codes)))
        if model.languages and len(blocks):
            each = np.zeros((len(model.languages), len(blocks) + 1), np.int64)
            np.cumsum(model.phrases(blocks), axis=1, out=each[:, 1:])
            total = (each[:, first[1:]] - each[:, first[:-1]]) * np.array(model.weight)[:, None]
        for k in range(len(codes)):
            if not letters[k] or not model.languages:
                names.append(UNDETERMINED)
                scores.append(0.0)
                fits.append(0.0)
                continue
            bits = total[:, k] / len(codes[k])
            best = int(np.argmin(bits))  # of equal languages the first by name
            share = (bits[best] / np.maximum(bits, 1e-9)) ** 8
            names.append(model.languages[best])
            scores.append(float(1 / share.sum()) if bits[best] > 0 else 1.0)
            spare = FREE_PHRASES * model.weight[best] / len(codes[k])
            fits.append(max(0.0, float((bits[best] - spare) / model.needs[best])))
        yield names, scores, fits


def identify(
    df: DataFrame, labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"
) -> DataFrame:
    """(id_col, held_out, lang_pred, score), one row for each row of ``df``; no shuffle beyond choosing the sample.

    Learns from ``labelled`` (rows with a null id, text or label are not used). A null text, one without a letter, and
    every text where nothing could be learned gets ``und`` with score 0. Otherwise ``score`` is 1 divided by the sum of
    the languages' shares (1 for the best, less for those that need more phrases), so 1 is certain. A null id is never
    held out. Repeated rows are predicted each; other columns are ignored."""
    texts = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    out = predict(texts, sample_texts(labelled, id_col, text_col, lang_col))
    return out.select(F.col("id").alias(id_col), held_out(F.col("id")).alias("held_out"), "lang_pred", "score")


def predict(texts: DataFrame, samples: dict[str, str], with_text: bool = False) -> DataFrame:
    """(id, lang_pred, score, fit[, text]) for the rows (id, text); the id may be of any type. ``fit`` is the bits that the best
    language needs for the text, beyond FREE_PHRASES phrases, by those that labelled text of that language needs: about
    1 or less for a text in it, whatever other languages there are."""
    spark = texts.sparkSession
    shared = spark.sparkContext.broadcast(tuple(sorted(samples.items())))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = kept_model(shared.value, lambda: Model(shared.value))
        for batch in batches:
            names, scores, fits = [], [], []
            for a, b, c in _predict(model, *text_bytes(batch.column(1))):
                names += a
                scores += b
                fits += c
            arrays = [batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(fits, pa.float64())]
            yield pa.RecordBatch.from_arrays(arrays + [batch.column(1)] * with_text, ["id", "lang_pred", "score", "fit"] + ["text"] * with_text)

    return arrow_map(texts, run, with_id(texts, "lang_pred string, score double, fit double" + ", text string" * with_text), keeps=True)
