"""Personal data: regular expressions propose spans, validators confirm them, nearby words adjust the score."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import arrow_map, with_id

# in the order in which spans are listed; the first four are reported whenever their own rule holds
KINDS = ("email", "ip", "card", "phone", "iban", "national_id")
BASE = 4
#: Score a proposal of the further kinds must reach.
THRESHOLD = 0.6
#: Code points before a span that are searched for context words.
CONTEXT = 60

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_NATIONAL = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_NOT_DIGIT = re.compile(r"[^0-9]+")
_WORDS = {
    "email": ("mail", "contact", "write"),
    "ip": ("ip", "host", "address", "server"),
    "card": ("card", "visa", "credit", "payment"),
    "phone": ("phone", "tel", "call", "mobile", "fax"),
    "iban": ("iban", "account", "bank", "konto", "compte", "cuenta"),
    "national_id": ("ssn", "social", "security", "national", "tax", "id"),
}
_START = {"email": 0.8, "ip": 0.6, "card": 0.9, "phone": 0.6, "iban": 0.8, "national_id": 0.4}


def luhn(digits: str) -> bool:
    """The check sum of card numbers."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def mod97(iban: str) -> bool:
    """The check of account numbers: moved and spelled out in digits, the rest by 97 is 1."""
    rest = 0
    for c in iban[4:] + iban[:4]:
        v = int(c, 36)
        rest = (rest * (100 if v > 9 else 10) + v) % 97
    return rest == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of the e-mail pattern, in time linear in the text: an address holds one @, so each @ is tried
    with the run of allowed characters before it that no earlier match has used."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and _LOCAL.match(text, start - 1):
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            yield start, m.end()
            done = m.end()
            at = text.find("@", done)
        else:
            done = max(done, at)  # what stands before this @ cannot begin a later match
            at = text.find("@", at + 1)


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or 0) <= 255


def _score(kind: str, text: str, start: int) -> float:
    near = text[max(0, start - CONTEXT) : start].lower()
    found = any(w in _WORDS[kind] for w in re.split(r"[^a-z]+", near) if w)
    return min(1.0, _START[kind] + 0.2 * found)


def find_spans(text: str | None) -> list[tuple[str, int, int, float]]:
    """(kind, start, end, score) in code points, end exclusive, by kind as listed, then start. Null: none."""
    if not text:
        return []
    out = []
    for start, end in _emails(text):
        out.append(("email", start, end))
    for m in _IP.finditer(text):
        if all(map(_small, m[0].split("."))):
            out.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = m[0].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
                out.append(("phone", *m.span()))
    spans = [(k, s, e, _score(k, text, s)) for k, s, e in out]
    for m in _IBAN.finditer(text):
        bare = m[0].replace(" ", "")
        if 15 <= len(bare) <= 34 and mod97(bare):
            spans.append(("iban", *m.span(), _score("iban", text, m.start())))
    for m in _NATIONAL.finditer(text):
        score = _score("national_id", text, m.start())
        if score >= THRESHOLD and m[0][:3] not in ("000", "666") and m[0][0] != "9":
            spans.append(("national_id", *m.span(), score))
    return spans


def mask(text: str | None, spans: list[tuple[str, int, int, float]]) -> str | None:
    """The text with each span replaced by ``[kind]``; overlapping spans become one, named by the first."""
    if text is None or not spans:
        return text
    out, done = [], 0
    for kind, start, end, _ in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= done:
            out += [text[done:start], f"[{kind}]"]
        done = max(done, end)
    return "".join(out) + text[done:]


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])


def _found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep, masked, spans = batch.column(0), [], []
        for value in batch.column(1):
            text = value.as_py()
            found = find_spans(text)
            spans.append([dict(zip(("kind", "start", "end", "score"), s, strict=True)) for s in found])
            masked.append(mask(text, found))
        arrays = [keep, pa.array(masked, pa.string()), pa.array(spans, pa.list_(_SPAN))]
        yield pa.RecordBatch.from_arrays(arrays, ["id", "masked", "spans"])


def find_personal(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, masked, spans), one row for each row of ``df``, in one pass without a shuffle.

    ``spans`` is an array of (kind, start, end, score) by kind as in KINDS, then start. A null text has no spans and
    stays null; an empty one stays empty. Repeated rows and null ids are kept as they are; other columns are ignored.
    Every search is linear in the length of the text."""
    texts = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return search(texts).select(F.col("id").alias(id_col), "masked", "spans")


def search(texts: DataFrame) -> DataFrame:
    """(id, masked, spans) for the rows (id, text); the id may be of any type."""
    spans = "array<struct<kind:string,start:long,end:long,score:double>>"
    return arrow_map(texts, _found, with_id(texts, f"masked string, spans {spans}"))


def digest(spans: list[tuple[str, int, int, float]]) -> str:
    """Reference form of the listing: kind:start:end joined by commas, hashed."""
    return hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e, *_ in spans).encode()).hexdigest()
