"""Spelling variants, language-model scores and token alignment against brute force, and their results for awkward input."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest

from quayside.llm import alignment, common, scoring, spelling
from quayside.llm.queries import byte_vocabulary, piece_model
from tests.llm.test_llm_operators import frame, lower, prose

SF = "/root/testdata/sf0.001"


# ------------------------------------------------------------------ 11 spelling


def brute_variants(rows, least_length=5, least_n=3, every=97):
    count = collections.Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = lower(run)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % every == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            count[w] += 1
    words = {w: n for w, n in count.items() if len(w) >= least_length and n >= least_n}
    letters = {c for w in words for c in w}
    out = {}
    for w, n in words.items():
        other = {w[:i] + c + w[i + k :] for i in range(len(w) + 1) for c in letters | {""} for k in (0, 1)} - {w}
        near = sorted((x for x in other if x in words), key=lambda x: (-words[x], x))
        form = near[0] if near and words[near[0]] >= 2 * n else None
        out[w] = (form, n, len(near), words[form] if form else None)

    def root(w):
        while out[w][0]:
            w = out[w][0]
        return w

    return {w: (v[0], root(w), *v[1:]) for w, v in out.items()}


def variants(df, **kw):
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in spelling.spelling_variants(df, **kw).collect()}


def test_variants_against_brute_force(spark):
    rng = random.Random(5)
    texts = [" ".join("".join(rng.choice("abÀé") for _ in range(rng.randint(1, 7))) for _ in range(400)) for _ in range(12)]
    texts += [None, "", "123 !?", "Aaaaa aaaaa aaaa aaaaaa", "x" * 3000 + " abcde ABCDE Kmbcde"]
    rows = list(enumerate(texts))
    for every in (97, 3):
        got = variants(frame(spark, texts), every=every, least_length=3)
        want = brute_variants(rows, every=every, least_length=3)
        assert got == want and any(v[0] for v in want.values()) and any(v[1] != v[0] and v[0] for v in want.values())


def test_variants_of_the_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert variants(docs) == brute_variants([tuple(r) for r in docs.select("doc_id", "text").collect()])


def test_variants_of_odd_rows(spark):
    texts = ["letter lettre letters leter"] * 4 + ["letter"] * 8
    ids = [1, 1, None, 2, *range(10, 18)]
    got = variants(frame(spark, texts, ids), every=10**9)
    assert got["letters"] == ("letter", "letter", 4, 1, 12) and got["leter"][0] == "letter" and got["lettre"] == (None, "lettre", 4, 0, None)
    assert variants(frame(spark, [])) == {}


def test_roots_of_a_long_chain(spark):
    chain = spark.createDataFrame([(f"w{i}", f"w{i + 1}") for i in range(20)], "word string, form string")
    assert {tuple(r) for r in spelling.roots(chain).collect()} == {(f"w{i}", "w20") for i in range(20)}


# ------------------------------------------------------------------ 12 scores


def brute_scores(rows, folds=10):
    toks = [re.findall(r"[^\x20\x09-\x0D]+", lower(t or "")) + [None] for _, t in rows]
    held = [zlib.crc32(("" if i is None else str(i)).encode()) % folds == 0 for i, _ in rows]
    one = collections.Counter(w for t, h in zip(toks, held, strict=True) if not h for w in t)
    two = collections.Counter(p for t, h in zip(toks, held, strict=True) if not h for p in zip([None, *t], t, strict=False))
    total, base = sum(one.values()), lambda w: (one[w] + 0.1) / (sum(one.values()) + 0.1 * (len(one) + 1))
    least = lambda n: int(scoring.LEVELS[scoring.LEVELS <= n].max()) if n else 0
    out = []
    for t, h in zip(toks, held, strict=True):
        pairs = list(zip([None, *t], t, strict=False))
        s = sum(math.log10((least(two[a, b]) + scoring.MASS * base(b)) / (one[a] + scoring.MASS)) for a, b in pairs)
        out.append((h, len(t), sum(one[w] > 0 for w in t), total, sum(math.log10(base(w)) for w in t), s))
    return out


@pytest.mark.parametrize("settings", [{}, {"block_bytes": 500}, {"filter_bits": 1 << 16, "block_bytes": 4000}])
def test_scores_against_brute_force(spark, settings):
    texts = [prose(i, 60) for i in range(30)] + [None, "", " \n", "One one ONE", "é" * 200, "w " * 5000]
    got = {r["doc_id"]: tuple(r)[1:] for r in scoring.score_texts(frame(spark, texts), **settings).collect()}
    want = brute_scores(list(enumerate(texts)))
    assert len(got) == len(texts)
    for i, w in enumerate(want):
        assert got[i][:4] == w[:4] and math.isclose(got[i][4], w[4], rel_tol=1e-9), i
        # a small filter may answer for pairs that were never entered
        assert math.isclose(got[i][5], w[5], rel_tol=1e-9) if "filter_bits" not in settings else got[i][5] >= w[5] - 1e-9, i


def test_scores_of_held_out_documents(spark):
    rows = scoring.score_texts(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).where("held_out").collect()
    assert sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows) * 0.9 and all(r["score"] < 0 for r in rows)


def test_scores_of_odd_rows(spark):
    texts = ["a b c", "a b c", "a b d", None]
    rows = [tuple(r) for r in scoring.score_texts(frame(spark, texts, [5, 5, None, None])).collect()]
    want = brute_scores(list(zip([5, 5, None, None], texts, strict=True)))
    assert sorted(str(tuple(round(x, 9) if isinstance(x, float) else x for x in r[1:])) for r in rows) == sorted(str(tuple(round(x, 9) if isinstance(x, float) else x for x in w)) for w in want)
    assert scoring.score_texts(frame(spark, [])).count() == 0
    assert [r["score"] for r in scoring.score_texts(frame(spark, ["x"], [None])).collect()] == [0.0]  # nothing was learned


def test_filter_never_passes_the_driver_at_once(spark, monkeypatch):
    df = frame(spark, [prose(i, 60) for i in range(10)])
    kind, columns = type(df), []
    collect = kind.collect
    monkeypatch.setattr(kind, "collect", lambda self: (columns.extend(self.columns), collect(self))[1])
    scored = scoring.score_texts(df)
    assert columns and "bits" not in columns
    assert len(scored.collect()) == 10


def test_levels_never_promise_more(spark):
    n = np.arange(1, 5000)
    assert (scoring.LEVELS[np.searchsorted(scoring.LEVELS, n, "right") - 1] <= n).all()


def test_hashes_of_structured_words():
    """A word and its letter-wise complement whose sums of parts cancel in any polynomial modulo 2 ** 64."""
    word = "a"
    for _ in range(11):
        word += word.translate(str.maketrans("ab", "ba"))
    other = word.translate(str.maketrans("ab", "ba"))
    data = np.frombuffer(f"{word} {other} {word.upper()}".encode(), np.uint8)
    h, _, start, end = common.words(data, np.array([0, len(data)]))
    assert h[0] == h[2] != h[1] and (end - start).tolist() == [2048] * 3


# ------------------------------------------------------------------ 13 alignment


@pytest.fixture(scope="module")
def libraries():
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(byte_vocabulary())
    a.encode_special_tokens = True
    return a, SentencePieceProcessor(model_file=piece_model())


def brute_alignment(libraries, texts):
    one, two = libraries
    letters = alignment.byte_letters()
    a_bytes = {i: bytes(letters[c] for c in t) for t, i in one.get_vocab().items() if i < 50256}

    def b_bytes(i):
        p = two.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if two.is_byte(i) else p.replace("▁", " ").encode()

    found, held = [], collections.Counter()
    for t in texts:
        data = (" " + t).encode() if t else b""
        a = [(i, a_bytes[i]) for i in one.encode(" " + t, add_special_tokens=False).ids] if t else []
        b = [(i, b_bytes(i)) for i in two.encode(t)] if t else []
        if not t or b"".join(x for _, x in a) != data or b"".join(x for _, x in b) != data:
            found.append(None)
            continue
        ends_a, ends_b = (np.cumsum([len(x) for _, x in tokens]) for tokens in (a, b))
        groups, before = [], 0
        for end in sorted(set(ends_a.tolist()) & set(ends_b.tolist())):
            groups.append(tuple([i for (i, _), e in zip(tokens, ends, strict=True) if before < e <= end] for tokens, ends in ((a, ends_a), (b, ends_b))))
            before = end
        found.append((len(a), len(b), groups))
        held.update({(p, q) for x, y in groups for p in x for q in y})
    best = collections.defaultdict(int)
    for (p, _), n in held.items():
        best[p] = max(best[p], n)
    out = []
    for f in found:
        if f is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        links = [(p, q) for x, y in f[2] for p in x for q in y]
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in f[2])
        out.append((f[0], f[1], len(f[2]), len(links), sum(held[k] == best[k[0]] for k in links), sum(held[k] for k in links), hashlib.sha256(text.encode()).hexdigest()))
    return out


def odd_texts():
    rng = random.Random(3)
    texts = [
        "", None, "a▁b", "<|endoftext|> x", "<s> it's</s>", "  ", " a  b ", "中文没有空格，但有标点。" * 30, "'s'll " * 20,
        "\x00\n\t x", "😀éß" * 10, "aaaaaaaab" * 60, "x", "日本語テキスト" * 40 + " ab1c2 d3" * 9, "<unk> ⁇", "​﻿zero　wide",
        "ab " * 2 + "--==::" * 30 + "1234567890" * 30, "ab " * 2 + "--==::" * 30 + "1234567890" * 30,
    ]
    return texts + ["".join(rng.choice("ab '\n1中。é😀-_ st") for _ in range(rng.randrange(1, 300))) for _ in range(40)]


@pytest.mark.parametrize("settings", [{}, {"range_bytes": 40, "block_bytes": 3000}])
def test_alignment_against_the_libraries(spark, libraries, settings):
    texts = odd_texts()
    df = alignment.align_tokens(frame(spark, texts), byte_vocabulary(), piece_model(), **settings)
    got = {r["doc_id"]: tuple(r)[1:] for r in df.collect()}
    for i, want in enumerate(brute_alignment(libraries, texts)):
        assert got[i] == want, (i, texts[i])


def test_alignment_of_the_documents(spark, libraries):
    rows = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 60").select("doc_id", "text")
    got = {r["doc_id"]: tuple(r)[1:] for r in alignment.align_tokens(rows, byte_vocabulary(), piece_model()).collect()}
    known = rows.orderBy("doc_id").collect()
    assert [got[r["doc_id"]] for r in known] == brute_alignment(libraries, [r["text"] for r in known])


def test_alignment_of_odd_rows(spark):
    rows = alignment.align_tokens(frame(spark, ["same text"] * 3, [7, 7, None]), byte_vocabulary(), piece_model()).collect()
    assert len({tuple(r)[1:] for r in rows}) == 1 and rows[0]["count_sum"] == 3 * rows[0]["n_links"]
    assert alignment.align_tokens(frame(spark, []), byte_vocabulary(), piece_model()).count() == 0
    with pytest.raises(ValueError, match="range_bytes"):
        alignment.align_tokens(frame(spark, ["x"]), byte_vocabulary(), piece_model(), range_bytes=1 << 20)


def random_fragments(rng):
    ends = [sorted(rng.sample(range(1, 60), rng.randint(5, 30))) + [60] for _ in "ab"]
    a, b = (alignment.Tokens(np.arange(len(e)), np.array(e)) for e in ends)
    cuts = [[-1, *sorted(rng.choice(e) for _ in range(4)), alignment.FAR] for e in ends]
    parts = [alignment.fragment(a.part(*cuts[0][i : i + 2]), b.part(*cuts[1][i : i + 2]), i == 0) for i in range(5)]
    return a, b, parts


def test_composition_is_associative():
    same = lambda f: (f.cut, *(t.ends.tolist() for side in (f.head, f.tail) for t in side))
    for seed in range(300):
        a, _, parts = random_fragments(random.Random(seed))
        for i in range(3):
            x, y, z = (f for f, _ in parts[i : i + 3])
            assert same(alignment.compose(alignment.compose(x, y)[0], z)[0]) == same(alignment.compose(x, alignment.compose(y, z)[0])[0])
        now, closed = parts[0]
        n = len(closed[0].ids)
        for f, closed in parts[1:]:
            now, met = alignment.compose(now, f)
            n += len(closed[0].ids) + len(met[0].ids)
        assert n == len(a.ids) and not len(now.head[0].ids) and not len(now.tail[0].ids)


def test_wide_groups_count_all_links():
    class Two:
        n_a, n_b, names = 10, 10, [f"{i}{m}" for m in ",|,;" for i in range(10)]
        a_size, b_size = np.full(10, 2), np.full(10, 3)

    a = alignment.Tokens(np.arange(60) % 4, np.concatenate([np.arange(1, 60) * 10 + 1, [600]]))
    b = alignment.Tokens(np.arange(60) % 3, np.concatenate([np.arange(1, 60) * 10, [600]]))
    found = alignment.closed_groups(Two(), a, b, np.array([60]), np.array([60]))
    assert found.groups.tolist() == [1] and found.links.tolist() == [3600] and found.times.tolist() == [300] * 12
