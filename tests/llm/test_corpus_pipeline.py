"""The pipeline against a plain-Python version of its stages, and its registration."""

import re

import __spark_entry__
import corpus_pipeline
from quayside.llm import personal
from quayside.llm.queries import piece_model
from tests.llm.test_llm_operators import brute_personal, sets_of, sha, word_list

SF = "/root/testdata/sf0.001"


def test_registered():
    names = list(__spark_entry__.queries())
    assert "pipeline" in names and {f"op{n}_" for n in range(1, 14)} == {m[0] for n in names if (m := re.match(r"op\d+_", n))}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near_dedup", "decontaminate", "personal_data", "sentencepiece"]


def test_run_against_brute_force(spark):
    from sentencepiece import SentencePieceProcessor

    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    items = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    # language: all of these documents are in one of the labelled languages
    kept = {i for i, r in docs.items() if r["text"] and re.search(r"[^\W\d_]", r["text"])}
    own = {i: sets_of(docs[i]["text"], 5) for i in kept}
    group = {i: i for i in kept}
    for _ in range(3):
        for i in kept:
            for j in kept:
                if own[i] and own[j] and 100 * len(own[i] & own[j]) >= 80 * len(own[i] | own[j]):
                    group[i] = group[j] = min(group[i], group[j])
    kept = {i for i in kept if group[i] == i}
    wanted = [sets_of(t, min(5, len(word_list(t)))) for t in items]
    kept = {i for i in kept if not any(100 * len(own[i] & q) >= 80 * len(q) for q in wanted)}
    library = SentencePieceProcessor(model_file=piece_model())
    got = {r["doc_id"]: r for r in corpus_pipeline.run(spark, SF).collect()}
    assert set(got) == kept and 20 < len(kept) < len(docs)
    for i, r in got.items():
        text = docs[i]["text"]
        spans = personal.find_spans(text)
        assert [s[:3] for s in spans if s[0] in personal.KINDS[: personal.BASE]] == brute_personal(text)
        ids = library.encode(personal.mask(text, spans))
        assert r["token_ids"] == ids and r["n_tokens"] == len(ids) and r["ids_sha256"] == sha(",".join(map(str, ids)))


def test_stages_on_odd_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    odd = spark.createDataFrame(
        [(1000, None, None, None, None), (1001, "", "en", "s", 0), (1002, "12345 !!", "en", "s", 8), (None, docs.first()["text"], "en", None, 5),
         (0, "another text under a known id", "en", "s", 29)], docs.schema,
    )
    mixed = docs.unionByName(odd).selectExpr("*", "'x' AS id", "'y' AS masked", "'z' AS kept")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, mixed, SF)
        assert out.columns == mixed.columns, name
        out.write.mode("overwrite").format("noop").save()
        assert stage(spark, mixed.limit(0), SF).count() == 0
    assert corpus_pipeline.language(spark, mixed, SF).where("doc_id IN (1000, 1001, 1002)").count() == 0
    once = corpus_pipeline.near_dedup(spark, mixed, SF)
    # two texts of one id both stay; the row without an id repeats the first document
    assert once.where("doc_id = 0").count() == 2 and once.where("doc_id IS NULL").count() == 0
    masked = corpus_pipeline.personal_data(spark, mixed, SF)
    assert masked.count() == mixed.count() and masked.where("text IS NULL").count() == 1
    assert corpus_pipeline.STAGES[-1][1](spark, mixed, SF).count() == mixed.count()


def test_contaminated_rows_leave_alone(spark):
    item = spark.read.parquet(f"{SF}/benchmark.parquet").where("length(text) > 40").first()["text"]
    texts = ["a clean text without an id", f"before {item} after", None, "another clean text", item, "clean under a shared id"]
    ids = [None, None, None, 1, 2, 2]
    docs = spark.createDataFrame([(i, t, "en", "x") for i, t in zip(ids, texts)], "doc_id long, text string, lang string, _row string")
    out = corpus_pipeline.decontaminate(spark, docs, SF)
    assert out.columns == docs.columns
    assert sorted(str(r["text"]) for r in out.collect()) == sorted(str(texts[i]) for i in (0, 2, 3, 5))


def test_rows_of_one_id_are_judged_by_their_texts(spark):
    long = " ".join(f"w{i}" for i in range(60))
    rows = [(1, None), (1, ""), (1, "words"), (2, None), (2, " "), (3, long), (3, "quite another text"), (4, long), (None, long + " more"), (None, "alone")]
    out = corpus_pipeline.near_dedup(spark, spark.createDataFrame(rows, "doc_id long, text string"), SF)
    assert sorted(out.collect(), key=str) == sorted((r for r in rows if r[0] != 4 and r[1] != long + " more"), key=str)


def test_text_that_all_languages_fit_equally_stays(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    odd = spark.createDataFrame([(1000, "a", None), (1001, "e", None), (1002, "\u4e2d\u6587" * 40, None)], docs.schema)
    out = corpus_pipeline.language(spark, docs.unionByName(odd), SF)
    assert {r["doc_id"] for r in out.where("doc_id >= 1000").collect()} == {1000, 1001}
