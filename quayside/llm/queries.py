"""The queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm.alignment import align_tokens
from quayside.llm.byte_repeats import remove_repeats
from quayside.llm.common import table
from quayside.llm.decontaminate import contaminated
from quayside.llm.language import identify
from quayside.llm.near_dup import near_duplicates
from quayside.llm.passages import passage_classes
from quayside.llm.personal import BASE as PERSONAL_BASE
from quayside.llm.personal import KINDS as PERSONAL_KINDS
from quayside.llm.personal import find_personal
from quayside.llm.piece_bpe import encode_texts
from quayside.llm.scoring import score_texts
from quayside.llm.secret_parts import KINDS as SECRET_KINDS
from quayside.llm.secret_parts import find_secrets
from quayside.llm.spelling import spelling_variants
from quayside.llm.syncmers import compare_with_edits
from quayside.llm.url_rules import judge_urls


def piece_model() -> str:
    """Where the public vocabulary of the SentencePiece query lies."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def byte_vocabulary() -> str:
    """Where the public byte-level vocabulary of the alignment query lies."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _listing(spans: Column) -> Column:
    """kind:start:end, joined by commas."""
    text = F.transform(
        spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    )
    return F.array_join(text, ",")


def _digest(df: DataFrame, kinds: tuple[str, ...]) -> DataFrame:
    """Counts of the base kinds, the hash of their listing, and the listing of all spans."""
    of = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    base = F.filter("spans", lambda s: s["kind"].isin(*kinds))
    return df.select(
        "doc_id", *[of(k) for k in kinds], F.sha2(_listing(base), 256).alias("base_sha256"),
        _listing(F.col("spans")).alias("spans"),
    )


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _digest(find_secrets(table(spark, sf_dir, "documents")), SECRET_KINDS[:3])


def op2_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passage_classes(table(spark, sf_dir, "documents"))


# host, path, action
URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, action string")
    return judge_urls(table(spark, sf_dir, "pages"), rules, "page_id", "url")


OP3_SQL = r"""
WITH u AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 1, 's'), ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 2, 's'), '') AS path
  FROM pages),
r(host, path, action) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'),
  ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block'))
SELECT u.page_id, u.host, u.path, f.rule, coalesce(f.action, 'allow') AS verdict
FROM u LEFT JOIN LATERAL (
  SELECT r.host || r.path AS rule, r.action FROM r
  WHERE (u.host = r.host OR suffix(u.host, '.' || r.host)) AND starts_with(u.path, r.path)
  ORDER BY length(r.host || r.path) DESC LIMIT 1) f ON true
"""


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), words_in_shingle=2)


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return identify(documents, documents)


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_with_edits(table(spark, sf_dir, "documents"))


def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _digest(find_personal(table(spark, sf_dir, "documents")), PERSONAL_KINDS[:PERSONAL_BASE])


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    items = F.array_join(F.transform("items", lambda i: i.cast("string")), ",")
    return found.select("doc_id", "contaminated", "n_items", items.alias("items"))


OP8_SQL = r"""
WITH w AS (
  SELECT 'd' AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 'b', item_id, text FROM benchmark),
l AS (
  SELECT kind, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM w),
s AS (
  SELECT DISTINCT kind, id, unnest([array_to_string(w[i:i + 4], ' ') for i in range(1, len(w) - 3)]) AS g FROM l),
q AS (SELECT id, count(*) AS n FROM s WHERE kind = 'b' GROUP BY id),
c AS (
  SELECT d.id AS doc_id, b.id AS item_id FROM s d JOIN s b ON d.g = b.g JOIN q ON q.id = b.id
  WHERE d.kind = 'd' AND b.kind = 'b' GROUP BY d.id, b.id, q.n HAVING 100 * count(*) >= 80 * q.n),
a AS (SELECT doc_id, count(*) AS n, string_agg(item_id, ',' ORDER BY item_id) AS items FROM c GROUP BY doc_id)
SELECT d.doc_id, a.n IS NOT NULL AS contaminated, coalesce(a.n, 0) AS n_items, coalesce(a.items, '') AS items
FROM documents d LEFT JOIN a ON a.doc_id = d.doc_id
"""


def op9_byte_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).drop("removed")


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_texts(table(spark, sf_dir, "documents"), piece_model(), ids=False)


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"))


def op12_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(table(spark, sf_dir, "documents"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_tokens(table(spark, sf_dir, "documents"), byte_vocabulary(), piece_model())


QUERIES = {
    "op1_secret_scan": op1_secret_scan,
    "op2_repeated_passages": op2_repeated_passages,
    "op3_url_filter": op3_url_filter,
    "op4_near_duplicates": op4_near_duplicates,
    "op5_language": op5_language,
    "op6_fingerprints": op6_fingerprints,
    "op7_personal_data": op7_personal_data,
    "op8_decontaminate": op8_decontaminate,
    "op9_byte_repeats": op9_byte_repeats,
    "op10_sentencepiece": op10_sentencepiece,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_lm_scores": op12_lm_scores,
    "op13_token_alignment": op13_token_alignment,
}
ORACLES = {"op3_url_filter": OP3_SQL, "op8_decontaminate": OP8_SQL}
