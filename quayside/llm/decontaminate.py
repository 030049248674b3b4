"""Benchmark decontamination: short test items inside long documents, by size-partitioned MinHash containment.

A document contains an item if at least ``percent`` of the item's word shingles occur in it. One hash orders all
shingles, and an item's sketch is its smallest hashes (its MinHashes). Items are partitioned by the size of their set,
because the sketch that suffices depends on it: of q shingles a containing document misses at most q minus the wanted
number, so one more than that many smallest hashes always leave one that the document has. Documents need no sketch of
their own size: per partition they are held against the sketches by those of their hashes that are not above the
partition's largest sketch hash, and only if they have enough shingles for its items. So candidates are complete, and
the exact containment of each is then counted on the shingles themselves, not on hashes.

DataFrame functions only; the documents' text is not shuffled unless the candidates are too many to broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import small, stored

WORDS = 5


def word_list(text: Column) -> Column:
    """Words (runs without space, tab and line ends) with A-Z lower-cased; none for a null."""
    low = F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.array_remove(F.split(low, r"[\x20\x09-\x0D]+"), "")


def _starts(words: Column, size: int) -> Column:
    """Places of the first words of all shingles of that size, from 1."""
    count = F.size(words) - size + 1
    return F.when(count > 0, F.sequence(F.lit(1), F.greatest(count, F.lit(1)))).otherwise(F.array().cast("array<int>"))


def shingle_hashes(words: Column, size: int) -> Column:
    def one(i: Column) -> Column:
        return F.xxhash64(F.lit(size), *[F.get(words, i + (j - 1)) for j in range(size)])

    return F.transform(_starts(words, size), one)


def shingle_texts(words: Column, size: Column) -> Column:
    count = F.size(words) - size + 1
    starts = F.when(count > 0, F.sequence(F.lit(1), F.greatest(count, F.lit(1)))).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(starts, lambda i: F.array_join(F.slice(words, i, size), " ")))


def contained_items(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", item_col: str = "item_id", text_col: str = "text",
    words_in_shingle: int = WORDS, percent: int = 80,
) -> DataFrame:
    """(id_col, item_col, n_common, n_item): each item that a document contains, and how many of its shingles.

    Texts are words with A-Z lower-cased. An item of fewer words than a shingle is looked for as a whole; an item
    without words or with a null id is in no document. A null or empty document contains nothing. Of repeated rows the one with the
    most common shingles counts. Documents with a null id are searched too and share the null id. Other columns are
    ignored; empty tables give an empty result."""
    wanted = items.where(F.col(item_col).isNotNull()).select(F.col(item_col).alias("item"), word_list(F.col(text_col)).alias("w"))
    wanted = wanted.where(F.size("w") > 0).withColumn("size", F.least(F.size("w"), F.lit(words_in_shingle)))
    wanted = wanted.withColumn("texts", shingle_texts(F.col("w"), F.col("size")))
    sizes = sorted(r[0] for r in wanted.select("size").distinct().collect())  # at most words_in_shingle numbers
    hashes = F.lit(None).cast("array<long>")
    for n in sizes:
        hashes = F.when(F.col("size") == n, F.array_distinct(shingle_hashes(F.col("w"), n))).otherwise(hashes)
    wanted = wanted.withColumn("h", F.array_sort(hashes)).withColumn("q", F.size("texts"))
    # the number of shingles that a containing document has, rounded up
    wanted = wanted.withColumn("need", F.expr(f"cast((q * {percent} + 99) div 100 as int)"))
    sketch = wanted.select(
        "item", "size", "need", F.ceil(F.log2("q")).alias("part"), F.explode(F.expr("slice(h, 1, q - need + 1)")).alias("h")
    )
    sketch = stored(sketch, "decontaminate-sketch")
    parts = sketch.groupBy("size", "part").agg(F.max("h").alias("top"), F.min("need").alias("need")).collect()

    texts = docs.select(F.col(id_col).alias("id"), word_list(F.col(text_col)).alias("w"))
    # by shingle size, the limits of all partitions that a document is large enough for: few numbers, part of the plan
    kept = []
    for n in sizes:
        own = [r for r in parts if r["size"] == n]
        count = F.size("w") - n + 1
        limit = F.greatest(*[F.when(count >= r["need"], F.lit(r["top"])) for r in own], F.lit(-(1 << 63)))
        kept.append(_below(shingle_hashes(F.col("w"), n), limit))
    if not kept:
        kept = [F.array().cast("array<long>")]
    own = texts.select("id", F.explode(F.concat(*kept)).alias("h"))
    hits = own.join(small(sketch.select("item", "h")), "h").select("id", "item").distinct()
    pairs = stored(hits, "decontaminate-pairs")

    exact = wanted.select("item", "size", "q", "need", F.col("texts").alias("item_texts"))
    found = texts.join(small(pairs).withColumnRenamed("id", "pair_id"), F.col("id").eqNullSafe(F.col("pair_id")))
    found = found.join(small(exact, F.col("q")), "item")
    common = F.size(F.array_intersect(shingle_texts(F.col("w"), F.col("size")), F.col("item_texts")))
    found = found.select("id", "item", "need", "q", common.alias("common")).where("common >= need")
    found = found.groupBy("id", "item").agg(F.max("common").cast("long").alias("n_common"), F.max("q").cast("long").alias("n_item"))
    return found.select(F.col("id").alias(id_col), F.col("item").alias(item_col), "n_common", "n_item")


def _below(hashes: Column, limit: Column) -> Column:
    return F.filter(hashes, lambda h: h <= limit)


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", item_col: str = "item_id", **more) -> DataFrame:
    """(id_col, contaminated, n_items, items), one row for each row of ``docs``; ``items`` lists ids in order."""
    found = contained_items(docs, items, id_col, item_col, **more)
    listed = found.groupBy(F.col(id_col).alias("_id")).agg(F.array_sort(F.collect_list(item_col)).alias("items"))
    ids = docs.select(F.col(id_col))
    out = ids.join(listed, F.col(id_col).eqNullSafe(F.col("_id")), "left")
    return out.select(
        id_col, F.col("items").isNotNull().alias("contaminated"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items", F.array().cast(listed.schema["items"].dataType)).alias("items"),
    )
