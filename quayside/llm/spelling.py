"""Spelling variants of words by permuterm rotations.

A word with a terminator is turned so that each of its letters comes last once; what stands before that letter is the
rotation's prefix. Words of one prefix differ by a replaced letter at one place, and the word that is the whole prefix
(turned likewise) lacks that letter. Rotations are dealt and sorted by prefix and each group is scanned once: a member's
neighbours are counted from the group's size and its best neighbour is the group's first or second, so no pairs are made.
A letter of a run of equal letters is a missing letter only at the run's first place, so that two words meet once.

A group has at most one word for each letter of the alphabet, and the word without it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import discard, stored

#: Letters of a word; all are single UTF-16 units, so lengths are code points.
RUN = "[A-Za-zÀ-ÿ]+"
END = "$"  # not a letter, sorts before all letters
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def edited_runs(df: DataFrame, id_col: str, text_col: str, every: int) -> DataFrame:
    """(word) for each letter run of each text, lower-cased in A-Z; where ``every`` divides the CRC-32 of "<id>:<run>"
    one letter is left out. A null text has no runs, a null id counts as an empty one."""
    text = F.translate(F.col(text_col).cast("string"), UPPER, LOWER)
    owner = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    runs = df.select(owner.alias("owner"), F.explode(F.regexp_extract_all(text, F.lit(RUN), F.lit(0))).alias("run"))
    runs = runs.withColumn("h", F.crc32(F.concat("owner", F.lit(":"), "run").cast("binary")))
    at = (F.col("h") % F.length("run")).cast("int")
    left_out = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    return runs.select(F.when(F.col("h") % every == 0, left_out).otherwise(F.col("run")).alias("word"))


def rotations(words: DataFrame) -> DataFrame:
    """(prefix, letter, first, n) of each word: for each letter the rotation that ends in it, split before it, and each
    whole rotation with an empty letter. ``first``: the letter before it in the word is another one."""
    size = F.length("word")
    skip = words.select("word", "n", F.explode(F.sequence(F.lit(1), size)).alias("at"))
    letter = F.substring("word", F.col("at"), F.lit(1))
    before = F.when(F.col("at") == 1, "").otherwise(F.substring("word", F.col("at") - 1, F.lit(1)))
    skip = skip.select(_turned(F.col("at"), F.col("at") - 1).alias("prefix"), letter.alias("letter"), (letter != before).alias("first"), "n")
    whole = words.select("word", "n", F.explode(F.sequence(F.lit(0), size)).alias("at"))
    whole = whole.select(_turned(F.col("at"), F.col("at")).alias("prefix"), F.lit("").alias("letter"), F.lit(False).alias("first"), "n")
    return skip.unionByName(whole)


def _turned(behind: Column, ahead: Column) -> Column:
    """The word's letters after the first ``behind``, the terminator, and its first ``ahead`` letters."""
    return F.concat(F.substring("word", behind + 1, F.length("word")), F.lit(END), F.substring("word", F.lit(1), ahead))


def _first(members: Column) -> Column:
    return F.get(members, F.lit(0))["by"]


def neighbours(words: DataFrame) -> DataFrame:
    """(word, n_near, best) for the words (word, n) that have a near one; ``best`` is the near word with the largest n,
    of equal ones the first, as a struct (less: -n, word)."""
    letter = F.col("letter")
    word = F.concat(F.substring_index("prefix", END, -1), letter, F.substring_index("prefix", END, 1))
    rows = rotations(words).select("prefix", "letter", "first", F.struct((-F.col("n")).alias("less"), word.alias("word")).alias("by"))
    member = F.struct("by", "letter", "first")
    groups = rows.groupBy("prefix").agg(F.array_sort(F.collect_list(member)).alias("all")).where("size(all) > 1")
    groups = groups.select(
        F.filter("all", lambda m: m["letter"] != "").alias("skip"),
        _first(F.filter("all", lambda m: m["letter"] == "")).alias("whole"),
    ).withColumn("first", F.filter("skip", lambda m: m["first"]))
    whole = F.col("whole")

    def seen(m: Column) -> Column:
        best, next_best = _first(F.col("skip")), F.get("skip", F.lit(1))["by"]
        other = F.when(m["by"]["word"] == best["word"], next_best).otherwise(best)
        near = F.size("skip") - 1 + F.when(m["first"] & whole.isNotNull(), 1).otherwise(0)
        return F.struct(m["by"]["word"].alias("word"), near.alias("near"), F.least(other, F.when(m["first"], whole)).alias("best"))

    longer = F.struct(whole["word"].alias("word"), F.size("first").alias("near"), _first(F.col("first")).alias("best"))
    emitted = F.filter(F.concat(F.transform("skip", seen), F.array(longer)), lambda e: e["word"].isNotNull() & (e["near"] > 0))
    found = groups.select(F.explode(emitted).alias("e")).select("e.*")
    return found.groupBy("word").agg(F.sum("near").alias("n_near"), F.min("best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for (word, form): the end of the chain of forms. Each round doubles the steps taken, so rounds grow
    with the logarithm of the longest chain; a form is at least twice as frequent, so there are no circles."""
    now = stored(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        on = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = now.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        moved = stored(moved, "spelling-roots")
        discard(now)
        now = moved
        if now.where("moved").isEmpty():
            return now.select("word", "root")


def spelling_variants(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = 5, least_n: int = 3, every: int = 97, times: int = 2
) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of the words of at least ``least_length`` letters that occur at least
    ``least_n`` times.

    A word's form is its most frequent near word (one letter inserted, deleted or replaced) if that is at least
    ``times`` as frequent, its root the end of the chain of forms. Texts that are null, empty or without letters add no
    words; repeated rows count again; no rows give no words; other columns are ignored. A run without a limit of length
    is a word like any other: a word of L letters has 2 L + 1 rotations of L letters."""
    words = edited_runs(df, id_col, text_col, every).where(F.length("word") >= least_length)
    words = stored(words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_n), "spelling-words")
    near = words.join(neighbours(words), "word", "left")
    enough = -F.col("best.less") >= times * F.col("n")
    near = near.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(enough, F.col("best.word")).alias("form"), F.when(enough, -F.col("best.less")).alias("form_n"),
    )
    near = stored(near, "spelling-forms")
    discard(words)
    ends = roots(near.where("form is not null"))
    out = near.join(ends, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
