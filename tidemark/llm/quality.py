"""Operator 2 (DataFrame functions only): quality rules and a hashed n-gram likelihood ratio.

A document fails the base rules if it is short or repeats itself. Of the others, those are
kept whose words and word pairs are, on average, likelier in the trusted documents (labelled
``quality = 1``) than in the whole corpus. Words and pairs are hashed to ``BUCKETS`` cells;
the two multinomials are smoothed counts of the cells over all documents, so the model is as
large for any corpus. Log ratios are whole millionths, so that a document's sum does not
depend on the order of addition and the threshold falls the same way every time.

Every text is read whole, twice. Word rows exist only between a scan and the aggregate that
follows it in the same stage: what is shuffled is a row a cell, and a row a document.

Defined results: a null or empty text has no words and fails; repeated rows are judged each;
a label without a document, and a null label, count for nothing; a document labelled twice is
trusted if one label says so; without any trusted document all ratios compare with an even
spread; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 10_000
SCALE = 1_000_000
#: Least mean log ratio of a kept document, in millionths.
THRESHOLD = -40_000

SPACE = r"[\x20\x09-\x0D]+"


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda x: x != "")


def _repeat_words(df: DataFrame) -> DataFrame:
    """Adds ``n_repeat_words`` from the words ``w`` and their number ``n_words``.

    Three-word windows become one number each, the hash above the place, with as many bits
    for places as the document needs. Sorted, equal windows are neighbours; the words
    themselves are compared to be sure. Places of repeats, sorted, give the words covered.
    """
    bits = F.ceil(F.log2(F.col("n_words") + 1)).cast("int")
    df = df.withColumn("bits", bits)
    packed = F.expr(
        "sort_array(transform(slice(w, 1, greatest(n_words - 2, 0)),"
        " (x, i) -> shiftleft(xxhash64(x, w[i + 1], w[i + 2]), bits) | cast(i as bigint)))"
    )
    df = df.withColumn("s", F.when(F.col("n_words") >= 3, packed).otherwise(F.expr("array()").cast("array<bigint>")))
    df = df.withColumn("mask", F.expr("shiftleft(1L, bits) - 1"))
    place = "cast({} & mask as int)"
    equal = (
        "(shiftright({a}, bits) = shiftright({b}, bits) and w[{pa}] = w[{pb}]"
        " and w[{pa} + 1] = w[{pb} + 1] and w[{pa} + 2] = w[{pb} + 2])"
    )
    before, after = "get(s, j - 1)", "get(s, j + 1)"
    same = [equal.format(a="v", b=o, pa=place.format("v"), pb=place.format(o)) for o in (before, after)]
    again = f"filter(s, (v, j) -> coalesce(j > 0 and {same[0]}, false) or coalesce(j < size(s) - 1 and {same[1]}, false))"
    df = df.withColumn("r", F.expr(f"sort_array(transform({again}, v -> v & mask))"))
    covered = "aggregate(transform(r, (v, j) -> least(3L, coalesce(get(r, j + 1), v + 3) - v)), 0L, (a, x) -> a + x)"
    return df.withColumn("n_repeat_words", F.when(F.size("r") > 0, F.expr(covered)).otherwise(F.lit(0).cast("long")))


def base_rules(docs: DataFrame) -> DataFrame:
    """``doc_id, w`` and the counts that the base rules use."""
    text = F.coalesce(F.col("text"), F.lit(""))
    df = docs.select("doc_id", text.alias("t")).withColumn("w", words_of(F.col("t")))
    lines = F.filter(F.split("t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    df = df.select(
        "doc_id",
        "w",
        F.size("w").cast("long").alias("n_words_long"),
        F.size("w").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        (F.length("t") - F.length(F.translate("t", "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        lines.alias("lines"),
    )
    df = df.withColumn("n_dup_lines", (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long")).drop("lines")
    df = _repeat_words(df)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words_long"))
    return df.select(
        "doc_id", "w", F.col("n_words_long").alias("n_words"), "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"),
    )


def _bucket(gram: Column) -> Column:
    return F.pmod(F.crc32(gram.cast("binary")), F.lit(BUCKETS)).cast("int")


def _grams(df: DataFrame, *cols: str) -> DataFrame:
    """A row a word: ``one`` and ``two``, the cells of the word and of it with the next."""
    rows = df.select(*cols, "w", F.posexplode("w").alias("i", "word"))
    pair = F.concat_ws(" ", F.col("word"), F.expr("get(w, i + 1)"))
    last = F.expr("i + 1 >= size(w)")
    return rows.select(*cols, _bucket(F.col("word")).alias("one"), F.when(~last, _bucket(pair)).alias("two"))


def log_ratios(docs: DataFrame, labels: DataFrame) -> list[int]:
    """For each cell the log of trusted over raw probability, in whole millionths."""
    trusted = labels.where("quality = 1").select(F.col("doc_id").alias("trusted_id")).distinct()
    # The same join for any number of labels; adaptive execution may split it.
    marked = docs.select("doc_id", "text").join(trusted.hint("merge"), F.col("doc_id") == F.col("trusted_id"), "left")
    marked = marked.select(F.col("trusted_id").isNotNull().alias("good"), words_of(F.col("text")).alias("w"))
    cells = _grams(marked, "good").select("good", F.explode(F.array("one", "two")).alias("cell")).where("cell is not null")
    # Two rows a cell, however large the corpus.
    counts = cells.groupBy("cell").agg(F.count(F.lit(1)).alias("raw"), F.count(F.when(F.col("good"), 1)).alias("target")).collect()
    raw, target = [0] * BUCKETS, [0] * BUCKETS
    for row in counts:
        raw[row["cell"]], target[row["cell"]] = row["raw"], row["target"]
    all_raw, all_target = sum(raw) + BUCKETS, sum(target) + BUCKETS
    return [round(SCALE * (math.log((t + 1) / all_target) - math.log((r + 1) / all_raw))) for r, t in zip(raw, target)]


def judge(docs: DataFrame, labels: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """Every document with its counts, ``mean_ratio`` and ``kept``."""
    # Folded to one constant array when the plan is made.
    table = F.split(F.lit(",".join(map(str, log_ratios(docs, labels)))), ",").cast("array<bigint>")
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    rows = base_rules(docs).withColumn("row_id", F.monotonically_increasing_id())
    rows = rows.select("row_id", "doc_id", *counts, "w")
    # The empty word stands for a document without words and adds nothing.
    filled = rows.withColumn("w", F.when(F.size("w") > 0, F.col("w")).otherwise(F.array(F.lit(""))))
    grams = _grams(filled, "row_id", "doc_id", *counts)
    worth = F.element_at(table, F.col("one") + 1) + F.coalesce(F.element_at(table, F.col("two") + 1), F.lit(0))
    sums = grams.groupBy("row_id", "doc_id", *counts).agg(F.sum(worth).alias("total"))
    grams_of = F.greatest(2 * F.col("n_words") - 1, F.lit(1))
    return sums.select(
        "doc_id",
        *counts,
        (~F.col("base_failed") & (F.col("total") >= F.lit(threshold) * grams_of)).alias("kept"),
        F.when(F.col("n_words") > 0, F.col("total") / grams_of / SCALE).alias("mean_ratio"),
    )
