"""From raw documents to packed sequences, in five stages of the operators of ``tidemark.llm``.

Every stage takes ``(spark, docs, sf_dir)`` and all but the last give back the columns of
documents. Stages work on rows, whatever their ids: rows with a null or repeated doc_id stay
rows of their own, and columns of any name pass through. A null text is kept as it is. What a
stage stores on its way is emptied before it returns; its decisions and its rows stay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.contamination import contaminated
from tidemark.llm.neardup import near_duplicates
from tidemark.llm.packing import pack
from tidemark.llm.substrings import dedup_substrings
from tidemark.llm.tables import passing_tables, stored, table, with_rows
from tidemark.llm.toxicity import learn


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the scorer finds toxic go (operator 4)."""
    with passing_tables(spark):
        scorer = learn(docs, table(spark, sf_dir, "labels"))
    # The text goes to the scorer and back once, beside the row.
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("row"), "text")
    kept = scorer.scored(rows, "row", keep_text=True).where("score < 0.5")
    return kept.select(*[F.col("text") if c == "text" else F.col("row")[c].alias(c) for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates the document with the least doc_id stays (operator 5)."""
    rows = with_rows(docs, "near-rows")
    with passing_tables(spark) as kept:
        classes = near_duplicates(rows.select(F.col("row_id").alias("doc_id"), "text"))
        members = classes.select(F.col("doc_id").alias("row_id"), "class_row").join(rows.select("row_id", "row.doc_id"), "row_id")
        order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_id")
        first = kept(members.groupBy("class_row").agg(F.min(order).alias("first")).select("first.row_id"), "near-firsts")
    return rows.join(first, "row_id", "left_semi").select("row.*")


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated word sequences leave the texts that hold them (operator 7); other texts stay as they are."""
    rows = with_rows(docs, "substring-rows")
    with passing_tables(spark) as kept:
        found = dedup_substrings(rows.select(F.col("row_id").alias("doc_id"), "text"))
        changed = kept(found.where("n_removed > 0").select(F.col("doc_id").alias("row_id"), F.col("kept")), "changed-texts")
    joined = rows.join(changed, "row_id", "left")

    def value(name: str):
        own = F.col("row")[name]
        if name == "text":
            return F.coalesce("kept", own).alias(name)
        if name == "n_chars":
            return F.when(F.col("kept").isNotNull(), F.length("kept").cast(docs.schema[name].dataType)).otherwise(own).alias(name)
        return own.alias(name)

    return joined.select(*map(value, docs.columns))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go (operator 1)."""
    rows = with_rows(docs, "clean-rows")
    with passing_tables(spark) as kept:
        found = contaminated(rows.select(F.col("row_id").alias("doc_id"), "text"), table(spark, sf_dir, "benchmark"))
        held = kept(found.select(F.col("doc_id").alias("row_id")).distinct(), "contaminated-rows")
    return rows.join(held, "row_id", "left_anti").select("row.*")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, packed into sequences (operator 8)."""
    return pack(docs)


STAGES = [
    ("toxicity", toxicity),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: Stages learn, hash and tokenize; SQL cannot express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
