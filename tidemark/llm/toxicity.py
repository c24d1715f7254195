"""Operator 4: toxicity by a weighted lexicon, matched in one pass by an automaton.

* **Folding.** Letters that look like Latin ones, full-width forms, and digits and signs used
  as letters become those letters; case is dropped.
* **Lexicon.** Words and word beginnings of the labelled documents, weighted by the log of
  their rate in toxic over that in other documents; the ``LEXICON`` most significant ones.
  The counts are taken over all labelled documents of the training folds.
* **Exceptions.** A lexicon word with the word before or after it, if such phrases stand in
  harmless documents: a match inside a phrase does not count.
* **Score.** The weights of the matches (the heaviest at each place), divided by a power of
  the number of words, through a logistic curve. Power and curve are fitted to the training
  documents, at most about ``FIT_ROWS`` of them, chosen by a hash.

Matching is by Aho-Corasick: the time does not depend on the size of the lexicon. A word
matches between two non-letters, a beginning after one.

Defined results: a null or empty text has no matches and the score of a clean document; rows
without doc_id are scored but never learned from; if a document is labelled twice, one toxic
label marks it; repeated rows are scored each; without training labels every score is 0;
other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tidemark.llm.blocks import release_memory, small_batches
from tidemark.llm.tables import BATCH_BYTES, SMALL_BATCH, setting, stored

LEXICON = 3000
EXCEPTIONS = 2000
FIT_ROWS = 50_000
PREFIXES = (5, 6, 7)
#: Least log-likelihood ratio statistic and least weight of an entry.
SIGNIFICANT = 20.0
LEAST_WEIGHT = 2.0
POWERS = (0.0, 0.25, 0.5, 1.0)

# Letters of other scripts and what they look like, then digits and signs.
HOMOGLYPHS = str.maketrans(
    "аеорсухіјѕԁһӏкмтнвАВЕКМНОРСТУХІЈЅαονρτικυεΑΒΕΖΗΙΚΜΝΟΡΤΥΧ",
    "aeopcyxijsdhlkmthbABEKMHOPCTYXIJSaovptikueABEZHIKMNOPTYX",
)
FULL_WIDTH = {0xFF01 + i: 0x21 + i for i in range(94)}
DIGITS = str.maketrans("0134578", "oieastb")
SIGNS = {"@": "a", "$": "s", "!": "i"}

FOLD = {**HOMOGLYPHS, **FULL_WIDTH}
SIGN_IN_WORD = re.compile(r"(?<=[^\W\d_])[@$!](?=[^\W\d_])|(?<!\S)[@$](?=[^\W\d_])")
WORD = re.compile(r"[^\W\d_]+")


def folded(text: str | None) -> str:
    if not text:
        return ""
    if not text.isascii():
        text = text.translate(FOLD)
    text = text.lower().translate(DIGITS)
    return SIGN_IN_WORD.sub(lambda m: SIGNS[m[0]], text) if "@" in text or "$" in text or "!" in text else text


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))


class Lexicon:
    """Entries ``word`` or ``beginning*`` with weights, and phrases that excuse a match."""

    def __init__(self, weights: dict[str, float], phrases: list[str]):
        self.weights, self.phrases = weights, phrases
        self.automaton = None

    def __getstate__(self):
        return {"weights": self.weights, "phrases": self.phrases, "automaton": None}

    def _build(self):
        self.automaton = ahocorasick.Automaton()
        entries: dict[str, list] = {}
        for term, weight in self.weights.items():
            entries.setdefault(term.rstrip("*"), []).append((term.endswith("*"), weight, term))
        for phrase in self.phrases:
            entries.setdefault(phrase, []).append((False, None, phrase))
        for text, found in entries.items():
            self.automaton.add_word(text, (len(text), found))
        self.automaton.make_automaton()

    def matches(self, text: str) -> list[tuple[int, int, float, str]]:
        """Start, end, weight and entry of the matches that count, one a place."""
        if not self.weights or not text:
            return []
        if self.automaton is None:
            self._build()
        at: dict[int, tuple[int, int, float, str]] = {}
        excused: list[tuple[int, int]] = []
        for last, (size, entries) in self.automaton.iter(text):
            start, end = last - size + 1, last + 1
            if start and text[start - 1].isalpha():
                continue
            bounded = end == len(text) or not text[end].isalpha()
            for beginning, weight, term in entries:
                if weight is None:
                    if bounded:
                        excused.append((start, end))
                elif (bounded or beginning) and (start not in at or at[start][2] < weight):
                    at[start] = (start, end, weight, term)
        if excused:
            return [m for m in at.values() if not any(a <= m[0] and m[1] <= b for a, b in excused)]
        return list(at.values())


def terms_of(text: str) -> set[str]:
    words = set(WORD.findall(text))
    return words.union(w[:n] + "*" for w in words for n in PREFIXES if len(w) > n)


def _counted(docs: DataFrame, terms) -> DataFrame:
    """``term, toxic, clean``: documents of either label that have each term."""
    schema = "term string, toxic long, clean long"
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def count(batches):
        for batch in batches:
            toxic, clean = Counter(), Counter()
            for text, label in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                (toxic if label else clean).update(terms(text))
            rows = ({"term": t, "toxic": toxic[t], "clean": clean[t]} for t in toxic.keys() | clean.keys())
            yield from small_batches(rows, arrow, 50_000)

    return docs.mapInArrow(count, schema).groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def learn_lexicon(training: DataFrame) -> Lexicon:
    """From folded ``text`` and ``toxic`` of the training documents."""
    totals = training.agg(F.coalesce(F.sum("toxic"), F.lit(0)).alias("t"), F.count(F.lit(1)).alias("n")).first()
    toxic, clean = totals["t"], totals["n"] - totals["t"]
    if not toxic or not clean:
        return Lexicon({}, [])
    rate = toxic / (toxic + clean)
    n = F.col("toxic") + F.col("clean")

    def part(x: Column, expected: Column) -> Column:
        return F.when(x > 0, x * F.log(x / expected)).otherwise(0.0)

    weight = F.log((F.col("toxic") + 0.5) / (toxic + 1)) - F.log((F.col("clean") + 0.5) / (clean + 1))
    statistic = 2 * (part(F.col("toxic"), n * rate) + part(F.col("clean"), n * (1 - rate)))
    scored = _counted(training, terms_of).withColumn("weight", weight).withColumn("statistic", statistic)
    chosen = scored.where((F.col("weight") >= LEAST_WEIGHT) & (F.col("statistic") >= SIGNIFICANT))
    rows = chosen.orderBy(F.col("statistic").desc(), "term").limit(LEXICON).collect()
    lexicon = Lexicon({r["term"]: r["weight"] for r in rows}, [])

    def phrases_of(text: str) -> set[str]:
        found = set()
        for start, _, _, _ in lexicon.matches(text):
            word = WORD.match(text, start)[0]
            end = start + len(word)
            before, after = text[max(0, start - 40) : start], text[end : end + 40]
            if m := re.search(r"[^\W\d_]+[ ]$", before):
                found.add(m[0] + word)
            if m := re.match(r"[ ][^\W\d_]+", after):
                found.add(word + m[0])
        return found

    harmless = _counted(training, phrases_of).withColumn("weight", weight)
    harmless = harmless.where((F.col("clean") >= 3) & (F.col("weight") < 0))
    rows = harmless.orderBy(F.col("clean").desc(), "term").limit(EXCEPTIONS).collect()
    return Lexicon(lexicon.weights, [r["term"] for r in rows])


def _features(df: DataFrame, lexicon: Lexicon, fold: bool, keep_text: bool = False) -> DataFrame:
    """The columns, text only if asked, with ``total`` weight of matches and ``n`` words."""
    others = [c for c in df.columns if c != "text" or keep_text]
    schema = StructType([df.schema[c] for c in others]).add("total", "double").add("n", "long")
    arrow = to_arrow_schema(schema)

    def measure(batches):
        for batch in batches:
            total, n = [], []
            for value in batch.column("text"):  # one text at a time
                text = folded(value.as_py()) if fold else value.as_py()
                total.append(float(math.fsum(m[2] for m in lexicon.matches(text))))
                n.append(len(text.split()))
            columns = [batch.column(c) for c in others] + [pa.array(total, pa.float64()), pa.array(n, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)
            release_memory()

    return df.mapInArrow(measure, schema)


def fit_curve(total: np.ndarray, n: np.ndarray, toxic: np.ndarray) -> tuple[float, float, float]:
    """Power of the length, slope and offset with the least log loss (Newton steps, small penalty)."""
    best = (math.inf, 0.0, 0.0, -50.0)
    for power in POWERS:
        x = total / np.maximum(n, 1) ** power
        scale = x.std() or 1.0
        a, b = 1.0, -1.0
        design = np.stack([x / scale, np.ones(len(x))], axis=1)
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(design @ (a, b), -30, 30)))
            gradient = design.T @ (p - toxic) + 1e-2 * np.array([a, b])
            hessian = (design * (p * (1 - p))[:, None]).T @ design + 1e-2 * np.eye(2)
            step = np.linalg.solve(hessian, gradient)
            step *= min(1.0, 2.0 / max(1e-12, np.abs(step).max()))
            a, b = a - step[0], b - step[1]
        p = np.clip(1 / (1 + np.exp(-np.clip(design @ (a, b), -30, 30))), 1e-9, 1 - 1e-9)
        loss = -(toxic * np.log(p) + (1 - toxic) * np.log(1 - p)).mean()
        best = min(best, (loss, power, a / scale, b))
    return best[1:]


class Scorer:
    def __init__(self, lexicon: Lexicon, power: float, slope: float, offset: float):
        self.lexicon, self.power, self.slope, self.offset = lexicon, power, slope, offset

    def column(self) -> Column:
        x = F.col("total") / F.pow(F.greatest("n", F.lit(1)).cast("double"), F.lit(self.power))
        return 1 / (1 + F.exp(-(x * self.slope + self.offset)))

    def scored(self, docs: DataFrame, *columns: str, keep_text: bool = False) -> DataFrame:
        return _features(docs.select(*columns, "text"), self.lexicon, True, keep_text).withColumn("score", self.column())


def learn(docs: DataFrame, labels: DataFrame, folds: int = 5, fold: int = 0) -> Scorer:
    """A scorer learned from the labelled documents outside the held-out fold."""
    marks = labels.where("toxic is not null").groupBy(F.col("doc_id").alias("label_id")).agg(F.max("toxic").cast("long").alias("toxic"))
    rows = docs.select("doc_id", "text").where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"), folds, fold))
    # The same join for any number of labels; adaptive execution may split it.
    rows = rows.join(marks.hint("merge"), F.col("doc_id") == F.col("label_id")).select("doc_id", "text", "toxic")
    schema = StructType.fromDDL("doc_id long, text string, toxic long")
    arrow = to_arrow_schema(schema)

    def fold_texts(batches):
        for batch in batches:
            texts = pa.array((folded(t.as_py()) for t in batch.column("text")), pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), texts, batch.column(2)], schema=arrow)

    with setting(docs.sparkSession, BATCH_BYTES, SMALL_BATCH):
        training = stored(rows.mapInArrow(fold_texts, schema), "toxicity-training")
    lexicon = learn_lexicon(training)
    n = training.count()
    part = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(min(1.0, FIT_ROWS / max(1, n)) * (1 << 20))
    fit = _features(training.where(part).select("toxic", "text"), lexicon, False).toPandas()
    if not len(fit) or fit["toxic"].nunique() < 2:
        return Scorer(lexicon, 0.0, 0.0, -50.0)
    return Scorer(lexicon, *fit_curve(fit["total"].to_numpy(), fit["n"].to_numpy(float), fit["toxic"].to_numpy(float)))


def score_documents(docs: DataFrame, labels: DataFrame, folds: int = 5, fold: int = 0) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document."""
    scored = learn(docs, labels, folds, fold).scored(docs, "doc_id")
    return scored.select(
        "doc_id", held_out(F.col("doc_id"), folds, fold).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
