"""Operator 9: language by sparse multinomial logistic regression on character n-grams.

A text is the TF-IDF of its runs of one to three characters, case dropped, hashed to
``CELLS`` features: the share of a feature among the n-grams of the text, times the log of
how rare it is among the training documents. Document frequencies are counted over all of
them. The weights are learned by follow-the-regularised-leader with an elastic net, which
leaves most at zero, on about ``FIT_ROWS`` training documents chosen by a hash; a fifth of
those is kept back and a temperature is fitted to it, so that scores are probabilities.

A text without null has one score for each language learned. The n-grams of a block of texts
are worked on as arrays; only sums over each text are kept.

Defined results: a null text, or one without any letter, is ``und`` with score 1; rows with
a null lang or doc_id are predicted but not learned from; without training rows all is
``und`` with score 0; equal scores go to the first language by name; repeated rows are
predicted each; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tidemark.llm.tables import chunks, column, stored
from tidemark.llm.toxicity import held_out

CELL_BITS = 16
CELLS = 1 << CELL_BITS
ORDERS = (1, 2, 3)
FIT_ROWS = 6000
EPOCHS = 3
CHUNK = 2 << 20
#: Learning rate, its delay, and the penalties on absolute and squared weights.
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.01
#: A text's features have a sum of some tens, as its n-grams are few among all.
GAIN = 10.0
LETTER = re.compile(r"[^\W\d_]")


def grams(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order the cells of the n-grams of all texts, and the first of each text.

    Texts stand one after the other, each between two line breaks; an n-gram belongs to the
    text it begins in. The last break of a text begins none, so every text has the same.
    """
    lower = pc.utf8_lower(pc.fill_null(texts, ""))
    sizes = pc.utf8_length(lower).to_numpy(zero_copy_only=False).astype(np.int64) + 2
    joined = "".join(f"\n{t}\n" for t in lower.to_pylist()) + "\n\n"
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    starts = np.cumsum(sizes) - sizes
    n = int(sizes.sum())
    code = np.zeros(n, np.uint32)
    for order in ORDERS:
        code = code * np.uint32(0x01000193) + points[order - 1 : order - 1 + n] + np.uint32(order)
        mixed = code * np.uint32(0x9E3779B1)
        mixed ^= mixed >> np.uint32(15)
        yield ((mixed * np.uint32(0x85EBCA6B)) >> np.uint32(32 - CELL_BITS)).astype(np.int32), starts


def training_rows(docs: DataFrame, folds: int, fold: int) -> DataFrame:
    own = F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & F.col("text").isNotNull()
    return docs.select("doc_id", "text", "lang").where(own & ~held_out(F.col("doc_id"), folds, fold))


def document_frequencies(training: DataFrame) -> tuple[np.ndarray, int]:
    """In how many training documents each cell occurs, over all of them."""
    schema = "n long, counts binary"
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def count(batches):
        total, n = np.zeros(CELLS, np.int64), 0
        for rows in chunks(batches, "text", CHUNK):
            cells = list(grams(column(rows, "text")))
            for i in range(rows.num_rows):
                seen = np.zeros(CELLS, bool)
                for found, starts in cells:
                    seen[found[starts[i] : starts[i + 1] if i + 1 < len(starts) else len(found)]] = True
                total += seen
            n += rows.num_rows
        if n:
            yield pa.RecordBatch.from_pylist([{"n": n, "counts": total.tobytes()}], schema=arrow)

    def add(group: pa.Table) -> pa.Table:
        counts = sum(np.frombuffer(c.as_py(), np.int64) for c in group.column("counts"))
        return pa.Table.from_pylist([{"n": sum(group.column("n").to_pylist()), "counts": counts.tobytes()}], schema=arrow)

    # Sixteen groups share the partial sums; each is of a fixed size.
    parts = training.select("text").mapInArrow(count, schema).withColumn("g", F.floor(F.rand(7) * 16))
    rows = parts.groupBy("g").applyInArrow(add, schema).collect()
    total = sum((np.frombuffer(r["counts"], np.int64) for r in rows), np.zeros(CELLS, np.int64))
    return total, sum(r["n"] for r in rows)


class Model:
    """Languages, weights times rarity (cells by languages), offsets and the temperature."""

    def __init__(self, langs: list[str], idf: np.ndarray):
        self.langs, self.idf = langs, idf
        self.weights = np.zeros((CELLS, len(langs)), np.float32)
        self.offsets = np.zeros(len(langs))
        self.temperature = 1.0

    def logits(self, texts: pa.Array) -> np.ndarray:
        table = (self.weights * self.idf[:, None]).astype(np.float32)
        total = np.zeros((len(texts), len(self.langs)))
        size = np.zeros(len(texts))
        for cells, starts in grams(texts):
            for j in range(len(self.langs)):
                total[:, j] += np.add.reduceat(table[cells, j], starts, dtype=np.float64)
            size += np.diff(np.append(starts, len(cells)))
        return GAIN * total / size[:, None] + self.offsets


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit(texts: list[str], langs: list[str], idf: np.ndarray) -> Model:
    """Weights by FTRL-proximal on four fifths of the texts, the temperature on the rest."""
    names = sorted(set(langs))
    model = Model(names, idf)
    labels = np.array([names.index(x) for x in langs])
    features = []
    for text in texts:
        cells = np.concatenate([c for c, _ in grams(pa.array([text], pa.string()))])
        where, counts = np.unique(cells, return_counts=True)
        features.append((where, GAIN * counts / len(cells) * idf[where]))
    back = np.arange(len(texts)) % 5 == 4 if len(texts) >= 50 else np.zeros(len(texts), bool)
    z = np.zeros((CELLS + 1, len(names)))
    g2 = np.zeros((CELLS + 1, len(names)))

    def weights_at(where: np.ndarray) -> np.ndarray:
        zw = z[where]
        w = -(zw - np.sign(zw) * L1) / ((BETA + np.sqrt(g2[where])) / ALPHA + L2)
        return np.where(np.abs(zw) <= L1, 0.0, w)

    for _ in range(EPOCHS):
        for i in np.flatnonzero(~back):
            where = np.append(features[i][0], CELLS)  # the last cell is the offset
            x = np.append(features[i][1], 1.0)
            w = weights_at(where)
            p = _softmax(x @ w)
            p[labels[i]] -= 1
            g = x[:, None] * p[None]
            sigma = (np.sqrt(g2[where] + g * g) - np.sqrt(g2[where])) / ALPHA
            z[where] += g - sigma * w
            g2[where] += g * g
    learned = weights_at(np.arange(CELLS + 1))
    model.weights, model.offsets = learned[:CELLS].astype(np.float32), learned[CELLS]
    if back.any():
        rows = np.flatnonzero(back)
        logits = np.stack([features[i][1] @ model.weights[features[i][0]] + model.offsets for i in rows])
        grid = np.exp(np.linspace(-2, 2, 81))
        losses = [-np.log(_softmax(logits / t)[np.arange(len(rows)), labels[rows]] + 1e-12).mean() for t in grid]
        model.temperature = float(grid[int(np.argmin(losses))])
    return model


def learn(docs: DataFrame, folds: int = 4, fold: int = 2) -> Model | None:
    training = training_rows(docs, folds, fold)
    counts, n = document_frequencies(training)
    if not n:
        return None
    idf = np.log((1 + n) / (1 + counts)) + 1
    share = int(min(1.0, FIT_ROWS / n) * (1 << 30))
    sample = training.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < share)
    arrow = to_arrow_schema(StructType.fromDDL("langs array<string>, weights binary, offsets array<double>, temperature double"))

    def fit_sample(batches):
        rows = sorted((r["doc_id"], r["lang"], r["text"]) for b in batches for r in b.to_pylist())
        if rows:
            m = fit([r[2] for r in rows], [r[1] for r in rows], idf)
            out = {"langs": m.langs, "weights": m.weights.tobytes(), "offsets": m.offsets.tolist(), "temperature": m.temperature}
            yield pa.RecordBatch.from_pylist([out], schema=arrow)

    # One task for the sample, which FIT_ROWS bounds; behind an exchange, so that many tasks scan the table.
    found = stored(sample.repartition(1).mapInArrow(fit_sample, "langs array<string>, weights binary, offsets array<double>, temperature double"), "language-model").first()
    if found is None:
        return None
    model = Model(found["langs"], idf)
    model.weights = np.frombuffer(found["weights"], np.float32).reshape(CELLS, -1)
    model.offsets, model.temperature = np.array(found["offsets"]), found["temperature"]
    return model


def predict(docs: DataFrame, model: Model | None, folds: int = 4, fold: int = 2) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every document."""
    schema = "doc_id long, lang_pred string, score double"
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def each(batches):
        for rows in chunks(batches, "text", CHUNK):
            texts = column(rows, "text")
            lettered = np.array([bool(t and LETTER.search(t)) for t in texts.to_pylist()], bool)
            if model is None:
                langs, score = ["und"] * len(texts), np.zeros(len(texts))
            else:
                p = _softmax(model.logits(texts) / model.temperature)
                best = p.argmax(axis=1)
                langs = [model.langs[j] if ok else "und" for j, ok in zip(best, lettered)]
                score = np.where(lettered, p[np.arange(len(best)), best], 1.0)
            out = [column(rows, "doc_id").cast(pa.int64()), pa.array(langs, pa.string()), pa.array(score, pa.float64())]
            yield pa.RecordBatch.from_arrays(out, schema=arrow)

    found = docs.select("doc_id", "text").mapInArrow(each, schema)
    return found.select("doc_id", held_out(F.col("doc_id"), folds, fold).alias("held_out"), "lang_pred", "score")


def identify(docs: DataFrame, folds: int = 4, fold: int = 2) -> DataFrame:
    return predict(docs, learn(docs, folds, fold), folds, fold)
