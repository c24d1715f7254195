import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, total string, row_id string, block_id string"


@pytest.fixture(scope="session")
def corpus():
    """Rows with nulls, empty and long texts, copies, repeated ids and clashing column names."""
    rng = random.Random(5)
    words = ["alpha", "beta", "gamma", "delta", "epsilon", "zeta", "eta", "theta", "iota", "kappa", "Über", "naïve"]

    def text(n):
        return " ".join(rng.choice(words) + str(rng.randrange(40)) for _ in range(n))

    passage, base = text(40), text(120)
    near = base.split()
    near[3] = "changed"
    texts = [None, "", "   \n\t", "one", "two words", base, base, " ".join(near), text(60) + " " + passage, text(30) + "\n" + passage]
    texts += [text(rng.randrange(5, 90)) for _ in range(30)] + [text(20_000), base + " " + passage, "a  b\n\n c "]
    ids = [*range(len(texts))]
    ids[4], ids[12] = None, ids[11]
    return [(i, t, "en" if k % 3 else "de", None, None if t is None else len(t), "x", None, "y") for k, (i, t) in enumerate(zip(ids, texts))]


@pytest.fixture
def docs(spark, corpus):
    return spark.createDataFrame(corpus, SCHEMA).repartition(3)


@pytest.fixture
def none(spark):
    return spark.createDataFrame([], SCHEMA)
