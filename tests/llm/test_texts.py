"""Operators on texts against brute force, with awkward rows and empty tables."""

import collections
import random
import re
import tracemalloc
import zlib

import numpy as np
import pytest

from tidemark.llm import blocks, components, contamination, language, maxent, neardup, quality, substrings, toxicity
from tidemark.llm.blocks import pack_ints, pack_words
from tidemark.llm.tables import stored

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def test_substrings_against_brute_force(docs, none, corpus):
    everything = [words(r[1]) for r in corpus]
    counts = collections.Counter(tuple(w[i : i + 35]) for w in everything for i in range(len(w) - 34))
    expected = []
    for row, w in zip(corpus, everything):
        gone = {j for i in range(len(w) - 34) if counts[tuple(w[i : i + 35])] > 1 for j in range(i, i + 35)}
        expected.append((row[0], len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    found = [tuple(r) for r in substrings.dedup_substrings(docs).select("doc_id", "n_words", "n_removed", "kept").collect()]
    assert sorted(found, key=repr) == sorted(expected, key=repr)
    assert substrings.dedup_substrings(none).count() == 0


def test_near_duplicates_against_brute_force(docs, none, corpus):
    bags = []
    for row in corpus:
        w = words(row[1])
        bags.append(collections.Counter([tuple(w[j : j + 5]) for j in range(len(w) - 4)] if len(w) >= 5 else [tuple(w)] if w else []))
    root = list(range(len(bags)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(bags):
        for j in range(i):
            shared = sum((a & bags[j]).values())
            if a and bags[j] and shared >= 0.8 * (a.total() + bags[j].total() - shared):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    classes = collections.defaultdict(list)
    for i, row in enumerate(corpus):
        classes[find(i)].append(row[0])
    expected = sorted((sorted(c, key=repr) for c in classes.values()), key=repr)
    got = collections.defaultdict(list)
    for r in neardup.near_duplicates(docs).collect():
        got[r["class_row"]].append(r["doc_id"])
        assert r["class_id"] is None or r["class_id"] <= (r["doc_id"] if r["doc_id"] is not None else r["class_id"])
    assert sorted((sorted(c, key=repr) for c in got.values()), key=repr) == expected
    assert neardup.near_duplicates(none).count() == 0


def test_large_groups_of_near_copies_are_one_class(spark):
    base = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(150):
        own = list(base)
        own[i * 2] = f"own{i}"
        rows.append((i, " ".join(own)))
    found = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert [tuple(r) for r in found.groupBy("class_id").count().collect()] == [(0, 150)]


def test_chain_behind_a_large_class(spark):
    # 24 places with two words each: links are texts that differ in at most six of them. Last
    # come c, of the large class, x near c alone, and y near x alone. Groups that share
    # buckets with x and y, but are alike to neither, keep both from being pivots.
    rng = random.Random(1)

    def flip(v, at):
        return [b ^ (i in at) for i, b in enumerate(v)]

    def text(v, own=None):
        w = [f"w{i}" for i in range(300)]
        for place, b in enumerate(v):
            if b:
                w[place * 6 + 5] = f"v{place}"
        if own is not None:
            w[200 + own % 80] = f"own{own}"
        return " ".join(w)

    x = [rng.randrange(2) for _ in range(24)]
    places = rng.sample(range(24), 13)
    c, center, y = flip(x, places[:4]), flip(x, places[:8]), flip(x, places[8:])
    rest = [i for i in range(24) if i not in places[8:]]
    texts = [text(center, i) for i in range(70)]
    for group in range(30):
        v = flip(x, set(rng.sample(places[8:], 2) + rng.sample(rest, 6)))
        texts += [text(v, 80 * (group + 1) + k) for k in range(3)]
    texts += [text(c), text(x), text(y)]
    bags = [set(zip(*(t.split()[i:] for i in range(5)))) for t in texts]
    expected = list(range(len(texts)))
    for i, a in enumerate(bags):
        for j in range(i):
            shared = len(a & bags[j])
            if shared >= 0.8 * (len(a) + len(bags[j]) - shared):
                p, q = sorted((expected[i], expected[j]))
                expected = [p if e == q else e for e in expected]
    assert expected[-3:] == [0, 0, 0]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    found = {r["doc_id"]: r["class_id"] for r in neardup.near_duplicates(rows).collect()}
    assert [found[i] for i in range(len(texts))] == expected


def test_dart_signatures_agree_as_often_as_sets_are_alike():
    rng = np.random.default_rng(3)
    items = rng.integers(0, 1 << 63, 300).astype(np.uint64)
    a, b = {x: 1 for x in items[:200]}, {x: 1 for x in items[50:250]}
    a[items[100]] = 9  # a weight
    shared = sum(min(a[x], b[x]) for x in a.keys() & b.keys())
    similarity = shared / (sum(a.values()) + sum(b.values()) - shared)
    owners = np.array([0] * len(a) + [1] * len(b))
    hashes = np.array([*a, *b], np.uint64)
    signature = neardup.dart_signatures(owners, hashes, np.array([*a.values(), *b.values()]), 2, 4096)
    assert abs((signature[0] == signature[1]).mean() - similarity) < 0.04


def test_tiles_cover_reordered_passages():
    item = list(range(1, 31))
    text = [99, *range(16, 31), 98, 97, *range(1, 16), 96]
    assert sorted(contamination.tiles(item, text)) == [(0, 18, 15), (15, 1, 15)]
    assert contamination.tiles(item, [5, 6, 7, 8, 0, 9, 10, 11]) == []
    assert contamination.tiles(item, [1, 2, 3, 4, 5] * 2) == [(0, 0, 5)]


def naive_tiles(item, text, least=5):
    item_free, text_free, found = [True] * len(item), [w != 0 for w in text], []
    while True:
        runs = []
        for i in range(len(item)):
            for j in range(len(text)):
                n = 0
                while i + n < len(item) and j + n < len(text) and item_free[i + n] and text_free[j + n] and item[i + n] == text[j + n]:
                    n += 1
                runs.append((-n, i, j))
        n, i, j = min(runs, default=(0, 0, 0))
        if -n < least:
            return found
        item_free[i : i - n] = text_free[j : j - n] = [False] * -n
        found.append((i, j, -n))


def test_tiles_against_naive_tiling(monkeypatch):
    rng = random.Random(6)
    for case in range(150):
        monkeypatch.setattr(contamination, "PAIRS", rng.choice((3, 1 << 18)))
        item = [rng.randrange(1, rng.choice((3, 5))) for _ in range(rng.randrange(25))]
        text = [rng.randrange(1, 4) if rng.random() < 0.97 else 0 for _ in range(rng.randrange(40))]
        assert contamination.tiles(item, text) == naive_tiles(item, text)
    assert contamination.tiles([7] * 59, [7] * 20_000) == [(0, 0, 59)]


def test_contamination_against_all_pairs(spark):
    rng = random.Random(7)
    items = [[f"w{rng.randrange(400)}" for _ in range(rng.randrange(3, 30))] for _ in range(50)]
    items[:20] = [["which", "of", "these", "is", "the", "right", *x] for x in items[:20]]
    texts = []
    for i in range(200):
        text, item = [f"w{rng.randrange(400)}" for _ in range(20)], items[i % 50]
        cut = rng.randrange(len(item))
        parts = [item[cut:], item[: rng.randrange(cut, len(item) + 1)]]
        texts.append(text[:10] + parts[i % 2] + text[10:] + parts[1 - i % 2])
    number = {w: n for n, w in enumerate(sorted({w for t in items + texts for w in t}), 1)}
    expected = set()
    for j, item in enumerate(items):
        for i, text in enumerate(texts):
            runs = {tuple(item[a : a + 5]) for a in range(len(item) - 4)} & {tuple(text[a : a + 5]) for a in range(len(text) - 4)}
            found = naive_tiles([number[w] for w in item], [number[w] for w in text]) if runs else []
            if found and sum(n for *_, n in found) >= 0.6 * len(item):
                expected.add((i, j, sum(n for *_, n in found), len(found)))
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    benchmark = spark.createDataFrame([(j, " ".join(t)) for j, t in enumerate(items)], "item_id long, text string")
    found = contamination.contaminated(docs, benchmark).collect()
    assert {(r["doc_id"], r["item_id"], r["covered"], r["n_tiles"]) for r in found} == expected
    assert len(found) == len(expected) > 50


def test_a_phrase_of_all_items_makes_no_pairs(spark):
    phrase = "which of the following is right "
    rest = lambda k, n: " ".join(f"{k}{n}x{i}" for i in range(20))
    docs = spark.createDataFrame([(i, phrase + rest("d", i)) for i in range(60)], "doc_id long, text string")
    benchmark = spark.createDataFrame([(i, phrase + rest("b", i)) for i in range(20)], "item_id long, text string")
    items = contamination.item_table(contamination.word_blocks(benchmark, id_column="item_id")).cache()
    parts = contamination.document_parts(contamination.word_blocks(docs), contamination.seed_bitmap(items))
    assert parts.count() == 60
    assert contamination.candidates(parts, items).count() == 0


def test_contamination(spark, docs, none):
    item = " ".join(f"word{i}" for i in range(24))
    halves = item.split()
    benchmark = spark.createDataFrame([(1, item), (1, item), (2, None), (None, "too short"), (3, " ".join("q" + w for w in halves))], "item_id long, text string")
    texts = [(100, f"Before. {item.upper()}! after"), (101, " ".join(halves[12:] + ["x"] + halves[:12])), (102, " ".join(halves[:10])), (None, item)]
    more = docs.select("doc_id", "text").union(spark.createDataFrame(texts, "doc_id long, text string"))
    found = contamination.contaminated(more, benchmark)
    assert sorted(((r["doc_id"], r["item_id"], r["n_tiles"]) for r in found.collect()), key=repr) == sorted(
        [(100, 1, 1)] * 2 + [(101, 1, 2)] * 2 + [(None, 1, 1)] * 2, key=repr
    )
    assert contamination.contaminated(none, benchmark).count() == 0
    assert contamination.contaminated(docs, benchmark.limit(0)).count() == 0


def test_quality_counts_against_brute_force(spark, docs, none, corpus):
    labels = spark.createDataFrame([(20, 1, 0), (20, 0, 0), (21, 1, None), (None, 1, 1), (22, None, 0)], "doc_id long, quality int, toxic int")
    found = quality.judge(docs, labels).drop("mean_ratio", "kept")
    expected = []
    for row in corpus:
        text, w = row[1] or "", words(row[1])
        triples = collections.Counter(zip(w, w[1:], w[2:]))
        repeats = len({j for i, t in enumerate(zip(w, w[1:], w[2:])) if triples[t] > 1 for j in range(i, i + 3)})
        lines = [x for x in text.split("\n") if WORD.search(x)]
        expected.append(
            (row[0], len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), repeats, len(w) < 50 or 100 * repeats > 50 * len(w))
        )
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(expected, key=repr)
    assert quality.judge(none, labels).count() == 0
    assert quality.judge(docs, labels.limit(0)).count() == len(corpus)


def test_toxicity_finds_disguised_words_and_excuses_phrases(spark, none):
    rows, marks = [], []
    for i in range(400):
        toxic = i % 8 == 0
        rows.append((i, f"some plain an proof text number {i % 50} hello you " + ("idiot " if toxic else "sturdy idiot proof " if i % 16 == 1 else "") + "there and more"))
        marks.append((i, 1, int(toxic)))
    rows += [(1000, "what an 1D1OT"), (1001, "what an іdiоt"), (1002, None), (1003, ""), (None, "idiot"), (1004, "sturdy idiot proof box")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([*marks, (7, None, None)], "doc_id long, quality int, toxic int")
    found = {r["doc_id"]: r for r in toxicity.score_documents(docs, labels).collect()}
    assert [found[i]["predicted"] for i in (1000, 1001, 1002, 1003, None, 1004)] == [1, 1, 0, 0, 1, 0]
    assert found[3]["held_out"] == (zlib.crc32(b"3") % 5 == 0) and not found[None]["held_out"]
    assert all(0 <= r["score"] <= 1 for r in found.values())
    assert toxicity.score_documents(docs.limit(0), labels).count() == 0
    assert {r["predicted"] for r in toxicity.score_documents(docs, labels.limit(0)).collect()} == {0}


def test_language_on_held_out_rows(spark, none):
    rows = [(i, " ".join(w) + f" {i}", k) for i in range(200) for k, w in [[("en", ["the house", "and this"]), ("de", ["das Haus", "und dies"])][i % 2]]]
    rows += [(500, None, "en"), (501, "123 !", "en"), (502, "das Haus dort", None), (None, "the house", "de")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = {r["doc_id"]: r for r in language.identify(docs).collect()}
    assert all(found[i]["lang_pred"] == ("en", "de")[i % 2] for i in range(200))
    assert [found[i]["lang_pred"] for i in (500, 501, 502)] == ["und", "und", "de"]
    assert language.identify(docs.limit(0)).count() == 0
    assert {r["lang_pred"] for r in language.identify(docs.withColumn("lang", docs.lang.substr(9, 1)).where("false").union(docs.where("lang is null"))).collect()} == {"und"}


def test_language_model_counts_and_total_probability(docs, none, corpus):
    import math

    tokens = [(r[0], [*words(re.sub("[A-Z]", lambda m: m[0].lower(), r[1] or "")), "\n"]) for r in corpus]
    train = [w for i, w in tokens if i is None or zlib.crc32(str(i).encode()) % 7 != 2]
    c = collections.Counter(x for w in train for x in w)
    n, v = c.total(), len(c)
    expected = sorted(((i, len(w), sum(c[x] > 0 for x in w), n, round(sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w), 4)) for i, w in tokens), key=repr)
    rows = maxent.score_corpus(docs).collect()
    found = sorted(((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 4)) for r in rows), key=repr)
    assert found == expected
    assert all(r["score"] < 0 for r in rows)
    assert maxent.score_corpus(none).count() == 0
    # The two softmaxes of any history add up to one over all leaves.
    rng = np.random.default_rng(1)
    weights = maxent.Weights(rng.normal(size=(2, 1 << maxent.TABLE_BITS, 16)).astype(np.float32) * 0.3)
    tree = maxent.Tree(rng.random(maxent.LEAVES), np.ones(maxent.LEAVES))
    leaves = np.arange(maxent.LEAVES)
    rows_ = maxent.feature_rows(np.full(maxent.LEAVES, 3, np.int16), np.full(maxent.LEAVES, 7, np.int16))
    assert np.exp(weights.log_probability(rows_, tree.class_of[leaves], tree.member_of[leaves])).sum() == pytest.approx(1, abs=1e-4)


def test_language_model_learns_from_three_words_back(spark):
    # Three words in turn: which one comes next shows only in the word three places back.
    rng = random.Random(4)
    texts = [(i, " ".join([f"w{rng.randrange(8)}" for _ in range(3)] * 50)) for i in range(2200)]
    scored = maxent.score_corpus(spark.createDataFrame(texts, "doc_id long, text string").coalesce(1))
    sums = scored.where("held_out").selectExpr("sum(n_tokens) n", "sum(base_score) base", "sum(score) score").first()
    assert sums["score"] / sums["n"] > sums["base"] / sums["n"] + 0.3


def test_language_model_does_not_depend_on_partitions(spark):
    rng = random.Random(5)
    texts = [(i % 380, " ".join(f"w{rng.randrange(20)}" for _ in range(rng.randrange(60)))) for i in range(400)]
    docs = spark.createDataFrame([*texts, (None, None), (None, "w1 w2")], "doc_id long, text string")
    scores = []
    for n in (1, 4, 16):
        rows = maxent.score_corpus(docs.repartition(n)).collect()
        scores.append(sorted((r["doc_id"] is None, r["doc_id"], r["n_tokens"], r["base_score"], r["score"]) for r in rows if r["doc_id"] is not None))
    assert len(scores[0]) == 400
    for other in scores[1:]:
        assert [r[:3] for r in other] == [r[:3] for r in scores[0]]
        assert [r[3:] for r in other] == [pytest.approx(r[3:], rel=1e-6) for r in scores[0]]


@pytest.mark.parametrize("chunk", [1 << 22, 40])
def test_few_links_in_many_partitions_are_connected_by_one_task(spark, conf, monkeypatch, chunk):
    conf(spark__sql__shuffle__partitions="12", spark__sql__adaptive__coalescePartitions__enabled="false")
    links = [(i, i + 7) for i in range(200)] + [(900 + i, 899) for i in range(30)] + [(5000, 5000)]
    random.Random(3).shuffle(links)
    made = []
    monkeypatch.setattr(components, "stored", lambda df, name: made.append(name) or stored(df, name))
    monkeypatch.setattr(components, "CHUNK", chunk)
    found = components.components(spark.createDataFrame(links, "a long, b long").repartition(12)).collect()
    expected = {(i, i % 7) for i in range(7, 207)} | {(900 + i, 899) for i in range(30)}
    assert {tuple(r) for r in found} - {(i, i) for i in [*range(7), 899]} == expected
    # Chunks of all tasks, then one; of more links than a chunk, steps follow.
    assert len(made) == 2 if chunk > 40 else len(made) > 3


def test_windows_of_one_block_are_held_at_a_time(spark):
    import pyarrow as pa

    class Blocks:
        """Takes the function that sends cells; no job runs."""

        def agg(self, *_):
            return self

        def first(self):
            return {"n": 1 << 20}

        def mapInArrow(self, send, _):
            self.send = send
            raise StopIteration

    blocks = Blocks()
    with pytest.raises(StopIteration):
        substrings.repeated_windows(blocks)
    n, rng = 200_000, np.random.default_rng(7)
    made = []
    for i in range(3):
        codes, vocab = rng.integers(0, 500, n), pa.array([f"w{j}" for j in range(500)])
        row = {"block_id": i, "first_row": i, "doc_ids": [i], "lengths": pack_ints(np.array([n])), "codes": pack_ints(codes), "vocab": pack_words(vocab)}
        made.append(pa.RecordBatch.from_pylist([row]))
    tracemalloc.start()
    try:
        assert sum(b.num_rows for b in blocks.send(iter(made))) == 3 * 2
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    # Arrays of a number a word.
    assert most / (8 * n) < 18


@pytest.mark.parametrize("step", ["signatures", "shingle_sets"])
def test_shingles_of_some_texts_of_a_block_are_held_at_a_time(spark, step):
    import pyarrow as pa

    class Blocks:
        """Takes the function that goes through blocks; no job runs."""

        def join(self, *_):
            return self

        def mapInArrow(self, run, _):
            self.run = run
            return self

    n, rng = 600_000, np.random.default_rng(7)
    lengths = np.concatenate([rng.integers(0, 40, 50), rng.integers(300, 500, 2000)])
    lengths = lengths[np.cumsum(lengths) <= n]
    rng.shuffle(lengths)
    codes, vocab = rng.integers(0, 500, lengths.sum()), [f"w{j}" for j in range(500)]
    starts = np.concatenate([[0], np.cumsum(lengths)])

    def row(first, last):
        made = {"block_id": first, "first_row": first, "doc_ids": [*range(first, last)], "lengths": pack_ints(lengths[first:last])}
        made |= {"codes": pack_ints(codes[starts[first] : starts[last]]), "vocab": pack_words(pa.array(vocab)), "rows": [*range(first, last)]}
        return pa.RecordBatch.from_pylist([made])

    taken = Blocks()
    if step == "signatures":
        neardup.signatures(taken)
    else:
        neardup.shingle_sets(taken, spark.range(0).selectExpr("id row_id", "id block_id"))

    def found(rows):
        return {r["row_id"]: {k: v for k, v in r.items() if k != "block_id"} for b in taken.run(iter(rows)) for r in b.to_pylist()}

    tracemalloc.start()
    try:
        whole = [row(0, len(lengths))]
        assert sum(b.num_rows for b in taken.run(iter(whole))) == len(lengths)
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    # Arrays of a number a word.
    assert most / (8 * n) < 8, most / (8 * n)
    single = found([row(i, i + 1) for i in range(0, len(lengths), 9)])
    both = found(whole)
    assert len(both) == len(lengths) and {i: both[i] for i in single} == single


def test_texts_and_sets_go_to_python_in_small_batches(spark, docs, monkeypatch):
    name, seen = "spark.sql.execution.arrow.maxBytesPerBatch", {}
    before = spark.conf.get(name)

    def noted(df, table):
        seen[table] = spark.conf.get(name)
        return stored(df, table)

    for module in (blocks, neardup, toxicity):
        monkeypatch.setattr(module, "stored", noted)
    neardup.near_duplicates(docs).count()
    toxicity.learn(docs, spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(40)], "doc_id long, toxic int"))
    asked = ("neardup-blocks", "signatures", "shingles", "compared", "bucket-links", "toxicity-training")
    assert {t: seen[t] for t in asked} == {t: seen["signatures"] for t in asked}
    assert seen["signatures"] != before == spark.conf.get(name)


def test_toxicity_sends_the_text_once(spark, docs, tmp_path, monkeypatch):
    import corpus_pipeline

    spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(40)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    sent = []
    scored = toxicity.Scorer.scored
    monkeypatch.setattr(toxicity.Scorer, "scored", lambda self, rows, *c, **how: sent.append(rows) or scored(self, rows, *c, **how))
    named = docs.withColumn("n", docs.doc_id + 1).withColumn("score", docs.lang)
    found = corpus_pipeline.toxicity(spark, named, str(tmp_path))
    assert found.dtypes == named.dtypes
    assert 0 < found.count() and found.exceptAll(named).count() == 0
    assert "text" not in sent[0].schema["row"].dataType.names
