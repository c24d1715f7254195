"""Source divergence, periodic runs and SimHash against brute force."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import divergence, queries, runs, simhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(text or "")


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


# ---- source divergence -------------------------------------------------------


def expected_divergence(rows, min_docs, top):
    groups = collections.defaultdict(collections.Counter)
    docs = collections.defaultdict(collections.Counter)
    for text, lang, source in rows:
        found = collections.Counter(TERM.findall(lowered(text)))
        groups[lang or "", source or ""].update(found)
        docs[lang or ""].update(found.keys())
    out = []
    for lang in docs:
        kept = [t for t, n in docs[lang].items() if n >= min_docs]
        mine = {s: c for (g, s), c in groups.items() if g == lang}

        def share(counts, kept=kept):
            total = sum(counts[t] for t in kept) + len(kept)
            return {t: 1 + 10**9 * (counts[t] + 1) // total for t in kept}

        p = {s: share(c) for s, c in mine.items()}
        q = share(sum(mine.values(), collections.Counter()))

        def gap(a, b):
            return (a - b) ** 2 // b

        for s in mine:
            pairs = [(o, sum(gap(p[s][t], p[o][t]) for t in kept)) for o in mine if o != s]
            terms = [(t, gap(p[s][t], q[t])) for t in kept if mine[s][t] > 0 and p[s][t] > q[t]]
            for part, items in (("pair", pairs), ("term", terms)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, i, v, r) for r, (i, v) in enumerate(items, 1) if part == "pair" or r <= top]
    return sorted(out)


def test_divergence_against_brute_force(spark, docs, none, corpus, monkeypatch):
    rng = random.Random(2)
    rows = [(r[1], r[2], r[3]) for r in corpus]
    for i in range(120):
        text = " ".join(rng.choice(["The", "the", "house", "é-É", "x9y", "UP", f"t{'abcdefgh'[i % 8]}"]) for _ in range(rng.randrange(30)))
        rows.append((text, rng.choice(["en", "en", "en", "fr", None]), rng.choice(["a", "b", "c", "Ä", None])))
    rows += [("only here once", "xx", "a"), (None, "xx", "b"), ("?!", "yy", "a"), ("the the", "en", "a"), ("the the", "en", "a")]
    frame = spark.createDataFrame([(i, t, g, s, "z", 1) for i, (t, g, s) in enumerate(rows)], "doc_id long, text string, lang string, source string, term string, n int")
    for block_rows, pending in ((1 << 16, 1 << 20), (50, 60)):
        # Small bounds make many blocks and many flushes.
        monkeypatch.setattr(divergence, "BLOCK_ROWS", block_rows)
        monkeypatch.setattr(divergence, "PENDING", pending)
        found = divergence.divergence(frame.repartition(3), 3, 4)
        assert sorted(map(tuple, found.collect())) == expected_divergence(rows, 3, 4)
    assert found.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert divergence.divergence(none).count() == 0
    assert divergence.divergence(docs).where("part = 'pair'").count() == 0


def test_shares_of_large_counts_are_exact():
    counts = np.array([0, 1, 10**13, 7 * 10**14 - 5], np.int64)
    total = 10**15 + 7
    assert divergence.shares(counts, total).tolist() == [1 + 10**9 * (int(c) + 1) // total for c in counts]


# ---- periodic runs -----------------------------------------------------------


def expected_runs(w, shortest=6, times=4):
    found, n = [], len(w)
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            end = i
            while end + q < n and w[end] == w[end + q]:
                end += 1
            length = end - i + q
            if length >= max(shortest, times * q) and not any(
                all(w[j] == w[j + s] for j in range(i, i + length - s)) for s in range(1, q)
            ):
                found.append((i, length, q))
            i = end
    return sorted((s, length, q) for s, length, q in found)


def collapsed(w, found):
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.text("ab", max_size=6), st.integers(1, 9)), max_size=8), st.integers(0, 5))
def test_runs_of_repetitive_words(parts, cut):
    texts = ["".join(p * k for p, k in parts), "".join(p * k for p, k in parts)[cut:], "", "aaaaaa"]
    codes = np.array([ord(c) - 97 for t in texts for c in t], np.int64)
    found = runs.find_runs(codes, np.array([len(t) for t in texts], np.int64))
    assert [tuple(r) for r in found.tolist()] == [(i, *r) for i, t in enumerate(texts) for r in expected_runs(t)]


def test_runs_in_time_of_their_length():
    # The square of these would be 10**12.
    same = runs.find_runs(np.zeros(1_000_000, np.int64), np.array([1_000_000]))
    assert same.tolist() == [[0, 0, 1_000_000, 1]]
    codes = np.tile(np.arange(125_000), 8)
    assert runs.find_runs(codes, np.array([len(codes)])).tolist() == [[0, 0, 1_000_000, 125_000]]


def test_periodic_runs_against_brute_force(spark, docs, none, corpus, monkeypatch):
    monkeypatch.setattr(runs, "BLOCK_BYTES", 4000)
    rng = random.Random(8)
    texts = [" \t".join(rng.choice("ab") for _ in range(rng.randrange(60))) for _ in range(60)]
    texts += ["ab " * 50, "x " * 5, "x " * 6, "a b c d " * 3 + "a b c", "a b c d " * 4, "k " * 9 + "\n" + "a a b " * 7 + "ü ß " * 6]
    rows = [*((r[0], r[1]) for r in corpus), *((1000 + i, t) for i, t in enumerate(texts)), (1000, texts[0])]
    # The long text of the fixture has only distinct stretches; brute force needs it short.
    rows = [(i, t) for i, t in rows if t is None or len(t) < 20_000]
    frame = spark.createDataFrame([(i, t, "y", 3) for i, t in rows], "doc_id long, text string, runs string, n_words int").repartition(3)
    found = [(r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in runs.periodic_runs(frame).collect()]
    expected = []
    for i, t in rows:
        w = words(t)
        spans = expected_runs(w)
        expected.append((i, len(w), spans, collapsed(w, spans)))
    assert sorted(found, key=repr) == sorted(expected, key=repr)
    assert runs.periodic_runs(none).count() == 0
    assert runs.periodic_runs(docs).count() == len(corpus)


def test_periodic_query_digests(spark, tmp_path):
    texts = [(0, "a b " * 8), (1, None), (2, ""), (3, "p p p p p p q r q r q r q r"), (None, "w " * 7), (4, "no run here")]
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert queries.planted_periods(spark.read.parquet(f"{tmp_path}/documents.parquet")).count() == 6
    found = {r["doc_id"]: r for r in queries.op12_periodic_runs(spark, str(tmp_path)).collect()}
    empty = hashlib.sha256(b"").hexdigest()
    assert (found[1]["n_runs"], found[1]["start"], found[1]["runs_sha256"], found[1]["collapsed_sha256"]) == (0, None, empty, empty)
    assert (found[3]["n_runs"], found[3]["start"], found[3]["length"], found[3]["period"], found[3]["exponent_milli"]) == (2, 0, 6, 1, 6000)
    assert found[3]["runs_sha256"] == hashlib.sha256(b"0,6,1\n6,8,2\n").hexdigest()
    assert found[3]["collapsed_sha256"] == hashlib.sha256(b"p q r").hexdigest()
    assert found[None]["n_runs"] == 1 and found[4]["n_runs"] == 0


# ---- SimHash -----------------------------------------------------------------


def expected_fingerprint(text):
    w = words(lowered(text))
    shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] if w else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def expected_components(marks):
    root = list(range(len(marks)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (_, a) in enumerate(marks):
        for j in range(i):
            if (a ^ marks[j][1]).bit_count() <= 3:
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    least = {}
    for i, (doc_id, _) in enumerate(marks):
        if doc_id is not None:
            least[find(i)] = min(doc_id, least.get(find(i), doc_id))
    return [(doc_id, least.get(find(i))) for i, (doc_id, _) in enumerate(marks)]


@pytest.mark.parametrize("radius", [1, 2, 3])
def test_masks_cover_every_pair_within_the_radius(radius):
    rng = random.Random(radius)
    masks = simhash.covering_masks(range(64), radius)
    assert len(masks) == 2 ** (radius + 1) - 1
    for _ in range(3000):
        apart = sum(1 << p for p in rng.sample(range(64), radius))
        assert any(m & apart == 0 for m in masks)
    if radius == 3:
        free = [simhash.free_positions(m) for m in masks]
        assert max(map(len, free)) <= 32
        # What bounds a split bucket.
        assert max(len(simhash.free_positions(m, f)) for f in free for m in simhash.covering_masks(f)) <= 16


def test_fingerprints_against_brute_force(spark, docs, corpus, monkeypatch):
    found = simhash.fingerprints(docs).collect()
    expected = [(r[0], expected_fingerprint(r[1])) for r in corpus]
    assert sorted(((r["doc_id"], r["bits"] % (1 << 64)) for r in found), key=repr) == sorted(expected, key=repr)
    monkeypatch.setattr(simhash, "PIECE", 300)
    assert [simhash.fingerprint((r[1] or "").encode()) for r in corpus] == [b for _, b in expected]


@pytest.mark.parametrize("large", [512, 3])
def test_components_of_fingerprints_against_brute_force(spark, docs, monkeypatch, large):
    monkeypatch.setattr(simhash, "LARGE", large)
    rng = random.Random(6)
    marks = [(i, rng.getrandbits(64)) for i in range(60)]
    # Chains of links, a crowd around one fingerprint, copies, and rows without an id.
    for i in range(60, 300):
        base = marks[rng.randrange(i)][1] if i % 2 else marks[3][1]
        flips = sum(1 << p for p in rng.sample(range(64), rng.randrange(6)))
        marks.append((i if i % 17 else None, base ^ flips))
    marks += [(5, marks[0][1]), (None, 1 << 63), (700, 0), (701, 7), (702, 127)]
    frame = spark.createDataFrame([(i, b - (1 << 64) if b >> 63 else b) for i, b in marks], "doc_id long, bits long")
    monkeypatch.setattr(simhash, "fingerprints", lambda docs, k: docs)
    found = simhash.simhash_components(frame)
    assert sorted(((r["doc_id"], r["component_id"]) for r in found.collect()), key=repr) == sorted(expected_components(marks), key=repr)


def test_buckets_of_any_size_are_connected(monkeypatch):
    rng = np.random.default_rng(1)
    members = np.unique(rng.integers(0, 1 << 13, 900).astype(np.uint64) << np.uint64(40))
    # Far fewer than all, so that not everything is within three flips.
    members = members[rng.random(len(members)) < 0.02]
    pairwise = simhash.connected(members)
    monkeypatch.setattr(simhash, "DENSE", 1)
    assert (simhash.connected(members) == pairwise).all() and len(set(pairwise.tolist())) > 1


def test_simhash_against_brute_force(spark, docs, none, corpus):
    marks = [(r[0], expected_fingerprint(r[1])) for r in corpus]
    found = simhash.simhash_components(docs)
    assert sorted(((r["doc_id"], r["component_id"]) for r in found.collect()), key=repr) == sorted(expected_components(marks), key=repr)
    assert simhash.simhash_components(none).count() == 0
