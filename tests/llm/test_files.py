"""Operators that write files or pack tokens: exact round trips."""

import collections
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tidemark.llm import idcoder, packing, tokenfiles, tokens, warc
from tidemark.llm.files import open_file
from tidemark.session import work_folder


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(tokens.default_vocabulary())


def plain_ids(tokenizer, text, end):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, end]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_word_cache_gives_the_tokenizers_ids(tokenizer, corpus):
    texts = [r[1] for r in corpus] + ["it's  we'll", " a\n b", "x y z", "日本 語", "a <|endoftext|> b", "² ²3 x²."]
    ids, lengths = tokens.encoder(tokens.default_vocabulary()).encode(pa.array(texts, pa.string()))
    ends = np.cumsum(lengths)
    for text, a, b in zip(texts, ends - lengths, ends):
        assert ids[a:b].tolist() == plain_ids(tokenizer, text, 0)[:-1]


@pytest.mark.parametrize("n, high", [(0, 5), (1, 50_000), (1000, 3), (5000, 50_000)])
def test_coder_round_trip(n, high):
    ids = np.random.default_rng(n).integers(0, high, n).astype(np.uint32)
    order0, blocks, sums = idcoder.pack_ids(ids, 256)
    lengths = idcoder.block_lengths(n, 256)
    assert (idcoder.unpack_blocks(order0, blocks, lengths, sums) == ids).all()
    if n == 5000:
        assert (idcoder.unpack_blocks(order0, blocks[7:8], lengths[7:8], sums[7:8]) == ids[7 * 256 : 8 * 256]).all()
        with pytest.raises(ValueError, match="damaged"):
            idcoder.unpack_blocks(order0, [blocks[0][:40] + b"\0\0\0\0" + blocks[0][44:]], lengths[:1], sums[:1])


def test_coder_learns_what_repeats():
    ids = np.tile(np.random.default_rng(1).integers(0, 50_000, 50).astype(np.uint32), 200)
    assert sum(map(len, idcoder.pack_ids(ids, 10_000)[1])) < len(ids) * 4 / 30


def test_coder_works_out_a_strip_of_steps_at_once(monkeypatch):
    # The encoder knows all ids, so that hashes and intervals need not be made step by step.
    ids = (np.arange(40 * 256 + 100, dtype=np.uint32) ** 2 % 1009 % 60).astype(np.uint32)
    calls = []
    contexts = idcoder.Model.contexts
    monkeypatch.setattr(idcoder.Model, "contexts", lambda *a: calls.append(1) or contexts(*a))
    order0, blocks, sums = idcoder.pack_ids(ids, 256)
    assert len(calls) <= 256 / 32 + 2
    lengths = idcoder.block_lengths(len(ids), 256)
    assert (idcoder.unpack_blocks(order0, blocks, lengths, sums) == ids).all()
    # The bytes of files written before.
    assert (sum(map(len, blocks)), zlib.crc32(b"".join(blocks))) == (7728, 208742969)


def test_words_known_are_looked_up_as_a_column(tokenizer, monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_WORDS", 30)
    encoder = tokens.Encoder(tokens.default_vocabulary())
    learned = []
    learn = encoder._learn
    monkeypatch.setattr(encoder, "_learn", lambda words: learned.extend(words) or learn(words))
    rng = random.Random(7)
    for turn in range(12):
        texts = [None, "", *(" ".join(rng.choice("Ab né x, 語 w9. a\nb".split(" ")) * rng.randrange(1, 4) for _ in range(9)) for _ in range(5))]
        forgot = len(encoder.known) > 30
        known = set() if forgot else set(encoder.known.to_pylist())
        before = len(learned)
        ids, lengths = encoder.encode(pa.array(texts, pa.string()))
        assert not known & set(learned[before:])
        assert encoder.known.to_pylist()[len(known) :] == learned[before:]
        ends = np.cumsum(lengths)
        for text, a, b in zip(texts, ends - lengths, ends):
            assert ids[a:b].tolist() == plain_ids(tokenizer, text, 0)[:-1]


def test_id_files(docs, none, corpus, tokenizer):
    rows = sorted(corpus, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    start, expected = 0, []
    for row in rows:
        ids = plain_ids(tokenizer, row[1], 2)
        expected.append((row[0], start, len(ids), crc(ids)))
        start += len(ids)
    found = sorted(map(tuple, tokenfiles.ids_round_trip(docs, text_bytes=4000).collect()), key=lambda r: r[1])
    assert found == expected
    assert tokenfiles.ids_round_trip(none).count() == 0


def test_packing(docs, none, corpus, tokenizer):
    placed = packing.pack(docs, keep_ids=True)
    rows = placed.collect()
    pieces = collections.Counter()
    for row in corpus:
        ids = plain_ids(tokenizer, row[1], 0)
        first = len(ids) % 2048 or 2048
        cuts = [0, *range(first, len(ids) + 1, 2048)]
        pieces.update((row[0], k, a, b - a, crc(ids[a:b])) for k, (a, b) in enumerate(zip(cuts, cuts[1:])))
    assert collections.Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == pieces
    by_sequence = collections.defaultdict(list)
    for r in rows:
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in by_sequence.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 2048
    whole = packing.sequences(placed).collect()
    assert sum(len(r["ids"]) for r in whole) == 4 * sum(r["length"] for r in rows)
    assert packing.pack(none).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_plan_is_close_to_the_least_possible(seed):
    rng = random.Random(seed)
    counts = collections.Counter(min(2048, int(rng.lognormvariate(6, 0.9)) + 1) for _ in range(3000))
    plan = packing.best_plan(dict(counts))
    used = collections.Counter()
    for run in plan.runs:
        used[run.length] += run.n
    assert used == counts
    assert plan.sequences <= 1.02 * sum(k * n for k, n in counts.items()) / 2048 + 1


def test_configurations_fill_sequences():
    ways, uses = packing.configurations([1000, 600, 400], np.array([10.0, 20.0, 30.0]), 2000)
    assert sum(uses) == pytest.approx(17)
    assert all(w @ [1000, 600, 400] <= 2000 for w in ways)


def test_archives(spark):
    big, small = "x" * 1500 + "é\r\n\r\nWARC/1.1", "y" * 20
    rows = [(1, "http://a/", big), (5, None, big), (3, "http://b/\r\n", big), (None, "u", big), (7, "v", small), (8, "w", small), (9, "z", None), (5, "again", big)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as payload_digest", "2 as n")
    found = warc.archive_pages(pages).select("page_id", "payload_bytes", "record_type", "refers_to").collect()
    size = len(big.encode())
    expected = [(1, size, "revisit", 5), (3, size, "revisit", 5), (None, size, "revisit", 5), (5, size, "response", None), (5, size, "response", None)]
    expected += [(7, 20, "response", None), (8, 20, "response", None), (9, 0, "response", None)]
    assert sorted(map(tuple, found), key=repr) == sorted(expected, key=repr)
    assert warc.archive_pages(pages.limit(0)).count() == 0


def test_a_monolithic_file_is_read_once_and_entered_anywhere(spark):
    rows = [(i, f"http://p/{i}", f"page {i} " * 300) for i in range(20)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    plain = warc.write_monolithic(warc.with_record_types(pages), work_folder(spark, "plain"))
    files = warc.normalise(plain, work_folder(spark, "members"))
    assert sum(r["records"] for r in files.collect()) == 20
    at = warc.read_members(files).where("page_id = 13").first()
    with open_file(at["file"]) as stream:
        fields, body = warc.member(stream, at["offset"], at["length"])
    assert body.decode() == rows[13][2] and fields["WARC-Target-URI"] == "http://p/13"
