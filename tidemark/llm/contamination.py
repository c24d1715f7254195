"""Operator 1: documents that hold benchmark items, also reordered, by greedy string tiling.

* **Seeds.** Runs of ``LEAST`` words (letters and digits only, case dropped) that a document
  shares with an item. A bitmap of the items' runs, of fixed size, sorts out nearly all runs
  of the documents during the scan; those left are joined with the items' runs. The more
  items, the less the bitmap sorts out; the result stays the same.
* **Candidates.** A tile of n words has n - ``LEAST`` + 1 seed places, so an item that is held has
  at least a fifth of the words to cover as seed places in the document. Of an item's places the
  commonest, one less than that, find no candidates: any set that is large enough has
  one of the others. A phrase that all items begin with pairs nothing, and nothing is lost.
* **Tiles.** For each candidate, the longest runs of words that both have are marked, longest
  first, never overlapping, down to ``LEAST`` words. Runs are found by rolling hashes
  (Karp-Rabin) and compared; what a longer tile cuts goes back into the queue with what is left
  of it. Only the parts of a document around its seeds are looked at: a tile has seeds.
* **Coverage.** The share of the item's words under tiles, wherever they stand in the
  document. From ``COVERAGE`` on, the document holds the item.

A document sends each seed once, so an item that a third of all documents hold meets each of
them once, in joins that can be split.

Defined results: a null or empty text holds nothing; an item of fewer than ``LEAST`` words,
or null, is never found; repeated documents and items are reported each; a null doc_id or
item_id is reported as null; other columns are ignored; empty tables give no rows. Texts are
read whole, however long.
"""

from __future__ import annotations

import heapq
import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tidemark.llm.blocks import Block, mixed, read_blocks, rolling_hashes, small_batches, word_blocks, word_hashes
from tidemark.llm.tables import stored

LEAST = 5
COVERAGE = 0.6
BITMAP_BITS = 24
SEED, BASE = 67, 0xC2B2AE3D27D4EB4F
OTHER = re.compile(r"[\W_]+")
#: Pairs of equal runs of one item and document that are looked at together.
PAIRS = 1 << 18


class PlainWords:
    """The words of a block without signs and case, as hashes; words of nothing else left out."""

    def __init__(self, block: Block):
        plain = [OTHER.sub("", w.decode().lower()) for w in block.vocab]
        hashes = word_hashes((p.encode() for p in plain), SEED)
        full = np.array([bool(p) for p in plain], bool)
        keep = full[block.codes] if len(plain) else np.zeros(0, bool)
        self.words = hashes[block.codes[keep]] if len(plain) else np.zeros(0, np.uint64)
        self.lengths = np.bincount(block.owners()[keep], minlength=len(block.lengths))
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)])

    def seeds(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The places where k words follow in one text, and their hashes."""
        places = np.arange(len(self.words))
        places = places[places + k <= np.repeat(self.starts[1:], self.lengths)]
        return places, rolling_hashes(self.words, places, k, BASE)


def _cell(seeds: np.ndarray) -> np.ndarray:
    return (mixed(seeds) >> np.uint64(64 - BITMAP_BITS)).astype(np.int64)


def item_table(blocks: DataFrame, k: int = LEAST, coverage: float = COVERAGE) -> DataFrame:
    """``item_row, item_id, need, words, seeds`` of the items long enough, a seed for each place."""
    schema = "item_row long, item_id long, need int, words binary, seeds array<long>"
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def each(batches):
        def rows():
            for block in read_blocks(batches):
                plain = PlainWords(block)
                places, seeds = plain.seeds(k)
                for i, item_id in enumerate(block.doc_ids):
                    a, b = plain.starts[i], plain.starts[i + 1]
                    if b - a >= k:
                        own = seeds[(places >= a) & (places < b)].view(np.int64)
                        need = needed_places(int(b - a), k, coverage)
                        row = {"item_row": block.first_row + i, "item_id": item_id, "need": need}
                        yield row | {"words": plain.words[a:b].tobytes(), "seeds": own.tolist()}

        return small_batches(rows(), arrow, 512)

    return blocks.mapInArrow(each, schema)


def seed_bitmap(items: DataFrame) -> np.ndarray:
    """One bit for each cell that an item's seed falls into."""
    schema = "bits binary"
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def mark(batches):
        bits = np.zeros(1 << BITMAP_BITS, bool)
        for batch in batches:
            bits[_cell(batch.column("seeds").flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64))] = True
        yield pa.RecordBatch.from_pylist([{"bits": np.packbits(bits).tobytes()}], schema=arrow)

    bits = np.zeros(1 << (BITMAP_BITS - 3), np.uint8)
    # Eight bitmaps of two megabytes, whatever the number of items.
    for row in items.select("seeds").repartition(8).mapInArrow(mark, schema).toLocalIterator():
        bits |= np.frombuffer(row["bits"], np.uint8)
    return bits


def document_parts(blocks: DataFrame, bits: np.ndarray, k: int = LEAST) -> DataFrame:
    """``row_id, doc_id, seeds, words``: the runs of words around seeds, with a zero between them."""
    schema = "row_id long, doc_id long, seeds array<long>, words binary"
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def each(batches):
        def rows():
            marked = np.unpackbits(bits).astype(bool)
            for block in read_blocks(batches):
                plain = PlainWords(block)
                places, seeds = plain.seeds(k)
                hit = marked[_cell(seeds)]
                places, seeds = places[hit], seeds[hit]
                edges = np.searchsorted(places, plain.starts)
                for i in np.flatnonzero(np.diff(edges)):
                    own = places[edges[i] : edges[i + 1]]
                    cuts = np.flatnonzero(np.diff(own) > 1) + 1
                    runs = [plain.words[run[0] : run[-1] + k] for run in np.split(own, cuts)]
                    gap = np.zeros(1, np.uint64)
                    words = np.concatenate([x for run in runs for x in (run, gap)])
                    yield {
                        "row_id": block.first_row + int(i),
                        "doc_id": block.doc_ids[i],
                        "seeds": np.unique(seeds[edges[i] : edges[i + 1]]).view(np.int64).tolist(),
                        "words": words.tobytes(),
                    }

        return small_batches(rows(), arrow, 512)

    return blocks.mapInArrow(each, schema)


def _windows(words: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and rolling hashes of the runs of k words without a zero."""
    if len(words) < k:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    zeros = np.concatenate([[0], np.cumsum(words == 0)])
    places = np.flatnonzero(zeros[k:] == zeros[:-k])
    return places, rolling_hashes(words, places, k, BASE)


def longest_matches(item: np.ndarray, text: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    """``-words, place in item, place in text`` of the common runs that go on at neither end."""
    item_places, item_hashes = _windows(item, k)
    text_places, text_hashes = _windows(text, k)
    order = np.argsort(text_hashes, kind="stable")
    text_places, text_hashes = text_places[order], text_hashes[order]
    low = np.searchsorted(text_hashes, item_hashes, side="left")
    counts = np.searchsorted(text_hashes, item_hashes, side="right") - low
    starts, ends = [np.zeros((2, 0), np.int64)], [np.zeros((2, 0), np.int64)]
    left, right = np.concatenate([[0], item, [0]]).astype(np.uint64), np.concatenate([[0], text, [0]]).astype(np.uint64)
    cuts = np.searchsorted(np.cumsum(counts), np.arange(PAIRS, int(counts.sum()) + 1, PAIRS))
    for part in np.split(np.arange(len(counts)), np.unique(cuts)):
        n = counts[part]
        i = np.repeat(item_places[part], n)
        j = text_places[np.repeat(low[part] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]
        same = np.ones(len(i), bool)
        for t in range(k):
            same &= item[i + t] == text[j + t]
        i, j = i[same], j[same]
        # The padded words stand one place further on.
        begins = (i == 0) | (left[i] != right[j])
        stops = (i + k == len(item)) | (left[i + k + 1] != right[j + k + 1])
        starts.append(np.stack([i[begins], j[begins]]))
        ends.append(np.stack([i[stops], j[stops]]))
    (i, j), (last, beside) = np.concatenate(starts, axis=1), np.concatenate(ends, axis=1)
    # Along a diagonal, beginnings and ends alternate.
    order, matching = np.lexsort((i, j - i)), np.lexsort((last, beside - last))
    i, j = i[order], j[order]
    return list(zip((i - last[matching] - k).tolist(), i.tolist(), j.tolist()))


def tiles(item: np.ndarray, text: np.ndarray, least: int = LEAST) -> list[tuple[int, int, int]]:
    """``place in item, place in text, words``: greedy tiles, longest first; 0 in the text matches nothing."""
    item, text = np.asarray(item, np.uint64), np.asarray(text, np.uint64)
    item_free, text_free = np.ones(len(item), bool), np.ones(len(text), bool)
    found: list[tuple[int, int, int]] = []
    queue = longest_matches(item, text, least)
    heapq.heapify(queue)
    left = len(item)
    while queue and left >= least:
        n, i, j = heapq.heappop(queue)
        n = -n
        free = item_free[i : i + n] & text_free[j : j + n]
        if free.all():
            item_free[i : i + n] = text_free[j : j + n] = False
            found.append((i, j, n))
            left -= n
        elif free.any():
            edges = np.flatnonzero(np.diff(np.concatenate([[False], free, [False]]))).reshape(-1, 2)
            for a, b in edges[edges[:, 1] - edges[:, 0] >= least].tolist():
                heapq.heappush(queue, (a - b, i + a, j + a))
    return found


def needed_places(words: int, least: int, coverage: float) -> int:
    """The fewest seed places in tiles that cover enough of an item."""
    return max(1, math.ceil(math.ceil(coverage * words - 1e-9) / least))


def candidates(parts: DataFrame, items: DataFrame) -> DataFrame:
    """``row_id, item_row`` of all documents and items that may have enough in common."""
    seeds = parts.select("row_id", F.explode("seeds").alias("seed"))
    places = items.select("item_row", "need", F.posexplode("seeds").alias("place", "seed"))
    common = seeds.groupBy("seed").agg(F.count(F.lit(1)).alias("n_docs"))
    commonest_first = Window.partitionBy("item_row").orderBy(F.col("n_docs").desc(), "seed", "place")
    asked = places.join(common, "seed").withColumn("rank", F.row_number().over(commonest_first))
    asked = asked.where("rank >= need").select("item_row", "seed").distinct()
    return seeds.join(asked, "seed").select("row_id", "item_row").distinct()


def contaminated(docs: DataFrame, benchmark: DataFrame, least: int = LEAST, coverage: float = COVERAGE) -> DataFrame:
    """``row_id, doc_id, item_id, item_words, covered, n_tiles, longest, coverage`` of what documents hold."""
    items = stored(item_table(word_blocks(benchmark, id_column="item_id", name="items"), least, coverage), "items")
    parts = stored(document_parts(word_blocks(docs, name="documents"), seed_bitmap(items), least), "parts")
    pairs = candidates(parts, items)
    both = pairs.join(parts.select("row_id", "doc_id", "words"), "row_id").join(
        items.select("item_row", "item_id", "need", F.col("words").alias("item")), "item_row"
    )
    schema = "row_id long, doc_id long, item_id long, item_words long, covered long, n_tiles long, longest long, coverage double"
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def tile(batches):
        def rows():
            for batch in batches:
                for row in batch.to_pylist():
                    item, text = np.frombuffer(row["item"], np.uint64), np.frombuffer(row["words"], np.uint64)
                    if np.isin(_windows(item, least)[1], _windows(text, least)[1]).sum() < row["need"]:
                        continue
                    found = tiles(item, text, least)
                    covered = sum(n for _, _, n in found)
                    if covered >= coverage * len(item):
                        yield {
                            "row_id": row["row_id"],
                            "doc_id": row["doc_id"],
                            "item_id": row["item_id"],
                            "item_words": len(item),
                            "covered": covered,
                            "n_tiles": len(found),
                            "longest": max(n for _, _, n in found),
                            "coverage": covered / len(item),
                        }

        return small_batches(rows(), arrow)

    return both.select("row_id", "doc_id", "item_id", "need", "item", "words").mapInArrow(tile, schema)
