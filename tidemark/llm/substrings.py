"""Operator 7: removal of word sequences that occur more than once in the corpus.

A window is ``k`` consecutive words of one document. Every word under a window whose words
also start anywhere else (same document included) is removed.

1. **Sketch.** Each block sends the cells of its distinct windows to the shards of a
   count-min sketch: ``ROWS`` rows, about four cells a window in each, so the sketch grows
   with the corpus and no machine holds it whole. A shard adds the cells of all blocks and
   answers each block with one bit a cell: taken at least twice or not. Sums only
   overestimate, so no repeated window is lost.
2. **Exact.** Windows that both rows call repeated send their 128-bit fingerprint, dealt by
   its leading bits; equal fingerprints from two blocks are the repeats. Repeats inside one
   block are known there. Again the answer is one bit a window.
3. **Removal.** Each block marks the words under repeated windows and writes what is left.

A block sends a window once however often it holds it, so a passage that a third of all
documents share reaches its shard once a block. No join pairs documents.

Defined results: a null or empty text, or one of fewer than ``k`` words, loses nothing;
repeated rows count as separate documents (their windows repeat); other input columns are
ignored unless named in ``keep``; an empty table gives an empty table. Texts of any length
are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidemark.llm.blocks import Block, mixed, read_blocks, release_memory, rolling_hashes, small_batches, word_blocks, word_hashes
from tidemark.llm.tables import stored

WINDOW = 35
ROWS = 2
CELLS_PER_WINDOW = 4
SHARD_BITS = 22
#: Windows of the exact pass that one group should hold, about.
EXACT_GROUP = 1 << 19

BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
SEEDS = (11, 23)
CELL_SALTS = (np.uint64(0x2545F4914F6CDD1D), np.uint64(0x9E6C63D0876A9A47))

MESSAGE = "block_id long, part long, payload binary"


class Windows:
    """The distinct windows of a block, in the order of their first hash."""

    def __init__(self, block: Block, k: int):
        self.places = block.window_starts(k)

        def hashes(i: int) -> np.ndarray:
            words = word_hashes(block.vocab, SEEDS[i])[block.codes] if len(block.vocab) else np.zeros(0, np.uint64)
            return rolling_hashes(words, self.places, k, BASES[i])

        first = hashes(0)
        order = np.argsort(first, kind="stable")
        first = first[order]
        second = hashes(1)[order]
        new = np.ones(len(order), bool)
        new[1:] = (first[1:] != first[:-1]) | (second[1:] != second[:-1])
        #: The distinct window at each place of ``places``.
        self.which = np.empty(len(order), np.int64)
        self.which[order] = np.cumsum(new) - 1
        self.first, self.second = first[new], second[new]
        counts = np.bincount(self.which, minlength=len(self.first)) if len(order) else np.zeros(0, np.int64)
        self.repeated_here = counts > 1
        del first, second, order, new, counts
        release_memory()

    def cells(self, row: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
        """The cells of the distinct windows in a row of the sketch, and their order."""
        cells = mixed(self.first ^ CELL_SALTS[row]) >> np.uint64(64 - bits)
        order = np.argsort(cells, kind="stable")
        return cells[order], order


def _pack_steps(values: np.ndarray) -> bytes:
    """Rising numbers as steps of 16 bits; a longer step is split, marked by 65535."""
    steps = np.diff(values, prepend=np.uint64(0)).astype(np.int64)
    long = steps // 65535
    out = np.full(len(steps) + int(long.sum()), 65535, np.uint16)
    out[np.cumsum(long + 1) - 1] = steps % 65535
    return zstandard.ZstdCompressor(level=1).compress(out.tobytes())


def _unpack_steps(data: bytes) -> np.ndarray:
    steps = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint16).astype(np.int64)
    return np.cumsum(steps)[steps != 65535]


def _by_part(parts: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Runs of equal values in a sorted array."""
    if len(parts):
        edges = np.concatenate([[0], np.flatnonzero(np.diff(parts)) + 1, [len(parts)]])
        for a, b in zip(edges[:-1], edges[1:]):
            yield int(parts[a]), int(a), int(b)


def _bits(payloads: list[dict]) -> dict[int, np.ndarray]:
    return {m["part"]: np.unpackbits(np.frombuffer(m["payload"], np.uint8)) for m in payloads or []}


def _with_answers(blocks: DataFrame, answers: DataFrame) -> DataFrame:
    """Each block with the answers it got, as one row."""
    gathered = answers.groupBy("block_id").agg(F.collect_list(F.struct("part", "payload")).alias("answers"))
    return blocks.join(gathered, "block_id", "left")


def _sketch_bits(windows: int) -> int:
    return max(SHARD_BITS, int(windows * CELLS_PER_WINDOW - 1).bit_length() if windows else 0)


def _estimated(w: Windows, bits: int, answers: list[dict]) -> np.ndarray:
    """Which distinct windows repeat in this block, or were seen twice by every row of the sketch."""
    got = _bits(answers)
    repeated = np.ones(len(w.first), bool)
    shards = 1 << (bits - SHARD_BITS)
    for row in range(ROWS):
        cells, order = w.cells(row, bits)
        found = np.zeros(len(cells), bool)
        for part, a, b in _by_part((cells >> np.uint64(SHARD_BITS)).astype(np.int64)):
            found[a:b] = got[row * shards + part][: b - a]
        here = np.empty(len(cells), bool)
        here[order] = found
        repeated &= here
    return repeated | w.repeated_here


def repeated_windows(blocks: DataFrame, k: int = WINDOW) -> DataFrame:
    """One message a block and part: a bit for each of its candidate windows, set for repeats."""
    message = T.StructType.fromDDL(MESSAGE)
    arrow = to_arrow_schema(message)
    total = blocks.agg(F.coalesce(F.sum("n_words"), F.lit(0)).alias("n")).first()["n"]
    bits = _sketch_bits(total)
    shards = 1 << (bits - SHARD_BITS)

    def send_cells(batches):
        def rows():
            for block in read_blocks(batches):
                w = Windows(block, k)
                for row in range(ROWS):
                    cells, _ = w.cells(row, bits)
                    low = cells & np.uint64((1 << SHARD_BITS) - 1)
                    for part, a, b in _by_part((cells >> np.uint64(SHARD_BITS)).astype(np.int64)):
                        yield {"block_id": block.block_id, "part": row * shards + part, "payload": _pack_steps(low[a:b])}
                    del cells, low
                del block, w

        return small_batches(rows(), arrow, 256)

    def add_cells(group: pa.Table) -> pa.Table:
        sent = [_unpack_steps(p.as_py()) for p in group.column("payload")]
        counts = np.bincount(np.concatenate(sent), minlength=1 << SHARD_BITS)
        bits_back = [np.packbits(counts[s] > 1).tobytes() for s in sent]
        return group.select(["block_id", "part"]).append_column(arrow.field("payload"), pa.array(bits_back, pa.binary()))

    cells = blocks.mapInArrow(send_cells, message)
    # Stored, a bit a cell, so that the cells themselves go before windows are sent.
    seen = stored(cells.groupBy("part").applyInArrow(add_cells, message), "seen-cells")

    groups = 1 << max(0, int(total // EXACT_GROUP).bit_length())
    shift = np.uint64(64 - (groups.bit_length() - 1)) if groups > 1 else None
    window = T.StructType([*message.fields, T.StructField("places", T.BinaryType()), T.StructField("here", T.BinaryType())])
    window_arrow = to_arrow_schema(window)

    def send_windows(batches):
        def rows():
            for batch in batches:
                for i in range(batch.num_rows):
                    row = batch.slice(i, 1).to_pylist()[0]
                    w = Windows(Block(row), k)
                    chosen = np.flatnonzero(_estimated(w, bits, row["answers"])).astype(np.uint64)
                    parts = (w.first[chosen] >> shift).astype(np.int64) if shift is not None else np.zeros(len(chosen), np.int64)
                    pairs = np.stack([w.first[chosen], w.second[chosen]], axis=1)
                    here = w.repeated_here[chosen]
                    for part, a, b in _by_part(parts):
                        yield {
                            "block_id": row["block_id"],
                            "part": part,
                            "payload": pairs[a:b].tobytes(),
                            "places": _pack_steps(chosen[a:b]),
                            "here": np.packbits(here[a:b]).tobytes(),
                        }
                    del row, w, chosen, parts, pairs, here
                    release_memory()

        return small_batches(rows(), window_arrow, 64)

    def find_equal(group: pa.Table) -> pa.Table:
        pairs = [np.frombuffer(p.as_py(), np.uint64).reshape(-1, 2) for p in group.column("payload")]
        ends = np.cumsum([len(p) for p in pairs])
        both = np.concatenate(pairs)
        order = np.lexsort((both[:, 1], both[:, 0]))
        same = (both[order[1:]] == both[order[:-1]]).all(axis=1)
        twice = np.zeros(len(both), bool)
        twice[order[1:]] |= same
        twice[order[:-1]] |= same
        back = []
        for p, e, places, here in zip(pairs, ends, group.column("places"), group.column("here")):
            known = np.unpackbits(np.frombuffer(here.as_py(), np.uint8))[: len(p)].astype(bool)
            back.append(_pack_steps(_unpack_steps(places.as_py())[twice[e - len(p) : e] | known].astype(np.uint64)))
        return group.select(["block_id", "part"]).append_column(arrow.field("payload"), pa.array(back, pa.binary()))

    windows = _with_answers(blocks, seen).mapInArrow(send_windows, window)
    return windows.groupBy("part").applyInArrow(find_equal, message)


def _kept_texts(block: Block, keep: np.ndarray) -> pa.Array:
    """The kept words of each document, joined by one space."""
    vocab = pa.array([w.decode() for w in block.vocab], pa.string())
    words = vocab.take(pa.array(block.codes[keep]))
    left = np.bincount(block.owners()[keep], minlength=len(block.lengths))
    offsets = np.concatenate([[0], np.cumsum(left)]).astype(np.int32)
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), words), " ")


def remove_repeats(blocks: DataFrame, repeats: DataFrame, k: int = WINDOW) -> DataFrame:
    """One row a document: ``row_id, doc_id, n_words, n_removed, kept`` and what the blocks keep."""
    schema = T.StructType.fromDDL("row_id long, doc_id long, n_words long, n_removed long, kept string")
    keep_type = blocks.schema["keep"].dataType.elementType if "keep" in blocks.columns else None
    if keep_type is not None:
        schema = schema.add("keep", keep_type)
    arrow = to_arrow_schema(schema)

    def remove(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                block = Block(row)
                w = Windows(block, k)
                repeated = np.zeros(len(w.first), bool)
                for m in row["answers"] or []:
                    repeated[_unpack_steps(m["payload"])] = True
                starts = w.places[repeated[w.which]] if len(w.places) else w.places
                edges = np.zeros(len(block.codes) + 1, np.int64)
                np.add.at(edges, starts, 1)
                np.add.at(edges, starts + k, -1)
                keep = np.cumsum(edges[:-1]) == 0
                kept = _kept_texts(block, keep)
                left = np.bincount(block.owners()[keep], minlength=len(block.lengths))
                n = len(block.lengths)
                out = {
                    "row_id": np.arange(block.first_row, block.first_row + n),
                    "doc_id": block.doc_ids,
                    "n_words": block.lengths,
                    "n_removed": block.lengths - left,
                    "kept": kept,
                }
                columns = [pa.array(out[f], arrow.field(f).type) for f in out]
                if keep_type is not None:
                    columns.append(pa.array(block.keep, arrow.field("keep").type))
                rows = pa.RecordBatch.from_arrays(columns, schema=arrow)
                for start in range(0, n, 2000):
                    yield rows.slice(start, 2000)
                del row, block, w, repeated, starts, edges, keep, kept, out, columns, rows
                release_memory()

    return _with_answers(blocks, repeats).mapInArrow(remove, schema)


def dedup_substrings(docs: DataFrame, k: int = WINDOW, keep: list[str] | None = None) -> DataFrame:
    """The documents without the word sequences that occur twice; ``kept`` is what is left."""
    blocks = word_blocks(docs, keep=keep, name="substring-blocks")
    return remove_repeats(blocks, stored(repeated_windows(blocks, k), "repeats"), k)
