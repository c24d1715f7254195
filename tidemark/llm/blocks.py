"""Documents as blocks of coded words: split once, read by every pass that follows.

A block holds the words of some neighbouring documents as numbers into a vocabulary of its
own, most frequent word first. It is bounded in bytes of text (one long text may exceed it
alone), so a pass over a table holds one block at a time whatever the size of the table.
Blocks are written to the shared folder, which also makes block and row numbers stable: a
lost executor never renumbers them.
"""

from __future__ import annotations

import copy
import ctypes
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidemark.llm.tables import BATCH_BYTES, SMALL_BATCH, chunks, column, setting, stored

BLOCK_BYTES = 8 << 20


def split_words(texts: pa.Array, lower: bool = False) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of each text: codes, vocabulary, words per text.

    A null text has no words. ``lower`` folds A-Z only. The vocabulary is ordered by
    falling frequency, which keeps the codes small.
    """
    texts = pc.fill_null(texts, "")
    if lower:
        texts = pc.ascii_lower(texts)
    parts = pc.ascii_split_whitespace(texts)
    lengths = pc.list_value_length(parts).to_numpy(zero_copy_only=False).astype(np.int64)
    coded = parts.flatten().dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False)
    vocab = coded.dictionary
    blank = pc.index(vocab, "").as_py()
    if blank >= 0:
        owners = np.repeat(np.arange(len(lengths)), lengths)
        full = codes != blank
        lengths = np.bincount(owners[full], minlength=len(lengths))
        codes = codes[full]
    counts = np.bincount(codes, minlength=len(vocab))
    order = np.argsort(-counts, kind="stable")[: int(np.count_nonzero(counts))]
    place = np.zeros(len(vocab), np.int32)
    place[order] = np.arange(len(order), dtype=np.int32)
    return place[codes], vocab.take(pa.array(order)), lengths.astype(np.int64)


def pack_ints(values: np.ndarray) -> bytes:
    """32-bit numbers as four byte planes, compressed."""
    planes = np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack_ints(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


def pack_words(words: pa.Array) -> bytes:
    """Words without white space, one a line, compressed."""
    joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words), "\n")
    return zstandard.ZstdCompressor(level=1).compress(joined[0].as_py().encode())


def unpack_words(data: bytes) -> list[bytes]:
    text = zstandard.ZstdDecompressor().decompress(data)
    return text.split(b"\n") if text else []


def word_hashes(words: Iterable[bytes], seed: int) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(w, seed) for w in words], dtype=np.uint64)


class Block:
    """One row of a block table, unpacked."""

    def __init__(self, row: dict):
        self.block_id: int = row["block_id"]
        self.first_row: int = row["first_row"]
        self.doc_ids: list[int | None] = row["doc_ids"]
        self.lengths = unpack_ints(row["lengths"])
        self.codes = unpack_ints(row["codes"])
        self.vocab = unpack_words(row["vocab"])
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)])
        self.keep: list[dict] | None = row.get("keep")

    def window_starts(self, k: int) -> np.ndarray:
        """The places at which k words of one document follow."""
        ends = np.repeat(self.starts[1:], self.lengths)
        places = np.arange(len(self.codes))
        return places[places + k <= ends]

    def owners(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.lengths)), self.lengths)

    def parts(self, at: np.ndarray, n_words: int) -> Iterator[tuple[np.ndarray, Block]]:
        """The documents ``at`` in runs of about so many words, or one text, each as a block with the same vocabulary."""
        runs = np.cumsum(self.lengths[at]) // n_words
        for docs in np.split(at, np.flatnonzero(np.diff(runs)) + 1) if len(at) else []:
            part = copy.copy(self)
            part.doc_ids = [self.doc_ids[i] for i in docs]
            part.lengths = self.lengths[docs]
            part.codes = np.concatenate([self.codes[self.starts[i] : self.starts[i + 1]] for i in docs])
            part.starts = np.concatenate([[0], np.cumsum(part.lengths)])
            yield docs, part


BLOCK_SCHEMA = "block_id long, first_row long, doc_ids array<long>, lengths binary, codes binary, vocab binary, n_words long"


def word_blocks(
    docs: DataFrame,
    lower: bool = False,
    keep: list[str] | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
    name: str = "blocks",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The documents as a stored block table; ``keep`` carries further columns of each row."""
    schema = T.StructType.fromDDL(BLOCK_SCHEMA)
    kept = None
    if keep:
        kept = T.StructType([docs.schema[c] for c in keep])
        schema = schema.add("keep", T.ArrayType(kept))
    arrow = to_arrow_schema(schema)
    kept_arrow = to_arrow_schema(kept) if kept else None
    cols = list(dict.fromkeys([id_column, text_column, *(keep or [])]))

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        row = part << 40
        for rows in chunks(batches, text_column, block_bytes):
            codes, vocab, lengths = split_words(column(rows, text_column), lower)
            fields = {
                "block_id": [row],
                "first_row": [row],
                "doc_ids": [rows.column(id_column).to_pylist()],
                "lengths": [pack_ints(lengths)],
                "codes": [pack_ints(codes)],
                "vocab": [pack_words(vocab)],
                "n_words": [len(codes)],
            }
            out = [pa.array(fields[f], arrow.field(f).type) for f in fields]
            if kept is not None:
                structs = rows.select(keep).cast(kept_arrow).to_struct_array()
                structs = structs.combine_chunks() if isinstance(structs, pa.ChunkedArray) else structs
                if isinstance(structs, pa.ChunkedArray):
                    structs = structs.chunk(0)
                lists = pa.ListArray.from_arrays(pa.array([0, len(structs)], pa.int32()), structs)
                out.append(lists.cast(arrow.field("keep").type))
            yield pa.RecordBatch.from_arrays(out, schema=arrow)
            row += rows.num_rows

    with setting(docs.sparkSession, BATCH_BYTES, SMALL_BATCH):
        return stored(docs.select(*cols).mapInArrow(split, schema), name)


def release_memory() -> None:
    """Gives what freed arrays held back to the system, before the next block is opened."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library


def read_blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[Block]:
    """The blocks of a task, one in memory at a time if the caller drops its own before it asks for the next."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield Block(batch.slice(i, 1).to_pylist()[0])
            release_memory()


def small_batches(rows: Iterable[dict], schema: pa.Schema, limit: int = 2048) -> Iterator[pa.RecordBatch]:
    held: list[dict] = []
    for row in rows:
        held.append(row)
        if len(held) >= limit:
            yield pa.RecordBatch.from_pylist(held, schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=schema)


MIX1, MIX2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spreads every bit of 64-bit numbers over all others."""
    h = h ^ (h >> np.uint64(33))  # a copy, changed in place from here on
    h *= MIX1
    h ^= h >> np.uint64(33)
    h *= MIX2
    h ^= h >> np.uint64(33)
    return h


def powers(base: int, n: int) -> np.ndarray:
    steps = np.full(n, base, np.uint64)
    if n:
        steps[0] = 1
    return np.multiply.accumulate(steps)


def rolling_hashes(values: np.ndarray, starts: np.ndarray, k: int, base: int) -> np.ndarray:
    """64-bit polynomial hashes of the k values from each start on, the same wherever they stand.

    Sums of ``value * base**place`` modulo 2**64; an odd base has an inverse, which takes
    the place out again.
    """
    n = len(values)
    sums = np.zeros(n + 1, np.uint64)
    steps = powers(base, n)
    steps *= values
    np.cumsum(steps, out=sums[1:])
    del steps
    found = sums[k:][starts]
    found -= sums[starts]
    del sums
    found *= powers(pow(base, -1, 1 << 64), n)[starts]
    return mixed(found)
