"""Operator 3: token ids in compressed binary files, in the order of the documents' ids.

The documents are dealt out by ranges of doc_id and sorted; each task encodes its texts and
writes files of bounded size, numbered in order. A file holds

    8 bytes   magic
    8 bytes   length of the header
    header    JSON: documents, ids, block size, scale, and for each block its length and two
              checksums (of the ids and of the coded bytes)
    arrays    document numbers, ids per document, the order-0 table (compressed)
    blocks    range-coded, each from the same starting state (``idcoder``)

A block is read alone by its place in the header, so a file can be split among readers or
entered in the middle.

Defined results: a null or empty text has the end id alone; a null doc_id comes first;
repeated ids are ordered by text; other columns are ignored; an empty table writes no file.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tidemark.llm.files import finished_file, open_file
from tidemark.llm.idcoder import BLOCK_IDS, Order0, block_lengths, pack_ids, unpack_blocks
from tidemark.llm.tables import chunks, column, stored
from tidemark.llm.tokens import default_vocabulary, encoder, with_end
from tidemark.session import work_folder

MAGIC = b"tmids\x00\x00\x01"
END_ID = 2
TEXT_BYTES = 16 << 20
NO_ID = -(1 << 63)

FILES = "part long, number long, file string, n_docs long, n_ids long"
ROWS = "doc_id long, start long, n_tokens long, ids_crc32 long"


def file_bytes(doc_ids: np.ndarray, ids: np.ndarray, lengths: np.ndarray, block_ids: int = BLOCK_IDS) -> Iterator[bytes]:
    """The parts of a file."""
    order0, blocks, sums = pack_ids(ids, block_ids)
    arrays = [doc_ids.astype("<i8"), lengths.astype("<i8"), order0.ids.astype("<u4"), order0.freq.astype("<u4")]
    packed = [zstandard.ZstdCompressor(level=3).compress(a.tobytes()) for a in arrays]
    header = {
        "n_docs": len(doc_ids),
        "n_ids": len(ids),
        "block_ids": block_ids,
        "scale_bits": order0.bits,
        "arrays": [len(p) for p in packed],
        "arrays_crc32": zlib.crc32(b"".join(packed)),
        "blocks": [[len(b), zlib.crc32(b), s] for b, s in zip(blocks, sums)],
    }
    text = json.dumps(header).encode()
    yield MAGIC + len(text).to_bytes(8, "little") + text
    yield from packed
    yield from blocks


class IdFile:
    """An open file: its documents, and its ids by blocks."""

    def __init__(self, stream):
        self.stream = stream
        if stream.read(8) != MAGIC:
            raise ValueError("not a file of token ids")
        size = int.from_bytes(stream.read(8), "little")
        self.header = json.loads(stream.read(size))
        data = [stream.read(n) for n in self.header["arrays"]]
        if zlib.crc32(b"".join(data)) != self.header["arrays_crc32"]:
            raise ValueError("the tables of the file are damaged")
        raw = [zstandard.ZstdDecompressor().decompress(d) if d else b"" for d in data]
        self.doc_ids = np.frombuffer(raw[0], "<i8")
        self.lengths = np.frombuffer(raw[1], "<i8")
        self.order0 = Order0(np.frombuffer(raw[2], "<u4"), np.frombuffer(raw[3], "<u4"), self.header["scale_bits"])
        sizes = np.array([b[0] for b in self.header["blocks"]], np.int64)
        self.offsets = 16 + size + sum(self.header["arrays"]) + np.concatenate([[0], np.cumsum(sizes)])

    def ids(self, first: int = 0, last: int | None = None) -> np.ndarray:
        """The ids of the blocks from ``first`` up to ``last``, all by default."""
        blocks = self.header["blocks"][first:last]
        if not blocks:
            return np.zeros(0, np.uint32)
        self.stream.seek(int(self.offsets[first]))
        data = self.stream.read(sum(b[0] for b in blocks))
        payloads, at = [], 0
        for i, (size, crc, _) in enumerate(blocks):
            payloads.append(data[at : at + size])
            if zlib.crc32(payloads[-1]) != crc:
                raise ValueError(f"block {first + i} is damaged")
            at += size
        lengths = block_lengths(self.header["n_ids"], self.header["block_ids"])[first:last]
        return unpack_blocks(self.order0, payloads, lengths, [b[2] for b in blocks])


def write_ids(docs: DataFrame, folder: str, vocabulary: str | None = None, end_id: int = END_ID, text_bytes: int = TEXT_BYTES) -> DataFrame:
    """Writes the files and returns them in a stored table, ``first_id`` being the ids before each."""
    path = vocabulary or default_vocabulary()
    arrow = to_arrow_schema(StructType.fromDDL(FILES))

    def write(batches):
        part = TaskContext.get().partitionId()
        for number, rows in enumerate(chunks(batches, "text", text_bytes)):
            ids, lengths = with_end(*encoder(path).encode(column(rows, "text")), end_id)
            doc_ids = column(rows, "doc_id").fill_null(NO_ID).to_numpy(zero_copy_only=False)
            name = f"{folder}/ids-{part:06d}-{number:04d}.tmids"
            with finished_file(name) as out:
                for piece in file_bytes(doc_ids, ids, lengths):
                    out.write(piece)
            row = {"part": part, "number": number, "file": name, "n_docs": len(lengths), "n_ids": len(ids)}
            yield pa.RecordBatch.from_pylist([row], schema=arrow)

    spark = docs.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = docs.select("doc_id", "text").repartitionByRange(tasks, F.col("doc_id").asc_nulls_first())
    ordered = ordered.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
    files = stored(ordered.mapInArrow(write, FILES), "id-files")
    # One row a file: the table is some ten-thousandth of the corpus.
    before = F.sum("n_ids").over(Window.orderBy("part", "number")) - F.col("n_ids")
    return files.withColumn("first_id", before)


def read_ids(files: DataFrame) -> DataFrame:
    """Every document back from the files: ``doc_id, start, n_tokens, ids_crc32``."""
    arrow = to_arrow_schema(StructType.fromDDL(ROWS))

    def read(batches):
        for batch in batches:
            for name, first in zip(batch.column("file").to_pylist(), batch.column("first_id").to_pylist()):
                with open_file(name) as stream:
                    found = IdFile(stream)
                    raw = memoryview(found.ids().astype("<u4").tobytes())
                ends = np.cumsum(found.lengths)
                starts = ends - found.lengths
                sums = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist())]
                ids = pa.array(found.doc_ids, mask=found.doc_ids == NO_ID)
                columns = [ids, pa.array(first + starts), pa.array(found.lengths), pa.array(sums, pa.int64())]
                out = pa.RecordBatch.from_arrays(columns, schema=arrow)
                for i in range(0, out.num_rows, 4096):
                    yield out.slice(i, 4096)

    tasks = max(1, min(files.count(), 4 * files.sparkSession.sparkContext.defaultParallelism))
    return files.select("file", "first_id").repartition(tasks, "file").mapInArrow(read, ROWS)


def ids_round_trip(docs: DataFrame, **how) -> DataFrame:
    """The documents written as ids, and read back."""
    return read_ids(write_ids(docs, work_folder(docs.sparkSession, "ids"), **how))
