"""Reading the corpus tables, and intermediate results in the shared folder."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import local_frame, work_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Whether the shuffle files of a query go when it ends, not when the driver collects its garbage.
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Bytes after which a batch of rows is sent to Python. Spark's own bound lets 35 MB of texts pass at a time,
#: held by the JVM and the worker at once; used where batches say nothing about the result.
BATCH_BYTES, SMALL_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch", "4m"


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A session setting for the queries that run in the block."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


#: Tables stored since each open ``passing_tables`` began.
_passing: list[list[tuple[str, T.StructType]]] = []


def stored(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """The frame as a table in the shared folder: read again after a loss, never made again.

    ``by`` is a column with a folder for each value. What the query shuffled goes with it.
    """
    path = work_folder(df.sparkSession, f"llm-{name}")
    with setting(df.sparkSession, SHUFFLES_GO, "true"):
        (df.write.partitionBy(by) if by else df.write).parquet(path)
    if _passing:
        _passing[-1].append((path, df.schema))
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def passing_tables(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """Tables stored in the block are emptied at its end, those made by the given function excepted.

    A frame that still reads one of them fails afterwards. With an error the tables stay.
    """
    _passing.append([])
    try:

        def kept(df: DataFrame, name: str) -> DataFrame:
            table = stored(df, name)
            _passing[-1].pop()
            return table

        yield kept
        for path, schema in _passing[-1]:
            local_frame(spark, [], schema).write.mode("overwrite").parquet(path)
    finally:
        _passing.pop()


def with_rows(docs: DataFrame, name: str) -> DataFrame:
    """Stored rows ``row_id, text, row``: a number for each, and the row itself as one struct.

    The struct keeps the columns apart from those an operator adds, whatever their names; the
    text is stored once, in it.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = stored(docs.select(F.monotonically_increasing_id().alias("row_id"), row), name)
    return rows.select("row_id", F.col("row.text").alias("text"), "row")


def text_bytes(texts: pa.Array) -> np.ndarray:
    """The bytes of each text, 0 for null."""
    return pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def chunks(batches: Iterable[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.Table]:
    """The rows in order, dealt into tables of at most ``limit`` bytes of ``column``, or one row."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        sizes = text_bytes(batch.column(column))
        start, n = 0, batch.num_rows
        ends = np.cumsum(sizes)
        while start < n:
            before = int(ends[start - 1]) if start else 0
            stop = int(np.searchsorted(ends, before + limit - size, side="right"))
            if stop <= start:
                if held:
                    yield pa.Table.from_batches(held).combine_chunks()
                    held, size = [], 0
                    continue
                stop = start + 1
            held.append(batch.slice(start, stop - start))
            size += int(ends[stop - 1]) - before
            start = stop
            if size >= limit:
                yield pa.Table.from_batches(held).combine_chunks()
                held, size = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def column(rows: pa.Table, name: str) -> pa.Array:
    """A column of a table as one array, large offsets made small."""
    found = rows.column(name)
    if isinstance(found, pa.ChunkedArray):
        found = found.combine_chunks() if found.num_chunks != 1 else found.chunk(0)
        if isinstance(found, pa.ChunkedArray):
            found = pa.concat_arrays(found.chunks) if found.num_chunks else pa.array([], found.type)
    if pa.types.is_large_string(found.type):
        found = found.cast(pa.string())
    return found
