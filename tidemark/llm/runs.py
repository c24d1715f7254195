"""Operator 12: periodic runs of words, by a sparse dynamic program over diagonals.

A run is a stretch of consecutive words with smallest period ``q`` (words ``q`` apart are
equal), at least ``max(SHORTEST, TIMES * q)`` words long, that no neighbouring word extends.

Seen as a table of word against earlier word, a run of period ``q`` is a stretch of matches
along the diagonal of lag ``q``. Going through the words, each earlier occurrence of a word
lengthens the match of its lag by one, and where a diagonal ends its run is known if it is long
enough. Keeping every lag alive costs the square of a repetitive text, so the table is kept
sparse by levels: at level ``c = 1, 2, 4, ...`` what is matched are stretches of ``c`` words,
and each lengthens one lag only, that of its *nearest* earlier occurrence. No run is lost: a
stretch of ``c >= q`` words inside a run of smallest period ``q`` has its nearest earlier
occurrence exactly ``q`` words before, as a nearer one would give that part of the run, by Fine
and Wilf, a smaller period. So level ``c`` answers for ``c / 2 < q <= c``: as long as
the lag stays the same the diagonal grows, where it changes the diagonal ends, and the lag is the
smallest period of what it covered. A stretch that occurs once in its text leaves all further
levels, so most texts need two or three; the worst text of ``n`` words takes ``n log n`` steps.

All documents of a block advance together, one level at a time. There is no shuffle.

Defined results: a null or empty text has no words, no runs and an empty collapsed text; words
are compared as they are; repeated rows and null or repeated ids are rows of their own; other
columns are ignored, whatever their names; an empty table gives an empty table. Texts are read
whole; a text longer than a block is a block of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidemark.llm.blocks import release_memory, split_words
from tidemark.llm.tables import chunks, column

SHORTEST = 6
TIMES = 4
BLOCK_BYTES = 4 << 20

RUNS = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def find_runs(codes: np.ndarray, lengths: np.ndarray, shortest: int = SHORTEST, times: int = TIMES) -> np.ndarray:
    """The runs of texts that lie one behind the other: rows of text, start, length, period.

    ``codes`` are the words as numbers, ``lengths`` the words of each text; starts are counted
    in the text. Rows are in the order of text, start and period.
    """
    if times < 3:
        raise ValueError("levels need runs of at least three periods")
    n = len(codes)
    owners = np.repeat(np.arange(len(lengths)), lengths)
    places = np.arange(n)
    keys = owners * (int(codes.max()) + 1 if n else 1) + codes
    found = [np.zeros((0, 3), np.int64)]
    c = 1
    while len(places):
        order = np.argsort(keys, kind="stable")
        in_order = keys[order]
        same = in_order[1:] == in_order[:-1]
        lags = np.zeros(len(places), np.int64)
        lags[order[1:][same]] = (places[order[1:]] - places[order[:-1]])[same]
        found.append(_ended(places, lags, c, shortest, times))
        # Stretches that repeat get a number each; two that follow make one of the next level.
        repeats = np.zeros(len(places), bool)
        repeats[order[1:][same]] = True
        repeats[order[:-1][same]] = True
        numbers = np.empty(len(places), np.int64)
        numbers[order] = np.cumsum(np.concatenate([[False], ~same]))
        known = np.full(n + c, -1, np.int64)
        known[places[repeats]] = numbers[repeats]
        places = places[repeats]
        places = places[(known[places + c] >= 0)]
        places = places[owners[places] == owners[places + c]]
        keys = known[places] * (len(numbers) + 1) + known[places + c]
        c *= 2
    runs = np.concatenate(found)
    first = np.cumsum(lengths) - lengths
    owner = owners[runs[:, 0]] if len(runs) else np.zeros(0, np.int64)
    runs = np.column_stack([owner, runs[:, 0] - first[owner], runs[:, 1:]])
    return runs[np.lexsort((runs[:, 3], runs[:, 1], runs[:, 0]))]


def _ended(places: np.ndarray, lags: np.ndarray, c: int, shortest: int, times: int) -> np.ndarray:
    """The runs of one level: start, length, period."""
    ours = (lags <= c) & (2 * lags > c)
    places, lags = places[ours], lags[ours]
    if not len(places):
        return np.zeros((0, 3), np.int64)
    ends = np.flatnonzero((np.diff(places) != 1) | (np.diff(lags) != 0))
    first, last = np.concatenate([[0], ends + 1]), np.concatenate([ends, [len(places) - 1]])
    period = lags[first]
    matched = last - first + c
    enough = matched + period >= np.maximum(shortest, times * period)
    return np.column_stack([places[first] - period, matched + period, period])[enough]


def periodic_runs(docs: DataFrame, shortest: int = SHORTEST, times: int = TIMES) -> DataFrame:
    """Each document with its ``runs`` and ``collapsed``, the text with one period of each left.

    Words are joined by one space. A word goes if any run holds it after that run's first period.
    """
    arrow = to_arrow_schema(T.StructType.fromDDL(RUNS))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in chunks(batches, "text", BLOCK_BYTES):
            codes, vocab, lengths = split_words(column(rows, "text"))
            runs = find_runs(codes.astype(np.int64), lengths, shortest, times)
            first = np.cumsum(lengths) - lengths
            edges = np.zeros(len(codes) + 1, np.int64)
            begins = first[runs[:, 0]] + runs[:, 1]
            np.add.at(edges, begins + runs[:, 3], 1)
            np.add.at(edges, begins + runs[:, 2], -1)
            keep = np.cumsum(edges[:-1]) == 0
            left = np.add.reduceat(np.concatenate([keep, [False]]).astype(np.int64), first) if len(first) else lengths
            left = np.where(lengths > 0, left, 0)
            kept = pa.ListArray.from_arrays(_offsets(left), vocab.take(pa.array(codes[keep])).cast(pa.string()))
            spans = pa.StructArray.from_arrays([pa.array(runs[:, i]) for i in (1, 2, 3)], names=["start", "length", "period"])
            n_runs = np.bincount(runs[:, 0], minlength=len(lengths))
            columns = [column(rows, "doc_id"), pa.array(lengths), pa.ListArray.from_arrays(_offsets(n_runs), spans), pc.binary_join(kept, " ")]
            out = pa.Table.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow)], schema=arrow)
            yield from out.to_batches(max_chunksize=2000)
            del columns, out, kept, codes, vocab
            release_memory()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(find, RUNS)


def _offsets(sizes: np.ndarray) -> pa.Array:
    return pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))


def best_run(runs: Column) -> Column:
    """Of runs by start and period the one of greatest length over period, the first among equals."""

    def better(best: Column, run: Column) -> Column:
        return F.when(best["period"].isNull() | (run["length"] * best["period"] > best["length"] * run["period"]), run).otherwise(best)

    none = F.lit(None).cast("struct<start:long,length:long,period:long>")
    return F.aggregate(runs, none, better)
