"""Operator 8: documents packed into sequences of at most ``capacity`` tokens.

Only the number of pieces of each length decides a packing, and there are at most
``capacity`` lengths. So the plan is made from that histogram, whose size does not depend on
the corpus, and the documents are then dealt out to it where they are:

1. Full pieces fill a sequence each.
2. **Linear grouping.** The large lengths are cut, longest first, into groups of equal
   numbers of pieces, and rounded up to the longest of their group.
3. **Configurations.** Over these few sizes, a linear program finds how often each way to
   fill a sequence is used; ways are generated by a knapsack as long as they improve it.
   Whole uses are taken, the rest is left over.
4. **Substitution.** Actual pieces take the places of their group, longest first.
5. **Best fit.** The left-over and the small pieces go, longest first, where they leave the
   least room, and to new sequences when no room is left.

What is large is a matter of the corpus: rounding leaves room that only small pieces fill.
So a plan is made for several limits, and the one with the fewest sequences is taken.

Everything is done in runs: so many pieces of one length, put into so many consecutive
sequences at one offset. A piece finds its run by its length and its rank among the pieces
of that length. Ranks are counted within hashed shares of a length, so that a length that a
third of all pieces have is not ranked in one task.

Defined results: a null or empty text is the end token alone; repeated rows and ids are
separate documents; other columns are ignored; an empty table has no pieces. A text longer
than the capacity is cut, its first piece being the shorter one.
"""

from __future__ import annotations

import bisect
import zlib
from collections import defaultdict, deque
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tidemark.llm.tables import chunks, column, stored
from tidemark.llm.tokens import default_vocabulary, encoder, with_end

CAPACITY = 2048
END_ID = 0
GROUPS = 32
#: Lengths up to this part of the capacity are small; each is planned and the best plan kept.
SMALL_PARTS = (2, 3, 4, 8)
TEXT_BYTES = 8 << 20
#: Pieces of one length that are ranked together, about.
SHARE = 100_000

PIECES = "row_id long, doc_id long, piece int, start long, length long, ids_crc32 long"


def token_pieces(
    docs: DataFrame,
    vocabulary: str | None = None,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    keep_ids: bool = False,
) -> DataFrame:
    """The pieces of every document; with ``keep_ids`` their little-endian 32-bit ids too."""
    path = vocabulary or default_vocabulary()
    schema = PIECES + (", ids binary" if keep_ids else "")
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def cut(batches):
        row = TaskContext.get().partitionId() << 40
        for rows in chunks(batches, "text", TEXT_BYTES):
            ids, lengths = with_end(*encoder(path).encode(column(rows, "text")), end_id)
            count = -(-lengths // capacity)
            owner = np.repeat(np.arange(len(lengths)), count)
            piece = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
            first = lengths - (count - 1) * capacity
            start = np.where(piece == 0, 0, first[owner] + (piece - 1) * capacity)
            length = np.where(piece == 0, first[owner], capacity)
            at = (np.cumsum(lengths) - lengths)[owner] + start
            data = memoryview(ids.astype("<u4").tobytes())
            parts = [data[4 * a : 4 * (a + n)] for a, n in zip(at.tolist(), length.tolist())]
            out = {
                "row_id": row + owner,
                "doc_id": column(rows, "doc_id").take(pa.array(owner)),
                "piece": piece,
                "start": start,
                "length": length,
                "ids_crc32": [zlib.crc32(p) for p in parts],
            }
            if keep_ids:
                out["ids"] = [p.tobytes() for p in parts]
            columns = [v if isinstance(v, pa.Array) else pa.array(v, arrow.field(f).type) for f, v in out.items()]
            columns = [c.cast(arrow.field(f).type) for f, c in zip(out, columns)]
            batch = pa.RecordBatch.from_arrays(columns, schema=arrow)
            for i in range(0, batch.num_rows, 4096):
                yield batch.slice(i, 4096)
            row += rows.num_rows

    return docs.select("doc_id", "text").mapInArrow(cut, schema)


@dataclass
class Run:
    """``n`` pieces of one length, from a rank on, in sequences from ``sequence`` on."""

    length: int
    rank: int
    n: int
    sequence: int
    offset: int


class Plan:
    """A packing of a histogram of lengths, as runs."""

    def __init__(self, counts: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS, small_part: int = 4):
        self.capacity = capacity
        self.runs: list[Run] = []
        self.sequences = 0
        self.taken: dict[int, int] = defaultdict(int)
        #: Free room to the (first sequence, number) of the sequences that have it.
        self.rooms: dict[int, deque[tuple[int, int]]] = {}
        self.room_sizes: list[int] = []
        counts = {length: n for length, n in counts.items() if n > 0}
        if full := counts.pop(capacity, 0):
            self._put(capacity, full, 0, 0)
            self.sequences = full
        large = {length: n for length, n in counts.items() if length > capacity // small_part}
        left = dict(counts)
        if large:
            for length, n in self._grouped(large, groups).items():
                left[length] = n
        for length in sorted(left, reverse=True):
            self._best_fit(length, left[length])

    def _put(self, length: int, n: int, sequence: int, offset: int) -> None:
        self.runs.append(Run(length, self.taken[length], n, sequence, offset))
        self.taken[length] += n

    def _add_room(self, room: int, sequence: int, n: int) -> None:
        if room <= 0 or n <= 0:
            return
        if room not in self.rooms:
            self.rooms[room] = deque()
            bisect.insort(self.room_sizes, room)
        self.rooms[room].append((sequence, n))

    def _grouped(self, large: dict[int, int], groups: int) -> dict[int, int]:
        """Packs whole uses of configurations and returns the pieces left over."""
        total = sum(large.values())
        each = -(-total // groups)
        queues: list[deque[list[int]]] = []
        free = 0
        for length in sorted(large, reverse=True):
            n = large[length]
            while n:
                if not free:
                    queues.append(deque())
                    free = each
                part = min(n, free)
                queues[-1].append([length, part])
                n -= part
                free -= part
        # Groups that round up to the same length are one size.
        merged: dict[int, deque[list[int]]] = {}
        for queue in queues:
            merged.setdefault(queue[0][0], deque()).extend(queue)
        sizes = list(merged)
        demand = np.array([sum(n for _, n in merged[s]) for s in sizes], float)
        ways, uses = configurations(sizes, demand, self.capacity)
        for way, times in zip(ways, uses):
            whole = int(np.floor(times + 1e-9))
            whole = min([whole, *(sum(n for _, n in merged[s]) // a for s, a in zip(sizes, way) if a)])
            if whole:
                self._fill(way, whole, [merged[s] for s in sizes])
        left: dict[int, int] = defaultdict(int)
        for queue in merged.values():
            for length, n in queue:
                left[length] += n
        return {length: left.get(length, 0) for length in large}

    def _fill(self, way: np.ndarray, n: int, queues: list[deque[list[int]]]) -> None:
        """``n`` new sequences of one configuration; segments have the same tokens used."""
        segments = [(self.sequences, n, 0)]
        self.sequences += n
        for queue, times in zip(queues, way):
            for _ in range(int(times)):
                after = []
                for first, count, used in segments:
                    while count:
                        length, have = queue[0]
                        part = min(count, have)
                        self._put(length, part, first, used)
                        after.append((first, part, used + length))
                        first, count = first + part, count - part
                        if part == have:
                            queue.popleft()
                        else:
                            queue[0][1] -= part
                segments = after
        for first, count, used in segments:
            self._add_room(self.capacity - used, first, count)

    def _best_fit(self, length: int, n: int) -> None:
        """The same sequences as one piece at a time would get."""
        while n:
            at = bisect.bisect_left(self.room_sizes, length)
            if at < len(self.room_sizes):
                room = self.room_sizes[at]
                first, count = self.rooms[room].popleft()
                if not self.rooms[room]:
                    del self.rooms[room]
                    self.room_sizes.pop(at)
            else:
                room = self.capacity
                first, count = self.sequences, -(-n // (room // length))
                self.sequences += count
            fit = room // length
            full = min(count, n // fit)
            for i in range(fit if full else 0):
                self._put(length, full, first, self.capacity - room + i * length)
            n -= full * fit
            self._add_room(room - fit * length, first, full)
            first, count = first + full, count - full
            if count and n:
                part = min(n, fit)
                for i in range(part):
                    self._put(length, 1, first, self.capacity - room + i * length)
                n -= part
                self._add_room(room - part * length, first, 1)
                first, count = first + 1, count - 1
            self._add_room(room, first, count)


def best_plan(counts: dict[int, int], capacity: int = CAPACITY) -> Plan:
    plans = [Plan(counts, capacity, small_part=part) for part in SMALL_PARTS]
    return min(plans, key=lambda plan: plan.sequences)


def configurations(sizes: list[int], demand: np.ndarray, capacity: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Ways to fill a sequence and how often to use each, fewest in all (a linear program).

    Starts with one size a way. The prices of the sizes at the present solution tell the
    best new way, a knapsack; it enters the basis until none is worth more than a sequence.
    """
    m = len(sizes)
    basis = np.diag([float(capacity // s) for s in sizes])
    amounts = demand / np.diag(basis)
    for _ in range(40 * m):
        prices = np.linalg.solve(basis.T, np.ones(m))
        way, worth = best_way(sizes, np.maximum(prices, 0), capacity)
        if worth <= 1 + 1e-9:
            break
        change = np.linalg.solve(basis, way)
        ratios = np.where(change > 1e-9, amounts / np.where(change > 1e-9, change, 1), np.inf)
        out = int(np.argmin(ratios))
        basis[:, out] = way
        amounts = np.maximum(np.linalg.solve(basis, demand), 0)
    return [basis[:, i].copy() for i in range(m)], amounts


def best_way(sizes: list[int], prices: np.ndarray, capacity: int) -> tuple[np.ndarray, float]:
    """The way to fill a sequence that is worth most (an unbounded knapsack)."""
    order = np.array(sizes)
    best = np.zeros(capacity + 1)
    last = np.full(capacity + 1, -1)
    smallest = int(order.min())
    for room in range(smallest, capacity + 1):
        best[room], last[room] = best[room - 1], -1
        fits = order <= room
        worth = np.where(fits, best[room - np.minimum(order, room)] + prices, -1.0)
        top = int(np.argmax(worth))
        if worth[top] > best[room] + 1e-12:
            best[room], last[room] = worth[top], top
    way = np.zeros(len(sizes))
    room = capacity
    while room >= smallest:
        if last[room] < 0:
            room -= 1
        else:
            way[last[room]] += 1
            room -= sizes[last[room]]
    return way, float(best[capacity])


def ranked(pieces: DataFrame) -> DataFrame:
    """Each piece with its rank among those of its length, from 0, without one task a length."""
    total = pieces.count()
    shares = max(1, -(-total // SHARE))
    dealt = pieces.withColumn("share", F.pmod(F.xxhash64("row_id", "piece"), F.lit(shares)).cast("int"))
    counts = dealt.groupBy("length", "share").agg(F.count(F.lit(1)).alias("n"))
    before = counts.select(
        "length",
        "share",
        (F.sum("n").over(Window.partitionBy("length").orderBy("share")) - F.col("n")).alias("before"),
    )
    within = F.row_number().over(Window.partitionBy("length", "share").orderBy("row_id", "piece"))
    return (
        dealt.withColumn("within", within)
        .join(before, ["length", "share"])
        .withColumn("rank", F.col("before") + F.col("within") - 1)
        .drop("share", "before", "within")
    )


def pack(docs: DataFrame, capacity: int = CAPACITY, keep_ids: bool = False, **how) -> DataFrame:
    """Pieces with ``sequence_id`` and ``offset``: the place of each in the packing."""
    pieces = stored(token_pieces(docs, capacity=capacity, keep_ids=keep_ids, **how), "pieces")
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    runs = sorted(best_plan(counts, capacity).runs, key=lambda r: (r.length, r.rank))
    # At most a few thousand runs, as there are at most ``capacity`` lengths.
    keys = np.array([(r.length << 48) + r.rank for r in runs], np.int64)
    ranks = np.array([r.rank for r in runs], np.int64)
    sequences = np.array([r.sequence for r in runs], np.int64)
    offsets = np.array([r.offset for r in runs], np.int64)
    columns = [c for c in pieces.columns if c != "row_id"]
    schema = StructType([pieces.schema[c] for c in columns]).add("sequence_id", "long").add("offset", "long")
    arrow = to_arrow_schema(schema)

    def place(batches):
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False).astype(np.int64)
            rank = batch.column("rank").to_numpy(zero_copy_only=False).astype(np.int64)
            run = np.searchsorted(keys, (length << 48) + rank, side="right") - 1
            extra = [pa.array(sequences[run] + rank - ranks[run]), pa.array(offsets[run])]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), *extra], schema=arrow)

    return ranked(pieces).mapInArrow(place, schema)


def sequences(placed: DataFrame) -> DataFrame:
    """The packed sequences themselves, from ``pack(..., keep_ids=True)``: at most ``capacity`` ids each."""
    ordered = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(ordered, F.lit(b"").cast("binary"), lambda a, x: F.concat(a, x["ids"]))
    return placed.groupBy("sequence_id").agg(joined.alias("ids"), F.sum("length").alias("n_tokens"))
