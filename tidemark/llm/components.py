"""Connected components of links that are too many for one machine."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import stored

#: Links that a task connects at a time.
CHUNK = 1 << 22


def _least_reached(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of some links, and the least node that each is connected with by them."""
    nodes, places = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = places[: len(a)], places[len(a) :]
    least = np.arange(len(nodes))
    while True:
        low = np.minimum(least[x], least[y])
        lower = least.copy()
        for end in (x, y, least[x], least[y]):
            np.minimum.at(lower, end, low)
        lower = np.minimum(lower, lower[lower])
        if (lower == least).all():
            return nodes, nodes[least]
        least = lower


def _shortened(links: DataFrame) -> DataFrame:
    """``a, b, part``: links that connect the same nodes, each chunk of a task's links a star.

    Pre-aggregation before any shuffle by node: few links are one chunk, and done by it.
    """

    def shorten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def stars() -> Iterator[pa.RecordBatch]:
            a, b = (np.concatenate([h.column(i).to_numpy() for h in held]) for i in (0, 1))
            nodes, least = _least_reached(a, b)
            moved = nodes != least
            part = np.full(int(moved.sum()), min(int(a[0]), int(b[0])))
            found = pa.RecordBatch.from_arrays([pa.array(x) for x in (nodes[moved], least[moved], part)], names=["a", "b", "part"])
            for start in range(0, found.num_rows, 50_000):
                yield found.slice(start, 50_000)

        for batch in batches:
            if batch.num_rows:
                held.append(batch)
            if sum(h.num_rows for h in held) >= CHUNK:
                yield from stars()
                held = []
        if held:
            yield from stars()

    return links.mapInArrow(shorten, "a long, b long, part long")


def _step(links: DataFrame, towards_smaller: bool) -> DataFrame:
    """One star step: every node hands its neighbours on one side to the least node it knows."""
    if towards_smaller:
        sides = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    else:
        sides = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = sides.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")).withColumnRenamed("a", "hub")
    joined = sides.join(least, sides.a == least.hub)
    if towards_smaller:
        moved = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(joined.select("a", F.col("m").alias("b")))
    else:
        moved = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.where("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for every node of the links ``a, b``; a component is its least node.

    Tasks connect what they hold first. What is left of a chunk's links or fewer, one task connects,
    whatever the number of partitions they lay in. Of more, steps towards larger and smaller neighbours
    alternate until every link points at the least node of its component, some two to five rounds.
    Each round is written to the shared folder. A node with very many neighbours is a join
    key that adaptive execution can split.
    """
    short = stored(_shortened(links.select("a", "b").where("a <> b")), "links")
    parts = short.agg(F.min("part"), F.max("part"), F.count(F.lit(1))).first()
    now = short.select("a", "b")
    if parts[0] != parts[1]:
        # Few links come together in one task, many are spread.
        gathered = now.coalesce(1) if parts[2] <= CHUNK else now.hint("rebalance")
        short = stored(_shortened(gathered), "links")
        parts = short.agg(F.min("part"), F.max("part")).first()
        now = short.select("a", "b")
    if parts[0] == parts[1]:
        # One chunk, or none: each link points at the least node of its component.
        return now.withColumnsRenamed({"a": "node", "b": "component"})
    state = None
    while True:
        row = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b") % (1 << 40))).first()
        if tuple(row) == state:
            return now.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("component"))
        state = tuple(row)
        now = stored(_step(_step(now, False), True), "links")
