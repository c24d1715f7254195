"""Operator 13: near duplicates by SimHash, found by covering locality-sensitive hashing.

1. **Fingerprints.** A bit is set if more than half the hashes of a text's shingles of three
   words, repeats included, have it set. The hash is XXH64 with seed 42.
2. **Tables.** Each bit position has a vector over GF(2) of ``radius + 1`` places, and each
   non-zero vector ``v`` of that length makes a table: its mask keeps the positions whose
   vector has an odd product with ``v``. The positions in which two fingerprints differ give at
   most ``radius`` equations for ``v``, too few to leave only zero, so some table masks all
   of them out: **every** pair within the radius shares a bucket of one of the tables, 15 for a
   radius of 3. Vectors are dealt in turn, so a mask keeps 32 to 36 of 64 bits.
3. **Buckets.** Distinct fingerprints are dealt to their buckets. Members of a bucket differ
   in the positions its mask leaves out, 32 at most. A bucket of more than ``LARGE``
   members is split by the same construction on just these positions, after which at most 16
   are free, hence at most 65,536 members are left, whatever the table holds. A bucket sends
   one link for each member that is connected within it, to the least fingerprint it reaches,
   never its pairs.
4. **Components** of the links, and the least doc_id of each.

Copies have one fingerprint and enter once. Nothing is capped, and no pair within the radius
is missed.

Defined results: a null text or one without words has the fingerprint zero and is linked like
any other; fewer than three words make one shingle; a null doc_id is never the least of a
component, and a component without any other has a null ``component_id``; repeated rows are
rows of their own; other columns are ignored, whatever their names; an empty table gives an
empty table. Texts are read whole, their hashes in pieces.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import combinations, islice, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.llm.tables import chunks, column, stored

SHINGLE = 3
SEED = 42
RADIUS = 3
BITS = 64
#: Members from which on a bucket is split.
LARGE = 512
#: Members up to which a bucket is compared pair by pair, in memory.
DENSE = 1024
#: Salts of the join that marks large buckets.
SALTS = 16
#: A fingerprint with more than this share of all rows is joined by broadcast; there are fewer.
HOT = 1000
PIECE = 1 << 16


def covering_masks(positions: Sequence[int], radius: int = RADIUS) -> list[int]:
    """Masks over the positions such that any ``radius`` of them lie outside one mask."""
    tables = (1 << (radius + 1)) - 1
    return [
        sum(1 << place for i, place in enumerate(positions) if ((1 + i % tables) & v).bit_count() % 2)
        for v in range(1, tables + 1)
    ]


def free_positions(mask: int, positions: Sequence[int] = range(BITS)) -> list[int]:
    return [p for p in positions if not mask >> p & 1]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


# ---- fingerprints ------------------------------------------------------------


def _bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each of the 64 bits set."""
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8), bitorder="little").reshape(-1, BITS)
    # Sums of 255 ones fit into a byte, which adds fastest.
    full = len(bits) // 255 * 255
    counts = bits[:full].reshape(-1, 255, BITS).sum(axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
    return counts + bits[full:].sum(axis=0, dtype=np.uint8)


def fingerprint(text: bytes, k: int = SHINGLE) -> int:
    """The fingerprint of a UTF-8 text, 0 if it has no words."""
    words = text.lower().split()
    if not words:
        return 0
    shingles = map(b" ".join, zip(*(words[i:] for i in range(k)))) if len(words) >= k else iter([b" ".join(words)])
    counts = np.zeros(BITS, np.int64)
    total = max(1, len(words) - k + 1)
    for start in range(0, total, PIECE):
        size = min(PIECE, total - start)
        counts += _bit_counts(np.fromiter(map(xxhash.xxh64_intdigest, islice(shingles, size), repeat(SEED)), np.uint64, size))
    return int(np.packbits(2 * counts > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, k: int = SHINGLE) -> DataFrame:
    """``doc_id, bits`` of every document; the bits as a signed number."""

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in chunks(batches, "text", 8 << 20):
            texts = pc.fill_null(column(rows, "text"), "").cast(pa.binary())
            bits = np.array([fingerprint(t.as_py(), k) for t in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([column(rows, "doc_id"), pa.array(bits)], names=["doc_id", "bits"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(mark, "doc_id long, bits long")


# ---- links -------------------------------------------------------------------


def _settled(labels: np.ndarray, lowered) -> np.ndarray:
    """Labels lowered along the links until every member has the least that it reaches."""
    while True:
        lower = lowered(labels)
        lower = np.minimum(lower, lower[lower])
        if (lower == labels).all():
            return labels
        labels = lower


def connected(members: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """For each of the sorted distinct fingerprints the place of the least it is connected with.

    Few are compared with each other. Many differ in few positions, which index a table that
    is asked for every neighbour within the radius: work in proportion to their number.
    """
    n = len(members)
    if n <= DENSE:
        near = np.bitwise_count(members[:, None] ^ members[None, :]) <= radius
        return _settled(np.arange(n), lambda labels: np.where(near, labels[None, :], n).min(axis=1))
    differing = int(np.bitwise_or.reduce(members ^ members[0]))
    places = [p for p in range(BITS) if differing >> p & 1]
    flips = [sum(1 << i for i in c) for size in range(1, radius + 1) for c in combinations(range(len(places)), size)]
    index = np.zeros(n, np.int64)
    for i, p in enumerate(places):
        index |= ((members >> np.uint64(p)) & np.uint64(1)).astype(np.int64) << i
    at = np.full(1 << len(places), n, np.int64)
    at[index] = np.arange(n)

    def lowered(labels: np.ndarray) -> np.ndarray:
        known, lower = np.append(labels, n), labels.copy()
        for flip in flips:
            np.minimum(lower, known[at[index ^ flip]], out=lower)
        return lower

    return _settled(np.arange(n), lowered)


def _pairs_of_two(first: np.ndarray, second: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    near = np.bitwise_count(first ^ second) <= radius
    return np.maximum(first, second)[near], np.minimum(first, second)[near]


def bucket_links(buckets: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``a, b``: members of a bucket that links connect within it, and the least they reach."""

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("members")
            offsets = lists.offsets.to_numpy()
            members = lists.values.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            sizes = np.diff(offsets)
            twos = offsets[:-1][sizes == 2]
            found = [_pairs_of_two(members[twos], members[twos + 1], radius)]
            for i in np.flatnonzero(sizes > 2):
                own = np.sort(members[offsets[i] : offsets[i + 1]])
                least = connected(own, radius)
                moved = least != np.arange(len(own))
                found.append((own[moved], own[least[moved]]))
            a, b = (np.concatenate(side).view(np.int64) for side in zip(*found))
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return buckets.select("members").mapInArrow(link, "a long, b long")


def _salt() -> Column:
    return F.pmod(F.xxhash64("bits"), F.lit(SALTS))


def covering_links(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links ``a, b`` that connect all fingerprints ``bits`` within the radius of one another."""
    masks = covering_masks(range(BITS), radius)
    keys = F.array(*[F.col("bits").bitwiseAND(F.lit(_signed(m))) for m in masks])
    dealt = distinct.select("bits", F.posexplode(keys).alias("table", "key"))
    counts = dealt.groupBy("table", "key").agg(F.count(F.lit(1)).alias("n"))
    large = stored(counts.where(F.col("n") > LARGE).select("table", "key"), "large-buckets")
    rest, split = dealt, None
    if not large.isEmpty():
        # Fewer than tables / LARGE a fingerprint; a hot bucket has SALTS keys in this join.
        marks = large.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
        salted = dealt.withColumn("salt", _salt())
        rest = salted.join(marks, ["table", "key", "salt"], "left_anti").drop("salt")
        inner = [m for outer in masks for m in covering_masks(free_positions(outer), radius)]
        of_table = F.slice(F.array(*[F.lit(_signed(m)) for m in inner]), F.col("table") * len(masks) + 1, F.lit(len(masks)))
        parts = salted.join(marks, ["table", "key", "salt"], "left_semi").select("bits", "table", "key", F.posexplode(of_table).alias("part", "mask"))
        split = parts.groupBy("table", "key", "part", F.col("bits").bitwiseAND(F.col("mask")).alias("part_key")).agg(F.collect_list("bits").alias("members"))
    buckets = rest.groupBy("table", "key").agg(F.collect_list("bits").alias("members")).select("members")
    if split is not None:
        buckets = buckets.union(split.select("members"))
    return bucket_links(buckets.where(F.size("members") > 1), radius)


# ---- components --------------------------------------------------------------


def simhash_components(docs: DataFrame, k: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """``doc_id, bits, component_id`` of every document."""
    marks = stored(fingerprints(docs, k), "fingerprints")
    distinct = stored(marks.groupBy("bits").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("copies")), "distinct-fingerprints")
    nodes = components(covering_links(distinct.select("bits"), radius))
    named = distinct.join(nodes, distinct.bits == nodes.node, "left").select(
        "bits", "first_id", "copies", F.coalesce("component", "bits").alias("component")
    )
    named = stored(named, "fingerprint-components")
    least = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    ids = stored(named.join(least, "component").select("bits", "copies", "component_id"), "component-ids")
    rows = marks.count()
    # At most HOT fingerprints, by their share of the rows.
    hot = F.broadcast(ids.where(F.col("copies") * HOT > rows).select("bits", "component_id"))
    common = marks.join(hot, "bits")
    others = marks.join(hot, "bits", "left_anti").join(ids.select("bits", "component_id"), "bits")
    return common.unionByName(others).select("doc_id", "bits", "component_id")
