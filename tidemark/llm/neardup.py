"""Operator 5: near-duplicate documents by DartMinHash signatures.

A document is the bag of its shingles of five consecutive words; how often one occurs is its
weight. Two documents are linked if their weighted Jaccard similarity (shared weight over
joint weight) is at least 0.8, and a class is what links connect.

1. **Signatures.** Each shingle owns the strip of a plane above its weight: darts fall on the
   plane at random, the same for every document, since they are hashes of the shingle. Along
   the strip they come in order of rank, at a rate of one for each unit of weight and rank.
   A document takes the darts within its weights up to a rank that gives it some
   ``K (ln K + 3)`` of them; a hash deals them to ``K`` coordinates, and each keeps its
   earliest. If a coordinate got none, the rank is doubled. Two documents agree in a
   coordinate with the probability of their similarity.
2. **Bands.** Four coordinates make a key, 32 keys a document: a pair at 0.8 shares none with
   a probability of 5e-8. Copies (equal word sequences) are put together first and enter once.
3. **Links.** Buckets are cut by size, since similar documents are of similar size. All
   comparisons are exact, on the shingles themselves. In the first bands the members of a
   bucket are compared with the least of them. Then, in all bands, the largest class of a bucket
   stands for its rows: what else lies there is compared with the member of that class there
   that has the most links, which brings together the copies of one text. Then what shares a bucket with a large class is compared with the texts of the
   class, in blocks of texts, again with those that joined by that, for some rounds, and at
   last what is left in a bucket without being of one class, in blocks as well. So every
   pair that shares a bucket was compared, or is too unlike in size, or is in one class
   anyway; pairs within a group are never emitted, and nothing is capped.

Shingles are compared by 48 bits of their hashes. A bucket that holds a third of all rows is
met by aggregates that combine before the shuffle and by joins that can be split.

Defined results: a document without words (null, empty, white space) is alone in its class; one
of one to four words has one shingle, all its words; repeated rows are copies; a null doc_id
takes part, and a class is named by the least doc_id in it, null if it has none; other
columns are ignored; an empty table gives no rows. Long texts are taken whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tidemark.llm.blocks import Block, mixed, read_blocks, release_memory, rolling_hashes, small_batches, word_blocks, word_hashes
from tidemark.llm.components import components
from tidemark.llm.tables import BATCH_BYTES, SHUFFLES_GO, SMALL_BATCH, setting, stored

SHINGLE = 5
SIMILARITY = 0.8
BANDS = 32
BAND_ROWS = 4
FIRST_BANDS = 4
#: Rounds over all bands in which what lies beside the largest class of a bucket meets its hub.
HUB_ROUNDS = 2
#: Classes of so many texts are compared in blocks of texts.
LARGE_CLASS = 64
#: Rounds in which large classes meet their buckets; what joins in the last is compared in its buckets.
CLASS_ROUNDS = 4
#: A block of texts: at most about so many, of so many bytes.
ROW_TEXTS = 128
ROW_BYTES = 4 << 20
ITEM_SLICE = 8192
#: Words of a block whose shingles are held at a time; a longer text is held alone.
PART_WORDS = 1 << 17
#: Bucket members, and bytes of their shingles, for which the rounds have one task more.
TASK_MEMBERS, TASK_BYTES = 50_000, 32 << 20

WORD_SEED = 41
BASE = 0xA0761D6478BD642F
SEQUENCE_BASES = (0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3)
STEP = np.uint64(0x9E3779B97F4A7C15)

SIGNATURES = "row_id long, block_id long, doc_id long, size long, h1 long, h2 long, keys array<long>"


class Shingles:
    """The shingles of a block's documents: hash, owner and weight, by owner; ``vocabulary`` has the hashes of its words."""

    def __init__(self, block: Block, vocabulary: np.ndarray, k: int = SHINGLE):
        words = vocabulary[block.codes]
        starts = block.window_starts(k)
        hashes = rolling_hashes(words, starts, k, BASE)
        owners = block.owners()[starts]
        short = np.flatnonzero((block.lengths > 0) & (block.lengths < k))
        if len(short):
            sums = np.array([_sequence(words[a:b], BASE) for a, b in zip(block.starts[short], block.starts[short + 1])], np.uint64)
            hashes, owners = np.concatenate([hashes, sums]), np.concatenate([owners, short])
        # One key for owner and hash; owners are few enough in a block to leave 40 bits.
        order = np.argsort((owners.astype(np.uint64) << np.uint64(40)) | (hashes >> np.uint64(24)))
        hashes, owners = hashes[order], owners[order]
        new = np.ones(len(order), bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (owners[1:] != owners[:-1])
        first = np.flatnonzero(new)
        self.hashes, self.owners = hashes[first], owners[first]
        self.weights = np.diff(np.append(first, len(order)))
        self.words = words


def _sequence(words: np.ndarray, base: int) -> int:
    total = 0
    for w in words.tolist():
        total = (total * base + w + 1) & 0xFFFFFFFFFFFFFFFF
    return int(mixed(np.array([total], np.uint64))[0])


def sequence_hashes(words: np.ndarray, starts: np.ndarray, base: int) -> np.ndarray:
    """A 64-bit hash of the whole word sequence of each document, with its length."""
    n = len(starts) - 1
    steps = np.full(len(words), base, np.uint64)
    if len(steps):
        steps[0] = 1
    sums = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(mixed(words + np.uint64(base & 0xFFFF)) * np.multiply.accumulate(steps), out=sums[1:])
    inverse = np.full(len(words) + 1, pow(base, -1, 1 << 64), np.uint64)
    inverse[0] = 1
    back = np.multiply.accumulate(inverse)
    lengths = np.diff(starts).astype(np.uint64)
    return mixed((sums[starts[1:]] - sums[starts[:-1]]) * back[starts[:-1]] + lengths * STEP) if n else np.zeros(0, np.uint64)


def dart_signatures(owners: np.ndarray, hashes: np.ndarray, weights: np.ndarray, n: int, k: int) -> np.ndarray:
    """The earliest dart of each of ``k`` coordinates for each of ``n`` weighted sets (0: empty set)."""
    signature = np.zeros((n, k), np.uint64)
    totals = np.bincount(owners, weights=weights, minlength=n)
    todo = totals > 0
    darts = k * (np.log(k) + 3)
    while todo.any():
        reach = np.where(todo, darts / np.maximum(totals, 1), 0.0)
        chosen = todo[owners]
        found, ranks = _throw(owners[chosen], hashes[chosen], weights[chosen], reach, n, k)
        full = todo & (ranks < np.inf).all(axis=1)
        signature[full] = found[full]
        todo &= ~full
        darts *= 2
    return signature


def _throw(owners, hashes, weights, reach, n, k) -> tuple[np.ndarray, np.ndarray]:
    """The darts up to each set's reach, and the earliest of each coordinate."""
    best = np.full(n * k, np.inf)
    name = np.zeros(n * k, np.uint64)
    # Strips of weight [0, 1), [1, 2), [2, 4), ...: the same for every set.
    strip = 0
    while len(owners):
        low = 0 if strip == 0 else 1 << (strip - 1)
        inside = weights > low
        owners, hashes, weights = owners[inside], hashes[inside], weights[inside]
        width = 1 if strip == 0 else low
        own, h, w = owners, mixed(hashes + np.uint64(strip * int(STEP) & (1 << 64) - 1)), weights
        rank = np.zeros(len(own))
        while len(own):
            h = mixed(h + STEP)
            rank = rank - np.log((h >> np.uint64(11)).astype(np.float64) * 2.0**-53 + 2.0**-54) / width
            near = rank <= reach[own]
            own, h, w, rank = own[near], h[near], w[near], rank[near]
            dart = mixed(h ^ STEP)
            coordinate = (dart >> np.uint64(32)) * np.uint64(k) >> np.uint64(32)
            at = own * k + coordinate.astype(np.int64)
            if strip:
                hit = low + (mixed(dart) >> np.uint64(11)).astype(np.float64) * 2.0**-53 * width < w
                at, dart, ranks = at[hit], dart[hit], rank[hit]
            else:
                ranks = rank
            np.minimum.at(best, at, ranks)
            first = ranks == best[at]
            name[at[first]] = dart[first]
        strip += 1
    return name.reshape(n, k), best.reshape(n, k)


def signatures(blocks: DataFrame, k: int = SHINGLE, bands: int = BANDS, rows: int = BAND_ROWS) -> DataFrame:
    """Band keys and sequence hashes of every document with a word; no keys for the others."""
    arrow = to_arrow_schema(StructType.fromDDL(SIGNATURES))

    def signed(row_ids: np.ndarray, block: Block, vocabulary: np.ndarray) -> pa.RecordBatch:
        shingles = Shingles(block, vocabulary, k)
        n = len(block.lengths)
        found = dart_signatures(shingles.owners, shingles.hashes, shingles.weights, n, bands * rows)
        keys = np.zeros((n, bands), np.uint64)
        for row in range(rows):
            keys = mixed(keys * STEP + found[:, row::rows])
        keys = mixed(keys + np.arange(1, bands + 1, dtype=np.uint64) * STEP).view(np.int64)
        words = block.lengths > 0
        offsets = np.concatenate([[0], np.cumsum(np.where(words, bands, 0))]).astype(np.int32)
        h1, h2 = (sequence_hashes(shingles.words, block.starts, b).view(np.int64) for b in SEQUENCE_BASES)
        columns = [
            pa.array(row_ids),
            pa.array(np.full(n, block.block_id)),
            pa.array(block.doc_ids, pa.int64()),
            pa.array(np.bincount(shingles.owners, weights=shingles.weights, minlength=n).astype(np.int64)),
            pa.array(h1),
            pa.array(h2),
            pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys[words].ravel())),
        ]
        return pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow)], schema=arrow)

    def sign(batches):
        for block in read_blocks(batches):
            vocabulary = word_hashes(block.vocab, WORD_SEED)
            # Short texts come together: the shorter a text, the more often each of its shingles throws.
            for docs, part in block.parts(np.argsort(block.lengths, kind="stable"), PART_WORDS):
                out = signed(block.first_row + docs, part, vocabulary)
                for i in range(0, out.num_rows, 4096):
                    yield out.slice(i, 4096)
            del block, vocabulary, docs, part, out

    return blocks.mapInArrow(sign, SIGNATURES)


def shingle_sets(blocks: DataFrame, wanted: DataFrame, k: int = SHINGLE) -> DataFrame:
    """``row_id, items`` of the wanted documents: sorted 48-bit hashes of (shingle, occurrence)."""
    arrow = to_arrow_schema(StructType.fromDDL("row_id long, items binary"))

    def take(batches):
        def each():
            for batch in batches:
                for i in range(batch.num_rows):
                    row = batch.slice(i, 1).to_pylist()[0]
                    block = Block(row)
                    vocabulary = word_hashes(block.vocab, WORD_SEED)
                    wanted_docs = np.array(sorted(row["rows"])) - block.first_row
                    for docs, part in block.parts(wanted_docs, PART_WORDS):
                        shingles = Shingles(part, vocabulary, k)
                        edges = np.searchsorted(shingles.owners, np.arange(len(docs) + 1))
                        for doc, a, b in zip(docs, edges[:-1], edges[1:]):
                            weights = shingles.weights[a:b]
                            nth = np.arange(int(weights.sum())) - np.repeat(np.cumsum(weights) - weights, weights)
                            items = mixed(np.repeat(shingles.hashes[a:b], weights) + nth.astype(np.uint64) * STEP)
                            yield {"row_id": int(block.first_row + doc), "items": pack48(np.sort(items >> np.uint64(16)))}
                    del row, block, vocabulary, docs, part, shingles
                    release_memory()

        return small_batches(each(), arrow, 512)

    by_block = wanted.groupBy("block_id").agg(F.collect_set("row_id").alias("rows"))
    return blocks.join(by_block, "block_id").mapInArrow(take, "row_id long, items binary")


def pack48(values: np.ndarray) -> bytes:
    return (values & np.uint64(0xFFFFFFFF)).astype("<u4").tobytes() + (values >> np.uint64(32)).astype("<u2").tobytes()


def unpack48(data: bytes) -> np.ndarray:
    n = len(data) // 6
    low = np.frombuffer(data, "<u4", n).astype(np.uint64)
    return low | (np.frombuffer(data, "<u2", n, 4 * n).astype(np.uint64) << np.uint64(32))


def similarities(pairs: DataFrame, sets: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """``a, b, near`` of the pairs: whether their similarity is at least ``least``."""
    schema = "a long, b long, near boolean"
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def compare(batches):
        for batch in batches:
            name, items = None, None
            found = []
            a_ids, b_ids = batch.column("a").to_pylist(), batch.column("b").to_pylist()
            for i, (a, b) in enumerate(zip(a_ids, b_ids)):
                if a != name:
                    name, items = a, unpack48(batch.column("a_items")[i].as_py())
                other = unpack48(batch.column("b_items")[i].as_py())
                both = np.sort(np.concatenate([items, other]))
                shared = int(np.count_nonzero(both[1:] == both[:-1]))
                joint = len(both) - shared
                found.append({"a": a, "b": b, "near": shared >= least * joint})
            yield pa.RecordBatch.from_pylist(found, schema=arrow)

    with_b = pairs.join(sets.select(F.col("row_id").alias("b"), F.col("items").alias("b_items")), "b")
    with_a = with_b.join(sets.select(F.col("row_id").alias("a"), F.col("items").alias("a_items")), "a")
    return with_a.select("a", "b", "a_items", "b_items").mapInArrow(compare, schema)


def cut_buckets(members: DataFrame) -> DataFrame:
    """Buckets anew, each of the members of two neighbouring steps of an old bucket.

    Steps without a neighbour are a bucket of their own. A bucket has some forty steps.
    """
    steps = members.groupBy("key").agg(F.collect_set("step").alias("steps"))
    below = F.array_contains("steps", F.col("step") - 1)
    above = F.array_contains("steps", F.col("step") + 1)
    step = F.col("step")
    into = F.when(below & above, F.array(step, step + 1)).when(above, F.array(step + 1)).otherwise(F.array(step))
    cut = members.join(steps, "key").withColumn("part", F.explode(into))
    return cut.withColumn("key", F.xxhash64("key", "part")).drop("steps", "step", "part")


def bucket_members(firsts: DataFrame, least: float) -> DataFrame:
    """``key, band, row_id, block_id`` of the buckets with more than one member.

    Similar documents are of similar size, so a bucket is cut by size: each member enters
    its own step of a scale and the next one, the steps so wide that a pair alike enough is
    together in at least one.
    """
    entries = firsts.select("row_id", "block_id", "size", F.posexplode("keys").alias("band", "key"))
    shared = entries.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
    step = F.floor(F.log(F.col("size").cast("double")) / F.log(F.lit(1.0001 / least)))
    cut = cut_buckets(entries.join(shared, "key", "left_semi").withColumn("step", step)).drop("size")
    shared = cut.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
    return cut.join(shared, "key", "left_semi")


def _unsettled(members: DataFrame) -> DataFrame:
    """The members of the buckets that hold more than one class."""
    classes = members.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y"))
    return members.join(classes.where("x <> y").select("key"), "key", "left_semi")


def _hubs(members: DataFrame) -> DataFrame:
    """``key, top, p`` of the buckets with more than one class: the largest class, and its hub there.

    The hub is the member with the most links, as a rule the text that the others are copies of;
    of equals the least. Classes are summed up before the shuffle, so a large group is one row a task
    and bucket.
    """
    hub = F.max(F.struct("degree", (-F.col("row_id")).alias("minus")))
    classes = members.groupBy("key", "component").agg(F.count(F.lit(1)).alias("n"), hub.alias("hub"))
    largest = F.max(F.struct("n", (-F.col("component")).alias("minus"), "hub"))
    tops = classes.groupBy("key").agg(largest.alias("largest"), F.count(F.lit(1)).alias("classes")).where("classes > 1")
    return tops.select("key", (-F.col("largest.minus")).alias("top"), (-F.col("largest.hub.minus")).alias("p"))


def _degrees(links: DataFrame) -> DataFrame:
    ends = links.select(F.col("a").alias("row_id")).union(links.select(F.col("b").alias("row_id")))
    return ends.groupBy("row_id").agg(F.count(F.lit(1)).alias("degree"))


def shared_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many items each set on the left shares with each on the right."""
    n = len(left)
    sets = left + right
    items = np.concatenate(sets)
    owners = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = np.argsort(items, kind="stable")
    items, owners = items[order], owners[order]
    new = np.ones(len(items), bool)
    new[1:] = items[1:] != items[:-1]
    item = np.cumsum(new) - 1
    often = np.bincount(item) > 1
    place = np.cumsum(often) - 1
    keep = often[item]
    item, owners = place[item[keep]], owners[keep]
    counts = np.zeros((n, len(right)))
    # Items in slices, so that the table of who has what stays small.
    for first in range(0, int(often.sum()), ITEM_SLICE):
        a, b = np.searchsorted(item, [first, first + ITEM_SLICE])
        has = np.zeros((ITEM_SLICE, len(sets)), np.float32)
        has[item[a:b] - first, owners[a:b]] = 1
        counts += has[:, :n].T @ has[:, n:]
    return counts


def _packed(rows: DataFrame, group: str, sets: DataFrame, name: str) -> DataFrame:
    """``group, slot, name``: the texts of each group in rows of bounded number and size."""
    rows = rows.join(sets, "row_id")
    totals = rows.groupBy(group).agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("items")).alias("size"))
    slots = F.ceil(F.greatest(F.col("n") / ROW_TEXTS, F.col("size") / ROW_BYTES))
    dealt = rows.join(totals, group).withColumn("slot", F.pmod(F.xxhash64("row_id"), slots))
    return dealt.groupBy(group, "slot").agg(F.collect_list(F.struct("row_id", "items")).alias(name))


def _spanning(pairs: list[tuple[int, int]]) -> list[dict]:
    """As many of the pairs as connect what all of them connect."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.setdefault(x, x) != x:
            root[x] = x = root[root[x]]
        return x

    kept = []
    for a, b in pairs:
        x, y = find(a), find(b)
        if x != y:
            root[max(x, y)] = min(x, y)
            kept.append({"a": a, "b": b})
    return kept


def _block_links(both: DataFrame, least: float) -> DataFrame:
    """``a, b`` of the alike texts between the two packed columns of each row."""
    arrow = to_arrow_schema(StructType.fromDDL("a long, b long"))

    def compare(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                left, right = ([unpack48(m["items"]) for m in row[side]] for side in ("left", "right"))
                a_ids, b_ids = ([m["row_id"] for m in row[side]] for side in ("left", "right"))
                shared = shared_counts(left, right)
                joint = np.array([len(t) for t in left])[:, None] + np.array([len(t) for t in right])[None] - shared
                found = zip(*np.nonzero(shared >= least * joint))
                pairs = [(a_ids[x], b_ids[y]) for x, y in found if a_ids[x] != b_ids[y]]
                yield pa.RecordBatch.from_pylist(_spanning(pairs), schema=arrow)

    return both.select("left", "right").mapInArrow(compare, "a long, b long")


def _against_classes(members: DataFrame, large: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """Links of members with the texts of the large classes that they share a bucket with."""
    in_bucket = members.join(large, ["row_id", "component"], "left_semi").select("key", F.col("component").alias("class")).distinct()
    asked = members.join(in_bucket, "key").where(F.col("component") != F.col("class")).select("class", "row_id").distinct()
    of_class = large.withColumnRenamed("component", "class")
    texts = _packed(of_class, "class", sets, "right").withColumnRenamed("slot", "other")
    return _block_links(_packed(asked, "class", sets, "left").join(texts, "class"), least)


def _within_buckets(members: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """Links between the members of each bucket."""
    left = stored(_packed(members.select("key", "row_id"), "key", sets, "left"), "buckets")
    right = left.select("key", F.col("slot").alias("other"), F.col("left").alias("right"))
    return _block_links(left.join(right, "key").where("slot <= other"), least)


def near_links(blocks: DataFrame, firsts: DataFrame, least: float = SIMILARITY, k: int = SHINGLE) -> DataFrame:
    """``row_id, component`` of the documents linked to another, of ``row_id, block_id, size, keys``."""
    spark = blocks.sparkSession
    start = stored(bucket_members(firsts, least), "members")
    with setting(spark, BATCH_BYTES, SMALL_BATCH):
        sets = stored(shingle_sets(blocks, start.select("block_id", "row_id").distinct(), k), "shingles")
    tasks = _round_tasks(start, firsts)
    with (
        setting(spark, "spark.sql.shuffle.partitions", str(tasks)),
        setting(spark, SHUFFLES_GO, "true"),
        setting(spark, BATCH_BYTES, SMALL_BATCH),
    ):
        classes = _linked(start, sets, least)
    if classes is None:
        return firsts.select("row_id", F.col("row_id").alias("component")).limit(0)
    return classes.withColumnRenamed("node", "row_id")


def _round_tasks(members: DataFrame, firsts: DataFrame) -> int:
    """How many tasks the exchanges of the rounds have: by what they move, up to the session's number.

    There are many exchanges, so that on few members the tasks would cost more than the work.
    """
    spark = members.sparkSession
    n, size = members.count(), firsts.agg(F.avg("size")).first()[0] or 0
    wanted = max(spark.sparkContext.defaultParallelism, -(-n // TASK_MEMBERS), int(n * size * 6) // TASK_BYTES)
    return min(int(spark.conf.get("spark.sql.shuffle.partitions")), wanted)


def _linked(start: DataFrame, sets: DataFrame, least: float) -> DataFrame | None:
    """``node, component`` of the linked members; none without links."""
    links = classes = compared = None

    def named(rows: DataFrame) -> DataFrame:
        rows = rows.select("key", "row_id")
        if classes is None:
            return rows.withColumn("component", F.col("row_id"))
        rows = rows.join(classes.withColumnRenamed("node", "row_id"), "row_id", "left")
        return rows.select("key", "row_id", F.coalesce("component", "row_id").alias("component"))

    def connect(found: DataFrame) -> None:
        nonlocal links, classes
        if not found.isEmpty():
            links = found if links is None else links.union(found)
            # What earlier links connect, their classes do.
            known = found if classes is None else found.union(classes.select("component", "node"))
            classes = stored(components(known), "classes")

    def compare(pairs: DataFrame) -> None:
        """Compares rows with their pivots ``p``, unless they were compared before."""
        nonlocal compared
        pairs = pairs.select(F.least("p", "row_id").alias("a"), F.greatest("p", "row_id").alias("b")).where("a <> b").distinct()
        if compared is not None:
            pairs = pairs.join(compared, ["a", "b"], "left_anti")
        new = stored(similarities(pairs, sets, least), "compared")
        compared = new if compared is None else compared.union(new)
        connect(new.where("near").select("a", "b"))

    first = start.where(F.col("band") < FIRST_BANDS).select("key", "row_id")
    compare(first.join(first.groupBy("key").agg(F.min("row_id").alias("p")), "key"))
    for _ in range(HUB_ROUNDS if classes is not None else 0):
        linked = named(start).join(_degrees(links), "row_id", "left").withColumn("degree", F.coalesce("degree", F.lit(0)))
        hubs = stored(_hubs(linked), "hubs")
        met = linked.join(hubs, "key").where(F.col("component") != F.col("top"))
        compare(met.select("row_id", "p"))
        # A hub leaves its bucket, and so does all of a bucket that has none.
        start = stored(start.join(hubs, "key").where(F.col("row_id") != F.col("p")).select("key", "row_id"), "unsettled")
    members = start
    members = _unsettled(named(members))
    met = None
    for _ in range(CLASS_ROUNDS if classes is not None else 0):
        # What large classes have near them is found at once; then the texts that took part
        # leave the buckets. Those that joined by it stay: they have not met their buckets yet.
        members = stored(members, "unsettled")
        sizes = classes.groupBy("component").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= LARGE_CLASS)
        large = classes.join(sizes, "component").select(F.col("node").alias("row_id"), "component")
        if met is not None:
            large = large.join(met, "row_id", "left_anti")
        large = stored(large, "large-classes")
        if members.join(large, "row_id", "left_semi").isEmpty():
            break
        connect(stored(_against_classes(members, large, sets, least), "class-links"))
        rows = large.select("row_id")
        met = rows if met is None else met.union(rows)
        members = _unsettled(named(members.join(rows, "row_id", "left_anti")))
    connect(stored(_within_buckets(members, sets, least), "bucket-links"))
    return classes


def near_duplicates(docs: DataFrame, least: float = SIMILARITY, k: int = SHINGLE) -> DataFrame:
    """``row_id, doc_id, class_row, class_id, is_first`` of every document.

    ``class_row`` is the least row of the class and ``is_first`` marks that row; ``class_id``
    is the least doc_id of the class.
    """
    blocks = word_blocks(docs, name="neardup-blocks")
    return classes_of(blocks, least, k)


def classes_of(blocks: DataFrame, least: float = SIMILARITY, k: int = SHINGLE) -> DataFrame:
    with setting(blocks.sparkSession, BATCH_BYTES, SMALL_BATCH):
        rows = stored(signatures(blocks, k), "signatures")
    worded = rows.where(F.size("keys") > 0)
    copies = worded.groupBy("h1", "h2").agg(F.min("row_id").alias("first_row"))
    firsts = worded.join(copies.select(F.col("first_row").alias("row_id")), "row_id", "left_semi").select("row_id", "block_id", "size", "keys")
    classes = near_links(blocks, stored(firsts, "firsts"), least, k)
    named = copies.join(classes.withColumnRenamed("row_id", "first_row"), "first_row", "left")
    named = named.select("h1", "h2", F.coalesce("component", "first_row").alias("class_row"))
    all_rows = worded.select("row_id", "doc_id", "h1", "h2").join(named, ["h1", "h2"]).select("row_id", "doc_id", "class_row")
    all_rows = all_rows.union(rows.where(F.size("keys") == 0).select("row_id", "doc_id", F.col("row_id").alias("class_row")))
    all_rows = stored(all_rows, "class-rows")
    ids = all_rows.groupBy("class_row").agg(F.min("doc_id").alias("class_id"))
    return all_rows.join(ids, "class_row").select(
        "row_id", "doc_id", "class_row", "class_id", (F.col("row_id") == F.col("class_row")).alias("is_first")
    )
