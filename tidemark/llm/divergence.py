"""Operator 11: how far the sources of one language diverge, and by which terms.

1. **Counting.** ``bytes.translate`` lowers A-Z and blanks every other ASCII byte in one pass
   over a text, ``bytes.split`` cuts it into terms, and a ``Counter`` a document gives the
   occurrences of each. A task adds up many documents before it sends anything, so a hot
   source sends a term once a flush and not once a document.
2. **Kept terms.** A language keeps the terms that occur in at least ``MIN_DOCS`` of its
   documents. What is left is sparse: one row for a term and each source that has it.
3. **Shares.** With ``N`` occurrences of the ``V`` kept terms a group gives each of them
   ``p = 1 + floor(SCALE * (count + 1) / (N + V))``, also those it lacks.
4. **Divergence.** ``f = floor((p - q)**2 / q)``. All rows of a term go to one block, so a
   block adds up its part of every pair of sources from the rows it holds. What a pair gets
   from terms that only one of the two has, or neither, follows from the distinct shares of
   each source, so nothing is ever written out for a term that a source lacks.

All arithmetic is on whole numbers. Blocks hold some ``BLOCK_ROWS`` rows, or as many as there
are sources if that is more; a pair of sources is one row a block until blocks are added up.

Defined results: null ``text``, ``lang`` or ``source`` counts as the empty string; a text
without a term still makes its group occur; a language without kept terms has the value 0 for
every pair; repeated rows count as separate documents; equal values are ranked by the item's
bytes; other columns are ignored, whatever their names; an empty table gives an empty table.
Texts are read whole, one at a time.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.tables import chunks, column, stored

MIN_DOCS = 3
SCALE = 1_000_000_000
TOP_TERMS = 200
#: Rows of a term and a source that one block should hold, about.
BLOCK_ROWS = 1 << 16
#: Terms of documents that a task holds before it adds them up.
PENDING = 1 << 20

#: A-Z become a-z, every other ASCII byte but a-z a blank; bytes of other characters stay.
TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))

COUNTS = "lang string, source string, term string, n long, docs long"
COUNTS_ARROW = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])


class _Pending:
    """Terms of documents, not added up yet."""

    def __init__(self):
        self.groups: dict[tuple[str, str], int] = {}
        self.owners: list[int] = []
        self.sizes: list[int] = []
        self.terms: list[bytes] = []
        self.counts: list[int] = []

    def add(self, lang: str, source: str, text: bytes) -> None:
        found = Counter(text.translate(TABLE).split())
        self.owners.append(self.groups.setdefault((lang, source), len(self.groups)))
        self.sizes.append(len(found))
        self.terms.extend(found)
        self.counts.extend(found.values())

    def rows(self) -> Iterator[pa.RecordBatch]:
        """A row for each group and term, and one with a null term for each group."""
        owners = pa.array(np.repeat(np.array(self.owners, np.int32), self.sizes))
        held = pa.table({"group": owners, "term": pa.array(self.terms, pa.binary()), "n": pa.array(self.counts, pa.int64())})
        sums = held.group_by(["group", "term"]).aggregate([("n", "sum"), ("n", "count")])
        group = np.concatenate([np.arange(len(self.groups)), sums.column("group").to_numpy()]).astype(np.int32)
        none = len(self.groups)
        columns = [
            pa.array([lang for lang, _ in self.groups], pa.string()).take(pa.array(group)),
            pa.array([source for _, source in self.groups], pa.string()).take(pa.array(group)),
            pa.concat_arrays([pa.nulls(none, pa.string()), *[c.cast(pa.string()) for c in sums.column("term").chunks]]),
            pa.array(np.concatenate([np.zeros(none, np.int64), sums.column("n_sum").to_numpy()])),
            pa.array(np.concatenate([np.zeros(none, np.int64), sums.column("n_count").to_numpy()])),
        ]
        rows = pa.RecordBatch.from_arrays(columns, schema=COUNTS_ARROW)
        for start in range(0, rows.num_rows, 20_000):
            yield rows.slice(start, 20_000)


def term_counts(docs: DataFrame) -> DataFrame:
    """Occurrences ``n`` and documents of each term of each group, added up within a task.

    A group has one row with a null term and zeros for every flush in which it occurs.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending = _Pending()
        for rows in chunks(batches, "text", 8 << 20):
            texts = pc.fill_null(column(rows, "text"), "").cast(pa.binary())
            langs, sources = column(rows, "lang").to_pylist(), column(rows, "source").to_pylist()
            for lang, source, text in zip(langs, sources, texts):
                pending.add(lang, source, text.as_py())
                if len(pending.terms) >= PENDING:
                    yield from pending.rows()
                    pending = _Pending()
        if pending.owners:
            yield from pending.rows()

    rows = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"),
        F.col("text").cast("string").alias("text"),
    )
    return rows.mapInArrow(count, COUNTS)


def kept_terms(counts: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """One row for each group and kept term; a group without any has one with a null term.

    ``first`` marks one row of each kept term of a language, so that terms can be counted.
    """
    # One exchange serves the sums and the windows over them.
    summed = counts.repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    of_term = Window.partitionBy("lang", "term")
    marked = summed.select("*", F.sum("docs").over(of_term).alias("all_docs"), F.min("source").over(of_term).alias("first_source"))
    kept = marked.where(F.col("term").isNull() | (F.col("all_docs") >= min_docs))
    is_first = F.col("term").isNotNull() & (F.col("source") == F.col("first_source"))
    return kept.select("lang", "source", "term", "n", is_first.alias("first"))


def shares(counts: np.ndarray, total: np.ndarray | int) -> np.ndarray:
    """``1 + floor(SCALE * (count + 1) / total)`` by long division, three digits a step."""
    share = np.zeros(np.broadcast(counts, total).shape, np.int64)
    rest = counts + 1
    for _ in range(3):
        rest = rest * 1000
        share = share * 1000 + rest // total
        rest = rest % total
    return share + 1


def _gap(p, q):
    """``floor((p - q)**2 / q)``."""
    d = p - q
    return d * d // q


class _LangBlock:
    """The rows of one language in one block: sources by number, terms in byte order."""

    def __init__(self, sources: list[str], totals: np.ndarray, lang_total: int, source: np.ndarray, term: np.ndarray, n: np.ndarray, names: pa.Array):
        order = np.lexsort((source, term))
        self.source, self.term, n = source[order], term[order], n[order]
        self.sources, self.names = sources, names
        n_terms = int(self.term.max()) + 1 if len(order) else 0
        self.starts = np.searchsorted(self.term, np.arange(n_terms + 1))
        self.n_terms = n_terms
        self.p = shares(n, totals[self.source])
        #: What a source gives a term that it lacks.
        self.absent = shares(np.zeros(len(sources), np.int64), totals)
        per_term = np.add.reduceat(n, self.starts[:-1]) if n_terms else np.zeros(0, np.int64)
        self.q = shares(per_term, lang_total)
        by_source = np.argsort(self.source, kind="stable")
        cuts = np.searchsorted(self.source[by_source], np.arange(len(sources) + 1))
        #: The rows of each source, in the order of terms.
        self.rows = [by_source[a:b] for a, b in zip(cuts[:-1], cuts[1:])]
        self.distinct = [np.unique(self.p[r], return_counts=True) for r in self.rows]

    def pairs(self, a: int) -> np.ndarray:
        """What this block adds to the divergence of source ``a`` from each source."""
        absent, mine = self.absent, self.rows[a]
        own = absent[a]
        neither = _gap(own, absent)
        values = neither * self.n_terms
        for p, times in zip(*self.distinct[a]):
            values += times * (_gap(p, absent) - neither)
        for b, (q, times) in enumerate(self.distinct):
            values[b] += int((times * (_gap(own, q) - neither[b])).sum())
        # Terms that both have were counted as if each lacked the other's.
        first, size = self.starts[self.term[mine]], np.diff(self.starts)[self.term[mine]]
        at = np.repeat(first - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        p, q, b = np.repeat(self.p[mine], size), self.p[at], self.source[at]
        np.add.at(values, b, _gap(p, q) - _gap(p, absent[b]) - _gap(own, q) + neither[b])
        return values

    def terms(self, a: int, top: int) -> tuple[np.ndarray, np.ndarray]:
        """Terms that source ``a`` has more of than its language, at most ``top``, and their values."""
        mine = self.rows[a]
        term, p = self.term[mine], self.p[mine]
        more = p > self.q[term]
        term, p = term[more], p[more]
        values = _gap(p, self.q[term])
        best = np.argsort(-values, kind="stable")[:top]
        return term[best], values[best]


PARTS = "lang string, source string, part string, item string, value long"
PARTS_ARROW = pa.schema([("lang", pa.string()), ("source", pa.string()), ("part", pa.string()), ("item", pa.string()), ("value", pa.int64())])


def _block_parts(batches: Iterator[pa.RecordBatch], top: int) -> Iterator[pa.RecordBatch]:
    rows = pa.Table.from_batches(batches).combine_chunks()
    langs = column(rows, "lang").dictionary_encode()
    lang_of = langs.indices.to_numpy(zero_copy_only=False)
    for number, lang in enumerate(langs.dictionary.to_pylist()):
        of_lang = rows.filter(pa.array(lang_of == number))
        is_group = column(of_lang, "term").is_null()
        groups, held = of_lang.filter(is_group), of_lang.filter(pc.invert(is_group))
        names = column(groups, "source")
        sources = names.to_pylist()
        source = pc.index_in(column(held, "source"), names).to_numpy(zero_copy_only=False).astype(np.int64)
        coded = column(held, "term").dictionary_encode()
        in_order = pc.sort_indices(coded.dictionary)
        place = np.empty(len(in_order), np.int64)
        place[in_order.to_numpy(zero_copy_only=False)] = np.arange(len(in_order))
        block = _LangBlock(
            sources,
            column(groups, "total").to_numpy(zero_copy_only=False),
            int(column(groups, "lang_total")[0].as_py()),
            source,
            place[coded.indices.to_numpy(zero_copy_only=False)],
            column(held, "n").to_numpy(zero_copy_only=False),
            coded.dictionary.take(in_order),
        )
        for a, source_name in enumerate(sources):
            others = np.flatnonzero(np.arange(len(sources)) != a)
            term, value = block.terms(a, top)
            items = pa.concat_arrays([names.take(pa.array(others)), block.names.take(pa.array(term)).cast(pa.string())])
            parts = pa.array(np.repeat(["pair", "term"], [len(others), len(term)]), pa.string())
            values = np.concatenate([block.pairs(a)[others], value])
            fixed = [pa.array([x] * len(items), pa.string()) for x in (lang, source_name)]
            yield pa.RecordBatch.from_arrays([*fixed, parts, items, pa.array(values)], schema=PARTS_ARROW)


def divergence(docs: DataFrame, min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS) -> DataFrame:
    """``lang, source, part, item, value, rank``: parts ``pair`` (all) and ``term`` (the first)."""
    kept = stored(kept_terms(term_counts(docs), min_docs), "kept-terms")
    groups = kept.groupBy("lang", "source").agg(
        F.sum("n").alias("n"), F.sum(F.col("first").cast("long")).alias("v"), F.count("term").alias("rows")
    )
    of_lang = Window.partitionBy("lang")
    # One row a source; a language without kept terms divides by one instead of zero.
    v = F.sum("v").over(of_lang)
    groups = stored(
        groups.select(
            "lang",
            "source",
            F.greatest(F.col("n") + v, F.lit(1)).alias("total"),
            F.greatest(F.sum("n").over(of_lang) + v, F.lit(1)).alias("lang_total"),
            "rows",
        ),
        "term-groups",
    )
    n_rows, n_groups = groups.agg(F.coalesce(F.sum("rows"), F.lit(0)), F.count(F.lit(1))).first()
    blocks = -(-n_rows // max(BLOCK_ROWS, n_groups)) or 1
    no = F.lit(None).cast("long")
    held = kept.where("term is not null").select(
        F.pmod(F.xxhash64("term"), F.lit(blocks)).alias("block"), "lang", "source", "term", "n", no.alias("total"), no.alias("lang_total")
    )
    everywhere = groups.select(
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"),
        "lang",
        "source",
        F.lit(None).cast("string").alias("term"),
        no.alias("n"),
        "total",
        "lang_total",
    )

    def parts_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _block_parts(batches, top_terms)

    parts = stored(held.unionByName(everywhere).groupBy("block").applyInArrow(parts_of, PARTS), "divergence-parts")
    pairs = parts.where("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    ranked = Window.partitionBy("lang", "source", "part").orderBy(F.col("value").desc(), "item")

    def rank(rows: DataFrame) -> DataFrame:
        return rows.select("lang", "source", "part", "item", "value", F.row_number().over(ranked).alias("rank"))

    return rank(pairs).unionByName(rank(parts.where("part = 'term'")).where(F.col("rank") <= top_terms))
