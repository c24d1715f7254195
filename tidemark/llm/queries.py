"""One query for each operator, over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.contamination import contaminated
from tidemark.llm.divergence import divergence
from tidemark.llm.language import identify
from tidemark.llm.maxent import score_corpus
from tidemark.llm.neardup import near_duplicates
from tidemark.llm.packing import pack
from tidemark.llm.quality import judge
from tidemark.llm.registry import LLM_ORACLES, LLM_QUERIES, llm_query
from tidemark.llm.runs import best_run, periodic_runs
from tidemark.llm.simhash import simhash_components
from tidemark.llm.substrings import dedup_substrings
from tidemark.llm.tables import table
from tidemark.llm.tokenfiles import ids_round_trip
from tidemark.llm.toxicity import score_documents
from tidemark.llm.warc import archive_pages

SUBSTRINGS_SQL = r"""
with d as (
    select row_number() over (order by doc_id) as r, doc_id,
           list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w
    from documents
), win as (
    select r, unnest(range(1, len(w) - 33)) as i, w from d where len(w) >= 35
), h as (
    select r, i, md5(array_to_string(w[i:i + 34], ' ')) as h from win
), rep as (
    select r, i from h where h in (select h from h group by h having count(*) > 1)
), cov as (
    select distinct r, i + unnest(range(0, 35)) as p from rep
), gone as (
    select r, list(p) as gone, count(*) as n from cov group by r
)
select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n, 0) as bigint) as n_removed,
       sha256(array_to_string(
           case when n is null then w
                else list_filter(w, lambda x, j: not list_contains(gone, j))
           end, ' ')) as kept_sha256
from d left join gone using (r)
"""


@llm_query("op7_substring_dedup", SUBSTRINGS_SQL)
def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dedup_substrings(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


WARC_SQL = """
with p as (
    select page_id, coalesce(html, '') as html, sha1(coalesce(html, '')) as payload_digest,
           cast(strlen(coalesce(html, '')) as bigint) as payload_bytes
    from pages
), q as (
    select *, case when payload_bytes >= 1000 then max(page_id) over (partition by payload_digest) end as first_id from p
)
select page_id, payload_bytes, payload_digest,
       case when first_id is not null and page_id is distinct from first_id then 'revisit' else 'response' end as record_type,
       case when first_id is not null and page_id is distinct from first_id then first_id end as refers_to
from q
"""


@llm_query("op6_warc", WARC_SQL)
def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = archive_pages(table(spark, sf_dir, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@llm_query("op8_best_fit_packing")
def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


@llm_query("op3_token_files")
def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ids_round_trip(table(spark, sf_dir, "documents"))


@llm_query("op5_minhash_neardup")
def op5_minhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "class_id")


@llm_query("op2_quality_rules")
def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("mean_ratio")


@llm_query("op4_toxicity")
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@llm_query("op9_language_id")
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))


@llm_query("op1_decontamination")
def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("row_id")


@llm_query("op10_lm_scoring")
def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_corpus(table(spark, sf_dir, "documents"))


DIVERGENCE_SQL = r"""
with d as (
    select row_number() over () as r, coalesce(lang, '') as lang, coalesce(source, '') as source, coalesce(text, '') as text
    from documents
), t as (
    select r, lang, source, unnest(regexp_split_to_array(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x40\x5B-\x60\x7B-\x7F]+')) as term
    from d
), g as (
    select distinct lang, source from d
), k as (
    select lang, term from t where term <> '' group by lang, term having count(distinct r) >= 3
), v as (
    select lang, count(term) as v from (select distinct lang from d) left join k using (lang) group by lang
), c as (
    select lang, source, term, count(*) as n from t join k using (lang, term) group by lang, source, term
), full_c as (
    select g.lang, g.source, k.term, coalesce(c.n, 0) as n from g join k using (lang) left join c using (lang, source, term)
), p as (
    select lang, source, term, n,
           1 + (1000000000 * (cast(n as hugeint) + 1)) // (sum(n) over (partition by lang, source) + v.v) as p
    from full_c join v using (lang)
), q as (
    select lang, term, 1 + (1000000000 * (n + 1)) // (sum(n) over (partition by lang) + v.v) as q
    from (select lang, term, cast(sum(n) as hugeint) as n from full_c group by lang, term) join v using (lang)
), sums as (
    select a.lang, a.source, b.source as item, sum((a.p - b.p) * (a.p - b.p) // b.p) as value
    from p a join p b on a.lang = b.lang and a.term = b.term and a.source <> b.source
    group by a.lang, a.source, b.source
), f as (
    select a.lang, a.source, 'pair' as part, b.source as item, coalesce(value, 0) as value
    from g a join g b on a.lang = b.lang and a.source <> b.source
         left join sums on sums.lang = a.lang and sums.source = a.source and sums.item = b.source
    union all
    select lang, source, 'term', term, (p - q) * (p - q) // q from p join q using (lang, term) where n > 0 and p > q
), ranked as (
    select *, row_number() over (partition by lang, source, part order by value desc, item) as rank from f
)
select lang, source, part, item, cast(value as bigint) as value, cast(rank as integer) as rank
from ranked where part = 'pair' or rank <= 200
"""


@llm_query("op11_source_divergence", DIVERGENCE_SQL)
def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence(table(spark, sf_dir, "documents"))


RUNS_SQL = r"""
with d as (
    select row_number() over () as r, doc_id,
           list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w,
           -- crc32 of the decimal id, bit by bit
           xor(4294967295, list_reduce(
               list_prepend(cast(4294967295 as bigint), list_transform(regexp_extract_all(cast(doc_id as varchar), '.'), lambda x: cast(ascii(x) as bigint))),
               lambda crc, byte: list_reduce(
                   list_prepend(xor(crc, byte), range(8)),
                   lambda x, bit: xor(x >> 1, 3988292384 * (x & 1))))) as h
    from documents
), s as (
    select *, len(w) as n, h // 10 as g, (h // 10) % greatest(len(w), 1) as a from d
), planted as (
    select *, 1 + (n - a) // (3 + g % 8) as p from s
), x as (
    select r, doc_id, n,
           case when h % 10 = 0 and n > 0
                then list_transform(range(n), lambda i: w[1 + case when i < a then i else a + (i - a) % p end])
                else w end as w
    from planted
), gram as (
    select r, i, md5(array_to_string(w[i + 1:i + 5], ' ')) as gram from (select r, w, unnest(range(n - 4)) as i from x where n >= 5)
), pairs as (
    select b.r, b.i, b.i - a.i as lag from gram a join gram b on a.r = b.r and a.gram = b.gram and a.i < b.i
), islands as (
    select r, lag, i, i - row_number() over (partition by r, lag order by i) as island from pairs
), stretches as (
    -- five words match from each place of an island on
    select r, min(i) - lag as start, count(*) + 4 + lag as length, lag as period from islands group by r, lag, island
), long_enough as (
    select * from stretches where length >= greatest(6, 4 * period)
), runs as (
    select * from long_enough a where not exists (
        select 1 from long_enough b
        where b.r = a.r and b.period < a.period and b.start <= a.start and b.start + b.length >= a.start + a.length)
), listed as (
    select r, count(*) as n_runs,
           string_agg(start || ',' || length || ',' || period || chr(10), '' order by start, period) as lines,
           first({'start': start, 'length': length, 'period': period} order by cast(length as double) / period desc, start, period) as best
    from runs group by r
), gone as (
    select r, list_distinct(flatten(list(range(start + period, start + length)))) as gone from runs group by r
), kept as (
    select x.*, case when gone is null then w
                     else (select list(y.word order by y.i) from (select unnest(w) as word, unnest(range(n)) as i) y
                           where not list_contains(gone, y.i)) end as kept
    from x left join gone using (r)
)
select doc_id, cast(coalesce(n_runs, 0) as bigint) as n_runs, cast(best.start as bigint) as start, cast(best.length as bigint) as length,
       cast(best.period as bigint) as period, cast(1000 * best.length // best.period as bigint) as exponent_milli,
       sha256(coalesce(lines, '')) as runs_sha256, sha256(array_to_string(coalesce(kept, []), ' ')) as collapsed_sha256
from kept left join listed using (r)
"""


def planted_periods(docs: DataFrame) -> DataFrame:
    """The documents, every tenth (by its id's hash) repeating a stretch of itself from some word on.

    Makes the input of the query, and nothing else.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    rows = docs.select(
        "doc_id",
        "text",
        (h % 10 == 0).alias("chosen"),
        F.expr("crc32(cast(cast(doc_id as string) as binary)) div 10").alias("g"),
        F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), "").alias("w"),
    )
    rows = rows.withColumn("n", F.size("w")).withColumn("a", F.expr("cast(g % greatest(n, 1) as int)"))
    rows = rows.withColumn("p", F.expr("cast(1 + (n - a) div (3 + g % 8) as int)"))
    repeated = F.expr("concat_ws(' ', slice(w, 1, a), transform(sequence(a, n - 1), i -> element_at(w, a + (i - a) % p + 1)))")
    return rows.select("doc_id", F.when(F.col("chosen") & (F.col("n") > 0), repeated).otherwise(F.col("text")).alias("text"))


@llm_query("op12_periodic_runs", RUNS_SQL)
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(planted_periods(table(spark, sf_dir, "documents")))
    line = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.concat(F.array_join(line, "\n"), F.when(F.size("runs") > 0, F.lit("\n")).otherwise(F.lit("")))
    rows = found.withColumn("best", best_run(F.col("runs")))
    return rows.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@llm_query("op13_simhash_neardup")
def op13_simhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_components(table(spark, sf_dir, "documents"))
    hexed = F.lower(F.lpad(F.hex("bits"), 16, "0"))
    return found.select("doc_id", hexed.alias("fingerprint"), "component_id")


__all__ = ["LLM_ORACLES", "LLM_QUERIES"]
