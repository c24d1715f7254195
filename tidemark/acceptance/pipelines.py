"""Incremental pipelines and the state they keep."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidemark.acceptance.merges import money_as_double
from tidemark.acceptance.registry import query
from tidemark.acceptance.scans import BY_MONTH
from tidemark.acceptance.views import (
    RUN_AT,
    RUN_AT_SQL,
    VERSION_1_AT,
    hours,
    table,
    v_orders,
    version_1,
    version_2,
    with_sql,
)
from tidemark.functions import ntz
from tidemark.operators import initial_replica
from tidemark.plans.pipelines import replicate as run_replication
from tidemark.plans.pipelines import sync_in as run_sync_in
from tidemark.plans.pipelines import sync_out as run_sync_out
from tidemark.plans.pipelines import two_way_sync as run_two_way
from tidemark.plans.state import (
    ControlLog,
    Watermarks,
    bootstrap_version,
    last_processed,
    newer_rows,
    watermark_of,
)
from tidemark.plans.table import VersionedTable
from tidemark.session import local_frame, work_folder
from tidemark.sources.replica import TableReplica

KEYS = ["order_id"]
SHOWN = ["order_id", "city", "order_amount", "order_status", "updated_at", "source_system", "sync_version"]
SHOWN_SQL = (
    "order_id, city, order_amount::double as order_amount, order_status, updated_at, source_system, sync_version"
)


def _state_rows(state):
    return state.rows().select("pipeline_name", "last_watermark", "last_status")


@query(
    """
    select event_type, timestamp '1900-01-01' as last_watermark, count(*)::bigint as newer
    from events group by event_type"""
)
def watermark_default(spark, sf_dir):
    """A pipeline without state starts in 1900 and finds every row newer."""
    events = table(spark, sf_dir, "events")
    state = events.select(
        F.col("event_type").alias("pipeline_name"), F.col("ts").alias("last_watermark")
    )
    watermark = watermark_of(state, "never_ran").first()["last_watermark"]
    return (
        newer_rows(events, watermark, updated_at="ts")
        .groupBy("event_type")
        .agg(F.count(F.lit(1)).alias("newer"))
        .withColumn("last_watermark", ntz(watermark))
        .select("event_type", "last_watermark", "newer")
    )


@query(
    """
    with mark as (select max(ts) as wm from events where event_type = 'click' and event_id % 2 = 0
                  and ts <= timestamp '2024-01-15')
    select user_id, count(*)::bigint as newer, max(ts) as last_seen
    from events, mark where ts > wm and event_type = 'click' group by user_id"""
)
def watermark_increment(spark, sf_dir):
    """Rows of one origin after a stored watermark, to the microsecond."""
    events = table(spark, sf_dir, "events")
    seen = (F.col("event_id") % 2 == 0) & (F.col("ts") <= ntz(dt.datetime(2024, 1, 15)))
    state = events.where(seen).select(
        F.col("event_type").alias("pipeline_name"), F.col("ts").alias("last_watermark")
    )
    watermark = watermark_of(state, "click").first()["last_watermark"]
    newer = newer_rows(events, watermark, "click", updated_at="ts", source="event_type")
    return newer.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("newer"), F.max("ts").alias("last_seen")
    )


def _lake(spark, sf_dir, rows=None):
    rows = v_orders(spark, sf_dir) if rows is None else rows
    return VersionedTable.create(rows, work_folder(spark, "lake"), BY_MONTH, VERSION_1_AT)


def _replica(spark, rows):
    copy = VersionedTable.create(rows, work_folder(spark, "replica"), BY_MONTH, VERSION_1_AT)
    return TableReplica(copy, KEYS)


def _app_side(spark, sf_dir):
    """The replica's copy: some orders changed there, earlier or later than in the lake."""
    key = F.col("order_id")
    return (
        v_orders(spark, sf_dir)
        .where(key % 7 != 0)
        .withColumn("order_status", F.when(key % 4 == 0, "APP_EDIT").otherwise(F.col("order_status")))
        .withColumn("updated_at", F.col("updated_at") + hours(F.when(key % 8 == 0, 3).otherwise(-1)))
    )


APP_SQL = """
    app as (select * replace (
                case when order_id % 4 = 0 then 'APP_EDIT' else order_status end as order_status,
                updated_at + to_hours(case when order_id % 8 = 0 then 3 else -1 end) as updated_at)
            from v_orders where order_id % 7 <> 0)"""
MARK = dt.datetime(1998, 6, 1, 5, 0, 0)
MARK_SQL = "timestamp '1998-06-01 05:00:00'"


def _merged_sql(target: str, source: str) -> str:
    """``target`` after later rows of ``source`` overwrote and unknown ones were added."""
    return f"""
        select s.* from {source} s left join {target} t using (order_id)
        where t.order_id is null or s.updated_at > t.updated_at
        union all
        select t.* from {target} t left join {source} s using (order_id)
        where s.order_id is null or not (s.updated_at > t.updated_at)"""


@query(
    with_sql("v_orders")
    + f""", {APP_SQL},
    sent as (select * from v_orders where source_system = 'LAKE' and updated_at > {MARK_SQL}),
    result as ({_merged_sql("app", "sent")})
    select {SHOWN_SQL} from result"""
)
def replica_upsert_newer(spark, sf_dir):
    """Rows of a replica after an upsert that only overwrites older ones."""
    replica = _replica(spark, _app_side(spark, sf_dir))
    replica.upsert(newer_rows(v_orders(spark, sf_dir), MARK, "LAKE"), "run_1")
    return money_as_double(replica.rows().select(*SHOWN))


@query(
    with_sql("v_orders")
    + f""", {APP_SQL} select {SHOWN_SQL} from app where source_system = 'APP' and updated_at > {MARK_SQL}"""
)
def replica_increment_read(spark, sf_dir):
    """What a replica gives past a watermark, of one origin."""
    replica = _replica(spark, _app_side(spark, sf_dir))
    return money_as_double(replica.increment(MARK, "APP").select(*SHOWN))


@query(
    with_sql("v_orders")
    + f""", {APP_SQL},
    sent as (select * from v_orders where source_system = 'LAKE' and updated_at > {MARK_SQL}),
    result as ({_merged_sql("app", "sent")})
    select {SHOWN_SQL}, (select max(updated_at) from sent) as last_watermark, 'NO_DATA' as last_status
    from result"""
)
def sync_out(spark, sf_dir):
    """Lake to replica from a stored watermark; a second run finds nothing."""
    lake = _lake(spark, sf_dir)
    replica = _replica(spark, _app_side(spark, sf_dir))
    state = Watermarks(spark, work_folder(spark, "state"))
    state.set("out", MARK, "run_0", "SUCCESS", RUN_AT)
    run_sync_out(lake, replica, state, "out", "LAKE", run_id="run_1", at=RUN_AT)
    again = run_sync_out(lake, replica, state, "out", "LAKE", run_id="run_2", at=RUN_AT)
    return money_as_double(replica.rows().select(*SHOWN)).withColumns(
        {"last_watermark": ntz(again.watermark), "last_status": F.lit(again.status)}
    )


@query(
    with_sql("v_orders")
    + f""", {APP_SQL},
    held as (select * from v_orders where order_id % 9 <> 0),
    sent as (select * from app where source_system = 'APP'),
    result as ({_merged_sql("held", "sent")})
    select {SHOWN_SQL}, (select max(updated_at) from sent) as last_watermark, 'SUCCESS' as last_status
    from result"""
)
def sync_in(spark, sf_dir):
    """Replica to lake, first run."""
    lake = _lake(spark, sf_dir, v_orders(spark, sf_dir).where(F.col("order_id") % 9 != 0))
    replica = _replica(spark, _app_side(spark, sf_dir))
    state = Watermarks(spark, work_folder(spark, "state"))
    state.seed("in", RUN_AT)
    run_sync_in(replica, lake, state, "in", "APP", run_id="run_1", at=RUN_AT)
    marks = _state_rows(state).where(F.col("pipeline_name") == "in").first()
    return money_as_double(lake.as_of().select(*SHOWN)).withColumns(
        {"last_watermark": ntz(marks["last_watermark"]), "last_status": F.lit(marks["last_status"])}
    )


@query(
    with_sql("v_orders")
    + f""", {APP_SQL},
    lake_0 as (select * from v_orders where order_id % 9 <> 0),
    sent as (select * from lake_0 where source_system = 'LAKE'),
    app_1 as ({_merged_sql("app", "sent")}),
    back as (select * from app_1 where source_system = 'APP'),
    lake_1 as ({_merged_sql("lake_0", "back")})
    select 'lake' as side, {SHOWN_SQL} from lake_1
    union all select 'replica', {SHOWN_SQL} from app_1"""
)
def two_way_sync(spark, sf_dir):
    """One round out and back; the later change of a row wins on both sides."""
    lake = _lake(spark, sf_dir, v_orders(spark, sf_dir).where(F.col("order_id") % 9 != 0))
    replica = _replica(spark, _app_side(spark, sf_dir))
    state = Watermarks(spark, work_folder(spark, "state"))
    run_two_way(lake, replica, state, ("out", "in"), ("LAKE", "APP"), at=RUN_AT)
    sides = lake.as_of().select(F.lit("lake").alias("side"), *SHOWN)
    return money_as_double(
        sides.union(replica.rows().select(F.lit("replica").alias("side"), *SHOWN))
    )


@query(
    """
    select event_type as pipeline_name, event_id::varchar as last_processed_snapshot_id, ts as last_processed_at
    from events where event_type = 'click' and value > 5 order by ts desc, event_id desc limit 1"""
)
def control_last_processed(spark, sf_dir):
    """The newest completed row of a pipeline in a log made of all events."""
    log = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("pipeline_name"),
        F.col("event_id").cast("string").alias("last_processed_snapshot_id"),
        F.col("ts").alias("last_processed_at"),
        F.when(F.col("value") > 5, "COMPLETED").otherwise("FAILED").alias("status"),
    )
    return last_processed(log, "click").drop("status")


@query(
    """
    with target as (select max(o_orderdate) as loaded from orders where o_orderkey % 3 = 0
                    and o_orderdate < timestamp '1999-01-01'),
    commits as (select o_orderkey as version, o_orderdate as committed_at from orders where o_orderkey % 2 = 0)
    select max(version)::bigint as baseline from commits, target
    where committed_at = (select max(committed_at) from commits, target where committed_at <= loaded)"""
)
def bootstrap_baseline(spark, sf_dir):
    """The version that was current when the target was last loaded."""
    orders = table(spark, sf_dir, "orders")
    loaded = (F.col("o_orderkey") % 3 == 0) & (F.col("o_orderdate") < ntz(dt.datetime(1999, 1, 1)))
    target = orders.where(loaded).select(F.col("o_orderdate").alias("updated_at"))
    commits = orders.where(F.col("o_orderkey") % 2 == 0).select(
        F.col("o_orderkey").alias("version"), F.col("o_orderdate").alias("committed_at")
    )
    baseline = bootstrap_version(commits, target)
    return local_frame(spark, [(baseline,)], "baseline bigint")


def _with_time(rows, column="updated_at"):
    return rows.withColumn(column, F.col("order_date").cast("timestamp_ntz"))


def _replication(spark, sf_dir):
    """A source with two versions, a target loaded from the first, an empty log."""
    root = work_folder(spark, "source")
    source = VersionedTable.create(_with_time(version_1(spark, sf_dir)), root, BY_MONTH, VERSION_1_AT)
    loaded_at = dt.datetime(2026, 1, 10)
    first = initial_replica(source.as_of(), "o_orderkey", loaded_at)
    target = VersionedTable.create(first, work_folder(spark, "target"), BY_MONTH, loaded_at)
    source.overwrite(_with_time(version_2(spark, sf_dir)), dt.datetime(2026, 2, 1))
    return source, target, ControlLog(spark, work_folder(spark, "control"))


@query(
    with_sql("s1", "s2")
    + f"""
    select n.*, n.order_date::timestamp as source_updated_timestamp,
           case when o.o_orderkey is null or o.o_orderstatus is distinct from n.o_orderstatus
                  or o.o_totalprice is distinct from n.o_totalprice or o.p is distinct from n.p
                then {RUN_AT_SQL} else timestamp '2026-01-10' end as updated_at
    from s2 n left join s1 o using (o_orderkey)"""
)
def replicate(spark, sf_dir):
    """Changes between two source versions carried into a target; untouched rows keep their time."""
    source, target, control = _replication(spark, sf_dir)
    run_replication(source, target, control, "orders", "o_orderkey", at=RUN_AT)
    columns = ["o_orderkey", "o_custkey", "order_date", "o_orderstatus", "o_totalprice", "p"]
    return target.as_of().select(*columns, "source_updated_timestamp", "updated_at")


@query(
    with_sql("s1", "s2")
    + """
    select * from (values (1, 'SKIPPED', 0::bigint, 1::bigint), (2, 'LOGGED', 0::bigint, 1::bigint))
        as v(run, outcome, applied, target_versions)
    cross join (select count(*)::bigint as target_rows from s2)"""
)
def replicate_noop(spark, sf_dir):
    """No new version: nothing happens. A version without row changes: only a log row."""
    root = work_folder(spark, "source")
    rows = _with_time(version_2(spark, sf_dir))
    source = VersionedTable.create(rows, root, BY_MONTH, VERSION_1_AT)
    loaded_at = dt.datetime(2026, 1, 10)
    first = initial_replica(source.as_of(), "o_orderkey", loaded_at)
    target = VersionedTable.create(first, work_folder(spark, "target"), BY_MONTH, loaded_at)
    control = ControlLog(spark, work_folder(spark, "control"))
    results = []
    for run in (1, 2):
        done = run_replication(source, target, control, "orders", "o_orderkey", at=RUN_AT)
        versions = target.commits().count()
        results.append((run, done.outcome, done.applied, versions))
        source.overwrite(rows.where("o_orderkey >= 0"), dt.datetime(2026, 2, run))
    rows_now = target.as_of().count()
    runs = [(*result, rows_now) for result in results]
    return local_frame(
        spark, runs, "run int, outcome string, applied bigint, target_versions bigint, target_rows bigint"
    )
