"""Row-level changes: updates, deletes, merges, upserts, restores."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.acceptance.layouts import PLAIN_SQL, plain_orders
from tidemark.acceptance.registry import query
from tidemark.acceptance.scans import BY_MONTH
from tidemark.acceptance.views import (
    INVENTORY_TIES,
    RUN_AT,
    RUN_AT_SQL,
    VERSION_1_AT,
    hours,
    v_inventory,
    v_orders,
    version_1,
    version_2,
    with_sql,
)
from tidemark.functions import adjusted_stock, ntz, stock_status
from tidemark.operators import (
    delete,
    delete_matching,
    insert,
    insert_if_absent as add_absent,
    latest_per_key,
    merge_into,
    update,
    update_where as set_where,
    upsert,
)
from tidemark.operators.layout import add_columns
from tidemark.plans.table import VersionedTable
from tidemark.session import work_folder

STOCK_COLUMNS = [
    "inventory_id",
    "product_id",
    "warehouse_id",
    "city",
    "movement_date",
    "movement_type",
    "quantity",
    "available_quantity",
    "damaged_quantity",
    "inventory_status",
    "updated_at",
    "source_system",
    "sync_version",
]


def money_as_double(df):
    return df.withColumn("order_amount", F.col("order_amount").cast("double"))


def stock(spark, sf_dir):
    """One row per inventory id, with its status."""
    latest = latest_per_key(v_inventory(spark, sf_dir), ["inventory_id"], tie_break=INVENTORY_TIES)
    return latest.withColumn("inventory_status", stock_status(F.col("available_quantity"))).select(
        *STOCK_COLUMNS
    )


STATUS_SQL = """case when {0} <= 0 then 'OUT_OF_STOCK' when {0} < 20 then 'LOW_STOCK' else 'IN_STOCK' end"""
STOCK_SQL = (
    with_sql("v_inventory", "latest_inventory")
    + f""", stock as (
        select inventory_id, product_id, warehouse_id, city, movement_date, movement_type, quantity,
               available_quantity, damaged_quantity, {STATUS_SQL.format("available_quantity")} as inventory_status,
               updated_at, source_system, sync_version
        from latest_inventory) """
)
# The adjusted columns of rows of ``stock``.
ADJUSTED_SQL = f"""
    inventory_id, product_id, warehouse_id, city, movement_date, 'STOCK_ADJUSTED' as movement_type,
    quantity, greatest(available_quantity - 20, 0) as available_quantity,
    damaged_quantity + 20 as damaged_quantity,
    {STATUS_SQL.format("greatest(available_quantity - 20, 0)")} as inventory_status,
    {RUN_AT_SQL} as updated_at, 'WAREHOUSE_APP' as source_system, sync_version + 1 as sync_version"""


@query(
    with_sql("v_orders")
    + f"""
    select order_id, customer_id, city, order_amount::double as order_amount,
           case when city = 'NATION_3' then 'CANCELLED' else order_status end as order_status,
           case when city = 'NATION_3' then {RUN_AT_SQL} else updated_at end as updated_at
    from v_orders"""
)
def update_where(spark, sf_dir):
    orders = v_orders(spark, sf_dir).select(
        "order_id", "customer_id", "city", "order_amount", "order_status", "updated_at"
    )
    values = {"order_status": "CANCELLED", "updated_at": ntz(RUN_AT)}
    return money_as_double(set_where(orders, F.col("city") == "NATION_3", values))


@query(
    STOCK_SQL
    + f""", top as (select inventory_id from stock order by updated_at desc, inventory_id limit 5)
    select {ADJUSTED_SQL} from stock where inventory_id in (select inventory_id from top)
    union all
    select * from stock where inventory_id not in (select inventory_id from top)"""
)
def update_topk(spark, sf_dir):
    """The five rows changed last move 20 items to damaged stock."""
    rows = stock(spark, sf_dir)
    newest = rows.orderBy(F.col("updated_at").desc(), "inventory_id").limit(5)
    # Five rows, so the broadcast is bounded.
    marks = F.broadcast(newest.select("inventory_id", F.lit(True).alias("__top")))
    marked = rows.join(marks, "inventory_id", "left")
    top = F.coalesce(F.col("__top"), F.lit(False))
    return set_where(marked, top, adjusted_stock(ntz(RUN_AT))).select(*STOCK_COLUMNS)


@query(
    with_sql("v_orders")
    + """, fraud as (select order_id from v_orders where order_amount > 450000 and payment_status = 'PENDING')
    select order_id, city, order_amount::double as order_amount
    from v_orders where order_id not in (select order_id from fraud)"""
)
def delete_fraud(spark, sf_dir):
    """Orders on a list are deleted."""
    orders = v_orders(spark, sf_dir)
    suspicious = (F.col("order_amount") > 450000) & (F.col("payment_status") == "PENDING")
    listed = orders.where(suspicious).select("order_id", F.lit("fraud_order").alias("delete_reason"))
    kept = delete_matching(orders, listed, ["order_id"])
    return money_as_double(kept.select("order_id", "city", "order_amount"))


@query(with_sql("s1", "s2") + "select * from s2 union all select * from s1 where o_orderkey % 11 = 0")
def merge_upsert(spark, sf_dir):
    return merge_into(
        version_1(spark, sf_dir), version_2(spark, sf_dir), ["o_orderkey"], [update()], [insert()]
    )


def _moved_orders(spark, sf_dir):
    """Orders as the other side has them: some newer, some older, some unknown, some of equal age."""
    key = F.col("order_id")
    shift = F.when(key % 4 == 0, 2).when(key % 4 == 1, -2).otherwise(0)
    return (
        v_orders(spark, sf_dir)
        .where(key % 5 != 0)
        .withColumn("order_status", F.lit("SYNCED"))
        .withColumn("sync_version", F.col("sync_version") + (key % 3 - 1).cast("int"))
        .withColumn("updated_at", F.col("updated_at") + hours(shift))
    )


SYNC_COLUMNS = ["order_id", "city", "order_amount", "order_status", "updated_at", "sync_version"]
MOVED_SQL = (
    with_sql("v_orders")
    + """, moved as (
        select * replace (
            'SYNCED' as order_status,
            (sync_version + (order_id % 3 - 1))::int as sync_version,
            updated_at + to_hours(case order_id % 4 when 0 then 2 when 1 then -2 else 0 end) as updated_at)
        from v_orders where order_id % 5 <> 0),
    held as (select * from v_orders where order_id % 7 <> 0) """
)


@query(
    MOVED_SQL
    + """
    select order_id, city, order_amount::double as order_amount, order_status, updated_at, sync_version
    from (
        select m.* from moved m left join held h using (order_id)
        where h.order_id is null or m.updated_at > h.updated_at
        union all
        select h.* from held h left join moved m using (order_id)
        where m.order_id is null or not (m.updated_at > h.updated_at))"""
)
def merge_if_newer(spark, sf_dir):
    """Later rows overwrite, unknown rows are added."""
    held = v_orders(spark, sf_dir).where(F.col("order_id") % 7 != 0)
    merged = upsert(held, _moved_orders(spark, sf_dir), ["order_id"], newer_than="updated_at")
    return money_as_double(merged.select(*SYNC_COLUMNS))


@query(
    MOVED_SQL
    + """, wins as (
        select m.* from moved m join held h using (order_id)
        where m.updated_at > h.updated_at
           or (m.updated_at = h.updated_at and m.sync_version > h.sync_version))
    select order_id, city, order_amount::double as order_amount, order_status, updated_at, sync_version
    from (select * from wins union all
          select * from held where order_id not in (select order_id from wins))"""
)
def merge_tiebreak(spark, sf_dir):
    """Later rows overwrite, and of equal times the higher version; nothing is added."""
    held = v_orders(spark, sf_dir).where(F.col("order_id") % 7 != 0)
    newer = F.col("s.updated_at") > F.col("t.updated_at")
    same_but_higher = (F.col("s.updated_at") == F.col("t.updated_at")) & (
        F.col("s.sync_version") > F.col("t.sync_version")
    )
    merged = merge_into(
        held, _moved_orders(spark, sf_dir), ["order_id"], [update(when=newer | same_but_higher)]
    )
    return money_as_double(merged.select(*SYNC_COLUMNS))


@query(
    with_sql("s1", "s2")
    + """, src as (
        select *, case when o_orderkey % 6 = 0 then 'DELETE' when o_orderkey % 6 = 1 then 'KEEP'
                       else 'UPDATE' end as kind
        from s2)
    select s.o_orderkey, s.o_custkey, s.order_date, s.o_orderstatus, s.o_totalprice, s.p
    from src s left join s1 t using (o_orderkey)
    where kind = 'UPDATE'
    union all
    select t.* from s1 t left join src s using (o_orderkey)
    where s.o_orderkey is null or kind = 'KEEP'"""
)
def merge_delete_arm(spark, sf_dir):
    """Delete, conditional update and conditional insert in one merge."""
    key = F.col("o_orderkey")
    kind = F.when(key % 6 == 0, "DELETE").when(key % 6 == 1, "KEEP").otherwise("UPDATE")
    return merge_into(
        version_1(spark, sf_dir),
        version_2(spark, sf_dir).withColumn("kind", kind),
        ["o_orderkey"],
        matched=[delete(F.col("s.kind") == "DELETE"), update(when=F.col("s.kind") == "UPDATE")],
        not_matched=[insert(when=F.col("s.kind") == "UPDATE")],
    )


@query(
    with_sql("s1", "s2")
    + """
    select t.o_orderkey, t.o_custkey, t.order_date, coalesce(s.o_orderstatus, t.o_orderstatus) as o_orderstatus,
           case when s.o_orderkey is null then t.o_totalprice else s.o_totalprice end as o_totalprice, t.p
    from s1 t left join s2 s using (o_orderkey)"""
)
def merge_matched_only(spark, sf_dir):
    """Two columns copied onto rows that exist; nothing is added."""
    return merge_into(
        version_1(spark, sf_dir),
        version_2(spark, sf_dir),
        ["o_orderkey"],
        [update(["o_orderstatus", "o_totalprice"])],
    )


@query(
    STOCK_SQL
    + f""", top as (select inventory_id from stock order by inventory_id limit 10)
    select {ADJUSTED_SQL} from stock where inventory_id in (select inventory_id from top)
    union all
    select * from stock where inventory_id not in (select inventory_id from top)"""
)
def merge_self_topk(spark, sf_dir):
    """The first ten rows, recomputed, are merged back into their own table."""
    rows = stock(spark, sf_dir)
    source = rows.orderBy("inventory_id").limit(10)
    source = source.withColumns(adjusted_stock(ntz(RUN_AT), first_version=None))
    newer = F.col("s.updated_at") > F.col("t.updated_at")
    same_but_higher = (F.col("s.updated_at") == F.col("t.updated_at")) & (
        F.col("s.sync_version") > F.col("t.sync_version")
    )
    return merge_into(rows, source, ["inventory_id"], [update(when=newer | same_but_higher)])


@query(with_sql("s1", "s2") + "select * from s1 union all select * from s2 where o_orderkey % 10 = 9")
def insert_if_absent(spark, sf_dir):
    return add_absent(version_1(spark, sf_dir), version_2(spark, sf_dir), ["o_orderkey"])


@query(
    with_sql("v_orders")
    + f""", app as (select city, max(updated_at) as wm from v_orders where source_system = 'APP' group by city),
    lake as (select product_category as city, max(updated_at) as wm from v_orders group by product_category
             union all
             select city, max(updated_at) from v_orders where source_system = 'LAKE' and order_id % 4 = 0
             group by city having count(*) % 2 = 0)
    select 'sync_' || coalesce(l.city, a.city) as pipeline_name,
           case when l.city is null then a.wm else l.wm end as last_watermark,
           case when l.city is null then 'initial' else 'run_2' end as last_run_id,
           case when l.city is null then 'INITIALIZED' else 'SUCCESS' end as last_status,
           {RUN_AT_SQL} as updated_at
    from app a full join lake l on a.city = l.city"""
)
def upsert_state(spark, sf_dir):
    """Pipeline state rows overwritten by key, whatever their age, or added."""
    orders = v_orders(spark, sf_dir)

    def state(rows, pipeline, run_id, status):
        return rows.groupBy(F.concat(F.lit("sync_"), F.col(pipeline)).alias("pipeline_name")).agg(
            F.max("updated_at").alias("last_watermark"),
            F.first(F.lit(run_id)).alias("last_run_id"),
            F.first(F.lit(status)).alias("last_status"),
            F.first(ntz(RUN_AT)).alias("updated_at"),
            F.count(F.lit(1)).alias("n"),
        )

    held = state(orders.where(F.col("source_system") == "APP"), "city", "initial", "INITIALIZED").drop("n")
    lake = orders.where((F.col("source_system") == "LAKE") & (F.col("order_id") % 4 == 0))
    fresh = state(lake, "city", "run_2", "SUCCESS").where(F.col("n") % 2 == 0)
    fresh = fresh.union(state(orders, "product_category", "run_2", "SUCCESS")).drop("n")
    return upsert(held, fresh, ["pipeline_name"])


@query(
    with_sql("v_orders")
    + """
    select order_id, order_status, order_amount::double as order_amount,
           case when order_id % 5 = 0 then 'COURIER_' || (order_id % 3)::varchar end as delivery_partner,
           case when order_id % 5 = 0 then (order_id % 90)::int end as estimated_delivery_minutes
    from v_orders"""
)
def add_columns_merge(spark, sf_dir):
    """Two new columns, empty until a merge fills them for some rows and adds others."""
    orders = v_orders(spark, sf_dir)
    key = F.col("order_id")
    partner = F.concat(F.lit("COURIER_"), (key % 3).cast("string"))
    minutes = (key % 90).cast("int")
    staged = orders.where(key % 5 == 0).withColumns(
        {"delivery_partner": partner, "estimated_delivery_minutes": minutes}
    )
    new = {"delivery_partner": "string", "estimated_delivery_minutes": "int"}
    target = add_columns(orders.where(key % 10 != 0), new)
    merged = merge_into(target, staged, ["order_id"], [update()], [insert()])
    return money_as_double(merged).select(
        "order_id", "order_status", "order_amount", "delivery_partner", "estimated_delivery_minutes"
    )


def _orders_after_delete(spark, sf_dir):
    orders = plain_orders(spark, sf_dir)
    held = VersionedTable.create(orders, work_folder(spark, "restore"), BY_MONTH, VERSION_1_AT)
    lost = orders.where((F.col("order_status") == "F") & (F.col("order_id") % 50 == 0))
    held.delete_matching(lost, ["order_id"])
    return held


WANTED_SQL = "order_status = 'F' and order_id % 25 = 0"


@query(
    PLAIN_SQL
    + f"""
    select order_id, customer_id, order_date, order_status, order_amount::double as order_amount from (
        select * from plain where not (order_status = 'F' and order_id % 50 = 0)
        union all select * from plain where {WANTED_SQL})"""
)
def restore_rows(spark, sf_dir):
    """Old rows appended again: those still present are now held twice."""
    held = _orders_after_delete(spark, sf_dir)
    held.restore_rows(1, F.expr(WANTED_SQL))
    return money_as_double(held.as_of())


@query(
    PLAIN_SQL
    + """
    select order_id, customer_id, order_date, order_status, order_amount::double as order_amount from plain"""
)
def restore_rows_only_missing(spark, sf_dir):
    held = _orders_after_delete(spark, sf_dir)
    held.restore_rows(1, F.expr(WANTED_SQL), only_missing=["order_id"])
    return money_as_double(held.as_of())
