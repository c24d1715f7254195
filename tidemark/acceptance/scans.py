"""Sources, versions, logs and literals."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tidemark.acceptance.registry import query
from tidemark.acceptance.views import (
    VERSION_1_AT,
    VERSION_2_AT,
    table,
    v_inventory,
    version_1,
    version_2,
    with_sql,
)
from tidemark.operators.layout import Layout
from tidemark.plans.table import VersionedTable, latest_version
from tidemark.session import work_folder
from tidemark.sources import literal_rows, read_rows, sample_inventory, sample_orders, write_rows
from tidemark.sources.delimited import typed
from tidemark.sources.samples import (
    MOVEMENT_TYPES,
    ORDER_CATEGORIES,
    ORDER_CITIES,
    ORDER_STATUSES,
    PAYMENT_STATUSES,
    SOURCE_SYSTEMS,
    STOCK_CATEGORIES,
    STOCK_REGIONS,
)

BY_MONTH = Layout(month_of="order_date")


def versioned_orders(spark: SparkSession, sf_dir: str) -> VersionedTable:
    """A table whose two versions are the two states of the orders."""
    root = work_folder(spark, "orders")
    orders = VersionedTable.create(version_1(spark, sf_dir), root, BY_MONTH, VERSION_1_AT)
    orders.overwrite(version_2(spark, sf_dir), VERSION_2_AT)
    return orders


@query(
    with_sql("v_inventory")
    + """
    select inventory_id, product_id, warehouse_id, city, movement_date, movement_type,
           quantity, available_quantity, damaged_quantity, updated_at,
           source_system, sync_version, 'RAW' as loaded_from
    from v_inventory"""
)
def typed_projection(spark, sf_dir):
    """Text columns cast to their declared types, plus a constant."""
    rows = v_inventory(spark, sf_dir).drop("region")
    raw = rows.select([F.col(c).cast("string").alias(c) for c in rows.columns])
    types = {
        "inventory_id": "bigint",
        "product_id": "string",
        "warehouse_id": "string",
        "city": "string",
        "movement_date": "date",
        "movement_type": "string",
        "quantity": "int",
        "available_quantity": "int",
        "damaged_quantity": "int",
        "updated_at": "timestamp_ntz",
        "source_system": "string",
        "sync_version": "int",
    }
    return typed(raw, types).withColumn("loaded_from", F.lit("RAW"))


CSV_SQL = """
    select o_orderkey, o_custkey, o_orderstatus, o_totalprice,
           cast(o_orderdate as date) as o_orderdate, o_orderpriority,
           case o_orderkey % 6 when 0 then '  pad  ' when 1 then '' when 2 then null
                when 3 then 'say "hi"' when 4 then 'a, b' else 'plain' end as note
    from orders"""


def _orders_csv(spark: SparkSession, sf_dir: str) -> str:
    path = work_folder(spark, "orders-csv")
    orders = table(spark, sf_dir, "orders")
    note = (
        "case o_orderkey % 6 when 0 then '  pad  ' when 1 then '' when 2 then null"
        " when 3 then 'say \"hi\"' when 4 then 'a, b' else 'plain' end"
    )
    orders = orders.withColumn("o_orderdate", F.col("o_orderdate").cast("date")).withColumn("note", F.expr(note))
    write_rows(orders, path, "csv")
    return path


@query(CSV_SQL)
def csv_roundtrip(spark, sf_dir):
    schema = (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
        " o_orderdate string, o_orderpriority string, note string"
    )
    raw = read_rows(spark, _orders_csv(spark, sf_dir), schema)
    return raw.withColumn("o_orderdate", F.col("o_orderdate").cast("date"))


@query(CSV_SQL)
def csv_roundtrip_inferred(spark, sf_dir):
    raw = read_rows(spark, _orders_csv(spark, sf_dir))
    return typed(
        raw,
        {
            "o_orderkey": "bigint",
            "o_custkey": "bigint",
            "o_orderstatus": "string",
            "o_totalprice": "double",
            "o_orderdate": "date",
            "o_orderpriority": "string",
            "note": "string",
        },
    )


@query(
    """
    select level, count(*)::bigint as orders
    from orders left join (values ('1-URGENT', 'fast'), ('2-HIGH', 'fast'), ('3-MEDIUM', 'normal'),
                             ('5-LOW', 'slow')) as v(priority, level) on o_orderpriority = priority
    group by level"""
)
def literal_relation(spark, sf_dir):
    """A spelled-out dimension as a view, joined to all orders from SQL."""
    rows = [("1-URGENT", "fast"), ("2-HIGH", "fast"), ("3-MEDIUM", "normal"), ("5-LOW", "slow")]
    literal_rows(spark, rows, "priority string, level string", view="priority_levels")
    table(spark, sf_dir, "orders").createOrReplaceTempView("literal_orders")
    return spark.sql(
        """
        select level, sum(n) as orders
        from (select o_orderpriority, count(*) as n from literal_orders group by o_orderpriority)
             left join priority_levels on o_orderpriority = priority
        group by level"""
    )


@query(with_sql("s1") + "select * from s1")
def as_of_version(spark, sf_dir):
    return versioned_orders(spark, sf_dir).as_of(version=1)


@query(with_sql("s1", "s2") + "select * from s2 union all select * from s1 where false")
def as_of_timestamp(spark, sf_dir):
    return versioned_orders(spark, sf_dir).as_of(timestamp=dt.datetime(2026, 2, 15))


@query(
    with_sql("s1", "s2")
    + """
    select 1::bigint as version, timestamp '2026-01-01' as committed_at, 'create' as operation,
           (select count(*) from s1)::bigint as records, false as is_latest
    union all
    select 2::bigint, timestamp '2026-02-01', 'overwrite', (select count(*) from s2)::bigint, true"""
)
def commit_log_latest(spark, sf_dir):
    """The commit log with the size of each version, the latest one marked."""
    orders = versioned_orders(spark, sf_dir)
    commits = orders.commits()
    sizes = orders.versions().groupBy("version").agg(F.count(F.lit(1)).alias("records"))
    latest = latest_version(commits)
    return (
        commits.join(sizes, "version")
        .withColumn("is_latest", F.col("version") == latest)
        .select("version", "committed_at", "operation", "records", "is_latest")
    )


# ---- sample rows, one per order ------------------------------------------------


def _draw(name: str, choices: int) -> str:
    return f"(('0x' || substr(md5(id::varchar || ':42:{name}'), 1, 8))::bigint % {choices})"


def _pick(values: list[str], place: str) -> str:
    listed = ", ".join(f"'{v}'" for v in values)
    return f"([{listed}])[({place} + 1)::int]"


@query(
    f"""
    with ids as (select o_orderkey as id from orders),
    dated as (select id, date '2026-01-01' + {_draw("order_date", 61)}::int as d from ids)
    select id + 100000 as order_id,
           'C' || lpad(({_draw("customer_id", 300)} + 1)::varchar, 4, '0') as customer_id,
           d::date::varchar as order_date,
           {_pick(ORDER_CATEGORIES, _draw("product_category", 6))} as product_category,
           {_pick(ORDER_CITIES, _draw("city", 7))} as city,
           ({_draw("order_amount", 7470001)} + 30000) / 100.0::double as order_amount,
           {_pick(ORDER_STATUSES, _draw("order_status", 3))} as order_status,
           {_pick(PAYMENT_STATUSES, _draw("payment_status", 2))} as payment_status,
           strftime(d::timestamp + to_hours(({_draw("updated_at", 48)} + 1)::int),
                    '%Y-%m-%d %H:%M:%S') as updated_at
    from dated"""
)
def gen_orders(spark, sf_dir):
    return sample_orders(table(spark, sf_dir, "orders"), "o_orderkey")


@query(
    f"""
    with ids as (select o_orderkey as id from orders),
    drawn as (
        select id, {_draw("warehouse_id", 27)} as w,
               {_pick(MOVEMENT_TYPES, _draw("movement_type", 6))} as movement_type,
               ({_draw("quantity", 500)} + 1)::int as quantity,
               {_draw("available_quantity", 1001)}::int as stock,
               {_draw("damaged_quantity", 51)}::int as damage,
               date '2026-01-01' + {_draw("movement_date", 91)}::int as d
        from ids),
    moved as (
        select *, case movement_type when 'STOCK_SOLD' then greatest(stock - quantity, 0)
                       when 'STOCK_RECEIVED' then stock + quantity else stock end as available_quantity
        from drawn)
    select id + 500000 as inventory_id,
           'P' || lpad(({_draw("product_id", 5000)} + 1)::varchar, 5, '0') as product_id,
           'W' || lpad((w + 1)::varchar, 4, '0') as warehouse_id,
           {_pick(list(STOCK_REGIONS), "w // 3")} as city,
           d::date::varchar as movement_date,
           {_pick(STOCK_CATEGORIES, _draw("product_category", 7))} as product_category,
           movement_type, quantity, available_quantity,
           {_draw("reserved_quantity", 201)}::int as reserved_quantity,
           (damage + case when movement_type = 'STOCK_DAMAGED'
                          then {_draw("more_damage", 30)} + 1 else 0 end)::int as damaged_quantity,
           case when available_quantity <= 0 then 'OUT_OF_STOCK'
                when available_quantity < 20 then 'LOW_STOCK' else 'IN_STOCK' end as inventory_status,
           strftime(d::timestamp + to_hours(({_draw("updated_hour", 72)} + 1)::int)
                    + to_minutes({_draw("updated_minute", 60)}::int), '%Y-%m-%d %H:%M:%S') as updated_at,
           {_pick(SOURCE_SYSTEMS, _draw("source_system", 4))} as source_system,
           1 as sync_version
    from moved"""
)
def gen_inventory(spark, sf_dir):
    return sample_inventory(table(spark, sf_dir, "orders"), "o_orderkey")


