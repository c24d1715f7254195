"""The test tables in the shape of orders, inventory and their versions.

Each view exists twice: as a DataFrame and, with the same rows, as an SQL subquery.
Conditions on keys make the second state of a table differ from the first in every way a
change can (keys added, gone, altered, emptied); both states cover the whole table.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ["region", "nation", "customer", "supplier", "orders", "lineitem", "events"]

JANUARY = (dt.date(1996, 1, 1), dt.date(1996, 2, 1))
IN_JANUARY = "order_date >= date '1996-01-01' and order_date < date '1996-02-01'"
VERSION_1_AT = dt.datetime(2026, 1, 1)
VERSION_2_AT = dt.datetime(2026, 2, 1)
RUN_AT = dt.datetime(2026, 6, 24, 12, 0, 0)
RUN_AT_SQL = "timestamp '2026-06-24 12:00:00'"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def hours(number):
    return F.make_dt_interval(hours=number.cast("int"))


def month_sql(date: str) -> str:
    return f"((year({date}) - 1970) * 12 + month({date}) - 1)::int"


def with_sql(*names: str) -> str:
    """A WITH clause that defines the named views."""
    return "with " + ", ".join(f"{n} as ({VIEWS_SQL[n]})" for n in names) + " "


def v_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with city, amount as money, origin and version."""
    o, c, n = (table(spark, sf_dir, t) for t in ("orders", "customer", "nation"))
    key = F.col("o_orderkey")
    return (
        o.join(c, F.col("o_custkey") == F.col("c_custkey"))
        .join(n, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            key.alias("order_id"),
            F.concat(F.lit("C"), F.lpad(F.col("o_custkey").cast("string"), 4, "0")).alias("customer_id"),
            F.col("o_orderdate").cast("date").alias("order_date"),
            F.col("o_orderpriority").alias("product_category"),
            F.col("n_name").alias("city"),
            F.col("o_totalprice").cast("decimal(12,2)").alias("order_amount"),
            F.col("o_orderstatus").alias("order_status"),
            F.when(key % 2 == 0, "PAID").otherwise("PENDING").alias("payment_status"),
            (F.col("o_orderdate") + hours(key % 48 + 1)).alias("updated_at"),
            F.when(key % 3 == 0, "APP").otherwise("LAKE").alias("source_system"),
            F.lit(1).alias("sync_version"),
        )
    )


def v_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stock movements; ``inventory_id`` repeats."""
    li, s, n, r = (table(spark, sf_dir, t) for t in ("lineitem", "supplier", "nation", "region"))
    flag = F.col("l_returnflag")
    return (
        li.join(s, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(n, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(r, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            (F.col("l_orderkey") * 7 + F.col("l_linenumber") - 1).alias("inventory_id"),
            F.concat(F.lit("P"), F.lpad(F.col("l_partkey").cast("string"), 5, "0")).alias("product_id"),
            F.concat(F.lit("W"), F.lpad(F.col("l_suppkey").cast("string"), 4, "0")).alias("warehouse_id"),
            F.col("n_name").alias("city"),
            F.col("r_name").alias("region"),
            F.col("l_shipdate").cast("date").alias("movement_date"),
            F.when(flag == "A", "STOCK_SOLD")
            .when(flag == "R", "STOCK_RETURNED")
            .otherwise("STOCK_RECEIVED")
            .alias("movement_type"),
            F.col("l_quantity").cast("int").alias("quantity"),
            F.col("l_quantity").cast("int").alias("available_quantity"),
            (F.col("l_orderkey") % 50).cast("int").alias("damaged_quantity"),
            (F.col("l_shipdate") + hours(F.col("l_linenumber"))).alias("updated_at"),
            F.when(F.col("l_linestatus") == "F", "ERP").otherwise("WAREHOUSE_APP").alias("source_system"),
            F.lit(1).alias("sync_version"),
        )
    )


INVENTORY_TIES = ["product_id", "warehouse_id", "quantity", "damaged_quantity"]


def version_1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders before: some keys not there yet, some prices and priorities missing."""
    key = F.col("o_orderkey")
    return (
        table(spark, sf_dir, "orders")
        .where(key % 10 != 9)
        .select(
            "o_orderkey",
            "o_custkey",
            F.col("o_orderdate").cast("date").alias("order_date"),
            "o_orderstatus",
            F.when(key % 23 != 0, F.col("o_totalprice")).alias("o_totalprice"),
            F.when(key % 17 != 0, F.col("o_orderpriority")).alias("p"),
        )
    )


def version_2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders after: some keys gone, statuses and prices changed, gaps filled, some emptied."""
    key = F.col("o_orderkey")
    return (
        table(spark, sf_dir, "orders")
        .where(key % 11 != 0)
        .select(
            "o_orderkey",
            "o_custkey",
            F.col("o_orderdate").cast("date").alias("order_date"),
            F.when(key % 7 == 0, "X").otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
            F.when(key % 13 == 0, F.col("o_totalprice") + 1)
            .otherwise(F.col("o_totalprice"))
            .alias("o_totalprice"),
            F.when(key % 34 == 0, "").otherwise(F.col("o_orderpriority")).alias("p"),
        )
    )


def stock_1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inventory before, keys repeating; some dates and cities missing."""
    key = F.col("inventory_id")
    return (
        v_inventory(spark, sf_dir)
        .where(key % 10 != 9)
        .select(
            "inventory_id",
            F.when(key % 19 != 0, F.col("city")).alias("city"),
            F.when(key % 23 != 0, F.col("movement_date")).alias("movement_date"),
            "movement_type",
            "quantity",
            "updated_at",
        )
    )


def stock_2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inventory after: some keys gone, quantities and cities changed, gaps filled, some made."""
    key = F.col("inventory_id")
    return (
        v_inventory(spark, sf_dir)
        .where(key % 11 != 0)
        .select(
            "inventory_id",
            F.when(key % 38 == 0, "").otherwise(F.col("city")).alias("city"),
            F.when(key % 29 != 0, F.col("movement_date")).alias("movement_date"),
            F.when(key % 7 == 0, "STOCK_ADJUSTED").otherwise(F.col("movement_type")).alias("movement_type"),
            F.when(key % 13 == 0, F.col("quantity") + 1).otherwise(F.col("quantity")).alias("quantity"),
            "updated_at",
        )
    )


def corrections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Up to three corrections for every twentieth order, from three sources."""
    orders = v_orders(spark, sf_dir).where(F.col("order_id") % 20 == 0)
    k = F.col("k")
    return (
        orders.withColumn("k", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))))
        .where(~((k == 1) & (F.col("order_id") % 40 == 0)))
        .select(
            "order_id",
            (F.col("order_amount") + k).cast("decimal(12,2)").alias("order_amount"),
            F.when(k == 1, "finance_team").when(k == 2, "ops_team").otherwise("other").alias(
                "correction_source"
            ),
            (F.col("updated_at") + hours(k)).alias("updated_at"),
        )
    )


VIEWS_SQL = {
    "v_orders": """
        select o_orderkey as order_id,
               'C' || lpad(cast(o_custkey as varchar), 4, '0') as customer_id,
               cast(o_orderdate as date) as order_date,
               o_orderpriority as product_category,
               n_name as city,
               cast(o_totalprice as decimal(12,2)) as order_amount,
               o_orderstatus as order_status,
               case when o_orderkey % 2 = 0 then 'PAID' else 'PENDING' end as payment_status,
               o_orderdate + to_hours(cast(o_orderkey % 48 + 1 as int)) as updated_at,
               case when o_orderkey % 3 = 0 then 'APP' else 'LAKE' end as source_system,
               1 as sync_version
        from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey""",
    "v_inventory": """
        select l_orderkey * 7 + l_linenumber - 1 as inventory_id,
               'P' || lpad(cast(l_partkey as varchar), 5, '0') as product_id,
               'W' || lpad(cast(l_suppkey as varchar), 4, '0') as warehouse_id,
               n_name as city, r_name as region,
               cast(l_shipdate as date) as movement_date,
               case l_returnflag when 'A' then 'STOCK_SOLD' when 'R' then 'STOCK_RETURNED'
                    else 'STOCK_RECEIVED' end as movement_type,
               cast(l_quantity as int) as quantity,
               cast(l_quantity as int) as available_quantity,
               cast(l_orderkey % 50 as int) as damaged_quantity,
               l_shipdate + to_hours(cast(l_linenumber as int)) as updated_at,
               case when l_linestatus = 'F' then 'ERP' else 'WAREHOUSE_APP' end as source_system,
               1 as sync_version
        from lineitem join supplier on l_suppkey = s_suppkey
             join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey""",
    "latest_inventory": """
        select * exclude (rn) from (
            select *, row_number() over (partition by inventory_id
                order by updated_at desc, product_id, warehouse_id, quantity, damaged_quantity) as rn
            from v_inventory)
        where rn = 1""",
    "s1": """
        select o_orderkey, o_custkey, cast(o_orderdate as date) as order_date, o_orderstatus,
               case when o_orderkey % 23 = 0 then null else o_totalprice end as o_totalprice,
               case when o_orderkey % 17 = 0 then null else o_orderpriority end as p
        from orders where o_orderkey % 10 <> 9""",
    "s2": """
        select o_orderkey, o_custkey, cast(o_orderdate as date) as order_date,
               case when o_orderkey % 7 = 0 then 'X' else o_orderstatus end as o_orderstatus,
               case when o_orderkey % 13 = 0 then o_totalprice + 1 else o_totalprice end as o_totalprice,
               case when o_orderkey % 34 = 0 then '' else o_orderpriority end as p
        from orders where o_orderkey % 11 <> 0""",
    "stock1": """
        select inventory_id,
               case when inventory_id % 19 = 0 then null else city end as city,
               case when inventory_id % 23 = 0 then null else movement_date end as movement_date,
               movement_type, quantity, updated_at
        from v_inventory where inventory_id % 10 <> 9""",
    "stock2": """
        select inventory_id,
               case when inventory_id % 38 = 0 then '' else city end as city,
               case when inventory_id % 29 = 0 then null else movement_date end as movement_date,
               case when inventory_id % 7 = 0 then 'STOCK_ADJUSTED' else movement_type end as movement_type,
               case when inventory_id % 13 = 0 then quantity + 1 else quantity end as quantity,
               updated_at
        from v_inventory where inventory_id % 11 <> 0""",
    "corr": """
        select order_id, cast(order_amount + k as decimal(12,2)) as order_amount,
               case k when 1 then 'finance_team' when 2 then 'ops_team' else 'other' end as correction_source,
               updated_at + to_hours(k) as updated_at
        from v_orders cross join (select 1 as k union all select 2 union all select 3) x
        where order_id % 20 = 0 and not (k = 1 and order_id % 40 = 0)""",
}
