"""Joins with dimensions and aggregations."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.acceptance.layouts import PLAIN_SQL, plain_orders
from tidemark.acceptance.registry import query
from tidemark.acceptance.views import (
    IN_JANUARY,
    JANUARY,
    table,
    v_inventory,
    v_orders,
    with_sql,
)
from tidemark.functions import in_month_range
from tidemark.operators.sizes import measured

CITY_DIM_SQL = """
    city_dim as (
        select n_name as city, case when n_nationkey % 3 = 0 then 'Tier 2' else 'Tier 1' end as city_tier,
               r_name as region
        from nation join region on n_regionkey = r_regionkey where n_nationkey <> 7) """
BY_REGION_SQL = (
    with_sql("v_orders")
    + f""", {CITY_DIM_SQL}
    select region, city_tier, count(*)::bigint as orders
    from v_orders left join city_dim using (city) group by region, city_tier"""
)


def city_dim(spark, sf_dir):
    """City, tier and region; one city is missing."""
    nations = table(spark, sf_dir, "nation").where(F.col("n_nationkey") != 7)
    regions = table(spark, sf_dir, "region")
    tier = F.when(F.col("n_nationkey") % 3 == 0, "Tier 2").otherwise("Tier 1")
    return nations.join(regions, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_name").alias("city"), tier.alias("city_tier"), F.col("r_name").alias("region")
    )


@query(BY_REGION_SQL)
def dim_join_sortmerge(spark, sf_dir):
    """Without a broadcast: counted by city first, so that the join shuffles one row per city."""
    per_city = v_orders(spark, sf_dir).groupBy("city").agg(F.count(F.lit(1)).alias("n"))
    joined = per_city.hint("merge").join(city_dim(spark, sf_dir), "city", "left")
    return joined.groupBy("region", "city_tier").agg(F.sum("n").alias("orders"))


@query(BY_REGION_SQL)
def dim_join_broadcast(spark, sf_dir):
    """With a broadcast of the dimension, whose size in bytes is measured first."""
    dim = measured(city_dim(spark, sf_dir))
    joined = v_orders(spark, sf_dir).join(dim, "city", "left")
    return joined.groupBy("region", "city_tier").agg(F.count(F.lit(1)).alias("orders"))


@query(
    with_sql("v_inventory")
    + """
    select region, movement_type, count(*)::bigint as movements, sum(available_quantity)::bigint as available
    from v_inventory group by region, movement_type"""
)
def inventory_by_region(spark, sf_dir):
    return (
        v_inventory(spark, sf_dir)
        .groupBy("region", "movement_type")
        .agg(F.count(F.lit(1)).alias("movements"), F.sum("available_quantity").alias("available"))
    )


@query(with_sql("v_orders") + "select city, count(*)::bigint as orders from v_orders group by city")
def count_by_city(spark, sf_dir):
    return v_orders(spark, sf_dir).groupBy("city").agg(F.count(F.lit(1)).alias("orders"))


@query(
    with_sql("v_orders")
    + f"select city, count(*)::bigint as orders from v_orders where {IN_JANUARY} group by city"
)
def count_by_city_january(spark, sf_dir):
    """Filter and projection before the shuffle."""
    january = v_orders(spark, sf_dir).where(in_month_range(F.col("order_date"), *JANUARY))
    return january.select("city").groupBy("city").agg(F.count(F.lit(1)).alias("orders"))


@query(
    with_sql("v_orders")
    + """
    select order_status, payment_status, count(*)::bigint as orders,
           round(count(*)::double / (select count(*) from v_orders), 6) as share,
           round((sum(order_amount)::double / count(*)), 2) as avg_amount, max(updated_at) as last_update
    from v_orders group by order_status, payment_status"""
)
def status_distribution(spark, sf_dir):
    """Orders per status with their share of all, from a single scan."""
    orders = v_orders(spark, sf_dir)
    groups = orders.groupBy("order_status", "payment_status").agg(
        F.count(F.lit(1)).alias("orders"),
        F.sum("order_amount").cast("double").alias("amount"),
        F.max("updated_at").alias("last_update"),
    )
    # One row per status pair is left by now, so a window over all of them is small.
    total = F.sum("orders").over(Window.partitionBy(F.lit(1)))
    return groups.select(
        "order_status",
        "payment_status",
        "orders",
        F.round(F.col("orders") / total, 6).alias("share"),
        F.round(F.col("amount") / F.col("orders"), 2).alias("avg_amount"),
        "last_update",
    )


@query(
    with_sql("v_orders")
    + f""", jan as (select * from v_orders where {IN_JANUARY})
    select 'city' as cut, city as name, count(*)::bigint as orders, sum(order_amount)::double as amount
    from jan group by city
    union all
    select 'category', product_category, count(*), sum(order_amount)::double from jan group by product_category
    union all select 'all', null, count(*), sum(order_amount)::double from jan"""
)
def dict_agg(spark, sf_dir):
    """Three aggregations of one month from a single pass, instead of a cache and three jobs."""
    january = v_orders(spark, sf_dir).where(in_month_range(F.col("order_date"), *JANUARY))
    sets = january.groupingSets(
        [["city"], ["product_category"], []], "city", "product_category"
    ).agg(
        F.grouping("city").alias("no_city"),
        F.grouping("product_category").alias("no_category"),
        F.count(F.lit(1)).alias("orders"),
        F.sum("order_amount").cast("double").alias("amount"),
    )
    cut = F.when(F.col("no_city") == 0, "city").when(F.col("no_category") == 0, "category").otherwise("all")
    return sets.select(
        cut.alias("cut"), F.coalesce("city", "product_category").alias("name"), "orders", "amount"
    )


@query(
    PLAIN_SQL
    + """
    select order_id, order_status, order_amount::double as order_amount
    from plain where order_status in ('F', 'P')"""
)
def ordered_inlist(spark, sf_dir):
    rows = plain_orders(spark, sf_dir).where(F.col("order_status").isin("F", "P"))
    return rows.select(
        "order_id", "order_status", F.col("order_amount").cast("double").alias("order_amount")
    ).orderBy("order_id")
