"""Writes, partition layouts, file metadata and compaction."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.acceptance.registry import query
from tidemark.acceptance.scans import BY_MONTH
from tidemark.acceptance.views import (
    IN_JANUARY,
    JANUARY,
    VERSION_1_AT,
    month_sql,
    table,
    v_orders,
    with_sql,
)
from tidemark.functions import in_month_range, in_months
from tidemark.operators.layout import (
    Layout,
    batch_of,
    bytes_scanned,
    empty_like,
    ensure_table,
    file_inventory as list_files,
    partition_count as count_partitions,
    partition_file_stats as file_stats,
    read_partitioned,
    replace_partitions,
    save_bucketed,
    write_partitioned,
)
from tidemark.plans.table import VersionedTable
from tidemark.session import work_folder

REVENUE_SQL = (
    with_sql("v_orders")
    + f"""
    select count(*)::bigint as jan_orders, sum(order_amount)::double as jan_revenue
    from v_orders where {IN_JANUARY}"""
)


def january_revenue(rows):
    return rows.agg(
        F.count(F.lit(1)).alias("jan_orders"),
        F.sum("order_amount").cast("double").alias("jan_revenue"),
    )


def plain_orders(spark, sf_dir):
    """Orders with a date, without the joins that add a city."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("order_amount"),
    )


PLAIN_SQL = """
    with plain as (
        select o_orderkey as order_id, o_custkey as customer_id, cast(o_orderdate as date) as order_date,
               o_orderstatus as order_status, cast(o_totalprice as decimal(12,2)) as order_amount
        from orders) """


def _landed(spark, df, layout, **options):
    path = work_folder(spark, "landed")
    write_partitioned(df, path, layout, **options)
    return path, read_partitioned(spark, path, df.schema, layout)


@query(REVENUE_SQL)
def month_partition_revenue(spark, sf_dir):
    """Land orders by month, then read one month's folder."""
    _, landed = _landed(spark, v_orders(spark, sf_dir), BY_MONTH)
    month = F.col(BY_MONTH.month)
    return january_revenue(landed.where(in_month_range(F.col("order_date"), *JANUARY, month)))


@query(REVENUE_SQL)
def bucket_layout_revenue(spark, sf_dir):
    """The same question to a layout by customer hash, which cannot prune by date."""
    layout = Layout(bucket=("customer_id", 10))
    _, landed = _landed(spark, v_orders(spark, sf_dir), layout)
    return january_revenue(landed.where(in_month_range(F.col("order_date"), *JANUARY)))


@query(
    with_sql("v_orders")
    + f"""
    select layout, layout = 'month' as reads_less, count(*)::bigint as jan_orders, sum(order_amount)::double as jan_revenue
    from v_orders cross join (values ('plain'), ('month'), ('bucket')) as l(layout)
    where {IN_JANUARY} group by all"""
)
def data_scanned_by_layout(spark, sf_dir):
    """January's orders and revenue from three layouts, and whether fewer bytes were read than are there."""
    layouts = {"plain": Layout(), "month": BY_MONTH, "bucket": Layout(bucket=("customer_id", 10))}
    answers = []
    for name, layout in layouts.items():
        path, landed = _landed(spark, v_orders(spark, sf_dir), layout)
        month = F.col(layout.month) if layout.month else None
        january = landed.where(in_month_range(F.col("order_date"), *JANUARY, month))
        folders = landed if month is None else landed.where(in_months(month, *JANUARY))
        named = F.lit(name).alias("layout")
        less = bytes_scanned(spark, path, folders).select(named, (F.col("bytes_read") < F.col("bytes")).alias("reads_less"))
        answers.append(january_revenue(january).select(named, "*").join(less, "layout"))
    return reduce(DataFrame.unionByName, answers)


@query(
    PLAIN_SQL
    + f"""
    select {month_sql("order_date")} as order_date_month, order_status, count(*)::bigint as orders,
           sum(order_amount)::double as revenue
    from plain where customer_id is not null group by all"""
)
def composite_layout_counts(spark, sf_dir):
    """Month, status and customer bucket at once; rows without a customer are left out."""
    layout = Layout("order_date", ("order_status",), ("customer_id", 4))
    _, landed = _landed(spark, plain_orders(spark, sf_dir), layout, drop_null_keys=True)
    return landed.groupBy("order_date_month", "order_status").agg(
        F.count(F.lit(1)).alias("orders"), F.sum("order_amount").cast("double").alias("revenue")
    )


@query(
    PLAIN_SQL
    + f"""
    select {month_sql("order_date")} as order_date_month, true as has_files, count(*)::bigint as records
    from plain group by all"""
)
def partition_file_stats(spark, sf_dir):
    path, landed = _landed(spark, plain_orders(spark, sf_dir), BY_MONTH)
    files = list_files(spark, path, landed.drop(*BY_MONTH.columns).schema, BY_MONTH, records=True)
    stats = file_stats(files, BY_MONTH.columns)
    has_files = (F.col("file_count") >= 1) & (F.col("avg_file_size_mb") >= 0)
    return stats.select("order_date_month", has_files.alias("has_files"), "records")


@query(
    PLAIN_SQL
    + f"""
    select {month_sql("order_date")} as order_date_month, count(*)::bigint as records,
           true as same_files, true as same_mean_mb
    from plain group by all"""
)
def file_inventory(spark, sf_dir):
    """Files listed without opening them, set against those that a scan of the rows names."""
    path, landed = _landed(spark, plain_orders(spark, sf_dir), BY_MONTH)
    parts = BY_MONTH.columns
    listed = file_stats(list_files(spark, path, landed.drop(*parts).schema, BY_MONTH, records=True), parts)
    scanned = landed.select(*parts, "_metadata.file_path", "_metadata.file_size").distinct()
    scanned = scanned.groupBy(*parts).agg(
        F.count(F.lit(1)).alias("files"), F.round(F.avg("file_size") / 1024 / 1024, 2).alias("mean_mb")
    )
    return listed.join(scanned, parts).select(
        *parts,
        "records",
        (F.col("file_count") == F.col("files")).alias("same_files"),
        (F.col("avg_file_size_mb") == F.col("mean_mb")).alias("same_mean_mb"),
    )


IDENTITY = "case o_orderkey % 7 when 0 then null when 1 then '' when 2 then ' ' when 3 then '+1' when 4 then 'a/b=c%d' when 5 then 'n' else o_orderpriority end"


@query(
    f"""
    select {IDENTITY} as label, cast(null as varchar) as picked, count(*)::bigint as orders, sum(o_orderkey)::bigint as keys
    from orders group by all
    union all
    select {IDENTITY}, 'empty', count(*)::bigint, sum(o_orderkey)::bigint from orders where {IDENTITY} = '' group by all
    union all
    select {IDENTITY}, 'null', count(*)::bigint, sum(o_orderkey)::bigint from orders where {IDENTITY} is null group by all"""
)
def identity_layout_values(spark, sf_dir):
    """Orders partitioned by a text that may be NULL, empty or full of signs; two folders read alone."""
    layout = Layout(identity=("label",))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.expr(IDENTITY).alias("label"))
    _, landed = _landed(spark, orders, layout)

    def counted(rows, picked):
        return rows.groupBy("label", F.lit(picked).cast("string").alias("picked")).agg(
            F.count(F.lit(1)).alias("orders"), F.sum("o_orderkey").alias("keys")
        )

    empty = counted(landed.where(layout.in_part("label", "")), "empty")
    null = counted(landed.where(layout.in_part("label", None)), "null")
    return counted(landed, None).union(empty).union(null)


@query(
    """
    select c_mktsegment, count(*)::bigint as orders, sum(cast(o_totalprice as decimal(12,2)))::double as revenue
    from orders join customer on o_custkey = c_custkey group by all"""
)
def bucketed_join(spark, sf_dir):
    """Orders and customers in catalog tables bucketed by customer, joined where they lie."""
    buckets = 8
    frames = {
        "orders": table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("custkey"), F.col("o_totalprice").cast("decimal(12,2)").alias("price")),
        "customers": table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("custkey"), "c_mktsegment"),
    }
    held = {}
    for name, frame in frames.items():
        held[name] = f"{name}_bucketed_{uuid.uuid4().hex[:12]}"
        save_bucketed(frame, held[name], work_folder(spark, held[name]), "custkey", buckets)
    joined = spark.table(held["orders"]).join(spark.table(held["customers"]), "custkey")
    return joined.groupBy("c_mktsegment").agg(
        F.count(F.lit(1)).alias("orders"), F.sum("price").cast("double").alias("revenue")
    )


@query(
    PLAIN_SQL
    + f"select count(distinct {month_sql('order_date')})::bigint as total_partitions from plain"
)
def partition_count(spark, sf_dir):
    _, landed = _landed(spark, plain_orders(spark, sf_dir), BY_MONTH)
    return count_partitions(landed, BY_MONTH.columns)


@query(
    PLAIN_SQL
    + """
    select order_status, count(*)::bigint as orders, sum(order_amount)::double as revenue
    from plain group by order_status"""
)
def empty_clone_append(spark, sf_dir):
    """An empty table declared if absent, filled from an empty clone and then from all orders."""
    orders = plain_orders(spark, sf_dir)
    name = f"orders_clone_{uuid.uuid4().hex[:12]}"
    path = work_folder(spark, "clone")
    ensure_table(spark, name, orders.schema, path)
    ensure_table(spark, name, orders.schema, path)
    empty_like(orders).write.insertInto(name)
    orders.write.insertInto(name)
    return spark.table(name).groupBy("order_status").agg(
        F.count(F.lit(1)).alias("orders"), F.sum("order_amount").cast("double").alias("revenue")
    )


def _batched(spark, sf_dir):
    orders = plain_orders(spark, sf_dir)
    root = work_folder(spark, "batched")
    by_status = Layout(identity=("order_status",))
    batched = VersionedTable.create(empty_like(orders), root, by_status, VERSION_1_AT)
    batched.append_in_batches(orders, batch_of("order_id", 10), 10)
    return batched


@query(
    PLAIN_SQL
    + """
    select order_status, count(*)::bigint as orders, sum(order_amount)::double as revenue,
           10::bigint as appends
    from plain group by order_status"""
)
def batched_append_total(spark, sf_dir):
    """Ten appends cut by key hash, one commit each."""
    batched = _batched(spark, sf_dir)
    appends = batched.commits().where(F.col("operation") == "append").count()
    return (
        batched.as_of()
        .groupBy("order_status")
        .agg(F.count(F.lit(1)).alias("orders"), F.sum("order_amount").cast("double").alias("revenue"))
        .withColumn("appends", F.lit(appends).cast("bigint"))
    )


@query(
    PLAIN_SQL
    + """
    select order_status, count(*)::bigint as orders, sum(order_amount)::double as revenue,
           true as fewer_files
    from plain group by order_status"""
)
def compaction_preserves_rows(spark, sf_dir):
    batched = _batched(spark, sf_dir)
    before = batched.files().count()
    batched.compact()
    fewer = batched.files().count() < before
    return (
        batched.as_of()
        .groupBy("order_status")
        .agg(F.count(F.lit(1)).alias("orders"), F.sum("order_amount").cast("double").alias("revenue"))
        .withColumn("fewer_files", F.lit(fewer))
    )


@query(
    PLAIN_SQL
    + f"""
    select strftime(order_date, '%Y-%m') as order_month,
           case when {IN_JANUARY} then 'REPROCESSED' else order_status end as order_status,
           count(*)::bigint as records
    from plain group by all"""
)
def overwrite_partitions_reprocess(spark, sf_dir):
    """One month read, corrected and written back over itself, as a new version."""
    orders = VersionedTable.create(plain_orders(spark, sf_dir), work_folder(spark, "reprocessed"), BY_MONTH, VERSION_1_AT)
    january = orders.as_of(months=JANUARY)
    orders.overwrite_partitions(january.withColumn("order_status", F.lit("REPROCESSED")))
    month = F.date_format("order_date", "yyyy-MM").alias("order_month")
    return orders.as_of().groupBy(month, "order_status").agg(F.count(F.lit(1)).alias("records"))


@query(
    PLAIN_SQL
    + f"""
    select order_id, order_date, order_status, order_amount::double as order_amount
    from plain where not ({IN_JANUARY})
    union all
    (select order_id, order_date, 'ONLY_TWO_ROWS_OVERWRITE', order_amount::double
     from plain where {IN_JANUARY} order by order_id limit 2)"""
)
def overwrite_partitions_loss(spark, sf_dir):
    """Two rows overwrite their month: the rest of that month is gone."""
    orders = plain_orders(spark, sf_dir)
    two = orders.where(in_month_range(F.col("order_date"), *JANUARY)).orderBy("order_id").limit(2)
    two = two.withColumn("order_status", F.lit("ONLY_TWO_ROWS_OVERWRITE"))
    return replace_partitions(orders, two, BY_MONTH).select(
        "order_id", "order_date", "order_status", F.col("order_amount").cast("double").alias("order_amount")
    )


@query(
    PLAIN_SQL
    + f"""
    select {month_sql("order_date")} as order_date_month, count(*)::bigint as orders,
           sum(order_amount)::double as revenue
    from plain group by all"""
)
def layout_evolution_read(spark, sf_dir):
    """Half the orders written without partitions, half by month; one read of both, by month."""
    orders = plain_orders(spark, sf_dir)
    even = F.col("order_id") % 2 == 0
    evolved = VersionedTable.create(orders.where(even), work_folder(spark, "evolved"))
    evolved.evolve_layout(BY_MONTH)
    evolved.append(orders.where(~even))
    return (
        evolved.as_of(with_layout=True)
        .groupBy("order_date_month")
        .agg(F.count(F.lit(1)).alias("orders"), F.sum("order_amount").cast("double").alias("revenue"))
    )
