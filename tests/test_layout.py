import datetime as dt
import glob
import os

from pyspark.sql import functions as F

from tests.conftest import rows_of
from tidemark.functions import in_month_range, in_months, month_ordinal, stock_status
from tidemark.functions.stock import adjusted_stock
from tidemark.operators.layout import (
    Layout,
    add_columns,
    bytes_scanned,
    empty_like,
    ensure_table,
    file_inventory,
    file_listing,
    overwrite_partitions,
    partition_count,
    partition_file_stats,
    read_partitioned,
    replace_partitions,
    save_bucketed,
    write_partitioned,
)


def days(spark, n=120):
    return spark.range(n).select(
        F.col("id").alias("k"),
        F.date_add(F.lit("2026-01-01").cast("date"), F.col("id").cast("int")).alias("day"),
        F.when(F.col("id") % 10 != 0, F.col("id") % 3).alias("who"),
    )


def test_month_ordinal(spark):
    dates = spark.sql("select explode(array(date'1969-12-31', date'1970-01-01', date'2026-03-15')) as d")
    assert [r[0] for r in dates.select(month_ordinal(F.col("d"))).collect()] == [-1, 0, 674]


def test_composite_layout(spark, folder):
    layout = Layout("day", (), ("who", 2))
    write_partitioned(days(spark), folder, layout, drop_null_keys=True)
    back = read_partitioned(spark, folder, days(spark).schema, layout)
    assert rows_of(back.select("k", "day", "who")) == rows_of(days(spark).where("who is not null"))
    assert layout.columns == ["day_month", "who_bucket"]
    found = partition_count(back, layout.columns).first()["total_partitions"]
    assert found == back.select(*layout.columns).distinct().count()


def test_month_filter_reaches_folders_and_files(spark, folder):
    layout = Layout("day")
    write_partitioned(days(spark), folder, layout)
    back = read_partitioned(spark, folder, days(spark).schema, layout)
    january = back.where(
        in_month_range(F.col("day"), dt.date(2026, 1, 10), dt.date(2026, 2, 1), F.col("day_month"))
    )
    plan = january.select("k")._jdf.queryExecution().executedPlan().toString()
    assert "day_month" in plan.split("PartitionFilters")[1].split("]")[0]
    assert "GreaterThanOrEqual(day" in plan
    assert january.count() == 22


def test_dynamic_overwrite_matches_its_pure_form(spark, folder):
    layout = Layout("day")
    write_partitioned(days(spark), folder, layout)
    two = days(spark).where("k in (1, 2)").withColumn("who", F.lit(77).cast("bigint"))
    pure = replace_partitions(days(spark), two, layout)
    overwrite_partitions(two, folder, layout)
    back = read_partitioned(spark, folder, days(spark).schema, layout).select("k", "day", "who")
    assert rows_of(back) == rows_of(pure)
    assert back.count() == 120 - 31 + 2


def test_partition_stats(spark, folder):
    layout = Layout("day")
    write_partitioned(days(spark), folder, layout)
    write_partitioned(days(spark).where("k < 31"), folder, layout, mode="append")
    files = file_inventory(spark, folder, days(spark).schema, layout, records=True)
    stats = partition_file_stats(files, ["day_month"]).collect()
    assert [(r["day_month"], r["file_count"], r["records"]) for r in stats][0] == (672, 2, 62)
    assert sum(r["records"] for r in stats) == 151
    plan = files._jdf.queryExecution().executedPlan().toString()
    # Footers of the data files, and no content of the listed ones.
    assert "ReadSchema: struct<>" in plan and "ReadSchema: struct<path:string,length:bigint>" in plan
    on_disk = [os.path.getsize(f) for f in glob.glob(f"{folder.removeprefix('file:')}/**/*.parquet", recursive=True)]
    listed = file_inventory(spark, folder, days(spark).schema, layout)
    assert sorted(r["file_size_in_bytes"] for r in listed.collect()) == sorted(on_disk)
    assert "Parquet" not in listed._jdf.queryExecution().executedPlan().toString()


def test_mean_size_of_files(spark):
    files = spark.createDataFrame([("a", 3 << 20), ("a", 4 << 20), ("b", 1000)], "part string, file_size_in_bytes bigint")
    stats = [tuple(r) for r in partition_file_stats(files, ["part"]).collect()]
    assert stats == [("a", 2, 3.5), ("b", 1, 0.0)]


def test_identity_values_come_back(spark, folder):
    values = ["", None, " ", "a b", "+1", "-01", "a/b=c%d+e", "%2B", "n", "v", "__HIVE_DEFAULT_PARTITION__", "Ü:*?{}", "1995-01-01"]
    rows = spark.createDataFrame([(i, v, i % 2 == 0, None if i % 3 else -0.5) for i, v in enumerate(values)], "k int, who string, even boolean, d double")
    layout = Layout(identity=("who", "even", "d"))
    write_partitioned(rows, folder, layout)
    back = read_partitioned(spark, folder, rows.schema, layout)
    assert rows_of(back.select(rows.columns)) == rows_of(rows)
    for value in values:
        assert [r["who"] for r in back.where(layout.in_part("who", value)).collect()] == [value]
    listed = file_inventory(spark, folder, rows.schema, layout)
    assert sorted(((r["who"], r["even"], r["d"]) for r in listed.collect()), key=repr) == sorted(((r["who"], r["even"], r["d"]) for r in rows.collect()), key=repr)
    plan = back.where(layout.in_part("who", ""))._jdf.queryExecution().executedPlan().toString()
    assert "who_part" in plan.split("PartitionFilters")[1].split("]")[0]
    kept = replace_partitions(rows, rows.where("k = 1").withColumn("k", F.lit(99)), Layout(identity=("who",)))
    assert kept.count() == len(values) and [r["k"] for r in kept.where("who is null").collect()] == [99]


def test_bucketed_tables_join_without_a_shuffle(spark, folder, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    names = [f"bucketed_{side}_{folder[-12:]}" for side in ("a", "b")]
    for name in names:
        save_bucketed(days(spark).repartition(7), name, f"{folder}/{name}", "k", 10)
        # One file a bucket, however many tasks wrote.
        assert file_listing(spark, f"{folder}/{name}").count() == 10
    joined = spark.table(names[0]).join(spark.table(names[1]), "k")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert joined.count() == 120


def test_tables_and_clones(spark, folder):
    name = f"declared_{folder[-12:]}"
    assert ensure_table(spark, name, days(spark).schema, folder).count() == 0
    days(spark).write.insertInto(name)
    assert ensure_table(spark, name, "k bigint", folder).count() == 120
    clone = empty_like(spark.table(name))
    assert clone.schema == spark.table(name).schema and clone.count() == 0
    wider = add_columns(clone, {"k": "string", "coupon": "string"})
    assert dict(wider.dtypes)["k"] == "bigint" and wider.columns[-1] == "coupon"


def test_hot_partition_is_written_as_several_files(spark, folder, conf):
    conf(spark__sql__adaptive__advisoryPartitionSizeInBytes="50KB")
    hot = spark.range(0, 60000, numPartitions=8).select(
        F.sha2(F.col("id").cast("string"), 256).alias("v"),
        F.when(F.col("id") % 3 == 0, F.lit("2026-01-05")).otherwise("2026-02-05").cast("date").alias("day"),
    )
    write_partitioned(hot, folder, Layout("day"))
    back = read_partitioned(spark, folder, hot.schema, Layout("day"))
    assert file_inventory(spark, folder, hot.schema, Layout("day")).count() > 4 and back.count() == 60000


def test_stock_rules(spark):
    rows = spark.createDataFrame(
        [(v, 1, None) for v in (-5, 0, 19, 20, 39, 40, None)],
        "available_quantity int, damaged_quantity int, sync_version int",
    )
    statuses = rows.select(stock_status(F.col("available_quantity")).alias("s")).collect()
    assert [r["s"] for r in statuses] == [
        "OUT_OF_STOCK",
        "OUT_OF_STOCK",
        "LOW_STOCK",
        "IN_STOCK",
        "IN_STOCK",
        "IN_STOCK",
        "IN_STOCK",
    ]
    moved = rows.select([c.alias(n) for n, c in adjusted_stock(F.lit(0)).items()]).collect()
    assert [r["available_quantity"] for r in moved] == [0, 0, 0, 0, 19, 20, 0]
    assert [r["inventory_status"] for r in moved[:6]] == [
        "OUT_OF_STOCK",
        "OUT_OF_STOCK",
        "OUT_OF_STOCK",
        "OUT_OF_STOCK",
        "LOW_STOCK",
        "IN_STOCK",
    ]
    assert {r["sync_version"] for r in moved} == {2} and {r["damaged_quantity"] for r in moved} == {21}
    kept = rows.select(adjusted_stock(F.lit(0), first_version=None)["sync_version"].alias("v"))
    assert {r["v"] for r in kept.collect()} == {None}


def test_bytes_scanned_are_those_of_the_folders_asked_for(spark, folder):
    layout = Layout("day")
    write_partitioned(days(spark), folder, layout)
    back = read_partitioned(spark, folder, days(spark).schema, layout)
    february = glob.glob(f"{folder.removeprefix('file:')}/day_month=673/*.parquet")
    whole = glob.glob(f"{folder.removeprefix('file:')}/*/*.parquet")
    found = bytes_scanned(spark, folder, back.where(in_months(F.col("day_month"), dt.date(2026, 2, 1), dt.date(2026, 3, 1)))).first()
    assert (found["bytes_read"], found["bytes"]) == (sum(map(os.path.getsize, february)), sum(map(os.path.getsize, whole)))
