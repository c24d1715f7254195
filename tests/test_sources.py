import datetime as dt

import pytest
from pyspark.errors import NumberFormatException
from pyspark.sql import functions as F

from tests.conftest import rows_of
from tidemark.operators import latest_per_key
from tidemark.sources import (
    JdbcReplica,
    literal_rows,
    read_csv,
    read_rows,
    sample_inventory,
    sample_orders,
    sample_warehouses,
    write_rows,
)
from tidemark.sources.delimited import NULL_TEXT
from tidemark.sources.delimited import typed
from tidemark.sources.samples import numbered


def test_quoted_text(spark, folder):
    rows = [(1, 'a "q", b'), (2, "back\\slash"), (3, None), (4, "")]
    df = spark.createDataFrame(rows, "id bigint, note string")
    write_rows(df, folder, "csv")
    back = read_csv(spark, folder, "id bigint, note string", escape='"', null_value=NULL_TEXT)
    assert {r["id"]: r["note"] for r in back.collect()}[1] == 'a "q", b'
    assert back.count() == 4


@pytest.mark.parametrize("file_format", ["csv", "parquet"])
def test_rows_come_back_by_default(spark, folder, file_format):
    rows = [(1, None), (2, ""), (3, "  pad "), (4, 'say "hi", ok'), (5, "back\\slash"), (None, "NULL")]
    frame = spark.createDataFrame(rows, "id bigint, note string")
    write_rows(frame, folder, file_format)
    assert rows_of(read_rows(spark, folder, frame.schema, file_format)) == rows_of(frame)
    with pytest.raises(ValueError, match="csv"):
        read_rows(spark, folder, file_format="orc")


def test_backslash_escapes(spark, folder):
    lines = spark.createDataFrame([('id,note\n1,"say \\"hi\\", ok"',)], "value string")
    lines.coalesce(1).write.text(folder)
    assert read_csv(spark, folder, "id bigint, note string").first()["note"] == 'say "hi", ok'


def test_parquet_and_unknown_formats(spark, folder):
    df = spark.range(3)
    write_rows(df, folder, "parquet")
    assert spark.read.parquet(folder).count() == 3
    with pytest.raises(ValueError, match="csv"):
        write_rows(df, folder, "orc")


def test_bad_text_fails_or_becomes_null(spark):
    raw = spark.createDataFrame([("7",), ("seven",)], "n string")
    with pytest.raises(NumberFormatException):
        typed(raw, {"n": "int"}).collect()
    assert [r["n"] for r in typed(raw, {"n": "int"}, bad_values="null").collect()] == [7, None]


def test_literal_view(spark):
    literal_rows(spark, [(1, "x")], "id bigint, name string", view="literal_test")
    assert spark.sql("select name from literal_test").first()["name"] == "x"


def test_literal_rows_have_a_known_size(spark):
    rows = [(1, dt.datetime(2026, 1, 1, 5, 0, 0, 7), None), (2, None, "x")]
    df = literal_rows(spark, rows, "id bigint, at timestamp_ntz, note string")
    assert [tuple(r) for r in df.collect()] == rows
    for small in (df, literal_rows(spark, [], "id bigint")):
        plan = spark.range(10**9).join(small, "id")._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan


def test_samples_do_not_depend_on_partitions(spark):
    one, many = numbered(spark, 500).coalesce(1), numbered(spark, 500).repartition(8)
    assert rows_of(sample_orders(one)) == rows_of(sample_orders(many))
    assert rows_of(sample_inventory(one)) == rows_of(sample_inventory(many))
    assert rows_of(sample_orders(one, seed=1)) != rows_of(sample_orders(one))


def test_sample_orders_stay_in_range(spark):
    orders = sample_orders(numbered(spark, 3000))
    facts = orders.agg(
        F.min("order_id"),
        F.max("order_id"),
        F.countDistinct("customer_id"),
        F.min("order_date"),
        F.max("order_date"),
        F.min("order_amount") >= 300,
        F.max("order_amount") <= 75000,
        F.countDistinct("city"),
        F.countDistinct("order_status"),
        F.countDistinct("payment_status"),
    ).first()
    assert tuple(facts) == (100001, 103000, 300, "2026-01-01", "2026-03-02", True, True, 7, 3, 2)
    late = orders.select(
        (F.col("updated_at").cast("timestamp_ntz") - F.col("order_date").cast("timestamp_ntz")).alias("d")
    )
    span = late.agg(F.min("d"), F.max("d")).first()
    assert tuple(span) == (dt.timedelta(hours=1), dt.timedelta(hours=48))


def test_sample_inventory_is_consistent(spark):
    warehouses = sample_warehouses(spark)
    assert warehouses.count() == 27 and warehouses.select("city").distinct().count() == 9
    stock = sample_inventory(numbered(spark, 3000))
    joined = stock.join(warehouses, ["warehouse_id", "city"])
    assert joined.count() == 3000
    assert stock.where("available_quantity < 0 or damaged_quantity < 0").count() == 0
    assert stock.where("movement_type <> 'STOCK_DAMAGED' and damaged_quantity > 50").count() == 0
    assert stock.where("movement_type = 'STOCK_DAMAGED' and damaged_quantity > 50").count() > 0
    wrong = "inventory_status <> case when available_quantity <= 0 then 'OUT_OF_STOCK' when available_quantity < 20 then 'LOW_STOCK' else 'IN_STOCK' end"
    assert stock.where(wrong).count() == 0


@pytest.fixture
def replica(spark):
    return JdbcReplica(
        spark, "jdbc:none:", "public.orders", ["id", "v", "updated_at"], ["id"], split_by=("id", 0, 100)
    )


def test_increment_query(replica):
    text = replica.increment_query(dt.datetime(2026, 1, 2, 3, 4, 5, 678900), "o'brien")
    assert text == (
        "(SELECT id, v, updated_at FROM public.orders"
        " WHERE updated_at > TIMESTAMP '2026-01-02 03:04:05.678900'"
        " AND source_system = 'o''brien') AS increment"
    )
    assert "source_system" not in replica.increment_query(dt.datetime(2026, 1, 1), None)


def test_upsert_statement(replica):
    assert replica.upsert_statement("stage_1") == (
        "INSERT INTO public.orders AS r (id, v, updated_at)"
        " SELECT DISTINCT ON (id) id, v, updated_at FROM stage_1 ORDER BY id, updated_at DESC"
        " ON CONFLICT (id) DO UPDATE SET v = EXCLUDED.v, updated_at = EXCLUDED.updated_at"
        " WHERE EXCLUDED.updated_at > r.updated_at"
    )
    assert replica.staging_name("run-1") == "public.orders_stage_run_1"


def test_names_are_checked(spark):
    with pytest.raises(ValueError, match="plain SQL name"):
        JdbcReplica(spark, "jdbc:none:", "orders; drop table x", ["id"], ["id"])


def test_samples_feed_the_operators(spark):
    orders = sample_orders(numbered(spark, 100))
    assert latest_per_key(orders, ["customer_id"]).count() <= 100


def test_csv_keeps_every_text(spark, folder):
    rows = [(1, "  pad  "), (2, ""), (3, None), (4, 'say "hi", ok'), (5, "a,b")]
    write_rows(spark.createDataFrame(rows, "id bigint, note string"), folder, "csv")
    back = read_csv(spark, folder, "id bigint, note string", escape='"', null_value=NULL_TEXT)
    assert sorted(map(tuple, back.collect())) == rows


@pytest.mark.parametrize("text", ["two\nlines", NULL_TEXT])
def test_csv_refuses_what_it_cannot_hold(spark, folder, text):
    with pytest.raises(Exception, match="does not fit into CSV"):
        write_rows(spark.createDataFrame([(1, text)], "id bigint, note string"), folder, "csv")
