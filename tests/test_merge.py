import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import SparkRuntimeException
from pyspark.sql import functions as F

from tests.conftest import rows_of
from tidemark.operators import (
    delete,
    delete_matching,
    insert,
    insert_if_absent,
    merge_into,
    update,
    update_where,
    upsert,
)
from tidemark.operators.sizes import measured

T0, T1, T2 = (dt.datetime(2026, 6, 24, h) for h in (9, 10, 11))
SCHEMA = "k bigint, v string, at timestamp_ntz, n int"


@pytest.fixture
def target(spark):
    rows = [(1, "a", T1, 1), (2, "b", T1, 1), (3, "c", None, 1), (None, "none", T1, 1)]
    return spark.createDataFrame(rows, SCHEMA)


def test_update_where_sees_old_values_and_ignores_unknown(target):
    changed = update_where(target, F.col("at") == F.lit(T1), {"v": F.concat("v", F.lit("!")), "n": F.col("n") + 1})
    assert rows_of(changed.select("k", "v", "n")) == rows_of_literal(
        [(1, "a!", 2), (2, "b!", 2), (3, "c", 1), (None, "none!", 2)]
    )


def rows_of_literal(rows):
    return sorted(rows, key=repr)


def test_delete_matching_keeps_null_keys(spark, target):
    keys = spark.createDataFrame([(1,), (1,), (None,), (9,)], "k bigint")
    assert rows_of(delete_matching(target, keys, ["k"]).select("k")) == rows_of_literal(
        [(2,), (3,), (None,)]
    )


def test_upsert_null_keys_and_order_of_arms(spark, target):
    source = spark.createDataFrame(
        [(1, "new", T2, 2), (None, "lost", T2, 2), (7, "add", T2, 2)], SCHEMA
    )
    merged = upsert(target, source, ["k"])
    assert rows_of(merged.select("k", "v")) == rows_of_literal(
        [(1, "new"), (2, "b"), (3, "c"), (None, "none"), (None, "lost"), (7, "add")]
    )


def test_first_clause_wins(spark, target):
    source = spark.createDataFrame([(1, "x", T2, 2), (2, "y", T0, 2)], SCHEMA)
    merged = merge_into(
        target,
        source,
        ["k"],
        matched=[
            update({"v": "first"}, when=F.col("s.at") > F.col("t.at")),
            delete(),
        ],
    )
    assert rows_of(merged.select("k", "v")) == rows_of_literal(
        [(1, "first"), (3, "c"), (None, "none")]
    )


@pytest.mark.parametrize("source_time", [T0, T1, T2, None])
def test_newer_only(spark, target, source_time):
    source = spark.createDataFrame([(1, "new", source_time, 2)], SCHEMA)
    merged = upsert(target, source, ["k"], newer_than="at")
    expected = "new" if source_time == T2 else "a"
    assert merged.where("k = 1").first()["v"] == expected


def test_missing_target_time_is_never_newer(spark, target):
    source = spark.createDataFrame([(3, "new", T2, 2)], SCHEMA)
    assert upsert(target, source, ["k"], newer_than="at").where("k = 3").first()["v"] == "c"


@pytest.mark.parametrize("version, wins", [(0, False), (1, False), (2, True)])
def test_equal_times_go_to_the_higher_version(spark, target, version, wins):
    source = spark.createDataFrame([(1, "new", T1, version)], SCHEMA)
    newer = F.col("s.at") > F.col("t.at")
    higher = (F.col("s.at") == F.col("t.at")) & (F.col("s.n") > F.col("t.n"))
    merged = merge_into(target, source, ["k"], [update(when=newer | higher)])
    assert (merged.where("k = 1").first()["v"] == "new") is wins


def test_insert_of_listed_columns_leaves_others_null(spark, target):
    source = spark.createDataFrame([(1, "x", T2, 5), (8, "y", T2, 5)], SCHEMA)
    columns = ["k", "v"]
    merged = merge_into(target, source, ["k"], [update(["v"])], [insert(columns)])
    kept = {r["k"]: (r["v"], r["at"], r["n"]) for r in merged.where("k in (1, 8)").collect()}
    assert kept == {1: ("x", T1, 1), 8: ("y", None, None)}


def test_two_source_rows_for_one_target_row_fail(spark, target):
    source = spark.createDataFrame([(1, "x", T2, 1), (1, "y", T2, 1)], SCHEMA)
    with pytest.raises(SparkRuntimeException, match="more than one source row"):
        upsert(target, source, ["k"]).collect()
    # The check also holds when no column of the source is asked for.
    with pytest.raises(SparkRuntimeException, match="more than one source row"):
        upsert(target, source, ["k"]).count()


def test_repeated_source_rows_without_a_match_all_go_in(spark, target):
    source = spark.createDataFrame([(9, "x", T2, 1), (9, "y", T2, 1), (9, "z", T2, 1)], SCHEMA)
    assert upsert(target, source, ["k"]).where("k = 9").count() == 3


def test_empty_sides(spark, target):
    empty = spark.createDataFrame([], SCHEMA)
    assert rows_of(upsert(target, empty, ["k"])) == rows_of(target)
    assert rows_of(upsert(empty, target, ["k"])) == rows_of(target)


def test_merge_is_idempotent(spark, target):
    source = spark.createDataFrame([(1, "x", T2, 1), (9, "y", T2, 1)], SCHEMA)
    once = upsert(target, source, ["k"])
    assert rows_of(upsert(once, source, ["k"])) == rows_of(once)


def test_insert_if_absent(spark, target):
    source = spark.createDataFrame([(1, "x", T2, 1), (9, "b", T2, 1), (9, "a", T2, 1)], SCHEMA)
    merged = insert_if_absent(target, source, ["k"])
    assert merged.where("k = 1").first()["v"] == "a"
    assert [r["v"] for r in merged.where("k = 9").collect()] == ["a"]


def merged_by_hand(target, source):
    """Delete on 'd', update if newer, insert unless 'x'; NULL keys match nothing."""
    result = []
    for t in target:
        match = next((s for s in source if s[0] is not None and s[0] == t[0]), None)
        if match is None:
            result.append(t)
        elif match[1] == "d":
            continue
        elif match[2] is not None and t[2] is not None and match[2] > t[2]:
            result.append((t[0], match[1], match[2], t[3]))
        else:
            result.append(t)
    held = {t[0] for t in target if t[0] is not None}
    for s in source:
        if s[0] not in held and s[1] != "x" and s[1] is not None:
            result.append((s[0], s[1], s[2], None))
    return sorted(result, key=repr)


times = st.sampled_from([T0, T1, None])
target_rows = st.lists(
    st.tuples(st.sampled_from([1, 2, 3, None]), st.sampled_from(["a", "b"]), times, st.just(1)), max_size=8
)
source_rows = st.lists(
    st.tuples(
        st.sampled_from([1, 2, 3, 4, 5, None]), st.sampled_from(["d", "x", "n", None]), times, st.just(2)
    ),
    max_size=8,
)


@settings(
    max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(target=target_rows, source=source_rows)
def test_merge_equals_a_merge_by_hand(spark, target, source):
    single = list({s[0]: s for s in source if s[0] is not None}.values())
    single += [s for s in source if s[0] is None]
    expected = merged_by_hand(target, single)
    for unique in (True, False):
        merged = merge_into(
            spark.createDataFrame(target, SCHEMA),
            spark.createDataFrame(single, SCHEMA),
            ["k"],
            matched=[
                delete(F.col("s.v") == "d"),
                update(["v", "at"], when=F.col("s.at") > F.col("t.at")),
            ],
            not_matched=[insert(["k", "v", "at"], when=F.col("s.v") != "x")],
            source_unique=unique,
        )
        assert rows_of(merged) == expected


def test_lab_merge_rows(spark):
    """One known and one unknown order."""
    schema = "order_id bigint, order_amount double, order_status string"
    held = spark.createDataFrame([(100001, 1.0, "PLACED"), (100002, 2.0, "PLACED")], schema)
    incoming = spark.createDataFrame([(100002, 99999.0, "DELIVERED"), (999999, 4500.0, "PLACED")], schema)
    assert rows_of(upsert(held, incoming, ["order_id"])) == [
        (100001, 1.0, "PLACED"),
        (100002, 99999.0, "DELIVERED"),
        (999999, 4500.0, "PLACED"),
    ]


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_small_source_never_shuffles_the_target(spark, folder):
    spark.range(1000).selectExpr("id as k", "cast(id as string) as v").write.parquet(folder)
    target = spark.read.parquet(folder)
    source = spark.createDataFrame([(1, "x"), (5000, "y")], "k bigint, v string").persist()
    source.count()  # from here on its size is known
    merged = upsert(target, source, ["k"], source_unique=True)
    plan = merged._jdf.queryExecution().executedPlan().toString()
    updated, inserted = plan[: plan.index("LeftAnti")], plan[plan.index("LeftAnti") :]
    assert "BroadcastHashJoin" in updated and "SortMergeJoin" not in updated
    # The keys of the target meet the broadcast source before they are shuffled.
    assert inserted.index("Exchange hashpartitioning") < inserted.index("LeftSemi, BuildRight")
    assert merged.count() == 1001
    source.unpersist()


def test_hot_target_key_is_split(spark, conf):
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="10KB",
        spark__sql__adaptive__coalescePartitions__enabled="false",
    )
    ids = spark.range(0, 60000, numPartitions=8)
    key = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id"))
    target = ids.select(key.alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    source = spark.range(20000).selectExpr("id as k", "concat('new', id) as v")
    for unique in (True, False):
        merged = upsert(target, source, ["k"], source_unique=unique)
        report = merged.agg(F.count("k").alias("rows"), F.sum(F.length("v")).alias("width"))
        assert "SortMergeJoin(skew=true)" in final_plan(report)
        # Every third id turned into key 7; keys 0, 3, 6, ... below 20000 are new.
        assert report.first()["rows"] == 60000 + 6667


def test_broadcast_only_within_a_bound_in_bytes(spark, conf):
    dim = measured(spark.range(5000).selectExpr("id", "sha2(cast(id as string), 256) as name"))
    fact = spark.range(10)
    assert "BroadcastHashJoin" in final_plan(fact.join(dim, "id", "left"))
    # The file of the dimension is larger than this, and only it could be broadcast here.
    conf(spark__sql__autoBroadcastJoinThreshold="10KB")
    assert "BroadcastHashJoin" not in fact.join(dim, "id", "left")._jdf.queryExecution().executedPlan().toString()
