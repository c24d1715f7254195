import datetime as dt
import random
import uuid

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import rows_of
from tidemark.operators import (
    apply_changes,
    apply_corrections,
    change_summary,
    compare_versions,
    duplicate_keys,
    effective_changes,
    latest_per_key,
    priority_per_key,
    raw_diff,
    snapshot_diff,
    version_history,
)

SCHEMA = "k bigint, s string, d int, updated_at timestamp_ntz"
NOON = dt.datetime(2026, 6, 24, 12)


def at(hour):
    return None if hour is None else NOON + dt.timedelta(hours=hour)


keys = st.integers(0, 4)
row = st.tuples(keys, st.sampled_from(["", "a", "b", None]), st.sampled_from([1, 2, None]))
timed = st.tuples(row, st.sampled_from([0, 1, 2])).map(lambda x: (*x[0], at(x[1])))
table = st.lists(timed, max_size=12)
few = settings(
    max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def compare_rows(o, n, nulls):
    """Whether two rows differ, spelled out."""
    for i, is_text in ((1, True), (2, False), (3, False)):
        a, b = o[i], n[i]
        if nulls == "safe":
            differ = a != b
        elif is_text:
            differ = (a or "") != (b or "")
        else:
            differ = a is not None and b is not None and a != b
        if differ:
            return True
    return False


@few
@given(old=table, new=table)
def test_raw_diff_counts_every_pair(spark, old, new):
    for nulls in ("safe", "empty"):
        expected = {}
        for n in new:
            facing = [o for o in old if o[0] == n[0]]
            pairs = sum(compare_rows(o, n, nulls) for o in facing) if facing else 1
            if pairs:
                change = ("UPDATE" if facing else "INSERT", *n)
                expected[change] = expected.get(change, 0) + pairs
        for o in old:
            if all(n[0] != o[0] for n in new):
                change = ("DELETE", o[0], None, None, None)
                expected[change] = expected.get(change, 0) + 1
        found = raw_diff(
            spark.createDataFrame(old, SCHEMA), spark.createDataFrame(new, SCHEMA), "k", nulls=nulls
        )
        assert {tuple(r)[:-1]: r["copies"] for r in found.collect()} == expected


@few
@given(old=table, new=table)
def test_changes_turn_old_into_new(spark, old, new):
    before = spark.createDataFrame(old, SCHEMA)
    after = spark.createDataFrame(new, SCHEMA)
    changes = snapshot_diff(before, after, "k")
    result = apply_changes(latest_per_key(before, ["k"]), changes, "k", source_unique=True)
    assert rows_of(result) == rows_of(latest_per_key(after, ["k"]))
    assert snapshot_diff(after, after, "k").count() == 0


def test_raw_diff_of_a_hot_key_builds_no_pairs(spark):
    """A third of all rows share a key: 400 million pairs, counted in seconds."""
    n = 60000
    key = F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id"))
    old = spark.range(n).select(key.alias("k"), F.col("id").alias("v"))
    new = spark.range(n).select(key.alias("k"), (F.col("id") + 30).alias("v"))
    found = {
        r["change_type"]: (r["n"], r["copies"])
        for r in raw_diff(old, new, "k", nulls="safe")
        .groupBy("change_type")
        .agg(F.count("k").alias("n"), F.sum("copies").alias("copies"))
        .collect()
    }
    # Each of the 20,000 new rows of the hot key equals one old row, but for the last ten.
    pairs = 20000 * 20000 - (20000 - 10)
    assert found == {"UPDATE": (n, pairs + 40000)}


def test_null_modes(spark):
    old = spark.createDataFrame([(1, None, None, at(0)), (2, "a", 1, at(0))], SCHEMA)
    new = spark.createDataFrame([(1, "", 5, at(0)), (2, "a", None, at(0))], SCHEMA)
    changed = {
        nulls: {r["k"] for r in snapshot_diff(old, new, "k", nulls=nulls).collect()}
        for nulls in ("safe", "empty", "plain")
    }
    assert changed == {"safe": {1, 2}, "empty": set(), "plain": set()}
    with pytest.raises(ValueError, match="nulls"):
        snapshot_diff(old, new, "k", nulls="other")


def test_delete_rows_carry_the_key_alone(spark):
    old = spark.createDataFrame([(1, "a", 1, at(0))], SCHEMA)
    gone = snapshot_diff(old, old.limit(0), "k").collect()
    assert [tuple(r) for r in gone] == [("DELETE", 1, None, None, None)]


def test_latest_is_decided_by_tie_breaks(spark):
    rows = [(1, "b", 1, at(1)), (1, "a", 2, at(1)), (1, "c", 0, at(0)), (1, "d", 0, None)]
    for order in (rows, rows[::-1]):
        winner = latest_per_key(spark.createDataFrame(order, SCHEMA).repartition(4), ["k"])
        assert [tuple(r) for r in winner.collect()] == [(1, "a", 2, at(1))]


CORRECTION = "order_id bigint, order_amount double, order_status string, updated_at timestamp_ntz, correction_source string"


@pytest.fixture
def corrections(spark):
    day = dt.datetime(2026, 6, 24)
    rows = [
        (100010, 5200.0, "DELIVERED", day.replace(hour=10), "finance_team"),
        (100010, 5000.0, "SHIPPED", day.replace(hour=9, minute=30), "ops_team"),
        (999997, 3200.0, "PLACED", day.replace(hour=10, minute=15), "ops_team"),
    ]
    return spark.createDataFrame(rows, CORRECTION)


def test_priority_beats_time(spark, corrections):
    best = priority_per_key(corrections, ["order_id"], "correction_source", ["finance_team", "ops_team"])
    assert {r["order_id"]: r["order_amount"] for r in best.collect()} == {100010: 5200.0, 999997: 3200.0}
    other_way = priority_per_key(corrections, ["order_id"], "correction_source", ["ops_team"])
    assert {r["order_id"]: r["order_amount"] for r in other_way.collect()}[100010] == 5000.0


def test_correction_workflow(spark, corrections):
    assert [tuple(r) for r in duplicate_keys(corrections, ["order_id"]).collect()] == [(100010, 2)]
    schema = "order_id bigint, order_amount double, order_status string, updated_at timestamp_ntz"
    held = spark.createDataFrame([(100010, 1.0, "PLACED", NOON), (999999, 2.0, "PLACED", NOON)], schema)
    fraud = spark.createDataFrame([(999997, "fraud_order"), (999999, "test_order")], "order_id bigint, why string")
    result = apply_corrections(
        held, corrections, fraud, "order_id", "correction_source", ["finance_team", "ops_team"]
    )
    assert [(r["order_id"], r["order_amount"]) for r in result.collect()] == [(100010, 5200.0)]


def test_effective_changes(spark):
    schema = "change_type string, k bigint, s string"
    changes = spark.createDataFrame(
        [
            ("DELETE", 1, None),
            ("DELETE", 9, None),
            ("INSERT", 2, "same"),
            ("INSERT", 3, "other"),
            ("UPDATE", 8, "missing"),
            ("UPDATE", 4, None),
        ],
        schema,
    )
    target = spark.createDataFrame([(1, "x"), (2, "same"), (3, "x"), (4, None)], "k bigint, s string")
    kept = effective_changes(changes, target, "k", ["s"])
    assert sorted((r["change_type"], r["k"]) for r in kept.collect()) == [
        ("DELETE", 1),
        ("INSERT", 3),
        ("UPDATE", 8),
    ]
    result = apply_changes(target, changes, "k")
    assert rows_of(result) == rows_of_sorted([(2, "same"), (3, "other"), (4, None), (8, "missing")])


def rows_of_sorted(rows):
    return sorted(rows, key=repr)


def test_change_summary(spark):
    old = spark.createDataFrame([(1, "a", 1, at(0)), (2, "a", 1, at(0))], SCHEMA)
    new = spark.createDataFrame([(2, "b", 1, at(0)), (3, "a", 1, at(0))], SCHEMA)
    summary = change_summary(snapshot_diff(old, new, "k"))
    assert {r["change_type"]: r["count"] for r in summary.collect()} == {"DELETE": 1, "UPDATE": 1, "INSERT": 1}


def test_version_history(spark):
    rows = [(1, "a", 1), (2, "a", 1), (1, "b", 2), (2, "b", 2), (1, "c", 3), (None, "x", 2)]
    versions = spark.createDataFrame(rows, "k bigint, s string, version bigint")
    history = {
        (r["k"], r["version"]): (r["is_active"], r["is_deleted"])
        for r in version_history(versions, "k").collect()
    }
    assert history == {
        (1, 1): (False, False),
        (1, 2): (False, False),
        (1, 3): (True, False),
        (2, 1): (False, False),
        (2, 2): (False, True),
        (None, 2): (False, True),
    }


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedup_limits_groups_before_the_shuffle(spark):
    frame = spark.range(100).selectExpr("id % 7 as k", "id as updated_at")
    plan = plan_of(latest_per_key(frame, ["k"]))
    exchange = plan.index("Exchange hashpartitioning")
    assert plan.index("Partial") > exchange and "Final" in plan[:exchange]


def test_diff_shuffles_each_side_once(spark, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    old = spark.range(100).selectExpr("id as k", "id as v", "id as updated_at")
    new = spark.range(100).selectExpr("id + 5 as k", "id as v", "id as updated_at")
    assert plan_of(snapshot_diff(old, new, "k")).count("Exchange hashpartitioning") == 2


def test_effective_changes_once_a_key_and_with_columns_the_target_lacks(spark):
    changes = spark.createDataFrame([(1, "x", "n", "UPDATE"), (2, "y", None, "UPDATE"), (3, None, None, "DELETE")], "id long, v string, w string, change_type string")
    target = spark.createDataFrame([(1, "a"), (1, "x"), (1, "b"), (2, "y"), (3, "z"), (3, "z")], "id long, v string")
    found = effective_changes(changes, target, "id", ["v", "w"])
    assert sorted(r["id"] for r in found.collect()) == [1, 3]


def test_raw_diff_of_many_columns_that_may_be_null(spark):
    names = [f"c{i}" for i in range(70)]
    rng = random.Random(3)

    def rows(n):
        return [(rng.randrange(6) or None, *[rng.choice([0, 0, 0, None]) if i % 7 == k % 7 else 0 for i in range(69)], rng.choice([0, 1, None])) for k in range(n)]

    old, new = rows(40), rows(40)
    expected = {}
    for n in new:
        facing = [o for o in old if n[0] is not None and o[0] == n[0]]
        pairs = sum(any(a is not None and b is not None and a != b for a, b in zip(o[1:], n[1:])) for o in facing) if facing else 1
        if pairs:
            change = ("UPDATE" if facing else "INSERT", *n)
            expected[change] = expected.get(change, 0) + pairs
    for o in old:
        if o[0] is None or all(n[0] != o[0] for n in new):
            change = ("DELETE", o[0], *[None] * 70)
            expected[change] = expected.get(change, 0) + 1
    schema = "k int, " + ", ".join(f"{c} int" for c in names)
    found = raw_diff(spark.createDataFrame(old, schema), spark.createDataFrame(new, schema), "k").collect()
    assert {tuple(r)[:-1]: r["copies"] for r in found} == expected and len(found) == len(expected)


def test_raw_diff_reads_each_side_once_and_exchanges_six_times(spark, conf, folder):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    spark.range(100).selectExpr("id as k", "if(id % 9 = 0, null, id) as v", "cast(id as string) as s").write.parquet(f"{folder}/old")
    spark.range(100).selectExpr("id + 5 as k", "id as v", "cast(id as string) as s").write.parquet(f"{folder}/new")
    assert jobs_of(spark, lambda: raw_diff(spark.read.parquet(f"{folder}/old"), spark.read.parquet(f"{folder}/new"), "k")) <= 2
    found = raw_diff(spark.read.parquet(f"{folder}/old"), spark.read.parquet(f"{folder}/new"), "k")
    found.collect()
    plan = plan_of(found).split("== Initial Plan ==")[0]
    fresh = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line and "Reused" not in line]
    assert len(fresh) <= 6 and found.where("change_type = 'INSERT'").count() == 5


def test_raw_diff_compares_some_columns(spark):
    old = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, None, 3), (None, "x", 1)], "k int, s string, d int")
    new = spark.createDataFrame([(1, "a", 7), (1, "a", 8), (2, "", 4), (None, "x", 1), (None, "x", 1), (3, None, 0)], "k int, s string, d int")
    found = raw_diff(old, new, "k", compare=["s"])
    assert rows_of(found) == rows_of_sorted(
        [("UPDATE", 1, "a", 7, 1), ("UPDATE", 1, "a", 8, 1), ("INSERT", None, "x", 1, 2), ("INSERT", 3, None, 0, 1), ("DELETE", None, None, None, 1)]
    )


def test_diffs_fail_on_keys_that_repeat_without_dedup(spark):
    once = spark.createDataFrame([(1, "a"), (2, "b")], "k int, s string")
    twice = spark.createDataFrame([(1, "a"), (1, "b")], "k int, s string")
    for old, new in ((once, twice), (twice, once)):
        with pytest.raises(Exception, match="k repeats: 1"):
            snapshot_diff(old, new, "k", dedup_by=None).collect()
        with pytest.raises(Exception, match="k repeats: 1"):
            # Not even a count lets the check go.
            snapshot_diff(old, new, "k", dedup_by=None).count()
        with pytest.raises(Exception, match="k repeats: 1"):
            compare_versions(old, new, "k", "s", dedup_by=None).collect()
    assert snapshot_diff(once, once, "k", dedup_by=None).count() == 0


def test_null_keys_stay_out_of_the_join(spark, conf, folder):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    spark.range(10_010).selectExpr("if(id < 10000, null, id) as k", "id as v").write.parquet(f"{folder}/rows")
    rows = spark.read.parquet(f"{folder}/rows")
    found = snapshot_diff(rows, rows, "k", dedup_by=None)
    assert {r["change_type"]: r["count"] for r in found.groupBy("change_type").count().collect()} == {"DELETE": 10_000, "INSERT": 10_000}
    plan = plan_of(found)
    assert plan.count("Exchange hashpartitioning") == 2
    joined, *alone = plan.split("SortMergeJoin")[1].split("PushedFilters: ")[1:]
    assert joined.startswith("[IsNotNull(k)]") and [a[:11] for a in alone] == ["[IsNotNull(", "[IsNull(k)]", "[IsNull(k)]"]
    assert compare_versions(rows, rows, "k", "v", dedup_by=None).count() == 0


def jobs_of(spark, work):
    group = f"count-{uuid.uuid4().hex}"
    spark.sparkContext.setJobGroup(group, group)
    try:
        work()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_raw_diff_without_nulls_exchanges_rows_twice(spark, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    old = spark.range(3000).selectExpr("id div 2 as k", "id as v", "cast(id as string) as s")
    new = spark.range(3000).selectExpr("id div 2 + 5 as k", "id + id % 3 as v", "cast(id as string) as s")
    found = raw_diff(old, new, "k")
    kinds = {r["change_type"]: (r["n"], r["copies"]) for r in found.groupBy("change_type").agg(F.count("k").alias("n"), F.sum("copies").alias("copies")).collect()}
    # Two old rows face two new ones under each of 1,495 keys; none is equal, as s differs.
    assert kinds == {"UPDATE": (2990, 5980), "INSERT": (10, 10), "DELETE": (5, 10)}
    found.collect()
    # Nothing reaches the steps that compare across patterns of NULLs.
    assert "Window" not in plan_of(found).split("== Initial Plan ==")[0]
