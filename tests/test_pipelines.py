import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows_of
from tidemark.operators import initial_replica
from tidemark.plans.pipelines import replicate, sync_in, sync_out, two_way_sync
from tidemark.plans.state import BEGINNING, ControlLog, Watermarks
from tidemark.plans.table import VersionedTable
from tidemark.session import work_folder
from tidemark.sources import TableReplica

SCHEMA = "id bigint, v string, updated_at timestamp_ntz, source_system string, sync_version int"
T = [dt.datetime(2026, 6, 24, h, 0, 0, 123456) for h in range(10)]


def new_table(spark, rows, schema=SCHEMA):
    return VersionedTable.create(spark.createDataFrame(rows, schema), work_folder(spark, "test"))


@pytest.fixture
def state(spark):
    return Watermarks(spark, work_folder(spark, "state"))


def values(df):
    return {r["id"]: r["v"] for r in df.collect()}


def test_watermarks(state):
    assert state.get("p") == BEGINNING
    state.seed("p")
    state.set("p", T[3], "run_1", "SUCCESS")
    state.seed("p")  # does not reset
    state.set("q", T[1], "run_1", "FAILED")
    assert state.get("p") == T[3] and state.get("q") == T[1]
    assert state.rows().count() == 2


def test_watermarks_do_not_depend_on_the_clock(spark, state, monkeypatch):
    back = iter(range(1000, 0, -1))
    monkeypatch.setattr("tidemark.plans.state.now", lambda: T[0] - dt.timedelta(days=1000 - next(back)))
    monkeypatch.setattr("time.time_ns", lambda: next(back))
    for hour in (3, 1, 7, 2):
        state.set("p", T[hour], f"run_{hour}", "SUCCESS")
        assert state.get("p") == T[hour]
    assert state.rows().first()["last_run_id"] == "run_2"


def test_watermark_files_stay_few(spark, state):
    for run in range(100):
        state.set("a/b=c%", T[0] + dt.timedelta(seconds=run), f"run_{run}", "SUCCESS")
    for name in ("", "a/b=c%25", "A/B=C%"):
        state.set(name, T[1], "run", "SUCCESS")
    assert state.get("a/b=c%") == T[0] + dt.timedelta(seconds=99) and state.get("") == T[1]
    assert state.rows().count() == 4
    assert len(state._log().inputFiles()) == 2 + 3


def test_sync_out(spark, state):
    lake = new_table(
        spark,
        [
            (1, "old", T[1], "LAKE", 1),
            (1, "new", T[2], "LAKE", 2),
            (2, "stale", T[1], "LAKE", 1),
            (3, "foreign", T[3], "APP", 1),
            (4, "no time", None, "LAKE", 1),
        ],
    )
    far = new_table(spark, [(2, "later there", T[5], "APP", 1), (5, "untimed there", None, "APP", 1)])
    replica = TableReplica(far, ["id"])
    done = sync_out(lake, replica, state, "out", "LAKE")
    assert (done.status, done.found, done.written, done.watermark) == ("SUCCESS", 3, 2, T[2])
    assert values(replica.rows()) == {1: "new", 2: "later there", 5: "untimed there"}
    again = sync_out(lake, replica, state, "out", "LAKE")
    assert (again.status, again.watermark) == ("NO_DATA", T[2])
    # A row as late as the watermark is never picked up; one microsecond later is.
    lake.append(spark.createDataFrame([(6, "tie", T[2], "LAKE", 1)], SCHEMA))
    assert sync_out(lake, replica, state, "out", "LAKE").status == "NO_DATA"
    just_after = T[2] + dt.timedelta(microseconds=1)
    lake.append(spark.createDataFrame([(7, "after", just_after, "LAKE", 1)], SCHEMA))
    assert sync_out(lake, replica, state, "out", "LAKE").found == 1


class Broken:
    keys = ["id"]

    def increment(self, watermark, origin):
        raise OSError("unreachable")

    def upsert(self, df, run_id):
        raise OSError("unreachable")


def test_a_failed_run_keeps_the_watermark(spark, state):
    lake = new_table(spark, [(1, "a", T[4], "LAKE", 1)])
    state.set("out", T[3], "run_0", "SUCCESS")
    with pytest.raises(OSError):
        sync_out(lake, Broken(), state, "out", "LAKE", run_id="run_1")
    row = state.rows().first()
    assert (row["last_watermark"], row["last_status"], row["last_run_id"]) == (T[3], "FAILED", "run_1")
    with pytest.raises(OSError):
        sync_in(Broken(), lake, state, "in", "APP")
    assert state.get("in") == BEGINNING
    replica = TableReplica(new_table(spark, []), ["id"])
    assert sync_out(lake, replica, state, "out", "LAKE").status == "SUCCESS"


def test_two_ways_without_echo(spark, state):
    lake = new_table(spark, [(1, "lake", T[1], "LAKE", 1), (2, "lake", T[5], "LAKE", 1)])
    far = TableReplica(
        new_table(spark, [(1, "app", T[3], "APP", 2), (2, "app", T[4], "APP", 2), (3, "app", T[1], "APP", 1)]),
        ["id"],
    )
    two_way_sync(lake, far, state, ("out", "in"), ("LAKE", "APP"))
    assert values(lake.as_of()) == values(far.rows()) == {1: "app", 2: "lake", 3: "app"}
    out, back = two_way_sync(lake, far, state, ("out", "in"), ("LAKE", "APP"))
    assert (out.status, back.status) == ("NO_DATA", "NO_DATA")


ORDERS = "id bigint, city string, amount double, updated_at timestamp_ntz"
AT = dt.datetime(2026, 7, 1)


def source_and_target(spark, rows):
    source = VersionedTable.create(
        spark.createDataFrame(rows, ORDERS), work_folder(spark, "source"), committed_at=dt.datetime(2026, 1, 1)
    )
    loaded = dt.datetime(2026, 1, 2)
    target = VersionedTable.create(
        initial_replica(source.as_of(), "id", loaded), work_folder(spark, "target"), committed_at=loaded
    )
    return source, target, ControlLog(spark, work_folder(spark, "control"))


def run(source, target, control):
    return replicate(source, target, control, "orders", "id", at=AT)


def test_replication(spark):
    rows = [(1, "A", 1.0, T[1]), (2, "B", 2.0, T[1]), (2, "B", 2.5, T[2]), (3, "C", 3.0, T[1])]
    source, target, control = source_and_target(spark, rows)
    first = run(source, target, control)
    assert (first.outcome, first.old_version, first.new_version) == ("SKIPPED", 1, 1)
    # Bootstrapping leaves a log row; skipping leaves none.
    assert control.rows().count() == 1
    run(source, target, control)
    assert control.rows().count() == 1 and target.latest_version() == 1

    # Another older copy of key 2 is a new version, but changes no key.
    source.append(spark.createDataFrame([(2, "B", 0.0, T[0])], ORDERS))
    logged = run(source, target, control)
    assert (logged.outcome, logged.applied, logged.changes) == ("LOGGED", 0, {})
    assert control.last_version("orders") == 2 and target.latest_version() == 1

    source.update_where(F.col("id") == 1, {"city": None, "updated_at": T[5]})
    source.delete_matching(spark.createDataFrame([(3,)], "id bigint"), ["id"])
    source.append(spark.createDataFrame([(4, "D", 4.0, T[1])], ORDERS))
    merged = run(source, target, control)
    assert merged.outcome == "MERGED" and merged.applied == 3
    assert merged.changes == {"UPDATE": 1, "DELETE": 1, "INSERT": 1}
    found = {r["id"]: (r["city"], r["source_updated_timestamp"], r["updated_at"]) for r in target.as_of().collect()}
    assert found == {
        1: (None, T[5], AT),
        2: ("B", T[2], dt.datetime(2026, 1, 2)),
        4: ("D", T[1], AT),
    }


def test_a_gained_column_comes_with_the_first_change(spark):
    source, target, control = source_and_target(spark, [(1, "A", 1.0, T[1]), (2, "B", 2.0, T[1])])
    source.add_columns({"coupon": "string"})
    done = run(source, target, control)
    # A column without values alters nothing, so the target gets no new version.
    assert (done.outcome, target.latest_version()) == ("LOGGED", 1)
    source.update_where(F.col("id") == 1, {"coupon": "C10"})
    assert run(source, target, control).outcome == "MERGED"
    assert {r["id"]: r["coupon"] for r in target.as_of().collect()} == {1: "C10", 2: None}


def test_changes_the_target_already_has(spark):
    source, target, control = source_and_target(spark, [(1, "A", 1.0, T[1]), (2, "B", 2.0, T[1])])
    source.update_where(F.col("id") == 1, {"amount": 9.0})
    target.update_where(F.col("id") == 1, {"amount": 9.0})
    done = replicate(source, target, control, "orders", "id", at=AT)
    assert (done.outcome, done.changes) == ("LOGGED", {"UPDATE": 1})


def test_bootstrap_needs_a_loaded_target(spark):
    source, target, control = source_and_target(spark, [(1, "A", 1.0, T[1])])
    empty = VersionedTable.create(target.as_of().limit(0), work_folder(spark, "target"))
    with pytest.raises(ValueError, match="target is empty"):
        run(source, empty, control)
    early = target.as_of().withColumn("updated_at", F.lit("2020-01-01").cast("timestamp_ntz"))
    too_old = VersionedTable.create(early, work_folder(spark, "target"))
    with pytest.raises(ValueError, match="no version had been committed"):
        run(source, too_old, control)
    with pytest.raises(ValueError, match="no versions"):
        run(VersionedTable(spark, work_folder(spark, "none")), target, control)


def test_replicated_target_equals_source(spark):
    rows = [(i, f"c{i % 3}", float(i), T[i % 10]) for i in range(30)]
    source, target, control = source_and_target(spark, rows)
    for step in range(3):
        source.update_where(F.col("id") % 5 == step, {"amount": 100.0 + step})
        source.delete_matching(spark.createDataFrame([(10 + step,)], "id bigint"), ["id"])
        source.append(spark.createDataFrame([(100 + step, "x", 1.0, T[0])], ORDERS))
        run(source, target, control)
        copy = target.as_of().select("id", "city", "amount", F.col("source_updated_timestamp").alias("updated_at"))
        assert rows_of(copy) == rows_of(source.as_of())
