import datetime as dt
import os
import uuid

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows_of
from tidemark.operators import insert, snapshot_diff, update
from tidemark.operators.layout import Layout, batch_of
from tidemark.plans.table import VersionedTable

BY_MONTH = Layout(month_of="day")
DAY_1, DAY_2 = dt.datetime(2026, 1, 1), dt.datetime(2026, 2, 1)
SCHEMA = "k bigint, day date, city string, amount double"


@pytest.fixture
def rows(spark):
    data = [
        (i, dt.date(2026, 1 + i % 4, 1 + i), ["A", "B b", "C/d=%+"][i % 3], i * 1.5) for i in range(20)
    ]
    return spark.createDataFrame(data, SCHEMA)


@pytest.fixture
def table(rows, folder):
    return VersionedTable.create(rows, folder, BY_MONTH, DAY_1)


def folders(table, version=None):
    """The folders of a version: commit, batch, partition folder."""
    return {(r["write"], r["batch"], r["folder"]) for r in table._folders(table._state(version)).collect()}


def test_versions_do_not_change(table, rows):
    before = rows_of(table.as_of(1))
    table.update_where(F.col("k") < 5, {"city": "Z"}, DAY_2)
    table.append(rows.limit(3))
    table.delete_matching(rows.where("k > 10"), ["k"])
    table.overwrite(rows.limit(1))
    assert rows_of(table.as_of(1)) == before == rows_of(rows)
    assert table.as_of().count() == 1
    assert [r["operation"] for r in table.commits().orderBy("version").collect()] == [
        "create",
        "update",
        "append",
        "delete",
        "overwrite",
    ]


def test_as_of_time(table, rows):
    table.overwrite(rows.limit(1), DAY_2)
    assert table.as_of(timestamp=dt.datetime(2026, 1, 15)).count() == 20
    assert table.as_of(timestamp=DAY_2).count() == 1
    with pytest.raises(ValueError, match="no version"):
        table.as_of(timestamp=dt.datetime(2025, 12, 31))
    with pytest.raises(ValueError, match="never committed"):
        table.as_of(version=7)


def test_commit_times_do_not_go_back(table, rows):
    table.overwrite(rows, dt.datetime(2100, 1, 1))
    table.append(rows.limit(1))  # the clock is behind: counts as made at the same time
    assert table.latest_version() == 3
    assert table.version_at(dt.datetime(2100, 1, 1)) == 3
    with pytest.raises(ValueError, match="committed later"):
        table.append(rows, DAY_2)
    with pytest.raises(ValueError, match="already holds a table"):
        VersionedTable.create(rows, table.root)


def test_version_is_no_column_name(rows, folder):
    with pytest.raises(ValueError, match="taken by the table"):
        VersionedTable.create(rows.withColumn("version", F.lit(1)), folder)


def test_month_reads_need_a_month_layout(rows, folder):
    table = VersionedTable.create(rows, folder)
    with pytest.raises(ValueError, match="by month"):
        table.as_of(months=(dt.date(2026, 1, 1), dt.date(2026, 2, 1)))


def test_a_table_without_versions(spark, folder):
    table = VersionedTable(spark, folder)
    assert not table.exists()
    with pytest.raises(ValueError, match="no versions"):
        table.latest_version()


def test_data_of_a_commit_that_died_is_not_read(spark, table, rows):
    rows.withColumn("day_month", F.lit(999)).write.partitionBy("day_month").parquet(f"{table.root}/data/commit_id=died/commit_batch=0")
    assert table.latest_version() == 1 and table.as_of().count() == 20
    table.append_in_batches(rows.limit(4), batch_of("k", 2), 2)
    assert table.as_of().count() == 24


def test_a_merge_rewrites_only_touched_folders(spark, table):
    source = spark.createDataFrame(
        [(0, dt.date(2026, 1, 1), "new", 0.0), (50, dt.date(2026, 3, 1), "added", 0.0)], SCHEMA
    )
    before = folders(table)
    table.merge(source, ["k"], [update()], [insert()])
    after = folders(table)
    # January was rewritten, March got one more file, the rest is shared.
    assert {f for *_, f in before - after} == {"day_month=672"}
    assert {f for *_, f in after - before} == {"day_month=672", "day_month=674"}
    assert table.as_of().count() == 21
    assert {r["city"] for r in table.as_of().where("k in (0, 50)").collect()} == {"new", "added"}


def test_a_merge_may_move_rows_to_another_folder(spark, table):
    source = spark.createDataFrame([(0, dt.date(2026, 4, 9), "moved", 0.0)], SCHEMA)
    table.merge(source, ["k"], [update()])
    assert [r["day"] for r in table.as_of().where("k = 0").collect()] == [dt.date(2026, 4, 9)]
    assert table.as_of().count() == 20
    table.update_where(F.col("k") == 1, {"day": dt.date(2030, 1, 1)})
    assert table.as_of(months=(dt.date(2030, 1, 1), dt.date(2030, 2, 1))).count() == 1
    assert table.as_of().count() == 20


def test_changed_between_gives_the_same_diff(spark, table, rows):
    source = spark.createDataFrame([(3, dt.date(2026, 1, 1), "new", 0.0), (60, dt.date(2026, 1, 2), "x", 1.0)], SCHEMA)
    table.append(rows.where("k = 7").withColumn("amount", F.lit(99.0)))
    table.merge(source, ["k"], [update()], [insert()])
    table.delete_matching(rows.where("k in (7, 8)"), ["k"])
    for old, new in [(1, 2), (2, 3), (3, 4), (1, 4), (4, 1)]:
        whole = snapshot_diff(table.as_of(old), table.as_of(new), "k", dedup_by="amount")
        cut = snapshot_diff(*table.changed_between(old, new, ["k"]), "k", dedup_by="amount")
        assert rows_of(cut) == rows_of(whole)


def test_month_reads_prune_folders(table):
    january = table.as_of(months=(dt.date(2026, 1, 1), dt.date(2026, 2, 1)))
    plan = january._jdf.queryExecution().executedPlan().toString()
    assert "day_month" in plan[plan.index("PartitionFilters") :]
    assert january.count() == 5


def test_overwrite_partitions_loses_the_rest_of_a_partition(table, rows):
    two = rows.where("k in (0, 4)").withColumn("city", F.lit("only two"))
    table.overwrite_partitions(two)
    counts = {r["day_month"]: r["count"] for r in table.as_of(with_layout=True).groupBy("day_month").count().collect()}
    assert counts == {672: 2, 673: 5, 674: 5, 675: 5}


def test_odd_folder_names(spark, rows, folder):
    table = VersionedTable.create(rows, folder, Layout(identity=("city",), bucket=("k", 2)))
    assert rows_of(table.as_of()) == rows_of(rows)
    table.delete_matching(rows.where("city = 'C/d=%+'"), ["k"])
    assert rows_of(table.as_of()) == rows_of(rows.where("city <> 'C/d=%+'"))
    table.append(rows.withColumn("city", F.lit(None).cast("string")).limit(2))
    table.update_where(F.col("city").isNull(), {"amount": -1.0})
    assert table.as_of().where("city is null and amount = -1").count() == 2


def test_columns_and_layout_evolve(spark, rows, folder):
    table = VersionedTable.create(rows, folder)
    table.add_columns({"coupon": "string", "k": "bigint"})
    assert table.as_of().columns == [*rows.columns, "coupon"]
    table.evolve_layout(BY_MONTH)
    table.append(rows.withColumn("coupon", F.lit("C10")))
    assert table.as_of().where("coupon = 'C10'").count() == 20
    assert table.as_of(1).columns == rows.columns
    assert table.as_of(months=(dt.date(2026, 1, 1), dt.date(2026, 2, 1))).count() == 10
    with pytest.raises(ValueError, match="another layout"):
        table.overwrite_partitions(rows)
    table.delete_matching(rows.where("k = 0"), ["k"])
    assert table.as_of().count() == 38
    # The unpartitioned file was touched, so its rows now lie in month folders.
    assert all("day_month" in folder for *_, folder in folders(table))
    with pytest.raises(ValueError, match="no columns"):
        table.append(rows.withColumn("unknown", F.lit(1)))


def test_an_update_after_a_new_layout_gathers_its_rows(spark, folder):
    days = spark.range(0, 400, numPartitions=8).selectExpr(
        "id as k", "date_add(date'2026-01-01', cast(id % 100 as int)) as day", "'A' as city"
    )
    days.write.parquet(f"{folder}/many")
    table = VersionedTable.create(spark.read.parquet(f"{folder}/many"), f"{folder}/table")
    table.evolve_layout(BY_MONTH)
    table.update_where(F.col("k") % 2 == 0, {"city": "B"})
    assert table.files().count() == 4
    assert table.as_of().where("city = 'B'").count() == 200
    table.update_where(F.col("k") % 2 == 1, {"city": "C"})
    assert {r["city"]: r["count"] for r in table.as_of().groupBy("city").count().collect()} == {"B": 200, "C": 200}


def test_compaction_keeps_rows_and_reduces_files(table, rows):
    table.append_in_batches(rows, batch_of("k", 5), 5)
    before, files = rows_of(table.as_of()), table.files().count()
    assert table.compact() is not None
    assert rows_of(table.as_of()) == before
    assert table.files().count() == 4 < files
    assert table.compact() is None
    stats = {r["day_month"]: (r["file_count"], r["records"]) for r in table.file_stats().collect()}
    assert stats == {m: (1, 10) for m in (672, 673, 674, 675)}


def test_restore_and_recover(table, rows):
    table.delete_matching(rows.where("k = 1"), ["k"])
    table.restore_rows(1, F.col("k") <= 1)
    assert table.as_of().where("k <= 1").count() == 3
    table.update_where(F.col("k") == 5, {"city": "bad"})
    table.delete_matching(rows.where("k = 6"), ["k"])
    table.recover(1, F.col("k").isin(5, 6), ["k"])
    assert {r["city"] for r in table.as_of().where("k in (5, 6)").collect()} == {"C/d=%+"}
    table.restore_rows(1, F.col("k").isin(5, 6), only_missing=["k"])
    assert table.as_of().where("k in (5, 6)").count() == 2


def test_versions(table, rows):
    table.overwrite(rows.limit(2))
    counts = {r["version"]: r["count"] for r in table.versions().groupBy("version").count().collect()}
    assert counts == {1: 20, 2: 2}


def test_empty_content(table, rows):
    table.delete_matching(rows, ["k"])
    assert table.as_of().count() == 0
    table.append(rows.limit(2))
    assert table.as_of().count() == 2


def test_batches_without_rows_and_out_of_range(spark, folder):
    table = VersionedTable.create(spark.createDataFrame([(0, 0)], "id bigint, b int"), folder)
    table.append_in_batches(spark.createDataFrame([(1, 0), (2, 7), (3, 7)], "id bigint, b int"), F.col("b"), 10)
    assert sorted(r["id"] for r in table.as_of().collect()) == [0, 1, 2, 3]
    assert table.latest_version() == 11
    for bad in (10, -1, None):
        with pytest.raises(Exception, match="no such batch"):
            table.append_in_batches(spark.createDataFrame([(9, bad)], "id bigint, b int"), F.col("b"), 10)
    assert table.as_of().count() == 4


def test_a_second_writer_is_refused(spark, folder):
    table = VersionedTable.create(spark.createDataFrame([(1,)], "id bigint"), folder)
    state = table._state()
    table.append(spark.createDataFrame([(2,)], "id bigint"))
    with pytest.raises(RuntimeError, match="another writer"):
        table._commit(state, spark.createDataFrame([(3,)], "id bigint"), "append", state.layout, None)
    assert sorted(r["id"] for r in table.as_of().collect()) == [1, 2]


def test_merge_leaves_the_callers_cache(spark, folder):
    table = VersionedTable.create(spark.createDataFrame([(1, "a")], "id bigint, v string"), folder)
    source = spark.createDataFrame([(1, "b")], "id bigint, v string").persist()
    source.count()
    table.merge(source, ["id"], matched=[update()])
    assert source.storageLevel.useMemory
    source.unpersist()


def jobs_of(spark, work):
    """How many Spark jobs some work starts."""
    group = f"count-{uuid.uuid4().hex}"
    spark.sparkContext.setJobGroup(group, group)
    try:
        work()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def ids(table):
    return sorted(r["id"] for r in table.as_of().collect())


def test_overlapping_writers_lose_no_row(spark, folder, monkeypatch):
    def one(i):
        return spark.createDataFrame([(i,)], "id bigint")

    first = VersionedTable.create(one(1), folder)
    second = VersionedTable(spark, folder)
    written = first._written

    def overtaken(*args):
        # The other writer commits after this one's data was written, before its log entry.
        second.append(one(20))
        return written(*args)

    monkeypatch.setattr(first, "_written", overtaken)
    with pytest.raises(RuntimeError, match="another writer"):
        first.append(one(10))
    assert ids(second) == [1, 20]
    monkeypatch.undo()
    first.append(one(10))
    assert ids(first) == [1, 10, 20]


def test_an_entry_without_rows_is_taken_over_only_if_asked(spark, folder):
    table = VersionedTable.create(spark.createDataFrame([(1,)], "id bigint"), folder)
    # As a writer leaves it that dies while it publishes.
    spark.createDataFrame([], "kind string").write.parquet(f"{folder}/log/entry=2")
    assert ids(table) == [1]
    with pytest.raises(RuntimeError, match="another writer"):
        table.append(spark.createDataFrame([(2,)], "id bigint"))
    VersionedTable(spark, folder, take_over=True).append(spark.createDataFrame([(2,)], "id bigint"))
    assert ids(table) == [1, 2] and table.latest_version() == 2
    # What holds a version is never replaced.
    late = VersionedTable(spark, folder, take_over=True)
    with pytest.raises(RuntimeError, match="another writer"):
        late._publish(2, [], late._folders(late._state()))


def paths_of(df):
    return {p.split("/data/")[1].split("/")[2] for p in df.inputFiles()}


def test_month_reads_list_the_folders_of_their_months_only(spark, table, rows):
    months = (dt.date(2026, 2, 1), dt.date(2026, 4, 1))
    table.append(rows.limit(8))
    assert paths_of(table.as_of()) == {f"day_month={m}" for m in (672, 673, 674, 675)}
    found = table.as_of(months=months)
    assert paths_of(found) == {"day_month=673", "day_month=674"}
    assert rows_of(found) == rows_of(rows.union(rows.limit(8)).where("day >= '2026-02-01' and day < '2026-04-01'"))
    # Folders of another layout may hold any month.
    table.evolve_layout(Layout(identity=("city",)))
    table.append(rows.limit(4))
    table.evolve_layout(BY_MONTH)
    assert {p.split("=")[0] for p in paths_of(table.as_of(months=months))} == {"day_month", "city_part"}
    assert table.as_of(months=months).count() == found.count() + rows.limit(4).where("day >= '2026-02-01' and day < '2026-04-01'").count()


def test_reading_takes_as_many_jobs_for_any_number_of_versions(spark, folder, rows):
    few = VersionedTable.create(rows.limit(2), f"{folder}/few")
    few.append_in_batches(rows, batch_of("k", 2), 2)
    many = VersionedTable.create(rows.limit(2), f"{folder}/many")
    many.append_in_batches(rows, batch_of("k", 29), 29)
    assert (few.latest_version(), many.latest_version()) == (3, 30)
    for read in (lambda t: t.versions().count(), lambda t: t.as_of().count(), lambda t: t.append(rows.limit(1))):
        assert jobs_of(spark, lambda: read(few)) == jobs_of(spark, lambda: read(many))


def test_versions_equal_each_version_read_alone(spark, table, rows):
    table.append_in_batches(rows.limit(6), batch_of("k", 3), 3)
    table.add_columns({"coupon": "string"})
    table.delete_matching(rows.where("k in (2, 5)"), ["k"])
    table.append(rows.limit(2).withColumn("coupon", F.lit("C")))
    table.compact()
    table.evolve_layout(Layout(identity=("city",)))
    table.update_where(F.col("k") == 7, {"amount": -1.0})
    table.overwrite(rows.limit(3))
    together = table.versions()
    assert together.columns == [*rows.columns, "coupon", "version"]
    for n in range(1, table.latest_version() + 1):
        alone = table.as_of(n)
        assert rows_of(together.where(F.col("version") == n).select(*alone.columns)) == rows_of(alone)
    # Each file is scanned once, whatever the number of versions that share it.
    files = together.inputFiles()
    assert len([f for f in files if "/data/" in f]) == len({f for f in files if "/data/" in f})


def test_compaction_leaves_large_files_alone(spark, folder, conf):
    def rows(n, start=0):
        return spark.range(start, start + n, numPartitions=1).selectExpr("id as k", "date'2026-01-05' as day", "sha2(cast(id as string), 256) as v")

    table = VersionedTable.create(rows(3000), folder, BY_MONTH)
    for i in range(4):
        table.append(rows(20, 10_000 + 20 * i))
    table.append(rows(5, 20_000).withColumn("day", F.lit("2026-02-05").cast("date")))
    before, files = rows_of(table.as_of()), {r["file_path"]: r["file_size_in_bytes"] for r in table.files().collect()}
    large = {p for p, size in files.items() if size > 50_000}
    assert len(files) == 6 and len(large) == 1
    conf(spark__sql__adaptive__advisoryPartitionSizeInBytes="1KB")
    version = table.compact(target_file_bytes=50_000)
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "1KB"
    now = {r["file_path"] for r in table.files().collect()}
    # The large file and February's only one are the same files; the four small ones became one.
    assert large < now and len(now & set(files)) == 2 and len(now) == 3
    assert rows_of(table.as_of()) == before and table.compact(target_file_bytes=50_000) is None
    assert rows_of(table.as_of(version - 1)) == before
    # The folder that is read by file name can be changed and compacted like any other.
    table.update_where(F.col("k") == 1, {"v": "changed"})
    assert table.as_of().count() == len(before) and table.as_of().where("v = 'changed'").count() == 1
    assert table.files().where(F.col("file_path").isin(*large)).count() == 0


def test_compaction_fills_files_up_to_the_target(spark, folder):
    parts = spark.range(0, 4000, numPartitions=40).selectExpr("id as k", "sha2(cast(id as string), 256) as v")
    table = VersionedTable.create(spark.createDataFrame([], "k bigint, v string"), folder)
    table._commit(table._state(), parts, "append", Layout(), None, fitted=True)
    sizes = [r["file_size_in_bytes"] for r in table.files().where("file_size_in_bytes > 2000").collect()]
    target = 3 * max(sizes)
    table.compact(target_file_bytes=target)
    after = [r["file_size_in_bytes"] for r in table.files().where("file_size_in_bytes > 2000").collect()]
    assert len(after) < len(sizes) / 2 and max(after) < 2 * target and len(after) > 3
    assert table.as_of().count() == 4000


def test_overwriting_partitions_with_rows_of_the_table_itself(table, rows):
    january = table.as_of(months=(dt.date(2026, 1, 1), dt.date(2026, 2, 1)))
    table.overwrite_partitions(january.withColumn("city", F.lit("again")))
    assert table.as_of().count() == 20 and table.as_of().where("city = 'again'").count() == 5
    assert rows_of(table.as_of(1)) == rows_of(rows)


def test_file_stats_are_those_on_disk(spark, table, rows):
    table.append(rows.limit(6))
    listed = {r["file_path"].removeprefix("file:"): r for r in table.files(records=True).collect()}
    assert {p: os.path.getsize(p) for p in listed} == {p: r["file_size_in_bytes"] for p, r in listed.items()}
    assert sum(r["record_count"] for r in listed.values()) == 26
    stats = {r["day_month"]: r for r in table.file_stats().collect()}
    for month, row in stats.items():
        sizes = [os.path.getsize(p) for p in listed if f"day_month={month}/" in p]
        assert row["file_count"] == len(sizes)
        assert row["avg_file_size_mb"] == round(sum(sizes) / len(sizes) / 1024 / 1024, 2)
    assert "records" not in table.file_stats(records=False).columns
    assert "parquet" not in table.files()._jdf.queryExecution().executedPlan().toString().lower().replace(".parquet", "")
