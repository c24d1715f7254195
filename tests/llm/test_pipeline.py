"""The stages keep the columns of documents and take effect."""

import tempfile
import time
from pathlib import Path

import pyarrow.parquet as pq
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.conftest import SCHEMA
from tidemark.llm.neardup import near_duplicates
from tidemark.llm.tables import SHUFFLES_GO, stored, with_rows
from tidemark.session import shared_root


def test_stages(spark, docs, none, tmp_path):
    folder = str(tmp_path)
    spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(40)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    item = " ".join(f"bench{i}" for i in range(20))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    extra = spark.createDataFrame([(900, "here " + item, "en", "s", 3, None, None, None)], SCHEMA)
    docs.union(extra).write.parquet(f"{folder}/documents.parquet")
    now = spark.read.parquet(f"{folder}/documents.parquet")
    sizes = {}
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, folder).count() == 0
        after = stage(spark, now, folder)
        if name != "packing":
            assert after.dtypes == now.dtypes
            after.write.parquet(f"{folder}/{name}")
            after = spark.read.parquet(f"{folder}/{name}")
        sizes[name] = (now.count(), after.count())
        now = after
    assert sizes["near_dedup"][1] == sizes["near_dedup"][0] - 2
    assert sizes["substring_dedup"][0] == sizes["substring_dedup"][1]
    assert sizes["decontamination"][1] == sizes["decontamination"][0] - 1
    assert corpus_pipeline.run(spark, folder).columns[:2] == ["doc_id", "piece"]


def test_rows_are_stored_with_one_copy_of_the_text(docs):
    rows = with_rows(docs, "test-rows")
    assert rows.columns == ["row_id", "text", "row"]
    folder = rows.inputFiles()[0].removeprefix("file://").rpartition("/")[0]
    assert pq.read_schema(next(Path(folder).glob("*.parquet"))).names == ["row_id", "row"]
    assert rows.where("not text <=> row.text").count() == 0 and rows.count() == docs.count()


def test_shuffle_files_go_with_the_query_that_stores(spark):
    """Looks at the local folder of this session; another one in the same folder would be seen too."""

    def held():
        return {f for f in Path(spark.conf.get("spark.local.dir", tempfile.gettempdir())).glob("blockmgr-*/*/shuffle_*.data")}

    before = held()
    found = stored(spark.range(20_000).repartition(3).groupBy((F.col("id") % 5000).alias("k")).count(), "test-shuffle")
    end = time.monotonic() + 20
    while left := [f for f in held() - before if f.exists()]:
        assert time.monotonic() < end, left
        time.sleep(0.2)
    assert found.count() == 5000
    assert spark.conf.get(SHUFFLES_GO) == "false"


def test_toxicity_leaves_no_training_texts(spark, docs, tmp_path):
    spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(40)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    root = Path(shared_root(spark).removeprefix("file://")) / "tidemark"
    before = set(root.glob("llm-toxicity-training-*"))
    assert corpus_pipeline.toxicity(spark, docs, str(tmp_path)).count() > 0
    new = set(root.glob("llm-toxicity-training-*")) - before
    assert len(new) == 1 and spark.read.parquet(str(new.pop())).count() == 0


def test_rounds_of_near_duplicates_have_tasks_by_what_they_move(spark, docs, conf):
    conf(spark__sql__shuffle__partitions="60", spark__sql__adaptive__coalescePartitions__enabled="false")
    sc = spark.sparkContext
    asked = docs.union(docs.selectExpr("doc_id + 1000", "concat(text, ' x')", "lang", "source", "n_chars", "total", "row_id", "block_id"))
    group = f"near-{time.monotonic()}"
    sc.setJobGroup(group, "near duplicates")
    try:
        assert near_duplicates(asked).count() == asked.count()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    tracker = sc.statusTracker()
    stages = {s for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds}
    wide = [s for s in stages if (info := tracker.getStageInfo(s)) and info.numTasks == 60 and info.numCompletedTasks == 60]
    # Buckets, copies and the result are dealt in sixty; before, the rounds were too.
    assert len(wide) < 30
    assert spark.conf.get("spark.sql.shuffle.partitions") == "60"
