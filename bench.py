"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR   input tables      (default /root/testdata/sf0.1)
BENCH_CPUS     local threads     (default 8)
BENCH_QUERIES  names, separated by commas (default: the list below)
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import functions as F

from tidemark.acceptance import QUERIES
from tidemark.acceptance.views import JANUARY, v_orders
from tidemark.functions import in_month_range
from tidemark.session import build_session

HEADLINE = [
    "dim_join_sortmerge",
    "dim_join_broadcast",
    "count_by_city",
    "count_by_city_january",
    "dict_agg",
    "month_partition_revenue",
    "bucket_layout_revenue",
    "partition_file_stats",
    "inventory_by_region",
    "dedup_latest",
    "duplicate_keys",
    "diff_dedup_nullsafe",
    "diff_raw",
    "effective_changes",
    "merge_upsert",
    "merge_if_newer",
    "merge_delete_arm",
    "apply_corrections",
    "delete_fraud",
    "update_where",
    "csv_roundtrip",
    "gen_orders",
    "overwrite_partitions_reprocess",
    "compaction_preserves_rows",
    "as_of_version",
    "version_history",
    "sync_out",
    "replicate",
]


def run(frame) -> None:
    frame.write.format("noop").mode("overwrite").save()


def with_conf(spark, settings: dict[str, str], work) -> None:
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        work()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def three_aggregations(spark, sf_dir: str, cached: bool) -> None:
    """Three separate jobs over one month; ``dict_agg`` answers them in one pass."""
    january = v_orders(spark, sf_dir).where(in_month_range(F.col("order_date"), *JANUARY))
    january = january.select("order_id", "city", "product_category", "order_amount")
    if cached:
        january = january.persist()
        january.count()
    run(january.groupBy("city").count())
    run(january.groupBy("product_category").count())
    run(january.agg({"order_amount": "sum"}))
    january.unpersist()


def execution_controls(spark, sf_dir: str) -> dict:
    """The settings the lab compares: adaptive execution off and on, cache off and on."""

    def january():
        run(QUERIES["count_by_city_january"](spark, sf_dir))

    hundred = {"spark.sql.shuffle.partitions": "100"}
    return {
        "count_by_city_january[adaptive off]": lambda: with_conf(
            spark, hundred | {"spark.sql.adaptive.enabled": "false"}, january
        ),
        "count_by_city_january[adaptive on]": lambda: with_conf(
            spark, hundred | {"spark.sql.adaptive.enabled": "true"}, january
        ),
        "three_aggregations[no cache]": lambda: three_aggregations(spark, sf_dir, False),
        "three_aggregations[cache]": lambda: three_aggregations(spark, sf_dir, True),
    }


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = build_session(
        "bench",
        master=f"local[{cpus}]",
        shuffle_partitions=cpus,
        **{"spark.driver.memory": "12g", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    for table in ("orders", "lineitem"):  # start the workers and the file cache
        run(spark.read.parquet(f"{sf_dir}/{table}.parquet"))

    work = {name: lambda name=name: run(QUERIES[name](spark, sf_dir)) for name in names}
    if names is HEADLINE:
        work |= execution_controls(spark, sf_dir)
    seconds = {}
    for name, job in work.items():
        start = time.perf_counter()
        job()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr)
    result = {
        "metric": "total_query_time",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
