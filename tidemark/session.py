"""Session settings and the shared folder that written tables live in."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

_own_root: dict[str, str] = {}


def build_session(
    app: str = "tidemark",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    **conf: str,
) -> SparkSession:
    """A session with the settings the operators rely on.

    Adaptive execution must stay on: writes use rebalance hints and joins count on
    it to split hot keys. ``shuffle_partitions`` is left to the cluster unless
    given; with adaptive execution a high number is safe, as small ones are merged.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.parquet.inferTimestampNTZ.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if master is not None:
        builder = builder.master(master)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local session may go without it; there a fresh temporary folder is used
    for as long as the application lives.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _own_root:
        _own_root[app] = tempfile.mkdtemp(prefix="run-tidemark-")
    return _own_root[app]


def work_folder(spark: SparkSession, name: str) -> str:
    """A new, unused folder path under the shared root."""
    return f"{shared_root(spark)}/tidemark/{name}-{uuid.uuid4().hex[:12]}"


def local_frame(spark: SparkSession, rows: Iterable[tuple], schema: T.StructType | str) -> DataFrame:
    """A few rows as a relation inside the plan.

    Unlike a frame made from Python rows it has a known size, so that joins with it
    can be broadcast, and needs no job of its own.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    named = [dict(zip(schema.names, row)) for row in rows]
    table = pa.Table.from_pylist(named, schema=to_arrow_schema(schema))
    return spark.createDataFrame(table, schema=schema)
