"""What a pipeline remembers between runs."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import ntz, part_code
from tidemark.operators.dedup import latest_per_key
from tidemark.plans.table import version_at
from tidemark.session import local_frame

# Where a pipeline starts, and the states it can be in.
BEGINNING = dt.datetime(1900, 1, 1)
INITIALIZED, SUCCESS, NO_DATA, FAILED = "INITIALIZED", "SUCCESS", "NO_DATA", "FAILED"
COMPLETED = "COMPLETED"

WATERMARKS = T.StructType(
    [
        T.StructField("pipeline_name", T.StringType()),
        T.StructField("last_watermark", T.TimestampNTZType()),
        T.StructField("last_run_id", T.StringType()),
        T.StructField("last_status", T.StringType()),
        T.StructField("updated_at", T.TimestampNTZType()),
    ]
)
WATERMARK_LOG = T.StructType([*WATERMARKS.fields, T.StructField("entry", T.LongType())])
_SLOTS = T.StructType(
    [*WATERMARK_LOG.fields, T.StructField("pipeline", T.StringType()), T.StructField("slot", T.IntegerType())]
)
CONTROL = T.StructType(
    [
        T.StructField("pipeline_name", T.StringType()),
        T.StructField("source_table", T.StringType()),
        T.StructField("target_table", T.StringType()),
        T.StructField("last_processed_snapshot_id", T.StringType()),
        T.StructField("last_processed_at", T.TimestampNTZType()),
        T.StructField("status", T.StringType()),
    ]
)


def now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def watermark_of(state: DataFrame, pipeline: str) -> DataFrame:
    """One row: the stored watermark, or the beginning when the pipeline has none."""
    stored = F.max("last_watermark")
    return state.where(F.col("pipeline_name") == pipeline).agg(
        F.coalesce(stored, ntz(BEGINNING)).alias("last_watermark")
    )


def newer_rows(
    df: DataFrame,
    watermark: dt.datetime,
    origin: str | None = None,
    updated_at: str = "updated_at",
    source: str = "source_system",
) -> DataFrame:
    """Rows changed after the watermark, of one origin. Both filters reach the scan.

    The watermark keeps its microseconds. Rows without a time are never newer.
    """
    rows = df.where(F.col(updated_at) > ntz(watermark))
    return rows if origin is None else rows.where(F.col(source) == origin)


class Watermarks:
    """The watermark of each pipeline.

    ``<root>/pipeline=<code>/slot=<0 or 1>`` holds one row. A new one gets the next number of its
    pipeline and replaces the older of the two, so the newest is there at any moment, the
    order does not depend on clocks, and two small files a pipeline are all there ever are. Each
    pipeline has one writer at a time; pipelines do not touch each other's rows.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root
        ensure_folder(spark, root, _SLOTS, ["pipeline", "slot"])

    def rows(self) -> DataFrame:
        """One row per pipeline."""
        return latest_per_key(self._log(), ["pipeline_name"], "entry").select(*WATERMARKS.names)

    def _log(self) -> DataFrame:
        # A slot may be replaced while it is read; the other one is newer then.
        return self.spark.read.schema(_SLOTS).option("ignoreMissingFiles", True).parquet(self.root)

    def _own(self, pipeline: str) -> DataFrame:
        return self._log().where((F.col("pipeline") == part_code(F.lit(pipeline))) & (F.col("pipeline_name") == pipeline))

    def seed(self, pipeline: str, at: dt.datetime | None = None) -> None:
        """A first row for a pipeline that has none."""
        if self._own(pipeline).isEmpty():
            self.set(pipeline, BEGINNING, "initial", INITIALIZED, at)

    def get(self, pipeline: str) -> dt.datetime:
        newest = self._own(pipeline).orderBy(F.col("entry").desc()).limit(1)
        return watermark_of(newest, pipeline).first()["last_watermark"]

    def set(
        self,
        pipeline: str,
        watermark: dt.datetime,
        run_id: str,
        status: str,
        at: dt.datetime | None = None,
    ) -> None:
        entry = (self._own(pipeline).agg(F.max("entry")).first()[0] or 0) + 1
        row = local_frame(self.spark, [(pipeline, watermark, run_id, status, at or now(), entry)], WATERMARK_LOG)
        (
            row.withColumns({"pipeline": part_code(F.col("pipeline_name")), "slot": (F.col("entry") % 2).cast("int")})
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("pipeline", "slot")
            .parquet(self.root)
        )


def ensure_folder(spark: SparkSession, path: str, schema: T.StructType, parts: Sequence[str] = ()) -> None:
    """An empty Parquet folder unless there is one."""
    local_frame(spark, [], schema).write.mode("ignore").partitionBy(*parts).parquet(path)


def append_row(spark: SparkSession, row: tuple, schema: T.StructType, path: str) -> None:
    local_frame(spark, [row], schema).write.mode("append").parquet(path)


def last_processed(control: DataFrame, pipeline: str) -> DataFrame:
    """The newest completed log row of a pipeline, or none; of equal times the later version."""
    mine = (F.col("pipeline_name") == pipeline) & (F.col("status") == COMPLETED)
    version = F.col("last_processed_snapshot_id").try_cast("bigint")
    return control.where(mine).orderBy(F.col("last_processed_at").desc(), version.desc()).limit(1)


def bootstrap_version(commits: DataFrame, target: DataFrame, loaded_at: str = "updated_at") -> int:
    """The source version that was current when the target was last loaded."""
    moment = target.agg(F.max(loaded_at)).first()[0]
    if moment is None:
        raise ValueError("the target is empty: load it once before running incrementally")
    return version_at(commits, moment)


class ControlLog:
    """An append-only log of processed versions; the latest row counts."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root
        ensure_folder(spark, root, CONTROL)

    def rows(self) -> DataFrame:
        return self.spark.read.schema(CONTROL).parquet(self.root)

    def last_version(self, pipeline: str) -> int | None:
        found = last_processed(self.rows(), pipeline).collect()
        return int(found[0]["last_processed_snapshot_id"]) if found else None

    def completed(
        self, pipeline: str, source: str, target: str, version: int, at: dt.datetime | None = None
    ) -> None:
        row = (pipeline, source, target, str(version), at or now(), COMPLETED)
        append_row(self.spark, row, CONTROL, self.root)
