"""Relations spelled out in code, for staged changes and small dimensions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.session import local_frame


def literal_rows(
    spark: SparkSession, rows: Iterable[tuple], schema: T.StructType | str, view: str | None = None
) -> DataFrame:
    """A small DataFrame, also registered as a temporary view if one is named."""
    df = local_frame(spark, rows, schema)
    if view is not None:
        df.createOrReplaceTempView(view)
    return df
