"""What is known about the size of a frame before it is joined."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemark.session import work_folder


def measured(df: DataFrame) -> DataFrame:
    """The frame as a table in the shared folder: made once, and its size in bytes is known.

    That size alone decides whether Spark broadcasts it in a join: within
    ``spark.sql.autoBroadcastJoinThreshold`` it does, beyond it both sides are shuffled.
    """
    path = work_folder(df.sparkSession, "measured")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
