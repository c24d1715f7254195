"""Delimited text in, delimited text or Parquet out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: What stands for NULL in the files written here.
NULL_TEXT = "\\N"


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    escape: str = "\\",
    null_value: str = "",
    mode: str = "PERMISSIVE",
) -> DataFrame:
    """Comma-separated text with a header line and ``"`` quotes.

    Without a schema the types are inferred, which reads the files once more. Use
    ``escape='"'`` for files that double their quotes; ``read_rows`` reads files of
    ``write_rows``. A field that does not fit its type becomes NULL, or fails the query with
    ``mode="FAILFAST"``.
    """
    reader = (
        spark.read.option("header", True)
        .option("quote", '"')
        .option("escape", escape)
        .option("nullValue", null_value)
        .option("mode", mode)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
    )
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    return reader.schema(schema).csv(path)


def read_rows(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None, file_format: str = "csv"
) -> DataFrame:
    """What ``write_rows`` has written: NULL, empty text, padding and quotes come back as they were."""
    if file_format == "csv":
        return read_csv(spark, path, schema, escape='"', null_value=NULL_TEXT)
    if file_format == "parquet":
        return (spark.read if schema is None else spark.read.schema(schema)).parquet(path)
    raise ValueError("file_format must be 'csv' or 'parquet'")


def typed(df: DataFrame, types: dict[str, str], bad_values: str = "fail") -> DataFrame:
    """Named columns cast to the given types, in that order.

    Text that does not fit fails the query, or with ``bad_values="null"`` becomes NULL.
    """

    def cast(name: str, kind: str) -> Column:
        column = F.col(name)
        return (column.cast(kind) if bad_values == "fail" else column.try_cast(kind)).alias(name)

    return df.select(*[cast(name, kind) for name, kind in types.items()])


def write_rows(df: DataFrame, path: str, file_format: str = "csv", mode: str = "overwrite") -> None:
    """Write a folder of CSV (with header, quotes doubled) or Parquet files.

    CSV keeps padding, and empty text apart from NULL, which is written as ``NULL_TEXT``.
    A text with a line break, or that is ``NULL_TEXT``, fails the write: the first would
    make files that cannot be split, the second would be read as NULL.
    """
    if file_format == "csv":
        refused = F.raise_error(F.lit(f"text with a line break, or {NULL_TEXT!r}, does not fit into CSV")).cast("string")
        checked = [
            F.when(F.col(f"`{f.name}`").rlike("[\\r\\n]") | (F.col(f"`{f.name}`") == NULL_TEXT), refused)
            .otherwise(F.col(f"`{f.name}`"))
            .alias(f.name)
            if isinstance(f.dataType, T.StringType)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
        (
            df.select(*checked)
            .write.mode(mode)
            .option("header", True)
            .option("escape", '"')
            .option("nullValue", NULL_TEXT)
            .option("ignoreLeadingWhiteSpace", False)
            .option("ignoreTrailingWhiteSpace", False)
            .csv(path)
        )
    elif file_format == "parquet":
        df.write.mode(mode).parquet(path)
    else:
        raise ValueError("file_format must be 'csv' or 'parquet'")
