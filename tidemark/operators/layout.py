"""Partition layouts of plain Parquet folders, and relations about their files."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import bucket_of, month_ordinal, part_code, part_value
from tidemark.operators.sizes import measured

# The folder name of a NULL or empty partition value, and the signs that Spark
# writes as % and two digits in one, control characters apart.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
ESCAPED_SIGNS = "\"#%'*/:=?\\\x7f{[]^"


@dataclass(frozen=True)
class Layout:
    """How rows are spread over folders: month of a date, columns, hash bucket of a column.

    Folders are named by derived columns, which ``add`` computes and ``columns`` lists in
    folder order: ``<column>_month``, ``<column>_part`` and ``<column>_bucket``. A part is a
    reversible code of the value, apart for NULL, empty text and signs, which Spark's own
    folder names confuse or guess a type for. The column itself stays in the files.
    """

    month_of: str | None = None
    identity: tuple[str, ...] = ()
    bucket: tuple[str, int] | None = None

    @property
    def month(self) -> str | None:
        return f"{self.month_of}_month" if self.month_of else None

    @property
    def columns(self) -> list[str]:
        return [name for name, _ in self._named()]

    @property
    def value_columns(self) -> list[str]:
        """What ``values`` gives: identity columns by their own name."""
        return [column or name for name, column in self._named()]

    def _named(self) -> list[tuple[str, str | None]]:
        """Each folder column, and the identity column it is a code of, if any."""
        names = [(self.month, None)] if self.month else []
        names += [(f"{c}_part", c) for c in self.identity]
        return names + ([(f"{self.bucket[0]}_bucket", None)] if self.bucket else [])

    def add(self, df: DataFrame) -> DataFrame:
        new: dict[str, Column] = {}
        if self.month_of:
            new[self.month] = month_ordinal(F.col(self.month_of))
        for c in self.identity:
            new[f"{c}_part"] = part_code(F.col(c))
        if self.bucket:
            new[f"{self.bucket[0]}_bucket"] = bucket_of(F.col(self.bucket[0]), self.bucket[1])
        return df.withColumns(new) if new else df

    def schema(self, base: T.StructType) -> T.StructType:
        folders = [T.StructField(name, T.StringType() if column else T.IntegerType()) for name, column in self._named()]
        return T.StructType([*base.fields, *folders])

    def in_part(self, column: str, value: object) -> Column:
        """``column <=> value``; also names its folder, so that the others are not read."""
        return F.col(column).eqNullSafe(F.lit(value)) & (F.col(f"{column}_part") == part_code(F.lit(value)))

    def values(self, base: T.StructType, path: Column) -> list[Column]:
        """The partition values that a path stands for; NULL where it names none."""
        values = []
        for name, column in self._named():
            found = F.regexp_extract(path, f"(?:^|/){re.escape(name)}=([^/]*)", 1)
            text = F.when((found != "") & (found != NO_VALUE), F.url_decode(F.regexp_replace(found, r"\+", "%2B")))
            value = part_value(text, base[column].dataType) if column else text.cast("int")
            values.append(value.alias(column or name))
        return values


def escaped(value: str | None) -> str:
    """A partition value or column as it stands in a folder name."""
    if not value:
        return NO_VALUE
    return "".join(f"%{ord(c):02X}" if c in ESCAPED_SIGNS or 0 < ord(c) < 32 else c for c in value)


def gathered(df: DataFrame, layout: Layout, and_by: Sequence[str] = ()) -> DataFrame:
    """Rows of one folder brought together before a write, so that tasks open few files.

    A rebalance, not a repartition: adaptive execution cuts a folder that is too
    large for one task into several files and merges small ones.
    """
    columns = [F.col(c) for c in (*and_by, *layout.columns)]
    return df.hint("rebalance", *columns)


def write_partitioned(
    df: DataFrame, path: str, layout: Layout, mode: str = "overwrite", drop_null_keys: bool = False
) -> None:
    """Write in the layout. ``drop_null_keys`` leaves out rows whose bucket key is NULL."""
    if drop_null_keys and layout.bucket:
        df = df.where(F.col(layout.bucket[0]).isNotNull())
    rows = gathered(layout.add(df), layout)
    (
        rows.write.mode(mode)
        .option("partitionOverwriteMode", "static")
        .partitionBy(*layout.columns)
        .parquet(path)
    )


def save_bucketed(df: DataFrame, name: str, path: str, column: str, buckets: int) -> None:
    """A catalog table bucketed and sorted by a column: joins on it need no shuffle.

    Rows are dealt to tasks as they are to buckets, so each bucket is one sorted file however
    many tasks the input has.
    """
    (
        df.repartition(buckets, column)
        .write.mode("overwrite")
        .bucketBy(buckets, column)
        .sortBy(column)
        .option("path", path)
        .saveAsTable(name)
    )


def read_partitioned(
    spark: SparkSession, path: str, schema: T.StructType, layout: Layout
) -> DataFrame:
    """Read with a declared schema: types of folder names are not guessed, new columns are NULL."""
    return spark.read.schema(layout.schema(schema)).parquet(path)


def replace_partitions(
    target: DataFrame, incoming: DataFrame, layout: Layout
) -> DataFrame:
    """The target with every partition that occurs in ``incoming`` replaced by it.

    The rest of such a partition is lost even if ``incoming`` holds only part of it.
    """
    by = {name: f"__{name}" for name in layout.columns}
    present = layout.add(incoming).select(*layout.columns).distinct().withColumnsRenamed(by)
    # One row per partition: small enough, as a rule, to be broadcast, so that the target is not shuffled.
    present = measured(present)
    same = [F.col(name).eqNullSafe(F.col(other)) for name, other in by.items()]
    kept = layout.add(target).join(present, same, "left_anti").select(*target.columns)
    return kept.unionByName(incoming.select(*target.columns))


def overwrite_partitions(df: DataFrame, path: str, layout: Layout) -> None:
    """Replace in a folder only the partitions that occur in ``df``."""
    rows = gathered(layout.add(df), layout)
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*layout.columns)
        .parquet(path)
    )


def file_listing(spark: SparkSession, *paths: str) -> DataFrame:
    """``file_path, file_size_in_bytes`` of the Parquet files under some folders: no file is opened."""
    listed = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet")
        .load(list(paths))
    )
    return listed.select(F.col("path").alias("file_path"), F.col("length").alias("file_size_in_bytes"))


def file_path() -> Column:
    """The file that a row was read from, as ``file_listing`` spells it."""
    # In ``_metadata`` it is URL-encoded.
    return F.url_decode(F.regexp_replace("_metadata.file_path", r"\+", "%2B"))


def record_counts(rows: DataFrame) -> DataFrame:
    """``file_path, record_count`` of the files behind a frame, from their footers alone."""
    return rows.select(file_path().alias("file_path")).groupBy("file_path").agg(F.count(F.lit(1)).alias("record_count"))


def file_inventory(
    spark: SparkSession, path: str, schema: T.StructType, layout: Layout, records: bool = False
) -> DataFrame:
    """One row per data file: its partition values, path and bytes, and if asked its records.

    Path and bytes come from the listing, values from the folder names. ``records`` reads
    the footers as well.
    """
    files = file_listing(spark, path)
    if records:
        files = with_records(files, read_partitioned(spark, path, schema, layout))
    return files.select(*layout.values(schema, F.col("file_path")), *files.columns)


def bytes_scanned(spark: SparkSession, path: str, rows: DataFrame) -> DataFrame:
    """One row: ``bytes_read`` of the files that a frame filtered by folder columns reads, of all ``bytes``."""
    read = record_counts(rows).select("file_path", F.lit(True).alias("__read"))
    files = file_listing(spark, path).join(read, "file_path", "left")
    size = F.col("file_size_in_bytes")
    return files.agg(F.sum(F.when(F.col("__read"), size).otherwise(0)).alias("bytes_read"), F.sum(size).alias("bytes"))


def with_records(files: DataFrame, rows: DataFrame) -> DataFrame:
    """Listed files with the number of rows that a frame over them has in each."""
    counted = files.join(record_counts(rows), "file_path", "left")
    return counted.select(*files.columns, F.coalesce("record_count", F.lit(0).cast("long")).alias("record_count"))


def partition_file_stats(files: DataFrame, parts: Sequence[str]) -> DataFrame:
    """Files and mean size in MB of each partition, most files first; records if they are there."""
    measures = [
        F.count(F.lit(1)).alias("file_count"),
        F.round(F.avg("file_size_in_bytes") / 1024 / 1024, 2).alias("avg_file_size_mb"),
    ]
    if "record_count" in files.columns:
        measures.append(F.sum("record_count").alias("records"))
    return files.groupBy(*parts).agg(*measures).orderBy(F.col("file_count").desc(), *parts)


def partition_count(df: DataFrame, parts: Sequence[str]) -> DataFrame:
    return df.select(*parts).distinct().agg(F.count(F.lit(1)).alias("total_partitions"))


def empty_like(df: DataFrame) -> DataFrame:
    return df.limit(0)


def ensure_table(spark: SparkSession, name: str, schema: T.StructType | str, path: str) -> DataFrame:
    """Create an empty Parquet table in the catalog unless it exists; return it."""
    if not spark.catalog.tableExists(name):
        ddl = schema if isinstance(schema, str) else _ddl(schema)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl}) USING parquet LOCATION '{path}'")
    return spark.table(name)


def add_columns(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """New nullable columns, NULL in the rows that exist; present ones are kept."""
    new = {c: F.lit(None).cast(t) for c, t in columns.items() if c not in df.columns}
    return df.withColumns(new) if new else df


def batch_of(key: str, batches: int) -> Column:
    """The batch a row belongs to when a load is cut up by key hash."""
    return F.pmod(F.hash(F.col(key)), F.lit(batches))


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
