"""The far side of a sync: a keyed copy that takes upserts and gives increments."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.merge import insert, update
from tidemark.plans.state import newer_rows
from tidemark.plans.table import VersionedTable
from tidemark.session import work_folder

_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_]*(\.[A-Za-z_][A-Za-z0-9_]*)?")


class TableReplica:
    """A replica kept as a table with versions."""

    def __init__(self, table: VersionedTable, keys: Sequence[str], updated_at: str = "updated_at"):
        self.table = table
        self.keys = list(keys)
        self.updated_at = updated_at

    def rows(self) -> DataFrame:
        return self.table.as_of()

    def increment(self, watermark: dt.datetime, origin: str | None) -> DataFrame:
        return newer_rows(self.rows(), watermark, origin, self.updated_at)

    def upsert(self, df: DataFrame, run_id: str) -> None:
        """Insert, or overwrite rows that are strictly older. ``df`` has one row per key."""
        newer = F.col(f"s.{self.updated_at}") > F.col(f"t.{self.updated_at}")
        self.table.merge(df, self.keys, [update(when=newer)], [insert()], source_unique=True)


class JdbcReplica:
    """A replica in a relational database with PostgreSQL's ``ON CONFLICT``.

    Executors write an increment to a staging table in parallel; one statement then
    moves it into the replica, so the replica never shows half an increment. A
    task that ran twice leaves its rows twice in the staging table; the statement
    keeps one per key.
    """

    def __init__(
        self,
        spark: SparkSession,
        url: str,
        table: str,
        columns: Sequence[str],
        keys: Sequence[str],
        updated_at: str = "updated_at",
        source: str = "source_system",
        properties: Mapping[str, str] | None = None,
        connections: int = 4,
        split_by: tuple[str, object, object] | None = None,
    ):
        for name in (table, *columns, *keys, updated_at, source):
            if not _NAME.fullmatch(name):
                raise ValueError(f"not a plain SQL name: {name!r}")
        self.spark = spark
        self.url = url
        self.table = table
        self.columns = list(columns)
        self.keys = list(keys)
        self.updated_at = updated_at
        self.source = source
        self.properties = dict(properties or {})
        self.connections = connections
        self.split_by = split_by

    def increment_query(self, watermark: dt.datetime, origin: str | None) -> str:
        """The subquery the database runs: projection, watermark and origin."""
        text = (
            f"SELECT {', '.join(self.columns)} FROM {self.table}"
            f" WHERE {self.updated_at} > TIMESTAMP '{watermark.isoformat(sep=' ')}'"
        )
        if origin is not None:
            text += f" AND {self.source} = '" + origin.replace("'", "''") + "'"
        return f"({text}) AS increment"

    def read_increment(self, watermark: dt.datetime, origin: str | None) -> DataFrame:
        """Rows changed after the watermark, straight from the database.

        With ``split_by``, a column and its bounds, several connections share the read.
        """
        reader = (
            self.spark.read.format("jdbc")
            .option("url", self.url)
            .option("dbtable", self.increment_query(watermark, origin))
            .options(**self.properties)
        )
        if self.split_by is not None:
            column, low, high = self.split_by
            reader = (
                reader.option("partitionColumn", column)
                .option("lowerBound", str(low))
                .option("upperBound", str(high))
                .option("numPartitions", self.connections)
            )
        return reader.load()

    def increment(self, watermark: dt.datetime, origin: str | None) -> DataFrame:
        """The same rows, copied once to the shared folder.

        The database moves on; what is read twice, or again after an executor was lost,
        has to be the rows the new watermark stands for.
        """
        path = work_folder(self.spark, "increment")
        rows = self.read_increment(watermark, origin)
        rows.write.parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def staging_name(self, run_id: str) -> str:
        return f"{self.table}_stage_{re.sub('[^A-Za-z0-9]', '_', run_id)}"

    def upsert_statement(self, staging: str) -> str:
        """Move staged rows: insert, or overwrite rows that are strictly older."""
        names = ", ".join(self.columns)
        keys = ", ".join(self.keys)
        settings = ", ".join(f"{c} = EXCLUDED.{c}" for c in self.columns if c not in self.keys)
        return (
            f"INSERT INTO {self.table} AS r ({names})"
            f" SELECT DISTINCT ON ({keys}) {names} FROM {staging}"
            f" ORDER BY {keys}, {self.updated_at} DESC"
            f" ON CONFLICT ({keys}) DO UPDATE SET {settings}"
            f" WHERE EXCLUDED.{self.updated_at} > r.{self.updated_at}"
        )

    def upsert(self, df: DataFrame, run_id: str) -> None:
        staging = self.staging_name(run_id)
        (
            df.select(*self.columns)
            .repartition(self.connections)
            .write.format("jdbc")
            .mode("overwrite")
            .option("url", self.url)
            .option("dbtable", staging)
            .options(**self.properties)
            .save()
        )
        self._execute([self.upsert_statement(staging), f"DROP TABLE {staging}"])

    def _execute(self, statements: Sequence[str]) -> None:
        """Run statements in one transaction over the driver's own JDBC classes."""
        jvm = self.spark._jvm
        settings = jvm.java.util.Properties()
        for key, value in self.properties.items():
            settings.setProperty(key, value)
        connection = jvm.java.sql.DriverManager.getConnection(self.url, settings)
        try:
            connection.setAutoCommit(False)
            for text in statements:
                statement = connection.createStatement()
                statement.execute(text)
                statement.close()
            connection.commit()
        finally:
            connection.close()
