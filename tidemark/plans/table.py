"""A Parquet folder that keeps its versions.

    <root>/data/commit_id=<id>/commit_batch=<n>/<partition folders>/*.parquet
    <root>/log/entry=<first version>/*.parquet

A commit writes only the partitions it changes, under an id of its own. Its log entry lists
every folder that the new version consists of, those it took over included, so a version is
read from one entry and nothing has to be replayed. Changing 1 GB of a 100 TB table rewrites the
touched partitions and a list of folders, not the table.

The entry is written last, in a mode that fails if it is there: of two writers that started
from the same version one is refused and loses no row of the other. Data without an entry, of
a commit that died or was refused, is never read.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable, Collection, Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import in_month_range, in_months, ntz
from tidemark.operators.layout import (
    Layout,
    escaped,
    file_listing,
    file_path,
    gathered,
    partition_file_stats,
    record_counts,
)
from tidemark.operators.merge import (
    Clause,
    delete_matching,
    held_keys,
    merge_into,
    update,
    update_where,
)
from tidemark.session import local_frame

COMMIT, FOLDER = "commit", "folder"
#: A folder that a version consists of: all its files, or those named. ``month`` is the number
#: in its name, of the column ``month_of``.
FOLDERS = (
    "kind string, version bigint, layout string, write string, batch int, folder string,"
    " month_of string, month int, files array<string>"
)
LOG = f"{FOLDERS}, committed_at timestamp_ntz, operation string, table_schema string"
TAKEN = ("version", "commit_id", "commit_batch")
#: The parts of a data file's path: id, batch, partition folder, file.
DATA_FILE = r".*/data/commit_id=([^/]+)/commit_batch=(\d+)/(?:(.*)/)?([^/]+)$"


class VersionedTable:
    """``take_over`` lets the next commit replace a log entry without rows, as a writer leaves it
    that dies while it publishes. Set it only when no other writer is at work."""

    def __init__(self, spark: SparkSession, root: str, take_over: bool = False):
        self.spark = spark
        self.root = root.rstrip("/")
        self.take_over = take_over

    # ---- log ---------------------------------------------------------------

    @classmethod
    def create(
        cls,
        df: DataFrame,
        root: str,
        layout: Layout | None = None,
        committed_at: dt.datetime | None = None,
    ) -> VersionedTable:
        """A new table whose first version holds ``df``."""
        table = cls(df.sparkSession, root)
        # The folder of the log is there before it is looked into.
        local_frame(df.sparkSession, [], LOG).write.mode("ignore").parquet(f"{table.root}/log/entry=0")
        if table.exists():
            raise ValueError(f"{root} already holds a table")
        table._commit(None, df, "create", layout or Layout(), committed_at, replaces_all=True)
        return table

    def exists(self) -> bool:
        return not self._commits().isEmpty()

    def commits(self) -> DataFrame:
        """The commit log: version, committed_at, operation."""
        return self._commits().select("version", "committed_at", "operation")

    def latest_version(self) -> int:
        return latest_version(self.commits())

    def version_at(self, moment: dt.datetime) -> int:
        return version_at(self.commits(), moment)

    # ---- reads -------------------------------------------------------------

    def as_of(
        self,
        version: int | None = None,
        timestamp: dt.datetime | None = None,
        months: tuple[dt.date, dt.date] | None = None,
        with_layout: bool = False,
    ) -> DataFrame:
        """The table at a version, at a time, or now.

        ``months`` keeps rows whose month-layout date lies in ``[start, end)``; other folders
        are neither listed nor read. ``with_layout`` keeps the derived partition columns.
        """
        if timestamp is not None:
            version = self.version_at(timestamp)
        state = self._state(version)
        rows = self._read(state, self._folders(state, months).collect())
        if months is not None:
            rows = rows.where(in_month_range(F.col(state.layout.month_of), *months, F.col(state.layout.month)))
        return rows.select(*state.names, *(state.layout.columns if with_layout else []))

    def versions(self) -> DataFrame:
        """Rows of every version, with the column ``version``.

        Each file is read once, however many versions share it: its rows are joined to the
        interval of versions in which it was part of the table.
        """
        log = self._log()
        schemas = self._commits().groupBy("table_schema").agg(F.min("version").alias("since")).orderBy("since").collect()
        schema = _merged([T.StructType.fromJson(json.loads(r["table_schema"])) for r in schemas])
        place = ["write", "batch", "folder", "files", "layout"]
        intervals = (
            log.where(F.col("kind") == FOLDER).groupBy(*place).agg(F.min("version").alias("first"), F.max("version").alias("last"))
        )
        # One row per folder and set of files; a folder that was ever whole is read as a whole.
        found = intervals.select(*place).distinct().collect()
        whole = {(r["write"], r["batch"], r["folder"]) for r in found if r["files"] is None}
        wanted = [r for r in found if r["files"] is None or (r["write"], r["batch"], r["folder"]) not in whole]
        columns = [f.name for f in schema.fields]
        path = F.col("_metadata.file_path")
        at = [_folder_key(path).alias("__at"), *([_file_name(path).alias("__file")] if len(whole) < len(found) else [])]
        scans = [scan.select(*columns, *at) for _, scan in self._scans(schema, _merged_files(wanted))]
        rows = reduce(DataFrame.union, scans) if scans else self._nothing(schema, "__at string, __file string")
        place = F.concat_ws("/", "write", F.concat(F.lit("commit_batch="), "batch"), F.when(F.col("folder") != "", F.col("folder")))
        spans = intervals.select(place.alias("__of"), F.col("files").alias("__files"), "first", "last")
        here = F.col("__at") == F.col("__of")
        if "__file" in rows.columns:
            here = here & (F.col("__files").isNull() | F.array_contains("__files", F.col("__file")))
        return rows.join(spans, here).select(*columns, F.explode(F.sequence("first", "last")).alias("version"))

    def changed_between(self, old: int, new: int, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
        """Both versions, cut down to keys that occur in folders they do not share.

        A key found only in shared folders has the same rows in both versions, so no
        diff of the two can mention it. The shared folders are filtered by a semi
        join before anything is shuffled for the diff itself.
        """
        before, after = self._state(old), self._state(new)
        was, is_now = self._folders(before).collect(), self._folders(after).collect()
        shared = {_key(r) for r in was} & {_key(r) for r in is_now}
        if not shared:
            return self._rows(before, was), self._rows(after, is_now)
        only_old = self._rows(before, [r for r in was if _key(r) not in shared])
        only_new = self._rows(after, [r for r in is_now if _key(r) not in shared])
        touched = only_old.select(*keys).union(only_new.select(*keys)).distinct()

        def whole(state, rows, rest):
            kept = self._rows(state, [r for r in rows if _key(r) in shared])
            return rest.unionByName(kept.join(touched, list(keys), "left_semi"))

        return whole(before, was, only_old), whole(after, is_now, only_new)

    def files(self, version: int | None = None, records: bool = False) -> DataFrame:
        """One row per live file: partition values, path, bytes and, if asked, records.

        Files are listed, not opened; ``records`` reads their footers. Folders of an older
        layout have NULL for values that their names do not give.
        """
        state = self._state(version)
        live = self._folders(state).collect()
        files = self._listing(live)
        if records:
            counts = [record_counts(scan) for _, scan in self._scans(state.schema, live)]
            if counts:
                files = files.join(reduce(DataFrame.union, counts), "file_path", "left")
            else:
                files = files.withColumn("record_count", F.lit(None).cast("long"))
            files = files.withColumn("record_count", F.coalesce("record_count", F.lit(0).cast("long")))
        return files.select(*state.layout.values(state.schema, F.col("file_path")), *files.columns)

    def file_stats(self, version: int | None = None, records: bool = True) -> DataFrame:
        """File count, mean size and records of each partition of the present layout."""
        files = self.files(version, records)
        return partition_file_stats(files, [c for c in files.columns if c not in FILE])

    # ---- commits -----------------------------------------------------------

    def append(self, df: DataFrame, committed_at: dt.datetime | None = None) -> int:
        state = self._state()
        return self._commit(state, df, "append", state.layout, committed_at)

    def append_in_batches(
        self, df: DataFrame, batch: Column, batches: int, committed_at: dt.datetime | None = None
    ) -> int:
        """One version per batch number in ``[0, batches)``, written in a single pass.

        A batch without rows is a version that adds nothing; a row whose number is NULL or
        outside the range fails the write.
        """
        state = self._state()
        outside = F.raise_error(F.concat(F.lit("no such batch: "), F.coalesce(batch.cast("string"), F.lit("NULL"))))
        number = F.when((batch >= 0) & (batch < batches), batch.cast("int")).otherwise(outside.cast("int"))
        numbered = df.withColumn("commit_batch", number)
        rows = state.layout.add(self._fitted(numbered, state.schema, ["commit_batch"]))
        return self._commit(state, rows, "append", state.layout, committed_at, batches=batches)

    def overwrite(
        self,
        df: DataFrame,
        committed_at: dt.datetime | None = None,
        layout: Layout | None = None,
        operation: str = "overwrite",
    ) -> int:
        """Replace the whole content."""
        state = self._state()
        layout = layout or state.layout
        return self._commit(state, df, operation, layout, committed_at, replaces_all=True)

    def overwrite_partitions(self, df: DataFrame, committed_at: dt.datetime | None = None) -> int:
        """Replace the partitions that occur in ``df``, whole, and no others.

        The rows may come from the table itself: what they were read from stays.
        """
        state = self._state()
        if not self._folders(state).where(F.col("layout") != _layout_text(state.layout)).isEmpty():
            raise ValueError("older folders use another layout: rewrite the table first")
        return self._commit(state, df, "overwrite", state.layout, committed_at, cut_written=True)

    def add_columns(self, columns: Mapping[str, str], committed_at: dt.datetime | None = None) -> int:
        """Nullable columns from now on; no data is rewritten."""
        state = self._state()
        fields = list(state.schema.fields)
        for name, kind in columns.items():
            if name not in state.names:
                parsed = T.StructType.fromDDL(f"`{name}` {kind}")
                fields.append(parsed.fields[0])
        return self._alter(state, T.StructType(fields), state.layout, committed_at)

    def evolve_layout(self, layout: Layout, committed_at: dt.datetime | None = None) -> int:
        """Use another layout for what is written from now on; old folders stay as they are."""
        state = self._state()
        return self._alter(state, state.schema, layout, committed_at)

    def merge(
        self,
        source: DataFrame,
        on: Sequence[str],
        matched: Sequence[Clause] = (),
        not_matched: Sequence[Clause] = (),
        source_unique: bool = False,
        committed_at: dt.datetime | None = None,
    ) -> int:
        """A merge that rewrites only partitions in which a source key occurs."""
        # A frame that the caller has cached stays so.
        own = not (source.storageLevel.useMemory or source.storageLevel.useDisk)
        if own:
            source = source.persist()
        try:
            source.count()  # measures its size, which decides whether it is broadcast
            keys = source.select(*on).distinct()
            return self._rewrite(
                lambda rows: rows.join(keys, list(on), "left_semi"),
                lambda rows: merge_into(rows, source, on, matched, not_matched, source_unique),
                "merge",
                committed_at,
            )
        finally:
            if own:
                source.unpersist()

    def update_where(
        self, predicate: Column, values: Mapping[str, object], committed_at: dt.datetime | None = None
    ) -> int:
        return self._rewrite(
            lambda rows: rows.where(predicate),
            lambda rows: update_where(rows, predicate, values),
            "update",
            committed_at,
            values,
        )

    def delete_matching(
        self, keys: DataFrame, on: Sequence[str], committed_at: dt.datetime | None = None
    ) -> int:
        keys = keys.select(*on).distinct().persist()
        try:
            keys.count()  # measures their size, which decides whether they are broadcast
            return self._rewrite(
                lambda rows: rows.join(keys, list(on), "left_semi"),
                lambda rows: delete_matching(rows, keys, on),
                "delete",
                committed_at,
            )
        finally:
            keys.unpersist()

    def compact(
        self, target_file_bytes: int = 128 << 20, committed_at: dt.datetime | None = None
    ) -> int | None:
        """Merge files of less than the target size, within each folder name, into files of about it.

        Small files are put into bins in the order of their names, each bin becomes one file of
        less than twice the target. Larger files, a bin's only file and folders of an older
        layout stay as they are.
        """
        state = self._state()
        live = self._folders(state).where(F.col("layout") == _layout_text(state.layout)).collect()
        files = self._listing(live).select("*", *_place(F.col("file_path")))
        folder = Window.partitionBy("__folder")
        before = F.sum("file_size_in_bytes").over(
            folder.orderBy("__write", "__batch", "__file").rowsBetween(Window.unboundedPreceding, -1)
        )
        small = files.where(F.col("file_size_in_bytes") < target_file_bytes)
        binned = small.withColumn("bin", F.floor(F.coalesce(before, F.lit(0)) / target_file_bytes))
        in_bin = F.count(F.lit(1)).over(Window.partitionBy("__folder", "bin"))
        # One row per small file: what Spark itself keeps of the files of a scan.
        merged = binned.withColumn("n", in_bin).where(F.col("n") > 1).select("__write", "__batch", "__folder", "__file", "bin").collect()
        if not merged:
            return None
        bins = {key: i for i, key in enumerate(sorted({(r["__folder"], r["bin"]) for r in merged}))}
        chosen = [(r["__write"], r["__batch"], r["__folder"], r["__file"], bins[r["__folder"], r["bin"]]) for r in merged]
        dealt = local_frame(self.spark, chosen, "__write string, __batch int, __folder string, __file string, bin int")
        by_file = ["__write", "__batch", "__folder", "__file"]
        layout_text = _layout_text(state.layout)
        parts: dict[tuple, list[str]] = {}
        for write, batch, name, file, _ in chosen:
            parts.setdefault((write, batch, name), []).append(file)
        sources = [Row(write=w, batch=b, folder=f, files=names, layout=layout_text) for (w, b, f), names in parts.items()]
        (_, scan), = self._scans(state.schema, sources)
        placed = scan.select(*state.names, *state.layout.columns, *_place(file_path())).join(dealt, by_file)
        rows = placed.repartitionById(len(bins), "bin").select(*state.names, *state.layout.columns)

        # What stays of the folders that lost files, by name.
        touched = local_frame(self.spark, list(parts), "write string, batch int, folder string")
        same_folder = ["write", "batch", "folder"]
        left = files.join(dealt, by_file, "left_anti").select(*[F.col(f"__{c}").alias(c) for c in same_folder], "__file")
        left = left.join(touched, same_folder, "left_semi").groupBy(*same_folder).agg(F.collect_list("__file").alias("left"))
        now = self._folders(state)
        kept = now.join(touched, same_folder, "left_anti").unionByName(
            now.join(left, same_folder).withColumn("files", F.col("left")).select(*now.columns)
        )
        return self._commit(state, rows, "compact", state.layout, committed_at, kept=kept, fitted=True)

    def restore_rows(
        self,
        version: int,
        predicate: Column,
        only_missing: Sequence[str] | None = None,
        committed_at: dt.datetime | None = None,
    ) -> int:
        """Append rows of an old version.

        A row that is still present is then held twice, unless ``only_missing`` names
        the key by which present rows are left out.
        """
        rows = self.as_of(version).where(predicate)
        if not only_missing:
            return self.append(rows, committed_at)
        rows = rows.persist()
        try:
            rows.count()  # measures their size, see merge
            held = held_keys(self.as_of(), rows, list(only_missing), source_unique=False)
            lost = rows.join(held, list(only_missing), "left_anti").select(*rows.columns)
            return self.append(lost, committed_at)
        finally:
            rows.unpersist()

    def recover(
        self,
        version: int,
        predicate: Column,
        on: Sequence[str],
        committed_at: dt.datetime | None = None,
    ) -> int:
        """Set rows that still exist back to what they were in an old version."""
        stage = self.as_of(version).where(predicate)
        return self.merge(stage, on, matched=[update()], committed_at=committed_at)

    # ---- inner workings ----------------------------------------------------

    def _state(self, version: int | None = None) -> _State:
        """What the log says of one version; its folders are in ``_folders``."""
        commits = self._commits()
        if version is not None:
            commits = commits.where((F.col("entry") <= version) & (F.col("version") == version))
        found = commits.orderBy(F.col("version").desc()).limit(1).collect()
        if not found and version is not None and self.exists():
            raise ValueError(f"version {version} was never committed")
        if not found:
            raise ValueError("the table has no versions")
        row = found[0]
        schema = T.StructType.fromJson(json.loads(row["table_schema"]))
        return _State(row["version"], row["entry"], row["committed_at"], schema, _layout_from(row["layout"]))

    def _folders(self, state: _State, months: tuple[dt.date, dt.date] | None = None) -> DataFrame:
        """The folders of a version, those that other months fill left out."""
        entry = self.spark.read.schema(FOLDERS).parquet(f"{self.root}/log/entry={state.entry}")
        rows = entry.where((F.col("kind") == FOLDER) & (F.col("version") == state.version))
        if months is None:
            return rows
        date = state.layout.month_of
        if date is None:
            raise ValueError("this version is not laid out by month")
        # Folders of a layout by another column say nothing about this one.
        other = ~F.col("month_of").eqNullSafe(F.lit(date))
        return rows.where(other | in_months(F.col("month"), *months))

    def _scans(self, schema: T.StructType, folders: Collection[Row]) -> list[tuple[Layout, DataFrame]]:
        """One scan for the folders of each layout, with the columns of the layout."""
        groups: dict[str, list[str]] = {}
        for row in sorted(folders, key=lambda r: (r["write"], r["batch"], r["folder"])):
            path = f"{self._data(row['write'])}/commit_batch={row['batch']}"
            path += f"/{row['folder']}" if row["folder"] else ""
            groups.setdefault(row["layout"], []).extend([path] if row["files"] is None else [f"{path}/{f}" for f in row["files"]])
        scans = []
        for text, paths in groups.items():
            layout = _layout_from(text)
            reader = self.spark.read.schema(layout.schema(schema)).option("basePath", f"{self.root}/data")
            scans.append((layout, reader.parquet(*paths)))
        return scans

    def _read(self, state: _State, folders: Collection[Row], with_path: bool = False) -> DataFrame:
        """Table columns and columns of the present layout, from the given folders."""
        wanted = state.layout.schema(state.schema)
        frames = []
        for layout, rows in self._scans(state.schema, folders):
            if with_path:
                rows = rows.select("*", F.col("_metadata.file_path").alias("__path"))
            if layout != state.layout:
                rows = state.layout.add(rows)
            frames.append(rows.select(*wanted.names, *(["__path"] if with_path else [])))
        if not frames:
            return self._nothing(wanted, "__path string" if with_path else None)
        return reduce(DataFrame.unionByName, frames)

    def _rows(self, state: _State, folders: Collection[Row]) -> DataFrame:
        return self._read(state, folders).select(*state.names)

    def _nothing(self, schema: T.StructType, more: str | None = None) -> DataFrame:
        return local_frame(self.spark, [], T.StructType([*schema.fields, *(T.StructType.fromDDL(more).fields if more else [])]))

    def _listing(self, folders: Collection[Row]) -> DataFrame:
        """The files of the given folders, by listing."""
        whole = [r for r in folders if r["files"] is None]
        cut = [r for r in folders if r["files"] is not None]
        paths = [
            f"{self._data(r['write'])}/commit_batch={r['batch']}" + (f"/{r['folder']}" if r["folder"] else "") + name
            for r in whole + cut
            for name in ([""] if r["files"] is None else [f"/{f}" for f in r["files"]])
        ]
        if not paths:
            return local_frame(self.spark, [], "file_path string, file_size_in_bytes bigint")
        return file_listing(self.spark, *paths)

    def _rewrite(
        self,
        touching: Callable[[DataFrame], DataFrame],
        change: Callable[[DataFrame], DataFrame],
        operation: str,
        committed_at: dt.datetime | None,
        values: Mapping[str, object] | None = None,
    ) -> int:
        """Replace the folders in which ``touching`` finds a row by their changed content."""
        state = self._state()
        live = self._folders(state).collect()
        hits = touching(self._read(state, live, with_path=True)).select("__path").distinct()
        # One row per touched folder name.
        names = hits.select(F.regexp_extract(_decoded("__path"), DATA_FILE, 3)).distinct()
        found = {r[0] for r in names.collect()}
        touched = [r for r in live if r["folder"] in found]
        # Rows that stay in their folder can be written by the task that read them.
        layout = state.layout
        moved = values is None or {layout.month_of, *layout.identity, layout.bucket and layout.bucket[0]} & set(values)
        gather = bool(moved) or any(r["layout"] != _layout_text(layout) for r in touched)
        kept = self._folders(state).join(local_frame(self.spark, [(f,) for f in sorted(found)], "folder string"), "folder", "left_anti")
        rows = change(self._rows(state, touched))
        return self._commit(state, rows, operation, layout, committed_at, kept=kept, gather=gather)

    def _alter(self, state, schema, layout, committed_at) -> int:
        n = state.version + 1
        row = _commit_row(n, "alter", schema, layout, _moment(state, committed_at))
        self._publish(n, [row], self._folders(state).withColumn("version", F.lit(n).cast("long")))
        return n

    def _fitted(self, df: DataFrame, schema: T.StructType, extra: Sequence[str] = ()) -> DataFrame:
        """Columns in table order and type; those the input lacks are NULL."""
        unknown = set(df.columns) - set(schema.fieldNames()) - set(extra)
        if unknown:
            raise ValueError(f"the table has no columns {sorted(unknown)}")
        given = set(df.columns)
        columns = [
            (F.col(f.name) if f.name in given else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
        return df.select(*columns, *extra)

    def _commit(
        self,
        state: _State | None,
        df: DataFrame,
        operation: str,
        layout: Layout,
        committed_at: dt.datetime | None,
        replaces_all: bool = False,
        cut_written: bool = False,
        kept: DataFrame | None = None,
        batches: int | None = None,
        gather: bool = True,
        fitted: bool = False,
    ) -> int:
        """Write ``df``, then publish a version of what it wrote and the folders that are kept.

        Kept are all folders of ``state`` unless ``kept`` says which; none with
        ``replaces_all``; with ``cut_written`` those under whose name nothing was written. ``batches``
        makes a version of each number of the column ``commit_batch``. ``fitted`` rows are
        written as they come, by the tasks that hold them.
        """
        n = 1 if state is None else state.version + 1
        moment = _moment(state, committed_at)
        schema = df.schema if replaces_all else state.schema
        taken = [c for c in TAKEN if c in schema.fieldNames()]
        if taken:
            raise ValueError(f"the column name {taken[0]!r} is taken by the table itself")
        schema = T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields])
        write = uuid.uuid4().hex
        if fitted:
            rows = df
        elif batches is None:
            rows = layout.add(self._fitted(df, schema))
            rows = gathered(rows, layout) if gather else rows
        else:
            rows = gathered(df, layout, ["commit_batch"])
        by = [*(["commit_batch"] if batches else []), *layout.columns]
        # The write itself says which folders it fills: each distinct set of values is one.
        seen = Observation()
        rows = rows.observe(seen, F.collect_set(F.struct(F.lit(0).alias("__any"), *[F.col(c).cast("string").alias(c) for c in by])).alias("folders"))
        rows.write.partitionBy(*by).parquet(self._data(write) + ("" if batches else "/commit_batch=0"))
        last = n + (batches or 1) - 1
        new = self._written(write, layout, seen.get["folders"], batches)
        if kept is None and not replaces_all:
            kept = self._folders(state)
            if cut_written:
                kept = kept.join(new.select("folder").distinct(), "folder", "left_anti")

        def until_last(first: Column) -> Column:
            return F.explode(F.sequence(first.cast("long"), F.lit(last).cast("long"))).alias("version")

        folders = new.select(*[c for c in new.columns if c != "version"], until_last(F.lit(n) + F.col("batch")))
        if kept is not None:
            folders = folders.unionByName(kept.select(*[c for c in kept.columns if c != "version"], until_last(F.lit(n))))
        self._publish(n, [_commit_row(i, operation, schema, layout, moment) for i in range(n, last + 1)], folders)
        return last

    def _written(self, write: str, layout: Layout, filled: Sequence[Row], batches: int | None) -> DataFrame:
        """The folders that one commit has written, given the values of each."""
        text = _layout_text(layout)
        rows = []
        for values in filled:
            batch = int(values["commit_batch"]) if batches else 0
            folder = "/".join(f"{escaped(c)}={escaped(values[c])}" for c in layout.columns)
            month = values[layout.month] if layout.month else None
            rows.append((FOLDER, None, text, write, batch, folder, layout.month_of, None if month is None else int(month), None))
        return local_frame(self.spark, rows, FOLDERS)

    def _publish(self, n: int, rows: list[tuple], folders: DataFrame) -> None:
        """Make versions visible, unless there are any. One file if it is small, several if not."""
        entries = local_frame(self.spark, rows, LOG).unionByName(folders, allowMissingColumns=True)
        left_over = self.take_over and self._log().where(F.col("entry") == n).isEmpty()
        try:
            entries.hint("rebalance").write.mode("overwrite" if left_over else "errorifexists").parquet(f"{self.root}/log/entry={n}")
        except AnalysisException as problem:
            if problem.getCondition() != "PATH_ALREADY_EXISTS":
                raise
            raise RuntimeError(f"version {n} was committed by another writer; read the table again") from problem

    def _data(self, write: str) -> str:
        return f"{self.root}/data/commit_id={write}"

    def _log(self) -> DataFrame:
        schema = f"{LOG}, entry bigint"
        try:
            return self.spark.read.schema(schema).parquet(f"{self.root}/log")
        except AnalysisException as problem:
            if problem.getCondition() != "PATH_NOT_FOUND":
                raise
            return local_frame(self.spark, [], schema)

    def _commits(self) -> DataFrame:
        return self._log().where(F.col("kind") == COMMIT)


FILE = ("file_path", "file_size_in_bytes", "record_count")


class _State:
    """What one version consists of, but for its folders."""

    def __init__(self, version, entry, committed_at, schema, layout):
        self.version: int = version
        self.entry: int = entry
        self.committed_at: dt.datetime = committed_at
        self.schema: T.StructType = schema
        self.layout: Layout = layout

    @property
    def names(self) -> list[str]:
        return self.schema.fieldNames()


def _place(path: Column) -> list[Column]:
    """Where a data file lies: id, batch, partition folder and name."""
    id_, batch, folder, file = (F.regexp_extract(path, DATA_FILE, i) for i in (1, 2, 3, 4))
    return [id_.alias("__write"), batch.try_cast("int").alias("__batch"), folder.alias("__folder"), file.alias("__file")]


def _decoded(path: Column | str) -> Column:
    """A path of ``_metadata`` as the file system spells it. Only a path with signs is worth the work."""
    path = F.col(path) if isinstance(path, str) else path
    return F.when(path.contains("%"), F.url_decode(F.regexp_replace(path, r"\+", "%2B"))).otherwise(path)


def _file_name(path: Column) -> Column:
    return F.substring_index(_decoded(path), "/", -1)


def _folder_key(path: Column) -> Column:
    """``<id>/commit_batch=<n>/<folder>`` of a data file: one row has one, so it is found without patterns."""
    inside = F.substring_index(path, "/data/commit_id=", -1)
    folder = F.substring(inside, F.lit(1), F.length(inside) - F.length(F.substring_index(inside, "/", -1)) - 1)
    return _decoded(folder)


def _key(row: Row) -> tuple:
    return row["write"], row["batch"], row["folder"], None if row["files"] is None else tuple(sorted(row["files"]))


def _merged_files(rows: Collection[Row]) -> list[Row]:
    """One row a folder, with every file that any of its rows names."""
    by_place: dict[tuple, Row] = {}
    for row in rows:
        place = row["write"], row["batch"], row["folder"]
        have = by_place.get(place)
        if have is not None and have["files"] is not None:
            names = sorted({*have["files"], *row["files"]})
            row = Row(write=place[0], batch=place[1], folder=place[2], files=names, layout=row["layout"])
        by_place[place] = row
    return list(by_place.values())


def _merged(schemas: Sequence[T.StructType]) -> T.StructType:
    """The columns of all schemas by name, the first seen first."""
    fields: dict[str, T.StructField] = {}
    for schema in schemas:
        for f in schema.fields:
            if fields.setdefault(f.name, f).dataType != f.dataType:
                raise ValueError(f"column {f.name!r} changed its type between versions")
    return T.StructType(list(fields.values()))


def latest_version(commits: DataFrame) -> int:
    """The version committed last; an error if there is none."""
    top = commits.orderBy(F.col("committed_at").desc(), F.col("version").desc()).limit(1).collect()
    if not top:
        raise ValueError("the table has no versions")
    return top[0]["version"]


def version_at(commits: DataFrame, moment: dt.datetime) -> int:
    """The version that was current at a moment; an error if there was none yet."""
    earlier = commits.where(F.col("committed_at") <= ntz(moment))
    top = earlier.orderBy(F.col("committed_at").desc(), F.col("version").desc()).limit(1).collect()
    if not top:
        raise ValueError(f"no version had been committed at {moment}")
    return top[0]["version"]


def _moment(state: _State | None, committed_at: dt.datetime | None) -> dt.datetime:
    """When a commit counts as made: never before the one it follows."""
    before = dt.datetime.min if state is None else state.committed_at
    if committed_at is None:
        return max(before, dt.datetime.now(dt.timezone.utc).replace(tzinfo=None))
    if committed_at < before:
        raise ValueError(f"the version before was committed later, at {before}")
    return committed_at


def _commit_row(n, operation, schema, layout, moment) -> tuple:
    text = _layout_text(layout)
    return (COMMIT, n, text, None, None, None, None, None, None, moment, operation, schema.json())


def _layout_text(layout: Layout) -> str:
    return json.dumps([layout.month_of, list(layout.identity), layout.bucket])


def _layout_from(text: str) -> Layout:
    month_of, identity, bucket = json.loads(text)
    return Layout(month_of, tuple(identity), tuple(bucket) if bucket else None)
