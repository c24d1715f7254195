"""Incremental pipelines between tables, and between a table and a replica."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from typing import Protocol

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import ntz
from tidemark.operators.change import (
    CHANGE_TYPE,
    DELETE,
    effective_changes,
    snapshot_diff,
)
from tidemark.operators.dedup import latest_per_key
from tidemark.operators.merge import delete, insert, update
from tidemark.plans.state import (
    FAILED,
    NO_DATA,
    SUCCESS,
    ControlLog,
    Watermarks,
    bootstrap_version,
    newer_rows,
    now,
)
from tidemark.plans.table import VersionedTable

RENAMED_TIME = "source_updated_timestamp"


class Replica(Protocol):
    keys: Sequence[str]

    def increment(self, watermark: dt.datetime, origin: str | None) -> DataFrame: ...

    def upsert(self, df: DataFrame, run_id: str) -> None: ...


@dataclass(frozen=True)
class SyncResult:
    status: str
    found: int
    written: int
    watermark: dt.datetime


def sync_out(
    table: VersionedTable,
    replica: Replica,
    state: Watermarks,
    pipeline: str,
    origin: str | None = None,
    updated_at: str = "updated_at",
    run_id: str | None = None,
    at: dt.datetime | None = None,
) -> SyncResult:
    """Bring rows changed since the watermark from the table to the replica."""
    return _sync(
        lambda watermark: newer_rows(table.as_of(), watermark, origin, updated_at),
        replica.upsert,
        replica.keys,
        state,
        pipeline,
        updated_at,
        run_id,
        at,
    )


def sync_in(
    replica: Replica,
    table: VersionedTable,
    state: Watermarks,
    pipeline: str,
    origin: str | None = None,
    updated_at: str = "updated_at",
    run_id: str | None = None,
    at: dt.datetime | None = None,
) -> SyncResult:
    """Bring rows changed since the watermark from the replica into the table."""
    newer = F.col(f"s.{updated_at}") > F.col(f"t.{updated_at}")

    def merge(df: DataFrame, _run_id: str) -> None:
        table.merge(
            df, replica.keys, [update(when=newer)], [insert()], source_unique=True, committed_at=at
        )

    return _sync(
        lambda watermark: replica.increment(watermark, origin),
        merge,
        replica.keys,
        state,
        pipeline,
        updated_at,
        run_id,
        at,
    )


def two_way_sync(
    table: VersionedTable,
    replica: Replica,
    state: Watermarks,
    pipelines: tuple[str, str],
    origins: tuple[str, str],
    updated_at: str = "updated_at",
    at: dt.datetime | None = None,
) -> tuple[SyncResult, SyncResult]:
    """Out, then in.

    Each side sends only rows of its own origin, so nothing echoes back. Where both
    changed a row, the later change wins.
    """
    out = sync_out(table, replica, state, pipelines[0], origins[0], updated_at, at=at)
    back = sync_in(replica, table, state, pipelines[1], origins[1], updated_at, at=at)
    return out, back


def _sync(
    read: Callable[[dt.datetime], DataFrame],
    write: Callable[[DataFrame, str], None],
    keys: Sequence[str],
    state: Watermarks,
    pipeline: str,
    updated_at: str,
    run_id: str | None,
    at: dt.datetime | None,
) -> SyncResult:
    """Read past the watermark, keep the latest row per key, write, then move the watermark.

    The watermark moves only after the write, so a run that fails is repeated in full
    and the guarded upsert makes the repetition harmless. The increment is read more than
    once (and again if an executor is lost): it must come from something that does not
    change meanwhile, which a table version is and a replica has to see to.
    """
    run_id = run_id or uuid.uuid4().hex[:12]
    watermark = state.get(pipeline)
    latest = None
    try:
        increment = read(watermark)
        found, newest = increment.agg(F.count(F.lit(1)), F.max(updated_at)).first()
        if not found:
            state.set(pipeline, watermark, run_id, NO_DATA, at)
            return SyncResult(NO_DATA, 0, 0, watermark)
        latest = latest_per_key(increment, keys, updated_at).persist()
        written = latest.count()
        write(latest, run_id)
        state.set(pipeline, newest, run_id, SUCCESS, at)
        return SyncResult(SUCCESS, found, written, newest)
    except Exception:
        state.set(pipeline, watermark, run_id, FAILED, at)
        raise
    finally:
        if latest is not None:
            latest.unpersist()


@dataclass(frozen=True)
class ReplicationResult:
    outcome: str
    old_version: int
    new_version: int
    changes: dict[str, int]
    applied: int


def replicate(
    source: VersionedTable,
    target: VersionedTable,
    control: ControlLog,
    pipeline: str,
    key: str,
    updated_at: str = "updated_at",
    at: dt.datetime | None = None,
    names: tuple[str, str] = ("source", "target"),
) -> ReplicationResult:
    """Carry the row changes since the last processed source version into a target.

    * no new version: nothing happens at all (``SKIPPED``);
    * a new version that alters nothing in the target: a log row only (``LOGGED``);
    * otherwise a merge and a log row (``MERGED``).

    A column that the source gained is added to the target together with the first change
    that is merged. The target keeps the source's time in ``source_updated_timestamp`` and the
    load time in ``updated_at``.
    """
    at = at or now()
    new = source.latest_version()
    old = control.last_version(pipeline)
    held = None
    if old is None:
        held = target.as_of()
        old = bootstrap_version(source.commits(), held)
        control.completed(pipeline, *names, old, at)
    if old == new:
        return ReplicationResult("SKIPPED", old, new, {}, 0)

    before, after = source.changed_between(old, new, [key])
    found = snapshot_diff(before, after, key, dedup_by=updated_at)
    found = found.withColumnRenamed(updated_at, RENAMED_TIME).persist()
    compare = [c for c in found.columns if c not in (key, CHANGE_TYPE)]
    held = target.as_of() if held is None else held
    effective = effective_changes(found, held, key, compare).persist()
    try:
        summary = {r[0]: r[1] for r in found.groupBy(CHANGE_TYPE).count().collect()}
        applied = effective.count()
        if applied:
            gained = {f.name: f.dataType.simpleString() for f in found.schema.fields if f.name in compare and f.name not in held.columns}
            if gained:
                target.add_columns(gained, committed_at=at)
            is_delete = F.col(f"s.{CHANGE_TYPE}") == DELETE
            target.merge(
                effective.withColumn("updated_at", ntz(at)),
                [key],
                matched=[delete(is_delete), update(when=~is_delete)],
                not_matched=[insert(when=~is_delete)],
                source_unique=True,
                committed_at=at,
            )
        control.completed(pipeline, *names, new, at)
        return ReplicationResult("MERGED" if applied else "LOGGED", old, new, summary, applied)
    finally:
        effective.unpersist()
        found.unpersist()
