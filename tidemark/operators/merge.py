"""Row-level changes as joins.

A merge is two joins, not one full outer join:

* target left join source - updates and deletes. With a small source Spark
  broadcasts it and the target is never shuffled; with a large one the target is the
  streamed side, whose hot keys adaptive execution can split (it cannot do that for
  a full outer join);
* source left anti join target keys - inserts.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.dedup import first_per_key

_COPY = "__copy"
_ACTION = "__action"
_KEY = "__key"


@dataclass(frozen=True)
class Clause:
    """One arm of a merge. ``when`` and values may use columns ``t.x`` and ``s.x``."""

    kind: str
    when: Column | None = None
    values: Mapping[str, Column] | Sequence[str] | None = field(default=None)


def update(values=None, when: Column | None = None) -> Clause:
    """Set columns of a matched row: a list of names to copy, or a name-to-value map.

    Without ``values`` every column the source also has is copied.
    """
    return Clause("update", when, values)


def delete(when: Column | None = None) -> Clause:
    return Clause("delete", when)


def insert(values=None, when: Column | None = None) -> Clause:
    """Add an unmatched source row; columns not given become NULL."""
    return Clause("insert", when, values)


def update_where(df: DataFrame, predicate: Column, values: Mapping[str, object]) -> DataFrame:
    """Set columns where the predicate is true. All values see the old row."""
    types = {f.name: f.dataType for f in df.schema.fields}
    changed = {}
    for name, value in values.items():
        column = value if isinstance(value, Column) else F.lit(value)
        changed[name] = F.when(predicate, column.cast(types[name])).otherwise(F.col(name))
    return df.withColumns(changed)


def delete_matching(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key is not listed. Rows with a NULL key stay."""
    return df.join(_distinct_keys(keys, on), list(on), "left_anti")


def insert_if_absent(
    target: DataFrame, source: DataFrame, on: Sequence[str], order: Sequence[Column] | None = None
) -> DataFrame:
    """Target plus one source row for each key it lacks.

    Of several source rows with one key, the first by ``order`` goes in (by
    default in order of all columns).
    """
    rest = [F.col(c) for c in source.columns if c not in on]
    single = first_per_key(source, on, order or rest or [F.col(on[0])])
    return merge_into(target, single, on, not_matched=[insert()], source_unique=True)


def upsert(
    target: DataFrame,
    source: DataFrame,
    on: Sequence[str],
    newer_than: str | None = None,
    source_unique: bool = False,
) -> DataFrame:
    """Insert or overwrite by key; with ``newer_than`` only a later value overwrites."""
    when = None if newer_than is None else F.col(f"s.{newer_than}") > F.col(f"t.{newer_than}")
    return merge_into(
        target, source, on, [update(when=when)], [insert()], source_unique=source_unique
    )


def merge_into(
    target: DataFrame,
    source: DataFrame,
    on: Sequence[str],
    matched: Sequence[Clause] = (),
    not_matched: Sequence[Clause] = (),
    source_unique: bool = False,
) -> DataFrame:
    """The target after a merge. The first clause whose condition is true applies.

    A condition that is NULL does not hold. NULL keys match nothing. The plan fails if
    two source rows match one target row; ``source_unique=True`` skips that check
    for sources already reduced to one row per key. The result has the target's
    columns and types. The source is read once per kind of clause: persist it if it
    is costly.
    """
    for clause in matched:
        if clause.kind not in ("update", "delete"):
            raise ValueError(f"{clause.kind} is not allowed for matched rows")
    for clause in not_matched:
        if clause.kind != "insert":
            raise ValueError(f"{clause.kind} is not allowed for rows without a match")
    on = list(on)
    merged = target
    if matched:
        merged = _matched_part(target, source, on, matched, source_unique)
    if not_matched:
        merged = merged.unionByName(
            _inserted_part(target, source, on, not_matched, source_unique)
        )
    return merged


def _matched_part(target, source, on, clauses, source_unique):
    # A NULL key matches nothing and would only gather in one task.
    rows = source
    for k in on:
        rows = rows.where(F.col(k).isNotNull())
    if not source_unique:
        # Two rows of a key are enough to prove that it repeats. Partitioning by a
        # struct leaves the join its own exchange, which can be split when skewed.
        window = Window.partitionBy(F.struct(*on)).orderBy(*on)
        rows = rows.withColumn(_COPY, F.row_number().over(window)).where(F.col(_COPY) <= 2)
    else:
        rows = rows.withColumn(_COPY, F.lit(1))
    same_key = [F.col(f"t.{k}") == F.col(f"s.{k}") for k in on]
    joined = target.alias("t").join(rows.alias("s"), same_key, "left")

    hit = F.col(_COPY).isNotNull()
    action = F.lit(None).cast("int")
    for place, clause in reversed(list(enumerate(clauses))):
        holds = hit if clause.when is None else hit & clause.when
        action = F.when(holds, place).otherwise(action)
    if not source_unique:
        message = F.lit("more than one source row matches a target row")
        action = F.when(F.col(_COPY) == 2, F.raise_error(message).cast("int")).otherwise(action)

    deletes = [i for i, c in enumerate(clauses) if c.kind == "delete"]
    columns = []
    for f in target.schema.fields:
        value = F.col(f"t.{f.name}")
        for place, clause in enumerate(clauses):
            if clause.kind == "update":
                given = _values(clause, source, target, on)
                if f.name in given:
                    value = F.when(F.col(_ACTION) == place, given[f.name].cast(f.dataType)).otherwise(
                        value
                    )
        columns.append(value.alias(f.name))
    acted = joined.withColumn(_ACTION, action)
    # The action is read here in every case, so that the check cannot be pruned away.
    kept = F.coalesce(~F.col(_ACTION).isin(deletes), F.lit(True)) if deletes else (
        F.coalesce(F.col(_ACTION), F.lit(-1)) >= -1
    )
    return acted.where(kept).select(*columns)


def _inserted_part(target, source, on, clauses, source_unique):
    held = held_keys(target, source, on, source_unique)
    lone = source.join(held, on, "left_anti").select(*source.columns)
    chosen = F.lit(None).cast("int")
    for place, clause in reversed(list(enumerate(clauses))):
        holds = F.lit(True) if clause.when is None else clause.when
        chosen = F.when(holds, place).otherwise(chosen)
    columns = []
    for f in target.schema.fields:
        value = F.lit(None).cast(f.dataType)
        for place, clause in enumerate(clauses):
            given = _values(clause, source, target, [])
            if f.name in given:
                value = F.when(F.col(_ACTION) == place, given[f.name].cast(f.dataType)).otherwise(value)
        columns.append(value.alias(f.name))
    acted = lone.alias("s").withColumn(_ACTION, chosen).where(F.col(_ACTION).isNotNull())
    return acted.select(*columns)


def held_keys(target, source, on, source_unique):
    """Keys of the target that the source has, for an anti join of the source.

    Cut down to them before anything is made distinct; a small source is broadcast for that.
    """
    keys = target.select(*on).join(source.select(*on).distinct(), on, "left_semi")
    if source_unique:
        return keys.distinct()
    # A source key may be hot: leave the join its own exchange (see _matched_part).
    return keys.select(F.struct(*on).alias(_KEY)).distinct().select(f"{_KEY}.*")


def _distinct_keys(df, on):
    keys = df.select(*on).distinct()
    for k in on:
        keys = keys.where(F.col(k).isNotNull())
    return keys


def _values(clause, source, target, keys):
    given = clause.values
    if given is None:
        given = [c for c in target.columns if c in source.columns and c not in keys]
    if isinstance(given, Mapping):
        return {k: v if isinstance(v, Column) else F.lit(v) for k, v in given.items()}
    return {c: F.col(f"s.{c}") for c in given}
