"""Differences between versions of a table, and applying them elsewhere."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import differs, ntz
from tidemark.operators.dedup import latest_per_key, priority_per_key
from tidemark.operators.merge import delete, delete_matching, insert, merge_into, update

INSERT, UPDATE, DELETE = "INSERT", "UPDATE", "DELETE"
CHANGE_TYPE = "change_type"
COPIES = "copies"


def snapshot_diff(
    old: DataFrame,
    new: DataFrame,
    key: str,
    dedup_by: str | None = "updated_at",
    compare: Sequence[str] | None = None,
    nulls: str = "safe",
    tie_break: Sequence[str] | None = None,
) -> DataFrame:
    """What turns ``old`` into ``new``, one row per changed key.

    Both sides are first reduced to the latest row per key by ``dedup_by``. With None, keys
    must not repeat: the query fails if one does (see ``raw_diff`` for keys that do). A DELETE
    row carries the key alone. A NULL key matches nothing and stays out of the join. Dedup,
    check and join share one shuffle per side.
    """
    if dedup_by is not None:
        old = latest_per_key(old, [key], dedup_by, tie_break, joins_on_keys=True)
        new = latest_per_key(new, [key], dedup_by, tie_break, joins_on_keys=True)
    compare = list(compare or [c for c in new.columns if c != key])
    types = {f.name: f.dataType for f in new.schema.fields}
    # A column that came later is NULL on the old side.
    there = [F.col(c) if c in old.columns else F.lit(None).cast(types[c]).alias(c) for c in compare]
    was, is_now = old.where(F.col(key).isNotNull()), new.where(F.col(key).isNotNull())
    if dedup_by is None:
        was, is_now = _checked(was, key), _checked(is_now, key)
    o = was.select(key, *there).withColumn("__held", F.lit(True)).alias("o")
    n = is_now.withColumn("__held", F.lit(True)).alias("n")
    in_old, in_new = F.col("o.__held").isNotNull(), F.col("n.__held").isNotNull()

    changed = ~in_old | ~in_new
    for c in compare:
        changed = changed | differs(F.col(f"o.{c}"), F.col(f"n.{c}"), types[c], nulls)
    kind = F.when(~in_old, INSERT).when(~in_new, DELETE).otherwise(UPDATE)
    others = [c for c in new.columns if c != key]
    joined = (
        o.join(n, F.col(f"o.{key}") == F.col(f"n.{key}"), "full_outer")
        .where(changed)
        .select(
            kind.alias(CHANGE_TYPE),
            F.coalesce(F.col(f"n.{key}"), F.col(f"o.{key}")).alias(key),
            *[F.col(f"n.{c}").alias(c) for c in others],
        )
    )
    gone = old.where(F.col(key).isNull()).select(
        F.lit(DELETE).alias(CHANGE_TYPE), key, *[F.lit(None).cast(types[c]).alias(c) for c in others]
    )
    came = new.where(F.col(key).isNull()).select(F.lit(INSERT).alias(CHANGE_TYPE), key, *others)
    return joined.unionByName(gone).unionByName(came)


def _checked(df: DataFrame, key: str) -> DataFrame:
    """The same rows; the query fails at a second row of a key. Spread and sorted as a join needs it."""
    place = F.row_number().over(Window.partitionBy(key).orderBy(key))
    message = F.concat(F.lit(f"{key} repeats: "), F.col(key).cast("string"))
    once = F.when(F.col("__place") > 1, F.raise_error(message).cast("boolean")).otherwise(True)
    return df.withColumn("__place", place).where(once).drop("__place")


def raw_diff(
    old: DataFrame,
    new: DataFrame,
    key: str,
    compare: Sequence[str] | None = None,
    nulls: str = "empty",
) -> DataFrame:
    """The diff without dedup, where a repeated key compares every old with every new row.

    Those pairs are counted, never built: ``copies`` says how many differing pairs
    have this new row. A new row differs from all old rows of its key except those
    that compare equal, and both numbers come from group counts.

    With ``nulls="empty"`` a column that is not text passes as equal where either side is NULL. So
    rows meet once for each pattern of NULLs that the other side has under their key, on
    the columns that neither pattern leaves out. A key with one pattern and no NULL text needs
    no such meeting: its rows are exchanged twice, those of other keys four times. Both tables
    are read once, and no step needs all rows of a key in one task.
    """
    if nulls not in ("safe", "empty"):
        raise ValueError("raw_diff compares with nulls='safe' or nulls='empty'")
    compare = list(compare or [c for c in new.columns if c != key])
    types = {f.name: f.dataType for f in new.schema.fields}
    texts = [c for c in compare if nulls == "empty" and isinstance(types[c], T.StringType)]
    loose = [c for c in compare if nulls == "empty" and c not in texts]
    others = [c for c in new.columns if c != key and c not in compare]

    def pattern(columns: Sequence[str]) -> Column:
        """The places of the columns that are NULL: empty for most rows."""
        marks = [F.when(F.col(c).isNull(), f",{i},").otherwise("") for i, c in enumerate(columns)]
        return F.concat(*marks) if marks else F.lit("")

    def side(df: DataFrame, is_new: bool) -> DataFrame:
        values = [(F.coalesce(F.col(c), F.lit("")) if c in texts else F.col(c)).alias(f"__{c}") for c in compare]
        # What a new row has beyond what is compared.
        own = [F.col(c) if is_new else F.lit(None).cast(types[c]).alias(c) for c in others]
        return df.select(
            key,
            *values,
            pattern(loose).alias("__nulls"),
            (pattern(texts) if is_new else F.lit("")).alias("__texts"),
            *own,
            F.lit(int(not is_new)).alias("__old"),
            F.lit(int(is_new)).alias("__new"),
        )

    both = side(old, False).unionByName(side(new, True))
    counted = [F.sum("__old").alias("__old"), F.sum("__new").alias("__new")]
    rows = both.groupBy(*[c for c in both.columns if c not in ("__old", "__new")]).agg(*counted)
    # What a key holds. Grouped by a struct, so that the join gets an exchange of its own to split;
    # it matches NULLs, which keeps both its sides the same scan.
    keys = rows.groupBy(F.struct(key).alias("__k")).agg(
        F.sum("__old").alias("__olds"),
        F.sum("__new").alias("__news"),
        F.min("__nulls").alias("__low"),
        F.collect_set(F.when(F.col("__nulls") != "", F.col("__nulls"))).alias("__marked"),
        F.max("__texts").alias("__worded"),
    )
    keys = keys.select(F.col(f"__k.{key}").alias("__key"), "__olds", "__news", "__low", "__marked", "__worded")
    columns = [key, *[c for c in new.columns if c != key]]

    # Old rows of a key without new ones, or of the NULL key, which faces nobody. The last condition
    # always holds: it asks for all of the sums, so that they are exchanged once.
    alone = F.col("__key").isNull() | (F.col("__news") == 0)
    summed = F.col("__low").isNotNull() & F.col("__worded").isNotNull() & (F.size("__marked") >= 0)
    gone = keys.where((F.col("__olds") > 0) & alone & summed).select(
        F.lit(DELETE).alias(CHANGE_TYPE),
        F.col("__key").alias(key),
        *[F.lit(None).cast(types[c]).alias(c) for c in columns if c != key],
        F.col("__olds").alias(COPIES),
    )

    # Every row finds its key; as an outer join it takes no filter, so that what follows shares it.
    met = rows.join(keys, F.col(key).eqNullSafe(F.col("__key")), "left").where(F.coalesce("__news", F.lit(1)) > 0)
    facing = F.when(F.col(key).isNotNull(), F.col("__olds")).otherwise(0)
    one = F.when(F.col("__low") == "", F.size("__marked") == 0).otherwise(F.size("__marked") == 1)
    plain = one & (F.col("__worded") == "") & F.lit(not others)

    def found(frame: DataFrame, value, new_rows: Column, faced: Column, equal: Column) -> DataFrame:
        copies = F.when(faced > 0, new_rows * (faced - equal)).otherwise(new_rows)
        return frame.select(
            F.when(faced > 0, UPDATE).otherwise(INSERT).alias(CHANGE_TYPE),
            *[F.col(key) if c == key else value(c).alias(c) for c in columns],
            copies.alias(COPIES),
        ).where(F.col(COPIES) > 0)

    # Under one pattern of NULLs a new row equals the old rows that were grouped with it.
    simple = met.where(F.coalesce(plain & (F.col("__nulls") == F.col("__low")) & (F.col("__texts") == ""), F.lit(True)))
    simple = found(simple, lambda c: F.col(f"__{c}" if c in compare else c).cast(types[c]), F.col("__new"), facing, F.col("__old"))

    # Other rows take part as new and as old ones, against each pattern under their key.
    marked = F.when(F.col("__low") == "", F.concat(F.array(F.lit("")), F.col("__marked"))).otherwise(F.col("__marked"))
    mixed = met.where(~F.coalesce(plain, F.lit(False))).withColumn("__faced", facing)
    mixed = mixed.withColumn("__theirs", F.explode(marked))
    as_new, as_old = F.when(F.col("__new") > 0, F.lit(True)), F.when(F.col("__old") > 0, F.lit(False))
    mixed = mixed.withColumn("__as_new", F.explode(F.array_compact(F.array(as_new, as_old))))
    mine, theirs = F.col("__nulls"), F.col("__theirs")
    old_nulls, new_nulls = F.when(F.col("__as_new"), theirs).otherwise(mine), F.when(F.col("__as_new"), mine).otherwise(theirs)
    left_out = F.concat(mine, theirs)
    seen = [
        F.when(~left_out.contains(f",{loose.index(c)},"), F.col(f"__{c}")).alias(f"__{c}") if c in loose else F.col(f"__{c}")
        for c in compare
    ]
    group = Window.partitionBy(F.struct(key, old_nulls.alias("old_nulls"), new_nulls.alias("new_nulls"), *seen))
    told = mixed.withColumn("__equal", F.sum(F.when(~F.col("__as_new"), F.col("__old")).otherwise(0)).over(group))

    # One row for each new row, over the patterns it met.
    def shown(c: str) -> Column:
        value = F.col(c) if c in others else F.col(f"__{c}")
        if c in texts:
            value = F.when(~F.col("__texts").contains(f",{texts.index(c)},"), value)
        return value.cast(types[c]).alias(c)

    row = F.struct(key, *[shown(c) for c in columns if c != key])
    own = F.sum(F.when(mine == theirs, F.col("__new")))
    over = told.where("__as_new").groupBy(row.alias("__row")).agg(
        F.max("__faced").alias("__faced"), F.sum("__equal").alias("__equal"), own.alias("__own")
    )
    over = over.select(*[F.col(f"__row.{c}").alias(c) for c in columns], "__faced", "__equal", "__own")
    over = found(over, F.col, F.col("__own"), F.col("__faced"), F.col("__equal"))
    return simple.unionByName(over).unionByName(gone)


def change_summary(changes: DataFrame, name: str = "count") -> DataFrame:
    return changes.groupBy(CHANGE_TYPE).agg(F.count(F.lit(1)).alias(name))


def effective_changes(
    changes: DataFrame, target: DataFrame, key: str, compare: Mapping[str, str] | Sequence[str]
) -> DataFrame:
    """Only the changes that would alter the target.

    A DELETE counts if the key is there; anything else if the key is missing or a
    compared column differs (NULL equals NULL) in any row of that key. ``compare`` lists
    columns, or maps columns of the changes to those of the target; a column that the
    target lacks is NULL there.
    """
    pairs = dict(compare) if isinstance(compare, Mapping) else {c: c for c in compare}
    types = {f.name: f.dataType for f in changes.schema.fields}
    held = target.select(
        key,
        *[
            (F.col(c) if c in target.columns else F.lit(None).cast(types[mine])).alias(c)
            for c, mine in {theirs: mine for mine, theirs in pairs.items()}.items()
        ],
    )
    altered = F.lit(False)
    for mine, theirs in pairs.items():
        altered = altered | ~F.col(f"t.{theirs}").eqNullSafe(F.col(f"c.{mine}"))
    # One mark a key, so that a key the target repeats does not repeat its change.
    marks = (
        changes.alias("c")
        .join(held.alias("t"), F.col(f"c.{key}") == F.col(f"t.{key}"))
        .groupBy(F.col(f"c.{key}").alias("__key"))
        .agg(F.max(altered).alias("__altered"))
    )
    is_delete = F.col(f"c.{CHANGE_TYPE}") == DELETE
    is_held = F.col("m.__key").isNotNull()
    return (
        changes.alias("c")
        .join(marks.alias("m"), F.col(f"c.{key}") == F.col("m.__key"), "left")
        .where((is_delete & is_held) | (~is_delete & (~is_held | F.col("m.__altered"))))
        .select("c.*")
    )


def apply_changes(
    target: DataFrame, changes: DataFrame, key: str, source_unique: bool = False
) -> DataFrame:
    """The target after the changes.

    The change type speaks about the source, not the target: an INSERT of a present
    key updates it, an UPDATE of a missing key inserts it.
    """
    is_delete = F.col(f"s.{CHANGE_TYPE}") == DELETE
    return merge_into(
        target,
        changes,
        [key],
        matched=[delete(is_delete), update(when=~is_delete)],
        not_matched=[insert(when=~is_delete)],
        source_unique=source_unique,
    )


def version_history(
    versions: DataFrame, key: str, version: str = "version", latest: int | None = None
) -> DataFrame:
    """Every version of every row, marked active (in the latest version) or deleted.

    ``is_deleted`` marks the last known row of a key the latest version lacks.
    """
    if latest is None:
        latest = versions.agg(F.max(version)).first()[0]
    # Grouped by a struct, so that the join gets an exchange of its own to split.
    last = versions.groupBy(F.struct(key).alias("__k")).agg(F.max(version).alias("__last"))
    last = last.select(F.col(f"__k.{key}").alias("__key"), "__last")
    is_last = F.col(version) == F.col("__last")
    return versions.join(last, F.col(key).eqNullSafe(F.col("__key"))).select(
        *versions.columns,
        (F.col(version) == F.lit(latest)).alias("is_active"),
        (is_last & (F.col("__last") < F.lit(latest))).alias("is_deleted"),
    )


def compare_versions(
    old: DataFrame,
    current: DataFrame,
    key: str,
    column: str,
    dedup_by: str | None = "updated_at",
) -> DataFrame:
    """Rows held by both versions whose column differs; NULL on a side is no difference.

    As in ``snapshot_diff``, None for ``dedup_by`` is for keys that do not repeat, and the query
    fails if one does. A NULL key matches nothing.
    """
    old, current = (df.where(F.col(key).isNotNull()) for df in (old, current))
    if dedup_by is not None:
        old = latest_per_key(old, [key], dedup_by, joins_on_keys=True)
        current = latest_per_key(current, [key], dedup_by, joins_on_keys=True)
    else:
        old, current = _checked(old, key), _checked(current, key)
    before = old.select(key, F.col(column).alias(f"old_{column}"))
    now = current.select(key, F.col(column).alias(f"current_{column}"))
    return (
        now.join(before, key)
        .where(F.col(f"current_{column}") != F.col(f"old_{column}"))
        .select(key, f"old_{column}", f"current_{column}")
    )


def initial_replica(
    source: DataFrame,
    key: str,
    run_at: dt.datetime | str,
    updated_at: str = "updated_at",
    tie_break: Sequence[str] | None = None,
) -> DataFrame:
    """The first load of a replica: latest row per key, source time kept, load time added."""
    return (
        latest_per_key(source, [key], updated_at, tie_break)
        .withColumnRenamed(updated_at, "source_updated_timestamp")
        .withColumn("updated_at", ntz(run_at))
    )


def apply_corrections(
    target: DataFrame,
    corrections: DataFrame,
    deletes: DataFrame,
    key: str,
    source: str,
    priorities: Sequence[str],
) -> DataFrame:
    """Merge the best correction per key, then remove the listed keys."""
    best = priority_per_key(corrections, [key], source, priorities)
    merged = merge_into(target, best, [key], [update()], [insert()], source_unique=True)
    return delete_matching(merged, deletes, [key])
