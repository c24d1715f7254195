"""One row per key.

``row_number() = 1`` is planned with a group limit on both sides of the shuffle, so
each task sends at most one row per key: a key that holds a third of the table
costs no more than any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK = "__rank"


def first_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], joins_on_keys: bool = False
) -> DataFrame:
    """The first row of each key.

    With ``joins_on_keys`` the result stays spread by the keys, so that a join of two
    such frames moves nothing again. Otherwise it is spread by a struct of them: a
    join with a table whose keys may be hot then gets an exchange of its own, the
    one shape in which adaptive execution splits a skewed side.
    """
    spread = list(keys) if joins_on_keys else [F.struct(*keys)]
    window = Window.partitionBy(*spread).orderBy(*order)
    return df.withColumn(_RANK, F.row_number().over(window)).where(F.col(_RANK) == 1).drop(_RANK)


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    updated_at: str = "updated_at",
    tie_break: Sequence[str] | None = None,
    joins_on_keys: bool = False,
) -> DataFrame:
    """The newest row of each key.

    Rows of equal time are told apart by ``tie_break`` (ascending). By default these
    are all other columns, so that the winner never depends on row order.
    """
    if tie_break is None:
        tie_break = [c for c in df.columns if c not in (*keys, updated_at)]
    order = [F.col(updated_at).desc(), *[F.col(c).asc() for c in tie_break]]
    return first_per_key(df, keys, order, joins_on_keys)


def priority_per_key(
    df: DataFrame,
    keys: Sequence[str],
    source: str,
    priorities: Sequence[str],
    updated_at: str = "updated_at",
    tie_break: Sequence[str] | None = None,
) -> DataFrame:
    """The row from the best-ranked source of each key; newest first within a source.

    Sources that are not listed rank last.
    """
    rank = F.lit(len(priorities))
    for place, name in reversed(list(enumerate(priorities))):
        rank = F.when(F.col(source) == name, place).otherwise(rank)
    if tie_break is None:
        tie_break = [c for c in df.columns if c not in (*keys, updated_at)]
    order = [rank, F.col(updated_at).desc(), *[F.col(c).asc() for c in tie_break]]
    return first_per_key(df, keys, order)


def duplicate_keys(df: DataFrame, keys: Sequence[str], name: str = "cnt") -> DataFrame:
    """Keys held by more than one row, most frequent first."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
    return counts.where(F.col(name) > 1).orderBy(F.col(name).desc(), *keys)
