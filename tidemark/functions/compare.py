"""The ways two versions of a column are compared."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

NULL_MODES = ("safe", "empty", "plain")


def differs(old: Column, new: Column, dtype: T.DataType, nulls: str = "safe") -> Column:
    """True where the values count as different; never NULL.

    ``safe``:  NULL equals NULL and differs from everything else.
    ``empty``: strings compare with NULL as ``''``; for other types a NULL on
               either side is no difference.
    ``plain``: a NULL on either side is no difference, whatever the type.
    """
    if nulls == "safe":
        return ~old.eqNullSafe(new)
    if nulls == "empty" and isinstance(dtype, T.StringType):
        return F.coalesce(old, F.lit("")) != F.coalesce(new, F.lit(""))
    if nulls in ("empty", "plain"):
        return F.coalesce(old != new, F.lit(False))
    raise ValueError(f"nulls must be one of {NULL_MODES}, not {nulls!r}")
