"""Partition transforms and literals."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def month_ordinal(date: Column) -> Column:
    """Months since January 1970, as int."""
    return ((F.year(date) - 1970) * 12 + F.month(date) - 1).cast("int")


def bucket_of(column: Column, buckets: int) -> Column:
    """Hash bucket in ``[0, buckets)``. The numbers are Spark's own, not portable."""
    return F.pmod(F.hash(column), F.lit(buckets)).cast("int")


def part_code(value: Column) -> Column:
    """A text that stands for a value in a folder name: ``n`` for NULL, else ``v`` and the value."""
    return F.coalesce(F.concat(F.lit("v"), value.cast("string")), F.lit("n"))


def part_value(code: Column, dtype: T.DataType) -> Column:
    """The value that ``part_code`` made a text of."""
    return F.when(code.startswith("v"), F.substring(code, 2, 2**31 - 1)).cast(dtype)


def in_month_range(
    date: Column, start: dt.date, end: dt.date, month: Column | None = None
) -> Column:
    """``start <= date < end``; also bounds the month column so that its folders prune."""
    predicate = (date >= F.lit(start)) & (date < F.lit(end))
    return predicate if month is None else predicate & in_months(month, start, end)


def in_months(month: Column, start: dt.date, end: dt.date) -> Column:
    """Whether a month, by its number, holds a day of ``start <= date < end``."""
    last_day = end - dt.timedelta(days=1)
    first = (start.year - 1970) * 12 + start.month - 1
    last = (last_day.year - 1970) * 12 + last_day.month - 1
    return month.between(first, last)


def ntz(moment: dt.datetime | str) -> Column:
    """A timestamp literal without zone, whole microseconds kept."""
    text = moment if isinstance(moment, str) else moment.isoformat(sep=" ")
    return F.lit(text).cast("timestamp_ntz")
