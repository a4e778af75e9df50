"""Calendar rules: day numbers (``yyyyMMdd``), run ranges and baseline windows.

Everything is a Column expression. Applied to a literal, Catalyst folds it to a
constant, so a range built here still prunes partitions.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

DAY_FORMAT = "yyyyMMdd"

# Fixed value: days before a run that its baseline covers.
TRAILING_DAYS = 30


def parse_day(day: int | str | dt.date) -> dt.date:
    """A run argument as a date; an impossible day (20180230) is an error, not a roll-over."""
    if isinstance(day, dt.date):
        return day
    text = str(day)
    if len(text) != 8 or not text.isdigit():
        raise ValueError(f"expected a day as yyyyMMdd, got {day!r}")
    try:
        return dt.date(int(text[:4]), int(text[4:6]), int(text[6:]))
    except ValueError as exc:
        raise ValueError(f"no such day: {day!r}") from exc


def run_range(start, end, max_days: int | None = None) -> tuple[dt.date, dt.date]:
    """Validated (first, last) day of a run. A reversed range is legal and holds no days.

    A range is as long as asked for, unless ``max_days`` limits it.
    """
    first, last = parse_day(start), parse_day(end)
    if max_days is not None and (last - first).days + 1 > max_days:
        raise ValueError(f"{first}..{last} is longer than the allowed {max_days} days")
    return first, last


def day_runs(days: Sequence[int]) -> list[tuple[dt.date, dt.date]]:
    """Sorted ``yyyyMMdd`` numbers as the fewest (first, last) ranges that hold just these days."""
    found: list[tuple[dt.date, dt.date]] = []
    for day in map(parse_day, days):
        if found and (day - found[-1][1]).days <= 1:
            found[-1] = found[-1][0], day
        else:
            found.append((day, day))
    return found


def date_of(day: Column) -> Column:
    """``yyyyMMdd`` number or text to a date; NULL where there is no such day."""
    return F.try_to_date(day.cast("string"), DAY_FORMAT)


def day_of(date: Column) -> Column:
    """A date or timestamp to its ``yyyyMMdd`` number, by integer arithmetic."""
    return F.year(date) * 10000 + F.month(date) * 100 + F.dayofmonth(date)


def day_sequence(first: Column, last: Column) -> Column:
    """Inclusive array of dates; empty when ``first > last`` (``sequence`` would count down)."""
    return F.when(first <= last, F.sequence(first, last)).otherwise(
        F.array().cast(T.ArrayType(T.DateType()))
    )


def trailing_window(start: Column, end: Column | None = None) -> tuple[Column, Column]:
    """The 30 days before a day; with ``end``, the days before any day of a run."""
    return F.date_sub(start, TRAILING_DAYS), F.date_sub(start if end is None else end, 1)


def year_ago_month(start: Column, end: Column | None = None) -> tuple[Column, Column]:
    """First and last day of the month one year earlier; with ``end``, of all a run's months."""
    last = start if end is None else end
    return F.trunc(F.add_months(start, -12), "MM").cast("date"), F.last_day(F.add_months(last, -12))


def column_windows(start: Column, end: Column | None = None) -> list[tuple[Column, Column]]:
    """Baseline windows of the column-consistency check."""
    return [trailing_window(start, end)]


def total_windows(start: Column, end: Column | None = None) -> list[tuple[Column, Column]]:
    """Baseline windows of the total-consistency check."""
    return [year_ago_month(start, end), trailing_window(start, end)]


def partition_between(name: str, dtype: T.DataType, first: Column, last: Column) -> Column:
    """Rows of a date-partitioned table between two dates, on the raw partition column.

    The column itself stays bare on the left, so the predicate prunes partitions
    (or reaches Parquet row groups) whether days are stored as numbers, text,
    dates or timestamps.
    """
    column = F.col(name)
    if isinstance(dtype, T.DateType):
        return column.between(first, last)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        kind = dtype.typeName()
        return (column >= first.cast(kind)) & (column < F.date_add(last, 1).cast(kind))
    if isinstance(dtype, (T.StringType, T.IntegralType)):
        numbered = column.between(day_of(first).cast(dtype), day_of(last).cast(dtype))
        if isinstance(dtype, T.IntegralType):
            return numbered
        # Text days have dashes or not; as text, days of one form lie outside any range of the other.
        return numbered | column.between(first.cast("string"), last.cast("string"))
    raise ValueError(f"{name}: cannot partition days by a {dtype.simpleString()} column")


def partition_in(name: str, dtype: T.DataType, windows) -> Column:
    """Rows inside any of several (first, last) windows."""
    return reduce(or_, [partition_between(name, dtype, a, b) for a, b in windows])


def partition_day(name: str, dtype: T.DataType) -> Column:
    """The ``yyyyMMdd`` number of a row's partition."""
    column = F.col(name)
    if isinstance(dtype, T.StringType):
        return F.replace(column, F.lit("-"), F.lit("")).cast("int")
    if isinstance(dtype, T.IntegralType):
        return column.cast("int")
    return day_of(column)
