"""Report period predicates."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

DateLike = dt.date | str


def _date(d: DateLike) -> Column:
    return F.lit(str(d)).cast("date")


def closed_dates(col: str | Column, start: DateLike, end: DateLike, plus_one_day: bool = False) -> Column:
    """``col BETWEEN start AND end`` on a date column.

    ``plus_one_day`` reproduces release 1.0.0, whose closing bound is
    ``end + 1 day`` (it also counts the next day's donations).
    """
    c = F.col(col) if isinstance(col, str) else col
    hi = F.date_add(_date(end), 1) if plus_one_day else _date(end)
    return c.between(_date(start), hi)


def timestamp_period(col: str | Column, start: DateLike, end: DateLike, half_open: bool = False) -> Column:
    """``col BETWEEN start AND end + 1 day`` on a timestamp column.

    The reference's bound includes midnight of the day after ``end``;
    ``half_open=True`` excludes it.  Both bounds are constants, so the
    predicate reaches the Parquet scan as a pushed filter.
    """
    c = F.col(col) if isinstance(col, str) else col
    lo = _date(start).cast("timestamp_ntz")
    hi = F.date_add(_date(end), 1).cast("timestamp_ntz")
    if half_open:
        return (c >= lo) & (c < hi)
    return c.between(lo, hi)
