"""Days between a fixed reference date and a user's latest activity."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

AsOf = dt.date | str | Column


def as_of_today(offset_days: int) -> Column:
    """Today minus ``offset_days``. Results then change from day to day."""
    return F.date_sub(F.current_date(), offset_days)


def as_of_date(as_of: AsOf) -> Column:
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, str):
        as_of = dt.date.fromisoformat(as_of)
    return F.lit(as_of)


def epoch_day(seconds: Column) -> Column:
    """Calendar day of an epoch-second value in the session time zone; null if unreadable."""
    return F.from_unixtime(seconds.try_cast("bigint"), "yyyy-MM-dd").try_cast("date")


def text_day(text: Column) -> Column:
    """Calendar day of a text value that starts with ``yyyy-MM-dd``; null if unreadable."""
    return F.substring(text, 1, 10).try_cast("date")


def recency_days(day: Column, as_of: AsOf) -> Column:
    return F.datediff(as_of_date(as_of), day)
