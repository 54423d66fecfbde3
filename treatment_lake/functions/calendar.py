"""Calendar and clock expressions, all native (codegen) column expressions.

Keys are derived, never numbered: a date's key is its yyyymmdd integer and
a time of day's key is its second of the day. The same expression is used
on the dimension side and the fact side, so keys agree across re-runs and
incremental batches without a lookup.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def date_key(c: ColumnOrName) -> Column:
    """yyyymmdd as INT; NULL stays NULL."""
    d = F.to_date(_c(c))
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def second_of_day(c: ColumnOrName) -> Column:
    """hour*3600 + minute*60 + whole second, as INT; NULL stays NULL."""
    ts = _c(c)
    return (F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)).cast("int")


def epoch_seconds(c: ColumnOrName) -> Column:
    """Whole seconds since 1970-01-01 00:00:00 of a wall-clock timestamp.

    Computed from the calendar day and the second of the day, so the
    result does not depend on the session time zone.
    """
    ts = _c(c)
    days = F.datediff(F.to_date(ts), F.lit("1970-01-01").cast("date")).cast("long")
    return days * F.lit(86400).cast("long") + second_of_day(ts).cast("long")


def day_name(c: ColumnOrName) -> Column:
    """Full English weekday name, trimmed (Monday ... Sunday)."""
    return F.date_format(_c(c), "EEEE")


def month_name(c: ColumnOrName) -> Column:
    """Full English month name, trimmed (January ... December)."""
    return F.date_format(_c(c), "MMMM")


def is_weekend(c: ColumnOrName) -> Column:
    """Saturday or Sunday; NULL date gives FALSE."""
    return F.coalesce(F.dayofweek(_c(c)).isin(1, 7), F.lit(False))


def calendar_columns(c: ColumnOrName) -> list[Column]:
    """date_sk, date, day_of_week, month, quarter, year, is_weekend of a DATE column."""
    d = _c(c)
    return [
        date_key(d).alias("date_sk"),
        d.alias("date"),
        day_name(d).alias("day_of_week"),
        month_name(d).alias("month"),
        F.quarter(d).cast("int").alias("quarter"),
        F.year(d).cast("int").alias("year"),
        is_weekend(d).alias("is_weekend"),
    ]


def time_columns_from_key(c: ColumnOrName) -> list[Column]:
    """time_sk, hours, minutes, seconds from a second-of-day key."""
    k = _c(c)
    return [
        k.alias("time_sk"),
        (k / 3600).cast("int").alias("hours"),
        ((k % 3600) / 60).cast("int").alias("minutes"),
        (k % 60).cast("int").alias("seconds"),
    ]
