"""Time-range predicates."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F


def as_datetime(moment) -> datetime:
    """A datetime from a datetime, a date or ISO text."""
    if isinstance(moment, datetime):
        return moment
    return datetime.fromisoformat(str(moment))


def between_times(df: DataFrame, lo, hi, include_hi: bool = False) -> DataFrame:
    """Rows with `lo <= event_time < hi` (`<= hi` with `include_hi`), in session time.

    With a `dt` column the rows are also bounded by date: on an archive partitioned by `dt`
    that prunes the partitions. One day of slack on both sides keeps it right when the
    archive was written under another time zone.
    """
    return _between(df, timestamp(lo), timestamp(hi), include_hi)


def on_day_until(df: DataFrame, moment) -> DataFrame:
    """Rows from the session's midnight before `moment` until `moment`, which is included."""
    end = timestamp(moment)
    return _between(df, F.date_trunc("day", end), end, include_hi=True)


def timestamp(moment) -> Column:
    """The moment; one without a time zone is in that of the session."""
    return F.lit(as_datetime(moment).isoformat(" ")).cast("timestamp")


def _between(df: DataFrame, lo: Column, hi: Column, include_hi: bool) -> DataFrame:
    event_time = F.col("event_time")
    rows = df.filter(event_time >= lo)
    rows = rows.filter(event_time <= hi if include_hi else event_time < hi)
    if "dt" in df.columns:
        rows = rows.filter(F.col("dt").between(F.date_sub(lo, 1), F.date_add(hi, 1)))
    return rows
