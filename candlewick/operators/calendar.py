"""Trading calendar operators.

The calendar is the set of dates on which the index series ``sh`` has a
bar: one row per open day, so its size is bounded by the span of time, not
by the amount of data. Scalar lookups return Python dates (one tiny job
each) so that the screens can use them as literals that prune Parquet row
groups; everything else stays a DataFrame.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_LATEST = dt.date(1900, 1, 1)


def latest_day_frame(calendar: DataFrame, default=None) -> DataFrame:
    """One-row frame with the newest open day (``default`` when empty)."""
    latest = F.max("date")
    if default is not None:
        latest = F.coalesce(latest, F.lit(default))
    return calendar.agg(latest.alias("latest_day"))


def latest_day(calendar: DataFrame, default=None) -> dt.date | None:
    return latest_day_frame(calendar, default).first()["latest_day"]


def newest_bar_day(bars: DataFrame) -> dt.date | None:
    """Newest date over all codes."""
    return bars.agg(F.max("date").alias("d")).first()["d"]


def last_open_days(calendar: DataFrame, end, n: int) -> DataFrame:
    """The last n open days up to ``end`` (inclusive)."""
    return calendar.filter(F.col("date") <= F.lit(end)).orderBy(F.col("date").desc()).limit(n)


def open_day_frame(calendar: DataFrame, end, n: int) -> DataFrame:
    """The n-th last open day up to ``end``; fewer than n -> the earliest."""
    return last_open_days(calendar, end, n).agg(F.min("date").alias("open_day"))


def open_day(calendar: DataFrame, end, n: int) -> dt.date | None:
    return open_day_frame(calendar, end, n).first()["open_day"]


def open_day_lookup(calendar: DataFrame, end, ns) -> dict[int, dt.date | None]:
    """A07 for several n at once: one job that reads the last max(ns) open
    days up to ``end`` (bounded by the parameter, not by the data)."""
    ns = sorted(set(int(n) for n in ns))
    last = [r["date"] for r in last_open_days(calendar, end, ns[-1]).collect()]
    last.sort(reverse=True)
    return {n: (last[min(n, len(last)) - 1] if last else None) for n in ns}


def open_days(calendar: DataFrame, start, end) -> DataFrame:
    """Open days in [start, end]."""
    return calendar.filter(F.col("date").between(F.lit(start), F.lit(end)))


def count_open_days(calendar: DataFrame, start, end) -> int:
    return open_days(calendar, start, end).count()


def window_facts(calendar: DataFrame, start, end) -> tuple[int, dt.date | None]:
    """A08 + next open day in one small job: (open days in [start, end],
    first open day after end)."""
    r = calendar.agg(
        F.count_if(F.col("date").between(F.lit(start), F.lit(end))).alias("n"),
        F.min(F.when(F.col("date") > F.lit(end), F.col("date"))).alias("next"),
    ).first()
    return r["n"], r["next"]


def next_open_day(calendar: DataFrame, after) -> dt.date | None:
    """First open day strictly after ``after`` (Q18)."""
    return calendar.filter(F.col("date") > F.lit(after)).agg(F.min("date").alias("d")).first()["d"]


def as_of_day(calendar: DataFrame, value=None) -> dt.date | None:
    """The day a screen is evaluated for: the given one, else the newest
    open day (A05)."""
    return as_date(value) if value is not None else latest_day(calendar)


def as_date(value) -> dt.date | None:
    if value is None or isinstance(value, dt.date):
        return value
    return dt.date.fromisoformat(str(value))
