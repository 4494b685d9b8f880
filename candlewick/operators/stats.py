"""Per-code aggregates over bars (A01-A04, A09-A24 building blocks).

All are ``groupBy(...).agg`` with map-side partial aggregation; the value
of an extreme is found together with its day through ``max_by``/``min_by``
or a struct maximum instead of joining the aggregate back to the rows (J05).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def min_max_day(bars: DataFrame, until=None) -> DataFrame:
    """Code, min_date, max_date, days (bars up to ``until`` when given)."""
    if until is not None:
        bars = bars.filter(F.col("date") <= F.lit(until))
    return bars.groupBy("code").agg(
        F.min("date").alias("min_date"), F.max("date").alias("max_date"), F.count(F.lit(1)).alias("days"))


def day_count(bars: DataFrame, until=None) -> DataFrame:
    """Code, num_days."""
    if until is not None:
        bars = bars.filter(F.col("date") <= F.lit(until))
    return bars.groupBy("code").agg(F.count(F.lit(1)).alias("num_days"))


def _in_range(bars: DataFrame, start, end) -> DataFrame:
    return bars.filter(F.col("date").between(F.lit(start), F.lit(end)))


def max_close_last_day(bars: DataFrame, start, end) -> DataFrame:
    """Highest close in [start, end] and the last day it was reached."""
    return _in_range(bars, start, end).groupBy("code").agg(
        F.max(F.struct("close", "date")).alias("m")).select("code", F.col("m.date").alias("date"),
                                                             F.col("m.close").alias("close"))


def max_close_first_day(bars: DataFrame, start, end) -> DataFrame:
    """A04 (Q01, the form the reference computes): highest close, first day."""
    neg_day = -F.unix_date("date")
    return _in_range(bars, start, end).groupBy("code").agg(
        F.max(F.struct(F.col("close"), neg_day.alias("nd"), F.col("date"))).alias("m")
    ).select("code", F.col("m.date").alias("date"), F.col("m.close").alias("close"))


def min_close_first_day(bars: DataFrame, start, end) -> DataFrame:
    """A04 (Q01, the named intent): lowest close and the first day reached."""
    return _in_range(bars, start, end).groupBy("code").agg(
        F.min(F.struct("close", "date")).alias("m")).select("code", F.col("m.date").alias("date"),
                                                             F.col("m.close").alias("close"))


def monotone_codes(extremes: DataFrame) -> DataFrame:
    """Codes whose extremes are in rising order: for every extreme the
    rank by close desc equals the rank by date desc."""
    return (
        extremes.groupBy("code")
        .agg(F.count_if(F.col("rank") == F.col("date_rank")).alias("n_eq"), F.max("rank").alias("n"))
        .filter(F.col("n_eq") == F.col("n")).select("code")
    )


def amplitude(high: str = "high", low: str = "low") -> Column:
    """(max(high) - min(low)) / min(low) as an aggregate expression."""
    return F.try_divide(F.max(high) - F.min(low), F.min(low))


def value_on(day, col: str) -> Column:
    """Conditional max used as a pivot: the column's value on ``day``."""
    return F.max(F.when(F.col("date") == F.lit(day), F.col(col)))
