"""Per-code window operators over bars.

Every window here partitions by ``code``: one Exchange on code and one Sort
by (code, date) serve all frames of a call (W08). A code's series is one
bar per open day, so a window partition stays bounded by the length of the
calendar no matter how the raw rows were skewed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewick.schema import PEAK_LEFT, PEAK_RIGHT

CLOSE_MAS = (5, 10, 20, 30, 60, 120, 250)
VOLUME_MAS = (5, 10, 20)
# bars before a day that feed its longest moving average
TAIL_LEN = max(CLOSE_MAS + VOLUME_MAS) - 1
INDEX_COLS = ["bar_no", "tail_from"]


def by_code(order: str = "date") -> Window:
    return Window.partitionBy("code").orderBy(order)


def trailing_mean(col: str, n: int, key: str = "date") -> Column:
    """Mean of the last n rows including this one; a partial frame at
    the start of a series gives the mean of the rows that exist."""
    return F.avg(col).over(by_code(key).rowsBetween(-(n - 1), 0))


def trailing_mean_full(col: str, n: int, key: str = "date") -> Column:
    """Chart-style SMA, NULL until n rows exist."""
    w = by_code(key).rowsBetween(-(n - 1), 0)
    return F.when(F.count(col).over(w) == n, F.avg(col).over(w))


def with_moving_averages(
    bars: DataFrame,
    close_windows=CLOSE_MAS,
    volume_windows=VOLUME_MAS,
) -> DataFrame:
    """ma{n} of close and v_ma{n} of volume in one window pass."""
    cols = {f"ma{n}": trailing_mean("close", n) for n in close_windows}
    cols.update({f"v_ma{n}": trailing_mean("volume", n) for n in volume_windows})
    return bars.withColumns(cols)


def with_bar_index(bars: DataFrame) -> DataFrame:
    """Per-bar index columns, from the same window as the averages:
    ``bar_no`` = 1-based position of the bar in its code's series;
    ``tail_from`` = date of the first of the TAIL_LEN bars ending at this bar
    (NULL with fewer bars). They let later jobs bound their history reads."""
    w = by_code()
    return bars.withColumns({
        "bar_no": F.row_number().over(w).cast("bigint"),
        "tail_from": F.lag("date", TAIL_LEN - 1).over(w),
    })


def with_changes(bars: DataFrame, first_prev: float | None = None) -> DataFrame:
    """price_change and p_change (percent) from the previous bar."""
    prev = F.lag("close").over(by_code())
    if first_prev is not None:
        prev = F.coalesce(prev, F.lit(float(first_prev)))
    return (
        bars.withColumn("_prev", prev)
        .withColumn("price_change", F.col("close") - F.col("_prev"))
        .withColumn("p_change", F.round(F.try_divide(100 * F.col("price_change"), F.col("_prev")), 4))
        .drop("_prev")
    )


def extremes(
    bars: DataFrame,
    start,
    end,
    kind: str = "peak",
    left: int = PEAK_LEFT,
    right: int = PEAK_RIGHT,
) -> DataFrame:
    """Closes that equal the max (peak) or min (trough)
    of the rows [-left, +right] around them, among bars dated in
    [start, end] (the range filter comes first: it cuts the frame, Q20).

    Out: code, date, close, max_close|min_close, rank, date_rank. ``rank``
    orders by close desc with date desc as tie-break (Q04); ``date_rank`` by
    date desc.
    """
    agg, name = (F.max, "max_close") if kind == "peak" else (F.min, "min_close")
    rows = bars.select("code", "date", "close")
    if start is not None:
        rows = rows.filter(F.col("date") >= F.lit(start))
    if end is not None:
        rows = rows.filter(F.col("date") <= F.lit(end))
    w = by_code().rowsBetween(-left, right)
    ext = rows.withColumn(name, agg("close").over(w)).filter(F.col("close") == F.col(name))
    return ext.withColumns({
        "rank": F.row_number().over(
            Window.partitionBy("code").orderBy(F.col("close").desc(), F.col("date").desc())).cast("bigint"),
        "date_rank": F.row_number().over(Window.partitionBy("code").orderBy(F.col("date").desc())).cast("bigint"),
    })


def peaks_and_troughs(
    bars: DataFrame,
    start,
    end,
    left: int = PEAK_LEFT,
    right: int = PEAK_RIGHT,
) -> DataFrame:
    """W03-W06 for both kinds in one scan and one window pass: rows of
    ``extremes(kind="peak")`` and ``extremes(kind="trough")`` with a
    ``kind`` column (a bar can be both). Out: code, kind, date, close, rank,
    date_rank (ranks within (code, kind))."""
    rows = bars.select("code", "date", "close")
    if start is not None:
        rows = rows.filter(F.col("date") >= F.lit(start))
    if end is not None:
        rows = rows.filter(F.col("date") <= F.lit(end))
    w = by_code().rowsBetween(-left, right)
    both = rows.withColumns({"_max": F.max("close").over(w), "_min": F.min("close").over(w)})
    kinds = F.filter(
        F.array(F.when(F.col("close") == F.col("_max"), F.lit("peak")),
                F.when(F.col("close") == F.col("_min"), F.lit("trough"))),
        lambda k: k.isNotNull())
    ext = both.select("code", "date", "close", F.explode(kinds).alias("kind"))
    by_kind = Window.partitionBy("code", "kind")
    return ext.withColumns({
        "rank": F.row_number().over(by_kind.orderBy(F.col("close").desc(), F.col("date").desc())).cast("bigint"),
        "date_rank": F.row_number().over(by_kind.orderBy(F.col("date").desc())).cast("bigint"),
    })


def recency_rank(bars: DataFrame, since, until=None) -> DataFrame:
    """row_number of bars per code by date desc inside [since, until]."""
    rows = bars.filter(F.col("date") >= F.lit(since))
    if until is not None:
        rows = rows.filter(F.col("date") <= F.lit(until))
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy("code").orderBy(F.col("date").desc())))


def lag_change(df: DataFrame, col: str, order: str = "date") -> Column:
    """Relative change to the previous row of the same code."""
    prev = F.lag(col).over(by_code(order))
    return F.try_divide(F.col(col) - prev, prev)
