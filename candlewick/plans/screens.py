"""Rule-based screens.

Each screen is a lazy function of the market tables and an explicit as-of
day; nothing reads a clock and no bar after the as-of day is seen (Q06).
Scalars (open days) are resolved on the small calendar and become literals,
so date predicates reach the Parquet scan. Joins are on ``code`` between
per-code aggregates and the as-of slice, whose sizes are bounded by the
number of codes; AQE picks broadcast or sort-merge from their measured size.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candlewick.functions.arrays import ordered_list
from candlewick.functions.columns import (
    above_mas, bullish_touch_prev_close, not_risk_flagged, not_suspended, p_change_between, rel_change,
    round_fixed, short_upper_shadow,
)
from candlewick.operators import stats
from candlewick.operators.calendar import as_date, as_of_day, count_open_days, open_day, window_facts
from candlewick.operators.windows import extremes, peaks_and_troughs
from candlewick.plans.market import Market
from candlewick.schema import INDEX_NAMES

PICK_INFO = ["code", "name", "industry", "esp", "pe"]


def picks(codes_pct: DataFrame, info: DataFrame, as_of, reason: str, percent=None) -> DataFrame:
    """Pick rows (stock_recommend layout) from (code[, percent]) x info."""
    pct = F.col("percent") if percent is None else F.lit(float(percent))
    return (
        codes_pct.join(info.select(*PICK_INFO), "code")
        .select(*PICK_INFO, pct.cast("double").alias("percent"),
                F.lit(as_date(as_of)).alias("update_date"), F.lit(reason).alias("reason"))
        .distinct()
    )


def two_top_facts(ext: DataFrame, trend_percent: float) -> DataFrame:
    """One row per code with at least two extremes, in one aggregate over the
    two highest (rank <= 2): day and close of the highest, and (later -
    earlier) / earlier of the two, at most trend_percent (Q05)."""
    return (
        ext.filter(F.col("rank") <= 2).groupBy("code")
        .agg(F.count(F.lit(1)).alias("n"), F.max_by("close", "date").alias("later"),
             F.min_by("close", "date").alias("earlier"), F.min_by("close", "rank").alias("m_close"),
             F.min_by("date", "rank").alias("date"))
        .filter(F.col("n") == 2)
        .select("code", "date", "m_close", rel_change("later", "earlier").alias("percent"))
        .filter(F.col("percent") <= F.lit(trend_percent))
    )


def _breakout(m: Market, kind: str, on_days, trend_start, pre_start, trend_percent, up_percent, as_of) -> DataFrame:
    """(code, date, percent) of the codes that pass the rules common to X01,
    X02 and X07; ``on_days``: condition on the day of the highest extreme."""
    facts = two_top_facts(extremes(m.stocks, trend_start, as_of, kind), trend_percent).filter(on_days)
    listed = m.first_dates().filter(F.col("first_date") <= F.lit(trend_start)).select("code")
    high = stats.max_close_last_day(m.bars, pre_start, trend_start - dt.timedelta(days=1)).select(
        "code", F.col("close").alias("h_close"))
    return (
        facts.join(listed, "code").join(high, "code")
        .filter(F.try_divide(F.col("h_close") - F.col("m_close"), F.col("h_close")) >= F.lit(up_percent))
        .select("code", "date", "percent")
    )


def _days_before(as_of, n: int):
    return F.col("date").between(F.lit(as_of - dt.timedelta(days=n)), F.lit(as_of - dt.timedelta(days=1)))


def _above_short_mas(m: Market, as_of) -> DataFrame:
    return m.stocks.filter((F.col("date") == F.lit(as_of)) & above_mas((5, 10, 20))).select("code")


def box_breakout(m: Market, trend_start, pre_start, trend_percent: float, up_percent: float,
                 as_of=None) -> DataFrame:
    """X01 (`up_trend`): peaks over [trend_start, as_of]; of the two highest
    peaks the later is at most trend_percent above the earlier; the highest
    peak is on the as-of day; listed no later than trend_start; not ST; the
    highest close of [pre_start, trend_start - 1] is at least up_percent
    above the peak."""
    as_of, trend_start, pre_start = as_of_day(m.calendar, as_of), as_date(trend_start), as_date(pre_start)
    codes = _breakout(m, "peak", F.col("date") == F.lit(as_of), trend_start, pre_start, trend_percent, up_percent, as_of)
    return picks(codes, m.info.filter(not_risk_flagged()), as_of, "up_trend")


def pull_back(m: Market, trend_start, pre_start, trend_percent: float, up_percent: float, as_of=None) -> DataFrame:
    """X02 (`callback`): as X01, but the highest peak lies 1..14 calendar
    days before the as-of day, and on the as-of day close >= ma5, ma10, ma20."""
    as_of, trend_start, pre_start = as_of_day(m.calendar, as_of), as_date(trend_start), as_date(pre_start)
    codes = _breakout(m, "peak", _days_before(as_of, 14), trend_start, pre_start, trend_percent, up_percent, as_of)
    codes = codes.join(_above_short_mas(m, as_of), "code")
    return picks(codes, m.info.filter(not_risk_flagged()), as_of, "callback")


def peak_breakouts(m: Market, trend_start, pre_start, trend_percent: float, up_percent: float, as_of=None) -> DataFrame:
    """X01 and X02 together: the picks of both (told apart by ``reason``)
    from one scan and one window pass; their days exclude each other."""
    as_of, trend_start, pre_start = as_of_day(m.calendar, as_of), as_date(trend_start), as_date(pre_start)
    on_day = F.col("date") == F.lit(as_of)
    codes = _breakout(m, "peak", on_day | _days_before(as_of, 14), trend_start, pre_start, trend_percent, up_percent, as_of)
    above = _above_short_mas(m, as_of).withColumn("above", F.lit(True))
    codes = codes.join(above, "code", "left").filter(on_day | F.col("above"))
    codes = codes.withColumn("reason", F.when(on_day, F.lit("up_trend")).otherwise(F.lit("callback")))
    return (
        codes.join(m.info.filter(not_risk_flagged()).select(*PICK_INFO), "code")
        .select(*PICK_INFO, F.col("percent").cast("double").alias("percent"), F.lit(as_of).alias("update_date"), "reason")
        .distinct()
    )


def trough_breakout(m: Market, trend_start, pre_start, trend_percent: float, up_percent: float,
                    as_of=None) -> DataFrame:
    """X07 (`up_trend_low`): X01 on troughs since trend_start; the highest
    trough lies 1..10 calendar days before the as-of day."""
    as_of, trend_start, pre_start = as_of_day(m.calendar, as_of), as_date(trend_start), as_date(pre_start)
    codes = _breakout(m, "trough", _days_before(as_of, 10), trend_start, pre_start, trend_percent, up_percent, as_of)
    return picks(codes, m.info.filter(not_risk_flagged()), as_of, "up_trend_low")


def rising_structure(m: Market, trend_start, as_of) -> DataFrame:
    """Codes whose peaks and troughs over [trend_start, as_of] are all in
    rising order (A20 on both kinds; both kinds must exist). One scan and
    one window pass for both kinds."""
    ext = peaks_and_troughs(m.stocks, trend_start, as_of)
    monotone = (
        ext.groupBy("code", "kind")
        .agg(F.count_if(F.col("rank") == F.col("date_rank")).alias("n_eq"), F.max("rank").alias("n"))
        .filter(F.col("n_eq") == F.col("n"))
    )
    return monotone.groupBy("code").agg(F.count(F.lit(1)).alias("kinds")).filter(F.col("kinds") == 2).select("code")


def today_with_history(m: Market, as_of, min_bars: int) -> DataFrame:
    """As-of bars of codes with more than ``min_bars`` bars up to the as-of
    day (P15, A02). With stored bar numbers this is a predicate on the as-of
    slice; otherwise the bars up to the as-of day are counted."""
    if m.numbered is not None:
        return m.numbered.filter(
            ~F.col("code").isin(*INDEX_NAMES) & (F.col("date") == F.lit(as_of)) & (F.col("bar_no") > min_bars))
    days = stats.day_count(m.stocks, as_of).filter(F.col("num_days") > min_bars).select("code")
    return m.stocks.filter(F.col("date") == F.lit(as_of)).join(days, "code")


def ascending(m: Market, trend_start, as_of=None) -> DataFrame:
    """X04 (`asc`): rising peaks and troughs; on the as-of day close >= ma5,
    ma10, ma20, p_change <= 9, open > 0; more than 30 bars of history."""
    as_of, trend_start = as_of_day(m.calendar, as_of), as_date(trend_start)
    today = today_with_history(m, as_of, 30).filter(
        above_mas((5, 10, 20)) & (F.col("p_change") <= 9.0) & not_suspended()).select("code")
    codes = rising_structure(m, trend_start, as_of).join(today, "code")
    return picks(codes, m.info, as_of, "asc", percent=0.0)


def latest_ascending(m: Market, trend_start, as_of=None, hold_days: int = 3) -> DataFrame:
    """X05 (`latest_asc`): X04's structure; on each of the last hold_days
    open days close >= ma5..ma120 (distinct days, Q12); on the as-of day
    close >= ma5, ma10, ma20 and p_change in [0, 9], open > 0; more than 25
    bars; not ST."""
    as_of, trend_start = as_of_day(m.calendar, as_of), as_date(trend_start)
    since = open_day(m.calendar, as_of, hold_days)
    held = (
        m.stocks.filter(F.col("date").between(F.lit(since), F.lit(as_of)) & above_mas((5, 10, 20, 30, 60, 120)))
        .groupBy("code").agg(F.count_distinct("date").alias("n"))
        .filter(F.col("n") == hold_days).select("code")
    )
    today = today_with_history(m, as_of, 25).filter(
        above_mas((5, 10, 20)) & p_change_between(0.0, 9.0) & not_suspended()).select("code")
    codes = rising_structure(m, trend_start, as_of).join(today, "code").join(held, "code")
    return picks(codes, m.info.filter(not_risk_flagged()), as_of, "latest_asc", percent=0.0)


def volume_breakout(m: Market, as_of=None, push_days: int = 7, up_days: int = 3, volume_increase: float = 2,
                    no_down_day: str = "drop") -> DataFrame:
    """X06 (`up_ma`): over the last push_days calendar days at least up_days
    bars, up-day volume >= volume_increase x down-day volume, close range
    >= 4 %, positive closes; on the as-of day open > 0, close >= ma5..ma60
    and >= the window's highest close, p_change <= 5, (high-close)/open <=
    0.01. Without a down day the down volume is NULL and the code is
    dropped (Q07) unless ``no_down_day='pass'``."""
    as_of = as_of_day(m.calendar, as_of)
    win = m.stocks.filter(F.col("date").between(F.lit(as_of - dt.timedelta(days=push_days)), F.lit(as_of)))
    agg = win.groupBy("code").agg(
        F.sum(F.when(F.col("p_change") < 0, F.col("volume"))).alias("cons"),
        F.sum(F.when(F.col("p_change") >= 0, F.col("volume"))).alias("pos"),
        F.max("close").alias("max_close"), F.min("close").alias("min_close"),
        F.count(F.lit(1)).alias("n"),
    )
    vol_ok = F.col("pos") >= F.lit(volume_increase) * F.col("cons")
    if no_down_day == "pass":
        vol_ok = vol_ok | (F.col("cons").isNull() & F.col("pos").isNotNull())
    s = agg.filter(
        (F.col("n") >= up_days) & (F.col("min_close") > 0) & vol_ok
        & (rel_change("max_close", "min_close") >= 0.04)
    ).select("code", "max_close")
    today = m.stocks.filter(
        (F.col("date") == F.lit(as_of)) & not_suspended() & above_mas((5, 10, 20, 30, 60))
        & (F.col("p_change") <= 5.0) & short_upper_shadow(0.01, base="open")
    )
    codes = today.join(s, "code").filter(F.col("close") >= F.col("max_close")).select("code")
    return picks(codes, m.info, as_of, "up_ma", percent=0.0)


def continuous_increase(m: Market, as_of, n_days: int) -> DataFrame:
    """Bars since the (n+1)-th last open day with p_change in [-3, 5]:
    at least n of them >= 1; the first in [-3, 0]; the last > 0 (Q16); on
    the as-of day (high-close)/close <= 0.02, close > open, low <= previous
    close. Out: industry, code, name, p_change[] by date (2 places), n_days."""
    as_of = as_of_day(m.calendar, as_of)
    start = open_day(m.calendar, as_of, n_days + 1)
    today = m.stocks.filter(
        (F.col("date") == F.lit(as_of)) & short_upper_shadow(0.02, base="close") & bullish_touch_prev_close()
    ).select("code")
    s = m.stocks.filter(F.col("date").between(F.lit(start), F.lit(as_of)) & p_change_between(-3.0, 5.0))
    agg = (
        s.join(today, "code", "left_semi").groupBy("code")
        .agg(
            ordered_list(round_fixed("p_change"), "date").alias("p_change"),
            F.count_if(F.col("p_change") >= 1.0).alias("n_up"),
            F.min_by("p_change", "date").alias("first"),
            F.max_by("p_change", "date").alias("last"),
        )
        .filter((F.col("n_up") >= n_days) & F.col("first").between(-3.0, 0.0) & (F.col("last") > 0.0))
    )
    return agg.join(m.info, "code").select(
        "industry", "code", "name", "p_change", F.lit(n_days).alias("n_days"),
        F.lit(as_of).alias("update_date"))


def above_all_averages(m: Market, as_of, n_days: int, interval: int) -> DataFrame:
    """Since the (n+interval)-th last open day at least n bars with
    p_change in [-3, 0]; on the as-of day p_change in [0.1, 5] and close
    strictly above ma5..ma250."""
    as_of = as_of_day(m.calendar, as_of)
    start = open_day(m.calendar, as_of, n_days + interval)
    s = (
        m.stocks.filter(F.col("date").between(F.lit(start), F.lit(as_of)) & p_change_between(-3.0, 0.0))
        .groupBy("code").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= n_days).select("code")
    )
    today = m.stocks.filter(
        (F.col("date") == F.lit(as_of)) & p_change_between(0.1, 5.0)
        & above_mas((5, 10, 20, 30, 60, 120, 250), strict=True)
    ).select("code", "p_change")
    return today.join(s, "code").join(m.info, "code").select(
        "industry", "code", "name", "p_change", F.lit(n_days).alias("n_days"),
        F.lit(interval).alias("interval"), F.lit(as_of).alias("update_date"))


def interval_return(m: Market, interval: int, end_day=None) -> DataFrame:
    """Return between the interval-th last open day and end_day, and
    the range amplitude; one row per (code, concept); codes missing on
    either day are dropped. One conditional aggregation, one scan (J04)."""
    end_day = as_of_day(m.calendar, end_day)
    start = open_day(m.calendar, end_day, interval)
    per_code = (
        m.stocks.filter(F.col("date").between(F.lit(start), F.lit(end_day)))
        .groupBy("code").agg(
            stats.value_on(start, "close").alias("start_close"),
            stats.value_on(end_day, "close").alias("end_close"),
            stats.amplitude().alias("high_percent"),
        )
        .filter(F.col("start_close").isNotNull() & F.col("end_close").isNotNull())
    )
    return per_code.join(m.concept, "code").select(
        "code", F.lit(start).alias("start_day"), F.lit(end_day).alias("end_day"),
        rel_change("end_close", "start_close").alias("percent"),
        "high_percent", "name", "c_name")


def volume_trend_codes(m: Market, start, end, volume_cnt: int, neg_volume_percent: float,
                       n_open: int | None = None) -> DataFrame:
    """X08 first stage: per code in [start, end] at least (open days - 3)
    bars; few up-day volumes below the largest down-day volume (U03, Q02:
    at most volume_cnt of them); consecutive down-day volumes never change
    by more than neg_volume_percent (U02, Q02). No down day: both pass."""
    start, end = as_date(start), as_date(end)
    if n_open is None:
        n_open = count_open_days(m.calendar, start, end)
    rows = m.stocks.filter(F.col("date").between(F.lit(start), F.lit(end))).select(
        "code", "date", "p_change", "volume")
    # one pass over the range: the down day before a down day is the last one that the rows before have
    fell = F.when(F.col("p_change") < 0, F.col("volume"))
    before = F.last(fell, ignorenulls=True).over(
        Window.partitionBy("code").orderBy("date").rowsBetween(Window.unboundedPreceding, -1))
    return (
        rows.withColumn("max_neg", F.max(fell).over(Window.partitionBy("code")))
        .withColumn("chg", F.abs(F.try_divide(fell - before, before)))
        .groupBy("code").agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if((F.col("p_change") >= 0) & (F.col("volume") < F.col("max_neg"))).alias("n_below"),
            F.max("chg").alias("max_chg"))
        .filter((F.col("n") >= n_open - 3) & (F.col("n_below") <= volume_cnt)
                & (F.col("max_chg").isNull() | (F.col("max_chg") <= F.lit(neg_volume_percent))))
        .select("code")
    )


def volume_trend(m: Market, start, end, volume_cnt: int, neg_volume_percent: float, as_of=None) -> DataFrame:
    """For the kept codes, (high on the as-of day - close on the first
    open day after end) / that close, where that day's p_change < 9.9 (Q18:
    next open day, not next calendar day)."""
    as_of, start, end = as_of_day(m.calendar, as_of), as_date(start), as_date(end)
    n_open, min_day = window_facts(m.calendar, start, end)  # one small job for both calendar facts
    codes = volume_trend_codes(m, start, end, volume_cnt, neg_volume_percent, n_open=n_open)
    fwd = (
        m.stocks.filter(F.col("date").isin(F.lit(min_day), F.lit(as_of)))
        .join(codes, "code", "left_semi")
        .groupBy("code").agg(
            stats.value_on(min_day, "close").alias("min_close"),
            stats.value_on(as_of, "high").alias("max_close"),
            stats.value_on(min_day, "p_change").alias("p_change"))
        .filter(F.col("p_change") < 9.9)
    )
    return fwd.join(m.info, "code").select(
        "code", "name", rel_change("max_close", "min_close").alias("ratio"))
