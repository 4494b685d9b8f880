"""Industry and concept rankings.

Per (day, group): average change, share of rising codes and the top-n codes
by change. Statistics are partial aggregates (map-side combine); the top-n
uses a WindowGroupLimit, so no group - however hot - is collected whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.functions.arrays import ordered_list, top_k_lists
from candlewick.functions.columns import avg_round_fixed, label, ratio_round, round_fixed
from candlewick.operators.calendar import as_date, as_of_day, open_day, open_day_lookup
from candlewick.plans.market import Market
from candlewick.schema import CALENDAR_CODE

LIMIT_UP = 9.5


def limit_up_codes(bars: DataFrame, start, end, min_days: int) -> DataFrame:
    """J06 side: codes with at least ``min_days`` bars of p_change > 9.5 in [start, end]."""
    return (
        bars.filter(F.col("date").between(F.lit(start), F.lit(end)) & (F.col("p_change") > LIMIT_UP))
        .groupBy("code").agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") >= min_days).select("code")
    )


def group_by_day(
    bars: DataFrame,
    members: DataFrame,
    group_col: str,
    start,
    end,
    top_n: int,
    excluded: DataFrame,
    as_of,
) -> DataFrame:
    """X11/X13 core: members(code, name, <group_col>) x bars in [start, end]."""
    stats, top = group_by_day_parts(bars, members, group_col, start, end, top_n, excluded)
    keys = ["date", group_col]
    return stats.join(top, keys).select(
        group_col, "date", "p_change", "positive_stock_ratio", "top_n_stock", "top_n_change",
        F.lit(as_date(as_of)).alias("update_date"),
    )


def group_by_day_parts(bars, members, group_col, start, end, top_n, excluded) -> tuple[DataFrame, DataFrame]:
    """(statistics per (date, group), top-n lists per (date, group))."""
    rows = (
        bars.filter(F.col("date").between(F.lit(start), F.lit(end)))
        .select("code", "date", "p_change")
        .join(excluded, "code", "left_anti")  # before the (many-to-many) member join
        .join(members.select("code", "name", group_col), "code")
    )
    keys = ["date", group_col]
    pos = F.count_if(F.col("p_change") > 0)
    neg = F.count_if(F.col("p_change") <= 0)
    stats = rows.groupBy(*keys).agg(
        avg_round_fixed("p_change").alias("p_change"),
        ratio_round(pos, pos + neg).alias("positive_stock_ratio"),
    )
    top = top_k_lists(
        rows, keys, [F.col("p_change").desc_nulls_last(), F.col("code").asc()], top_n,
        {"top_n_stock": label(), "top_n_change": F.col("p_change")},
    )
    return stats, top


def _industry_args(m: Market, as_of, top_n: int, n_days: int, ignore_n_days: int, extra_days=()):
    days = open_day_lookup(m.calendar, as_of, [n_days, ignore_n_days, *extra_days])
    excluded = limit_up_codes(m.bars, days[ignore_n_days], as_of, ignore_n_days)
    return (m.stocks, m.info, "industry", days[n_days], as_of, top_n, excluded), days


def _concept_args(m: Market, as_of, top_n: int, n_days: int, limit_up_days: int):
    start = open_day(m.calendar, as_of, n_days)
    excluded = limit_up_codes(m.bars, start, as_of, limit_up_days)
    members = m.concept.select("code", "name", F.col("c_name").alias("concept"))
    return (m.stocks, members, "concept", start, as_of, top_n, excluded)


def industry_by_day(m: Market, as_of=None, top_n: int = 5, n_days: int = 30, ignore_n_days: int = 3) -> DataFrame:
    """X11: last n_days open days per (day, industry); codes with at least
    ignore_n_days limit-up bars within the last ignore_n_days open days are
    left out."""
    as_of = as_of_day(m.calendar, as_of)
    args, _ = _industry_args(m, as_of, top_n, n_days, ignore_n_days)
    return group_by_day(*args, as_of)


def industry_stats_by_day(m: Market, as_of=None, n_days: int = 30, ignore_n_days: int = 3) -> DataFrame:
    """X11's statistics half: (industry, date, p_change, positive_stock_ratio)."""
    as_of = as_of_day(m.calendar, as_of)
    args, _ = _industry_args(m, as_of, 1, n_days, ignore_n_days)
    return group_by_day_parts(*args)[0]


def concept_by_day(m: Market, as_of=None, top_n: int = 5, n_days: int = 10, limit_up_days: int = 2) -> DataFrame:
    """As X11 over concept tags; codes with at least limit_up_days
    limit-up bars in the whole window are left out. ``top_n`` is honoured
    (Q14), default 5."""
    as_of = as_of_day(m.calendar, as_of)
    return group_by_day(*_concept_args(m, as_of, top_n, n_days, limit_up_days), as_of)


def group_summary(
    by_day: DataFrame, group_col: str, top_n: int, label_start=None, label_end=None,
    top: DataFrame | None = None, as_of=None,
) -> DataFrame:
    """Per group, change and ratio arrays by date desc, and the
    top_n most mentioned labels (``label+count``, count desc then label) of
    the days in [label_start, label_end]. ``by_day`` holds this run only (Q13).

    ``by_day`` needs the statistics columns; the labels are taken from
    ``top`` when given (the top-n half of X11/X13), else from ``by_day``.
    """
    aggs = [
        ordered_list("p_change", "date", descending=True).alias("p_change"),
        ordered_list("positive_stock_ratio", "date", descending=True).alias("positive_stock_ratio"),
    ]
    if as_of is None:
        aggs.append(F.max("update_date").alias("update_date"))
    series = by_day.groupBy(group_col).agg(*aggs)
    days = by_day if top is None else top
    if label_start is not None:
        days = days.filter(F.col("date").between(F.lit(label_start), F.lit(label_end)))
    mentions = (
        days.select(group_col, F.explode("top_n_stock").alias("stock"))
        .groupBy(group_col, "stock").agg(F.count(F.lit(1)).alias("stock_cnt"))
    )
    mentions_top = top_k_lists(
        mentions, [group_col], [F.col("stock_cnt").desc(), F.col("stock").asc()], top_n,
        {"top_n_stock": F.concat(F.col("stock"), F.lit("+"), F.col("stock_cnt").cast("string"))},
    )
    return series.join(mentions_top, group_col).select(
        group_col, "p_change", "positive_stock_ratio", "top_n_stock",
        F.lit(as_date(as_of)).alias("update_date") if as_of is not None else F.col("update_date"))


def industry_summary(m: Market, as_of=None, top_n: int = 5, n_days: int = 30, ignore_n_days: int = 3) -> DataFrame:
    """Labels counted over the last top_n open days. Statistics and
    top-n lists of X11 are each computed once."""
    as_of = as_of_day(m.calendar, as_of)
    args, days = _industry_args(m, as_of, top_n, n_days, ignore_n_days, extra_days=(top_n,))
    stats, top = group_by_day_parts(*args)
    return group_summary(stats, "industry", top_n, days[top_n], as_of, top=top, as_of=as_of)


def concept_summary(m: Market, as_of=None, top_n: int = 5, n_days: int = 10, limit_up_days: int = 2) -> DataFrame:
    """Labels counted over all days of this run."""
    as_of = as_of_day(m.calendar, as_of)
    stats, top = group_by_day_parts(*_concept_args(m, as_of, top_n, n_days, limit_up_days))
    return group_summary(stats, "concept", top_n, top=top, as_of=as_of)


def top_groups_on_day(by_day: DataFrame, group_col: str, k: int) -> DataFrame:
    """T02/J08 side: the k groups with the highest change on the newest day
    of ``by_day`` (tie-break: group name). k is the report size, fixed."""
    newest = by_day.agg(F.max("date").alias("date"))
    return (
        by_day.join(newest, "date")
        .orderBy(F.col("p_change").desc_nulls_last(), F.col(group_col).asc())
        .limit(k).select(group_col)
    )


def excess_return(m: Market, by_day: DataFrame, k: int = 20) -> DataFrame:
    """Industry change minus index change by date (left join J07) for
    the k best industries of the newest day (J08). ``by_day`` is read three
    times (top groups, series, first day): pass a stored frame."""
    first_day = by_day.agg(F.min("date").alias("d")).first()["d"]  # scalar: the date bound reaches the scan
    index = m.bars.filter((F.col("code") == CALENDAR_CODE) & (F.col("date") >= F.lit(first_day))).select(
        "date", F.col("p_change").alias("index_change"))
    hot = by_day.join(top_groups_on_day(by_day, "industry", k), "industry", "left_semi")
    return hot.join(index, "date", "left").select(
        F.lit("industry index").alias("series"), "industry", "date",
        round_fixed(F.col("p_change") - F.col("index_change"), 4).alias("p_change"),
    )


def hot_industries_with_index(m: Market, by_day: DataFrame, k: int = 10) -> DataFrame:
    """Top-k industries' daily series UNION ALL the index series.
    ``by_day`` is read three times: pass a stored frame."""
    span = by_day.agg(F.min("date").alias("lo"), F.max("date").alias("hi")).first()  # scalars for the scan
    hot = by_day.join(top_groups_on_day(by_day, "industry", k), "industry", "left_semi").select(
        F.lit("industry index").alias("series"), "industry", "date", "p_change")
    index = (
        m.bars.filter((F.col("code") == CALENDAR_CODE) & F.col("date").between(F.lit(span["lo"]), F.lit(span["hi"])))
        .select(F.lit("market index").alias("series"), F.lit("market index").alias("industry"),
                "date", "p_change")
    )
    return hot.unionByName(index)
