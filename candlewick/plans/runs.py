"""End-to-end runs: what the reference's entry scripts do, as Spark jobs.

``run_screens`` evaluates the pick screens for an as-of day and replaces
each (update_date, reason) slice of the picks table (K04); ``run_rankings``
replaces the day's ranking slices; ``run_reports`` writes the report lines
of the day as text (K07); ``run_charts`` writes chart series per code (K08);
``run_trends`` the volume trend, interval return and industry series;
``run_refresh`` is the daily bar and moving-average refresh (X20).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.operators.calendar import as_date, as_of_day, open_day
from candlewick.plans import groups, pipeline, publish, screens
from candlewick.plans.market import Market
from candlewick.schema import BARS_DAILY
from candlewick.session import fresh_dir, path_exists
from candlewick.sources.tables import read_landed, store
from candlewick.streaming import latest
from candlewick.streaming.quotes import read_newest

#: Parameters of the screens that are lengths or limits; the two start days follow the as-of day unless given:
#: the structure is looked for in the last ``trend_days`` calendar days, the high before it in ``pre_days`` more, the
#: rising structure in ``asc_days``.
DEFAULTS = {
    "trend_days": 54, "pre_days": 122, "asc_days": 35,
    "trend_percent": 0.1, "up_percent": 0.0, "hold_days": 3,
    "push_days": 7, "up_days": 3, "volume_increase": 2.0,
    "volume_cnt": 2, "neg_volume_percent": 1.0, "volume_days": 10, "interval": 5, "top_k": 20,
}


def screen_parameters(as_of, given: dict | None = None) -> dict:
    p = {**DEFAULTS, **{k: v for k, v in (given or {}).items() if v is not None}}
    back = lambda days: as_of - dt.timedelta(days=days)
    p["trend_start"] = as_date(p.get("trend_start")) or back(p["trend_days"])
    p["pre_start"] = as_date(p.get("pre_start")) or p["trend_start"] - dt.timedelta(days=p["pre_days"])
    p["asc_start"] = as_date(p.get("asc_start")) or back(p["asc_days"])
    return p


def pick_screens(m: Market, as_of, p: dict | None = None) -> dict[str, DataFrame]:
    """reason -> picks (stock_recommend layout) of every pick screen."""
    p = screen_parameters(as_of, p)
    args = (p["trend_start"], p["pre_start"], p["trend_percent"], p["up_percent"])
    peaks = screens.peak_breakouts(m, *args, as_of)
    return {
        "up_trend": peaks.filter(F.col("reason") == "up_trend"),
        "callback": peaks.filter(F.col("reason") == "callback"),
        "up_trend_low": screens.trough_breakout(m, *args, as_of),
        "asc": screens.ascending(m, p["asc_start"], as_of),
        "latest_asc": screens.latest_ascending(m, p["asc_start"], as_of, p["hold_days"]),
        "up_ma": screens.volume_breakout(m, as_of, p["push_days"], p["up_days"], p["volume_increase"]),
    }


def run_screens(m: Market, as_of, out_root: str, reasons=None, params: dict | None = None) -> dict[str, str]:
    """Replace the (update_date, reason) slice of ``out_root/picks`` per
    screen. ``as_of``: None for the newest open day (A05)."""
    as_of = as_of_day(m.calendar, as_of)
    done = {}
    for reason, df in pick_screens(m, as_of, params).items():
        if reasons and reason not in reasons:
            continue
        done[reason] = publish.replace_slice(
            df, f"{out_root}/picks", update_date=as_of.isoformat(), reason=reason)
    for n in (2, 3):
        done[f"increase_{n}"] = publish.replace_slice(
            screens.continuous_increase(m, as_of, n), f"{out_root}/continuous_increase",
            update_date=as_of.isoformat(), n_days=n)
    for n, iv in ((2, 1), (2, 2)):
        done[f"up_all_mas_{n}_{iv}"] = publish.replace_slice(
            screens.above_all_averages(m, as_of, n, iv), f"{out_root}/up_all_mas",
            update_date=as_of.isoformat(), n_days=n, interval=iv)
    return done


def run_rankings(m: Market, as_of, out_root: str) -> dict[str, str]:
    """X11-X14 slices of the day (by update_date)."""
    as_of = as_of_day(m.calendar, as_of)
    d = as_of.isoformat()
    return {
        "top_industry": publish.replace_slice(groups.industry_by_day(m, as_of), f"{out_root}/top_industry",
                                              update_date=d),
        "top_n_industry": publish.replace_slice(groups.industry_summary(m, as_of), f"{out_root}/top_n_industry",
                                                update_date=d),
        "top_concept": publish.replace_slice(groups.concept_by_day(m, as_of), f"{out_root}/top_concept",
                                             update_date=d),
        "top_n_concept": publish.replace_slice(groups.concept_summary(m, as_of), f"{out_root}/top_n_concept",
                                               update_date=d),
    }


def run_reports(spark, as_of, out_root: str) -> str:
    """X18/K07 from the stored slices of the day; one text folder per report."""
    as_of = as_date(as_of)
    d = as_of.isoformat()
    picks = publish.read_slice(spark, f"{out_root}/picks", update_date=d)
    cont = publish.read_slice(spark, f"{out_root}/continuous_increase", update_date=d)
    mas = publish.read_slice(spark, f"{out_root}/up_all_mas", update_date=d)
    rows = (
        publish.breakout_report(picks.filter(F.col("reason").isin("up_trend", "callback")))
        .unionByName(publish.increase_report(cont))
        .unionByName(publish.all_mas_report(mas))
    )
    lines = publish.report_lines(rows, d)
    path = f"{out_root}/reports/update_date={d}"
    (lines.repartition("report").sortWithinPartitions("line_no").select("report", "text")
     .write.mode("overwrite").partitionBy("report").text(path))
    return path


def read_picks(spark, as_of, out_root: str, reason: str | None = None) -> DataFrame:
    """The day's picks, the highest percent first."""
    picks = publish.read_slice(spark, f"{out_root}/picks", update_date=as_date(as_of).isoformat())
    if reason:
        picks = picks.filter(F.col("reason") == reason)
    return picks.orderBy(F.col("percent").desc_nulls_last(), "code")


def run_charts(m: Market, as_of, out_root: str, reason: str, since=publish.CHART_START) -> str:
    """Chart series of one reason's picks of the day: averages,
    label, RSI and MACD; Bollinger bands for pull-backs."""
    as_of = as_of_day(m.calendar, as_of)
    d = as_of.isoformat()
    picks = publish.read_slice(m.bars.sparkSession, f"{out_root}/picks", update_date=d).filter(
        F.col("reason") == reason)
    series = publish.chart_series(m.bars, picks, m.info, since=since, until=as_of, bollinger=(reason == "callback"))
    recursive = publish.chart_recursive(m.bars, picks, since=since, until=as_of).drop("close")
    path = f"{out_root}/charts/update_date={d}/reason={reason}"
    publish.write_chart_data(series.join(recursive, ["code", "date"], "left"), path)
    return path


def run_trends(m: Market, as_of, out_root: str, params: dict | None = None) -> dict[str, str]:
    """X08, X15, X16 and X17 of the day, each replacing its own slice."""
    as_of = as_of_day(m.calendar, as_of)
    d, p, spark = as_of.isoformat(), screen_parameters(as_of, params), m.bars.sparkSession
    end = next_or_last_open_day(m, as_of)
    start = open_day(m.calendar, end, p["volume_days"])
    stats = store(groups.industry_stats_by_day(m, as_of), fresh_dir(spark, "trends"), sort_by=("date",))
    first = open_day(m.calendar, as_of, p["interval"])
    ratio = screens.volume_trend(m, start, end, p["volume_cnt"], p["neg_volume_percent"], as_of)
    return {
        "volume_trend": publish.replace_slice(ratio.orderBy(F.col("ratio").desc_nulls_last(), "code"), f"{out_root}/volume_trend", update_date=d),
        "interval_return": publish.replace_slice(screens.interval_return(m, p["interval"], as_of), f"{out_root}/interval_return",
                                                 start_day=first.isoformat(), end_day=d),
        "excess_return": publish.replace_slice(groups.excess_return(m, stats, p["top_k"]), f"{out_root}/excess_return", update_date=d),
        "hot_industries": publish.replace_slice(groups.hot_industries_with_index(m, stats), f"{out_root}/hot_industries", update_date=d),
    }


def next_or_last_open_day(m: Market, as_of):
    """The open day before the as-of day: the last on which a volume trend
    can end, since its return starts on the open day after."""
    return open_day(m.calendar, as_of - dt.timedelta(days=1), 1)


def read_newest_provisional(spark, path: str) -> DataFrame:
    """Provisional bars of a folder: the newest per code of the live job's
    changes, of the newest batch where it has one folder per batch, else of
    all its files."""
    if path_exists(spark, f"{path}/changes"):
        return latest.read_provisional(spark, path).select(*BARS_DAILY.fieldNames())
    if "batch_id" in spark.read.parquet(path).columns:
        return read_newest(spark, path).select(*BARS_DAILY.fieldNames())
    return read_landed(spark, path, BARS_DAILY)


def run_refresh(m: Market | None, landed_dir: str | None, out_root: str, provisional_dir: str | None = None,
                spark=None) -> dict:
    """X20 as a job on the book ``out_root/book`` (created from ``m`` by the
    first run): landed final bars and optionally provisional bars are
    upserted, the MA rows extended; only the months they touch are written."""
    spark = spark or m.bars.sparkSession
    book = f"{out_root}/book"
    if not pipeline.book_exists(spark, book):
        pipeline.create_book(m, book)
    landed = read_landed(spark, landed_dir, BARS_DAILY) if landed_dir else None
    prov = read_newest_provisional(spark, provisional_dir) if provisional_dir else None
    return {"book": book, "months": pipeline.refresh_book(spark, book, landed, prov)}
