"""Registered queries: one Spark callable and, where SQL can state the rule,
one DuckDB oracle text per key. Parameters are those of FIXTURES.md §3."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick import oracle as O
from candlewick.functions.arrays import last, nth
from candlewick.operators import bars as bar_ops
from candlewick.operators import calendar, stats
from candlewick.operators.ranking import global_row_number
from candlewick.operators.windows import extremes
from candlewick.plans import groups, kept_extremes, pipeline, publish, screens, smoothed
from candlewick.plans.market import load_market
from candlewick.schema import BAR_BASE_COLS, BAR_COLS, CONCEPT, INFO
from candlewick.session import fresh_dir
from candlewick.sources import tables
from candlewick.streaming import latest, quotes

AS_OF = dt.date(2015, 11, 24)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# ---------------------------------------------------------------- X11 - X14
@register("x11_industry_by_day", O.with_base(
    *O.industry_by_day_ctes(AS_OF, 5, 30, 3),
    select="SELECT * FROM gday"))
def x11(spark, sf_dir):
    return groups.industry_by_day(load_market(spark, sf_dir), AS_OF, top_n=5, n_days=30, ignore_n_days=3)


LIMIT_UP_DAY = dt.date(2015, 11, 22)  # a code was limit-up on the last two open days


@register("x11_industry_by_day_limit_up", O.with_base(
    *O.industry_by_day_ctes(LIMIT_UP_DAY, 5, 30, 2),
    select="SELECT * FROM gday"))
def x11_limit_up(spark, sf_dir):
    return groups.industry_by_day(load_market(spark, sf_dir), LIMIT_UP_DAY, top_n=5, n_days=30, ignore_n_days=2)


@register("x12_industry_summary", O.with_base(
    *O.industry_by_day_ctes(AS_OF, 5, 30, 3),
    select=O.group_summary_sql("industry", 5, f"date BETWEEN {O.open_day(AS_OF, 5)} AND {O.d(AS_OF)}")))
def x12(spark, sf_dir):
    return groups.industry_summary(load_market(spark, sf_dir), AS_OF, top_n=5, n_days=30, ignore_n_days=3)


@register("x13_concept_by_day", O.with_base(
    *O.concept_by_day_ctes(AS_OF, 5, 10, 2),
    select="SELECT * FROM gday"))
def x13(spark, sf_dir):
    return groups.concept_by_day(load_market(spark, sf_dir), AS_OF, top_n=5, n_days=10, limit_up_days=2)


@register("x13_concept_by_day_30", O.with_base(
    *O.concept_by_day_ctes(AS_OF, 5, 30, 2),
    select="SELECT * FROM gday"))
def x13_30(spark, sf_dir):
    return groups.concept_by_day(load_market(spark, sf_dir), AS_OF, top_n=5, n_days=30, limit_up_days=2)


@register("x14_concept_summary", O.with_base(
    *O.concept_by_day_ctes(AS_OF, 5, 10, 2),
    select=O.group_summary_sql("concept", 5)))
def x14(spark, sf_dir):
    return groups.concept_summary(load_market(spark, sf_dir), AS_OF, top_n=5, n_days=10, limit_up_days=2)


# ---------------------------------------------------------------- screens
TREND_START = dt.date(2015, 10, 1)
PRE_START = dt.date(2015, 6, 1)
ASC_START = dt.date(2015, 10, 20)


@register("x01_box_breakout", O.breakout_sql(
    "peak", "up_trend", TREND_START, PRE_START, 0.1, 0.0, AS_OF, f"date = {O.d(AS_OF)}"))
def x01(spark, sf_dir):
    return screens.box_breakout(load_market(spark, sf_dir), TREND_START, PRE_START, 0.1, 0.0, AS_OF)


@register("x02_pull_back", O.breakout_sql(
    "peak", "callback", TREND_START, PRE_START, 0.1, 0.0, AS_OF,
    f"date >= {O.d(AS_OF)} - 14 AND date < {O.d(AS_OF)}",
    today=f"e.date = {O.d(AS_OF)} AND {O.over('e', 5, 10, 20)}"))
def x02(spark, sf_dir):
    return screens.pull_back(load_market(spark, sf_dir), TREND_START, PRE_START, 0.1, 0.0, AS_OF)


@register("x04_ascending", O.ascending_sql(ASC_START, AS_OF))
def x04(spark, sf_dir):
    return screens.ascending(load_market(spark, sf_dir), ASC_START, AS_OF)


@register("x05_latest_ascending", O.ascending_sql(ASC_START, AS_OF, latest=True, hold_days=3))
def x05(spark, sf_dir):
    return screens.latest_ascending(load_market(spark, sf_dir), ASC_START, AS_OF, hold_days=3)


@register("x06_volume_breakout", O.volume_breakout_sql(AS_OF, 7, 3, 2))
def x06(spark, sf_dir):
    return screens.volume_breakout(load_market(spark, sf_dir), AS_OF, push_days=7, up_days=3, volume_increase=2)


@register("x07_trough_breakout", O.breakout_sql(
    "trough", "up_trend_low", TREND_START, PRE_START, 0.1, 0.0, AS_OF,
    f"date >= {O.d(AS_OF)} - 10 AND date < {O.d(AS_OF)}"))
def x07(spark, sf_dir):
    return screens.trough_breakout(load_market(spark, sf_dir), TREND_START, PRE_START, 0.1, 0.0, AS_OF)


VT_START, VT_END = dt.date(2015, 11, 1), dt.date(2015, 11, 12)


@register("x08_volume_trend", O.volume_trend_sql(VT_START, VT_END, 2, 1.0, AS_OF))
def x08(spark, sf_dir):
    return screens.volume_trend(load_market(spark, sf_dir), VT_START, VT_END, 2, 1.0, AS_OF)


@register("x09_continuous_increase_1", O.continuous_increase_sql(AS_OF, 1))
def x09_1(spark, sf_dir):
    return screens.continuous_increase(load_market(spark, sf_dir), AS_OF, 1)


@register("x09_continuous_increase_2", O.continuous_increase_sql(AS_OF, 2))
def x09_2(spark, sf_dir):
    return screens.continuous_increase(load_market(spark, sf_dir), AS_OF, 2)


@register("x10_above_all_averages_2_2", O.above_all_averages_sql(AS_OF, 2, 2))
def x10_22(spark, sf_dir):
    return screens.above_all_averages(load_market(spark, sf_dir), AS_OF, 2, 2)


DAY_BEFORE = dt.date(2015, 11, 23)  # a day on which this pair of parameters picks


@register("x10_above_all_averages_2_1", O.above_all_averages_sql(DAY_BEFORE, 2, 1))
def x10_21(spark, sf_dir):
    return screens.above_all_averages(load_market(spark, sf_dir), DAY_BEFORE, 2, 1)


@register("x15_interval_return", O.interval_return_sql(5, AS_OF))
def x15(spark, sf_dir):
    return screens.interval_return(load_market(spark, sf_dir), 5, AS_OF)


# ------------------------------------------------- helper tables, windows
@register("w01_bars_with_averages", O.with_base(select=f"SELECT {O.BAR_COLUMNS} FROM bars"))
def w01(spark, sf_dir):
    return load_market(spark, sf_dir).bars


@register("w03_peaks", O.with_base(select=f"FROM ({O.extremes_sql('peak', O.d(TREND_START), O.d(AS_OF))})"))
def w03(spark, sf_dir):
    return extremes(load_market(spark, sf_dir).stocks, TREND_START, AS_OF, "peak")


@register("w04_troughs", O.with_base(select=f"FROM ({O.extremes_sql('trough', O.d(ASC_START), O.d(AS_OF))})"))
def w04(spark, sf_dir):
    return extremes(load_market(spark, sf_dir).stocks, ASC_START, AS_OF, "trough")


@register("w03_kept_extremes", O.with_base(select=f"""
    FROM (FROM ({O.extremes_sql('peak', O.d(TREND_START), O.d(AS_OF))}) SELECT 'peak' AS kind, code, date, close, rank, date_rank
          UNION ALL
          FROM ({O.extremes_sql('trough', O.d(TREND_START), O.d(AS_OF))}) SELECT 'trough' AS kind, code, date, close, rank, date_rank)"""))
def w03_kept(spark, sf_dir):
    """W03-W06 kept from run to run, all codes: a first run in which each
    code's newest and oldest close are wrong, a run that corrects the newest
    (in the tail), one that corrects the oldest (the codes are computed
    again) and one that adds the days up to the as-of day."""
    m, root = load_market(spark, sf_dir), fresh_dir(spark, "w03")
    bars = m.stocks.filter((F.col("date") >= F.lit(TREND_START)) & (F.col("date") <= F.lit(AS_OF))).select("code", "date", "close")
    early = bars.filter(F.col("date") <= F.lit(LOAD_FROM))
    ends = early.groupBy("code").agg(F.min("date").alias("oldest"), F.max("date").alias("newest"))

    def spoiled(*days):
        wrong = F.lit(False)
        for day in days:
            wrong = wrong | (F.col("date") == F.col(day))
        return early.join(ends, "code").withColumn("close", F.when(wrong, F.col("close") * 2).otherwise(F.col("close")))

    kept_extremes.refresh(spark, root, spoiled("oldest", "newest"), TREND_START)
    kept_extremes.refresh(spark, root, spoiled("oldest"), TREND_START, landed=ends.select("code", F.col("newest").alias("date")))
    kept_extremes.refresh(spark, root, early, TREND_START, landed=ends.select("code", F.col("oldest").alias("date")))
    kept_extremes.refresh(spark, root, bars, TREND_START)
    return kept_extremes.read_extremes(spark, root)


@register("a01_min_max_day", O.with_base(select=(
    "SELECT code, min(date) AS min_date, max(date) AS max_date, count(*) AS days FROM bars GROUP BY code")))
def a01(spark, sf_dir):
    return stats.min_max_day(load_market(spark, sf_dir).bars)


@register("a02_day_count", O.with_base(select="SELECT code, count(*) AS num_days FROM bars GROUP BY code"))
def a02(spark, sf_dir):
    return stats.day_count(load_market(spark, sf_dir).bars)


@register("a03_max_close_last_day", O.with_base(select=f"""
    FROM bars SELECT code, date, close WHERE date >= {O.d(PRE_START)} AND date <= {O.d(TREND_START)}
    QUALIFY row_number() OVER (PARTITION BY code ORDER BY close DESC, date DESC) = 1"""))
def a03(spark, sf_dir):
    return stats.max_close_last_day(load_market(spark, sf_dir).bars, PRE_START, TREND_START)


@register("a04_max_close_first_day", O.with_base(select=f"""
    FROM bars SELECT code, date, close WHERE date >= {O.d(PRE_START)} AND date <= {O.d(TREND_START)}
    QUALIFY row_number() OVER (PARTITION BY code ORDER BY close DESC, date) = 1"""))
def a04_max(spark, sf_dir):
    return stats.max_close_first_day(load_market(spark, sf_dir).bars, PRE_START, TREND_START)


@register("a04_min_close_first_day", O.with_base(select=f"""
    FROM bars SELECT code, date, close WHERE date >= {O.d(PRE_START)} AND date <= {O.d(TREND_START)}
    QUALIFY row_number() OVER (PARTITION BY code ORDER BY close, date) = 1"""))
def a04_min(spark, sf_dir):
    return stats.min_close_first_day(load_market(spark, sf_dir).bars, PRE_START, TREND_START)


# ------------------------------------------------------ bar maintenance
@register("x03_tick_to_bar", O.tick_to_bar_sql(AS_OF))
def x03(spark, sf_dir):
    m = load_market(spark, sf_dir)
    return bar_ops.tick_to_bar(bar_ops.ticks_from_bars(m.bars, AS_OF), m.stocks, AS_OF)


@register("w02_incremental_averages", O.with_base(select=f"SELECT {O.BAR_COLUMNS} FROM bars WHERE date > {O.d(AS_OF)}"))
def w02(spark, sf_dir):
    """Property as a query: MA rows extended from a table stored up to the
    as-of day equal the full rebuild (Q21)."""
    m = load_market(spark, sf_dir)
    stored = m.numbered.filter(F.col("date") <= F.lit(AS_OF))
    return bar_ops.extend_moving_averages(stored, m.numbered).select(*BAR_COLS)


LOAD_FROM = dt.date(2015, 11, 10)


@register("s02_incremental_load", O.with_base(select=f"""
    SELECT {O.BAR_COLUMNS} FROM bars b
    WHERE b.date >= {O.d(LOAD_FROM)}
      AND b.date > coalesce((SELECT max(date) FROM bars s WHERE s.code = b.code AND s.date <= {O.d(AS_OF)}),
                            DATE '1900-01-01')"""))
def s02(spark, sf_dir):
    """Stored: bars up to the as-of day; landed: bars since LOAD_FROM."""
    m = load_market(spark, sf_dir)
    stored = m.bars.filter(F.col("date") <= F.lit(AS_OF))
    landed = m.bars.filter(F.col("date") >= F.lit(LOAD_FROM))
    return bar_ops.incremental_rows(stored, landed)


@register("s07_universe", O.with_base(select="""
    SELECT DISTINCT code FROM (
      SELECT code FROM info WHERE code IS NOT NULL AND length(code) = 6
      UNION ALL SELECT unnest(['sh', 'sz', 'hs300', 'sz50', 'zxb', 'cyb']))"""))
def s07(spark, sf_dir):
    return bar_ops.universe(spark, load_market(spark, sf_dir).info)


# ------------------------------------------------------ group charts
@register("x16_excess_return", O.excess_return_sql(AS_OF, 20))
def x16(spark, sf_dir):
    m = load_market(spark, sf_dir)
    stats = tables.store(groups.industry_stats_by_day(m, AS_OF, 30, 3), fresh_dir(spark, "x16"), sort_by=("date",))
    return groups.excess_return(m, stats, k=20)


@register("x17_hot_industries_with_index", O.hot_industries_sql(AS_OF, 10))
def x17(spark, sf_dir):
    m = load_market(spark, sf_dir)
    stats = tables.store(groups.industry_stats_by_day(m, AS_OF, 30, 3), fresh_dir(spark, "x17"), sort_by=("date",))
    return groups.hot_industries_with_index(m, stats, k=10)


# ------------------------------------------------------ publishing
@register("x18_report_lines", O.report_lines_sql(
    AS_OF,
    O.breakout_sql("peak", "up_trend", TREND_START, PRE_START, 0.1, 0.0, AS_OF, f"date = {O.d(AS_OF)}"),
    ORACLE["x02_pull_back"],
    [O.continuous_increase_sql(AS_OF, 1), O.continuous_increase_sql(AS_OF, 2)],
    [O.above_all_averages_sql(AS_OF, 2, 1), O.above_all_averages_sql(AS_OF, 2, 2)]))
def x18(spark, sf_dir):
    m = load_market(spark, sf_dir)
    peaks = screens.peak_breakouts(m, TREND_START, PRE_START, 0.1, 0.0, AS_OF)
    rows = (
        publish.breakout_report(peaks)
        .unionByName(publish.increase_report(screens.continuous_increase(m, AS_OF, 1)
                                             .unionByName(screens.continuous_increase(m, AS_OF, 2))))
        .unionByName(publish.all_mas_report(screens.above_all_averages(m, AS_OF, 2, 1)
                                            .unionByName(screens.above_all_averages(m, AS_OF, 2, 2))))
    )
    return publish.report_lines(rows, AS_OF)


@register("x19_chart_series", O.with_base(select=O.chart_series_sql(
    f"SELECT code FROM ({O.ascending_sql(ASC_START, AS_OF)})", publish.CHART_START, AS_OF)))
def x19(spark, sf_dir):
    m = load_market(spark, sf_dir)
    s = publish.chart_series(m.bars, screens.ascending(m, ASC_START, AS_OF), m.info, until=AS_OF, bollinger=True)
    # band values to 1e-6: standard deviations differ in the last bits between engines
    return s.withColumns({c: F.round(F.col(c) * 1e6) / 1e6 for c in ("bb_up", "bb_dn")})


@register("x19_chart_rsi_macd", O.with_base_recursive(O.recursive_indicators_sql(
    f"SELECT code FROM ({O.ascending_sql(ASC_START, AS_OF)})", publish.CHART_START, AS_OF)))
def x19_rec(spark, sf_dir):
    m = load_market(spark, sf_dir)
    s = publish.chart_recursive(m.bars, screens.ascending(m, ASC_START, AS_OF), until=AS_OF)
    # recursive smoothing: compare at 1e-6 (summation order of the seeds may differ in the last bits)
    return s.withColumns({c: F.round(F.col(c) * 1e6) / 1e6 for c in ("rsi14", "macd", "macd_signal", "macd_hist")})


@register("u01_continued_indicators", O.with_base_recursive(O.recursive_indicators_sql(
    "SELECT code FROM bars", publish.CHART_START, AS_OF)))
def u01(spark, sf_dir):
    """U01/W12/W13 as stored recurrences, all codes: a first run up to some
    days before the as-of day, in which the newest close of each code is
    wrong, a run that corrects it, and one that adds the days since. The
    series equal one computed whole."""
    m, root = load_market(spark, sf_dir), fresh_dir(spark, "u01")
    bars = m.bars.filter((F.col("date") >= F.lit(publish.CHART_START)) & (F.col("date") <= F.lit(AS_OF))).select("code", "date", "close")
    early = bars.filter(F.col("date") <= F.lit(LOAD_FROM))
    newest = early.groupBy("code").agg(F.max("date").alias("date"))
    wrong = early.join(newest.withColumnRenamed("date", "newest"), "code").withColumn(
        "close", F.when(F.col("date") == F.col("newest"), F.col("close") * 2).otherwise(F.col("close")))
    smoothed.refresh(spark, root, wrong)
    smoothed.refresh(spark, root, early, landed=newest)
    smoothed.refresh(spark, root, bars)
    s = smoothed.read_indicators(spark, root)
    return s.withColumns({c: F.round(F.col(c) * 1e6) / 1e6 for c in ("rsi14", "macd", "macd_signal", "macd_hist")})


# ------------------------------------------------------ quote streams (batch form)
@register("r06_daily_bars_from_quotes", """
    SELECT CAST(user_id AS VARCHAR) AS code, time_bucket(INTERVAL 1 DAY, ts) AS window_start,
           first(value ORDER BY ts, value) AS open, max(value) AS high, min(value) AS low,
           last(value ORDER BY ts, value) AS close,
           CAST(count(*) AS DOUBLE) AS volume, count(*) AS n_quotes
    FROM events GROUP BY user_id, time_bucket(INTERVAL 1 DAY, ts)""")
def r06(spark, sf_dir):
    """R06 on a static frame: the same plan the stream runs, all windows."""
    ev = spark.read.parquet(f"{sf_dir}/events.parquet")
    return quotes.daily_bars(quotes.quotes_from_events(ev), watermark=None)


@register("r03_latest_quote", """
    SELECT CAST(user_id AS VARCHAR) AS code, max(ts) AS event_ts, last(value ORDER BY ts, value) AS price,
           CAST(1 AS DOUBLE) AS volume
    FROM events GROUP BY user_id""")
def r03(spark, sf_dir):
    ev = spark.read.parquet(f"{sf_dir}/events.parquet")
    return quotes.latest(quotes.quotes_from_events(ev))


# ------------------------------------------------------ daily refresh
@register("x20_daily_refresh", O.with_base(select=f"SELECT {O.BAR_COLUMNS} FROM bars"))
def x20(spark, sf_dir):
    """Two runs on one book: the provisional bars of the as-of day (X03) on
    the history before it, then the final bars from that day on. The whole
    table equals a full rebuild (Q10, Q21)."""
    m = load_market(spark, sf_dir)
    root = fresh_dir(spark, "x20")
    before = F.col("date") < F.lit(AS_OF)
    pipeline.create_book(replace(m, numbered=m.numbered.filter(before)), root)
    quotes_of_day = bar_ops.ticks_from_bars(m.bars, AS_OF)
    pipeline.refresh_book(spark, root, None, bar_ops.tick_to_bar(quotes_of_day, m.stocks, AS_OF))
    pipeline.refresh_book(spark, root, m.bars.filter(~before))
    return pipeline.open_book(spark, root).bars


@register("k06_delete_newest_day", O.with_base(select=f"""
    SELECT {O.BAR_COLUMNS} FROM bars WHERE date < (SELECT max(date) FROM bars) OR date IS NULL"""))
def k06(spark, sf_dir):
    """Bars and averages of the newest day go in one version of the
    book; a run that lands the day again and a second deletion leave the same."""
    m = load_market(spark, sf_dir)
    root = fresh_dir(spark, "k06")
    pipeline.create_book(m, root)
    day = dt.date.fromisoformat(pipeline.delete_newest_day(spark, root))
    pipeline.refresh_book(spark, root, m.bars.filter(F.col("date") == F.lit(day)))
    pipeline.delete_newest_day(spark, root)
    return pipeline.open_book(spark, root).bars


# ------------------------------------------------------ parameterised SQL scan
@register("s01_sql_scan", O.with_base(select=f"""
    SELECT d.code, d.date, d.close, i.industry FROM stocks d JOIN info i ON d.code = i.code
    WHERE d.date BETWEEN {O.d(TREND_START)} AND {O.d(AS_OF)} AND d.p_change > 4.0"""))
def s01(spark, sf_dir):
    """SQL text over the market views with bound parameters."""
    m = load_market(spark, sf_dir)
    tables.register_views(m, prefix="cw_")
    return tables.sql_scan(
        spark,
        "SELECT d.code, d.date, d.close, i.industry FROM cw_stock_daily d JOIN cw_stock_info i ON d.code = i.code "
        "WHERE d.date BETWEEN :start AND :end AND d.p_change > :min_change",
        start=TREND_START, end=AS_OF, min_change=4.0)


# ------------------------------------------------------ sources and sinks, read back
@register("s04_index_renaming", O.with_base(select="SELECT code, date, close FROM bars WHERE code = 'sh'"))
def s04(spark, sf_dir):
    """Index bars land under the feed's id."""
    feed = load_market(spark, sf_dir).bars.filter(F.col("code") == "sh").select(F.lit("000001").alias("code"), "date", "close")
    return bar_ops.rename_index_ids(feed).select("code", "date", "close")


@register("k01_append_history", O.with_base(select=f"SELECT {O.BAR_COLUMNS} FROM bars WHERE date >= {O.d(LOAD_FROM)}"))
def k01(spark, sf_dir):
    """Landed rows, delivered twice and overlapping what is stored,
    are appended once; a rerun adds nothing."""
    m, path = load_market(spark, sf_dir), fresh_dir(spark, "k01")
    recent = m.bars.filter(F.col("date") >= F.lit(LOAD_FROM))
    tables.append_rows(recent.filter(F.col("date") <= F.lit(AS_OF)), path)
    for _ in range(2):
        stored = spark.read.schema(recent.schema).parquet(path)
        new = fresh_dir(spark, "k01-new")
        bar_ops.append_new(stored, recent.unionByName(recent)).write.parquet(new)
        tables.append_rows(spark.read.schema(recent.schema).parquet(new), path)
    return spark.read.schema(recent.schema).parquet(path)


@register("k02_replace_tables", O.with_base(select="SELECT code, name, industry, esp, pe, c_name FROM info JOIN (SELECT code, c_name FROM concept) USING (code)"))
def k02(spark, sf_dir):
    """Instrument facts and concept tags replaced as a whole,
    read with their schemas."""
    m, root = load_market(spark, sf_dir), fresh_dir(spark, "k02")
    for part in (m.info.limit(1), m.info):
        tables.replace_table(part, f"{root}/stock_info")
    for part in (m.concept.limit(1), m.concept):
        tables.replace_table(part, f"{root}/stock_concept")
    info = tables.read_landed(spark, f"{root}/stock_info", INFO)
    return info.join(tables.read_landed(spark, f"{root}/stock_concept", CONCEPT).select("code", "c_name"), "code")


@register("k05_delete_day", O.with_base(select=f"SELECT {O.BAR_COLUMNS} FROM bars WHERE date <> {O.d(AS_OF)}"))
def k05(spark, sf_dir):
    return bar_ops.delete_day(load_market(spark, sf_dir).bars, AS_OF)


@register("t04_picks_by_percent", O.with_base(select=f"""
    FROM ({O.breakout_sql("trough", "up_trend_low", TREND_START, PRE_START, 0.1, 0.0, AS_OF,
                          f"date >= {O.d(AS_OF)} - 10 AND date < {O.d(AS_OF)}")})
    SELECT code, percent, reason, CAST(row_number() OVER (ORDER BY percent DESC, code) AS INTEGER) AS place"""))
def t04(spark, sf_dir):
    """A slice replaced twice, read by its keys in the order of
    a report."""
    m, root = load_market(spark, sf_dir), fresh_dir(spark, "t04")
    day = AS_OF.isoformat()
    publish.replace_slice(screens.ascending(m, ASC_START, AS_OF), f"{root}/picks", update_date=day, reason="asc")
    for end in (DAY_BEFORE, AS_OF):
        picked = screens.trough_breakout(m, TREND_START, PRE_START, 0.1, 0.0, end)
        publish.replace_slice(picked, f"{root}/picks", update_date=day, reason="up_trend_low")
    rows = publish.read_slice(spark, f"{root}/picks", update_date=day, reason="up_trend_low")
    placed = publish.number_reports(publish.breakout_report(rows))
    return placed.join(rows.select("code", "percent"), "code").select(
        "code", "percent", F.col("report").alias("reason"), F.col("rn").alias("place")).orderBy("place")


@register("t05_volume_trend_by_ratio", f"""
    SELECT code, name, ratio, row_number() OVER (ORDER BY ratio DESC NULLS LAST, code) AS place
    FROM ({O.volume_trend_sql(VT_START, VT_END, 2, 1.0, AS_OF)})""")
def t05(spark, sf_dir):
    """X08 in the order of its list, numbered across partitions."""
    rows = screens.volume_trend(load_market(spark, sf_dir), VT_START, VT_END, 2, 1.0, AS_OF)
    numbered = global_row_number(rows, [F.col("ratio").desc_nulls_last(), F.col("code")], "place")
    return numbered.withColumn("place", F.col("place").cast("bigint")).orderBy("place")


@register("a05_newest_days", O.with_base(select=f"""
    SELECT (SELECT max(date) FROM cal) AS newest_open_day, max(date) AS newest_bar_day, DATE '1900-01-01' AS without_days FROM bars"""))
def a05(spark, sf_dir):
    """Newest open day, newest bar day, and the default of a
    calendar without days."""
    m = load_market(spark, sf_dir)
    newest = calendar.latest_day(m.calendar)  # scalars, as the screens take them
    none = calendar.latest_day(m.calendar.filter(F.lit(False)), calendar.DEFAULT_LATEST)
    return m.bars.agg(F.max("date").alias("newest_bar_day")).select(
        F.lit(newest).cast("date").alias("newest_open_day"), "newest_bar_day", F.lit(none).alias("without_days"))


@register("f05_list_subscripts", O.with_base(
    *O.industry_by_day_ctes(AS_OF, 5, 30, 3),
    select="SELECT industry, date, top_n_stock[1] AS first, top_n_stock[2] AS second, top_n_stock[9] AS ninth, top_n_change[-1] AS least FROM gday"))
def f05(spark, sf_dir):
    """1-based subscripts, null beyond the end, and the last one."""
    by_day = groups.industry_by_day(load_market(spark, sf_dir), AS_OF, top_n=5, n_days=30, ignore_n_days=3)
    return by_day.select("industry", "date", *[nth("top_n_stock", i).alias(n) for i, n in ((1, "first"), (2, "second"), (9, "ninth"))],
                         last("top_n_change").alias("least"))


@register("k08_chart_tables", ORACLE["x19_chart_series"])
def k08(spark, sf_dir):
    """A folder per code, read back (codes keep their leading zeros)."""
    series, root = x19(spark, sf_dir), fresh_dir(spark, "k08")
    publish.write_chart_data(series, root)
    return spark.read.schema(series.schema).parquet(root).select(*series.columns)


def _run(stream) -> None:
    stream.awaitTermination()


@register("r04_quote_history", """
    SELECT DISTINCT CAST(user_id AS VARCHAR) AS code, ts AS event_ts, value AS price, CAST(1 AS DOUBLE) AS volume FROM events""")
def r04(spark, sf_dir):
    """Quotes delivered twice, as a stream run to its end: the
    history has each once."""
    root = fresh_dir(spark, "r04")
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    for _ in range(2):
        events.write.mode("append").parquet(f"{root}/landing")
    raw = quotes.read_stream(spark, f"{root}/landing", events.schema)
    _run(quotes.start_quote_pipeline(quotes.dedupe(quotes.quotes_from_events(raw), "3650 days"), f"{root}/out", f"{root}/checkpoint"))
    return spark.read.parquet(f"{root}/out/history").select("code", F.col("event_ts").cast("timestamp_ntz").alias("event_ts"), "price", "volume")


@register("r05_provisional_bars", O.tick_to_bar_sql(AS_OF))
def r05(spark, sf_dir):
    """R01/R03/R05/S08 over three landings: an early quote of each code with a
    date and a time text, the closing one, then a repeat and a late one that
    change nothing. The stream's keyed state hands on changed codes only."""
    m, root = load_market(spark, sf_dir), fresh_dir(spark, "r05")
    ticks = bar_ops.ticks_from_bars(m.bars, AS_OF)
    at = lambda time, part: ticks.withColumns({"time": F.lit(time), "price": F.col("price") * part})
    for landed in (at("09:30:00", 0.5), ticks, ticks.unionByName(at("11:00:00", 0.25))):
        landed.write.mode("append").parquet(f"{root}/landing")
        raw = quotes.read_stream(spark, f"{root}/landing", ticks.schema).withColumn("event_ts", quotes.event_time())
        _run(latest.start_latest(raw.drop("date", "time"), f"{root}/out", f"{root}/checkpoint", history_bars=m.stocks, fold_every=2))
    return latest.read_provisional(spark, f"{root}/out/provisional").select(*BAR_BASE_COLS)


@register("r03_latest_changes", ORACLE["r03_latest_quote"])
def r03_stream(spark, sf_dir):
    """R03 as keyed state: the quotes land by day of the week, out of order and
    the first lot again; each run hands on the codes that it changes."""
    root = fresh_dir(spark, "r03")
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    lots = [F.dayofweek("ts").isin(*days) for days in ((4, 5), (1, 2, 3), (6, 7), (4, 5))]
    for lot in lots:
        events.filter(lot).write.mode("append").parquet(f"{root}/landing")
        raw = quotes.read_stream(spark, f"{root}/landing", events.schema)
        _run(latest.start_latest(quotes.quotes_from_events(raw), f"{root}/out", f"{root}/checkpoint", fold_every=2))
    return latest.read_latest(spark, f"{root}/out/latest").select("code", F.col("event_ts").cast("timestamp_ntz").alias("event_ts"), "price", "volume")


@register("r06_closed_daily_bars", """
    SELECT CAST(user_id AS VARCHAR) AS code, time_bucket(INTERVAL 1 DAY, ts) AS window_start,
           arg_min(value, (ts, value)) AS open, max(value) AS high, min(value) AS low, arg_max(value, (ts, value)) AS close,
           CAST(count(*) AS DOUBLE) AS volume, count(*) AS n_quotes
    FROM events GROUP BY user_id, time_bucket(INTERVAL 1 DAY, ts)
    HAVING time_bucket(INTERVAL 1 DAY, ts) + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)""")
def r06_stream(spark, sf_dir):
    """R06 as a stream run to its end, twice on one checkpoint: all quotes,
    then the same again with quotes that come too late. The table holds each
    window that the watermark has closed once, without the late quotes; open
    windows wait in the state."""
    root = fresh_dir(spark, "r06")
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    horizon = events.agg(F.max("ts").alias("t")).first()["t"]
    late = events.filter(F.col("ts") < F.lit(horizon - dt.timedelta(days=3)) if horizon else F.lit(False)).withColumns(
        {"value": F.col("value") + 1000, "ts": F.expr("ts + INTERVAL 1 SECOND")})
    for landed in (events, events.unionByName(late)):
        landed.write.mode("append").parquet(f"{root}/landing")
        raw = quotes.read_stream(spark, f"{root}/landing", events.schema)
        _run(quotes.start_daily_bars(quotes.quotes_from_events(raw), f"{root}/bars", f"{root}/checkpoint"))
    return spark.read.parquet(f"{root}/bars")
