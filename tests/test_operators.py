"""Operator units on literal frames: NULL, tie, one-row, empty and short
history cases; each SURVEY §2.12 quirk has a test named after it."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from candlewick.functions import arrays as A
from candlewick.functions import columns as C
from candlewick.operators import bars as B
from candlewick.operators import calendar as cal
from candlewick.operators import stats
from candlewick.operators.windows import extremes, trailing_mean_full
from candlewick.plans import groups, screens

from helpers import bars_df, day, market


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


# ---------------------------------------------------------------- calendar
def test_open_day_nth_last_and_short_calendar(spark):
    m = market(spark, {"sh": [1, 2, 3, 4, 5]})
    assert cal.open_day(m.calendar, day(4), 2) == day(3)
    assert cal.open_day(m.calendar, day(4), 10) == day(0)  # fewer than n -> earliest
    assert cal.latest_day(m.calendar) == day(4)
    assert cal.next_open_day(m.calendar, day(2)) == day(3)
    assert cal.count_open_days(m.calendar, day(1), day(3)) == 3


def test_latest_day_default_when_empty(spark):
    m = market(spark, {"sh": [1]})
    empty = m.calendar.filter(F.lit(False))
    assert cal.latest_day(empty, cal.DEFAULT_LATEST) == dt.date(1900, 1, 1)


# ---------------------------------------------------------------- windows
def test_trailing_mean_partial_frame_and_chart_sma(spark):
    b = bars_df(spark, {"600001": [10, 20, 30]})
    got = rows(b, "date", "ma5")
    assert [r[1] for r in got] == [10.0, 15.0, 20.0]
    sma = b.withColumn("s", trailing_mean_full("close", 3)).orderBy("date").select("s").collect()
    assert [r[0] for r in sma] == [None, None, 20.0]


def test_q04_tie_break_latest_first(spark):
    b = bars_df(spark, {"600001": [1, 5, 1, 1, 5, 1]})
    ext = extremes(b, None, None, "peak", left=1, right=1)
    got = rows(ext, "date", "rank")
    assert got == [(day(1), 2), (day(4), 1)]


def test_q20_edge_of_range_is_a_peak(spark):
    b = bars_df(spark, {"600001": [1, 2, 3, 4]})
    ext = extremes(b, day(0), day(3), "peak")
    assert rows(ext, "date") == [(day(3),)]


def test_peaks_of_negated_close_are_troughs(spark):
    series = [3, 1, 4, 1, 5, 9, 2, 6, 5, 3, 5, 8, 9, 7, 9, 3, 2, 3, 8, 4, 6, 2, 6, 4, 3]
    b = bars_df(spark, {"600001": series})
    lows = extremes(b, None, None, "trough", left=2, right=2)
    neg = b.withColumn("close", -F.col("close"))
    peaks = extremes(neg, None, None, "peak", left=2, right=2)
    assert rows(lows, "date") == rows(peaks, "date")


# ---------------------------------------------------------------- aggregates
def test_a03_a04_extreme_days_with_ties(spark):
    b = bars_df(spark, {"600001": [5, 9, 2, 9, 2]})
    assert rows(stats.max_close_last_day(b, day(0), day(4)), "code", "date", "close") == [("600001", day(3), 9.0)]
    assert rows(stats.max_close_first_day(b, day(0), day(4)), "date") == [(day(1),)]
    assert rows(stats.min_close_first_day(b, day(0), day(4)), "date", "close") == [(day(2), 2.0)]


def test_q01_min_and_max_first_day_differ(spark):
    b = bars_df(spark, {"600001": [5, 9, 2]})
    assert rows(stats.max_close_first_day(b, day(0), day(2)), "close") == [(9.0,)]
    assert rows(stats.min_close_first_day(b, day(0), day(2)), "close") == [(2.0,)]


def test_a20_monotone(spark):
    # rising peaks: 5 then 7 -> monotone; falling: 7 then 5 -> not
    up = bars_df(spark, {"600001": [1, 5, 1, 1, 7, 1], "600002": [1, 7, 1, 1, 5, 1]})
    ext = extremes(up, None, None, "peak", left=1, right=1)
    assert rows(stats.monotone_codes(ext), "code") == [("600001",)]


# ---------------------------------------------------------------- scalar functions
def test_f05_out_of_range_is_null(spark):
    df = spark.createDataFrame([([1.0],)], "a array<double>")
    r = df.select(A.nth("a", 2).alias("x"), A.nth("a", 1).alias("y"), A.last("a").alias("z")).first()
    assert r.x is None and r.y == 1.0 and r.z == 1.0


def test_a_mean_just_below_zero_rounds_to_plain_zero(spark):
    df = spark.createDataFrame([("a", -0.004), ("b", 0.004), ("b", -0.009), ("c", 0.0), ("d", -0.006)], "g string, x double")
    got = {r.g: r.m for r in df.groupBy("g").agg(C.avg_round_fixed("x").alias("m")).collect()}
    assert {g: repr(m) for g, m in got.items()} == {"a": "0.0", "b": "0.0", "c": "0.0", "d": "-0.01"}
    one = spark.createDataFrame([(-1, 1000), (0, 5), (-1, 3)], "p long, n long")
    assert [repr(r[0]) for r in one.select(C.ratio_round("p", "n")).collect()] == ["0.0", "0.0", "-0.33"]


def test_exact_rounding_half_away(spark):
    df = spark.createDataFrame([(1.005,), (-2.5,), (0.155,), (2.675,), (None,)], "x double")
    got = [r[0] for r in df.select(C.round_fixed("x")).collect()]
    assert got == [1.01, -2.5, 0.16, 2.68, None]


def test_avg_round_exact_on_boundary(spark):
    df = spark.createDataFrame([(1.7857,), (0.7772,), (-2.0979,)], "x double")
    assert df.agg(C.avg_round_fixed("x")).first()[0] == 0.16


def test_q15_ratio_of_no_rows_is_null(spark):
    df = spark.createDataFrame([(0, 0), (1, 3), (1, 8)], "p long, n long")
    got = [r[0] for r in df.select(C.ratio_round("p", "n")).collect()]
    assert got == [None, 0.33, 0.13]


def test_f02_f04_text(spark):
    df = spark.createDataFrame([([1.0, 2.5],)], "a array<double>")
    assert df.select(A.join_percent("a")).first()[0] == "1.00%,2.50%"
    df2 = spark.createDataFrame([(0.125,)], "x double")
    assert df2.select(C.percent_text("x", 100)).first()[0] == "12.50%"


def test_f14_f15_exchange_and_link(spark):
    df = spark.createDataFrame([("600001",), ("000002",)], "code string")
    got = [r[0] for r in df.select(C.quote_link()).collect()]
    assert got == ["https://xueqiu.com/S/SH600001", "https://xueqiu.com/S/SZ000002"]


def test_p13_risk_flag(spark):
    df = spark.createDataFrame([("ST Foo",), ("Foo",), ("*ST Bar",)], "name string")
    assert [r[0] for r in df.filter(C.not_risk_flagged()).collect()] == ["Foo"]


def test_q17_nulls_last_in_top_list(spark):
    df = spark.createDataFrame(
        [("d", "g", "a", None), ("d", "g", "b", 1.0), ("d", "g", "c", 3.0)], "date string, grp string, code string, p double")
    out = A.top_k_lists(df, ["date", "grp"], [F.col("p").desc_nulls_last(), F.col("code")], 3,
                        {"codes": F.col("code")}).first()
    assert out.codes == ["c", "b", "a"]


# ---------------------------------------------------------------- joins, groups
def test_j06_limit_up_exclusion_n_minus_1_n_n_plus_1(spark):
    # p_change > 9.5 on 1, 2 and 3 of the last 3 days for three codes
    s = {
        "600001": [100, 100, 100, 111, 100],          # one limit-up day
        "600002": [100, 100, 111, 123, 123],          # two
        "600003": [100, 100, 111, 123, 136],          # three
        "sh": [1, 1, 1, 1, 1],
    }
    m = market(spark, s)
    ex = groups.limit_up_codes(m.bars, day(2), day(4), 2)
    assert rows(ex, "code") == [("600002",), ("600003",)]
    out = groups.industry_by_day(m, day(4), top_n=5, n_days=3, ignore_n_days=2)
    seen = {c for r in out.collect() for c in r.top_n_stock}
    # window of the last 2 open days: only 600003 has 2 limit-up days in it
    assert seen == {"Name600001(600001)", "Name600002(600002)"}


def test_q15_group_with_only_null_changes_still_appears(spark):
    m = market(spark, {"600001": [10], "sh": [1]})
    out = groups.industry_by_day(m, day(0), top_n=5, n_days=1, ignore_n_days=1).first()
    assert out.p_change is None and out.positive_stock_ratio is None


# ---------------------------------------------------------------- screens
def test_q05_single_peak_drops_code(spark):
    m = market(spark, {"600001": [1, 2, 3, 4, 5], "sh": [1, 1, 1, 1, 1]})
    ext = extremes(m.stocks, day(0), day(4), "peak")
    assert screens.two_top_facts(ext, 1.0).count() == 0


def test_q07_no_down_day_dropped_by_default(spark):
    closes = [100, 101, 102, 103, 104, 106, 108, 110]
    m = market(spark, {"600001": closes, "sh": [1] * len(closes)})
    assert screens.volume_breakout(m, day(7), 7, 3, 2).count() == 0
    assert screens.volume_breakout(m, day(7), 7, 3, 2, no_down_day="pass").count() == 1


def test_q06_no_look_ahead(spark):
    base = {"600001": [100, 98, 99, 101, 103, 102, 104, 106], "sh": [1] * 8}
    longer = {"600001": base["600001"] + [90, 80, 120], "sh": [1] * 11}
    a = screens.continuous_increase(market(spark, base), day(7), 1)
    b = screens.continuous_increase(market(spark, longer), day(7), 1)
    assert rows(a, "code", "p_change") == rows(b, "code", "p_change")
    a = screens.volume_breakout(market(spark, base), day(7), 7, 3, 1, no_down_day="pass")
    b = screens.volume_breakout(market(spark, longer), day(7), 7, 3, 1, no_down_day="pass")
    assert rows(a, "code") == rows(b, "code")


def test_q12_latest_asc_counts_distinct_days(spark):
    m = market(spark, {"600001": [10, 11, 12, 13], "sh": [1, 1, 1, 1]})
    dup = m.bars.unionByName(m.bars.filter(F.col("date") == day(3)))
    held = (dup.filter(F.col("date").between(day(2), day(3)))
            .groupBy("code").agg(F.count_distinct("date").alias("n")))
    assert {r.n for r in held.collect()} == {2}


def test_q02_volume_rules(spark):
    # down days with volumes 100 -> 150 (+50 %): passes at 1.0, fails at 0.4
    closes = [10, 9, 10, 9, 10]
    vols = [100, 100, 120, 150, 300]  # day 0 has no previous close: p_change NULL
    m = market(spark, {"600001": closes, "sh": [1] * 5}, volumes={"600001": vols})
    assert screens.volume_trend_codes(m, day(0), day(4), 2, 1.0).count() == 1
    assert screens.volume_trend_codes(m, day(0), day(4), 2, 0.4).count() == 0
    # up-day volumes below the largest down-day volume: 1 of them (day 2: 120 < 150)
    assert screens.volume_trend_codes(m, day(0), day(4), 0, 1.0).count() == 0


def test_interval_return_drops_code_missing_on_a_day(spark):
    m = market(spark, {"600001": [10, 11, 12], "600002": [10, 11, 12], "sh": [1, 1, 1]},
               gaps={"600002": {0}})
    out = screens.interval_return(m, 3, day(2))
    assert rows(out, "code", "percent") == [("600001", pytest.approx(0.2))]


# ---------------------------------------------------------------- bar maintenance
def test_q10_final_beats_provisional_and_upsert(spark):
    final = bars_df(spark, {"600001": [10, 11]})
    prov = final.withColumn("close", F.col("close") + 100).unionByName(
        bars_df(spark, {"600001": [10, 11, 12]}).filter(F.col("date") == day(2)).withColumn("close", F.lit(7.0)))
    merged = B.merge_provisional(final, prov)
    assert rows(merged, "date", "close") == [(day(0), 10.0), (day(1), 11.0), (day(2), 7.0)]
    up = B.upsert(final, prov)
    assert rows(up, "date", "close") == [(day(0), 110.0), (day(1), 111.0), (day(2), 7.0)]


def test_k01_append_is_idempotent(spark):
    stored = bars_df(spark, {"600001": [10, 11]})
    incoming = bars_df(spark, {"600001": [10, 11, 12]})
    new = B.append_new(stored, incoming.unionByName(incoming))
    assert rows(new, "date") == [(day(2),)]
    assert B.append_new(stored.unionByName(new), incoming).count() == 0


def test_q21_incremental_ma_equals_full_rebuild_with_gaps(spark):
    closes = [float(i % 17 + i) for i in range(300)]
    full = bars_df(spark, {"600001": closes, "600002": closes[:280]}, gaps={"600002": {5, 6, 7}})
    stored = full.filter(F.col("date") <= day(200))
    inc = B.extend_moving_averages(stored, full)
    expect = full.filter(F.col("date") > day(200))
    cols = ["code", "date", "ma5", "ma30", "ma250", "v_ma20"]
    assert rows(inc, *cols) == rows(expect, *cols)


def test_s02_incremental_rows(spark):
    stored = bars_df(spark, {"600001": [1, 2, 3]})
    landed = bars_df(spark, {"600001": [1, 2, 3, 4], "600002": [5]})
    assert rows(B.incremental_rows(stored, landed), "code", "date") == [("600001", day(3)), ("600002", day(0))]


def test_q11_universe_drops_bad_codes(spark):
    info = spark.createDataFrame([("600001",), ("12345",), (None,)], "code string")
    got = {r.code for r in B.universe(spark, info).collect()}
    assert got == {"600001", "sh", "sz", "hs300", "sz50", "zxb", "cyb"}


def test_x03_tick_needs_k_bars(spark):
    hist = bars_df(spark, {"600001": list(range(10, 17))})  # 7 bars -> ma5 defined, ma10 NULL
    ticks = spark.createDataFrame(
        [("600001", day(7), 16.0, 18.0, 15.0, 17.0, 16.0, 500.0)],
        "code string, date date, open double, high double, low double, price double, pre_close double, volume double")
    r = B.tick_to_bar(ticks, hist, day(7)).first()
    # ma5 of days 2..6 = 14; rolling update drops close of rank 5 (day 2 = 12)
    assert r.ma5 == pytest.approx(14 + (17 - 12) / 5)
    assert r.ma10 is None and r.volume == 5.0 and r.p_change == pytest.approx(100 / 16)


def test_s04_index_ids_renamed(spark):
    landed = spark.createDataFrame([("000001", day(0), 1.0), ("399006", day(0), 2.0), ("999999", day(0), 3.0)],
                                   "code string, date date, close double")
    got = rows(B.rename_index_ids(landed), "code", "close")
    assert got == [("cyb", 2.0), ("sh", 1.0)]


def test_k05_delete_newest_day(spark):
    b = bars_df(spark, {"600001": [1, 2, 3]})
    assert rows(B.delete_day(b, day(2)), "date") == [(day(0),), (day(1),)]


def test_s03_high_water_mark(spark):
    b = bars_df(spark, {"600001": [1, 2, 3]})
    r = B.high_water_mark(b).first()
    assert (r.hwm, r.start_day) == (day(2), day(3))


# ---------------------------------------------------------------- more §2.12 decisions
def test_q03_q18_volume_trend_uses_calendar_and_next_open_day(spark):
    # calendar has a gap after day 4: the forward day must be day 6, not day 5
    closes = [10, 9, 10, 9, 10, 99, 10.5, 11]
    m = market(spark, {"600001": closes, "sh": [1] * 8}, gaps={"sh": {5}, "600001": {5}})
    out = screens.volume_trend(m, day(0), day(4), 5, 10.0, day(7)).first()
    # min_close = close on day 6 (10.5, +5 %), max_close = high on day 7 (11 + 1)
    assert out.ratio == pytest.approx((12 - 10.5) / 10.5)


def test_q09_report_sorts_numbers_not_text(spark):
    from candlewick.plans import publish as P
    rows_ = spark.createDataFrame(
        [("I", "A", "600001", 9.0, 2, 1), ("I", "B", "600002", 10.0, 2, 1), ("I", "B", "600002", 10.0, 2, 2)],
        "industry string, name string, code string, p_change double, n_days int, interval int")
    got = P.number_reports(P.all_mas_report(rows_)).orderBy("rn").collect()
    assert [r.code for r in got] == ["600002", "600001"]     # A22: one row per pick
    assert got[0].value == "10.00%"


def test_q13_q14_summary_of_this_run_and_top_n(spark):
    s = {f"60000{i}": [10 + (i * j) % 7 for j in range(12)] for i in range(1, 8)}
    s["sh"] = [1] * 12
    m = market(spark, s)
    by_day = groups.concept_by_day(m, day(11), top_n=3, n_days=4, limit_up_days=2)
    assert max(len(r.top_n_stock) for r in by_day.collect()) == 3
    summ = groups.concept_summary(m, day(11), top_n=3, n_days=4, limit_up_days=2).first()
    assert len(summ.p_change) == 4 and len(summ.top_n_stock) <= 3


def test_q16_first_kept_day_and_q22_update_date(spark):
    # p_change: +7 % (dropped by the [-3, 5] filter), then -1 %, +2 %, +1.5 %
    closes = [100, 107, 105.93, 108.0486, 109.669329]
    m = market(spark, {"600001": closes, "sh": [1] * 5})
    out = screens.continuous_increase(m, day(4), 2).collect()
    assert len(out) == 0 or out[0].update_date == day(4)
    m2 = market(spark, {"600001": closes[1:], "sh": [1] * 4}, start=1)
    assert all(r.update_date == day(4) for r in screens.continuous_increase(m2, day(4), 1).collect())


def test_q23_q24_report_values(spark):
    from candlewick.plans import publish as P
    picks = spark.createDataFrame([("I", "A", "600001", 0.05)], "industry string, name string, code string, percent double")
    assert P.breakout_report(picks, "up_trend").first().value == "5.00%"
    cont = spark.createDataFrame([("I", "A", "600001", [1.0, 2.5], 2)],
                                 "industry string, name string, code string, p_change array<double>, n_days int")
    assert P.increase_report(cont).first().value == "1.00%,2.50%"


def test_all_index_series_are_not_stocks(spark):
    m = market(spark, {"600001": [1, 2], "sh": [1, 1], "hs300": [1, 1], "cyb": [2, 2]})
    assert {r.code for r in m.stocks.select("code").distinct().collect()} == {"600001"}


def test_w02_table_update_keeps_index_columns(spark):
    from candlewick.operators.windows import with_bar_index
    full = with_bar_index(bars_df(spark, {"600001": [float(10 + i % 7) for i in range(40)]}))
    stored = full.filter(F.col("date") <= day(30))
    out = B.refresh_moving_averages(stored, full.drop("bar_no", "tail_from"))
    assert set(out.columns) == set(full.columns)
    assert rows(out, "date", "bar_no", "ma5") == rows(full, "date", "bar_no", "ma5")


def test_w07_recency_rank_and_w09_lag_change(spark):
    from candlewick.operators.windows import lag_change, recency_rank
    b = bars_df(spark, {"600001": [10, 11, 12, 13]}, volumes={"600001": [100, 150, 75, 75]})
    ranked = recency_rank(b, day(1), day(3))
    assert rows(ranked, "date", "rank") == [(day(1), 3), (day(2), 2), (day(3), 1)]
    chg = b.select("date", lag_change(b, "volume").alias("c")).orderBy("date").collect()
    assert [r.c for r in chg] == [None, 0.5, -0.5, 0.0]


def test_peaks_and_troughs_in_one_pass_equal_separate_extremes(spark):
    from candlewick.operators.windows import peaks_and_troughs
    series = [3, 1, 4, 1, 5, 9, 2, 6, 5, 3, 5, 8, 9, 7, 9, 3, 2, 3, 8, 4, 6, 2, 6, 4, 3, 3, 3]
    b = bars_df(spark, {"600001": series, "000002": series[::-1]})
    both = peaks_and_troughs(b, day(2), day(24), left=2, right=2)
    for kind in ("peak", "trough"):
        sep = extremes(b, day(2), day(24), kind, left=2, right=2)
        assert rows(both.filter(F.col("kind") == kind), "code", "date", "close", "rank", "date_rank") == \
            rows(sep, "code", "date", "close", "rank", "date_rank")
