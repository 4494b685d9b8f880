"""Publishing, indicators and quote streams."""

import os
import shutil

import numpy as np
from pyspark.sql import functions as F

from candlewick.operators import indicators as I
from candlewick.plans import publish as P
from candlewick.streaming import quotes as Q

from helpers import day, market

EVENTS = "/root/testdata/sf0.001/events.parquet"


def test_k04_rerun_with_empty_result_clears_the_slice(spark, tmp_dir):
    root = f"{tmp_dir}/picks"
    picks = spark.createDataFrame([("600001", 0.1)], "code string, percent double")
    other = spark.createDataFrame([("600002", 0.2)], "code string, percent double")
    P.replace_slice(picks, root, update_date="2015-11-24", reason="asc")
    P.replace_slice(other, root, update_date="2015-11-24", reason="up_ma")
    P.replace_slice(picks, root, update_date="2015-11-24", reason="asc")  # rerun: same rows
    assert P.read_slice(spark, root, reason="asc").count() == 1
    P.replace_slice(picks.filter(F.lit(False)), root, update_date="2015-11-24", reason="asc")
    assert P.read_slice(spark, root, reason="asc").count() == 0
    assert P.read_slice(spark, root, reason="up_ma").count() == 1


def test_k07_report_layout(spark):
    picks = spark.createDataFrame(
        [(f"IND", f"N{i}", f"60000{i}", 0.01 * i) for i in range(1, 6)],
        "industry string, name string, code string, percent double")
    lines = P.report_lines(P.breakout_report(picks, "up_trend"), "2015-11-24", reports=["up_trend"]).orderBy(
        "line_no").collect()
    assert len(lines) == 1 + 5 + 3
    assert lines[0].text.startswith("Trend breakout picks (2015-11-24)")
    assert lines[1].text == "[IND][5.00%]:$N5(SH600005)$"
    assert lines[2].text == "[IND][5.00%]:\tN5 : https://xueqiu.com/S/SH600005"
    assert [r.line_no for r in lines] == list(range(1, 10))
    empty = P.report_lines(P.breakout_report(picks.limit(0), "callback"), "2015-11-24", reports=["callback"])
    assert [r.text for r in empty.collect()] == ["Breakout pull-back picks (2015-11-24)"]  # header without picks


def test_k08_chart_series_one_folder_per_code(spark, tmp_dir):
    m = market(spark, {"600001": list(range(10, 50)), "000002": list(range(10, 50))})
    picks = spark.createDataFrame([("600001",)], "code string")
    s = P.chart_series(m.bars, picks, m.info, since=day(0), bollinger=True)
    assert s.select("code").distinct().count() == 1
    assert s.filter(F.col("sma30").isNotNull()).count() == 40 - 29
    P.write_chart_data(s, f"{tmp_dir}/charts")
    assert os.listdir(f"{tmp_dir}/charts").count("code=600001") == 1


def _plain_ema(x, n, alpha):
    out, e = [np.nan] * min(n - 1, len(x)), None
    for i in range(n - 1, len(x)):
        e = np.mean(x[:n]) if e is None else (1 - alpha) * e + alpha * x[i]
        out.append(e)
    return np.array(out)


def _plain_indicators(close):
    """rsi14, macd, macd_signal by plain loops."""
    x = np.array(close, float)
    macd = _plain_ema(x, 12, 2 / 13) - _plain_ema(x, 26, 2 / 27)
    signal = np.concatenate([[np.nan] * min(25, len(x)), _plain_ema(macd[25:], 9, 0.2)])
    change = np.diff(x)
    gain, loss = _plain_ema(np.maximum(change, 0), 14, 1 / 14), _plain_ema(np.maximum(-change, 0), 14, 1 / 14)
    rsi = [np.nan] + [np.nan if np.isnan(g) else 100.0 if v == 0 else 100 - 100 / (1 + g / v) for g, v in zip(gain, loss)]
    return np.array(rsi[: len(x)]), macd, signal


def _series(df, code):
    return df[df.code == code].sort_values("date").reset_index(drop=True)


def _closes(n, seed):
    return np.round(20 + np.cumsum(np.random.default_rng(seed).normal(0, 0.5, n)), 2).tolist()


def test_u01_equals_plain_recursion_at_seed_and_block_edges(spark):
    lengths = (1, 2, 11, 12, 14, 15, 16, 25, 26, 33, 34, 35, 63, 64, 65, 128, 129, 300)
    closes = {f"{600000 + n}": _closes(n, n) for n in lengths}
    rows = [(c, day(i), v) for c, vs in closes.items() for i, v in enumerate(vs)]
    out = I.recursive_indicators(spark.createDataFrame(rows, "code string, date date, close double")).toPandas()
    for code, vs in closes.items():
        got = _series(out, code)
        for name, want in zip(("rsi14", "macd", "macd_signal"), _plain_indicators(vs)):
            np.testing.assert_allclose(got[name].to_numpy(float), want, rtol=1e-9, atol=1e-9, err_msg=f"{code} {name}")


def test_u01_bar_without_close_is_no_step_and_empty_table(spark):
    vs = _closes(60, 1)
    rows = [("600001", day(2 * i), v) for i, v in enumerate(vs)] + [("600001", day(81), None), ("600002", day(0), None)]
    bars = spark.createDataFrame(rows, "code string, date date, close double")
    out = I.recursive_indicators(bars).toPandas()
    one = _series(out, "600001")
    gap = one[one.close.isna()]
    assert len(gap) == 1 and gap[["rsi14", "macd", "macd_signal", "macd_hist"]].isna().all(axis=None)
    np.testing.assert_allclose(one[one.close.notna()].macd.to_numpy(float), _plain_indicators(vs)[1], rtol=1e-9, atol=1e-9)
    assert _series(out, "600002").macd.isna().all()
    assert I.recursive_indicators(bars.limit(0)).count() == 0


def test_u01_runs_that_go_on_equal_one_whole_run(spark, tmp_dir):
    """Appended days, a new code, a code that pauses, corrections of the newest day, of the middle and of the first
    day, and a run with nothing new."""
    from candlewick.plans import smoothed
    a, b, c = _closes(90, 1), _closes(90, 2), _closes(40, 3)
    full = [("600001", day(i), v) for i, v in enumerate(a)] + [("600002", day(i), v) for i, v in enumerate(b) if not 50 <= i < 70]
    full += [("600003", day(i + 50), v) for i, v in enumerate(c)]
    kinds, root = "code string, date date, close double", f"{tmp_dir}/smoothed"
    frame = lambda rows: spark.createDataFrame(rows, kinds)
    want = I.recursive_indicators(frame(full)).toPandas()
    first = [(k, d, v + (5 if (k, d) in {("600001", day(0)), ("600002", day(20))} else 0)) for k, d, v in full if d <= day(40)]
    smoothed.refresh(spark, root, frame(first))
    smoothed.refresh(spark, root, frame([r for r in full if r[1] <= day(40)]),
                     landed=spark.createDataFrame([("600001", day(0)), ("600002", day(20))], "code string, date date"))
    for end in (41, 60, 60):
        smoothed.refresh(spark, root, frame([r for r in full if r[1] <= day(end)]))
    smoothed.refresh(spark, root, frame([(k, d, v * (2 if d == day(75) else 1)) for k, d, v in full if d <= day(75)]))
    keys = [(k, d) for k, d, _ in full if d >= day(75)]
    assert smoothed.refresh(spark, root, frame(full), landed=spark.createDataFrame(keys, "code string, date date")) == 7
    got = smoothed.read_indicators(spark, root).toPandas()
    assert len(got) == len(full)
    for code in ("600001", "600002", "600003"):
        x, y = _series(got, code), _series(want, code)
        assert x.date.tolist() == y.date.tolist()
        for name in ("close", "rsi14", "macd", "macd_signal", "macd_hist"):
            np.testing.assert_allclose(x[name].to_numpy(float), y[name].to_numpy(float), rtol=1e-12, err_msg=f"{code} {name}")


def test_w03_runs_that_go_on_equal_one_whole_run(spark, tmp_dir):
    """After each run the kept extremes equal those of the whole series: appended days one by one, a new code, a pause,
    ties, a null, changes within the slack and before it, late bars, deleted newest bars, and changes after deletions."""
    import random

    from candlewick.operators.windows import peaks_and_troughs
    from candlewick.plans import kept_extremes
    rnd, kinds, root = random.Random(4), "code string, date date, close double", f"{tmp_dir}/kept"
    frame = lambda rows: spark.createDataFrame([(k, d, v) for (k, d), v in sorted(rows.items())], kinds)
    table = {(k, day(i)): float(rnd.randrange(8)) for k in ("600001", "600002", "600003") for i in range(60)
             if not (k == "600002" and 25 <= i < 40) and not (k == "600003" and i < 45)}
    table["600001", day(30)] = None
    stored = {k: v for k, v in table.items() if k[1] <= day(40)}

    def run(landed=None):
        keys = None if landed is None else spark.createDataFrame(landed, "code string, date date")
        kept_extremes.refresh(spark, root, frame(stored), day(3), keys)
        got = kept_extremes.read_extremes(spark, root).collect()
        want = peaks_and_troughs(frame(stored), day(3), None).select("code", "kind", "date", "close", "rank", "date_rank").collect()
        assert sorted(map(tuple, got)) == sorted(map(tuple, want)) and len(want) > 5

    run()
    run()  # nothing new
    for end in (41, 47):
        stored |= {k: v for k, v in table.items() if k[1] <= day(end)}
        run()
    changes = [("600001", day(45), 9.0), ("600001", day(20), 9.0), ("600002", day(30), 5.0)]  # in the slack, before it, a late bar
    for k, d, v in changes:
        stored[k, d] = v
        run([(k, d)])
    gone = [k for k in stored if k[0] == "600001" and k[1] > day(34)]
    for k in gone:
        del stored[k]
    run(gone)
    stored |= {k: table[k] for k in gone}
    run(gone)
    stored |= {k: v for k, v in table.items() if k[1] > day(47)}
    run([k for k in table if k[1] > day(47)])


def test_w03_a_new_day_reads_only_the_tail(spark, tmp_dir):
    """The plan's scans: bars behind the newest day by a pushed-down date; settled rows of earlier runs stay as they are."""
    from candlewick.plans import kept_extremes
    from candlewick.sources import versions
    root, kinds = f"{tmp_dir}/kept", "code string, date date, close double"
    rows = [("600001", day(i), float(i * 37 % 11)) for i in range(101)]
    kept_extremes.refresh(spark, root, spark.createDataFrame(rows[:100], kinds), day(0))
    first = versions.manifest(spark, root)["tables"]
    kept_extremes.refresh(spark, root, spark.createDataFrame(rows, kinds).filter(F.col("date") >= F.lit(day(99))), day(0))  # no history given
    second = versions.manifest(spark, root)["tables"]
    assert second["settled"][:1] == first["settled"] and len(second["settled"]) == 2
    assert spark.read.parquet(f"{root}/{second['tail'][0]}").count() == kept_extremes.TAIL
    from candlewick.operators.windows import peaks_and_troughs
    want = peaks_and_troughs(spark.createDataFrame(rows, kinds), None, None).select("code", "kind", "date", "close", "rank", "date_rank")
    assert sorted(map(tuple, kept_extremes.read_extremes(spark, root).collect())) == sorted(map(tuple, want.collect()))


def test_u01_rsi_bounds_and_macd_per_code(spark):
    m = market(spark, {"600001": [10 + (i % 7) - (i % 3) for i in range(60)], "600002": list(range(10, 70))})
    out = I.recursive_indicators(m.bars).toPandas()
    assert out.groupby("code").size().to_dict() == {"600001": 60, "600002": 60}
    rsi = out["rsi14"].dropna()
    assert ((rsi >= 0) & (rsi <= 100)).all()
    rising = out[out.code == "600002"].sort_values("date")
    assert rising["rsi14"].dropna().eq(100.0).all()
    assert rising["macd"].isna().sum() == 25


def _copy_events(tmp_dir):
    src = f"{tmp_dir}/src"
    os.makedirs(src)
    shutil.copy(EVENTS, f"{src}/part-0.parquet")
    return src


def test_r06_closed_stream_windows_equal_batch(spark, tmp_dir):
    ev = spark.read.parquet(EVENTS)
    batch = Q.daily_bars(Q.quotes_from_events(ev), watermark=None)
    st = Q.read_stream(spark, _copy_events(tmp_dir), ev.schema)
    q = (Q.daily_bars(Q.quotes_from_events(st), watermark="1 hour").writeStream.format("memory")
         .queryName("r06_test").outputMode("append").option("checkpointLocation", f"{tmp_dir}/ck")
         .trigger(availableNow=True).start())
    q.awaitTermination(180)
    out = spark.sql("SELECT * FROM r06_test")
    assert 0 < out.count() < batch.count()          # open windows are not emitted
    assert out.exceptAll(batch).count() == 0         # every closed window equals batch


def test_r02_r04_dedupe_and_exactly_once_history(spark, tmp_dir):
    ev = spark.read.parquet(EVENTS)
    src = _copy_events(tmp_dir)
    shutil.copy(EVENTS, f"{src}/part-1-repeat.parquet")  # the same quotes delivered twice
    q = Q.start_quote_pipeline(Q.dedupe(Q.quotes_from_events(Q.read_stream(spark, src, ev.schema))),
                               f"{tmp_dir}/out", f"{tmp_dir}/ck")
    q.awaitTermination(180)
    hist = spark.read.parquet(f"{tmp_dir}/out/history")
    distinct = ev.select("user_id", "ts").distinct().count()
    assert hist.count() == distinct
    latest = spark.read.parquet(f"{tmp_dir}/out/latest")
    newest = latest.agg(F.max("batch_id")).first()[0]
    cur = latest.filter(F.col("batch_id") == newest)
    assert cur.count() == ev.select("user_id").distinct().count()
    # restart on the same checkpoint: nothing new to process, history unchanged
    q2 = Q.start_quote_pipeline(Q.dedupe(Q.quotes_from_events(Q.read_stream(spark, src, ev.schema))),
                                f"{tmp_dir}/out", f"{tmp_dir}/ck")
    q2.awaitTermination(180)
    assert spark.read.parquet(f"{tmp_dir}/out/history").count() == distinct


def test_r01_event_time(spark):
    df = spark.createDataFrame([("2015-11-24", "15:00:00")], "date string, time string")
    ts = df.select(Q.event_time().alias("t")).first().t
    assert (ts.hour, ts.minute) == (15, 0)


def test_r05_stream_snapshot_to_provisional_bar_equals_batch(spark, tmp_dir):
    from candlewick.operators import bars as B
    m = market(spark, {"600001": [float(10 + i % 5 + i) for i in range(40)],
                       "000002": [float(50 - i % 3) for i in range(40)], "sh": [1.0] * 40})
    snap_day = day(39)
    ticks = B.ticks_from_bars(m.bars, snap_day)
    batch = B.tick_to_bar(ticks, m.stocks, snap_day)
    quotes_df = ticks.withColumn("event_ts", Q.event_time())
    src = f"{tmp_dir}/ticks"
    quotes_df.write.parquet(src)
    st = Q.read_stream(spark, src, quotes_df.schema)
    q = Q.start_quote_pipeline(st, f"{tmp_dir}/out", f"{tmp_dir}/ck", history_bars=m.stocks, as_of=snap_day)
    q.awaitTermination(180)
    prov = spark.read.parquet(f"{tmp_dir}/out/provisional").drop("batch_id")
    assert prov.count() == 2
    assert prov.select(*batch.columns).exceptAll(batch).count() == 0


def test_python_workers_do_not_need_the_package_installed(tmp_dir):
    """applyInPandas code travels with the task: run from a folder where the
    package cannot be imported by the workers."""
    import subprocess
    import sys
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = (
        "import sys; sys.path.insert(0, %r)\n"
        "from pyspark.sql import SparkSession\n"
        "s = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').getOrCreate()\n"
        "import __spark_entry__ as E\n"
        "print('ROWS', len(E.queries()['x19_chart_rsi_macd'](s, '/root/testdata/sf0.001').collect()))\n" % repo
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_dir, env=env, capture_output=True, text=True,
                         timeout=300)
    assert "ROWS 515" in out.stdout, out.stderr[-2000:]


def test_daily_runs_write_slices_reports_and_charts(spark, tmp_dir):
    from candlewick.plans import runs
    from candlewick.plans.market import load_market
    m = load_market(spark, "/root/testdata/sf0.01")
    out = f"{tmp_dir}/out"
    runs.run_screens(m, "2015-11-24", out)
    runs.run_screens(m, "2015-11-24", out)  # rerun replaces, never duplicates
    picks = P.read_slice(spark, f"{out}/picks", update_date="2015-11-24")
    assert picks.filter(F.col("reason") == "asc").count() == 18
    assert picks.filter(F.col("reason") == "up_trend").count() == 4
    path = runs.run_reports(spark, "2015-11-24", out)
    texts = spark.read.text(path).collect()
    assert any(r.value.startswith("Trend breakout picks (2015-11-24)") for r in texts)
    charts = runs.run_charts(m, "2015-11-24", out, "asc")
    series = spark.read.parquet(charts)
    assert series.select("code").distinct().count() == 18
    assert {"rsi14", "macd", "macd_signal", "macd_hist", "sma5"} <= set(series.columns)
    assert series.filter("rsi14 IS NOT NULL").count() > 0
    percents = [r.percent for r in runs.read_picks(spark, "2015-11-24", out).collect()]
    assert percents == sorted(percents, reverse=True)
    for _ in range(2):  # each slice is replaced by a rerun
        done = runs.run_trends(m, "2015-11-24", out)
        counts = {k: spark.read.parquet(v).count() for k, v in done.items()}
    assert counts["interval_return"] == 646 and counts["excess_return"] == 592 and counts["hot_industries"] == 329
    assert counts["volume_trend"] > 0 and "start_day=2015-" in done["interval_return"]


def test_r06_late_quotes_beyond_watermark_are_dropped(spark, tmp_dir):
    import datetime as dt
    schema = "code string, event_ts timestamp, price double, volume double"
    t = lambda d, h: dt.datetime(2015, 11, d, h)
    src = f"{tmp_dir}/q"
    # batch 1: day 20 and day 22 quotes -> watermark moves to day 22 - 1 h
    spark.createDataFrame([("A", t(20, 10), 1.0, 1.0), ("A", t(20, 11), 2.0, 1.0), ("A", t(22, 10), 5.0, 1.0)],
                          schema).coalesce(1).write.parquet(f"{src}/b1")
    q = (Q.daily_bars(Q.read_stream(spark, f"{src}/b*", spark.createDataFrame([], schema).schema), "1 hour")
         .writeStream.format("memory").queryName("late_test").outputMode("append")
         .option("checkpointLocation", f"{tmp_dir}/ck").start())
    q.processAllAvailable()
    # batch 2: a late quote for day 20 (behind the watermark) and a repeat of day 22
    spark.createDataFrame([("A", t(20, 12), 99.0, 1.0), ("A", t(23, 10), 6.0, 1.0)], schema).coalesce(1).write.parquet(
        f"{src}/b2")
    q.processAllAvailable()
    q.stop()
    out = {r.window_start.day: r for r in spark.sql("SELECT * FROM late_test").collect()}
    assert out[20].close == 2.0 and out[20].n_quotes == 2     # the late 99.0 never entered the closed window
    assert 23 not in out                                      # the newest window is still open


def test_live_job_from_feed_layout_files(spark, tmp_dir):
    from candlewick.operators import bars as B
    from candlewick.plans.market import load_market
    from candlewick.schema import QUOTE
    from candlewick.streaming import latest, live
    m = load_market(spark, "/root/testdata/sf0.01")
    as_of = __import__("datetime").date(2015, 11, 24)
    ticks = B.ticks_from_bars(m.bars, as_of)
    feed = ticks.select(*[F.col(c) if c in ticks.columns else F.lit(None).cast(QUOTE[c].dataType).alias(c)
                          for c in QUOTE.fieldNames()])
    feed.write.parquet(f"{tmp_dir}/quotes/part1")
    feed.write.parquet(f"{tmp_dir}/quotes/part2")  # the same snapshot delivered twice
    q = live.start(spark, m, f"{tmp_dir}/quotes/*", f"{tmp_dir}/out", as_of)
    q.awaitTermination(300)
    prov = latest.read_provisional(spark, f"{tmp_dir}/out/live/provisional")
    batch = B.tick_to_bar(ticks, m.stocks, as_of)
    assert prov.count() == batch.count() == 78
    assert prov.select(*batch.columns).exceptAll(batch).count() == 0
    assert spark.read.parquet(f"{tmp_dir}/out/live/history").count() == 78


def test_refresh_job_with_landed_files(spark, tmp_dir):
    import datetime as dt
    from candlewick.operators import bars as B
    from candlewick.plans import runs
    from candlewick.plans.market import load_market
    from candlewick.plans import pipeline
    m = load_market(spark, "/root/testdata/sf0.01")
    newest = dt.date(2015, 12, 24)
    m.daily.filter(F.col("date") == F.lit(newest)).write.parquet(f"{tmp_dir}/landed")  # the day landed again
    out = runs.run_refresh(m, f"{tmp_dir}/landed", f"{tmp_dir}/out")
    assert out["months"] == ["2015-12"]
    book = pipeline.open_book(spark, out["book"])
    assert book.daily.exceptAll(m.daily).count() == 0 and book.daily.count() == m.daily.count()
    cols = ["code", "date", "ma5", "ma250", "bar_no", "tail_from"]
    assert book.numbered.select(*cols).exceptAll(m.numbered.select(*cols)).count() == 0
    assert book.ma_state.exceptAll(B.last_rows(m.numbered)).count() == 0
    # the next run needs no market: it goes on from the book, with the newest batch of provisional bars
    day = newest + dt.timedelta(days=7)
    new = m.daily.filter(F.col("date") == F.lit(newest)).withColumn("date", F.lit(day))
    for batch, close in ((0, 1.0), (1, 2.0)):
        new.withColumn("close", F.lit(close)).write.parquet(f"{tmp_dir}/live/batch_id={batch}")
    assert runs.run_refresh(None, None, f"{tmp_dir}/out", f"{tmp_dir}/live", spark)["months"] == ["2015-12"]
    book = pipeline.open_book(spark, out["book"])
    assert [r.close for r in book.bars.filter(F.col("date") == F.lit(day)).select("close").distinct().collect()] == [2.0]
    assert book.calendar.agg(F.max("date")).first()[0] == day


def test_r03_a_batch_writes_the_codes_that_it_changes(spark, tmp_dir):
    """Rows written equal changed codes: new, newer and greater quotes of the
    same time change a code, older and repeated ones do not; a folded table
    reads the same, and a restart goes on from the state."""
    import datetime as dt
    from candlewick.streaming import latest
    t = lambda h: dt.datetime(2015, 11, 24, h)
    schema = spark.createDataFrame([], "code string, event_ts timestamp, price double, volume double").schema
    lots = [([("A", t(10), 1.0, 1.0), ("B", t(10), 2.0, 1.0)], {"A", "B"}),
            ([("A", t(10), 1.0, 1.0), ("B", t(9), 9.0, 1.0)], set()),        # a repeat and a late one
            ([("A", t(11), 3.0, 1.0), ("B", t(10), 2.0, 1.0), ("C", t(8), 5.0, 1.0)], {"A", "C"}),
            ([("B", t(10), 2.5, 1.0)], {"B"}),                              # same time, greater price
            ([("C", t(12), 6.0, 1.0), ("C", t(13), 7.0, 1.0)], {"C"})]
    seen = []
    for rows, changed in lots:
        seen += rows
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp_dir}/in")
        q = latest.start_latest(Q.read_stream(spark, f"{tmp_dir}/in", schema), f"{tmp_dir}/out", f"{tmp_dir}/ck", fold_every=2)
        q.awaitTermination(120)
        ids = latest._numbers(spark, f"{tmp_dir}/out/latest/changes", "batch_id")
        last = spark.read.schema(schema).parquet(f"{tmp_dir}/out/latest/changes/batch_id={ids[-1]}").collect()
        assert {r.code for r in last} == changed and len(last) == len(changed)
        now = latest.read_latest(spark, f"{tmp_dir}/out/latest")
        assert now.select(schema.fieldNames()).exceptAll(Q.latest(spark.createDataFrame(seen, schema))).count() == 0
        assert now.count() == len({r[0] for r in seen})
    assert latest._numbers(spark, f"{tmp_dir}/out/latest/base", "upto") == [1, 3]
    assert latest._numbers(spark, f"{tmp_dir}/out/latest/changes", "batch_id")[0] == 2  # folded ones are gone


def test_r03_a_replayed_batch_rewrites_its_own_rows(spark, tmp_dir):
    from candlewick.streaming import latest
    rows = spark.createDataFrame([("A", 1.0)], "code string, price double")
    for batch in range(7):
        for _ in range(2):
            latest._put(spark, rows.withColumn("price", F.lit(float(batch))), f"{tmp_dir}/t", batch, fold_every=3)
    assert [tuple(r) for r in latest.read_latest(spark, f"{tmp_dir}/t").select("code", "price").collect()] == [("A", 6.0)]


def test_r06_stream_appends_each_closed_window_once(spark, tmp_dir):
    """The running stream: repeats within the watermark are counted once, late
    quotes not at all, a restart continues with the open windows."""
    import datetime as dt
    schema = spark.createDataFrame([], "code string, event_ts timestamp, price double, volume double").schema
    t = lambda d, h, m=0: dt.datetime(2015, 11, d, h, m)
    lots = [[("A", t(20, 10), 1.0, 1.0), ("A", t(20, 11), 2.0, 1.0), ("A", t(20, 11), 2.0, 1.0), ("A", t(20, 23, 30), 4.0, 1.0)],
            [("A", t(20, 23, 30), 4.0, 1.0), ("A", t(20, 23, 50), 3.0, 1.0), ("B", t(22, 10), 9.0, 1.0)],   # closes day 20
            [("A", t(20, 12), 99.0, 1.0), ("B", t(22, 11), 8.0, 1.0), ("B", t(24, 1), 7.0, 1.0)]]           # late for day 20; closes 22
    for rows in lots:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp_dir}/in")
        Q.start_daily_bars(Q.read_stream(spark, f"{tmp_dir}/in", schema), f"{tmp_dir}/bars", f"{tmp_dir}/ck").awaitTermination(120)
    out = sorted((r.code, r.window_start.day, r.open, r.high, r.low, r.close, r.n_quotes) for r in spark.read.parquet(f"{tmp_dir}/bars").collect())
    assert out == [("A", 20, 1.0, 4.0, 1.0, 3.0, 4), ("B", 22, 9.0, 9.0, 8.0, 8.0, 2)]
