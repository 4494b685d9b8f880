"""Properties on the driver fixture (sf0.01): no look-ahead, containment."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from candlewick.operators.windows import extremes
from candlewick.plans import groups, screens
from candlewick.plans.market import Market, load_market
from candlewick.schema import BAR_COLS

SF = "/root/testdata/sf0.01"
AS_OF = dt.date(2015, 11, 24)
TS, PS, AS = dt.date(2015, 10, 1), dt.date(2015, 6, 1), dt.date(2015, 10, 20)

SCREENS = {
    "x01": lambda m: screens.box_breakout(m, TS, PS, 0.1, 0.0, AS_OF),
    "x02": lambda m: screens.pull_back(m, TS, PS, 0.1, 0.0, AS_OF),
    "x04": lambda m: screens.ascending(m, AS, AS_OF),
    "x05": lambda m: screens.latest_ascending(m, AS, AS_OF),
    "x06": lambda m: screens.volume_breakout(m, AS_OF),
    "x07": lambda m: screens.trough_breakout(m, TS, PS, 0.1, 0.0, AS_OF),
    "x08": lambda m: screens.volume_trend(m, dt.date(2015, 11, 1), dt.date(2015, 11, 12), 2, 1.0, AS_OF),
    "x09": lambda m: screens.continuous_increase(m, AS_OF, 1),
    "x10": lambda m: screens.above_all_averages(m, AS_OF, 2, 2),
    "x11": lambda m: groups.industry_by_day(m, AS_OF),
    "x13": lambda m: groups.concept_by_day(m, AS_OF),
    "x15": lambda m: screens.interval_return(m, 5, AS_OF),
}


@pytest.fixture(scope="module")
def markets(spark):
    full = load_market(spark, SF)
    cut = Market(bars=full.bars.filter(F.col("date") <= F.lit(AS_OF)), info=full.info, concept=full.concept,
                 calendar=full.calendar.filter(F.col("date") <= F.lit(AS_OF)))
    return full, cut


@pytest.mark.parametrize("key", sorted(SCREENS))
def test_q06_result_unchanged_without_future_bars(markets, key):
    full, cut = markets
    a, b = SCREENS[key](full), SCREENS[key](cut)
    assert a.count() > 0
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_x01_picks_are_peaks_on_the_as_of_day(markets):
    full, _ = markets
    picks = SCREENS["x01"](full).select("code")
    peaks = extremes(full.stocks, TS, AS_OF, "peak").filter(F.col("date") == F.lit(AS_OF)).select("code")
    assert picks.count() > 0 and picks.exceptAll(peaks).count() == 0


def test_screen_rerun_is_deterministic(markets):
    full, _ = markets
    a, b = SCREENS["x11"](full), SCREENS["x11"](full)
    assert a.exceptAll(b).count() == 0


def test_w02_bounded_tail_keeps_the_bar_index_and_pushes_a_date_bound(spark, markets):
    from candlewick.operators import bars as B
    from candlewick.schema import BAR_COLS
    full, _ = markets
    stored = full.numbered.filter(F.col("date") <= F.lit(AS_OF))
    last = B.last_rows(stored)  # the stored per-code state of the MA table
    ext = B.extend_moving_averages(stored, full.bars, full.first_dates(), last=last)
    want = full.numbered.filter(F.col("date") > F.lit(AS_OF))
    cols = ["code", "date", "bar_no", "tail_from", "ma5", "ma250", "v_ma20"]
    assert ext.select(*cols).exceptAll(want.select(*cols)).count() == 0
    assert want.select(*cols).exceptAll(ext.select(*cols)).count() == 0
    ext.write.format("noop").mode("overwrite").save()
    plan = ext._jdf.queryExecution().executedPlan().toString()
    # the history read of the tail carries a lower date bound (not the whole history)
    assert "GreaterThanOrEqual(date," in plan
    assert set(ext.columns) == set(BAR_COLS) | {"bar_no", "tail_from"}


def _same(a, b, cols):
    return a.select(*cols).exceptAll(b.select(*cols)).count() == 0 and b.select(*cols).exceptAll(a.select(*cols)).count() == 0


def _file_times(root):
    import os
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(root) for f in fs if f.endswith(".parquet")}


def test_x20_runs_chain_and_leave_other_months_alone(spark, markets, tmp_dir):
    """Day 2 reads what day 1 left: bars, MA rows, state, calendar and
    listing equal a full rebuild after each; a month that no landed key
    touches keeps its files."""
    import datetime as dt
    from dataclasses import replace
    from candlewick.operators import bars as B
    from candlewick.plans import pipeline
    full, _ = markets
    root = f"{tmp_dir}/book"
    day1 = AS_OF + dt.timedelta(days=7)
    until = lambda day: full.numbered.filter(F.col("date") <= F.lit(day))
    pipeline.create_book(replace(full, numbered=until(AS_OF)), root)
    before = _file_times(f"{root}/bars")
    cols = [*BAR_COLS, "bar_no", "tail_from"]
    steps = [(AS_OF, day1), (day1, dt.date(2015, 12, 31))]
    for after, upto in steps:
        landed = full.bars.filter((F.col("date") > F.lit(after)) & (F.col("date") <= F.lit(upto)))
        months = pipeline.refresh_book(spark, root, landed)
        assert months and min(months) >= "2015-11"
        book = pipeline.open_book(spark, root)
        want = until(upto)
        assert _same(book.numbered, want, cols)
        assert _same(book.ma_state, B.last_rows(want), ["code", "hwm", "hwm_no", "hwm_tail"])
        assert _same(book.calendar, want.filter("code = 'sh'").select("date").distinct(), ["date"])
        assert _same(book.listing, want.groupBy("code").agg(F.min("date").alias("first_date")), ["code", "first_date"])
    now = _file_times(f"{root}/bars")
    old = {f: t for f, t in before.items() if "month=2015-11" not in f}
    assert old and all(now.get(f) == t for f, t in old.items())
    # a correction of one old bar rewrites the months from its day on for that code
    code, when = "600002", dt.date(2015, 9, 3)
    bar = full.bars.filter((F.col("code") == code) & (F.col("date") >= F.lit(when))).orderBy("date").limit(1).withColumn("close", F.col("close") + 1.0)
    pipeline.refresh_book(spark, root, bar)
    fixed = pipeline.open_book(spark, root)
    plain = upsert_all(full.bars.filter(F.col("date") <= F.lit(steps[-1][1])), bar)
    assert _same(fixed.numbered, plain, cols)
    assert pipeline.refresh_book(spark, root, bar.limit(0)) == []


def _book_state(spark, root):
    from candlewick.plans import pipeline
    b = pipeline.open_book(spark, root)
    return {name: sorted(map(tuple, df.collect()), key=repr) for name, df in
            (("bars", b.numbered.select(*BAR_COLS, "bar_no", "tail_from")), ("state", b.ma_state), ("calendar", b.calendar), ("listing", b.listing))}


def test_x20_a_run_that_dies_leaves_the_old_book_and_a_rerun_gives_the_new_one(spark, tmp_dir, monkeypatch):
    """Killed before each of its writes and before the rename: readers see
    the old book whole, a rerun gives what an undisturbed run gives."""
    import datetime as dt
    from dataclasses import replace
    from candlewick.plans import pipeline
    from candlewick.plans.market import load_market
    from candlewick.sources import versions
    m = load_market(spark, "/root/testdata/sf0.001")
    first, last = AS_OF - dt.timedelta(days=3), AS_OF + dt.timedelta(days=7)
    part = replace(m, numbered=m.numbered.filter((F.col("date") <= F.lit(AS_OF)) & (F.col("date") >= "2015-10-01")))
    landed = m.bars.filter((F.col("date") >= F.lit(first)) & (F.col("date") <= F.lit(last))).withColumn("close", F.col("close") + 1.0)
    pipeline.create_book(part, f"{tmp_dir}/plain")
    pipeline.create_book(part, f"{tmp_dir}/book")
    old = _book_state(spark, f"{tmp_dir}/book")
    assert pipeline.refresh_book(spark, f"{tmp_dir}/plain", landed)
    want = _book_state(spark, f"{tmp_dir}/plain")
    assert want != old

    class Killed(Exception):
        pass

    def dies(real, at):
        calls = iter(range(100))

        def step(*args, **kw):
            if next(calls) == at:
                raise Killed
            return real(*args, **kw)
        return step

    for name, at in (("_write_bars", 0), ("_write_bars", 1), ("_write", 0), ("_write", 1), ("_commit", 0)):
        with monkeypatch.context() as patch:
            patch.setattr(pipeline, name, dies(getattr(pipeline, name), at))
            with pytest.raises(Killed):
                pipeline.refresh_book(spark, f"{tmp_dir}/book", landed)
        assert versions.manifest(spark, f"{tmp_dir}/book")["version"] == 1
    assert _book_state(spark, f"{tmp_dir}/book") == old
    pipeline.refresh_book(spark, f"{tmp_dir}/book", landed)
    assert _book_state(spark, f"{tmp_dir}/book") == want
    # what the dead runs left goes, what the kept versions name stays
    left = versions.expire(spark, f"{tmp_dir}/book", keep=2)
    assert len(left) >= 5 and _book_state(spark, f"{tmp_dir}/book") == want
    assert pipeline.open_book(spark, f"{tmp_dir}/book", version=1).bars.count() == len(old["bars"])
    assert versions.expire(spark, f"{tmp_dir}/book", keep=1) and _book_state(spark, f"{tmp_dir}/book") == want


def test_x20_of_two_runs_at_once_one_is_refused(spark, tmp_dir, monkeypatch):
    import datetime as dt
    from dataclasses import replace
    from candlewick.plans import pipeline
    from candlewick.plans.market import load_market
    from candlewick.sources import versions
    m = load_market(spark, "/root/testdata/sf0.001")
    days = [AS_OF + dt.timedelta(days=k) for k in (0, 7, 14)]
    root = f"{tmp_dir}/book"
    pipeline.create_book(replace(m, numbered=m.numbered.filter((F.col("date") <= F.lit(days[0])) & (F.col("date") >= "2015-10-01"))), root)
    one = m.bars.filter((F.col("date") > F.lit(days[0])) & (F.col("date") <= F.lit(days[1])))
    two = m.bars.filter((F.col("date") > F.lit(days[1])) & (F.col("date") <= F.lit(days[2])))
    real = pipeline._commit

    def late(*args, **kw):  # another run commits while this one is about to
        monkeypatch.setattr(pipeline, "_commit", real)
        pipeline.refresh_book(spark, root, two)
        return real(*args, **kw)

    monkeypatch.setattr(pipeline, "_commit", late)
    with pytest.raises(versions.ConcurrentChange):
        pipeline.refresh_book(spark, root, one)
    after = pipeline.open_book(spark, root).bars
    assert after.join(two.select("code", "date"), ["code", "date"]).count() == two.count() and after.join(one.select("code", "date"), ["code", "date"]).count() == 0
    pipeline.refresh_book(spark, root, one)
    assert pipeline.open_book(spark, root).bars.count() == after.count() + one.count()


def upsert_all(bars, bar):
    """Full rebuild after an upsert."""
    from candlewick.operators.bars import upsert
    from candlewick.operators.windows import with_bar_index, with_moving_averages
    from candlewick.schema import BAR_BASE_COLS
    base = upsert(bars.select(*BAR_BASE_COLS), bar.select(*BAR_BASE_COLS))
    return with_bar_index(with_moving_averages(base)).select(*BAR_COLS, "bar_no", "tail_from")


def test_market_of_stored_tables_and_the_newest_day(spark, markets, tmp_dir):
    """Bar tables that are not the fixture: the same screens, by default for
    the newest open day; changed input is read anew."""
    from candlewick.plans.market import load_market
    from candlewick.schema import BAR_BASE_COLS
    full, _ = markets
    upto = full.bars.filter(F.col("date") <= F.lit(AS_OF)).select(*BAR_BASE_COLS)
    upto.write.parquet(f"{tmp_dir}/db/stock_daily")
    full.info.write.parquet(f"{tmp_dir}/db/stock_info")
    full.concept.write.parquet(f"{tmp_dir}/db/stock_concept")
    m = load_market(spark, f"{tmp_dir}/db")
    cut = full.numbered.filter(F.col("date") <= F.lit(AS_OF))
    assert _same(m.numbered, cut, [*BAR_COLS, "bar_no", "tail_from"])
    newest = m.calendar.agg(F.max("date")).first()[0]
    assert _same(screens.ascending(m, "2015-10-20"), screens.ascending(full, "2015-10-20", newest), ["code", "update_date"])
    assert screens.box_breakout(m, "2015-10-01", "2015-06-01", 0.1, 0.0).count() == screens.box_breakout(full, "2015-10-01", "2015-06-01", 0.1, 0.0, newest).count()
    days = m.calendar.count()
    full.bars.filter(F.col("date") <= F.lit("2015-06-30")).select(*BAR_BASE_COLS).write.mode("overwrite").parquet(f"{tmp_dir}/db/stock_daily")
    assert load_market(spark, f"{tmp_dir}/db").calendar.count() < days


def _edge_markets(spark):
    from helpers import market
    one_bar = market(spark, {"600001": [10.0], "sh": [1.0]})
    suspended = market(spark, {"600001": [0.0] * 40, "000002": [10.0, 0.0, 0.0, 12.0] * 10, "sh": [1.0] * 40})
    empty = Market(bars=one_bar.bars.limit(0), info=one_bar.info, concept=one_bar.concept,
                   calendar=one_bar.calendar)
    return {"one_bar": one_bar, "suspended": suspended, "empty_bars": empty}


@pytest.mark.parametrize("key", sorted(SCREENS))
def test_screens_survive_edge_markets(spark, key):
    """One-bar history, suspended bars (close/open 0) and no bars: no ANSI
    error (division by zero, array index), empty or valid results."""
    from helpers import day
    edge_screens = {
        "x01": lambda m: screens.box_breakout(m, day(0), day(0), 0.1, 0.0, day(39)),
        "x02": lambda m: screens.pull_back(m, day(0), day(0), 0.1, 0.0, day(39)),
        "x04": lambda m: screens.ascending(m, day(0), day(39)),
        "x05": lambda m: screens.latest_ascending(m, day(0), day(39)),
        "x06": lambda m: screens.volume_breakout(m, day(39)),
        "x07": lambda m: screens.trough_breakout(m, day(0), day(0), 0.1, 0.0, day(39)),
        "x08": lambda m: screens.volume_trend(m, day(0), day(20), 2, 1.0, day(39)),
        "x09": lambda m: screens.continuous_increase(m, day(39), 1),
        "x10": lambda m: screens.above_all_averages(m, day(39), 2, 2),
        "x11": lambda m: groups.industry_by_day(m, day(39)),
        "x13": lambda m: groups.concept_by_day(m, day(39)),
        "x15": lambda m: screens.interval_return(m, 5, day(39)),
    }
    for name, m in _edge_markets(spark).items():
        edge_screens[key](m).collect()
