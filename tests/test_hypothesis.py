"""Randomised properties (hypothesis; few examples, each runs Spark jobs)."""

from decimal import ROUND_HALF_UP, Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from candlewick.functions import columns as C
from candlewick.operators import bars as B
from candlewick.operators.windows import extremes
from candlewick.plans import groups

from helpers import bars_df, day, market

SETTINGS = dict(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))


@settings(**SETTINGS)
@given(st.lists(st.integers(-10**8, 10**8), min_size=1, max_size=200))
def test_round_fixed_equals_decimal_half_up(spark, units):
    vals = [u / 10000 for u in units]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = [r[0] for r in df.select(C.round_fixed("x")).collect()]
    want = [float(Decimal(u).scaleb(-4).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)) for u in units]
    assert got == want


@settings(**SETTINGS)
@given(st.lists(st.integers(-10**12, 10**12), min_size=1, max_size=200))
def test_rounding_of_eight_decimals_is_exact(spark, units):
    """A change that a live bar holds unrounded: no cut to fewer places before the rounding."""
    df = spark.createDataFrame([(u / 10**8,) for u in units] + [(1.234996,)], "x double")
    half_up = lambda v: float(v.quantize(Decimal("0.01"), rounding=ROUND_HALF_UP))
    want = [half_up(Decimal(repr(u / 10**8))) for u in units] + [1.23]
    assert [r[0] for r in df.select(C.round_fixed("x")).collect()] == want
    exact = [Decimal(repr(u / 10**8)) for u in units] + [Decimal("1.234996")]
    assert df.agg(C.avg_round_fixed("x")).first()[0] == half_up(sum(exact) / len(exact))


@settings(**SETTINGS)
@given(st.lists(st.integers(-500000, 500000), min_size=1, max_size=60))
def test_avg_round_fixed_equals_exact_decimal_average(spark, units):
    df = spark.createDataFrame([(u / 10000,) for u in units], "x double")
    got = df.agg(C.avg_round_fixed("x")).first()[0]
    exact = (Decimal(sum(units)) / Decimal(len(units))).scaleb(-4)
    assert got == float(exact.quantize(Decimal("0.01"), rounding=ROUND_HALF_UP))


@settings(**SETTINGS)
@given(st.lists(st.integers(20, 400), min_size=30, max_size=120), st.integers(5, 25),
       st.sets(st.integers(0, 29), max_size=5))
def test_incremental_ma_equals_full(spark, closes, split, gaps):
    full = bars_df(spark, {"600001": closes}, gaps={"600001": gaps})
    stored = full.filter(F.col("date") <= day(split))
    inc = B.extend_moving_averages(stored, full).select("date", "ma5", "ma30", "ma250", "v_ma10")
    want = full.filter(F.col("date") > day(split)).select("date", "ma5", "ma30", "ma250", "v_ma10")
    assert sorted(inc.collect()) == sorted(want.collect())


@settings(**SETTINGS)
@given(st.lists(st.integers(1, 50), min_size=5, max_size=80))
def test_peaks_of_negated_close_are_troughs(spark, closes):
    b = bars_df(spark, {"600001": closes})
    lows = extremes(b, None, None, "trough").select("date", "rank")
    peaks = extremes(b.withColumn("close", -F.col("close")), None, None, "peak").select("date")
    assert sorted(r.date for r in lows.collect()) == sorted(r.date for r in peaks.collect())


@settings(**SETTINGS)
@given(st.lists(st.lists(st.integers(90, 110), min_size=6, max_size=6), min_size=2, max_size=8))
def test_industry_stats_match_pandas(spark, series):
    s = {f"60000{i}": [float(c) for c in cl] for i, cl in enumerate(series)}
    s["sh"] = [1.0] * 6
    m = market(spark, s)
    got = groups.industry_by_day(m, day(5), top_n=2, n_days=4, ignore_n_days=6).toPandas()
    bars = m.stocks.join(m.info, "code").select("code", "date", "p_change", "industry").toPandas()
    bars = bars[(bars.date >= day(2)) & (bars.date <= day(5))]
    for (d, ind), g in bars.groupby(["date", "industry"]):
        row = got[(got.date == d) & (got.industry == ind)].iloc[0]
        vals = g.p_change.dropna()
        if len(vals):
            exact = Decimal(int(round((vals * 10000).round().sum()))) / Decimal(len(vals))
            want = float(exact.scaleb(-4).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP))
            assert row.p_change == want
        top = g.sort_values(["p_change", "code"], ascending=[False, True], na_position="last").head(2)
        assert list(row.top_n_change) == [x for x in top.p_change]
        pos, neg = (vals > 0).sum(), (vals <= 0).sum()
        if pos + neg:
            ratio = Decimal(int(pos)) / Decimal(int(pos + neg))
            assert row.positive_stock_ratio == float(ratio.quantize(Decimal("0.01"), rounding=ROUND_HALF_UP))


@settings(**SETTINGS)
@given(st.lists(st.integers(20, 400), min_size=30, max_size=300), st.integers(5, 280),
       st.sets(st.integers(0, 299), max_size=40))
def test_indexed_incremental_ma_equals_full(spark, closes, split, gaps):
    from candlewick.operators.windows import with_bar_index
    full = with_bar_index(bars_df(spark, {"600001": closes, "000002": closes[::-1]}, gaps={"600001": gaps}))
    first = full.groupBy("code").agg(F.min("date").alias("first_date"))
    stored = full.filter(F.col("date") <= day(split))
    cols = ["code", "date", "bar_no", "tail_from", "ma5", "ma250", "v_ma10"]
    inc = B.extend_moving_averages(stored, full.drop("bar_no", "tail_from"), first,
                                   last=B.last_rows(stored)).select(*cols)
    want = full.filter(F.col("date") > day(split)).select(*cols)
    assert sorted(inc.collect()) == sorted(want.collect())
