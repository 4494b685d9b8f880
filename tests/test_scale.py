"""Results that must not depend on the size of the input or on what ran before."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from candlewick import session
from candlewick.operators import bars as B
from candlewick.operators.ranking import global_row_number
from candlewick.plans import market as market_mod
from candlewick.plans import registry
from candlewick.streaming import quotes as Q

from tests.helpers import day, market

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("n", [1000, 200_000])
def test_numbers_are_1_to_n_at_any_size(spark, n):
    df = spark.range(n).select(F.xxhash64("id").alias("k"), "id", F.rand(3).alias("x"), F.lit("a" * 20).alias("pad"))
    out = global_row_number(df, [F.col("k"), F.col("id")], partitions=8)
    r = out.agg(F.countDistinct("rn").alias("d"), F.min("rn").alias("lo"), F.max("rn").alias("hi")).first()
    assert (r.d, r.lo, r.hi) == (n, 1, n)
    grouped = global_row_number(df.withColumn("g", F.col("id") % 3), [F.col("k"), F.col("id")], partitions=8, group="g")
    for r in grouped.groupBy("g").agg(F.countDistinct("rn").alias("d"), F.max("rn").alias("hi"), F.count("*").alias("n")).collect():
        assert r.d == r.hi == r.n


@pytest.mark.parametrize("key", ["x16_excess_return", "x17_hot_industries_with_index", "x18_report_lines", "x20_daily_refresh"])
def test_an_earlier_result_stays_readable_after_the_next_call(spark, key):
    first = registry.QUERIES[key](spark, SF)
    second = registry.QUERIES[key](spark, SF)
    n = second.count()
    assert n > 0 and first.count() == n


def test_upserts_keep_the_newest_copy(spark):
    old, new = ("600001", day(1), 1.0, 1), ("600001", day(1), 0.5, 2)
    cols = "code string, date date, close double, batch int"
    for rows in ([old, new], [new, old]):
        inc = spark.createDataFrame(rows, cols)
        assert B.one_per_key(inc, "batch").first()["close"] == 0.5
        assert B.one_per_key(inc.drop("batch")).first()["close"] == 1.0


def _quote(code, when, price):
    return (code, when, price, price, price, price, 9.0, 100.0)


QUOTE_COLS = "code string, event_ts timestamp, open double, high double, low double, price double, pre_close double, volume double"


def test_only_quotes_of_the_day_become_bars(spark, tmp_dir):
    m = market(spark, {"600001": [float(10 + i) for i in range(40)], "600002": [float(20 + i) for i in range(40)]})
    today = dt.datetime.combine(day(40), dt.time(10))
    run = Q.quote_sink(tmp_dir, m.stocks)
    run(spark.createDataFrame([_quote("600001", today, 51.0), _quote("600002", today - dt.timedelta(days=1), 61.0)], QUOTE_COLS), 0)
    assert [r.code for r in Q.read_newest(spark, f"{tmp_dir}/provisional").collect()] == ["600001"]
    # the next batch changes a price; the newest snapshot and bar have it
    run(spark.createDataFrame([_quote("600001", today + dt.timedelta(minutes=1), 52.0)], QUOTE_COLS), 1)
    assert [r.close for r in Q.read_newest(spark, f"{tmp_dir}/provisional").collect()] == [52.0]
    latest = {r.code: r.price for r in Q.read_newest(spark, f"{tmp_dir}/latest").collect()}
    assert latest == {"600001": 52.0, "600002": 61.0}
    # the day moves on with the quotes
    run(spark.createDataFrame([_quote("600002", today + dt.timedelta(days=1), 63.0)], QUOTE_COLS), 2)
    assert [(r.code, r.date) for r in Q.read_newest(spark, f"{tmp_dir}/provisional").collect()] == [("600002", day(41))]


def test_an_unreadable_snapshot_fails_the_batch(spark, tmp_dir):
    quote = [_quote("600001", dt.datetime.combine(day(40), dt.time(10)), 51.0)]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        Q.quote_sink(tmp_dir)(spark.createDataFrame(quote, QUOTE_COLS), 5)


def test_equal_times_have_an_order(spark):
    t = dt.datetime(2015, 1, 5, 10)
    rows = [("a", t, 2.0, 1.0), ("a", t, 1.0, 1.0), ("a", t, 3.0, 1.0)]
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "code string, event_ts timestamp, price double, volume double")
        bar = Q.daily_bars(df, watermark=None).first()
        assert (bar.open, bar.close) == (1.0, 3.0)
        assert Q.latest(df).first().price == 3.0


def test_paths_go_through_the_file_system_of_the_session(spark, tmp_dir):
    spark.range(3).write.parquet(f"{tmp_dir}/t.parquet")
    assert session.path_exists(spark, f"{tmp_dir}/t.parquet") and session.path_exists(spark, f"file://{tmp_dir}/t.parquet")
    assert not session.path_exists(spark, f"{tmp_dir}/none")
    before = session.path_state(spark, f"{tmp_dir}/t.parquet")
    spark.range(30_000).write.mode("overwrite").parquet(f"{tmp_dir}/t.parquet")
    assert before != session.path_state(spark, f"{tmp_dir}/t.parquet") and session.path_state(spark, f"{tmp_dir}/none") == ""


def test_changed_input_is_another_market(spark, tmp_dir):
    assert market_mod._fingerprint(spark, tmp_dir) == market_mod._fingerprint(spark, tmp_dir)
    before = market_mod._fingerprint(spark, tmp_dir)
    spark.range(5).write.parquet(f"{tmp_dir}/lineitem.parquet")
    assert before != market_mod._fingerprint(spark, tmp_dir)
