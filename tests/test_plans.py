"""Plan shapes behind the scale claims (README "Design for scale")."""

import re

import pytest

from candlewick.plans import registry
from candlewick.sources import fixtures

SF = "/root/testdata/sf0.001"


@pytest.fixture(autouse=True)
def full_metadata(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")  # do not truncate PushedFilters
    yield
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def final_plan(df) -> str:
    df.collect()  # run this DataFrame's own execution: executedPlan is then the final adaptive plan
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return re.sub(r"#\d+L?", "", plan)


def test_lines_are_pre_aggregated_once_before_the_shuffle(spark):
    plan = final_plan(fixtures.bars(spark, SF))
    # partial aggregate (map-side combine) on the integer key under the exchange; the index series reuses the
    # per-code stage, so lineitem is scanned once
    assert re.search(r"HashAggregate\(keys=\[l_suppkey, date\], functions=\[partial_sum", plan)
    assert plan.count("FileScan parquet") == 1 and "Reused" in plan


def test_top_n_lists_limit_rows_before_the_shuffle(spark):
    plan = final_plan(registry.QUERIES["x11_industry_by_day"](spark, SF))
    assert "WindowGroupLimit" in plan and "Partial" in plan


@pytest.mark.parametrize("key", ["x01_box_breakout", "x04_ascending", "x06_volume_breakout", "x09_continuous_increase_1",
                                 "x15_interval_return"])
def test_per_code_screens_need_no_shuffle_on_the_bucketed_market(spark, key):
    plan = final_plan(registry.QUERIES[key](spark, SF))
    assert "Exchange hashpartitioning" not in plan
    assert "Bucketed: true" in plan


@pytest.mark.parametrize("key", ["x09_continuous_increase_1", "x11_industry_by_day", "x03_tick_to_bar"])
def test_date_predicates_reach_the_scan(spark, key):
    plan = final_plan(registry.QUERIES[key](spark, SF))
    assert re.search(r"PushedFilters: \[.*?(GreaterThanOrEqual|LessThanOrEqual|EqualTo)\(date,", plan)


def test_no_query_runs_python(spark):
    for key, fn in registry.QUERIES.items():
        plan = final_plan(fn(spark, SF))
        python = any(n in plan for n in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas",
                                         "FlatMapGroupsInArrow", "MapInPandas"))
        assert not python, key


def test_no_nested_loop_or_cartesian_join_anywhere(spark):
    plans = {key: final_plan(fn(spark, SF)) for key, fn in registry.QUERIES.items()}
    assert [k for k, plan in plans.items() if "NestedLoopJoin" in plan or "CartesianProduct" in plan] == []


def test_bucket_count_follows_the_session_setting(spark, tmp_dir):
    from candlewick.plans.market import load_market
    spark.conf.set("spark.candlewick.buckets", "3")
    try:
        m = load_market(spark, SF, root=f"{tmp_dir}/market")
        plan = final_plan(m.stocks.groupBy("code").count())
        assert "SelectedBucketsCount: 3 out of 3" in plan
        assert "Exchange hashpartitioning" not in plan
    finally:
        spark.conf.unset("spark.candlewick.buckets")
