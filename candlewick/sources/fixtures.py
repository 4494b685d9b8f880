"""Model tables derived from the driver's TPC-H-style parquet tables.

Bars: one row per (supplier, shipping week) of ``lineitem``; consecutive
weeks become consecutive days from 2015-01-01, and a running sum of a
per-line integer step drives the close. Index code ``sh`` (the trading
calendar) aggregates all lines of a day. All steps are integer-exact up to
``close``, so any engine produces the same bars.

Scale notes: lineitem is aggregated with a map-side partial aggregate
before any shuffle (a supplier holding a third of all lines costs one
partial-agg buffer per task, not a hot reducer); the index series is
aggregated from the per-code partials, not from a second scan. Windows then
run over at most one row per (code, day).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from candlewick.operators.windows import INDEX_COLS, by_code, with_bar_index, with_moving_averages
from candlewick.schema import BAR_COLS, CALENDAR_CODE

# Fixed values of the fixture rule.
BAR_EPOCH = "2015-01-01"
SHIP_EPOCH = "1995-01-01"
START_CLOSE = 300
FLOOR_CLOSE = 20
ST_MODULUS = 17
ST_REMAINDER = 3
CONCEPT_QUANTITY = 50.0


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def code_of(suppkey: Column) -> Column:
    """`6` + 5-digit key when even, `0` + key when odd (longer keys are kept
    whole, never truncated). Built-in string functions only: they compile
    into the generated code, unlike a per-row format string."""
    digits = suppkey.cast("string")
    padded = F.when(F.length(digits) < 5, F.lpad(digits, 5, "0")).otherwise(digits)
    return F.concat(F.when(suppkey % 2 == 0, F.lit("6")).otherwise(F.lit("0")), padded)


def line_steps(lineitem: DataFrame) -> DataFrame:
    """Step a, per line: supplier key, day, step, line number, quantity."""
    days = F.datediff(F.to_date("l_shipdate"), F.lit(SHIP_EPOCH).cast("date"))
    return lineitem.select(
        F.col("l_suppkey"),
        F.date_add(F.lit(BAR_EPOCH).cast("date"), F.floor(days / 7).cast("int")).alias("date"),
        (F.round(100 * F.col("l_discount")).cast("int") - F.round(100 * F.col("l_tax")).cast("int") - 1).alias("step"),
        F.col("l_linenumber"),
        F.col("l_quantity"),
    )


def raw_bars(lineitem: DataFrame) -> DataFrame:
    """Step a: (code, date, step, ln, volume) for stocks plus the `sh` index.

    Lines are aggregated on the integer supplier key (cheap hash and shuffle
    key); the text code is formatted once per aggregated row."""
    per_code = line_steps(lineitem).groupBy("l_suppkey", "date").agg(
        F.sum("step").alias("step"),
        F.max("l_linenumber").alias("ln"),
        F.sum("l_quantity").alias("volume"),
    ).select(code_of(F.col("l_suppkey")).alias("code"), "date", "step", "ln", "volume")
    index = per_code.groupBy("date").agg(
        (F.sum("step") % 7).alias("step"),
        F.max("ln").alias("ln"),
        F.sum("volume").alias("volume"),
    ).select(F.lit(CALENDAR_CODE).alias("code"), "date", "step", "ln", "volume")
    return per_code.unionByName(index)


def bars_from_steps(raw: DataFrame) -> DataFrame:
    """Step b: close from the running step sum, OHLC, changes and all MAs."""
    w = by_code()
    running = F.sum("step").over(w.rowsBetween(Window.unboundedPreceding, 0))
    df = raw.withColumn("close", F.greatest(F.lit(START_CLOSE) + running, F.lit(FLOOR_CLOSE)).cast("double"))
    df = df.withColumn("_prev", F.coalesce(F.lag("close").over(w), F.lit(float(START_CLOSE))))
    lnm = F.col("ln") % 3
    df = df.select(
        "code", "date",
        ((F.col("_prev") + F.col("close")) / 2).alias("open"),
        (F.greatest("_prev", "close") + lnm).alias("high"),
        "close",
        (F.least("_prev", "close") - lnm).alias("low"),
        F.col("volume").cast("double").alias("volume"),
        (F.col("close") - F.col("_prev")).alias("price_change"),
        F.round(100 * (F.col("close") - F.col("_prev")) / F.col("_prev"), 4).alias("p_change"),
        F.lit(0.0).alias("turnover"),
    )
    return with_bar_index(with_moving_averages(df)).select(*BAR_COLS, *INDEX_COLS)


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """stock_daily + stock_daily_more columns (key code, date) and the bar
    index columns (bar_no, tail_from)."""
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_suppkey", "l_shipdate", "l_discount", "l_tax", "l_linenumber", "l_quantity")
    return bars_from_steps(raw_bars(li))


def info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """stock_info: supplier x nation (nation is a fixed 25-row dimension)."""
    sup = read_table(spark, sf_dir, "supplier")
    nat = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    st = F.when(F.col("s_suppkey") % ST_MODULUS == ST_REMAINDER, F.lit("ST ")).otherwise(F.lit(""))
    return sup.join(F.broadcast(nat), sup.s_nationkey == nat.n_nationkey).select(
        code_of(F.col("s_suppkey")).alias("code"),
        F.concat(st, F.col("s_name")).alias("name"),
        F.col("n_name").alias("industry"),
        (F.col("s_acctbal") / 1000).alias("esp"),
        (F.col("s_acctbal") / 100).alias("pe"),
    )


def concept(spark: SparkSession, sf_dir: str, info_df: DataFrame | None = None) -> DataFrame:
    """stock_concept: distinct (code, brand) of lines with quantity 50.

    The filter is pushed into the lineitem scan; the distinct is aggregated
    map-side before the join with part, so the join sees one row per
    (supplier, part) instead of one per line.
    """
    li = read_table(spark, sf_dir, "lineitem").select("l_suppkey", "l_partkey", "l_quantity")
    pairs = li.filter(F.col("l_quantity") == CONCEPT_QUANTITY).select("l_suppkey", "l_partkey").distinct()
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    tags = (
        pairs.join(part, pairs.l_partkey == part.p_partkey)
        .select(code_of(F.col("l_suppkey")).alias("code"), F.col("p_brand").alias("c_name"))
        .distinct()
    )
    names = (info_df if info_df is not None else info(spark, sf_dir)).select("code", "name")
    return tags.join(names, "code", "left").select("code", "name", "c_name")
