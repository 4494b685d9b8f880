"""Literal bar fixtures for unit tests."""

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from candlewick.operators.windows import with_changes, with_moving_averages
from candlewick.plans.market import market_from_frames
from candlewick.schema import BAR_COLS, INDEX_NAMES

D0 = dt.date(2015, 1, 1)


def day(i: int) -> dt.date:
    return D0 + dt.timedelta(days=i)


def bars_df(spark, series: dict, start: int = 0, volumes: dict | None = None, gaps: dict | None = None):
    """series: code -> list of closes on consecutive days from day(start)
    (gaps: code -> set of day offsets to skip)."""
    rows = []
    for code, closes in series.items():
        skip = (gaps or {}).get(code, set())
        vols = (volumes or {}).get(code)
        for i, c in enumerate(closes):
            if i in skip:
                continue
            v = float(vols[i]) if vols else 100.0
            rows.append((code, day(start + i), float(c), v))
    raw = spark.createDataFrame(rows, "code string, date date, close double, volume double")
    prev = F.lag("close").over(Window.partitionBy("code").orderBy("date"))
    raw = raw.withColumn("_p", F.coalesce(prev, F.col("close")))
    raw = raw.select(
        "code", "date", ((F.col("_p") + F.col("close")) / 2).alias("open"),
        (F.greatest("_p", "close") + 1).alias("high"), "close",
        (F.least("_p", "close") - 1).alias("low"), "volume", F.lit(0.0).alias("turnover"))
    return with_moving_averages(with_changes(raw)).select(*BAR_COLS)


def info_df(spark, codes, st=()):
    return spark.createDataFrame(
        [(c, ("ST " if c in st else "") + f"Name{c}", f"IND{int(c[-1]) % 3}", 1.0, 10.0) for c in codes],
        "code string, name string, industry string, esp double, pe double")


def market(spark, series: dict, start: int = 0, st=(), volumes=None, gaps=None, concept=None):
    bars = bars_df(spark, series, start, volumes, gaps)
    codes = [c for c in series if c not in INDEX_NAMES]
    info = info_df(spark, codes, st)
    if concept is None:
        concept = spark.createDataFrame([(c, f"Name{c}", "C1") for c in codes], "code string, name string, c_name string")
    return market_from_frames(bars, info, concept)
