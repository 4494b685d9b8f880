"""Peaks and troughs kept from run to run (W03-W06 for X04 and X07).

Whether a bar is an extreme depends on the ten bars before and after it, so a
new day can only change the end of a series. A versioned folder holds
``settled`` (the extremes behind which enough bars have come; each is written
once) and ``tail`` (the last ``TAIL`` bars of each code; ``open``: not settled
yet). A run reads the tail and the bars behind a code's newest day, settles
what has become old enough and writes the tail anew; the history of bars is
not read. Changed bars among the last ``SLACK`` are replaced in the tail; a
code with an older change is computed again from its first bar, and only then
are settled rows rewritten. One rename makes the run visible.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from candlewick.operators.windows import by_code
from candlewick.schema import PEAK_LEFT, PEAK_RIGHT
from candlewick.sources import versions

#: A bar is settled with so many bars behind it, so that changes of the last SLACK bars reach no settled one.
SLACK = 10
OPEN = PEAK_RIGHT + SLACK
TAIL = PEAK_LEFT + OPEN
SCHEMAS = {"settled": "code string, kind string, date date, close double", "tail": "code string, date date, close double, open boolean"}


def _read(spark: SparkSession, root: str, content: dict, table: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[table]).parquet(*[f"{root}/{f}" for f in content["tables"][table]])


def _write(df: DataFrame, root: str, table: str, run: str) -> str:
    df.write.parquet(f"{root}/{table}/{run}")
    return f"{table}/{run}"


def _kinds(rows: DataFrame) -> DataFrame:
    """Adds ``kinds`` (peak, trough or both) and ``behind``, the number of bars after this one."""
    w = by_code().rowsBetween(-PEAK_LEFT, PEAK_RIGHT)
    kinds = F.array_compact(F.array(
        F.when(F.col("close") == F.max("close").over(w), F.lit("peak")),
        F.when(F.col("close") == F.min("close").over(w), F.lit("trough"))))
    behind = F.row_number().over(Window.partitionBy("code").orderBy(F.col("date").desc())) - 1
    return rows.withColumns({"kinds": kinds, "behind": behind})


def _extremes(rows: DataFrame) -> DataFrame:
    return rows.select("code", F.explode("kinds").alias("kind"), "date", "close")


def _steps(codes: DataFrame, tail: DataFrame, landed: DataFrame | None, since) -> DataFrame:
    """(code, from_day, again) of the codes of a run: the day from which their bars are read, and whether the code is
    computed again from its first bar."""
    opened = F.array_sort(F.collect_list(F.when(F.col("open"), F.col("date"))))  # at most OPEN days
    ends = tail.groupBy("code").agg(F.max("date").alias("newest"), F.bool_and("open").alias("whole"), opened.alias("days"))
    # the PEAK_RIGHT bars before a change must be open, or the series has no settled bar
    ends = ends.select("code", "newest", F.when(F.col("whole"), F.lit(since).cast("date")).otherwise(F.get("days", F.lit(PEAK_RIGHT))).alias("free"))
    steps = codes.join(ends, "code", "left")
    if landed is None:
        steps = steps.withColumn("changed", F.lit(None).cast("date"))
    else:
        steps = steps.join(landed.groupBy("code").agg(F.min("date").alias("changed")), "code", "left")
    behind = F.date_add("newest", 1)
    old = F.coalesce(F.col("changed") < behind, F.lit(False)) & ~F.coalesce(F.col("changed") >= F.col("free"), F.lit(False))
    again = F.col("newest").isNull() | old
    return steps.select("code", F.when(again, F.lit(since).cast("date")).otherwise(F.least("changed", behind)).alias("from_day"), old.alias("again"))


def refresh(spark: SparkSession, root: str, bars: DataFrame, since, landed: DataFrame | None = None) -> int:
    """One run over the bars from ``since`` on (the same day in every run); returns the new version. ``landed``: the keys
    (code, date) that were added, changed or deleted; without them only bars behind a code's newest day are new."""
    content, run = versions.manifest(spark, root), uuid.uuid4().hex
    bars = bars.filter(F.col("date") >= F.lit(since)).select("code", "date", F.col("close").cast("double").alias("close"))
    tables = {"settled": []} if content is None else {"settled": list(content["tables"]["settled"])}
    if content is None:
        rows = bars.withColumn("open", F.lit(True))
    else:
        tail = _read(spark, root, content, "tail")
        codes = (bars if landed is None else landed).select("code").distinct()
        steps = _steps(codes, tail, landed, since)
        steps = spark.read.schema("code string, from_day date, again boolean").parquet(f"{root}/{_write(steps, root, 'steps', run)}")
        asked = steps.agg(F.min("from_day").alias("low"), F.count_if("again").alias("again")).first()
        if asked["again"]:
            stays = _read(spark, root, content, "settled").join(steps.filter("again"), "code", "left_anti")
            tables["settled"] = [_write(stays, root, "settled", f"{run}-kept")]
        kept = tail.join(steps, "code", "left").filter("from_day IS NULL OR date < from_day").select("code", "date", "close", "open")
        new = bars.filter(F.col("date") >= F.lit(asked["low"])).join(steps, "code").filter("date >= from_day")  # the bound reaches the scan
        rows = kept.unionByName(new.select("code", "date", "close", F.lit(True).alias("open")))
    rows = _kinds(rows)
    tables["settled"].append(_write(_extremes(rows.filter(F.col("open") & (F.col("behind") >= OPEN))), root, "settled", f"{run}-new"))
    last = rows.filter(F.col("behind") < TAIL).select("code", "date", "close", (F.col("open") & (F.col("behind") < OPEN)).alias("open"))
    tables["tail"] = [_write(last, root, "tail", run)]
    return versions.commit(spark, root, {"tables": tables}, 0 if content is None else content["version"])


def read_extremes(spark: SparkSession, root: str) -> DataFrame:
    """code, kind, date, close, rank, date_rank (``operators.windows.peaks_and_troughs``) up to each code's newest bar."""
    content = versions.manifest(spark, root)
    if content is None:
        raise FileNotFoundError(f"no extremes at {root}")
    still_open = _extremes(_kinds(_read(spark, root, content, "tail")).filter("open"))
    both = _read(spark, root, content, "settled").unionByName(still_open)
    by_kind = Window.partitionBy("code", "kind")
    return both.withColumns({
        "rank": F.row_number().over(by_kind.orderBy(F.col("close").desc(), F.col("date").desc())).cast("bigint"),
        "date_rank": F.row_number().over(by_kind.orderBy(F.col("date").desc())).cast("bigint"),
    })
