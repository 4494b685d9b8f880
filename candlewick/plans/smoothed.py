"""Stored recurrences: the states of RSI and MACD kept from run to run.

A versioned folder holds ``states`` (a row per bar: the state after it) and
``last`` (a row per code: its newest day and the state after it). A run folds
the bars behind a code's newest day from its ``last`` row, one step a day, and
adds a folder of rows; the history of bars is not read. Bars landed on or
before a code's newest day are corrections: the code goes back to the state
before the first of them, and needs its bars from there on. One rename makes
the run visible (``sources.versions``).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.operators.indicators import indicator_states, indicators_of, last_states
from candlewick.sources import versions


def _write(df: DataFrame, root: str, table: str, run: str) -> str:
    df.write.parquet(f"{root}/{table}/{run}")
    return f"{table}/{run}"


def _read(spark: SparkSession, root: str, content: dict, table: str) -> DataFrame:
    folders = [f"{root}/{f}" for f in content["tables"][table]]
    return spark.read.schema(content["schemas"][table]).parquet(*folders)


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields)


def refresh(spark: SparkSession, root: str, bars: DataFrame, landed: DataFrame | None = None) -> int:
    """One run; returns the new version. ``bars``: code, date, close of all
    stored bars (only what a run needs is read). ``landed``: the keys (code,
    date) that the run has changed; without them only bars behind a code's
    newest day are new. The first run folds everything."""
    content, run = versions.manifest(spark, root), uuid.uuid4().hex
    bars = bars.select("code", "date", "close")
    if content is None:
        states = indicator_states(bars)
        folder = _write(states, root, "states", run)
        last = last_states(spark.read.schema(states.schema).parquet(f"{root}/{folder}"))
        tables = {"states": [folder], "last": [_write(last, root, "last", run)]}
        return versions.commit(spark, root, {"tables": tables, "schemas": {"states": _ddl(states), "last": _ddl(last)}}, 0)

    stored, last = _read(spark, root, content, "states"), _read(spark, root, content, "last")
    names, tables = last.columns, {k: list(v) for k, v in content["tables"].items()}
    if landed is not None:
        first = landed.groupBy("code").agg(F.min("date").alias("first_changed"))
        back = first.join(last.select("code", F.col("date").alias("newest")), "code").filter("first_changed <= newest").select("code", "first_changed")
        folder = _write(back, root, "back", run)
        back = spark.read.schema(back.schema).parquet(f"{root}/{folder}")
        if not back.isEmpty():  # the rows that stay are written anew; others are never touched
            stays = stored.join(back, "code", "left").filter("first_changed IS NULL OR date < first_changed").drop("first_changed")
            tables["states"] = [_write(stays, root, "states", f"{run}-kept")]
            kept = spark.read.schema(content["schemas"]["states"]).parquet(f"{root}/{tables['states'][0]}")
            again = last_states(kept.join(back, "code", "left_semi")).select(*names)
            last = last.join(back, "code", "left_anti").select(*names).unionByName(again)
    # codes without a state (new ones, or corrected from their first day) take all their bars, others those behind their newest day
    ends = last.select("code", F.col("date").alias("newest"))
    codes = (bars if landed is None else landed).select("code").distinct()
    asked = codes.join(ends, "code", "left").agg(F.count_if(F.col("newest").isNull()).alias("unknown"), F.min("newest").alias("since")).first()
    if landed is not None:
        bars = bars.join(codes, "code", "left_semi")
    if asked["since"] is not None and not asked["unknown"]:
        bars = bars.filter(F.col("date") > F.lit(asked["since"]))  # reaches the scan
    new = bars.join(ends, "code", "left").filter("newest IS NULL OR date > newest").drop("newest")
    folder = _write(indicator_states(new, last), root, "states", f"{run}-new")
    tables["states"].append(folder)
    added = spark.read.schema(content["schemas"]["states"]).parquet(f"{root}/{folder}")
    newest = last_states(added).select(*names)
    tables["last"] = [_write(last.join(newest, "code", "left_anti").select(*names).unionByName(newest), root, "last", run)]
    return versions.commit(spark, root, {"tables": tables, "schemas": content["schemas"]}, content["version"])


def read_indicators(spark: SparkSession, root: str) -> DataFrame:
    """RSI and MACD of every stored bar, as the last run left them."""
    content = versions.manifest(spark, root)
    if content is None:
        raise FileNotFoundError(f"no indicators at {root}")
    return indicators_of(_read(spark, root, content, "states"))
