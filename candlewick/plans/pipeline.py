"""The daily refresh of the stored tables (the book).

The reference deletes the newest stored day, reloads, deletes the newest MA
day and extends the MA table. Here (Q10): landed bars are upserted on
(code, date) - a final bar replaces a provisional one, a provisional bar
never replaces a final one - and the MA rows of a code are computed anew
from its first changed day on with its last 249 bars (Q21).

A book is a versioned folder (``sources.versions``) of tables: ``bars``
(daily and MA columns, bar index; by run and month), ``state`` (per-code
state of the MA table), ``calendar``, ``listing``, ``info`` and ``concept``.
A manifest names, for every month, the folders that hold its bars, and the
folder of every other table. A run writes the new rows of the months that its
keys touch and the rows that stay there, each once, under its own name, and
only the small tables that change; then one rename makes all of it the next
version (K05/K06: bars and averages are never seen apart). A run that dies
before has changed nothing; repeated with the same landed rows it gives the
same book. Readers keep the version that they have opened.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.operators.bars import KEY, advance_last, extend_moving_averages, last_rows, merge_provisional, upsert
from candlewick.operators.windows import INDEX_COLS
from candlewick.plans.market import Market, calendar_of
from candlewick.schema import BAR_BASE_COLS, BAR_COLS
from candlewick.session import hadoop_path, remove
from candlewick.sources import versions

TABLES = ("bars", "state", "calendar", "listing", "info", "concept")


def refresh_bars(stored: DataFrame, landed: DataFrame | None, provisional: DataFrame | None = None) -> DataFrame:
    """stock_daily after the run: landed (final) rows upserted, then
    provisional rows where no final bar exists."""
    out = stored.select(*BAR_BASE_COLS)
    if landed is not None:
        out = upsert(out, landed.select(*BAR_BASE_COLS), BAR_BASE_COLS)
    if provisional is not None:
        out = merge_provisional(out, provisional.select(*BAR_BASE_COLS), BAR_BASE_COLS)
    return out


def changed_keys(landed: DataFrame | None, provisional: DataFrame | None = None) -> DataFrame:
    """(code, date) keys a run may have changed: those it wrote. Reading
    only the (small) landed rows avoids diffing the whole history."""
    keys = [df.select(*KEY) for df in (landed, provisional) if df is not None]
    return (keys[0] if len(keys) == 1 else keys[0].unionByName(keys[1])).distinct()


def _kept(stored_ma: DataFrame, first: DataFrame) -> DataFrame:
    """MA rows before each changed code's first changed day."""
    return (
        stored_ma.join(first, "code", "left")
        .filter(F.col("first_changed").isNull() | (F.col("date") < F.col("first_changed")))
        .drop("first_changed")
    )


def _probe(changed: DataFrame, last: DataFrame) -> tuple[DataFrame, object, bool]:
    """(first changed day per code, the first of all, whether any change is a correction): one small job."""
    first = changed.groupBy("code").agg(F.min("date").alias("first_changed"))
    r = first.join(last, "code", "left").agg(
        F.min("first_changed").alias("since"), F.count_if(F.col("first_changed") <= F.col("hwm")).alias("n_corrected")).first()
    return first, r["since"], bool(r["n_corrected"])


def _state_kept(keep: DataFrame, first: DataFrame, last: DataFrame, corrected: bool) -> DataFrame:
    """The state of the rows that stay: a corrected code takes the newest of its kept rows, read only when there are any."""
    with_first = last.join(first, "code", "left")
    kept = with_first.filter(F.col("first_changed").isNull() | (F.col("first_changed") > F.col("hwm"))).drop("first_changed")
    if corrected:
        codes = with_first.filter(F.col("first_changed") <= F.col("hwm")).select("code")
        kept = kept.unionByName(last_rows(keep.join(codes, "code", "left_semi")))
    return kept


def refresh_with_state(stored_ma: DataFrame, bars_after: DataFrame, changed: DataFrame, last: DataFrame,
                       first_dates: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(kept MA rows, new MA rows, state of the kept rows) for an indexed MA
    table with its stored per-code state ``last`` (see
    ``operators.bars.last_rows``); ``advance_last`` gives the state after the
    run from the latter two.

    A code whose first changed day lies after its newest stored row (the
    daily append) keeps its state; a corrected code (a change on or before
    its newest row) takes the newest of its kept rows - read only when
    corrections exist. No other read of the history is needed for the
    newest rows, and the tail read is bounded by the stored tail starts.

    Precondition (kept by ``refresh_book``): before the run the MA table
    covers every stored bar, so all new MA rows lie on or after the first
    changed day. For an MA table that lags its bars use
    ``extend_moving_averages`` without ``since``.
    """
    first, since, corrected = _probe(changed, last)
    keep = _kept(stored_ma, first)
    kept_last = _state_kept(keep, first, last, corrected)
    new = extend_moving_averages(keep, bars_after, first_dates, since=since, last=kept_last,
                                 first_new=first.withColumnRenamed("first_changed", "first_new"))
    return keep, new, kept_last


# ------------------------------------------------------------------ the book
def _months(bars: DataFrame) -> DataFrame:
    return bars.withColumn("month", F.date_format("date", "yyyy-MM"))


def _write_bars(bars: DataFrame, root: str, run: str) -> None:
    """Bars by month, sorted by day; a month is as many files as its size asks for."""
    (_months(bars.select(*BAR_COLS, *INDEX_COLS)).hint("rebalance", "month").sortWithinPartitions("month", "date", "code")
     .write.partitionBy("month").parquet(f"{root}/bars/run={run}"))


def _write(df: DataFrame, root: str, table: str, run: str) -> str:
    df.write.parquet(f"{root}/{table}/{run}")
    return f"{table}/{run}"


def _written_months(spark: SparkSession, root: str, run: str) -> dict[str, str]:
    """month -> folder of the bars that a run has written."""
    fs, p = hadoop_path(spark, f"{root}/bars/run={run}")
    names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
    return {n.removeprefix("month="): f"bars/run={run}/{n}" for n in names if n.startswith("month=")}


def _read_bars(spark: SparkSession, root: str, folders: list[str], schema: T.StructType) -> DataFrame:
    full = T.StructType([*schema.fields, T.StructField("run", T.StringType()), T.StructField("month", T.StringType())])
    if not folders:
        return spark.createDataFrame([], full)
    return spark.read.schema(full).option("basePath", f"{root}/bars").parquet(*[f"{root}/{f}" for f in folders])


def _tables(content: dict) -> dict[str, list[str]]:
    """Folders by table: those of the bars are listed by month."""
    return {name: files if name != "bars" else [f for m in sorted(files) for f in files[m]] for name, files in content["book"].items()}


def _commit(spark: SparkSession, root: str, book: dict, schemas: dict, after: int) -> int:
    content = {"book": book, "schemas": schemas}
    return versions.commit(spark, root, content | {"tables": _tables(content)}, after)


def create_book(m: Market, root: str) -> None:
    """Store a market as the first version of a book (later runs refresh it)."""
    spark, run = m.bars.sparkSession, uuid.uuid4().hex
    _write_bars(m.numbered, root, run)
    months = _written_months(spark, root, run)
    schema = m.numbered.select(*BAR_COLS, *INDEX_COLS).schema
    stored = _read_bars(spark, root, list(months.values()), schema)
    small = {"state": last_rows(stored), "calendar": calendar_of(stored), "info": m.info, "concept": m.concept,
             "listing": stored.groupBy("code").agg(F.min("date").alias("first_date"))}
    book = {"bars": {k: [f] for k, f in months.items()}} | {name: [_write(df, root, name, run)] for name, df in small.items()}
    _commit(spark, root, book, {"bars": schema.json()} | {name: df.schema.json() for name, df in small.items()}, after=0)


def book_exists(spark: SparkSession, root: str) -> bool:
    return versions.manifest(spark, root) is not None


def _frames(spark: SparkSession, root: str, content: dict) -> dict[str, DataFrame]:
    schemas = {name: T.StructType.fromJson(json.loads(text)) for name, text in content["schemas"].items()}
    found = _tables(content)
    frames = {name: spark.read.schema(schemas[name]).parquet(*[f"{root}/{f}" for f in found[name]]) for name in TABLES if name != "bars"}
    return frames | {"bars": _read_bars(spark, root, found["bars"], schemas["bars"])}


def open_book(spark: SparkSession, root: str, version: int | None = None) -> Market:
    """The market that the last run left (or a version that is kept). The month of a
    day is a partition column: screens that bound the date skip other files by their date range."""
    content = versions.manifest(spark, root, version)
    if content is None:
        raise FileNotFoundError(f"no book at {root}")
    t = _frames(spark, root, content)
    numbered = t["bars"].select(*BAR_COLS, *INDEX_COLS)
    return Market(bars=numbered.select(*BAR_COLS), info=t["info"], concept=t["concept"], calendar=t["calendar"],
                  listing=t["listing"], numbered=numbered, ma_state=t["state"])


def refresh_book(spark: SparkSession, root: str, landed: DataFrame | None, provisional: DataFrame | None = None) -> list[str]:
    """One run of X20 on the book at ``root``; returns the months it rewrote.
    ``versions.ConcurrentChange`` says that another run was first: run again."""
    content = versions.manifest(spark, root)
    t = _frames(spark, root, content)
    numbered = t["bars"].select(*BAR_COLS, *INDEX_COLS)
    run = uuid.uuid4().hex
    changed = changed_keys(landed, provisional)
    changed.write.parquet(f"{root}/changed/{run}")
    changed = spark.read.schema(changed.schema).parquet(f"{root}/changed/{run}")
    if changed.isEmpty():
        remove(spark, f"{root}/changed/{run}")
        return []
    after = refresh_bars(numbered.select(*BAR_BASE_COLS), landed, provisional)
    _, new, kept_state = refresh_with_state(numbered, after, changed, t["state"], t["listing"])
    _write_bars(new, root, f"{run}-new")
    written = _written_months(spark, root, f"{run}-new")
    new = _read_bars(spark, root, list(written.values()), numbered.schema).select(*numbered.columns)

    # the rows that stay in the months that have new ones; other months keep their folders
    first = changed.groupBy("code").agg(F.min("date").alias("first_changed"))
    months, book = sorted(written), {name: list(files) if name != "bars" else dict(files) for name, files in content["book"].items()}
    before = [f for m in months for f in book["bars"].get(m, [])]
    kept = {}
    if before:
        stays = _read_bars(spark, root, before, numbered.schema).select(*numbered.columns)
        _write_bars(_kept(stays, first), root, f"{run}-kept")
        kept = _written_months(spark, root, f"{run}-kept")
    book["bars"] |= {m: [f for f in (written.get(m), kept.get(m)) if f] for m in months}

    book["state"] = [_write(advance_last(kept_state, new), root, "state", run)]
    opened = calendar_of(new).join(t["calendar"], "date", "left_anti")
    if not opened.isEmpty():  # a few days: a file more
        book["calendar"].append(_write(opened, root, "calendar", run))
    # a corrected code may start earlier than it did; a code's first day never gets later
    starts = first.withColumnRenamed("first_changed", "first_date").join(t["listing"].withColumnRenamed("first_date", "was"), "code", "left")
    if not starts.where("was IS NULL OR first_date < was").isEmpty():
        listing = t["listing"].unionByName(starts.select("code", "first_date")).groupBy("code").agg(F.min("first_date").alias("first_date"))
        book["listing"] = [_write(listing, root, "listing", run)]
    _commit(spark, root, book, content["schemas"], content["version"])
    remove(spark, f"{root}/changed/{run}")
    return months


def delete_newest_day(spark: SparkSession, root: str) -> str | None:
    """K05/K06 on the book: the bars of the newest day and their averages go,
    in one version; returns the day. No other average depends on them."""
    content = versions.manifest(spark, root)
    t = _frames(spark, root, content)
    day = t["state"].agg(F.max("hwm").alias("d")).first()["d"]
    if day is None:
        return None
    run, month = uuid.uuid4().hex, day.strftime("%Y-%m")
    book = {name: list(files) if name != "bars" else dict(files) for name, files in content["book"].items()}
    numbered = t["bars"].select(*BAR_COLS, *INDEX_COLS)
    stays = _read_bars(spark, root, book["bars"][month], numbered.schema).select(*numbered.columns).filter(F.col("date") < F.lit(day))
    _write_bars(stays, root, run)
    book["bars"].pop(month)
    book["bars"] |= {m: [f] for m, f in _written_months(spark, root, run).items()}
    # codes that had a bar on that day fall back to the one before, at bar_no - 1; the others keep their state
    touched = t["state"].filter(F.col("hwm") == F.lit(day)).select("code", (F.col("hwm_no") - 1).alias("bar_no"))
    earlier = numbered.filter(F.col("date") < F.lit(day)).join(touched, ["code", "bar_no"])
    state = t["state"].filter(F.col("hwm") < F.lit(day)).unionByName(last_rows(earlier))
    book["state"] = [_write(state, root, "state", run)]
    book["calendar"] = [_write(t["calendar"].filter(F.col("date") < F.lit(day)), root, "calendar", run)]
    book["listing"] = [_write(t["listing"].filter(F.col("first_date") < F.lit(day)), root, "listing", run)]
    _commit(spark, root, book, content["schemas"], content["version"])
    return day.isoformat()
