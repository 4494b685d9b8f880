"""Bar table maintenance.

Everything is keyed on (code, date). Per-code side tables (high-water marks,
tails of the series) have one row - or at most 249 rows - per code, so they
grow with the universe, not with the history; AQE decides at run time
whether they are broadcast.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from candlewick.operators.windows import INDEX_COLS, TAIL_LEN, by_code, with_moving_averages
from candlewick.schema import BAR_BASE_COLS, BAR_COLS, INDEX_NAMES

KEY = ["code", "date"]


# ------------------------------------------------------------------ loading
def high_water_mark(stored: DataFrame) -> DataFrame:
    """Per code the newest stored day and the first day to load."""
    return stored.groupBy("code").agg(F.max("date").alias("hwm")).withColumn(
        "start_day", F.date_add("hwm", 1))


def incremental_rows(stored: DataFrame, landed: DataFrame) -> DataFrame:
    """Landed rows newer than the code's newest stored day; a code
    with nothing stored takes its full history."""
    hwm = high_water_mark(stored).select("code", "hwm")
    return (
        landed.join(hwm, "code", "left")
        .filter(F.col("hwm").isNull() | (F.col("date") > F.col("hwm")))
        .drop("hwm")
    )


def one_per_key(rows: DataFrame, newest_by: str | None = None) -> DataFrame:
    """One row per (code, date): the newest by ``newest_by`` (a load time or
    batch number) when given, and the greatest by its columns among equals,
    so that a rerun keeps the same copy. A partial aggregate."""
    rest = [c for c in rows.columns if c not in KEY and c != newest_by]
    order = [newest_by, *rest] if newest_by else rest
    return rows.groupBy(*KEY).agg(F.max(F.struct(*order)).alias("_row")).select(
        *[F.col(c) if c in KEY else F.col(f"_row.{c}") for c in rows.columns])


def append_new(stored: DataFrame, incoming: DataFrame, newest_by: str | None = None) -> DataFrame:
    """Rows of ``incoming`` whose key is not stored yet (a rerun adds
    nothing); also de-duplicates ``incoming`` on the key (Q12)."""
    return one_per_key(incoming, newest_by).join(stored.select(*KEY), KEY, "left_anti")


def upsert(stored: DataFrame, incoming: DataFrame, cols=None, newest_by: str | None = None) -> DataFrame:
    """Q10: the table after replacing stored rows by incoming rows with the
    same (code, date); incoming duplicates keep one row per key."""
    cols = cols or stored.columns
    inc = one_per_key(incoming, newest_by).select(*cols)
    return stored.select(*cols).join(inc.select(*KEY), KEY, "left_anti").unionByName(inc)


def merge_provisional(final: DataFrame, provisional: DataFrame, cols=None, newest_by: str | None = None) -> DataFrame:
    """Q10: a provisional bar (from quotes) is kept only where no final bar
    of that (code, date) exists; a final bar always wins."""
    cols = cols or final.columns
    extra = one_per_key(provisional, newest_by).select(*cols).join(final.select(*KEY), KEY, "left_anti")
    return final.select(*cols).unionByName(extra)


def delete_day(bars: DataFrame, day) -> DataFrame:
    """The table without the bars of ``day``."""
    return bars.filter(F.col("date") != F.lit(day))


# Feed ids of the index series and their codes.
INDEX_ID_TO_CODE = [
    ("000001", "sh"), ("399001", "sz"), ("000300", "hs300"),
    ("000016", "sz50"), ("399005", "zxb"), ("399006", "cyb"),
]


def rename_index_ids(landed_index: DataFrame, id_col: str = "code") -> DataFrame:
    """Index bars keyed by feed id -> index code (a map literal of six
    ids, no join); rows of other ids are left out."""
    codes = F.create_map(*[F.lit(x) for pair in INDEX_ID_TO_CODE for x in pair])
    return (
        landed_index.withColumn("_index_code", F.try_element_at(codes, F.col(id_col))).filter(F.col("_index_code").isNotNull())
        .drop(id_col).withColumnRenamed("_index_code", "code")
    )


def universe(spark: SparkSession, info: DataFrame) -> DataFrame:
    """Valid 6-character codes of the dimension plus the index names (Q11)."""
    idx = spark.createDataFrame([(n,) for n in INDEX_NAMES], "code string")
    stocks = info.select("code").filter(F.col("code").isNotNull() & (F.length("code") == 6))
    return stocks.unionByName(idx).distinct()


# --------------------------------------------------------- moving averages
def last_rows(ma: DataFrame) -> DataFrame:
    """Per-code state of an indexed MA table: newest day (hwm), its bar_no
    and tail_from. One row per code; stored next to the table and advanced
    by each refresh, so a refresh never derives it from the history."""
    return ma.groupBy("code").agg(
        F.max("date").alias("hwm"), F.max_by("bar_no", "date").alias("hwm_no"),
        F.max_by("tail_from", "date").alias("hwm_tail"))


def advance_last(last: DataFrame, new_rows: DataFrame) -> DataFrame:
    """State after appending ``new_rows`` (indexed MA rows newer than each
    code's hwm): codes with new rows take their newest new row."""
    return last.join(new_rows.select("code").distinct(), "code", "left_anti").unionByName(last_rows(new_rows))


def extend_moving_averages(stored_ma: DataFrame, bars: DataFrame, first_dates: DataFrame | None = None,
                           since=None, last: DataFrame | None = None,
                           first_new: DataFrame | None = None) -> DataFrame:
    """W02 (Q21 fix): MA rows for bars newer than each code's newest MA row.

    Each new row's averages need the code's last TAIL_LEN bars before its
    first new day (a bounded row_number window), so ma250 of an incremental
    run equals a full rebuild even after a long backlog or a code that
    missed days. ``since`` bounds the dates of new bars when the caller
    knows it (the daily refresh passes its first changed day).

    With ``last`` (the stored per-code state of ``stored_ma``, see
    ``last_rows``) the history is not scanned for the newest rows, and the
    tail of every code starts at ``tail_from`` of its newest row (or at its
    first day, from ``first_dates``, while it has fewer bars): only bars from
    the smallest such day on are read - a date predicate that reaches the
    scan. Without it, the newest rows come from an aggregate over
    ``stored_ma`` and the tail from the history's four needed columns. When
    ``stored_ma`` is indexed (bar_no, tail_from), new rows get their index
    columns in the same window pass. ``first_new`` (code, first_new) may
    name each code's first new day when the caller knows it (the refresh:
    its first changed day per code); otherwise it is derived from the new
    bars.
    """
    indexed = all(c in stored_ma.columns for c in INDEX_COLS)
    if last is not None:
        hw = last
    elif indexed:
        hw = last_rows(stored_ma)
    else:
        hw = stored_ma.groupBy("code").agg(F.max("date").alias("hwm"))
    src = bars.select(*BAR_BASE_COLS)
    if since is not None:
        src = src.filter(F.col("date") >= F.lit(since))
    new = src.join(hw, "code", "left").filter(F.col("hwm").isNull() | (F.col("date") > F.col("hwm")))
    if first_new is None:
        first_new = new.groupBy("code").agg(F.min("date").alias("first_new"))
    if "bar_no" in bars.columns:
        # positions are stored: a code's tail is a range of them, no window over the history
        firsts = (
            bars.select("code", "date", "bar_no").join(first_new.withColumnRenamed("first_new", "date"), ["code", "date"])
            .select("code", F.col("bar_no").alias("first_no"))
        )
        tail = (
            bars.select("code", "date", "close", "volume", "bar_no").join(firsts, "code")
            .filter(F.col("bar_no").between(F.col("first_no") - TAIL_LEN, F.col("first_no") - 1))
            .select("code", "date", "close", "volume")
        )
    else:
        history = bars.select("code", "date", "close", "volume")  # the tail only feeds the averages
        starts = first_new.withColumn("tail_start", F.lit(None).cast("date"))
        if last is not None:
            starts = _tail_starts(first_new, hw, first_dates)
            r = starts.agg(F.min("tail_start").alias("lo"), F.count_if(F.col("tail_start").isNull()).alias("unknown")).first()
            if r["unknown"] == 0:  # (no stored code has new bars: lo is null and no tail is read)
                history = history.filter(F.col("date") >= F.lit(r["lo"] or dt.date.max))
        # rows before a code's own tail start leave before the window: a code that resumes after years pulls no other
        # code's years into it
        tail = (
            history.join(starts, "code")
            .filter((F.col("date") < F.col("first_new"))
                    & (F.col("tail_start").isNull() | (F.col("date") >= F.col("tail_start"))))
            .withColumn("_rn", F.row_number().over(Window.partitionBy("code").orderBy(F.col("date").desc())))
            .filter(F.col("_rn") <= TAIL_LEN)
            .drop("_rn", "first_new", "tail_start")
        )
    keep_cols = [c for c in new.columns if c not in ("hwm", "hwm_tail")]
    base = tail.withColumn("_new", F.lit(False)).unionByName(
        new.select(*keep_cols).withColumn("_new", F.lit(True)), allowMissingColumns=True)
    ma = with_moving_averages(base.drop("ma5", "ma10", "ma20", "v_ma5", "v_ma10", "v_ma20"))
    out = list(BAR_COLS)
    if indexed:
        w = by_code()
        position = F.sum(F.col("_new").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0))
        ma = ma.withColumns({
            "bar_no": (F.coalesce(F.col("hwm_no"), F.lit(0)) + position).cast("bigint"),
            "tail_from": F.lag("date", TAIL_LEN - 1).over(w),
        })
        out += INDEX_COLS
    return ma.filter("_new").select(*out)


def _tail_starts(first_new: DataFrame, hw: DataFrame, first_dates: DataFrame | None) -> DataFrame:
    """(code, first_new, tail_start): the day each stored code's tail starts
    on; null where it is unknown (read all of the code)."""
    cand = first_new.join(hw.filter(F.col("hwm").isNotNull()), "code")
    bound = F.col("hwm_tail")
    if first_dates is not None:
        cand = cand.join(first_dates, "code", "left")
        bound = F.coalesce(bound, F.col("first_date"))
    return cand.select("code", "first_new", bound.alias("tail_start"))


def refresh_moving_averages(stored_ma: DataFrame, bars: DataFrame) -> DataFrame:
    """W02 as a table update: the MA table with the rows of new days added
    (index columns kept when the table has them)."""
    return upsert(stored_ma, extend_moving_averages(stored_ma, bars), stored_ma.columns)


# ------------------------------------------------------------- quotes->bars
def ticks_from_bars(bars: DataFrame, day) -> DataFrame:
    """Fixture: the quote snapshot of ``day`` (stock_tick_data layout subset)."""
    return bars.filter((F.col("date") == F.lit(day)) & ~F.col("code").isin(*INDEX_NAMES)).select(
        "code", "date", F.lit("15:00:00").alias("time"), "open", "high", "low",
        F.col("close").alias("price"), (F.col("close") - F.col("price_change")).alias("pre_close"),
        (F.col("volume") * 100).alias("volume"))


def tick_to_bar(ticks: DataFrame, history: DataFrame, day, lookback_days: int = 90) -> DataFrame:
    """Snapshot -> provisional daily bar.

    ma_k = ma_k(newest bar) + (price - close of the k-th newest bar) / k for
    k = 5, 10, 20 over the bars of the last ``lookback_days`` calendar days
    before ``day`` (fewer than k bars -> NULL). Codes without history are
    dropped (inner join). Volume is converted from shares to lots.
    """
    day = day if isinstance(day, dt.date) else dt.date.fromisoformat(str(day))
    recent = history.filter(
        (F.col("date") >= F.lit(day - dt.timedelta(days=lookback_days))) & (F.col("date") < F.lit(day)))
    ranked = recent.withColumn("rank", F.row_number().over(
        Window.partitionBy("code").orderBy(F.col("date").desc())))
    # ranks above 20 are never read: cut them before the pivot aggregation
    t = ranked.filter(F.col("rank") <= 20).groupBy("code").agg(
        F.max(F.when(F.col("rank") == 5, F.col("close"))).alias("price5"),
        F.max(F.when(F.col("rank") == 10, F.col("close"))).alias("price10"),
        F.max(F.when(F.col("rank") == 20, F.col("close"))).alias("price20"),
        F.max(F.when(F.col("rank") == 1, F.col("ma5"))).alias("last_ma5"),
        F.max(F.when(F.col("rank") == 1, F.col("ma10"))).alias("last_ma10"),
        F.max(F.when(F.col("rank") == 1, F.col("ma20"))).alias("last_ma20"),
    )
    s = ticks
    return s.join(t, "code").select(
        "code", "date", "open", "high",
        F.col("price").alias("close"), "low",
        (F.col("volume") / 100).alias("volume"),
        (F.col("price") - F.col("pre_close")).alias("price_change"),
        (F.try_divide(F.col("price") - F.col("pre_close"), F.col("pre_close")) * 100).alias("p_change"),
        (F.col("last_ma5") + (F.col("price") - F.col("price5")) / 5).alias("ma5"),
        (F.col("last_ma10") + (F.col("price") - F.col("price10")) / 10).alias("ma10"),
        (F.col("last_ma20") + (F.col("price") - F.col("price20")) / 20).alias("ma20"),
        F.lit(0.0).alias("v_ma5"), F.lit(0.0).alias("v_ma10"), F.lit(0.0).alias("v_ma20"),
        F.lit(0.0).alias("turnover"),
    )
