"""Quote streams (R01-R06) with Structured Streaming.

A quote is (code, event_ts, price, volume). The file source lands snapshot
files; the stream de-duplicates repeated quotes within the watermark, keeps
the latest quote per code, appends the raw quotes to a history table
exactly once per micro-batch, turns the latest snapshot into provisional
daily bars, and builds tumbling daily OHLCV bars. All state is keyed by
code (and window), so it spreads over the shuffle partitions; the
checkpoint in the shared folder lets a restarted query resume.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.operators.bars import tick_to_bar
from candlewick.session import remove

QUOTE_STREAM = T.StructType([
    T.StructField("code", T.StringType()),
    T.StructField("event_ts", T.TimestampType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("volume", T.DoubleType()),
])


def quotes_from_events(events: DataFrame) -> DataFrame:
    """Fixture mapping of the driver's `events`: code = user_id, price = value."""
    return events.select(
        F.col("user_id").cast("string").alias("code"),
        F.col("ts").alias("event_ts"),
        F.col("value").alias("price"),
        F.lit(1.0).alias("volume"),
    )


def event_time(date_col: str = "date", time_col: str = "time") -> F.Column:
    """Event timestamp from a date column and a `HH:MM:SS` text column."""
    return F.to_timestamp(F.concat_ws(" ", F.col(date_col).cast("string"), F.col(time_col)))


def read_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                max_files_per_trigger: int | None = None) -> DataFrame:
    """File-source stream with an explicit schema (never inferred)."""
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def dedupe(quotes: DataFrame, watermark: str = "1 hour") -> DataFrame:
    """Drop repeated quotes (same code and event time) within the watermark."""
    return (quotes.withColumn("event_ts", F.col("event_ts").cast("timestamp"))
            .withWatermark("event_ts", watermark).dropDuplicatesWithinWatermark(["code", "event_ts"]))


def daily_bars(quotes: DataFrame, watermark: str | None = "1 hour", width: str = "1 day") -> DataFrame:
    """Tumbling OHLCV bars per code. In a stream with a watermark and
    append mode a window is emitted once it has closed; late quotes beyond
    the watermark are dropped (the final daily bar corrects it, Q10)."""
    when = F.struct("event_ts", "price", "volume")  # equal times: the lower price comes first
    src = quotes
    if watermark:
        # watermarks need an instant type; wall-clock (NTZ) input is read in the session time zone
        src = src.withColumn("event_ts", F.col("event_ts").cast("timestamp")).withWatermark("event_ts", watermark)
    return (
        src.groupBy(F.window("event_ts", width).alias("w"), "code")
        .agg(
            F.min_by("price", when).alias("open"),
            F.max("price").alias("high"),
            F.min("price").alias("low"),
            F.max_by("price", when).alias("close"),
            F.sum("volume").alias("volume"),
            F.count(F.lit(1)).alias("n_quotes"),
        )
        .select("code", F.col("w.start").cast("timestamp_ntz").alias("window_start"), "open", "high", "low",
                "close", "volume", "n_quotes")
    )


def start_daily_bars(quotes: DataFrame, root: str, checkpoint: str, watermark: str = "1 hour", width: str = "1 day",
                     available_now: bool = True):
    """R06 as a running stream: repeated quotes are dropped within the
    watermark, a window's bar is appended to the table at ``root`` once, when
    the watermark has passed its end; the file sink's log makes that exactly
    once across restarts. Returns the StreamingQuery."""
    once = dedupe(quotes, watermark)
    writer = (daily_bars(once, watermark=None, width=width).writeStream.format("parquet").outputMode("append")
              .option("path", root).option("checkpointLocation", checkpoint))
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def latest(quotes: DataFrame) -> DataFrame:
    """The newest quote per code (batch or update-mode stream); of quotes
    with equal times the one that is greatest by its other columns."""
    cols = ["event_ts", *[c for c in quotes.columns if c not in ("code", "event_ts")]]
    newest = quotes.groupBy("code").agg(F.max(F.struct(*cols)).alias("q"))
    return newest.select("code", "q.*").select(*quotes.columns)


def upsert_latest(current: DataFrame | None, batch: DataFrame) -> DataFrame:
    """R03 in foreachBatch: current latest table merged with a batch."""
    merged = batch if current is None else current.unionByName(batch.select(*current.columns))
    return latest(merged)


def _batch_dir(root: str, batch_id: int) -> str:
    return f"{root.rstrip('/')}/batch_id={batch_id}"


def read_newest(spark: SparkSession, path: str) -> DataFrame:
    """The newest snapshot of a per-batch snapshot table (``latest`` or
    ``provisional``): rows of the highest batch_id (one small scalar)."""
    df = spark.read.parquet(path)
    newest = df.agg(F.max("batch_id").alias("b")).first()["b"]
    return df.filter(F.col("batch_id") == F.lit(newest)).drop("batch_id")


def history_sink(root: str):
    """A foreachBatch function that writes a batch's quotes to
    ``history/batch_id=N`` with overwrite."""
    def run(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(_batch_dir(f"{root}/history", batch_id))
    return run


def quote_sink(root: str, history_bars: DataFrame | None = None, as_of=None):
    """A foreachBatch function.

    Each micro-batch writes its quotes to ``history/batch_id=N`` (the
    history is all batches) and the merged latest table to
    ``latest/batch_id=N`` (a full snapshot: read the newest with
    ``read_newest``) with overwrite: a batch replayed after a failure
    rewrites the same folders, so the sink is exactly once together with
    the stream checkpoint. A previous snapshot that cannot be read fails
    the batch. The snapshots of the last two batches are kept: a replay
    needs the one before.

    With ``history_bars`` the quotes of the latest snapshot that are of the
    day become provisional daily bars (X03) under ``provisional/batch_id=N``;
    the day is ``as_of`` or else the newest day of the snapshot. A quote of
    an earlier day is not a bar of today and its day has a bar already.
    """
    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch.write.mode("overwrite").parquet(_batch_dir(f"{root}/history", batch_id))
        prev = spark.read.parquet(_batch_dir(f"{root}/latest", batch_id - 1)) if batch_id > 0 else None
        upsert_latest(prev, batch).write.mode("overwrite").parquet(_batch_dir(f"{root}/latest", batch_id))
        remove(spark, _batch_dir(f"{root}/latest", batch_id - 2))
        if history_bars is None:
            return
        cur = spark.read.parquet(_batch_dir(f"{root}/latest", batch_id)).withColumn("date", F.to_date("event_ts"))
        day = as_of or cur.agg(F.max("date").alias("d")).first()["d"]
        if day is not None:
            snap = cur.filter(F.col("date") == F.lit(day)).select(
                "code", "date", "open", "high", "low", "price", "pre_close", "volume")
            tick_to_bar(snap, history_bars, day).write.mode("overwrite").parquet(
                _batch_dir(f"{root}/provisional", batch_id))
            remove(spark, _batch_dir(f"{root}/provisional", batch_id - 2))
    return run


def start_quote_pipeline(quotes: DataFrame, root: str, checkpoint: str, history_bars: DataFrame | None = None,
                         as_of=None, available_now: bool = True):
    """Starts the R02-R05 stream; returns the StreamingQuery."""
    writer = (
        quotes.writeStream.foreachBatch(quote_sink(root, history_bars, as_of))
        .option("checkpointLocation", checkpoint)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
