"""R03/R05/S08 as keyed state: a micro-batch emits the codes that it changes, and nothing else.

The state of a code is its newest quote with the time of the micro-batch that
brought it. The aggregate runs in update mode, which hands on every code of a
batch; those whose newest quote came earlier are left out by comparing that
time with the batch's own (Spark gives all of a batch one time, and the same
one when it replays the batch). So a batch reads no table and writes as many
rows as it changes codes.

The rows of batch N go to ``latest/changes/batch_id=N`` with overwrite, so a
replayed batch rewrites its own. Now and then a batch folds the changes into
``latest/base/upto=N``; the base before and the changes behind it stay until
the next time, for readers that have opened them.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.operators.bars import tick_to_bar
from candlewick.session import hadoop_path, path_exists, remove

#: Batches between two folds.
FOLD_EVERY = 20


def changed_codes(quotes: DataFrame) -> DataFrame:
    """The newest quote of each code that a micro-batch changes; of quotes with equal times the greatest by its other
    columns. Late and repeated quotes change nothing, whatever their delay, so no watermark is needed."""
    rest = [c for c in quotes.columns if c not in ("code", "event_ts")]
    earlier_first = -F.unix_micros(F.current_timestamp())  # a repeated quote keeps the batch that brought it first
    newest = quotes.withColumn("_seen", earlier_first).groupBy("code").agg(F.max(F.struct("event_ts", *rest, "_seen")).alias("q"))
    return newest.where(F.col("q._seen") == -F.unix_micros(F.current_timestamp())).select(
        *[F.col("code") if c == "code" else F.col(f"q.{c}") for c in quotes.columns])


def _numbers(spark: SparkSession, path: str, key: str) -> list[int]:
    """The finished folders ``key=N`` under a path."""
    fs, p = hadoop_path(spark, path)
    names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
    return sorted(int(n.removeprefix(f"{key}=")) for n in names if n.startswith(f"{key}=") and path_exists(spark, f"{path}/{n}/_SUCCESS"))


def _merged(spark: SparkSession, root: str, upto: int | None = None) -> DataFrame | None:
    """The newest row of each code from the last base and the changes behind it, up to a batch."""
    bases = [n for n in _numbers(spark, f"{root}/base", "upto") if upto is None or n < upto]
    changes = [n for n in _numbers(spark, f"{root}/changes", "batch_id") if (not bases or n > bases[-1]) and (upto is None or n <= upto)]
    parts = [spark.read.parquet(f"{root}/base/upto={bases[-1]}")] if bases else []
    if changes:
        behind = spark.read.option("basePath", f"{root}/changes").parquet(*[f"{root}/changes/batch_id={n}" for n in changes])
        parts.append(behind.withColumn("batch_id", F.col("batch_id").cast("long")))
    if not parts:
        return None
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    columns = [c for c in rows.columns if c not in ("code", "batch_id")]
    last = rows.groupBy("code").agg(F.max(F.struct("batch_id", *columns)).alias("r"))  # a batch has one row of a code
    return last.select("code", *[F.col(f"r.{c}") for c in columns], F.col("r.batch_id").alias("batch_id"))


def read_latest(spark: SparkSession, path: str) -> DataFrame:
    """The table at ``path`` (``.../latest`` or ``.../provisional``) as the last finished batch left it: a row per code."""
    rows = _merged(spark, path)
    if rows is None:
        raise FileNotFoundError(f"no batch has finished at {path}")
    return rows.drop("batch_id")


def _put(spark: SparkSession, rows: DataFrame, root: str, batch_id: int, fold_every: int) -> DataFrame:
    path = f"{root}/changes/batch_id={batch_id}"
    rows.write.mode("overwrite").parquet(path)
    if batch_id and batch_id % fold_every == 0:
        upto = batch_id - 1  # the batches before are finished for good
        merged = _merged(spark, root, upto)
        if merged is not None:
            merged.write.mode("overwrite").parquet(f"{root}/base/upto={upto}")
            before = upto - fold_every
            for n in _numbers(spark, f"{root}/changes", "batch_id"):
                if n <= before:
                    remove(spark, f"{root}/changes/batch_id={n}")
            for n in _numbers(spark, f"{root}/base", "upto"):
                if n < before:
                    remove(spark, f"{root}/base/upto={n}")
    return spark.read.schema(rows.schema).parquet(path)


def change_sink(root: str, history_bars: DataFrame | None = None, as_of: dt.date | None = None, fold_every: int = FOLD_EVERY):
    """A foreachBatch function for ``changed_codes``: the changes, and with ``history_bars`` the provisional bars (X03) of
    the changed codes whose quote is of the day: ``as_of``, or else the newest day among the changes."""
    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = _put(spark, batch, f"{root}/latest", batch_id, fold_every)
        if history_bars is None:
            return
        dated = rows.withColumn("date", F.to_date("event_ts"))
        day = as_of or dated.agg(F.max("date").alias("d")).first()["d"]
        if day is not None:
            quotes = dated.filter(F.col("date") == F.lit(day)).select("code", "date", "open", "high", "low", "price", "pre_close", "volume")
            _put(spark, tick_to_bar(quotes, history_bars, day), f"{root}/provisional", batch_id, fold_every)
    return run


def read_provisional(spark: SparkSession, path: str) -> DataFrame:
    """The provisional bars of the newest day that has any: a row per code."""
    rows = read_latest(spark, path)
    newest = rows.agg(F.max("date").alias("d")).first()["d"]
    return rows.filter(F.col("date") == F.lit(newest))


def start_latest(quotes: DataFrame, root: str, checkpoint: str, history_bars: DataFrame | None = None, as_of: dt.date | None = None,
                 available_now: bool = True, fold_every: int = FOLD_EVERY):
    """Starts the stream of changes; returns the StreamingQuery."""
    writer = (changed_codes(quotes).writeStream.outputMode("update").foreachBatch(change_sink(root, history_bars, as_of, fold_every))
              .option("checkpointLocation", checkpoint))
    return (writer.trigger(availableNow=True) if available_now else writer).start()
