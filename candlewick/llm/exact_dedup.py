"""Exact deduplication with a stateful stream (operator 9, DataFrame functions and Structured Streaming only).

Landing: one narrow row per document (digest of the text, id, content locator = file and row) is written to the shared
folder. A stream over the landed files keeps one state row per digest in RocksDB (disk-backed, checkpointed to the
shared folder, no watermark: nothing expires): the largest id with its locator, and the number of copies. The state is
read back as a table and joined to the landed rows.

A digest alone decides nothing: on every hit (a digest with more than one row) the document's full bytes are compared
with those of the row that the state's locator names; rows that differ form groups of their own by their bytes.

Defined results: a null text counts as empty, and all empty texts are equal; of rows with equal text and equal id the
one that comes last by (file, row) stays; a null id is below every other id; an empty table gives an empty table; the
locator is ``file``, ``pos`` of the result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.llm.common import fresh_path, id_filter, maybe_in, stored

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
FALLOCATE = "spark.sql.streaming.stateStore.rocksdb.allowFAllocate"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def located(docs: DataFrame) -> DataFrame:
    """``docs`` with the content locator ``_file``, ``_pos`` of each row; a frame that isn't a file scan is stored
    first, so that its rows have one."""
    where = (F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_pos"))
    try:
        return docs.select(F.struct("*").alias("row"), *where)
    except AnalysisException:
        return stored(docs, "content").select(F.struct("*").alias("row"), *where)


def keyed_state(landed: DataFrame, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """Runs the stream over the landed files at ``path`` to its end and returns its state: digest, keep, n."""
    spark = landed.sparkSession
    reader = spark.readStream.schema(landed.schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    state = reader.parquet(path).groupBy("digest").agg(
        F.max(F.struct("id", "file", "pos")).alias("keep"), F.count(F.lit(1)).alias("n"))
    checkpoint = fresh_path(spark, "dedup-state")
    # no space is set aside ahead of need: the state is many small stores
    settings = {PROVIDER: ROCKSDB, FALLOCATE: "false"}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        query = (state.writeStream.outputMode("update").format("noop").option("checkpointLocation", checkpoint)
                 .trigger(availableNow=True).start())
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    query.awaitTermination()
    return spark.read.format("statestore").load(checkpoint).select(
        "key.digest", F.col("value.max").alias("keep"), F.col("value.count").alias("n"))


def dedup_located(rows: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  digest: Callable[[Column], Column] = sha256, files_per_trigger: int | None = None) -> DataFrame:
    """``located`` rows -> one row per input row: id, keep_id, group_size, kept, digest, file, pos."""
    spark = rows.sparkSession
    text = F.coalesce(F.col(f"row.{text_col}"), F.lit(""))
    path = fresh_path(spark, "dedup-landing")
    rows.select(digest(text).alias("digest"), F.col(f"row.{id_col}").alias("id"), F.col("_file").alias("file"),
                F.col("_pos").alias("pos")).write.parquet(path)
    landed = spark.read.parquet(path)
    if landed.isEmpty():
        return landed.select(F.col("id").alias(id_col), F.col("id").alias("keep_id"), F.lit(0).cast("long").alias("group_size"),
                             F.lit(True).alias("kept"), "digest", "file", "pos")
    state = stored(keyed_state(landed, path, files_per_trigger), "dedup-groups")

    # hits: the texts of all rows whose digest occurs more than once, against the text that the locator names; a bitmap
    # of bounded size spares the shuffle of the texts that are alone
    shared = state.where("n > 1").select("digest", "keep")
    texts = rows.select(digest(text).alias("digest"), text.alias("text"), F.col("_file").alias("file"), F.col("_pos").alias("pos"))
    texts = maybe_in(texts, F.xxhash64("digest"), id_filter(shared.select(F.xxhash64("digest").alias("h")), "h"))
    hits = texts.join(shared, "digest")
    is_keeper = (F.col("file") == F.col("keep.file")) & (F.col("pos") == F.col("keep.pos"))
    keepers = hits.where(is_keeper).select("digest", F.col("text").alias("keep_text"))
    others = hits.where(~is_keeper).join(keepers, "digest").where(F.col("text") != F.col("keep_text"))
    others = stored(others.select("digest", "text", "file", "pos").join(landed.select("file", "pos", "id"), ["file", "pos"]), "dedup-differing")

    found = landed.join(state, "digest")
    keep, n = F.col("keep"), F.col("n")
    if not others.isEmpty():  # texts that share a digest without being equal: groups by their bytes
        apart = others.groupBy("digest", "text").agg(F.max(F.struct("id", "file", "pos")).alias("own"), F.count(F.lit(1)).alias("own_n"))
        apart = others.join(apart, ["digest", "text"]).select("file", "pos", "own", "own_n")
        fewer = others.groupBy("digest").agg(F.count(F.lit(1)).alias("away"))
        found = found.join(fewer, "digest", "left").join(apart, ["file", "pos"], "left")
        keep, n = F.coalesce("own", "keep"), F.coalesce("own_n", F.col("n") - F.coalesce("away", F.lit(0)))
    return found.select(
        F.col("id").alias(id_col), keep["id"].alias("keep_id"), n.alias("group_size"),
        ((F.col("file") == keep["file"]) & (F.col("pos") == keep["pos"])).alias("kept"), "digest", "file", "pos")


def dedup(docs: DataFrame, **options) -> DataFrame:
    return dedup_located(located(docs), **options)


def distinct_texts(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that stay, with the columns of ``docs``."""
    rows = located(docs)
    gone = dedup_located(rows, **options).where(~F.col("kept")).select("file", "pos")
    return rows.join(gone, (F.col("_file") == F.col("file")) & (F.col("_pos") == F.col("pos")), "left_anti").select("row.*")
