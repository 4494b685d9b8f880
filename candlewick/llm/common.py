"""Small helpers shared by the operators."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.session import shared_dir

#: A word: a run of characters other than space, tab, line feed, vertical tab, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(c: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    return F.translate(c, UPPER, LOWER)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends the package to the Python workers, once per application: they need not have it installed."""
    sc = spark.sparkContext
    if sc.applicationId not in _shipped:
        root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        archive = shutil.make_archive(os.path.join(tempfile.mkdtemp(), "candlewick_code"), "zip", os.path.dirname(root), os.path.basename(root))
        sc.addPyFile(archive)  # Spark's file server hands it to every executor
        _shipped.add(sc.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A folder of its own for each call, in the folder that the cluster shares."""
    return f"{shared_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: computed once, and a lost executor rereads files."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def crc_fold(id_col: Column, folds: int = 5) -> Column:
    """crc32 of the id as text, modulo ``folds``: 0 is the held-out fold. A null id is in fold 0."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % folds, F.lit(0))


def labelled_rows(docs: DataFrame, labels: DataFrame, label: str, most: int, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """``(id, text, label)`` of at most ``most`` documents of each label (0 and 1), chosen by a hash of their id,
    outside the held-out fold: the only rows that a classifier learns from. An id with both labels counts as 1."""
    known = (
        labels.where(F.col(label).isin(0, 1) & F.col(id_col).isNotNull() & (crc_fold(F.col(id_col)) != 0))
        .groupBy(F.col(id_col).alias("id")).agg(F.max(label).alias("label"))
    )
    chosen = bounded_sample(known.where("label = 0"), most, "id").union(bounded_sample(known.where("label = 1"), most, "id"))
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.join(F.broadcast(chosen), "id")  # at most 2 * most ids


def bounded_sample(rows: DataFrame, most: int, *key: str) -> DataFrame:
    """At most ``most`` rows, spread evenly by a hash of ``key``; the same rows on every run."""
    return rows.orderBy(F.xxhash64(*key), *key).limit(most)


#: Bits of a join filter: its table has at most FILTER_BITS / 8 bytes (1 MB), whatever the number of keys.
FILTER_BITS = 1 << 23


def id_filter(keys: DataFrame, key: str) -> DataFrame:
    """A bitmap of the hashes of a long column: (part, bits), at most FILTER_BITS / 8 bytes in all."""
    place = F.pmod(F.col(key), F.lit(FILTER_BITS))
    return keys.groupBy(F.bitmap_bucket_number(place).alias("_part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("_bits"))


def maybe_in(df: DataFrame, key: Column, filter_: DataFrame) -> DataFrame:
    """The rows whose key may be among those of the filter: all that are, and others by chance. It only spares the
    shuffle of rows that an exact join would drop; that join follows."""
    place = F.pmod(key, F.lit(FILTER_BITS))
    position = F.bitmap_bit_position(place)
    byte = F.conv(F.hex(F.substring("_bits", (position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    hit = F.getbit(byte, (position % 8).cast("int")) == 1
    return df.withColumn("_part", F.bitmap_bucket_number(place)).join(F.broadcast(filter_), "_part").where(hit).drop("_part", "_bits")
