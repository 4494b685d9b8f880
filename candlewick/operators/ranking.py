"""Distributed global row numbers.

``row_number()`` over a window without partition puts every row into one
task. Here the rows are range partitioned on the sort keys, each partition
numbers its own rows, and a partition's offset is the number of rows in the
partitions before it (one small aggregate: one row per partition).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewick.session import fresh_dir


def global_row_number(df: DataFrame, order: list[Column], name: str = "rn", partitions: int | None = None,
                      group: str | None = None) -> DataFrame:
    """``df`` with ``name`` = 1-based position in ``order`` (within each
    value of ``group`` when given; ties broken by the order columns only:
    give a unique key last).

    Numbering needs two passes (partition sizes, then numbers) that agree on
    which partition a row is in. Range bounds come from a sample, so two
    plans over the same rows may cut them differently: the rows are written
    once, after the range partitioning and with their partition as a column,
    to a folder of this call in the shared folder, and both passes read it.
    """
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    g = [group] if group else []
    path = fresh_dir(spark, "numbering")
    (df.repartitionByRange(n, *[F.col(c) for c in g], *order)
     .withColumn("_pid", F.spark_partition_id()).write.parquet(path))
    parts = spark.read.parquet(path)
    local = parts.withColumn("_lrn", F.row_number().over(Window.partitionBy("_pid", *g).orderBy(*order)))
    sizes = parts.groupBy("_pid", *g).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*g).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_pid", *g, F.sum("_n").over(before).alias("_off"))  # a row per partition and group
    return (
        local.join(offsets, ["_pid", *g])
        .withColumn(name, (F.coalesce(F.col("_off"), F.lit(0)) + F.col("_lrn")).cast("int"))
        .drop("_pid", "_lrn", "_off")
    )
