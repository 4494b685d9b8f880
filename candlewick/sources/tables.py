"""Table access: parameterised SQL scans, explicit-schema reads, replace and
append writes (S01, S05, S06, S09, K01-K03).

Tables are Parquet folders; a write never goes through the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from candlewick.plans.market import Market, read_landed  # noqa: F401  (read_landed: S05/S06/K02)


def register_views(m: Market, prefix: str = "") -> None:
    """Expose the market as temp views for SQL: stock_daily (bars with all
    MA columns), stock_info, stock_concept, trading_calendar."""
    m.bars.createOrReplaceTempView(f"{prefix}stock_daily")
    m.info.createOrReplaceTempView(f"{prefix}stock_info")
    m.concept.createOrReplaceTempView(f"{prefix}stock_concept")
    m.calendar.createOrReplaceTempView(f"{prefix}trading_calendar")


def sql_scan(spark: SparkSession, text: str, **params) -> DataFrame:
    """SQL with named parameter markers (``:name``) bound by Spark."""
    return spark.sql(text, args=params)


def replace_table(df: DataFrame, path: str) -> None:
    """Full replace (instrument facts, concept tags)."""
    df.write.mode("overwrite").parquet(path)


def append_rows(df: DataFrame, path: str) -> None:
    """Append (snapshot history); callers de-duplicate on the key
    first (``operators.bars.append_new``) so a rerun adds nothing."""
    df.write.mode("append").parquet(path)


def store(df: DataFrame, path: str, sort_by=("date", "code")) -> DataFrame:
    """Materialise a derived table shared between jobs and read it back
    (cuts the lineage; the files survive lost executors)."""
    cols = [c for c in sort_by if c in df.columns]
    (df.sortWithinPartitions(*cols) if cols else df).write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)
