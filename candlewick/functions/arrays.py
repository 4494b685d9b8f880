"""Ordered array aggregates and ANSI-safe array access.

Spark has no ``array_agg(x ORDER BY y)``: collect structs whose leading
fields are the sort keys, sort the array, and project the value. A struct
keeps NULL values that ``collect_list(x)`` would drop.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def ordered_list(value, key, descending: bool = False) -> Column:
    """Values of the group ordered by ``key`` (unique within the group).

    Descending order puts NULL keys last, ascending puts them first.
    """
    val = F.col(value) if isinstance(value, str) else value
    key_col = F.col(key) if isinstance(key, str) else key
    arr = F.sort_array(F.collect_list(F.struct(key_col.alias("k"), val.alias("v"))), asc=not descending)
    return F.transform(arr, _field("v"))


def _field(name: str):
    return lambda x: x[name]


def nth(arr, i: int) -> Column:
    """1-based subscript, NULL when out of range (PostgreSQL rule)."""
    return F.try_element_at(F.col(arr) if isinstance(arr, str) else arr, F.lit(i))


def last(arr) -> Column:
    """last element, NULL for an empty array."""
    return F.try_element_at(F.col(arr) if isinstance(arr, str) else arr, F.lit(-1))


def join_percent(arr) -> Column:
    """`1.00%,2.50%` from an array of doubles (two decimals each, Q24)."""
    col = F.col(arr) if isinstance(arr, str) else arr
    return F.concat(F.array_join(F.transform(col, lambda x: F.format_string("%.2f", x)), "%,"), F.lit("%"))


def top_k_lists(
    df: DataFrame,
    keys: list[str],
    order: list[Column],
    k: int,
    values: dict[str, Column],
) -> DataFrame:
    """Per group, the first ``k`` values in ``order`` as arrays.

    ``row_number() <= k`` is planned as a WindowGroupLimit whose partial
    step runs before the shuffle, so each map task sends at most k rows per
    group: a group holding a third of all rows never reaches one reducer
    whole. Only k rows per group are then collected.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    ranked = df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= k)
    fields = [F.col("_rn")] + [v.alias(name) for name, v in values.items()]
    agg = ranked.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(*fields))).alias("_top"))
    return agg.select(*keys, *[F.transform("_top", _field(name)).alias(name) for name in values])
