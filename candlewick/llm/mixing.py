"""Mixing sources to target weights with a time-varying curriculum (operator 4, DataFrame functions only).

Every source has a weight schedule: a piecewise linear function of training time in [0, 1]. Its integral is the
source's weight. The sources share ``budget`` times all words by weight; a source's target stops at ``max_repeat``
times its size, and what is over is shared again by weight until no target is above its limit.

A source's documents lie one after another in a fixed order (by the md5 of their id), passes follow each other, and
the mix takes the first ``target`` words of that line. A source's demand up to time t is its target times the integral
of its schedule up to t; inverting it gives each copy of each document its training position in [0, 1], and a range
sort by position is the training order.

Defined results: a null text has size 0; a null source is a source of its own, last in order; a document without words
is never taken (``taken`` 0, no position); equal ids are ordered by size, and rows equal in both are interchangeable;
an empty table gives an empty table. A boundary document may be taken in part, so that a source's taken words are its
target rounded to a word.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from candlewick.llm.common import WORD

#: Hash ranges into which each source's line of documents is cut (16^3), so that a source that holds a third of all
#: rows is numbered by thousands of tasks.
HEX_DIGITS = 3


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def ramps(rank: Column) -> Column:
    """Schedules whose integrals are the weights 1, 2, 3, repeating by source rank: even ranks rise from half the
    weight to one and a half times the weight, odd ranks fall."""
    w = (rank % 3 + 1).cast("double")
    low, high = w * 0.5, w * 1.5
    first = F.when(rank % 2 == 0, low).otherwise(high)
    last = F.when(rank % 2 == 0, high).otherwise(low)
    return F.array(F.struct(F.lit(0.0).alias("at"), first.alias("weight")), F.struct(F.lit(1.0).alias("at"), last.alias("weight")))


def _segments(knots: Column) -> Column:
    """Knots -> array of (t0, h, w0, slope, area): the linear pieces of a schedule."""
    def piece(i):
        a, b = F.element_at(knots, i), F.element_at(knots, i + 1)
        h = b["at"] - a["at"]
        return F.struct(a["at"].alias("t0"), a["weight"].alias("w0"), ((b["weight"] - a["weight"]) / h).alias("slope"),
                        (h * (a["weight"] + b["weight"]) / 2).alias("area"))
    return F.transform(F.sequence(F.lit(1), F.size(knots) - 1), piece)


def _with_starts(segments: Column) -> Column:
    """Adds ``u0``, the area before each piece."""
    return F.transform(segments, lambda s, i: F.struct(
        s["t0"].alias("t0"), s["w0"].alias("w0"), s["slope"].alias("slope"),
        F.aggregate(F.slice(segments, F.lit(1), i), F.lit(0.0), lambda acc, x: acc + x["area"]).alias("u0")))


def _inverse(pieces: Column, u: Column) -> Column:
    """The time at which the integral of the schedule is ``u``: the root of w0*x + slope*x^2/2 = u - u0."""
    s = F.element_at(F.filter(pieces, lambda p: p["u0"] <= u), -1)
    r = u - s["u0"]
    root = F.sqrt(F.greatest(s["w0"] * s["w0"] + 2 * r * s["slope"], F.lit(0.0)))
    return F.when(r <= 0, s["t0"]).otherwise(s["t0"] + 2 * r / (s["w0"] + root))


def source_targets(sizes: DataFrame, schedules: Callable[[Column], Column], budget: float = 1.0,
                   max_repeat: int = 3) -> DataFrame:
    """``(skey, source, source_size)`` -> the same with weight, schedule and target.

    Sharing the excess again and again ends where target = least(limit, rate * weight) for one common rate; sources
    ordered by limit / weight reach their limit first, so the rate is the first one that the next source can follow.
    The windows run over one row per source.
    """
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    s = sizes.withColumn("rank", F.row_number().over(by_name) - 1).withColumn("knots", schedules(F.col("rank")))
    s = s.withColumn("segments", _segments(F.col("knots")))
    s = s.withColumn("weight", F.aggregate("segments", F.lit(0.0), lambda acc, x: acc + x["area"]))
    s = s.withColumn("pieces", _with_starts(F.col("segments")))
    s = s.withColumn("cap", F.col("source_size") * max_repeat).withColumn("reach", F.col("cap") / F.col("weight"))
    order = W.orderBy("reach", "rank")
    everything = W.partitionBy()
    before = F.coalesce(F.sum("cap").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    left = F.sum("weight").over(order.rowsBetween(0, W.unboundedFollowing))
    s = s.withColumn("rate", (budget * F.sum("source_size").over(everything) - before) / left)
    rate = F.min(F.when(F.col("rate") <= F.col("reach"), F.struct("reach", "rank", "rate"))).over(everything)["rate"]
    s = s.withColumn("target", F.coalesce(F.least(F.col("cap").cast("double"), rate * F.col("weight")), F.col("cap").cast("double")))
    return s.select("skey", "source_size", "weight", "pieces", "target")


def curriculum(docs: DataFrame, schedules: Callable[[Column], Column] = ramps, id_col: str = "doc_id",
               text_col: str = "text", source_col: str = "source", budget: float = 1.0, max_repeat: int = 3,
               carry: bool = False) -> DataFrame:
    """One row per document: id, size, source_size, target, taken, positions (of each copy, ascending) and, with
    ``carry``, the whole input row as the struct ``row``.

    The table is read twice: for the sizes per source and hash range, then for the documents. The running sum within
    a source is a sum over hash ranges plus one within the range; no window holds a whole source.
    """
    source = F.col(source_col)
    sized = docs.select(
        F.col(id_col).alias(id_col), source.alias("source"), word_count(F.col(text_col)).alias("size"),
        F.coalesce(F.concat(F.lit("s"), source.cast("string")), F.lit("n")).alias("skey"),
        F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")).alias("place"),
        *([F.struct("*").alias("row")] if carry else []),
    ).withColumn("part", F.substring("place", 1, HEX_DIGITS))
    parts = sized.groupBy("skey", "source", "part").agg(F.sum("size").alias("part_size"))
    sizes = parts.groupBy("skey", "source").agg(F.sum("part_size").alias("source_size"))
    targets = source_targets(sizes, schedules, budget, max_repeat)
    ahead = W.partitionBy("skey").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    starts = parts.select("skey", "part", F.coalesce(F.sum("part_size").over(ahead), F.lit(0)).alias("start"))
    line = W.partitionBy("skey", "part").orderBy("place", id_col, "size").rowsBetween(W.unboundedPreceding, -1)
    placed = (
        sized.withColumn("inner", F.coalesce(F.sum("size").over(line), F.lit(0)))
        .join(starts, ["skey", "part"]).join(targets, "skey")
        .withColumn("offset", F.col("start") + F.col("inner"))
    )
    goal = F.round("target").cast("long")
    whole = F.when(F.col("source_size") > 0, F.floor(goal / F.col("source_size"))).otherwise(0).cast("long")
    placed = placed.withColumn("whole", whole).withColumn("rest", goal - F.col("whole") * F.col("source_size"))
    part = F.least(F.greatest(F.col("rest") - F.col("offset"), F.lit(0)), F.col("size"))
    placed = placed.withColumn("taken", F.col("whole") * F.col("size") + part)
    copies = F.when(F.col("size") > 0, F.col("whole") + F.when(part > 0, 1).otherwise(0)).otherwise(0).cast("int")
    positions = F.when(copies > 0, F.transform(
        F.sequence(F.lit(0), F.greatest(copies - 1, F.lit(0))),
        lambda j: F.round(_inverse(F.col("pieces"), F.col("weight") * (j * F.col("source_size") + F.col("offset")) / F.col("target")), 9),
    )).otherwise(F.array().cast("array<double>"))
    return placed.select(id_col, "size", "source_size", "target", "taken", positions.alias("positions"), *(["row"] if carry else []))


def training_order(mixed: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row per copy that fits whole (the boundary copy when at least half of it is taken), range-sorted by
    training position. Needs ``carry=True``; returns the columns of the input documents."""
    copies = F.when(F.col("size") > 0, F.round(F.col("taken") / F.col("size"))).otherwise(0).cast("int")
    kept = F.slice("positions", F.lit(1), copies)
    return (
        mixed.select("row", F.explode(kept).alias("position")).orderBy("position", F.col(f"row.{id_col}"))
        .select("row.*")
    )
