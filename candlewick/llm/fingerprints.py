"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests (operator 3, DataFrame functions only).

A text's paragraphs are its lines, cut into pieces of at most ``PIECE`` characters; the first ``HEAD`` characters are cut
into pieces of ``FINE``, so that texts of one line have several. A sketch has three tables of ``size`` cells; each distinct
paragraph digest is added to one cell of each table, chosen by other bits of it. A cell holds how many digests it has,
their exclusive or, and that of a second hash of them. The fingerprint is the sketch of size ``BASE`` as hex digits.

Two versions are compared by subtracting their sketches cell by cell, so that what they share cancels, and peeling: a
cell with one digest left (its second hash tells) names it and its side; taking it out of its other cells frees more.
When cells are left over, the comparison is retried with larger sketches: first of a size that fits all paragraphs of
both, then four times that, then sixteen times; a comparison that still fails (two digests alike in every cell) uses the
digests themselves. The likeness of two versions is the Jaccard index of their digest sets, from the recovered ones.

Defined results: a null text is an empty text; an empty text has no paragraphs, and two such are alike (1.0); a
paragraph that repeats in a text counts once; equal texts have equal fingerprints; documents with the same id follow each
other by a hash of their text; a null id comes before all others; the next of the last document is the first, in a table
of one row the row itself; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

HEAD, FINE, PIECE = 120, 20, 1000
#: Cells per table of the fingerprint itself.
BASE = 4
#: Rows per range of ids in which each document meets the next one; ranges per level at most.
RANGE_ROWS, MOST_RANGES = 2000, 1000
ROUNDS = 24


def digests(text: Column) -> Column:
    """Sorted distinct digests of the paragraphs."""
    head = F.regexp_extract_all(F.substring(text, 1, HEAD), F.lit(f"(?s).{{1,{FINE}}}"), F.lit(0))
    rest = F.regexp_extract_all(F.substring(text, F.lit(HEAD + 1), F.length(text)),
                                F.lit(rf"[^\n]{{1,{PIECE}}}"), F.lit(0))
    return F.array_sort(F.array_distinct(F.transform(F.concat(head, rest), lambda p: F.xxhash64(p))))


def _items(ds: Column, size: Column) -> Column:
    """Digests with their second hash and the three cells that each belongs to."""
    place = lambda h, t: (F.pmod(F.shiftright(h, 20 * t), size) + t * size).cast("int")
    return F.transform(ds, lambda h: F.struct(
        h.alias("h"), F.xxhash64(h).alias("check"), place(h, 0).alias("p0"), place(h, 1).alias("p1"), place(h, 2).alias("p2")))


def _cell(place: Column, count: Column, key: Column, check: Column) -> Column:
    return F.struct(place.cast("int").alias("place"), count.cast("int").alias("count"), key.cast("long").alias("key"), check.cast("long").alias("check"))


def sketch(ds: Column, size: Column) -> Column:
    """The cells of the three tables, in order of place."""
    def table(items, t):
        def cell(j):
            return F.aggregate(F.filter(items, lambda d: d[f"p{t}"] == j), _cell(j, F.lit(0), F.lit(0), F.lit(0)), lambda acc, d: _cell(
                j, acc["count"] + 1, acc["key"].bitwiseXOR(d["h"]), acc["check"].bitwiseXOR(d["check"])))
        return F.transform(F.sequence((t * size).cast("int"), ((t + 1) * size - 1).cast("int")), cell)

    # the array around the items makes them a variable, computed once and not for every cell
    return F.transform(F.array(_items(ds, size)), lambda items: F.concat(table(items, 0), table(items, 1), table(items, 2)))[0]


def subtract(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: _cell(x["place"], x["count"] - y["count"], x["key"].bitwiseXOR(y["key"]), x["check"].bitwiseXOR(y["check"])))


def peel(cells: Column, size: Column) -> Column:
    """A subtracted sketch -> struct(whole, found): the digests with their sides (1: only in the first version, -1: only
    in the second), and whether nothing is left."""
    def filled(c):
        return (c["count"] != 0) | (c["key"] != 0) | (c["check"] != 0)

    def without(cells, pure):
        def rest(c):
            own = F.filter(pure, lambda p: (p["p0"] == c["place"]) | (p["p1"] == c["place"]) | (p["p2"] == c["place"]))
            return F.aggregate(own, c, lambda acc, p: _cell(
                acc["place"], acc["count"] - p["side"], acc["key"].bitwiseXOR(p["h"]), acc["check"].bitwiseXOR(p["check"])))
        return F.filter(F.transform(cells, rest), filled)

    def one_round(state, _):
        single = F.filter(state["cells"], lambda c: (F.abs(c["count"]) == 1) & (F.xxhash64(c["key"]) == c["check"]))
        place = lambda h, t: (F.pmod(F.shiftright(h, 20 * t), size) + t * size).cast("int")
        now = F.array_distinct(F.transform(single, lambda c: F.struct(  # a digest that shows twice is taken out once
            c["key"].alias("h"), c["check"].alias("check"), c["count"].alias("side"),
            place(c["key"], 0).alias("p0"), place(c["key"], 1).alias("p1"), place(c["key"], 2).alias("p2"))))
        step = F.transform(F.array(now), lambda p: F.struct(
            without(state["cells"], p).alias("cells"),
            F.concat(state["found"], F.transform(p, lambda d: F.struct(d["h"].alias("h"), d["side"].alias("side")))).alias("found"),
            (F.size(p) > 0).alias("live")))
        return F.when(~state["live"], state).otherwise(step[0])

    start = F.struct(F.filter(cells, filled).alias("cells"), F.array().cast("array<struct<h:long,side:int>>").alias("found"), F.lit(True).alias("live"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, one_round, lambda s: F.struct(
        (F.size(s["cells"]) == 0).alias("whole"), s["found"].alias("found")))


def _attempt(df: DataFrame, a: str, b: str, size: Column, into: str, only_if: Column) -> DataFrame:
    """Adds ``into``: peel of the difference of two digest arrays with sketches of ``size``, where ``only_if``."""
    made = peel(subtract(sketch(F.col(a), size), sketch(F.col(b), size)), size)
    return df.withColumn(into, F.when(only_if, made))


def with_difference(df: DataFrame, a: str, b: str, into: str, first_a: str | None = None, first_b: str | None = None) -> DataFrame:
    """Adds ``into``: array of (h, side), the paragraph digests in which the versions with digest arrays ``a`` and ``b``
    differ; ``first_a`` and ``first_b`` name columns with their sketches of size BASE, where these are there."""
    base = F.lit(BASE).cast("long")
    one = subtract(F.col(first_a) if first_a else sketch(F.col(a), base), F.col(first_b) if first_b else sketch(F.col(b), base))
    df = df.withColumn("_try0", peel(one, base))
    both = F.size(a) + F.size(b)
    fitting = F.greatest(F.lit(2 * BASE).cast("long"), F.ceil(both * 0.6).cast("long"))
    df = df.withColumn("_size", fitting)
    for k, factor in ((1, 1), (2, 4), (3, 16)):
        df = _attempt(df, a, b, F.col("_size") * factor, f"_try{k}", ~F.coalesce(*[F.col(f"_try{j}.whole") for j in reversed(range(k))]))
    side = lambda d, s: F.transform(d, lambda h: F.struct(h.alias("h"), F.lit(s).alias("side")))
    exact = F.concat(side(F.array_except(a, b), 1), side(F.array_except(b, a), -1))
    tries = [F.when(F.col(f"_try{k}.whole"), F.col(f"_try{k}.found")) for k in range(4)]
    return df.withColumn(into, F.coalesce(*tries, exact)).drop("_size", *[f"_try{k}" for k in range(4)])


def likeness(difference: Column, a: Column, b: Column) -> Column:
    both, apart = F.size(a) + F.size(b), F.size(difference)
    return F.when(both == 0, 1.0).otherwise((both - apart) / (both + apart))


def as_text(cells: Column) -> Column:
    digits = lambda v, n: F.lpad(F.hex(v), n, "0")
    return F.array_join(F.transform(cells, lambda c: F.concat(digits(c["count"].cast("long"), 4), digits(c["key"], 16), digits(c["check"], 16))), "")


def _ranges(ids: DataFrame, rows: int) -> tuple[list, DataFrame, int]:
    """Bounds of ranges of ids on two levels, both from quantiles of all ids: a list, and a table with a list per first
    range (at most MOST_RANGES lists of at most MOST_RANGES bounds)."""
    per_level = min(MOST_RANGES, max(1, round((rows / RANGE_ROWS) ** 0.5)))
    cuts = F.array(*[F.lit(i / per_level) for i in range(1, per_level)]) if per_level > 1 else None
    if cuts is None:
        return [], ids.limit(0).select(F.lit(0).alias("r1"), F.array(F.lit(0)).cast("array<long>").alias("inner")), 1
    outer = ids.agg(F.percentile_approx("id", cuts, F.lit(10 * per_level)).alias("b")).first()["b"]
    inner = ids.select(_range_of(F.col("id"), outer).alias("r1"), "id").groupBy("r1").agg(F.percentile_approx("id", cuts, F.lit(10 * per_level)).alias("inner"))
    return outer, inner, per_level


def _range_of(id_: Column, bounds: list) -> Column:
    return F.size(F.filter(F.array(*[F.lit(b) for b in bounds]).cast("array<long>"), lambda b: F.coalesce(id_ >= b, F.lit(False)))) if bounds else F.lit(0)


def with_next(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(id, text, ds, next_text, next_ds)``: each document with the next by id, both with their digests.

    Documents meet the next one inside ranges of ids; the first document of a range is also sent to the range before
    it. The text is shuffled once, and no task sees more than a range."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    ids = rows.select("id", F.xxhash64("text").alias("h"))
    total = ids.count()
    outer, inner, _ = _ranges(ids, total)

    def ranged(df):
        df = df.withColumn("r1", _range_of(F.col("id"), outer))
        df = df.join(F.broadcast(inner), "r1", "left")
        r2 = F.size(F.filter(F.coalesce("inner", F.array().cast("array<long>")), lambda b: F.coalesce(F.col("id") >= b, F.lit(False))))
        return df.withColumn("r", F.col("r1").cast("long") * (MOST_RANGES + 1) + r2).drop("r1", "inner")

    firsts = ranged(ids).groupBy("r").agg(F.min(F.struct(F.col("id").isNotNull().alias("has"), "id", "h")).alias("first"))
    around = W.orderBy("r")  # one row per range
    everything = W.partitionBy()
    firsts = firsts.select("r", F.col("first.id").alias("first_id"), F.col("first.h").alias("first_h"),
                           F.coalesce(F.lag("r").over(around), F.max("r").over(everything)).alias("before"))
    # a row of four numbers per range, of which there are at most (MOST_RANGES + 1)^2
    sent = ranged(rows.withColumn("h", F.xxhash64("text"))).join(F.broadcast(firsts), "r")
    is_first = F.col("id").eqNullSafe(F.col("first_id")) & (F.col("h") == F.col("first_h"))
    targets = F.array(F.struct(F.col("r").alias("to"), F.lit(False).alias("extra")), F.when(is_first, F.struct(F.col("before").alias("to"), F.lit(True).alias("extra"))))
    sent = sent.withColumn("ds", digests(F.col("text"))).select("id", "h", "text", "ds", F.explode(F.filter(targets, lambda t: t.isNotNull())).alias("t"))
    following = W.partitionBy("t.to").orderBy("t.extra", F.col("id").asc_nulls_first(), "h")
    return (
        sent.withColumn("next", F.lead(F.struct("text", "ds")).over(following)).where(~F.col("t.extra"))
        .select("id", "text", "ds", F.col("next.text").alias("next_text"), F.col("next.ds").alias("next_ds"))
    )


def fingerprint(text: Column) -> Column:
    return as_text(sketch(digests(text), F.lit(BASE).cast("long")))


def compare_with_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_chars, the edited text (its last half replaced by the beginning of the next document)
    as sha256, both fingerprints, and the likeness of the document to its edited text and to the next document."""
    df = with_next(docs, id_col, text_col)
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    df = df.withColumn("edited", F.concat(F.substring("text", F.lit(1), n - half), F.substring("next_text", F.lit(1), half)))
    df = df.select("id", n.cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"), "ds", digests(F.col("edited")).alias("edited_ds"), "next_ds")
    base = F.lit(BASE).cast("long")
    for name in ("ds", "edited_ds", "next_ds"):
        df = df.withColumn(f"{name}_cells", sketch(F.col(name), base))
    df = with_difference(df, "ds", "edited_ds", "to_edited", "ds_cells", "edited_ds_cells")
    df = with_difference(df, "ds", "next_ds", "to_next", "ds_cells", "next_ds_cells")
    return df.select(
        F.col("id").alias(id_col), "n_chars", "edited_sha256", as_text(F.col("ds_cells")).alias("fingerprint"),
        as_text(F.col("edited_ds_cells")).alias("edited_fingerprint"),
        likeness(F.col("to_edited"), F.col("ds"), F.col("edited_ds")).alias("near_edited"),
        likeness(F.col("to_next"), F.col("ds"), F.col("next_ds")).alias("near_next"))
