"""N-gram Jaccard join in the metric space of shingle sets (operator 2).

Jaccard distance is a metric, but nearly all documents are at distance 1 from any document taken as a pivot, so Voronoi
regions of document pivots alone would leave a corpus in one region. The join therefore divides twice:

1. Pivots in projections. The universe of shingles is dealt into m classes by hash. Sets within the threshold differ in
   at most D shingles, a bound that follows from their sizes; with m > D classes their projections on at least one class
   coincide, so they are at distance 0 from the same pivot there (the projection itself), and by the triangle
   inequality no window beyond distance 0 is needed. Sizes are cut into intervals such that partners lie in the same or
   the next one; a document on the border of two is replicated into both. A region is (interval, class, projection).
   Empty projections say nothing; m has room for the usual number of them, and only sets with more send them as well.
2. Document pivots in regions. The first member of a region is its first pivot: members within the threshold of it are
   linked to it and to each other's component. Regions whose other members then still belong to several components go
   on. Large ones take more pivots, in turns: a pivot meets every member of another component unless their sizes, the
   triangle inequality over the first pivot, or their shingle counts per class rule a link out, and then leaves. When
   that no longer shrinks them, they are divided by document pivots: every member goes to its nearest pivot's Voronoi
   region and, where the triangle inequality allows a partner there (distance at most the least one plus twice the
   threshold), is replicated into others, and these are joined in the same way, as long as it halves the pairs. What is
   left are mostly near misses at like distances, which no pivot tells apart. They are compared pair by pair, under the
   same exclusions, each pair in one of the regions that both are in.

Every link is decided on the whole sets, and no pair within the threshold is lost: each such pair either shares a region
and is compared, or is already connected. Only connected components are returned, so copies need not be paired.

A document's set is identified by a 64-bit hash of it and shingles by 64-bit hashes; sets of equal hash are one set.
Equal sets are one member, however many documents have them; a task sends a set once.

Defined results: a null text, an empty one and one without words have no shingles and are linked with nothing; fewer
words than a shingle has make one shingle; a null id is never the smallest of its component unless all ids are null;
rows with the same id are compared by their texts; an empty table gives an empty table.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from candlewick.llm import chars
from candlewick.llm.common import id_filter, maybe_in, ship, stored
from candlewick.llm.exact_dedup import located

#: Characters per piece of work in a task; sets remembered as sent by a task.
PIECE, SEEN = 1_000_000, 500_000
#: Members of a region that is compared at once; pivots per turn of a larger one; levels of Voronoi regions.
LEAF, PIVOTS, LEVELS = 48, 8, 8
#: Members of a region whose distances to its pivots tell whether these divide it.
TRIAL = 32
#: Smallest regions by which a pair is known to meet before.
FIRST = 16
#: Classes of the counts that bound what two sets share.
COUNTED, COARSE = 256, 16


# -- shingle sets (numpy, in tasks) -----------------------------------------------------------------------------------

def _mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def _cut_at_blank(text: str) -> list[str]:
    pieces, at = [], 0
    while len(text) - at > PIECE:
        end = max(text.rfind(c, at, at + PIECE) for c in chars.BLANKS)
        if end <= at:
            end = min((e for e in (text.find(c, at + PIECE) for c in chars.BLANKS) if e >= 0), default=len(text))
        pieces.append(text[at:end])
        at = end
    return [*pieces, text[at:]]


def _word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, A-Z lower-cased, and the number of words of each."""
    joined = "\n".join(texts)
    codes = chars.codes_of(joined)
    upper = (codes >= 65) & (codes <= 90)
    codes = codes + np.where(upper, np.uint32(32), np.uint32(0))
    starts, _, hashes = chars.words_of(codes, chars.classes_of(codes))
    begin = np.cumsum([0] + [len(t) + 1 for t in texts])
    edge = np.searchsorted(starts, begin)
    return _mix(hashes), edge[1:] - edge[:-1]


def shingle_sets(texts: list[str], words: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    sets: list[np.ndarray] = []
    for run in chars.batches(texts, PIECE):
        if len(run) == 1 and len(run[0]) > PIECE:
            h = np.concatenate([_word_hashes([p])[0] for p in _cut_at_blank(run[0])])
            counts = np.array([len(h)])
        else:
            h, counts = _word_hashes(run)
        at = 0
        rolled = np.zeros(max(len(h) - words + 1, 0), np.uint64)
        for j in range(words):
            rolled = _mix(rolled * np.uint64(31) + h[j : j + len(rolled)])
        for n in counts.tolist():
            if n >= words:
                sets.append(np.unique(rolled[at : at + n - words + 1]))
            elif n:
                one = np.array([n], np.uint64)  # no shingle starts from a number of words
                for j in range(n):
                    one = _mix(one * np.uint64(31) + h[at + j])
                sets.append(one)
            else:
                sets.append(np.zeros(0, np.uint64))
            at += n
    return sets


def _signature(s: np.ndarray) -> int:
    """64-bit hash of a set, as a signed number."""
    total = np.add.reduce(_mix(s + np.uint64(0x9E3779B97F4A7C15)), dtype=np.uint64)
    return int(_mix(np.array([total ^ np.uint64(len(s))], np.uint64)).astype(np.int64)[0])


class Intervals:
    """Size intervals, and per interval the number of classes and of empty projections that it has room for."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den  # the threshold as a fraction
        self.first = [1]
        self.classes: list[int] = []
        self.room: list[int] = []

    def of(self, n: int) -> int:
        while self.first[-1] <= n:
            low = self.first[-1]
            behind = low * self.den // self.num + 1  # the first size that is no partner of low
            self.first.append(behind)
            largest = behind - 1
            differences = largest * (self.den - self.num) // self.num
            room = 0
            for _ in range(20):  # the usual number of empty projections of the smallest set, and a little more
                z = (differences + 1 + room) * math.exp(-low / (differences + 1 + room)) if differences else 0.0
                more = math.ceil(z + 2 * math.sqrt(z)) if z > 0.01 else 0
                if more <= room:
                    break
                room = min(more, differences)
            self.classes.append(differences + 1 + room)
            self.room.append(room)
        return int(np.searchsorted(self.first, n, side="right")) - 1


def _regions(s: np.ndarray, intervals: Intervals) -> np.ndarray:
    """Keys of the regions of a set: in its own size interval, and in the one below as a larger partner."""
    keys = []
    own = intervals.of(len(s))
    mixed = _mix(s ^ np.uint64(0xA5A5A5A5A5A5A5A5))
    for k in (own, own - 1):
        if k < 0 or (k < own and len(s) > (intervals.first[k + 1] - 1) * intervals.den // intervals.num):
            continue
        m = intervals.classes[k]
        label = (s >> np.uint64(20)) % np.uint64(m)
        content, filled = np.zeros(m, np.uint64), np.zeros(m, bool)
        np.add.at(content, label, mixed)
        filled[label] = True
        places = np.arange(m, dtype=np.uint64)
        key = _mix(content ^ _mix(places + (np.uint64(k + 1) << np.uint64(40))))
        keys.append(key if m - int(filled.sum()) > intervals.room[k] else key[filled])
    return np.concatenate(keys).astype(np.int64)


# -- Spark -------------------------------------------------------------------------------------------------------------

def signatures(docs: DataFrame, words: int, id_col: str, text_col: str, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: id, sig, n, and the columns to carry."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = shingle_sets([t or "" for t in batch.column(1).to_pylist()], words)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([_signature(s) for s in sets], pa.int64()), pa.array([len(s) for s in sets], pa.int64()),
                 *[batch.column(2 + k) for k in range(len(carry))]], names=["id", "sig", "n", *carry])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), *carry)
    kinds = "".join(f", {c} {rows.schema[c].dataType.simpleString()}" for c in carry)
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, sig long, n long{kinds}")


def region_rows(docs: DataFrame, words: int, num: int, den: int, text_col: str) -> DataFrame:
    """``(key, sig, n)``: a row per region of each set; a task sends a set once (as far as it remembers)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        intervals, seen = Intervals(num, den), set()
        for batch in batches:
            texts = [t or "" for t in batch.column(0).to_pylist()]
            for part in chars.batches(texts, PIECE):
                keys, sigs, sizes, counts = [], [], [], []
                for s in shingle_sets(part, words):
                    if len(s) and (sig := _signature(s)) not in seen:
                        seen.add(sig)
                        keys.append(_regions(s, intervals))
                        sigs.append(sig)
                        sizes.append(len(s))
                        counts.append(len(keys[-1]))
                if len(seen) > SEEN:
                    seen.clear()
                if keys:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(keys)), pa.array(np.repeat(np.array(sigs, np.int64), counts)),
                         pa.array(np.repeat(np.array(sizes, np.int32), counts))], names=["key", "sig", "n"])

    return docs.select(text_col).mapInArrow(run, "key long, sig long, n int")


def _counts(s: np.ndarray) -> list[int] | None:
    """Shingles per class of COUNTED classes: the sum of the smaller counts of two sets bounds what they share. None
    where a count doesn't fit, and then nothing is known."""
    c = np.bincount(((s >> np.uint64(7)) % np.uint64(COUNTED)).astype(np.int64), minlength=COUNTED)
    return c.tolist() if c.max(initial=0) < 2**15 else None


def full_sets(docs: DataFrame, words: int, text_col: str) -> DataFrame:
    """``(sig, shingles, counts)`` of each row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chars.batches([t or "" for t in batch.column(0).to_pylist()], PIECE):
                sets = shingle_sets(part, words)
                offsets = np.cumsum([0] + [len(s) for s in sets]).astype(np.int32)
                flat = np.concatenate([*sets, np.zeros(0, np.uint64)]).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([_signature(s) for s in sets], pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
                     pa.array([_counts(s) for s in sets], pa.list_(pa.int16()))], names=["sig", "shingles", "counts"])

    return docs.select(text_col).mapInArrow(run, "sig long, shingles array<long>, counts array<short>")


def with_overlap(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``pairs`` (a, b, ...) with na, nb and shared, counted on the whole sets."""
    a = sets.select(F.col("sig").alias("a"), F.col("shingles").alias("sa"))
    b = sets.select(F.col("sig").alias("b"), F.col("shingles").alias("sb"))
    both = pairs.join(a, "a").join(b, "b")
    return both.withColumn("na", F.size("sa")).withColumn("nb", F.size("sb")).withColumn(
        "shared", F.size(F.array_intersect("sa", "sb"))).drop("sa", "sb")


def _is_link(num: int, den: int):
    return den * F.col("shared") >= num * (F.col("na") + F.col("nb") - F.col("shared"))


def components(links: DataFrame) -> DataFrame:
    """``(a, b)`` links -> ``(sig, comp)``, comp the smallest sig of the component: alternating large and small stars
    until nothing changes; each step's edges are written, and only a count and a checksum come to the driver."""
    def oriented(e):
        return e.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))

    edges = stored(oriented(links).distinct(), "edges")
    before = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        large = oriented(large).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).union(low.select(F.col("u").alias("a"), F.col("m").alias("b")))
        edges = stored(oriented(small).distinct(), "edges")
        now = edges.agg(F.count(F.lit(1)), F.coalesce(F.bit_xor(F.xxhash64("u", "v")), F.lit(0))).first()
        if now == before:
            return edges.select(F.col("u").alias("sig"), F.col("v").alias("comp"))
        before = now


def _distance():
    return 1 - F.col("shared") / (F.col("na") + F.col("nb") - F.col("shared"))


def _open_regions(members: DataFrame, labels: DataFrame, sets: DataFrame) -> DataFrame:
    """``(key, sig, n, d)`` -> with comp, counts and size, only regions whose members belong to several components, and
    of regions with the same members one."""
    named = members.join(labels, "sig", "left").withColumn("comp", F.coalesce("comp", "sig"))
    several = (
        named.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.min("comp").alias("lo"), F.max("comp").alias("hi"),
                                 F.bit_xor(F.xxhash64("sig")).alias("x"), F.sum(F.hash("sig").cast("long")).alias("s"))
        .where("lo <> hi").groupBy("size", "x", "s").agg(F.min("key").alias("key")).select("key", "size")
    )
    coarse = [F.aggregate(F.slice("counts", 1 + i * COUNTED // COARSE, COUNTED // COARSE), F.lit(0), lambda acc, x: acc + x).alias(f"k{i}")
              for i in range(COARSE)]
    return named.join(several, "key").join(sets.select("sig", "counts", *coarse), "sig")


def _possible(members: DataFrame, others: DataFrame, num: int, den: int, which=None, once: bool = False) -> DataFrame:
    """Pairs of members of a region that may be links: of different components, and not excluded by their sizes, by the
    triangle inequality over the region's pivot (``d``: the distance to it), or by the bound of their counts; with
    ``once`` only in the region with the smallest key that ``keys`` of both hold."""
    columns = ["sig", "n", "comp", "d", "counts", *[f"k{i}" for i in range(COARSE)], *(["keys"] if once else [])]
    side = lambda df, x: df.select("key", *[F.col(c).alias(f"{c}{x}") for c in columns])
    na, nb = F.col("na"), F.col("nb")
    sizes = (na * den >= nb * num) & (nb * den >= na * num)
    window = F.abs(F.col("da") - F.col("db")) <= (1 - num / den) + 1e-9
    # the same bound over few classes first: it is compiled, and rules most pairs out
    few = sum((F.least(F.col(f"k{i}a"), F.col(f"k{i}b")) for i in range(1, COARSE)), F.least(F.col("k0a"), F.col("k0b")))
    maybe = F.coalesce((num + den) * few >= num * (na + nb), F.lit(True))
    most = F.aggregate(F.zip_with("countsa", "countsb", lambda x, y: F.least(x, y)), F.lit(0), lambda acc, x: acc + x)
    shared = F.coalesce((num + den) * most >= num * (na + nb), F.lit(True))
    may = (F.col("compa") != F.col("compb")) & sizes & window & maybe & shared
    if which is not None:
        may = which & may
    if once:
        may = may & F.coalesce(F.array_min(F.array_intersect("keysa", "keysb")) == F.col("key"), F.lit(True))
    return side(members, "a").join(side(others, "b"), "key").where(may)


def _leaf_pairs(leaf: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs of members of a region that may be links, each in one region: of the regions that both are in, that with
    the smallest key. It is known from the FIRST smallest keys of each, if these have one in common; if not, the pair
    may turn up in several regions."""
    own = leaf.groupBy("sig").agg(F.slice(F.sort_array(F.collect_set("key")), 1, FIRST).alias("keys"))
    pairs = _possible(leaf.join(own, "sig"), leaf.join(own, "sig"), num, den, F.col("siga") < F.col("sigb"), once=True)
    return pairs.select(F.col("siga").alias("a"), F.col("sigb").alias("b")).distinct()


def _merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Components after more links."""
    return components(labels.select(F.col("sig").alias("a"), F.col("comp").alias("b")).union(links))


def _relabelled(regions: DataFrame, labels: DataFrame, sets: DataFrame) -> DataFrame:
    return stored(_open_regions(regions.select("key", "sig", "n", "d"), labels, sets), "open")


def _chosen(regions: DataFrame, most: int, turn: int) -> DataFrame:
    """At most ``most`` members of each region, by a hash that changes with the turn."""
    by_hash = W.partitionBy("key").orderBy(F.xxhash64("key", "sig", F.lit(turn)), "sig")
    return regions.withColumn("r", F.row_number().over(by_hash)).where(F.col("r") <= most).drop("r")


def _voronoi(big: DataFrame, members: DataFrame, sets: DataFrame, num: int, den: int, pivots: int, level: int) -> tuple[DataFrame, DataFrame]:
    """(placed, links): the given members of the regions in the Voronoi regions of document pivots, with the distance to
    the pivot; a member is replicated into every region that the triangle inequality leaves open to a partner."""
    centres = _chosen(big, pivots, -1 - level).select("key", F.col("sig").alias("a"))
    pairs = members.select("key", F.col("sig").alias("b"), "n").join(centres, "key")
    apart = stored(with_overlap(pairs.select("a", "b").distinct(), sets).withColumn("d", _distance()), "distances")
    reach = pairs.join(apart.select("a", "b", "d"), ["a", "b"])
    nearest = reach.groupBy("key", "b").agg(F.min("d").alias("least"))
    placed = reach.join(nearest, ["key", "b"]).where(F.col("d") <= F.col("least") + 2 * (1 - num / den) + 1e-9)
    placed = placed.select(F.col("key").alias("parent"), F.xxhash64("key", "a").alias("key"), F.col("b").alias("sig"), "n", "d")
    links = apart.where(_is_link(num, den) & (F.col("a") != F.col("b"))).select("a", "b")
    return stored(placed, "placed"), links


def _divided(placed: DataFrame, pivots: int) -> DataFrame:
    """Keys of the regions whose Voronoi regions together leave at most half the pairs to compare."""
    parts = placed.groupBy("parent", "key").agg(F.count(F.lit(1)).alias("c")).groupBy("parent").agg(F.sum(F.col("c") * F.col("c")).alias("work"))
    sizes = placed.groupBy("parent").agg(F.count_distinct("sig").alias("size"))
    return parts.join(sizes, "parent").where(2 * F.col("work") <= F.col("size") * F.col("size")).select("parent")


def named_components(docs: DataFrame, words: int = 5, num: int = 8, den: int = 10, id_col: str = "doc_id", text_col: str = "text",
                     leaf: int = LEAF, pivots: int = PIVOTS, levels: int = LEVELS, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: id, sig, n, comp (null without shingles), and the columns to carry; documents link where
    shared / union >= num / den."""
    ship(docs.sparkSession)
    sigs = stored(signatures(docs, words, id_col, text_col, carry), "signatures")
    # regions: streams through the sorted rows of a key; a member that isn't the first meets the first as its pivot
    order = W.partitionBy("key").orderBy("sig")
    rows = region_rows(docs, words, num, den, text_col)
    met = (
        rows.withColumn("pivot", F.first("sig").over(order.rowsBetween(W.unboundedPreceding, 0)))
        .withColumn("before", F.lag("sig").over(order)).where("sig <> pivot AND sig <> before").drop("before")
    )
    met = stored(met, "regions")  # (key, sig, n, pivot): regions with at least two sets, without their first one
    involved = stored(met.select("sig").union(met.select("pivot")).distinct(), "involved")

    # the whole sets of those, from the documents that have them
    holders = sigs.join(involved, "sig", "left_semi").groupBy("sig").agg(F.min(F.xxhash64("id")).alias("h")).select("h")
    texts = maybe_in(docs.select(id_col, text_col), F.xxhash64(id_col), id_filter(holders, "h"))
    sets = stored(full_sets(texts, words, text_col).join(involved, "sig", "left_semi").dropDuplicates(["sig"]), "sets")

    link = _is_link(num, den)
    tested = stored(with_overlap(met.select(F.col("pivot").alias("a"), F.col("sig").alias("b")).distinct(), sets), "tested")
    labels = components(tested.where(link).select("a", "b"))

    # the first pivot has met every member: it leaves the region, with the distances to it staying behind
    from_pivot = tested.select(F.col("a").alias("pivot"), F.col("b").alias("sig"), _distance().alias("d"))
    members = met.join(from_pivot, ["pivot", "sig"]).select("key", "sig", "n", "d")
    todo = _relabelled(members, labels, sets)

    # large regions: more pivots, each of which leaves once it has met all members that may be its partners
    turn, rows = 0, todo.where(F.col("size") > leaf).count()
    while rows:
        big = todo.where(F.col("size") > leaf)
        centres = stored(_chosen(big, pivots, turn), "centres")
        pairs = _possible(centres, big, num, den).select(F.col("siga").alias("a"), F.col("sigb").alias("b")).distinct()
        more = stored(with_overlap(pairs, sets).where(link).select("a", "b"), "links")
        barren = more.isEmpty()
        labels = labels if barren else _merged(labels, more)
        todo = _relabelled(todo.join(centres.select("key", "sig"), ["key", "sig"], "left_anti"), labels, sets)
        turn, before, rows = turn + 1, rows, todo.where(F.col("size") > leaf).count()
        if barren or 10 * rows > 9 * before:
            break
    for level in range(levels):
        big = todo.where(F.col("size") > leaf)
        if big.isEmpty():
            break
        # do pivots divide them? A few members of each tell; all members of those that they divide are placed
        trial, links = _voronoi(big, _chosen(big, TRIAL, -100), sets, num, den, pivots, level)
        divided = stored(_divided(trial, pivots).withColumnRenamed("parent", "key"), "divided")
        if divided.isEmpty():
            break
        placed, links = _voronoi(big, big.join(divided, "key", "left_semi"), sets, num, den, pivots, level)
        labels = _merged(labels, links)
        rest = todo.join(divided, "key", "left_anti").select("key", "sig", "n", "d")
        todo = _relabelled(rest.union(placed.select("key", "sig", "n", "d")), labels, sets)
    last = stored(with_overlap(_leaf_pairs(todo, num, den), sets).where(link).select("a", "b"), "links")
    if not last.isEmpty():
        labels = _merged(labels, last)

    return sigs.join(labels, "sig", "left").withColumn("comp", F.when(F.col("n") > 0, F.coalesce("comp", "sig")))


def join(docs: DataFrame, words: int = 5, num: int = 8, den: int = 10, id_col: str = "doc_id", text_col: str = "text",
         leaf: int = LEAF, pivots: int = PIVOTS, levels: int = LEVELS) -> DataFrame:
    """One row per document: id, n_shingles, component_id."""
    named = named_components(docs, words, num, den, id_col, text_col, leaf, pivots, levels)
    smallest = named.where("n > 0").groupBy("comp").agg(F.min("id").alias("smallest"))
    return named.join(smallest, "comp", "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("smallest")).otherwise(F.col("id")).alias("component_id"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row of each component, the first by (id, file, row), null ids last; every row without shingles. Rows are told
    apart by their locator, as an id may occur on several."""
    rows = located(docs)
    flat = rows.select(F.col(f"row.`{id_col}`").alias("id"), F.col(f"row.`{text_col}`").alias("text"), "_file", "_pos")
    named = named_components(flat, id_col="id", text_col="text", carry=("_file", "_pos"), **options).where("n > 0")
    place = F.struct(F.col("id").isNull().alias("last"), "id", "_file", "_pos")
    stays = named.groupBy("comp").agg(F.min(place).alias("stays"))
    gone = named.join(stays, "comp").where((F.col("_file") != F.col("stays._file")) | (F.col("_pos") != F.col("stays._pos")))
    gone = gone.select(F.col("_file").alias("file"), F.col("_pos").alias("pos"))
    return rows.join(gone, (F.col("_file") == F.col("file")) & (F.col("_pos") == F.col("pos")), "left_anti").select("row.*")
