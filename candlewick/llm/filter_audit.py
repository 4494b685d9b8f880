"""Filter interaction audit over radix text tries (operator 13).

Each document gets a mask of the filters that it fails. Four are functions of its text alone; the fifth asks whether a
smaller id has the same text, and is answered by compressed (radix) tries:

1. A task inserts the whole texts it reads into a trie whose terminals hold the least id, and writes one narrow row per
   document and one row per distinct text (a *chunk* of a task's texts at a time, so that memory is bounded). A group of
   copies leaves a task as one text.
2. A text that no other chunk's text equals in its first characters and its length is a leaf of its own, and its
   terminal's id is the least. The others are range-partitioned by adaptive prefixes: a range is a run of neighbouring
   prefixes that holds about ``RANGE`` characters; a prefix that alone holds more is cut again behind the longest prefix
   its texts share. A prefix whose texts are all equal stays whole: it has one row per chunk.
3. Each range's whole texts are inserted into one trie, as they stream in; it is traversed for the least id of each
   terminal. These ids go back to the narrow rows, which gives the duplicate flag.

Masks are then reduced: counts per part and mask are all that the orders of the filters need.

Defined results: a null text is an empty one, a null part the empty string; a null id is no smaller and no larger than
any other; rows with equal id and text are no duplicates of each other; a row of an id with several labels counts as
labelled 1 if any of them is 1; every row counts, repeated ones too; a table without rows has no parts.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import reduce
from itertools import permutations

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from candlewick.llm.common import id_filter, maybe_in, ship, stored

#: The filters, in the order of their bits.
FILTERS = "ABCDE"
MIN_WORDS, DISTINCT_PERCENT, UPPER_PERCENT, SYMBOLS = 50, 65, 5, b"#$%&*|"
_UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Characters of a task's chunk of distinct texts, of a range; first characters that are looked at; what a prefix grows by.
CHUNK, RANGE, HEAD, STEP = 16_000_000, 4_000_000, 64, 2
#: Rows, and about as many characters, of a batch that a task writes.
ROWS, CHARACTERS = 2_000, 4_000_000


class Trie:
    """A compressed trie of whole texts: an edge holds a run of characters, a terminal the least id of its text."""

    def __init__(self):
        self.root: list = ["", {}, -1]  # label, children by first character, terminal
        self.least: list = []  # by terminal
        self.size = 0  # characters

    def insert(self, text: str, ident) -> int:
        """The terminal of a text, which then knows ``ident``."""
        node, at, n = self.root, 0, len(text)
        while at < n:
            child = node[1].get(text[at])
            if child is None:
                child = [text[at:], {}, -1]
                node[1][text[at]] = child
                self.size += n - at
                node, at = child, n
            elif text.startswith(child[0], at):
                node, at = child, at + len(child[0])
            else:
                k = _shared(child[0], text, at)
                middle = [child[0][:k], {child[0][k]: child}, -1]
                child[0] = child[0][k:]
                node[1][text[at]] = middle
                node, at = middle, at + k
        if node[2] < 0:
            node[2] = len(self.least)
            self.least.append(ident)
        elif ident is not None and (self.least[node[2]] is None or ident < self.least[node[2]]):
            self.least[node[2]] = ident
        return node[2]

    def walk(self) -> Iterator[tuple[str, int]]:
        """(text, terminal), in the order of the texts."""
        stack = [("", self.root)]
        while stack:
            before, node = stack.pop()
            text = before + node[0]
            if node[2] >= 0:
                yield text, node[2]
            stack.extend((text, node[1][c]) for c in sorted(node[1], reverse=True))


def _shared(label: str, text: str, at: int) -> int:
    """Length of the longest prefix of ``label`` that stands in ``text`` at ``at``; the whole label doesn't."""
    step = 16
    while step < len(label) and text.startswith(label[:step], at):
        step *= 2
    low, high = step // 2 if step > 16 else 0, min(step, len(label)) - 1
    while low < high:
        k = (low + high + 1) // 2
        low, high = (k, high) if text.startswith(label[:k], at) else (low, k - 1)
    return low


def text_mask(text: str) -> int:
    """Bits of the filters A to D that a text fails."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()  # of bytes: at space and \x09-\x0D only
    mask = len(words) < MIN_WORDS
    mask |= (100 * len(set(words)) < DISTINCT_PERCENT * len(words)) << 1
    mask |= (100 * (len(raw) - len(raw.translate(None, _UPPER))) > UPPER_PERCENT * len(text)) << 2
    return mask | (len(raw.translate(None, SYMBOLS)) < len(raw)) << 3


def _read(kind: pa.DataType):
    """(id, part, text) -> a row per document (mask, chunk, terminal) and, behind a chunk's, one per distinct text."""
    names = ["id", "part", "mask", "chunk", "terminal", "text"]
    types = [kind, pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.string()]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    def texts(trie: Trie, chunk: int) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for text, terminal in trie.walk():
            rows.append((trie.least[terminal], None, -1, chunk, terminal, text))
            size += len(text)
            if len(rows) >= ROWS or size >= CHARACTERS:
                yield batch(rows)
                rows, size = [], 0
        if rows:
            yield batch(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, trie = TaskContext.get().partitionId() << 24, Trie()
        for b in batches:
            for start in range(0, b.num_rows, ROWS):
                part = b.slice(start, ROWS)
                rows = []
                for ident, name, text in zip(*(part.column(k).to_pylist() for k in range(3)), strict=True):
                    text = text or ""
                    rows.append((ident, name or "", text_mask(text), chunk, trie.insert(text, ident), None))
                    if trie.size >= CHUNK:
                        yield batch(rows)
                        yield from texts(trie, chunk)
                        rows, chunk, trie = [], chunk + 1, Trie()
                if rows:
                    yield batch(rows)
        if trie.least:
            yield from texts(trie, chunk)
    return run


def _ranges(texts: DataFrame, most: int) -> DataFrame:
    """``texts`` (chunk, terminal, text) -> (chunk, terminal, range) of those that share their first characters and their
    length with another: no other text is its equal. Texts of a range start alike and hold ``most`` characters together,
    or a little more, or are all equal. Only the first characters are moved: each turn cuts the prefixes that hold more
    behind what all their texts share; those whose first characters are all equal go on with the next ones, twice as many."""
    key = ["chunk", "terminal"]
    first = texts.select(*key, (F.length("text") + 1).cast("long").alias("w"), F.substring("text", 1, HEAD).alias("head"))
    several = first.groupBy("head", "w").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    open_ = stored(first.join(several, ["head", "w"]).withColumns({"range": F.lit(0).cast("long"), "shared": F.lit(0)}), "heads")
    if (open_.agg(F.sum("w")).first()[0] or 0) <= most:
        return open_.select(*key, "range")
    done, waiting, start, length = [], [], 0, HEAD
    while True:
        cut = open_.withColumn("prefix", F.substring("head", F.lit(1), F.col("shared") + STEP))
        groups = cut.groupBy("range", "prefix").agg(F.sum("w").alias("total"), F.min("head").alias("lo"), F.max("head").alias("hi"),
                                                    F.min("w").alias("least"), F.max("w").alias("largest"))
        groups = groups.withColumn("state", F.when(F.col("total") <= most, "done").when(F.col("lo") != F.col("hi"), "open")
                                   .when((F.col("least") == F.col("largest")) & (F.col("largest") <= start + length + 1), "done").otherwise("wait"))
        # neighbouring small prefixes are packed in their order: a row per prefix of a few characters behind what its range shares
        small = F.when(F.col("total") <= most, F.col("total")).otherwise(0)
        before = F.coalesce(F.sum(small).over(W.partitionBy("range").orderBy("prefix").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
        pack = F.when(F.col("total") <= most, F.floor(before / most)).otherwise(F.lit(-1))
        # ranges are named by a hash; two of one name would share a trie, which finds the same ids
        to = F.when(pack >= 0, F.xxhash64("range", pack)).otherwise(F.xxhash64("range", F.lit("alone"), "prefix"))
        groups = groups.withColumn("to", to).select("range", "prefix", "to", "state", F.when(F.col("state") == "open", _common("lo", "hi")).otherwise(0).alias("next"))
        moved = cut.join(groups, ["range", "prefix"]).select(*key, "w", "head", F.col("to").alias("range"), "state", F.col("next").alias("shared"))
        moved = stored(moved, "moved")
        done.append(moved.where("state = 'done'").select(*key, "range"))
        waiting.append(moved.where("state = 'wait'").select(*key, "w", "range"))
        open_ = moved.where("state = 'open'").drop("state")
        if open_.isEmpty():
            rest = reduce(DataFrame.union, waiting)
            if rest.isEmpty():
                return reduce(DataFrame.union, done)
            start, length, waiting = start + length, 2 * length, []
            heads = texts.select(*key, F.substring("text", start + 1, length).alias("head")).where("head <> ''")
            open_ = stored(rest.join(heads, key, "left").withColumns({"head": F.coalesce("head", F.lit("")), "shared": F.lit(0)}), "heads")


def _common(a: str, b: str):
    """Length of the longest common prefix of two columns, by bisection (a prefix of a common prefix is one)."""
    low, high = F.lit(0), F.least(F.length(a), F.length(b))
    state = F.struct(low.alias("low"), high.alias("high"))

    def halve(s, _):
        k = F.floor((s["low"] + s["high"] + 1) / 2).cast("int")
        same = F.substring(a, F.lit(1), k) == F.substring(b, F.lit(1), k)
        return F.struct(F.when(same, k).otherwise(s["low"]).alias("low"), F.when(same, s["high"]).otherwise(k - 1).alias("high"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(31)), state, halve, lambda s: s["low"])


def _least(kind: pa.DataType):
    """(range, id, chunk, terminal, text), sorted by range -> (chunk, terminal, least id of the text)."""
    def found(trie: Trie, rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
             pa.array([trie.least[r[2]] for r in rows], kind)], names=["chunk", "terminal", "found"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, trie, rows = None, Trie(), []
        for b in batches:
            for name, ident, chunk, terminal, text in zip(*(b.column(k).to_pylist() for k in range(5)), strict=True):
                if name != now:
                    if rows:
                        yield found(trie, rows)
                    now, trie, rows = name, Trie(), []
                rows.append((chunk, terminal, trie.insert(text, ident)))
        if rows:
            yield found(trie, rows)
    return run


def fail_masks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source",
               range_size: int | None = None) -> DataFrame:
    """One row per document: id, part, mask (bit k: it fails the k-th of ``FILTERS``)."""
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.col(part_col).cast("string").alias("part"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    arrow = {"string": pa.string(), "int": pa.int32(), "bigint": pa.int64()}[kind]
    read = stored(rows.mapInArrow(_read(arrow), f"id {kind}, part string, mask int, chunk long, terminal long, text string"), "texts")
    texts = read.where("mask = -1").select("id", "chunk", "terminal", "text")
    ranges = stored(_ranges(texts.drop("id"), range_size or RANGE), "ranges")
    handle = F.xxhash64("chunk", "terminal")
    moved = maybe_in(texts, handle, id_filter(ranges.select(handle.alias("h")), "h")).join(ranges, ["chunk", "terminal"])
    placed = moved.select("range", "id", "chunk", "terminal", "text").repartition("range").sortWithinPartitions("range")
    found = placed.mapInArrow(_least(arrow), f"chunk long, terminal long, found {kind}")
    least = texts.join(found, ["chunk", "terminal"], "left").select("chunk", "terminal", F.coalesce("found", "id").alias("least"))
    flagged = read.where("mask >= 0").select("id", "part", "mask", "chunk", "terminal").join(least, ["chunk", "terminal"])
    copy = F.coalesce(F.col("id") > F.col("least"), F.lit(False))
    return flagged.select("id", "part", F.col("mask").bitwiseOR(F.when(copy, 1 << FILTERS.index("E")).otherwise(0)).alias("mask"))


def audit(masks: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``fail_masks`` rows and labels (id, quality, toxic) -> a row per part, order of the filters and step."""
    marked = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(
        F.coalesce(F.max((F.col("quality") == 1).cast("long")), F.lit(0)).alias("good"),
        F.coalesce(F.max((F.col("toxic") == 1).cast("long")), F.lit(0)).alias("bad"))
    rows = masks.join(marked, "id", "left").groupBy("part", "mask").agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("good"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
    tables = rows.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "bad")).alias("masks"))  # 32 masks at most
    orders = [{"filter_order": "".join(p), "step": s + 1, "bit": 1 << FILTERS.index(p[s]), "seen": sum(1 << FILTERS.index(x) for x in p[:s])}
              for p in permutations(FILTERS) for s in range(len(p))]
    steps = F.from_json(F.lit(json.dumps(orders)), "array<struct<filter_order: string, step: int, bit: int, seen: int>>")
    table = tables.select("*", F.inline(steps))
    bit, seen = F.col("bit"), F.col("seen")

    def summed(count: str, of, weight=lambda m: F.lit(1)):
        """Sum of the counts of the masks that ``of`` picks."""
        return F.aggregate("masks", F.lit(0).cast("long"), lambda total, x: total + F.when(of(x["mask"]), x[count] * weight(x["mask"])).otherwise(0))

    fails = lambda m: m.bitwiseAND(bit) != 0
    earlier = lambda m: m.bitwiseAND(seen) != 0
    every = 1
    for k in range(2, len(FILTERS) + 1):
        every *= k
    # among the failed filters of a mask each is the first in as many orders
    share = lambda m: F.call_function("div", F.lit(every), F.bit_count(m)).cast("long")
    return table.select(
        "part", "filter_order", "step",
        summed("n", lambda m: m.bitwiseAND(seen.bitwiseOR(bit)) == 0).alias("kept"),
        summed("n", lambda m: fails(m) & ~earlier(m)).alias("removed"),
        summed("n", lambda m: fails(m) & earlier(m)).alias("redundant"),
        summed("n", lambda m: m == bit).alias("unique_fails"),
        summed("good", lambda m: fails(m) & ~earlier(m)).alias("good_lost"),
        summed("bad", lambda m: fails(m) & ~earlier(m)).alias("toxic_lost"),
        summed("n", fails, share).alias("shapley"))
