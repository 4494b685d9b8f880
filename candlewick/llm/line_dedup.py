"""Content-defined chunks of lines, and repeated passages (operator 8, DataFrame functions).

Each line is hashed, and a rolling hash runs over the hashes of consecutive lines. Three rules find what is repeated:

- Runs (``repeated_runs``, the query): first chunks, then the lines they leave. A boundary lies behind a line when the
  rolling hash there is 0 modulo ``CUT`` and the one before is not (``spaced_ends``): boundaries depend on content alone,
  survive insertions before them, and never leave a chunk of one line between them. A chunk with two blank lines in a row
  is left to the second step; any other that occurs before in the corpus goes, after a comparison of bytes. Then windows
  of ``MIN_LINES`` lines are compared in the same way, those that still occur twice when the windows inside chunks that
  went are not counted: they let a matched chunk grow into its neighbours line by line, and find passages that have no two
  boundaries of their own.
- Passages (``repeated_passages``): windows alone. Lines that occur in a window, with one non-blank character, before in
  the corpus and without overlapping that place are removed. Every longer repeated run is made of such windows, so all of
  it goes, wherever it begins and ends. The runs have the same result with fewer rows: the first place of a window is
  never inside a chunk that went, since that chunk's first copy holds the window too, so no comparison is lost.
- Chunks (``repeated_chunks``): chunks alone, by boundaries that are 0 modulo ``DIVISOR``. Fewer rows travel, but a
  repeated passage without two boundaries of its own stays.

The first occurrence (smallest id, then smallest line number) stays. Hashes only find candidates: lines go only if their
bytes equal those of lines before them, and so every distinct line stays at least once.

Defined results: a null text stays null and has no lines; an empty text has one empty line; rows with the same id and
text are one document and are treated alike (both keep a first occurrence); lines that share a hash but not their bytes
are told apart by their bytes; a null id sorts before the others; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.llm.common import id_filter, maybe_in, stored

#: Lines in the rolling window, boundaries per line (1 in so many), fewest lines of a chunk or passage that may go.
WINDOW, DIVISOR, MIN_LINES = 2, 4, 2
#: Rolling hashes per boundary condition of the spaced chunks: one line in CUT * CUT / (CUT - 1) ends a chunk.
CUT = 2
#: Two blank lines in a row.
BLANK_PAIR = r"(?:\A|\n)[^\S\n]*\n[^\S\n]*(?:\n|\z)"


def chunk_ends(lines: Column) -> Column:
    """Index (1-based) of the last line of each chunk."""
    hashes = F.transform(lines, lambda x: F.xxhash64(x))

    def rolling(i):
        window = F.slice(hashes, i - (WINDOW - 1), WINDOW)
        return F.aggregate(window, F.lit(0).cast("long"), lambda acc, h: F.xxhash64(acc, h))

    inner = F.filter(F.sequence(F.lit(1), F.size(lines)),
                     lambda i: (i == F.size(lines)) | ((i >= WINDOW) & (F.pmod(rolling(i), F.lit(DIVISOR)) == 0)))
    return inner


def chunked(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per chunk of at least ``MIN_LINES`` lines: id, key (the document), first line, number of lines, hash, body."""
    rows = docs.where(F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.xxhash64(text_col).alias("key"), F.split(text_col, "\n").alias("lines"))
    rows = rows.withColumn("ends", chunk_ends(F.col("lines")))
    spans = F.transform("ends", lambda e, i: F.struct(
        (F.when(i == 0, 0).otherwise(F.get("ends", i - 1)) + 1).alias("first"),
        (e - F.when(i == 0, 0).otherwise(F.get("ends", i - 1))).alias("n")))
    long_enough = F.filter(spans, lambda s: s["n"] >= MIN_LINES)
    chunks = F.transform(long_enough, lambda s: F.struct(
        s["first"].alias("first"), s["n"].alias("n"), F.array_join(F.slice("lines", s["first"], s["n"]), "\n").alias("body")))
    flat = rows.select("id", "key", F.explode(chunks).alias("c")).select("id", "key", "c.*")
    return flat.where(F.col("body").rlike(r"\S")).withColumn("hash", F.xxhash64("body"))


def repeated_chunks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, key, first, n)`` of the chunks that go."""
    chunks = chunked(docs, id_col, text_col)
    # narrow first: only the hash travels, and the few that repeat come back
    shared = stored(chunks.groupBy("hash").agg(F.count(F.lit(1)).alias("copies")).where("copies > 1").select("hash"), "chunk-hashes")
    found = chunks.join(shared, "hash")
    # byte comparison: groups of equal bytes, the smallest place of each stays; partial sums meet hot chunks
    first = found.groupBy("hash", "body").agg(F.min(F.struct("id", "first", "key")).alias("stays"))
    return (
        found.join(first, ["hash", "body"])
        .where(~(F.col("id").eqNullSafe(F.col("stays.id")) & (F.col("key") == F.col("stays.key")) & (F.col("first") == F.col("stays.first"))))
        .select("id", "key", "first", "n").distinct()
    )


def windows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per ``MIN_LINES`` consecutive lines: id, key (the document), lines (all of it), first line, hash."""
    rows = docs.where(F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.xxhash64(text_col).alias("key"), F.split(text_col, "\n").alias("lines"))
    rows = rows.where(F.size("lines") >= MIN_LINES)
    hashes, n = F.transform("lines", lambda x: F.xxhash64(x)), F.size("lines") - (MIN_LINES - 1)
    rolled = F.slice(hashes, F.lit(1), n)
    for k in range(1, MIN_LINES):
        rolled = F.zip_with(rolled, F.slice(hashes, F.lit(1 + k), n), lambda acc, h: F.xxhash64(acc, h))
    return rows.select("id", "key", "lines", F.posexplode(rolled).alias("at", "hash")).withColumn("first", F.col("at") + 1).drop("at")


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, key, first, n)`` of the windows of ``MIN_LINES`` lines that go; they overlap within a longer passage."""
    every = windows(docs, id_col, text_col)
    # narrow first: only the hash travels, and the text of the windows that may repeat follows
    shared = stored(every.groupBy("hash").agg(F.count(F.lit(1)).alias("copies")).where("copies > 1").select("hash"), "window-hashes")
    body = F.concat_ws("\n", *[F.get("lines", F.col("first") + (k - 1)) for k in range(MIN_LINES)])
    found = maybe_in(every, F.col("hash"), id_filter(shared, "hash")).select("id", "key", "first", "hash", body.alias("body"))
    found = found.where(F.col("body").rlike(r"\S"))
    # byte comparison: groups of equal bytes, the smallest place of each stays; partial sums meet hot windows
    first = found.groupBy("hash", "body").agg(F.min(F.struct("id", "first", "key")).alias("stays"), F.count(F.lit(1)).alias("copies"))
    same = F.col("id").eqNullSafe(F.col("stays.id")) & (F.col("key") == F.col("stays.key"))
    return (
        found.join(first.where("copies > 1").drop("copies"), ["hash", "body"])
        .where(~same | (F.col("first") >= F.col("stays.first") + MIN_LINES))
        .select("id", "key", "first", F.lit(MIN_LINES).alias("n")).distinct()
    )


def rolling_hashes(lines: Column) -> Column:
    """The hash of every ``MIN_LINES`` consecutive lines, in order of their first line (there are that many lines)."""
    hashes, n = F.transform(lines, lambda x: F.xxhash64(x)), F.size(lines) - (MIN_LINES - 1)
    rolled = F.slice(hashes, F.lit(1), n)
    for k in range(1, MIN_LINES):
        rolled = F.zip_with(rolled, F.slice(hashes, F.lit(1 + k), n), lambda acc, h: F.xxhash64(acc, h))
    return rolled


def spaced_ends(rolled: Column, n_lines: Column) -> Column:
    """Index (1-based) of the last line of each chunk: where a rolling hash is 0 modulo CUT and the one before is not."""
    zero = F.transform(rolled, lambda r: F.pmod(r, F.lit(CUT)) == 0)
    before = F.concat(F.array(F.lit(False)), F.slice(zero, F.lit(1), F.size(zero) - 1))
    cuts = F.transform(F.zip_with(zero, before, lambda now, was: now & ~was), lambda cut, i: F.when(cut, i + MIN_LINES))
    return F.array_union(F.filter(cuts, lambda e: e.isNotNull()), F.array(n_lines))


def spans(rows: DataFrame) -> DataFrame:
    """Adds ``spans``: first line and number of lines of every chunk of ``rows`` (lines, rolled)."""
    rows = rows.withColumn("ends", spaced_ends(F.col("rolled"), F.size("lines")))
    starts = F.concat(F.array(F.lit(0)), F.slice("ends", F.lit(1), F.size("ends") - 1))
    return rows.withColumn("spans", F.zip_with(starts, "ends", lambda s, e: F.struct((s + 1).alias("first"), (e - s).alias("n")))).drop("ends")


def spaced_chunks(rows: DataFrame) -> DataFrame:
    """``(id, key, first, n, hash, body)`` of the chunks of ``rows`` (id, key, lines, spans) that may go."""
    chunks = F.transform(F.filter("spans", lambda s: s["n"] >= MIN_LINES), lambda s: F.struct(
        s["first"].alias("first"), s["n"].alias("n"), F.array_join(F.slice("lines", s["first"], s["n"]), "\n").alias("body")))
    flat = rows.select("id", "key", F.explode(chunks).alias("c")).select("id", "key", "c.*")
    return flat.where(F.col("body").rlike(r"\S") & ~F.col("body").rlike(BLANK_PAIR)).withColumn("hash", F.xxhash64("body"))


def spaced_windows(rows: DataFrame, with_body: bool) -> DataFrame:
    """``(id, key, first, n, chunk, hash)``, if asked with the body, of the windows of ``rows`` (id, key, lines, rolled, spans);
    chunk: first line of the chunk that holds the whole window, null where it reaches over the chunk's end."""
    last = F.size("rolled")

    def of(s):
        end = s["first"] + s["n"] - 1
        starts = F.when(s["first"] <= last, F.sequence(s["first"], F.least(end, last))).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.struct(
            i.alias("first"), F.when(i + MIN_LINES - 1 <= end, s["first"]).alias("chunk"), F.get("rolled", i - 1).alias("hash"),
            *([F.array_join(F.slice("lines", i, MIN_LINES), "\n").alias("body")] if with_body else [])))

    flat = rows.select("id", "key", F.explode(F.flatten(F.transform("spans", of))).alias("w")).select("id", "key", F.lit(MIN_LINES).alias("n"), "w.*")
    return flat.where(F.col("body").rlike(r"\S")) if with_body else flat


def _later(places: DataFrame, counted: DataFrame, apart: Column, name: str) -> DataFrame:
    """Those of ``places`` (id, key, first, n, hash, body) whose bytes occur at a smaller place, among the hashes that
    ``counted`` holds twice; ``apart``: what must hold, besides, of two places in the same document."""
    # narrow first: only the hash travels, and the text of those that may repeat follows
    shared = stored(counted.groupBy("hash").agg(F.count(F.lit(1)).alias("copies")).where("copies > 1").select("hash"), name)
    found = stored(maybe_in(places, F.col("hash"), id_filter(shared, "hash")), f"{name}-found")
    # byte comparison: groups of equal bytes, the smallest place of each stays; partial sums meet hot groups
    first = found.groupBy("hash", "body").agg(F.min(F.struct("id", "first", "key")).alias("stays"), F.count(F.lit(1)).alias("copies"))
    same = F.col("id").eqNullSafe(F.col("stays.id")) & (F.col("key") == F.col("stays.key"))
    return (
        found.join(first.where("copies > 1").drop("copies"), ["hash", "body"]).where(~same | apart)
        .select("id", "key", "first", "n").distinct()
    )


def runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """``(id, key, first, n)`` of the chunks that go, and of the windows of ``MIN_LINES`` lines that go besides."""
    rows = docs.where(F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.xxhash64(text_col).alias("key"), F.split(text_col, "\n").alias("lines"))
    rows = spans(rows.where(F.size("lines") >= MIN_LINES).withColumn("rolled", rolling_hashes(F.col("lines"))))
    chunks = spaced_chunks(rows)
    chunks = stored(_later(chunks, chunks, F.col("first") > F.col("stays.first"), "chunk-hashes"), "chunks")
    # a window inside a chunk that went is not counted: what such chunks share is left with one copy, and not compared again
    gone = chunks.select(F.col("id").alias("c_id"), F.col("key").alias("c_key"), F.col("first").alias("c_first"))
    counted = spaced_windows(rows, with_body=False).join(
        gone, F.col("id").eqNullSafe(F.col("c_id")) & (F.col("key") == F.col("c_key")) & (F.col("chunk") == F.col("c_first")), "left_anti")
    windows_ = spaced_windows(rows, with_body=True).drop("chunk")
    return chunks, _later(windows_, counted, F.col("first") >= F.col("stays.first") + MIN_LINES, "window-hashes")


def repeated_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, key, first, n)`` of the chunks that go and of the windows that go besides; they overlap."""
    chunks, besides = runs(docs, id_col, text_col)
    return chunks.unionByName(besides)


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                repeated: Callable[[DataFrame, str, str], DataFrame] = repeated_chunks) -> DataFrame:
    """One row per document: id, text without what ``repeated`` finds, n_lines, removed_lines; other columns stay."""
    gone = repeated(docs, id_col, text_col).select("id", "key", F.explode(F.expr("sequence(first, first + n - 1)")).alias("line"))
    gone = gone.groupBy("id", "key").agg(F.collect_set("line").alias("gone"))
    rows = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("doc"), F.col(text_col).alias("whole"), F.xxhash64(text_col).alias("doc_key"))
    rows = rows.join(gone, F.col("doc").eqNullSafe(F.col("id")) & (F.col("doc_key") == F.col("key")), "left")
    lines = F.split("whole", "\n")
    # one pass over the numbers of the lines that stay, however many go; the lines are split once, in the outer array
    left = F.get(F.transform(F.array(lines), lambda all_: F.transform(
        F.array_except(F.sequence(F.lit(1), F.size(all_)), "gone"), lambda i: F.get(all_, i - 1))), F.lit(0))
    text = F.when(F.col("gone").isNull(), F.col("whole")).otherwise(F.array_join(left, "\n"))
    removed = F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone"))
    return rows.select(
        F.col("doc").alias(id_col), text.alias(text_col), F.when(F.col("whole").isNull(), 0).otherwise(F.size(lines)).alias("n_lines"),
        removed.alias("removed_lines"),
        *[F.col(f"row.`{c}`") for c in docs.columns if c not in (id_col, text_col, "n_lines", "removed_lines")])
