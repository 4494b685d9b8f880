"""Approximate nearest neighbours by multi-index hashing (operator 12).

Codes. A bounded sample of the vectors' directions gives a mean, principal axes and, by iterative quantisation from
several starts, rotations of them; the signs of ``BITS`` rotated coordinates are a vector's code. The same sample tells
the Hamming radius within which ``KEEP`` of the nearest neighbours by inner product lie.

Index. A code is split into substrings of 16 bits; each has an index of its own: buckets of rows by substring. Codes
within radius r differ, in the k-th of m substrings, by at most a bits for one of the first b + 1 of them or a - 1 for
one of the others, where r = m a + b (pigeonhole). Probing visits every bucket within that distance and so retrieves every
code within the radius; whole codes are compared next, and the floats of those left are ranked. A query that finds fewer
than ``LEAST`` rows in an index widens its radius until it has them or all rows.

Every row is indexed. Rows are dealt into shards of about ``ROWS`` by class of length (so that directions are compared
among vectors of like length) and hash, queries into blocks of about ``QUERIES``; a task has one shard and one block, both
bounded, and returns the best of each query there, and the best of all shards are kept. Scores are summed in double
precision in the order of the components, so equal vectors have equal scores.

Defined results: vectors that are null, zero, or hold a null or non-finite component, and those whose number of
components isn't the most frequent one (of equally frequent ones the largest), take no part; the sum that a length is
taken from must be finite; each row is a query or candidate of its own, also where ids repeat; a null id is no query,
and comes last among ties; an empty table gives an empty table.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from candlewick.llm.common import bounded_sample, ship, stored

#: Bits of a code, of a substring.
BITS, PART = 128, 16
#: Rows and queries of the sample that codes and radius are learned from; share of neighbours within the radius.
SAMPLE, TRIALS, KEEP = 8192, 256, 0.97
#: Rows of a shard, queries of a block, rows that a query finds in a shard at least.
ROWS, QUERIES, LEAST = 8192, 512, 64
#: Length classes for each power of two.
CLASSES = 4


@dataclass
class Coder:
    """Codes of vectors, and the radius to search."""

    mean: np.ndarray
    planes: np.ndarray  # components x bits
    radius: int = 0

    def parts(self, x: np.ndarray) -> np.ndarray:
        """(rows, substrings) of 16 bits."""
        x = x / np.linalg.norm(x, axis=1, keepdims=True)
        bits = (x - self.mean) @ self.planes > 0
        return np.packbits(bits, axis=1, bitorder="little").view(np.uint16)


def _rotations(x: np.ndarray, bits: int, rounds: int = 20) -> np.ndarray:
    """Principal axes, rotated so that the signs say most: from as many starts as the bits need."""
    values, axes = np.linalg.eigh(x.T @ x)
    axes = axes[:, np.argsort(-values, kind="stable")][:, :bits]
    v = x @ axes
    found, rnd = [], np.random.default_rng(11)
    for _ in range(math.ceil(bits / axes.shape[1])):
        turn = np.linalg.qr(rnd.normal(size=(axes.shape[1],) * 2))[0]
        for _ in range(rounds):
            a, _, b = np.linalg.svd(v.T @ np.where(v @ turn > 0, 1.0, -1.0))
            turn = a @ b
        found.append(axes @ turn)
    return np.concatenate(found, axis=1)[:, :bits]


def learn(sample: np.ndarray, k: int, bits: int = BITS, keep: float = KEEP, trials: int = TRIALS) -> Coder:
    """``sample``: vectors as they are. The radius holds ``keep`` of the k nearest of the trial queries in the sample;
    in a larger table the nearest are nearer."""
    x = sample / np.linalg.norm(sample, axis=1, keepdims=True)
    mean = x.mean(axis=0)
    coder = Coder(mean, _rotations(x - mean, bits))
    words = coder.parts(sample).view(np.uint64)
    k = min(k, len(sample) - 1)
    if k > 0:
        trials = min(trials, len(sample))
        scores = sample[:trials] @ sample.T
        scores[np.arange(trials), np.arange(trials)] = -np.inf
        near = np.argpartition(-scores, k - 1, axis=1)[:, :k]
        apart = np.bitwise_count(words[:trials, None, :] ^ words[near]).sum(axis=2, dtype=np.int64)
        coder.radius = int(np.quantile(apart, keep, method="higher"))
    return coder


class Index:
    """The substring indexes of a shard."""

    def __init__(self, parts: np.ndarray):
        self.words = np.ascontiguousarray(parts).view(np.uint64)
        self.n, self.m = parts.shape
        self.tables = []
        for k in range(self.m):
            order = np.argsort(parts[:, k], kind="stable")
            values, counts = np.unique(parts[:, k], return_counts=True)
            self.tables.append((values, counts, order))

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """Every row whose code is within the radius."""
        a, b = divmod(min(radius, self.m * PART), self.m)
        met = np.zeros(self.n, bool)
        for k, (values, counts, order) in enumerate(self.tables):
            reach = a if k <= b else a - 1
            near = np.bitwise_count(values ^ code[k]) <= reach if reach >= 0 else np.zeros(len(values), bool)
            met[order[np.repeat(near, counts)]] = True  # the buckets within reach
        rows = np.flatnonzero(met)
        apart = np.bitwise_count(self.words[rows] ^ code.view(np.uint64)).sum(axis=1, dtype=np.int64)
        return rows[apart <= radius]

    def find(self, code: np.ndarray, radius: int, least: int) -> np.ndarray:
        """Rows within the radius, which grows until there are ``least`` or all."""
        rows = self.within(code, radius)
        while len(rows) < min(least, self.n):
            radius += self.m
            rows = self.within(code, radius)
        return rows


def _scores(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    total = np.zeros(len(x))
    for d in range(x.shape[1]):
        total += x[:, d] * q[d]
    return total


def _best(x: np.ndarray, ids: np.ndarray, rows: np.ndarray, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best of the rows: (rows, scores), ties to the smaller id."""
    if len(rows) > k:
        rough = x[rows] @ q
        least = np.partition(rough, len(rows) - k)[len(rows) - k]
        rows = rows[rough >= least - 1e-9 * (np.abs(rough).max() + 1e-300)]
    exact = _scores(x[rows], q)
    order = np.lexsort((ids[rows], -exact))[:k]
    return rows[order], exact[order]


def _matrix(table: pa.Table, name: str, width: int) -> np.ndarray:
    column = table.column(name).combine_chunks()
    return np.asarray(column.flatten(), np.float64).reshape(len(column), width)


def _search(coder: Coder, k: int, least: int):
    width = len(coder.mean)

    def run(rows: pa.Table, queries: pa.Table) -> pa.Table:
        out = {"q": [], "query_id": [], "id": [], "score": []}
        if rows.num_rows and queries.num_rows:
            x, q = _matrix(rows, "v", width), _matrix(queries, "v", width)
            given = rows.column("id").combine_chunks()
            keys = given.fill_null(np.iinfo(np.int64).max).to_numpy()  # a null id comes last
            own, asked = rows.column("uid").to_numpy(), queries.column("uid").to_numpy()
            index, codes = Index(coder.parts(x)), coder.parts(q)
            for i in range(len(q)):
                found = index.find(codes[i], coder.radius, least + 1)
                found = found[own[found] != asked[i]]
                best, scores = _best(x, keys, found, q[i], k)
                out["q"].append(np.full(len(best), asked[i]))
                out["query_id"].append(np.full(len(best), i))
                out["id"].append(best)
                out["score"].append(scores)
            at = {c: np.concatenate(v) for c, v in out.items()}
            return pa.table({"q": at["q"], "query_id": queries.column("id").combine_chunks().take(pa.array(at["query_id"])),
                             "vec_id": given.take(pa.array(at["id"])), "score": at["score"]})
        return pa.table({"q": pa.array([], pa.int64()), "query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
    return run


def usable(vectors: DataFrame, query: Column, id_col: str, vector_col: str) -> DataFrame:
    """uid, id, v (doubles), is_query, length: the vectors that take part, stored."""
    v = F.col(vector_col).cast("array<double>")
    finite = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), v.alias("v"), F.coalesce(query, F.lit(False)).alias("is_query"))
    rows = rows.where(F.col("v").isNotNull()).where(finite)
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda t, c: t + c * c))
    rows = rows.withColumn("length", length).where((F.col("length") > 0) & (F.col("length") < float("inf")))
    return stored(rows.withColumn("uid", F.monotonically_increasing_id()), "vectors")


def search(vectors: DataFrame, query: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding",
           bits: int = BITS, keep: float = KEEP, rows_per_shard: int = ROWS, queries_per_block: int = QUERIES) -> DataFrame:
    """The rows that ``query`` picks against all others: query_id, rank, vec_id, score of the k nearest found."""
    spark = vectors.sparkSession
    ship(spark)
    rows = usable(vectors, query, id_col, vector_col)
    widths = rows.groupBy(F.size("v").alias("width")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("width")).first()
    empty = "query_id long, rank int, vec_id long, score double"
    if widths is None:
        return spark.createDataFrame([], empty)
    rows = rows.where(F.size("v") == widths["width"]).withColumn("class", F.floor(F.log2("length") * CLASSES + 0.5))
    counts = rows.groupBy("class").agg(F.count(F.lit(1)).alias("n"), F.count_if("is_query").alias("q")).orderBy("class").collect()  # a row per length class
    sample = np.array([r["v"] for r in bounded_sample(rows.select("v", "uid"), SAMPLE, "uid").collect()])
    coder = learn(sample, k, bits, keep)

    # shards are numbered through the classes
    shards, numbered = 0, []
    for r in counts:
        n = math.ceil(r["n"] / rows_per_shard)
        numbered += [F.lit(r["class"]), F.struct(F.lit(shards).alias("first"), F.lit(n).alias("n"))]
        shards += n
    asked = sum(r["q"] for r in counts)
    query_blocks = max(math.ceil(asked / queries_per_block), 1)
    own = F.element_at(F.create_map(*numbered), F.col("class"))
    hashed = lambda salt, n: F.pmod(F.xxhash64(F.lit(salt), "uid"), n)
    placed = rows.select("uid", "id", "v", (own["first"] + hashed(1, own["n"])).cast("int").alias("shard"),
                         F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("block"))
    queries = rows.where("is_query").select("uid", "id", "v", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"),
                                            hashed(2, F.lit(query_blocks)).cast("int").alias("block"))
    found = placed.groupBy("shard", "block").cogroup(queries.groupBy("shard", "block")).applyInArrow(
        _search(coder, k, LEAST), "q long, query_id long, vec_id long, score double")
    best = W.partitionBy("q").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
