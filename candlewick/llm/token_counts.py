"""Exact length histogram (operator 5).

Every document is encoded whole with a public byte-level BPE vocabulary (its file is a parameter); the documents are
counted by encoded length, and suffix sums over the histogram answer, for every context limit at once, how many
documents and tokens there are at or above a length, the quantile of a length, and the tokens that remain when every
document is cut to the limit. The histogram has one row per distinct length, whatever the number of documents; its
running sums are cut into ranges of lengths, so no task reads the whole of it.

Defined results: a null or empty text has length 0; special-token strings in a text are ordinary text; repeated rows
count each time; an empty table gives an empty histogram and no answers.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from candlewick.llm.common import ship, stored

#: A public vocabulary; any tiktoken rank file does.
RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: The split pattern that belongs to the vocabulary (a fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Lengths per range of the running sums.
RANGE = 4096


@lru_cache(maxsize=2)
def _built(content: bytes):
    import tiktoken

    table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, filter(None, content.splitlines()))}
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})


def _content(ranks: str) -> bytes:
    with open(ranks, "rb") as f:
        return f.read()


def encoding(ranks: str):
    return _built(_content(ranks))


def encoded_lengths(docs: DataFrame, text_col: str = "text", ranks: str = RANKS) -> DataFrame:
    """One column ``n_tokens``, a row per document. The vocabulary is read on the driver and broadcast (its size is that
    of the file, whatever the table)."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(_content(ranks))

    @F.pandas_udf("long")
    def length(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        enc = _built(shared.value)
        for texts in batches:
            yield texts.map(lambda t: len(enc.encode_ordinary(t)) if t else 0)

    return docs.select(length(F.col(text_col)).alias("n_tokens"))


def histogram(docs: DataFrame, text_col: str = "text", ranks: str = RANKS) -> DataFrame:
    """``(n_tokens, docs)``, a row per distinct length, written to the shared folder: the answers read it several times,
    and each text is encoded once."""
    return stored(encoded_lengths(docs, text_col, ranks).groupBy("n_tokens").agg(F.count(F.lit(1)).alias("docs")), "lengths")


def with_suffix_sums(hist: DataFrame) -> DataFrame:
    """``(n_tokens, docs)`` -> for each length: docs and tokens at or above it, all docs and tokens, the share of
    documents up to it, and the tokens left when every document is cut to it."""
    h = hist.withColumn("tokens", F.col("n_tokens") * F.col("docs")).withColumn("part", F.floor(F.col("n_tokens") / RANGE))
    parts = h.groupBy("part").agg(F.sum("docs").alias("part_docs"), F.sum("tokens").alias("part_tokens"))
    above = W.orderBy(F.col("part").desc()).rowsBetween(W.unboundedPreceding, -1)  # one row per range of lengths
    everything = W.partitionBy()
    parts = parts.select(
        "part", F.coalesce(F.sum("part_docs").over(above), F.lit(0)).alias("docs_above"),
        F.coalesce(F.sum("part_tokens").over(above), F.lit(0)).alias("tokens_above"),
        F.sum("part_docs").over(everything).alias("all_docs"), F.sum("part_tokens").over(everything).alias("all_tokens"))
    within = W.partitionBy("part").orderBy(F.col("n_tokens").desc()).rowsBetween(W.unboundedPreceding, 0)
    h = h.withColumn("d", F.sum("docs").over(within)).withColumn("t", F.sum("tokens").over(within)).join(parts, "part")
    h = h.withColumn("docs_at_least", F.col("docs_above") + F.col("d")).withColumn("tokens_at_least", F.col("tokens_above") + F.col("t"))
    return h.select(
        "n_tokens", "docs", "docs_at_least", "tokens_at_least", "all_docs", "all_tokens",
        ((F.col("all_docs") - F.col("docs_at_least") + F.col("docs")) / F.col("all_docs")).alias("share_up_to"),
        (F.col("all_tokens") - F.col("tokens_at_least") + F.col("n_tokens") * F.col("docs_at_least")).alias("tokens_cut_here"))


def totals(sums: DataFrame, limit: int) -> DataFrame:
    """One row: documents, tokens, documents over the limit, tokens when cut to it. Any limit, seen as a length or not:
    the first length at or above it has the suffix sums."""
    first = F.min_by(F.struct("docs_at_least", "tokens_at_least", "docs", "n_tokens"), F.when(F.col("n_tokens") > limit, F.col("n_tokens")))
    return sums.agg(F.max("all_docs").alias("docs"), F.max("all_tokens").alias("tokens"), first.alias("s")).where("docs IS NOT NULL").select(
        F.lit(limit).alias("context"), "docs", "tokens", F.coalesce("s.docs_at_least", F.lit(0)).alias("docs_over"),
        (F.col("tokens") - F.coalesce("s.tokens_at_least", F.lit(0)) + limit * F.coalesce("s.docs_at_least", F.lit(0))).alias("tokens_cut"))


def quantile(sums: DataFrame, q: float) -> DataFrame:
    """One row: the smallest length that at least the share ``q`` of the documents do not exceed."""
    return sums.where(F.col("share_up_to") >= q).agg(F.min("n_tokens").alias("n_tokens")).where("n_tokens IS NOT NULL")
