"""The registered queries of this subpackage and their DuckDB texts (None: SQL cannot express the query)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.llm import (
    exact_dedup, filter_audit, fingerprints, hamming_search, jaccard_join, line_dedup, mixing, pieces, prefix_trie, quality, token_counts, toxicity,
    url_filter,
)
from candlewick.llm.common import crc_fold, table

URL_RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), URL_RULES)


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join(table(spark, sf_dir, "documents"), words=3, num=9, den=10)


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_with_edits(table(spark, sf_dir, "documents"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.curriculum(table(spark, sf_dir, "documents"))
    return mixed.select(
        "doc_id", "size", "source_size", "target", "taken", F.get("positions", F.lit(0)).alias("position"),
    ).orderBy(F.col("position").asc_nulls_last(), "doc_id")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.with_suffix_sums(token_counts.histogram(table(spark, sf_dir, "documents")))


def _judged(docs: DataFrame, score, threshold: float) -> DataFrame:
    scored = docs.select("doc_id", (crc_fold(F.col("doc_id")) == 0).alias("held_out"), score(F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    machine = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return _judged(docs, lambda text: toxicity.score(machine, text), 0.5)


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    chain = quality.train(docs, table(spark, sf_dir, "labels"))
    return _judged(docs, lambda text: quality.score(chain, text), 0.3)


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs, repeated=line_dedup.repeated_runs)


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return exact_dedup.dedup(docs).select(
        "doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


def op10_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode_checked(table(spark, sf_dir, "documents"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = prefix_trie.turns(table(spark, sf_dir, "conversations"))
    return prefix_trie.trie(prefix_trie.rebuilt(turns)).drop("last_words", "words_before")


def op12_hamming_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hamming_search.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    masks = filter_audit.fail_masks(table(spark, sf_dir, "documents"))
    return filter_audit.audit(masks, table(spark, sf_dir, "labels"))


OP4_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size, md5(CAST(doc_id AS VARCHAR)) AS place
  FROM documents
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, CAST(row_number() OVER (ORDER BY source ASC NULLS LAST) - 1 AS INTEGER) AS rank
  FROM sized GROUP BY source
), weighted AS (
  SELECT *, CAST(rank % 3 + 1 AS DOUBLE) AS weight, 3 * source_size AS cap, (3 * source_size) / CAST(rank % 3 + 1 AS DOUBLE) AS reach
  FROM sources
), rates AS (
  SELECT *, ((SELECT sum(source_size) FROM sources)
     - coalesce(sum(cap) OVER (ORDER BY reach, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
     / sum(weight) OVER (ORDER BY reach, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rate
  FROM weighted
), common AS (
  SELECT arg_min(rate, reach) AS rate FROM rates WHERE rate <= reach
), targets AS (
  SELECT source, source_size, rank, weight, coalesce(least(CAST(cap AS DOUBLE), (SELECT rate FROM common) * weight), CAST(cap AS DOUBLE)) AS target
  FROM weighted
), lined AS (
  SELECT s.doc_id, s.size, t.source_size, t.rank, t.weight, t.target, CAST(round(t.target) AS BIGINT) AS goal,
    CAST(coalesce(sum(s.size) OVER (PARTITION BY t.rank ORDER BY s.place, s.doc_id, s.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
), taken AS (
  SELECT *, CASE WHEN source_size > 0 THEN goal // source_size ELSE 0 END AS passes FROM lined
), parts AS (
  SELECT *, least(greatest(goal - passes * source_size - start, 0), size) AS part,
    weight * start / target AS u,
    CASE WHEN rank % 2 = 0 THEN weight * 0.5 ELSE weight * 1.5 END AS w0,
    CASE WHEN rank % 2 = 0 THEN weight ELSE -weight END AS slope
  FROM taken
)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target, CAST(passes * size + part AS BIGINT) AS taken,
  CASE WHEN size > 0 AND (passes > 0 OR part > 0) THEN
    round(CASE WHEN u <= 0 THEN 0.0 ELSE 2 * u / (w0 + sqrt(greatest(w0 * w0 + 2 * u * slope, 0.0))) END, 9) END AS position
FROM parts
"""

OP9_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
     g AS (SELECT text, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, sha256(d.text) AS text_sha256
FROM d JOIN g ON d.text = g.text
"""

#: The bitwise CRC-32 of the decimal id; a node is the list of what its turns say; every node adds to all its prefixes.
OP11_SQL = r"""
WITH RECURSIVE crc(c, bits, place, step) AS (
  SELECT conv_id, 4294967295::BIGINT, 0, 0 FROM (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL)
  UNION ALL
  SELECT c, CASE WHEN step = 0 THEN xor(bits, ascii(substr(CAST(c AS VARCHAR), place + 1, 1))::BIGINT)
                 WHEN bits % 2 = 1 THEN xor(bits // 2, 3988292384::BIGINT) ELSE bits // 2 END,
         CASE WHEN step = 8 THEN place + 1 ELSE place END, CASE WHEN step = 8 THEN 0 ELSE step + 1 END
  FROM crc WHERE place < length(CAST(c AS VARCHAR))
), heads AS (
  SELECT c, xor(bits, 4294967295::BIGINT) % 4 AS h FROM crc WHERE place = length(CAST(c AS VARCHAR))
), said AS (
  SELECT conv_id AS c, {'role': coalesce(role, ''), 'text': coalesce(text, '')} AS t,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL
), original AS (
  SELECT c, list(t ORDER BY pos) AS ts FROM said GROUP BY c
), whole AS (
  SELECT o.c, list_concat(coalesce(b.ts[1:h], []), o.ts[h + 1:]) AS ts
  FROM original o JOIN heads USING (c) LEFT JOIN original b ON b.c = o.c - o.c % 20
), prefixes AS (
  SELECT c, ts[1:d] AS node, d, len(ts) = d AS ended FROM (SELECT c, ts, unnest(range(0, len(ts) + 1)) AS d FROM whole)
), nodes AS (
  SELECT node, any_value(d) AS depth, min(c) AS conv_id, count(*) AS n_convs,
    CASE WHEN any_value(d) = 0 THEN 0 ELSE len(regexp_extract_all(node[len(node)].text, '[^\x20\x09-\x0D]+')) END AS words,
    sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE ended), '')) AS ends_sha256
  FROM prefixes GROUP BY node
), children AS (
  SELECT node[1:len(node) - 1] AS node, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL
), below AS (
  SELECT node[1:i] AS node, sum((n_convs - 1) * words) AS saved, count(*) FILTER (WHERE childless) AS leaves
  FROM (SELECT n.node, n_convs, words, c.n IS NULL AS childless, unnest(range(0, n.depth + 1)) AS i FROM nodes n LEFT JOIN children c USING (node))
  GROUP BY ALL
)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, n.n_convs, CAST(coalesce(c.n, 0) AS BIGINT) AS n_children,
  CAST(b.leaves AS BIGINT) AS n_leaves, CAST(b.saved AS BIGINT) AS saved_tokens, n.ends_sha256
FROM nodes n JOIN below b USING (node) LEFT JOIN children c USING (node)
  LEFT JOIN nodes p ON n.depth > 0 AND p.depth = n.depth - 1 AND p.node = n.node[1:n.depth - 1]
"""

OP13_SQL = r"""
WITH judged AS (
  SELECT coalesce(source, '') AS part, len(ws) < 50 AS a, 100 * len(list_distinct(ws)) < 65 * len(ws) AS b,
    100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t) AS c, regexp_matches(t, '[#$%&*|]') AS d,
    coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false) AS e, coalesce(good, 0) AS good, coalesce(bad, 0) AS bad
  FROM (SELECT doc_id, source, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents)
  LEFT JOIN (SELECT doc_id, max(CAST(quality = 1 AS INT)) AS good, max(CAST(toxic = 1 AS INT)) AS bad FROM labels GROUP BY doc_id) USING (doc_id)
), masks AS (
  SELECT part, a::INT + 2 * b::INT + 4 * c::INT + 8 * d::INT + 16 * e::INT AS mask, count(*) AS n, sum(good) AS good, sum(bad) AS bad
  FROM judged GROUP BY ALL
), letters AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x, unnest([1, 2, 4, 8, 16]) AS bit
), orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM letters a, letters b, letters c, letters d, letters e WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31
    AND (a.bit | b.bit | c.bit | d.bit | e.bit) = 31
), steps AS (
  SELECT filter_order, step, bits[step] AS bit, CAST(coalesce(list_sum(bits[1:step - 1]), 0) AS INTEGER) AS seen
  FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step)
), counted AS (
  SELECT part, filter_order, step, any_value(bit) AS bit,
    sum(CASE WHEN mask & (seen | bit) = 0 THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN mask & bit <> 0 AND mask & seen = 0 THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN mask & bit <> 0 AND mask & seen <> 0 THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN mask & bit <> 0 AND mask & seen = 0 THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN mask & bit <> 0 AND mask & seen = 0 THEN bad ELSE 0 END) AS toxic_lost
  FROM masks, steps GROUP BY part, filter_order, step
), totals AS (
  SELECT part, bit, sum(removed) AS shapley FROM counted GROUP BY part, bit
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
  CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(shapley AS BIGINT) AS shapley
FROM counted JOIN totals USING (part, bit)
"""

QUERIES = {
    "op1_url_filter": op1_url_filter,
    "op2_jaccard_join": op2_jaccard_join,
    "op3_fingerprints": op3_fingerprints,
    "op4_mixing": op4_mixing,
    "op5_token_counts": op5_token_counts,
    "op6_toxicity": op6_toxicity,
    "op7_quality": op7_quality,
    "op8_line_dedup": op8_line_dedup,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_pieces": op10_pieces,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_hamming_search": op12_hamming_search,
    "op13_filter_audit": op13_filter_audit,
}
ORACLE: dict[str, str] = {"op4_mixing": OP4_SQL, "op9_exact_dedup": OP9_SQL, "op11_prefix_trie": OP11_SQL, "op13_filter_audit": OP13_SQL}
