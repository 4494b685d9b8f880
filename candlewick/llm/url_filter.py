"""URL filter: host and path rules, and gradient-boosted trees for what no rule decides (operator 1, DataFrame
functions and ``pyspark.ml`` only).

The trees are trained from labelled URLs on lexical features: lengths, path depth, digit ratio, character entropy,
parameter counts, and for the host's last label (its suffix) how many training URLs have it and how many of them are
blocked. The suffix statistics travel with the model as a table; a suffix that training never saw gets the overall share.

Rules are a bounded list given by the caller (``MAX_RULES``) and travel as a map literal from host to paths: a URL
looks up each suffix of its host, so matching needs no shuffle and is linear in the number of labels.

Defined results: a null URL or one without ``://`` has empty host and path, fits no rule and is judged by the model on
its features (null counts as empty). Two rules of equal length: the longer host wins; the same rule given twice: block
wins. Without labelled URLs, or with labels of one kind, the score is the share of blocked ones (0.0 without any).
Repeated rows get equal verdicts; an empty table gives an empty table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.llm.common import bounded_sample, lower_ascii, stored

MAX_RULES = 10_000
#: Most labelled URLs that the trees are trained on, spread evenly by hash.
TRAINING_ROWS = 20_000
LEXICAL = ["url_length", "host_length", "path_length", "depth", "labels", "digit_ratio", "host_digit_ratio", "entropy",
           "parameters", "query_length", "hyphens", "has_fragment", "is_https", "longest_token"]
FEATURES = [*LEXICAL, "suffix_rows", "suffix_share"]


def host_of(url: Column) -> Column:
    return lower_ascii(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _share(part: Column, of: Column) -> Column:
    return F.when(F.length(of) > 0, F.length(part) / F.length(of)).otherwise(F.lit(0.0))


def entropy(c: Column) -> Column:
    """Shannon entropy in bits of the characters of a string (0 for an empty one)."""
    n = F.length(c)
    chars = F.array_distinct(F.split(c, ""))
    count = lambda x: (n - F.length(F.replace(c, x, F.lit("")))).cast("double")
    bits = F.aggregate(F.filter(chars, lambda x: x != ""), F.lit(0.0),
                       lambda acc, x: acc - count(x) / n * F.log2(count(x) / n))
    return F.when(n > 0, bits).otherwise(F.lit(0.0))


def lexical(urls: DataFrame, url_col: str = "url") -> DataFrame:
    """Adds host, path, suffix and the lexical features to a frame with no columns of these names."""
    df = urls.withColumn("host", host_of(F.col(url_col))).withColumn("path", path_of(F.col(url_col)))
    url, host, path = F.coalesce(F.col(url_col), F.lit("")), F.col("host"), F.col("path")
    query = F.regexp_extract(url, r"(?s)^[^?#]*\?([^#]*)", 1)
    features = {
        "suffix": F.substring_index(host, ".", -1),
        "url_length": F.length(url), "host_length": F.length(host), "path_length": F.length(path),
        "depth": F.regexp_count(path, F.lit("/")), "labels": F.size(F.split(host, r"\.")),
        "digit_ratio": _share(F.regexp_replace(url, "[^0-9]", ""), url),
        "host_digit_ratio": _share(F.regexp_replace(host, "[^0-9]", ""), host),
        "entropy": entropy(url),
        "parameters": F.when(query == "", 0).otherwise(F.regexp_count(query, F.lit("&")) + 1),
        "query_length": F.length(query), "hyphens": F.regexp_count(url, F.lit("-")),
        "has_fragment": F.instr(url, "#") > 0, "is_https": F.startswith(url, F.lit("https")),
        "longest_token": F.coalesce(F.array_max(F.transform(F.split(url, "[^A-Za-z0-9]+"), lambda t: F.length(t))), F.lit(0)),
    }
    return df.select("*", *[(v if k == "suffix" else v.cast("double")).alias(k) for k, v in features.items()])


def suffix_statistics(labelled: DataFrame, smoothing: float = 10.0) -> DataFrame:
    """``(suffix, suffix_rows, suffix_share)``: per suffix the training rows and the smoothed share of blocked ones."""
    overall = labelled.agg(F.avg("label").alias("overall"))
    return (
        labelled.groupBy("suffix").agg(F.count(F.lit(1)).cast("double").alias("suffix_rows"), F.sum("label").alias("_blocked"))
        .crossJoin(F.broadcast(overall))  # one row
        .select("suffix", "suffix_rows", ((F.col("_blocked") + smoothing * F.col("overall")) / (F.col("suffix_rows") + smoothing)).alias("suffix_share"))
    )


@dataclass
class UrlModel:
    """Trained trees with the suffix table (at most ``TRAINING_ROWS`` rows); ``trees`` is None for a constant score."""

    share: float
    suffixes: DataFrame | None = None
    trees: GBTClassificationModel | None = None

    def _vectors(self, features: DataFrame) -> DataFrame:
        full = features.join(self.suffixes, "suffix", "left").fillna({"suffix_rows": 0.0, "suffix_share": self.share})
        return VectorAssembler(inputCols=FEATURES, outputCol="features").transform(full)

    def score(self, features: DataFrame) -> DataFrame:
        """``lexical`` rows with ``score``, the trees' probability of block."""
        if self.trees is None:
            return features.withColumn("score", F.lit(self.share))
        judged = self.trees.transform(self._vectors(features))
        return judged.withColumn("score", vector_to_array("probability")[1])


def train(labelled: DataFrame, most: int = TRAINING_ROWS, rounds: int = 20, depth: int = 4) -> UrlModel:
    """``(url, label)`` with label 1 for block and 0 for allow -> model. Rows with a null in either are left out."""
    rows = labelled.select("url", F.col("label").cast("double").alias("label")).where("url IS NOT NULL AND label IS NOT NULL")
    sample = stored(lexical(bounded_sample(rows, most, "url", "label")), "url-training")
    kinds = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}  # two rows
    n = sum(kinds.values())
    share = kinds.get(1.0, 0) / n if n else 0.0
    if len(kinds) < 2:
        return UrlModel(share)
    model = UrlModel(share, stored(suffix_statistics(sample), "url-suffixes"))
    vectors = stored(model._vectors(sample).select("features", "label"), "url-vectors")
    model.trees = GBTClassifier(maxIter=rounds, maxDepth=depth, maxBins=32, stepSize=0.2, seed=7).fit(vectors)
    return model


def with_rule(urls: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    """Adds ``rule`` (the longest rule that fits, or null) and ``rule_verdict`` to a frame with host and path.

    ``rules``: (verdict, host + path prefix from the first ``/`` on).
    """
    if len(rules) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules")
    by_host: dict[str, dict[str, str]] = {}
    for verdict, rule in rules:
        host, slash, path = rule.partition("/")
        had = by_host.setdefault(host.lower(), {}).get(slash + path)
        by_host[host.lower()][slash + path] = "block" if "block" in (verdict, had) else "allow"
    if not by_host:
        return urls.withColumn("rule", F.lit(None).cast("string")).withColumn("rule_verdict", F.lit(None).cast("string"))
    table = F.create_map(*[x for host, paths in by_host.items() for x in (
        F.lit(host), F.array(*[F.struct(F.lit(p).alias("path"), F.lit(v).alias("verdict")) for p, v in paths.items()]))])
    labels = F.split("host", r"\.")
    suffixes = F.transform(labels, lambda _, i: F.array_join(F.slice(labels, i + 1, F.size(labels)), "."))

    def fits(suffix):
        here = F.filter(F.coalesce(F.element_at(table, suffix), F.array().cast("array<struct<path:string,verdict:string>>")),
                        lambda r: F.startswith(F.col("path"), r["path"]))
        return F.transform(here, lambda r: F.struct(
            (F.length(suffix) + F.length(r["path"])).alias("n"), F.length(suffix).alias("host_n"),
            F.concat(suffix, r["path"]).alias("rule"), r["verdict"].alias("verdict")))

    best = F.array_max(F.flatten(F.transform(suffixes, fits)))
    return urls.withColumn("_best", best).withColumn("rule", F.col("_best.rule")).withColumn("rule_verdict", F.col("_best.verdict")).drop("_best")


def judge(pages: DataFrame, rules: list[tuple[str, str]], labelled: DataFrame | None = None, id_col: str = "page_id",
          url_col: str = "url", block_from: float = 0.5, **training) -> DataFrame:
    """One row per page: id, host, path, rule, verdict, score. ``labelled`` is ``(url, label)``; without it the URLs
    that the rules decide are the labelled ones."""
    urls = with_rule(lexical(pages.select(id_col, F.col(url_col).alias("url"))), rules)
    if labelled is None:
        decided = pages.select(F.col(url_col).alias("url")).distinct()
        decided = with_rule(decided.withColumn("host", host_of(F.col("url"))).withColumn("path", path_of(F.col("url"))), rules)
        labelled = decided.where("rule IS NOT NULL").select("url", (F.col("rule_verdict") == "block").cast("int").alias("label"))
    scored = train(labelled, **training).score(urls)
    by_method = F.when(F.col("score") >= block_from, "block").otherwise("allow")
    return scored.select(id_col, "host", "path", "rule", F.coalesce("rule_verdict", by_method).alias("verdict"), "score")
