"""Source mixing (4), token counts (5), fingerprints (3), URL filter (1)."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import pytest
import xxhash
from llm_helpers import LONG, ROWS, docs, empty
from pyspark.sql import functions as F

from candlewick.llm import fingerprints as P
from candlewick.llm import mixing as M
from candlewick.llm import token_counts as T
from candlewick.llm import url_filter as U


def words(t):
    return len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))


def targets(sizes, repeat=3):
    """Sharing the excess again until no target is above its limit."""
    weight = {s: k % 3 + 1 for k, s in enumerate(sorted(sizes, key=lambda s: (s is None, (s or "").encode())))}
    capped, total = {}, sum(sizes.values())
    while True:
        rest = [s for s in sizes if s not in capped]
        left, w = total - sum(capped.values()), sum(weight[s] for s in rest)
        share = {s: left * weight[s] / w for s in rest}
        over = [s for s in rest if share[s] > repeat * sizes[s]]
        if not over:
            return capped | share
        capped |= {s: repeat * sizes[s] for s in over}


def test_targets_and_taken_words(spark):
    rows = [(i, " ".join(["w"] * (1 + i * 7 % 23)), "en", f"s{i % 7}" if i % 50 else None) for i in range(300)]
    rows += [(1000 + i, "w " * 3000, "en", "big") for i in range(3)]
    out = M.curriculum(docs(spark, rows)).collect()
    sizes = defaultdict(int)
    for _, t, _, s in rows:
        sizes[s] += words(t)
    want = targets(sizes)
    source = {r[0]: r[3] for r in rows}
    taken = defaultdict(int)
    for r in out:
        s = source[r.doc_id]
        assert r.source_size == sizes[s] and math.isclose(r.target, want[s], rel_tol=1e-12)
        assert 0 <= r.taken <= 3 * r.size
        assert len(r.positions) == math.ceil(r.taken / r.size) and list(r.positions) == sorted(r.positions)
        assert all(0 <= p <= 1 for p in r.positions)
        taken[s] += r.taken
    assert {s: round(t) for s, t in want.items()} == dict(taken)
    again = M.curriculum(docs(spark, rows[::-1]).repartition(5)).collect()
    key = lambda r: r.doc_id
    assert sorted(out, key=key) == sorted(again, key=key)


def test_positions_follow_the_integral_of_the_schedule(spark):
    """At any time the words placed so far are the target times the integral of the schedule up to then."""
    rows = [(i, "w " * 10, "en", "ab"[i % 2]) for i in range(2000)]
    out = M.curriculum(docs(spark, rows)).select("doc_id", "size", "target", F.explode("positions").alias("p")).collect()
    for k, s in enumerate("ab"):
        mine = sorted(r.p for r in out if r.doc_id % 2 == k)
        w0, slope = (0.5, 1.0) if k == 0 else (1.5, -1.0)  # of the weight: rising, falling
        for t in (0.1, 0.25, 0.5, 0.9):
            placed = sum(1 for p in mine if p < t) / len(mine)
            assert abs(placed - (w0 * t + slope * t * t / 2)) < 0.01


def test_mixing_on_awkward_rows(spark):
    out = M.curriculum(docs(spark)).collect()
    assert len(out) == len(ROWS)
    by_id = {r.doc_id: r for r in out}
    for i in (3, 4, 5):
        assert (by_id[i].size, by_id[i].taken, by_id[i].positions) == (0, 0, [])
    ordered = M.training_order(M.curriculum(docs(spark), carry=True))
    assert ordered.columns == docs(spark).columns
    assert not {3, 4, 5} & {r.doc_id for r in ordered.collect()}
    assert M.curriculum(empty(spark)).collect() == []
    assert M.curriculum(docs(spark, [(1, None, "en", "s")])).first().target == 0.0


def test_histogram_answers_every_limit(spark):
    rows = [r for r in ROWS if r[0] != 6] + [(100 + i, "word " * (i * i % 97), "en", "s") for i in range(200)] + [(6, LONG * 3, "en", "s")]
    enc = T.encoding(T.RANKS)
    lengths = [len(enc.encode_ordinary(t or "")) for _, t, *_ in rows]
    sums = T.with_suffix_sums(T.histogram(docs(spark, rows)))
    sums.persist()
    got = {r.n_tokens: r for r in sums.collect()}
    assert {n: r.docs for n, r in got.items()} == Counter(lengths)
    for n, r in got.items():
        assert r.docs_at_least == sum(x >= n for x in lengths) and r.tokens_at_least == sum(x for x in lengths if x >= n)
        assert (r.all_docs, r.all_tokens) == (len(lengths), sum(lengths))
        assert r.tokens_cut_here == sum(min(x, n) for x in lengths)
        assert math.isclose(r.share_up_to, sum(x <= n for x in lengths) / len(lengths))
    for limit in (0, 1, 7, 50, 1000, 10**9):
        r = T.totals(sums, limit).first()
        assert (r.docs_over, r.tokens_cut) == (sum(x > limit for x in lengths), sum(min(x, limit) for x in lengths))
    for q in (0.01, 0.5, 0.9, 1.0):
        assert T.quantile(sums, q).first().n_tokens == sorted(lengths)[math.ceil(q * len(lengths) - 1e-9) - 1]
    sums.unpersist()


def test_histogram_of_special_strings_and_of_nothing(spark):
    df = docs(spark, [(1, "<|endoftext|>", "en", "s"), (2, None, "en", "s")])
    assert {r.n_tokens: r.docs for r in T.histogram(df).collect()} == {len(T.encoding(T.RANKS).encode_ordinary("<|endoftext|>")): 1, 0: 1}
    assert T.with_suffix_sums(T.histogram(empty(spark))).collect() == [] and T.totals(T.with_suffix_sums(T.histogram(empty(spark))), 5).collect() == []


def paragraph_set(t):
    head = [t[:P.HEAD][i:i + P.FINE] for i in range(0, min(P.HEAD, len(t)), P.FINE)]
    rest = [p for line in t[P.HEAD:].split("\n") for p in [line[i:i + P.PIECE] for i in range(0, len(line), P.PIECE)]]
    return {xxhash.xxh64_intdigest(p.encode(), 42) for p in head + rest}


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


@pytest.mark.parametrize("rows_per_range", [2, 10_000])
def test_edits_and_likeness_equal_brute_force(spark, monkeypatch, rows_per_range):
    monkeypatch.setattr(P, "RANGE_ROWS", rows_per_range)
    rows = [(i, (t or "") + f"\ntail {i % 4}\n" + "".join(f"p{i}-{k}\n" for k in range(i % 40)), "en", "s")
            for i, t in enumerate(["", "short", "two\nlines", "x" * 300, LONG[:5000]] * 12)]
    rows += [(900, "", "en", "s"), (901, None, "en", "s"), (902, "é漢𝔘", "en", "s")]
    got = {r.doc_id: r for r in P.compare_with_edits(docs(spark, rows)).collect()}
    texts = sorted((i, t or "") for i, t, *_ in rows)
    assert len(got) == len(rows)
    for k, (i, t) in enumerate(texts):
        after = texts[(k + 1) % len(texts)][1]
        half = len(t) // 2
        edited = t[: len(t) - half] + after[:half]
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert math.isclose(r.near_edited, jaccard(paragraph_set(t), paragraph_set(edited)))
        assert math.isclose(r.near_next, jaccard(paragraph_set(t), paragraph_set(after)))
    prints = defaultdict(set)
    for i, t in texts:
        prints[t].add(got[i].fingerprint)
    assert all(len(p) == 1 for p in prints.values()) and len({p for s in prints.values() for p in s}) == len(prints)


def test_peeling_recovers_both_sides(spark):
    a, b = list(range(0, 60)), list(range(20, 90))
    df = spark.createDataFrame([(a, b), (a, a), ([], b), ([], [])], "a array<long>, b array<long>")
    df = df.select(*[F.array_sort(F.transform(c, lambda x: F.xxhash64(x))).alias(c) for c in ("a", "b")])
    out = P.with_difference(df, "a", "b", "d").withColumn("left", F.array_sort(F.transform(F.filter("d", lambda x: x["side"] == 1), lambda x: x["h"])))
    out = out.withColumn("right", F.array_sort(F.transform(F.filter("d", lambda x: x["side"] == -1), lambda x: x["h"])))
    for r in out.select("left", "right", F.array_sort(F.array_except("a", "b")).alias("x"), F.array_sort(F.array_except("b", "a")).alias("y")).collect():
        assert (r.left, r.right) == (r.x, r.y)


def test_a_sketch_too_small_says_so(spark):
    size = F.lit(4).cast("long")
    df = spark.createDataFrame([(list(range(200)),), ([1, 2],)], "a array<long>").select(F.transform("a", lambda x: F.xxhash64(x)).alias("a"))
    none = F.array().cast("array<long>")
    got = df.select(P.peel(P.subtract(P.sketch(F.col("a"), size), P.sketch(none, size)), size).alias("p")).select("p.whole").collect()
    assert [r.whole for r in got] == [False, True]


def test_fingerprints_on_awkward_rows(spark):
    out = P.compare_with_edits(docs(spark)).collect()
    assert len(out) == len(ROWS) and all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in out)
    one = P.compare_with_edits(docs(spark, [(5, "abcdef", "en", "s")])).first()
    assert one.edited_sha256 == hashlib.sha256(b"abcabc").hexdigest() and one.near_next == 1.0
    assert P.compare_with_edits(empty(spark)).collect() == []


RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]


def judged(url):
    m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
    host, path = ("".join(c.lower() if "A" <= c <= "Z" else c for c in m[1]), m[2]) if m else ("", "")
    best = None
    for verdict, rule in RULES:
        h, _, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (best is None or len(rule) > len(best[1])):
            best = verdict, rule
    return host, path, best and best[1], best and best[0]


def test_rules_equal_brute_force(spark):
    urls = [f"{s}://{h}{p}{q}" for s in ("http", "HTTPS") for h in ("org", "example.org", "Blog.EXAMPLE.org", "notexample.org", "a.com", "x.net", "exampleXorg", "")
            for p in ("", "/", "/es/x", "/es", "/en/1", "/en/12.html", "/fr/3", "/de/a/b") for q in ("", "?page=2&ref=/de/", "#/fr/")]
    urls += ["", "no scheme", "a://b://c/de/", "http://x.com/de/\nnew", "://com/de/", None, "http://" + "a" * 50_000 + ".com/de/1"]
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)], "page_id long, url string, host string")
    got = {r.page_id: r for r in U.judge(pages, RULES, rounds=2).collect()}
    for i, u in enumerate(urls):
        host, path, rule, verdict = judged(u)
        r = got[i]
        assert (r.host, r.path, r.rule) == (host, path, rule), u
        assert r.verdict == (verdict or ("block" if r.score >= 0.5 else "allow")) and 0 <= r.score <= 1


def test_trees_learn_from_labelled_urls(spark):
    """Held-out accuracy on a rule that only the lexical features can show."""
    urls = [(f"http://h{i % 9}.net/{'p/' * (i % 5)}{'7' * (i % 13)}x{i}" + ("?a=1&b=2&c=3" if i % 2 else ""), i % 2) for i in range(600)]
    labelled = spark.createDataFrame(urls[:400], "url string, label int")
    rest = spark.createDataFrame([(i, u) for i, (u, _) in enumerate(urls[400:])], "page_id long, url string")
    got = {r.page_id: r.verdict for r in U.judge(rest, [], labelled, rounds=5).collect()}
    right = sum(got[i] == ("block" if y else "allow") for i, (_, y) in enumerate(urls[400:]))
    assert right >= 0.97 * 200


def test_url_filter_without_labels_or_rows(spark):
    pages = spark.createDataFrame([(1, "http://x.net/a"), (None, None)], "page_id long, url string")
    assert [(r.verdict, r.score) for r in U.judge(pages, RULES).collect()] == [("allow", 0.0)] * 2
    only = spark.createDataFrame([("http://a.b/", 1)], "url string, label int")
    assert [r.verdict for r in U.judge(pages, [], only).collect()] == ["block"] * 2
    assert U.judge(pages.limit(0), RULES).collect() == []


def test_entropy(spark):
    df = spark.createDataFrame([("aab",), ("",), ("x" * 1000,)], "s string")
    got = [r[0] for r in df.select(U.entropy(F.col("s"))).collect()]
    assert got == pytest.approx([-(2 / 3 * math.log2(2 / 3) + 1 / 3 * math.log2(1 / 3)), 0, 0])
