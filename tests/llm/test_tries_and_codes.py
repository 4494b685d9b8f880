"""Prefix trie (11), nearest neighbours by multi-index hashing (12), filter audit (13)."""

import binascii
import hashlib
import random
import re
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pytest
from llm_helpers import LONG, ROWS, docs, empty
from pyspark.sql import functions as F

from candlewick.llm import filter_audit as A
from candlewick.llm import hamming_search as H
from candlewick.llm import prefix_trie as P
from candlewick.llm.common import table

SF = "/root/testdata/sf0.01"


# -- 11 ---------------------------------------------------------------------------------------------------------------

def conversations(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns(
        {k: F.lit(1) for k in ("conv", "pos", "block", "w", "m", "depth", "words", "gid")})


def trie_by_hand(rows):
    """Every prefix of every rebuilt conversation, one by one."""
    said = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            said[c].append((turn is not None, turn or 0, role or "", text or ""))
    original = {c: [t[2:] for t in sorted(ts)] for c, ts in said.items()}
    whole = {}
    for c, ts in original.items():
        h = binascii.crc32(str(c).encode()) % 4
        whole[c] = original.get(c - int(np.fmod(c, 20)), [])[:h] + ts[h:]
    members, ends = defaultdict(list), defaultdict(list)
    for c, ts in sorted(whole.items()):
        for d in range(len(ts) + 1):
            members[tuple(ts[:d])].append(c)
        ends[tuple(ts)].append(c)
    n_words = lambda node: len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
    children = Counter(node[:-1] for node in members if node)
    out = []
    for node, of in members.items():
        below = [x for x in members if x[:len(node)] == node]
        out.append((min(of), len(node), min(members[node[:-1]]) if node else None, len(of), children[node], sum(not children[x] for x in below),
                    sum((len(members[x]) - 1) * n_words(x) for x in below), hashlib.sha256(",".join(map(str, ends[node])).encode()).hexdigest()))
    return sorted(out, key=repr)


TRIE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def found_trie(spark, rows, **options):
    out = P.trie(P.rebuilt(P.turns(conversations(spark, rows))), **options).select(*TRIE)
    return sorted((tuple(r) for r in out.collect()), key=repr)


@pytest.mark.parametrize("options", [{}, {"width": 3, "run": 2}, {"width": 1, "run": 3}])
def test_trie_equals_all_prefixes(spark, options):
    rnd = random.Random(5)
    rows = []
    for c in [*range(0, 70), *range(2000, 2006), -5, 2**40]:
        for t in range(rnd.choice([1, 2, 3, 5, 9, 30])):
            rows.append((c, t, rnd.choice(["user", "bot"]), rnd.choice(["a b", "c", "", "d e f"]) if t < 3 or rnd.random() < 0.1 else "same words here"))
    assert found_trie(spark, rows, **options) == trie_by_hand(rows)


def test_trie_on_awkward_rows(spark):
    rows = [(None, 0, "user", "nobody"), (1, None, None, None), (1, 2, "user", None), (1, 1, None, "x"), (20, 5, "user", "a"), (20, 5, "user", "a"),
            (21, 0, "", "role:"), (21, 1, ":", "x"), (22, 0, "user", LONG), (22, 1, "user", LONG + "."), (40, 0, "u", "漢 字 é"), (60, 1, "u", "a\tb\nc")]
    assert found_trie(spark, rows) == trie_by_hand(rows)
    assert found_trie(spark, [r for r in rows if r[0] is None] + rows[:0] or rows[:1]) == []
    assert P.trie(P.rebuilt(P.turns(conversations(spark, rows).limit(0)))).collect() == []


def test_ends_are_hashed_across_pieces_and_batches(spark, monkeypatch):
    monkeypatch.setattr(P, "PIECE_BITS", 2)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        rows = [(c, t, "u", "hello") for c in range(100, 160) for t in range(4)] + [(c, 0, "u", f"own {c}") for c in range(300, 310)]
        assert found_trie(spark, rows) == trie_by_hand(rows)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


# -- 12 ---------------------------------------------------------------------------------------------------------------

def nearest_by_hand(x, ids, i, k):
    scores = np.zeros(len(x))
    for d in range(x.shape[1]):  # in the order of the components
        scores += x[:, d] * x[i, d]
    return [j for j in np.lexsort((ids, -scores)) if j != i][:k], scores


def test_probing_retrieves_every_code_within_the_radius():
    rnd = np.random.default_rng(2)
    parts = rnd.integers(0, 2**16, (500, 4)).astype(np.uint16)
    parts[100:] = parts[:400] ^ (rnd.random((400, 4, 16)) < 0.2).dot(1 << np.arange(16)).astype(np.uint16)
    index = H.Index(parts)
    words = parts.view(np.uint64)
    for radius in (0, 1, 2, 3, 5, 11, 20, 64):
        for i in (0, 7, 120):
            apart = np.bitwise_count(words ^ words[i]).sum(axis=1)
            assert index.within(parts[i], radius).tolist() == np.flatnonzero(apart <= radius).tolist()
    assert len(index.find(parts[0], 0, 30)) >= 30 and len(index.find(parts[0], 0, 10**6)) == 500


def test_recall_against_brute_force(spark):
    vectors = table(spark, "/root/testdata/sf0.1", "embeddings")
    rows = vectors.select("vec_id", "embedding").collect()
    x, ids = np.array([r.embedding for r in rows], np.float64), np.array([r.vec_id for r in rows])
    got = defaultdict(list)
    for r in sorted(H.search(vectors, F.col("vec_id") % 20 == 0).collect(), key=lambda r: (r.query_id, r.rank)):
        got[r.query_id].append(r)
    assert sorted(got) == [i for i in sorted(ids) if i % 20 == 0]
    right = 0
    for i in np.flatnonzero(ids % 20 == 0):
        want, scores = nearest_by_hand(x, ids, i, 20)
        found = got[ids[i]]
        assert [r.rank for r in found] == list(range(1, 21))
        by_id = dict(zip(ids.tolist(), scores.tolist(), strict=True))
        assert all(r.score == by_id[r.vec_id] for r in found)  # to the last bit
        assert [(-r.score, r.vec_id) for r in found] == sorted((-r.score, r.vec_id) for r in found)
        right += len({r.vec_id for r in found} & set(ids[want].tolist()))
    assert right / (20 * len(got)) >= 0.95


def test_recall_with_uneven_lengths_and_many_cells(spark):
    rnd = np.random.default_rng(3)
    x = rnd.normal(size=(1500, 24)) * np.exp(rnd.normal(size=(1500, 1)))
    vectors = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = H.search(vectors, F.col("vec_id") % 20 == 0, k=10, rows_per_shard=200, queries_per_block=10).collect()
    right = sum(r.vec_id in {int(j) for j in nearest_by_hand(x, np.arange(1500), r.query_id, 10)[0]} for r in got)
    assert len(got) == 750 and right / 750 >= 0.9


def test_search_on_awkward_rows(spark):
    same = [1.0, 2.0, 3.0]
    rows = [(i, same) for i in range(19, 50)] + [(0, [3.0, 2.0, 1.0]), (0, [3.0, 2.0, 1.0]), (None, same), (100, None), (120, [0.0, 0.0, 0.0]), (140, [1.0, None, 2.0]),
            (160, [float("nan"), 1.0, 2.0]), (180, [float("inf"), 1.0, 1.0]), (200, [1.0, 2.0]), (220, []), (61, [-1e-3, 0.0, 0.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({c: F.lit(1) for c in ("id", "v", "uid", "class", "score", "rank", "q")})
    got = defaultdict(list)
    for r in sorted(H.search(vectors, F.col("vec_id") % 20 == 0).collect(), key=lambda r: (r.query_id, r.rank)):
        got[r.query_id].append((r.vec_id, r.score))
    assert sorted(got) == [0, 20, 40]
    assert got[20] == [(i, 14.0) for i in [19, *range(21, 40)]] and got[40] == [(i, 14.0) for i in range(19, 39)]
    assert [r[0] for r in got[0]].count(0) == 2  # two rows of one id: each finds the other
    assert H.search(vectors.limit(0), F.col("vec_id") % 20 == 0).collect() == []
    few = H.search(vectors.where("vec_id IN (0, 61) OR vec_id IS NULL"), F.col("vec_id") % 20 == 0).collect()
    assert len(few) == 6 and {r.vec_id for r in few} == {0, 61, None}
    alone = H.search(vectors.where("vec_id = 40"), F.col("vec_id") % 20 == 0)
    assert alone.collect() == [] and alone.columns == ["query_id", "rank", "vec_id", "score"]


# -- 13 ---------------------------------------------------------------------------------------------------------------

def mask_by_hand(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return ((len(words) < 50) | (100 * len(set(words)) < 65 * len(words)) << 1 | (100 * len(re.findall("[A-Z]", text)) > 5 * len(text)) << 2
            | bool(re.search(r"[#$%&*|]", text)) << 3)


def masks_by_hand(rows):
    least = {}
    for i, text, *_ in rows:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    return [(i, source or "", mask_by_hand(text or "") | (i is not None and i > least[text or ""]) << 4) for i, text, _, source in rows]


def audit_by_hand(masks, labels):
    good, bad = ({i for i, q, t in labels if (q, t)[k] == 1} for k in (0, 1))
    out = []
    for part in {p for _, p, _ in masks}:
        own = [(i, {f for k, f in enumerate("ABCDE") if m >> k & 1}) for i, p, m in masks if p == part]
        removed = {}
        for order in map("".join, permutations("ABCDE")):
            for s, f in enumerate(order):
                removed[order, s] = [i for i, fails in own if f in fails and not fails & set(order[:s])]
        shapley = Counter()
        for (order, s), r in removed.items():
            shapley[order[s]] += len(r)
        for (order, s), r in removed.items():
            f, seen = order[s], set(order[:s])
            out.append((part, order, s + 1, sum(not fails & (seen | {f}) for _, fails in own), len(r), sum(f in fails and bool(fails & seen) for _, fails in own),
                        sum(fails == {f} for _, fails in own), sum(i in good for i in r), sum(i in bad for i in r), shapley[f]))
    return sorted(out)


def many_texts():
    rnd = random.Random(8)
    shared = "A licence line that many documents share, word for word. " * 6
    rows = []
    for i in range(400):
        kind = rnd.randrange(6)
        text = [lambda: shared + str(rnd.randrange(40)), lambda: "copy of one text", lambda: " ".join(rnd.choice("abcdefgh") + str(rnd.randrange(90)) for _ in range(rnd.randrange(120))),
                lambda: "X" * rnd.randrange(60), lambda: "".join(rnd.choice("漢字é#A ") for _ in range(rnd.randrange(9))), lambda: LONG[: rnd.choice([3000, 3001, 9000])]][kind]()
        rows.append((rnd.randrange(1000), text, "en", rnd.choice(["s1", "s2", None, ""])))
    return rows


def test_tries_find_the_least_id_of_every_text():
    rnd = random.Random(1)
    texts = ["".join(rnd.choice("ab") for _ in range(rnd.randrange(9))) * rnd.choice([1, 1, 30]) for _ in range(600)]
    tree, least = A.Trie(), {}
    for i, t in enumerate(texts):
        n = (i * 7919) % 1009
        assert tree.least[tree.insert(t, n)] <= n
        least[t] = min(n, least.get(t, n))
    walked = [(t, tree.least[k]) for t, k in tree.walk()]
    assert dict(walked) == least and [t for t, _ in walked] == sorted(least)


@pytest.mark.parametrize("small", [False, True])
def test_audit_equals_every_order_by_hand(spark, monkeypatch, small):
    rows = many_texts()
    if small:  # many chunks, many ranges
        monkeypatch.setattr(A, "CHUNK", 2000)
        monkeypatch.setattr(A, "ROWS", 7)
    masks = A.fail_masks(docs(spark, rows).repartition(3), range_size=6000 if small else None)
    got = [tuple(r) for r in masks.collect()]
    assert Counter(got) == Counter(masks_by_hand(rows))
    if small:
        return
    labels = [(i, i % 2, i % 3 == 0) for i in range(0, 1000, 2)] + [(4, 1, 1), (4, 0, 0), (None, 1, 1), (6, None, None)]
    frame = spark.createDataFrame([(i, q if q is None else int(q), t if t is None else int(t)) for i, q, t in labels], "doc_id long, quality int, toxic int")
    out = A.audit(masks, frame).collect()
    assert sorted(tuple(r) for r in out) == audit_by_hand(got, [(i, q, t) for i, q, t in labels])


def test_ranges_split_long_shared_prefixes_and_hold_what_they_may(spark):
    shared = "same start " * 50
    texts = [shared + f"{i:03d}" + "z" * 40 for i in range(60)] * 2 + ["equal " * 200] * 5 + [shared] * 2 + ["", "", "a", "b" * 700]
    texts += [shared + "x" * 300 + "tail"] * 30 + [shared + "x" * 300 + "tall"] * 30  # one length, other only behind 850 characters
    frame = spark.createDataFrame([(0, i, t) for i, t in enumerate(texts)], "chunk long, terminal long, text string")
    out = {r.terminal: r["range"] for r in A._ranges(frame, 3000).collect()}
    assert {texts[i] for i in range(len(texts)) if i not in out} == {"a", "b" * 700}  # alone with their start and length
    by_range = defaultdict(list)
    for i, r in out.items():
        by_range[r].append(texts[i])
    # a range starts at less than ``most`` and ends with the prefix that goes beyond
    assert len(by_range) > 10 and all(sum(map(len, ts)) <= 6000 or len(set(ts)) == 1 for ts in by_range.values())
    assert all(len({out[i] for i, t in enumerate(texts) if t == own}) == 1 for own in {texts[i] for i in out})


def test_audit_on_awkward_and_empty_tables(spark):
    masks = A.fail_masks(docs(spark))
    assert Counter(tuple(r) for r in masks.collect()) == Counter(masks_by_hand(ROWS))
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    out = A.audit(masks, labels).collect()
    assert len(out) == 600 * len({r[3] or "" for r in ROWS}) and all(r.good_lost == r.toxic_lost == 0 for r in out)
    assert A.audit(A.fail_masks(empty(spark)), labels).collect() == []
