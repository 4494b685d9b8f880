"""Exact dedup (9), n-gram Jaccard join (2), line dedup (8)."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest
from llm_helpers import LONG, ROWS, docs, empty
from pyspark.sql import functions as F

from candlewick.llm import exact_dedup as E
from candlewick.llm import jaccard_join as J
from candlewick.llm import line_dedup as L


def test_exact_dedup_equals_brute_force_on_awkward_rows(spark):
    got = [(r.doc_id, r.keep_id, r.group_size, r.digest) for r in E.dedup(docs(spark)).collect()]
    groups = defaultdict(list)
    for i, t, *_ in ROWS:
        groups[t or ""].append(i)
    want = []
    for t, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        want += [(i, keep, len(ids), hashlib.sha256(t.encode()).hexdigest()) for i in ids]
    assert Counter(got) == Counter(want)


def test_one_row_of_each_text_stays(spark):
    kept = E.distinct_texts(docs(spark))
    assert kept.columns == docs(spark).columns
    assert sorted((r.doc_id is not None, r.doc_id or 0) for r in kept.collect()) == \
        sorted((i is not None, i or 0) for i in (2, 4, 5, 6, None, 7, 8))


def test_texts_that_share_a_digest_are_told_apart_by_their_bytes(spark):
    rows = [(i, f"text {i % 5}", "en", "s") for i in range(40)]
    weak = lambda text: F.substring(E.sha256(text), 1, 0)  # noqa: E731  every digest is equal
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in E.dedup(docs(spark, rows), digest=weak).collect()}
    assert got == {i: (35 + i % 5, 8, i >= 35) for i in range(40)}


def test_state_goes_on_over_several_batches(spark, tmp_dir):
    landed = spark.createDataFrame([("a", 1, "f", 0), ("b", 2, "f", 1), ("a", 3, "f", 2), ("a", 2, "f", 3)],
                                   "digest string, id long, file string, pos long")
    landed.repartition(4).write.parquet(f"{tmp_dir}/landed")
    state = E.keyed_state(landed, f"{tmp_dir}/landed", files_per_trigger=1)
    assert {r.digest: (r.keep["id"], r.n) for r in state.collect()} == {"a": (3, 3), "b": (2, 1)}


def test_session_settings_are_put_back(spark):
    before = spark.conf.get(E.PROVIDER)
    E.dedup(docs(spark, [(1, "a", "en", "s")])).collect()
    assert spark.conf.get(E.PROVIDER) == before


def test_exact_dedup_of_an_empty_table(spark):
    assert E.dedup(empty(spark)).collect() == []
    assert E.distinct_texts(empty(spark)).columns == docs(spark).columns


def shingles(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if len(words) >= k:
        return {tuple(words[i:i + k]) for i in range(len(words) - k + 1)}
    return {tuple(words)} if words else set()


def linked(rows, k, num, den):
    sets = [shingles(t, k) for _, t, *_ in rows]
    comp = list(range(len(rows)))

    def top(i):
        while comp[i] != i:
            i = comp[i]
        return i

    for a in range(len(rows)):
        for b in range(a):
            union, shared = len(sets[a] | sets[b]), len(sets[a] & sets[b])
            if union and den * shared >= num * union:
                comp[max(top(a), top(b))] = min(top(a), top(b))
    members = defaultdict(list)
    for i in range(len(rows)):
        members[top(i)].append(i)
    out = []
    for group in members.values():
        least = min((rows[i][0] for i in group if rows[i][0] is not None), default=None)
        out += [(rows[i][0], len(sets[i]), least if sets[i] else rows[i][0]) for i in group]
    return Counter(out)


def near_copies(seed, n, words=60):
    """Chains of copies: each a few edits away from an earlier text, so that similarities lie all around the threshold."""
    rnd = random.Random(seed)
    texts = [[f"w{rnd.randrange(400)}" for _ in range(rnd.choice([2, 5, words, 3 * words]))] for _ in range(n // 4)]
    while len(texts) < n:
        t = list(rnd.choice(texts))
        for _ in range(rnd.choice([0, 1, 1, 2, 4, 9])):
            if t:
                t[rnd.randrange(len(t))] = f"w{rnd.randrange(400)}"
        if rnd.random() < 0.3:
            t = t + [f"w{rnd.randrange(400)}" for _ in range(rnd.randrange(6))]
        texts.append(t)
    passage = " ".join(f"shared{i}" for i in range(25))
    return [(i, " ".join(t) + (" " + passage if i % 3 == 0 else ""), "en", "s") for i, t in enumerate(texts)]


@pytest.mark.parametrize("k, num, den, sizes", [
    (3, 9, 10, {}), (5, 8, 10, {}), (3, 6, 10, {"leaf": 3, "pivots": 2, "levels": 4}), (2, 5, 10, {"leaf": 2, "pivots": 3, "levels": 3}),
])
def test_jaccard_join_equals_brute_force(spark, k, num, den, sizes):
    rows = near_copies(k + num, 160)
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in J.join(docs(spark, rows), k, num, den, **sizes).collect())
    assert got == linked(rows, k, num, den)


def test_jaccard_join_on_awkward_rows(spark):
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in J.join(docs(spark), 3, 9, 10).collect())
    assert got == linked(ROWS, 3, 9, 10)


def test_jaccard_join_of_an_empty_table_and_kept_columns(spark):
    assert J.join(empty(spark)).collect() == []
    kept = J.one_of_each(docs(spark))
    assert kept.columns == docs(spark).columns
    assert {r.doc_id for r in kept.collect()} == {1, 3, 4, 5, 6, None, 7, 8}


def test_one_row_of_each_component_stays_where_ids_repeat(spark):
    base = [f"w{k}" for k in range(60)]
    near = lambda n: " ".join([*base, *(f"more{k}" for k in range(n))])
    alone = [" ".join(f"{x}{k}" for k in range(30)) for x in "abcd"]
    rows = [(1, near(0), "en", "s"), (1, near(1), "en", "s"),  # two near copies under the smallest id
            (2, near(2), "en", "s"), (2, alone[0], "en", "s"),  # a near copy and a text of its own under one id
            (None, near(1), "en", "s"), (None, alone[1], "en", "s"),
            (3, alone[2], "en", "s"), (3, alone[2], "en", "s"), (4, alone[3], "en", "s"), (5, None, "en", "s"), (5, "", "en", "s")]
    kept = Counter((r.doc_id, r.text) for r in J.one_of_each(docs(spark, rows)).collect())
    ones = Counter([(2, alone[0]), (None, alone[1]), (3, alone[2]), (4, alone[3]), (5, None), (5, "")])
    assert kept - ones in (Counter([(1, near(0))]), Counter([(1, near(1))])) and ones - kept == Counter()


def test_partners_meet_in_a_region():
    """Pigeonhole: sets within the threshold always share a region, whatever their sizes and empty projections."""
    import numpy as np

    rnd = random.Random(5)
    for num, den in ((9, 10), (8, 10), (1, 2)):
        intervals = J.Intervals(num, den)
        for _ in range(300):
            n = rnd.choice([1, 2, 3, 5, 9, 10, 11, 20, 47, 100, 333])
            x = {rnd.getrandbits(64) for _ in range(n)}
            y = set(x)
            while True:  # as far from x as the threshold allows
                z = set(y)
                (z.discard(rnd.choice(sorted(z))) if rnd.random() < 0.5 and len(z) > 1 else z.add(rnd.getrandbits(64)))
                if den * len(x & z) < num * len(x | z):
                    break
                y = z
            keys = [set(J._regions(np.array(sorted(s), np.uint64), intervals).tolist()) for s in (x, y)]
            assert keys[0] & keys[1], (num, den, len(x), len(y), len(x & y))


def test_a_long_text_is_read_in_pieces(monkeypatch):
    whole = J.shingle_sets([LONG], 3)[0]
    monkeypatch.setattr(J, "PIECE", 1000)
    assert (J.shingle_sets([LONG], 3)[0] == whole).all()
    assert len(whole) == len(shingles(LONG, 3))


def brute_lines(rows):
    """The chunks by the rule, then the first of each body stays."""
    import xxhash

    def h64(v, seed):
        return xxhash.xxh64_intdigest(v, seed)

    def signed(v):
        return v - 2**64 if v >= 2**63 else v

    def long_hash(v, seed):
        return h64((v % 2**64).to_bytes(8, "little"), seed)

    chunks = []
    for i, t, *_ in rows:
        if t is None:
            continue
        lines = t.split("\n")
        hashes = [h64(x.encode(), 42) for x in lines]
        start = 0
        for e in range(1, len(lines) + 1):
            acc = 0
            for v in hashes[max(0, e - L.WINDOW):e]:
                acc = long_hash(v, long_hash(acc, 42))
            if e == len(lines) or (e >= L.WINDOW and signed(acc) % L.DIVISOR == 0):
                if e - start >= L.MIN_LINES and "\n".join(lines[start:e]).strip():
                    chunks.append((i, start, e, "\n".join(lines[start:e])))
                start = e
    first = {}
    for i, s, e, body in chunks:
        first[body] = min(first.get(body, (float("inf"), 0)), (i, s))
    out = {}
    for i, t, *_ in rows:
        lines = t.split("\n")
        gone = {k for j, s, e, body in chunks if j == i and first[body] != (i, s) for k in range(s, e)}
        out[i] = ("\n".join(x for k, x in enumerate(lines) if k not in gone), len(gone))
    return out


def test_line_dedup_equals_brute_force(spark):
    rnd = random.Random(2)
    passages = [[f"passage {p} line {i} {rnd.randrange(99)}" for i in range(rnd.randrange(2, 12))] for p in range(6)]
    rows = []
    for i in range(60):
        lines = [f"own {i} {k}" for k in range(rnd.randrange(0, 5))]
        for _ in range(rnd.randrange(0, 3)):
            lines += rnd.choice(passages) + [f"own {i} more {rnd.random()}"]
        rows.append((i, "\n".join(lines), "en", "s"))
    got = {r.doc_id: (r.text, r.removed_lines) for r in L.dedup_lines(docs(spark, rows)).collect()}
    want = brute_lines(rows)
    assert got == want
    assert sum(n for _, n in want.values()) > 20


def test_line_dedup_on_awkward_rows(spark):
    out = L.dedup_lines(docs(spark))
    assert set(docs(spark).columns) < set(out.columns)
    got = {}
    for r in out.collect():
        got.setdefault(r.doc_id, []).append((r.text, r.n_lines, r.removed_lines))
    assert got[3] == [(None, 0, 0)] and got[4] == [("", 1, 0)] and got[5] == [("   \n\t ", 2, 0)]
    assert got[6] == [(LONG, 4000, 0)] * 2  # rows with the same id and text are one document
    assert len(got[None]) == 1
    assert L.dedup_lines(empty(spark)).collect() == []


def test_boundaries_move_with_the_lines(spark):
    """Lines inserted in front change no boundary behind the window."""
    body = [f"line {i}" for i in range(200)]
    rows = [(1, "\n".join(body), "en", "s"), (2, "\n".join(["x", "y", "z", *body]), "en", "s")]
    out = {r.doc_id: r.removed_lines for r in L.dedup_lines(docs(spark, rows)).collect()}
    assert out[1] == 0 and out[2] > 0.5 * 200


def brute_passages(rows):
    """Lines that, in a run of MIN_LINES, equal lines at a smaller place that they do not overlap."""
    texts = sorted((i, t.split("\n")) for i, t, *_ in rows)
    seen, gone = [], defaultdict(set)
    for i, lines in texts:
        for k in range(len(lines) - L.MIN_LINES + 1):
            run = lines[k:k + L.MIN_LINES]
            if "".join(run).strip() and any(r == run and (j != i or m + L.MIN_LINES <= k) for j, m, r in seen):
                gone[i] |= set(range(k, k + L.MIN_LINES))
            seen.append((i, k, run))
    return {i: ("\n".join(x for k, x in enumerate(lines) if k not in gone[i]), len(gone[i])) for i, lines in texts}


def test_every_repeated_run_of_lines_goes(spark):
    """Recall 1 against brute force: short passages between a document's own lines, runs of one line, blank lines."""
    rnd = random.Random(7)
    passages = [[f"passage {p} line {i}" for i in range(2 + p % 5)] for p in range(12)] + [["same"] * 7, ["", "", "end"], ["", " "]]
    rows = []
    for i in range(50):
        lines = [f"own {i}"]
        for k in range(rnd.randrange(4)):
            lines += rnd.choice(passages) + [f"own {i} {k}"] * rnd.randrange(1, 4)
        rows.append((i, "\n".join(lines), "en", "s"))
    got = {r.doc_id: (r.text, r.removed_lines) for r in L.dedup_lines(docs(spark, rows), repeated=L.repeated_passages).collect()}
    want = brute_passages(rows)
    assert got == want
    by_chunks = sum(n for _, n in brute_lines(rows).values())
    assert sum(n for _, n in want.values()) > 2 * by_chunks > 0
    lines = lambda texts: {x for t in texts for x in t.split("\n") if x.strip()}
    assert lines(t for t, _ in got.values()) == lines(t for _, t, *_ in rows)  # each line stays somewhere


def test_repeated_passages_on_awkward_rows(spark):
    out = L.dedup_lines(docs(spark), repeated=L.repeated_passages)
    assert set(docs(spark).columns) < set(out.columns)
    got = {}
    for r in out.collect():
        got.setdefault(r.doc_id, []).append((r.text, r.n_lines, r.removed_lines))
    assert got[1] == [(ROWS[0][1], 2, 0)] and got[2] == [("", 2, 2)]
    assert got[3] == [(None, 0, 0)] and got[4] == [("", 1, 0)] and got[5] == [("   \n\t ", 2, 0)]
    assert got[6] == [(LONG, 4000, 0)] * 2 and len(got[None]) == 1
    assert L.dedup_lines(empty(spark), repeated=L.repeated_passages).collect() == []
    rows = [(1, LONG, "en", "s"), (1, "own\n" + LONG, "en", "s"), (None, "x\ny", "en", "s"), (2, "x\ny\nz", "en", "s")]
    got = Counter((r.doc_id, r.text) for r in L.dedup_lines(docs(spark, rows), repeated=L.repeated_passages).collect())
    assert got == Counter([(1, LONG), (1, "own"), (None, "x\ny"), (2, "z")])


def by_chunks_alone(spark, rows):
    """Lines that go with a whole chunk, by ``repeated_runs``."""
    chunks, _ = L.runs(docs(spark, rows))
    return sum(r.n for r in chunks.collect())


def test_chunks_and_what_they_leave_equal_brute_force(spark):
    """Recall 1 with chunks first: short and long passages, runs of one line, blank lines, insertions, copies."""
    rnd = random.Random(11)
    passages = [[f"passage {p} line {i}" for i in range(2 + p * 3 % 17)] for p in range(12)] + [
        ["same"] * 9, ["", "", "end"], ["", " "], ["a", "", "", "", "b"], ["", "", "", "head", "tail", "", ""]]
    rows = []
    for i in range(60):
        lines = [f"own {i}"]
        for k in range(rnd.randrange(5)):
            passage = rnd.choice(passages)
            at = rnd.randrange(len(passage) + 1)
            lines += [*passage[:at], f"put in {i}", *passage[at:]] if rnd.random() < 0.3 else passage
            lines += [f"own {i} {k}"] * rnd.randrange(0, 3)
        rows.append((i, "\n".join(lines), "en", "s"))
    rows += [(100 + i, t, "en", "s") for i, t, *_ in rows[:9]]
    got = {r.doc_id: (r.text, r.removed_lines) for r in L.dedup_lines(docs(spark, rows), repeated=L.repeated_runs).collect()}
    want = brute_passages(rows)
    assert got == want
    assert by_chunks_alone(spark, rows) > sum(n for _, n in want.values()) / 3  # many of these passages have two lines


def test_spaced_boundaries_leave_no_chunk_of_one_line(spark):
    lines = [f"line {i % 37} {i // 50}" for i in range(600)] + ["same"] * 50
    frame = docs(spark, [(1, "\n".join(lines), "en", "s")]).select(F.split("text", "\n").alias("lines"))
    ends = frame.select(L.spaced_ends(L.rolling_hashes(F.col("lines")), F.size("lines")).alias("ends")).first().ends
    sizes = [b - a for a, b in zip([0, *ends], ends)]
    assert ends[-1] == 650 and min(sizes[:-1]) >= L.MIN_LINES and 650 / 8 < len(ends) < 650 / 2
    # lines put in front move no boundary behind them
    more = docs(spark, [(1, "\n".join(["x", "y", *lines]), "en", "s")]).select(F.split("text", "\n").alias("lines"))
    moved = more.select(L.spaced_ends(L.rolling_hashes(F.col("lines")), F.size("lines")).alias("ends")).first().ends
    assert {e + 2 for e in ends if e > 3} <= set(moved)


def test_repeated_runs_on_awkward_rows(spark):
    out = L.dedup_lines(docs(spark), repeated=L.repeated_runs)
    assert set(docs(spark).columns) < set(out.columns)
    got = {}
    for r in out.collect():
        got.setdefault(r.doc_id, []).append((r.text, r.n_lines, r.removed_lines))
    assert got[1] == [(ROWS[0][1], 2, 0)] and got[2] == [("", 2, 2)]
    assert got[3] == [(None, 0, 0)] and got[4] == [("", 1, 0)] and got[5] == [("   \n\t ", 2, 0)]
    assert got[6] == [(LONG, 4000, 0)] * 2 and len(got[None]) == 1
    assert L.dedup_lines(empty(spark), repeated=L.repeated_runs).collect() == []
    rows = [(1, LONG, "en", "s"), (1, "own\n" + LONG, "en", "s"), (None, "x\ny", "en", "s"), (2, "x\ny\nz", "en", "s")]
    got = Counter((r.doc_id, r.text) for r in L.dedup_lines(docs(spark, rows), repeated=L.repeated_runs).collect())
    assert got == Counter([(1, LONG), (1, "own"), (None, "x\ny"), (2, "z")])


@pytest.mark.parametrize("first", [16, 1, 0])
def test_a_group_of_near_misses_in_many_regions(spark, monkeypatch, first):
    """A group whose members are mostly just below the threshold of each other equals brute force, whether the regions
    that a pair shares are known or not."""
    monkeypatch.setattr(J, "FIRST", first)
    rnd = random.Random(9)
    base = [f"w{i}" for i in range(80)]
    rows = [(i, " ".join(w if rnd.random() > 0.035 else f"x{rnd.randrange(10**6)}" for w in base), "en", "s") for i in range(60)]
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in J.join(docs(spark, rows), 3, 8, 10, leaf=4, pivots=2).collect())
    assert got == linked(rows, 3, 8, 10) and len({c for *_, c in got}) > 5
