"""Toxicity (6), quality classifier (7), SentencePiece (10) and the pipeline."""

import binascii
import itertools
import random
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from llm_helpers import LONG, ROWS, docs, empty
from pyspark.sql import functions as F

import corpus_pipeline
from candlewick.llm import chars
from candlewick.llm import pieces as P
from candlewick.llm import quality as Q
from candlewick.llm import toxicity as X
from candlewick.llm.common import crc_fold, id_filter, labelled_rows, maybe_in, table

SF = "/root/testdata/sf0.01"


def held_out(i):
    return binascii.crc32(str(i).encode()) % 5 == 0


def auc(scores, labels):
    order = np.argsort(np.argsort(scores))
    y = np.asarray(labels)
    return (order[y == 1].sum() - (y == 1).sum() * ((y == 1).sum() - 1) / 2) / ((y == 1).sum() * (y == 0).sum())


def test_only_rows_outside_the_held_out_fold_are_learned_from(spark):
    rows = labelled_rows(table(spark, SF, "documents"), table(spark, SF, "labels"), "toxic", 50).collect()
    assert rows and not any(held_out(r.id) for r in rows)
    assert max(Counter(r.label for r in rows).values()) <= 50
    df = spark.createDataFrame([(i,) for i in range(100)] + [(None,)], "i long")
    assert [r[0] == 0 for r in df.select(crc_fold(F.col("i"))).collect()] == [*map(held_out, range(100)), True]


def test_the_join_filter_keeps_every_key(spark):
    keys = spark.range(0, 1000, 7).select(F.xxhash64("id").alias("h"))
    rest = maybe_in(spark.range(1000), F.xxhash64("id"), id_filter(keys, "h"))
    got = {r.id for r in rest.collect()}
    assert set(range(0, 1000, 7)) <= got and len(got) < 200


def test_words_and_classes():
    text = "Ab  c,d\n\té漢!  x"
    codes = chars.codes_of(text)
    starts, ends, hashes = chars.words_of(codes, chars.classes_of(codes))
    assert [text[a:b] for a, b in zip(starts, ends, strict=True)] == text.split()
    again = chars.words_of(chars.codes_of("x c,d Ab"), chars.classes_of(chars.codes_of("x c,d Ab")))[2]
    assert again.tolist() == [hashes[3], hashes[1], hashes[0]]
    assert "\n".join(chars.cut(LONG, 999)) == LONG and max(map(len, chars.cut(LONG, 999))) < 999


def test_marginals_equal_all_labellings():
    rnd = np.random.default_rng(1)
    chain = Q.Chain(np.zeros(3), np.ones(3), rnd.normal(size=4), rnd.normal(size=(2, 2)))
    lines = np.array([1, 5, 3])
    x = rnd.normal(size=(9, 3))
    got = Q.marginals(chain, x, lines)
    s, at, want = chain.line_scores(x), 0, []
    for n in lines:
        total, good = 0.0, np.zeros(n)
        for y in itertools.product((0, 1), repeat=int(n)):
            w = np.exp(sum(s[at + k] for k in range(n) if y[k]) + sum(chain.moves[a, b] for a, b in zip(y, y[1:], strict=False)))
            total += w
            good += w * np.array(y)
        want += list(good / total)
        at += n
    np.testing.assert_allclose(got, want)


def test_fitting_reads_no_unset_memory(monkeypatch):
    """Chains of different lengths: whatever memory held before, the weights are finite and the same."""
    rnd = np.random.default_rng(7)
    lines, labels = np.array([1, 9, 4, 2]), np.array([0, 1, 0, 1])
    x = rnd.normal(size=(16, 3)) + np.repeat(labels, lines)[:, None]
    want = Q.fit(x, lines, labels, steps=20)
    monkeypatch.setattr(Q.np, "empty_like", lambda a, *_, **__: np.full_like(a, np.nan))
    got = Q.fit(x, lines, labels, steps=20)
    assert np.isfinite(got.weights).all() and np.array_equal(got.weights, want.weights) and np.array_equal(got.moves, want.moves)


def test_line_features_look_at_neighbours_and_not_beyond_the_text(monkeypatch):
    a, b = "One line.\nTWO two two", "!!! ###\n\nlast"
    x, length, lines = Q.features([a, b])
    assert lines.tolist() == [2, 3] and length.tolist() == [9, 11, 7, 0, 4]
    n = Q.N_BASE
    np.testing.assert_allclose(x[1, n:2 * n], x[0, :n])
    np.testing.assert_allclose(x[0, 2 * n:3 * n], x[1, :n])
    assert not x[2, n:2 * n].any() and not x[1, 2 * n:3 * n].any()
    whole = Q.features([LONG])[0]
    monkeypatch.setattr(Q, "PIECE", 500)
    np.testing.assert_allclose(Q.features([LONG])[0], whole)


def _accuracy(spark, train, score, label):
    documents, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    model = train(documents, labels)
    rows = documents.join(labels, "doc_id").where(crc_fold(F.col("doc_id")) == 0)
    got = rows.select(label, score(model, F.col("text")).alias("p")).collect()
    return np.array([r.p for r in got]), np.array([r[label] for r in got])


def test_quality_on_held_out_documents(spark):
    p, y = _accuracy(spark, Q.train, Q.score, "quality")
    assert ((0 <= p) & (p <= 1)).all() and auc(p, y) > 0.97
    assert (p[y == 1] >= 0.3).mean() > 0.97 and (p[y == 0] < 0.3).mean() > 0.9


def test_toxicity_on_held_out_documents(spark):
    p, y = _accuracy(spark, X.train, X.score, "toxic")
    assert ((0 <= p) & (p <= 1)).all() and auc(p, y) > 0.95


@pytest.fixture(scope="module")
def machine(spark):
    rnd = random.Random(4)
    bad, plain = ["idiot", "moron", "stupid"], [f"{a}{b}{c}" for a in "bdfg" for b in "aeou" for c in ("lor", "ren", "tav", "mus")]
    rows = []
    for i in range(400):
        t = [" ".join(rnd.choice(plain) for _ in range(8)) + "." for _ in range(4)]
        if i % 2:
            k = rnd.randrange(4)
            t[k] = f"{rnd.choice(plain)} {rnd.choice(bad)} {t[k]}"
        rows.append((i, "\n".join(t), "en", "s"))
    labels = spark.createDataFrame([(i, i % 2) for i in range(400)], "doc_id long, toxic int")
    return X.train(docs(spark, rows), labels)


def test_inserted_and_gapped_letters_are_tolerated(machine):
    score = lambda *t: X.Scorer(machine).score(list(t))
    assert (score("balor you idiot.", "an id-iot", "i d i o t", "S.T.U.P.I.D man", "IDIOT!!", "stuupid", "a moroon") > 0.5).all()
    assert (score("balor duren fomus.", "", "   ", "a b", "...") < 0.5).all()


def test_a_long_text_scores_its_worst_sentence(machine, monkeypatch):
    long = "\n".join(["balor duren fomus."] * 3000)
    whole = X.Scorer(machine).score([long, long + "\nyou idiot.", "you idiot."])
    assert whole[0] < 0.5 and whole[1] == pytest.approx(whole[2])
    monkeypatch.setattr(X, "PIECE", 2000)
    np.testing.assert_allclose(X.Scorer(machine).score([long, long + "\nyou idiot.", "you idiot."]), whole, rtol=1e-6)


def test_spelled_words_end_with_their_text(machine):
    """Texts scored together score as each alone: a run of single letters doesn't go on into the next text."""
    texts = ["balor plan b", "i d i o t", "duren x y", "z fomus", "", "s t", "u p i d", "a", "m o r o n b", "i d i o t"]
    alone = [X.Scorer(machine).score([t])[0] for t in texts]
    np.testing.assert_allclose(X.Scorer(machine).score(texts), alone, rtol=1e-6)
    assert alone[1] > 0.5 > alone[0]


def test_a_long_text_below_the_bias_scores_as_a_short_one(machine, monkeypatch):
    mild = X.Machine(machine.kernel, -np.ones_like(machine.beta), 1.0)  # words only lower the bias
    texts = ["\n".join(["you idiot.", "stupid moron idiot."] * 500), " \n" * 2000, "you idiot.", ""]
    whole = X.Scorer(mild).score(texts)
    assert whole[0] == pytest.approx(whole[2]) and whole[0] < whole[1] == whole[3]
    monkeypatch.setattr(X, "PIECE", 1000)
    np.testing.assert_allclose(X.Scorer(mild).score(texts), whole, rtol=1e-6)


def test_kernel_equals_its_definition(machine):
    def weights(w):
        out = Counter()
        for i in range(len(w)):
            for a, b in X._OFFSETS:
                if i + b < len(w):
                    out[w[i] + w[i + a] + w[i + b]] += X.DECAY ** (b + 1)
        return out

    words = ["idiot", "idxiot", "abc", "ab", "mooron", "stupidly"]
    got = machine.kernel.of(words)
    for k, u in enumerate(words):
        for j, v in enumerate(machine.kernel.landmarks):
            a, b = weights(u), weights(v)
            inner = sum(a[t] * b[t] for t in a)
            norm = float(X._norms(np.array([len(u)]))[0] * X._norms(np.array([len(v)]))[0])
            assert got[k, j] == pytest.approx((inner / norm) ** 2, rel=1e-4, abs=1e-9)


@pytest.mark.parametrize("module, label", [(Q, "quality"), (X, "toxic")])
def test_classifiers_on_awkward_rows_and_without_labels(spark, module, label):
    labels = spark.createDataFrame([(1, 1), (2, 1), (7, None), (None, 1)], f"doc_id long, {label} int")
    for given in (labels, labels.limit(0)):
        model = module.train(docs(spark), given, label)
        got = docs(spark).select("doc_id", "text", module.score(model, F.col("text")).alias("p")).collect()
        assert len(got) == len(ROWS) and all(0 <= r.p <= 1 for r in got)
        by_text = {}
        for r in got:
            assert by_text.setdefault(r.text or "", r.p) == r.p
    assert empty(spark).select(module.score(model, F.col("text"))).collect() == []


def test_encoding_equals_the_public_library(spark):
    m = sentencepiece.SentencePieceProcessor(model_file=P.MODEL)
    rnd = random.Random(3)
    texts = ["", " ", "\n", "a  b\n c\té ▁x 漢𝔘 <s>", "   lead", "trail   ", "a" * 300, "x" * 500 + " " * 40 + "the" * 100,
             "def f(x):\n        return  x**2\n", "日本語のテキスト" * 30, "\x00\x01�", LONG]
    texts += ["".join(rnd.choice("etaoinshr lducm▁\n.é漢") for _ in range(rnd.randrange(400))) for _ in range(200)]
    rows = [(i, t, "en", "s") for i, t in enumerate(texts)] + [(900, None, "en", "s")]
    out = P.encode(docs(spark, rows))
    got = {r.doc_id: r.ids for r in out.collect()}
    assert got == {i: m.encode(t or "") for i, t, *_ in rows}
    back = {r.doc_id: r.text for r in P.decode(out).collect()}
    assert back == {i: (t or "").replace("▁", " ") for i, t, *_ in rows}
    sample = table(spark, SF, "documents").limit(150)
    checked = P.encode_checked(sample).collect()
    want = {r.doc_id: m.encode(r.text or "") for r in sample.collect()}
    assert {r.doc_id: r.ids for r in checked} == want and all(r.round_trip for r in checked)


def test_small_batches_and_a_forgetful_encoder_change_nothing(monkeypatch):
    texts = [LONG[:3000], "one two  three", "", "漢字 " * 20, "q" * 200]
    want = P.Encoder(P.load()).encode(texts)
    for name, value in (("BATCH", 64), ("KEPT", 5), ("ABREAST", 3)):
        monkeypatch.setattr(P, name, value)
    got = P.Encoder(P.load()).encode(texts)
    assert got[0].tolist() == want[0].tolist() and got[1].tolist() == want[1].tolist()


def test_encoding_on_awkward_rows(spark):
    out = P.encode_checked(docs(spark)).collect()
    assert len(out) == len(ROWS) and all(r.round_trip and r.n_ids == len(r.ids) for r in out)
    assert P.encode(empty(spark)).collect() == [] and P.decode(P.encode(empty(spark))).collect() == []


def test_pipeline_stages_keep_the_columns_and_take_effect(spark):
    rows = [(i, f"Clean text number {i} with a few words. It has another sentence, too.\nAnd a line of its own {i * 7}.", "en", "s") for i in range(40)]
    rows += [(100 + i, rows[i][1], "en", "s") for i in range(5)]  # exact copies
    rows += [(200, " ".join(f"w{k}" for k in range(100)) + ".", "en", "t"), (201, " ".join(f"w{k}" for k in range(101)) + ".", "en", "t")]
    rows += [(300, None, "en", "s"), (301, "", "en", None)]
    frame = docs(spark, rows)
    stages = [f for _, f in corpus_pipeline.STAGES]
    exact = stages[1](spark, frame, SF)
    assert {r.doc_id for r in exact.collect()} == ({r[0] for r in rows} - set(range(5))) - {300}
    near = stages[2](spark, exact, SF)
    assert {r.doc_id for r in exact.collect()} - {r.doc_id for r in near.collect()} == {201}
    mixed = stages[3](spark, near, SF)
    assert exact.columns == near.columns == mixed.columns == frame.columns
    copies = Counter(r.doc_id for r in mixed.collect())
    assert max(copies.values()) <= 3 and not {300, 301} & set(copies)
    out = stages[4](spark, mixed, SF).collect()
    assert Counter(r.doc_id for r in out) == copies and all(r.round_trip for r in out)
    good = stages[0](spark, frame, SF)
    assert good.columns == frame.columns and {r.doc_id for r in good.collect()} >= set(range(40))


def test_pipeline_on_awkward_and_empty_tables(spark):
    for frame in (docs(spark), empty(spark)):
        for _, stage in corpus_pipeline.STAGES:
            frame = stage(spark, frame, SF)
            frame.collect()


def test_pipeline_runs_over_documents(spark):
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert out.columns == ["doc_id", "ids", "n_ids", "round_trip"] and out.count() > 100
    assert out.where("NOT round_trip").count() == 0
