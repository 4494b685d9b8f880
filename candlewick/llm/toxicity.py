"""Toxicity: a support vector machine on a subsequence string kernel with Nyström landmarks (operator 6).

Two words are alike by the subsequences of three characters that they share, anywhere within SPAN characters and not
necessarily adjacent, each weighted by DECAY to the power of the length it spans; so an insult with inserted or gapped
characters still meets its landmark. The kernel of two words is scaled by their lengths and squared; that of two
sentences is the sum over their words. What isn't a letter is left out of a word, and a run of three or more
single-character words also counts as the word that it spells. The Nyström map over a few landmark words, chosen from the labelled documents, makes the machine linear; its
decision for a sentence is then a sum of one number per word, which a task computes once per distinct word.

Landmarks are words and beginnings of words whose share of documents differs between the labels beyond chance (a log-likelihood
ratio of ``SURE`` or more; the largest first, so stems that many words share come before the words). Training sees labelled sentences by way of labelled documents: in a document without the label no
sentence is toxic, in one with it at least one is, so the machine is refitted a few times on the sentence of each positive
document that it finds most toxic, without the few that stay furthest from toxic (labels err). At most ``TRAINING_DOCS``
documents of each label are used, chosen by a hash of their id, and ``SENTENCES`` of each.

Some toxic words also turn up by chance in long clean texts; one of these alone says little there, several in a short text
say much. A document is therefore judged in two ways. Its most toxic sentence decides, through a logistic curve, where it
is beyond what all but ``SPARED`` of the clean training documents have; so a plain insult counts in a text of any length.
Otherwise a second machine weighs the evidence of all its distinct words, their kernels with each landmark beyond ``FAINT``, against
their number: the log-odds of two rates are linear in both. It is trained on the same documents, taken whole, and so are
the curves of both.

Defined results: a null or empty text, and one without words, has the score of an empty sentence; equal texts get equal
scores; without labels, or with one label only, every score is 0 (or 1 where all labels are 1); an empty table gives an
empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.llm import chars
from candlewick.llm.common import labelled_rows, ship, stored

TRAINING_DOCS, SENTENCES = 2000, 10
#: Log-likelihood ratio that makes a landmark (20: beyond four standard errors); share of clean documents whose best sentence may pass; share of positives that
#: are left out as mislabelled; a kernel that chance gives to any two words.
SURE, SPARED, DOUBTED, FAINT = 20.0, 0.002, 0.05, 0.15
#: Times that a document counts for a word.
OFTEN = 3
#: Subsequences span at most SPAN characters; a character spanned weighs DECAY.
SPAN, DECAY = 6, 0.7
TOXIC_LANDMARKS, OTHER_LANDMARKS = 24, 8
#: Characters per piece of work, distinct words kept per task.
PIECE, KEPT = 1_000_000, 1_000_000
_OFFSETS = [(a, b) for a, b in combinations(range(1, SPAN), 2)]


def _norms(lengths: np.ndarray) -> np.ndarray:
    """Scale of a word by its length: the norm of its subsequence weights if all were different."""
    total = np.zeros(len(lengths))
    for _, b in _OFFSETS:
        total += np.maximum(lengths - b, 0) * DECAY ** (2 * (b + 1))
    return np.sqrt(np.maximum(total, 1e-12))


@dataclass
class Kernel:
    """The landmarks, laid out so that a word's kernel with all of them is a sum of table rows."""

    landmarks: list[str]
    letters: np.ndarray = field(init=False)
    rows: np.ndarray = field(init=False)
    weights: np.ndarray = field(init=False)

    def __post_init__(self):
        alphabet = sorted({c for w in self.landmarks for c in w})
        self.letters = np.array([ord(c) for c in alphabet], np.uint32)
        size = len(alphabet) + 1
        number = {c: i + 1 for i, c in enumerate(alphabet)}
        found: dict[int, np.ndarray] = {}
        norms = _norms(np.array([len(w) for w in self.landmarks]))
        for k, w in enumerate(self.landmarks):
            for i in range(len(w)):
                for a, b in _OFFSETS:
                    if i + b < len(w):
                        key = (number[w[i]] * size + number[w[i + a]]) * size + number[w[i + b]]
                        found.setdefault(key, np.zeros(len(self.landmarks), np.float32))[k] += DECAY ** (b + 1) / norms[k]
        self.rows = np.zeros(size**3, np.int32)
        self.weights = np.zeros((len(found) + 1, len(self.landmarks)), np.float32)
        for row, (key, value) in enumerate(found.items(), 1):
            self.rows[key], self.weights[row] = row, value

    def words(self, codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Kernel of each word (a range of codes) with each landmark."""
        lengths = ends - starts
        n = len(starts)
        # the words one after another, each followed by a gap that no subsequence crosses
        room = np.cumsum(lengths + 1) - (lengths + 1)
        flat = np.zeros(int((lengths + 1).sum()) + SPAN, np.int64)
        word = np.full(len(flat), -1, np.int64)
        place = np.repeat(room - starts, lengths) + (np.arange(int(lengths.sum())) + np.repeat(starts - (np.cumsum(lengths) - lengths), lengths))
        source = place - np.repeat(room - starts, lengths)
        at = np.searchsorted(self.letters, codes[source])
        at[at == len(self.letters)] = 0
        flat[place] = np.where(self.letters[at] == codes[source], at + 1, 0)
        word[place] = np.repeat(np.arange(n), lengths)
        size = len(self.letters) + 1
        sums = np.zeros((n, len(self.landmarks)), np.float32)
        m = len(flat) - SPAN
        first = np.flatnonzero(flat[:m])
        for a, b in _OFFSETS:
            key = (flat[first] * size + flat[first + a]) * size + flat[first + b]
            row = np.where((flat[first + a] > 0) & (flat[first + b] > 0) & (word[first] == word[first + b]), self.rows[key], 0)
            hit = np.flatnonzero(row)
            if len(hit):
                owner = word[first[hit]]
                runs = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
                sums[owner[runs]] += np.add.reduceat(self.weights[row[hit]], runs, axis=0) * np.float32(DECAY ** (b + 1))
        return (sums / _norms(lengths)[:, None]) ** 2

    def of(self, words: list[str]) -> np.ndarray:
        codes = chars.codes_of("".join(words)).copy()
        ends = np.cumsum([len(w) for w in words])
        return self.words(codes, ends - np.array([len(w) for w in words]), ends)


@dataclass
class Batch:
    """Words of a batch of texts: each distinct word once, the distinct words of each sentence, each sentence's text."""

    codes: np.ndarray
    starts: np.ndarray  # of the distinct words
    ends: np.ndarray
    hashes: np.ndarray
    number: np.ndarray  # a distinct word ...
    sentence: np.ndarray  # ... and a sentence that has it
    text: np.ndarray  # of each sentence


def read(texts: list[str]) -> Batch:
    """Lower-cased words with what isn't a letter left out ("id-iot" spells "idiot"). A sentence ends at a line feed,
    and at a stop with white space behind it."""
    lowered = [t.lower() for t in texts]
    codes = chars.codes_of("\n".join(lowered))
    cls = chars.classes_of(codes)
    blank = (cls & chars.SPACE) > 0
    stops = codes == 10
    stops[:-1] |= ((cls[:-1] & chars.STOP) > 0) & blank[1:]
    sentence = np.cumsum(stops)
    keep = np.flatnonzero(blank | ((cls & chars.LETTER) > 0))
    codes, cls = codes[keep], cls[keep]
    starts, ends, hashes = chars.words_of(codes, cls)
    sentence = sentence[keep][starts]
    new = np.ones(len(starts), bool)
    new[1:] = sentence[1:] != sentence[:-1]
    sentence = np.cumsum(new) - 1
    begin = np.cumsum([0] + [len(t) + 1 for t in lowered[:-1]])
    text = np.searchsorted(begin, keep[starts[new]], side="right") - 1
    # a run of single characters spells one more word of its sentence
    single = ends - starts == 1
    other = np.ones(len(starts), bool)  # the first word of a text: a run ends with its text
    other[1:] = text[sentence[1:]] != text[sentence[:-1]]
    begins = np.flatnonzero(single & (other | ~np.concatenate([[False], single[:-1]])))
    behind = np.flatnonzero(single & np.concatenate([other[1:] | ~single[1:], [True]])) + 1
    long = behind - begins >= 3
    runs = list(zip(begins[long].tolist(), behind[long].tolist(), strict=True))
    if runs:
        tail = np.concatenate([np.concatenate([[32], codes[starts[a:b]]]) for a, b in runs]).astype(np.uint32)
        s, e, h = chars.words_of(tail, chars.classes_of(tail))
        starts, ends, hashes = (np.concatenate(p) for p in ((starts, s + len(codes)), (ends, e + len(codes)), (hashes, h)))
        sentence = np.concatenate([sentence, sentence[[a for a, _ in runs]]])
        codes = np.concatenate([codes, tail])
    hashes, at, number = np.unique(hashes, return_index=True, return_inverse=True)
    pairs = np.unique(sentence * max(len(hashes), 1) + number)
    return Batch(codes, starts[at], ends[at], hashes, pairs % max(len(hashes), 1), pairs // max(len(hashes), 1), text)


@dataclass
class Machine:
    kernel: Kernel | None
    beta: np.ndarray  # weight of each landmark's kernel
    bias: float
    slope: float = 1.0
    level: float = 0.0
    gamma: np.ndarray | None = None  # weight of each landmark's evidence in a document
    per_word: float = 0.0
    always: float = 0.0

    def chance(self, best: np.ndarray, evidence: np.ndarray, words: np.ndarray) -> np.ndarray:
        """Score of documents: their best sentence's decision, the weighted evidence and the number of their words."""
        odds = self.slope * best + self.level
        if self.gamma is not None:
            odds = np.where(odds >= 0, odds, evidence + self.per_word * words + self.always)
        return 0.5 * (1 + np.tanh(0.5 * odds))


class Scorer:
    """Scores texts; remembers what up to KEPT distinct words say by their 64-bit hash."""

    def __init__(self, machine: Machine):
        self.machine = machine
        self.keys, self.values = np.zeros(0, np.uint64), np.zeros((0, 2), np.float32)

    def _decisions(self, b: Batch) -> np.ndarray:
        """What each distinct word adds to a sentence's decision, and to a document's evidence."""
        at = np.searchsorted(self.keys, b.hashes)
        hit = at < len(self.keys)
        hit[hit] = self.keys[at[hit]] == b.hashes[hit]
        out = np.zeros((len(b.hashes), 2), np.float32)
        out[hit] = self.values[at[hit]]
        new = np.flatnonzero(~hit)
        if len(new):
            k = self.machine.kernel.words(b.codes, b.starts[new], b.ends[new])
            out[new, 0] = k @ self.machine.beta.astype(np.float32)
            if self.machine.gamma is not None:
                out[new, 1] = np.maximum(k - np.float32(FAINT), 0) @ self.machine.gamma.astype(np.float32)
            if len(self.keys) > KEPT:
                self.keys, self.values = self.keys[:0], self.values[:0]
            keys, values = np.concatenate([self.keys, b.hashes[new]]), np.concatenate([self.values, out[new]])
            order = np.argsort(keys, kind="stable")
            self.keys, self.values = keys[order], values[order]
        return out

    def facts(self, run: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The best sentence's decision, the evidence and the number of the distinct words of each text."""
        best, held = np.full(len(run), -np.inf), []
        whole = sum(map(len, run)) <= PIECE
        for part, own in [(run, None)] if whole else [([p], i) for i, t in enumerate(run) for p in chars.cut(t, PIECE)]:
            b = read(part)
            if len(b.text):
                each = self._decisions(b)
                sums = np.bincount(b.sentence, each[b.number, 0], minlength=len(b.text)) + self.machine.bias
                target = b.text if own is None else np.full(len(b.text), own)
                first = np.flatnonzero(np.concatenate([[True], target[1:] != target[:-1]]))
                top = np.maximum.reduceat(sums, first)
                best[target[first]] = np.maximum(best[target[first]], top)
                pairs = np.unique(target[b.sentence] * len(each) + b.number)
                held.append((pairs // len(each), b.hashes[pairs % len(each)], each[pairs % len(each), 1]))
        evidence, words = np.zeros(len(run)), np.zeros(len(run))
        if held:
            text, word, value = (np.concatenate(c) for c in zip(*held, strict=True))
            if len(held) > 1:  # a word of several pieces of a text
                order = np.lexsort((word, text))
                text, word, value = text[order], word[order], value[order]
                new = np.concatenate([[True], (text[1:] != text[:-1]) | (word[1:] != word[:-1])])
                text, value = text[new], value[new]
            evidence, words = np.bincount(text, value, minlength=len(run)), np.bincount(text, minlength=len(run)).astype(np.float64)
        return np.where(np.isneginf(best), self.machine.bias, best), evidence, words  # no sentence: an empty one

    def score(self, texts: list[str]) -> np.ndarray:
        m = self.machine
        if m.kernel is None:
            return np.full(len(texts), m.level)
        out = [m.chance(*self.facts(run)) for run in chars.batches(texts, PIECE)]
        return np.concatenate(out) if out else np.zeros(0)


# -- training ---------------------------------------------------------------------------------------------------------

def _beginning(n: int):
    return lambda w: F.substring(w, 1, n)  # (a second parameter would be the index)


def landmark_words(rows: DataFrame) -> tuple[list[str], list[str]]:
    """Words and beginnings of words that most tell labelled documents apart, and common words that do not, from how
    often documents of both classes hold them, up to OFTEN times each (counted by Spark; a bounded number comes to the
    driver). A toxic one is held by two documents at least."""
    words = F.filter(F.split(F.lower("text"), r"[\s.,!?]+"), lambda w: F.length(w).between(3, 24))
    parts = [F.when(F.length("w") >= n, F.substring("w", 1, n)) for n in (4, 5, 6, 7, 8)]
    spelled = rows.select("id", "label", F.explode(words).alias("w")).select("id", "label", F.explode(F.array_distinct(F.array("w", *parts))).alias("word"))
    each = spelled.where("word IS NOT NULL").groupBy("id", "label", "word").agg(F.least(F.count(F.lit(1)), F.lit(OFTEN)).alias("n"))
    counts = each.groupBy("word").agg(F.sum(F.col("n") * F.col("label")).alias("toxic"), F.sum(F.col("n") * (1 - F.col("label"))).alias("clean"),
                                      F.sum("label").alias("holders"), F.count(F.lit(1)).alias("seen"))
    sizes = rows.agg(F.sum("label").alias("toxic"), F.sum(1 - F.col("label")).alias("clean")).first()
    n1, n0 = float(max(sizes["toxic"], 1)), float(max(sizes["clean"], 1))
    toxic, clean, share = F.col("toxic"), F.col("clean"), n1 / (n1 + n0)
    cell = lambda o, e: F.when(o > 0, o * F.ln(o / e)).otherwise(0.0)
    told = 2 * (cell(toxic, (toxic + clean) * share) + cell(clean, (toxic + clean) * (1 - share)))
    ranked = counts.where("seen >= 3 OR holders >= 2").select("word", "holders", F.round(F.when(toxic * n0 > clean * n1, told).otherwise(-told), 6).alias("sure"))
    best = [r["word"] for r in ranked.where((F.col("sure") >= SURE) & (F.col("holders") >= 2)).orderBy(F.desc("sure"), F.desc(F.length("word")), "word")
            .limit(60 * TOXIC_LANDMARKS).collect()]
    common = [r["word"] for r in ranked.orderBy("sure", "word").limit(OTHER_LANDMARKS).collect()]
    chosen: list[str] = []
    for w in best:  # one of each family: no two chosen words begin alike
        if len(chosen) < TOXIC_LANDMARKS and not any(w.startswith(c[:4]) or c.startswith(w[:4]) for c in chosen):
            chosen.append(w)
    return chosen, [w for w in common if w not in chosen]


def _sentence_features(kernel: Kernel, toxic: int):
    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for text, label in zip(frame["text"], frame["label"], strict=True):
                parts = []
                for piece in chars.cut(text, PIECE):
                    b = read([piece])
                    x = np.zeros((len(b.text), len(kernel.landmarks)))
                    if len(b.text):
                        np.add.at(x, b.sentence, kernel.words(b.codes, b.starts, b.ends)[b.number])
                    parts.append(x)
                x = np.concatenate(parts)
                top = x[np.argsort(-x[:, :toxic].max(axis=1, initial=0), kind="stable")[:SENTENCES]]
                out.append((int(label), len(top), top.astype(np.float32).tobytes()))
            yield pd.DataFrame(out, columns=["label", "n", "x"])
    return rows


def _svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0, rounds: int = 30) -> np.ndarray:
    """Squared hinge loss by Newton steps; the last weight is the bias, which is not penalised."""
    z = np.concatenate([x, np.ones((len(x), 1))], axis=1)
    w = np.zeros(z.shape[1])
    penalty = np.full(z.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(rounds):
        inside = y * (z @ w) < 1
        zi, wi = z[inside], weight[inside]
        new = np.linalg.solve(zi.T @ (zi * wi[:, None]) + np.diag(penalty), zi.T @ (wi * y[inside]))
        if np.allclose(new, w, atol=1e-7):
            break
        w = new
    return w


def fit(kernel: Kernel, x: np.ndarray, doc: np.ndarray, labels: np.ndarray, passes: int = 4) -> Machine:
    """``x``: landmark kernels of sentences, ``doc``: the document of each, ``labels``: of each document."""
    among = kernel.of(kernel.landmarks)
    values, vectors = np.linalg.eigh((among + among.T) / 2 + 1e-6 * np.eye(len(among)))
    root = vectors / np.sqrt(np.maximum(values, 1e-6)) @ vectors.T  # Nyström: kernel matrix to the power -1/2
    z = x @ root
    first = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
    picked = x.sum(axis=1)
    negative, keep = labels[doc] == 0, None
    for _ in range(passes):
        top = np.zeros(len(x), bool)  # the most toxic sentence of each positive document
        for a, b in zip(first, [*first[1:], len(x)], strict=True):
            if labels[doc[a]]:
                top[a + int(np.argmax(picked[a:b]))] = True
        if keep is not None:
            top[np.flatnonzero(top)[picked[top] < np.quantile(picked[top], DOUBTED)]] = False
        keep = top
        use = negative | top
        y = np.where(top[use], 1.0, -1.0)
        w = _svm(z[use], y, np.where(y > 0, use.sum() / (2 * max(top.sum(), 1)), use.sum() / (2 * max(negative.sum(), 1))) / use.sum() * 2000)
        picked = z @ w[:-1]
    return Machine(kernel, root @ w[:-1], float(w[-1]))


def calibrate(machine: Machine, best: np.ndarray, evidence: np.ndarray, words: np.ndarray, labels: np.ndarray) -> None:
    """The second machine and both curves, from labelled documents: the decision of their best sentence, their evidence
    of each landmark, the number of their words."""
    machine.slope, machine.level = _logistic(best, labels)
    beyond = float(np.quantile(best[labels == 0], 1 - SPARED)) + 1e-6
    machine.level = min(machine.level, -machine.slope * beyond)
    x = np.concatenate([evidence, words[:, None]], axis=1)
    scale = np.maximum(x.std(axis=0), 1e-6)
    y, weight = np.where(labels == 1, 1.0, -1.0), np.where(labels == 1, 0.5 / max((labels == 1).mean(), 1e-9), 1.0)
    use = np.ones(x.shape[1], bool)
    while True:  # evidence never speaks against the label, and the number of words never for it
        w = np.zeros(len(use) + 1)
        w[np.append(use, True)] = _svm(x[:, use] / scale[use], y, weight, ridge=50.0)
        wrong = np.append(w[:-2] < 0, w[-2] > 0)
        if not wrong.any():
            break
        use &= ~wrong
    a, b = _logistic(x / scale @ w[:-1] + w[-1], labels)
    machine.gamma, machine.per_word, machine.always = a * (w[:-2] / scale[:-1]), float(a * w[-2] / scale[-1]), float(a * w[-1] + b)


def _logistic(d: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and level of P(label) over the decision, classes weighted alike; the slope stays positive."""
    weight = np.where(y == 1, 0.5 / max((y == 1).sum(), 1), 0.5 / max((y == 0).sum(), 1))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * d + b, -30, 30)))
        g = np.array([(weight * (p - y) * d).sum() + 1e-3 * (a - 1), (weight * (p - y)).sum()])
        s = weight * p * (1 - p)
        h = np.array([[(s * d * d).sum() + 1e-3, (s * d).sum()], [(s * d).sum(), s.sum() + 1e-6]])
        step = np.linalg.solve(h, g)
        a, b = max(a - step[0], 1e-3), b - step[1]
    return float(a), float(b)


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", id_col: str = "doc_id", text_col: str = "text",
          most: int = TRAINING_DOCS) -> Machine:
    ship(docs.sparkSession)
    rows = stored(labelled_rows(docs, labels, label, most, id_col, text_col).select("id", "text", "label"), "toxic-training")
    kinds = sorted(r["label"] for r in rows.select("label").distinct().collect())
    if len(kinds) < 2:
        return Machine(None, np.zeros(0), 0.0, level=float(kinds[0]) if kinds else 0.0)
    toxic, other = landmark_words(rows)
    if not toxic:
        return Machine(None, np.zeros(0), 0.0)
    kernel = Kernel([*toxic, *other])
    sample = rows.mapInPandas(_sentence_features(kernel, len(toxic)), "label int, n long, x binary").collect()  # bounded by most * SENTENCES
    sample = sorted((r for r in sample if r["n"]), key=lambda r: (r["label"], r["x"]))
    if len({r["label"] for r in sample}) < 2:
        return Machine(None, np.zeros(0), 0.0)
    x = np.concatenate([np.frombuffer(r["x"], np.float32).reshape(r["n"], -1) for r in sample]).astype(np.float64)
    machine = fit(kernel, x, np.repeat(np.arange(len(sample)), [r["n"] for r in sample]), np.array([r["label"] for r in sample]))
    facts = sorted(rows.mapInPandas(_document_facts(machine), "label int, best double, words double, x binary").collect(), key=tuple)  # 2 * most
    calibrate(machine, np.array([r["best"] for r in facts]), np.stack([np.frombuffer(r["x"]) for r in facts]), np.array([r["words"] for r in facts]),
              np.array([r["label"] for r in facts]))
    return machine


def _document_facts(machine: Machine):
    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(machine)
        for frame in frames:
            out = []
            for text, label in zip(frame["text"], frame["label"], strict=True):
                best, _, words = scorer.facts([text])
                x, seen = np.zeros(len(machine.kernel.landmarks)), np.zeros(0, np.uint64)
                for piece in chars.cut(text, PIECE):
                    b = read([piece])
                    k = machine.kernel.words(b.codes, b.starts, b.ends)
                    x += np.maximum(k - FAINT, 0)[~np.isin(b.hashes, seen)].sum(axis=0)
                    seen = np.union1d(seen, b.hashes)
                out.append((int(label), float(best[0]), float(words[0]), x.tobytes()))
            yield pd.DataFrame(out, columns=["label", "best", "words", "x"])
    return rows


def score(machine: Machine, text: Column) -> Column:
    ship(SparkSession.active())

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(machine)
        for texts in batches:
            yield pd.Series(scorer.score(texts.fillna("").tolist()))

    return scored(text)
