"""Quality classifier: a linear-chain conditional random field over lines (operator 7).

Each line is described by counts of its characters and words and by the same measures of the line before and after it;
the chain labels every line good (1) or bad (0). Forward-backward gives each line's marginal, and a document's score is
the mean marginal weighted by line length (plus one, so that empty lines count).

Training: at most ``TRAINING_DOCS`` documents of each label, taken by a hash of their id; a document gives at most
``SEGMENTS`` evenly spaced runs of ``RUN`` lines, and its label is that of its lines. The features are computed in
Spark tasks; the few parameters are fitted on the driver. Scoring covers every line of every text, in pieces of whole
lines, so memory is bounded by the longest line.

Defined results: a null text is an empty text, one empty line, and gets that line's marginal; equal texts get equal
scores; without labels every score is 0.5; an empty table gives an empty table; a score that is not finite cannot
occur (inputs are finite counts).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.llm import chars
from candlewick.llm.common import labelled_rows, ship

TRAINING_DOCS, SEGMENTS, RUN = 1000, 8, 64
#: Characters per piece of work in a task.
PIECE = 1_000_000
N_BASE = 14
N_FEATURES = 3 * N_BASE + 2


def _base_features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Measures and length of each line of the text."""
    codes = chars.codes_of(text)
    cls = chars.classes_of(codes)
    feeds = np.flatnonzero(codes == 10)
    begin, end = np.concatenate([[0], feeds + 1]), np.concatenate([feeds, [len(codes)]])
    length = (end - begin).astype(np.float64)
    per = np.maximum(length, 1)

    def share(mask):
        total = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
        return (total[end] - total[begin]) / per

    starts, ends, hashes = chars.words_of(codes, cls)
    line = np.searchsorted(begin, starts, side="right") - 1
    n = len(begin)
    words = np.bincount(line, minlength=n).astype(np.float64)
    same = (line[1:] == line[:-1]) & (hashes[1:] == hashes[:-1])
    again = np.bincount(line[1:][same], minlength=n)
    order = np.lexsort((hashes, line))
    new = np.ones(len(order), bool)
    new[1:] = (line[order][1:] != line[order][:-1]) | (hashes[order][1:] != hashes[order][:-1])
    distinct = np.bincount(line[order][new], minlength=n)
    closed = np.bincount(line[(cls[ends - 1] & chars.SYMBOL) > 0], minlength=n) if len(ends) else np.zeros(n)
    per_word = np.maximum(words, 1)
    last = np.where(length > 0, cls[np.maximum(end - 1, 0)] if len(cls) else 0, 0)
    shout = share(codes == 33)
    x = np.stack([
        np.log1p(length), np.log1p(words), np.minimum(length / per_word, 40) / 10, share((cls & chars.UPPER) > 0),
        share((cls & chars.DIGIT) > 0), share((cls & chars.SYMBOL) > 0), share((cls & (chars.PUNCT | chars.STOP)) > 0),
        shout, again / per_word, distinct / per_word, closed / per_word, (words == 0) * 1.0, (words == 1) * 1.0,
        ((last & chars.STOP) > 0) * 1.0,
    ], axis=1)
    return x, length


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features and length of each line of all texts, and the number of lines of each text."""
    pieces = [p for t in texts for p in chars.cut(t, PIECE)]
    lines = np.array([t.count("\n") + 1 for t in texts])
    parts = [_base_features("\n".join(run)) for run in chars.batches(pieces, PIECE)]
    x, length = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
    after = np.cumsum(lines)
    first, last = np.zeros(len(x), bool), np.zeros(len(x), bool)
    first[after - lines], last[after - 1] = True, True
    before = np.where(first[:, None], 0, np.roll(x, 1, axis=0))
    behind = np.where(last[:, None], 0, np.roll(x, -1, axis=0))
    return np.concatenate([x, before, behind, first[:, None], last[:, None]], axis=1), length, lines


@dataclass
class Chain:
    """A fitted chain: feature scale, weights, and the four transition scores between bad (0) and good (1)."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # the last one is the constant
    moves: np.ndarray  # 2 x 2

    def line_scores(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.scale) @ self.weights[:-1] + self.weights[-1]


def _forward(s: np.ndarray, moves: np.ndarray, active: list[int]) -> np.ndarray:
    """Log odds of good from the left. ``s``: positions x chains; ``active[t]``: chains that reach position t; 0 elsewhere."""
    a = np.zeros_like(s)
    a[0] = s[0]
    for t in range(1, len(s)):
        k, p = active[t], a[t - 1, : active[t]]
        a[t, :k] = s[t, :k] + np.logaddexp(moves[0, 1], p + moves[1, 1]) - np.logaddexp(moves[0, 0], p + moves[1, 0])
    return a


def _backward(s: np.ndarray, moves: np.ndarray, active: list[int]) -> np.ndarray:
    b = np.zeros_like(s)
    for t in range(len(s) - 2, -1, -1):
        k = active[t + 1]
        p = s[t + 1, :k] + b[t + 1, :k]
        b[t, :k] = np.logaddexp(moves[1, 0], p + moves[1, 1]) - np.logaddexp(moves[0, 0], p + moves[0, 1])
    return b


def _laid_out(lines: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[int], np.ndarray]:
    """Chains by falling length: (position, chain) of every line, chains active at each position, the order."""
    order = np.argsort(-lines, kind="stable")
    place = np.empty(len(lines), np.int64)
    place[order] = np.arange(len(lines))
    chain = np.repeat(place, lines)
    position = np.arange(lines.sum()) - np.repeat(np.cumsum(lines) - lines, lines)
    active = np.searchsorted(-lines[order], -np.arange(lines.max()), side="left").tolist()
    return position, chain, active, order


def sigmoid(v: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * v))


def marginals(chain: Chain, x: np.ndarray, lines: np.ndarray) -> np.ndarray:
    """P(good) of each line given its whole document. Chains are taken in groups of similar length."""
    s = chain.line_scores(x)
    out = np.empty(len(s))
    start = np.cumsum(lines) - lines
    by_length = np.argsort(-lines, kind="stable")
    at = 0
    while at < len(by_length):  # a group's grid holds at most a million cells, or one chain
        width = max(1, 1_000_000 // int(lines[by_length[at]]))
        group = by_length[at : at + width]
        at += width
        rows = np.concatenate([np.arange(start[d], start[d] + lines[d]) for d in group])
        position, column, active, _ = _laid_out(lines[group])
        grid = np.zeros((int(lines[group].max()), len(group)))
        grid[position, column] = s[rows]
        odds = _forward(grid, chain.moves, active) + _backward(grid, chain.moves, active)
        out[rows] = sigmoid(odds[position, column])
    return out


def fit(x: np.ndarray, lines: np.ndarray, labels: np.ndarray, steps: int = 120, ridge: float = 1e-3) -> Chain:
    """Maximum likelihood of the labels (one per chain, that of its lines) by Adam on the whole sample."""
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    z = np.concatenate([(x - mean) / scale, np.ones((len(x), 1))], axis=1)
    y = np.repeat(labels, lines).astype(np.float64)
    position, column, active, _ = _laid_out(lines)
    shape = (int(lines.max()), len(lines))
    there = np.zeros(shape, bool)
    there[position, column] = True
    gold = np.zeros((2, 2))
    stay = lines - 1
    gold[1, 1], gold[0, 0] = stay[labels == 1].sum(), stay[labels == 0].sum()
    w = np.zeros(z.shape[1] + 4)
    m, v, n = np.zeros_like(w), np.zeros_like(w), len(lines)
    for step in range(1, steps + 1):
        moves = w[-4:].reshape(2, 2)
        s = np.zeros(shape)
        s[position, column] = z @ w[:-4]
        a, b = _forward(s, moves, active), _backward(s, moves, active)
        p = sigmoid((a + b)[position, column])
        left, right = a[:-1], (s + b)[1:]
        joint = np.stack([np.full_like(left, moves[0, 0]), right + moves[0, 1], left + moves[1, 0], left + right + moves[1, 1]])
        joint -= joint.max(axis=0)
        joint = np.exp(joint)
        joint /= joint.sum(axis=0)
        expected = (joint * there[1:]).sum(axis=(1, 2))
        g = np.concatenate([z.T @ (p - y), expected - gold.ravel()]) / n + ridge * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return Chain(mean, scale, w[:-4], w[-4:].reshape(2, 2).copy())


def _segments(lines: int) -> list[tuple[int, int]]:
    """At most SEGMENTS evenly spaced runs of RUN lines."""
    runs = -(-lines // RUN)
    return [(k * RUN, min(lines, (k + 1) * RUN)) for k in sorted({i * (runs - 1) // max(1, SEGMENTS - 1) for i in range(SEGMENTS)})]


def _training_rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        rows = []
        for text, label in zip(frame["text"], frame["label"], strict=True):
            x, _, lines = features([text])
            rows += [(int(label), b - a, x[a:b].astype(np.float32).tobytes()) for a, b in _segments(int(lines[0]))]
        yield pd.DataFrame(rows, columns=["label", "n", "x"])


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", id_col: str = "doc_id", text_col: str = "text",
          most: int = TRAINING_DOCS) -> Chain | None:
    ship(docs.sparkSession)
    rows = labelled_rows(docs, labels, label, most, id_col, text_col)
    sample = rows.select("text", "label").mapInPandas(_training_rows, "label int, n long, x binary").collect()  # bounded by most * SEGMENTS
    if not sample:
        return None
    sample.sort(key=lambda r: (r["x"], r["label"]))
    x = np.concatenate([np.frombuffer(r["x"], np.float32).reshape(-1, N_FEATURES) for r in sample]).astype(np.float64)
    return fit(x, np.array([r["n"] for r in sample]), np.array([r["label"] for r in sample]))


def score_texts(chain: Chain | None, texts: list[str]) -> np.ndarray:
    if chain is None:
        return np.full(len(texts), 0.5)
    scores = []
    for run in chars.batches(texts, PIECE):
        x, length, lines = features(run)
        weight = length + 1
        first = np.cumsum(lines) - lines
        scores.append(np.add.reduceat(marginals(chain, x, lines) * weight, first) / np.add.reduceat(weight, first))
    return np.clip(np.concatenate(scores), 0, 1) if scores else np.zeros(0)


def score(chain: Chain | None, text: Column) -> Column:
    ship(SparkSession.active())

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(score_texts(chain, texts.fillna("").tolist()))

    return scored(text)
