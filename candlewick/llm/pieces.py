"""SentencePiece encoding and decoding by suffix-array matching (operator 10).

The model is a public BPE vocabulary with byte fallback; its file is a parameter, read on the driver and broadcast
(its size is that of the vocabulary). Texts are cut into units at spaces and at line feeds, which no piece crosses, and
each unit that a task has not met yet is indexed once: the new units of a batch are concatenated, a suffix array over
the text (sorted by as many characters as the longest piece has) is built by prefix doubling, every piece is
binary-searched for its range of occurrences, the ranges become edges (position, piece), the edges are sorted by
position, and a relaxation from left to right finds the encoding.

BPE is not a shortest path by score, so the relaxation carries, for every prefix of a unit, the last piece of that
prefix's encoding; an edge relaxes its end when its piece may follow the last piece at its start, that is when BPE on
the two together would leave them apart. Exactly one edge passes at every position, so the result is that of merging
pairs by rank, as the tests compare with the public library.

Defined results: a null or empty text has no ids; characters outside the vocabulary become their UTF-8 bytes; U+2581,
the model's own mark for a space, is read as a space, so a text that holds it decodes with spaces (every other text
decodes to itself); repeated rows are encoded each time; an empty table gives an empty table; columns of the input
other than the id and the text are not carried.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from candlewick.llm.common import ship

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
UNIT = re.compile(f"{SPACE}+[^{SPACE}\n]*|[^{SPACE}\n]+|\n")
#: Characters per batch text, units kept per task, longest unit that is relaxed side by side with others.
BATCH, KEPT, ABREAST = 2_000_000, 300_000, 64


@dataclass(frozen=True)
class Vocabulary:
    """Pieces by id; ``rank`` orders merges (-1: a single character or a byte), ``left`` and ``right`` are the two
    pieces whose merge makes a piece; ``byte`` is the id of each byte."""

    pieces: tuple[str, ...]
    rank: np.ndarray
    left: np.ndarray
    right: np.ndarray
    byte: tuple[int, ...]
    drop: frozenset[int]  # control pieces

    @property
    def other(self) -> int:
        """Stands for a character outside the vocabulary."""
        return len(self.pieces)


def _merged(piece: str, ids: dict[str, int], rank) -> list[str]:
    """BPE on one short string, pair by pair."""
    parts = list(piece)
    while True:
        best = min(((rank[ids[a + b]], i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in ids), default=None)
        if best is None:
            return parts
        i = best[1]
        parts[i : i + 2] = [parts[i] + parts[i + 1]]


@lru_cache(maxsize=2)
def load(path: str = MODEL) -> Vocabulary:
    import sentencepiece

    m = sentencepiece.SentencePieceProcessor(model_file=path)
    n = m.get_piece_size()
    byte, normal = [0] * 256, {}
    for i in range(n):
        if m.is_byte(i):
            byte[int(m.id_to_piece(i)[1:-1], 16)] = i
        elif not (m.is_control(i) or m.is_unknown(i) or m.is_unused(i)):
            normal[m.id_to_piece(i)] = i
    rank = np.full(n + 1, -1, np.int64)
    several = sorted((p for p in normal if len(p) > 1), key=lambda p: (-m.get_score(normal[p]), normal[p]))
    for k, p in enumerate(several):
        rank[normal[p]] = k
    ids = {p: i for p, i in normal.items() if len(p) > 1}
    left, right = np.full(n + 1, -1, np.int64), np.full(n + 1, -1, np.int64)
    for p in several:
        i = ids.pop(p)
        parts = _merged(p, ids, rank)  # without itself: two parts are left where it is made by a merge
        ids[p] = i
        if len(parts) == 2 and all(x in normal for x in parts):
            left[i], right[i] = normal[parts[0]], normal[parts[1]]
    # pieces that no merge makes are never an edge
    rank[[i for i in ids.values() if left[i] < 0]] = -2
    drop = frozenset(i for i in range(n) if m.is_control(i))
    return Vocabulary(tuple(m.id_to_piece(i) for i in range(n)), rank, left, right, tuple(byte), drop)


class Encoder:
    """Encodes units; one per Python worker. Bounded: at most KEPT units and their ids are kept."""

    def __init__(self, v: Vocabulary):
        self.v = v
        special = set(v.byte) | set(v.drop) | {0}
        singles = {p: i for i, p in enumerate(v.pieces) if len(p) == 1 and i not in special}
        several = [i for i in range(len(v.pieces)) if v.rank[i] >= 0]
        # characters of the vocabulary are numbered from 1; 0 ends a unit, the last number is any other character
        self.code_of = np.zeros(0x110000, np.uint16)
        self.id_of = np.full(len(singles) + 2, v.other, np.int64)
        for k, (c, i) in enumerate(singles.items(), 1):
            self.code_of[ord(c)], self.id_of[k] = k, i
        self.code_of[self.code_of == 0] = len(singles) + 1
        self.ids = np.array(several, np.int64)
        self.lengths = np.array([len(v.pieces[i]) for i in several], np.int64)
        self.length = np.ones(len(v.pieces) + 1, np.int64)
        self.length[self.ids] = self.lengths
        self.width = -(-int(self.lengths.max(initial=1)) // 4) * 4
        codes = np.zeros((len(several), self.width), np.uint64)
        for row, i in enumerate(several):
            codes[row, : self.lengths[row]] = self.code_of[[ord(c) for c in v.pieces[i]]]
        top = np.where(np.arange(self.width) < self.lengths[:, None], codes, 0xFFFF)
        self.low, self.high = self._packed(codes), self._packed(top)
        pairs = {}
        number = {p: i for i, p in enumerate(v.pieces) if i not in special}
        for i in several:
            p = v.pieces[i]
            for k in range(1, len(p)):
                a, b = number.get(p[:k]), number.get(p[k:])
                if a is not None and b is not None:
                    pairs[a * (len(v.pieces) + 1) + b] = int(v.rank[i])
        self.pair_keys = np.array(sorted(pairs), np.int64)
        self.pair_rank = np.array([pairs[k] for k in self.pair_keys.tolist()], np.int64)
        self.known_keys, self.known = np.zeros(0, np.int64), np.zeros(0, bool)
        self.known_one: dict[int, bool] = {}
        self.clear()

    @staticmethod
    def _packed(codes: np.ndarray) -> np.ndarray:
        """Rows of codes, four 16-bit codes to a number."""
        c = codes.astype(np.uint64).reshape(len(codes), -1, 4)
        return (c[..., 0] << np.uint64(48)) | (c[..., 1] << np.uint64(32)) | (c[..., 2] << np.uint64(16)) | c[..., 3]

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.new: list[str] = []
        self.flat, self.starts = [np.zeros(0, np.int32)], [np.zeros(1, np.int64)]
        self.done = 0

    # -- which piece may follow which ---------------------------------------------------------------------------

    def _follow(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether BPE keeps a and b apart. Their merges are undone, the latest first (of equal ones, the right one);
        if the two parts at the border would have merged before the merge that was undone last, it does not."""
        v, size = self.v, len(self.v.pieces) + 1
        u, w = a.copy(), b.copy()
        limit = np.full(len(a), np.iinfo(np.int64).max)
        apart, todo = np.ones(len(a), bool), np.arange(len(a))
        while len(todo):
            x, y = u[todo], w[todo]
            key = x * size + y
            at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
            merges = (self.pair_keys[at] == key) & (self.pair_rank[at] < limit[todo])
            apart[todo[merges]] = False
            rx, ry = v.rank[x], v.rank[y]
            go_on = ~merges & ((rx >= 0) | (ry >= 0))
            undo_left = go_on & (rx > ry)
            undo_right = go_on & ~undo_left
            t = todo[undo_left]
            limit[t], u[t] = rx[undo_left], v.right[x[undo_left]]
            t = todo[undo_right]
            limit[t], w[t] = ry[undo_right] + 1, v.left[y[undo_right]]  # leftmost of equal pairs goes first
            todo = todo[go_on]
        return apart

    def may_follow(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """``_follow`` with a memory of the pairs seen."""
        key = a * (len(self.v.pieces) + 1) + b
        if not len(key):
            return np.zeros(0, bool)
        at = np.searchsorted(self.known_keys, key)
        hit = at < len(self.known_keys)
        hit[hit] = self.known_keys[at[hit]] == key[hit]
        if not hit.all():
            new = np.unique(key[~hit])
            size = len(self.v.pieces) + 1
            found = self._follow(new // size, new % size)
            if len(self.known_keys) > 4_000_000:
                self.known_keys, self.known = np.zeros(0, np.int64), np.zeros(0, bool)
                return self.may_follow(a, b) if len(new) < len(key) else self._follow(a, b)
            keys, known = np.concatenate([self.known_keys, new]), np.concatenate([self.known, found])
            order = np.argsort(keys, kind="stable")
            self.known_keys, self.known = keys[order], known[order]
            at = np.searchsorted(self.known_keys, key)
        return self.known[at]

    # -- suffix array, ranges, edges, relaxation ------------------------------------------------------------------

    def _occurrences(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Edges of the text: start and piece of every occurrence of every piece of two or more characters."""
        n, width = len(text), self.width
        padded = np.concatenate([text, np.zeros(width + 4, np.uint16)]).astype(np.uint64)
        words = (padded[:-3] << np.uint64(48)) | (padded[1:-2] << np.uint64(32)) | (padded[2:-1] << np.uint64(16)) | padded[3:]
        rank, step = np.unique(words[: n + width], return_inverse=True)[1].astype(np.int64), 4
        while step < width:
            behind = np.concatenate([rank[step:], np.zeros(step, np.int64)])
            rank = np.unique(rank * (n + width + 1) + behind, return_inverse=True)[1].astype(np.int64)
            step *= 2
        suffixes = np.argsort(rank[:n], kind="stable")

        def below(bounds: np.ndarray, or_equal: bool) -> np.ndarray:
            """Number of suffixes below each bound, by binary search over all bounds at once."""
            lo, hi = np.zeros(len(bounds), np.int64), np.full(len(bounds), n, np.int64)
            while True:
                live = np.flatnonzero(lo < hi)
                if not len(live):
                    return lo
                mid = (lo[live] + hi[live]) // 2
                at = suffixes[mid]
                less, same = np.zeros(len(live), bool), np.ones(len(live), bool)
                for k in range(width // 4):
                    here, bound = words[at + 4 * k], bounds[live, k]
                    less |= same & (here < bound)
                    same &= here == bound
                less |= same & or_equal
                lo[live[less]] = mid[less] + 1
                hi[live[~less]] = mid[~less]

        first, last = below(self.low, False), below(self.high, True)
        counts = last - first
        total = int(counts.sum())
        shift = np.repeat(first - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts)
        return suffixes[np.arange(total) + shift], np.repeat(self.ids, counts)

    def _encode(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all units one after another, and how many each has."""
        joined = "\0".join(units) + "\0"
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        sizes = np.array([len(u) for u in units], np.int64)
        starts = np.cumsum(sizes + 1) - (sizes + 1)
        text = self.code_of[points]
        text[starts + sizes] = 0
        start, piece = self._occurrences(text)
        unit = np.searchsorted(starts, start, side="right") - 1
        end = start - starts[unit] + self.length[piece]  # place in the unit behind the edge
        last = self.id_of[text]  # at a character's place: the last piece of the encoding that ends there
        short = sizes[unit] <= ABREAST
        order = np.flatnonzero(short)[np.argsort(end[short].astype(np.int16), kind="stable")]
        at = np.searchsorted(end[order], np.arange(ABREAST + 2))
        for j in range(2, ABREAST + 1):
            e = order[at[j] : at[j + 1]]
            if len(e):
                self._relax(last, start[e], piece[e], starts[unit[e]])
        far = np.flatnonzero(~short)
        if len(far):
            far = far[np.argsort(start[far] + self.length[piece[far]], kind="stable")]
            self._relax_one_by_one(last, start[far].tolist(), piece[far].tolist(), starts[unit[far]].tolist())
        # from the end of each unit back, piece by piece
        ends = np.zeros(len(text), bool)
        cur, low = (starts + sizes - 1)[sizes > 0], starts[sizes > 0]
        while len(cur):
            ends[cur] = True
            cur = cur - self.length[last[cur]]
            on = cur >= low
            cur, low = cur[on], low[on]
        places = np.flatnonzero(ends)
        ids = last[places]
        owner = np.searchsorted(starts, places, side="right") - 1
        strange = np.flatnonzero(ids == self.v.other)
        if len(strange):
            spelled = [chr(c).encode("utf-8", "replace") for c in points[places[strange]].tolist()]
            many = np.ones(len(ids), np.int64)
            many[strange] = [len(s) for s in spelled]
            first = (np.cumsum(many) - many)[strange]
            ids, owner = np.repeat(ids, many), np.repeat(owner, many)
            for f, s in zip(first.tolist(), spelled, strict=True):
                ids[f : f + len(s)] = [self.v.byte[b] for b in s]
        return ids.astype(np.int32), np.bincount(owner, minlength=len(units))

    def _relax(self, last: np.ndarray, start: np.ndarray, piece: np.ndarray, low: np.ndarray) -> None:
        inner = start > low
        good = ~inner
        good[inner] = self.may_follow(last[start[inner] - 1], piece[inner])
        last[start[good] + self.length[piece[good]] - 1] = piece[good]

    def _relax_one_by_one(self, last: np.ndarray, starts: list[int], pieces: list[int], lows: list[int]) -> None:
        size, known, length = len(self.v.pieces) + 1, self.known_one, self.length
        if len(known) > KEPT:
            known.clear()
        for s, p, low in zip(starts, pieces, lows, strict=True):
            if s > low:
                before = int(last[s - 1])
                good = known.get(before * size + p)
                if good is None:
                    good = known[before * size + p] = bool(self._follow(np.array([before]), np.array([p]))[0])
                if not good:
                    continue
            last[s + length[p] - 1] = p

    def _finish(self) -> None:
        """Encodes the units that are new since the last call, in batch texts of at most BATCH characters."""
        at = 0
        while at < len(self.new):
            size, to = 0, at
            while to < len(self.new) and (to == at or size + len(self.new[to]) <= BATCH):
                size += len(self.new[to]) + 1
                to += 1
            ids, counts = self._encode(self.new[at:to])
            self.flat.append(ids)
            self.starts.append(self.starts[-1][-1] + np.cumsum(counts))
            at = to
        self.new = []
        self.flat, self.starts = [np.concatenate(self.flat)], [np.concatenate(self.starts)]

    def _units(self, text: str) -> np.ndarray:
        index, new = self.index, self.new
        marked = SPACE + text.replace(" ", SPACE) if text else ""
        units = UNIT.findall(marked) if len(marked) <= BATCH else (m.group() for m in UNIT.finditer(marked))

        def number(u):
            k = index.get(u)
            if k is None:
                k = index[u] = len(index)
                new.append(u)
            return k

        return np.fromiter(map(number, units), np.int64)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and how many each has."""
        flats, counts, at = [], [], 0
        while at < len(texts):
            size, to, found = 0, at, []
            while to < len(texts) and (to == at or size + len(texts[to]) <= BATCH):
                found.append(self._units(texts[to]))
                size += len(texts[to])
                to += 1
            self._finish()
            flat, starts = self.flat[0], self.starts[0]
            units = np.concatenate(found)
            many = starts[units + 1] - starts[units]
            total = int(many.sum())
            shift = np.repeat(starts[units] - (np.cumsum(many) - many), many)
            flats.append(flat[np.arange(total) + shift])
            sums = np.concatenate([[0], np.cumsum(many)])
            edge = np.concatenate([[0], np.cumsum([len(f) for f in found])])
            counts.append(sums[edge[1:]] - sums[edge[:-1]])
            if len(self.index) > KEPT:
                self.clear()
            at = to
        return (np.concatenate(flats), np.concatenate(counts)) if flats else (np.zeros(0, np.int32), np.zeros(0, np.int64))


class Decoder:
    def __init__(self, v: Vocabulary):
        as_byte = {i: bytes([b]) for b, i in enumerate(v.byte)}
        self.table = [b"" if i in v.drop else as_byte.get(i, p.replace(SPACE, " ").encode()) for i, p in enumerate(v.pieces)]

    def decode(self, ids: list[int]) -> str:
        """The text; the space that encoding puts in front is taken off again."""
        text = b"".join(map(self.table.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


_made: dict[tuple, tuple[Encoder, Decoder]] = {}


def _coders(v: Vocabulary) -> tuple[Encoder, Decoder]:
    """One pair per Python worker and vocabulary."""
    key = (len(v.pieces), hash(v.pieces))
    if key not in _made:
        _made.clear()
        _made[key] = Encoder(v), Decoder(v)
    return _made[key]


def _as_lists(ids: np.ndarray, counts: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), pa.array(ids, pa.int32()))


def _mapped(df: DataFrame, cols: list[str], model: str, out: str, work) -> DataFrame:
    """``work(coders, columns)`` on each batch of the named columns, the first of which is kept."""
    ship(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(load(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coders = _coders(shared.value)
        for batch in batches:
            made = work(coders, batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), *made.values()], names=[cols[0], *made])

    rows = df.select(*[df[c] for c in cols])
    return rows.mapInArrow(run, f"`{cols[0]}` {rows.schema[0].dataType.simpleString()}, {out}")


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str = MODEL) -> DataFrame:
    """One row per document: id, ids, n_ids."""
    def work(coders, texts):
        ids, counts = coders[0].encode([t or "" for t in texts.to_pylist()])
        return {"ids": _as_lists(ids, counts), "n_ids": pa.array(counts, pa.int64())}

    return _mapped(docs, [id_col, text_col], model, "ids array<int>, n_ids long", work)


def decode(encoded: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", model: str = MODEL) -> DataFrame:
    """One row per row: id, text."""
    def work(coders, lists):
        return {"text": pa.array([coders[1].decode(ids or []) for ids in lists.to_pylist()], pa.string())}

    return _mapped(encoded, [id_col, ids_col], model, "text string", work)


def encode_checked(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str = MODEL) -> DataFrame:
    """``encode`` with ``round_trip``: whether the decoded ids are the text again (U+2581 read as a space)."""
    def work(coders, texts):
        texts = [t or "" for t in texts.to_pylist()]
        ids, counts = coders[0].encode(texts)
        ends = np.cumsum(counts)
        same = [coders[1].decode(ids[b - n : b].tolist()) == t.replace(SPACE, " ") for t, b, n in zip(texts, ends.tolist(), counts.tolist(), strict=True)]
        return {"ids": _as_lists(ids, counts), "n_ids": pa.array(counts, pa.int64()), "round_trip": pa.array(same, pa.bool_())}

    return _mapped(docs, [id_col, text_col], model, "ids array<int>, n_ids long, round_trip boolean", work)
