"""Vectorised character and word measures of text batches (numpy, inside tasks)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Character classes: bits of the class table.
SPACE, UPPER, LETTER, DIGIT, STOP, PUNCT, SYMBOL = 1, 2, 4, 8, 16, 32, 64
#: White space as the word rule has it, and ordinary punctuation (fixed values).
BLANKS, STOPS, ORDINARY = " \t\n\v\f\r", ".!?", ",;:'\"()-"
_classes = np.zeros(0x110000, np.uint8)
#: Multiplier of the polynomial word hash (odd, so it has an inverse modulo 2^64).
_BASE = 0x9E3779B97F4A7C15


def _class_of(code: int) -> int:
    c = chr(code)
    if c in BLANKS:
        return SPACE
    if c in STOPS:
        return STOP
    if c in ORDINARY:
        return PUNCT
    if c.isalpha():
        return LETTER | (UPPER if c.isupper() else 0)
    return DIGIT if c.isdigit() else SYMBOL


def codes_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def classes_of(codes: np.ndarray) -> np.ndarray:
    """The class bits of each code point; the table fills as code points turn up."""
    found = _classes[codes]
    if not found.all():
        for code in np.unique(codes[found == 0]):
            _classes[code] = _class_of(int(code))
        found = _classes[codes]
    return found


_powers: dict[str, np.ndarray] = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _power(name: str, n: int) -> np.ndarray:
    if len(_powers[name]) < n:
        base = _BASE if name == "up" else pow(_BASE, -1, 1 << 64)
        steps = np.full(n, base, np.uint64)
        steps[0] = 1
        _powers[name] = np.cumprod(steps, dtype=np.uint64)
    return _powers[name][:n]


def words_of(codes: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and 64-bit hash of each word (a run without white space)."""
    inside = np.concatenate([[False], (classes & SPACE) == 0, [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    n = len(codes)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * _power("up", n), out=sums[1:])
    hashes = (sums[ends] - sums[starts]) * _power("down", n)[starts] if n else sums[:0]
    return starts, ends, hashes ^ (hashes >> np.uint64(29))


def batches(texts: list[str], most: int) -> Iterator[list[str]]:
    """Consecutive runs of texts of at most ``most`` characters together; a longer text comes alone."""
    run, size = [], 0
    for t in texts:
        if run and size + len(t) > most:
            yield run
            run, size = [], 0
        run.append(t)
        size += len(t)
    if run:
        yield run


def cut(text: str, most: int) -> list[str]:
    """The text in pieces of whole lines, of about ``most`` characters each; joined by a line feed they are the text."""
    pieces, at = [], 0
    while len(text) - at > most:
        end = text.rfind("\n", at, at + most)
        if end < 0:
            end = text.find("\n", at + most)
        if end < 0:
            break
        pieces.append(text[at:end])
        at = end + 1
    return [*pieces, text[at:]]
