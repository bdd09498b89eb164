"""Hashed word shingles of texts, and random numbers that follow from them."""

from __future__ import annotations

import sys

import numpy as np

WORDS = 5
# White space as str.split() has it, as a class for regular expressions of SQL functions.
SPACE = "[" + "".join(f"\\x{{{c:x}}}" for c in range(sys.maxunicode) if chr(c).isspace()) + "]"
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of x bears on every bit of the result."""
    x = x.astype(np.uint64, copy=True)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def uniform(x: np.ndarray) -> np.ndarray:
    """Numbers in (0, 1) from 64-bit hashes."""
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


_tables: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of GOLDEN and of its inverse modulo 2^64, at least n of each."""
    if len(_tables.get("powers", ())) < n:
        size = 1 << max(16, int(n).bit_length())
        for name, base in (("powers", int(GOLDEN)), ("inverse", pow(int(GOLDEN), -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _tables[name] = np.cumprod(steps)
    return _tables["powers"], _tables["inverse"]


def _is_space() -> np.ndarray:
    """Whether each code point is white space, as str.split() has it."""
    if "space" not in _tables:
        _tables["space"] = np.array([chr(c).isspace() for c in range(sys.maxunicode + 1)])
    return _tables["space"]


def word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-case words of all texts in a row, and the bounds of each text's.

    A word's hash is a polynomial of its code points, taken as a difference of running sums over
    all texts, so that no word is handled by itself.
    """
    lower = [t.lower() if t else "" for t in texts]
    points = np.frombuffer("\n".join([*lower, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    inside = np.concatenate([[False], ~_is_space()[points], [False]]).astype(np.int8)
    edges = np.diff(inside)
    first, end = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    texts_end = np.cumsum([len(t) + 1 for t in lower]) if lower else np.empty(0, np.int64)
    ends = np.concatenate([[0], np.searchsorted(first, texts_end)]).astype(np.int64)
    if not len(first):
        return np.empty(0, np.uint64), ends
    powers, inverse = _powers(len(points))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(
        (points.astype(np.uint64) + np.uint64(1)) * powers[:len(points)])])
    return mix((sums[end] - sums[first]) * inverse[first]), ends


def shingles(texts: list[str | None], words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the word windows of all texts in a row, and the bounds of each text's.

    The i-th window of a text begins at its i-th word. A text of fewer words than a window has one,
    of all its words; a text without words has none.
    """
    w, ends = word_hashes(texts)
    n = np.diff(ends)
    count = np.where(n == 0, 0, np.maximum(n - words + 1, 1))
    bounds = np.concatenate([[0], np.cumsum(count)])
    first = np.arange(bounds[-1]) + np.repeat(ends[:-1] - bounds[:-1], count)
    stop = np.repeat(ends[1:], count)
    out = np.zeros(len(first), np.uint64)
    for k in range(words):
        at = first + k
        inside = at < stop
        out[inside] = mix(out[inside] * GOLDEN + w[at[inside]] + np.uint64(k + 1))
    return out, bounds


def counted(hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct hashes of each text, how often each occurs, and the text each belongs to."""
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    order = np.lexsort((hashes, text))
    h, t = hashes[order], text[order]
    if not len(h):
        return h, np.empty(0, np.int64), t
    new = np.concatenate([[True], (h[1:] != h[:-1]) | (t[1:] != t[:-1])])
    at = np.flatnonzero(new)
    return h[at], np.diff(np.append(at, len(h))), t[at]
