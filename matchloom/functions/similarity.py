"""Similarity of names, many pairs at a time: the same numbers as the functions of one pair in ``names``.

A batch of pairs is made of few different names. What concerns one name (its words, their order, the places of its
letters) is worked out once for each; what concerns a pair is done by arrays over all pairs. Common subsequences are
counted by bit-parallel rows, 64 letters at most; pairs of two longer names go through the function of one pair.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd

#: Letters of a row of bits, and words of a name that fit the key of a set of words.
BITS, WORDS = 64, 30


def _letters(texts: list[str]) -> np.ndarray:
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)


def _codes(sizes: np.ndarray, letters: np.ndarray) -> np.ndarray:
    """The letters of each text in a row, -1 after its end."""
    out = np.full((len(sizes), int(sizes.max(initial=0))), -1, np.int64)
    out[np.arange(out.shape[1]) < sizes[:, None]] = letters
    return out


def common(left: list[str], i: np.ndarray, right: list[str], j: np.ndarray, single: Callable[[str, str], int] | None, kept: tuple[np.ndarray, np.ndarray] | None = None) -> np.ndarray:
    """Length of the longest common subsequence of ``left[i]`` and ``right[j]``, pair by pair.

    ``kept`` has, for each pair, the places of the letters that count on both sides; names have ``BITS`` letters at most then.
    """
    size_a, size_b, all_a, all_b = _lengths(left), _lengths(right), _letters(left), _letters(right)
    there = np.zeros(1 + int(max(all_a.max(initial=0), all_b.max(initial=0))), bool)
    there[all_a] = there[all_b] = True
    number = np.cumsum(there) - 1
    a, b = _codes(size_a, number[all_a]), _codes(size_b, number[all_b])
    if kept is not None:
        return _rows(a, size_a, i, b, j, int(number[-1]) + 1, kept)
    out = np.zeros(len(i), np.int64)
    short = size_a[i] <= BITS
    turned = ~short & (size_b[j] <= BITS)
    for at, rows, columns, sizes, x, y in ((short, a, b, size_a, i, j), (turned, b, a, size_b, j, i)):
        if at.any():
            out[at] = _rows(rows, sizes, x[at], columns, y[at], int(number[-1]) + 1)
    for p in np.flatnonzero(~short & ~turned):
        out[p] = single(left[i[p]], right[j[p]])
    return out


def _rows(a: np.ndarray, sizes: np.ndarray, i: np.ndarray, b: np.ndarray, j: np.ndarray, letters: int, kept: tuple[np.ndarray, np.ndarray] | None = None) -> np.ndarray:
    places = np.zeros((len(a), letters + 1), np.uint64)  # the last column is that of no letter
    for k in range(min(a.shape[1], BITS)):
        there = np.flatnonzero((a[:, k] >= 0) & (sizes <= BITS))
        places[there, a[there, k]] |= np.uint64(1 << k)
    flat, base = places.ravel(), i * (letters + 1)
    steps = np.ascontiguousarray(np.where(b < 0, letters, b).T)
    row = np.full(len(i), np.iinfo(np.uint64).max, np.uint64)
    for k, column in enumerate(steps):
        u = row & flat[base + column[j]]
        if kept is not None:
            u &= kept[0] & (np.uint64(0) - (kept[1] >> np.uint64(k) & np.uint64(1)))
        row = (row + u) | (row - u)
    n = sizes[i]
    full = np.where(n >= BITS, np.iinfo(np.uint64).max, (np.uint64(1) << np.minimum(n, BITS - 1).astype(np.uint64)) - np.uint64(1))
    return n - np.bitwise_count(row & full).astype(np.int64)


def _ratio(found: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    return np.where(sizes > 0, 200.0 * found / np.maximum(sizes, 1), 100.0)


def _lengths(texts: list[str]) -> np.ndarray:
    return np.array([len(t) for t in texts], np.int64)


class Pairs:
    """Pairs (left[i], right[j]) of names."""

    def __init__(self, left: list[str], i: np.ndarray, right: list[str], j: np.ndarray, one):
        """``one`` has the functions of one pair: common_subsequence and set_ratio."""
        self.left, self.i, self.right, self.j, self.one = left, i, right, j, one

    def plain(self) -> np.ndarray:
        found = common(self.left, self.i, self.right, self.j, self.one.common_subsequence)
        return _ratio(found, _lengths(self.left)[self.i] + _lengths(self.right)[self.j])

    def strict(self) -> np.ndarray:
        a, b = ([" ".join(sorted(t.split())) for t in names] for names in (self.left, self.right))
        both = (_lengths(self.left)[self.i] > 0) & (_lengths(self.right)[self.j] > 0)
        found = common(a, self.i, b, self.j, self.one.common_subsequence)
        return np.where(both, _ratio(found, _lengths(a)[self.i] + _lengths(b)[self.j]), 0.0)

    def sets(self) -> np.ndarray:
        words_a, words_b = ([sorted(set(t.split())) for t in names] for names in (self.left, self.right))
        fits = [np.array([len(w) <= WORDS and sum(map(len, w)) + len(w) <= BITS for w in ws], bool) for ws in (words_a, words_b)]
        fit, out = fits[0][self.i] & fits[1][self.j], np.zeros(len(self.i))
        for p in np.flatnonzero(~fit):
            out[p] = self.one.set_ratio(self.left[self.i[p]], self.right[self.j[p]])
        if fit.any():
            short = lambda ws, ok: [w if f else [] for w, f in zip(ws, ok, strict=True)]
            out[fit] = _sets(short(words_a, fits[0]), self.i[fit], short(words_b, fits[1]), self.j[fit])
        return out

    def score(self) -> np.ndarray:
        return np.maximum(self.sets(), self.strict())

    def rooms(self, filler: frozenset[str]) -> np.ndarray:
        """The better of the scores with and without the filler words."""
        bare_a, bare_b = ([" ".join(t for t in n.split() if t not in filler) for n in names] for names in (self.left, self.right))
        differ = np.array([x != y for x, y in zip(bare_a, self.left, strict=True)], bool)[self.i] | np.array([x != y for x, y in zip(bare_b, self.right, strict=True)], bool)[self.j]
        out = self.score()
        if differ.any():
            out[differ] = np.maximum(out[differ], Pairs(bare_a, self.i[differ], bare_b, self.j[differ], self.one).score())
        return out


def _words(names: list[list[str]], most: int, number: dict[str, int], none: int) -> np.ndarray:
    out = np.full((len(names), most), none, np.int64)
    for i, ws in enumerate(names):
        out[i, : len(ws)] = [number.setdefault(w, len(number)) for w in ws]
    return out


def _some(names: list[list[str]], i: np.ndarray, chosen: np.ndarray, most: int) -> np.ndarray:
    """The places, in each pair's name, of the letters of its words whose bit is set in ``chosen``, and of the spaces between these words."""
    word, space = np.zeros((most, len(names)), np.uint64), np.zeros((most, len(names)), np.uint64)
    for n, ws in enumerate(names):
        at = 0
        for k, w in enumerate(ws):
            word[k, n] = ((1 << len(w)) - 1) << at
            space[k, n] = 1 << at - 1 if k else 0
            at += len(w) + 1
    out, before = np.zeros(len(i), np.uint64), np.zeros(len(i), bool)
    for k in range(most):
        here = (chosen >> k & 1).astype(bool)
        out |= np.where(here, word[k][i], np.uint64(0)) | np.where(here & before, space[k][i], np.uint64(0))
        before |= here
    return out


def _sets(words_a: list[list[str]], i: np.ndarray, words_b: list[list[str]], j: np.ndarray) -> np.ndarray:
    """The set similarity of names whose words, joined, have ``BITS`` letters at most."""
    most = [max(map(len, w), default=0) for w in (words_a, words_b)]
    number: dict[str, int] = {}
    ids_a, ids_b = (_words(ws, n, number, none) for ws, n, none in ((words_a, most[0], -1), (words_b, most[1], -2)))
    in_a, in_b = np.zeros(len(i), np.int64), np.zeros(len(i), np.int64)
    columns_b = [ids_b[j, q] for q in range(most[1])]
    for p in range(most[0]):
        word = ids_a[i, p]
        for q, other in enumerate(columns_b):
            same = (word == other).astype(np.int64)
            in_a |= same << p
            in_b |= same << q
    rest_a, rest_b = _some(words_a, i, ~in_a, most[0]), _some(words_b, j, ~in_b, most[1])
    both = np.bitwise_count(_some(words_a, i, in_a, most[0])).astype(np.int64)
    x, y = np.bitwise_count(rest_a).astype(np.int64), np.bitwise_count(rest_b).astype(np.int64)
    found = common([" ".join(w) for w in words_a], i, [" ".join(w) for w in words_b], j, None, (rest_a, rest_b))
    size_x, size_y = both + (both > 0) + x, both + (both > 0) + y
    best = 100.0 - 100.0 * (x + y - 2 * found) / np.maximum(size_x + size_y, 1)
    for size in (size_x, size_y):
        best = np.where(both > 0, np.maximum(best, 100.0 - 100.0 * (size - both) / np.maximum(size + both, 1)), best)
    best = np.where((both > 0) & ((x == 0) | (y == 0)), 100.0, best)
    some = [np.array([len(w) > 0 for w in ws], bool)[k] for ws, k in ((words_a, i), (words_b, j))]
    return np.where(some[0] & some[1], best, 0.0)


def pairwise(a: pd.Series, b: pd.Series, measure: Callable[[Pairs], np.ndarray], one) -> pd.Series:
    """``measure`` for each row; null counts as empty, and each pair of names is worked out once."""
    i, left = pd.factorize(a.fillna("").to_numpy(object))
    j, right = pd.factorize(b.fillna("").to_numpy(object))
    if not len(i):
        return pd.Series([], dtype="float64")
    keys, at = np.unique(i.astype(np.int64) * len(right) + j, return_inverse=True)
    return pd.Series(measure(Pairs(list(left), keys // len(right), list(right), keys % len(right), one))[at.reshape(-1)])
