"""Vectorised work on texts as UTF-8 bytes: words, their hashes, shingles."""

from __future__ import annotations

import numpy as np

U64 = np.uint64
_MULT = U64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64 bits; every bit of x reaches every bit of the result."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(32)
    x *= U64(0xD6E8FEB86659FD93)
    x ^= x >> U64(32)
    x *= U64(0xD6E8FEB86659FD93)
    x ^= x >> U64(32)
    return x


#: A fixed random value of 64 bits for each byte.
BYTE_VALUE = mix(np.arange(1, 257, dtype=U64) * _MULT)

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def words(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, text index) of each maximal run of bytes that are no white space.

    offs bounds the texts in buf; a word never crosses such a bound.
    """
    n = len(buf)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, z
    solid = ~IS_SPACE[buf]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    edge = offs[1:-1]
    edge = edge[(edge > 0) & (edge < n)]
    first[edge] = solid[edge]
    last = solid.copy()
    last[:-1] &= ~solid[1:]
    last[edge - 1] = solid[edge - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return start, end, np.searchsorted(offs, start, side="right") - 1


_powers = np.ones(1, U64)
_inverse = np.ones(1, U64)
_BASE = U64(0x2545F4914F6CDD1D)
_BASE_INV = U64(pow(0x2545F4914F6CDD1D, -1, 2**64))


def _power_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers, _inverse
    if len(_powers) < n:
        m = max(n, 1 << 20)
        up, down = np.full(m, _BASE, U64), np.full(m, _BASE_INV, U64)
        up[0] = down[0] = 1
        _powers, _inverse = np.multiply.accumulate(up), np.multiply.accumulate(down)
    return _powers[:n], _inverse[:n]


def run_hash(buf: np.ndarray, start: np.ndarray, end: np.ndarray, piece: int = 1 << 20) -> np.ndarray:
    """A 64-bit hash of the bytes of each run; equal runs have equal hashes wherever they stand.

    Runs are in order of start and do not overlap.
    """
    out = np.zeros(len(start), U64)
    i = 0
    while i < len(start):
        a = start[i]
        j = max(i + 1, int(np.searchsorted(end, a + piece, side="right")))
        b = end[j - 1]
        up, down = _power_table(int(b - a) + 1)
        total = np.zeros(int(b - a) + 1, U64)
        np.cumsum(BYTE_VALUE[buf[a:b]] * up[:-1], out=total[1:])
        s, e = start[i:j] - a, end[i:j] - a
        out[i:j] = (total[e] - total[s]) * down[s] + (e - s).astype(U64) * _MULT
        i = j
    return mix(out)


def span_hash(buf: np.ndarray, start: np.ndarray, size: int, piece: int = 1 << 20) -> np.ndarray:
    """A 64-bit hash of the size bytes from each start on; starts are in order and may overlap."""
    out = np.zeros(len(start), U64)
    i = 0
    while i < len(start):
        a = start[i]
        j = int(np.searchsorted(start, a + piece, side="right"))
        b = start[j - 1] + size
        up, down = _power_table(int(b - a) + 1)
        total = np.zeros(int(b - a) + 1, U64)
        np.cumsum(BYTE_VALUE[buf[a:b]] * up[:-1], out=total[1:])
        s = start[i:j] - a
        out[i:j] = (total[s + size] - total[s]) * down[s]
        i = j
    return mix(out)


def shingles(word: np.ndarray, text: np.ndarray, n_texts: int, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text index) of the distinct shingles of each text, in order of text and hash.

    A text of fewer words than width has its whole sequence as one shingle; one without words none.
    """
    n = np.bincount(text, minlength=n_texts)
    h = np.zeros(max(0, len(word) - width + 1), U64)
    salt = np.arange(1, width + 1, dtype=U64) * _MULT
    for k in range(width):
        h += mix(word[k : len(word) - width + 1 + k] + salt[k]) if len(h) else h
    whole = text[: len(h)] == text[width - 1 :] if len(h) else np.zeros(0, bool)
    h, t = mix(h[whole]), text[: len(whole)][whole]
    short = np.flatnonzero((n > 0) & (n < width))
    if len(short):
        begin = np.concatenate([[0], np.cumsum(n)])[short]
        s = n[short].astype(U64) * U64(0xA0761D6478BD642F)
        for k in range(width - 1):
            has = n[short] > k
            s[has] += mix(word[begin[has] + k] + salt[k])
        h, t = np.concatenate([h, mix(s)]), np.concatenate([t, short])
    return distinct_by_text(h, t)


def distinct_by_text(h: np.ndarray, t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct (text, hash) pairs, sorted."""
    if len(t) and (t[1:] < t[:-1]).any():
        o = np.argsort(t, kind="stable")
        h, t = h[o], t[o]
    else:
        h = h.copy()
    cut = np.flatnonzero(np.concatenate([[True], t[1:] != t[:-1], [True]])) if len(t) else []
    for a, b in zip(cut[:-1], cut[1:], strict=True):
        h[a:b].sort()
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (t[1:] != t[:-1])
    return h[new], t[new]


def bounds(sorted_ids: np.ndarray, n: int) -> np.ndarray:
    """Offsets of each of n groups in a sorted index array."""
    return np.searchsorted(sorted_ids, np.arange(n + 1))


def planes(a: np.ndarray) -> np.ndarray:
    """The bytes of numbers, all first ones first, as they pack best."""
    return np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.itemsize).T).ravel()


def from_planes(b: np.ndarray, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(b.reshape(size, len(b) // size).T).ravel().view(kind)
