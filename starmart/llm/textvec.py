"""Whole-text vectorisation for Arrow tasks: byte buffers, words, word hashes, shingles.

A task hands over one Arrow string column. Its UTF-8 bytes stay in one buffer
and every step (lower-casing, word bounds, hashing) is a few numpy passes over
it. Words are maximal runs of ASCII letters, digits and non-ASCII characters;
in UTF-8 every byte of a non-ASCII character is >= 0x80, so classifying bytes is
exact. A word hash is a polynomial in an odd base over random 64-bit byte
values, modulo 2**64, finished with a bit mixer; equal words have equal hashes
in every task and run (the constants come from a fixed seed).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 20  # texts are vectorised in chunks of whole documents of about this size

_rng = np.random.default_rng(20240607)
_BASE = np.uint64(int(_rng.integers(1, 1 << 62)) * 2 + 1)
_BASE_INV = np.uint64(pow(int(_BASE), -1, 1 << 64))
_BYTE = _rng.integers(1, 1 << 63, size=256, dtype=np.uint64)
_MIX = np.uint64(0x9E3779B97F4A7C15)
_MIX2 = np.uint64(0xBF58476D1CE4E5B9)
POS = _rng.integers(1, 1 << 62, size=64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)  # word position in a shingle

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_ALNUM = np.zeros(256, dtype=bool)
_ALNUM[48:58] = _ALNUM[65:91] = _ALNUM[97:123] = _ALNUM[128:] = True
_NONSPACE = np.ones(256, dtype=bool)
_NONSPACE[[9, 10, 11, 12, 13, 32]] = False
_BYTE_LOWER = _BYTE[LOWER]

_pow = {"p": np.ones(1, dtype=np.uint64), "q": np.ones(1, dtype=np.uint64)}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of the base and of its inverse (kept for the chunk size, not for one huge text)."""
    if len(_pow["p"]) <= n:
        m = max(n, CHUNK_BYTES) + 1
        out = []
        for b in (_BASE, _BASE_INV):
            a = np.full(m, b, dtype=np.uint64)
            a[0] = 1
            out.append(np.multiply.accumulate(a))
        if n > CHUNK_BYTES:
            return out[0], out[1]
        _pow["p"], _pow["q"] = out
    return _pow["p"], _pow["q"]


def mix(h: np.ndarray) -> np.ndarray:
    """Bit mixer on uint64 (a bijection), so that every bit depends on all bits."""
    h = (h ^ (h >> np.uint64(31))) * _MIX
    h = (h ^ (h >> np.uint64(29))) * _MIX2
    return h ^ (h >> np.uint64(32))


def utf8(col: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null is an empty text."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if not pa.types.is_large_string(col.type):
        col = col.cast(pa.large_string())
    if col.null_count:
        col = pc.fill_null(col, "")
    if not len(col):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offs, data = col.buffers()
    off = np.frombuffer(offs, dtype=np.int64)[col.offset : col.offset + len(col) + 1]
    buf = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return buf[off[0] : off[-1]], off - off[0]


def chunks(off: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges [i, j) of whole documents of at most ``limit`` bytes (one document where it alone is longer)."""
    i, n = 0, len(off) - 1
    while i < n:
        j = int(np.searchsorted(off, off[i] + limit, side="right")) - 1
        j = min(n, max(j, i + 1))
        yield i, j
        i = j


class Words:
    """Words of the documents of one chunk.

    ``hash``: a 64-bit hash for each word, ``start``/``end``: its bytes in
    ``buf``, ``first``: for each document (and the end) the index of its first word.
    """

    def __init__(self, buf: np.ndarray, off: np.ndarray, spaced: bool = False):
        self.buf, self.off = buf, off
        mask = (_NONSPACE if spaced else _ALNUM)[buf]
        n = len(buf)
        edge = np.zeros(n + 1, dtype=bool)
        if n:
            edge[0], edge[n] = mask[0], mask[-1]
            np.not_equal(mask[1:], mask[:-1], out=edge[1:n])
            # a word ends where its document ends, though the next text goes on without a gap
            cut = np.unique(off[1:-1])
            cut = cut[(cut > 0) & (cut < n)]
            glued = cut[mask[cut] & mask[cut - 1]]
        else:
            glued = np.zeros(0, np.int64)
        at = np.flatnonzero(edge)
        if len(glued):
            at = np.sort(np.concatenate([at, glued, glued]))
        self.start, self.end = at[0::2], at[1::2]
        p, q = _powers(n)
        s = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(_BYTE_LOWER[buf] * p[:n], out=s[1:])
        self.hash = mix((s[self.end] - s[self.start]) * q[self.start])
        self.first = np.searchsorted(self.start, off)

    def shingles(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all runs of ``n`` words and, for each document (and the end), the index of
        its first one. A document of fewer words, but not none, has one shingle: all its words."""
        h, first = self.hash, self.first
        count = np.diff(first)
        m = len(h)
        full = np.zeros(m, dtype=np.uint64)
        if m >= n:
            for j in range(n):
                full[: m - n + 1] += h[j : m - n + 1 + j] * POS[j]
        per = np.where(count >= n, count - n + 1, (count > 0).astype(np.int64))
        for short in range(1, n):
            at = first[:-1][count == short]
            if len(at):
                v = np.full(len(at), short, dtype=np.uint64) * _MIX2
                for j in range(short):
                    v = v + h[at + j] * POS[j + n]
                full[at] = v
        begin = np.concatenate([[0], np.cumsum(per)])
        if begin[-1] == 0:
            return np.zeros(0, np.uint64), begin
        idx = np.arange(begin[-1]) - np.repeat(begin[:-1] - first[:-1], per)
        return mix(full[idx]), begin


def each_chunk(col, spaced: bool = False) -> Iterator[tuple[int, int, Words]]:
    """(i, j, words) for chunks of whole documents [i, j) of an Arrow string column."""
    buf, off = utf8(col)
    for i, j in chunks(off):
        yield i, j, Words(buf[off[i] : off[j]], off[i : j + 1] - off[i], spaced)


def minima(values: np.ndarray, begin: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """MinHash minima, one row a document and one column a permutation x -> a*x+b (mod 2**64).

    A document without values has the maximum everywhere. Works through the values in
    cache-sized blocks of whole documents.
    """
    docs = len(begin) - 1
    out = np.full((docs, len(a)), np.iinfo(np.uint64).max, dtype=np.uint64)
    some = np.flatnonzero(np.diff(begin) > 0)
    if not len(some):
        return out
    start, end = begin[some], begin[some + 1]
    i = 0
    while i < len(some):
        j = int(np.searchsorted(end, start[i] + 16384, side="right"))
        j = max(j, i + 1)
        x, at = values[start[i] : end[j - 1]], start[i:j] - start[i]
        rows = some[i:j]
        for k in range(len(a)):
            out[rows, k] = np.minimum.reduceat(x * a[k] + b[k], at)
        i = j
    return out


def permutations(k: int, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """``k`` universal hash functions: odd multipliers and offsets modulo 2**64."""
    rng = np.random.default_rng(seed)
    return rng.integers(0, 1 << 62, size=k, dtype=np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 1 << 63, size=k, dtype=np.uint64)


def signatures(col, n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """uint16 signatures (documents x permutations) of the ``n``-word shingles of whole texts."""
    parts = []
    for i, j, w in each_chunk(col):
        values, begin = w.shingles(n)
        low = minima(values, begin, a, b)
        parts.append((mix(low) >> np.uint64(48)).astype(np.uint16))
    return np.concatenate(parts) if parts else np.zeros((0, len(a)), np.uint16)
