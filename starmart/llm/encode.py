"""Byte-level BPE ids of whole texts, exactly those of the ``tokenizers`` library.

BPE never merges across pre-tokens, so a text's ids are the ids of its
pre-tokens in a row. A task cuts a chunk of texts into pre-tokens with a few
numpy passes over its code points, looks their hashes up in a table of pieces
seen before and asks ``tokenizers`` only for new ones. The table is bounded
(``MAX_PIECES``; it starts anew when full). A text with a character outside
the well-known ranges goes through ``tokenizers`` as a whole.
"""

from __future__ import annotations

import os
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from starmart.llm import textvec as V

MAX_PIECES = 400_000
ENCODE_BYTES = 1 << 18  # texts vectorised at a time
_BITS = 20
_LETTER, _NUMBER, _SPACE, _OTHER, _UNSURE = range(5)
_LIMIT = 0x2E80
_state: dict[str, Encoder] = {}


def _classes() -> np.ndarray:
    """Class of each code point below ``_LIMIT``; unsure where Unicode versions or libraries might differ."""
    old = unicodedata.ucd_3_2_0
    out = np.full(_LIMIT + 1, _UNSURE, dtype=np.uint8)
    for c in range(_LIMIT):
        kind = unicodedata.category(chr(c))
        if kind != old.category(chr(c)) or kind in ("Cn", "Cs", "Co"):
            continue
        if kind[0] in "LN":
            out[c] = _LETTER if kind[0] == "L" else _NUMBER
        elif c in (9, 10, 13, 32, 0xA0):
            out[c] = _SPACE
        elif kind[0] in "PSM" or 0 <= c < 9:
            out[c] = _OTHER
    return out


class Encoder:
    """Ids for Arrow string columns, with a table of known pre-tokens."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = True
        self.cls = _classes()
        self.value = np.random.default_rng(99).integers(1, 1 << 63, size=_LIMIT + 1, dtype=np.uint64)
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that byte-level BPE writes as themselves
        others = [b for b in range(256) if b not in printable]
        self.letters = str.maketrans({chr(b): chr(256 + k) for k, b in enumerate(others)})
        self.model = self.tok.model
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(1 << _BITS, dtype=np.uint64)
        self.slot = np.zeros(1 << _BITS, dtype=np.int32)
        self.begin = np.zeros(1 << 16, dtype=np.int32)
        self.size = np.zeros(1 << 16, dtype=np.int32)
        self.ids = np.zeros(1 << 18, dtype=np.int32)
        self.n = self.n_ids = 0

    def _find(self, h: np.ndarray) -> np.ndarray:
        """Piece numbers, -1 where unknown."""
        at = (h >> np.uint64(64 - _BITS)).astype(np.int64)
        k = self.keys[at]
        out = np.where(k == h, self.slot[at], -1)
        rest = np.flatnonzero((k != h) & (k != 0))
        while len(rest):
            at[rest] = (at[rest] + 1) & ((1 << _BITS) - 1)
            k = self.keys[at[rest]]
            hit = k == h[rest]
            out[rest[hit]] = self.slot[at[rest[hit]]]
            rest = rest[~hit & (k != 0)]
        return out

    def _add(self, h: np.ndarray, texts: list[str]) -> None:
        """New distinct hashes with the pre-tokens they stand for."""
        encoded = [[t.id for t in self.model.tokenize(x.encode().decode("latin-1").translate(self.letters))] for x in texts]
        size = np.fromiter(map(len, encoded), np.int32, len(encoded))
        flat = np.fromiter((i for e in encoded for i in e), np.int32, int(size.sum()))
        for name, need in (("begin", self.n + len(h)), ("size", self.n + len(h)), ("ids", self.n_ids + len(flat))):
            old = getattr(self, name)
            if need > len(old):
                setattr(self, name, np.concatenate([old, np.zeros(max(need - len(old), len(old) // 2), old.dtype)]))
        number = np.arange(self.n, self.n + len(h), dtype=np.int32)
        self.begin[number] = self.n_ids + np.cumsum(size) - size
        self.size[number] = size
        self.ids[self.n_ids : self.n_ids + len(flat)] = flat
        self.n, self.n_ids = self.n + len(h), self.n_ids + len(flat)
        at = (h >> np.uint64(64 - _BITS)).astype(np.int64)
        rest = np.arange(len(h))
        while len(rest):
            free = rest[self.keys[at[rest]] == 0]
            self.keys[at[free]] = h[free]
            placed = free[self.keys[at[free]] == h[free]]
            self.slot[at[placed]] = number[placed]
            todo = np.ones(len(h), dtype=bool)
            todo[placed] = False
            rest = rest[todo[rest]]
            at[rest] = (at[rest] + 1) & ((1 << _BITS) - 1)

    def _starts(self, cp: np.ndarray, cls: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Begins of the pre-tokens: contractions; runs of letters, digits or other marks with one
        blank before them; white space, of which the last character before a run stands alone."""
        n = len(cp)
        doc = np.zeros(n + 1, dtype=bool)
        doc[off] = True
        st = np.zeros(n + 3, dtype=bool)
        st[1:n] = cls[1:] != cls[:-1]
        st[:n] |= doc[:n]
        begin = np.flatnonzero(st[:n])
        end = np.append(begin[1:], n)
        goes_on = ~doc[end]  # another run of the same text follows
        space = (cls[begin] == _SPACE) & goes_on
        last = end[space] - 1
        st[last] = True
        joined = last[cp[last] == 32] + 1
        st[joined] = False
        quote = begin[(cls[begin] == _OTHER) & (end - begin == 1) & goes_on & (cp[begin] == 39)]
        if len(quote):
            quote = quote[st[quote] & (cls[quote + 1] == _LETTER)]
        if len(quote):
            c1 = cp[quote + 1]
            inside = ~doc[np.minimum(quote + 2, n)]
            c2 = np.where(inside, cp[np.minimum(quote + 2, n - 1)], 0)
            one = np.isin(c1, [ord(c) for c in "stmd"])
            two = ((c2 == ord("e")) & ((c1 == ord("r")) | (c1 == ord("v")))) | ((c1 == ord("l")) & (c2 == ord("l")))
            for q, k in ((quote[one], 1), (quote[two & ~one], 2)):
                st[q + 1] = False
                st[q + 1 + k] = True  # the rest of the letters, or the next run, which begins there anyway
        return np.flatnonzero(st[:n])

    def _sure(self, cp: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, begin of each text's ids) for texts of sure characters only."""
        cls = self.cls[cp]
        st = self._starts(cp, cls, off)
        p, q = V._powers(len(cp))
        s = np.zeros(len(cp) + 1, dtype=np.uint64)
        np.cumsum(self.value[cp] * p[: len(cp)], out=s[1:])
        end = np.append(st[1:], len(cp))
        h = V.mix((s[end] - s[st]) * q[st])
        h[h == 0] = 1
        piece = self._find(h)
        new = np.flatnonzero(piece < 0)
        if len(new):
            if self.n > MAX_PIECES:
                self.clear()
                new = np.arange(len(h))
            found, first = np.unique(h[new], return_index=True)
            at = new[first]
            self._add(found, [cp[a:b].astype("<u4").tobytes().decode("utf-32-le") for a, b in zip(st[at].tolist(), end[at].tolist())])
            piece[new] = self._find(h[new])
        size = self.size[piece].astype(np.int64)
        upto = np.cumsum(size)
        ids = self.ids[np.repeat(self.begin[piece] - (upto - size), size) + np.arange(int(upto[-1]) if len(upto) else 0)]
        return ids, np.append(0, upto)[np.searchsorted(st, off)]

    def encode(self, col) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(i, j, ids, begin) for chunks of whole texts [i, j): ids in a row, and where each text's begin (and the end)."""
        buf, off = V.utf8(col)
        for i, j in V.chunks(off, ENCODE_BYTES):
            data = buf[off[i] : off[j]]
            cp = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), dtype=np.uint32)
            lead = np.append(0, np.cumsum((data & 0xC0) != 0x80))  # code points before each byte
            at = lead[off[i : j + 1] - off[i]]
            cp = np.minimum(cp, _LIMIT).astype(np.int64) if len(cp) and cp.max() >= _LIMIT else cp.astype(np.int64)
            unsure = np.append(0, np.cumsum(self.cls[cp] == _UNSURE))
            odd = np.flatnonzero(unsure[at[1:]] > unsure[at[:-1]])
            if not len(odd):
                ids, begin = self._sure(cp, at)
                yield i, j, ids, begin
                continue
            texts = [data[a:b].tobytes().decode() for a, b in zip((off[i + odd] - off[i]).tolist(), (off[i + odd + 1] - off[i]).tolist())]
            whole = [np.array(e.ids, dtype=np.int32) for e in self.tok.encode_batch(texts, add_special_tokens=False)]
            keep = np.ones(j - i, dtype=bool)
            keep[odd] = False
            char = np.repeat(keep, np.diff(at))
            size = np.where(keep, np.diff(at), 0)
            ids, begin = self._sure(cp[char], np.append(0, np.cumsum(size)))
            parts, k = [], 0
            for d in range(j - i):
                if keep[d]:
                    parts.append(ids[begin[d] : begin[d + 1]])
                else:
                    parts.append(whole[k])
                    k += 1
            yield i, j, np.concatenate(parts), np.append(0, np.cumsum([len(x) for x in parts]))


def encoder(path: str) -> Encoder:
    """The worker's encoder for a vocabulary file; it outlives a task."""
    if path not in _state:
        _state[path] = Encoder(path)
    return _state[path]


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    """Path of a public tokenizer's vocabulary file on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def lengths(col: pa.Array, path: str) -> np.ndarray:
    """Number of ids of each text."""
    parts = [np.diff(begin) for _, _, _, begin in encoder(path).encode(col)]
    return np.concatenate(parts) if parts else np.zeros(0, np.int64)
