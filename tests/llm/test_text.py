"""Vectorised words, shingles and token ids against plain Python."""

import random
import re

import numpy as np
import pyarrow as pa

from starmart.llm import encode, textvec

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s or "")


def strings(n, seed=0):
    rng = random.Random(seed)
    parts = ["a", "B", "s", "'", "'s", "'re", "'ll", " ", "  ", "\n", "\t", "1", "23", ".", "!", "é", "ß", "日本", "\u2003", "\u200b", "x", "<|endoftext|>", "\x85", "\x00", " '", "don't", "we've", "😀", "e\u0301", "\r\n", "\xa0", "÷"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for _ in range(n)] + ["", None, "'", "'s", " 's"]


def test_words_and_shingles():
    texts = strings(400)
    seen = {}
    for i, j, w in textvec.each_chunk(pa.array(texts)):
        values, begin = w.shingles(3)
        for d in range(i, j):
            want = WORD.findall(lower(texts[d]))
            f, e = w.first[d - i], w.first[d - i + 1]
            got = [textvec.LOWER[w.buf[a:b]].tobytes().decode() for a, b in zip(w.start[f:e], w.end[f:e])]
            assert got == want
            grams = [tuple(want[k : k + 3]) for k in range(len(want) - 2)] or ([tuple(want)] if want else [])
            own = values[begin[d - i] : begin[d - i + 1]].tolist()
            assert len(own) == len(grams)
            for g, h in zip(grams, own):
                assert seen.setdefault(g, h) == h
    assert len(set(seen.values())) == len(seen)


def test_ids_are_those_of_the_library():
    e = encode.Encoder(encode.vocabulary())
    texts = strings(6000, 1)
    want = [x.ids for x in e.tok.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    for _ in range(2):  # the second time from the table
        got = []
        for i, j, ids, begin in e.encode(pa.array(texts)):
            got += [ids[begin[k] : begin[k + 1]].tolist() for k in range(j - i)]
        assert got == want


def test_piece_table_starts_anew(monkeypatch):
    monkeypatch.setattr(encode, "MAX_PIECES", 50)
    monkeypatch.setattr(encode, "ENCODE_BYTES", 64)
    e = encode.Encoder(encode.vocabulary())
    texts = strings(300, 2)
    want = [len(x.ids) for x in e.tok.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    got = np.concatenate([np.diff(b) for _, _, _, b in e.encode(pa.array(texts))])
    assert got.tolist() == want


def test_minima_match_brute_force():
    a, b = textvec.permutations(7)
    v = np.arange(1, 40, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    begin = np.array([0, 10, 10, 39])
    got = textvec.minima(v, begin, a, b)
    for d, k in ((0, 0), (0, 6), (2, 3)):
        assert got[d, k] == (v[begin[d] : begin[d + 1]] * a[k] + b[k]).min()
    assert (got[1] == np.iinfo(np.uint64).max).all()
