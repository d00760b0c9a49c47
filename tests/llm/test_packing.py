"""Packing: every id once, in order, and cuts as cheap as an exhaustive search finds."""

from collections import defaultdict
from functools import cache
from zlib import crc32

import numpy as np
from llm_data import awkward

from starmart.llm import encode, packing


def cost(cuts, pen, window):
    out = 0
    for a, b in zip(cuts, cuts[1:]):
        n = b - a
        out += (0 if n & (n - 1) == 0 else window - n) + pen[b]
    return out


def test_cuts_are_optimal():
    rng = np.random.default_rng(4)
    for _ in range(60):
        window = 16
        gaps = rng.integers(1, 7, 14)
        places = np.append(0, np.cumsum(gaps))
        pen = rng.integers(0, 6, len(places)).astype(float)
        chosen = packing.choose_cuts(places, pen, window)
        by = dict(zip(places.tolist(), pen.tolist()))

        @cache
        def best(j):
            if j == 0:
                return 0.0
            return min(best(i) + (0 if (n := int(places[j] - places[i])) & (n - 1) == 0 else window - n) + pen[j] for i in range(j) if places[j] - places[i] <= window)

        assert cost(places[chosen].tolist(), by, window) == best(len(places) - 1)


def check(docs, rows, window=1024):
    tok = encode.encoder(encode.vocabulary()).tok
    want = defaultdict(int)
    for r in docs.collect():
        ids = tuple(tok.encode(r.text or "", add_special_tokens=False).ids) + (0,)
        want[(r.doc_id, ids)] += 1
    by_seq = defaultdict(list)
    pieces = defaultdict(list)
    for r in rows:
        by_seq[r.sequence_id].append(r)
        pieces[(r.doc_id, r.doc_tokens)].append(r)
    filled = padded = 0
    for own in by_seq.values():
        own.sort(key=lambda r: r.offset)
        at = 0
        for r in own:
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= window
        filled += at
        padded += at if at & (at - 1) == 0 else window
    assert filled == sum(len(ids) * n for (_, ids), n in want.items())
    for (i, ids), n in want.items():
        own = sorted((r.start, r.length, r.ids_crc32) for r in pieces[(i, len(ids))])
        crcs = defaultdict(int)
        for s, m, c in own:
            crcs[(s, m, c)] += 1
            assert c in {crc32(np.array(x[s : s + m], dtype="<u4").tobytes()) for (j, x) in want if j == i and len(x) == len(ids)}
    return 1 - filled / padded


def test_pack(spark, monkeypatch):
    docs = awkward(spark)
    assert check(docs, packing.report(docs).collect()) < 0.02
    monkeypatch.setattr(packing, "SEGMENT", 700)
    assert check(docs, packing.report(docs).collect()) < 0.05
    assert packing.report(docs.limit(0)).count() == 0


def test_order_is_kept(spark):
    docs = awkward(spark).coalesce(1)
    rows = packing.pack(docs).collect()
    at = [(r.sequence_id, r.offset) for r in rows]
    assert at == sorted(at)
    whole = b"".join(bytes(r.ids) for r in rows)
    tok = encode.encoder(encode.vocabulary()).tok
    ids = [x for r in docs.collect() for x in tok.encode(r.text or "", add_special_tokens=False).ids + [0]]
    assert np.frombuffer(whole, dtype="<u4").tolist() == ids
