"""Lattice language model and length histogram against brute force."""

import time
from collections import Counter
from math import log10
from zlib import crc32

import numpy as np
import pytest
from llm_data import awkward

from starmart.llm import encode, lattice_lm, lengths


@pytest.fixture(scope="module")
def pieces():
    return lattice_lm.load_pieces()


def brute(pieces, word, logp):
    """Sum over all segmentations by plain recursion."""
    index = {p: i for i, p in enumerate(pieces.names) if pieces.open[i] and not p.startswith("<0x") and i != pieces.end}
    s = "\u2581" + word

    def total(at):
        if at == len(s):
            return 1.0
        out = 0.0
        for j in range(at + 1, min(len(s), at + pieces.longest) + 1):
            if s[at:j] in index:
                out += np.exp(logp[index[s[at:j]]]) * total(j)
        if s[at] not in index:
            out += np.exp(sum(logp[b] for b in pieces.bytes_of(ord(s[at])))) * total(at + 1)
        return out

    return total(0)


def test_marginal_is_the_sum_over_segmentations(pieces):
    words = ["the", "thanedble", "éveaux", "日本😀", "x", "$$a", "\x00z"]
    got = np.exp(lattice_lm.word_logs(pieces, [w.encode() for w in words], pieces.start))
    assert np.allclose(got, [brute(pieces, w, pieces.start) for w in words], rtol=1e-9)


def test_expected_counts_are_gradients(pieces):
    words = [b"thanedble", "naïve☃".encode()]
    e = lattice_lm.expected_counts(pieces, words, np.array([1.0, 3.0]), pieces.start)
    for i in np.flatnonzero(e > 0.1)[:6]:
        q = pieces.start.copy()
        q[i] += 1e-5
        d = (lattice_lm.word_logs(pieces, words, q) - lattice_lm.word_logs(pieces, words, pieces.start)) / 1e-5
        assert abs(d[0] + 3 * d[1] - e[i]) < 1e-3
    assert lattice_lm.word_logs(pieces, [b"z" * 5000], pieces.start)[0] < -1000


def test_long_words_like_short_ones(pieces, monkeypatch):
    words = ["thanedble日☃x" * 9, "z" * 90, "the", "\u2581a" * 40, "\U0001f600é" * 30]
    words = [w.encode() for w in words]
    counts = np.array([1.0, 2.0, 3.0, 1.0, 5.0])
    a, e = lattice_lm.word_logs(pieces, words, pieces.start), lattice_lm.expected_counts(pieces, words, counts, pieces.start)
    monkeypatch.setattr(lattice_lm, "LONG", 0)
    monkeypatch.setattr(lattice_lm, "REACH", 7)
    assert np.allclose(lattice_lm.word_logs(pieces, words, pieces.start), a, rtol=1e-9, atol=0)
    assert np.allclose(lattice_lm.expected_counts(pieces, words, counts, pieces.start), e, rtol=1e-9)


def test_a_run_of_200000_letters(pieces):
    word = ("qzjxkvbpthe日本" * 20_000)[:200_000].encode()
    began = time.monotonic()
    assert lattice_lm.word_logs(pieces, [word], pieces.start)[0] < -200_000
    assert lattice_lm.expected_counts(pieces, [word], np.ones(1), pieces.start).sum() > 20_000
    assert time.monotonic() - began < 30


def test_batch_size_changes_nothing(pieces):
    import pyarrow as pa

    words = [f"w{k * k}x{'ab' * (k % 9)}".encode() for k in range(3000)]
    table = pa.table({"word": pa.array(words, pa.binary())})
    logs = [np.concatenate([lattice_lm.word_logs(pieces, b["word"].to_pylist(), pieces.start) for b in lattice_lm.gathered(table.to_batches(max_chunksize=n))]) for n in (7, 2000, 5000)]
    assert all(np.allclose(x, logs[0], rtol=1e-9) for x in logs)
    assert sum(b.num_rows for b in lattice_lm.gathered(table.to_batches(max_chunksize=2000))) == 3000


def test_scores_against_brute_force(spark, pieces, monkeypatch):
    monkeypatch.setattr(lattice_lm, "HOT_WORDS", 30)
    docs = awkward(spark)
    out = lattice_lm.score(spark, docs, pieces).collect()
    texts = [(r.doc_id, lattice_lm.split(r.text)) for r in docs.collect()]
    held = lambda i: crc32(("" if i is None else str(i)).encode()) % 10 == 0
    c, n_docs = Counter(), 0
    for i, w in texts:
        if not held(i):
            c.update(w)
            n_docs += 1
    n, v = sum(c.values()) + n_docs, len(c) + 1
    want = []
    for i, w in texts:
        counts = [c[x] for x in w] + [n_docs]
        want.append((i is None, i or 0, len(w) + 1, sum(x > 0 for x in counts), round(sum(log10((x + 0.1) / (n + 0.1 * (v + 1))) for x in counts), 6), held(i)))
    got = [(r.doc_id is None, r.doc_id or 0, r.n_tokens, r.n_known, round(r.base_score, 6), r.held_out) for r in out]
    assert sorted(got) == sorted(want) and {r.train_tokens for r in out} == {n}
    assert all(r.score < 0 and r.lattice_score < 0 for r in out)


def test_probabilities_add_up(spark, pieces):
    """Over all words the arcs of known words and the pieces' share make one distribution with the end."""
    docs = spark.createDataFrame([(i, "aa ab ab b") for i in range(40)], "doc_id long, text string")
    out = lattice_lm.score(spark, docs, pieces).collect()
    one = [r for r in out if not r.held_out][0]
    n = one.train_tokens
    p = 10 ** one.score
    assert 0 < p <= (n / 5 / n) ** 2 * (2 * n / 5 / n) ** 2 * (n / 5 / n) * 1.5


def test_empty_tables(spark, pieces):
    docs = awkward(spark).limit(0)
    assert lattice_lm.score(spark, docs, pieces).count() == 0
    assert lengths.report(docs).count() == 0


def test_histogram(spark):
    docs = awkward(spark)
    tok = encode.encoder(encode.vocabulary()).tok
    sizes = [len(tok.encode(r.text or "", add_special_tokens=False).ids) for r in docs.select("text").collect()]
    hist = lengths.report(docs)
    rows = {r.length: r for r in hist.collect()}
    assert sorted(rows) == sorted(set(sizes))
    for n, r in rows.items():
        assert r.docs == sizes.count(n) and r.tokens == n * r.docs
        assert r.docs_ge == sum(x >= n for x in sizes) and r.tokens_ge == sum(x for x in sizes if x >= n)
        assert r.docs_le == sum(x <= n for x in sizes) and r.truncated_tokens == sum(min(x, n) for x in sizes)
    limits = [0, 1, 7, 100, 5000, 10**6]
    for r in lengths.at_limits(hist, limits).collect():
        assert (r.total_tokens, r.docs_ge, r.truncated_tokens) == (sum(sizes), sum(x >= r.limit for x in sizes), sum(min(x, r.limit) for x in sizes))
    for r in lengths.quantiles(hist, [0.1, 0.5, 1.0]).collect():
        assert r.length == min(x for x in sizes if sum(y <= x for y in sizes) >= r.q * len(sizes))
