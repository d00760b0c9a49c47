"""Decontamination, fingerprints and the n-gram join against brute force."""

import hashlib
import re
from collections import Counter

import numpy as np
from conftest import SF_SMALL
from llm_data import awkward, prose
from test_text import WORD, lower

from starmart.llm import components, decontaminate, neardup, ngram_join


def words(t):
    return WORD.findall(lower(t))


def shingles(t, n=5):
    w = words(t)
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} or ({tuple(w)} if w else set())


def jac(x, y):
    return len(x & y) / len(x | y) if x and y else 0.0


def marked(docs, items, n=10):
    out = []
    for i, t in docs:
        w = words(t)
        hit, found = set(), set()
        for k, b in items:
            v = words(b)
            m = min(n, len(v))
            for s in range(len(v) - m + 1 if m else 0):
                for p in range(len(w) - m + 1):
                    if w[p : p + m] == v[s : s + m]:
                        hit.update(range(p, p + m))
                        found.add(k)
        sha = hashlib.sha256(",".join(sorted(str(k) for k in found)).encode()).hexdigest()
        out.append((str(i), len(w), len(hit), len(found), sha, bool(hit)))
    return sorted(out)


def test_decontamination(spark, monkeypatch):
    long = prose(3, 12000).split()
    items = [(1, prose(1, 60)), (2, "Two, WORDS"), (11, " ".join(long[500:530]) + " other end"), (11, " ".join(long[900:912])), (4, ""), (5, None), (6, "kappa1"), (7, " ".join(long[504:520]))]
    docs = awkward(spark)
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = marked([(r.doc_id, r.text) for r in docs.collect()], items)
    assert sum(x[2] for x in want) > 100
    for block in (1 << 20, 60):  # the second cuts the benchmark into many blocks
        monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)
        got = decontaminate.report(spark, docs, bench)
        assert sorted((str(r.doc_id), r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in got.collect()) == want
    kept = decontaminate.decontaminate(spark, docs, bench)
    assert kept.columns == docs.columns and kept.count() == sum(not x[5] for x in want)
    assert decontaminate.decontaminate(spark, docs, bench.limit(0)).count() == docs.count()
    assert decontaminate.report(spark, docs.limit(0), bench).count() == 0
    found = decontaminate.longest_matches(spark, docs, bench.where("item_id = 11")).collect()
    assert {(r.doc_id, r.doc_start, r.item_start, r.n_words) for r in found} == {(8, 500, 0, 30), (8, 900, 0, 12)}


def test_search_finds_ranges():
    rng = np.random.default_rng(2)
    rows = rng.integers(0, 3, (60, 4)).astype(np.uint64)
    cols = rows[np.lexsort(rows.T[::-1])].T
    q = rng.integers(0, 4, (50, 3)).astype(np.uint64)
    lo, hi = decontaminate.search(cols, q)
    for k in range(50):
        want = [i for i in range(60) if (cols[:3, i] == q[k]).all()]
        assert list(range(lo[k], hi[k])) == want


def test_fingerprints(spark):
    docs = awkward(spark).where("doc_id is not null").dropDuplicates(["doc_id"])
    spark.conf.set("spark.sql.shuffle.partitions", "5")
    got = {r.doc_id: r for r in neardup.report(docs).collect()}
    rows = sorted((r.doc_id, r.text or "") for r in docs.collect())
    assert sorted(got) == [i for i, _ in rows]
    prints = {i: neardup.sketch(__import__("pyarrow").array([t]))[0] for i, t in rows}
    for k, (i, t) in enumerate(rows):
        nxt_id, nxt = rows[(k + 1) % len(rows)]
        q = len(t) // 4
        e = t[: len(t) - q] + nxt[:q]
        r = got[i]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(e.encode()).hexdigest()
        assert r.fingerprint == neardup.as_text(prints[i][None])[0]
        assert r.near_next == (prints[i] == prints[nxt_id]).mean()
        if shingles(t):
            assert abs(r.near_edited - jac(shingles(t), shingles(e))) < 0.18
    every = neardup.report(awkward(spark)).collect()  # null and repeated ids
    assert len(every) == awkward(spark).count()
    assert neardup.report(docs.limit(0)).count() == 0 and neardup.report(docs.limit(1)).count() == 1


def test_near_pairs(spark):
    base = prose(5, 200)
    docs = spark.createDataFrame([(1, base), (2, base), (3, base + " more words"), (4, prose(6, 200)), (5, None)], "doc_id long, text string")
    pairs = neardup.near_pairs(spark, docs).collect()
    assert {(r.a, r.b) for r in pairs} == {(1, 3)}
    assert abs(pairs[0].jaccard - jac(shingles(base), shingles(base + " more words"))) < 1e-12


def test_near_pairs_of_a_dissimilar_bucket_head(spark):
    """2 and 3 are similar; 1 shares buckets with both but is similar to neither. 4 and 5 differ in one word only."""
    w = prose(7, 400).split()
    b = w[:]
    c = w[:-12] + prose(8, 12).split()
    head = w[:270] + prose(10, 130).split()
    long = prose(12, 4000)
    texts = {1: head, 2: b, 3: c, 4: long.split(), 5: [*long.split()[:-1], "other"]}
    docs = spark.createDataFrame([(k, " ".join(t)) for k, t in texts.items()] + [(6, " ".join(c))], "doc_id long, text string")
    sets = {k: shingles(" ".join(t)) for k, t in texts.items()}
    want = {(a, b): jac(sets[a], sets[b]) for a in sets for b in sets if a < b and jac(sets[a], sets[b]) >= 0.8}
    assert set(want) == {(2, 3), (4, 5)} and min(jac(sets[1], sets[2]), jac(sets[1], sets[3])) > 0.4
    got = {(r.a, r.b): r.jaccard for r in neardup.near_pairs(spark, docs).collect()}
    assert got == want
    rows = [(k, r.doc_id, r.text) for k, r in enumerate(docs.collect())]
    assert sorted((str(r.doc_id), str(r.class_id), r.n_links) for r in neardup.near_groups(spark, docs).collect()) == groups(rows)


def test_near_pairs_of_a_large_group(spark, monkeypatch):
    """Graded near copies over many chunks: every link, as by comparing all pairs."""
    monkeypatch.setattr(neardup, "CELL", 8)
    w, v = prose(14, 150).split(), prose(15, 150).split()
    texts = {k: " ".join(v[: 3 * k] + w[3 * k :]) for k in range(40)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    sets = {k: shingles(t) for k, t in texts.items()}
    want = {(a, b) for a in sets for b in sets if a < b and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])}
    got = [(r.a, r.b) for r in neardup.near_pairs(spark, docs).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    rows = [(k, i, t) for k, (i, t) in enumerate(texts.items())]
    assert sorted((str(r.doc_id), str(r.class_id), r.n_links) for r in neardup.near_groups(spark, docs).collect()) == groups(rows)


def test_near_groups_on_awkward_rows(spark):
    docs = awkward(spark)
    rows = [(k, r.doc_id, r.text) for k, r in enumerate(docs.collect())]
    assert sorted((str(r.doc_id), str(r.class_id), r.n_links) for r in neardup.near_groups(spark, docs).collect()) == groups(rows)
    assert neardup.near_pairs(spark, docs.limit(0)).count() == 0


def groups(rows, threshold=0.8):
    """id -> (class, links) by comparing all pairs; rows: (row number, id, text)."""
    sets = [shingles(t) for _, _, t in rows]
    links = [0] * len(rows)
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                links[a] += 1
                links[b] += 1
                root[find(a)] = find(b)
    best = {}
    for k, (_, i, _) in enumerate(rows):
        if i is not None:
            best[find(k)] = min(best.get(find(k), i), i)
    return sorted((str(i), str(best.get(find(k)) if sets[k] else i), links[k]) for k, (_, i, _) in enumerate(rows))


def test_join_on_awkward_rows(spark):
    docs = awkward(spark)
    rows = [(k, r.doc_id, r.text) for k, r in enumerate(docs.collect())]
    got = ngram_join.ngram_join(spark, docs)
    assert sorted((str(r.doc_id), str(r.class_id), r.n_links) for r in got.collect()) == groups(rows)
    kept = ngram_join.deduplicate(spark, docs)
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter([1, 4, 5, 5, 6, 7, None, None, 8, 9])
    assert ngram_join.ngram_join(spark, docs.limit(0)).count() == 0
    assert ngram_join.deduplicate(spark, docs.limit(0)).count() == 0


def test_join_on_documents(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = [(k, r.doc_id, r.text) for k, r in enumerate(docs.collect())]
    got = ngram_join.ngram_join(spark, docs)
    assert sorted((str(r.doc_id), str(r.class_id), r.n_links) for r in got.collect()) == groups(rows)


def test_join_of_a_large_group(spark, monkeypatch):
    """One group of near copies over many chunks: links and class whole, output linear."""
    monkeypatch.setattr(ngram_join, "CELL", 8)
    base = prose(9, 120)
    rows = [(k, k, base + f" extra{k % 37} end{k % 37}") for k in range(120)] + [(k, k, prose(100 + k, 60)) for k in range(120, 140)]
    docs = spark.createDataFrame([(i, t) for _, i, t in rows], "doc_id long, text string")
    got = ngram_join.ngram_join(spark, docs).collect()
    assert sorted((str(r.doc_id), str(r.class_id), r.n_links) for r in got) == groups(rows)


def test_join_of_a_chain(spark, monkeypatch):
    """Texts each like the next only: one connected part, but cells by bucket, so as many rows as texts and bands at most."""
    monkeypatch.setattr(ngram_join, "CELL", 4)
    monkeypatch.setattr(neardup, "CELL", 4)
    words = prose(21, 100 + 10 * 300).split()
    rows = [(k, k, " ".join(words[10 * k : 10 * k + 100])) for k in range(300)]
    docs = spark.createDataFrame([(i, t) for _, i, t in rows], "doc_id long, text string")
    dealt = []
    deal = ngram_join.deal
    monkeypatch.setattr(ngram_join, "deal", lambda *a: dealt.append(deal(*a)) or dealt[-1])
    got = ngram_join.ngram_join(spark, docs).collect()
    want = groups(rows)
    assert sorted((str(r.doc_id), str(r.class_id), r.n_links) for r in got) == want
    assert {c for _, c, _ in want} == {"0"} and max(n for _, _, n in want) == 2
    bands, _ = ngram_join.choose_bands()
    cells = dealt[0].groupBy("place", "band", "b", "i", "j").count().collect()
    assert sum(r["count"] for r in cells) <= 2 * bands * len(rows) and max(r["band"] for r in cells) > 0
    assert max(r["count"] for r in cells) < 40
    near = neardup.near_groups(spark, docs).collect()
    assert sorted((str(r.doc_id), str(r.class_id), r.n_links) for r in near) == want
    pairs = [(r.a, r.b) for r in neardup.near_pairs(spark, docs).collect()]
    assert sorted(pairs) == [(k, k + 1) for k in range(299)]


def test_a_pair_of_several_bands_counts_once():
    left = np.array([[1, 2], [3, 4]])
    assert ngram_join.unmet(left, np.array([[1, 9], [7, 8], [0, 4]])).tolist() == [[False, True, True], [True, True, False]]


def test_columns_of_marks_only(spark):
    """Columns named like the struct's own filler come back."""
    docs = spark.createDataFrame([(1, prose(30, 40), "x", 5), (2, prose(30, 40), "y", 6), (3, prose(31, 40), "z", 7)], "doc_id long, text string, `_` string, `___` int")
    kept = ngram_join.deduplicate(spark, docs)
    assert kept.columns == docs.columns and sorted((r.doc_id, r["_"], r["___"]) for r in kept.collect()) == [(1, "x", 5), (3, "z", 7)]


def test_components_of_a_hub(spark):
    """A hub with most of the edges, a chain and a second hub that is its leaf."""
    edges = [(5, k) for k in range(100, 2600)] + [(2599, k) for k in range(3000, 3400)] + [(k, k + 1) for k in range(4000, 4030)]
    got = {r.node: r.comp for r in components.components(spark, spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {5: 5, **{k: 5 for k in [*range(100, 2600), *range(3000, 3400)]}, **{k: 4000 for k in range(4000, 4031)}}
    facts = spark.createDataFrame([(1, 9000, "a"), (2, 2, "b"), (3, 1, "c")], "u long, n long, x string")
    rows = spark.createDataFrame([(1, 7), (1, 8), (2, 9), (4, 9)], "u long, v long")
    assert sorted(map(tuple, components.hub_join(rows, facts, "u", "n", 9003).select("u", "v", "x").collect())) == [(1, 7, "a"), (1, 8, "a"), (2, 9, "b")]


def test_components(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, 101), (102, 101), (7, 7), (None, 3)]
    got = {r.node: r.comp for r in components.components(spark, spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{k: 0 for k in range(41)}, 100: 100, 101: 100, 102: 100}
    assert components.components(spark, spark.createDataFrame([], "a long, b long")).count() == 0


def test_bands():
    bands, rows = ngram_join.choose_bands(0.8, 0.9999, 192)
    assert bands * rows <= 192 and 1 - (1 - 0.8**rows) ** bands >= 0.9999
    assert 1 - (1 - 0.8 ** (rows + 1)) ** (192 // (rows + 1)) < 0.9999
    assert re.match(r"\d+", str(bands))
