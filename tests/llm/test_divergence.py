"""Source divergence against plain counting; joint tables against counts of pairs."""

import random
import re
from collections import Counter

import pytest
from llm_data import awkward, rows_of

from starmart.llm import divergence as D

LOWER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def plain(docs, min_docs, top=D.TOP):
    counts, df, langs = {}, {}, {}
    for text, lang, source in docs:
        lang, source = lang or "", source or ""
        own = Counter(t.translate(LOWER) for t in TERM.findall(text or ""))
        counts.setdefault((lang, source), Counter()).update(own)
        df.setdefault(lang, Counter()).update(own.keys())
        langs.setdefault(lang, Counter()).update(own)
    out, tables = [], {}
    for lang in langs:
        kept = sorted(t for t, n in df[lang].items() if n >= min_docs)
        v = len(kept)
        total = sum(langs[lang][t] for t in kept)
        p = {}
        groups = sorted((s for g, s in counts if g == lang), key=str.encode)
        for s in groups:
            n = sum(counts[lang, s][t] for t in kept)
            p[s] = {t: 1 + 10**9 * (counts[lang, s][t] + 5) // (n + 5 * v) for t in kept}
        q = {t: 1 + 10**9 * (langs[lang][t] + 5) // (total + 5 * v) for t in kept}
        for i, s in enumerate(groups):
            far = sorted(((-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode(), o) for o in groups if o != s))
            out += [(lang, s, "pair", o, -f, k) for k, (f, _, o) in enumerate(far, 1)]
            own = sorted((q[t] - p[s][t], t.encode(), t) for t in kept if counts[lang, s][t] and p[s][t] > q[t])
            out += [(lang, s, "term", t, -f, k) for k, (f, _, t) in enumerate(own[:top], 1)]
            for j in range(i + 1, len(groups)):
                for t in kept:
                    key = (lang, i, counts[lang, s][t], j, counts[lang, groups[j]][t])
                    tables[key] = tables.get(key, 0) + 1
    return sorted(out, key=str), tables


def docs():
    rng = random.Random(7)
    words = ["Wort", "été", "ÉTÉ", "naïve", "a", "B", "日本", "x" * 3000] + [f"w{chr(97 + k)}" for k in range(26)]
    out = []
    for _ in range(260):
        lang, source = rng.choice(["en", "de", None, ""]), rng.choice(["s0"] * 6 + [None, "", "é", "z9", "Z", "😀"])
        out.append((" ".join(rng.choice(words) for _ in range(rng.randint(0, 30))) + rng.choice([".", "1a2", "", " ", "_"]), lang, source))
    out += [(None, "en", "s0"), ("", "fr", "a"), ("...", "fr", "b"), ("wort " * 50_000, "en", "s0")] + [("same text here", "en", "hot")] * 120
    return out


@pytest.mark.parametrize("sizes", [{}, {"block": 5, "panel": 2, "tile": 3}])
def test_against_brute_force(spark, sizes):
    rows = docs()
    df = spark.createDataFrame([(t, la, s, 1, "own") for t, la, s in rows], "text string, lang string, source string, n int, value string").repartition(6)
    want, tables = plain(rows, 30)
    assert sorted(rows_of(D.report(spark, df, **sizes)), key=str) == want
    assert {r[:5]: r[5] for r in rows_of(D.Audit(spark, df, **sizes).joint_tables())} == tables


def test_awkward_and_empty(spark):
    df = awkward(spark)
    rows = [(r.text, r.lang, r.source) for r in df.collect()]
    for least in (1, 2, 30):
        audit = D.Audit(spark, df, min_docs=least)
        want = [(a, b, c, v) for a, b, k, c, v, _ in plain(rows, least)[0] if k == "pair"]
        assert sorted(rows_of(audit.pairs()), key=str) == sorted(want, key=str)
    assert D.report(spark, df.limit(0)).collect() == []


def test_shares_stay_exact_for_huge_counts(spark):
    from pyspark.sql import functions as F

    got = spark.range(1).select(D.share(F.lit(4 * 10**17), F.lit(9 * 10**17), F.lit(3))).head()[0]
    assert got == 1 + 10**9 * (4 * 10**17 + 5) // (9 * 10**17 + 15)
