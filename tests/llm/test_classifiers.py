"""Toxicity, language identification: held-out quality, awkward rows."""

import numpy as np
from conftest import SF_SMALL
from llm_data import awkward
from pyspark.sql import functions as F

from starmart.llm import langid, queries, toxicity

SF = SF_SMALL.replace("sf0.001", "sf0.01")


def test_machine_learns_a_pair():
    """Features 0 and 1 are harmless alone and toxic together, which additive weights can't express well."""
    rng = np.random.default_rng(1)
    rows, y = [], []
    for _ in range(1200):
        r = [k for k in range(2) if rng.random() < 0.5] + [2 + int(rng.integers(0, 5))]
        rows.append(np.array(r))
        y.append(float(0 in r and 1 in r))
    w0, w, v = toxicity.train(rows, np.array(y), 7)
    m = toxicity.Machine(np.arange(7), w0, w, v)
    assert m.raw(np.array([0, 1])) > 0 > max(m.raw(np.array([0])), m.raw(np.array([1])), m.raw(np.array([], dtype=np.int64)))


def test_fit_learns_a_pair_without_marginal_effect(spark):
    """Either word alone is toxic, both or none are not: neither tells the labels apart by itself."""
    rng = np.random.default_rng(3)
    rows = []
    for k in range(800):
        a, b = k % 2, k // 2 % 2
        rows.append((k, " ".join(["zorp"] * a + ["quix"] * b + [f"w{x}" for x in rng.integers(0, 40, 6)]), int(a != b)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    m = toxicity.fit(spark, docs.select("doc_id", "text"), docs.select("doc_id", "toxic"))
    tests = spark.createDataFrame([(t,) for t in ("zorp", "quix", "zorp quix", "none")], "text string")
    got = {r.text: r.score for r in toxicity.predict(spark, tests, m).collect()}
    assert min(got["zorp"], got["quix"]) > 0.8 and max(got["zorp quix"], got["none"]) < 0.2


def test_an_id_with_most_rows_is_thinned(spark, monkeypatch):
    """One id holds most rows, each text its own; the others are still learned from, and little reaches the driver."""
    rows = [(k, f"{'zorp' if k % 2 else 'calm'} w{k % 7}", k % 2) for k in range(100)] + [(1000, f"zorp w{k}", 1) for k in range(3000)] + [(1000, "zorp again", 1)] * 500
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    seen = []
    train = toxicity.train
    monkeypatch.setattr(toxicity, "train", lambda x, y, n: seen.append(len(x)) or train(x, y, n))
    m = toxicity.fit(spark, docs.select("doc_id", "text"), docs.select("doc_id", "toxic").distinct(), rows=120)
    assert 100 <= seen[0] <= 120
    got = {r.text: r.score for r in toxicity.predict(spark, spark.createDataFrame([("zorp",), ("calm",)], "text string"), m).collect()}
    assert got["zorp"] > 0.5 > got["calm"]


def test_sample_draws_copies_one_by_one(spark):
    """A third of the rows are copies of one text: their share of the sample is about a third."""
    docs = spark.range(6000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "copy").otherwise(F.concat(F.lit("t"), "id")).alias("text"), F.lit("en").alias("lang"))
    got = langid.sample(docs, 600)
    n, copies = got.count(), got.where("text = 'copy'").count()
    assert 450 < n < 750 and 0.25 < copies / n < 0.42
    assert langid.fit(spark, docs, 600).langs == langid.fit(spark, docs.drop("doc_id"), 600).langs == ["en"]


def test_filters_keep_columns_named_like_their_own(spark):
    """Columns named as the filters' own come back as they were."""
    rows = [(k, ("the green house of my friend" if k % 2 else "la casa verde de mi amigo") + f" {k}", "en" if k % 2 else "es", k) for k in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, __toxic int").withColumns({"__LANG": F.col("doc_id") + 1, "__score": F.lit("s")})
    got = langid.keep_identified(spark, docs)
    assert got.columns == docs.columns and sorted(map(tuple, got.collect())) == sorted(map(tuple, docs.collect()))
    clean = toxicity.keep_clean(spark, docs, spark.createDataFrame([(0, 0), (1, 0)], "doc_id long, toxic int"))
    assert clean.columns == docs.columns and sorted(map(tuple, clean.collect())) == sorted(map(tuple, docs.collect()))


def test_interactions():
    rng = np.random.default_rng(4)
    x = rng.random((3000, 12)) < 0.3
    y = ((x[:, 2] ^ x[:, 7]) | x[:, 0]).astype(float)
    z = toxicity.interactions([np.flatnonzero(r) for r in x], y, 12, strip=5)
    assert np.allclose(z, z.T) and z[2, 7] > toxicity.LEAST_PAIR
    others = [1, 3, 4, 5, 6, 8, 9, 10, 11]
    assert z[np.ix_(others, range(12))].max() < toxicity.LEAST_PAIR


def test_toxicity_held_out(spark):
    out = queries.op1_toxicity(spark, SF)
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "toxic")
    rows = out.join(labels, "doc_id").where("held_out").select("score", "toxic").collect()
    pos, neg = [r.score for r in rows if r.toxic], [r.score for r in rows if not r.toxic]
    assert out.count() == 1000
    assert np.mean([(p > q) + 0.5 * (p == q) for p in pos for q in neg]) > 0.8
    assert np.mean([q < 0.3 for q in neg]) > 0.95


def test_toxicity_awkward(spark):
    docs = awkward(spark)
    labels = spark.createDataFrame([(1, 0, 1), (1, 0, None), (3, 1, 0), (None, 1, 1), (8, 1, None), (99, 0, 1)], "doc_id long, quality int, toxic int")
    out = toxicity.report(spark, docs, labels).collect()
    assert len(out) == docs.count() and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in out)
    none = toxicity.report(spark, docs, labels.limit(0))
    assert {r.score < 0.01 for r in none.collect()} == {True}
    assert toxicity.report(spark, docs.limit(0), labels).count() == 0
    kept = toxicity.keep_clean(spark, docs, labels.limit(0))
    assert kept.columns == docs.columns and kept.count() == docs.count()


def test_language_held_out(spark):
    out = queries.op5_language_id(spark, SF)
    lang = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    held = out.where("held_out").join(lang, "doc_id")
    assert held.where("lang_pred = lang").count() >= 0.97 * held.count()


def test_language_counts_below_the_cut(spark, monkeypatch):
    """A word that one language keeps has its true count in the other, where it is beyond the cut; so has an n-gram."""
    monkeypatch.setattr(langid, "WORDS", 2)
    monkeypatch.setattr(langid, "GRAMS", 2)
    texts = {"a": "aa " * 9 + "bb " * 8 + "cc " * 7, "b": "cc dd dd"}
    docs = spark.createDataFrame([(t, x) for x, t in texts.items()], "text string, lang string")
    m = langid.fit(spark, docs)
    assert m.langs == ["a", "b"] and set(m.words.row) == {"aa", "bb", "cc", "dd"}
    v = langid.ALPHA * 5
    for w, (a, b) in {"aa": (9, 0), "bb": (8, 0), "cc": (7, 1), "dd": (0, 2)}.items():
        assert np.allclose(m.words.get(w), np.log([(a + 0.5) / (24 + v), (b + 0.5) / (3 + v)]))
    grams = {x: [g for w in t.split() for n in range(1, 5) for g in langid.grams_of(w, n)] for x, t in texts.items()}
    for g in m.grams.row:
        n = [sum(len(y) == len(g) for y in grams[x]) for x in m.langs]
        c = [grams[x].count(g) for x in m.langs]
        assert np.allclose(m.grams.get(g), [np.log((c[k] + 0.5) / (n[k] + 0.5 * (len(m.grams.row) + 1))) for k in range(2)])


def test_language_backs_off():
    docs = langid.Model(["a", "b"], {"known": np.log([0.9, 0.1])}, {"xy": np.log([0.1, 0.8]), "<qrs": np.log([0.7, 0.1])})
    assert docs.word("known")[0] > docs.word("known")[1]
    assert docs.word("qrstxy").tolist() == docs.grams.get("<qrs").tolist()  # the longest known n-grams decide
    assert docs.word("zxyz").tolist() == docs.grams.get("xy").tolist()
    assert docs.word("oo").tolist() == docs.floor.tolist()


def test_language_awkward(spark):
    docs = awkward(spark)
    out = langid.report(spark, docs).collect()
    assert len(out) == docs.count()
    by = {}
    for r in out:
        by.setdefault(r.doc_id, r)
        assert 0 <= r.score <= 1
    assert by[4].lang_pred == by[6].lang_pred == "und" and by[6].score == 0
    assert {r.lang_pred for r in langid.report(spark, docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    assert langid.report(spark, docs.limit(0)).count() == 0
    assert langid.keep_identified(spark, docs).columns == docs.columns
