"""Toxicity: a factorization machine over hashed terms.

Terms of a text are its distinct words and their first 4 and 5 bytes (inflected forms
share these), hashed into ``BUCKETS``. The machine's score adds a weight for each term and, for each
pair of terms, the product of their factor vectors, so that pairs count that are harmless alone:
w0 + sum w_i + 1/2 sum_f ((sum v_if)^2 - sum v_if^2).

Fitting: a bounded sample of labelled rows (about ``SAMPLE_ROWS`` by a hash of the id; all where there are
fewer; where they stand for more than twice as many rows, equal rows count once and
an id's rows are thinned to about two by a hash of their texts) is joined with its texts and hashed in Spark, which also counts in how many documents of either
label a bucket occurs; the ``FEATURES`` buckets that tell the labels apart best (chi-square of at least
``LEAST_CHI2``) enter the machine. Beside them enter the terms of pairs whose effect is not that of its terms
alone (the ``PAIRED`` strongest at most): of the ``ORDINARY`` most frequent other buckets, with each other and with the ``TELLING`` best ones, those
whose share of toxic documents changes with the one differently where the other is
(``interactions`` of at least ``LEAST_PAIR``). Pairs with a rarer term aren't looked for. The machine is
trained with AdaGrad on sparse rows of its buckets only.
Scoring: whole texts, where they are read, without a shuffle; long texts aren't diluted, for
a bucket that isn't a feature counts nothing.

Defined results: a null or empty text, or one without features, scores as the bias alone. Without labels
of both kinds the score is the share of label 1 (0 without labels). A document with several
labels is toxic if one says so; labels without toxic or doc_id aren't used. Repeated rows get the same result
each. Further columns pass through.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.llm import textvec as V
from starmart.llm.common import fold, fresh, keep, mapped

BUCKETS = 1 << 22
PREFIXES = (4, 5)
SAMPLE_ROWS = 20_000
FEATURES = 4096
LEAST_CHI2, LEAST_DOCS = 12.0, 3
ORDINARY, TELLING = 2048, 512
LEAST_PAIR, LEAST_TOGETHER = 36.0, 5  # some million pairs are looked at
PAIRED = 256
FACTORS, EPOCHS, RATE, PENALTY = 8, 30, 0.1, 1e-4
CACHE = 150_000  # words whose features a task keeps
THRESHOLD = 0.3

_WORD = bytes(int(V.LOWER[b]) if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def words_of(text: str | None) -> set[bytes]:
    return set((text or "").lower().encode().translate(_WORD).split())


def buckets_of(word: bytes) -> list[int]:
    """Hashed terms of a word: itself and its prefixes."""
    return [crc32(word) % BUCKETS] + [crc32(word[:n], n) % BUCKETS for n in PREFIXES if len(word) >= n]


class Machine:
    def __init__(self, buckets: np.ndarray, w0: float, w: np.ndarray, v: np.ndarray):
        self.index = {int(b): k for k, b in enumerate(buckets)}
        self.w0, self.w, self.v = w0, w, v

    def raw(self, at: np.ndarray) -> float:
        if not len(at):
            return self.w0
        v = self.v[at]
        s = v.sum(axis=0)
        return float(self.w0 + self.w[at].sum() + 0.5 * (s @ s - (v * v).sum()))


def train(rows: list[np.ndarray], y: np.ndarray, n: int, seed: int = 0) -> tuple[float, np.ndarray, np.ndarray]:
    """AdaGrad on the logistic loss over sparse 0/1 rows of feature numbers below ``n``."""
    rng = np.random.default_rng(seed)
    w0, w, v = float(np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3))), np.zeros(n), rng.normal(0, 0.02, (n, FACTORS))
    g0, gw, gv = 1e-8, np.full(n, 1e-8), np.full((n, FACTORS), 1e-8)
    size = np.array([len(r) for r in rows])
    begin = np.append(0, np.cumsum(size))
    flat = np.concatenate(rows) if rows else np.zeros(0, np.int64)
    for _ in range(EPOCHS):
        order = rng.permutation(len(rows))
        for k in range(0, len(order), 64):
            pick = order[k : k + 64]
            m = size[pick]
            owner = np.repeat(np.arange(len(pick)), m)
            at = flat[np.repeat(begin[pick], m) + np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m)]
            vv = v[at]
            s = np.zeros((len(pick), FACTORS))
            np.add.at(s, owner, vv)
            pairs = 0.5 * ((s * s).sum(axis=1) - np.bincount(owner, weights=(vv * vv).sum(axis=1), minlength=len(pick)))
            z = w0 + np.bincount(owner, weights=w[at], minlength=len(pick)) + pairs
            d = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[pick]) / len(pick)
            seen, inv = np.unique(at, return_inverse=True)
            dw = np.bincount(inv, weights=d[owner], minlength=len(seen)) + PENALTY * w[seen]
            dv = np.zeros((len(seen), FACTORS))
            np.add.at(dv, inv, d[owner][:, None] * (s[owner] - vv))
            dv += PENALTY * v[seen]
            d0 = d.sum()
            g0 += d0 * d0
            w0 -= RATE * d0 / np.sqrt(g0)
            gw[seen] += dw * dw
            w[seen] -= RATE * dw / np.sqrt(gw[seen])
            gv[seen] += dv * dv
            v[seen] -= RATE * dv / np.sqrt(gv[seen])
    return w0, w, v


def interactions(rows: list[np.ndarray], y: np.ndarray, n: int, strip: int = 256) -> np.ndarray:
    """For each feature below ``n`` and each other: the squared difference, in standard errors, between what the one
    adds to the share of label 1 where the other is and where it isn't (n x n, float32; 0 where one of the four
    groups of rows has fewer than ``LEAST_TOGETHER``)."""
    both = np.zeros((2, n, n), dtype=np.float32)
    for label in (0, 1):
        of = np.flatnonzero(y == label)
        for k in range(0, len(of), 1024):
            part = [rows[i] for i in of[k : k + 1024]]
            block = np.zeros((len(part), n), dtype=np.float32)
            block[np.repeat(np.arange(len(part)), [len(r) for r in part]), np.concatenate(part)] = 1
            both[label] += block.T @ block
    all_ = np.array([(y == 0).sum(), (y == 1).sum()], dtype=np.float64)
    single = np.stack([np.diagonal(m).astype(np.float64) for m in both])
    out = np.zeros((n, n), dtype=np.float32)
    for k in range(0, n, strip):
        with_both = both[:, k : k + strip].astype(np.float64)
        one = single[:, k : k + strip, None] - with_both
        other = single[:, None, :] - with_both
        neither = all_[:, None, None] - with_both - one - other
        diff, var, least = 0.0, 0.0, np.inf
        for sign, (clean, toxic) in ((1, with_both), (-1, one), (-1, other), (1, neither)):
            size = clean + toxic
            share = (toxic + 0.5) / (size + 1)
            diff = diff + sign * share
            var = var + share * (1 - share) / (size + 1)
            least = np.minimum(least, size)
        out[k : k + strip] = np.where(least >= LEAST_TOGETHER, diff * diff / var, 0)
    return out


def fit(spark: SparkSession, documents: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Machine:
    """A machine from ``documents`` (doc_id, text) and ``labels`` (doc_id, toxic)."""
    known = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    n = known.count()
    if n > rows:
        known = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(1e6 * rows / n))
    # the sample is bounded, so it may go to every task
    docs = documents.select("doc_id", "text").join(F.broadcast(known), "doc_id")

    def terms(batch: pa.RecordBatch) -> Iterator[tuple[int, set[int]]]:
        for y, t in zip(batch["toxic"].to_pylist(), batch["text"].to_pylist()):
            yield y, {b for w in words_of(t) for b in buckets_of(w)}

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: list[Counter] = [Counter(), Counter()]
            for y, found in terms(batch):
                counts[int(y > 0)].update(found)
            keys = sorted(counts[0].keys() | counts[1].keys())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int32()), pa.array([counts[1][k] for k in keys], pa.int64()), pa.array([counts[0][k] for k in keys], pa.int64())], names=["bucket", "a", "b"])

    def sizes(df: DataFrame) -> tuple[int, int]:
        total = df.agg(F.count(F.when(F.col("toxic") > 0, 1)).alias("p"), F.count(F.when(F.col("toxic") <= 0, 1)).alias("q")).head()
        return int(total["p"]), int(total["q"])

    p, q = sizes(docs)
    if p + q > 2 * rows:  # few ids, many rows
        docs = keep(spark, docs.distinct(), "labelled")
        # about two rows of an id; the ids are a bounded sample, so their counts may go to every task
        of_id = F.broadcast(docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")))
        docs = docs.join(of_id, "doc_id").where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1_000_000)) * F.col("n") < 2_000_000)
        p, q = sizes(docs)
    docs = docs.select("text", "toxic")
    if not p or not q:
        share = 1.0 if p else 0.0
        return Machine(np.zeros(0, np.int64), 30.0 if share else -30.0, np.zeros(0), np.zeros((0, FACTORS)))
    a, b = F.col("a").cast("double"), F.col("b").cast("double")
    c, d = F.lit(float(p)) - a, F.lit(float(q)) - b
    chi2 = F.lit(float(p + q)) * (a * d - b * c) ** 2 / ((a + b) * (c + d) * p * q)
    best = mapped(docs, counted, "bucket int, a long, b long").groupBy("bucket").agg(F.sum("a").alias("a"), F.sum("b").alias("b")).where((F.col("a") + F.col("b") >= LEAST_DOCS) & (F.col("a") + F.col("b") < p + q))
    best = keep(spark, best.withColumn("x", chi2), "buckets")
    told = [r["bucket"] for r in best.where(F.col("x") >= LEAST_CHI2).orderBy(F.desc("x"), "bucket").limit(FEATURES).collect()]
    known_ = set(told)
    split = F.least(F.col("a") + F.col("b"), F.lit(p + q) - F.col("a") - F.col("b"))
    often = [r["bucket"] for r in best.orderBy(F.desc(split), "bucket").limit(ORDINARY + len(told)).collect() if r["bucket"] not in known_][:ORDINARY]
    # the best of the telling buckets first, then the ordinary ones, then the other telling ones
    some = told[:TELLING] + often
    order = some + told[TELLING:]
    index = {int(x): k for k, x in enumerate(order)}

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [sorted(index[x] for x in t if x in index) for _, t in terms(batch)]
            yield pa.RecordBatch.from_arrays([batch["toxic"], pa.array(out, pa.list_(pa.int32()))], names=["toxic", "at"])

    got = mapped(docs, features, "toxic int, at array<int>").toArrow()
    y = (got["toxic"].to_numpy() > 0).astype(np.float64)
    sets = [x for c in got["at"].chunks if len(c) for x in np.split(c.flatten().to_numpy(), np.cumsum(pc.list_value_length(c).to_numpy())[:-1])]
    # both terms of each pair that tells more than its terms, where one isn't telling alone
    n_told = len(told[:TELLING])
    z = interactions([x[: np.searchsorted(x, len(some))] for x in sets], y, len(some))[:, n_told:].max(axis=0, initial=0)
    best_z = np.argsort(-z, kind="stable")[:PAIRED]
    paired = n_told + best_z[z[best_z] >= LEAST_PAIR]
    take = np.sort(np.concatenate([np.arange(n_told), paired, np.arange(len(some), len(order))])).astype(np.int64)
    buckets = np.array(order, dtype=np.int64)[take]
    to = np.full(len(order), -1)
    to[take] = np.arange(len(take))
    kept = [(t, (r := to[x])[r >= 0].tolist()) for t, x in zip(y.tolist(), sets)]
    kept.sort(key=lambda r: (r[0], len(r[1]), r[1]))  # the rows' order must not change the machine
    w0, w, v = train([np.array(r, dtype=np.int64) for _, r in kept], np.array([t for t, _ in kept]), len(buckets))
    return Machine(buckets, w0, w, v)


def predict(spark: SparkSession, documents: DataFrame, machine: Machine, text_col: str = "text", out: str = "score") -> DataFrame:
    """``documents`` with a score from 0 to 1; a column of that name is replaced."""
    sent = spark.sparkContext.broadcast(machine)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = sent.value
        cache: dict[bytes, tuple] = {}
        for batch in batches:
            z = np.zeros(batch.num_rows)
            for k, text in enumerate(batch[text_col].to_pylist()):
                found: set[int] = set()
                for w in words_of(text):
                    f = cache.get(w)
                    if f is None:
                        if len(cache) >= CACHE:
                            cache.clear()
                        f = cache[w] = tuple(machine.index[b] for b in buckets_of(w) if b in machine.index)
                    if f:
                        found.update(f)
                z[k] = machine.raw(np.array(sorted(found), dtype=np.int64))
            own = [(n, batch[n]) for n in batch.schema.names]
            yield pa.RecordBatch.from_arrays([c for _, c in own] + [pa.array(1 / (1 + np.exp(-np.clip(z, -30, 30))))], names=[n for n, _ in own] + [out])

    src = documents.drop(out)
    return mapped(src, task, T.StructType([*src.schema.fields, T.StructField(out, T.DoubleType())]))


def report(spark: SparkSession, documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted; learned from rows outside fold 2 of 4."""
    held = fold("doc_id", 4) == 2
    machine = fit(spark, documents, labels.where(~held))
    out = predict(spark, documents.select("doc_id", "text", held.alias("held_out")), machine)
    return out.select("doc_id", "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_clean(spark: SparkSession, documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Documents that score below ``threshold``; columns unchanged."""
    machine = fit(spark, documents, labels)
    out = fresh(documents, "__toxic")
    return predict(spark, documents, machine, out=out).where(F.col(out) < threshold).drop(out)
