"""Language identification: words first, then shorter and shorter character n-grams.

Known words are scored by their log frequency in each language. A word that the
model has not seen backs off to its longest known character n-grams (with a
mark at both ends): if none of ``LONGEST`` characters is known, to those one shorter, and so on.
A text's score for a language is the mean over its words, sharpened with the root of their number;
the prediction is the best language, its score the share of the best in the softmax.

Fitting: a bounded sample of labelled rows (about ``SAMPLE_ROWS`` by a hash of doc_id, where there is one, text and lang, so that copies of a
text are drawn one by one; all rows where there are fewer), counted in Spark; for each language the ``WORDS`` most frequent words and
``GRAMS`` most frequent n-grams make the model, each with its true count in every language; it goes to the
tasks as a broadcast.
Prediction: whole texts, where they are read, without a shuffle.

Defined results: a null text, or one without a letter, is ``und`` with score 0. Where no language
was learned, everything is ``und``. Rows without lang are not learned from. Ties go to the language
that sorts first. Repeated rows get the same result each. Further columns pass through.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.llm.common import fold, fresh, keep, mapped

SAMPLE_ROWS = 12_000
WORDS, GRAMS = 20_000, 12_000  # for each language
LONGEST = 4
ALPHA = 0.5
CACHE = 100_000  # words whose scores a task keeps
UNKNOWN = "und"
LETTERS = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    """Maximal runs of letters, lower-cased."""
    return LETTERS.findall((text or "").lower())


def grams_of(word: str, n: int) -> list[str]:
    w = f"<{word}>"
    return [w[i : i + n] for i in range(len(w) - n + 1)]


class Table:
    """Log scores of terms by language, in one matrix."""

    def __init__(self, scores: dict[str, np.ndarray], width: int):
        self.row = {t: k for k, t in enumerate(scores)}
        self.matrix = np.array(list(scores.values()), dtype=np.float64).reshape(len(scores), width)

    def get(self, term: str) -> np.ndarray | None:
        k = self.row.get(term)
        return None if k is None else self.matrix[k]


class Model:
    def __init__(self, langs: list[str], words: dict[str, np.ndarray], grams: dict[str, np.ndarray]):
        self.langs = langs
        self.words, self.grams = Table(words, len(langs)), Table(grams, len(langs))
        self.floor = np.full(len(langs), math.log(1e-6))

    def word(self, w: str) -> np.ndarray:
        """Log score of a word for each language."""
        known = self.words.get(w)
        if known is not None:
            return known
        for n in range(LONGEST, 0, -1):
            found = [g for x in grams_of(w, n) if (g := self.grams.get(x)) is not None]
            if found:
                return np.mean(found, axis=0)
        return self.floor


def sample(labelled: DataFrame, rows: int) -> DataFrame:
    """About ``rows`` rows by a hash of all columns; all of them where there are no more."""
    n = labelled.count()
    if n <= rows:
        return labelled
    return labelled.where(F.pmod(F.xxhash64(*labelled.columns), F.lit(1_000_000)) < int(1e6 * rows / n))


def fit(spark: SparkSession, documents: DataFrame, rows: int = SAMPLE_ROWS) -> Model:
    """Model from the rows' ``text`` and ``lang``; ``doc_id``, if it is there, only draws the sample."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: dict[str, Counter] = defaultdict(Counter)
            for text, lang in zip(batch["text"].to_pylist(), batch["lang"].to_pylist()):
                counts[lang].update(words_of(text))
            out: list[tuple] = []
            for lang, words in counts.items():
                out += [(lang, 0, w, c) for w, c in words.items()]
                grams: Counter = Counter()
                for w, c in words.items():
                    for n in range(1, LONGEST + 1):
                        for g in grams_of(w, n):
                            grams[g] += c
                out += [(lang, len(g), g, c) for g, c in grams.items()]
            if out:
                lang, kind, term, c = zip(*out)
                yield pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(kind, pa.int32()), pa.array(term, pa.string()), pa.array(c, pa.int64())], names=["lang", "kind", "term", "c"])

    drawn = [c for c in ("doc_id", "text", "lang") if c in documents.columns]
    rows_ = sample(documents.select(*drawn).where("lang is not null and text is not null"), rows).select("text", "lang")
    counts = keep(spark, mapped(rows_, count, "lang string, kind int, term string, c long").groupBy("lang", "kind", "term").agg(F.sum("c").alias("c")), "counts")
    word = F.col("kind") == 0
    best = W.partitionBy("lang", word).orderBy(F.desc("c"), "kind", "term")
    chosen = counts.withColumn("n", F.row_number().over(best)).where(F.col("n") <= F.when(word, WORDS).otherwise(GRAMS)).select("kind", "term").distinct()
    # a term that one language keeps has its true count in each
    top = counts.join(chosen, ["kind", "term"], "left_semi").groupBy("kind", "term").agg(F.map_from_arrays(F.collect_list("lang"), F.collect_list("c")).alias("c")).collect()
    totals = counts.groupBy("lang", "kind").agg(F.sum("c").alias("c")).collect()
    langs = sorted({r["lang"] for r in totals})
    at = {x: k for k, x in enumerate(langs)}
    total = defaultdict(lambda: np.zeros(len(langs)))
    for r in totals:
        total[r["kind"]][at[r["lang"]]] = r["c"]
    number: dict[str, dict[str, np.ndarray]] = {"w": {}, "g": {}}
    kind_of: dict[str, int] = {}
    for r in top:
        number["g" if r["kind"] else "w"][r["term"]] = row = np.zeros(len(langs))
        for lang, c in r["c"].items():
            row[at[lang]] = c
        if r["kind"]:
            kind_of[r["term"]] = r["kind"]
    logs = lambda c, t, v: np.log((c + ALPHA) / (t + ALPHA * (v + 1)))
    words = {w: logs(c, total[0], len(number["w"])) for w, c in number["w"].items()}
    grams = {g: logs(c, total[kind_of[g]], len(number["g"])) for g, c in number["g"].items()}
    return Model(langs, words, grams)


def predict(spark: SparkSession, documents: DataFrame, model: Model, text_col: str = "text", lang_out: str = "lang_pred", score_out: str = "score") -> DataFrame:
    """``documents`` with the predicted language and its score; columns of these names are replaced."""
    sent = spark.sparkContext.broadcast(model)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        cache: dict[str, int] = {}
        table = np.zeros((1024, len(model.langs)))
        for batch in batches:
            pred, scores = [], []
            for text in batch[text_col].to_pylist():
                counts = Counter(words_of(text))
                if not counts or not model.langs:
                    pred.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                if len(cache) + len(counts) > CACHE and len(cache):
                    cache = {}
                at = []
                for w in counts:
                    k = cache.get(w)
                    if k is None:
                        k = cache[w] = len(cache)
                        if k >= len(table):
                            table = np.concatenate([table, np.zeros_like(table)])
                        table[k] = model.word(w)
                    at.append(k)
                tf = np.fromiter(counts.values(), float, len(counts))
                s = tf @ table[at] / math.sqrt(tf.sum())
                e = np.exp(s - s.max())
                best = int(e.argmax())
                pred.append(model.langs[best])
                scores.append(float(e[best] / e.sum()))
            own = [(n, batch[n]) for n in batch.schema.names]
            yield pa.RecordBatch.from_arrays([c for _, c in own] + [pa.array(pred, pa.string()), pa.array(scores, pa.float64())], names=[n for n, _ in own] + [lang_out, score_out])

    src = documents.drop(lang_out, score_out)
    return mapped(src, task, T.StructType([*src.schema.fields, T.StructField(lang_out, T.StringType()), T.StructField(score_out, T.DoubleType())]))


def report(spark: SparkSession, documents: DataFrame, folds: int = 5) -> DataFrame:
    """doc_id, held_out, lang_pred, score; learned from the documents outside fold 0."""
    docs = documents.select("doc_id", "text", "lang", (fold("doc_id", folds) == 0).alias("held_out"))
    model = fit(spark, docs.where(~F.col("held_out")))
    return predict(spark, docs.select("doc_id", "held_out", "text"), model).drop("text")


def keep_identified(spark: SparkSession, documents: DataFrame, least: float = 0.5) -> DataFrame:
    """Documents whose language is recognised with a score of at least ``least``; columns unchanged."""
    model = fit(spark, documents)
    lang, score = fresh(documents, "__lang"), fresh(documents, "__score")
    out = predict(spark, documents, model, lang_out=lang, score_out=score)
    return out.where((F.col(lang) != UNKNOWN) & (F.col(score) >= least)).drop(lang, score)
