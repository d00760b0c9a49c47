"""Cleaning pipeline over ``documents``: five operators of ``starmart.llm``, one stage each.

Every stage reads what the one before kept and returns the columns of documents; the last packs the
rest into sequences. ``run`` writes each stage's result to the shared folder and goes on from there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starmart.llm import decontaminate, langid, ngram_join, packing, toxicity
from starmart.llm.common import keep, table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents whose language is recognised."""
    return langid.keep_identified(spark, docs)


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that score as toxic, learned from the labelled ones among them."""
    return toxicity.keep_clean(spark, docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    return ngram_join.deduplicate(spark, docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents with a verbatim window of a benchmark item."""
    return decontaminate.decontaminate(spark, docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in training sequences."""
    return packing.report(docs)


STAGES = [
    ("language_id", language_id),
    ("toxicity", toxic),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("packing", pack),
]

ORACLE_SQL = None  # models, hashing and tokenisation have no SQL form; tests/llm holds the stages against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = keep(spark, stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
