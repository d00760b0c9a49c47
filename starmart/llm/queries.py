"""One query for each operator, over its whole table, and SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starmart.llm import decontaminate, divergence, langid, lattice_lm, lengths, main_text, neardup, ngram_join, packing, prefix_trie, toxicity, url_filter, warc
from starmart.llm.common import table


def op1_toxicity(spark: SparkSession, d: str) -> DataFrame:
    return toxicity.report(spark, table(spark, d, "documents"), table(spark, d, "labels"))


def op2_url_filter(spark: SparkSession, d: str) -> DataFrame:
    return url_filter.report(spark, table(spark, d, "pages"))


def op3_lm_scoring(spark: SparkSession, d: str) -> DataFrame:
    return lattice_lm.score(spark, table(spark, d, "documents"))


def op4_token_counts(spark: SparkSession, d: str) -> DataFrame:
    return lengths.report(table(spark, d, "documents"))


def op5_language_id(spark: SparkSession, d: str) -> DataFrame:
    return langid.report(spark, table(spark, d, "documents"))


def op6_decontamination(spark: SparkSession, d: str) -> DataFrame:
    return decontaminate.report(spark, table(spark, d, "documents"), table(spark, d, "benchmark"))


def op7_packing(spark: SparkSession, d: str) -> DataFrame:
    return packing.report(table(spark, d, "documents"))


def op8_fingerprints(spark: SparkSession, d: str) -> DataFrame:
    return neardup.report(table(spark, d, "documents"))


def op9_ngram_join(spark: SparkSession, d: str) -> DataFrame:
    return ngram_join.ngram_join(spark, table(spark, d, "documents"))


def op10_warc(spark: SparkSession, d: str) -> DataFrame:
    return warc.report(spark, table(spark, d, "pages"))


def op11_prefix_trie(spark: SparkSession, d: str) -> DataFrame:
    return prefix_trie.report(spark, d)


def op12_source_divergence(spark: SparkSession, d: str) -> DataFrame:
    return divergence.report(spark, table(spark, d, "documents"))


def op13_main_text(spark: SparkSession, d: str) -> DataFrame:
    return main_text.report(table(spark, d, "pages"))


QUERIES = {f.__name__: f for f in (op1_toxicity, op2_url_filter, op3_lm_scoring, op4_token_counts, op5_language_id, op6_decontamination, op7_packing, op8_fingerprints, op9_ngram_join, op10_warc, op11_prefix_trie, op12_source_divergence, op13_main_text)}

ORACLES = {"op2_url_filter": url_filter.ORACLE, "op10_warc": warc.ORACLE, "op11_prefix_trie": prefix_trie.ORACLE, "op12_source_divergence": divergence.ORACLE}
