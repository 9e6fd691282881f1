"""Registered queries of the training-data operators (thin: tables in, contract columns out)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from seedrank.llm import (decontam, exact_stream, fim, langid, lm_score, oracle, packing, quality, ranked_search, simhash, substring,
                          suffix_dedup, toxicity, url_filter)
from seedrank.llm.tables import read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {
    "op3_suffix_dedup": oracle.SUFFIX_DEDUP,
    "op4_substring_dedup": oracle.SUBSTRING_DEDUP,
    "op7_url_filter": oracle.url_filter(url_filter.RULES, url_filter.DAMPING, url_filter.BLOCK_SHARE),
    "op9_exact_dedup": oracle.EXACT_DEDUP,
    "op10_decontamination": oracle.DECONTAMINATION,
    "op12_fill_in_middle": oracle.FILL_IN_MIDDLE,
    "op13_ranked_search": oracle.RANKED_SEARCH,
}


def register(fn):
    QUERIES[fn.__name__] = fn
    return fn


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@register
def op1_quality_classifier(spark: SparkSession, d: str) -> DataFrame:
    return quality.classify(read(spark, d, "documents"), read(spark, d, "labels"))


@register
def op2_language_id(spark: SparkSession, d: str) -> DataFrame:
    return langid.identify(read(spark, d, "documents"))


@register
def op3_suffix_dedup(spark: SparkSession, d: str) -> DataFrame:
    return suffix_dedup.digests(read(spark, d, "documents"))


@register
def op4_substring_dedup(spark: SparkSession, d: str) -> DataFrame:
    return substring.digests(read(spark, d, "documents"))


@register
def op5_lm_score(spark: SparkSession, d: str) -> DataFrame:
    return lm_score.score(read(spark, d, "documents"), read(spark, d, "labels"))


@register
def op6_packing(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack(read(spark, d, "documents"), tokenizer_path())


@register
def op7_url_filter(spark: SparkSession, d: str) -> DataFrame:
    return url_filter.judge(read(spark, d, "pages"))


@register
def op8_simhash(spark: SparkSession, d: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, d, "documents"))


@register
def op9_exact_dedup(spark: SparkSession, d: str) -> DataFrame:
    return exact_stream.decisions(read(spark, d, "documents"))


@register
def op10_decontamination(spark: SparkSession, d: str) -> DataFrame:
    return decontam.contamination(read(spark, d, "documents"), read(spark, d, "benchmark"))


@register
def op11_toxicity(spark: SparkSession, d: str) -> DataFrame:
    return toxicity.classify(read(spark, d, "documents"), read(spark, d, "labels"))


@register
def op12_fill_in_middle(spark: SparkSession, d: str) -> DataFrame:
    return fim.digests(read(spark, d, "documents"))


@register
def op13_ranked_search(spark: SparkSession, d: str) -> DataFrame:
    return ranked_search.search(read(spark, d, "documents"), read(spark, d, "benchmark"))
