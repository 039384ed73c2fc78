"""The registered queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from bookweave.llm import decontamination, fingerprints, jaccard, language, licenses, mixing, quality, sharding, surrogates, token_files
from bookweave.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return surrogates.op1_surrogates(table(spark, sf_dir, "documents"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.op2_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.op3_fingerprints(table(spark, sf_dir, "documents"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.op4_mixing(table(spark, sf_dir, "documents"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.op5_sharding(table(spark, sf_dir, "documents"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.op6_decontamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.op7_language(table(spark, sf_dir, "documents"))


def op8_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.op8_jaccard(table(spark, sf_dir, "documents"))


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.op9_licenses(table(spark, sf_dir, "documents"))


def op10_token_files(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    return token_files.op10_token_files(spark, table(spark, sf_dir, "documents"), tokenizer)


QUERIES: dict[str, Query] = {f.__name__: f for f in (op1_surrogates, op2_quality, op3_fingerprints, op4_mixing, op5_sharding, op6_decontamination, op7_language, op8_jaccard, op9_licenses, op10_token_files)}
ORACLES: dict[str, str] = {"op4_mixing": mixing.ORACLE, "op5_sharding": sharding.ORACLE, "op8_jaccard": jaccard.ORACLE}
