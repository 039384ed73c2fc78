"""The corpus pipeline: quality, near-duplicates, decontamination, mixing, shards.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet
and read again as the next stage's docs. All but the last return the columns of documents:

1. ``quality`` drops what the classifier, fitted on the labels that are not held out, rejects.
2. ``near_duplicates`` keeps the document of least doc_id of each group that links (five-word shingles,
   Jaccard 0.8) connect.
3. ``decontamination`` drops documents that hold half of a benchmark item or more.
4. ``mixing`` repeats or leaves out documents so that sources meet their target shares.
5. ``sharding`` adds ``shard``, from 0 to 7, of near equal bytes; equal texts share one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from bookweave.llm import decontamination, jaccard, mixing, quality, sharding
from bookweave.llm.common import settle, table
from bookweave.session import clean, parts

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.drop_near_duplicates(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality", keep_good),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("sharding", shard),
]

ORACLE_SQL: str | None = None  # the classifier has no SQL form; tests/llm hold the rows against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), parts(spark)
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = settle(docs)
            clean(spark, before, keep=docs)  # what the stage and those before it left
    return docs
