"""The corpus pipeline: quality rules, near duplicates, decontamination, mixing, sharding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet
and read again as the next stage's ``docs``.  Stages are exactly the library's operators;
a stage judges all rows its predecessor kept.

1. quality          documents that the quality rules reject go; frequent lines go from the others
2. near_duplicates  one document of each class of near copies stays (the least doc_id)
3. decontaminate    documents that the benchmark contaminates go
4. mix              documents pass as often as the mixture asks: every one at least once, none more than twice
5. shard            24 shards of near equal bytes; adds size, text_crc32, law, shard, slot
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontam, jaccard_join, kd_sharding, line_quality, mixing
from tidemark.llm.common import STAGED, release, stage, table
from tidemark.llm.queries import REPETITION, SHARDS


_SCRATCH: list[str] = []


def _stage(apply: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """A stage's input is its predecessor's written result, so the predecessor's scratch tables can go when it begins.

    The last stage's tables stay: ``run`` returns its rows unwritten, and a later run mustn't take them away."""
    @functools.wraps(apply)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        release(spark, _SCRATCH)
        before = len(STAGED)
        out = apply(spark, docs, sf_dir)
        if run_stage is not STAGES[-1][1]:
            _SCRATCH.extend(STAGED[before:])
        return out

    return run_stage


@_stage
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_quality.clean(docs)


@_stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.one_of_each(docs)


@_stage
def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


@_stage
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs, repetition=REPETITION)


@_stage
def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return kd_sharding.sharded_documents(docs, n_shards=SHARDS)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality), ("near_duplicates", near_duplicates), ("decontaminate", decontaminate), ("mix", mix), ("shard", shard)]

#: SQL can't express the bisected exponent, the keyed permutations and the K-d tree; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir), f"pipeline-{name}", keep=True)
    return STAGES[-1][1](spark, docs, sf_dir)
