"""The registered queries of the training-data operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (conversation_trie, decontam, jaccard_join, kd_sharding, lattice_lm, license_scan, line_chunks, line_quality, mixing, oracles, periodic_runs,
               pii_surrogates, span_dedup, token_store)
from .common import table

#: Mixing: no source passes more than this often, and every source at least once.
REPETITION = 2.0
SHARDS = 24
#: The key of the registered query; a user passes a secret one.
PII_KEY = b"public example key"


def _word_bpe() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _pieces() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op1_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.read_documents(token_store.write_store(table(spark, sf_dir, "documents"), _word_bpe()))


def op2_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_surrogates.pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"), PII_KEY)


def op3_kd_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (kd_sharding.kd_shards(table(spark, sf_dir, "documents"), n_shards=SHARDS)
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")))


def op4_line_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_chunks.line_digest(table(spark, sf_dir, "documents"))


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(table(spark, sf_dir, "documents"))


def op6_span_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return span_dedup.dedup_spans(table(spark, sf_dir, "documents"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("rid")


def op7_proximity(spark: SparkSession, sf_dir: str) -> DataFrame:
    near = decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), near=True)
    return near.select("doc_id", "n_words", "n_hit", "contaminated", "n_near", F.array_join("near_items", ",").alias("near_items"))


def op8_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_quality.judge(table(spark, sf_dir, "documents"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op10_temperature_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), repetition=REPETITION)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = periodic_runs.repeated_tails(table(spark, sf_dir, "documents"))
    return periodic_runs.run_digest(periodic_runs.find_runs(docs))


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = conversation_trie.ordered_turns(table(spark, sf_dir, "conversations"))
    return conversation_trie.prefix_trie(*conversation_trie.shared_heads(turns))


def op13_lattice_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice_lm.score_texts(table(spark, sf_dir, "documents"), _pieces())


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_token_store, op2_pii_surrogates, op3_kd_sharding, op4_line_chunks, op5_jaccard_join, op6_span_dedup,
                            op7_decontamination, op7_proximity, op8_line_quality, op9_license_scan, op10_temperature_mixing, op11_periodic_runs,
                            op12_conversation_trie, op13_lattice_lm)
}

#: DuckDB SQL of the queries that SQL can express on whole tables.
ORACLES: dict[str, str] = {"op6_span_dedup": oracles.SPAN_DEDUP, "op7_decontamination": oracles.DECONTAMINATION, "op8_line_quality": oracles.LINE_QUALITY,
                           "op12_conversation_trie": oracles.CONVERSATION_TRIE}
