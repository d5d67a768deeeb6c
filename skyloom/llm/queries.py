"""The operators as queries over the given tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyloom.llm import decontaminate, exact, importance, kneser_ney, language, lm_scoring, mixing, oracles, sharding, simhash, suffix_arrays, suffix_trees, topk, whitening
from skyloom.llm.common import table


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.verdicts(decontaminate.scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


def op2_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kneser_ney.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_masked_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score(table(spark, sf_dir, "documents"))


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).withColumn("mix_rate", F.round("mix_rate", 6))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op6_suffix_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_trees.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op7_histogram_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents")).select(
        "doc_id",
        F.col("shard_bytes").alias("size"),
        F.col("shard_crc").alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        F.col("shard_slot").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.verdicts(simhash.near_duplicates(table(spark, sf_dir, "documents")))


def op9_suffix_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_arrays.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256")


def op10_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_whiten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.verdicts(table(spark, sf_dir, "embeddings"))


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.verdicts(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_decontaminate,
        op2_kneser_ney,
        op3_masked_lm,
        op4_mix_sources,
        op5_language_id,
        op6_suffix_trees,
        op7_histogram_shards,
        op8_simhash,
        op9_suffix_arrays,
        op10_top_k,
        op11_importance_resampling,
        op12_whiten,
        op13_exact_dedup,
    )
}

ORACLE_SQL: dict[str, str] = {
    "op1_decontaminate": oracles.DECONTAMINATE,
    "op4_mix_sources": mixing.sql(),
    "op7_histogram_shards": sharding.sql(),
    "op6_suffix_trees": oracles.SUFFIX_TREES,
    "op9_suffix_arrays": oracles.SUFFIX_ARRAYS,
    "op10_top_k": topk.sql(),
    "op11_importance_resampling": importance.sql(),
    "op13_exact_dedup": exact.sql(),
}
