"""A training corpus from ``documents``: five stages, each a DataFrame to a DataFrame.

Language ID drops documents without an identifiable language; SimHash
near-dedup keeps one document of each group; decontamination drops documents
that quote the benchmark; mixing repeats each document by a Poisson draw
towards its source's weight; sharding adds each row's shard and slot.  All but
the last return the columns of ``documents``.

Defined cases: a document of null or empty text, or without letters, has no
language and goes; rows that repeat a doc_id are one document, of which one row
stays; a row without a doc_id is a document known by its fingerprint; a null
source is a source of its own; a very long text goes through whole; equal sizes
and hashes are ordered by doc_id; empty tables give no rows; further columns are
carried along whatever their names, but for those that sharding adds (shard,
shard_slot, shard_bytes, shard_crc), which it replaces.
"""

from __future__ import annotations

import posixpath
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from skyloom.llm import decontaminate, language, mixing, sharding, simhash
from skyloom.llm.common import shared_folder, table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language.keep_identified(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_first(docs)


def drop_benchmark_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs, marks=False)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharding.shard(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", identify_language),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_benchmark_text),
    ("source_mixing", mix_sources),
    ("histogram_sharding", shard),
]

#: Learned labels and hashes of shingles are beyond SQL; a test rebuilds run() by brute force.
ORACLE_SQL = None


def _remove(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each written to the shared folder and reread; what a stage has read goes when it is written."""
    folder = posixpath.join(shared_folder(spark), f"pipeline-{uuid.uuid4().hex}")
    docs, read = table(spark, sf_dir, "documents"), None
    for k, (name, stage) in enumerate(STAGES):
        path = posixpath.join(folder, f"{k}-{name}")
        stage(spark, docs, sf_dir).write.mode("overwrite").parquet(path)
        docs = spark.read.parquet(path)
        if read:
            _remove(spark, read)
        read = path
    return docs
