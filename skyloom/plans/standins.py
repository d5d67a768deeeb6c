"""The general tables seen as a sky catalogue: what the registered queries run on.

events: patch = user_id % 4, group = core_<user_id % 13>, row = event_id,
redshift = value.  orders: ra and dec from price and key.  embeddings: a wide
spectrum a row, cut into three shards of one patch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BINS, DECIMALS, LEVEL = 8, 2, 5
PATCHES = (0, 1, 2, 3)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        (F.col("user_id") % 4).cast("int").alias("skypatch"),
        F.concat(F.lit("core_"), (F.col("user_id") % 13).cast("string")).alias("core_group"),
        F.col("event_id").alias("row_in_group"),
        F.col("value").alias("redshift"),
        F.col("event_id").alias("core_tag"),
    )


def sky(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        key.alias("input_row"),
        (key % 4).cast("int").alias("partition_index"),
        F.pmod(F.col("o_totalprice") * 7.3, F.lit(360.0)).alias("ra"),
        (F.pmod(key * F.lit(0.5545), F.lit(180.0)) - 90.0).alias("dec"),
    )


#: DuckDB: the same two as common table expressions.
CATALOG_SQL = """cat AS (SELECT (user_id % 4)::INTEGER AS skypatch, 'core_' || (user_id % 13) AS core_group, event_id AS row_in_group,
  value AS redshift, event_id AS core_tag FROM events)"""
NUMBERED_SQL = CATALOG_SQL + """, num AS (SELECT *, row_number() OVER (PARTITION BY skypatch ORDER BY core_group, row_in_group) - 1 AS source_global_row FROM cat)"""
SKY_SQL = """sky AS (SELECT o_orderkey AS input_row, (o_orderkey % 4)::INTEGER AS partition_index,
  ((o_totalprice * 7.3::DOUBLE) % 360.0::DOUBLE) AS ra, ((o_orderkey * 0.5545::DOUBLE) % 180.0::DOUBLE) - 90.0::DOUBLE AS dec FROM orders)"""


def spectra(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Patch 0: a row a vector, with the identity columns that a shard carries."""
    return table(spark, sf_dir, "embeddings").select(
        F.lit(0).alias("skypatch"),
        F.col("vec_id").alias("source_global_row"),
        F.col("embedding").alias("SED"),
        F.col("vec_id").alias("core_tag"),
        (F.col("label") / 10.0).alias("redshift"),
    )


def shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three shards that cover all vectors: the first two fifths, the next two and the rest."""
    n = table(spark, sf_dir, "embeddings").agg(F.count(F.lit(1)).alias("n"), F.max(F.size("embedding")).alias("width"))
    at = lambda f: F.floor(F.col("n") * f / 5).cast("long")
    rows = F.array(*[F.struct(F.lit(i).alias("shard"), at(a).alias("row_offset"), (at(b) - at(a)).alias("n_rows")) for i, a, b in ((0, 0, 2), (1, 2, 4), (2, 4, 5))])
    return n.select(F.inline(rows), F.col("n").alias("n_global"), F.col("width")).select(
        F.lit(0).alias("patch"), "shard", F.lit(3).alias("nshards"), "row_offset", "n_rows", "n_global", "width", F.lit(64).alias("block_size"), F.lit(True).alias("complete"),
        F.format_string("seds_skypatch_0.shard%dof3.parquet", F.col("shard")).alias("name"),
    )


SHARDS_SQL = """tot AS (SELECT count(*) AS n, max(len(embedding))::INTEGER AS width FROM embeddings),
shards AS (SELECT 0 AS patch, i::INTEGER AS shard, 3 AS nshards, (n * lo // 5)::BIGINT AS row_offset, ((n * hi // 5) - (n * lo // 5))::BIGINT AS n_rows, n AS n_global, width
  FROM tot, (VALUES (0, 0, 2), (1, 2, 4), (2, 4, 5)) v(i, lo, hi))"""

EDGES_SQL = f"""qs AS (SELECT quantile_cont(redshift, [{', '.join(f'{i / BINS}' for i in range(BINS + 1))}]) AS q, min(redshift) AS lo, max(redshift) AS hi FROM cat),
raw AS (SELECT i, CASE i WHEN 0 THEN floor(lo / 0.01::DOUBLE) * 0.01::DOUBLE WHEN {BINS} THEN ceil(hi / 0.01::DOUBLE) * 0.01::DOUBLE
    ELSE round_even(q[i + 1] * 100.0::DOUBLE, 0) / 100.0::DOUBLE END AS e FROM qs, range(0, {BINS + 1}) t(i)),
rep(i, e) AS (SELECT i, e FROM raw WHERE i = 0 UNION ALL
    SELECT r.i, CASE WHEN r.e <= p.e THEN p.e + 0.01::DOUBLE ELSE r.e END FROM rep p JOIN raw r ON r.i = p.i + 1),
edges AS (SELECT list(round_even(e * 100.0::DOUBLE, 0) / 100.0::DOUBLE ORDER BY i) AS es FROM rep)"""
BINNED_SQL = NUMBERED_SQL + ", " + EDGES_SQL + f""", binned AS (SELECT num.*, greatest(0, least({BINS - 1}, len(list_filter(es, lambda x: x <= redshift)) - 1))::INTEGER AS partition_index FROM num, edges)"""
