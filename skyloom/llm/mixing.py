"""Mixing sources to target weights by Poisson replication (DataFrame only).

The target repetition rate of a source is its weight times all documents over
its own documents.  A document's copies are the inverse of the Poisson
distribution with that mean at a uniform number hashed from seed and doc_id;
the document is exploded by that count and all copies are shuffled globally
by a hash of doc_id and copy number.  A mean over PART is drawn as a sum of
equal smaller draws, so no distribution underflows.

Defined cases: a null source is a source of its own; a null doc_id hashes as
``null``; repeated rows get equal counts; a null, empty or long text is
carried along unread; an empty table gives no rows.  Of further columns only
those named like the three that are added are replaced, and none without
``marks``.  A source without a weight in ``weights`` gets weight 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyloom.llm.common import apart

SEED = 20_240_607
#: Weights are proportional to the source's documents to this power.
TEMPERATURE = 0.5
#: Most sources whose rates are broadcast; beyond that they are joined by shuffle.
BROADCAST_SOURCES = 10_000
#: Largest mean of one draw, and the terms kept of its distribution.
PART, TERMS = 64, 192
SALTS = 16


def uniform(*keys: Column) -> Column:
    """52 hashed bits in [0, 1)."""
    digest = F.md5(F.concat_ws(":", *keys).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def source_rates(docs: DataFrame, weights: dict[str, float] | None = None, temperature: float = TEMPERATURE, source: str = "source") -> tuple[DataFrame, int]:
    """mix_source, mix_rate for every source, and how many sources there are."""
    counts = docs.groupBy(F.coalesce(F.col(source).cast("string"), F.lit("\0null")).alias("mix_source")).agg(F.count(F.lit(1)).alias("n"))
    weight = F.pow(F.col("n").cast("double"), F.lit(temperature))
    if weights is not None:
        given = F.create_map(*[F.lit(x) for pair in weights.items() for x in pair]) if weights else F.create_map().cast("map<string,double>")
        weight = F.coalesce(F.try_element_at(given, F.col("mix_source")).cast("double"), F.lit(0.0))
    counts = counts.withColumn("weight", weight)
    total = counts.agg(F.count(F.lit(1)).alias("sources"), F.sum("n").alias("n"), F.sum("weight").alias("weight")).first()
    scale = (total["n"] or 0) / (total["weight"] or 1.0)
    return counts.select("mix_source", (F.col("weight") * F.lit(float(scale)) / F.col("n")).alias("mix_rate")), total["sources"]


def _with_distribution(rates: DataFrame) -> DataFrame:
    """Adds the number of draws and the cumulative distribution of one draw."""
    return rates.withColumn("mix_draws", F.greatest(F.ceil(F.col("mix_rate") / PART), F.lit(1)).cast("int")).withColumn(
        "mix_cdf",
        F.expr(
            f"""aggregate(sequence(1, {TERMS}),
                 struct(exp(-mix_rate / mix_draws) AS p, exp(-mix_rate / mix_draws) AS c, array(exp(-mix_rate / mix_draws)) AS a),
                 (s, k) -> struct(s.p * mix_rate / mix_draws / k AS p, s.c + s.p * mix_rate / mix_draws / k AS c,
                                  array_append(s.a, s.c + s.p * mix_rate / mix_draws / k) AS a),
                 s -> s.a)"""
        ),
    )


def _counted(docs: DataFrame, names: dict[str, str], weights: dict[str, float] | None, temperature: float, seed: int) -> tuple[DataFrame, Column]:
    """docs (of columns set apart) with mix_rate and mix_count, and the hashed key of a document."""
    rates, sources = source_rates(docs, weights, temperature, names["source"])
    rates = _with_distribution(rates)
    key = F.coalesce(F.col(names["doc_id"]).cast("string"), F.lit("null"))
    rows = docs.withColumn("mix_source", F.coalesce(F.col(names["source"]).cast("string"), F.lit("\0null")))
    if sources <= BROADCAST_SOURCES:
        rows = rows.join(F.broadcast(rates), "mix_source")
    else:
        salt = F.pmod(F.xxhash64(key), F.lit(SALTS)).cast("int")
        rates = rates.withColumn("mix_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        rows = rows.withColumn("mix_salt", salt).join(rates, ["mix_source", "mix_salt"]).drop("mix_salt")
    # each draw hashes once; the distribution is then searched for that number
    draws = F.transform(F.sequence(F.lit(0), F.col("mix_draws") - 1), lambda j: uniform(F.lit(str(seed)), j.cast("string"), key))
    count = F.aggregate(draws, F.lit(0), lambda n, u: n + F.size(F.filter("mix_cdf", lambda c: u >= c)))
    return rows.withColumn("mix_count", count).select(*names.values(), "mix_rate", "mix_count"), key


def counted(docs: DataFrame, weights: dict[str, float] | None = None, temperature: float = TEMPERATURE, seed: int = SEED) -> DataFrame:
    """docs with mix_rate and mix_count, the copies that each row is to get."""
    rows, names = apart(docs)
    rows, _ = _counted(rows, names, weights, temperature, seed)
    return rows.select(*[F.col(v).alias(k) for k, v in names.items() if k not in ("mix_rate", "mix_count")], "mix_rate", "mix_count")


def mix(docs: DataFrame, weights: dict[str, float] | None = None, temperature: float = TEMPERATURE, seed: int = SEED, marks: bool = True) -> DataFrame:
    """Every copy as a row, in random order, with mix_rate, mix_copy and mix_key, or without these ``marks``.

    mix_key is uniform, so hash partitions of it, each sorted by it, are one
    global random permutation, without a sampling pass over the texts.
    """
    rows, names = apart(docs)
    rows, key = _counted(rows, names, weights, temperature, seed)
    copies = (
        rows.where("mix_count > 0")
        .withColumn("mix_copy", F.explode(F.sequence(F.lit(1), F.col("mix_count"))))
        .drop("mix_count")
        .withColumn("mix_key", F.md5(F.concat_ws(":", F.lit(f"{seed}:order"), key, F.col("mix_copy")).cast("binary")))
    )
    added = ("mix_rate", "mix_copy", "mix_key") if marks else ()
    return copies.repartition("mix_key").sortWithinPartitions("mix_key").select(*[F.col(v).alias(k) for k, v in names.items() if k not in added], *added)


def sql(temperature: float = TEMPERATURE, seed: int = SEED) -> str:
    """mix() without weights in DuckDB SQL; the means are below PART here."""
    return f"""
WITH n AS (SELECT source, count(*)::DOUBLE AS n FROM documents GROUP BY source),
r AS (SELECT source, (pow(n, {temperature}) * (sum(n) OVER ()) / (sum(pow(n, {temperature})) OVER ())) / n AS rate FROM n),
c AS (SELECT source, k, sum(CASE WHEN k = 0 THEN exp(-rate) ELSE exp(k * ln(rate) - rate - lgamma(k + 1.0)) END)
        OVER (PARTITION BY source ORDER BY k) AS c FROM r, range(0, {TERMS + 1}) t(k)),
cdf AS (SELECT source, list(c ORDER BY k) AS cdf FROM c GROUP BY source),
d AS (SELECT d.*, r.rate, len(list_filter(cdf, lambda x: ('0x' || substr(md5('{seed}:0:' || d.doc_id), 1, 13))::BIGINT / {float(1 << 52)} >= x)) AS cnt
      FROM documents d JOIN r ON d.source IS NOT DISTINCT FROM r.source JOIN cdf ON d.source IS NOT DISTINCT FROM cdf.source)
SELECT doc_id, text, lang, source, n_chars, round(rate, 6) AS mix_rate, k::INTEGER AS mix_copy,
       md5('{seed}:order:' || doc_id || ':' || k) AS mix_key
FROM d, LATERAL (SELECT unnest(range(1, cnt + 1)) AS k)"""
