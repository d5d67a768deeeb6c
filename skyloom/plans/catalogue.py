"""The engine's operators as registered queries, each with the same result in DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyloom.functions import arrays, healpix, names, numeric
from skyloom.operators import binning, checks, fingerprint, meta, projection, regions, rows, spatial, spectra, storage, tree
from skyloom.plans import pipeline
from skyloom.plans.standins import BINNED_SQL, BINS, CATALOG_SQL, DECIMALS, EDGES_SQL, LEVEL, NUMBERED_SQL, PATCHES, SHARDS_SQL, SKY_SQL
from skyloom.plans.standins import catalog as catalog_of
from skyloom.plans.standins import shards as shards_of
from skyloom.plans.standins import sky as sky_of
from skyloom.plans.standins import spectra as spectra_of
from skyloom.plans.standins import table
from skyloom.sources import layout

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str) -> Callable[[Query], Query]:
    def keep(f: Query) -> Query:
        QUERIES[f.__name__] = f
        ORACLE_SQL[f.__name__] = sql
        return f

    return keep


def _edges(spark: SparkSession, d: str) -> list[float]:
    return binning.quantile_edges(catalog_of(spark, d), "redshift", BINS, DECIMALS)


def _binned(spark: SparkSession, d: str) -> tuple[DataFrame, list[float]]:
    edges = _edges(spark, d)
    return binning.assign_bins(rows.number_rows(catalog_of(spark, d)), "redshift", edges), edges


def _flat(spark: SparkSession, d: str) -> DataFrame:
    """The catalogue's redshift as a flat source in single precision; every 97th row is off."""
    numbered = rows.number_rows(catalog_of(spark, d))
    off = F.when(F.col("row_in_group") % 97 == 0, 0.5).otherwise(0.0)
    return numbered.select("skypatch", "source_global_row", (F.col("redshift") + off).cast("float").alias("redshift"))


_FLAT_SQL = "flat AS (SELECT skypatch, source_global_row, (redshift + CASE WHEN row_in_group % 97 = 0 THEN 0.5::DOUBLE ELSE 0.0::DOUBLE END)::FLOAT AS redshift FROM num)"
_ENDS_SQL = f"WITH {NUMBERED_SQL}, {_FLAT_SQL}, ends AS (SELECT skypatch, core_group, min(source_global_row) AS a, max(source_global_row) AS b FROM num GROUP BY 1, 2), bad AS (SELECT DISTINCT num.skypatch, num.core_group, num.source_global_row FROM num JOIN ends ON num.skypatch = ends.skypatch AND num.source_global_row IN (a, b) JOIN flat ON flat.skypatch = num.skypatch AND flat.source_global_row = num.source_global_row WHERE num.redshift::FLOAT <> flat.redshift)"


# --- rows -----------------------------------------------------------------


@query(f"WITH {CATALOG_SQL}, s AS (SELECT skypatch, core_group, count(*) AS n_rows FROM cat GROUP BY 1, 2) SELECT *, coalesce(sum(n_rows) OVER (PARTITION BY skypatch ORDER BY core_group ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS row_offset, (sum(n_rows) OVER (PARTITION BY skypatch))::BIGINT AS n_total FROM s")
def core_group_offsets(spark: SparkSession, d: str) -> DataFrame:
    return rows.group_offsets(catalog_of(spark, d))


@query(f"WITH {NUMBERED_SQL} SELECT skypatch, core_group, row_in_group, source_global_row FROM num")
def global_row_number(spark: SparkSession, d: str) -> DataFrame:
    return rows.number_rows(catalog_of(spark, d)).select("skypatch", "core_group", "row_in_group", "source_global_row")


@query("SELECT 0 AS skypatch, 'core_' || (vec_id // 100) AS core_group, vec_id % 100 AS row_in_group, (coalesce((SELECT count(*) FROM embeddings b WHERE 'core_' || (b.vec_id // 100) < 'core_' || (a.vec_id // 100)), 0) + vec_id % 100)::BIGINT AS source_global_row FROM embeddings a")
def dense_row_number(spark: SparkSession, d: str) -> DataFrame:
    cat = table(spark, d, "embeddings").select(F.lit(0).alias("skypatch"), F.concat(F.lit("core_"), F.floor(F.col("vec_id") / 100).cast("string")).alias("core_group"), (F.col("vec_id") % 100).alias("row_in_group"))
    return rows.number_dense_rows(cat).select("skypatch", "core_group", "row_in_group", "source_global_row")


@query(f"WITH {NUMBERED_SQL}, {_FLAT_SQL} SELECT num.skypatch, source_global_row, num.core_tag, num.redshift, flat.redshift::DOUBLE AS flat_redshift, (num.redshift * 2)::DOUBLE AS magnitude FROM num JOIN flat USING (skypatch, source_global_row)")
def positional_join(spark: SparkSession, d: str) -> DataFrame:
    cat = rows.number_rows(catalog_of(spark, d))
    lum = _flat(spark, d).withColumn("flat_redshift", F.col("redshift").cast("double")).drop("redshift")
    phot = cat.select("skypatch", "source_global_row", (F.col("redshift") * 2).alias("magnitude"))
    return rows.positional_join(cat.select("skypatch", "source_global_row", "core_tag", "redshift"), lum, phot)


@query(f"WITH {NUMBERED_SQL}, s AS (SELECT skypatch, core_group, min(source_global_row) AS low FROM num GROUP BY 1, 2) SELECT num.skypatch, num.source_global_row, s.core_group, num.source_global_row - s.low AS row_in_group FROM num ASOF JOIN s ON num.skypatch = s.skypatch AND num.source_global_row >= s.low")
def row_to_group_asof(spark: SparkSession, d: str) -> DataFrame:
    cat = catalog_of(spark, d)
    numbered = rows.number_rows(cat).select("skypatch", "source_global_row")
    return rows.group_of_rows(numbered, rows.group_offsets(cat))


@query(f"WITH {NUMBERED_SQL} SELECT skypatch, source_global_row, substr(core_group, 6)::INTEGER AS source_core, core_tag FROM num")
def provenance_columns(spark: SparkSession, d: str) -> DataFrame:
    return rows.with_provenance(rows.number_rows(catalog_of(spark, d))).select("skypatch", "source_global_row", "source_core", "core_tag")


@query(f"WITH {CATALOG_SQL}, s AS (SELECT skypatch, count(*) AS n FROM cat GROUP BY 1) SELECT DISTINCT skypatch, (i * (n - 1)) // (least(16, n) - 1) AS sample_row FROM s, range(0, 16) t(i) WHERE i < least(16, n)")
def sample_rows(spark: SparkSession, d: str) -> DataFrame:
    sizes = catalog_of(spark, d).groupBy("skypatch").agg(F.count(F.lit(1)).alias("n_rows"))
    return rows.sample_rows(sizes, spectra.SAMPLES).select("skypatch", "sample_row")


@query("SELECT url AS path, min(page_id) AS first_position FROM (SELECT page_id, regexp_replace(url, '[?#].*$', '') AS url FROM pages) GROUP BY url")
def target_dedupe(spark: SparkSession, d: str) -> DataFrame:
    found = table(spark, d, "pages").select(F.regexp_replace("url", "[?#].*$", "").alias("path"), F.col("page_id").alias("first_position"))
    return rows.first_of(found, "path", "first_position").select("path", "first_position")


@query("SELECT (user_id % 4)::INTEGER AS skypatch FROM events GROUP BY 1")
def distinct_patches(spark: SparkSession, d: str) -> DataFrame:
    return layout.distinct_patches(catalog_of(spark, d))


@query("SELECT l_orderkey, l_linenumber, (count(*) - 1)::BIGINT AS n_repeats FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def adjacent_duplicates(spark: SparkSession, d: str) -> DataFrame:
    found = checks.adjacent_duplicates(table(spark, d, "lineitem").select("l_orderkey", "l_linenumber"), ["l_orderkey", "l_linenumber"])
    return found.groupBy("l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("n_repeats"))


# --- bins -----------------------------------------------------------------


@query(f"WITH RECURSIVE {CATALOG_SQL}, {EDGES_SQL} SELECT i::INTEGER AS edge_index, es[i + 1] AS edge FROM edges, range(0, {BINS + 1}) t(i)")
def quantile_edges(spark: SparkSession, d: str) -> DataFrame:
    edges = F.array(*[F.lit(e) for e in _edges(spark, d)])
    return spark.range(1).select(F.posexplode(edges).alias("edge_index", "edge"))


@query(f"WITH RECURSIVE {BINNED_SQL} SELECT b.i::INTEGER AS partition_index, es[b.i + 1] AS z_min, es[b.i + 2] AS z_max, (SELECT count(*) FROM binned WHERE partition_index = b.i) AS n_objects FROM edges, range(0, {BINS}) b(i)")
def quantile_bins(spark: SparkSession, d: str) -> DataFrame:
    edges = _edges(spark, d)
    counts = binning.bin_counts(binning.assign_bins(catalog_of(spark, d), "redshift", edges), BINS)
    return meta.manifest(counts, edges, list(PATCHES)).select("partition_index", "z_min", "z_max", "n_objects")


@query(f"WITH RECURSIVE {BINNED_SQL} SELECT skypatch, source_global_row, partition_index FROM binned")
def bin_assignment(spark: SparkSession, d: str) -> DataFrame:
    return _binned(spark, d)[0].select("skypatch", "source_global_row", "partition_index")


_PATCH_BINS_SQL = f"WITH RECURSIVE {BINNED_SQL}, pb AS (SELECT p.skypatch, b.i::INTEGER AS partition_index, (SELECT count(*) FROM binned x WHERE x.partition_index = b.i AND x.skypatch = p.skypatch) AS n_objects FROM (SELECT DISTINCT skypatch FROM cat) p, range(0, {BINS}) b(i))"


@query(_PATCH_BINS_SQL + " SELECT * FROM pb")
def patch_bin_counts(spark: SparkSession, d: str) -> DataFrame:
    return binning.bin_counts(binning.assign_bins(catalog_of(spark, d), "redshift", _edges(spark, d)), BINS, ["skypatch"])


@query(_PATCH_BINS_SQL + " SELECT *, coalesce(sum(n_objects) OVER (PARTITION BY partition_index ORDER BY skypatch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS bin_start FROM pb")
def patch_bin_starts(spark: SparkSession, d: str) -> DataFrame:
    return binning.patch_starts(patch_bin_counts(spark, d))


@query(f"WITH RECURSIVE {BINNED_SQL}, c AS (SELECT b.i, (SELECT count(*) FROM binned WHERE partition_index = b.i) AS n FROM range(0, {BINS}) b(i)) SELECT i::INTEGER AS partition_index, n AS n_objects, round(n / (sum(n) OVER () / {BINS}.0) - 1, 6)::DOUBLE AS deviation, round((max(n) OVER () - min(n) OVER ()) / (sum(n) OVER () / {BINS}.0), 6)::DOUBLE AS spread FROM c")
def balance_report(spark: SparkSession, d: str) -> DataFrame:
    edges = _edges(spark, d)
    counts = binning.bin_counts(binning.assign_bins(catalog_of(spark, d), "redshift", edges), BINS)
    found = binning.balance(counts, edges)
    return found.select("partition_index", "n_objects", F.round("deviation", 6).alias("deviation"), F.round("spread", 6).alias("spread"))


@query(f"WITH {CATALOG_SQL} SELECT skypatch, core_group, count(*) AS n_objects, min(redshift) AS key_min, max(redshift) AS key_max FROM cat GROUP BY 1, 2")
def core_redshift_stats(spark: SparkSession, d: str) -> DataFrame:
    return binning.key_statistics(catalog_of(spark, d), "redshift", ["skypatch", "core_group"])


@query(f"WITH {CATALOG_SQL} SELECT count(*) AS n_objects, min(redshift) AS key_min, max(redshift) AS key_max FROM cat")
def catalog_summary(spark: SparkSession, d: str) -> DataFrame:
    return binning.key_statistics(catalog_of(spark, d), "redshift", [])


@query(f"WITH RECURSIVE {BINNED_SQL} SELECT partition_index, round(median(redshift), 6) AS median FROM binned GROUP BY 1")
def median_per_bin(spark: SparkSession, d: str) -> DataFrame:
    binned = binning.assign_bins(catalog_of(spark, d), "redshift", _edges(spark, d))
    return binning.medians(binned, "redshift").select("partition_index", F.round("median", 6).alias("median"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round_even(l_extendedprice / 7.0 * 100.0::DOUBLE, 0) / 100.0::DOUBLE AS rounded FROM lineitem")
def scaled_rounding(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", numeric.round_half_even(F.col("l_extendedprice") / 7.0, 2).alias("rounded"))


@query(f"WITH RECURSIVE {BINNED_SQL} SELECT b.i::INTEGER AS partition_index, es[b.i + 1] AS z_min, es[b.i + 2] AS z_max, {BINS} AS n_partitions, (SELECT count(*) FROM binned WHERE partition_index = b.i) AS n_objects, array_to_string(list_transform(es, lambda e: printf('%.2f', e)), ' ') AS redshift_edges, '0 1 2 3' AS skypatches, printf('catalogue_%04d_z_%05.2f_%05.2f', b.i, es[b.i + 1], es[b.i + 2]) AS name FROM edges, range(0, {BINS}) b(i)")
def partition_manifest(spark: SparkSession, d: str) -> DataFrame:
    edges = _edges(spark, d)
    counts = binning.bin_counts(binning.assign_bins(catalog_of(spark, d), "redshift", edges), BINS)
    found = meta.manifest(counts, edges, list(PATCHES))
    text = F.array_join(F.transform("redshift_edges", lambda e: F.format_string("%.2f", e)), " ")
    return found.withColumns({"redshift_edges": text, "skypatches": F.array_join(F.transform("skypatches", lambda p: p.cast("string")), " ")})


# --- pixels ---------------------------------------------------------------


def _pixels(level: int) -> Query:
    def run(spark: SparkSession, d: str) -> DataFrame:
        return spatial.with_pixel(sky_of(spark, d), level).select("input_row", "pixel")

    run.__name__ = f"healpix_pixel_l{level}"
    return run


for _level in (0, 3, 5, 13):
    query(f"WITH {SKY_SQL} SELECT input_row, {healpix.pixel_sql('ra', 'dec', _level)}::BIGINT AS pixel FROM sky")(_pixels(_level))


def _pix_sql(level: int) -> str:
    return SKY_SQL + f", pix AS (SELECT *, {healpix.pixel_sql('ra', 'dec', level)}::BIGINT AS pixel FROM sky)"


@query(f"WITH {_pix_sql(4)} SELECT pixel, count(*) AS n_objects FROM pix GROUP BY 1")
def pixel_index_rollup(spark: SparkSession, d: str) -> DataFrame:
    every = sky_of(spark, d).withColumn("partition_index", F.lit(0))
    rolled = spatial.rolled_up(spatial.pixel_counts(spatial.with_pixel(every, LEVEL), LEVEL), LEVEL)
    return rolled.where("level = 4").select("pixel", F.col("size").alias("n_objects"))


_SPARSE_SQL = f"WITH {_pix_sql(LEVEL)}, c AS (SELECT partition_index, l::INTEGER AS level, pixel >> (2 * ({LEVEL} - l)) AS pixel, count(*) AS size FROM pix, range(0, {LEVEL + 1}) t(l) GROUP BY 1, 2, 3)"


@query(_SPARSE_SQL + " SELECT partition_index, level, pixel, coalesce(sum(size) OVER (PARTITION BY partition_index, level ORDER BY pixel ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start, size FROM c")
def pixel_index_sparse(spark: SparkSession, d: str) -> DataFrame:
    return spatial.sparse_index(spatial.with_pixel(sky_of(spark, d), LEVEL), LEVEL)


@query(f"WITH {_pix_sql(3)}, c AS (SELECT p.partition_index, g.i AS pixel, count(pix.pixel) AS size FROM (SELECT DISTINCT partition_index FROM pix) p CROSS JOIN range(0, 768) g(i) LEFT JOIN pix ON pix.partition_index = p.partition_index AND pix.pixel = g.i GROUP BY 1, 2) SELECT partition_index, 3 AS level, pixel, coalesce(sum(size) OVER (PARTITION BY partition_index ORDER BY pixel ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start, size FROM c")
def pixel_index_dense(spark: SparkSession, d: str) -> DataFrame:
    return spatial.dense_index(spatial.sparse_index(spatial.with_pixel(sky_of(spark, d), 3), 3), 3)


@query(f"WITH {_pix_sql(3)}, c AS (SELECT partition_index, pixel, count(*) AS n FROM pix GROUP BY 1, 2) SELECT partition_index, count(*) AS n_filled, 768::BIGINT AS n_pixels, min(n) AS size_min, max(n) AS size_max, round(avg(n), 6) AS size_mean FROM c GROUP BY 1")
def occupancy(spark: SparkSession, d: str) -> DataFrame:
    counts = spatial.pixel_counts(spatial.with_pixel(sky_of(spark, d), 3), 3)
    return spatial.occupancy(counts, 3).withColumn("size_mean", F.round("size_mean", 6))


@query(f"WITH {_pix_sql(LEVEL)} SELECT partition_index, row_number() OVER (PARTITION BY partition_index ORDER BY pixel, input_row) - 1 AS output_row, input_row FROM pix")
def spatial_order_permutation(spark: SparkSession, d: str) -> DataFrame:
    return spatial.provenance(spatial.ordered_rows(spatial.with_pixel(sky_of(spark, d), LEVEL)))


@query(f"WITH {_pix_sql(LEVEL)} SELECT partition_index, input_row, pixel FROM pix WHERE pixel >> {2 * (LEVEL - 1)} = 17")
def region_read(spark: SparkSession, d: str) -> DataFrame:
    found = spatial.with_pixel(sky_of(spark, d), LEVEL)
    return found.where(spatial.in_region(F.col("pixel"), 17, 1, LEVEL)).select("partition_index", "input_row", "pixel")


@query(_SPARSE_SQL + " SELECT level, (1 << level)::BIGINT AS nside, (12 * (1 << (2 * level)))::BIGINT AS npix, round(degrees(sqrt(4 * pi() / (12 * (1 << (2 * level))))) * 60, 6) AS resolution_arcmin, count(*) AS n_entries, sum(size)::BIGINT AS n_objects FROM c GROUP BY level")
def pixel_resolution(spark: SparkSession, d: str) -> DataFrame:
    """What the levels of a written index are, and hold."""
    index = spatial.sparse_index(spatial.with_pixel(sky_of(spark, d), LEVEL), LEVEL)
    return spatial.level_summary(index).withColumn("resolution_arcmin", F.round("resolution_arcmin", 6))


#: A disc across partitions and base pixels, and a quadrangle on the celestial equator.
CONE = regions.cone(200.0, -35.0, 18.0)
QUADRANGLE = regions.polygon([(40.0, -20.0), (95.0, -12.0), (88.0, 31.0), (35.0, 22.0)])


@query(f"WITH {SKY_SQL} SELECT partition_index, input_row FROM sky WHERE {regions.inside_sql(CONE)}")
def cone_search(spark: SparkSession, d: str) -> DataFrame:
    """Pixels of the cover first, which sorted files can answer, then the exact distance."""
    found = spatial.with_pixel(sky_of(spark, d), LEVEL).where(regions.in_ranges(F.col("pixel"), regions.cover(CONE, LEVEL)))
    return found.where(regions.inside(CONE)).select("partition_index", "input_row")


@query(f"WITH {SKY_SQL} SELECT partition_index, input_row FROM sky WHERE {regions.inside_sql(QUADRANGLE)}")
def polygon_search(spark: SparkSession, d: str) -> DataFrame:
    found = spatial.with_pixel(sky_of(spark, d), LEVEL).where(regions.in_ranges(F.col("pixel"), regions.cover(QUADRANGLE, LEVEL)))
    return found.where(regions.inside(QUADRANGLE)).select("partition_index", "input_row")


@query(f"WITH {_pix_sql(LEVEL)}, o AS (SELECT *, row_number() OVER (PARTITION BY partition_index ORDER BY pixel, input_row) - 1 AS output_row FROM pix) SELECT partition_index, output_row, input_row FROM o WHERE {regions.inside_sql(CONE)}")
def cone_slices(spark: SparkSession, d: str) -> DataFrame:
    """The rows of a disc by the index alone: (start, size) slices of the files' rows, then the exact distance."""
    pixels = rows.checkpointed(spatial.with_pixel(sky_of(spark, d), LEVEL))
    near = regions.near(spatial.sparse_index(pixels, LEVEL), CONE, LEVEL)
    return spatial.ordered_rows(pixels).where(near).where(regions.inside(CONE)).select("partition_index", "output_row", "input_row")


@query(f"WITH RECURSIVE {BINNED_SQL}, pos AS (SELECT b.*, {healpix.pixel_sql('((redshift * 7.3::DOUBLE) % 360.0::DOUBLE)', '(((core_tag * 0.5545::DOUBLE) % 180.0::DOUBLE) - 90.0::DOUBLE)', LEVEL)}::BIGINT AS pixel FROM binned b), inp AS (SELECT *, row_number() OVER (PARTITION BY partition_index ORDER BY skypatch, source_global_row) - 1 AS input_row FROM pos) SELECT partition_index, row_number() OVER (PARTITION BY partition_index ORDER BY pixel, input_row) - 1 AS output_row, input_row, pixel, skypatch, source_global_row, redshift, round(redshift * 2, 6) AS mag_u FROM inp")
def published_catalogue(spark: SparkSession, d: str) -> DataFrame:
    """The whole run on the stand-ins: number, bin, order by pixel, join three sources."""
    cat = catalog_of(spark, d).withColumns({"ra": F.pmod(F.col("redshift") * 7.3, F.lit(360.0)), "dec": F.pmod(F.col("core_tag") * F.lit(0.5545), F.lit(180.0)) - 90.0})
    numbered = rows.number_rows(pipeline.narrow(cat))
    places = rows.checkpointed(pipeline.in_pixel_order(pipeline.placed(numbered, binning.quantile_edges(cat, "redshift", BINS, DECIMALS)), LEVEL))
    keys = ["skypatch", "source_global_row"]
    lum = places.select(*keys, F.col("redshift").cast("float").alias("redshift"), F.array("ra", "dec").alias("M_ABS_SDSS"))
    phot = places.select(*keys, F.array(F.col("redshift") * 2, F.col("redshift") * 3).alias("survey"))
    specs = projection.resolve_columns(cat, lum, phot, {"_LUM_M_ABS_SDSS": ["g", "r"], "survey": ["u.txt", "a.b-c"]})
    found = pipeline.payload(cat, lum, phot, specs, places)
    return found.select("partition_index", "output_row", "input_row", "pixel", *keys, "redshift", F.round("mag_u", 6).alias("mag_u"))


_PROOF_SQL = ", ".join(f"sum(('0x' || substr(h, {8 * k + 1}, 8))::BIGINT)::BIGINT AS h{k}" for k in range(4))


@query(f"WITH {NUMBERED_SQL}, d AS (SELECT md5(skypatch || ':' || source_global_row || ':' || core_tag) AS h FROM num) SELECT side, count(*) AS n, {_PROOF_SQL} FROM d, (VALUES ('published'), ('source')) v(side) GROUP BY side")
def lossless_proof(spark: SparkSession, d: str) -> DataFrame:
    """Sums of row hashes of the numbered catalogue and of the same rows binned and put in their places."""
    numbered = rows.number_rows(catalog_of(spark, d))
    after = pipeline.placed(numbered, _edges(spark, d)).repartition("partition_index")
    digest = F.md5(F.concat_ws(":", "skypatch", "source_global_row", "core_tag").cast("binary"))
    sums = [x.agg(*fingerprint.digest_sums(digest)).withColumn("side", F.lit(side)) for side, x in (("source", numbered), ("published", after))]
    return sums[0].unionByName(sums[1])


# --- spectra --------------------------------------------------------------


@query(f"WITH {SHARDS_SQL} SELECT 0 AS skypatch, vec_id AS source_global_row, shard, vec_id - row_offset AS local_row FROM embeddings JOIN shards ON vec_id >= row_offset AND vec_id < row_offset + n_rows")
def shard_interval_join(spark: SparkSession, d: str) -> DataFrame:
    return spectra.shard_of_rows(spectra_of(spark, d).select("skypatch", "source_global_row"), shards_of(spark, d))


@query(f"WITH {SHARDS_SQL} SELECT patch, shard, row_offset, n_rows, coalesce(sum(n_rows) OVER (PARTITION BY patch ORDER BY row_offset, shard ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS expected_offset FROM shards")
def shard_contiguity(spark: SparkSession, d: str) -> DataFrame:
    return spectra.coverage(shards_of(spark, d)).select("patch", "shard", "row_offset", "n_rows", "expected_offset")


def _broken_shards(spark: SparkSession, d: str) -> DataFrame:
    """Good shards (patch 0), a gap (1), a wrong total (2) and a lost middle shard (3)."""
    good = shards_of(spark, d)
    return (
        good.unionByName(good.withColumns({"patch": F.lit(1), "row_offset": F.col("row_offset") + F.when(F.col("shard") == 1, 1).otherwise(0)}))
        .unionByName(good.withColumns({"patch": F.lit(2), "n_global": F.col("n_global") + 5}))
        .unionByName(good.where("shard <> 1").withColumn("patch", F.lit(3)))
    )


_BROKEN_SQL = f"{SHARDS_SQL}, broken AS (SELECT * FROM shards UNION ALL SELECT 1, shard, nshards, row_offset + CASE WHEN shard = 1 THEN 1 ELSE 0 END, n_rows, n_global, width FROM shards UNION ALL SELECT 2, shard, nshards, row_offset, n_rows, n_global + 5, width FROM shards UNION ALL SELECT 3, shard, nshards, row_offset, n_rows, n_global, width FROM shards WHERE shard <> 1)"


@query(f"WITH {_BROKEN_SQL}, e AS (SELECT *, coalesce(sum(n_rows) OVER (PARTITION BY patch ORDER BY row_offset, shard ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS x FROM broken) SELECT patch, count(*) FILTER (row_offset <> x) AS n_gaps, sum(n_rows)::BIGINT AS n_covered, max(n_global) AS n_global FROM e GROUP BY 1 HAVING count(*) FILTER (row_offset <> x) > 0 OR sum(n_rows) <> max(n_global)")
def shard_range_violations(spark: SparkSession, d: str) -> DataFrame:
    return checks.shard_range_violations(_broken_shards(spark, d))


@query(f"WITH {_BROKEN_SQL} SELECT patch, count(*) AS n, max(nshards) AS nshards FROM broken GROUP BY 1 HAVING count(*) <> max(nshards) OR min(shard) <> 0 OR max(shard) <> max(nshards) - 1")
def shard_set_violations(spark: SparkSession, d: str) -> DataFrame:
    return checks.shard_set_violations(_broken_shards(spark, d)).select("patch", "n", "nshards")


@query(f"WITH {_BROKEN_SQL} SELECT patch, shard, 'name and metadata disagree' AS reason FROM broken WHERE patch <> 0")
def shard_metadata_violations(spark: SparkSession, d: str) -> DataFrame:
    return checks.shard_metadata_violations(_broken_shards(spark, d)).select("patch", "shard", "reason")


@query("SELECT 0 AS skypatch, vec_id AS source_global_row, len(embedding)::INTEGER AS width, round(embedding[1]::DOUBLE, 6) AS first_value FROM embeddings")
def sed_concat(spark: SparkSession, d: str) -> DataFrame:
    shards = shards_of(spark, d)
    source = spectra.shard_of_rows(spectra_of(spark, d), shards).select(F.lit(0).alias("patch"), "shard", "local_row", "SED")
    found = spectra.concatenated(source, shards)
    return found.select("skypatch", "source_global_row", F.size("SED").alias("width"), F.round(arrays.element(F.col("SED"), 0).cast("double"), 6).alias("first_value"))


def _final(spark: SparkSession, d: str) -> DataFrame:
    """Final rows: patch 0 of the catalogue in bins, with the spectrum's tag and redshift, some of them off."""
    own = spectra_of(spark, d).select("skypatch", "source_global_row", "core_tag", "redshift")
    off = F.when(F.col("source_global_row") % 31 == 0, 0.25).when(F.col("source_global_row") % 37 == 0, F.lit(float("nan"))).otherwise(0.0)
    final = own.withColumns({"redshift": F.col("redshift") + off, "partition_index": (F.col("source_global_row") % 3).cast("int"), "output_row": F.floor(F.col("source_global_row") / 3).cast("long")})
    return final


_FINAL_SQL = "final AS (SELECT 0 AS skypatch, vec_id AS source_global_row, vec_id AS core_tag, label / 10.0::DOUBLE + CASE WHEN vec_id % 31 = 0 THEN 0.25::DOUBLE WHEN vec_id % 37 = 0 THEN 'nan'::DOUBLE ELSE 0 END AS redshift, (vec_id % 3)::INTEGER AS partition_index, vec_id // 3 AS output_row FROM embeddings)"


@query("SELECT (event_id % 2)::INTEGER AS skypatch, event_id AS source_global_row, CASE WHEN vec_id IS NULL THEN NULL ELSE round(embedding[2]::DOUBLE, 6) END AS second_value FROM events LEFT JOIN embeddings ON event_id % 2 = 0 AND vec_id = event_id")
def sed_gather(spark: SparkSession, d: str) -> DataFrame:
    final = table(spark, d, "events").select((F.col("event_id") % 2).cast("int").alias("skypatch"), F.col("event_id").alias("source_global_row"))
    found = spectra.gathered(final, spectra_of(spark, d))
    return found.select("skypatch", "source_global_row", F.round(arrays.element(F.col("SED"), 1).cast("double"), 6).alias("second_value"))


@query("SELECT (event_id % 2)::INTEGER AS skypatch, event_id AS source_global_row FROM events WHERE NOT (event_id % 2 = 0 AND event_id IN (SELECT vec_id FROM embeddings))")
def sed_missing(spark: SparkSession, d: str) -> DataFrame:
    final = table(spark, d, "events").select((F.col("event_id") % 2).cast("int").alias("skypatch"), F.col("event_id").alias("source_global_row"))
    return spectra.missing_spectra(final, spectra_of(spark, d))


@query("SELECT 0 AS skypatch, l_orderkey AS source_global_row, count(*) AS n_references FROM lineitem GROUP BY 2 HAVING count(*) > 1")
def sed_duplicates(spark: SparkSession, d: str) -> DataFrame:
    return spectra.duplicate_references(table(spark, d, "lineitem").select(F.lit(0).alias("skypatch"), F.col("l_orderkey").alias("source_global_row")))


@query(f"WITH {SHARDS_SQL} SELECT (event_id % 2)::INTEGER AS skypatch, event_id - 3 AS source_global_row FROM events WHERE event_id % 2 = 1 OR event_id - 3 < 0 OR event_id - 3 >= (SELECT max(n_global) FROM shards)")
def sed_out_of_range(spark: SparkSession, d: str) -> DataFrame:
    final = table(spark, d, "events").select((F.col("event_id") % 2).cast("int").alias("skypatch"), (F.col("event_id") - 3).alias("source_global_row"))
    return spectra.out_of_range(final, shards_of(spark, d))


@query(f"WITH {_FINAL_SQL}, s AS (SELECT partition_index, count(*) AS n FROM final GROUP BY 1), p AS (SELECT DISTINCT partition_index, (i * (n - 1)) // (least(64, n) - 1) AS output_row FROM s, range(0, 64) t(i) WHERE i < least(64, n)) SELECT partition_index, output_row, source_global_row FROM final JOIN p USING (partition_index, output_row) JOIN embeddings ON vec_id = source_global_row WHERE isnan(redshift) OR abs(redshift - label / 10.0::DOUBLE) > 1e-6")
def identity_check(spark: SparkSession, d: str) -> DataFrame:
    return spectra.identity_violations(_final(spark, d), spectra_of(spark, d), samples=64).select("partition_index", "output_row", "source_global_row")


@query(f"WITH {SHARDS_SQL}, p AS (SELECT DISTINCT row_offset + (i * (n_rows - 1)) // (least(64, n_rows) - 1) AS r FROM shards, range(0, 64) t(i) WHERE i < least(64, n_rows)) SELECT 0 AS skypatch, r AS source_global_row FROM p WHERE r % 29 = 0 OR r % 23 = 0")
def source_identity_check(spark: SparkSession, d: str) -> DataFrame:
    own = spectra_of(spark, d)
    cat = own.select("skypatch", "source_global_row", (F.col("core_tag") + F.when(F.col("source_global_row") % 29 == 0, 1).otherwise(0)).alias("core_tag"), "redshift")
    lum = own.select("skypatch", "source_global_row", (F.col("redshift") + F.when(F.col("source_global_row") % 23 == 0, 0.5).otherwise(0.0)).cast("float").alias("redshift"))
    return spectra.source_violations(own, cat, lum, shards_of(spark, d), samples=64).select("skypatch", "source_global_row")


@query("SELECT vec_id, round(a.embedding[1] * (1 + label / 10.0), 6) AS first_wave, len(embedding)::INTEGER AS n_waves FROM embeddings a")
def observed_wavelengths(spark: SparkSession, d: str) -> DataFrame:
    wide = arrays.observed_wavelengths(F.transform("embedding", lambda x: x.cast("double")), F.col("label") / 10.0)
    return table(spark, d, "embeddings").select("vec_id", F.round(F.get(wide, F.lit(0)), 6).alias("first_wave"), F.size(wide).alias("n_waves"))


@query("SELECT 0 AS patch, vec_id::INTEGER AS shard FROM embeddings WHERE label <> (SELECT label FROM embeddings ORDER BY vec_id LIMIT 1)")
def grid_violations(spark: SparkSession, d: str) -> DataFrame:
    grids = table(spark, d, "embeddings").select(F.lit(0).alias("patch"), F.col("vec_id").cast("int").alias("shard"), F.lit(3).alias("width"), F.array(F.lit(1.0), F.lit(2.0), F.col("label").cast("double")).alias("wave_rest"))
    return spectra.grid_violations(grids).select("patch", "shard")


# --- projections ----------------------------------------------------------


@query("SELECT vec_id, label, round(embedding[1]::DOUBLE, 6) AS mag_u, round(embedding[2]::DOUBLE, 6) AS mag_a_b_c, round(embedding[3]::DOUBLE, 6) AS mag_z FROM embeddings")
def band_expand(spark: SparkSession, d: str) -> DataFrame:
    found = projection.expand_bands(table(spark, d, "embeddings"), "embedding", ["u.txt", "a.b-c", "z"])
    return found.select("vec_id", "label", *[F.round(F.col(c).cast("double"), 6).alias(c) for c in ("mag_u", "mag_a_b_c", "mag_z")])


@query(r"SELECT page_id, translate(regexp_replace(url || CASE WHEN page_id % 2 = 0 THEN '.txt' ELSE '' END, '\.txt$', ''), '.-', '__') AS band FROM pages")
def band_sanitize(spark: SparkSession, d: str) -> DataFrame:
    name = F.concat("url", F.when(F.col("page_id") % 2 == 0, ".txt").otherwise(""))
    return table(spark, d, "pages").select("page_id", names.sanitized_band_column(name).alias("band"))


@query("SELECT p_partkey, b.i::INTEGER AS position, string_split(string_split(replace(p_name, ' ', ',') || ' ' || p_brand, ' ')[1], ',')[b.i + 1] AS band FROM part, range(0, 8) b(i) WHERE b.i < len(string_split(string_split(replace(p_name, ' ', ',') || ' ' || p_brand, ' ')[1], ','))")
def band_list(spark: SparkSession, d: str) -> DataFrame:
    text = F.concat_ws(" ", F.replace("p_name", F.lit(" "), F.lit(",")), "p_brand")
    return table(spark, d, "part").select("p_partkey", F.posexplode(names.listed_bands_column(text)).alias("position", "band"))


_RESOLVED = (("redshift", "lightcone_catalogs", "redshift", -1, 1), ("core_tag", "lightcone_catalogs", "core_tag", -1, None), ("M_ABS_SDSS_g", "luminosities", "M_ABS_SDSS", 0, 2), ("M_ABS_SDSS_r", "luminosities", "M_ABS_SDSS", 1, 3), ("L_BOL_LSUN", "luminosities", "L_BOL_LSUN", -1, 4), ("mag_u", "photometry", "survey", 0, 5), ("mag_a_b_c", "photometry", "survey", 1, 6))


@query(f"WITH {CATALOG_SQL} " + " UNION ALL ".join(f"SELECT '{n}' AS name, '{k}' AS kind, '{s}' AS dataset, {i}::INTEGER AS col_index, count(*) AS n_values, max({f'redshift * {m}' if m else 'core_tag'})::DOUBLE AS largest FROM cat" for n, k, s, i, m in _RESOLVED))
def column_resolution(spark: SparkSession, d: str) -> DataFrame:
    """The output columns that three sources resolve to, with what they hold once they are taken."""
    base = catalog_of(spark, d)
    z = lambda k: F.col("redshift") * k
    lum = base.select("skypatch", "redshift", F.array(z(2), z(3)).alias("M_ABS_SDSS"), z(4).alias("L_BOL_LSUN"))
    phot = base.select("skypatch", F.array(z(5), z(6)).alias("survey"))
    specs = projection.resolve_columns(base, lum, phot, {"_LUM_M_ABS_SDSS": ["g", "r"], "survey": ["u.txt", "a.b-c"]})
    out = None
    for kind, df in (("lightcone_catalogs", base), ("luminosities", lum), ("photometry", phot)):
        mine = [s for s in specs if s.kind == kind]
        told = projection.projected(df, mine, []).agg(*[f(s.name).alias(f"{s.name}_{n}") for s in mine for f, n in ((F.count, "n"), (F.max, "m"))])
        each = [F.struct(F.lit(s.name).alias("name"), F.lit(s.kind).alias("kind"), F.lit(s.dataset).alias("dataset"), F.lit(-1 if s.index is None else s.index).alias("col_index"), F.col(f"{s.name}_n").alias("n_values"), F.col(f"{s.name}_m").cast("double").alias("largest")) for s in mine]
        told = told.select(F.inline(F.array(*each)))
        out = told if out is None else out.unionByName(told)
    return out


@query("SELECT vec_id FROM embeddings WHERE len(embedding) <> 64 OR vec_id % 50 = 7")
def matrix_width_violations(spark: SparkSession, d: str) -> DataFrame:
    cut = table(spark, d, "embeddings").withColumn("embedding", F.when(F.col("vec_id") % 50 == 7, F.slice("embedding", 1, 10)).otherwise(F.col("embedding")))
    return projection.width_violations(cut, "embedding", 64).select("vec_id")


_KEYS_SQL = "keys AS (SELECT DISTINCT o_orderpriority AS grp, o_custkey::VARCHAR AS key FROM orders), fst AS (SELECT DISTINCT key FROM keys WHERE grp = (SELECT min(grp) FROM keys))"


@query(f"WITH {_KEYS_SQL} SELECT g.grp, fst.key, 'missing' AS side FROM (SELECT DISTINCT grp FROM keys) g, fst WHERE NOT EXISTS (SELECT 1 FROM keys k WHERE k.grp = g.grp AND k.key = fst.key) UNION ALL SELECT grp, key, 'extra' FROM keys WHERE key NOT IN (SELECT key FROM fst)")
def schema_symmetric_difference(spark: SparkSession, d: str) -> DataFrame:
    return projection.group_key_difference(table(spark, d, "orders").select(F.col("o_orderpriority").alias("grp"), F.col("o_custkey").cast("string").alias("key")))


def _advice_sql(columns: dict[str, str]) -> str:
    parts = []
    for c, kind in columns.items():
        if kind == "int":
            parts.append(f"SELECT '{c}' AS \"column\", (max({c}) - min({c}))::BIGINT AS spread, coalesce(max({c}) - min({c}) < 65536, false) AS compress FROM part")
        else:
            parts.append(f"SELECT '{c}', -1, false")
    return " UNION ALL ".join(parts)


@query(_advice_sql({"p_partkey": "int", "p_name": "", "p_brand": "", "p_type": "", "p_size": "int", "p_retailprice": ""}))
def int_spread_policy(spark: SparkSession, d: str) -> DataFrame:
    return storage.compress_advice(table(spark, d, "part")).withColumn("spread", F.coalesce("spread", F.lit(-1)))


_UNITS_SQL = {"ra": "'deg', NULL", "dec": "'deg', NULL", "core_tag": "NULL, 'Unique identifier of the galaxy core'", "skypatch": "NULL, 'Source skypatch identifier'", "redshift": "NULL, NULL", "mag_u": "'mag', NULL", "M_ABS_SDSS_g": "'mag', NULL", "mah_age_gyr": "'Gyr', NULL", "other_age_gyr": "'Gyr', NULL", "sfh": "'solMass / yr', NULL", "vx": "'km / s', 'x-component of the galaxy velocity'", "stellar_mass": "'solMass / littleh', 'Stellar mass of the galaxy'"}


@query("WITH n AS (SELECT count(*) AS n, count(CASE WHEN event_id % 3 = 0 THEN 1 END) AS few FROM events) SELECT \"column\", unit, description, CASE WHEN \"column\" = 'vx' THEN few ELSE n END AS n_values FROM n, (VALUES " + ", ".join(f"('{c}', {told})" for c, told in _UNITS_SQL.items()) + ") v(\"column\", unit, description)")
def unit_annotations(spark: SparkSession, d: str) -> DataFrame:
    """Units and descriptions of a published table's own columns, and how many values stand under them."""
    base = catalog_of(spark, d).select("core_tag", "skypatch", "redshift", *[F.col("redshift").alias(c) for c in _UNITS_SQL if c not in ("core_tag", "skypatch", "redshift", "vx")], F.when(F.col("core_tag") % 3 == 0, F.col("redshift")).alias("vx"))
    return meta.described(meta.annotated(base))


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def missing_keys(spark: SparkSession, d: str) -> DataFrame:
    return checks.missing_keys(table(spark, d, "documents"), table(spark, d, "labels"), "doc_id")


# --- checks ---------------------------------------------------------------


@query(_ENDS_SQL + " SELECT * FROM bad")
def endpoint_alignment(spark: SparkSession, d: str) -> DataFrame:
    return checks.endpoint_differences(rows.number_rows(catalog_of(spark, d)), _flat(spark, d)).select("skypatch", "core_group", "source_global_row")


@query(f"WITH {NUMBERED_SQL}, {_FLAT_SQL} SELECT num.skypatch, num.core_group, num.source_global_row FROM num JOIN flat USING (skypatch, source_global_row) WHERE num.redshift::FLOAT <> flat.redshift")
def full_alignment(spark: SparkSession, d: str) -> DataFrame:
    return checks.aligned_differences(rows.number_rows(catalog_of(spark, d)), _flat(spark, d)).select("skypatch", "core_group", "source_global_row")


@query(_ENDS_SQL + ", g AS (SELECT DISTINCT skypatch, core_group FROM num), b AS (SELECT DISTINCT skypatch, core_group FROM bad) SELECT g.skypatch, count(*) FILTER (b.core_group IS NULL) AS passed, count(*) FILTER (b.core_group IS NOT NULL) AS failed FROM g LEFT JOIN b USING (skypatch, core_group) GROUP BY 1")
def verify_report(spark: SparkSession, d: str) -> DataFrame:
    return checks.verify_report(rows.number_rows(catalog_of(spark, d)), _flat(spark, d))


@query("WITH f AS (SELECT DISTINCT o_custkey AS skypatch, CASE o_orderstatus WHEN 'O' THEN 'lightcone_catalogs' WHEN 'F' THEN 'luminosities' ELSE 'photometry' END AS kind FROM orders) SELECT p.skypatch, k.kind FROM (SELECT DISTINCT skypatch FROM f) p, (VALUES ('lightcone_catalogs'), ('luminosities'), ('photometry')) k(kind) WHERE NOT EXISTS (SELECT 1 FROM f WHERE f.skypatch = p.skypatch AND f.kind = k.kind)")
def patch_parity(spark: SparkSession, d: str) -> DataFrame:
    kind = F.when(F.col("o_orderstatus") == "O", "lightcone_catalogs").when(F.col("o_orderstatus") == "F", "luminosities").otherwise("photometry")
    found = table(spark, d, "orders").select(F.col("o_custkey").alias("skypatch"), kind.alias("kind"))
    return checks.missing_kinds(found, list(layout.KINDS))


@query("SELECT r.i AS skypatch FROM range(0, 8) r(i) EXCEPT SELECT user_id % 4 FROM events")
def patch_selection(spark: SparkSession, d: str) -> DataFrame:
    return checks.unavailable(spark.range(8).select(F.col("id").alias("skypatch")), catalog_of(spark, d))


@query("WITH c AS (SELECT (user_id % 4)::INTEGER AS skypatch, count(*) AS n_catalog FROM events GROUP BY 1), o AS (SELECT (o_custkey % 4)::INTEGER AS skypatch, count(*) AS n_other FROM orders GROUP BY 1) SELECT skypatch, n_catalog, n_other, 'photometry' AS kind FROM c FULL JOIN o USING (skypatch) WHERE n_catalog IS DISTINCT FROM n_other")
def row_count_parity(spark: SparkSession, d: str) -> DataFrame:
    cat = catalog_of(spark, d)
    other = table(spark, d, "orders").select((F.col("o_custkey") % 4).cast("int").alias("skypatch"))
    return checks.row_count_differences(cat, {"luminosities": cat, "photometry": other})


@query(f"WITH RECURSIVE {BINNED_SQL}, a AS (SELECT partition_index, count(*) AS n FROM binned GROUP BY 1), b AS (SELECT greatest(0, least({BINS - 1}, len(list_filter(es, lambda x: x <= ceil(redshift))) - 1))::INTEGER AS partition_index, count(*) AS n FROM cat, edges GROUP BY 1) SELECT partition_index, coalesce(a.n, 0) AS n_objects, coalesce(b.n, 0) AS n_written FROM a FULL JOIN b USING (partition_index) WHERE coalesce(a.n, 0) <> coalesce(b.n, 0)")
def written_vs_expected(spark: SparkSession, d: str) -> DataFrame:
    edges, cat = _edges(spark, d), catalog_of(spark, d)
    both = (cat, cat.withColumn("redshift", F.ceil("redshift").cast("double")))  # written from rounded keys
    a, b = (binning.assign_bins(x, "redshift", edges).groupBy("partition_index").agg(F.count(F.lit(1)).alias("n_objects")) for x in both)
    found = checks.count_differences(a, b, ["partition_index"])
    return found.select("partition_index", F.coalesce("n_objects", F.lit(0)).alias("n_objects"), F.coalesce("_other", F.lit(0)).alias("n_written"))


@query("WITH c AS (SELECT (user_id % 4)::INTEGER AS skypatch, count(*) AS n FROM events GROUP BY 1) SELECT skypatch, n AS n_catalog, n AS n_luminosities, n + CASE WHEN skypatch = 1 THEN 4 ELSE 0 END AS n_sed FROM c WHERE skypatch = 1")
def total_counts(spark: SparkSession, d: str) -> DataFrame:
    cat = catalog_of(spark, d)
    totals = cat.groupBy(F.col("skypatch").alias("patch")).agg(F.count(F.lit(1)).alias("n_global"))
    totals = totals.withColumn("n_global", F.col("n_global") + F.when(F.col("patch") == 1, 4).otherwise(0))
    return checks.total_differences(cat, cat, totals)


@query("SELECT event_id, (value - (value + (event_id % 5) * 4e-7::DOUBLE) <= 0 AND abs(value - (value + (event_id % 5) * 4e-7::DOUBLE)) <= 1e-6::DOUBLE AND event_id % 11 <> 0) AS near FROM events")
def near_redshift(spark: SparkSession, d: str) -> DataFrame:
    other = F.when(F.col("event_id") % 11 == 0, F.lit(float("nan"))).otherwise(F.col("value") + (F.col("event_id") % 5) * F.lit(4e-7))
    return table(spark, d, "events").select("event_id", numeric.is_close(F.col("value"), other, 1e-6).alias("near"))


@query(f"WITH {CATALOG_SQL} SELECT core_tag FROM cat WHERE core_tag % 13 IN (0, 1)")
def key_violations(spark: SparkSession, d: str) -> DataFrame:
    broken = F.when(F.col("core_tag") % 13 == 0, F.lit(float("nan"))).when(F.col("core_tag") % 13 == 1, F.lit(None)).otherwise(F.col("redshift"))
    return catalog_of(spark, d).where(~numeric.is_key(broken)).select("core_tag")


# --- headers --------------------------------------------------------------


@query(f"WITH RECURSIVE {BINNED_SQL}, t AS (SELECT b.i::INTEGER AS partition_index, b.i = 2 OR b.i = 5 AS skipped, es[b.i + 1] AS a, es[b.i + 2] AS b FROM edges, range(0, {BINS}) b(i)), m AS (SELECT partition_index, median(redshift) AS median FROM binned GROUP BY 1) SELECT t.partition_index, t.skipped, CASE WHEN skipped THEN NULL ELSE round(coalesce(median, 9.0), 6) END AS file_redshift, CASE WHEN skipped THEN -1 ELSE 10 + (row_number() OVER (PARTITION BY skipped ORDER BY t.partition_index)) - 1 END AS file_step, CASE WHEN skipped THEN 0.0::DOUBLE ELSE a END AS z_min, CASE WHEN skipped THEN 9.0::DOUBLE ELSE b END AS z_max, 'run-7' AS simulation FROM t LEFT JOIN m USING (partition_index)")
def header_specialise(spark: SparkSession, d: str) -> DataFrame:
    edges = _edges(spark, d)
    binned = binning.assign_bins(catalog_of(spark, d), "redshift", edges)
    counts = binning.bin_counts(binned, BINS)
    targets = counts.select("partition_index", (F.col("partition_index") == 2).alias("is_source"), (F.col("partition_index") == 5).alias("has_header"))
    donor = spark.range(1).select(F.lit(9.0).alias("file_redshift"), F.lit(0).cast("long").alias("file_step"), F.array(F.lit(0.0), F.lit(9.0)).alias("z_range"), F.lit("run-7").alias("simulation"))
    found = meta.specialised_headers(targets, donor, binned, meta.manifest(counts, edges, list(PATCHES)), first_step=10)
    return found.select("partition_index", "skipped", F.round("file_redshift", 6).alias("file_redshift"), F.coalesce("file_step", F.lit(-1)).alias("file_step"), F.get("z_range", F.lit(0)).alias("z_min"), F.get("z_range", F.lit(1)).alias("z_max"), "simulation")


def _donor(spark: SparkSession, d: str) -> DataFrame:
    """A header of two levels and more, from the events."""
    z = F.col("redshift")
    told = catalog_of(spark, d).agg(F.max(z).alias("z"), F.count(F.lit(1)).alias("n"), F.sort_array(F.collect_set("skypatch")).alias("patches"))
    return told.select(
        F.struct(F.round("z", 4).alias("redshift"), F.lit(7).cast("long").alias("step"), F.lit("run-7").alias("origin")).alias("file"),
        F.struct(F.array(F.lit(0.0), F.round("z", 4)).alias("z_range"), F.struct("patches", F.col("n").alias("rows")).alias("sources")).alias("lightcone"),
        F.struct(F.struct(F.struct(F.lit(0.31).alias("omega_m")).alias("matter")).alias("densities"), F.lit(None).cast("string").alias("note")).alias("cosmology"),
    )


_DONOR_SQL = f"""{CATALOG_SQL}, a AS (SELECT round(max(redshift), 4) AS z, count(*) AS n, '[' || string_agg(DISTINCT skypatch, ',' ORDER BY skypatch) || ']' AS p FROM cat),
tree AS (SELECT unnest([{{'path': 'file', 'kind': 'group', 'number': NULL, 'value': NULL}}, {{'path': 'file/redshift', 'kind': 'attribute', 'number': z, 'value': NULL}}, {{'path': 'file/step', 'kind': 'attribute', 'number': 7, 'value': NULL}},
  {{'path': 'file/origin', 'kind': 'attribute', 'number': NULL, 'value': 'run-7'}}, {{'path': 'lightcone', 'kind': 'group', 'number': NULL, 'value': NULL}}, {{'path': 'lightcone/z_range', 'kind': 'dataset', 'number': NULL, 'value': 'range'}},
  {{'path': 'lightcone/sources', 'kind': 'group', 'number': NULL, 'value': NULL}}, {{'path': 'lightcone/sources/patches', 'kind': 'dataset', 'number': NULL, 'value': p}}, {{'path': 'lightcone/sources/rows', 'kind': 'attribute', 'number': n, 'value': NULL}},
  {{'path': 'cosmology', 'kind': 'group', 'number': NULL, 'value': NULL}}, {{'path': 'cosmology/densities', 'kind': 'group', 'number': NULL, 'value': NULL}}, {{'path': 'cosmology/densities/matter', 'kind': 'group', 'number': NULL, 'value': NULL}},
  {{'path': 'cosmology/densities/matter/omega_m', 'kind': 'attribute', 'number': 0.31, 'value': NULL}}, {{'path': 'cosmology/note', 'kind': 'attribute', 'number': NULL, 'value': NULL}}], recursive := true) FROM a)"""


@query(f"WITH {_DONOR_SQL} SELECT count(*) FILTER (kind = 'group') AS n_groups, count(*) FILTER (kind = 'dataset') AS n_datasets, count(*) FILTER (kind = 'attribute') AS n_attributes FROM tree")
def header_census(spark: SparkSession, d: str) -> DataFrame:
    return tree.census(tree.rows_of(_donor(spark, d)))


@query(f"WITH RECURSIVE {_DONOR_SQL}, {EDGES_SQL}, binned AS (SELECT redshift, greatest(0, least({BINS - 1}, len(list_filter(es, lambda x: x <= redshift)) - 1))::INTEGER AS partition_index FROM cat, edges), m AS (SELECT partition_index, round(median(redshift), 6) AS median FROM binned GROUP BY 1), t AS (SELECT i::INTEGER AS partition_index, es[i + 1] AS a, es[i + 2] AS b, 10 + row_number() OVER (ORDER BY i) - 1 AS step FROM edges, range(0, {BINS}) r(i) WHERE i <> 2) SELECT t.partition_index, path, CASE path WHEN 'lightcone/z_range' THEN 'attribute' ELSE kind END AS kind, CASE path WHEN 'file/redshift' THEN coalesce(median, number) WHEN 'file/step' THEN step ELSE number END::DOUBLE AS number, CASE path WHEN 'lightcone/z_range' THEN printf('%.2f %.2f', a, b) ELSE value END AS value FROM t LEFT JOIN m USING (partition_index), tree")
def header_tree(spark: SparkSession, d: str) -> DataFrame:
    """A donor of four levels on every partition but one, with the fields that vary."""
    edges = _edges(spark, d)
    binned = binning.assign_bins(catalog_of(spark, d), "redshift", edges)
    counts = binning.bin_counts(binned, BINS)
    targets = counts.select("partition_index", F.lit(False).alias("is_source"), (F.col("partition_index") == 2).alias("has_header"))
    found = meta.specialised_headers(targets, _donor(spark, d), binned, meta.manifest(counts, edges, list(PATCHES)), first_step=10).where("not skipped")
    number = F.round(F.when((F.col("kind") == "attribute") & F.col("type").isin("double", "bigint", "int"), F.expr("try_cast(value AS double)")), 6)
    range_ = F.from_json("value", "array<double>")
    text = F.when(F.col("path") == "lightcone/z_range", F.format_string("%.2f %.2f", F.get(range_, F.lit(0)), F.get(range_, F.lit(1)))).when(number.isNull(), F.col("value"))
    return found.select("partition_index", "path", "kind", number.alias("number"), text.alias("value"))


@query("SELECT (user_id % 4)::INTEGER AS skypatch, (user_id % 13)::INTEGER AS grp, event_id, row_number() OVER (PARTITION BY user_id % 4 ORDER BY user_id % 13, event_id) - 1 AS place FROM events")
def stable_order(spark: SparkSession, d: str) -> DataFrame:
    found = table(spark, d, "events").select((F.col("user_id") % 4).cast("int").alias("skypatch"), (F.col("user_id") % 13).cast("int").alias("grp"), "event_id")
    return rows.with_place(found, ["skypatch"], ["grp"], "event_id", "place")
