"""Order by sky pixel, the multi-level index over it, and its use."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from skyloom.functions import healpix
from skyloom.operators.rows import bounded_broadcast, exclusive_sum

#: Levels above the finest by which starts are summed first, so that no window holds all pixels.
COARSER = 5
#: Rows of a partition whose rows of one pixel are sorted together.
PIXEL_BUCKET = 1 << 20


def with_pixel(df: DataFrame, level: int, ra: str = "ra", dec: str = "dec", name: str = "pixel") -> DataFrame:
    return healpix.add_pixel(df, ra, dec, level, name)


def pixel_counts(df: DataFrame, level: int, by: str = "partition_index") -> DataFrame:
    """Occupied pixels with their objects, at the finest level."""
    return df.groupBy(by, "pixel").agg(F.count(F.lit(1)).alias("size")).withColumn("level", F.lit(level))


def with_starts(counts: DataFrame, by: str = "partition_index") -> DataFrame:
    """Adds start, the objects in smaller pixels, in two phases: coarse pixels first, then inside each."""
    counts = counts.withColumn("_coarse", F.shiftright("pixel", 2 * COARSER))
    coarse = counts.groupBy(by, "level", "_coarse").agg(F.sum("size").alias("_n"))
    coarse = coarse.withColumn("_base", exclusive_sum(F.col("_n"), [by, "level"], ["_coarse"])).drop("_n")
    inside = exclusive_sum(F.col("size"), [by, "level", "_coarse"], ["pixel"])
    return counts.withColumn("_in", inside).join(coarse, [by, "level", "_coarse"]).withColumn("start", F.col("_base") + F.col("_in")).drop("_coarse", "_base", "_in")


def rolled_up(counts: DataFrame, level: int, by: str = "partition_index") -> DataFrame:
    """Counts of the finest pixels as counts of the pixels of every level."""
    levels = counts.drop("level").withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(level))))
    up = healpix.parent(F.col("pixel"), F.lit(level) - F.col("level"))
    return levels.groupBy(by, "level", up.alias("pixel")).agg(F.sum("size").alias("size"))


def sparse_index(df: DataFrame, level: int, by: str = "partition_index") -> DataFrame:
    """Occupied pixels of every level with start and size; one pass over the finest counts rolls them all up by shifts."""
    rolled = rolled_up(pixel_counts(df, level, by), level, by)
    return with_starts(rolled, by).select(by, "level", "pixel", "start", F.col("size").cast("long").alias("size"))


def dense_index(sparse: DataFrame, level: int, by: str = "partition_index") -> DataFrame:
    """One level with every pixel; empty ones have size 0 and the start where they would go.

    A pixel's start is all before it; windows run over coarse pixels only, so
    even the finest level's 805 million pixels spread over tasks.
    """
    groups = bounded_broadcast(sparse.select(by).distinct())
    every = sparse.sparkSession.range(healpix.pixel_count(level)).withColumnRenamed("id", "pixel").crossJoin(groups)
    own = sparse.where(F.col("level") == level).select(by, "pixel", "size")
    filled = every.join(own, [by, "pixel"], "left").select(by, "pixel", F.coalesce("size", F.lit(0)).cast("long").alias("size")).withColumn("level", F.lit(level))
    return with_starts(filled, by).select(by, "level", "pixel", "start", "size")


def occupancy(dense_or_sparse: DataFrame, level: int, by: str = "partition_index") -> DataFrame:
    """Occupied and all pixels, least, most and mean objects of an occupied one."""
    filled = dense_or_sparse.where((F.col("level") == level) & (F.col("size") > 0))
    return filled.groupBy(by).agg(
        F.count(F.lit(1)).alias("n_filled"),
        F.lit(healpix.pixel_count(level)).cast("long").alias("n_pixels"),
        F.min("size").alias("size_min"),
        F.max("size").alias("size_max"),
        F.avg("size").alias("size_mean"),
    )


def level_summary(index: DataFrame) -> DataFrame:
    """Side, pixels and resolution of each level of an index, and what the index holds of it."""
    found = index.groupBy("level").agg(F.count(F.lit(1)).alias("n_entries"), F.sum("size").alias("n_objects"))
    return found.select("level", *[c.alias(n) for n, c in healpix.level_columns(F.col("level")).items()], "n_entries", "n_objects")


def ordered_rows(df: DataFrame, by: str = "partition_index", row: str = "input_row", bucket_rows: int = PIXEL_BUCKET) -> DataFrame:
    """Adds output_row: the place in its partition after the stable sort by pixel.

    The start of a row's pixel, the rows before its bucket and its rank in the
    bucket; all go by (partition, pixel, bucket), so rows move once, and a
    pixel that holds most of a partition is sorted in parts.
    """
    keys = [by, "pixel", "_bucket"]
    placed = df.withColumn("_bucket", F.floor(F.col(row) / F.lit(bucket_rows)).cast("long"))
    counts = placed.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    before = counts.withColumn("_before", exclusive_sum(F.col("_n"), [by, "pixel"], ["_bucket"]))
    pixels = counts.groupBy(by, "pixel").agg(F.sum("_n").alias("size")).withColumn("level", F.lit(0))
    starts = before.join(with_starts(pixels, by).select(by, "pixel", "start"), [by, "pixel"]).select(*keys, (F.col("start") + F.col("_before")).alias("_start"))
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(row))
    return placed.withColumn("_rank", rank).join(starts, keys).withColumn("output_row", (F.col("_start") + F.col("_rank") - 1).cast("long")).drop("_rank", "_start", "_bucket")


def in_file_order(df: DataFrame, sizes: dict[int, int], by: str = "partition_index", row: str = "output_row", files: int | None = None) -> DataFrame:
    """Ranges of (partition, row), each sorted: files of equally many rows with narrow pixel ranges.

    sizes: rows of each partition, whose rows are numbered 0, 1, ... in ``row``.
    They tell each row's file, so no pass samples the rows and each is computed
    once.  files: how many to aim at (spark.sql.shuffle.partitions by default);
    every partition has at least one.
    """
    files = files or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    most = max(1, -(-sum(sizes.values()) // files))
    first, total = [0] * (max(sizes, default=-1) + 1), 0
    for part in sorted(sizes):
        first[part] = total
        total += max(1, -(-sizes[part] // most))
    at = F.get(F.array(*[F.lit(f) for f in first]).cast("array<int>"), F.col(by)) + F.floor(F.col(row) / most).cast("int")
    return df.repartitionById(max(1, total), at).sortWithinPartitions(by, row)


def provenance(ordered: DataFrame, by: str = "partition_index", row: str = "input_row") -> DataFrame:
    """The stored permutation: the input row of each output row."""
    return ordered.select(by, "output_row", F.col(row).alias("input_row"))


def in_region(pix: Column, region: int, level: int, at: int) -> Column:
    """Rows of a coarser pixel as a range, which prunes sorted files (enabled by the layout, an extension)."""
    low, high = healpix.range_of(region, level, at)
    return pix.between(low, high)
