"""Wide spectra in shards: discovery table, coverage, gather join and identity checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from skyloom.errors import LayoutError
from skyloom.functions.arrays import equal_arrays
from skyloom.functions.numeric import is_close
from skyloom.operators.rows import bounded_broadcast, few_of, interval_join, sample_rows

FINAL_TOLERANCE, CATALOG_TOLERANCE, FLAT_TOLERANCE = 1e-6, 1e-10, 1e-6
SAMPLES = 16


def shard_of_rows(rows: DataFrame, shards: DataFrame, row: str = "source_global_row") -> DataFrame:
    """Interval lookup: the shard whose range holds each row, with the row inside it."""
    start = F.col("row_offset")
    spans = shards.select(F.col("patch").alias("skypatch"), "shard", start, start.alias("_low"), (start + F.col("n_rows")).alias("_high"))
    met = interval_join(rows, spans, row, ["skypatch"], "_low", "_high")
    return met.select(*rows.columns, "shard", (F.col(row) - start).alias("local_row"))


def concatenated(spectra: DataFrame, shards: DataFrame) -> DataFrame:
    """Shard rows at their global rows: row_offset + local_row."""
    offsets = bounded_broadcast(shards.select("patch", "shard", "row_offset"))
    return spectra.join(offsets, ["patch", "shard"]).withColumn("source_global_row", F.col("row_offset") + F.col("local_row")).drop("row_offset").withColumnRenamed("patch", "skypatch")


def require_datasets(spectra: DataFrame) -> None:
    """Raises unless shard rows have an array SED, core_tag, redshift and their row."""
    kinds = dict(spectra.dtypes)
    if lost := [c for c in ("SED", "core_tag", "redshift", "local_row") if c not in kinds]:
        raise LayoutError(f"spectra lack {lost}")
    if not kinds["SED"].startswith("array<"):
        raise LayoutError(f"SED is {kinds['SED']}, not an array")


def checked_rows(spectra: DataFrame, shards: DataFrame) -> DataFrame:
    """Shard rows whose SED, when it is read, must be as wide as declared; so no pass of its own reads all spectra."""
    widths = bounded_broadcast(shards.select("patch", "shard", F.col("width").alias("_width")))
    said = F.format_string("the spectrum of patch %d, shard %d, row %d is not %d wide", "patch", "shard", "local_row", "_width")
    whole = F.when(F.size("SED") == F.col("_width"), F.col("SED")).otherwise(F.raise_error(said))
    return spectra.join(widths, ["patch", "shard"]).withColumn("SED", whole).drop("_width")


def coverage(shards: DataFrame) -> DataFrame:
    """Every shard with the offset that contiguous ranges would give it."""
    before = Window.partitionBy("patch").orderBy("row_offset", "shard").rowsBetween(Window.unboundedPreceding, -1)
    return shards.withColumn("expected_offset", F.coalesce(F.sum("n_rows").over(before), F.lit(0)).cast("long"))


def gathered(final: DataFrame, spectra: DataFrame, row: str = "source_global_row") -> DataFrame:
    """final with its SED (NULL where missing): one sort-merge join by (skypatch, row), spectra read once."""
    wide = spectra.select("skypatch", F.col("source_global_row").alias(row), "SED")
    return final.join(wide.hint("merge"), ["skypatch", row], "left")


def with_aligned(data: DataFrame, wide: DataFrame) -> DataFrame:
    """data with the SED of the table of spectra, which has the same places."""
    keys = ["partition_index", "output_row" if "output_row" in wide.columns else "input_row"]
    return data.join(wide.select(*keys, "SED"), keys)


def missing_spectra(final: DataFrame, spectra: DataFrame, row: str = "source_global_row") -> DataFrame:
    """Final rows without a spectrum; only keys are read."""
    return final.join(spectra.select("skypatch", F.col("source_global_row").alias(row)), ["skypatch", row], "left_anti")


def duplicate_references(final: DataFrame, row: str = "source_global_row") -> DataFrame:
    """Source rows that more than one final row names."""
    return final.groupBy("skypatch", row).agg(F.count(F.lit(1)).alias("n_references")).where("n_references > 1")


def out_of_range(final: DataFrame, shards: DataFrame, row: str = "source_global_row") -> DataFrame:
    """Final rows of an unknown patch or outside [0, n_global)."""
    totals = bounded_broadcast(shards.groupBy(F.col("patch").alias("skypatch")).agg(F.max("n_global").alias("n_global")))
    return final.join(totals, "skypatch", "left").where(f"n_global is null or {row} < 0 or {row} >= n_global").select(*final.columns)


def identity_violations(final: DataFrame, spectra: DataFrame, samples: int = SAMPLES, by: str = "partition_index") -> DataFrame:
    """Evenly sampled final rows whose tag or redshift differs from the spectrum's (needs output_row)."""
    sizes = final.groupBy(by).agg(F.count(F.lit(1)).alias("n_rows"))
    picked = sample_rows(sizes, samples).select(by, F.col("sample_row").alias("output_row"))
    keys = ["skypatch", "source_global_row"]
    rows = bounded_broadcast(final.join(bounded_broadcast(picked), [by, "output_row"], "left_semi"))
    source = few_of(spectra.select(*keys, F.col("core_tag").alias("sed_tag"), F.col("redshift").alias("sed_redshift")), rows, keys)
    same = (F.col("core_tag") == F.col("sed_tag")) & is_close(F.col("redshift"), F.col("sed_redshift"), FINAL_TOLERANCE)
    return rows.join(source, keys, "left").where(~F.coalesce(same, F.lit(False)))


def source_violations(spectra: DataFrame, catalog: DataFrame, luminosities: DataFrame, shards: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """Sampled shard rows whose tag differs from the catalogue's, or whose redshift from either source's."""
    picked = sample_rows(shards.select("patch", "row_offset", "n_rows"), samples)
    picked = picked.select(F.col("patch").alias("skypatch"), (F.col("row_offset") + F.col("sample_row")).alias("source_global_row"))
    keys = ["skypatch", "source_global_row"]
    picked = bounded_broadcast(picked)
    rows = bounded_broadcast(few_of(spectra.select(*keys, "core_tag", "redshift"), picked, keys))
    cat = few_of(catalog.select(*keys, F.col("core_tag").alias("cat_tag"), F.col("redshift").alias("cat_redshift")), picked, keys)
    lum = few_of(luminosities.select(*keys, F.col("redshift").alias("lum_redshift")), picked, keys)
    same = (
        (F.col("core_tag") == F.col("cat_tag"))
        & is_close(F.col("redshift"), F.col("cat_redshift"), CATALOG_TOLERANCE)
        & is_close(F.col("redshift").cast("double"), F.col("lum_redshift").cast("double"), FLAT_TOLERANCE)
    )
    return rows.join(cat, keys, "left").join(lum, keys, "left").where(~F.coalesce(same, F.lit(False)))


def grid_width_violations(grids: DataFrame) -> DataFrame:
    """Shards (patch, shard, width, wave_rest) without a grid, or with one of another length than the width."""
    return grids.where("wave_rest is null or width is null or size(wave_rest) <> width")


def grid_violations(grids: DataFrame) -> DataFrame:
    """Shards (patch, shard, width, wave_rest) whose width or grid differs from the first shard's; all are checked."""
    first = grids.orderBy("patch", "shard").limit(1).select(F.col("wave_rest").alias("_grid"), F.col("width").alias("_width"))
    return grids.join(F.broadcast(first)).where(~(equal_arrays(F.col("wave_rest"), F.col("_grid")) & (F.col("width") == F.col("_width")))).drop("_grid", "_width")
