"""Alignment checks: each gives a table of violations, empty if all is well."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from skyloom.errors import LayoutError
from skyloom.functions.names import number_in
from skyloom.functions.numeric import same_in_single_precision
from skyloom.operators.rows import bounded_broadcast, few_of
from skyloom.operators.spectra import coverage


def require_none(violations: DataFrame, message: str, shown: int = 5) -> None:
    rows = violations.limit(shown).collect()
    if rows:
        raise LayoutError(f"{message}: " + "; ".join(str(r.asDict()) for r in rows))


def require(checks: Iterable[tuple[str, DataFrame]]) -> None:
    """All checks, then one error that names each that failed."""
    failed = [f"{message}: {rows[0].asDict()}" for message, violations in checks if (rows := violations.limit(1).collect())]
    if failed:
        raise LayoutError("; ".join(failed))


def missing_kinds(found: DataFrame, kinds: list[str]) -> DataFrame:
    """(skypatch, kind) pairs without a source, from rows (skypatch, kind)."""
    patches = found.select("skypatch").distinct()
    every = patches.withColumn("kind", F.explode(F.array(*[F.lit(k) for k in kinds])))
    return every.join(found.select("skypatch", "kind").distinct(), ["skypatch", "kind"], "left_anti")


def unavailable(requested: DataFrame, available: DataFrame) -> DataFrame:
    """Requested patches that are not there."""
    return requested.select(F.col("skypatch").cast("long")).subtract(available.select(F.col("skypatch").cast("long")))


def missing_keys(wanted: DataFrame, present: DataFrame, key: str) -> DataFrame:
    """Keys of a table that the other lacks."""
    return wanted.select(key).join(present.select(key), key, "left_anti")


def empty_patches(catalog: DataFrame, patches: list[int]) -> DataFrame:
    """Patches that hold no rows."""
    wanted = catalog.sparkSession.createDataFrame([(int(p),) for p in patches], "skypatch int")
    return wanted.join(catalog.select("skypatch").distinct(), "skypatch", "left_anti")


def row_count_differences(catalog: DataFrame, others: dict[str, DataFrame]) -> DataFrame:
    """Patches whose sources have other numbers of rows than the catalogue."""
    counts = catalog.groupBy("skypatch").agg(F.count(F.lit(1)).alias("n_catalog"))
    out = None
    for kind, df in others.items():
        own = df.groupBy("skypatch").agg(F.count(F.lit(1)).alias("n_other"))
        bad = counts.join(own, "skypatch", "full").where("not (n_catalog <=> n_other)").withColumn("kind", F.lit(kind))
        out = bad if out is None else out.unionByName(bad)
    return out


def endpoint_differences(catalog: DataFrame, flat: DataFrame, key: str = "redshift") -> DataFrame:
    """Groups whose first or last row differs from the flat source, compared in its single precision."""
    ends = catalog.groupBy("skypatch", "core_group").agg(F.min("source_global_row").alias("a"), F.max("source_global_row").alias("b"))
    ends = ends.select("skypatch", "core_group", F.explode(F.array_distinct(F.array("a", "b"))).alias("source_global_row"))
    keys = ["skypatch", "source_global_row"]
    ends = bounded_broadcast(ends)
    few = bounded_broadcast(catalog.drop("core_group").join(ends, keys))
    return aligned_differences(few, few_of(flat.select(*keys, key), ends, keys), key)


def aligned_differences(catalog: DataFrame, flat: DataFrame, key: str = "redshift") -> DataFrame:
    """The full check: every row (of what is given) whose key differs."""
    own = flat.select("skypatch", "source_global_row", F.col(key).alias("_flat"))
    same = same_in_single_precision(F.col(key), F.col("_flat"))
    return catalog.join(own, ["skypatch", "source_global_row"], "left").where(~F.coalesce(same, F.lit(False)))


def verify_report(catalog: DataFrame, flat: DataFrame, key: str = "redshift") -> DataFrame:
    """Groups passed and failed at their endpoints, in each patch."""
    groups = catalog.select("skypatch", "core_group").distinct()
    bad = endpoint_differences(catalog, flat, key).select("skypatch", "core_group").distinct().withColumn("bad", F.lit(True))
    return groups.join(bad, ["skypatch", "core_group"], "left").groupBy("skypatch").agg(F.count_if(F.col("bad").isNull()).alias("passed"), F.count_if(F.col("bad").isNotNull()).alias("failed"))


def shard_metadata_violations(shards: DataFrame) -> DataFrame:
    """Shards (patch, shard, nshards, row_offset, n_rows, n_global, width, complete, name) with a reason."""
    named = lambda i: number_in(r"seds_skypatch_(\d+)\.shard(\d+)of(\d+)", F.col("name"), i)
    lacking = F.greatest(*[F.col(c).isNull() for c in ("shard", "nshards", "row_offset", "n_global", "complete")])
    reason = (
        F.when(lacking, "an attribute is missing")
        .when(~F.col("complete"), "not complete")
        .when(~F.coalesce((named(1) == F.col("patch")) & (named(2) == F.col("shard")) & (named(3) == F.col("nshards")), F.lit(False)), "name and metadata disagree")
    )
    return shards.withColumn("reason", reason).where("reason is not null")


def shard_set_violations(shards: DataFrame) -> DataFrame:
    """Patches whose shards aren't exactly 0 to nshards - 1 with one nshards, n_global and width."""
    sets = shards.groupBy("patch").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_distinct("shard").alias("n_distinct"),
        F.min("shard").alias("low"),
        F.max("shard").alias("high"),
        F.max("nshards").alias("nshards"),
        F.count_distinct("nshards", "n_global", "width").alias("n_kinds"),
    )
    return sets.where("n <> nshards or n_distinct <> n or low <> 0 or high <> nshards - 1 or n_kinds <> 1")


def shard_range_violations(shards: DataFrame) -> DataFrame:
    """Patches whose ranges aren't contiguous from 0 to n_global."""
    covered = coverage(shards).groupBy("patch").agg(F.count_if(F.col("row_offset") != F.col("expected_offset")).alias("n_gaps"), F.sum("n_rows").alias("n_covered"), F.max("n_global").alias("n_global"))
    return covered.where("n_gaps > 0 or n_covered <> n_global")


def shard_row_violations(rows: DataFrame, shards: DataFrame) -> DataFrame:
    """Shards whose rows (patch, shard, local_row) aren't exactly the declared 0 to n_rows - 1; only keys are read."""
    each = rows.groupBy("patch", "shard", "local_row").agg(F.count(F.lit(1)).alias("_n"))
    counted = each.groupBy("patch", "shard").agg(F.sum("_n").alias("n_counted"), F.count("local_row").alias("n_distinct"), F.min("local_row").alias("low"), F.max("local_row").alias("high"))
    both = shards.select("patch", "shard", "n_rows").join(counted, ["patch", "shard"], "full")
    right = "n_rows is not null and coalesce(n_counted, 0) = n_rows and (n_rows = 0 or n_distinct = n_rows and low = 0 and high = n_rows - 1)"
    return both.where(f"not ({right})")


def count_differences(a: DataFrame, b: DataFrame, keys: list[str], value: str = "n_objects") -> DataFrame:
    """Keys whose counts differ, a missing one being 0: two passes, or expected and written."""
    right = b.select(*keys, F.col(value).alias("_other"))
    return a.join(right, keys, "full").where(F.coalesce(value, F.lit(0)) != F.coalesce("_other", F.lit(0)))


def total_differences(catalog: DataFrame, luminosities: DataFrame, shards: DataFrame) -> DataFrame:
    """Patches where catalogue, luminosities and the spectra's declared total disagree."""
    n = lambda df, name: df.groupBy("skypatch").agg(F.count(F.lit(1)).alias(name))
    declared = shards.groupBy(F.col("patch").alias("skypatch")).agg(F.max("n_global").alias("n_sed"))
    joined = n(catalog, "n_catalog").join(n(luminosities, "n_luminosities"), "skypatch", "full").join(declared, "skypatch", "full")
    return joined.where("not (n_catalog <=> n_luminosities and n_catalog <=> n_sed)")


def require_columns(df: DataFrame, columns: Iterable[str], what: str) -> None:
    if lost := [c for c in columns if c not in df.columns]:
        raise LayoutError(f"{what} lacks {lost}")


def require_appendable(df: DataFrame, manifest: DataFrame | None = None, overwrite: bool = False) -> None:
    """Before spectra are appended: provenance is there, and no complete spectra, unless they are to be replaced.

    The manifest's status decides; where it records none, spectra among the data are complete ones.
    """
    require_columns(df, ("skypatch", "source_global_row"), "the catalogue")
    told = manifest is not None and "sed_append_complete" in manifest.columns
    complete = manifest.where("sed_append_complete").limit(1).count() > 0 if told else "SED" in df.columns
    if complete and not overwrite:
        raise LayoutError("the catalogue has spectra already")
    if "wave_rest" in df.columns:
        raise LayoutError("the catalogue has a wavelength grid as a column (an old layout)")


def adjacent_duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows equal to the one before them in the order of the keys."""
    order = Window.partitionBy(keys[0]).orderBy(*keys[1:])
    return df.withColumn("_before", F.lag(F.struct(*keys)).over(order)).where(F.col("_before") == F.struct(*keys)).drop("_before")
