"""The whole run: number, bin, order, join the payload once, append spectra, publish.

Numbering, bins, pixels and places are worked out on a few narrow columns and
staged.  The payload of the three sources is then shuffled once to its
positional join and once to its files; checks, provenance, index and medians
come from the staged places.
"""

from __future__ import annotations

import functools
import posixpath
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyloom.errors import LayoutError
from skyloom.functions import healpix
from skyloom.operators import binning, checks, fingerprint, meta, projection, regions, rows, spatial, spectra, storage, tree
from skyloom.sources import layout, snapshots, staged

KEY = "redshift"
KEYS = ["skypatch", "source_global_row"]
#: The tables of a published catalogue.
TABLES = ("data", "index", "provenance", "manifest", "header", "axes", "spectra")
_PLACE = ("partition_index", "input_row", "pixel", "output_row")
_NARROW = ("skypatch", "core_group", "row_in_group", KEY, "ra", "dec", "core_tag")
SOURCE_NOTE = "raw spectrum shards"


@dataclass
class Storage:
    """How tables are written: codec and level of the catalogue and of spectra, bytes of a page, rows of a page of spectra."""

    codec: str = "blosc"
    level: int = 5
    chunk_bytes: int = 1 << 20
    sed_codec: str = "blosc-lz4"
    sed_level: int = 5
    sed_rows: int = storage.SPECTRUM_ROWS

    def options(self, df: DataFrame) -> dict[str, str]:
        if "SED" in df.columns:  # a table of spectra: pages of as many rows as asked, also in its few narrow columns
            return storage.writer_options(self.sed_codec, self.sed_level, self.chunk_bytes, self.sed_rows)
        return storage.writer_options(self.codec, self.level, self.chunk_bytes)


def numbered_sources(catalog: DataFrame, luminosities: DataFrame, photometry: DataFrame, patches: list[int]) -> DataFrame:
    """The catalogue's narrow columns with the global row, after checks that no source is empty and all have as many rows."""
    checks.require(
        [
            ("patches without rows", checks.empty_patches(catalog, patches)),
            ("row counts differ", checks.row_count_differences(catalog, {"luminosities": luminosities, "photometry": photometry})),
        ]
    )
    return rows.number_rows(narrow(catalog))


def narrow(catalog: DataFrame) -> DataFrame:
    return catalog.select(*[c for c in _NARROW if c in catalog.columns])


def checked_specs(numbered: DataFrame, catalog: DataFrame, luminosities: DataFrame, photometry: DataFrame, bands: dict[str, list[str]]) -> list[projection.ColumnSpec]:
    """The output columns, after the checks that numbered sources are aligned and matrices as wide as their bands.

    Matrices that name their bands themselves (see projection.bands_listed) need no list for them.
    """
    if KEY in luminosities.columns:
        checks.require([("sources are misaligned", checks.endpoint_differences(numbered, luminosities, KEY))])
    listed = projection.bands_listed(luminosities) | projection.bands_listed(photometry)
    specs = projection.resolve_columns(catalog, luminosities, photometry, bands, listed)
    sources = {"luminosities": luminosities, "photometry": photometry}
    checks.require((f"{d} is not {w} wide", projection.width_violations(sources[k], d, w)) for (k, d), w in projection.matrix_widths(specs).items())
    return specs


def placed(numbered: DataFrame, edges: list[float]) -> DataFrame:
    """Adds partition_index and input_row, the place in the partition by patch and row."""
    return rows.with_place(binning.assign_bins(numbered, KEY, edges), ["partition_index"], ["skypatch"], "source_global_row")


def in_pixel_order(places: DataFrame, level: int) -> DataFrame:
    """Adds pixel and output_row, the place in the partition by pixel and input_row."""
    checks.require_columns(places, ("ra", "dec"), "the data")
    return spatial.ordered_rows(spatial.with_pixel(places, healpix.checked_level(level)))


def payload(catalog: DataFrame, luminosities: DataFrame, photometry: DataFrame, specs: list[projection.ColumnSpec], places: DataFrame, offsets: DataFrame | None = None, proof: fingerprint.Proof | None = None) -> DataFrame:
    """All output columns at their places, by one join on (skypatch, source_global_row); a proof watches each source.

    offsets (see rows.dense_offsets) give the catalogue its rows without a
    shuffle; without them it meets its places by (skypatch, core_group, row_in_group).
    """
    if "source_global_row" in catalog.columns:  # staged
        numbered = catalog
    elif offsets is not None:
        numbered = catalog.join(offsets, ["skypatch", "core_group"]).withColumn("source_global_row", F.col("row_offset") + F.col("row_in_group"))
    else:
        keys = ["skypatch", "core_group", "row_in_group"]
        numbered = catalog.join(places.select(*keys, "source_global_row"), keys)
    own = {"lightcone_catalogs": numbered, "luminosities": luminosities, "photometry": photometry}
    parts = []
    for kind, df in own.items():
        mine = [s for s in specs if s.kind == kind]
        part = projection.projected(df, mine, [*KEYS, "core_group"] if kind == "lightcone_catalogs" else KEYS)
        parts.append(proof.source(kind, part, [c for c in part.columns if c != "core_group"]) if proof else part)
    where = [c for c in _PLACE if c in places.columns]
    return rows.with_provenance(rows.positional_join(*parts, places.select(*KEYS, *where))).drop("core_group")


def shard_checks(rows: DataFrame, shards: DataFrame, grids: DataFrame) -> list[tuple[str, DataFrame]]:
    """What must hold for shards whatever refers to them; rows: patch, shard and local_row of their spectra."""
    return [
        ("shard metadata", checks.shard_metadata_violations(shards)),
        ("shard sets", checks.shard_set_violations(shards)),
        ("shard ranges", checks.shard_range_violations(shards)),
        ("shard rows differ from those declared", checks.shard_row_violations(rows, shards)),
        ("wavelength grids and widths differ", spectra.grid_width_violations(grids)),
        ("wavelength grids disagree", spectra.grid_violations(grids)),
    ]


def require_same_objects(source: DataFrame, catalog: DataFrame, luminosities: DataFrame, shards: DataFrame, samples: int = spectra.SAMPLES) -> None:
    """Counts of catalogue, luminosities and spectra agree, and so do sampled tags and redshifts of all three (samples = 0: counts only)."""
    checks.require([("row counts differ", checks.total_differences(catalog, luminosities, shards))])
    if samples:
        checks.require_columns(source, ("core_tag", KEY), "the table of spectra")
        checks.require_columns(catalog, ("core_tag", KEY), "the catalogue")
        checks.require_columns(luminosities, (KEY,), "the table of luminosities")
        checks.require([("spectra are misaligned", spectra.source_violations(source, catalog, luminosities, shards, samples))])


def spectra_of(spark: SparkSession, root: str, patches: list[int] | int | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Shard table, grids, and all spectra at their global rows, of the width that is declared."""
    shards = shard_table(spark, root, patches)
    read = read_shards(spark, root, patches)
    return shards, shard_grids(spark, root, shards), spectra.concatenated(spectra.checked_rows(read, shards), shards)


def appended_spectra(places: DataFrame, source: DataFrame, shards: DataFrame, samples: int = spectra.SAMPLES, *, grids: DataFrame, row: str = "output_row") -> tuple[DataFrame, fingerprint.Proof]:
    """The spectrum of every row of ``places``, at its place, after all reference checks; and the proof that each has one.

    Of the final rows only keys and places move, not their payload.
    """
    refs = places.select(*KEYS)
    checks.require(
        [
            *shard_checks(source.select(F.col("skypatch").alias("patch"), "shard", "local_row"), shards, grids),
            ("rows outside the spectra", spectra.out_of_range(refs, shards)),
            ("rows named twice", spectra.duplicate_references(refs)),
            ("rows without a spectrum", spectra.missing_spectra(refs, source)),
        ]
    )
    if {"core_tag", KEY, "output_row"} <= set(places.columns) and {"core_tag", KEY} <= set(source.columns):
        checks.require([("identities differ", spectra.identity_violations(places, source, samples))])
    else:
        print("identities of the spectra were not compared: core_tag, redshift or output_row is missing")
    own = places.select("partition_index", row, *KEYS)
    proof = fingerprint.Proof()
    proof.expect("the catalogue", own, own.columns)
    if own.count() == shards.agg(F.sum("n_rows")).first()[0]:  # all spectra are wanted, so all must arrive
        source = proof.source("the spectra", source, [*KEYS, "SED"])
    wide = spectra.gathered(own, source)
    said = F.format_string("row %d of patch %d has no spectrum", "source_global_row", "skypatch")
    return wide.withColumn("SED", F.coalesce("SED", F.raise_error(said))), proof


def companions(spark: SparkSession, root: layout.Root, patches: list[int], required: bool) -> tuple[DataFrame, DataFrame] | None:
    """Numbered catalogue and luminosities of the patches, beside the spectra or in a raw root; None if there are none and none are required."""
    kinds = ("lightcone_catalogs", "luminosities")
    if not required and not any(layout.exists(spark, path) for p in patches for k in kinds for path in layout.companion_paths(root, p, k)):
        return None
    found = []
    for kind in kinds:
        parts = [spark.read.parquet(layout.companion_path(spark, root, p, kind)).withColumn("skypatch", F.lit(int(p))) for p in patches]
        found.append(functools.reduce(DataFrame.unionByName, parts))
    return rows.number_rows(narrow(found[0])), found[1]


def verified_shards(spark: SparkSession, root: str, patches: list[int] | int | None = None, raw_root: layout.Root | None = None, samples: int = spectra.SAMPLES) -> DataFrame:
    """The shard table, after all checks of the shards and of the catalogue and luminosities.

    These are sought in raw_root, and then must be there, else beside the
    spectra; if there are none, that is printed.
    """
    shards = shard_table(spark, root, patches)
    read = read_shards(spark, root, patches)
    checks.require(shard_checks(read, shards, shard_grids(spark, root, shards)))
    chosen = sorted({n[1] for n in layout.shard_names(spark, root, patches)})
    found = companions(spark, root if raw_root is None else raw_root, chosen, raw_root is not None)
    if found is None:
        print(f"no catalogue and luminosities beside the spectra of {chosen}: neither counts nor identities were compared")
    else:
        require_same_objects(spectra.concatenated(read, shards), *found, shards, samples)
    return shards


def converted_spectra(
    spark: SparkSession, root: str, out: str, patches: list[int] | int | None = None, overwrite: bool = False, raw_root: layout.Root | None = None, samples: int = spectra.SAMPLES, how: Storage | None = None
) -> list[str]:
    """One table a patch from its shards, rows in global order, and its attributes with the wavelength grid beside it.

    An earlier good table stays until the new one is whole.
    """
    how = how or Storage(sed_codec="blosc")
    verified_shards(spark, root, patches, raw_root, samples)
    chosen = sorted({n[1] for n in layout.shard_names(spark, root, patches)})
    targets = {p: (posixpath.join(out, f"seds_skypatch_{p}.parquet"), posixpath.join(out, f"seds_skypatch_{p}.attributes.parquet")) for p in chosen}
    if not overwrite and (there := [t for pair in targets.values() for t in pair if layout.exists(spark, t)]):
        raise LayoutError(f"{there} exist")
    shards, grids, found = spectra_of(spark, root, chosen)
    sizes = {int(p): int(n) for p, n in shards.groupBy("patch").agg(F.max("n_global")).collect()}
    ordered = spatial.in_file_order(meta.annotated(found), sizes, by="skypatch", row="source_global_row")
    grid = grids.orderBy("patch", "shard").limit(1).select("wave_rest").withMetadata("wave_rest", meta.WAVELENGTH_METADATA)
    told = shards.groupBy(F.col("patch").alias("skypatch")).agg(F.max("n_global").alias("n_objects")).crossJoin(F.broadcast(grid)).withColumn("source_row_order", F.lit("producer global flat row order"))  # one row
    with _partial(spark, posixpath.join(out, "seds")) as partial:  # all patches by one job each, then each in its place
        for name, df, options in (("spectra", ordered.withColumn("_patch", F.col("skypatch")), how.options(ordered)), ("attributes", told.withColumn("_patch", F.col("skypatch")), None)):
            _written(df, posixpath.join(partial, name), ("_patch",), options)
        for p, pair in targets.items():
            for name, target in zip(("spectra", "attributes"), pair, strict=True):
                swap(spark, posixpath.join(partial, name, f"_patch={p}"), target)
    return [t for t, _ in targets.values()]


def read_shards(spark: SparkSession, root: str, patches: list[int] | int | None = None) -> DataFrame:
    """Rows of all shards with patch and shard, from their paths."""
    paths = [n[0] for n in layout.shard_names(spark, root, patches)]
    read = spark.read.parquet(*paths)
    spectra.require_datasets(read)
    where = F.col("_metadata.file_path")
    found = lambda i: F.regexp_extract(where, r"seds_skypatch_(\d+)\.shard(\d+)of(\d+)", i).cast("int")
    return read.withColumns({"patch": found(1), "shard": found(2)})


def shard_table(spark: SparkSession, root: str, patches: list[int] | int | None = None) -> DataFrame:
    """Shard metadata: declared columns of ``<root>/shards.parquet``, checked against the files there."""
    names = [(posixpath.basename(n[0]), n[1], n[2], n[3]) for n in layout.shard_names(spark, root, patches)]
    files = spark.createDataFrame(names, "name string, patch int, shard int, declared int")
    meta_ = spark.read.parquet(posixpath.join(root, "shards.parquet"))
    meta_ = meta_ if patches is None else meta_.where(F.col("patch").isin(layout.as_list(patches)))
    both = meta_.drop("name").join(files, ["patch", "shard"], "full")
    checks.require_none(both.where("declared is null or nshards is null or declared <> nshards"), "shard files and metadata differ")
    return both.drop("declared")


def shard_grids(spark: SparkSession, root: str, shards: DataFrame) -> DataFrame:
    """patch, shard, width and wave_rest of every shard, from ``<root>/wave_rest.parquet``: a row a shard, or one for all."""
    path = posixpath.join(root, "wave_rest.parquet")
    if not layout.exists(spark, path):
        raise LayoutError(f"no wavelength grid: {path} is missing")
    grids = spark.read.parquet(path)
    keys = ["patch", "shard"]
    if set(keys) <= set(grids.columns):
        return shards.select(*keys, "width").join(grids.select(*keys, "wave_rest"), keys, "left")
    if grids.limit(2).count() != 1:
        raise LayoutError(f"{path} needs one row, or patch and shard of each")
    return shards.select(*keys, "width").crossJoin(F.broadcast(grids.select("wave_rest")))  # one row


def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    return jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path


def _renamed(system, a, b) -> bool:
    return bool(system.rename(a, b))


def swap(spark: SparkSession, new: str, target: str) -> None:
    """Puts a finished folder in the place of target; a target that cannot be replaced is back where it was."""
    system, path = _file_system(spark, target)
    aside = f"{target.rstrip('/')}.old-{uuid.uuid4().hex[:8]}"
    there = system.exists(path(target))
    if there and not _renamed(system, path(target), path(aside)):
        raise LayoutError(f"{target} could not be moved aside")
    try:
        system.mkdirs(path(target).getParent())
        done = _renamed(system, path(new), path(target))
    except Exception:
        done = False
    if not done:
        if there and not _renamed(system, path(aside), path(target)):
            raise LayoutError(f"{target} could not be replaced; the old table is {aside}")
        raise LayoutError(f"{new} could not take the place of {target}")
    if there:
        system.delete(path(aside), True)


@contextmanager
def _partial(spark: SparkSession, target: str) -> Iterator[str]:
    """A name beside target for what is being written; whatever is left of it goes."""
    partial = f"{target.rstrip('/')}.partial-{uuid.uuid4().hex[:8]}"
    try:
        yield partial
    finally:
        system, path = _file_system(spark, target)
        if system.exists(path(partial)):
            system.delete(path(partial), True)


def _written(df: DataFrame, path: str, partition_by: tuple[str, ...] = (), options: dict[str, str] | None = None) -> None:
    writer = df.write.options(**(storage.writer_options() if options is None else options))
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def publish_one(df: DataFrame, target: str, overwrite: bool = False, partition_by: tuple[str, ...] = (), options: dict[str, str] | None = None) -> None:
    """Writes beside the target and swaps on success; the old table stays until the new one is in place."""
    spark = df.sparkSession
    if layout.exists(spark, target) and not overwrite:
        raise LayoutError(f"{target} exists")
    with _partial(spark, target) as partial:
        _written(df, partial, partition_by, options)
        swap(spark, partial, target)


def publish_parts(df: DataFrame, target: str, partition_by: tuple[str, ...] = ("partition_index",), options: dict[str, str] | None = None) -> list[str]:
    """Writes a new folder of partitions and returns their names; no reader knows it before a snapshot does."""
    _written(df, target, partition_by, options)
    return snapshots.partitions(df.sparkSession, target)


Tables = dict[str, tuple[DataFrame, tuple[str, ...], dict[str, str] | None]]


def publish(spark: SparkSession, out: str, tables: Tables, proofs: dict[str, fingerprint.Proof], overwrite: bool = False) -> None:
    """A whole catalogue in place of what ``out`` holds, by one commit."""
    refuse_populated(spark, out, overwrite)
    if other := sorted(n for n in layout.listing(spark, out) if n.split(".")[0] not in (*TABLES, snapshots.FOLDER)):
        raise LayoutError(f"{out} holds other things, which would be lost: {other}")
    changed(spark, out, tables, proofs, keep=False)


def changed(spark: SparkSession, path: str, tables: Tables, proofs: dict[str, fingerprint.Proof] | None = None, keep: bool = True) -> None:
    """Puts new tables into a catalogue by one commit; the others stay as they are, files and all (without ``keep``: go).

    proofs: what must hold for a table, seen while it is written.
    """
    before, old = snapshots.state(spark, path, TABLES)
    if not old:
        snapshots.start(spark, path)
    after, made = dict(old) if keep else {}, []
    try:
        for name, (df, by, options) in tables.items():
            folder, proof = snapshots.new_folder(name), (proofs or {}).get(name)
            made.append(folder)
            _written(proof.result(df) if proof else df, posixpath.join(path, folder), by, options)
            if proof:
                proof.require(spark.read.parquet(posixpath.join(path, folder)))
            after[name] = [[folder, None]]
        snapshots.commit(spark, path, before, after)
    except Exception:
        snapshots.abandon(spark, path, made)
        raise


def read_catalogue(spark: SparkSession, path: str, with_spectra: bool = False) -> DataFrame:
    """The objects of a catalogue; with spectra, SED from their own table, which has the data's places and order.

    Only the rows and columns that are asked for are read: a filter on
    partition_index and output_row reaches both tables' files.
    """
    _, state = snapshots.state(spark, path, TABLES)
    data = snapshots.read(spark, path, "data", state)
    if not with_spectra or "SED" in data.columns:
        return data
    return spectra.with_aligned(data, snapshots.read(spark, path, "spectra", state))


def read_region(spark: SparkSession, path: str, region: list[regions.Cap], with_spectra: bool = False) -> DataFrame:
    """The objects inside a region, read by the slices that the index has for it."""
    _, state = snapshots.state(spark, path, TABLES)
    level = snapshots.read(spark, path, "manifest", state).agg(F.max("spatial_index_level")).first()[0]
    data, index = (snapshots.read(spark, path, t, state) for t in ("data", "index"))
    found = regions.select(data, index, region, level)
    if not with_spectra or "SED" in data.columns:
        return found
    wide = snapshots.read(spark, path, "spectra", state)
    return spectra.with_aligned(found, wide.where(regions.near(index, region, level)))


def refuse_populated(spark: SparkSession, out: str, overwrite: bool) -> None:
    if not overwrite and (there := sorted(snapshots.state(spark, out, TABLES)[1])):
        raise LayoutError(f"{out} holds {there} already")


def sizes_of(manifest: DataFrame) -> dict[int, int]:
    """Objects of each partition (few)."""
    return {int(p): int(n) for p, n in manifest.select("partition_index", "n_objects").collect()}


def in_files(data: DataFrame, sizes: dict[int, int], row: str = "output_row") -> DataFrame:
    """data as it is published: columns in alphabetical order with their metadata, rows in ranges of (partition, row)."""
    return spatial.in_file_order(meta.annotated(data.select(*projection.object_columns(data))), sizes, row=row)


@contextmanager
def staging(spark: SparkSession, folder: str, keep: bool = False) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """A function that writes a table under ``folder`` and returns what it reads there; without ``keep`` the folder goes in the end."""

    def stage(df: DataFrame, name: str) -> DataFrame:
        path = posixpath.join(folder, name)
        df.write.mode("overwrite").parquet(path)
        return spark.read.parquet(path)

    try:
        yield stage
    finally:
        system, path = _file_system(spark, folder)
        if not keep and system.exists(path(folder)):
            system.delete(path(folder), True)


def scratch_folder(out: str, scratch: str | None) -> str:
    return posixpath.join(scratch, "skyloom_staging") if scratch else f"{out.rstrip('/')}.staging-{uuid.uuid4().hex[:8]}"


def opened(spark: SparkSession, root: layout.Root, patches: list[int] | None = None) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame, list[int]]:
    """Catalogue, luminosities and photometry of a raw root or of staged sources, the numbered keys, and the patches."""
    if staged.is_staged(spark, root):
        every = staged.record_of(spark, root)["patches"]
        chosen = layout.selected_patches(every, patches)
        catalog, lum, phot = (staged.read(spark, root, kind) for kind in layout.KINDS)
        if chosen != every:
            catalog, lum, phot = (df.where(F.col("skypatch").isin(chosen)) for df in (catalog, lum, phot))
        return catalog, lum, phot, catalog.select(*[c for c in (*_NARROW, "source_global_row") if c in catalog.columns]), chosen
    chosen = layout.selected_patches(layout.discover_skypatches(spark, root), patches)
    catalog, lum, phot = (layout.read_kind(spark, root, kind, chosen) for kind in layout.KINDS)
    return catalog, lum, phot, numbered_sources(catalog, lum, phot, chosen), chosen


def stage_sources(spark: SparkSession, raw_root: layout.Root, out: str, patches: list[int] | None = None, buckets: int | None = None) -> None:
    """Raw sources, checked and numbered, as tables in buckets of their common key.

    The payload moves here once; runs on ``out`` join it where it lies, however
    often it is binned anew.
    """
    if staged.is_staged(spark, out):
        raise LayoutError(f"{out} holds staged sources already")
    catalog, lum, phot, numbered, chosen = opened(spark, raw_root, patches)
    keys = ["skypatch", "core_group", "row_in_group"]
    with staging(spark, scratch_folder(out, None)) as stage:
        numbered = stage(numbered, "numbered")
        offsets = rows.dense_offsets(numbered, rows.group_offsets(catalog))
        if offsets is not None:
            whole = catalog.join(offsets, ["skypatch", "core_group"]).withColumn("source_global_row", F.col("row_offset") + F.col("row_in_group")).drop("row_offset")
        else:
            whole = catalog.join(numbered.select(*keys, "source_global_row"), keys)
        staged.write(spark, out, dict(zip(layout.KINDS, (whole, lum, phot), strict=True)), chosen, buckets)


def repartitioned(spark: SparkSession, raw_root: layout.Root, bands: dict[str, list[str]], n_partitions: int, decimals: int, patches: list[int] | None, stage, level: int | None = None):
    """Raw sources to (data, places, counts, edges, patches, sources, proof): lossless, each object to the range of its key.

    proof: once data is written, it tells whether every value of the three
    sources is there, in the row where it belongs.
    """
    catalog, lum, phot, numbered, chosen = opened(spark, raw_root, patches)
    plain = catalog.select("skypatch", KEY)
    edges = binning.quantile_edges(plain, KEY, n_partitions, decimals)
    places = placed(numbered, edges)
    places = stage(places if level is None else in_pixel_order(places, level), "places")
    specs = checked_specs(places, catalog, lum, phot, bands)
    counts = binning.bin_counts(binning.assign_bins(plain, KEY, edges), n_partitions)
    again = places.groupBy("partition_index").agg(F.count(F.lit(1)).alias("n_objects"))
    checks.require_none(checks.count_differences(counts, again, ["partition_index"]), "rows counted differ from rows placed")
    offsets = None if "source_global_row" in catalog.columns else rows.dense_offsets(places, rows.group_offsets(catalog))
    proof = fingerprint.Proof()
    proof.expect("places", places, [c for c in (*KEYS, *_PLACE) if c in places.columns])
    return payload(catalog, lum, phot, specs, places, offsets, proof), places, counts, edges, chosen, (catalog, lum), proof


def run(
    spark: SparkSession,
    raw_root: layout.Root,
    out: str,
    bands_path: str,
    n_partitions: int = 16,
    decimals: int = 2,
    level: int = 5,
    patches: list[int] | None = None,
    sed_root: str | None = None,
    header_path: str | None = None,
    first_step: int = 0,
    overwrite: bool = False,
    samples: int = spectra.SAMPLES,
    prefix: str = "catalogue",
    grids_path: str | None = None,
    how: Storage | None = None,
    scratch: str | None = None,
    keep_intermediates: bool = False,
) -> None:
    """Raw sources to published tables.  A header is used whenever one is given, and needed for spectra."""
    healpix.checked_level(level)
    how = how or Storage()
    if sed_root is not None and header_path is None:
        raise LayoutError("spectra need a header to describe them")
    refuse_populated(spark, out, overwrite)  # before any work
    axes = None if grids_path is None else meta.annotated(layout.load_time_grids(spark, grids_path))
    with staging(spark, scratch_folder(out, scratch), keep_intermediates) as stage:
        data, places, counts, edges, chosen, (catalog, lum), proof = repartitioned(spark, raw_root, layout.load_band_names(spark, bands_path), n_partitions, decimals, patches, stage, level)
        manifest, sizes = meta.with_level(meta.manifest(counts, edges, chosen, prefix), level), sizes_of(counts)
        proofs, wide = {"data": proof}, None
        if sed_root is not None:
            shards, grids, source = spectra_of(spark, sed_root, chosen)
            wide, proofs["spectra"] = appended_spectra(places, source, shards, samples, grids=grids)
            require_same_objects(source, places, lum, shards, samples)
            manifest = meta.with_status(manifest, True, SOURCE_NOTE)
        headers = None
        if header_path is not None:
            targets = counts.select("partition_index", F.lit(False).alias("is_source"), F.lit(False).alias("has_header"))
            headers = meta.specialised_headers(targets, spark.read.parquet(header_path), places, manifest, first_step, replace=True)
            if sed_root is not None:
                headers = meta.with_spectrum_header(headers, grids.orderBy("patch", "shard").limit(1).select("wave_rest"))
        ordered = in_files(data, sizes)
        tables = {
            "data": (ordered, ("partition_index",), how.options(ordered)),
            "index": (spatial.sparse_index(places, level), ("partition_index", "level"), None),
            "provenance": (spatial.provenance(places), ("partition_index",), None),
            "manifest": (manifest, (), None),
        }
        tables |= {name: (df, (), None) for name, df in (("header", headers), ("axes", axes)) if df is not None}
        if wide is not None:
            tables["spectra"] = spectra_table(wide, sizes, how)
        publish(spark, out, tables, proofs, overwrite)


def spectra_table(wide: DataFrame, sizes: dict[int, int], how: Storage, row: str = "output_row") -> tuple[DataFrame, tuple[str, ...], dict[str, str]]:
    """Spectra as a table of their own, in the data's ranges of rows, with pages of their own size."""
    ordered = in_files(wide, sizes, row)
    return ordered, ("partition_index",), how.options(ordered)


def spatial_catalogue(spark: SparkSession, source: str, out: str, level: int = 5, overwrite: bool = False, how: Storage | None = None) -> list[int]:
    """Orders the partitions of a repartitioned catalogue by pixel and indexes them; returns those that were written.

    Partitions that ``out`` lists are skipped unless they are to be replaced.
    All are written by one job and one commit; if it fails, one by one, and
    every failure is named in the end.  What is not per object (header, axes) is
    carried over.
    """
    level, how = healpix.checked_level(level), how or Storage()
    if posixpath.normpath(source) == posixpath.normpath(out):
        raise LayoutError("input and output folders are the same")
    _, given = snapshots.state(spark, source, TABLES)
    data, manifest = (snapshots.read(spark, source, t, given) for t in ("data", "manifest"))
    if "input_row" not in data.columns:
        raise LayoutError("the data has no input_row; repartition it again")
    old = snapshots.state(spark, out, TABLES)[1]
    done = {r[0] for r in snapshots.read(spark, out, "manifest", old).select("partition_index").collect()} if "manifest" in old and not overwrite else set()
    sizes = {p: n for p, n in sizes_of(manifest).items() if p not in done}
    todo = sorted(sizes)

    def write(parts: list[int]) -> None:
        own = data.where(F.col("partition_index").isin(parts)).drop("pixel", "output_row")
        before, state = snapshots.state(spark, out, TABLES)
        after, replaced = dict(state), [f"partition_index={p}" for p in parts]
        if not state:
            snapshots.start(spark, out)
        with staging(spark, scratch_folder(out, None)) as stage:
            keys, proof = ["partition_index", "input_row"], fingerprint.Proof()
            places = stage(in_pixel_order(own.select(*keys, "ra", "dec"), level), "places")
            proof.expect("places", places, [*keys, "pixel", "output_row"])
            own = proof.source("the input", own, own.columns)
            ordered = in_files(own.join(places.select(*keys, "pixel", "output_row"), keys), {p: sizes[p] for p in parts})
            made = {"data": (proof.result(ordered), ("partition_index",), how.options(ordered)), "index": (spatial.sparse_index(places, level), ("partition_index", "level"), None), "provenance": (spatial.provenance(places), ("partition_index",), None)}
            for name, (df, by, options) in made.items():
                folder = snapshots.new_folder(name)
                written = publish_parts(df, posixpath.join(out, folder), by, options)
                if name == "data":
                    proof.require(spark.read.parquet(posixpath.join(out, folder)))
                after[name] = snapshots.merged(snapshots.listed(spark, out, state.get(name, [])), folder, written, replaced)
        told = meta.with_level(manifest.where(F.col("partition_index").isin(parts)), level)
        if "manifest" in state:
            told = told.unionByName(snapshots.read(spark, out, "manifest", state).where(~F.col("partition_index").isin(parts)), allowMissingColumns=True)
        for name, df in (("manifest", told), *((n, snapshots.read(spark, source, n, given)) for n in ("header", "axes") if n in given)):
            after[name] = [[snapshots.new_folder(name), None]]
            _written(df, posixpath.join(out, after[name][0][0]))
        snapshots.commit(spark, out, before, after)

    good, failed = [], {}
    if todo:
        try:
            write(todo)
            good = todo
        except LayoutError:
            raise
        except Exception:  # one bad partition must not hold back the others
            for part in todo:
                try:
                    write([part])
                    good.append(part)
                except Exception as error:
                    failed[part] = str(error).splitlines()[0]
    if failed:
        raise LayoutError(f"{len(failed)} partitions failed: " + "; ".join(f"{p}: {e}" for p, e in failed.items()))
    return good


def append_catalogue(spark: SparkSession, path: str, sed_root: str, out: str | None = None, overwrite: bool = False, samples: int = spectra.SAMPLES, how: Storage | None = None) -> None:
    """A published catalogue with its spectra and their header, in its own place or as a catalogue ``out``.

    The spectra are a table of their own with the data's places; the data's files
    are not touched.  Spectra, header and manifest appear by one commit.
    """
    how = how or Storage()
    _, state = snapshots.state(spark, path, TABLES)
    if "header" not in state:
        raise LayoutError(f"spectra need a header to describe them, and {path} has none")
    final, manifest, header = (snapshots.read(spark, path, t, state) for t in ("data", "manifest", "header"))
    checks.require_appendable(final, manifest, overwrite)
    row = "output_row" if "output_row" in final.columns else "input_row"
    checks.require_columns(final, (row,), "the catalogue")
    if out is not None:
        refuse_populated(spark, out, overwrite)
    patches = sorted(r[0] for r in layout.distinct_patches(final).collect())
    shards, grids, source = spectra_of(spark, sed_root, patches)
    wide, proof = appended_spectra(final, source, shards, samples, grids=grids, row=row)
    sizes = sizes_of(manifest)
    header = meta.with_spectrum_header(header, grids.orderBy("patch", "shard").limit(1).select("wave_rest"))
    tables: Tables = {"spectra": spectra_table(wide, sizes, how, row), "header": (header, (), None), "manifest": (meta.with_status(manifest, True, SOURCE_NOTE), (), None)}
    if "SED" in final.columns:  # an older catalogue, with spectra among the data
        tables["data"] = (in_files(final.drop("SED"), sizes, row), ("partition_index",), how.options(final.drop("SED")))
    if out is not None:
        by = {"index": ("partition_index", "level"), "provenance": ("partition_index",)}
        copied = in_files(final.drop("SED"), sizes, row)
        tables["data"] = (copied, ("partition_index",), how.options(copied))
        tables |= {t: (snapshots.read(spark, path, t, state), by.get(t, ()), None) for t in ("index", "provenance", "axes") if t in state}
    changed(spark, path if out is None else out, tables, {"spectra": proof}, keep=out is None)


def header_catalogues(spark: SparkSession, source: str, targets: list[str], replace: bool = False, specialise: bool = True, first_step: int = 0) -> int:
    """A donor's header on the partitions of each catalogue, steps counting on; returns how many partitions got one.

    source: a header table, or a catalogue that holds one, which is skipped as a target.
    """
    inside = snapshots.has(spark, source, "header")
    donor = snapshots.read(spark, source, "header") if inside else spark.read.parquet(source)
    if inside and tree.is_tree(donor):
        first = donor.where("not skipped").agg(F.min("partition_index")).first()[0]
        donor = tree.rows_of(donor.where(F.col("partition_index") == first).where("not skipped"))
    elif inside or "partition_index" in donor.columns:
        donor = donor.where("not coalesce(skipped, false)").orderBy("partition_index").limit(1).drop("partition_index", "is_source", "has_header", "skipped", "copied_before", "warnings")
    if tree.is_tree(donor):
        checks.require_none(tree.problems(tree.rows_of(donor)), "the header is no tree")
        found = tree.census(tree.rows_of(donor)).first()
        print(f"header: {found['n_groups']} subgroups, {found['n_datasets']} datasets, {found['n_attributes']} attributes")
    copied = 0
    for target in targets:
        _, state = snapshots.state(spark, target, TABLES)
        same, has = inside and posixpath.normpath(target) == posixpath.normpath(source), "header" in state
        if same or has and not replace:
            print(f"{target}: " + ("is the source" if same else "has a header already (--replace)") + ", skipped")
            continue
        manifest = snapshots.read(spark, target, "manifest", state)
        data = snapshots.read(spark, target, "data", state) if specialise else None
        names = manifest.select("partition_index", F.lit(False).alias("is_source"), F.lit(has).alias("has_header"))
        headers = meta.specialised_headers(names, donor, data, manifest if specialise else None, first_step + copied, replace)
        changed(spark, target, {"header": (headers, (), None)})
        copied += manifest.count()
    return copied
