"""Commands: ``python -m skyloom.plans.cli <command> ...``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from skyloom.errors import LayoutError
from skyloom.functions import healpix
from skyloom.operators import binning, checks, spatial
from skyloom.plans import pipeline
from skyloom.sources import layout, snapshots

CODECS = ["blosc", "blosc-lz4", "gzip", "lzf", "none"]


def at_least(low: int):
    def number(text: str) -> int:
        if (value := int(text)) < low:
            raise argparse.ArgumentTypeError(f"{value} is below {low}")
        return value

    return number


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="skyloom", description=__doc__)
    sub = top.add_subparsers(dest="command", required=True)

    def storage(p, default="blosc"):
        p.add_argument("--compression", default=default, choices=CODECS)
        p.add_argument("--compression-level", type=int, default=5)

    def binned(p):
        p.add_argument("--bands", help="band names (default: bands.json in the raw root, else raw/)")
        p.add_argument("--n-partitions", type=at_least(1), default=16)
        p.add_argument("--decimals", type=at_least(0), default=2)
        p.add_argument("--patch", type=int, action="append", help="only this patch (repeatable)")
        p.add_argument("--prefix", default="catalogue", help="of the partitions' names")
        p.add_argument("--scratch-dir", help="shared folder for staged tables (default: beside the output)")
        p.add_argument("--overwrite", action="store_true")

    def spectra(p):
        p.add_argument("--chunk-rows", type=at_least(1), default=pipeline.storage.SPECTRUM_ROWS, help="rows of a page of spectra")
        p.add_argument("--verify-samples", type=at_least(0), default=16, help="identity samples a partition or shard (0: none)")

    p = sub.add_parser("repartition", help="split into equal-population ranges")
    p.add_argument("--raw-root", default="raw")
    p.add_argument("--output-dir", default="repartitioned")
    p.add_argument("--verify", action="store_true", help="only check the sources' alignment")
    binned(p)
    p = sub.add_parser("spatial", help="order by pixel and index; partitions that are done are skipped")
    p.add_argument("--level", type=int, default=5, choices=range(healpix.MAX_LEVEL + 1))
    p.add_argument("--input-dir", default="repartitioned")
    p.add_argument("--output-dir", default="spatially_indexed")
    p.add_argument("--chunk-kib", type=at_least(1), default=1024, help="bytes of a page")
    p.add_argument("--overwrite", action="store_true")
    storage(p)
    p = sub.add_parser("stage", help="raw sources as tables in buckets of their common key, which later runs join without moving them")
    p.add_argument("--raw-root", required=True)
    p.add_argument("--output-dir", required=True)
    p.add_argument("--patch", type=int, action="append", help="only this patch (repeatable)")
    p.add_argument("--buckets", type=int, help="files of each kind (default: spark.sql.shuffle.partitions)")

    p = sub.add_parser("append", help="join spectra to catalogues that have a header")
    p.add_argument("catalog", nargs="*")
    p.add_argument("--catalog-dir", help="a catalogue, or a folder of catalogues")
    p.add_argument("--sed-dir", default="hires")
    p.add_argument("--output-dir", help="of one catalogue (default: in place)")
    p.add_argument("--overwrite", action="store_true")
    spectra(p)
    storage(p, "blosc-lz4")
    p = sub.add_parser("convert", help="one table a patch from spectrum shards")
    p.add_argument("--input-dir", default="hires")
    p.add_argument("--output-dir", default="hires_converted")
    p.add_argument("--patch", type=int, action="append")
    p.add_argument("--verify", action="store_true", help="only check the shards")
    p.add_argument("--raw-root", help="catalogue and luminosities to compare with (default: those beside the spectra, if any)")
    p.add_argument("--overwrite", action="store_true")
    spectra(p)
    storage(p)
    p = sub.add_parser("header", help="put a donor's header on every partition")
    p.add_argument("targets", nargs="*")
    p.add_argument("--source", required=True, help="a header table, or a catalogue that has one")
    p.add_argument("--target-dir", help="a catalogue, or a folder of catalogues")
    p.add_argument("--replace", action="store_true")
    p.add_argument("--no-specialise", action="store_true")
    p.add_argument("--first-step", type=int, default=0)
    p = sub.add_parser("pipeline", help="all of it")
    p.add_argument("--raw-root", help="a folder with one folder a kind (default: raw), or these three:")
    p.add_argument("--catalog-dir")
    p.add_argument("--luminosity-dir")
    p.add_argument("--photometry-dir")
    p.add_argument("--level", type=int, default=5, choices=range(healpix.MAX_LEVEL + 1))
    p.add_argument("--output-dir", required=True)
    p.add_argument("--sed-dir")
    p.add_argument("--header-source", help="required with --sed-dir")
    p.add_argument("--time-grids", help="shared history axes to publish")
    p.add_argument("--first-step", type=int, default=0)
    p.add_argument("--sed-compression", default="blosc-lz4", choices=CODECS)
    p.add_argument("--sed-compression-level", type=int, default=5)
    p.add_argument("--keep-intermediates", action=argparse.BooleanOptionalAction, default=False)
    binned(p)
    spectra(p)
    storage(p)
    return top


def raw_root(a: argparse.Namespace) -> layout.Root:
    """One root, or three folders as a virtual one."""
    three = (a.catalog_dir, a.luminosity_dir, a.photometry_dir)
    if any(three):
        if a.raw_root:
            raise LayoutError("either --raw-root or the three folders")
        return layout.linked_roots(*three)
    return a.raw_root or "raw"


def bands_of(spark: SparkSession, a: argparse.Namespace, root: layout.Root) -> str:
    folder = root["lightcone_catalogs"] if isinstance(root, dict) else root
    return layout.resolve_data_path(spark, "bands.json", a.bands, (folder,))


def verify(spark: SparkSession, root: layout.Root, patches: list[int] | None) -> None:
    """Prints every group's endpoints passed and failed, then raises if any failed."""
    chosen = layout.selected_patches(layout.discover_skypatches(spark, root), patches)
    catalog, lum, phot = (layout.read_kind(spark, root, k, chosen) for k in layout.KINDS)
    numbered = pipeline.numbered_sources(catalog, lum, phot, chosen)
    checks.verify_report(numbered, lum).orderBy("skypatch").show(1000)
    checks.require([("sources are misaligned", checks.endpoint_differences(numbered, lum))])


def main(args: list[str] | None = None, spark: SparkSession | None = None) -> None:
    a = parser().parse_args(args)
    spark = spark or SparkSession.builder.appName("skyloom").getOrCreate()
    if a.command == "repartition":
        if a.verify:
            verify(spark, a.raw_root, a.patch)
            return
        pipeline.refuse_populated(spark, a.output_dir, a.overwrite)
        bands = layout.load_band_names(spark, bands_of(spark, a, a.raw_root))
        with pipeline.staging(spark, pipeline.scratch_folder(a.output_dir, a.scratch_dir)) as stage:
            data, _, counts, edges, patches, _, proof = pipeline.repartitioned(spark, a.raw_root, bands, a.n_partitions, a.decimals, a.patch, stage)
            ordered = pipeline.in_files(data, pipeline.sizes_of(counts), "input_row")
            manifest = pipeline.meta.manifest(counts, edges, patches, a.prefix)
            tables = {"data": (ordered, ("partition_index",), pipeline.Storage().options(ordered)), "manifest": (manifest, (), None)}
            pipeline.publish(spark, a.output_dir, tables, {"data": proof}, a.overwrite)
        binning.balance(counts, edges).orderBy("partition_index").show(1000)
    elif a.command == "stage":
        pipeline.stage_sources(spark, a.raw_root, a.output_dir, a.patch, a.buckets)
    elif a.command == "spatial":
        how = pipeline.Storage(a.compression, a.compression_level, a.chunk_kib << 10)
        done = pipeline.spatial_catalogue(spark, a.input_dir, a.output_dir, a.level, a.overwrite, how)
        print(f"level {a.level}, {healpix.pixel_count(a.level)} pixels of {healpix.resolution_degrees(a.level):.3f} degrees; partitions written: {done or 'none, nothing to do'}")
        if done:
            spatial.occupancy(snapshots.read(spark, a.output_dir, "index"), a.level).orderBy("partition_index").show(1000)
    elif a.command == "append":
        found = layout.collect_targets(spark, a.catalog, a.catalog_dir, required=True)
        if a.output_dir and len(found) > 1:
            raise LayoutError("--output-dir takes one catalogue")
        how = pipeline.Storage(sed_codec=a.compression, sed_level=a.compression_level, sed_rows=a.chunk_rows)
        for path in found:
            pipeline.append_catalogue(spark, path, a.sed_dir, a.output_dir, a.overwrite, a.verify_samples, how)
    elif a.command == "convert":
        if a.verify:
            shards = pipeline.verified_shards(spark, a.input_dir, a.patch, a.raw_root, a.verify_samples)
            shards.groupBy("patch").agg(F.max("n_global").alias("verified_rows")).orderBy("patch").show(1000)
        else:
            how = pipeline.Storage(sed_codec=a.compression, sed_level=a.compression_level, sed_rows=a.chunk_rows)
            pipeline.converted_spectra(spark, a.input_dir, a.output_dir, a.patch, a.overwrite, a.raw_root, a.verify_samples, how)
    elif a.command == "header":
        found = layout.collect_targets(spark, a.targets, a.target_dir, required=True)
        copied = pipeline.header_catalogues(spark, a.source, found, a.replace, not a.no_specialise, a.first_step)
        print(f"partitions with a new header: {copied}")
    else:
        root = raw_root(a)
        how = pipeline.Storage(a.compression, a.compression_level, sed_codec=a.sed_compression, sed_level=a.sed_compression_level, sed_rows=a.chunk_rows)
        pipeline.run(
            spark, root, a.output_dir, bands_of(spark, a, root), a.n_partitions, a.decimals, a.level, a.patch, a.sed_dir, a.header_source, a.first_step,
            a.overwrite, a.verify_samples, a.prefix, a.time_grids, how, a.scratch_dir, a.keep_intermediates,
        )


if __name__ == "__main__":
    main()
