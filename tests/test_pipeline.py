"""The published tables, the checks' negative cases and the commands, on small Parquet sources."""

import json
import math

import pytest
from pyspark.sql import functions as F

from skyloom.errors import LayoutError
from skyloom.operators import checks, meta, projection, spectra, storage
from skyloom.plans import cli, pipeline
from skyloom.sources import hdf5, layout, snapshots

GROUPS = {0: {"core_1": 5, "core_10": 4, "core_2": 7}, 1: {"core_0": 6, "core_3": 0}}


def catalog_rows():
    made, tag = [], 0
    for patch, groups in GROUPS.items():
        for group in sorted(groups):
            for row in range(groups[group]):
                made.append((patch, group, row, 0.1 + 0.07 * tag, (tag * 37.5) % 360, (tag * 13.0) % 180 - 90, 1000 + tag, tag % 2 == 0))
                tag += 1
    return made


@pytest.fixture()
def raw(spark, tmp_path):
    """Two patches in three kinds, spectra in two shards a patch, bands and a donor header."""
    root = tmp_path / "raw"
    sed = tmp_path / "sed"
    made = catalog_rows()
    metadata = []
    for patch in GROUPS:
        own = [r for r in made if r[0] == patch]
        cat = spark.createDataFrame([r[1:] for r in own], "core_group string, row_in_group long, redshift double, ra double, dec double, core_tag long, central boolean")
        cat.coalesce(1).write.parquet(layout.patch_path(str(root), patch, "lightcone_catalogs"))
        flat = [(i, r[3], [float(i), 1.0], 2.0 * i) for i, r in enumerate(own)]
        lum = spark.createDataFrame(flat, "source_global_row long, redshift float, M_ABS_SDSS array<double>, L_BOL_LSUN double")
        lum.coalesce(1).write.parquet(layout.patch_path(str(root), patch, "luminosities"))
        phot = spark.createDataFrame([(i, [float(i), -float(i)]) for i in range(len(own))], "source_global_row long, survey array<double>")
        phot.coalesce(1).write.parquet(layout.patch_path(str(root), patch, "photometry"))
        n = len(own)
        for shard, (a, b) in enumerate(((0, n // 2), (n // 2, n))):
            rows = [(i - a, [float(own[i][6])] * 3, own[i][6], own[i][3]) for i in range(a, b)]
            spark.createDataFrame(rows, "local_row long, SED array<float>, core_tag long, redshift double").coalesce(1).write.parquet(str(sed / f"seds_skypatch_{patch}.shard{shard}of2.parquet"))
            metadata.append((patch, shard, 2, a, b - a, n, 3, 64, True, f"seds_skypatch_{patch}.shard{shard}of2.parquet"))
    schema = "patch int, shard int, nshards int, row_offset long, n_rows long, n_global long, width int, block_size int, complete boolean, name string"
    spark.createDataFrame(metadata, schema).write.parquet(str(sed / "shards.parquet"))
    (tmp_path / "bands.json").write_text(json.dumps({"_LUM_M_ABS_SDSS": ["g", "r"], "survey": ["u.txt", "a.b-c"]}))
    spark.createDataFrame([(9.0, 0, [0.0, 9.0], "run")], "file_redshift double, file_step long, z_range array<double>, simulation string").write.parquet(str(tmp_path / "donor"))
    spark.createDataFrame([([1.0, 2.0, 3.0],)], "wave_rest array<double>").write.parquet(str(sed / "wave_rest.parquet"))
    return tmp_path


def run(spark, raw, out="out", **more):
    pipeline.run(spark, str(raw / "raw"), str(raw / out), str(raw / "bands.json"), n_partitions=3, level=3, sed_root=str(raw / "sed"), header_path=str(raw / "donor"), first_step=5, **more)
    return {t: snapshots.read(spark, str(raw / out), t) for t in ("data", "index", "provenance", "manifest", "header", "spectra")}


def test_published_tables(spark, raw):
    found = run(spark, raw)
    assert "SED" not in found["data"].columns
    data = pipeline.read_catalogue(spark, str(raw / "out"), with_spectra=True).collect()
    made = catalog_rows()
    assert sorted(r.core_tag for r in data) == sorted(r[6] for r in made)  # nothing lost
    by_tag = {r[6]: r for r in made}
    order = {p: [r[6] for r in made if r[0] == p] for p in GROUPS}
    for r in data:
        assert order[r.skypatch][r.source_global_row] == r.core_tag and r.redshift == by_tag[r.core_tag][3]
        assert r.mag_u == r.source_global_row == -r.mag_a_b_c == r.M_ABS_SDSS_g and r.SED == [r.core_tag] * 3
        assert r.source_core == int(by_tag[r.core_tag][1][5:])
    manifest = {m.partition_index: m for m in found["manifest"].collect()}
    assert sum(m.n_objects for m in manifest.values()) == len(data) and sorted(manifest) == [0, 1, 2]
    for m in manifest.values():
        own = [r for r in data if r.partition_index == m.partition_index]
        assert len(own) == m.n_objects and all(m.z_min <= r.redshift <= m.z_max for r in own)
        assert sorted(r.output_row for r in own) == list(range(len(own)))
        own.sort(key=lambda r: r.output_row)
        assert [(r.pixel, r.input_row) for r in own] == sorted((r.pixel, r.input_row) for r in own)
        index = found["index"].where(f"partition_index = {m.partition_index} and level = 3").collect()
        for i in index:
            assert {r.pixel for r in own[i.start : i.start + i["size"]]} == {i.pixel}
    assert {(r.partition_index, r.output_row, r.input_row) for r in data} == set(map(tuple, found["provenance"].select("partition_index", "output_row", "input_row").collect()))
    headers = sorted(found["header"].collect(), key=lambda r: r.partition_index)
    assert [h.file_step for h in headers] == [5, 6, 7] and all(h.simulation == "run" for h in headers)
    assert headers[0].sed_wave_rest == [1.0, 2.0, 3.0] and headers[0].sed_flux_unit == "Jy"
    assert found["header"].schema["sed_wave_rest"].metadata["unit"] == "Angstrom"
    assert headers[0].z_range == [manifest[0].z_min, manifest[0].z_max]
    units = {f.name: f.metadata for f in found["data"].schema.fields}
    assert units["ra"]["unit"] == "deg" and units["mag_u"]["unit"] == "mag" and "core_tag" in units and "description" in units["core_tag"]


def test_existing_output_is_refused_before_work_and_replaced_on_demand(spark, raw):
    run(spark, raw)
    with pytest.raises(LayoutError, match="already"):
        run(spark, raw)
    assert run(spark, raw, overwrite=True)["data"].count() == len(catalog_rows())
    assert len(layout.listing(spark, str(raw / "out"))) == 13  # two states of six tables, and their record


def test_failed_write_leaves_the_old_table(spark, tmp_path):
    target = str(tmp_path / "t")
    pipeline.publish_one(spark.range(3), target)
    with pytest.raises(Exception, match="no"):
        pipeline.publish_one(spark.range(5).select(F.raise_error(F.lit("no")).alias("id")), target, overwrite=True)
    assert spark.read.parquet(target).count() == 3 and layout.listing(spark, str(tmp_path)) == ["t"]
    with pytest.raises(LayoutError):
        pipeline.publish_one(spark.range(1), target)


def test_misaligned_sources_are_rejected(spark, raw):
    bad = spark.createDataFrame([(i, 9.0, [1.0, 2.0], 1.0) for i in range(6)], "source_global_row long, redshift float, M_ABS_SDSS array<double>, L_BOL_LSUN double")
    bad.write.mode("overwrite").parquet(layout.patch_path(str(raw / "raw"), 1, "luminosities"))
    with pytest.raises(LayoutError, match="misaligned"):
        run(spark, raw)
    bad.limit(4).write.mode("overwrite").parquet(layout.patch_path(str(raw / "raw"), 1, "luminosities"))
    with pytest.raises(LayoutError, match="row counts"):
        run(spark, raw)


def test_matrix_width_must_equal_the_bands(spark, raw):
    (raw / "bands.json").write_text(json.dumps({"_LUM_M_ABS_SDSS": ["g", "r", "i"], "survey": ["u.txt", "a.b-c"]}))
    with pytest.raises(LayoutError, match="wide"):
        run(spark, raw)


def test_discovery(spark, raw):
    root = str(raw / "raw")
    assert layout.discover_skypatches(spark, root) == [0, 1] and layout.selected_patches([0, 1], [1, 1]) == [1]
    with pytest.raises(LayoutError):
        layout.selected_patches([0, 1], [2])
    with pytest.raises(LayoutError):
        layout.patch_path(root, 0, "spectra")
    spark.range(1).write.parquet(layout.patch_path(root, 7, "photometry"))
    with pytest.raises(LayoutError, match="luminosities of 7"):
        layout.discover_skypatches(spark, root)
    with pytest.raises(LayoutError):
        layout.discover_skypatches(spark, str(raw / "nothing"))
    assert layout.companion_path(spark, root, 0, "photometry").endswith("photometry/photometry_skypatch_0.parquet")
    assert layout.collect_targets(spark, ["/a/x", "/a/./x", "/b"]) == ["/a/x", "/b"]
    assert layout.resolve_data_path(spark, "bands.json", None, (str(raw),)) == f"{raw}/bands.json" and layout.resolve_data_path(spark, "n.json") == "raw/n.json"
    with pytest.raises(LayoutError):
        layout.collect_targets(spark, [], str(raw / "nothing"), required=True)
    with pytest.raises(LayoutError):
        layout.load_band_names(spark, str(raw / "none.json"))
    with pytest.raises(LayoutError):
        layout.linked_roots("a", "", "c")


def test_time_grids(spark, tmp_path):
    whole = spark.range(1).select(*[F.array_repeat(F.lit(1.0), n).alias(k) for k, n in layout.TIME_GRIDS.items()])
    whole.write.parquet(str(tmp_path / "good"))
    assert layout.load_time_grids(spark, str(tmp_path / "good")).columns == list(layout.TIME_GRIDS)
    whole.drop("mah_step").write.parquet(str(tmp_path / "short"))
    whole.withColumn("mah_step", F.array(F.lit(1.0))).write.parquet(str(tmp_path / "wrong"))
    for bad in ("short", "wrong", "none"):
        with pytest.raises(LayoutError):
            layout.load_time_grids(spark, str(tmp_path / bad))


SHARD = "patch int, shard int, nshards int, row_offset long, n_rows long, n_global long, width int, complete boolean, name string"


def shard(patch=0, shard=0, nshards=3, offset=0, n=10, total=30, width=4, complete=True, name=None):
    return patch, shard, nshards, offset, n, total, width, complete, name or f"seds_skypatch_{patch}.shard{shard}of{nshards}.parquet"


@pytest.mark.parametrize(
    ("change", "fails"),
    [
        ({}, set()),
        ({"drop": 1}, {"set", "range"}),
        ({"offset": 11}, {"range"}),
        ({"offset": 9}, {"range"}),
        ({"total": 31}, {"set"}),
        ({"width": 5}, {"set"}),
        ({"complete": False}, {"metadata"}),
        ({"complete": None}, {"metadata"}),
        ({"name": "seds_skypatch_0.shard2of3.parquet"}, {"metadata"}),
    ],
)
def test_shard_rules(spark, change, fails):
    rows = [shard(shard=i, offset=10 * i) for i in range(3)]
    if "drop" in change:
        del rows[1]
    elif change:
        rows[1] = shard(shard=1, **{"offset": 10} | change)
    df = spark.createDataFrame(rows, SHARD)
    got = {k for k, v in (("metadata", checks.shard_metadata_violations(df)), ("set", checks.shard_set_violations(df)), ("range", checks.shard_range_violations(df))) if v.count()}
    assert fails <= got and (fails or not got)


def test_references_and_identities(spark):
    shards = spark.createDataFrame([shard(shard=i, offset=10 * i) for i in range(3)], SHARD)
    refs = spark.createDataFrame([(0, 0), (0, 29), (0, 30), (0, -1), (5, 1), (0, 7), (0, 7)], "skypatch int, source_global_row long")
    assert sorted((r.skypatch, r.source_global_row) for r in spectra.out_of_range(refs, shards).collect()) == [(0, -1), (0, 30), (5, 1)]
    assert [tuple(r) for r in spectra.duplicate_references(refs).collect()] == [(0, 7, 2)]
    source = spark.createDataFrame([(0, i, [1.0], i, i / 10) for i in range(10)], "skypatch int, source_global_row long, SED array<float>, core_tag long, redshift double")
    final = spark.createDataFrame([(0, i, i if i != 3 else 99, math.nan if i == 5 else i / 10 + (2e-6 if i == 7 else 0), 0, i) for i in range(10)], "skypatch int, source_global_row long, core_tag long, redshift double, partition_index int, output_row long")
    assert sorted(r.source_global_row for r in spectra.identity_violations(final, source).collect()) == [3, 5, 7]
    assert spectra.gathered(final, source.where("source_global_row < 4")).where("SED is null").count() == 6
    with pytest.raises(LayoutError, match="spectra already"):
        checks.require_appendable(final.withColumn("SED", F.lit(1)))
    status = lambda done: meta.with_status(final.limit(1), done, None)
    with pytest.raises(LayoutError, match="spectra already"):
        checks.require_appendable(final, status(True))
    checks.require_appendable(final.withColumn("SED", F.lit(1)), status(False))  # an append that did not end
    with pytest.raises(LayoutError, match="old layout"):
        checks.require_appendable(final.withColumn("wave_rest", F.lit(1)))
    with pytest.raises(LayoutError, match="lacks"):
        checks.require_appendable(final.drop("skypatch"))


def test_headers_say_what_stayed(spark):
    targets = spark.createDataFrame([(0, False, False), (1, True, False), (2, False, True), (3, False, False)], "partition_index int, is_source boolean, has_header boolean")
    donor = spark.createDataFrame([(9.0, 0)], "file_redshift double, file_step long")
    got = meta.specialised_headers(targets, donor, None, None).orderBy("partition_index").collect()
    assert [r.skipped for r in got] == [False, True, True, False] and len(got[0].warnings) == 2 and got[0].file_redshift == 9.0
    data = spark.createDataFrame([(0, 1.0), (0, 3.0), (3, 5.0)], "partition_index int, redshift double")
    got = meta.specialised_headers(targets, donor, data, None, first_step=4).orderBy("partition_index").collect()
    assert [(r.file_redshift, r.file_step) for r in got if not r.skipped] == [(2.0, 4), (5.0, 5)]
    assert [r.file_step for r in meta.specialised_headers(targets, donor, data, None, replace=True).orderBy("partition_index").collect()] == [0, None, 1, 2]


def test_wavelength_grids_must_agree(spark):
    grid = spark.createDataFrame([([1.0, 2.0],)], "wave_rest array<double>")
    header = spark.createDataFrame([("run", [1.0, 2.0])], "simulation string, sed_wave_rest array<double>")
    assert meta.with_spectrum_header(header, grid).first().sed_wavelength_axis == "1"
    with pytest.raises(LayoutError, match="differs"):
        meta.with_spectrum_header(header, spark.createDataFrame([([1.0, 2.5],)], "wave_rest array<double>"))
    with pytest.raises(LayoutError, match="need a header"):
        meta.with_spectrum_header(header.where("false"), grid)


def test_names_collide_loudly(spark):
    cat = spark.createDataFrame([(1.0, 1.0)], "redshift double, mag_u double")
    lum = spark.createDataFrame([(1.0,)], "redshift float")
    phot = spark.createDataFrame([([1.0],)], "survey array<double>")
    with pytest.raises(LayoutError, match="mag_u"):
        projection.resolve_columns(cat, lum, phot, {"survey": ["u"]})
    with pytest.raises(LayoutError, match="mag_a_b"):
        projection.resolve_columns(lum, lum, phot, {"survey": ["a.b", "a-b"]})
    with pytest.raises(LayoutError, match="no band names"):
        projection.resolve_columns(lum, lum, phot, {})


def test_compression_advice(spark):
    rows = [(0, 0, True, 1.0, [1.0]), (65_535, 65_536, False, 2.0, [2.0])]
    df = spark.createDataFrame(rows, "narrow int, wide long, flag boolean, x double, h array<double>")
    advice = lambda d: {r.column: r.compress for r in storage.compress_advice(d).collect()}
    assert advice(df) == {"narrow": True, "wide": False, "flag": True, "x": False, "h": True}
    assert advice(df.where("false"))["narrow"] is False
    assert storage.chunk_shape(1000, 117, 8, 2400) == (100, 3) and storage.chunk_shape(5, None, 4, 1) == (1,) and storage.spectrum_shape(10, 7) == (10, 7)
    with pytest.raises(ValueError, match="codec"):
        storage.writer_options("rar")


def test_commands(spark, raw):
    args = ["--raw-root", str(raw / "raw"), "--bands", str(raw / "bands.json")]
    cli.main(["repartition", *args, "--verify"], spark)
    cli.main(["repartition", *args, "--n-partitions", "3", "--output-dir", str(raw / "r")], spark)
    cli.main(["spatial", "--level", "3", "--input-dir", str(raw / "r"), "--output-dir", str(raw / "s")], spark)
    with pytest.raises(LayoutError, match="header"):
        cli.main(["append", "--catalog-dir", str(raw / "s"), "--sed-dir", str(raw / "sed"), "--output-dir", str(raw / "a")], spark)
    cli.main(["header", "--source", str(raw / "donor"), "--target-dir", str(raw / "s")], spark)
    cli.main(["append", "--catalog-dir", str(raw / "s"), "--sed-dir", str(raw / "sed"), "--output-dir", str(raw / "a")], spark)
    cli.main(["convert", "--input-dir", str(raw / "sed"), "--output-dir", str(raw / "c")], spark)
    cli.main(["convert", "--input-dir", str(raw / "sed"), "--output-dir", str(raw / "c"), "--patch", "1", "--verify"], spark)
    cli.main(["header", "--source", str(raw / "donor"), "--target-dir", str(raw / "r"), "--first-step", "2"], spark)
    cli.main(["pipeline", *args, "--n-partitions", "3", "--level", "3", "--output-dir", str(raw / "p"), "--sed-dir", str(raw / "sed"), "--header-source", str(raw / "donor")], spark)
    pick = lambda folder: sorted(map(str, pipeline.read_catalogue(spark, str(raw / folder), True).select("partition_index", "output_row", "core_tag", "SED").collect()))
    assert pick("a") == pick("p")
    spectra_of = spark.read.parquet(str(raw / "c" / "seds_skypatch_0.parquet")).orderBy("source_global_row").collect()
    assert [r.core_tag for r in spectra_of] == [r[6] for r in catalog_rows() if r[0] == 0]
    assert sorted(r.file_step for r in snapshots.read(spark, str(raw / "r"), "header").collect()) == [2, 3, 4]
    with pytest.raises(LayoutError, match="same"):
        cli.main(["spatial", "--input-dir", str(raw / "r"), "--output-dir", str(raw / "r")], spark)


def _rewritten(spark, path, change):
    rows = change(spark.read.parquet(path))
    held = spark.createDataFrame(rows.collect(), rows.schema)
    held.coalesce(1).write.mode("overwrite").parquet(path)


@pytest.mark.parametrize(
    ("file", "change", "message"),
    [
        ("shards.parquet", lambda d: d.withColumn("complete", F.col("shard") == 0), "not complete"),
        ("seds_skypatch_1.shard1of2.parquet", lambda d: d.where("local_row <> 1"), "shard rows"),
        ("seds_skypatch_1.shard1of2.parquet", lambda d: d.withColumn("local_row", F.greatest("local_row", F.lit(1)).cast("long")), "shard rows"),
        ("wave_rest.parquet", lambda d: d.withColumn("wave_rest", F.slice("wave_rest", 1, 2)), "grids and widths"),
        ("wave_rest.parquet", lambda d: d.selectExpr("explode(array(0, 1)) patch", "wave_rest").selectExpr("patch", "explode(array(0, 1)) shard", "transform(wave_rest, x -> x + patch * shard) wave_rest"), "grids disagree"),
        ("seds_skypatch_1.shard1of2.parquet", lambda d: d.withColumn("core_tag", F.col("core_tag") + 1), "spectra are misaligned|identities differ"),
    ],
)
def test_every_run_checks_its_spectra(spark, raw, file, change, message):
    sed = str(raw / "sed")
    _rewritten(spark, f"{sed}/{file}", change)
    args = ["convert", "--input-dir", sed, "--output-dir", str(raw / "c"), "--raw-root", str(raw / "raw")]
    for more in ([], ["--verify"]):
        with pytest.raises(LayoutError, match=message):
            cli.main([*args, *more], spark)
    with pytest.raises(LayoutError, match=message):
        run(spark, raw)
    assert not layout.exists(spark, str(raw / "c")) and not layout.exists(spark, str(raw / "out"))


def test_counts_of_all_three_sources_are_compared(spark, raw):
    cli.main(["convert", "--input-dir", str(raw / "sed"), "--output-dir", str(raw / "c"), "--raw-root", str(raw / "raw"), "--verify"], spark)
    path = layout.patch_path(str(raw / "raw"), 1, "luminosities")
    _rewritten(spark, path, lambda d: d.where("source_global_row < 5"))
    with pytest.raises(LayoutError, match="row counts"):
        cli.main(["convert", "--input-dir", str(raw / "sed"), "--output-dir", str(raw / "c"), "--raw-root", str(raw / "raw")], spark)
    with pytest.raises(LayoutError, match="no luminosities"):
        layout_root = str(raw / "empty")
        spark.read.parquet(layout.patch_path(str(raw / "raw"), 0, "lightcone_catalogs")).write.parquet(layout.patch_path(layout_root, 0, "lightcone_catalogs"))
        cli.main(["convert", "--input-dir", str(raw / "sed"), "--output-dir", str(raw / "c"), "--raw-root", layout_root, "--patch", "0"], spark)


def test_missing_spectra_and_misaligned_repartition_are_refused(spark, raw):
    shards = pipeline.shard_table(spark, str(raw / "sed"))
    source = pipeline.spectra.concatenated(pipeline.read_shards(spark, str(raw / "sed")), shards)
    grids = pipeline.shard_grids(spark, str(raw / "sed"), shards)
    final = source.select("skypatch", "source_global_row", F.lit(0).alias("partition_index"), F.monotonically_increasing_id().alias("output_row"))
    assert pipeline.appended_spectra(final, source, shards, grids=grids)[0].where("SED is not null").count() == source.count()
    with pytest.raises(LayoutError, match="without a spectrum"):
        pipeline.appended_spectra(final, source.where("source_global_row <> 3"), shards, grids=grids)
    _rewritten(spark, layout.patch_path(str(raw / "raw"), 1, "luminosities"), lambda d: d.withColumn("redshift", F.col("redshift") + F.lit(1).cast("float")))
    with pytest.raises(LayoutError, match="misaligned"):
        cli.main(["repartition", "--raw-root", str(raw / "raw"), "--bands", str(raw / "bands.json"), "--n-partitions", "3", "--output-dir", str(raw / "r")], spark)


def test_failed_renames_restore_the_old_table(spark, tmp_path, monkeypatch):
    target = str(tmp_path / "t")
    pipeline.publish_one(spark.range(3), target)
    real, calls = pipeline._renamed, []

    def second_fails(system, a, b):
        calls.append((str(a), str(b)))
        return len(calls) != 2 and real(system, a, b)

    monkeypatch.setattr(pipeline, "_renamed", second_fails)
    with pytest.raises(LayoutError, match="could not take the place"):
        pipeline.publish_one(spark.range(5), target, overwrite=True)
    assert len(calls) == 3 and layout.listing(spark, str(tmp_path)) == ["t"] and spark.read.parquet(target).count() == 3
    monkeypatch.setattr(pipeline, "_renamed", lambda system, a, b: False)
    with pytest.raises(LayoutError, match="moved aside"):
        pipeline.publish_one(spark.range(5), target, overwrite=True)
    assert layout.listing(spark, str(tmp_path)) == ["t"] and spark.read.parquet(target).count() == 3


def test_three_folders_prefix_axes_and_staging(spark, raw):
    grids = spark.range(1).select(*[F.array_repeat(F.lit(1.0), n).alias(k) for k, n in layout.TIME_GRIDS.items()])
    grids.write.parquet(str(raw / "grids"))
    folders = ["--catalog-dir", str(raw / "raw/lightcone_catalogs"), "--luminosity-dir", str(raw / "raw/luminosities"), "--photometry-dir", str(raw / "raw/photometry")]
    args = [*folders, "--bands", str(raw / "bands.json"), "--n-partitions", "3", "--level", "2", "--prefix", "sky", "--time-grids", str(raw / "grids"), "--scratch-dir", str(raw / "scratch"), "--compression", "gzip"]
    cli.main(["pipeline", *args, "--patch", "0", "--keep-intermediates", "--output-dir", str(raw / "one")], spark)
    out = {t: snapshots.read(spark, str(raw / "one"), t) for t in ("data", "manifest", "axes")}
    rows = out["manifest"].collect()
    assert all(r.name.startswith("sky_") and (r.spatial_index_level, r.spatial_index_nside, list(r.skypatches)) == (2, 4, [0]) for r in rows)
    assert out["data"].count() == sum(GROUPS[0].values()) and out["axes"].schema["sfh_age_gyr"].metadata["unit"] == "Gyr"
    stored = [c for c in out["data"].columns if c != "partition_index"]
    assert stored == sorted(stored) and "SED" not in stored
    assert spark.read.parquet(str(raw / "scratch/skyloom_staging/places")).count() == out["data"].count()
    assert any(".gz.parquet" in f for f in out["data"].inputFiles())
    with pytest.raises(LayoutError, match="header"):
        cli.main(["pipeline", *args, "--sed-dir", str(raw / "sed"), "--output-dir", str(raw / "two")], spark)
    with pytest.raises(LayoutError, match="either"):
        cli.main(["pipeline", *args, "--raw-root", str(raw), "--output-dir", str(raw / "two")], spark)
    with pytest.raises(LayoutError, match="no folder"):
        cli.main(["pipeline", *folders[:4], "--output-dir", str(raw / "two")], spark)
    assert not layout.exists(spark, str(raw / "two")) and not [n for n in layout.listing(spark, str(raw)) if "staging" in n]
    spark.range(1).write.parquet(str(raw / "one/mine"))
    with pytest.raises(LayoutError, match="other things"):
        cli.main(["pipeline", *args, "--output-dir", str(raw / "one"), "--overwrite"], spark)


def test_partitions_that_are_done_are_skipped_and_failures_are_named(spark, raw, monkeypatch):
    args = ["--raw-root", str(raw / "raw"), "--bands", str(raw / "bands.json")]
    cli.main(["repartition", *args, "--n-partitions", "3", "--output-dir", str(raw / "r")], spark)
    real = pipeline.publish_parts

    def fails_on_one(df, target, *more, **named):
        if df.where("partition_index = 1").count():
            raise RuntimeError("disk of partition 1")
        return real(df, target, *more, **named)

    monkeypatch.setattr(pipeline, "publish_parts", fails_on_one)
    with pytest.raises(LayoutError, match="1 partitions failed: 1: disk"):
        pipeline.spatial_catalogue(spark, str(raw / "r"), str(raw / "s"), 3)
    table = lambda name: snapshots.read(spark, str(raw / "s"), name)
    record = lambda: sorted(r.partition_index for r in table("manifest").collect())
    assert record() == [0, 2]
    monkeypatch.setattr(pipeline, "publish_parts", real)
    assert pipeline.spatial_catalogue(spark, str(raw / "r"), str(raw / "s"), 3) == [1] and record() == [0, 1, 2]
    assert pipeline.spatial_catalogue(spark, str(raw / "r"), str(raw / "s"), 3) == []
    assert pipeline.spatial_catalogue(spark, str(raw / "r"), str(raw / "s"), 2, overwrite=True) == [0, 1, 2]
    assert {r.spatial_index_level for r in table("manifest").collect()} == {2}
    assert table("data").count() == len(catalog_rows()) and table("index").agg(F.max("level")).first()[0] == 2


def test_spectra_are_appended_in_place_with_a_status(spark, raw):
    args = ["--raw-root", str(raw / "raw"), "--bands", str(raw / "bands.json"), "--n-partitions", "2", "--level", "1", "--header-source", str(raw / "donor")]
    for patch in ("0", "1"):
        cli.main(["pipeline", *args, "--patch", patch, "--output-dir", str(raw / "all" / patch)], spark)
    sed = str(raw / "sed")
    _rewritten(spark, f"{sed}/shards.parquet", lambda d: d.withColumn("complete", F.col("patch") == 0))  # patch 1 is still being copied
    cli.main(["append", str(raw / "all/0"), "--sed-dir", sed, "--compression", "none", "--chunk-rows", "2"], spark)
    own = {t: snapshots.read(spark, str(raw / "all/0"), t) for t in ("data", "spectra", "manifest", "header")}
    assert own["spectra"].where("SED is null").count() == 0 and own["spectra"].schema["SED"].metadata["sed_format"] == "fnu_jy_obs_on_restgrid"
    assert own["spectra"].count() == own["data"].count()
    assert {(r.sed_append_complete, r.sed_append_source) for r in own["manifest"].collect()} == {(True, "raw spectrum shards")} and own["header"].first().sed_wave_rest == [1.0, 2.0, 3.0]
    with pytest.raises(LayoutError, match="spectra already"):
        cli.main(["append", "--catalog-dir", str(raw / "all/0"), "--sed-dir", sed], spark)
    with pytest.raises(LayoutError, match="not complete"):
        cli.main(["append", str(raw / "all/0"), "--catalog-dir", str(raw / "all"), "--sed-dir", sed, "--overwrite"], spark)
    with pytest.raises(LayoutError, match="one catalogue"):
        cli.main(["append", "--catalog-dir", str(raw / "all"), "--sed-dir", sed, "--output-dir", str(raw / "x")], spark)
    with pytest.raises(LayoutError, match="missing"):
        cli.main(["append", str(raw / "none"), "--sed-dir", sed], spark)
    assert [p.rsplit("/", 1)[1] for p in layout.final_paths(spark, str(raw / "all"))] == ["0", "1"]
    # headers: the source catalogue is skipped, steps count on over the others
    for k in ("2", "3"):
        for t in ("data", "manifest"):
            snapshots.read(spark, str(raw / "all/1"), t).write.parquet(str(raw / "all" / k / t))  # an older catalogue
    cli.main(["header", "--source", str(raw / "all/0"), "--target-dir", str(raw / "all"), "--first-step", "10"], spark)
    steps = [sorted(r.file_step for r in snapshots.read(spark, str(raw / "all" / k), "header").collect()) for k in "0123"]
    assert steps == [[0, 1], [0, 1], [10, 11], [12, 13]]


def test_wrong_spectra_are_refused(spark, raw):
    sed = str(raw / "sed")
    file = f"{sed}/seds_skypatch_0.shard0of2.parquet"
    good = spark.read.parquet(file)
    held = spark.createDataFrame(good.collect(), good.schema)
    convert = ["convert", "--input-dir", sed, "--output-dir", str(raw / "c"), "--compression", "gzip"]
    held.withColumn("SED", F.slice("SED", 1, 2)).write.mode("overwrite").parquet(file)
    with pytest.raises(Exception, match="is not 3 wide"):
        cli.main(convert, spark)
    assert not layout.listing(spark, str(raw / "c"))
    held.withColumn("SED", F.get("SED", F.lit(0))).write.mode("overwrite").parquet(file)
    with pytest.raises(LayoutError, match="not an array"):
        pipeline.spectra.require_datasets(spark.read.parquet(file))
    held.drop("core_tag").write.mode("overwrite").parquet(file)
    with pytest.raises(LayoutError, match="core_tag"):
        pipeline.spectra.require_datasets(spark.read.parquet(file))
    held.write.mode("overwrite").parquet(file)
    cli.main([*convert, "--patch", "0"], spark)
    told = spark.read.parquet(str(raw / "c/seds_skypatch_0.attributes.parquet")).first()
    assert (told.skypatch, told.n_objects, told.wave_rest) == (0, 16, [1.0, 2.0, 3.0])
    assert spark.read.parquet(str(raw / "c/seds_skypatch_0.parquet")).schema["SED"].metadata["unit"] == "Jy"


def test_bands_that_matrices_list_themselves(spark, raw):
    path = layout.patch_path(str(raw / "raw"), 0, "luminosities")
    for patch in GROUPS:
        path = layout.patch_path(str(raw / "raw"), patch, "luminosities")
        _rewritten(spark, path, lambda d: d)
        held = spark.read.parquet(path)
        spark.createDataFrame(held.collect(), held.schema).withMetadata("M_ABS_SDSS", {"bands": "u,i mag"}).write.mode("overwrite").parquet(path)
    found = run(spark, raw)["data"]
    assert {"M_ABS_SDSS_u", "M_ABS_SDSS_i"} <= set(found.columns) and "M_ABS_SDSS_g" not in found.columns


def test_one_scan_reads_all_patches(spark, raw):
    found = layout.read_kind(spark, str(raw / "raw"), "photometry", [0, 1])
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 1 and "Union" not in plan and {r.skypatch for r in found.collect()} == {0, 1}
    other = layout.patch_path(str(raw / "raw"), 1, "photometry")
    _rewritten(spark, other, lambda d: d.withColumn("more", F.lit(1)))
    with pytest.raises(LayoutError, match="more int"):
        layout.read_kind(spark, str(raw / "raw"), "photometry", [0, 1])


def test_empty_patches_are_refused(spark, raw):
    for kind in layout.KINDS:
        _rewritten(spark, layout.patch_path(str(raw / "raw"), 1, kind), lambda d: d.where("false"))
    with pytest.raises(LayoutError, match="without rows"):
        run(spark, raw)


def test_key_sets_are_compared_without_a_cross_join(spark, monkeypatch):
    listed = spark.createDataFrame([(g, k) for g, ks in {"a": "xyz", "b": "xyz", "c": "yw", "d": ""}.items() for k in ks], "grp string, key string")
    found = projection.group_key_difference(listed)
    want = [("c", "w", "extra"), ("c", "x", "missing"), ("c", "z", "missing")]
    assert sorted(map(tuple, found.collect())) == want and "NestedLoop" not in found._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(projection, "NAMED_GROUPS", 0)
    assert sorted(map(tuple, projection.group_key_difference(listed).collect())) == want


def test_page_shapes(spark):
    schema = spark.createDataFrame([], "SED array<float>, sfh array<double>, x float").schema
    assert storage.page_rows(schema, {"SED": 1000, "sfh": 117}, 10_000) == 64
    assert storage.page_rows(spark.createDataFrame([], "x float, y tinyint").schema, {}, 1 << 30, 1 << 20) == 1 << 18


def test_hdf5_needs_its_library(spark):
    try:
        import h5py  # noqa: F401
    except ImportError:
        with pytest.raises(RuntimeError, match="h5py"):
            hdf5.register(spark)
