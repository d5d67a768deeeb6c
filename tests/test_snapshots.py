"""Tables that change together, proofs of losslessness, plans that read little."""

import json
import shutil

import pytest
from pyspark.sql import functions as F

from skyloom.errors import LayoutError
from skyloom.operators import checks, fingerprint, meta, rows, spatial, spectra, tree
from skyloom.plans import cli, pipeline
from skyloom.sources import layout, snapshots
from tests.test_pipeline import catalog_rows, raw, run  # noqa: F401


def table(spark, n):
    return spark.range(n).withColumn("partition_index", (F.col("id") % 2).cast("int"))


def test_states_follow_each_other(spark, tmp_path):
    root = str(tmp_path / "c")
    pipeline.publish(spark, root, {"data": (table(spark, 4), ("partition_index",), None), "manifest": (spark.range(1), (), None)}, {})
    first = snapshots.state(spark, root)
    assert first[0] == 1 and snapshots.read(spark, root, "data").count() == 4 and snapshots.is_catalogue(spark, root)
    pipeline.changed(spark, root, {"manifest": (spark.range(2), (), None)})
    number, second = snapshots.state(spark, root)
    assert number == 2 and second["data"] == first[1]["data"] and snapshots.read(spark, root, "manifest").count() == 2
    assert snapshots.read(spark, root, "manifest", first[1]).count() == 1  # a reader that opened the state before
    with pytest.raises(LayoutError, match="another writer"):
        snapshots.commit(spark, root, 1, first[1])
    pipeline.changed(spark, root, {"manifest": (spark.range(3), (), None)})
    assert not layout.exists(spark, f"{root}/{first[1]['manifest'][0][0]}")  # two states are kept
    with pytest.raises(LayoutError, match="no table"):
        snapshots.read(spark, root, "axes")
    assert layout.final_paths(spark, str(tmp_path)) == [root]


def test_partitions_are_replaced_one_by_one(spark):
    old = snapshots.merged([], "data.a", ["partition_index=0", "partition_index=1"], [])
    new = snapshots.merged(old, "data.b", ["partition_index=1", "partition_index=2"], ["partition_index=1", "partition_index=2"])
    assert new == [["data.a", ["partition_index=0"]], ["data.b", ["partition_index=1", "partition_index=2"]]]
    assert snapshots.merged(new, "data.c", [], ["partition_index=0"]) == new[1:]


class Killed(BaseException):
    """Ends a writer where it stands: no cleaning up."""


def test_a_killed_append_leaves_the_old_catalogue(spark, raw, monkeypatch):  # noqa: F811
    """After any write before the commit readers see the catalogue without spectra; a rerun completes."""
    pipeline.run(spark, str(raw / "raw"), str(raw / "first"), str(raw / "bands.json"), n_partitions=2, level=1, header_path=str(raw / "donor"))
    real = pipeline._written
    for step in range(4):
        out, calls = str(raw / f"out{step}"), []
        shutil.copytree(raw / "first", out)
        before = snapshots.state(spark, out)
        files = sorted(snapshots.read(spark, out, "data").inputFiles())

        def writes(*a, calls=calls, step=step, **k):
            if len(calls) == step:
                raise Killed
            calls.append(1)
            real(*a, **k)

        def commits(*a):
            raise Killed

        monkeypatch.setattr(pipeline, "_written", writes)
        if step == 3:
            monkeypatch.setattr(snapshots, "commit", commits)
        with pytest.raises(Killed):
            pipeline.append_catalogue(spark, out, str(raw / "sed"))
        assert snapshots.state(spark, out) == before
        assert not snapshots.has(spark, out, "spectra") and "sed_append_complete" not in snapshots.read(spark, out, "manifest").columns
        monkeypatch.undo()
        if step not in (1, 3):
            continue
        pipeline.append_catalogue(spark, out, str(raw / "sed"))
        assert sorted(snapshots.read(spark, out, "data").inputFiles()) == files  # not rewritten
        whole = pipeline.read_catalogue(spark, out, with_spectra=True)
        assert whole.count() == len(catalog_rows()) and whole.where("SED[0] <> core_tag").count() == 0
        known = {f for folders in snapshots.state(spark, out)[1].values() for f, _ in folders} | {f for folders in before[1].values() for f, _ in folders}
        assert set(layout.listing(spark, out)) == known | {snapshots.FOLDER}  # what the killed writer left is gone
    with pytest.raises(LayoutError, match="spectra already"):
        pipeline.append_catalogue(spark, out, str(raw / "sed"))


def test_a_failed_first_write_leaves_nothing(spark, tmp_path):
    root = str(tmp_path / "new")
    with pytest.raises(Exception, match="no"):
        pipeline.publish(spark, root, {"manifest": (spark.range(1), (), None), "data": (spark.range(2).select(F.raise_error(F.lit("no")).alias("partition_index")), (), None)}, {})
    assert not layout.exists(spark, root)


def test_an_older_catalogue_is_read_and_changed(spark, tmp_path):
    root = str(tmp_path / "old")
    table(spark, 3).write.partitionBy("partition_index").parquet(f"{root}/data")
    spark.range(1).write.parquet(f"{root}/manifest")
    assert snapshots.read(spark, root, "data").count() == 3
    pipeline.changed(spark, root, {"manifest": (spark.range(5), (), None)})
    assert snapshots.read(spark, root, "data").count() == 3 and snapshots.read(spark, root, "manifest").count() == 5


def test_regions_are_read_from_a_catalogue(spark, raw):  # noqa: F811
    run(spark, raw)
    from skyloom.operators import regions

    region = regions.cone(100.0, 0.0, 60.0)
    found = pipeline.read_region(spark, str(raw / "out"), region, with_spectra=True).collect()
    every = pipeline.read_catalogue(spark, str(raw / "out")).where(regions.inside(region)).collect()
    assert sorted(r.core_tag for r in found) == sorted(r.core_tag for r in every) and 0 < len(found) < len(catalog_rows())
    assert all(r.SED == [r.core_tag] * 3 for r in found)


# --- losslessness ---------------------------------------------------------


def test_fingerprints_tell_rows_apart(spark):
    a = spark.createDataFrame([(1, None, [1.0]), (None, 1, [2.0]), (3, 3, None)], "x int, y int, v array<double>")
    sums = lambda d: fingerprint.of(d, ["x", "y", "v"])
    assert sums(a) == sums(a.repartition(3).orderBy("y"))
    assert sums(a) == sums(a.withColumn("x", F.col("x").cast("long")))
    for other in (a.select(F.col("y").alias("x"), F.col("x").alias("y"), "v"), a.unionByName(a.limit(1)), a.where("x is not null"), a.withColumn("v", F.lit(None).cast("array<double>"))):
        assert sums(a) != sums(other)
    assert sums(a.where("false"))["n"] == 0


def test_one_swapped_value_fails_the_run(spark, raw, monkeypatch):  # noqa: F811
    """Two rows exchange one value of one source: every count still holds, the proof does not."""
    real = pipeline.rows.positional_join

    def swapped(*parts, **named):
        own = F.when(F.col("source_global_row") == 0, 1).when(F.col("source_global_row") == 1, 0).otherwise(F.col("source_global_row"))
        wrong = parts[2].withColumn("source_global_row", F.when(F.col("skypatch") == 0, own).otherwise(F.col("source_global_row")))
        return real(parts[0], parts[1], wrong, *parts[3:], **named)

    monkeypatch.setattr(pipeline.rows, "positional_join", swapped)
    with pytest.raises(LayoutError, match="photometry"):
        run(spark, raw)
    assert not layout.exists(spark, str(raw / "out"))


def test_a_lost_row_fails_the_run(spark, raw, monkeypatch):  # noqa: F811
    real = pipeline.in_files
    monkeypatch.setattr(pipeline, "in_files", lambda d, *a: real(d.where("source_global_row <> 2") if "core_tag" in d.columns else d, *a))
    with pytest.raises(LayoutError, match="rows written differ"):
        run(spark, raw)


def test_the_payload_is_computed_once(spark):
    """No pass samples the rows before they go to their files."""
    seen = spark.sparkContext.accumulator(0)
    count = F.udf(lambda x: seen.add(1) or x, "long").asNondeterministic()
    df = spark.range(5000).select((F.col("id") % 3).cast("int").alias("partition_index"), F.floor(F.col("id") / 3).cast("long").alias("output_row"), count("id").alias("x"))
    found = spatial.in_file_order(df, {0: 1667, 1: 1667, 2: 1666}, files=8)
    parts = found.select("partition_index", "output_row", F.spark_partition_id().alias("p"), "x")
    rows_ = [tuple(r) for r in parts.collect()]
    assert seen.value == 5000 and len(rows_) == 5000
    assert [r[:2] for r in rows_] == sorted(r[:2] for r in rows_)  # in order over all files
    sizes = {}
    for r in rows_:
        sizes[r[2]] = sizes.get(r[2], 0) + 1
    assert max(sizes.values()) <= 625 and len({(r[2], r[0]) for r in rows_}) == len(sizes)


# --- plans ----------------------------------------------------------------


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_sampled_checks_scan_without_a_shuffle(spark, tmp_path, monkeypatch):
    """What is looked up for a few sampled rows is filtered in its scan by the broadcast sample."""
    wide = spark.range(3000).select(F.lit(0).alias("skypatch"), F.col("id").alias("source_global_row"), F.col("id").alias("core_tag"), (F.col("id") / 10).alias("redshift"), F.lit(0).alias("partition_index"), F.col("id").alias("output_row"), F.concat(F.lit("core_"), (F.col("id") % 5).cast("string")).alias("core_group"))
    wide.write.parquet(str(tmp_path / "w"))
    wide = spark.read.parquet(str(tmp_path / "w"))
    looked_up = []
    real = rows.bounded_broadcast
    for module in (rows, spectra, checks):
        monkeypatch.setattr(module, "bounded_broadcast", lambda df, *a: looked_up.append(df) or real(df, *a))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shards = spark.createDataFrame([(0, 0, 0, 3000, 3000)], "patch int, shard int, row_offset long, n_rows long, n_global long")
        found = [spectra.identity_violations(wide, wide), spectra.source_violations(wide, wide, wide, shards), checks.endpoint_differences(wide, wide), checks.verify_report(wide, wide)]
        assert all(f.count() == 0 for f in found[:3])
        scans = [d for d in looked_up if "FileScan" in d._jdf.queryExecution().executedPlan().toString() and "HashAggregate" not in d._jdf.queryExecution().executedPlan().toString() and "ObjectHashAggregate" not in d._jdf.queryExecution().executedPlan().toString()]
        assert len(scans) >= 7 and all(exchanges(d) == 0 for d in scans)
        assert all("FileScan" not in f._jdf.queryExecution().executedPlan().toString() for f in found[:3])
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("limit", [1 << 17, 3])
def test_intervals_meet_by_cells(spark, monkeypatch, limit):
    """Equal joins by (patch, cell) at any number of spans: short and very long ones, empty ones and gaps."""
    monkeypatch.setattr(rows.bounded_broadcast, "__defaults__", (limit,))
    spans = [(0, "a", 0, 1), (0, "b", 1, 1), (0, "c", 1, 700), (0, "d", 700, 703), (1, "a", 5, 6), (1, "z", 10, 5000)]
    offsets = spark.createDataFrame([(p, g, a, b - a) for p, g, a, b in spans], "skypatch int, core_group string, row_offset long, n_rows long")
    own = [(p, r) for p in (0, 1, 2) for r in (*range(0, 720, 7), 1, 699, 702, 4999, 5000)]
    found = rows.group_of_rows(spark.createDataFrame(own, "skypatch int, source_global_row long"), offsets)
    want = sorted((p, r, g, r - a) for p, r in own for q, g, a, b in spans if p == q and a <= r < b)
    assert sorted(map(tuple, found.collect())) == want
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "_cell" in plan and ("SortMergeJoin" in plan or limit > 3)


# --- nested headers -------------------------------------------------------


def donor(spark):
    return spark.sql("select struct(9.0D as redshift, 3L as step, 'run \"7\"' as origin) as file, struct(array(0.0D, 9.0D) as z_range, struct(array('a','b') as names, cast(null as string) as note) as deep) as lightcone, 1.5D as version")


def test_a_nested_donor_arrives_whole(spark, raw):  # noqa: F811
    donor(spark).write.parquet(str(raw / "nested"))
    pipeline.run(spark, str(raw / "raw"), str(raw / "out"), str(raw / "bands.json"), n_partitions=3, level=1, sed_root=str(raw / "sed"), header_path=str(raw / "nested"), first_step=5)
    header = snapshots.read(spark, str(raw / "out"), "header")
    assert {r.n for r in header.groupBy("partition_index").agg(F.count("path").alias("n")).collect()} == {10 + 1 + len(meta.SPECTRUM_HEADER)}
    value = lambda path, kind, part: tree.value_of(header, path, kind, partition_index=part)
    assert value("file/origin", "string", 1) == 'run "7"' and value("lightcone/deep/names", "array<string>", 2) == ["a", "b"] and value("lightcone/deep/note", "string", 0) is None
    assert [value("file/step", "bigint", p) for p in range(3)] == [5, 6, 7] and value("version", "double", 0) == 1.5
    assert value("sed_wave_rest", "array<double>", 2) == [1.0, 2.0, 3.0] and value("sed_flux_unit", "string", 0) == "Jy"
    manifest = {r.partition_index: r for r in snapshots.read(spark, str(raw / "out"), "manifest").collect()}
    assert value("lightcone/z_range", "array<double>", 1) == [manifest[1].z_min, manifest[1].z_max]
    # and from one catalogue to another, steps counting on
    pipeline.run(spark, str(raw / "raw"), str(raw / "two"), str(raw / "bands.json"), n_partitions=2, level=1)
    assert pipeline.header_catalogues(spark, str(raw / "out"), [str(raw / "two"), str(raw / "out")], first_step=20) == 2
    copied = snapshots.read(spark, str(raw / "two"), "header")
    assert [tree.value_of(copied, "file/step", "bigint", partition_index=p) for p in (0, 1)] == [20, 21]
    assert tree.value_of(copied, "lightcone/deep/names", "array<string>", partition_index=1) == ["a", "b"]
    with pytest.raises(LayoutError, match="differs"):
        meta.with_spectrum_header(header, spark.createDataFrame([([7.0],)], "wave_rest array<double>"))


def test_trees_are_counted_and_checked(spark):
    rows_ = tree.rows_of(donor(spark))
    assert tuple(tree.census(rows_).first()) == (3, 2, 5)
    assert tree.rows_of(rows_).collect() == rows_.collect() and tree.problems(rows_).count() == 0
    bad = rows_.where("path <> 'lightcone/deep'").unionByName(rows_.where("path = 'version'"))
    assert sorted(map(tuple, tree.problems(bad).collect())) == [("lightcone/deep/names", "has no group"), ("lightcone/deep/note", "has no group"), ("version", "is there twice")]
    targets = spark.createDataFrame([(0, False, True), (1, False, False)], "partition_index int, is_source boolean, has_header boolean")
    found = meta.specialised_headers(targets, donor(spark), None, None).collect()
    assert [r.path for r in found if r.skipped] == [None] and len([r for r in found if not r.skipped]) == 10
    assert all(len(r.warnings) == 2 for r in found if not r.skipped)
    plain = meta.specialised_headers(targets, rows_.where("path not like 'file%'"), spark.createDataFrame([(1, 2.0)], "partition_index int, redshift double"), None, replace=True)
    assert "header has no group file" in plain.first().warnings and json.loads(plain.where("path = 'lightcone/z_range'").first()["value"]) == [0.0, 9.0]


# --- staged sources -------------------------------------------------------


def test_staged_sources_join_without_an_exchange(spark, raw):  # noqa: F811
    """Runs on staged sources give the same catalogue, and the join moves places only."""
    bands = ["--bands", str(raw / "bands.json"), "--n-partitions", "3", "--level", "2"]
    cli.main(["stage", "--raw-root", str(raw / "raw"), "--output-dir", str(raw / "staged"), "--buckets", "5"], spark)
    with pytest.raises(LayoutError, match="already"):
        cli.main(["stage", "--raw-root", str(raw / "raw"), "--output-dir", str(raw / "staged")], spark)
    cli.main(["pipeline", "--raw-root", str(raw / "staged"), *bands, "--output-dir", str(raw / "a")], spark)
    cli.main(["pipeline", "--raw-root", str(raw / "raw"), *bands, "--output-dir", str(raw / "b")], spark)
    a, b = (snapshots.read(spark, str(raw / k), "data") for k in "ab")
    assert a.columns == b.columns and sorted(map(str, a.collect())) == sorted(map(str, b.select(*a.columns).collect()))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        catalog, lum, phot, _, chosen = pipeline.opened(spark, str(raw / "staged"))
        assert chosen == [0, 1] and len(catalog.inputFiles()) <= 5
        joined = rows.positional_join(catalog.drop("redshift"), lum, phot)
        text = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in text and "Exchange" not in text and joined.count() == len(catalog_rows())
        places = catalog.select("skypatch", "source_global_row", F.lit(1).alias("place")).repartition(3)
        text = joined.join(places, ["skypatch", "source_global_row"])._jdf.queryExecution().executedPlan().toString()
        assert all("place" in line for line in text.splitlines() if "Exchange hashpartitioning" in line) or text.count("Exchange hashpartitioning") == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    one = pipeline.opened(spark, str(raw / "staged"), [1])
    assert one[4] == [1] and one[0].count() == 6
