import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyloom.errors import LayoutError
from skyloom.functions import arrays, healpix, names, numeric
from skyloom.operators import rows, spatial
from skyloom.streaming.assign import assign


def test_groups_go_in_string_order(spark):
    cat = spark.createDataFrame([(0, g, i) for g in ("core_1", "core_2", "core_8", "core_10") for i in range(2)], "skypatch int, core_group string, row_in_group long")
    got = rows.number_rows(cat).orderBy("source_global_row").collect()
    assert [r.core_group for r in got][::2] == ["core_1", "core_10", "core_2", "core_8"]
    assert [r.source_global_row for r in got] == list(range(8))
    dense = rows.number_dense_rows(cat)
    assert sorted(map(tuple, dense.collect())) == sorted(map(tuple, rows.number_rows(cat).select(dense.columns).collect()))


def test_numbering_in_small_buckets(spark):
    cat = spark.createDataFrame([(i % 2, f"core_{i % 3}", i * 7) for i in range(100)], "skypatch int, core_group string, row_in_group long")
    a, b = (sorted(map(tuple, rows.number_rows(cat, bucket_rows=n).select("skypatch", "core_group", "row_in_group", "source_global_row").collect())) for n in (10, 1 << 20))
    assert a == b


@pytest.mark.parametrize(("n", "k"), [(0, 16), (1, 16), (5, 16), (17, 16), (1000, 16), (10, 1)])
def test_samples_equal_numpy(spark, n, k):
    want = np.unique(np.linspace(0, n - 1, min(k, n), dtype=np.int64)).tolist() if n else []
    assert rows.sample_positions(n, k) == want
    got = rows.sample_rows(spark.createDataFrame([(n,)], "n_rows long"), k)
    assert sorted(r.sample_row for r in got.collect()) == want


def centre(pix, level):
    """Centre of a nested pixel, by the public formulas."""
    ns = 1 << level
    face, inside = divmod(pix, ns * ns)
    x = sum(((inside >> (2 * b)) & 1) << b for b in range(level))
    y = sum(((inside >> (2 * b + 1)) & 1) << b for b in range(level))
    ring = (face // 4 + 2) * ns - x - y - 1
    if ring < ns:
        nr, z, shift = ring, 1 - ring * ring / (3 * ns * ns), 0
    elif ring > 3 * ns:
        nr = 4 * ns - ring
        z, shift = -1 + nr * nr / (3 * ns * ns), 0
    else:
        nr, z, shift = ns, (2 * ns - ring) * 2 / (3 * ns), (ring - ns) & 1
    start = (1, 3, 5, 7, 0, 2, 4, 6, 1, 3, 5, 7)[face]
    jp = (start * nr + x - y + 1 + shift) // 2
    jp = (jp - 1) % (4 * ns) + 1
    phi = (jp - (shift + 1) * 0.5) * (math.pi / 2 / nr)
    return math.degrees(phi) % 360, math.degrees(math.asin(z))


@pytest.mark.parametrize("level", [0, 1, 3])
def test_pixel_centres_come_back(spark, level):
    made = [(p, *centre(p, level)) for p in range(healpix.pixel_count(level))]
    df = healpix.add_pixel(spark.createDataFrame(made, "want long, ra double, dec double"), "ra", "dec", level)
    assert df.where("pixel <> want or pixel is null").count() == 0


def test_pixels_nest_and_stay_in_range(spark):
    edge = [(0.0, 90.0), (360.0, 90.0), (0.0, -90.0), (360.0, 0.0), (0.0, 0.0), (359.999999, 41.81)]
    df = spark.createDataFrame([(float(r), float(d)) for r, d in edge], "ra double, dec double")
    for level in (5, 13):
        df = healpix.add_pixel(df, "ra", "dec", level, f"p{level}")
    got = df.collect()
    assert all(0 <= r.p5 < healpix.pixel_count(5) and r.p13 >> 16 == r.p5 for r in got)
    bad = healpix.add_pixel(spark.createDataFrame([(1.0, 91.0), (math.nan, 0.0), (None, 0.0), (1.0, None)], "ra double, dec double"), "ra", "dec", 3)
    assert [r.pixel for r in bad.collect()] == [None] * 4
    with pytest.raises(LayoutError):
        healpix.checked_level(14)


def test_index_invariants(spark):
    level = 3
    df = spark.range(500).select((F.col("id") % 2).cast("int").alias("partition_index"), F.col("id").alias("input_row"), (F.col("id") * 7.7 % 360).alias("ra"), (F.col("id") * 0.37 % 180 - 90).alias("dec"))
    placed = spatial.with_pixel(df, level)
    index = spatial.sparse_index(placed, level)
    assert {r["s"] for r in index.groupBy("partition_index", "level").agg(F.sum("size").alias("s")).collect()} == {250}
    dense = spatial.dense_index(index, level).where("partition_index = 0").orderBy("pixel").collect()
    assert len(dense) == healpix.pixel_count(level) and dense[-1].start + dense[-1]["size"] == 250
    assert all(a.start + a["size"] == b.start for a, b in zip(dense, dense[1:], strict=False))
    ordered = spatial.ordered_rows(placed).where("partition_index = 0").orderBy("output_row").collect()
    assert [r.output_row for r in ordered] == list(range(250))
    assert [(r.pixel, r.input_row) for r in ordered] == sorted((r.pixel, r.input_row) for r in ordered)
    for r in dense:  # the index addresses the ordered rows
        assert {x.pixel for x in ordered[r.start : r.start + r["size"]]} <= {r.pixel}
    low, high = healpix.range_of(5, 1, level)
    assert placed.where(spatial.in_region(F.col("pixel"), 5, 1, level)).count() == sum(low <= r.pixel <= high for r in placed.collect())


def test_names():
    assert [names.sanitized_band(b) for b in ("u.txt", "a.b-c", "x.txt.txt")] == ["u", "a_b_c", "x_txt"]
    assert names.listed_bands(b"g,r trailing words", []) == ["g", "r"] and names.listed_bands(None, ["z"]) == ["z"]
    seen = {}
    names.check_new_names(seen, "a", "x")
    with pytest.raises(LayoutError):
        names.check_new_names(seen, "a", "y")


def test_group_numbers_must_be_numbers(spark):
    assert spark.createDataFrame([("core_12",)], "g string").select(names.group_number(F.col("g"))).first()[0] == 12
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        spark.createDataFrame([("core_x",)], "g string").select(names.group_number(F.col("g"))).collect()


def test_numeric_rules(spark):
    values = [0.5, 1.5, 2.5, 0.125, 0.375, -0.005, 1.005, 2.675]
    got = spark.createDataFrame([(v,) for v in values], "x double").select(numeric.round_half_even(F.col("x"), 2)).collect()
    assert [r[0] for r in got] == [float(np.round(v, 2)) for v in values]
    pairs = [(1.0, 1.0 + 1e-7), (math.nan, math.nan), (math.inf, math.inf), (math.inf, -math.inf), (None, 1.0)]
    got = spark.createDataFrame(pairs, "a double, b double").select(numeric.is_close(F.col("a"), F.col("b"), 1e-6)).collect()
    assert [r[0] for r in got] == [True, False, True, False, False]
    grids = [([1.0, 2.0], [1.0, 2.0]), ([1.0], [1.0, 2.0]), ([math.nan], [math.nan])]
    got = spark.createDataFrame(grids, "a array<double>, b array<double>").select(arrays.equal_arrays(F.col("a"), F.col("b"))).collect()
    assert [r[0] for r in got] == [True, False, False]


def test_stream_assignment_equals_batch(spark, tmp_path):
    df = spark.range(50).select((F.col("id") / 25).alias("redshift"), (F.col("id") * 7.0).alias("ra"), (F.col("id") - 25.0).alias("dec"))
    df.write.parquet(str(tmp_path / "in"))
    edges = [0.0, 0.5, 1.0, 2.0]
    stream = assign(spark.readStream.schema(df.schema).parquet(str(tmp_path / "in")), edges, 4)
    q = stream.writeStream.format("memory").queryName("assigned").start()
    try:
        q.processAllAvailable()
        assert sorted(map(tuple, spark.table("assigned").collect())) == sorted(map(tuple, assign(df, edges, 4).collect()))
    finally:
        q.stop()


def test_rows_without_a_place_are_refused(spark):
    schema = "skypatch int, core_group string, row_in_group long"
    for bad in ((None, "core_1", 0), (0, None, 0), (0, "core_1", None)):
        with pytest.raises(LayoutError, match="no place"):
            rows.number_rows(spark.createDataFrame([(0, "core_1", 5), bad], schema))


def test_places_and_pixel_order_in_small_buckets(spark):
    made = [(i % 3, i % 2, (i * 37) % 200, (i * 7) % 5) for i in range(200)]
    df = spark.createDataFrame(made, "partition_index int, skypatch int, source_global_row long, pixel long")
    placed = rows.with_place(df, ["partition_index"], ["skypatch"], "source_global_row", bucket_rows=9)
    for bucket in (7, 1 << 20):
        got = spatial.ordered_rows(placed, bucket_rows=bucket).collect()
        for p in range(3):
            own = [r for r in got if r.partition_index == p]
            by_row = sorted(own, key=lambda r: (r.skypatch, r.source_global_row))
            assert [r.input_row for r in by_row] == list(range(len(own)))
            assert [r.output_row for r in sorted(own, key=lambda r: (r.pixel, r.input_row))] == list(range(len(own)))


def ring_of(nested, level):
    """Ring number of a nested pixel, by the published index formulas."""
    ns = 1 << level
    face, inside = divmod(nested, ns * ns)
    x = sum(((inside >> (2 * b)) & 1) << b for b in range(level))
    y = sum(((inside >> (2 * b + 1)) & 1) << b for b in range(level))
    ring = (face // 4 + 2) * ns - x - y - 1
    if ring < ns:
        nr, before, shift = ring, 2 * ring * (ring - 1), 0
    elif ring > 3 * ns:
        nr = 4 * ns - ring
        before, shift = 12 * ns * ns - 2 * nr * (nr + 1), 0
    else:
        nr, before, shift = ns, 2 * ns * (ns - 1) + (ring - ns) * 4 * ns, (ring - ns) & 1
    along = ((1, 3, 5, 7, 0, 2, 4, 6, 1, 3, 5, 7)[face] * nr + x - y + 1 + shift) // 2
    return before + (along - 1) % (4 * nr if nr < ns else 4 * ns)


def test_published_pixel_numbers(spark):
    """Ring numbers of nside 16 that the documentation of the public library prints, and poles and seams of other sides."""
    quarter, half = 45.0, 90.0
    known = [(4, 0.0, 90.0 - half, 1440), (4, quarter, 90.0 - quarter, 427), (4, half, 90.0 - half, 1520), (4, 0.0, 90.0, 0), (4, 0.0, -90.0, 3068)]
    known += [(0, 45.0, 90.0, 0), (0, 45.0, -90.0, 8), (0, 0.0, 0.0, 4), (1, 45.0, 80.0, 0), (13, 45.0, 90.0, 0), (13, 315.0, -90.0, 12 * 4**13 - 1)]
    for level, ra, dec, ring in known:
        for turn in (0.0, 360.0):
            df = spark.createDataFrame([(ra + turn, dec)], "ra double, dec double")
            assert ring_of(healpix.add_pixel(df, "ra", "dec", level).first().pixel, level) == ring, (level, ra, dec)
