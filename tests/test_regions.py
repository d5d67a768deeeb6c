"""Reads by sky region: covers, slices, pruned files."""

import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from skyloom.errors import LayoutError
from skyloom.functions import healpix
from skyloom.operators import regions, rows, spatial


def test_directions_are_inside_their_pixels(spark):
    """Places inside pixels, whose pixel the engine's own arithmetic gives back."""
    dice = np.random.default_rng(2)
    for level in (0, 1, 4, 9):
        pix = np.unique(dice.integers(0, healpix.pixel_count(level), 60))
        made = []
        for dx, dy in ((0.5, 0.5), (0.02, 0.03), (0.97, 0.5), (0.4, 0.98)):
            x, y, z = regions.directions(pix, level, dx, dy).T
            made += list(zip(pix.tolist(), np.degrees(np.arctan2(y, x)).tolist(), np.degrees(np.arcsin(z)).tolist(), strict=True))
        df = spark.createDataFrame(made, "own long, ra double, dec double")
        assert healpix.add_pixel(df, "ra", "dec", level).where("own <> pixel").count() == 0


def test_a_pixel_lies_in_its_circle():
    """Corners are a pixel's farthest places, also where its sides bend."""
    for level in (0, 1, 2, 5):
        pix = np.arange(min(healpix.pixel_count(level), 3000), dtype=np.int64)
        reach = lambda places: np.max([regions._angle(regions.directions(pix, level), regions.directions(pix, level, a, b)) for a in places for b in places], axis=0)
        assert np.all(reach(np.linspace(0, 1, 9)) <= reach((0, 1)) * (1 + 1e-9))


def plain_inside(region, ra, dec):
    v = regions.vector(ra, dec)
    return np.all([regions._angle(v, regions.vector(c.ra, c.dec)) <= math.radians(c.angle) for c in region], axis=0)


@settings(max_examples=60, deadline=None)
@given(st.floats(0, 360), st.floats(-90, 90), st.floats(0, 180), st.integers(0, 6), st.sampled_from([8, 64, 4096]))
def test_a_cover_holds_its_disc(ra, dec, radius, level, most):
    region = regions.cone(ra, dec, radius)
    ranges = regions.cover(region, level, most)
    assert all(a <= b for a, b in ranges) and all(x[1] + 1 < y[0] for x, y in zip(ranges, ranges[1:], strict=False)) and len(ranges) <= max(most, 12)
    pix = np.arange(healpix.pixel_count(level), dtype=np.int64)
    held = np.zeros(len(pix), bool)
    for a, b in ranges:
        held[a : b + 1] = True
    for dx, dy in ((0.5, 0.5), (0.01, 0.01), (0.99, 0.3)):
        x, y, z = regions.directions(pix, level, dx, dy).T
        assert np.all(held[plain_inside(region, np.degrees(np.arctan2(y, x)), np.degrees(np.arcsin(z)))])


def test_covers_are_narrow():
    area = lambda ranges, level: sum(b - a + 1 for a, b in ranges) / healpix.pixel_count(level)
    disc = (1 - math.cos(math.radians(5))) / 2
    assert disc < area(regions.cover(regions.cone(10, 20, 5), 8), 8) < 1.2 * disc
    assert regions.cover(regions.cone(0, 0, 180), 4) == [(0, healpix.pixel_count(4) - 1)]
    assert len(regions.joined([(0, 1), (3, 4), (10, 11), (12, 20)], 2)) == 2 and regions.joined([], 4) == []


def test_bad_regions_are_refused():
    for bad in (lambda: regions.cone(0, 91, 1), lambda: regions.cone(0, 0, -1), lambda: regions.polygon([(0, 0), (1, 1)]), lambda: regions.polygon([(0, 0), (10, 0), (2, 2), (0, 10)])):
        with pytest.raises(LayoutError):
            bad()


def sky(spark, n=4000):
    dice = np.random.default_rng(7)
    made = [(i % 3, i, float(r), float(d)) for i, (r, d) in enumerate(zip(dice.uniform(0, 360, n), np.degrees(np.arcsin(dice.uniform(-1, 1, n))), strict=True))]
    made += [(0, n, 200.0, 90.0), (1, n + 1, 10.0, -90.0), (2, n + 2, 0.0, 0.0), (2, n + 3, 359.9999, 0.0)]
    return made, spark.createDataFrame(made, "partition_index int, input_row long, ra double, dec double")


@pytest.mark.parametrize("region", [regions.cone(0, 0, 10), regions.cone(123, 89, 5), regions.cone(200, -40, 0.5), regions.cone(30, 30, 100), regions.polygon([(350, -10), (10, -8), (12, 9), (355, 11)]), regions.polygon([(20, 60), (140, 62), (260, 58)])])
def test_slices_and_the_exact_test_give_the_region(spark, region):
    made, df = sky(spark)
    placed = rows.checkpointed(spatial.ordered_rows(spatial.with_pixel(df, 5)))
    index = spatial.sparse_index(placed, 5)
    found = regions.select(placed, index, region, 5)
    want = [m[1] for m in made if plain_inside(region, m[2], m[3])]
    assert sorted(r.input_row for r in found.collect()) == want
    slices = regions.slices(index, regions.cover(region, 5), 5).collect()
    by_place = {(r.partition_index, r.output_row): r.input_row for r in placed.collect()}
    near = {by_place[s.partition_index, s.start + k] for s in slices for k in range(s["size"])}
    assert set(want) <= near
    few = regions.select(placed, index, region, 5, most=12)  # a coarse cover, and a slice a partition
    assert sorted(r.input_row for r in few.collect()) == want


def test_a_null_position_is_in_no_region(spark):
    df = spark.createDataFrame([(None, 1.0), (1.0, None), (1.0, 1.0)], "ra double, dec double")
    assert df.where(regions.inside(regions.cone(0, 0, 180))).count() == 1


def test_files_outside_a_region_are_not_read(spark, tmp_path):
    """Row groups of other pixels, and folders of other partitions, are left out by the reader."""
    _, df = sky(spark, 20_000)
    sizes = {r[0]: r[1] for r in df.groupBy("partition_index").count().collect()}
    ordered = spatial.in_file_order(spatial.ordered_rows(spatial.with_pixel(df, 6)), sizes, files=24)
    ordered.write.partitionBy("partition_index").parquet(str(tmp_path / "data"))
    data = spark.read.parquet(str(tmp_path / "data"))
    assert len(data.inputFiles()) == 24
    index = spatial.sparse_index(data, 6)
    region = regions.cone(77, 10, 3)
    found = regions.select(data, index.where("partition_index <> 1"), region, 6)
    kept = found.where("partition_index <> 1")
    assert kept.count() > 0
    plan = kept._jdf.queryExecution().executedPlan()
    kept._jdf.queryExecution().toRdd().count()
    text = plan.toString()
    assert "PushedFilters" in text and "output_row" in text.split("PushedFilters")[1] and "pixel" in text.split("PushedFilters")[1]
    scan = plan
    while scan.children().size():
        scan = scan.children().apply(0)
    read = scan.metrics().apply("numOutputRows").value()
    assert 0 < read < data.count() / 6
    assert scan.metrics().apply("numFiles").value() <= 16
