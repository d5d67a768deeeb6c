"""Reads by sky region: a cover of nested pixels, slices of sorted files, and the exact test.

A region is the intersection of caps (axis in degrees, opening angle): a disc is
one cap, a convex polygon a half-sphere for each edge.  Its cover is found by
descending the quad-tree of nested pixels: a pixel that lies outside one cap is
dropped, one inside all caps is taken whole, others are cut in four until the
finest level or ``most`` ranges.  The cover holds the region and a little more;
the index turns its ranges into (start, size) slices of the rows of each
partition, files are read where these slices are, and ``inside`` decides row by
row.
"""

from __future__ import annotations

import functools
import math
import operator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyloom.errors import LayoutError
from skyloom.functions import healpix
from skyloom.operators.rows import interval_join

#: Ranges that a cover has at most, and those that a scan filters by.
MOST_RANGES, SCAN_RANGES = 4096, 24
#: Slack of a pixel's circumscribed circle, in parts of its radius.
SLACK = 0.1


@dataclass(frozen=True)
class Cap:
    """All directions within ``angle`` degrees of (ra, dec)."""

    ra: float
    dec: float
    angle: float


def vector(ra, dec) -> np.ndarray:
    a, d = np.radians(ra), np.radians(dec)
    return np.stack([np.cos(d) * np.cos(a), np.cos(d) * np.sin(a), np.sin(d)], axis=-1)


def cone(ra: float, dec: float, radius: float) -> list[Cap]:
    if not (-90 <= dec <= 90 and 0 <= radius <= 180 and math.isfinite(ra)):
        raise LayoutError(f"no cone of {radius} degrees at ({ra}, {dec})")
    return [Cap(ra % 360, dec, radius)]


def polygon(corners: list[tuple[float, float]]) -> list[Cap]:
    """Half-spheres of a convex polygon whose sides are great circles; its corners may run either way."""
    points = vector(*np.array(corners, np.float64).T)
    if len(points) < 3:
        raise LayoutError("a polygon needs three corners")
    axes = np.cross(points, np.roll(points, -1, axis=0))
    axes *= np.sign((axes @ points.mean(axis=0)).sum())
    sizes = np.linalg.norm(axes, axis=1)
    if np.any(sizes < 1e-12) or np.any(axes @ points.T < -1e-9 * sizes[:, None]):
        raise LayoutError("the corners are not those of a convex polygon")
    axes /= sizes[:, None]
    return [Cap(float(np.degrees(np.arctan2(y, x))) % 360, float(np.degrees(np.arcsin(np.clip(z, -1, 1)))), 90.0) for x, y, z in axes]


def inside(region: list[Cap], ra: str = "ra", dec: str = "dec") -> Column:
    """The exact test: the haversine of the distance to each axis; false where there is no position."""

    def one(cap: Cap) -> Column:
        up, along = (F.radians(F.col(dec)) - F.lit(math.radians(cap.dec))) / 2, (F.radians(F.col(ra)) - F.lit(math.radians(cap.ra))) / 2
        half = F.sin(up) * F.sin(up) + F.cos(F.radians(F.col(dec))) * F.lit(math.cos(math.radians(cap.dec))) * F.sin(along) * F.sin(along)
        return half <= F.lit(math.sin(math.radians(cap.angle) / 2) ** 2)

    return F.coalesce(functools.reduce(operator.and_, map(one, region)), F.lit(False))


def inside_sql(region: list[Cap], ra: str = "ra", dec: str = "dec") -> str:
    """The same as SQL text, by the angle between vectors."""
    return " AND ".join(
        f"2 * asin(least(1.0, sqrt(pow(sin(radians({dec} - {c.dec!r}::DOUBLE) / 2), 2) + cos(radians({dec})) * cos(radians({c.dec!r}::DOUBLE)) * pow(sin(radians({ra} - {c.ra!r}::DOUBLE) / 2), 2)))) <= radians({c.angle!r}::DOUBLE)" for c in region
    )


def _squeezed(pix: np.ndarray) -> np.ndarray:
    """Every second bit, closed up."""
    out = np.zeros_like(pix)
    for b in range(healpix.MAX_LEVEL + 1):
        out |= (pix >> (2 * b) & 1) << b
    return out


def directions(pix: np.ndarray, level: int, dx: float = 0.5, dy: float = 0.5) -> np.ndarray:
    """Unit vectors of a place (dx, dy in 0 to 1) inside nested pixels; 0.5, 0.5 is the centre."""
    face, own = pix >> (2 * level), pix & ((1 << (2 * level)) - 1)
    x, y = (_squeezed(own) + dx) / (1 << level), (_squeezed(own >> 1) + dy) / (1 << level)
    ring = np.array(healpix.BASE_RING)[face] - x - y  # 0 at the north pole, 2 at the equator, 4 at the south pole
    wide = np.minimum(1.0, np.minimum(ring, 4 - ring))
    z = np.where(ring < 1, 1 - ring**2 / 3, np.where(ring > 3, (4 - ring) ** 2 / 3 - 1, (2 - ring) * 2 / 3))
    turn = np.where(wide > 0, np.array(healpix.BASE_TURN)[face] + np.divide(x - y, wide, out=np.zeros_like(x), where=wide > 0), 0)
    flat = np.sqrt(np.maximum(0, (1 - z) * (1 + z)))
    return np.stack([flat * np.cos(turn * math.pi / 4), flat * np.sin(turn * math.pi / 4), z], axis=-1)


def _angle(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return 2 * np.arcsin(np.clip(np.linalg.norm(a - b, axis=-1) / 2, 0, 1))


def cover(region: list[Cap], level: int, most: int = MOST_RANGES) -> list[tuple[int, int]]:
    """Sorted, disjoint ranges (first, last) of pixels of ``level`` that hold the region.

    A level is descended for all open pixels at once; the descent ends early
    when the ranges would be more than ``most``, and the open pixels then count
    whole.
    """
    level = healpix.checked_level(level)
    axes, angles = vector(np.array([c.ra for c in region]), np.array([c.dec for c in region])), np.radians([c.angle for c in region])
    open_, done = np.arange(healpix.BASE_PIXELS, dtype=np.int64), []
    for at in range(level + 1):
        centre = directions(open_, at)
        reach = (1 + SLACK) * np.max([_angle(centre, directions(open_, at, dx, dy)) for dx in (0, 1) for dy in (0, 1)], axis=0)
        away = _angle(centre[:, None, :], axes[None, :, :])
        open_keep = np.all(away - reach[:, None] <= angles + 1e-12, axis=1)
        whole = open_keep & np.all(away + reach[:, None] <= angles, axis=1)
        rest = open_[open_keep & ~whole]
        done += [healpix.range_of(int(p), at, level) for p in open_[whole]]
        if at == level or len(done) + 4 * len(rest) > most:
            done += [healpix.range_of(int(p), at, level) for p in rest]
            break
        open_ = (rest[:, None] * 4 + np.arange(4)).reshape(-1)
    return joined(done, len(done))


def joined(ranges: list[tuple[int, int]], most: int) -> list[tuple[int, int]]:
    """At most ``most`` ranges that hold the given ones: touching ones are one, and the smallest gaps are closed."""
    ranges = sorted(ranges)
    gaps = sorted((b[0] - a[1] - 1, i) for i, (a, b) in enumerate(zip(ranges, ranges[1:], strict=False)))
    closed = {i for k, (gap, i) in enumerate(gaps) if gap <= 0 or k < len(ranges) - most}
    out: list[tuple[int, int]] = []
    for i, (a, b) in enumerate(ranges):
        out[-1:] = [(out[-1][0], b)] if i and i - 1 in closed else [*out[-1:], (a, b)]
    return out


def in_ranges(pixel: Column, ranges: list[tuple[int, int]]) -> Column:
    """A filter that Parquet's statistics can answer: few plain comparisons."""
    return functools.reduce(operator.or_, [pixel.between(a, b) for a, b in joined(ranges, SCAN_RANGES)], F.lit(False))


def slices(index: DataFrame, ranges: list[tuple[int, int]], level: int, by: str = "partition_index") -> DataFrame:
    """(partition, first_pixel, start, size) of the rows of each range: rows lie in the order of pixels, so a range is one slice.

    index: the index of the catalogue at ``level`` at least, of which only that level is read.
    """
    own = index.where((F.col("level") == level) & in_ranges(F.col("pixel"), ranges))
    table = index.sparkSession.createDataFrame([(int(a), int(a), int(b) + 1) for a, b in ranges], "first_pixel long, low long, high long")
    met = interval_join(own, table, "pixel", [])
    return met.groupBy(by, "first_pixel").agg(F.min("start").alias("start"), F.sum("size").alias("size"))


def in_slices(found: list[tuple[int, int, int]], by: str = "partition_index", row: str = "output_row", most: int = SCAN_RANGES) -> Column:
    """The filter of slices (partition, start, size): whole partitions fall away by folder, rows by the statistics of files."""
    each: dict[int, list[tuple[int, int]]] = {}
    for part, start, size in found:
        if size:
            each.setdefault(part, []).append((start, start + size - 1))
    own = max(1, most // max(1, len(each)))
    parts = [(F.col(by) == part) & functools.reduce(operator.or_, [F.col(row).between(a, b) for a, b in joined(spans, own)]) for part, spans in sorted(each.items())]
    return functools.reduce(operator.or_, parts, F.lit(False))


def near(index: DataFrame, region: list[Cap], level: int, most: int = MOST_RANGES, by: str = "partition_index") -> Column:
    """A filter on (partition, output_row) that holds the region.

    The driver sees a start and an end for each partition that the region
    meets, or for each of its ranges while these are few.
    """
    met = slices(index, cover(region, level, most), level, by)
    few = met.limit(most + 1).collect()
    if len(few) > most:  # a wide region: a slice for each partition from its first to its last row
        few = met.groupBy(by).agg(F.min("start").alias("start"), (F.max(F.col("start") + F.col("size")) - F.min("start")).alias("size")).collect()
    return in_slices([(r[by], r["start"], r["size"]) for r in few], by)


def select(data: DataFrame, index: DataFrame, region: list[Cap], level: int, most: int = MOST_RANGES, by: str = "partition_index") -> DataFrame:
    """The rows of published data inside a region, read by slices."""
    ranges = cover(region, level, most)
    return data.where(near(index, region, level, most, by) & in_ranges(F.col("pixel"), ranges)).where(inside(region))
