"""Hierarchical equal-area pixels of the sphere in nested order, by Column arithmetic.

After Gorski et al. 2005: twelve base pixels, each cut into 4 ** level.  All of
it is arithmetic on Columns, so it runs inside generated code.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyloom.errors import LayoutError

MAX_LEVEL = 13
BASE_PIXELS = 12
#: Angle from a pole within which its distance is taken from the sine.
POLAR = 0.01


def checked_level(level: int) -> int:
    if not 0 <= int(level) <= MAX_LEVEL:
        raise LayoutError(f"level {level} is outside 0 to {MAX_LEVEL}")
    return int(level)


def side(level: int) -> int:
    return 1 << level


def pixel_count(level: int) -> int:
    return BASE_PIXELS << (2 * level)


def resolution_degrees(level: int) -> float:
    """Side of a square of a pixel's area."""
    return math.degrees(math.sqrt(4 * math.pi / pixel_count(level)))


def level_columns(level: Column) -> dict[str, Column]:
    """Side, number of pixels and resolution in minutes of arc of a column of levels."""
    each = [(side(k), pixel_count(k), 60 * resolution_degrees(k)) for k in range(MAX_LEVEL + 1)]
    pick = lambda i: F.get(F.array(*[F.lit(row[i]) for row in each]), level)
    return {"nside": pick(0).cast("long"), "npix": pick(1).cast("long"), "resolution_arcmin": pick(2)}


def _spread(x: Column, level: int) -> Column:
    """Bit b to bit 2b."""
    bits = [F.shiftleft(F.shiftright(x, b).bitwiseAND(F.lit(1).cast("long")), 2 * b) for b in range(max(level, 1))]
    return sum(bits[1:], bits[0])


def add_pixel(df: DataFrame, ra: str, dec: str, level: int, name: str = "pixel") -> DataFrame:
    """df with the nested pixel of a direction in degrees.

    NULL where dec is outside [-90, 90] or a value is NULL or NaN.  The steps
    are projections of their own: each intermediate value is used several
    times, and Catalyst then computes it once instead of copying it into every
    use, which would outgrow generated code.
    """
    level = checked_level(level)
    ns = side(level)
    c = F.col
    low = lambda x: F.floor(x).cast("long")
    mask, edge = F.lit(ns - 1).cast("long"), F.lit(ns - 1).cast("long")
    good = c(dec).between(-90.0, 90.0) & ~F.isnan(c(ra)) & c(ra).isNotNull()
    turned = (c(ra) - 360.0 * F.floor(c(ra) / 360.0)) / 90.0
    # the polar angle, as the public library takes it: directions on a border of pixels then fall on the same side
    out = df.withColumns({"_theta": F.when(good, F.lit(math.pi / 2) - F.radians(c(dec))), "_tt": F.when(good, turned)})
    out = out.withColumns({"_z": F.cos("_theta"), "_za": F.abs(F.cos("_theta")), "_ntt": F.least(F.lit(3).cast("long"), low(c("_tt")))})
    # beside the poles 1 - |z| has lost its digits, and the sine has not
    polar = (c("_theta") < POLAR) | (c("_theta") > math.pi - POLAR)
    radius = F.when(polar, F.sin("_theta") / F.sqrt((1.0 + c("_za")) / 3.0)).otherwise(F.sqrt(3.0 * (1.0 - c("_za"))))
    tp, t = c("_tt") - c("_ntt"), ns * radius
    base, tilt = ns * (0.5 + c("_tt")), ns * c("_z") * 0.75
    out = out.withColumns({"_jp": low(base - tilt), "_jm": low(base + tilt), "_cp": F.least(edge, low(tp * t)), "_cm": F.least(edge, low((1.0 - tp) * t))})
    out = out.withColumns({"_fp": F.shiftright(c("_jp"), level), "_fm": F.shiftright(c("_jm"), level)})
    belt, north = c("_za") <= F.lit(2.0) / F.lit(3.0), c("_z") >= 0
    belt_face = F.when(c("_fp") == c("_fm"), c("_fp").bitwiseOR(F.lit(4).cast("long"))).when(c("_fp") < c("_fm"), c("_fp")).otherwise(c("_fm") + 8)
    face = F.when(c("_z").isNull(), None).when(belt, belt_face).when(north, c("_ntt")).otherwise(c("_ntt") + 8)
    x = F.when(belt, c("_jm").bitwiseAND(mask)).when(north, edge - c("_cm")).otherwise(c("_cp"))
    y = F.when(belt, edge - c("_jp").bitwiseAND(mask)).when(north, edge - c("_cp")).otherwise(c("_cm"))
    # a filter on the pixel (also one that a join infers) stops at this generator
    # instead of being rewritten in terms of ra and dec, which would copy them all again
    out = out.select(*df.columns, F.inline(F.array(F.struct(face.alias("_face"), x.alias("_x"), y.alias("_y")))))
    found = F.shiftleft(c("_face"), 2 * level) + _spread(c("_x"), level) + F.shiftleft(_spread(c("_y"), level), 1)
    return out.withColumn(name, found).drop("_face", "_x", "_y")


def parent(pix: Column, levels: int | Column = 1) -> Column:
    """The pixel ``levels`` up that holds this one."""
    if isinstance(levels, int):
        return F.shiftright(pix, 2 * levels)
    return F.call_function("shiftright", pix, (levels * 2).cast("int"))


def range_of(pix: int, level: int, at: int) -> tuple[int, int]:
    """First and last pixel of level ``at`` inside a coarser pixel; a scan filters by it (min/max pruning)."""
    shift = 2 * (at - level)
    return pix << shift, ((pix + 1) << shift) - 1


# Ring of the southern corner, and longitude of the centre in eighths of a turn, of the twelve base pixels.
BASE_RING = (2, 2, 2, 2, 3, 3, 3, 3, 4, 4, 4, 4)
BASE_TURN = (1, 3, 5, 7, 0, 2, 4, 6, 1, 3, 5, 7)


def pixel_sql(ra: str, dec: str, level: int) -> str:
    """The nested pixel as SQL text, found in another way than add_pixel() does.

    A direction's ring coordinate (0 at the north pole, 2 at the equator) and
    longitude give its place in the frame of each base pixel; the one that
    holds it is taken.
    """
    ns = side(level)
    spread = lambda v: " + ".join(f"((({v} >> {b}) & 1) << {2 * b})" for b in range(max(level, 1)))
    bases = ", ".join(f"({f}, {r}, {t})" for f, (r, t) in enumerate(zip(BASE_RING, BASE_TURN, strict=True)))
    return f"""(SELECT min((f << {2 * level}) + ({spread('ix')}) + 2 * ({spread('iy')})) FROM (
      SELECT f, least({ns - 1}, floor(x * {ns})::BIGINT) AS ix, least({ns - 1}, floor(y * {ns})::BIGINT) AS iy
      FROM (SELECT f, w, d, (r - h + d * w) / 2 AS x, (r - h - d * w) / 2 AS y
            FROM (SELECT f, r, h, least(1.0, h, 4.0 - h) AS w, ((turn - c + 12.0) % 8.0) - 4.0 AS d
                  FROM (SELECT CASE WHEN abs(sin(radians({dec}))) <= 2.0::DOUBLE / 3.0::DOUBLE THEN 2.0 - 1.5 * sin(radians({dec}))
                                    WHEN {dec} > 0 THEN sqrt(6.0::DOUBLE) * sin(radians(90.0 - {dec}) / 2) ELSE 4.0 - sqrt(6.0::DOUBLE) * sin(radians(90.0 + {dec}) / 2) END AS h,
                               ({ra} - 360.0 * floor({ra} / 360.0)) / 45.0::DOUBLE AS turn), (VALUES {bases}) b(f, r, c)))
      WHERE x BETWEEN 0 AND 1 AND y BETWEEN 0 AND 1 AND (w = 1 OR d >= -1 AND d < 1)))"""
