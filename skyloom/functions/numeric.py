"""Numeric Column expressions: rounding, binning and comparisons."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_even(x: Column, decimals: int) -> Column:
    """Round in scaled space, ties to even (``round``/``bround`` work on decimal text)."""
    scale = F.lit(float(10**decimals))
    return F.rint(x * scale) / scale


def bin_of(x: Column, edges: list[float]) -> Column:
    """Bin of x: left-closed, the last bin closed, outer values clipped in.

    Edges are few (one a partition), so a bin is the count of inner edges at
    or below x; that stays inside code generation, unlike a higher-order filter.
    """
    inner = edges[1:-1]
    if not inner:
        return F.lit(0)
    return sum((F.when(x >= F.lit(float(e)), 1).otherwise(0) for e in inner[1:]), F.when(x >= F.lit(float(inner[0])), 1).otherwise(0))


def is_close(a: Column, b: Column, tolerance: float) -> Column:
    """|a - b| <= tolerance, or equal infinities; NaN and NULL are never close."""
    near = ~F.isnan(a) & ~F.isnan(b) & ((F.abs(a - b) <= F.lit(tolerance)) | (a == b))
    return F.coalesce(near, F.lit(False))


def same_in_single_precision(a: Column, b: Column) -> Column:
    """Equality after rounding both to 32-bit floats."""
    return a.cast("float") == b.cast("float")


def is_key(x: Column) -> Column:
    """Whether x can be a partitioning key: neither NULL nor NaN."""
    return x.isNotNull() & ~F.isnan(x)
