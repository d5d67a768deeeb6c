"""Embedding whitening from an exact integer scatter.

Entries become integers x = floor(1024 c) + SHIFT.  Tasks subtract the shift
again and accumulate sums and cross-products without rounding: numbers are cut
into limbs of 20 bits, whose products over 8,192 rows are exact in doubles, and
meet in integers of any size; partial results travel as limbs of 32 bits, which
Spark sums as longs.  From n, S and XᵀX the driver forms n·XᵀX - SSᵀ, an exact
integer matrix as wide as a vector, and only then converts to doubles and takes
its eigenvectors.  The shift changes nothing but the size of the numbers.

A second pass projects the centred rows.  Their own mean and covariance are
measured on the staged result, centred before multiplying.

Defined cases: a null vector, or one with null or non-finite entries, is
dropped, and so is one that is shorter than the longest (its last entries are
missing); entries of 2**62 / 1024 and beyond count as that; repeated rows count
as often as they are there; a null id is carried along; components are numbered
1, 2, ... (at most as many as entries), each with its largest entry positive;
where the variance of a component is zero by the precision of doubles its
``whitened`` is null, and ``explained`` is null where nothing varies;
``deviation`` is null beyond 38 digits; an empty table gives no rows; further
columns are carried along by whiten(), but for those that it adds.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyloom.llm.common import apart, checkpointed

SCALE, SHIFT, COMPONENTS = 1024, 100_000, 8
#: Bits of a limb and rows of a product: sums of 2**13 products of 2 x 20 bits are exact in doubles.
LIMB, BLOCK = 20, 1 << 13
LARGEST = float(1 << 62)
_DIGITS = 10**38
ADDED = ("deviation", "whitened")


def integers(vector: Column) -> Column:
    """Entries as longs; null for a vector that is null or has an entry that is null or not finite."""
    whole = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    scaled = lambda c: F.least(F.lit(LARGEST), F.greatest(F.lit(-LARGEST), c.cast("double") * SCALE))
    return F.when(whole, F.transform(vector, lambda c: F.floor(scaled(c)).cast("long") + SHIFT))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, width)


def exact_products(y: np.ndarray) -> np.ndarray:
    """YᵀY of int64 rows as integers of any size."""
    bits = max((int(abs(int(m))).bit_length() for m in (y.min(), y.max())), default=0) if y.size else 0
    count = max(1, -(-bits // LIMB))
    total = np.zeros((y.shape[1],) * 2, object)
    for at in range(0, len(y), BLOCK):
        rest, limbs = y[at : at + BLOCK], []
        for _ in range(count - 1):
            limbs.append((rest & ((1 << LIMB) - 1)).astype(np.float64))
            rest = rest >> LIMB
        limbs.append(rest.astype(np.float64))
        for i, a in enumerate(limbs):
            for j, b in enumerate(limbs):
                total += (a.T @ b).astype(np.int64).astype(object) << (LIMB * (i + j))
    return total


def _moments(width: int):
    """n, sums and cross-products of a task, as (i, j, limb, value): i = -1 for sums, i = j = -1 for n."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, products = 0, np.zeros(width, object), np.zeros((width, width), object)
        for batch in batches:
            y = _matrix(batch.column(0), width) - SHIFT
            n += len(y)
            for at in range(0, len(y), BLOCK):  # halves, so that no sum of longs overflows
                part = y[at : at + BLOCK]
                sums = sums + ((part >> 32).sum(axis=0).astype(object) << 32) + (part & 0xFFFFFFFF).sum(axis=0).astype(object)
            products = products + exact_products(y)
        i, j = np.triu_indices(width)
        first, second = np.r_[-1, np.full(width, -1), i], np.r_[-1, np.arange(width), j]
        rest, k = np.r_[np.array([n], object), sums, products[i, j]], 0
        while n and (k == 0 or any(rest)):
            last = k and all(-(1 << 31) <= v < 1 << 31 for v in rest)
            low = rest if last else rest & 0xFFFFFFFF
            yield pa.RecordBatch.from_arrays(
                [pa.array(first, pa.int32()), pa.array(second, pa.int32()), pa.array(np.full(len(first), k), pa.int32()), pa.array(low.astype(np.int64))], names=["i", "j", "limb", "value"]
            )
            if last:
                break
            rest, k = rest >> 32, k + 1

    return partial


def scatter(x: DataFrame, width: int) -> tuple[int, list[int], np.ndarray]:
    """n, the sums S of x, and n·XᵀX - SSᵀ, all exact, of the one column of arrays of longs."""
    totals = x.mapInArrow(_moments(width), "i int, j int, limb int, value long").groupBy("i", "j", "limb").agg(F.sum("value").alias("v")).collect()
    n, sums, products = 0, np.zeros(width, object), np.zeros((width, width), object)
    for i, j, limb, v in totals:  # as many as a vector has pairs of entries
        part = int(v) << (32 * limb)
        if j < 0:
            n += part
        elif i < 0:
            sums[j] += part
        else:
            products[i, j] += part
    products = products + products.T - np.diag(np.diagonal(products))
    return n, [int(s) + n * SHIFT for s in sums], n * products - np.outer(sums, sums)


def components(n: int, scattered: np.ndarray, most: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray, float]:
    """Eigenvalues, falling, and unit eigenvectors (columns) of the covariance, and its trace."""
    covariance = np.array([[int(v) / (n * n) for v in row] for row in scattered], np.float64)  # each correctly rounded
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1][:most].copy(), vectors[:, ::-1][:, :most].copy()
    vectors *= np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])])
    return values, vectors, int(sum(int(scattered[i, i]) for i in range(len(scattered)))) / (n * n)


def _projected(n: int, sums: list[int], weights: np.ndarray):
    """An Arrow function: longs to the exact deviation and the projections of the centred row."""
    width, large = len(sums), max(map(abs, sums), default=0)

    def project(x: pa.Array) -> pa.Array:
        rows = _matrix(x, width)
        most = int(np.abs(rows).max(initial=0))
        small = n * most + large < 1 << 62
        off = rows * n - np.array(sums, np.int64) if small else rows.astype(object) * n - np.array(sums, object)
        if small and width * int(np.abs(off).max(initial=0)) ** 2 < 1 << 63:
            deviation = pa.array((off * off).sum(axis=1)).cast(pa.decimal128(38, 0))
        else:
            exact = (off.astype(object) ** 2).sum(axis=1)
            deviation = pa.array([Decimal(int(v)) if v < _DIGITS else None for v in exact], pa.decimal128(38, 0))
        centred = off / float(n) if small else np.array([[int(v) / n for v in row] for row in off], np.float64).reshape(-1, width)
        made = centred @ weights
        offsets = pa.array(np.arange(len(rows) + 1, dtype=np.int32) * weights.shape[1])
        return pa.StructArray.from_arrays([deviation, pa.ListArray.from_arrays(offsets, pa.array(made.reshape(-1)))], names=["deviation", "whitened"])

    return project


def whiten(df: DataFrame, vector: str = "embedding", most: int = COMPONENTS) -> tuple[DataFrame, dict]:
    """df's usable rows with deviation and the array whitened, staged; and n, values, explained and identity_error."""
    rows, names = apart(df)
    rows = rows.withColumn("_x", integers(F.col(names[vector])))
    width = rows.where("_x is not null").agg(F.max(F.size("_x"))).first()[0] or 0
    rows = rows.where((F.col("_x").isNotNull()) & (F.size("_x") == width))
    n, sums, scattered = scatter(rows.select("_x"), width)
    values, vectors, trace = components(n, scattered, most) if n and width else (np.zeros(0), np.zeros((width, 0)), 0.0)
    good = values > max(values, default=0.0) * width * 2.0**-50
    weights = np.divide(vectors, np.sqrt(np.where(good, values, 1.0)))
    own = {c: name for c, name in names.items() if c not in ADDED}
    found = rows.withColumn("_made", F.arrow_udf(_projected(n, sums, weights), "deviation decimal(38,0), whitened array<double>")("_x"))
    kept = F.transform("_made.whitened", lambda w, i: F.when(F.get(F.array(*[F.lit(bool(g)) for g in good]), i), w)) if len(good) else F.array().cast("array<double>")
    found = checkpointed(found.select(*[F.col(name).alias(c) for c, name in own.items()], F.col("_made.deviation").alias("deviation"), kept.alias("whitened")))
    told = {"n": n, "values": values, "explained": [max(float(v), 0.0) / trace if trace else None for v in values], "identity_error": identity_error(found, np.flatnonzero(good).tolist())}
    return found, told


def identity_error(found: DataFrame, at: list[int]) -> float | None:
    """Largest entry of (the covariance of whitened - identity), over the components at these places."""
    if not at:
        return None
    w = lambda i: F.get("whitened", F.lit(i))
    means = found.agg(*[F.avg(w(i)).alias(f"m{i}") for i in at]).first()
    pairs = [(i, j) for i in at for j in at if i <= j]
    found = found.agg(*[F.avg((w(i) - F.lit(means[f"m{i}"])) * (w(j) - F.lit(means[f"m{j}"]))).alias(f"c{i}_{j}") for i, j in pairs]).first()
    return max(abs(found[f"c{i}_{j}"] - (i == j)) for i, j in pairs)


def verdicts(df: DataFrame, id_column: str = "vec_id", vector: str = "embedding", most: int = COMPONENTS) -> DataFrame:
    """A row for each usable row and component; ``deviation`` is null where it does not fit a long."""
    found, told = whiten(df.select(id_column, vector), vector, most)
    explained = F.array(*[F.lit(e).cast("double") for e in told["explained"]]).cast("array<double>")
    rows = found.select(id_column, F.expr("try_cast(deviation AS long)").alias("deviation"), F.posexplode("whitened").alias("_at", "whitened"))
    return rows.select(
        id_column,
        (F.col("_at") + 1).cast("int").alias("component"),
        F.lit(told["n"]).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(explained, F.col("_at")).alias("explained"),
        F.lit(told["identity_error"]).cast("double").alias("identity_error"),
    )
