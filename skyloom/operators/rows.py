"""Row identity: numbering rows, offsets, positional and as-of joins.

Spark keeps no row order, so a row's place in its patch becomes a column first
and everything else joins on it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from skyloom.errors import LayoutError
from skyloom.functions.names import group_number

#: Rows of a numbering bucket; windows never hold more of dense keys.
BUCKET_ROWS = 1 << 20
#: Most offset rows that are broadcast (a few per patch).
BROADCAST_ROWS = 1 << 17


def exclusive_sum(value: Column, partition: list[str], order: list[str]) -> Column:
    """Sum of what comes before, 0 at first."""
    frame = Window.partitionBy(*partition).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(value).over(frame), F.lit(0)).cast("long")


def group_offsets(catalog: DataFrame, patch: str = "skypatch", group: str = "core_group") -> DataFrame:
    """Rows, exclusive offset and patch total of every group, groups in string order (core_10 before core_2)."""
    sizes = catalog.groupBy(patch, group).agg(F.count(F.lit(1)).alias("n_rows"))
    return sizes.withColumns(
        {"row_offset": exclusive_sum(F.col("n_rows"), [patch], [group]), "n_total": F.sum("n_rows").over(Window.partitionBy(patch)).cast("long")}
    )


def bounded_broadcast(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """df, computed once and hinted for broadcast if it has at most ``limit`` rows; else df as it is.

    The large side of the join then needs no shuffle and the small one no second pass.
    """
    found = df.limit(limit + 1).toArrow()
    return F.broadcast(df.sparkSession.createDataFrame(found, df.schema)) if found.num_rows <= limit else df


def few_of(df: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """The rows of df that a few keys name, computed once: one scan of df without a shuffle where the keys are broadcast."""
    return bounded_broadcast(df.join(keys.select(*on), on, "left_semi"))


def checkpointed(df: DataFrame) -> DataFrame:
    """df, cut from its lineage by a copy in the checkpoint folder, or in the warehouse where none is set.

    Driver and executors must share it: on a cluster a local warehouse won't do.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_checkpoints"
            system = context._jvm.org.apache.hadoop.fs.Path(folder).getFileSystem(context._jsc.hadoopConfiguration())
            if system.getScheme() == "file" and not (context.master == "local" or context.master.startswith("local[")):
                raise LayoutError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        context.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def interval_join(rows: DataFrame, spans: DataFrame, row: str, by: list[str], low: str = "low", high: str = "high") -> DataFrame:
    """rows with the other columns of each span [low, high) of their ``by`` that holds them.

    Spans are cut at cells about as wide as a mean span, so there are at most
    some three times as many pieces, and rows meet them by (by, cell): an equal
    join at any number of spans, broadcast while the pieces are few, and never
    with all rows of a patch under one key.
    """
    told = spans.agg(F.count(F.lit(1)), F.sum(F.col(high) - F.col(low))).first()
    bits = max(0, (int(told[1] or 0) // max(1, told[0])).bit_length())
    cell = lambda c: F.shiftright(c.cast("long"), bits)
    pieces = spans.where(F.col(high) > F.col(low)).withColumn("_cell", F.explode(F.sequence(cell(F.col(low)), cell(F.col(high) - 1))))
    met = rows.withColumn("_cell", cell(F.col(row))).join(bounded_broadcast(pieces), [*by, "_cell"])
    return met.where((F.col(row) >= F.col(low)) & (F.col(row) < F.col(high))).drop("_cell", low, high)


def number_rows(catalog: DataFrame, row: str = "row_in_group", patch: str = "skypatch", group: str = "core_group", bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Adds source_global_row: 0, 1, ... per patch, by group and row.

    Two phases: a group's rows are cut into buckets of the row key, buckets
    get exclusive offsets from their counts, and only a bucket is ever sorted,
    so a group of a tenth of all rows spreads over many tasks.  A row without
    patch, group or row key raises: it has no place, and none may be lost.
    """
    bucketed = catalog.withColumn("_bucket", F.floor(F.col(row) / F.lit(bucket_rows)).cast("long"))
    sizes = bucketed.groupBy(patch, group, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    offsets = sizes.withColumn("_offset", exclusive_sum(F.col("_n"), [patch], [group, "_bucket"])).drop("_n")
    rank = F.row_number().over(Window.partitionBy(patch, group, "_bucket").orderBy(row))
    ranked = bucketed.withColumn("_rank", rank.cast("long"))
    offsets = bounded_broadcast(offsets)
    if offsets.where(" or ".join(f"`{c}` is null" for c in (patch, group, "_bucket"))).limit(1).count():
        raise LayoutError(f"rows without {patch}, {group} or {row} have no place")
    return ranked.join(offsets, [patch, group, "_bucket"]).withColumn("source_global_row", F.col("_offset") + F.col("_rank") - 1).drop("_bucket", "_offset", "_rank")


def number_dense_rows(catalog: DataFrame, row: str = "row_in_group", patch: str = "skypatch", group: str = "core_group") -> DataFrame:
    """The same where rows of a group are already 0, 1, ...: offset plus row, no sort and no shuffle of rows."""
    offsets = bounded_broadcast(group_offsets(catalog, patch, group).select(patch, group, "row_offset"))
    return catalog.join(offsets, [patch, group]).withColumn("source_global_row", F.col("row_offset") + F.col(row)).drop("row_offset")


def with_place(df: DataFrame, by: list[str], major: list[str], row: str, name: str = "input_row", bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Adds the 0-based place in each group of ``by``, in the order of ``major`` and then ``row``.

    As in number_rows(), only buckets of the row are sorted; their counts give
    them their offsets.  Rows of equal keys get places in any order.
    """
    bucketed = df.withColumn("_bucket", F.floor(F.col(row) / F.lit(bucket_rows)).cast("long"))
    keys = [*by, *major, "_bucket"]
    sizes = bucketed.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    offsets = sizes.withColumn("_offset", exclusive_sum(F.col("_n"), by, [*major, "_bucket"])).drop("_n")
    ranked = bucketed.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(row)))
    return ranked.join(bounded_broadcast(offsets), keys).withColumn(name, F.col("_offset") + F.col("_rank") - 1).drop("_bucket", "_rank", "_offset")


def dense_offsets(numbered: DataFrame, offsets: DataFrame, row: str = "row_in_group") -> DataFrame | None:
    """The groups' offsets if every numbered row is its group's offset plus its own row, else None."""
    offsets = bounded_broadcast(offsets.select("skypatch", "core_group", "row_offset"))
    moved = numbered.join(offsets, ["skypatch", "core_group"]).where(F.col("source_global_row") != F.col("row_offset") + F.col(row))
    return None if moved.limit(1).count() else offsets


def positional_join(catalog: DataFrame, *others: DataFrame, keys: tuple[str, ...] = ("skypatch", "source_global_row")) -> DataFrame:
    """One row for each position that all sources have; sources share one partitioning."""
    out = catalog
    for other in others:
        out = out.join(other, list(keys), "inner")
    return out


def group_of_rows(rows: DataFrame, offsets: DataFrame, patch: str = "skypatch", row: str = "source_global_row") -> DataFrame:
    """As-of lookup: the group with the last offset at or below each row, by the offsets of its patch."""
    start = F.col("row_offset")
    spans = offsets.select(F.col(patch), "core_group", start.alias("_start"), start.alias("_low"), (start + F.col("n_rows")).alias("_high"))
    met = interval_join(rows, spans, row, [patch], "_low", "_high")
    return met.select(*rows.columns, "core_group", (F.col(row) - F.col("_start")).alias("row_in_group"))


def with_provenance(catalog: DataFrame, group: str = "core_group") -> DataFrame:
    """skypatch, source_global_row and source_core as published provenance columns."""
    return catalog.withColumns({"skypatch": F.col("skypatch").cast("int"), "source_core": group_number(F.col(group)), "source_global_row": F.col("source_global_row").cast("long")})


def sample_positions(n: int, count: int) -> list[int]:
    """At most ``count`` evenly spaced rows of n, first and last included."""
    k = min(count, n)
    return sorted({i * (n - 1) // (k - 1) for i in range(k)}) if k > 1 else [0] * k


def sample_rows(sizes: DataFrame, count: int, size: str = "n_rows") -> DataFrame:
    """The same for a table of sizes: one row for each sampled position."""
    k = F.least(F.lit(count).cast("long"), F.col(size))
    at = F.when(k > 1, F.expr(f"transform(sequence(0L, least({count}L, {size}) - 1), i -> i * ({size} - 1) div (least({count}L, {size}) - 1))")).otherwise(
        F.when(k == 1, F.array(F.lit(0).cast("long"))).otherwise(F.array().cast("array<bigint>"))
    )
    return sizes.withColumn("sample_row", F.explode(F.array_distinct(at)))


def first_of(paths: DataFrame, key: str, order: str) -> DataFrame:
    """Order-preserving distinct: the first row of each key."""
    return paths.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(order))).where("_n = 1").drop("_n")
