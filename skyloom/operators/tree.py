"""Nested headers as rows (path, kind, type, value).

A header is a tree: groups hold groups, datasets and attributes.  As a table it
has a row for each, ``a/b/c`` being the path, so a tree of any depth and any
fields is copied whole by a join, and fields are overridden by their path.  A
donor may come as such rows or as one row of nested structs (a struct is a
group, an array a dataset, anything else an attribute).  Values are JSON text,
and ``type`` says what they were.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from skyloom.errors import LayoutError
from skyloom.operators.binning import medians

COLUMNS = ("path", "kind", "type", "value")
#: Most rows of a header, which is broadcast.
MOST_ROWS = 1 << 16
# Groups and fields that vary from file to file.
REDSHIFT, STEP, Z_RANGE = "file/redshift", "file/step", "lightcone/z_range"


def is_tree(df: DataFrame) -> bool:
    """Whether a header is nested: rows of a tree, or a row with structs."""
    return set(COLUMNS) <= set(df.columns) or any(isinstance(f.dataType, T.StructType) for f in df.schema.fields)


def _text(value: Column, kind: T.DataType) -> Column:
    return value.cast("string") if isinstance(kind, T.StringType) else F.get_json_object(F.to_json(F.struct(value.alias("v"))), "$.v")


def _rows(schema: T.StructType, at: str, of: Column | None) -> list[Column]:
    out = []
    for f in schema.fields:
        path, value = f"{at}{f.name}", F.col(f"`{f.name}`") if of is None else of.getField(f.name)
        if isinstance(f.dataType, T.StructType):
            out.append((path, "group", "", F.lit(None).cast("string")))
            out += _rows(f.dataType, f"{path}/", value)
        else:
            out.append((path, "dataset" if isinstance(f.dataType, T.ArrayType) else "attribute", f.dataType.simpleString(), _text(value, f.dataType)))
    return out


def rows_of(header: DataFrame) -> DataFrame:
    """A header as rows of its tree; one row of nested structs is taken apart."""
    if set(COLUMNS) <= set(header.columns):
        return header.select(*COLUMNS)
    made = [F.struct(F.lit(p).alias("path"), F.lit(k).alias("kind"), F.lit(t).alias("type"), v.alias("value")) for p, k, t, v in _rows(header.schema, "", None)]
    return header.limit(1).select(F.inline(F.array(*made)))


def value_of(rows: DataFrame, path: str, kind: str, **keys: int) -> object:
    """One value of a tree, parsed as a type."""
    found = rows.where(F.col("path") == path)
    for k, v in keys.items():
        found = found.where(F.col(k) == v)
    parsed = F.col("value") if kind == "string" else F.from_json(F.concat(F.lit('{"v":'), "value", F.lit("}")), f"v {kind}").getField("v")
    row = found.select(parsed.alias("v")).first()
    return None if row is None else row["v"]


def census(rows: DataFrame) -> DataFrame:
    """Subgroups, datasets and attributes of a tree."""
    count = lambda kind: F.count_if(F.col("kind") == kind)
    return rows.agg(count("group").alias("n_groups"), count("dataset").alias("n_datasets"), count("attribute").alias("n_attributes"))


def problems(rows: DataFrame) -> DataFrame:
    """Paths that a tree has twice, or whose group it lacks."""
    twice = rows.groupBy("path").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("path", F.lit("is there twice").alias("reason"))
    above = rows.where("instr(path, '/') > 0").select("path", F.regexp_replace("path", "/[^/]*$", "").alias("group"))
    lost = above.join(rows.where("kind = 'group'").select(F.col("path").alias("group")), "group", "left_anti")
    return twice.unionByName(lost.select("path", F.lit("has no group").alias("reason")))


def with_overrides(copies: DataFrame, overrides: DataFrame, keys: list[str]) -> DataFrame:
    """copies (keys, path, kind, type, value) with the rows of ``overrides`` in place of those of equal keys and path, or beside them."""
    return copies.join(overrides.select(*keys, "path"), [*keys, "path"], "left_anti").unionByName(overrides.select(*keys, *COLUMNS))


def specialised(targets: DataFrame, header: DataFrame, data: DataFrame | None, bounds: DataFrame | None, first_step: int = 0, replace: bool = False, key: Column | None = None) -> DataFrame:
    """The donor's whole tree for every target that takes it, with the fields that vary; and each target's ``skipped`` and ``warnings``.

    Rules as in meta.specialised_headers(): the source and, without
    ``replace``, targets with a header are skipped and use up no step.
    Redshift and step are set if there is a key and a group ``file``, the range
    if there are bounds and a group ``lightcone``, whether or not the donor has
    the field.
    """
    tree = rows_of(header)
    few = tree.limit(MOST_ROWS + 1).toArrow()
    if few.num_rows > MOST_ROWS:
        raise LayoutError(f"a header of over {MOST_ROWS} rows")
    tree = F.broadcast(header.sparkSession.createDataFrame(few, tree.schema))
    groups = {r["path"] for r in few.select(["path", "kind"]).to_pylist() if r["kind"] == "group"}
    told = targets.withColumn("skipped", F.coalesce("is_source", F.lit(False)) | (F.coalesce("has_header", F.lit(False)) & F.lit(not replace)))
    taken = told.where("not skipped").withColumn("step", F.row_number().over(Window.partitionBy("skipped").orderBy("partition_index")) - 1 + first_step).select("partition_index", "step")
    copies = taken.select("partition_index").crossJoin(tree)
    field = lambda path, kind, value: F.struct(F.lit(path).alias("path"), F.lit("attribute").alias("kind"), F.lit(kind).alias("type"), value.alias("value"))
    notes = []
    if data is not None and key is not None and "file" in groups:
        own = taken.join(medians(data.select("partition_index", key.alias("key")), "key"), "partition_index", "left")
        step = own.select("partition_index", F.inline(F.array(field(STEP, "bigint", F.col("step").cast("string")))))
        median = own.where("median is not null").select("partition_index", F.inline(F.array(field(REDSHIFT, "double", F.col("median").cast("string")))))
        copies = with_overrides(copies, step.unionByName(median), ["partition_index"])
    else:
        notes.append("header has no group file" if "file" not in groups else "no redshift column: file/redshift keeps the donor's value")
    if bounds is not None and "lightcone" in groups:
        range_ = F.to_json(F.array(F.col("z_min").cast("double"), F.col("z_max").cast("double")))
        own = taken.join(bounds.where("z_min is not null and z_max is not null"), "partition_index").select("partition_index", F.inline(F.array(field(Z_RANGE, "array<double>", range_))))
        copies = with_overrides(copies, own, ["partition_index"])
    else:
        notes.append("header has no group lightcone" if "lightcone" not in groups else "no recorded bounds: lightcone/z_range keeps the donor's value")
    warnings = F.array(*[F.lit(n) for n in notes]).cast("array<string>")
    return copies.withColumns({"skipped": F.lit(False), "warnings": warnings}).unionByName(
        told.where("skipped").select("partition_index", *[F.lit(None).cast("string").alias(c) for c in COLUMNS], "skipped", F.lit(None).cast("array<string>").alias("warnings"))
    )


def with_spectra(headers: DataFrame, wave_rest: DataFrame, fields: dict[str, str]) -> DataFrame:
    """Trees with the shared wavelength grid as the dataset sed_wave_rest, and what the spectra mean as attributes.

    A grid that a tree has already must be the same one.
    """
    if headers.where("not skipped").limit(1).count() == 0:
        raise LayoutError("spectra need a header to describe them")
    grid = wave_rest.limit(1).select(F.col("wave_rest").cast("array<double>").alias("_grid"))
    read = F.from_json("value", "array<double>")
    if headers.where("path = 'sed_wave_rest'").crossJoin(F.broadcast(grid)).where(~F.coalesce(read == F.col("_grid"), F.lit(False))).limit(1).count():  # one row
        raise LayoutError("the header's wavelength grid differs from the spectra's")
    values = [("sed_wave_rest", "dataset", "array<double>", F.to_json("_grid")), *((k, "attribute", "string", F.lit(v)) for k, v in fields.items())]
    made = F.inline(F.array(*[F.struct(F.lit(p).alias("path"), F.lit(k).alias("kind"), F.lit(t).alias("type"), v.alias("value")) for p, k, t, v in values]))
    shared = headers.where("not skipped").select("partition_index", "skipped", "warnings").distinct()
    added = shared.crossJoin(F.broadcast(grid)).select("partition_index", "skipped", "warnings", made)  # one row
    return with_overrides(headers, added, ["partition_index", "skipped", "warnings"])
