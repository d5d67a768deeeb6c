"""Logical output columns of the three sources, and where each comes from."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyloom.errors import LayoutError
from skyloom.functions.arrays import element
from skyloom.functions.names import check_new_names, listed_bands, sanitized_band

#: Luminosity matrices that become one column a band, and their fallback band lists.
LUMINOSITY_MATRICES = {"M_ABS_SDSS": "_LUM_M_ABS_SDSS", "M_ABS_WISE": "_LUM_M_ABS_WISE"}
SHARED_AXES = ("sfh_age_gyr", "sfh_redshift", "mah_age_gyr", "mah_redshift", "mah_step")


@dataclass(frozen=True)
class ColumnSpec:
    """One output column: its source, dataset and, for a matrix, the element."""

    name: str
    kind: str
    dataset: str
    index: int | None = None

    def column(self, prefix: str = "") -> Column:
        return element(F.col(prefix + self.dataset), self.index).alias(self.name)


def resolve_columns(
    catalog: DataFrame,
    luminosities: DataFrame,
    photometry: DataFrame,
    bands: dict[str, list[str]],
    listed: dict[str, list[str]] | None = None,
    keys: tuple[str, ...] = ("skypatch", "core_group", "row_in_group", "source_global_row"),
) -> list[ColumnSpec]:
    """Catalogue, then luminosity, then photometry columns; names may not collide.

    The luminosities' redshift is left out (the catalogue's wins), magnitude
    matrices become a column a band, with ``listed`` naming bands where the
    source does.
    """
    seen: dict[str, str] = {}
    specs: list[ColumnSpec] = []

    def add(name: str, kind: str, dataset: str, index: int | None = None) -> None:
        check_new_names(seen, name, f"{kind}/{dataset}")
        specs.append(ColumnSpec(name, kind, dataset, index))

    own = lambda df: [c for c in df.columns if c not in keys]
    for c in own(catalog):
        add(c, "lightcone_catalogs", c)
    for c in own(luminosities):
        if c == "redshift":
            continue
        if c in LUMINOSITY_MATRICES:
            for i, band in enumerate((listed or {}).get(c) or bands[LUMINOSITY_MATRICES[c]]):
                add(f"{c}_{band}", "luminosities", c, i)
        else:
            add(c, "luminosities", c)
    for survey in own(photometry):
        if survey not in bands:
            raise LayoutError(f"there are no band names for {survey}")
        inside: dict[str, str] = {}
        for i, band in enumerate(bands[survey]):
            check_new_names(inside, f"mag_{sanitized_band(band)}", f"photometry/{survey}")
            add(f"mag_{sanitized_band(band)}", "photometry", survey, i)
    return specs


def bands_listed(df: DataFrame) -> dict[str, list[str]]:
    """Bands that matrix columns name themselves, by the metadata entry ``bands`` of their field."""
    return {f.name: listed_bands(f.metadata["bands"], []) for f in df.schema.fields if "bands" in f.metadata}


def matrix_widths(specs: list[ColumnSpec]) -> dict[tuple[str, str], int]:
    """Elements that each expanded matrix must have."""
    width: dict[tuple[str, str], int] = {}
    for s in specs:
        if s.index is not None:
            width[s.kind, s.dataset] = max(width.get((s.kind, s.dataset), 0), s.index + 1)
    return width


def width_violations(df: DataFrame, matrix: str, width: int) -> DataFrame:
    """Rows whose matrix isn't as wide as its band list."""
    return df.where((F.size(matrix) != width) | F.col(matrix).isNull())


def projected(joined: DataFrame, specs: list[ColumnSpec], extra: list[str]) -> DataFrame:
    """All output columns in one select, so that each matrix is read once."""
    return joined.select(*extra, *[s.column() for s in specs])


def expand_bands(df: DataFrame, matrix: str, bands: list[str], prefix: str = "mag_") -> DataFrame:
    """A matrix as one column a band."""
    seen: dict[str, str] = {}
    for band in bands:
        check_new_names(seen, prefix + sanitized_band(band), matrix)
    return df.select(*[c for c in df.columns if c != matrix], *[element(F.col(matrix), i).alias(n) for i, n in enumerate(seen)])


def object_columns(df: DataFrame) -> list[str]:
    """Per-object columns, alphabetical, without the shared axes."""
    return sorted(c for c in df.columns if c not in SHARED_AXES)


def schema_difference(a: DataFrame, b: DataFrame) -> set[str]:
    """Columns (with types) of only one of two tables; order doesn't count."""
    return {f"{n} {t}" for n, t in set(a.dtypes) ^ set(b.dtypes)}


#: Groups that a plan may name one by one.
NAMED_GROUPS = 10_000


def group_key_difference(listed: DataFrame) -> DataFrame:
    """Symmetric difference of (grp, key) sets from the first group's: rows (grp, key, side).

    Only groups that lack a key are compared with the first one's whole set.
    """
    pairs = listed.select("grp", "key").distinct()
    first = listed.agg(F.min("grp").alias("grp"))
    expected = pairs.join(F.broadcast(first), "grp", "left_semi").select("key")  # one row is broadcast
    extra = pairs.join(expected, "key", "left_anti").select("grp", "key").withColumn("side", F.lit("extra"))
    whole = expected.count()
    common = pairs.join(expected, "key", "left_semi").groupBy("grp").agg(F.count(F.lit(1)).alias("n"))
    lacking = pairs.select("grp").distinct().join(common, "grp", "left").where(F.coalesce("n", F.lit(0)) < whole).select("grp")
    named = [r[0] for r in lacking.limit(NAMED_GROUPS + 1).collect()]
    if len(named) <= NAMED_GROUPS:
        groups = F.array(*[F.lit(g) for g in named]).cast(f"array<{listed.schema['grp'].dataType.simpleString()}>")
        should = expected.select(F.explode(groups).alias("grp"), "key")
    else:
        should = lacking.crossJoin(expected)
    missing = should.join(pairs, ["grp", "key"], "left_anti").withColumn("side", F.lit("missing"))
    return missing.unionByName(extra)
