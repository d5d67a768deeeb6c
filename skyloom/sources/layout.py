"""Where sources lie and what they hold.  Files are reached through Spark's file systems only.

A raw root has a folder a kind with one Parquet folder a patch,
``<kind>/<stem>_skypatch_<n>.parquet``; spectra lie beside in shards,
``seds_skypatch_<n>.shard<i>of<m>.parquet``.
"""

from __future__ import annotations

import json
import posixpath
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyloom.errors import LayoutError

#: The three kinds of raw source and their file stems.
KINDS = {"lightcone_catalogs": "lightcone_galaxies", "luminosities": "luminosities", "photometry": "photometry"}
#: Shared history axes and their lengths.
TIME_GRIDS = {"sfh_age_gyr": 117, "sfh_redshift": 117, "mah_age_gyr": 101, "mah_redshift": 101, "mah_step": 101}

_SHARD = re.compile(r"seds_skypatch_(\d+)\.shard(\d+)of(\d+)\.parquet")


#: A raw root, or the three folders of linked_roots().
Root = str | dict[str, str]


def kind_folder(root: Root, kind: str) -> str:
    if kind not in KINDS:
        raise LayoutError(f"there is no raw kind {kind!r}")
    return root[kind] if isinstance(root, dict) else posixpath.join(root, kind)


def patch_path(root: Root, patch: int, kind: str) -> str:
    return posixpath.join(kind_folder(root, kind), f"{KINDS[kind]}_skypatch_{int(patch)}.parquet")


def listing(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder of any file system that Spark reads; [] if there is none."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(f.getPath().getName() for f in system.listStatus(path)) if system.exists(path) else []


def exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def patches_by_kind(spark: SparkSession, root: Root) -> dict[str, set[int]]:
    found = {}
    for kind, stem in KINDS.items():
        names = (re.fullmatch(rf"{re.escape(stem)}_skypatch_(\d+)\.parquet", n) for n in listing(spark, kind_folder(root, kind)) if ".shard" not in n)
        found[kind] = {int(m[1]) for m in names if m}
    return found


def discover_skypatches(spark: SparkSession, root: Root) -> list[int]:
    """Sorted patches; each must lie in every kind."""
    found = patches_by_kind(spark, root)
    every = sorted(set().union(*found.values()))
    if not every:
        raise LayoutError(f"no raw skypatches under {root!r}")
    missing = [(p, k) for p in every for k in KINDS if p not in found[k]]
    if missing:
        raise LayoutError("raw skypatches lack " + ", ".join(f"{k} of {p}" for p, k in missing))
    return every


def selected_patches(available: list[int], requested: list[int] | None = None) -> list[int]:
    chosen = sorted({int(p) for p in (available if requested is None else requested)})
    if lost := [p for p in chosen if p not in set(available)]:
        raise LayoutError(f"requested skypatches are unavailable: {lost}")
    return chosen


def read_kind(spark: SparkSession, root: Root, kind: str, patches: list[int]) -> DataFrame:
    """One kind of all patches with its skypatch, by column name: one scan, whose paths tell the patch.

    Only the patches' footers are compared beforehand.
    """
    paths = [patch_path(root, p, kind) for p in patches]
    schemas = [spark.read.parquet(p).schema for p in paths]
    kinds = [{(f.name, f.dataType.simpleString()) for f in s.fields} for s in schemas]
    for p, own in zip(patches, kinds, strict=True):
        if own != kinds[0]:
            raise LayoutError(f"{kind} of patch {p} differs in columns: {sorted(f'{n} {t}' for n, t in own ^ kinds[0])}")
    found = spark.read.schema(schemas[0]).parquet(*paths)
    patch = F.regexp_extract(F.col("_metadata.file_path"), rf"{KINDS[kind]}_skypatch_(\d+)\.parquet", 1).cast("int")
    return found.withColumn("skypatch", patch)


def read_json_file(spark: SparkSession, path: str) -> dict:
    if not exists(spark, path):
        raise LayoutError(f"file is missing: {path}")
    return json.loads(spark.read.text(path, wholetext=True).first()[0])


def load_band_names(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """Bands of each survey in the order of the matrix columns; read when asked for."""
    return read_json_file(spark, path)


def load_time_grids(spark: SparkSession, path: str) -> DataFrame:
    """The shared axes as one row of arrays with checked lengths."""
    if not exists(spark, path):
        raise LayoutError(f"file is missing: {path}")
    grids = spark.read.parquet(path)
    if lost := sorted(set(TIME_GRIDS) - set(grids.columns)):
        raise LayoutError(f"time grids lack {lost}")
    sizes = grids.select(*[F.size(k).alias(k) for k in TIME_GRIDS]).first()
    if wrong := {k: sizes[k] for k, n in TIME_GRIDS.items() if sizes[k] != n}:
        raise LayoutError(f"time grids have lengths {wrong}, not {({k: TIME_GRIDS[k] for k in wrong})}")
    return grids.select(*TIME_GRIDS)


def companion_paths(root: Root, patch: int, kind: str) -> list[str]:
    """Where a companion may lie: directly under root, or in its kind's folder."""
    nested = patch_path(root, patch, kind)
    return [nested] if isinstance(root, dict) else [posixpath.join(root, posixpath.basename(nested)), nested]


def companion_path(spark: SparkSession, root: Root, patch: int, kind: str) -> str:
    """The first of companion_paths() that is there."""
    for path in companion_paths(root, patch, kind):
        if exists(spark, path):
            return path
    raise LayoutError(f"no {kind} of patch {patch} under {root!r}")


def resolve_data_path(spark: SparkSession, relative: str, path: str | None = None, roots: tuple[str | None, ...] = ()) -> str:
    """An explicit path, else the first root that has the file, else ``raw/``."""
    if path is not None:
        return path
    for root in roots:
        if root is not None and exists(spark, candidate := posixpath.join(root, relative)):
            return candidate
    return posixpath.join("raw", relative)


def final_paths(spark: SparkSession, folder: str) -> list[str]:
    """Published catalogues: the folder itself if it holds data, else those of its folders that do, in order."""
    holds = lambda path: any(exists(spark, posixpath.join(path, n)) for n in ("data", "_snapshots"))
    if holds(folder):
        return [folder]
    return [path for n in listing(spark, folder) if holds(path := posixpath.join(folder, n))]


def collect_targets(spark: SparkSession, paths: list[str], folder: str | None = None, required: bool = False) -> list[str]:
    """Explicit catalogues and a folder's, each once, in order."""
    unique: dict[str, str] = {}
    for path in [*paths, *(final_paths(spark, folder) if folder else [])]:
        unique.setdefault(posixpath.normpath(path), path)
    if required and not unique:
        raise LayoutError("there are no targets")
    if lost := [p for p in unique.values() if required and not exists(spark, p)]:
        raise LayoutError(f"targets are missing: {lost}")
    return list(unique.values())


def linked_roots(catalogs: str, luminosities: str, photometry: str) -> dict[str, str]:
    """The three input folders of a run as one virtual root."""
    roots = {"lightcone_catalogs": catalogs, "luminosities": luminosities, "photometry": photometry}
    if lost := [k for k, v in roots.items() if not v]:
        raise LayoutError(f"no folder for {lost}")
    return roots


def as_list(patches: list[int] | int | None) -> list[int] | None:
    return [int(patches)] if isinstance(patches, int) else None if patches is None else sorted({int(p) for p in patches})


def shard_names(spark: SparkSession, root: str, patches: list[int] | int | None = None) -> list[tuple[str, int, int, int]]:
    """(path, patch, shard, declared shards) of the spectra under root, of all patches or the given ones."""
    wanted = as_list(patches)
    found = [(posixpath.join(root, n), *map(int, m.groups())) for n in listing(spark, root) if (m := _SHARD.fullmatch(n))]
    found = [f for f in found if wanted is None or f[1] in wanted]
    if not found or wanted is not None and (set(wanted) - {f[1] for f in found}):
        raise LayoutError(f"no spectra under {root!r}" + (f" for patches {sorted(set(wanted) - {f[1] for f in found})}" if wanted is not None else ""))
    return found


def distinct_patches(df: DataFrame) -> DataFrame:
    return df.select("skypatch").distinct()
