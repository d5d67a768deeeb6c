"""Catalogues of several tables that change together.

A catalogue's tables lie in folders of their own, and ``_snapshots`` holds a
numbered file for each state: which folders, or which partitions of them, each
table is made of.  New folders are written first, under names that no state
knows; the next number's file then makes all of them visible at once.  It gets
its name by a rename that does not overwrite (atomic where the file system's
is), so of two writers that start from one state one fails.  A reader takes the greatest number when it opens the catalogue and sees
that state, whole, however far a writer has come; what a killed writer leaves is
unknown to all states and goes with the next commit.

A folder without such a file is an older catalogue: its tables are its folders.
"""

from __future__ import annotations

import functools
import json
import posixpath
import re
import uuid

from pyspark.sql import DataFrame, SparkSession

from skyloom.errors import LayoutError
from skyloom.sources import layout

FOLDER = "_snapshots"
#: States that keep their folders: the last one and the one before, which readers may still have open.
KEPT = 2
#: name -> [[folder, [partition, ...] or None], ...]
State = dict[str, list]
_NUMBER = re.compile(r"(\d{8})\.json")


def _numbers(spark: SparkSession, root: str) -> list[int]:
    return [int(m[1]) for n in layout.listing(spark, posixpath.join(root, FOLDER)) if (m := _NUMBER.fullmatch(n))]


def _file(root: str, number: int) -> str:
    return posixpath.join(root, FOLDER, f"{number:08d}.json")


def state(spark: SparkSession, root: str, tables: tuple[str, ...] = ()) -> tuple[int, State]:
    """The number (0: none yet) and the state of a catalogue; ``tables`` are the names that an older one may have."""
    if numbers := _numbers(spark, root):
        return max(numbers), layout.read_json_file(spark, _file(root, max(numbers)))
    there = set(layout.listing(spark, root))
    return 0, {t: [[t, None]] for t in tables if t in there}


def read(spark: SparkSession, root: str, name: str, found: State | None = None) -> DataFrame:
    """A table of the catalogue's state (by default the last one)."""
    folders = (state(spark, root, (name,))[1] if found is None else found).get(name)
    if not folders:
        raise LayoutError(f"{root} has no table {name}")
    parts = []
    for folder, only in folders:
        base = posixpath.join(root, folder)
        parts.append(spark.read.parquet(base) if only is None else spark.read.option("basePath", base).parquet(*[posixpath.join(base, p) for p in only]))
    return functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def has(spark: SparkSession, root: str, name: str) -> bool:
    return name in state(spark, root, (name,))[1]


def is_catalogue(spark: SparkSession, root: str) -> bool:
    return has(spark, root, "data")


def new_folder(name: str) -> str:
    return f"{name}.{uuid.uuid4().hex[:12]}"


def partitions(spark: SparkSession, path: str) -> list[str]:
    return [n for n in layout.listing(spark, path) if "=" in n]


def merged(old: list, folder: str, written: list[str], replaced: list[str]) -> list:
    """A table's folders after some of its partitions were replaced by those ``written`` to ``folder``."""
    kept = [[f, [p for p in only if p not in replaced]] for f, only in old]
    return [[f, only] for f, only in kept if only] + ([[folder, written]] if written else [])


def listed(spark: SparkSession, root: str, folders: list) -> list:
    """The same with every partition named."""
    return [[f, partitions(spark, posixpath.join(root, f)) if only is None else only] for f, only in folders]


def write_file(spark: SparkSession, path: str, text: str) -> bool:
    """Puts a whole small file at path unless something is there: written aside, then renamed without overwriting."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    target, aside = (jvm.org.apache.hadoop.fs.Path(p) for p in (path, f"{path}.{uuid.uuid4().hex[:8]}.new"))
    system = target.getFileSystem(conf)
    out = system.create(aside, False)
    out.write(bytearray(text.encode()))
    out.close()
    try:
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(system.getUri(), conf)
        context.rename(aside, target, spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0))
    except Exception:  # it is there already
        system.delete(aside, False)
        return False
    return True


def remove(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def start(spark: SparkSession, root: str) -> None:
    """State 0 of a new catalogue, without tables: whatever is written before the first commit is unseen."""
    write_file(spark, _file(root, 0), "{}")


def commit(spark: SparkSession, root: str, before: int, after: State) -> int:
    """Makes ``after`` the state that follows number ``before``; fails if another writer was faster."""
    if max(_numbers(spark, root), default=0) != before or not write_file(spark, _file(root, before + 1), json.dumps(after, indent=1)):
        raise LayoutError(f"{root} was changed by another writer")
    tidy(spark, root)
    return before + 1


def abandon(spark: SparkSession, root: str, folders: list[str]) -> None:
    """Removes what a failed writer has made, and a catalogue that has never had a table."""
    for folder in folders:
        remove(spark, posixpath.join(root, folder))
    if _numbers(spark, root) == [0]:
        remove(spark, posixpath.join(root, FOLDER))
    if not layout.listing(spark, root):
        remove(spark, root)


def tidy(spark: SparkSession, root: str) -> None:
    """Removes the folders of this catalogue that only older states know, or none at all, and the files of these states."""
    numbers = sorted(_numbers(spark, root))
    known = {f for n in numbers[-KEPT:] for folders in layout.read_json_file(spark, _file(root, n)).values() for f, _ in folders}
    tables = {t for n in numbers for t in layout.read_json_file(spark, _file(root, n))}
    for name in layout.listing(spark, root):
        if name.split(".")[0] in tables and name not in known:
            remove(spark, posixpath.join(root, name))
    for n in numbers[:-KEPT]:
        remove(spark, _file(root, n))
