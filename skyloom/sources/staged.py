"""Raw sources staged once, so that every later run joins them without moving them.

Each kind is a table in buckets of (skypatch, source_global_row), one file a
bucket: rows of equal keys of all kinds lie in buckets of equal number, which
Spark joins side by side.  ``staged.json`` says how many buckets there are and
what the columns are; a session registers the tables when it opens them.
"""

from __future__ import annotations

import hashlib
import json
import posixpath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from skyloom.errors import LayoutError
from skyloom.sources import layout, snapshots

KEYS = ("skypatch", "source_global_row")
RECORD = "staged.json"


def is_staged(spark: SparkSession, root: layout.Root) -> bool:
    return isinstance(root, str) and layout.exists(spark, posixpath.join(root, RECORD))


def record_of(spark: SparkSession, root: str) -> dict:
    return layout.read_json_file(spark, posixpath.join(root, RECORD))


def _name(root: str, kind: str) -> str:
    return f"skyloom_{kind}_{hashlib.md5(root.encode()).hexdigest()[:12]}"


def write(spark: SparkSession, root: str, sources: dict[str, DataFrame], patches: list[int], buckets: int | None = None) -> None:
    """Stages sources that have ``skypatch`` and ``source_global_row``; the record is written last and makes them whole."""
    if is_staged(spark, root):
        raise LayoutError(f"{root} holds staged sources already")
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    for kind, df in sources.items():
        name = _name(root, kind)
        spark.sql(f"DROP TABLE IF EXISTS `{name}`")
        snapshots.remove(spark, posixpath.join(root, kind))
        dealt = df.repartition(buckets, *KEYS)  # the same hash as that of buckets, so a task writes one file
        dealt.write.format("parquet").bucketBy(buckets, *KEYS).sortBy(*KEYS).option("path", posixpath.join(root, kind)).saveAsTable(name)
    told = {"buckets": buckets, "patches": patches, "kinds": {kind: df.schema.json() for kind, df in sources.items()}}
    if not snapshots.write_file(spark, posixpath.join(root, RECORD), json.dumps(told)):
        raise LayoutError(f"{root} was staged by another writer")


def read(spark: SparkSession, root: str, kind: str) -> DataFrame:
    """A staged kind as a table in buckets."""
    told = record_of(spark, root)
    schema, name = T.StructType.fromJson(json.loads(told["kinds"][kind])), _name(root, kind)
    keys = ", ".join(f"`{k}`" for k in KEYS)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    place = posixpath.join(root, kind).replace("'", "\\'")
    spark.sql(f"CREATE TABLE IF NOT EXISTS `{name}` ({columns}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {told['buckets']} BUCKETS LOCATION '{place}'")
    found = spark.table(name)
    for f in schema.fields:
        if f.metadata:
            found = found.withMetadata(f.name, f.metadata)
    return found
