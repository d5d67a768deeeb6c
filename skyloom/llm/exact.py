"""Exact dedup by two-pass Bloom filtering.

A row's fingerprint is the SHA-256 of its text with A-Z in lower case; its
first 60 bits are its hash.  Pass one sets the bits of every hash in a filter
of two planes, *once* and *twice*: a bit that is met again goes to the second
plane, and planes of tasks unite by ``twice |= other.twice | once &
other.once``.  All bits of a repeated hash are then in ``twice``, whoever saw
it.  Pass two tests each row against that plane.  A row that fails is alone:
it passes straight through, without a shuffle.  Only the others meet by their
whole fingerprint, so that what the filter takes for repeated by mistake comes
out as a group of one.

Planes are made in parts: a task sends the words that it set, by segment of
the filter, and no task or driver holds more than the ``twice`` plane of
``filter_rows`` rows (two bytes a row, 32 MB by default).  More rows take further
filters, each for a range of hashes, over the same narrow rows.

Groups of over HOT_ROWS rows (and over a ten-thousandth of all, so at most
10,000 of them) are broadcast with their verdict; of the others each has at
most that many rows in one task.

Defined cases: a null text is an empty one; a null doc_id is smaller than any;
of rows that repeat text and doc_id one stays, which one does not matter; a
very long text is hashed whole and not moved by verdicts(); an empty table
gives no rows; columns named like the verdict's are replaced, others carried.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyloom.llm.common import apart, checkpointed, pack, unpack

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
VERDICT = ("keep_id", "group_size", "kept", "text_sha256")
#: Rows of one filter, bits for a row, words of 64 bits of a segment.
FILTER_ROWS, ROW_BITS, SEGMENT = 1 << 24, 16, 1 << 14
#: Rows of a group whose verdict is broadcast, and most such groups.
HOT_ROWS, HOT_GROUPS = 1000, 10_000
HASH_BITS = 60
#: Odd numbers that spread a hash to its bits: of rows that are alone one in 700 is taken for repeated.
MULTIPLIERS = (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)


def fingerprint(text: Column) -> Column:
    """SHA-256 of the text, A-Z in lower case and nothing else changed, in hexadecimal."""
    return F.sha2(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER).cast("binary"), 256)


def _places(hashes: np.ndarray, words: int) -> np.ndarray:
    """The bits of the filter for each hash, a row for each of them."""
    h = hashes.astype(np.uint64)
    return np.stack([((h * np.uint64(odd)) >> np.uint64(16)) % np.uint64(64 * words) for odd in MULTIPLIERS]).astype(np.int64)


def _set(once: np.ndarray, twice: np.ndarray, places: np.ndarray) -> None:
    """Meets bits with the planes; one that is met again, here or before, goes to the second."""
    at, times = np.unique(places, return_counts=True)
    word, bit = at >> 6, np.uint64(1) << (at & 63).astype(np.uint64)
    again = (times > 1) | (once[word] & bit > 0)
    np.bitwise_or.at(twice, word[again], bit[again])
    np.bitwise_or.at(once, word, bit)


def _holds(plane: np.ndarray, places: np.ndarray) -> np.ndarray:
    return np.all(plane[places >> 6] >> (places & 63).astype(np.uint64) & np.uint64(1) > 0, axis=0)


def _planes(words: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Pass one of a task: its two planes, as the words that it set in each segment."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice = np.zeros(words, np.uint64), np.zeros(words, np.uint64)
        for batch in batches:
            _set(once, twice, _places(batch.column(0).to_numpy(), words))
        used = np.flatnonzero(once)
        for part in np.split(used, np.flatnonzero(np.diff(used // SEGMENT)) + 1):
            if len(part):
                blob = pack({"at": pa.array((part % SEGMENT).astype(np.uint16)), "once": pa.array(once[part]), "twice": pa.array(twice[part])})
                yield pa.RecordBatch.from_arrays([pa.array([part[0] // SEGMENT], pa.int32()), pa.array([blob], pa.binary())], names=["segment", "planes"])

    return build


def _united(key: tuple, parts: pa.Table) -> pa.Table:
    """The ``twice`` plane of a segment from the planes of all tasks."""
    once, twice = np.zeros(SEGMENT, np.uint64), np.zeros(SEGMENT, np.uint64)
    for blob in parts.column("planes"):
        own = unpack(blob.as_py())
        at, first, second = (own.column(i).to_numpy() for i in range(3))
        twice[at] |= second | (once[at] & first)
        once[at] |= first
    return pa.table({"segment": pa.array([key[0].as_py()], pa.int32()), "twice": pa.array([pack({"twice": pa.array(twice)})], pa.binary())})


def _repeated(hashes: DataFrame, rows: int) -> np.ndarray:
    """The ``twice`` plane over a column of hashes, of ROW_BITS bits a row."""
    words = max(1, -(-rows * ROW_BITS // 64))
    parts = hashes.mapInArrow(_planes(words), "segment int, planes binary")
    whole = np.zeros(-(-words // SEGMENT) * SEGMENT, np.uint64)
    for segment, blob in parts.groupBy("segment").applyInArrow(_united, "segment int, twice binary").collect():
        whole[segment * SEGMENT : (segment + 1) * SEGMENT] = unpack(bytes(blob)).column(0).to_numpy()
    return whole[:words]


def _test(plane: Broadcast):
    """Pass two: whether all bits of a hash are in the plane."""

    @F.pandas_udf("boolean")
    def possible(h: pd.Series) -> pd.Series:
        return pd.Series(_holds(plane.value, _places(h.to_numpy(), len(plane.value))))

    return possible


def _tested(rows: DataFrame, filter_rows: int) -> tuple[DataFrame, int]:
    """rows (with _h) with _possible, false where the hash is surely alone; and how many rows there are."""
    count = rows.count()
    filters = max(1, -(-count // filter_rows))
    out = None
    for k in range(filters):
        low, high = (k << HASH_BITS) // filters, ((k + 1) << HASH_BITS) // filters
        own = rows if filters == 1 else rows.where((F.col("_h") >= low) & (F.col("_h") < high))
        plane = rows.sparkSession.sparkContext.broadcast(_repeated(own.select("_h"), max(1, count // filters)))
        own = own.withColumn("_possible", _test(plane)("_h"))
        out = own if out is None else out.unionByName(own)
    return out, count


def _marked(rows: DataFrame, id_column: str, filter_rows: int, hot_rows: int) -> DataFrame:
    tested, count = _tested(rows, filter_rows)
    alone = tested.where("not _possible").select("*", F.col(id_column).alias("_keep"), F.lit(1).cast("long").alias("_size"), F.lit(True).alias("_kept"))
    # the row number is fixed by the checkpoint, so rows that are equal in all else can be told apart
    met = checkpointed(tested.where("_possible").withColumn("_row", F.monotonically_increasing_id()))
    groups = met.groupBy("_sha").agg(F.count(F.lit(1)).alias("_size"), F.max(F.struct(F.col(id_column).alias("id"), F.col("_row").alias("row"))).alias("_best"))
    limit = max(hot_rows, count // HOT_GROUPS)
    hot = rows.sparkSession.createDataFrame(groups.where(F.col("_size") > limit).toArrow(), groups.schema)
    first = met.join(F.broadcast(hot), "_sha", "left")
    rest = first.where("_size is null").drop("_size", "_best").join(groups.where(F.col("_size") <= limit), "_sha")
    found = first.where("_size is not null").unionByName(rest)
    found = found.select("*", F.col("_best.id").alias("_keep"), (F.col("_best.row") == F.col("_row")).alias("_kept")).drop("_best", "_row")
    return alone.unionByName(found)


def mark(docs: DataFrame, filter_rows: int = FILTER_ROWS, hot_rows: int = HOT_ROWS, with_text: bool = True) -> DataFrame:
    """docs with keep_id, group_size, kept and text_sha256; of the texts only possibly repeated ones move.

    Without ``with_text`` the text is dropped at once: it is read one time, and
    what is kept of a row is its other columns and its fingerprint.
    """
    rows, names = apart(docs)
    rows = rows.withColumn("_sha", fingerprint(F.col(names["text"])))
    rows = rows.withColumns({"_h": F.conv(F.substring("_sha", 1, HASH_BITS // 4), 16, 10).cast("long"), "_sha": F.unhex("_sha")})
    own = {c: name for c, name in names.items() if c not in VERDICT and (with_text or c != "text")}
    rows = rows.select(*{*own.values(), names["doc_id"]}, "_sha", "_h")
    found = _marked(rows if with_text else checkpointed(rows), names["doc_id"], filter_rows, hot_rows)
    verdict = (F.col("_keep").alias("keep_id"), F.col("_size").alias("group_size"), F.col("_kept").alias("kept"), F.lower(F.hex("_sha")).alias("text_sha256"))
    return found.select(*[F.col(name).alias(c) for c, name in own.items()], *verdict)


def verdicts(docs: DataFrame, **limits: int) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 of every row."""
    return mark(docs.select("doc_id", "text"), with_text=False, **limits)


def deduplicated(docs: DataFrame, **limits: int) -> DataFrame:
    """The rows that stay, with the columns of docs."""
    rows, names = apart(docs)
    rows = mark(rows.withColumnsRenamed({names["doc_id"]: "doc_id", names["text"]: "text"}), **limits).where("kept")
    return rows.select(*[F.col({"doc_id": "doc_id", "text": "text"}.get(c, name)).alias(c) for c, name in names.items()])


def sql() -> str:
    return f"""
WITH n AS (SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM n WINDOW w AS (PARTITION BY t)"""
