"""Sharding by histogram sort.

Documents are ordered by (60 bits of the text's MD5, doc_id), so equal texts
lie side by side.  A splitter is a row of that order: the first with at least
i/shards of all bytes below it.  The bracket of its key shrinks by rounds:
executors sample keys inside the open brackets, count the exact bytes and rows
below these probes, and the driver keeps the two probes around each target; a
bracket of few rows is listed whole and settles the key exactly (tolerance 0).
Rows of one key are alike, so a division tells how many of them lie below the
splitter.  Only then are the rows exchanged, once, to ranges a fraction of a
shard wide, whose exact row counts give every row its place, and by that its
shard and slot.

A key that very many rows share has a range of its own, which no order can cut:
its rows are staged, keep the partition where they lie, and are numbered there
behind the counts of the partitions before, so no task gets all of them.

Law ``bytes``: a row's size is its UTF-8 bytes plus 8, and a shard's size
differs from the mean by less than the largest row, whatever rows are alike.

Defined cases: a null text counts 0 bytes and comes before all others; a null
doc_id sorts first; rows of equal doc_id and text are in any order among
themselves, and a splitter may part them; a very long text is hashed and moved
whole; an empty table gives no rows.  Columns shard_* that the operator adds
replace columns of these names.
"""

from __future__ import annotations

import bisect

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from skyloom.llm.common import apart, checkpointed

SHARDS = 24
#: Keys sampled from a bracket in a round; a bracket of fewer rows is listed.
SAMPLE = 64
#: Ranges that a shard, or a partition of the exchange, is cut into at least, and rows aimed at in one.
RANGES, RANGE_ROWS, REFINEMENTS = 8, 200_000, 4
HASH_BITS = 60

_NULL = -(1 << 63)


def keyed(docs: DataFrame) -> DataFrame:
    """docs with shard_hash, shard_id, shard_bytes and shard_crc."""
    digest = F.md5(F.col("text").cast("binary"))
    return docs.withColumns(
        {
            "shard_hash": F.coalesce(F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("long"), F.lit(-1)),
            "shard_id": F.coalesce(F.col("doc_id").cast("long"), F.lit(_NULL)),
            "shard_bytes": F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 8,
            "shard_crc": F.crc32(F.coalesce("text", F.lit(""))).cast("long"),
        }
    )


def _codes(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Pairs of longs as 16-byte strings of the same order."""
    out = np.empty((len(high), 2), ">u8")
    out[:, 0] = high.astype(np.int64).view(np.uint64) ^ np.uint64(1 << 63)
    out[:, 1] = low.astype(np.int64).view(np.uint64) ^ np.uint64(1 << 63)
    return out.reshape(-1).view("S16")


def _code_table(probes: list[tuple[int, int]]) -> np.ndarray:
    return _codes(*(np.array([p[i] for p in probes], np.int64) for i in (0, 1)))


def _positions(probes: list[tuple[int, int]], high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """How many of the sorted probes are at or below each key."""
    if not probes:
        return np.zeros(len(high), np.int64)
    return np.searchsorted(_code_table(probes), _codes(high, low), side="right")


def _columns(batch: pa.RecordBatch, *names: str) -> list[np.ndarray]:
    return [batch.column(n).to_numpy(zero_copy_only=False) for n in names]


def _histogram(keys: DataFrame, probes: list[tuple[int, int]]) -> tuple[list[int], list[int]]:
    """Exact bytes and rows below each probe: partial sums per partition, then totals."""

    def partial(batches):
        n = len(probes) + 1
        total = np.zeros((2, n), np.int64)
        for batch in batches:
            high, low, size = _columns(batch, "shard_hash", "shard_id", "shard_bytes")
            at = _positions(probes, high, low)
            np.add.at(total[0], at, size)
            total[1] += np.bincount(at, minlength=n)
        used = np.flatnonzero(total[1])
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (used, total[0][used], total[1][used])], names=["at", "bytes", "rows"])

    sums = keys.mapInArrow(partial, "at long, bytes long, rows long").groupBy("at").agg(F.sum("bytes"), F.sum("rows")).collect()
    size, rows = [0] * (len(probes) + 1), [0] * (len(probes) + 1)
    for at, b, n in sums:
        size[at], rows[at] = b, n
    return np.cumsum(size).tolist(), np.cumsum(rows).tolist()


def _sampled(keys: DataFrame, bounds: list[tuple[int, int]], rates: dict[int, float], salt: int) -> list[tuple[int, int, int, int]]:
    """(bracket, hash, id, bytes) of hash-sampled rows, by the rate of their bracket."""

    def pick(batches):
        for batch in batches:
            high, low, size = _columns(batch, "shard_hash", "shard_id", "shard_bytes")
            at = _positions(bounds, high, low)
            with np.errstate(over="ignore"):
                dice = (high.view(np.uint64) ^ np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15) + low.view(np.uint64)
                dice = (dice ^ (dice >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
            rate = np.zeros(len(bounds) + 1)
            for k, v in rates.items():
                rate[k] = v
            keep = (dice >> np.uint64(11)) / float(1 << 53) < rate[at]
            yield pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in (at, high, low, size)], names=["at", "high", "low", "size"])

    return [tuple(r) for r in keys.mapInArrow(pick, "at long, high long, low long, size long").collect()]


def _after(key: tuple[int, int]) -> tuple[int, int]:
    """The least key above this one."""
    return (key[0], key[1] + 1) if key[1] < (1 << 63) - 1 else (key[0] + 1, _NULL)


def splitters(keys: DataFrame, shards: int = SHARDS, sample: int = SAMPLE) -> tuple[list[tuple[int, int] | None], list[int], int]:
    """The keys at or after the shards - 1 splitters (None: no such key), the rows below each splitter, and all rows."""
    total, count = _histogram(keys, [])
    total, count = total[-1], count[-1]
    # bracket of splitter i: greatest key known to be too low, least key known to do
    low: list[tuple] = [(None, 0, 0)] * (shards - 1)  # key, bytes below, rows below
    high: list[tuple] = [(None, total, count)] * (shards - 1)
    done: list = [False] * (shards - 1)
    target = [i * total for i in range(1, shards)]  # compared with shards * bytes
    salt = 1
    while count and not all(done):
        open_ = [i for i in range(shards - 1) if not done[i]]
        bounds = sorted({k for i in open_ for k in (low[i][0], high[i][0]) if k is not None})
        rates: dict[int, float] = {}
        for i in open_:
            first = bisect.bisect_right(bounds, low[i][0]) if low[i][0] is not None else 0
            last = bisect.bisect_left(bounds, high[i][0]) if high[i][0] is not None else len(bounds)
            inside = high[i][2] - low[i][2]
            for at in range(first, last + 1):
                rates[at] = max(rates.get(at, 0.0), 1.1 if inside <= sample else sample / inside)
        seen = _sampled(keys, bounds, rates, salt)
        salt += 1
        # the key after a bracket's lower end settles many rows of one key
        after = {_after(low[i][0]) for i in open_ if low[i][0] is not None}
        probes = sorted({(h, k) for _, h, k, _ in seen} | after)
        below, rows = _histogram(keys, probes)
        for i in open_:
            inside = high[i][2] - low[i][2]
            for key, b, n in zip(probes, below, rows, strict=False):
                if low[i][0] is not None and key <= low[i][0] or high[i][0] is not None and key >= high[i][0]:
                    continue
                if shards * b >= target[i]:
                    high[i] = (key, b, n)
                    break
                low[i] = (key, b, n)
            bottom = low[i][0]
            # every key of the bracket was a probe, or the bracket is one key
            done[i] = inside <= sample or bottom is not None and high[i][0] == _after(bottom)
    below = []
    for i in range(shards - 1) if count else ():
        # the splitter lies among the rows between the bracket's ends, which all have the key of its lower end
        (_, first, rows), (_, last, end) = low[i], high[i]
        size = (last - first) // (end - rows)
        below.append(rows + -(-(target[i] - shards * first) // (shards * size)))
    return [h[0] for h in high], below, count


def _hot_keys(keys: DataFrame, fine: list[tuple[int, int]], heavy: list[int], most: int) -> list[tuple[int, int]]:
    """Keys of more than ``most`` rows inside some ranges; there are at most all rows / ``most`` of them."""
    if not heavy:
        return []

    def inside(batches):
        for batch in batches:
            high, low = _columns(batch, "shard_hash", "shard_id")
            keep = np.isin(_positions(fine, high, low), heavy)
            yield pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in (high, low)], names=["high", "low"])

    counted = keys.mapInArrow(inside, "high long, low long").groupBy("high", "low").count().where(F.col("count") > most)
    return [(h, i) for h, i, _ in counted.collect()]


def _ranges(keys: DataFrame, cuts: list[tuple[int, int]], count: int, ranges: int, range_rows: int) -> tuple[list[tuple[int, int]], list[int], list[bool]]:
    """Least keys of ranges of at most some range_rows rows, the rows before each range, and which have one key of more rows."""
    fine = sorted(set(cuts) | {((k << HASH_BITS) // ranges, _NULL) for k in range(1, ranges)})
    for turn in range(REFINEMENTS):  # ranges that hold too many rows (copies of one text) are cut at sampled keys
        _, below = _histogram(keys, fine)
        rows_in = np.diff([0, *below])
        heavy = {k: min(1.0, 4.0 * SAMPLE / n) for k, n in enumerate(rows_in.tolist()) if n > 2 * range_rows}
        if not heavy:
            break
        seen: dict[int, list[tuple[int, int]]] = {}
        for at, h, i, _ in _sampled(keys, fine, heavy, 1000 + turn):
            seen.setdefault(at, []).append((h, i))
        for at, found in seen.items():
            found = sorted(set(found))
            parts = min(len(found), -(-int(rows_in[at]) // range_rows))
            fine = [*fine, *(found[len(found) * j // parts] for j in range(1, parts))]
        fine = sorted(set(fine))
    _, below = _histogram(keys, fine)
    hot = set(_hot_keys(keys, fine, [k for k, n in enumerate(np.diff([0, *below]).tolist()) if n > 2 * range_rows], range_rows))
    fine = sorted({*fine, *hot, *map(_after, hot)})
    _, below = _histogram(keys, fine)
    return fine, [0, *below[:-1]], [False, *(k in hot for k in fine)]


def _placed(docs: DataFrame, shards: int, sample: int, range_rows: int) -> tuple[DataFrame, list[int]]:
    """docs with shard_range, shard_part and shard_place, the place in the whole order; and the rows below each splitter."""
    rows = keyed(docs)
    keys = checkpointed(rows.select("shard_hash", "shard_id", "shard_bytes"))
    cuts, below, count = splitters(keys, shards, sample)
    # several ranges for each partition of the exchange, so that they even out
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    range_rows = min(range_rows, max(1, -(-count // (RANGES * max(shards, partitions)))))
    fine, starts, hot = _ranges(keys, [c for c in cuts if c is not None], count, max(RANGES * shards, -(-count // range_rows)), range_rows)

    # a row for each range, of RANGE_ROWS rows of the table
    table = docs.sparkSession.sparkContext.broadcast((_code_table(fine), np.array(starts, np.int64), np.array(hot, bool)))

    @F.pandas_udf("number int, base long, hot boolean")
    def range_of(high: pd.Series, low: pd.Series) -> pd.DataFrame:
        codes, base, hot = table.value
        at = np.searchsorted(codes, _codes(high.to_numpy(), low.to_numpy()), side="right") if len(codes) else np.zeros(len(high), np.int64)
        return pd.DataFrame({"number": at.astype(np.int32), "base": base[at], "hot": hot[at]})

    rows = rows.withColumn("shard_range", range_of("shard_hash", "shard_id"))
    rows = rows.select("*", F.col("shard_range.base").alias("shard_base"), F.col("shard_range.hot").alias("shard_hot")).withColumn("shard_range", F.col("shard_range.number"))
    order = Window.partitionBy("shard_range", "shard_part").orderBy("shard_hash", "shard_id")
    place = (F.col("shard_base") + F.row_number().over(order) - 1).alias("shard_place")
    plain = rows.where("not shard_hot").withColumn("shard_part", F.lit(0))
    if any(hot):
        # where these rows lie is fixed by the checkpoint
        staged = checkpointed(rows.where("shard_hot").withColumn("shard_part", F.spark_partition_id()))
        parts = staged.groupBy("shard_range", "shard_part").agg(F.count(F.lit(1)).alias("n"))
        before = Window.partitionBy("shard_range").orderBy("shard_part").rowsBetween(Window.unboundedPreceding, -1)
        parts = parts.select("shard_range", "shard_part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shard_before")).toArrow()  # as many as hot keys have partitions
        offsets = F.broadcast(docs.sparkSession.createDataFrame(parts))
        staged = staged.join(offsets, ["shard_range", "shard_part"]).withColumn("shard_base", F.col("shard_base") + F.col("shard_before"))
        plain = plain.unionByName(staged.select(*plain.columns))
    return plain.select("*", place), below


def _shard(docs: DataFrame, shards: int, sample: int, range_rows: int) -> DataFrame:
    rows, below = _placed(docs, shards, sample, range_rows)
    at = F.col("shard_place")
    shard = sum((F.when(at >= b, 1).otherwise(0) for b in below), F.lit(0)).cast("int")
    first = F.get(F.array(*[F.lit(b).cast("long") for b in [0, *below]]), F.col("shard"))
    return rows.withColumn("shard", shard).withColumn("shard_slot", at - first)


def shard(docs: DataFrame, shards: int = SHARDS, sample: int = SAMPLE, range_rows: int = RANGE_ROWS) -> DataFrame:
    """docs with shard, shard_slot, shard_bytes and shard_crc; texts move once."""
    added = ("shard", "shard_slot", "shard_bytes", "shard_crc")
    rows, names = apart(docs)
    rows = _shard(rows.withColumnsRenamed({names["doc_id"]: "doc_id", names["text"]: "text"}), shards, sample, range_rows)
    own = [F.col({"doc_id": "doc_id", "text": "text"}.get(c, name)).alias(c) for c, name in names.items() if c not in added]
    return rows.select(*own, *added)


def sql(shards: int = SHARDS) -> str:
    """Sizes, CRC-32, shards and slots by one ordered pass, in DuckDB; the checksum goes bit by bit."""
    return f"""
WITH k AS (SELECT doc_id, coalesce(octet_length(encode(text)), 0) + 8 AS size, hex(encode(coalesce(text, ''))) AS h,
             coalesce(('0x' || substr(md5(text), 1, {HASH_BITS // 4}))::BIGINT, -1) AS key FROM documents),
c AS (SELECT *, xor(list_reduce([4294967295::BIGINT] || list_transform(range(1, length(h) // 2 + 1), lambda i: ('0x' || substr(h, 2 * i - 1, 2))::BIGINT),
        lambda c, x: list_reduce([xor(c, x), 0, 0, 0, 0, 0, 0, 0, 0], lambda y, z: xor(y >> 1, 3988292384::BIGINT * (y & 1)))), 4294967295) AS crc FROM k),
p AS (SELECT *, ((sum(size) OVER (ORDER BY key, doc_id ROWS UNBOUNDED PRECEDING) - size) * {shards} // sum(size) OVER ())::INTEGER AS shard FROM c)
SELECT doc_id, size::BIGINT AS size, crc::BIGINT AS text_crc32, 'bytes' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY key, doc_id) - 1 AS slot, NULL::INTEGER AS grown_shard FROM p"""
