"""Exact top-k search over binary codes by incremental multi-index hashing.

A vector's code has a bit for each positive component.  Codes are cut into
16-bit segments, each with a table from value to codes.  A search looks up
all values within radius 0, then 1, 2, ... of its own segments, one segment
after the other, and verifies what it meets by full Hamming distance.  After
segment a at radius r every code within segments * r + a bits has been met, so
a query ends when k codes lie within that bound.

Rows are dealt into shards of bounded size.  Each shard is indexed once and
stays where it is; only the queries, packed in blocks, are copied to every
shard and streamed through its index, and a window merges the shards' answers.  Rows of one code are one entry with its least ids, of which
k + 1 can matter.

Defined cases: rows without id or vector are neither found nor searched for;
missing components count as not positive, shorter vectors are filled up so; a
row never finds its own id; equal distances go by id; of rows that repeat an id
the one of the least code counts; an empty table gives no rows; further columns
are ignored.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from skyloom.llm.common import mix64

K, EVERY = 10, 50
SEGMENT = 16
#: Rows of an index, rows at least where a small input is dealt to idle tasks, and queries of a block.
SHARD_ROWS, LEAST_ROWS, BLOCK_QUERIES = 1 << 18, 1 << 13, 1 << 10
#: Table look-ups made at once.
CHUNK = 1 << 18


def binary_codes(vectors: list[list[float] | None], dims: int) -> np.ndarray:
    """uint16 segments of the sign bits, one row a vector."""
    width = -(-dims // SEGMENT) * SEGMENT
    bits = np.zeros((len(vectors), width), np.uint8)
    for i, v in enumerate(vectors):
        x = np.array([0.0 if c is None else c for c in v], np.float64) if v is not None else np.zeros(0)
        bits[i, : len(x)] = x > 0
    return np.packbits(bits, axis=1, bitorder="little").view("<u2").astype(np.uint16)


def _bytes(codes: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(codes, "<u2").view(f"S{2 * codes.shape[1]}").reshape(-1)


def _masks(radius: int) -> np.ndarray:
    return np.array([sum(1 << b for b in c) for c in combinations(range(SEGMENT), radius)], np.uint16)


class MultiIndex:
    """Segment tables over distinct codes, each with its ``keep`` least ids."""

    def __init__(self, ids: np.ndarray, codes: np.ndarray, keep: int):
        order = np.lexsort((_bytes(codes), ids))
        order = order[np.concatenate([np.ones(min(1, len(order)), bool), np.diff(ids[order]) != 0])]  # the least code of each id
        ids, codes = ids[order], codes[order]
        order = np.lexsort((ids, *codes.T[::-1]))
        ids, codes = ids[order], codes[order]
        new = np.ones(len(ids), bool)
        new[1:] = (codes[1:] != codes[:-1]).any(axis=1)
        self.codes = codes[new]
        first = np.flatnonzero(new)
        size = np.minimum(np.diff(np.append(first, len(ids))), keep)
        self.first = np.cumsum(size) - size
        self.size = size
        self.ids = ids[np.repeat(first - self.first, size) + np.arange(size.sum())]
        self.tables = []
        for s in range(codes.shape[1]):
            value = self.codes[:, s]
            self.tables.append((np.argsort(value, kind="stable"), np.concatenate([[0], np.cumsum(np.bincount(value, minlength=1 << SEGMENT))])))

    def _met(self, query: np.ndarray, codes: np.ndarray, s: int, r: int):
        """(query, code, distance) not met at an earlier step, by look-ups in table s at radius r."""
        order, offset = self.tables[s]
        masks = _masks(r)
        step = max(1, CHUNK // len(masks))
        for low in range(0, len(query), step):
            part = query[low : low + step]
            value = (codes[part, s][:, None] ^ masks).reshape(-1)
            n = offset[value.astype(np.int64) + 1] - offset[value]
            q = np.repeat(np.repeat(part, len(masks)), n)
            c = order[np.repeat(offset[value] - np.cumsum(n) + n, n) + np.arange(n.sum())]
            d = np.bitwise_count(codes[q] ^ self.codes[c])
            fresh = (d[:, :s] > r).all(axis=1) & (d[:, s + 1 :] >= r).all(axis=1)
            yield q[fresh], c[fresh], d[fresh].sum(axis=1, dtype=np.int64)

    def search(self, codes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, code, distance) of all codes that the k nearest ids of each query can have."""
        m = codes.shape[1]
        seen = np.zeros((len(codes), m * SEGMENT + 1), np.int64)
        bound = np.full(len(codes), m * SEGMENT)
        open_ = np.arange(len(codes))
        met = []
        for r in range(SEGMENT + 1):
            for s in range(m):
                for q, c, d in self._met(open_, codes, s, r):
                    np.add.at(seen, (q, d), self.size[c])
                    met.append((q, c, d))
                within = min(m * r + s, m * SEGMENT)
                enough = seen[open_, : within + 1].sum(axis=1) >= k
                everything = seen[open_].sum(axis=1) == len(self.ids)
                bound[open_] = np.where(everything, m * SEGMENT, within)
                open_ = open_[~(enough | everything)]
                if not len(open_):
                    break
            if not len(open_):
                break
        if not met:
            none = np.zeros(0, np.int64)
            return none, none, none
        q, c, d = (np.concatenate(x) for x in zip(*met, strict=True))
        good = d <= bound[q]
        return q[good], c[good], d[good]


def nearest(index: MultiIndex, ids: np.ndarray, codes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query id, neighbour id, distance), the k least by distance and id, without the query's own."""
    distinct, back = np.unique(codes, axis=0, return_inverse=True)
    q, c, d = index.search(distinct, k + 1)
    order = np.argsort(q, kind="stable")
    q, c, d = q[order], c[order], d[order]
    low, high = np.searchsorted(q, back), np.searchsorted(q, back, side="right")
    out = []
    for i in range(len(ids)):
        own = slice(low[i], high[i])
        size = index.size[c[own]]
        near = index.ids[np.repeat(index.first[c[own]] - np.cumsum(size) + size, size) + np.arange(size.sum())]
        far = np.repeat(d[own], size)
        other = near != ids[i]
        near, far = near[other], far[other]
        best = np.lexsort((near, far))[:k]
        out.append((np.full(len(best), ids[i]), near[best], far[best]))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else (np.zeros(0, np.int64),) * 3


def top_k(vectors: DataFrame, k: int = K, every: int = EVERY, shard_rows: int = SHARD_ROWS, block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """query_id, neighbour_id, distance, rank for each row whose id ``every`` divides."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").where("vec_id is not null and embedding is not null")
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("embedding")).alias("dims"), F.count_if(F.col("vec_id") % every == 0).alias("q")).first()
    dims = max(1, size["dims"] or 0)
    tasks = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shards = max(1, -(-size["n"] // shard_rows), min(tasks, size["n"] // LEAST_ROWS))

    def pack(cuts: list, ids: np.ndarray, codes: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([p for p, _ in cuts], pa.int32()), pa.array([ids[c].tobytes() for _, c in cuts], pa.binary()), pa.array([codes[c].tobytes() for _, c in cuts], pa.binary())],
            names=["shard", "ids", "codes"],
        )

    def to_shards(batches):
        for batch in batches:
            ids = batch.column("vec_id").to_numpy()
            part = (mix64(ids.view(np.uint64)) % np.uint64(shards)).astype(np.int32)
            yield pack([(p, part == p) for p in np.unique(part).tolist()], ids, binary_codes(batch.column("embedding").to_pylist(), dims))

    def coded(batches):
        for batch in batches:
            codes = binary_codes(batch.column("embedding").to_pylist(), dims)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array([c.tobytes() for c in codes], pa.binary())], names=["vec_id", "code"])

    def to_blocks(batches):
        for batch in batches:
            ids = batch.column("vec_id").to_numpy()
            codes = np.frombuffer(b"".join(batch.column("code").to_pylist()), np.uint16).reshape(len(ids), -1)
            yield pack([(-1, slice(low, low + block_queries)) for low in range(0, len(ids), block_queries)], ids, codes)

    def opened(ids: list[bytes], codes: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        ids = np.frombuffer(b"".join(ids), np.int64)
        return ids, np.frombuffer(b"".join(codes), np.uint16).reshape(len(ids), -1)

    def search(batches):
        """A partition's shards one after the other: first the rows, then the queries."""
        shard, held, index = None, [], None
        for batch in batches:
            for at, asks, ids, codes in zip(*(batch.column(c).to_pylist() for c in ("shard", "asks", "ids", "codes")), strict=True):
                if at != shard:
                    shard, held, index = at, [], None
                if not asks:
                    held.append((ids, codes))
                    continue
                if held:
                    index, held = MultiIndex(*opened(*zip(*held, strict=True)), keep=k + 1), []
                if index is not None:
                    found = nearest(index, *opened([ids], [codes]), k)
                    yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in found], names=["query_id", "neighbour_id", "distance"])

    columns = "shard int, ids binary, codes binary"
    data = rows.mapInArrow(to_shards, columns).withColumn("asks", F.lit(False))
    asked = rows.where(F.col("vec_id") % every == 0).mapInArrow(coded, "vec_id long, code binary").groupBy("vec_id").agg(F.min("code").alias("code"))
    asked = asked.mapInArrow(to_blocks, columns).withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).withColumn("asks", F.lit(True))
    dealt = data.unionByName(asked).repartition(min(shards, 1 << 15), "shard").sortWithinPartitions("shard", "asks")
    found = dealt.mapInArrow(search, "query_id long, neighbour_id long, distance long")
    order = Window.partitionBy("query_id").orderBy("distance", "neighbour_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def sql(k: int = K, every: int = EVERY) -> str:
    """The same by comparing every query with every row, in DuckDB."""
    return f"""
WITH c AS (SELECT vec_id, list_transform(embedding, lambda x: x > 0) AS bits FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL),
d AS (SELECT q.vec_id AS query_id, c.vec_id AS neighbour_id,
        len(list_filter(list_zip(q.bits, c.bits), lambda p: p[1] <> p[2]))::BIGINT AS distance
      FROM c q JOIN c ON q.vec_id <> c.vec_id WHERE q.vec_id % {every} = 0)
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbour_id)::INTEGER AS rank FROM d) WHERE rank <= {k}"""
