"""Documents in packed blocks, and messages from blocks to the buckets of keys.

A block holds about BLOCK_BYTES of whole documents, dealt by a hash of doc_id
and text; blocks, and with them buckets, grow in number with the input, not in
size.  A message is a few columns packed to one blob.  While there are few
buckets a block sends one blob to each; beyond ``fan`` buckets messages take
two hops, first to one of sqrt(buckets) groups of buckets, where the messages
of sqrt(blocks) blocks are united, so that n blocks send n * sqrt(n) blobs and
never n * n.
"""

from __future__ import annotations

import math
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from skyloom.llm.common import byte_rows, mix64

BLOCK_BYTES, LEAST_BLOCK = 8 << 20, 64 << 10
#: Most blobs that a block sends at once.
FAN = 1024
LAST = (1 << 63) - 1

#: Kinds of the columns of a document blob: ids, whether an id is null, texts.
DOCUMENT = ("i8", "?", "text")
BLOCKS = "part int, blob binary"
SENT = "part int, lane int, kind int, home int, blob binary"
GOT = "part int, kind int, blob binary"

Columns = list[np.ndarray | list[bytes]]


def packed(columns: Columns) -> bytes:
    """Columns of equal length as one compressed blob."""
    parts = []
    for c in columns:
        if isinstance(c, list):
            parts += [np.fromiter(map(len, c), np.uint32, len(c)).tobytes(), *c]
        else:
            parts.append(c.tobytes())
    raw = b"".join(parts)
    return np.array([len(columns[0]), len(raw)], np.int64).tobytes() + pa.compress(raw, codec="zstd", asbytes=True)


def unpacked(blobs: Iterable[bytes], kinds: tuple[str, ...]) -> Columns:
    """The columns of all blobs, one after the other; a kind is a numpy type or ``text``."""
    found: list[list] = [[] for _ in kinds]
    for blob in blobs:
        n, size = np.frombuffer(blob, np.int64, 2).tolist()
        raw = pa.decompress(memoryview(blob)[16:], decompressed_size=size, codec="zstd", asbytes=True) if size else b""
        at = 0
        for own, kind in zip(found, kinds, strict=True):
            if kind == "text":
                ends = (at + 4 * n + np.cumsum(np.frombuffer(raw, np.uint32, n, at), dtype=np.int64)).tolist()
                at += 4 * n
                for end in ends:
                    own.append(raw[at:end])
                    at = end
            else:
                own.append(np.frombuffer(raw, kind, n, at))
                at += own[-1].nbytes
    return [own if kind == "text" else np.concatenate([np.zeros(0, kind), *own]) for own, kind in zip(found, kinds, strict=True)]


def dealt(columns: Columns, to: np.ndarray) -> Iterable[tuple[int, bytes]]:
    """(target, blob) of each value of ``to``."""
    if not len(to):
        return
    order = np.argsort(to, kind="stable")
    to = to[order]
    cut = np.flatnonzero(np.concatenate([[True], to[1:] != to[:-1]]))
    texts = [i for i, c in enumerate(columns) if isinstance(c, list)]
    columns = [c if i in texts else c[order] for i, c in enumerate(columns)]
    for target, a, b in zip(to[cut].tolist(), cut.tolist(), [*cut[1:].tolist(), len(to)], strict=True):
        yield target, packed([[c[i] for i in order[a:b].tolist()] if k in texts else c[a:b] for k, c in enumerate(columns)])


def block_count(volume: int, least: int = 1, block_bytes: int = BLOCK_BYTES) -> int:
    """Blocks of so many bytes of text: of block_bytes, or smaller if so many tasks (``least``) would idle."""
    return max(-(-volume // block_bytes), min(least, volume // min(LEAST_BLOCK, block_bytes) + 1))


def table(rows: Iterable[tuple], schema: pa.Schema) -> pa.Table:
    rows = list(rows)
    columns = zip(*rows, strict=True) if rows else [[] for _ in schema]
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


_TYPES = {"int": pa.int32(), "binary": pa.binary()}


def _schema(ddl: str) -> pa.Schema:
    return pa.schema([(n, _TYPES[t]) for n, t in (c.split() for c in ddl.split(", "))])


def in_blocks(docs: DataFrame, parts: int) -> DataFrame:
    """(part, blob) of whole documents; several blobs make a block."""

    def deal(batches):
        for batch in batches:
            ids = batch.column("doc_id").cast(pa.int64())
            number = ids.fill_null(LAST).to_numpy(zero_copy_only=False)
            texts = [t or b"" for t in byte_rows(batch)]
            digest = np.fromiter(map(xxhash.xxh64_intdigest, texts), np.uint64, len(texts))
            to = (mix64(number.view(np.uint64) ^ digest) % np.uint64(parts)).astype(np.int32)
            yield pa.RecordBatch.from_pylist([{"part": p, "blob": b} for p, b in dealt([number, ids.is_null().to_numpy(zero_copy_only=False), texts], to)], _schema(BLOCKS))

    return docs.select("doc_id", "text").mapInArrow(deal, BLOCKS)


def documents(blobs: Iterable[bytes]) -> tuple[list[int | None], list[bytes]]:
    """A block's rows in an order that does not hang on how they arrived."""
    number, null, texts = unpacked(blobs, DOCUMENT)
    rows = sorted(zip(number.tolist(), null.tolist(), texts, strict=True))
    return [None if n else i for i, n, _ in rows], [t for _, _, t in rows]


class Exchange:
    """Messages between parts; columns of a message follow its target and its origin, of type int32."""

    def __init__(self, parts: int, kinds: tuple[str, ...], fan: int = FAN):
        self.kinds, self.step = ("i4", "i4", *kinds), 1 if parts <= fan else math.isqrt(parts - 1) + 1

    def sent(self, columns: Columns, to: np.ndarray, origin: np.ndarray | int, home: int) -> list[tuple]:
        """Rows of SENT; ``home`` is the part that sends them."""
        to = to.astype(np.int32)
        origin = np.full(len(to), origin, np.int32) if isinstance(origin, int) else origin
        lane = 0 if self.step == 1 else home // self.step
        return [(p, lane, 0, home, b) for p, b in dealt([to, origin, *columns], to // self.step)]

    def kept(self, kind: int, home: int, columns: Columns) -> list[tuple]:
        """A note of another kind, of its own columns, to the sender itself."""
        return [(home // self.step, home // self.step, kind, home, packed(columns))]

    def rows(self, rows: Iterable[tuple]) -> pa.Table:
        return table(rows, _schema(SENT))

    def delivered(self, messages: DataFrame) -> DataFrame:
        """Rows of GOT at their targets."""
        if self.step == 1:
            return messages.select("part", "kind", "blob")
        kinds = self.kinds

        def hop(rows: pa.Table) -> pa.Table:
            kind, home, blobs = (rows.column(c).to_pylist() for c in ("kind", "home", "blob"))
            columns = unpacked((b for b, k in zip(blobs, kind, strict=True) if not k), kinds)
            notes = [(h, k, b) for h, k, b in zip(home, kind, blobs, strict=True) if k]
            return table([*notes, *((p, 0, b) for p, b in dealt(columns, columns[0]))], _schema(GOT))

        return messages.groupBy("part", "lane").applyInArrow(hop, GOT)

    def opened(self, rows: pa.Table) -> Columns:
        """Origins and columns of what arrived."""
        kind = rows.column("kind").to_numpy()
        return unpacked((b.as_py() for b, k in zip(rows.column("blob"), kind, strict=True) if not k), self.kinds)[1:]


def notes_of(rows: pa.Table, kind: int, kinds: tuple[str, ...]) -> Columns:
    mine = rows.column("kind").to_numpy() == kind
    return unpacked((b.as_py() for b, k in zip(rows.column("blob"), mine, strict=True) if k), kinds)
