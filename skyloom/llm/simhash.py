"""SimHash near-duplicates with BK-trees.

A document's fingerprint has a bit where over half of the XXH64 values of its
word shingles have it.  Documents of one fingerprint collapse to it before
anything is compared.  Two fingerprints within ``radius`` bits agree on one of
radius + 1 equal slices of the 64 bits, so each fingerprint goes to the shards
of its slices, and each shard holds one BK-tree for a slice value: children
hang at their integer Hamming distance from the parent, and a query follows
only edges within the radius of its own distance.  Shard trees are not
broadcast to all rows: they grow with the corpus; routing by slice finds the
same pairs and each row meets only trees that can hold a partner.  A slice value with
more than ``split`` fingerprints is dealt again by slices of the other bits.
A shard emits one edge per fingerprint to the least document of its local
group instead of all pairs; the groups are joined by alternating stars.

Defined cases: a null or wordless text has fingerprint zero and links like
any other; fewer words than a shingle are one shingle; rows are kept, also
repeated ones; rows without doc_id get the component of their fingerprint, or
none; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from skyloom.llm.common import LOWER, apart, byte_rows, checkpointed

SHINGLE, RADIUS, SEED = 3, 3, 42
#: Fingerprints of one slice value beyond which it is dealt again.
SPLIT = 4096
#: Fingerprints of one slice value that a task takes; more are dealt to other
#: tasks by further bits.  The list of such values is broadcast up to MOST_HEAVY.
TASK, MOST_HEAVY = 1 << 20, 10_000
#: Tag of these second slices, which may differ in any bit.
SECOND = 64
#: Part of all rows beyond which a fingerprint's rows are joined in parts.
SHARE = 1024
#: Most texts that are broadcast (17 bytes each) as ones to drop or to look at again.
FEW = 1 << 19

#: For each byte a word whose eight byte lanes are its bits, least first.
_LANES = np.unpackbits(np.arange(256, dtype=np.uint8).reshape(-1, 1), axis=1, bitorder="little").reshape(-1).view("<u8").copy()


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    words = text.translate(LOWER).split() if text else []
    if not words:
        return 0
    digest, join = xxhash.xxh64_intdigest, b" ".join
    if len(words) <= shingle:
        return digest(join(words), SEED)
    parts = zip(*(words[i:] for i in range(shingle)), strict=False)
    h = np.fromiter((digest(join(p), SEED) for p in parts), np.uint64, len(words) - shingle + 1)
    lanes = np.zeros((-(-len(h) // 255) * 255, 8), np.uint64)
    lanes[: len(h)] = _LANES[h.astype("<u8").view(np.uint8).reshape(-1, 8)]
    ones = lanes.reshape(-1, 255, 8).sum(axis=1).view(np.uint8).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, also: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, the fingerprint as a signed long, and further long columns."""

    def run(batches):
        for batch in batches:
            values = np.fromiter((fingerprint(t, shingle) for t in byte_rows(batch)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(values.view(np.int64)), *map(batch.column, also)], names=["doc_id", "fp", *also])

    return docs.select("doc_id", "text", *also).mapInArrow(run, ", ".join(f"{c} long" for c in ("doc_id", "fp", *also)))


class BKForest:
    """BK-trees over groups of distinct fingerprints, built level by level.

    Nodes are positions in ``codes``; ``group`` is sorted.  The first code of
    a group is its root; the first code at a distance from a node becomes the
    node's child there and parent of the others at that distance.
    """

    def __init__(self, codes: np.ndarray, group: np.ndarray):
        self.codes = codes
        n = len(codes)
        starts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])) if n else np.zeros(0, np.int64)
        self.root = np.repeat(starts, np.diff(np.append(starts, n)))
        item = np.setdiff1d(np.arange(n), starts, assume_unique=True)
        parent = self.root[item]
        edges, nodes = [], []
        while len(item):
            key = parent * 128 + np.bitwise_count(codes[item] ^ codes[parent])
            order = np.argsort(key, kind="stable")
            key, item = key[order], item[order]
            first = np.concatenate([[True], key[1:] != key[:-1]])
            edges.append(key[first])
            nodes.append(item[first])
            parent = item[first][np.cumsum(first) - 1][~first]
            item = item[~first]
        edge = np.concatenate(edges) if edges else np.zeros(0, np.int64)
        order = np.argsort(edge)
        self.edge = edge[order]
        self.node = (np.concatenate(nodes) if nodes else np.zeros(0, np.int64))[order]

    def within(self, query: np.ndarray, radius: int):
        """Pairs (query, other) of one tree that differ in at most radius bits, a level at a time."""
        at, node = query, self.root[query]
        while len(at):
            d = np.bitwise_count(self.codes[at] ^ self.codes[node]).astype(np.int64)
            hit = (d <= radius) & (at != node)
            yield at[hit], node[hit]
            low = np.searchsorted(self.edge, node * 128 + np.maximum(d - radius, 0))
            high = np.searchsorted(self.edge, node * 128 + d + radius, side="right")
            width = high - low
            at = np.repeat(at, width)
            node = self.node[np.repeat(low - np.cumsum(width) + width, width) + np.arange(width.sum())]


def _roots(n: int, pairs) -> np.ndarray:
    """For each of n items the least item that the pairs connect it with."""
    label = np.arange(n)
    for a, b in pairs:
        while len(a):
            x, y = label[a], label[b]
            differ = x != y
            if not differ.any():
                break
            a, b = a[differ], b[differ]
            high, low = np.maximum(x, y)[differ], np.minimum(x, y)[differ]
            np.minimum.at(label, high, low)
            while True:  # labels point to labels of their own
                deeper = label[label]
                if np.array_equal(deeper, label):
                    break
                label = deeper
    return label


def _pairs_in(codes: np.ndarray, group: np.ndarray, free: Callable[[int], list[int]], radius: int, split: int, chunk: int = 20_000):
    """Pairs within the radius among codes of equal group (sorted).

    free(g): the bits in which codes of group g may differ.  A group of more
    than ``split`` codes is cut into radius + 1 slices of these bits; a pair
    agrees on one of them, so the groups of equal slices hold all pairs.
    """
    start = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    size = np.diff(np.append(start, len(group)))
    alone = (size <= split) | np.array([n > split and len(free(g)) < 4 * (radius + 1) for g, n in zip(group[start].tolist(), size.tolist(), strict=True)], bool)
    small = np.flatnonzero(np.repeat(alone & (size > 1), size))
    if len(small):
        forest = BKForest(codes[small], group[small])
        for k in range(0, len(small), chunk):
            for a, b in forest.within(np.arange(k, min(k + chunk, len(small))), radius):
                yield small[a], small[b]
    for at, n in zip(start[~alone].tolist(), size[~alone].tolist(), strict=True):
        bits = free(int(group[at]))
        for k in range(radius + 1):
            own = bits[k * len(bits) // (radius + 1) : (k + 1) * len(bits) // (radius + 1)]
            value = codes[at : at + n] & np.uint64(sum(1 << b for b in own))
            order = np.argsort(value, kind="stable")
            value = value[order]
            part = np.cumsum(np.concatenate([[0], value[1:] != value[:-1]]))
            rest = [b for b in bits if b not in set(own)]
            for a, b in _pairs_in(codes[at : at + n][order], part, lambda _, rest=rest: rest, radius, split):
                yield at + order[a], at + order[b]


def local_edges(part: np.ndarray, code: np.ndarray, node: np.ndarray, radius: int = RADIUS, split: int = SPLIT) -> tuple[np.ndarray, np.ndarray]:
    """For rows sorted by part: each node with the least node of its local group."""
    order = np.lexsort((node, part))
    part, code, node = part[order], code[order], node[order]
    width = 64 // (radius + 1)

    def free(group: int) -> list[int]:
        shared = range((group >> 32) * width, (group >> 32) * width + width) if group >> 32 < SECOND else ()
        return [b for b in range(64) if b not in shared]

    label = _roots(len(code), _pairs_in(code, part, free, radius, split))
    moved = label != np.arange(len(code))
    return node[moved], node[label[moved]]


def links(nodes: DataFrame, radius: int = RADIUS, split: int = SPLIT, task: int = TASK) -> DataFrame:
    """Edges (u, v), v < u, that connect all fingerprints within the radius."""
    width = 64 // (radius + 1)

    def sliced(first: int, size: int, count: int, tag: int):
        cut = lambda k: F.shiftrightunsigned("fp", first + k * size).bitwiseAND((1 << size) - 1)
        return [F.lit((tag + k) << 32) + cut(k) for k in range(count)]

    dealt = nodes.select("fp", "node", F.explode(F.array(*sliced(0, width, radius + 1, 0))).alias("part"))
    # slice values that too many fingerprints share are dealt again, with a slice of the other bits
    sizes = dealt.groupBy("part").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > task)
    heavy = [r[0] for r in sizes.select("part").limit(MOST_HEAVY + 1).collect()]
    if heavy:
        listed = sizes.select(F.col("part").alias("heavy"))
        listed = F.broadcast(listed) if len(heavy) <= MOST_HEAVY else listed
        narrow = width // (radius + 1)
        finer = F.array(*[F.struct(F.lit(k).alias("k"), v.alias("v")) for k, v in enumerate(sliced(0, narrow, 64 // narrow, 0))])
        finer = F.filter(finer, lambda x: F.floor(x["k"] * narrow / width) != F.shiftright("part", 32))
        # radius + 1 unions of the other slices: a pair agrees on one of them
        lanes = F.transform(F.sequence(F.lit(0), F.lit(radius)), lambda j: F.xxhash64("part", j, F.transform(F.filter(finer, lambda x: x["k"] % (radius + 1) == j), lambda x: x["v"])))
        joined = dealt.join(listed, dealt["part"] == listed["heavy"], "left")
        again = F.when(F.col("heavy").isNull(), F.array("part")).otherwise(F.transform(lanes, lambda h: F.lit(SECOND << 32) + F.pmod(h, F.lit(1 << 32))))
        dealt = joined.select("fp", "node", F.explode(again).alias("part"))
    dealt = dealt.repartition("part").sortWithinPartitions("part")

    def run(batches):
        held: list[tuple[np.ndarray, ...]] = []
        rows = 0

        def solve(columns, final):
            part, code, node = (np.concatenate(c) for c in zip(*columns, strict=True))
            cut = len(part) if final else int(np.searchsorted(part, part[-1]))
            u, v = local_edges(part[:cut], code[:cut], node[:cut], radius, split)
            rest = (part[cut:], code[cut:], node[cut:])
            return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"]), rest

        for batch in batches:
            if not batch.num_rows:
                continue
            part, fp, node = (batch.column(c).to_numpy() for c in ("part", "fp", "node"))
            held.append((part, fp.view(np.uint64), node))
            rows += len(part)
            if rows >= 200_000 and held[0][0][0] != part[-1]:
                found, rest = solve(held, False)
                held, rows = [rest], len(rest[0])
                yield found
        if held:
            yield solve(held, True)[0]

    return dealt.mapInArrow(run, "u long, v long")


def components(edges: DataFrame) -> DataFrame:
    """node, component for every node of the edges (u > v): alternating stars.

    Each round hangs every node's neighbours on its least neighbour, first the
    larger ones, then the smaller; rounds end when the edges no longer change.
    """
    edges = checkpointed(edges.distinct())
    mark = lambda e: tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
    seen = mark(edges)
    while seen[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        edges = checkpointed(small.where("u != v").distinct())
        now = mark(edges)
        if now == seen:
            break
        seen = now
    roots = edges.groupBy("u").agg(F.min("v").alias("component"))
    tops = roots.select(F.col("component").alias("node")).distinct().withColumn("component", F.col("node"))
    return roots.withColumnRenamed("u", "node").unionByName(tops)


def _labelled(rows: DataFrame, prints: DataFrame, radius: int, split: int, task: int, share: int = SHARE) -> DataFrame:
    """rows (doc_id, fp, _deal, ...) with the component of their fingerprint; NULL where no document that has it has an id.

    A fingerprint that more than a ``share``-th of all rows have, of which there
    are at most so many, is joined in parts; ``_deal`` tells each row's part.
    """
    nodes = prints.groupBy("fp").agg(F.min("doc_id").alias("node"), F.count(F.lit(1)).alias("n"))
    found = components(links(nodes.where("node is not null").select("fp", "node"), radius, split, task))
    most = max(1, prints.count() // share)
    parts = F.when(F.col("n") > most, F.ceil(F.col("n") / most)).otherwise(1).cast("int")
    resolved = nodes.join(found, "node", "left").select("fp", F.coalesce("component", "node").alias("component"), F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"))
    heavy = nodes.where(F.col("n") > most).select("fp", parts.alias("parts"))
    salted = rows.join(F.broadcast(heavy), "fp", "left").withColumn("part", F.coalesce(F.pmod(F.col("_deal"), F.col("parts")), F.lit(0)).cast("int"))
    return salted.drop("parts", "_deal").join(resolved, ["fp", "part"]).drop("part")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, split: int = SPLIT, task: int = TASK) -> DataFrame:
    """doc_id, fp and component: the least doc_id reachable over links."""
    # rows without an id are dealt by their place in the checkpoint
    prints = checkpointed(fingerprints(docs, shingle))
    dealt = prints.withColumn("_deal", F.xxhash64(F.coalesce("doc_id", F.monotonically_increasing_id())))
    return _labelled(dealt, prints, radius, split, task).select("doc_id", "fp", "component")


def verdicts(found: DataFrame) -> DataFrame:
    """The contract's columns from near_duplicates()."""
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), F.col("component").alias("component_id"))


def keep_first(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, few: int = FEW) -> DataFrame:
    """docs of which one document of each component stays, the least doc_id, as one row.

    Of rows that repeat this doc_id the one of the least text hash stays, and of
    equal texts the least by its columns as JSON.  Of rows without doc_id one a
    fingerprint stays, by the same order, if no row with an id has it.
    """
    rows, names = apart(docs)
    doc, text = names["doc_id"], names["text"]
    rows = rows.withColumn("_hash", F.xxhash64(text))
    prints = checkpointed(fingerprints(rows.select(F.col(doc).cast("long").alias("doc_id"), F.col(text).alias("text"), "_hash"), shingle, ("_hash",)))
    texts = prints.groupBy("doc_id", "_hash", "fp").agg(F.count(F.lit(1)).alias("_times"))
    texts = texts.withColumn("_deal", F.xxhash64("doc_id", "_hash"))
    texts = checkpointed(_labelled(texts, prints, radius, SPLIT, TASK).withColumn("_lead", F.col("doc_id").eqNullSafe(F.col("component"))))
    # the first text of each document that stays; one without an id is known by its fingerprint
    document = F.struct("doc_id", F.when(F.col("doc_id").isNull(), F.col("fp")).alias("fp"))
    first = texts.where("_lead").groupBy(document.alias("_document")).agg(F.min("_hash").alias("_first"))
    told = texts.withColumn("_document", document).join(first, "_document", "left")
    stays = F.col("_lead") & (F.col("_hash") == F.col("_first"))
    flags = told.where(~F.coalesce(stays, F.lit(False)) | (F.col("_times") > 1)).select(F.col("doc_id").alias("_id"), F.col("_hash").alias("_text"), F.coalesce(stays, F.lit(False)).alias("_stays"))
    flags = checkpointed(flags)
    size = flags.agg(F.count(F.lit(1)).alias("n"), F.count_if("_stays").alias("repeated")).first()
    # few flagged texts are sent to the rows, which then don't move
    flags = F.broadcast(flags) if size["n"] <= few else flags
    found = rows.join(flags, F.col(doc).cast("long").eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("_text")), "left")
    kept = found.where("_stays is null")
    if size["repeated"]:
        one = F.row_number().over(Window.partitionBy("_id", "_text").orderBy(F.to_json(F.struct(*names.values()))))
        kept = kept.select(*names.values()).unionByName(found.where("_stays").withColumn("_n", one).where("_n = 1").select(*names.values()))
    return kept.select(*[F.col(v).alias(k) for k, v in names.items()])
