"""Resampling towards a target distribution by bucket-partitioned inverted postings.

A text's features (runs of 1 to ``runs`` words) fall into ``buckets`` by their
CRC-32.  One pass over the texts counts them in batches and inverts each batch
into posting lists (bucket, document, count), packed by range of buckets.
Bucket totals of both corpora are reduced from these.  The postings are then
shuffled by (range, part), where parts are groups of batches, so that a bucket
that nearly every document has is dealt to many tasks; there they are
co-grouped with both corpora's totals of the range's buckets, each bucket's gain
is computed on the spot, and gain times count is emitted, already summed by
document over the range.  A last shuffle by batch reduces that by document.

The mean gain plus Gumbel noise hashed from doc_id is the score, an integer.
Scores have a bounded range, so a table of their counts gives the least drawn
score; the drawn rows alone are sorted, by ranges of (score, doc_id, place),
which no tie can make uneven, and ranked by the sizes of the ranges before.

Defined cases: a null, empty or wordless text has no features, weight 0, and is
never drawn unless ``least_words`` is 0; a null doc_id hashes as ``null`` and is
the last of its ties; rows that repeat a doc_id, or are equal in all, are rows
of their own, ranked in any order among ties; a very long text is counted in
pieces of 4 MB cut between words; an empty target leaves t = T = 0; an empty
table gives no rows; drawn() carries further columns along.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyloom.llm.common import LOWER, apart, checkpointed, pack, unpack

BUCKETS, RUNS, SEED, PERCENT, LEAST_WORDS = 10_000, 1, 2024, 10, 20
#: Ranges of buckets; rows and bytes of text of a batch; batches of a part.
RANGES, BATCH_ROWS, BATCH_BYTES, PART_BATCHES = 16, 1 << 16, 4 << 20, 48
PIECE = 4 << 20
#: Feature hashes that a task remembers.
REMEMBERED = 1 << 18
_DOCS = -1

_WORD, _GAP = re.compile(rb"[0-9a-z\x80-\xff]+"), re.compile(rb"[^0-9A-Za-z\x80-\xff]")


def _pieces(text: bytes) -> Iterator[bytes]:
    """The text in lower case, in pieces cut between words."""
    at = 0
    while at < len(text):
        cut = _GAP.search(text, at + PIECE)
        end = cut.start() if cut else len(text)
        yield text[at:end].translate(LOWER)
        at = end


def features(text: bytes | None, runs: int = RUNS) -> tuple[Counter, int]:
    """Runs of 1 to ``runs`` words with their counts, and the number of words."""
    found, words, before = Counter(), 0, []
    for piece in _pieces(text or b""):
        own = _WORD.findall(piece)
        found.update(own)
        words += len(own)
        joined = before + own
        for k in range(2, runs + 1):
            first = max(0, len(before) - k + 1)  # runs that end in this piece
            found.update(b" ".join(joined[i : i + k]) for i in range(first, len(joined) - k + 1))
        before = joined[max(0, len(joined) - runs + 1) :] if runs > 1 else []
    return found, words


def _inverted(buckets: int, runs: int, with_id: bool):
    """Batches of texts as posting lists (batch, range, list), and a list of the batch's documents under range -1."""

    def invert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number: dict[bytes, int] = {}
        task, made = TaskContext.get().partitionId(), 0

        def lists(ids: list, sizes: list, words: list, keys: list[np.ndarray], counts: list[np.ndarray]) -> pa.RecordBatch:
            every = [(_DOCS, pack({"doc_id": pa.array(ids, pa.int64()), "features": pa.array(sizes, pa.int64()), "words": pa.array(words, pa.int64())}))]
            key, n = (np.concatenate(keys), np.concatenate(counts)) if keys else (np.zeros(0, np.int64),) * 2
            order = np.argsort(key)
            bucket, doc, n = key[order] // len(ids), key[order] % len(ids), n[order]
            of = bucket * RANGES // buckets
            for part in np.split(np.arange(len(of)), np.flatnonzero(np.diff(of)) + 1):
                if len(part):
                    every.append((int(of[part[0]]), pack({"bucket": pa.array(bucket[part].astype(np.uint32)), "doc": pa.array(doc[part].astype(np.uint32)), "count": pa.array(n[part])})))
            batch = (task << 32) + made
            return pa.RecordBatch.from_arrays([pa.array([batch] * len(every), pa.int64()), pa.array([g for g, _ in every], pa.int32()), pa.array([b for _, b in every], pa.binary())], names=["batch", "range", "list"])

        for batch in batches:
            texts = batch.column("text").cast(pa.large_binary())
            names = batch.column("doc_id") if with_id else pa.nulls(len(texts), pa.int64())
            at = 0
            while at < len(texts):
                ids, sizes, words, volume, pairs = [], [], [], 0, []
                while at < len(texts) and len(ids) < BATCH_ROWS and volume < BATCH_BYTES:
                    text = texts[at].as_py()
                    found, n = features(text, runs)
                    for f in found:
                        if f not in number:
                            if len(number) >= REMEMBERED:
                                number.clear()
                            number[f] = zlib.crc32(f) % buckets
                    # a feature may have been forgotten meanwhile, by those of the same text
                    pairs.append((np.fromiter((number[f] if f in number else zlib.crc32(f) % buckets for f in found), np.int64, len(found)), np.fromiter(found.values(), np.int64, len(found))))
                    ids.append(names[at].as_py())
                    sizes.append(sum(found.values()))
                    words.append(n)
                    volume += len(text or b"")
                    at += 1
                keys, counts = [], []
                for i, (own, n) in enumerate(pairs):
                    bucket, where = np.unique(own, return_inverse=True)
                    keys.append(bucket * len(ids) + i)
                    counts.append(np.bincount(where, n, len(bucket)).astype(np.int64))
                yield lists(ids, sizes, words, keys, counts)
                made += 1

    return invert


def postings(docs: DataFrame, buckets: int = BUCKETS, runs: int = RUNS) -> DataFrame:
    """batch, range and list: posting lists of ``text``, by range of buckets; range -1 lists the documents of a batch."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text") if "doc_id" in docs.columns else docs.select("text")
    return own.mapInArrow(_inverted(buckets, runs, "doc_id" in docs.columns), "batch long, range int, list binary")


def bucket_totals(lists: DataFrame, buckets: int, name: str) -> DataFrame:
    """Occurrences of each bucket: partial sums of tasks, then totals."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for blob in batch.column(0):
                own = unpack(blob.as_py())
                np.add.at(total, own.column("bucket").to_numpy(), own.column("count").to_numpy())
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])], names=["bucket", "n"])

    return lists.where(f"range <> {_DOCS}").select("list").mapInArrow(partial, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias(name))


def gain(s: np.ndarray, t: np.ndarray, all_s: int, all_t: int, buckets: int) -> np.ndarray:
    """floor(1000 ln(((t + 1)(S + buckets)) / ((s + 1)(T + buckets)))), in doubles."""
    return np.floor(1000.0 * np.log((t + 1.0) * (all_s + float(buckets)) / ((s + 1.0) * (all_t + float(buckets))))).astype(np.int64)


def _contributions(all_s: int, all_t: int, buckets: int):
    def emit(lists: pa.Table, totals: pa.Table) -> pa.Table:
        """Posting lists of a range of buckets, a part of all, and the range's totals in both corpora."""
        table = np.zeros(buckets, np.int64)
        for row in totals.column("totals").to_pylist():
            bucket, s, t = (np.array([x[k] for x in row], np.int64) for k in ("bucket", "s", "t"))
            table[bucket] = gain(s, t, all_s, all_t, buckets)
        batches, blobs = [], []
        for batch, blob in zip(lists.column("batch").to_pylist(), lists.column("list"), strict=True):
            own = unpack(blob.as_py())
            doc, count = own.column("doc").to_numpy().astype(np.int64), own.column("count").to_numpy()
            order = np.argsort(doc, kind="stable")
            doc, value = doc[order], (table[own.column("bucket").to_numpy()] * count)[order]
            first = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
            batches.append(batch)
            blobs.append(pack({"doc": pa.array(doc[first].astype(np.uint32)), "sum": pa.array(np.add.reduceat(value, first))}))
        return pa.table({"batch": pa.array(batches, pa.int64()), "range": pa.array([0] * len(batches), pa.int32()), "list": pa.array(blobs, pa.binary())})

    return emit


def _reduced(key: tuple, lists: pa.Table) -> pa.Table:
    """A batch's documents with the floored means of their contributions."""
    docs, sums = None, None
    rows = sorted(zip(lists.column("range").to_pylist(), lists.column("list"), strict=True), key=lambda r: r[0])
    for kind, blob in rows:  # the list of documents comes first
        own = unpack(blob.as_py())
        if kind == _DOCS:
            docs, sums = own, np.zeros(own.num_rows, np.int64)
        else:
            sums[own.column("doc").to_numpy()] += own.column("sum").to_numpy()
    n = docs.column("features").to_numpy()
    weight = np.where(n > 0, sums // np.maximum(n, 1), 0)
    place = pa.array(np.arange(len(n), dtype=np.int64))
    return pa.table({"batch": pa.array([key[0].as_py()] * len(n), pa.int64()), "place": place, "doc_id": docs.column("doc_id"), "n_features": docs.column("features"), "n_words": docs.column("words"), "weight": pa.array(weight)})


def weighted(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, runs: int = RUNS) -> DataFrame:
    """batch, place, doc_id, n_features, n_words and weight, the floored mean gain, of every row."""
    lists = checkpointed(postings(docs, buckets, runs))  # texts are read once
    mine, theirs = bucket_totals(lists, buckets, "s"), bucket_totals(postings(target.select("text"), buckets, runs), buckets, "t")
    both = checkpointed(mine.join(theirs, "bucket", "full").select("bucket", F.coalesce("s", F.lit(0)).alias("s"), F.coalesce("t", F.lit(0)).alias("t")))
    total = both.agg(F.sum("s"), F.sum("t")).first()
    batches = lists.where(f"range = {_DOCS}").count()
    parts = max(1, -(-batches // PART_BATCHES))
    ranged = both.groupBy((F.col("bucket") * RANGES / buckets).cast("int").alias("range")).agg(F.collect_list(F.struct("bucket", "s", "t")).alias("totals"))
    ranged = ranged.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    parted = lists.where(f"range <> {_DOCS}").withColumn("part", F.pmod(F.xxhash64("batch"), F.lit(parts)).cast("int"))
    keys = ("range", "part")
    summed = parted.groupBy(*keys).cogroup(ranged.groupBy(*keys)).applyInArrow(_contributions(total[0] or 0, total[1] or 0, buckets), "batch long, range int, list binary")
    told = summed.unionByName(lists.where(f"range = {_DOCS}"))
    return told.groupBy("batch").applyInArrow(_reduced, "batch long, place long, doc_id long, n_features long, n_words long, weight long")


def _numbered(ranges: dict[int, int], drawn: int):
    """Ranks of the rows of sorted ranges; rows beyond the last rank have none."""

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            own = batch.column("_range").to_numpy()
            rank = np.empty(len(own), np.int64)
            for r in np.unique(own).tolist():
                at = np.flatnonzero(own == r)
                rank[at] = ranges[r] + seen[r] + np.arange(1, len(at) + 1)
                seen[r] += len(at)
            columns = [batch.column(c) for c in ("doc_id", "n_features", "weight", "score")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(rank, mask=rank > drawn)], names=["doc_id", "n_features", "weight", "score", "rank"])

    return number


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, buckets: int = BUCKETS, runs: int = RUNS, seed: int = SEED) -> DataFrame:
    """doc_id, n_features, weight, score and rank (null: not drawn) of every row of docs."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))).cast("binary"), 256)
    uniform = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") + F.lit(0.5)) / F.lit(4294967296.0)
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log(uniform))).cast("long")
    scored = checkpointed(weighted(docs, target, buckets, runs).withColumn("score", F.col("weight") + noise))
    able = F.col("n_words") >= least_words
    counts = sorted((tuple(r) for r in scored.where(able).groupBy("score").count().collect()), reverse=True)  # as many as scores have values
    drawn = percent * sum(n for _, n in counts) // 100
    least, above = None, 0
    for score, n in counts:
        if above >= drawn:
            break
        least, above = score, above + n
    plain = ("doc_id", "n_features", "weight", "score")
    if least is None:
        return scored.select(*plain, F.lit(None).cast("long").alias("rank"))
    top = able & (F.col("score") >= least)
    order = (F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("batch"), F.col("place"))
    ordered = checkpointed(scored.where(top).repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_range", F.spark_partition_id()))
    sizes = dict(tuple(r) for r in ordered.groupBy("_range").count().collect())
    starts, below = {}, 0
    for r in sorted(sizes):
        starts[r], below = below, below + sizes[r]
    ranked = ordered.mapInArrow(_numbered(starts, drawn), "doc_id long, n_features long, weight long, score long, rank long")
    return ranked.unionByName(scored.where(~top).select(*plain, F.lit(None).cast("long").alias("rank")))


def drawn(docs: DataFrame, target: DataFrame, **how: int) -> DataFrame:
    """The rows of docs whose doc_id is drawn (all that repeat it), with all their columns."""
    rows, names = apart(docs)
    plain = rows.select(F.col(names["doc_id"]).alias("doc_id"), F.col(names["text"]).alias("text"))
    ids = resample(plain, target, **how).where("rank is not null").select(F.col("doc_id").alias("_id")).distinct()
    kept = rows.join(ids, F.col(names["doc_id"]).cast("long").eqNullSafe(F.col("_id")), "left_semi")
    return kept.select(*[F.col(v).alias(k) for k, v in names.items()])


def sql(buckets: int = BUCKETS, seed: int = SEED, percent: int = PERCENT, least_words: int = LEAST_WORDS) -> str:
    """resample() with single words in DuckDB SQL; the checksum goes bit by bit over distinct words."""
    words = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    return f"""
WITH d AS (SELECT doc_id, {words} AS w FROM documents),
f AS (SELECT doc_id, x, count(*) AS c FROM (SELECT doc_id, unnest(w) AS x FROM d) GROUP BY doc_id, x),
q AS (SELECT x, count(*) AS c FROM (SELECT unnest({words}) AS x FROM benchmark) GROUP BY x),
v AS (SELECT x, hex(encode(x)) AS h FROM (SELECT x FROM f UNION SELECT x FROM q)),
b AS (SELECT x, xor(list_reduce([4294967295::BIGINT] || list_transform(range(1, length(h) // 2 + 1), lambda i: ('0x' || substr(h, 2 * i - 1, 2))::BIGINT),
        lambda c, x: list_reduce([xor(c, x), 0, 0, 0, 0, 0, 0, 0, 0], lambda y, z: xor(y >> 1, 3988292384::BIGINT * (y & 1)))), 4294967295) % {buckets} AS b FROM v),
s AS (SELECT b, sum(c)::DOUBLE AS s FROM f JOIN b USING (x) GROUP BY b),
t AS (SELECT b, sum(c)::DOUBLE AS t FROM q JOIN b USING (x) GROUP BY b),
n AS (SELECT (SELECT coalesce(sum(s), 0) FROM s) AS ss, (SELECT coalesce(sum(t), 0) FROM t) AS tt),
g AS (SELECT b, floor(1000 * ln((coalesce(t, 0) + 1) * (ss + {buckets}) / ((s + 1) * (tt + {buckets}))))::BIGINT AS gain FROM s LEFT JOIN t USING (b), n),
m AS (SELECT doc_id, sum(c)::BIGINT AS n_features, floor(sum(c * gain) / sum(c))::BIGINT AS weight FROM f JOIN b USING (x) JOIN g USING (b) GROUP BY doc_id),
r AS (SELECT d.doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight, len(w) AS words,
        coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('{seed}:' || d.doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
      FROM d LEFT JOIN m ON d.doc_id = m.doc_id),
k AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n FROM r WHERE words >= {least_words})
SELECT r.doc_id, n_features, weight, score, CASE WHEN rank <= {percent} * n // 100 THEN rank END AS rank FROM r LEFT JOIN k ON r.doc_id = k.doc_id"""
