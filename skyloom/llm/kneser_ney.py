"""Quality classifier: an interpolated modified Kneser-Ney model of trusted text.

Grams are ``order`` consecutive UTF-8 bytes (blanks before the first).  A gram
and all its lower orders down to three share the two bytes before the last, so
counts, continuation counts and context totals of a hash shard of that pair
need no other shard; only the table of byte pairs (at most 65,536 entries) and
the discounts are common.  Documents send the distinct grams of each piece of
text, with the documents that hold them, to the same shards; the join there
gives each document's partial log-probabilities, which are summed.  A document
is kept if its perplexity is at most the ``quantile`` of trusted documents of
its language.

Trusted text: documents labelled quality 1 and toxic 0.  All of them count
grams and all of them set the thresholds, by exact quantiles.  No document is
scored by a model that counted it: a hash of its id deals each to one of FOLDS
folds, grams are counted by fold, and a trusted document is scored by the model
of all trusted documents of the other folds (cross-validation), every other
document by the model of all.  Every document is scored whole.

Trusted texts are found by a filter of one hash of their ids (two bytes an id,
32 MB at most, broadcast); what passes it meets the ids themselves by a
shuffle, so the other texts do not move.

Defined cases: rows that repeat a doc_id are one document, and so are all rows
without one, for a verdict is found again by its id alone; a very long text is
counted in pieces and scored whole; a null or empty text has no perplexity and is not kept; a null lang, or one without trusted
documents, has the threshold of all languages; without trusted text (for a trusted document: in other folds) every byte
is equally likely; further columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyloom.llm.common import byte_rows, checkpointed, mix64, pack, text_volume, unpack
from skyloom.operators.binning import order_statistics

ORDER, SHARDS = 4, 16
SEED = 3
QUANTILE = 0.99
#: Folds of the trusted documents; bits of a fold right of a gram, and the fold that is never left out.
FOLDS, FOLD_BITS, ALWAYS = 5, 3, 7
#: The model of all folds, where a fold to leave out is named.
NONE_OUT = -1
#: Bits of the filter for a trusted document, and at most.
ID_BITS, FILTER_BITS = 16, 1 << 28
#: Grams that a task holds before it sends their counts on.
HELD_GRAMS = 1 << 21
#: Text of a piece, and text whose postings meet one copy of a shard's model.
PIECE_BYTES, SALT_BYTES = 3 << 20, 256 << 20
#: Text for each byte of all copies of the model together, at least.
MODEL_COPIES = 8

_ROW = "shard int, salt int, blob binary"


def gram_keys(texts: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """A key and the text for each byte: pair before the last, nearer to farther history, last."""
    pad = b" " * (order - 1)
    buf = np.frombuffer(b"".join(pad + t for t in texts), np.uint8).astype(np.uint64)
    n = len(buf) - order + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    part = lambda back: buf[order - 1 - back : order - 1 - back + n]
    key = (part(2) << np.uint64(8)) | part(1)
    for back in range(3, order):
        key = (key << np.uint64(8)) | part(back)
    key = (key << np.uint64(8)) | part(0)
    text = np.repeat(np.arange(len(texts)), [len(t) + order - 1 for t in texts])[: len(buf)]
    valid = np.ones(len(buf), bool)
    size = np.array([len(t) + order - 1 for t in texts])
    start = np.cumsum(size) - size
    for k in range(order - 1):
        valid[start + k] = False
    own = np.flatnonzero(valid[order - 1 :])
    return key[own], text[order - 1 :][own]


def lower(key: np.ndarray, order: int, to: int) -> np.ndarray:
    """Keys of an order without their farthest bytes."""
    history = (key >> np.uint64(8)) >> np.uint64(8 * (order - to))
    return (history << np.uint64(8)) | (key & np.uint64(255))


def shard_of(key: np.ndarray, order: int, shards: int) -> np.ndarray:
    return (mix64(key >> np.uint64(8 * (order - 2))) % np.uint64(shards)).astype(np.int32)


def pieces(texts: list[bytes], most: int = 1 << 20):
    """(number of the first text, texts) a piece, of at most so many texts."""
    first = 0
    while first < len(texts):
        end, size = first, 0
        while end < len(texts) and (end == first or end - first < most and size + len(texts[end]) <= PIECE_BYTES):
            size += len(texts[end])
            end += 1
        yield first, texts[first:end]
        first = end


def folds_of(ids: pa.Array, seed: int) -> np.ndarray:
    """The fold of each document; what has no id is in none that is left out."""
    known = ids.cast(pa.int64())
    hashed = mix64(known.fill_null(0).to_numpy(zero_copy_only=False).astype(np.uint64) ^ np.uint64(seed))
    return np.where(known.is_null().to_numpy(zero_copy_only=False), ALWAYS, (hashed % np.uint64(FOLDS)).astype(np.int64))


def _heads(sorted_: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin."""
    return np.flatnonzero(np.concatenate([[True], sorted_[1:] != sorted_[:-1]])) if len(sorted_) else np.zeros(0, np.int64)


class Tally:
    """Counts by key; what came in is added up when it is more than what is held."""

    def __init__(self):
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.held = self.waiting = 0

    def add(self, key: np.ndarray, n: np.ndarray) -> None:
        self.parts.append((key, n))
        self.waiting += len(key)
        if self.waiting > max(1 << 18, self.held):
            self.counts()

    def counts(self) -> tuple[np.ndarray, np.ndarray]:
        """Keys in order, and the sum of each."""
        key = np.concatenate([np.zeros(0, np.uint64), *(k for k, _ in self.parts)])
        n = np.concatenate([np.zeros(0, np.int64), *(m for _, m in self.parts)])
        order = np.argsort(key, kind="stable")
        key, n = key[order], n[order]
        first = _heads(key)
        self.parts = [(key[first], np.add.reduceat(n, first) if len(first) else n)]
        self.held, self.waiting = len(first), 0
        return self.parts[0]


def without(key: np.ndarray, n: np.ndarray, fold: int) -> tuple[np.ndarray, np.ndarray]:
    """Grams and their counts in all folds but one, from the counts by (gram, fold)."""
    if fold != NONE_OUT:
        left = (key & np.uint64((1 << FOLD_BITS) - 1)) != np.uint64(fold)
        key, n = key[left], n[left]
    key = key >> np.uint64(FOLD_BITS)
    first = _heads(key)
    return key[first], np.add.reduceat(n, first) if len(first) else n


def folds_in(key: np.ndarray) -> list[int]:
    """Folds that can be left out of counts by (gram, fold)."""
    return [int(f) for f in np.unique(key & np.uint64((1 << FOLD_BITS) - 1)) if f != ALWAYS]


def discounts(times: np.ndarray) -> np.ndarray:
    """D1, D2, D3+ from the numbers of grams counted 1, 2, 3 and 4 times."""
    n1, n2, n3, n4 = (max(float(x), 1.0) for x in times)
    y = n1 / (n1 + 2 * n2)
    return np.clip([1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3], 0.05, [0.95, 1.95, 2.95])


class ShardModel:
    """Counts of a shard, from its distinct highest-order grams."""

    def __init__(self, key: np.ndarray, count: np.ndarray, order: int):
        self.order = order
        self.tables: dict[int, tuple[np.ndarray, ...]] = {}
        for m in range(order, 2, -1):
            history = key >> np.uint64(8)
            # keys are sorted, so contexts are runs
            first = np.flatnonzero(np.concatenate([[True], history[1:] != history[:-1]])) if len(key) else np.zeros(0, np.int64)
            total = np.add.reduceat(count, first) if len(first) else count
            kinds = [np.add.reduceat((np.minimum(count, 3) == j).astype(np.int64), first) if len(first) else count for j in (1, 2, 3)]
            self.tables[m] = (key, count, history[first], total, *kinds)
            if m > 3:
                key, count = np.unique(lower(key, m, m - 1), return_counts=True)

    def counts_of_counts(self) -> np.ndarray:
        """Grams of each order above two that were counted 1 to 4 times."""
        return np.array([[int((self.tables[m][1] == j).sum()) for j in (1, 2, 3, 4)] for m in range(self.order, 2, -1)])

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Last two bytes, and how many bytes they follow here."""
        key = self.tables[3][0]
        return np.unique(key & np.uint64(0xFFFF), return_counts=True)

    def log_probability(self, key: np.ndarray, taken: np.ndarray, pairs: np.ndarray) -> np.ndarray:
        """taken: discounts of the orders from the highest to 3; pairs: probabilities of byte pairs."""
        p = pairs[(lower(key, self.order, 3) & np.uint64(0xFFFF)).astype(np.int64)]
        for m in range(3, self.order + 1):
            grams, count, contexts, total, one, two, more = self.tables[m]
            own = lower(key, self.order, m)
            d = taken[self.order - m]
            if not len(grams):
                continue
            at = np.minimum(np.searchsorted(contexts, own >> np.uint64(8)), len(contexts) - 1)
            known = contexts[at] == own >> np.uint64(8)
            here = np.minimum(np.searchsorted(grams, own), len(grams) - 1)
            c = np.where(grams[here] == own, count[here], 0)
            less = np.maximum(c - np.concatenate([[0.0], d])[np.minimum(c, 3)], 0)
            free = d[0] * one[at] + d[1] * two[at] + d[2] * more[at]
            p = np.where(known, (less + free * p) / total[at], p)
        return np.log(p)


def pair_table(pairs: np.ndarray, followed: np.ndarray) -> np.ndarray:
    """Interpolated probabilities of all byte pairs from their continuation counts."""
    count = np.zeros((256, 256))
    np.add.at(count.reshape(-1), pairs.astype(np.int64), followed)
    d = discounts(np.array([(count == j).sum() for j in (1, 2, 3, 4)]))
    single = (count > 0).sum(axis=0).astype(float)
    total = single.sum()
    one = discounts(np.array([(single == j).sum() for j in (1, 2, 3, 4)]))
    kept = np.maximum(single - np.concatenate([[0.0], one])[np.minimum(single, 3).astype(int)], 0)
    given = one[0] * (single == 1).sum() + one[1] * (single == 2).sum() + one[2] * (single >= 3).sum()
    p1 = (kept + given / 256) / total if total else np.full(256, 1 / 256)
    all_ = count.sum(axis=1, keepdims=True)
    less = np.maximum(count - np.concatenate([[0.0], d])[np.minimum(count, 3).astype(int)], 0)
    free = (d[0] * (count == 1) + d[1] * (count == 2) + d[2] * (count >= 3)).sum(axis=1, keepdims=True)
    return np.where(all_ > 0, (less + free * p1) / np.maximum(all_, 1), p1).reshape(-1)


def _dealt(columns: dict[str, np.ndarray], shard: np.ndarray):
    order = np.argsort(shard, kind="stable")
    shard = shard[order]
    cut = np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1]])) if len(shard) else []
    for a, b in zip(cut, [*cut[1:], len(shard)], strict=True):
        yield int(shard[a]), {k: v[order[a:b]] for k, v in columns.items()}


def model_shards(trusted: DataFrame, order: int = ORDER, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """shard, blob (sorted grams with their counts in each fold) and stats of each shard, from the trusted texts.

    Stats: the folds met, and for the model of all folds and for those without
    one of them the counts of counts and the byte pairs (model << 16 | pair) with
    what they follow.  Without a doc_id no text is ever left out.
    """
    with_ids = "doc_id" in trusted.columns

    def sent(tally):
        key, n = tally.counts()
        rows = [(s, pack({k: pa.array(v) for k, v in c.items()})) for s, c in _dealt({"key": key, "n": n}, shard_of(key >> np.uint64(FOLD_BITS), order, shards))]
        return pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], t) for j, t in enumerate((pa.int32(), pa.binary()))], names=["shard", "blob"])

    def count(batches):
        tally = Tally()
        for batch in batches:
            folds = folds_of(batch.column("doc_id"), seed) if with_ids else np.full(batch.num_rows, ALWAYS)
            for first, texts in pieces([t or b"" for t in byte_rows(batch)]):
                key, text = gram_keys(texts, order)
                key = (key << np.uint64(FOLD_BITS)) | folds[first + text].astype(np.uint64)
                if len(key):
                    tally.add(*np.unique(key, return_counts=True))
            if tally.held > HELD_GRAMS:
                yield sent(tally)
                tally = Tally()
        if tally.parts:
            yield sent(tally)

    def merge(key, table):
        tally = Tally()
        for blob in table.column("blob"):
            part = unpack(blob.as_py())
            tally.add(part.column("key").to_numpy(), part.column("n").to_numpy())
        grams, n = tally.counts()
        met = folds_in(grams)
        stats = []
        for fold in (NONE_OUT, *range(FOLDS)):
            if fold == NONE_OUT or fold in met:
                model = ShardModel(*without(grams, n, fold), order)
                stats.append((model.counts_of_counts().reshape(-1), *model.pairs()))
            else:  # a fold that is not met takes nothing from the whole
                stats.append(stats[0])
        times, pairs, followed = zip(*stats, strict=True)
        marked = [p.astype(np.int32) | np.int32(i << 16) for i, p in enumerate(pairs)]
        return pa.Table.from_arrays(
            [
                pa.array([key[0].as_py()], pa.int32()),
                pa.array([pack({"key": pa.array(grams), "n": pa.array(n)})], pa.binary()),
                pa.array([met], pa.list_(pa.int32())),
                pa.array([np.concatenate(times).tolist()], pa.list_(pa.int64())),
                pa.array([np.concatenate(marked)], pa.list_(pa.int32())),
                pa.array([np.concatenate(followed)], pa.list_(pa.int64())),
            ],
            names=["shard", "blob", "folds", "times", "pairs", "followed"],
        )

    counted = trusted.select(*(["doc_id"] if with_ids else []), "text").mapInArrow(count, "shard int, blob binary")
    return counted.groupBy("shard").applyInArrow(merge, "shard int, blob binary, folds array<int>, times array<long>, pairs array<int>, followed array<long>")


def trusted_documents(labels: DataFrame) -> DataFrame:
    return labels.where("quality = 1 and coalesce(toxic, 0) = 0 and doc_id is not null").select("doc_id").distinct()


def trusted_texts(docs: DataFrame, trusted: DataFrame, most_bits: int = FILTER_BITS) -> DataFrame:
    """doc_id and text of the documents whose ids are in trusted (doc_id, each once)."""
    bits = max(64, min(most_bits, trusted.count() * ID_BITS))
    place = F.pmod(F.xxhash64(F.col("doc_id").cast("long")), F.lit(bits))
    words = trusted.select(place.alias("at")).groupBy(F.shiftright("at", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(at & 63 as int))")).alias("bits")).toArrow()
    plane = np.zeros(-(-bits // 64), np.uint64)
    plane[words.column("word").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
    sent = docs.sparkSession.sparkContext.broadcast(plane)

    @F.pandas_udf("boolean")
    def possible(at: pd.Series) -> pd.Series:
        at = at.to_numpy()
        return pd.Series(sent.value[at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1) > 0)

    met = docs.select("doc_id", "text").where("doc_id is not null").where(possible(place))
    return met.hint("shuffle_merge").join(trusted, "doc_id", "left_semi")  # at any size as at a large one


def language_quota(halves: list[tuple[float, int]], bound: float) -> float:
    """Documents a language may train on, from (half, languages of that half), so that all stay within the bound."""
    left, languages = bound, sum(n for _, n in halves)
    for half, n in sorted(halves):
        if half * languages > left:
            return left / languages
        left, languages = left - half * n, languages - n
    return float("inf")


def trusted_ids(labels: DataFrame, max_trusted: int, seed: int = SEED, known: DataFrame | None = None) -> DataFrame:
    """doc_id of a hash half of each language's trusted documents, about max_trusted in all at most, for callers who want a smaller model.

    known: doc_id and lang of the documents; without it all are of one language.
    """
    good = trusted_documents(labels)
    good = good.withColumn("lang", F.lit(None).cast("string")) if known is None else good.join(known, "doc_id")
    sizes = good.groupBy(F.col("lang").alias("_lang")).agg((F.count(F.lit(1)) / 2).alias("_half"))
    quota = language_quota([tuple(r) for r in sizes.groupBy("_half").count().collect()], max_trusted)
    half = good.where(F.pmod(F.xxhash64("doc_id", F.lit(seed + 1)), F.lit(2)) == 0)
    if quota == float("inf"):
        return half.select("doc_id")
    cut = F.broadcast(sizes.where(F.col("_half") > quota))  # at most max_trusted / quota languages
    die = F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1 << 40)) / float(1 << 40)
    return half.join(cut, F.col("lang").eqNullSafe(F.col("_lang")), "left").where(die < F.coalesce(quota / F.col("_half"), F.lit(1.0))).select("doc_id")


def log_likelihoods(docs: DataFrame, models: DataFrame, order: int = ORDER, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """doc_id, n_bytes, log_probability and held_out (by the model without the document's fold) by the sharded join of grams."""
    _, volume = text_volume(docs)
    size = models.agg(F.sum(F.octet_length("blob"))).first()[0] or 1
    salts = max(1, min(-(-volume // SALT_BYTES), volume // (MODEL_COPIES * size)))
    stats = models.select("folds", "times").collect()
    folds = sorted({f for r in stats for f in r["folds"]})
    times = sum((np.array(r["times"]).reshape(FOLDS + 1, order - 2, 4) for r in stats), np.zeros((FOLDS + 1, order - 2, 4), np.int64))
    taken = [np.array([discounts(t) for t in own]) for own in times]
    followed = models.select(F.explode(F.arrays_zip("pairs", "followed")).alias("x")).groupBy("x.pairs").agg(F.sum("x.followed").alias("n")).toArrow()  # 65,536 a model at most
    pair, follows = (c.to_numpy() for c in followed.columns)
    pairs = [pair_table(pair[own] & 0xFFFF, follows[own]) for own in (pair >> 16 == i for i in range(FOLDS + 1))]

    def send(batches):
        for batch in batches:
            ids = batch.column("doc_id").cast(pa.int64())
            bits = np.uint64(64 - 8 * order)  # left of the key for the text's number
            for first, texts in pieces([t or b"" for t in byte_rows(batch)], 1 << min(20, int(bits))):
                key, text = gram_keys(texts, order)
                both = np.sort((key << bits) | text.astype(np.uint64))
                if not len(both):
                    continue
                new = np.flatnonzero(np.concatenate([[True], both[1:] != both[:-1]]))
                n = np.diff(np.append(new, len(both)))
                both = both[new]
                key, text = both >> bits, (both & np.uint64((1 << int(bits)) - 1)).astype(np.int32)
                own = ids.slice(first, len(texts))
                salt = int(mix64(both[:1])[0] % np.uint64(salts))
                rows = []
                for s, c in _dealt({"key": key, "text": text, "n": n}, shard_of(key, order, shards)):
                    head = np.flatnonzero(np.concatenate([[True], c["key"][1:] != c["key"][:-1]]))
                    step = c["text"].copy()
                    step[1:] -= c["text"][:-1]
                    step[head] = c["text"][head]
                    grams = pack({"key": pa.array(np.diff(c["key"][head], prepend=np.uint64(0))), "n": pa.array(np.diff(np.append(head, len(step))).astype(np.uint32))})
                    # small steps and counts take one byte; the rare larger ones go beside them
                    big, often = np.flatnonzero(step > 254), np.flatnonzero(c["n"] > 255)
                    postings = pack({"step": pa.array(np.minimum(step, 255).astype(np.uint8)), "n": pa.array(np.minimum(c["n"], 255).astype(np.uint8))})
                    rows.append((s, salt, pack({
                        "grams": pa.array([grams], pa.binary()), "postings": pa.array([postings], pa.binary()),
                        "big": pa.array([step[big].tolist()], pa.list_(pa.int32())),
                        "often_at": pa.array([often.tolist()], pa.list_(pa.int64())), "often": pa.array([c["n"][often].tolist()], pa.list_(pa.int64())),
                        "ids": pa.array([own.to_pylist()], pa.list_(pa.int64())),
                    })))
                yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], t) for j, t in enumerate((pa.int32(), pa.int32(), pa.binary()))], names=["shard", "salt", "blob"])

    def read(blob):
        """ids, and for each posting the place of its gram, its text and how often; distinct grams."""
        row = unpack(blob).to_pylist()[0]
        grams, postings = unpack(row["grams"]), unpack(row["postings"])
        key, times = np.cumsum(grams.column("key").to_numpy(), dtype=np.uint64), grams.column("n").to_numpy().astype(np.int64)
        step, n = postings.column("step").to_numpy().astype(np.int64), postings.column("n").to_numpy().astype(np.int64)
        step[step == 255] = row["big"]
        n[row["often_at"]] = row["often"]
        head = np.cumsum(times) - times
        run = np.cumsum(step)
        text = run - np.repeat(run[head] - step[head], times)
        return pa.array(row["ids"], pa.int64()), key, np.repeat(np.arange(len(key)), times), text, n

    def join(model, sent):
        own = [unpack(b) for b in model.column("blob").to_pylist()]
        counted = (own[0].column("key").to_numpy(), own[0].column("n").to_numpy()) if own else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        blobs, found = sent.column("blob").to_pylist(), []
        for out in (NONE_OUT, *folds):  # one model at a time
            counts = ShardModel(*without(*counted, out), order)
            for i, blob in enumerate(blobs):
                if out != NONE_OUT and not (found[i][1] == out).any():
                    continue
                ids, key, gram, text, n = read(blob)
                if out != NONE_OUT:
                    at = np.flatnonzero((found[i][1] == out)[text])
                    used, gram = np.unique(gram[at], return_inverse=True)
                    key, text, n = key[used], text[at], n[at]
                sums = np.bincount(text, weights=counts.log_probability(key, taken[out + 1], pairs[out + 1])[gram] * n, minlength=len(ids))
                if out == NONE_OUT:
                    found.append((ids, folds_of(ids, seed), np.bincount(text, weights=n, minlength=len(ids)), sums, sums.copy()))
                else:
                    own_fold, held = found[i][1] == out, found[i][4]
                    held[own_fold] = sums[own_fold]
        tables = []
        for ids, _, n, log, held in found:
            used = np.flatnonzero(n)
            tables.append(pa.Table.from_arrays([ids.take(pa.array(used)), pa.array(n[used].astype(np.int64)), pa.array(log[used]), pa.array(held[used])], names=["doc_id", "n", "log", "held"]))
        return pa.concat_tables(tables) if tables else pa.table({"doc_id": pa.array([], pa.int64()), "n": pa.array([], pa.int64()), "log": pa.array([], pa.float64()), "held": pa.array([], pa.float64())})

    sent = docs.select("doc_id", "text").mapInArrow(send, _ROW)
    copies = models.select("shard", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"), "blob")
    joined = copies.groupBy("shard", "salt").cogroup(sent.groupBy("shard", "salt")).applyInArrow(join, "doc_id long, n long, log double, held double")
    return joined.groupBy("doc_id").agg(F.sum("n").alias("n_bytes"), F.sum("log").alias("log_probability"), F.sum("held").alias("held_out"))


def thresholds(trusted: DataFrame, quantile: float, by: str | None = None) -> dict:
    """The least perplexity that ``quantile`` of the documents do not exceed, for all (group 0) or by language."""
    rank = lambda n: max(0, math.ceil(quantile * n) - 1)
    found, stats = order_statistics(trusted, "perplexity", [quantile], lambda n: [rank(n)], by)
    return {g: found[g, rank(n)] for g, (n, *_) in stats.items() if n}


def classify(docs: DataFrame, labels: DataFrame, order: int = ORDER, shards: int = SHARDS, max_trusted: int | None = None, quantile: float = QUANTILE, seed: int = SEED) -> DataFrame:
    """doc_id, lang, n_bytes, perplexity, threshold and keep of every document; order: 3 to 7.

    max_trusted: instead of all folds, count a hash half of the trusted documents, at most about so many, and let the others set the thresholds.
    """
    if not 3 <= order <= 7:
        raise ValueError(f"order {order} is not 3 to 7: a gram and a text's number share 64 bits")
    known = docs.groupBy("doc_id").agg(F.max("lang").alias("lang"))
    trusted = checkpointed(trusted_documents(labels))
    if max_trusted is None:
        texts = trusted_texts(docs, trusted)
    else:
        train = F.broadcast(checkpointed(trusted_ids(labels, max_trusted, seed, known)))  # of bounded size
        texts, trusted = docs.join(train, "doc_id", "left_semi").select("text"), trusted.join(train, "doc_id", "left_anti")
    models = checkpointed(model_shards(texts, order, shards, seed))
    logs = log_likelihoods(docs, models, order, shards, seed).withColumnRenamed("doc_id", "_doc_id")
    scored = known.join(logs, F.col("doc_id").eqNullSafe(F.col("_doc_id")), "left").drop("_doc_id")
    scored = scored.join(trusted.withColumn("_trusted", F.lit(True)), "doc_id", "left")
    log = F.when(F.col("_trusted"), F.col("held_out")).otherwise(F.col("log_probability"))
    scored = checkpointed(scored.withColumn("perplexity", F.exp(-F.try_divide(log, "n_bytes"))))
    trusted = scored.where("_trusted and perplexity is not null").select("lang", "perplexity")
    overall = thresholds(trusted, quantile).get(0)
    found = [(lang, level) for lang, level in thresholds(trusted.where("lang is not null"), quantile, "lang").items()]
    by_lang = docs.sparkSession.createDataFrame(found, "lang string, threshold double")  # as many as languages
    return (
        scored.join(by_lang, "lang", "left")
        .withColumn("threshold", F.coalesce("threshold", F.lit(overall).cast("double")))
        .select("doc_id", "lang", F.coalesce("n_bytes", F.lit(0)).alias("n_bytes"), "perplexity", "threshold", F.coalesce(F.expr("perplexity <= threshold"), F.col("perplexity").isNotNull()).alias("keep"))
    )
