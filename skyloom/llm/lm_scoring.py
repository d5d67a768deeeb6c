"""Masked pseudo-likelihood by a bidirectional window network in numpy.

Words are lower-cased; the most frequent of the whole corpus have a number
each, the others share hashed ones (buckets).  The network predicts the word at each
position from the ``side`` words on its left and on its right: position-wise
embeddings are summed, squashed and read out by a class softmax and a softmax
within the class.  It is trained on a hashed share of masked positions of
every document: each lane of some blocks runs its own gradient steps from the
shared parameters, which are then averaged by trained positions, block by
block of parameters and 64 lanes at a time, for ``rounds`` rounds.  A word of a
bucket has the bucket's conditional probability times its own within the
bucket: its count in the whole corpus, over those of all words of the bucket
and an unknown word, which counts as often as there are words seen once (once
at least).  A document's score is the sum of the conditional log-probabilities
of all its words.

Documents are dealt by a hash into packed blocks, whose number hangs on the
volume of text alone, so results do not hang on partitions.  Each block asks
the shards of its words for their counts in the corpus; these grow with it and
stay distributed.  What is broadcast are the parameters and the totals of
buckets, of a size that is fixed by VOCABULARY, HIDDEN and ``side``.  As
context, words of one bucket count alike.

Defined cases: a null, empty or blank text has no words, sum 0 and no mean; a
null doc_id is scored like any other; repeated rows get equal results; a
missing neighbour counts as nothing; a long text is one text, worked on in
parts; further columns are ignored; an empty corpus trains nothing and gives
no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyloom.llm.blocks import FAN, LAST, SENT, Exchange, block_count, documents, in_blocks, packed, unpacked
from skyloom.llm.common import LOWER, checkpointed, mix64, text_volume
from skyloom.llm.suffix_trees import word_hashes

#: Numbers of words: half for frequent words, half shared by the others.
VOCABULARY, WITHIN, HIDDEN, SIDE = 2048, 64, 32, 3
ROUNDS, MASKED, SEED = 2, 0.10, 5
RATE, BATCH = 0.08, 4096
PIECE_BYTES, CHUNK = 512 << 10, 1 << 15
#: Text of a block, of a lane that trains on its own, and blocks that a small input is dealt into, of LEAST_BLOCK bytes at least.
BLOCK_BYTES, LANE_BYTES, LEAST_BLOCKS = 4 << 20, 8 << 20, 32
#: Lanes whose parameters a task averages.
AVERAGED = 64

Parameters = dict[str, np.ndarray]


def fresh(side: int = SIDE, seed: int = SEED) -> Parameters:
    dice = np.random.default_rng(seed)
    classes = VOCABULARY // WITHIN
    draw = lambda *shape: (dice.standard_normal(shape) * 0.1).astype(np.float32)
    near = draw(2 * side, VOCABULARY + 1, HIDDEN)
    near[:, VOCABULARY] = 0
    zero = lambda *shape: np.zeros(shape, np.float32)
    return {"near": near, "bias": zero(HIDDEN), "kind": draw(HIDDEN, classes), "kind_bias": zero(classes), "word": draw(classes, HIDDEN, WITHIN), "word_bias": zero(classes, WITHIN)}


def pieces(texts: list[bytes | None], frequent: np.ndarray):
    """(number of first text, words of each text, word numbers, text and hash of each word) a piece."""
    first = 0
    while first < len(texts):
        end, size, part = first, 0, []
        while end < len(texts) and (not part or size + len(texts[end] or b"") <= PIECE_BYTES):
            part.append((texts[end] or b"").translate(LOWER))
            size += len(part[-1])
            end += 1
        start, code = word_hashes(np.frombuffer(b" ".join(part), np.uint8))
        length = np.array([len(t) + 1 for t in part], np.int64)
        text = np.searchsorted(np.cumsum(length), start, side="right")
        half = VOCABULARY // 2
        at = np.minimum(np.searchsorted(frequent[:, 0], code), max(0, len(frequent) - 1))
        shared = (half + code % np.uint64(half)).astype(np.int64)
        word = np.where(frequent[at, 0] == code, frequent[at, 1].astype(np.int64), shared) if len(frequent) else shared
        yield first, np.bincount(text, minlength=len(part)), word, text, code
        first = end


def neighbours(word: np.ndarray, text: np.ndarray, at: np.ndarray, side: int) -> np.ndarray:
    """Words around the positions ``at``, left to right; VOCABULARY beyond a text."""
    out = np.full((2 * side, len(at)), VOCABULARY)
    for j, step in enumerate([*range(-side, 0), *range(1, side + 1)]):
        other = at + step
        inside = (other >= 0) & (other < len(word))
        other = np.where(inside, other, 0)
        out[j] = np.where(inside & (text[other] == text[at]), word[other], VOCABULARY)
    return out


def _softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=1, keepdims=True))
    return x / x.sum(axis=1, keepdims=True)


def _log_softmax_at(x: np.ndarray, target: np.ndarray, small: bool) -> np.ndarray:
    """Logarithms of one value of each row's softmax; x is overwritten.  small: no value can overflow."""
    if not small:
        x -= x.max(axis=1, keepdims=True)
    own = x[np.arange(len(x)), target]
    return own - np.log(np.exp(x, out=x) @ np.ones(x.shape[1], x.dtype))


def _small(weights: np.ndarray, bias: np.ndarray) -> bool:
    """Whether exp() of no output can leave single precision: hidden values lie within -1 and 1."""
    return float((np.abs(weights).sum(axis=-2) + np.abs(bias)).max()) < 80


def _hidden(p: Parameters, near: np.ndarray) -> np.ndarray:
    total = p["near"][0].take(near[0], axis=0)
    one = np.empty_like(total)
    for j in range(1, len(near)):
        total += p["near"][j].take(near[j], axis=0, out=one, mode="clip")
    total += p["bias"]
    return np.tanh(total, out=total)


def log_probabilities(p: Parameters, near: np.ndarray, word: np.ndarray) -> np.ndarray:
    h = _hidden(p, near)
    kind = word // WITHIN
    out = _log_softmax_at(h @ p["kind"] + p["kind_bias"], kind, _small(p["kind"], p["kind_bias"]))
    small = _small(p["word"], p["word_bias"])
    order = np.argsort(kind, kind="stable")
    cut = np.searchsorted(kind[order], np.arange(len(p["word"]) + 1))
    for c in range(len(p["word"])):
        own = order[cut[c] : cut[c + 1]]
        if len(own):
            out[own] += _log_softmax_at(h[own] @ p["word"][c] + p["word_bias"][c], word[own] % WITHIN, small)
    return out


def gradient_step(p: Parameters, sums: Parameters, near: np.ndarray, word: np.ndarray, rate: float = RATE) -> None:
    """One Adagrad step on a batch, in place."""
    n = len(word)
    h = _hidden(p, near)
    kind = word // WITHIN
    d = _softmax(h @ p["kind"] + p["kind_bias"])
    d[np.arange(n), kind] -= 1
    back = d @ p["kind"].T
    grads = {"kind": h.T @ d / n, "kind_bias": d.sum(axis=0) / n}
    word_grad, bias_grad = np.zeros_like(p["word"]), np.zeros_like(p["word_bias"])
    order = np.argsort(kind, kind="stable")
    cut = np.searchsorted(kind[order], np.arange(len(p["word"]) + 1))
    for c in range(len(p["word"])):
        own = order[cut[c] : cut[c + 1]]
        if len(own):
            q = _softmax(h[own] @ p["word"][c] + p["word_bias"][c])
            q[np.arange(len(own)), word[own] % WITHIN] -= 1
            back[own] += q @ p["word"][c].T
            word_grad[c], bias_grad[c] = h[own].T @ q / n, q.sum(axis=0) / n
    grads |= {"word": word_grad, "word_bias": bias_grad}
    back *= (1 - h * h) / n
    grads["bias"] = back.sum(axis=0)
    near_grad = np.zeros_like(p["near"])
    for j in range(len(near)):
        order = np.argsort(near[j], kind="stable")
        key = near[j][order]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        near_grad[j][key[first]] = np.add.reduceat(back[order], first, axis=0)
    near_grad[:, VOCABULARY] = 0
    grads["near"] = near_grad
    for name, g in grads.items():
        sums[name] += g * g
        p[name] -= rate * g / np.sqrt(sums[name])


def lanes(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, int]:
    """lane, part and blob of every block, and the number of blocks; a lane's blocks lie side by side, in order."""
    _, volume = text_volume(docs)
    parts = block_count(volume, LEAST_BLOCKS, block_bytes)
    together = max(1, parts * LANE_BYTES // max(1, volume))

    def unite(key, rows):
        found: dict[int, list[bytes]] = {}
        for part, blob in zip(*(rows.column(c).to_pylist() for c in ("part", "blob")), strict=True):
            found.setdefault(part, []).append(blob)
        blobs = []
        for part in sorted(found):
            ids, texts = documents(found.pop(part))
            none = np.array([i is None for i in ids], bool)
            blobs.append((part, packed([np.array([LAST if i is None else i for i in ids], np.int64), none, texts])))
        return pa.table({"lane": pa.array([key[0].as_py()] * len(blobs), pa.int32()), "part": pa.array([p for p, _ in blobs], pa.int32()), "blob": pa.array([b for _, b in blobs], pa.binary())})

    lane = F.floor(F.col("part") / together).cast("int").alias("lane")
    return checkpointed(in_blocks(docs, parts).groupBy(lane).applyInArrow(unite, "lane int, part int, blob binary")), parts


def _rows(batches):
    """Blocks one by one: lane, part, documents."""
    for batch in batches:
        for lane, part, blob in zip(*(batch.column(c) for c in ("lane", "part", "blob")), strict=True):
            yield lane.as_py(), part.as_py(), documents([blob.as_py()])


def distinct_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of a block, and how often each occurs there."""
    found = [np.unique(code, return_counts=True) for _, _, _, _, code in pieces(texts, np.zeros((0, 2), np.uint64))]
    code, back = np.unique(np.concatenate([np.zeros(0, np.uint64), *(c for c, _ in found)]), return_inverse=True)
    return code, np.bincount(back, weights=np.concatenate([np.zeros(0), *(n for _, n in found)]), minlength=len(code)).astype(np.int64)


#: Hash and count of a word; shard and count in the corpus of a word that was asked for.
WORDS, TOTALS = ("u8", "i8"), ("i4", "i8")


def shard_of(code: np.ndarray, parts: int) -> np.ndarray:
    return (mix64(code) % np.uint64(parts)).astype(np.int32)


def asked_totals(code: np.ndarray, parts: int, shard: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Totals of a block's distinct words, from shards that each answer in the order of the words."""
    out = np.empty(len(code), np.int64)
    out[np.argsort(shard_of(code, parts), kind="stable")] = total[np.argsort(shard, kind="stable")]
    return out


def counted(blocks: DataFrame, parts: int, fan: int = FAN) -> DataFrame:
    """Counts in the whole corpus: each shard's table (kind 2), and messages (kind 0) to the blocks that asked, in the order in which they did."""
    exchange, back_ = Exchange(parts, WORDS, fan), Exchange(parts, TOTALS, fan)

    def ask(batches):
        for _, part, (_, texts) in _rows(batches):
            code, n = distinct_words(texts)
            yield from exchange.rows(exchange.sent([code, n], shard_of(code, parts), part, part)).to_batches()

    def answer(key, asked):
        home = key[0].as_py()
        origin, code, n = exchange.opened(asked)
        each, back = np.unique(code, return_inverse=True)
        total = np.bincount(back, weights=n).astype(np.int64)
        return back_.rows([*back_.kept(2, home, [each, total]), *back_.sent([np.full(len(code), home, np.int32), total[back]], origin, home, home)])

    return checkpointed(exchange.delivered(blocks.mapInArrow(ask, SENT)).groupBy("part").applyInArrow(answer, SENT))


def word_counts(counted: DataFrame) -> DataFrame:
    """code and n of every word of all texts."""

    def tell(batches):
        for batch in batches:
            for blob in batch.column("blob"):
                code, n = unpacked([blob.as_py()], WORDS)
                yield pa.RecordBatch.from_arrays([pa.array(code.view(np.int64)), pa.array(n)], names=["code", "n"])

    return counted.where("kind = 2").select("blob").mapInArrow(tell, "code long, n long")


def frequent_words(counts: DataFrame) -> np.ndarray:
    """Hash and number of the most frequent words, counted over all texts, in order of the hash."""
    top = counts.orderBy(F.desc("n"), "code").limit(VOCABULARY // 2).collect()
    table = np.array([[int(r["code"]) % (1 << 64), i] for i, r in enumerate(top)], np.uint64).reshape(-1, 2)
    return table[np.argsort(table[:, 0])]


def bucket_totals(counts: DataFrame, frequent: np.ndarray) -> np.ndarray:
    """Occurrences of the words of each bucket and of its unknown word."""
    half = VOCABULARY // 2

    def add(batches):
        n, once = np.zeros(half, np.int64), np.zeros(half, np.int64)
        for batch in batches:
            code, times = batch.column("code").to_numpy().view(np.uint64), batch.column("n").to_numpy()
            own = ~np.isin(code, frequent[:, 0])
            bucket = (code[own] % np.uint64(half)).astype(np.int64)
            np.add.at(n, bucket, times[own])
            np.add.at(once, bucket, times[own] == 1)
        yield pa.RecordBatch.from_arrays([pa.array(range(half), pa.int32()), pa.array(n), pa.array(once)], names=["bucket", "n", "once"])

    sums = counts.mapInArrow(add, "bucket int, n long, once long").groupBy("bucket").agg(F.sum("n").alias("n"), F.sum("once").alias("once")).collect()
    out = np.ones(half)
    for r in sums:
        out[r["bucket"]] = r["n"] + max(r["once"], 1)
    return out


def _flat(p: Parameters) -> np.ndarray:
    return np.concatenate([p[k].reshape(-1) for k in sorted(p)])


def _shaped(flat: np.ndarray, like: Parameters) -> Parameters:
    out, at = {}, 0
    for k in sorted(like):
        out[k] = flat[at : at + like[k].size].reshape(like[k].shape).copy()
        at += like[k].size
    return out


def masked_positions(word: np.ndarray, text: np.ndarray, code: np.ndarray, share: float, turn: int, seed: int) -> np.ndarray:
    """Positions to train on, by a hash of the word and its place in its text."""
    place = np.arange(len(word))
    place -= np.maximum.accumulate(np.where(np.diff(text, prepend=-1) != 0, place, 0))
    with np.errstate(over="ignore"):
        die = mix64(place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + code + np.uint64(turn * 7919 + seed))
    return np.flatnonzero((die >> np.uint64(11)) / float(1 << 53) < share)


def train(blocks: DataFrame, frequent: np.ndarray, rounds: int = ROUNDS, masked: float = MASKED, side: int = SIDE, seed: int = SEED) -> Parameters:
    """Local gradient steps in every lane, averaged by positions after each round."""
    context = blocks.sparkSession.sparkContext
    now = fresh(side, seed)
    width = 1 << 14  # parameters of a block
    message = "block int, lane int, seen double, values binary"

    def packed_parameters(flat: np.ndarray, lane: int, seen: float) -> pa.RecordBatch:
        cuts = range(0, len(flat), width)
        return pa.RecordBatch.from_arrays(
            [pa.array(range(len(cuts)), pa.int32()), pa.array([lane] * len(cuts), pa.int32()), pa.array([float(seen)] * len(cuts)), pa.array([flat[c : c + width].tobytes() for c in cuts], pa.binary())],
            names=["block", "lane", "seen", "values"],
        )

    for turn in range(rounds):
        shared = context.broadcast((now, frequent))

        def learn(batches, shared=shared, turn=turn):
            start, known = shared.value
            lane, seen, own, sums, held = None, 0, {}, {}, []
            for at_lane, _, (_, texts) in _rows(batches):
                if at_lane != lane:
                    seen += _steps(own, sums, held, seed)
                    if seen:
                        yield packed_parameters(_flat(own), lane, seen)
                    lane, seen, held = at_lane, 0, []
                    own = {k: v.copy() for k, v in start.items()}
                    sums = {k: np.full(v.shape, 1e-6, np.float32) for k, v in own.items()}
                for _, _, word, text, code in pieces(texts, known):
                    at = masked_positions(word, text, code, masked, turn, seed)
                    held.append((neighbours(word, text, at, side), word[at]))
                    if sum(len(w) for _, w in held) >= 8 * BATCH:
                        seen += _steps(own, sums, held, seed)
                        held = []
            seen += _steps(own, sums, held, seed)
            if seen:
                yield packed_parameters(_flat(own), lane, seen)

        def average(batches):
            total: dict[tuple[int, int], np.ndarray] = {}
            weight: dict[tuple[int, int], float] = {}
            for batch in batches:
                for block, lane, n, values in zip(*(batch.column(c).to_pylist() for c in ("block", "lane", "seen", "values")), strict=True):
                    total[block, lane] = total.get((block, lane), 0) + n * np.frombuffer(values, np.float32).astype(np.float64)
                    weight[block, lane] = weight.get((block, lane), 0.0) + n
            for (block, lane), n in weight.items():
                mean = (total[block, lane] / n).astype(np.float32).tobytes()
                yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([lane], pa.int32()), pa.array([n]), pa.array([mean], pa.binary())], names=["block", "lane", "seen", "values"])

        learnt = blocks.mapInArrow(learn, message)
        some = learnt.withColumn("lane", F.floor(F.col("lane") / AVERAGED).cast("int")).repartition("block", "lane").mapInArrow(average, message)
        found = some.withColumn("lane", F.lit(0)).repartition("block").mapInArrow(average, message).collect()
        if found:
            flat = np.concatenate([np.frombuffer(r["values"], np.float32) for r in sorted(found, key=lambda r: r["block"])])
            now = _shaped(flat, now)
        shared.unpersist()
    return now


def _steps(own: Parameters, sums: Parameters, held: list[tuple[np.ndarray, np.ndarray]], seed: int) -> int:
    if not held:
        return 0
    near, word = np.concatenate([n for n, _ in held], axis=1), np.concatenate([w for _, w in held])
    order = np.random.default_rng(seed).permutation(len(word))
    for low in range(0, len(order), BATCH):
        part = order[low : low + BATCH]
        gradient_step(own, sums, near[:, part], word[part])
    return len(word)


def score_texts(texts: list[bytes | None], p: Parameters, frequent: np.ndarray, side: int = SIDE, within: tuple[np.ndarray, np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Words and summed log-probabilities of each text.

    within: sorted hashes of the texts' words of buckets, and the logarithm of
    their share of the bucket; without it a word counts as its bucket.
    """
    words, sums = np.zeros(len(texts), np.int64), np.zeros(len(texts))
    for first, count, word, text, code in pieces(texts, frequent):
        words[first : first + len(count)] = count
        for low in range(0, len(word), CHUNK):
            at = np.arange(low, min(low + CHUNK, len(word)))
            log = log_probabilities(p, neighbours(word, text, at, side), word[at])
            sums[first : first + len(count)] += np.bincount(text[at], weights=log, minlength=len(count))
        shared = np.flatnonzero(word >= VOCABULARY // 2)
        if within is not None and len(shared):
            log = within[1][np.searchsorted(within[0], code[shared])]
            sums[first : first + len(count)] += np.bincount(text[shared], weights=log, minlength=len(count))
    return words, sums


def score(docs: DataFrame, rounds: int = ROUNDS, masked: float = MASKED, side: int = SIDE, seed: int = SEED, block_bytes: int = BLOCK_BYTES, fan: int = FAN) -> DataFrame:
    """doc_id, n_words, pseudo_log_likelihood and its mean per word."""
    blocks, parts = lanes(docs, block_bytes)
    found = counted(blocks, parts, fan)
    counts = word_counts(found)
    frequent = frequent_words(counts)
    shared = docs.sparkSession.sparkContext.broadcast((train(blocks, frequent, rounds, masked, side, seed), frequent, bucket_totals(counts, frequent)))
    exchange = Exchange(parts, TOTALS, fan)
    scored_type = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("pseudo_log_likelihood", pa.float64())])

    def run(key, block, answers):
        p, known, totals = shared.value
        ids, texts = documents(b.as_py() for b in block.column("blob"))
        _, shard, total = exchange.opened(answers)
        code, _ = distinct_words(texts)
        n = asked_totals(code, parts, shard, total)
        words, sums = score_texts(texts, p, known, side, (code, np.log(n / totals[(code % np.uint64(len(totals))).astype(np.int64)])))
        return pa.Table.from_arrays([pa.array(ids, pa.int64()), pa.array(words), pa.array(sums)], schema=scored_type)

    answers = exchange.delivered(found.where("kind = 0"))
    scored = blocks.groupBy("part").cogroup(answers.groupBy("part")).applyInArrow(run, "doc_id long, n_words long, pseudo_log_likelihood double")
    return scored.withColumn("mean_log_probability", F.try_divide("pseudo_log_likelihood", "n_words"))
