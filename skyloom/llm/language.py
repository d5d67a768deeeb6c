"""Language identification of words by a linear-chain conditional random field.

Words are runs of letters a-z, after lower-casing, and of characters beyond
ASCII, whose punctuation and digits thus count as letters of words.  A word's
features are its byte
n-grams of 2 to 4 bytes with a blank on either side (those with a blank are
its affixes), hashed to a table of fixed size, and the word itself if the
lexicon of the training words has it.  Transitions between neighbouring words
and start weights are learned with them by the gradient of the conditional
likelihood, on code-switched sequences spliced from labelled documents.
Forward-backward gives each word's label probabilities; a document's language
is the label of the largest summed probability, its score that share.

A text of over LONG_BYTES is cut into lanes of LANE words that advance side by
side: each lane's transfer matrix is taken first, a scan over the lanes joins
them to the messages that enter and leave every lane, and these make its
probabilities the same as those of one pass over the whole text.  Its features
are made in pieces cut between words.

Training uses a hash sample of about ``per_language`` labelled documents a
language (the documented bound), each whole, like every document that is then
labelled.

Defined cases: a null text, or one without letters, is ``und`` with score 0;
without labelled documents everything is; a null lang is never learned from; a
null doc_id is neither held out nor learned from; repeated rows get equal
results; a very long text is labelled whole, in lanes; further columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyloom.llm.suffix_trees import _powers

PER_LANGUAGE, SEED = 120, 11
BUCKETS = 1 << 16
LEXICON_COUNT = 3
#: Text labelled at once, and text whose features are held at once.
PIECE_BYTES, FEATURE_BYTES = 2 << 20, 256 << 10
#: Rows of a batch whose texts are held as Python strings at once.
SLICE_ROWS = 512
UNKNOWN = "und"
#: Text that is labelled in lanes, words of a lane, lanes at once.
LONG_BYTES, LANE, LANES = 256 << 10, 512, 256

_LETTER = re.compile(r"[^\W\d_]")
_KEEP = bytes(b if b >= 0x80 or 97 <= b <= 122 else 32 for b in range(256))


@dataclass
class Words:
    """The words of some texts: features of byte positions, and where words lie."""

    first: np.ndarray  # position of the blank before each word
    text: np.ndarray  # text of each word
    code: np.ndarray  # hash of each word
    grams: list[np.ndarray]  # buckets by position, BUCKETS where there is none
    size: int


def words_of(texts: list[bytes]) -> Words:
    """texts: lower-cased UTF-8."""
    buf = np.frombuffer(b" " + b" ".join(texts) + b"    ", np.uint8)
    buf = np.frombuffer(buf.tobytes().translate(_KEEP), np.uint8)
    solid = buf != 32
    step = np.diff(solid.astype(np.int8))
    first = np.flatnonzero(step == 1)
    end = np.flatnonzero(step == -1) + 1
    n = len(buf) - 3
    wide = buf.astype(np.uint32)
    grams, value = [], wide[:n]
    inner = np.ones(n, bool)
    for k in (2, 3, 4):
        value = (value << np.uint32(8)) | wide[k - 1 : n + k - 1]
        if k == 2:
            good = solid[:n] | solid[1 : n + 1]
        else:
            inner = inner & solid[k - 2 : n + k - 2]
            good = inner
        h = (value ^ np.uint32(0x9E3779B9 * k % (1 << 32))) * np.uint32(0x85EBCA6B)
        h = ((h ^ (h >> np.uint32(13))) * np.uint32(0xC2B2AE35)) >> np.uint32(16)
        grams.append(np.where(good, h, np.uint32(BUCKETS)).astype(np.int32))
    size = np.array([len(t) + 1 for t in texts], np.int64)
    text = np.searchsorted(np.cumsum(size), first, side="right")
    up, down = _powers(len(buf) + 1)
    total = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * up[:-1], out=total[1:])
    code = (total[end] - total[first + 1]) * down[first + 1]
    code = (code ^ (code >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    return Words(first, text, code ^ (code >> np.uint64(29)), grams, n)


@dataclass
class Model:
    labels: list[str]
    grams: np.ndarray  # BUCKETS + 1 rows; the last is 0
    lexicon: np.ndarray  # sorted hashes
    lexical: np.ndarray  # weights of the lexicon, and a last row of 0
    move: np.ndarray
    start: np.ndarray

    def plain(self) -> tuple:
        """What a worker that lacks the package can unpickle; Model(*plain) is the model."""
        return self.labels, self.grams, self.lexicon, self.lexical, self.move, self.start

    def lexicon_rows(self, code: np.ndarray) -> np.ndarray:
        if not len(self.lexicon):
            return np.zeros(len(code), np.int64)
        at = np.minimum(np.searchsorted(self.lexicon, code), len(self.lexicon) - 1)
        return np.where(self.lexicon[at] == code, at, len(self.lexicon))

    def emissions(self, words: Words, rows: np.ndarray) -> np.ndarray:
        if not len(words.first):
            return np.zeros((0, len(self.labels)), np.float32)
        each = self.grams[words.grams[0]]
        each += self.grams[words.grams[1]]
        each += self.grams[words.grams[2]]
        return np.add.reduceat(each, words.first, axis=0) + self.lexical[rows]


def forward_backward(emission: np.ndarray, text: np.ndarray, move: np.ndarray, start: np.ndarray, pairs: bool = False, enter: np.ndarray | None = None, leave: np.ndarray | None = None):
    """Label probabilities of each word; with ``pairs`` also expected starts and moves.

    Sequences (runs of one ``text``) advance side by side, longest first, so a
    step's words lie together.  ``enter`` and ``leave`` have a row for each
    sequence that is a part of a longer one: the weights of its first word's
    labels by what comes before it, and of its last word's by what comes after.
    """
    n, k = emission.shape
    probability = np.zeros((n, k), np.float32)
    moves, starts = np.zeros((k, k)), np.zeros(k)
    if not n:
        return probability, moves, starts
    begin = np.flatnonzero(np.concatenate([[True], text[1:] != text[:-1]]))
    length = np.diff(np.append(begin, n))
    order = np.argsort(-length, kind="stable")
    begin, length = begin[order], length[order]
    active = np.searchsorted(-length, -np.arange(length[0]), side="left")  # sequences longer than t
    base = np.cumsum(active) - active
    slot = np.repeat(base, active)
    place = np.arange(n) - slot  # which sequence
    source = begin[place] + np.repeat(np.arange(len(active)), active)
    e = np.exp(emission[source] - emission[source].max(axis=1, keepdims=True))
    a = np.empty_like(e)
    trans = np.exp(move - move.max()).astype(np.float32)
    now = e[: active[0]] * (np.exp(start - start.max()) if enter is None else enter[order]).astype(np.float32)
    now /= now.sum(axis=1, keepdims=True)
    a[: active[0]] = now
    ones = np.ones(k, np.float32)
    spans = list(zip(base.tolist(), active.tolist(), strict=True))
    for low, m in spans[1:]:
        now = (now[:m] @ trans) * e[low : low + m]
        now /= (now @ ones)[:, None]
        a[low : low + m] = now
    back = np.ones((len(begin), k), np.float32) / k if leave is None else leave[order].astype(np.float32)
    for t in range(len(spans) - 1, -1, -1):
        low, m = spans[t]
        here = a[low : low + m] * back[:m]
        here /= (here @ ones)[:, None]
        if t:
            seen = e[low : low + m] * back[:m]
            if pairs:
                prior = a[spans[t - 1][0] : spans[t - 1][0] + m]
                both = prior[:, :, None] * trans * seen[:, None, :]
                moves += (both / both.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
            b = seen @ trans.T
            b /= (b @ ones)[:, None]
            back[:m] = b
        else:
            starts = here.sum(axis=0, dtype=np.float64)
        a[low : low + m] = here
    probability[source] = a
    return probability, moves, starts


def _transfers(emission: np.ndarray, lane: int, trans: np.ndarray) -> np.ndarray:
    """For each lane the product of the steps from its first word to its last (the first word's own weights left out), scaled."""
    n, k = emission.shape
    lanes = -(-n // lane)
    out = np.broadcast_to(np.eye(k), (lanes, k, k)).copy()
    weight = np.exp(emission.astype(np.float64) - emission.max(axis=1, keepdims=True))
    for t in range(1, min(lane, n)):
        own = weight[t::lane]  # the t-th word of the lanes that have one
        step = (out[: len(own)] @ trans) * own[:, None, :]
        out[: len(own)] = step / step.sum(axis=(1, 2), keepdims=True)
    return out


def long_share(emission: np.ndarray, model: Model, lane: int | None = None, at_once: int | None = None) -> np.ndarray:
    """Summed label probabilities of the words of one long text."""
    lane, at_once = lane or LANE, at_once or LANES
    n, k = emission.shape
    trans = np.exp(model.move.astype(np.float64) - model.move.max())
    lanes = -(-n // lane)
    first = emission[::lane].astype(np.float64)
    first = np.exp(first - first.max(axis=1, keepdims=True))
    block = lane * at_once
    through = np.concatenate([_transfers(emission[at : at + block], lane, trans) for at in range(0, n, block)])
    enter, leave = np.empty((lanes, k)), np.empty((lanes, k))
    now = np.exp(model.start.astype(np.float64) - model.start.max())
    for j in range(lanes):  # the scan over lanes
        enter[j] = now / now.sum()
        now = (enter[j] * first[j]) @ through[j] @ trans
    now = np.ones(k)
    for j in range(lanes - 1, -1, -1):
        leave[j] = now / now.sum()
        now = trans @ (first[j] * (through[j] @ leave[j]))
    share = np.zeros(k)
    for at in range(0, n, block):
        own = emission[at : at + block]
        some = slice(at // lane, at // lane + -(-len(own) // lane))
        p, _, _ = forward_backward(own, np.arange(len(own)) // lane, model.move, model.start, enter=enter[some], leave=leave[some])
        share += p.sum(axis=0, dtype=np.float64)
    return share


def long_emissions(low: bytes, model: Model) -> np.ndarray:
    """What each word of a long text says of its label, by pieces cut between words."""
    kept, at, out = low.translate(_KEEP), 0, []
    while at < len(kept):
        end = kept.find(b" ", at + FEATURE_BYTES)
        end = len(kept) if end < 0 else end
        words = words_of([kept[at:end]])
        out.append(model.emissions(words, model.lexicon_rows(words.code)))
        at = end
    return np.concatenate(out)


def spliced(documents: list[tuple[str, bytes]], seed: int = SEED) -> tuple[list[bytes], list[list[tuple[str, int]]]]:
    """Sequences of pieces of different documents: texts, and (label, bytes) of their pieces."""
    dice = np.random.default_rng(seed)
    pieces = []
    for label, text in documents:
        words = text.split()
        at = 0
        while at < len(words):
            n = int(dice.integers(4, 40))
            pieces.append((label, b" ".join(words[at : at + n])))
            at += n
    pieces = [pieces[i] for i in dice.permutation(len(pieces))]
    texts, marks = [], []
    while pieces:
        own, pieces = pieces[:5], pieces[5:]
        texts.append(b" ".join(t for _, t in own))
        marks.append([(label, len(t) + 1) for label, t in own])
    return texts, marks


def train(documents: list[tuple[str, bytes]], epochs: int = 8, batch: int = 100, rate: float = 0.2, seed: int = SEED) -> Model:
    """documents: (label, lower-cased words with blanks between them)."""
    labels = sorted({label for label, _ in documents})
    k = len(labels)
    number = {label: i for i, label in enumerate(labels)}
    texts, marks = spliced(documents, seed)
    model = Model(labels, np.zeros((BUCKETS + 1, k), np.float32), np.zeros(0, np.uint64), np.zeros((1, k), np.float32), np.zeros((k, k), np.float32), np.zeros(k, np.float32))
    if k < 2:
        return model
    found = [np.unique(words_of(texts[low : low + batch]).code, return_counts=True) for low in range(0, len(texts), batch)]
    code, back = np.unique(np.concatenate([np.zeros(0, np.uint64), *(c for c, _ in found)]), return_inverse=True)
    times = np.bincount(back, weights=np.concatenate([np.zeros(0), *(n for _, n in found)]), minlength=len(code))
    model.lexicon = code[times >= LEXICON_COUNT]
    model.lexical = np.zeros((len(model.lexicon) + 1, k), np.float32)
    prepared = []
    for low in range(0, len(texts), batch):
        part = texts[low : low + batch]
        words = words_of(part)
        ends = np.cumsum([n for m in marks[low : low + batch] for _, n in m])
        gold = np.array([number[label] for m in marks[low : low + batch] for label, _ in m])
        prepared.append((words, gold[np.searchsorted(ends, words.first, side="right")], model.lexicon_rows(words.code)))
    sums = [np.full(x.shape, 1e-2) for x in (model.grams, model.lexical, model.move, model.start)]
    dice = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in dice.permutation(len(prepared)):
            words, gold, rows = prepared[i]
            if not len(gold):
                continue
            p, moves, starts = forward_backward(model.emissions(words, rows), words.text, model.move, model.start, pairs=True)
            delta = -p.astype(np.float64)
            delta[np.arange(len(gold)), gold] += 1
            joint = words.text[1:] == words.text[:-1]
            opens = np.concatenate([[True], ~joint])
            seen = np.zeros((k, k))
            np.add.at(seen, (gold[:-1][joint], gold[1:][joint]), 1)
            begun = np.bincount(gold[opens], minlength=k)
            reach = np.diff(np.append(words.first, words.size))
            at = np.repeat(np.arange(len(gold)), reach)
            gram = np.zeros((BUCKETS + 1, k))
            for g in words.grams:
                own = g[words.first[0] :]
                for j in range(k):
                    gram[:, j] += np.bincount(own, weights=delta[at, j], minlength=BUCKETS + 1)
            lexical = np.stack([np.bincount(rows, weights=delta[:, j], minlength=len(model.lexical)) for j in range(k)], axis=1)
            gram[-1] = lexical[-1] = 0
            for x, g, s in zip((model.grams, model.lexical, model.move, model.start), (gram, lexical, seen - moves, begun - starts), sums, strict=True):
                g = g / len(gold) - 1e-7 * x
                s += g * g
                x += (rate * g / np.sqrt(s)).astype(np.float32)
    return model


def _lowered(text: str | None) -> bytes:
    return text.lower().encode() if text and _LETTER.search(text) else b""


def label_words(text: str, model: Model) -> list[tuple[str, dict[str, float]]]:
    """The words of one text with their label probabilities."""
    low = _lowered(text)
    words = words_of([low])
    p, _, _ = forward_backward(model.emissions(words, model.lexicon_rows(words.code)), words.text, model.move, model.start)
    found = low.translate(_KEEP).split(b" ")
    return [(w.decode(errors="replace"), dict(zip(model.labels, row.tolist(), strict=True))) for w, row in zip(filter(None, found), p, strict=True)]


def predict(texts: list[str | None], model: Model) -> tuple[list[str], list[float]]:
    labels, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
    if not model.labels:
        return labels, scores
    first = 0
    while first < len(texts):
        end, size = first, 0
        found: list[tuple[np.ndarray, np.ndarray]] = []
        while end < len(texts) and size < PIECE_BYTES:
            low, start = [], end
            held = 0
            while end < len(texts) and held < FEATURE_BYTES:
                own = _lowered(texts[end])
                if len(own) > LONG_BYTES:
                    share = long_share(long_emissions(own, model), model)
                    labels[end], scores[end] = model.labels[int(share.argmax())], min(1.0, float(share.max() / share.sum()))
                    own = b""
                low.append(own)
                held += len(low[-1]) + 1
                end += 1
            size += held
            words = words_of(low)
            found.append((model.emissions(words, model.lexicon_rows(words.code)), words.text + (start - first)))
        emission, text = (np.concatenate(x) for x in zip(*found, strict=True))
        p, _, _ = forward_backward(emission, text, model.move, model.start)
        if len(p):
            begin = np.flatnonzero(np.concatenate([[True], text[1:] != text[:-1]]))
            share = np.add.reduceat(p, begin, axis=0, dtype=np.float64)
            share /= share.sum(axis=1, keepdims=True)
            best = share.argmax(axis=1)
            for i, b, s in zip(text[begin].tolist(), best.tolist(), share.max(axis=1).tolist(), strict=True):
                labels[first + i], scores[first + i] = model.labels[b], min(1.0, s)
        first = end
    return labels, scores


def predict_column(texts: pa.Array, model: Model) -> tuple[list[str], list[float]]:
    """predict() of a batch, a slice of its rows at a time."""
    labels, scores = [], []
    for at in range(0, len(texts), SLICE_ROWS):
        some, shares = predict(texts.slice(at, SLICE_ROWS).to_pylist(), model)
        labels += some
        scores += shares
    return labels, scores


def held_out():
    """The fold that is never learned from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE, seed: int = SEED) -> Model:
    """A model of labelled documents outside the held-out fold, whole texts of about per_language of each language."""
    rows = docs.select("doc_id", "text", F.col("lang").cast("string").alias("lang")).where("doc_id is not null and text is not null and lang is not null").where(~held_out())
    counts = {r[0]: r[1] for r in rows.groupBy("lang").count().collect()}
    if not counts:
        return train([])
    share = F.create_map(*[F.lit(x) for lang, n in sorted(counts.items()) for x in (lang, min(1.0, per_language / n))])
    die = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit(seed)), F.lit(1 << 40)) / float(1 << 40)
    chosen = rows.where(die < F.element_at(share, F.col("lang")))

    def words(batches):
        for batch in batches:
            out = [_lowered(text).translate(_KEEP) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), batch.column("lang"), pa.array(out, pa.binary())], names=["doc_id", "lang", "words"])

    found = sorted((r[0], r[1], bytes(r[2])) for r in chosen.mapInArrow(words, "doc_id long, lang string, words binary").collect())
    return train([(lang, text) for _, lang, text in found if text.strip()], seed=seed)


def identify(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document."""
    model = fit(docs) if model is None else model
    shared = docs.sparkSession.sparkContext.broadcast(model.plain())  # tables of fixed size

    def run(batches):
        own = Model(*shared.value)
        for batch in batches:
            labels, scores = predict_column(batch.column("text"), own)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), batch.column("held_out"), pa.array(labels, pa.string()), pa.array(scores, pa.float64())],
                names=["doc_id", "held_out", "lang_pred", "score"],
            )

    return docs.select("doc_id", "text", held_out().alias("held_out")).mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def keep_identified(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """docs without those that have no language, or none with a share of ``least``."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs).plain())

    def run(batches):
        own = Model(*shared.value)
        for batch in batches:
            labels, scores = predict_column(batch.column("text"), own)
            yield batch.filter(pa.array([label != UNKNOWN and s >= least for label, s in zip(labels, scores, strict=True)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
