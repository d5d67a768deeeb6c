"""Substring dedup by prefix-partitioned suffix trees over words.

Words covered by a window of ``length`` words that also starts in a smaller
doc_id go.  Of the different contexts of shared anchors (see ``repeats``) each
window is a suffix that carries the least doc_id of its context's copies.
Suffixes are split by variable-length prefixes: by their first word, and where
a prefix has more suffixes than fit in memory by one more word, until every
group fits.  Each group becomes a suffix tree, built from its sorted suffixes
and their common prefixes; its internal nodes at least ``length`` words deep
are the maximal repeats, and the least doc_id below such a node (or at a leaf
of several copies) keeps its words.

Defined cases: a null, empty or blank text has no words; a text of fewer words
than a window loses none; rows that repeat a doc_id count as one document and
keep each other's words; a null doc_id counts as the largest; further columns
are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from skyloom.llm.blocks import BLOCK_BYTES, FAN
from skyloom.llm.common import mix64
from skyloom.llm.repeats import _BASE, HOT, Method, Occurrences, gram_anchors, removed_windows, rolled

LENGTH, GRAM = 13, 5
#: Suffixes of one tree.
GROUP = 200_000

_SPACE = np.array([b in b"\t\n\v\f\r " for b in range(256)])
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """_BASE ** i and its inverse, modulo 2^64, for i < n."""
    if len(_POWERS.get("up", ())) < n:
        size = max(n, 1 << 18)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            out = np.ones(size, np.uint64)
            have = 1
            while have < size:
                take = min(have, size - have)
                out[have : have + take] = out[:take] * np.uint64(pow(base, have, 1 << 64))
                have += take
            _POWERS[name] = out
    return _POWERS["up"][:n], _POWERS["down"][:n]


def word_hashes(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and 64-bit hash of every word of a text."""
    solid = ~_SPACE[buf]
    edge = np.diff(np.concatenate([[False], solid, [False]]).astype(np.int8))
    first, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    up, down = _powers(len(buf) + 1)
    total = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * up[:-1], out=total[1:])
    return first, mix64((total[end] - total[first]) * down[first] + (end - first).astype(np.uint64))


def word_contexts(length: int, gram: int):
    def contexts(texts: list[bytes]):
        buf = np.frombuffer(b" ".join(texts), np.uint8)
        first, code = word_hashes(buf)
        none = np.zeros(0, np.int64)
        if len(code) < length:
            return none, none, none, none.astype(np.uint64)
        size = np.array([len(t) + 1 for t in texts])
        doc_of = np.searchsorted(np.cumsum(size) - size, first, side="right") - 1
        valid = doc_of[: len(code) - length + 1] == doc_of[length - 1 :]
        # a document's last valid window and the next one's first are never adjacent
        start, count, anchor = gram_anchors(rolled(code, gram), length - gram + 1, valid)
        doc = doc_of[start]
        base = np.searchsorted(doc_of, np.arange(len(texts)))
        return doc, start - base[doc], count, anchor

    return contexts


class SuffixTree:
    """Internal nodes (depth, low, high) over sorted suffixes, from their common prefixes.

    common[i] is what suffix i shares with suffix i - 1; common[0] is 0.  A node
    spans the sorted suffixes low to high - 1.
    """

    def __init__(self, common: list[int]):
        self.nodes: list[tuple[int, int, int]] = []
        open_: list[tuple[int, int]] = [(0, 0)]
        for i, depth in enumerate([*common[1:], 0], 1):
            low = i - 1
            while open_[-1][0] > depth:
                top, low = open_.pop()
                self.nodes.append((top, low, i))
            if open_[-1][0] < depth:
                open_.append((depth, low))

    def deep(self, depth: int) -> list[tuple[int, int]]:
        return [(low, high) for d, low, high in self.nodes if d >= depth]


def prefix_groups(words: np.ndarray, starts: np.ndarray, length: int, limit: int):
    """Suffixes in groups of at most ``limit`` (more only if equal for ``length`` words), by variable-length prefixes.

    Yields arrays of suffixes in the order of their prefixes; prefixes that are
    neighbours share a group while it fits.
    """
    todo = [(np.arange(len(starts)), 0)]
    while todo:
        own, depth = todo.pop()
        if len(own) <= limit or depth == length:
            if len(own):
                yield own
            continue
        word = words[starts[own] + depth]
        order = np.argsort(word, kind="stable")
        own, word = own[order], word[order]
        cut = np.append(np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]])), len(own)).tolist()
        low = 0
        parts = []
        for a, b in zip(cut[:-1], cut[1:], strict=True):
            if b - a > limit:  # this prefix needs one more word
                parts += [(own[low:a], length), (own[a:b], depth + 1)]
                low = b
            elif b - low > limit:
                parts.append((own[low:a], length))
                low = a
        parts.append((own[low:], length))
        todo += [p for p in parts if len(p[0])]


def _sorted_suffixes(words: np.ndarray, starts: np.ndarray, own: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in order, and the words each shares with the one before, up to ``length``."""
    at = starts[own]
    order = np.arange(len(own))
    rank = np.zeros(len(own), np.int64)
    common = np.zeros(len(own), np.int64)
    for depth in range(length):  # one word more of the suffixes that are still equal
        twin = np.zeros(len(own), bool)
        same = rank[1:] == rank[:-1]
        twin[1:] |= same
        twin[:-1] |= same
        open_ = np.flatnonzero(twin)
        if not len(open_):
            break
        slot_rank = rank[open_]
        word = words[at[order[open_]] + depth]
        new = np.argsort((slot_rank << np.int64(32)) | word, kind="stable")
        order[open_] = order[open_][new]
        word = word[new]
        equal = np.concatenate([[False], (slot_rank[1:] == slot_rank[:-1]) & (word[1:] == word[:-1])])
        common[open_[equal]] = depth + 1
        head = np.maximum.accumulate(np.where(equal, 0, open_))
        rank[open_] = head
    return own[order], common


def solver(length: int, limit: int):
    def solve(seen: Occurrences):
        parts = [t.split(b" ") for t in seen.text]
        size = np.array([len(p) for p in parts])
        ids: dict[bytes, int] = {}
        words = np.fromiter((ids.setdefault(w, len(ids)) for p in parts for w in p), np.int64, size.sum())
        base = np.cumsum(size) - size
        context = np.repeat(np.arange(len(parts)), seen.count)
        window = np.arange(seen.count.sum()) - np.repeat(np.cumsum(seen.count) - seen.count, seen.count)
        starts = base[context] + window
        doc = seen.doc[context]
        first = doc.copy()  # a leaf occurs where its context does
        for own in prefix_groups(words, starts, length, limit):
            suffix, common = _sorted_suffixes(words, starts, own, length)
            for low, high in SuffixTree(common.tolist()).deep(length):
                below = suffix[low:high]
                first[below] = doc[below].min()
        yield context, window, first, np.zeros(len(first), np.int64)

    return solve


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, limit: int = GROUP, hot: int = HOT, block_bytes: int = BLOCK_BYTES, fan: int = FAN) -> DataFrame:
    """doc_id, n_words, removed spans of words and the kept words' digest per document."""

    def finish(text: bytes, windows: list[tuple[int, int]]):
        words = text.split()
        if not windows:
            return len(words), 0, [], hashlib.sha256(b" ".join(words)).hexdigest()
        depth = np.zeros(len(words) + 1, np.int32)
        at = np.array(windows, np.int64)
        np.add.at(depth, at[:, 0], 1)
        np.add.at(depth, at.sum(axis=1) + length - 1, -1)
        gone = np.cumsum(depth[:-1]) > 0
        edge = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
        spans = [{"start": a, "end": b} for a, b in edge.reshape(-1, 2).tolist()]
        kept = b" ".join([w for w, out in zip(words, gone.tolist(), strict=True) if not out])
        return len(words), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()

    def slicer(text: bytes):
        words = text.split()
        return lambda start, count: b" ".join(words[start : start + count + length - 1])

    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    return removed_windows(
        docs,
        Method(
            word_contexts(length, gram), slicer, solver(length, limit), finish, False,
            ("n_words", "n_removed", "spans", "kept_sha256"), (pa.int64(), pa.int64(), span, pa.string()),
            "n_words long, n_removed long, spans array<struct<start: long, end: long>>, kept_sha256 string",
        ),
        hot, block_bytes, fan,
    )
