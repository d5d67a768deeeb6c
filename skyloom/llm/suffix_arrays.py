"""Substring dedup by suffix arrays over bytes.

Every byte covered by a ``length``-byte string that starts earlier (in a
smaller doc_id, or earlier in the document) goes.  The different contexts of
shared anchors (see ``repeats``), each with the earliest place of its copies,
are cut into shards; each shard gets a suffix array by Larsson-Sadakane refinement (groups of equal prefixes are split by
the ranks that lie as far on as the prefix is long, doubling it), Kasai's
common prefixes in text order, and strings that one shard shares with an
earlier one are found by binary search in the earlier shard's sorted strings.

Defined cases: a null or empty text has no bytes; documents shorter than the
string lose nothing; rows that repeat a doc_id count as one document, in which
only a smaller offset is earlier; a null doc_id counts as the largest; further columns are ignored; an empty
table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from skyloom.llm.blocks import BLOCK_BYTES, FAN
from skyloom.llm.repeats import HOT, Method, Occurrences, gram_anchors, removed_windows, rolled

LENGTH, GRAM = 100, 32
#: Context bytes of one suffix array.
SHARD_BYTES = 2 << 20
#: Positions that a lane of the common prefix pass walks.
LANE = 256


def _words(text: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on as a big-endian number; zeros follow the end."""
    padded = np.concatenate([text, np.zeros(8, np.uint8)]).astype(np.uint64)
    pair = (padded[:-1] << np.uint64(8)) | padded[1:]
    four = (pair[:-2] << np.uint64(16)) | pair[2:]
    return ((four[:-4] << np.uint64(32)) | four[4:])[: len(text)]


def _symbols(text: np.ndarray) -> np.ndarray:
    """The seven bytes from each position on, each plus one in nine bits; 0 is past the end."""
    v = np.concatenate([text.astype(np.uint64) + np.uint64(1), np.zeros(7, np.uint64)])
    n = len(text)
    pair = (v[:-1] << np.uint64(9)) | v[1:]
    four = (pair[:-2] << np.uint64(18)) | pair[2:]
    return (four[:n] << np.uint64(27)) | (pair[4 : n + 4] << np.uint64(9)) | v[6 : n + 6]


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Positions in the order of their first ``depth`` bytes (at least 7); a suffix comes before its extensions."""
    n = len(text)
    key = _symbols(text)
    sa = np.argsort(key, kind="stable")
    new = np.ones(n, bool)
    new[1:] = key[sa][1:] != key[sa][:-1]
    rank = np.empty(n, np.int64)
    rank[sa] = np.maximum.accumulate(np.where(new, np.arange(n), 0)) + 1  # 0 is past the end
    have = 7
    while have < depth:
        step = min(have, depth - have)  # the last step overlaps
        alone = new & np.append(new[1:], True)
        open_ = np.flatnonzero(~alone)  # slots of groups that are not single yet
        if not len(open_):
            break
        at = sa[open_]
        ahead = at + step
        second = np.where(ahead < n, rank[np.minimum(ahead, n - 1)], 0)
        both = (rank[at] << np.int64(31)) | second
        order = np.argsort(both, kind="stable")
        both = both[order]
        sa[open_] = at[order]
        split = np.ones(len(open_), bool)
        split[1:] = both[1:] != both[:-1]
        new[open_] = split
        head = np.maximum.accumulate(np.where(split, open_, 0))
        rank[sa[open_]] = head + 1
        have += step
    return sa


def common_prefixes(text: np.ndarray, sa: np.ndarray, depth: int) -> np.ndarray:
    """Kasai: common prefix, up to ``depth``, of each suffix with the one before it in sa.

    The length drops by at most one from a position to the next, so only new
    bytes are compared.  Lanes of consecutive positions advance side by side.
    """
    n = len(text)
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    word = _words(text)
    found = np.zeros(n, np.int64)
    starts = np.arange(0, n, LANE)
    length = np.zeros(len(starts), np.int64)
    for step in range(min(LANE, n)):
        at = starts + step
        if at[-1] >= n:
            starts, at, length = starts[:-1], at[:-1], length[:-1]
            if not len(at):
                break
        other = before[at]
        # suffixes equal to the full depth stand in any order, which tells nothing of the next
        length = np.where((length >= depth) | (other < 0), 0, np.maximum(length - 1, 0))
        go = np.flatnonzero((other >= 0) & (length < depth))
        while len(go):
            a, b = at[go] + length[go], other[go] + length[go]
            inside = np.maximum(a, b) < n
            go, a, b = go[inside], a[inside], b[inside]
            differ = word[a] ^ word[b]
            # equal leading bytes of the two words; the float's exponent tells the highest set bit
            equal = np.where(differ == 0, 8, 7 - (np.frexp(np.maximum(differ >> np.uint64(11), 0).astype(np.float64))[1] + 10) // 8)
            small = (differ != 0) & (differ < np.uint64(1 << 11))
            if small.any():
                equal[small] = np.where(differ[small] < 256, 7, 6)
            length[go] += np.minimum(equal, n - np.maximum(a, b))
            go = go[(equal == 8) & (length[go] < depth)]
        found[at] = np.minimum(length, depth)
    return found[sa]


class Shard:
    """The sorted strings of a shard's contexts, each with its earliest start."""

    def __init__(self, seen: Occurrences, which: np.ndarray, length: int):
        parts = [seen.text[i] for i in which.tolist()]
        self.text = np.frombuffer(b"".join(parts), np.uint8)
        sizes = np.array([len(p) for p in parts])
        base = np.cumsum(sizes) - sizes
        count = seen.count[which]
        # windows: the context, the offset in it and the position in the shard's text
        self.context = np.repeat(which, count)
        self.offset = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        place = np.repeat(base, count) + self.offset
        window = np.full(len(self.text), -1, np.int64)
        window[place] = np.arange(len(place))
        sa = suffix_array(self.text, length)
        new = common_prefixes(self.text, sa, length) < length
        mine = window[sa] >= 0
        string = np.cumsum(new)[mine]
        own = window[sa[mine]]
        doc, start = seen.doc[self.context], seen.start[self.context] + self.offset
        head = np.flatnonzero(np.concatenate([[True], string[1:] != string[:-1]])) if len(string) else np.zeros(0, np.int64)
        size = np.diff(np.append(head, len(string)))
        lead = own[head]
        many = np.flatnonzero(size > 1)  # the earliest of several occurrences leads
        rank = np.repeat(np.arange(len(many)), size[many])
        inside = own[np.repeat(head[many] - np.cumsum(size[many]) + size[many], size[many]) + np.arange(len(rank))]
        order = np.lexsort((start[inside], doc[inside], rank))
        lead[many] = inside[order][np.cumsum(size[many]) - size[many]]
        self.string = np.empty(len(own), np.int64)
        self.string[own] = np.repeat(np.arange(len(head)), size)
        self.first_doc, self.first_start = doc[lead], start[lead]
        self.place, self.length, self._strings = place[lead], length, None

    @property
    def strings(self) -> np.ndarray:
        """The distinct strings in order, made when another shard asks for them."""
        if self._strings is None:
            rows = np.lib.stride_tricks.sliding_window_view(self.text, self.length)[self.place] if len(self.place) else np.zeros((0, self.length), np.uint8)
            self._strings = np.ascontiguousarray(rows).view(f"S{self.length}").reshape(-1)
        return self._strings

    def merge_earlier(self, other: Shard) -> None:
        """Lets strings that ``other`` holds too start where they start first, in both."""
        if not len(self.strings) or not len(other.strings):
            return
        at = np.minimum(np.searchsorted(other.strings, self.strings), len(other.strings) - 1)
        mine = np.flatnonzero(other.strings[at] == self.strings)
        at = at[mine]
        a, b = (self.first_doc[mine], self.first_start[mine]), (other.first_doc[at], other.first_start[at])
        less = (b[0] < a[0]) | (b[0] == a[0]) & (b[1] < a[1])
        self.first_doc[mine], self.first_start[mine] = np.where(less, b[0], a[0]), np.where(less, b[1], a[1])
        other.first_doc[at], other.first_start[at] = self.first_doc[mine], self.first_start[mine]

    def firsts(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(context, window, document, start) of all windows, in order: where their strings start first."""
        return self.context, self.offset, self.first_doc[self.string], self.first_start[self.string]


def solver(length: int, shard_bytes: int):
    def solve(seen: Occurrences):
        size = np.cumsum([len(t) for t in seen.text])
        number = (size - 1) // shard_bytes
        shards: list[Shard] = []
        for k in np.unique(number):
            which = np.flatnonzero(number == k)
            shards.append(Shard(seen, which, length))
            # equal strings have equal anchors, and contexts are in order of the anchor
            if which[0] and seen.anchor[which[0] - 1] == seen.anchor[which[0]]:
                for other in shards[:-1]:
                    shards[-1].merge_earlier(other)
            elif len(shards) > 1:
                yield from _settled(shards[:-1])
                shards = shards[-1:]
        yield from _settled(shards)

    return solve


def _settled(shards: list[Shard]):
    if len(shards) > 2:  # a start that a later shard lowered reaches the others
        for a in shards:
            for b in shards:
                if a is not b:
                    a.merge_earlier(b)
    for shard in shards:
        yield shard.firsts()


def byte_contexts(length: int, gram: int):
    def contexts(texts: list[bytes]):
        buf = np.frombuffer(b"".join(texts), np.uint8)
        none = np.zeros(0, np.int64)
        if len(buf) < length:
            return none, none, none, none.astype(np.uint64)
        size = np.array([len(t) for t in texts])
        base = np.cumsum(size) - size
        grams = rolled(buf.astype(np.uint64) + np.uint64(1), gram)
        edge = np.zeros(len(buf) + 1, np.int8)
        long = size >= length
        np.add.at(edge, base[long], 1)
        np.add.at(edge, (base + size - length + 1)[long], -1)
        start, count, anchor = gram_anchors(grams, length - gram + 1, np.cumsum(edge[:-1], dtype=np.int8) > 0)
        doc = np.searchsorted(base, start, side="right") - 1
        return doc, start - base[doc], count, anchor

    return contexts


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, shard_bytes: int = SHARD_BYTES, hot: int = HOT, block_bytes: int = BLOCK_BYTES, fan: int = FAN) -> DataFrame:
    """doc_id, n_bytes, removed spans (start, end) and kept bytes' digest per document."""

    def finish(text: bytes, windows: list[tuple[int, int]]):
        if not windows:
            return len(text), 0, [], hashlib.sha256(text).hexdigest()
        depth = np.zeros(len(text) + 1, np.int32)
        at = np.array(windows, np.int64)
        np.add.at(depth, at[:, 0], 1)
        np.add.at(depth, at.sum(axis=1) + length - 1, -1)
        gone = np.cumsum(depth[:-1]) > 0
        edge = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
        kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
        spans = [{"start": a, "end": b} for a, b in edge.reshape(-1, 2).tolist()]
        return len(text), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()

    def slicer(text: bytes):
        return lambda start, count: text[start : start + count + length - 1]

    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    return removed_windows(
        docs,
        Method(
            byte_contexts(length, gram), slicer, solver(length, shard_bytes), finish, True,
            ("n_bytes", "n_removed", "spans", "kept_sha256"), (pa.int64(), pa.int64(), span, pa.string()),
            "n_bytes long, n_removed long, spans array<struct<start: long, end: long>>, kept_sha256 string",
        ),
        hot, block_bytes, fan,
    )
