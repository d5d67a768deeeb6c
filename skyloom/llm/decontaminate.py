"""Benchmark decontamination with one Aho-Corasick automaton.

Benchmark items and documents are normalised alike: A-Z lower-cased, words
are runs of digits, letters a-z and any character from U+0080 on.  The
translation maps bytes one to one, so a word's offsets in the normalised
text are its byte offsets in the original.  Every window of ``n`` item words
(a shorter item is one window) becomes a pattern of word numbers; documents
are scanned once by one automaton and each word inside an occurrence counts as
hit.  The automaton lies in arrays, children of a node side by side, so that a
node takes 16 bytes, and is built once and broadcast; up to AUTOMATON_BYTES of
item text make one (some 35 bytes a byte).  Beyond that further automata are
built in turn over the rows at hand.  Rows are judged one by one whatever the
size of the benchmark; nothing is shuffled.

Defined cases: a null or wordless text has no words and no hits; repeated
rows and repeated items give repeated equal results; a very long text is
scanned whole, in lanes; an empty benchmark hits nothing; words that an item without an item_id holds are hit, but it is not
listed; further columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyloom.llm.common import byte_rows

WINDOW = 13
#: Item text that one automaton holds; a larger benchmark is split by item.
AUTOMATON_BYTES = 4 << 20
#: Documents' text that several automata are built for, one after the other.
HELD_BYTES = 64 << 20
#: Text scanned at once, and words of a lane of it; all lanes advance side by side.
PIECE_BYTES, LANE = 4 << 20, 128
#: Rows of a batch whose texts are held as Python bytes at once.
SLICE_ROWS = 1024

_WORD = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 0x80 or 48 <= b <= 57 or 97 <= b <= 122 else 32
    for b in range(256)
)
_SCHEMA = (
    "doc_id long, n_words long, hit_words array<int>, items array<string>, "
    "spans array<struct<start: long, end: long>>"
)

Items = list[tuple[str | None, bytes | None]]
Found = tuple[int, list[int], list[str], list[dict]]


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_WORD).split() if text else []


class Automaton:
    """Aho-Corasick over word numbers; node 0 is the root, nodes are numbered level by level.

    Children of a node are ``first[node]`` to ``first[node + 1] - 1``, in order
    of their words; ``fail`` is the node of the longest suffix, ``told`` the
    nearest node on the way along the fails (itself first) that ends a window.
    """

    def __init__(self, items: Items, n: int = WINDOW):
        self.ids = sorted({i for i, _ in items if i is not None})
        place = {i: k for k, i in enumerate(self.ids)}
        self.words: dict[bytes, int] = {}
        texts = [(place.get(i, -1), [self.words.setdefault(w, len(self.words) + 1) for w in words_of(t)]) for i, t in items]
        texts = [(i, w) for i, w in texts if w]
        self.n = n
        flat = np.array([x for _, w in texts for x in w], np.int32)
        size = np.array([len(w) for _, w in texts], np.int64)
        windows = np.maximum(size - n + 1, 1)
        inside = np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
        start = np.repeat(np.cumsum(size) - size, windows) + inside
        length = np.repeat(np.minimum(size, n), windows)
        item = np.repeat(np.array([i for i, _ in texts], np.int64), windows)
        self._grow(flat, start, length)
        self._link()
        ends = np.unique(np.stack([self._end, item]), axis=1)
        self.end_node, self.end_item = ends[0].astype(np.int32), ends[1].astype(np.int32)

    def _grow(self, flat: np.ndarray, start: np.ndarray, length: np.ndarray) -> None:
        node, total, level = np.zeros(len(start), np.int64), 1, [0, 1]
        word, parent = [np.zeros(1, np.int32)], [np.zeros(1, np.int64)]
        for depth in range(self.n):
            on = np.flatnonzero(length > depth)
            if not len(on):
                break
            key, back = np.unique((node[on] << np.int64(32)) | flat[start[on] + depth], return_inverse=True)
            node[on] = total + back
            parent.append(key >> np.int64(32))
            word.append((key & np.int64(0xFFFFFFFF)).astype(np.int32))
            total += len(key)
            level.append(total)
        self.word, self._parent, self._level, self._end = np.concatenate(word), np.concatenate(parent), level, node
        # levels lie one after the other, each in order of its parents
        self.first = (1 + np.searchsorted(self._parent[1:], np.arange(total + 1))).astype(np.int32)
        self.root = np.zeros(len(self.words) + 1, np.int32)
        if len(level) > 2:
            self.root[self.word[1 : level[2]]] = np.arange(1, level[2])

    def _link(self) -> None:
        self.fail, self.told = np.zeros(len(self.word), np.int32), np.zeros(len(self.word), np.int32)
        self.told[self._end] = self._end
        for low, high in zip(self._level[1:], self._level[2:], strict=False):
            if low > 1:
                self.fail[low:high] = self.step(self.fail[self._parent[low:high]], self.word[low:high])
            own = self.told[low:high]
            self.told[low:high] = np.where(own > 0, own, self.told[self.fail[low:high]])
        del self._parent, self._level

    def child(self, node: np.ndarray, word: np.ndarray) -> np.ndarray:
        """The child of a node below the root by a word; 0 if there is none."""
        low, high = self.first[node], self.first[node + 1]
        many = np.flatnonzero(high - low > 1)
        while len(many):
            middle = (low[many] + high[many]) // 2
            right = self.word[middle] <= word[many]
            low[many] = np.where(right, middle, low[many])
            high[many] = np.where(right, high[many], middle)
            many = many[high[many] - low[many] > 1]
        at = np.minimum(low, len(self.word) - 1)
        return np.where((low < high) & (self.word[at] == word), at, 0)

    def step(self, node: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Where each node goes by a word (0: a word of no item)."""
        out = self.root[word]
        open_ = np.flatnonzero((node > 0) & (word > 0))
        node = node[open_]
        while len(open_):
            to = self.child(node, word[open_])
            found = to > 0
            out[open_[found]] = to[found]
            node = self.fail[node[~found]]
            open_ = open_[~found][node > 0]
            node = node[node > 0]
        return out

    def occurrences(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position of the last word, node) of every window in the words (0 keeps texts apart)."""
        # a state hangs on the last n words only: a lane starts n - 1 words early
        early = self.n - 1
        lanes = max(1, -(-len(words) // LANE))
        padded = np.zeros(early + lanes * LANE, np.int32)
        padded[early : early + len(words)] = words
        base = np.arange(lanes) * LANE
        node = np.zeros(lanes, np.int32)
        at, ends = [], []
        for t in range(early + LANE):
            node = self.step(node, padded[base + t])
            if t >= early:
                own = np.flatnonzero(self.told[node])
                end = self.told[node[own]]
                while len(own):
                    at.append(base[own] + t - early)
                    ends.append(end)
                    end = self.told[self.fail[end]]
                    own, end = own[end > 0], end[end > 0]
        return (np.concatenate(at), np.concatenate(ends)) if at else (np.zeros(0, np.int64), np.zeros(0, np.int32))

    def depths(self) -> np.ndarray:
        """Words of each node's pattern."""
        if not hasattr(self, "_depth"):
            self._depth, low, high, depth = np.zeros(len(self.word), np.int32), 0, 1, 0
            while high < len(self.word):
                low, high, depth = high, int(self.first[high]), depth + 1
                self._depth[low:high] = depth
        return self._depth

    def hits(self, texts: list[list[bytes]]) -> list[tuple[np.ndarray | None, set[str]]]:
        """For each text whether each of its words is hit (None if none is), and the items hit."""
        out: list[tuple[np.ndarray | None, set[str]]] = [(None, set()) for _ in texts]
        if len(self.word) == 1:
            return out
        number = self.words.get
        size = np.array([len(t) + 1 for t in texts], np.int64)
        listed: list[int] = []
        for t in texts:
            listed += [number(w, 0) for w in t]
            listed.append(0)
        words = np.array(listed, np.int32)
        at, node = self.occurrences(words)
        if not len(at):
            return out
        start = np.cumsum(size) - size
        depth = np.zeros(len(words) + 1, np.int32)
        np.add.at(depth, at + 1 - self.depths()[node], 1)
        np.add.at(depth, at + 1, -1)
        hit = np.cumsum(depth[:-1]) > 0
        text = np.searchsorted(start, at, side="right") - 1
        both = np.unique((text << np.int64(32)) | node)
        text, node = both >> np.int64(32), both & np.int64(0xFFFFFFFF)
        low, high = np.searchsorted(self.end_node, node), np.searchsorted(self.end_node, node, side="right")
        for i, a, b in zip(text.tolist(), low.tolist(), high.tolist(), strict=True):
            if out[i][0] is None:
                out[i] = (hit[start[i] : start[i] + size[i] - 1], set())
            out[i][1].update(self.ids[k] for k in self.end_item[a:b].tolist() if k >= 0)
        return out


def described(text: bytes | None, n_words: int, hit: np.ndarray | None, items: set[str]) -> Found:
    """Words, hit word indexes, items hit and original byte spans of a text."""
    if hit is None:
        return n_words, [], [], []
    # offsets of the words in the original bytes
    solid = np.frombuffer(text.translate(_WORD), np.uint8) != 32
    edge = np.diff(np.concatenate([[False], solid, [False]]).astype(np.int8))
    first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    runs = np.diff(np.concatenate([[False], hit, [False]]).astype(np.int8))
    spans = [
        {"start": int(first[a]), "end": int(last[b - 1])}
        for a, b in zip(np.flatnonzero(runs == 1), np.flatnonzero(runs == -1), strict=True)
    ]
    return n_words, np.flatnonzero(hit).tolist(), sorted(items), spans


def scan_texts(texts: list[bytes | None], machines: Iterable[Automaton]) -> list[Found]:
    """What described() tells of each text, the hits of all automata united."""
    sizes = [0] * len(texts)
    hits: list[np.ndarray | None] = [None] * len(texts)
    items: list[set[str]] = [set() for _ in texts]
    for machine in machines:
        first = 0
        while first < len(texts):
            end, held, part = first, 0, []
            while end < len(texts) and (end == first or held + len(texts[end] or b"") <= PIECE_BYTES):
                held += len(texts[end] or b"")
                part.append(words_of(texts[end]))
                end += 1
            for i, (words, (hit, ids)) in enumerate(zip(part, machine.hits(part), strict=True), first):
                sizes[i] = len(words)
                if hit is not None:
                    hits[i] = hit if hits[i] is None else hits[i] | hit
                    items[i] |= ids
            first = end
    return [described(*x) for x in zip(texts, sizes, hits, items, strict=True)]


def _held(batches: Iterable[pa.RecordBatch]) -> Iterable[list[pa.RecordBatch]]:
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= HELD_BYTES:
            yield held
            held, size = [], 0
    if held:
        yield held


def _scanner(benchmark: DataFrame, n: int, max_bytes: int):
    """batches -> each batch with what scan_texts() tells of its rows."""
    context = benchmark.sparkSession.sparkContext
    groups = _groups(benchmark, max_bytes)
    if len(groups) == 1:
        shared = context.broadcast(vars(Automaton(groups[0], n)))  # plain arrays: workers need not have the package

        def run(batches):
            machine = Automaton.__new__(Automaton)
            vars(machine).update(shared.value)
            for batch in batches:
                parts = (batch.slice(at, SLICE_ROWS) for at in range(0, batch.num_rows, SLICE_ROWS))
                yield batch, [found for part in parts for found in scan_texts(byte_rows(part), [machine])]

        return run
    parts = context.broadcast(groups)

    def run_parts(batches):
        for held in _held(batches):
            found = scan_texts([text for batch in held for text in byte_rows(batch)], (Automaton(group, n) for group in parts.value))
            at = 0
            for batch in held:
                yield batch, found[at : at + batch.num_rows]
                at += batch.num_rows

    return run_parts


def _groups(benchmark: DataFrame, max_bytes: int) -> list[Items]:
    """The items, dealt by hash into groups of about max_bytes."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text")
    volume = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-volume // max_bytes))
    groups = []
    for k in range(parts):
        own = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == k)
        rows = own.select("item_id", F.col("text").cast("binary").alias("text")).collect()
        groups.append([(r[0], None if r[1] is None else bytes(r[1])) for r in rows])
    return groups


def scan(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW, max_bytes: int = AUTOMATON_BYTES) -> DataFrame:
    """doc_id, n_words, hit_words, items and original byte spans of each row.

    An automaton holds about ``max_bytes`` of item text: a larger benchmark is
    dealt by item hash into parts whose automata are built in turn over the
    rows at hand, and each row's hits are united in place.
    """
    scanned = _scanner(benchmark, n, max_bytes)

    def run(batches):
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for batch, rows in scanned(batches):
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()),
                    pa.array([r[0] for r in rows], pa.int64()),
                    pa.array([r[1] for r in rows], pa.list_(pa.int32())),
                    pa.array([r[2] for r in rows], pa.list_(pa.string())),
                    pa.array([r[3] for r in rows], span),
                ],
                names=["doc_id", "n_words", "hit_words", "items", "spans"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, _SCHEMA)


def verdicts(found: DataFrame) -> DataFrame:
    """The contract's columns from what scan() returns."""
    return found.select(
        "doc_id",
        "n_words",
        F.size("hit_words").cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
    ).withColumn("contaminated", F.expr("n_hit > 0 and 20 * n_hit >= n_words"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW, max_bytes: int = AUTOMATON_BYTES) -> DataFrame:
    """docs without the rows of which a twentieth of the words is hit."""
    scanned = _scanner(benchmark, n, max_bytes)

    def clean(batches):
        for batch, rows in scanned(batches):
            yield batch.filter(pa.array([not (hit and 20 * len(hit) >= words) for words, hit, _, _ in rows], pa.bool_()))

    return docs.mapInArrow(clean, docs.schema)
