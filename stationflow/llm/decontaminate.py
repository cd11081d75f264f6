"""Benchmark leaks: CGK walks, bit-sampling LSH over item-sized windows, exact edit verification."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationflow.llm.common import ids_and_text, of_texts, staged, stretches

SIMILARITY = 0.8
#: Words that stay in a row whatever an item's edits are, at most; text without such a run near it is not embedded.
RUN_WORDS = 3
#: Walks of a window, and symbols of a walk that make one key.
REPEATS, SAMPLED = 32, 2
#: Symbols are sampled from this share of a walk's steps, before most walks reach the window's end.
STEPS = 0.85
#: Items of more words are embedded in pieces of at least half as many, and compared whole.
PIECE_WORDS = 128
#: Window sizes grow by at least this factor; an item is embedded up to the next smaller one.
SIZE_STEP = 1.1
WORDS = re.compile(r"[^\W_]+")
#: Scripts written without blanks, whose signs count as words.
UNSPACED = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
TOKENS = re.compile(f"[^\\W_{UNSPACED}]+|[{UNSPACED}]")
#: Words of documents looked up together, windows embedded together, and cells of edit tables filled together.
WORDS_AT_ONCE, WINDOWS_AT_ONCE, CELLS_AT_ONCE = 1 << 20, 1024, 1 << 17
#: Item text that one pass may broadcast; more items are taken in several passes.
ITEM_CHARS = 16 << 20
SCHEMA = "doc_id long, item_id long, word_start long, edits int, similarity double"
ARROW = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("word_start", pa.int64()), ("edits", pa.int32()), ("similarity", pa.float64())])
#: Edits and start of an alignment in one number, edits first.
EDIT = 1 << 32


def words_of(text: str | None) -> list[str]:
    """Lower-cased runs of letters and digits."""
    return WORDS.findall(text.lower()) if text else []


def tokens_of(text: str | None) -> list[str]:
    """Lower-cased runs of letters and digits; in scripts without blanks, single signs."""
    return TOKENS.findall(text.lower()) if text else []


def window_sizes(most: int) -> list[int]:
    """The sizes that windows may have, up to ``most``."""
    sizes = [1]
    while sizes[-1] < most:
        sizes.append(max(sizes[-1] + 1, int(sizes[-1] * SIZE_STEP)))
    return sizes


def _in(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Which of ``wanted`` are among the sorted ``keys``."""
    return keys[np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)] == wanted if len(keys) else np.zeros(len(wanted), bool)


class ItemIndex:
    """Benchmark items as word numbers, the keys of their walks by window size, and the short runs that gate the embedding."""

    def __init__(self, items: list[tuple[int | None, str | None]], similarity: float = SIMILARITY, seed: int = 0) -> None:
        texts = [(i, w) for i, w in ((i, tokens_of(t)) for i, t in items) if w]
        self.vocab: dict[str, int] = {}
        for _, words in texts:
            for w in words:
                self.vocab.setdefault(w, len(self.vocab) + 1)
        self.ids = [i for i, _ in texts]
        self.items = [np.array([self.vocab[w] for w in words], np.int64) for _, words in texts]
        self.size = np.array([len(x) for x in self.items], np.int64)
        self.budget = self._edits(self.size, similarity)
        pieces = [(k, int(o), int(n)) for k, x in enumerate(self.items) for o, n in self._cut(len(x))]
        self.piece_item, self.piece_at, piece_size = (np.array([p[c] for p in pieces], np.int64) for c in range(3))
        spare = self._edits(piece_size, similarity)
        self.reach = int((piece_size + spare).max(initial=0))
        # with so few edits, a run of this many words stays as it is (of a long item: in some piece), and as an edit
        # spoils no more runs than it has words, so many runs stay within the stretch
        run = np.minimum(RUN_WORDS, -(-(piece_size - spare) // (spare + 1)))
        need = np.maximum(1, piece_size - run + 1 - run * spare)
        self.gates = sorted({(int(g), int(n + e - g + 1), int(c)) for g, n, e, c in zip(run, piece_size, spare, need, strict=True)})
        self.base = len(self.vocab) + 1
        self.runs: dict[int, np.ndarray] = {}
        for g in np.unique(run).tolist():
            parts = [self._grams(self.items[k][o : o + n], g) for (k, o, n), r in zip(pieces, run, strict=True) if r == g]
            self.runs[g] = np.unique(np.concatenate(parts))
        rng = np.random.default_rng(seed)
        sizes = np.array(window_sizes(int(piece_size.max(initial=1))), np.int64)
        rounded = sizes[np.searchsorted(sizes, piece_size, "right") - 1] if len(piece_size) else piece_size
        self.mix = rng.integers(1 << 64, size=(2 * int(rounded.max(initial=1)), REPEATS), dtype=np.uint64)
        self.at = rng.random((REPEATS, SAMPLED)) * STEPS
        self.keys: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        words = np.concatenate([x for k, o, n in pieces for x in (self.items[k][o : o + n], np.zeros(1, np.int64))]) if pieces else np.zeros(1, np.int64)
        starts = np.cumsum(piece_size + 1) - piece_size - 1
        for n in np.unique(rounded).tolist():
            which = np.flatnonzero(rounded == n)
            keys, own = [], []
            for c in range(0, len(which), WINDOWS_AT_ONCE):
                mine = which[c : c + WINDOWS_AT_ONCE]
                walks = self.walks(words, starts[mine], starts[mine] + piece_size[mine], n)
                found, whole = self.walk_keys(words, walks, starts[mine], n)
                keys.append(found[whole])
                own.append(np.broadcast_to(mine[None, :], found.shape)[whole])
            key, piece = np.concatenate(keys), np.concatenate(own)
            order = np.argsort(key, kind="stable")
            self.keys[n] = key[order], piece[order]

    @staticmethod
    def _edits(size: np.ndarray, similarity: float) -> np.ndarray:
        return ((1 - similarity) * size + 1e-9).astype(np.int64)

    @staticmethod
    def _cut(n: int) -> list[tuple[int, int]]:
        """Starts and sizes of an item's pieces: if it is within its budget, some piece is within its own."""
        count = -(-n // PIECE_WORDS)
        cuts = np.linspace(0, n, count + 1).astype(int)
        return list(zip(cuts[:-1], np.diff(cuts), strict=True))

    def _grams(self, words: np.ndarray, g: int) -> np.ndarray:
        """A number for each run of ``g`` words; 0 where one is in no item."""
        n = max(0, len(words) - g + 1)
        code, known = np.zeros(n, np.int64), np.ones(n, bool)
        for k in range(g):
            code = code * self.base + words[k : k + n]
            known &= words[k : k + n] > 0
        return np.where(known, code, 0)

    def walks(self, words: np.ndarray, starts: np.ndarray, ends: np.ndarray, size: int) -> np.ndarray:
        """Where the CGK walks from ``starts`` stand at each of 2 x ``size`` steps: steps x REPEATS x starts.

        At each step a walk writes the word it stands on and moves on if a random bit of the
        step and the word says so; ``ends`` are the places after the last words, which hold 0.
        """
        coded = (words + 2).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        place = np.broadcast_to(starts, (REPEATS, len(starts))).astype(np.int32)
        steps = int(np.ceil(2 * size * STEPS))
        out = np.empty((steps, REPEATS, len(starts)), np.int32)
        for t in range(steps):
            out[t] = place
            if t + 1 < steps:
                bit = ((coded[place] ^ self.mix[t][:, None]) * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(63)
                place = np.minimum(place + bit.astype(np.int32), ends.astype(np.int32))
        return out

    def walk_keys(self, words: np.ndarray, walks: np.ndarray, starts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """The key of each walk over a window of ``size`` words, and whether all its symbols are known words inside it."""
        when = (self.at * 2 * size).astype(np.int64)
        line = np.arange(REPEATS)
        key = np.broadcast_to(line[:, None].astype(np.uint64), walks.shape[1:]) + np.uint64(1)
        whole = np.ones(walks.shape[1:], bool)
        for j in range(SAMPLED):
            place = walks[when[:, j], line]
            sign = words[place]
            whole &= (sign > 0) & (place - starts < size)
            key = (key ^ sign.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            key ^= key >> np.uint64(29)
        return key, whole

    def edits(self, words: np.ndarray, item: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Fewest word edits that turn each item into some stretch of ``words[low:high]``, and the first start of such a stretch."""
        edits, start = np.zeros(len(item), np.int64), np.zeros(len(item), np.int64)
        order = np.lexsort((high - low, self.size[item]))
        at = 0
        while at < len(order):
            end, width = at + 1, int((high - low)[order[at]])
            while end < len(order):
                wider = max(width, int((high - low)[order[end]]))
                if (end + 1 - at) * wider > CELLS_AT_ONCE:
                    break
                end, width = end + 1, wider
            mine = order[at:end]
            at = end
            n = self.size[item[mine]]
            rows = np.zeros((len(mine), int(n.max())), np.int64)
            for k, i in enumerate(item[mine]):
                rows[k, : n[k]] = self.items[i]
            place = low[mine, None] + np.arange(width)
            spans = np.where(place < high[mine, None], words[np.minimum(place, len(words) - 1)], 0)
            slope = np.arange(width + 1) * EDIT
            cost = np.broadcast_to(np.arange(width + 1), (len(mine), width + 1)).copy()
            for i in range(rows.shape[1]):
                step = np.empty_like(cost)
                step[:, 0] = (i + 1) * EDIT
                step[:, 1:] = np.minimum(cost[:, :-1] + (spans != rows[:, i, None]) * EDIT, cost[:, 1:] + EDIT)
                cost = np.minimum.accumulate(step - slope, 1) + slope
                done = n == i + 1
                if done.any():
                    best = cost[done].min(1)
                    edits[mine[done]], start[mine[done]] = best // EDIT, low[mine[done]] + best % EDIT
        return edits, start

    def _open(self, words: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Places where, by the runs of words that follow, a stretch within some item's budget may start."""
        upto, near = {}, np.zeros(len(words) + 1, np.int64)
        for g, keys in self.runs.items():
            spots = np.flatnonzero(_in(keys, self._grams(words, g)))
            held = np.zeros(len(words) + 1, np.int64)
            held[spots + 1] = 1
            upto[g] = np.cumsum(held)
            np.add.at(near, np.maximum(first[np.searchsorted(first, spots, "right") - 1], spots - self.reach), 1)
            np.add.at(near, spots + 1, -1)
        starts = np.flatnonzero(np.cumsum(near)[:-1] > 0)
        ok = np.zeros(len(starts), bool)
        for g, width, need in self.gates:  # one for each size of item
            ok |= upto[g][np.minimum(starts + width, len(words))] - upto[g][starts] >= need
        return starts[ok]

    def propose(self, words: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Windows (as places of ``starts``) and pieces that share a key of some walk."""
        found_at, found = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        most = max(self.keys, default=0)
        for c in range(0, len(starts), WINDOWS_AT_ONCE):
            own, stop = starts[c : c + WINDOWS_AT_ONCE], ends[c : c + WINDOWS_AT_ONCE]
            walks = self.walks(words, own, stop, most)
            for n, (keys, piece) in self.keys.items():
                key, whole = self.walk_keys(words, walks, own, n)
                hit = np.flatnonzero(whole.ravel())
                key = key.ravel()[hit]
                lo = np.searchsorted(keys, key)
                same = np.flatnonzero(keys[np.minimum(lo, len(keys) - 1)] == key) if len(keys) else lo[:0]
                if not len(same):
                    continue
                lo, hi = lo[same], np.searchsorted(keys, key[same], "right")
                count = hi - lo
                pick = np.repeat(lo, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                pair = np.unique(np.repeat(hit[same] % len(own) + c, count) * len(self.piece_item) + piece[pick])
                found_at.append(pair // len(self.piece_item))
                found.append(pair % len(self.piece_item))
        return np.concatenate(found_at), np.concatenate(found)

    def find(self, texts: list[str | None]) -> Iterator[tuple[int, int, int, int]]:
        """``row, item number, word start, edits`` of each text and item within the item's budget, at its best stretch."""
        if not len(self.items):
            return
        rows: list[int] = []
        parts: list[np.ndarray] = []
        held = 0
        for row, text in enumerate(texts):
            found = tokens_of(text)
            rows.append(row)
            parts.append(np.fromiter(map(self.vocab.get, found, repeat(0)), np.int64, len(found)))
            held += len(found)
            if held >= WORDS_AT_ONCE:
                yield from self._find(rows, parts)
                rows, parts, held = [], [], 0
        yield from self._find(rows, parts)

    def _find(self, rows: list[int], parts: list[np.ndarray]) -> Iterator[tuple[int, int, int, int]]:
        gap = np.zeros(RUN_WORDS, np.int64)  # no run crosses documents
        words = np.concatenate([x for p in parts for x in (p, gap)]) if parts else gap
        first = np.cumsum([0, *(len(p) + RUN_WORDS for p in parts)])
        starts = self._open(words, first)
        if not len(starts):
            return
        doc = np.searchsorted(first, starts, "right") - 1
        at, piece = self.propose(words, starts, first[doc + 1] - RUN_WORDS)
        item, own = self.piece_item[piece], doc[at]
        low = starts[at] - self.piece_at[piece] - self.budget[item]
        high = low + self.size[item] + 3 * self.budget[item]
        low, high = np.maximum(low, first[own]), np.minimum(high, first[own + 1] - RUN_WORDS)
        ok = high > low
        item, own, low, high = item[ok], own[ok], low[ok], high[ok]
        if not len(item):
            return
        order = np.lexsort((low, item, own))
        item, own, low, high = item[order], own[order], low[order], high[order]
        # spans of one document and item that overlap are compared as one
        group = np.concatenate([[0], np.cumsum((own[1:] != own[:-1]) | (item[1:] != item[:-1]))])
        wide = np.int64(len(words) + 1)
        ahead = np.maximum.accumulate(high + group * wide)
        new = np.flatnonzero(np.concatenate([[True], (low + group * wide)[1:] >= ahead[:-1]]))
        high = np.maximum.reduceat(high, new)
        item, own, low = item[new], own[new], low[new]
        cost, start = self.edits(words, item, low, high)
        good = np.flatnonzero(cost <= self.budget[item])
        good = good[np.lexsort((start[good], cost[good], item[good], own[good]))]
        pair = own[good] * len(self.items) + item[good]
        for k in good[np.concatenate([[True], pair[1:] != pair[:-1]])] if len(good) else good:
            yield rows[own[k]], int(item[k]), int(start[k] - first[own[k]]), int(cost[k])


def item_indexes(items: DataFrame, id_col: str = "item_id", text_col: str = "text", similarity: float = SIMILARITY, item_chars: int = ITEM_CHARS) -> Iterator[tuple[ItemIndex, bool]]:
    """Indexes that each hold about ``item_chars`` of item text, one at a time, and whether there are several."""
    items = items.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).cast("string").alias("text")).distinct()
    chars = items.agg(F.sum(F.length("text")).alias("n")).first()["n"] or 0
    blocks = -(-2 * chars // item_chars) if chars > item_chars else 1
    cut = items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)))
    for k in range(blocks):
        rows = cut.where(F.col("block") == k).orderBy("item_id", "text").collect()  # bounded by item_chars
        yield ItemIndex([(r["item_id"], r["text"]) for r in rows], similarity), blocks > 1


def find_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY, item_chars: int = ITEM_CHARS) -> DataFrame:
    """``doc_id, item_id, word_start, edits, similarity`` of documents that hold a benchmark item.

    A document holds an item if some stretch of its words can be turned into the item's
    words with at most (1 - similarity) of them edited; of its stretches with the fewest edits, the
    one that starts first is returned. Scripts without blanks count sign by sign. Items
    of any length take part; those under 5 words have no edit to spare at 0.8.

    Windows of the items' sizes are embedded by CGK walks; those that share the sampled symbols of
    some walk with an item are compared exactly. Where too few runs of three words of any items follow,
    no stretch can be within an item's budget, as an edit spoils three runs at most; windows
    there aren't embedded, which loses nothing.

    Null and empty texts and items hold nothing; rows and items without an id are taken like
    others, with a null id; repeated rows are reported once each, and so are items whose ids share
    a text; other columns are left out; empty tables give an empty result. Whole texts are searched.
    """
    found = None
    for index, several in item_indexes(items, text_col="text", similarity=similarity, item_chars=item_chars):

        def run(batches: Iterator[pa.RecordBatch], index: ItemIndex = index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at, n in stretches(batch.column(1)):
                    ids, texts = (c.slice(at, n).to_pylist() for c in batch.columns)
                    hits = [(ids[r], index.ids[i], s, e, 1 - e / int(index.size[i])) for r, i, s, e in index.find(texts)]
                    columns = list(zip(*hits, strict=True)) or [[]] * len(ARROW)
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, ARROW, strict=True)], schema=ARROW)

        part = ids_and_text(docs, id_col, text_col).mapInArrow(run, SCHEMA)
        part = staged(part) if several else part  # so that the driver holds one index at a time
        found = part if found is None else found.unionByName(part)
    return found


def holds_item(index: ItemIndex) -> Callable[[Column], Column]:
    """Whether a text holds an item of ``index``, as a column function."""

    def holds(texts: list) -> list:
        hit = {r for r, *_ in index.find(texts)}
        return [k in hit for k in range(len(texts))]

    return of_texts(holds, "boolean", pa.bool_())


def drop_leaks(docs: DataFrame, items: DataFrame, text_col: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs``, with all columns, that hold no benchmark item; null and empty texts stay, repeated rows stay or go alike."""
    for index, several in item_indexes(items, similarity=similarity):
        docs = docs.where(~holds_item(index)(F.col(text_col).cast("string")))
        docs = staged(docs) if several else docs
    return docs
