"""Repeated byte strings across documents, by suffix arrays over content-routed shards."""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationflow.llm.suffix_arrays import permuted_prefixes, suffix_array

LENGTH = 50
#: Bytes that are hashed together; the least hash of a string's grams is the string's route. Shorter grams stand in
#: more texts by chance, the more text there is; longer ones make more routes.
GRAM = 20
#: Bytes of a route; routes that are equal by chance only cost time.
ROUTE_BYTES = 6
MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93, 0x165667B19E3779F9], np.uint64)
#: Text bytes of a tile of documents, and text bytes for each bucket of routes and each shard.
TILE_BYTES, BUCKET_BYTES, SHARD_BYTES = 8 << 20, 32 << 20, 16 << 20
#: Bytes of blocks in one suffix array; a shard makes several, each of whole routes.
SORT_BYTES = 2 << 20
#: A route whose distinct blocks have more bytes than this is dealt out string by string.
HOT_BYTES = 1 << 20
#: Rows of one text come to one tile up to this part of it.
TEXT_SHARE = 8
CHUNK = 1 << 20
#: Blocks are hashed and compared eight bytes at a time up to this size, and whole beyond.
WORD_BY_WORD = 256
#: Tiles, buckets and shards have a task each up to this number of tasks; then a task takes several, one at a time.
PARTS = 1 << 15
#: Equal rows that fill a tile, and more than one in so many of all bytes, are counted and dealt by number.
HEAVY_SHARE = 1_000_000
#: Stands for no document; whether one is there is told apart by a flag, so it may be an id too.
NEVER = np.iinfo(np.int64).max


def _words(data: bytes) -> np.ndarray:
    """The eight bytes from every place on, as far as there are eight."""
    return np.ndarray((max(len(data) - 7, 0),), "<u8", data, strides=(1,))


def strings_routes(data: bytes, length: int) -> np.ndarray:
    """The least hash among the grams of each string of ``length`` bytes of ``data``, cut to ``ROUTE_BYTES`` bytes."""
    gram = min(GRAM, length)
    words, n = _words(data), len(data) - gram + 1
    h = words[:n] * MIX[0]
    for k in range(8, gram, 8):
        k = min(k, gram - 8)
        h += words[k : k + n] * MIX[-(-k // 8)]
    h ^= h >> np.uint64(29)
    h *= MIX[3]
    h = (h ^ (h >> np.uint64(32))) >> np.uint64(64 - 8 * ROUTE_BYTES)
    want, width = length - gram + 1, 1
    while 2 * width <= want:
        h, width = np.minimum(h[:-width], h[width:]), 2 * width
    return np.minimum(h[: len(h) - (want - width)], h[want - width :])


def _packed(routes: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(routes.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :ROUTE_BYTES])


def _unpacked(packed: bytes) -> np.ndarray:
    out = np.zeros((len(packed) // ROUTE_BYTES, 8), np.uint8)
    out[:, :ROUTE_BYTES] = np.frombuffer(packed, np.uint8).reshape(-1, ROUTE_BYTES)
    return out.view("<u8")[:, 0]


def route_runs(texts: list[bytes], length: int) -> list[np.ndarray]:
    """Runs of strings with one route: document number, first and last string start, route, and a mark of the run's block.

    The mark comes from the block's length, its first and its last bytes.
    """
    parts: list[list[np.ndarray]] = [[np.zeros(0, np.int64)] * 3 + [np.zeros(0, np.uint64)] * 2]
    at = 0
    while at < len(texts):
        size, end = 0, at
        while end < len(texts) and (size == 0 or size + len(texts[end]) <= CHUNK):
            size += len(texts[end])
            end += 1
        lens = np.array([len(t) for t in texts[at:end]])
        if size >= length:
            starts = np.cumsum(lens) - lens
            data = b"".join(texts[at:end])
            route = strings_routes(data, length)
            new = np.empty(len(route), bool)
            new[0] = True
            np.not_equal(route[1:], route[:-1], out=new[1:])
            for edge in (starts, np.maximum(starts + lens - length + 1, starts)):  # a text's first string, and the first that its end cuts off
                new[edge[edge < len(new)]] = True
            first = np.flatnonzero(new)
            last = np.append(first[1:], len(route)) - 1
            doc = np.searchsorted(starts, first, "right") - 1
            ok = first - starts[doc] <= lens[doc] - length  # strings within one document
            first, last, doc = first[ok], last[ok], doc[ok]
            words = _words(data)
            mark = words[first] * MIX[0] + words[last + length - 8] * MIX[1] + (last - first).astype(np.uint64)
            parts.append([doc + at, first - starts[doc], last - starts[doc], route[first], mark])
        at = end
    return [np.concatenate(column) for column in zip(*parts, strict=True)]


def _mixed(routes: np.ndarray, parts: int) -> np.ndarray:
    """Which of ``parts`` each route belongs to; least hashes are small, so they are mixed again."""
    return ((routes * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(33)).astype(np.int64) % parts


class Tile:
    """A tile's different texts, each under the first id that has it, in order of id, those without an id last; ``owner`` numbers the ids, none being one.

    ``of`` is each row's text. A row whose text a smaller id has too (``again``) has no string left; other rows of a text
    are as its first one.
    """

    def __init__(self, rows: pd.DataFrame) -> None:
        ids, none = rows["doc_id"].to_numpy(np.int64), rows["none"].to_numpy(bool)
        order = np.lexsort((ids, none))
        self.row_ids, self.row_none, self.copies = ids[order], none[order], rows["copies"].to_numpy(np.int64)[order]
        owner = np.cumsum(np.concatenate([[False], (self.row_ids[1:] != self.row_ids[:-1]) | (self.row_none[1:] != self.row_none[:-1])]))
        texts, at = rows["data"].tolist(), {}
        self.of = np.array([at.setdefault(bytes(texts[k]), len(at)) for k in order.tolist()], np.int64)
        self.texts = list(at)
        first = np.unique(self.of, return_index=True)[1]
        self.ids, self.none, self.owner = self.row_ids[first], self.row_none[first], owner[first]
        self.again = owner != self.owner[self.of]


def _tile_routes(number: int, tile: Tile, buckets: int, length: int) -> pd.DataFrame:
    """A tile's distinct routes by bucket; each route's mark: the top bit if two of the tile's documents have it, below it the size of its distinct blocks in quarter bits."""
    doc, first, last, route, mark = route_runs(tile.texts, length)
    order = np.lexsort((mark, route))
    route, mark, own, size = route[order], mark[order], tile.owner[doc[order]], (last - first + length)[order]
    new = np.concatenate([[True], route[1:] != route[:-1]]) if len(route) else np.zeros(0, bool)
    head = np.flatnonzero(new)
    if len(head):
        size[1:][~new[1:] & (mark[1:] == mark[:-1])] = 0  # a block counts once
        weight = np.ceil(4 * np.log2(np.add.reduceat(size, head))).astype(np.uint8)
        twice = np.minimum.reduceat(own, head) != np.maximum.reduceat(own, head)
    else:
        weight, twice = np.zeros(0, np.uint8), np.zeros(0, bool)
    route, marks = route[head], weight | (twice.astype(np.uint8) << 7)
    bucket = _mixed(route, buckets)
    order = np.argsort(bucket, kind="stable")
    bucket, route, marks = bucket[order], route[order], marks[order]
    cuts, route = np.searchsorted(bucket, np.arange(buckets + 1)), _packed(route)
    used = np.flatnonzero(np.diff(cuts))
    return pd.DataFrame({"bucket": used.astype("int32"), "tile": np.full(len(used), number, "int32"), "routes": [route[cuts[k] : cuts[k + 1]].tobytes() for k in used], "marks": [marks[cuts[k] : cuts[k + 1]].tobytes() for k in used]})


def _shared_routes(rows: pd.DataFrame, hot_bytes: int) -> pd.DataFrame:
    """Of a bucket's routes, those of two documents or more, for each tile that has them, and which of them are hot."""
    parts = [_unpacked(bytes(r)) for r in rows["routes"]]
    route = np.concatenate(parts)
    marks = np.concatenate([np.frombuffer(bytes(b), np.uint8) for b in rows["marks"]])
    order = np.argsort(route, kind="stable")
    ranked = route[order]
    first = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
    count = np.diff(first, append=len(ranked))
    shared = (count > 1) | np.logical_or.reduceat(marks[order] > 127, first)
    heavy = np.add.reduceat(np.exp2((marks[order] & 127) / 4), first) > hot_bytes
    keep, hot = np.zeros(len(route), bool), np.zeros(len(route), bool)
    keep[order], hot[order] = np.repeat(shared, count), np.repeat(heavy, count)
    cuts = np.cumsum([0, *(len(p) for p in parts)])
    mine = [keep[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    return pd.DataFrame({"tile": rows["tile"].astype("int32"), "shared": [_packed(p[k]).tobytes() for p, k in zip(parts, mine, strict=True)], "hot": [np.packbits(hot[a:b][k]).tobytes() for a, b, k in zip(cuts[:-1], cuts[1:], mine, strict=True)]})


def _shared_runs(texts: list[bytes], shared: np.ndarray, hot: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """The runs whose route is shared; where it is hot, each string is a run, routed by a hash of all its bytes."""
    doc, first, last, route, _ = route_runs(texts, length)
    if not len(shared):
        return doc[:0], first[:0], last[:0], route[:0]
    order = np.argsort(shared)
    shared, hot = shared[order], hot[order]
    maybe = np.zeros(1 << 20, bool)
    maybe[_mixed(shared, len(maybe))] = True
    keep = np.flatnonzero(maybe[_mixed(route, len(maybe))])
    at = np.minimum(np.searchsorted(shared, route[keep]), len(shared) - 1)
    found = shared[at] == route[keep]
    keep, at = keep[found], at[found]
    doc, first, last, route, hot = doc[keep], first[keep], last[keep], route[keep], hot[at]
    if not hot.any():
        return doc, first, last, route
    count = np.where(hot, last - first + 1, 1)
    place = np.repeat(first, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    hot, doc, last, route = (np.repeat(x, count) for x in (hot, doc, last, route))
    digest = xxhash.xxh3_64_intdigest
    route[hot] = np.fromiter((digest(texts[d][a : a + length]) for d, a in zip(doc[hot].tolist(), place[hot].tolist(), strict=True)), np.uint64, int(hot.sum()))
    return doc, place, np.where(hot, place, last), route


def _same_as_before(words: np.ndarray, data: bytes, at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether each block (``size`` bytes of ``data`` from ``at`` on) is the block before it; ``words`` has the eight bytes at every place."""
    same = np.concatenate([[False], size[1:] == size[:-1]]) if len(size) else np.zeros(0, bool)
    left = np.flatnonzero(same)
    long = size[left] > WORD_BY_WORD
    for i in left[long].tolist():
        x, y, n = int(at[i]), int(at[i - 1]), int(size[i])
        same[i] = data[x : x + n] == data[y : y + n]
    left, k = left[~long], 0
    while len(left):  # the last eight bytes overlap those before
        step = np.minimum(k, size[left] - 8)
        equal = words[at[left] + step] == words[at[left - 1] + step]
        same[left[~equal]] = False
        k += 8
        left = left[equal & (size[left] > k)]
    return same


def _digests(words: np.ndarray, data: bytes, at: np.ndarray, size: np.ndarray, mark: np.ndarray) -> np.ndarray:
    """A hash of each block, of which equal ones have the same ``mark``."""
    left, k, mark = np.flatnonzero(size <= WORD_BY_WORD), 0, mark.copy()
    for i in np.flatnonzero(size > WORD_BY_WORD).tolist():
        mark[i] ^= np.uint64(xxhash.xxh3_64_intdigest(data[int(at[i]) : int(at[i] + size[i])]))
    while len(left):
        h = (mark[left] ^ words[at[left] + np.minimum(k, size[left] - 8)]) * MIX[k // 8 % 4]
        mark[left] = h ^ (h >> np.uint64(31))
        k += 8
        left = left[size[left] > k]
    return mark


class TileBlocks:
    """A tile's shared runs, its distinct blocks (the bytes of a run's strings), and each block's place in its shard's list.

    The same documents and shared routes give the same lists, so results come back by
    place and no keys are sent. Blocks are found equal by a hash and then byte by byte; equal ones that
    stood apart would only be sent twice.
    """

    def __init__(self, tile: Tile, shared: tuple[np.ndarray, np.ndarray], shards: int, length: int) -> None:
        self.doc, self.first, last, route = _shared_runs(tile.texts, *shared, length)
        lens = np.array([len(t) for t in tile.texts], np.int64)
        self.data = b"".join(tile.texts)
        at, size = (np.cumsum(lens) - lens)[self.doc] + self.first, last - self.first + length
        words = _words(self.data)
        mark = _digests(words, self.data, at, size, route)
        by = np.argsort(mark, kind="stable")  # documents come in order of id, and stay so
        new = ~_same_as_before(words, self.data, at[by], size[by])
        head = np.flatnonzero(new)
        count = np.diff(head, append=len(by))
        least, most = by[head], by[head + count - 1]
        turn = np.argsort(least)  # blocks as they first appear
        number = np.empty(len(turn), np.int64)
        number[turn] = np.arange(len(turn))
        self.of = np.empty(len(by), np.int64)
        self.of[by] = np.repeat(number, count)
        least, most = least[turn], most[turn]
        self.at, self.size, shard = at[least], size[least], _mixed(route[least], shards)
        least, most = self.doc[least], self.doc[most]
        self.real, self.more = ~tile.none[least], tile.owner[least] != tile.owner[most]
        self.low = np.where(self.real, tile.ids[least], NEVER)
        self.order = np.argsort(shard, kind="stable")  # in a shard's list, ids only grow too
        self.used, self.cuts = np.unique(shard[self.order], return_index=True)
        self.cuts = np.append(self.cuts, len(self.order))


def _blocks(number: int, tile: Tile, shared: tuple[np.ndarray, np.ndarray], shards: int, length: int) -> pd.DataFrame:
    """A tile's blocks by shard: sizes, smallest ids as steps, whether there is one (1) and whether more documents of the tile have them (2), and bytes."""
    b, press = TileBlocks(tile, shared, shards, length), zstandard.ZstdCompressor(level=3)
    order, heads = b.order, b.cuts[:-1]
    low, size = b.low[order], b.size[order].astype("<i4")
    steps = np.diff(low, prepend=0).astype("<i8")
    steps[heads] = low[heads]
    flags = b.real[order].astype(np.uint8) | (b.more[order].astype(np.uint8) << 1)
    texts = [b.data[x : x + n] for x, n in zip(b.at[order].tolist(), size.tolist(), strict=True)]
    cuts = list(zip(heads.tolist(), b.cuts[1:].tolist(), strict=True))
    out = {"shard": b.used.astype("int32"), "tile": np.full(len(cuts), number, "int32")}
    out |= {name: [column[x:y].tobytes() for x, y in cuts] for name, column in (("lens", size), ("low", steps), ("flags", flags))}
    return pd.DataFrame(out | {"text": [press.compress(b"".join(texts[x:y])) for x, y in cuts]})


def _bits(packed: pd.Series, counts: list[int]) -> np.ndarray:
    return np.concatenate([np.unpackbits(np.frombuffer(bytes(x), np.uint8), count=n).astype(bool) for x, n in zip(packed, counts, strict=True)])


def earliest(blocks: list[bytes], low: np.ndarray, real: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """For every string of ``length`` bytes of the blocks, in their order: the smallest ``low`` of a block that has it, and whether such a block is ``real``.

    One suffix array holds all blocks; strings that are equal stand side by side there,
    as their common prefixes tell.
    """
    lens = np.array([len(b) for b in blocks], np.int64)
    text = np.frombuffer(b"\xff".join(blocks) + b"\xff\xfe", np.uint8) + np.uint8(2)  # a gap becomes 1, the end 0
    sa = suffix_array(text, 250, length)
    start = np.cumsum(lens + 1) - lens - 1
    block = np.repeat(np.arange(len(lens)), lens + 1)
    full = np.zeros(len(text), bool)
    full[: len(block)] = np.arange(len(block)) - start[block] <= lens[block] - length
    sa = sa[full[sa]]
    shared = permuted_prefixes(np.concatenate([text, np.zeros(length + 8, np.uint8)]), sa, length)
    first = np.flatnonzero(np.concatenate([[True], shared[sa[1:]] < length]))
    count, own = np.diff(first, append=len(sa)), block[sa]
    least, known = np.empty(len(text), np.int64), np.empty(len(text), bool)
    least[sa] = np.repeat(np.minimum.reduceat(low[own], first), count)
    known[sa] = np.repeat(np.logical_or.reduceat(real[own], first), count)
    return least[: len(block)][full[: len(block)]], known[: len(block)][full[: len(block)]]


def earliest_by_route(blocks: list[bytes], low: np.ndarray, real: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """``earliest`` of distinct blocks whose strings have one route each: only blocks that share their route are sorted, all of a route together.

    Equal strings have one route. So a block alone on its route has no string of another block, and its own ``low`` is the smallest.
    """
    count = np.array([len(b) - length + 1 for b in blocks], np.int64)
    found, known = np.repeat(low, count), np.repeat(real, count)
    route = strings_routes(b"".join(b[:length] for b in blocks), length)[::length]
    by = np.argsort(route, kind="stable")
    first = np.flatnonzero(np.concatenate([[True], np.diff(route[by]) > 0]))
    size = np.diff(first, append=len(by))
    met = size > 1
    by, size = by[np.repeat(met, size)], size[met]
    if not len(by):
        return found, known
    n_bytes = np.add.reduceat(count[by] + length - 1, np.cumsum(size) - size)
    share = (np.cumsum(n_bytes) - n_bytes) // SORT_BYTES
    begin = np.cumsum(count) - count
    for part in np.split(by, np.cumsum(size)[:-1][np.diff(share) > 0]):
        n = count[part]
        strings = np.repeat(begin[part] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        found[strings], known[strings] = earliest([blocks[k] for k in part.tolist()], low[part], real[part], length)
    return found, known


def _shard(rows: pd.DataFrame, length: int) -> pd.DataFrame:
    """For each tile, its blocks' runs of strings by the smallest id that has them, where a larger id has them too."""
    lens = [np.frombuffer(bytes(x), "<i4").astype(np.int64) for x in rows["lens"]]
    low = np.concatenate([np.frombuffer(bytes(x), "<i8").cumsum() for x in rows["low"]])
    flags = np.frombuffer(b"".join(rows["flags"]), np.uint8)
    real, more = (flags & 1).astype(bool), (flags & 2).astype(bool)
    at: dict[bytes, int] = {}
    numbers: list[int] = []
    unpress = zstandard.ZstdDecompressor()
    for text, ns in zip(rows["text"], lens, strict=True):
        text, ends = unpress.decompress(bytes(text)), np.cumsum(ns).tolist()
        numbers += [at.setdefault(text[a:b], len(at)) for a, b in zip([0, *ends[:-1]], ends, strict=True)]  # tiles share blocks
    of = np.array(numbers, np.int64)
    own = np.full(len(at), NEVER, np.int64)
    np.minimum.at(own, of, low)
    owned = np.zeros(len(at), bool)
    np.logical_or.at(owned, of, real)
    blocks = list(at)
    found, known = earliest_by_route(blocks, own, owned, length)
    count = np.array([len(b) - length + 1 for b in blocks], np.int64)
    ends = np.cumsum(count)
    new = np.concatenate([[True], (found[1:] != found[:-1]) | (known[1:] != known[:-1])])
    new[ends - count] = True
    turn = np.flatnonzero(new)
    run_of = np.searchsorted(ends, turn, "right")
    runs = np.searchsorted(run_of, np.arange(len(at) + 1))
    stop = np.append(turn[1:], len(found)) - (ends - count)[run_of]  # where each run ends in its block
    least, known = found[turn], known[turn]
    need = more | np.where(real, np.minimum.reduceat(least, runs[:-1])[of] < low, np.logical_or.reduceat(known, runs[:-1])[of])
    out: dict[str, list] = {"tile": [], "shard": [], "n_runs": [], "stops": [], "least": [], "known": []}
    place = 0
    for tile, ns in zip(rows["tile"], lens, strict=True):
        mine = of[place : place + len(ns)]
        n = np.where(need[place : place + len(ns)], (runs[1:] - runs[:-1])[mine], 0)
        place += len(ns)
        pick = np.repeat(runs[mine], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        if len(pick):
            out["tile"].append(tile)
            out["shard"].append(int(rows["shard"].iloc[0]))
            out["n_runs"].append(n.astype("<i4").tobytes())
            out["stops"].append(stop[pick].astype("<i4").tobytes())
            out["least"].append(least[pick].astype("<i8").tobytes())
            out["known"].append(np.packbits(known[pick]).tobytes())
    return pd.DataFrame(out).astype({"tile": "int32", "shard": "int32"})


def _removed(tile: Tile, shared: tuple[np.ndarray, np.ndarray], found: pd.DataFrame, shards: int, length: int) -> list[list[tuple[int, int]]]:
    """The maximal removed runs of bytes of each text of a tile."""
    spans: list[list[tuple[int, int]]] = [[] for _ in tile.texts]
    if not len(found):
        return spans
    b = TileBlocks(tile, shared, shards, length)
    n_runs, start = np.zeros(len(b.size), np.int64), np.zeros(len(b.size), np.int64)
    stops, least, known, total = [], [], [], 0
    for k, ns, ss, ls, ks in zip(np.searchsorted(b.used, found["shard"].to_numpy(np.int64)).tolist(), found["n_runs"], found["stops"], found["least"], found["known"], strict=True):
        mine, n = b.order[b.cuts[k] : b.cuts[k + 1]], np.frombuffer(bytes(ns), "<i4").astype(np.int64)
        n_runs[mine], start[mine] = n, total + np.cumsum(n) - n
        stops.append(np.frombuffer(bytes(ss), "<i4"))
        least.append(np.frombuffer(bytes(ls), "<i8"))
        known.append(np.unpackbits(np.frombuffer(bytes(ks), np.uint8), count=len(least[-1])).astype(bool))
        total += int(n.sum())
    stop, low, real = np.concatenate(stops).astype(np.int64), np.concatenate(least), np.concatenate(known)
    n = n_runs[b.of]
    run = np.repeat(np.arange(len(n)), n)
    nth = np.arange(len(run)) - np.repeat(np.cumsum(n) - n, n)
    pick = start[b.of][run] + nth
    from_ = np.where(nth > 0, stop[pick - 1], 0)
    ok = np.where(tile.none[b.doc[run]], real[pick], low[pick] < tile.ids[b.doc[run]])
    at = b.first[run]
    for d, lo, hi in zip(b.doc[run][ok].tolist(), (at + from_)[ok].tolist(), (at + stop[pick] - 1 + length)[ok].tolist(), strict=True):
        mine = spans[d]
        if mine and lo <= mine[-1][1]:
            mine[-1] = (mine[-1][0], max(hi, mine[-1][1]))
        else:
            mine.append((lo, hi))
    return spans


def _spread(rows: DataFrame, key: str, count: int) -> DataFrame:
    """The rows dealt so that each number of ``key``, which are less than ``count``, has a task for itself."""
    return rows.repartitionById(count, key) if count <= PARTS else rows.repartition(PARTS, key)


def _dealt(rows: DataFrame) -> tuple[DataFrame, int]:
    """The rows with ``copies`` and ``tile``, and the bytes of all texts.

    Rows of one text come to one tile, which takes it once. A text whose rows would crowd a tile is dealt over several, by id.
    Equal rows would still crowd one where they are more than it holds. They are counted
    and come as several rows with a part of the copies each, which rows of one id allow.
    """
    size, h = F.octet_length("data").cast("long"), F.xxhash64("data").alias("h")
    same = rows.groupBy("doc_id", "none", h).agg(F.count("*").alias("n"), F.sum(size).alias("bytes"))
    weight = F.greatest("bytes", "n")
    most = F.max(F.when(F.col("n") > 1, weight)).alias("most")
    texts = same.groupBy("h").agg(F.sum("n").alias("n"), F.sum("bytes").alias("bytes"), most)
    total = texts.agg(F.sum("bytes").alias("bytes"), F.max("most").alias("most"), F.max(F.when(F.col("n") > 1, weight)).alias("widest")).first()
    all_bytes = total["bytes"] or 0
    share, few = TILE_BYTES // TEXT_SHARE, all_bytes // HEAVY_SHARE  # at most HEAVY_SHARE rows weigh more than ``few``, so they can be broadcast
    least = max(TILE_BYTES, few)
    dealt = rows.withColumns({"copies": F.lit(1).cast("long"), "part": F.lit(0).cast("long")})
    if (total["most"] or 0) > least:
        heavy = F.broadcast(same.where((F.col("n") > 1) & (weight > least)).select("doc_id", "none", "h"))
        keyed, on = rows.withColumn("h", h), ["doc_id", "none", "h"]
        parts = F.ceil(F.col("n") * F.greatest(size, F.lit(1)) / TILE_BYTES)
        many = keyed.join(heavy, on, "left_semi").groupBy("doc_id", "none", "data").agg(F.count("*").alias("n")).withColumn("parts", F.least(parts, "n"))
        many = many.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
        copies = F.floor(F.col("n") / F.col("parts")) + (F.col("part") < F.col("n") % F.col("parts")).cast("long")
        single = keyed.join(heavy, on, "left_anti").select("doc_id", "none", "data", F.lit(1).cast("long").alias("copies"), F.lit(0).cast("long").alias("part"))
        dealt = single.unionByName(many.select("doc_id", "none", "data", copies.alias("copies"), "part"))
    if (total["widest"] or 0) > max(share, few):
        wide = F.broadcast(texts.where((F.col("n") > 1) & (weight > max(share, few))).select("h", F.ceil(weight / share).alias("over")))
        turn = F.pmod(F.xxhash64("doc_id", "none", "part"), F.coalesce("over", F.lit(1)))
        dealt = dealt.withColumn("h", h).join(wide, "h", "left").withColumn("part", turn).drop("h", "over")
    tiles = int(-(-all_bytes // TILE_BYTES)) or 1
    return dealt.withColumn("tile", F.pmod(F.xxhash64("data", "part"), F.lit(tiles)).cast("int")).drop("part"), all_bytes


def remove_repeats(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text", hot_bytes: int = HOT_BYTES) -> DataFrame:
    """``doc_id, n_bytes, spans, kept``: the bytes of each text not covered by an earlier document's strings.

    A byte goes if a string of ``length`` bytes over it also starts in a document of a
    smaller id, as the texts were given; ``spans`` are the maximal removed runs (bytes,
    end exclusive), ``kept`` the remaining bytes, which need not be whole characters.

    Each string is routed by the least hash of its grams, so equal strings meet.
    Documents stand in tiles, those of one text together; a text is taken once there, under its first id. Routes of one document only go first; of the others, runs of
    strings with one route make blocks, and each shard of routes sorts its distinct
    blocks in one suffix array, which gives every string's earliest document. A route
    whose distinct blocks exceed ``hot_bytes`` would crowd one shard; its strings are dealt
    one by one, by a hash of all their bytes. Nothing but packed arrays passes between
    tiles and shards, and a block of many documents is sent once by each tile.

    Null texts are empty; rows with one id never remove from each other; rows without
    an id count as later than all others, and never remove from each other, so equal rows
    in any number are spread over tiles; texts under
    ``length`` bytes stay whole, and texts of any length are taken whole; other columns are
    left out; an empty table gives an empty result.
    """
    key = F.col(id_col).cast("long")
    rows = docs.select(F.coalesce(key, F.lit(0).cast("long")).alias("doc_id"), key.isNull().alias("none"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("data"))
    rows, size = _dealt(rows)
    tiles, buckets, shards = (int(-(-size // each)) or 1 for each in (TILE_BYTES, BUCKET_BYTES, SHARD_BYTES))
    by_tile = _spread(rows.select("tile", "doc_id", "none", "copies", "data"), "tile", tiles).groupBy("tile")

    def routes(part: pd.DataFrame) -> pd.DataFrame:
        return _tile_routes(int(part["tile"].iloc[0]), Tile(part), buckets, length)

    def blocks(part: pd.DataFrame, shared: pd.DataFrame) -> pd.DataFrame:
        return _blocks(int(part["tile"].iloc[0]), Tile(part), _joined(shared), shards, length)

    def finish(part: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        tile = Tile(part)
        spans = _removed(tile, _joined(found[found["shared"].notna()]), found[found["n_runs"].notna()], shards, length)
        n_bytes, cuts, kept = [], [], []
        for k, again in zip(tile.of.tolist(), tile.again.tolist(), strict=True):
            text = tile.texts[k]
            cut = [(0, len(text))] if again and len(text) >= length else spans[k]
            ends = [0, *(x for s in cut for x in s), len(text)]
            n_bytes.append(len(text))
            cuts.append([{"start": a, "end": b} for a, b in cut])
            kept.append(b"".join(text[a:b] for a, b in zip(ends[::2], ends[1::2], strict=True)))
        return pd.DataFrame({"copies": tile.copies, "doc_id": pd.arrays.IntegerArray(tile.row_ids, tile.row_none), "n_bytes": n_bytes, "spans": cuts, "kept": kept})

    all_routes = by_tile.applyInPandas(routes, "bucket int, tile int, routes binary, marks binary")
    shared = _spread(all_routes, "bucket", buckets).groupBy("bucket").applyInPandas(lambda part: _shared_routes(part, hot_bytes), "tile int, shared binary, hot binary")
    sent = by_tile.cogroup(_spread(shared, "tile", tiles).groupBy("tile")).applyInPandas(blocks, "shard int, tile int, lens binary, low binary, flags binary, text binary")
    found = _spread(sent, "shard", shards).groupBy("shard").applyInPandas(lambda part: _shard(part, length), "tile int, shard int, n_runs binary, stops binary, least binary, known binary")
    back = _spread(found.unionByName(shared, allowMissingColumns=True), "tile", tiles)
    cleaned = by_tile.cogroup(back.groupBy("tile")).applyInPandas(finish, "copies long, doc_id long, n_bytes long, spans array<struct<start:int,end:int>>, kept binary")
    return cleaned.select(F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))), "doc_id", "n_bytes", "spans", "kept").drop("col")


def _joined(shared: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """A tile's shared routes and which of them are hot."""
    if not len(shared):
        return np.zeros(0, np.uint64), np.zeros(0, bool)
    parts = [_unpacked(bytes(s)) for s in shared["shared"]]
    return np.concatenate(parts), _bits(shared["hot"], [len(p) for p in parts])
