"""Suffix arrays by induced sorting, and permuted common prefixes, over numpy arrays.

Both inducing passes take one of two forms. Over bytes, buckets are large and few: they are
stepped through in order, each dealing what precedes it in one go. Over names, most buckets
hold a suffix or two: there all suffixes of a type are induced together. A larger suffix is a
run of falling signs down to the next leftmost-smaller one, a smaller suffix a run of rising
signs up to the next larger one, so ranks within buckets are refined by the rank one place on,
then two, four and so on, until the runs are through.
"""

from __future__ import annotations

import numpy as np

#: Buckets are stepped through if they hold so many suffixes on average.
BUCKET_MEAN = 256
#: Suffixes are dealt share by share if a bucket gets so many on average, else one by one.
SHARE_MEAN = 32
#: Leftmost-smaller substrings are compared sign by sign up to here, and whole beyond.
SIGN_BY_SIGN = 64
#: Runs of one sign are followed place by place up to here, and whole beyond.
WAVES = 16


def suffix_types(t: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the next one; the last sign must be the unique smallest."""
    small = np.ones(len(t), bool)
    change = np.flatnonzero(t[:-1] != t[1:])
    if len(change):
        small[: change[-1] + 1] = np.repeat(t[change] < t[change + 1], np.diff(change, prepend=-1))
    return small


def _next_at(marked: np.ndarray) -> np.ndarray:
    """For each place, the first marked place at or after it; the end if there is none."""
    n = len(marked)
    return np.minimum.accumulate(np.where(marked, np.arange(n, dtype=np.int32), np.int32(n - 1))[::-1])[::-1]


def _induce(rank: np.ndarray, of: np.ndarray, stop: np.ndarray) -> None:
    """Refine the ranks of the suffixes ``of`` by the ranks along their runs, which end at ``stop``.

    A rank is the first place of its class in the suffix array; classes that the ranks at
    their runs' ends don't part stay classes.
    """
    h = 1
    while len(of := of[stop[of] - of >= h]):
        key = (rank[of].astype(np.uint64) << np.uint64(32)) | rank[np.minimum(of + h, stop[of])].astype(np.uint64)
        order = np.argsort(key)
        of, key = of[order], key[order]
        base = key >> np.uint64(32)
        new = np.concatenate([[True], key[1:] != key[:-1]])
        head = np.concatenate([[True], base[1:] != base[:-1]])
        at = np.arange(len(of))
        rank[of] += (np.maximum.accumulate(np.where(new, at, 0)) - np.maximum.accumulate(np.where(head, at, 0))).astype(rank.dtype)
        first = np.flatnonzero(new)
        size = np.diff(first, append=len(of))
        of, h = of[np.repeat(size > 1, size)], 2 * h


def _ranks(t: np.ndarray, small: np.ndarray, left: np.ndarray, starts: np.ndarray, larger: np.ndarray, order: np.ndarray | None) -> np.ndarray:
    """Ranks of all suffixes, induced from the leftmost-smaller ones: by their ``order``, or by their signs alone.

    In a bucket the larger suffixes come first. Larger suffixes are induced first, then smaller ones from them.
    """
    rank = (starts[t] + np.where(small, larger[t], 0)).astype(np.int32)
    ends = _next_at(left)
    if order is not None:  # places among the bucket's smaller suffixes, in order; only their order counts
        signs = t[order]
        by = np.argsort(signs, kind="stable")
        ranked, signs = order[by], signs[by]
        head = np.maximum.accumulate(np.where(np.concatenate([[True], signs[1:] != signs[:-1]]), np.arange(len(by)), 0))
        rank[ranked] += (np.arange(len(by)) - head).astype(np.int32)
    _induce(rank, np.flatnonzero(~small), ends)
    rank[small] = (starts[t[small]] + larger[t[small]]).astype(np.int32)
    _induce(rank, np.flatnonzero(small)[:-1], _next_at(~small))
    return rank


def _deal(sa: np.ndarray, at: np.ndarray, p: np.ndarray, signs: np.ndarray, step: int) -> None:
    """Put the suffixes ``p`` into the buckets of their signs, in order, from ``at`` on in direction ``step``."""
    order = np.argsort(signs, kind="stable")
    signs, dealt = signs[order], p[order]
    first = np.flatnonzero(np.concatenate([[True], signs[1:] != signs[:-1]])) if len(signs) else np.zeros(0, np.int64)
    count, used = np.diff(first, append=len(signs)), signs[first]
    if len(first) * SHARE_MEAN <= len(signs):  # a bucket's share lies together and goes there in one piece
        for x, a, n in zip(at[used].tolist(), first.tolist(), count.tolist(), strict=True):
            if step > 0:
                sa[x : x + n] = dealt[a : a + n]
            else:
                sa[x - n + 1 : x + 1] = dealt[a : a + n][::-1]
    else:
        rank = np.arange(len(signs)) - np.repeat(first, count)
        sa[np.repeat(at[used], count) + step * rank] = dealt
    at[used] += step * count


def _runs_back(ends: np.ndarray, run: np.ndarray) -> np.ndarray:
    """The suffixes of the runs of one sign that end at ``ends``: all the ends, then all those one place before, and so on."""
    parts, k = [ends], 1
    rest = ends[run[ends] > 1]
    while len(rest) and k < WAVES:
        parts.append(rest - k)
        k += 1
        rest = rest[run[rest] > k]
    if len(rest):  # long runs
        count = run[rest].astype(np.int64) - k
        back = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        parts.append((np.repeat(rest - k, count) - back)[np.argsort(back, kind="stable")])
    return np.concatenate(parts) if len(parts) > 1 else ends


def _step_through(t: np.ndarray, leftmost: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The suffix array, induced bucket by bucket from the leftmost-smaller suffixes in their order."""
    n, starts = len(t), np.concatenate([[0], bounds[:-1]])
    place = np.arange(n, dtype=np.int32)
    run = place - np.maximum.accumulate(np.where(np.concatenate([[True], t[1:] != t[:-1]]), place, 0)) + 1
    sa = np.full(n, -1, np.int32)
    signs = t[leftmost]
    held = np.bincount(signs, minlength=len(bounds))
    _deal(sa, bounds - held, leftmost.astype(np.int32), signs, 1)
    head = starts.copy()
    for c in np.flatnonzero(bounds > starts):
        larger = _runs_back(sa[starts[c] : head[c]], run)  # the rest of their runs follow in this bucket
        sa[starts[c] : starts[c] + len(larger)] = larger
        head[c] = starts[c] + len(larger)
        for e in (larger, sa[bounds[c] - held[c] : bounds[c]]):
            p = e - 1  # of the first suffix: the end, whose sign is 0
            signs = t[p]
            ok = signs > c  # then it is larger than what it precedes
            _deal(sa, head, p[ok], signs[ok], 1)
    tail = bounds - 1
    sa[0] = n - 1
    for c in np.flatnonzero(bounds > starts)[:0:-1]:
        smaller = _runs_back(sa[tail[c] + 1 : bounds[c]][::-1], run)
        tail[c] = bounds[c] - 1 - len(smaller)
        sa[tail[c] + 1 : bounds[c]] = smaller[::-1]
        for e in (smaller, sa[starts[c] : head[c]][::-1]):
            p = e - 1
            signs = t[p]
            ok = (signs < c) & (signs > 0)
            _deal(sa, tail, p[ok], signs[ok], -1)
    return sa


def _named(t: np.ndarray, ranked: np.ndarray, width: np.ndarray) -> np.ndarray:
    """Names of leftmost-smaller substrings that stand in order: equal ones share a name."""
    new = np.ones(len(ranked), bool)
    a = np.flatnonzero(width[1:] == width[:-1]) + 1
    new[a] = False
    for k in range(SIGN_BY_SIGN):  # neighbours of one width, until they differ or end
        differ = t[ranked[a] + k] != t[ranked[a - 1] + k]
        new[a[differ]] = True
        a = a[~differ]
        a = a[width[a] > k]
        if not len(a):
            break
    for i in a.tolist():
        p, q, n = int(ranked[i]), int(ranked[i - 1]), int(width[i]) + 1
        new[i] = not np.array_equal(t[p : p + n], t[q : q + n])
    return np.cumsum(new) - 1


def suffix_array(t: np.ndarray, signs: int, depth: int) -> np.ndarray:
    """Suffixes of ``t`` in order of their first ``depth`` signs at least; its last sign is the unique 0.

    Leftmost-smaller substrings are sorted by inducing from their signs, and named; if names
    repeat, the string of the names is sorted in turn by the same function, to half the depth, as
    a name stands for two signs at least. From that order the whole array is induced.
    """
    if len(t) < 3:
        return np.arange(len(t), dtype=np.int32)[::-1].copy()
    small = suffix_types(t)
    left = np.zeros(len(t), bool)
    left[1:] = small[1:] & ~small[:-1]
    count, at = np.bincount(t, minlength=signs), np.flatnonzero(left)
    stepped = len(t) >= signs * BUCKET_MEAN
    if stepped:
        bounds = np.cumsum(count)
        sa = _step_through(t, at, bounds)
        ranked = sa[left[sa]].astype(np.int64)
        after = np.full(len(t), len(t) - 1, np.int64)
        after[at[:-1]] = at[1:]
        name = _named(t, ranked, after[ranked] - ranked)
        of = np.empty(len(t), np.int64)
        of[ranked] = name
        names, classes = of[at], int(name[-1]) + 1
    else:
        starts, larger = np.cumsum(count) - count, np.bincount(t[~small], minlength=signs)
        found, names = np.unique(_ranks(t, small, left, starts, larger, None)[at], return_inverse=True)
        classes = len(found)
    if classes == len(at) or depth < 2:
        order = at[np.argsort(names, kind="stable")]
    else:
        order = at[suffix_array(names, classes, depth // 2 + 1 if depth > 2 else 1)]
    if stepped:
        return _step_through(t, order, bounds)
    rank = _ranks(t, small, left, starts, larger, order)
    sa = np.empty(len(t), np.int32)
    sa[rank] = np.arange(len(t), dtype=np.int32)
    return sa


def permuted_prefixes(data: np.ndarray, sa: np.ndarray, most: int) -> np.ndarray:
    """For each suffix, by its place in the text: signs it shares with the one before it in ``sa``, ``most`` at most.

    ``data`` must hold ``most`` + 8 bytes past every suffix in ``sa``. Eight bytes are
    compared at once, in the text's order, as its neighbours' prefixes lie side by side.
    """
    before = np.full(len(data), -1, np.int32)
    before[sa[1:]] = sa[:-1]
    place = np.flatnonzero(before >= 0)
    prior = before[place].astype(np.int64)
    shared = np.zeros(len(data), np.int16)
    words = np.ndarray((len(data) - 7,), "<u8", data.tobytes(), strides=(1,))
    for k in range(0, most, 8):
        differ = words[place + k] ^ words[prior + k]
        low = differ & (~differ + np.uint64(1))
        shared[place] = k + np.where(differ == 0, 8, np.bitwise_count(low - np.uint64(1)) >> 3)
        place, prior = place[differ == 0], prior[differ == 0]
    return np.minimum(shared, most)
