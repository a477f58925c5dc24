"""Suffix arrays by induced sorting, whole buckets at a time in numpy.

Suffixes are classified as smaller (S) or larger (L) than the next; the leftmost
smaller ones (LMS) are sorted by their substrings, named, and their order is found
by sorting the shorter text of names. From the sorted LMS suffixes the L and then
the S suffixes are induced. A bucket is worked through in waves: what it holds
induces entries of later buckets, and of itself in the next wave; a wave is one
array operation, so the work is linear and the number of steps is the number of
buckets and the longest run of one character.
"""

from __future__ import annotations

import numpy as np

# Largest alphabet that is worked through bucket by bucket; names beyond it are sorted by doubling.
BUCKETS = 4096


def _smaller(text: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the next one; the last one counts as smaller."""
    n = len(text)
    out = np.ones(n, bool)
    if n == 1:
        return out
    change = np.append(text[1:] != text[:-1], True)
    at = np.where(change, np.arange(n), n)
    at = np.minimum.accumulate(at[::-1])[::-1]
    inner = at < n - 1
    out[inner] = text[at[inner]] < text[at[inner] + 1]
    return out


def _deal(into: list[list[np.ndarray]], places: np.ndarray, chars: np.ndarray) -> None:
    """Append places to the buckets of their characters, in their order."""
    if not len(places):
        return
    order = np.argsort(chars, kind="stable")
    chars, places = chars[order], places[order]
    cuts = np.flatnonzero(chars[1:] != chars[:-1]) + 1
    begin = 0
    for end in [*cuts.tolist(), len(chars)]:
        into[chars[begin]].append(places[begin:end])
        begin = end


def _joined(parts: list[np.ndarray]) -> np.ndarray:
    return np.concatenate(parts) if parts else np.empty(0, np.int32)


def induce(text: np.ndarray, small: np.ndarray, lms: np.ndarray, size: int) -> np.ndarray:
    """All suffixes in order, from the LMS suffixes in order (or from any order, to sort their substrings)."""
    seeds: list[list[np.ndarray]] = [[] for _ in range(size)]
    _deal(seeds, lms, text[lms])
    seed = [_joined(s) for s in seeds]
    later: list[list[np.ndarray]] = [[] for _ in range(size)]
    large = [np.empty(0, np.int32)] * size
    for c in range(size):
        done, wave = [], _joined(later[c])
        while len(wave):
            done.append(wave)
            before = wave[wave > 0] - 1
            before = before[~small[before]]
            chars = text[before]
            own = chars == c
            wave = before[own]
            _deal(later, before[~own], chars[~own])
        large[c] = _joined(done)
        before = seed[c][seed[c] > 0] - 1
        _deal(later, before, text[before])
    earlier: list[list[np.ndarray]] = [[] for _ in range(size)]
    out: list[np.ndarray] = []
    last = len(text) - 1
    for c in range(size - 1, -1, -1):
        done, wave = [], _joined(earlier[c])
        if text[last] == c:
            wave = np.append(wave, np.int32(last))
        while len(wave):
            done.append(wave)
            before = wave[wave > 0] - 1
            before = before[small[before]]
            chars = text[before]
            own = chars == c
            wave = before[own]
            _deal(earlier, before[~own], chars[~own])
        out.append(_joined(done))
        before = large[c][::-1]
        before = before[before > 0] - 1
        before = before[small[before]]
        _deal(earlier, before, text[before])
        out.append(large[c][::-1])
    return np.concatenate(out)[::-1]


def _doubled(names: np.ndarray) -> np.ndarray:
    """Suffix array of names by sorting pairs of ranks; settled suffixes are left alone."""
    n = len(names)
    rank = names.astype(np.int64)
    order = np.argsort(rank, kind="stable")
    open_ = order
    step = 1
    while True:
        key = rank[order]
        first = np.concatenate(([True], key[1:] != key[:-1]))
        # Ranks are the place of the first suffix of a group, so that groups keep their place.
        place = np.maximum.accumulate(np.where(first, np.arange(n), 0))
        rank[order] = place
        alone = first & np.concatenate((first[1:], [True]))
        at = np.flatnonzero(~alone)
        if not len(at):
            return order
        open_ = order[at]
        after = np.where(open_ + step < n, rank[np.minimum(open_ + step, n - 1)] + 1, 0)
        group = rank[open_]
        sort = np.lexsort((after, group))
        order[at] = open_[sort]
        # New ranks within each group, by what follows.
        group, after = group[sort], after[sort]
        new = np.concatenate(([True], (group[1:] != group[:-1]) | (after[1:] != after[:-1])))
        rank[order[at]] = at[np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))]
        step *= 2


def _named(text: np.ndarray, lms: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Names of the LMS substrings, in text order; equal substrings have equal names."""
    length = np.empty(len(text), np.int32)
    length[lms] = np.append(np.diff(lms) + 1, 1)
    a, b = order[:-1], order[1:]
    same = length[a] == length[b]
    left = np.flatnonzero(same)
    k = 0
    while len(left):
        left = left[length[a[left]] > k]
        wrong = text[a[left] + k] != text[b[left] + k]
        same[left[wrong]] = False
        left = left[~wrong]
        k += 1
    name = np.empty(len(text), np.int32)
    name[order] = np.concatenate(([0], np.cumsum(~same)))
    return name[lms]


def suffix_array(text: np.ndarray, size: int) -> np.ndarray:
    """Suffix array of characters 0 to ``size`` - 1; the last is 0 and occurs once."""
    n = len(text)
    if n < 2:
        return np.arange(n, dtype=np.int32)
    small = _smaller(text)
    lms = (np.flatnonzero(small[1:] & ~small[:-1]) + 1).astype(np.int32)
    if len(lms) < 2:
        return induce(text, small, lms, size)
    is_lms = np.zeros(n, bool)
    is_lms[lms] = True
    order = induce(text, small, lms, size)
    order = order[is_lms[order]]
    names = _named(text, lms, order)
    most = int(names.max()) + 1
    if most < len(names):
        inner = suffix_array(names.astype(np.uint16), most) if most <= BUCKETS else _doubled(names)
        order = lms[inner]
    return induce(text, small, order.astype(np.int32), size)


def common_prefixes(data: np.ndarray, order: np.ndarray) -> np.ndarray:
    """For each suffix but the first, in the array's order, the bytes it shares with the one before.

    Computed in text order: a suffix and its predecessor that follow equal bytes
    share one byte less than the suffix before; only the others are compared.
    """
    n = len(data)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    place = np.arange(n)
    # Preceded by different bytes, or by none: the prefix is not that of the suffix before less one byte.
    own = (before <= 0) | (place == 0)
    own[~own] = data[place[~own] - 1] != data[before[~own] - 1]
    heads = np.flatnonzero(own & (before >= 0))
    padded = np.concatenate((data, np.zeros(16, np.uint8)))
    words = np.lib.stride_tricks.sliding_window_view(padded, 8)
    shared = np.zeros(n, np.int64)
    left, k = heads, 0
    other = before[heads]
    while len(left):
        here, there = left + k, other + k
        inside = np.maximum(here, there) < n
        left, other, here, there = left[inside], other[inside], here[inside], there[inside]
        equal = words[here] == words[there]
        count = np.where(equal.all(1), 8, equal.argmin(1))
        shared[left] += np.minimum(count, n - np.maximum(here, there))
        go = count == 8
        left, other = left[go], other[go]
        k += 8
    head = np.maximum.accumulate(np.where(own, place, 0))
    full = np.maximum(shared[head] - (place - head), 0)
    full[before < 0] = 0
    return full[order[1:]]
