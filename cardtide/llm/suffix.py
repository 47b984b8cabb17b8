"""Suffix arrays of one shard of bytes: refinement by doubled ranks, common prefixes, merging."""

from __future__ import annotations

import numpy as np


def words_at(data: np.ndarray) -> np.ndarray:
    """The 8 bytes at every place, little-endian; zeros follow the end."""
    padded = np.concatenate([data, np.zeros(16, np.uint8)])
    return np.ascontiguousarray(np.ndarray(len(data) + 9, "<u8", padded, 0, (1,)))


def suffix_array(words: np.ndarray, n: int) -> np.ndarray:
    """Places 0..n-1 in the order of their suffixes.

    Larsson-Sadakane: suffixes are grouped by their first 8 bytes, and each group of more than one is
    ordered by the group of the suffix h places further on, with h doubled in every round. Groups of
    one are never touched again. A suffix that ends is smaller than one that goes on.
    """
    key = words[:n].byteswap()
    order = np.argsort(key).astype(np.int32)
    key = key[order]
    new = np.ones(n, bool)
    new[1:] = key[1:] != key[:-1]
    group = np.maximum.accumulate(np.where(new, np.arange(n, dtype=np.int32), np.int32(0)))
    rank = np.empty(n, np.int32)
    rank[order] = group
    slots = _open(new)
    h = 8
    while slots.size:
        place = order[slots]
        beyond = place.astype(np.int64) + (h - n)
        # Past the end the shorter suffix is the smaller one.
        minor = np.where(beyond < 0, rank[np.minimum(beyond, -1)], -1 - beyond)
        key = group[slots] * np.int64(n + h) + (minor + h)
        by = np.argsort(key)
        key, place = key[by], place[by]
        order[slots] = place
        fresh = np.ones(len(slots), bool)
        fresh[1:] = key[1:] != key[:-1]
        group[slots] = np.maximum.accumulate(np.where(fresh, slots, 0))
        rank[place] = group[slots]
        last = np.concatenate([fresh[1:], [True]])
        slots = slots[~(fresh & last)]
        h *= 2
    return order


def _open(new: np.ndarray) -> np.ndarray:
    """Slots of groups with more than one member."""
    return np.flatnonzero(~(new & np.concatenate([new[1:], [True]]))) if len(new) else np.zeros(0, np.int64)


def common_prefixes(words: np.ndarray, n: int, order: np.ndarray, firsts: np.ndarray, sizes: np.ndarray, cap: int) -> np.ndarray:
    """For every slot of ``order`` the bytes its suffix shares with that of the slot before, ``cap`` at most.

    ``order`` holds the places firsts[i] .. firsts[i] + sizes[i] - 1 of runs i, in the order of their suffixes.
    Kasai: if p follows q in ``order`` and shares l bytes with it, then p + 1 shares at least l - 1 with what it
    follows, provided that q + 1 is one of the places too. All runs are gone through side by side.
    """
    before = np.full(n + 1, -1, np.int32)
    before[order[1:]] = order[:-1]
    goes_on = np.ones(n, bool)
    goes_on[firsts + sizes - 1] = False
    shared = np.zeros(n, np.int32)
    by_size = np.argsort(-sizes, kind="stable")
    lanes, sizes = firsts[by_size], sizes[by_size]
    length = np.zeros(len(lanes), np.int64)
    for step in range(int(sizes[0]) if len(sizes) else 0):
        count = int(np.searchsorted(-sizes, -step))
        here = lanes[:count] + step
        other = before[here].astype(np.int64)
        if step:
            last = before[here - 1]
            length = np.where((last >= 0) & goes_on[last], np.maximum(length[:count] - 1, 0), 0)
        length = np.where(other >= 0, length[:count], 0)
        live = np.flatnonzero((other >= 0) & (length < cap))
        while live.size:
            a, b = here[live] + length[live], other[live] + length[live]
            end = n - np.maximum(a, b)
            differ = words[a] ^ words[b]
            equal = np.where(differ == 0, 8, np.bitwise_count((differ & (~differ + np.uint64(1))) - np.uint64(1)) >> 3)
            length[live] += np.minimum(equal, end)
            live = live[(equal == 8) & (length[live] < cap) & (end > 8)]
        shared[here] = np.minimum(length, cap)
    return shared[order]


def least_owner(
    data: np.ndarray, firsts: np.ndarray, sizes: np.ndarray, owners: np.ndarray, length: int, shard: int
) -> np.ndarray:
    """For each window of ``length`` bytes the least owner of any equal window.

    Run i has the ``sizes[i]`` windows from ``firsts[i]`` on, and ``owners[i]``; runs ascend and do not share
    windows. They are dealt into shards of about ``shard`` bytes, each with a suffix array of its own;
    equal windows are found by their common prefixes. Windows of different shards meet by binary
    search of one shard's sorted distinct windows in the other's.
    """
    least = np.repeat(owners, sizes)
    total = np.concatenate([[0], np.cumsum(sizes)])
    found = []
    begin = 0
    while begin < len(firsts):
        end = max(begin + 1, int(np.searchsorted(firsts, firsts[begin] + shard)))
        base, stop = int(firsts[begin]), int(firsts[end - 1] + sizes[end - 1]) + length - 1
        own, number = firsts[begin:end] - base, sizes[begin:end]
        words = words_at(data[base:stop])
        of = np.repeat(np.arange(end - begin), number)
        starts = own[of] + np.arange(len(of)) - (total[begin:end] - total[begin])[of]
        index = np.full(stop - base, -1, np.int32)
        index[starts] = np.arange(len(starts), dtype=np.int32)
        windows = index[suffix_array(words, stop - base)]
        windows = windows[windows >= 0]
        run_ends = common_prefixes(words, stop - base, starts[windows], own, number, length) < length
        run_ends[0] = True
        first = np.flatnonzero(run_ends)
        low = np.minimum.reduceat(owners[begin:end][of[windows]], first)
        times = np.diff(np.concatenate([first, [len(windows)]]))
        keys = None
        if begin or end < len(firsts):
            keys = _keys(words, starts[windows[first]], length)
        found.append((windows + total[begin], times, low, keys))
        begin = end
    for i, (_, _, low, keys) in enumerate(found):
        for _, _, other_low, other_keys in found[i + 1 :]:
            at = _lower_bound(other_keys, keys)
            hit = np.flatnonzero(at < len(other_low))
            hit = hit[(other_keys[at[hit]] == keys[hit]).all(1)]
            both = np.minimum(low[hit], other_low[at[hit]])
            low[hit] = both
            other_low[at[hit]] = both
    for windows, times, low, _ in found:
        least[windows] = np.repeat(low, times)
    return least


def _keys(words: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """Each window as whole numbers that compare as its bytes do."""
    places = [*range(0, length - 7, 8), *([length - 8] if length % 8 else [])]
    return np.stack([words[starts + p].byteswap() for p in places], 1)


def _lower_bound(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    low, high = np.zeros(len(keys), np.int64), np.full(len(keys), len(table), np.int64)
    while (open_ := np.flatnonzero(low < high)).size:
        middle = (low[open_] + high[open_]) >> 1
        less, tie = np.zeros(len(open_), bool), np.ones(len(open_), bool)
        for c in range(table.shape[1]):
            x, y = table[middle, c], keys[open_, c]
            less |= tie & (x < y)
            tie &= x == y
        low[open_[less]] = middle[less] + 1
        high[open_[~less]] = middle[~less]
    return low
