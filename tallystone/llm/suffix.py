"""Suffix array by induced sorting and permuted common prefixes, in numpy.

The induced passes run bucket by bucket over whole arrays: all suffixes that
wait in a bucket induce their predecessors at once, those that fall into the
same bucket form its next round, and the order of arrival is the order of the
suffixes. Work is linear in the text, with a handful of array operations for
each of the 256 buckets and round.
"""

from __future__ import annotations

import numpy as np


def _types(t: np.ndarray) -> np.ndarray:
    """True where the suffix is smaller than its right neighbour (the last one is not)."""
    n = len(t)
    differ = np.flatnonzero(t[1:] != t[:-1])
    small = np.zeros(n, bool)
    if len(differ):
        nxt = np.searchsorted(differ, np.arange(n))           # the next place where the text changes
        inside = nxt < len(differ)
        at = differ[nxt[inside]]
        small[inside] = t[at] < t[at + 1]
    return small


def _deal(t: np.ndarray, where: np.ndarray, buckets: list[list]) -> None:
    """Append positions to the buckets of their characters, in order."""
    if not len(where):
        return
    c = t[where]
    order = np.argsort(c, kind="stable")
    c, where = c[order], where[order]
    cuts = np.flatnonzero(c[1:] != c[:-1]) + 1
    for part, ch in zip(np.split(where, cuts), c[np.r_[0, cuts]]):
        buckets[ch].append(part)


def _join(parts: list) -> np.ndarray:
    return np.concatenate(parts) if parts else np.zeros(0, np.int32)


def _induce(t: np.ndarray, small: np.ndarray, lms: np.ndarray) -> np.ndarray:
    """All suffixes in the order that the ordered leftmost-smaller suffixes ``lms`` induce."""
    n = len(t)
    large: list[list] = [[] for _ in range(256)]
    seeds: list[list] = [[] for _ in range(256)]
    _deal(t, lms, seeds)
    large[t[n - 1]].append(np.array([n - 1], np.int32))                 # the end of the text comes before all
    for c in range(256):
        done, now = [], _join(large[c])
        while len(now):
            done.append(now)
            before = now[now > 0] - 1
            before = before[~small[before]]
            same = t[before] == c
            _deal(t, before[~same], large)
            now = before[same]
        large[c] = done
        before = _join(seeds[c])
        before = before[before > 0] - 1
        _deal(t, before[~small[before]], large)
    up: list[list] = [[] for _ in range(256)]                 # smaller suffixes, from the right end of a bucket
    for c in range(255, -1, -1):
        done, now = [], _join(up[c])
        while len(now):
            done.append(now)
            before = now[now > 0] - 1
            before = before[small[before]]
            same = t[before] == c
            _deal(t, before[~same], up)
            now = before[same]
        up[c] = done
        before = _join(large[c])[::-1]
        before = before[before > 0] - 1
        _deal(t, before[small[before]], up)
    return _join([x for c in range(256) for x in (_join(large[c]), _join(up[c])[::-1])])


def _ranked(names: np.ndarray) -> np.ndarray:
    """Order of the suffixes of the reduced text: names of doubled length until all differ."""
    n = len(names)
    rank = names.astype(np.int64)
    step = 1
    while True:
        second = np.zeros(n, np.int64)
        second[:max(0, n - step)] = rank[step:] + 1
        key = rank * (n + 2) + second
        order = np.argsort(key)
        new = np.zeros(n, np.int64)
        new[order] = np.r_[0, np.cumsum(key[order][1:] != key[order][:-1])]
        rank, step = new, 2 * step
        if rank[order[-1]] == n - 1 or step > 2 * n:
            return order


def suffix_array(t: np.ndarray) -> np.ndarray:
    """Starts of the suffixes of ``t`` (uint8, not empty) in byte order."""
    n = len(t)
    small = _types(t)
    lms = np.flatnonzero(small[1:] & ~small[:-1]).astype(np.int32) + 1
    if len(lms) > 1:
        rough = _induce(t, small, lms)
        is_lms = np.zeros(n, bool)
        is_lms[lms] = True
        sorted_lms = rough[is_lms[rough]]
        end = np.full(n, n, np.int64)
        end[lms[:-1]] = lms[1:]
        p, q = sorted_lms[:-1], sorted_lms[1:]
        same = (end[p] - p == end[q] - q) & (end[p] < n) & (end[q] < n)
        live = np.flatnonzero(same)
        d = 0
        while len(live):                                      # compare neighbours, place by place
            differ = t[p[live] + d] != t[q[live] + d]
            same[live[differ]] = False
            live = live[~differ]
            live = live[p[live] + d < end[p[live]]]
            d += 1
        name = np.zeros(n, np.int64)
        name[sorted_lms] = np.r_[0, np.cumsum(~same)]
        if not same.any():
            lms = sorted_lms
        else:
            lms = lms[_ranked(name[lms])]
    return _induce(t, small, lms)


def common_prefixes(t: np.ndarray, sa: np.ndarray, most: int, anchors: np.ndarray) -> np.ndarray:
    """For each rank, the common prefix with the rank before, up to ``most``.

    Computed in text order: a suffix whose left character equals that of its
    predecessor in the suffix array takes its left neighbour's value less one;
    only the others, and ``anchors``, are compared, eight bytes at a time. The
    values are exact up to ``most`` less the distance to the anchor before.
    """
    n = len(t)
    phi = np.full(n, -1, np.int64)
    phi[sa[1:]] = sa[:-1]
    left = np.arange(n) - 1
    plain = (left >= 0) & (phi > 0)
    plain[plain] = t[left[plain]] == t[phi[plain] - 1]
    plain[anchors] = False
    i = np.flatnonzero(~plain & (phi >= 0))
    padded = np.zeros(n + most + 16, np.uint8)
    padded[:n] = t
    word = np.ndarray((n + most,), "<u8", padded.data, strides=(1,))
    plcp = np.full(n, -1, np.int64)
    plcp[phi < 0] = 0
    got = np.zeros(len(i), np.int64)
    live = np.arange(len(i))
    for d in range(0, most, 8):
        x = word[i[live] + d] ^ word[phi[i[live]] + d]
        stop = x != 0
        y = x[stop]
        got[live[stop]] = d + np.bitwise_count((y & (~y + np.uint64(1))) - np.uint64(1)).astype(np.int64) // 8
        live = live[~stop]
        if not len(live):
            break
    got[live] = most
    plcp[i] = np.minimum(got, n - np.maximum(i, phi[i]))
    known = plcp >= 0
    place = np.arange(n)
    reach = np.where(known, plcp + place, -1)
    source = np.maximum.accumulate(np.where(known, place, -1))
    plcp = np.where(known, plcp, np.maximum(reach[source] - place, 0))
    return plcp[sa]
