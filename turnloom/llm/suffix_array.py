"""Suffix arrays by induced sorting, and permuted common prefixes, in numpy.

The steps are those of induced sorting: classify suffixes as smaller or larger than
their right neighbour, sort the leftmost-smaller (LMS) substrings, name them, order the
string of names recursively, and induce the whole array from the LMS suffixes. The
induction goes bucket by bucket: the entries a bucket holds so far are expanded at once,
those that fall into the same bucket are its next wave, the rest wait in later buckets;
the order is that of the one-by-one scan. Every suffix is handled a fixed number of
times, so the work is linear.
"""

from __future__ import annotations

import numpy as np

from ..session import ship_by_value

ship_by_value(__name__)

# The string of names is sorted by induction again while its alphabet is small against
# its length; where names are nearly all different, rank doubling ends it.
_INDUCE_RATIO = 64


def classify(t: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the next one; the last suffix counts as smaller."""
    n = len(t)
    up = np.empty(n, np.int8)
    up[:-1] = np.sign(t[1:].astype(np.int32) - t[:-1].astype(np.int32))
    up[-1] = 1
    at = np.where(up != 0, np.arange(n), n)  # next place where neighbours differ
    at = np.minimum.accumulate(at[::-1])[::-1]
    return up[at] > 0


def _grouped(ch: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Stable order by symbol, the symbols present, their counts, and each entry's place in its group."""
    order = np.argsort(ch, kind="stable")
    s = ch[order]
    first = np.flatnonzero(np.append(True, s[1:] != s[:-1]))
    count = np.diff(np.append(first, len(s)))
    return order, s[first], count, np.arange(len(s)) - np.repeat(first, count)


def _induce(t: np.ndarray, smaller: np.ndarray, start: np.ndarray, size: np.ndarray, l_size: np.ndarray, lms: np.ndarray) -> np.ndarray:
    """The array induced from ``lms``, LMS places grouped by first symbol in their order."""
    n = len(t)
    sa = np.full(n, -1, np.int32)
    head = start.copy()
    cut = np.searchsorted(t[lms], np.arange(len(size) + 1))
    present = np.flatnonzero(size)

    def push(j: np.ndarray, want: bool) -> None:
        j = j[j > 0] - 1
        j = j[smaller[j] == want]
        if not len(j):
            return
        ch = t[j]
        order, sym, count, place = _grouped(ch)
        if want:
            sa[np.repeat(tail[sym], count) - 1 - place] = j[order]
            tail[sym] -= count
        else:
            sa[np.repeat(head[sym], count) + place] = j[order]
            head[sym] += count

    for c in present.tolist():
        done = start[c]
        while done != head[c]:
            wave, done = sa[done : head[c]], head[c]
            push(wave, False)
        push(lms[cut[c] : cut[c + 1]], False)

    tail = start + size
    for c in present[::-1].tolist():
        done = start[c] + size[c]
        while done != tail[c]:
            wave, done = sa[tail[c] : done][::-1], tail[c]
            push(wave, True)
        push(sa[start[c] : start[c] + l_size[c]][::-1], True)
    sa[0] = n - 1
    return sa


def _names(t: np.ndarray, sorted_lms: np.ndarray, lms: np.ndarray) -> tuple[np.ndarray, int]:
    """Equal LMS substrings get equal names, in order; names by text order of ``lms``."""
    length = np.zeros(len(t), np.int32)
    length[lms[:-1]] = np.diff(lms)
    a, b = sorted_lms[:-1], sorted_lms[1:]
    same = length[a] == length[b]
    live, d = np.flatnonzero(same), 0
    while len(live):
        live = live[d <= length[a[live]]]
        diff = t[a[live] + d] != t[b[live] + d]
        same[live[diff]] = False
        live, d = live[~diff], d + 1
    name = np.zeros(len(t), np.int32)
    name[sorted_lms] = np.append(0, np.cumsum(~same))
    return name[lms], int(name[sorted_lms[-1]]) + 1


def _by_doubling(r: np.ndarray) -> np.ndarray:
    """Order of the suffixes of ``r`` (names in order of content): unresolved groups are
    split by the rank twice as far on, until all ranks differ."""
    n = len(r)
    order = np.argsort(r, kind="stable")
    s = r[order]
    new = np.append(True, s[1:] != s[:-1])
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    single = new & np.append(new[1:], True)
    live, h = order[~single], 1
    while len(live):
        ahead = live + h
        second = np.where(ahead < n, rank[np.minimum(ahead, n - 1)] + 1, 0)
        key = rank[live] * (n + 1) + second
        o = np.argsort(key)
        live, key = live[o], key[o]
        old = rank[live]
        at = np.arange(len(live))
        new = np.append(True, key[1:] != key[:-1])
        group = np.maximum.accumulate(np.where(np.append(True, old[1:] != old[:-1]), at, 0))
        rank[live] = old + np.maximum.accumulate(np.where(new, at, 0)) - group
        live, h = live[~(new & np.append(new[1:], True))], h * 2
    out = np.empty(n, np.int32)
    out[rank] = np.arange(n)
    return out


def suffix_array(t: np.ndarray, symbols: int) -> np.ndarray:
    """Order of all suffixes of ``t``, whose last symbol is 0 and stands nowhere else."""
    n = len(t)
    if n == 1:
        return np.zeros(1, np.int32)
    smaller = classify(t)
    lms = (np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1).astype(np.int32)
    size = np.bincount(t, minlength=symbols)
    l_size = np.bincount(t[~smaller], minlength=symbols)
    start = np.append(0, np.cumsum(size)[:-1])
    by_first = lms[np.argsort(t[lms], kind="stable")]
    sa = _induce(t, smaller, start, size, l_size, by_first)
    is_lms = np.zeros(n, bool)
    is_lms[lms] = True
    names, k = _names(t, sa[is_lms[sa]], lms)
    if k == len(lms):
        order = np.empty(k, np.int32)
        order[names] = np.arange(k)
    elif k * _INDUCE_RATIO < len(lms):
        order = suffix_array(names, k)
    else:
        order = _by_doubling(names)
    return _induce(t, smaller, start, size, l_size, lms[order])


def permuted_lcp(data: np.ndarray, sa: np.ndarray, left: np.ndarray) -> np.ndarray:
    """For each place i, the bytes its suffix shares with the one before it in ``sa``, at
    most to the end of either's segment (``left``: bytes from a place to the end of its
    segment, 0 at separators).

    Places whose left neighbours agree share one byte less than the place before
    (reducible); the rest are compared directly, eight bytes at a time.
    """
    n = len(sa)
    phi = np.full(n, -1, np.int32)
    phi[sa[1:]] = sa[:-1]
    at = np.arange(n)
    prev = np.maximum(phi - 1, 0)
    hard = (phi <= 0) | (at == 0)
    hard[1:] |= (data[:-1] != data[prev[1:]]) | (left[:-1] == 0) | (left[prev[1:]] == 0)
    i = np.flatnonzero(hard & (phi >= 0))
    limit = np.minimum(left[i], left[phi[i]])
    padded = np.concatenate([data, np.zeros(16, np.uint8)])
    words = np.lib.stride_tricks.as_strided(padded.view(np.uint8), (n + 8, 8), (1, 1))
    got = np.zeros(len(i), np.int64)
    live = np.flatnonzero(limit > 0)
    while len(live):
        a = words[i[live] + got[live]].view("<u8").ravel()
        b = words[phi[i[live]] + got[live]].view("<u8").ravel()
        x = a ^ b
        low = x & (~x + np.uint64(1))
        same = np.where(x == 0, 8, np.bitwise_count(low - np.uint64(1)) // 8).astype(np.int64)
        got[live] += same
        live = live[(same == 8) & (got[live] < limit[live])]
    total = np.zeros(n, np.int64)
    total[i] = np.minimum(got, limit) + i
    source = np.maximum.accumulate(np.where(hard, at, 0))
    out = total[source] - at
    return np.maximum(out, 0)
