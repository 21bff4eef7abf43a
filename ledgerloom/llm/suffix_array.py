"""Suffix array of a byte string by induced sorting, and permuted common
prefixes.

Suffixes are classified (S: smaller than the next suffix, L: larger), the
leftmost S-type ones (an S after an L) are sorted by their substrings, named,
and, where names repeat, sorted by recursion on the string of names; all other
suffixes follow by induction, linearly, bucket by bucket with whole arrays. The
recursion renames pairs of names, not leftmost S-type runs of names: with their
large alphabet, induction would go item by item.
"""

from __future__ import annotations

import numpy as np


def s_types(t: np.ndarray) -> np.ndarray:
    """True for S-type places; the last (a unique smallest item) is one."""
    n = len(t)
    up = np.ones(n, bool)
    if n > 1:
        differs = np.append(t[:-1] != t[1:], True)
        # place of the first difference at or after i
        at = np.where(differs, np.arange(n), n)
        at = np.minimum.accumulate(at[::-1])[::-1]
        up[:-1] = np.append(t[:-1] < t[1:], True)[at[:-1]]
    return up


def _induce_bytes(t: np.ndarray, is_s: np.ndarray, lms: np.ndarray, k: int) -> np.ndarray:
    """Suffix order induced from ``lms`` in order; items of t are below k."""
    n = len(t)
    count = np.bincount(t, minlength=k)
    n_l = np.bincount(t[~is_s], minlength=k)
    head = np.cumsum(count) - count
    order = np.full(n, -1, np.int32)
    # the leftmost S-type suffixes of each bucket
    kind = t[lms]
    by = np.argsort(kind, kind="stable")
    first = np.searchsorted(kind[by], np.arange(k + 1))
    starts = lms[by]
    end = head.copy()

    def put(preds: np.ndarray, step: int) -> None:
        d = t[preds]
        o = np.argsort(d, kind="stable")
        d, preds = d[o], preds[o]
        cut = np.flatnonzero(np.diff(d)) + 1
        for a, b in zip([0, *cut.tolist()], [*cut.tolist(), len(d)]):
            c = int(d[a])
            if step > 0:
                order[end[c]:end[c] + b - a] = preds[a:b]
                end[c] += b - a
            else:
                order[end[c] - (b - a):end[c]] = preds[a:b][::-1]
                end[c] -= b - a

    for c in range(k):                  # L-type, from the smallest bucket up
        if not count[c]:
            continue
        done = head[c]
        while done < end[c]:            # items of a bucket may add to it
            now = order[done:end[c]].copy()
            done = end[c]
            now = now[now > 0] - 1
            now = now[~is_s[now]]
            if len(now):
                put(now, 1)
        now = starts[first[c]:first[c + 1]]
        now = now[now > 0] - 1
        if len(now):
            put(now, 1)                 # what precedes a leftmost S-type is L-type
    end = head + count
    for c in range(k - 1, -1, -1):      # S-type, from the largest bucket down
        if not count[c]:
            continue
        done = head[c] + count[c]
        while done > end[c]:
            now = order[end[c]:done][::-1].copy()
            done = end[c]
            now = now[now > 0] - 1
            now = now[is_s[now]]
            if len(now):
                put(now, -1)
        now = order[head[c]:head[c] + n_l[c]][::-1]
        now = now[now > 0] - 1
        now = now[is_s[now]]
        if len(now):
            put(now, -1)
    order[0] = n - 1                    # the unique smallest item has no successor
    return order


def _equal_neighbours(t: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """For substrings in order: whether each equals the one before it."""
    same = np.zeros(len(starts), bool)
    maybe = np.flatnonzero(lengths[1:] == lengths[:-1]) + 1
    for k in range(0, len(maybe), 1 << 18):
        i = maybe[k:k + (1 << 18)]
        n = lengths[i]
        first = np.cumsum(n) - n
        step = np.arange(int(n.sum())) - np.repeat(first, n)
        equal = t[np.repeat(starts[i], n) + step] == t[np.repeat(starts[i - 1], n) + step]
        same[i] = np.logical_and.reduceat(equal, first)
    return same


def _names(t: np.ndarray, lms: np.ndarray, in_order: np.ndarray) -> tuple[np.ndarray, int]:
    """Names of the leftmost S-type substrings in text order, and how many."""
    place = np.full(len(t), -1, np.int64)
    place[lms] = np.arange(len(lms))
    length = np.append(np.diff(lms) + 1, 1)         # up to and with the next one's first item
    at = place[in_order]
    same = _equal_neighbours(t, in_order.astype(np.int64), length[at])
    name = np.cumsum(~same) - 1
    out = np.empty(len(lms), np.int64)
    out[at] = name
    return out, int(name[-1]) + 1


def _order_names(names: np.ndarray, n_names: int) -> np.ndarray:
    """Suffix order of the string of names, by recursion on pairs: a name and
    the one ``step`` behind it are renamed together, and ``step`` doubles, for
    the names that still repeat."""
    m = len(names)
    count = np.bincount(names, minlength=n_names)
    rank = (np.cumsum(count) - count)[names]        # a repeated name: the first place of its bucket
    active, step = np.flatnonzero(count[names] > 1), 1
    while len(active):
        after = active + step
        second = np.where(after < m, rank[np.minimum(after, m - 1)] + 1, 0)
        key = rank[active] * (m + 1) + second
        o = np.argsort(key, kind="stable")
        key, active = key[o], active[o]
        old, place = rank[active], np.arange(len(active))
        new = np.concatenate(([True], key[1:] != key[:-1]))
        bucket = np.concatenate(([True], old[1:] != old[:-1]))
        rank[active] = old + np.maximum.accumulate(np.where(new, place, 0)) - np.maximum.accumulate(np.where(bucket, place, 0))
        active = active[~(new & np.append(new[1:], True))]
        step *= 2
    order = np.empty(m, np.int64)
    order[rank] = np.arange(m)
    return order


def _sort(t: np.ndarray, k: int) -> np.ndarray:
    """Suffix array of ``t``, whose last item is 0 and occurs only there."""
    n = len(t)
    if n == 1:
        return np.zeros(1, np.int32)
    is_s = s_types(t)
    lms = np.flatnonzero(is_s[1:] & ~is_s[:-1]) + 1
    found = _induce_bytes(t, is_s, lms, k)
    leftmost = np.zeros(n, bool)
    leftmost[lms] = True
    in_order = found[leftmost[found]]
    names, n_names = _names(t, lms, in_order)
    if n_names < len(lms):
        in_order = lms[_order_names(names, n_names)]
    return _induce_bytes(t, is_s, in_order, k)


def suffix_array(t: np.ndarray) -> np.ndarray:
    """Suffix array of non-negative items below 511; a unique smaller item is
    put behind them for the sort and left out of the result."""
    if not len(t):
        return np.empty(0, np.int32)
    s = np.append(t.astype(np.int16) + 1, np.int16(0))
    return _sort(s, int(s.max()) + 1)[1:]


def permuted_lcp(t: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(before, lcp) by place in the text: the suffix before a place's in the
    suffix array (-1 for the first), and their common prefix.

    Where the items before a suffix and before its predecessor are equal, the
    common prefix is one less than that of the place before; only the other
    places are compared, eight bytes at a time."""
    n = len(order)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    place = np.arange(n)
    has = before >= 0
    follows = has & (place > 0) & (before > 0)
    follows[follows] = t[place[follows] - 1] == t[before[follows] - 1]
    todo = np.flatnonzero(has & ~follows)
    lcp = np.zeros(n, np.int64)
    padded = np.concatenate((t, np.zeros(8, t.dtype)))
    a, b, got = todo.copy(), before[todo], np.zeros(len(todo), np.int64)
    live = np.arange(len(todo))
    offsets = np.arange(8)
    while len(live):
        x, y = a[live] + got[live], b[live] + got[live]
        room = np.minimum(8, n - np.maximum(x, y))
        ix, iy = np.minimum(x, n)[:, None] + offsets, np.minimum(y, n)[:, None] + offsets
        differs = padded[ix] != padded[iy]
        run = np.where(differs.any(axis=1), differs.argmax(axis=1), 8)
        run = np.minimum(run, room)
        got[live] += run
        live = live[(run == 8)]
    lcp[todo] = got
    # the rest, from the last compared place before each
    last = np.maximum.accumulate(np.where(follows, 0, place))
    rest = np.flatnonzero(follows)
    lcp[rest] = np.maximum(0, lcp[last[rest]] - (rest - last[rest]))
    return before, lcp
