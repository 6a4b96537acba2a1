"""Suffix arrays by induced sorting, and permuted common prefixes.

The text is an array of small integers that ends in a unique 0. Suffixes are classified S or L; the substrings
between leftmost S positions are sorted by their letters, named, and, where names repeat, sorted by the same
method on the string of names; an induction then gives all suffixes. Induction goes bucket by bucket: all entries
of a bucket that are known at a time are handled in one vector step, so the cost is linear and the steps follow
the alphabet and the longest run of one letter. Strings of names have large alphabets; those take plain loops.
"""

from __future__ import annotations

import numpy as np

#: Value that no common prefix crosses.
SEPARATOR = 1


def _types(s: np.ndarray) -> np.ndarray:
    """True where the suffix is S: smaller than its successor."""
    n = len(s)
    d = np.sign(s[1:].astype(np.int64) - s[:-1])
    nxt = np.where(d != 0, np.arange(n - 1), n - 1)
    nxt = np.minimum.accumulate(nxt[::-1])[::-1]
    t = np.ones(n, bool)
    inside = nxt < n - 1
    t[:-1][inside] = d[nxt[inside]] > 0
    t[:-1][~inside] = False
    return t


def _induce(s: np.ndarray, t: np.ndarray, k: int, lms: np.ndarray) -> np.ndarray:
    """Sort all suffixes from LMS positions given in the order that they shall have within their buckets."""
    n = len(s)
    sizes = np.bincount(s, minlength=k)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    sa = np.full(n, -1, np.int64)
    # LMS suffixes by bucket, in the order given
    order = np.argsort(s[lms], kind="stable")
    by = lms[order]
    first = np.searchsorted(s[by], np.arange(k + 1))
    head = starts.copy()

    def put_left(p: np.ndarray) -> None:
        c = s[p]
        o = np.argsort(c, kind="stable")
        c = c[o]
        new = np.flatnonzero(np.diff(c, prepend=-1))
        count = np.diff(np.append(new, len(c)))
        sa[head[c] + np.arange(len(c)) - np.repeat(new, count)] = p[o]
        head[c[new]] += count

    for c in range(k):
        at = starts[c]
        while at < head[c]:
            wave = sa[at : head[c]]
            at = head[c]
            p = wave[wave > 0] - 1
            p = p[~t[p]]
            if len(p):
                put_left(p)
        wave = by[first[c] : first[c + 1]]
        p = wave[wave > 0] - 1
        p = p[~t[p]]
        if len(p):
            put_left(p)
    tail = ends.copy()

    def put_right(p: np.ndarray) -> None:
        c = s[p]
        o = np.argsort(c, kind="stable")
        c = c[o]
        new = np.flatnonzero(np.diff(c, prepend=-1))
        count = np.diff(np.append(new, len(c)))
        sa[tail[c] - 1 - (np.arange(len(c)) - np.repeat(new, count))] = p[o]
        tail[c[new]] -= count

    for c in range(k - 1, -1, -1):
        at = ends[c]
        while at > tail[c]:
            wave = sa[tail[c] : at][::-1]
            at = tail[c]
            p = wave[wave > 0] - 1
            p = p[t[p]]
            if len(p):
                put_right(p)
        wave = sa[starts[c] : head[c]][::-1]
        p = wave[wave > 0] - 1
        p = p[t[p]]
        if len(p):
            put_right(p)
    sa[0] = n - 1
    return sa


def _induce_plain(s: list[int], t: list[bool], k: int, lms: list[int]) -> list[int]:
    n = len(s)
    sizes = [0] * k
    for c in s:
        sizes[c] += 1
    starts, ends, at = [0] * k, [0] * k, 0
    for c in range(k):
        starts[c] = at
        at += sizes[c]
        ends[c] = at
    sa, tail = [-1] * n, ends[:]
    for j in reversed(lms):
        c = s[j]
        tail[c] -= 1
        sa[tail[c]] = j
    head = starts[:]
    for i in range(n):
        j = sa[i] - 1
        if j >= 0 and not t[j]:
            c = s[j]
            sa[head[c]] = j
            head[c] += 1
    tail = ends[:]
    for i in range(n - 1, -1, -1):
        j = sa[i] - 1
        if j >= 0 and t[j]:
            c = s[j]
            tail[c] -= 1
            sa[tail[c]] = j
    sa[0] = n - 1
    return sa


def _names(s: np.ndarray, t: np.ndarray, k: int, lms: np.ndarray) -> tuple[np.ndarray, int]:
    """Names of the LMS substrings in text order, by their order; equal substrings share one. Number of names.

    Letters are compared with their types, so no substring is the beginning of another. As many letters as fit a word are
    compared at a time, and only where the letters before are equal.
    """
    n = len(s)
    key = 2 * s.astype(np.int64) + t + 1  # 0 stands behind the end
    bits = int(2 * k + 1).bit_length()
    step = 62 // bits
    length = np.append(lms[1:], n - 1) - lms + 1

    def packed(of: np.ndarray, d: int) -> np.ndarray:
        out = np.zeros(len(of), np.int64)
        for j in range(d, d + step):
            out = out << bits | np.where(j < length[of], key[np.minimum(lms[of] + j, n - 1)], 0)
        return out

    every = np.arange(len(lms))
    word = packed(every, 0)
    order = np.argsort(word, kind="stable")
    word = word[order]
    new = np.ones(len(lms), bool)
    new[1:] = word[1:] != word[:-1]
    d = step
    while True:
        group = np.cumsum(new) - 1
        size = np.bincount(group)
        slots = np.flatnonzero((size[group] > 1) & (length[order] > d))
        if not len(slots):
            break
        word = packed(order[slots], d)
        by = np.lexsort((word, group[slots]))
        order[slots] = order[slots][by]
        word = word[by]
        # Slots of a group follow each other, before and after.
        differ = np.flatnonzero((word[1:] != word[:-1]) & (group[slots[1:]] == group[slots[:-1]])) + 1
        new[slots[differ]] = True
        d += step
    out = np.empty(len(lms), np.int64)
    out[order] = np.cumsum(new) - 1
    return out, int(new.sum())


def suffix_array(s: np.ndarray, k: int) -> np.ndarray:
    """Positions of the suffixes of s in order; s ends in a unique 0, and its values are below k."""
    n = len(s)
    if n == 1:
        return np.zeros(1, np.int64)
    t = _types(s)
    lms = np.flatnonzero(t[1:] & ~t[:-1]) + 1
    plain = k > max(1024, n // 64)
    if plain:
        sl, tl = s.tolist(), t.tolist()
        induce = lambda order: np.asarray(_induce_plain(sl, tl, k, order.tolist()), np.int64)
    else:
        induce = lambda order: _induce(s, t, k, order)
    names, count = _names(s, t, k, lms)
    order = lms[np.argsort(names)] if count == len(lms) else lms[suffix_array(names, count)]
    return induce(order)


def permuted_prefixes(s: np.ndarray, sa: np.ndarray) -> np.ndarray:
    """For each position, the length it shares with the suffix before it in order; never across a SEPARATOR.

    Values are compared only where the letters before differ; elsewhere the value is one less than its left neighbour's.
    """
    n = len(s)
    phi = np.full(n, -1, np.int64)
    phi[sa[1:]] = sa[:-1]
    before_i = np.empty(n, s.dtype)
    before_i[0] = 0
    before_i[1:] = s[:-1]
    before_p = np.where(phi > 0, s[np.maximum(phi, 1) - 1], 0)
    own = (before_i != before_p) | (before_i <= SEPARATOR) | (phi <= 0)
    own[0] = True
    at = np.flatnonzero(own)
    out = np.zeros(n, np.int64)
    live = at[phi[at] >= 0]
    d = 0
    while len(live):
        x = s[np.minimum(live + d, n - 1)]
        live = live[(x == s[np.minimum(phi[live] + d, n - 1)]) & (x > SEPARATOR)]
        d += 1
        out[live] = d
    last = np.maximum.accumulate(np.where(own, np.arange(n), 0))
    return np.where(own, out, np.maximum(out[last] - (np.arange(n) - last), 0))
