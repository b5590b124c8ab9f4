"""Suffix arrays by induced sorting, in array steps, and their common prefixes.

Symbols are small integers. A suffix is S if it is smaller than the next one, else L; leftmost S
suffixes (an L before them) are sorted as substrings by one round of inducing, named, and the string of
names is sorted recursively; a second round induces the order of all suffixes. A round goes through the
buckets of the alphabet; what a bucket's entries induce is placed by whole arrays, once per run of equal
symbols. Strings of names with more than ``MAX_BUCKETS`` symbols would need a step for almost every
entry, so the recursion ends there and ranks are doubled instead.
"""

from __future__ import annotations

import numpy as np

MAX_BUCKETS = 1024


def _types(s: np.ndarray) -> np.ndarray:
    """True for S; the last symbol is a unique smallest one and S."""
    n = len(s)
    rises = np.empty(n, bool)
    rises[:-1] = s[:-1] < s[1:]
    rises[-1] = True
    decided = np.ones(n, bool)
    decided[:-1] = s[:-1] != s[1:]
    # equal neighbours have the type of the next place that differs
    at = np.where(decided, np.arange(n), n)
    return rises[np.minimum.accumulate(at[::-1])[::-1]]


def _induce(s: np.ndarray, small: np.ndarray, lms: np.ndarray, symbols: int) -> np.ndarray:
    """Order of all suffixes from leftmost S suffixes in (supposed) order."""
    n = len(s)
    sizes = np.bincount(s, minlength=symbols)
    ends = np.cumsum(sizes)
    begins = ends - sizes
    sa = np.full(n, -1, np.int64)
    first = s[lms]
    order = np.argsort(first, kind="stable")
    seeds = np.bincount(first, minlength=symbols)
    before = np.cumsum(seeds) - seeds
    sa[ends[first[order]] - seeds[first[order]] + np.arange(len(lms)) - before[first[order]]] = lms[order]
    used = np.flatnonzero(sizes)

    def place(entries: np.ndarray, want: bool, edge: np.ndarray, step: int) -> None:
        p = entries[entries > 0] - 1
        p = p[small[p] == want]
        if not len(p):
            return
        c = s[p]
        order = np.argsort(c, kind="stable")
        p, c = p[order], c[order]
        counts = np.bincount(c, minlength=symbols)
        rank = np.arange(len(p)) - (np.cumsum(counts) - counts)[c]
        if step > 0:
            sa[edge[c] + rank] = p
            edge += counts
        else:
            sa[edge[c] - 1 - rank] = p
            edge -= counts

    heads = begins.copy()
    for c in used:
        done = begins[c]
        while done < heads[c]:
            now, done = sa[done : heads[c]], heads[c]
            place(now, False, heads, 1)
        if seeds[c]:
            place(sa[ends[c] - seeds[c] : ends[c]], False, heads, 1)
    tails = ends.copy()
    sa[0] = n - 1  # the last symbol's suffix is induced by nothing
    tails[s[-1]] -= 1
    for c in used[::-1]:
        done = ends[c]
        if c == s[-1]:
            place(sa[:1], True, tails, -1)
            done = tails[c]
        while done > tails[c]:
            now, done = sa[tails[c] : done][::-1].copy(), tails[c]
            place(now, True, tails, -1)
        if heads[c] > begins[c]:
            place(sa[begins[c] : heads[c]][::-1], True, tails, -1)
    return sa


def _double(ranks: np.ndarray) -> np.ndarray:
    """Suffix order of distinct-enough names by doubling the compared length."""
    n, k = len(ranks), 1
    ranks = np.unique(ranks, return_inverse=True)[1].astype(np.int64)
    while True:
        second = np.zeros(n, np.int64)
        if k < n:
            second[:-k] = ranks[k:] + 1
        key = ranks * (n + 2) + second
        order = np.argsort(key, kind="stable")
        new = np.cumsum(np.diff(key[order], prepend=key[order[0]]) != 0)
        if new[-1] == n - 1:
            return order
        ranks[order] = new
        k *= 2


def _same_substrings(s: np.ndarray, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Whether s[a : a + length] equals s[b : b + length], element by element of the arrays."""
    same = np.ones(len(a), bool)
    live, k = np.arange(len(a)), 0
    while len(live):
        equal = s[a[live] + k] == s[b[live] + k]
        same[live[~equal]] = False
        live = live[equal]
        k += 1
        live = live[length[live] > k]
    return same


def suffix_array(s: np.ndarray, symbols: int) -> np.ndarray:
    """Order of the suffixes of ``s``, whose last symbol must be its only 0."""
    n = len(s)
    if n < 3:
        return np.arange(n)[::-1].copy()
    if symbols > MAX_BUCKETS:
        return _double(s)
    small = _types(s)
    lms = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    if len(lms) > 1:
        induced = _induce(s, small, lms, symbols)
        is_lms = np.zeros(n, bool)
        is_lms[lms] = True
        ordered = induced[is_lms[induced]]
        end = np.full(n, n - 1)
        end[lms[:-1]] = lms[1:]
        length = end[ordered] - ordered + 1
        equal = length[1:] == length[:-1]
        at = np.flatnonzero(equal)
        equal[at] = _same_substrings(s, ordered[at], ordered[at + 1], length[at])
        names = np.concatenate([[0], np.cumsum(~equal)])
        name = np.empty(n, np.int64)
        name[ordered] = names
        if names[-1] + 1 < len(lms):
            lms = lms[suffix_array(name[lms], int(names[-1]) + 1)]
        else:
            lms = ordered
    return _induce(s, small, lms, symbols)


def permuted_lcp(s: np.ndarray, sa: np.ndarray, stop: int) -> np.ndarray:
    """By place in the text, the symbols shared with the preceding suffix in order, up to any symbol <= ``stop``.

    Where the symbols before both suffixes agree, the value is one less than at the place before; the
    others are compared symbol by symbol, all at once.
    """
    n = len(s)
    before = np.full(n, n - 1)
    before[sa[1:]] = sa[:-1]
    carried = np.zeros(n, bool)
    i = np.arange(1, n)
    carried[1:] = (before[1:] > 0) & (s[i - 1] == s[before[1:] - 1]) & (s[i - 1] > stop) & (before[:-1] == before[1:] - 1)
    out = np.zeros(n, np.int64)
    live, k = np.flatnonzero(~carried), 0
    live = live[live != sa[0]]
    while len(live):
        a, b = live + k, before[live] + k
        inside = (a < n) & (b < n)
        live, a, b = live[inside], a[inside], b[inside]
        live = live[(s[a] == s[b]) & (s[a] > stop)]
        k += 1
        out[live] = k
    base = np.maximum.accumulate(np.where(carried, 0, np.arange(n)))
    return np.maximum(out[base] - (np.arange(n) - base), 0)
