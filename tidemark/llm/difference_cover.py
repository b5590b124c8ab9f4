"""Longest common extensions of word sequences by a difference cover.

Of all suffixes only those at positions whose remainder by ``PERIOD`` lies in the cover are sorted: first by
their first PERIOD words, then by doubling, where the suffix PERIOD words further on is sampled as well.  For any
two positions some step below PERIOD leads to two sampled ones, so an extension compares a few words and then asks
a sparse table for the least common prefix between the two ranks.
"""

from __future__ import annotations

import numpy as np

PERIOD = 31


def cover(period: int) -> np.ndarray:
    """A small set of remainders whose differences give every remainder, chosen greedily."""
    chosen, missing = [0, 1], set(range(period)) - {0, 1, period - 1}
    while missing:
        gain = [len(missing & {d for c in chosen for d in ((x - c) % period, (c - x) % period)}) for x in range(period)]
        chosen.append(int(np.argmax(gain)))
        missing -= {(a - b) % period for a in chosen for b in chosen}
    return np.array(sorted(chosen))


COVER = cover(PERIOD)


def _steps() -> np.ndarray:
    """By two remainders: the least step that takes both into the cover."""
    inside = np.zeros(PERIOD, bool)
    inside[COVER] = True
    step = np.arange(PERIOD)
    both = inside[(np.arange(PERIOD)[:, None, None] + step) % PERIOD] & inside[(np.arange(PERIOD)[None, :, None] + step) % PERIOD]
    return both.argmax(axis=2)


STEPS = _steps()


def _ranks(*keys: np.ndarray) -> np.ndarray:
    """Dense ranks of rows of keys, the first the most significant."""
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    for key in keys:
        new[1:] |= key[order][1:] != key[order][:-1]
    ranks = np.empty(len(order), np.int64)
    ranks[order] = np.cumsum(new)
    return ranks


class Extensions:
    """``words`` are integers; equal words at two positions of different texts must not be asked for.

    Whoever joins texts puts a number that occurs nowhere else after each of them.
    """

    def __init__(self, words: np.ndarray):
        n = len(words)
        top = int(words.max(initial=0)) + 1
        # past the end every position differs from every other
        self.words = np.concatenate([words, np.arange(top, top + 2 * PERIOD)]).astype(np.int64)
        at = np.arange(0, n + PERIOD)
        self.sampled = at[np.isin(at % PERIOD, COVER)]
        self.place = np.full(n + 2 * PERIOD, -1, np.int64)
        self.place[self.sampled] = np.arange(len(self.sampled))
        self.table: list[np.ndarray] | None = None  # sorted once a step is reached

    def _sort(self) -> None:
        s, wide = self.sampled, 1 << 21
        keys = [self.words[np.minimum(s + k, len(self.words) - 1)] for k in range(PERIOD)]
        if len(self.words) and self.words.max() < wide:  # three words a key
            keys = [sum(key << (21 * (2 - j)) for j, key in enumerate(keys[k : k + 3])) for k in range(0, PERIOD, 3)]
        ranks, span, levels = _ranks(*keys), PERIOD, []
        while True:
            levels.append((span, ranks))
            if not len(ranks) or ranks.max() == len(ranks) - 1:
                break
            ranks = _ranks(ranks, self._rank_at(ranks, s + span))
            span *= 2
        order = np.empty(len(s), np.int64)
        order[ranks] = np.arange(len(s))
        self.rank = ranks
        self.table = self._table(self._common(s[order[:-1]], s[order[1:]], levels))

    def _rank_at(self, ranks: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Ranks of sampled positions; those past the end are below all others."""
        inside = at < len(self.place)
        place = np.where(inside, self.place[np.where(inside, at, 0)], -1)
        return np.where(place >= 0, ranks[place], -1 - np.maximum(at, 0) * (place < 0))

    def _common(self, a: np.ndarray, b: np.ndarray, levels) -> np.ndarray:
        """Common prefixes of pairs of sampled suffixes, by equal ranks from long spans to short ones."""
        length = np.zeros(len(a), np.int64)
        for span, ranks in reversed(levels):
            same = self._rank_at(ranks, a + length) == self._rank_at(ranks, b + length)
            length += np.where(same, span, 0)
        return length + self._compared(a + length, b + length, np.full(len(a), PERIOD))

    def _compared(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Equal words from a and b on, at most ``most``."""
        length, open_ = np.zeros(len(a), np.int64), np.arange(len(a))
        last = len(self.words) - 1
        for step in range(int(most.max(initial=0))):
            open_ = open_[most[open_] > step]
            x, y = a[open_] + step, b[open_] + step
            open_ = open_[(self.words[np.minimum(x, last)] == self.words[np.minimum(y, last)]) & (x <= last) & (y <= last)]
            if not len(open_):
                break
            length[open_] = step + 1
        return length

    @staticmethod
    def _table(common: np.ndarray) -> list[np.ndarray]:
        table, half = [common], 1
        while 2 * half <= len(common):
            table.append(np.minimum(table[-1][:-half], table[-1][half:]))
            half *= 2
        return table

    def least(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Least common prefix between ranks low < high."""
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        found = np.empty(len(low), np.int64)
        for k in np.unique(level):
            here = level == k
            found[here] = np.minimum(self.table[k][low[here]], self.table[k][high[here] - (1 << int(k))])
        return found

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words from a and b (a <> b) on are equal."""
        step = STEPS[a % PERIOD, b % PERIOD]
        length = self._compared(a, b, step)
        more = np.flatnonzero(length == step)
        if len(more):
            if self.table is None:
                self._sort()
            x = self.rank[self.place[a[more] + step[more]]]
            y = self.rank[self.place[b[more] + step[more]]]
            length[more] += self.least(np.minimum(x, y), np.maximum(x, y))
        return length
