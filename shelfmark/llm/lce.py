"""Longest common extensions between suffixes of an integer sequence, by a difference cover.

A cover D of the residues modulo v holds, for any two residues, a shift that
takes both into D. Only suffixes at positions of D are sorted. A query compares
the at most v numbers before both positions reach D, and from there reads the
common prefix of two sorted suffixes as a range minimum in a sparse table.
"""

from __future__ import annotations

from functools import cache

import numpy as np

#: Numbers compared at once.
CHUNK = 16


@cache
def cover(v: int) -> tuple[np.ndarray, np.ndarray]:
    """(sorted cover D of the residues modulo v, shift[a, b] with a + shift and b + shift both in D).

    With r near the root of v, 0..r-1 and the multiples of r differ by every residue.
    """
    r = int(np.ceil(np.sqrt(v)))
    members = np.unique(np.concatenate([np.arange(r), np.arange(r, v + r, r) % v]))
    inside = np.zeros(v, bool)
    inside[members] = True
    shift = np.full((v, v), -1, np.int16)
    residues = np.arange(v)
    for s in range(v - 1, -1, -1):
        hit = inside[(residues + s) % v]
        shift[np.ix_(hit, hit)] = s
    return members, shift


class Extensions:
    """`numbers` (not negative) prepared for queries; the last number must stand nowhere else."""

    def __init__(self, numbers: np.ndarray):
        self.size = len(numbers)
        self.v = 64 if self.size < 1 << 20 else 256
        self.members, self.shift = cover(self.v)
        top = int(numbers.max(initial=0)) + 1
        # numbers of their own behind the end, so that comparisons need no bounds
        self.numbers = np.concatenate([numbers, np.arange(top, top + 2 * self.v + CHUNK)]).astype(np.int64)
        self._sort()

    def _sample(self, positions: np.ndarray) -> np.ndarray:
        """Places of sampled positions among all sampled ones."""
        return positions // self.v * len(self.members) + np.searchsorted(self.members, positions % self.v)

    def _sort(self) -> None:
        v, base = self.v, int(self.numbers.max()) + 1
        at = (np.arange(self.size // v + 1)[:, None] * v + self.members).ravel()
        at = at[at < self.size]
        # the first v numbers by one name, as many at once as fit a 64-bit key
        names, i = np.zeros(len(at), np.int64), 0
        while i < v:
            keys, room = names, int(names.max(initial=0)) + 1
            while i < v and room <= (1 << 62) // base:
                keys, room, i = keys * base + self.numbers[at + i], room * base, i + 1
            names = np.unique(keys, return_inverse=True)[1]
        # doubling: the name of twice as many numbers from two names
        levels, span = [names.astype(np.int32)], v
        while len(names) and int(names.max()) + 1 < len(names):
            later = at + span
            there = later < self.size
            second = np.zeros(len(at), np.int64)
            second[there] = names[self._sample(later[there])] + 1
            names = np.unique(names * (len(at) + 1) + second, return_inverse=True)[1]
            levels.append(names.astype(np.int32))
            span *= 2
        self.rank = names.astype(np.int32)
        order = np.empty(len(at), np.int64)
        order[names] = at
        self.minima = [self._common(order[:-1], order[1:], levels).astype(np.int32)]
        while len(self.minima[-1]) > (step := 1 << (len(self.minima) - 1)):
            before = self.minima[-1]
            self.minima.append(np.minimum(before[:-step], before[step:]))

    def _common(self, a: np.ndarray, b: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
        """Common prefixes of sampled suffixes, from the names of ever shorter pieces."""
        total = np.zeros(len(a), np.int64)
        for k in range(len(levels) - 1, -1, -1):
            x, y = a + total, b + total
            fits = np.flatnonzero((x < self.size) & (y < self.size))
            same = fits[levels[k][self._sample(x[fits])] == levels[k][self._sample(y[fits])]]
            total[same] += self.v << k
        return total + self._compare(a + total, b + total, np.full(len(a), self.v, np.int64))

    def _compare(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Equal numbers from a and b on, counted up to `most`."""
        total = np.zeros(len(a), np.int64)
        steps = np.arange(CHUNK)
        open_ = np.flatnonzero(most > 0)
        while len(open_):
            x, y = (a[open_] + total[open_])[:, None] + steps, (b[open_] + total[open_])[:, None] + steps
            differs = self.numbers[x] != self.numbers[y]
            run = np.where(differs.any(axis=1), differs.argmax(axis=1), CHUNK)
            total[open_] += run
            open_ = open_[(run == CHUNK) & (total[open_] < most[open_])]
        return np.minimum(total, most)

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the longest common prefix of the suffixes at a and b, pair by pair; a and b differ."""
        shift = self.shift[a % self.v, b % self.v].astype(np.int64)
        total = self._compare(a, b, shift)
        on = np.flatnonzero((total == shift) & (a + shift < self.size) & (b + shift < self.size))
        if len(on):
            x = self.rank[self._sample(a[on] + shift[on])]
            y = self.rank[self._sample(b[on] + shift[on])]
            low, high = np.minimum(x, y), np.maximum(x, y)
            level = np.frexp((high - low).astype(np.float64))[1] - 1
            found = np.empty(len(on), np.int64)
            for k in np.unique(level):
                own = level == k
                table = self.minima[k]
                found[own] = np.minimum(table[low[own]], table[high[own] - (1 << k)])
            total[on] += found
        return total
