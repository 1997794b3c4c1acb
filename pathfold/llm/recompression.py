"""A run-length grammar by recompression, and longest common extensions on it.

A sequence of numbers is rewritten round by round.  A block round replaces every
maximal run of one symbol by a symbol for (symbol, length).  A pair round splits
the symbols into two classes and replaces every first-class symbol with a
second-class one behind it by a symbol for the pair.  Equal stretches are rewritten
alike except near their ends, so two positions are compared by going up while both
are at the beginning of a symbol, stepping over equal symbols, and down again
where symbols differ: a number of steps that grows with the number of rounds, not
with the length.

All queries of a call are answered together, by array operations per round.
"""
from __future__ import annotations

import numpy as np

_CLASS = np.uint64(0x9E3779B97F4A7C15)


def _named(first: np.ndarray, second: np.ndarray, names: int) -> tuple[np.ndarray, int]:
    """New symbols, from ``names`` on, for pairs; equal pairs get the same."""
    code = first.astype(np.int64) * (int(second.max(initial=0)) + 1) + second
    distinct, inverse = np.unique(code, return_inverse=True)
    return (inverse + names).astype(np.int64), names + len(distinct)


class Round:
    """The sequence of a round: symbols, how many words each stands for, and
    where each one's children begin in the sequence below."""

    __slots__ = ("symbols", "sizes", "first", "parent", "ahead", "behind")

    def __init__(self, symbols: np.ndarray, sizes: np.ndarray, first: np.ndarray | None):
        self.symbols, self.sizes, self.first = symbols, sizes, first
        self.parent = None  # of each symbol, in the sequence above
        n = len(symbols)
        new = np.flatnonzero(np.concatenate([[True], symbols[1:] != symbols[:-1]]))
        length = np.diff(np.append(new, n))
        at = np.arange(n) - np.repeat(new, length)
        self.behind = at + 1                         # equal symbols up to this one, itself included
        self.ahead = np.repeat(length, length) - at  # and from it on


class Grammar:
    """The rounds of ``words``, whose last number must occur nowhere else in it."""

    def __init__(self, words: np.ndarray):
        n = len(words)
        self.rounds = [Round(np.asarray(words, dtype=np.int64), np.ones(n, dtype=np.int64), None)]
        names, k = int(words.max(initial=0)) + 1, 0
        while len(self.rounds[-1].symbols) > 4 and k < 400:
            below = self.rounds[-1]
            if k % 2 == 0:
                start = below.behind == 1
                if start.all():  # no two equal neighbours: nothing to do in this round
                    k += 1
                    continue
                heads = np.flatnonzero(start)
                symbols, many = below.symbols[heads].copy(), below.ahead[heads] > 1
                symbols[many], names = _named(below.symbols[heads][many], below.ahead[heads][many], names)
            else:
                left = ((below.symbols.astype(np.uint64) + np.uint64(k)) * _CLASS >> np.uint64(40 + k % 16)) & np.uint64(1) == 1
                pair = np.zeros(len(left), dtype=bool)
                pair[:-1] = left[:-1] & ~left[1:]
                if not pair.any():
                    k += 2
                    continue
                start = np.ones(len(left), dtype=bool)
                start[1:] = ~pair[:-1]
                heads = np.flatnonzero(start)
                symbols, two = below.symbols[heads].copy(), pair[heads]
                symbols[two], names = _named(below.symbols[heads][two], below.symbols[heads[two] + 1], names)
            below.parent = np.cumsum(start) - 1
            self.rounds.append(Round(symbols, np.add.reduceat(below.sizes, heads), heads))
            k += 1

    def common(self, a: np.ndarray, b: np.ndarray, back: bool = False) -> np.ndarray:
        """For each pair of different positions a, b: how many words from them on
        (or up to them, ``back``) are equal.  Positions may be -1 with ``back``."""
        a, b = np.asarray(a, dtype=np.int64).copy(), np.asarray(b, dtype=np.int64).copy()
        out = np.zeros(len(a), dtype=np.int64)
        at = np.zeros(len(a), dtype=np.int64)   # the round in which a pair stopped going up
        going = np.arange(len(a))
        step = -1 if back else 1

        def stepped(level, who):
            """Over equal symbols as far as both repeat them; who is stepped, and whether it may go on."""
            x, y = a[who], b[who]
            there = (x >= 0) & (y >= 0)
            same = there.copy()
            same[there] = level.symbols[x[there]] == level.symbols[y[there]]
            who, x, y = who[same], x[same], y[same]
            runs = level.behind if back else level.ahead
            n, m = runs[x], runs[y]
            over = np.minimum(n, m)
            out[who] += over * level.sizes[x]
            a[who] += step * over
            b[who] += step * over
            return same, who[n == m]

        for height, level in enumerate(self.rounds):
            at[going] = height
            if level.parent is None:
                break
            up = []
            edge = np.concatenate([[False], level.parent[1:] == level.parent[:-1]])  # not at a symbol's beginning
            if back:
                edge = np.append(edge[1:], False)
            while len(going):
                inside = (a[going] >= 0) & (b[going] >= 0)
                x, y = a[going], b[going]
                inside[inside] = edge[x[inside]] | edge[y[inside]]
                ready = (x >= 0) & (y >= 0) & ~inside
                up.append(going[ready])
                _, going = stepped(level, going[~ready])
            if not up:
                break
            going = np.concatenate(up)
            a[going], b[going] = level.parent[a[going]], level.parent[b[going]]
        for height in range(len(self.rounds) - 1, -1, -1):
            level = self.rounds[height]
            who = np.flatnonzero(at >= height)
            while len(who):
                _, who = stepped(level, who)
            if height:
                below = self.rounds[height - 1]
                ends = np.append(level.first[1:], len(below.symbols)) - 1
                who = np.flatnonzero((at >= height) & (a >= 0) & (b >= 0))
                child = ends if back else level.first
                a[who], b[who] = child[a[who]], child[b[who]]
        return out
