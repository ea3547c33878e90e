"""A sequence as a run-length grammar by recompression, and how far it goes on alike from two places.

Rounds alternate. Block compression replaces every maximal block of one symbol by a symbol of its own; pair
compression flips a coin for each symbol and replaces every pair of a heads and a tails symbol. Both look at a
symbol and its neighbours only, so equal stretches are parsed alike but for their rims. That makes extensions
exact and cheap: climb while both places hold the same symbol, go down where they part. Each takes a step a level.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_MIX = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class _Level:
    """A string of the grammar, and how the next one groups it."""

    symbols: np.ndarray
    begins: np.ndarray | None = None  # of each symbol of the next level: its first symbol here
    ends: np.ndarray | None = None  # and its last
    parents: np.ndarray | None = None
    blocks: bool = False


def _heads(symbols: np.ndarray, salt: int) -> np.ndarray:
    x = (symbols.astype(np.uint64) + np.uint64(salt)) * _MIX
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return (x >> np.uint64(63)).astype(bool)


class Grammar:
    """The grammar of ``symbols`` (non-negative); the first and the last must be found nowhere else."""

    def __init__(self, symbols: np.ndarray):
        s = symbols.astype(np.int64)
        free, salt = int(s.max(initial=0)) + 1, 0
        self.levels = [_Level(s)]
        while len(s) > 1:
            changed = np.concatenate([[True], s[1:] != s[:-1]])
            blocks = not changed.all()
            if blocks:
                begins = np.flatnonzero(changed)
            else:
                heads, salt = _heads(s, salt), salt + 1
                second = np.concatenate([[False], heads[:-1] & ~heads[1:]])
                if not second.any():
                    continue
                begins = np.flatnonzero(~second)
            ends = np.append(begins[1:], len(s)) - 1
            above = s[begins]
            many = np.flatnonzero(ends > begins)
            # a block is named by symbol and size, a pair by its two symbols
            rest = (ends - begins)[many] if blocks else s[ends[many]]
            _, names = np.unique(above[many] << 32 | rest, return_inverse=True)
            above[many] = free + names
            free += int(names.max()) + 1
            parents = np.repeat(np.arange(len(begins)), ends - begins + 1)
            level = self.levels[-1]
            level.begins, level.ends, level.parents, level.blocks = begins, ends, parents, blocks
            s = above
            self.levels.append(_Level(s))

    def alike(self, i: np.ndarray, j: np.ndarray, step: int) -> np.ndarray:
        """How many symbols are equal from each i and j (i < j) on, to the right (step 1) or left (-1)."""
        a, b = i.astype(np.int64), j.astype(np.int64)
        parted = np.zeros(len(a), np.int64)  # the level on which a and b hold different symbols
        going = np.arange(len(a))
        for k, level in enumerate(self.levels):
            s = level.symbols
            going = going[_stay(parted, going, s[a[going]] == s[b[going]], k)]
            if not len(going):
                break
            # both must stand at the rim of their parents; one symbol or the rest of a block leads there
            rims = level.begins if step > 0 else level.ends
            x, y = a[going], b[going]
            px, py = level.parents[x], level.parents[y]
            off = np.flatnonzero((rims[px] != x) | (rims[py] != y))
            if len(off):
                x, y, px, py, who = x[off], y[off], px[off], py[off], going[off]
                hop = 1
                if level.blocks:
                    far = level.ends if step > 0 else level.begins
                    hop = np.minimum(np.abs(far[px] - x), np.abs(far[py] - y)) + 1
                a[who], b[who] = x + step * hop, y + step * hop
                held = np.ones(len(going), bool)
                held[off] = _stay(parted, who, s[a[who]] == s[b[who]], k)
                going = going[held]
            a[going], b[going] = level.parents[a[going]], level.parents[b[going]]
        for k in range(len(self.levels) - 1, 0, -1):
            who = np.flatnonzero(parted >= k)
            if not len(who):
                continue
            level, x, y = self.levels[k - 1], a[who], b[who]
            rims = level.begins if step > 0 else level.ends
            down_x, down_y = rims[x], rims[y]
            hop = np.minimum(level.ends[x] - level.begins[x], level.ends[y] - level.begins[y]) + 1 if level.blocks else 1
            hop = step * hop * (level.symbols[down_x] == level.symbols[down_y])
            a[who], b[who] = down_x + hop, down_y + hop
        return np.abs(a - i)


def _stay(parted: np.ndarray, who: np.ndarray, same: np.ndarray, level: int) -> np.ndarray:
    parted[who[~same]] = level
    return same
