"""Run-length grammars of word sequences by recompression, with longest common extensions over them.

Levels alternate: block compression replaces each maximal repetition of one symbol by one symbol, pair compression replaces
a symbol of the left half of the alphabet followed by one of the right half by one symbol. A draw by the symbol's name
splits the alphabet, so that equal stretches are parsed alike but for their ends. A symbol's name is a 64-bit hash of its rule, that of a word
its own number. Two equal stretches are then compared by climbing to the largest symbols that both begin with, and down
again where these differ, in steps as many as there are levels; a block is compared with another one in one step.
"""

from __future__ import annotations

import numpy as np

from arkspark.llm.common import mix

_BLOCK, _LEFT, _RIGHT, _SALT = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93))
#: Pair compression that joins nothing so many times in a row ends the grammar.
_IDLE = 3
_MOST_LEVELS = 400


def _salt(number: int) -> np.uint64:
    return np.uint64((number + 1) * int(_SALT) % (1 << 64))


class Grammar:
    """Over ``symbols`` (distinct numbers for distinct symbols), of which ``barriers`` never join others; the first and the
    last must be barriers, and no barrier may equal another symbol.

    All levels lie one after the other in one array for each property; ``up``, ``first`` and ``last`` are places in them,
    -1 above the top and below the ground. ``ahead`` and ``behind`` count the copies in the symbol's block from it to the block's ends.
    """

    def __init__(self, symbols: np.ndarray, barriers: np.ndarray, salt: int = 0):
        name, bar, size = mix(symbols.astype(np.uint64) + _salt(salt)), barriers, np.ones(len(symbols), np.int64)
        names, sizes, starts, counts, blocks = [name], [size], [], [], []
        enough, idle = 2 * int(barriers.sum()) + 1, 0
        while len(name) > enough and idle < _IDLE and len(starts) < _MOST_LEVELS:
            at = np.flatnonzero(np.concatenate(([True], name[1:] != name[:-1])))
            if len(at) < len(name):
                k = np.diff(np.append(at, len(name)))
                many = k > 1
                above = name[at]
                above[many] = mix(above[many] * _BLOCK + k[many].astype(np.uint64) * _RIGHT)
                name, bar, size = above, bar[at], np.add.reduceat(size, at)
                for held, x in zip((names, sizes, starts, counts, blocks), (name, size, at, k, True), strict=True):
                    held.append(x)
            side = (mix(name ^ _salt(len(starts))) & np.uint64(1)).astype(np.int8)
            side[bar] = 2
            joined = np.flatnonzero((side[:-1] == 0) & (side[1:] == 1))
            idle = 0 if len(joined) else idle + 1
            if len(joined):
                kept = np.ones(len(name), bool)
                kept[joined + 1] = False
                at = np.flatnonzero(kept)
                k = np.diff(np.append(at, len(name)))
                above = name[at]
                two = k > 1
                above[two] = mix(name[joined] * _LEFT + name[joined + 1] * _RIGHT + _BLOCK)
                name, bar, size = above, bar[at], np.add.reduceat(size, at)
                for held, x in zip((names, sizes, starts, counts, blocks), (name, size, at, k, False), strict=True):
                    held.append(x)
        offsets = np.cumsum([0, *map(len, names)])
        self.name, self.size = np.concatenate(names), np.concatenate(sizes)
        self.up, self.first, self.last = (np.full(offsets[-1], -1, np.int64) for _ in range(3))
        self.ahead, self.behind = np.ones(offsets[-1], np.int64), np.ones(offsets[-1], np.int64)
        for level, (at, k, block) in enumerate(zip(starts, counts, blocks, strict=True)):
            low, mid, high = offsets[level : level + 3]
            self.first[mid:high], self.last[mid:high] = low + at, low + at + k - 1
            self.up[low:mid] = np.repeat(np.arange(mid, high), k)
            if block:
                own = np.arange(mid - low)
                begin = np.repeat(at, k)
                self.behind[low:mid] = own - begin + 1
                self.ahead[low:mid] = np.repeat(at + k, k) - own

    def extend(self, i: np.ndarray, j: np.ndarray, forward: bool) -> np.ndarray:
        """How many symbols from the places ``i`` and ``j`` on are equal, each with each, to the right or to the left."""
        edge, room, step = (self.first, self.ahead, 1) if forward else (self.last, self.behind, -1)
        a, b, out, live = i.astype(np.int64), j.astype(np.int64), np.zeros(len(i), np.int64), np.arange(len(i))
        while len(live):
            above, other = self.up[a], self.up[b]
            climb = (above >= 0) & (edge[above] == a) & (edge[other] == b) & (self.name[above] == self.name[other])
            same = self.name[a] == self.name[b]
            by = np.where(same & ~climb, np.minimum(room[a], room[b]), 0)
            out[live] += by * self.size[a]
            down = ~same  # what differs can't have been climbed to
            a, b = (np.where(climb, x, np.where(down, edge[p], p + step * by)) for p, x in ((a, above), (b, other)))
            on = a >= 0
            if not on.all():
                a, b, live = a[on], b[on], live[on]
        return out
