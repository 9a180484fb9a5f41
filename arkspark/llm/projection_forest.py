"""Random-projection trees with spill: fitted on a sample, descended by all vectors, compared within leaves.

A tree halves its vectors again and again by a random direction. The cut is made where few sample vectors lie, near the middle; those
within ``margin`` of it go to both sides (spill), so that near ones are seldom parted. A node that no direction cuts well,
because its vectors lie too close together, ends as it is, with a centre: vectors within half the angle of the threshold of the centre are
all linked with each other and need no comparison (a ball).

Leaves hold vectors as 16-bit numbers with a bound of what that changes; pairs that the bound doesn't decide are told apart
from the others, to be verified in full.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np

from arkspark.llm.common import mix

TRIES = 4
#: Sample vectors that a node needs for a cut, and the share of them that may go to its larger side.
LEAST_SAMPLE = 32
LARGEST_SIDE = 0.75
#: Cuts lie between these quantiles.
MIDDLE = (0.35, 0.65)
_END, _STEP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_SLACK = 1e-9


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1, safe for very large and very small numbers."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def margin(threshold: float, dim: int, width: float = 0.2) -> float:
    """Half the spill's width: ``width`` standard deviations of what a random direction parts a pair at the threshold by."""
    return width * np.sqrt(2 * (1 - threshold) / dim)


def root_of(tree: int, dim: int) -> int:
    return int(np.array([tree * (1 << 32) + dim], np.int64)[0]) << 1


def end_ids(root: int, number: np.ndarray, final: np.ndarray) -> np.ndarray:
    """Ids of a node's ends, odd if they are not to be cut further."""
    start = np.array([root], np.int64).view(np.uint64) * _END
    return ((mix(start + (number.astype(np.uint64) + np.uint64(1)) * _STEP) & ~np.uint64(1)) | final.astype(np.uint64)).view(np.int64)


def direction(root: int, node: int, attempt: int, dim: int) -> np.ndarray:
    u = np.random.default_rng([root & 0xFFFFFFFF, root >> 32 & 0xFFFFFFFF, node, attempt]).standard_normal(dim)
    return u / np.sqrt(u @ u)


@dataclass
class Cuts:
    """The part of a tree below one node: inner nodes by number from 0 on, their sides >= 0 inner nodes and < 0 ends (-1 - end)."""

    attempt: list[int] = field(default_factory=list)
    cut: list[float] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    final: list[int] = field(default_factory=list)
    #: Of final ends, one after the other.
    centres: list[float] = field(default_factory=list)


def fit_cuts(x: np.ndarray, rows_each: float, root: int, leaf_rows: int, threshold: float) -> Cuts:
    """Cuts down to about ``leaf_rows`` rows, where a vector of the sample ``x`` (unit rows) stands for ``rows_each`` rows."""
    out, near = Cuts(), margin(threshold, x.shape[1])
    waiting = [(np.arange(len(x)), None, 0)]  # members, whose side, of which inner node
    while waiting:
        rows, sides, at = waiting.pop()
        found = _cut(x, rows, root, len(out.cut), near) if len(rows) * rows_each > leaf_rows and len(rows) >= LEAST_SAMPLE else None
        if found is None or found[3] > LARGEST_SIDE * len(rows):
            place = -1 - len(out.final)
            out.final.append(int(found is not None))
            if found is not None:
                mean = x[rows].mean(axis=0)
                out.centres.extend((mean / max(np.sqrt(mean @ mean), 1e-300)).tolist())
        else:
            attempt, t, p, _ = found
            place = len(out.cut)
            for held, value in zip((out.attempt, out.cut, out.left, out.right), (attempt, t, 0, 0), strict=True):
                held.append(value)
            waiting += [(rows[p >= t - near], out.right, place), (rows[p <= t + near], out.left, place)]
        if sides is not None:
            sides[at] = place
    return out


def _cut(x: np.ndarray, rows: np.ndarray, root: int, node: int, near: float) -> tuple[int, float, np.ndarray, int]:
    """(attempt, cut, projections, members of the larger side) of the direction that spills least."""
    best = None
    lo, hi = (int(q * len(rows)) for q in MIDDLE)
    for attempt in range(TRIES):
        p = x[rows] @ direction(root, node, attempt, x.shape[1])
        s = np.sort(p)
        t = (s[lo:hi] + s[lo + 1 : hi + 1]) / 2
        below, above = np.searchsorted(s, t + near, "right"), len(s) - np.searchsorted(s, t - near, "left")
        i = int(np.argmin(below + above))
        if best is None or below[i] + above[i] < best[4]:
            best = (attempt, float(t[i]), p, int(max(below[i], above[i])), int(below[i] + above[i]))
    return best[:4]


class Directions(dict):
    """Directions by (root, node, attempt, dimension), forgotten when there are ``limit``."""

    limit = 1 << 14

    def __missing__(self, key):
        if len(self) >= self.limit:
            self.clear()
        value = self[key] = direction(*key).astype(np.float64)
        return value


def descend(x: np.ndarray, cuts: Cuts, root: int, threshold: float, directions: Directions) -> Iterator[tuple[np.ndarray, int, np.ndarray]]:
    """(rows, end's id, whether each lies in the end's ball) for the ends that rows of ``x`` (unit rows) come to."""
    near, dim = margin(threshold, x.shape[1]), x.shape[1]
    final = np.array(cuts.final, np.int64)
    ids, ball = end_ids(root, np.arange(len(final)), final), np.cumsum(final) - 1
    within = np.sqrt((1 + threshold) / 2) + _SLACK
    waiting = [(np.arange(len(x)), 0 if cuts.cut else -1)]
    while waiting:
        rows, node = waiting.pop()
        if not len(rows):
            continue
        if node < 0:
            e = -1 - node
            core = np.zeros(len(rows), bool)
            if final[e]:
                core = x[rows] @ np.array(cuts.centres[ball[e] * dim : (ball[e] + 1) * dim]) >= within
            yield rows, int(ids[e]), core
        else:
            p = x[rows] @ directions[root, node, cuts.attempt[node], dim]
            waiting += [(rows[p >= cuts.cut[node] - near], cuts.right[node]), (rows[p <= cuts.cut[node] + near], cuts.left[node])]


def quantised(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(16-bit numbers, their unit, length of what they leave off) of unit rows."""
    step = np.abs(x).max(axis=1) / 32767
    q = np.rint(x / step[:, None]).astype(np.int16)
    off = x - q * step[:, None]
    return q, step, np.sqrt(np.einsum("ij,ij->i", off, off))


@dataclass
class Leaf:
    """Vectors that are compared with each other; those of unequal sides only, if it is split."""

    key: np.ndarray
    weight: np.ndarray
    vectors: np.ndarray
    off: np.ndarray
    ball: np.ndarray  # 0 for none
    side: np.ndarray
    split: bool  # there are two sides, of which one may be empty
    earlier: list[np.ndarray]  # leaves before this one, by id, that each is in


def compare(leaf: Leaf, threshold: float) -> tuple[np.ndarray, list[tuple[int, int]], list[tuple[int, int]]]:
    """(links of each by weight, edges that join what is linked here, pairs that are too close to the threshold to tell).

    A pair counts in the first leaf that holds both; pairs of one ball don't, as they are linked anyway.
    """
    n = len(leaf.key)
    dots = leaf.vectors @ leaf.vectors.T
    slack = leaf.off[:, None] + leaf.off[None, :] + leaf.off[:, None] * leaf.off[None, :] + _SLACK
    able = leaf.key[:, None] != leaf.key[None, :]
    if leaf.split:
        able &= leaf.side[:, None] != leaf.side[None, :]
    able &= (leaf.ball[:, None] != leaf.ball[None, :]) | (leaf.ball == 0)[:, None]
    near = able & (dots >= threshold - slack)
    counts = np.zeros(n, np.int64)
    rows = np.flatnonzero(near.any(axis=1))
    if not len(rows):
        return counts, [], []
    near, sure = near[np.ix_(rows, rows)], (near & (dots > threshold + slack))[np.ix_(rows, rows)]
    edges = _joined(leaf.key[rows], sure)
    new = ~_share([leaf.earlier[r] for r in rows])
    counts[rows] = (sure & new) @ leaf.weight[rows]
    a, b = np.nonzero(np.triu(near & ~sure & new))
    return counts, edges, list(zip(leaf.key[rows[a]].tolist(), leaf.key[rows[b]].tolist(), strict=True))


def _share(earlier: list[np.ndarray]) -> np.ndarray:
    """Whether two have an earlier leaf in common."""
    ids, at, n = np.unique(np.concatenate(earlier), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(earlier)), [len(e) for e in earlier])
    several = n > 1
    column = np.cumsum(several) - 1
    held = np.zeros((len(earlier), int(several.sum())), np.float32)
    on = several[at]
    held[owner[on], column[at[on]]] = 1
    return held @ held.T > 0


def _joined(key: np.ndarray, linked: np.ndarray) -> list[tuple[int, int]]:
    """An edge from each to the smallest key that it can reach by links."""
    order = np.argsort(key, kind="stable")
    linked = linked[np.ix_(order, order)]
    least = np.arange(len(key))
    while True:
        now = np.minimum(least, np.where(linked, least[None, :], len(key)).min(axis=1, initial=len(key)))
        now = now[now]
        if (now == least).all():
            break
        least = now
    key = key[order]
    return [(a, b) for a, b in zip(key.tolist(), key[least].tolist(), strict=True) if a != b]
