"""Periodic runs of words, found exactly by recompression.

A run is a stretch of words with a smallest period q, at least ``MIN_PERIODS`` times as long as q and ``MIN_WORDS`` long, that
no neighbouring word extends. For every q, such a run covers several places of the grid 0, q, 2q, ... and has the same word at them: those
chains of equal words on the harmonic grids are the candidates. Each is extended to both sides by the grammar
(``recompression``), which tells where the period ends; a stretch found by several periods has the smallest.

Texts are taken together up to ``BATCH_WORDS`` words a time, so that short ones share the passes; a longer one is taken
alone and whole.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arkspark.llm.common import only, texts
from arkspark.llm.recompression import Grammar

MIN_WORDS = 24
MIN_PERIODS = 3
BATCH_WORDS = 1 << 18
#: Grids whose chains are looked for at once, by period, so that a period's multiples come after it.
_BAND = 2


def grid_chains(ids: np.ndarray, q: int) -> tuple[np.ndarray, np.ndarray]:
    """(first, last): the chains of places of the grid of ``q`` at which the same word stands, long enough to be in a run."""
    grid = ids[::q]
    equal = np.empty(len(grid) + 1, np.int8)
    equal[0] = equal[-1] = 0
    np.equal(grid[1:], grid[:-1], out=equal[1:-1].view(bool))
    turns = np.flatnonzero(equal[1:] != equal[:-1])
    first, end = turns[::2], turns[1::2]
    enough = end - first >= max(MIN_WORDS, MIN_PERIODS * q) // q - 1
    return first[enough], end[enough]


class _Runs:
    """The runs found in a batch so far, by places in it."""

    def __init__(self):
        self.start, self.end, self.period = (np.empty(0, np.int64) for _ in range(3))

    def add(self, start: np.ndarray, end: np.ndarray, period: np.ndarray) -> None:
        """With those known; of equal stretches the smallest period stays."""
        s, e, q = (np.concatenate(x) for x in ((self.start, start), (self.end, end), (self.period, period)))
        order = np.lexsort((q, e, s))
        s, e, q = s[order], e[order], q[order]
        new = np.ones(len(s), bool)
        new[1:] = (s[1:] != s[:-1]) | (e[1:] != e[:-1])
        self.start, self.end, self.period = s[new], e[new], q[new]

    def cover(self, low: np.ndarray, high: np.ndarray, q: np.ndarray) -> np.ndarray:
        """Whether the words from ``low`` up to ``high`` lie in the known run of those begun before that reaches farthest, and its period divides q."""
        if not len(self.start):
            return np.zeros(len(low), bool)
        reach = np.maximum.accumulate(self.end)
        far = np.maximum.accumulate(np.where(self.end == reach, np.arange(len(reach)), 0))
        at = np.searchsorted(self.start, low, "right") - 1
        run = far[np.maximum(at, 0)]
        return (at >= 0) & (self.end[run] >= high) & (q % self.period[run] == 0)


def _extended(runs: _Runs, grammar: Grammar, shift, first: np.ndarray, end: np.ndarray, q: np.ndarray) -> None:
    """Extend the chains (places first..end of the grids of q): at their first place, then at ever more places at once as far
    as what was found doesn't cover them."""
    many = np.ones(len(first), np.int64)
    while len(first):
        many = np.minimum(many, end - first)
        chain = np.repeat(np.arange(len(first)), many)
        k = first[chain] + np.arange(len(chain)) - np.repeat(np.cumsum(many) - many, many)
        step = q[chain]
        i = k * step
        j = i + step
        left = grammar.extend(shift(i) - 1, shift(j) - 1, False)
        right = grammar.extend(shift(i), shift(j), True)
        start, stop = i - left, j + right
        held = stop - start >= np.maximum(MIN_WORDS, MIN_PERIODS * step)
        runs.add(start[held], stop[held], step[held])
        last = np.cumsum(many) - 1
        first = np.maximum(first + many, stop[last] // q)
        on = end - first >= np.maximum(MIN_WORDS, MIN_PERIODS * q) // q - 1
        first, end, q, many = first[on], end[on], q[on], 2 * many[on]


def _exact(ids: np.ndarray, runs: _Runs) -> bool:
    """Whether each stretch has its period and ends where it does: hashes of rules could have met."""
    for s, e, q in zip(runs.start.tolist(), runs.end.tolist(), runs.period.tolist(), strict=True):
        if ids[s - 1] == ids[s - 1 + q] or ids[e] == ids[e - q] or not np.array_equal(ids[s : e - q], ids[s + q : e]):
            return False
    return True


def find_runs(sequences: list[np.ndarray]) -> list[list[tuple[int, int, int]]]:
    """For each sequence of word numbers (from 0 on) its runs (start, length, period), by start and then period."""
    lengths = np.array([len(x) for x in sequences], np.int64)
    begins = np.cumsum(lengths + 1) - lengths  # a barrier before each and one at the end
    ids = np.empty(int(lengths.sum()) + len(sequences) + 1, np.int64)
    inside = np.ones(len(ids), bool)
    inside[begins - 1] = inside[-1] = False
    ids[inside] = np.concatenate([*sequences, np.empty(0, np.int64)])
    ids[~inside] = -1 - np.arange(len(sequences) + 1)
    longest = int(lengths.max(initial=0))

    chains = []
    for q in range(1, longest // MIN_PERIODS + 1):
        first, end = grid_chains(ids, q)
        if len(first):
            chains.append((q, first, end))
    if not chains:
        return [[] for _ in sequences]
    period = np.repeat([c[0] for c in chains], [len(c[1]) for c in chains])
    first, end = (np.concatenate([c[k] for c in chains]) for k in (1, 2))

    # Only sequences with candidates go into the grammar.
    owner = np.searchsorted(begins, first * period, "right") - 1
    inner = np.searchsorted(begins, end * period, "right") - 1 == owner
    inner &= owner >= 0  # a chain over several sequences has no run of its own over their barriers, but may have one inside
    wide = ~inner
    used = np.zeros(len(sequences), bool)
    used[owner[inner]] = True
    for a, b in zip(first[wide] * period[wide], end[wide] * period[wide], strict=True):
        used[max(0, np.searchsorted(begins, a, "right") - 1) : np.searchsorted(begins, b, "right")] = True
    taken = np.repeat(used, lengths + 1)
    taken = np.append(taken, True)  # each with the barrier before it, and the last barrier
    places = np.cumsum(taken) - 1

    salt = 0
    while True:
        grammar, runs = Grammar(ids[taken], ~inside[taken], salt), _Runs()
        for band in range(int(period[-1]).bit_length()):
            lo, hi = np.searchsorted(period, (_BAND**band, _BAND ** (band + 1)))
            f, e, q = first[lo:hi], end[lo:hi], period[lo:hi]
            open_ones = ~runs.cover(f * q, e * q + 1, q)
            _extended(runs, grammar, places.__getitem__, f[open_ones], e[open_ones], q[open_ones])
        if _exact(ids, runs):
            break
        salt += 1
    out: list[list[tuple[int, int, int]]] = [[] for _ in sequences]
    order = np.lexsort((runs.period, runs.start))
    owner = np.searchsorted(begins, runs.start, "right") - 1
    for r in order.tolist():
        d = owner[r]
        out[d].append((int(runs.start[r] - begins[d]), int(runs.end[r] - runs.start[r]), int(runs.period[r])))
    return out


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words outside runs or in the first period of all runs that hold them, joined by one space."""
    if not runs:
        return b" ".join(words)
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    gone = np.cumsum(change[:-1]) > 0
    return b" ".join([w for w, x in zip(words, gone.tolist(), strict=True) if not x])


_FOUND = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    keys, held, size = [], [], 0

    def found() -> pa.RecordBatch:
        number: dict[bytes, int] = defaultdict(count().__next__)
        runs = find_runs([np.fromiter(map(number.__getitem__, words), np.int64, len(words)) for words in held])
        flat = [dict(zip(("start", "length", "period"), r, strict=True)) for own in runs for r in own]
        lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, runs)]).astype(np.int32)), pa.array(flat, _RUN))
        left = pa.array([collapsed(w, r) for w, r in zip(held, runs, strict=True)], pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array([len(w) for w in held], pa.int64()), lists, left.cast(pa.string())], ["doc_id", "n_words", "runs", "collapsed"])

    for part, rows in texts(batches, "text"):
        for key, text in zip(part.column("doc_id").to_pylist(), rows, strict=True):
            words = (text or b"").split()
            if held and size + len(words) > BATCH_WORDS:
                yield found()
                keys, held, size = [], [], 0
            keys.append(key)
            held.append(words)
            size += len(words)
    if held:
        yield found()


def periodic_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) for each row of ``docs`` (doc_id, text; other columns are ignored).

    Words are runs of other characters than ASCII white space, numbered from 0. ``runs`` has (start, length, period) by start and
    then period; ``collapsed`` is the words but those that a run holds after its first period, joined by one space. Null and empty texts have no
    words and no runs; rows without an id and repeated rows keep theirs. Several runs of one stretch can't be: the smallest
    period tells it. An empty table gives no rows.
    """
    return only(docs, doc_id="long", text="string").mapInArrow(_find, _FOUND)


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, text): documents of which those whose crc32(doc_id as text) ends in 0 repeat a stretch of their words up to their end.

    With h the checksum, g = h div 10 and n words, each from a = g mod n on becomes the original word a + (i - a) mod p,
    p = 1 + (n - a) div (3 + g mod 8). Texts without words and rows without an id stay as they are.
    """
    docs = only(docs, doc_id="long", text="string").withColumn("h", F.crc32(F.col("doc_id").cast("string").cast("binary")))
    chosen = F.col("h") % 10 == 0
    docs = docs.withColumn("ws", F.when(chosen, F.expr(r"filter(split(text, '[\\x20\\x09-\\x0D]+'), w -> w <> '')"))).withColumn("n", F.size("ws")).withColumn("g", F.expr("h div 10"))
    docs = docs.withColumn("a", F.expr("CASE WHEN n > 0 THEN cast(g % n AS int) END")).withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    planted = F.expr("array_join(transform(sequence(0, n - 1), i -> ws[IF(i < a, i, cast(a + (i - a) % p AS int))]), ' ')")
    return docs.select("doc_id", F.when(F.col("n") > 0, planted).otherwise(F.col("text")).alias("text"))


def runs_digest(found: DataFrame) -> DataFrame:
    """What ``periodic_runs`` found, as figures and digests: per row the number of runs, that of the greatest exact length by period
    (of equal ones that of the smallest start, then period), and SHA-256 of all runs and of the collapsed text."""
    best = F.expr("aggregate(runs, cast(NULL AS struct<start:bigint,length:bigint,period:bigint>), (b, r) -> IF(b IS NULL OR r.length * b.period > b.length * r.period, r, b))")
    lines = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')), '')")
    out = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    return out.select("doc_id", "n_runs", "best.start", "best.length", "best.period", F.expr("1000 * best.length div best.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")
