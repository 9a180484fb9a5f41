"""Which n-grams stand in one set alone, counted over all sets in packed blocks.

A set whose n-grams are private, held by no other set, in more than ``1 - num / den`` of all has no partner: too few are
left to share. Only n-grams of the lower end of the hash range are counted, ``SLICE`` times as many as have to be
private: enough to tell for most sets. Each task packs them into records of ten bytes, in order of the hash, and sends one block for
each of 2^16 hash buckets. An n-gram that several sets of one such block hold is sent for two of them only, so that even
one that all texts share has no more than two records a block. What is found is packed again, by the sets' names, and
added up.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE = 1.75
#: Records that a task packs, or unpacks, at once.
RECORDS = 1 << 20
#: 32 bits of an n-gram's hash below the 16 of its bucket, and the 48 bits that name a set.
RECORD = np.dtype([("gram", "<u4"), ("low", "<u4"), ("high", "<u2")])


def slice_end(num: int, den: int) -> np.uint64:
    """The largest hash that is counted."""
    return np.uint64(int(min(1.0, SLICE * (den - num) / den) * ((1 << 64) - 1)))


def _runs(sorted_values: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate(([True], sorted_values[1:] != sorted_values[:-1])))


def _least_and_most(grams: np.ndarray, sets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each distinct n-gram, in order: the least and the greatest of its sets."""
    order = np.argsort(grams, kind="stable")
    grams, sets = grams[order], sets[order]
    at = _runs(grams)
    return grams[at], np.minimum.reduceat(sets, at), np.maximum.reduceat(sets, at)


def pack(hashes: list[np.ndarray], names: list[int]) -> tuple[pa.Array, pa.Array]:
    """(buckets, blocks) of the n-gram hashes of sets with these 48-bit names."""
    sets = np.repeat(np.array(names, np.uint64), [len(h) for h in hashes])
    if not len(sets):
        return pa.array([], pa.int32()), pa.array([], pa.binary())
    grams, least, most = _least_and_most(np.concatenate(hashes) >> np.uint64(16), sets)
    two = (most != least).astype(np.int64)
    at = np.cumsum(1 + two) - 1 - two
    held = np.empty(len(grams) + int(two.sum()), np.uint64)
    held[at] = least
    held[at[two > 0] + 1] = most[two > 0]
    grams = np.repeat(grams, 1 + two)
    records = np.empty(len(grams), RECORD)
    records["gram"], records["low"], records["high"] = grams & np.uint64(0xFFFFFFFF), held & np.uint64(0xFFFFFFFF), held >> np.uint64(32)
    buckets = (grams >> np.uint64(32)).astype(np.int32)
    starts = _runs(buckets)
    ends = np.append(starts, len(records)).astype(np.int32) * np.int32(RECORD.itemsize)
    return pa.array(buckets[starts]), pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(records.tobytes())])


def private_sets(buckets: list[int], blocks: list[bytes]) -> np.ndarray:
    """The name of its set for each n-gram of whole buckets that one set alone holds."""
    records = np.frombuffer(b"".join(blocks), RECORD)
    if not len(records):
        return np.empty(0, np.uint64)
    bucket = np.repeat(np.array(buckets, np.uint64), [len(b) // RECORD.itemsize for b in blocks])
    _, least, most = _least_and_most(bucket << np.uint64(32) | records["gram"], records["low"] | records["high"].astype(np.uint64) << np.uint64(32))
    return least[least == most]


COUNT = np.dtype([("low", "<u4"), ("high", "<u2"), ("count", "<u4")])
#: Counts go back in so many buckets by the sets' names.
NAME_BUCKETS = 256


class Chunks:
    """Whole buckets, of ``RECORDS`` records or more, from blocks that come sorted by bucket."""

    def __init__(self, itemsize: int):
        self.least = RECORDS * itemsize
        self._fresh()

    def _fresh(self) -> None:
        self.buckets, self.data, self.size = [], [], 0

    def add(self, bucket: int, block: bytes) -> tuple[list[int], list[bytes]] | None:
        """Takes a block; gives the buckets before it if they are enough."""
        full = None
        if self.size >= self.least and bucket != self.buckets[-1]:
            full = self.rest()
        self.buckets.append(bucket)
        self.data.append(block)
        self.size += len(block)
        return full

    def rest(self) -> tuple[list[int], list[bytes]]:
        held = self.buckets, self.data
        self._fresh()
        return held


def count_private(buckets: list[int], data: list[bytes]) -> tuple[list[int], list[bytes]]:
    """(buckets, blocks) of the sets' names with their private n-grams, from blocks of whole buckets of n-grams."""
    names, counts = np.unique(private_sets(buckets, data), return_counts=True)
    if not len(names):
        return [], []
    records = np.empty(len(names), COUNT)
    records["low"], records["high"], records["count"] = names & np.uint64(0xFFFFFFFF), names >> np.uint64(32), counts
    at = names * np.uint64(NAME_BUCKETS) >> np.uint64(48)
    starts = _runs(at)
    ends = np.append(starts[1:], len(records))
    return at[starts].astype(int).tolist(), [records[a:b].tobytes() for a, b in zip(starts, ends, strict=True)]


def _chunked(blocks: Iterator[tuple[int, bytes]], itemsize: int) -> Iterator[tuple[list[int], list[bytes]]]:
    chunks = Chunks(itemsize)
    for bucket, block in blocks:
        if full := chunks.add(bucket, block):
            yield full
    if chunks.buckets:
        yield chunks.rest()


def private_counts(blocks: Iterator[tuple[int, bytes]]) -> Iterator[tuple[list[int], list[bytes]]]:
    """``count_private`` of blocks of n-grams sorted by bucket."""
    for buckets, data in _chunked(blocks, RECORD.itemsize):
        yield count_private(buckets, data)


def summed_counts(blocks: Iterator[tuple[int, bytes]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(names, private n-grams of each) from blocks of counts sorted by bucket: each name once."""
    for _, data in _chunked(blocks, COUNT.itemsize):
        records = np.frombuffer(b"".join(data), COUNT)
        names, where = np.unique(records["low"] | records["high"].astype(np.uint64) << np.uint64(32), return_inverse=True)
        yield names.astype(np.int64), np.bincount(where, records["count"], minlength=len(names)).astype(np.int64)
