"""N-gram Jaccard join: rare-first prefix filtering with length, positional and suffix filters.

Two texts link when the Jaccard similarity of their sets of word n-grams reaches ``num / den``. The steps:

1. One scan gives each document the size and digest of its set, and counts which n-grams one set alone holds
   (``gram_blocks``). Equal sets are one class from here on. A class with so many private n-grams that a prefix could
   be made of them has no partner and is done.
2. The sets of the other classes are written once, with parity bitmaps. Each is ordered by how many of these classes
   hold an n-gram, rarest first, told by ``FREQUENCY_SLOTS`` counters; its prefix, that two similar sets must share an
   n-gram in, goes on as (n-gram, class, position, size). Prefix n-grams that one class alone holds go.
3. Classes that share a prefix n-gram pair up if the length filter and the positional filter let them. Each pair is then
   held against the suffix filter once. That is a Hamming bound: two sets differ in at least as many n-grams as their parity bitmaps
   differ in bits. It stands on bitmaps of two to four bits an n-gram instead of halving the suffixes, since those
   would have to be shipped for it.
4. Each pair left is verified once, on the sets themselves: first each class with its nearest by the bitmaps, then
   the pairs that aren't within one component yet.

Under one n-gram with over ``SMALL_GROUP`` classes, not all pairs are verified: what matters is which classes are
connected. Each class is first verified against its nearest few by the bitmaps; then, round by round, against further
ones as far as they aren't connected yet, until every pair that the filters admit is verified or lies within one
component. Such groups are dealt out by blocks of ``BLOCK`` classes, so none is gathered whole; at first they are compared within
blocks, then the classes outside the group's largest component with all others.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arkspark.llm.common import Scratch, WordIds, mix, multipliers, only, texts, windows
from arkspark.llm.components import connected_components
from arkspark.llm.gram_blocks import RECORD, RECORDS, Chunks, count_private, pack, slice_end, summed_counts

FREQUENCY_SLOTS = 1 << 20
_BLOCK_SLOTS = 1 << 10
_BITS = 512
SMALL_GROUP = 32
BLOCK = 20_000
#: Ranks, by Hamming distance, up to which a class of a large group is verified in each round; the last has no bound.
RANKS = (4, 64, 1024, 1 << 62)


def shingle_set(ids: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct hashes of the k-word shingles; the whole sequence is one shingle if there are fewer words."""
    if len(ids) == 0:
        return np.empty(0, np.uint64)
    if len(ids) < k:
        return mix(np.array([np.sum(ids * multipliers(len(ids))) + np.uint64(len(ids) * 2 + 1)], np.uint64))
    h = windows(ids, k)
    h.sort()
    return h[np.concatenate(([True], h[1:] != h[:-1]))]


def _slot(h: np.ndarray) -> np.ndarray:
    return ((h >> np.uint64(20)) & np.uint64(FREQUENCY_SLOTS - 1)).astype(np.int64)


def _sets(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    ids = WordIds()
    for part, rows in texts(batches, "text"):
        yield part, [shingle_set(ids.of((t or b"").lower().split()), k) for t in rows]


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    ends = pa.array(np.cumsum([0, *map(len, arrays)]).astype(np.int32))
    return pa.ListArray.from_arrays(ends, pa.array(np.concatenate(arrays).view(np.int64) if arrays else np.empty(0, np.int64)))


def _digest(h: np.ndarray) -> bytes:
    return hashlib.blake2b(h.tobytes(), digest_size=16).digest()


def _name(digest: bytes) -> int:
    """48 bits of a set's digest; sets that share them count as not told apart."""
    return int.from_bytes(digest[:6], "little")


def _parities(h: np.ndarray, power: int) -> np.ndarray:
    odd = np.bincount((h >> np.uint64(20) & np.uint64((1 << power) - 1)).astype(np.int64), minlength=1 << power) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _bitmap(h: np.ndarray) -> list[int]:
    """Parity bitmap of ``_BITS`` bits: whether the set has an odd number of n-grams in each slot."""
    return _parities(h, _BITS.bit_length() - 1).tolist()


def _wide_bitmap(h: np.ndarray) -> np.ndarray:
    """Parity bitmap of 2 to 4 bits for each n-gram; empty where that of fixed width is as wide."""
    power = int(2 * len(h) - 1).bit_length() if len(h) else 0
    return np.empty(0, np.int64) if 1 << power <= _BITS else _parities(h, power)


#: Odd, so that consecutive rows take all buckets in turn, far from each other.
_TURN = 40503
_PACKED = "bucket int, doc_id long, n long, digest binary, name long, block binary"
_PROFILE = "doc_id long, n long, digest binary, name long, bucket int, block binary"


def _profiles(k: int, end: np.uint64):
    """A row for each document and the packed n-grams, up to ``end``, of those with an id. Rows of documents need no others,
    so that they are dealt out in turn, however many are equal."""

    def packed(hashes: list[np.ndarray], names: list[int]) -> pa.RecordBatch:
        buckets, blocks = pack(hashes, names)
        none = lambda kind: pa.nulls(len(blocks), kind)
        return pa.RecordBatch.from_arrays([buckets, none(pa.int64()), none(pa.int64()), none(pa.binary()), none(pa.int64()), blocks], ["bucket", "doc_id", "n", "digest", "name", "block"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, names, size, given = [], [], 0, 0
        for part, sets in _sets(batches, k):
            digests = [_digest(h) for h in sets]
            called = [_name(d) for d in digests]
            buckets = pa.array(-1 - (given + np.arange(len(sets))) * _TURN % (1 << 16), pa.int32())
            given += len(sets)
            yield pa.RecordBatch.from_arrays(
                [buckets, part.column("doc_id"), pa.array([len(h) for h in sets], pa.int64()), pa.array(digests, pa.binary()), pa.array(called, pa.int64()), pa.nulls(len(sets), pa.binary())],
                ["bucket", "doc_id", "n", "digest", "name", "block"],
            )
            for h, name, has_id in zip(sets, called, part.column("doc_id").is_valid().to_pylist(), strict=True):
                low = h[: np.searchsorted(h, end, "right")]
                if has_id and len(low):
                    hashes.append(low)
                    names.append(name)
                    size += len(low)
            if size >= RECORDS:
                yield packed(hashes, names)
                hashes, names, size = [], [], 0
        yield packed(hashes, names)

    return run


def _blocks(batch: pa.RecordBatch) -> Iterator[tuple[int, bytes]]:
    rows = batch.filter(batch.column("block").is_valid())
    return zip(rows.column("bucket").to_pylist(), rows.column("block").to_pylist(), strict=True)


def _count_private(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows sorted by bucket: those of documents as they are, at once, and of the blocks the private n-grams by name."""
    columns, chunks = ["doc_id", "n", "digest", "name"], Chunks(RECORD.itemsize)

    def counted(full: tuple[list[int], list[bytes]]) -> pa.RecordBatch:
        buckets, blocks = count_private(*full)
        none = [pa.nulls(len(blocks), kind) for kind in (pa.int64(), pa.int64(), pa.binary(), pa.int64())]
        return pa.RecordBatch.from_arrays([*none, pa.array(buckets, pa.int32()), pa.array(blocks, pa.binary())], [*columns, "bucket", "block"])

    for batch in batches:
        rows = batch.filter(batch.column("digest").is_valid())
        if rows.num_rows:
            yield pa.RecordBatch.from_arrays([*(rows.column(c) for c in columns), pa.nulls(rows.num_rows, pa.int32()), pa.nulls(rows.num_rows, pa.binary())], [*columns, "bucket", "block"])
        for bucket, block in _blocks(batch):
            if full := chunks.add(bucket, block):
                yield counted(full)
    yield counted(chunks.rest())


def _sum_private(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for names, counts in summed_counts(x for batch in batches for x in _blocks(batch)):
        yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(counts)], ["name", "private"])


def _whole_sets(k: int):
    """The sets that have the digest asked for; other texts of the same id have another."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, sets in _sets(batches, k):
            wanted = [(key, h) for key, d, h in zip(part.column("doc_id").to_pylist(), part.column("digest").to_pylist(), sets, strict=True) if d == _digest(h)]
            held = [h for _, h in wanted]
            yield pa.RecordBatch.from_arrays(
                [pa.array([key for key, _ in wanted], pa.int64()), pa.array([len(h) for h in held], pa.int64()), _lists(held), pa.array([_bitmap(h) for h in held], pa.list_(pa.int64())), _lists([_wide_bitmap(h) for h in held])],
                ["key", "n", "items", "bits", "wide"],
            )

    return run


def _items(batch: pa.RecordBatch) -> list[np.ndarray]:
    column = batch.column("items")
    ends, flat = np.asarray(column.offsets), np.asarray(column.values).view(np.uint64)
    return [flat[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]


def _count_slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(FREQUENCY_SLOTS, np.uint32)
    for batch in batches:
        counts += np.bincount(_slot(np.concatenate([*_items(batch), np.empty(0, np.uint64)])), minlength=FREQUENCY_SLOTS).astype(np.uint32)
    held = [b for b in range(FREQUENCY_SLOTS // _BLOCK_SLOTS) if counts[b * _BLOCK_SLOTS : (b + 1) * _BLOCK_SLOTS].any()]
    yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), pa.array([counts[b * _BLOCK_SLOTS : (b + 1) * _BLOCK_SLOTS].tobytes() for b in held], pa.binary())], ["block", "counts"])


def _add_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for b, c in zip(batch.column("block").to_pylist(), batch.column("counts").to_pylist(), strict=True):
            sums[b] = sums.get(b, 0) + np.frombuffer(c, np.uint32).astype(np.uint64)
    clipped = [np.minimum(c, 0xFFFFFFFF).astype(np.uint32).tobytes() for c in sums.values()]
    yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(clipped, pa.binary())], ["block", "counts"])


def _frequencies(sets: DataFrame) -> np.ndarray:
    """The summed counters: ``FREQUENCY_SLOTS`` numbers at any input size, so that they can be broadcast."""
    parts = sets.select("items").mapInArrow(_count_slots, "block int, counts binary")
    out = np.zeros(FREQUENCY_SLOTS, np.uint32)
    for row in parts.repartition(16, "block").mapInArrow(_add_blocks, "block int, counts binary").collect():
        out[row.block * _BLOCK_SLOTS : (row.block + 1) * _BLOCK_SLOTS] = np.frombuffer(row.counts, np.uint32)
    return out


def _prefixes(num: int, den: int, frequencies):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.minimum(frequencies.value, (1 << 24) - 1).astype(np.uint64) << np.uint64(40)
        for batch in batches:
            kept = []
            for h in _items(batch):
                rank = counts[_slot(h)] | (h >> np.uint64(24))
                kept.append(h[np.argsort(rank, kind="stable")[: len(h) - (num * len(h) + den - 1) // den + 1]])
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("n"), _lists(kept)], ["key", "n", "prefix"])

    return run


def _nearest(num: int, den: int, high: int):
    """Of two blocks of a large group (or one with itself): each class that seeks with its ``high`` nearest by Hamming distance, as far as
    they lie in other components."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("key")
        key, comp, n, pos, side = (rows[c].to_numpy() for c in ("key", "comp", "n", "pos", "side"))
        bits = np.ascontiguousarray(np.stack(rows["bits"].to_numpy()).astype(np.int64)).view(np.uint64)
        split = rows["lo"].iloc[0] != rows["hi"].iloc[0]
        seekers = np.flatnonzero(rows["seeks"].to_numpy())
        a_out, b_out, far_out, rest = [], [], [], 0
        step = max(1, 1_000_000 // max(1, len(key)))
        for at in range(0, len(seekers), step):
            i = seekers[at : at + step]
            both = n[i, None] + n[None, :]
            need = (num * both + num + den - 1) // (num + den)
            ok = den * np.minimum(n[i, None], n[None, :]) >= num * np.maximum(n[i, None], n[None, :])
            shared = np.minimum(pos[i, None], pos[None, :]) + 1 + np.minimum(n[i, None] - pos[i, None], n[None, :] - pos[None, :]) - 1
            ok &= (shared >= need) & (key[i, None] != key[None, :])
            if split:
                ok &= side[i, None] != side[None, :]
            far = np.zeros(ok.shape, np.int32)
            for w in range(bits.shape[1]):
                far += np.bitwise_count(bits[i, None, w] ^ bits[None, :, w])
            ok &= far <= both - 2 * need
            for r in np.flatnonzero(ok.any(axis=1)):
                to = np.flatnonzero(ok[r])
                to = to[np.argsort(far[r, to], kind="stable")]
                rest += int((comp[to[high:]] != comp[i[r]]).sum())
                to = to[:high]
                to = to[comp[to] != comp[i[r]]]
                a_out.append(np.minimum(key[i[r]], key[to]))
                b_out.append(np.maximum(key[i[r]], key[to]))
                far_out.append(far[r, to])
        found = pd.DataFrame({"a": np.concatenate(a_out), "b": np.concatenate(b_out), "far": np.concatenate(far_out)} if a_out else {"a": [], "b": [], "far": []}, dtype="Int64").drop_duplicates()
        found["rest"] = 0
        return pd.concat([found, pd.DataFrame({"a": [pd.NA], "b": [pd.NA], "far": [pd.NA], "rest": [rest]})]).astype("Int64") if rest else found.astype("Int64")

    return run


def _plausible(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """(a, b, far): the pairs that their bitmaps admit, with the bits in which these differ.

    Sets of over ``_BITS`` bits are compared by their wide bitmaps; if these have two widths, the wider one is folded
    in half. The length filter admits no other widths.
    """
    wide = F.when(F.size("wide") == 0, F.col("bits")).otherwise(F.col("wide"))
    x, y = (sets.select(F.col("key").alias(e), F.col("n").alias("n" + e), wide.alias("wide" + e)) for e in "ab")
    both = pairs.select("a", "b").join(x, "a").join(y, "b")

    def folded(mine: str, other: str):
        half = F.expr(f"size({mine}) div 2")
        pairs_of_words = F.zip_with(F.slice(mine, F.lit(1), half), F.slice(mine, half + 1, half), lambda v, w: v.bitwiseXOR(w))
        return F.when(F.size(mine) > F.size(other), pairs_of_words).otherwise(F.col(mine))

    differ = F.zip_with(folded("widea", "wideb"), folded("wideb", "widea"), lambda v, w: F.bit_count(v.bitwiseXOR(w)))
    both = both.withColumn("far", F.aggregate(differ, F.lit(0), lambda t, v: t + v).cast("long"))
    need = F.expr(f"({num} * (na + nb) + {num + den - 1}) div {num + den}")
    return both.where(F.col("far") <= F.col("na") + F.col("nb") - 2 * need).select("a", "b", "far")


def _verified(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    left = sets.select(F.col("key").alias("a"), F.col("items").alias("x"))
    right = sets.select(F.col("key").alias("b"), F.col("items").alias("y"))
    inter = F.size(F.array_intersect("x", "y"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", inter.alias("i"), (F.size("x") + F.size("y")).alias("n"))
    return both.where(den * F.col("i") >= num * (F.col("n") - F.col("i"))).select("a", "b")


def _linked_components(docs: DataFrame, open_ones: DataFrame, known: DataFrame, k: int, num: int, den: int, scratch: Scratch) -> DataFrame:
    """(node, component) of the classes ``open_ones`` (doc_id, digest) by their links, and by those ``known`` (a, b)."""
    spark = docs.sparkSession
    # Shuffled at every size, as it must be for large tables; hashing the ids saves sorting the texts.
    wanted = docs.where("doc_id is not null").join(open_ones.hint("shuffle_hash"), "doc_id").dropDuplicates(["doc_id", "digest", "text"])
    sets = scratch.write(wanted.mapInArrow(_whole_sets(k), "key long, n long, items array<long>, bits array<long>, wide array<long>"), "sets")

    frequencies = spark.sparkContext.broadcast(_frequencies(sets))
    prefixes = sets.select("key", "n", "items").mapInArrow(_prefixes(num, den, frequencies), "key long, n long, prefix array<long>")
    grams = scratch.write(prefixes.select("key", "n", F.posexplode("prefix").alias("pos", "gram")), "grams")
    # As a table of its own, so that a common n-gram's rows can be split when they are joined with it.
    held = scratch.write(grams.groupBy("gram").agg(F.count("*").alias("m")).where("m > 1"), "held")
    shared = scratch.write(grams.join(held, "gram"), "shared")
    scratch.drop(grams, held)

    small = shared.where(F.col("m") <= SMALL_GROUP)
    x, y = (small.select("gram", *(F.col(c).alias(c + s) for c in ("key", "pos", "n"))) for s in "xy")
    need = F.expr(f"({num} * (nx + ny) + {num + den - 1}) div {num + den}")
    pairs = x.join(
        y,
        (x.gram == y.gram)
        & (F.col("keyx") < F.col("keyy"))
        & (den * F.least("nx", "ny") >= num * F.greatest("nx", "ny"))
        & (F.least("posx", "posy") + F.least(F.col("nx") - F.col("posx"), F.col("ny") - F.col("posy")) >= need),
    ).select(F.col("keyx").alias("a"), F.col("keyy").alias("b"), F.lit(0).cast("long").alias("rest"))

    large = shared.where(F.col("m") > SMALL_GROUP)
    some_large = not large.isEmpty()
    if some_large:
        large = scratch.write(large.join(sets.select("key", "bits"), "key"), "large")
    blocks = lambda rows: F.expr(f"({rows} + {BLOCK - 1}) div {BLOCK}")
    deal = lambda n: F.pmod(F.xxhash64("key"), F.greatest(n, F.lit(1)))
    group = ["gram", "lo", "hi"]

    def compared(rows: DataFrame, high: int) -> DataFrame:
        rows = rows.select(*group, "key", "comp", "n", "pos", "side", "seeks", "bits")
        return rows.groupBy(*group).applyInPandas(_nearest(num, den, high), "a long, b long, far long, rest long").select("a", "b", "rest")

    def near_at_first() -> DataFrame:
        """Pairs within blocks."""
        rows = large.withColumn("lo", deal(blocks("m"))).withColumns({"hi": F.col("lo"), "side": F.lit(0), "comp": F.col("key"), "seeks": F.lit(True)})
        return compared(rows, RANKS[0])

    def near(high: int, comps: DataFrame) -> DataFrame:
        """Pairs of the classes outside their group's largest component with all of the group. Those inside it meet the blocks of those outside alone."""
        rows = large.join(comps.select(F.col("node").alias("key"), F.col("component").alias("c")), "key", "left").withColumn("comp", F.coalesce("c", "key"))
        main = rows.groupBy("gram", "comp").agg(F.count("*").alias("held")).groupBy("gram").agg(F.max_by("comp", F.struct("held", "comp")).alias("main"), F.max("held").alias("inside"), (F.sum("held") - F.max("held")).alias("outside"))
        rows = rows.join(scratch.write(main.where("outside > 0"), "main"), "gram").withColumn("seeks", F.col("comp") != F.col("main"))
        rows = rows.withColumns({"out": blocks("outside"), "in": blocks("inside")})
        rows = rows.withColumn("mine", F.when(F.col("seeks"), deal(F.col("out"))).otherwise(F.col("out") + deal(F.col("in"))))
        rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.when(F.col("seeks"), F.col("out") + F.col("in")).otherwise(F.col("out")) - 1)))
        rows = rows.withColumns({"lo": F.least("mine", "other"), "hi": F.greatest("mine", "other"), "side": (F.col("mine") < F.col("other")).cast("int")})
        return compared(rows, high)

    if some_large:
        pairs = pairs.unionByName(near_at_first())
    met = scratch.write(pairs.groupBy("a", "b").agg(F.sum("rest").alias("rest")), "met")
    rest = met.where("a is null").agg(F.sum("rest")).first()[0] or (some_large and not large.where(F.col("m") > BLOCK).isEmpty())
    pairs = scratch.write(_plausible(met.where("a is not null"), sets, num, den), "pairs")
    first = pairs.select("far", F.explode(F.array(F.struct(F.col("a").alias("x"), F.col("b").alias("y")), F.struct(F.col("b").alias("x"), F.col("a").alias("y")))).alias("p"))
    first = first.groupBy("p.x").agg(F.min(F.struct("far", "p.y")).alias("p")).select(F.least("x", "p.y").alias("a"), F.greatest("x", "p.y").alias("b")).distinct()
    first = scratch.write(first, "first")
    links = scratch.write(_verified(first, sets, num, den).unionByName(known), "links")
    comps = scratch.write(connected_components(links, scratch), "components")
    ca, cb = (comps.select(F.col("node").alias(e), F.col("component").alias("c" + e)) for e in "ab")
    second = pairs.select("a", "b").join(ca, "a", "left").join(cb, "b", "left")
    second = second.where(~F.coalesce("ca", "a").eqNullSafe(F.coalesce("cb", "b"))).select("a", "b").join(first, ["a", "b"], "left_anti")
    found = scratch.write(_verified(second, sets, num, den), "links")
    if not found.isEmpty():
        links = links.unionByName(found)
        comps = scratch.write(connected_components(links, scratch), "components")
    done = met.where("a is not null").select("a", "b")
    for high in RANKS[1:]:
        if not rest:
            break
        more = near(high, comps).groupBy("a", "b").agg(F.sum("rest").alias("rest"))
        more = scratch.write(more.join(done, ["a", "b"], "left_anti"), "met")
        done = done.unionByName(more.where("a is not null").select("a", "b"))
        likely = scratch.write(_plausible(more.where("a is not null"), sets, num, den), "pairs")
        found = scratch.write(_verified(likely, sets, num, den), "links")
        rest = more.where("a is null").agg(F.sum("rest")).first()[0] or 0
        if not found.isEmpty():
            links = links.unionByName(found)
            comps = scratch.write(connected_components(links, scratch), "components")
    return comps


def ngram_jaccard_join(docs: DataFrame, k: int = 5, num: int = 8, den: int = 10, scratch: Scratch | None = None) -> DataFrame:
    """(doc_id, n_shingles, component_id, class_id) for every row of ``docs`` (doc_id, text; other columns are ignored).

    Documents link when den * |A & B| >= num * |A | B|; component_id is the smallest doc_id reachable by links.
    class_id is the smallest doc_id with the same set. Words are runs of other characters than ASCII white space,
    with A-Z lower-cased. A text of 1 to k-1 words is one shingle; null and empty texts have none, link with nothing
    and are their own component. A null doc_id keeps its row, with null component_id and class_id, and isn't linked.
    Repeated rows give repeated rows; rows of one doc_id with different texts each keep their row and size and are one
    node with the links of all; tied and equal sets fall into one class. An empty table gives no rows. N-grams
    stand as 64-bit hashes of their words: two sets are mistaken only if such hashes collide within one pair.
    """
    scratch = scratch or Scratch(docs.sparkSession)
    docs = only(docs, doc_id="long", text="string")
    packed = docs.mapInArrow(_profiles(k, slice_end(num, den)), _PACKED).repartition("bucket").sortWithinPartitions("bucket")
    profiles = scratch.write(packed.mapInArrow(_count_private, _PROFILE), "profiles")
    own = profiles.where("block is null")
    classes = scratch.write(own.where("doc_id is not null and n > 0").groupBy("digest").agg(F.min("doc_id").alias("key"), F.min("n").alias("n"), F.min("name").alias("name")), "classes")

    counted = profiles.where("block is not null").select("bucket", "block").repartition("bucket").sortWithinPartitions("bucket")
    private = counted.mapInArrow(_sum_private, "name long, private long")
    named = classes.groupBy("name").agg(F.count("*").alias("twins"))
    open_ones = classes.join(named, "name").join(private, "name", "left")
    open_ones = open_ones.where((F.col("twins") > 1) | (F.coalesce("private", F.lit(0)) < F.expr(f"n - (({num} * n + {den - 1}) div {den}) + 1")))
    open_ones = scratch.write(open_ones.select(F.col("key").alias("doc_id"), "digest"), "open")
    # Sets of one id are one node.
    held = own.where("doc_id is not null and n > 0").join(classes.select("digest", "key"), "digest").select("doc_id", "key")
    several = held.groupBy("doc_id").agg(F.min("key").alias("b"), F.max("key").alias("most")).where("b <> most").select("doc_id", "b")
    of_one_id = held.join(several, "doc_id").where("key <> b").select(F.col("key").alias("a"), "b").distinct()
    if open_ones.isEmpty():
        comps = scratch.write(connected_components(of_one_id, scratch), "components")
    else:
        comps = _linked_components(docs, open_ones, of_one_id, k, num, den, scratch)

    merged = classes.join(comps.withColumnRenamed("node", "key"), "key", "left").select("digest", F.col("key").alias("class_id"), F.coalesce("component", "key").alias("component_id"))
    out = own.where("doc_id is not null and n > 0").join(merged, "digest").select("doc_id", F.col("n").alias("n_shingles"), "component_id", "class_id")
    alone = own.where("doc_id is null or n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.col("doc_id").alias("class_id"))
    result = scratch.write(out.unionByName(alone), "result")
    scratch.keep_only(result)
    return result
