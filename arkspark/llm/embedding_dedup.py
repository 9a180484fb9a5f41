"""Near duplicates among embeddings by a random-projection tree forest with spill.

1. Equal vectors become one class, with their number as its weight.
2. ``TREES`` trees are fitted on a sample of at most about ``FIT_VECTORS`` classes, drawn by hash, and all classes go down all of them
   (``projection_forest``), each to several leaves at times. Leaves that hold more than they should are fitted and cut again,
   each on a sample of its own of about ``FIT_NODE``, until none is left but those that no cut parts.
3. Vectors are compared within leaves, on 16-bit copies whose error is bounded. A pair counts in the first leaf that both are in, so
   that links are counted where they are found and no pairs need to be gathered. Pairs within the error of the
   threshold are verified by the whole vectors in double precision.
4. Leaves of over ``BLOCK`` classes are dealt out by pairs of blocks. Those that no cut parts are dense: classes within half the
   threshold's angle of the leaf's centre are linked by the triangle inequality, so that they are counted, not compared; only the others
   are compared with them and with each other.
5. Links are united to components.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arkspark.llm import projection_forest as forest
from arkspark.llm.common import Scratch, only
from arkspark.llm.components import connected_components

THRESHOLD = 0.9
TREES = 8
LEAF = 256
BLOCK = 512
FIT_VECTORS = 1 << 14
FIT_NODE = 1 << 10

_CLASS = "digest binary, vec_id long, dim int, vec binary"
_PLACED = "key long, weight long, leaves array<long>, ball long, dim int, q binary, step double, off double"
_CUTS = "leaf long, dim int, attempt array<int>, cut array<double>, left array<int>, right array<int>, final array<int>, centres array<double>"
_FOUND = "key long, n long, other long, close boolean"


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors as bytes, of four a number if none is changed by it, and their digest; none of those that link with nothing."""
    for batch in batches:
        digests, dims, held = [], [], []
        for row in batch.column("embedding"):
            numbers = row.values.to_numpy(zero_copy_only=False).astype(np.float64) + 0.0 if row.is_valid else np.empty(0)
            if len(numbers) and np.isfinite(numbers).all() and numbers.any():
                digests.append(hashlib.blake2b(numbers.tobytes(), digest_size=16).digest())
                with np.errstate(over="ignore"):
                    short = numbers.astype(np.float32)
                held.append(short.tobytes() if (short == numbers).all() else numbers.tobytes())
                dims.append(len(numbers))
            else:
                digests.append(None)
                held.append(None)
                dims.append(None)
        yield pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), batch.column("vec_id"), pa.array(dims, pa.int32()), pa.array(held, pa.binary())], ["digest", "vec_id", "dim", "vec"])


def _vectors(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, unit vectors) of the batch by dimension."""
    dims, held = batch.column("dim").to_numpy(), batch.column("vec").to_pylist()
    for dim in np.unique(dims).tolist():
        rows = np.flatnonzero(dims == dim)
        yield rows, forest.unit(np.stack([np.frombuffer(held[r], np.float32 if len(held[r]) == 4 * dim else np.float64).astype(np.float64) for r in rows]))


def _fit(leaf_rows: int, threshold: float, last: bool):
    """Cuts of the node that the rows of a group are a sample of; each stands for ``each`` rows. ``last``: what isn't cut now is an end for good."""

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        batch = rows.combine_chunks().to_batches()[0]
        dim, node = batch.column("dim")[0].as_py(), batch.column("leaf")[0].as_py()
        (_, x), *_ = _vectors(batch)
        cuts = forest.fit_cuts(x, batch.column("each")[0].as_py(), node, leaf_rows, threshold)
        if last and cuts.final == [0]:
            cuts = forest.Cuts(final=[1], centres=forest.unit(x.mean(axis=0, keepdims=True) + 1e-300)[0].tolist())
        columns = [[node], [dim], [cuts.attempt], [cuts.cut], [cuts.left], [cuts.right], [cuts.final], [cuts.centres]]
        kinds = [pa.int64(), pa.int32(), *(pa.list_(k) for k in (pa.int32(), pa.float64(), pa.int32(), pa.int32(), pa.int32(), pa.float64()))]
        return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["leaf", "dim", "attempt", "cut", "left", "right", "final", "centres"])

    return run


def _cuts(row) -> forest.Cuts:
    return forest.Cuts(*(list(row[c]) for c in ("attempt", "cut", "left", "right", "final", "centres")))


def _lists(counts: np.ndarray, flat: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(counts))).astype(np.int32)), pa.array(flat, pa.int64()))


def _place(trees: int, threshold: float, fitted):
    """Where all trees take each class; ``fitted`` has the cuts of each root, by (tree, dimension)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        directions = forest.Directions()
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            rows, ids, cores = [], [], []
            q, step, off = [b""] * n, np.zeros(n), np.zeros(n)
            for at, x in _vectors(batch):
                numbers, step[at], off[at] = forest.quantised(x)
                for r, v in zip(at.tolist(), numbers, strict=True):
                    q[r] = v.tobytes()
                for tree in range(trees):
                    root = forest.root_of(tree, x.shape[1])
                    for own, leaf, core in forest.descend(x, fitted.value.get(root) or forest.Cuts(final=[0]), root, threshold, directions):
                        rows.append(at[own])
                        ids.append(np.full(len(own), leaf))
                        cores.append(core)
            rows, ids, cores = np.concatenate(rows), np.concatenate(ids), np.concatenate(cores)
            order = np.lexsort((ids, rows))
            rows, ids, cores = rows[order], ids[order], cores[order]
            balls = np.zeros(n, np.int64)
            held, first = np.unique(rows[cores], return_index=True)
            balls[held] = ids[cores][first]
            leaves = _lists(np.bincount(rows, minlength=n), ids)
            balls = pa.array(balls, pa.int64(), mask=balls == 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("weight"), leaves, balls, batch.column("dim"), pa.array(q, pa.binary()), pa.array(step), pa.array(off)], ["key", "weight", "leaves", "ball", "dim", "q", "step", "off"]
            )

    return run


def _place_again(threshold: float):
    """From rows of a class in a leaf with the leaf's cuts: (key, leaf, ball) of the ends that it comes to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        directions = forest.Directions()
        for batch in batches:
            nodes = batch.column("leaf").to_numpy()
            keys, ids, cores = [], [], []
            for node in np.unique(nodes).tolist():
                mine = batch.take(pa.array(np.flatnonzero(nodes == node)))
                cuts, (_, x) = _cuts({c: mine.column(c)[0].as_py() for c in ("attempt", "cut", "left", "right", "final", "centres")}), next(_vectors(mine))
                own = mine.column("key").to_numpy()
                for rows, leaf, core in forest.descend(x, cuts, node, threshold, directions):
                    keys.append(own[rows])
                    ids.append(np.full(len(rows), leaf))
                    cores.append(core)
            flat = [np.concatenate([*x, np.empty(0, kind)]) for x, kind in ((keys, np.int64), (ids, np.int64), (cores, bool))]
            yield pa.RecordBatch.from_arrays([pa.array(flat[0]), pa.array(flat[1]), pa.array(flat[1], pa.int64(), mask=~flat[2])], ["key", "leaf", "ball"])

    return run


def _drawn(share) -> F.Column:
    """Rows drawn by hash of the class, a ``share`` of all."""
    return F.pmod(F.xxhash64("key", F.lit("fit")), F.lit(1 << 30)) < share * (1 << 30)


def _compare(threshold: float):
    """From rows sorted by leaf and block pair: links counted, edges, and pairs too close to the threshold, leaf by leaf."""
    group = ("leaf", "lo", "hi")

    def told(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(parts).combine_chunks()
        column = lambda c: rows.column(c).combine_chunks()
        key, dims = column("key").to_numpy(), column("dim").to_numpy()
        dots = np.stack([np.frombuffer(q, np.int16) for q in column("q").to_pylist()]).astype(np.float64) * column("step").to_numpy()[:, None]
        before = column("leaves")
        ends, flat = np.asarray(before.offsets), np.asarray(before.values)
        earlier = [flat[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
        assert (dims == dims[0]).all()
        found = forest.Leaf(key, column("weight").to_numpy(), dots, column("off").to_numpy(), column("ball").fill_null(0).to_numpy(zero_copy_only=False), column("side").to_numpy(), rows.column("lo")[0].as_py() != rows.column("hi")[0].as_py(), earlier)
        counts, edges, close = forest.compare(found, threshold)
        some = np.flatnonzero(counts)
        out = [(int(key[r]), int(counts[r]), None, False) for r in some] + [(a, 0, b, False) for a, b in edges] + [(a, 0, b, True) for a, b in close]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True) if out else ([],) * 4, (pa.int64(), pa.int64(), pa.int64(), pa.bool_()), strict=True)], ["key", "n", "other", "close"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, last = [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            of = np.stack([batch.column(c).to_numpy() for c in group])
            cuts = [0, *(np.flatnonzero((of[:, 1:] != of[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                now = tuple(of[:, a].tolist())
                if parts and now != last:
                    yield told(parts)
                    parts = []
                parts.append(batch.slice(a, b - a))
                last = now
        if parts:
            yield told(parts)

    return run


def _placed(classes: DataFrame, n: int, trees: int, leaf_rows: int, fit_vectors: int, fit_node: int, threshold: float, scratch: Scratch) -> DataFrame:
    """All classes with the ids of their leaves, in order, and that of their ball."""
    spark = classes.sparkSession
    share = min(1.0, fit_vectors / n)
    roots = F.transform(F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: F.shiftleft(F.shiftleft(t.cast("long"), 32) + F.col("dim"), 1))
    sample = classes.where(_drawn(share)).select("dim", "vec", F.explode(roots).alias("leaf"), F.lit(1 / share).alias("each"))
    # A few thousand numbers for each tree and dimension, however large the table.
    fitted = {row.leaf: _cuts(row) for row in sample.groupBy("leaf").applyInArrow(_fit(leaf_rows, threshold, False), _CUTS).collect()}
    shared = spark.sparkContext.broadcast(fitted)
    placed = scratch.write(classes.mapInArrow(_place(trees, threshold, shared), _PLACED), "placed")
    shared.destroy()

    # Even leaves of twice what they should hold are cut again; odd ones are as they must be.
    members, again = None, placed.select(F.explode("leaves").alias("leaf"))
    while True:
        large = again.where("leaf & 1 = 0").groupBy("leaf").agg(F.count("*").alias("m")).where(F.col("m") > 2 * leaf_rows)
        large = scratch.write(large, "large")
        if large.isEmpty():
            break
        if members is None:
            members = placed.select("key", F.explode("leaves").alias("leaf"), "ball")
        rows = members.select("key", "leaf").join(large, "leaf").join(classes.select("key", "dim", "vec"), "key")
        rows = scratch.write(rows, "again")
        sample = rows.withColumn("each", F.greatest(F.lit(1.0), F.col("m") / fit_node)).where(_drawn(1 / F.col("each"))).select("leaf", "dim", "vec", "each")
        cuts = scratch.write(sample.groupBy("leaf").applyInArrow(_fit(leaf_rows, threshold, True), _CUTS), "cuts")
        new = rows.select("leaf", "key", "dim", "vec").join(cuts.drop("dim"), "leaf").mapInArrow(_place_again(threshold), "key long, leaf long, ball long")
        # Leaves of which no row was drawn wait for the next draw, as they are.
        members = members.join(cuts.select("leaf"), "leaf", "left_anti").select("key", "leaf", "ball").unionByName(new)
        members = scratch.write(members, "members")
        again = members.select("leaf")
    if members is None:
        return placed
    leaves = members.groupBy("key").agg(F.array_sort(F.collect_list("leaf")).alias("leaves"), F.min("ball").alias("ball"))
    return scratch.write(placed.drop("leaves", "ball").join(leaves, "key"), "placed")


def _dealt(placed: DataFrame, block: int, scratch: Scratch) -> DataFrame:
    """A row for each class and leaf of several, dealt by block pairs where the leaf has over ``block`` classes."""
    rows = placed.select("*", F.explode("leaves").alias("leaf"))
    sizes = rows.groupBy("leaf", "ball").agg(F.count("*").alias("n"))
    sizes = sizes.groupBy("leaf").agg(F.sum("n").alias("m"), F.max_by("ball", F.when(F.col("ball").isNotNull(), F.col("n"))).alias("most"), F.coalesce(F.max(F.when(F.col("ball").isNotNull(), F.col("n"))), F.lit(0)).alias("dense"))
    large = scratch.write(sizes.where(F.col("m") > block), "large")
    earlier = F.filter("leaves", lambda x: x < F.col("leaf")).alias("leaves")
    rows = rows.select("key", "weight", earlier, "ball", "dim", "q", "step", "off", "leaf")
    if large.isEmpty():
        return rows.withColumns({"lo": F.lit(0), "hi": F.lit(0), "side": F.lit(0)})
    blocks = lambda n: f"cast(({n} + {block - 1}) div {block} as int)"
    rows = rows.join(large, "leaf", "left").withColumn("is_dense", F.coalesce(F.col("ball") == F.col("most"), F.lit(False)))
    rows = rows.withColumn("others", F.expr(blocks("(m - dense)"))).withColumn("all", F.expr(f"others + {blocks('dense')}"))
    draw = F.xxhash64("key", F.lit("block"))
    mine = F.when(F.col("is_dense"), F.col("others") + F.pmod(draw, F.col("all") - F.col("others"))).otherwise(F.pmod(draw, F.col("others"))).cast("int")
    met = F.when(F.col("is_dense"), F.col("others")).otherwise(F.col("all"))
    meets = F.when(F.col("m").isNull(), F.array(F.lit(0))).when(met > 0, F.sequence(F.lit(0), met - 1)).otherwise(F.array().cast("array<int>"))
    rows = rows.withColumn("mine", F.coalesce(mine, F.lit(0))).withColumn("with", F.explode(meets))
    rows = rows.withColumns({"lo": F.least("mine", "with"), "hi": F.greatest("mine", "with"), "side": (F.col("mine") < F.col("with")).cast("int")})
    return rows.select("key", "weight", "leaves", "ball", "dim", "q", "step", "off", "leaf", "lo", "hi", "side")


def _verified(close: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """(a, b, weights of both): the pairs whose cosine by the whole vectors reaches the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cosines = np.zeros(batch.num_rows)
            both = []
            for side in "ab":
                out: list[np.ndarray] = [np.empty(0)] * batch.num_rows
                for rows, x in _vectors(pa.RecordBatch.from_arrays([batch.column("dim"), batch.column("vec" + side)], ["dim", "vec"])):
                    for r, v in zip(rows.tolist(), x, strict=True):
                        out[r] = v
                both.append(out)
            for r, (x, y) in enumerate(zip(*both, strict=True)):
                cosines[r] = x @ y
            yield batch.select(["a", "b", "wa", "wb"]).filter(pa.array(cosines >= threshold))

    x, y = (classes.select(F.col("key").alias(e), F.col("weight").alias("w" + e), F.col("vec").alias("vec" + e), "dim") for e in "ab")
    return close.join(x, "a").join(y.drop("dim"), "b").select("a", "b", "wa", "wb", "dim", "veca", "vecb").mapInArrow(run, "a long, b long, wa long, wb long")


def embedding_near_duplicates(
    embeddings: DataFrame, threshold: float = THRESHOLD, trees: int = TREES, leaf_rows: int = LEAF, block: int = BLOCK, fit_vectors: int = FIT_VECTORS, fit_node: int = FIT_NODE, scratch: Scratch | None = None
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for each row of ``embeddings`` (vec_id, embedding; other columns are ignored).

    Rows link if the cosine of their vectors is at least ``threshold``; n_links counts the other rows linked, component_id is the
    smallest vec_id reachable by links, kept tells whether that is the row's own. Vectors that are null, empty, zero or hold
    null or non-finite numbers link with nothing, and so do vectors of unequal lengths with each other. Repeated rows count each as a vector of its own; rows
    of one id share their component. Rows without an id link with nothing, have no component and are kept. Equal vectors are always linked; of links
    between unequal ones the forest finds nearly all, and reports none that isn't one. An empty table gives no rows.
    """
    spark = embeddings.sparkSession
    scratch = scratch or Scratch(spark)
    read = only(embeddings, vec_id="long", embedding="array<double>").mapInArrow(_read, _CLASS)
    rows = scratch.write(read.select("vec_id", F.when(F.col("vec_id").isNotNull(), F.col("digest")).alias("digest")), "rows")
    classes = read.where("vec_id is not null and digest is not null").groupBy("digest").agg(F.min("vec_id").alias("key"), F.count("*").alias("weight"), F.first("dim").alias("dim"), F.first("vec").alias("vec"))
    held = rows.where("digest is not null")
    several = scratch.write(held.groupBy("vec_id").agg(F.min("digest").alias("a"), F.max("digest").alias("b")).where("a <> b").select("vec_id"), "several")
    # A class is known by its smallest id; where ids have several vectors, by a hash.
    key = F.col("vec_id") if several.isEmpty() else F.xxhash64("digest")
    classes = scratch.write(classes.withColumn("vec_id", F.col("key")).withColumn("key", key), "classes")
    n = classes.count()
    of_one_id = held.join(several, "vec_id").select("vec_id", F.xxhash64("digest").alias("key")).distinct()
    of_one_id = of_one_id.join(of_one_id.groupBy("vec_id").agg(F.min("key").alias("b")), "vec_id").where("key <> b").select(F.col("key").alias("a"), "b")
    if n:
        placed = _placed(classes, n, trees, leaf_rows, fit_vectors, fit_node, threshold, scratch)
        dealt = _dealt(placed, block, scratch).repartition("leaf", "lo", "hi").sortWithinPartitions("leaf", "lo", "hi")
        found = scratch.write(dealt.mapInArrow(_compare(threshold), _FOUND), "found")
        close = _verified(found.where("close").select(F.col("key").alias("a"), F.col("other").alias("b")), classes, threshold)
        close = scratch.write(close, "close")
        balls = placed.where("ball is not null").groupBy("ball").agg(F.sum("weight").alias("total"), F.min("key").alias("least"))
        balls = scratch.write(balls, "balls")
        in_balls = placed.where("ball is not null").select("key", "ball", "weight").join(balls, "ball")
        counts = found.where("n > 0").select("key", "n").unionByName(close.select(F.col("a").alias("key"), F.col("wb").alias("n"))).unionByName(close.select(F.col("b").alias("key"), F.col("wa").alias("n")))
        counts = counts.unionByName(in_balls.select("key", (F.col("total") - F.col("weight")).alias("n"))).groupBy("key").agg(F.sum("n").alias("n"))
        edges = found.where("other is not null and not close").select(F.col("key").alias("a"), F.col("other").alias("b")).unionByName(close.select("a", "b")).unionByName(in_balls.select(F.col("key").alias("a"), F.col("least").alias("b")))
        edges = edges.unionByName(of_one_id)
    else:
        counts, edges = spark.createDataFrame([], "key long, n long"), spark.createDataFrame([], "a long, b long")
    comps = scratch.write(connected_components(edges, scratch), "components")

    told = classes.join(comps.withColumnRenamed("node", "key"), "key", "left").withColumn("component", F.coalesce("component", "key"))
    told = scratch.write(told.join(counts, "key", "left").select("digest", "vec_id", "component", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links")), "told")
    least = told.groupBy("component").agg(F.min("vec_id").alias("component_id"))
    told = told.join(least, "component").select("digest", "n_links", "component_id")
    linked = rows.where("digest is not null").join(told, "digest").select("vec_id", "n_links", "component_id")
    alone = rows.where("digest is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    result = linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
    result = scratch.write(result, "result")
    scratch.keep_only(result)
    return result
