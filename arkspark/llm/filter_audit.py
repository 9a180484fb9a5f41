"""Audit of how filters interact, for every order of applying them.

A document is told by the set of filters that it fails, so that the documents of a part come down to counts by that set.
The states of the lattice are the sets of filters applied so far; an edge adds one filter and removes the documents that
fail it and none of the state. Counting paths forward (orders that reach a state) and backward (orders that go on from it)
weighs each edge with the orders that use it: the removals of a filter's edges with these weights are its Shapley sum, and
each step of each order is read from the same edges.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence
from itertools import permutations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arkspark.llm.common import Scratch, only, texts

#: Takes a text's UTF-8 bytes; true if the text fails.
Filter = Callable[[bytes], bool]

MIN_WORDS = 200
MIN_DISTINCT_PERCENT = 50
MAX_CAPITALS_PERCENT = 2
CAPITALS = bytes(range(65, 91))
CONTINUATION = bytes(range(0x80, 0xC0))
SYMBOLS = b"#$%&*|"


def few_words(text: bytes) -> bool:
    return len(text.split()) < MIN_WORDS


def repetitive(text: bytes) -> bool:
    words = text.split()
    return 100 * len(set(words)) < MIN_DISTINCT_PERCENT * len(words)


def shouting(text: bytes) -> bool:
    capitals = len(text) - len(text.translate(None, CAPITALS))
    return 100 * capitals > MAX_CAPITALS_PERCENT * len(text.translate(None, CONTINUATION))


def has_symbols(text: bytes) -> bool:
    return len(text.translate(None, SYMBOLS)) < len(text)


TEXT_FILTERS: dict[str, Filter] = {"A": few_words, "B": repetitive, "C": shouting, "D": has_symbols}
#: The filter that no text tells by itself: an earlier document has the same one.
REPEATED = "E"


def lattice_edges(n: int) -> list[tuple[int, int, int]]:
    """(state, filter, orders) of the subset lattice over ``n`` filters: the orders that pass each edge, as the paths that
    reach its lower state times those that leave its upper one."""
    top = (1 << n) - 1
    reach, leave = {0: 1}, {top: 1}
    for state in range(1, top + 1):
        reach[state] = sum(reach[state & ~(1 << f)] for f in range(n) if state >> f & 1)
    for state in range(top - 1, -1, -1):
        leave[state] = sum(leave[state | 1 << f] for f in range(n) if not state >> f & 1)
    return [(state, f, reach[state] * leave[state | 1 << f]) for state in range(top + 1) for f in range(n) if not state >> f & 1]


def _profiles(filters: dict[str, Filter]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, rows in texts(batches, "text"):
            held = [t or b"" for t in rows]
            fails = [sum(1 << i for i, fails in enumerate(filters.values()) if fails(t)) for t in held]
            digests = pa.array([hashlib.sha256(t).digest() for t in held], pa.binary())
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("part"), pa.array(fails, pa.int32()), digests], ["doc_id", "part", "fails", "digest"])

    return run


def failure_counts(docs: DataFrame, labels: DataFrame, filters: dict[str, Filter] = TEXT_FILTERS) -> DataFrame:
    """(part, fails, n, good, toxic): documents of each source by the set of filters that they fail, as bits in the order of
    ``filters``, the bit above them for a text that a document of a smaller id has; of them those labelled good and toxic.

    No text is shuffled. What a text fails by itself is the same for all its copies, so that copies need not meet: all
    documents are counted as copies, and one of each text, that of the smallest id, is taken off again.
    """
    scratch, repeated = Scratch(docs.sparkSession), 1 << len(filters)
    docs = only(docs, doc_id="long", source="string", text="string").select("doc_id", F.coalesce("source", F.lit("")).alias("part"), "text")
    told = only(labels, doc_id="long", quality="int", toxic="int").where("doc_id is not null")
    told = told.groupBy(F.col("doc_id").alias("label_id")).agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    rows = docs.mapInArrow(_profiles(filters), "doc_id long, part string, fails int, digest binary")
    rows = rows.join(told, F.col("doc_id") == F.col("label_id"), "left").na.fill(0, ["good", "toxic"])
    rows = scratch.write(rows.groupBy("doc_id", "digest", "part", "fails", "good", "toxic").agg(F.count("*").alias("n")), "profiles")

    tally = [F.sum("n").alias("n"), F.sum(F.col("n") * F.col("good")).alias("good"), F.sum(F.col("n") * F.col("toxic")).alias("toxic")]
    every = rows.groupBy("part", "fails").agg(*tally)
    one_id = rows.groupBy("doc_id", "digest", "fails", "good", "toxic").agg(F.collect_list(F.struct("part", "n")).alias("parts"))
    # Ids before none; rows without an id are no one's copies by themselves.
    first = one_id.groupBy("digest").agg(F.min_by(F.struct("fails", "good", "toxic", "parts"), F.struct(F.col("doc_id").isNull(), "doc_id")).alias("of"))
    first = first.select("of.fails", "of.good", "of.toxic", F.inline("of.parts")).groupBy("part", "fails").agg(*tally)
    as_copy = (F.col("fails") + repeated).alias("fails")
    moved = F.array(F.struct("fails", "n", "good", "toxic"), F.struct(as_copy, *((-F.col(c)).alias(c) for c in ("n", "good", "toxic"))))
    both = every.select("part", as_copy, "n", "good", "toxic").unionByName(first.select("part", F.inline(moved)))
    counts = scratch.write(both.groupBy("part", "fails").agg(*(F.sum(c).alias(c) for c in ("n", "good", "toxic"))), "counts")
    scratch.keep_only(counts)
    return counts


def order_audit(spark: SparkSession, counts: DataFrame, names: Sequence[str]) -> DataFrame:
    """One row per part, order of the filters ``names`` and step of it, from the ``failure_counts`` of that many bits.

    The tables of edges and of steps are as large as the number of filters makes them, whatever the input.
    """
    n = len(names)
    edges = F.array(*(F.struct(F.lit(s).alias("state"), F.lit(f).alias("filter"), F.lit(orders).cast("long").alias("orders")) for s, f, orders in lattice_edges(n)))
    steps = []
    for order in permutations(range(n)):
        state = 0
        for at, f in enumerate(order):
            steps.append(("".join(names[g] for g in order), at + 1, state, f))
            state |= 1 << f
    steps = spark.createDataFrame(steps, "filter_order string, step int, state int, filter int")

    fails = F.expr("shiftright(fails, filter) & 1") == 1
    passed = F.col("fails").bitwiseAND(F.col("state")) == 0
    alone = F.expr("fails = shiftleft(1, filter)")
    total = lambda where, column="n": F.sum(F.when(where, F.col(column)).otherwise(0))
    on_edges = counts.select("*", F.inline(edges)).groupBy("part", "state", "filter", "orders").agg(  # a few rows of each part, never documents
        total(passed & ~fails).alias("kept"),
        total(passed & fails).alias("removed"),
        total(~passed & fails).alias("redundant"),
        total(alone).alias("unique_fails"),
        total(passed & fails, "good").alias("good_lost"),
        total(passed & fails, "toxic").alias("toxic_lost"),
    )
    shapley = on_edges.groupBy("part", "filter").agg(F.sum(F.col("removed") * F.col("orders")).alias("shapley"))
    out = on_edges.join(shapley, ["part", "filter"]).join(F.broadcast(steps), ["state", "filter"])
    numbers: list[Column] = [F.col(c).cast("long").alias(c) for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")]
    return out.select("part", "filter_order", "step", *numbers)


def filter_audit(docs: DataFrame, labels: DataFrame, filters: dict[str, Filter] = TEXT_FILTERS, repeated: str = REPEATED) -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) for each source
    (null: empty string) of ``docs`` (doc_id, source, text), each order of the filters, and each step of it.

    Null texts are empty. Repeated rows count each; those of the smallest id with a text aren't its copies. Rows without an id
    are copies of any document that has one, not of each other. Of several labels of a document one suffices. Columns
    other than these are ignored, whatever their names. An empty table gives no rows; without labels nothing is lost as good or toxic.
    """
    return order_audit(docs.sparkSession, failure_counts(docs, labels, filters), [*filters, repeated])
