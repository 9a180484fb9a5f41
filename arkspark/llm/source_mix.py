"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Each document draws an exponential key, divided by its quality weight, which grows with the score of the pairwise
quality classifier; within its source, documents come in the order of their keys, so that better ones tend to come
first. A source's token target is met by complete epochs of all its
documents and then by those, in key order, of whose words more than half come before the rest of the budget ends.

The running sum isn't taken over a whole source: keys fall into ``BINS`` bins in key order, bins are summed over all
documents, and only documents of the one bin in which a source's budget ends are put in order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arkspark.llm.common import Scratch, only, texts
from arkspark.llm.pairwise_quality import FEATURES, QualityModel, features

#: Keys are exponential with a rate of the weight. By the distribution of the least weight, no bin has more than the greatest weight by the least one, by BINS, of any documents.
BINS = 1 << 13
WEIGHTS = (3, 1, 2)
#: The weight of a document with the score 0; one with the score 1 weighs 1 more.
LEAST_WEIGHT = 0.25


def _measured(model):
    """Of each text its number of words, runs of other characters than ASCII white space; its weight; its MD5."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, rows in texts(batches, "text"):
            if model is None:
                weight = np.ones(len(rows))
            else:
                weight = LEAST_WEIGHT + model.value.scores(np.array([features(t) for t in rows]).reshape(-1, len(FEATURES)))
            sizes = pa.array([len((t or b"").split()) for t in rows], pa.int64())
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("source"), sizes, pa.array(weight), pa.array([hashlib.md5(t or b"").digest() for t in rows], pa.binary())], ["doc_id", "source", "size", "weight", "tie"])

    return run


def uniform(doc_id: Column, seed: int, otherwise: Column | str = "") -> Column:
    """In (0, 1), from the first 52 bits of an MD5 of seed and id, or ``otherwise`` for a null id: the same in every run."""
    otherwise = otherwise if isinstance(otherwise, Column) else F.lit(otherwise)
    drawn = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), otherwise))), 1, 13), 16, 10).cast("double")
    return (drawn + 0.5) / float(1 << 52)


def source_targets(sizes: DataFrame, share: float = 1.5, cap: float = 2.0, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """(source, source_size, target) from (source, source_size), one row per source; null is a source, in last place.

    Sources by code point weigh ``weights``, repeating. Together they get ``share`` of all sizes; none gets above
    ``cap`` times its own size, and the excess is shared out again by weight. That is filling up to one level:
    target = least(cap * size, level * weight), found over sources in order of cap * size / weight.
    """
    ranked = sizes.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    n = len(weights)
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.pmod(F.col("rank") - 1, F.lit(n)) + 1).cast("int"))
    ranked = ranked.withColumn("weight", weight).withColumn("cap", F.lit(cap) * F.col("source_size"))
    order = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    everything = Window.partitionBy(F.lit(1))
    filled = F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    weighing = F.sum("weight").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    budget = F.lit(share) * F.sum("source_size").over(everything)
    ranked = ranked.withColumn("level", (budget - filled) / weighing)
    open_level = F.min(F.when(F.col("cap") > F.col("level") * F.col("weight"), F.struct((F.col("cap") / F.col("weight")).alias("o"), F.col("rank"), F.col("level")))).over(everything)["level"]
    return ranked.withColumn("target", F.when(open_level.isNull(), F.col("cap")).otherwise(F.least(F.col("cap"), open_level * F.col("weight")))).select("source", "source_size", "target")


def mix_sources(docs: DataFrame, model: QualityModel | None = None, share: float = 1.5, cap: float = 2.0, weights: tuple[int, ...] = WEIGHTS, seed: int = 42, scratch: Scratch | None = None) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken) for every row of ``docs`` (doc_id, text, source).

    Weights come of the scores of ``model``; without one all documents weigh the same. The texts are read once, into a
    table of one short row per document; what each source takes is planned in a table of one row per source, whose size Spark knows when it
    joins the two.

    taken counts the words that the mix takes of the document, repeats counted: the complete epochs of its source
    times its size, and once more if the middle of its words comes, in the running sum, before the end of what is left
    of the target. Its source's words thus end within half a document of the target. Ties in the key go by doc_id, then by text; equal
    rows share their place in any order. Null or empty texts have size 0 and take 0; a null doc_id draws the key of its
    text; null sources form one source. An empty table gives no rows.
    """
    scratch = scratch or Scratch(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model) if model else None
    df = only(docs, doc_id="long", text="string", source="string").mapInArrow(_measured(shared), "doc_id long, source string, size long, weight double, tie binary")
    df = df.withColumn("key", -F.log(uniform(F.col("doc_id"), seed, F.hex("tie"))) / F.col("weight")).drop("weight")
    df = scratch.write(df.withColumn("bin", F.floor((1 - F.exp(-LEAST_WEIGHT * F.col("key"))) * BINS).cast("int")), "sizes")
    bins = df.groupBy("source", "bin").agg(F.sum("size").alias("bin_size"))
    targets = source_targets(bins.groupBy("source").agg(F.sum("bin_size").alias("source_size")), share, cap, weights)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    targets = targets.withColumn("epochs", epochs).withColumn("left", F.col("target") - F.col("epochs") * F.col("source_size"))
    before = Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    edges = bins.withColumn("before", F.coalesce(F.sum("bin_size").over(before), F.lit(0))).alias("b").join(targets.alias("t"), F.expr("b.source <=> t.source"))
    edges = edges.where("b.before + b.bin_size > t.left").groupBy("t.source", "source_size", "target", "epochs", "left").agg(F.min(F.struct("bin", "before")).alias("edge"))
    plan = targets.alias("t").join(edges.alias("e"), F.expr("t.source <=> e.source"), "left").select("t.source", "t.source_size", "t.target", "t.epochs", "t.left", F.col("e.edge.bin").alias("edge_bin"), F.col("e.edge.before").alias("edge_before"))
    plan = scratch.write(plan, "plan")
    rows = df.alias("d").join(plan.alias("p"), F.expr("d.source <=> p.source")).select("d.*", "p.source_size", "p.target", "p.epochs", "p.left", "p.edge_bin", "p.edge_before")
    out = ["doc_id", "source", "size", "source_size", "target"]
    whole = rows.where("edge_bin is null or bin <> edge_bin").select(*out, (F.col("size") * (F.col("epochs") + F.when(F.col("edge_bin").isNull() | (F.col("bin") < F.col("edge_bin")), F.lit(1).cast("long")).otherwise(0) * F.when(F.col("left") > 0, 1).otherwise(0))).alias("taken"))
    sums = F.sum("size").over(Window.partitionBy("source").orderBy("key", "doc_id", "tie").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    edge = rows.where("bin = edge_bin").withColumn("upto", F.col("edge_before") + sums).select(*out, (F.col("size") * (F.col("epochs") + F.when(2 * F.col("upto") - F.col("size") < 2 * F.col("left"), 1).otherwise(0))).alias("taken"))
    return whole.unionByName(edge)
