"""A bounded sample of labelled documents, and held-out folds by CRC-32."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arkspark.llm.common import only


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null for null."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(folds))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int, rows: int) -> DataFrame:
    """(doc_id, text, label) of at most ``rows`` labelled documents outside the held-out fold, drawn by hash of the id.

    The drawn ids and labels are at most ``rows`` small rows, so that they are broadcast and no text is shuffled.
    Null ids and labels are left out; of several labels of a document the largest counts, and of several texts of one
    id the one with the least hash.
    """
    known = only(labels, doc_id="long", **{label: "int"}).where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
    known = known.where(fold(F.col("doc_id"), folds) != held_out).groupBy("doc_id").agg(F.max(label).alias("label"))
    drawn = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    found = only(docs, doc_id="long", text="string").join(F.broadcast(drawn), "doc_id")
    return found.groupBy("doc_id", "label").agg(F.min_by("text", F.xxhash64("text")).alias("text")).select("doc_id", "text", "label")
