"""The n-gram join where very many documents share a set or an n-gram."""

import random

import pyarrow as pa
from pyspark.sql import functions as F

from arkspark.llm import ngram_join
from tests.llm.test_operators import components, docs


def test_rows_of_documents_are_not_piled_up(monkeypatch):
    """Rows come out batch by batch, while what is read is not more than what was given out by more than a batch."""
    read, columns = [0], ["bucket", "doc_id", "n", "digest", "name", "block"]

    def batches():
        for at in range(1000):
            n = 1000
            read[0] += n
            yield pa.RecordBatch.from_arrays([pa.array([-1] * n, pa.int32()), pa.array(range(at, at + n), pa.int64()), pa.array([0] * n, pa.int64()), pa.array([b"d"] * n, pa.binary()), pa.array([5] * n, pa.int64()), pa.nulls(n, pa.binary())], columns)

    given = 0
    for out in ngram_join._count_private(batches()):
        given += out.num_rows
        assert read[0] - given <= 1000
    assert given == 1_000_000


def test_equal_texts_are_dealt_evenly(spark):
    rows = spark.range(40_000).select(F.col("id").alias("doc_id"), F.lit("").alias("text")).repartition(4)
    packed = rows.mapInArrow(ngram_join._profiles(5, ngram_join.slice_end(8, 10)), ngram_join._PACKED).where("digest is not null")
    most = packed.repartition(16, "bucket").groupBy(F.spark_partition_id()).count().agg(F.max("count"), F.count("*")).first()
    assert most[0] < 2 * 40_000 / 16 and most[1] == 16


def test_large_groups_by_blocks(spark, monkeypatch):
    """Groups of many blocks, with chains within and across them, against brute force."""
    monkeypatch.setattr(ngram_join, "BLOCK", 16)
    monkeypatch.setattr(ngram_join, "SMALL_GROUP", 8)
    monkeypatch.setattr(ngram_join, "RANKS", (1, 2, 1 << 62))
    draw = random.Random(11)
    base = [f"w{i}" for i in range(50)]
    texts = {}
    for family in range(5):
        words = [*base[:30], *(f"f{family}-{i}" for i in range(30))]
        for j in range(40):
            if draw.random() < 0.7:
                words = list(words)
                words[draw.randrange(30, 60)] = f"x{family}-{j}"
            texts[family * 100 + j] = " ".join(words)
    for j in range(60):
        texts[1000 + j] = " ".join([*base[:40], *(f"y{j}-{i}" for i in range(40))])
    got = {r.doc_id: r.component_id for r in ngram_join.ngram_jaccard_join(docs(spark, *((i, t, "s") for i, t in texts.items())), 3, 8, 10).collect()}
    want = components(texts, 3, 8, 10)
    assert got == want and 5 < len(set(want.values())) < len(texts)
