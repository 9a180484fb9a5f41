"""Quality rules: within-document statistics and cross-document line frequency.

Normalised lines are hashed and counted over all documents: in how many distinct texts of a host a line stands. Lines
above the limit are boilerplate and are taken out of the texts; a document that they make up for the most part is
depleted and rejected.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from arkspark.llm.common import Scratch, WordIds, only, texts, windows

SYMBOLS = b"#*$%&|<>"
#: A line is boilerplate in more than this share of its host's distinct texts; in tiny hosts, in more texts than the floor.
LINE_TEXTS, LINE_SHARE = 5, 0.01
#: A document is depleted if its other lines hold fewer words than this, and less than this share of its words.
LEFT_WORDS, LEFT_SHARE = 20, 0.2

_SCHEMA = "row_id string, doc_id long, text_hash long, host string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, body long, lines array<struct<h:long,w:int,c:int>>"


def repeated_words(ids: np.ndarray, k: int = 8) -> int:
    """Words that lie in a k-word window found twice or more in the text, the first one included."""
    h = windows(ids, k)
    if len(h) < 2:
        return 0
    order = np.argsort(h, kind="stable")
    same = h[order[1:]] == h[order[:-1]]
    if not same.any():
        return 0
    twice = np.zeros(len(ids) + 1, np.int32)
    at = np.unique(np.concatenate((order[1:][same], order[:-1][same])))
    np.add.at(twice, at, 1)
    np.add.at(twice, at + k, -1)
    return int((np.cumsum(twice) > 0).sum())


def _normal(line: bytes) -> bytes:
    return b" ".join(line.lower().split())


def _line_hash(line: bytes) -> int:
    return xxhash.xxh64_intdigest(_normal(line)) - (1 << 63)


def _row_key(doc_id: Column, host: Column) -> Column:
    return F.concat_ws("-", F.coalesce(doc_id.cast("string"), F.lit("")), host)


def _statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    ids = WordIds()
    symbol = np.zeros(256, np.int64)
    symbol[list(SYMBOLS)] = 1
    for part, rows in texts(batches, "text"):
        columns: list[list] = [[] for _ in range(6)]
        hashes, words_in, times, ends = [], [], [], [0]
        for t in rows:
            t = t or b""
            words = t.split()
            seen: set[bytes] = set()
            dups, lines = 0, {}
            for line in t.split(b"\n"):
                if w := line.split():
                    if line in seen:
                        dups += 1
                    seen.add(line)
                    h = _line_hash(line)
                    n, c = lines.get(h, (0, 0))
                    lines[h] = (n + len(w), c + 1)
            chars = np.bincount(np.frombuffer(t, np.uint8), minlength=256) if t else np.zeros(256, np.int64)
            joined = b"".join(words)
            follow = int(np.count_nonzero((np.frombuffer(joined, np.uint8) & 0xC0) == 0x80)) if joined else 0
            for column, value in zip(columns, (len(words), len(joined) - follow, int((chars * symbol).sum()), dups, repeated_words(ids.of(words)), xxhash.xxh64_intdigest(b" ".join(words)) - (1 << 63)), strict=True):
                column.append(value)
            hashes += lines
            words_in += [n for n, _ in lines.values()]
            times += [c for _, c in lines.values()]
            ends.append(len(hashes))
        held = pa.StructArray.from_arrays([pa.array(hashes, pa.int64()), pa.array(words_in, pa.int32()), pa.array(times, pa.int32())], ["h", "w", "c"])
        names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "body", "lines"]
        yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("row_id", "doc_id", "text_hash", "host")), *(pa.array(c, pa.int64()) for c in columns), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), held)], ["row_id", "doc_id", "text_hash", "host", *names])


@F.pandas_udf(BinaryType())
def _without_lines(texts: pd.Series, gone: pd.Series) -> pd.Series:
    out = []
    for t, hashes in zip(texts, gone, strict=True):
        if t is not None:
            held = set(hashes.tolist())
            t = b"\n".join(x for x in bytes(t).split(b"\n") if not x.split() or _line_hash(x) not in held)
        out.append(t)
    return pd.Series(out, dtype=object)


def quality_rules(docs: DataFrame, host: str = "source", line_texts: int = LINE_TEXTS, line_share: float = LINE_SHARE, left_words: int = LEFT_WORDS, left_share: float = LEFT_SHARE, scratch: Scratch | None = None) -> DataFrame:
    """The columns of ``docs`` (doc_id, text and the host's column are needed) and text_hash, n_words, word_chars,
    n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, frequent_lines, left_words and left_text, for every row.

    Lines are compared by their words, A-Z lower-cased. A line is frequent if it stands in more than ``line_texts``
    distinct texts of its host and in more than ``line_share`` of the host's distinct texts; copies of a text count
    once. left_text is the text without its frequent lines; all other lines stay as they are. A document is rejected if
    base_failed, or if its lines that aren't frequent hold fewer than ``left_words`` words and less than ``left_share``
    of all. Null and empty texts have no words and fail; a null host is a host of its own; a null doc_id keeps its row;
    repeated rows each get theirs; an empty table gives no rows.
    """
    scratch = scratch or Scratch(docs.sparkSession)
    base = only(docs, doc_id="long", text="string", **{host: "string"}).withColumnRenamed(host, "host")
    base = base.select(F.concat_ws("-", F.spark_partition_id(), F.monotonically_increasing_id()).alias("row_id"), "doc_id", F.xxhash64("text").alias("text_hash"), "host", "text")
    stats = scratch.write(base.mapInArrow(_statistics, _SCHEMA), "quality")
    stats = stats.withColumn("host", F.coalesce(F.concat(F.lit("h"), "host"), F.lit("")))
    bodies = stats.select("host", "body", "lines").dropDuplicates(["host", "body"])
    hosts = bodies.groupBy("host").agg(F.count("*").alias("texts"))
    held = bodies.select("host", F.explode("lines").alias("l")).groupBy("host", F.col("l.h").alias("h")).agg(F.count("*").alias("n")).where(F.col("n") > line_texts)
    frequent = held.join(hosts, "host").where(F.col("n") > line_share * F.col("texts")).select("host", "h")
    lines = stats.select("row_id", "host", F.explode("lines").alias("l")).select("row_id", "host", F.col("l.h").alias("h"), F.col("l.w").alias("w"), F.col("l.c").alias("c"))
    gone = lines.join(frequent, ["host", "h"]).groupBy("row_id").agg(F.sum("w").alias("gone_words"), F.sum("c").alias("gone_lines"), F.collect_list("h").alias("_gone"))
    out = stats.drop("lines").join(gone, "row_id", "left")
    left = F.col("n_words") - F.coalesce("gone_words", F.lit(0))
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    depleted = (left < left_words) & (left < left_share * F.col("n_words"))
    verdict = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), (~failed & ~depleted).alias("kept"), F.coalesce("gone_lines", F.lit(0)).alias("frequent_lines"), left.alias("left_words"), "_gone"]
    key = ["_row_key", "text_hash"]
    rules = scratch.write(out.select(_row_key(F.col("doc_id"), F.col("host")).alias("_row_key"), "text_hash", *verdict).dropDuplicates(key), "verdicts")
    scratch.keep_only(rules)
    # Rows of one id, host and text share their verdict, so that texts needn't be written beside their lines.
    rows = docs.withColumn("text_hash", F.xxhash64(F.col("text").cast("string")))
    rows = rows.withColumn("_row_key", _row_key(F.col("doc_id").cast("long"), F.coalesce(F.concat(F.lit("h"), F.col(f"`{host}`").cast("string")), F.lit("")))).join(rules, key)
    text, some = F.col("text").cast("string"), F.col("_gone").isNotNull()
    less = _without_lines(F.when(some, text.cast("binary")), F.col("_gone")).cast("string")
    return rows.withColumn("left_text", F.when(some, less).otherwise(text)).drop("_gone", "_row_key")
