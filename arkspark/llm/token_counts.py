"""Token counts by an exact histogram of encoded lengths.

Documents are encoded whole and counted by their number of tokens. Suffix sums over that histogram answer, for every
context limit, how many documents and tokens there are, how many lie above, what is left after truncation, and which
share of documents fits.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from arkspark.llm.common import only

RANKS_PATH = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the pre-tokenisation pattern that belongs to these ranks.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_ENCODINGS: dict[int, object] = {}


def encoding_of(ranks: bytes, pattern: str):
    """The encoding of a ranks file, built once per process."""
    import tiktoken

    key = hash((ranks, pattern))
    if key not in _ENCODINGS:
        pairs = (line.split() for line in ranks.splitlines() if line)
        _ENCODINGS[key] = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks={base64.b64decode(a): int(b) for a, b in pairs}, special_tokens={})
    return _ENCODINGS[key]


def _lengths(ranks, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoding_of(ranks.value, pattern).encode_ordinary
        for batch in batches:
            found: dict[int, int] = {}
            for text in batch.column("text"):
                n = len(encode(text.as_py() or ""))
                found[n] = found.get(n, 0) + 1
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int64()), pa.array(list(found.values()), pa.int64())], ["length", "n"])

    return run


def length_histogram(docs: DataFrame, ranks_path: str = RANKS_PATH, pattern: str = PATTERN) -> DataFrame:
    """(length, docs): how many rows of ``docs`` (text; other columns are ignored) have so many tokens.

    Null and empty texts have length 0; repeated rows count again; an empty table gives no rows. The ranks file is
    read by the driver and shipped; strings of special tokens are ordinary text.
    """
    with open(ranks_path, "rb") as f:
        ranks = docs.sparkSession.sparkContext.broadcast(f.read())
    counts = only(docs, text="string").mapInArrow(_lengths(ranks, pattern), "length long, n long")
    return counts.groupBy("length").agg(F.sum("n").alias("docs"))


def limit_report(histogram: DataFrame) -> DataFrame:
    """For every length that occurs, taken as the context limit: context_limit, docs, tokens (of documents of that
    length), docs_above, tokens_above, truncated_total (tokens left if documents are cut at the limit), total_tokens,
    fitting_share (of documents at most that long: the limit is the quantile of that share).

    The histogram has at most as many rows as the longest document has tokens; only it is put in one order.
    """
    df = histogram.withColumn("tokens", F.col("length") * F.col("docs"))
    above = Window.orderBy(F.col("length").desc()).rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.orderBy(F.col("length").desc()).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    zero = F.lit(0).cast("long")
    df = df.withColumn("docs_above", F.coalesce(F.sum("docs").over(above), zero)).withColumn("tokens_above", F.coalesce(F.sum("tokens").over(above), zero))
    df = df.withColumn("docs_upto", F.sum("docs").over(upto)).withColumn("tokens_upto", F.sum("tokens").over(upto))
    return df.select(
        F.col("length").alias("context_limit"), "docs", "tokens", "docs_above", "tokens_above",
        (F.col("tokens_upto") + F.col("length") * F.col("docs_above")).alias("truncated_total"),
        (F.col("tokens_upto") + F.col("tokens_above")).alias("total_tokens"),
        (F.col("docs_upto") / (F.col("docs_upto") + F.col("docs_above"))).alias("fitting_share"),
    )


def length_quantile(report: DataFrame, share: float) -> DataFrame:
    """(context_limit): the smallest limit that at least this share of the documents fits."""
    return report.where(F.col("fitting_share") >= share).agg(F.min("context_limit").alias("context_limit"))


def truncated_at(report: DataFrame, limit: int) -> DataFrame:
    """(docs_above, truncated_total, total_tokens) of any limit, between lengths that occur too."""
    known = F.col("context_limit") <= limit
    at = F.max(F.when(known, F.struct("context_limit", "truncated_total", "docs_above")))
    return report.agg(at.alias("at"), F.max("total_tokens").alias("total_tokens"), F.sum("docs").alias("n")).select(
        F.coalesce("at.docs_above", "n").alias("docs_above"),
        F.coalesce(F.col("at.truncated_total") + (limit - F.col("at.context_limit")) * F.col("at.docs_above"), limit * F.col("n")).alias("truncated_total"),
        "total_tokens",
    )
