"""What is written of captures: documents, summaries, placeholders and record bundles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def capture_documents(rows: DataFrame) -> DataFrame:
    """(ord, document): a capture as nested request, response and source; absent parts are left out of the JSON.

    The packed size is given only for encoded contents that were longer than their Content-Length.
    rows: ord, url, ts14, status, mime, digest, length, encoding, content_length, source, collection.
    """
    packed = F.when(F.col("encoding").isNotNull() & (F.col("content_length") < F.col("length")), F.col("content_length"))
    body = F.struct(F.col("mime").alias("mimetype"), F.col("length").alias("size"), packed.alias("compressedSize"), F.col("digest").alias("sha256"))
    document = F.struct(
        F.struct(F.lit("GET").alias("method"), "url").alias("request"),
        F.struct("status", body.alias("body")).alias("response"),
        F.struct(F.col("source").alias("type"), "collection", F.struct("url", F.col("ts14").alias("timestamp"), "status", "digest").alias("cdxEntry")).alias("source"),
    )
    return rows.select("ord", F.to_json(document).alias("document"))


def unavailable_inputs(requests: DataFrame, rows: DataFrame) -> DataFrame:
    """Requests without any capture of type ok."""
    return requests.join(rows.where("type = 'ok'").select("request_url").distinct(), "request_url", "left_anti")


def correction_names(corrections):
    """Names of corrected fields as the summary writes them, sorted and joined; others don't show."""
    shown = F.transform(corrections, lambda c: F.when(c["field"] == "captureTime", "capture_ts").when(c["field"] == "url", "url"))
    return F.array_join(F.array_sort(F.array_compact(shown)), "|")


def record_bundles(records: DataFrame) -> DataFrame:
    """(capture, content): each capture's records, an archive's header first, joined byte by byte in their order.

    records: capture, kind, ord, content (binary). A capture has the few records that stand beside it in its archive.
    An ARC record without its header is an error in ``error``, and content is null.
    """
    parts = F.array_sort(F.collect_list(F.struct((F.col("kind") != "arc-header").alias("late"), "ord", F.hex("content").alias("hex"))))
    out = records.groupBy("capture").agg(parts.alias("p"), F.bool_or(F.col("kind") == "arc").alias("arc"), F.bool_or(F.col("kind") == "arc-header").alias("head"))
    bad = F.col("arc") & ~F.col("head")
    return out.select("capture", F.when(~bad, F.unhex(F.array_join(F.transform("p", lambda x: x["hex"]), ""))).alias("content"), F.when(bad, "no archive header").alias("error"))
