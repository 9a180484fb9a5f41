"""Classification, corrections and validation of captures."""

from __future__ import annotations

import codecs

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from arkspark.functions.scalars import bind

REDIRECTS = (301, 302, 303, 307, 308)


def classify(rows: DataFrame, not_found: tuple[str, ...], expected: tuple[int, ...] = (), transient: tuple[str, ...] = (), overrides: DataFrame | None = None) -> DataFrame:
    """Adds ``type`` to rows of (url, status, sha, mime, content, download); earlier rules win."""
    if overrides is not None:
        rows = rows.join(overrides.select(F.col("sha").alias("o_sha"), F.col("type").alias("o_type")), F.col("sha") == F.col("o_sha"), "left")
        given = F.col("o_type")
    else:
        given = F.lit(None).cast("string")
    status, text = F.col("status"), F.lower("content")
    html = F.coalesce(F.lower("mime").contains("html"), F.lit(False))
    phrase: Column = F.lit(False)
    for p in not_found:
        phrase = phrase | F.coalesce(text.contains(p), F.lit(False))
    rule = (
        F.when(given.isNotNull(), given)
        .when(F.col("download") == "corrupt", "corrupt")
        .when((status == 200) & (F.length("content") == 0), "corrupt")
        .when(F.col("download") == "unavailable", "unavailable")
        .when(status.isin(*expected) if expected else F.lit(False), "ok")
        .when(status == 400, "bad_request")
        .when(status == 404, "not_found")
        .when(status.cast("string").startswith("5"), "origin_error")
        .when(status.isin(*REDIRECTS), "redirect")
        .when(F.col("sha").isin(*transient) if transient else F.lit(False), "transient_retry")
        .when(html & phrase, "not_found")
        .when(status == 403, "forbidden")
        .otherwise("ok")
    )
    return rows.withColumn("type", rule).drop("o_sha", "o_type")


def correct(rows: DataFrame) -> DataFrame:
    """Corrected url and ``corrections`` (field, original, corrected, reason): slash of implicit redirects, and a
    backslash after the scheme. rows: url, request_url, status."""
    slash = (F.col("status") == 200) & F.col("request_url").endswith("/") & ~F.col("url").endswith("/") & (F.concat("url", F.lit("/")) == F.col("request_url"))
    back = F.col("url").startswith("http://\\")
    fixed = F.when(slash, F.concat("url", F.lit("/"))).when(back, F.regexp_replace("url", r"^http://\\+", "http://")).otherwise(F.col("url"))
    note = F.when(slash, "implicit_redirect").when(back, "backslash")
    entry = F.struct(F.lit("url").alias("field"), F.col("url").alias("original"), fixed.alias("corrected"), note.alias("reason"))
    return rows.withColumn("corrections", F.filter(F.array(F.when(note.isNotNull(), entry)), lambda x: x.isNotNull())).withColumn("url", fixed)


def local_to_utc(ts14: Column, zone: str = "America/Los_Angeles") -> Column:
    """A stamp in local time as a stamp in UTC."""
    return F.date_format(F.to_utc_timestamp(F.try_to_timestamp(ts14, F.lit("yyyyMMddHHmmss")), zone), "yyyyMMddHHmmss")


def validate(rows: DataFrame) -> DataFrame:
    """Adds ``errors``, rule names in order, from seconds: capture_s, server_s, modified_s, memento_s, precise_s; and
    record_sha, sha, record_status, status, is_revisit."""
    gap = lambda a, b: F.abs(F.col(a) - F.col(b))
    fresh = ~F.coalesce("is_revisit", F.lit(False))
    rules = {
        "server-time-mismatch": gap("server_s", "capture_s") > 30 * 86400,
        "capture-time-precise-mismatch": gap("precise_s", "capture_s") > 1,
        "modification-time-future": F.col("modified_s") - F.col("capture_s") > 3600,
        "memento-time-mismatch": F.col("memento_s") != F.col("capture_s"),
        "record-content-mismatch": fresh & (F.col("record_sha") != F.col("sha")),
        "record-status-mismatch": fresh & (F.col("record_status") != F.col("status")),
    }
    return rows.withColumn("errors", F.filter(F.array(*(F.when(F.coalesce(c, F.lit(False)), name) for name, c in rules.items())), lambda x: x.isNotNull()))


#: How pages name their charset, the standard ways and others, in order of trust.
CHARSET_NAMES = (
    r"(?i)<meta\s+charset=[\"']?([^\"'>\s]+)",
    r"(?i)<meta\s+http-equiv=[\"']?Content-Type[\"']?\s+content=[\"'][^\"']*charset=([^\"'>\s]+)",
    r"(?i)<meta\s+name=[\"']?charset[\"']?\s+content=[\"'][^\"']*charset=([^\"'>\s]+)",
    r"(?i)<meta\s+name=[\"']?charset[\"']?\s+content=[\"']?([^\"'>\s]+)",
)
#: Names that browsers read as windows-1252.
_LATIN = frozenset("ascii us-ascii latin1 latin-1 l1 iso-8859-1 iso8859-1 iso88591 iso_8859-1 cp1252 x-cp1252 windows-1252".split())


def page_charset(content: Column) -> Column:
    """The charset that a page names in its first 2 KiB; windows-1252 if none."""
    head = F.decode(F.substring(content, 1, 2048), "ISO-8859-1")
    found = lambda h: F.coalesce(*(F.nullif(F.regexp_extract(h, p, 1), F.lit("")) for p in CHARSET_NAMES), F.lit("windows-1252"))
    return bind(head, found)


def _decoded(content: bytes | None, charset: str) -> str | None:
    if content is None:
        return None
    name = "cp1252" if charset.lower() in _LATIN else charset
    try:
        codecs.lookup(name)
        text = bytes(content).decode(name, "replace")
    except (LookupError, ValueError):
        name = "cp1252"
    if name == "cp1252":  # its five free places are control characters to browsers
        text = bytes(content).decode("latin-1").translate(_CP1252)
    return text.removeprefix("\ufeff")


_CP1252 = {b: bytes([b]).decode("cp1252", "ignore") or chr(b) for b in range(0x80, 0xA0)}


@F.pandas_udf(StringType())
def _decode(contents: pd.Series, charsets: pd.Series) -> pd.Series:
    return pd.Series([_decoded(c, n) for c, n in zip(contents, charsets, strict=True)], dtype=object)


def decode_html(content: Column) -> Column:
    """The text of a page by its own charset; by windows-1252 if that is unknown."""
    return _decode(content, page_charset(content))


def own_redirect_page(path: Column) -> Column:
    """The page, in lower case, by which a server sent a visitor to the same path again."""
    return F.lower(F.concat(F.lit('<html><head><meta http-equiv="refresh" content="0.1; url='), path, F.lit('">\n<meta http-equiv="pragma" content="no cache">\n<meta http-equiv="expires" content="-1">\n</head></html>')))


def classify_captures(rows: DataFrame, not_found: tuple[str, ...], not_found_sha: tuple[str, ...] = (), transient_sha: tuple[str, ...] = (), overrides: DataFrame | None = None, expected: tuple[int, ...] = ()) -> DataFrame:
    """``rows`` (url, status, sha256, mime, content binary, download, download_details struct) with ``classification``: struct<type, details
    struct<reason, downloaded_size, actual_size>>. Earlier rules win.

    ``overrides`` (sha256, type). Phrases and own redirects are looked for in the decoded text of HTML pages, in lower case. Only rows
    that get as far as these rules are decoded.
    """
    from arkspark.functions import urls

    status, sha = F.col("status"), F.col("sha256")
    if overrides is not None:
        given = overrides.groupBy(F.col("sha256").alias("_sha")).agg(F.min("type").alias("_given"))
        rows = rows.join(given, sha == F.col("_sha"), "left").drop("_sha")
    else:
        rows = rows.withColumn("_given", F.lit(None).cast("string"))
    listed = lambda column, values: F.coalesce(column.isin(*values), F.lit(False)) if values else F.lit(False)
    empty = (status == 200) & (F.coalesce(F.length("content"), F.lit(0)) == 0)
    early = (
        F.when(F.col("_given").isNotNull(), F.col("_given"))
        .when((F.col("download") == "corrupt") | empty, "corrupt")
        .when(F.col("download") == "unavailable", "unavailable")
        .when(listed(status, expected), "ok")
        .when(status == 400, "bad_request")
        .when(status == 404, "not_found")
        .when(status.cast("string").startswith("5"), "origin_error")
        .when(status.isin(*REDIRECTS), "redirect")
        .when(listed(sha, transient_sha), "transient_retry")
    )
    html = F.coalesce(F.lower("mime").contains("html"), F.lit(False))
    rows = rows.withColumn("_early", early)
    rows = rows.withColumn("_text", F.lower(decode_html(F.when(F.col("_early").isNull() & html, F.col("content")))))
    phrase = F.exists(F.array(*(F.lit(p) for p in not_found)), lambda p: F.col("_text").contains(p)) if not_found else F.lit(False)
    missing = html & (F.coalesce(phrase, F.lit(False)) | listed(sha, not_found_sha))
    again = html & F.coalesce(F.replace(F.trim(F.regexp_replace("_text", r"^\s+|\s+$", "")), F.lit("\r"), F.lit("")) == own_redirect_page(urls.path(F.col("url"))), F.lit(False))
    kind = F.coalesce("_early", F.when(missing, "not_found").when(again, "transient_retry").when(status == 403, "forbidden").otherwise("ok"))
    corrupt = F.col("_given").isNull() & (F.col("download") == "corrupt")
    reason = lambda text: F.struct(F.lit(text).alias("reason"), F.lit(None).cast("long").alias("downloaded_size"), F.lit(None).cast("long").alias("actual_size"))
    details = F.when(corrupt, F.col("download_details")).when(F.col("_given").isNull() & empty, reason("empty_content")).when(F.col("_early").isNull() & missing, reason("not_found_string_detected"))
    return rows.withColumn("classification", F.struct(kind.alias("type"), details.alias("details"))).drop("_given", "_early", "_text")


def apply_corrections(rows: DataFrame, quirks: DataFrame) -> DataFrame:
    """``rows`` (ts14, memento14, url, request_url, status, collection) put right, with ``corrections``: array<struct<field, original, corrected, reason>>.

    In collections of ``quirks`` (collection, local_time, implicit_redirects) with local times, stamps become UTC; in those with
    implicit redirects, a capture whose path is the requested one but for the slash at its end gets it. A backslash after "http://" goes.
    """
    few = quirks.select(F.col("collection").alias("_c"), "local_time", "implicit_redirects")
    out = rows.join(few, F.col("collection") == F.col("_c"), "left")
    local, implicit = F.coalesce("local_time", F.lit(False)), F.coalesce("implicit_redirects", F.lit(False))
    path = lambda u: F.lower(F.regexp_extract(u, r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)", 1))
    own, asked = path(F.col("url")), path(F.col("request_url"))
    slash = F.coalesce(implicit & (F.col("status") == 200) & (own != "") & ~own.endswith("/") & (F.concat(own, F.lit("/")) == asked), F.lit(False))
    with_slash = F.regexp_replace("url", r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*[^?#]*)", "$1/")
    first = F.when(slash, with_slash).otherwise(F.col("url"))
    back = F.coalesce(first.startswith("http://\\"), F.lit(False))
    second = F.when(back, F.concat(F.lit("http://"), F.substring(first, F.lit(9), F.length(first)))).otherwise(first)
    entry = lambda happens, field, a, b, why: F.when(happens, F.struct(F.lit(field).alias("field"), a.alias("original"), b.alias("corrected"), why.alias("reason")))
    because = lambda text: F.concat(F.col("collection"), F.lit(f": {text}"))
    entries = F.array_compact(F.array(
        entry(local & local_to_utc(F.col("ts14")).isNotNull(), "captureTime", F.col("ts14"), local_to_utc(F.col("ts14")), because("Capture time stored as local time")),
        entry(local & local_to_utc(F.col("memento14")).isNotNull(), "mementoTime", F.col("memento14"), local_to_utc(F.col("memento14")), because("Memento time stored as local time")),
        entry(slash, "url", F.col("url"), with_slash, because("Redirects followed without updating URL")),
        entry(back, "url", first, second, F.lit("Malformed URL with backslash after protocol")),
    ))
    stamp = lambda c: F.when(local, F.coalesce(local_to_utc(F.col(c)), F.col(c))).otherwise(F.col(c))
    return out.withColumn("corrections", entries).withColumns({"ts14": stamp("ts14"), "memento14": stamp("memento14"), "url": second}).drop("_c", "local_time", "implicit_redirects")


def validate_captures(rows: DataFrame) -> DataFrame:
    """``rows`` with ``errors``: array<struct<type, values array<struct<field, value>>>>, in the order of the rules.

    rows: capture_time, server_time, precise_capture_time, modified_time, precise_modified_time, memento_time (timestamps), modified_candidates
    (array of timestamps), sha256, status, is_revisit, index_ts14, index_url, and record, a struct of sha256, status, ts14, url of the
    archived record or null. Nulls satisfy a rule; a month is 30 days; contents and statuses of revisits aren't compared.
    """
    text = lambda c: (c if isinstance(c, Column) else F.col(c)).cast("string")
    seconds = lambda c: F.unix_micros(c if isinstance(c, Column) else F.col(c)) / 1e6
    gap = lambda a, b: F.abs(seconds(a) - seconds(b))

    def error(kind: str, wrong: Column, *values: tuple) -> Column:
        return F.when(F.coalesce(wrong, F.lit(False)), F.struct(F.lit(kind).alias("type"), F.array(*(F.struct(F.lit(f).alias("field"), text(v).alias("value")) for f, v in values)).alias("values")))

    fresh, record = F.col("record").isNotNull() & ~F.coalesce("is_revisit", F.lit(False)), F.col("record")
    capture = ("captureTime", "capture_time")
    single = [
        error("server-time-mismatch", gap("server_time", "capture_time") > 30 * 86400, ("serverTime", "server_time"), capture),
        error("capture-time-precise-mismatch", gap("precise_capture_time", "capture_time") > 1, ("captureTimePrecise", "precise_capture_time"), capture),
        error("modification-time-future", seconds("modified_time") - seconds("capture_time") > 3600, ("modificationTime", "modified_time"), capture),
        error("modification-time-precise-mismatch", gap("precise_modified_time", "modified_time") > 1, ("modificationTimePrecise", "precise_modified_time"), ("modificationTime", "modified_time")),
    ]
    candidates = F.transform(F.coalesce("modified_candidates", F.array().cast("array<timestamp>")), lambda c: error("modification-time-precise-candidate-mismatch", gap(c, "modified_time") > 1, ("modificationTimePreciseCandidate", c), ("modificationTime", "modified_time")))
    rest = [
        error("memento-time-mismatch", F.col("memento_time") != F.col("capture_time"), ("mementoTime", "memento_time"), capture),
        error("record-content-mismatch", fresh & (record["sha256"] != F.col("sha256")), ("recordSha256", record["sha256"]), ("entrySha256", "sha256")),
        error("record-status-mismatch", fresh & ~record["status"].eqNullSafe(F.col("status")), ("recordStatus", record["status"]), ("entryStatus", "status")),
        error("record-timestamp-mismatch", record.isNotNull() & ~record["ts14"].eqNullSafe(F.col("index_ts14")), ("recordTimestamp", record["ts14"]), ("entryTimestamp", "index_ts14")),
        error("record-url-mismatch", record.isNotNull() & ~record["url"].eqNullSafe(F.col("index_url")), ("recordUrl", record["url"]), ("entryUrl", "index_url")),
    ]
    return rows.withColumn("errors", F.array_compact(F.concat(F.array(*single), candidates, F.array(*rest))))
