"""Responses of archives: contents by digest, headers, MIME defaults and lengths."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arkspark.functions.headers import iis_version
from arkspark.functions.scalars import content_length, header_value, uncompressed_length

#: Of a server version the tables, by their names, that hold its default MIME types; the first one's "*" is for extensions that none has.
#: Versions that aren't listed have a table of their own name.
TABLES_OF = {version: ("6.0", "6.0rtm", "6.0rc1", "6.0sp2") for version in ("6.0", "7.0", "7.5", "8.0", "8.5")}


def mime_tables(spark: SparkSession, folder: str) -> DataFrame:
    """(version, ext, mime) of the CSV files (ext, mime) in the folders ``version=...`` of a folder."""
    return spark.read.schema("ext string, mime string, version string").csv(folder, header=True)


def defaults_by_version(tables: DataFrame, tables_of: dict[str, tuple[str, ...]] = TABLES_OF) -> DataFrame:
    """(version, ext, mimes, star) of every version that has a table, itself or by those of which it takes its types; ``mimes`` is null for none, ``star`` the types of
    unknown extensions, in one row per version with a null ext."""
    spark = tables.sparkSession
    inherited = spark.createDataFrame([(v, t, i) for v, names in tables_of.items() for i, t in enumerate(names)], "version string, table string, place int")
    named = tables.where("version is not null and ext is not null and mime is not null").select(F.col("version").alias("table"), F.lower("ext").alias("ext"), "mime")
    own = named.select("table").distinct().where(~F.col("table").isin(*tables_of)).select(F.col("table").alias("version"), "table", F.lit(0).alias("place"))
    rows = named.join(F.broadcast(inherited.unionByName(own)), "table")
    known = rows.where("ext <> '*'").groupBy("version", "ext").agg(F.collect_set("mime").alias("mimes"))
    first = rows.where("ext = '*'").groupBy("version", "place").agg(F.collect_set("mime").alias("mimes")).groupBy("version").agg(F.min_by("mimes", "place").alias("mimes"))
    every = rows.select("version").distinct().join(first, "version", "left").select("version", F.lit(None).cast("string").alias("ext"), F.coalesce("mimes", F.array().cast("array<string>")).alias("mimes"))
    return known.unionByName(every)


def with_default_mime(rows: DataFrame, defaults: DataFrame, tables_of: dict[str, tuple[str, ...]] = TABLES_OF) -> DataFrame:
    """``rows`` (filename, mime, server, ...) with default_mime: whether that server gives that MIME type to the file's extension.

    ``defaults`` (version, ext, mime), as ``mime_tables`` reads them, has a row "*" for extensions that a version doesn't know; a version may take its types of
    several tables. "text/html" always counts, as error pages have it; servers of other kinds and versions without rows have no defaults. The tables are configuration, so that
    rows look them up where they are.
    """
    told = defaults_by_version(defaults, tables_of)
    own = rows.withColumn("_version", iis_version(F.col("server"))).withColumn("_ext", F.lower(F.substring_index("filename", ".", -1)))
    known = told.where("ext is not null").select(F.col("version").alias("_version"), F.col("ext").alias("_ext"), F.col("mimes").alias("_mimes"))
    star = told.where("ext is null").select(F.col("version").alias("_version"), F.col("mimes").alias("_star"))
    out = own.join(F.broadcast(known), ["_version", "_ext"], "left").join(F.broadcast(star), "_version", "left")
    fits = F.array_contains(F.coalesce("_mimes", "_star"), F.col("mime"))
    return out.withColumn("default_mime", F.coalesce(F.col("_star").isNotNull() & ((F.col("mime") == "text/html") | fits), F.lit(False))).drop("_version", "_ext", "_mimes", "_star")


def with_contents(captures: DataFrame, downloads: DataFrame) -> DataFrame:
    """``captures`` (digest, url, ts14, status, mime, headers, type, ...) with what was downloaded for their digest.

    ``downloads``, one row per digest: digest, url, ts14, status, status_message, mime, headers, sha256, type, size, unavailable. A capture
    with its url, stamp and status is ``downloaded`` and takes headers, status and message from it; any other is a ``digest-match`` and keeps
    its own. Unavailable downloads have no content; the digest's type holds where there is content or the match is exact, else the
    capture is unavailable.
    """
    d = downloads.select("digest", *(F.col(c).alias("_" + c) for c in ("url", "ts14", "status", "status_message", "mime", "headers", "sha256", "type", "size", "unavailable")))
    out = captures.join(d, "digest", "left")
    there = F.coalesce(~F.col("_unavailable"), F.lit(False))
    exact = F.coalesce(there & (F.col("url") == F.col("_url")) & (F.col("ts14") == F.col("_ts14")) & F.col("status").eqNullSafe(F.col("_status")), F.lit(False))
    size = F.when(there, F.col("_size")).otherwise(0).cast("long")
    return out.withColumns({
        "headers": F.when(exact, F.col("_headers")).otherwise(F.col("headers")),
        "status_message": F.when(exact, F.col("_status_message")),
        "mime": F.coalesce(F.when(exact, F.col("_mime")), F.col("mime")),
        "sha256": F.col("_sha256"),
        "size": size,
        "type": F.when((exact | (size > 0)) & F.col("_type").isNotNull(), F.col("_type")).otherwise("unavailable"),
        "download": F.when(exact, "downloaded").otherwise("digest-match"),
    }).drop("_url", "_ts14", "_status", "_status_message", "_mime", "_headers", "_sha256", "_type", "_size", "_unavailable")


def digest_representatives(captures: DataFrame, download_all: bool = False) -> DataFrame:
    """The captures to download: of each digest the first available one by ord, else the first unavailable; each without a digest, and
    every one if all are to be downloaded."""
    if download_all:
        return captures
    first = captures.where("digest is not null").groupBy("digest").agg(F.min(F.struct(F.coalesce("unavailable", F.lit(False)).alias("late"), "ord")).alias("f")).select(F.col("f.ord").alias("ord"))
    return captures.where("digest is null").unionByName(captures.where("digest is not null").join(first, "ord", "left_semi"))


def header_source(captures: DataFrame) -> DataFrame:
    """``captures`` (record struct<headers, ip, protocol>, cleaned_headers, ...) with headers, ip, protocol and headers_derived: those of the
    archived record where there is one, else the headers read out of playback."""
    has = F.col("record").isNotNull()
    return captures.withColumns({"headers": F.when(has, F.col("record.headers")).otherwise(F.col("cleaned_headers")), "ip": F.col("record.ip"), "protocol": F.col("record.protocol"), "headers_derived": ~has & F.col("cleaned_headers").isNotNull()})


def length_audit(captures: DataFrame) -> DataFrame:
    """(ord, expected, size, reason) of captures (ord, size, headers, raw_headers, type, download) whose content isn't as long as
    their headers say.

    A length of -1, and corrupt contents, aren't held against it. Where the content was packed, the length before packing counts: a
    mismatch with it is told, and a content that another capture's digest stands for can't be checked without it: ``unverifiable``.
    """
    told = F.coalesce(content_length(header_value(F.col("headers"), "content-length")), content_length(header_value(F.col("raw_headers"), "content-length")))
    packed, whole = F.coalesce(header_value(F.col("headers"), "content-encoding") == "gzip", F.lit(False)), uncompressed_length(F.col("headers"))
    off = told.isNotNull() & (told != -1) & (F.col("size") != told) & ~F.col("type").contains("corrupt")
    reason = F.when(~off, None).when(~packed, "length").when(whole.isNotNull() & (whole != F.col("size")), "unpacked length").when(whole.isNull() & (F.col("download") == "digest-match"), "unverifiable")
    return captures.select("ord", F.when(packed, whole).otherwise(told).alias("expected"), "size", reason.alias("reason")).where("reason is not null")
