"""Archive files: readings of their names, the report on them, and their statistics."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arkspark.functions.archive_names import FAMILIES, FIELDS, archive_name, best_reading, may_be_of
from arkspark.sources.files import written

_READING = "struct<confidence:double,layout:string,record_format:string,details:struct<" + ",".join(f"{name}:{kind}" for name, kind in FIELDS) + ">>"


@lru_cache(maxsize=16)
def _reading(families: tuple[str, ...], application: str) -> Column:
    """The expression over _name and _stamp: of some thousand parts, so that it is built once for a Spark application."""
    return archive_name(F.col("_name"), F.col("_stamp"), families)


def with_archive_names(df: DataFrame, name: str = "filename", stamp: str | None = None, families: tuple[str, ...] = tuple(FAMILIES)) -> DataFrame:
    """``df`` with archive_file, the best reading of each name, null where none fits; and archive_file_error.

    Each distinct name (with its stamp, if given) is read once, by the families of which a layout may fit it; a family that no name of the table
    may be of isn't planned. Null names stay, unread.
    """
    keys = [F.col(name).alias("_name"), (F.col(stamp) if stamp else F.lit(None)).cast("string").alias("_stamp")]
    known = written(df.select(*keys).where("_name is not null").distinct().withColumn("_of", may_be_of(F.col("_name"), families)), "names")
    seen = known.agg(*(F.coalesce(F.max(F.col("_of").bitwiseAND(1 << i)), F.lit(0)) for i in range(len(families)))).first()
    # Few bytes, but long to read: spread out, as Spark would put small partitions together.
    spread = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), df.sparkSession.sparkContext.defaultParallelism)
    application = df.sparkSession.sparkContext.applicationId
    known_end = F.lower(F.col(name)).rlike(r"\.w?arc(\.zst)?(\.gz)?$")
    error = F.when(F.col(name).isNotNull() & ~known_end, F.lit("unknown record format"))
    planned = [(i, family) for i, family in enumerate(families) if seen[i]]
    if not planned:
        return df.withColumns({"archive_file": F.lit(None).cast(_READING), "archive_file_error": error})
    readings = F.array(*(F.when(F.col("_of").bitwiseAND(1 << i) > 0, _reading((family,), application)) for i, family in planned))
    # Of equal scores the first in the order of the families. All in one expression: a filter on readings would be worked out before the rows are spread as well.
    best = known.repartition(spread).select("_name", "_stamp", best_reading(readings).alias("archive_file"))
    same = F.col(name).eqNullSafe(F.col("_name"))
    if stamp:
        same = same & F.col(stamp).cast("string").eqNullSafe(F.col("_stamp"))
    return df.join(best, same, "left").drop("_name", "_stamp").withColumn("archive_file_error", error)


def name_report(rows: DataFrame) -> DataFrame:
    """(capture_ts, url, archive_filename, crawl_id, type, provider, confidence) of rows (capture_ts, url, archive_filename)."""
    read = with_archive_names(rows.select("capture_ts", "url", "archive_filename"), "archive_filename", "capture_ts")
    a = F.col("archive_file")
    return read.select("capture_ts", "url", "archive_filename", a["details"]["crawl_identifier"].alias("crawl_id"), a["layout"].alias("type"), a["details"]["crawl_provider"].alias("provider"), F.round(a["confidence"], 3).alias("confidence"))


def file_statistics(details: DataFrame) -> DataFrame:
    """(item, file, size, md5, modified) of a catalogue of items (item, files array<struct<name,size,md5,mtime>>), archives only.

    mtime counts epoch seconds; a size or time that is no number is null.
    """
    files = details.select("item", F.explode("files").alias("f")).where(F.lower(F.col("f.name")).rlike(r"\.(warc\.gz|arc\.gz|warc\.zst)$"))
    return files.select("item", F.col("f.name").alias("file"), F.col("f.size").try_cast("long").alias("size"), F.col("f.md5").alias("md5"), F.timestamp_seconds(F.col("f.mtime").try_cast("long")).alias("modified"))


def object_statistics(objects: DataFrame) -> DataFrame:
    """The same of objects in a store (file, length, etag, modified): an ETag of 32 hexadecimal digits is an MD5, any other isn't."""
    return objects.select(F.lit(None).cast("string").alias("item"), "file", F.col("length").try_cast("long").alias("size"), F.when(F.col("etag").rlike('^"?[0-9a-f]{32}"?$'), F.replace("etag", F.lit('"'), F.lit(""))).alias("md5"), "modified")


def with_file_statistics(captures: DataFrame, statistics: DataFrame) -> DataFrame:
    """``captures`` with archive_size, archive_md5 and archive_modified of filename, which is ``item/file``; nulls where unknown."""
    item, file = F.substring_index("filename", "/", 1), F.expr("substring(filename, instr(filename, '/') + 1)")
    right = statistics.select(F.col("item").alias("_item"), F.col("file").alias("_file"), F.col("size").alias("archive_size"), F.col("md5").alias("archive_md5"), F.col("modified").alias("archive_modified"))
    return captures.join(right, (item == F.col("_item")) & (file == F.col("_file")), "left").drop("_item", "_file")


def with_object_statistics(captures: DataFrame, statistics: DataFrame) -> DataFrame:
    """The same of statistics of a store's objects, whose whole names captures have as filename."""
    right = statistics.select(F.col("file").alias("_file"), F.col("size").alias("archive_size"), F.col("md5").alias("archive_md5"), F.col("modified").alias("archive_modified"))
    return captures.join(right, F.col("filename") == F.col("_file"), "left").drop("_file")


def archive_counts(details: DataFrame) -> DataFrame:
    """(item, warc_files, arc_files) of a catalogue of items (item, files, warc_files, arc_files): given counts stay, missing ones are counted."""
    count = lambda end: F.size(F.filter(F.coalesce("files", F.array()), lambda f: F.lower(f["name"]).endswith(end))).cast("long")
    warc = count(".warc.gz") + count(".warc.zst")
    return details.select("item", F.coalesce(F.col("warc_files").cast("long"), warc).alias("warc_files"), F.coalesce(F.col("arc_files").cast("long"), count(".arc.gz")).alias("arc_files"))
