"""Capture-index files as rows: text, JSON and line-wise JSON indexes, and lists of URLs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arkspark.functions.scalars import content_length

#: Field letters of the text format.
CDX_FIELDS = {"N": "urlkey", "b": "ts14", "a": "url", "m": "mime", "s": "status", "k": "digest", "V": "offset", "S": "length", "g": "filename"}
_NUMBERS = ("status", "offset", "length")
_COLUMNS = tuple(CDX_FIELDS.values())
#: Parts in which a file's lines are joined with its header.
_PARTS = 256
#: The fields that are asked of the index, in order.
WAYBACK_FIELDS = ("ts14", "url", "status", "digest", "mime", "length", "urlkey", "filename", "offset")
_CRAWL = "urlkey string, timestamp string, url string, mime string, status string, digest string, length string, offset string, filename string, _bad string"


def lines_of(spark: SparkSession, path: str, whole: bool = False) -> DataFrame:
    """(path, value): the lines of text files, or each file whole."""
    return spark.read.text(path, wholetext=whole).select(F.input_file_name().alias("path"), "value")


def _number(name: str, value: Column) -> Column:
    return content_length(value).alias(name) if name in _NUMBERS else value.alias(name)


def headerless_files(lines: DataFrame) -> DataFrame:
    """(path, error) of the files in which no line names the fields."""
    head = F.col("value").startswith(" CDX ")
    return lines.groupBy("path").agg(F.bool_or(head).alias("_head")).where(~F.coalesce("_head", F.lit(False))).select("path", F.lit("no index header").alias("error"))


def parse_cdx(lines: DataFrame, strict: bool = True) -> DataFrame:
    """Rows of space-separated index lines (path, value); each file's header line names its fields by letter.

    ``-`` and missing fields are null. Lines without urlkey, stamp, URL or MIME type go; a file without a header line
    ends the job with an error if ``strict``, else its lines go and ``headerless_files`` tells of it. Headers are one short row per file and join by path
    and part of the file's lines, so that a long file goes to many tasks.
    """
    rows = lines.select("path", F.regexp_replace("value", r"\s+$", "").alias("line")).where("line <> ''")
    head = F.col("line").startswith(" CDX ")
    heads = rows.where(head).groupBy("path").agg(F.min("line").alias("head")).select("path", F.split(F.expr("substring(head, 6)"), " ").alias("codes"))
    part = F.pmod(F.xxhash64("line"), F.lit(_PARTS)).cast("int")
    heads = heads.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(_PARTS - 1))))
    body = rows.where(~head).withColumn("_part", part).join(heads, ["path", "_part"], "left" if strict else "inner")
    codes = F.when(F.col("codes").isNull(), F.raise_error(F.concat(F.lit("no index header in "), "path")).cast("array<string>")).otherwise(F.col("codes"))
    body = body.select("path", F.split("line", " ").alias("parts"), codes.alias("codes"))
    value = lambda code: F.nullif(F.get("parts", F.array_position("codes", code).cast("int") - 1), F.lit("-"))
    out = body.select("path", *(_number(name, value(code)) for code, name in CDX_FIELDS.items()))
    return out.where("urlkey <> '' and ts14 <> '' and url <> '' and mime <> ''")


def parse_cdx_json(files: DataFrame, fields: tuple[str, ...], first_page: bool = True, resume: bool = False) -> DataFrame:
    """Rows of JSON indexes (path, value), each an array of arrays in the order of ``fields``.

    Of a first page, the first row is a header. With ``resume``, a last row of one value is the key to go on from; it
    and the empty row before it go. ``place`` is the row's place in its file.
    """
    rows = files.select("path", F.from_json("value", "array<array<string>>").alias("rows"))
    if resume:
        rows = rows.select("path", F.when(F.size(F.element_at("rows", -1)) == 1, F.slice("rows", F.lit(1), F.greatest(F.size("rows") - 2, F.lit(0)))).otherwise(F.col("rows")).alias("rows"))
    rows = rows.select("path", F.posexplode("rows").alias("place", "row"))
    if first_page:
        rows = rows.where("place > 0")
    return rows.select("path", "place", *(_number(name, F.get("row", F.lit(i))) for i, name in enumerate(fields)))


def parse_crawl_index(lines: DataFrame, collection: Column, request_url: Column) -> DataFrame:
    """Rows of line-wise JSON (value, and what the two columns need); lines that don't parse go."""
    parsed = F.from_json(F.trim("value"), _CRAWL, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    rows = lines.where(F.trim("value") != "").select(parsed.alias("r"), collection.alias("collection"), request_url.alias("request_url")).where("r._bad is null")
    names = {"ts14": "timestamp"}
    return rows.select(*(_number(c, F.col(f"r.{names.get(c, c)}")) for c in _COLUMNS), F.lit("commoncrawl").alias("source"), "request_url", "collection")


def url_list(lines: DataFrame, normalise: bool = False) -> DataFrame:
    """Distinct URLs of (value), cut at a broken bar; ``normalise`` also cuts numbered www and the scheme's own port."""
    url = F.trim(F.substring_index("value", "¦", 1))
    if normalise:
        url = F.regexp_replace(url, r"(?i)^(https?://)www\d*\.", "$1")
        url = F.regexp_replace(url, r"(?i)^(http://[^/]+):80(/|$)", "$1$2")
        url = F.regexp_replace(url, r"(?i)^(https://[^/]+):443(/|$)", "$1$2")
    return lines.select(url.alias("url")).where("url <> ''").distinct()
