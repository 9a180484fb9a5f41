"""Catalogues: collections and their sizes, items and their files, a library's index, enrichment periods, and lists of wanted URLs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arkspark.functions.scalars import content_length, lenient_int

#: Fields of a line of the library's index.
LIBRARY_FIELDS = ("urlkey", "timestamp", "url", "mime", "status", "digest", "redirect", "robotflags", "length", "offset", "filename", "load_url", "source", "source-coll")


def parse_library_index(lines: DataFrame) -> DataFrame:
    """Rows of line-wise JSON (value) with all fields as text; ``-`` is null, and lines that don't parse go."""
    schema = ", ".join(f"`{f}` string" for f in (*LIBRARY_FIELDS, "_bad"))
    rows = lines.where(F.trim("value") != "").select(F.from_json(F.trim("value"), schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}).alias("r")).where("r._bad is null")
    return rows.select("r.urlkey", F.col("r.timestamp").alias("ts14"), "r.url", "r.mime", *(lenient_int(F.col(f"r.{c}")).alias(c) for c in ("status", "length", "offset")), "r.digest", "r.filename")


def read_collections(spark: SparkSession, path: str) -> DataFrame:
    """(id, name, from, to) of a JSON array of collections."""
    return spark.read.schema("id string, name string, `from` string, `to` string").json(path, multiLine=True)


def read_collection_sizes(spark: SparkSession, path: str) -> DataFrame:
    """(id, pages, urls, digests) of a CSV with the columns crawl, page, url and "digest estim."; what is no number is null, of rows of one crawl the
    last counts."""
    rows = spark.read.csv(path, header=True, inferSchema=False)
    number = lambda c: content_length(F.col(f"`{c}`"))
    rows = rows.select(F.col("crawl").alias("id"), number("page").alias("pages"), number("url").alias("urls"), number("digest estim.").alias("digests"), F.monotonically_increasing_id().alias("_at"))
    return rows.groupBy("id").agg(F.max_by(F.struct("pages", "urls", "digests"), "_at").alias("r")).select("id", "r.*")


def parse_items(documents: DataFrame) -> DataFrame:
    """(item, title, description, parents, files, warc_files, arc_files) of item documents (value): metadata and a list of files.

    Only archives among the files stay, with name, private, mtime, size and md5. ``parents``, one name or a list of them, is an array.
    """
    schema = "metadata struct<identifier string, title string, description string, collection string, numwarcs string, numarcs string>, files array<struct<name string, private string, mtime string, size string, md5 string>>"
    rows = documents.select(F.from_json("value", schema).alias("d")).where("d.metadata.identifier is not null")
    given = F.col("d.metadata.collection")
    parents = F.when(given.startswith("["), F.from_json(given, "array<string>")).when(given.isNotNull(), F.array(given))
    files = F.filter("d.files", lambda f: f["name"].rlike(r"\.(warc\.gz|arc\.gz|warc\.zst)$"))
    number = lambda c: content_length(F.col(f"d.metadata.{c}"))
    return rows.select(F.col("d.metadata.identifier").alias("item"), "d.metadata.title", "d.metadata.description", parents.alias("parents"), files.alias("files"), number("numwarcs").alias("warc_files"), number("numarcs").alias("arc_files"))


def _plain_json(text: Column) -> Column:
    """Without commas before closing brackets."""
    return F.regexp_replace(text, r",\s*([\]}])", "$1")


_CRAWLER = "struct<crawlerName string, crawlerHostname string, crawlerHostnameSecondary string, crawlerIpAddress string>"
#: Schemas of a period by the kind of file.
PERIODS = {
    "crawlers": f"struct<`from` string, `to` string, crawlerIpRange string, knownCrawlers array<{_CRAWLER}>>",
    "headers": "struct<`from` string, `to` string, protocol string, headers array<array<string>>>",
    "overrides": "struct<`from` string, `to` string, crawlerHostname string, crawlerIpAddress string, protocol string, headers array<array<string>>>",
}


def parse_periods(files: DataFrame, kind: str, keyed: bool) -> DataFrame:
    """(key, from, to, ..., ord) of enrichment files (key, value), in the files' order; JSON with comments and trailing commas.

    A file is a list of periods, of the key it comes with (a provider); a ``keyed`` one is an object of such lists by name, which
    become the keys, in lower case.
    """
    period, options = PERIODS[kind], {"allowComments": "true", "allowSingleQuotes": "true", "allowUnquotedFieldNames": "true"}
    text = _plain_json(F.col("value"))
    if keyed:
        lists = files.select(F.posexplode(F.map_entries(F.from_json(text, f"map<string, array<{period}>>", options))).alias("k", "e")).select(F.lower("e.key").alias("key"), "k", F.col("e.value").alias("list"))
    else:
        lists = files.select("key", F.lit(0).alias("k"), F.from_json(text, f"array<{period}>", options).alias("list"))
    return lists.select("key", "k", F.posexplode("list").alias("at", "p")).select("key", "p.*", (F.col("k").cast("long") * 1_000_000 + F.col("at")).alias("ord"))


def requests_of(files: DataFrame, variables: DataFrame | None = None, min_ts: str | None = None, max_ts: str | None = None) -> DataFrame:
    """(input_id, at, url, min_ts, max_ts, slash_mode, error) of wanted files (input_id, min_ts, max_ts, slash_mode, urls array<struct<url, min_ts, max_ts, slash_mode>>).

    Bounds of a URL win over the file's, those over the common ones. ``{var:name}`` in URLs becomes the value of (name, value); a name that
    isn't there is an error of that row.
    """
    u = F.col("u")
    rows = files.select("input_id", *(F.col(c).alias("_" + c) for c in ("min_ts", "max_ts", "slash_mode")), F.posexplode("urls").alias("at", "u"))
    rows = rows.select("input_id", "at", u["url"].alias("url"), F.coalesce(u["min_ts"], "_min_ts", F.lit(min_ts).cast("string")).alias("min_ts"), F.coalesce(u["max_ts"], "_max_ts", F.lit(max_ts).cast("string")).alias("max_ts"), F.coalesce(u["slash_mode"], "_slash_mode").alias("slash_mode"))
    if variables is None:
        return rows.withColumn("error", F.when(F.col("url").contains("{var:"), F.lit("unknown variable")))
    table = variables.agg(F.map_from_entries(F.collect_list(F.struct("name", "value"))).alias("_vars"))
    names = F.regexp_extract_all("url", F.lit(r"\{var:([^}]+)\}"), F.lit(1))
    filled = F.aggregate(names, F.col("url"), lambda t, n: F.replace(t, F.concat(F.lit("{var:"), n, F.lit("}")), F.coalesce(F.try_element_at(F.col("_vars"), n), F.concat(F.lit("{var:"), n, F.lit("}")))))
    # One row of a configuration's few variables.
    out = rows.crossJoin(F.broadcast(table)).withColumn("url", filled)
    return out.withColumn("error", F.when(F.col("url").contains("{var:"), F.lit("unknown variable"))).drop("_vars")


def shared_urls(requests: DataFrame) -> DataFrame:
    """(bare_url, inputs): URLs, without scheme and numbered "www", that several inputs ask for."""
    bare = F.regexp_replace(F.regexp_replace("url", r"^https?://", ""), r"^www\d*\.", "")
    return requests.select(bare.alias("bare_url"), "input_id").distinct().groupBy("bare_url").agg(F.array_sort(F.collect_set("input_id")).alias("inputs")).where(F.size("inputs") > 1)
