"""Registered queries of duplicates by rule, playback headers, contents, classes, corrections and validation."""

from __future__ import annotations

from pyspark.sql import functions as F

from arkspark.functions.headers import archive_source, original_headers
from arkspark.operators import classify as cls
from arkspark.operators import duplicates, etags, records, responses
from arkspark.plans.queries import query
from arkspark.sources.captures import captures
from arkspark.sources.files import new_folder

_REQUEST = "concat(regexp_replace(url, '[?#].*$', ''), CASE WHEN page_id % 3 = 0 THEN '/' ELSE '' END)"
_PATH = "lower(CASE WHEN regexp_extract({0}, '^[^:]+://[^/?#]*([^?#]*)', 1) = '' THEN '/' ELSE regexp_extract({0}, '^[^:]+://[^/?#]*([^?#]*)', 1) END)"
_A, _B = _PATH.format("url"), _PATH.format("request_url")
_SLASH = {"strict": f"({_A} = {_B})", "strictWithValid": f"({_A} = {_B} OR (({_A} || '/' = {_B} OR {_B} || '/' = {_A}) AND CAST(status AS VARCHAR) LIKE '2%'))"}


def _states(mode: str) -> str:
    return f"""q AS (SELECT *, {_REQUEST} AS request_url FROM caps),
m AS (SELECT request_url, url, ts14, status, min(ord) AS ord, CASE WHEN count(DISTINCT digest) > 1 THEN NULL ELSE min(digest) END AS digest, count(*) AS n_rows, bool_or(ord % 2 = 0) AS served FROM q GROUP BY request_url, url, ts14, status),
g AS (SELECT *, count(*) OVER w AS n_groups, sum(n_rows) OVER w AS total FROM m WINDOW w AS (PARTITION BY request_url, ts14)),
z AS (SELECT request_url, url, ts14, status, ord, digest, n_rows, CASE WHEN NOT {_SLASH[mode]} THEN 'slash' WHEN total = 1 THEN 'single' WHEN ts14 BETWEEN '20240110000000' AND '20240113235959' THEN 'limited' WHEN n_groups = 1 THEN 'merged' WHEN served THEN 'resolved' ELSE 'unavailable' END AS state FROM g)"""


def _resolved(spark, d, mode):
    rows = captures(spark, d).withColumn("request_url", F.expr(_REQUEST))
    ranges = spark.createDataFrame([("20240110000000", "20240113235959")], "start_ts string, end_ts string")
    return duplicates.resolve_duplicates(rows, rows.where("ord % 2 = 0"), mode, ranges)


@query(f"WITH CAPS, {_states('strict')} SELECT request_url, url, ts14, status, ord, digest, n_rows, state FROM z")
def duplicates_by_rule(spark, d):
    return _resolved(spark, d, "strict").select("request_url", "url", "ts14", "status", "ord", "digest", "n_rows", "state")


@query(f"WITH CAPS, {_states('strictWithValid')} SELECT request_url, ts14, ord, state = 'unavailable' AS unavailable FROM z WHERE state NOT IN ('slash', 'limited')")
def duplicates_kept(spark, d):
    return duplicates.kept_duplicates(_resolved(spark, d, "strictWithValid")).select("request_url", "ts14", "ord", "unavailable")


@query(f"""WITH CAPS, {_states('strictWithValid')} SELECT request_url, CAST(nullif(sum(CASE WHEN state = 'slash' THEN n_rows ELSE 0 END), 0) AS BIGINT) AS slash_filtered, CAST(nullif(sum(CASE WHEN state = 'limited' THEN n_rows ELSE 0 END), 0) AS BIGINT) AS limited_filtered,
CAST(nullif(sum(CASE WHEN state IN ('resolved', 'unavailable') THEN n_rows - 1 ELSE 0 END), 0) AS BIGINT) AS duplicate_filtered FROM z GROUP BY request_url""")
def duplicate_filters(spark, d):
    return duplicates.resolution_counts(_resolved(spark, d, "strictWithValid"))


def _pairs(*pairs) -> F.Column:
    return F.filter(F.array(*(F.struct(F.lit(n).alias("name"), (F.lit(v) if isinstance(v, str) else v).cast("string").alias("value")) for n, v in pairs)), lambda h: h["value"].isNotNull())


def _shown(headers) -> F.Column:
    return F.array_join(F.transform(headers, lambda h: F.concat(h["name"], F.lit("="), h["value"], F.when(h["unconfirmed"], F.lit("?")).otherwise(""))), "|")


@query("""SELECT page_id, CASE WHEN page_id % 2 = 0 THEN concat('item/', page_id, '.warc.gz') END AS source,
concat('Server=Apache/1', CASE WHEN page_id % 3 = 0 THEN '|Content-Type=text/html' WHEN page_id % 3 = 1 THEN '|Content-Type=text/html?' ELSE '|Content-Type=a/b; c=d' END, CASE WHEN page_id % 4 < 2 THEN concat('|ETag="', page_id, '"') ELSE '' END,
'|Content-Encoding=gzip|Location=', CASE WHEN page_id % 5 = 0 THEN concat('http://b.org/', page_id) ELSE concat('/x', page_id) END, '|Content-Location=/orig') AS headers FROM pages""")
def playback_headers(spark, d):
    page = F.col("page_id")
    location = F.when(page % 5 == 0, F.concat(F.lit("https://web.archive.org/web/20200101000000id_/http://b.org/"), page.cast("string"))).otherwise(F.concat(F.lit("/web/2020/http://a.org:80/x"), page.cast("string")))
    raw = _pairs(
        ("x-archive-orig-server", "Apache/1"), ("x-archive-orig-x_commoncrawl_a", "1"), ("content-type", F.when(page % 3 == 2, "a/b; c=d").otherwise("text/html")), ("x-archive-orig-etag", F.when(page % 4 < 2, F.concat(F.lit('"'), page.cast("string"), F.lit('"')))),
        ("Content-Encoding", "gzip"), ("location", location), ("content-location", "/web/2020/y"), ("x-archive-orig-content-location", "/orig"), ("x-archive-src", F.when(page % 2 == 0, F.concat(F.lit("item/"), page.cast("string"), F.lit(".warc.gz")))), ("date", "x"),
    )
    rows = spark.read.parquet(f"{d}/pages.parquet").select("page_id", raw.alias("raw"))
    return rows.select("page_id", archive_source(F.col("raw")).alias("source"), _shown(original_headers(F.lit("http://a.org/p"), F.col("raw"), F.lit(2020), page % 3 == 0)).alias("headers"))


@query("""SELECT page_id, CASE page_id % 6 WHEN 0 THEN true WHEN 1 THEN true WHEN 2 THEN false WHEN 3 THEN true WHEN 4 THEN false ELSE false END AS default_mime FROM pages""")
def default_mime_types(spark, d):
    table = spark.createDataFrame([("5.0", "gif", "image/gif"), ("5.0", "gif", "image/x-gif"), ("5.0", "*", "application/octet-stream"), ("6.0", "*", "application/octet-stream"), ("6.0", "txt", "text/plain")], "version string, ext string, mime string")
    rows = spark.read.parquet(f"{d}/pages.parquet").select("page_id").withColumn("k", (F.col("page_id") % 6).cast("int"))
    given = [("a.GIF", "image/gif", "Microsoft-IIS/5.0"), ("b.zzz", "application/octet-stream", "Microsoft-IIS/7.5"), ("b.gif", "application/octet-stream", "Microsoft-IIS/5.0"), ("x.asp", "text/html", "Microsoft-IIS/8.0"), ("a.gif", "image/gif", "Apache"), ("a.gif", "image/gif", "Microsoft-IIS/1.0")]
    pick = lambda i: F.element_at(F.array(*(F.lit(g[i]) for g in given)), F.col("k") + 1)
    return responses.with_default_mime(rows.select("page_id", pick(0).alias("filename"), pick(1).alias("mime"), pick(2).alias("server")), table).select("page_id", "default_mime")


_TABLES = "t AS (SELECT DISTINCT CASE page_id % 4 WHEN 0 THEN '5.0' WHEN 1 THEN '6.0rtm' WHEN 2 THEN '6.0sp2' ELSE '4.0' END AS version, CASE WHEN page_id % 30 < 4 THEN '*' ELSE 'e' || page_id % 30 END AS ext, 'app/' || page_id % 7 AS mime FROM pages)"


@query(f"""WITH {_TABLES}, f AS (SELECT page_id, 'e' || page_id % 37 AS ext, CASE WHEN page_id % 11 = 0 THEN 'text/html' ELSE 'app/' || page_id % 7 END AS mime, CASE page_id % 5 WHEN 0 THEN '5.0' WHEN 1 THEN '8.5' WHEN 2 THEN '4.0' WHEN 3 THEN '6.0' ELSE '1.0' END AS v FROM pages),
a(v, table_, place) AS (VALUES ('5.0', '5.0', 0), ('4.0', '4.0', 0), ('6.0', '6.0rtm', 1), ('6.0', '6.0sp2', 3), ('8.5', '6.0rtm', 1), ('8.5', '6.0sp2', 3)), r AS (SELECT v, place, ext, mime FROM a JOIN t ON t.version = a.table_),
s AS (SELECT v, min(place) AS place FROM r WHERE ext = '*' GROUP BY v), x AS (SELECT r.v, r.mime FROM r JOIN s ON r.v = s.v AND r.place = s.place WHERE ext = '*')
SELECT page_id, v IN (SELECT v FROM r) AND (mime = 'text/html' OR CASE WHEN EXISTS (SELECT 1 FROM r WHERE r.v = f.v AND r.ext = f.ext) THEN EXISTS (SELECT 1 FROM r WHERE r.v = f.v AND r.ext = f.ext AND r.mime = f.mime) ELSE EXISTS (SELECT 1 FROM x WHERE x.v = f.v AND x.mime = f.mime) END) AS default_mime FROM f""")
def default_mime_tables(spark, d):
    """Tables of four server versions in files of their own, some of which other versions share."""
    n, pages = F.col("page_id"), spark.read.parquet(f"{d}/pages.parquet")
    version = F.when(n % 4 == 0, "5.0").when(n % 4 == 1, "6.0rtm").when(n % 4 == 2, "6.0sp2").otherwise("4.0")
    folder = new_folder(spark, "types")
    pages.select(F.when(n % 30 < 4, "*").otherwise(F.concat(F.lit("E"), (n % 30).cast("string"))).alias("ext"), F.concat(F.lit("app/"), (n % 7).cast("string")).alias("mime"), version.alias("version")).distinct().write.mode("overwrite").partitionBy("version").csv(folder, header=True)
    server = F.concat(F.lit("Microsoft-IIS/"), F.when(n % 5 == 0, "5.0").when(n % 5 == 1, "8.5").when(n % 5 == 2, "4.0").when(n % 5 == 3, "6.0").otherwise("1.0"))
    rows = pages.select("page_id", F.concat(F.lit("a.b.e"), (n % 37).cast("string")).alias("filename"), F.when(n % 11 == 0, "text/html").otherwise(F.concat(F.lit("app/"), (n % 7).cast("string"))).alias("mime"), server.alias("server"))
    return responses.with_default_mime(rows, responses.mime_tables(spark, folder)).select("page_id", "default_mime")


_REPRESENTED = "x AS (SELECT *, CASE WHEN ord % 11 = 0 THEN NULL ELSE digest END AS d, ord % 5 = 0 AS unavailable FROM caps), f AS (SELECT d, min((CAST(unavailable AS INT), ord)) AS f FROM x WHERE d IS NOT NULL GROUP BY d)"


def _some_without_digest(spark, d):
    return captures(spark, d).withColumn("digest", F.when(F.col("ord") % 11 != 0, F.col("digest"))).withColumn("unavailable", F.col("ord") % 5 == 0)


@query(f"WITH CAPS, {_REPRESENTED} SELECT ord FROM x WHERE d IS NULL UNION ALL SELECT f[2] FROM f")
def digest_downloads(spark, d):
    return responses.digest_representatives(_some_without_digest(spark, d)).select("ord")


@query(f"""WITH CAPS, {_REPRESENTED}, y AS (SELECT x.* FROM x JOIN f ON x.ord = f.f[2])
SELECT x.ord, CASE WHEN e.exact THEN 'downloaded' ELSE 'digest-match' END AS download, CASE WHEN y.d IS NULL OR y.unavailable OR (y.length = 0 AND NOT e.exact) THEN 'unavailable' ELSE concat('t', y.status) END AS type,
CAST(CASE WHEN y.d IS NULL OR y.unavailable THEN 0 ELSE y.length END AS BIGINT) AS size, CASE WHEN e.exact THEN concat('m', y.ord) END AS status_message, CASE WHEN e.exact THEN concat('mime/', y.ord) ELSE 'mime/own' END AS mime
FROM x LEFT JOIN y ON x.d = y.d, LATERAL (SELECT coalesce(NOT y.unavailable AND x.url = y.url AND x.ts14 = y.ts14 AND x.status = y.status, false) AS exact) e""")
def contents_joined(spark, d):
    rows = _some_without_digest(spark, d)
    headers = _pairs(("a", "b"))
    first = responses.digest_representatives(rows).where("digest is not null")
    downloads = first.select("digest", "url", "ts14", "status", F.concat(F.lit("m"), "ord").alias("status_message"), F.concat(F.lit("mime/"), "ord").alias("mime"), headers.alias("headers"), F.col("digest").alias("sha256"), F.concat(F.lit("t"), "status").alias("type"), F.col("length").alias("size"), "unavailable")
    out = responses.with_contents(rows.select("ord", "digest", "url", "ts14", "status", F.lit("mime/own").alias("mime"), headers.alias("headers"), F.lit("x").alias("type")), downloads)
    return out.select("ord", "download", "type", "size", "status_message", "mime")


@query("""SELECT page_id, CASE WHEN page_id % 2 = 0 THEN 'r' WHEN page_id % 3 = 0 THEN 'c' END AS first_header, CASE WHEN page_id % 2 = 0 THEN '192.0.2.1' END AS ip, CASE WHEN page_id % 2 = 0 THEN 'HTTP/1.1' END AS protocol, page_id % 2 = 1 AND page_id % 3 = 0 AS headers_derived FROM pages""")
def header_sources(spark, d):
    page = F.col("page_id")
    record = F.when(page % 2 == 0, F.struct(_pairs(("r", "1")).alias("headers"), F.lit("192.0.2.1").alias("ip"), F.lit("HTTP/1.1").alias("protocol")))
    rows = spark.read.parquet(f"{d}/pages.parquet").select("page_id", record.alias("record"), F.when(page % 3 == 0, _pairs(("c", "1"))).alias("cleaned_headers"))
    return responses.header_source(rows).select("page_id", F.get("headers", F.lit(0))["name"].alias("first_header"), "ip", "protocol", "headers_derived")


@query("""WITH CAPS, k AS (SELECT ord, length AS size, ord % 8 AS k FROM caps)
SELECT ord, CAST(CASE k WHEN 1 THEN size + 1 WHEN 3 THEN size + 2 END AS BIGINT) AS expected, size, CASE k WHEN 1 THEN 'length' WHEN 3 THEN 'unpacked length' ELSE 'unverifiable' END AS reason FROM k WHERE k IN (1, 3, 4)""")
def content_lengths(spark, d):
    k, size = F.col("ord") % 8, F.col("length")
    told = F.when(k == 2, -1).when(k == 0, size).otherwise(size + 1)
    gzip = F.when(k.isin(3, 4, 5, 6), "gzip")
    whole = F.when(k == 3, size + 2).when(k == 6, size)
    rows = captures(spark, d).select("ord", F.col("length").alias("size"), _pairs(("Content-Length", F.when(k != 7, told)), ("content-encoding", gzip), ("X-Original-Content-Length", whole)).alias("headers"), _pairs(("content-length", F.when(k == 7, told))).alias("raw_headers"), F.when(k == 7, "corrupt").otherwise("ok").alias("type"), F.when(k == 5, "downloaded").otherwise("digest-match").alias("download"))
    return responses.length_audit(rows)


_CLASS_TEXT = """CASE ord % 12 WHEN 0 THEN '' WHEN 1 THEN concat('<html>Page NOT Found', ord) WHEN 2 THEN concat(chr(10), '<HTML><HEAD><META HTTP-EQUIV="Refresh" CONTENT="0.1; URL=/p', ord, '">', chr(13), chr(10), '<META HTTP-EQUIV="Pragma" CONTENT="no cache">', chr(10), '<META HTTP-EQUIV="Expires" CONTENT="-1">', chr(10), '</HEAD></HTML>  ')
 ELSE concat('text ', ord) END"""


@query(f"""WITH CAPS, t AS (SELECT ord, {_CLASS_TEXT} AS text, CAST(CASE ord % 12 WHEN 6 THEN 400 WHEN 7 THEN 404 WHEN 8 THEN 503 WHEN 9 THEN 307 WHEN 10 THEN 403 WHEN 4 THEN 403 WHEN 1 THEN 403 ELSE 200 END AS INT) AS status FROM caps)
SELECT ord, CASE WHEN ord % 12 = 3 AND ord % 24 = 3 THEN 'given' WHEN ord % 12 = 11 THEN 'corrupt' WHEN ord % 12 = 0 THEN 'corrupt' WHEN ord % 12 = 5 THEN 'unavailable' WHEN ord % 12 = 6 THEN 'bad_request' WHEN ord % 12 = 7 THEN 'not_found' WHEN ord % 12 = 8 THEN 'origin_error' WHEN ord % 12 = 9 THEN 'redirect'
 WHEN ord % 12 = 1 THEN 'not_found' WHEN ord % 12 = 2 THEN 'transient_retry' WHEN ord % 12 IN (4, 10) THEN 'forbidden' ELSE 'ok' END AS type,
 CASE ord % 12 WHEN 11 THEN 'truncated' WHEN 0 THEN 'empty_content' WHEN 1 THEN 'not_found_string_detected' END AS reason, CASE WHEN ord % 12 = 11 THEN CAST(7 AS BIGINT) END AS downloaded_size FROM t""")
def classified_by_rule(spark, d):
    k = F.col("ord") % 12
    status = F.when(k == 6, 400).when(k == 7, 404).when(k == 8, 503).when(k == 9, 307).when(k.isin(1, 4, 10), 403).otherwise(200)
    details = F.struct(F.lit("truncated").alias("reason"), F.lit(7).cast("long").alias("downloaded_size"), F.lit(None).cast("long").alias("actual_size"))
    rows = captures(spark, d).select("ord", F.concat(F.lit("http://a.b/p"), "ord").alias("url"), status.alias("status"), F.concat(F.lit("s"), F.col("ord") % 24).alias("sha256"), F.lit("text/HTML").alias("mime"), F.expr(_CLASS_TEXT.replace("chr(", "char(")).cast("binary").alias("content"), F.when(k == 11, "corrupt").when(k == 5, "unavailable").alias("download"), details.alias("download_details"))
    given = spark.createDataFrame([("s3", "given")], "sha256 string, type string")
    c = F.col("classification")
    return cls.classify_captures(rows, ("page not found",), overrides=given).select("ord", c["type"].alias("type"), c["details"]["reason"].alias("reason"), c["details"]["downloaded_size"].alias("downloaded_size"))


@query("""SELECT page_id, CASE page_id % 5 WHEN 0 THEN 'windows-1252' WHEN 1 THEN 'utf-8' WHEN 2 THEN 'ISO-8859-2' WHEN 3 THEN 'x-none' ELSE 'iso-8859-1' END AS charset, concat(CASE page_id % 5 WHEN 0 THEN '' WHEN 1 THEN '<meta charset="utf-8">' WHEN 2 THEN '<META HTTP-EQUIV=Content-Type content="text/html; charset=ISO-8859-2">' WHEN 3 THEN '<meta name="charset" content="x-none">' ELSE '<meta charset=iso-8859-1>' END,
page_id, CASE page_id % 5 WHEN 0 THEN '€é' WHEN 1 THEN 'žé' WHEN 2 THEN 'žé' WHEN 3 THEN '€é' ELSE '€é' END) AS text FROM pages""")
def pages_decoded(spark, d):
    k = (F.col("page_id") % 5).cast("int")
    heads = ["", '<meta charset="utf-8">', '<META HTTP-EQUIV=Content-Type content="text/html; charset=ISO-8859-2">', '<meta name="charset" content="x-none">', "<meta charset=iso-8859-1>"]
    tails = [b"\x80\xe9", "žé".encode(), "žé".encode("iso-8859-2"), b"\x80\xe9", b"\x80\xe9"]
    content = F.concat(F.element_at(F.array(*(F.lit(h) for h in heads)), k + 1).cast("binary"), F.col("page_id").cast("string").cast("binary"), F.element_at(F.array(*(F.lit(t) for t in tails)), k + 1))
    rows = spark.read.parquet(f"{d}/pages.parquet").select("page_id", content.alias("content"))
    return rows.select("page_id", cls.page_charset(F.col("content")).alias("charset"), cls.decode_html(F.col("content")).alias("text"))


@query(r"""WITH CAPS, c AS (SELECT ord, ts14, CASE ord % 4 WHEN 0 THEN 'CC-MAIN-2008-2009' WHEN 1 THEN 'CC-MAIN-2012' END AS collection, CASE ord % 3 WHEN 0 THEN concat('http://a.b/Dir', ord, '?q') WHEN 1 THEN concat('http://\\c.d/e', ord) ELSE url END AS u, ord % 2 = 0 AS memento FROM caps),
k AS (SELECT *, ord % 4 = 0 AS local, ord % 12 = 0 AS slash, ord % 3 = 1 AS back, strftime(strptime(ts14, '%Y%m%d%H%M%S') + INTERVAL 8 HOUR, '%Y%m%d%H%M%S') AS utc FROM c)
SELECT ord, CASE WHEN local THEN utc ELSE ts14 END AS ts14, CASE WHEN memento THEN CASE WHEN local THEN utc ELSE ts14 END END AS memento14, CASE WHEN slash THEN concat('http://a.b/Dir', ord, '/?q') WHEN back THEN concat('http://c.d/e', ord) ELSE u END AS url,
array_to_string(list_filter([CASE WHEN local THEN 'captureTime' END, CASE WHEN local AND memento THEN 'mementoTime' END, CASE WHEN slash THEN 'url:CC-MAIN-2008-2009: Redirects followed without updating URL' END, CASE WHEN back THEN 'url:Malformed URL with backslash after protocol' END], lambda x: x IS NOT NULL), '|') AS corrections FROM k""")
def corrected_by_rule(spark, d):
    k = F.col("ord")
    own = F.when(k % 3 == 0, F.concat(F.lit("http://a.b/Dir"), k, F.lit("?q"))).when(k % 3 == 1, F.concat(F.lit("http://\\c.d/e"), k)).otherwise(F.col("url"))
    rows = captures(spark, d).select("ord", "ts14", F.when(k % 2 == 0, F.col("ts14")).alias("memento14"), own.alias("url"), F.concat(F.lit("http://x.y/dir"), k, F.lit("/")).alias("request_url"), F.lit(200).alias("status"), F.when(k % 4 == 0, "CC-MAIN-2008-2009").when(k % 4 == 1, "CC-MAIN-2012").alias("collection"))
    out = cls.apply_corrections(rows, records.quirks_table(spark))
    said = F.transform("corrections", lambda c: F.when(c["field"] == "url", F.concat(F.lit("url:"), c["reason"])).otherwise(c["field"]))
    return out.select("ord", "ts14", "memento14", "url", F.array_join(said, "|").alias("corrections"))


_RULES = ("server-time-mismatch", "capture-time-precise-mismatch", "modification-time-future", "modification-time-precise-mismatch", "modification-time-precise-candidate-mismatch", "memento-time-mismatch", "record-content-mismatch", "record-status-mismatch", "record-timestamp-mismatch", "record-url-mismatch")
_BROKEN = ["ord % 2 = 0", "ord % 3 = 0", "ord % 5 = 0", "ord % 7 = 0", "ord % 11 = 0", "ord % 13 = 0", "ord % 4 <> 3 AND ord % 6 = 1", "ord % 4 <> 3 AND ord % 6 = 2", "ord % 6 = 3", "ord % 6 = 4"]


@query(f"""WITH CAPS SELECT ord, array_to_string(list_filter([{", ".join(f"CASE WHEN {b} THEN '{r}' END" for r, b in zip(_RULES, _BROKEN, strict=True))}], lambda x: x IS NOT NULL), '|') AS errors,
CASE WHEN ord % 6 = 4 THEN concat('http://other/', ord) END AS record_url FROM caps""")
def validated_by_rule(spark, d):
    k, t = F.col("ord"), F.to_timestamp("ts14", "yyyyMMddHHmmss")
    shift = lambda wrong, seconds: F.timestamp_seconds(F.unix_timestamp(t) + F.when(wrong, seconds).otherwise(0))
    modified = F.timestamp_seconds(F.unix_timestamp(t) + F.when(k % 5 == 0, 3601).otherwise(-9))
    beside = lambda wrong: F.timestamp_seconds(F.unix_timestamp(modified) + F.when(wrong, 2).otherwise(1))
    record = F.struct(F.when(k % 6 == 1, "x").otherwise(F.col("digest")).alias("sha256"), F.when(k % 6 == 2, 1).otherwise(F.col("status")).alias("status"), F.when(k % 6 == 3, "x").otherwise(F.col("ts14")).alias("ts14"), F.when(k % 6 == 4, F.concat(F.lit("http://other/"), k)).otherwise(F.col("url")).alias("url"))
    rows = captures(spark, d).select(
        "ord", t.alias("capture_time"), shift(k % 2 == 0, 31 * 86400).alias("server_time"), shift(k % 3 == 0, -2).alias("precise_capture_time"), modified.alias("modified_time"), beside(k % 7 == 0).alias("precise_modified_time"), F.array(beside(F.lit(False)), beside(k % 11 == 0)).alias("modified_candidates"),
        shift(k % 13 == 0, 1).alias("memento_time"), F.col("digest").alias("sha256"), "status", (k % 4 == 3).alias("is_revisit"), F.col("ts14").alias("index_ts14"), F.col("url").alias("index_url"), record.alias("record"),
    )
    out = cls.validate_captures(rows)
    url = F.filter("errors", lambda e: e["type"] == "record-url-mismatch")
    return out.select("ord", F.array_join(F.transform("errors", lambda e: e["type"]), "|").alias("errors"), F.get(F.get(url, F.lit(0))["values"], F.lit(0))["value"].alias("record_url"))


@query("""WITH e AS (SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS s FROM events)
SELECT event_id, CASE WHEN event_id % 3 <> 2 THEN strftime(make_timestamp(s * 1000000), '%Y-%m-%dT%H:%M:%S.000000000Z') END AS modified_precise FROM e""")
def exact_modification_times(spark, d):
    """ETags made of the events' own seconds: with their time as the modification time, or of such a server; of another server, none."""
    from arkspark.functions.scalars import iis_etag

    k = F.col("event_id")
    s = F.unix_timestamp("ts")
    rows = spark.read.parquet(f"{d}/events.parquet").select("event_id", iis_etag(s, F.lit(0), F.lit(5)).alias("etag"), (s + 5).cast("long").alias("capture_seconds"), F.when(k % 3 == 0, s).cast("long").alias("modified_seconds"), F.when(k % 3 == 1, "Microsoft-IIS/5.0").otherwise("Apache").alias("server"))
    out = etags.exact_modification(rows)
    # a second candidate may be as plausible; the event's own is among them
    own = F.date_format(F.timestamp_seconds(F.col("capture_seconds") - 5), "yyyy-MM-dd'T'HH:mm:ss.000000000'Z'")
    held = F.coalesce(F.array_contains("modified_candidates", own), F.lit(False)) | F.coalesce(F.col("modified_precise") == own, F.lit(False))
    return out.select("event_id", F.when(held, own).alias("modified_precise"))
