"""Registered queries of archive records: the pages are written to archives first, and the SQL tells what must come back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arkspark.functions.scalars import header_value
from arkspark.operators import archive_files, records
from arkspark.plans.queries import query
from arkspark.sources import archives
from arkspark.sources.files import written

_CRLF = "\r\n"


def _bytes(*parts) -> F.Column:
    return F.concat(*((F.lit(p) if isinstance(p, str) else p.cast("string") if not isinstance(p, tuple) else p[0]).cast("binary") for p in parts))


def _warc(kind: str, record_id, block, *headers) -> F.Column:
    lines = [x for name, value in headers for x in (f"{name}: ", value, _CRLF)]
    return _bytes("WARC/1.0" + _CRLF, f"WARC-Type: {kind}{_CRLF}WARC-Date: 2024-01-01T00:00:00Z{_CRLF}WARC-Record-ID: ", record_id, _CRLF, *lines, "Content-Length: ", F.octet_length(block), _CRLF * 2, (block,), _CRLF * 2)


def _pages(spark, d) -> DataFrame:
    return spark.read.parquet(f"{d}/pages.parquet").select("page_id", "url", F.col("html").cast("binary").alias("body"))


def _name(letter: str) -> F.Column:
    return F.concat(F.lit(f"<urn:{letter}:"), F.col("page_id").cast("string"), F.lit(">"))


def _warc_places(spark, d) -> DataFrame:
    """Of each page a request and a response, chunked or with a length, and of some a description, a look-up of the host and a revisit.
    The lengths of every third page are higher than what was kept."""
    page, body, url = F.col("page_id"), F.col("body"), F.col("url")
    chunked = _bytes("HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\nContent-Type: text/html\r\n\r\n", F.hex(F.octet_length("body")), ";x=y\r\n", (body,), "\r\n0\r\n\r\n")
    plain = _bytes("HTTP/1.1 404 Not Found\r\nContent-Length: ", F.octet_length("body") + F.when(page % 3 == 1, 5).otherwise(0), "\r\n\r\n", (body,))
    response = _warc("response", _name("r"), F.when(page % 3 == 0, chunked).otherwise(plain), ("WARC-Target-URI", F.concat(F.lit("<"), url, F.lit(">"))), ("WARC-IP-Address", F.lit("192.0.2.1")))
    request = _warc("request", _name("q"), _bytes("GET /x HTTP/1.0\r\nHost: a\r\n\r\n"), ("WARC-Target-URI", url), ("WARC-Concurrent-To", _name("r")))
    info = F.when(page % 10 == 0, _warc("warcinfo", _name("i"), _bytes("software: crawler ", page, "\r\nformat: WARC\r\n\r\n")))
    dns = F.when(page % 7 == 0, _warc("response", _name("d"), _bytes("20240101 host"), ("WARC-Target-URI", F.lit("dns:host"))))
    again = F.when(page % 5 == 0, _warc("revisit", _name("v"), _bytes("HTTP/1.1 200 OK\r\nA: b\r\n\r\n"), ("WARC-Target-URI", url), ("WARC-Refers-To", _name("r"))))
    held = F.array(*(F.struct(F.lit(letter).alias("letter"), record.alias("record")) for letter, record in zip("iqrdv", (info, request, response, dns, again), strict=True)))
    rows = _pages(spark, d).select(F.inline(F.filter(held, lambda r: r["record"].isNotNull())))
    return archives.write_archives(rows, ".warc.gz")


def _parsed(spark, d) -> DataFrame:
    return records.parse_records(archives.scan_archives(_warc_places(spark, d)))


_EXPECTED = """p AS (SELECT page_id, url, html FROM pages), r AS (
SELECT 'r' AS c, 'warc' AS kind, page_id, NULL AS concurrent_to, NULL AS refers_to, url, '192.0.2.1' AS ip, '' AS method, 'HTTP/1.1' AS protocol, CASE WHEN page_id % 3 = 0 THEN 200 ELSE 404 END AS status, CASE WHEN page_id % 3 = 0 THEN 'OK' ELSE 'Not Found' END AS status_message, html AS content FROM p
UNION ALL SELECT 'q', 'warc-request', page_id, '<urn:r:' || page_id || '>', NULL, url, NULL, 'GET', 'HTTP/1.0', 0, '', '' FROM p
UNION ALL SELECT 'i', 'warc-info', page_id, NULL, NULL, '', NULL, '', '', 0, '', 'software: crawler ' || page_id || chr(13) || chr(10) || 'format: WARC' || chr(13) || chr(10) || chr(13) || chr(10) FROM p WHERE page_id % 10 = 0
UNION ALL SELECT 'd', 'warc', page_id, NULL, NULL, 'dns:host', NULL, '', '', 0, '', '20240101 host' FROM p WHERE page_id % 7 = 0
UNION ALL SELECT 'v', 'warc', page_id, NULL, '<urn:r:' || page_id || '>', url, NULL, '', 'HTTP/1.1', 200, 'OK', '' FROM p WHERE page_id % 5 = 0)"""
_COLUMNS = "'<urn:' || c || ':' || page_id || '>' AS record_id, kind, concurrent_to, refers_to, url, ip, method, protocol, CAST(status AS INTEGER) AS status, status_message, sha256(content) AS sha256"


@query(f"WITH {_EXPECTED} SELECT {_COLUMNS}, CAST(NULL AS VARCHAR) AS error FROM r")
def warc_records(spark, d):
    return _parsed(spark, d).select("record_id", "kind", "concurrent_to", "refers_to", "url", "ip", "method", "protocol", "status", "status_message", F.sha2("content", 256).alias("sha256"), "error")


@query(f"WITH {_EXPECTED} SELECT {_COLUMNS} FROM r")
def records_looked_up(spark, d):
    places = _warc_places(spark, d)
    found = records.parse_records(archives.look_up_records(places))
    return found.select("record_id", "kind", "concurrent_to", "refers_to", "url", "ip", "method", "protocol", "status", "status_message", F.sha2("content", 256).alias("sha256"))


@query("""SELECT '<urn:r:' || page_id || '>' AS record_id, CASE WHEN page_id % 3 = 1 THEN 'truncated' END AS reason, CASE WHEN page_id % 3 = 1 THEN CAST(octet_length(encode(html)) AS BIGINT) END AS downloaded_size,
CASE WHEN page_id % 3 = 1 THEN CAST(octet_length(encode(html)) AS BIGINT) + 5 END AS actual_size FROM pages""")
def records_truncated(spark, d):
    t = records.truncation(F.col("content"), F.col("headers"), F.col("metadata"))
    return _parsed(spark, d).where("kind = 'warc' and record_id like '<urn:r:%'").select("record_id", t["reason"].alias("reason"), t["downloaded_size"].alias("downloaded_size"), t["actual_size"].alias("actual_size"))


@query("""WITH p AS (SELECT page_id FROM pages), k(c, kind, m) AS (VALUES ('r', 'warc', 1), ('q', 'warc-request', 1), ('v', 'warc', 5)), r AS (SELECT page_id, c, kind FROM p, k WHERE page_id % m = 0)
SELECT '<urn:' || a.c || ':' || a.page_id || '>' AS record_id, '<urn:' || b.c || ':' || b.page_id || '>' AS related_id, b.kind AS related_kind FROM r a JOIN r b ON a.page_id = b.page_id AND a.c <> b.c AND a.kind = 'warc'""")
def records_related(spark, d):
    """From the places of responses, as an index has them: only the bytes around those are read."""
    near = archives.records_nearby(_warc_places(spark, d).where("letter = 'r'"))
    parsed = written(records.parse_records(near).select("path", "offset", "length", "kind", "record_id", "concurrent_to", "refers_to"), "parsed")
    ids = parsed.select("path", "offset", "record_id")
    own = records.related_records(parsed).join(ids, ["path", "offset"])
    return own.join(ids.select("path", F.col("offset").alias("related_offset"), F.col("record_id").alias("related_id")), ["path", "related_offset"]).select("record_id", "related_id", "related_kind")


@query("""SELECT page_id, 'software=crawler ' || page_id || '|format=WARC' AS fields FROM pages WHERE page_id % 10 = 0""")
def warcinfo_read(spark, d):
    info = _parsed(spark, d).where("kind = 'warc-info'")
    fields = records.warcinfo_fields(F.col("content"))
    return info.select(F.regexp_extract("record_id", r"(\d+)", 1).cast("long").alias("page_id"), F.array_join(F.transform(fields, lambda f: F.concat(f["name"], F.lit("="), f["value"])), "|").alias("fields"))


_ARC_COLLECTION = "CASE page_id % 4 WHEN 0 THEN 'CC-MAIN-2008-2009' WHEN 1 THEN 'CC-MAIN-2012' WHEN 2 THEN 'CC-MAIN-2018-34' END"


def _arc_places(spark, d) -> DataFrame:
    """Records of one and two lines' worth of fields, with the oddities of their collections; before every eighth, a description."""
    page, body = F.col("page_id"), F.col("body")
    block = _bytes("HTTP/1.0 200 Fine  now\r\nx-commoncrawl-a: 1\r\nTransfer-Encoding: ", F.when(page % 4 < 2, "chunked").otherwise("x"), "\r\nB:2\r\n\r\n", (body,))
    length = F.octet_length(block) + F.when(page % 4 == 1, 1).otherwise(0)
    head = F.when(page % 2 == 0, F.concat(F.col("url"), F.lit(" 192.0.2.7 20080102030405 text/html "))).otherwise(F.concat(F.col("url"), F.lit(" 192.0.2.7 20080102030405 text/html 200 - - 0 f.arc.gz ")))
    record = _bytes(head, length, "\n", (block,), "\n")
    xml = _bytes('1 1 InternetArchive\nURL IP\n<arcmetadata xmlns="x">\n<arc:software>Crawler ', page, "</arc:software>\n<arc:robots y>obey</arc:robots>\n<dc:format>ARC</dc:format></arcmetadata>\n")
    described = F.when(page % 8 == 0, _bytes("filedesc://", page, ".arc 0.0.0.0 20080102030405 text/plain ", F.octet_length(xml), "\n", (xml,), "\nrest"))
    rows = _pages(spark, d).select("page_id", F.expr(_ARC_COLLECTION).alias("collection"), F.explode(F.array_compact(F.array(described, record))).alias("record"))
    return archives.write_archives(rows, ".arc.gz")


@query(f"""SELECT page_id, 'arc' AS kind, url, '192.0.2.7' AS ip, '2008-01-02T03:04:05Z' AS ts, CAST(200 AS INTEGER) AS status, 'Fine  now' AS status_message, 'HTTP/1.0' AS protocol, sha256(html) AS sha256,
CASE WHEN page_id % 4 < 2 THEN '1' END AS moved, CASE WHEN page_id % 4 < 2 THEN NULL ELSE '1' END AS stayed, '2' AS b, CAST(NULL AS VARCHAR) AS error FROM pages
UNION ALL SELECT page_id, 'arc-header', 'filedesc://' || page_id || '.arc', '0.0.0.0', '2008-01-02T03:04:05Z', 0, '', '', NULL, NULL, NULL, NULL, NULL FROM pages WHERE page_id % 8 = 0""")
def arc_records(spark, d):
    places = _arc_places(spark, d)
    found = archives.look_up_records(places).drop("error").join(places, ["path", "offset", "length"])
    parsed = records.parse_records(found, ("page_id",), "collection")
    content = F.when(F.col("kind") == "arc", F.sha2("content", 256))
    return parsed.select("page_id", "kind", "url", "ip", "ts", "status", "status_message", "protocol", content.alias("sha256"), header_value(F.col("metadata"), "x-commoncrawl-a").alias("moved"), header_value(F.col("headers"), "x-commoncrawl-a").alias("stayed"), header_value(F.col("headers"), "b").alias("b"), "error")


@query("""SELECT page_id, 'software=Crawler ' || page_id || '|robots=obey|format=ARC' AS fields FROM pages WHERE page_id % 8 = 0""")
def arc_descriptions(spark, d):
    parsed = records.parse_records(archives.scan_archives(_arc_places(spark, d))).where("kind = 'arc-header'")
    tags = records.arc_description(F.col("content"))
    return parsed.select(F.regexp_extract("url", r"(\d+)", 1).cast("long").alias("page_id"), F.array_join(F.transform(tags, lambda f: F.concat(f["name"], F.lit("="), f["value"])), "|").alias("fields"))


_XML = ('1 1 InternetArchive\nURL IP\n<arcmetadata xmlns="x">\n<arc:software>Crawler ', "</arc:software>\n</arcmetadata>\n")
_XML_SQL = "' || page_id || '".join(x.replace("\n", "' || chr(10) || '") for x in _XML)
_LINES_SQL = "chr(13) || chr(10)"


@query(f"""WITH f AS (SELECT page_id // 16 AS file, min(page_id) AS page_id FROM pages GROUP BY 1), x AS (SELECT *, '{_XML_SQL}' AS xml FROM f JOIN pages USING (page_id)),
r AS (SELECT file, page_id, CASE WHEN file % 2 = 0 THEN 'filedesc://' || page_id || '.arc 0.0.0.0 20080102030405 text/plain ' || octet_length(encode(xml)) || chr(10) || xml
ELSE 'WARC/1.0' || {_LINES_SQL} || 'WARC-Type: response' || {_LINES_SQL} || 'WARC-Date: 2024-01-01T00:00:00Z' || {_LINES_SQL} || 'WARC-Record-ID: <urn:r:' || page_id || '>' || {_LINES_SQL} || 'WARC-Target-URI: ' || url || {_LINES_SQL}
 || 'Content-Length: ' || octet_length(encode(html)) || {_LINES_SQL} || {_LINES_SQL} || html || {_LINES_SQL} || {_LINES_SQL} END AS record FROM x)
SELECT file, page_id, CAST(0 AS BIGINT) AS "offset", CAST(octet_length(encode(record)) AS BIGINT) AS bytes, sha256(record) AS sha256 FROM r""")
def archive_first_records(spark, d):
    """A file for each 16 pages, every other one begun by its description: of each the record at its start, without what follows the description's last line."""
    page = F.col("page_id")
    xml = _bytes(_XML[0], page, _XML[1])
    described = _bytes("filedesc://", page, ".arc 0.0.0.0 20080102030405 text/plain ", F.octet_length(xml), "\n", (xml,), "rest")
    response = _warc("response", _name("r"), F.col("body"), ("WARC-Target-URI", F.col("url")))
    rows = _pages(spark, d).withColumn("file", F.expr("page_id div 16")).select("page_id", "file", F.posexplode(F.array_compact(F.array(F.when(page % 32 == 0, described), response))).alias("ord", "record"))
    places = archives.write_archives(rows.repartition("file").sortWithinPartitions("file", "page_id", "ord"), ".gz", by="file")
    first = archives.first_records(places).join(places.select("path", "offset", "file", "page_id"), ["path", "offset"])
    return first.select("file", "page_id", "offset", F.length("record").cast("long").alias("bytes"), F.sha2("record", 256).alias("sha256"))


@query("""SELECT page_id, 'Content-Length=9|Server=a' || CASE WHEN page_id % 2 = 0 THEN '|Content-Encoding=gzip' ELSE '' END AS headers, 'WARC-Type=response' || '|X-Crawler-content-length=' || page_id AS metadata FROM pages""")
def crawler_headers(spark, d):
    pair = lambda name, value: F.struct(F.lit(name).alias("name"), value.cast("string").alias("value"))
    page = F.col("page_id")
    headers = F.filter(F.array(pair("X-Crawler-Content-Length", F.lit("9")), pair("Server", F.lit("a")), pair("content-length", page), F.when(page % 2 == 0, pair("x-crawler-Content-Encoding", F.lit("gzip")))), lambda h: h.isNotNull())
    both = records.restore_crawler_headers(headers, F.array(pair("WARC-Type", F.lit("response"))))
    text = lambda pairs: F.array_join(F.transform(pairs, lambda h: F.concat(h["name"], F.lit("="), h["value"])), "|")
    return _pages(spark, d).select("page_id", text(both["headers"]).alias("headers"), text(both["metadata"]).alias("metadata"))


@query("""WITH i AS (SELECT page_id, 'item' || page_id AS item FROM pages WHERE page_id % 3 = 0), f AS (SELECT page_id, item, 'a.warc.gz' AS file, page_id AS n FROM i UNION ALL SELECT page_id, item, 'b.ARC.GZ', page_id + 1 FROM i UNION ALL SELECT page_id, item, 'c.warc.zst', NULL FROM i)
SELECT p.page_id, f.item AS item, f.n AS archive_size, CASE WHEN f.item IS NOT NULL THEN md5(coalesce(CAST(f.n AS VARCHAR), 'x')) END AS archive_md5, epoch(make_timestamp(f.n * 1000000)) AS modified
FROM pages p LEFT JOIN f ON f.item = 'item' || p.page_id AND f.file = CASE p.page_id % 2 WHEN 0 THEN 'a.warc.gz' ELSE 'b.ARC.GZ' END""")
def archive_file_statistics(spark, d):
    pages = _pages(spark, d)
    file = lambda name, n: F.struct(F.lit(name).alias("name"), n.cast("string").alias("size"), F.md5(F.coalesce(n.cast("string"), F.lit("x")).cast("binary")).alias("md5"), n.cast("string").alias("mtime"))
    page = F.col("page_id")
    catalogue = pages.where("page_id % 3 = 0").select(F.concat(F.lit("item"), page.cast("string")).alias("item"), F.array(file("a.warc.gz", page), file("b.ARC.GZ", page + 1), file("c.warc.zst", F.lit(None).cast("long")), file("notes.txt", page)).alias("files"))
    rows = pages.select("page_id", F.concat(F.lit("item"), page.cast("string"), F.when(page % 2 == 0, F.lit("/a.warc.gz")).otherwise(F.lit("/b.ARC.GZ"))).alias("filename"))
    out = archive_files.with_file_statistics(rows, archive_files.file_statistics(catalogue))
    return out.select("page_id", F.when(F.col("archive_md5").isNotNull(), F.substring_index("filename", "/", 1)).alias("item"), "archive_size", "archive_md5", F.unix_timestamp("archive_modified").cast("double").alias("modified"))


@query("""SELECT page_id, CASE WHEN page_id % 2 = 0 THEN CAST(7 AS BIGINT) ELSE CAST(2 AS BIGINT) END AS warc_files, CAST(1 AS BIGINT) AS arc_files FROM pages""")
def archive_file_counts(spark, d):
    names = F.array(*(F.struct(F.lit(x).alias("name")) for x in ("a.warc.gz", "b.warc.zst", "c.arc.gz", "d.txt")))
    items = _pages(spark, d).select(F.col("page_id").alias("item"), names.alias("files"), F.when(F.col("page_id") % 2 == 0, 7).alias("warc_files"), F.lit(None).cast("int").alias("arc_files"))
    return archive_files.archive_counts(items).withColumnRenamed("item", "page_id")


@query("""SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS archive_size, CASE WHEN page_id % 3 > 0 THEN md5(html) END AS archive_md5, epoch(make_timestamp((1700000000 + page_id) * 1000000)) AS modified FROM pages""")
def stored_file_statistics(spark, d):
    """Files of a store, whose ETags are MD5s but for those put there in parts."""
    pages, page = _pages(spark, d), F.col("page_id")
    etag = F.when(page % 3 == 0, F.concat(F.md5("body"), F.lit("-2"))).when(page % 3 == 1, F.concat(F.lit('"'), F.md5("body"), F.lit('"'))).otherwise(F.md5("body"))
    objects = pages.select(F.concat(F.lit("crawl-data/"), page.cast("string"), F.lit(".warc.gz")).alias("file"), F.octet_length("body").cast("string").alias("length"), etag.alias("etag"), F.timestamp_seconds(page + 1_700_000_000).alias("modified"))
    rows = pages.select("page_id", F.concat(F.lit("crawl-data/"), page.cast("string"), F.lit(".warc.gz")).alias("filename"))
    out = archive_files.with_object_statistics(rows, archive_files.object_statistics(objects))
    return out.select("page_id", "archive_size", "archive_md5", F.unix_timestamp("archive_modified").cast("double").alias("modified"))
