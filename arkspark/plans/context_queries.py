"""Registered queries of catalogues, enrichment, look-ups, versions, summaries and further stages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arkspark.functions import dates, scalars
from arkspark.functions.archive_names import archive_name
from arkspark.operators import archive_files, enrichment, joins, lookup, sampling, transforms, versions
from arkspark.operators.ordinals import ordinals
from arkspark.plans.queries import key_sql, query
from arkspark.sources import catalogues, outputs
from arkspark.sources.captures import captures
from arkspark.sources.files import new_folder


_KEY = key_sql("url")


def _table(spark, d, name) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _n(column: str = "page_id") -> F.Column:
    return F.col(column).cast("string")


# Catalogues


@query("""WITH CAPS SELECT concat('k', ord) AS urlkey, ts14, url, 'text/html' AS mime, CASE WHEN ord % 3 > 0 THEN CAST(status AS BIGINT) END AS status, length, CASE WHEN ord % 4 > 0 THEN ord END AS "offset", digest, 'f.warc.gz' AS filename FROM caps WHERE ord % 7 > 0""")
def library_index(spark, d):
    text = lambda kept, c: F.when(kept, F.col(c).cast("string")).otherwise("-")
    k = F.col("ord")
    line = F.struct(F.concat(F.lit("k"), k).alias("urlkey"), F.col("ts14").alias("timestamp"), "url", F.lit("text/html").alias("mime"), text(k % 3 > 0, "status").alias("status"), "digest", F.lit("-").alias("redirect"), F.col("length").cast("string").alias("length"), text(k % 4 > 0, "ord").alias("offset"), F.lit("f.warc.gz").alias("filename"), F.lit("x").alias("source-coll"))
    lines = captures(spark, d).select(F.when(k % 7 > 0, F.to_json(line)).otherwise(F.lit("{broken")).alias("value"))
    return catalogues.parse_library_index(lines)


def _collections(spark, d):
    folder = new_folder(spark, "catalogue")
    rows = _table(spark, d, "region").select(F.struct(F.concat(F.lit("CC-"), "r_regionkey").alias("id"), F.concat(F.trim("r_name"), F.lit(" Index")).alias("name"), F.lit("2020-01-01").alias("from"), F.lit("2020-02-01").alias("to")).alias("r"))
    rows.agg(F.to_json(F.array_sort(F.collect_list("r"))).alias("value")).write.text(f"{folder}/collections")
    sizes = _table(spark, d, "nation").groupBy("n_regionkey").agg(F.count("*").alias("n")).select(F.concat(F.lit("CC-"), "n_regionkey").alias("crawl"), F.col("n").cast("string").alias("page"), F.concat("n", F.lit("0")).alias("url"), F.when(F.col("n_regionkey") == 2, "n/a").otherwise(F.concat("n", F.lit("00"))).alias("digest estim."))
    sizes.write.csv(f"{folder}/sizes", header=True)
    return catalogues.read_collections(spark, f"{folder}/collections"), catalogues.read_collection_sizes(spark, f"{folder}/sizes")


@query("""WITH n AS (SELECT n_regionkey, count(*) AS n FROM nation GROUP BY 1)
SELECT n_nationkey, CASE WHEN r_regionkey = 1 THEN 'Spring Crawl' ELSE concat(trim(r_name), ' Crawl') END AS title, CASE WHEN r_regionkey = 1 THEN '2006-01-02' END AS publish_date, n.n AS pages, n.n * 10 AS urls, CASE WHEN n.n_regionkey <> 2 THEN n.n * 100 END AS digests
FROM nation a JOIN region ON r_regionkey = a.n_regionkey JOIN n ON n.n_regionkey = a.n_regionkey""")
def collection_info(spark, d):
    collections, sizes = _collections(spark, d)
    info = spark.createDataFrame([("CC-1", "Spring Crawl Index", "January 2, 2006", "s")], "id string, title string, date string, summary string")
    out = joins.with_collection_info(_table(spark, d, "nation").select("n_nationkey", F.concat(F.lit("CC-"), "n_regionkey").alias("collection")), collections, info, sizes)
    i = F.col("collection_info")
    return out.select("n_nationkey", *(i[c].alias(c) for c in ("title", "publish_date", "pages", "urls", "digests")))


@query("""SELECT concat('i', page_id) AS item, CASE WHEN page_id % 3 = 0 THEN 2 ELSE 1 END AS n_files, CASE WHEN page_id % 2 = 0 THEN CAST(9 AS BIGINT) ELSE CAST(1 AS BIGINT) END AS warc_files, CASE WHEN page_id % 3 = 0 THEN CAST(1 AS BIGINT) ELSE CAST(0 AS BIGINT) END AS arc_files,
CASE WHEN page_id % 4 = 0 THEN CASE WHEN page_id >= 2 THEN 'i1:t1' ELSE 'i1:t1' END WHEN page_id % 4 = 1 THEN 'i2:t2|i1:t1' ELSE '' END AS collections FROM pages""")
def item_catalogue(spark, d):
    p = F.col("page_id")
    parents = F.when(p % 4 == 0, F.lit('"i1"')).when(p % 4 == 1, F.lit('["web","i2","none","i1"]')).otherwise(F.lit("null"))
    files = F.concat(F.lit('[{"name":"a.warc.gz","size":"1"},{"name":"n.txt"}'), F.when(p % 3 == 0, F.lit(',{"name":"b.arc.gz","mtime":"5"}')).otherwise(""), F.lit("]"))
    value = F.concat(F.lit('{"metadata":{"identifier":"i'), _n(), F.lit('","title":"t'), _n(), F.lit('","collection":'), parents, F.when(p % 2 == 0, F.lit(',"numwarcs":"9"')).otherwise(""), F.lit('},"files":'), files, F.lit("}"))
    items = catalogues.parse_items(_table(spark, d, "pages").select(value.alias("value")))
    counts = archive_files.archive_counts(items)
    listed = joins.parent_collections(items).select("item", F.array_join(F.transform("collections", lambda c: F.concat(c["id"], F.lit(":"), c["title"])), "|").alias("collections"))
    return items.select("item", F.size("files").alias("n_files")).join(counts, "item").join(listed, "item")


@query("""WITH r AS (SELECT r_regionkey AS k FROM region)
SELECT concat('p', k) AS key, CAST(CASE WHEN j = 0 THEN '2000' ELSE '2010' END AS VARCHAR) AS "from", CASE WHEN j = 1 THEN concat('192.0.2.', k) END AS ip_range, CASE WHEN j = 0 THEN 2 END AS known, CAST(j AS BIGINT) AS ord FROM r, range(2) t(j)
UNION ALL SELECT concat('name', k), '1999', NULL, NULL, CAST(0 AS BIGINT) FROM r""")
def enrichment_periods(spark, d):
    k = F.col("r_regionkey").cast("string")
    lists = F.concat(F.lit('// periods\n[{"from": "2000", "to": "2009", knownCrawlers: [{"crawlerName": "a"}, {"crawlerName": \'b\',},],}, /* later */ {"from": "2010", "to": "2019", "crawlerIpRange": "192.0.2.'), k, F.lit('"},]'))
    keyed = F.concat(F.lit('{"NAME'), k, F.lit('": [{"from": "1999", "to": "2001", "crawlerHostname": "h",},],}'))
    regions = _table(spark, d, "region")
    a = catalogues.parse_periods(regions.select(F.concat(F.lit("p"), k).alias("key"), lists.alias("value")), "crawlers", False)
    b = catalogues.parse_periods(regions.select(F.lit("file").alias("key"), keyed.alias("value")), "overrides", True)
    return a.select("key", "from", F.col("crawlerIpRange").alias("ip_range"), F.when(F.size("knownCrawlers") > 0, F.size("knownCrawlers")).alias("known"), "ord").unionByName(b.select("key", "from", F.lit(None).cast("string").alias("ip_range"), F.lit(None).cast("int").alias("known"), "ord"))


_WANTED = """CASE WHEN page_id % 3 = 0 THEN '2001' END AS f_min, CASE WHEN page_id % 5 = 0 THEN '2002' END AS u_min"""


def _wanted(spark, d) -> DataFrame:
    p = F.col("page_id")
    entry = lambda url, low: F.struct(url.alias("url"), low.alias("min_ts"), F.lit(None).cast("string").alias("max_ts"), F.lit(None).cast("string").alias("slash_mode"))
    nothing = F.lit(None).cast("string")
    urls = F.array(entry(F.concat(F.lit("http://www.{var:site}.org/"), (p % 10).cast("string")), F.when(p % 5 == 0, "2002")), entry(F.concat(F.lit("https://{var:other}/"), _n()), nothing))
    return _table(spark, d, "pages").select(p.alias("input_id"), F.when(p % 3 == 0, "2001").alias("min_ts"), nothing.alias("max_ts"), F.when(p % 2 == 0, "strict").alias("slash_mode"), urls.alias("urls"))


def _variables(spark) -> DataFrame:
    return spark.createDataFrame([("site", "example"), ("unused", "x")], "name string, value string")


@query(f"""WITH p AS (SELECT page_id, {_WANTED} FROM pages)
SELECT page_id AS input_id, CAST(0 AS INTEGER) AS "at", concat('http://www.example.org/', page_id % 10) AS url, coalesce(u_min, f_min, '2000') AS min_ts, CASE WHEN page_id % 2 = 0 THEN 'strict' END AS slash_mode, NULL AS error FROM p
UNION ALL SELECT page_id, 1, concat('https://{{var:other}}/', page_id), coalesce(f_min, '2000'), CASE WHEN page_id % 2 = 0 THEN 'strict' END, 'unknown variable' FROM p""")
def requests_listed(spark, d):
    return catalogues.requests_of(_wanted(spark, d), _variables(spark), "2000").drop("max_ts")


@query("""SELECT concat('example.org/', page_id % 10) AS bare_url, array_to_string(list_sort(list(page_id)), ',') AS inputs FROM pages GROUP BY page_id % 10 HAVING count(*) > 1""")
def urls_shared(spark, d):
    out = catalogues.shared_urls(catalogues.requests_of(_wanted(spark, d), _variables(spark)))
    return out.select("bare_url", F.array_join(F.col("inputs").cast("array<string>"), ",").alias("inputs"))


# Joins


@query("""WITH CAPS, t AS (SELECT ts14, url, digest, length, min(ord) AS o FROM caps WHERE ord % 3 = 0 GROUP BY ALL)
SELECT c.ord, CASE WHEN c.ord % 2 = 0 THEN c.ord WHEN c.ord % 5 = 0 THEN t.o + 1000000 END AS "offset" FROM caps c LEFT JOIN t ON t.ts14 = c.ts14 AND t.url = c.url AND t.digest = c.digest AND t.length = c.length""")
def offsets_completed(spark, d):
    rows = captures(spark, d)
    third = rows.where("ord % 3 = 0").select("ord", "ts14", "url", "digest", "length", (F.col("ord") + 1_000_000).alias("offset"))
    own = rows.select("ord", "ts14", "url", "digest", "length", F.when(F.col("ord") % 2 == 0, F.col("ord")).alias("offset"), F.when(F.col("ord") % 5 == 0, F.array(F.lit("x"), F.lit("nlaweb"))).otherwise(F.array(F.lit("x"))).alias("collections"))
    return joins.complete_offsets(own, third).select("ord", "offset")


@query("""WITH CAPS, t AS (SELECT ts14, url, digest, length, status, min(ord) AS o FROM caps WHERE ord % 3 > 0 GROUP BY ALL)
SELECT c.ord, CASE WHEN t.o IS NOT NULL THEN concat('f', t.o % 9) END AS record_path, t.o AS record_offset, CASE WHEN t.o IS NULL THEN 'no matching index row' END AS record_error FROM caps c LEFT JOIN t ON t.ts14 = c.ts14 AND t.url = c.url AND t.digest = c.digest AND t.length = c.length AND t.status = c.status""")
def record_index_matched(spark, d):
    rows = captures(spark, d)
    index = rows.where("ord % 3 > 0").select("ord", "ts14", "url", "digest", "length", "status", F.concat(F.lit("f"), F.col("ord") % 9).alias("path"), F.col("ord").alias("offset"))
    return joins.match_record_index(rows, index).select("ord", "record_path", "record_offset", "record_error")


@query("""SELECT page_id AS input_id, concat('http://192.0.2.1/', page_id) AS url, true AS exclude_invalid, '2000' AS min_ts, 'lax' AS slash_mode FROM pages
UNION ALL SELECT page_id, concat('http://a.b/', page_id), page_id % 2 = 0, '2005', 'strict' FROM pages""")
def additional_urls(spark, d):
    nothing = F.lit(None).cast("string")
    entry = lambda url, low, mode, out: F.struct(F.concat(F.lit(url), _n()).alias("url"), low.alias("min_ts"), nothing.alias("max_ts"), mode.alias("slash_mode"), out.alias("exclude_invalid"))
    more = F.array(entry("http://192.0.2.1/", nothing, nothing, F.lit(None).cast("boolean")), entry("http://a.b/", F.lit("2005"), F.lit("strict"), F.when(F.col("page_id") % 2 == 0, True)))
    inputs = _table(spark, d, "pages").select(F.col("page_id").alias("input_id"), F.lit("2000").alias("min_ts"), nothing.alias("max_ts"), F.lit("lax").alias("slash_mode"), more.alias("more"))
    return joins.additional_urls(inputs).select("input_id", "url", "exclude_invalid", "min_ts", "slash_mode")


@query("""WITH r AS (SELECT page_id, 'http://www.main.com/a/' || page_id || '?q' AS url, CASE WHEN page_id % 2 = 0 THEN '2001' END AS low, CASE WHEN page_id % 3 = 0 THEN '2009' END AS high FROM pages)
SELECT page_id AS input_id, url, false AS is_mirror, false AS exclude_invalid, low AS min_ts, high AS max_ts FROM r
UNION ALL SELECT page_id, 'http://region1.com/a/' || page_id || '?q', true, true, coalesce(low, '1998'), coalesce(high, NULL) FROM r
UNION ALL SELECT page_id, 'http://192.0.2.9/b/' || page_id || '?q', true, true, low, CASE WHEN high IS NOT NULL THEN '2005' ELSE '2005' END FROM r""")
def mirrors_clamped(spark, d):
    p = F.col("page_id")
    requests = _table(spark, d, "pages").select(p.alias("input_id"), F.concat(F.lit("http://www.main.com/a/"), _n(), F.lit("?q")).alias("url"), F.when(p % 2 == 0, "2001").alias("min_ts"), F.when(p % 3 == 0, "2009").alias("max_ts"))
    mirrors = spark.createDataFrame([("main.com", None, "http://region1.com", "1998", None, True), ("http://main.com", "/a/", "http://192.0.2.9/b", None, "2005", None), ("main.com", "/z", "http://no.com", None, None, None), ("main.com", None, "http://www.main.com", None, None, None)], "host string, path_prefix string, mirror_url string, min_ts string, max_ts string, exclude_invalid boolean")
    fixed = mirrors.withColumn("mirror_url", F.when(F.col("path_prefix") == "/a/", F.lit("http://192.0.2.9/b/")).otherwise(F.col("mirror_url")))
    return joins.clamp_mirrors(requests, fixed.withColumn("path_prefix", F.when(F.col("path_prefix") == "/a/", F.lit("/a")).otherwise(F.col("path_prefix"))))


# Enrichment

_K = "struct<crawlerName:string,crawlerHostname:string,crawlerHostnameSecondary:string,crawlerIpAddress:string>"


def _crawl_rows(spark, d) -> DataFrame:
    k = F.col("ord") % 6
    provider = F.when(k < 3, "p").when(k == 3, "alexa").when(k == 4, "few").otherwise("none")
    name = F.when(k == 0, "C7").when(k == 1, "other").when(k == 3, F.when(F.col("ord") % 12 == 3, "Listed").otherwise("c7"))
    return captures(spark, d).select("ord", "ts14", provider.alias("provider"), name.alias("crawler_name"), F.when(k == 1, "HOST8.org:80").alias("crawler_hostname"))


def _periods(spark) -> DataFrame:
    known = [{"crawlerName": f"c{i}", "crawlerHostname": f"host{i}.org", "crawlerHostnameSecondary": None, "crawlerIpAddress": f"192.0.2.{i}"} for i in range(10)]
    rows = [("p", "20240101000000", "20240115235959", None, known, 0), ("p", "20240110000000", "20240120235959", "10.0.0.0/8", None, 1), ("p", "20240120000000", "20240131235959", None, known[:7], 2), ("few", "20240101000000", "20240131235959", None, known[:3], 3), ("alexa", "20240101000000", "20240131235959", None, known, 4)]
    return spark.createDataFrame(rows, f"key string, `from` string, `to` string, crawlerIpRange string, knownCrawlers array<{_K}>, ord long")


def _overrides(spark) -> DataFrame:
    rows = [("listed", "20240101000000", "20240110235959", "over.org", None, "HTTP/1.0", [["User-Agent", "over"], ["Host"]], 0), ("listed", "20240105000000", "20240108235959", None, "192.0.2.77", None, None, 1)]
    return spark.createDataFrame(rows, "key string, `from` string, `to` string, crawlerHostname string, crawlerIpAddress string, protocol string, headers array<array<string>>, ord long")


@query("""WITH CAPS, k AS (SELECT ord, ts14, ord % 6 AS k, CASE WHEN ts14 <= '20240115235959' THEN 1 WHEN ts14 <= '20240120235959' THEN 2 ELSE 3 END AS period FROM caps)
SELECT ord, CASE WHEN k = 0 AND period = 1 THEN 'c7' WHEN k = 1 AND period = 1 THEN 'c8' WHEN k = 3 AND ord % 12 = 9 THEN 'c7' END AS name,
CASE WHEN k = 0 AND period = 1 THEN 'host7.org' WHEN k = 1 AND period = 1 THEN 'host8.org' WHEN k = 3 AND ord % 12 = 3 AND ts14 <= '20240110235959' THEN 'over.org' WHEN k = 3 AND ord % 12 = 9 THEN 'host7.org' END AS hostname,
CASE WHEN k = 0 AND period = 1 THEN '192.0.2.7' WHEN k = 1 AND period = 1 THEN '192.0.2.8' WHEN k = 3 AND ord % 12 = 9 THEN '192.0.2.7' END AS ip_address, CASE WHEN k < 3 AND period = 2 THEN '10.0.0.0/8' END AS ip_range, CASE WHEN k = 4 THEN 3 END AS known FROM k""")
def crawler_info(spark, d):
    out = enrichment.crawler_info(_crawl_rows(spark, d), _periods(spark), _overrides(spark))
    i = F.col("crawler_info")
    return out.select("ord", *(i[c].alias(c) for c in ("name", "hostname", "ip_address", "ip_range")), F.when(F.size(i["known"]) > 0, F.size(i["known"])).alias("known"))


@query("""WITH CAPS, k AS (SELECT ord, ts14, ord % 6 AS k, url FROM caps)
SELECT ord, CASE k WHEN 0 THEN 'HTTP/1.1' WHEN 1 THEN CASE WHEN ts14 <= '20240110235959' THEN 'HTTP/1.0' END WHEN 2 THEN CASE WHEN ts14 <= '20240115235959' THEN 'HTTP/1.2' ELSE NULL END END AS request_protocol,
CASE k WHEN 0 THEN concat('User-Agent=own', CASE WHEN ord % 12 = 0 THEN '' ELSE '?' END, '|Host=h', ord, '.org:81|Referer=http://r/', ord, CASE WHEN ord % 12 = 0 THEN '|From=me' ELSE '' END)
 WHEN 1 THEN CASE WHEN ts14 <= '20240110235959' THEN concat('User-Agent=over|Host=h', ord, '.org') END
 WHEN 2 THEN CASE WHEN ts14 <= '20240115235959' THEN concat('Accept=*/*|Host=h', ord, '.org:81') END
 WHEN 4 THEN 'User-Agent=own' END AS headers FROM k""")
def request_headers(spark, d):
    """A provider's period, an override, the rule of an identifier, a WARC file, a crawl that only its archive describes, and none."""
    k, o = F.col("ord") % 6, F.col("ord").cast("string")
    described = F.when((F.col("ord") % 12 == 0) | (k == 4), F.filter(F.array(F.struct(F.lit("http-header-user-agent").alias("name"), F.lit("own").alias("value")), F.when(k == 0, F.struct(F.lit("http-header-from").alias("name"), F.lit("me").alias("value")))), lambda h: h.isNotNull()))
    rows = captures(spark, d).select(
        "ord", "ts14", F.concat(F.lit("http://h"), o, F.lit(".org:81/x")).alias("url"), F.when(k == 3, "warc").otherwise("arc").alias("record_format"), F.when(k.isin(0, 3), "p").when(k == 1, "alexa").when(k == 2, "internetarchive").otherwise("q").alias("provider"),
        F.when(k == 1, "LISTED").alias("crawler_name"), F.when(k == 2, "wide-07").alias("crawl_identifier"), described.alias("description"), F.concat(F.lit("http://r/"), o).alias("referer"),
    )
    periods = spark.createDataFrame([("p", "20240101000000", "20240131235959", "HTTP/1.1", [["User-Agent", "own", "?"], ["Host"], ["Referer"], ["Nothing"]], 0)], "key string, `from` string, `to` string, protocol string, headers array<array<string>>, ord long")
    principals = spark.createDataFrame([("WI", "2000", "2030", "HTTP/9", [["x", "y"]], 0), ("WIDE", "20240101000000", "20240115235959", "HTTP/1.2", [["Accept", "*/*"], ["Host"]], 1), ("wide-07", "2000", "2030", "HTTP/8", [["x", "y"]], 2)], "key string, `from` string, `to` string, protocol string, headers array<array<string>>, ord long")
    out = enrichment.request_headers(rows, periods, _overrides(spark), principals)
    return out.select("ord", "request_protocol", F.array_join(F.transform("request_headers", lambda h: F.concat(h["name"], F.lit("="), h["value"], F.when(h["unconfirmed"], "?").otherwise(""))), "|").alias("headers"))


@query("""SELECT page_id, CASE page_id % 4 WHEN 0 THEN 'crawler 1' WHEN 1 THEN 'old' END AS crawler, CASE page_id % 4 WHEN 0 THEN 'pub' END AS publisher, CASE page_id % 4 WHEN 0 THEN 'obey' WHEN 1 THEN 'classic' END AS robots, page_id % 4 > 1 AS nothing FROM pages""")
def crawl_descriptions(spark, d):
    k = F.col("page_id") % 4
    info = "WARC-Filename: x\r\nsoftware: crawler 1\r\npublisher: pub\r\nrobots: obey\r\n\r\nsoftware: no\r\n"
    xml = "<arcmetadata><arc:software>old</arc:software><publisher>no</publisher><arc:robots>classic</arc:robots></arcmetadata>"
    rows = _table(spark, d, "pages").select("page_id", F.when(k == 0, "warc-info").when(k == 3, "warc").otherwise("arc-header").alias("kind"), F.when(k == 0, info).when(k == 1, xml).otherwise("x").cast("binary").alias("content"))
    i = enrichment.crawl_info(F.col("kind"), F.col("content"))
    return rows.select("page_id", i["crawler"].alias("crawler"), i["publisher"].alias("publisher"), i["robots"].alias("robots"), i.isNull().alias("nothing"))


@query("""WITH CAPS SELECT ord, concat('CRAWL-', ord) AS crawl_identifier, 'accelovation' AS crawl_provider, 'c7' AS crawler_name, 'c7.accelovation.com' AS crawler_hostname, CASE WHEN ts14 <= '20240115235959' THEN '192.0.2.7' END AS crawler_ip_address, '00001' AS file_serial_number FROM caps WHERE ord % 2 = 0
UNION ALL SELECT ord, NULL, NULL, NULL, NULL, NULL, NULL FROM caps WHERE ord % 2 = 1""")
def archive_file_infos(spark, d):
    """The file's own crawler name and host win; its provider's period adds the address."""
    rows = captures(spark, d).select("ord", "ts14", F.when(F.col("ord") % 2 == 0, F.concat(F.lit("CRAWL-"), "ord", F.lit("-20240101000000-00001-c7.accelovation.com.arc.gz"))).otherwise("notes.txt").alias("filename"))
    read = rows.withColumn("archive_file", archive_name(F.col("filename"), F.col("ts14"), ("generic",)))
    a = F.col("archive_file.details")
    periods = _periods(spark).where("key = 'p' and ord = 0").withColumn("key", F.lit("accelovation"))
    out = enrichment.crawler_info(read.select("*", a["crawl_provider"].alias("provider"), a["crawler_name"].alias("crawler_name"), a["crawler_hostname"].alias("crawler_hostname")), periods)
    i = enrichment.archive_file_info(F.col("archive_file"), F.col("crawler_info"))
    return out.withColumn("i", i).select("ord", *(F.col(f"i.{c}").alias(c) for c in ("crawl_identifier", "crawl_provider", "crawler_name", "crawler_hostname", "crawler_ip_address", "file_serial_number")))


_IMAGE = '<layer visibility="hide"><div style="display:none"><img src="http://c.x/t.gif?source=Eu&URI={uri}{r}&p=Games_X"'


@query("""SELECT page_id, CASE page_id % 5 WHEN 0 THEN concat('http://r.org/', page_id, '?a=1&b') WHEN 1 THEN concat('/deep/', page_id) WHEN 2 THEN NULL WHEN 3 THEN 'http://same' END AS referer, CASE page_id % 5 WHEN 4 THEN 'several referrers: http://one, http://two' END AS referer_error FROM pages""")
def tracking_referers(spark, d):
    k = F.col("page_id") % 5
    deep = F.concat(F.lit("%2Flibrary%2Ftoolbar%2F3%2E0%2Fasp%2Easpx%3Fh%3Da%26r%3D%2Fdeep%2F"), _n())
    one = lambda uri, r: F.concat(F.lit(_IMAGE.split("{uri}")[0]), uri, r, F.lit(_IMAGE.split("{r}")[1]))
    two = lambda r: F.lit(f'<layer visibility="hide"><div style="display:none"><img alt="" width="0" height="0" border="0" hspace="0" vspace="0" src="http://c.x/t.gif?x=1&amp;r={r}">')
    plain = F.lit("%2Fx%2Easp")
    text = F.when(k == 0, one(plain, F.concat(F.lit("&r=http%3A%2F%2Fr%2Eorg%2F"), _n(), F.lit("%3Fa%3D1%26b")))).when(k == 1, one(deep, F.lit(""))).when(k == 2, one(plain, F.lit(""))).when(k == 3, F.concat(one(plain, F.lit("&r=http%3A%2F%2Fsame")), two("http%3A%2F%2Fsame"))).otherwise(F.concat(one(plain, F.lit("&r=http%3A%2F%2Fone")), two("http%3A%2F%2Ftwo")))
    rows = _table(spark, d, "pages").select("page_id", F.lit("text/html").alias("mime"), text.cast("binary").alias("content"))
    return enrichment.with_referer(rows).select("page_id", "referer", "referer_error")


@query("""WITH CAPS SELECT ord, 'crawler 1' AS crawler, 'c7' AS crawler_name, CASE WHEN ts14 <= '20240115235959' THEN '192.0.2.7' END AS crawler_ip_address, concat('User-Agent=own?|Host=h', ord, '.org|Referer=http://r/', ord) AS request_headers, ord AS archive_size, concat(strftime(strptime(ts14, '%Y%m%d%H%M%S'), '%Y-%m-%dT%H:%M:%S'), '.000000000Z') AS modified FROM caps""")
def captures_enriched(spark, d):
    """The whole chain: exact time, crawl and file by name, crawler, request headers with a referrer from the page, the file's statistics."""
    o = F.col("ord").cast("string")
    seconds = F.unix_timestamp(F.to_timestamp("ts14", "yyyyMMddHHmmss")).cast("long")
    page = F.concat(F.lit(_IMAGE.split("{uri}")[0]), F.lit("%2Fx&r=http%3A%2F%2Fr%2F"), o, F.lit('&p=x"'))
    rows = captures(spark, d).select(
        "ord", "ts14", F.concat(F.lit("http://h"), o, F.lit(".org/x")).alias("url"), F.concat(F.lit("item/CRAWL-"), o, F.lit("-20240101000000-00001-c7.accelovation.com.arc.gz")).alias("filename"), scalars.iis_etag(seconds, F.lit(0), F.lit(5)).alias("etag"),
        (seconds + 5).alias("capture_seconds"), seconds.alias("modified_seconds"), F.lit("Microsoft-IIS/5.0").alias("server"), F.lit("arc-header").alias("record_kind"), F.lit("<arcmetadata><arc:software>crawler 1</arc:software></arcmetadata>").cast("binary").alias("record_content"), F.lit("text/html").alias("mime"), page.cast("binary").alias("content"),
    )
    periods = _periods(spark).where("key = 'p' and ord = 0").withColumn("key", F.lit("accelovation"))
    headers = spark.createDataFrame([("accelovation", "20240101000000", "20240131235959", "HTTP/1.1", [["User-Agent", "own", "?"], ["Host"], ["Referer"]], 0)], "key string, `from` string, `to` string, protocol string, headers array<array<string>>, ord long")
    statistics = captures(spark, d).select(F.lit("item").alias("item"), F.concat(F.lit("CRAWL-"), o, F.lit("-20240101000000-00001-c7.accelovation.com.arc.gz")).alias("file"), F.col("ord").alias("size"), F.lit("m").alias("md5"), F.lit(None).cast("timestamp").alias("modified"))
    out = enrichment.enrich(rows, periods, headers, _overrides(spark), headers.where("false"), statistics, ("generic", "playback"))
    own = F.concat(F.date_format(F.timestamp_seconds("modified_seconds"), "yyyy-MM-dd'T'HH:mm:ss"), F.lit(".000000000Z"))
    shown = F.array_join(F.transform("request_headers", lambda h: F.concat(h["name"], F.lit("="), h["value"], F.when(h["unconfirmed"], "?").otherwise(""))), "|")
    held = (F.col("modified_precise") == own) | F.array_contains("modified_candidates", own)
    return out.select("ord", F.col("crawl_info.crawler").alias("crawler"), F.col("archive_file_info.crawler_name").alias("crawler_name"), F.col("archive_file_info.crawler_ip_address").alias("crawler_ip_address"), shown.alias("request_headers"), "archive_size", F.when(held, own).alias("modified"))


# Look-ups

_ODD = "CASE WHEN ord % 9 = 0 THEN '20241301000000' ELSE ts14 END"


def _index(spark, d) -> DataFrame:
    o = F.col("ord")
    return captures(spark, d).select("ord", F.col("url").alias("request_url"), F.when(o % 9 == 0, "20241301000000").otherwise(F.col("ts14")).alias("ts14"), F.when(o % 5 == 0, "warc/revisit").otherwise("text/html").alias("mime"), (o % 4 == 0).alias("unavailable"))


@query("WITH CAPS SELECT ord FROM caps WHERE ord % 5 > 0 AND (ord % 9 > 0 OR ord % 4 = 0)")
def index_readable(spark, d):
    return lookup.split_readable(_index(spark, d))[0].select("ord")


@query(f"""WITH CAPS, r AS (SELECT url AS request_url, string_agg(CASE WHEN ord % 5 = 0 THEN {_ODD} END, ',' ORDER BY {_ODD}) AS unresolvable_revisits, string_agg(CASE WHEN ord % 5 > 0 AND ord % 9 = 0 AND ord % 4 > 0 THEN '20241301000000' END, ',') AS invalid_timestamps FROM caps GROUP BY url)
SELECT * FROM r WHERE unresolvable_revisits IS NOT NULL OR invalid_timestamps IS NOT NULL""")
def index_filter_report(spark, d):
    report = lookup.split_readable(_index(spark, d))[1]
    return report.select("request_url", F.array_join("unresolvable_revisits", ",").alias("unresolvable_revisits"), F.array_join("invalid_timestamps", ",").alias("invalid_timestamps"))


@query("WITH CAPS, b AS (SELECT page_id % 2 = 0 AS same, regexp_replace(url, '[?#].*$', '') AS bare FROM caps) SELECT concat(bare, CASE WHEN same THEN '' ELSE '/more' END) AS request_url, count(*) FILTER (NOT same) AS rejected FROM b GROUP BY 1")
def slash_filtered(spark, d):
    bare = F.regexp_replace("url", "[?#].*$", "")
    rows = captures(spark, d).select(bare.alias("url"), F.concat(bare, F.when(F.col("page_id") % 2 == 0, "").otherwise("/more")).alias("request_url"), "status")
    return lookup.slash_filter(rows, "strict")[1]


@query("""WITH p AS (SELECT page_id, page_id % 3 = 0 AS mirror, page_id % 2 = 0 AS more FROM pages)
SELECT page_id AS input_id, page_id % 4 = 0 OR page_id % 7 = 0 OR (page_id % 11 = 0 AND (NOT mirror OR more)) AS enabled FROM p""")
def crawl_enabled(spark, d):
    p = F.col("page_id")
    pages = _table(spark, d, "pages")
    inputs = pages.select(p.alias("input_id"), F.when(p % 4 == 0, True).alias("flag"), F.when(p % 7 == 0, F.array(F.lit("c"))).when(p % 7 == 1, F.array().cast("array<string>")).alias("collections"))
    requests = pages.select(p.alias("input_id"), F.concat(F.lit("http://h"), (p % 11).cast("string"), F.lit(".org/x")).alias("url"), (p % 3 == 0).alias("is_mirror"), (p % 2 == 0).alias("is_additional"))
    return lookup.crawl_enabled(inputs, lookup.crawl_queries(requests), spark.createDataFrame([("http://h0.org/",)], "prefix string"))


@query("""WITH CAPS SELECT ord, CASE WHEN ord % 7 = 0 THEN 'skipped' WHEN ord % 5 = 0 THEN 'unavailable' ELSE 'base' END AS state, CASE WHEN ord % 7 > 0 AND ord % 5 > 0 THEN digest END AS sha256, CASE WHEN ord % 7 > 0 AND ord % 5 > 0 THEN length END AS content_size FROM caps""")
def states_split(spark, d):
    o = F.col("ord")
    rows = captures(spark, d).select("ord", (o % 5 == 0).alias("unavailable"), F.when(o % 7 == 0, True).alias("skipped"), F.col("digest").alias("sha256"), F.col("length").alias("content_size"), F.array(F.lit("h")).alias("headers"))
    return lookup.split_states(rows).select("ord", "state", "sha256", "content_size")


@query("WITH CAPS SELECT ord, CASE WHEN ord % 4 = 0 THEN status = 404 ELSE status BETWEEN 200 AND 299 END AS is_valid FROM caps WHERE ord % 3 > 0 OR CASE WHEN ord % 4 = 0 THEN status = 404 ELSE status BETWEEN 200 AND 299 END")
def valid_by_request(spark, d):
    rows = captures(spark, d).withColumn("exclude_invalid", F.col("ord") % 3 == 0)
    return lookup.split_valid(rows.where("ord % 4 = 0"), (404,)).unionByName(lookup.split_valid(rows.where("ord % 4 > 0"))).select("ord", "is_valid")


@query("""SELECT page_id, CASE page_id % 4 WHEN 0 THEN true WHEN 1 THEN false WHEN 2 THEN true ELSE false END AS is_covered FROM pages""")
def cache_covered_exactly(spark, d):
    k = F.col("page_id") % 4
    queries = _table(spark, d, "pages").select("page_id", F.when(k == 3, "http://z/").otherwise("http://a.org/x").alias("url"), F.when(k == 0, "2005").alias("min_ts"), F.when(k == 2, "1999").alias("max_ts"))
    coverage = spark.createDataFrame([("http://a.org/", "2000", None), ("http://a.org/x", None, "2000")], "prefix string, min_ts string, max_ts string")
    return lookup.covered_exactly(queries, coverage).select("page_id", "is_covered")


@query("""WITH CAPS, s AS (SELECT *, ts14 BETWEEN '20240103000000' AND '20240120235959' AS inside, page_id % 2 = 0 AS mirror FROM caps),
i AS (SELECT *, substr(ts14, 1, 8) AS d, count(*) OVER (PARTITION BY url, substr(ts14, 1, 8)) AS n FROM s WHERE inside AND status = 200), t(target, mirror) AS (VALUES (360.0, false), (1080.0, false), (720.0, true)),
x AS (SELECT ord, row_number() OVER (PARTITION BY url, d, target ORDER BY abs(CAST(substr(ts14, 9, 2) AS INT) * 60 + CAST(substr(ts14, 11, 2) AS INT) - target), ts14, ord) AS rn FROM i JOIN t USING (mirror) WHERE n > CASE WHEN mirror THEN 1 ELSE 2 END),
k AS (SELECT url, ts14, ord FROM s WHERE NOT inside UNION ALL SELECT url, ts14, ord FROM i WHERE n <= CASE WHEN mirror THEN 1 ELSE 2 END UNION ALL SELECT url, ts14, ord FROM s WHERE ord IN (SELECT ord FROM x WHERE rn = 1))
SELECT min(ord) AS ord FROM k GROUP BY url, ts14""")
def limited_mirror_captures(spark, d):
    rows = captures(spark, d).withColumn("request_url", F.col("url")).withColumn("input_id", F.lit("all")).withColumn("is_mirror", F.col("page_id") % 2 == 0)
    ranges = spark.createDataFrame([("all", "20240103000000", "20240110235959"), ("all", "20240109000000", "20240120235959")], "input_id string, start_ts string, end_ts string")
    return sampling.limit_captures(rows, ranges, 2, 1).select("ord")


@query("""WITH CAPS SELECT ord, CASE WHEN ord % 3 = 0 THEN ts14 WHEN ts14 < '20240115000000' THEN ts14 ELSE '20240115000000' END AS earliest, CASE WHEN ord % 3 = 0 THEN ts14 WHEN ts14 > '20240115000000' THEN ts14 ELSE '20240115000000' END AS latest, CASE WHEN ord % 4 > 0 THEN length END AS number,
concat(strftime(make_timestamp(ord * 1001000), '%Y-%m-%dT%H:%M:%S.%g'), '000000Z') AS precise FROM caps""")
def stamps_and_numbers(spark, d):
    o = F.col("ord")
    other = F.when(o % 3 > 0, "20240115000000").otherwise("")
    return captures(spark, d).select("ord", scalars.earliest(F.col("ts14"), other, F.lit(None).cast("string")).alias("earliest"), scalars.latest(F.col("ts14"), other).alias("latest"), scalars.lenient_int(F.when(o % 4 > 0, F.col("length").cast("string")).otherwise("-")).alias("number"), dates.precise_stamp((o * 1001).cast("long")).alias("precise"))


# Versions and summaries


@query("""WITH CAPS, v AS (SELECT *, max(last_modified14 IS NOT NULL) OVER (PARTITION BY source, digest) AS dated FROM caps), k AS (SELECT * FROM v WHERE last_modified14 IS NOT NULL OR NOT dated)
SELECT source AS input_id, digest AS sha256, last_modified14 AS modified14, min((ts14, ord))[2] AS ord FROM k GROUP BY ALL""")
def output_versions(spark, d):
    rows = captures(spark, d).select(F.col("source").alias("input_id"), F.col("digest").alias("sha256"), F.col("last_modified14").alias("modified14"), "ts14", "ord")
    return versions.output_versions(rows).select("input_id", "sha256", "modified14", "ord")


_SHORT = [{"name": "bottomframe", "output_name": "btm", "pattern": r"/(\w+)/(\w+)[.]htm", "groups": [1, 2], "required": True}, {"name": "drop", "output_name": None}, {"name": "fix", "output_value": "F"}, {"name": "soft", "pattern": "z(.)", "groups": [1]}]


@query("""SELECT page_id, CASE page_id % 4 WHEN 0 THEN concat('~hbtm=a', page_id, '-b') WHEN 1 THEN concat('~hbtm=a', page_id, '-b&fix=F&soft=q') WHEN 2 THEN '~qdrop=x' ELSE '~qbottomframe=none' END AS text, CASE page_id % 4 WHEN 0 THEN concat('bottomframe=/a', page_id, '/b.htm&drop=x') WHEN 1 THEN concat('bottomframe=/a', page_id, '/b.htm&fix=1&soft=zq') WHEN 2 THEN 'drop=x' ELSE 'bottomframe=none' END AS original FROM pages""")
def params_shortened(spark, d):
    k = F.col("page_id") % 4
    frame = F.concat(F.lit("/a"), _n(), F.lit("/b.htm"))
    params = F.when(k == 0, F.create_map(F.lit("drop"), F.lit("x"), F.lit("bottomframe"), frame, F.lit("empty"), F.lit(""))).when(k == 1, F.create_map(F.lit("bottomframe"), frame, F.lit("fix"), F.lit("1"), F.lit("soft"), F.lit("zq"))).when(k == 2, F.create_map(F.lit("drop"), F.lit("x"))).otherwise(F.create_map(F.lit("bottomframe"), F.lit("none")))
    return _table(spark, d, "pages").select("page_id", versions.params_text(params, _SHORT).alias("text"), versions.original_query(params, _SHORT).alias("original"))


@query("""SELECT page_id AS input_id, CASE page_id % 4 WHEN 0 THEN concat('n', page_id) WHEN 1 THEN 'given.tar' WHEN 2 THEN '_unnamed' ELSE 'plain' END AS base, CASE page_id % 4 WHEN 0 THEN '.htm' WHEN 1 THEN '.gz' WHEN 2 THEN '.html' ELSE '' END AS ext, CASE page_id % 4 WHEN 0 THEN 'a.org/dir' WHEN 1 THEN 'a.org/.' WHEN 2 THEN 'a.org/dir/sub' ELSE 'a.org/.' END AS folder FROM pages""")
def input_names(spark, d):
    p, k = F.col("page_id"), F.col("page_id") % 4
    pages = _table(spark, d, "pages")
    url = F.when(k == 0, F.concat(F.lit("http://A.org/dir/n"), _n(), F.lit(".htm"))).when(k == 1, "http://a.org/").when(k == 2, "http://a.org/dir/sub/").otherwise("http://a.org/plain")
    given = F.when(k == 1, "given.tar.gz")
    own = pages.select(p.alias("input_id"), F.lit(1).alias("at"), url.alias("url"), F.lit(False).alias("is_mirror"), given.alias("filename"))
    mirror = pages.select(p.alias("input_id"), F.lit(0).alias("at"), F.lit("http://m.org/other.htm").alias("url"), F.lit(True).alias("is_mirror"), given.alias("filename"))
    return versions.names_of_urls(own.unionByName(mirror))


@query("""WITH CAPS, k AS (SELECT ord, ts14, last_modified14 AS m, ord % 4 AS k FROM caps), s AS (SELECT *, CASE WHEN k = 0 THEN ts14 ELSE coalesce(m, ts14) END AS stamp FROM k)
SELECT ord, CASE WHEN k < 3 THEN concat('f~~~q', '~qa=1', '.', substr(stamp, 1, 8), '-', substr(stamp, 9, 6), CASE WHEN k = 2 THEN '_2' WHEN k = 0 THEN '_1' ELSE '' END, CASE WHEN k = 0 THEN '.invalid' ELSE '' END, '.html') END AS output_name, CASE WHEN k = 0 THEN 'archival' ELSE 'main' END AS folder_kind, coalesce(m, ts14) AS modified, CASE WHEN k = 3 THEN 'no place among versions' END AS name_error FROM s""")
def version_files(spark, d):
    k = F.col("ord") % 4
    params = versions.params_text(F.create_map(F.lit("a"), F.lit("1")))
    rows = captures(spark, d).select("ord", "ts14", F.col("last_modified14").alias("modified14"), F.when(k == 0, "not_found").otherwise("ok").alias("type"), F.lit(None).cast("string").alias("flag"), F.lit(1).alias("capture_index"), F.when(k == 1, 0).when(k == 2, 2).alias("content_index"), F.lit("f~?").alias("base"), F.lit(".html").alias("ext"), params.alias("params_text"))
    return versions.version_files(rows).select("ord", "output_name", "folder_kind", "modified", "name_error")


@query("""WITH CAPS SELECT concat(substr(ts14, 1, 4), '-', substr(ts14, 5, 2), '-', substr(ts14, 7, 2), 'T', substr(ts14, 9, 2), ':', substr(ts14, 11, 2), ':', substr(ts14, 13, 2), 'Z') AS capture_ts, CASE WHEN last_modified14 IS NULL THEN '' ELSE concat(substr(last_modified14, 1, 4), '-', substr(last_modified14, 5, 2), '-', substr(last_modified14, 7, 2), 'T00:00:00Z') END AS modification_ts,
CASE WHEN ord % 2 = 0 THEN 'o' ELSE digest END AS capture_sha256, status AS statuscode, CASE ord % 3 WHEN 0 THEN 'capture_ts|url' WHEN 1 THEN '' ELSE '' END AS corrections, CASE WHEN ord % 2 = 0 THEN 'a|b' END AS additional_providers, ord % 2 = 0 AS record_available, ord AS record_offset FROM caps""")
def summary_rows(spark, d):
    o = F.col("ord")
    correction = lambda *names: F.array(*(F.struct(F.lit(n).alias("field")) for n in names))
    rows = captures(spark, d).select(
        "ts14", F.col("last_modified14").alias("modified14"), F.lit(None).cast("int").alias("capture_index"), F.lit(0).alias("content_index"), F.when(o % 2 == 0, "o").alias("original_sha256"), F.col("digest").alias("sha256"), "url", "status",
        F.when(o % 3 == 0, correction("url", "captureTime", "mementoTime")).when(o % 3 == 1, correction("mementoTime")).alias("corrections"), F.lit("ok").alias("type"), F.lit("text/html").alias("mime"), "source", F.when(o % 2 == 0, F.array(F.lit("b"), F.lit("a"))).alias("additional_sources"), "digest",
        F.lit("d").alias("actual_digest"), F.lit("f").alias("filename"), F.when(o % 2 == 0, F.array(F.lit("warc-info"), F.lit("warc"))).otherwise(F.array(F.lit("warc-info"))).alias("record_kinds"), o.alias("offset"), "length",
    )
    return versions.summary_rows(rows).select("capture_ts", "modification_ts", "capture_sha256", "statuscode", "corrections", "additional_providers", "record_available", "record_offset")


@query("""WITH CAPS, o AS (SELECT concat('p', page_id) AS path, ts14 AS capture_ts, ord AS capture_index, 'old' AS run FROM caps WHERE ord % 2 = 0), n AS (SELECT concat('p', page_id) AS path, ts14 AS capture_ts, ord AS capture_index, 'new' AS run FROM caps WHERE ord % 3 = 0 AND page_id % 2 = 0)
SELECT *, row_number() OVER (ORDER BY path, capture_ts, capture_index) AS place FROM (SELECT * FROM o WHERE path NOT IN (SELECT path FROM n) UNION ALL SELECT * FROM n)""")
def summary_upserted(spark, d):
    rows = captures(spark, d).select(F.concat(F.lit("p"), "page_id").alias("path"), F.col("ts14").alias("capture_ts"), F.col("ord").alias("capture_index"), "page_id", "ord")
    columns = ("path", "capture_ts", "capture_index", "run")
    old, new = rows.where("ord % 2 = 0").withColumn("run", F.lit("old")).select(*columns), rows.where("ord % 3 = 0 and page_id % 2 = 0").withColumn("run", F.lit("new")).select(*columns)
    folder = new_folder(spark, "summary") + "/rows"
    versions.write_summary(old, folder)
    return ordinals(versions.write_summary(new, folder), "path", "capture_ts", "capture_index")


_STATES = "s AS (SELECT page_id, source, CASE WHEN ord % 7 = 0 THEN 'skipped' WHEN ord % 5 = 0 THEN 'unavailable' ELSE 'base' END AS state, status FROM caps)"
_NUMBERS = "count(*) AS total, count(*) FILTER (state = 'base' AND status = 200) AS valid, count(*) FILTER (state = 'base' AND status <> 200) AS invalid, count(*) FILTER (state = 'unavailable') AS unavailable, count(*) FILTER (state = 'skipped') AS skipped"


def _states_of(spark, d) -> DataFrame:
    o = F.col("ord")
    state = F.when(o % 7 == 0, "skipped").when(o % 5 == 0, "unavailable").otherwise("base")
    return captures(spark, d).select(F.col("page_id").alias("input_id"), "source", state.alias("state"), F.when(F.col("status") == 200, "ok").otherwise("redirect").alias("type"))


@query(f"WITH CAPS, {_STATES} SELECT page_id AS input_id, source, {_NUMBERS} FROM s GROUP BY GROUPING SETS ((page_id), (page_id, source))")
def capture_counts_by_state(spark, d):
    return versions.capture_counts(_states_of(spark, d))


@query(f"""WITH CAPS, {_STATES}, n AS (SELECT page_id, source, {_NUMBERS} FROM s GROUP BY GROUPING SETS ((page_id), (page_id, source))),
j AS (SELECT page_id, source, concat('{{"total":', total, ',"valid":', valid, ',"invalid":', invalid, ',"unavailable":', unavailable, ',"skipped":', skipped, '}}') AS j FROM n)
SELECT page_id AS input_id, concat('{{', CASE WHEN page_id % 2 = 0 THEN '"min_ts":"2000",' ELSE '' END, '"captures":', max(j) FILTER (source IS NULL), ',"sources":{{', string_agg(concat('"', source, '":', j), ',' ORDER BY source) FILTER (source IS NOT NULL), '}},"filtered":{{"duplicates":', page_id, '}}}}') AS document FROM j GROUP BY page_id""")
def input_documents(spark, d):
    counts = versions.capture_counts(_states_of(spark, d))
    inputs = counts.select("input_id").distinct()
    bounds = inputs.select("input_id", F.when(F.col("input_id") % 2 == 0, "2000").alias("min_ts"), F.lit(None).cast("string").alias("max_ts"))
    return versions.input_documents(counts, bounds, inputs.select("input_id", F.col("input_id").alias("duplicates"), F.lit(None).cast("long").alias("slashes")))


@query("""SELECT page_id AS ord, CASE page_id % 4 WHEN 0 THEN 'POST' ELSE 'GET' END AS method, CASE page_id % 4 WHEN 0 THEN 'HTTP/1.1' WHEN 1 THEN 'HTTP/1.0' END AS protocol, CASE page_id % 4 WHEN 0 THEN 'own' WHEN 2 THEN 'derived' END AS header, page_id % 4 IN (1, 2) AS partial FROM pages""")
def requests_told(spark, d):
    p, k = F.col("page_id"), F.col("page_id") % 4
    pages = _table(spark, d, "pages")
    headers = lambda name: F.array(F.struct(F.lit(name).alias("name"), F.lit("v").alias("value")))
    rows = pages.select(p.alias("ord"), F.when(k.isin(0, 2), headers("derived")).alias("derived_headers"), F.when(k.isin(0, 1), "HTTP/1.0").alias("derived_protocol"))
    told = pages.where("page_id % 4 = 0").select(p.alias("ord"), F.lit("POST").alias("method"), F.lit("HTTP/1.1").alias("protocol"), headers("own").alias("headers"))
    r = F.col("request")
    return versions.request_of(rows, told).select("ord", r["method"].alias("method"), r["protocol"].alias("protocol"), F.get(r["headers"], F.lit(0))["name"].alias("header"), r["partial"].alias("partial"))


@query("""WITH CAPS SELECT concat('2013', substr(ts14, 5)) AS capture_ts, concat('FOCUS-20130405060708-crawl512/FOCUS-', concat('2013', substr(ts14, 5)), '-', lpad(CAST(ord AS VARCHAR), 5, '0'), '.warc.gz') AS archive_filename, 'FOCUS' AS crawl_id, 'wayback-2012' AS type, 'internetarchive' AS provider, CAST(1 AS DOUBLE) AS confidence FROM caps""")
def name_report(spark, d):
    stamp = F.concat(F.lit("2013"), F.substring("ts14", 5, 10))
    rows = captures(spark, d).select(stamp.alias("capture_ts"), "url", F.concat(F.lit("FOCUS-20130405060708-crawl512/FOCUS-"), stamp, F.lit("-"), F.lpad(F.col("ord").cast("string"), 5, "0"), F.lit(".warc.gz")).alias("archive_filename"))
    return archive_files.name_report(rows).drop("url")


# Stages


@query("""WITH p AS (SELECT page_id FROM pages)
SELECT page_id, CASE WHEN v IS NULL THEN concat('id=', page_id, ' x') ELSE concat('id[', page_id, ':', v, '] x') END AS content, coalesce('n=' || v, '') AS param_key FROM p, (VALUES ('1'), ('2'), ('3'), ('z'), (NULL)) t(v) WHERE page_id % 2 = 0 UNION ALL SELECT page_id, concat('none ', page_id), '' FROM p WHERE page_id % 2 = 1""")
def stage_templates(spark, d):
    p = F.col("page_id")
    text = F.when(p % 2 == 0, F.concat(F.lit("id="), _n(), F.lit(" x"))).otherwise(F.concat(F.lit("none "), _n()))
    sources = _table(spark, d, "pages").select(F.sha2(text, 256).alias("sha"), text.alias("content"))
    contents, _ = transforms.run_stages(sources, transforms.stages_of([{"type": "template", "name": "n", "pattern": r"id=(\d+)", "template": "id[$1:{value}]", "values": [(1, 3), "z", None]}]))
    return contents.select(F.regexp_extract("content", r"(\d+)", 1).cast("long").alias("page_id"), "content", "param_key")


_FOOT = "function footerjs(doc) "


@query("""SELECT page_id, CASE page_id % 4 WHEN 0 THEN concat('http://c.x/t.gif?source=www&URI=%2fgames%2f', page_id, '.asp&p=games_x') WHEN 1 THEN 'http://c.x/t.gif?source=localhost&URI=%2flibrary%2ftoolbar%2f3.0%2fasp.aspx%3fh%3dwww%252Emicrosoft%252Ecom%26r%3d%26u%3dX&p=library_toolbar_3.0' WHEN 2 THEN concat('http://c.x/t.gif?source=www&URI=%2fgames%2fdefault.aspx&q=', page_id) ELSE concat('http://c.x/t.gif?source=Eu&URI=%2FGames&r=', page_id) END AS image FROM pages""")
def stage_tracking(spark, d):
    k = F.col("page_id") % 4
    head, tail = F.lit('<layer visibility="hide"><div style="display:none"><img src="'), F.lit('">')
    url = F.when(k == 0, F.concat(F.lit("http://c.x/t.gif?source=Eu&URI=%2FGames%2F"), _n(), F.lit("%2Easp&p=Games_X&r=http%3A%2F%2Fr"))).when(k == 1, F.lit("http://c.x/t.gif?source=localhost&URI=%2Flibrary%2Ftoolbar%2F3%2E0%2Fasp%2Easpx%3Fh%3Da%2Eb%26r%3D%2Fz%26u%3DX&p=library_toolbar_3.0")).when(k == 2, F.concat(F.lit("http://c.x/t.gif?source=Us&URI=%2FGames%2F%3Fa%3D1&q="), _n())).otherwise(F.concat(F.lit("http://c.x/t.gif?source=Eu&URI=%2FGames&r="), _n()))
    rows = _table(spark, d, "pages").select("page_id", F.concat(F.when(k == 3, "").otherwise(_FOOT), head, url, tail).alias("content"), F.expr("cast(map() as map<string, string>)").alias("params"))
    out = transforms.tracking_stage(query="strip", default_path="default.aspx")(rows)
    return out.select("page_id", F.regexp_extract("content", 'src="([^"]*)"', 1).alias("image"))


_LINKED = "x AS (SELECT ord, page_id, status, concat('text ', page_id, CASE WHEN page_id % 2 = 0 THEN ' OLD' ELSE '' END) AS text FROM caps)"


def _linked(spark, d):
    text = F.concat(F.lit("text "), "page_id", F.when(F.col("page_id") % 2 == 0, " OLD").otherwise(""))
    rows = captures(spark, d).select("ord", F.sha2(text, 256).alias("sha"), text.alias("content"), F.col("last_modified14").alias("modified14"), F.when(F.col("status") == 200, "ok").otherwise("other").alias("type"))
    _, links = transforms.run_stages(rows.where("type = 'ok'").select("sha", "content"), [transforms.regex_stage(" OLD$", "")])
    return rows, links


@query(f"WITH CAPS, {_LINKED} SELECT ord FROM x WHERE status <> 200 OR page_id % 2 = 0")
def raw_outputs(spark, d):
    return transforms.raw_outputs(*_linked(spark, d)).select("ord")


@query(f"WITH CAPS, {_LINKED} SELECT x.ord, sha256(replace(text, ' OLD', '')) AS output_sha, CASE WHEN x.page_id % 2 = 0 THEN sha256(text) END AS original_sha, CASE WHEN x.page_id % 2 = 1 THEN last_modified14 END AS modified14 FROM x JOIN caps USING (ord) WHERE text IN (SELECT text FROM x WHERE status = 200)")
def transformed_captures(spark, d):
    rows, links = _linked(spark, d)
    return transforms.transformed_captures(rows, links).select("ord", "output_sha", "original_sha", "modified14")


@query("""WITH CAPS, w AS (SELECT * FROM caps WHERE source = 'wayback'), c AS (SELECT * FROM caps WHERE source <> 'wayback'), x AS (SELECT * FROM w WHERE ord % 2 = 0),
e AS (SELECT ts14, url, status, digest, length, min(ord) AS o FROM c GROUP BY ALL), l AS (SELECT ts14, url, status, length, min(ord) AS o FROM c GROUP BY ALL),
m AS (SELECT x.ord, coalesce(e.o, l.o) AS crawl_ord FROM x LEFT JOIN e ON e.ts14 = x.ts14 AND e.url = x.url AND e.status = x.status AND e.digest = x.digest AND e.length = x.length LEFT JOIN l ON l.ts14 = x.ts14 AND l.url = x.url AND l.status = x.status AND l.length = x.length),
f AS (SELECT crawl_ord, min(ord) AS copy FROM m WHERE crawl_ord IS NOT NULL GROUP BY crawl_ord)
SELECT c.ord, c.source, concat('m', f.copy) AS metadata, CASE WHEN f.copy IS NOT NULL THEN 'wayback' END AS additional, NULL AS error FROM c JOIN f ON f.crawl_ord = c.ord
UNION ALL SELECT c.ord, c.source, NULL, NULL, NULL FROM c WHERE ord NOT IN (SELECT crawl_ord FROM f) UNION ALL SELECT ord, source, concat('m', ord), NULL, NULL FROM w WHERE ord % 2 = 1
UNION ALL SELECT ord, 'wayback', NULL, NULL, 'no matching crawl row' FROM m WHERE crawl_ord IS NULL""")
def captures_merged(spark, d):
    rows = captures(spark, d)
    o = F.col("ord")
    copies = rows.where("source = 'wayback'").withColumns({"item_collections": F.when(o % 2 == 0, F.array(F.lit("commoncrawl"))).otherwise(F.array(F.lit("x"))), "metadata": F.concat(F.lit("m"), o), "memento14": F.col("ts14")})
    merged, errors = joins.merge_captures(copies, rows.where("source <> 'wayback'").withColumn("offset", o))
    out = merged.select("ord", "source", "metadata", F.array_join("additional_sources", "|").alias("additional"), F.lit(None).cast("string").alias("error"))
    return out.unionByName(errors.select("ord", "source", F.lit(None).cast("string").alias("metadata"), F.lit(None).cast("string").alias("additional"), "error"))


@query("""WITH p AS (SELECT page_id, CASE WHEN page_id % 2 = 0 THEN '2001' END AS low FROM pages)
SELECT concat('http://main.com/', page_id % 5) AS prefix, CASE WHEN bool_or(low IS NULL) THEN NULL ELSE min(low) END AS min_ts FROM p GROUP BY page_id % 5 UNION ALL SELECT concat('http://m.org/x', page_id % 5), CASE WHEN bool_or(low IS NULL) THEN '1999' ELSE '2001' END FROM p GROUP BY page_id % 5""")
def prefix_queries_expanded(spark, d):
    p = F.col("page_id")
    queries = _table(spark, d, "pages").select(F.concat(F.lit("http://main.com/"), (p % 5).cast("string")).alias("prefix"), F.when(p % 2 == 0, "2001").alias("min_ts"), F.lit(None).cast("string").alias("max_ts"))
    mirrors = spark.createDataFrame([("www.main.com", "/", "http://m.org/x", "1999", None)], "host string, path_prefix string, mirror_url string, min_ts string, max_ts string")
    return joins.expand_prefixes(queries, mirrors).select("prefix", "min_ts")


@query(f"""WITH CAPS, k AS (SELECT ord, ts14, {_KEY} AS key, lower(url) AS low FROM caps) SELECT ord, row_number() OVER (ORDER BY ts14, key, low, ord) AS place FROM k""")
def captures_ordered(spark, d):
    return ordinals(captures(spark, d), *sampling.order_keys(), "ord").select("ord", "place")


@query("""WITH CAPS, r AS (SELECT url AS request_url, count(*) FILTER (ord % 5 = 0) AS a, count(*) FILTER (ord % 50 = 1) AS b FROM caps GROUP BY url) SELECT request_url, nullif(a, 0) AS revisits, nullif(b, 0) AS duplicates FROM r WHERE a > 0 OR b > 0""")
def filters_reported(spark, d):
    rows = captures(spark, d).withColumn("request_url", F.col("url"))
    one = rows.where("ord % 5 = 0").groupBy("request_url").agg(F.count("*").alias("revisits"))
    two = rows.groupBy("request_url").agg(F.count_if(F.col("ord") % 50 == 1).alias("duplicates"))
    return lookup.filter_report(one, two)


@query("""WITH CAPS SELECT ord, concat('{"request":{"method":"', CASE WHEN ord % 2 = 0 THEN 'POST' ELSE 'GET' END, '"', CASE WHEN ord % 2 = 0 THEN ',"headers":[{"name":"a","value":"b"}]' ELSE '' END, '},"response":{"status":', status, ',"body":{"size":', length, CASE WHEN ord % 4 = 0 THEN ',"compressedSize":1' ELSE '' END, '}},"source":{"type":"', source, '","cdxEntry":{"url":"', CASE ord % 3 WHEN 0 THEN 'revisit' WHEN 1 THEN 'unpatched' ELSE 'own' END, '","status":', status, '}}}') AS document FROM caps""")
def documents_in_full(spark, d):
    o = F.col("ord")
    entry = lambda name: F.struct(F.lit(name).alias("url"), F.col("status"))
    request = F.struct(F.when(o % 2 == 0, "POST").otherwise("GET").alias("method"), F.when(o % 2 == 0, F.array(F.struct(F.lit("a").alias("name"), F.lit("b").alias("value")))).alias("headers"))
    rows = captures(spark, d).select("ord", "status", "length", "source", request.alias("request"), F.when(o % 3 == 0, entry("revisit")).alias("revisit_entry"), F.when(o % 3 < 2, entry("unpatched")).alias("unpatched_entry"), entry("own").alias("entry"), F.when(o % 4 == 0, "gzip").alias("encoding"), F.lit(1).alias("content_length"))
    return versions.capture_documents(rows)


@query("SELECT concat('site', page_id % 7, '/p', page_id, '.html') AS name, CAST(octet_length(encode(html)) AS BIGINT) AS size, sha256(html) AS sha256, true AS listed FROM pages")
def files_written(spark, d):
    """Contents written to files by name, read back from the store and held against what was said to be written."""
    folder = new_folder(spark, "files")
    page = F.col("page_id").cast("string")
    rows = _table(spark, d, "pages").select(F.concat(F.lit("site"), (F.col("page_id") % 7).cast("string"), F.lit("/p"), page, F.lit(".html")).alias("name"), F.col("html").cast("binary").alias("content"))
    written = outputs.write_files(rows, folder)
    back = outputs.read_files(written, folder).select("name", "size", F.sha2("content", 256).alias("sha256"))
    told = written.select("name", F.col("size").alias("told_size"), F.col("sha256").alias("told"))
    return back.join(told, "name").select("name", "size", "sha256", ((F.col("told") == F.col("sha256")) & (F.col("told_size") == F.col("size"))).alias("listed"))


@query("""WITH CAPS SELECT source AS input_id, ord, url, CASE WHEN ord % 2 = 0 THEN concat('a "', ord, '", ', chr(10), 'b') ELSE '' END AS note, last_modified14 FROM caps""")
def summaries_written(spark, d):
    """A CSV file for each input, read back: quotes, line ends, empty texts and nulls come back as they were."""
    note = F.when(F.col("ord") % 2 == 0, F.concat(F.lit('a "'), F.col("ord").cast("string"), F.lit('", \nb'))).otherwise("")
    rows = captures(spark, d).select("ord", "url", note.alias("note"), "last_modified14", F.col("source").alias("input_id"))
    return outputs.write_by_input(rows, new_folder(spark, "summaries"), ("ord",))


@query("""WITH CAPS SELECT source AS input_id, url, count(*) AS captures FROM caps GROUP BY 1, 2""")
def documents_written(spark, d):
    """JSON documents in a folder for each input, read back."""
    rows = captures(spark, d).groupBy(F.col("source").alias("input_id"), "url").agg(F.count("*").alias("captures"))
    return outputs.write_by_input(rows.select("url", "captures", "input_id"), new_folder(spark, "documents"), ("url",), "json")
