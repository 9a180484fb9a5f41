"""What is known of a capture's crawl: crawler periods, request headers, descriptions in archives, referrers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arkspark.functions.archive_names import FAMILIES
from arkspark.functions.scalars import bind, header_value
from arkspark.operators.records import arc_description, warcinfo_fields

_KNOWN = "array<struct<crawlerName string, crawlerHostname string, crawlerHostnameSecondary string, crawlerIpAddress string>>"


def _intervals(periods: Column) -> Column:
    """array<struct<at, value>>: what holds from each bound on up to the next one, by bound, of an array of struct<from, to, ord, value>.

    Bounds are texts, ``to`` included; where periods overlap the first by ord holds, outside all null.
    """
    after = lambda p: F.concat(p["to"], F.lit("\0"))  # noqa: E731  the least text above
    known = F.array_sort(F.filter(periods, lambda p: p["from"].isNotNull() & p["to"].isNotNull()), lambda x, y: F.when(x["ord"] < y["ord"], -1).when(x["ord"] > y["ord"], 1).otherwise(0))

    def over(p: Column) -> Column:
        bounds = F.array_sort(F.array_distinct(F.concat(F.transform(p, lambda x: x["from"]), F.transform(p, after))))
        return F.transform(bounds, lambda at: F.struct(at.alias("at"), F.get(F.filter(p, lambda x: (x["from"] <= at) & (after(x) > at)), F.lit(0))["value"].alias("value")))

    return bind(known, over)


def _holding(intervals: Column, ts: Column) -> Column:
    """What holds at a stamp."""
    return F.try_element_at(F.filter(intervals, lambda i: i["at"] <= ts), F.lit(-1))["value"]


def _period(*value: str | Column) -> Column:
    return F.struct(F.col("from").alias("from"), F.col("to").alias("to"), F.col("ord").alias("ord"), (F.struct(*value) if len(value) > 1 else value[0]).alias("value"))


def with_period(rows: DataFrame, periods: DataFrame, on: Column, columns: tuple[str, ...], name: str = "period") -> DataFrame:
    """``rows`` (ts14, ...) with a struct of ``columns`` of the first period (key, from, to, ord, ...), by ord, of the key ``on`` that holds the stamp.

    Periods are configuration: each key's become one sorted array without overlaps, so that the rows look theirs up where they are.
    """
    index = periods.groupBy(F.col("key").alias("_key")).agg(_intervals(F.collect_list(_period(F.struct(*columns)))).alias("_intervals"))
    return rows.join(F.broadcast(index), on == F.col("_key"), "left").withColumn(name, _holding(F.col("_intervals"), F.col("ts14"))).drop("_key", "_intervals")


def overrides_of(rows: DataFrame, overrides: DataFrame) -> DataFrame:
    """``rows`` (ts14, crawler_name) with has_override, whether the crawler is listed, and ``override``: struct<crawlerHostname, crawlerIpAddress, protocol, headers>,
    each from the first of its periods that holds the stamp and says it. As ``with_period``, in one look-up."""
    host = F.struct("crawlerHostname", "crawlerIpAddress")
    said = {"_hosts": (F.col("crawlerHostname").isNotNull() | F.col("crawlerIpAddress").isNotNull(), host), "_protocols": (F.col("protocol").isNotNull(), F.col("protocol")), "_headers": (F.col("headers").isNotNull(), F.col("headers"))}
    index = overrides.where("key is not null").groupBy(F.col("key").alias("_key")).agg(*(_intervals(F.collect_list(F.when(kept, _period(value)))).alias(name) for name, (kept, value) in said.items()))
    at = lambda name: _holding(F.col(name), F.col("ts14"))
    out = rows.join(F.broadcast(index), F.lower("crawler_name") == F.col("_key"), "left")
    told = F.struct(at("_hosts")["crawlerHostname"].alias("crawlerHostname"), at("_hosts")["crawlerIpAddress"].alias("crawlerIpAddress"), at("_protocols").alias("protocol"), at("_headers").alias("headers"))
    return out.withColumns({"has_override": F.col("_key").isNotNull(), "override": told}).drop("_key", *said)


def crawler_info(rows: DataFrame, periods: DataFrame, overrides: DataFrame | None = None, override_provider: str = "alexa") -> DataFrame:
    """``rows`` (ts14, provider, crawler_name, crawler_hostname) with ``crawler_info``: struct<name, hostname, hostname_secondary, ip_address, ip_range, known>.

    Of the provider's first period that holds the stamp: its IP range if it has one; else the crawler known by this name or host, ports cut and case ignored; else, if
    five at most are known, all of them. Crawlers of ``override_provider`` that are listed among ``overrides`` have that alone.
    """
    out = with_period(rows, periods, F.col("provider"), ("crawlerIpRange", "knownCrawlers"))
    if overrides is not None:
        out = overrides_of(out, overrides)
    else:
        out = out.withColumns({"has_override": F.lit(False), "override": F.lit(None).cast("struct<crawlerHostname:string,crawlerIpAddress:string>")})
    bare = lambda h: F.lower(F.substring_index(h, ":", 1))
    name, host, known = F.lower("crawler_name"), bare(F.col("crawler_hostname")), F.col("period.knownCrawlers")
    fits = lambda c: F.coalesce(F.lower(c["crawlerName"]) == name, F.lit(False)) | F.coalesce(bare(c["crawlerHostname"]) == host, F.lit(False))
    match = F.try_element_at(F.filter(known, fits), F.lit(1))
    text = F.lit(None).cast("string")

    def info(name=text, hostname=text, secondary=text, ip=text, ip_range=text, known=None) -> Column:
        many = F.lit(None).cast(_KNOWN.replace(" string", ":string")) if known is None else known
        return F.struct(name.alias("name"), hostname.alias("hostname"), secondary.alias("hostname_secondary"), ip.alias("ip_address"), ip_range.alias("ip_range"), many.alias("known"))

    overridden = (F.col("provider") == override_provider) & F.col("has_override")
    told = lambda match: (
        F.when(overridden, info(hostname=F.col("override.crawlerHostname"), ip=F.col("override.crawlerIpAddress")))
        .when(F.col("period.crawlerIpRange").isNotNull(), info(ip_range=F.col("period.crawlerIpRange")))
        .when(match.isNotNull(), info(match["crawlerName"], match["crawlerHostname"], match["crawlerHostnameSecondary"], match["crawlerIpAddress"]))
        .when(F.size(known).between(1, 5), info(known=known))
    )
    return out.withColumn("crawler_info", bind(match, told)).drop("period", "has_override", "override")


def prefix_periods(rows: DataFrame, rules: DataFrame) -> DataFrame:
    """``rows`` (ts14, crawl_identifier) with ``principal``: struct<protocol, headers>. The first key, by ord, that is the identifier or stands before a hyphen
    in it, in any case, decides; of its periods the first that holds the stamp.

    A key and the identifiers that it decides begin with the same letters up to the first hyphen, so that they are joined by those.
    """
    head = lambda c: F.substring_index(c, "-", 1)
    keys = rules.where("key is not null").groupBy(F.lower("key").alias("rule")).agg(F.min("ord").alias("place"), _intervals(F.collect_list(_period(F.struct("protocol", "headers")))).alias("intervals"))
    index = keys.groupBy(head(F.col("rule")).alias("_head")).agg(F.sort_array(F.collect_list(F.struct("place", "rule", "intervals"))).alias("_rules"))
    low = F.lower("crawl_identifier")
    out = rows.join(F.broadcast(index), head(low) == F.col("_head"), "left")
    rule = F.get(F.filter("_rules", lambda r: (r["rule"] == low) | low.startswith(F.concat(r["rule"], F.lit("-")))), F.lit(0))
    return out.withColumn("principal", _holding(rule["intervals"], F.col("ts14"))).drop("_head", "_rules")


def derived_headers(template: Column, host: Column, referer: Column) -> Column:
    """array<struct<name, value, unconfirmed>> of a list of [name], [name, value] or [name, value, "?"].

    Of names without a value, Host and Referer are filled in; the others are left out.
    """
    name = lambda h: F.lower(h[0])
    value = lambda h: F.coalesce(F.get(h, F.lit(1)), F.when(name(h) == "host", host).when(name(h) == "referer", referer))
    filled = F.transform(template, lambda h: F.struct(h[0].alias("name"), value(h).alias("value"), F.coalesce(F.get(h, F.lit(2)) == "?", F.lit(False)).alias("unconfirmed")))
    return F.filter(filled, lambda h: h["value"].isNotNull())


def replace_header(headers: Column, name: str, value: Column) -> Column:
    """``headers`` with a value in the place of the first of that name, or at the end; unchanged for a null value."""

    def told(b: Column) -> Column:
        headers, value = b["headers"], b["value"]
        new = F.struct(F.lit(name).alias("name"), value.alias("value"), F.lit(False).alias("unconfirmed"))
        at = F.array_position(F.transform(headers, lambda h: F.lower(h["name"])), name.lower())
        placed = bind(at, lambda at: F.when(at > 0, F.transform(headers, lambda h, i: F.when(i == at - 1, new).otherwise(h))).otherwise(F.concat(headers, F.array(new))))
        return F.when(value.isNotNull(), placed).otherwise(headers)

    return bind(F.struct(headers.alias("headers"), value.alias("value")), told)


def request_headers(rows: DataFrame, periods: DataFrame, overrides: DataFrame, principals: DataFrame) -> DataFrame:
    """``rows`` (ts14, url, record_format, provider, crawler_name, crawl_identifier, description (name, value pairs of the archive), referer) with request_protocol
    and request_headers, as they are known of that crawl at that time.

    WARC files tell the requests themselves, so that nothing is derived for them. Listed crawlers have their override alone, crawls of the archive itself the rule of
    their identifier, others their provider's period. The archive's own User-Agent and From win.
    """
    from arkspark.functions.urls import host, port

    out = with_period(prefix_periods(overrides_of(rows, overrides), principals), periods, F.col("provider"), ("protocol", "headers"))
    listed = (F.col("provider") == "alexa") & F.col("has_override")
    own = (F.col("provider") == "internetarchive") & F.col("principal").isNotNull()
    pick = lambda field: F.when(listed, F.col(f"override.{field}")).when(own, F.col(f"principal.{field}")).otherwise(F.col(f"period.{field}"))
    with_port = F.concat(host(F.col("url")), F.when(port(F.col("url")) != "", F.concat(F.lit(":"), port(F.col("url")))).otherwise(""))
    site = F.when(F.col("provider") == "alexa", host(F.col("url"))).otherwise(with_port)
    empty = F.array().cast("array<struct<name:string,value:string,unconfirmed:boolean>>")
    told = F.coalesce(derived_headers(pick("headers"), site, F.col("referer")), empty)
    told = replace_header(told, "User-Agent", header_value(F.col("description"), "http-header-user-agent"))
    told = replace_header(told, "From", header_value(F.col("description"), "http-header-from"))
    warc = F.coalesce(F.col("record_format") == "warc", F.lit(False))
    out = out.withColumn("_told", told)
    return out.withColumns({"request_protocol": F.when(~warc, pick("protocol")), "request_headers": F.when(~warc & (F.size("_told") > 0), F.col("_told"))}).drop("has_override", "override", "principal", "period", "_told")


#: Fields of a crawl's description and the names they have in it.
CRAWL_FIELDS = {"crawler": "software", "ip": "ip", "hostname": "hostname", "crawl_job": "isPartOf", "description": "description", "publisher": "publisher", "operator": "operator", "robots": "robots", "format": "format", "conforms_to": "conformsTo"}


def crawl_info(kind: Column, content: Column) -> Column:
    """A struct of ``CRAWL_FIELDS`` of an archive's first record, of kind warc-info or arc-header; null if it tells none of them. Only WARC
    files name a publisher."""
    pairs = F.when(kind == "warc-info", warcinfo_fields(content)).when(kind == "arc-header", arc_description(content))

    def told(p: Column) -> Column:
        # Names in lower case once, so that a field's place is found without a look at each pair by an expression.
        named = F.struct(F.transform(p, lambda h: F.lower(h["name"])).alias("names"), F.transform(p, lambda h: h["value"]).alias("values"))
        return bind(bind(named, taken), lambda s: F.when(F.coalesce(*(s[k] for k in CRAWL_FIELDS)).isNotNull(), s))

    def taken(n: Column) -> Column:
        values = {k: F.get(n["values"], F.array_position(n["names"], name.lower()) - 1) for k, name in CRAWL_FIELDS.items()}
        values["publisher"] = F.when(kind == "warc-info", values["publisher"])
        return F.struct(*(v.alias(k) for k, v in values.items()))

    return bind(pairs, told)


def archive_file_info(archive_file: Column, crawler: Column) -> Column:
    """A struct of what the file's name and its crawler's period tell; the name wins."""
    d = archive_file["details"]
    both = {"crawler_name": "name", "crawler_hostname": "hostname", "crawler_ip_address": "ip_address"}
    names = ("crawl_identifier", "crawl_provider", "crawl_generation_code", "crawl_job_id", "crawl_subset")
    more = {"crawler_hostname_secondary": crawler["hostname_secondary"], "known_crawlers": crawler["known"], "crawler_ip_range": crawler["ip_range"]}
    times = ("file_write_start", "file_write_end", "crawl_processing", "file_serial_number")
    return F.when(archive_file.isNotNull(), F.struct(*(d[n].alias(n) for n in names), *(F.coalesce(d[k], crawler[v]).alias(k) for k, v in both.items()), *(v.alias(k) for k, v in more.items()), *(d[n].alias(n) for n in times)))


# The two ways in which pages hold their tracking image, and the page whose address stands in its own parameter.
TRACKING_IMAGES = ((r'<layer visibility="hide"><div style="display:none"><img src="(.+?)"', "&"), (r'<layer visibility="hide"><div style="display:none"><img alt="" width="0" height="0" border="0" hspace="0" vspace="0" src="(.+?)">', "&amp;"))
TOOLBAR = "/library/toolbar/3.0/asp.aspx"


def _decoded(text: Column) -> Column:
    """Percent escapes undone; a plus sign stays."""
    return F.try_url_decode(F.replace(text, F.lit("+"), F.lit("%2B")))


def tracking_referers(text: Column) -> Column:
    """Distinct referrers in the tracking images of a page: parameter r, or r inside the address of the toolbar."""

    def of(text: Column, pattern: str, separator: str) -> Column:
        query = F.get(F.split(F.regexp_extract(text, pattern, 1), r"\?"), F.lit(1))
        return bind(F.coalesce(F.split(query, separator), F.array().cast("array<string>")), told)

    def told(parts: Column) -> Column:
        inner = lambda p: bind(_decoded(F.substring(p, F.lit(5), F.length(p))), lambda c: F.when(F.substring_index(c, "?", 1) == TOOLBAR, F.filter(F.split(F.get(F.split(c, r"\?"), F.lit(1)), "&"), lambda s: s.startswith("r=") & (F.length(s) > 2))))
        nested = F.flatten(F.filter(F.transform(F.filter(parts, lambda p: p.startswith("URI=")), inner), lambda x: x.isNotNull()))
        return F.transform(F.concat(nested, F.filter(parts, lambda p: p.startswith("r="))), lambda s: _decoded(F.substring(s, F.lit(3), F.length(s))))

    return F.array_distinct(bind(text, lambda t: F.concat(*(of(t, p, s) for p, s in TRACKING_IMAGES))))


def with_referer(pages: DataFrame) -> DataFrame:
    """``pages`` (mime, content, ...) with referer, null for none, and referer_error where the two images disagree."""
    found = tracking_referers(F.when(F.col("mime") == "text/html", F.decode("content", "ISO-8859-1")))
    out = pages.withColumn("_r", found)
    several = F.size("_r") > 1
    return out.withColumns({"referer": F.when(~several, F.nullif(F.get("_r", F.lit(0)), F.lit(""))), "referer_error": F.when(several, F.concat(F.lit("several referrers: "), F.array_join("_r", ", ")))}).drop("_r")


def enrich(rows: DataFrame, crawlers: DataFrame, headers: DataFrame, overrides: DataFrame, principals: DataFrame, statistics: DataFrame, families: tuple[str, ...] = tuple(FAMILIES)) -> DataFrame:
    """``rows`` (ord, ts14, url, filename, etag, capture_seconds, modified_seconds, server, record_kind, record_content, mime, content) with all that is known of their crawl, in this order:
    exact times, crawl and archive file (by the layouts of ``families``), request headers, file statistics."""
    from arkspark.operators.archive_files import with_archive_names, with_file_statistics
    from arkspark.operators.etags import exact_modification

    # What records and pages tell first, where the rows are: whoever needs no contents then has none of them sent to the names of their files.
    described = F.when(F.col("record_kind") == "warc-info", warcinfo_fields(F.col("record_content"))).when(F.col("record_kind") == "arc-header", arc_description(F.col("record_content")))
    told = rows.withColumns({"crawl_info": crawl_info(F.col("record_kind"), F.col("record_content")), "description": described})
    out = with_archive_names(exact_modification(with_referer(told)), "filename", "ts14", families)
    d = F.col("archive_file.details")
    out = out.withColumns({"provider": d["crawl_provider"], "crawler_name": d["crawler_name"], "crawler_hostname": d["crawler_hostname"], "crawl_identifier": d["crawl_identifier"], "record_format": F.col("archive_file.record_format")})
    out = crawler_info(out, crawlers, overrides).withColumn("archive_file_info", archive_file_info(F.col("archive_file"), F.col("crawler_info")))
    out = request_headers(out, headers, overrides, principals)
    return with_file_statistics(out, statistics)
