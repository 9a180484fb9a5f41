"""Index files, dates and transformation stages on small cases."""

import hashlib

import pytest
from pyspark.sql import functions as F

from arkspark.functions import dates, scalars
from arkspark.operators import documents, transforms
from arkspark.sources import indexes


def test_text_index_from_files(spark, tmp_path):
    (tmp_path / "a.cdx").write_text(" CDX N b a m s k S\nk1 20000101000000 http://a/ text/html 200 D 12\r\nk2 20000101000000 http://b/ - 200 D 12\n\nk3 2000 http://c/ text/css -\n")
    rows = indexes.parse_cdx(indexes.lines_of(spark, str(tmp_path))).orderBy("urlkey").collect()
    assert [(r.urlkey, r.status, r.digest, r.length, r.offset) for r in rows] == [("k1", 200, "D", 12, None), ("k3", None, None, None, None)]


def test_text_index_without_header(spark):
    with pytest.raises(Exception, match="no index header"):
        indexes.parse_cdx(spark.createDataFrame([("p", "k 2000 u m")], "path string, value string")).collect()


def test_files_without_header_can_be_reported(spark):
    lines = spark.createDataFrame([("p", "k 2000 u m"), ("q", " CDX N b a m"), ("q", "k 2000 u m")], "path string, value string")
    assert [r.path for r in indexes.parse_cdx(lines, strict=False).collect()] == ["q"]
    assert [(r.path, r.error) for r in indexes.headerless_files(lines).collect()] == [("p", "no index header")]


def test_json_index_of_no_rows(spark):
    files = spark.createDataFrame([("p", "[]"), ("q", None)], "path string, value string")
    assert indexes.parse_cdx_json(files, indexes.WAYBACK_FIELDS).count() == 0


@pytest.mark.parametrize(("text", "seconds"), [("Sun, 06 Nov 1994 08:49:37 GMT", 784111777), ("Sunday, 06-Nov-94 08:49:37 GMT", 784111777), ("Sun Nov  6 08:49:37 1994", 784111777), ("Thu, 31 Feb 2000 00:00:00 GMT", None), ("", None), (None, None)])
def test_http_date(spark, text, seconds):
    got = spark.createDataFrame([(text,)], "t string").select(F.unix_timestamp(dates.http_date(F.col("t"))).alias("s")).first().s
    assert got == seconds


def test_crawl_title(spark):
    rows = spark.createDataFrame([("May 2020 Index",), (" Crawl of 2012 ",)], "t string").select(scalars.crawl_title(F.col("t")).alias("t"))
    assert [r.t for r in rows.collect()] == ["May 2020 Crawl", "Crawl of 2012"]


def test_stages(spark):
    texts = ["<A href=X>", "<a href=X>", "", None]
    sources = spark.createDataFrame([(hashlib.sha256(repr(t).encode()).hexdigest(), t) for t in texts], "sha string, content string")
    contents, links = transforms.run_stages(sources, [transforms.regex_stage("<([A-Za-z]+)", "<$1", "lower"), transforms.param_stage("h", "href=([A-Z])", [None, "Q"])])
    assert sorted((r.content, r.param_key) for r in contents.collect()) == [("", ""), ("<a href=Q>", "h=Q"), ("<a href=X>", "")]
    assert links.where("param_key = 'h=Q'").count() == 2
    assert links.count() == 6


def test_bundle_order(spark):
    records = spark.createDataFrame([(1, "arc", 1, b"b\xff"), (1, "arc-header", 9, b"a"), (2, "arc", 1, b"x")], "capture int, kind string, ord int, content binary")
    got = {r.capture: (r.content, r.error) for r in documents.record_bundles(records).collect()}
    assert bytes(got[1][0]) == b"ab\xff" and got[2] == (None, "no archive header")
