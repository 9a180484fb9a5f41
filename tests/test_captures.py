"""Capture queries against their SQL, and small cases."""

import datetime
import decimal

import duckdb
import pytest
from pyspark.sql import functions as F

from arkspark.functions import scalars, urls
from arkspark.operators import etags, sampling
from arkspark.plans import QUERIES, SQL

SF = "/root/testdata/sf0.001"


def plain(value):
    if isinstance(value, decimal.Decimal | float):
        return round(float(value), 6)
    return str(value) if isinstance(value, datetime.datetime) else value


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(spark, name):
    con = duckdb.connect()
    for table in ("events", "pages", "region", "nation"):
        con.sql(f"create view {table} as select * from '{SF}/{table}.parquet'")
    ours = QUERIES[name](spark, SF)
    theirs = con.sql(SQL[name])
    columns = sorted(ours.columns)
    assert columns == sorted(theirs.columns)
    a = sorted((tuple(plain(r[c]) for c in columns) for r in ours.collect()), key=repr)
    at = [theirs.columns.index(c) for c in columns]
    b = sorted((tuple(plain(r[i]) for i in at) for r in theirs.limit(10**9).fetchall()), key=repr)
    assert a == b


def one(spark, column, **values):
    return spark.createDataFrame([tuple(values.values())], list(values)).select(column.alias("x")).first().x


@pytest.mark.parametrize(("url", "key"), [("http://www.example.com/", "com,example)/"), ("https://a.b.org:8080/X/?q=1", "org,b,a:8080)/x/?q=1"), ("http://example.com/dir/", "com,example)/dir")])
def test_simple_urlkey(spark, url, key):
    assert one(spark, urls.simple_urlkey(F.col("u")), u=url) == key


def test_wayback_urlkey(spark):
    assert one(spark, urls.wayback_urlkey(F.col("u")), u="http://www.Example.com/a/../B/?z=1&a=2#top") == "com,example)/b?a=2&z=1"


def test_etag_round_trip(spark):
    rows = spark.createDataFrame([(925_000_000, 123_456_700, 2038)], "s long, n long, c int")
    rows = rows.select(scalars.iis_etag(F.col("s"), F.col("n"), F.col("c")).alias("etag"), F.col("s").alias("capture_seconds"))
    found = etags.etag_candidates(rows).first().candidates
    assert decimal.Decimal("925000000.1234567") in found


def test_clock_sample_takes_the_nearest(spark):
    rows = spark.createDataFrame([(h, "u", f"20001001{h:02d}0000") for h in range(24)], "ord long, url string, ts14 string")
    assert sorted(r.ts14[8:10] for r in sampling.clock_sample(rows, ("url",), 4).collect()) == ["03", "09", "15", "21"]
