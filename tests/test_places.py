"""Places in an order, summaries on disk, outputs, look-ups by prefix and by interval, on small cases."""

import random

import pytest
from pyspark.sql import functions as F

from arkspark.operators import enrichment, lookup, sampling, versions
from arkspark.operators.ordinals import ordinals
from arkspark.sources import outputs


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_places_among_all_and_by_key(spark):
    """Half of all rows have one key, and some a null one."""
    draw = random.Random(1)
    rows = [(None if i % 50 == 0 else "hot" if i % 2 else f"k{draw.randrange(40)}", draw.randrange(30), i) for i in range(5000)]
    df = spark.createDataFrame(rows, "k string, t int, i int")
    got = ordinals(df.repartition(7), "t", "i")
    assert [r.i for r in got.orderBy("place").collect()] == [i for _, _, i in sorted(rows, key=lambda r: r[1:])] and got.agg(F.max("place")).first()[0] == 5000
    by = ordinals(df, "t", "i", by=("k",)).collect()
    for key in {r[0] for r in rows}:
        want = [i for k, _, i in sorted(rows, key=lambda r: r[1:]) if k == key]
        assert [r.i for r in sorted((r for r in by if r.k == key), key=lambda r: r.place)] == want
        assert sorted(r.place for r in by if r.k == key) == list(range(1, len(want) + 1))
    assert ordinals(df.limit(0), "t").count() == 0


def test_a_hot_key_is_spread(spark):
    df = spark.range(20_000).select(F.lit("hot").alias("k"), F.col("id").alias("t"))
    spread = df.repartitionByRange(4, "k", "t").groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert spread < 10_000 and ordinals(df, "t", by=("k",)).where("place <> t + 1").count() == 0


def test_index_sample_of_few_and_null_keys(spark):
    rows = spark.createDataFrame([("a", "1", 1), ("a", "2", 2), ("a", "3", 3), (None, "1", 4), (None, "2", 5)], "u string, ts14 string, ord long")
    assert sorted(r.ord for r in sampling.index_sample(rows, ("u",), 2).collect()) == [1, 3, 4, 5]
    assert sorted(r.ord for r in sampling.index_sample(rows, ("u",), 1).collect()) == [1, 4]


def test_ranges_of_their_inputs(spark):
    rows = spark.createDataFrame([(i, f"2020010{d}") for i in ("a", "b") for d in range(1, 6)] + [(None, "20200101")], "input_id string, ts14 string")
    ranges = spark.createDataFrame([("x", "20200101", "20200103", 2, "a"), ("y", "20200101", "20200109", 4, None), ("z", "20200104", "20200105", 5, None)], "range_id string, start_ts string, end_ts string, threshold int, input_id string")
    got = {(r.input_id, r.range_id, r.n) for r in sampling.active_ranges(rows, ranges).collect()}
    assert got == {("a", "x", 3), ("a", "y", 5), ("b", "y", 5)}


def summary(spark, *rows):
    return spark.createDataFrame([(p, t, i, r) for p, t, i, r in rows], "path string, capture_ts string, capture_index long, run string")


def test_summary_on_disk(spark, tmp_path):
    folder = str(tmp_path / "summary")
    versions.write_summary(summary(spark, *((f"p{i}", "2000", i, "old") for i in range(40))), folder, parts=8)
    parts = {p.name: {f.name for f in p.iterdir()} for p in (tmp_path / "summary").iterdir() if p.is_dir()}
    got = versions.write_summary(summary(spark, ("p3", "2001", 0, "new"), ("p3", "1999", 1, "new"), ("q", "2001", 0, "new")), folder, parts=8)
    assert sorted((r.path, r.capture_ts, r.run) for r in got.collect()) == sorted([*((f"p{i}", "2000", "old") for i in range(40) if i != 3), ("p3", "2001", "new"), ("p3", "1999", "new"), ("q", "2001", "new")])
    after = {p.name: {f.name for f in p.iterdir()} for p in (tmp_path / "summary").iterdir() if p.is_dir()}
    assert sum(parts[p] != after.get(p) for p in parts) <= 2  # the parts of p3 and q alone are written anew


def test_a_failed_run_leaves_the_summary(spark, tmp_path):
    folder = str(tmp_path / "summary")
    old = versions.write_summary(summary(spark, *((f"p{i}", "2000", i, "old") for i in range(20))), folder, parts=4)
    before = sorted(tuple(r) for r in old.collect())
    bad = summary(spark, ("p1", "2001", 0, "new"), ("p2", "2001", 0, "new")).withColumn("run", F.when(F.col("path") == "p2", F.raise_error(F.lit("broken"))).otherwise(F.col("run")))
    with pytest.raises(Exception, match="broken"):
        versions.write_summary(bad, folder, parts=4)
    assert sorted(tuple(r) for r in spark.read.schema(old.schema).parquet(folder).select(*old.columns).collect()) == before


def test_files_by_name(spark, tmp_path):
    rows = spark.createDataFrame([("a/b c.html", b"x"), ("a/é.bin", b"\x00\xff"), ("empty", None), (None, b"y")], "name string, content binary")
    written = outputs.write_files(rows, f"file:{tmp_path}")
    assert {r.name: (bytes(r.content), r.size) for r in outputs.read_files(written, f"file:{tmp_path}").collect()} == {"a/b c.html": (b"x", 1), "a/é.bin": (b"\x00\xff", 2), "empty": (b"", 0)}
    with pytest.raises(ValueError, match="two rows"):
        outputs.write_files(rows.union(rows.limit(1)), f"file:{tmp_path}")


def test_intervals_hold_what_the_first_period_says(spark):
    """Overlapping, touching, empty and open periods against the first by order that holds a stamp."""
    draw = random.Random(4)
    periods = [(draw.choice("ab"), a, b, o, f"v{o}") for o in range(30) for a, b in [sorted(draw.choices([f"20{y:02d}" for y in range(40)], k=2))]] + [("a", None, "2050", -1, "never"), (None, "2000", "2050", -2, "none")]
    draw.shuffle(periods)
    rows = [(k, f"20{y:02d}") for k in ("a", "b", "c", None) for y in range(42)] + [("a", None)]
    got = enrichment.with_period(spark.createDataFrame(rows, "provider string, ts14 string"), spark.createDataFrame(periods, "key string, from string, to string, ord int, name string"), F.col("provider"), ("name",))
    for r in got.collect():
        held = [(o, v) for k, a, b, o, v in periods if k == r.provider and None not in (k, a, b, r.ts14) and a <= r.ts14 <= b]
        assert (r.period.name if r.period else None) == (min(held)[1] if held else None)


def test_look_ups_shuffle_no_rows(spark):
    rows = spark.createDataFrame([("2001", "a", "c1", "h", "a-b-1"), ("2009", "b", None, None, None)], "ts14 string, provider string, crawler_name string, crawler_hostname string, crawl_identifier string")
    periods = spark.createDataFrame([("a", "2000", "2005", 0, "192.0.2.0/24", None)], "key string, from string, to string, ord int, crawlerIpRange string, knownCrawlers array<struct<crawlerName:string,crawlerHostname:string,crawlerHostnameSecondary:string,crawlerIpAddress:string>>")
    rules = spark.createDataFrame([("A-b", "2000", "2005", 1, "HTTP/1.0", None), ("a", "2000", "2005", 2, "x", None)], "key string, from string, to string, ord int, protocol string, headers array<array<string>>")
    out = enrichment.prefix_periods(enrichment.crawler_info(rows, periods), rules)
    first = out.where("provider = 'a'").first()
    assert (first.crawler_info.ip_range, first.principal.protocol) == ("192.0.2.0/24", "HTTP/1.0")
    plan = plan_of(out)
    assert "SortMergeJoin" not in plan and "NestedLoop" not in plan


def test_prefixes_by_equality(spark):
    urls = ["http://a/", "http://a/b", "http://a/bc", "http://b", None, ""]
    rows = spark.createDataFrame([(u,) for u in urls], "url string")
    prefixes = [("http://a/", "1"), ("http://a/b", "2"), ("http://a/b", "3"), (None, "4"), ("http://c", "5")]
    out = lookup.with_prefixes(rows, spark.createDataFrame(prefixes, "prefix string, dumps string"))
    assert sorted((r.url, r.dumps) for r in out.collect()) == sorted((u, n) for u in urls for p, n in prefixes if u and p and u.startswith(p))
    assert "NestedLoop" not in plan_of(out) and "Cartesian" not in plan_of(out)


def test_reports_in_parts(spark, monkeypatch):
    monkeypatch.setattr(lookup, "LISTED", 3)
    rows = spark.createDataFrame([("u", f"200{i}", "warc/revisit", False) for i in range(8)] + [("u", "x", "text/html", False), ("v", "20000101000000", "text/html", False)], "request_url string, ts14 string, mime string, unavailable boolean")
    kept, report = lookup.split_readable(rows)
    got = sorted((r.request_url, r.part, r.unresolvable_revisits, r.invalid_timestamps) for r in report.collect())
    assert [r.request_url for r in kept.collect()] == ["v"]
    assert got == [("u", 0, ["2000", "2001", "2002"], ["x"]), ("u", 1, ["2003", "2004", "2005"], None), ("u", 2, ["2006", "2007"], None)]
