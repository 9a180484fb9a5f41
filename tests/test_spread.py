"""Steps that must not gather in one task what grows with the input: their plans, and the same rows as before."""

import random
import re
from collections import Counter
from contextlib import contextmanager
from decimal import Decimal
from itertools import product

import pyarrow as pa
from pyspark.sql import functions as F

from arkspark.operators import etags, joins, ordinals, records, sampling
from arkspark.plans import QUERIES, archive_queries
from arkspark.sources import files, indexes, outputs

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@contextmanager
def plainly(spark):
    """Without joins chosen by size and partitions joined at run time."""
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def candidates(code: str, capture: int) -> list[Decimal]:
    """In every way, by plain Python."""
    found = set()
    for way in product((1, 2), repeat=8):
        if sum(way) == len(code):
            ends = [sum(way[: i + 1]) for i in range(8)]
            pieces = [code[e - w : e] for e, w in zip(ends, way, strict=True)]
            if not any(len(p) == 2 and p[0] == "0" for p in pieces):
                ticks = sum(int(p, 16) << 8 * i for i, p in enumerate(pieces)) - 116444736000000000
                if 820454400 * 10**7 <= ticks <= (capture + 86400) * 10**7:
                    found.add(Decimal(ticks) / 10**7)
    return sorted(found)


def test_etag_candidates_where_the_rows_are(spark):
    draw = random.Random(1)
    rows = []
    for i in range(400):
        code = "".join(draw.choice("0123456789abcdef") for _ in range(draw.randint(5, 13))) + draw.choice(["ba1", "c01", "e51", "102", "91", "12"])
        rows.append((i, f'"{code}:5"', draw.choice([925_000_000, 1_700_000_000, 2_767_045_206, 3_500_000_000, -5])))
    out = etags.etag_candidates(spark.createDataFrame([*rows, (400, None, 5), (401, '"065876af836be1:7"', None)], "i long, etag string, capture_seconds long"))
    assert "Join" not in plan(out) and "Exchange" not in plan(out)
    got = {r.i: r.candidates for r in out.collect()}
    assert got.pop(400) == got.pop(401) == []
    expected = {i: candidates(etag[1:-3], capture) for i, etag, capture in rows}
    assert got == expected and sum(map(len, expected.values())) > 100


def test_orders_are_worked_out_before_the_sort(spark, monkeypatch):
    rows = spark.createDataFrame([(i, f"20240101{i % 24:02d}0000", f"http://www.h{i % 7}.org/{i}") for i in range(50)], "ord long, ts14 string, url string")
    seen = []
    monkeypatch.setattr(ordinals, "written", lambda df, label: seen.append(df) or files.written(df, label))
    places = {r.ord: r.place for r in ordinals.ordinals(rows, *sampling.order_keys(), "ord").collect()}
    assert [r.ord for r in sampling.capture_order(rows).collect()] == sorted(places, key=places.get)
    for df in (seen[0], sampling.capture_order(rows)):
        sorts = [line for line in plan(df).splitlines() if "Sort [" in line or "rangepartitioning" in line]
        assert sorts and not any("regexp" in line for line in sorts)


def test_lines_of_one_file_in_many_tasks(spark):
    lines = spark.createDataFrame([("f", " CDX N b a m")] + [("f", f"k{i} 2000 http://a/{i} text/html") for i in range(200)], "path string, value string")
    with plainly(spark):
        found = indexes.parse_cdx(lines).withColumn("task", F.spark_partition_id()).collect()
    assert len(found) == 200 and len({r.task for r in found}) > 1


def test_text_index_of_a_source_in_several_files(spark, monkeypatch):
    expected = sorted(map(str, QUERIES["index_text_files"](spark, SF).collect()))
    monkeypatch.setattr(archive_queries, "_FILE_ROWS", 300)
    seen, read = [], indexes.lines_of
    monkeypatch.setattr(indexes, "lines_of", lambda spark, path, whole=False: seen.append(read(spark, path, whole)) or seen[-1])
    found = sorted(map(str, QUERIES["index_text_files"](spark, SF).collect()))
    assert found == expected and seen[0].select("path").distinct().count() > 3


def test_ranges_meet_rows_where_they_are(spark):
    rows = spark.createDataFrame([(i, "a", "u", f"20240101{i:02d}0000", 200) for i in range(24)], "ord long, input_id string, request_url string, ts14 string, status int")
    ranges = spark.createDataFrame([("a", "20240101", "20240102")], "input_id string, start_ts string, end_ts string")
    with plainly(spark):
        out = sampling.limit_captures(rows, ranges, 2)
        assert "SortMergeJoin [input_id" not in plan(out)
        assert sorted(r.ord for r in out.collect()) == [6, 18]


def test_rows_of_one_input_in_several_files(spark, tmp_path):
    rows = spark.range(400).select("id", F.lit("a\n").alias("note"), F.lit("one").alias("input_id"))
    with plainly(spark):
        back = outputs.write_by_input(rows, str(tmp_path), ("id",))
        assert sorted(r.id for r in back.collect()) == list(range(400))
    assert len(list(tmp_path.glob("input_id=one/*.csv"))) > 1


def test_records_are_taken_apart_in_pieces():
    block = b"HTTP/1.1 200 OK\r\n\r\n" + b"x" * 20_000
    record = b"WARC/1.0\r\nWARC-Type: response\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (len(block), block)
    rows = [record if i % 3 else None for i in range(999)]
    flags = pa.array([None] * 999, pa.bool_())
    batch = pa.RecordBatch.from_arrays([pa.array(range(999)), pa.array(rows, pa.binary()), flags, flags, flags], ["n", "record", "trailing_newline", "dechunked", "extra_blank_line"])
    out = list(records._parse(iter([batch, batch.slice(0, 0)])))
    assert max(b.num_rows for b in out) <= 256 and max(b.nbytes for b in out) < 8 << 20
    assert [n for b in out for n in b.column("n").to_pylist()] == list(range(999))
    assert [e for b in out for e in b.column("error").to_pylist()] == [None if r else "no record" for r in rows]


def test_json_index_files_hold_many_pages(spark, monkeypatch):
    seen, read = [], indexes.lines_of
    monkeypatch.setattr(indexes, "lines_of", lambda spark, path, whole=False: seen.append(read(spark, path, whole)) or seen[-1])
    QUERIES["index_json_files"](spark, SF).collect()
    pages = spark.read.parquet(f"{SF}/pages.parquet").count()
    assert 1 <= seen[0].select("path").distinct().count() <= pages // 64 + 1


def test_rows_that_refer_to_nothing_are_spread(spark):
    rows = spark.createDataFrame(
        [(i, f"u{i}", "2000", 200, f"d{i}", f"u{i - 1}" if i % 50 == 1 else "gone" if i % 50 == 2 else None, None if i % 50 == 0 else "2000") for i in range(400)],
        "ord long, url string, ts14 string, status int, digest string, refers_url string, refers_ts string",
    )
    with plainly(spark):
        found = joins.resolve_revisits(rows).withColumn("task", F.spark_partition_id()).collect()
    plain = Counter(r.task for r in found if r.ord % 50 > 2)
    assert len(found) == 400 and len(plain) > 1 and max(plain.values()) < 200
    assert {r.ord: (r.digest, r.target_ord, r.error) for r in found} == {i: (f"d{i - 1}", i - 1, None) if i % 50 == 1 else (f"d{i}", None, "missing" if i % 50 == 2 else None) for i in range(400)}


def test_pages_are_read_before_names_are_joined(spark):
    lines = QUERIES["captures_enriched"](spark, SF)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    joined = next(i for i, line in enumerate(lines) if "Join" in line and re.search(r"\b_name#", line))
    read = [i for i, line in enumerate(lines) if '<img src="(.+?)"' in line]
    assert read and min(read) > joined
