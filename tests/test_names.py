"""Archive file names, records, sort keys and stage configurations on small cases."""

import gzip
import io
import random

import pytest
from pyspark.sql import functions as F

from arkspark.functions import headers, urls
from arkspark.functions.archive_names import FAMILIES, archive_name, archive_name_candidates, may_be_of
from arkspark.operators import archive_files, records, transforms
from arkspark.plans import name_queries
from arkspark.sources import archives

#: Made-up names: name, stamp of a capture in it, layout and score, and fields.
NAMES = [
    ("slash_19990301101112-920400000.arc.gz", "19990310000000", "alexa-1998", 0.9, {"crawl_identifier": "slash", "crawl_batch_start": "1999-03-01T18:11:12Z", "crawler_name": "green"}),
    ("to-19990220-919500000.arc.gz", None, "alexa-1998", 0.7, {"crawl_identifier": "to", "crawl_start_date": "1999-02-20"}),
    ("to-crawl-000123-20000601010203-959900000.arc.gz", None, "alexa-1998", 0.8, {"crawl_identifier": "to-crawl", "crawler_name": "crawl1", "crawl_batch_start": "2000-06-01T08:02:03Z"}),
    ("20000706-000777-20000707080910-963000000.arc.gz", None, "alexa-1998", 0.8, {"crawl_identifier": "20000706", "crawl_start_date": "2000-07-06", "file_serial_number": "000777"}),
    ("IA-E96-42.arc.gz", "19980801235959", "alexa-1996", 1.0, {"crawl_identifier": "IA-E96", "crawler_name": "widener", "file_serial_number": "42"}),
    ("QQ-000042.arc.gz", "19980802000000", "alexa-1996", 0.5, {"crawl_identifier": "QQ", "crawler_name": None}),
    ("short3z-7-40-958000001.arc.gz", None, "alexa-2000-04-image", 0.8, {"crawl_tuning_parameter": 40, "file_serial_number": None, "crawler_node": "7"}),
    ("E02_daily_crawl9.20020101020304.arc.gz", None, "alexa-2002-election", 0.8, {"crawl_identifier": "E02_daily", "file_serial_number": None}),
    ("shop_set-07-20110203040506-00012-domU-0A-1B-2C-3D-4E-5F.compute-2.internal.warc.gz", None, "generic", 0.4, {"crawler_mac_address": "0A:1B:2C:3D:4E:5F", "crawler_name": None}),
    ("shop_set-08-20110304050607-00034-ip-10-9-8-7.ec2.internal.warc.gz", None, "generic", 0.4, {"crawler_ip_address_internal": "10.9.8.7"}),
    ("ABC-HARVEST-7-2011-20110405060708-00056-crawling777.us.archive.org.warc.gz", None, "generic", 0.6, {"crawl_identifier": "ABC-HARVEST-7-2011", "crawler_name": "crawling777"}),
    ("BROAD--20120506070809--00078.warc.gz", None, "generic", 0.4, {"crawl_identifier": "BROAD", "file_serial_number": "00078"}),
    ("cgi9.archive.org.wb_robots.20021203040506.arc.gz", "20021203040506", "wayback-2002", 1.0, {"crawler_name": "cgi9", "crawler_hostname": "cgi9.archive.org"}),
    ("live-20120607080910111-00900-20120608091011121/live-20120607101112131-00905.arc.gz", None, "wayback-live", 0.8, {"file_write_start": "2012-06-07T10:11:12.131Z"}),
    ("archiveteam_maps_20150708091011/maps_20150708091011.megawarc.warc.gz", None, "archiveteam-warrior", 1.0, {"crawl_identifier": "maps", "file_write_start": None}),
    ("crawl-data/CC-MAIN-2014-99/segments/1400000000123.45/warc/CC-MAIN-20140809101112-00099-ip-10-1-2-3.ec2.internal.warc.gz", None, "commoncrawl-2013", 1.0, {"file_segment": "1400000000123.45", "file_segment_time": "2014-05-13T16:53:20.123Z"}),
    ("a/b/c.txt", None, None, None, {}),
    ("EX_2_1_crawl9_.20060102030405.arc.gz", None, None, None, {}),
    ("", None, None, None, {}),
]


def test_archive_names(spark):
    rows = spark.createDataFrame([(i, n, s) for i, (n, s, *_) in enumerate(NAMES)] + [(-1, None, None)], "i int, filename string, stamp string")
    got = {r.i: (r.archive_file, r.archive_file_error) for r in archive_files.with_archive_names(rows, "filename", "stamp").collect()}
    assert len(got) == len(NAMES) + 1 and got[-1] == (None, None)
    for i, (name, _, layout, score, fields) in enumerate(NAMES):
        read, error = got[i]
        assert (read and read.layout) == layout, name
        assert error == ("unknown record format" if name in ("a/b/c.txt", "") else None), name
        if read:
            assert round(read.confidence, 3) == score, name
            assert {k: read.details[k] for k in fields} == fields, name


def test_signs_hide_no_reading(spark):
    """Of names of all layouts, whole and spoilt, no family reads one that its sign leaves out."""
    draw = random.Random(3)
    caps = spark.createDataFrame([(i, f"2024{1 + i % 12:02d}{1 + i % 28:02d}{i % 24:02d}{i % 60:02d}00") for i in range(20)], "ord long, ts14 string")
    layouts = [x[1] for group in (name_queries._EARLY, name_queries._CRAWLS, name_queries._PLAYBACK, name_queries._SUBSCRIBED) for x in group]
    names = [v for r in caps.select(*(F.expr(e).alias(f"n{i}") for i, e in enumerate(layouts))).collect() for v in r] + [n for n, *_ in NAMES]
    for n in names[:]:
        at = draw.randrange(len(n) + 1)
        names += [n[:at] + draw.choice("-_.0aZ/") + n[at:], n[at:], n[:at] + n[at + 1 :], draw.choice(("a/", "x/y/", "")) + n]
    rows = spark.createDataFrame([(n,) for n in sorted(set(names))], "name string").repartition(4)
    for family in FAMILIES:
        read = rows.select("name", may_be_of(F.col("name"), (family,)).alias("of"), archive_name(F.col("name"), None, (family,)).alias("r"))
        missed, hit = read.agg(F.count_if((F.col("of") == 0) & F.col("r").isNotNull()), F.count_if(F.col("r").isNotNull())).first()
        assert missed == 0 and hit, family


def test_equal_scores_keep_the_order_of_families(spark):
    name = F.lit("CDL-20090203040506-00042-dp08.warc.gz")
    read = spark.range(1).select(archive_name_candidates(name).alias("c")).first().c
    assert [r.layout for r in read] == ["cdl", "generic"] and list(FAMILIES)[0] == "alexa"


def test_names_are_read_once(spark):
    """Of several families, in one place of the plan, and with scores as they are told by each."""
    rows = spark.createDataFrame([(n, s) for n, s, *_ in NAMES], "filename string, stamp string")
    out = archive_files.with_archive_names(rows, "filename", "stamp")
    lines = out._jdf.queryExecution().optimizedPlan().toString().splitlines()
    assert sum("lambda" in line for line in lines) == 1
    alone = {r.filename: r.layout for r in rows.select("filename", archive_name(F.col("filename"), F.col("stamp"))["layout"].alias("layout")).collect()}
    assert {r.filename: r.archive_file and r.archive_file.layout for r in out.collect()} == alone


CASES = [
    ("http://www.bigmaker.com/toys/blocks/", "com,bigmaker)/toys/blocks"), ("http://bigmaker.com:80/toys/blocks/?", "com,bigmaker)/toys/blocks"), ("https://example.com:443/path", "com,example)/path"), ("http://example.com:8080/path", "com,example:8080)/path"),
    ("http://www.www2.example.com/", "com,example)/"), ("http://\\www.example.com:80/secure/a.gif", "com,example,\\www)/secure/a.gif"), ("http://a.b/?f=/r.asp?I=1&E=2&D=", "b,a)/?d=&e=2&f=/r.asp?i=1"), ("dns:example.com", "com,example)"), ("filedesc:foo.arc.gz", "filedesc:foo.arc.gz"),
    ("http://a.b/a//../b", "b,a)/a/b"), ("http://a.b/a/b/..", "b,a)/a"), ("http://a.b/../x", "b,a)/../x"), ("http://a.b/?jsessionid=0123456789abcdefABCDEF0123456789", "b,a)/?"), ("http://010.0.0.1/", "1,0,0,8)/"), ("http://192.168.000.1/", "1,0,168,192)/"),
    ("http://a.b/%7Ex/é", "b,a)/~x/%c3%a9"), ("http://a.b/%25%32%35", "b,a)/%25"), ("", "-"), (None, "-"),
]


def test_archive_sort_keys(spark):
    rows = spark.createDataFrame([(i, u) for i, (u, _) in enumerate(CASES)], "i int, url string")
    got = {r.i: r.urlkey for r in urls.wayback_urlkeys(rows).collect()}
    assert [(u, got[i]) for i, (u, _) in enumerate(CASES)] == CASES


def test_damaged_members_are_passed_over():
    a, b = gzip.compress(b"one" * 1000), gzip.compress(b"two")
    broken = bytearray(gzip.compress(b"bad" * 1000))
    broken[15] ^= 0xFF
    data = b"junk" + a + bytes(broken) + b"\x1f\x8b" + b + a[:-5]
    found = list(archives.gzip_members(io.BytesIO(data)))
    assert [(at, r[:3]) for at, _, r in found] == [(4, b"one"), (len(data) - len(a) + 5 - len(b), b"two")]
    assert all(gzip.decompress(data[at : at + n]) == r for at, n, r in found)
    assert list(archives.gzip_members(io.BytesIO(b""))) == []


def test_contents_of_records():
    headers_ = [{"name": "Transfer-Encoding", "value": "Chunked"}, {"name": "Content-Encoding", "value": "GZIP"}]
    packed = gzip.compress(b"text")
    chunked = b"%x\r\n" % len(packed) + packed + b"\r\n0\r\n\r\n"
    assert records.unpack_content(chunked, headers_) == b"text" == records.unpack_content(packed, headers_, dechunked=True)
    assert records.unpack_content(b"\x1f\x8bno gzip", headers_, dechunked=True) == b"\x1f\x8bno gzip"
    for wrong in (b"zz\r\n", b"5\r\nab", b"2\r\nabX", b"no end"):
        with pytest.raises(records.RecordError):
            records.dechunk(wrong)
    with pytest.raises(records.RecordError):
        records.parse_arc(b"http://a 1.2.3.4 2000 text/html 9\nshort")


def test_unreadable_records_and_files(spark):
    rows = spark.createDataFrame([(1, b"WARC/1.0\r\nno end"), (2, None), (3, b"x"), (4, b"WARC/1.0\r\nContent-Length: q\r\n\r\n")], "i int, record binary")
    out = records.parse_records(rows, ("i",)).collect()
    assert len(out) == 4 and all(r.error and r.kind is None for r in out)
    gone = archives.scan_archives(spark.createDataFrame([("/no/such/file.warc.gz",), (None,)], "path string")).collect()
    assert len(gone) == 1 and gone[0].error
    assert archives.look_up_records(spark.createDataFrame([("/no/such", 0, 5)], "path string, offset long, length long")).first().error


def test_playback_headers_of_later_captures(spark):
    raw = F.array(*(F.struct(F.lit(n).alias("name"), F.lit(v).alias("value")) for n, v in (("X-Archive-Orig-x-powered-by", "p"), ("content-type", "text/css"), ("x-archive-orig-content-type", "text/plain"), ("date", "d"))))
    out = spark.range(1).select(headers.original_headers(F.lit("http://a/"), raw, F.lit(2016), F.lit(False)).alias("h")).first().h
    assert [(h.name, h.value, h.unconfirmed) for h in out] == [("x-powered-by", "p", False), ("content-type", "text/plain", False)]


def test_stage_configurations():
    assert len(transforms.stages_of([{"type": "regex", "pattern": "a", "template": "b"}, {"type": "tracking", "query": "strip"}])) == 2
    for wrong in ({"type": "none"}, {"type": "regex", "pattern": "a"}, {"type": "tracking", "colour": "x"}):
        with pytest.raises(ValueError, match="stage"):
            transforms.stages_of([wrong])
    assert transforms.range_values([(1, 3), "a", None]) == ["1", "2", "3", "a", None]
