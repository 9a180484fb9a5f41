"""Archives read in stretches: each member once, whatever the stretches, with range reads that follow what is asked for."""

import gzip
import io
import os
import random
import zlib

import pytest
from pyspark.sql import functions as F

from arkspark.sources import archives


def record(draw, i, size):
    body = bytes(draw.randrange(256) for _ in range(size)) if draw.random() < 0.5 else b"words " * (size // 6)
    return b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:%d>\r\nContent-Length: %d\r\n\r\n" % (i, len(body)) + body + b"\r\n\r\n"


def member(data, level=6):
    pack = zlib.compressobj(level, wbits=31)
    return pack.compress(data) + pack.flush()


def archive(seed=1, many=300):
    """Records of all sizes, some that hold files packed by gzip, stored as they are, some damaged, and bytes between them."""
    draw, out = random.Random(seed), []
    for i in range(many):
        data = member(record(draw, i, draw.choice((0, 10, 3000, 9000))), draw.choice((0, 6)))
        kind = draw.random()
        if kind < 0.1:
            held = gzip.compress(b"a file " * draw.randrange(2000))
            data = member(b"WARC/1.0\r\nContent-Length: %d\r\n\r\n" % len(held) + held + b"\r\n\r\n", 0)
        elif kind < 0.15:
            data = data[: len(data) // 2] + b"\x00\xff" * 5 + data[len(data) // 2 :]
        elif kind < 0.2:
            data = b"between \x1f\x8b\x08 records" + data
        out.append(data)
    return b"".join(out)


class Counted(io.BytesIO):
    count = 0

    def read(self, n=-1):
        out = super().read(n)
        self.count += len(out)
        return out


@pytest.mark.parametrize("stretch", [1_000, 7_919, 50_000, 10**9])
def test_stretches_together_read_each_member_once(stretch):
    data = archive()
    whole = list(archives.gzip_members(io.BytesIO(data)))
    assert len(whole) > 250 and [x[0] for x in whole] == sorted({x[0] for x in whole})
    parts = [x for at in range(0, len(data), stretch) for x in archives.gzip_members(io.BytesIO(data), at, min(at + stretch, len(data)))]
    assert parts == whole


def test_a_damaged_member_costs_no_second_copy():
    """Each byte is read about once, also behind members that are cut off."""
    data = member(b"WARC/1.0 a") + member(bytes(random.Random(2).randrange(256) for _ in range(1 << 21)), 1)[:-20] + member(b"WARC/1.0 b")
    stream = Counted(data)
    assert [r for _, _, r in archives.gzip_members(stream)] == [b"WARC/1.0 a", b"WARC/1.0 b"]
    assert stream.count < 4 * len(data)


def test_the_first_record_alone_is_read():
    data = member(b"WARC/1.0\r\nfirst") + os.urandom(1 << 22)
    stream = Counted(data)
    assert next(archives.gzip_members(stream, step=archives._SHORT_STEP))[2] == b"WARC/1.0\r\nfirst"
    assert stream.count <= archives._SHORT_STEP


def test_a_large_file_is_read_by_many_tasks(spark, tmp_path):
    data = archive(4, 600)
    (tmp_path / "a.warc.gz").write_bytes(data)
    (tmp_path / "empty.gz").write_bytes(b"")
    files = spark.createDataFrame([(str(tmp_path / n),) for n in ("a.warc.gz", "empty.gz", "none.gz")], "path string")
    got = archives.scan_archives(files, stretch=len(data) // 24).withColumn("task", F.spark_partition_id()).collect()
    whole = list(archives.gzip_members(io.BytesIO(data)))
    assert sorted((r.offset, r.length, bytes(r.record)) for r in got if r.record is not None) == whole
    assert len({r.task for r in got if r.record is not None}) >= 16
    assert [r.path.rpartition("/")[2] for r in got if r.error] == ["none.gz"]


def test_records_nearby_are_those_of_the_whole_file(spark, tmp_path):
    """Windows around every 40th record, joined where they meet."""
    draw = random.Random(6)
    data, places = b"", []
    for i in range(400):
        packed = member(record(draw, i, draw.choice((100, 4000))))
        places.append((str(tmp_path / "a.warc.gz"), len(data), len(packed)))
        data += packed
    (tmp_path / "a.warc.gz").write_bytes(data)
    asked = spark.createDataFrame([*places[::40], (None, 1, 1), (places[0][0], None, 5)], "path string, offset long, length long")
    nearby = 9_000
    stretches = sorted((r.start, r.end) for r in archives.nearby_stretches(asked, nearby, 6_000).collect())
    assert all(a[1] <= b[0] for a, b in zip(stretches[:-1], stretches[1:], strict=True)) and all(b - a <= 6_000 for a, b in stretches)
    assert sum(b - a for a, b in stretches) <= 10 * (2 * nearby + 10_000) < len(data)
    got = {(r.offset, r.length) for r in archives.records_nearby(asked, nearby, 6_000).collect()}
    want = {(o, n) for _, o, n in places for _, at, m in places[::40] if o >= at - nearby and o < at + m + nearby}
    assert got == want


def test_first_records_of_files(spark, tmp_path):
    (tmp_path / "a.gz").write_bytes(member(b"filedesc://a line\nmore\nrest") + member(b"WARC/1.0 b"))
    (tmp_path / "b.gz").write_bytes(b"")
    got = {r.path.rpartition("/")[2]: (bytes(r.record) if r.record is not None else None, r.error is None) for r in archives.first_records(spark.createDataFrame([(str(tmp_path / n),) for n in ("a.gz", "b.gz", "c.gz")] + [(None,)], "path string")).collect()}
    assert got == {"a.gz": (b"filedesc://a line\nmore\n", True), "b.gz": (None, False), "c.gz": (None, False)}


def test_files_by_key(spark):
    rows = spark.createDataFrame([(k, b"WARC/1.0 %d %d" % (k, i)) for k in range(5) for i in range(3)], "k long, record binary").repartition(2, "k").sortWithinPartitions("k")
    places = archives.write_archives(rows, ".warc.gz", by="k").collect()
    assert len({p.path for p in places}) == 5 and all(len({q.k for q in places if q.path == p.path}) == 1 for p in places)
    assert sum(p.offset == 0 for p in places) == 5


def test_written_folders_have_their_scheme(spark):
    from arkspark.sources.files import new_folder

    assert ":/" in new_folder(spark, "x")
