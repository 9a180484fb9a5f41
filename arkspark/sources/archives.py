"""Compressed archive files: all their records, or those at given places. One gzip member is one record.

A file is read in stretches of about ``STRETCH`` bytes, each by one task. A task looks for the first true member that begins in its
stretch and reads on past the stretch's end to finish the last one, so that each member is read once.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from arkspark.sources.files import new_folder, open_file

_STEP = 1 << 18
#: What a first record, which is mostly short, is read by.
_SHORT_STEP = 1 << 14
_MAGIC = b"\x1f\x8b\x08"
#: Bytes given to the decompressor at once: what it hands back at a member's end is no more.
_FEED = 1 << 14
#: How a record begins: the version of a WARC record, or the line of fields of an ARC record.
_RECORD = re.compile(rb"WARC/\d|\S+ \S+ \d{14} [^\n]*\d\s*\n")
#: A file is read by one task for each so many bytes.
STRETCH = 64 << 20
#: Bytes around a response in which records that belong to it are looked for.
NEARBY = 512_000
#: Rows of one batch that a task gives out at most.
_ROWS = 256


class _Bytes:
    """A stream by places, of which one step is held."""

    def __init__(self, stream, step: int = _STEP):
        self.stream, self.step, self.base, self.held, self.read = stream, step, 0, b"", 0

    def _load(self, at: int) -> None:
        self.stream.seek(at)
        self.base, self.held = at, self.stream.read(self.step)
        self.read += len(self.held)

    def piece(self, at: int, size: int) -> bytes:
        """Some of the bytes from ``at`` on, ``size`` at most; none at the end."""
        if not self.base <= at < self.base + len(self.held):
            self._load(at)
        return self.held[at - self.base : at - self.base + size]

    def find(self, what: bytes, at: int, end: int | None) -> int | None:
        """Where ``what`` next begins, from ``at`` on and before ``end``."""
        while end is None or at < end:
            if not self.base <= at <= self.base + len(self.held) - len(what):
                self._load(at)
                if len(self.held) < len(what):
                    return None
            found = self.held.find(what, at - self.base)
            if found >= 0:
                return self.base + found if end is None or self.base + found < end else None
            at = self.base + len(self.held) - len(what) + 1
        return None


def _member(source: _Bytes, at: int) -> tuple[int, bytes] | None:
    """(packed length, content) of the member at a place; none if it is damaged, cut off, or isn't one."""
    unpack, parts, place = zlib.decompressobj(wbits=31), [], at
    while not unpack.eof:
        piece = source.piece(place, _FEED)
        if not piece:
            return None
        try:
            parts.append(unpack.decompress(piece))
        except zlib.error:
            return None
        place += len(piece)
    return place - len(unpack.unused_data) - at, b"".join(parts)


def first_true_member(source: _Bytes, at: int, end: int | None) -> int | None:
    """Where the first member begins, from a place on at which any part of a file may be.

    What looks like a member may be a file that a record holds, stored as it is. So it must begin with a record's first line, or be
    followed by one that does, or by the file's end. Archives that hold archives, stored as they are over the border of a stretch, can't be told
    apart from their own members.
    """
    while (at := source.find(_MAGIC, at, end)) is not None:
        found = _member(source, at)
        if found is not None:
            after = at + found[0]
            if _RECORD.match(found[1]) or not source.piece(after, 1):
                return at
            following = _member(source, after) if source.piece(after, 1) == _MAGIC[:1] else None
            if following is not None and _RECORD.match(following[1]):
                return at
        at += 1
    return None


def gzip_members(stream, start: int = 0, end: int | None = None, step: int = _STEP) -> Iterator[tuple[int, int, bytes]]:
    """(offset, packed length, content) of each member of a seekable stream that begins from ``start`` on and before ``end``; bytes that are part of no member are
    passed over.

    A damaged member is given up, and the next one looked for after its first byte. Of the file no more is held than a
    step, and of members one.
    """
    source = _Bytes(stream, step)
    at = first_true_member(source, start, end) if start else 0
    while at is not None and (at := source.find(_MAGIC, at, end)) is not None:
        found = _member(source, at)
        if found is None:
            at += 1
            continue
        yield at, *found
        at += found[0]


def _batch(rows: list[tuple], columns: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], columns)


_SCAN = "path string, offset long, length long, record binary, error string"
_KINDS = [pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.string()]
_NAMES = [c.split()[0] for c in _SCAN.split(", ")]
_PART = "path string, start long, end long"


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes = []
        for path in batch.column("path").to_pylist():
            try:
                with open_file(path) as stream:
                    sizes.append(stream.size())
            except OSError:
                sizes.append(None)  # told by the task that is to read it
        yield pa.RecordBatch.from_arrays([batch.column("path"), pa.array(sizes, pa.int64())], ["path", "size"])


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, start, end in zip(*(batch.column(c).to_pylist() for c in ("path", "start", "end")), strict=True):
            rows: list[tuple] = []
            try:
                with open_file(path) as stream:
                    for offset, length, record in gzip_members(stream, start, end):
                        rows.append((path, offset, length, record, None))
                        if len(rows) == _ROWS or len(record) > _STEP:
                            yield _batch(rows, _NAMES, _KINDS)
                            rows = []
            except OSError as wrong:
                rows.append((path, None, None, None, str(wrong)))
            if rows:
                yield _batch(rows, _NAMES, _KINDS)


def stretches_of(files: DataFrame, stretch: int = STRETCH) -> DataFrame:
    """(path, start, end): the stretches of the files (path), whose sizes are looked up; one stretch of a file that can't be opened."""
    sizes = files.select("path").where("path is not null").distinct().mapInArrow(_sizes, "path string, size long")
    starts = F.sequence(F.lit(0).cast("long"), F.greatest(F.coalesce("size", F.lit(0)) - 1, F.lit(0)), F.lit(stretch).cast("long"))
    return sizes.select("path", F.explode(starts).alias("start"), "size").select("path", "start", F.coalesce(F.least(F.col("start") + stretch, "size"), F.lit(0)).alias("end"))


def nearby_stretches(places: DataFrame, nearby: int = NEARBY, stretch: int = STRETCH) -> DataFrame:
    """(path, start, end): disjoint stretches that hold all bytes within ``nearby`` of the places (path, offset, length), none longer than ``stretch``.

    Places are first joined by cells of that size, so that what is put in order for a file is as long as the file, not as its places.
    """
    known = places.where("path is not null and offset is not null and length is not null")
    cells = known.groupBy("path", F.expr(f"offset div {nearby}").alias("cell")).agg(F.min(F.greatest(F.col("offset") - nearby, F.lit(0))).alias("low"), F.max(F.col("offset") + F.col("length") + nearby).alias("high"))
    order = Window.partitionBy("path").orderBy("low", "high")
    reached = F.max("high").over(order.rowsBetween(Window.unboundedPreceding, -1))
    islands = cells.withColumn("new", F.coalesce(F.col("low") > reached, F.lit(True)).cast("int")).withColumn("island", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    islands = islands.groupBy("path", "island").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    starts = F.sequence(F.col("low"), F.greatest(F.col("high") - 1, "low"), F.lit(stretch).cast("long"))
    return islands.select("path", F.explode(starts).alias("start"), "high").select("path", "start", F.least(F.col("start") + stretch, "high").alias("end"))


def read_stretches(parts: DataFrame, stretch: int = STRETCH) -> DataFrame:
    """A row for each member that begins in one of the parts (path, start, end): path, offset, length (packed), record, error.

    Parts are dealt by their bytes: about ``stretch`` to a task, whatever the number of files.
    """
    parts = parts.select("path", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"))
    total, n = parts.agg(F.coalesce(F.sum(F.col("end") - F.col("start")), F.lit(0)), F.count("*")).first()
    tasks = max(1, min(n, max(-(-total // stretch), 4 * parts.sparkSession.sparkContext.defaultParallelism)))
    return parts.repartition(tasks).mapInArrow(_scan, _SCAN)


def scan_archives(files: DataFrame, stretch: int = STRETCH) -> DataFrame:
    """A row per gzip member of the files (path): path, offset, length (packed), record, error.

    A large file is read by many tasks, a stretch each, record by record. One that can't be opened gives a row with an error; null paths
    and files without members give none.
    """
    return read_stretches(stretches_of(files, stretch), stretch)


def records_nearby(places: DataFrame, nearby: int = NEARBY, stretch: int = STRETCH) -> DataFrame:
    """The members of archive files that begin within ``nearby`` bytes of the places (path, offset, length), each once: only those stretches of
    the files are read."""
    return read_stretches(nearby_stretches(places, nearby, stretch), stretch)


def _look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    name, context, stream = None, None, None
    try:
        for batch in batches:
            rows: list[tuple] = []
            for path, offset, length in zip(*(batch.column(c).to_pylist() for c in ("path", "offset", "length")), strict=True):
                try:
                    if path != name:
                        if context:
                            context.__exit__(None, None, None)
                        context, name = None, None
                        opened = open_file(path)
                        stream = opened.__enter__()
                        context, name = opened, path
                    stream.seek(offset)
                    record = zlib.decompressobj(wbits=31).decompress(stream.read(length))
                    rows.append((path, offset, length, record, None))
                except (OSError, zlib.error, ValueError) as wrong:
                    rows.append((path, offset, length, None, str(wrong)))
                if len(rows) == _ROWS:
                    yield _batch(rows, _NAMES, _KINDS)
                    rows = []
            if rows:
                yield _batch(rows, _NAMES, _KINDS)
    finally:
        if context:
            context.__exit__(None, None, None)


def look_up_records(places: DataFrame) -> DataFrame:
    """The records at distinct places (path, offset, length) of archive files, with an error where there is none.

    Places are dealt by file and stretch of the file and read in their order, so that each task opens a file once and
    reads on, and a file that very many rows ask for is spread. Places with a null are left out.
    """
    known = places.select("path", F.col("offset").cast("long").alias("offset"), F.col("length").cast("long").alias("length")).where("path is not null and offset is not null and length is not null").distinct()
    dealt = known.withColumn("stretch", F.expr(f"offset div {STRETCH}")).repartition("path", "stretch").sortWithinPartitions("path", "offset")
    return dealt.select("path", "offset", "length").mapInArrow(_look_up, _SCAN)


def _first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows: list[tuple] = []
        for path in batch.column("path").to_pylist():
            try:
                with open_file(path) as stream:
                    offset, length, record = next(gzip_members(stream, step=_SHORT_STEP), (None, None, None))
                rows.append((path, offset, length, record, None if record is not None else "no record"))
            except OSError as wrong:
                rows.append((path, None, None, None, str(wrong)))
            if len(rows) == _ROWS:
                yield _batch(rows, _NAMES, _KINDS)
                rows = []
        if rows:
            yield _batch(rows, _NAMES, _KINDS)


def first_records(files: DataFrame) -> DataFrame:
    """Of each of the files (path) its first record, which describes it: (path, offset, length, record, error). Of an ARC file's, what follows its last line end goes.

    No more of a file is read than that record and a step of ``_SHORT_STEP`` bytes.
    """
    paths = files.select("path").where("path is not null").distinct()
    first = paths.repartition(4 * files.sparkSession.sparkContext.defaultParallelism, "path").mapInArrow(_first, _SCAN)
    text = F.decode("record", "ISO-8859-1")
    return first.withColumn("record", F.when(text.startswith("filedesc:"), F.encode(F.regexp_replace(text, r"[^\n]*$", ""), "ISO-8859-1")).otherwise(F.col("record")))


def _packer(folder: str, extension: str, level: int, by: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        context = TaskContext.get()
        stem, number, at, rows, stream, opened, last = f"{folder}/part-{context.partitionId():05d}-{context.taskAttemptId()}", 0, 0, [], None, None, None
        path = stem + extension
        try:
            for batch in batches:
                others = [c for c in batch.schema.names if c != "record"]
                for record, *keys in zip(batch.column("record").to_pylist(), *(batch.column(c).to_pylist() for c in others), strict=True):
                    now = keys[others.index(by)] if by else None
                    if stream is not None and now != last:
                        opened.__exit__(None, None, None)
                        stream, opened, at, number = None, None, 0, number + 1
                    last = now
                    if stream is None:
                        path = f"{stem}-{number:05d}{extension}" if by else stem + extension
                        opened = open_file(path, "w")
                        stream = opened.__enter__()
                    pack = zlib.compressobj(level, wbits=31)
                    data = pack.compress(record) + pack.flush()
                    stream.write(data)
                    rows.append((path, at, len(data), *keys))
                    at += len(data)
                kinds = [pa.string(), pa.int64(), pa.int64(), *(f.type for f in batch.schema if f.name != "record")]
                yield _batch(rows, ["path", "offset", "length", *others], kinds)
                rows = []
        finally:
            if opened:
                opened.__exit__(None, None, None)

    return run


def write_archives(records: DataFrame, extension: str, folder: str | None = None, level: int = 6, by: str | None = None) -> DataFrame:
    """Write the record of each row as a gzip member, in the rows' order, a file for each partition; returns the place of each
    (path, offset, length) beside the other columns, itself kept in a table in the folder. Files of tasks that failed are in no place.

    With ``by`` a new file begins wherever that column changes: rows that were dealt and sorted by it make one file for each value.
    """
    spark: SparkSession = records.sparkSession
    folder = folder or new_folder(spark, "archives")
    others = [f for f in records.schema if f.name != "record"]
    schema = ", ".join(["path string", "offset long", "length long", *(f"{f.name} {f.dataType.simpleString()}" for f in others)])
    records.mapInArrow(_packer(folder, extension, level, by), schema).write.parquet(f"{folder}/places")
    return spark.read.schema(schema).parquet(f"{folder}/places")
