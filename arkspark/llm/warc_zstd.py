"""Zstandard web archives: written and read as .warc.zst files.

An archive begins with a skippable frame that holds the dictionary, and has one Zstandard frame per record. The reader
takes the dictionary from that frame, decodes record by record, and validates headers, lengths and digests.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from urllib.parse import urlparse

import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arkspark.llm.common import Scratch, only

SKIPPABLE = 0x184D2A5D
_ZSTD_MAGIC = b"\x28\xb5\x2f\xfd"
VERSION = b"WARC/1.1"
#: An archive is closed once it has this many bytes.
ARCHIVE_BYTES = 64 << 20
#: The dictionary of an archive is trained on its first so many payloads, of so many bytes at most.
TRAIN_PAYLOADS, TRAIN_BYTES, DICTIONARY_BYTES = 64, 1 << 20, 16 << 10
_STEP = 1 << 18
#: Archives that a task reads at most, so that a large set is read by as many tasks as its size asks for.
READ_AT_ONCE = 8
#: What Arrow calls the schemes that Hadoop has names of its own for.
_ARROW_SCHEMES = {"s3a": "s3", "s3n": "s3", "wasb": "abfs", "wasbs": "abfss"}


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


@contextmanager
def _open(path: str, mode: str):
    """A binary stream of the shared file system that ``path`` names."""
    kind = urlparse(path).scheme
    if kind in ("", "file"):
        fs, name = pafs.LocalFileSystem(), urlparse(path).path
    else:
        fs, name = pafs.FileSystem.from_uri(_ARROW_SCHEMES.get(kind, kind) + path[len(kind) :])
    with fs.open_output_stream(name, compression=None) if mode == "w" else fs.open_input_stream(name, compression=None) as stream:
        yield stream


def encode_record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = b"".join(f"{k}: {v}\r\n".encode() for k, v in [*headers, ("Content-Length", str(len(block)))])
    return VERSION + b"\r\n" + lines + b"\r\n" + block + b"\r\n\r\n"


class RecordError(ValueError):
    pass


def decode_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (names in lower case) and block of one whole record; raises RecordError if it isn't valid."""
    head, found, rest = data.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not found or lines[0] not in (b"WARC/1.0", b"WARC/1.1"):
        raise RecordError("no WARC header")
    headers = {}
    for line in lines[1:]:
        name, colon, value = line.decode("utf-8", "replace").partition(":")
        if not colon or not name.strip():
            raise RecordError("malformed header line")
        headers[name.strip().lower()] = value.strip()
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if name not in headers:
            raise RecordError(f"missing {name}")
    if not headers["content-length"].isdigit():
        raise RecordError("malformed content-length")
    n = int(headers["content-length"])
    if len(rest) != n + 4 or rest[n:] != b"\r\n\r\n":
        raise RecordError(f"content-length is {n}, the frame has {len(rest) - 4}")
    return headers, rest[:n]


def payload_of(headers: dict[str, str], block: bytes) -> bytes:
    """Of an HTTP response record the bytes after the HTTP header; else the block."""
    if headers.get("content-type", "").startswith("application/http"):
        head, found, body = block.partition(b"\r\n\r\n")
        if not found:
            raise RecordError("no end of the HTTP header")
        return body
    return block


def train_dictionary(payloads: list[bytes]) -> bytes:
    """A dictionary for an archive that begins with these payloads; empty if there is too little to train on."""
    samples = [p[: TRAIN_BYTES // TRAIN_PAYLOADS] for p in payloads if p]
    if len(samples) < 8:
        return b""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, level=3).as_bytes()
    except zstandard.ZstdError:
        return b""


class ArchiveWriter:
    def __init__(self, stream, dictionary: bytes):
        self.stream, self.bytes = stream, 0
        packed = zstandard.ZstdCompressor(level=3).compress(dictionary) if dictionary else b""
        self._write(struct.pack("<II", SKIPPABLE, len(packed)) + packed)
        self.codec = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None, write_content_size=True)

    def _write(self, data: bytes) -> None:
        self.stream.write(data)
        self.bytes += len(data)

    def add(self, record: bytes) -> None:
        self._write(self.codec.compress(record))


def read_archive(stream) -> Iterator[tuple[int, bytes | None, str | None]]:
    """(offset of the frame, decoded record, error) for each frame; after a damaged frame reading ends."""
    buffer, at, ended = b"", 0, False

    def more() -> bool:
        nonlocal buffer, ended
        piece = stream.read(_STEP)
        ended = not piece
        buffer += piece
        return not ended

    while len(buffer) < 8 and more():
        pass
    dictionary = None
    first = True
    while buffer or more():
        while len(buffer) < 8 and more():
            pass
        magic = struct.unpack("<I", buffer[:4])[0] if len(buffer) >= 4 else 0
        if magic & 0xFFFFFFF0 == 0x184D2A50 and len(buffer) >= 8:
            size = struct.unpack("<I", buffer[4:8])[0]
            while len(buffer) < 8 + size and more():
                pass
            if len(buffer) < 8 + size:
                yield at, None, "truncated skippable frame"
                return
            if first and magic == SKIPPABLE and size:
                raw = buffer[8 : 8 + size]
                raw = zstandard.ZstdDecompressor().decompress(raw) if raw[:4] == _ZSTD_MAGIC else raw
                dictionary = zstandard.ZstdCompressionDict(raw)
            buffer, at, first = buffer[8 + size :], at + 8 + size, False
            continue
        first = False
        codec = zstandard.ZstdDecompressor(dict_data=dictionary).decompressobj()
        out, used = [], 0
        try:
            while not codec.eof:
                if not buffer and not more():
                    yield at, None, "truncated frame"
                    return
                used += len(buffer)
                out.append(codec.decompress(buffer))
                buffer = b""
        except zstandard.ZstdError as error:
            yield at, None, f"damaged frame: {error}"
            return
        buffer = codec.unused_data
        yield at, b"".join(out), None
        at += used - len(buffer)


def _http(payload: bytes) -> bytes:
    return b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload) + payload


def _record(row) -> bytes:
    """The record of one page; row: page_id, url, payload, size, digest, first."""
    revisit = row["first"] is not None
    headers = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'page:{row["page_id"]}')}>"),
        ("WARC-Date", "2024-01-01T00:00:00Z"),
        ("WARC-Target-URI", " ".join((row["url"] or "").split()) or "about:blank"),
        ("WARC-Payload-Digest", f"sha1:{row['digest']}"),
        ("X-Page-Id", "" if row["page_id"] is None else str(row["page_id"])),
    ]
    if not revisit:
        return encode_record([*headers, ("Content-Type", "application/http; msgtype=response")], _http(row["payload"]))
    more = [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Refers-To", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'page:{row["first"]}')}>"), ("X-Refers-To-Page-Id", str(row["first"])), ("X-Payload-Length", str(row["size"]))]
    return encode_record([*headers, *more], b"")


def _writer(folder: str, archive_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # the attempt is part of the name: a task that runs again doesn't touch what another attempt has written
        task = TaskContext.get()
        name, number = f"{task.partitionId():06d}-{task.taskAttemptId()}", 0
        rows = (row for batch in batches for at in range(0, batch.num_rows, 256) for row in batch.slice(at, 256).to_pylist())
        pending: list[dict] = []
        paths, counts, sizes = [], [], []
        while True:
            while len(pending) < TRAIN_PAYLOADS and sum(len(r["payload"]) for r in pending) < 8 * TRAIN_BYTES and (row := next(rows, None)) is not None:
                pending.append(row)
            if not pending:
                break
            path = f"{folder}/part-{name}-{number:04d}.warc.zst"
            number += 1
            with _open(path, "w") as stream:
                archive = ArchiveWriter(stream, train_dictionary([r["payload"] for r in pending if r["first"] is None]))
                archive.add(encode_record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, path)}>"), ("WARC-Date", "2024-01-01T00:00:00Z"), ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n"))
                n = 0
                while archive.bytes < archive_bytes:
                    row = pending.pop(0) if pending else next(rows, None)
                    if row is None:
                        break
                    archive.add(_record(row))
                    n += 1
            paths.append(path)
            counts.append(n)
            sizes.append(archive.bytes)
        yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(counts, pa.int64()), pa.array(sizes, pa.int64())], ["path", "records", "bytes"])

    return run


def write_archives(pages: DataFrame, folder: str | None = None, min_revisit_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write a record per row of ``pages`` (page_id, url, html); returns the written (path, records, bytes).

    The payload is the html in UTF-8, empty for null. Of equal payloads of at least ``min_revisit_bytes``, the row
    with the smallest page_id is a response, the others revisits of it; rows that share that id are all responses, and
    a null page_id is a revisit of any other. An empty table writes no archive. ``folder`` must be shared by all
    executors; it is a new one under spark.checkpoint.dir unless given.
    """
    scratch = Scratch(pages.sparkSession)
    folder = folder or scratch.path("warc")
    pages.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(folder).getFileSystem(pages.sparkSession.sparkContext._jsc.hadoopConfiguration()).mkdirs(pages.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(folder))
    df = only(pages, page_id="long", url="string", html="string").withColumn("payload", F.coalesce("html", F.lit("")).cast("binary")).drop("html")
    df = df.withColumn("size", F.length("payload").cast("long")).withColumn("sha1", F.sha1("payload"))
    # Told by digests alone. The table of repeated ones is written first, so that Spark knows its size: while it is
    # small, no payload is shuffled.
    again = df.where(F.col("size") >= min_revisit_bytes).groupBy("sha1").agg(F.count("*").alias("n"), F.min("page_id").alias("least")).where("n > 1").select("sha1", "least")
    df = df.join(scratch.write(again, "repeated"), "sha1", "left").withColumn("first", F.when((F.col("size") >= min_revisit_bytes) & ~F.col("page_id").eqNullSafe(F.col("least")), F.col("least")))
    df = df.withColumn("digest", base32(F.col("sha1")))
    done = df.select("page_id", "url", "payload", "size", "digest", "first").mapInArrow(_writer(folder, archive_bytes), "path string, records long, bytes long")
    return scratch.write(done, "archives")


def base32(sha1_hex):
    """Base32 of a SHA-1 given in hexadecimal: four groups of 40 bits, eight digits each."""
    groups = [F.lpad(F.conv(F.substring(sha1_hex, 10 * g + 1, 10), 16, 32), 8, "0") for g in range(4)]
    return F.translate(F.upper(F.concat(*groups)), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


_READ = "path string, offset long, type string, record_id string, target_uri string, page_id long, refers_to long, payload binary, payload_bytes long, payload_digest string, error string"


def _reader(keep_payload: bool):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = [c.split()[0] for c in _READ.split(", ")]

        def row(path: str, offset: int, data: bytes | None, error: str | None) -> list:
            if error is None:
                try:
                    headers, block = decode_record(data)
                    payload = payload_of(headers, block)
                    kind, digest = headers["warc-type"], headers.get("warc-payload-digest", "").removeprefix("sha1:") or None
                    size = len(payload)
                    if kind == "response":
                        if digest != base32_sha1(payload):
                            raise RecordError("the payload doesn't have its digest")
                    elif kind == "revisit":
                        size = int(headers["x-payload-length"]) if headers.get("x-payload-length", "").isdigit() else None
                    number = lambda x: int(x) if x else None
                    return [path, offset, kind, headers["warc-record-id"], headers.get("warc-target-uri"), number(headers.get("x-page-id")), number(headers.get("x-refers-to-page-id")), payload if keep_payload else None, size, digest, None]
                except RecordError as wrong:
                    error = str(wrong)
            return [path, offset, *[None] * 8, error]

        for batch in batches:
            for path in batch["path"]:
                with _open(path, "r") as stream:
                    rows: list[list] = []
                    for offset, data, error in read_archive(stream):
                        rows.append(row(path, offset, data, error))
                        if len(rows) >= 512:
                            yield pd.DataFrame(rows, columns=columns).astype({c: "Int64" for c in ("offset", "page_id", "refers_to", "payload_bytes")})
                            rows = []
                    if rows:
                        yield pd.DataFrame(rows, columns=columns).astype({c: "Int64" for c in ("offset", "page_id", "refers_to", "payload_bytes")})

    return run


def read_archives(archives: DataFrame, keep_payload: bool = True) -> DataFrame:
    """A row per record of the archives (path): its headers, payload, length and digest, or what is wrong with it.

    A record without a valid header, length or payload digest gives a row with ``error`` and nulls; so does a damaged
    or truncated frame, after which that archive isn't read on. Empty archives give no rows.
    """
    paths = only(archives, path="string")
    tasks = max(archives.sparkSession.sparkContext.defaultParallelism * 4, -(-paths.count() // READ_AT_ONCE))
    return paths.repartition(tasks).mapInPandas(_reader(keep_payload), _READ)


def archive_round_trip(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to), read back from archives written of ``pages``."""
    records = read_archives(write_archives(pages, folder), keep_payload=False)
    broken = F.raise_error(F.concat(F.lit("unreadable record in "), F.col("path"), F.lit(": "), F.col("error")))
    records = records.where(F.col("error").isNotNull() | F.col("type").isin("response", "revisit"))
    return records.select("page_id", "payload_bytes", "payload_digest", F.when(F.col("error").isNotNull(), broken).otherwise(F.col("type")).alias("record_type"), "refers_to")
