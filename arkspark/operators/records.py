"""Records of archive files: WARC and ARC records taken apart, their relations, repairs and descriptions."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from datetime import UTC, datetime

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arkspark.functions.scalars import bind, header_value, parse_headers

_PAIRS = "array<struct<name:string,value:string>>"
PARSED = f"kind string, record_id string, concurrent_to string, refers_to string, url string, ip string, ts string, method string, protocol string, status int, status_message string, metadata {_PAIRS}, headers {_PAIRS}, content binary, error string"
_PAIR_TYPE = pa.list_(pa.struct([("name", pa.string()), ("value", pa.string())]))
_TYPES = [pa.string()] * 9 + [pa.int32(), pa.string(), _PAIR_TYPE, _PAIR_TYPE, pa.binary(), pa.string()]
_PARSED_NAMES = [c.split()[0] for c in PARSED.split(", ")]

#: How records of some collections differ from what their headers say.
COLLECTION_QUIRKS = (
    {"collection": "CC-MAIN-2008-2009", "metadata_prefixes": ["x_commoncrawl_", "x-commoncrawl-"], "local_time": True, "implicit_redirects": True, "dechunked": True, "trailing_newline": False, "extra_blank_line": False},
    {"collection": "CC-MAIN-2009-2010", "metadata_prefixes": ["x_commoncrawl_", "x-commoncrawl-"], "local_time": True, "implicit_redirects": True, "dechunked": True, "trailing_newline": False, "extra_blank_line": False},
    {"collection": "CC-MAIN-2012", "metadata_prefixes": ["x_commoncrawl_", "x-commoncrawl-"], "local_time": False, "implicit_redirects": False, "dechunked": True, "trailing_newline": True, "extra_blank_line": False},
    {"collection": "CC-MAIN-2018-34", "metadata_prefixes": [], "local_time": False, "implicit_redirects": False, "dechunked": False, "trailing_newline": False, "extra_blank_line": True},
)
#: Tags of an ARC file's description, in the order of their output; a prefix is not shown.
ARC_TAGS = ("arc:software", "arc:hostname", "arc:ip", "dcterms:isPartOf", "dc:description", "ns0:date", "arc:operator", "arc:http-header-user-agent", "arc:http-header-from", "arc:robots", "dc:format", "dcterms:conformsTo")
#: How far before and after a response its related records may lie, in bytes.
NEARBY = 512_000
#: Bytes of records and rows that a task takes apart at once: their parts are held beside them.
_PIECE, _ROWS = 4 << 20, 256


class RecordError(ValueError):
    pass


def _pairs(lines: list[str]) -> list[dict[str, str]]:
    cut = [x.partition(":") for x in lines if ":" in x]
    return [{"name": name.strip(), "value": value.strip()} for name, _, value in cut]


def _first(pairs: list[dict[str, str]], name: str) -> str | None:
    return next((p["value"] for p in pairs if p["name"].lower() == name), None)


def _number(text: str | None, what: str) -> int:
    digits = (text or "").strip()
    head = digits[: len(digits) - len(digits.lstrip("0123456789"))]
    if not head:
        raise RecordError(f"{what} is not a number")
    return int(head)


def dechunk(body: bytes) -> bytes:
    """The content of a chunked body."""
    out, at = [], 0
    while at < len(body):
        end = body.find(b"\r\n", at)
        if end < 0:
            raise RecordError("a chunk has no size")
        size = body[at:end].split(b";")[0]
        if not size or size.strip(b"0123456789abcdefABCDEF"):
            raise RecordError("a chunk's size is not a number")
        n, start = int(size, 16), end + 2
        if n == 0:
            break
        if start + n > len(body) or body[start + n : start + n + 2] != b"\r\n":
            raise RecordError("a chunk ends before its size")
        out.append(body[start : start + n])
        at = start + n + 2
    return b"".join(out)


def unpack_content(body: bytes, headers: list[dict[str, str]], dechunked: bool = False) -> bytes:
    """Without chunks, then without gzip, each only as the headers say; what isn't packed in spite of them stays."""
    if not dechunked and any(h["name"].lower() == "transfer-encoding" and h["value"].lower() == "chunked" for h in headers):
        body = dechunk(body)
    if body[:2] == b"\x1f\x8b" and any(h["name"].lower() == "content-encoding" and h["value"].lower() == "gzip" for h in headers):
        try:
            return zlib.decompress(body, wbits=31)
        except zlib.error:
            return body
    return body


def _http(block: bytes, divider: int) -> tuple[list[str], list[dict[str, str]], bytes]:
    end = block.find(b"\r\n\r\n")
    if end < 0:
        raise RecordError("no HTTP headers")
    first, *lines = block[:end].decode("latin-1").split("\r\n")
    return first.split(" "), _pairs(lines), block[end + divider :]


#: Record types by WARC-Type; any other is unknown.
WARC_KINDS = {"warcinfo": "warc-info", "request": "warc-request", "response": "warc", "revisit": "warc"}


def parse_warc(record: bytes, extra_blank_line: bool = False) -> dict:
    end = record.find(b"\r\n\r\n")
    if end < 0:
        raise RecordError("no record headers")
    version, *lines = record[:end].decode("latin-1").split("\r\n")
    if not version.startswith("WARC/"):
        raise RecordError("no WARC version")
    metadata = _pairs(lines)
    kind, url = (_first(metadata, "warc-type") or "").strip().lower(), (_first(metadata, "warc-target-uri") or "").removeprefix("<").removesuffix(">")
    block = record[end + 4 : end + 4 + _number(_first(metadata, "content-length"), "Content-Length")]
    out = {
        "kind": WARC_KINDS.get(kind, "warc-unknown"), "record_id": _first(metadata, "warc-record-id"), "concurrent_to": _first(metadata, "warc-concurrent-to"), "refers_to": _first(metadata, "warc-refers-to"),
        "url": url, "ip": _first(metadata, "warc-ip-address"), "ts": _first(metadata, "warc-date"), "metadata": metadata, "headers": [], "content": block, "status": 0, "status_message": "", "protocol": "", "method": "",
    }
    if kind in ("response", "revisit") and not url.startswith("dns:"):
        first, headers, body = _http(block, 6 if extra_blank_line else 4)
        out |= {"protocol": first[0], "status": _number(first[1] if len(first) > 1 else None, "the status"), "status_message": " ".join(first[2:]), "headers": headers, "content": unpack_content(body, headers)}
    elif kind == "request":
        first, headers, body = _http(block, 4)
        out |= {"method": first[0], "protocol": first[2] if len(first) > 2 else None, "headers": headers, "content": body}
    return out


def parse_arc(record: bytes, trailing_newline: bool = False, dechunked: bool = False) -> dict:
    end = record.find(b"\n")
    if end < 0:
        raise RecordError("no ARC header")
    fields = record[:end].decode("latin-1").strip().split(" ")
    if len(fields) not in (5, 10):
        raise RecordError(f"an ARC header of {len(fields)} fields")
    length = _number(fields[-1], "the length")
    url, ip, stamp = fields[:3]
    if url.startswith("filedesc:"):
        return {"kind": "arc-header", "url": url, "ip": ip, "ts": _arc_time(stamp), "metadata": [], "headers": [], "content": record[end + 1 :], "status": 0, "status_message": "", "protocol": "", "method": ""}
    length -= bool(trailing_newline)
    if end + 1 + length > len(record):
        raise RecordError("the content is longer than the record")
    first, headers, body = _http(record[end + 1 : end + 1 + length], 4)
    return {
        "kind": "arc", "url": url, "ip": ip, "ts": _arc_time(stamp), "protocol": first[0], "status": _number(first[1] if len(first) > 1 else None, "the status"), "status_message": " ".join(first[2:]), "method": "",
        "metadata": [], "headers": headers, "content": unpack_content(body, headers, dechunked),
    }


def _arc_time(stamp: str) -> str:
    try:
        return datetime.strptime(stamp, "%Y%m%d%H%M%S").replace(tzinfo=UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    except ValueError:
        return stamp


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches' rows in pieces of about ``_PIECE`` bytes of records, ``_ROWS`` rows at most, one row at least."""
    for batch in batches:
        sizes = pc.binary_length(batch.column("record")).fill_null(0).to_pylist()
        start = held = 0
        for at, size in enumerate(sizes):
            if at > start and (held + size > _PIECE or at - start == _ROWS):
                yield batch.slice(start, at - start)
                start, held = at, 0
            held += size
        if start < len(sizes):
            yield batch.slice(start)


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _pieces(batches):
        flags = [batch.column(c).to_pylist() for c in ("trailing_newline", "dechunked", "extra_blank_line")]
        out = []
        for record, newline, dechunked, blank in zip(batch.column("record").to_pylist(), *flags, strict=True):
            try:
                if record is None:
                    raise RecordError("no record")
                out.append(parse_warc(record, bool(blank)) if record[:5] == b"WARC/" else parse_arc(record, bool(newline), bool(dechunked)))
            except (RecordError, IndexError) as wrong:
                out.append({"error": str(wrong)})
        keep = [c for c in batch.schema.names if c not in ("record", "trailing_newline", "dechunked", "extra_blank_line")]
        parsed = [pa.array([r.get(c) for r in out], kind) for c, kind in zip(_PARSED_NAMES, _TYPES, strict=True)]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), *parsed], [*keep, *_PARSED_NAMES])


def quirks_table(spark: SparkSession) -> DataFrame:
    """One row per collection of ``COLLECTION_QUIRKS``."""
    schema = "collection string, metadata_prefixes array<string>, local_time boolean, implicit_redirects boolean, dechunked boolean, trailing_newline boolean, extra_blank_line boolean"
    columns = [c.split()[0] for c in schema.split(", ")]
    return spark.createDataFrame([tuple(q[c] for c in columns) for q in COLLECTION_QUIRKS], schema)


def split_metadata(headers: Column, prefixes: Column) -> Column:
    """A struct of the headers whose names begin with one of the prefixes (metadata) and of the others (headers)."""
    is_metadata = lambda h: F.exists(F.coalesce(prefixes, F.array().cast("array<string>")), lambda p: h["name"].startswith(p))
    return F.struct(F.filter(headers, is_metadata).alias("metadata"), F.filter(headers, lambda h: ~is_metadata(h)).alias("headers"))


def parse_records(records: DataFrame, keys: tuple[str, ...] = ("path", "offset", "length"), collection: str | None = None) -> DataFrame:
    """``keys`` and the parts of each record of ``records`` (record, keys): see ``PARSED``.

    kind is arc, arc-header, warc (responses and revisits), warc-request, warc-info or warc-unknown. A record that can't be
    taken apart gives its keys and an error. ``collection`` names a column of collections, whose quirks are then heeded:
    headers with their prefixes go to metadata, and contents are cut and unpacked as they were really written.
    """
    flags = ("trailing_newline", "dechunked", "extra_blank_line")
    df = records.select(*keys, "record", *([F.col(collection).alias("_collection")] if collection else []))
    if collection:
        # A table of as many rows as the constant has.
        df = df.join(F.broadcast(quirks_table(records.sparkSession)), F.col("_collection") == F.col("collection"), "left").select(*keys, "record", "metadata_prefixes", *(F.coalesce(c, F.lit(False)).alias(c) for c in flags))
    else:
        df = df.select(*keys, "record", F.lit(None).cast("array<string>").alias("metadata_prefixes"), *(F.lit(False).alias(c) for c in flags))
    schema = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in df.schema if f.name not in ("record", *flags)), PARSED])
    parsed = df.mapInArrow(_parse, schema)
    both = split_metadata(F.col("headers"), F.col("metadata_prefixes"))
    arc = F.col("kind") == "arc"
    return parsed.withColumn("_both", both).withColumns({"metadata": F.when(arc, F.col("_both.metadata")).otherwise(F.col("metadata")), "headers": F.when(arc, F.col("_both.headers")).otherwise(F.col("headers"))}).drop("_both", "metadata_prefixes")


_RENAMED = "x-crawler-"


def restore_crawler_headers(headers: Column, metadata: Column) -> Column:
    """A struct of both arrays with ``X-Crawler-`` names undone: the header takes its old name, and one that had replaced it goes to the
    metadata under the longer name."""
    old = F.transform(F.filter(headers, lambda h: F.lower(h["name"]).startswith(_RENAMED)), lambda h: F.substring(F.lower(h["name"]), F.lit(len(_RENAMED) + 1), F.length(h["name"])))
    replaces = lambda h: F.array_contains(old, F.lower(h["name"]))
    renamed = lambda h: F.when(F.lower(h["name"]).startswith(_RENAMED), F.struct(F.substring(h["name"], F.lit(len(_RENAMED) + 1), F.length(h["name"])).alias("name"), h["value"].alias("value"))).otherwise(h)
    moved = F.transform(F.reverse(F.filter(headers, replaces)), lambda h: F.struct(F.concat(F.lit("X-Crawler-"), h["name"]).alias("name"), h["value"].alias("value")))
    return F.struct(F.transform(F.filter(headers, lambda h: ~replaces(h)), renamed).alias("headers"), F.concat(metadata, moved).alias("metadata"))


def warcinfo_fields(content: Column) -> Column:
    """array<struct<name, value>> of a warcinfo record's block, up to its first empty line."""
    return parse_headers(F.substring_index(F.decode(content, "ISO-8859-1"), "\r\n\r\n", 1))


def arc_description(content: Column) -> Column:
    """array<struct<name, value>> of the tags in an ARC file's first record; empty without its metadata element."""

    def told(text: Column) -> Column:
        found = [F.struct(F.lit(tag.rpartition(":")[2]).alias("name"), F.when(text.contains(f"</{tag}>"), F.nullif(F.regexp_extract(text, f"<{tag}.*?>(.*)</{tag}>", 1), F.lit(""))).alias("value")) for tag in ARC_TAGS]
        whole = text.contains("<arcmetadata") & text.contains("</arcmetadata>")
        return F.filter(F.when(whole, F.array(*found)).otherwise(F.array().cast("array<struct<name:string,value:string>>")), lambda p: p["value"].isNotNull())

    return bind(F.decode(content, "ISO-8859-1"), told)


def record_kind(warc_type: Column) -> Column:
    """The record type that a WARC-Type stands for."""
    kind = F.lit("warc-unknown")
    for name, value in WARC_KINDS.items():
        kind = F.when(warc_type == name, F.lit(value)).otherwise(kind)
    return kind


def truncation(content: Column, headers: Column, metadata: Column) -> Column:
    """struct<reason, downloaded_size, actual_size> of a content that was cut, else null.

    It is cut if it is shorter than its Content-Length, or if a header of the crawl says so, among the record's headers or the
    response's.
    """
    size, told = F.length(content).cast("long"), F.regexp_extract(header_value(headers, "content-length"), r"^\s*([0-9]+)", 1).try_cast("long")
    said = header_value(metadata, "x-commoncrawl-contenttruncated").isNotNull() | header_value(headers, "warc-truncated").isNotNull() | header_value(metadata, "warc-truncated").isNotNull()
    cut = lambda actual: F.struct(F.lit("truncated").alias("reason"), size.alias("downloaded_size"), actual.alias("actual_size"))
    return F.when(size < told, cut(told)).when(said, cut(F.lit(None).cast("long")))


def related_records(records: DataFrame, nearby: int = NEARBY) -> DataFrame:
    """(path, offset, related_offset, related_kind) of each response with the records near it that share an id with it.

    ``records``: path, offset, length, kind, record_id, concurrent_to, refers_to. A record is related if its id, or one that it is
    concurrent to or refers to, is one of the response's own three, and if it lies whole within ``nearby`` bytes of it. Joined by
    path and id, so that responses meet only records that name one of their ids.
    """
    ids = F.array_distinct(F.array_compact(F.array("record_id", "concurrent_to", "refers_to")))
    each = records.where("kind like 'warc%'").select("path", "offset", "length", "kind", F.explode(ids).alias("id"))
    response = each.where("kind = 'warc'").select("path", "id", F.col("offset").alias("at"), (F.col("offset") - nearby).alias("low"), (F.col("offset") + F.col("length") + nearby).alias("high"))
    met = response.join(each, ["path", "id"]).where((F.col("offset") != F.col("at")) & (F.col("offset") >= F.col("low")) & (F.col("offset") + F.col("length") <= F.col("high")))
    return met.select("path", F.col("at").alias("offset"), F.col("offset").alias("related_offset"), F.col("kind").alias("related_kind")).distinct()
