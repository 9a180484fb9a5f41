"""Digests, headers, MIME types, ETags and file names as column functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once.

    By ``try_element_at``, which tells its type once; ``get`` tells it again for every row, of all that is nested in it.
    """
    return F.try_element_at(F.transform(F.array(value), use), F.lit(1))


def base32_sha1(content: Column) -> Column:
    """Upper-case base32 of the SHA-1, by four groups of 40 bits."""
    text = F.sha1(content)
    groups = [F.lpad(F.conv(F.substring(text, 10 * g + 1, 10), 16, 32), 8, "0") for g in range(4)]
    return F.translate(F.upper(F.concat(*groups)), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def mime_type(content_type: Column, index_mime: Column) -> Column:
    return F.coalesce(F.nullif(F.trim(F.substring_index(content_type, ";", 1)), F.lit("")), index_mime)


def header_value(headers: Column, name: str) -> Column:
    """First value of that name, in any case, of array<struct<name, value>>."""
    return F.try_element_at(F.filter(headers, lambda h: F.lower(h["name"]) == name.lower()), F.lit(1))["value"]


def parse_headers(block: Column) -> Column:
    """array<struct<name, value>> of header lines, cut at the first colon and trimmed."""
    lines = F.filter(F.split(block, "\r\n"), lambda x: x.contains(":"))
    return F.transform(lines, lambda x: F.struct(F.trim(F.substring_index(x, ":", 1)).alias("name"), F.trim(F.regexp_replace(x, "^[^:]*:", "")).alias("value")))


def fold_headers(headers: Column) -> Column:
    """map of lower-case name to its values, joined by a comma and a space in their order."""
    names = F.array_distinct(F.transform(headers, lambda h: F.lower(h["name"])))
    return F.map_from_arrays(names, F.transform(names, lambda n: F.array_join(F.transform(F.filter(headers, lambda h: F.lower(h["name"]) == n), lambda h: h["value"]), ", ")))


#: Names that two servers write in another way than by capital initials.
SERVER_NAMES = {
    "etag": "ETag",
    "vtag": "VTag",
    "p3p": "P3P",
    "microsoftofficewebserver": "MicrosoftOfficeWebServer",
    "x-aspnet-version": "X-AspNet-Version",
    "ntcoent-length": "ntCoent-Length",
    "www-authenticate": "WWW-Authenticate",
    "x-ccc": "X-CCC",
    "x-cid": "X-CID",
    "x-meta-ms.locale": "X-Meta-MS.Locale",
}


def header_case(name: Column, server: Column, year: Column) -> Column:
    """As IIS and Apache write names; capital initials for captures before 2015; else as given."""
    capital = F.array_join(F.transform(F.split(F.lower(name), "-"), lambda p: F.concat(F.upper(F.substring(p, 1, 1)), F.substring(p, F.lit(2), F.length(p)))), "-")
    table = F.create_map(*(F.lit(x) for pair in SERVER_NAMES.items() for x in pair))
    known = F.lower(server).startswith("microsoft-iis") | F.lower(server).startswith("apache")
    return F.when(known, F.coalesce(F.try_element_at(table, F.lower(name)), capital)).when(year < 2015, capital).otherwise(name)


def lenient_int(text: Column) -> Column:
    return F.nullif(text, F.lit("-")).try_cast("bigint")


def content_length(text: Column) -> Column:
    return F.regexp_extract(text, r"^\s*([+-]?[0-9]+)", 1).try_cast("bigint")


#: Headers that tell a length before compression, in order of trust.
UNCOMPRESSED_LENGTHS = ("ntcoent-length", "x-uncompressed-content-length", "x-original-content-length", "x-decompressed-content-length", "cteonnt-length")


def uncompressed_length(headers: Column) -> Column:
    """Length of the content once unpacked, by array<struct<name, value>>; null where a packed one doesn't tell."""
    packed = F.coalesce(header_value(headers, "content-encoding") == "gzip", F.lit(False))
    return F.when(packed, F.coalesce(*(content_length(header_value(headers, n)) for n in UNCOMPRESSED_LENGTHS))).otherwise(content_length(header_value(headers, "content-length")))


def crawl_title(title: Column) -> Column:
    """A collection's title, trimmed, without a closing "Index" and with "Crawl" in it."""
    bare = F.trim(F.regexp_replace(F.trim(title), " Index$", ""))
    return F.when(bare.contains("Crawl"), bare).otherwise(F.concat(bare, F.lit(" Crawl")))


#: Characters that file names don't hold, in the order of escaping.
FILE_NAME_ESCAPES = (("~", "~~"), ("?", "~q"), ("/", "~s"), ("\\", "~b"), ("*", "~a"), (":", "~c"), ("|", "~p"), ("<", "~l"), (">", "~g"), ('"', "~'"))


def escape_file_name(text: Column) -> Column:
    for char, code in FILE_NAME_ESCAPES:
        text = F.replace(text, F.lit(char), F.lit(code))
    return text


def output_name(base: Column, params: Column, ts14: Column, counter: Column, flag: Column, ext: Column) -> Column:
    """``base params . yyyyMMdd-HHmmss [_n] [.flag] ext``; params is a map, written by key without empty values."""
    pairs = F.transform(F.filter(F.array_sort(F.map_entries(params)), lambda e: F.coalesce(e["value"], F.lit("")) != ""), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    written = F.when(F.size(pairs) > 0, escape_file_name(F.concat(F.lit("?"), F.array_join(pairs, "&")))).otherwise("")
    stamp = F.when(F.length(ts14) == 14, F.concat(F.substring(ts14, 1, 8), F.lit("-"), F.substring(ts14, 9, 6))).otherwise(F.coalesce(ts14, F.lit("19700101-000000")))
    count = F.when(counter.isNotNull(), F.concat(F.lit("_"), counter.cast("string"))).otherwise("")
    return F.concat(escape_file_name(base), written, F.lit("."), stamp, count, F.when(flag.isNotNull(), F.concat(F.lit("."), flag)).otherwise(""), escape_file_name(ext))


_EPOCH_TICKS = 116444736000000000


def iis_etag(seconds: Column, nanos: Column, change: Column) -> Column:
    """ETag of a modification time: eight bytes of the 100 ns ticks since 1601, lowest first, without leading zeros each."""
    ticks = seconds.cast("bigint") * 10_000_000 + F.floor(nanos / 100).cast("bigint") + _EPOCH_TICKS
    digits = [F.lower(F.hex(F.shiftright(ticks, 8 * i).bitwiseAND(255))) for i in range(8)]
    plain = [F.when(F.length(d) > 1, F.regexp_replace(d, "^0(.)$", "$1")).otherwise(d) for d in digits]
    return F.concat(F.lit('"'), *plain, F.lit(":"), F.lower(F.hex(change)), F.lit('"'))


def earliest(*stamps: Column) -> Column:
    """The least of stamps; null and empty ones don't count."""
    return F.least(*(F.nullif(s, F.lit("")) for s in stamps))


def latest(*stamps: Column) -> Column:
    return F.greatest(*(F.nullif(s, F.lit("")) for s in stamps))
