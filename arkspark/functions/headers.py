"""Headers of playback responses, and what they tell of the capture."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from arkspark.functions.scalars import header_case, header_value
from arkspark.functions.urls import strip_playback

ORIGINAL = "x-archive-orig-"
#: Prefixed headers that a crawl added, headers that playback passes on, and those with addresses in them.
ADDED = ("x-archive-orig-x_commoncrawl_", "x-archive-orig-x-commoncrawl-")
PASSED_ON = ("content-encoding", "content-disposition")
ADDRESSES = ("location", "content-location", "content-base")


def original_headers(url: Column, headers: Column, year: Column, default_mime: Column) -> Column:
    """array<struct<name, value, unconfirmed>> of the headers that the captured server sent, out of a playback response's (name, value).

    Prefixed headers lose their prefix. Of the others content type, encoding, disposition and addresses count unless they are there
    with the prefix as well; addresses lose their playback part. A content type without parameters that isn't the server's default
    (``default_mime``) may be the archive's own guess and is unconfirmed. Names are written as the server did, see ``header_case``.
    """
    server = header_value(headers, ORIGINAL + "server")
    name = lambda h: F.lower(h["name"])
    is_original = lambda h: name(h).startswith(ORIGINAL) & ~name(h).startswith(ADDED[0]) & ~name(h).startswith(ADDED[1])
    alone = lambda h: ~F.exists(headers, lambda o: name(o) == F.concat(F.lit(ORIGINAL), name(h)))
    counts = lambda h: is_original(h) | (name(h).isin("content-type", *PASSED_ON, *ADDRESSES) & alone(h))

    def cleaned(h: Column) -> Column:
        own = F.when(is_original(h), F.substring(h["name"], F.lit(len(ORIGINAL) + 1), F.length(h["name"]))).otherwise(h["name"])
        value = F.when(~is_original(h) & name(h).isin(*ADDRESSES), strip_playback(url, h["value"])).otherwise(h["value"])
        guess = ~is_original(h) & (name(h) == "content-type") & ~h["value"].contains(";") & ~F.coalesce(default_mime, F.lit(False))
        return F.struct(header_case(own, server, year).alias("name"), value.alias("value"), guess.alias("unconfirmed"))

    return F.transform(F.filter(headers, counts), cleaned)


def archive_source(headers: Column) -> Column:
    """The archive file that a playback response came from; null if the response is no capture."""
    return header_value(headers, "x-archive-src")


def iis_version(server: Column) -> Column:
    return F.nullif(F.regexp_extract(server, r"Microsoft-IIS/([0-9]+[.][0-9]+)", 1), F.lit(""))
