"""URL columns: parts, archive sort keys and playback addresses."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from arkspark.functions.scalars import bind

#: scheme, host, port, path, query.
PARTS = r"^(?:([A-Za-z][A-Za-z0-9+.-]*)://)?(?:[^/@?#]*@)?([^:/?#]*)(?::([0-9]+))?([^?#]*)(\?[^#]*)?"
IPV4 = r"^((25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])\.){3}(25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])$"


def _part(url: Column, n: int) -> Column:
    return F.regexp_extract(url, PARTS, n)


def scheme(url: Column) -> Column:
    return F.lower(_part(url, 1))


def host(url: Column) -> Column:
    return F.lower(_part(url, 2))


def port(url: Column) -> Column:
    """The port as text, empty where it is the scheme's own."""
    own = F.when(scheme(url) == "http", "80").when(scheme(url) == "https", "443").otherwise("")
    return F.when(_part(url, 3) == own, "").otherwise(_part(url, 3))


def path(url: Column) -> Column:
    return F.when(_part(url, 4) == "", "/").otherwise(_part(url, 4))


def query(url: Column) -> Column:
    """With its question mark; empty for none and for a mark alone."""
    return F.when(_part(url, 5) == "?", "").otherwise(_part(url, 5))


def host_to_surt(name: Column) -> Column:
    return F.array_join(F.reverse(F.split(name, r"\.")), ",")


def massage_host(name: Column) -> Column:
    return F.regexp_replace(name, r"^(www[0-9]*\.)+", "")


def simple_urlkey(url: Column) -> Column:
    bare = F.regexp_replace(host(url), r"^www[0-9]*\.", "")
    way = F.when((query(url) == "") & (path(url) != "/"), F.regexp_replace(path(url), "/$", "")).otherwise(path(url))
    at = F.when(port(url) != "", F.concat(F.lit(":"), port(url))).otherwise("")
    return F.concat(host_to_surt(bare), at, F.lit(")"), F.lower(F.concat(way, query(url))))


def urlkey_to_url(key: Column) -> Column:
    front = F.substring_index(key, ")", 1)
    names = F.array_join(F.reverse(F.split(F.substring_index(front, ":", 1), ",")), ".")
    at = F.regexp_extract(front, "(:[^:]*)$", 1)
    return F.concat(F.lit("http://"), names, at, F.regexp_replace(key, r"^[^)]*\)", ""))


def slash_match(capture: Column, request: Column, mode: str, status: Column) -> Column:
    """Whether a capture's path fits the requested one; modes strict, strictWithValid and lax. A null status isn't valid."""
    if mode == "lax":
        return F.lit(True)
    a, b = F.lower(path(capture)), F.lower(path(request))
    if mode == "strict":
        return a == b
    slash = (F.concat(a, F.lit("/")) == b) | (F.concat(b, F.lit("/")) == a)
    return (a == b) | (slash & F.coalesce(status.cast("string").startswith("2"), F.lit(False)))


def is_ipv4(url: Column) -> Column:
    return F.coalesce(host(url).rlike(IPV4), F.lit(False))


def mirror_host(url: Column) -> Column:
    return F.regexp_replace(url, r"^(http://)?(https://)?(www\.)?", "")


def playback(url: Column) -> Column:
    """struct(timestamp, original_url) of a playback address, else null."""
    pattern = r"https?://web\.archive\.org/web/([0-9]+)(?:[a-z]{2}_)?/(.*)"
    original = F.regexp_extract(url, pattern, 2)
    return F.when(original != "", F.struct(F.regexp_extract(url, pattern, 1).alias("timestamp"), original.alias("original_url")))


def strip_playback(url: Column, location: Column) -> Column:
    """A redirect target without its playback prefix; relative ones also lose the capture's own origin."""
    absolute = location.rlike("^https?://")
    origin = F.concat(scheme(url), F.lit("://"), host(url), F.when(port(url) != "", F.concat(F.lit(":"), port(url))).otherwise(""))
    default = F.when(port(url) == "", F.when(scheme(url) == "http", ":80").when(scheme(url) == "https", ":443").otherwise("")).otherwise("")
    rest = F.regexp_replace(location, r"^/web/[0-9]+[^/]*/", "")
    full = F.concat(origin, default)
    cut = F.when(rest.startswith(full), F.substring(rest, F.length(full) + 1, F.length(rest))).when(rest.startswith(origin), F.substring(rest, F.length(origin) + 1, F.length(rest))).otherwise(rest)
    return F.when(absolute, F.regexp_replace(location, r"^https?://web\.archive\.org/web/[0-9]+[^/]*/", "")).otherwise(cut)


def link_header(value: Column) -> Column:
    """array<struct<url, rel, type>> of a Link header."""
    parts = F.filter(F.split(value, r",\s*(?=<)"), lambda p: p.contains("<"))
    attribute = lambda p, name: F.nullif(F.regexp_extract(p, f'{name}="([^"]*)"', 1), F.lit(""))
    return F.transform(parts, lambda p: F.struct(F.regexp_extract(p, "<([^>]*)>", 1).alias("url"), attribute(p, "rel").alias("rel"), attribute(p, "type").alias("type")))


def reorder_query(text: Column) -> Column:
    """Pairs of a query without its mark, by key, then value; a key without a value first."""
    pairs = F.transform(F.split(text, "&"), lambda p: F.struct(F.substring_index(p, "=", 1).alias("k"), F.when(p.contains("="), F.regexp_replace(p, "^[^=]*=", "")).alias("v")))
    return F.array_join(F.transform(F.array_sort(pairs), lambda p: F.concat(p["k"], F.when(p["v"].isNotNull(), F.concat(F.lit("="), p["v"])).otherwise(""))), "&")


#: Session ids in queries, each with what comes before and after kept.
SESSION_IDS = (
    r"(?i)^(.+?)jsessionid=[0-9a-z]{32}(?:&(.*))?$",
    r"(?i)^(.+?)phpsessid=[0-9a-z]{32}(?:&(.*))?$",
    r"(?i)^(.+?)sid=[0-9a-z]{32}(?:&(.*))?$",
    r"(?i)^(.+?)aspsessionid[a-z]{8}=[a-z]{24}(?:&(.*))?$",
    r"(?i)^(.+?)cfid=[^&]+&cftoken=[^&]+(?:&(.*))?$",
)


def strip_session_ids(text: Column) -> Column:
    for pattern in SESSION_IDS:
        text = F.regexp_replace(text, pattern, "$1$2")
    return text


def strip_path_session(text: Column) -> Column:
    text = F.regexp_replace(text, r"(?i)^(.*/)\((?:[a-z]\([0-9a-z]{24}\))+\)/([^?]+\.aspx.*)$", "$1$2")
    return F.regexp_replace(text, r"(?i)^(.*/)\([0-9a-z]{24}\)/([^?]+\.aspx.*)$", "$1$2")


def normalise_path(text: Column) -> Column:
    """Without ``.`` segments; ``..`` takes back the segment before it, an empty one too, or stays at the root; of the
    rest, empty segments go but for the last."""
    segments = F.slice(F.split(text, "/"), F.lit(2), F.size(F.split(text, "/")))
    keep = F.aggregate(
        segments,
        F.array().cast("array<string>"),
        lambda done, s: F.when(s == ".", done).when((s == "..") & (F.size(done) > 0), F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0)))).otherwise(F.array_append(done, s)),
    )
    inner = lambda k: F.filter(F.slice(k, F.lit(1), F.greatest(F.size(k) - 1, F.lit(0))), lambda s: s != "")
    return bind(keep, lambda k: F.concat(F.lit("/"), F.array_join(F.transform(inner(k), lambda s: F.concat(s, F.lit("/"))), ""), F.coalesce(F.get(k, F.size(k) - 1), F.lit(""))))


def dotted_ipv4(name: Column) -> Column:
    """A host given as one integer, or as four octal or decimal numbers, as dotted IPv4; other hosts as they are."""
    n = F.when(name.rlike("^[0-9]{1,10}$"), name.try_cast("bigint"))
    whole = bind(n, lambda n: F.when(n < (1 << 32), F.concat_ws(".", *(F.shiftright(n, s).bitwiseAND(255).cast("string") for s in (24, 16, 8, 0)))))
    quad = F.split(name, r"\.")
    octal = F.transform(quad, lambda x: F.conv(x, 8, 10).try_cast("bigint"))
    decimal = F.transform(quad, lambda x: x.try_cast("bigint"))
    numbers = F.when(name.rlike(r"^0[0-7]*(\.[0-7]{1,9}){3}$"), octal).when(name.rlike(r"^[1-9][0-9]*(\.[0-9]{1,9}){3}$"), decimal)
    four = bind(numbers, lambda q: F.when(F.forall(q, lambda x: x.between(0, 255)), F.array_join(q.cast("array<string>"), ".")))
    return F.coalesce(whole, four, name)


_ESCAPES = re.compile("((?:%[0-9a-fA-F]{2})+)")


def _unescape(text: str | None) -> str | None:
    """Percent escapes undone again and again, until none is left. A run that is no UTF-8 loses those of ASCII only."""
    while text and "%" in text:
        before = text
        text = _ESCAPES.sub(_decode_run, text)
        if text == before:
            break
    return text


def _decode_run(match: re.Match) -> str:
    run = bytes.fromhex(match[1].replace("%", ""))
    try:
        return run.decode("utf-8")
    except UnicodeDecodeError:
        if run[0] < 128:
            return chr(run[0]) + "".join(match[1][3:])
        return match[1][:3] + (_ESCAPES.sub(_decode_run, match[1][3:]) if len(match[1]) > 3 else "")


def _escape(text: str | None) -> str | None:
    """Control characters, spaces, characters beyond ASCII, # and % as escapes."""
    return text if text is None else "".join(chr(b) if 32 < b < 128 and b not in b"#%" else f"%{b:02X}" for b in text.encode("utf-8", "surrogatepass"))


def _ascii_host(name: str | None) -> str | None:
    """A host beyond ASCII by its IDNA form; as it is if it has none."""
    text = _unescape(name)
    if text and not text.isascii():
        try:
            return text.encode("idna").decode()
        except UnicodeError:
            return text
    return text


@F.pandas_udf(StringType())
def _unescaped(texts: pd.Series) -> pd.Series:
    return texts.map(_unescape)


@F.pandas_udf(StringType())
def _escaped(texts: pd.Series) -> pd.Series:
    return texts.map(_escape)


@F.pandas_udf(StringType())
def _ascii_hosts(texts: pd.Series) -> pd.Series:
    return texts.map(_ascii_host)


#: Characters that make a part go through Python: escapes, and what has to be escaped. All else stays in the JVM.
_ODD = r"[%#\x00-\x20\u0080-\x{10FFFF}]"


def _oddly(text: Column, use) -> Column:
    return F.coalesce(use(F.when(text.rlike(_ODD), text)), text)


def _split(url: Column) -> Column:
    """struct of the scheme, host, port, path and query of a URL as it is written."""
    text = F.regexp_replace(F.trim(F.coalesce(url, F.lit(""))), r"[\n\r\t\u0085\u2028\u2029]+", "")
    whole = r"^(?:([a-zA-Z][a-zA-Z0-9+.-]*):)?(?://(?:[^/?#@]*@)?([^:/?#]*)(?::([^/?#]*))?)?([^?#]*)(\?[^#]*)?(?:#.*)?$"

    def parts(t: Column) -> Column:
        full = F.when(t.rlike(r"(?i)^(https?|ftp|mms|rtsp|wais)://"), t).otherwise(F.concat(F.lit("http://"), t))
        return bind(F.regexp_replace(full, r"(?i)^(https?://)/+", "$1"), lambda u: F.struct(F.lower(F.regexp_extract(u, whole, 1)).alias("scheme"), F.regexp_extract(u, whole, 2).alias("host"), F.regexp_extract(F.regexp_extract(u, whole, 3), r"^\s*\+?0*([0-9]+)", 1).alias("port"), F.regexp_extract(u, whole, 4).alias("path"), F.regexp_extract(u, whole, 5).alias("query")))

    return bind(text, parts)


def _plain_host(host: Column) -> Column:
    """A host without stray dots, and as dotted IPv4 if it is a number."""
    return F.lower(bind(F.regexp_replace(F.replace(F.regexp_replace(host, r"^\.+", ""), F.lit(".."), F.lit(".")), r"\.$", ""), dotted_ipv4))


def _joined(scheme: Column, host: Column, port: Column, path: Column, query: Column) -> Column:
    own = F.when(scheme == "http", "80").when(scheme == "https", "443").otherwise("")
    at = F.when((port == "") | (port == own), "").otherwise(F.concat(F.lit(":"), port))
    way = bind(strip_path_session(F.lower(path)), lambda w: F.when(F.length(w) > 1, F.regexp_replace(w, "/$", "")).otherwise(w))
    sorted_query = lambda q: F.when(F.length(q) > 1, F.concat(F.lit("?"), reorder_query(F.substring(q, F.lit(2), F.length(q))))).otherwise(q)
    ask = F.when(F.length(query) > 1, bind(F.lower(strip_session_ids(query)), sorted_query)).otherwise("")
    return F.concat(host_to_surt(massage_host(host)), at, F.lit(")"), way, ask)


def _special(url: Column, made: Column) -> Column:
    """``made``, but for URLs that have no key of that form."""
    return (
        F.when(F.coalesce(url, F.lit("")) == "", "-")
        .when(url.rlike("^(filedesc|warcinfo)"), url)
        .when(url.startswith("dns:"), F.concat(host_to_surt(F.regexp_replace(url, "^dns:", "")), F.lit(")")))
        .when(F.trim(url).rlike("^(dns|filedesc|warcinfo):"), url)
        .otherwise(made)
    )


def wayback_urlkey(url: Column) -> Column:
    """Full archive sort key of a URL without escapes and without characters beyond ASCII; null for one with such: see wayback_urlkeys."""

    def made(p: Column) -> Column:
        odd = F.concat(p["host"], p["path"], p["query"]).rlike(_ODD)
        return F.when(~odd, bind(F.struct(_plain_host(p["host"]).alias("host"), normalise_path(p["path"]).alias("path")), lambda c: _joined(p["scheme"], c["host"], p["port"], c["path"], p["query"])))

    return _special(url, bind(_split(url), made))


def wayback_urlkeys(df, url: str = "url", key: str = "urlkey"):
    """``df`` with the full archive sort key of each URL.

    Host and query are put into one form (escapes, IDNA, IP addresses), the path normalised, "www" prefixes, user, default port, session
    ids and a trailing slash dropped, and the query sorted. Empty URLs give "-", host look-ups the host's key, and descriptions of
    archives themselves. Parts without escapes or characters beyond ASCII never leave the JVM.
    """
    df = df.withColumn("_p", _split(F.col(url)))
    df = df.withColumns({"_host": _oddly(F.col("_p.host"), _ascii_hosts), "_path": _oddly(F.col("_p.path"), _unescaped), "_query": _oddly(F.col("_p.query"), _unescaped)})
    df = df.withColumns({"_host": _plain_host(F.col("_host")), "_path": normalise_path(F.col("_path"))})
    df = df.withColumns({name: _oddly(F.col(name), _escaped) for name in ("_host", "_path", "_query")})
    return df.withColumn(key, _special(F.col(url), _joined(F.col("_p.scheme"), F.col("_host"), F.col("_p.port"), F.col("_path"), F.col("_query")))).drop("_p", "_host", "_path", "_query")
