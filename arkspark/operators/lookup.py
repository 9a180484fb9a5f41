"""Filters and look-ups on capture indexes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arkspark.operators.ordinals import ordinals


def in_range(ts: Column, low: Column | str | None, high: Column | str | None) -> Column:
    """Inclusive range of 14-digit stamps, compared as text; a null bound is open."""
    low, high = (x if isinstance(x, Column) else F.lit(x).cast("string") for x in (low, high))
    return (low.isNull() | (ts >= low)) & (high.isNull() | (ts <= high))


def index_lookup(index: DataFrame, requests: DataFrame) -> DataFrame:
    """Rows of the index per request: equal urlkey, stamp in the request's bounds, collection in its list if it has one.

    requests: request_url, urlkey, min_ts, max_ts, collections (array or null).
    """
    rows = index.join(requests.withColumnRenamed("urlkey", "r_key"), F.col("urlkey") == F.col("r_key"))
    listed = F.col("collections").isNull() | F.coalesce(F.array_contains("collections", F.col("collection")), F.lit(False))
    return rows.where(in_range(F.col("ts14"), F.col("min_ts"), F.col("max_ts")) & listed).drop("r_key", "min_ts", "max_ts", "collections")


def covered(queries: DataFrame, coverage: DataFrame) -> DataFrame:
    """Adds ``is_covered``: some dump of the prefix has wider bounds and all the query's collections. The dumps of a prefix are one array, so that queries meet them once."""
    dumps = coverage.where("prefix is not null").groupBy(F.col("prefix").alias("c_prefix")).agg(F.collect_list(F.struct("min_ts", "max_ts", "collections")).alias("c_dumps"))
    wide = lambda c: (c["min_ts"].isNull() | (c["min_ts"] <= F.col("min_ts"))) & (c["max_ts"].isNull() | (c["max_ts"] >= F.col("max_ts")))
    lists = lambda c: c["collections"].isNull() | (F.size(F.array_except("collections", c["collections"])) == 0)
    hit = F.exists("c_dumps", lambda c: F.coalesce(wide(c) & lists(c), F.lit(False)))
    return queries.join(dumps, F.col("prefix") == F.col("c_prefix"), "left").withColumn("is_covered", F.coalesce(hit, F.lit(False))).drop("c_prefix", "c_dumps")


def with_prefixes(rows: DataFrame, prefixes: DataFrame, url: str = "url", name: str = "dumps") -> DataFrame:
    """A row for each row and each of ``prefixes`` (prefix, ``name``) that its URL begins with, by equality: URLs are cut to the lengths that prefixes have. Those lengths
    are gathered, a number each and no more than the longest prefix has letters."""
    known = prefixes.where("prefix is not null")
    lengths = sorted(r.n for r in known.select(F.length("prefix").alias("n")).distinct().collect())
    cuts = F.filter(F.array(*map(F.lit, lengths)).cast("array<int>"), lambda n: n <= F.length(url))
    return rows.withColumn("_n", F.explode(cuts)).withColumn("_cut", F.substring(F.col(url), F.lit(1), F.col("_n"))).join(known.withColumnRenamed("prefix", "_prefix"), F.col("_cut") == F.col("_prefix")).drop("_n", "_cut", "_prefix")


def overlapping(collections: DataFrame, low: str | None, high: str | None, ids: list[str] | None = None) -> DataFrame:
    """Collections (id, from_ts, to_ts) that overlap the range; those without valid ends go."""
    rows = collections.where(F.col("from_ts").isNotNull() & F.col("to_ts").isNotNull())
    if ids is not None:
        rows = rows.where(F.col("id").isin(ids))
    return rows.where((F.lit(high).cast("string").isNull() | (F.col("from_ts") <= F.lit(high))) & (F.lit(low).cast("string").isNull() | (F.col("to_ts") >= F.lit(low))))


def condition(tree: dict, params: Column) -> Column:
    """A condition on a map of query parameters: {"exists": p}, {"param": p, "matches": regex}, {"and"/"or": [...]}, {"not": {...}}."""
    if "exists" in tree:
        return F.map_contains_key(params, tree["exists"])
    if "param" in tree:
        return F.coalesce(F.try_element_at(params, F.lit(tree["param"])).rlike(tree["matches"]), F.lit(False))
    if "and" in tree:
        return reduce(lambda a, b: a & b, (condition(t, params) for t in tree["and"]))
    if "or" in tree:
        return reduce(lambda a, b: a | b, (condition(t, params) for t in tree["or"]))
    return ~condition(tree["not"], params)


def covered_exactly(queries: DataFrame, coverage: DataFrame) -> DataFrame:
    """As ``covered``, by the stricter rule: a dump with a bound covers only queries that have that bound, and within it; and of URLs that begin with the prefix."""
    dumps = coverage.where("prefix is not null").groupBy("prefix").agg(F.collect_list(F.struct("min_ts", "max_ts")).alias("dumps"))
    inside = lambda c: (c["min_ts"].isNull() | F.coalesce(F.col("min_ts") >= c["min_ts"], F.lit(False))) & (c["max_ts"].isNull() | F.coalesce(F.col("max_ts") <= c["max_ts"], F.lit(False)))
    asked = ("url", "min_ts", "max_ts")
    hits = with_prefixes(queries.select(*asked).distinct(), dumps).where(F.exists("dumps", inside)).select(*(F.col(c).alias("c_" + c) for c in asked)).distinct().withColumn("_hit", F.lit(True))
    same = reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col("c_" + c)) for c in asked))
    return queries.join(hits, same, "left").withColumn("is_covered", F.coalesce("_hit", F.lit(False))).drop("_hit", *("c_" + c for c in asked))


def split_valid(rows: DataFrame, expected: tuple[int, ...] = ()) -> DataFrame:
    """``rows`` (status, exclude_invalid, ...) with is_valid: status among those expected, or 2xx if none are. Invalid rows of requests that exclude
    them go."""
    valid = F.coalesce(F.col("status").isin(*expected) if expected else F.col("status").cast("string").startswith("2"), F.lit(False))
    return rows.withColumn("is_valid", valid).where(F.col("is_valid") | ~F.coalesce("exclude_invalid", F.lit(False)))


#: Stamps of each kind in one row of a report: a URL with more has several rows, as it may have any number.
LISTED = 1000


def split_readable(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, report): index rows without unresolvable revisits and without stamps that are no time; and per request_url the stamps of both
    kinds, sorted, null for none, ``LISTED`` in a row (``part`` from 0 on). Stamps of unavailable rows stay as they are."""
    revisit = F.coalesce(F.col("mime") == "warc/revisit", F.lit(False))
    broken = ~revisit & F.try_to_timestamp("ts14", F.lit("yyyyMMddHHmmss")).isNull() & ~F.coalesce("unavailable", F.lit(False))
    kind = F.when(revisit, "unresolvable_revisits").when(broken, "invalid_timestamps")
    odd = rows.select("request_url", kind.alias("kind"), F.coalesce("ts14", F.lit("")).alias("ts")).where("kind is not null")
    placed = ordinals(odd, "ts", by=("request_url", "kind")).withColumn("part", F.expr(f"(place - 1) div {LISTED}"))
    told = lambda k: F.array_sort(F.collect_list(F.when(F.col("kind") == k, F.col("ts")))).alias(k)
    report = placed.groupBy("request_url", "part").agg(told("unresolvable_revisits"), told("invalid_timestamps"))
    return rows.where(~revisit & ~broken), report.select("request_url", "part", *(F.when(F.size(k) > 0, F.col(k)).alias(k) for k in ("unresolvable_revisits", "invalid_timestamps")))


def slash_filter(rows: DataFrame, mode: str) -> tuple[DataFrame, DataFrame]:
    """(rows whose slash matches, per request_url how many didn't)."""
    from arkspark.functions.urls import slash_match

    fits = slash_match(F.col("url"), F.col("request_url"), mode, F.col("status"))
    marked = rows.withColumn("_fits", fits)
    return marked.where("_fits").drop("_fits"), marked.groupBy("request_url").agg(F.count_if(~F.col("_fits")).alias("rejected"))


def crawl_queries(requests: DataFrame) -> DataFrame:
    """The requests that are looked up in the crawl's index: main and additional URLs, not mirrors."""
    return requests.where(~F.coalesce("is_mirror", F.lit(False)) | F.coalesce("is_additional", F.lit(False)))


def crawl_enabled(inputs: DataFrame, requests: DataFrame, prefixes: DataFrame) -> DataFrame:
    """(input_id, enabled): an input's flag is set, it names collections, or one of its URLs begins with a cached prefix."""
    hit = with_prefixes(requests.select("input_id", "url").distinct(), prefixes.select("prefix").distinct()).select("input_id").distinct().withColumn("_hit", F.lit(True))
    flag = F.coalesce("flag", F.lit(False)) | (F.coalesce(F.size("collections"), F.lit(0)) > 0) | F.coalesce("_hit", F.lit(False))
    return inputs.join(hit, "input_id", "left").select("input_id", flag.alias("enabled"))


def split_states(rows: DataFrame) -> DataFrame:
    """``rows`` (unavailable, skipped, sha256, content_size, headers, ...) with ``state``: skipped, unavailable or base. What isn't there is reset: an
    unavailable capture has no hash, no content and no headers, a skipped one no content and no headers either."""
    state = F.when(F.coalesce("skipped", F.lit(False)), "skipped").when(F.coalesce("unavailable", F.lit(False)), "unavailable").otherwise("base")
    out = rows.withColumn("state", state)
    keep = lambda c: F.when(F.col("state") == "base", F.col(c))
    return out.withColumns({c: keep(c) for c in ("sha256", "content_size", "headers")})


def filter_report(*counts: DataFrame) -> DataFrame:
    """One row per request_url with the columns of all ``counts``, 0 as null; requests of which nothing was filtered go."""
    out = reduce(lambda a, b: a.join(b, "request_url", "full"), counts)
    names = [c for c in out.columns if c != "request_url"]
    numbers = {f.name for f in out.schema if f.dataType.typeName() in ("long", "integer")}
    shown = out.select("request_url", *(F.nullif(F.col(c), F.lit(0)).alias(c) if c in numbers else F.col(c) for c in names))
    return shown.where(reduce(lambda a, b: a | b, (F.col(c).isNotNull() for c in names)))
