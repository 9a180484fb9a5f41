"""Joins between indexes, enrichment periods and mirrors."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arkspark.operators.ordinals import ordinals


def _same(a: str, b: str, *columns: str):
    out = F.lit(True)
    for c in columns:
        out = out & F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}"))
    return out


def merge_archives(copies: DataFrame, crawls: DataFrame) -> DataFrame:
    """Crawl rows with ``copy_ord``, the first copy that is equal in (ts14, url, status, digest, length) or, failing
    that, in all but the digest; nulls are equal to nulls."""
    def first_by(*columns: str) -> DataFrame:
        return copies.groupBy(*columns).agg(F.min("ord").alias("copy_ord"))

    exact, loose = ("ts14", "url", "status", "digest", "length"), ("ts14", "url", "status", "length")
    a = crawls.alias("c").join(first_by(*exact).alias("w"), _same("c", "w", *exact), "left").select("c.*", F.col("w.copy_ord").alias("exact_ord"))
    b = a.alias("c").join(first_by(*loose).alias("w"), _same("c", "w", *loose), "left").select("c.*", F.col("w.copy_ord").alias("loose_ord"))
    return b.withColumn("copy_ord", F.coalesce("exact_ord", "loose_ord")).withColumn("match", F.when(F.col("exact_ord").isNotNull(), "exact").when(F.col("loose_ord").isNotNull(), "loose").otherwise("none")).drop("exact_ord", "loose_ord")


def apply_patches(index: DataFrame, patches: DataFrame, columns: tuple[str, ...] = ("status", "digest")) -> DataFrame:
    """Index rows with patched columns by (url, ts14); the row as it was stays in ``unpatched``, null without a patch."""
    p = patches.select(F.col("url").alias("p_url"), F.col("ts14").alias("p_ts"), *(F.col(c).alias("p_" + c) for c in columns))
    rows = index.join(p, (F.col("url") == F.col("p_url")) & (F.col("ts14") == F.col("p_ts")), "left")
    hit = F.col("p_url").isNotNull()
    before = F.when(hit, F.struct(*(F.col(c) for c in columns)))
    return rows.select(*(F.coalesce("p_" + c, c).alias(c) if c in columns else F.col(c) for c in index.columns), before.alias("unpatched"))


def resolve_revisits(rows: DataFrame) -> DataFrame:
    """Revisit rows (refers_url, refers_ts not null) get status and digest of the first row of that address and stamp.

    One hop over the rows as they come; ``error`` tells of a target that is missing or is itself a revisit. Rows that refer to nothing are spread by ord: by
    their null address alone, all would be in one task.
    """
    to = rows.groupBy("url", "ts14").agg(F.min_by(F.struct("ord", "status", "digest", F.col("refers_url").isNotNull().alias("again")), "ord").alias("t"))
    refers = F.col("refers_url").isNotNull() & F.col("refers_ts").isNotNull()
    placed = rows.withColumn("_place", F.when(refers, F.xxhash64("refers_url", "refers_ts")).otherwise(F.xxhash64("ord")))
    targets = to.withColumn("_place", F.xxhash64("url", "ts14"))
    out = placed.alias("r").join(targets.alias("o"), (F.col("r._place") == F.col("o._place")) & (F.col("r.refers_url") == F.col("o.url")) & (F.col("r.refers_ts") == F.col("o.ts14")), "left")
    revisit = F.col("r.refers_url").isNotNull()
    error = F.when(revisit & F.col("o.t").isNull(), "missing").when(revisit & F.col("o.t.again"), "chain")
    return out.select("r.ord", "r.url", "r.ts14", F.when(revisit & F.col("o.t").isNotNull(), F.col("o.t.status")).otherwise(F.col("r.status")).alias("status"), F.when(revisit & F.col("o.t").isNotNull(), F.col("o.t.digest")).otherwise(F.col("r.digest")).alias("digest"), F.col("o.t.ord").alias("target_ord"), error.alias("error"))


def expand_mirrors(requests: DataFrame, mirrors: DataFrame) -> DataFrame:
    """Requests and, for each mirror of their host, a request at the mirror with bounds clamped to both.

    requests: url, host, rest, min_ts, max_ts; mirrors: host, mirror_host, min_ts, max_ts. The original has is_mirror false.
    """
    m = mirrors.select(F.col("host").alias("m_host"), "mirror_host", F.col("min_ts").alias("m_min"), F.col("max_ts").alias("m_max"))
    more = requests.join(m, F.col("host") == F.col("m_host")).select(F.concat(F.lit("http://"), "mirror_host", "rest").alias("url"), F.greatest("min_ts", "m_min").alias("min_ts"), F.least("max_ts", "m_max").alias("max_ts"), F.lit(True).alias("is_mirror"))
    return requests.select("url", "min_ts", "max_ts", F.lit(False).alias("is_mirror")).unionByName(more).distinct()


def widen_prefixes(queries: DataFrame) -> DataFrame:
    """One row per prefix with the widest bounds; a null bound is open and wins."""
    bound = lambda f, c: F.when(F.bool_or(F.col(c).isNull()), None).otherwise(f(c)).alias(c)
    return queries.groupBy("prefix").agg(bound(F.min, "min_ts"), bound(F.max, "max_ts"))


def repair_shared(rows: DataFrame) -> DataFrame:
    """Rows of a digest that a corrupt row shares take sha and type of the digest's first clean row; adds ``repaired``."""
    clean = rows.where(~F.col("corrupt")).groupBy("digest").agg(F.min_by(F.struct("ord", "sha", "type"), "ord").alias("c"))
    taint = rows.groupBy("digest").agg(F.max("corrupt").alias("t"))
    out = rows.join(taint, "digest").join(clean, "digest", "left")
    fix = F.col("t") & ~F.col("corrupt") & F.col("c").isNotNull() & (F.col("ord") != F.col("c.ord"))
    return out.select("ord", "digest", F.when(fix, F.col("c.sha")).otherwise(F.col("sha")).alias("sha"), F.when(fix, F.col("c.type")).otherwise(F.col("type")).alias("type"), fix.alias("repaired"))


def positional(left: DataFrame, right: DataFrame, key: str = "request_url", compared: tuple[str, ...] = ("ts14", "digest")) -> DataFrame:
    """Rows at the same place, by (ts14, ord), of two listings of a request; ``ok`` says that the columns ``compared`` agree."""
    columns = ("ord", *compared)

    def numbered(df: DataFrame, prefix: str) -> DataFrame:
        return ordinals(df.select(key, "ts14", *(c for c in columns if c != "ts14")), "ts14", "ord", by=(key,), name="rn").select(key, "rn", *(F.col(c).alias(prefix + c) for c in columns))

    both = numbered(left, "a_").join(numbered(right, "b_"), [key, "rn"], "full")
    return both.withColumn("ok", reduce(lambda a, b: a & b, (F.col(f"a_{c}").eqNullSafe(F.col(f"b_{c}")) for c in compared)))


def complete_offsets(rows: DataFrame, third: DataFrame, item: str = "nlaweb") -> DataFrame:
    """``rows`` (ts14, url, digest, length, offset, collections array) of that item's collection without an offset take the first of an index's rows
    that are equal in stamp, URL, digest and length; nulls are equal to nulls."""
    keys = ("ts14", "url", "digest", "length")
    found = third.groupBy(*keys).agg(F.min_by("offset", "ord").alias("_offset"))
    out = rows.alias("a").join(found.alias("b"), _same("a", "b", *keys), "left").select("a.*", "b._offset")
    wanted = F.col("offset").isNull() & F.coalesce(F.array_contains("collections", item), F.lit(False))
    return out.withColumn("offset", F.when(wanted, F.col("_offset")).otherwise(F.col("offset"))).drop("_offset")


def match_record_index(captures: DataFrame, index: DataFrame) -> DataFrame:
    """``captures`` with record_offset, record_path and record_error: the first row of an archive file's own index (path, ord, offset) that is equal in stamp, URL, digest,
    length and status. No match is an error, not an end of the job."""
    keys = ("ts14", "url", "digest", "length", "status")
    found = index.groupBy(*keys).agg(F.min_by(F.struct("path", "offset"), "ord").alias("_r"))
    out = captures.alias("a").join(found.alias("b"), _same("a", "b", *keys), "left").select("a.*", "b._r")
    return out.withColumns({"record_path": F.col("_r.path"), "record_offset": F.col("_r.offset"), "record_error": F.when(F.col("_r").isNull(), F.lit("no matching index row"))}).drop("_r")


def additional_urls(inputs: DataFrame) -> DataFrame:
    """A request for each additional URL of the inputs, as of a mirror: (input_id, url, is_mirror, is_additional, exclude_invalid, min_ts, max_ts, slash_mode).

    inputs: input_id, min_ts, max_ts, slash_mode, more (array<struct<url, min_ts, max_ts, slash_mode, exclude_invalid>>). Their own
    bounds and mode win; hosts that are IPv4 addresses exclude invalid captures unless told otherwise.
    """
    from arkspark.functions.urls import is_ipv4

    u = F.col("u")
    rows = inputs.select("input_id", *(F.col(c).alias("_" + c) for c in ("min_ts", "max_ts", "slash_mode")), F.explode("more").alias("u"))
    own = {c: F.coalesce(u[c], F.col("_" + c)).alias(c) for c in ("min_ts", "max_ts", "slash_mode")}
    return rows.select("input_id", u["url"].alias("url"), F.lit(True).alias("is_mirror"), F.lit(True).alias("is_additional"), F.coalesce(u["exclude_invalid"], is_ipv4(u["url"])).alias("exclude_invalid"), *own.values())


def parent_collections(items: DataFrame) -> DataFrame:
    """(item, collections array<struct<id, title, description>>): the known collections of each item (item, parents, title, description) in the order given, without the
    general one that all belong to. ``parents`` is an array, of one for a single collection."""
    each = items.select("item", F.posexplode(F.coalesce("parents", F.array().cast("array<string>"))).alias("at", "parent")).where("parent <> 'web'")
    known = items.select(F.col("item").alias("parent"), "title", "description")
    found = each.join(known, "parent").groupBy("item").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", F.col("parent").alias("id"), "title", "description"))), lambda x: F.struct(x["id"].alias("id"), x["title"].alias("title"), x["description"].alias("description"))).alias("collections"))
    empty = F.array().cast("array<struct<id:string,title:string,description:string>>")
    return items.select("item").join(found, "item", "left").select("item", F.coalesce("collections", empty).alias("collections"))


def with_collection_info(rows: DataFrame, collections: DataFrame, info: DataFrame, sizes: DataFrame) -> DataFrame:
    """``rows`` (collection) with a struct ``collection_info``: title and publication date in their usual forms, bounds, and numbers of pages.

    collections: id, name, from, to; info: id, title, date ("January 2, 2006"), summary; sizes: id, pages, urls, digests. Unknown ones
    stay null.
    """
    from arkspark.functions.scalars import crawl_title

    known = collections.alias("c").join(info.alias("i"), F.col("c.id") == F.col("i.id"), "left").join(sizes.alias("s"), F.col("c.id") == F.col("s.id"), "left")
    published = F.to_date(F.try_to_timestamp("i.date", F.lit("MMMM d, yyyy"))).cast("string")
    told = F.struct(F.col("c.id").alias("id"), crawl_title(F.coalesce("i.title", "c.name")).alias("title"), published.alias("publish_date"), F.col("c.from").alias("from"), F.col("c.to").alias("to"), F.col("i.summary").alias("description"), F.col("s.pages").alias("pages"), F.col("s.urls").alias("urls"), F.col("s.digests").alias("digests"))
    return rows.join(known.select(F.col("c.id").alias("_id"), told.alias("collection_info")), F.col("collection") == F.col("_id"), "left").drop("_id")


def clamp_mirrors(requests: DataFrame, mirrors: DataFrame) -> DataFrame:
    """Requests and their mirrors: (input_id, url, is_mirror, exclude_invalid, min_ts, max_ts).

    A mirror (host, path_prefix or null, mirror_url, min_ts, max_ts, exclude_invalid) holds for requests (input_id, url, min_ts, max_ts) of that host, with or without
    "www.", under its path; the rest of the URL stays. Bounds are clamped to both; without a word, hosts that are IPv4 addresses exclude invalid captures. Each
    URL of an input comes once, the original before its mirrors.
    """
    from arkspark.functions.urls import is_ipv4, mirror_host

    bare = mirror_host(F.col("url"))
    r = requests.select("input_id", "url", "min_ts", "max_ts", F.regexp_extract(bare, "^([^/?#]*)", 1).alias("_host"), F.regexp_extract(bare, "^[^/?#]*(.*)$", 1).alias("_rest"))
    m = mirrors.select(mirror_host(F.col("host")).alias("_m_host"), F.coalesce("path_prefix", F.lit("")).alias("_prefix"), "mirror_url", F.col("min_ts").alias("_min"), F.col("max_ts").alias("_max"), "exclude_invalid")
    hit = r.join(m, (F.col("_host") == F.col("_m_host")) & F.col("_rest").startswith(F.col("_prefix")))
    there = F.concat(F.regexp_replace("mirror_url", "/$", ""), F.expr("substring(_rest, length(_prefix) + 1)"))
    more = hit.select("input_id", there.alias("url"), F.lit(True).alias("is_mirror"), F.coalesce("exclude_invalid", is_ipv4(there)).alias("exclude_invalid"), F.greatest("min_ts", "_min").alias("min_ts"), F.least("max_ts", "_max").alias("max_ts"))
    own = requests.select("input_id", "url", F.lit(False).alias("is_mirror"), is_ipv4(F.col("url")).alias("exclude_invalid"), "min_ts", "max_ts")
    every = own.unionByName(more)
    first = F.min(F.struct(*(F.col(c) for c in ("is_mirror", "exclude_invalid", "min_ts", "max_ts"))))
    return every.groupBy("input_id", "url").agg(first.alias("f")).select("input_id", "url", "f.is_mirror", "f.exclude_invalid", "f.min_ts", "f.max_ts")


def merge_captures(copies: DataFrame, crawls: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(captures, errors): the captures of two archives, those once that one has copied from the other.

    ``copies`` (ord, ts14, url, status, digest, length, source, item_collections, metadata, memento14, ...) in the item collection "commoncrawl" belong to the first row of ``crawls`` that
    is equal in stamp, URL, status, digest and length, or failing that in all but the digest; nulls are equal to nulls. That row gains additional_sources, metadata and
    memento14 of its first copy. Copies without such a row are errors; all other rows stay as they are.
    """
    copied = F.coalesce(F.array_contains("item_collections", "commoncrawl"), F.lit(False))
    matched = merge_archives(crawls, copies.where(copied)).withColumnRenamed("copy_ord", "crawl_ord")
    first = matched.where("crawl_ord is not null").groupBy("crawl_ord").agg(F.min_by(F.struct("source", "metadata", "memento14"), "ord").alias("_w"))
    own = crawls.join(first, crawls["ord"] == F.col("crawl_ord"), "left").drop("crawl_ord")
    own = own.withColumns({"additional_sources": F.when(F.col("_w").isNotNull(), F.array("_w.source")), "metadata": F.col("_w.metadata"), "memento14": F.col("_w.memento14")}).drop("_w")
    rest = copies.where(~copied).drop("item_collections").withColumn("additional_sources", F.lit(None).cast("array<string>"))
    errors = matched.where("crawl_ord is null").select("ord", "ts14", "url", "source", F.lit("no matching crawl row").alias("error"))
    return own.unionByName(rest, allowMissingColumns=True), errors


def expand_prefixes(queries: DataFrame, mirrors: DataFrame) -> DataFrame:
    """One row per prefix of ``queries`` (prefix, min_ts, max_ts) and of the same prefixes at ``mirrors`` (host, path_prefix, mirror_url, min_ts, max_ts), bounds clamped to the mirror's; of a
    prefix that comes several times the widest, where an open one wins."""
    from arkspark.functions.urls import mirror_host

    bare = mirror_host(F.col("prefix"))
    q = queries.select("prefix", "min_ts", "max_ts", F.regexp_extract(bare, "^([^/?#]*)", 1).alias("_host"), F.regexp_extract(bare, "^[^/?#]*(.*)$", 1).alias("_rest"))
    m = mirrors.select(mirror_host(F.col("host")).alias("_m_host"), F.coalesce("path_prefix", F.lit("")).alias("_prefix"), "mirror_url", F.col("min_ts").alias("_min"), F.col("max_ts").alias("_max"))
    hit = q.join(m, (F.col("_host") == F.col("_m_host")) & F.col("_rest").startswith(F.col("_prefix")))
    more = hit.select(F.concat("mirror_url", F.expr("substring(_rest, length(_prefix) + 1)")).alias("prefix"), F.greatest("min_ts", "_min").alias("min_ts"), F.least("max_ts", "_max").alias("max_ts"))
    return widen_prefixes(queries.select("prefix", "min_ts", "max_ts").unionByName(more))
