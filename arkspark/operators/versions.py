"""Versions to write, their names, and the summaries beside them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arkspark.functions.scalars import escape_file_name
from arkspark.operators.documents import correction_names


def output_versions(rows: DataFrame, deduplicate: bool = True) -> DataFrame:
    """The rows to write: the first, by (ts14, ord), of each content and modification time of an input, of any type; contents with a dated version
    have no undated one. All rows if they aren't deduplicated. rows: input_id, ts14, ord, sha256, modified14, ..."""
    if not deduplicate:
        return rows
    dated = rows.groupBy("input_id", "sha256").agg(F.bool_or(F.col("modified14").isNotNull() & F.col("sha256").isNotNull()).alias("_dated"))
    own = (F.col("r.input_id") == F.col("d.input_id")) & F.col("r.sha256").eqNullSafe(F.col("d.sha256"))
    kept = rows.alias("r").join(dated.alias("d"), own).where(F.col("r.modified14").isNotNull() | ~F.col("d._dated")).select("r.*")
    keys = ("input_id", "sha256", "modified14")
    first = F.min_by(F.struct(*(F.col(c) for c in rows.columns if c not in keys)), F.struct("ts14", "ord"))
    found = kept.groupBy(*keys).agg(first.alias("f"))
    return found.select(*(F.col(c) if c in keys else F.col(f"f.{c}").alias(c) for c in rows.columns))


def shorten_params(params: Column, rules: list[dict]) -> Column:
    """struct<params, shortened>: query parameters rewritten by rules {name, output_name, output_value, pattern, groups, required}.

    The groups that the pattern finds in a value are joined by hyphens, or output_value stands for it; under output_name if that is given, and an output_name of
    None, if present as a key, drops the parameter. Where a required one is missing or doesn't fit, or nothing is left, the parameters stay as they are.
    """
    value = lambda r: F.nullif(F.try_element_at(params, F.lit(r["name"])), F.lit(""))

    def new(rule: dict) -> Column:
        if rule.get("output_value") is not None:
            return F.when(value(rule).isNotNull(), F.lit(rule["output_value"]))
        parts = [F.when(value(rule).rlike(rule["pattern"]), F.regexp_extract(value(rule), rule["pattern"], g)) for g in rule.get("groups", [])]
        return F.nullif(F.concat_ws("-", *(F.nullif(p, F.lit("")) for p in parts)), F.lit("")) if parts else F.lit(None).cast("string")

    dropped = lambda r: "output_name" in r and r["output_name"] is None
    entries = [F.when(new(r).isNotNull(), F.struct(F.lit(r.get("output_name") or r["name"]).alias("k"), new(r).alias("v"))) for r in rules if not dropped(r)]
    missing = F.lit(False)
    for r in rules:
        if r.get("required"):
            missing = missing | (value(r).isNull() if dropped(r) else new(r).isNull())
    found = F.map_from_entries(F.array_compact(F.array(*entries))) if entries else F.lit(None).cast("map<string,string>")
    short = ~missing & (F.coalesce(F.size(found), F.lit(0)) > 0)
    return F.struct(F.when(short, found).otherwise(params).alias("params"), F.coalesce(short, F.lit(False)).alias("shortened"))


def _pairs(params: Column) -> Column:
    kept = F.filter(F.array_sort(F.map_entries(params)), lambda e: F.coalesce(e["value"], F.lit("")) != "")
    return F.array_join(F.transform(kept, lambda e: F.concat(e["key"], F.lit("="), e["value"])), "&")


def params_text(params: Column, rules: list[dict] | None = None) -> Column:
    """Parameters in a file name, by key and without empty values: escaped after a question mark, or after ``~h`` if rules shortened them."""
    if not rules:
        return F.coalesce(F.when(_pairs(params) != "", escape_file_name(F.concat(F.lit("?"), _pairs(params)))), F.lit(""))
    short = shorten_params(params, rules)
    text = _pairs(short["params"])
    return F.coalesce(F.when(text != "", F.when(short["shortened"], F.concat(F.lit("~h"), text)).otherwise(escape_file_name(F.concat(F.lit("?"), text)))), F.lit(""))


def original_query(params: Column, rules: list[dict] | None) -> Column:
    """The parameters as they were, to be kept beside a file whose name may hold them shortened; null without rules."""
    return _pairs(params) if rules else F.lit(None).cast("string")


def names_of_urls(requests: DataFrame, default: tuple[str, str] = ("_unnamed", ".html")) -> DataFrame:
    """(input_id, base, ext, folder) of inputs' requests (input_id, at, url, is_mirror, filename or null): a configured file name, else that of the first URL that isn't a
    mirror's and doesn't end in a slash, else the default; and the first such URL's domain and path as the folder."""
    own = requests.where(~F.coalesce("is_mirror", F.lit(False)))
    named = ~F.col("url").endswith("/")
    first = own.groupBy("input_id").agg(F.min_by("url", F.when(named, F.col("at"))).alias("_named"), F.min_by("url", "at").alias("_first"))
    given = requests.groupBy("input_id").agg(F.min("filename").alias("_given"))
    file = F.coalesce("_given", F.substring_index("_named", "/", -1))
    ext = F.regexp_extract(file, r"^.+(\.[^.]*)$", 1)
    base = F.when(ext != "", F.expr("substring(_file, 1, length(_file) - length(_ext))")).otherwise(F.col("_file"))
    host, path = F.lower(F.regexp_extract("_first", r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^:/?#]*)", 1)), F.regexp_extract("_first", r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*/?([^?#]*)", 1)
    folder = F.when(path.contains("/"), F.regexp_replace(path, "/[^/]*$", "")).otherwise(F.lit("."))
    out = given.join(first, "input_id", "left").withColumn("_file", file).withColumn("_ext", ext)
    none = F.col("_file").isNull()
    return out.select("input_id", F.when(none, default[0]).otherwise(base).alias("base"), F.when(none, default[1]).otherwise(F.col("_ext")).alias("ext"), F.concat(host, F.lit("/"), folder).alias("folder"))


def version_files(versions: DataFrame, deduplicated: bool = True) -> DataFrame:
    """``versions`` (ts14, modified14, type, flag, capture_index, content_index, base, ext, params_text, ...) with output_name, output_flag, folder_kind and modified.

    Invalid ones have the flag "invalid". Names of unflagged versions tell the modification time, or else the capture's, and their place among versions of that second; flagged ones,
    and all if nothing is deduplicated, the capture's. A place of 0 isn't written. A version without a place has no name and an error.
    """
    flag = F.when(F.col("type") != "ok", "invalid").otherwise(F.col("flag"))
    plain = flag.isNull() & F.lit(deduplicated)
    stamp = F.when(plain, F.coalesce("modified14", "ts14")).otherwise(F.col("ts14"))
    place = F.when(plain, F.col("content_index")).otherwise(F.col("capture_index"))
    count = F.when(place > 0, F.concat(F.lit("_"), place.cast("string"))).otherwise("")
    name = F.concat(escape_file_name(F.col("base")), F.coalesce("params_text", F.lit("")), F.lit("."), F.substring(stamp, 1, 8), F.lit("-"), F.substring(stamp, 9, 6), count, F.when(flag.isNotNull(), F.concat(F.lit("."), flag)).otherwise(""), escape_file_name(F.col("ext")))
    return versions.withColumns({"output_name": F.when(place.isNotNull(), name), "output_flag": flag, "folder_kind": F.when(flag.isNull(), "main").otherwise("archival"), "modified": F.coalesce("modified14", "ts14"), "name_error": F.when(place.isNull(), "no place among versions")})


def _iso(stamp: Column) -> Column:
    return F.regexp_replace(stamp, r"^(\d{4})(\d{2})(\d{2})(\d{2})(\d{2})(\d{2})$", "$1-$2-$3T$4:$5:$6Z")


def summary_rows(captures: DataFrame, deduplicated: bool = True) -> DataFrame:
    """The rows of an input's summary, of captures with ts14, modified14, capture_index, content_index, original_sha256, sha256, url, status, corrections, type, mime, source,
    additional_sources, digest, actual_digest, filename, record_kinds, offset and length."""
    columns = {
        "capture_ts": _iso(F.col("ts14")), "capture_index": F.coalesce("capture_index", F.lit(0)), "modification_ts": F.coalesce(_iso(F.col("modified14")), F.lit("")),
        "capture_sha256": F.coalesce("original_sha256", "sha256"), "output_sha256": F.col("sha256"), "output_index": F.col("content_index"), "url": F.col("url"), "statuscode": F.col("status"),
        "corrections": F.coalesce(correction_names(F.col("corrections")), F.lit("")), "classification": F.col("type"), "mimetype": F.col("mime"), "provider": F.col("source"),
        "additional_providers": F.array_join(F.array_sort("additional_sources"), "|"), "record_digest": F.col("digest"), "actual_digest": F.col("actual_digest"), "archive_filename": F.col("filename"),
        "record_available": F.coalesce(F.arrays_overlap("record_kinds", F.array(F.lit("warc"), F.lit("arc"))), F.lit(False)), "record_offset": F.col("offset"), "record_length": F.col("length"),
    }
    return captures.select(*(c.alias(name) for name, c in columns.items() if deduplicated or name != "output_index"))


def upsert_summary(old: DataFrame, new: DataFrame) -> DataFrame:
    """The rows of the global summary after a run: those of paths that the run wrote are replaced."""
    return old.join(new.select("path").distinct(), "path", "left_anti").unionByName(new)


SUMMARY_PARTS = 64


def write_summary(new: DataFrame, folder: str, parts: int = SUMMARY_PARTS) -> DataFrame:
    """Put a run's rows (path, capture_ts, capture_index, ...) into the global summary in ``folder``, a table in ``parts`` parts by path, and read it back.

    Only the parts that hold paths of the run are read and replaced, by Spark's staged write of partitions: a run that fails leaves the
    summary as it was. Rows of a part are in the order of path, capture_ts and capture_index.
    """
    spark = new.sparkSession
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    store = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    there = store.exists(where)
    new = new.withColumn("part", F.pmod(F.xxhash64("path"), F.lit(parts)).cast("int"))
    rows = new
    if there:
        touched = [r.part for r in new.select("part").distinct().collect()]
        old = spark.read.schema(new.schema).parquet(folder).where(F.col("part").isin(touched))
        rows = upsert_summary(old, new)
    rows = rows.repartition("part").sortWithinPartitions("part", "path", "capture_ts", "capture_index")
    rows.write.partitionBy("part").option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(folder)
    return spark.read.schema(new.schema).parquet(folder).drop("part")


def capture_counts(states: DataFrame) -> DataFrame:
    """Per input, overall (source null) and by source: total, valid, invalid, unavailable and skipped captures, of (input_id, source, state, type), in one pass."""
    base, state = F.col("state") == "base", F.col("state")
    counted = states.select("input_id", "source", state, "type").groupingSets([["input_id"], ["input_id", "source"]], "input_id", "source")
    ok = F.coalesce(F.col("type") == "ok", F.lit(False))
    return counted.agg(F.count("*").alias("total"), F.count_if(base & ok).alias("valid"), F.count_if(base & ~ok).alias("invalid"), F.count_if(state == "unavailable").alias("unavailable"), F.count_if(state == "skipped").alias("skipped"))


def input_documents(counts: DataFrame, bounds: DataFrame, filters: DataFrame) -> DataFrame:
    """(input_id, document): JSON with an input's bounds, counts, counts by source and what was filtered.

    counts: as ``capture_counts``; bounds: input_id, min_ts, max_ts; filters: input_id and one column per reason. What is null is left out.
    """
    numbers = ("total", "valid", "invalid", "unavailable", "skipped")
    overall = counts.where("source is null").select("input_id", F.struct(*numbers).alias("captures"))
    sources = counts.where("source is not null").groupBy("input_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("source", F.struct(*numbers))))).alias("sources"))
    gone = filters.select("input_id", F.struct(*(c for c in filters.columns if c != "input_id")).alias("filtered"))
    both = overall.join(sources, "input_id", "left").join(bounds, "input_id", "left").join(gone, "input_id", "left")
    return both.select("input_id", F.to_json(F.struct("min_ts", "max_ts", "captures", "sources", "filtered")).alias("document"))


def request_of(captures: DataFrame, requests: DataFrame) -> DataFrame:
    """``captures`` (ord, derived_headers, derived_protocol) with ``request``: struct<method, protocol, headers, partial>, of the archived request record (ord, method, protocol,
    headers) where there is one, else derived and partial; GET if only a protocol or headers are known."""
    r = requests.groupBy("ord").agg(F.min_by(F.struct("method", "protocol", "headers"), F.struct("method", "protocol")).alias("_r"))
    out = captures.join(r, "ord", "left")
    known = F.col("derived_protocol").isNotNull() | (F.coalesce(F.size("derived_headers"), F.lit(0)) > 0)
    own = F.struct(F.col("_r.method").alias("method"), F.col("_r.protocol").alias("protocol"), F.col("_r.headers").alias("headers"), F.lit(False).alias("partial"))
    derived = F.struct(F.lit("GET").alias("method"), F.col("derived_protocol").alias("protocol"), F.col("derived_headers").alias("headers"), F.lit(True).alias("partial"))
    nothing = F.struct(F.lit("GET").alias("method"), F.lit(None).cast("string").alias("protocol"), F.lit(None).cast(captures.schema["derived_headers"].dataType).alias("headers"), F.lit(False).alias("partial"))
    return out.withColumn("request", F.when(F.col("_r").isNotNull(), own).when(known, derived).otherwise(nothing)).drop("_r")


def capture_documents(captures: DataFrame) -> DataFrame:
    """(ord, document): JSON of a capture's request, response and source; what is null is left out.

    captures: ord, status, length, source, request (struct), entry, revisit_entry, unpatched_entry (structs of index rows), encoding, content_length. The index row shown is that of the
    revisit, else that before patching, else the capture's own; a packed size only of encoded contents longer than their Content-Length.
    """
    packed = F.when(F.col("encoding").isNotNull() & (F.col("content_length") < F.col("length")), F.col("content_length"))
    body = F.struct(F.col("length").alias("size"), packed.alias("compressedSize"))
    document = F.struct("request", F.struct("status", body.alias("body")).alias("response"), F.struct(F.col("source").alias("type"), F.coalesce("revisit_entry", "unpatched_entry", "entry").alias("cdxEntry")).alias("source"))
    return captures.select("ord", F.to_json(document).alias("document"))
