"""Duplicate captures of one moment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arkspark.functions.urls import slash_match


def _differ(column: str) -> Column:
    """Whether a group holds several values, null being one: told by partial aggregates, without a distinct count."""
    return F.coalesce(F.min(column) != F.max(column), F.lit(False)) | ((F.count(column) > 0) & (F.count(column) < F.count("*")))


def merge_duplicates(rows: DataFrame, keys: tuple[str, ...] = ("request_url", "ts14", "status", "url")) -> DataFrame:
    """One row per key: the first by ord, with digest and length null where they differ, and n_rows."""
    first = F.min_by(F.struct(*(c for c in rows.columns if c not in keys)), "ord")
    found = rows.groupBy(*keys).agg(first.alias("f"), _differ("digest").alias("d1"), _differ("length").alias("d2"), F.count("*").alias("n_rows"))
    cols = [F.when(F.col("d1"), None).otherwise(F.col("f.digest")).alias("digest") if c == "digest" else F.when(F.col("d2"), None).otherwise(F.col("f.length")).alias("length") if c == "length" else F.col(f"f.{c}").alias(c) for c in rows.columns if c not in keys]
    return found.select(*keys, *cols, "n_rows")


def resolve_mixed(rows: DataFrame, served: DataFrame) -> DataFrame:
    """Groups of a moment with several (status, url): those served (ts14, url, status) are ``resolved``, others ``unavailable``.

    Groups with one (status, url) are ``single``.
    """
    merged = merge_duplicates(rows)
    groups = merged.groupBy("request_url", "ts14").agg(F.count("*").alias("n_groups"))
    marks = served.select("ts14", "url", "status").distinct().withColumn("served", F.lit(True))
    out = merged.join(groups, ["request_url", "ts14"]).join(marks, ["ts14", "url", "status"], "left")
    state = F.when(F.col("n_groups") == 1, "single").when(F.col("served"), "resolved").otherwise("unavailable")
    return out.withColumn("state", state).drop("served")


def duplicate_counts(resolved: DataFrame) -> DataFrame:
    """Per request: rows in, merged away, resolved and unavailable."""
    return resolved.groupBy("request_url").agg(
        F.sum("n_rows").alias("n_in"), F.sum(F.col("n_rows") - 1).alias("n_merged"), F.count_if(F.col("state") == "resolved").alias("n_resolved"), F.count_if(F.col("state") == "unavailable").alias("n_unavailable"), F.count_if(F.col("state") == "single").alias("n_single")
    )


def resolve_duplicates(rows: DataFrame, served: DataFrame, mode: str, ranges: DataFrame | None = None) -> DataFrame:
    """What becomes of each (request_url, ts14, status, url): its first row by ord, digest and length null where they differ, n_rows and ``state``.

    ``rows``: request_url, ts14, ord, status, url, digest, length, ...; ``served`` (ts14, status, url): what the archive
    gives out for a moment; ``mode``: how a trailing slash has to match, see ``slash_match``. A moment with one row is ``single``, with
    equal (status, url) ``merged``; of other moments the group served is ``resolved``, the others ``unavailable``. Groups whose slash doesn't
    match are ``slash`` and filtered, as are, unresolved, all rows of moments with several inside ``ranges`` (start_ts, end_ts): ``limited``.
    """
    groups = merge_duplicates(rows)
    moments = groups.groupBy("request_url", "ts14").agg(F.count("*").alias("_groups"), F.sum("n_rows").alias("_rows"))
    marks = served.select("ts14", "status", "url").distinct().withColumn("_served", F.lit(True))
    same = (F.col("g.ts14") == F.col("m.ts14")) & F.col("g.status").eqNullSafe(F.col("m.status")) & (F.col("g.url") == F.col("m.url"))
    out = groups.join(moments, ["request_url", "ts14"]).alias("g").join(marks.alias("m"), same, "left").select("g.*", F.col("m._served").alias("_served"))
    if ranges is not None:
        inside = out.select("ts14").distinct().join(ranges.select("start_ts", "end_ts"), (F.col("ts14") >= F.col("start_ts")) & (F.col("ts14") <= F.col("end_ts")), "left_semi").withColumn("_inside", F.lit(True))
        out = out.join(inside, "ts14", "left")
    else:
        out = out.withColumn("_inside", F.lit(None).cast("boolean"))
    fits = slash_match(F.col("url"), F.col("request_url"), mode, F.col("status"))
    state = (
        F.when(~fits, "slash")
        .when(F.col("_rows") == 1, "single")
        .when(F.coalesce("_inside", F.lit(False)), "limited")
        .when(F.col("_groups") == 1, "merged")
        .when(F.coalesce("_served", F.lit(False)), "resolved")
        .otherwise("unavailable")
    )
    return out.withColumn("state", state).drop("_groups", "_rows", "_served", "_inside")


def kept_duplicates(resolved: DataFrame) -> DataFrame:
    """The rows that stay, with ``unavailable``."""
    return resolved.where(~F.col("state").isin("slash", "limited")).withColumn("unavailable", F.col("state") == "unavailable")


def resolution_counts(resolved: DataFrame) -> DataFrame:
    """Per request: rows filtered by the slash, by limited ranges and as duplicates; null for none."""
    total = lambda kept, n: F.nullif(F.sum(F.when(kept, n).otherwise(0)), F.lit(0)).cast("long")
    state = F.col("state")
    return resolved.groupBy("request_url").agg(total(state == "slash", F.col("n_rows")).alias("slash_filtered"), total(state == "limited", F.col("n_rows")).alias("limited_filtered"), total(state.isin("resolved", "unavailable"), F.col("n_rows") - 1).alias("duplicate_filtered"))
