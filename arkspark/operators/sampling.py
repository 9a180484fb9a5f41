"""Limits on captures per day, and ordinals."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arkspark.operators.ordinals import ordinals


def active_ranges(rows: DataFrame, ranges: DataFrame) -> DataFrame:
    """(input_id, range_id, start_ts, end_ts, n): ranges with more captures of the input than their threshold.

    ``ranges`` (range_id, start_ts, end_ts, threshold) hold for every input, or, with a column input_id, each for its own (null: for every one). They
    are configuration: an input's become one array that its rows count into. What is found limits captures by ``limit_captures``.
    """
    one = F.struct("range_id", "start_ts", "end_ts", "threshold")
    hits = lambda name: F.filter(F.col(name), lambda r: (F.col("ts14") >= r["start_ts"]) & (F.col("ts14") <= r["end_ts"]))
    named = ranges if "input_id" in ranges.columns else ranges.withColumn("input_id", F.lit(None).cast(rows.schema["input_id"].dataType))
    own = named.where("input_id is not null").groupBy(F.col("input_id").alias("_id")).agg(F.collect_list(one).alias("_own"))
    general = named.where("input_id is null").groupBy(F.lit(True).alias("_any")).agg(F.collect_list(one).alias("_general"))
    rows = rows.select("input_id", "ts14").join(F.broadcast(own), F.col("input_id") == F.col("_id"), "left").withColumn("_true", F.lit(True)).join(F.broadcast(general), F.col("_true") == F.col("_any"), "left")
    none = F.array().cast(general.schema["_general"].dataType)
    hit = rows.select("input_id", F.explode(F.concat(F.coalesce(hits("_own"), none), F.coalesce(hits("_general"), none))).alias("r"))
    return hit.groupBy("input_id", "r").agg(F.count("*").alias("n")).where("n > r.threshold").select("input_id", "r.range_id", "r.start_ts", "r.end_ts", "n")


def clock_sample(rows: DataFrame, keys: tuple[str, ...], n: int) -> DataFrame:
    """Of each key and day the captures nearest to n evenly spaced clock times; of equally near ones the earliest.

    Seconds don't count; each capture is returned once. Nearest per target is a minimum of structs, so that a busy day
    is aggregated partially and never sorted in one task.
    """
    step = 24 * 60 / n
    minute = F.substring("ts14", 9, 2).cast("int") * 60 + F.substring("ts14", 11, 2).cast("int")
    by = [*keys, "_day", "_target"]
    near = rows.withColumn("_day", F.substring("ts14", 1, 8)).withColumn("_target", F.explode(F.array(*(F.lit(step / 2 + i * step) for i in range(n)))))
    best = near.groupBy(*by).agg(F.min(F.struct(F.abs(minute - F.col("_target")).alias("d"), "ts14", "ord")).alias("b"))
    return rows.join(best.select(F.col("b.ord").alias("ord")).distinct(), "ord", "left_semi")


def index_sample(rows: DataFrame, keys: tuple[str, ...], n: int) -> DataFrame:
    """Of each key n captures at even distances in order of (ts14, ord), ends included; the first if n is 1."""
    ranked = ordinals(rows, "ts14", "ord", by=keys, name="_i").withColumn("_i", (F.col("_i") - 1).cast("int"))
    totals = ranked.groupBy(*(F.col(c).alias(f"_k{i}") for i, c in enumerate(keys))).agg(F.count("*").alias("_m"))
    same = reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate(keys)))
    ranked = ranked.join(totals, same).drop(*(f"_k{i}" for i in range(len(keys))))
    take = F.least(F.lit(n), F.col("_m"))
    if n == 1:
        hit = F.col("_i") == 0
    else:
        picks = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.when(i < take, F.when(take == 1, 0).otherwise(F.floor(i * (F.col("_m") - 1) / (take - 1) + 0.5)).cast("int")))
        hit = F.array_contains(F.array_compact(picks), F.col("_i"))
    return ranked.where(hit).drop("_i", "_m")


def limit_captures(rows: DataFrame, ranges: DataFrame, per_day: int, mirror_per_day: int | None = None) -> DataFrame:
    """Inside an active range (input_id, start_ts, end_ts) at most ``per_day`` captures of a request and day, all with
    status 200, others go; outside all stay. Everywhere only the first row of a request and stamp stays. ``mirror_per_day`` holds for rows with
    ``is_mirror``; where a request has rows of both kinds, each kind's are chosen among its own.

    Ranges are configuration: each input's become one array, so that rows meet them where they are, however many an input has.
    Days are summed up by partial aggregates that hold the nearest capture of each clock time; rows are joined with them once.
    """
    spans = ranges.groupBy(F.col("input_id").alias("_id")).agg(F.collect_list(F.struct("start_ts", "end_ts")).alias("_spans"))
    inside = F.coalesce(F.exists("_spans", lambda s: (F.col("ts14") >= s["start_ts"]) & (F.col("ts14") <= s["end_ts"])), F.lit(False))
    marked = rows.join(F.broadcast(spans), F.col("input_id") == F.col("_id"), "left").withColumn("_in", inside).withColumn("_d", F.substring("ts14", 1, 8)).drop("_id", "_spans")
    minute = F.substring("ts14", 9, 2).cast("int") * 60 + F.substring("ts14", 11, 2).cast("int")

    mirror = F.coalesce("is_mirror", F.lit(False)) if "is_mirror" in rows.columns and mirror_per_day else F.lit(False)

    def nearest(n: int, own: Column) -> list:
        step = 24 * 60 / n
        return [F.min(F.when(own, F.struct(F.abs(minute - (step / 2 + i * step)).alias("d"), "ts14", "ord")))["ord"] for i in range(n)]

    days = marked.where("_in and status = 200").groupBy("request_url", "_d").agg(F.count("*").alias("_n"), F.array(*nearest(per_day, ~mirror)).alias("_picks"), F.array(*nearest(mirror_per_day or per_day, mirror)).alias("_mirror_picks"))
    most, picks = F.when(mirror, F.lit(mirror_per_day)).otherwise(F.lit(per_day)), F.when(mirror, F.col("_mirror_picks")).otherwise(F.col("_picks"))
    kept = marked.join(days, ["request_url", "_d"], "left").where(~F.col("_in") | ((F.col("status") == 200) & ((F.col("_n") <= most) | F.array_contains(picks, F.col("ord")))))
    first = kept.groupBy("request_url", "ts14").agg(F.min_by(F.struct(*(F.col(c) for c in rows.columns if c not in ("request_url", "ts14"))), "ord").alias("f"))
    return first.select(*(F.col(c) if c in ("request_url", "ts14") else F.col(f"f.{c}").alias(c) for c in rows.columns))


def capture_index(rows: DataFrame, keys: tuple[str, ...] = ("input_id",)) -> DataFrame:
    """Ordinal from 0 among rows of one key and stamp."""
    return rows.withColumn("capture_index", F.row_number().over(Window.partitionBy(*keys, "ts14").orderBy("ord")) - 1)


def content_index(rows: DataFrame, keys: tuple[str, ...] = ("input_id",)) -> DataFrame:
    """Ordinal from 0 of a version (digest, last_modified14) among the key's versions of one displayed second, else null.

    Only rows of type ok make versions; one without a date counts only if its digest has no dated version. The
    displayed second is last_modified14, else the stamp of the version's first row.
    """
    ok = rows.where(F.col("type") == "ok")
    dated = ok.groupBy(*keys, "digest").agg(F.max(F.col("last_modified14").isNotNull()).alias("_dated"))
    versions = ok.join(dated, [*keys, "digest"]).where(F.col("last_modified14").isNotNull() | ~F.col("_dated"))
    versions = versions.withColumn("_lm", F.coalesce("last_modified14", F.lit(""))).groupBy(*keys, "digest", "_lm").agg(F.min(F.struct("ts14", "ord")).alias("f"))
    shown = F.when(F.col("_lm") != "", F.col("_lm")).otherwise(F.col("f.ts14"))
    versions = versions.withColumn("content_index", F.row_number().over(Window.partitionBy(*keys, shown).orderBy("f")) - 1).drop("f")
    return rows.withColumn("_lm", F.coalesce("last_modified14", F.lit(""))).join(versions, [*keys, "digest", "_lm"], "left").drop("_lm")


def order_keys() -> list:
    """The order of captures: stamp, then sort key and URL in lower case."""
    from arkspark.functions.urls import simple_urlkey

    return [F.col("ts14"), simple_urlkey(F.col("url")), F.lower("url")]


def capture_order(rows: DataFrame) -> DataFrame:
    keys = {f"_o{i}": key for i, key in enumerate(order_keys())}
    return rows.withColumns(keys).orderBy(*keys, "ord").drop(*keys)
