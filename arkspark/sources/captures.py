"""The derived capture index over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def captures(spark: SparkSession, sf_dir: str, content: bool = False) -> DataFrame:
    """One index row per event: ord, page_id, url, ts14, status, digest, length, source, collection, last_modified14."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "ts", "user_id", "event_type")
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    own = pages.select("page_id", "url", F.sha2("html", 256).alias("sha"), F.length("html").cast("long").alias("length"), *(["html"] if content else []))
    count = pages.agg(F.count("*").alias("n"))
    rows = events.crossJoin(F.broadcast(count)).withColumn("page_id", F.pmod("user_id", "n")).join(own if not content else own, "page_id")
    hour = F.date_format(F.date_trunc("HOUR", "ts"), "yyyyMMddHHmmss")
    changed = F.col("event_id") % 97 == 0
    crawl = F.col("event_id") % 3 == 0
    if content:
        html = F.when(changed, F.concat("html", F.col("event_id").cast("string"))).otherwise(F.col("html"))
        digest = F.sha2(html, 256)
    else:
        texts = pages.select(F.col("page_id").alias("c_page"), "html")
        some = events.where(changed).crossJoin(F.broadcast(count)).select(F.col("event_id").alias("c_event"), F.pmod("user_id", "n").alias("c_page")).join(texts, "c_page").select("c_event", F.sha2(F.concat("html", F.col("c_event").cast("string")), 256).alias("c_sha"))
        rows = rows.join(some, F.col("event_id") == F.col("c_event"), "left")
        digest = F.coalesce("c_sha", "sha")
    return rows.select(
        F.col("event_id").alias("ord"), "page_id", "url", hour.alias("ts14"),
        F.when(F.col("event_type") == "error", 404).when(F.col("event_type") == "signup", 301).otherwise(200).alias("status"),
        digest.alias("digest"), "length",
        F.when(crawl, "commoncrawl").otherwise("wayback").alias("source"),
        F.when(crawl, F.concat(F.lit("CC-MAIN-2024-"), F.substring(hour, 7, 1))).alias("collection"),
        F.when(F.col("event_id") % 4 == 0, F.concat(F.date_format("ts", "yyyyMMdd"), F.lit("000000"))).alias("last_modified14"),
        *([html.alias("html")] if content else []),
    )


CAPTURES_SQL = """caps AS (SELECT e.event_id AS ord, p.page_id, p.url, strftime(date_trunc('hour', e.ts), '%Y%m%d%H%M%S') AS ts14,
  CASE e.event_type WHEN 'error' THEN 404 WHEN 'signup' THEN 301 ELSE 200 END AS status,
  sha256(CASE WHEN e.event_id % 97 = 0 THEN concat(p.html, CAST(e.event_id AS VARCHAR)) ELSE p.html END) AS digest,
  CAST(length(p.html) AS BIGINT) AS length, CASE WHEN e.event_id % 3 = 0 THEN 'commoncrawl' ELSE 'wayback' END AS source,
  CASE WHEN e.event_id % 3 = 0 THEN concat('CC-MAIN-2024-', substr(strftime(date_trunc('hour', e.ts), '%Y%m%d%H%M%S'), 7, 1)) END AS collection,
  CASE WHEN e.event_id % 4 = 0 THEN concat(strftime(e.ts, '%Y%m%d'), '000000') END AS last_modified14
  FROM events e CROSS JOIN (SELECT count(*) AS n FROM pages) c JOIN pages p ON p.page_id = e.user_id % c.n)"""
