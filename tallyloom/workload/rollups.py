"""Timeframes of several months from monthly rollups, and requests that expire."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions.periods import month_start
from tallyloom.operators.rollup import estimated_visitors, number_users, unique_visitors, visitor_bitmaps, visitor_sketches
from tallyloom.plans.workspace import new_folder
from tallyloom.sources.lake import touched_months, write_months
from tallyloom.streaming.requests import expired_requests, write_expired
from tallyloom.workload.registry import as_text, query, table

TIMEFRAME_MONTHS = (1, 3)

_TIMEFRAMES = """
    WITH v AS (SELECT DISTINCT date_trunc('month', o_orderdate)::DATE AS d, o_orderpriority AS media, o_custkey AS u FROM orders),
    e AS (SELECT DISTINCT d AS e FROM v),
    c AS (
      SELECT e, media, n AS months, count(DISTINCT u) AS unique_visitors
      FROM e CROSS JOIN (VALUES (1), (3)) t(n) JOIN v ON v.d <= e AND v.d > e - to_months(n) GROUP BY ALL)"""


def _rollups(spark: SparkSession, sf_dir: str) -> str:
    """Bitmaps and sketches of orders by month and priority, landed in two steps, each numbering its new users only."""
    visits = table(spark, sf_dir, "orders").select(month_start(F.col("o_orderdate")).alias("data_date"), F.col("o_orderpriority").alias("media"), F.col("o_custkey").alias("user"))
    folder, numbers = new_folder(spark, "rollups"), None
    visits.distinct().write.parquet(f"{folder}/visits")
    seen = spark.read.parquet(f"{folder}/visits")
    for step, part in enumerate((seen.filter("year(data_date) < 1995"), seen.filter("year(data_date) >= 1995"))):
        number_users(part, "user", numbers).write.parquet(f"{folder}/numbers/{step}")
        numbers = spark.read.parquet(f"{folder}/numbers/{step}")
        months = touched_months(part)
        write_months(visitor_bitmaps(part, numbers, "data_date", "media", "user"), f"{folder}/bitmaps", months)
        write_months(visitor_sketches(part, "data_date", "media", "user"), f"{folder}/sketches", months)
    return folder


@query(f"""{_TIMEFRAMES}
    SELECT e::VARCHAR AS data_date, media, months, unique_visitors FROM c""")
def unique_visitors_by_timeframe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact unique visitors of one month and of three, merged from monthly bitmaps."""
    bitmaps = spark.read.parquet(f"{_rollups(spark, sf_dir)}/bitmaps")
    one, three = (unique_visitors(bitmaps, "data_date", "media", n) for n in TIMEFRAME_MONTHS)
    return as_text(one.unionByName(three), "data_date")


@query(f"""{_TIMEFRAMES}
    SELECT e::VARCHAR AS data_date, media, months, unique_visitors, true AS within_bound FROM c""")
def visitors_sketched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same timeframes from monthly sketches: whether the exact number lies within the estimate's bounds."""
    folder, out = _rollups(spark, sf_dir), []
    bitmaps, sketches = (spark.read.parquet(f"{folder}/{name}") for name in ("bitmaps", "sketches"))
    for n in TIMEFRAME_MONTHS:
        found = unique_visitors(bitmaps, "data_date", "media", n).join(estimated_visitors(sketches, "data_date", "media", n), ["data_date", "media", "months"])
        out.append(found.withColumn("within_bound", F.col("unique_visitors").between(F.col("low"), F.col("high"))).drop("estimate", "low", "high"))
    return as_text(out[0].unionByName(out[1]), "data_date")


@query("""
    SELECT c.event_id, c.user_id FROM events c
    WHERE c.event_type = 'click' AND NOT EXISTS (
      SELECT 1 FROM events p WHERE p.event_type = 'purchase' AND p.user_id = c.user_id AND p.ts BETWEEN c.ts AND c.ts + INTERVAL 36 HOUR)""")
def expired_requests_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clicks as requests and purchases as ready answers, which arrive in two drops: requests without an answer within 36 hours.

    The second drop ends with a heartbeat on both sides, far enough ahead to close every window.
    """
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts")
    last = events.agg(F.max("ts")).first()[0] + timedelta(days=60)
    beat = spark.range(1).select(F.lit(-1).cast("bigint").alias("event_id"), F.lit(-1).cast("bigint").alias("user_id"), F.explode(F.array(F.lit("click"), F.lit("purchase"))).alias("event_type"), F.lit(last).cast(events.schema["ts"].dataType).alias("ts"))
    folder = new_folder(spark, "expired")
    early = F.dayofmonth("ts") <= 15
    # event times of streams are instants
    stream = lambda kind, at: spark.readStream.schema(events.schema).parquet(f"{folder}/{kind}").select("event_id", "user_id", F.col("ts").cast("timestamp").alias(at))
    for drop in (events.filter(early), events.filter(~early).unionByName(beat)):
        for kind in ("click", "purchase"):
            drop.filter(F.col("event_type") == kind).write.mode("append").parquet(f"{folder}/{kind}")
        asked, answers = stream("click", "asked_at"), stream("purchase", "answered_at").drop("event_id")
        expired = expired_requests(asked, answers, ["user_id"], "asked_at", "answered_at", "36 HOURS")
        write_expired(expired, f"{folder}/expired", f"{folder}/checkpoint")
    return spark.read.parquet(f"{folder}/expired").filter("event_id >= 0").select("event_id", "user_id")
