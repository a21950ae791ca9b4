"""Rollups of visitors and requests that expire."""

import datetime

from payloads import rows_of
from pyspark.sql import functions as F

from tallyloom.operators import rollup
from tallyloom.plans.workspace import new_folder
from tallyloom.streaming.requests import expired_requests, write_expired


def visits(spark, rows):
    full = [(datetime.date(2019, m, 1), a, u) for m, a, u in rows]
    return spark.createDataFrame(full, "month date, media string, user string")


def test_users_are_numbered_without_gaps_and_keep_their_numbers(spark):
    first = rollup.number_users(spark.range(5000).select(F.col("id").cast("string").alias("u")), "u")
    again = rollup.number_users(spark.range(4000, 9000).select(F.when(F.col("id") % 7 > 0, F.col("id").cast("string")).alias("u")), "u", first)
    assert sorted(r.number for r in first.collect()) == list(range(1, 5001))
    known, every = dict(rows_of(first, "u", "number")), dict(rows_of(again, "u", "number"))
    assert sorted(every.values()) == list(range(1, len(every) + 1)) and None not in every
    assert all(every[u] == n for u, n in known.items())
    assert rollup.number_users(first.select("u").filter("false"), "u").count() == 0


def test_timeframes_from_bitmaps(spark):
    rows = [(1, "a", "x"), (1, "a", "x"), (1, "a", "y"), (2, "a", "y"), (3, "a", "z"), (3, "b", "x"), (6, "a", "x"), (1, "b", None)]
    frame = visits(spark, rows)
    bitmaps = rollup.visitor_bitmaps(frame, rollup.number_users(frame, "user"), "month", "media", "user")
    got = lambda n: sorted((m.month, a, k) for m, a, k in rows_of(rollup.unique_visitors(bitmaps, "month", "media", n), "month", "media", "unique_visitors"))
    assert got(1) == [(1, "a", 2), (2, "a", 1), (3, "a", 1), (3, "b", 1), (6, "a", 1)]
    assert got(3) == [(1, "a", 2), (2, "a", 2), (3, "a", 3), (3, "b", 1), (6, "a", 1)]


def test_many_buckets_and_bounds_of_sketches(spark):
    """More users than a bucket has bits, half of them in both months."""
    n = 100_000
    month = lambda m, lo: spark.range(lo, lo + n).select(F.lit(datetime.date(2019, m, 1)).alias("month"), F.lit("a").alias("media"), F.col("id").alias("user"))
    frame = month(1, 0).unionByName(month(2, n // 2))
    bitmaps = rollup.visitor_bitmaps(frame, rollup.number_users(frame, "user"), "month", "media", "user")
    assert bitmaps.select("bucket").distinct().count() > 3
    assert {r.month.month: r.unique_visitors for r in rollup.unique_visitors(bitmaps, "month", "media", 2).collect()} == {1: n, 2: n * 3 // 2}
    found = rollup.estimated_visitors(rollup.visitor_sketches(frame, "month", "media", "user"), "month", "media", 2)
    assert all(r.low <= (n if r.month.month == 1 else n * 3 // 2) <= r.high <= r.low * 1.08 for r in found.collect())
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan


T = lambda hour, day=1: datetime.datetime(2024, 1, day, hour)
ASKED, ANSWERED = "q string, at timestamp", "q string, got timestamp"


def test_expired_requests_of_tables(spark):
    asked = spark.createDataFrame([("a", T(1)), ("b", T(1)), ("c", T(1)), (None, T(1)), ("a", T(9))], ASKED)
    answers = spark.createDataFrame([("a", T(3)), ("a", T(4)), ("b", T(4)), ("c", T(0)), (None, T(2))], ANSWERED)
    out = expired_requests(asked, answers, ["q"], "at", "got", "2 HOURS")
    assert sorted(rows_of(out, "q", "expired_at"), key=str) == sorted([("a", T(11)), ("b", T(3)), ("c", T(3)), (None, T(3))], key=str)


def test_a_request_comes_out_when_its_window_has_passed(spark):
    folder = new_folder(spark, "expired")
    read = lambda name, schema: spark.readStream.schema(schema).parquet(f"{folder}/{name}")

    def run(asked, answers):
        spark.createDataFrame(asked, ASKED).coalesce(1).write.mode("append").parquet(f"{folder}/asked")
        spark.createDataFrame(answers, ANSWERED).coalesce(1).write.mode("append").parquet(f"{folder}/answers")
        write_expired(expired_requests(read("asked", ASKED), read("answers", ANSWERED), ["q"], "at", "got", "2 HOURS"), f"{folder}/out", f"{folder}/checkpoint")
        return sorted(rows_of(spark.read.parquet(f"{folder}/out"), "q"))

    assert run([("a", T(1)), ("b", T(1)), ("c", T(2))], [("x", T(2)), ("a", T(2))]) == []  # nothing is certain yet
    assert run([("d", T(6))], [("b", T(3)), ("x", T(6))]) == [("c",)]
    assert run([("e", T(1, 9))], [("x", T(1, 9))]) == [("c",), ("d",)]
    assert run([("e", T(2, 9))], [("x", T(2, 9))]) == [("c",), ("d",)]  # each comes out once
