import datetime
from pathlib import Path

import pytest
from payloads import doc, header, row, rows_of
from pyspark.sql import functions as F

from tallyloom.operators.grid import ask, request_parameters
from tallyloom.operators.reshape import pair_reversed
from tallyloom.plans.monthly import build_report, run_month, stream_report
from tallyloom.plans.specs import DESKTOP, REPORTS
from tallyloom.plans.workspace import new_folder
from tallyloom.streaming.ingest import landing_source

SCHEMA = "request_id string, report string, data_date date, attempt int, payload string"
HEAD = header(["Category", "Attribute", ("Visitors", "1")])


def answer(media, value):
    return doc(HEAD, row(media, ["c", "a", str(value)]))


def log(spark, *rows):
    full = [(q, "desktop", datetime.date(2019, m, 1), n, p) for q, m, n, p in rows]
    return spark.createDataFrame(full, SCHEMA)


FIRST = [("q1", 3, 1, "<r><errors/></r>"), ("q2", 3, 1, answer("B", 2)), ("q3", 4, 1, answer("C", 3))]
SECOND = [("q1", 3, 2, answer("A", 1)), ("q2", 3, 2, answer("B", 20))]


def requests(spark):
    return spark.createDataFrame(
        [(f"q{i}", "1 month average", "custom entities") for i in range(1, 4)],
        "request_id string, timeframe string, categories string",
    )


def months(spark, path):
    return sorted((str(d), m, v) for d, m, v in rows_of(spark.read.parquet(path), "data_date", "media", "metric_value"))


def test_stream_of_answers_equals_the_batch(spark):
    folder = new_folder(spark, "answers")

    def run():
        stream_report(
            spark, landing_source(spark, f"{folder}/in"), "desktop", f"{folder}/landing", f"{folder}/lake", "desktop", f"{folder}/checkpoint",
            requests(spark),
        )
        return months(spark, f"{folder}/lake/desktop")

    log(spark, *FIRST).coalesce(1).write.parquet(f"{folder}/in")
    assert run() == [("2019-03-01", "B", 2.0), ("2019-04-01", "C", 3.0)]
    log(spark, *SECOND).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    expected = [("2019-03-01", "A", 1.0), ("2019-03-01", "B", 20.0), ("2019-04-01", "C", 3.0)]
    assert run() == expected
    batch = build_report(log(spark, *FIRST, *SECOND), "desktop", requests(spark))
    assert sorted((str(d), m, v) for d, m, v in rows_of(batch, "data_date", "media", "metric_value")) == expected


def test_a_newer_empty_answer_takes_its_month_back(spark):
    base = new_folder(spark, "lake")
    run_month(log(spark, ("q1", 3, 1, answer("A", 1))), "desktop", "2019-03-05", base, "desktop", requests(spark))
    path = run_month(log(spark, ("q1", 3, 1, answer("A", 1)), ("q1", 3, 2, doc(HEAD))), "desktop", "2019-03-05", base, "desktop", requests(spark))
    assert not list(Path(path).glob("data_date=*"))


def test_one_month_is_published_alone(spark):
    base = new_folder(spark, "lake")
    landing = log(spark, *FIRST, *SECOND)
    path = run_month(landing, "desktop", "2019-04-22", base, "desktop", requests(spark))
    assert months(spark, path) == [("2019-04-01", "C", 3.0)]
    run_month(landing, "desktop", "2019-03-05", base, "desktop", requests(spark))
    assert len(months(spark, path)) == 3


def test_request_answered_from_facts(spark):
    fact = spark.createDataFrame(
        [("m1", 231, 840, "1", 1.0), ("m2", 231, 840, "4", 2.0), ("m1", 230, 840, "1", 3.0), ("m3", 231, 840, "2", 4.0)],
        "media string, period int, geo int, metric_id string, v double",
    )
    parameters = request_parameters(DESKTOP, 231, timeType=1, media=["m1", "m2"])
    assert parameters["geo"] == 840 and parameters["targetGroup"] == 15 and parameters["timePeriod"] == 231
    columns = {"geo": "geo", "timePeriod": "period", "media": "media"}
    with pytest.raises(ValueError, match="timeType"):
        ask(fact, DESKTOP, parameters, columns)
    del parameters["timeType"]
    assert rows_of(ask(fact, DESKTOP, parameters, columns), "v") == [(1.0,)]
    assert rows_of(ask(fact, DESKTOP, parameters, columns, measures=["4"]), "v") == [(2.0,)]
    members = spark.createDataFrame([("m3",)], "media string")
    assert rows_of(ask(fact, DESKTOP, request_parameters(DESKTOP, 231), columns, members), "v") == [(4.0,)]


def test_spec_sizes():
    sizes = {"desktop": 21, "local_market": 21, "multi_platform": 45, "mobile_web_and_app": 14, "cross_visiting": 4, "audience_duplication": 4}
    assert {k: len(s.measures) for k, s in REPORTS.items()} == sizes
    widths = {"desktop": 14, "local_market": 15, "multi_platform": 14, "mobile_web_and_app": 12, "cross_visiting": 13, "audience_duplication": 13}
    assert {k: len(s.schema) for k, s in REPORTS.items()} == widths


def test_mirrored_rows_of_a_group_larger_than_a_block(spark):
    df = spark.range(100).select(F.when(F.col("id") < 97, "big").otherwise("small").alias("g"), F.when(F.col("id") < 97, F.col("id")).otherwise(F.col("id") - 97).alias("p"))
    df = df.withColumn("v", F.col("p") * 10)
    out = pair_reversed(df, ["g"], "p", ["v"], block=8)
    assert out.count() == 100
    assert all(r.mirrored_v == ((96 if r.g == "big" else 2) - r.p) * 10 for r in out.collect())
