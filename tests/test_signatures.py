"""Layouts by header labels."""

import datetime

from payloads import doc, header, row, rows_of
from pyspark.sql import functions as F

from tallyloom.operators.parse import parse_tables
from tallyloom.operators.signatures import only_known, register, unknown_headers
from tallyloom.plans import reports
from tallyloom.plans.specs import DESKTOP, MOBILE

SCHEMA = "request_id string, report string, data_date date, timeframe string, categories string, payload string"
MARCH = datetime.date(2019, 3, 1)
HEAD = ["Category", "Attribute", ("Visitors", "1"), ("Pages", "2")]


def landed(spark, *payloads, report="desktop"):
    return spark.createDataFrame([(f"q{i}", report, MARCH, "t", "c", p) for i, p in enumerate(payloads)], SCHEMA)


def table(head, label="Media", cells=("c", "a", "1", "2")):
    return doc(header(head, label), row("A", list(cells)))


def test_headers_that_drift_at_the_same_width_are_caught(spark):
    other = ["Category", "Attribute", ("Minutes", "3"), ("Share", "9")]
    known = register(parse_tables(landed(spark, table(HEAD)), DESKTOP), "plain").unionByName(register(parse_tables(landed(spark, table(other)), DESKTOP), "minutes"))
    frames = landed(
        spark, table(HEAD), table(HEAD, "MEDIA"), table(["Category", "Attribute", ("Pages", "2"), ("Visitors", "1")]), table(["Category", "Attribute", ("Visitors", "1"), ("Pages", "22")]),
        table(HEAD, "Site"), table([*HEAD, ("More", "4")]), "<r>no table</r>", table(["Category", "Attribute", ("Minutes", "3"), ("Pages", "2")]), table(other),
    )
    found = unknown_headers(parse_tables(frames, DESKTOP), known)
    assert sorted(rows_of(found, "request_id", "nearest", "distance", "reject_reason")) == [
        ("q2", "minutes", 2, "unknown_header"), ("q3", "plain", 1, "unknown_header"), ("q4", "plain", 1, "unknown_header"), ("q5", "plain", 1, "unknown_header"), ("q7", "minutes", 1, "unknown_header"),
    ]
    facts = reports.desktop(frames, watch=only_known(known))
    assert facts.count() == 3 * 2
    exchanges = [x for x in facts._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange hashpartitioning" in x and ("data_rows" in x or "payload" in x)]
    assert exchanges == []


def test_a_report_without_registered_layouts_and_upper_headers(spark):
    known = register(parse_tables(landed(spark, table(HEAD)), DESKTOP), "plain")
    two = doc(header(["x", "y"]), header([("Visitors", "1"), ("Pages", "2")]), row("A", ["1", "2"]))
    mobile = landed(spark, two, two.replace(">x<", ">z<"), report="mobile_web_and_app")
    assert rows_of(unknown_headers(parse_tables(mobile, MOBILE), known), "nearest", "distance") == [(None, None)] * 2
    own = register(parse_tables(mobile.filter("request_id = 'q0'"), MOBILE), "xy")
    assert rows_of(unknown_headers(parse_tables(mobile, MOBILE), own), "request_id", "nearest", "distance") == [("q1", "xy", 1)]
    assert unknown_headers(parse_tables(mobile.filter(F.lit(False)), MOBILE), own).count() == 0
