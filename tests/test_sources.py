import datetime
import json
from pathlib import Path

import pytest
from payloads import doc, header, landing, row, rows_of
from pyspark.sql import functions as F

from tallyloom.functions.numbers import nan_to_null, to_measure
from tallyloom.functions.periods import month_start, parse_date, period_id, period_labels
from tallyloom.functions.text import drop_brackets, escape, last_two, resolve_references, slug, strip, unescape
from tallyloom.operators.grid import decorate_measures, report_query, request_grid, with_request_id
from tallyloom.operators.quality import missing_requests
from tallyloom.plans import reports
from tallyloom.plans.specs import DESKTOP
from tallyloom.plans.workspace import new_folder
from tallyloom.sources.config import CATEGORIES, TARGETS, TIMEFRAMES, category_rows, load_config
from tallyloom.sources.landing import latest_ready, markets, pending, read_landing, read_landing_files, ready_documents
from tallyloom.sources.lake import publish, register_months, create_table, table_path, touched_months, write_months
from tallyloom.streaming.ingest import current_log, ingest_stream, land_batch


def one(spark, value, fn, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(fn(F.col("v"))).first()[0]


def test_text(spark):
    assert one(spark, "  a\tb \n ", strip) == "a\tb"
    assert one(spark, "[P]", drop_brackets) == "P"
    assert one(spark, "New York, NY", last_two) == "NY" and one(spark, "X", last_two) == "X"
    assert one(spark, "Duplicated (2 or more sites)", slug) == "duplicated_2_or_more_sites"
    text = "a & <b> \"c\" d"
    assert one(spark, text, lambda c: unescape(resolve_references(escape(c)))) == text
    decoded = {"&#00000233;&#x000000E9;&#0;": "éé&#0;", "&eacute;&#233;&#xE9;": "ééé", "&amp;eacute;": "&eacute;", "&#60;&#38;lt;": "<&lt;", "&nope; & AT&T": "&nope; & AT&T", "&#xD800;": "&#xD800;"}
    for raw, plain in decoded.items():
        assert one(spark, raw, lambda c: unescape(resolve_references(c))) == plain


def test_numbers(spark):
    cases = {
        "12.5": 12.5, "1,234": None, "": None, "-": None, "NaN": None, "inf": float("inf"), "-Infinity": float("-inf"),
        "1d": None, "2f": None, " 7 ": 7.0, "1_000": None, "1.": 1.0, ".5": 0.5, "+3": 3.0, "1e5": 1e5, "0x10": None,
        "True": None, "1e400": float("inf"), ".": None, " 8": 8.0,
    }
    got = spark.createDataFrame([(k,) for k in cases], "v string").select("v", to_measure(F.col("v")))
    assert {r[0]: r[1] for r in got.collect()} == cases
    assert got.schema[1].dataType.simpleString() == "float"
    swept = nan_to_null(spark.sql("SELECT double('NaN') a, float('NaN') b, 'nan' c, double('inf') d, 1 e"))
    assert tuple(swept.first()) == (None, None, "nan", float("inf"), 1)
    whole = nan_to_null(spark.sql("SELECT 'x' a"))
    assert whole.columns == ["a"]


def test_periods(spark):
    day = spark.sql("SELECT '2019-03-17' s").withColumn("d", month_start(parse_date(F.col("s"))))
    got = day.select("d", period_id(F.col("d")), *[c.alias(k) for k, c in period_labels(F.col("d")).items()]).first()
    assert tuple(got) == (datetime.date(2019, 3, 1), 231, "March", 2019)
    assert one(spark, datetime.date(2015, 1, 1), period_id, "date") == 181
    assert one(spark, datetime.date(2014, 12, 1), period_id, "date") == 180


def test_grid_sizes_and_ids(spark):
    base = spark.range(1).select()
    desktop = request_grid(base, timeframes=TIMEFRAMES, categories=category_rows("desktop"))
    assert desktop.count() == 4 and {r.media_set for r in desktop.collect()} == {778228, 20, 23, 26}
    assert request_grid(base, timeframes=TIMEFRAMES, categories=category_rows("multi_platform")).count() == 4
    assert request_grid(base, categories=category_rows("mobile_web_and_app")).count() == 3
    assert request_grid(base, timeframes=TIMEFRAMES, targets=TARGETS).count() == 5
    groups = [{"media_ids": ["1", str(i)]} for i in range(2, 6)]
    assert request_grid(base, timeframes=TIMEFRAMES, targets=TARGETS, reports=groups).count() == 20
    places = spark.createDataFrame([("501", "New York, NY"), ("502", "Boston, MA")], "region_id string, region string")
    local = request_grid(places, timeframes=TIMEFRAMES, categories=category_rows("local_market"))
    ids = with_request_id(local, "local_market", ["region_id", "timeframe", "categories"])
    assert ids.count() == 6 == ids.select("request_id").distinct().count()
    plan = local._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan
    assert len(CATEGORIES["local_market"]) == 3 and len(DESKTOP.measures) == 21


def test_missing_requests(spark):
    grid = spark.createDataFrame([("a",), ("b",), (None,)], "request_id string")
    done = spark.createDataFrame([("a",), ("a",)], "request_id string")
    assert sorted(rows_of(missing_requests(grid, done, ["request_id"]), "request_id"), key=str) == [("b",), (None,)]


def test_report_query(spark):
    fact = spark.createDataFrame(
        [("840", "m1", "1", 1.0), ("840", "m2", "2", 2.0), ("124", "m1", "1", 3.0), ("840", "m3", "1", 4.0)],
        "geo string, media string, metric_id string, v double",
    )
    media_set = spark.createDataFrame([("m1",), ("m1",), ("m2",)], "media string")
    asked = report_query(fact, equals={"geo": "840"}, member_sets={"media": media_set}, measures=[1])
    assert rows_of(asked, "v") == [(1.0,)]
    assert rows_of(report_query(fact, members={"media": ["m3"]}), "v") == [(4.0,)]
    named = decorate_measures(fact, {"1": "Visitors"})
    assert set(rows_of(named, "metric_id", "metric_name", "is_known")) == {("1", "Visitors", True), ("2", None, False)}


def test_config_file(spark, tmp_path):
    config = {
        "table_name": "t",
        "timeframe": [{"time": "1 month average", "id": 1}],
        "categories": [{"media_set": 5, "media_set_type": 2, "name": "five"}],
        "targets": [{"target": 23}, {"targetGroup": 15}],
        "media_measures": [{"id": 1, "name": "Visitors"}],
        "reports": [{"media": [{"id": 1, "name": "A"}, {"id": 2, "name": "B"}]}],
    }
    path = tmp_path / "c.yaml"
    path.write_text(json.dumps(config))
    got = load_config(str(path))
    assert got["timeframes"] == [{"timeframe": "1 month average", "time_type": 1}]
    assert got["targets"][1] == {"target_key": "targetGroup", "target_value": 15}
    assert got["media_groups"][0]["media_ids"] == ["1", "2"] and got["measures"] == {"1": "Visitors"}
    grid = request_grid(spark.range(1).select(), targets=got["targets"], media=got["media_groups"])
    assert grid.count() == 2 and grid.first().media_ids == ["1", "2"]
    path.write_text(json.dumps({"reports": [{"id": 1, "name": "A"}]}))
    assert load_config(str(path))["media"] == [{"media_id": "1", "media_name": "A"}]


def test_markets(spark):
    text = "<E><v><EnumValue Id='501' Value='New York, NY'/><enumvalue value=\"A &amp; B, TX\" id=\"7\"></enumvalue></v></E>"
    found = markets(spark.createDataFrame([(text,)], "payload string"))
    assert sorted(rows_of(found, "region_id", "region", "state")) == [("501", "New York, NY", "NY"), ("7", "A & B, TX", "TX")]


LANDED = "request_id string, report string, data_date date, attempt int, payload string"


def test_readiness(spark):
    queued = "<r><errors>queued</errors></r>"
    day = datetime.date(2019, 3, 1)
    log = spark.createDataFrame(
        [
            ("a", "desktop", day, 1, queued), ("a", "desktop", day, 2, "<r>2</r>"), ("a", "desktop", day, 3, "<r>3</r>"),
            ("a", "desktop", day, 4, queued), ("b", "desktop", day, 1, "<r>1</r>"), ("c", "desktop", day, 1, queued),
        ],
        LANDED,
    )
    assert sorted(rows_of(ready_documents(log), "request_id", "attempt", "payload")) == [("a", 3, "<r>3</r>"), ("b", 1, "<r>1</r>")]
    marked = log.withColumn("is_ready", ~F.col("payload").contains("errors"))
    assert sorted(rows_of(latest_ready(marked, ["request_id"], ["attempt"]), "request_id", "attempt")) == [("a", 3), ("b", 1)]
    grid = spark.createDataFrame([("a",), ("c",), ("d",)], "request_id string")
    assert sorted(rows_of(pending(grid, marked, ["request_id"]), "request_id")) == [("c",), ("d",)]


def test_landing_files_and_table(spark, tmp_path):
    for attempt, text in ((1, "<r><errors/></r>"), (2, "<r>\n<b/>\n</r>")):
        folder = tmp_path / "files" / "report=desktop" / "data_date=2019-03-01" / "request_id=q1" / f"attempt={attempt}"
        folder.mkdir(parents=True)
        (folder / "answer.xml").write_text(text)
    files = read_landing_files(spark, str(tmp_path / "files"))
    assert sorted(rows_of(files, "request_id", "report", "attempt", "payload")) == [
        ("q1", "desktop", 1, "<r><errors/></r>"), ("q1", "desktop", 2, "<r>\n<b/>\n</r>"),
    ]
    assert files.schema["data_date"].dataType.simpleString() == "date" and files.filter("received_at IS NULL").count() == 0
    files.write.partitionBy("report", "data_date").parquet(str(tmp_path / "table"))
    assert read_landing(spark, str(tmp_path / "table"), "desktop").count() == 2
    assert read_landing(spark, str(tmp_path / "table"), "mobile").count() == 0


def test_same_request_ids_in_two_months(spark):
    march, april = datetime.date(2019, 3, 1), datetime.date(2019, 4, 1)
    log = spark.createDataFrame(
        [("a", "desktop", march, 1, "<r>m</r>"), ("a", "desktop", april, 1, "<r>1</r>"), ("a", "desktop", april, 2, "<r>2</r>"), ("a", "mobile", march, 5, "<r>x</r>")], LANDED
    )
    assert sorted(rows_of(ready_documents(log), "report", "payload")) == [("desktop", "<r>2</r>"), ("desktop", "<r>m</r>"), ("mobile", "<r>x</r>")]


def test_an_attempt_landed_twice_counts_once(spark):
    day, at = datetime.date(2019, 3, 1), datetime.datetime
    rows = [("a", day, 1, at(2019, 3, 2), "old"), ("a", day, 1, at(2019, 3, 3), "new"), ("b", day, 1, at(2019, 3, 2), "same"), ("b", day, 1, at(2019, 3, 2), "same")]
    log = spark.createDataFrame(rows, "request_id string, data_date date, attempt int, received_at timestamp_ntz, payload string")
    assert sorted(rows_of(ready_documents(log), "request_id", "payload")) == [("a", "new"), ("b", "same")]


def test_repeated_requests_stop_the_job(spark):
    frame = landing(spark, doc(header(["C", "A", ("v", "1")]), row("M", ["c", "a", "1"]))).drop("timeframe", "categories")
    requests = spark.createDataFrame([("r0", "x", "five")] * 2, "request_id string, timeframe string, categories string")
    with pytest.raises(Exception, match="repeated request"):
        reports.attach_requests(frame, requests).collect()


def test_attached_requests_are_broadcast_and_documents_not_shuffled(spark):
    frame = landing(spark, doc(header(["C", "A", ("v", "1")]), row("M", ["c", "a", "1"]))).drop("timeframe", "categories")
    requests = spark.sql("SELECT * FROM VALUES ('r0', '1 month average', 'five') AS t(request_id, timeframe, categories)")
    out = reports.desktop(reports.attach_requests(frame, requests))
    assert rows_of(out, "media", "timeframe", "categories", "metric_value") == [("M", "1 month average", "five", 1.0)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "payload" not in "".join(x for x in plan.split("\n") if "Exchange hashpartitioning" in x)


def _months(spark, **values):
    return spark.createDataFrame([(datetime.date(2019, int(k[1:]), 1), v) for k, v in values.items()], "data_date date, v int")


def test_months_are_replaced_and_others_stay(spark):
    base = new_folder(spark, "lake")
    path = table_path(base, "facts")
    read = lambda: sorted((str(d), v) for d, v in rows_of(spark.read.parquet(path), "data_date", "v"))
    write_months(_months(spark, m1=1, m2=2), path)
    write_months(_months(spark, m1=1, m2=2), path)
    assert read() == [("2019-01-01", 1), ("2019-02-01", 2)]
    write_months(_months(spark, m2=20, m3=30), path)
    assert read() == [("2019-01-01", 1), ("2019-02-01", 20), ("2019-03-01", 30)]
    assert touched_months(_months(spark, m2=20, m3=30)) == ["2019-02-01", "2019-03-01"]
    assert write_months(_months(spark, m2=21, m1=99), path, ["2019-02-01", "2019-03-01", "2019-05-01"]) == ["2019-03-01", "2019-05-01"]
    assert read() == [("2019-01-01", 1), ("2019-02-01", 21)]
    with pytest.raises(ValueError):
        table_path(base, "x; drop")


def test_catalog_registration_is_repeatable(spark):
    base = new_folder(spark, "lake")
    frame = _months(spark, m1=1, m2=2)
    for _ in range(2):
        path = publish(frame, base, "facts", ["2019-01-01", "2019-02-01"], "facts_registered")
    assert sorted(v for (v,) in rows_of(spark.table("facts_registered"), "v")) == [1, 2]
    write_months(_months(spark, m4=4), path)
    for _ in range(2):
        register_months(spark, "facts_registered", path, ["2019-04-01"])
    assert sorted(v for (v,) in rows_of(spark.table("facts_registered"), "v")) == [1, 2, 4]
    assert spark.sql("SHOW PARTITIONS facts_registered").count() == 3
    pruned = spark.table("facts_registered").filter("data_date = '2019-04-01'")
    assert "PartitionFilters: [isnotnull(data_date" in pruned._jdf.queryExecution().executedPlan().toString()
    publish(_months(spark, m2=5), base, "facts", ["2019-02-01", "2019-04-01"], "facts_registered")
    assert sorted(v for (v,) in rows_of(spark.table("facts_registered"), "v")) == [1, 5]
    assert spark.sql("SHOW PARTITIONS facts_registered").count() == 2
    spark.sql("DROP TABLE facts_registered")
    create_table(spark, "facts_registered", f"{path} it's", frame)
    spark.sql("DROP TABLE facts_registered")


def test_stream_equals_batch_and_keeps_earlier_rows_of_a_month(spark):
    folder = new_folder(spark, "stream")
    schema = "data_date date, v int"
    build = lambda log: log.groupBy("data_date").agg(F.sum("v").cast("int").alias("v"))

    def run():
        source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
        ingest_stream(spark, source, f"{folder}/landing", f"{folder}/table", f"{folder}/checkpoint", build)
        return sorted((str(d), v) for d, v in rows_of(spark.read.parquet(f"{folder}/table"), "data_date", "v"))

    _months(spark, m1=1, m2=2).coalesce(1).write.parquet(f"{folder}/in")
    assert run() == [("2019-01-01", 1), ("2019-02-01", 2)]
    _months(spark, m2=5).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    _months(spark, m2=7, m3=3).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    assert run() == [("2019-01-01", 1), ("2019-02-01", 14), ("2019-03-01", 3)]
    assert run() == [("2019-01-01", 1), ("2019-02-01", 14), ("2019-03-01", 3)]


def test_log_is_compacted_and_repeated_batches_replace_themselves(spark):
    path = new_folder(spark, "landing")
    schema = spark.createDataFrame([], "data_date date, v int, first_batch long").schema
    held = lambda m: sorted(v for (v,) in rows_of(current_log(spark, path, schema, [m]), "v"))
    for batch in (7, 7, 8, 9, 9, 10):
        assert land_batch(_months(spark, m1=batch, m2=2) if batch < 10 else _months(spark, m1=10), path, batch)[0] == "2019-01-01"
    assert held("2019-01-01") == [7, 8, 9, 10] and held("2019-02-01") == [2, 2, 2] and held("2019-05-01") == []
    assert {int(p.name.partition("=")[2]) for p in Path(path, "data_date=2019-01-01").glob("batch_id=*")} == {7, 8, 9, 10}


def test_rows_without_a_month_are_quarantined(spark):
    path = new_folder(spark, "landing")
    assert land_batch(spark.createDataFrame([(None, 1), (datetime.date(2019, 1, 1), 2)], "data_date date, v int"), path, 0) == ["2019-01-01"]
    assert rows_of(spark.read.parquet(f"{path}/_rejected"), "v", "reject_reason") == [(1, "no month")]
