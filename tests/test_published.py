"""Accounts of documents, months that change in one step, look-ups that leave the texts where they are."""

import datetime
import uuid
from pathlib import Path

import pytest
from payloads import doc, header, row, rows_of
from pyspark.sql import functions as F

from tallyloom.operators.accounting import DocumentAccount, silent_documents, unbalanced
from tallyloom.operators.parse import parse_tables
from tallyloom.plans.monthly import build_report, run_month
from tallyloom.plans.specs import DESKTOP, REPORTS
from tallyloom.plans.workspace import new_folder
from tallyloom.sources import landing as landings
from tallyloom.sources import versions
from tallyloom.sources.landing import latest_ready, read_landing, ready_documents, with_readiness

HEAD = header(["Category", "Attribute", ("Visitors", "1")])
GOOD = doc(HEAD, row("A", ["c", "a", "1"]), row("B", ["c", "a"]))
SCHEMA = "request_id string, report string, data_date date, attempt int, payload string, timeframe string, categories string"
MARCH, APRIL = datetime.date(2019, 3, 1), datetime.date(2019, 4, 1)


def landed(spark, *rows):
    full = [(q, "desktop", d, n, p, "1 month average", "five") for q, d, n, p in rows]
    return with_readiness(spark.createDataFrame(full, SCHEMA))


ROWS = [
    ("q1", MARCH, 1, "<r><errors/></r>"), ("q1", MARCH, 2, GOOD), ("q2", MARCH, 1, "<r>nothing</r>"), ("q3", MARCH, 1, doc(HEAD)),
    ("q4", MARCH, 1, doc()), ("q1", APRIL, 1, GOOD), ("q1", APRIL, 1, GOOD), ("q5", None, 1, GOOD), ("q6", MARCH, 1, ""), ("q7", MARCH, 1, None),
]


def test_every_document_is_accounted_for(spark):
    frame, account = landed(spark, *ROWS), DocumentAccount("desktop", [MARCH, APRIL])
    built = build_report(frame, "desktop", account=account)
    assert built.count() == 3  # the good row of each good document
    found = account.frame(spark)
    counts = {r[0]: r[1:] for r in rows_of(found, "data_date", "ready", "with_rows", "empty", "no_table", "scanned")}
    assert counts == {MARCH: (6, 1, 2, 3, 2), APRIL: (1, 1, 0, 0, 2), None: (1, 1, 0, 0, 2)}
    ids = latest_ready(frame, ["report", "data_date", "request_id"], ["attempt"])
    assert unbalanced(found, ids).count() == 0
    lost = unbalanced(found, ids.unionByName(ids.filter("request_id = 'q5'").withColumn("request_id", F.lit("q8"))))
    assert rows_of(lost, "data_date", "asked", "ready") == [(None, 2, 1)]


def test_silent_documents_are_named(spark):
    tables = parse_tables(ready_documents(landed(spark, *ROWS)), DESKTOP)
    assert sorted(rows_of(silent_documents(tables), "request_id", "reject_reason")) == [("q2", "no_table"), ("q3", "empty"), ("q4", "empty"), ("q6", "no_table"), ("q7", "no_table")]


@pytest.mark.parametrize("report", sorted(REPORTS))
def test_accounts_of_all_reports_read_the_texts_once(spark, report):
    spec = REPORTS[report]
    heads = [HEAD] * spec.header_rows
    frame = landed(spark, ("q1", MARCH, 1, doc(*heads)), ("q2", MARCH, 1, "<r/>")).withColumn("report", F.lit(report))
    frame = frame.withColumns({"region": F.lit("x"), "region_id": F.lit("1"), "media_ids": F.array(F.lit("1"))})
    folder = new_folder(spark, "landing")
    frame.write.partitionBy("report", "data_date").parquet(folder)
    account = DocumentAccount(report, [MARCH])
    built = build_report(read_landing(spark, folder), report, account=account)
    plan = built._jdf.queryExecution().executedPlan().toString()
    assert sum("payload" in x for x in plan.splitlines() if "ReadSchema" in x) == 1
    assert built.count() == 0
    assert rows_of(account.frame(spark), "ready", "with_rows", "empty", "no_table") == [(2, 0, 1, 1)]


def many(spark, folder):
    rows = [(f"q{i}", MARCH if i % 2 else APRIL, n, f"<r>{i} {n}</r>") for i in range(30) for n in range(1, 2 + i % 3)]
    frame = landed(spark, *rows, ("q0", APRIL, 1, "<r>0 1</r>"), ("q9", None, 1, "<r>a</r>"), ("q9", None, 1, "<r>b</r>"), (None, MARCH, 1, "<r>x</r>"), (None, MARCH, 2, "<r>y</r>"))
    for part in (frame, frame.filter("request_id = 'q3'")):
        part.write.mode("append").partitionBy("report", "data_date").parquet(folder)
    return read_landing(spark, folder)


@pytest.mark.parametrize("bound", [100_000, 12, 2, 0])
def test_newest_documents_without_moving_their_texts(spark, monkeypatch, bound):
    """With broadcasts by size off, no exchange lies above a scan of texts, whether the look-up is sent whole or by months."""
    frame = many(spark, new_folder(spark, "landing"))
    monkeypatch.setattr(landings, "LOOKED_UP", bound)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = ready_documents(frame)
        got = sorted(rows_of(out, "request_id", "data_date", "payload"), key=str)
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        exchanged = [x for x in out._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange hashpartitioning" in x and "payload" in x]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    want = [(f"q{i}", MARCH if i % 2 else APRIL, f"<r>{i} {1 + i % 3}</r>") for i in range(30)] + [("q9", None, "<r>b</r>"), (None, MARCH, "<r>y</r>")]
    assert got == sorted(want, key=str)
    assert "payload" in plan
    if bound >= 12:  # below that, a single month exceeds the bound and the choice is Spark's
        assert exchanged == [] and "SortMergeJoin" not in out._jdf.queryExecution().executedPlan().toString()


def facts(spark, **values):
    return spark.createDataFrame([(datetime.date(2019, int(k[1:]), 1), v) for k, v in values.items()], "data_date date, v int")


def seen(spark, name):
    return sorted((str(d), v) for d, v in rows_of(spark.table(name), "data_date", "v"))


def test_a_month_changes_in_one_step(spark, monkeypatch):
    base, name = new_folder(spark, "lake"), f"t_{uuid.uuid4().hex}"
    every = ["2019-01-01", "2019-02-01", "2019-03-01"]
    first = versions.publish_version(facts(spark, m1=1, m2=2), base, "facts", every, name)
    old = [("2019-01-01", 1), ("2019-02-01", 2)]
    assert seen(spark, name) == old
    planned = spark.table(name)
    planned.count()

    broken = facts(spark, m1=10, m2=20).withColumn("v", F.when(F.col("v") == 20, F.raise_error(F.lit("broken"))).otherwise(F.col("v")).cast("int"))
    with pytest.raises(Exception, match="broken"):
        versions.publish_version(broken, base, "facts", every, name)
    assert seen(spark, name) == old

    point_to = versions._point_to

    def stops_at_february(spark_, table, month, *rest):
        if month == "2019-02-01":
            raise RuntimeError("killed")
        point_to(spark_, table, month, *rest)

    with monkeypatch.context() as m:
        m.setattr(versions, "_point_to", stops_at_february)
        with pytest.raises(RuntimeError):
            versions.publish_version(facts(spark, m1=10, m2=20), base, "facts", every, name)
    spark.catalog.refreshTable(name)
    assert seen(spark, name) == [("2019-01-01", 10), ("2019-02-01", 2)]  # each month is whole

    last = versions.publish_version(facts(spark, m2=21, m3=30), base, "facts", every, name)
    assert seen(spark, name) == [("2019-02-01", 21), ("2019-03-01", 30)]
    assert versions.registered_months(spark, name) == ["2019-02-01", "2019-03-01"]
    folders = {p.name: sorted(x.name for x in p.glob("data_date=*")) for p in Path(base, "facts").glob("version=*")}
    # a month's files stay for one more publish; what broken publishes left is gone
    assert folders[Path(first).name] == ["data_date=2019-02-01"] and folders[Path(last).name] == ["data_date=2019-02-01", "data_date=2019-03-01"]
    assert len(folders) == 3
    versions.publish_version(facts(spark, m2=22), base, "facts", every, name)
    assert Path(first).name not in {p.name for p in Path(base, "facts").glob("version=*")}
    assert seen(spark, name) == [("2019-02-01", 22)]
    spark.sql(f"DROP TABLE {name}")


def test_a_versioned_month_of_a_report(spark):
    base, name = new_folder(spark, "lake"), f"t_{uuid.uuid4().hex}"
    for value in ("1", "2"):
        frame = landed(spark, ("q1", MARCH, 1, doc(HEAD, row("A", ["c", "a", value]))))
        run_month(frame, "desktop", "2019-03-09", base, "desktop", catalog_table=name, versioned=True)
        assert rows_of(spark.table(name), "media", "metric_value") == [("A", float(value))]
    run_month(frame.filter("false"), "desktop", "2019-03-09", base, "desktop", catalog_table=name, versioned=True)
    assert spark.table(name).count() == 0
    with pytest.raises(ValueError, match="catalog"):
        run_month(frame, "desktop", "2019-03-09", base, "desktop", versioned=True)
    spark.sql(f"DROP TABLE {name}")
