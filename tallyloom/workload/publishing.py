"""Accounts of what was published, and what readers see meanwhile."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions.periods import month_start
from tallyloom.operators.accounting import DocumentAccount, unbalanced
from tallyloom.plans.joins import null_safe_join
from tallyloom.plans.monthly import build_report
from tallyloom.plans.workspace import new_folder
from tallyloom.sources.lake import publish, touched_months
from tallyloom.sources.landing import latest_ready, read_landing
from tallyloom.sources.versions import publish_version
from tallyloom.workload.documents import desktop_landing, mobile_landing
from tallyloom.workload.registry import as_text, query, table

NO_TABLE = "<Envelope><Body><Report>no data</Report></Body></Envelope>"


def _emptied(payload: Column, bare: Column, headed: Column) -> Column:
    """The answer itself, or one without a table, or one whose table ends with its header."""
    header_only = F.regexp_replace(payload, "(?s)<TBODY>.*</TBODY>", "<TBODY></TBODY>")
    return F.when(bare, F.lit(NO_TABLE)).when(headed, header_only).otherwise(payload)


@query("""
    WITH a AS (SELECT DISTINCT date_trunc('month', o_orderdate)::DATE AS d, o_orderpriority, o_orderstatus FROM orders),
    m AS (SELECT d, count(*) AS n FROM a GROUP BY d),
    c(categories) AS (VALUES ('expanded categories'), ('topline categories'), ('custom entities')),
    x AS (
      SELECT 'desktop' AS report, d, n, CASE WHEN month(d) % 4 = 0 AND categories = 'custom entities' THEN 'no_table'
             WHEN month(d) % 3 = 0 AND categories <> 'topline categories' THEN 'empty' ELSE 'with_rows' END AS outcome
      FROM m CROSS JOIN c
      UNION ALL
      SELECT 'mobile_web_and_app', DATE '2024-01-01', n, CASE WHEN day(d) % 7 = 0 THEN 'no_table' WHEN day(d) % 5 = 0 THEN 'empty' ELSE 'with_rows' END
      FROM (SELECT ts::DATE AS d, count(DISTINCT event_type) AS n FROM events GROUP BY ALL))
    SELECT report, d::VARCHAR AS data_date, count(*) AS asked, count(*) AS ready, count(*) FILTER (outcome = 'with_rows') AS with_rows,
           count(*) FILTER (outcome = 'empty') AS empty, count(*) FILTER (outcome = 'no_table') AS no_table,
           coalesce(sum(n) FILTER (outcome = 'with_rows'), 0)::BIGINT AS scanned, true AS balanced
    FROM x GROUP BY ALL""")
def documents_reconciled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two reports' landed answers, some without a table, some with a header only, all asked for twice and landed twice: what became of
    each ready one, counted by the job that publishes the rows, against the ids of the log."""
    month, day = F.month("data_date"), F.dayofmonth(F.col("categories").cast("date"))
    sets = F.col("categories")
    desktop = desktop_landing(spark, sf_dir, ["data_date", "categories"])
    desktop = desktop.withColumn("payload", _emptied(F.col("payload"), (month % 4 == 0) & (sets == "custom entities"), (month % 3 == 0) & (sets != "topline categories")))
    mobile = mobile_landing(spark, sf_dir)
    mobile = mobile.withColumn("payload", _emptied(F.col("payload"), day % 7 == 0, day % 5 == 0))
    landed = [d.select("request_id", "data_date", "categories", F.lit(name).alias("report"), F.lit(2).alias("attempt"), "payload") for name, d in (("desktop", desktop), ("mobile_web_and_app", mobile))]
    ready = landed[0].unionByName(landed[1])
    queued = ready.withColumns({"attempt": F.lit(1), "payload": F.lit("<r><errors>queued</errors></r>")})
    folder = new_folder(spark, "accounts")
    for part in (queued, ready, ready):
        part.withColumns({"is_ready": F.col("attempt") == 2, "timeframe": F.lit("1 month average")}).write.mode("append").partitionBy("report", "data_date").parquet(f"{folder}/landing")
    accounts = []
    for report in ("desktop", "mobile_web_and_app"):
        landing = read_landing(spark, f"{folder}/landing", report)
        account = DocumentAccount(report, touched_months(landing))
        publish(build_report(landing, report, account=account), folder, report, account.months)
        accounts.append(account.frame(spark))
    found = accounts[0].unionByName(accounts[1])
    ids = latest_ready(read_landing(spark, f"{folder}/landing").drop("payload"), ["report", "data_date", "request_id"], ["attempt"])
    wrong = unbalanced(found, ids).select("report", "data_date", F.lit(False).alias("_fits"))
    asked = ids.groupBy("report", "data_date").agg(F.count(F.lit(1)).alias("asked"))
    out = null_safe_join(null_safe_join(asked, found, ["report", "data_date"], "full"), wrong, ["report", "data_date"], "left")
    return as_text(out.withColumn("balanced", F.coalesce("_fits", F.lit(True))).drop("_fits"), "data_date")


@query("""
    WITH m AS (SELECT date_trunc('month', o_orderdate)::DATE AS d, o_orderpriority AS media, count(*) AS n FROM orders GROUP BY ALL)
    SELECT phase, d::VARCHAR AS data_date, media, CASE WHEN phase = 'after' AND d >= DATE '1995-01-01' AND d < DATE '1996-01-01' THEN 10 * n ELSE n END AS n
    FROM m CROSS JOIN (VALUES ('before'), ('during'), ('after')) p(phase)
    WHERE NOT (phase = 'after' AND d >= DATE '1996-01-01' AND d < DATE '1997-01-01')""")
def published_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A month table as its readers see it: before a publish, after one that broke off while it wrote the year 1995, and after one that
    replaced that year and emptied the next."""
    counted = table(spark, sf_dir, "orders").groupBy(month_start(F.col("o_orderdate")).alias("data_date"), F.col("o_orderpriority").alias("media")).agg(F.count(F.lit(1)).alias("n"))
    folder, name = new_folder(spark, "versions"), f"versions_{uuid.uuid4().hex}"
    year = lambda first, last: [m for m in every if first <= m < last]
    seen = []

    def look(phase: str) -> None:
        spark.table(name).withColumn("phase", F.lit(phase)).write.parquet(f"{folder}/seen/{phase}")
        seen.append(spark.read.parquet(f"{folder}/seen/{phase}"))

    every = touched_months(counted)
    publish_version(counted, folder, "months", every, name)
    look("before")
    changed = year("1995", "1996")
    raised = counted.withColumn("n", F.col("n") * 10)
    broken = raised.withColumn("n", F.when(F.month("data_date") == 12, F.raise_error(F.lit("broken off")).cast("bigint")).otherwise(F.col("n")))
    try:
        publish_version(broken, folder, "months", changed, name)
    except PySparkException as x:
        if "broken off" not in str(x):
            raise
    look("during")
    publish_version(raised.filter("year(data_date) = 1995"), folder, "months", [*changed, *year("1996", "1997")], name)
    look("after")
    return as_text(reduce(DataFrame.unionByName, seen), "data_date")
