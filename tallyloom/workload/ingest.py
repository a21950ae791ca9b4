"""From landed answers to lake tables: batch, stream and catalog."""

from __future__ import annotations

import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions.periods import month_start, parse_date
from tallyloom.operators.grid import ask, request_grid, request_parameters, with_request_id
from tallyloom.plans.monthly import build_report
from tallyloom.plans.specs import CROSS_VISITING
from tallyloom.plans.workspace import new_folder
from tallyloom.sources.config import TIMEFRAMES, load_config
from tallyloom.sources.lake import publish, touched_months
from tallyloom.sources.landing import read_landing, ready_documents, results_of_jobs
from tallyloom.streaming.ingest import ingest_stream
from tallyloom.workload.documents import CATEGORY_ROWS, desktop_landing, finish
from tallyloom.workload.registry import ORACLES, as_text, query, table


@query(ORACLES["roundtrip_one_header"])
def landed_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Desktop answers in a landing table: request ids that come back every month, an attempt that is not ready, one that was
    landed twice, another report's documents; built, published and read back from the catalog by name."""
    docs = desktop_landing(spark, sf_dir, ["categories"]).select("request_id", "data_date", "payload")
    received = F.to_timestamp_ntz(F.lit("2019-03-22 00:00:00"))
    ready = docs.withColumns({"report": F.lit("desktop"), "attempt": F.month("data_date") + 1, "received_at": received})
    queued = ready.withColumns({"attempt": F.lit(1), "payload": F.lit("<r><errors>queued</errors></r>")})
    late = ready.withColumns({"attempt": F.col("attempt") + 1, "payload": F.lit("<r><errors>queued</errors></r>")})
    other = ready.withColumns({"report": F.lit("mobile_web_and_app"), "payload": F.lit("<r></r>")})
    folder = new_folder(spark, "landed-report")
    queued.unionByName(ready).unionByName(ready).unionByName(late).unionByName(other).write.partitionBy("report", "data_date").parquet(f"{folder}/landing")
    landing = read_landing(spark, f"{folder}/landing", "desktop")
    grid = with_request_id(request_grid(spark.range(1).select(), timeframes=TIMEFRAMES, categories=CATEGORY_ROWS), "desktop", ["categories"])
    name = f"landed_report_{uuid.uuid4().hex}"
    publish(build_report(landing, "desktop", grid), folder, "desktop", touched_months(landing), name)
    return finish(spark.table(name), "metric_value")


@query("""
    WITH e AS (SELECT *, ts::DATE AS d FROM events WHERE event_type <> 'error')
    SELECT d::VARCHAR AS data_date, user_id % 20 AS request, max(event_id) AS event_id, max_by(event_type, event_id) AS event_type
    FROM e WHERE day(d) <> 5 GROUP BY ALL""")
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as answers that arrive in 20 drops, one batch each: the same request ids every day, answers up to two drops late, some
    landed again, and at last attempts that take the fifth of the month back."""
    events = table(spark, sf_dir, "events")
    answers = events.select(
        (F.col("user_id") % 20).cast("string").alias("request_id"), F.lit("events").alias("report"), F.col("ts").cast("date").alias("data_date"),
        F.col("event_id").alias("attempt"), F.col("ts").alias("received_at"), F.col("event_type").alias("payload"),
        (F.col("event_type") != "error").alias("is_ready"),
    )
    day, late = F.dayofmonth("data_date"), F.pmod(F.col("attempt"), F.lit(3))
    arrival = F.floor((day - 1) * 16 / 31) + late
    taken_back = answers.filter("day(data_date) = 5 AND is_ready").withColumns({"attempt": F.lit(2**40), "payload": F.lit("")}).distinct()
    folder = new_folder(spark, "stream-ingest")
    drops = [answers.filter(arrival == k) for k in range(18)] + [answers.filter((day < 4) & (late < 2)), taken_back]
    for drop in drops:
        drop.write.mode("append").parquet(f"{folder}/in")
    files = len(spark.read.parquet(f"{folder}/in").inputFiles())
    source = spark.readStream.schema(answers.schema).option("maxFilesPerTrigger", -(-files // len(drops))).parquet(f"{folder}/in")

    def build(log: DataFrame) -> DataFrame:
        newest = ready_documents(log).filter("payload <> ''")
        return newest.select("data_date", F.col("request_id").cast("bigint").alias("request"), F.col("attempt").alias("event_id"), F.col("payload").alias("event_type"))

    ingest_stream(spark, source, f"{folder}/landing", f"{folder}/table", f"{folder}/checkpoint", build)
    return as_text(spark.read.parquet(f"{folder}/table"), "data_date")


@query("""
    SELECT '1995-03-01' AS month, o_orderpriority AS media, m.id AS metric_id, count(*) AS n
    FROM orders, (VALUES ('54'), ('228')) m(id)
    WHERE o_orderdate >= DATE '1995-03-01' AND o_orderdate < DATE '1995-04-01' AND o_orderpriority IN ('1-URGENT', '5-LOW')
    GROUP BY ALL""")
def configured_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report request whose media and measures come from a configuration file."""
    config = load_config(str(Path(__file__).with_name("pair_report.yaml")))
    per_month = table(spark, sf_dir, "orders").groupBy(month_start(F.col("o_orderdate")).alias("month"), F.col("o_orderpriority").alias("media")).agg(F.count(F.lit(1)).alias("n"))
    ids = F.array(*[F.lit(str(m)) for m in CROSS_VISITING.measures])
    fact = per_month.withColumn("metric_id", F.explode(ids))
    parameters = request_parameters(CROSS_VISITING, 0, media=[m["media_name"] for m in config["media"]])
    fact = fact.withColumn("period", F.when(F.col("month") == parse_date(F.lit("1995-03-01")), 0).otherwise(1))
    asked = ask(fact, CROSS_VISITING, parameters, {"timePeriod": "period", "media": "media"}, measures=list(config["measures"]))
    return as_text(asked.drop("period"), "month")


@query("""
    SELECT u.conv_id, u.turn AS asked, a.turn AS answered, length(a.text) AS n_chars
    FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
    WHERE u.role = 'user' AND a.role = 'assistant'""")
def jobs_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User turns as submissions whose answer names a job, the next assistant turn as that job's result."""
    turns = table(spark, sf_dir, "conversations")
    named = F.concat(F.lit("<r><jobId>"), F.concat_ws("-", "conv_id", F.col("turn") + 1), F.lit(" </jobId></r>"))
    submitted = turns.filter("role = 'user'").select("conv_id", F.col("turn").alias("asked"), named.alias("payload"))
    results = turns.filter("role = 'assistant'").select(F.concat_ws("-", "conv_id", "turn").alias("job_id"), F.col("turn").alias("answered"), F.length("text").alias("n_chars"))
    return results_of_jobs(submitted, results).drop("job_id")
