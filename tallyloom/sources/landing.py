"""Landed report documents: scan, market discovery, readiness."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions.text import resolve_references
from tallyloom.operators.parse import TAG, attribute, has_errors, job_id
from tallyloom.plans.joins import null_safe_join
from tallyloom.plans.workspace import new_folder

LANDING_SCHEMA = (
    "request_id string, report string, data_date date, attempt int, received_at timestamp_ntz, payload string"
)


#: The file and the place in it that a landed row was read from.
LANDED = "landed"


def with_landed_ids(stored: DataFrame) -> DataFrame:
    """Name every row of a frame that was read from parquet files by its place, which tells equal rows apart."""
    return stored.withColumn(LANDED, F.struct("_metadata.file_path", "_metadata.row_index"))


def read_landing(spark: SparkSession, path: str, report: str | None = None) -> DataFrame:
    """The landing table with ``landed`` ids; report and month filters prune its directories."""
    landing = with_landed_ids(spark.read.parquet(path))
    return landing if report is None else landing.filter(F.col("report") == report)


def read_landing_files(spark: SparkSession, path: str) -> DataFrame:
    """Documents landed one per file below ``report=…/data_date=…/request_id=…/attempt=…`` directories."""
    files = spark.read.text(path, wholetext=True)
    return files.select(
        F.col("request_id").cast("string"),
        F.col("report").cast("string"),
        F.col("data_date").cast("date"),
        F.col("attempt").cast("int"),
        F.to_timestamp_ntz(F.col("_metadata.file_modification_time").cast("string")).alias("received_at"),
        F.col("value").alias("payload"),
    )


def markets(discovery: DataFrame, payload: str = "payload") -> DataFrame:
    """Market dimension from discovery responses: every ``enumvalue`` element's id and value."""
    carried = [c for c in discovery.columns if c != payload]
    tag = rf"(?i)<enumvalue(?=[\s/>])({TAG})>"
    tags = F.regexp_extract_all(resolve_references(F.col(payload)), F.lit(tag), F.lit(1))
    found = discovery.select(*carried, F.explode(tags).alias("tag"))
    region = attribute(F.col("tag"), "value")
    return found.select(
        *carried, attribute(F.col("tag"), "id").alias("region_id"), region.alias("region"),
        F.right(region, F.lit(2)).alias("state"),
    )


def latest_ready(log: DataFrame, request: list[str], order: list[str], ready: str = "is_ready") -> DataFrame:
    """Newest ready attempt of every request, as the values of ``order``.

    A maximum per request combines before the shuffle, so a request polled very often costs no more than others.
    """
    best = F.max(F.struct(*order)).alias("_best")
    return log.filter(F.col(ready)).groupBy(*request).agg(best).select(*request, "_best.*")


def pending(grid: DataFrame, log: DataFrame, request: list[str], ready: str = "is_ready") -> DataFrame:
    """Requests of the grid without a ready attempt so far."""
    done = log.filter(F.col(ready)).select(*request).distinct()
    return grid.join(done, request, "left_anti")


def with_readiness(landing: DataFrame) -> DataFrame:
    """Mark ready answers. Stored with the landing table, the mark spares later look-ups the document text."""
    return landing if "is_ready" in landing.columns else landing.withColumn("is_ready", ~has_errors(F.col("payload")))


def results_of_jobs(submitted: DataFrame, results: DataFrame, payload: str = "payload") -> DataFrame:
    """Results with the request that submitted their job.

    ``submitted`` holds the answers to submissions, whose text names the job; ``results`` has a column ``job_id``. A result of an
    unknown job, and a submission whose answer names none, meet nothing.
    """
    jobs = submitted.withColumn("job_id", job_id(F.col(payload))).drop(payload).filter("job_id IS NOT NULL")
    return results.join(jobs, "job_id")


#: What names a request: the same id comes back every month.
REQUEST_KEY = ("report", "data_date", "request_id")


def request_key(landing: DataFrame) -> list[str]:
    """The columns of ``REQUEST_KEY`` that the frame has."""
    return [c for c in REQUEST_KEY if c in landing.columns]


#: As many look-up rows, of ids and attempt numbers, go to every task at a time.
LOOKED_UP = 100_000


def _month_groups(newest: DataFrame, month: Column) -> list[tuple[list[str], int]]:
    """Months whose look-up rows fit in ``LOOKED_UP`` together, or single ones that do not, with the number of their rows."""
    groups: list[tuple[list[str], int]] = []
    for name, n in sorted(tuple(r) for r in newest.groupBy(month.alias("month")).count().collect()):
        if groups and groups[-1][1] + n <= LOOKED_UP:
            groups[-1] = (groups[-1][0] + [name], groups[-1][1] + n)
        else:
            groups.append(([name], n))
    return groups


def _with_newest(log: DataFrame, newest: DataFrame, key: list[str]) -> DataFrame:
    """The log with the look-up's ``_best``, null where it has no row; the log itself, with its texts, is not exchanged.

    A look-up of at most ``LOOKED_UP`` rows is broadcast. A larger one is cut into groups of months, each of which scans its own
    part of the log. A month has one row for each request that was asked again, and the request grid bounds these;
    should one month still exceed the bound, Spark chooses its join.
    """
    if newest.count() <= LOOKED_UP:
        return null_safe_join(log, F.broadcast(newest), key, "left")
    if "data_date" not in key:
        return null_safe_join(log, newest, key, "left")
    month = F.coalesce(F.col("data_date").cast("string"), F.lit(""))
    parts, known = [], []
    for names, n in _month_groups(newest, month):
        part = newest.filter(month.isin(names))
        parts.append(null_safe_join(log.filter(month.isin(names)), F.broadcast(part) if n <= LOOKED_UP else part, key, "left"))
        known += names
    rest = log.filter(~month.isin(known)).withColumn("_best", F.lit(None).cast(newest.schema["_best"].dataType))
    return reduce(DataFrame.unionByName, parts, rest)


def ready_documents(landing: DataFrame) -> DataFrame:
    """The newest ready document of every request of every report and month, exactly one of each.

    Of several rows of one attempt (an answer that was landed again) the last received counts, then the last batch's, then the
    last by place (``landed``). The look-up reads ids and attempt numbers only and holds the requests with more than one
    ready row. Texts are not exchanged; only for frames without ``landed`` ids are those rows that agree in all else.
    """
    log, key = with_readiness(landing).filter("is_ready"), request_key(landing)
    order = [c for c in ("attempt", "received_at", "first_batch", LANDED) if c in landing.columns]
    ties = log.groupBy(*key, *order).agg(F.count(F.lit(1)).alias("_n"))
    best = ties.groupBy(*key).agg(F.max(F.struct(*order, "_n")).alias("_best"), F.sum("_n").alias("_all"))
    folder = new_folder(landing.sparkSession, "newest")
    best.filter("_all > 1").select(*key, "_best").write.parquet(folder)
    newest = landing.sparkSession.read.parquet(folder)
    picked = _with_newest(log, newest, key)
    same = [F.col(c).eqNullSafe(F.col(f"_best.{c}")) for c in order]
    picked = picked.filter(F.col("_best").isNull() | reduce(lambda a, b: a & b, same))
    if LANDED in order:
        return picked.drop("_best", "is_ready", LANDED)
    once = picked.filter("_best IS NULL OR _best._n = 1").drop("_best", "is_ready")
    again = picked.filter("_best._n > 1").drop("_best", "is_ready").dropDuplicates(key)
    return once.unionAll(again)
