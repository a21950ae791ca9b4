"""What became of every document, counted by the job that writes its rows."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallyloom.plans.joins import null_safe_join

PARTITION = "data_date"
ACCOUNT_SCHEMA = "report string, data_date date, ready long, with_rows long, empty long, no_table long, scanned long"
OUTCOMES = ("with_rows", "empty", "no_table")


def outcome(data_rows: str = "data_rows") -> Column:
    """What a parsed document holds: rows, a table without any (a header at most), or no table at all."""
    n = F.size(data_rows)
    return F.when(F.col(data_rows).isNull(), F.lit("no_table")).when(n > 0, F.lit("with_rows")).otherwise(F.lit("empty"))


class DocumentAccount:
    """Counts of documents and their data rows per month, observed while a job reads them.

    ``watch`` adds the counting to a plan; any job that runs the plan to its end takes it along, so no document is read
    or parsed again for it. ``months`` are named beforehand, as an observation holds a fixed list of numbers; documents of other
    months, and those without one, stand under the null month, so that none is left out. An account can watch one
    frame and belongs to its first job.
    """

    def __init__(self, report: str, months: Iterable):
        self.report, self.months = report, sorted({str(m) for m in months})
        self.observation = Observation(f"documents of {report}")

    def watch(self, tables: DataFrame, data_rows: str = "data_rows") -> DataFrame:
        """``tables`` as they are, one row per document, with the counting on the way."""
        day = F.col(PARTITION).cast("string")
        of_month = [day == m for m in self.months] + [~F.coalesce(day.isin(*self.months), F.lit(False))]
        metrics = []
        for k, here in enumerate(of_month):
            metrics.append(F.count_if(here).alias(f"ready_{k}"))
            metrics += [F.count_if(here & (outcome(data_rows) == o)).alias(f"{o}_{k}") for o in OUTCOMES]
            metrics.append(F.coalesce(F.sum(F.when(here, F.greatest(F.size(data_rows), F.lit(0)))), F.lit(0)).alias(f"scanned_{k}"))
        return tables.observe(self.observation, *metrics)

    def frame(self, spark: SparkSession) -> DataFrame:
        """The account, one row per month that has documents; waits for the job that was watched."""
        found, rows = self.observation.get, []
        for k, month in enumerate([*self.months, None]):
            counts = [int(found[f"{name}_{k}"]) for name in ("ready", *OUTCOMES, "scanned")]
            if counts[0]:
                rows.append((self.report, month, *counts))
        made = spark.createDataFrame(rows, ACCOUNT_SCHEMA.replace("data_date date", "data_date string"))
        return made.withColumn(PARTITION, F.col(PARTITION).cast("date"))


def unbalanced(account: DataFrame, ready: DataFrame) -> DataFrame:
    """Months whose documents do not add up: ``ready`` (``report, data_date, ...``, a row for each ready request, from ids alone) against the
    documents that were read, and these against their outcomes."""
    asked = ready.groupBy("report", PARTITION).agg(F.count(F.lit(1)).alias("asked"))
    met = null_safe_join(asked, account, ["report", PARTITION], "full")
    parts = F.col("with_rows") + F.col("empty") + F.col("no_table")
    return met.filter(~(F.col("asked").eqNullSafe(F.col("ready")) & F.col("ready").eqNullSafe(parts)))


def silent_documents(tables: DataFrame, data_rows: str = "data_rows") -> DataFrame:
    """The quarantine of documents: those of ``parse_tables`` that give no row, with the reason."""
    found = tables.withColumn("reject_reason", outcome(data_rows)).filter(F.col("reject_reason") != "with_rows")
    return found.select(*[c for c in ("report", PARTITION, "request_id") if c in tables.columns], "reject_reason")
