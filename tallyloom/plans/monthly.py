"""From the landing table to published months, for any of the six reports."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.operators.accounting import DocumentAccount
from tallyloom.plans.reports import BUILDERS, attach_requests
from tallyloom.sources.landing import ready_documents, with_readiness
from tallyloom.sources.lake import publish, table_path
from tallyloom.sources.versions import publish_version
from tallyloom.streaming.ingest import ingest_stream


def build_report(landing: DataFrame, report: str, requests: DataFrame | None = None, account: DocumentAccount | None = None, **options) -> DataFrame:
    """The report's table from all its landed attempts.

    ``requests`` labels the documents by request id; without it the landing frame carries the labels itself. ``account``
    counts what became of every document while the table is written.
    """
    ready = ready_documents(landing.filter(F.col("report") == report))
    labelled = ready if requests is None else attach_requests(ready, requests)
    return BUILDERS[report](labelled, watch=None if account is None else account.watch, **options)


def run_month(
    landing: DataFrame, report: str, month: str, base: str, table: str, requests: DataFrame | None = None,
    catalog_table: str | None = None, account: DocumentAccount | None = None, versioned: bool = False, **options,
) -> str:
    """Build one month of one report and replace its partition; any day of the month may be given.

    With ``versioned`` the month of the catalog table changes in one step (``publish_version``), else its files are replaced in place.
    """
    first = date.fromisoformat(month).replace(day=1)
    of_month = landing.filter(F.col("data_date") == F.lit(first))
    built = build_report(of_month, report, requests, account, **options)
    if versioned:
        if catalog_table is None:
            raise ValueError("versions are read through the catalog: name a catalog table")
        return publish_version(built, base, table, [first], catalog_table)
    return publish(built, base, table, [first], catalog_table)


def stream_report(
    spark: SparkSession, source: DataFrame, report: str, landing_path: str, base: str, table: str, checkpoint: str,
    requests: DataFrame | None = None, **options,
) -> None:
    """Take in newly landed answers of a stream and rebuild the months they belong to."""

    def build(landing: DataFrame) -> DataFrame:
        return build_report(landing, report, requests, **options)

    ingest_stream(spark, with_readiness(source), landing_path, table_path(base, table), checkpoint, build)
