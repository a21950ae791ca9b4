"""Incremental landing and rebuild of the months a batch touches."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.sources.lake import PARTITION, write_months
from tallyloom.sources.landing import LANDING_SCHEMA
from tallyloom.streaming.runs import BATCH, add_runs, clean_up, live_runs, read_runs


def landing_source(spark: SparkSession, path: str) -> DataFrame:
    """Answers that arrive as parquet files, as a stream."""
    return spark.readStream.schema(LANDING_SCHEMA).parquet(path)


def land_batch(batch: DataFrame, landing_path: str, batch_id: int) -> list[str]:
    """Add one micro-batch to the log; gives the months it holds.

    The batch becomes one run of each of its months (``tallyloom.streaming.runs``), so what was landed before is written again
    only when runs are merged. A batch that is repeated after a failure, wherever that was, ends in the same state.
    Rows without a month cannot belong to any; they are kept below ``_rejected`` with the reason.
    """
    spark = batch.sparkSession
    found = batch.groupBy(F.col(PARTITION).cast("string").alias("month")).agg(F.count(F.lit(1)).alias("n")).collect()
    counts = {r["month"]: r["n"] for r in sorted(found, key=lambda r: r["month"] or "")}
    if counts.pop(None, 0):
        (
            batch.filter(F.col(PARTITION).isNull()).withColumn("reject_reason", F.lit("no month"))
            .write.mode("overwrite").parquet(f"{landing_path}/_rejected/{BATCH}={batch_id}")
        )
    if counts:
        clean_up(spark, landing_path, list(counts), batch_id)
        dated = batch.filter(F.col(PARTITION).isNotNull()).withColumn("first_batch", F.lit(batch_id).cast("long"))
        add_runs(dated, landing_path, batch_id, counts)
    return list(counts)


def current_log(spark: SparkSession, landing_path: str, schema: T.StructType, months: list[str]) -> DataFrame:
    """All landed rows of some months, as the newest manifest names them."""
    runs = live_runs(spark, landing_path)
    return read_runs(spark, landing_path, schema, {m: runs[m] for m in months if m in runs})


def ingest_stream(
    spark: SparkSession,
    source: DataFrame,
    landing_path: str,
    table_path: str,
    checkpoint: str,
    build: Callable[[DataFrame], DataFrame],
) -> None:
    """Take in everything new at the source once, then stop.

    Each micro-batch is added to the landing log. The months it holds are then rebuilt by ``build`` from the *whole* log of
    these months and replaced, also by nothing, so a late document neither drops what came before it nor leaves what
    it took back. Both writes are repeatable: a batch that is run again after a failure ends in the same state.
    """

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        months = land_batch(batch, landing_path, batch_id)
        if months:
            schema = T.StructType([*batch.schema.fields, T.StructField("first_batch", T.LongType())])
            write_months(build(current_log(batch.sparkSession, landing_path, schema, months)), table_path, months)

    query = (
        source.writeStream.trigger(availableNow=True)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(on_batch)
        .start()
    )
    query.awaitTermination()
