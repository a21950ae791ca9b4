"""Uniqueness, completeness and reconciliation checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def assert_unique(df: DataFrame, keys: Sequence[str]) -> None:
    """Raise when a key occurs twice."""
    found = duplicate_keys(df, keys).limit(1).collect()
    if found:
        raise ValueError(f"duplicate key: {found[0].asDict()}")


def missing_requests(grid: DataFrame, results: DataFrame, on: Sequence[str]) -> DataFrame:
    """Requests of the grid that have no result."""
    return grid.join(results.select(*on).distinct(), list(on), "left_anti")


def reconcile(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    """Scanned, kept and rejected row counts of one parsed frame; kept + rejected = scanned."""
    return rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("scanned"),
        F.count_if(F.col("reject_reason").isNull()).alias("kept"),
        F.count_if(F.col("reject_reason").isNotNull()).alias("rejected"),
    )


def conform(df: DataFrame, schema: T.StructType, extra: Sequence[str] = ()) -> DataFrame:
    """Bind the columns to a schema by name, cast them and check the outcome."""
    lacking = [f.name for f in schema if f.name not in df.columns]
    if lacking:
        raise ValueError(f"columns missing from report: {lacking}")
    out = df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema], *extra)
    got = [(f.name, f.dataType) for f in out.schema][: len(schema)]
    if got != [(f.name, f.dataType) for f in schema]:
        raise ValueError(f"unexpected schema: {got}")
    return out
