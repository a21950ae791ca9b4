"""Publishing months so that no reader sees a mixture of old and new files.

Every publish writes its months to a folder of its own. Only when all files are there is the catalog told, one month at a time,
where the month now lies; that is a single change of one partition, so a reader of the table has either the old month or the
new one. Whatever stops a publish before that leaves the table as it was. The files a month had before stay until
the next publish of that month, for readers that have planned with them.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.sources.lake import PARTITION, _identifier, _text, create_table, drop_months, table_path

VERSION = "version"


def new_version() -> str:
    """A name that sorts behind those of earlier publishes."""
    return f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"


def _file_system(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def _exists(spark: SparkSession, path: str) -> bool:
    fs, folder = _file_system(spark, path)
    return fs.exists(folder)


def registered_months(spark: SparkSession, table: str) -> list[str]:
    """The months that the catalog knows of a table."""
    return sorted(r[0].partition("=")[2] for r in spark.sql(f"SHOW PARTITIONS {_identifier(table)}").collect())


def month_location(spark: SparkSession, table: str, month: str) -> str:
    """Where the catalog says that a month lies."""
    rows = spark.sql(f"DESCRIBE FORMATTED {_identifier(table)} PARTITION ({PARTITION}={_text(month)})").collect()
    return next(r["data_type"] for r in rows if r["col_name"] == "Location")


def _point_to(spark: SparkSession, table: str, month: str, location: str, known: bool) -> None:
    partition = f"PARTITION ({PARTITION}={_text(month)})"
    if known:
        spark.sql(f"ALTER TABLE {_identifier(table)} {partition} SET LOCATION {_text(location)}")
    else:
        spark.sql(f"ALTER TABLE {_identifier(table)} ADD {partition} LOCATION {_text(location)}")


def _retire(spark: SparkSession, path: str, month: str, version: str, kept: set[str]) -> None:
    """Remove a month's folders of versions before this one, but those that are kept."""
    fs, folder = _file_system(spark, path)
    for found in fs.listStatus(folder):
        name = str(found.getPath().getName())
        if name.startswith(f"{VERSION}=") and name.partition("=")[2] < version and name not in kept:
            old = spark._jvm.org.apache.hadoop.fs.Path(found.getPath(), f"{PARTITION}={month}")
            fs.delete(old, True)
            rest = [str(f.getPath().getName()) for f in fs.listStatus(found.getPath())]
            if not any(r.startswith(f"{PARTITION}=") for r in rest):
                fs.delete(found.getPath(), True)


def publish_version(df: DataFrame, base: str, table: str, months: Iterable, catalog_table: str) -> str:
    """Replace exactly ``months`` of the catalog table, also by nothing, each in one step; gives the version's folder.

    Readers go by the catalog: the folders below the table's path hold more than one version. A month has one publisher at a time.
    A publish that failed is simply done again; what it had written goes with the next one that succeeds.
    """
    spark, named, version = df.sparkSession, sorted({str(m) for m in months}), new_version()
    path = table_path(base, table)
    folder = f"{path}/{VERSION}={version}"
    create_table(spark, catalog_table, path, df)
    (
        df.filter(F.col(PARTITION).cast("string").isin(*named)).hint("rebalance", PARTITION)
        .write.option("compression", "snappy").partitionBy(PARTITION).parquet(folder)
    )
    known = set(registered_months(spark, catalog_table))
    before = {m: month_location(spark, catalog_table, m) for m in named if m in known}
    for month in named:
        if _exists(spark, f"{folder}/{PARTITION}={month}"):
            _point_to(spark, catalog_table, month, f"{folder}/{PARTITION}={month}", month in known)
        else:
            drop_months(spark, catalog_table, [month])
    spark.catalog.refreshTable(catalog_table)
    for month in named:
        parts = before.get(month, "").rstrip("/").split("/")
        _retire(spark, path, month, version, {p for p in parts if p.startswith(f"{VERSION}=")})
    return folder
