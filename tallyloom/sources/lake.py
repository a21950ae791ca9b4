"""Month-partitioned lake tables."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PARTITION = "data_date"


def table_path(base: str, table: str) -> str:
    return f"{base.rstrip('/')}/{_identifier(table)}"


def _identifier(name: str) -> str:
    if not re.fullmatch(r"[A-Za-z_][A-Za-z0-9_]*(\.[A-Za-z_][A-Za-z0-9_]*)?", name):
        raise ValueError(f"not a table name: {name!r}")
    return name


def _month_files(spark: SparkSession, path: str, month: str) -> tuple:
    """The folder of a month, its file system, and the names of the files in it."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{PARTITION}={month}")
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    names = {str(f.getPath().getName()) for f in fs.listStatus(folder)} if fs.exists(folder) else set()
    return fs, folder, names


def write_months(df: DataFrame, path: str, months: Iterable | None = None) -> list[str]:
    """Replace months and leave all others alone; gives the named months that hold no rows now.

    With ``months``, exactly these are replaced: one for which the frame has no rows ends empty. Without, the months the
    frame touches are. The rebalance hint gathers each month into files of the advisory size; a month that is far
    larger than the others is split over several tasks.
    """
    spark = df.sparkSession
    named = sorted({str(m) for m in months or ()})
    if months is not None:
        df = df.filter(F.col(PARTITION).cast("string").isin(*named))
    before = {m: _month_files(spark, path, m)[2] for m in named}
    (
        df.hint("rebalance", PARTITION)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .partitionBy(PARTITION)
        .parquet(path)
    )
    empty = []
    for month in named:
        fs, folder, now = _month_files(spark, path, month)
        if now == before[month]:  # the write put no new file there
            fs.delete(folder, True)
            empty.append(month)
    return empty


def _text(value: str) -> str:
    """A string as an SQL literal."""
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def create_table(spark: SparkSession, table: str, path: str, df: DataFrame) -> None:
    """External table over the path, if it does not exist yet."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {_identifier(table)} ({columns}) USING parquet "
        f"PARTITIONED BY ({PARTITION}) LOCATION {_text(path)}"
    )


def register_months(spark: SparkSession, table: str, path: str, months: Iterable) -> None:
    """Add the months' partitions to the catalog; months that are there already stay."""
    specs = " ".join(
        f"PARTITION ({PARTITION}={_text(m)}) LOCATION {_text(f'{path}/{PARTITION}={m}')}" for m in sorted({str(m) for m in months})
    )
    if specs:
        spark.sql(f"ALTER TABLE {_identifier(table)} ADD IF NOT EXISTS {specs}")
    spark.catalog.refreshTable(table)


def drop_months(spark: SparkSession, table: str, months: Iterable) -> None:
    """Take the months' partitions out of the catalog; months that are not there are passed over."""
    specs = ", ".join(f"PARTITION ({PARTITION}={_text(m)})" for m in sorted({str(m) for m in months}))
    if specs:
        spark.sql(f"ALTER TABLE {_identifier(table)} DROP IF EXISTS {specs}")


def touched_months(df: DataFrame) -> list:
    """The distinct months of a frame, without null; a calendar bounds their number."""
    return sorted(str(r[0]) for r in df.select(PARTITION).where(F.col(PARTITION).isNotNull()).distinct().collect())


def publish(df: DataFrame, base: str, table: str, months: Iterable, catalog_table: str | None = None) -> str:
    """Replace exactly ``months`` and, when a catalog table is named, bring its partitions in line. Other months are neither
    read nor listed."""
    spark, named = df.sparkSession, sorted({str(m) for m in months})
    path = table_path(base, table)
    empty = write_months(df, path, named)
    if catalog_table:
        create_table(spark, catalog_table, path, df)
        drop_months(spark, catalog_table, empty)
        register_months(spark, catalog_table, path, set(named) - set(empty))
    return path
