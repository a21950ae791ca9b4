"""Run the registered queries against their SQL and compare whole results."""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def oracle(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _value(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    return None if v is None else str(v)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(str(_value(r[i])) for i in order) for r in rows)


def difference(df, con, sql: str) -> str | None:
    """None when both results hold the same columns and rows."""
    spark_rows = df.collect()
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(df.columns):
        return f"columns differ: {sorted(df.columns)} / {sorted(names)}"
    got, want = _rows(df.columns, spark_rows), _rows(names, result.fetchall())
    if got == want:
        return None
    only_got = [r for r in got if r not in set(want)][:3]
    only_want = [r for r in want if r not in set(got)][:3]
    return f"{len(got)} rows / {len(want)} rows; only in result {only_got}; only in SQL {only_want}"


def main(sf_dir: str, names: list[str]) -> None:
    from pyspark.sql import SparkSession

    import __spark_entry__ as e

    spark = (
        SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8").config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "8g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = oracle(sf_dir)
    for name, fn in e.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            sql = e.oracle_sql().get(name)
            df = fn(spark, sf_dir)
            outcome = f"rows={df.count()} (no SQL)" if sql is None else difference(df, con, sql) or "same"
        except Exception as x:  # noqa: BLE001
            outcome = f"ERROR {str(x)[:1500]}"
        print(f"{name:28s} {time.time() - start:6.2f}s {outcome}", flush=True)
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
