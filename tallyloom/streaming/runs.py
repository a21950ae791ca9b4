"""The landing log: append-only runs per month, merged by size, and a manifest that names the live ones.

A batch adds one run to each month it touches. As soon as a month has ``FANOUT`` runs of one size class, these become one run, which
belongs to a higher class; so a row is written again at most once per class, and n batches cost n log n rows instead of
the n * n of a log that is rewritten. Nothing is live before a manifest names it, and a manifest replaces the one before
it in a single rename: a batch that is killed anywhere leaves the log as it was, and its repetition starts from there.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.sources.lake import PARTITION

BATCH = "batch_id"
FANOUT = 4
#: month -> [(batch, rows)], the live runs from old to new
Runs = dict[str, list[tuple[int, int]]]


def _folder(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def _manifests(spark: SparkSession, landing_path: str) -> list[int]:
    """The batches whose manifests exist, from old to new."""
    fs, folder = _folder(spark, f"{landing_path}/_manifest")
    names = [str(f.getPath().getName()) for f in fs.listStatus(folder)] if fs.exists(folder) else []
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))


def _manifest(landing_path: str, batch_id: int) -> str:
    return f"{landing_path}/_manifest/{batch_id:020d}.json"


def _read(spark: SparkSession, landing_path: str, batch_id: int) -> Runs:
    fs, file = _folder(spark, _manifest(landing_path, batch_id))
    stream = fs.open(file)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return {month: [(b, n) for b, n in runs] for month, runs in json.loads(text).items()}


def live_runs(spark: SparkSession, landing_path: str, before: int | None = None) -> Runs:
    """What the newest manifest names, or the newest of the batches before one."""
    known = [b for b in _manifests(spark, landing_path) if before is None or b < before]
    return _read(spark, landing_path, known[-1]) if known else {}


def commit(spark: SparkSession, landing_path: str, batch_id: int, runs: Runs) -> None:
    """Make these runs the live ones."""
    fs, target = _folder(spark, _manifest(landing_path, batch_id))
    _, draft = _folder(spark, f"{landing_path}/_manifest/.{batch_id:020d}.draft")
    stream = fs.create(draft, True)
    try:
        stream.write(bytearray(json.dumps(runs).encode()))
    finally:
        stream.close()
    fs.delete(target, False)  # of a batch that is repeated
    if not fs.rename(draft, target):
        raise OSError(f"no manifest was written: {target.toString()}")


def size_class(rows: int) -> int:
    """The largest k with ``FANOUT ** k <= rows``."""
    k = 0
    while FANOUT ** (k + 1) <= rows:
        k += 1
    return k


def to_merge(runs: list[tuple[int, int]], rows: int) -> list[tuple[int, int]]:
    """The runs that become one with a new run of so many rows: those of its class once there are enough, then those of the
    class of the outcome, and so on. Some of the runs stay as they are; the order of rows does not matter in a log."""
    taken: list[tuple[int, int]] = []
    while True:
        rest = [r for r in runs if r not in taken]
        peers = [r for r in rest if size_class(r[1]) == size_class(rows)]
        if len(peers) + 1 < FANOUT:
            return taken
        taken += peers
        rows += sum(n for _, n in peers)


def read_runs(spark: SparkSession, landing_path: str, schema: T.StructType, runs: Runs) -> DataFrame:
    """The rows of some runs, by a fixed schema; nothing is listed but their folders."""
    stored = T.StructType([f for f in schema.fields if f.name != BATCH])
    paths = [f"{landing_path}/{PARTITION}={month}/{BATCH}={b}" for month, of_month in sorted(runs.items()) for b, _ in of_month]
    rows = spark.read.schema(stored).option("basePath", landing_path).parquet(*paths) if paths else spark.createDataFrame([], stored)
    return rows.select(*stored.names)


def add_runs(batch: DataFrame, landing_path: str, batch_id: int, counts: dict[str, int]) -> Runs:
    """Write the batch, which has so many rows of each month, as new runs, merge what is due, and make the outcome live.

    One job writes all months; it reads, apart from the batch, the runs that are merged.
    """
    spark = batch.sparkSession
    before, merged = live_runs(spark, landing_path, before=batch_id), {}
    after = dict(before)
    for month, rows in counts.items():
        taken = to_merge(before.get(month, []), rows)
        merged[month] = taken
        after[month] = [r for r in before.get(month, []) if r not in taken] + [(batch_id, rows + sum(n for _, n in taken))]
    whole = read_runs(spark, landing_path, batch.schema, merged).unionByName(batch)
    (
        whole.withColumn(BATCH, F.lit(batch_id))
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PARTITION, BATCH).parquet(landing_path)
    )
    commit(spark, landing_path, batch_id, after)
    return after


def clean_up(spark: SparkSession, landing_path: str, months: list[str], batch_id: int) -> None:
    """Remove the runs of some months that neither of the two newest manifests before a batch names, and older manifests.

    The manifest before the newest one still serves those who read it, and the batch that is repeated.
    """
    known = [b for b in _manifests(spark, landing_path) if b < batch_id]
    kept = [_read(spark, landing_path, b) for b in known[-2:]]
    for month in months:
        live = {b for runs in kept for b, _ in runs.get(month, [])}
        fs, folder = _folder(spark, f"{landing_path}/{PARTITION}={month}")
        for found in fs.listStatus(folder) if fs.exists(folder) else []:
            name = str(found.getPath().getName())
            number = int(name.partition("=")[2]) if name.startswith(f"{BATCH}=") else batch_id
            if number < batch_id and number not in live:
                fs.delete(found.getPath(), True)
    for b in known[:-2]:
        fs, file = _folder(spark, _manifest(landing_path, b))
        fs.delete(file, False)
