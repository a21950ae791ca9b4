"""The landing log: rows written, repeated batches, clean-up."""

import datetime
import math
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tallyloom.plans.workspace import new_folder
from tallyloom.streaming import ingest, runs
from tallyloom.streaming.ingest import current_log, land_batch
from tallyloom.streaming.runs import live_runs, size_class, to_merge

MONTH = "2019-01-01"


def batch(spark, first, n, month=1):
    return spark.range(first, first + n).select(F.lit(datetime.date(2019, month, 1)).alias("data_date"), F.col("id").alias("v"))


def held(spark, path, month=MONTH):
    schema = spark.createDataFrame([], "data_date date, v long, first_batch long").schema
    return sorted(r.v for r in current_log(spark, path, schema, [month]).select("v").collect())


def test_rows_written_grow_with_n_log_n():
    for sizes in ([10] * 4096, [1, 100, 7, 3] * 700, [2**k for k in range(20)] * 3):
        live, written = [], 0
        for k, n in enumerate(sizes):
            taken = to_merge(live, n)
            live = [r for r in live if r not in taken] + [(k, n + sum(m for _, m in taken))]
            written += live[-1][1]
        total = sum(sizes)
        assert sum(n for _, n in live) == total
        assert written <= total * (2 + math.log(total, runs.FANOUT))
        assert len(live) <= (runs.FANOUT - 1) * (1 + size_class(total))


def test_log_holds_every_batch_and_reads_only_live_runs(spark):
    path = new_folder(spark, "runs")
    for k in range(12):
        assert land_batch(batch(spark, 10 * k, 10), path, k) == [MONTH]
        assert held(spark, path) == list(range(10 * k + 10))
    assert len(live_runs(spark, path)[MONTH]) < 6
    folders = {int(p.name.partition("=")[2]) for p in Path(path, f"data_date={MONTH}").glob("batch_id=*")}
    assert folders >= {b for b, _ in live_runs(spark, path)[MONTH]} and len(folders) < 12
    assert len(list(Path(path, "_manifest").glob("*.json"))) <= 3


@pytest.mark.parametrize("where", ["before", "after"])
def test_a_batch_killed_around_its_manifest_is_repeated(spark, monkeypatch, where):
    path = new_folder(spark, "runs")
    for k in range(7):
        land_batch(batch(spark, 10 * k, 10).unionByName(batch(spark, 0, 1, month=2)), path, k)
    commit = runs.commit

    def killed(*args):
        if where == "after":
            commit(*args)
        raise RuntimeError("killed")

    with monkeypatch.context() as m:
        m.setattr(runs, "commit", killed)
        for _ in range(2):
            with pytest.raises(RuntimeError):
                land_batch(batch(spark, 70, 10), path, 7)
        assert held(spark, path) == list(range(70 if where == "before" else 80))
    land_batch(batch(spark, 70, 10), path, 7)
    assert held(spark, path) == list(range(80))
    assert held(spark, path, "2019-02-01") == [0] * 7
    land_batch(batch(spark, 80, 10), path, 8)
    assert held(spark, path) == list(range(90))


def test_an_empty_batch_changes_nothing(spark):
    path = new_folder(spark, "runs")
    land_batch(batch(spark, 0, 3), path, 0)
    assert ingest.land_batch(batch(spark, 0, 3).where("false"), path, 1) == []
    assert held(spark, path) == [0, 1, 2] and held(spark, path, "2020-01-01") == []
