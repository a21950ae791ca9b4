"""The largest entities without summing all of them: a sketch proposes candidates, exact sums of these alone prove the answer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.audience import top_entities
from tallyloom.plans.joins import null_safe_join
from tallyloom.plans.workspace import new_folder

#: Tables of the sketch, and cells of each for every entity that is wanted.
TABLES = 2
CELLS = 16


def _cell(entity: str, number: int, cells: int) -> Column:
    return F.pmod(F.xxhash64(entity, F.lit(number)), F.lit(cells))


def _kept(df: DataFrame, name: str) -> DataFrame:
    """Written and read back, so that Spark knows the size of what it joins with."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sketch(events: DataFrame, period: str, entity: str, measure: str, cells: int) -> DataFrame:
    """``(period, _table, _cell, _bound)``: what all entities of a cell add up to, which none of them can exceed."""
    places = F.array(*[F.struct(F.lit(k).alias("_table"), _cell(entity, k, cells).alias("_cell")) for k in range(TABLES)])
    added = events.select(period, F.greatest(F.col(measure), F.lit(0)).alias("_value"), F.explode(places).alias("_at"))
    return added.select(period, "_at.*", "_value").groupBy(period, "_table", "_cell").agg(F.sum("_value").alias("_bound"))


def _inside(events: DataFrame, period: str, entity: str, chosen: DataFrame, number: int, cells: int) -> DataFrame:
    """The events whose entity lies in one of the chosen cells of a table."""
    mine = chosen.filter(F.col("_table") == number).select(period, "_cell")
    return null_safe_join(events.withColumn("_cell", _cell(entity, number, cells)), mine, [period, "_cell"], "left_semi").drop("_cell")


def candidates(events: DataFrame, period: str, entity: str, measure: str, n: int, cells: int | None = None) -> DataFrame:
    """The events of all entities that can be among the ``n`` largest of their period, and of some that are not.

    The ``n`` heaviest cells of the first table hold at least ``n`` entities. The n-th largest exact sum among these is a
    threshold that the answer cannot fall below, so an entity whose bound is smaller in any table is none of it. Where a
    period has no such threshold, all its entities are candidates.
    """
    cells = cells or CELLS * n
    bounds = _kept(sketch(events, period, entity, measure, cells), "bounds")
    heaviest = top_entities(bounds.filter("_table = 0"), period, "_cell", "_bound", n).select(period, "_table", "_cell")
    first = _inside(events, period, entity, _kept(heaviest, "heaviest"), 0, cells)
    sums = first.groupBy(period, entity).agg(F.sum(measure).alias("_sum"))
    threshold = top_entities(sums, period, entity, "_sum", n).filter(F.col("rank") == n).select(period, F.col("_sum").alias("_least"))
    known = null_safe_join(bounds, threshold, [period], "left")
    chosen = _kept(known.filter("_least IS NULL OR _bound >= _least").select(period, "_table", "_cell"), "chosen")
    for number in range(TABLES):
        events = _inside(events, period, entity, chosen, number, cells)
    return events


def proven_top(events: DataFrame, period: str, entity: str, measure: str, n: int, cells: int | None = None) -> DataFrame:
    """``(period, entity, measure, rank)``: the ``n`` entities of every period with the largest sums, ties by entity.

    The rows of ``top_entities`` over the summed events, but only candidates are summed: what is exchanged grows with the cells
    of the sketch and with ``n``, not with the number of entities. Sums have to be exact, so ``measure`` holds whole
    numbers or decimals.
    """
    if events.schema[measure].dataType.typeName() in ("float", "double"):
        raise TypeError(f"{measure} must be of an exact type")
    # other columns, which could be named like those made here, are left behind
    plain = events.select(F.col(period).alias("p"), F.col(entity).alias("e"), F.col(measure).alias("v"))
    sums = candidates(plain, "p", "e", "v", n, cells).groupBy("p", "e").agg(F.sum("v").alias("v"))
    return top_entities(sums, "p", "e", "v", n).select(F.col("p").alias(period), F.col("e").alias(entity), F.col("v").alias(measure), "rank")
