"""Keeping expensive columns from being computed again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def computed_once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add columns behind a one-row generator.

    The optimizer moves filters below projections and repeats the projected expressions in them. It does not move
    them below a generator that makes the columns, so these are evaluated a single time per row. The expressions
    themselves are projected first, which compiles them; a generator would interpret them.
    """
    fields = F.struct(*[c.alias(name) for name, c in columns.items()])
    return df.withColumn("_once", F.array(fields)).select(*df.columns, F.inline_outer("_once"))


def exploded(df: DataFrame, array: Column | str, name: str, position: str | None = None) -> DataFrame:
    """Explode without the size filter that an inner explode adds below itself, for arrays that are costly to make.

    The array is projected first and leaves the frame with the explode, so that no row carries it along.
    """
    source = array if isinstance(array, str) else "_items"
    made = df if isinstance(array, str) else df.withColumn(source, array)
    kept = [c for c in made.columns if c != source]
    if position:
        out = made.select(*kept, F.posexplode_outer(source).alias(position, name))
    else:
        out = made.select(*kept, F.explode_outer(source).alias(name))
    return out.filter(F.col(name).isNotNull())


def spread(df: DataFrame, *by: str) -> DataFrame:
    """Deal rows out by a hash of the columns ``by``, ahead of work that costs far more than an exchange of the rows.

    A scan gives no more tasks than its files have row groups. Adaptive execution sets the number here: one partition
    for each core at least, and more of them as the rows outgrow its advisory size.
    """
    return df.repartition(F.xxhash64(*by))
