"""Unique visitors of any timeframe from monthly rollups, without the events.

Users get dense numbers once. A month's rollup holds, for every media, bitmaps over these numbers in buckets of 32,768; bitmaps of
several months are combined bit by bit, which counts a user once however many months they came in. Where an estimate is
enough, a sketch of fixed size takes the place of the bitmaps.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Slices in which users are numbered; the users of a slice are sorted together.
SLICES = 1024
#: Standard errors within which an estimate's bounds lie, and the standard error of a merged sketch with one register.
DEVIATIONS, REGISTER_ERROR = 4, 1.04


def number_users(users: DataFrame, user: str, known: DataFrame | None = None) -> DataFrame:
    """``(user, number)``: the users of ``known`` as they are, and new ones numbered on without gaps, from 1.

    Users are numbered within slices of a hash; a slice's first number follows from the sizes of the slices before it, which are
    ``SLICES`` rows. Null users get none.
    """
    new = users.select(user).filter(F.col(user).isNotNull()).distinct()
    if known is not None:
        new = new.join(known.select(user), user, "left_anti")
    sliced = new.withColumn("_slice", F.pmod(F.xxhash64(user), F.lit(SLICES)))
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sliced.groupBy("_slice").agg(F.count(F.lit(1)).alias("_n"))
    first = sizes.select("_slice", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    place = F.row_number().over(Window.partitionBy("_slice").orderBy(user))
    numbered = sliced.join(first, "_slice").select(user, (F.col("_first") + place).alias("number"))
    if known is None:
        return numbered
    last = known.agg(F.coalesce(F.max("number"), F.lit(0)).alias("n"))
    return known.select(user, "number").unionByName(numbered.withColumn("number", F.col("number") + last.scalar()))


def visitor_bitmaps(visits: DataFrame, numbers: DataFrame, period: str, media: str, user: str) -> DataFrame:
    """``(period, media, bucket, bitmap)``: the rollup of visits that may hold a (user, media) pair any number of times.

    A media that everybody visits has many buckets, so no group is larger than a bucket.
    """
    met = visits.select(period, media, user).distinct().join(numbers, user)
    bucket = F.bitmap_bucket_number("number").alias("bucket")
    return met.groupBy(period, media, bucket).agg(F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bitmap"))


def _by_end(rollup: DataFrame, period: str, months: int) -> DataFrame:
    """Every row once for each timeframe it belongs to, named by the last month; timeframes end in months that have rows."""
    ends = rollup.select(F.col(period).alias("_end")).distinct()
    steps = F.sequence(F.lit(0), F.lit(months - 1))
    dealt = rollup.withColumn("_end", F.explode(F.transform(steps, lambda k: F.add_months(period, k))))
    return dealt.join(ends, "_end").drop(period).withColumnRenamed("_end", period)


def unique_visitors(bitmaps: DataFrame, period: str, media: str, months: int = 1) -> DataFrame:
    """Exact unique visitors per media of the ``months`` up to and with every month, from the rollup alone."""
    merged = _by_end(bitmaps, period, months).groupBy(period, media, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
    counted = merged.groupBy(period, media).agg(F.sum(F.bitmap_count("bitmap")).alias("unique_visitors"))
    return counted.select(period, media, F.lit(months).alias("months"), "unique_visitors")


def visitor_sketches(visits: DataFrame, period: str, media: str, user: str, log2_size: int = 14) -> DataFrame:
    """``(period, media, sketch)``: a rollup of fixed size for every media, whatever its audience."""
    return visits.groupBy(period, media).agg(F.hll_sketch_agg(user, F.lit(log2_size)).alias("sketch"))


def estimated_visitors(sketches: DataFrame, period: str, media: str, months: int = 1, log2_size: int = 14) -> DataFrame:
    """Estimated unique visitors of a timeframe and the bounds ``low`` and ``high``, from the sketches alone.

    The bounds are ``DEVIATIONS`` standard errors away; the error does not grow with the number of months.
    """
    error = DEVIATIONS * REGISTER_ERROR / math.sqrt(2**log2_size)
    merged = _by_end(sketches, period, months).groupBy(period, media).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("estimate"))
    return merged.select(
        period, media, F.lit(months).alias("months"), "estimate", F.floor(F.col("estimate") * (1 - error)).alias("low"),
        F.ceil(F.col("estimate") * (1 + error)).alias("high"),
    )
