"""Overlap of every pair of media of a large set, as the user × media matrix multiplied by itself in blocks.

Media get dense numbers, and a user is one row with the numbers of their media. Where a user has many, these are cut into blocks, and
every pair of blocks becomes a row of its own, so that the work for one heavy user is spread over many tasks. Only
numbers are unfolded, and pairs are counted on the map side before they are exchanged.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.operators.audience import pair_measures
from tallyloom.operators.rollup import number_users
from tallyloom.plans.joins import null_safe_join

#: Users of more media than this are cut into blocks of media.
LIGHT = 24
BLOCKS = 16


def blocked_users(numbered: DataFrame, by: Sequence[str]) -> DataFrame:
    """``(by, _x, _y)``: for every user of several media the pairs of blocks of their media, from ``(by, _user, _no)``.

    A user's numbers appear at most ``BLOCKS + 1`` times, those of a light user once.
    """
    user = [*by, "_user"]
    sized = numbered.withColumn("_size", F.count(F.lit(1)).over(Window.partitionBy(*user))).filter("_size > 1")
    dealt = sized.withColumn("_block", F.when(F.col("_size") > LIGHT, F.col("_no") % BLOCKS).otherwise(F.lit(0)))
    blocks = dealt.groupBy(*user, "_block").agg(F.collect_list("_no").alias("_numbers"))
    rows = blocks.groupBy(*user).agg(F.sort_array(F.collect_list(F.struct("_block", "_numbers"))).alias("_blocks"))
    first = rows.select(*user, "_blocks", F.posexplode("_blocks").alias("_at", "_x"))
    rest = F.slice("_blocks", F.col("_at") + 1, F.size("_blocks") - F.col("_at"))
    # what is unfolded next is quadratic in the blocks: it is dealt first
    return first.select(*user, "_x", F.explode(rest).alias("_y")).repartition(*user, "_x._block", "_y._block").drop("_user")


def overlap_matrix(
    visits: DataFrame, media: str, user: str, by: Sequence[str] = (), among: DataFrame | None = None
) -> DataFrame:
    """Shared audience of every media with every other, separately per ``by``, with the measures of ``cross_visit``.

    ``visits`` may hold a (user, media) pair any number of times. ``among``, a frame with the column ``media``, names the
    set whose matrix is wanted, such as the largest 5,000; percentages still refer to all users. Visits without a
    user or a media count for no pair; pairs without shared users are left out.
    """
    by = list(by)
    pairs = visits.select(*by, F.col(user).alias("_user"), F.col(media).alias("_media")).distinct().filter("_user IS NOT NULL")
    inside = pairs.filter("_media IS NOT NULL")
    if among is not None:
        inside = inside.join(among.select(F.col(media).alias("_media")).distinct(), "_media", "left_semi")
    numbers = number_users(inside, "_media").withColumnRenamed("number", "_no")
    numbered = inside.join(numbers, "_media").select(*by, "_user", "_no")
    cells = blocked_users(numbered, by)
    left = cells.select(*by, "_y", F.col("_x._block").alias("_low"), F.explode("_x._numbers").alias("_a"))
    both = left.select(*by, "_a", "_low", F.col("_y._block").alias("_high"), F.explode("_y._numbers").alias("_b"))
    # inside one block every pair is met in both orders
    met = both.filter("_low <> _high OR _a < _b").select(*by, F.least("_a", "_b").alias("_a"), F.greatest("_a", "_b").alias("_b"))
    counted = met.groupBy(*by, "_a", "_b").agg(F.count(F.lit(1)).alias("shared"))
    turned = F.explode(F.array(F.struct(F.col("_a").alias("x"), F.col("_b").alias("y")), F.struct(F.col("_b").alias("x"), F.col("_a").alias("y"))))
    matrix = counted.select(*by, "shared", turned.alias("_pair")).select(*by, "shared", F.col("_pair.x").alias("_a"), F.col("_pair.y").alias("_b"))
    sizes = numbered.groupBy(*by, "_no").agg(F.count(F.lit(1)).alias("audience")).join(numbers, "_no")
    own = sizes.select(*by, F.col("_no").alias("_a"), F.col("_media").alias("benchmark"), "audience")
    other = sizes.select(*by, F.col("_no").alias("_b"), F.col("_media").alias("comparison"), F.col("audience").alias("comparison_audience"))
    found = null_safe_join(null_safe_join(matrix, own, [*by, "_a"]), other, [*by, "_b"])
    users = pairs.select(*by, "_user").distinct().groupBy(*by).agg(F.count("_user").alias("_total"))
    return pair_measures(null_safe_join(found, users, by) if by else found.withColumn("_total", users.scalar()), by)
