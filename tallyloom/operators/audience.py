"""Measures over raw events: who was reached, and who was reached by several media."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyloom.plans.joins import null_safe_join

# Bits of one non-negative 64-bit mask.
MASK_BITS = 62


def key_measures(
    events: DataFrame, period: str, media: str, user: str, value: str, scaled: bool = False
) -> DataFrame:
    """Unique visitors, pages, minutes and reach per period and media.

    Users are reduced to one row per (period, media, user) before anything meets on the smaller keys. ``scaled`` gives
    visitors in thousands, pages and minutes in millions.
    """
    per_user = events.groupBy(period, media, user).agg(F.count(F.lit(1)).alias("pages"), F.sum(value).alias("minutes"))
    per_media = per_user.groupBy(period, media).agg(
        F.count(user).alias("unique_visitors"), F.sum("pages").alias("pages"), F.sum("minutes").alias("minutes")
    )
    # from the reduced rows: the events are read and shuffled once
    totals = per_user.select(period, user).distinct().groupBy(period).agg(F.count(user).alias("_total"))
    return _with_reach(per_media, totals, period, scaled)


def _with_reach(per_media: DataFrame, totals: DataFrame, period: str, scaled: bool) -> DataFrame:
    reach = F.col("unique_visitors").cast("double") * 100 / F.col("_total")
    out = null_safe_join(per_media, totals, [period]).withColumn("reach", reach).drop("_total")
    if scaled:
        units = {"unique_visitors": 1_000, "pages": 1_000_000, "minutes": 1_000_000}
        out = out.withColumns({c: F.col(c).cast("double") / unit for c, unit in units.items()})
    return out


def _listed(spark: SparkSession, comparison: Sequence) -> DataFrame:
    """``(comparison, _no)``: the listed media with their places, as a frame made of one literal."""
    entries = F.array(*[F.lit(m) for m in dict.fromkeys(comparison)])
    return spark.range(1).select(F.posexplode(entries).alias("_no", "comparison"))


def pair_measures(found: DataFrame, by: list[str], kept: Sequence[str] = ()) -> DataFrame:
    """The pair measures from shared and single audiences and the number of users."""
    shared = F.col("shared").cast("double")
    expected = F.col("audience").cast("double") * F.col("comparison_audience")
    return found.select(
        *by, "benchmark", "comparison", "shared",
        (shared * 100 / F.col("audience")).alias("horizontal"),
        (shared * 100 / F.col("comparison_audience")).alias("vertical"),
        # Observed over expected overlap; 100 for independent audiences.
        (shared * 100 * F.col("_total") / expected).alias("index"),
        *kept,
    )


def cross_visit(
    visits: DataFrame, media: str, user: str, comparison: Sequence, by: Sequence[str] = ()
) -> DataFrame:
    """Shared audience of every media with every listed comparison media, separately per ``by`` (month, target …).

    ``visits`` may hold a (user, media) pair any number of times; it is reduced to distinct pairs first. The listed
    media a user visited become the bits of numbered masks (62 to a mask), combined on the map side and joined back to
    the user's media; adaptive execution splits that join for a user with very many media. Users of a media with the
    same mask are then one row with a count, and only those rows are unfolded into bits. No pair of visits is ever
    formed, and the plan is the same whatever the length of the list. Pairs without shared users are left out.
    """
    by = list(by)
    listed = _listed(visits.sparkSession, comparison)
    pairs = visits.select(*by, F.col(user).alias("_user"), F.col(media).alias("benchmark")).distinct()
    known = pairs.join(listed, F.col("benchmark") == F.col("comparison"))
    bit = F.expr(f"shiftleft(1L, _no % {MASK_BITS})")
    masks = known.groupBy(*by, "_user", F.floor(F.col("_no") / MASK_BITS).alias("_part")).agg(F.bit_or(bit).alias("_mask"))
    groups = pairs.join(masks, [*by, "_user"]).groupBy(*by, "benchmark", "_part", "_mask").agg(F.count(F.lit(1)).alias("_n"))
    bits = F.filter(F.sequence(F.lit(0), F.lit(MASK_BITS - 1)), lambda i: F.call_function("getbit", F.col("_mask"), i) == 1)
    unfolded = groups.select(*by, "benchmark", "_part", "_n", F.explode(bits).alias("_bit"))
    unfolded = unfolded.withColumn("_no", F.col("_part") * MASK_BITS + F.col("_bit"))
    shared = unfolded.groupBy(*by, "benchmark", "_no").agg(F.sum("_n").alias("shared"))
    named = shared.join(listed, "_no").filter(F.col("benchmark") != F.col("comparison"))
    audience = pairs.groupBy(*by, "benchmark").agg(F.count("_user").alias("audience"))
    other = audience.select(*by, F.col("benchmark").alias("comparison"), F.col("audience").alias("comparison_audience"))
    found = named.join(audience, [*by, "benchmark"]).join(other, [*by, "comparison"])
    users = pairs.groupBy(*by, "_user").agg(F.count(F.lit(1))).groupBy(*by).agg(F.count("_user").alias("_total"))
    return pair_measures(found.join(users, by) if by else found.withColumn("_total", users.scalar()), by)


#: A listed media's sketch is met by very many others; it is copied so often, and they are dealt among the copies.
COPIES = 32


def cross_visit_approx(
    visits: DataFrame, media: str, user: str, comparison: Sequence, log2_size: int = 12, by: Sequence[str] = ()
) -> DataFrame:
    """The same measures from one sketch per media, plus the estimated audiences; pairs with nothing shared are left out.

    The error is about 2 / sqrt(2 ** log2_size) of the larger audience.
    """
    by = list(by)
    sketches = visits.groupBy(*by, F.col(media).alias("benchmark")).agg(F.theta_sketch_agg(user, log2_size).alias("sketch"))
    names = F.array(*[F.lit(m) for m in dict.fromkeys(comparison)])
    left = sketches.withColumn("_copy", F.pmod(F.xxhash64("benchmark"), F.lit(COPIES))).withColumn("comparison", F.explode(names))
    right = sketches.join(_listed(visits.sparkSession, comparison), F.col("benchmark") == F.col("comparison")).select(
        *by, "comparison", F.col("sketch").alias("other"), F.explode(F.expr(f"sequence(0L, {COPIES - 1}L)")).alias("_copy")
    )
    estimate = F.theta_sketch_estimate
    met = left.filter(F.col("benchmark") != F.col("comparison")).join(right, [*by, "comparison", "_copy"]).select(
        *by, "benchmark", "comparison", estimate(F.theta_intersection("sketch", "other")).alias("shared"),
        estimate("sketch").alias("audience"), estimate("other").alias("comparison_audience"),
    )
    total = visits.groupBy(*by).agg(estimate(F.theta_sketch_agg(user, log2_size)).alias("_total"))
    met = met.filter("shared > 0")
    met = met.join(total, by) if by else met.withColumn("_total", total.scalar())
    return pair_measures(met, by, ["audience", "comparison_audience"])


def duplication(
    visits: DataFrame, media: str, user: str, sets: dict[str, Sequence], by: Sequence[str] = ()
) -> DataFrame:
    """Net reach and duplicated audience of configured sets of media, separately per ``by``.

    ``sets`` maps a name to its media. A visit is tagged with the sets that hold its media; per set and user only a
    count remains.
    """
    by = list(by)
    names: dict = {}
    for name, members in sets.items():
        for m in members:
            names.setdefault(m, []).append(name)
    tags = F.create_map(*[x for m, ns in names.items() for x in (F.lit(m), F.array(*[F.lit(n) for n in ns]))])
    size = F.create_map(*[x for n, ms in sets.items() for x in (F.lit(n), F.lit(len(set(ms))))])
    listed = visits.filter(F.col(media).isin(*names)).select(*by, user, media).distinct()
    tagged = listed.select(*by, user, F.explode(F.try_element_at(tags, F.col(media))).alias("media_set"))
    per_user = tagged.groupBy(*by, "media_set", user).agg(F.count(F.lit(1)).alias("_n"))
    return per_user.groupBy(*by, "media_set").agg(
        F.count_if(F.col("_n") == F.try_element_at(size, F.col("media_set"))).alias("duplicated_all_sites"),
        F.count_if(F.col("_n") >= 2).alias("duplicated_2_or_more_sites"),
        F.count(F.lit(1)).alias("unduplicated"),
    )


def top_entities(fact: DataFrame, period: str, entity: str, measure: str, n: int, salts: int = 32) -> DataFrame:
    """The n largest entities of every period, ties by entity.

    ``fact`` has one row per period and entity. A first ranking within salted slices of a period keeps at most n rows
    per slice; the final ranking then sees n * salts rows, however large the period is.
    """
    order = [F.col(measure).desc_nulls_last(), F.col(entity).asc()]
    salted = fact.withColumn("_salt", F.pmod(F.xxhash64(entity), F.lit(salts)))
    slice_rank = F.row_number().over(Window.partitionBy(period, "_salt").orderBy(*order))
    kept = salted.withColumn("_rank", slice_rank).filter(F.col("_rank") <= n).drop("_rank", "_salt")
    rank = F.row_number().over(Window.partitionBy(period).orderBy(*order))
    return kept.withColumn("rank", rank).filter(F.col("rank") <= n)


def timeframe_average(
    fact: DataFrame, keys: Sequence[str], period_id: str, value: str, months: int, name: str = "average"
) -> DataFrame:
    """Mean of the values of the last ``months`` periods, by period id, so that gaps count as absent months.

    Rows are first combined to one per key and period, which leaves a window at most as long as the calendar.
    """
    per_period = fact.groupBy(*keys, period_id).agg(F.sum(value).alias("_sum"), F.count(value).alias("_n"))
    frame = Window.partitionBy(*keys).orderBy(period_id).rangeBetween(-(months - 1), 0)
    total, n = F.sum("_sum").over(frame), F.sum("_n").over(frame)
    return per_period.withColumn(name, F.when(n > 0, total.cast("double") / n)).drop("_sum", "_n")
