"""Unpivot, pivot, split, join and pair-up on long facts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.plans.joins import null_safe_join
from tallyloom.plans.staging import computed_once


def unpivot(df: DataFrame, keys: Sequence[str], values: Sequence[str], name: str = "metric", value: str = "metric_value") -> DataFrame:
    """Wide to long; rows with a null value stay."""
    return df.unpivot(list(keys), list(values), name, value)


def pivot_strict(
    df: DataFrame,
    keys: Sequence[str],
    column: str,
    value: str,
    names: dict[str, str],
    on_duplicate: str = "fail",
) -> DataFrame:
    """Long to wide with a pinned list of labels (label -> output column).

    One map-side combined aggregation gives the values and the evidence of uniqueness. A key that holds a label twice
    stops the job (``fail``) or shows up as ``is_duplicate`` (``flag``). Labels outside the list give no column.
    """
    label = F.col(column)
    aggs: list[Column] = []
    for text, out in names.items():
        aggs.append(F.max(F.when(label == text, F.col(value))).alias(out))
        aggs.append(F.count_if(label == text).alias(f"_n_{out}"))
    wide = df.groupBy(*keys).agg(*aggs)
    duplicate = F.greatest(*[F.col(f"_n_{c}") for c in names.values()], F.lit(0)) > 1
    if on_duplicate == "flag":
        return wide.select(*keys, *names.values(), duplicate.alias("is_duplicate"))
    first, *rest = names.values()
    checked = F.when(duplicate, F.raise_error(F.lit("duplicate key in pivot")).cast(df.schema[value].dataType)).otherwise(F.col(first))
    return wide.select(*keys, checked.alias(first), *rest)


def is_member(c: Column, members: Column) -> Column:
    """Null-safe membership: a null is not a member."""
    return F.coalesce(F.array_contains(members, c), F.lit(False))


def split_by_member(
    df: DataFrame, column: str, members: Sequence | Column, shared: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Rows in the list and rows not in it; rows with a null belong to the second part.

    Both are plain filters, which reach the scan. ``shared`` hides the test from the optimizer, so that both parts keep the same
    plan below and share a shuffle that made the frame.
    """
    if isinstance(members, Column):
        inside = is_member(F.col(column), members)
    else:
        inside = F.coalesce(F.col(column).isin(*members), F.lit(False))
    if not shared:
        return df.filter(inside), df.filter(~inside)
    flagged = computed_once(df, {"_inside": inside})
    return flagged.filter("_inside").drop("_inside"), flagged.filter("NOT _inside").drop("_inside")


def attach_summary(media: DataFrame, summary: DataFrame, on: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Left join of the summary values; every media row stays."""
    return null_safe_join(media, summary.select(*on, *columns), on, "left")


def pair_up(df: DataFrame, group: Sequence[str], member: str, members: Sequence | Column, value: str) -> DataFrame:
    """Each row with every *other* listed member of its group.

    The candidates come from the request's own list, so that a row fans out by the length of that list; the partner's
    value is then found by an equi-join on group and member.
    """
    listed = members if isinstance(members, Column) else F.array(*[F.lit(m) for m in members])
    own = F.col(member)
    wanted = df.withColumn("companion", F.explode(F.filter(listed, lambda m: m != own)))
    partner = df.select(*group, F.col(member).alias("companion"), F.col(value).alias(f"companion_{value}"))
    return null_safe_join(wanted, partner, [*group, "companion"])


def pair_reversed(
    df: DataFrame, group: Sequence[str], position: str, columns: Sequence[str], block: int = 65_536
) -> DataFrame:
    """Each row with the row at the mirrored position of its group; null keys form a group like any other.

    Positions run from 0 without gaps; anything else stops the job, as rows would meet the wrong partners
    (``ranked_positions`` closes gaps). The group size is a combined count. It is joined per block of positions, so
    that a group of many rows spreads over as many tasks as it has blocks while small groups keep one row of size. The
    mirrored position then makes an equi-join on group and position.
    """
    at = F.col(position).cast("bigint")
    sizes = df.groupBy(*group).agg(F.count(F.lit(1)).alias("_n"), F.max(at).alias("_last"), F.min(at).alias("_first"))
    gap = F.raise_error(F.lit("positions have gaps")).cast("bigint")
    size = F.when((F.col("_last") + 1 == F.col("_n")) & (F.col("_first") == 0), F.col("_n")).otherwise(gap)
    sizes = sizes.select(*group, size.alias("_n"))
    sizes = sizes.withColumn("_block", F.explode(F.sequence(F.lit(0), F.floor((F.col("_n") - 1) / block).cast("int"))))
    left = null_safe_join(df.withColumn("_block", F.floor(at / block).cast("int")), sizes, [*group, "_block"])
    left = left.withColumn("_at", F.col("_n") - 1 - at).drop("_n", "_block")
    right = df.select(*group, at.alias("_at"), *[F.col(c).alias(f"mirrored_{c}") for c in columns])
    return null_safe_join(left, right, [*group, "_at"], "left").drop("_at")


def ranked_positions(df: DataFrame, group: Sequence[str], order: str, name: str) -> DataFrame:
    """Positions 0, 1, 2 … of the rows of each group by ``order``, whatever gaps it has. The rows of one group are a request's
    own media list, which fits a task."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*group).orderBy(order)) - 1)


def concat_reports(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Stack frames by column name; a column missing on one side is null there."""
    for other in others:
        first = first.unionByName(other, allowMissingColumns=True)
    return first
