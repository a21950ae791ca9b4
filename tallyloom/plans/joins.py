"""Join helpers. No strategy is hinted: Spark chooses by the size in bytes and adaptive execution."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join in which null keys meet each other.

    No null filter is inferred for either side, so two branches of one frame keep the same plan below their shuffles
    and the shuffles are done once.
    """
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    condition = reduce(lambda a, b: a & b, [left[k].eqNullSafe(renamed[f"_right_{k}"]) for k in keys])
    return left.join(renamed, condition, how).drop(*[f"_right_{k}" for k in keys])
