"""Requests that run out of their retry window, as a stream."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def expired_requests(
    asked: DataFrame, answers: DataFrame, key: Sequence[str], asked_at: str, answered_at: str, window: str, lateness: str = "0 seconds"
) -> DataFrame:
    """Requests without a ready answer from the time they were asked until ``window`` later, as soon as that is certain.

    ``answers`` holds ready answers only; both frames may be streams or tables. A request waits in the join's state until the
    watermark - the latest time seen on both sides, less ``lateness`` - has passed the end of its window, and comes out once.
    Answers leave the state by the same rule, so it holds what one window holds, however long the stream runs. Null
    keys are never answered.
    """
    left = asked.withWatermark(asked_at, lateness)
    names = {c: f"_answer_{c}" for c in answers.columns}
    right = answers.withWatermark(answered_at, lateness).withColumnsRenamed(names)
    end = F.col(asked_at) + F.expr(f"INTERVAL {window}")
    at = F.col(names[answered_at])
    met = [F.col(k) == F.col(names[k]) for k in key] + [at >= F.col(asked_at), at <= end]
    joined = left.join(right, reduce(lambda a, b: a & b, met), "left_outer")
    return joined.filter(at.isNull()).select(*asked.columns, end.alias("expired_at"))


def write_expired(expired: DataFrame, path: str, checkpoint: str) -> None:
    """Take in everything new at the sources, add what has expired to a table of files exactly once, then stop."""
    query = (
        expired.writeStream.trigger(availableNow=True).outputMode("append").format("parquet")
        .option("path", path).option("checkpointLocation", checkpoint).start()
    )
    query.awaitTermination()
