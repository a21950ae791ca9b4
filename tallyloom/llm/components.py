"""Connected components of a graph that lives in a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import written


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``edges (a, b)``; ``component`` is the smallest node reachable.

    Large-star and small-star rounds: each node hands the smallest neighbour it knows to its other neighbours, until
    the edges are stars. Minima are combined before each shuffle and the joins are plain equi-joins, so a node with
    very many neighbours is split by adaptive execution. Each round is a written table in the shared folder. Null
    ends and loops are ignored; no edges give no rows.
    """
    pair = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).where("u != v")
    now = written(pair.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before = None
    while True:
        both = now.unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy(F.col("u").alias("k")).agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(low, both.u == low.k).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u != v").distinct()
        least = large.groupBy(F.col("u").alias("k")).agg(F.min("v").alias("m"))
        joined = large.join(least, large.u == least.k)
        small = joined.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        stars = least.select(F.col("k").alias("u"), F.col("m").alias("v"))
        now = written(small.unionAll(stars).distinct(), "edges")
        # the rounds only ever lower the ends, so equal counts and sums mean that nothing moved
        state = tuple(now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if state == before:
            break
        before = state
    members = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return members.unionAll(roots)
