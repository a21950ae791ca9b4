"""Exact top-k search by MaxScore over integer vectors.

A query's terms are its components, a term's postings the candidates' components. In every block of candidates a term has
an upper bound of what it can add. While the block is worked through, a query's terms are split: the non-essential
ones, of the smallest bounds, cannot lift any candidate over the query's threshold by themselves, so only the postings
of the essential ones are traversed; candidates are then probed in the others, the largest bound first, for as long
as what they have and what is still to come can compete.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.common import groups_for, written

SCALE = 1024
#: Candidates of a shard, candidates looked at together, and queries of a block.
SHARD = 8192
BLOCK = 1024
QUERIES = 2048


def quantised(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """``(vec_id, v)`` with ``v = floor(scale * x)`` of every component as double; vectors that are null or hold null or
    non-finite components, and rows without an id, take no part. A component that no long can hold stops the job."""
    plain = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("x"))
    whole = plain.where("vec_id is not null and x is not null and not exists(x, e -> e is null or isnan(e) or abs(e) = double('infinity'))")
    too_large = F.raise_error(F.lit("a component is too large for a long")).cast("long")
    return whole.select("vec_id", F.transform("x", lambda e: F.when(F.abs(e * scale) < 2.0**63, F.floor(e * scale)).otherwise(too_large)).alias("v"))


def _largest(matrix: np.ndarray) -> int:
    return max(-int(matrix.min(initial=0)), int(matrix.max(initial=0)))


def _numbers(queries: np.ndarray, candidates: np.ndarray) -> tuple[type, float | int]:
    """The fastest numbers in which all sums of products are exact - doubles, 64-bit integers or Python's own - and one
    that is below every score."""
    most = candidates.shape[1] * _largest(queries) * _largest(candidates)
    if most < 2**53:
        return np.float64, -np.inf
    return np.int64 if most < 2**62 else object, -most - 1


def search(queries: np.ndarray, query_ids: np.ndarray, candidates: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(query number, vec_id, score)`` of each query's ``k`` best candidates of other ids; ties to the smaller id.

    Scores are exact; one of the best that no long can hold raises OverflowError.
    """
    kind, none = _numbers(queries, candidates)
    order = np.argsort(ids, kind="stable")
    candidates, ids = candidates[order].astype(kind), ids[order]
    queries = queries.astype(kind)
    n = len(queries)
    best = np.full((n, k), none, kind)
    where = np.full((n, k), -1, np.int64)
    for at in range(0, len(ids), BLOCK):
        block, own = candidates[at : at + BLOCK], ids[at : at + BLOCK]
        bound = np.maximum(queries * block.max(axis=0), queries * block.min(axis=0))
        terms = np.argsort(-np.abs(bound), axis=1, kind="stable")
        for q in range(n):
            threshold = best[q, -1]
            live = np.flatnonzero(own != query_ids[q])
            rest = np.concatenate((np.cumsum(bound[q, terms[q]][::-1])[::-1], np.zeros(1, kind)))
            # essential: as many terms as it takes until the rest of the bounds alone stays under the threshold
            cut = int(np.flatnonzero(rest <= max(threshold, 0))[0]) if where[q, -1] >= 0 else len(rest) - 1
            cut = max(cut, len(rest) // 4)
            score = block[live][:, terms[q, :cut]] @ queries[q, terms[q, :cut]]
            while True:
                keep = score + rest[cut] >= threshold
                live, score = live[keep], score[keep]
                if cut == len(rest) - 1 or not len(live):
                    break
                step = min(cut + 8, len(rest) - 1)
                score = score + block[live][:, terms[q, cut:step]] @ queries[q, terms[q, cut:step]]
                cut = step
            if len(live):
                # earlier blocks have the smaller ids, so an equal score does not displace what is there
                scores, found = np.concatenate((best[q], score)), np.concatenate((where[q], at + live))
                top = np.argsort(-scores, kind="stable")[:k]
                best[q], where[q] = scores[top], found[top]
    number, place = np.nonzero(where >= 0)
    return number, ids[where[number, place]], best[number, place].astype(np.int64)


def _packed(rows: DataFrame, key: str) -> DataFrame:
    """Rows of equal length packed into one row for each ``key``: ids and the matrix of their components."""

    def pack(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by("vec_id")
        ids = table.column("vec_id").to_numpy()
        flat = np.concatenate([x.values.to_numpy() for x in table.column("v").chunks]) if len(table) else np.zeros(0, np.int64)
        return pa.table({key: table.column(key)[:1], "dims": table.column("dims")[:1], "ids": pa.array([ids.tobytes()], pa.binary()), "body": pa.array([flat.astype("<i8").tobytes()], pa.binary())})

    return rows.groupBy("dims", key).applyInArrow(pack, f"{key} int, dims int, ids binary, body binary")


def top_k(vectors: DataFrame, k: int = 10, every: int = 100, scale: int = SCALE) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` candidates with the highest integer inner products for every query.

    Queries are the rows whose ``vec_id`` is divisible by ``every``; candidates all rows but those of the query's own id. Fewer
    candidates give fewer ranks. Vectors meet those of their own length only. Rows that repeat a vec_id are each a
    candidate; equal query rows ask once, different ones of one id share its ranks. Wholly equal rows are counted and at most
    ``k`` of them go on, which is all that can be ranked. Scores are exact at any size of the components. Blocks of queries meet shards of
    candidates, each pair a task of its own; shards are merged by rank. Empty tables give no rows.
    """
    copies = quantised(vectors, scale).groupBy("vec_id", "v").agg(F.count(F.lit(1)).alias("n"))
    copy = F.explode(F.sequence(F.lit(1).cast("long"), F.least("n", F.lit(k).cast("long")))).alias("copy")
    table = written(copies.select("vec_id", "v", F.size("v").alias("dims"), copy), "vectors")
    asked = table.where((F.col("vec_id") % every == 0) & (F.col("copy") == 1))
    total, queries = table.count(), asked.count()
    shards, blocks = groups_for(total, SHARD), groups_for(queries, QUERIES)
    left = _packed(asked.withColumn("block", F.pmod(F.xxhash64("vec_id", "v"), F.lit(blocks)).cast("int")), "block")
    right = _packed(table.withColumn("shard", F.pmod(F.xxhash64("vec_id", "v"), F.lit(shards)).cast("int")), "shard")
    left = left.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    right = right.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    keys = ["dims", "block", "shard"]
    pairs = left.select(*keys, F.col("ids").alias("query_ids"), F.col("body").alias("query_body")).join(right, keys)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                q, c = np.frombuffer(row["query_ids"], np.int64), np.frombuffer(row["ids"], np.int64)
                left = np.frombuffer(row["query_body"], "<i8").reshape(len(q), row["dims"])
                right = np.frombuffer(row["body"], "<i8").reshape(len(c), row["dims"])
                number, ids, score = search(left, q, right, c, k)
                yield pa.RecordBatch.from_arrays([pa.array(q[number]), pa.array(ids), pa.array(score)], ["query_id", "vec_id", "score"])

    found = pairs.mapInArrow(find, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
