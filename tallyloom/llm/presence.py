"""Ranked lexical search by presence masks.

For an item, the documents of a shard are grouped by which of the item's terms they hold. All documents of a group share one
upper bound: the sum of the largest contributions of the terms in its mask. Groups are evaluated by descending bound,
until no group left can reach the scores already found.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.common import documents_of, written

#: Terms of the items that are searched for together; an item with more is a block of its own.
BLOCK_TERMS = 200_000
#: Documents of a shard, and numbers (documents times terms of an item) that are looked at together.
SHARD = 16_384
CELLS = 4_000_000
#: Fixed by the score: k1 and b of the weighting as integers.
SCALE, MILLI, SATURATION, FLAT = 1_000_000_000, 1000, 20, 50

#: Terms are runs of ASCII letters and digits and of anything beyond ASCII; A-Z count as a-z.
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def terms(text: str) -> list[bytes]:
    return text.encode("utf-8").translate(_TABLE).split()


def weight(n_docs: int, n_with: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n_with + 1)))


def forward_index(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """``(doc_id, n, ids, counts)`` of every document with a term: the number of its terms with repeats, and which of the
    vocabulary it holds how often, as packed 32-bit numbers."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = shared.value.get
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = terms(text)
                if found:
                    hits = np.array([k for k in map(get, found) if k is not None], dtype=np.int32)
                    ids, n = np.unique(hits, return_counts=True)
                    rows.append((doc_id, len(found), ids.tobytes(), n.astype(np.int32).tobytes()))
            doc_ids, sizes, ids, counts = zip(*rows, strict=True) if rows else ((), (), (), ())
            columns = [pa.array(doc_ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(ids, pa.binary()), pa.array(counts, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "ids", "counts"])

    return documents_of(docs).mapInArrow(count, "doc_id long, n long, ids binary, counts binary")


def statistics(index: DataFrame, n_terms: int) -> tuple[int, int, np.ndarray]:
    """Documents with a term, terms with repeats, and the number of documents that hold each vocabulary term."""

    def holders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(n_terms, dtype=np.int64)
        for batch in batches:
            n += np.bincount(np.frombuffer(b"".join(batch.column(0).to_pylist()), np.int32), minlength=n_terms)
        held = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int64()), pa.array(n[held], pa.int64())], ["term", "n"])

    total = index.agg(F.count(F.lit(1)).alias("n"), F.sum("n").alias("length")).first()
    df = np.zeros(n_terms, dtype=np.int64)
    for row in index.select("ids").mapInArrow(holders, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect():
        df[row["term"]] = row["n"]
    return total["n"], total["length"] or 0, df


class Shard:
    """Some documents by term: for every vocabulary term its documents here and what it adds to their scores."""

    def __init__(self, doc_ids: np.ndarray, sizes: np.ndarray, ids: list[bytes], counts: list[bytes], n_docs: int, n_all: int, weights: np.ndarray):
        self.doc_ids = doc_ids
        damping = 100 - FLAT + FLAT * sizes * n_docs // n_all
        doc = np.repeat(np.arange(len(ids)), [len(x) // 4 for x in ids])
        term, tf = np.frombuffer(b"".join(ids), np.int32), np.frombuffer(b"".join(counts), np.int32).astype(np.int64)
        order = np.argsort(term, kind="stable")
        self.docs, term, tf = doc[order], term[order], tf[order]
        self.adds = weights[term] * (SCALE * tf // (MILLI * tf + SATURATION * damping[self.docs]))
        self.starts = np.searchsorted(term, np.arange(len(weights) + 1))

    def best(self, of_item: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions and scores of the ``k`` best documents for the terms of one item, by score, then doc_id."""
        spans = [(int(self.starts[t]), int(self.starts[t + 1])) for t in of_item]
        spans = [(a, b) for a, b in spans if a < b]
        n = len(self.doc_ids)
        if not spans:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        presence = np.zeros((-(-len(spans) // 64), n), dtype=np.uint64)
        for place, (a, b) in enumerate(spans):
            presence[place // 64, self.docs[a:b]] |= np.uint64(1 << place % 64)
        held = np.flatnonzero(presence.any(axis=0))
        if len(presence) == 1:
            masks, group = np.unique(presence[0, held], return_inverse=True)
            masks = masks[None]
        else:
            masks, group = np.unique(presence[:, held], axis=1, return_inverse=True)
        bounds = np.zeros(masks.shape[1], dtype=np.int64)
        for place, (a, b) in enumerate(spans):
            bit = masks[place // 64] >> np.uint64(place % 64) & np.uint64(1)
            bounds += bit.astype(np.int64) * self.adds[a:b].max()
        by_bound = np.argsort(-bounds, kind="stable")
        rank = np.empty(len(by_bound), dtype=np.int64)
        rank[by_bound] = np.arange(len(by_bound))
        order = np.argsort(rank[group.ravel()], kind="stable")  # the documents, group after group
        members = held[order]
        stops = np.cumsum(np.bincount(group.ravel(), minlength=len(bounds))[by_bound])
        best_docs, best_scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        done = at = 0
        while at < len(by_bound):
            if len(best_scores) == k and bounds[by_bound[at]] < best_scores[-1]:
                break  # a group that could only tie is still looked at, as a smaller doc_id wins
            # enough groups for k documents first, then twice as many documents each time
            at = max(at + 1, int(np.searchsorted(stops, done + max(k, done), side="right")))
            part = members[done : stops[at - 1]]
            done = int(stops[at - 1])
            here = np.full(n, -1, dtype=np.int64)
            here[part] = np.arange(len(part))
            scores = np.zeros(len(part), dtype=np.int64)
            for a, b in spans:
                place = here[self.docs[a:b]]
                scores[place[place >= 0]] += self.adds[a:b][place >= 0]
            docs, scores = np.concatenate((best_docs, part)), np.concatenate((best_scores, scores))
            top = np.lexsort((self.doc_ids[docs], -scores))[:k]
            best_docs, best_scores = docs[top], scores[top]
        keep = best_scores > 0
        return best_docs[keep], best_scores[keep]


def _search(index: DataFrame, items: list[np.ndarray], weights: np.ndarray, n_docs: int, n_all: int, k: int) -> DataFrame:
    """The ``k`` best documents of every shard for every item."""
    shared = index.sparkSession.sparkContext.broadcast((items, weights))

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        held: list[tuple] = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                held.append(row)
                if len(held) == SHARD:
                    yield tuple(zip(*held, strict=True))
                    held = []
        if held:
            yield tuple(zip(*held, strict=True))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, w = shared.value
        for doc_ids, sizes, ids, counts in shards(batches):
            known = np.array([d is not None for d in doc_ids])
            # documents without an id rank behind all others
            ranked = np.array([2**63 - 1 if d is None else d for d in doc_ids], dtype=np.int64)
            shard = Shard(ranked, np.array(sizes, dtype=np.int64), ids, counts, n_docs, n_all, w)
            found = [shard.best(item, k) for item in wanted]
            item = np.repeat(np.arange(len(found)), [len(d) for d, _ in found])
            docs = np.concatenate([d for d, _ in found])
            columns = [pa.array(item, pa.int64()), pa.array(ranked[docs], mask=~known[docs]), pa.array(np.concatenate([s for _, s in found]), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["item", "doc_id", "score"])

    found = index.mapInArrow(search, "item long, doc_id long, score long")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _blocks(items: DataFrame) -> Iterator[list[tuple]]:
    """The items and their different terms, in blocks of at most ``BLOCK_TERMS`` terms (or of one item)."""
    block, size = [], 0
    for row in items.select("item_id", F.col("text").cast("string").alias("text")).toLocalIterator():
        of_item = sorted(set(terms(row["text"] or "")))
        if block and size + len(of_item) > BLOCK_TERMS:
            yield block
            block, size = [], 0
        block.append((row["item_id"], of_item))
        size += len(of_item)
    if block:
        yield block


def ranked(docs: DataFrame, items: DataFrame, k: int = 50) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: for every row of ``items (item_id, text)`` the ``k`` best documents of ``docs (doc_id, text)``
    with a score above 0, equal scores by ascending doc_id (null ids last).

    A document's score is the sum, over the item's different terms, of the term's weight (``weight``) times its
    saturated count: in whole numbers ``10**9 * tf // (1000 * tf + 20 * m)`` with ``m = 50 + 50 * n * N // L`` for a document of ``n`` terms, ``N`` documents
    with a term and ``L`` terms in all. Documents without a term, null and empty ones included, are neither counted nor found.
    Rows that repeat an item_id are items of their own, each with its ranks; an item without terms finds nothing; rows
    that repeat a doc_id are documents of their own. Empty tables give no rows; further columns are ignored.

    The items are the queries and go to the tasks in blocks of ``BLOCK_TERMS`` terms, each block with one pass over the documents; a
    task holds a shard of ``SHARD`` documents as far as it meets the block's terms. Only the ``k`` best of each shard are
    exchanged.
    """
    spark, out = docs.sparkSession, None
    for block in _blocks(items):
        vocabulary = {t: k for k, t in enumerate(sorted({t for _, of_item in block for t in of_item}))}
        index = written(forward_index(docs, vocabulary), "forward")
        n_docs, n_all, df = statistics(index, len(vocabulary))
        weights = np.array([weight(n_docs, int(n)) for n in df], dtype=np.int64)
        numbered = [np.array([vocabulary[t] for t in of_item], dtype=np.int64) for _, of_item in block]
        found = _search(index, numbered, weights, n_docs, n_all, k)
        names = spark.createDataFrame([(n, i) for n, (i, _) in enumerate(block)], f"item long, item_id {items.schema['item_id'].dataType.simpleString()}")
        named = found.join(names, "item").select("item_id", "rank", "doc_id", "score")
        out = named if out is None else out.unionAll(named)
    if out is None:
        return spark.createDataFrame([], f"item_id {items.schema['item_id'].dataType.simpleString()}, rank int, doc_id long, score long")
    return out
