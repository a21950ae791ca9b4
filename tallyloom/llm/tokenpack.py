"""Token-id output: documents packed best-fit-decreasing into rows of an id matrix.

A segment tree over the capacities finds, in as many steps as it has levels, the fullest row that still has room.
Documents longer than a row are cut into row-sized pieces and a rest, so no id is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import documents_of, groups_for, text_bytes
from tallyloom.llm.tokens import Encoder, default_path

LIMIT = 2048
END_ID = 49407  # the vocabulary's end of text
PAD_ID = 0
#: Bytes of text whose pieces are packed together.
SHARD_BYTES = 4 << 20


class Capacities:
    """Rows by the room they have left: a segment tree over 0 .. limit whose nodes count the rows below them."""

    def __init__(self, limit: int):
        self.leaves = 1 << limit.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.rows: list[list[int]] = [[] for _ in range(limit + 1)]

    def add(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        node = self.leaves + room
        while node:
            self.count[node] += 1
            node >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """The row with the least room that is at least ``need``, and that room; it leaves the tree."""
        node = self.leaves + need
        if not self.count[node]:
            # up until a right neighbour holds a row, then down along the left
            while node > 1 and (node & 1 or not self.count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if self.count[2 * node] else 2 * node + 1
        room = node - self.leaves
        row = self.rows[room].pop()
        while node:
            self.count[node] -= 1
            node >>= 1
        return row, room


def best_fit_decreasing(sizes: np.ndarray, limit: int) -> np.ndarray:
    """The row of each piece; sizes are 1 to ``limit``."""
    tree, rows, out = Capacities(limit), 0, np.empty(len(sizes), np.int64)
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        found = tree.take(size)
        if found is None:
            row, room, rows = rows, limit, rows + 1
        else:
            row, room = found
        out[i] = row
        if room > size:
            tree.add(room - size, row)
    return out


SCHEMA = (
    "shard int, sequence int, n_tokens int, doc_ids array<long>, starts array<long>, cu_seqlens array<int>, "
    "position_resets array<int>, input_ids binary"
)


def _pack(limit: int, pad_id: int):
    def run(table: pa.Table) -> pa.Table:
        # one order whatever way the rows came
        doc, start, body = (table.column(c).to_pylist() for c in ("doc_id", "start", "ids"))
        order = sorted(range(len(table)), key=lambda i: (doc[i] is None, doc[i] or 0, start[i], body[i]))
        ids, docs, starts = [np.frombuffer(body[i], "<u2") for i in order], [doc[i] for i in order], [start[i] for i in order]
        rows = best_fit_decreasing(np.array([len(x) for x in ids], np.int64), limit)
        by_row = np.argsort(rows, kind="stable")
        out: dict[str, list] = {k: [] for k in ("shard", "sequence", "n_tokens", "doc_ids", "starts", "cu_seqlens", "position_resets", "input_ids")}
        for part in np.split(by_row, np.flatnonzero(np.diff(rows[by_row])) + 1):
            ends = np.cumsum([len(ids[i]) for i in part]).tolist()
            matrix = np.full(limit, pad_id, "<u2")
            matrix[: ends[-1]] = np.concatenate([ids[i] for i in part])
            out["shard"].append(table.column("shard")[0].as_py())
            out["sequence"].append(int(rows[part[0]]))
            out["n_tokens"].append(ends[-1])
            out["doc_ids"].append([docs[i] for i in part])
            out["starts"].append([starts[i] for i in part])
            out["cu_seqlens"].append([0, *ends])
            out["position_resets"].append([0, *ends[:-1]])
            out["input_ids"].append(matrix.tobytes())
        kinds = [pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.binary()]
        return pa.table({k: pa.array(v, kind) for (k, v), kind in zip(out.items(), kinds, strict=True)})

    return run


def token_pieces(docs: DataFrame, path: str, limit: int, end_id: int) -> DataFrame:
    """``(doc_id, start, ids)``: little-endian 16-bit ids of every piece of every document, the end id included."""

    @F.pandas_udf("array<binary>")
    def cut(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder, end = Encoder(path), np.array([end_id], "<u2")
        for part in texts:
            whole = (np.concatenate((ids.astype("<u2"), end)) for ids in encoder.ids(part.tolist()))
            yield pd.Series([[w[at : at + limit].tobytes() for at in range(0, len(w), limit)] for w in whole])

    found = docs.select("doc_id", "shard", F.posexplode(cut("text")).alias("piece", "ids"))
    return found.select("doc_id", "shard", (F.col("piece").cast("long") * limit).alias("start"), "ids")


def packed(docs: DataFrame, path: str | None = None, limit: int = LIMIT, end_id: int = END_ID, pad_id: int = PAD_ID, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """One row of the id matrix for every sequence: ``(shard, sequence, n_tokens, doc_ids, starts, cu_seqlens,
    position_resets, input_ids)``.

    ``input_ids`` holds ``limit`` little-endian 16-bit ids, the places behind ``n_tokens`` filled with ``pad_id``. Segment k lies
    between ``cu_seqlens[k]`` and ``cu_seqlens[k + 1]``; it is the ids of document ``doc_ids[k]`` from ``starts[k]`` on, and position
    counting begins anew at ``position_resets[k]``. Every document ends with ``end_id``; null and empty texts are that id
    alone. Shards are packed each for itself; rows are dealt among them by a hash. Repeated rows are packed each, null
    ids are kept, an empty table gives no rows, further columns are ignored. The vocabulary must fit 16 bits.
    """
    rows = documents_of(docs)
    shards = groups_for(text_bytes(rows), shard_bytes)
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("doc_id", "text"), F.lit(shards)).cast("int"))
    pieces = token_pieces(dealt, path or default_path(), limit, end_id)
    return pieces.groupBy("shard").applyInArrow(_pack(limit, pad_id), SCHEMA)


def write_packed(docs: DataFrame, folder: str, **options) -> None:
    """Write the matrix rows of ``packed`` as Parquet, one folder for each shard; a repeated run replaces them."""
    packed(docs, **options).write.mode("overwrite").partitionBy("shard").parquet(folder)


def positions(cu_seqlens: list[int], limit: int) -> np.ndarray:
    """Position ids of a row: they count from 0 in each segment, and on over the padding."""
    out = np.arange(limit)
    for start in cu_seqlens[1:]:
        out[start:] = np.arange(limit - start)
    return out


def unpacked(rows: DataFrame) -> DataFrame:
    """``(doc_id, start, ids)`` of every segment of ``packed`` rows: the way back."""

    def split(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for docs, starts, ends, ids in zip(frame["doc_ids"], frame["starts"], frame["cu_seqlens"], frame["input_ids"], strict=True):
                for k, (doc, start) in enumerate(zip(docs, starts, strict=True)):
                    out.append((doc, start, bytes(ids[2 * ends[k] : 2 * ends[k + 1]])))
            yield pd.DataFrame(out, columns=["doc_id", "start", "ids"])

    return rows.mapInPandas(split, "doc_id long, start long, ids binary")
