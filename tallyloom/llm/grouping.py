"""Best-fit packing of token pieces by a grouping genetic algorithm on islands."""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import documents_of, groups_for, written
from tallyloom.llm.tokens import Encoder, default_path

LIMIT = 2048
END_ID = 0
#: Pieces that are packed together; every block is a problem of its own, with its own islands.
BLOCK = 32768
ISLANDS = 2
POPULATION = 5
GENERATIONS = 8
EPOCHS = 2

Bins = list[tuple[int, tuple[int, ...]]]  # what each bin's items add up to, and the items


def pieces(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32)``: the token ids of every whole text with the end id behind them, cut
    after every ``limit`` ids; only longer documents are cut."""

    @F.pandas_udf("array<struct<start: long, length: long, ids_crc32: long>>")
    def cut(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = Encoder(path)
        end = np.array([END_ID], dtype="<u4")
        for part in texts:
            out = []
            for ids in encoder.ids(part.tolist()):
                whole = np.concatenate((ids.astype("<u4"), end))
                cuts = [whole[at : at + limit] for at in range(0, len(whole), limit)]
                out.append([{"start": k * limit, "length": len(c), "ids_crc32": zlib.crc32(c.tobytes())} for k, c in enumerate(cuts)])
            yield pd.Series(out)

    found = documents_of(docs).select("doc_id", F.posexplode(cut("text")).alias("piece", "cut"))
    return found.select("doc_id", "piece", "cut.start", "cut.length", "cut.ids_crc32")


def best_fit(order: list[int], sizes: list[int], limit: int, bins: Bins | None = None) -> Bins:
    """Put each item of ``order`` into the fullest bin that has room, or into a new one; gives ``bins`` with them."""
    loads = [load for load, _ in bins or []]
    items: list[list[int] | tuple[int, ...]] = [i for _, i in bins or []]
    room = sorted((limit - load, k) for k, load in enumerate(loads) if load < limit)
    for i in order:
        size = sizes[i]
        at = bisect_left(room, (size, -1))
        if at < len(room):
            left, k = room.pop(at)
            items[k] = (*items[k], i)
            loads[k] += size
        else:
            left, k = limit, len(items)
            items.append((i,))
            loads.append(size)
        if left > size:
            insort(room, (left - size, k))
    return list(zip(loads, items, strict=True))


def fitness(bins: Bins) -> tuple[int, int]:
    """Fewer bins first; of equally many, the more unequal filling, which leaves room to save another bin."""
    return -len(bins), sum(load * load for load, _ in bins)


def crossed(first: Bins, second: Bins, sizes: list[int], limit: int, rng: np.random.Generator) -> Bins:
    """Inject whole well-filled bins of ``second`` into ``first``, remove the bins that hold their items a second time,
    and best-fit what these held besides."""
    weight = np.array([load for load, _ in second], dtype=float) ** 8
    n = int(rng.integers(1, max(2, len(second) // 4)))
    chosen = rng.choice(len(second), size=min(n, len(second)), replace=False, p=weight / weight.sum())
    injected = [second[k] for k in chosen.tolist()]
    taken = {i for _, b in injected for i in b}
    kept = [b for b in first if taken.isdisjoint(b[1])]
    displaced = [i for _, b in first if not taken.isdisjoint(b) for i in b if i not in taken]
    # a few poorly filled bins are opened too, so that the rest can close up
    kept.sort(key=lambda b: b[0])
    opened = int(rng.integers(0, 4))
    displaced += [i for _, b in kept[:opened] for i in b]
    displaced.sort(key=lambda i: -sizes[i])
    return best_fit(displaced, sizes, limit, kept[opened:] + injected)


def evolve(sizes: list[int], limit: int, seeds: list[Bins], rng: np.random.Generator) -> Bins:
    """One epoch of one island: the best packing found from ``seeds`` and fresh individuals."""
    least = -(-sum(sizes) // limit)
    people = [b for b in seeds if b]
    if not people:
        people.append(best_fit(sorted(range(len(sizes)), key=lambda i: -sizes[i]), sizes, limit))
    while len(people) < POPULATION and min(map(len, people)) > least:
        noise = (np.array(sizes) * rng.uniform(0.8, 1.2, len(sizes))).tolist()
        people.append(best_fit(sorted(range(len(sizes)), key=lambda i: -noise[i]), sizes, limit))
    ranked = sorted(people, key=fitness, reverse=True)
    for _ in range(GENERATIONS):
        if len(ranked[0]) <= least or len(ranked) < 2:
            break
        children = []
        for _ in range(POPULATION - 1):
            a, b = rng.choice(len(ranked), size=2, replace=False)
            children.append(crossed(ranked[min(a, b)], ranked[max(a, b)], sizes, limit, rng))
        ranked = sorted(ranked + children, key=fitness, reverse=True)[:POPULATION]
    return ranked[0]


def _bins(numbers: np.ndarray, sizes: list[int]) -> Bins:
    items: list[list[int]] = [[] for _ in range(int(numbers.max()) + 1)]
    for i, k in enumerate(numbers.tolist()):
        items[k].append(i)
    return [(sum(sizes[i] for i in b), tuple(b)) for b in items if b]


STATE = "block int, island int, row_id long, length long, own int, migrant int"


def _epoch(limit: int, epoch: int):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("row_id", ignore_index=True)
        sizes = frame["length"].tolist()
        seeds = [_bins(frame[c].to_numpy(), sizes) for c in ("own", "migrant") if (frame[c] >= 0).all()]
        rng = np.random.default_rng([int(frame["block"].iloc[0]), int(frame["island"].iloc[0]), epoch])
        own = np.empty(len(frame), np.int64)
        for k, (_, b) in enumerate(evolve(sizes, limit, seeds, rng)):
            own[list(b)] = k
        return frame.assign(own=own)

    return run


def _elite(frame: pd.DataFrame) -> pd.DataFrame:
    """Of a block's islands, the one with the fewest sequences; ties to the smaller number."""
    used = frame.groupby("island")["own"].nunique()
    return frame[frame["island"] == used.idxmin()]


def pack(docs: DataFrame, path: str | None = None, limit: int = LIMIT, block: int = BLOCK) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32, sequence_id, offset)`` of every piece of every row of ``docs (doc_id,
    text)``.

    Sequences hold at most ``limit`` ids, without gaps. Pieces of ``limit`` ids are sequences of their own. All others
    are dealt into blocks by a hash of their row; on every block ``ISLANDS`` populations of packings evolve, and after each
    epoch an island gets the elite of its neighbour. Null and empty texts are one piece, the end id. Repeated rows
    are packed each; null ids are kept; an empty table gives no rows; further columns are ignored.
    """
    path = path or default_path()
    table = written(pieces(docs, path, limit).withColumn("row_id", F.monotonically_increasing_id()), "pieces")
    rest = table.where(F.col("length") < limit)
    blocks = groups_for(rest.count(), block)
    start = rest.select(F.pmod(F.xxhash64("row_id"), F.lit(blocks)).cast("int").alias("block"), F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))).alias("island"), "row_id", "length")
    state = start.withColumns({"own": F.lit(-1), "migrant": F.lit(-1)})
    for epoch in range(EPOCHS):
        if epoch:
            state = written(state, "islands")
            elite = state.select("block", F.pmod(F.col("island") + 1, F.lit(ISLANDS)).alias("island"), "row_id", F.col("own").alias("migrant"))
            state = state.drop("migrant").join(elite, ["block", "island", "row_id"]).select("block", "island", "row_id", "length", "own", "migrant")
        state = state.groupBy("block", "island").applyInPandas(_epoch(limit, epoch), STATE)
    best = state.groupBy("block").applyInPandas(_elite, STATE)
    placed = best.select("row_id", (F.col("block").cast("long") * 2**32 + F.col("own")).alias("sequence_id"))
    named = table.join(placed, "row_id", "left").withColumn("sequence_id", F.coalesce("sequence_id", -1 - F.col("row_id")))
    before = "sum(length) OVER (PARTITION BY sequence_id ORDER BY row_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    offset = F.coalesce(F.expr(before), F.lit(0)).cast("long")
    return named.withColumn("offset", offset).select("doc_id", F.col("piece").cast("int").alias("piece"), "start", "length", "ids_crc32", "sequence_id", "offset")
