"""SimHash near-duplicates, found through pivot distance tables."""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import documents_of, free_name, written
from tallyloom.llm.components import connected_components

#: Fixed values of the fingerprint.
SEED = 42
BITS = 64
WORD = re.compile(rb"[^\x20\x09-\x0D]+")

#: Reference fingerprints of the distance table; drawn once from a fixed seed.
PIVOTS = 16
#: Members of a bucket that are compared at once; a larger bucket is cut into tiles of this many.
TILE = 2048


def fingerprint(text: str, width: int = 4) -> int:
    """The fingerprint of one text, as an unsigned number. Texts without words have fingerprint zero."""
    return int(_fingerprints([text], width)[0])


def _fingerprints(texts: list[str], width: int) -> np.ndarray:
    """Fingerprints of a batch: the hashes of all shingles are unpacked into bits and summed per text."""
    out = np.zeros(len(texts), dtype=np.uint64)
    digest = xxhash.xxh64_intdigest
    for i, text in enumerate(texts):
        words = WORD.findall(text.encode("utf-8", "surrogatepass").lower())
        if not words:
            continue
        joined = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        n = max(1, len(words) - width + 1)
        stops = ends[width - 1 :] if len(words) >= width else ends[-1:]
        ones = np.zeros(BITS, dtype=np.int64)
        for at in range(0, n, 65536):  # long texts in slices, so that memory stays bounded
            cut = zip(starts[at : min(n, at + 65536)].tolist(), stops[at : at + 65536].tolist(), strict=True)
            h = np.fromiter((digest(joined[s:e], SEED) for s, e in cut), dtype=np.uint64)
            ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        out[i] = np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0]
    return out


def fingerprints(docs: DataFrame, width: int = 4) -> DataFrame:
    """``(doc_id, fp)`` with the fingerprint of every whole text as a signed long."""

    @F.pandas_udf("long")
    def fp(texts: pd.Series) -> pd.Series:
        return pd.Series(_fingerprints(texts.tolist(), width).view(np.int64))

    return documents_of(docs).select("doc_id", fp("text").alias("fp"))


def pivot_table() -> np.ndarray:
    return np.random.default_rng(7).integers(0, 2**64, size=PIVOTS, dtype=np.uint64)


def bands_for(distance: int) -> list[int]:
    """Bit masks such that fingerprints within ``distance`` bits agree wholly under one of them: the 64 bits are cut
    into ``distance + 2`` parts, of which at least two are then untouched."""
    parts = np.array_split(np.arange(BITS), distance + 2)
    masks = [sum(1 << int(b) for b in part) for part in parts]
    return [a | b for a, b in combinations(masks, 2)]


def _near(left: np.ndarray, right: np.ndarray, distance: int, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the pairs within ``distance``: rows of the distance table that lie too far apart are discarded,
    coordinate by coordinate, and the survivors verified."""
    pivots = pivot_table()
    table = lambda x: np.bitwise_count(x[:, None] ^ pivots[None, :]).astype(np.int8)
    a, b = table(left), table(right)
    # the first coordinate is sorted, so only a window of it is looked at
    order = np.argsort(b[:, 0], kind="stable")
    low = np.searchsorted(b[order, 0], a[:, 0] - distance, side="left")
    high = np.searchsorted(b[order, 0], a[:, 0] + distance, side="right")
    found_i, found_j = [], []
    step = 256
    for at in range(0, len(left), step):
        n = (high - low)[at : at + step]
        i = np.repeat(np.arange(at, at + len(n)), n)
        j = order[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low[at : at + step], n)]
        if same:
            keep = i < j
            i, j = i[keep], j[keep]
        for p in range(1, PIVOTS):
            keep = np.abs(a[i, p] - b[j, p]) <= distance
            i, j = i[keep], j[keep]
            if len(i) < 64:
                break
        keep = np.bitwise_count(left[i] ^ right[j]) <= distance
        found_i.append(i[keep])
        found_j.append(j[keep])
    return np.concatenate(found_i), np.concatenate(found_j)


def _spanning(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Positions of the links that join two parts not joined by earlier ones: at most n - 1."""
    root = list(range(n))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    kept = []
    for k, (x, y) in enumerate(zip(i.tolist(), j.tolist(), strict=True)):
        x, y = find(x), find(y)
        if x != y:
            root[max(x, y)] = min(x, y)
            kept.append(k)
    return np.array(kept, dtype=np.int64)


def _runs(frames: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Sorted frames, cut so that a run of equal keys is never split over two of them."""
    rest: list[pd.DataFrame] = []
    for frame in frames:
        if not len(frame):
            continue
        last = (frame[keys] != frame[keys].iloc[-1]).any(axis=1).to_numpy()
        cut = int(np.flatnonzero(last)[-1]) + 1 if last.any() else 0
        if cut:
            yield pd.concat([*rest, frame.iloc[:cut]], ignore_index=True)
            rest = []
        rest.append(frame.iloc[cut:])
    if rest:
        yield pd.concat(rest, ignore_index=True)


def _bucket_links(frame: pd.DataFrame, distance: int) -> pd.DataFrame:
    """Spanning links of every bucket in a frame that is sorted by bucket."""
    fps, side = frame["fp"].to_numpy().view(np.uint64), frame["side"].to_numpy()
    x, y = frame["x"].to_numpy(), frame["y"].to_numpy()
    key = frame[["band", "part", "x", "y"]]
    new = np.concatenate(([True], (key.to_numpy()[1:] != key.to_numpy()[:-1]).any(axis=1))) if len(frame) else np.zeros(0, bool)
    starts = np.flatnonzero(new)
    sizes = np.diff(np.concatenate((starts, [len(frame)])))
    found_i, found_j = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    small = sizes <= 32
    # small buckets together: each member with the one d places on
    left = np.repeat(np.where(small, starts + sizes, 0), sizes)
    at = np.arange(len(frame))
    pivots = pivot_table()
    table = np.bitwise_count(fps[:, None] ^ pivots[None, :]).astype(np.int8)
    for d in range(1, 32):
        i = at[at + d < left]
        if not len(i):
            break
        i = i[(x[i] == y[i]) | (side[i] != side[i + d])]
        near = (np.abs(table[i] - table[i + d]) <= distance).all(axis=1)
        i = i[near]
        i = i[np.bitwise_count(fps[i] ^ fps[i + d]) <= distance]
        found_i.append(i)
        found_j.append(i + d)
    for start, size in zip(starts[~small].tolist(), sizes[~small].tolist(), strict=True):
        part = slice(start, start + size)
        if x[start] == y[start]:
            i, j = _near(fps[part], fps[part], distance, True)
        else:
            a, b = np.flatnonzero(side[part] == 0), np.flatnonzero(side[part] == 1)
            if not len(a) or not len(b):
                continue
            i, j = _near(fps[part][a], fps[part][b], distance, False)
            i, j = a[i], b[j]
        keep = _spanning(size, i, j)
        found_i.append(start + i[keep])
        found_j.append(start + j[keep])
    i, j = np.concatenate(found_i), np.concatenate(found_j)
    out = pd.DataFrame({"a": fps[i].view(np.int64), "b": fps[j].view(np.int64)})
    return out.drop_duplicates()


def links(distinct: DataFrame, distance: int = 4) -> DataFrame:
    """Links ``(a, b)`` between different fingerprints ``fp`` within ``distance`` bits: enough of them to join what
    is joined, never all pairs of a group.

    Fingerprints meet where they agree under one of the masks of ``bands_for``; every near pair agrees under at least
    one, so none is lost. A bucket of more than ``TILE`` members is cut into tiles by a hash, and each pair of tiles
    is a bucket of its own, so no task holds an unbounded one. Inside a bucket the pivot table decides which pairs
    are verified.
    """
    masks = [m - 2**64 if m >= 2**63 else m for m in bands_for(distance)]
    parts = [F.struct(F.lit(k).alias("band"), F.col("fp").bitwiseAND(F.lit(m)).alias("part")) for k, m in enumerate(masks)]
    banded = distinct.select("fp", F.explode(F.array(*parts)).alias("key")).select("fp", "key.band", "key.part")
    sizes = banded.groupBy("band", "part").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    tiles = F.ceil(F.col("n") / TILE).cast("int")
    shared = banded.join(sizes, ["band", "part"]).withColumn("tiles", tiles).withColumn("tile", F.pmod(F.xxhash64("fp"), F.col("tiles")).cast("int"))
    dealt = shared.select("fp", "band", "part", "tile", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other")).select(
        "fp", "band", "part", F.least("tile", "other").alias("x"), F.greatest("tile", "other").alias("y"), (F.col("tile") > F.col("other")).cast("int").alias("side")
    )
    keys = ["band", "part", "x", "y"]

    def compare(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in _runs(frames, keys):
            yield _bucket_links(frame, distance)

    return dealt.repartition(*keys).sortWithinPartitions(*keys).mapInPandas(compare, "a long, b long")


def near_duplicates(docs: DataFrame, width: int = 4, distance: int = 4) -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` of every row of ``docs (doc_id, text)``.

    Texts are lower-cased (A-Z) and cut into words at ASCII white space; shingles have ``width`` words, repeats
    included (fewer words: the whole sequence; null, empty or blank texts: fingerprint zero, linked like any other).
    Fingerprints link at ``distance`` or fewer differing bits; ``component_id`` is the smallest doc_id that links
    reach, itself included. Equal fingerprints are one node, so copies cost one row each and a group of copies is
    never compared with itself. Rows that repeat a doc_id are each returned. Null ids are returned and have the
    smallest id of their component, null if all are null. Empty tables give no rows; further columns are ignored.
    """
    found = written(fingerprints(docs, width), "fingerprints")
    distinct = written(found.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    nodes = connected_components(links(distinct.select("fp"), distance))
    joined = distinct.join(nodes, distinct.fp == nodes.node, "left").select("fp", "first", F.coalesce("component", "fp").alias("component"))
    joined = written(joined, "members")
    least = joined.groupBy("component").agg(F.min("first").alias("component_id"))
    named = written(joined.join(least, "component").select("fp", "component_id"), "named")
    return found.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, width: int = 4, distance: int = 4) -> DataFrame:
    """The rows of ``docs`` whose doc_id is the smallest of its component, with all their columns. Rows that repeat
    a kept id are the same document and stay; rows without an id stay only where no row of their component has one."""
    name = free_name(docs, "kept_id")
    kept = near_duplicates(docs, width, distance).where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias(name)).distinct()
    return docs.join(kept, F.col("doc_id").cast("long").eqNullSafe(F.col(name)), "left_semi")
