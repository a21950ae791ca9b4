"""Jaccard join of word n-gram sets by partitioning the universe of n-grams.

Two sets within the similarity differ in at most U n-grams, a number that their sizes bound. A hash deals all n-grams into
segments, more than U in number, so two such sets agree in some segment: if a search looks into segments with thresholds
that add up to more than U points - one for "the same subset", two for "the same but for one n-gram" - it misses nothing.
Subsets meet by their hashes, and a set's subsets without one member (its one-deletion neighbours) meet the others' whole
subsets. Which segments a set is searched by is a matter of cost alone: frequent subsets are passed over.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.common import documents_of, written
from tallyloom.llm.components import connected_components

#: Texts that are cut and whose rows are handed on together.
TOGETHER = 256
#: Counters of the frequencies by which costs are estimated, and those that are sent together.
CELL_BITS = 20
BLOCK = 1 << 12
#: Pairs of segments by which sets meet ahead of the join, so that a dense group becomes one component early.
LEADS = 4
#: How often the sets of a key are compared with one of them, for the same reason.
TURNS = 3
INDEX, PROBE = 1, 2  # the parts that a row can take in the join
#: Bits by which two sets that meet are compared before their texts are: whether a set has an odd number of n-grams there. Sets
#: differ in at least as many n-grams as bits.
PARITY = 1024
WITHOUT_ONE = np.uint64(0x9E3779B97F4A7C15)  # tells neighbours from whole subsets


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit of a 64-bit number over all others."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8").lower().split()


def grams_of(text: str, width: int) -> set[tuple[bytes, ...]]:
    """The set itself: runs of ``width`` words, or the whole sequence if there are fewer."""
    words = words_of(text)
    if len(words) < width:
        return {tuple(words)} if words else set()
    return set(zip(*(words[k:] for k in range(width)), strict=False))


class Hasher:
    """The distinct n-grams of texts as sorted 64-bit hashes."""

    def __init__(self, width: int, seed: int):
        self.width, self.seed = width, seed

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        cut = pc.ascii_split_whitespace(pc.ascii_lower(pa.array(texts, pa.large_string())))
        coded = cut.flatten().dictionary_encode()
        hashes = np.array([xxhash.xxh3_64_intdigest(w, self.seed) for w in coded.dictionary.cast(pa.large_binary()).to_pylist()], dtype=np.uint64)
        place = coded.indices.to_numpy()
        # blanks at an edge of a text leave an empty word there
        full = pc.binary_length(coded.dictionary).to_numpy(zero_copy_only=False)[place] > 0
        words = hashes[place[full]]
        before = np.concatenate(([0], np.cumsum(full)))[cut.offsets.to_numpy()].tolist()
        return [self._grams(words[a:b]) for a, b in zip(before[:-1], before[1:], strict=True)]

    def _grams(self, words: np.ndarray) -> np.ndarray:
        width = min(self.width, len(words))
        if not width:
            return np.zeros(0, dtype=np.uint64)
        n = len(words) - width + 1
        h = words[:n] + np.uint64(width)
        for k in range(1, width):
            h = h * np.uint64(0x2545F4914F6CDD1D) + words[k : k + n]
        return np.unique(_mixed(h))


class Scheme:
    """Size bands and the number of segments of each.

    A set's partners that are no smaller lie in its own band or the next. ``points(band)`` more than the largest difference of
    such a pair are needed; a few segments more than that leave a choice.
    """

    def __init__(self, percent: int):
        self.percent, lows = percent, [1]
        while percent < 100 and lows[-1] < 2**40:
            lows.append(max(lows[-1], 100 * lows[-1] // percent) + 1)
        lows.append(2**62)
        self.lows = np.array(lows, dtype=np.int64)

    def band(self, size: int) -> int:
        return int(np.searchsorted(self.lows, size, side="right")) - 1

    def high(self, band: int) -> int:
        return int(self.lows[band + 1]) - 1

    def points(self, smaller: int, larger: int) -> int:
        """One more than the difference that sets of these sizes may have."""
        return (100 - self.percent) * (smaller + larger) // (100 + self.percent) + 1

    def segments(self, band: int) -> tuple[int, int]:
        """How many segments, and how many of them also have neighbours indexed."""
        most = self.points(self.high(band), 100 * self.high(band) // self.percent)
        return most + most // 24, 1 + most // 24


class Subsets:
    """One set's subsets under the segments of a band."""

    def __init__(self, grams: np.ndarray, band: int, scheme: Scheme):
        self.n, self.n_wide = scheme.segments(band)
        place = ((grams >> np.uint64(33)) * np.uint64(self.n) >> np.uint64(31)).astype(np.int64)
        low = np.bincount(place, weights=(grams & np.uint64(0xFFFFFFFF)).astype(np.float64), minlength=self.n).astype(np.uint64)
        high = np.bincount(place, weights=(grams >> np.uint64(32)).astype(np.float64), minlength=self.n).astype(np.uint64)
        self.sums = (high << np.uint64(32)) + low  # of the members' hashes, which is the subset's hash
        self.salt = _mixed(np.arange(self.n, dtype=np.uint64) + np.uint64(band << 40))
        wide = place < self.n_wide
        self.members, self.of = grams[wide], place[wide]

    def whole(self) -> np.ndarray:
        return _mixed(self.sums + self.salt)

    def whole_as_neighbours(self) -> np.ndarray:
        """The wide segments' subsets, as they meet another set's neighbours."""
        return _mixed((self.sums + self.salt)[: self.n_wide] + WITHOUT_ONE)

    def neighbours(self) -> np.ndarray:
        """The wide segments' subsets without one member each."""
        return _mixed(self.sums[self.of] - self.members + self.salt[self.of] + WITHOUT_ONE)

    def neighbours_as_whole(self) -> np.ndarray:
        return _mixed(self.sums[self.of] - self.members + self.salt[self.of])


def _cell(keys: np.ndarray) -> np.ndarray:
    return (keys >> np.uint64(64 - CELL_BITS)).astype(np.int64)


def indexed(grams: np.ndarray, scheme: Scheme) -> np.ndarray:
    """What other sets can find a set by."""
    subsets = Subsets(grams, scheme.band(len(grams)), scheme)
    return np.concatenate((subsets.whole(), subsets.neighbours()))


def probes(grams: np.ndarray, band: int, scheme: Scheme, frequency: np.ndarray) -> np.ndarray:
    """The keys by which a set looks for the smaller or equal sets of a band, at the least cost."""
    subsets = Subsets(grams, band, scheme)
    points = scheme.points(min(len(grams), scheme.high(band)), len(grams))
    whole, neighbours = subsets.whole(), subsets.neighbours_as_whole()
    again = subsets.whole_as_neighbours()
    # empty subsets are as frequent as any can be, though few enough of a band to stay hidden among a cell's other keys
    one = np.where(subsets.sums == 0, np.inf, frequency[_cell(whole)])
    alone = subsets.sums[subsets.of] == subsets.members
    two = frequency[_cell(again)] + np.bincount(subsets.of, weights=np.where(alone, np.inf, frequency[_cell(neighbours)]), minlength=subsets.n_wide)
    # a second point stands behind the first of its segment
    cost = np.concatenate((one, np.maximum(two, one[: subsets.n_wide])))
    chosen = np.argsort(cost, kind="stable")[:points]
    first = chosen[chosen < subsets.n]
    second = np.zeros(subsets.n_wide, dtype=bool)
    second[chosen[chosen >= subsets.n] - subsets.n] = True
    return np.concatenate((whole[first], again[second], neighbours[second[subsets.of]]))


def rows_of(grams: np.ndarray, scheme: Scheme, frequency: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All keys of a set and the parts it takes there. Sets so small that partners are equal have none."""
    if scheme.points(len(grams), 100 * len(grams) // scheme.percent) < 2:
        return np.zeros(0, np.uint64), np.zeros(0, np.int8)
    band, own = scheme.band(len(grams)), indexed(grams, scheme)
    keys, parts = [own], [np.full(len(own), INDEX, np.int8)]
    for other in (band, band - 1):
        if other >= 0 and 100 * min(scheme.high(other), len(grams)) >= scheme.percent * len(grams):
            found = probes(grams, other, scheme, frequency)
            keys.append(found)
            parts.append(np.full(len(found), PROBE, np.int8))
    keys, place = np.unique(np.concatenate(keys), return_inverse=True)
    both = np.zeros(len(keys), np.int8)
    np.bitwise_or.at(both, place, np.concatenate(parts))
    return keys, both


def _leads(grams: np.ndarray, scheme: Scheme) -> list[int]:
    subsets = Subsets(grams, scheme.band(len(grams)), scheme)
    sums = (subsets.sums + subsets.salt)[: 2 * min(LEADS, subsets.n // 2)].reshape(-1, 2)
    full = (subsets.sums[: 2 * len(sums)].reshape(-1, 2) != 0).any(axis=1)
    return _mixed(sums[:, 0] * np.uint64(3) + sums[:, 1])[full].view(np.int64).tolist()


def _parity(grams: np.ndarray) -> list[int]:
    odd = np.bincount((grams >> np.uint64(54)).astype(np.int64), minlength=PARITY) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64).tolist()


def _may_be_near(n_x: Column, n_y: Column, x: Column, y: Column, percent: int) -> Column:
    """Whether sets of these sizes and parities can be similar enough."""
    differing = reduce(lambda a, b: a + b, [F.bit_count(F.get(x, F.lit(k)).bitwiseXOR(F.get(y, F.lit(k)))) for k in range(PARITY // 64)])
    return differing * (100 + percent) <= (n_x + n_y) * (100 - percent)


SETS = "doc_id long, row long, n long, node long, proof long, leads array<long>, parity array<long>, block long, cells binary"


def _node(grams: np.ndarray, seed: int) -> tuple[int, int]:
    whole = xxhash.xxh3_128_intdigest(grams.tobytes(), seed)
    return (whole >> 64) - 2**63, (whole & (2**64 - 1)) - 2**63


def gram_sets(docs: DataFrame, width: int, scheme: Scheme, seed: int) -> DataFrame:
    """``(doc_id, row, n, node, proof, leads, parity)`` of every document: the size of its set, two digests of it, the keys of
    ``LEADS`` and the bits of ``PARITY``; ``row`` tells rows that share an id apart. Rows with a ``block`` hold, for a part of
    the cells, how many index keys of a task's sets fall into each."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed, cells = Hasher(width, seed), np.zeros(1 << CELL_BITS, dtype=np.int32)
        schema = _arrow_schema(SETS)
        for batch in batches:
            for at in range(0, len(batch), TOGETHER):
                part, rows, keys = batch.slice(at, TOGETHER), [], []
                for grams in hashed(part.column("text").to_pylist()):
                    node, proof = _node(grams, seed)
                    leads, parity = [], []
                    if scheme.points(len(grams), 100 * len(grams) // scheme.percent) > 1:  # smaller sets only meet their equals
                        leads, parity = _leads(grams, scheme), _parity(grams)
                        keys.append(indexed(grams, scheme))
                    rows.append((len(grams), node if len(grams) else None, proof, leads, parity))
                if keys:
                    cells += np.bincount(_cell(np.concatenate(keys)), minlength=len(cells)).astype(np.int32)
                made = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types[2:7], strict=True)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("row"), *made, pa.nulls(len(part), pa.int64()), pa.nulls(len(part), pa.binary())], schema=schema)
        blocks = cells.reshape(-1, BLOCK)
        held = np.flatnonzero(blocks.any(axis=1))
        empty = [pa.nulls(len(held), t) for t in schema.types[:7]]
        yield pa.RecordBatch.from_arrays([*empty, pa.array(held, pa.int64()), pa.array([blocks[k].tobytes() for k in held], pa.binary())], schema=schema)

    return documents_of(docs).withColumn("row", F.xxhash64("text")).mapInArrow(digest, SETS)


def _arrow_schema(columns: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "array<long>": pa.list_(pa.int64()), "binary": pa.binary()}
    return pa.schema([(name, kinds[kind]) for name, kind in (c.split(" ") for c in columns.split(", "))])


def frequencies(found: DataFrame) -> np.ndarray:
    """How many index keys of all sets fall into each cell: an upper bound of every key's frequency, of fixed size."""

    def added(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x, np.int32).astype(np.int64) for x in table.column("cells").to_pylist())
        return pa.table({"block": table.column("block").slice(0, 1), "cells": pa.array([total.astype(np.float32).tobytes()], pa.binary())})

    out = np.zeros(((1 << CELL_BITS) // BLOCK, BLOCK), dtype=np.float32)
    for row in found.where("block IS NOT NULL").select("block", "cells").groupBy("block").applyInArrow(added, "block long, cells binary").collect():
        out[row["block"]] = np.frombuffer(row["cells"], np.float32)
    return out.ravel()


def _met(texts: DataFrame, width: int, scheme: Scheme, seed: int, frequency: np.ndarray) -> DataFrame:
    """``(key, node, part)`` of the sets that share a key with another set, one of them as the searching one."""
    shared = texts.sparkSession.sparkContext.broadcast(frequency)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed = Hasher(width, seed)
        for batch in batches:
            for at in range(0, len(batch), TOGETHER):
                found = []
                for grams in hashed(batch.column(0).slice(at, TOGETHER).to_pylist()):
                    keys, parts = rows_of(grams, scheme, shared.value) if len(grams) else ((), ())
                    if len(keys):
                        found.append((keys, np.full(len(keys), _node(grams, seed)[0], dtype=np.int64), parts))
                if found:
                    keys, nodes, parts = (np.concatenate(x) for x in zip(*found, strict=True))
                    yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(nodes), pa.array(parts)], ["key", "node", "part"])

    whole = Window.partitionBy("key")
    made = texts.select("text").mapInArrow(rows, "key long, node long, part byte")
    ends = made.select("*", F.min("node").over(whole).alias("least"), F.max("node").over(whole).alias("most"), F.bit_or("part").over(whole).alias("parts"))
    return ends.where((F.col("least") != F.col("most")) & (F.col("parts") == INDEX | PROBE)).select("key", "node", "part").distinct()


def _verified(pairs: DataFrame, docs: DataFrame, sets: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` whose sets, taken from the texts themselves, are similar enough."""
    pairs = written(pairs, "pairs")
    nodes = pairs.select(F.col("a").alias("node")).unionAll(pairs.select(F.col("b").alias("node"))).distinct()
    places = sets.join(nodes, "node").select("node", "place.doc_id", "place.row")
    rows = documents_of(docs).withColumn("row", F.xxhash64("text")).withColumnRenamed("doc_id", "id")
    found = rows.join(places, F.col("id").eqNullSafe(F.col("doc_id")) & (rows.row == places.row)).select("node", "text")
    texts = written(found.groupBy("node").agg(F.first("text").alias("text")), "texts")  # rows can repeat

    @F.pandas_udf("boolean")
    def similar(left: pd.Series, right: pd.Series) -> pd.Series:
        out, last, held = [], None, set()
        for a, b in zip(left, right, strict=True):
            if a is not last and a != last:
                last, held = a, grams_of(a, width)
            other = grams_of(b, width)
            both = len(held & other)
            out.append(100 * both >= percent * (len(held) + len(other) - both))
        return pd.Series(out, dtype=bool)

    first = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("x")), "a")
    second = first.join(texts.select(F.col("node").alias("b"), F.col("text").alias("y")), "b")
    return written(second.where(similar("x", "y")).select("a", "b"), "links")


def _parts(sets: DataFrame, links: DataFrame, before: DataFrame | None = None) -> DataFrame:
    """``(node, n, parity, part_of)``: the component of every set by these links and the components there were before."""
    if before is not None:
        links = links.unionAll(before.where("node != part_of").select("part_of", "node"))
    joined = sets.select("node", "n", "parity").join(connected_components(links), "node", "left")
    return written(joined.select("node", "n", "parity", F.coalesce("component", "node").alias("part_of")), "parts")


def _apart(met: DataFrame, named: DataFrame) -> DataFrame:
    """The rows of ``met`` whose key is shared by sets of different components, with what is known of their sets."""
    over = Window.partitionBy("key")
    known = met.join(named, "node").withColumns({"lo": F.min("part_of").over(over), "hi": F.max("part_of").over(over)})
    return known.where("lo != hi").drop("lo", "hi")


def _stars(apart: DataFrame, turn: int, percent: int) -> DataFrame:
    """Of every key, one set with each set of another component. The order by which it is chosen is that of all keys, so sets that
    share many keys mostly meet the same one."""
    center = F.min_by(F.struct("node", "n", "parity", "part_of"), F.xxhash64("node", F.lit(turn))).alias("c")
    around = apart.join(apart.groupBy("key").agg(center), "key")
    fits = (F.col("part_of") != F.col("c.part_of")) & _may_be_near(F.col("n"), F.col("c.n"), F.col("parity"), F.col("c.parity"), percent)
    return around.where(fits).select(F.least("node", "c.node").alias("a"), F.greatest("node", "c.node").alias("b")).distinct()


def _pairs(apart: DataFrame, percent: int) -> DataFrame:
    """Sets of different components, one of which another finds by a key, that may be similar enough."""
    apart = written(apart, "apart")
    left = apart.where(F.col("part").bitwiseAND(PROBE) != 0).select("key", F.col("node").alias("x"), F.col("n").alias("nx"), F.col("parity").alias("bx"), F.col("part_of").alias("px"))
    right = apart.where(F.col("part").bitwiseAND(INDEX) != 0).select("key", F.col("node").alias("y"), F.col("n").alias("ny"), F.col("parity").alias("by"), F.col("part_of").alias("py"))
    fits = (F.col("px") != F.col("py")) & (F.col("ny") <= F.col("nx")) & (F.col("ny") * 100 >= F.col("nx") * percent)
    fits = fits & _may_be_near(F.col("nx"), F.col("ny"), F.col("bx"), F.col("by"), percent)
    return left.join(right, "key").where(fits).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def similar_sets(docs: DataFrame, width: int = 4, percent: int = 85) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` of every row of ``docs (doc_id, text)``.

    A-Z are lower-cased and words cut at ASCII white space; a document's set holds its different runs of ``width`` words, or the
    whole sequence if it has fewer. Two documents link when ``100 * intersection >= percent * union`` (``percent`` above 0);
    ``component_id`` is the smallest doc_id that links reach, itself included. Null, empty and blank texts have the empty
    set and link with nothing. Null ids are kept and have the smallest id of their component, null if all are null; rows that repeat
    an id are each returned; empty tables give no rows; further columns are ignored.

    Equal sets are one node, known by two digests of 64 bits (should different sets share the first, other hashes are taken).
    Sets that agree in a pair of segments, and then in a key of the join, are compared with one of them first, so that a dense
    group of near copies is one component before the join looks at all pairs of different components. Every link counts
    the n-grams of the two texts themselves.
    """
    scheme = Scheme(percent)
    for seed in count():
        made = written(gram_sets(docs, width, scheme, seed), "sets")
        found = made.where("block IS NULL").drop("block", "cells")
        nodes = found.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("first"), F.min(F.struct("doc_id", "row")).alias("place"), F.first("n").alias("n"), F.first("leads").alias("leads"), F.first("parity").alias("parity"), F.min("proof").alias("p"), F.max("proof").alias("q"))
        sets = written(nodes, "nodes")
        if sets.where("p != q").isEmpty():
            break
    meeting = sets.select("node", F.explode("leads").alias("key"))
    least = meeting.groupBy("key").agg(F.min("node").alias("a"), F.max("node").alias("last")).where("a < last").select("key", "a")
    stars = meeting.join(least, "key").where("a != node").select("a", F.col("node").alias("b")).distinct()
    named = _parts(sets, _verified(stars, docs, sets, width, percent))

    met = written(_met(documents_of(docs), width, scheme, seed, frequencies(made)), "met")
    for turn in range(TURNS):
        stars = _stars(written(_apart(met, named), "apart"), turn, percent)
        named = _parts(sets, _verified(stars, docs, sets, width, percent), named)
    pairs = _pairs(_apart(met, named), percent)
    whole = _parts(sets, _verified(pairs, docs, sets, width, percent), named)
    ids = whole.join(sets.select("node", "first"), "node").groupBy("part_of").agg(F.min("first").alias("component_id"))
    component = written(whole.join(ids, "part_of").select("node", "component_id"), "named")
    out = found.join(component, "node", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))
