"""Benchmark decontamination by spaced-seed hashing.

Fixed masks look at some token positions of a window and ignore the others, so a substituted token spoils only the
seeds that look at it. Hashes of the masked tokens of benchmark items and of documents are joined; around every hit
the two texts are laid over each other and compared token by token, which tolerates substitutions.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed masks: 1 looks at a token, 0 ignores it. Every placing of the substitutions that an overlap may have (one in 5
#: to 9 tokens, two in 10 to 13) leaves at least one of the masks a place where all tokens it looks at agree.
MASKS = ("1111", "11011", "10111", "11101")
#: An overlap counts if at least ``OVERLAP`` tokens (the whole item, if it is shorter) agree at ``SIMILARITY`` of the places.
OVERLAP = 13
SIMILARITY = 0.8
#: Items with fewer tokens are too short to tell a leak from chance and are not looked for.
LEAST_TOKENS = 5
#: Tokens of the benchmark that are laid over the documents in one pass: about 40 MB of arrays in a task.
BLOCK_TOKENS = 500_000

TOKEN = re.compile(r"\w+")


def tokens(text: str) -> list[str]:
    return TOKEN.findall(text.lower())


class Seeds:
    """The seeds of one block of benchmark items, ready to be laid over documents."""

    def __init__(self, items: list[list[str]]):
        words = sorted({w for item in items for w in item})
        self.number = {w: k + 1 for k, w in enumerate(words)}  # 0: not in the benchmark
        self.flat = np.array([self.number[w] for item in items for w in item], dtype=np.int32)
        self.ends = np.cumsum([len(item) for item in items])
        self.starts = np.concatenate(([0], self.ends[:-1]))
        self.rng = np.random.default_rng(11).integers(1, 2**63, size=max(map(len, MASKS)), dtype=np.uint64) | np.uint64(1)
        item_of = np.repeat(np.arange(len(items)), self.ends - self.starts)
        self.seeds = []
        for mask in MASKS:
            at = np.arange(max(0, len(self.flat) - len(mask) + 1))
            at = at[at + len(mask) <= self.ends[item_of[at]]]
            h = self._hash(self.flat, at, mask)
            order = np.argsort(h, kind="stable")
            self.seeds.append((h[order], at[order], item_of[at[order]]))

    def _hash(self, flat: np.ndarray, at: np.ndarray, mask: str) -> np.ndarray:
        h = np.zeros(len(at), np.uint64)
        for k, bit in enumerate(mask):
            if bit == "1":
                h = (h ^ flat[at + k].astype(np.uint64)) * self.rng[k]
                h ^= h >> np.uint64(31)
        return h

    def ids(self, text: str) -> np.ndarray:
        words = tokens(text)
        return np.fromiter(map(self.number.get, words, [0] * len(words)), np.int32, len(words))

    def contaminated(self, texts: list[str]) -> np.ndarray:
        """Whether each text holds an overlap with any item of the block."""
        out = np.zeros(len(texts), bool)
        part, size = [], 0
        for k, text in enumerate(texts):
            ids = self.ids(text)
            part.append((k, ids))
            size += len(ids)
            if size >= 200_000:
                self._scan(part, out)
                part, size = [], 0
        if part:
            self._scan(part, out)
        return out

    def _scan(self, part: list[tuple[int, np.ndarray]], out: np.ndarray) -> None:
        gap = np.full(max(map(len, MASKS)), -1, np.int32)  # never equal to a token, so nothing runs over an edge
        flat = np.concatenate([x for _, ids in part for x in (ids, gap)])
        owner = np.repeat([k for k, _ in part], [len(ids) + len(gap) for _, ids in part])
        known = flat > 0
        for mask, (seeds, places, items) in zip(MASKS, self.seeds, strict=True):
            ok = np.ones(max(0, len(flat) - len(mask) + 1), bool)
            for k, bit in enumerate(mask):
                if bit == "1":
                    ok &= known[k : k + len(ok)]
            at = np.flatnonzero(ok)
            at = at[~out[owner[at]]]
            h = self._hash(flat, at, mask)
            low, high = np.searchsorted(seeds, h), np.searchsorted(seeds, h, side="right")
            hit = np.flatnonzero(high > low)
            for begin in range(0, len(hit), 50_000):
                mine = hit[begin : begin + 50_000]
                n = high[mine] - low[mine]
                seed = np.repeat(low[mine], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                here = np.repeat(at[mine], n)
                # a document and an item meet once per offset, however many seeds hit there
                first = here - places[seed] + self.starts[items[seed]]
                pairs = np.unique(np.stack((first, items[seed], owner[here]), axis=1), axis=0)
                for start in range(0, len(pairs), 4096):
                    self._verify(flat, owner, pairs[start : start + 4096], out)

    def _verify(self, flat: np.ndarray, owner: np.ndarray, pairs: np.ndarray, out: np.ndarray) -> None:
        """Lay each item over the text at its offset: some window of tokens must agree at enough places."""
        pairs = pairs[~out[pairs[:, 2]]]
        for size in np.unique((self.ends - self.starts)[pairs[:, 1]]):
            mine = pairs[(self.ends - self.starts)[pairs[:, 1]] == size]
            place = mine[:, :1] + np.arange(size)
            inside = (place >= 0) & (place < len(flat))
            place = np.where(inside, place, 0)
            same = inside & (owner[place] == mine[:, 2:]) & (flat[place] == self.flat[self.starts[mine[:, 1]][:, None] + np.arange(size)])
            window = int(min(size, OVERLAP))
            total = np.cumsum(np.pad(same, ((0, 0), (1, 0))), axis=1)
            best = (total[:, window:] - total[:, :-window]).max(axis=1)
            out[mine[best >= SIMILARITY * window - 1e-9, 2]] = True


def blocks(benchmark: DataFrame) -> Iterator[list[list[str]]]:
    """The items' tokens in blocks of bounded size; null and repeated texts count once or not at all."""
    part, size = [], 0
    for row in benchmark.select(F.col("text").cast("string").alias("text")).where("text is not null").distinct().orderBy("text").toLocalIterator():
        item = tokens(row["text"])
        if len(item) < LEAST_TOKENS:
            continue
        # a longer item than a block goes over several, which share a window
        for at in range(0, max(1, len(item) - OVERLAP + 1), BLOCK_TOKENS):
            cut = item[at : at + BLOCK_TOKENS + OVERLAP - 1]
            if part and size + len(cut) > BLOCK_TOKENS:
                yield part
                part, size = [], 0
            part.append(cut)
            size += len(cut)
    if part:
        yield part


def _look(items: Broadcast):
    @F.pandas_udf("boolean")
    def look(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        seeds = Seeds(items.value)
        for part in texts:
            yield pd.Series(seeds.contaminated([x or "" for x in part]))

    return look


def contaminated(benchmark: DataFrame, text: str = "text") -> Column:
    """A column: whether the whole text holds a passage of the benchmark. Null and empty texts hold none.

    The benchmark is a stated set of queries; every block of it, of bounded size, is laid over all rows. Nothing is
    shuffled, so no hot passage or source can gather rows in one task.
    """
    found = F.lit(False)
    spark = benchmark.sparkSession
    for items in blocks(benchmark):
        found = found | _look(spark.sparkContext.broadcast(items))(F.col(text).cast("string"))
    return found


def flagged(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``(doc_id, contaminated)`` of every row of ``docs (doc_id, text)`` against ``benchmark (text)``.

    A text is contaminated if, at some offset, at least 13 tokens in a row of an item (all, if it has fewer) agree
    with it at 0.8 or more of the places; the masks miss none of these. Tokens are lower-cased runs of letters, digits and
    underscores. Items under five tokens are not looked for. Repeated rows are each judged; an empty benchmark finds
    nothing; empty tables give no rows; further columns are ignored.
    """
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), contaminated(benchmark).alias("contaminated"))


def without_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no passage of the benchmark, with all their columns."""
    return docs.where(~contaminated(benchmark))
