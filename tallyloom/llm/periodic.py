"""Periodic runs in the words of a text, found with a suffix automaton and link-cut access.

The states of the automaton form a tree by their suffix links; the path from the state of a prefix to the root holds all
suffixes of that prefix. Each state has a colour: where its strings ended last. Going through the words from left to
right, the path of every prefix is recoloured with its own end. Before that the path consists of segments of one
colour each, and the deepest state of a segment is the longest suffix that also ended there. If the distance of the
two ends is no more than that length, the two occurrences touch or overlap: a square, and what it repeats is a run that
goes back as far as the length says. Splay trees hold the segments, so that an access costs the logarithm of the text
on average however deep the tree is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tallyloom.llm.common import documents_of

#: Texts whose results are handed on together.
TOGETHER = 512
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _automaton(codes: list[int]) -> tuple[list[int], list[int], list[int]]:
    """Suffix links, lengths of the longest strings, and the state of every prefix."""
    step: list[dict[int, int]] = [{}]
    link, length, prefixes, last = [-1], [0], [], 0
    for c in codes:
        new = len(step)
        step.append({})
        length.append(length[last] + 1)
        link.append(0)
        at = last
        while at >= 0 and c not in step[at]:
            step[at][c] = new
            at = link[at]
        if at >= 0:
            to = step[at][c]
            if length[at] + 1 != length[to]:
                copy = len(step)
                step.append(step[to].copy())
                length.append(length[at] + 1)
                link.append(link[to])
                link[to] = copy
                while at >= 0 and step[at].get(c) == to:
                    step[at][c] = copy
                    at = link[at]
                to = copy
            link[new] = to
        prefixes.append(new)
        last = new
    return link, length, prefixes


class Paths:
    """The segments of a rooted tree, each a splay tree by depth; the root of a splay tree knows the segment's colour."""

    def __init__(self, parents: list[int]):
        self.up = list(parents)  # within a splay tree, and from its root to the segment above
        self.low = [-1] * len(parents)
        self.high = [-1] * len(parents)
        self.colour = [-1] * len(parents)

    def _rotate(self, x: int) -> None:
        up, low, high = self.up, self.low, self.high
        y = up[x]
        z = up[y]
        if z >= 0:
            if low[z] == y:
                low[z] = x
            elif high[z] == y:
                high[z] = x
        if low[y] == x:
            b = high[x]
            low[y], high[x] = b, y
        else:
            b = low[x]
            high[y], low[x] = b, y
        if b >= 0:
            up[b] = y
        up[y], up[x] = x, z

    def splay(self, x: int) -> None:
        up, low, high = self.up, self.low, self.high
        top = x
        while True:
            y = up[x]
            if y < 0 or (low[y] != x and high[y] != x):
                break
            z = up[y]
            if z >= 0 and (low[z] == y or high[z] == y):
                self._rotate(y if (low[y] == x) == (low[z] == y) else x)
                top = z
            else:
                top = y
            self._rotate(x)
        self.colour[x] = self.colour[top]

    def recolour(self, x: int, colour: int) -> Iterator[tuple[int, int]]:
        """Give the path from ``x`` to the root one colour; gives the deepest node and the colour of every segment it had."""
        first, below = x, -1
        while x >= 0:
            self.splay(x)
            was, cut = self.colour[x], self.high[x]
            yield x, was
            if cut >= 0:
                self.colour[cut] = was
            self.high[x] = below
            below, x = x, self.up[x]
        self.colour[below] = colour
        self.splay(first)


def _squares(codes: list[int], times: int) -> dict[tuple[int, int], int]:
    """The end of every stretch that repeats at least ``times`` times, by its start and period."""
    link, length, prefixes = _automaton(codes)
    paths, found = Paths(link), {}
    for end, state in enumerate(prefixes):
        for node, before in paths.recolour(state, end):
            period = end - before
            # the strings of a segment ended at `before` last, so no smaller period holds
            if before >= 0 and period * (times - 1) <= length[node]:
                found[end - period - length[node] + 1, period] = end + 1
    return found


def _stretches(codes: np.ndarray, least: int, times: int) -> Iterator[tuple[int, np.ndarray]]:
    """Where runs can be: a word that occurs less than ``times`` times in a stretch is in none of its runs and cuts it."""
    todo = [(0, codes)]
    while todo:
        at, part = todo.pop()
        if len(part) < least:
            continue
        _, code, n = np.unique(part, return_inverse=True, return_counts=True)
        rare = np.flatnonzero(n[code] < times)
        if not len(rare):
            yield at, code
            continue
        starts, stops = np.concatenate(([0], rare + 1)), np.concatenate((rare, [len(part)]))
        long = stops - starts >= least
        pieces = list(zip(starts[long].tolist(), stops[long].tolist(), strict=True))
        if len(pieces) == 1 and 10 * (pieces[0][1] - pieces[0][0]) > 9 * len(part):
            yield at + pieces[0][0], code[pieces[0][0] : pieces[0][1]]  # cutting on would hardly shorten it
        else:
            todo += [(at + a, part[a:b]) for a, b in pieces]


def runs_of(words: list, least: int = 6, times: int = 4) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` by start, then period: the maximal stretches of at least ``least`` words that repeat with their
    smallest period at least ``times`` (2 or more) times."""
    if len(words) < least:
        return []
    number: dict = {}
    codes = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    found = []
    for at, part in _stretches(codes, least, times):
        for (start, period), stop in _squares(part.tolist(), times).items():
            if stop - start >= max(least, times * period):
                found.append((at + start, stop - start, period))
    return sorted(found)


def _collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words without those that repeat the first period of a run."""
    if not runs:
        return b" ".join(words)
    gone = np.zeros(len(words), dtype=bool)
    for start, length, period in runs:
        gone[start + period : start + length] = True
    return b" ".join(words[k] for k in np.flatnonzero(~gone).tolist())


def periodic_runs(docs: DataFrame, least: int = 6, times: int = 4) -> DataFrame:
    """``(doc_id, n_words, runs, text)`` of every row of ``docs (doc_id, text)``.

    Words are cut at ASCII white space; ``runs`` is an array of ``(start, length, period)`` in words, by start, then period, as
    ``runs_of`` defines them. ``text`` has the words joined by one space, without those that stand in a run after its first period. Null
    texts count as empty; null ids are kept; repeated rows are each returned; an empty table gives no rows; further
    columns are ignored. No rows are exchanged. A text is one value: its automaton holds some 600 bytes a word of those stretches
    where words repeat often enough for a run.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), TOGETHER):
                part = batch.slice(at, TOGETHER)
                sizes, runs, kept = [], [], []
                for text in part.column(1).to_pylist():
                    words = text.encode("utf-8").split()
                    found = runs_of(words, least, times)
                    sizes.append(len(words))
                    runs.append([dict(zip(("start", "length", "period"), r, strict=True)) for r in found])
                    kept.append(_collapsed(words, found).decode("utf-8"))
                columns = [part.column(0), pa.array(sizes, pa.int64()), pa.array(runs, pa.list_(RUN)), pa.array(kept, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "runs", "text"])

    schema = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, text string"
    return documents_of(docs).mapInArrow(find, schema)
