"""Exact repeated substrings over a collection of documents, by column-wise construction of the collection's
Burrows-Wheeler transform.

The construction inserts one symbol of every string each round. Whole documents would need as many rounds as the
longest has bytes, so the collection is first cut into short strings, none longer than ``2 * WINDOW - GRAM`` bytes, such
that every window of ``WINDOW`` bytes lies whole in one of them and equal windows meet in one shard:

1. ``_anchors``: a window belongs to its core, the ``CORE`` bytes that begin or end with its smallest hashed gram; runs of
   windows with one core are a string.
2. ``_repeated``: cores that only one document has cannot hold a repeat; the rest are told to the groups that have them.
3. ``_strings``: the strings of repeated cores, each once per group of documents, go to the core's shard.
4. ``_answers``: a shard builds its transform column by column, reads the sorted windows off it, and finds for each
   class of equal windows the smallest document; the answers go back to the groups.
5. ``_removed``: every byte under a window that a smaller document also has is marked.

Documents are dealt into groups of ``GROUP_BYTES`` or more by a hash of their texts, so that copies meet: of these only one
goes through steps 1 to 4, the others follow from it. The exchange that deals them is used by steps 1, 3 and 5. What steps 1-4 send on are packed arrays, one row for each group and shard. Groups grow with the root of the
input, so these rows grow with the input and not with its square.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.llm.common import free_name, groups_for, text_bytes

WINDOW = 50
GRAM = 16
SPAN = WINDOW - GRAM + 1  # grams of a window, and windows of a string at most
CORE = WINDOW - SPAN // 2  # a gram has so many bytes on one side at least, itself included, in every window that holds it
GROUP_BYTES = 2 << 20
#: Beyond so many groups their size grows as their number does, up to so many times.
GROUPS, GROWN = 128, 8
SLICE = 1 << 20  # bytes that are looked at together
ROW_BYTES = 100  # that a row counts for besides its text
PLACE = (1 << 22) - 1  # the bits of a position in a slice, which holds less than 2 * SLICE + WINDOW bytes
#: A core with more strings than this, over all groups, is hot: they are cut into single windows, dealt by their own hash.
HOT_STRINGS = 1 << 15
NO_ID = np.iinfo(np.int64).max  # rows without an id come after all others

MASK = (1 << 48) - 1
PARTS = 256  # a shard's strings are dealt on by the same key, so that what is sorted together fits a processor's cache
TOGETHER = 2000  # strings
ROUNDS = 10  # of a transform, whose symbols are merged at once

KEY, MESSAGE = "__group", "shard int, __group int, body binary"


def _packed(parts: list[tuple[np.ndarray, ...]]) -> list[bytes]:
    """Tuples of arrays as a compressed message each; their element types are fixed by the step. Wider elements go byte
    by byte, all first bytes before all second ones, as the upper bytes of sorted or small numbers are much the same."""
    compress, out = zstandard.ZstdCompressor(level=1).compress, []
    for arrays in parts:
        bodies = (a.view(np.uint8).reshape(-1, a.itemsize).T.tobytes() if a.itemsize > 1 and len(a) else a.tobytes() for a in arrays)
        out.append(compress(b"".join((np.array([len(a) for a in arrays], dtype=np.int64).tobytes(), *bodies))))
    return out


def _unpacked(bodies: pa.ChunkedArray, *kinds: str) -> list[tuple[np.ndarray, ...]]:
    decompress, sizes = zstandard.ZstdDecompressor().decompress, [np.dtype(k).itemsize for k in kinds]
    out = []
    for body in bodies.to_pylist():
        raw, at, arrays = decompress(body), 8 * len(kinds), []
        for n, kind, size in zip(np.frombuffer(raw, np.int64, len(kinds)).tolist(), kinds, sizes, strict=True):
            planes = np.frombuffer(raw, np.uint8, n * size, at)
            arrays.append((planes if size == 1 else np.ascontiguousarray(planes.reshape(size, n).T).reshape(-1)).view(kind))
            at += n * size
        out.append(tuple(arrays))
    return out


def _words(data: np.ndarray) -> np.ndarray:
    """The eight bytes from every position on, as a number."""
    out = np.empty(len(data) - 7, np.uint64)
    for k in range(8):
        out[k::8] = data[k : k + (len(data) - k) // 8 * 8].view(np.uint64)
    return out


def _hashed(words: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """A hash of the ``size`` bytes, 8 at least, from every position of ``begin`` on; ``words`` are those of ``_words``."""
    out, last = size.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15), begin + size - 8
    for at in range(0, size.max(initial=0), 8):
        some = slice(None) if at < size.min() else np.flatnonzero(size > at)
        # words are mixed before they are joined, as texts differ in few bits and at regular places
        word = words[np.minimum(begin[some] + at, last[some])]
        word ^= word >> np.uint64(32)
        word *= np.uint64(0xD6E8FEB86659FD93)
        word ^= word >> np.uint64(32)
        word *= np.uint64(0xD6E8FEB86659FD93)
        word ^= word >> np.uint64(32)
        word ^= out[some]
        word *= np.uint64(0xBF58476D1CE4E5B9)
        word ^= word >> np.uint64(31)
        out[some] = word
    out *= np.uint64(0x94D049BB133111EB)
    out ^= out >> np.uint64(29)
    return out


def _smallest_grams(eight: np.ndarray) -> np.ndarray:
    """For every window, the gram of smallest hash, of equal ones the first: its hash, with its place in the low bits."""
    h = eight[: len(eight) - (GRAM - 8)] * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    h += eight[GRAM - 8 :]
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0x94D049BB133111EB)
    h &= np.uint64(~PLACE & (1 << 64) - 1)
    h |= np.arange(len(h), dtype=np.uint64)
    width = 1
    while 2 * width <= SPAN:
        h = np.minimum(h[:-width], h[width:])
        width *= 2
    return np.minimum(h[: len(h) - (SPAN - width)], h[SPAN - width :]) if width < SPAN else h


def _slices(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """``(bytes, number of the text, its offset, end)`` of buffers of about ``SLICE`` bytes; a longer text goes over
    several, which overlap so that every window is whole in exactly one."""
    parts, size = [], 0
    for k, text in enumerate(texts):
        for at in range(0, max(len(text) - WINDOW + 1, 0), SLICE):
            part = text[at : at + SLICE + WINDOW - 1]
            parts.append((k, at, part))
            size += len(part)
            if size >= SLICE:
                yield _joined(parts)
                parts, size = [], 0
    if parts:
        yield _joined(parts)


def _joined(parts: list[tuple[int, int, bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    ends = np.cumsum([len(p) for _, _, p in parts])
    starts = np.concatenate(([0], ends[:-1]))
    return np.frombuffer(b"".join(p for _, _, p in parts), np.uint8), np.array([k for k, _, _ in parts]), np.array([at for _, at, _ in parts]) - starts, ends


def _runs(data: np.ndarray, ends: np.ndarray, eight: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(core, part, first window, windows)`` of every string in a buffer of texts that end at ``ends``; ``eight`` are
    its words, a core is known by 48 bits of its hash.

    Of the windows that hold a gram the earlier have more bytes before it; their core ends with it, that of the others
    begins with it. Which bytes are a window's core follows from the window alone.
    """
    eight = _words(data) if eight is None else eight
    grams = _smallest_grams(eight)
    starts = np.concatenate(([0], ends[:-1]))
    inside = np.ones(len(data), bool)
    inside[(ends[:, None] - np.arange(1, WINDOW)).ravel()] = False  # windows that would go over the end of a text
    inside = inside[: len(grams)]
    new = np.ones(len(grams), bool)
    np.not_equal(grams[1:], grams[:-1], out=new[1:])
    new[starts] = True
    new &= inside
    begin = np.flatnonzero(new)
    n = np.flatnonzero(inside & np.append(new[1:] | ~inside[1:], True)) + 1 - begin
    gram = (grams[begin] & np.uint64(PLACE)).astype(np.int64)
    before = np.clip(gram - SPAN // 2 + 1 - begin, 0, n)  # windows with the gram in their later half
    first = np.stack((begin, begin + before), 1).ravel()
    core = np.stack((gram - SPAN // 2, gram), 1).ravel()
    n = np.stack((before, n - before), 1).ravel()
    core, begin, n = core[n > 0], first[n > 0], n[n > 0]
    key = _hashed(eight, core, np.full(len(core), CORE)) & np.uint64(MASK)
    joint = (key[1:] == key[:-1]) & (begin[1:] == begin[:-1] + n[:-1])
    if joint.any():  # windows of periodic texts that move from one gram to an equal one
        head = np.flatnonzero(np.append(True, ~joint))
        key, begin, n = key[head], begin[head], np.add.reduceat(n, head)
    if n.max(initial=0) > SPAN:  # their runs are cut, so that strings stay short
        times = -(-n // SPAN)
        done = SPAN * (np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times))
        key, begin, n = np.repeat(key, times), np.repeat(begin, times) + done, np.minimum(np.repeat(n, times) - done, SPAN)
    return key, np.searchsorted(ends, begin, side="right"), begin, n


def _singles(cut: np.ndarray, begin: np.ndarray, n: np.ndarray, *others: np.ndarray) -> tuple[np.ndarray, ...]:
    """The strings, a string for each window of those that are ``cut``."""
    times = np.where(cut, n, 1)
    step = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
    return np.repeat(cut, times), np.repeat(begin, times) + step, np.repeat(np.where(cut, 1, n), times), *(np.repeat(x, times) for x in others)


def _texts(table: pa.Table) -> list[bytes]:
    return [x.as_buffer().to_pybytes() if x.is_valid else b"" for x in table.column("text").cast(pa.binary())]


def _firsts(texts: list[bytes], ids: np.ndarray) -> list[int]:
    """For every row the row of the same text with the smallest id, which may be itself."""
    first: dict[bytes, int] = {}
    numbers = ids.tolist()
    for k, text in enumerate(texts):
        if numbers[first.setdefault(text, k)] > numbers[k]:
            first[text] = k
    return [first[text] for text in texts]


def _without_copies(texts: list[bytes], ids: np.ndarray) -> list[bytes]:
    return [text if k == first else b"" for k, (text, first) in enumerate(zip(texts, _firsts(texts, ids), strict=True))]


def _ids(table: pa.Table) -> np.ndarray:
    return table.column("doc_id").cast(pa.int64()).fill_null(NO_ID).to_numpy()


def _shard(cores: np.ndarray, shards: int) -> np.ndarray:
    """Shards have ranges of the 48 bits, so what is sorted by core is sorted by shard."""
    return (cores >> np.uint64(16)) * np.uint64(shards) >> np.uint64(32)


def _dealt(shards: np.ndarray, group: int, *arrays: np.ndarray) -> pa.Table:
    """One message for each shard, of the rows of ``arrays`` that belong to it; sorted by shard already."""
    which, starts = np.unique(shards, return_index=True)
    stops = np.append(starts, len(shards))[1:]
    return _messages(which, group, [tuple(a[s:e] for a in arrays) for s, e in zip(starts.tolist(), stops.tolist(), strict=True)])


def _messages(shards: np.ndarray | list[int], group: int, parts: list[tuple[np.ndarray, ...]]) -> pa.Table:
    return pa.table({"shard": pa.array(shards, pa.int32()), KEY: pa.array([group] * len(parts), pa.int32()), "body": pa.array(_packed(parts), pa.binary())})


def _sent_on(table: pa.Table) -> pa.Table:
    """Messages that were dealt by group instead of by shard."""
    return pa.table({"shard": pa.array([0] * len(table), pa.int32()), KEY: table.column("shard"), "body": table.column("body")})


def _anchors(shards: int, key: str) -> Callable:
    def run(table: pa.Table) -> pa.Table:
        ids, cores, sides, docs = _ids(table), [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for data, which, _, ends in _slices(_without_copies(_texts(table), ids)):
            eight = _words(data)
            g, part, begin, n = _runs(data, ends, eight)
            cores.append(g)
            # strings of one core are told apart by their length and ends; this is for counting them only
            sides.append(eight[begin] * np.uint64(0x9E3779B97F4A7C15) + eight[begin + n + WINDOW - 9] * np.uint64(0xBF58476D1CE4E5B9) + n.astype(np.uint64))
            docs.append(ids[which[part]])
        g, side, d = np.concatenate(cores), np.concatenate(sides), np.concatenate(docs)
        order = np.argsort(g)
        g = g[order]
        start = np.flatnonzero(np.append(True, g[1:] != g[:-1])[: len(g)])
        n = np.diff(np.append(start, len(g)))
        several, strings = np.zeros(len(start), bool), np.ones(len(start), np.uint16)
        if (n > 1).any():
            more = np.repeat(n > 1, n)
            g_more, order = g[more], order[more]
            order = order[np.lexsort((side[order], g_more))]
            d, sides = d[order], side[order]
            first = np.cumsum(n[n > 1]) - n[n > 1]
            several[n > 1] = np.minimum.reduceat(d, first) != np.maximum.reduceat(d, first)
            new = np.append(True, sides[1:] != sides[:-1])
            new[first] = True
            strings[n > 1] = np.minimum(np.add.reduceat(new, first, dtype=np.int64), 0xFFFF)
        g = g[start]
        return _dealt(_shard(g, shards), table.column(key)[0].as_py(), g, several, strings)

    return run


def _repeated(hot_strings: int) -> Callable:
    def run(table: pa.Table) -> pa.Table:
        parts = _unpacked(table.column("body"), "u8", "?", "u2")
        owner = np.repeat(table.column(KEY).to_numpy(), [len(g) for g, _, _ in parts])
        cores, several, strings = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.argsort(cores)
        cores, owner, several, strings = cores[order], owner[order], several[order], strings[order]
        start = np.flatnonzero(np.append(True, cores[1:] != cores[:-1])[: len(cores)])
        n = np.diff(np.append(start, len(cores)))
        kept = np.repeat((n > 1) | np.logical_or.reduceat(several, start), n)
        hot = np.repeat(np.add.reduceat(strings, start, dtype=np.int64) > hot_strings, n)[kept]
        cores, owner = cores[kept], owner[kept]
        order = np.argsort(owner, kind="stable")
        return _sent_on(_dealt(owner[order], 0, cores[order], hot[order]))

    return run


def _strings(shards: int, key: str) -> Callable:
    def run(docs: pa.Table, told: pa.Table) -> pa.Table:
        if not len(told) or not len(docs):
            return _messages([], 0, [])
        cores, hot = (np.concatenate(x) for x in zip(*_unpacked(told.column("body"), "u8", "?"), strict=True))
        order = np.argsort(cores)
        cores, hot = cores[order], hot[order]
        ids = _ids(docs)
        found: dict[int, bytes] = {}  # strings by their hashes
        rows = [(np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64))]
        for data, which, _, ends in _slices(_without_copies(_texts(docs), ids)):
            raw, eight = data.tobytes(), _words(data)
            g, part, begin, n = _runs(data, ends, eight)
            at = np.minimum(np.searchsorted(cores, g), len(cores) - 1)
            keep = np.flatnonzero(cores[at] == g)
            begin, n, doc, to, cut = begin[keep], n[keep], ids[which[part[keep]]], g[keep], hot[at[keep]]
            if cut.any():
                cut, begin, n, doc, to = _singles(cut, begin, n, doc, to)
            size = n + WINDOW - 1
            digest = _hashed(eight, begin, size)
            rows.append((digest, np.where(cut, digest & np.uint64(MASK), to), doc))
            some, first = np.unique(digest, return_index=True)
            for d, s, e in zip(some.tolist(), begin[first].tolist(), (begin + size)[first].tolist(), strict=True):
                if d not in found:
                    found[d] = raw[s:e]
        digest, to, doc = (np.concatenate(x) for x in zip(*rows, strict=True))
        order = np.argsort(digest)
        digest, to, doc = digest[order], to[order], doc[order]
        start = np.flatnonzero(np.append(True, digest[1:] != digest[:-1])[: len(digest)])
        digest, to, low, high = digest[start], to[start], np.minimum.reduceat(doc, start), np.maximum.reduceat(doc, start)
        order = np.argsort(to)
        digest, to, low, high = digest[order], to[order], low[order], high[order]
        part = (to % np.uint64(PARTS)).astype(np.uint8)
        texts = [found[d] for d in digest.tolist()]
        size = np.array([len(t) for t in texts], np.uint8)
        which, starts = np.unique(_shard(to, shards), return_index=True)
        out, cut = [], cores[hot]  # which cores are hot goes along once, to come back with the answers
        for s, e in zip(starts.tolist(), [*starts.tolist(), len(texts)][1:], strict=True):
            out.append((np.frombuffer(b"".join(texts[s:e]), np.uint8), size[s:e], low[s:e], high[s:e] - low[s:e], part[s:e], cut))
            cut = cut[:0]
        return _messages(which, docs.column(key)[0].as_py(), out)

    return run


def transform(data: np.ndarray, ends: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The Burrows-Wheeler transform of the strings that end at ``ends`` in ``data`` (symbols 1 to 255; 0 ends a string).

    Round j puts the symbol before the suffix of length j of every string that has one into the transform of all
    shorter suffixes. Where it goes follows from the symbol put in the round before: its rank among the equal symbols
    of the transform so far, after all smaller ones.

    The symbols of ``ROUNDS`` rounds are kept apart (``recent``, with the place in ``whole`` that each goes before) and
    then merged at once, so that most rounds rank and move these few and look ranks in ``whole`` up by bisection.
    """
    n, rounds = len(sizes), int(sizes.max(initial=0))
    whole, place, live = data[ends - 1].copy(), np.arange(n), np.arange(n)
    for first in range(1, rounds + 1, ROUNDS):
        order = np.argsort(whole, kind="stable")[np.count_nonzero(whole == 0) :]
        wide = len(whole) + 1
        keys = whole[order].astype(np.int64) * wide + order
        latest = np.zeros(len(whole), bool)
        latest[place] = True
        # of so many smaller symbols, those whose own suffixes are not in ``whole`` yet
        ahead = np.concatenate(([0], np.cumsum(latest[order])))
        recent, before, newest = np.zeros(0, np.uint8), np.zeros(0, np.int64), np.zeros(0, bool)
        spot, symbol = place, whole[place]
        for j in range(first, min(first + ROUNDS, rounds + 1)):
            # the strings by the places of their suffixes of length j; those that have ended come first
            ended = np.count_nonzero(symbol == 0)
            by = np.argsort(symbol, kind="stable")[ended:]
            live = live[by]
            rank = np.searchsorted(keys, symbol[by].astype(np.int64) * wide + spot[by])
            spot, at = n + rank - ahead[rank], ahead[rank]
            if len(recent):
                at = at + np.flatnonzero(newest[np.argsort(recent, kind="stable")])[ended:] - np.count_nonzero(recent == 0)
            more = sizes[live] > j
            symbol = np.where(more, data[ends[live] - 1 - np.where(more, j, 0)], 0).astype(np.uint8)
            newest = np.zeros(len(recent) + len(live), bool)
            newest[at] = True
            recent, before = _inserted(recent, symbol, newest, at), _inserted(before, spot, newest, at)
        at = before + np.arange(len(before))
        place = at[newest]
        added = np.zeros(len(whole) + len(recent), bool)
        added[at] = True
        whole = _inserted(whole, recent, added, at)
    return whole


def _inserted(old: np.ndarray, new: np.ndarray, is_new: np.ndarray, at: np.ndarray) -> np.ndarray:
    out = np.empty(len(is_new), old.dtype)
    out[~is_new] = old
    out[at] = new
    return out


def sorted_windows(data: np.ndarray, ends: np.ndarray, sizes: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """``(string, offset)`` of every suffix of at least ``window`` symbols, in the order of the transform."""
    bwt = transform(data, ends, sizes)
    n, zeros = len(sizes), np.count_nonzero(bwt == 0)
    order = np.argsort(bwt, kind="stable")
    back = np.empty(len(bwt), np.int64)
    back[order] = np.arange(len(bwt)) + n - zeros
    place, live = np.arange(n), np.arange(n)
    string, offset = np.full(len(bwt), -1, np.int64), np.zeros(len(bwt), np.int64)
    for j in range(1, int(sizes.max(initial=0)) + 1):
        going = sizes[live] >= j
        place, live = back[place[going]], live[going]
        if j >= window:
            string[place] = live
            offset[place] = sizes[live] - j
    kept = string >= 0
    return string[kept], offset[kept]


def _classes(strings: list[bytes], least: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(string, offset, smallest document)`` of every window that several documents have."""
    sizes = np.array([len(s) for s in strings], np.int64)
    ends = np.cumsum(sizes)
    data = np.frombuffer(b"".join(strings) + bytes(8), np.uint8)
    # byte 0 ends strings in the transform, so texts that hold it are shifted into the free byte 255 of UTF-8
    string, offset = sorted_windows(np.where(data == 0, 255, data).astype(np.uint8), ends, sizes, WINDOW)
    start, eight = (ends - sizes)[string] + offset, _words(data)
    # neighbours in the order share a prefix of WINDOW bytes or are different
    same = np.ones(len(start) - 1, bool)
    for k in (*range(0, WINDOW - 7, 8), WINDOW - 8):
        same &= eight[start[1:] + k] == eight[start[:-1] + k]
    new = np.append(True, ~same)
    first, cls = np.flatnonzero(new), np.cumsum(new) - 1
    smallest = np.minimum.reduceat(least[string], first)[cls]
    repeated = smallest < np.maximum.reduceat(most[string], first)[cls]
    return string[repeated], offset[repeated], smallest[repeated]


def _answers(table: pa.Table) -> pa.Table:
    groups, owner, strings, low, high, parts, cuts = table.column(KEY).to_pylist(), [], [], [], [], [], []
    for group, (raw, size, least, more, part, cut) in zip(groups, _unpacked(table.column("body"), "u1", "u1", "i8", "i8", "u1", "u8"), strict=True):
        raw, end = raw.tobytes(), np.cumsum(size, dtype=np.int64)
        strings += [raw[e - s : e] for e, s in zip(end.tolist(), size.tolist(), strict=True)]
        owner.append(np.full(len(size), group, np.int64))
        low.append(least)
        high.append(least + more)
        parts.append(part)
        if len(cut):
            cuts.append((group, cut))
    owner, low, high, parts = (np.concatenate(x) for x in (owner, low, high, parts))
    number: dict[bytes, int] = {}
    which = np.array([number.setdefault(s, len(number)) for s in strings], np.int64)
    distinct = list(number)
    del strings, number
    least, most = np.full(len(distinct), NO_ID, np.int64), np.full(len(distinct), np.iinfo(np.int64).min, np.int64)
    np.minimum.at(least, which, low)
    np.maximum.at(most, which, high)
    part = np.zeros(len(distinct), np.int64)
    part[which] = parts
    part %= min(PARTS, -(-len(distinct) // TOGETHER))
    found = [(np.zeros(0, np.int64),) * 3]
    for k in np.unique(part):
        mine = np.flatnonzero(part == k)
        string, offset, smallest = _classes([distinct[i] for i in mine.tolist()], least[mine], most[mine])
        found.append((mine[string], offset, smallest))
    string, offset, smallest = (np.concatenate(x) for x in zip(*found, strict=True))
    # per distinct string its windows in order, as runs of one smallest document
    order = np.lexsort((offset, string))
    string, offset, smallest = string[order], offset[order], smallest[order]
    new = np.append(True, (string[1:] != string[:-1]) | (offset[1:] != offset[:-1] + 1) | (smallest[1:] != smallest[:-1]))[: len(string)]
    begin = np.flatnonzero(new)
    length = np.diff(np.append(begin, len(string)))
    string, offset, smallest = string[begin], offset[begin], smallest[begin]
    size = np.array([len(s) for s in distinct], np.int64)
    digest = _hashed(_words(np.frombuffer(b"".join(distinct), np.uint8)), np.cumsum(size) - size, size)
    # every group that sent a string gets its runs
    at, stop = np.searchsorted(string, which), np.searchsorted(string, which, side="right")
    n = stop - at
    run_of = np.repeat(at, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    to = np.repeat(owner, n)
    order = np.argsort(to, kind="stable")
    run_of, to = run_of[order], to[order]
    none = np.zeros(0, np.uint64)
    out = _dealt(to, 0, digest[string[run_of]], offset[run_of].astype(np.uint8), length[run_of].astype(np.uint8), smallest[run_of], none)
    hot = _messages([g for g, _ in cuts], 0, [(none, *(np.zeros(0, np.uint8),) * 2, np.zeros(0, np.int64), c) for _, c in cuts])
    return _sent_on(pa.concat_tables([out, hot]))


def _marks(docs: pa.Table, told: pa.Table) -> Iterator[tuple[bytes, np.ndarray]]:
    """Every text of a group with the mask of its removed bytes."""
    texts, ids = _texts(docs), _ids(docs)
    firsts, own = _firsts(texts, ids), _without_copies(texts, ids)
    base = np.cumsum([0, *(len(t) + 1 for t in own)])
    # by how much more windows cover a byte than the one before; a byte has WINDOW at most
    change = np.zeros(base[-1], np.int8)
    if len(told):
        digest, offset, length, smallest, cut = (np.concatenate(x) for x in zip(*_unpacked(told.column("body"), "u8", "u1", "u1", "i8", "u8"), strict=True))
        order = np.argsort(digest, kind="stable")
        digest, offset, length, smallest = digest[order], offset[order].astype(np.int64), length[order].astype(np.int64), smallest[order]
        for data, which, shift, ends in _slices(own) if len(digest) else ():
            eight = _words(data)
            g, part, begin, n = _runs(data, ends, eight)
            if len(cut):  # strings of hot cores were sent as single windows
                _, begin, n, part = _singles(np.isin(g, cut), begin, n, part)
            mine = _hashed(eight, begin, n + WINDOW - 1)
            at = np.searchsorted(digest, mine)
            known = np.flatnonzero(digest[np.minimum(at, len(digest) - 1)] == mine)
            at, mine, begin, part = at[known], mine[known], begin[known], part[known]
            times = np.searchsorted(digest, mine, side="right") - at
            row = np.repeat(np.arange(len(mine)), times)
            answer = np.repeat(at, times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            late = smallest[answer] < ids[which[part[row]]]
            row, answer = row[late], answer[late]
            first = base[which[part[row]]] + begin[row] + shift[part[row]] + offset[answer]
            np.add.at(change, first, 1)
            np.subtract.at(change, first + length[answer] + WINDOW - 1, 1)
    mask = np.cumsum(change, dtype=np.int8) > 0
    for text, number, first in zip(texts, ids.tolist(), firsts, strict=True):
        if number > ids[first] and len(text) >= WINDOW:
            yield text, np.ones(len(text), bool)
        else:
            yield text, mask[base[first] : base[first] + len(text)]


DIGESTS = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _digests(docs: pa.Table, told: pa.Table) -> pa.Table:
    rows = []
    for text, mask in _marks(docs, told):
        kept = np.frombuffer(text, np.uint8)[~mask].tobytes()
        spans = int(np.count_nonzero(mask[1:] & ~mask[:-1])) + int(mask[:1].sum())
        rows.append((len(text), int(mask.sum()), spans, hashlib.sha256(kept).hexdigest()))
    n, r, s, h = (list(x) for x in zip(*rows, strict=True)) if rows else ([], [], [], [])
    ids = docs.column("doc_id").cast(pa.int64())
    return pa.table({"doc_id": ids, "n_bytes": pa.array(n, pa.int64()), "n_removed": pa.array(r, pa.int64()), "n_spans": pa.array(s, pa.int64()), "kept_sha256": pa.array(h, pa.string())})


def _rewritten(columns: list[str]) -> Callable:
    def run(docs: pa.Table, told: pa.Table) -> pa.Table:
        kept = [np.frombuffer(t, np.uint8)[~m].tobytes().decode("utf-8", "ignore") if m.any() else None for t, m in _marks(docs, told)]
        old = docs.column("text").to_pylist()
        text = pa.array([o if k is None else k for k, o in zip(kept, old, strict=True)], pa.string())
        return docs.set_column(docs.column_names.index("text"), "text", text).select(columns)

    return run


def _group_bytes(total: int, least: int) -> int:
    """Bytes of a group. The messages of all groups to all shards are kept to a number in proportion to the input."""
    return min(max(least, int((total * least / GROUPS) ** 0.5)), GROWN * least)


def _each_group(docs: DataFrame, last: Callable, schema, hot_strings: int, group_bytes: int) -> DataFrame:
    total = text_bytes(docs)
    size = _group_bytes(total, group_bytes)
    groups, shards = groups_for(total, size), groups_for(total, 2 * size)
    # copies meet; where they would fill a group, they are spread by their ids
    text = F.xxhash64("text")
    weight = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + ROW_BYTES
    copies = docs.select(text.alias("text"), weight.alias("weight")).groupBy("text").agg(F.sum("weight").alias("weight"), F.count("*").alias("n"))
    many = [r.text for r in copies.where((F.col("n") > 1) & (F.col("weight") > size // 4)).select("text").collect()]
    group = F.pmod(F.xxhash64("text", F.when(text.isin(many), F.col("doc_id").cast("long"))), F.lit(groups)).cast("int")
    key = free_name(docs, KEY)
    dealt = docs.withColumn(key, group)
    anchors = dealt.groupBy(key).applyInArrow(_anchors(shards, key), MESSAGE)
    told = anchors.groupBy("shard").applyInArrow(_repeated(hot_strings), MESSAGE)
    strings = dealt.groupBy(key).cogroup(told.groupBy(KEY)).applyInArrow(_strings(shards, key), MESSAGE)
    answers = strings.groupBy("shard").applyInArrow(_answers, MESSAGE)
    return dealt.groupBy(key).cogroup(answers.groupBy(KEY)).applyInArrow(last, schema)


def repeat_digests(docs: DataFrame, hot_strings: int = HOT_STRINGS, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256)`` of every row of ``docs (doc_id, text)``.

    A byte is removed where a string of 50 bytes covers it that also starts in a document with a smaller doc_id;
    strings are judged on the input. Null texts are empty; texts under 50 bytes lose nothing. Rows without a doc_id
    come after all others and do not count against one another, nor do rows that share a doc_id. Empty tables give no
    rows; further columns are ignored.
    """
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return _each_group(plain, _digests, DIGESTS, hot_strings, group_bytes)


def without_repeats(docs: DataFrame, hot_strings: int = HOT_STRINGS, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """``docs`` with the repeated bytes taken out of ``text``; a character that loses a part of its bytes goes whole.
    All rows and all other columns stay as they are."""
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in docs.schema])
    return _each_group(docs, _rewritten(docs.columns), schema, hot_strings, group_bytes)
