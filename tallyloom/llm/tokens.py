"""Token ids of documents by a public tokenizer whose vocabulary file is a parameter."""

from __future__ import annotations

import json
import os
import sys
import types
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Places of the words whose ids a worker process keeps (33 bytes each), and what a word that is kept may have at most.
CACHE_LOG2 = 20
KEY_BYTES, KEY_IDS = 15, 8
#: Characters of text that are cut into words together.
BATCH_CHARS = 1 << 20

#: Fixed by the tokenizer: a run of these letters is one word to it, a run of marks another. The apostrophe is no such mark.
LETTERS = "^(?P<letters>[a-zß-öø-ÿ]+)(?P<marks>[!-&(-/:-@\\[-`{-~]*)$"


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _byte_letters() -> dict[int, str]:
    """The characters by which a byte-level vocabulary writes bytes: printable ones as themselves, the rest from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return {b: chr(b) for b in plain} | {b: chr(256 + n) for n, b in enumerate(b for b in range(256) if b not in plain)}


class WordMerges:
    """The merges of the tokenizer's vocabulary, applied to many words at once.

    The lowest-ranked pair of neighbours of each word is merged, the leftmost first, until no word has one.
    """

    def __init__(self, tokenizer):
        model = json.loads(tokenizer.to_str())["model"]
        vocab, end = model["vocab"], model["end_of_word_suffix"]
        self.plain, self.last = np.zeros(256, np.int64), np.zeros(256, np.int64)
        for b, c in _byte_letters().items():
            self.plain[b], self.last[b] = vocab[c], vocab[c + end]
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        keys = np.array([vocab[a] << 32 | vocab[b] for a, b in merges])
        order = np.argsort(keys)
        self.keys, self.rank = keys[order], order
        self.made = np.array([vocab[a + b] for a, b in merges])

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (right >= 0), self.rank[at], len(self.keys))

    def ids(self, words: list[bytes]) -> list[bytes]:
        out: list[bytes] = [b""] * len(words)
        by_size = sorted(range(len(words)), key=lambda k: len(words[k]))
        for at in range(0, len(words), 8192):
            part = by_size[at : at + 8192]
            for k, ids in zip(part, self._some([words[k] for k in part]), strict=True):
                out[k] = ids
        return out

    def _some(self, words: list[bytes]) -> list[bytes]:
        size = np.array([len(w) for w in words])
        wide = int(size.max())
        raw = np.frombuffer(b"".join(w.ljust(wide, b"\0") for w in words), np.uint8).reshape(-1, wide)
        ids = np.where(np.arange(wide) < size[:, None], self.plain[raw], -1)
        ids[np.arange(len(words)), size - 1] = self.last[raw[np.arange(len(words)), size - 1]]
        ids = np.pad(ids, ((0, 0), (0, 2)), constant_values=-1)
        none = len(self.keys)
        ranks = np.full(ids.shape, none)
        ranks[:, :wide] = self._ranks(ids[:, :wide], ids[:, 1 : wide + 1])
        live, done = np.arange(len(words)), np.full((len(words), wide), -1, np.int64)
        column = np.arange(ids.shape[1])
        while len(live):
            p = ranks.argmin(axis=1)
            row = np.arange(len(live))
            best = ranks[row, p]
            ended = best == none
            if ended.any():
                done[live[ended]] = ids[ended][:, :wide]
                live, ids, ranks, p, best = live[~ended], ids[~ended], ranks[~ended], p[~ended], best[~ended]
                if not len(live):
                    break
                row = np.arange(len(live))
            take = np.minimum(column + (column > p[:, None]), ids.shape[1] - 1)
            ids, ranks = np.take_along_axis(ids, take, 1), np.take_along_axis(ranks, take, 1)
            ids[row, p] = self.made[best]
            ranks[row, p] = self._ranks(ids[row, p], ids[row, p + 1])
            before = np.flatnonzero(p > 0)
            ranks[before, p[before] - 1] = self._ranks(ids[before, p[before] - 1], ids[before, p[before]])
        n = (done >= 0).sum(axis=1)
        flat, stop = done[done >= 0].astype(np.uint32).tobytes(), (4 * np.cumsum(n)).tolist()
        return [flat[a:b] for a, b in zip([0, *stop[:-1]], stop, strict=True)]


#: How many ids each of several words has, and the ids of all one after another.
Ids = tuple[np.ndarray, np.ndarray]


def _joined(ids: list[bytes]) -> Ids:
    return np.fromiter(map(len, ids), np.int64, len(ids)) // 4, np.frombuffer(b"".join(ids), np.uint32)


def _put(out: np.ndarray, at: np.ndarray, flat: np.ndarray, start: np.ndarray, size: np.ndarray) -> None:
    """Copy ``size`` numbers from each ``start`` of ``flat`` to each ``at`` of ``out``."""
    step = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    out[np.repeat(at, size) + step] = flat[np.repeat(start, size) + step]


class WordCache:
    """The ids of words met lately, of fixed size: a word has one place, and a later word of that place displaces it.

    Only words of up to ``KEY_BYTES`` bytes and ``KEY_IDS`` ids are kept. The key of such a word is its bytes and their number,
    so that what is found is never another word's.
    """

    def __init__(self, places_log2: int, n_ids: int):
        self.shift, n = np.uint64(64 - places_log2), 1 << places_log2
        self.low, self.high = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
        self.size, self.body = np.zeros(n, np.uint8), np.zeros((n, KEY_IDS), np.uint16 if n_ids <= 1 << 16 else np.uint32)

    def places(self, words: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of each word its place, both halves of its key, and whether it may be kept."""
        _, offsets, data = words.buffers()
        ends = np.frombuffer(offsets, np.int64)[words.offset : words.offset + len(words) + 1]
        raw = np.zeros(int(ends[-1]) + KEY_BYTES + 1, np.uint8)
        raw[: ends[-1]] = np.frombuffer(data, np.uint8, int(ends[-1])) if data is not None else 0
        size, column = np.diff(ends), np.arange(KEY_BYTES + 1)
        key = np.where(column < size[:, None], raw[ends[:-1][:, None] + column], 0).astype(np.uint8)
        key[:, KEY_BYTES] = np.minimum(size, 255)
        low, high = key.view(np.uint64).T
        mixed = (low ^ (high * np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xFF51AFD7ED558CCD)
        mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0xC4CEB9FE1A85EC53)
        return (mixed >> self.shift).astype(np.int64), low, high, (size > 0) & (size <= KEY_BYTES)

    def ids(self, words: pa.LargeStringArray, encode: Callable[[pa.LargeStringArray], Ids]) -> Ids:
        """The ids of all words; ``encode`` is asked for those that are not kept, and may itself look words up here."""
        place, low, high, short = self.places(words)
        held = short & (self.low[place] == low) & (self.high[place] == high)
        kept, asked = np.flatnonzero(held), np.flatnonzero(~held)
        known, body = self.size[place[kept]], self.body[place[kept]]
        size, fresh = encode(words.take(pa.array(asked)))
        n = np.zeros(len(words), np.int64)
        n[kept], n[asked] = known, size
        start, first, out = np.cumsum(n) - n, np.cumsum(size) - size, np.zeros(int(n.sum()), np.uint32)
        _put(out, start[kept], body.ravel(), KEY_IDS * np.arange(len(kept)), n[kept])
        _put(out, start[asked], fresh, first, size)
        keep = np.flatnonzero(short[asked] & (size <= KEY_IDS))
        _, one = np.unique(place[asked[keep]], return_index=True)
        keep = keep[one]
        at, mine = place[asked[keep]], asked[keep]
        self.low[at], self.high[at], self.size[at] = low[mine], high[mine], size[keep]
        body = np.zeros(len(keep) * KEY_IDS, self.body.dtype)
        _put(body, KEY_IDS * np.arange(len(keep)), fresh, first[keep], size[keep])
        self.body[at] = body.reshape(-1, KEY_IDS)
        return n, out


class Encoder:
    """``ids(texts)`` equals ``encode(text, add_special_tokens=False).ids`` of the tokenizer in ``path`` for each text; it
    must drop white space, lower its letters and never join anything over white space (a byte-level word BPE).

    Texts are cut at ASCII white space and the different words of a part are looked up among those met before. Words of
    plain lower-case letters go through the tokenizer's merges together; all others, and texts that hold a special token,
    through the tokenizer itself.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        # the words stay with the process, which serves many tasks; this module's own names are new in each of them
        kept = sys.modules.setdefault("_tallyloom_llm_words", types.ModuleType("_tallyloom_llm_words")).__dict__
        if path not in kept:
            from tokenizers import Tokenizer

            tokenizer = Tokenizer.from_file(path)
            special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
            kept[path] = (tokenizer, WordMerges(tokenizer), special, WordCache(CACHE_LOG2, tokenizer.get_vocab_size()))
        self.tokenizer, self.merges, self.special, self.cache = kept[path]

    def _one(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=np.uint32).tobytes()

    def _each(self, words: pa.LargeStringArray) -> Ids:
        return _joined([self._one(w) if w else b"" for w in words.to_pylist()])

    def _plain(self, words: pa.LargeStringArray) -> Ids:
        return _joined(self.merges.ids(words.cast(pa.large_binary()).to_pylist()))

    def _encoded(self, words: pa.LargeStringArray) -> Ids:
        """Words that are not kept: plain ones are looked up once more without the marks behind them."""
        found = pc.extract_regex(words, LETTERS)
        plain = found.is_valid()
        letters, marks = (pc.struct_field(found.filter(plain), k).dictionary_encode() for k in (0, 1))
        (n, ids), (n_marks, mark_ids) = self.cache.ids(letters.dictionary, self._plain), self._each(marks.dictionary)
        n_other, others = self._each(words.filter(pc.invert(plain)))
        word, mark, is_plain = letters.indices.to_numpy(), marks.indices.to_numpy(), plain.to_numpy(zero_copy_only=False)
        size = np.zeros(len(words), np.int64)
        size[is_plain], size[~is_plain] = n[word] + n_marks[mark], n_other
        start, out = np.cumsum(size) - size, np.zeros(int(size.sum()), np.uint32)
        _put(out, start[is_plain], ids, (np.cumsum(n) - n)[word], n[word])
        _put(out, start[is_plain] + n[word], mark_ids, (np.cumsum(n_marks) - n_marks)[mark], n_marks[mark])
        _put(out, start[~is_plain], others, np.cumsum(n_other) - n_other, n_other)
        return size, out

    def ids(self, texts: list[str]) -> Iterator[np.ndarray]:
        """The ids of each text in turn; only a part of the texts is cut into words at a time."""
        at = 0
        while at < len(texts):
            part, size = [], 0
            while at < len(texts) and (size == 0 or size + len(texts[at]) <= BATCH_CHARS):
                part.append(texts[at])
                size += len(texts[at]) + 1
                at += 1
            yield from self._part(part)

    def _part(self, part: list[str]) -> Iterator[np.ndarray]:
        # lowering must not make a special token of what was none
        alone = {k for k, t in enumerate(part) if any(s in t or s in t.lower() for s in self.special)}
        low = pc.ascii_lower(pa.array(["" if k in alone else t for k, t in enumerate(part)], pa.large_string()))
        cut = pc.ascii_split_whitespace(low)
        # each different word of the part is looked up once; its places are numbers from then on
        coded = cut.flatten().dictionary_encode()
        size, flat = self.cache.ids(coded.dictionary, self._encoded)
        start, place = np.cumsum(size) - size, coded.indices.to_numpy()
        n = size[place]
        stop = np.concatenate(([0], np.cumsum(n)))
        whole = flat[np.repeat(start[place] - stop[:-1], n) + np.arange(stop[-1])]
        edges = stop[cut.offsets.to_numpy()].tolist()
        for k, text in enumerate(part):
            yield np.frombuffer(self._one(text), np.uint32) if k in alone else whole[edges[k] : edges[k + 1]]
