"""Language identification by word-first backoff.

A word that the model knows scores its log frequency in each language. Any other word is scored by character n-grams:
at each place the longest one that the model knows, so that the score falls back to shorter and shorter ones.
"""

from __future__ import annotations

import re
from array import array
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, fields

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import documents_of, held_out, written

#: At most about this many labelled documents of each language are learnt from (chosen by a hash of their id).
DOCS_PER_LANGUAGE = 4000
#: Words and n-grams that the model keeps, the most frequent of each language first; what is left out is what the
#: shorter n-grams are for.
WORDS_PER_LANGUAGE = 20_000
GRAMS_PER_LANGUAGE = 20_000
LONGEST = 4
#: Texts whose words are counted together in a task, which bounds its memory.
TOGETHER = 1000
#: Numbers (items times languages) that are laid out or remembered at a time.
CELLS = 4_000_000
UNKNOWN = "und"
LETTERS = re.compile(r"[^\W\d_]+")


def grams(word: str) -> Iterator[str]:
    """The n-grams of a word, its edges marked."""
    marked = f"<{word}>"
    for n in range(1, LONGEST + 1):
        for at in range(len(marked) - n + 1):
            yield marked[at : at + n]


@dataclass
class Frequencies:
    """A table of log frequencies that only holds the languages an item was seen in."""

    starts: np.ndarray  # of each row in the next two, and their end
    columns: np.ndarray
    values: np.ndarray
    n_words: int  # the rows before this one are words, the others n-grams
    absent: np.ndarray  # of a word and of an n-gram in the languages it was not seen in

    def __getitem__(self, rows: list[int] | np.ndarray) -> np.ndarray:
        rows = np.asarray(rows, dtype=np.int64)
        out = self.absent[(rows >= self.n_words).astype(np.int64)]
        first, sizes = self.starts[rows], self.starts[rows + 1] - self.starts[rows]
        at = np.repeat(first - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
        out[np.repeat(np.arange(len(rows)), sizes), self.columns[at]] = self.values[at]
        return out


@dataclass
class LanguageModel:
    languages: list[str]
    words: dict[str, int]  # rows of the table
    grams: dict[str, int]
    table: np.ndarray | Frequencies  # log frequencies, one column for each language
    floor: np.ndarray  # of a character that was never seen

    def __post_init__(self) -> None:
        self.unseen: dict[str, np.ndarray] = {}
        self.together = max(1, CELLS // max(1, len(self.languages)))  # rows that are laid out at a time

    def _backoff(self, words: list[str]) -> np.ndarray:
        """For each word the mean score of the longest known n-grams that end at each of its places."""
        rows, sizes, get = [], [], self.grams.get
        for word in words:
            marked = f"<{word}>"
            for end in range(1, len(marked) + 1):
                for start in range(max(0, end - LONGEST), end):
                    row = get(marked[start:end])
                    if row is not None:
                        rows.append(row)
                        break
                else:
                    rows.append(-1)
            sizes.append(len(marked))
        at = np.array(rows)
        places = np.repeat(np.asarray(self.floor, dtype=np.float64)[None], len(at), axis=0)
        places[at >= 0] = self.table[at[at >= 0]]
        starts = np.cumsum([0, *sizes[:-1]])
        return np.add.reduceat(places, starts, axis=0) / np.array(sizes)[:, None]

    def _remember(self, words: list[str]) -> None:
        """Scores of unknown words, in parts whose places fit in ``together`` rows (or of one word)."""
        part, size = [], 0
        for word in words:
            if part and size + len(word) + 2 > self.together:
                self.unseen.update(zip(part, self._backoff(part), strict=True))
                part, size = [], 0
            part.append(word)
            size += len(word) + 2
        if part:
            self.unseen.update(zip(part, self._backoff(part), strict=True))

    def score(self, text: str) -> tuple[str, float]:
        """The likeliest language and its share of the likelihood; the first by name of equally likely ones."""
        found = LETTERS.findall(text.lower())
        if not found or not self.languages:
            return UNKNOWN, 0.0
        total = np.zeros(len(self.languages))
        counts = Counter(found)
        known = [(r, n) for w, n in counts.items() if (r := self.words.get(w)) is not None]
        if known:
            for at in range(0, len(known), self.together):
                rows, times = zip(*known[at : at + self.together], strict=True)
                total += np.array(times) @ self.table[list(rows)]
        rest = [(w, n) for w, n in counts.items() if w not in self.words]
        for at in range(0, len(rest), self.together):
            part = rest[at : at + self.together]
            if len(self.unseen) > min(200_000, self.together):  # words that turned up once need not stay for ever
                self.unseen.clear()
            self._remember([w for w, _ in part if w not in self.unseen])
            total += np.array([n for _, n in part]) @ np.array([self.unseen[w] for w, _ in part])
        odds = np.exp(total - total.max())
        return self.languages[int(total.argmax())], float(odds.max() / odds.sum())


def training_sample(docs: DataFrame, bound: int = DOCS_PER_LANGUAGE) -> tuple[DataFrame, list[str]]:
    """``(text, lang)`` of at most about ``bound`` documents of each language, and the languages."""
    learnt = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    learnt = learnt.where("lang is not null").where(~held_out())
    sizes = {r["lang"]: r["n"] for r in learnt.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    shares = {lang: int(1_000_000 * bound / n) for lang, n in sizes.items() if n > bound}
    share = F.coalesce(_looked_up(shares, F.col("lang"), "int"), F.lit(1_000_000))
    return learnt.where("text is not null").where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < share).select("text", "lang"), sorted(sizes)


def _looked_up(values: dict[str, int | str], key: Column, kind: str) -> Column:
    """The value of a key, null for other keys."""
    if not values:
        return F.lit(None).cast(kind)
    return F.try_element_at(F.map_from_arrays(F.array(*map(F.lit, values)), F.array(*map(F.lit, values.values()))), key).cast(kind)


def _most_frequent(pivoted: DataFrame, kind: str, size: int, sizes: dict[str, int]) -> DataFrame:
    """The items that are among the ``size`` most frequent ones of any language, whatever other languages there are."""
    of_kind = pivoted.where(F.col("kind") == kind)
    least: dict[str, int] = {}  # the last item of each language that has more
    last: dict[str, str] = {}
    for lang in (lang for lang, n in sizes.items() if n > size):
        n = F.col("by").getItem(lang)
        top = of_kind.where(n.isNotNull()).select("item", n.alias("n")).orderBy(F.desc("n"), "item").limit(size)
        row = top.orderBy("n", F.desc("item")).first()
        least[lang], last[lang] = (row["n"], row["item"]) if row else (2**62, "")

    def among(entry: Column) -> Column:
        n, item = _looked_up(least, entry["key"], "long"), _looked_up(last, entry["key"], "string")
        return n.isNull() | (entry["value"] > n) | ((entry["value"] == n) & (F.col("item") <= item))

    return of_kind.where(F.exists(F.map_entries("by"), among)).select("item", "by")


def fit(docs: DataFrame, bound: int = DOCS_PER_LANGUAGE, words: int = WORDS_PER_LANGUAGE, n_grams: int = GRAMS_PER_LANGUAGE) -> LanguageModel:
    """Learn from ``docs (doc_id, text, lang)``: rows outside the held-out fold with a language."""
    sample, languages = training_sample(docs, bound)
    column = {lang: k for k, lang in enumerate(languages)}

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in (f.iloc[at : at + TOGETHER] for f in frames for at in range(0, len(f), TOGETHER)):
            for lang, texts in frame.groupby("lang")["text"]:
                seen = Counter(w for text in texts for w in LETTERS.findall(text.lower()))
                parts: Counter = Counter()
                for word, n in seen.items():
                    for gram in grams(word):
                        parts[gram] += n
                for kind, counts in (("w", seen), ("g", parts)):
                    yield pd.DataFrame({"kind": kind, "lang": lang, "item": list(counts), "n": list(counts.values())})

    counts = sample.mapInPandas(count, "kind string, lang string, item string, n long").groupBy("kind", "lang", "item").agg(F.sum("n").alias("n"))
    pivoted = written(counts.groupBy("kind", "item").agg(F.map_from_entries(F.collect_list(F.struct("lang", "n"))).alias("by")), "counts")
    totals = {kind: np.zeros(len(languages)) for kind in "wg"}
    items: dict[str, dict[str, int]] = {kind: {} for kind in "wg"}  # of each language
    for r in pivoted.select("kind", F.explode("by").alias("lang", "n")).groupBy("kind", "lang").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("items")).collect():
        totals[r["kind"]][column[r["lang"]]] = r["n"]
        items[r["kind"]][r["lang"]] = r["items"]
    where: dict[str, dict[str, int]] = {"w": {}, "g": {}}
    sizes, columns, values, absent = array("q", [0]), [], [], []
    for kind, size in (("w", words), ("g", n_grams)):
        seen_in, times = array("i"), array("q")
        for r in _most_frequent(pivoted, kind, size, items[kind]).toLocalIterator():
            where[kind][r["item"]] = len(sizes) - 1
            sizes.append(len(r["by"]))
            seen_in.extend(column[lang] for lang in r["by"])
            times.extend(r["by"].values())
        at, whole = np.array(seen_in, dtype=np.int32), totals[kind] + 0.5 * max(1, len(where[kind]))
        columns.append(at)
        values.append(np.log((np.array(times, dtype=np.int64) + 0.5) / whole[at]).astype(np.float32))
        absent.append(np.log(0.5 / whole))
    table = Frequencies(np.cumsum(np.array(sizes, dtype=np.int64)), np.concatenate(columns), np.concatenate(values), len(where["w"]), np.array(absent, dtype=np.float32))
    return LanguageModel(languages, where["w"], where["g"], table, absent[1])


def _scorer(model: Broadcast):
    @F.pandas_udf("struct<lang: string, score: double>")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        parts = dict(model.value)
        if isinstance(parts["table"], dict):
            parts["table"] = Frequencies(**parts["table"])
        known = LanguageModel(**parts)
        for part in texts:
            yield pd.DataFrame([known.score(x or "") for x in part], columns=["lang", "score"])

    return score


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)`` of every row of ``docs (doc_id, text)``, from the whole text alone.

    Texts that are null or have no letter are ``und`` with score 0, as is everything if nothing could be learnt; ties go to
    the first language by name. Repeated rows are each judged; an empty table gives no rows; further columns are ignored.
    """
    # plain containers and arrays, as a broadcast is read where this package may not be installed
    plain = lambda x: {f.name: getattr(x, f.name) for f in fields(x)}
    shared = plain(model)
    if isinstance(model.table, Frequencies):
        shared["table"] = plain(model.table)
    score = _scorer(docs.sparkSession.sparkContext.broadcast(shared))
    scored = documents_of(docs).select("doc_id", held_out().alias("held_out"), score("text").alias("out"))
    return scored.select("doc_id", "held_out", F.col("out.lang").alias("lang_pred"), F.col("out.score").alias("score"))
