"""Substring dedup by hashing lines and the sentences in them: equal normalised units are found by their digests, the earliest
occurrence stays."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import documents_of, written

#: Sentences of fewer words are left alone inside a line: the shortest ("Yes.") repeat by chance. Lines have no such bound.
SENTENCE_WORDS = 5
NO_ID = 2**63 - 1  # rows without an id rank behind all others
TOGETHER = 1000

#: A sentence with the blanks behind it; what follows the last mark is one too.
SENTENCE = re.compile("[^.!?。！？]*(?:[.!?。！？]+[ \t\r]*|$)")
BLANKS = re.compile("[ \t\r]+")
_UNSPACED = "฀-๿぀-ヿ㐀-䶿一-鿿豈-﫿"
#: Words: in scripts without blanks every letter counts as one.
WORD = re.compile(f"[{_UNSPACED}]|[^ {_UNSPACED}]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def normalised(unit: str) -> str:
    """A-Z in lower case, runs of blanks as one space, none at the ends."""
    low = unit.lower() if unit.isascii() else unit.translate(_LOWER)
    return BLANKS.sub(" ", low).strip(" ")


def _n_words(norm: str) -> int:
    return norm.count(" ") + 1 if norm.isascii() else len(WORD.findall(norm))


def sentences(line: str) -> list[str]:
    """The parts of a line, which together are the line."""
    return [s for s in SENTENCE.findall(line) if s]


def units(text: str, least_words: int = SENTENCE_WORDS) -> Iterator[tuple[int, str]]:
    """``(place, normalised unit)``: lines that are not blank, and their sentences of ``least_words`` or more words where a line
    has several. The place of a line is twice its offset in characters, that of a sentence one more."""
    start = 0
    for line in text.split("\n"):
        norm = normalised(line)
        if norm:
            yield 2 * start, norm
            parts = sentences(line)
            if len(parts) > 1:
                at = start
                for part in parts:
                    norm = normalised(part)
                    if norm and _n_words(norm) >= least_words:
                        yield 2 * at + 1, norm
                    at += len(part)
        start += len(line) + 1


def _without(texts: pd.Series, removed: pd.Series) -> pd.DataFrame:
    """Texts without the units at the given places, their number and the offsets of what went."""
    out = []
    for text, at in zip(texts, removed, strict=True):
        if at is None or not len(at):
            out.append((text, 0, "", 0))
            continue
        gone, kept, spans, start = set(at), [], [], 0
        for line in text.split("\n"):
            if 2 * start in gone:
                spans.append((start, start + len(line)))
            else:
                rest, place = [], start
                for part in sentences(line):
                    if 2 * place + 1 in gone:
                        spans.append((place, place + len(part)))
                    else:
                        rest.append(part)
                    place += len(part)
                kept.append("".join(rest))
            start += len(line) + 1
        out.append(("\n".join(kept), len(spans), ",".join(f"{a}-{b}" for a, b in spans), sum(b - a for a, b in spans)))
    return pd.DataFrame(out, columns=["kept", "n", "spans", "n_chars"])


def _unit_digests(rows: DataFrame, least_words: int) -> DataFrame:
    """``(digest, id, at, row)`` of every unit."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, len(batch), TOGETHER):
                part = batch.slice(first, TOGETHER)
                digests, places, sizes = [], [], []
                for text in part.column(2).to_pylist():
                    before = len(digests)
                    for at, norm in units(text, least_words):
                        digests.append(xxhash.xxh3_128_digest(norm.encode()))
                        places.append(at)
                    sizes.append(len(digests) - before)
                owner = np.repeat(np.arange(len(part)), sizes)
                columns = [pa.array(digests, pa.binary()), part.column(0).take(pa.array(owner)), pa.array(places, pa.int64()), part.column(1).take(pa.array(owner))]
                yield pa.RecordBatch.from_arrays(columns, ["digest", "id", "at", "row"])

    return rows.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), "row", "text").mapInArrow(cut, "digest binary, id long, at long, row long")


def without_repeated_lines(docs: DataFrame, least_words: int = SENTENCE_WORDS) -> DataFrame:
    """``(doc_id, n_lines, n_removed, n_chars_removed, removed_spans, text)`` of every row of ``docs (doc_id, text)``.

    Units are lines (cut at line feeds, normalised, not blank) of any length, and within a line its sentences of
    ``least_words`` or more words; in scripts without blanks each letter is a word. Of every unit the occurrence that comes first by
    doc_id, then by place in its text, stays, and all later ones go, a line with its line feed. ``n_removed`` counts removed lines
    and removed sentences of other lines; ``removed_spans`` has their offsets in the original text as ``start-stop`` in
    characters, joined by commas. Null texts count as empty. Rows without an id rank last. Rows that repeat a doc_id rank
    by a hash of their texts; wholly equal rows are one document and lose the same units. Empty tables give no rows;
    further columns are ignored. Units are told apart by digests of 128 bits, made once and written.
    """
    rows = documents_of(docs).withColumn("row", F.xxhash64("text"))
    found = written(_unit_digests(rows, least_words), "units").select("digest", F.struct("id", "at", "row").alias("place"))
    first = found.groupBy("digest").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    # a table of its own, so that both sides of the join are dealt by digest and adaptive execution can split a hot line
    first = written(first.select("digest", "first"), "firsts")
    gone = found.join(first, "digest").where("place > first").select("place.*")
    removed = gone.groupBy("id", "row").agg(F.collect_set("at").alias("at"))
    joined = rows.join(removed, (F.coalesce(rows.doc_id, F.lit(NO_ID)) == removed.id) & (rows.row == removed.row), "left")
    cut = F.pandas_udf(_without, "struct<kept: string, n: long, spans: string, n_chars: long>")("text", "at")
    done = joined.select("doc_id", F.size(F.split("text", "\n", -1)).cast("long").alias("n_lines"), cut.alias("out"))
    return done.select("doc_id", "n_lines", F.col("out.n").alias("n_removed"), F.col("out.n_chars").alias("n_chars_removed"), F.col("out.spans").alias("removed_spans"), F.col("out.kept").alias("text"))
