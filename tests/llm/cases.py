"""Small tables that hold the awkward cases: nulls, empty and long texts, ties, repeated rows, clashing extra columns."""

from __future__ import annotations

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp string, `shard` string, row string, score string, at string"
PASSAGE = " ".join(f"word{i}" for i in range(60))


def documents(spark):
    rows = [
        (1, "The cat sat on the mat. " * 20),
        (2, "The cat sat on the mat. " * 20),
        (3, None),
        (4, ""),
        (5, "   \t\n"),
        (6, "short"),
        (7, "é" * 40 + " ß " + "ü" * 30),
        (8, "é" * 40 + " ß " + "ü" * 30 + " more"),
        (9, "intro one two three\n" + PASSAGE + "\nend of nine"),
        (10, "another begin\n" + PASSAGE.upper() + "\nend of ten"),
        (11, "begin here\n" + PASSAGE + "\nfinish"),
        (11, "begin here\n" + PASSAGE + "\nfinish"),
        (None, "begin here\n" + PASSAGE + "\nno id"),
        (None, None),
        (12, "a" * 5000),
        (13, "zero \x00 byte " * 12),
        (14, "zero \x00 byte " * 12),
        (15, "long " + " ".join(f"w{i % 977}" for i in range(30000))),
        (-5, "negative id " + PASSAGE),
    ]
    return spark.createDataFrame([(i, t, "en", "s", 1, "x", "y", "z", "q", "r") for i, t in rows], SCHEMA)


def empty(df):
    return df.where("false")
