"""Periodic runs and ranked search against plain versions, on awkward rows."""

import hashlib
import math
import random
import re
import zlib
from fractions import Fraction

import pytest
from cases import SCHEMA, documents, empty

from tallyloom.llm import periodic, presence, queries


def plain_runs(w, least=6, times=4):
    out = []
    for q in range(1, len(w) // times + 1):
        i = 0
        while i + q < len(w):
            s = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            n = i + q - s
            if i > s and n >= max(least, times * q):
                part = w[s : s + n]
                if not any(part[p:] == part[:-p] for p in range(1, q)):
                    out.append((s, n, q))
            i += i == s
    return sorted(out)


def test_runs_of_random_words():
    rng = random.Random(3)
    for _ in range(1500):
        n, k = rng.randrange(70), rng.choice([1, 2, 2, 3, 5])
        w = [rng.randrange(k) for _ in range(n)]
        if n > 4 and rng.random() < 0.6:
            a, p = rng.randrange(n), rng.randrange(1, 9)
            w = w[:a] + [w[a + (i - a) % p] if a + (i - a) % p < n else 0 for i in range(a, n)]
        least, times = rng.choice([(6, 4), (6, 4), (4, 2), (1, 3)])
        assert periodic.runs_of(w, least, times) == plain_runs(w, least, times)


def plain_row(doc_id, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(w), zlib.crc32(("" if doc_id is None else str(doc_id)).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = w[:a] + [w[a + (i - a) % p] for i in range(a, n)]
    runs = plain_runs(w)
    gone = {k for s, m, q in runs for k in range(s + q, s + m)}
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None, None, None)
    milli = 1000 * best[1] // best[2] if runs else None
    kept = " ".join(x for k, x in enumerate(w) if k not in gone)
    return (doc_id, len(runs), *best, milli, sha("".join(f"{s},{m},{q}\n" for s, m, q in runs)), sha(kept))


def as_table(spark, df, folder, name):
    df.write.mode("overwrite").parquet(f"{folder}/{name}.parquet")


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choice("ab") if i % 3 else rng.choice("abcdefghij") for _ in range(rng.randrange(40))), "en", "s", 1, "x", "y", "z", "q", "r") for i in range(100, 260)]
    short = documents(spark).where("text is null or length(text) < 3000")
    return short.unionByName(spark.createDataFrame(rows, SCHEMA))


def key(row):
    return [(x is None, str(x)) for x in row]


def test_run_query_agrees_with_plain_version(spark, docs, tmp_path):
    as_table(spark, docs, tmp_path, "documents")
    got = [tuple(r) for r in queries.op12_periodic_run_detection(spark, str(tmp_path)).collect()]
    want = [plain_row(r["doc_id"], r["text"]) for r in docs.collect()]
    assert sorted(got, key=key) == sorted(want, key=key)
    assert any(r[1] > 1 for r in want)


def test_runs_of_odd_rows(spark):
    found = periodic.periodic_runs(documents(spark))
    assert found.count() == documents(spark).count()
    assert {r["text"] for r in found.where("doc_id in (3, 4, 5)").collect()} == {""}
    whole = found.where("doc_id = 1").first()
    assert [tuple(r) for r in whole["runs"]] == [(0, 120, 6)] and whole["text"] == "The cat sat on the mat."
    assert periodic.periodic_runs(empty(documents(spark))).count() == 0


def plain_ranks(docs, items, k):
    lower = lambda t: "".join(c.lower() if c.isascii() else c for c in t or "")
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower(t))
    held = [(d, cut(t)) for d, t in docs]
    held = [(d, w) for d, w in held if w]
    n_docs, n_all, out = len(held), sum(len(w) for _, w in held), []
    for item_id, text in items:
        scored = []
        for d, w in held:
            score, m = 0, 50 + 50 * len(w) * n_docs // n_all
            for t in set(cut(text)):
                df, tf = sum(t in x for _, x in held), w.count(t)
                if tf:
                    score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1))) * (10**9 * tf // (1000 * tf + 20 * m))
            if score > 0:
                scored.append((-score, d is None, d))
        out += [(item_id, rank, d, -s) for rank, (s, _, d) in enumerate(sorted(scored)[:k], 1)]
    return out


def items_of(spark):
    many = " ".join(f"w{i}" for i in range(150))
    rows = [(1, "the CAT sat, word7 word8"), (2, None), (3, ""), (4, "é" * 40 + " Ü and begin"), (4, "begin here"), (None, "short a b c"), (6, many), (7, "unheard")]
    return spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "item_id long, text string, item string, score int")


@pytest.mark.parametrize("k", [1, 3, 50])
def test_ranks_agree_with_plain_version(spark, docs, k, monkeypatch):
    monkeypatch.setattr(presence, "SHARD", 16)
    all_docs = docs.unionByName(documents(spark).where("doc_id = 15"))
    got = [tuple(r) for r in presence.ranked(all_docs, items_of(spark), k).collect()]
    want = plain_ranks([(r["doc_id"], r["text"]) for r in all_docs.collect()], [(r["item_id"], r["text"]) for r in items_of(spark).collect()], k)
    assert sorted(got, key=key) == sorted(want, key=key)


def test_blocks_of_items_give_the_same_ranks(spark, docs, monkeypatch):
    want = sorted((tuple(r) for r in presence.ranked(docs, items_of(spark), 5).collect()), key=key)
    monkeypatch.setattr(presence, "BLOCK_TERMS", 4)
    assert sorted((tuple(r) for r in presence.ranked(docs, items_of(spark), 5).collect()), key=key) == want


def test_ranks_of_nothing(spark, docs):
    assert presence.ranked(empty(docs), items_of(spark)).count() == 0
    assert presence.ranked(docs, empty(items_of(spark))).count() == 0
