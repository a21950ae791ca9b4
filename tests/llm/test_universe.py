"""The n-gram Jaccard join against all pairs, on small tables."""

import random
import re

import numpy as np
import pytest
from cases import SCHEMA, documents, empty

from tallyloom.llm import universe


def grams(text, width=4):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in text or ""))
    if len(w) < width:
        return {tuple(w)} if w else set()
    return {tuple(w[k : k + width]) for k in range(len(w) - width + 1)}


def plain(rows, width=4, percent=85):
    sets = [grams(t, width) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for k, (d, _) in enumerate(rows):
        r = find(k)
        if d is not None:
            least[r] = min(least.get(r, d), d)
    return [(d, len(sets[k]), least.get(find(k))) for k, (d, _) in enumerate(rows)]


def key(row):
    return [(x is None, str(x)) for x in row]


def near_copies(seed, n):
    """Families of texts that differ in a few words, near and beyond the threshold, over a common passage."""
    rng, rows = random.Random(seed), []
    passage = [f"common{k}" for k in range(14)]
    for k in range(n):
        if not rows or rng.random() < 0.4:
            w = [f"v{rng.randrange(400)}" for _ in range(rng.choice([2, 5, 9, 12, 20, 40, 90]))]
            w = passage * rng.randrange(2) + w
        else:
            w = rng.choice(rows)[1].split()
            for _ in range(rng.randrange(4)):
                at = rng.randrange(len(w) + 1)
                w = rng.choice([w[:at] + w[at + 1 :], w[:at] + ["new"] + w[at:], w[:at] + ["X"] + w[at + 1 :]]) or ["w"]
        rows.append((k, " ".join(w)))
    return rows


@pytest.mark.parametrize(("width", "percent"), [(4, 85), (1, 60), (2, 100)])
def test_components_agree_with_all_pairs(spark, width, percent, monkeypatch):
    monkeypatch.setattr(universe, "TOGETHER", 16)
    rows = near_copies(width, 220)
    got = universe.similar_sets(spark.createDataFrame(rows, "doc_id long, text string"), width, percent).collect()
    assert sorted(map(tuple, got)) == sorted(plain(rows, width, percent))


def test_odd_rows(spark):
    docs = documents(spark)
    got = [tuple(r) for r in universe.similar_sets(docs).collect()]
    want = plain([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert sorted(got, key=key) == sorted(want, key=key)
    assert universe.similar_sets(empty(docs)).count() == 0


def test_clashing_ids_and_digests(spark, monkeypatch):
    """Different texts of one id stay apart, and a clash of the first digest is noticed."""
    words = lambda a: " ".join(f"{a}{k}" for k in range(30))
    rows = [(1, words("a")), (1, words("b")), (None, words("b") + " x"), (2, words("c")), (0, words("a") + " y")]
    frame = spark.createDataFrame(rows, SCHEMA.split(", lang")[0])
    got = [tuple(r) for r in universe.similar_sets(frame).collect()]
    assert sorted(got, key=key) == sorted(plain(rows), key=key)


def test_hashes_of_many_texts_at_once():
    texts = [f"  word{k} Two\tthree\n{k % 3} " * (k % 7) + "é end" * (k % 2) for k in range(300)]
    hashed = universe.Hasher(4, 0)
    assert [len(g) for at in range(0, 300, 64) for g in hashed(texts[at : at + 64])] == [len(grams(t)) for t in texts]
    assert all(np.array_equal(a, b) for a, b in zip(hashed(texts), [hashed([t.upper().replace("É", "é")])[0] for t in texts], strict=True))


def test_every_similar_pair_meets():
    """Any two sets within the similarity share a key that one indexes and the larger one searches, whatever the costs say."""
    rng, scheme = np.random.default_rng(4), universe.Scheme(85)
    for trial in range(400):
        n = int(rng.choice([6, 7, 11, 12, 30, 80, 300]))
        a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        gone = int(rng.integers(0, n // 6 + 2))
        b = np.unique(np.concatenate((a[gone:], rng.integers(0, 2**63, int(rng.integers(0, n // 6 + 2))).astype(np.uint64))))
        both = len(np.intersect1d(a, b))
        if not len(b) or 100 * both < 85 * (len(a) + len(b) - both):
            continue
        costs = rng.random(1 << universe.CELL_BITS).astype(np.float32)
        small, large = sorted((a, b), key=len)
        keys = [dict(zip(*map(list, universe.rows_of(x, scheme, costs)), strict=True)) for x in (small, large)]
        same = np.array_equal(a, b)
        assert same or any(keys[0][k] & universe.INDEX and part & universe.PROBE for k, part in keys[1].items() if k in keys[0])
