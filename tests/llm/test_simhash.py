import numpy as np
import xxhash
from cases import documents, empty

from tallyloom.llm import simhash


def slow_fingerprint(text, width=4):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words, word = [], ""
    for c in low + " ":
        if c in " \t\n\x0b\x0c\r":
            words, word = (words + [word] if word else words), ""
        else:
            word += c
    if not words:
        return 0
    shingles = [" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(fps, distance):
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= distance:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def test_fingerprints_and_components_against_brute_force(spark):
    docs = documents(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    fps = [slow_fingerprint(t) for _, t in rows]
    group = components(fps, 4)
    expected = []
    for k, (i, _) in enumerate(rows):
        ids = [rows[m][0] for m in range(len(rows)) if group[m] == group[k] and rows[m][0] is not None]
        expected.append((i, f"{fps[k]:016x}", min(ids) if ids else None))
    got = [tuple(r) for r in simhash.near_duplicates(docs).collect()]
    key = lambda r: tuple(map(str, r))
    assert sorted(got, key=key) == sorted(expected, key=key)


def test_crowded_buckets_are_tiled(spark, monkeypatch):
    monkeypatch.setattr(simhash, "TILE", 16)
    rng = np.random.default_rng(3)
    base = int(rng.integers(0, 2**63))
    fps = sorted({base ^ (1 << int(a)) ^ (1 << int(b)) ^ (1 << int(c)) for a, b, c in rng.integers(0, 63, (150, 3))} | {int(x) for x in rng.integers(0, 2**63, 50)})
    df = spark.createDataFrame([(x,) for x in fps], "fp long")
    edges = [(r.a, r.b) for r in simhash.links(df, 4).collect()]
    assert all((a ^ b).bit_count() <= 4 for a, b in edges)
    place, root = {x: i for i, x in enumerate(fps)}, list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = find(place[a]), find(place[b])
        root[max(x, y)] = min(x, y)
    assert [find(i) for i in range(len(fps))] == components(fps, 4)
    assert len(edges) < len(fps) ** 2 / 2


def test_one_of_each_keeps_columns_and_smallest_ids(spark):
    docs = documents(spark)
    kept = simhash.one_of_each(docs)
    ids = [r.doc_id for r in kept.collect()]
    assert kept.columns == docs.columns and 1 in ids and 2 not in ids and 3 in ids and 4 not in ids and ids.count(11) <= 2


def test_columns_named_like_its_own(spark):
    docs = documents(spark)
    more = docs.selectExpr("*", "'mine' AS kept_id", "'mine' AS KEPT_ID_", "'mine' AS component_id")
    kept = simhash.one_of_each(more)
    assert kept.columns == more.columns and kept.count() == simhash.one_of_each(docs).count()


def test_empty_table(spark):
    assert simhash.near_duplicates(empty(documents(spark))).count() == 0
