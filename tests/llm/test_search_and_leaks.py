import hashlib
import math
import random

import numpy as np
import pytest
from cases import documents, empty

from tallyloom.llm import decontaminate, lines, maxscore


def overlaps(text, item):
    """The rule, at every offset and every window."""
    n = len(item)
    window = min(n, 13)
    for offset in range(1 - n, len(text)):
        same = [0 <= offset + k < len(text) and text[offset + k] == item[k] for k in range(n)]
        if any(sum(same[s : s + window]) >= 0.8 * window - 1e-9 for s in range(n - window + 1)):
            return True
    return False


def test_every_overlap_is_found(spark):
    rng = random.Random(5)
    vocabulary = [f"v{k}" for k in range(12)]
    items = [[rng.choice(vocabulary) for _ in range(n)] for n in (3, 5, 6, 7, 9, 10, 11, 12, 13, 20, 45)]
    texts = []
    for _ in range(250):
        item = rng.choice(items[1:])
        part = item[rng.randrange(max(1, len(item) - 13)) :][: rng.randrange(4, 20)]
        part = [rng.choice(vocabulary) if rng.random() < 0.2 else w for w in part]
        texts.append([rng.choice(vocabulary) for _ in range(rng.randrange(6))] + part + [f"x{rng.random()}" for _ in range(3)])
    rows = [(k, " ".join(t)) for k, t in enumerate(texts)]
    docs, bench = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(k, " ".join(i)) for k, i in enumerate(items)], "item_id long, text string")
    got = {r.doc_id: r.contaminated for r in decontaminate.flagged(docs, bench).collect()}
    expected = {k: any(overlaps(t, i) for i in items if len(i) >= 5) for k, t in enumerate(texts)}
    assert got == expected and 20 < sum(expected.values()) < 250


def test_many_blocks_give_the_same(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    whole = {r.doc_id: r.contaminated for r in decontaminate.flagged(docs, bench).collect()}
    monkeypatch.setattr(decontaminate, "BLOCK_TOKENS", 60)
    assert {r.doc_id: r.contaminated for r in decontaminate.flagged(docs, bench).collect()} == whole
    assert 0 < sum(whole.values()) < len(whole) / 2


def test_leaks_and_odd_rows(spark):
    docs = documents(spark)
    passage = " ".join(f"word{i}" for i in range(10, 40))
    bench = spark.createDataFrame([(1, passage, "x"), (1, passage, "y"), (2, None, "z"), (3, "", ""), (4, "the", ""), (None, "short one here", "")], "item_id long, text string, doc_id string")
    got = [(r.doc_id, r.contaminated) for r in decontaminate.flagged(docs, bench).collect()]
    assert len(got) == docs.count()
    assert {i for i, c in got if c and i is not None} == {9, 10, 11, -5}
    kept = decontaminate.without_contaminated(docs, bench)
    assert kept.columns == docs.columns and kept.count() == docs.count() - sum(c for _, c in got)
    assert not any(r.contaminated for r in decontaminate.flagged(docs, empty(bench)).collect())
    assert decontaminate.flagged(empty(docs), bench).count() == 0


def brute_top(rows, k, every):
    whole = [(i, np.floor(1024 * np.array(x, dtype=float)).astype(int)) for i, x in rows if i is not None and x is not None and all(e is not None and np.isfinite(e) for e in x)]
    out = []
    for q, v in whole:
        if q % every == 0:
            scores = sorted((-int(v @ w), i) for i, w in whole if i != q and len(w) == len(v))
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores[:k])]
    return sorted(out)


@pytest.mark.parametrize("shard, block, queries", [(8192, 1024, 2048), (40, 16, 3)])
def test_top_k_against_brute_force(spark, monkeypatch, shard, block, queries):
    monkeypatch.setattr(maxscore, "SHARD", shard)
    monkeypatch.setattr(maxscore, "BLOCK", block)
    monkeypatch.setattr(maxscore, "QUERIES", queries)
    rng = np.random.default_rng(6)
    # few different values give many ties
    rows = [(int(i), (rng.integers(-2, 3, 8) / 4).tolist()) for i in rng.permutation(300)]
    rows += [(1000, None), (1001, [None] * 8), (1002, [float("nan")] * 8), (1010, [float("inf")] + [0.0] * 7), (None, [1.0] * 8), (2000, []), (3000, [0.5, 0.25])]
    df = spark.createDataFrame([(i, x, 1, "clash") for i, x in rows], "vec_id long, embedding array<double>, rank int, score string")
    got = sorted(tuple(r) for r in maxscore.top_k(df, k=5, every=10).collect())
    assert got == brute_top(rows, 5, 10)
    assert maxscore.top_k(empty(df)).count() == 0


def test_fewer_candidates_than_ranks(spark):
    df = spark.createDataFrame([(0, [1.0]), (1, [2.0]), (2, [-1.0])], "vec_id long, embedding array<float>")
    assert sorted(tuple(r) for r in maxscore.top_k(df, k=10, every=100).collect()) == [(0, 1, 1, 1024 * 2048), (0, 2, 2, -1024 * 1024)]


@pytest.mark.parametrize("size", [65_536, 900_000])
def test_scores_beyond_doubles_are_exact(spark, size):
    rng = random.Random(8)
    rows = [(i, [rng.choice((-1, 1)) * (size + rng.randrange(4096) / 1024) for _ in range(8)]) for i in range(60)]
    rows += [(100 + i, [x / 2**20 for x in v]) for i, v in rows[:20]]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    whole = {i: [math.floor(1024 * x) for x in v] for i, v in rows}
    expected = []
    for q in (i for i in whole if i % 10 == 0):
        scores = sorted((-sum(a * b for a, b in zip(whole[q], v, strict=True)), i) for i, v in whole.items() if i != q)
        expected += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores[:5])]
    assert max(s for *_, s in expected) > 2**53
    assert sorted(tuple(r) for r in maxscore.top_k(df, k=5, every=10).collect()) == sorted(expected)


def test_equal_rows_are_counted_first(spark):
    df = spark.createDataFrame([(0, [1.0])] * 30 + [(1, [3.0])] * 40 + [(2, [5.0])], "vec_id long, embedding array<double>")
    got = sorted((r.rank, r.vec_id) for r in maxscore.top_k(df, k=10, every=100).collect())
    assert got == [(1, 2)] + [(r, 1) for r in range(2, 11)]


def plain_units(text):
    """Offsets, whether a sentence, the text and the normalised text of every unit, cut character by character."""
    low = {c: c + 32 for c in range(65, 91)}
    norm = lambda u: " ".join(x for x in u.translate(low).replace("\t", " ").replace("\r", " ").split(" ") if x)
    out, start = [], 0
    for line in text.split("\n"):
        if norm(line):
            out.append((start, 0, line, norm(line)))
        cuts = [0]
        for k in range(1, len(line)):
            ended = line[:k].rstrip(" \t\r")
            if ended and ended[-1] in ".!?。！？" and line[k] not in " \t\r.!?。！？" or line[k - 1] in " \t\r" and ended and ended[-1] in ".!?。！？" and line[k] not in " \t\r":
                cuts.append(k)
        parts = [line[a:b] for a, b in zip(cuts, [*cuts[1:], len(line)], strict=True) if line[a:b]]
        if len(parts) > 1:
            for a, part in zip(cuts, parts, strict=True):
                n = sum(1 for k, c in enumerate(norm(part)) if c >= "\u0e00" and ("\u0e00" <= c <= "\u0e7f" or "\u3040" <= c <= "\u30ff" or "\u4e00" <= c <= "\u9fff"))
                if (n or len(norm(part).split())) >= 5:
                    out.append((start + a, 1, part, norm(part)))
        start += len(line) + 1
    return out


def test_units_against_brute_force(spark):
    more = [
        (20, "A first sentence of six words. Then another one with seven words! No. 版权所有。翻印必究，违者必追。"), (21, "x. then another  ONE with seven words! 翻印必究，违者必追。 end"),
        (22, "a first sentence of six words.\nNo.\n 3.14 is a number of this line .. and so it goes on"), (23, "No.\nand so it goes on\n A FIRST sentence of six words. again"), (24, "\n\n.\n . \n"),
    ]
    docs = documents(spark).unionByName(spark.createDataFrame([(i, t, "en", "s", 1, "x", "y", "z", "q", "r") for i, t in more], documents(spark).schema))
    rows = {(lines.NO_ID if r.doc_id is None else r.doc_id, r.h): r.t for r in docs.selectExpr("doc_id", "coalesce(text, '') t", "xxhash64(coalesce(text, '')) h").collect()}
    placed = sorted(((i, 2 * at + kind, h), norm) for (i, h), t in rows.items() for at, kind, _, norm in plain_units(t))
    first, gone = {}, set()
    for place, norm in placed:
        if first.setdefault(norm, place) != place:
            gone.add(place)
    expected = {}
    for (i, h), t in rows.items():
        cut = [(at, at + len(u), kind) for at, kind, u, _ in plain_units(t) if (i, 2 * at + kind, h) in gone]
        whole = [(a, b) for a, b, kind in cut if kind == 0]
        inner = [(a, b) for a, b, kind in cut if kind == 1 and not any(x <= a and b <= y for x, y in whole)]
        spans = sorted(whole + inner)
        dropped = {k for a, b in spans for k in range(a, b)}
        kept, start = [], 0
        for line in t.split("\n"):
            if (start, start + len(line)) not in whole:
                kept.append("".join(c for k, c in enumerate(line) if start + k not in dropped))
            start += len(line) + 1
        expected.setdefault(i, []).append(("\n".join(kept), ",".join(f"{a}-{b}" for a, b in spans), len(spans)))
    out = lines.without_repeated_lines(docs)
    assert out.count() == docs.count()
    for r in out.collect():
        assert (r.text, r.removed_spans, r.n_removed) in expected[lines.NO_ID if r.doc_id is None else r.doc_id]
    text = {r.doc_id: r.text for r in out.collect()}
    assert text[21] == "x. end" and text[23] == "again" and text[22].startswith("\n") is False
    assert lines.without_repeated_lines(empty(docs)).count() == 0


def test_lines_without_a_floor(spark):
    texts = {1: "All rights reserved.\n\n版权所有,翻印必究\nonly here", 2: "x\nall  rights reserved.\n \n版权所有,翻印必究", 3: "\nX\n\ny"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    out = {r.doc_id: r for r in lines.without_repeated_lines(docs).collect()}
    assert {k: r.text for k, r in out.items()} == {1: texts[1], 2: "x\n ", 3: "\n\ny"}
    assert [(out[k].n_removed, out[k].removed_spans) for k in (1, 2, 3)] == [(0, ""), (2, "2-23,26-35"), (1, "1-2")]
