import hashlib

import numpy as np
import pyarrow as pa
import pytest
from cases import documents, empty

from tallyloom.llm import repeats
from tallyloom.llm.common import groups_for


def brute(rows):
    """Every 50-byte window against all documents with a smaller id."""
    first, out = {}, []
    for i, b in rows:
        for p in range(len(b) - 49):
            w = b[p : p + 50]
            first[w] = min(first.get(w, i), i)
    for i, b in rows:
        mask = np.zeros(len(b), bool)
        for p in range(len(b) - 49):
            if first[b[p : p + 50]] < i:
                mask[p : p + 50] = True
        kept = np.frombuffer(b, np.uint8)[~mask].tobytes()
        spans = int((np.diff(np.concatenate(([0], mask.astype(int)))) == 1).sum())
        out.append((i, len(b), int(mask.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def rows_of(df):
    return [(repeats.NO_ID if r.doc_id is None else r.doc_id, (r.text or "").encode()) for r in df.collect()]


@pytest.mark.parametrize("hot_groups, group_bytes", [(512, 2 << 20), (1, 4000)])
def test_awkward_rows_against_brute_force(spark, hot_groups, group_bytes):
    docs = documents(spark)
    found = repeats.repeat_digests(docs, hot_groups, group_bytes).collect()
    got = sorted((repeats.NO_ID if r.doc_id is None else r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found)
    assert got == brute(rows_of(docs))


def test_long_texts_go_over_several_slices(spark, monkeypatch):
    monkeypatch.setattr(repeats, "SLICE", 300)
    docs = documents(spark)
    found = repeats.repeat_digests(docs, 512, 20_000).collect()
    got = sorted((repeats.NO_ID if r.doc_id is None else r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found)
    assert got == brute(rows_of(docs))


def test_rewritten_texts_keep_rows_and_columns(spark):
    docs = documents(spark)
    cut = repeats.without_repeats(docs)
    assert cut.columns == docs.columns and cut.count() == docs.count()
    text = {r.doc_id: r.text for r in cut.collect()}
    assert text[1] == "The cat sat on the mat. " * 20 and text[2] == "" and text[3] is None
    assert "word30" in text[-5] and "word30" not in text[9] and text[9].startswith("intro one two three")


def test_columns_named_like_its_own(spark):
    docs = documents(spark)
    for name in ("__group", "__GROUP_", "body"):
        docs = docs.selectExpr("*", f"'mine' AS {name}")
    cut = repeats.without_repeats(docs)
    assert cut.columns == docs.columns and {tuple(r[-3:]) for r in cut.collect()} == {("mine",) * 3}
    assert sorted(str(r.text) for r in cut.collect()) == sorted(str(r.text) for r in repeats.without_repeats(documents(spark)).collect())


def test_empty_table(spark):
    assert repeats.repeat_digests(empty(documents(spark))).count() == 0


def test_transform_orders_suffixes():
    words = [b"banana", b"bandana", b"ananas", b"a"]
    sizes = np.array([len(w) for w in words])
    string, offset = repeats.sorted_windows(np.frombuffer(b"".join(words), np.uint8), np.cumsum(sizes), sizes, 2)
    seen = [words[s][o:] for s, o in zip(string, offset, strict=True)]
    assert seen == sorted(seen) and len(seen) == sum(len(w) - 1 for w in words)


@pytest.mark.parametrize("rounds", [1, 2, 7, 100])
def test_transform_whatever_rounds_are_merged_at_once(monkeypatch, rounds):
    monkeypatch.setattr(repeats, "ROUNDS", rounds)
    rng = np.random.default_rng(rounds)
    for letters in (b"ab", b"abcdez\xff"):
        words = [bytes(rng.choice(list(letters), rng.integers(1, 30)).tolist()) for _ in range(40)] * 2
        sizes = np.array([len(w) for w in words])
        # ties between equal suffixes go by the order of the strings
        suffixes = sorted((w[o:], k, w[o - 1] if o else 0) for k, w in enumerate(words) for o in range(len(w) + 1))
        got = repeats.transform(np.frombuffer(b"".join(words), np.uint8), np.cumsum(sizes), sizes)
        assert got.tolist() == [before for _, _, before in suffixes]


def test_transform_sorts_few_symbols_a_round(monkeypatch):
    rng = np.random.default_rng(1)
    sizes = np.full(500, 84)
    data, sort, seen = rng.integers(97, 123, sizes.sum()).astype(np.uint8), np.argsort, []
    monkeypatch.setattr(np, "argsort", lambda x, *a, **k: (seen.append(len(x)), sort(x, *a, **k))[1])
    repeats.transform(data, np.cumsum(sizes), sizes)
    assert sum(seen) < 20 * len(data)  # sorting the whole transform in every round takes 43 times


def test_runs_of_a_buffer():
    texts = [b"a" * 130, b"b" * 50, bytes(range(1, 120)) * 2]
    data, ends = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([len(t) for t in texts])
    _, part, begin, n = repeats._runs(data, ends)
    assert n.max() <= repeats.SPAN and n.min() > 0
    for k, text in enumerate(texts):  # every window of every text is in one run, in order
        at = [i for b, m in zip(begin[part == k], n[part == k], strict=True) for i in range(b, b + m)]
        assert at == list(range(ends[k] - len(text), ends[k] - repeats.WINDOW + 1))


def group_of(group, texts):
    return pa.table({"doc_id": pa.array(range(len(texts)), pa.int64()), "text": pa.array(texts, pa.string()), "__group": pa.array([group] * len(texts), pa.int32())})


@pytest.mark.parametrize("hot_strings", [1 << 15, 1])
def test_periodic_texts_against_brute_force(spark, hot_strings):
    rng = np.random.default_rng(3)
    units = ["a ", "ab", " a a ", "0.25 0.50 ", "the the the a ", "é-", "=", "Thon thou "]
    rows = [(int(i), "".join(rng.choice(units) * int(rng.integers(1, 60)) for _ in range(6))) for i in rng.permutation(60)]
    found = repeats.repeat_digests(spark.createDataFrame(rows, "doc_id long, text string"), hot_strings, 3000).collect()
    assert sorted(tuple(r) for r in found) == brute(sorted((i, t.encode()) for i, t in rows))


@pytest.mark.parametrize("megabytes", [1, 100, 1000, 10_000, 40_000])
def test_messages_do_not_grow_with_the_square_of_the_input(megabytes):
    total = megabytes << 20
    size = repeats._group_bytes(total, repeats.GROUP_BYTES)
    messages = groups_for(total, size) * groups_for(total, 2 * size)
    assert messages <= 1 + total / 8192 and repeats.GROUP_BYTES <= size <= 16 << 20


def test_a_short_phrase_in_many_contexts_sends_no_strings():
    rng = np.random.default_rng(5)
    texts = [" as a matter of fact ".join("".join(map(chr, rng.integers(97, 123, 60))) for _ in range(30)) for _ in range(20)]
    anchors = pa.concat_tables([repeats._anchors(1, "__group")(group_of(g, texts[10 * g : 10 * g + 10])) for g in range(2)])
    assert len(repeats._repeated(1 << 15)(anchors)) == 0


def test_a_passage_that_all_groups_have_stays_in_whole_strings():
    docs = group_of(0, ["begin of it " + " ".join(f"word{i}" for i in range(60))] * 2)
    anchors = repeats._anchors(1, "__group")(docs)
    sent = []
    for groups in (2, 1000):  # a thousand groups with one string each are no load for a shard
        all_groups = pa.concat_tables([anchors.set_column(1, "__group", pa.array([g], pa.int32())) for g in range(groups)])
        told = repeats._repeated(repeats.HOT_STRINGS)(all_groups)
        sent.append(repeats._strings(1, "__group")(docs, told.filter(pa.array([g == 0 for g in told.column("__group").to_pylist()]))))
    assert sent[0].equals(sent[1])


def test_hashes_tell_regular_strings_apart():
    strings = {(b"u" * (k % 2) + unit * 50)[:size] for unit in (b" a", b"a ", b"0.25 ", b"==", b"a\x00") for k in range(2) for size in range(50, 85)}
    for at in range(60):
        strings |= {b"1.00 2.00 " * 5 + bytes([x]) * (k + 1) + b"0" * at for x in b"0123456789" for k in range(3)}
    strings = sorted(s for s in strings if len(s) <= 84)
    sizes = np.array([len(s) for s in strings])
    found = repeats._hashed(repeats._words(np.frombuffer(b"".join(strings), np.uint8)), np.cumsum(sizes) - sizes, sizes)
    assert len(set(found.tolist())) == len(strings)
    one = [repeats._hashed(repeats._words(np.frombuffer(s, np.uint8)), np.array([0]), np.array([len(s)]))[0] for s in strings]
    assert found.tolist() == one  # whatever is hashed beside it


def test_copies_of_a_text_send_no_strings():
    texts = ["".join(map(chr, np.random.default_rng(k).integers(97, 123, 500))) for k in range(5)]
    docs = group_of(0, texts * 20)
    assert len(repeats._repeated(1 << 15)(repeats._anchors(1, "__group")(docs))) == 0
    found = repeats._digests(docs, pa.table({"shard": pa.array([], pa.int32()), "__group": pa.array([], pa.int32()), "body": pa.array([], pa.binary())}))
    assert [tuple(r.values()) for r in found.to_pylist()] == brute([(k, t.encode()) for k, t in enumerate(texts * 20)])


@pytest.mark.parametrize("group_bytes", [4000, 2 << 20])
def test_copies_within_and_over_groups(spark, group_bytes):
    rng = np.random.default_rng(7)
    common = " ".join(f"common{i}" for i in range(80))
    few = ["".join(map(chr, rng.integers(97, 123, int(n)))) for n in rng.integers(40, 400, 10)]
    rows = [(i, common) for i in range(60)] + [(100 + i, few[i % 10] + common[:200]) for i in range(40)] + [(200 + i, few[i % 10]) for i in range(40)]
    rows += [(None, common), (None, few[3]), (205, few[5]), (7, few[7] + "!"), (300, "x" * 49), (301, "x" * 49), *((400 + i, None) for i in range(50))]
    docs = spark.createDataFrame([rows[i] for i in rng.permutation(len(rows))], "doc_id long, text string")
    found = repeats.repeat_digests(docs, group_bytes=group_bytes).collect()
    got = sorted((repeats.NO_ID if r.doc_id is None else r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found)
    assert got == brute(rows_of(docs))
