import random
from itertools import combinations

import pytest
from payloads import rows_of

from tallyloom.operators import audience


@pytest.fixture(scope="module")
def visits():
    rng = random.Random(5)
    # One user holds a third of all rows.
    rows = [(f"m{rng.randrange(9)}", rng.randrange(200)) for _ in range(2000)]
    return rows + [(f"m{rng.randrange(9)}", 7) for _ in range(1000)]


def frame(spark, visits):
    return spark.createDataFrame(visits, "media string, user long")


def brute(visits, listed):
    users = {}
    for m, u in visits:
        users.setdefault(m, set()).add(u)
    total = len({u for _, u in visits})
    out = {}
    for a in users:
        for b in listed:
            n = len(users[a] & users.get(b, set()))
            if a != b and n:
                out[a, b] = (n, n * 100 / len(users[a]), n * 100 / len(users[b]), n * 100 * total / (len(users[a]) * len(users[b])))
    return out


@pytest.mark.parametrize("bits", [62, 4])
def test_cross_visit_matches_brute_force_for_any_list_length(spark, visits, bits, monkeypatch):
    monkeypatch.setattr(audience, "MASK_BITS", bits)
    listed = [f"m{i}" for i in range(8)] + ["absent"]
    got = audience.cross_visit(frame(spark, visits), "media", "user", listed)
    found = {(r.benchmark, r.comparison): (r.shared, r.horizontal, r.vertical, r["index"]) for r in got.collect()}
    want = brute(visits, listed)
    assert found.keys() == want.keys()
    for k, v in want.items():
        assert found[k] == pytest.approx(v)


def test_cross_visit_with_a_full_mask(spark):
    media = [f"m{i}" for i in range(130)]
    rows = [(m, u) for u in range(3) for m in media]
    got = audience.cross_visit(frame(spark, rows), "media", "user", media)
    assert got.count() == 130 * 129 and {r.shared for r in got.collect()} == {3}


def test_overlap_properties(spark, visits):
    listed = [f"m{i}" for i in range(9)]
    found = {(r.benchmark, r.comparison): r for r in audience.cross_visit(frame(spark, visits), "media", "user", listed).collect()}
    for (a, b), r in found.items():
        assert r.shared == found[b, a].shared
        assert r.horizontal == pytest.approx(found[b, a].vertical) and r.horizontal <= 100
    sets = {f"{a}{b}": [a, b] for a, b in combinations(listed, 2)} | {"all": listed}
    net = {r.media_set: r for r in audience.duplication(frame(spark, visits), "media", "user", sets).collect()}
    sizes = {m: len({u for x, u in visits if x == m}) for m in listed}
    for a, b in combinations(listed, 2):
        r = net[f"{a}{b}"]
        assert r.duplicated_all_sites == r.duplicated_2_or_more_sites == found[a, b].shared
        assert r.unduplicated == sizes[a] + sizes[b] - r.duplicated_all_sites
    by_user = {}
    for m, u in visits:
        by_user.setdefault(u, set()).add(m)
    assert net["all"].unduplicated == len(by_user)
    assert net["all"].duplicated_2_or_more_sites == sum(len(s) > 1 for s in by_user.values())
    assert net["all"].duplicated_all_sites == sum(len(s) == 9 for s in by_user.values())


def test_independent_audiences_have_index_100(spark):
    rows = [("a", u) for u in range(100) if u % 2 == 0] + [("b", u) for u in range(100) if u % 4 < 2] + [("c", u) for u in range(100)]
    found = audience.cross_visit(frame(spark, rows), "media", "user", ["a", "b"])
    assert {r["index"] for r in found.filter("benchmark = 'a' AND comparison = 'b'").collect()} == {100.0}


def test_sketched_overlap_is_close(spark):
    rows = [("a", u) for u in range(20000)] + [("b", u) for u in range(10000, 40000)]
    r = audience.cross_visit_approx(frame(spark, rows), "media", "user", ["a", "b"]).filter("benchmark = 'a'").first()
    assert r.audience == pytest.approx(20000, rel=0.1) and r.comparison_audience == pytest.approx(30000, rel=0.1)
    assert r.shared == pytest.approx(10000, abs=2 / 64 * 30000 * 2)


def test_key_measures(spark):
    events = spark.createDataFrame(
        [("d1", "a", 1, 2), ("d1", "a", 1, 3), ("d1", "a", 2, 4), ("d1", "b", 3, 5), ("d2", "a", 1, 6)],
        "day string, media string, user long, v long",
    )
    out = audience.key_measures(events, "day", "media", "user", "v")
    got = sorted(rows_of(out, "day", "media", "unique_visitors", "pages", "minutes", "reach"))
    assert got == [("d1", "a", 2, 3, 9, pytest.approx(200 / 3)), ("d1", "b", 1, 1, 5, pytest.approx(100 / 3)), ("d2", "a", 1, 1, 6, 100.0)]
    scaled = audience.key_measures(events, "day", "media", "user", "v", scaled=True).filter("media = 'b'")
    assert rows_of(scaled, "unique_visitors", "pages", "minutes", "reach") == [(0.001, 1e-6, 5e-6, pytest.approx(100 / 3))]


def test_top_entities_breaks_ties_by_entity(spark):
    rows = [("p", e, v) for e, v in (("a", 1), ("b", 5), ("c", 5), ("d", 9), ("e", None))] + [("q", "z", 1)]
    fact = spark.createDataFrame(rows, "period string, entity string, v long")
    for salts in (1, 3):
        out = audience.top_entities(fact, "period", "entity", "v", 2, salts)
        assert sorted(rows_of(out, "period", "rank", "entity")) == [("p", 1, "d"), ("p", 2, "b"), ("q", 1, "z")]
    assert audience.top_entities(fact, "period", "entity", "v", 99).count() == 6


def test_timeframe_average_counts_gaps_as_absent(spark):
    fact = spark.createDataFrame([("a", 1, 2), ("a", 1, 4), ("a", 2, 6), ("a", 5, 8), ("a", 6, None)], "k string, p int, v long")
    out = audience.timeframe_average(fact, ["k"], "p", "v", 3)
    assert sorted(rows_of(out, "p", "average")) == [(1, 3.0), (2, 4.0), (5, 8.0), (6, 8.0)]


def test_the_plan_does_not_grow_with_the_list(spark):
    visits = frame(spark, [(f"m{i % 50}", i % 7) for i in range(200)])
    size = lambda n: len(audience.cross_visit(visits, "media", "user", [f"m{i}" for i in range(n)])._jdf.queryExecution().optimizedPlan().toString().splitlines())
    assert size(20) == size(2000)
