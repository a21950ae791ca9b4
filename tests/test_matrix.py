import random
from itertools import combinations

import pytest

from tallyloom.operators import audience, overlap
from tallyloom.plans import proven


def wide_visits(n_media, n_users, seed=4):
    """Light users, one who saw everything, one with a single media, and rows that name no user or no media."""
    rng = random.Random(seed)
    rows = [(f"m{min(int(rng.paretovariate(0.6)), n_media) - 1}", u) for u in range(n_users) for _ in range(rng.randrange(1, 12))]
    rows += [(f"m{k}", 10**6) for k in range(n_media)] + [("m0", 10**6 + 1), (None, 10**6 + 2), ("m1", None)]
    return rows + rows[:50]


def brute(rows):
    users, out = {}, {}
    for m, u in rows:
        if m is not None and u is not None:
            users.setdefault(m, set()).add(u)
    total = len({u for _, u in rows if u is not None})
    for a, b in combinations(users, 2):
        n = len(users[a] & users[b])
        for x, y in ((a, b), (b, a)):
            if n:
                out[x, y] = (n, n * 100 / len(users[x]), n * 100 / len(users[y]), n * 100 * total / (len(users[x]) * len(users[y])))
    return out


@pytest.mark.parametrize("light, blocks", [(24, 16), (0, 3), (1000, 16)])
def test_matrix_against_brute_force(spark, monkeypatch, light, blocks):
    monkeypatch.setattr(overlap, "LIGHT", light)
    monkeypatch.setattr(overlap, "BLOCKS", blocks)
    rows = wide_visits(90, 60)
    got = overlap.overlap_matrix(spark.createDataFrame(rows, "media string, user long"), "media", "user")
    found = {(r.benchmark, r.comparison): (r.shared, r.horizontal, r.vertical, r["index"]) for r in got.collect()}
    want = brute(rows)
    assert found.keys() == want.keys() and len(want) == 90 * 89
    assert all(found[k] == pytest.approx(v) for k, v in want.items())


def test_matrix_per_period_of_a_set_agrees_with_the_listed_form(spark):
    rows = [(p, m, u) for p in ("a", "b") for m, u in wide_visits(40, 50, ord(p))] + [(None, "m1", 1), (None, "m2", 1)]
    visits = spark.createDataFrame(rows, "month string, media string, user long")
    listed = [f"m{k}" for k in range(0, 40, 3)]
    among = spark.createDataFrame([(m,) for m in listed * 2] + [(None,)], "media string")
    key = lambda r: (r.month, r.benchmark, r.comparison, r.shared, r.horizontal, r.vertical, r["index"])
    got = sorted(map(key, overlap.overlap_matrix(visits, "media", "user", ["month"], among).filter("month IS NOT NULL").collect()))
    want = audience.cross_visit(visits, "media", "user", listed, ["month"]).filter("month IS NOT NULL").collect()
    assert got == sorted(key(r) for r in want if r.benchmark in listed)
    unnamed = overlap.overlap_matrix(visits, "media", "user", ["month"]).filter("month IS NULL")
    assert sorted((r.benchmark, r.comparison, r.shared) for r in unnamed.collect()) == [("m1", "m2", 1), ("m2", "m1", 1)]


def test_five_thousand_media_are_dealt_in_proportion_to_the_visits(spark):
    pairs = spark.createDataFrame([(u, k) for u in range(4) for k in range(5000)] + [(10 + u, k) for u in range(3000) for k in (u, u + 1)], "_user long, _no long")
    cells = overlap.blocked_users(pairs, [])
    held = cells.selectExpr("size(_x._numbers) * if(_x._block = _y._block, 1, 0) AS own", "size(_x._numbers) * 1L * size(_y._numbers) AS work").selectExpr("count(*) AS n", "sum(own) AS own", "max(work) AS most").first()
    assert held.n == 4 * 16 * 17 // 2 + 3000 and held.own == pairs.count()
    # no row unfolds into more than a block by a block
    assert held.most <= (5000 // 16 + 1) ** 2


def test_nothing_to_multiply(spark):
    visits = spark.createDataFrame([("a", 1), ("b", 2)], "media string, user long")
    assert overlap.overlap_matrix(visits, "media", "user").count() == 0
    assert overlap.overlap_matrix(visits.limit(0), "media", "user").count() == 0


def summed(events):
    return events.groupBy("period", "entity").agg({"v": "sum"}).withColumnRenamed("sum(v)", "v")


def rows(df):
    return sorted(map(str, df.select("period", "entity", "v", "rank").collect()))


@pytest.mark.parametrize("n, cells", [(1, 1), (5, None), (50, 60), (400, 20), (5000, None)])
def test_proven_top_equals_the_whole_ranking(spark, n, cells):
    rng = random.Random(9)
    # many ties, negative values, a period of a few entities, nulls in every column
    made = [(rng.choice("ab"), int(rng.paretovariate(0.5)) % 3000, rng.randrange(-2, 6)) for _ in range(9000)]
    made += [("c", 1, 5), ("c", 2, None), ("c", 3, -4), (None, 7, 1), (None, None, 9), ("a", None, 3)]
    events = spark.createDataFrame(made, "period string, entity long, v long").selectExpr("*", "1 AS _cell", "2 AS rank")
    assert rows(proven.proven_top(events, "period", "entity", "v", n, cells)) == rows(audience.top_entities(summed(events), "period", "entity", "v", n))


def test_few_entities_are_candidates(spark):
    tail = spark.range(60_000).selectExpr("'p' AS period", "id AS entity", "1L AS v")
    head = spark.range(40).selectExpr("'p' AS period", "id * 1000 AS entity", "500L - id AS v")
    events = tail.unionByName(head)
    assert proven.candidates(events, "period", "entity", "v", 20, 4096).select("entity").distinct().count() < 1000
    assert rows(proven.proven_top(events, "period", "entity", "v", 20, 4096)) == rows(audience.top_entities(summed(events), "period", "entity", "v", 20))
    assert proven.proven_top(events.filter("false"), "period", "entity", "v", 20).count() == 0
    with pytest.raises(TypeError):
        proven.proven_top(events.withColumn("v", events.v.cast("double")), "period", "entity", "v", 3)
