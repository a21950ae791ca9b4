import zlib

import numpy as np
import pytest
from cases import documents, empty
from pyspark.sql import functions as F

from tallyloom.llm import language, toxicity, urls
from tallyloom.llm.common import held_out

SF = "/root/testdata/sf0.01"


def is_held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


def test_held_out_fold(spark):
    got = {r[0]: r[1] for r in spark.range(50).select(F.col("id").alias("doc_id"), held_out()).collect()}
    assert got == {i: is_held_out(i) for i in range(50)}


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


def test_language_held_out_accuracy_and_odd_texts(spark, docs):
    model = language.fit(docs)
    truth = {r.doc_id: r.lang for r in docs.collect()}
    rows = [r for r in language.identify(docs, model).collect() if r.held_out]
    assert all(is_held_out(r.doc_id) for r in rows)
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in rows]) > 0.97
    odd = documents(spark)
    out = language.identify(odd, model).collect()
    assert len(out) == odd.count() and all(0 <= r.score <= 1 for r in out)
    assert {r.lang_pred for r in out if r.doc_id in (3, 4, 5)} == {"und"}
    assert language.identify(empty(odd), model).count() == 0


def test_language_is_learnt_from_the_other_folds_only(spark, docs):
    spoilt = docs.withColumn("lang", F.when(held_out(), "zz").otherwise(F.col("lang")))
    assert "zz" not in language.fit(spoilt).languages


def test_language_without_anything_to_learn(spark):
    docs = documents(spark).withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in language.identify(docs, language.fit(docs)).collect()} == {"und"}


def test_more_languages_do_not_cost_any_language_its_words(spark):
    # 70 languages of 3 documents outside the held-out fold, each with 40 words of its own and one that all share
    def own(k):
        return [f"{a}{b}{chr(97 + k % 26) * (1 + k // 26)}" for a in "qwxz" for b in "abcdefghij"]

    ids = [i for i in range(1000) if not is_held_out(i)]
    rows = [(ids[3 * k + j], " ".join(own(k)) + " shared", f"l{k:02}") for k in range(70) for j in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(docs)
    assert model.languages == [f"l{k:02}" for k in range(70)]
    assert set(model.words) == {w for k in range(70) for w in own(k)} | {"shared"}
    assert all(r.lang_pred == f"l{ids.index(r.doc_id) // 3:02}" for r in language.identify(docs, model).collect())
    few = language.fit(docs.where("lang < 'l02'"))
    assert set(few.words) == {w for k in range(2) for w in own(k)} | {"shared"}
    # the most frequent words of each language are kept, the first by name of equally frequent ones
    bounded = language.fit(docs.where("lang < 'l03'"), words=5, n_grams=7)
    assert set(bounded.words) == {w for k in range(3) for w in sorted([*own(k), "shared"])[:5]}
    # parts of any size give the same scores
    whole = {w: model.score(w) for w in ("qaa", "shared", "unheard", "qaa shared unheard of")}
    model.together = 1
    model.unseen.clear()
    assert {w: model.score(w)[0] for w in whole} == {w: lang for w, (lang, _) in whole.items()}
    assert np.allclose([model.score(w)[1] for w in whole], [share for _, share in whole.values()])


def test_sparse_frequencies_are_the_counts(spark):
    docs = spark.createDataFrame([(1, "b b a", "x"), (2, "c a", "y"), (3, "c", "y")], "doc_id long, text string, lang string")
    model = language.fit(docs)
    counts = {"a": [1, 1], "b": [2, 0], "c": [0, 2]}
    got = model.table[[model.words[w] for w in "abc"]]
    assert np.allclose(got, [np.log((np.array(counts[w]) + 0.5) / (3 + 0.5 * 3)) for w in "abc"])


def test_unknown_words_fall_back_to_shorter_grams():
    model = language.LanguageModel(["x", "y"], {"known": 0}, {"ab": 1, "a": 2}, np.log(np.array([[0.5, 0.1], [0.4, 0.2], [0.1, 0.3]])), np.log(np.array([1e-3, 1e-3])))
    assert model.score("known")[0] == "x" and model.score("1 2 3") == ("und", 0.0)
    # places of <ab>: unseen, a, ab, unseen
    assert np.allclose(model._backoff(["ab"])[0], (2 * np.log([1e-3, 1e-3]) + np.log([0.1, 0.3]) + np.log([0.4, 0.2])) / 4)


def test_toxicity_held_out_accuracy(spark, docs, labels):
    model = toxicity.fit(docs, labels)
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    rows = [r for r in toxicity.score_documents(docs, model).collect() if r.held_out and r.doc_id in truth]
    assert np.mean([r.predicted == truth[r.doc_id] for r in rows]) > 0.93
    assert {"idiot", "moron", "scum"} & set(model.features)


def test_toxicity_does_not_look_at_held_out_labels(spark, docs, labels):
    flipped = labels.withColumn("toxic", F.when(held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = toxicity.fit(docs, labels), toxicity.fit(docs, flipped)
    assert a.features == b.features and np.allclose(a.weights, b.weights)


def test_toxicity_odd_rows(spark, labels, docs):
    odd = documents(spark)
    model = toxicity.fit(docs, labels.unionAll(labels).unionByName(spark.createDataFrame([(None, 1, 1), (1, None, None)], labels.schema)))
    out = toxicity.score_documents(odd, model).collect()
    assert len(out) == odd.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in out)
    assert toxicity.without_toxic(odd, labels).columns == odd.columns
    nothing = toxicity.fit(odd, empty(labels))
    assert {r.predicted for r in toxicity.score_documents(odd, nothing).collect()} == {0}


def test_label_model_finds_rates_and_correlations():
    rng = np.random.default_rng(2)
    n, fires, misfires = 40_000, np.array([0.6, 0.5, 0.4, 0.3, 0.5]), np.array([0.02, 0.05, 0.01, 0.02, 0.05])
    y = rng.random(n) < 0.1
    votes = (rng.random((n, 5)) < np.where(y[:, None], fires, misfires)).astype(float)
    votes = np.column_stack((votes, votes[:, 1]))  # the last repeats the second
    given = y[:5000].astype(float)
    marked = (votes[:5000] * (given - given.mean())[:, None]).mean(axis=0)
    model = toxicity.LabelModel.fit(n, votes.sum(axis=0), votes.T @ votes, marked, given.mean())
    assert np.abs(model.fires[[0, 2, 3]] - fires[[0, 2, 3]]).max() < 0.1
    assert model.correlated[1, 5] and model.weight[1] < 0.7 < model.weight[0]
    p = model.posterior(votes)
    assert p[y].mean() > 0.6 and p[~y].mean() < 0.1


RULES = [urls.Rule("block", "net/"), urls.Rule("allow", "example.net/en/"), urls.Rule("block", "example.com/de/"), urls.Rule("allow", "org/fr/")]


def slow_rule(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = rest
    for c in "/?#":
        host = host.split(c, 1)[0]
    path = rest[len(host) :].split("?", 1)[0].split("#", 1)[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.text), default=None)
    return host, path, best and best.text, best and best.verdict


def test_rules_against_brute_force(spark):
    given = [
        "http://A.Example.NET/en/x", "https://example.net/de/1?a=/en/", "http://net/", "http://net", "http://xnet/", "http://example.com/de", "x://www.example.com/de/?q",
        "http://a.org/fr/", "no scheme", "", None, "://", "http://e.com?x=/de/#y", "http://ÄB.org/fr/1", "http://h/p\nq?r", "a://b://c/d", "http://" + "d" * 5000 + ".net/x",
    ]
    pages = spark.createDataFrame([(k, u, "clash") for k, u in enumerate(given)] + [(0, given[0], "again"), (None, "http://a.net/1", "")], "page_id long, url string, host string")
    got = urls.judge(pages, RULES).collect()
    assert len(got) == len(given) + 2
    for r in got:
        host, path, rule, verdict = slow_rule(given[r.page_id] if r.page_id is not None else "http://a.net/1")
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == (verdict or ("block" if r.score >= 0.5 else "allow"))
    assert urls.judge(empty(pages), RULES).count() == 0


def test_trees_learn_lexical_labels(spark):
    rows = [(k, f"http://h{k % 7}.site.com/" + ("x/" * (k % 5)) + ("1" * 12 if k % 2 else "abc")) for k in range(400)]
    df = urls.parsed(spark.createDataFrame(rows, "page_id long, url string"), [])
    label = F.when(F.col("page_id") % 2 == 1, 1).otherwise(0)
    ready = urls.with_features(df, urls.suffix_table(df, label), 0.5, label).withColumn("label", label)
    model = urls.train(ready.where("page_id < 200"))
    test = urls.VectorAssembler(inputCols=urls.FEATURES, outputCol="features").transform(ready.where("page_id >= 200"))
    assert model.transform(test).where("prediction = label").count() > 190


def test_entropy_and_counts(spark):
    row = urls.lexical(urls.parsed(spark.createDataFrame([(1, "http://a-b.c/aabb/12?x=1&y=2")], "page_id long, url string"), [])).first()
    url = "http://a-b.c/aabb/12?x=1&y=2"
    p = np.array([url.count(c) for c in set(url)]) / len(url)
    assert np.isclose(row.entropy, -(p * np.log2(p)).sum()) and row.parameters == 2 and row.depth == 2 and row.host_hyphens == 1
    assert np.isclose(row.digit_ratio, 4 / len(url))


def test_url_plan_runs_no_python(spark):
    plan = urls.judge(spark.read.parquet(f"{SF}/pages.parquet"), RULES)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
