"""The pipeline's stages, each held against a plain computation on its own input."""

import corpus_pipeline
from cases import documents
from test_repeats import brute

from tallyloom.llm import repeats, simhash, toxicity

SF = "/root/testdata/sf0.001"


def test_stages_follow_one_another(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        out.write.parquet(str(tmp_path / name))
        after = spark.read.parquet(str(tmp_path / name))
        before, rows = {r.doc_id: r for r in docs.collect()}, after.collect()
        seen[name] = len(rows)
        if name == "toxicity":
            model = toxicity.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
            scored = {r.doc_id: r.predicted for r in toxicity.score_documents(docs, model).collect()}
            assert {r.doc_id for r in rows} == {i for i, p in scored.items() if not p}
        elif name == "simhash_near_dedup":
            groups = simhash.near_duplicates(docs).collect()
            assert sorted(r.doc_id for r in rows) == sorted({r.component_id for r in groups})
        elif name == "suffix_array_dedup":
            expected = {i: n for i, _, n, _, _ in brute([(i, (r.text or "").encode()) for i, r in before.items()])}
            for r in rows:
                assert (r.text == before[r.doc_id].text) == (expected[r.doc_id] == 0) and r.n_chars == len(r.text)
            assert len(rows) == len(before)
        if name != "best_fit_packing":
            assert after.columns == columns
            assert all(r.lang == before[r.doc_id].lang for r in rows)
        else:
            assert {r.doc_id for r in rows} == set(before)
        docs = after
    assert corpus_pipeline.run(spark, SF).count() == seen["best_fit_packing"]


def test_stages_take_awkward_rows(spark):
    docs = documents(spark).select("doc_id", "text", "lang", "source", "n_chars")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and out.count() <= docs.count()
        assert stage(spark, docs.where("false"), SF).count() == 0
    assert repeats.without_repeats(docs).count() == docs.count()
