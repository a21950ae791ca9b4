"""Every query of the subpackage: against its SQL where it has some, else its contract's columns over the whole table."""

import importlib.util

import pytest
from compare import difference, oracle

import __spark_entry__ as entry
from tallyloom.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1": {"page_id", "host", "path", "rule", "verdict"},
    "op2": {"doc_id", "held_out", "lang_pred", "score"},
    "op4": {"input_ids", "cu_seqlens", "position_resets"},
    "op6": {"doc_id", "contaminated"},
    "op7": {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"},
    "op8": {"doc_id", "held_out", "score", "predicted"},
    "op9": {"doc_id", "fingerprint", "component_id"},
    "op11": {"doc_id", "n_shingles", "component_id"},
    "op12": {"doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"},
}


@pytest.fixture(scope="module")
def con():
    return oracle(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    if name in ORACLES:
        assert difference(df, con, ORACLES[name]) is None
        return
    op = name.split("_")[0]
    assert COLUMNS[op] <= set(df.columns)
    source = "pages" if op == "op1" else "documents"
    n = spark.read.parquet(f"{SF}/{source}.parquet").count()
    if op == "op4":
        assert df.selectExpr("explode(doc_ids) AS d").distinct().count() == n
    elif op == "op7":
        assert df.select("doc_id").distinct().count() == n
    else:
        assert df.count() == n


def test_all_operators_and_the_pipeline_are_registered():
    names = set(entry.queries())
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14))
    assert ("pipeline" in names) == (importlib.util.find_spec("corpus_pipeline") is not None)
    assert set(entry.oracle_sql()) <= names
