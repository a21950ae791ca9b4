import time

import pytest
from payloads import doc, header, landing, row, rows_of, target
from pyspark.sql import functions as F

from tallyloom.operators.parse import parse_rows
from tallyloom.operators.quality import assert_unique, conform, reconcile
from tallyloom.operators.reshape import pair_up, pivot_strict, split_by_member, unpivot
from tallyloom.plans import reports
from tallyloom.plans.specs import AUDIENCE_DUPLICATION, CROSS_VISITING

METRICS = ["% Vertical", "% Horizontal", "Index", "Shared Audience (000)"]
TOP = header(["", *["Beta"] * 4, *["Gamma"] * 4], "")
HEAD = header(["Target Audience", *[(m, str(i)) for _ in range(2) for i, m in enumerate(METRICS)]])


def visiting(spark, *rows):
    return landing(spark, doc(TOP, HEAD, *rows, summary=target("Persons: 2+")))


def test_cross_visiting(spark):
    out = reports.cross_visiting(
        visiting(spark, row("Alpha", ["Total", "1", "2", "3", "4", "5", "6", "", "8"], web_id="11"))
    )
    assert out.columns == [*CROSS_VISITING.schema.names, "data_date"]
    assert sorted(rows_of(out, *CROSS_VISITING.schema.names[:9]), key=str) == [
        ("Alpha", "11", "Persons: 2+", "Beta", "Total", 2.0, 1.0, 3.0, 4.0),
        ("Alpha", "11", "Persons: 2+", "Gamma", "Total", 6.0, 5.0, None, 8.0),
    ]
    corrected = reports.cross_visiting(visiting(spark), corrected_names=True)
    assert "per_comparison_media_visit_benchmark_media" in corrected.columns


def test_cross_visiting_with_an_absent_metric_gives_null(spark):
    top, head = header(["", "Beta", "Beta"], ""), header(["T", ("Index", "54"), ("% Vertical", "52")])
    out = reports.cross_visiting(landing(spark, doc(top, head, row("Alpha", ["Total", "1", "2"]), summary=target("t"))))
    assert rows_of(out, "index", "per_comparision_media_visit_benchmark_media", "shared_audience_000") == [(1.0, 2.0, None)]
    frame = landing(spark, doc(top, head, row("Alpha", ["Total", "1", "2"]), summary=target("t")))
    with pytest.raises(Exception, match="measure missing"):
        reports.cross_visiting(frame, require_metrics=True).collect()
    whole = visiting(spark, row("Alpha", ["Total", *"12345678"]))
    assert reports.cross_visiting(whole, require_metrics=True).count() == 2


def test_cross_visiting_duplicates(spark):
    twice = visiting(
        spark, row("Alpha", ["Total", *"12345678"]), row("Alpha", ["Total", *"12345678"]), row("Beta", ["Total", *"12345678"])
    )
    with pytest.raises(Exception, match="duplicate key"):
        reports.cross_visiting(twice).collect()
    assert {r[0] for r in rows_of(reports.cross_visiting(twice, on_duplicate="quarantine"), "benchmark_media")} == {"Beta"}
    assert sorted(rows_of(reports.cross_visiting_duplicates(twice), "row_no", "benchmark_media")) == [(0, "Alpha"), (1, "Alpha")]


def test_large_pair_matrices_take_linear_time(spark):
    def seconds(rows, columns):
        top, head = header(["", *[f"m{i}" for i in range(columns) for _ in METRICS]], ""), header(["T", *[(m, str(i)) for _ in range(columns) for i, m in enumerate(METRICS)]])
        text = doc(top, head, *[row(f"b{k}", ["Total", *["1"] * (4 * columns)]) for k in range(rows)], summary=target("t"))
        frame = landing(spark, text)
        start = time.perf_counter()
        assert reports.cross_visiting(frame).count() == rows * columns
        return time.perf_counter() - start

    seconds(10, 2)
    assert seconds(50_000, 1) < 12 * seconds(12_500, 1) + 5
    assert seconds(10, 800) < 12 * seconds(10, 200) + 5


def test_cross_visiting_repeated_metric_in_a_row(spark):
    top, head = header(["", "Beta", "Beta"], ""), header(["T", ("Index", "54"), ("Index", "54")])
    frame = landing(spark, doc(top, head, row("Alpha", ["Total", "1", "2"]), summary=target("t")))
    with pytest.raises(Exception, match="duplicate key"):
        reports.cross_visiting(frame).collect()


def duplication(spark, ids, *rows):
    head = header([("Visitors", "1"), ("Minutes", "2")])
    frame = landing(spark, doc(head, *rows, summary=target("Males 18+")))
    return frame.withColumn("media_ids", F.array(*[F.lit(i) for i in ids]))


SUMMARIES = [
    row("Unduplicated", ["50", "60"]), row("Duplicated (all sites)", ["30", "-"]), row("Duplicated (2 or more sites)", ["1", "2"]),
]


def test_audience_duplication(spark):
    frame = duplication(spark, ["1", "2"], row("Alpha", ["10", "20"], web_id="1"), *SUMMARIES, row("Beta", ["30", "40"], web_id="2"))
    expected = [
        ("Alpha", "1", "Minutes", "2", 20.0, "Males 18+", None, 60.0, "Beta"),
        ("Alpha", "1", "Visitors", "1", 10.0, "Males 18+", 30.0, 50.0, "Beta"),
        ("Beta", "2", "Minutes", "2", 40.0, "Males 18+", None, 60.0, "Alpha"),
        ("Beta", "2", "Visitors", "1", 30.0, "Males 18+", 30.0, 50.0, "Alpha"),
    ]
    for pairing in ("each", "reversed"):
        out = reports.audience_duplication(frame, pairing=pairing)
        assert out.columns == [*AUDIENCE_DUPLICATION.schema.names, "data_date"]
        assert sorted(rows_of(out, *out.columns[:9]), key=str) == sorted(expected, key=str)


def test_three_and_one_media(spark):
    three = duplication(spark, ["1", "2", "3"], *[row(m, ["1", "2"], web_id=i) for m, i in zip("ABC", "123")], *SUMMARIES)
    out = reports.audience_duplication(three).filter("metric_id = '1'")
    assert sorted(rows_of(out, "benchmark_media", "comparision_media")) == [
        ("A", "B"), ("A", "C"), ("B", "A"), ("B", "C"), ("C", "A"), ("C", "B"),
    ]
    back = reports.audience_duplication(three, pairing="reversed").filter("metric_id = '1'")
    assert sorted(rows_of(back, "benchmark_media", "comparision_media")) == [("A", "C"), ("B", "B"), ("C", "A")]
    one = duplication(spark, ["1"], row("A", ["1", "2"], web_id="1"))
    assert rows_of(reports.audience_duplication(one), "benchmark_media", "unduplicated", "comparision_media") == [
        ("A", None, None), ("A", None, None),
    ]


def test_duplication_quarantine_and_repeated_summary(spark):
    odd = duplication(spark, ["1"], row("A", ["1", "2"], web_id="1"), row("Mystery", ["1", "2"]), row("B", ["1"], web_id="2"), *SUMMARIES)
    assert sorted(rows_of(reports.audience_duplication_rejects(odd), "label", "reject_reason")) == [
        ("B", "short_row"), ("Mystery", "unknown_summary"),
    ]
    repeated = duplication(spark, ["1"], row("A", ["1", "2"], web_id="1"), *SUMMARIES, SUMMARIES[0])
    with pytest.raises(Exception, match="duplicate key"):
        reports.audience_duplication(repeated).collect()


def test_pivot_undoes_unpivot_and_finds_duplicates(spark):
    wide = spark.createDataFrame([("a", 1.0, None), ("b", 3.0, 4.0), (None, 5.0, 6.0)], "k string, x double, y double")
    long = unpivot(wide, ["k"], ["x", "y"])
    assert long.count() == 6
    back = pivot_strict(long, ["k"], "metric", "metric_value", {"x": "x", "y": "y"})
    assert sorted(rows_of(back, "k", "x", "y"), key=str) == sorted(rows_of(wide, "k", "x", "y"), key=str)
    doubled = long.unionByName(long.filter("k = 'a'"))
    with pytest.raises(Exception, match="duplicate key"):
        pivot_strict(doubled, ["k"], "metric", "metric_value", {"x": "x", "y": "y"}).collect()
    flagged = pivot_strict(doubled, ["k"], "metric", "metric_value", {"x": "x", "y": "y"}, on_duplicate="flag")
    assert rows_of(flagged.filter("is_duplicate"), "k") == [("a",)]
    with pytest.raises(ValueError, match="duplicate key"):
        assert_unique(doubled, ["k", "metric"])
    assert_unique(long, ["k", "metric"])


def test_split_keeps_nulls_outside(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "m string")
    inside, outside = split_by_member(df, "m", ["a"])
    assert rows_of(inside, "m") == [("a",)]
    assert sorted(rows_of(outside, "m"), key=str) == [("b",), (None,)]


def test_pair_up_by_list(spark):
    df = spark.createDataFrame([("g", "a", 1), ("g", "b", 2), ("g", "c", 3), ("h", "a", 4)], "g string, m string, v int")
    out = pair_up(df, ["g"], "m", ["a", "b", "c"], "v")
    assert out.count() == 6
    assert sorted(rows_of(out.filter("m = 'a'"), "g", "companion", "companion_v")) == [("g", "b", 2), ("g", "c", 3)]


def test_reconcile_counts_every_row(spark):
    frame = visiting(spark, row("Alpha", ["Total", *"12345678"]), row("Beta", ["Total"]))
    assert rows_of(reconcile(parse_rows(frame, CROSS_VISITING), ["request_id"]), "scanned", "kept", "rejected") == [(2, 1, 1)]


def test_conform_rejects_missing_columns(spark):
    with pytest.raises(ValueError, match="missing"):
        conform(spark.range(1), CROSS_VISITING.schema)
