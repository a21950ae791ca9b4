import html
import random

import pytest
from payloads import doc, header, landing, row, rows_of
from pyspark.sql import functions as F

from tallyloom.operators.parse import (
    attribute,
    fail_on_reject,
    has_errors,
    job_id,
    long_facts,
    parse_rows,
    rejected_rows,
    summary_target,
)
from tallyloom.plans import reports
from tallyloom.plans.specs import AUDIENCE_DUPLICATION, DESKTOP, LOCAL_MARKET, MOBILE, MULTI_PLATFORM, Layout
from tallyloom.workload import documents

DESKTOP_HEADER = header(["Category", "Attribute", ("Visitors", "1"), ("Minutes", "2")])


def desktop_rows(spark, *rows, **kw):
    return reports.desktop(landing(spark, doc(DESKTOP_HEADER, *rows)), **kw)


def test_clean_desktop_report(spark):
    out = desktop_rows(
        spark,
        row("A &amp; B", ["News", "x", "12.5", " 7 "], media_type="[P]", web_id="10", parent_id="9"),
        row("Gamma", ["Shop", "", "3", "4"]),
    )
    assert out.columns == [*DESKTOP.schema.names, "data_date"]
    assert sorted(rows_of(out, "media", "media_type", "company_id", "parent_company_id", "metric", "metric_id", "metric_value"), key=str) == sorted(
        [
            ("A & B", "P", "10", "9", "Visitors", "1", 12.5),
            ("A & B", "P", "10", "9", "Minutes", "2", 7.0),
            ("Gamma", None, None, None, "Visitors", "1", 3.0),
            ("Gamma", None, None, None, "Minutes", "2", 4.0),
        ],
        key=str,
    )
    assert set(rows_of(out, "timeframe", "month", "year", "report_type", "categories")) == {
        ("1 month average", "March", 2019, "Desktop Only", "custom entities")
    }
    assert set(rows_of(out, "category", "attribute")) == {("News", "x"), ("Shop", "")}


def test_cell_values(spark):
    cells = ["12.5", "1,234", "", "-", "NaN", "inf", "1d", " 7 ", "text", None]
    head = header(["Category", "Attribute", *[(f"m{i}", str(i)) for i in range(len(cells))]])
    out = reports.desktop(landing(spark, doc(head, row("A", ["c", "a", *cells]))))
    values = {m: v for m, v in rows_of(out, "metric", "metric_value")}
    assert [values[f"m{i}"] for i in range(len(cells))] == [
        12.5, None, None, None, None, float("inf"), None, 7.0, None, None,
    ]


def test_markup_variants(spark):
    messy = """<HTML><!-- <table><tr><td>no</td></tr></table> --><body><p>hi<br>there</p>
    <TABLE class="a>b"><caption>cap</caption><thead><TR><TH>Media<TD>Category<TD>Attribute<TD ID='1'>Visitors</TR></thead>
    <tbody><TR><TH WEB_ID=5 media_type='[M]'>A&nbsp;caf&eacute; <b>X</b></TH><td>c <i>d</i> e<td>&#233;&lt;<td> 4
    </TR></tbody></TABLE><table><tr><th>other</th></tr></table>"""
    out = reports.desktop(landing(spark, messy))
    assert rows_of(out, "media", "company_id", "media_type", "category", "attribute", "metric_id", "metric_value") == [
        ("A café X", "5", "M", "c d e", "é<", "1", 4.0)
    ]


def test_nested_table_keeps_later_rows(spark):
    inner = "<table><tr><th>i</th><td>0</td></tr></table>"
    payload = doc(DESKTOP_HEADER, f"<tr><th>A</th><td>c</td><td>a</td><td>1</td><td>2{inner}</td></tr>", row("B", ["c", "a", "3", "4"]))
    parsed = parse_rows(landing(spark, payload), DESKTOP)
    assert rows_of(parsed, "label", "reject_reason") == [("A", None), ("i", "short_row"), ("B", None)]


def test_ragged_rows_go_to_quarantine(spark):
    payload = doc(
        DESKTOP_HEADER, row("short", ["c", "a", "1"]), row("long", ["c", "a", "1", "2", "3"]), row("ok", ["c", "a", "1", "2"]),
        "<tr><td>c</td><td>a</td><td>1</td><td>2</td></tr>",
    )
    parsed = parse_rows(landing(spark, payload), DESKTOP)
    assert parsed.count() == 4
    assert sorted(rows_of(rejected_rows(parsed), "row_no", "label", "reject_reason"), key=str) == [
        (0, "short", "short_row"), (1, "long", "long_row"), (3, None, "no_label"),
    ]
    assert {r[0] for r in rows_of(long_facts(parsed, DESKTOP), "media")} == {"ok"}


def test_header_is_the_bound_unless_first_row_is_asked_for(spark):
    payload = doc(header([("a", "1"), ("b", "2")]), row("first", ["1"]), row("second", ["3", "4"]))
    by_header = long_facts(parse_rows(landing(spark, payload), LOCAL_MARKET), LOCAL_MARKET)
    assert sorted(rows_of(by_header, "media", "metric", "metric_value"), key=str) == [
        ("first", "a", 1.0), ("first", "b", None), ("second", "a", 3.0), ("second", "b", 4.0),
    ]
    spec = LOCAL_MARKET.with_width_from("first_row")
    by_first = long_facts(parse_rows(landing(spark, payload), spec), spec)
    assert sorted(rows_of(by_first, "media", "metric", "metric_value")) == [("first", "a", 1.0), ("second", "a", 3.0)]


def test_first_row_compatibility_of_drifting_layouts_drops_well_formed_rows(spark):
    metrics = [(f"m{i}", str(i)) for i in range(45)]
    head = "<tr><th></th>" + "".join("<td>Desktop</td>" for _ in metrics) + "</tr>" + header(["Category", *metrics])
    payload = doc(head, row("ragged", ["c", "1"]), row("ok", ["c", *map(str, range(45))]))
    assert {r[0] for r in rows_of(reports.multi_platform(landing(spark, payload)), "media")} == {"ok"}
    old = MULTI_PLATFORM.with_width_from("first_row")
    parsed = parse_rows(landing(spark, payload), old)
    assert sorted(rows_of(parsed, "label", "reject_reason")) == [("ok", "long_row"), ("ragged", "unknown_layout")]


def test_unbalanced_quotes_in_a_long_document(spark):
    quotes = "say \"hi\" and it's " * 100_000
    payload = doc(DESKTOP_HEADER, f'<tr><th web_id="1" note=it\'s>A</th><td>c</td><td>a</td><td>1</td><td>2</td></tr>') + quotes
    assert rows_of(parse_rows(landing(spark, payload + "<b " + quotes), DESKTOP), "reject_reason") == [(None,)]
    long_tag = "<i " + "x='1' " * 50_000 + ">"
    inside = doc(DESKTOP_HEADER, row("A", ["c", "a", f"{long_tag}1</i>", "2"]))
    assert sorted(rows_of(reports.desktop(landing(spark, inside)), "metric_value")) == [(1.0,), (2.0,)]


def test_empty_and_missing_tables(spark):
    out = reports.desktop(landing(spark, doc(DESKTOP_HEADER), "<Envelope/>", None, "<table></table>"))
    assert out.count() == 0


def _wide(n_metrics, n_keys, top_keys):
    keys = ["Category", "Attribute"]
    metrics = [(f"m{i}", str(i)) for i in range(n_metrics)]
    top = header([*keys[:top_keys], *[f"P{i}" for i in range(n_metrics)]], "")
    return doc(top, header([*keys[:n_keys], *metrics]), row("A", [*["c", "a"][:n_keys], *map(str, range(n_metrics))]))


@pytest.mark.parametrize("n_keys,top_keys", [(1, 0), (1, 1), (2, 2)])
def test_layouts_by_width(spark, n_keys, top_keys):
    out = reports.multi_platform(landing(spark, _wide(45, n_keys, top_keys)))
    expected = [("c", "a" if n_keys == 2 else "None", f"m{i}", float(i), f"P{i}") for i in range(45)]
    assert sorted(rows_of(out, "category", "attribute", "metric", "metric_value", "platform")) == sorted(expected)


def test_missing_attribute_can_be_null(spark):
    out = reports.multi_platform(landing(spark, _wide(45, 1, 0)), null_attribute=True)
    assert set(rows_of(out, "attribute")) == {(None,)}


def test_unknown_width_is_rejected_unless_any_width_is_allowed(spark):
    frame = landing(spark, _wide(30, 2, 2))
    assert rows_of(parse_rows(frame, MULTI_PLATFORM), "reject_reason") == [("unknown_layout",)]
    any_width = MULTI_PLATFORM.with_layouts(*MULTI_PLATFORM.layouts[:2], Layout(key_cells=("category", "attribute")))
    assert reports.multi_platform(frame, any_width).count() == 30


def test_strict_report(spark):
    top = header(["Web", "App"], "")
    head = header([("v", "1"), ("v", "1")])
    frame = landing(spark, doc(top, head, row("long", ["1", "2", "3"]), row("short", ["1"]), row("ok", ["5", "6"])))
    parsed = parse_rows(frame, MOBILE)
    assert sorted(rows_of(parsed, "label", "reject_reason"), key=str) == [("long", None), ("ok", None), ("short", "short_row")]
    out = reports.mobile_web_and_app(frame)
    assert sorted(rows_of(out, "media", "platform", "metric_value")) == [
        ("long", "App", 2.0), ("long", "Web", 1.0), ("ok", "App", 6.0), ("ok", "Web", 5.0),
    ]
    with pytest.raises(Exception, match="rejected report row"):
        reports.mobile_web_and_app(frame, strict=True).collect()
    with pytest.raises(Exception, match="short_row"):
        fail_on_reject(parsed).collect()


def test_same_media_in_two_categories_stays_twice(spark):
    frame = landing(spark, doc(DESKTOP_HEADER, row("A", ["c", "a", "1", "2"])), doc(DESKTOP_HEADER, row("A", ["c", "a", "1", "2"])))
    assert reports.desktop(frame).count() == 4


def test_small_texts(spark):
    texts = spark.createDataFrame(
        [
            ("<r><errors><e>queued</e></errors></r>", "<r><jobId> 77 </jobId></r>", "<summary><target>A &amp; B</target></summary>"),
            ("<r><errorsome/></r>", "<r/>", "<summary></summary><target>x</target>"),
            (None, "<c:jobid>5</c:jobid>", "<r/>"),
        ],
        "e string, j string, s string",
    )
    assert rows_of(texts, has_errors(F.col("e")), job_id(F.col("j")), summary_target(F.col("s"))) == [
        (True, "77", "A & B"), (False, None, None), (False, "5", None),
    ]


def test_parse_needs_no_python_and_no_shuffle(spark):
    plan = reports.desktop(landing(spark, "<r/>"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_random_tables_survive_the_round_trip(spark):
    rng = random.Random(11)
    alphabet = ["a", "B", "7", ".", "&", "<", ">", '"', "'", " ", "é", "ß", "漢", "&amp;", "&eacute;", "<td>", "</tr>", "\n", "=", "/"]
    text = lambda: "".join(rng.choice(alphabet) for _ in range(rng.randrange(9)))
    payloads, expected = [], []
    for d in range(150):
        n = rng.randrange(1, 6)
        rows, heads = [], [(text(), text() or None) for _ in range(n)]
        for r in range(rng.randrange(6)):
            label, wid, cells = text(), rng.choice([None, text()]), [text() for _ in range(rng.choice([n, n, n, n + 1, max(n - 1, 0)]))]
            tag = "" if wid is None else f' web_id="{html.escape(wid)}"'
            rows.append(f"<tr><th{tag}>{html.escape(label)}</th>{''.join(f'<td>{html.escape(c)}</td>' for c in cells)}</tr>")
            reason = "short_row" if len(cells) < n else "long_row" if len(cells) > n else None
            expected.append((f"r{d}", r, label.strip(), wid, [c.strip() for c in cells], [(m.strip(), i) for m, i in heads], reason))
        head = "".join(f"<td{'' if i is None else f' id={chr(34)}{html.escape(i)}{chr(34)}'}>{html.escape(m)}</td>" for m, i in heads)
        payloads.append(f"<e><table><thead><tr><th>x</th>{head}</tr></thead><tbody>{''.join(rows)}</tbody></table></e>")
    spec = AUDIENCE_DUPLICATION
    parsed = parse_rows(landing(spark, *payloads), spec)
    got = [
        (r.request_id, r.row_no, r.label, r.benchmark_media_id, r.cells, [(h.metric, h.metric_id) for h in r.header], r.reject_reason)
        for r in parsed.collect()
    ]
    assert sorted(got, key=lambda r: r[:2]) == sorted(expected, key=lambda r: r[:2])


def test_attribute_names_inside_other_values(spark):
    tags = {
        """title="see web_id='9' here" web_id="5" """: "5", " web_id=a/b x=1": "a/b", " data-web_id='1' web_id = '2'": "2", " x='web_id=3'": None, " Web_Id='4 > 3'": "4 > 3",
    }
    for tag, value in tags.items():
        assert spark.createDataFrame([(tag,)], "t string").select(attribute(F.col("t"), "web_id")).first()[0] == value, tag


def test_desktop_without_category_columns(spark):
    frame = landing(spark, doc(header([("v", "1"), ("w", "2")]), row("M", ["1", "2"])))
    out = reports.desktop(frame, DESKTOP.without_category_columns())
    assert sorted(rows_of(out, "category", "attribute", "metric", "metric_value")) == [("None", "None", "v", 1.0), ("None", "None", "w", 2.0)]


def test_one_split_of_documents_is_parsed_by_several_tasks(spark, tmp_path):
    texts = [f"a b c\n{i} {i}\nx y z" for i in range(200)] + [None, "", None]
    rows = [(i if i % 50 else None, t) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so few rows would be put together again
    try:
        tables = documents._line_tables(spark, str(tmp_path))
        assert tables.count() == len(rows)
        assert tables.select(F.spark_partition_id().alias("p")).distinct().count() > 1
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    found = documents.ragged_quarantine(spark, str(tmp_path))
    assert {tuple(r) for r in found.groupBy("reject_reason").agg(F.sum("n_rows"), F.sum("n_cells")).collect()} == {
        (None, 200, 600), ("short_row", 200, 400),
    }


def test_width_without_header_cells(spark):
    counted = parse_rows(landing(spark, doc(DESKTOP_HEADER, row("A", ["x"]))), documents.TEXT_LINES).select("width", "guard", "reject_reason")
    assert [tuple(r) for r in counted.collect()] == [(4, 4, "short_row")]
    # the attributes of the header's cells are not looked for where only their number counts
    assert r"id\s*=" not in counted._jdf.queryExecution().optimizedPlan().toString()
