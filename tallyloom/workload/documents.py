"""Round trips: aggregate a table, render it as report documents, parse them, build the report."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions.periods import month_start
from tallyloom.functions.text import strip
from tallyloom.operators.audience import cross_visit, duplication
from tallyloom.operators.grid import request_grid, with_request_id
from tallyloom.operators.parse import TAG, attribute, has_errors, job_id, parse_rows, parse_tables
from tallyloom.operators.render import collect_documents, data_row, document, fixed_row, header_row
from tallyloom.operators.signatures import only_known, register, unknown_headers
from tallyloom.plans import reports
from tallyloom.plans.specs import CROSS_VISITING_MEASURES, DESKTOP, LOCAL_MARKET, Layout, ReportSpec
from tallyloom.plans.staging import spread
from tallyloom.plans.workspace import new_folder
from tallyloom.sources.config import CATEGORY_SETS, TARGETS, TIMEFRAMES
from tallyloom.sources.landing import markets, ready_documents as pick_ready
from tallyloom.workload.registry import amount_text, as_double, as_text, cents, query, table

CATEGORY_ROWS = [{"categories": c} for c in CATEGORY_SETS]
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def finish(df: DataFrame, *doubles: str) -> DataFrame:
    return as_text(as_double(df, *doubles), "data_date")


@query("""
    WITH a AS (
      SELECT date_trunc('month', o_orderdate)::DATE AS d, o_orderpriority AS media, o_orderstatus AS category,
             count(*) AS n, sum(round(o_totalprice * 100)::BIGINT)::BIGINT AS total,
             max(round(o_totalprice * 100)::BIGINT) AS largest
      FROM orders GROUP BY ALL),
    m AS (
      SELECT *, 'Orders' AS metric, '1' AS metric_id, n::DOUBLE AS v FROM a
      UNION ALL SELECT *, 'Total Price & Tax', '2', total::DOUBLE / 100 FROM a
      UNION ALL SELECT *, 'Largest <Order>', '9', largest::DOUBLE / 100 FROM a),
    c(categories) AS (VALUES ('expanded categories'), ('topline categories'), ('custom entities'))
    SELECT media, CASE WHEN media = '5-LOW' THEN NULL WHEN media = '1-URGENT' THEN 'P' ELSE 'M' END AS media_type,
           left(media, 1) AS company_id, CASE WHEN media <> '3-MEDIUM' THEN '900' END AS parent_company_id, category,
           CASE category WHEN 'F' THEN 'Closed' ELSE 'Open' END AS attribute, metric, metric_id,
           v::FLOAT::DOUBLE AS metric_value, '1 month average' AS timeframe, strftime(d, '%B') AS month,
           year(d) AS year, 'Desktop Only' AS report_type, categories, d::VARCHAR AS data_date
    FROM m CROSS JOIN c""")
def roundtrip_one_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Desktop report: orders by month, priority and status."""
    return finish(reports.desktop(desktop_landing(spark, sf_dir, ["data_date", "categories"])), "metric_value")


def desktop_landing(spark: SparkSession, sf_dir: str, request: list[str]) -> DataFrame:
    """One document for each month and category set, with the request's labels; ``request`` names what the id is made of."""
    counted = (
        table(spark, sf_dir, "orders")
        .groupBy(month_start(F.col("o_orderdate")).alias("data_date"), "o_orderpriority", "o_orderstatus")
        .agg(
            F.count(F.lit(1)).alias("n"), F.sum(cents("o_totalprice")).alias("total"),
            F.max(cents("o_totalprice")).alias("largest"),
        )
    )
    media, status = F.col("o_orderpriority"), F.col("o_orderstatus")
    row = data_row(
        media,
        {
            "media_type": F.when(media == "1-URGENT", "[P]").when(media != "5-LOW", "[M]"),
            "web_id": F.left(media, F.lit(1)),
            "parent_id": F.when(media != "3-MEDIUM", "900"),
        },
        F.array(
            status, F.when(status == "F", "Closed").otherwise("Open"), F.col("n").cast("string"),
            amount_text("total"), amount_text("largest"),
        ),
    )
    ordered = counted.select("data_date", F.concat(media, status).alias("place"), row.alias("row"))
    header = fixed_row([
        ("Category", None), ("Attribute", None), ("Orders", "1"), ("Total Price & Tax", "2"), ("Largest <Order>", "9")
    ])
    docs = collect_documents(ordered, ["data_date"], "place").select(
        "data_date", document(F.col("rows_markup"), header).alias("payload")
    )
    grid = request_grid(docs, timeframes=TIMEFRAMES, categories=CATEGORY_ROWS)
    return with_request_id(grid, "desktop", request)


@query("""
    WITH a AS (
      SELECT ts::DATE::VARCHAR AS categories, event_type AS media, '2024-01-01' AS data_date,
             count(CASE WHEN value < 50 THEN 1 END) AS n_small, count(CASE WHEN value >= 50 THEN 1 END) AS n_large,
             sum(CASE WHEN value < 50 THEN round(value * 100)::BIGINT END)::BIGINT AS t_small,
             sum(CASE WHEN value >= 50 THEN round(value * 100)::BIGINT END)::BIGINT AS t_large
      FROM events GROUP BY ALL),
    m AS (
      SELECT *, 'Events' AS metric, '1' AS metric_id, 'Mobile Web' AS platform, n_small::DOUBLE AS v FROM a
      UNION ALL SELECT *, 'Value', '2', 'Mobile Web', t_small::DOUBLE / 100 FROM a
      UNION ALL SELECT *, 'Events', '1', 'Mobile App', n_large::DOUBLE FROM a
      UNION ALL SELECT *, 'Value', '2', 'Mobile App', t_large::DOUBLE / 100 FROM a)
    SELECT media, 'E' AS media_type, upper(left(media, 2)) AS company_id, NULL::VARCHAR AS parent_company_id, metric,
           metric_id, v::FLOAT::DOUBLE AS metric_value, platform, 'January' AS month, 2024 AS year,
           'Mobile Web & App' AS report_type, categories, data_date
    FROM m""")
def roundtrip_two_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mobile report: events by day and type under a platform header."""
    return finish(reports.mobile_web_and_app(mobile_landing(spark, sf_dir)), "metric_value")


def mobile_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document for each day of events, which stands for a category set."""
    value, small = F.col("value"), F.col("value") < 50
    counted = (
        table(spark, sf_dir, "events")
        .groupBy(F.col("ts").cast("date").alias("day"), "event_type")
        .agg(
            F.count_if(small).alias("n_small"), F.count_if(~small).alias("n_large"),
            F.sum(F.when(small, cents("value"))).alias("t_small"), F.sum(F.when(~small, cents("value"))).alias("t_large"),
        )
    )
    media = F.col("event_type")
    row = data_row(
        media, {"media_type": F.lit("[E]"), "web_id": F.upper(F.left(media, F.lit(2)))},
        F.array(F.col("n_small").cast("string"), amount_text("t_small"), F.col("n_large").cast("string"), amount_text("t_large")),
    )
    ordered = counted.select("day", "event_type", row.alias("row"))
    top = fixed_row([(p, None) for p in ("Mobile Web", "Mobile Web", "Mobile App", "Mobile App")])
    header = fixed_row([("Events", "1"), ("Value", "2"), ("Events", "1"), ("Value", "2")])
    docs = collect_documents(ordered, ["day"], "event_type").select(
        month_start(F.col("day")).alias("data_date"), F.col("day").cast("string").alias("categories"),
        document(F.col("rows_markup"), top, header).alias("payload"),
    )
    return with_request_id(docs, "mobile_web_and_app", ["categories"])


@query("""
    WITH a AS (
      SELECT c_nationkey, c_mktsegment AS media, count(*) AS n, sum(round(c_acctbal * 100)::BIGINT)::BIGINT AS total,
             max(round(c_acctbal * 100)::BIGINT) AS largest
      FROM customer GROUP BY ALL),
    m AS (
      SELECT *, 'Customers' AS metric, '1' AS metric_id, n::DOUBLE AS v FROM a
      UNION ALL SELECT *, 'Balance', '2', total::DOUBLE / 100 FROM a
      UNION ALL SELECT *, 'Largest', '3', CASE WHEN media <> 'MACHINERY' THEN largest::DOUBLE / 100 END FROM a),
    c(categories) AS (VALUES ('expanded categories'), ('topline categories'), ('custom entities'))
    SELECT media, 'S' AS media_type, left(media, 1) AS company_id, NULL::VARCHAR AS parent_company_id, metric,
           metric_id, v::FLOAT::DOUBLE AS metric_value, n_name || ', ' || left(r_name, 2) AS region,
           right(n_name || ', ' || left(r_name, 2), 2) AS state, n_nationkey::VARCHAR AS region_id,
           '1 month average' AS timeframe, 'March' AS month, 2019 AS year,
           'Local Market Single Region' AS report_type, categories, '2019-03-01' AS data_date
    FROM m JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey CROSS JOIN c""")
def roundtrip_local_market(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Market discovery, request grid and padded rows: customers by nation and segment."""
    nations = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    value = F.concat("n_name", F.lit(", "), F.left("r_name", F.lit(2)))
    tag = F.concat(F.lit('<EnumValue Id="'), "n_nationkey", F.lit('" Value="'), value, F.lit('" />'))
    discovery = nations.groupBy("r_name").agg(
        F.concat(F.lit("<Envelope><Values>"), F.array_join(F.array_sort(F.collect_list(tag)), ""), F.lit("</Values></Envelope>"))
        .alias("payload")
    )
    grid = request_grid(markets(discovery).drop("r_name"), timeframes=TIMEFRAMES, categories=CATEGORY_ROWS)
    requests = with_request_id(grid, "local_market", ["region_id", "categories"])

    counted = (
        table(spark, sf_dir, "customer")
        .groupBy(F.col("c_nationkey").alias("region_id"), "c_mktsegment")
        .agg(
            F.count(F.lit(1)).alias("n"), F.sum(cents("c_acctbal")).alias("total"),
            F.max(cents("c_acctbal")).alias("largest"),
        )
    )
    media = F.col("c_mktsegment")
    full = F.array(F.col("n").cast("string"), amount_text("total"), amount_text("largest"))
    row = data_row(
        media, {"media_type": F.lit("[S]"), "web_id": F.left(media, F.lit(1))},
        F.when(media == "MACHINERY", F.slice(full, 1, 2)).otherwise(full),
    )
    ordered = counted.select("region_id", "c_mktsegment", row.alias("row"))
    header = fixed_row([("Customers", "1"), ("Balance", "2"), ("Largest", "3")])
    docs = collect_documents(ordered, ["region_id"], "c_mktsegment").select(
        "region_id", F.lit("2019-03-01").cast("date").alias("data_date"),
        document(F.col("rows_markup"), header).alias("payload"),
    )
    landed = with_request_id(request_grid(docs, categories=CATEGORY_ROWS), "local_market", ["region_id", "categories"])
    landing = reports.attach_requests(landed.select("request_id", "data_date", "payload"), requests)
    return finish(reports.local_market(landing, LOCAL_MARKET), "metric_value")


@query("""
    WITH a AS (
      SELECT p_type, p_brand, p_size % 45 AS i, count(*) AS n FROM part GROUP BY ALL),
    g AS (
      SELECT p_type, p_brand, i FROM (SELECT DISTINCT p_type, p_brand FROM part), range(45) t(i))
    SELECT g.p_brand AS media, NULL::VARCHAR AS media_type, split_part(g.p_brand, '#', 2) AS company_id,
           NULL::VARCHAR AS parent_company_id, lower(g.p_type) AS category,
           CASE WHEN g.p_type IN ('STANDARD', 'LARGE') THEN 'Size' ELSE 'None' END AS attribute,
           'Size ' || g.i AS metric, (276 + g.i)::VARCHAR AS metric_id, coalesce(n, 0)::FLOAT::DOUBLE AS metric_value,
           CASE WHEN g.i % 2 = 0 THEN 'Desktop' ELSE 'Mobile' END AS platform, 'March' AS month, 2019 AS year,
           'Multi-platform Only' AS report_type, g.p_type AS categories, '2019-03-01' AS data_date
    FROM g LEFT JOIN a ON g.p_type = a.p_type AND g.p_brand = a.p_brand AND g.i = a.i""")
def layout_dispatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Multi-platform report in its three widths: parts by brand and size class."""
    n = 45
    counted = (
        table(spark, sf_dir, "part").groupBy("p_type", "p_brand")
        .agg(*[F.count_if(F.col("p_size") % n == i).cast("string").alias(f"_{i}") for i in range(n)])
    )
    wide = F.col("p_type").isin("STANDARD", "LARGE")
    shifted = F.col("p_type").isin("ECONOMY", "SMALL")
    values = F.array(*[F.col(f"_{i}") for i in range(n)])
    keys = F.when(wide, F.array(F.lower("p_type"), F.lit("Size"))).otherwise(F.array(F.lower("p_type")))
    row = data_row(F.col("p_brand"), {"web_id": F.split_part("p_brand", F.lit("#"), F.lit(2))}, F.concat(keys, values))
    ordered = counted.select("p_type", "p_brand", row.alias("row"))

    platforms = [("Desktop" if i % 2 == 0 else "Mobile", None) for i in range(n)]
    metrics = [(f"Size {i}", str(276 + i)) for i in range(n)]
    category, keys = [("Category", None)], [("Category", None), ("Attribute", None)]
    both = lambda top, header: F.concat(fixed_row(top), fixed_row(header, "Media"))
    headers = (
        F.when(wide, both(keys + platforms, keys + metrics))
        .when(shifted, both(platforms, category + metrics))
        .otherwise(both(category + platforms, category + metrics))
    )
    docs = collect_documents(ordered, ["p_type"], "p_brand").select(
        F.col("p_type").alias("categories"), F.lit("2019-03-01").cast("date").alias("data_date"),
        document(F.col("rows_markup"), headers).alias("payload"),
    )
    landing = with_request_id(docs, "multi_platform", ["categories"])
    return finish(reports.multi_platform(landing), "metric_value")


TEXT_LINES = ReportSpec(
    name="text_lines", header_rows=1, label="line", attributes={}, layouts=(Layout(),), ragged="drop", schema=None,
)


@query("""
    WITH l AS (
      SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) AS line_no,
             len(string_split(string_split(text, chr(10))[1], ' ')) AS expected,
             unnest(string_split(text, chr(10))) AS line
      FROM documents),
    w AS (SELECT doc_id, expected, len(string_split(line, ' ')) AS n, length(replace(line, ' ', '')) AS chars
          FROM l WHERE line_no > 1)
    SELECT doc_id, CASE WHEN n < expected THEN 'short_row' WHEN n > expected THEN 'long_row' END AS reject_reason,
           count(*) AS n_rows, sum(n)::BIGINT AS n_cells, sum(chars)::BIGINT AS n_chars
    FROM w GROUP BY ALL""")
def ragged_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a table: lines are rows, words are cells, the first line sets the width."""
    parsed = parse_rows(_line_tables(spark, sf_dir), TEXT_LINES)
    chars = F.length(F.array_join("cells", ""))
    return parsed.groupBy("doc_id", "reject_reason").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(F.size("cells")).alias("n_cells"),
        F.sum(chars).alias("n_chars"),
    )


def _line_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = F.split("text", "\n")
    words = lambda line: F.split(line, " ")
    first = F.transform(words(F.get(lines, F.lit(0))), lambda x: F.struct(x.alias("metric"), F.lit(None).cast("string").alias("metric_id")))
    rest = F.slice(lines, F.lit(2), F.greatest(F.size(lines) - 1, F.lit(0)))
    rows = F.transform(rest, lambda line, i: data_row(i.cast("string"), {}, words(line)))
    # rendering and parsing cost far more than an exchange of the texts, and one file may be a single split
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id", "text").select(
        "doc_id", document(F.array_join(rows, ""), header_row("line", first)).alias("payload")
    )
    return docs


@query("""
    WITH l AS (
      SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents WHERE len(string_split(text, chr(10))) > 1),
    w AS (SELECT doc_id, len(string_split(lines[2], ' ')) AS expected, len(string_split(unnest(lines[2:]), ' ')) AS n FROM l)
    SELECT doc_id, count(*) AS scanned, count(*) FILTER (n >= expected) AS kept, count(*) FILTER (n < expected) AS rejected,
           coalesce(sum(expected - n) FILTER (n < expected), 0)::BIGINT AS n_lacking
    FROM w GROUP BY ALL""")
def first_row_reconciled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same tables under the older rule, where the first data row's width is the guard and longer rows pass: scanned,
    kept and quarantined rows of each, and the cells the quarantined ones lack."""
    older = replace(TEXT_LINES, ragged="strict").with_width_from("first_row")
    parsed = parse_rows(_line_tables(spark, sf_dir), older)
    gone, lacking = F.col("reject_reason").isNotNull(), F.col("guard") - F.size("cells")
    return parsed.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("scanned"), F.count_if(~gone).alias("kept"), F.count_if(gone).alias("rejected"),
        F.coalesce(F.sum(F.when(gone, lacking)), F.lit(0)).alias("n_lacking"),
    )


@query(r"""
    WITH p AS (
      SELECT page_id, unnest(regexp_extract_all(html, '(?is)<a\s+href="([^"]*)"[^>]*>(.*?)</a>', 1)) AS href,
             unnest(regexp_extract_all(html, '(?is)<a\s+href="([^"]*)"[^>]*>(.*?)</a>', 2)) AS label,
             generate_subscripts(regexp_extract_all(html, '(?is)<a\s+href="([^"]*)"[^>]*>(.*?)</a>', 1), 1) - 1 AS pos
      FROM pages)
    SELECT page_id, pos, href, trim(label) AS label, CASE WHEN starts_with(href, '/') THEN NULL ELSE href END AS absolute
    FROM p""")
def attribute_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of raw pages: text and attribute, with an attribute that may be absent."""
    links = F.regexp_extract_all("html", F.lit(r"(?is)<a(\s+[^>]*>.*?)</a>"), F.lit(1))
    found = table(spark, sf_dir, "pages").select("page_id", F.posexplode(links).alias("pos", "link"))
    href = attribute(F.regexp_extract("link", f"^({TAG})>", 1), "href")
    label = strip(F.regexp_replace("link", f"^{TAG}>", ""))
    return found.select("page_id", "pos", href.alias("href"), label.alias("label"), F.when(~href.startswith("/"), href).alias("absolute"))


@query("""
    SELECT conv_id, turn AS attempt, conv_id::VARCHAR || '-' || turn::VARCHAR AS job_id, length(text) AS n_chars
    FROM conversations WHERE role = 'assistant'
    QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) = 1""")
def ready_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns as landed answers, ready when the assistant speaks: the newest ready one per conversation."""
    answer = F.concat(
        F.lit("<Envelope><jobId> "), F.concat_ws("-", F.col("conv_id"), F.col("turn")), F.lit(" </jobId>"),
        F.when(F.col("role") != "assistant", F.lit("<errors>queued</errors>")).otherwise(F.lit("")),
        F.lit("</Envelope>"),
    )
    landing = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("request_id"), F.col("turn").alias("attempt"), answer.alias("payload"),
        F.length("text").alias("n_chars"),
    )
    return pick_ready(landing.withColumn("is_ready", ~has_errors(F.col("payload")))).select(
        F.col("request_id").alias("conv_id"), "attempt", job_id(F.col("payload")).alias("job_id"), "n_chars"
    )


_OVERLAP = """
    p AS (SELECT DISTINCT o_custkey AS u, o_orderpriority AS m FROM orders),
    aud AS (SELECT m, count(*) AS n FROM p GROUP BY m),
    total AS (SELECT count(DISTINCT u) AS n FROM p),
    shared AS (SELECT a.m AS a, b.m AS b, count(*) AS n FROM p a JOIN p b ON a.u = b.u AND a.m <> b.m GROUP BY ALL)"""


@query(f"""
    WITH {_OVERLAP},
    t(k) AS (VALUES ('target 23'), ('target 5'), ('target 106'), ('target 107'), ('targetGroup 15')),
    g AS (SELECT x.m AS a, y.m AS b FROM aud x, aud y)
    SELECT g.a AS benchmark_media, left(g.a, 1) AS benchmark_media_id, k AS demographic, g.b AS comparison_media,
           'Total Audience' AS media_target_audience,
           (s.n::DOUBLE * 100 / x.n)::FLOAT::DOUBLE AS per_benchmark_media_visit_comparison_media,
           (s.n::DOUBLE * 100 / y.n)::FLOAT::DOUBLE AS per_comparision_media_visit_benchmark_media,
           (s.n::DOUBLE * 100 * total.n / (x.n::DOUBLE * y.n))::FLOAT::DOUBLE AS "index",
           s.n::FLOAT::DOUBLE AS shared_audience_000, 'March' AS month, 2019 AS year, 'Desktop' AS platform,
           '1 month average' AS timeframe, '2019-03-01' AS data_date
    FROM g JOIN aud x ON x.m = g.a JOIN aud y ON y.m = g.b CROSS JOIN total CROSS JOIN t
    LEFT JOIN shared s ON s.a = g.a AND s.b = g.b""")
def report_cross_visiting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cross-visiting from raw orders to documents and back to the pair matrix."""
    orders = table(spark, sf_dir, "orders")
    overlap = cross_visit(orders, "o_orderpriority", "o_custkey", PRIORITIES)
    values = F.array("vertical", "horizontal", "index", F.col("shared").cast("double"))
    per_media = overlap.groupBy("benchmark").agg(
        F.map_from_entries(F.collect_list(F.struct("comparison", F.transform(values, lambda v: v.cast("string"))))).alias("cells")
    )
    blank = F.array(*[F.lit("")] * 4)
    cells = F.concat(
        F.array(F.lit("Total Audience")),
        *[F.coalesce(F.try_element_at("cells", F.lit(p)), blank) for p in PRIORITIES],
    )
    row = data_row(F.col("benchmark"), {"web_id": F.left("benchmark", F.lit(1))}, cells)
    ordered = per_media.select(F.lit("2019-03-01").cast("date").alias("data_date"), "benchmark", row.alias("row"))
    measures = [(name, str(number)) for number, name in CROSS_VISITING_MEASURES.items()]
    header = fixed_row([("Target Audience", None), *measures * len(PRIORITIES)])
    top = fixed_row([("", None), *[(p, None) for p in PRIORITIES for _ in measures]])
    docs = collect_documents(ordered, ["data_date"], "benchmark")
    grid = request_grid(docs, timeframes=TIMEFRAMES, targets=TARGETS)
    target = F.concat_ws(" ", "target_key", F.col("target_value").cast("string"))
    landing = with_request_id(grid, "cross_visiting", ["target_key", "target_value"]).select(
        "request_id", "data_date", "timeframe", document(F.col("rows_markup"), top, header, target=target).alias("payload")
    )
    return finish(
        reports.cross_visiting(landing), "per_benchmark_media_visit_comparison_media",
        "per_comparision_media_visit_benchmark_media", "index", "shared_audience_000",
    )


MEDIA_SETS = {"urgent and low": ["1-URGENT", "5-LOW"], "urgent and high": ["1-URGENT", "2-HIGH"]}


@query("""
    WITH sets(media_set, m) AS (VALUES ('urgent and low', '1-URGENT'), ('urgent and low', '5-LOW'),
      ('urgent and high', '1-URGENT'), ('urgent and high', '2-HIGH')),
    p AS (SELECT o_custkey AS u, o_orderpriority AS m, count(*) AS n FROM orders GROUP BY ALL),
    per_media AS (SELECT m, count(*) AS visitors, sum(n)::BIGINT AS pages FROM p GROUP BY ALL),
    per_user AS (SELECT media_set, u, count(*) AS n FROM p JOIN sets USING (m) GROUP BY ALL),
    s AS (SELECT media_set, count(CASE WHEN n = 2 THEN 1 END) AS dup, count(*) AS net FROM per_user GROUP BY ALL),
    f AS (
      SELECT media_set, m, 'Total Unique Visitors (000)' AS metrics, '1' AS metric_id, visitors AS v, dup, net
      FROM sets JOIN per_media USING (m) JOIN s USING (media_set)
      UNION ALL
      SELECT media_set, m, 'Total Pages Viewed (MM)', '3', pages, NULL, NULL FROM sets JOIN per_media USING (m))
    SELECT a.m AS benchmark_media, left(a.m, 1) AS benchmark_media_id, a.metrics, a.metric_id,
           a.v::FLOAT::DOUBLE AS benchmark_metric_value, a.media_set AS demographic,
           a.dup::FLOAT::DOUBLE AS duplicated_all_sites, a.net::FLOAT::DOUBLE AS unduplicated,
           b.m AS comparision_media, 'March' AS month, 2019 AS year, 'Desktop' AS platform,
           '1 month average' AS timeframe, '2019-03-01' AS data_date
    FROM f a JOIN sets b ON a.media_set = b.media_set AND a.m <> b.m""")
def report_audience_duplication(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Duplication from raw orders to documents and back to the paired table."""
    orders = table(spark, sf_dir, "orders")
    per_media = (
        orders.groupBy("o_custkey", "o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
        .groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("visitors"), F.sum("n").alias("pages"))
    )
    names = F.create_map(*[
        x for m in PRIORITIES
        for x in (F.lit(m), F.array(*[F.lit(s) for s, ms in MEDIA_SETS.items() if m in ms]).cast("array<string>"))
    ])
    media_rows = per_media.select(
        F.explode(F.try_element_at(names, F.col("o_orderpriority"))).alias("media_set"),
        F.concat(F.lit("0"), "o_orderpriority").alias("place"),
        data_row(
            F.col("o_orderpriority"), {"web_id": F.left("o_orderpriority", F.lit(1))},
            F.array(F.col("visitors").cast("string"), F.col("pages").cast("string")),
        ).alias("row"),
    )
    summary = duplication(orders, "o_orderpriority", "o_custkey", MEDIA_SETS)
    labels = {
        "Duplicated (2 or more sites)": "duplicated_2_or_more_sites",
        "Duplicated (all sites)": "duplicated_all_sites",
        "Unduplicated": "unduplicated",
    }
    summary_rows = summary.select(
        "media_set",
        F.inline(F.array(*[
            F.struct(
                F.lit(f"1{label}").alias("place"),
                data_row(F.lit(label), {}, F.array(F.col(column).cast("string"), F.lit("-"))).alias("row"),
            )
            for label, column in labels.items()
        ])),
    )
    docs = collect_documents(media_rows.unionByName(summary_rows), ["media_set"], "place")
    header = fixed_row([("Total Unique Visitors (000)", "1"), ("Total Pages Viewed (MM)", "3")])
    ids = F.create_map(*[x for s, ms in MEDIA_SETS.items() for x in (F.lit(s), F.array(*[F.lit(m[0]) for m in ms]))])
    grid = request_grid(docs, timeframes=TIMEFRAMES)
    landing = with_request_id(grid, "audience_duplication", ["media_set"]).select(
        "request_id", "timeframe", F.lit("2019-03-01").cast("date").alias("data_date"),
        F.try_element_at(ids, F.col("media_set")).alias("media_ids"),
        document(F.col("rows_markup"), header, target=F.col("media_set")).alias("payload"),
    )
    return finish(
        reports.audience_duplication(landing), "benchmark_metric_value", "duplicated_all_sites", "unduplicated"
    )


@query("""
    WITH a AS (SELECT DISTINCT date_trunc('month', o_orderdate)::DATE AS d, o_orderpriority, o_orderstatus FROM orders),
    m AS (SELECT d, count(*) AS n FROM a GROUP BY d),
    c(categories) AS (VALUES ('expanded categories'), ('topline categories'), ('custom entities')),
    x AS (SELECT d, categories, n, (month(d) % 6 = 0)::INT AS renamed, (month(d) % 4 = 0)::INT AS swapped, (month(d) % 11 = 0)::INT AS other FROM m CROSS JOIN c)
    SELECT d::VARCHAR AS data_date, categories, CASE WHEN renamed + swapped + other > 0 THEN 'unknown_header' END AS reject_reason,
           CASE WHEN renamed + swapped + other > 0 THEN 'january' END AS nearest,
           CASE WHEN renamed + swapped + other > 0 THEN renamed + 2 * swapped + other END AS distance,
           CASE WHEN renamed + swapped + other > 0 THEN 0 ELSE 3 * n END AS n_facts
    FROM x""")
def header_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Desktop answers whose headers change in some months but keep their width: a measure renamed, two measures swapped, another
    row label. The headers of the Januaries are the known ones; the rest are caught with the nearest of them."""
    month = F.month("data_date")
    changed = lambda payload, when, old, new: F.when(when, F.replace(payload, F.lit(old), F.lit(new))).otherwise(payload)
    first, second = '<td id="1">Orders</td>', '<td id="2">Total Price &amp; Tax</td>'
    payload = changed(F.col("payload"), month % 6 == 0, "Largest &lt;Order&gt;", "Largest Order")
    payload = changed(payload, month % 4 == 0, first + second, second + first)
    payload = changed(payload, month % 11 == 0, "<THEAD><tr><th></th>", "<THEAD><tr><th>Site</th>")
    landed = desktop_landing(spark, sf_dir, ["data_date", "categories"]).withColumns({"payload": payload, "report": F.lit("desktop")})
    folder = new_folder(spark, "headers")
    landed.write.parquet(f"{folder}/landing")
    landing = spark.read.parquet(f"{folder}/landing")
    register(parse_tables(landing.filter(month == 1), DESKTOP), "january").write.parquet(f"{folder}/registry")
    registry = spark.read.parquet(f"{folder}/registry")
    strange = unknown_headers(parse_tables(landing, DESKTOP), registry).select("data_date", "categories", "reject_reason", "nearest", "distance", F.lit(0).cast("bigint").alias("n_facts"))
    facts = reports.desktop(landing, watch=only_known(registry)).groupBy("data_date", "categories").agg(F.count(F.lit(1)).alias("n_facts"))
    blank = {c: F.lit(None).cast(t) for c, t in (("reject_reason", "string"), ("nearest", "string"), ("distance", "int"))}
    return as_text(strange.unionByName(facts.withColumns(blank)), "data_date")
