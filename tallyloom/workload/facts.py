"""Queries on labels, numbers, unpivot, pivot, splits, joins and pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions.numbers import nan_to_null, to_number
from tallyloom.functions.periods import month_start, period_id, period_labels
from tallyloom.operators.audience import timeframe_average, top_entities
from tallyloom.operators.grid import decorate_measures, report_query as run_report_query, request_grid as make_grid
from tallyloom.operators.quality import missing_requests as find_missing
from tallyloom.operators.reshape import (
    attach_summary,
    concat_reports,
    pair_reversed,
    pair_up as make_pairs,
    pivot_strict,
    ranked_positions,
    split_by_member,
    unpivot,
)
from tallyloom.sources.config import CATEGORY_SETS, TIMEFRAMES
from tallyloom.workload.registry import as_text, cents, query, table

MEASURES = {"1": "Lines", "2": "Quantity", "3": "Revenue"}


def _monthly_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem by month and return flag, unpivoted to one row per measure."""
    wide = (
        table(spark, sf_dir, "lineitem")
        .groupBy(month_start(F.col("l_shipdate")).alias("data_date"), F.col("l_returnflag").alias("media"))
        .agg(
            F.count(F.lit(1)).cast("double").alias("1"),
            F.sum(F.col("l_quantity").cast("bigint")).cast("double").alias("2"),
            (F.sum(cents("l_extendedprice")).cast("double") / 100).alias("3"),
        )
    )
    return unpivot(wide, ["data_date", "media"], list(MEASURES), "metric_id", "metric_value")


_MONTHLY = """
    agg AS (
      SELECT date_trunc('month', l_shipdate)::DATE AS d, l_returnflag AS media, count(*)::DOUBLE AS lines,
             sum(l_quantity::BIGINT)::DOUBLE AS quantity,
             sum(round(l_extendedprice * 100)::BIGINT)::DOUBLE / 100 AS revenue
      FROM lineitem GROUP BY ALL),
    facts AS (
      SELECT d, media, '1' AS metric_id, 'Lines' AS metric, lines AS metric_value FROM agg
      UNION ALL SELECT d, media, '2', 'Quantity', quantity FROM agg
      UNION ALL SELECT d, media, '3', 'Revenue', revenue FROM agg)"""


@query(f"""
    WITH {_MONTHLY}
    SELECT d::VARCHAR AS data_date, media, metric, metric_id, metric_value::FLOAT::DOUBLE AS metric_value,
           strftime(d, '%B') AS month, year(d) AS year,
           (year(d) - 2015) * 12 + month(d) - 1 + 181 AS period_id
    FROM facts""")
def key_measures_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = decorate_measures(_monthly_measures(spark, sf_dir), MEASURES)
    day = F.col("data_date")
    labelled = facts.withColumns({**period_labels(day), "period_id": period_id(day)})
    return labelled.select(
        day.cast("string").alias("data_date"), "media", F.col("metric_name").alias("metric"), "metric_id",
        F.col("metric_value").cast("float").cast("double").alias("metric_value"), "month", "year", "period_id",
    )


@query("""
    WITH wide AS (
      SELECT event_type, date_trunc('day', ts)::DATE::VARCHAR AS day,
             CASE WHEN event_type <> 'error' THEN round(value * 100)::BIGINT END AS answered,
             CASE WHEN value >= 50 THEN round(value * 100)::BIGINT END AS large
      FROM events),
    long AS (
      SELECT event_type, day, 'answered' AS metric, answered AS v FROM wide
      UNION ALL SELECT event_type, day, 'large', large FROM wide)
    SELECT event_type, day, metric, count(*) AS n_rows, count(*) - count(v) AS n_null, sum(v)::BIGINT AS total
    FROM long GROUP BY ALL""")
def unpivot_nulls_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = table(spark, sf_dir, "events").select(
        "event_type", F.col("ts").cast("date").cast("string").alias("day"),
        F.when(F.col("event_type") != "error", cents("value")).alias("answered"),
        F.when(F.col("value") >= 50, cents("value")).alias("large"),
    )
    long = unpivot(wide, ["event_type", "day"], ["answered", "large"], "metric", "v")
    return long.groupBy("event_type", "day", "metric").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("v").isNull()).alias("n_null"), F.sum("v").alias("total")
    )


_NUMBER_SQL = r"^[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?)$"


@query(rf"""
    WITH texts AS (
      SELECT o_orderstatus, unnest([
        {{'kind': 'plain', 't': o_custkey::VARCHAR}},
        {{'kind': 'padded', 't': ' ' || o_custkey::VARCHAR || chr(9)}},
        {{'kind': 'grouped', 't': o_custkey::VARCHAR || ',000'}},
        {{'kind': 'suffixed', 't': o_custkey::VARCHAR || 'd'}},
        {{'kind': 'signed', 't': '+' || o_custkey::VARCHAR || '.'}},
        {{'kind': 'scaled', 't': o_custkey::VARCHAR || 'e2'}},
        {{'kind': 'label', 't': o_orderpriority}},
        {{'kind': 'first', 't': left(o_orderpriority, 1)}},
        {{'kind': 'underscored', 't': o_custkey::VARCHAR || '_0'}},
        {{'kind': 'dash', 't': '-'}}], recursive := true)
      FROM orders),
    parsed AS (
      SELECT o_orderstatus, kind,
             CASE WHEN regexp_matches(trim(t, ' ' || chr(9)), '{_NUMBER_SQL}')
                  THEN trim(t, ' ' || chr(9))::DOUBLE END AS v
      FROM texts)
    SELECT o_orderstatus, kind, count(*) AS n, count(v) AS n_numbers, sum(v::BIGINT)::BIGINT AS total
    FROM parsed GROUP BY ALL""")
def numeric_coerce(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, priority = F.col("o_custkey").cast("string"), F.col("o_orderpriority")
    texts = {
        "plain": key,
        "padded": F.concat(F.lit(" "), key, F.lit("\t")),
        "grouped": F.concat(key, F.lit(",000")),
        "suffixed": F.concat(key, F.lit("d")),
        "signed": F.concat(F.lit("+"), key, F.lit(".")),
        "scaled": F.concat(key, F.lit("e2")),
        "label": priority,
        "first": F.left(priority, F.lit(1)),
        "underscored": F.concat(key, F.lit("_0")),
        "dash": F.lit("-"),
    }
    wide = table(spark, sf_dir, "orders").select("o_orderstatus", *[c.alias(k) for k, c in texts.items()])
    parsed = unpivot(wide, ["o_orderstatus"], list(texts), "kind", "t").withColumn("v", to_number(F.col("t")))
    return parsed.groupBy("o_orderstatus", "kind").agg(
        F.count(F.lit(1)).alias("n"), F.count("v").alias("n_numbers"),
        F.sum(F.col("v").cast("bigint")).alias("total"),
    )


@query("""
    SELECT l_returnflag, l_linestatus, count(*) AS n,
           count(CASE WHEN l_tax = 0 THEN 1 END) AS n_null,
           sum(CASE WHEN l_tax <> 0 THEN round(l_extendedprice * 100)::BIGINT END)::BIGINT AS total
    FROM lineitem GROUP BY ALL""", name="nan_to_null")
def nan_to_null_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    dirty = table(spark, sf_dir, "lineitem").select(
        "l_returnflag", "l_linestatus",
        F.when(F.col("l_tax") == 0, float("nan")).otherwise(F.col("l_extendedprice")).alias("price"),
    )
    return nan_to_null(dirty).groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("price").isNull()).alias("n_null"),
        F.sum(cents("price")).alias("total"),
    )


@query("""
    SELECT date_trunc('month', o_orderdate)::DATE::VARCHAR AS data_date, strftime(o_orderdate, '%B') AS month,
           year(o_orderdate) AS year,
           (year(o_orderdate) - 2015) * 12 + month(o_orderdate) - 1 + 181 AS period_id, count(*) AS n
    FROM orders GROUP BY ALL""", name="period_labels")
def period_labels_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    months = table(spark, sf_dir, "orders").groupBy(month_start(F.col("o_orderdate")).alias("data_date"))
    day = F.col("data_date")
    counted = months.agg(F.count(F.lit(1)).alias("n")).withColumns({**period_labels(day), "period_id": period_id(day)})
    return as_text(counted, "data_date")


@query("""
    SELECT n_name AS nation, c_mktsegment AS segment, count(*) AS customers,
           sum(round(c_acctbal * 100)::BIGINT)::BIGINT AS balance, max(round(c_acctbal * 100)::BIGINT) AS largest
    FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL""")
def pivot_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Aggregate, unpivot to long facts, pivot back with pinned labels and a uniqueness check."""
    wide = (
        table(spark, sf_dir, "customer")
        .groupBy("c_nationkey", F.col("c_mktsegment").alias("segment"))
        .agg(F.count(F.lit(1)).alias("c"), F.sum(cents("c_acctbal")).alias("b"), F.max(cents("c_acctbal")).alias("l"))
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .withColumnRenamed("n_name", "nation")
    )
    long = unpivot(wide, ["nation", "segment"], ["c", "b", "l"])
    return pivot_strict(
        long, ["nation", "segment"], "metric", "metric_value", {"c": "customers", "b": "balance", "l": "largest"}
    )


@query("""
    WITH f AS (
      SELECT year(o_orderdate) AS year, o_orderpriority AS media, o_orderstatus AS metric, count(*) AS v
      FROM orders GROUP BY ALL),
    s AS (
      SELECT year, metric, max(CASE WHEN media = '3-MEDIUM' THEN v END) AS medium,
             max(CASE WHEN media = '4-NOT SPECIFIED' THEN v END) AS unspecified,
             max(CASE WHEN media = '5-LOW' THEN v END) AS low
      FROM f WHERE NOT coalesce(media IN ('1-URGENT', '2-HIGH'), false) GROUP BY ALL)
    SELECT f.year, f.media, f.metric, f.v, s.medium, s.unspecified, s.low
    FROM f LEFT JOIN s ON f.year = s.year AND f.metric = s.metric WHERE f.media IN ('1-URGENT', '2-HIGH')""")
def pivot_summary_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Split the media from the rest, pivot the rest, join it back by metric."""
    facts = (
        table(spark, sf_dir, "orders")
        .groupBy(F.year("o_orderdate").alias("year"), F.col("o_orderpriority").alias("media"), F.col("o_orderstatus").alias("metric"))
        .agg(F.count(F.lit(1)).alias("v"))
    )
    listed, rest = split_by_member(facts, "media", ["1-URGENT", "2-HIGH"], shared=True)
    names = {"3-MEDIUM": "medium", "4-NOT SPECIFIED": "unspecified", "5-LOW": "low"}
    summary = pivot_strict(rest, ["year", "metric"], "media", "v", names)
    return attach_summary(listed, summary, ["year", "metric"], list(names.values()))


SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@query("""
    WITH f AS (
      SELECT year(o_orderdate) AS year, c_mktsegment AS media, o_orderstatus AS metric, count(*) AS v
      FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL)
    SELECT a.year, a.metric, a.media, a.v, b.media AS companion, b.v AS companion_v
    FROM f a JOIN f b ON a.year = b.year AND a.metric = b.metric AND a.media <> b.media""")
def pair_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Orders are counted per customer before the join, so that a customer with very many orders is one row per group.
    per_customer = (
        table(spark, sf_dir, "orders")
        .groupBy("o_custkey", F.year("o_orderdate").alias("year"), F.col("o_orderstatus").alias("metric"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    customer = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_mktsegment").alias("media"))
    facts = (
        per_customer.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("year", "media", "metric")
        .agg(F.sum("n").alias("v"))
    )
    return make_pairs(facts, ["year", "metric"], "media", SEGMENTS, "v")


@query("""
    WITH p AS (
      SELECT conv_id, turn, role, length(text) AS n_chars,
             row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS fwd,
             row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS bwd
      FROM conversations)
    SELECT a.conv_id, a.turn, a.role, b.role AS mirrored_role, b.n_chars AS mirrored_n_chars
    FROM p a LEFT JOIN p b ON a.conv_id = b.conv_id AND a.fwd = b.bwd""")
def pair_reverse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every turn beside the turn at the same place read from the end."""
    turns = table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", "role", F.length("text").cast("bigint").alias("n_chars")
    )
    return pair_reversed(turns, ["conv_id"], "turn", ["role", "n_chars"]).drop("n_chars")


@query("""
    WITH p AS (
      SELECT nullif(conv_id // 10, 0) AS g, conv_id * 1000 + turn AS place, role,
             row_number() OVER (PARTITION BY nullif(conv_id // 10, 0) ORDER BY conv_id, turn) AS fwd,
             row_number() OVER (PARTITION BY nullif(conv_id // 10, 0) ORDER BY conv_id DESC, turn DESC) AS bwd
      FROM conversations WHERE turn % 3 <> 1)
    SELECT a.g, a.place, a.role, b.role AS mirrored_role
    FROM p a JOIN p b ON a.g IS NOT DISTINCT FROM b.g AND a.fwd = b.bwd""")
def pair_reverse_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same over turns with gaps, where the places are ranked first; the first ten conversations have no group."""
    turns = table(spark, sf_dir, "conversations").where("turn % 3 <> 1").select(
        F.expr("nullif(conv_id div 10, 0)").alias("g"), (F.col("conv_id") * 1000 + F.col("turn")).alias("place"), "role"
    )
    return pair_reversed(ranked_positions(turns, ["g"], "place", "at"), ["g"], "at", ["role"]).drop("at")


@query("""
    SELECT CASE WHEN coalesce(nullif(c_mktsegment, 'HOUSEHOLD') IN ('BUILDING', 'MACHINERY'), false)
                THEN 'in' ELSE 'out' END AS part,
           nullif(c_mktsegment, 'HOUSEHOLD') AS segment, count(*) AS n
    FROM orders LEFT JOIN customer ON o_custkey = c_custkey GROUP BY ALL""")
def not_in_null_safe(spark: SparkSession, sf_dir: str) -> DataFrame:
    per_customer = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    customer = table(spark, sf_dir, "customer").select(
        "c_custkey", F.nullif(F.col("c_mktsegment"), F.lit("HOUSEHOLD")).alias("segment")
    )
    counted = per_customer.join(customer, F.col("o_custkey") == F.col("c_custkey"), "left")
    counted = counted.groupBy("segment").agg(F.sum("n").alias("n"))
    inside, outside = split_by_member(counted, "segment", ["BUILDING", "MACHINERY"], shared=True)
    return concat_reports(inside.withColumn("part", F.lit("in")), outside.withColumn("part", F.lit("out")))


@query("""
    WITH m AS (SELECT DISTINCT c_nationkey AS region_id FROM customer),
    c(categories, media_set, media_set_type) AS (VALUES ('expanded categories', 778228, 2),
      ('topline categories', 20, 2), ('custom entities', 23, 2))
    SELECT region_id, '1 month average' AS timeframe, 1 AS time_type, categories, media_set, media_set_type
    FROM m CROSS JOIN c""")
def request_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    markets = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("region_id")).distinct()
    sets = [
        {"categories": name, "media_set": number, "media_set_type": kind}
        for name, (number, kind) in CATEGORY_SETS.items()
    ]
    return make_grid(markets, timeframes=TIMEFRAMES, categories=sets)


PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@query("""
    WITH g AS (
      SELECT c_custkey AS request, p AS priority
      FROM customer, (VALUES ('1-URGENT'), ('2-HIGH'), ('3-MEDIUM'), ('4-NOT SPECIFIED'), ('5-LOW')) t(p))
    SELECT g.request, g.priority FROM g
    ANTI JOIN orders ON o_custkey = request AND o_orderpriority = priority""")
def missing_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer × priority requests that no order answers."""
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("request"))
    grid = make_grid(customers, priorities=[{"priority": p} for p in PRIORITIES])
    results = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("request"), F.col("o_orderpriority").alias("priority")
    )
    return find_missing(grid, results, ["request", "priority"])


@query(f"""
    WITH {_MONTHLY}, dict(id, name) AS (VALUES ('1', 'Line Count'), ('3', 'Gross Revenue'))
    SELECT d::VARCHAR AS data_date, media, metric_id, name AS metric_name, name IS NOT NULL AS is_known, metric_value
    FROM facts LEFT JOIN dict ON metric_id = id""")
def measure_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = {"1": "Line Count", "3": "Gross Revenue"}
    return as_text(decorate_measures(_monthly_measures(spark, sf_dir), names), "data_date")


@query(f"""
    WITH {_MONTHLY}
    SELECT d::VARCHAR AS data_date, media, metric_id, metric_value FROM facts
    WHERE d >= DATE '1996-01-01' AND metric_id IN ('1', '3') AND media <> 'N'
      AND media IN (SELECT l_returnflag FROM lineitem WHERE l_linestatus = 'F')""")
def report_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Month range, media list, media set and measure list over the long facts."""
    lineitem = table(spark, sf_dir, "lineitem")
    media_set = lineitem.filter(F.col("l_linestatus") == "F").select(F.col("l_returnflag").alias("media"))
    facts = _monthly_measures(spark, sf_dir).filter(F.col("data_date") >= F.lit("1996-01-01").cast("date"))
    asked = run_report_query(facts, members={"media": ["A", "R"]}, member_sets={"media": media_set}, measures=[1, 3])
    return as_text(asked.select("data_date", "media", "metric_id", "metric_value"), "data_date")


@query("""
    SELECT o_orderstatus AS media, NULL::VARCHAR AS segment, count(*) AS n, sum(round(o_totalprice * 100)::BIGINT)::BIGINT AS total
    FROM orders GROUP BY ALL
    UNION ALL
    SELECT c_mktsegment, c_mktsegment, count(*), NULL FROM customer GROUP BY ALL""")
def union_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = (
        table(spark, sf_dir, "orders").groupBy(F.col("o_orderstatus").alias("media"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum(cents("o_totalprice")).alias("total"))
    )
    second = (
        table(spark, sf_dir, "customer").groupBy(F.col("c_mktsegment").alias("segment"))
        .agg(F.count(F.lit(1)).alias("n")).withColumn("media", F.col("segment"))
    )
    return concat_reports(first, second).select("media", "segment", "n", "total")


@query("""
    WITH f AS (
      SELECT date_trunc('month', l_shipdate)::DATE::VARCHAR AS data_date, l_partkey AS part,
             sum(l_quantity::BIGINT)::BIGINT AS quantity
      FROM lineitem GROUP BY ALL)
    SELECT data_date, part, quantity, row_number() OVER (PARTITION BY data_date ORDER BY quantity DESC, part) AS rank
    FROM f QUALIFY rank <= 10""", name="top_entities")
def top_entities_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = (
        table(spark, sf_dir, "lineitem")
        .groupBy(month_start(F.col("l_shipdate")).alias("data_date"), F.col("l_partkey").alias("part"))
        .agg(F.sum(F.col("l_quantity").cast("bigint")).alias("quantity"))
    )
    return as_text(top_entities(fact, "data_date", "part", "quantity", 10), "data_date")


@query("""
    WITH f AS (
      SELECT o_orderpriority AS media, (year(o_orderdate) - 2015) * 12 + month(o_orderdate) - 1 + 181 AS period_id,
             count(*) AS n
      FROM orders GROUP BY ALL)
    SELECT media, period_id,
           sum(n) OVER w ::DOUBLE / count(*) OVER w AS average
    FROM f WINDOW w AS (PARTITION BY media ORDER BY period_id RANGE BETWEEN 2 PRECEDING AND CURRENT ROW)""", name="timeframe_average")
def timeframe_average_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_orderpriority").alias("media"), period_id(F.col("o_orderdate")).alias("period_id"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return timeframe_average(fact, ["media"], "period_id", "n", 3)
