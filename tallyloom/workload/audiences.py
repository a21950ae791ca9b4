"""Queries on raw events and orders: measures, overlap, attempts, lake and stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions.periods import month_start
from tallyloom.operators import audience
from tallyloom.operators.overlap import overlap_matrix as matrix_of
from tallyloom.plans.proven import proven_top
from tallyloom.plans.workspace import new_folder
from tallyloom.sources.lake import touched_months, write_months
from tallyloom.sources.landing import latest_ready as newest_ready, pending
from tallyloom.workload.registry import as_text, cents, query, table

BRANDS = [f"Brand#{i}" for i in range(1, 26)]


def _brand_visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(customer, brand) pairs; an order keeps each brand once before it meets its customer."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    part = table(spark, sf_dir, "part").select("p_partkey", F.col("p_brand").alias("brand"))
    brands = lines.join(part, F.col("l_partkey") == F.col("p_partkey")).select("l_orderkey", "brand").distinct()
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("customer"))
    return brands.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select("customer", "brand")


_BRANDS = """
    p AS (SELECT DISTINCT o_custkey AS u, p_brand AS m
          FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey)"""


@query(f"""
    WITH {_BRANDS},
    aud AS (SELECT m, count(*) AS n FROM p GROUP BY m),
    total AS (SELECT count(DISTINCT u) AS n FROM p),
    s AS (SELECT a.m AS a, b.m AS b, count(*) AS n FROM p a JOIN p b ON a.u = b.u AND a.m <> b.m GROUP BY ALL)
    SELECT a AS benchmark, b AS comparison, s.n AS shared, s.n::DOUBLE * 100 / x.n AS horizontal,
           s.n::DOUBLE * 100 / y.n AS vertical, s.n::DOUBLE * 100 * total.n / (x.n::DOUBLE * y.n) AS "index"
    FROM s JOIN aud x ON x.m = a JOIN aud y ON y.m = b CROSS JOIN total""")
def cross_visit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audience.cross_visit(_brand_visits(spark, sf_dir), "brand", "customer", BRANDS)


@query(f"""
    WITH {_BRANDS},
    s AS (SELECT a.m AS a, b.m AS b, count(*) AS n FROM p a JOIN p b ON a.u = b.u AND a.m <> b.m GROUP BY ALL)
    SELECT a AS benchmark, b AS comparison, n AS shared, true AS within_bound FROM s""")
def cross_visit_approx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact overlaps beside the sketched ones: whether these keep within the stated error."""
    visits = _brand_visits(spark, sf_dir)
    exact = audience.cross_visit(visits, "brand", "customer", BRANDS).select("benchmark", "comparison", "shared")
    sketched = audience.cross_visit_approx(visits, "brand", "customer", BRANDS).withColumnRenamed("shared", "sketched")
    error = F.abs(F.col("sketched") - F.col("shared"))
    # three standard errors, and one user for audiences of a handful
    bound = 3 * 2 / 2**6 * F.greatest("audience", "comparison_audience") + 1
    return exact.join(sketched, ["benchmark", "comparison"]).select("benchmark", "comparison", "shared", (error <= bound).alias("within_bound"))


@query("""
    WITH p AS (SELECT DISTINCT o_custkey AS u, p_type AS m
               FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey),
    aud AS (SELECT m, count(*) AS n FROM p GROUP BY m),
    total AS (SELECT count(DISTINCT u) AS n FROM p),
    s AS (SELECT a.m AS a, b.m AS b, count(*) AS n FROM p a JOIN p b ON a.u = b.u AND a.m <> b.m GROUP BY ALL)
    SELECT a AS benchmark, b AS comparison, s.n AS shared, s.n::DOUBLE * 100 / x.n AS horizontal,
           s.n::DOUBLE * 100 / y.n AS vertical, s.n::DOUBLE * 100 * total.n / (x.n::DOUBLE * y.n) AS "index"
    FROM s JOIN aud x ON x.m = a JOIN aud y ON y.m = b CROSS JOIN total""")
def overlap_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every type of part with every other, by the customers they share; most customers bought many types."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    part = table(spark, sf_dir, "part").select("p_partkey", F.col("p_type").alias("type"))
    types = lines.join(part, F.col("l_partkey") == F.col("p_partkey")).select("l_orderkey", "type").distinct()
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("customer"))
    return matrix_of(types.join(orders, F.col("l_orderkey") == F.col("o_orderkey")), "type", "customer")


@query("""
    WITH f AS (
      SELECT l_linestatus AS status, l_orderkey AS order_key, sum(l_quantity::BIGINT)::BIGINT AS quantity
      FROM lineitem GROUP BY l_linestatus, l_orderkey)
    SELECT status, order_key, quantity, row_number() OVER (PARTITION BY status ORDER BY quantity DESC, order_key) AS rank
    FROM f QUALIFY rank <= 5000""")
def top_entities_proven(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5,000 largest orders of each status, many of them tied, from a sketch and exact sums of its candidates."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_linestatus").alias("status"), F.col("l_orderkey").alias("order_key"), F.col("l_quantity").cast("bigint").alias("quantity")
    )
    return proven_top(lines, "status", "order_key", "quantity", 5000)


BRAND_SETS = {"first two": BRANDS[:2], "first five": BRANDS[:5], "all": BRANDS}


@query(f"""
    WITH {_BRANDS},
    sets AS (
      SELECT 'first two' AS media_set, 'Brand#' || i AS m, 2 AS size FROM range(1, 3) t(i)
      UNION ALL SELECT 'first five', 'Brand#' || i, 5 FROM range(1, 6) t(i)
      UNION ALL SELECT 'all', 'Brand#' || i, 25 FROM range(1, 26) t(i)),
    c AS (SELECT media_set, size, u, count(*) AS n FROM p JOIN sets USING (m) GROUP BY ALL)
    SELECT media_set, count(CASE WHEN n = size THEN 1 END) AS duplicated_all_sites,
           count(CASE WHEN n >= 2 THEN 1 END) AS duplicated_2_or_more_sites, count(*) AS unduplicated
    FROM c GROUP BY ALL""")
def duplication(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audience.duplication(_brand_visits(spark, sf_dir), "brand", "customer", BRAND_SETS)


PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]

_BY_YEAR = """
    p AS (SELECT DISTINCT year(o_orderdate) AS year, o_custkey AS u, o_orderpriority AS m FROM orders)"""


def _priority_visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.year("o_orderdate").alias("year"), F.col("o_custkey").alias("customer"), F.col("o_orderpriority").alias("priority")
    )


@query(f"""
    WITH {_BY_YEAR},
    aud AS (SELECT year, m, count(*) AS n FROM p GROUP BY ALL),
    total AS (SELECT year, count(DISTINCT u) AS n FROM p GROUP BY ALL),
    s AS (SELECT a.year, a.m AS a, b.m AS b, count(*) AS n
          FROM p a JOIN p b ON a.year = b.year AND a.u = b.u AND a.m <> b.m GROUP BY ALL)
    SELECT s.year, a AS benchmark, b AS comparison, s.n AS shared, s.n::DOUBLE * 100 / x.n AS horizontal,
           s.n::DOUBLE * 100 / y.n AS vertical, s.n::DOUBLE * 100 * total.n / (x.n::DOUBLE * y.n) AS "index"
    FROM s JOIN aud x ON x.year = s.year AND x.m = a JOIN aud y ON y.year = s.year AND y.m = b
    JOIN total ON total.year = s.year""")
def cross_visit_by_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole pair matrix, year by year."""
    return audience.cross_visit(_priority_visits(spark, sf_dir), "priority", "customer", PRIORITIES, by=["year"])


@query(f"""
    WITH {_BY_YEAR},
    sets(media_set, m, size) AS (VALUES ('urgent', '1-URGENT', 2), ('urgent', '2-HIGH', 2),
      ('extremes', '1-URGENT', 2), ('extremes', '5-LOW', 2)),
    c AS (SELECT year, media_set, size, u, count(*) AS n FROM p JOIN sets USING (m) GROUP BY ALL)
    SELECT year, media_set, count(CASE WHEN n = size THEN 1 END) AS duplicated_all_sites,
           count(CASE WHEN n >= 2 THEN 1 END) AS duplicated_2_or_more_sites, count(*) AS unduplicated
    FROM c GROUP BY ALL""")
def duplication_by_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    sets = {"urgent": ["1-URGENT", "2-HIGH"], "extremes": ["1-URGENT", "5-LOW"]}
    return audience.duplication(_priority_visits(spark, sf_dir), "priority", "customer", sets, by=["year"])


@query("""
    WITH e AS (SELECT ts::DATE::VARCHAR AS day, event_type, user_id, round(value * 100)::BIGINT AS v FROM events),
    t AS (SELECT day, count(DISTINCT user_id) AS n FROM e GROUP BY ALL),
    m AS (SELECT day, event_type, count(DISTINCT user_id) AS unique_visitors, count(*) AS pages, sum(v)::BIGINT AS minutes
          FROM e GROUP BY ALL)
    SELECT day, event_type, unique_visitors, pages, minutes, unique_visitors::DOUBLE * 100 / n AS reach
    FROM m JOIN t USING (day)""")
def key_measures_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(
        F.col("ts").cast("date").alias("day"), "event_type", "user_id", cents("value").alias("v")
    )
    return as_text(audience.key_measures(events, "day", "event_type", "user_id", "v"), "day")


def _attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as attempts: a user's day is the request, an 'error' is an answer that is not ready."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("request"), F.col("ts").cast("date").cast("string").alias("day"), "ts", "event_id",
        (F.col("event_type") != "error").alias("is_ready"),
    )


@query("""
    SELECT user_id AS request, ts::DATE::VARCHAR AS day, event_id FROM events WHERE event_type <> 'error'
    QUALIFY row_number() OVER (PARTITION BY user_id, ts::DATE ORDER BY ts DESC, event_id DESC) = 1""")
def latest_ready(spark: SparkSession, sf_dir: str) -> DataFrame:
    return newest_ready(_attempts(spark, sf_dir), ["request", "day"], ["ts", "event_id"]).drop("ts")


@query("""
    SELECT user_id AS request, ts::DATE::VARCHAR AS day, count(*) AS attempts FROM events
    GROUP BY ALL HAVING count(CASE WHEN event_type <> 'error' THEN 1 END) = 0""")
def pending_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = _attempts(spark, sf_dir)
    grid = log.groupBy("request", "day").agg(F.count(F.lit(1)).alias("attempts"))
    return pending(grid, log, ["request", "day"])


@query("""
    WITH m AS (
      SELECT date_trunc('month', o_orderdate)::DATE AS d, o_orderpriority AS media, count(*) AS n,
             sum(round(o_totalprice * 100)::BIGINT)::BIGINT AS total
      FROM orders GROUP BY ALL)
    SELECT d::VARCHAR AS data_date, media, CASE WHEN year(d) >= 1997 THEN 'rerun' ELSE 'first' END AS run, n,
           CASE WHEN year(d) >= 1997 THEN total END AS total
    FROM m WHERE year(d) <> 1992""")
def partition_rewrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all months, then replace those from 1997 on, and those of 1992 by nothing; all others must stay."""
    monthly = (
        table(spark, sf_dir, "orders")
        .groupBy(month_start(F.col("o_orderdate")).alias("data_date"), F.col("o_orderpriority").alias("media"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum(cents("o_totalprice")).alias("total"))
    )
    path = new_folder(spark, "partition-rewrite")
    write_months(monthly.withColumns({"run": F.lit("first"), "total": F.lit(None).cast("bigint")}), path)
    again = monthly.filter(F.year("data_date") >= 1997).withColumn("run", F.lit("rerun"))
    # the months of 1992 are rebuilt to nothing
    write_months(again, path, [*touched_months(again), *[f"1992-{m:02d}-01" for m in range(1, 13)]])
    return as_text(spark.read.parquet(path), "data_date")
