"""The registered queries: each operator over its whole table, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm import decontaminate, grouping, language, lines, maxscore, periodic, presence, repeats, simhash, tokenpack, tokens, toxicity, universe, urls
from tallyloom.llm.common import table
from tallyloom.llm.registry import ORACLES, QUERIES, query  # noqa: F401


@query("op9_simhash_near_dedup")
def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), width=4, distance=4)


@query("op8_toxicity")
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score_documents(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


@query(
    "op3_suffix_array_dedup",
    """
    WITH d AS (SELECT doc_id, coalesce(hex(encode(text)), '') AS h FROM documents),
    w AS (
        SELECT doc_id, unnest(range(length(h) // 2 - 49)) AS p, h FROM d WHERE length(h) >= 100
    ),
    s AS (SELECT doc_id, p, md5_number(substr(h, 2 * p + 1, 100)) AS k FROM w),
    f AS (SELECT k, min(doc_id) AS first_id FROM s GROUP BY k HAVING min(doc_id) < max(doc_id)),
    hit AS (SELECT DISTINCT s.doc_id, s.p FROM s JOIN f USING (k) WHERE f.first_id < s.doc_id),
    seen AS (SELECT *, max(p) OVER (PARTITION BY doc_id ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev FROM hit),
    cut AS (SELECT *, sum(CASE WHEN prev IS NULL OR p > prev + 50 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM seen),
    span AS (SELECT doc_id, run, min(p) AS a, max(p) + 50 AS b FROM cut GROUP BY doc_id, run),
    edge AS (SELECT *, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM span),
    piece AS (
        SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans, max(b) AS stop,
            string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS kept
        FROM edge JOIN d USING (doc_id) GROUP BY doc_id
    )
    SELECT d.doc_id, length(h) // 2 AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
        CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
        sha256(unhex(coalesce(kept || substr(h, 2 * stop + 1), h))) AS kept_sha256
    FROM d LEFT JOIN piece USING (doc_id)
    """,
)
def op3_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.repeat_digests(table(spark, sf_dir, "documents"))


@query("op6_benchmark_decontamination")
def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.flagged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op7_best_fit_packing")
def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grouping.pack(table(spark, sf_dir, "documents"), tokens.default_path(), limit=2048)


@query(
    "op10_line_dedup",
    r"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
    l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS no FROM d),
    p AS (SELECT *, CAST(sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY no) AS BIGINT) - 1 - length(line) AS start FROM l),
    c AS (
        SELECT *, list_filter(regexp_extract_all(line, '[^.!?\x{3002}\x{FF01}\x{FF1F}]*(?:[.!?\x{3002}\x{FF01}\x{FF1F}]+[ \t\r]*|$)'), lambda x: x <> '') AS parts
        FROM p
    ),
    s AS (SELECT doc_id, no, start, len(parts) AS n_parts, unnest(parts) AS part, unnest(range(len(parts))) AS k FROM c),
    t AS (SELECT *, start + CAST(sum(length(part)) OVER (PARTITION BY doc_id, no ORDER BY k) AS BIGINT) - length(part) AS place FROM s),
    u AS (
        SELECT doc_id, no, false AS inner_part, start AS place, line AS unit FROM p
        UNION ALL
        SELECT doc_id, no, true, place, part FROM t WHERE n_parts > 1
    ),
    n AS (SELECT *, trim(regexp_replace(translate(unit, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \t\r]+', ' ', 'g'), ' ') AS norm FROM u),
    g AS (
        SELECT *, row_number() OVER (PARTITION BY norm ORDER BY doc_id, place, inner_part) > 1 AS again FROM n
        WHERE norm <> '' AND (NOT inner_part OR len(regexp_extract_all(norm, '[\x{0E00}-\x{0E7F}\x{3040}-\x{30FF}\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}\x{F900}-\x{FAFF}]|[^ \x{0E00}-\x{0E7F}\x{3040}-\x{30FF}\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}\x{F900}-\x{FAFF}]+')) >= 5)
    ),
    whole AS (SELECT doc_id, no FROM g WHERE again AND NOT inner_part),
    gone AS (
        SELECT doc_id, no, inner_part, place, unit FROM g LEFT JOIN whole w USING (doc_id, no)
        WHERE again AND (NOT inner_part OR w.no IS NULL)
    ),
    rest AS (
        SELECT t.doc_id, t.no, string_agg(part, '' ORDER BY k) FILTER (x.place IS NULL) AS kept
        FROM t LEFT JOIN gone x ON x.inner_part AND x.doc_id = t.doc_id AND x.place = t.place GROUP BY t.doc_id, t.no
    ),
    kept AS (
        SELECT p.doc_id, count(*) AS n_lines, string_agg(coalesce(r.kept, ''), chr(10) ORDER BY p.no) FILTER (w.no IS NULL) AS text
        FROM p LEFT JOIN rest r USING (doc_id, no) LEFT JOIN whole w USING (doc_id, no) GROUP BY p.doc_id
    ),
    spans AS (SELECT doc_id, count(*) AS n, sum(length(unit)) AS n_chars, string_agg(place || '-' || (place + length(unit)), ',' ORDER BY place) AS spans FROM gone GROUP BY doc_id)
    SELECT doc_id, n_lines, coalesce(n, 0) AS n_removed, CAST(coalesce(n_chars, 0) AS BIGINT) AS n_chars_removed, coalesce(spans, '') AS removed_spans,
        sha256(coalesce(text, '')) AS kept_sha256
    FROM kept LEFT JOIN spans USING (doc_id)
    """,
)
def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = lines.without_repeated_lines(table(spark, sf_dir, "documents"))
    return kept.withColumn("kept_sha256", F.sha2("text", 256)).drop("text")


@query(
    "op5_exact_top_k",
    """
    WITH v AS (
        SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
        FROM embeddings
        WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ),
    s AS (
        SELECT a.vec_id AS query_id, b.vec_id, CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda p: p[1] * p[2])) AS BIGINT) AS score
        FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
    ),
    r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
    SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
    """,
)
def op5_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxscore.top_k(table(spark, sf_dir, "embeddings"), k=10, every=100)


@query("op2_language_id")
def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language.identify(docs, language.fit(docs))


#: Fixed rules of the query.
URL_RULES = [urls.Rule("block", "net/"), urls.Rule("allow", "example.net/en/"), urls.Rule("block", "example.com/de/"), urls.Rule("allow", "org/fr/")]


@query("op1_url_filters")
def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"), URL_RULES)


@query("op4_token_id_output")
def op4_token_id_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenpack.packed(table(spark, sf_dir, "documents"), tokens.default_path())


def _with_planted_runs(docs: DataFrame) -> DataFrame:
    """The documents of the run query: of every tenth (by a checksum of its id; null as the empty text) the words repeat from some place on."""
    blank = r"[\x20\x09-\x0D]+"
    checksum = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    words = docs.select("doc_id", F.col("text").cast("string").alias("text"), checksum.alias("h")).withColumn("words", F.when(F.col("h") % 10 == 0, F.filter(F.split("text", blank), lambda w: w != "")))
    chosen = words.withColumn("g", F.floor(F.col("h") / 10).cast("long")).withColumn("n", F.size("words").cast("long")).withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    sized = chosen.withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    moved = F.transform(F.sequence(F.lit(0).cast("long"), F.col("n") - 1), lambda i: F.get("words", F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p")).cast("int")))
    return sized.select("doc_id", F.when(F.col("n") > 0, F.array_join(moved, " ")).otherwise(F.col("text")).alias("text"))


@query("op12_periodic_run_detection")
def op12_periodic_run_detection(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.periodic_runs(_with_planted_runs(table(spark, sf_dir, "documents")), least=6, times=4)
    # of equally often repeated runs the first in the array stays
    stronger = F.reduce("runs", F.get("runs", F.lit(0)), lambda best, r: F.when(r["length"] * best["period"] > best["length"] * r["period"], r).otherwise(best))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    digests = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), stronger.alias("best"), F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("text", 256).alias("collapsed_sha256"))
    milli = F.expr("1000 * best.length div best.period")
    return digests.select("doc_id", "n_runs", "best.start", "best.length", "best.period", milli.alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


@query(
    "op13_ranked_lexical_search",
    r"""
    WITH t AS (
        SELECT row_number() OVER () AS doc, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS words
        FROM documents
    ),
    d AS (SELECT doc, doc_id, words, CAST(len(words) AS BIGINT) AS n FROM t WHERE len(words) > 0),
    total AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_all FROM d),
    q AS (
        SELECT item, item_id, unnest(list_distinct(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))) AS word
        FROM (SELECT row_number() OVER () AS item, item_id, text FROM benchmark)
    ),
    p AS (
        SELECT doc, word, count(*) AS tf FROM (SELECT doc, unnest(words) AS word FROM d) WHERE word IN (SELECT word FROM q) GROUP BY doc, word
    ),
    w AS (SELECT word, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM p, total GROUP BY word, n_docs),
    s AS (
        SELECT item, item_id, doc, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * n_docs) // n_all)))) AS BIGINT) AS score
        FROM q JOIN p USING (word) JOIN w USING (word) JOIN d USING (doc), total GROUP BY item, item_id, doc, doc_id
    ),
    r AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM s WHERE score > 0)
    SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 50
    """,
)
def op13_ranked_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return presence.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=50)


@query("op11_ngram_jaccard_join")
def op11_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return universe.similar_sets(table(spark, sf_dir, "documents"), width=4, percent=85)
