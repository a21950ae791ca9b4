"""Landed documents to the six report tables.

Every function takes a landing frame whose rows are ready documents, already joined with their request's labels
(``attach_requests``), and returns the report's fixed columns plus the partition column ``data_date``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.numbers import nan_to_null, stripped_to_measure
from tallyloom.functions.periods import period_labels
from tallyloom.functions.text import last_two, slug
from tallyloom.operators.parse import (
    Watch,
    fail_on_reject,
    long_facts,
    parse_rows,
    parse_tables,
    parsed_rows,
    rejected_rows,
)
from tallyloom.operators.quality import conform
from tallyloom.operators.reshape import is_member
from tallyloom.plans.joins import null_safe_join
from tallyloom.plans.staging import computed_once, exploded
from tallyloom.sources.landing import request_key
from tallyloom.plans.specs import (
    AUDIENCE_DUPLICATION,
    CORRECTED_NAMES,
    CROSS_VISITING,
    CROSS_VISITING_METRICS,
    DESKTOP,
    DUPLICATION_SUMMARIES,
    LOCAL_MARKET,
    MOBILE,
    MULTI_PLATFORM,
    ReportSpec,
)

PARTITION = "data_date"


def attach_requests(landing: DataFrame, requests: DataFrame) -> DataFrame:
    """Label every document with the columns of its request; a document without a known request keeps null labels.

    Requests are named by id, and by report and month where their frame has these. A request that stands in the frame twice stops
    the job, as it would multiply its report's rows.
    """
    key = [c for c in request_key(landing) if c in requests.columns]
    labels = [c for c in requests.columns if c not in landing.columns]
    grouped = requests.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"), *[F.first(c).alias(c) for c in labels])
    stop = F.raise_error(F.lit("repeated request")).cast("boolean")
    once = grouped.filter(F.when(F.col("_n") > 1, stop).otherwise(F.lit(True))).drop("_n")
    return null_safe_join(landing, once, key, "left")


def _finish(facts: DataFrame, spec: ReportSpec, corrected_names: bool = False) -> DataFrame:
    labels = {**period_labels(F.col(PARTITION)), **{k: F.lit(v) for k, v in spec.constants}}
    out = conform(nan_to_null(facts.withColumns(labels)), spec.schema, extra=[PARTITION])
    return out.withColumnsRenamed(CORRECTED_NAMES) if corrected_names else out


def _rows(landing: DataFrame, spec: ReportSpec, strict: bool, watch: Watch | None) -> DataFrame:
    rows = parse_rows(landing, spec, watch=watch)
    return fail_on_reject(rows) if strict else rows


def key_measures(
    landing: DataFrame, spec: ReportSpec, strict: bool = False, null_attribute: bool = False, watch: Watch | None = None
) -> DataFrame:
    """Desktop, multi-platform and mobile reports: one row per media and metric."""
    facts = long_facts(_rows(landing, spec, strict, watch), spec, null_attribute)
    absent = F.lit(None if null_attribute else "None").cast("string")
    keys = [c for c in ("category", "attribute") if c in spec.schema.names and c not in facts.columns]
    return _finish(facts.withColumns({c: absent for c in keys}), spec)


def desktop(landing: DataFrame, spec: ReportSpec = DESKTOP, **options) -> DataFrame:
    return key_measures(landing, spec, **options)


def multi_platform(landing: DataFrame, spec: ReportSpec = MULTI_PLATFORM, **options) -> DataFrame:
    return key_measures(landing, spec, **options)


def mobile_web_and_app(landing: DataFrame, spec: ReportSpec = MOBILE, **options) -> DataFrame:
    return key_measures(landing, spec, **options)


def local_market(landing: DataFrame, spec: ReportSpec = LOCAL_MARKET, strict: bool = False, watch: Watch | None = None) -> DataFrame:
    """Desktop measures per market; the landing frame carries ``region`` and ``region_id``."""
    facts = long_facts(_rows(landing, spec, strict, watch), spec)
    return _finish(facts.withColumn("state", last_two(F.col("region"))), spec)


def _only(values: Column, what: str, kind: str) -> Column:
    """The single element of an array, null when empty; a second one stops the job."""
    message = F.lit(f"duplicate key: {what}")
    return F.when(F.size(values) > 1, F.raise_error(message).cast(kind)).otherwise(F.get(values, F.lit(0)))


def _readable(rows: Column, strict: bool) -> Column:
    """Rows of a document that fit its header."""
    fits = lambda r: r["label"].isNotNull() & (F.size(r["cells"]) == F.col("guard"))
    if strict:
        stop = F.raise_error(F.lit("rejected report row")).cast("boolean")
        return F.filter(rows, lambda r: F.when(fits(r), True).otherwise(stop))
    return F.filter(rows, fits)


def _documents(landing: DataFrame, spec: ReportSpec, strict: bool, watch: Watch | None = None) -> DataFrame:
    tables = parse_tables(landing, spec, watch=watch).withColumn("rows", parsed_rows(spec)).drop("data_rows")
    return tables.withColumn("rows", _readable(F.col("rows"), strict))


def _neighbour(items: str, at: Column, field: str) -> Column:
    return F.get(items, at)[field]


def _pair_rows(docs: DataFrame) -> DataFrame:
    """Benchmark rows with ``is_duplicate``: the same media, id and audience occur twice in the document.

    The keys are sorted within the document, where equal ones become neighbours; a row carries its flag only.
    """
    key = lambda r: F.struct(r["label"], r["benchmark_media_id"], F.get(r["cells"], F.lit(0)))
    placed = F.array_sort(F.transform("rows", lambda r, i: F.struct(key(r).alias("key"), i.alias("i"))))
    docs = computed_once(docs, {"placed": placed})
    same = lambda j, p: _neighbour("placed", j, "key").eqNullSafe(p["key"])
    flags = F.array_sort(F.transform("placed", lambda p, j: F.struct(p["i"], (same(j - 1, p) | same(j + 1, p)).alias("twice"))))
    docs = computed_once(docs, {"flags": flags}).drop("placed")
    joined = F.transform("rows", lambda r, i: F.struct(r.alias("r"), F.get("flags", i)["twice"].alias("twice")))
    rows = exploded(docs.withColumn("rows", joined).drop("flags"), "rows", "x")
    return rows.select(*[c for c in rows.columns if c != "x"], F.col("x.r").alias("r"), F.col("x.twice").alias("is_duplicate"))


def _compared(first_value: int) -> tuple[Column, Column]:
    """``entries``: a document's measure cells, sorted by comparison media and measure; ``compared``: one struct for each
    comparison media with the positions of its measures and whether one of them stands there twice.

    Equal media are neighbours in the sorted entries, and no media has more than the known measures, so each struct
    looks at as many entries as there are measures.
    """
    labels = list(CROSS_VISITING_METRICS)
    number = lambda j: F.coalesce(F.nullif(F.array_position(F.array(*[F.lit(m) for m in labels]), F.get("header", j)["metric"]), F.lit(0)), F.lit(len(labels) + 1))
    positions = F.when(F.col("width") > first_value, F.sequence(F.lit(first_value), F.col("width") - 1))
    entries = F.array_sort(F.transform(positions, lambda j: F.struct(F.get("top", j).alias("media"), number(j).alias("n"), j.alias("j"))))
    starts = F.filter(
        F.transform("entries", lambda e, i: F.when((i == 0) | ~_neighbour("entries", i - 1, "media").eqNullSafe(e["media"]), i)),
        lambda i: i.isNotNull(),
    )

    def group(i: Column) -> Column:
        near = [F.get("entries", i + d) for d in range(len(labels) + 1)]
        inside = [(i + d < F.size("entries")) & e["media"].eqNullSafe(near[0]["media"]) for d, e in enumerate(near)]
        place = lambda k: F.coalesce(*[F.when(ok & (e["n"] == k), e["j"]) for ok, e in zip(inside, near)])
        twice = [ok & (near[d]["n"] == near[d + 1]["n"]) & (near[d]["n"] <= len(labels)) for d, ok in enumerate(inside[1:])]
        return F.struct(near[0]["media"].alias("name"), *[place(k + 1).alias(f"p{k}") for k in range(len(labels))], reduce(lambda a, b: a | b, twice).alias("twice"))

    return entries, F.transform(starts, group)


def cross_visiting(
    landing: DataFrame, spec: ReportSpec = CROSS_VISITING, strict: bool = False, on_duplicate: str = "fail",
    corrected_names: bool = False, require_metrics: bool = False, watch: Watch | None = None,
) -> DataFrame:
    """One row per benchmark media, comparison media and target, four measures wide.

    All measures of a pair stand in one table row, so the pivot reads them there and moves no data.
    ``on_duplicate='quarantine'`` leaves out repeated keys, which ``cross_visiting_duplicates`` lists. A measure the
    table lacks is null, or stops the job with ``require_metrics``.
    """
    entries, compared = _compared(len(spec.layouts[0].key_cells))
    docs = computed_once(_documents(landing, spec, strict, watch), {"entries": entries})
    rows = _pair_rows(computed_once(docs, {"compared": compared}).drop("entries"))
    if on_duplicate == "fail":
        stop = F.raise_error(F.lit("duplicate key in pair matrix")).cast("boolean")
        usable = F.when(F.col("is_duplicate"), stop).otherwise(F.lit(True))
    else:
        usable = ~F.col("is_duplicate")
    if require_metrics:
        labels = F.array(*[F.lit(m) for m in CROSS_VISITING_METRICS])
        lacking = F.size(F.array_except(labels, F.transform("header", lambda h: h["metric"]))) > 0
        halt = F.raise_error(F.lit("measure missing from pair matrix")).cast("boolean")
        usable = F.when(lacking, halt).otherwise(usable)
    twice = F.raise_error(F.lit("duplicate key: a measure stands twice")).cast("string")
    values = F.transform(
        F.when(usable, F.col("compared")),
        lambda m: F.struct(
            m["name"].alias("name"),
            *[F.when(m["twice"], twice).otherwise(F.get("r.cells", m[f"p{k}"])).alias(f"v{k}") for k in range(len(CROSS_VISITING_METRICS))],
        ),
    )
    carried = [c for c in rows.columns if c not in ("r", "compared", "header", "top", "width", "is_duplicate")]
    rows = rows.select(
        *carried,
        F.col("r.label").alias("benchmark_media"),
        F.col("r.benchmark_media_id").alias("benchmark_media_id"),
        F.get("r.cells", F.lit(0)).alias("media_target_audience"),
        values.alias("values"),
    )
    measures = {column: stripped_to_measure(F.col(f"v.v{k}")) for k, column in enumerate(CROSS_VISITING_METRICS.values())}
    return _finish(exploded(rows, "values", "v").withColumns({"comparison_media": F.col("v.name"), **measures}), spec, corrected_names)


def cross_visiting_duplicates(landing: DataFrame, spec: ReportSpec = CROSS_VISITING) -> DataFrame:
    """Quarantine of benchmark rows whose key occurs twice in a document."""
    return _pair_rows(_documents(landing, spec, False)).filter("is_duplicate").select(
        "request_id", PARTITION, F.col("r.row_no").alias("row_no"), F.col("r.label").alias("benchmark_media"),
        F.col("r.benchmark_media_id").alias("benchmark_media_id"), F.lit("duplicate_key").alias("reject_reason"),
    )


def audience_duplication(
    landing: DataFrame, spec: ReportSpec = AUDIENCE_DUPLICATION, strict: bool = False, pairing: str = "each",
    corrected_names: bool = False, watch: Watch | None = None,
) -> DataFrame:
    """Listed media with the summary values of their metric and the other media of the request.

    The landing frame carries ``media_ids``, the ids the request asked for. Split, pivot of the summary rows, left
    join by metric and pair-up all stay inside the document's own rows, since a request is one document.
    ``pairing='each'`` gives a row per other media; ``'reversed'`` reads the media column backwards.
    """
    listed = lambda r: is_member(r["benchmark_media_id"], F.col("media_ids"))
    docs = _documents(landing, spec, strict, watch).withColumns(
        {"media": F.filter("rows", listed), "others": F.filter("rows", lambda r: ~listed(r))}
    )

    def summary_cells(name: str) -> Column:
        found = F.filter("others", lambda r: slug(r["label"]) == name)
        return _only(F.transform(found, lambda r: r["cells"]), name, "array<string>").alias(name)

    docs = docs.select("*", *[summary_cells(n) for n in DUPLICATION_SUMMARIES[1:]])
    docs = exploded(docs, F.col("media"), "r", "media_no")
    if pairing == "reversed":
        docs = docs.withColumn("comparision_media", F.get("media", F.size("media") - 1 - F.col("media_no"))["label"])
    else:
        rest = F.filter("media", lambda m: m["benchmark_media_id"] != F.col("r.benchmark_media_id"))
        docs = docs.withColumn("comparision_media", F.explode_outer(F.transform(rest, lambda m: m["label"])))
    docs = exploded(docs, F.when(F.col("width") > 0, F.sequence(F.lit(0), F.col("width") - 1)), "j")
    j = F.col("j")
    return _finish(
        docs.select(
            *[c for c in docs.columns if c not in DUPLICATION_SUMMARIES],
            F.col("r.label").alias("benchmark_media"),
            F.col("r.benchmark_media_id").alias("benchmark_media_id"),
            F.get("header", j)["metric"].alias("metrics"),
            F.get("header", j)["metric_id"].alias("metric_id"),
            stripped_to_measure(F.get("r.cells", j)).alias("benchmark_metric_value"),
            *[stripped_to_measure(F.get(n, j)).alias(n) for n in DUPLICATION_SUMMARIES[1:]],
        ),
        spec,
        corrected_names,
    )


def audience_duplication_rejects(landing: DataFrame, spec: ReportSpec = AUDIENCE_DUPLICATION) -> DataFrame:
    """Quarantine: ragged rows and rows that are neither a listed media nor a known summary."""
    rows = parse_rows(landing, spec)
    outsider = ~is_member(F.col("benchmark_media_id"), F.col("media_ids"))
    unknown = outsider & ~slug(F.col("label")).isin(*DUPLICATION_SUMMARIES)
    reason = F.coalesce("reject_reason", F.when(unknown, F.lit("unknown_summary")))
    return rejected_rows(rows.withColumn("reject_reason", reason))


BUILDERS: dict[str, Callable[..., DataFrame]] = {
    "desktop": desktop,
    "local_market": local_market,
    "multi_platform": multi_platform,
    "mobile_web_and_app": mobile_web_and_app,
    "cross_visiting": cross_visiting,
    "audience_duplication": audience_duplication,
}
