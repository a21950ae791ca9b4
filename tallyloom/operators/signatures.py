"""Table layouts known by their header labels, so that a header that drifts at the same width is noticed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.parse import Watch
from tallyloom.plans.joins import null_safe_join
from tallyloom.plans.staging import computed_once

#: Known signatures that are sent to every task; a registry has a handful for each report.
REGISTRY_ROWS = 10_000
#: Labels that can be told apart when headers are compared; they become characters from here on.
FIRST_CHARACTER, MOST_LABELS = 0x4E00, 0xD800 - 0x4E00


def header_labels() -> Column:
    """The labels of a table of ``parse_tables`` in order: the row label in lower case, each measure with its id, then the upper header."""
    text = lambda c: F.coalesce(c, F.lit("\x01"))  # a missing label is not an empty one
    row = F.concat(F.lit("row "), text(F.col("header_label")))
    measures = F.transform("header", lambda h: F.concat(F.lit("measure "), text(h["metric"]), F.lit("\x02"), text(h["metric_id"])))
    top = F.transform("top", lambda t: F.concat(F.lit("top "), text(t)))
    none = F.array().cast("array<string>")
    return F.concat(F.array(row), F.coalesce(measures, none), F.coalesce(top, none))


def with_signature(tables: DataFrame) -> DataFrame:
    """``labels`` and ``signature``, a digest of the labels in their order; null for documents without a table."""
    labelled = computed_once(tables, {"labels": F.when(F.col("data_rows").isNotNull(), header_labels())})
    return computed_once(labelled, {"signature": F.sha2(F.array_join("labels", "\x00"), 256)})


def register(tables: DataFrame, layout: str) -> DataFrame:
    """``(report, layout, signature, labels)``: registry rows from documents whose layout is known to be right."""
    found = with_signature(tables).filter("signature IS NOT NULL").groupBy("report", "signature").agg(F.first("labels").alias("labels"))
    return found.select("report", F.lit(layout).alias("layout"), "signature", "labels")


def _known(registry: DataFrame) -> DataFrame:
    """The registry's keys, broadcast if there are as few as there should be."""
    keys = registry.select("report", "signature").distinct()
    return F.broadcast(keys) if keys.count() <= REGISTRY_ROWS else keys


def only_known(registry: DataFrame) -> Watch:
    """Leave out documents whose header is not in the registry; ``unknown_headers`` lists them. Documents without a table stay,
    as they are no matter of headers. For ``watch`` of the report builders; no document text is exchanged."""
    keys = _known(registry).withColumn("_known", F.lit(True))

    def watch(tables: DataFrame) -> DataFrame:
        met = null_safe_join(with_signature(tables), keys, ["report", "signature"], "left")
        return met.filter(F.col("_known") | F.col("signature").isNull()).drop("_known", "labels", "signature")

    return watch


def _as_characters(headers: DataFrame, labels: DataFrame) -> DataFrame:
    """``(report, signature, written)``: each header as a string with one character for each label."""
    code = F.lpad(F.hex(F.lit(FIRST_CHARACTER) + F.col("_no")), 4, "0")
    places = headers.select("report", "signature", F.posexplode("labels").alias("_at", "label")).join(labels, "label")
    letter = F.decode(F.unhex(code), "UTF-16BE")
    letters = F.array_sort(F.collect_list(F.struct("_at", letter.alias("c"))))
    return places.groupBy("report", "signature").agg(F.array_join(F.transform(letters, lambda x: x["c"]), "").alias("written"))


def nearest_known(unknown: DataFrame, registry: DataFrame) -> DataFrame:
    """``(report, signature, nearest, distance)`` of headers ``(report, signature, labels)``: the registered layout of the report that
    takes the fewest labels added, removed or replaced; ties go to the first by name. Null where the report has none."""
    both = unknown.select("report", "signature", "labels").unionByName(registry.select("report", "signature", "labels")).distinct()
    label = both.select(F.explode("labels").alias("label")).distinct()
    # labels in order of their names; their number is that of the headers, not of the documents
    numbered = label.agg(F.array_sort(F.collect_set("label")).alias("all")).select(F.posexplode("all").alias("_no", "label"))
    stop = F.raise_error(F.lit("too many different labels")).cast("int")
    letters = _as_characters(both, numbered.withColumn("_no", F.when(F.col("_no") < MOST_LABELS, F.col("_no")).otherwise(stop)))
    known = letters.join(registry.select("report", "signature", "layout").distinct(), ["report", "signature"])
    known = known.select("report", F.col("written").alias("_known"), "layout")
    met = letters.join(unknown.select("report", "signature").distinct(), ["report", "signature"]).join(known, "report", "left")
    near = F.struct(F.levenshtein("written", "_known").alias("distance"), F.col("layout").alias("nearest"))
    best = F.min(F.when(F.col("layout").isNotNull(), near)).alias("best")
    return met.groupBy("report", "signature").agg(best).select("report", "signature", "best.nearest", "best.distance")


def unknown_headers(tables: DataFrame, registry: DataFrame) -> DataFrame:
    """The quarantine of layouts: documents whose header is not in the registry, with the nearest one that is."""
    carried = [c for c in ("report", "data_date", "request_id", "categories") if c in tables.columns]
    signed = with_signature(tables).filter("signature IS NOT NULL").select(*dict.fromkeys(["report", *carried]), "signature", "labels")
    strange = signed.join(_known(registry), ["report", "signature"], "left_anti")
    headers = strange.groupBy("report", "signature").agg(F.first("labels").alias("labels"))
    found = strange.drop("labels").join(nearest_known(headers, registry), ["report", "signature"], "left")
    return found.withColumn("reject_reason", F.lit("unknown_header"))
