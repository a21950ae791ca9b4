"""Report documents to table rows and long facts.

The document text is cut with regular expressions and array functions only, so a scan, its parse and the final explode
run in one stage without Python and without shuffling the text. Cells end where the next cell or row begins, which
reads markup with unclosed tags the same way as closed ones.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.numbers import stripped_to_measure
from tallyloom.functions.text import drop_brackets, resolve_references, strip, unescape
from tallyloom.plans.specs import ReportSpec
from tallyloom.plans.staging import computed_once, exploded

# The inside of an opening tag; a quoted value may hold '>'. Possessive, so that it needs no stack however long it is.
TAG = r"""(?:[^'">]++|"[^"]*+"|'[^']*+'|['"])*+"""
_TABLE = r"[tT][aA][bB][lL][eE](?=[\s/>])"
# Tags that are not part of the table's own structure.
_FOREIGN = (
    r"<(?!/?(?:[tT][rRhHdD]|[tT][aA][bB][lL][eE]|[tT][hH][eE][aA][dD]|[tT][bB][oO][dD][yY]|[tT][fF][oO][oO][tT])[\s/>])"
    rf"/?[a-zA-Z!?]{TAG}>"
)


def attribute(tag: Column, name: str) -> Column:
    """Value of one attribute of an opening tag's text, null when the tag lacks it."""
    # whole attributes are stepped over, so that the name is never found inside another one's quoted value
    other = rf"""(?:(?!(?<=\s|^){name}\s*=)(?:"[^"]*+"|'[^']*+'|[^"']))*+"""
    raw = F.nullif(F.regexp_extract(tag, rf"""(?is)^{other}{name}\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", 1), F.lit(""))
    quoted = raw.startswith('"') | raw.startswith("'")
    return unescape(F.when(quoted, F.substr(raw, F.lit(2), F.length(raw) - 2)).otherwise(raw))


def element_text(doc: Column, name: str) -> Column:
    """Text of the first element of that name, null when there is none."""
    pattern = rf"(?is)<{name}(?=[\s/>]){TAG}>(.*?)</{name}\s*>"
    inner = F.regexp_replace(F.regexp_extract(doc, pattern, 1), r"<[^>]*>", "")
    return F.when(doc.rlike(pattern), strip(unescape(inner)))


def summary_target(doc: Column) -> Column:
    """The target named inside the first summary element."""
    return element_text(F.regexp_extract(doc, rf"(?is)<summary(?=[\s/>]){TAG}>(.*?)</summary\s*>", 1), "target")


def has_errors(doc: Column) -> Column:
    """True when the service answered that the report is not ready."""
    return F.coalesce(doc.rlike(r"(?i)<errors(?=[\s/>])"), F.lit(False))


def job_id(doc: Column) -> Column:
    """Job id of a submit response."""
    return F.nullif(strip(F.regexp_extract(doc, r"(?is)<(?:\w+:)?jobid(?=[\s>])[^>]*>([^<]*)<", 1)), F.lit(""))


def _without_comments(doc: Column) -> Column:
    return F.when(F.contains(doc, F.lit("<!--")), F.regexp_replace(doc, r"(?s)<!--.*?-->", "")).otherwise(doc)


def _first_table(pieces: Column) -> Column:
    """The first table, from the text cut before every opening and closing table tag.

    Normally that is the second piece; with tables inside, the pieces up to the tag that closes the first one.
    """

    def step(acc: Column, piece: Column) -> Column:
        depth = acc["depth"] + F.when(piece.startswith("</"), -1).otherwise(1)
        return F.struct(
            depth.alias("depth"),
            (acc["done"] | (depth <= 0)).alias("done"),
            F.when(acc["done"], acc["text"]).otherwise(F.concat(acc["text"], piece)).alias("text"),
        )

    start = F.struct(F.lit(0).alias("depth"), F.lit(False).alias("done"), F.lit("").alias("text"))
    tail = F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 1, F.lit(0)))
    nested = F.aggregate(tail, start, step, lambda acc: acc["text"])
    plain = F.coalesce(F.get(pieces, F.lit(2)).startswith("</"), F.lit(True))
    return F.when(plain, F.get(pieces, F.lit(1))).otherwise(nested)


def with_table_rows(docs: DataFrame, payload: str = "payload") -> DataFrame:
    """Replace the document text by ``table_rows``: the markup of every row of its first table, in order.

    Each step is its own projection, so that every text is computed once and read many times.
    """
    carried = [c for c in docs.columns if c != payload]
    text = F.col("_text")
    cut = F.split(F.concat(F.lit(" "), _without_comments(F.col(payload))), rf"(?=</?{_TABLE})")
    steps = docs.select(*carried, cut.alias("_pieces"))
    steps = steps.select(*carried, _first_table(F.col("_pieces")).alias("_text"))
    steps = steps.select(
        *carried, F.when(text.rlike(_FOREIGN), F.regexp_replace(text, _FOREIGN, "")).otherwise(text).alias("_text")
    )
    steps = steps.select(*carried, F.split(text, r"<[tT][rR](?=[\s/>])").alias("_pieces"))
    n = F.greatest(F.size("_pieces") - 1, F.lit(0))
    return steps.select(*carried, F.slice("_pieces", F.lit(2), n).alias("table_rows"))


def _cells(row: Column, group: int) -> Column:
    return F.regexp_extract_all(row, F.lit(rf"<[tT][dD](?=[\s/>])({TAG})>([^<]*)"), F.lit(group))


def cell_texts(row: Column) -> Column:
    return F.transform(_cells(row, 2), lambda x: strip(unescape(x)))


def header_cells(row: Column) -> Column:
    """Metric name and id of every cell of a header row."""
    return F.transform(
        F.arrays_zip(_cells(row, 1).alias("tag"), _cells(row, 2).alias("text")),
        lambda c: F.struct(strip(unescape(c["text"])).alias("metric"), attribute(c["tag"], "id").alias("metric_id")),
    )


def _label_tag(row: Column) -> Column:
    return F.regexp_extract(row, rf"(?i)<th(?=[\s/>])({TAG})>", 1)


def row_label(row: Column) -> Column:
    """Text of the first label cell, null when the row has none."""
    pattern = rf"(?i)<th(?=[\s/>]){TAG}>([^<]*)"
    return F.when(row.rlike(pattern), strip(unescape(F.regexp_extract(row, pattern, 1))))


def _top_cells(row: Column, spec: ReportSpec) -> Column:
    cells = cell_texts(row)
    return F.transform(cells, lambda x: F.when(~x.isin(*spec.top_blanks), x)) if spec.top_blanks else cells


def _layout_number(spec: ReportSpec) -> Column:
    number = None
    for i, layout in enumerate(spec.layouts):
        fits = F.lit(True)
        if layout.cells is not None:
            fits = fits & (F.col("width") == layout.cells)
        if layout.top_cells is not None:
            fits = fits & (F.size("top") == layout.top_cells)
        number = F.when(fits, i) if number is None else number.when(fits, i)
    return number


def _reject_reason(spec: ReportSpec) -> Column:
    n = F.size("cells")
    reason = F.when(F.col("label").isNull(), F.lit("no_label"))
    if spec.ragged in ("drop", "strict"):
        reason = reason.when(n < F.col("guard"), F.lit("short_row"))
    if spec.ragged == "drop":
        reason = reason.when(n > F.col("guard"), F.lit("long_row"))
    return reason.when(F.col("layout").isNull(), F.lit("unknown_layout"))


#: What a caller puts between the documents and their rows, such as an account of them.
Watch = Callable[[DataFrame], DataFrame]


def parse_tables(landing: DataFrame, spec: ReportSpec, payload: str = "payload", watch: Watch | None = None) -> DataFrame:
    """One row per document: header, upper header, expected widths and the markup of the data rows (null without a table).

    ``watch`` is applied to this frame before anything reads its rows.
    """
    carried = [c for c in landing.columns if c != payload]
    h = spec.header_rows
    target = summary_target(F.col(payload)) if spec.has_target else F.lit(None).cast("string")
    docs = landing.withColumn(payload, resolve_references(F.col(payload)))
    tables = with_table_rows(docs.select(*carried, target.alias("demographic"), payload), payload)
    header_row = F.get("table_rows", F.lit(h - 1))
    top_row = F.get("table_rows", F.lit(0)) if spec.top else F.lit(None).cast("string")
    header_width = F.col("_header_width")
    by_first = spec.width_from == "first_row"
    out = tables.select(
        *carried,
        "demographic",
        header_cells(header_row).alias("header"),
        # counted apart from the cells, which are then not made where only their number is asked for
        F.size(_cells(header_row, 1)).alias("_header_width"),
        F.lower(row_label(header_row)).alias("header_label"),
        _top_cells(top_row, spec).alias("top"),
        F.size(_cells(F.get("table_rows", F.lit(h)), 1)).alias("first_width"),
        F.slice("table_rows", F.lit(h + 1), F.greatest(F.size("table_rows") - h, F.lit(0))).alias("data_rows"),
    ).select(
        *carried, "demographic", "header", "header_label", "top", "data_rows",
        (F.least("first_width", header_width) if by_first else header_width).alias("width"),
        # In compatibility mode the first data row is the guard where layouts drift or rows are cut, else the header.
        (F.col("first_width") if by_first and (len(spec.layouts) > 1 or spec.ragged == "strict") else header_width)
        .alias("guard"),
    )
    return out if watch is None else watch(out)


def parsed_rows(spec: ReportSpec, data_rows: str = "data_rows") -> Column:
    """All data rows of one document as an array of structs, for work that stays inside the document."""
    return F.transform(
        data_rows,
        lambda row, i: F.struct(
            i.alias("row_no"),
            row_label(row).alias("label"),
            *[attribute(_label_tag(row), a).alias(c) for c, a in spec.attributes.items()],
            cell_texts(row).alias("cells"),
        ),
    )


def parse_rows(landing: DataFrame, spec: ReportSpec, payload: str = "payload", watch: Watch | None = None) -> DataFrame:
    """One row per data row of every document, good and bad alike.

    All other columns of the landing frame are carried along; ``reject_reason`` is null for rows that can be read.
    """
    rows = exploded(parse_tables(landing, spec, payload, watch), "data_rows", "row", "row_no")
    tag = _label_tag(F.col("row"))
    parsed = {"label": row_label(F.col("row")), "cells": cell_texts(F.col("row"))}
    for column, name in spec.attributes.items():
        value = attribute(tag, name)
        parsed[column] = drop_brackets(value) if column == "media_type" else value
    rows = computed_once(rows, parsed).drop("row").withColumn("layout", _layout_number(spec))
    return rows.withColumn("reject_reason", _reject_reason(spec))


def fail_on_reject(rows: DataFrame) -> DataFrame:
    """Stop the job at the first rejected row, for reports that must be whole."""
    message = F.concat(F.lit("rejected report row: "), F.col("reject_reason"))
    checked = F.when(F.col("reject_reason").isNotNull(), F.raise_error(message)).otherwise(F.col("reject_reason"))
    return rows.withColumn("reject_reason", checked.cast("string"))


def rejected_rows(rows: DataFrame) -> DataFrame:
    """The quarantine: rows that cannot be read, with their position and the reason."""
    return rows.filter(F.col("reject_reason").isNotNull()).drop("header", "top", "width", "guard", "layout")


def long_facts(rows: DataFrame, spec: ReportSpec, null_attribute: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per readable media row and metric; ``keep`` names row-level columns to carry along."""
    dropped = {
        "demographic", "header", "header_label", "top", "width", "guard", "row_no", "label", "cells", "layout",
        "reject_reason", *spec.attributes,
    }
    carried = [c for c in rows.columns if c not in dropped]
    by_layout = lambda pick: F.element_at(F.array(*[F.lit(pick(x)) for x in spec.layouts]), F.col("layout") + 1)
    n_keys = by_layout(lambda x: len(x.key_cells))
    shift = by_layout(lambda x: x.top_shift)

    entries = F.transform(
        F.sequence(n_keys, F.col("width") - 1),
        lambda j: F.struct(
            F.get("header", j)["metric"].alias("metric"),
            F.get("header", j)["metric_id"].alias("metric_id"),
            F.get("cells", j).alias("value"),
            F.get("top", j - shift).alias("top"),
        ),
    )
    key_names = max((x.key_cells for x in spec.layouts), key=len)
    keys = []
    for i, name in enumerate(key_names):
        missing = F.lit(None if null_attribute else "None").cast("string")
        keys.append(F.when(n_keys > i, F.get("cells", F.lit(i))).otherwise(missing).alias(name))
    # Keys and entries are made first, so that the explode repeats only the keys and not the whole row.
    facts = rows.filter(F.col("reject_reason").isNull()).select(
        *carried, *keep, F.col("label").alias(spec.label), *spec.attributes, *keys,
        *(["demographic"] if spec.has_target else []),
        F.when(n_keys < F.col("width"), entries).alias("entries"),
    )
    facts = exploded(facts, "entries", "entry")
    return facts.select(
        *[c for c in facts.columns if c != "entry"],
        "entry.metric", "entry.metric_id", stripped_to_measure(F.col("entry.value")).alias("metric_value"),
        *([F.col("entry.top").alias(spec.top)] if spec.top else []),
    )
