"""Tables to report documents: the inverse of the parser, used to prove it by round trip."""

from __future__ import annotations

import html
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.text import escape


def _cell(text: Column) -> Column:
    return F.concat(F.lit("<td>"), escape(F.coalesce(text, F.lit(""))), F.lit("</td>"))


def data_row(label: Column, attributes: dict[str, Column], cells: Column) -> Column:
    """One ``<tr>``; attributes that are null are left out."""
    tags = [
        F.when(v.isNotNull(), F.concat(F.lit(f' {k}="'), escape(v), F.lit('"'))).otherwise(F.lit(""))
        for k, v in attributes.items()
    ]
    return F.concat(
        F.lit("<tr><th"), *tags, F.lit(">"), escape(label), F.lit("</th>"),
        F.array_join(F.transform(cells, _cell), ""), F.lit("</tr>"),
    )


def header_row(label: str, metrics: Column) -> Column:
    """``metrics`` is an array of structs (metric, metric_id)."""
    cell = lambda m: F.concat(
        F.lit("<td"),
        F.when(m["metric_id"].isNotNull(), F.concat(F.lit(' id="'), escape(m["metric_id"]), F.lit('"'))).otherwise(F.lit("")),
        F.lit(">"), escape(m["metric"]), F.lit("</td>"),
    )
    return F.concat(F.lit(f"<tr><th>{label}</th>"), F.array_join(F.transform(metrics, cell), ""), F.lit("</tr>"))


def fixed_row(cells: Sequence[tuple[str, str | None]], label: str = "") -> Column:
    """A header row that is the same for all documents: (text, id) pairs."""
    quote = lambda t: html.escape(t, quote=True)
    tds = "".join(f"<td>{quote(t)}</td>" if i is None else f'<td id="{quote(i)}">{quote(t)}</td>' for t, i in cells)
    return F.lit(f"<tr><th>{quote(label)}</th>{tds}</tr>")


def document(rows_markup: Column, *headers: Column, target: Column | None = None) -> Column:
    """A whole response: envelope, optional summary, one table."""
    summary = (
        [F.lit("<Summary><Target>"), escape(target), F.lit("</Target></Summary>")] if target is not None else []
    )
    return F.concat(
        F.lit("<Envelope><Body><Report>"), *summary, F.lit("<TABLE><THEAD>"), *headers, F.lit("</THEAD><TBODY>"),
        rows_markup, F.lit("</TBODY></TABLE></Report></Body></Envelope>"),
    )


def collect_documents(rows: DataFrame, request: Sequence[str], order: str, row: str = "row") -> DataFrame:
    """Join the row markup of each request in order.

    Meant for rows that are already aggregated to the labels of a report, so that a request holds as many rows as the
    report has labels, whatever the size of the data behind it.
    """
    ordered = F.array_sort(F.collect_list(F.struct(order, row)))
    return rows.groupBy(*request).agg(F.array_join(F.transform(ordered, lambda r: r[row]), "").alias("rows_markup"))
