"""Invented report documents."""

from __future__ import annotations

import datetime

LANDING = "request_id string, data_date date, timeframe string, categories string, payload string"
MARCH = datetime.date(2019, 3, 1)


def cell(text, metric_id=None):
    return "<td/>" if text is None else f'<td id="{metric_id}">{text}</td>' if metric_id else f"<td>{text}</td>"


def row(label, cells, **attributes):
    tags = "".join(f' {k}="{v}"' for k, v in attributes.items())
    return f"<tr><th{tags}>{label}</th>{''.join(cell(c) for c in cells)}</tr>"


def header(cells, label="Media"):
    return f"<tr><th>{label}</th>{''.join(cell(*c) if isinstance(c, tuple) else cell(c) for c in cells)}</tr>"


def doc(*rows, summary=""):
    return f"<Envelope><Body>{summary}<table>{''.join(rows)}</table></Body></Envelope>"


def target(text):
    return f"<summary><geo>US</geo><target> {text} </target></summary>"


def landing(spark, *payloads, **extra):
    rows = [(f"r{i}", MARCH, "1 month average", "custom entities", p) for i, p in enumerate(payloads)]
    return spark.createDataFrame(rows, LANDING)


def rows_of(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]
