"""Month arithmetic and period labels."""

from __future__ import annotations

import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# The first available month and its period id.
START_DATE = datetime.date(2015, 1, 1)
START_PERIOD_ID = 181


def month_start(c: Column) -> Column:
    """Any date or timestamp to the first of its month."""
    return F.trunc(c.cast("date"), "MM")


def parse_date(c: Column) -> Column:
    return F.to_date(c, "yyyy-MM-dd")


def month_name(c: Column) -> Column:
    return F.date_format(c, "MMMM")


def period_id(c: Column, start: datetime.date = START_DATE, start_id: int = START_PERIOD_ID) -> Column:
    """Whole months from the start date, offset by the start id."""
    months = (F.year(c) - F.lit(start.year)) * 12 + (F.month(c) - F.lit(start.month))
    return (months + F.lit(start_id)).cast("int")


def period_labels(c: Column) -> dict[str, Column]:
    """The label columns every report carries for its month."""
    return {"month": month_name(c), "year": F.year(c)}
