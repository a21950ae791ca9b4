"""Numeric parsing and missing-value rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.functions.text import strip

# A plain decimal number or an infinity. Java's '1d' / '2f' suffixes, '1,234', '0x10' and 'NaN' are not numbers here.
NUMBER = r"^[+-]?(?:(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?|[iI][nN][fF](?:[iI][nN][iI][tT][yY])?)$"


def stripped_to_number(text: Column) -> Column:
    """Text without surrounding white space to double; whatever is not a number becomes null."""
    return F.when(text.rlike(NUMBER), text.try_cast("double"))


def stripped_to_measure(text: Column) -> Column:
    """The same in the 32-bit measure type, parsed as 64-bit first."""
    return stripped_to_number(text).cast("float")


def to_number(c: Column) -> Column:
    return stripped_to_number(strip(c))


def to_measure(c: Column) -> Column:
    return stripped_to_measure(strip(c))


def nan_to_null(df: DataFrame) -> DataFrame:
    """Replace NaN by null in every floating column; text columns are left alone."""
    floating = (T.FloatType, T.DoubleType)
    swept = {
        f.name: F.nullif(F.col(f"`{f.name}`"), F.lit(float("nan")).cast(f.dataType))
        for f in df.schema
        if isinstance(f.dataType, floating)
    }
    return df.withColumns(swept) if swept else df
