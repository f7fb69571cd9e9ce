"""Facets and the faceted filter."""

from __future__ import annotations

import datetime
from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from bronzeway.functions.dates import within_years
from bronzeway.operators.profile import value_counts


def year_bounds(df: DataFrame, date: str) -> DataFrame:
    """First and last year; the extremes of the date are enough to know them."""
    return df.agg(
        F.year(F.min(date)).alias("min_year"), F.year(F.max(date)).alias("max_year")
    )


def facets(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """The values to choose from: ``column, value``, NULL included."""
    return value_counts(df, cols).select("column", "value")


def _literal(value) -> str:
    """A value as SQL text, typed as the literal of it would be."""
    if isinstance(value, str):
        quoted = value.replace("\\", "\\\\").replace("'", "\\'")
        return f"'{quoted}'"
    if isinstance(value, bool):
        return str(value).upper()
    if isinstance(value, datetime.datetime):
        return f"TIMESTAMP'{value.isoformat(' ')}'"
    if isinstance(value, datetime.date):
        return f"DATE'{value.isoformat()}'"
    if isinstance(value, int):
        return str(value)
    if isinstance(value, float):
        return f"double('{value!r}')"
    if isinstance(value, Decimal):
        return f"{value:f}BD"
    raise TypeError(f"no selection by {type(value).__name__}")


def _selected(column: str, values: Sequence, kind: DataType) -> Column:
    """Whether a column has one of the values, which are read as its type.

    A value that isn't of the type selects nothing. The list is one expression, parsed
    at once however long it is, and its literals reach the scan.
    """
    listed = dict.fromkeys(v for v in values if v is not None)
    c, name = F.col(column), column.replace("`", "``")
    hit = F.lit(False)
    if listed:
        items = ", ".join(f"try_cast({_literal(v)} AS {kind.simpleString()})" for v in listed)
        hit = F.expr(f"`{name}` IN ({items})")
    return hit | c.isNull() if None in values else hit


def facet_filter(
    df: DataFrame,
    date: str | None = None,
    years: tuple[int, int] | None = None,
    selections: Mapping[str, Sequence] | None = None,
) -> DataFrame:
    """Rows within the years (both included) and the selected values.

    An empty selection means all values and then NULLs stay too. The year range
    is put as a range of the date column so that the scan can skip by it.
    """
    if years is not None:
        df = df.filter(within_years(F.col(date), *years))
    for column, values in (selections or {}).items():
        if values:
            df = df.filter(_selected(column, values, df.schema[column].dataType))
    return df
