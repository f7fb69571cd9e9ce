"""Cleaning steps over named columns.

Each step is one projection; a job that needs several for the same table puts
the expressions of ``bronzeway.functions`` together in one ``clean`` instead.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bronzeway.functions import dates, numbers, recode as recodes, text
from bronzeway.operators.schema import clean
from bronzeway.values import NULL_TOKENS


def _each(df: DataFrame, cols: str | Sequence[str], rule) -> DataFrame:
    names = [cols] if isinstance(cols, str) else cols
    return clean(df, {name: rule(F.col(name)) for name in names})


def replace_null_tokens(
    df: DataFrame,
    cols: str | Sequence[str],
    value: str | None = None,
    tokens: Sequence[str] = NULL_TOKENS,
) -> DataFrame:
    """NULL and the null tokens become ``value``."""
    return _each(df, cols, lambda c: text.null_token(c, tokens, value))


def lowercase(df: DataFrame, cols: str | Sequence[str]) -> DataFrame:
    return _each(df, cols, F.lower)


def strip_lowered(df: DataFrame, cols: str | Sequence[str], removed: str) -> DataFrame:
    """Lower-case, then take ``removed`` out wherever it occurs."""
    return _each(df, cols, lambda c: text.lower_without(c, removed))


def parse_date_multi(
    df: DataFrame,
    cols: str | Sequence[str],
    shapes: Sequence[tuple[str, str]],
    otherwise: str,
) -> DataFrame:
    return _each(df, cols, lambda c: dates.date_by_shape(c, shapes, otherwise))


def parse_decimal_comma(df: DataFrame, cols: str | Sequence[str]) -> DataFrame:
    return _each(df, cols, numbers.comma_float)


def parse_int(df: DataFrame, cols: str | Sequence[str]) -> DataFrame:
    return _each(df, cols, numbers.lenient_int)


def zero_pad_code(
    df: DataFrame, cols: str | Sequence[str], width: int, null_text: str | None = None
) -> DataFrame:
    """Text of an integer code, zero-padded; text codes are parsed first."""
    parsed = _each(df, cols, lambda c: numbers.lenient_int(c.cast("string")))
    return _each(parsed, cols, lambda c: numbers.padded_code(c, width, null_text))


def recode(
    df: DataFrame,
    col: str,
    mapping: Mapping[str, str] | DataFrame,
    otherwise: str = "keep",
    to_null: Sequence[str] = (),
) -> DataFrame:
    """Replace listed values; ``otherwise`` is ``keep`` or ``null`` for the rest.

    A literal ``mapping`` becomes an expression. A frame (first column the old
    value, second the new) is joined; whether it is broadcast is left to its
    size. Its keys are made unique first, as a double key would multiply rows.
    """
    keep = otherwise == "keep"
    if isinstance(mapping, Mapping):
        return clean(df, {col: recodes.lookup(F.col(col), mapping, to_null, keep)})
    old, new = mapping.columns[:2]
    table = (
        mapping.groupBy(F.col(old).alias("_old"))
        .agg(F.min(new).alias("_new"))
        .filter(F.col("_old").isNotNull())
    )
    joined = df.join(table, F.col(col) == F.col("_old"), "left")
    rest = F.col(col) if keep else F.lit(None)
    value = F.when(F.col("_old").isNotNull(), F.col("_new")).otherwise(rest)
    if to_null:
        value = F.when(~F.col(col).isin(*to_null), value)
    return joined.withColumn(col, value).drop("_old", "_new")


def recode_rules(
    df: DataFrame, col: str, rules: Sequence[tuple], otherwise: str = "keep"
) -> DataFrame:
    return clean(df, {col: recodes.by_rules(F.col(col), rules, otherwise == "keep")})


def with_year(df: DataFrame, col: str, out: str) -> DataFrame:
    """The year of a date, timestamp or ISO text as an integer."""
    return df.withColumn(out, F.year(F.col(col).cast("date")))


def truncate_label(df: DataFrame, col: str, width: int = 35) -> DataFrame:
    return _each(df, col, lambda c: text.cut_label(c, width))


def display_number(df: DataFrame, col: str, style: str, out: str | None = None) -> DataFrame:
    return df.withColumn(out or col, text.number_text(F.col(col), style))
