"""Group-by operators. All reduce on the map side before their one shuffle."""

from __future__ import annotations

import operator
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def gold_rollup(
    df: DataFrame,
    keys: Mapping[str, str],
    count_as: str,
    flags: Mapping[str, str],
    totals: Mapping[str, str],
) -> DataFrame:
    """One row per combination of keys; NULL keys form groups of their own.

    ``keys``, ``flags`` and ``totals`` map published names to columns: the
    grouping keys, the counts of rows where a measure is above 0 (NULL is not),
    and the sums (NULL where a group has no value at all).
    """
    return df.groupBy(*(F.col(c).alias(name) for name, c in keys.items())).agg(
        F.count("*").alias(count_as),
        *(F.count_if(F.col(c) > 0).alias(name) for name, c in flags.items()),
        *(F.sum(c).alias(name) for name, c in totals.items()),
    )


def yearly_totals(
    gold: DataFrame, date: str, measures: Mapping[str, str], year: str = "ANO"
) -> DataFrame:
    """Sums per year in year order; ``measures`` maps output names to columns."""
    return (
        gold.groupBy(F.year(date).alias(year))
        .agg(*(F.sum(c).alias(name) for name, c in measures.items()))
        .orderBy(year)
    )


def drop_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows with all keys present, as plain IS NOT NULL tests a scan can use."""
    return df.filter(reduce(operator.and_, (F.col(k).isNotNull() for k in keys)))


def sum_by(df: DataFrame, measures: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Sums by keys for reporting: NULL keys drop, a sum of no values is 0."""
    return (
        drop_null_keys(df, keys)
        .groupBy(*keys)
        .agg(*(F.coalesce(F.sum(m), F.lit(0)).alias(m) for m in measures))
    )


def rate_by(
    df: DataFrame, key: str, numerator: str, denominator: str, out: str
) -> DataFrame:
    """Ratio of two sums per key; over 0 it is infinite, and NULL for 0 of 0."""
    sums = sum_by(df, [numerator, denominator], [key])
    over_nothing = F.when(F.col(numerator) != 0, F.lit(float("inf")) * F.signum(numerator))
    return sums.withColumn(
        out,
        F.when(F.col(denominator) == 0, over_nothing).otherwise(
            F.try_divide(F.col(numerator), F.col(denominator))
        ),
    )


def kpi(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Grand totals, all in one pass; 0 for no rows."""
    return df.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in cols))
