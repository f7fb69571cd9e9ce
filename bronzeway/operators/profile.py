"""Column profiles: one scan and one shuffle however many columns are asked."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bronzeway.functions.text import digit_mask


def value_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Distinct values of several columns as text: ``column, value, n``."""
    return (
        df.select(*(F.col(c).cast("string").alias(c) for c in cols))
        .unpivot([], list(cols), "column", "value")
        .groupBy("column", "value")
        .agg(F.count("*").alias("n"))
    )


# Parts in which the values of a column are ranked before all of it is.
_PARTS = 64


def _first_per_column(counts: DataFrame, limit: int | None) -> DataFrame:
    """The first ``limit`` values of each column, in value order.

    A column is ranked in parts, by a hash of the value, and then over the first
    ``limit`` of each part, so no task gets all values of a column.
    """
    if limit is None:
        return counts
    parts = counts.withColumn("_part", F.pmod(F.xxhash64("value"), F.lit(_PARTS)))
    for keys in (["column", "_part"], ["column"]):
        order = Window.partitionBy(*keys).orderBy("value")
        parts = parts.withColumn("_place", F.row_number().over(order)).filter(
            F.col("_place") <= limit
        )
    return parts.drop("_place", "_part")


def profile_values(df: DataFrame, cols: Sequence[str], limit: int | None = None) -> DataFrame:
    """Distinct values per column with their counts, optionally the first few."""
    return _first_per_column(value_counts(df, cols), limit)


def profile_formats(df: DataFrame, cols: Sequence[str], limit: int | None = None) -> DataFrame:
    """Distinct number formats per column: values with every digit as ``D``."""
    masked = df.select(*(digit_mask(F.col(c).cast("string")).alias(c) for c in cols))
    return _first_per_column(value_counts(masked, cols), limit)


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).distinct()
