"""Counts by key joined to a dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bronzeway.operators.rollup import sum_by


def aggregate_and_join(
    df: DataFrame,
    dim: DataFrame,
    measure: str,
    df_key: str,
    dim_key: str,
    having_gt: int | None = None,
) -> DataFrame:
    """Sum a measure by key, then join the sums to a dimension.

    Both key columns stay; keys without a partner drop. Summing first leaves
    one row per key for the join, already partitioned by that key, so only the
    dimension moves again. No side is hinted for broadcast: which one is small
    enough is known from the shuffle sizes at run time. ``having_gt`` keeps the
    keys whose sum is above it, before the join.
    """
    sums = sum_by(df, [measure], [df_key])
    if having_gt is not None:
        sums = sums.filter(F.col(measure) > having_gt)
    return dim.join(sums, dim[dim_key] == sums[df_key], "inner")
