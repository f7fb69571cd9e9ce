"""Line geometry grouped by a key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bronzeway.operators.rollup import drop_null_keys


def dissolve_parts(df: DataFrame, key: str, parts: str = "parts") -> DataFrame:
    """The distinct lines of each key, one per row: ``key, part``.

    These rows are the key's geometry together, however many there are. NULL keys
    drop, as in every group-by of the reporting side.

    A line and its reverse cover the same points, so they count as one. Rows
    are spread by key and line together: a key with most of the lines is
    shared by many tasks. A key without any line has one row with a NULL part.
    """
    line = F.col("part")
    return (
        drop_null_keys(df, [key])
        .select(key, F.explode_outer(parts).alias("part"))
        .select(key, F.least(line, F.reverse(line)).alias("part"))
        .distinct()
    )
