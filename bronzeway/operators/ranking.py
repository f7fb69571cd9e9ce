"""Top rows, shares, flags, scales and classes over aggregated frames.

Grand totals and extremes enter as scalar subqueries: they are reduced on the
map side and leave the rows where they are, so no frame is gathered in one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bronzeway.sources.tables import stored


def top_table(
    df: DataFrame, key: str, measure: str, n: int = 15, value_alias: str | None = None
) -> DataFrame:
    """The ``n`` rows with the largest measure, NULL last, ties by key."""
    return (
        df.select(key, measure)
        .orderBy(F.desc_nulls_last(measure), F.asc(key))
        .limit(n)
        .withColumnRenamed(measure, value_alias or measure)
    )


def share_of_total(df: DataFrame, measure: str, out: str = "PERCENTUAL") -> DataFrame:
    total = df.agg(F.sum(measure)).scalar()
    return df.withColumn(out, F.try_divide(F.col(measure), total))


def top_n_with_others(
    df: DataFrame,
    label: str,
    measure: str,
    n: int = 10,
    others: str = "Outros",
    share: str = "PERCENTUAL",
) -> DataFrame:
    """The ``n`` largest rows and one row for the remainder, with their shares.

    ``df`` has one row per label. The remainder row is always there, with 0 if
    nothing remains. The remainder is summed where its rows are.
    """
    order = (F.desc_nulls_last(measure), F.asc(label))
    # n rows at most from here on, so one task may order them.
    top = (
        df.orderBy(*order)
        .limit(n)
        .select(
            F.col(label).alias("_label"),
            F.row_number().over(Window.orderBy(*order)).alias("_rank"),
        )
    )
    marked = df.join(top, F.col(label).eqNullSafe(F.col("_label")), "left")
    nothing_left = df.sparkSession.range(1).select(
        F.lit(n + 1).alias("_rank"),
        F.lit(None).cast(df.schema[label].dataType).alias("_label"),
        F.lit(0).cast(df.schema[measure].dataType).alias(measure),
    )
    folded = (
        marked.select(F.coalesce("_rank", F.lit(n + 1)).alias("_rank"), "_label", measure)
        .union(nothing_left)
        .groupBy("_rank", "_label")
        .agg(F.sum(measure).alias(measure))
    )
    # n + 1 rows: the window below is over these alone.
    total = F.sum(measure).over(Window.partitionBy())
    return (
        folded.select(
            F.when(F.col("_rank") > n, F.lit(others)).otherwise(F.col("_label")).alias(label),
            measure,
            F.try_divide(F.col(measure), total).alias(share),
            "_rank",
        )
        .orderBy("_rank")
        .drop("_rank")
    )


def with_position(
    df: DataFrame, order: Sequence[Column | str], out: str = "position"
) -> DataFrame:
    """Every row with its place, from 1, in the order of all rows.

    Rows are dealt by ranges of the order and numbered in their partition; what
    is in front of a partition is the sum of the counts before it, one number a
    partition. Equal rows are told apart by where they were read, so that a key
    most rows have is cut over many partitions too; which of them comes first is
    open. The numbered rows are stored: both passes must see the same ranges.
    """
    tie = "".join(["_tie", *df.columns])
    rows = df.withColumn(tie, F.monotonically_increasing_id())
    dealt = rows.repartitionByRange(*order, tie).sortWithinPartitions(*order, tie)
    numbered = stored(dealt.drop(tie).withColumn(out, F.monotonically_increasing_id()), "numbered")
    # A row's id is its partition and, in the lower 33 bits, its place there.
    part, place = F.shiftright(out, 33), F.col(out).bitwiseAND((1 << 33) - 1)
    counts = dict(numbered.groupBy(part.cast("int").alias("part")).agg(F.count("*")).collect())
    sizes = [counts.get(i, 0) for i in range(max(counts, default=0) + 1)]
    fronts = F.from_json(F.lit(str([0, *accumulate(sizes)])), "array<bigint>")
    return numbered.withColumn(out, F.get(fronts, part.cast("int")) + place + 1)


def flag_max(df: DataFrame, measure: str, out: str = "is_max") -> DataFrame:
    """Marks every row that equals the maximum; largest first."""
    largest = df.agg(F.max(measure)).scalar()
    return df.withColumn(out, F.col(measure) == largest).orderBy(
        F.desc_nulls_last(measure)
    )


def _extent(df: DataFrame, measure: str) -> Column:
    value = F.col(measure).cast("double")
    return df.agg(F.struct(F.min(value).alias("lo"), F.max(value).alias("hi"))).scalar()


def minmax_scale(df: DataFrame, measure: str, out: str = "scaled") -> DataFrame:
    """Position between the smallest (0) and largest (1) value; 0 if all are equal."""
    extent = _extent(df, measure)
    lo, hi = extent["lo"], extent["hi"]
    scaled = (F.col(measure).cast("double") - lo) / (hi - lo)
    return df.withColumn(out, F.when(hi > lo, scaled).when(F.col(measure).isNotNull(), 0.0))


def class_breaks(df: DataFrame, measure: str, n: int = 6) -> DataFrame:
    """The ``n + 1`` evenly spaced limits of ``n`` classes: ``position, value``."""
    value = F.col(measure).cast("double")
    extent = df.agg(F.min(value).alias("lo"), F.max(value).alias("hi"))
    limits = F.transform(
        F.sequence(F.lit(0), F.lit(n)),
        lambda i: F.col("lo") + (F.col("hi") - F.col("lo")) * i / n,
    )
    return extent.select(F.posexplode(limits).alias("position", "value"))


def classify_equal_width(
    df: DataFrame, measure: str, n: int = 6, out: str = "class"
) -> DataFrame:
    """Class 1 to ``n`` of equal width; the maximum is in the last one."""
    scaled = minmax_scale(df, measure, out)
    return scaled.withColumn(
        out, F.least(F.floor(F.col(out) * n) + 1, F.lit(n)).cast("int")
    )
