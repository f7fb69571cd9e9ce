"""Projection, renaming, drift and schema comparison."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def project(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """A fixed list of columns, in that order."""
    return df.select(*columns)


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def clean(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Overwrite columns in place, all in one projection."""
    return df.withColumns(dict(rules))


def union_drifting(frames: Sequence[DataFrame]) -> DataFrame:
    """Rows of all frames by column name; what a frame lacks is NULL.

    Names meet without regard to case, in lower case; new columns go to the end.
    """
    lowered = (df.toDF(*(c.lower() for c in df.columns)) for df in frames)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), lowered)


def describe_schema(df: DataFrame, source: str | None = None) -> DataFrame:
    """One row per column: position, name, type (and the source it describes)."""
    rows = [
        (source, position, field.name, field.dataType.simpleString())
        for position, field in enumerate(df.schema, start=1)
    ]
    described = df.sparkSession.createDataFrame(
        rows, "source string, position int, column string, type string"
    )
    return described if source is not None else described.drop("source")


def column_presence(
    spark: SparkSession, columns_by_source: Mapping[str, Sequence[str]]
) -> DataFrame:
    """Each column with the number of sources that have it."""
    rows = [(s, c) for s, columns in columns_by_source.items() for c in columns]
    return (
        spark.createDataFrame(rows, "source string, column string")
        .groupBy("column")
        .agg(F.count_distinct("source").alias("n_sources"))
    )


def common_columns(
    spark: SparkSession, columns_by_source: Mapping[str, Sequence[str]]
) -> DataFrame:
    """Columns that every source has."""
    return (
        column_presence(spark, columns_by_source)
        .filter(F.col("n_sources") == len(columns_by_source))
        .select("column")
    )


def peek(df: DataFrame, n: int = 20, order_by: Sequence[str] = ()) -> DataFrame:
    """The first rows, for looking at; without ``order_by`` any ``n`` rows."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)


def sample_rows(
    df: DataFrame, fraction: float, seed: int, key: str | None = None
) -> DataFrame:
    """A share of the rows.

    With a ``key`` a row is in or out by the hash of its key, so the sample
    stays the same however the data are partitioned.
    """
    if key is None:
        return df.sample(fraction, seed)
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")))
    position = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
    return df.filter(position < int(fraction * 2**32))


def sample_blocks(
    spark: SparkSession, path: str, fraction: float, seed: int, spread: float = 2.0
) -> DataFrame:
    """About a share of the rows of a Parquet table, from few of its files.

    First files are drawn, ``spread`` times the share of them and one at least, in the
    order of a seeded hash of their names; then rows of these, so many that a row is
    in with the probability ``fraction``. So what is read is about ``spread`` times
    what is kept, where a sample of rows reads all. Rows of a file are often alike: a
    larger ``spread`` reads more files for it. ``weight`` is how many rows of the table
    a sampled one stands for, and sums to about their number.
    """
    listed = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .load(path)
        .select("path", "length")
    )
    drawn = F.xxhash64(F.lit(seed), F.regexp_extract("path", "[^/]*$", 0))
    n = listed.count()
    files = max(1, min(n, round(spread * fraction * n)))
    chosen = listed.orderBy(drawn, "path").limit(files).select("path").collect()
    share = files / n if n else 1.0
    within = min(1.0, fraction / share)
    # Partition columns are part of the paths; the first row groups tell the others.
    rows = spark.read.option("basePath", path).option("mergeSchema", "true")
    rows = rows.parquet(*(r.path for r in chosen)) if chosen else rows.parquet(path)
    return rows.sample(within, seed).withColumn("weight", F.lit(1 / (share * within)))
