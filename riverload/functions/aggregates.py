"""Aggregations that follow the missing-value rules of the domain."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def count_values(df: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """Number of different ``value`` per ``key``; a missing value counts as one.

    Both levels are combined before their shuffle, so a key (the null key
    included) that holds a large part of the rows only costs its distinct values.
    """
    return df.select(key, value).distinct().groupBy(key).agg(F.count("*").alias(name))


def sum_or_zero(value: str | Column) -> Column:
    """Sum that ignores missing values and is 0 when nothing is left."""
    return F.coalesce(F.sum(value), F.lit(0.0))


def stack(*frames: DataFrame) -> DataFrame:
    """Stack by column name; a column absent from one frame is null there."""
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame, allowMissingColumns=True)
    return result
