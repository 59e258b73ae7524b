"""Joins in which a missing key matches a missing key.

Spark plans ``<=>`` as an ordinary equi-join on the null-replaced key, so the
shuffle feeding it is always inserted by the planner. That is the kind of
exchange the adaptive skew join may split, which matters because the rows
without origin form one null-key group of any size.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame

Keys = str | list[str | tuple[str, str]]


def _pairs(on: Keys) -> list[tuple[str, str]]:
    keys = [on] if isinstance(on, str) else on
    return [(k, k) if isinstance(k, str) else k for k in keys]


def null_safe_join(
    left: DataFrame, right: DataFrame, on: Keys, how: str = "inner", grows: bool = False
) -> DataFrame:
    """Equi-join on ``on`` (names, or ``(left, right)`` pairs) with null = null.

    Key columns come from ``left``. Any other column name must occur on one
    side only, so that no column is renamed silently. ``grows`` says that ``right``
    grows with the data: both sides are then always exchanged. Written stages compress
    so well that Spark's size check takes a large one for small, and a broadcast
    planned from that gathers it on the driver.
    """
    pairs = _pairs(on)
    temp = {r: f"_key_{i}" for i, (_, r) in enumerate(pairs)}
    other = right.select([right[c].alias(temp.get(c, c)) for c in right.columns])
    clash = set(left.columns) & {c for c in right.columns if c not in temp}
    if clash and how not in ("left_semi", "left_anti"):
        raise ValueError(f"column names on both sides of the join: {sorted(clash)}")
    condition = _all(left[l].eqNullSafe(other[temp[r]]) for l, r in pairs)
    joined = left.join(other.hint("merge") if grows else other, condition, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*temp.values())


def members(df: DataFrame, column: str, other: DataFrame, other_column: str | None = None) -> DataFrame:
    """Rows of ``df`` whose ``column`` occurs in ``other``; never unknown."""
    key = other_column or column
    return null_safe_join(df, other.select(key), [(column, key)], "left_semi")


def non_members(df: DataFrame, column: str, other: DataFrame, other_column: str | None = None) -> DataFrame:
    """Rows of ``df`` whose ``column`` does not occur in ``other``; never unknown."""
    key = other_column or column
    return null_safe_join(df, other.select(key), [(column, key)], "left_anti")


def _all(conditions) -> Column:
    return reduce(lambda a, b: a & b, conditions)
