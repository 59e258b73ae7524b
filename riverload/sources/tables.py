"""Reading tables and fixing their columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riverload.functions.aggregates import stack
from riverload.functions.columns import grouped_decimal_comma


def read_table(
    spark: SparkSession, path: str | list[str], fmt: str, schema: T.StructType, **options
) -> DataFrame:
    """Read one exported table (``parquet``, ``csv``, ``json``, ``orc``) with its schema."""
    if fmt == "csv":
        options = {"header": True, "enforceSchema": False} | options
    return spark.read.format(fmt).schema(schema).options(**options).load(path)


def read_delimited_fr(
    spark: SparkSession, path: str | list[str], numeric: Iterable[str] = ()
) -> DataFrame:
    """Read ``;``-separated text with blanks trimmed.

    Columns named in ``numeric`` hold numbers like ``1.234,5`` and become
    doubles; all others stay text, so codes keep their leading zeros.
    """
    df = spark.read.options(
        sep=";", header=True, ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True,
    ).csv(path)
    return df.withColumns({c: grouped_decimal_comma(F.col(f"`{c}`")) for c in numeric})


def select_rename(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Keep the columns of ``names`` (source -> working name); all must exist."""
    missing = [c for c in names if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df.select([df[f"`{c}`"].alias(new) for c, new in names.items()])


def rename_columns(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Rename the columns of ``names`` (source -> working name), which must all exist; others stay."""
    missing = [c for c in names if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df.withColumnsRenamed(names)


def column_by_position(df: DataFrame, name: str, position: int) -> DataFrame:
    """Name the column at the 1-based ``position``.

    A header that repeats is renamed by readers in ways of their own; the
    position is what identifies the column in the source.
    """
    if not 1 <= position <= len(df.columns):
        raise ValueError(f"position {position} outside 1..{len(df.columns)}")
    names = list(df.columns)
    names[position - 1] = name
    return df.toDF(*names)


def union_by_position(frames: Iterable[DataFrame]) -> DataFrame:
    """Stack extracts column by column, under the names of the first one."""
    first, *rest = frames
    for frame in rest:
        first = first.union(frame)
    return first


def pivot_parameters(
    df: DataFrame, keys: Iterable[str] | None = None, by: Iterable[str] = ()
) -> DataFrame:
    """Rows (``Variable``, ``Valeur``) to one wide row, or one per ``by`` group.

    Giving the expected ``keys`` fixes the columns and saves a pass over the data.
    """
    named = df.where(F.col("Variable").isNotNull())
    return (named.groupBy(*by)
            .pivot("Variable", None if keys is None else list(keys))
            .agg(F.max("Valeur")))


def contributors_table(df: DataFrame) -> DataFrame:
    """Nested contributor records to a flat table, largest contribution first."""
    return df.select(
        F.col("author.login").alias("name"),
        F.col("author.login").alias("title"),
        F.col("author.type").alias("group"),
        F.col("total").alias("value"),
    ).orderBy(F.desc_nulls_last("value"))


__all__ = [
    "column_by_position", "contributors_table", "pivot_parameters", "read_delimited_fr",
    "read_table", "rename_columns", "select_rename", "stack", "union_by_position",
]
