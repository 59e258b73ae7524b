"""Choosing the measurement extracts of one territorial office."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riverload.fixed_values import KIND_NETWORK, KIND_PLANT, OFFICE_EXTRACTS, OFFICE_MANAGERS
from riverload.sources.tables import read_table, union_by_position

Catalog = dict[tuple[str, str], list[str]]


def office_catalog(folder: str, suffix: str) -> Catalog:
    """Paths of the extracts per (office, kind): one each, for one office two."""
    return {
        (office, kind): [f"{folder}/{kind}_{part}{suffix}"
                         for part in OFFICE_EXTRACTS.get(office, (office,))]
        for office in OFFICE_MANAGERS for kind in (KIND_PLANT, KIND_NETWORK)
    }


def select_office_source(
    spark: SparkSession, office: str, kind: str, catalog: Catalog, fmt: str, schema: T.StructType
) -> DataFrame:
    """Measures of one office and kind, with the kind as a column."""
    if (office, kind) not in catalog:
        raise ValueError(f"no extract for office {office!r}, kind {kind!r}")
    extracts = [read_table(spark, path, fmt, schema) for path in catalog[office, kind]]
    return union_by_position(extracts).withColumn("kind", F.lit(kind))


def office_rows(df: DataFrame, office: str, kind: str | None = None) -> DataFrame:
    """The same choice on one table partitioned by office: only its partitions are read."""
    chosen = df.where(F.col("DT") == office)
    return chosen if kind is None else chosen.where(F.col("kind") == kind)
