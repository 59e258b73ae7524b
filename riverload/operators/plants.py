"""Plants of an office that have no annual load."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riverload.fixed_values import OFFICE_MANAGERS, PLANT_LIST_NAMES, SITUATION_CLOSED
from riverload.functions.joins import members, non_members
from riverload.sources.tables import select_rename


def office_managers(spark: SparkSession, office: str | None = None) -> DataFrame:
    """Managing units per office (``DT, gestionnaire``); one office has two."""
    rows = [(dt, unit) for dt, units in OFFICE_MANAGERS.items() for unit in units]
    table = spark.createDataFrame(rows, "DT string, gestionnaire string")
    return table if office is None else table.where(F.col("DT") == office)


def plants_without_data(plants: DataFrame, annual: DataFrame, managers: DataFrame) -> DataFrame:
    """Plants in service, of the given managing units, absent from ``annual``."""
    in_service = plants.where(F.col("IDTYPE_SITUATION") != SITUATION_CLOSED)
    managed = members(in_service, "UNITE GESTIONNAIRE", managers, "gestionnaire")
    return non_members(select_rename(managed, PLANT_LIST_NAMES), "Code_SANDRE", annual)
