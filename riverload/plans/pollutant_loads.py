"""Measures to daily and annual loads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riverload.fixed_values import (
    KIND_NETWORK, KIND_PLANT, LABEL_MEASURED_PLANT, MEASURE_NAMES, NETWORK_ATTRIBUTES, PLANT_ATTRIBUTES,
)
from riverload.operators import loads
from riverload.operators.cleaning import clean_measures
from riverload.sources.tables import rename_columns
from riverload.stages import Stages


def measures_from_extract(extract: DataFrame, kind: str) -> DataFrame:
    """One kind's extract under the working names; what has no such name stays as delivered."""
    return rename_columns(extract, MEASURE_NAMES).withColumn("kind", F.lit(kind))


def prepared_measures(measures: DataFrame, kind: str) -> DataFrame:
    """Cleaned measures of one kind that can take part in a load, written once.

    Flow and concentrations are read from it several times; without the stage
    each reading would repeat the scan and the shuffle of the cleaning.
    """
    attributes = PLANT_ATTRIBUTES if kind == KIND_PLANT else NETWORK_ATTRIBUTES
    rows = loads.needed_measures(measures.where(F.col("kind") == kind))
    columns = ["DT", "Code_SANDRE", *attributes, "Pt_SANDRE", "Date_debut_prel",
               "Code_sandre_parametre", "Val_resultat_analyse", "Code_remarque",
               "Derniere_qualif_analyse", "Commentaire_analyse"]
    return Stages(measures.sparkSession, "loads").write(
        clean_measures(rows).select(*columns), kind)


def plant_daily(measures: DataFrame, params: DataFrame) -> DataFrame:
    """Daily loads of plants.

    The measured days are output and also the base of the ratios: written once,
    instead of joining flow and concentrations twice.
    """
    cleaned = prepared_measures(measures, KIND_PLANT)
    days, conc = loads.flow_and_concentrations(cleaned, params, PLANT_ATTRIBUTES)
    measured = Stages(measures.sparkSession, "loads").write(
        loads.measured_load(days, conc, params, LABEL_MEASURED_PLANT), "measured")
    ratio = loads.flow_weighted_ratio(measured)
    imputed = loads.impute_plant_load(loads.flagged_days(days, conc), ratio, params)
    return loads.assemble_daily(measured, imputed)


def network_daily(measures: DataFrame, params: DataFrame, as_written: bool = True) -> DataFrame:
    """Daily loads of networks."""
    return loads.network_daily_loads(
        prepared_measures(measures, KIND_NETWORK), params, as_written=as_written)


def plant_annual(measures: DataFrame, params: DataFrame) -> DataFrame:
    return loads.annual_load_plants(plant_daily(measures, params))


def network_annual(measures: DataFrame, params: DataFrame, as_written: bool = True) -> DataFrame:
    return loads.annual_load_networks(network_daily(measures, params, as_written))
