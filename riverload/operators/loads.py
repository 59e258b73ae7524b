"""Daily and annual pollutant loads from flow and concentration.

A day of flow meets the concentrations by (station, point, day). Which
pollutants were measured on a day is carried as one bit per pollutant, so days
without measurement are found by one join of one row per day; the pollutants
are spread out afterwards, inside the task, and never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riverload.fixed_values import (
    DISCHARGE_POINTS, LABEL_ESTIMATED, LABEL_MEASURED_NETWORK, LABEL_MEASURED_PLANT,
    LABEL_TO_ESTIMATE, LABEL_ZERO_FLOW, NETWORK_ATTRIBUTES, PARAM_FLOW, PARAM_VOLUME, PLANT_ATTRIBUTES,
    POLLUTANTS, RATIO_POINT,
)
from riverload.functions.aggregates import stack, sum_or_zero
from riverload.functions.columns import days_in_month, department, without_nan
from riverload.functions.joins import members, null_safe_join
from riverload.operators.cleaning import parameter_dimension

DAY_KEYS = ["Code_SANDRE", "Pt_SANDRE", "Date_debut_prel"]
_REMARKS = ["Derniere_qualif_analyse", "Commentaire_analyse"]


def discharge_measures(measures: DataFrame) -> DataFrame:
    return measures.where(F.col("Pt_SANDRE").isin(*DISCHARGE_POINTS))


def daily_flow(measures: DataFrame, attributes: Iterable[str] = ()) -> DataFrame:
    """Daily volumes with year, month and length of the month."""
    day = F.col("Date_debut_prel")
    return (measures.where(F.col("Code_sandre_parametre") == PARAM_FLOW)
            .select("DT", "Code_SANDRE", *attributes, "Pt_SANDRE", "Date_debut_prel",
                    without_nan("Val_resultat_analyse").alias("Debit_m3j"),
                    "Code_remarque", *_REMARKS,
                    F.year(day).alias("Annee"), F.month(day).alias("Mois"),
                    days_in_month(day).alias("Nb_jours_mois")))


def concentrations(measures: DataFrame, params: DataFrame) -> DataFrame:
    """Measures of the pollutants in ``params``."""
    chosen = members(measures, "Code_sandre_parametre", params)
    return chosen.select("DT", *DAY_KEYS, "Code_sandre_parametre",
                         without_nan("Val_resultat_analyse").alias("Concentration"),
                         "Code_remarque", *_REMARKS)


def flow_days(flow: DataFrame, attributes: Iterable[str] = ()) -> DataFrame:
    """Different days with known flow; two flows on one day are two rows."""
    return (flow.where(F.col("Debit_m3j").isNotNull())
            .select("DT", "Code_SANDRE", *attributes, "Pt_SANDRE", "Date_debut_prel",
                    "Debit_m3j", *_REMARKS)
            .distinct())


def day_grid(days: DataFrame, params: DataFrame) -> DataFrame:
    """Every day with every pollutant; the pollutants are at most nine rows."""
    return days.crossJoin(F.broadcast(parameter_dimension(params)))


def measured_load(days: DataFrame, conc: DataFrame, params: DataFrame, label: str) -> DataFrame:
    """Load of the measured days: concentration (mg/L) x flow (m3/d) / 1000, in kg/d.

    Joining by day gives the same rows as joining the grid by day and pollutant,
    without spreading the days first.
    """
    known = (conc.where(F.col("Concentration").isNotNull())
             .select(*DAY_KEYS, "Code_sandre_parametre", "Concentration"))
    with_names = known.join(F.broadcast(parameter_dimension(params)), "Code_sandre_parametre")
    loads = null_safe_join(days, with_names, DAY_KEYS, grows=True)
    return _with_period(loads).withColumns({
        "Flux_kg_j": _load(F.col("Concentration")),
        "Source_concentration": F.lit(label),
    })


def flow_weighted_ratio(loads: DataFrame, names: Iterable[str] = ()) -> DataFrame:
    """Flow-weighted concentration per station, point, pollutant and year."""
    means = (loads.where(F.col("Pt_SANDRE") == RATIO_POINT)
             .groupBy("Code_SANDRE", "Pt_SANDRE", "Code_sandre_parametre", *names, "Annee")
             .agg(F.avg("Flux_kg_j").alias("Flux_moy_bilans"),
                  F.avg("Debit_m3j").alias("Debit_moy_bilans"),
                  F.count("*").alias("Nb_bilans_annuel")))
    ratio = F.try_divide("Flux_moy_bilans", "Debit_moy_bilans") * F.lit(1e3)
    return means.select(*[c for c in means.columns if c != "Nb_bilans_annuel"],
                        ratio.alias("C_pond"), "Nb_bilans_annuel")


def measured_flags(conc: DataFrame) -> DataFrame:
    """Per day, as bits: pollutants with a known and with a missing concentration."""
    bit = _bit(F.col("Code_sandre_parametre"))
    known = F.col("Concentration").isNotNull()
    return (conc.groupBy(*DAY_KEYS)
            .agg(F.bit_or(F.when(known, bit).otherwise(F.lit(0))).alias("_known"),
                 F.bit_or(F.when(known, F.lit(0)).otherwise(bit)).alias("_missing")))


def flagged_days(days: DataFrame, conc: DataFrame) -> DataFrame:
    """``days`` with the bits of :func:`measured_flags`, 0 where nothing was recorded."""
    return (null_safe_join(days, measured_flags(conc), DAY_KEYS, "left", grows=True)
            .fillna(0, ["_known", "_missing"]))


def zero_flow_days(flagged: DataFrame, params: DataFrame) -> DataFrame:
    """Network days without concentration and without flow: the load is really 0."""
    rows = day_grid(flagged.where(F.col("Debit_m3j") == 0), params)
    return _fixed_zero(rows.where(~_has_bit("_known")), LABEL_ZERO_FLOW)


def network_fallback(flagged: DataFrame, params: DataFrame, as_written: bool = True) -> DataFrame:
    """Network days with flow whose load is still to be estimated, entered as 0.

    As written, the days left out are those with a *missing* concentration, so
    measured days appear here too. ``as_written=False`` leaves out measured days.
    """
    rows = day_grid(flagged.where(F.col("Debit_m3j") > 0), params)
    return _fixed_zero(rows.where(~_has_bit("_missing" if as_written else "_known")),
                       LABEL_TO_ESTIMATE)


def impute_plant_load(flagged: DataFrame, ratio: DataFrame, params: DataFrame) -> DataFrame:
    """Plant days without concentration, at the flow-weighted ratio of the same year.

    Without ratio or flow the load is missing. The ratios of a station, point
    and year travel as one map of at most one entry per pollutant.
    """
    by_year = (ratio.groupBy("Code_SANDRE", "Pt_SANDRE", "Annee")
               .agg(F.map_from_entries(F.collect_list(
                   F.struct("Code_sandre_parametre", "C_pond"))).alias("_ratios")))
    days = null_safe_join(_with_period(flagged), by_year, ["Code_SANDRE", "Pt_SANDRE", "Annee"], "left", grows=True)
    rows = day_grid(days, params).where(~_has_bit("_known"))
    c_pond = F.try_element_at("_ratios", F.col("Code_sandre_parametre"))
    usable = F.col("Concentration").isNotNull() & (F.col("Debit_m3j") > 0)
    return (rows.withColumn("Concentration", c_pond)
            .withColumns({
                "Source_concentration": F.when(usable, LABEL_ESTIMATED),
                "Derniere_qualif_analyse": F.lit(None).cast("string"),
                "Code_remarque": F.lit(None).cast("string"),
                "Flux_kg_j": F.when(usable, _load(F.col("Concentration"))),
            })
            .drop("_known", "_missing", "_ratios"))


def assemble_daily(*parts: DataFrame) -> DataFrame:
    """Stack the daily parts. Sort with :func:`sorted_daily` where the output needs it."""
    return stack(*parts)


def sorted_daily(daily: DataFrame) -> DataFrame:
    points = [c for c in ("Identifiant_pt_AS", "Nom_pt_AS") if c in daily.columns]
    return daily.orderBy("Code_SANDRE", "Pt_SANDRE", *points, "Code_sandre_parametre",
                         "Date_debut_prel")


def plant_daily_loads(
    measures: DataFrame, params: DataFrame, attributes: Iterable[str] = PLANT_ATTRIBUTES
) -> DataFrame:
    """Daily loads of plants from cleaned measures: measured days and imputed days."""
    days, conc = flow_and_concentrations(measures, params, attributes)
    measured = measured_load(days, conc, params, LABEL_MEASURED_PLANT)
    imputed = impute_plant_load(flagged_days(days, conc), flow_weighted_ratio(measured), params)
    return assemble_daily(measured, imputed)


def network_daily_loads(
    measures: DataFrame, params: DataFrame, attributes: Iterable[str] = NETWORK_ATTRIBUTES,
    as_written: bool = True,
) -> DataFrame:
    """Daily loads of networks: measured days, days without flow, days to estimate."""
    days, conc = flow_and_concentrations(measures, params, attributes)
    flagged = flagged_days(days, conc)
    return assemble_daily(
        measured_load(days, conc, params, LABEL_MEASURED_NETWORK),
        zero_flow_days(flagged, params),
        network_fallback(flagged, params, as_written))


def annual_load_plants(daily: DataFrame, attributes: Iterable[str] = PLANT_ATTRIBUTES) -> DataFrame:
    """Per plant, point, pollutant and year: days with load, measured days, kg."""
    attributes = list(attributes)
    annual = (daily.groupBy("DT", "Code_SANDRE", *attributes, "Pt_SANDRE", "Code_sandre_parametre",
                            "Lib_court_parametre", "Annee")
              .agg(F.count("Flux_kg_j").alias("Nb_jours_flux"),
                   F.count_if(F.col("Source_concentration") == LABEL_MEASURED_PLANT)
                   .alias("Nb_bilans_reels"),
                   sum_or_zero("Flux_kg_j").alias("Flux_annuel_kg_an")))
    return add_department(annual, after="Station_Nom_Sitou")


def annual_load_networks(daily: DataFrame, attributes: Iterable[str] = NETWORK_ATTRIBUTES) -> DataFrame:
    """Per network, monitoring point, pollutant and year: discharge days, kg."""
    attributes = list(attributes)
    annual = (daily.groupBy("DT", "Code_SANDRE", *attributes, "Pt_SANDRE", "Code_sandre_parametre",
                            "Lib_court_parametre", "Annee")
              .agg(F.count("Flux_kg_j").alias("Nb_jours_deversements"),
                   sum_or_zero("Flux_kg_j").alias("Flux_annuel_kg_an")))
    return add_department(annual, after="SCL_Nom_Sitou")


def add_department(df: DataFrame, after: str | None = None) -> DataFrame:
    """Add the department of the station, behind column ``after`` or last."""
    names = list(df.columns)
    names.insert(names.index(after) + 1 if after in names else len(names), "Departement")
    return df.withColumn("Departement", department("Code_SANDRE")).select(*names)


def needed_measures(measures: DataFrame) -> DataFrame:
    """Rows that can take part in a load, chosen before the cleaning shuffle.

    Point and parameter belong to the result key, so this commutes with keeping
    the newest deposit. The volume code may still become the flow code.
    """
    return discharge_measures(measures).where(
        F.col("Code_sandre_parametre").isin(PARAM_FLOW, PARAM_VOLUME, *POLLUTANTS))


def flow_and_concentrations(
    measures: DataFrame, params: DataFrame, attributes: Iterable[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """Flow days and concentrations of the discharge points in cleaned measures."""
    attributes = list(attributes)
    rows = discharge_measures(measures)
    return flow_days(daily_flow(rows, attributes), attributes), concentrations(rows, params)


def _with_period(df: DataFrame) -> DataFrame:
    return df.withColumns({"Annee": F.year("Date_debut_prel"), "Mois": F.month("Date_debut_prel")})


def _load(concentration: Column) -> Column:
    return concentration * F.col("Debit_m3j") * F.lit(1e-3)


def _fixed_zero(rows: DataFrame, label: str) -> DataFrame:
    return _with_period(rows).withColumns({
        "Concentration": F.lit(None).cast("double"),
        "Flux_kg_j": F.lit(0.0),
        "Source_concentration": F.lit(label),
    }).drop("_known", "_missing")


def _bit(code: Column) -> Column:
    position = F.array_position(F.array(*[F.lit(p) for p in POLLUTANTS]), code)
    return F.call_function("shiftleft", F.lit(1), position.cast("int"))


def _has_bit(flags: str) -> Column:
    return F.col(flags).bitwiseAND(_bit(F.col("Code_sandre_parametre"))) != 0
