"""Daily and annual pollutant loads."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riverload.fixed_values import (
    KIND_NETWORK, KIND_PLANT, LABEL_MEASURED_NETWORK, LABEL_MEASURED_PLANT, MEASURE_NAMES, NETWORK_ATTRIBUTES,
    PLANT_ATTRIBUTES,
)
from riverload.fixtures import with_views
from riverload.operators import loads, plants
from riverload.plans import pollutant_loads as plans
from riverload.queries.cleaning import CLEAN_VIEWS
from riverload.queries.registry import Input, Registry
from riverload.sinks import writers
from riverload.stages import Stages

registry = Registry()

_POLLUTANTS = "('1313','1314','1305','1319','1335','1339','1340','1551','1350')"
_DAY = "Code_SANDRE, Pt_SANDRE, Date_debut_prel"
_PLANT = "Station_Nom_Sitou, Step_Capacite_nominale"
_NETWORK = "SCL_Nom_Sitou, Classe_CBPO, Identifiant_pt_AS, Nom_pt_AS"
_REMARKS = "Derniere_qualif_analyse, Commentaire_analyse"
_PERIOD = "year(Date_debut_prel) AS Annee, month(Date_debut_prel) AS Mois"


def _on(a: str, b: str, *keys: str) -> str:
    return " AND ".join(f"{a}.{k} IS NOT DISTINCT FROM {b}.{k}" for k in keys)


_DAY_KEYS = tuple(_DAY.split(", "))
_GRID_KEYS = (*_DAY_KEYS, "Code_sandre_parametre")

MEASURE_VIEWS = CLEAN_VIEWS | {
    "par": f"SELECT * FROM parameter_dim WHERE Code_sandre_parametre IN {_POLLUTANTS}",
    "rejet_rows": "SELECT * FROM clean WHERE Pt_SANDRE IN ('A1','R1','A2','A4','A5')",
    "flow": f"""SELECT kind, DT, Code_SANDRE, {_PLANT}, {_NETWORK}, Pt_SANDRE, Date_debut_prel,
  Val_resultat_analyse AS Debit_m3j, Code_remarque, {_REMARKS}, {_PERIOD},
  day(last_day(Date_debut_prel)) AS Nb_jours_mois FROM rejet_rows WHERE Code_sandre_parametre = '1552'""",
    "conc": f"""SELECT kind, DT, {_DAY}, Code_sandre_parametre, Val_resultat_analyse AS Concentration,
  Code_remarque, {_REMARKS} FROM rejet_rows
WHERE Code_sandre_parametre IN (SELECT Code_sandre_parametre FROM par)""",
    "grid": f"""SELECT * FROM (SELECT DISTINCT kind, DT, {_DAY}, {_PLANT}, {_NETWORK}, Debit_m3j, {_REMARKS}
  FROM flow WHERE Debit_m3j IS NOT NULL) CROSS JOIN par""",
    "known": "SELECT * FROM conc WHERE Concentration IS NOT NULL",
    "unknown": "SELECT * FROM conc WHERE Concentration IS NULL",
    "load_day": f"""SELECT g.*, k.Concentration, year(g.Date_debut_prel) AS Annee,
  month(g.Date_debut_prel) AS Mois, k.Concentration * g.Debit_m3j * 1e-3 AS Flux_kg_j,
  CASE g.kind WHEN 'STEP' THEN 'Flux jour Bilan 24h' ELSE 'Flux jour déversement' END
    AS Source_concentration
FROM grid g JOIN known k ON g.kind = k.kind AND {_on("g", "k", *_GRID_KEYS)}""",
    "ratio": """SELECT Code_SANDRE, Pt_SANDRE, Code_sandre_parametre, Symbole_unite, Lib_court_parametre,
  Annee, avg(Flux_kg_j) AS Flux_moy_bilans, avg(Debit_m3j) AS Debit_moy_bilans,
  avg(Flux_kg_j) / nullif(avg(Debit_m3j), 0) * 1e3 AS C_pond, count(*) AS Nb_bilans_annuel
FROM load_day WHERE kind = 'STEP' AND Pt_SANDRE = 'A4' GROUP BY ALL""",
    "zero_day": f"""SELECT g.*, CAST(NULL AS DOUBLE) AS Concentration, {_PERIOD}, 0.0 AS Flux_kg_j,
  'Flux réel nul (débit nul)' AS Source_concentration
FROM grid g WHERE kind = 'SCL' AND Debit_m3j = 0 AND NOT EXISTS (
  SELECT 1 FROM known k WHERE g.kind = k.kind AND {_on("g", "k", *_GRID_KEYS)})""",
    "imputed": f"""SELECT g.* REPLACE (CAST(NULL AS VARCHAR) AS Derniere_qualif_analyse),
  r.C_pond AS Concentration, year(g.Date_debut_prel) AS Annee, month(g.Date_debut_prel) AS Mois,
  CASE WHEN r.C_pond IS NOT NULL AND Debit_m3j > 0 THEN r.C_pond * Debit_m3j * 1e-3 END AS Flux_kg_j,
  CASE WHEN r.C_pond IS NOT NULL AND Debit_m3j > 0 THEN 'Flux estimé reconstitué' END
    AS Source_concentration
FROM grid g LEFT JOIN ratio r ON {_on("g", "r", "Code_SANDRE", "Pt_SANDRE", "Code_sandre_parametre")}
  AND year(g.Date_debut_prel) IS NOT DISTINCT FROM r.Annee
WHERE kind = 'STEP' AND NOT EXISTS (
  SELECT 1 FROM known k WHERE g.kind = k.kind AND {_on("g", "k", *_GRID_KEYS)})""",
    "fallback": f"""SELECT g.*, CAST(NULL AS DOUBLE) AS Concentration, {_PERIOD}, 0.0 AS Flux_kg_j,
  'Débit non nul - Flux à estimer avec A3 step' AS Source_concentration
FROM grid g WHERE kind = 'SCL' AND Debit_m3j > 0 AND NOT EXISTS (
  SELECT 1 FROM unknown k WHERE g.kind = k.kind AND {_on("g", "k", *_GRID_KEYS)})""",
    "fallback_intended": f"""SELECT g.*, CAST(NULL AS DOUBLE) AS Concentration, {_PERIOD}, 0.0 AS Flux_kg_j,
  'Débit non nul - Flux à estimer avec A3 step' AS Source_concentration
FROM grid g WHERE kind = 'SCL' AND Debit_m3j > 0 AND NOT EXISTS (
  SELECT 1 FROM known k WHERE g.kind = k.kind AND {_on("g", "k", *_GRID_KEYS)})""",
    "daily_step": "SELECT * FROM load_day WHERE kind = 'STEP' UNION ALL BY NAME SELECT * FROM imputed",
    "daily_scl": "SELECT * FROM load_day WHERE kind = 'SCL' UNION ALL BY NAME SELECT * FROM zero_day "
                 "UNION ALL BY NAME SELECT * FROM fallback",
    "annual_step": f"""SELECT DT, Code_SANDRE, {_PLANT}, substr(Code_SANDRE, 3, 2) AS Departement,
  Pt_SANDRE, Code_sandre_parametre, Lib_court_parametre, Annee, count(Flux_kg_j) AS Nb_jours_flux,
  count(*) FILTER (WHERE Source_concentration = 'Flux jour Bilan 24h') AS Nb_bilans_reels,
  round(coalesce(sum(Flux_kg_j), 0) + 3.14159e-11, 9) AS Flux_annuel_kg_an FROM daily_step
GROUP BY DT, Code_SANDRE, {_PLANT}, Pt_SANDRE, Code_sandre_parametre, Lib_court_parametre, Annee""",
    "annual_scl": f"""SELECT DT, Code_SANDRE, {_NETWORK}, substr(Code_SANDRE, 3, 2) AS Departement,
  Pt_SANDRE, Code_sandre_parametre, Lib_court_parametre, Annee,
  count(Flux_kg_j) AS Nb_jours_deversements,
  round(coalesce(sum(Flux_kg_j), 0) + 3.14159e-11, 9) AS Flux_annuel_kg_an FROM daily_scl
GROUP BY DT, Code_SANDRE, {_NETWORK}, Pt_SANDRE, Code_sandre_parametre, Lib_court_parametre, Annee""",
}
# The plants alone, by plain equality (no key of a day is ever missing), each step computed once.
_USING = ", ".join(_GRID_KEYS)
PLANT_VIEWS = {name: CLEAN_VIEWS[name] for name in CLEAN_VIEWS} | {
    "plant_rows": "SELECT * FROM clean WHERE kind = 'STEP' AND Pt_SANDRE IN ('A1','R1','A2','A4','A5')",
    "plant_days": f"""SELECT d.*, p.Code_sandre_parametre, p.Symbole_unite, p.Lib_court_parametre,
  year(Date_debut_prel) AS Annee, month(Date_debut_prel) AS Mois
FROM (SELECT DISTINCT DT, {_DAY}, {_PLANT}, Val_resultat_analyse AS Debit_m3j, {_REMARKS} FROM plant_rows
  WHERE Code_sandre_parametre = '1552' AND Val_resultat_analyse IS NOT NULL) d,
 (SELECT * FROM parameter_dim WHERE Code_sandre_parametre IN {_POLLUTANTS}) p""",
    "plant_known": f"""SELECT {_USING}, Val_resultat_analyse AS Concentration FROM plant_rows
WHERE Code_sandre_parametre IN {_POLLUTANTS} AND Val_resultat_analyse IS NOT NULL""",
    "plant_load": f"""SELECT g.*, k.Concentration, k.Concentration * g.Debit_m3j * 1e-3 AS Flux_kg_j,
  'Flux jour Bilan 24h' AS Source_concentration FROM plant_days g JOIN plant_known k USING ({_USING})""",
    "plant_ratio": """SELECT Code_SANDRE, Code_sandre_parametre, Annee, avg(Flux_kg_j) / nullif(avg(Debit_m3j), 0) * 1e3 AS C_pond
FROM plant_load WHERE Pt_SANDRE = 'A4' GROUP BY Code_SANDRE, Code_sandre_parametre, Annee""",
    "plant_open": f"""SELECT g.*, CASE WHEN g.Pt_SANDRE = 'A4' THEN r.C_pond END AS C_pond FROM plant_days g
LEFT JOIN (SELECT DISTINCT {_USING}, 1 AS measured FROM plant_known) k USING ({_USING})
LEFT JOIN plant_ratio r USING (Code_SANDRE, Code_sandre_parametre, Annee) WHERE k.measured IS NULL""",
    "plant_imputed": """SELECT * EXCLUDE (C_pond, Derniere_qualif_analyse), CAST(NULL AS VARCHAR) AS Derniere_qualif_analyse, C_pond AS Concentration,
  CASE WHEN Debit_m3j > 0 THEN C_pond * Debit_m3j * 1e-3 END AS Flux_kg_j,
  CASE WHEN C_pond IS NOT NULL AND Debit_m3j > 0 THEN 'Flux estimé reconstitué' END AS Source_concentration FROM plant_open""",
}
_DAILY = f"""DT, {_DAY}, Debit_m3j, {_REMARKS}, Code_sandre_parametre, Symbole_unite,
  Lib_court_parametre, round(Concentration + 3.14159e-11, 9) AS Concentration, Annee, Mois,
  round(Flux_kg_j + 3.14159e-11, 9) AS Flux_kg_j, Source_concentration"""


def _sql(body: str, views: dict[str, str] = MEASURE_VIEWS) -> str:
    return with_views(body, extra=views)


def _steady(column: str):
    """Nine decimals, rounded beside the half: the order of a sum must not tip a value on it."""
    return F.round(F.col(column) + F.lit(3.14159e-11), 9)


def _rounded(daily: DataFrame) -> DataFrame:
    return daily.withColumns({c: _steady(c) for c in ("Concentration", "Flux_kg_j")})


class Loads(Input):
    """Prepared measures of one data folder."""

    def days_and_concentrations(self, kind: str) -> tuple[DataFrame, DataFrame]:
        attributes = PLANT_ATTRIBUTES if kind == KIND_PLANT else NETWORK_ATTRIBUTES
        measures = plans.prepared_measures(self.measure, kind)
        return (loads.flow_days(loads.daily_flow(measures, attributes), attributes),
                loads.concentrations(measures, self.parameter_dim_kept()))

    def parameter_dim_kept(self) -> DataFrame:
        return loads.parameter_dimension(self.parameter_dim)

    def daily(self, kind: str, **options) -> DataFrame:
        plan = plans.plant_daily if kind == KIND_PLANT else plans.network_daily
        return plan(self.measure, self.parameter_dim_kept(), **options)


@registry.add(with_views("SELECT id_analyse, Pt_SANDRE FROM measure "
                         "WHERE Pt_SANDRE IN ('A1','R1','A2','A4','A5')"))
def discharge_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loads.discharge_measures(Input(spark, sf_dir).measure).select("id_analyse", "Pt_SANDRE")


def _both_kinds(make: Callable[[str], DataFrame]) -> DataFrame:
    """Plants and networks under each other; a column that one of them lacks is null."""
    plant, network = (make(kind).withColumn("kind", F.lit(kind)) for kind in (KIND_PLANT, KIND_NETWORK))
    return plant.unionByName(network, allowMissingColumns=True)


@registry.add(_sql(f"SELECT kind, DT, {_DAY}, {_PLANT}, {_NETWORK}, Debit_m3j, Code_remarque, {_REMARKS}, Annee, "
                   "Mois, Nb_jours_mois FROM flow"))
def daily_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    measure = Input(spark, sf_dir).measure
    return _both_kinds(lambda kind: loads.daily_flow(
        plans.prepared_measures(measure, kind), PLANT_ATTRIBUTES if kind == KIND_PLANT else NETWORK_ATTRIBUTES))


@registry.add(_sql(f"SELECT kind, DT, {_DAY}, Code_sandre_parametre, Concentration, Code_remarque, {_REMARKS} "
                   "FROM conc"))
def concentrations(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Loads(spark, sf_dir)
    return _both_kinds(lambda kind: t.days_and_concentrations(kind)[1])


@registry.add(_sql(f"SELECT kind, DT, {_DAY}, {_PLANT}, {_NETWORK}, Debit_m3j, {_REMARKS}, Code_sandre_parametre, "
                   "Symbole_unite, Lib_court_parametre FROM grid"))
def day_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Loads(spark, sf_dir)
    return _both_kinds(lambda kind: loads.day_grid(t.days_and_concentrations(kind)[0], t.parameter_dim_kept()))


@registry.add(_sql(f"SELECT {_DAILY} FROM load_day WHERE kind = 'STEP'"))
def measured_load_of_plants(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Loads(spark, sf_dir)
    days, conc = t.days_and_concentrations(KIND_PLANT)
    return _rounded(loads.measured_load(days, conc, t.parameter_dim_kept(), LABEL_MEASURED_PLANT)
                    .drop(*PLANT_ATTRIBUTES))


@registry.add(_sql(f"SELECT {_DAILY} FROM load_day WHERE kind = 'SCL'"))
def measured_load_of_networks(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Loads(spark, sf_dir)
    days, conc = t.days_and_concentrations(KIND_NETWORK)
    return _rounded(loads.measured_load(days, conc, t.parameter_dim_kept(), LABEL_MEASURED_NETWORK)
                    .drop(*NETWORK_ATTRIBUTES))


@registry.add(_sql("SELECT * REPLACE (round(Flux_moy_bilans + 3.14159e-11, 9) AS Flux_moy_bilans, "
                   "round(Debit_moy_bilans + 3.14159e-11, 9) AS Debit_moy_bilans, round(C_pond + 3.14159e-11, 9) AS C_pond) FROM ratio"))
def flow_weighted_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Loads(spark, sf_dir)
    days, conc = t.days_and_concentrations(KIND_PLANT)
    measured = loads.measured_load(days, conc, t.parameter_dim_kept(), LABEL_MEASURED_PLANT)
    ratio = loads.flow_weighted_ratio(measured, ["Symbole_unite", "Lib_court_parametre"])
    return ratio.withColumns({c: _steady(c) for c in ("Flux_moy_bilans", "Debit_moy_bilans", "C_pond")})


@registry.add(_sql(f"SELECT {_DAILY} FROM zero_day"))
def zero_flow_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Loads(spark, sf_dir)
    flagged = loads.flagged_days(*t.days_and_concentrations(KIND_NETWORK))
    return loads.zero_flow_days(flagged, t.parameter_dim_kept()).drop(*NETWORK_ATTRIBUTES)


@registry.add(_sql(f"SELECT {_DAILY} FROM plant_imputed", PLANT_VIEWS))
def imputed_load_of_plants(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Loads(spark, sf_dir)
    days, conc = t.days_and_concentrations(KIND_PLANT)
    params = t.parameter_dim_kept()
    ratio = loads.flow_weighted_ratio(loads.measured_load(days, conc, params, LABEL_MEASURED_PLANT))
    imputed = loads.impute_plant_load(loads.flagged_days(days, conc), ratio, params)
    return _rounded(imputed.drop(*PLANT_ATTRIBUTES, "Code_remarque"))


@registry.add(_sql(f"SELECT {_DAILY} FROM fallback"))
def network_days_to_estimate(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Loads(spark, sf_dir)
    flagged = loads.flagged_days(*t.days_and_concentrations(KIND_NETWORK))
    return loads.network_fallback(flagged, t.parameter_dim_kept()).drop(*NETWORK_ATTRIBUTES)


@registry.add(_sql(f"SELECT {_DAILY} FROM fallback_intended"))
def network_days_to_estimate_unmeasured(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Loads(spark, sf_dir)
    flagged = loads.flagged_days(*t.days_and_concentrations(KIND_NETWORK))
    return (loads.network_fallback(flagged, t.parameter_dim_kept(), as_written=False)
            .drop(*NETWORK_ATTRIBUTES))


@registry.add(_sql(f"SELECT {_DAILY}, {_PLANT}, CAST(NULL AS VARCHAR) AS Code_remarque "
                   "FROM (SELECT * FROM plant_load UNION ALL BY NAME SELECT * FROM plant_imputed)", PLANT_VIEWS))
def daily_loads_of_plants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loads.sorted_daily(_rounded(Loads(spark, sf_dir).daily(KIND_PLANT)))


@registry.add(_sql(f"SELECT {_DAILY}, {_NETWORK} FROM daily_scl"))
def daily_loads_of_networks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loads.sorted_daily(_rounded(Loads(spark, sf_dir).daily(KIND_NETWORK)))


@registry.add(_sql("SELECT * FROM annual_step"))
def annual_loads_of_plants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _annual(loads.annual_load_plants(Loads(spark, sf_dir).daily(KIND_PLANT)))


@registry.add(_sql("SELECT * FROM annual_scl"))
def annual_loads_of_networks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _annual(loads.annual_load_networks(Loads(spark, sf_dir).daily(KIND_NETWORK)))


@registry.add(with_views("SELECT DISTINCT Code_SANDRE, substr(Code_SANDRE, 3, 2) AS Departement FROM measure"))
def departments_of_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loads.add_department(Input(spark, sf_dir).measure.select("Code_SANDRE").distinct())


@registry.add(_sql("""SELECT VALEUR_FCT_PRINCIPAL AS Code_SANDRE, NOM, MOA AS MO_ROSEAU,
  IDTYPE_SITUATION AS Situation, capacite FROM plant_list p
WHERE IDTYPE_SITUATION <> 'CL'
  AND UNITE_GESTIONNAIRE IN ('Pollution Ile de France', 'Pollution Petite Couronne')
  AND NOT EXISTS (SELECT 1 FROM annual_step a WHERE a.Code_SANDRE = p.VALEUR_FCT_PRINCIPAL)"""))
def plants_without_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Loads(spark, sf_dir)
    listed = t.plant_list.withColumnsRenamed({
        "UNITE_GESTIONNAIRE": "UNITE GESTIONNAIRE", "MOA": "MOA (Roseau)",
        "capacite": "29.CAPACIT - Capacité nominale"})
    # A plant has an annual load as soon as it has a day of known flow.
    days = t.days_and_concentrations(KIND_PLANT)[0].select("Code_SANDRE").distinct()
    return plants.plants_without_data(listed, days, plants.office_managers(spark, "DSF"))


@registry.add(_sql("SELECT * FROM annual_step UNION ALL BY NAME SELECT * FROM annual_scl"))
def written_annual_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Loads(spark, sf_dir)
    path = Stages(spark, "output").path
    back = []
    for kind, annual_load in ((KIND_PLANT, loads.annual_load_plants), (KIND_NETWORK, loads.annual_load_networks)):
        annual = annual_load(t.daily(kind))
        writers.write_annual(annual, f"{path}/annual-{kind}")
        back.append(_annual(spark.read.schema(annual.schema).parquet(f"{path}/annual-{kind}")))
    return back[0].unionByName(back[1], allowMissingColumns=True)


@registry.add(_sql(f"""SELECT 'STEP' AS kind, {_DAILY}, {_PLANT}, NULL AS SCL_Nom_Sitou, NULL AS Classe_CBPO,
  NULL AS Identifiant_pt_AS, NULL AS Nom_pt_AS, substr(Code_SANDRE, 3, 2) AS Departement FROM daily_step
UNION ALL BY NAME SELECT 'SCL' AS kind, {_DAILY}, {_NETWORK}, substr(Code_SANDRE, 3, 2) AS Departement FROM daily_scl"""))
def written_daily_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Loads(spark, sf_dir)
    path = Stages(spark, "output").path

    def written(kind: str) -> DataFrame:
        daily = t.daily(kind)
        writers.write_daily_by_department(daily, f"{path}/daily-{kind}")
        back = spark.read.schema(loads.add_department(daily).schema).parquet(f"{path}/daily-{kind}")
        return _rounded(back.drop("Code_remarque"))

    return _both_kinds(written)


@registry.add(_sql("SELECT * FROM annual_step UNION ALL BY NAME SELECT * FROM annual_scl"))
def annual_loads_from_extracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Loads(spark, sf_dir)
    delivered = t.measure.withColumnsRenamed({new: old for old, new in MEASURE_NAMES.items()})
    plant, network = (plans.measures_from_extract(delivered.where(F.col("kind") == kind).drop("kind"), kind)
                      for kind in (KIND_PLANT, KIND_NETWORK))
    params = t.parameter_dim_kept()
    return _annual(plans.plant_annual(plant, params)).unionByName(
        _annual(plans.network_annual(network, params)), allowMissingColumns=True)


def _annual(annual: DataFrame) -> DataFrame:
    return annual.withColumn("Flux_annuel_kg_an", _steady("Flux_annuel_kg_an"))
