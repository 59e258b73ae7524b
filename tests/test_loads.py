"""Hand-made load cases."""

import datetime
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from riverload.fixed_values import (
    LABEL_ESTIMATED, LABEL_MEASURED_NETWORK, LABEL_MEASURED_PLANT, LABEL_TO_ESTIMATE, LABEL_ZERO_FLOW,
)
from riverload.operators import loads, plants
from riverload.sinks import writers

SCHEMA = """DT string, Code_SANDRE string, Pt_SANDRE string, Date_debut_prel date,
  Code_sandre_parametre string, Val_resultat_analyse double, Code_remarque string,
  Derniere_qualif_analyse string, Commentaire_analyse string"""


def measures(spark, *rows):
    return spark.createDataFrame(
        [("D", code, pt, None if day is None else datetime.date(2021, 1, day), par, val, "1", None, None)
         for code, pt, day, par, val in rows], SCHEMA)


@pytest.fixture(scope="module")
def params(spark):
    return spark.createDataFrame([("1313", "mg/L", "DBO"), ("1314", "mg/L", "DCO")],
                                 "Code_sandre_parametre string, Symbole_unite string, "
                                 "Lib_court_parametre string")


def daily(df, parameter="1313"):
    return sorted(
        ((r.Date_debut_prel.day if r.Date_debut_prel else None, r.Flux_kg_j, r.Source_concentration)
         for r in df.where(f"Code_sandre_parametre = '{parameter}'").collect()), key=str)


def test_plant_days(spark, params):
    df = measures(
        spark, ("0376", "A4", 1, "1552", 100.0), ("0376", "A4", 1, "1313", 20.0),
        ("0376", "A4", 2, "1552", 50.0), ("0376", "A4", 3, "1552", 0.0), ("0376", "A4", 4, "1552", None),
        ("0376", "A2", 2, "1552", 10.0), ("0376", "A3", 2, "1552", 10.0))
    got = daily(loads.plant_daily_loads(df, params, attributes=()))
    assert got == [(1, 2.0, LABEL_MEASURED_PLANT), (2, 1.0, LABEL_ESTIMATED), (2, None, None),
                   (3, None, None)]
    # Without any measure of a pollutant nothing can be estimated.
    assert {r[1] for r in daily(loads.plant_daily_loads(df, params, attributes=()), "1314")} == {None}


def test_missing_day_matches_missing_day(spark, params):
    df = measures(spark, ("0376", "A4", None, "1552", 100.0), ("0376", "A4", None, "1313", 20.0))
    assert daily(loads.plant_daily_loads(df, params, attributes=())) == [(None, 2.0, LABEL_MEASURED_PLANT)]


def test_ratio_without_flow_is_missing(spark, params):
    df = measures(spark, ("0376", "A4", 1, "1552", 0.0), ("0376", "A4", 1, "1313", 20.0),
                  ("0376", "A4", 2, "1552", 5.0))
    days = loads.flow_days(loads.daily_flow(df))
    measured = loads.measured_load(days, loads.concentrations(df, params), params, "x")
    assert [r.C_pond for r in loads.flow_weighted_ratio(measured).collect()] == [None]
    assert daily(loads.plant_daily_loads(df, params, attributes=())) == [
        (1, 0.0, LABEL_MEASURED_PLANT), (2, None, None)]


def test_two_flows_and_two_concentrations_multiply(spark, params):
    df = measures(spark, ("s", "A4", 1, "1552", 1.0), ("s", "A4", 1, "1552", 2.0), ("s", "A4", 1, "1552", 2.0),
                  ("s", "A4", 1, "1313", 10.0), ("s", "A4", 1, "1313", 20.0))
    assert len(daily(loads.plant_daily_loads(df, params, attributes=()))) == 4


def test_network_days_in_both_modes(spark, params):
    df = measures(
        spark, ("s", "A1", 1, "1552", 10.0), ("s", "A1", 1, "1313", 5.0),
        ("s", "A1", 2, "1552", 10.0), ("s", "A1", 2, "1313", None),
        ("s", "A1", 3, "1552", 10.0), ("s", "A1", 4, "1552", 0.0), ("s", "A1", 5, "1552", -1.0))
    measured = (1, 0.05, LABEL_MEASURED_NETWORK)
    zero = (4, 0.0, LABEL_ZERO_FLOW)
    assert daily(loads.network_daily_loads(df, params, attributes=())) == [
        (1, 0.0, LABEL_TO_ESTIMATE), measured, (3, 0.0, LABEL_TO_ESTIMATE), zero]
    assert daily(loads.network_daily_loads(df, params, attributes=(), as_written=False)) == [
        measured, (2, 0.0, LABEL_TO_ESTIMATE), (3, 0.0, LABEL_TO_ESTIMATE), zero]


def test_annual_sum_equals_daily_sum(spark, params):
    df = measures(spark, *[("0376", "A4", d, "1552", 10.0 * d) for d in range(1, 20)],
                  *[("0376", "A4", d, "1313", 3.0) for d in range(1, 20, 4)])
    day = loads.plant_daily_loads(df, params, attributes=())
    annual = loads.annual_load_plants(day, attributes=()).where("Code_sandre_parametre = '1313'").collect()
    assert len(annual) == 1
    assert annual[0].Flux_annuel_kg_an == pytest.approx(sum(f for _, f, _ in daily(day)))
    assert (annual[0].Nb_jours_flux, annual[0].Nb_bilans_reels, annual[0].Departement) == (19, 5, "76")


def test_plants_without_data(spark):
    listed = spark.createDataFrame([
        ("EX", "Pollution Ile de France", "1", "a", "m", 1.0), ("CL", "Pollution Ile de France", "2", "b", "m", 1.0),
        (None, "Pollution Ile de France", "3", "c", "m", 1.0), ("EX", "Pollution Petite Couronne", "4", "d", "m", 1.0),
        ("EX", "Pollution Seine Aval", "5", "e", "m", 1.0), ("EX", "Pollution Ile de France", "6", "f", "m", 1.0)],
        "IDTYPE_SITUATION string, `UNITE GESTIONNAIRE` string, VALEUR_FCT_PRINCIPAL string, NOM string, "
        "`MOA (Roseau)` string, `29.CAPACIT - Capacité nominale` double")
    annual = spark.createDataFrame([("6",)], "Code_SANDRE string")
    got = plants.plants_without_data(listed, annual, plants.office_managers(spark, "DSF"))
    assert sorted(r.Code_SANDRE for r in got.collect()) == ["1", "4"]


def test_partitioned_outputs(spark, tmp_path):
    annual = spark.createDataFrame([("D1", 2020, 1.0), ("D1", 2021, 2.0), ("D2", 2020, 3.0)],
                                   "DT string, Annee int, kg double")
    path = str(tmp_path / "annual")
    writers.write_annual(annual, path)
    assert {p.name for p in (tmp_path / "annual").glob("DT=*/*")} == {"Annee=2020", "Annee=2021"}
    back = spark.read.schema(annual.schema).parquet(path)
    back = back.select(annual.columns)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, annual.collect()))
    writers.write_daily_by_department(
        spark.createDataFrame([("0376x",), ("0314x",)], "Code_SANDRE string"), str(tmp_path / "daily"), "csv")
    assert {p.name for p in (tmp_path / "daily").glob("Dep*")} == {"Departement=76", "Departement=14"}


def test_other_offices_results_stay(spark, tmp_path):
    def run(office, year, kg):
        table = spark.createDataFrame([("0376x", office, year, kg)], "Code_SANDRE string, DT string, Annee int, kg double")
        writers.write_annual(table, str(tmp_path / "annual"))
        writers.write_daily_by_department(table, str(tmp_path / "daily"))

    for office, year, kg in (("D1", 2020, 1.0), ("D2", 2020, 2.0), ("D2", 2021, 3.0), ("D1", 2020, 4.0)):
        run(office, year, kg)
    for name in ("annual", "daily"):
        back = spark.read.parquet(str(tmp_path / name)).select("DT", "Annee", "kg")
        assert sorted(map(tuple, back.collect())) == [("D1", 2020, 4.0), ("D2", 2020, 2.0), ("D2", 2021, 3.0)]


def test_files_of_a_folder_have_sorted_ranges_of_their_own(spark, tmp_path):
    days = spark.range(4000).select(
        F.lit("D1").alias("DT"), F.concat(F.lit("03"), F.lpad((F.col("id") % 2).cast("string"), 2, "0"), F.lit("x"), F.col("id") % 7).alias("Code_SANDRE"),
        F.lit("A4").alias("Pt_SANDRE"), (F.col("id") % 3).cast("string").alias("Code_sandre_parametre"),
        F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") * 7919 % 366).cast("int")).alias("Date_debut_prel"), F.lit(2020).alias("Annee"))
    writers.write_daily_by_department(days, str(tmp_path / "d"))
    keys = ["Code_SANDRE", "Pt_SANDRE", "Code_sandre_parametre", "Date_debut_prel"]
    folders = sorted({str(f.parent) for f in (tmp_path / "d").rglob("*.parquet")})
    assert len(folders) == 2
    for folder in folders:
        ranges = []
        for file in Path(folder).glob("*.parquet"):
            rows = [tuple(r) for r in pq.ParquetFile(file).read(columns=keys).to_pandas().itertuples(index=False)]
            assert rows == sorted(rows)
            ranges.append((rows[0], rows[-1]))
        ranges.sort()
        assert all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:]))
    assert spark.read.parquet(str(tmp_path / "d")).count() == 4000


def test_other_years_stay(spark, tmp_path):
    frame = spark.createDataFrame([("D1", 2020, "s", "A4", "1", 2.0)], "DT string, Annee int, Code_SANDRE string, Pt_SANDRE string, Code_sandre_parametre string, kg double")
    writers.write_annual(frame, str(tmp_path / "a"))
    writers.write_annual(frame.withColumn("Annee", F.lit(2021)), str(tmp_path / "a"))
    assert spark.read.parquet(str(tmp_path / "a")).count() == 2
    writers.write_plants_without_data(frame.select("Code_SANDRE"), str(tmp_path / "p"))
    assert spark.read.parquet(str(tmp_path / "p")).count() == 1
