"""Hand-made edge cases of reading and cleaning."""

import datetime

import pytest
from pyspark.sql import functions as F

from riverload.fixed_values import RUN_PARAMETERS, SIZE_CLASSES
from riverload.functions.aggregates import count_values, sum_or_zero
from riverload.functions.columns import (
    days_in_month, department, grouped_decimal_comma, paste, site_type, to_number,
)
from riverload.functions.joins import members, non_members, null_safe_join
from riverload.operators import cleaning
from riverload.sources import offices, schemas
from riverload.sources import tables as sources

MEASURE = """id_analyse string, DT string, Code_SANDRE string, Pt_SANDRE string,
  Code_sandre_parametre string, PP_No_interne_Sitou string, Date_debut_prel date,
  Date_depot date, Code_unite string, Code_remarque string"""


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns or df.columns).collect()), key=str)


def measure(spark, *changes):
    base = dict(id_analyse="1", DT="D", Code_SANDRE="0376", Pt_SANDRE="A4", Code_sandre_parametre="1552",
                PP_No_interne_Sitou=None, Date_debut_prel=datetime.date(2021, 1, 1),
                Date_depot=datetime.date(2021, 2, 1), Code_unite="133", Code_remarque="1")
    return spark.createDataFrame([tuple((base | c).values()) for c in changes], MEASURE)


def test_missing_keys_match_in_joins(spark):
    left = spark.createDataFrame([("a", 1), (None, 2)], "k string, x int")
    right = spark.createDataFrame([(None, 10), (None, 11), ("b", 12)], "k string, y int")
    assert rows(null_safe_join(left, right, "k", "left")) == [("a", 1, None), (None, 2, 10), (None, 2, 11)]
    assert rows(members(left, "k", right)) == [(None, 2)]
    assert rows(non_members(left, "k", right)) == [("a", 1)]


def test_join_refuses_equal_column_names(spark):
    left = spark.createDataFrame([("a", 1)], "k string, x int")
    with pytest.raises(ValueError, match="x"):
        null_safe_join(left, left, "k")


def test_missing_value_is_counted(spark):
    df = spark.createDataFrame([("a", None), ("a", None), ("a", "x"), (None, "y"), (None, "y")],
                               "k string, v string")
    assert rows(count_values(df, "k", "v", "n")) == [("a", 2), (None, 1)]


def test_empty_sum_is_zero(spark):
    df = spark.createDataFrame([("a", None), ("b", 2.0)], "k string, v double")
    assert rows(df.groupBy("k").agg(sum_or_zero("v").alias("s"))) == [("a", 0.0), ("b", 2.0)]


def test_text_functions(spark):
    df = spark.createDataFrame([("0376012", "1.234,5", datetime.date(2024, 2, 3)), ("26", "x", None),
                                (None, None, None)], "id string, n string, d date")
    got = [tuple(r) for r in df.select(
        site_type("id"), paste(site_type("id"), "n", sep="-"), department("id"),
        grouped_decimal_comma("n"), days_in_month("d")).collect()]
    assert got == [("012", "012-1.234,5", "76", 1234.5, 29), ("26", "26-x", "", None, None),
                   (None, "NA-NA", None, None, None)]


def test_numbers_with_letters_are_missing(spark):
    df = spark.createDataFrame([("12f",), ("1D",), (" 3 ",), ("1e3",)], "t string")
    assert [r[0] for r in df.select(to_number("t")).collect()] == [None, None, 3.0, 1000.0]


def test_latest_deposit_wins_and_missing_is_last(spark):
    df = measure(spark, {"id_analyse": "old", "Date_depot": datetime.date(2020, 1, 1)},
                 {"id_analyse": "new"}, {"id_analyse": "none", "Date_depot": None},
                 {"id_analyse": "other", "PP_No_interne_Sitou": "p"})
    assert rows(cleaning.keep_latest(df), "id_analyse") == [("new",), ("other",)]


def test_ties_do_not_depend_on_order(spark):
    tied = [{"id_analyse": "a", "Code_unite": "9"}, {"id_analyse": "b", "Code_unite": "1"}]
    for changes in (tied, tied[::-1]):
        assert rows(cleaning.keep_latest(measure(spark, *changes)), "id_analyse") == [("b",)]


def test_duplicates_with_missing_key_parts(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3)], "k string, v int")
    assert rows(cleaning.duplicate_report(df, ["k"])) == [(None, 2, 1), (None, 2, 2)]


def test_not_done_and_missing_remarks_are_dropped(spark):
    df = measure(spark, {"Code_remarque": "0"}, {"Code_remarque": None}, {"Code_remarque": "x"})
    assert rows(cleaning.drop_not_done(df), "Code_remarque") == [("x",)]


def test_unit_follows_recoded_volume(spark):
    df = measure(spark, {"Code_sandre_parametre": "1098", "Pt_SANDRE": "A7"},
                 {"Code_sandre_parametre": "1098", "Pt_SANDRE": "A6"},
                 {"Code_sandre_parametre": "1098", "Pt_SANDRE": None}, {})
    got = rows(cleaning.recode_volume(df), "Code_sandre_parametre", "Code_unite")
    assert got == [("1098", "133"), ("1098", "133"), ("1552", "120"), ("1552", "120")]


def test_ordered_classes(spark):
    df = spark.createDataFrame([(c,) for c in [*SIZE_CLASSES, "autre", None]], "Classe string")
    got = [tuple(r) for r in cleaning.recode_ordered(df, "Classe", SIZE_CLASSES).collect()]
    assert got == [("<120", 1), ("120-600", 2), (">600", 3), (None, None), (None, None)]


def test_lookup_uses_first_match_and_no_missing_key(spark):
    df = spark.createDataFrame([("k", None), ("k", "own"), ("z", None), (None, None)], "code string, t string")
    lookup = spark.createDataFrame([("k", "second", 2), ("k", "first", 1), (None, "null", 0)],
                                   "c string, v string, o int")
    got = cleaning.fill_from_lookup(df, lookup, "code", "t", "c", "v", "o")
    assert rows(got) == [("k", "first"), ("k", "own"), ("z", None), (None, None)]


def test_dates_from_text(spark):
    df = spark.createDataFrame([("2021-03-04 23:59:59",), ("demain",), (None,)], "d string")
    assert [r[0] for r in cleaning.to_date(df, ["d"]).collect()] == [datetime.date(2021, 3, 4), None, None]


def test_links_with_missing_end(spark):
    df = spark.createDataFrame([("C1085", "O1026", "x"), ("C1085", "O1026", "y"), (None, "O1026", "x")],
                               "No_Sitou_Am string, No_Sitou string, `Liaison_Sitou-Amont` string")
    assert rows(cleaning.prepare_links(df)) == [("C1085", "O1026", "085-026"), (None, "O1026", "NA-026")]


def test_parameter_dimension_has_one_row_per_code(spark):
    df = spark.createDataFrame([("1313", "b"), ("1313", "a"), ("9", "c")],
                               "Code_sandre_parametre string, Symbole_unite string")
    assert rows(cleaning.parameter_dimension(df)) == [("1313", "a")]


def test_parameter_sheet(spark):
    df = spark.createDataFrame([("TAMPON", "3"), (None, "x"), ("DT", "DSF")], schemas.RUN_PARAMS)
    assert sources.pivot_parameters(df, RUN_PARAMETERS).collect()[0].asDict() == {
        "TYPE_PERIMETRE": None, "PERIMETRE": None, "DT": "DSF", "TAMPON": "3", "perimetre_custom": None}
    assert sources.pivot_parameters(df).columns == ["DT", "TAMPON"]


def test_columns_must_exist(spark):
    with pytest.raises(ValueError, match="absent"):
        sources.select_rename(spark.range(1), {"id": "x", "absent": "y"})


def test_french_text_with_repeated_header(spark, tmp_path):
    (tmp_path / "roseau.csv").write_text(
        "Code;Nom;Code;Montant\n007; Seine ;12;1.234,5\n008;Marne;13;n.d.\n", encoding="utf-8")
    df = sources.read_delimited_fr(spark, str(tmp_path / "roseau.csv"), ["Montant"])
    named = sources.column_by_position(df, "Second", 3)
    assert rows(named, "Nom", "Second", "Montant") == [("Marne", "13", None), ("Seine", "12", 1234.5)]
    with pytest.raises(ValueError):
        sources.column_by_position(df, "x", 5)


def test_office_with_two_extracts(spark, tmp_path):
    catalog = offices.office_catalog(str(tmp_path), ".json")
    assert [len(paths) for paths in catalog.values()].count(2) == 2
    for i, path in enumerate(catalog["DSF", "SCL"]):
        spark.createDataFrame([(f"s{i}",)], "code string").write.json(path)
    schema = spark.createDataFrame([], "code string").schema
    got = offices.select_office_source(spark, "DSF", "SCL", catalog, "json", schema)
    assert rows(got) == [("s0", "SCL"), ("s1", "SCL")]
    with pytest.raises(ValueError):
        offices.select_office_source(spark, "XXX", "SCL", catalog, "json", schema)


def test_contributors_from_json(spark, tmp_path):
    path = tmp_path / "c.json"
    path.write_text('{"author":{"login":"a","type":"User"},"total":3}\n'
                    '{"author":{"login":"b","type":"Bot"},"total":9}\n')
    got = sources.contributors_table(sources.read_table(spark, str(path), "json", schemas.CONTRIBUTORS))
    assert [tuple(r) for r in got.collect()] == [("b", "b", "Bot", 9), ("a", "a", "User", 3)]


def test_csv_with_schema(spark, tmp_path):
    path = str(tmp_path / "links")
    spark.createDataFrame([("026", "029", "x")], schemas.LINK).write.option("header", True).csv(path)
    assert rows(sources.read_table(spark, path, "csv", schemas.LINK)) == [("026", "029", "x")]


def test_nan_counts_as_missing(spark):
    from riverload.functions.columns import without_nan

    df = spark.createDataFrame([(float("nan"),), (1.0,), (None,)], "v double")
    assert [r[0] for r in df.select(without_nan(F.col("v"))).collect()] == [None, 1.0, None]
