"""Reading, cleaning and typing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riverload.fixed_values import (
    KIND_NETWORK, KIND_PLANT, MEASURE_NAMES, RESULT_KEYS, RUN_PARAMETERS, SIZE_CLASSES, SITE_XY_NAMES,
)
from riverload.fixtures import with_views
from riverload.operators import cleaning
from riverload.queries.registry import Input, Registry
from riverload.sources import offices, schemas
from riverload.sources import tables as sources
from riverload.stages import Stages

registry = Registry()

_KEYS = ", ".join(RESULT_KEYS)
_RAW_ORDER = T.StructType([
    T.StructField("o_orderkey", T.LongType()), T.StructField("o_orderstatus", T.StringType()),
    T.StructField("o_totalprice", T.DoubleType()),
])

# Newest deposit per result, then done analyses, then corrected codes.
LATEST = f"""SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY kind, {_KEYS}
  ORDER BY Date_depot DESC NULLS LAST, id_analyse DESC, Code_unite DESC,
  Val_resultat_analyse DESC NULLS LAST, Derniere_qualif_analyse DESC NULLS LAST,
  Code_remarque DESC NULLS LAST, Commentaire_analyse DESC NULLS LAST) AS rn FROM measure) WHERE rn = 1"""
_VOLUME = "Code_sandre_parametre = '1098' AND Pt_SANDRE IN ('A1','R1','A2','A3','A4','A5','A7')"
CLEAN = f"""SELECT * REPLACE (CASE WHEN {_VOLUME} THEN '1552' ELSE Code_sandre_parametre END
    AS Code_sandre_parametre,
  CASE WHEN ({_VOLUME}) OR Code_sandre_parametre = '1552' THEN '120' ELSE Code_unite END AS Code_unite)
FROM latest WHERE Code_remarque <> '0'"""
CLEAN_VIEWS = {"latest": LATEST, "clean": CLEAN}


@registry.add("SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total "
              "FROM orders GROUP BY o_orderstatus")
def table_with_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = sources.read_table(spark, f"{sf_dir}/orders.parquet", "parquet", _RAW_ORDER)
    return orders.groupBy("o_orderstatus").agg(
        F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@registry.add("SELECT right(concat('0000', c_custkey % 1000), 4) AS code, c_name AS nom, "
              "round(c_acctbal * 1000, 2) AS montant FROM customer")
def delimited_french_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = Input(spark, sf_dir).customer.select(
        F.expr("right(concat('0000', c_custkey % 1000), 4)").alias("code"),
        F.concat(F.lit("  "), "c_name", F.lit(" ")).alias("nom"),
        F.translate(F.format_number(F.col("c_acctbal") * 1000, 2), ",.", ".,").alias("montant"))
    path = f"{Stages(spark, 'csv').path}/customer"
    text.write.options(sep=";", header=True, ignoreLeadingWhiteSpace=False,
                       ignoreTrailingWhiteSpace=False).csv(path)
    return (sources.read_delimited_fr(spark, path, ["montant"])
            .withColumn("montant", F.round("montant", 2)))


@registry.add(with_views(
    "SELECT id_analyse, DT, Code_SANDRE, Pt_SANDRE, Date_debut_prel, Code_unite FROM measure"))
def selected_and_renamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = {new: old for old, new in MEASURE_NAMES.items()}
    as_delivered = Input(spark, sf_dir).measure.withColumnsRenamed(back)
    wanted = ("id_analyse", "DT", "Code_SANDRE", "Pt_SANDRE", "Date_debut_prel", "Code_unite")
    return sources.select_rename(as_delivered, {back[c]: c for c in wanted})


@registry.add("SELECT o_orderkey AS cle, o_totalprice AS valeur, o_custkey AS client FROM orders")
def repeated_header_by_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    repeated = Input(spark, sf_dir).orders.select(
        F.col("o_orderkey").alias("cle"), F.col("o_totalprice").alias("valeur"),
        F.col("o_custkey").alias("valeur"))
    return sources.column_by_position(repeated, "client", 3)


@registry.add("SELECT l_orderkey AS commande, l_quantity AS quantite FROM lineitem WHERE l_tax < 0.03 "
              "UNION ALL SELECT l_orderkey, l_quantity FROM lineitem WHERE l_tax >= 0.03")
def extracts_by_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = Input(spark, sf_dir).lineitem
    first = lines.where("l_tax < 0.03").select(
        F.col("l_orderkey").alias("commande"), F.col("l_quantity").alias("quantite"))
    second = lines.where("l_tax >= 0.03").select("l_orderkey", "l_quantity")
    return sources.union_by_position([first, second])


@registry.add(with_views(
    "SELECT id_analyse, DT, Code_SANDRE, Val_resultat_analyse, kind FROM measure WHERE kind = 'STEP'"))
def office_with_two_extracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = Stages(spark, "office").path
    columns = ["id_analyse", "DT", "Code_SANDRE", "Val_resultat_analyse"]
    measure = Input(spark, sf_dir).measure.where("kind = 'STEP'")
    catalog = offices.office_catalog(folder, ".parquet")
    for dt, path in zip(("D0", "D1"), catalog["DSF", "STEP"]):
        measure.where(F.col("DT") == dt).select(columns).write.parquet(path)
    return offices.select_office_source(spark, "DSF", "STEP", catalog, "parquet",
                                        measure.select(columns).schema)


@registry.add(with_views("SELECT count(*) AS lignes, kind FROM measure WHERE DT = 'D1' GROUP BY kind"))
def office_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{Stages(spark, 'office').path}/measure"
    Input(spark, sf_dir).measure.select("DT", "kind", "id_analyse").write.partitionBy("DT").parquet(path)
    table = sources.read_table(spark, path, "parquet", T.StructType.fromDDL(
        "id_analyse string, kind string, DT string"))
    return offices.office_rows(table, "D1").groupBy("kind").agg(F.count("*").alias("lignes"))


_DATES = """SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN 'inconnue'
  ELSE concat(CAST(CAST(o_orderdate AS DATE) AS VARCHAR(10)), ' 23:30:00') END AS depot FROM orders"""


@registry.add(f"SELECT o_orderkey, CAST(try_cast(depot AS TIMESTAMP) AS DATE) AS depot FROM ({_DATES})")
def timestamps_to_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    Input(spark, sf_dir).orders.createOrReplaceTempView("orders")
    return cleaning.to_date(spark.sql(_DATES), ["depot"])


@registry.add(with_views("SELECT identifiant, try_cast(replace(X, ',', '.') AS DOUBLE) AS X, "
                         "try_cast(replace(Y, ',', '.') AS DOUBLE) AS Y FROM site_xy"))
def coordinates_with_decimal_comma(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = {new: old for old, new in SITE_XY_NAMES.items()}
    delivered = Input(spark, sf_dir).site_xy.withColumnsRenamed(back)
    return (cleaning.parse_decimal_comma(sources.select_rename(delivered, SITE_XY_NAMES), ["X", "Y"])
            .select("identifiant", "X", "Y"))


@registry.add(with_views("SELECT feuille, " + ", ".join(
    f"max(Valeur) FILTER (WHERE Variable = '{k}') AS {k}" for k in RUN_PARAMETERS)
    + " FROM parameter_rows WHERE Variable IS NOT NULL GROUP BY feuille"))
def parameter_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sources.pivot_parameters(Input(spark, sf_dir).parameter_rows, RUN_PARAMETERS, ["feuille"])


@registry.add(with_views("""SELECT pt_AS, CASE Classe WHEN '< 120 kgDBO/j' THEN '<120'
  WHEN 'de 120 à 600 kgDBO/j' THEN '120-600' WHEN '> 600 kgDBO/j' THEN '>600' END AS Classe,
  CASE Classe WHEN '< 120 kgDBO/j' THEN 1 WHEN 'de 120 à 600 kgDBO/j' THEN 2
  WHEN '> 600 kgDBO/j' THEN 3 END AS Classe_rang FROM sewer_list"""))
def ordered_size_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (cleaning.recode_ordered(Input(spark, sf_dir).sewer_list, "Classe", SIZE_CLASSES)
            .select("pt_AS", "Classe", "Classe_rang"))


@registry.add(with_views("""SELECT pt_AS, Code_SANDRE_SCL, coalesce(Type_reseau, reseau) AS Type_reseau
FROM sewer_list LEFT JOIN (SELECT code, reseau FROM (SELECT *, row_number() OVER (
  PARTITION BY code ORDER BY ordre) AS rn FROM network_lookup) WHERE rn = 1) ON code = Code_SANDRE_SCL"""))
def network_type_from_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Input(spark, sf_dir)
    return cleaning.fill_from_lookup(
        t.sewer_list, t.network_lookup, "Code_SANDRE_SCL", "Type_reseau", "code", "reseau", "ordre",
    ).select("pt_AS", "Code_SANDRE_SCL", "Type_reseau")


@registry.add(with_views(f"""SELECT * EXCLUDE (kind) FROM (
  SELECT *, count(*) OVER (PARTITION BY {_KEYS}, Date_depot) AS dupe_count
  FROM (SELECT {_KEYS}, Date_depot, kind, id_analyse, Val_resultat_analyse FROM measure))
WHERE dupe_count > 1"""))
def duplicate_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    measure = Input(spark, sf_dir).measure.select(
        *RESULT_KEYS, "Date_depot", "id_analyse", "Val_resultat_analyse")
    return cleaning.duplicate_report(measure, [*RESULT_KEYS, "Date_depot"])


@registry.add(with_views(f"""SELECT DT, Code_SANDRE, Commentaire_analyse, Derniere_qualif_analyse,
  count(*) AS dupe_count FROM measure GROUP BY DT, Code_SANDRE, Commentaire_analyse,
  Derniere_qualif_analyse HAVING count(*) > 1"""))
def duplicate_keys_with_missing_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ["DT", "Code_SANDRE", "Commentaire_analyse", "Derniere_qualif_analyse"]
    report = cleaning.duplicate_report(Input(spark, sf_dir).measure.select(keys), keys)
    return report.distinct()


@registry.add(with_views("SELECT * FROM latest", extra={"latest": LATEST}))
def latest_deposit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.keep_latest(Input(spark, sf_dir).measure, ["kind", *RESULT_KEYS])


@registry.add(with_views("SELECT id_analyse, Code_remarque FROM measure WHERE Code_remarque <> '0'"))
def done_analyses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.drop_not_done(Input(spark, sf_dir).measure).select("id_analyse", "Code_remarque")


@registry.add(with_views("SELECT id_analyse, Code_sandre_parametre, Code_unite FROM clean",
                         extra=CLEAN_VIEWS))
def cleaned_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (cleaning.clean_measures(Input(spark, sf_dir).measure, ["kind"])
            .select("id_analyse", "Code_sandre_parametre", "Code_unite"))


@registry.add(with_views(f"""SELECT id_analyse, Pt_SANDRE,
  CASE WHEN {_VOLUME} THEN '1552' ELSE Code_sandre_parametre END AS Code_sandre_parametre,
  CASE WHEN {_VOLUME} OR Code_sandre_parametre = '1552' THEN '120' ELSE Code_unite END AS Code_unite
FROM measure"""))
def volume_as_daily_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (cleaning.recode_volume(Input(spark, sf_dir).measure)
            .select("id_analyse", "Pt_SANDRE", "Code_sandre_parametre", "Code_unite"))


@registry.add(with_views("SELECT DISTINCT Code_sandre_parametre FROM measure"))
def parameters_present(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.distinct_parameters(Input(spark, sf_dir).measure)


@registry.add(with_views("SELECT DISTINCT Code_sandre_parametre, Code_unite FROM clean", extra=CLEAN_VIEWS))
def parameter_units_present(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.distinct_parameter_units(
        cleaning.clean_measures(Input(spark, sf_dir).measure, ["kind"]))


@registry.add(with_views("SELECT kind, Code_SANDRE FROM clean", extra=CLEAN_VIEWS))
def stations_of_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = cleaning.clean_measures(Input(spark, sf_dir).measure, ["kind"])
    plant, network = (cleaning.station_list(clean.where(F.col("kind") == kind)).withColumn("kind", F.lit(kind))
                      for kind in (KIND_PLANT, KIND_NETWORK))
    return plant.unionByName(network)


@registry.add(with_views("SELECT DISTINCT No_Sitou_Am, No_Sitou, "
                         "concat(right(No_Sitou_Am, 3), '-', right(No_Sitou, 3)) AS liaison FROM link"))
def prepared_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    link = Input(spark, sf_dir).link.withColumn("Liaison_Sitou-Amont", F.lit("x"))
    return cleaning.prepare_links(link)


@registry.add(with_views("SELECT No_Sitou AS identifiant, Nom_Sitou, No_Type_Sitou FROM site"))
def prepared_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.prepare_nodes(Input(spark, sf_dir).site)[0]


@registry.add(with_views("SELECT No_Sitou AS identifiant, DT FROM site"))
def site_offices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.prepare_nodes(Input(spark, sf_dir).site)[1]


@registry.add(with_views("SELECT * FROM parameter_dim WHERE Code_sandre_parametre IN "
                         "('1313','1314','1305','1319','1335','1339','1340','1551','1350')"))
def pollutant_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.parameter_dimension(Input(spark, sf_dir).parameter_dim)


@registry.add(with_views('SELECT login AS name, login AS title, type AS "group", '
                         "CAST(total AS BIGINT) AS value FROM contributor"))
def contributors(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{Stages(spark, 'json').path}/contributors"
    (Input(spark, sf_dir).contributor
     .select(F.to_json(F.struct(F.struct("login", "type").alias("author"), "total")).alias("value"))
     .write.text(path))
    return sources.contributors_table(
        sources.read_table(spark, path, "json", schemas.CONTRIBUTORS))
