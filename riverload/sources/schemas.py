"""Schemas of the input tables, under their source headers. Nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T


def _schema(strings=(), **typed) -> T.StructType:
    fields = [T.StructField(name, T.StringType()) for name in strings]
    fields += [T.StructField(name, kind) for name, kind in typed.items()]
    return T.StructType(fields)


LINK = _schema(["No_Sitou_Am", "No_Sitou", "Liaison_Sitou-Amont"])
SITE = _schema(["No_Sitou", "Nom_Sitou", "No_Type_Sitou", "DT", "Libellé UG"])
PLANT_POINTS = _schema(["No interne Sitou amont", "No interne Sitou", "LocalisationSitouref"])
SEWER_POINTS = _schema([
    "DT", "Code_SANDRE_SCL", "Nom_SCL", "No interne Sitou", "Nom Sitou",
    "Identifiant principal Sitou", "LocalisationSitouref", "Classe", "Type réseau",
])
NETWORK_LOOKUP = _schema(["Code Sandre SCL Sitouref", "Type_reseau"], ordre=T.LongType())
PARAMETER_DIM = _schema(["Code sandre paramètre", "Symbole_unite", "Lib_court_parametre"])
RUN_PARAMS = _schema(["Variable", "Valeur"])
SITE_XY = _schema(
    ["No interne Sitou", "Nom Sitou", "Coordonnée X L93", "Coordonnée Y L93"])
PLANT_LIST = _schema(
    ["IDTYPE_SITUATION", "UNITE GESTIONNAIRE", "VALEUR_FCT_PRINCIPAL", "NOM", "MOA (Roseau)"],
    **{"29.CAPACIT - Capacité nominale": T.DoubleType()},
)
PERIMETER_EDGES = _schema(
    ["layer", "ID"],
    x1=T.DoubleType(), y1=T.DoubleType(), x2=T.DoubleType(), y2=T.DoubleType(),
)
CONTRIBUTORS = T.StructType([
    T.StructField("author", T.StructType([
        T.StructField("login", T.StringType()), T.StructField("type", T.StringType()),
    ])),
    T.StructField("total", T.LongType()),
])
_MEASURE = [
    T.StructField("Code analyse", T.StringType()),
    T.StructField("DT", T.StringType()),
    T.StructField("Code SANDRE", T.StringType()),
    T.StructField("PP_No interne Sitou", T.StringType()),
    T.StructField("Pt SANDRE", T.StringType()),
    T.StructField("Date début prélèvt", T.TimestampType()),
    T.StructField("Date du dépôt", T.TimestampType()),
    T.StructField("Code sandre paramètre", T.StringType()),
    T.StructField("Code unité", T.StringType()),
    T.StructField("Val résultat analyse", T.DoubleType()),
    T.StructField("Dernière qualification analyse", T.StringType()),
    T.StructField("Code remarque", T.StringType()),
    T.StructField("Commentaire analyse", T.StringType()),
]
MEASURE_PLANT = T.StructType(_MEASURE + [
    T.StructField("Station_Nom_Sitou", T.StringType()),
    T.StructField("Step_Capacite_nominale", T.DoubleType()),
])
MEASURE_NETWORK = T.StructType(_MEASURE + [
    T.StructField(name, T.StringType())
    for name in ("SCL_Nom_Sitou", "Classe_CBPO", "Identifiant_pt_AS", "Nom_pt_AS")
])
