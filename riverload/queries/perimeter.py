"""Points in a perimeter and what is known about them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riverload.fixed_values import RUN_PARAMETERS, SIZE_CLASSES
from riverload.fixtures import with_views
from riverload.operators import sites, spatial
from riverload.operators.cleaning import recode_ordered
from riverload.plans import perimeter as plans
from riverload.queries.network import TABLE_VIEWS, Network
from riverload.queries.registry import Input, Registry
from riverload.sinks.writers import features, write_features
from riverload.stages import Stages

registry = Registry()

PARAMS = {"TYPE_PERIMETRE": "DEPARTEMENT", "PERIMETRE": "P1", "DT": "D1", "TAMPON": "3",
          "perimetre_custom": None}

_XY = {"xy": """SELECT * FROM (SELECT identifiant, Nom_Sitou,
  try_cast(replace(X, ',', '.') AS DOUBLE) AS X, try_cast(replace(Y, ',', '.') AS DOUBLE) AS Y
  FROM site_xy) WHERE X IS NOT NULL AND Y IS NOT NULL"""}
# Per point and feature: edges crossed by a ray to the right, squared distance to the boundary.
_NEAREST = """SELECT *, greatest(0.0, least(1.0, CASE WHEN (x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1) = 0
    THEN 0.0 ELSE ((X - x1) * (x2 - x1) + (Y - y1) * (y2 - y1))
      / ((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1)) END)) AS t FROM xy CROSS JOIN chosen"""
_FEATURES = """SELECT identifiant, X, Y, ID,
  count(*) FILTER (WHERE (y1 > Y) <> (y2 > Y)
    AND X < x1 + (Y - y1) * (x2 - x1) / nullif(y2 - y1, 0)) AS crossed,
  min((X - (x1 + t * (x2 - x1))) ** 2 + (Y - (y1 + t * (y2 - y1))) ** 2) AS d2
FROM nearest GROUP BY identifiant, X, Y, ID"""


def _spatial(chosen: str, condition: str) -> dict[str, str]:
    return _XY | {
        "chosen": chosen, "nearest": _NEAREST, "by_feature": _FEATURES,
        "inside": f"SELECT * FROM xy WHERE identifiant IN "
                  f"(SELECT identifiant FROM by_feature WHERE {condition})",
    }


def _sql(body: str, views: dict[str, str], recursive: bool = False) -> str:
    return with_views(body, extra=views, recursive=recursive)


_P1 = "SELECT * FROM perimeter_edges WHERE layer = 'DEPARTEMENT' AND ID = 'P1'"
_AT_3_KM = _spatial(_P1, "crossed % 2 = 1 OR d2 <= 3000.0 * 3000.0")
_SITES = TABLE_VIEWS | _AT_3_KM | {
    "typed": """SELECT *, CASE right(site_origine, 3) WHEN '029' THEN 'STEU' WHEN '243' THEN 'SCL'
  WHEN '012' THEN 'INDUSTRIE' ELSE 'AUTRE' END AS type_rejet FROM full_table
WHERE rejet IN (SELECT identifiant FROM inside WHERE right(identifiant, 3) = '026')""",
    "attached": """SELECT i.identifiant AS rejet, i.Nom_Sitou AS nom_rejet, i.X, i.Y,
  t.* EXCLUDE (rejet, nom_rejet) FROM inside i
LEFT JOIN typed t ON t.rejet = i.identifiant AND t.nom_rejet IS NOT DISTINCT FROM i.Nom_Sitou
WHERE i.identifiant IN (SELECT rejet FROM typed)""",
}


class Perimeter(Network):
    """Points, perimeters and correspondence of one data folder."""

    def xy(self) -> DataFrame:
        return spatial.points_from_xy(self.site_xy)

    def monitoring_points(self) -> DataFrame:
        return recode_ordered(self.sewer_list, "Classe", SIZE_CLASSES)

    def result(self) -> plans.PerimeterTables:
        return plans.perimeter_tables(
            self.site_xy, self.counted_origins(), self.monitoring_points(), self.perimeter_edges, PARAMS, self.plant_points)

    def inside(self, kind: str = "DEPARTEMENT", name: str = "P1", radius: float = 0.0) -> DataFrame:
        layer = spatial.select_perimeter_layer(self.perimeter_edges, kind)
        chosen = spatial.filter_perimeter(layer, PARAMS | {"TYPE_PERIMETRE": kind, "PERIMETRE": name})
        return spatial.points_in_perimeter(self.xy(), chosen, radius)


@registry.add(with_views("SELECT layer, ID, count(*) AS cotes FROM customer_edges "
                         "WHERE ID = 'E40' GROUP BY layer, ID"))
def chosen_feature_of_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = Input(spark, sf_dir).customer_edges
    params = PARAMS | {"TYPE_PERIMETRE": "EPCI", "PERIMETRE": "E40"}
    chosen, _ = plans.chosen_perimeter(edges, params)
    return chosen.groupBy("layer", "ID").agg(F.count("*").alias("cotes"))


@registry.add(_sql("SELECT * FROM xy", _XY))
def points_from_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Perimeter(spark, sf_dir).xy()


@registry.add(_sql("SELECT (SELECT count(*) FROM site_xy) - (SELECT count(*) FROM xy) "
                   "AS sans_coordonnees, (SELECT count(*) FROM site_xy) AS total", _XY))
def points_without_coordinates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spatial.missing_xy(Input(spark, sf_dir).site_xy)


@registry.add(_sql("SELECT * FROM inside", _spatial(_P1, "crossed % 2 = 1 OR d2 <= 0")))
def points_in_perimeter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Perimeter(spark, sf_dir).inside()


@registry.add(_sql("SELECT * FROM inside", _AT_3_KM))
def points_in_buffered_perimeter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Perimeter(spark, sf_dir).inside(radius=spatial.buffer_distance(PARAMS))


@registry.add(_sql("SELECT * FROM inside",
                   _spatial(_P1, "crossed % 2 = 1 AND d2 >= 2000.0 * 2000.0")))
def points_in_shrunk_perimeter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Perimeter(spark, sf_dir).inside(radius=-2000.0)


# Only points in the surroundings of a feature can be within 250 m of it.
_MANY = _spatial("""SELECT *, min(least(x1, x2)) OVER w AS west, max(greatest(x1, x2)) OVER w AS east,
  min(least(y1, y2)) OVER w AS south, max(greatest(y1, y2)) OVER w AS north
FROM customer_edges WINDOW w AS (PARTITION BY ID)""", "crossed % 2 = 1 OR d2 <= 250.0 * 250.0")
_MANY["nearest"] = _NEAREST.replace("xy CROSS JOIN chosen", """xy JOIN chosen
  ON X BETWEEN west - 250 AND east + 250 AND Y BETWEEN south - 250 AND north + 250""")


@registry.add(_sql("SELECT * FROM inside", _MANY))
def points_in_many_perimeters(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Perimeter(spark, sf_dir)
    return spatial.points_in_perimeter(t.xy(), t.customer_edges, 250.0)


@registry.add(_sql("SELECT identifiant FROM inside WHERE right(identifiant, 3) = '026'", _AT_3_KM))
def discharge_points_in_perimeter(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Perimeter(spark, sf_dir)
    perimeter, radius = plans.chosen_perimeter(t.perimeter_edges, PARAMS)
    return spatial.discharge_points_in_perimeter(t.xy(), perimeter, radius)


@registry.add(_sql("SELECT * FROM typed", _SITES, recursive=True))
def typed_correspondence_in_perimeter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Perimeter(spark, sf_dir).result().correspondence


@registry.add(_sql("SELECT * FROM attached", _SITES, recursive=True))
def discharges_with_correspondence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Perimeter(spark, sf_dir).result().discharges


@registry.add(_sql("""SELECT a.rejet, a.pt_AS, a.nom_pt_AS,
  CASE Classe WHEN '< 120 kgDBO/j' THEN '<120' WHEN 'de 120 à 600 kgDBO/j' THEN '120-600'
  WHEN '> 600 kgDBO/j' THEN '>600' END AS Classe, Type_reseau, a.X, a.Y
FROM attached a LEFT JOIN sewer_list s ON s.pt_AS IS NOT DISTINCT FROM a.pt_AS
  AND s.nom_pt_AS IS NOT DISTINCT FROM a.nom_pt_AS
WHERE type_rejet = 'SCL'""", _SITES, recursive=True))
def sewer_discharges_with_network(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Perimeter(spark, sf_dir).result().sewers


@registry.add(_sql("SELECT * FROM inside WHERE identifiant IN (SELECT site_origine FROM typed)",
                   _SITES, recursive=True))
def origin_sites_in_perimeter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Perimeter(spark, sf_dir).result().origins


@registry.add(_sql("SELECT * FROM inside WHERE identifiant IN (SELECT site_origine FROM typed) "
                   "AND right(identifiant, 3) <> '243'", _SITES, recursive=True))
def origin_sites_without_sewers(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Perimeter(spark, sf_dir)
    result = t.result()
    # Pairing adds no further origin, so the pairs are not made for this.
    return sites.origin_sites_in_perimeter(result.inside, result.unpaired, as_written=False)


_FEATURE = ("""concat('{"type":"Feature","geometry":{"type":"Point","coordinates":[', """
            """CAST(l_orderkey AS VARCHAR), '.5,', CAST(l_partkey AS VARCHAR), '.25]},""" 
            """"properties":{"rejet":"L', l_orderkey, '","rang":', l_linenumber, '}}')""")


@registry.add(f"SELECT {_FEATURE} AS value FROM lineitem")
def points_as_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = Input(spark, sf_dir).lineitem
    return features(lines.select(
        F.concat(F.lit("L"), "l_orderkey").alias("rejet"), F.col("l_linenumber").alias("rang"),
        (F.col("l_orderkey") + 0.5).cast("double").alias("X"),
        (F.col("l_partkey") + 0.25).cast("double").alias("Y")))


@registry.add(_sql("SELECT identifiant, X, Y FROM inside", _AT_3_KM))
def written_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{Stages(spark, 'output').path}/features"
    write_features(Perimeter(spark, sf_dir).inside(radius=3000.0), path)
    parsed = F.from_json("value", "geometry struct<coordinates: array<double>>, properties struct<identifiant: string>")
    return spark.read.text(path).select(parsed.alias("f")).select(
        "f.properties.identifiant", F.col("f.geometry.coordinates")[0].alias("X"),
        F.col("f.geometry.coordinates")[1].alias("Y"))


# Features of all five layers: the rectangle and the triangle moved about, one office in mixed case.
_LAYERS = """SELECT * FROM perimeter_edges
UNION ALL SELECT 'DT', 'd1b', x1 + 90000, y1 + 20000, x2 + 90000, y2 + 20000 FROM perimeter_edges WHERE ID = 'U1'
UNION ALL SELECT 'EPCI', 'E9', x1 + 140000, y1 + 140000, x2 + 140000, y2 + 140000 FROM perimeter_edges WHERE ID = 'U1'
UNION ALL SELECT 'EPCI', 'E8', x1, y1, x2, y2 FROM perimeter_edges WHERE ID = 'U1'
UNION ALL SELECT 'PERSONNALISE', 'own', x1 + 30000, y1 + 140000, x2 + 30000, y2 + 140000 FROM perimeter_edges WHERE ID = 'P1'"""
_SHEETS = """SELECT * FROM (VALUES
 ('1', 'TYPE_PERIMETRE', 'DT'), ('1', 'DT', 'D1B'), ('1', 'TAMPON', '1.5'), ('2', 'TYPE_PERIMETRE', 'EPCI'), ('2', 'PERIMETRE', 'E9'),
 ('3', 'TYPE_PERIMETRE', 'UH'), ('3', 'PERIMETRE', 'U1'), ('3', 'TAMPON', '0.25'), ('4', 'TYPE_PERIMETRE', 'PERSONNALISE'), ('4', 'TAMPON', '2'),
 ('5', 'TYPE_PERIMETRE', 'DEPARTEMENT'), ('5', 'PERIMETRE', 'P1'), ('5', 'TAMPON', '-4'), ('6', 'TYPE_PERIMETRE', 'EPCI'), ('6', 'PERIMETRE', 'none')
) AS t(run, Variable, Valeur)"""
_BY_SHEETS = _XY | {
    "chosen": f"""SELECT e.layer || e.ID AS ID, x1, y1, x2, y2, CAST(r.radius AS DOUBLE) AS radius FROM ({_LAYERS}) e
JOIN (VALUES ('DT', 'd1b', 1500), ('EPCI', 'E9', 0), ('UH', 'U1', 250), ('PERSONNALISE', 'own', 2000), ('DEPARTEMENT', 'P1', -4000)) r(layer, name, radius)
 ON e.layer = r.layer AND e.ID = r.name""",
    "nearest": _NEAREST, "by_feature": _FEATURES.replace("Y, ID,", "Y, ID, max(radius) AS radius,"),
    "inside": """SELECT * FROM xy WHERE identifiant IN (SELECT identifiant FROM by_feature
 WHERE CASE WHEN radius < 0 THEN crossed % 2 = 1 AND d2 >= radius * radius ELSE crossed % 2 = 1 OR d2 <= radius * radius END)""",
}


@registry.add(_sql("SELECT * FROM inside", _BY_SHEETS))
def points_of_parameter_sheets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points inside the perimeters that several parameter sheets name, each with its buffer."""
    t = Perimeter(spark, sf_dir)
    edges = spark.sql(_LAYERS.replace("perimeter_edges", "{edges}"), edges=t.perimeter_edges)
    sheets = spark.sql(_SHEETS).groupBy("run").pivot("Variable", list(RUN_PARAMETERS)).agg(F.first("Valeur"))
    return spatial.points_in_perimeter(t.xy(), spatial.perimeters_of_sheets(edges, sheets))
