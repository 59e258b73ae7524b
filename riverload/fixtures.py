"""Domain tables derived from the test tables, as SQL that Spark and DuckDB both run."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

_L, _I, _D, _S, _TS = "BIGINT", "INT", "DOUBLE", "STRING", "TIMESTAMP_NTZ"

TABLES = {
    "region": {"r_regionkey": _I, "r_name": _S},
    "nation": {"n_nationkey": _I, "n_name": _S, "n_regionkey": _I},
    "customer": {"c_custkey": _L, "c_name": _S, "c_nationkey": _I, "c_acctbal": _D, "c_mktsegment": _S},
    "supplier": {"s_suppkey": _L, "s_name": _S, "s_nationkey": _I, "s_acctbal": _D},
    "part": {"p_partkey": _L, "p_name": _S, "p_brand": _S, "p_type": _S, "p_size": _I,
             "p_retailprice": _D},
    "orders": {"o_orderkey": _L, "o_custkey": _L, "o_orderstatus": _S, "o_totalprice": _D,
               "o_orderdate": _TS, "o_orderpriority": _S},
    "lineitem": {"l_orderkey": _L, "l_partkey": _L, "l_suppkey": _L, "l_linenumber": _I,
                 "l_quantity": _D, "l_extendedprice": _D, "l_discount": _D, "l_tax": _D,
                 "l_returnflag": _S, "l_linestatus": _S, "l_shipdate": _TS},
    "documents": {"doc_id": _L, "text": _S, "lang": _S, "source": _S, "n_chars": _L},
}

# Views of the check's SQL that are read several times and computed once.
MATERIALIZED = {"latest", "clean", "grid", "known", "ratio", "plant_rows", "plant_days", "plant_known", "plant_load", "plant_ratio"}

# Each view may use the test tables and the views before it.
VIEWS = {
    "cust_site": """
SELECT *, concat('C', c_custkey, CASE c_custkey % 4 WHEN 0 THEN '085' WHEN 1 THEN '025'
  WHEN 2 THEN '242' ELSE '096' END) AS id FROM customer""",
    "nation_site": """
SELECT *, concat('N', n_nationkey, CASE n_nationkey % 4 WHEN 0 THEN '012' WHEN 1 THEN '243'
  WHEN 2 THEN '029' ELSE '013' END) AS id FROM nation""",
    "site": """
SELECT concat('O', o_orderkey, '026') AS No_Sitou, concat('rejet ', o_orderkey) AS Nom_Sitou,
  '026' AS No_Type_Sitou, concat('D', o_orderkey % 6) AS DT FROM orders
UNION ALL SELECT id, c_name, right(id, 3), concat('D', c_custkey % 6) FROM cust_site
UNION ALL SELECT id, n_name, right(id, 3), concat('D', n_nationkey % 6) FROM nation_site
UNION ALL SELECT concat('R', r_regionkey, '001'), r_name, '001', 'D0' FROM region
UNION ALL SELECT concat('A', c_custkey, '224'), concat('AS ', c_custkey), '224',
  concat('D', c_custkey % 6) FROM customer WHERE c_custkey % 4 < 2""",
    "link": """
SELECT c.id AS No_Sitou_Am, concat('O', o_orderkey, '026') AS No_Sitou
  FROM orders JOIN cust_site c ON o_custkey = c_custkey AND o_orderkey % 11 <> 0
UNION ALL SELECT n.id, c.id FROM cust_site c JOIN nation_site n ON c_nationkey = n_nationkey
UNION ALL SELECT concat('R', n_regionkey, '001'), id FROM nation_site
UNION ALL SELECT concat('O', o_orderkey, '026'), concat('O', o_orderkey + 1, '026')
  FROM orders WHERE o_orderkey % 50 = 0
UNION ALL SELECT concat('O', o_orderkey, '026'), concat('R', o_orderkey % 5, '001')
  FROM orders WHERE o_orderkey % 7 <> 0
UNION ALL SELECT id, concat('A', c_custkey, '224') FROM cust_site WHERE c_custkey % 4 < 2""",
    "plant_points": """
SELECT n.id AS site_origine, concat('S', s_suppkey, '223') AS pt_AS,
  concat('A', 1 + s_suppkey % 5) AS nom_pt_AS
FROM supplier JOIN nation_site n ON s_nationkey = n_nationkey WHERE right(n.id, 3) = '029'""",
    "measure_base": """
SELECT *, CASE WHEN l_suppkey % 10 < 5 THEN 'STEP' ELSE 'SCL' END AS kind,
  concat('03', 10 + l_suppkey % 3, '00000', l_suppkey) AS code,
  CASE WHEN l_suppkey % 10 < 5
    THEN (CASE l_linenumber % 4 WHEN 0 THEN 'A4' WHEN 1 THEN 'A2' WHEN 2 THEN 'A4' ELSE 'A3' END)
    ELSE (CASE l_linenumber % 2 WHEN 0 THEN 'A1' ELSE 'R1' END) END AS pt
FROM lineitem""",
    "measure": """
SELECT concat(l_orderkey, '-', l_linenumber) AS id_analyse, kind,
  concat('D', l_suppkey % 2) AS DT, code AS Code_SANDRE,
  concat('PP', l_suppkey % 4) AS PP_No_interne_Sitou, pt AS Pt_SANDRE,
  CAST(DATE '2020-07-01' + CAST(l_orderkey % 366 AS INT) AS DATE) AS Date_debut_prel,
  CAST(l_shipdate AS DATE) AS Date_depot,
  CASE WHEN l_partkey % 10 < 3 THEN '1552' WHEN l_partkey % 10 = 3 THEN '1098'
    WHEN l_partkey % 10 < 6 THEN '1313' WHEN l_partkey % 10 < 8 THEN '1314'
    WHEN l_partkey % 10 = 8 THEN '1305'
    ELSE (CASE (l_partkey % 70) - 9 WHEN 0 THEN '1319' WHEN 10 THEN '1335' WHEN 20 THEN '1339' WHEN 30 THEN '1340'
    WHEN 40 THEN '1551' WHEN 50 THEN '1350' ELSE '9999' END) END AS Code_sandre_parametre,
  CASE WHEN l_partkey % 10 = 3 THEN '117' ELSE '133' END AS Code_unite,
  CASE WHEN l_quantity <= 2 THEN 0.0 WHEN l_quantity > 48 THEN NULL ELSE l_quantity END
    AS Val_resultat_analyse,
  CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_returnflag END AS Derniere_qualif_analyse,
  CASE WHEN l_tax = 0 THEN '0' WHEN l_tax = 0.08 THEN NULL ELSE '1' END AS Code_remarque,
  l_linestatus AS Commentaire_analyse,
  CASE WHEN kind = 'STEP' THEN concat('Station ', right(code, 1)) END AS Station_Nom_Sitou,
  CASE WHEN kind = 'STEP' THEN 1000.0 * CAST(l_suppkey % 10 AS DOUBLE) END AS Step_Capacite_nominale,
  CASE WHEN kind = 'SCL' THEN concat('Reseau ', right(code, 1)) END AS SCL_Nom_Sitou,
  CASE WHEN kind = 'SCL' THEN (CASE WHEN l_suppkey % 10 < 8 THEN '<120' ELSE '>600' END) END
    AS Classe_CBPO,
  CASE WHEN kind = 'SCL' THEN concat('PT', l_suppkey % 10, pt) END AS Identifiant_pt_AS,
  CASE WHEN kind = 'SCL' THEN concat('Point ', pt) END AS Nom_pt_AS
FROM measure_base""",
    "parameter_dim": """
SELECT DISTINCT CASE p_partkey % 12 WHEN 0 THEN '1552' WHEN 1 THEN '1098' WHEN 2 THEN '1313'
    WHEN 3 THEN '1314' WHEN 4 THEN '1305' WHEN 5 THEN '1319' WHEN 6 THEN '1335' WHEN 7 THEN '1339'
    WHEN 8 THEN '1340' WHEN 9 THEN '1551' WHEN 10 THEN '1350' ELSE '9998' END AS Code_sandre_parametre,
  'mg/L' AS Symbole_unite, concat('Par', p_partkey % 12) AS Lib_court_parametre
FROM part""",
    "site_xy": """
SELECT concat('O', o_orderkey, '026') AS identifiant, concat('rejet ', o_orderkey) AS Nom_Sitou,
  concat(600000 + (o_orderkey * 7919) % 200000, ',5') AS X,
  concat(6600000 + (o_orderkey * 104729) % 200000, ',25') AS Y FROM orders
UNION ALL SELECT id, n_name, concat(630000 + n_nationkey * 4000, ',0'),
  CASE WHEN n_nationkey % 9 = 8 THEN 'inconnue' ELSE concat(6640000 + n_nationkey * 3000, ',75') END
FROM nation_site""",
    "perimeter_edges": """
SELECT layer, ID, CAST(x1 AS DOUBLE) AS x1, CAST(y1 AS DOUBLE) AS y1,
  CAST(x2 AS DOUBLE) AS x2, CAST(y2 AS DOUBLE) AS y2 FROM (VALUES
 ('DEPARTEMENT','P1',640000.0,6640000.0,760000.0,6640000.0),
 ('DEPARTEMENT','P1',760000.0,6640000.0,700000.0,6780000.0),
 ('DEPARTEMENT','P1',700000.0,6780000.0,640000.0,6640000.0),
 ('DEPARTEMENT','P1',690000.0,6670000.0,710000.0,6670000.0),
 ('DEPARTEMENT','P1',710000.0,6670000.0,710000.0,6690000.0),
 ('DEPARTEMENT','P1',710000.0,6690000.0,690000.0,6690000.0),
 ('DEPARTEMENT','P1',690000.0,6690000.0,690000.0,6670000.0),
 ('UH','U1',600000.0,6600000.0,650000.0,6600000.0), ('UH','U1',650000.0,6600000.0,650000.0,6650000.0),
 ('UH','U1',650000.0,6650000.0,600000.0,6650000.0), ('UH','U1',600000.0,6650000.0,600000.0,6600000.0)
) AS t(layer, ID, x1, y1, x2, y2)""",
    # One triangle per customer, of two sizes: a layer that grows with the data.
    "customer_corner": """
SELECT concat('E', c_custkey) AS ID, 600000.0 + (c_custkey * 3571) % 190000 AS x,
  6600000.0 + (c_custkey * 8513) % 190000 AS y,
  CASE WHEN c_custkey % 40 = 0 THEN 9000.0 ELSE 1200.0 END AS s
FROM customer""",
    "customer_edges": """
SELECT 'EPCI' AS layer, ID, CAST(x AS DOUBLE) AS x1, CAST(y AS DOUBLE) AS y1,
  CAST(x + s AS DOUBLE) AS x2, CAST(y AS DOUBLE) AS y2 FROM customer_corner
UNION ALL SELECT 'EPCI', ID, x + s, y, x, y + s FROM customer_corner
UNION ALL SELECT 'EPCI', ID, x, y + s, x, y FROM customer_corner""",
    # The parameter sheet, one per nation, with rows that have no key.
    "parameter_rows": """
SELECT c_nationkey AS feuille, CASE c_custkey % 6 WHEN 0 THEN 'TYPE_PERIMETRE'
    WHEN 1 THEN 'PERIMETRE' WHEN 2 THEN 'DT' WHEN 3 THEN 'TAMPON'
    WHEN 4 THEN 'perimetre_custom' END AS Variable, c_name AS Valeur FROM customer""",
    "sewer_list": """
SELECT concat('D', c_custkey % 6) AS DT, concat('03', 10 + c_custkey % 80, '0', c_nationkey) AS Code_SANDRE_SCL,
  c_name AS Nom_SCL, id AS pt_AS, c_name AS nom_pt_AS,
  CASE c_custkey % 5 WHEN 0 THEN '< 120 kgDBO/j' WHEN 1 THEN 'de 120 à 600 kgDBO/j'
    WHEN 2 THEN '> 600 kgDBO/j' WHEN 3 THEN 'autre' END AS Classe,
  CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_mktsegment END AS Type_reseau
FROM cust_site""",
    "network_lookup": """
SELECT concat('03', 10 + o_custkey % 80, '0', o_orderkey % 25) AS code, o_orderkey AS ordre,
  CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_orderpriority END AS reseau
FROM orders""",
    "plant_list": """
SELECT CASE s_suppkey % 4 WHEN 0 THEN 'CL' WHEN 1 THEN NULL ELSE 'EX' END AS IDTYPE_SITUATION,
  CASE s_suppkey % 3 WHEN 0 THEN 'Pollution Ile de France' WHEN 1 THEN 'Pollution Petite Couronne'
    ELSE 'Pollution Seine Aval' END AS UNITE_GESTIONNAIRE,
  concat('03', 10 + s_suppkey % 3, '00000', s_suppkey) AS VALEUR_FCT_PRINCIPAL,
  s_name AS NOM, concat('MOA ', s_nationkey) AS MOA, s_acctbal AS capacite
FROM supplier""",
    "contributor": """
SELECT source AS login, lang AS type, sum(n_chars) AS total FROM documents GROUP BY source, lang""",
}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One test table or derived view."""
    if name in TABLES:
        return _table(spark, sf_dir, name)
    sql = with_views(f"SELECT * FROM {name}", name)
    for table in TABLES:
        if _mentions(sql, table):
            _table(spark, sf_dir, table).createOrReplaceTempView(table)
    return spark.sql(sql)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    schema = ", ".join(f"{c} {t}" for c, t in TABLES[name].items())
    return spark.read.schema(schema).parquet(f"{sf_dir}/{name}.parquet")


def with_views(body: str, *names: str, recursive: bool = False, extra: dict[str, str] | None = None) -> str:
    """``body`` behind a WITH clause of the views it needs and of ``extra`` ones."""
    extra = extra or {}
    needed: list[str] = []

    def need(name: str) -> None:
        if name in VIEWS and name not in needed:
            for other in VIEWS:
                if other != name and _mentions(VIEWS[name], other):
                    need(other)
            needed.append(name)

    for text in (body, *extra.values()):
        for other in VIEWS:
            if _mentions(text, other):
                need(other)
    for name in names:
        need(name)
    parts = {n: VIEWS[n] for n in needed} | extra
    if not parts:
        return body
    clauses = ",\n".join(f"{n} AS {'MATERIALIZED ' if n in MATERIALIZED else ''}({text.strip()})" for n, text in parts.items())
    return f"WITH {'RECURSIVE ' if recursive else ''}{clauses}\n{body}"


def _mentions(text: str, name: str) -> bool:
    return re.search(rf"\b{name}\b", text) is not None
