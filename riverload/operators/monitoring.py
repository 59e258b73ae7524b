"""Pairing discharge points with monitoring points and receiving waters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riverload.fixed_values import (
    INDUSTRY_TO_DISCHARGE, INDUSTRY_TO_POINT, PLANT_DISCHARGE_LOCATIONS, TO_CHECK,
    TYPE_INDUSTRY, TYPE_PLANT, TYPE_SEWER_NETWORK, TYPE_SEWER_POINT,
)
from riverload.functions.aggregates import count_values, stack
from riverload.functions.columns import site_type
from riverload.functions.joins import non_members, null_safe_join

#: Keys over which the discharges of one plant are dealt.
PARTS = 16
_ORDER = ("DT", "rang", "site_origine", "nom_site_origine", "pt_AS", "nom_pt_AS", "rejet", "nom_rejet")


def of_type(origins: DataFrame, *types: str) -> DataFrame:
    return origins.where(site_type("site_origine").isin(*types))


def monitoring_sewer(origins: DataFrame, links: DataFrame, nodes: DataFrame) -> DataFrame:
    """Sewer origins with every sewer monitoring point directly upstream of the discharge."""
    points = (links.where(site_type("No_Sitou_Am") == TYPE_SEWER_POINT)
              .select(F.col("No_Sitou").alias("rejet"), F.col("No_Sitou_Am").alias("pt_AS")))
    paired = null_safe_join(of_type(origins, TYPE_SEWER_NETWORK), points, "rejet", "left")
    return null_safe_join(paired, _point_names(nodes), "pt_AS", "left").select(*_ORDER)


def monitoring_plant(origins: DataFrame, plant_points: DataFrame) -> DataFrame:
    """Plant origins with all monitoring points of the plant that sit on a discharge.

    ``plant_points`` holds ``site_origine, pt_AS, nom_pt_AS``; the name is the location code.
    A plant has many discharges and many points, and these are multiplied here, so whatever
    needs no point is better done before: :func:`with_plant_points`.
    """
    return _with_points(of_type(origins, TYPE_PLANT), plant_points).select(*_ORDER)


def points_on_discharge(plant_points: DataFrame) -> DataFrame:
    """Monitoring points of plants that sit on a discharge."""
    return plant_points.where(F.col("nom_pt_AS").isin(*PLANT_DISCHARGE_LOCATIONS))


def plant_origins(origins: DataFrame) -> DataFrame:
    """Plant origins that :func:`with_plant_points` is to pair."""
    missing = [F.lit(None).cast("string").alias(c) for c in ("pt_AS", "nom_pt_AS")]
    return of_type(origins, TYPE_PLANT).select("*", *missing).select(*_ORDER)


def industry_pairs(links: DataFrame, nodes: DataFrame) -> DataFrame:
    """(rejet, pt_AS) fed by the same workshop or industrial plant."""
    to_point = (links.where(F.col("liaison").isin(*INDUSTRY_TO_POINT))
                .select("No_Sitou_Am", F.col("No_Sitou").alias("pt_AS")))
    to_discharge = (links.where(F.col("liaison").isin(*INDUSTRY_TO_DISCHARGE))
                    .select("No_Sitou_Am", F.col("No_Sitou").alias("rejet")))
    # Both link families end in a type, so neither side has a missing key.
    pairs = to_point.join(to_discharge, "No_Sitou_Am").select("rejet", "pt_AS")
    return null_safe_join(pairs, _point_names(nodes), "pt_AS", "left")


def monitoring_industry(origins: DataFrame, links: DataFrame, nodes: DataFrame) -> DataFrame:
    """Industrial origins with the monitoring points linked to the discharge."""
    return null_safe_join(of_type(origins, TYPE_INDUSTRY), industry_pairs(links, nodes),
                          "rejet", "left").select(*_ORDER)


def leftover_origins(origins: DataFrame) -> DataFrame:
    """Rows of discharge points that have no sewer, plant or industrial origin.

    The three pairings are left joins, so their discharge points are those of
    the origins of their type; the pairings need not be computed for this.
    """
    paired = of_type(origins, TYPE_PLANT, TYPE_SEWER_NETWORK, TYPE_INDUSTRY)
    return non_members(origins, "rejet", paired)


def correspondence(
    plant: DataFrame, sewer: DataFrame, industry: DataFrame, leftover: DataFrame,
    links: DataFrame, nodes: DataFrame,
) -> DataFrame:
    """All pairings, with the site downstream of the discharge as receiving water.

    ``plant`` may be the plant origins alone, for :func:`with_plant_points` to pair at the end.
    """
    downstream = links.select(F.col("No_Sitou_Am").alias("rejet"),
                              F.col("No_Sitou").alias("milieu_recepteur"))
    names = nodes.select(F.col("identifiant").alias("milieu_recepteur"),
                         F.col("Nom_Sitou").alias("nom_milieu_recepteur"))
    pairings = stack(plant, sewer, industry, leftover)
    received = null_safe_join(pairings, downstream, "rejet", "left")
    return (null_safe_join(received, names, "milieu_recepteur", "left")
            .select(*_ORDER, "milieu_recepteur", "nom_milieu_recepteur"))


def with_plant_points(table: DataFrame, plant_points: DataFrame, *further: str) -> DataFrame:
    """``table`` with its plant origins paired with the points of their plants; other rows as they are.

    ``further`` columns of the points are added, null in the other rows.
    """
    plants = of_type(table, TYPE_PLANT).drop("pt_AS", "nom_pt_AS")
    return stack(_paired(table), _with_points(plants, plant_points, *further)).select(*table.columns, *further)


def correspondence_counts(table: DataFrame, plant_points: DataFrame | None = None) -> DataFrame:
    """Add points per discharge, points per origin and discharges per origin.

    The two counts per origin meet first, in one row per origin, so the table
    itself is joined twice rather than three times. With ``plant_points`` the plant origins
    of ``table`` are not paired yet, and the counts are those of the paired table.
    """
    if plant_points is None:
        per_discharge = count_values(table, "rejet", "pt_AS", "nb_pt_AS_par_rejet")
        points_per_origin = count_values(table, "site_origine", "pt_AS", "nb_pt_AS_par_site")
    else:
        plants = of_type(table, TYPE_PLANT).select("rejet", "site_origine").distinct()
        points = _points_of_plants(plants, plant_points)
        per_discharge = _points_per_discharge(plants, points, _paired(table))
        # An origin is a plant or is none, so the two parts have no origin in common.
        points_per_origin = stack(*[count_values(part, "site_origine", "pt_AS", "nb_pt_AS_par_site")
                                    for part in (points, _paired(table))])
    per_origin = null_safe_join(
        points_per_origin, count_values(table, "site_origine", "rejet", "nb_rejet_par_site"), "site_origine")
    return null_safe_join(null_safe_join(table, per_discharge, "rejet", "left"),
                          per_origin, "site_origine", "left")


def flag_to_check(table: DataFrame) -> DataFrame:
    """Mark plants with more than one discharge."""
    several = (site_type("site_origine") == TYPE_PLANT) & (F.col("nb_rejet_par_site") > 1)
    return table.withColumn("a_verifier", F.when(several, TO_CHECK))


def _point_names(nodes: DataFrame) -> DataFrame:
    return nodes.select(F.col("identifiant").alias("pt_AS"), F.col("Nom_Sitou").alias("nom_pt_AS"))


def _paired(table: DataFrame) -> DataFrame:
    """Rows that have their point: those whose origin is no plant, or missing."""
    return table.where(~F.coalesce(site_type("site_origine") == TYPE_PLANT, F.lit(False)))


def _with_points(plants: DataFrame, plant_points: DataFrame, *further: str) -> DataFrame:
    """Rows of plants with the points of each; the rows of one plant are dealt over ``PARTS`` keys, each with its points.

    Few bytes come in and very many rows go out, so both sides are dealt over all shuffle partitions:
    by size the adaptive planner would leave a handful of uneven tasks. The id of a plant is never missing.
    """
    points = (points_on_discharge(plant_points).select("site_origine", "pt_AS", "nom_pt_AS", *further)
              .withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1)))))
    dealt = plants.withColumn("_part", F.pmod(F.xxhash64("rejet"), F.lit(PARTS)).cast("int"))
    keys, n = ["site_origine", "_part"], int(plants.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (dealt.repartition(n, *keys).join(points.repartition(n, *keys).hint("merge"), keys, "left")
            .drop("_part"))


def _points_of_plants(plants: DataFrame, plant_points: DataFrame) -> DataFrame:
    """Different (site_origine, pt_AS) of the plants; a plant without point has a missing one."""
    points = points_on_discharge(plant_points).select("site_origine", "pt_AS").distinct()
    return null_safe_join(plants.select("site_origine").distinct(), points, "site_origine", "left", grows=True)


def _points_per_discharge(plants: DataFrame, points: DataFrame, paired: DataFrame) -> DataFrame:
    """Number of different points per discharge, from its plants and its other pairings.

    Discharges of the same plants have the same points there: these are counted once per
    set of plants, and a discharge adds its other points that none of its plants has.
    """
    sets = plants.groupBy("rejet").agg(F.array_sort(F.collect_set("site_origine")).alias("_plants"))
    reached = (null_safe_join(sets.select("_plants").distinct().select("_plants", F.explode("_plants").alias("site_origine")),
                              points, "site_origine", grows=True).select("_plants", "pt_AS").distinct())
    counts = reached.groupBy("_plants").agg(F.count("*").alias("_n"))
    own = null_safe_join(paired.select("rejet", "pt_AS").distinct(), sets, "rejet", "left", grows=True)
    further = null_safe_join(own, reached, ["_plants", "pt_AS"], "left_anti", grows=True)
    return (stack(null_safe_join(sets, counts, "_plants", grows=True).select("rejet", "_n"),
                  further.groupBy("rejet").agg(F.count("*").alias("_n")))
            .groupBy("rejet").agg(F.sum("_n").alias("nb_pt_AS_par_rejet")))
