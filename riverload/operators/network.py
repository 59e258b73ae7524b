"""From every discharge point up the network to the origins of its pollution.

All discharge points walk at the same time, and they share their ways: the walk starts
from the different sites directly upstream of any of them, and the discharge points are
put in front at the end, one link further. The state is one row per (first site, reached
site), laid out by these keys; a pass expands only the sites found by the pass before.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from riverload.fixed_values import STOP_TYPES, TYPE_DISCHARGE
from riverload.functions.joins import members, null_safe_join
from riverload.stages import KeyedTable, Stages


def discharge_points(nodes: DataFrame, site_type: str = TYPE_DISCHARGE) -> DataFrame:
    """The sites of one type: the starting points of the walk."""
    return (nodes.where(F.col("No_Type_Sitou") == site_type)
            .distinct().select("identifiant", "Nom_Sitou"))


def upstream_walk(
    nodes: DataFrame, links: DataFrame, seeds: DataFrame,
    stop_types: Iterable[str] = STOP_TYPES,
) -> DataFrame:
    """Sites upstream of each seed: ``seed, identifiant, No_Type_Sitou, depth``.

    ``depth`` is the smallest number of links to the seed. Stop types are
    reached but not passed; an upstream id that is no node is ignored; a cycle
    ends because a site is kept once per closure, however long the way.
    """
    stages = Stages(nodes.sparkSession, "walk")
    listed = nodes.select(
        "identifiant", "No_Type_Sitou", _key("identifiant", "No_Type_Sitou").alias("site"),
        (~F.coalesce(F.col("No_Type_Sitou").isin(*stop_types), F.lit(False))).alias("passable")).distinct()
    sites, rows = _counted(stages, listed, "sites")
    steps = stages.keyed("steps", ["site"], "site string, up string, passable boolean", rows)
    steps.add(_steps(sites, links).repartition(steps.buckets, *steps.keys).distinct())
    known = members(sites.where(F.col("identifiant").isNotNull()), "identifiant", seeds, "identifiant")
    start = stages.write(known.select(F.col("identifiant").alias("seed"), "site"), "seeds")
    firsts, rows = _counted(
        stages, start.join(steps.read(), "site").select("seed", F.col("up").alias("first"), "passable").distinct(), "firsts")
    closures = _closures(stages, firsts, steps, rows)
    reached = (firsts.select("seed", "first").join(closures, "first")
               .select("seed", "site", (F.col("depth") + 1).alias("depth"))
               .union(start.select("seed", "site", F.lit(0))))
    shortest = reached.groupBy("seed", "site").agg(F.min("depth").alias("depth"))
    # The key of a site says what it is, so the reached sites need not meet the nodes again.
    result = stages.write(shortest.select("seed", *_unkey("identifiant", "No_Type_Sitou"), "depth"), "walk")
    steps.drop()
    stages.drop("sites", "seeds", "firsts", "closures")
    return result


def origin_rank(
    walk: DataFrame, rank: str = "passes",
    stop_types: Iterable[str] = STOP_TYPES, seed_type: str = TYPE_DISCHARGE,
) -> DataFrame:
    """Rank of the candidate origins of each seed.

    ``passes``: number of passes until the seed's set of sites stopped growing,
    the same for all its origins (deepest depth + 1). ``hops``: distance of the
    origin itself.
    """
    candidates = walk.where(
        F.col("No_Type_Sitou").isin(seed_type, *stop_types) & (F.col("depth") > 0))
    if rank == "hops":
        return candidates.withColumn("rang", F.col("depth"))
    if rank != "passes":
        raise ValueError(f"rank must be 'passes' or 'hops', not {rank!r}")
    # Aggregated before the shuffle, where a window would gather a whole seed.
    passes = walk.groupBy("seed").agg((F.max("depth") + 1).alias("rang"))
    return null_safe_join(candidates, passes, "seed")


def prune_farthest(
    ranked: DataFrame, stop_types: Iterable[str] = STOP_TYPES
) -> DataFrame:
    """Drop the farthest candidates of a seed with several origins at different ranks.

    With rank ``passes`` all ranks of a seed are equal and nothing is dropped.
    """
    limits = ranked.groupBy("seed").agg(
        F.max("rang").alias("_far"), F.min("rang").alias("_near"),
        F.count_if(F.col("No_Type_Sitou").isin(*stop_types)).alias("_origins"))
    drop = ((F.col("_origins") > 1) & (F.col("_near") < F.col("_far"))
            & (F.col("rang") == F.col("_far")))
    return (null_safe_join(ranked, limits, "seed")
            .where(~drop).select(*ranked.columns))


def origin_table(ranked: DataFrame, seed_type: str = TYPE_DISCHARGE) -> DataFrame:
    """(rejet, site_origine, rang) without other discharge points."""
    return (ranked.where(F.col("No_Type_Sitou") != seed_type)
            .select(F.col("seed").alias("rejet"), F.col("identifiant").alias("site_origine"), "rang")
            .distinct())


def enrich_origins(
    seeds: DataFrame, origins: DataFrame, nodes: DataFrame, offices: DataFrame
) -> DataFrame:
    """Every discharge point with its origins, names and office; without origin it stays."""
    named = seeds.select(F.col("identifiant").alias("rejet"), F.col("Nom_Sitou").alias("nom_rejet"))
    with_origin = null_safe_join(named, origins, "rejet", "left")
    names = nodes.select(F.col("identifiant").alias("site_origine"),
                         F.col("Nom_Sitou").alias("nom_site_origine"))
    with_name = null_safe_join(with_origin, names, "site_origine", "left")
    with_office = null_safe_join(with_name, offices.select("DT", F.col("identifiant").alias("rejet")),
                                 "rejet", "left")
    return with_office.select("DT", "rang", "site_origine", "nom_site_origine", "rejet", "nom_rejet")


def _key(first: str, second: str) -> Column:
    """Two texts as one key that is never missing: the first behind its length, the second behind ``=``."""
    return F.concat(F.coalesce(F.length(first).cast("string"), F.lit("")), F.lit(":"), F.coalesce(F.col(first), F.lit("")),
                    F.coalesce(F.concat(F.lit("="), F.col(second)), F.lit("")))


def _unkey(first: str, second: str, key: str = "site") -> list[Column]:
    """The two texts of a key made by :func:`_key`."""
    length = F.substring_index(key, ":", 1)
    start, n = F.length(length) + 2, length.try_cast("int")
    text = F.substr(F.col(key), start, n)
    rest = F.substr(F.col(key), start + F.coalesce(n, F.lit(0)))
    return [text.alias(first), F.when(rest != "", F.substr(rest, F.lit(2))).alias(second)]


def _steps(sites: DataFrame, links: DataFrame) -> DataFrame:
    """Links between sites, from downstream to upstream; links that miss a site at an end are left out."""
    pairs = links.select(F.col("No_Sitou").alias("down"), F.col("No_Sitou_Am").alias("up_id"))
    below = null_safe_join(pairs, sites.select(F.col("identifiant").alias("down_id"), "site"), [("down", "down_id")])
    above = sites.select(F.col("identifiant").alias("above_id"), F.col("site").alias("up"), "passable")
    return null_safe_join(below, above, [("up_id", "above_id")]).select("site", "up", "passable")


def _counted(stages: Stages, df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """The written stage and its number of rows, which comes with the write."""
    seen = Observation()
    written = stages.write(df.observe(seen, F.count(F.lit(1)).alias("n")), name)
    return written, seen.get["n"]


def _closures(stages: Stages, firsts: DataFrame, steps: KeyedTable, rows: int | None = None) -> DataFrame:
    """``first, site, depth``: what is upstream of each first site, itself included at depth 0.

    Seeds share what lies above them, so the walk starts once from each site that is
    directly upstream of any seed. A pass joins the sites found last with their links and
    drops those that the closure has already: both tables lie by the keys of these joins,
    so a pass moves its new rows only.
    """
    known = stages.keyed("closures", ["first", "site"], "first string, site string, passable boolean, depth int", rows)
    found = firsts.groupBy("first").agg(F.bool_or("passable").alias("passable")).select(
        "first", F.col("first").alias("site"), "passable")
    depth = 0
    while True:
        # The count of sites to pass comes with the write, without another job.
        passable = Observation()
        known.add(found.withColumn("depth", F.lit(depth)).observe(passable, F.count_if("passable").alias("n")))
        if passable.get["n"] == 0:
            return known.close().drop("passable")
        # Files of other passes are skipped by their range of depths.
        frontier = known.read().where((F.col("depth") == depth) & F.col("passable")).select("first", "site")
        depth += 1
        reached = frontier.join(steps.read(), "site").select("first", F.col("up").alias("site"), "passable").distinct()
        found = reached.join(known.read().select("first", "site"), ["first", "site"], "left_anti")
