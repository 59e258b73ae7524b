"""Links and sites to the correspondence table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from riverload.operators import monitoring, network
from riverload.operators.cleaning import prepare_links, prepare_nodes
from riverload.stages import Stages


def origins_of_discharges(
    nodes: DataFrame, offices: DataFrame, links: DataFrame, rank: str = "passes"
) -> DataFrame:
    """Every discharge point with its origins, from prepared nodes, offices and links."""
    seeds = network.discharge_points(nodes)
    walk = network.upstream_walk(nodes, links, seeds)
    ranked = network.origin_rank(walk, rank)
    # All ranks of a discharge point are equal with "passes": nothing to prune.
    kept = network.prune_farthest(ranked) if rank == "hops" else ranked
    return network.enrich_origins(seeds, network.origin_table(kept), nodes, offices)


def correspondence_table(
    sites: DataFrame, links: DataFrame, plant_points: DataFrame, rank: str = "passes"
) -> DataFrame:
    """The full correspondence table with counts and check mark."""
    return monitoring.with_plant_points(counted_origins(sites, links, plant_points, rank), plant_points)


def counted_origins(
    sites: DataFrame, links: DataFrame, plant_points: DataFrame, rank: str = "passes"
) -> DataFrame:
    """The correspondence table, written once, with plant origins still to be paired.

    A plant pairs each of its discharges with each of its points: receiving waters, counts,
    check mark and what a caller chooses come before, so that the pairs are made last and
    are neither written nor exchanged.
    """
    table = monitoring.correspondence_counts(received_origins(sites, links, rank), plant_points)
    return Stages(sites.sparkSession, "correspondence").write(monitoring.flag_to_check(table), "counted")


def received_origins(sites: DataFrame, links: DataFrame, rank: str = "passes") -> DataFrame:
    """All pairings but those of the plants, which have one row per origin, with their receiving waters.

    Nodes and links are used in every step, the origins feed four pairings and the
    pairings four aggregates and joins, so all of them are written once.
    """
    stages = Stages(sites.sparkSession, "correspondence")
    nodes, offices = prepare_nodes(sites)
    nodes = stages.write(nodes, "nodes")
    clean_links = stages.write(prepare_links(links), "links")
    origins = stages.write(origins_of_discharges(nodes, offices, clean_links, rank), "origins")
    return stages.write(monitoring.correspondence(
        monitoring.plant_origins(origins),
        monitoring.monitoring_sewer(origins, clean_links, nodes),
        monitoring.monitoring_industry(origins, clean_links, nodes),
        monitoring.leftover_origins(origins), clean_links, nodes), "pairings")
