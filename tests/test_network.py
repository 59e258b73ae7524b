"""Network walk against a plain search, and edge cases of the correspondence."""

import random

import pytest
from pyspark.sql import functions as F

from riverload.fixed_values import STOP_TYPES
from riverload.operators import cleaning, monitoring, network
from riverload.plans.correspondence import correspondence_table
from riverload.stages import Stages

NODE = "identifiant string, Nom_Sitou string, No_Type_Sitou string"
LINK = "No_Sitou_Am string, No_Sitou string"


def frames(spark, types, links):
    nodes = spark.createDataFrame([(i, f"nom {i}", t) for i, t in types.items()], NODE)
    return nodes, spark.createDataFrame(links, LINK)


def walk(spark, types, links):
    nodes, link = frames(spark, types, links)
    seeds = network.discharge_points(nodes)
    return network.upstream_walk(nodes, link, seeds)


def plain_search(types, links):
    found = {}
    for seed in (i for i, t in types.items() if t == "026"):
        depth, frontier = {seed: 0}, [seed]
        while frontier:
            reached = {u for u, d in links if d in frontier and u in types and u not in depth}
            level = max(depth.values()) + 1
            depth |= dict.fromkeys(reached, level)
            frontier = [u for u in reached if types[u] not in STOP_TYPES]
        found |= {(seed, i): d for i, d in depth.items()}
    return found


def test_random_networks(spark):
    rng = random.Random(7)
    types, links = {}, []
    for g in range(150):
        ids = [f"g{g}n{i}" for i in range(rng.randint(2, 9))]
        types |= {i: rng.choice(["026", "029", "243", "096", "085", "001"]) for i in ids}
        ids += [f"g{g}unknown"]
        links += [(rng.choice(ids), rng.choice(ids)) for _ in range(rng.randint(1, 16))]
    got = {(r.seed, r.identifiant): r.depth for r in walk(spark, types, links).collect()}
    assert got == plain_search(types, links)


def test_cycle_unknown_parent_and_stop(spark):
    types = {"s": "026", "a": "096", "b": "085", "stop": "029", "behind": "012"}
    links = [("a", "s"), ("b", "a"), ("s", "b"), ("ghost", "b"), ("stop", "b"), ("behind", "stop")]
    got = sorted((r.identifiant, r.depth) for r in walk(spark, types, links).collect())
    assert got == [("a", 1), ("b", 2), ("s", 0), ("stop", 3)]


def test_long_way_is_walked_to_its_end(spark):
    types = {"n0": "026"} | {f"n{i}": "096" for i in range(1, 15)}
    links = [(f"n{i + 1}", f"n{i}") for i in range(14)]
    got = {(r.seed, r.identifiant): r.depth for r in walk(spark, types, links).collect()}
    assert got == {("n0", f"n{i}"): i for i in range(15)}


def test_seeds_share_their_ways(spark):
    """Closures are made once for each site directly upstream of a seed, whatever the number of seeds."""
    types = {f"s{i}": "026" for i in range(60)} | {"a": "096", "b": "096", "stop": "029", "top": "012"}
    links = [("a", f"s{i}") for i in range(60)] + [("stop", "s0"), ("b", "a"), ("top", "b"), ("top", "stop"), ("s1", "b"), ("s2", "s1")]
    nodes, link = frames(spark, types, links)
    stages = Stages(spark, "test")
    sites = nodes.select("identifiant", "No_Type_Sitou", network._key("identifiant", "No_Type_Sitou").alias("site"),
                         (~F.col("No_Type_Sitou").isin(*STOP_TYPES)).alias("passable"))
    steps = stages.keyed("steps", ["site"], "site string, up string, passable boolean")
    steps.add(network._steps(sites, link))
    firsts = sites.where("No_Type_Sitou = '026'").select("site").join(steps.read(), "site").select(F.col("up").alias("first"), "passable")
    closures = network._closures(stages, firsts, steps)
    assert closures.select("first").distinct().count() == 3  # a, stop, s2
    assert closures.groupBy("first").count().where("count = 1").count() == 1  # a stop type is not passed
    got = {(r.seed, r.identifiant): r.depth for r in walk(spark, types, links).collect()}
    assert got == plain_search(types, links)


def test_a_pass_moves_its_new_rows_only(spark):
    """Known rows and links lie by the keys of their joins: one exchange each, on the other side."""
    table = Stages(spark, "test").keyed("known", ["first", "site"], "first string, site string, depth int")
    for depth in range(table.MERGE + 2):
        table.add(spark.range(40).select((F.col("id") % 4).cast("string").alias("first"), F.concat(F.lit(f"{depth}-"), "id").alias("site"), F.lit(depth).alias("depth")))
    assert table.version == 1 and table.read().count() == 40 * (table.MERGE + 2)
    new = spark.range(90).select((F.col("id") % 4).cast("string").alias("first"), F.concat(F.lit("3-"), "id").alias("site"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = new.join(table.read(), ["first", "site"], "left_anti")
        assert joined.count() == 50
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("Exchange hashpartitioning") == 1
    scan = table.close()
    assert len(scan.inputFiles()) < 40 * table.MERGE and scan.count() == 40 * (table.MERGE + 2)


def test_chain_of_a_hundred_links(spark):
    types = {"n0": "026"} | {f"n{i}": "096" for i in range(1, 101)}
    nodes, link = frames(spark, types, [(f"n{i + 1}", f"n{i}") for i in range(100)])
    result = network.upstream_walk(nodes, link, network.discharge_points(nodes))
    assert {(r.seed, r.identifiant): r.depth for r in result.collect()} == {("n0", f"n{i}"): i for i in range(101)}
    assert result._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_ranks(spark):
    types = {"s": "026", "near": "029", "a": "096", "far": "243"}
    w = walk(spark, types, [("near", "s"), ("a", "s"), ("far", "a")])
    passes = network.prune_farthest(network.origin_rank(w))
    assert sorted(tuple(r) for r in network.origin_table(passes).collect()) == [
        ("s", "far", 3), ("s", "near", 3)]
    hops = network.prune_farthest(network.origin_rank(w, "hops"))
    assert [tuple(r) for r in network.origin_table(hops).collect()] == [("s", "near", 1)]
    with pytest.raises(ValueError):
        network.origin_rank(w, "other")


def test_equal_ranks_are_kept(spark):
    w = walk(spark, {"s": "026", "x": "029", "y": "243"}, [("x", "s"), ("y", "s")])
    assert network.prune_farthest(network.origin_rank(w, "hops")).count() == 2


SITE = "No_Sitou string, Nom_Sitou string, No_Type_Sitou string, DT string"


def test_correspondence_of_orphans_and_plants(spark):
    sites = spark.createDataFrame([
        ("r1026", "r1", "026", "D"), ("r2026", "r2", "026", "D"), ("r3026", "r3", "026", "D"),
        ("r4026", "r4", "026", "D"), ("p029", "plant", "029", "D"), ("f013", "farm", "013", "D"),
        ("w001", "water", "001", "D")], SITE)
    links = spark.createDataFrame([
        ("p029", "r1026"), ("p029", "r2026"), ("f013", "r1026"), ("f013", "r2026"), ("r1026", "w001")], LINK)
    points = spark.createDataFrame([("p029", "s1", "A4"), ("p029", "s2", "A3")],
                                   "site_origine string, pt_AS string, nom_pt_AS string")
    got = {(r.rejet, r.site_origine): r for r in correspondence_table(sites, links, points).collect()}
    # The farm is lost where the discharge has another type of origin; orphans stay.
    assert set(got) == {("r1026", "p029"), ("r2026", "p029"), ("r3026", None), ("r4026", None)}
    plant = got["r1026", "p029"]
    assert (plant.pt_AS, plant.a_verifier, plant.nom_milieu_recepteur) == ("s1", "oui", "water")
    # Orphans form one group; the missing point counts as one.
    orphan = got["r3026", None]
    assert (orphan.nb_rejet_par_site, orphan.nb_pt_AS_par_site, orphan.nb_pt_AS_par_rejet) == (2, 1, 1)
    assert orphan.a_verifier is None


def test_industry_pairs_multiply(spark):
    nodes = spark.createDataFrame([("a1224", "as1", "224")], NODE)
    links = cleaning.prepare_links(spark.createDataFrame([
        ("c1085", "a1224"), ("c1085", "o1026"), ("c2025", "a1224"), ("c2025", "o1026"),
        ("c3096", "a1224")], LINK).withColumn("Liaison_Sitou-Amont", F.lit("")))
    got = [tuple(r) for r in monitoring.industry_pairs(links, nodes).select(
        "rejet", "pt_AS", "nom_pt_AS").collect()]
    assert got == [("o1026", "a1224", "as1")] * 2


def _fan(spark, discharges, points):
    """Discharges of one plant, some of another one or a sewer too, and points of the plants, one of them shared and one twice."""
    sites = [("p029", "plant", "029", "D"), ("q029", "other", "029", "D"), ("n243", "net", "243", "D"), ("m242", "sewer point", "242", "D"),
             ("w001", "water", "001", "D")] + [(f"r{i}026", f"r{i}", "026", "D") for i in range(discharges)]
    links = [link for i in range(discharges) for link in (
        ("p029", f"r{i}026"), ("q029" if i % 3 == 0 else "ghost", f"r{i}026"), ("n243" if i % 4 == 0 else "ghost", f"r{i}026"),
        ("m242" if i % 8 == 0 else "ghost", f"r{i}026"), (f"r{i}026", "w001"))]
    rows = [("p029", f"s{k}", "A4") for k in range(points)] + [("p029", "s0", "A2"), ("q029", "s1", "A4"), ("q029", "only", "A5"), ("q029", "m242", "A5"), ("p029", "no", "A3")]
    return (spark.createDataFrame(sites, SITE), spark.createDataFrame(links, LINK),
            spark.createDataFrame(rows, "site_origine string, pt_AS string, nom_pt_AS string"))


def test_counts_before_the_plant_pairing_are_those_of_the_table(spark):
    from riverload.plans.correspondence import counted_origins, received_origins
    sites, links, points = _fan(spark, 24, 5)
    table = correspondence_table(sites, links, points).drop("a_verifier")
    counted = [c for c in table.columns if c.startswith("nb_")]
    plain = monitoring.correspondence_counts(table.drop(*counted)).select(*table.columns)
    assert table.count() == 24 * 6 + 8 * 3 + 6
    assert table.exceptAll(plain).count() == plain.exceptAll(table).count() == 0
    assert monitoring.with_plant_points(received_origins(sites, links), points).count() == table.count()
    assert {(r.rejet, r.nb_pt_AS_par_rejet) for r in counted_origins(sites, links, points).collect()} >= {("r1026", 5), ("r3026", 7), ("r0026", 7), ("r8026", 6), ("r4026", 6)}


def test_plant_pairs_are_made_last(spark):
    """Nothing is written or exchanged per pair: only the final join makes as many rows."""
    sites, links, points = _fan(spark, 60, 50)
    from riverload.plans.correspondence import counted_origins
    counted = counted_origins(sites, links, points)
    assert counted.count() == 60 + 20 + 15
    text = correspondence_table(sites, links, points)._jdf.queryExecution().executedPlan().toString()
    above = text[:text.index("SortMergeJoin")]
    assert "Exchange" not in above and text.count("SortMergeJoin") == 1


def test_pairs_of_one_plant_are_made_by_many_tasks(spark):
    """Few bytes go into the plant pairing and many rows come out: its size must not make it one task."""
    table = spark.createDataFrame([("D", 1, "P1029", "n", f"O{i}026", "r") for i in range(200)],
                                  "DT string, rang long, site_origine string, nom_site_origine string, rejet string, nom_rejet string")
    points = spark.createDataFrame([("P1029", f"S{i}", "A2") for i in range(50)], "site_origine string, pt_AS string, nom_pt_AS string")
    found = monitoring.monitoring_plant(table, points).groupBy(F.spark_partition_id().alias("task")).count().collect()
    assert sum(r["count"] for r in found) == 10_000
    assert len(found) > 2 and max(r["count"] for r in found) < 6_000


def test_a_part_has_one_file_a_bucket(spark):
    """However many tasks made its rows; and a table of few rows has few buckets."""
    table = Stages(spark, "test").keyed("few", ["site"], "site string", rows=10)
    table.add(spark.range(0, 4000, 1, 40).select(F.col("id").cast("string").alias("site")))
    assert len(table.read().inputFiles()) == table.buckets
    assert table.read().count() == 4000
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        buckets = [Stages(spark, "test").keyed("t", ["site"], "site string", rows).buckets for rows in (10, 5_000_000, 10**9, None)]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert buckets == [spark.sparkContext.defaultParallelism, 100, 200, 200]


def test_a_key_says_what_it_is(spark):
    texts = [None, "", "a", "=", "a:b", "12:c", "\x1f=d", "é=\U0001f600"]
    rows = [(a, b) for a in texts for b in texts]
    df = spark.createDataFrame(rows, "a string, b string").withColumn("site", network._key("a", "b"))
    assert df.where("site IS NULL").count() == 0 and df.select("site").distinct().count() == len(rows)
    back = df.select("a", "b", *[c.alias(f"{n}2") for c, n in zip(network._unkey("a", "b"), "ab")]).collect()
    assert [(r.a2, r.b2) for r in back] == [(r.a, r.b) for r in back]
