"""Connected components by alternating large and small stars.

Every round is two joins with a minimum that is combined before its shuffle; a
node with very many links is a hot join key that the adaptive join can split. No
node's neighbours are gathered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from riverload.stages import Stages


def components(links: DataFrame, stages: Stages) -> DataFrame:
    """``node, component`` for every node that has a link, ``component`` its smallest reachable node.

    ``links``: ``a, b``, in any direction, repeats and loops allowed, no nulls. No
    links, no rows. Every round's links are written as a stage, the round before
    is deleted.
    """
    now, mark = _write(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), stages, 0)
    before, turn = None, 0
    while mark != before:
        before, turn = mark, turn + 1
        following, mark = _write(_small_star(_large_star(now)), stages, turn)
        stages.drop(f"links-{turn - 1}")
        now = following
    roots = now.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)


def _large_star(links: DataFrame) -> DataFrame:
    """Each node's larger neighbours go to its smallest neighbour (or itself)."""
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    """Each node's smaller neighbours, and the node, go to the smallest of them."""
    least = links.groupBy("a").agg(F.min("b").alias("least"))
    moved = links.join(least, "a").where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.union(least.select("a", F.col("least").alias("b"))).distinct()


def _write(links: DataFrame, stages: Stages, turn: int) -> tuple[DataFrame, tuple[int, int]]:
    """The links as a stage, and their number and checksum, to see when nothing moves."""
    seen = Observation()
    written = stages.write(links.observe(
        seen, F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("sum")), f"links-{turn}")
    return written, (seen.get["n"], seen.get["sum"])
