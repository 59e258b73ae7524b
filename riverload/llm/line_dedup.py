"""Removal of lines that many sites share.

For every distinct line a HyperLogLog sketch of the sites it stands on is merged
by aggregation, combined before the shuffle. Lines whose estimate is near the
threshold get an exact distinct count; the others are decided by the sketch.

Lines travel as two 64-bit hashes, and only the lines to remove come back to the
documents. On request, a document that consists of shared lines for its greater part
keeps them: it is a copy of other documents rather than a page with boilerplate around
it, and removing its lines from all copies would lose the text where finding copies is
the work of near-duplicate detection.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riverload.stages import Stages

#: Standard errors around the threshold within which lines are counted exactly.
ERRORS = 4


def line_hashes(text: Column) -> Column:
    """Array of (``h1``, ``h2``, ``chars``), one per line; trimmed of spaces."""
    return F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: F.struct(
        F.xxhash64(F.trim(x)).alias("h1"), F.xxhash64(F.lit(1), F.trim(x)).alias("h2"), F.length(F.trim(x)).alias("chars")))


def shared_lines(lines: DataFrame, min_sites: int, lg_k: int = 12) -> DataFrame:
    """``h1, h2`` of the lines that stand on at least ``min_sites`` sites.

    ``lines``: ``h1, h2, site``; missing sites do not count.
    """
    stages = Stages(lines.sparkSession, "line-sites")
    band = max(1, math.ceil(ERRORS * 1.04 / math.sqrt(2**lg_k) * min_sites))
    sketched = lines.groupBy("h1", "h2").agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", lg_k)).alias("sites"))
    likely = stages.write(sketched.where(F.col("sites") >= min_sites - band), "likely")
    near = likely.where(F.col("sites") <= min_sites + band).select("h1", "h2")
    exact = (lines.where(F.col("site").isNotNull()).join(near, ["h1", "h2"], "left_semi")
             .select("h1", "h2", "site").distinct()
             .groupBy("h1", "h2").count().where(F.col("count") >= min_sites))
    sure = likely.where(F.col("sites") > min_sites + band)
    return stages.write(sure.select("h1", "h2").union(exact.select("h1", "h2")), "shared")


def drop_shared_lines(docs: DataFrame, min_sites: int = 10, min_chars: int = 1, copy_share: float | None = None, lg_k: int = 12,
                      site: str = "source", text: str = "text") -> DataFrame:
    """The documents without the lines that at least ``min_sites`` sites share.

    All columns stay, ``text`` is replaced, and ``shared_lines`` (of the document),
    ``removed_lines`` and ``removed_chars`` are added, replacing columns of these
    names. Lines are compared without leading and trailing spaces; blank lines are none.

    Two exceptions can be asked for. Lines shorter than ``min_chars`` characters stay:
    such scraps recur by chance. With ``copy_share``, nothing is removed from a document
    of whose characters shared lines hold that share or more: it is a copy of others.

    One row per row: repeated rows stay and get equal results. A missing text stays
    missing, an empty one empty; a document without site keeps the lines it has
    alone and loses those that others share. An empty table stays empty.
    """
    stages = Stages(docs.sparkSession, "line-dedup")
    key = F.xxhash64(text, F.col("doc_id"))
    listed = docs.select(F.col("doc_id"), key.alias("row_key"), F.col(site).cast("string").alias("site"), F.posexplode(line_hashes(F.col(text))).alias("pos", "line"))
    lines = stages.write(
        listed.where(F.col("line.chars") >= max(1, min_chars)).select("doc_id", "row_key", "site", "pos", "line.h1", "line.h2", "line.chars"), "lines")
    shared = shared_lines(lines.select("h1", "h2", "site"), min_sites, lg_k)
    found = (lines.join(shared, ["h1", "h2"], "left_semi")
             .groupBy("row_key", F.col("doc_id").alias("row_id")).agg(F.collect_set(F.struct("pos", "chars")).alias("found"))
             .select("row_key", "row_id", F.transform("found", lambda x: x["pos"]).alias("places"),
                     F.aggregate("found", F.lit(0).cast("long"), lambda n, x: n + x["chars"]).alias("chars")))
    added = ("shared_lines", "removed_lines", "removed_chars")
    kept = docs.drop(*added)
    joined = kept.withColumn("__line_dedup_key", key).join(
        found.select(F.struct("*").alias("__line_dedup_found")),
        (F.col("__line_dedup_key") == F.col("__line_dedup_found.row_key")) & F.col("doc_id").eqNullSafe(F.col("__line_dedup_found.row_id")), "left")
    split = F.split(F.col(text), "\n")
    total = F.aggregate(split, F.lit(0).cast("long"), lambda n, x: n + F.length(F.trim(x)))
    boiler = F.col("__line_dedup_found").isNotNull()
    if copy_share is not None:
        boiler &= F.col("__line_dedup_found.chars") < copy_share * total
    rest = F.array_except(F.sequence(F.lit(0), F.size(split) - 1), F.col("__line_dedup_found.places"))
    # The outer transform binds the split lines to a variable, so that they are split once and not for each line.
    cleaned = F.transform(F.array(split), lambda s: F.array_join(F.transform(rest, lambda i: F.element_at(s, i + 1)), "\n"))[0]
    n_shared = F.coalesce(F.size("__line_dedup_found.places"), F.lit(0)).cast("long")
    n_shared = F.when(F.col("__line_dedup_found").isNull(), F.lit(0).cast("long")).otherwise(n_shared)
    return joined.select(
        *[F.when(boiler, cleaned).otherwise(F.col(text)).alias(text) if c == text else F.col(c) for c in kept.columns],
        n_shared.alias("shared_lines"), F.when(boiler, n_shared).otherwise(0).alias("removed_lines"),
        F.when(boiler, F.col("__line_dedup_found.chars")).otherwise(0).alias("removed_chars"))
