"""Near duplicates by SimHash fingerprints and multi-index hashing.

A fingerprint of 64 bits falls into segments. Two fingerprints at most ``bits``
apart differ by at most ``bits // segments`` in one of them, so it is enough to
enumerate that small Hamming ball around each segment's value, fetch the
fingerprints with such a value by an equi-join, and compare in full. With two
segments of 32 bits a table of a billion fingerprints holds less than one per
value.

Copies share a fingerprint and take part once, as a class. Of two values that
differ, only the one that has the lowest differing bit set looks for the other,
which finds every pair once a segment and halves the look-ups. A fingerprint can
have at most as many links as its Hamming ball has members (43,744 for 3 bits),
however many documents there are.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riverload.llm.components import components
from riverload.stages import Stages

BITS = 64
SEED = 42
#: Hashes whose bits are counted together.
BLOCK = 1 << 16


def simhash(text: str | None, words: int) -> int:
    """Signed 64-bit fingerprint over shingles of so many words.

    A-Z are lower-cased, words lie between ASCII white space; with fewer words the
    whole sequence is the shingle, without words the fingerprint is zero. A bit is
    set if more than half of the shingles' XXH64 have it.
    """
    import xxhash

    found = (text or "").encode("utf-8", "replace").lower().split()
    if not found:
        return 0
    digest, count = xxhash.xxh64_intdigest, max(1, len(found) - words + 1)
    shingles = map(b" ".join, zip(*(itertools.islice(found, i, None) for i in range(words)))) if len(found) >= words else iter([b" ".join(found)])
    ones = np.zeros(BITS, np.int64)
    for start in range(0, count, BLOCK):
        size = min(BLOCK, count - start)
        hashes = np.fromiter((digest(s, SEED) for s in itertools.islice(shingles, size)), np.uint64, size)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > count, bitorder="little").view(np.int64)[0])


def fingerprint(text: str | Column, words: int = 3) -> Column:
    """Column with the fingerprint of the whole text; a missing text is an empty one."""
    def hashed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([simhash(t.as_py(), words) for t in batch], pa.int64())

    return F.arrow_udf(hashed, "long")(text)


def links(prints: DataFrame, bits: int = 3, segments: int = 2) -> DataFrame:
    """Pairs ``a, b`` of distinct fingerprints (``print``) at most ``bits`` apart; a pair may repeat."""
    width = BITS // segments
    if BITS % segments or width > 56:
        raise ValueError("segments must divide 64 evenly, two at least")
    masks = [sum(1 << b for b in chosen) for r in range(bits // segments + 1) for chosen in itertools.combinations(range(width), r)]

    def value(i: int) -> Column:
        return F.shiftrightunsigned("print", i * width).bitwiseAND(F.lit((1 << width) - 1))

    parts = F.explode(F.array(*[F.struct(F.lit(i).alias("segment"), value(i).alias("value")) for i in range(segments)])).alias("part")
    cut = prints.select("print", parts).select("print", "part.*")
    ball = F.array(*[F.struct(F.lit(m).cast("long").alias("mask"), F.lit(m & -m).cast("long").alias("lowest")) for m in masks])
    asking = (cut.select(F.col("print").alias("a"), "segment", "value", F.explode(ball).alias("near"))
              .where((F.col("near.mask") == 0) | (F.col("value").bitwiseAND(F.col("near.lowest")) != 0))
              .select("a", "segment", F.col("value").bitwiseXOR(F.col("near.mask")).alias("value"),
                      (F.col("near.mask") == 0).alias("same")))
    table = cut.select(F.col("print").alias("b"), "segment", "value")
    close = (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= bits) & (~F.col("same") | (F.col("a") < F.col("b")))
    # Spark takes the exploded rows for as many bytes as their fingerprints' file, so both sides are always exchanged.
    return (asking.join(table.hint("merge"), (asking["segment"] == table["segment"]) & (asking["value"] == table["value"]) & close)
            .select("a", "b"))


def near_duplicates(docs: DataFrame, words: int = 3, bits: int = 3, segments: int = 2, id_column: str = "doc_id") -> DataFrame:
    """``doc_id, fingerprint, component_id``, one row per row of ``docs``.

    ``fingerprint`` is the signed number, ``component_id`` the smallest id reachable
    over links, the document's own included. Repeated rows stay; texts that are
    missing, empty or blank have fingerprint zero and are linked like any other;
    missing ids are ignored in looking for the smallest, so a group without any id
    has none. An empty table gives no rows. Other columns are not read.

    The fingerprints are written once; everything after works on distinct ones.
    """
    return _grouped(docs.select(F.col(id_column).alias("doc_id"), fingerprint("text", words).alias("print")), bits, segments).select(
        "doc_id", F.col("print").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, words: int = 3, bits: int = 3, segments: int = 2, id_column: str = "doc_id") -> DataFrame:
    """Of each group of near duplicates one row of ``docs``, with all its columns.

    The one with the smallest id stays, a missing id counting as the largest; rows of
    one group that share this id are told apart by a hash of the text, and of equal
    rows any one stays.
    """
    hashes = [F.xxhash64(F.col(id_column), "text"), F.xxhash64(F.lit(1), F.col(id_column), "text")]
    names = ["hash", "check"]
    printed = docs.select(F.col(id_column).alias("doc_id"), fingerprint("text", words).alias("print"), *[h.alias(n) for h, n in zip(hashes, names)])
    order = F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", *names)
    firsts = (_grouped(printed, bits, segments).groupBy("component").agg(F.min(order).alias("least"))
              .select(*[F.col(f"least.{n}").alias(n) for n in names]))
    # The row travels as one column, whose fields may have any names. The rows lie by
    # these hashes after the join already, so dropping repeats moves nothing.
    rows = docs.select(F.struct("*").alias("row"), *[h.alias(n) for h, n in zip(hashes, names)])
    return rows.join(firsts, names, "left_semi").dropDuplicates(names).select("row.*")


def _grouped(printed: DataFrame, bits: int, segments: int) -> DataFrame:
    """``printed`` (``doc_id, print`` and more) with ``component``, its smallest print, and ``component_id``."""
    stages = Stages(printed.sparkSession, "simhash")
    rows = stages.write(printed, "prints")
    classes = stages.write(rows.groupBy("print").agg(F.min("doc_id").alias("least")), "classes")
    joined = components(links(classes.select("print"), bits, segments), stages)
    labelled = classes.join(joined.withColumnRenamed("node", "print"), "print", "left").select(
        "print", "least", F.coalesce("component", "print").alias("component"))
    smallest = labelled.groupBy("component").agg(F.min("least").alias("component_id"))
    return rows.join(labelled.join(smallest, "component").select("print", "component", "component_id"), "print")
