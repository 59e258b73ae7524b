"""Collocations of two to five words, counted on a weighted de Bruijn graph.

Every word position gives one gram: the five words that start there, an edge from its
first four words to its last four; near the end of a piece fewer words, the correction
for what ends there. Equal grams are summed before and after one shuffle. All shorter
counts follow from that: the flow of a node is what its edges carry plus what ends in it,
and a phrase of k words occurs as often as grams begin with it. Where an edge, the node
after it and that node's next edge carry the same weight, nothing begins, ends or
branches in between: such unary paths are compacted, and the shorter counts taken from
whole paths.

A gram that is too rare for a candidate need not be counted. A first pass counts grams of
one to five words in hashed cells, saturated at the least frequency; cells that stay below
it hold rare grams only. The second pass stops a gram where its cell says rare, as if the
piece ended there. Cells only save work: a gram that is frequent keeps all its occurrences
whatever else falls into its cell, and only exact counts reach the result. The table of
cells grows with the text up to a fixed size; beyond that fewer rare grams are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from riverload.stages import Stages

LONGEST = 5
#: Least occurrences of a candidate, and results of a language.
LEAST, KEEP = 100, 2000
#: Cells: at least and at most (powers of two), and bytes of text for one.
CELLS, BYTES = (16, 25), 32
#: Cells that travel together, and words that a task counts together.
BLOCK, TOGETHER = 1 << 16, 1_500_000
#: Different grams that a task holds at most.
HELD = 1_000_000
#: Bytes of text for a task, where there are enough for all cores: what a task sends, its cells and the grams that are
#: common everywhere, hardly grows with what it reads.
READ = 64_000_000
#: Most languages whose word numbers are broadcast.
LANGUAGES = 10_000
#: Edges in one row of a compacted path; a longer path takes several rows.
SEGMENT = 64
UNKNOWN = "und"

_PLAIN = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\x0b\x0c\x0d\t", b"abcdefghijklmnopqrstuvwxyz" + b"\n" * 9 + b" ")
_GRAMS = pa.schema([("lang", pa.string()), ("size", pa.int32()), ("gram", pa.string()), ("weight", pa.int64())])
_CELLS = pa.schema([("block", pa.int32()), ("counts", pa.binary())])


class _Numbers(dict):
    """Names to numbers in order of appearance."""

    def __missing__(self, name: bytes) -> int:
        self[name] = number = len(self)
        return number


@dataclass
class Words:
    """The words of several texts one after another."""

    vocabulary: list[bytes]
    ids: np.ndarray
    left: np.ndarray  # words from each position to the end of its piece, itself included
    langs: list[str]
    lang: np.ndarray

    def hashes(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For one to ``LONGEST`` words: positions with so many words left, and hashes of language and gram."""
        word = np.array([xxhash.xxh64_intdigest(w) for w in self.vocabulary], np.uint64)[self.ids]
        at = np.arange(len(self.ids))
        mixed = np.array([xxhash.xxh64_intdigest(x) for x in self.langs], np.uint64)[self.lang]
        for k in range(LONGEST):
            longer = self.left[at] > k
            at, mixed = at[longer], mixed[longer]
            mixed = (mixed ^ word[at + k]) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(29)
            yield at, mixed * np.uint64(0xBF58476D1CE4E5B9)


def read_words(batches: Iterator[pa.RecordBatch]) -> Iterator[Words]:
    """Words of ``lang, text`` rows, some texts at a time."""
    numbers, langs, found, ends, lang, lengths = _Numbers(), _Numbers(), [], [], [], []

    def made() -> Words:
        size = np.diff(np.array(ends, np.int64), prepend=0)
        left = np.repeat(np.array(ends, np.int64), size) - np.arange(len(found))
        ids = np.fromiter(map(numbers.__getitem__, found), np.int32, len(found))
        return Words(list(numbers), ids, left, list(langs), np.repeat(np.array(lang, np.int32), lengths))

    for batch in batches:
        for name, text in zip(batch.column(0), batch.column(1).cast(pa.binary())):
            before = len(found)
            for piece in (text.as_py() or b"").translate(_PLAIN).split(b"\n"):
                words = piece.split()
                if words:
                    found += words
                    ends.append(len(found))
            lang.append(langs[name.as_py()])
            lengths.append(len(found) - before)
            if len(found) >= TOGETHER:
                yield made()
                numbers, langs, found, ends, lang, lengths = _Numbers(), _Numbers(), [], [], [], []
    if found:
        yield made()


def frequent_cells(texts: DataFrame, least: int, power: int) -> np.ndarray:
    """For each of 2**power cells whether its grams together reach ``least``."""
    cells = 1 << power
    block = min(BLOCK, cells)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, any_words = np.zeros(cells, np.int32), False
        for words in read_words(batches):
            any_words = True
            for _, mixed in words.hashes():
                np.add.at(table, (mixed >> np.uint64(64 - power)).astype(np.intp), 1)
            np.minimum(table, least, out=table)
        if any_words:
            parts = table.astype(np.min_scalar_type(least)).reshape(-1, block)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.arange(len(parts), dtype=np.int32)),
                pa.array([pa.compress(p, "zstd", asbytes=True) for p in parts], pa.binary())], schema=_CELLS)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind, sums = np.dtype(np.min_scalar_type(least)), {}
        for batch in batches:
            for number, counts in zip(*(c.to_pylist() for c in batch.columns)):
                part = np.frombuffer(pa.decompress(counts, block * kind.itemsize, "zstd"), kind).astype(np.int64)
                sums[number] = np.minimum(part + sums[number], least).astype(kind) if number in sums else part.astype(kind)
        yield pa.RecordBatch.from_arrays([
            pa.array(list(sums), pa.int32()), pa.array([np.packbits(x >= least).tobytes() for x in sums.values()], pa.binary())], schema=_CELLS)

    kind = "block int, counts binary"
    frequent = np.zeros((cells // block, block // 8), np.uint8)
    for row in texts.mapInArrow(count, kind).repartition("block").mapInArrow(add, kind).collect():
        frequent[row["block"]] = np.frombuffer(row["counts"], np.uint8)
    return frequent.reshape(-1)


def _summed(words: Words, frequent: np.ndarray, power: int) -> Iterator[pa.RecordBatch]:
    """Grams of the positions, each as long as its cells allow, with their numbers; and the number of all words."""
    sizes = np.zeros(len(words.ids), np.int64)
    for k, (at, mixed) in enumerate(words.hashes()):
        at, cell = (x[sizes[at] == k] for x in (at, mixed >> np.uint64(64 - power)))
        sizes[at] += frequent[cell >> np.uint64(3)] >> (np.uint8(7) - (cell & np.uint64(7)).astype(np.uint8)) & 1
    at = np.flatnonzero(sizes)
    ids = np.append(words.ids + 1, np.zeros(LONGEST, np.int32)).astype(np.uint64)  # 0 stands for no word
    columns = [words.lang[at].astype(np.uint64)] + [np.where(sizes[at] > k, ids[at + k], 0) for k in range(LONGEST)]
    bits = max(len(words.vocabulary), len(words.langs)).bit_length()
    packed = []
    for i in range(0, len(columns), 63 // bits):
        key = np.zeros(len(at), np.uint64)
        for column in columns[i:i + 63 // bits]:
            key = key << np.uint64(bits) | column
        packed.append(key)
    order = np.lexsort(packed)
    new = np.ones(len(at), bool)
    if len(at):
        new[1:] = np.any([np.diff(x[order]) != 0 for x in packed], axis=0)
    first = np.flatnonzero(new)
    weights, chosen = np.diff(np.append(first, len(at))), order[first]
    vocabulary = pa.array([None, *words.vocabulary], pa.binary())
    parts = [vocabulary.take(pa.array(c[chosen].astype(np.int64))) for c in columns[1:]]
    grams = pc.binary_join_element_wise(*parts, pa.scalar(b" ", pa.binary()), null_handling="skip")
    langs = pa.array(words.langs)
    yield pa.RecordBatch.from_arrays([
        langs.take(pa.array(words.lang[at][chosen].astype(np.int64))), pa.array(sizes[at][chosen].astype(np.int32)),
        grams.cast(pa.string()), pa.array(weights)], schema=_GRAMS)
    totals = np.bincount(words.lang, minlength=len(langs))
    yield pa.RecordBatch.from_arrays([
        langs, pa.array(np.zeros(len(langs), np.int32)), pa.array([""] * len(langs)), pa.array(totals.astype(np.int64))], schema=_GRAMS)


def _merged(batches: list[pa.RecordBatch]) -> list[pa.RecordBatch]:
    """Equal grams as one row."""
    merged = pa.Table.from_batches(batches, _GRAMS).group_by(_GRAMS.names[:3]).aggregate([("weight", "sum")])
    return pa.Table.from_arrays(merged.select([*_GRAMS.names[:3], "weight_sum"]).columns, schema=_GRAMS).to_batches(max_chunksize=100_000)


def count_grams(texts: DataFrame, least: int = LEAST) -> DataFrame:
    """``lang, size, gram, weight``: longest grams by where they start; size 0 has the number of all words.

    ``texts``: ``lang, text``, no null language. Grams of ``LONGEST`` words are the
    edges, shorter ones what ends in a node.
    """
    spark = texts.sparkSession
    chars = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    power = min(max((chars // BYTES).bit_length(), CELLS[0]), CELLS[1])
    texts = texts.coalesce(max(chars // READ, spark.sparkContext.defaultParallelism))
    frequent = spark.sparkContext.broadcast(frequent_cells(texts, least, power))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for words in read_words(batches):
            held += _summed(words, frequent.value, power)
            if sum(map(len, held)) >= HELD:
                held = _merged(held)
                if sum(map(len, held)) >= HELD // 2:
                    yield from held
                    held = []
        yield from _merged(held)

    return (texts.mapInArrow(count, "lang string, size int, gram string, weight long")
            .groupBy("lang", "size", "gram").agg(F.sum("weight").alias("weight")))


def node_flow(grams: DataFrame) -> DataFrame:
    """``lang, gram, a`` of the nodes, phrases of one word less than an edge: what their edges carry, plus what ends in them."""
    start = F.when(F.col("size") == LONGEST, F.substring_index("gram", " ", LONGEST - 1)).otherwise(F.col("gram"))
    return (grams.where(F.col("size") >= LONGEST - 1)
            .groupBy("lang", start.alias("gram")).agg(F.sum("weight").alias("a")))


def compact_paths(edges: DataFrame, nodes: DataFrame, stages: Stages) -> DataFrame:
    """``lang, words, edges, weight``: unary paths of equal weight, at most ``SEGMENT`` edges a row.

    ``edges``: ``lang, gram, weight``, ``nodes`` as of ``node_flow``. An edge follows
    another without a branch if both carry all the flow of the node between. Heads are
    found by pointer jumping, so rounds grow with the logarithm of the longest path.
    There is no cycle: whoever walks one ends in it, so one of its nodes carries more
    than its edge.
    """
    last = F.substring_index("gram", " ", -(LONGEST - 1))
    first = F.substring_index("gram", " ", LONGEST - 1)
    into = edges.select("lang", F.col("gram").alias("before"), last.alias("node"), F.col("weight").alias("in"))
    out = edges.select("lang", "gram", first.alias("node"), F.col("weight").alias("out"))
    through = nodes.select("lang", F.col("gram").alias("node"), "a")
    links = (out.join(through, ["lang", "node"]).where("out = a").join(into, ["lang", "node"]).where("in = a")
             .select("lang", "gram", "before"))
    placed, more = _jumped(stages, "paths-0", edges.join(links, ["lang", "gram"], "left").select(
        "lang", "gram", "weight", F.coalesce("before", "gram").alias("head"), F.when(F.col("before").isNull(), 0).otherwise(1).alias("steps"),
        F.col("before").isNull().alias("done")))
    turn = 0
    while more:
        turn += 1
        ahead = placed.select("lang", F.col("gram").alias("head"), F.col("head").alias("over"), F.col("steps").alias("further"), F.col("done").alias("there"))
        following, more = _jumped(stages, f"paths-{turn}", placed.join(ahead, ["lang", "head"]).select(
            "lang", "gram", "weight", F.col("over").alias("head"), (F.col("steps") + F.col("further")).alias("steps"),
            (F.col("done") | F.col("there")).alias("done")))
        stages.drop(f"paths-{turn - 1}")
        placed = following
    segment = F.floor(F.col("steps") / SEGMENT).alias("segment")
    row = F.array_sort(F.collect_list(F.struct("steps", "gram")))
    return (placed.groupBy("lang", "head", segment, "weight").agg(row.alias("row"))
            .select("lang", F.concat(F.split(F.col("row")[0]["gram"], " "), F.transform(
                F.slice("row", 2, SEGMENT), lambda x: F.substring_index(x["gram"], " ", -1))).alias("words"),
                F.size("row").alias("edges"), "weight"))


def _jumped(stages: Stages, name: str, placed: DataFrame) -> tuple[DataFrame, bool]:
    """Edges with pointers towards their heads as a stage; whether some are still on the way."""
    seen = Observation()
    written = stages.write(placed.observe(seen, F.count_if(~F.col("done")).alias("open")), name)
    return written, seen.get["open"] > 0


def shorter_counts(paths: DataFrame, ends: DataFrame, nodes: DataFrame, least: int) -> DataFrame:
    """``lang, size, gram, a`` of all phrases shorter than an edge that occur ``least`` times.

    A phrase occurs where it begins an edge of a path, or one of ``ends``, the grams shorter than an edge.
    """
    by_path = paths.select("lang", F.explode(F.sequence(F.lit(1), "edges")).alias("at"), "words", "weight").select(
        "lang", F.slice("words", F.col("at"), LONGEST - 2).alias("words"), "weight")
    at_end = ends.select("lang", F.slice(F.split("gram", " "), 1, LONGEST - 2).alias("words"), "weight")
    begun = by_path.union(at_end)
    short = (begun.select("lang", F.explode(F.sequence(F.lit(1), F.size("words"))).alias("size"), "words", "weight")
             .groupBy("lang", "size", F.array_join(F.slice("words", F.lit(1), F.col("size")), " ").alias("gram"))
             .agg(F.sum("weight").alias("a")).where(F.col("a") >= least))
    return short.union(nodes.where(F.col("a") >= least).select("lang", F.lit(LONGEST - 1).alias("size"), "gram", "a"))


def score_phrases(counts: DataFrame, totals: DataFrame) -> DataFrame:
    """``lang, phrase, a, l, r, n, score`` of the phrases that no longer one contains as often.

    ``counts``: ``lang, size, gram, a`` of all frequent phrases and words; ``totals``:
    ``lang, n``. A longer phrase that contains a phrase as often has one in between that
    is longer by one word, so those are enough to look at.
    """
    phrases = counts.where("size > 1")
    inner = phrases.where("size > 2").select("lang", "a", F.explode(F.array(
        _words(F.col("size") - 1), _words(1 - F.col("size")))).alias("gram"))
    whole = inner.groupBy("lang", "gram").agg(F.max("a").alias("most"))
    own = (phrases.join(whole, ["lang", "gram"], "left")
           .where(F.col("most").isNull() | (F.col("most") < F.col("a"))).select("lang", "size", "gram", "a"))
    cuts = own.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1))).select(
        "lang", "gram", "a", "k", _words(F.col("k")).alias("first"),
        _words(F.col("k") - F.col("size")).alias("rest"))
    parts = counts.where(F.col("size") < LONGEST)
    scored = (cuts.join(parts.select("lang", F.col("gram").alias("first"), F.col("a").alias("l")), ["lang", "first"])
              .join(parts.select("lang", F.col("gram").alias("rest"), F.col("a").alias("r")), ["lang", "rest"])
              .join(totals, "lang")
              .withColumn("score", F.expr(
                  "(1000BD * cast(a AS decimal(18)) * cast(n AS decimal(18))) div (cast(l AS decimal(18)) * cast(r AS decimal(18)))")))
    best = F.min(F.struct("score", "k", "l", "r"))
    return (scored.groupBy("lang", "gram", "a", "n").agg(best.alias("cut"))
            .select("lang", F.col("gram").alias("phrase"), "a", "cut.l", "cut.r", "n", "cut.score"))


def _words(n: Column) -> Column:
    """The first ``n`` words of the gram, the last ones for a negative ``n``."""
    return F.call_function("substring_index", F.col("gram"), F.lit(" "), n)


def collocations(docs: DataFrame, least: int = LEAST, keep: int = KEEP) -> DataFrame:
    """The best phrases of every language: ``lang, rank, phrase, a, l, r, n, score``.

    ``docs``: ``lang, text``. A missing text has no words, a missing language is
    ``und``; repeated rows count as often as they stand. Texts of any length are read
    whole. Without phrases of ``least`` occurrences there are no rows. Ranks follow
    score, then ``a`` (both falling), then the phrase's bytes.
    """
    stages = Stages(docs.sparkSession, "collocations")
    texts = docs.select(F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"), "text")
    grams = stages.write(count_grams(texts, least), "grams")
    nodes = stages.write(node_flow(grams), "nodes")
    edges = grams.where(F.col("size") == LONGEST)
    frequent = edges.where(F.col("weight") >= least).select("lang", "gram", "weight")
    paths = compact_paths(frequent, nodes, stages)
    rare = edges.where(F.col("weight") < least).select("lang", F.split("gram", " ").alias("words"), F.lit(1).alias("edges"), "weight")
    ends = grams.where(F.col("size").between(1, LONGEST - 1))
    counts = stages.write(
        shorter_counts(paths.union(rare), ends, nodes, least)
        .union(frequent.select("lang", F.lit(LONGEST).alias("size"), "gram", F.col("weight").alias("a"))), "counts")
    totals = grams.where("size = 0").select("lang", F.col("weight").alias("n"))
    if totals.count() <= LANGUAGES:  # else the join goes by language, and a large one waits for its split
        totals = F.broadcast(totals)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (score_phrases(counts, totals).withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= keep)
            .select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))
