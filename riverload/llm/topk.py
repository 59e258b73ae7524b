"""Exact top-k by inner product with Fagin's threshold algorithm.

Vectors are packed into blocks of bounded size, and every block of queries meets
every block of candidates in one row of an equi-join on the pair of block numbers,
so that pairs spread evenly over tasks. Within a pair each dimension has its list of
candidates sorted by component. A query reads all lists from its favourable end in
parallel, scores what is new, and stops when the sum of the last read components,
which bounds every candidate not yet seen, is below its kth best score. A task that
has searched other blocks for the same queries starts from the kth score of those.
The best of all blocks are ranked per query, at most k from each block.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riverload.stages import Stages

#: Vectors in a block of queries and of candidates.
QUERIES, CANDIDATES = 1024, 4096
#: Entries read from every list in the first round; how much deeper each next round may go.
FIRST_DEPTH, DEEPER = 16, 4
#: Sums below this are exact in doubles.
EXACT = 2.0**53

_BLOCK = pa.schema([("n", pa.int64()), ("dim", pa.int32()), ("ids", pa.binary()), ("vectors", pa.binary())])


def _packed(vectors: DataFrame, scale: float) -> DataFrame:
    """One row for each partition's vectors, components as floor(scale * x) in long integers."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, rows = [], []
        for batch in batches:
            for i, v in zip(batch.column("id").to_pylist(), batch.column("vector")):
                x = np.asarray(v.values.to_numpy(zero_copy_only=False), np.float64)
                if v.values.null_count or not np.isfinite(x).all():
                    continue
                x = np.floor(scale * x)
                ids.append(i)
                rows.append(np.clip(x, -(2.0**62), 2.0**62).astype(np.int64))
        if ids:
            dim = max(map(len, rows))
            matrix = np.zeros((len(rows), dim), np.int64)
            for k, x in enumerate(rows):
                matrix[k, :len(x)] = x
            yield pa.RecordBatch.from_arrays(
                [pa.array([len(ids)], pa.int64()), pa.array([dim], pa.int32()), pa.array([np.array(ids, np.int64).tobytes()], pa.binary()),
                 pa.array([matrix.tobytes()], pa.binary())], schema=_BLOCK)

    return vectors.mapInArrow(pack, "n long, dim int, ids binary, vectors binary")


def _blocks(vectors: DataFrame, rows: int, scale: float, stages: Stages, name: str) -> tuple[DataFrame, int]:
    """Blocks of about so many vectors with numbers from 0, and how many they are at most."""
    count = max(1, math.ceil(vectors.count() / rows))
    packed = _packed(vectors.repartition(count), scale)
    return stages.write(packed.withColumn("block", F.spark_partition_id()), name), count


class Lists:
    """Candidates with their sorted per-dimension lists."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        lists = np.ascontiguousarray(vectors.T)
        self.order = np.argsort(lists, axis=1, kind="stable")
        self.sorted = np.take_along_axis(lists, self.order, axis=1)

    def _stop(self, query: np.ndarray, up: np.ndarray, down: np.ndarray, depth: int, floor) -> int:
        """Smallest depth from ``depth`` on at which no unread candidate reaches ``floor``."""
        n = len(self.ids)
        if floor is None:
            return n
        low, high = depth, n
        while low < high:
            middle = (low + high) // 2
            bound = (self.sorted[up, n - middle] * query[up]).sum() + (self.sorted[down, middle - 1] * query[down]).sum()
            low, high = (low, middle) if bound < floor else (middle + 1, high)
        return low

    def top(self, own: int, query: np.ndarray, k: int, floor=None) -> tuple[list[int], list, int]:
        """Ids and scores of the best k but the query's own, ties to the smaller id; how many were read.

        With ``floor``, a score that k other candidates reach, only those of at least
        that score. Lists are read in rounds; the bound says how deep the kth score
        found so far still requires, and a round goes no deeper.
        """
        n = len(self.ids)
        up, down = np.flatnonzero(query > 0), np.flatnonzero(query < 0)
        seen = np.full(n, not len(up) and not len(down))
        done = np.zeros(n, bool)
        ids, scores = np.empty(0, np.int64), np.empty(0, self.vectors.dtype)
        read, depth = 0, min(n, FIRST_DEPTH)
        if floor is not None:
            depth = self._stop(query, up, down, 1, floor)
        while True:
            seen[self.order[up, n - depth:n - read]] = True
            seen[self.order[down, read:depth]] = True
            new = np.flatnonzero(seen & ~done)
            done[new] = True
            if len(new) * 4 > n:  # one product over all is faster than gathering the rows read
                found = (self.vectors @ query)[new]
            else:
                found = self.vectors[new] @ query
            keep = self.ids[new] != own
            if floor is not None:
                keep &= (found >= floor).astype(bool)
            ids, scores = np.concatenate([ids, self.ids[new[keep]]]), np.concatenate([scores, found[keep]])
            if len(ids) > k and scores.dtype != object:
                keep = scores >= np.partition(scores, len(scores) - k)[len(scores) - k]
                ids, scores = ids[keep], scores[keep]
            best = np.lexsort((ids, -scores))[:k]
            ids, scores = ids[best], scores[best]
            if len(ids) == k:
                floor = scores[-1]
            read, target = depth, self._stop(query, up, down, depth, floor)
            if depth >= target or seen.all():
                return ids.tolist(), scores.tolist(), int(seen.sum())
            depth = min(target, DEEPER * depth)


def _exact(queries: np.ndarray, candidates: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both as doubles if all sums are exact in them, else as Python's integers; of equal width."""
    dim = max(queries.shape[1], candidates.shape[1])
    queries, candidates = (np.pad(x, ((0, 0), (0, dim - x.shape[1]))) for x in (queries, candidates))
    most = [float(np.abs(x).max(initial=0)) for x in (queries, candidates)]
    kind = np.float64 if most[0] * most[1] * max(dim, 1) < EXACT else object
    return queries.astype(kind), candidates.astype(kind)


def top_k(candidates: DataFrame, queries: DataFrame, k: int, scale: float = 256.0, id_column: str = "vec_id",
          vector: str = "embedding", query_rows: int = QUERIES, candidate_rows: int = CANDIDATES) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k best candidates of each query row.

    Components count as floor(scale * x), scores are integer inner products, ties go
    to the smaller id. Rows without id, vectors that are missing or hold a missing or
    non-finite component take no part; a query's own id is no candidate of it.
    Shorter vectors are padded with zeros, empty ones score 0. Components are held
    within 2**62 and scores within a long's range. Repeated candidates are ranked
    each, repeated queries answered each. Fewer candidates than k: all of them; no
    queries or candidates: no rows.
    """
    stages = Stages(candidates.sparkSession, "top-k")

    def usable(df: DataFrame) -> DataFrame:
        return df.where(F.col(id_column).isNotNull() & F.col(vector).isNotNull()).select(
            F.col(id_column).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"))

    asked, n_asked = _blocks(usable(queries), query_rows, scale, stages, "queries")
    offered, n_offered = _blocks(usable(candidates), candidate_rows, scale, stages, "candidates")
    left = asked.select(F.col("block").alias("q"), *[F.col(c).alias(f"q_{c}") for c in ("n", "dim", "ids", "vectors")],
                        F.explode(F.sequence(F.lit(0), F.lit(n_offered - 1))).alias("c"))
    right = offered.select(F.col("block").alias("c"), *[F.col(c).alias(f"c_{c}") for c in ("n", "dim", "ids", "vectors")],
                           F.explode(F.sequence(F.lit(0), F.lit(n_asked - 1))).alias("q"))
    schema = "q int, place int, query_id long, vec_id long, score long"
    kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64())

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, list[list]] = {}
        for batch in batches:
            for row in range(batch.num_rows):
                value = {c: batch.column(c)[row].as_py() for c in batch.schema.names}
                ids, vectors = ({s: np.frombuffer(value[f"{s}_{c}"], np.int64) for s in "qc"} for c in ("ids", "vectors"))
                both = _exact(*(vectors[s].reshape(value[f"{s}_n"], value[f"{s}_dim"]) for s in "qc"))
                lists, out = Lists(ids["c"], both[1]), []
                known = best.setdefault(value["q"], [[] for _ in both[0]])
                for place, (own, query) in enumerate(zip(ids["q"].tolist(), both[0])):
                    found, scores, _ = lists.top(own, query, k, known[place][-1] if len(known[place]) == k else None)
                    known[place] = sorted(known[place] + scores, reverse=True)[:k]
                    out += [(value["q"], place, own, i, max(-(2**63), min(2**63 - 1, int(s)))) for i, s in zip(found, scores)]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)],
                                                     names=["q", "place", "query_id", "vec_id", "score"])

    # Spark takes the exploded blocks for as many bytes as their file, so both sides are always exchanged.
    found = left.join(right.hint("merge"), ["q", "c"]).mapInArrow(search, schema)
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("q", "place").orderBy(F.desc("score"), "vec_id")))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
