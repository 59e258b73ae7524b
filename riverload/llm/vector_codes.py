"""Vector codes by product quantization, nearest entries found in a GNAT.

Vectors become integers and are cut into equal parts; every part position has a codebook
that is refined in rounds: each part goes to its nearest entry, each entry to the mean of
its parts. Sums are made within the tasks, so a round moves one row per component and
task, and only the codebooks, of fixed size, pass the driver.

The nearest entry is searched in a geometric near-neighbour access tree over the
codebook: a node has some entries as split points, every other entry belongs to the
nearest of them, and for each pair of split point and subtree the node keeps the range of
distances from that point to the entries of the subtree. A subtree is left out when the
query's distance to some split point differs from that whole range by more than the best
distance so far. Distances for this are rounded outwards and compared strictly, so an
equally near entry is never lost; what decides are integer squared distances, and among
equal ones the lower index.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riverload.functions.joins import null_safe_join
from riverload.stages import Stages

SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
#: Split points of a node; a node of so few entries has no subtrees.
SPLITS, LEAF = 4, 3
#: Components are kept within this, so that squared distances of parts of up to 127 components are exact.
LARGEST = 1 << 27
#: Share of a distance by which rounding may be off, amply.
ROUNDING = 1e-9


class Gnat:
    """The entries of one codebook as a tree; ``entries`` is an integer array, a row each."""

    def __init__(self, entries: np.ndarray, numbers: np.ndarray | None = None, splits: int = SPLITS, leaf: int = LEAF):
        numbers = np.arange(len(entries)) if numbers is None else numbers
        chosen = np.arange(len(entries)) if len(entries) <= max(leaf, splits) else _spread(entries, splits)
        self.points, self.numbers = entries[chosen], numbers[chosen]
        self.low = self.high = None
        self.children: list[tuple[int, Gnat]] = []
        rest = np.setdiff1d(np.arange(len(entries)), chosen)
        if len(rest):
            squares = squared_distances(entries[rest], self.points)
            near = squares.argmin(axis=1)
            away = np.sqrt(squares.astype(float))
            self.low = np.full((len(chosen), len(chosen)), np.inf)
            self.high = np.full((len(chosen), len(chosen)), -np.inf)
            for child in np.unique(near):
                mine = near == child
                self.low[:, child] = away[mine].min(axis=0) * (1 - ROUNDING)
                self.high[:, child] = away[mine].max(axis=0) * (1 + ROUNDING)
                self.children.append((int(child), Gnat(entries[rest[mine]], numbers[rest[mine]], splits, leaf)))

    def nearest(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry and squared distance to it, for each row."""
        best = np.full(len(queries), np.iinfo(np.int64).max)
        index = np.full(len(queries), np.iinfo(np.int64).max)
        self._search(queries, np.arange(len(queries)), best, index)
        return index, best

    def _search(self, queries: np.ndarray, rows: np.ndarray, best: np.ndarray, index: np.ndarray) -> int:
        """Improve ``best`` and ``index`` of the rows; returns the number of distances computed."""
        squares = squared_distances(queries[rows], self.points)
        done = squares.size
        for at, number in enumerate(self.numbers):
            better = (squares[:, at] < best[rows]) | ((squares[:, at] == best[rows]) & (number < index[rows]))
            best[rows[better]], index[rows[better]] = squares[better, at], number
        if not self.children:
            return done
        away = np.sqrt(squares.astype(float))
        below, above = away * (1 - ROUNDING), away * (1 + ROUNDING)
        for child, tree in self.children:
            reach = np.sqrt(best[rows].astype(float)) * (1 + ROUNDING)
            apart = np.maximum(below - self.high[:, child], self.low[:, child] - above).max(axis=1)
            left = ~(apart * (1 - ROUNDING) > reach)
            if left.any():
                done += tree._search(queries, rows[left], best, index)
        return done


def squared_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of every row of ``a`` to every row of ``b``, in integers."""
    out = np.empty((len(a), len(b)), np.int64)
    for k, point in enumerate(b):
        gap = a - point
        np.einsum("ij,ij->i", gap, gap, out=out[:, k])
    return out


def _spread(entries: np.ndarray, splits: int) -> np.ndarray:
    """Split points far from each other: each next one has the greatest distance to those before."""
    chosen = [0]
    away = squared_distances(entries, entries[:1])[:, 0]
    while len(chosen) < splits:
        away[chosen] = -1
        chosen.append(int(away.argmax()))
        away = np.minimum(away, squared_distances(entries, entries[chosen[-1:]])[:, 0])
    return np.array(chosen)


Codebooks = list[np.ndarray]  # for each part position the entries, an integer row each


def usable(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", scale: int = SCALE) -> DataFrame:
    """``vec_id, label, ints``: rows whose vector is there and all finite, components as ``floor(scale * x)``."""
    numbers = F.transform(vector, lambda x: x.cast("double"))
    whole = F.forall(numbers, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    bound = float(LARGEST)
    return (vectors.where(F.col(vector).isNotNull() & F.coalesce(whole, F.lit(False)))
            .select(F.col(vec_id).alias("vec_id"), F.col(label).alias("label"), F.transform(numbers, lambda x: F.floor(
                F.greatest(F.lit(-bound), F.least(F.lit(bound), x * scale))).cast("int")).alias("ints")))


def first_codebooks(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES) -> Codebooks:
    """The parts of the vectors of the smallest ids."""
    first = rows.orderBy(F.asc_nulls_last("vec_id"), "ints").limit(entries).select("ints").collect()
    return np.split(np.array([r["ints"] for r in first], np.int64), parts, axis=1) if first else []


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), -1)


def refine(rows: DataFrame, books: Codebooks) -> Codebooks:
    """One round: every part to its nearest entry, every entry to the floor of its parts' mean; unused entries stay."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [Gnat(book) for book in books]
        sums = [np.zeros((len(b), b.shape[1] + 1), np.int64) for b in books]
        for batch in batches:
            if batch.num_rows:
                for tree, total, part in zip(trees, sums, np.split(_matrix(batch.column(0)), len(books), axis=1)):
                    index, _ = tree.nearest(part)
                    for entry in np.unique(index):
                        mine = part[index == entry]
                        total[entry, :-1] += mine.sum(axis=0)
                        total[entry, -1] += len(mine)
        flat = np.concatenate([s.reshape(-1) for s in sums])
        yield pa.RecordBatch.from_pydict({"place": np.arange(len(flat)), "total": flat})

    found = rows.select("ints").mapInArrow(add, "place long, total long").groupBy("place").agg(F.sum("total").alias("total"))
    flat = np.zeros(sum(b.size + len(b) for b in books), np.int64)
    for row in found.collect():
        flat[row["place"]] = row["total"]
    made, at = [], 0
    for book in books:
        total = flat[at:at + book.size + len(book)].reshape(len(book), -1)
        at += total.size
        count = total[:, -1:]
        made.append(np.where(count > 0, total[:, :-1] // np.maximum(count, 1), book))
    return made


def encoded(ints: str | Column, books: Codebooks) -> Column:
    """Column (``code, error``): two hex digits for each part's entry, and the squared distances to them summed."""
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        trees = [Gnat(book) for book in books]
        for batch in batches:
            found = [tree.nearest(part) for tree, part in zip(trees, np.split(_matrix(batch), len(books), axis=1))] if len(batch) else []
            codes = np.column_stack([index for index, _ in found]).astype(np.uint8) if found else np.empty((0, 0), np.uint8)
            yield pa.StructArray.from_arrays([
                pa.array([c.tobytes().hex() for c in codes], pa.string()),
                pa.array(sum(error for _, error in found) if found else [], pa.int64())], ["code", "error"])

    return F.arrow_udf(encode, "struct<code string, error long>")(ints)


def compress(
    vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
    parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
) -> tuple[DataFrame, Codebooks]:
    """``vec_id, label, code, error, label_error`` of every usable vector, and the codebooks.

    Vectors that are null or hold null or non-finite components take no part, nor do
    vectors of another length than that of the smallest usable id, or of a length that
    ``parts`` does not divide. Fewer vectors than ``entries`` give smaller codebooks, no
    vectors no rows. Repeated rows are vectors of their own; missing ids come last among
    the first entries, missing labels are one label. Components beyond ``LARGEST`` in
    magnitude count as that. At most 256 entries.
    """
    stages = Stages(vectors.sparkSession, "codes")
    kept = stages.write(usable(vectors, vec_id, vector, label, scale), "vectors")
    first = kept.where((F.size("ints") > 0) & (F.size("ints") % parts == 0)).orderBy(F.asc_nulls_last("vec_id"), "ints").select(F.size("ints")).first()
    kept = kept.where(F.size("ints") == (first[0] if first else -1))
    books = first_codebooks(kept, parts, entries)
    for _ in range(rounds if books else 0):
        books = refine(kept, books)
    coded = stages.write(kept.select("vec_id", "label", encoded("ints", books).alias("found")).select("vec_id", "label", "found.*"), "codes")
    errors = coded.groupBy("label").agg(F.sum("error").alias("label_error"))
    return null_safe_join(coded, errors, "label").select("vec_id", "label", "code", "error", "label_error"), books
