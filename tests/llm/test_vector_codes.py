import hashlib
import math
import random

import numpy as np
import pytest

from riverload.llm import vector_codes as v

SCHEMA = "vec_id long, embedding array<double>, label int, code int"


def brute(rows, parts=8, entries=16, rounds=6):
    kept = [(i, [math.floor(4096 * x) for x in e], label) for i, e, label in rows if e and all(x is not None and math.isfinite(x) for x in e)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    w = len(kept[0][1]) // parts
    cut = [[tuple(e[p * w:(p + 1) * w]) for p in range(parts)] for _, e, _ in kept]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def near(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, y)), k) for k, y in enumerate(books[p]))

    for _ in range(rounds):
        made = []
        for p in range(parts):
            groups = {}
            for c in cut:
                groups.setdefault(near(p, c[p])[1], []).append(c[p])
            made.append([tuple(sum(col) // len(groups[k]) for col in zip(*groups[k])) if k in groups else y for k, y in enumerate(books[p])])
        books = made
    coded = [(i, "".join(f"{near(p, c[p])[1]:02x}" for p in range(parts)), sum(near(p, c[p])[0] for p in range(parts)), label) for (i, _, label), c in zip(kept, cut)]
    sums = {}
    for _, _, e, label in coded:
        sums[label] = sums.get(label, 0) + e
    return sorted((str(i), code, e, sums[label]) for i, code, e, label in coded), books


def run(spark, rows, **options):
    coded, books = v.compress(spark.createDataFrame([(*r, 0) for r in rows], SCHEMA), **options)
    return sorted((str(r.vec_id), r.code, r.error, r.label_error) for r in coded.collect()), books


def vectors(seed, n=300, dim=16, grain=None):
    rng = random.Random(seed)
    value = (lambda: rng.choice(grain)) if grain else (lambda: rng.gauss(0, 0.3))
    return [(i, [value() for _ in range(dim)], rng.choice([1, 1, 1, 2, None])) for i in rng.sample(range(10**6), n)]


@pytest.mark.parametrize("grain", [None, [-1 / 4096, 0.0, 1 / 4096]])
def test_against_brute_force(spark, grain):
    rows = vectors(1, grain=grain)
    got, books = run(spark, rows)
    expected, wanted = brute(rows)
    assert got == expected and [[tuple(y) for y in b.tolist()] for b in books] == wanted


def test_odd_rows(spark):
    rows = vectors(2, 40, 8)
    odd = rows + [rows[3], rows[3], (None, [0.5] * 8, None), (7, None, 1), (8, [None] + [0.1] * 7, 1), (9, [float("nan")] * 8, 1), (11, [float("-inf")] * 8, 1)]
    assert run(spark, odd)[0] == brute(odd)[0]
    others = [(10**7, [0.1] * 16, 1), (10**7 + 1, [0.1] * 7, 1), (-5, [], 1), (-6, [0.2] * 3, 1)]
    assert run(spark, rows + others)[0] == brute(rows)[0]
    assert run(spark, rows[:3])[0] == brute(rows[:3])[0]
    assert run(spark, []) == ([], [])
    assert run(spark, [(1, [1e300] * 8, 1), (2, [-1e300] * 8, 1)])[0] == [("1", "00" * 8, 0, 0), ("2", "01" * 8, 0, 0)]


@pytest.mark.parametrize("seed", range(6))
def test_tree_against_all_distances(seed):
    rng = np.random.default_rng(seed)
    spread = [2, 5, 1000, 1 << 27][seed % 4]
    entries = rng.integers(-spread, spread + 1, (rng.choice([1, 3, 16, 200]), 4))
    queries = np.concatenate([rng.integers(-spread, spread + 1, (500, 4)), entries])
    squares = v.squared_distances(queries, entries)
    index, best = v.Gnat(entries).nearest(queries)
    assert (best == squares.min(axis=1)).all() and (index == squares.argmin(axis=1)).all()


def test_subtrees_are_left_out():
    """Entries in well separated heaps: a query looks at its own heap only."""
    rng = np.random.default_rng(3)
    heaps = np.array([[0, 0], [10**6, 0], [0, 10**6], [10**6, 10**6]])
    entries = (heaps[:, None] + rng.integers(0, 100, (4, 50, 2))).reshape(-1, 2)
    queries = entries + rng.integers(0, 10, entries.shape)
    best, index = np.full(200, np.iinfo(np.int64).max), np.full(200, np.iinfo(np.int64).max)
    done = v.Gnat(entries)._search(queries, np.arange(200), best, index)
    assert done < 200 * 200 / 4 and (best == v.squared_distances(queries, entries).min(axis=1)).all()


def test_digest_is_of_the_codebooks(spark):
    import __spark_entry__ as contract

    sf = "/root/testdata/sf0.001"
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    expected, books = brute(rows, rounds=6)
    digest = hashlib.sha256(",".join(str(x) for b in books for y in b for x in y).encode()).hexdigest()
    got = contract.queries()["op11_vector_codes"](spark, sf).collect()
    assert {r.codebooks_sha256 for r in got} == {digest}
    assert sorted((str(r.vec_id), r.code, r.error, r.label_error) for r in got) == expected
