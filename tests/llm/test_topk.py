import math
import random

import numpy as np
import pytest

from riverload.llm.topk import Lists, _exact, top_k

SCHEMA = "vec_id long, embedding array<double>, score string"


def brute(rows, asked, k):
    usable = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, q in usable:
        if asked(i):
            scores = sorted((-sum(a * b for a, b in zip(q, c)), j) for j, c in usable if j != i)[:k]
            out += [(i, r, j, -s) for r, (s, j) in enumerate(scores, 1)]
    return sorted(out)


def run(spark, rows, asked=lambda c: c % 5 == 0, k=3, **sizes):
    df = spark.createDataFrame([(i, v, "clash") for i, v in rows], SCHEMA)
    return sorted(map(tuple, top_k(df, df.where(asked(df.vec_id)), k, **sizes).collect()))


def test_against_brute_force_with_ties_and_blocks(spark):
    rng = random.Random(1)
    rows = [(i, [rng.choice([-0.5, -0.01, 0.0, 0.004, 0.3, 1.0]) for _ in range(3)]) for i in range(120)]
    rows += [(200, None), (205, [None, 1.0, 1.0]), (210, [float("nan"), 0.0, 0.0]), (215, [float("inf"), 0.0, 0.0]), (None, [1.0, 1.0, 1.0]), (220, [0.0] * 3)]
    assert run(spark, rows, query_rows=7, candidate_rows=20) == brute(rows, lambda i: i % 5 == 0, 3)


def test_few_or_no_rows(spark):
    assert run(spark, []) == []
    assert run(spark, [(5, [1.0])]) == []
    assert run(spark, [(1, [1.0]), (2, [1.0])]) == []
    assert run(spark, [(5, [1.0]), (6, [1.0, 2.0]), (7, [])]) == [(5, 1, 6, 65536), (5, 2, 7, 0)]
    assert run(spark, [(5, [1.0]), (5, [2.0]), (6, [1.0])]) == [(5, 1, 6, 65536), (5, 1, 6, 131072)]
    assert run(spark, [(5, [1.0]), (6, [1.0]), (6, [1.0])]) == [(5, 1, 6, 65536), (5, 2, 6, 65536)]


@pytest.mark.parametrize("size", [1.0, 1e30])
def test_huge_components_are_exact(spark, size):
    rows = [(i, [size * (i + 1), 1.0 * i]) for i in range(6)]
    got = run(spark, rows)
    if size == 1.0:
        assert got == brute(rows, lambda i: i % 5 == 0, 3)
    assert len(got) == 6 and all(abs(r[3]) < 2**63 for r in got)


def test_stops_before_the_end():
    """One list decides: the bound falls below the best score after a few rows."""
    rng = np.random.default_rng(1)
    vectors = rng.integers(0, 5, (5000, 4))
    vectors[:8, 0] = 10**6
    queries, candidates = _exact(np.array([[1000, 1, 1, 1]]), vectors)
    ids, scores, read = Lists(np.arange(5000), candidates).top(-1, queries[0], 5)
    expected = sorted((-int(s), i) for i, s in enumerate(vectors @ [1000, 1, 1, 1]))[:5]
    assert [(-int(s), i) for s, i in zip(scores, ids)] == expected and read < 500


def test_starting_from_a_known_score():
    rng = np.random.default_rng(2)
    for _ in range(30):
        queries, candidates = _exact(rng.integers(-3, 4, (1, 5)), rng.integers(-3, 4, (300, 5)))
        lists = Lists(np.arange(300), candidates)
        ids, scores, _ = lists.top(7, queries[0], 5)
        expected = sorted((-s, i) for i, s in enumerate(candidates @ queries[0]) if i != 7)
        assert list(zip([-s for s in scores], ids)) == expected[:5]
        for known in (expected[4], expected[2], expected[40]):
            ids, scores, _ = lists.top(7, queries[0], 5, -known[0])
            assert list(zip([-s for s in scores], ids)) == [x for x in expected if x[0] <= known[0]][:5]


def test_blocks_are_never_gathered_for_a_broadcast(spark):
    """The files of the blocks are small, their copies for all blocks of the other side are not."""
    df = spark.createDataFrame([(i, [1.0 * i], "clash") for i in range(60)], SCHEMA)
    text = top_k(df, df.where("vec_id % 5 = 0"), 3, query_rows=4, candidate_rows=5)._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in text and "SortMergeJoin" in text
