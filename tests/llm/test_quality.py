import itertools
import math

import numpy as np
from pyspark.sql import functions as F

import __spark_entry__ as contract
from riverload.llm import quality

SF = "/root/testdata/sf0.01"


def test_marginals_against_all_labelings():
    rng = np.random.default_rng(1)
    for n in (1, 2, 5):
        e, pairs = rng.normal(size=n), rng.normal(size=(2, 2))
        weight = {y: math.exp(sum(a * b for a, b in zip(y, e)) + sum(pairs[a, b] for a, b in itertools.pairwise(y)))
                  for y in itertools.product((0, 1), repeat=n)}
        expected = [sum(w for y, w in weight.items() if y[t]) / sum(weight.values()) for t in range(n)]
        assert np.allclose(quality._marginals(np.exp(e).tolist(), np.exp(pairs).tolist()), expected)


def test_features_of_neighbours():
    whole, sizes = quality._features([["AB", "c1!"], ["é | x x"]])
    n = quality.FEATURES
    assert list(sizes) == [2, 3, 7]
    assert np.allclose(whole[0, n:2 * n], 0) and np.allclose(whole[1, n:2 * n], whole[0, :n])
    assert np.allclose(whole[0, 2 * n:], whole[1, :n]) and np.allclose(whole[1, 2 * n:], 0) and np.allclose(whole[2, n:], 0)
    assert whole[0, 1] == 2 / 3 and whole[1, 5] == 1 / 3 and whole[2, 8] == 3 / 4


def test_held_out_accuracy(spark):
    got = contract.queries()["op6_quality"](spark, SF)
    assert [f.dataType.simpleString() for f in got.schema] == ["bigint", "boolean", "double", "int"]
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = got.join(labels, "doc_id").where("held_out").collect()
    assert len(rows) > 50 and sum(r.quality == r.predicted for r in rows) / len(rows) >= 0.95
    assert got.count() == spark.read.parquet(f"{SF}/documents.parquet").count()


def test_query_against_plain_forward_backward(spark):
    """Every document alone, sums of logarithms over all lines."""
    sf = "/root/testdata/sf0.001"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    field = quality.fit_field(docs, quality.train_rows(labels))
    got = {r.doc_id: r.score for r in contract.queries()["op6_quality"](spark, sf).collect()}
    for r in docs.collect():
        lines = [x for x in (r.text or "").split("\n") if x.strip()] or [""]
        features, _ = quality._features([lines])
        emission = np.clip(np.clip((features - field.mean) / field.scale, -quality.FAR, quality.FAR) @ field.weights, -30, 30)
        local = np.stack([np.zeros(len(lines)), emission], axis=1)
        forward, backward = local.copy(), np.zeros_like(local)
        for i in range(1, len(lines)):
            forward[i] += np.logaddexp(*(forward[i - 1][:, None] + field.pairs))
        for i in range(len(lines) - 2, -1, -1):
            backward[i] = np.logaddexp(*(field.pairs + local[i + 1] + backward[i + 1]).T)
        both = forward + backward
        good = np.exp(both[:, 1] - np.logaddexp(both[:, 0], both[:, 1]))
        sizes = np.array([max(len(x), 1) for x in lines])
        assert abs(got[r.doc_id] - good @ sizes / sizes.sum()) < 1e-6
    assert len(got) == docs.count()


def test_labels_that_teach_nothing(spark):
    docs = spark.createDataFrame([(1, "a", 1), (None, "b", 1), (2, None, 1)], "doc_id long, text string, quality int")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert quality.fit_field(docs, none) is None
    one = spark.createDataFrame([(1, 1), (None, 0), (2, None), (9, 0)], "doc_id long, quality int")
    assert quality.fit_field(docs, one) is None
    contradicting = spark.createDataFrame([(1, 1), (1, 0), (2, 1)], "doc_id long, quality int")
    assert quality.fit_field(docs, contradicting) is None
    assert [r[0] for r in docs.select(quality.quality_score("text", None)).collect()] == [0.5] * 3
    assert quality.fit_field(docs.limit(0), one) is None


def test_odd_texts(spark):
    docs = spark.createDataFrame(
        [(i, "\n".join([" ".join(["Plain words of a text."] * (1 + i % 7)) if i % 2 else " ".join(["BAD!! WORDS!! | ### %%%"] * (1 + i % 7))] * (i // 2 % 6)))
         for i in range(200)], "doc_id long, text string")
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"))
    field = quality.fit_field(docs.union(docs.limit(3)), labels.union(labels))
    odd = [None, "", "\n\n", "x" * 2_000_000, "BAD!! WORDS!! | ### %%%\n" * 50_000, "A!! " * 300_000, "line\n" * 100_000, "Plain words of a text.", "\ud800".encode("utf-8", "replace").decode()]
    scores = quality.score_texts(odd, field)
    assert all(0 <= s <= 1 for s in scores) and scores[7] > 0.9 and scores[4] < 0.1
    assert scores[0] == scores[1] == scores[2]
    assert np.allclose(quality.score_texts(odd[::-1], field), scores[::-1], atol=1e-9)
