import random

import __spark_entry__ as contract
from riverload.llm import decontaminate as d

VOCABULARY = [f"w{i}" for i in range(300)] + ["the", "of", "and"] * 30


def text(rng, n):
    return " ".join(rng.choice(VOCABULARY) for _ in range(n))


def brute_scores(items, passages):
    """BM25 shares of every (passage, item), without an index."""
    import math

    docs = [d.words(t) for _, t in items]
    mean, n = sum(map(len, docs)) / len(docs), len(docs)
    df = {t: sum(t in w for w in docs) for w in docs for t in w}
    part = [{t: math.log(1 + (n - df[t] + 0.5) / (df[t] + 0.5)) * w.count(t) * (d.K1 + 1) / (w.count(t) + d.K1 * (1 - d.B + d.B * len(w) / mean)) for t in set(w)} for w in docs]
    return [[sum(p[t] for t in set(q) if t in p) / sum(p.values()) for p in part] for q in passages]


def test_search_finds_all_above_the_threshold():
    rng = random.Random(2)
    items = [(i, text(rng, rng.randint(4, 25))) for i in range(90)]
    for threshold in (0.3, 0.6):
        index = d.Index(items, threshold)
        documents = [d.words(text(rng, rng.choice([0, 1, 10, 60, 400]))) for _ in range(60)] + [d.words("x " * 30 + items[5][1] + " y" * 9)]
        for document, hits in zip(documents, index.search(documents)):
            s = index.stride
            passages = [document[at:at + 2 * s] for at in range(0, len(document), s)]
            expected = {}
            for row in brute_scores(items, passages):
                for i, score in enumerate(row):
                    if score >= threshold - 1e-9:
                        expected.setdefault(i, []).append(round(score, 9))
            assert {i: sorted(round(score, 9) for _, score in found) for i, found in hits.items()} == {i: sorted(x) for i, x in expected.items()}


def test_question_and_answer_are_both_needed():
    item = "What is the capital of the old northern kingdom by the sea?\nIt was the small harbour town of Exampleburg."
    index = d.Index([(7, item), (8, "Another item with quite different words in it. And an answer that differs too.")])
    question, answer = d.question_and_answer(item)
    noise = "some other text " * 20
    found = index.leaks([d.words(t) for t in (noise + item.upper().replace(" ", "\n") + noise, noise + question + noise, noise + answer, None, "", noise, item)])
    assert [[h["item_id"] for h in f] for f in found] == [[7], [], [], [], [], [], [7]]
    assert d.question_and_answer("One only.") == ("One only.", "") and d.question_and_answer("A b. C d.") == ("A b.", "C d.")


def test_every_passage_above_the_threshold_is_verified():
    """The item's words in disorder score as much as the item, and come first."""
    rng = random.Random(8)
    item = "Which river joins the northern lake after the last of the seven great falls near town?\nThe small green river that rises below the old stone bridge."
    index = d.Index([(7, item), (8, "Another item with quite different words in it. And an answer that differs too.")])
    filler = [f"filler{i}" for i in range(200)]
    for order in ("shuffled first", "item first"):
        shuffled = d.words(item) * 2
        rng.shuffle(shuffled)
        parts = [shuffled, filler, d.words(item)]
        document = sum(parts if order == "shuffled first" else parts[::-1], [])
        assert len(index.search([document])[0][0]) >= 2
        assert [h["item_id"] for h in index.leaks([document])[0]] == [7]
    assert index.leaks([shuffled + filler]) == [[]]


def test_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    items = {r.item_id: d.words(r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()}
    expected = set()
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        whole = f" {' '.join(d.words(r.text))} "
        expected |= {(r.doc_id, i) for i, w in items.items() if f" {' '.join(w)} " in whole}
    got = contract.queries()["op7_decontaminate"](spark, sf).collect()
    assert len(expected) > 10 and {(r.doc_id, r.item_id) for r in got} == expected and len(got) == len(expected)


def test_odd_rows(spark):
    items = spark.createDataFrame([(1, "five words stand in here", 0), (None, "other words are in this item", 0), (2, None, 0), (3, "", 0), (4, "!!", 0),
                                   (5, "five words stand in here", 0)], "item_id long, text string, hits int")
    docs = spark.createDataFrame([(1, "Five words stand in here!", "x"), (1, "Five words stand in here!", "x"), (None, "other words are in this item", "x"), (2, None, "x"),
                                  (3, "", "x"), (4, "filler " * 300_000 + "five words stand in here", "x")], "doc_id long, text string, item_id string")
    for shard in (d.SHARD, 10):
        got = docs.select("doc_id", d.leaks("text", items, shard=shard).alias("hits")).collect()
        assert sorted(((r.doc_id, sorted(str(h.item_id) for h in r.hits)) for r in got), key=str) == sorted(
            [(1, ["1", "5"]), (1, ["1", "5"]), (None, ["None"]), (2, []), (3, []), (4, ["1", "5"])], key=str)
    assert [r.hits for r in docs.select(d.leaks("text", items.limit(0)).alias("hits")).collect()] == [[]] * 6
    assert docs.limit(0).select(d.leaks("text", items)).count() == 0
