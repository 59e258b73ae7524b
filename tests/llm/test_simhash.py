import random

import pytest
import xxhash

import __spark_entry__ as contract
from riverload.llm.components import components
from riverload.llm.simhash import links, near_duplicates, simhash
from riverload.stages import Stages


def brute_print(text, n=3):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ").replace("\r", " ").replace("\x0b", " ").replace("\x0c", " ").split(" ")
    words = [w for w in words if w]
    shingles = [" ".join(words[i:i + n]) for i in range(len(words) - n + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, bits=3):
    """Smallest reachable id of each (id, print), by a walk over all pairs of distinct prints."""
    least, seen = {}, {}
    for i, p in prints:
        least[p] = min([x for x in (least.get(p), i) if x is not None], default=None)
    for p in least:
        if p in seen:
            continue
        group, stack = {p}, [p]
        while stack:
            q = stack.pop()
            for r in least.keys() - group:
                if (q ^ r).bit_count() <= bits:
                    group.add(r)
                    stack.append(r)
        best = min((least[q] for q in group if least[q] is not None), default=None)
        seen |= dict.fromkeys(group, best)
    return [(i, p, seen[p]) for i, p in prints]


def test_fingerprints():
    for text in (None, "", " \n\t", "a", "A b", "one Two three", "ä ß one\x0btwo\x85three four " * 40, "x y z q w e", "w " * 70_000):
        assert simhash(text, 3) % 2**64 == brute_print(text), text
    assert simhash("a b c d", 2) % 2**64 == brute_print("a b c d", 2)


def test_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, brute_print(r.text)) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = [tuple(r) for r in contract.queries()["op5_simhash"](spark, sf).collect()]
    assert sorted(got) == sorted((i, f"{p:016x}", c) for i, p, c in brute_components(docs))


@pytest.mark.parametrize(("bits", "segments"), [(3, 2), (3, 4), (5, 2), (0, 2)])
def test_links_against_all_pairs(spark, bits, segments):
    rng = random.Random(bits)
    prints = {rng.getrandbits(64) for _ in range(12)}
    for p in list(prints):
        for _ in range(25):
            prints.add(p ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 7))))
    signed = [p - (p >> 63 << 64) for p in prints]
    got = {frozenset(r) for r in links(spark.createDataFrame([(p,) for p in signed], "print long"), bits, segments).collect()}
    expected = {frozenset((a, b)) for a in signed for b in signed if a < b and ((a ^ b) % 2**64).bit_count() <= bits}
    assert got == expected


def test_components_of_chains_and_hubs(spark):
    chain = [(i, i + 1) for i in range(40)]
    hub = [(100, 101 + i) for i in range(500)] + [(601, 600)]
    edges = spark.createDataFrame(chain + hub + [(7, 7), (900, 900), (1, 0)], "a long, b long")
    got = {r.node: r.component for r in components(edges, Stages(spark, "test")).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 602)}
    assert components(edges.limit(0), Stages(spark, "test")).count() == 0


def test_odd_rows(spark):
    rows = [(3, "same words here", 1), (1, "same words here", 1), (3, "same words here", 1), (None, "alone in this", 1), (5, None, 1), (4, "", 1),
            (9, "word " * 300_000, 1), (None, "", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, component_id int")
    got = sorted(((r.doc_id, r.component_id) for r in near_duplicates(df).collect()), key=str)
    assert got == sorted([(3, 1), (1, 1), (3, 1), (None, None), (5, 4), (4, 4), (9, 9), (None, 4)], key=str)
    assert near_duplicates(df.limit(0)).count() == 0


def test_look_ups_are_never_gathered_for_a_broadcast(spark, tmp_path):
    """The fingerprints' file is small, the look-ups made of it are many times as much."""
    spark.range(2000).selectExpr("xxhash64(id) AS print").write.parquet(str(tmp_path / "prints"))
    text = links(spark.read.parquet(str(tmp_path / "prints")))._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in text and "SortMergeJoin" in text
