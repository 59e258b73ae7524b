import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from riverload.llm import collocations as c

SCHEMA = "doc_id long, text string, lang string, rank string, phrase int"


def brute(rows, least, keep):
    counts, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        text = "".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in text or "")
        for piece in re.split("[.,;:!?\n-\r]", text):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for k in range(1, 6):
                counts[lang].update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, count in counts.items():
        phrases = {g: a for g, a in count.items() if len(g) > 1 and a >= least}
        inside = {g[i:i + k] for g, a in phrases.items() for k in range(2, len(g)) for i in range(len(g) - k + 1) if phrases[g[i:i + k]] <= a}
        found = []
        for g, a in phrases.items():
            if g not in inside:
                score, k = min((1000 * a * n[lang] // (count[g[:k]] * count[g[k:]]), k) for k in range(1, len(g)))
                found.append((-score, -a, " ".join(g).encode(), count[g[:k]], count[g[k:]]))
        out += [(lang, r, p.decode(), -a, left, right, n[lang], -s) for r, (s, a, p, left, right) in enumerate(sorted(found)[:keep], 1)]
    return sorted(out)


def run(spark, rows, least=3, keep=1000):
    df = spark.createDataFrame([(i, t, x, "clash", 0) for i, (t, x) in enumerate(rows)], SCHEMA)
    return sorted(map(tuple, c.collocations(df, least, keep).collect()))


def texts(seed, n=150, words=9):
    rng = random.Random(seed)
    vocabulary = [f"{x}{k}" for k, x in enumerate(["a", "É", "the", "Of", "x-y", "日", "'s", "|", "b\xa0c"][:words])]
    ends = [" ", " ", " ", " ", " ", "\t", "  ", ". ", ",", "\n", "\r", "\x0b", "?!"]
    passages = [" ".join(rng.choice(vocabulary) for _ in range(rng.choice([6, 30, 200]))) for _ in range(3)]
    for _ in range(n):
        text = "".join(rng.choice(vocabulary) + rng.choice(ends) for _ in range(rng.randrange(40)))
        yield text + rng.choice([" ", "", "."]) + rng.choice([*passages, "", ""]), rng.choice(["en", "de", None, "und", ""])


@pytest.mark.parametrize("seed", range(3))
def test_against_brute_force(spark, monkeypatch, seed):
    rows = list(texts(seed))
    if seed == 1:
        monkeypatch.setattr(c, "CELLS", (3, 3))  # crowded cells leave nothing out
    if seed == 2:
        monkeypatch.setattr(c, "SEGMENT", 4)
    assert run(spark, rows) == brute(rows, 3, 1000)
    assert run(spark, rows, 5, 7) == brute(rows, 5, 7)


def test_odd_rows(spark):
    assert run(spark, []) == [] and run(spark, [(None, None), ("", "en"), (" .\t", "en"), ("one two", "en")]) == []
    rows = [("a b " * 3000, None)] + [("Long " + "piece of words " * 400, "en")] * 6 + [("x y", "en")] * 5 + [(None, "en"), ("", None)]
    assert run(spark, rows) == brute(rows, 3, 1000)


def test_products_beyond_64_bits(spark):
    counts = spark.createDataFrame([("en", 1, "a", 10**13), ("en", 1, "b", 2 * 10**13), ("en", 2, "a b", 10**13)], "lang string, size int, gram string, a long")
    totals = spark.createDataFrame([("en", 7 * 10**13)], "lang string, n long")
    (row,) = c.score_phrases(counts, totals).collect()
    assert row.score == 1000 * 10**13 * 7 * 10**13 // (10**13 * 2 * 10**13)


def test_paths_are_compacted(spark):
    from riverload.stages import Stages

    stages = Stages(spark, "test")
    rows = [("p q r s t u v w x", "en")] * 4 + [("q r s t u z", "en")] * 3
    grams = c.count_grams(spark.createDataFrame(rows, "text string, lang string").select("lang", "text"), 3).cache()
    edges = grams.where("size = 5").select("lang", "gram", "weight")
    paths = c.compact_paths(edges, c.node_flow(grams), stages)
    assert sorted((" ".join(r.words), r.edges, r.weight) for r in paths.collect()) == [
        ("p q r s t", 1, 4), ("q r s t u", 1, 7), ("r s t u v w x", 3, 4), ("r s t u z", 1, 3)]


def test_words_and_their_pieces():
    batch = pa.RecordBatch.from_pydict({"lang": ["a", "b"], "text": ["One two.three", None]})
    (found,) = c.read_words(iter([batch]))
    assert found.vocabulary == [b"one", b"two", b"three"] and found.left.tolist() == [2, 1, 1] and found.ids.dtype == np.int32
