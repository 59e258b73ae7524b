import random
import zlib
from collections import Counter

import numpy as np
import pytest

import __spark_entry__ as contract
from riverload.llm import packing
from riverload.llm.queries import bpe_path

ODD = ["", " ", "  ", "a", " a", "a  b", "a   b ", "a \nb", "a\n b", "a  b", "a  b", "don't we'll", "x  ", "\n\n", "日本語 テスト", "𝄞 x", "<|endoftext|> a", "1 2  3",
       "a <|endoftext|> b", "x<|endoftext|>", "<|endoftext|", "a\r\nb", "a\r b\r", "\x0b\x0c a\x0bb", "\x00 a\x01", "a\x1f b", "\x1c", "a\u2028b", "  \n\n  a", "\t\t\t", " " * 99 + "b",
       "é" * 40, "a" * 2000, "\t a", "a　 b", "a \x1c b", "a\x85 b", "a ​ b"]


def reference():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(bpe_path())
    return lambda text: t.encode(text, add_special_tokens=False).ids


def test_ids_against_tokenizers():
    encoder, expected, rng = packing.Encoder(bpe_path()), reference(), random.Random(2)
    parts = ["the", "Wh", " ", " ", " ", "\n", "\t", "é", "ß", "12", "'s", "...", "日", " ", "**", "İ", "а", "\r", "\x0b", "\x0c", "\x85", "\xa0", "\x1d", "\u3000", "\ufeff", "\u200b", "<|endoftext|>", "e\u0301", "🙂"]
    texts = ODD + ["".join(rng.choice(parts) for _ in range(rng.randrange(30))) for _ in range(4000)]
    for text in texts:
        assert np.frombuffer(encoder.ids(text), "<u4").tolist() == expected(text), repr(text)


def check(rows, texts, size=packing.SIZE):
    """Every piece at its place, no gaps, ids as the tokenizer gives them."""
    expected, found = reference(), Counter()
    for i, text in texts:
        ids = np.array([*expected(text or ""), 0], "<u4")
        bounds = [*([0] if len(ids) % size else []), *range(len(ids) % size, len(ids), size), len(ids)]
        for k, (a, b) in enumerate(zip(bounds, bounds[1:])):
            found[i, k, a, b - a, zlib.crc32(ids[a:b].tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == found
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= size
    return len(by)


def test_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    rows = contract.queries()["op4_packing"](spark, sf).collect()
    bound = packing.lower_bound(r.length for r in rows)
    assert bound <= check(rows, texts) <= bound + 1


def test_odd_rows(spark):
    texts = [(None, None), (1, ""), (1, ""), (2, "word " * 5000), (2, "word " * 5000), (None, "x"), *((9, t) for t in ODD)] + [(7, "same text")] * 50
    df = spark.createDataFrame([(i, t, 3, "x") for i, t in texts], "doc_id long, text string, rank int, length string")
    check(packing.pack_documents(df, packing.Encoder, bpe_path()).collect(), texts)
    assert packing.pack_documents(df.limit(0), packing.Encoder, bpe_path()).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_plan_holds_everything(seed):
    rng = random.Random(seed)
    histogram = {rng.randint(1, 100): rng.choice([1, 3, 500, 10**9]) for _ in range(rng.choice([1, 5, 60]))} | {100: 7}
    made = packing.plan(histogram, 100)
    held = Counter()
    for config, n in made.items():
        assert n > 0 and packing._fill(config) <= 100
        for s, k in config:
            held[s] += n * k
    assert held == Counter(histogram)
    bound = -(-sum(s * n for s, n in histogram.items()) // 100)
    alone = sum(n for s, n in histogram.items() if s > 50)
    assert sum(made.values()) >= max(bound, alone)
    assert packing.plan({}, 100) == {}


def test_program_beats_best_fit_where_it_errs():
    """Best-fit puts 6+4 and wastes; pairs of 5 and triples of 4, 4, 2 fill."""
    histogram = {s: 1000 for s in (7, 6, 5, 4, 3)}
    assert sum(packing.plan(histogram, 10).values()) <= 1.02 * 2500


def test_knapsack_against_all_choices():
    rng = random.Random(4)
    for _ in range(50):
        lengths = np.array(sorted({rng.randint(1, 9) for _ in range(4)}, reverse=True))
        prices, limits = np.array([rng.random() for _ in lengths]), np.array([rng.randint(1, 3) for _ in lengths])
        counts = packing._knapsack(lengths, prices, limits, 15)
        assert (counts @ lengths) <= 15 and (counts <= limits).all()
        choices = np.array(np.meshgrid(*[np.arange(n + 1) for n in limits])).reshape(len(lengths), -1).T
        assert np.isclose(counts @ prices, (choices @ prices)[choices @ lengths <= 15].max())
