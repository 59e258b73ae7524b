import math
import random
import re
import string
from collections import Counter

import pytest
from pyspark.sql import functions as F

from riverload.llm import secrets as s

ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)
SCHEMA = "doc_id long, text string, spans int, base string"


def brute_base(text):
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return [(s.KINDS[k], a, b, True) for a, k, b in sorted(out)]


def found(spark, texts, **options):
    df = spark.createDataFrame([(i, t, 0, "clash") for i, t in enumerate(texts)], SCHEMA)
    rows = s.find_secrets(df, **options).collect()
    assert len(rows) == len(texts)
    return [[tuple(x) for x in r.spans] for r in sorted(rows, key=lambda r: r.doc_id)]


def test_base_against_plain_patterns(spark):
    rng = random.Random(1)
    parts = ["token", "Secret", "api_key", "APIKEY", "passwd", "password", '"', "'", " ", " ", "=", ":", "= ", "abc", "abcdef", "0123456789abcdef", "AKIA", "ABCDEFGH12345678",
             "é", "𝄞", "\n", ".", "/x", "ſecret", "K"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(16))) for _ in range(1500)]
    for text, spans in zip(texts, found(spark, texts)):
        assert [x for x in spans if x[3]] == brute_base(text), text


def random_token(rng, alphabet, n):
    return "".join(rng.choice(alphabet) for _ in range(n))


WRITTEN = ["InternationalizationConfigurationFactoryBean", "/usr/local/share/applications/defaults", "this_is_a_very_long_identifier_name", "donaudampfschifffahrtsgesellschaft",
           "-" * 60, "_" * 44, "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "abcdefghijklmnopqrstuvwxyz0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789",
           "01010101010101010101010101010101010101", "20240101000000000000000000000001", "12345678901234567890123456789012345678901234567890", "a1a1a1a1a1a1a1a1a1a1a1a1a1a1a1a1a1a1a1a1"]


def test_random_runs_are_found_and_written_ones_are_not(spark):
    rng = random.Random(7)
    kinds = [(string.ascii_letters + string.digits + "+/", 44), (string.ascii_letters + string.digits, 40), (string.ascii_letters + string.digits + "-_", 64),
             (string.ascii_uppercase + "234567", 52), ("0123456789ABCDEF", 64)]
    tokens = [random_token(rng, a, n) for a, n in kinds for _ in range(12)]
    texts = [f"see {t} here" for t in tokens] + [f"see {w} here" for w in WRITTEN * 3]
    got = found(spark, texts)
    caught = sum(("random", 4, 4 + len(t), False) in spans for t, spans in zip(tokens, got))
    assert caught >= 0.9 * len(tokens)
    assert not any(x[0] == "random" for spans in got[len(tokens):] for x in spans)


def test_short_runs_among_many_written_ones_stay(spark):
    """A run of little information is a discovery only where few others of its class are not."""
    rng = random.Random(3)
    short = random_token(rng, string.ascii_lowercase, 20)
    assert found(spark, [f"x {short} x"] + ["governmentalizationsprocess"] * 40)[0] == []


def test_a_run_in_a_base_span_adds_nothing(spark):
    rng = random.Random(4)
    tokens = [random_token(rng, string.ascii_letters + string.digits, 60) for _ in range(10)]
    got = found(spark, [f"token={t} and {t}" for t in tokens])
    assert all([x[0] for x in spans] == ["assign", "random"] and spans[1][1] == 6 + 60 + 5 for spans in got)


def test_odd_rows(spark):
    long = "x" * 300_000 + " token = abcdefg " + "token=abcdefgh " * 20_000 + "deadbeef" * 50_000
    got = found(spark, [None, "", "token=abcdef", "token=abcdef", long])
    assert got[:4] == [[], [], [("assign", 0, 12, True)], [("assign", 0, 12, True)]]
    assert got[4] == brute_base(long)
    assert found(spark, []) == []
    null_id = spark.createDataFrame([(None, "token=abcdef")] * 2, "doc_id long, text string")
    assert [r.doc_id for r in s.find_secrets(null_id).collect()] == [None, None]


def test_positions_in_code_points(spark):
    texts = ["𝄞é aa b aaa", "", "aa", "b", "a" * 9, "baab" * 700]
    df = spark.createDataFrame(list(enumerate(texts)), "n int, text string").select("n", s.spans_of("text", "a+").alias("x"))
    for r in df.collect():
        assert [tuple(x) for x in r.x] == [(m.start(), m.end(), m[0]) for m in re.finditer("a+", texts[r.n])]


def brute_deviation(run):
    alphabet = next((a for p, a in s.ENCODINGS if re.fullmatch(p, run)), "")
    if not alphabet:
        return None
    n, m = len(run), len(alphabet)
    chi = sum(c * c for c in Counter(run).values()) * m / n - n
    uneven = (1.0 if m == 16 else m * 0.065 - 1) * n
    spread = (m - 1 + uneven - chi) / math.sqrt(2 * (m - 1 + 2 * uneven))
    sides = [alphabet.index(x) < m // 2 for x in run]
    runs, low = 1 + sum(a != b for a, b in zip(sides, sides[1:])), sum(sides)
    pairs = 2 * low * (n - low)
    clustered = -10.0 if not pairs else (0.7 * (pairs / n + 1) - abs(runs - pairs / n - 1)) / math.sqrt(pairs * (pairs - n) / (n * n * (n - 1)))
    values = [alphabet.index(x) for x in run]
    gaps = [x - sum(values) / n for x in values]
    alone = sum(x * x for x in gaps)
    r = min(0.999, abs(sum(a * b for a, b in zip(gaps, gaps[1:])) / alone)) if alone else 0.999
    return n * math.log2(m), min(spread, clustered, (math.atanh(0.8) - math.atanh(r)) * math.sqrt(n - 3))


def test_battery_against_plain_formulas(spark):
    rng = random.Random(5)
    runs = WRITTEN + [random_token(rng, a, n) for _, a in s.ENCODINGS[1:] for n in (20, 41, 300)] + ["a-/" * 20, "A" * 25, "B1" * 30]
    df = spark.createDataFrame(list(enumerate(runs)), "n int, run string").select("n", s.deviation(F.col("run")).alias("d"))
    for r in df.collect():
        expected = brute_deviation(runs[r.n])
        assert (r.d is None) == (expected is None) and (expected is None or tuple(r.d) == pytest.approx(expected)), runs[r.n]


def test_step_up_against_the_procedure(spark):
    rng = random.Random(6)
    rows = [(k, int(min(80, max(0, rng.gauss(m, 8))))) for k, m, n in ((5, 4, 300), (6, 30, 40), (7, 2, 50), (7, 60, 5)) for _ in range(n)]
    got = {r["class"]: r["least"] for r in s.thresholds(spark.createDataFrame(rows, "class int, step int")).collect()}
    for k in {k for k, _ in rows}:
        steps = sorted((x for c, x in rows if c == k), reverse=True)

        def tail(x):
            z = x / s.STEPS
            return 0.5 * math.exp(-z * z / 2) if z < 1 else math.exp(-z * z / 2) / (z * math.sqrt(2 * math.pi))

        passed = [x for i, x in enumerate(steps, 1) if tail(x) <= s.FALSE * i / len(steps)]
        assert got.get(k) == (min(passed) if passed else None)


def test_main_path_is_built_in(spark):
    plan = s.find_secrets(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
