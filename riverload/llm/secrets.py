"""Secrets in texts: keyed assignments, access keys, hex runs, and runs that look random.

Base spans follow fixed patterns. Besides, every long run of letters, digits and the
marks of common encodings is a candidate. The alphabet it is written in is inferred
from its characters, and three tests ask whether it has the structure of something
written or counted: chi-squared over the alphabet (some symbols more often than others),
runs of the alphabet's halves (too few or too many), serial correlation (each symbol near
the one before). Each test's null hypothesis is a structure of at least a given strength,
so a short run, which cannot show that the structure is absent, gets no small
probability. The least of the three deviations counts: all structures have to be ruled
out.

What is reported is chosen by false-discovery control over all candidates of the corpus:
the step-up procedure of Benjamini and Hochberg, within classes of equal information
(powers of two of length times bits a symbol), so that many short candidates do not
raise the bar for long ones. Deviations are rounded down to steps, so a class is a short
table of counts, and its probabilities are upper bounds of the normal tail. Only the
thresholds, one a class, pass the driver.

Built-in functions only.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riverload.stages import Stages

# Base kinds in the order of results, their patterns, and the characters the last group needs.
ASSIGN = r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']? *[:=] *["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "[0-9a-f]{24,}"
LEAST_ASSIGNED = 6
KINDS = ("assign", "access", "hex", "random")

#: Runs that are tested, without the padding at their end; shortest length.
SHORTEST = 20
RUN = f"[A-Za-z0-9+/_-]{{{SHORTEST},}}"

_LOWER, _UPPER, _DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
#: Probability that two letters of a written text are equal.
COINCIDENCE = 0.065
#: Encodings, the first that fits is inferred: its characters as a pattern, its alphabet. Digits alone are no secret.
ENCODINGS = (
    ("[0-9]+", ""),
    ("[0-9a-f]+", _DIGITS + "abcdef"),
    ("[0-9A-F]+", _DIGITS + "ABCDEF"),
    ("[A-Z2-7]+", _UPPER + "234567"),
    ("[a-z]+", _LOWER),
    ("[0-9a-z]+", _DIGITS + _LOWER),
    ("[0-9A-Z]+", _DIGITS + _UPPER),
    ("[A-Za-z]+", _UPPER + _LOWER),
    ("[0-9A-Za-z]+", _UPPER + _LOWER + _DIGITS),
    ("[0-9A-Za-z+/]+", _UPPER + _LOWER + _DIGITS + "+/"),
    ("[0-9A-Za-z_-]+", _UPPER + _LOWER + _DIGITS + "-_"),
)
#: Structures to be ruled out: unevenness of the small alphabets (a written text's in larger ones), share by which runs
#: are too few or many, correlation.
UNEVEN, RUNS_OFF, CORRELATED = 1.0, 0.7, 0.8
#: Steps of a deviation, the largest told apart, and the share of false discoveries.
STEPS, LARGEST, FALSE = 8, 10, 0.05


def given(value: Column, made: Callable[[Column], Column]) -> Column:
    """``made`` of the value, which is computed once: a column used in a lambda would be computed for each element."""
    return F.transform(F.array(value), made)[0]


def scan(items: Column, measure: Callable[[Column], Column], plus: Callable[[Column, Column], Column], zero: Column) -> Column:
    """Array of (``before, item``): with each item the measures of all items before it, added up by ``plus``.

    Made in blocks of about the root of their number, so that very many items take no square of time.
    """
    def listed(rows: Column, value: Callable[[Column], Column]) -> Column:
        none = F.slice(F.transform(rows, lambda x: F.struct(zero.alias("before"), x.alias("item"))), 1, 0)
        return F.aggregate(rows, F.struct(zero.alias("total"), none.alias("all")), lambda done, x: F.struct(
            plus(done["total"], value(x)).alias("total"),
            F.concat(done["all"], F.array(F.struct(done["total"].alias("before"), x.alias("item")))).alias("all")))

    def blocks(rows: Column) -> Column:
        size = F.ceil(F.sqrt(F.size(rows))).cast("int")
        cut = F.transform(F.sequence(F.lit(0), F.floor((F.size(rows) - 1) / size).cast("int")), lambda k: F.slice(rows, k * size + 1, size))
        return given(F.transform(cut, lambda b: listed(b, measure)), lambda inner: F.flatten(F.transform(
            listed(inner, lambda b: b["total"])["all"], lambda o: F.transform(o["item"]["all"], lambda x: F.struct(
                plus(o["before"], x["before"]).alias("before"), x["item"].alias("item"))))))

    return given(items, lambda rows: F.when(F.size(rows) > 0, blocks(rows)).otherwise(F.slice(
        F.transform(rows, lambda x: F.struct(zero.alias("before"), x.alias("item"))), 1, 0)))


def spans_of(text: str | Column, pattern: str) -> Column:
    """Matches of the pattern, array of (``start, end, found``), leftmost first; positions in code points.

    The text between the matches gives their places.
    """
    text = F.col(text) if isinstance(text, str) else text
    steps = F.zip_with(F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda gap, match: F.struct(
        F.length(gap).alias("gap"), F.length(match).alias("size"), match.alias("found")))
    placed = scan(F.filter(steps, lambda s: s["found"].isNotNull()), lambda s: s["gap"] + s["size"], lambda a, b: a + b, F.lit(0))
    spans = F.transform(placed, lambda s: F.struct(
        (s["before"] + s["item"]["gap"]).alias("start"), (s["before"] + s["item"]["gap"] + s["item"]["size"]).alias("end"),
        s["item"]["found"].alias("found")))
    return F.when(F.regexp_like(text, F.lit(pattern)), spans).otherwise(F.array().cast("array<struct<start:int,end:int,found:string>>"))


def base_spans(text: str | Column) -> Column:
    """Array of (``kind, start, end``) of the fixed patterns, by start, then kind as listed."""
    def kept(kind: str, spans: Column) -> Column:
        return F.transform(spans, lambda s: F.struct(
            s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("order"), s["end"].alias("end")))

    assigned = F.filter(spans_of(text, ASSIGN), lambda s: F.length(
        F.regexp_extract(s["found"], ASSIGN, 1)) >= LEAST_ASSIGNED)
    return F.array_sort(F.concat(kept("assign", assigned), kept("access", spans_of(text, ACCESS)), kept("hex", spans_of(text, HEX))))


def deviation(run: Column) -> Column:
    """(``bits``, ``z``): information of the run in its inferred encoding, and the least of its tests' deviations
    from structure; null if no encoding fits."""
    alphabet = reduce(lambda chain, e: chain.when(F.regexp_like(run, F.lit(f"^{e[0]}$")), F.lit(e[1])),
                      ENCODINGS[1:], F.when(F.regexp_like(run, F.lit(f"^{ENCODINGS[0][0]}$")), F.lit(ENCODINGS[0][1])))

    def tests(facts: Column) -> Column:
        n, m = F.length(run), F.length(facts["alphabet"])
        free = m - 1
        uneven = F.when(m == 16, F.lit(UNEVEN)).otherwise(m * COINCIDENCE - 1) * n
        chi = F.aggregate(F.array_distinct(facts["symbols"]), F.lit(0.0), lambda total, s: total + F.pow(
            (n - F.length(F.replace(run, s, F.lit("")))).cast("double"), F.lit(2.0))) * m / n - n
        spread = (free + uneven - chi) / F.sqrt(2 * (free + 2 * uneven))
        half = F.floor(m / 2).cast("int")
        sides = F.call_function("translate", run, facts["alphabet"], F.concat(F.repeat(F.lit("l"), half), F.repeat(F.lit("h"), m - half)))
        return given(F.struct(
            spread.alias("spread"), sides.alias("sides"), F.length(F.replace(sides, F.lit("h"), F.lit(""))).alias("low"),
            F.transform(facts["symbols"], lambda s: F.instr(facts["alphabet"], s).cast("double")).alias("values"), n.alias("n"), m.alias("m")), ordered)

    def ordered(facts: Column) -> Column:
        n, low = facts["n"], facts["low"].cast("double")
        pairs = 2 * low * (n - low)
        runs = 1 + (2 * n - F.length(F.replace(facts["sides"], F.lit("lh"), F.lit(""))) - F.length(F.replace(facts["sides"], F.lit("hl"), F.lit("")))) / 2
        wanted = pairs / n + 1
        clustered = F.when(pairs == 0, F.lit(-float(LARGEST))).otherwise(
            (RUNS_OFF * wanted - F.abs(runs - wanted)) / F.sqrt(pairs * (pairs - n) / (n * n * (n - 1.0))))
        mean = F.aggregate(facts["values"], F.lit(0.0), lambda total, v: total + v) / n
        gaps = given(mean, lambda middle: F.transform(facts["values"], lambda v: v - middle))
        return given(gaps, lambda around: F.struct(
            (n * F.log2(facts["m"])).alias("bits"), F.least(facts["spread"], clustered, serial(around, n)).alias("z")))

    def serial(gaps: Column, n: Column) -> Column:
        together = F.aggregate(F.zip_with(F.slice(gaps, F.lit(1), n - 1), F.slice(gaps, F.lit(2), n - 1), lambda a, b: a * b),
                               F.lit(0.0), lambda total, x: total + x)
        alone = F.aggregate(gaps, F.lit(0.0), lambda total, x: total + x * x)
        r = F.least(F.lit(0.999), F.abs(F.coalesce(F.try_divide(together, alone), F.lit(1.0))))
        return (math.atanh(CORRELATED) - F.atanh(r)) * F.sqrt(n - 3)

    return F.when(F.length(alphabet) > 0, given(F.struct(alphabet.alias("alphabet"), F.split(run, "").alias("symbols")), tests))


def candidates(text: str | Column) -> Column:
    """Array of (``start, end, class, step``): tested runs, class of their information and steps of their deviation."""
    tested = F.transform(spans_of(text, RUN), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), deviation(s["found"]).alias("test")))
    return F.transform(F.filter(tested, lambda s: s["test"].isNotNull()), lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), F.floor(F.log2(s["test"]["bits"])).cast("int").alias("class"),
        F.floor(F.greatest(F.lit(0.0), F.least(F.lit(float(LARGEST)), s["test"]["z"])) * STEPS).cast("int").alias("step")))


def thresholds(tested: DataFrame, share: float = FALSE) -> DataFrame:
    """``class, least``: the smallest step that is a discovery, for each class that has any.

    ``tested``: ``class, step``. At most ``LARGEST * STEPS + 1`` steps a class are counted.
    """
    counts = tested.groupBy("class", "step").agg(F.count(F.lit(1)).alias("n"))
    z = F.col("step") / STEPS
    tail = F.when(z < 1, 0.5 * F.exp(-z * z / 2)).otherwise(F.exp(-z * z / 2) / (z * math.sqrt(2 * math.pi)))
    down = Window.partitionBy("class").orderBy(F.desc("step"))
    whole = Window.partitionBy("class")
    return (counts.withColumn("found", F.sum("n").over(down)).withColumn("all", F.sum("n").over(whole))
            .where(tail * F.col("all") <= share * F.col("found"))
            .groupBy("class").agg(F.min("step").alias("least")))


def find_secrets(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", share: float = FALSE) -> DataFrame:
    """``doc_id, spans``, one row per row: array of (``kind, start, end, base``) by start, then kind as in ``KINDS``, then end.

    Spans are in code points of the whole text, ends exclusive. A missing or empty text
    has none; repeated rows are judged each and count each among the candidates. A
    random run that lies in a base span adds nothing. No rows, no result.
    """
    stages = Stages(docs.sparkSession, "secrets")
    whole = F.coalesce(F.col(text), F.lit(""))
    scanned = stages.write(docs.select(F.col(doc_id).alias("doc_id"), base_spans(whole).alias("base"), candidates(whole).alias("tested")), "scanned")
    passed = thresholds(scanned.select(F.inline("tested")).select("class", "step"), share).collect()  # one row a class, a class a power of two
    found = F.array().cast("array<struct<class:int,least:int>>") if not passed else F.array(*[
        F.struct(F.lit(r["class"]).alias("class"), F.lit(r["least"]).alias("least")) for r in passed])
    last = KINDS.index("random")
    random = F.filter("tested", lambda s: F.exists(found, lambda t: (t["class"] == s["class"]) & (s["step"] >= t["least"])))
    every = F.array_sort(F.concat("base", F.transform(random, lambda s: F.struct(
        s["start"].alias("start"), F.lit(last).alias("order"), s["end"].alias("end")))))
    # With each span the furthest end of the base spans before it.
    reached = scan(every, lambda s: F.when(s["order"] < last, s["end"]).otherwise(0), F.greatest, F.lit(0))
    new = F.filter(reached, lambda s: (s["item"]["order"] < last) | (s["item"]["end"] > s["before"]))
    names = F.array(*map(F.lit, KINDS))
    return scanned.select("doc_id", F.transform(new, lambda s: F.struct(
        F.get(names, s["item"]["order"]).alias("kind"), s["item"]["start"].cast("long").alias("start"),
        s["item"]["end"].cast("long").alias("end"), (s["item"]["order"] < last).alias("base"))).alias("spans"))
