import random
import re

from riverload.llm.pii import KINDS, detect, personal_spans, spans

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def brute(text):
    def luhn(digits):
        return sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(reversed(digits))) % 10 == 0

    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        d = [int(c) for c in m[0] if c.isdigit()]
        if 14 <= len(d) <= 19 and luhn(d):
            out.append(("card", *m.span()))
    return out + [("phone", *m.span()) for m in PHONE.finditer(text) if 10 <= sum(c.isdigit() for c in m[0]) <= 15]


def test_base_against_plain_patterns():
    rng = random.Random(5)
    words = ["a@b.c", "@", ".", "_", "1.2.3.4", "256", "4111 1111 1111 1111", "4111-1111", "+", "(0)", " ", "-", "x", "é", "+49 171 1234567", "00", "\n", "1"]
    for _ in range(6000):
        text = "".join(rng.choice(words) for _ in range(rng.randrange(14)))
        assert sorted(detect(text)) == sorted(brute(text)), text


def found(text):
    return [(k, text[s:e], base) for k, s, e, base in spans(text)]


def test_disguises():
    assert found("mail john [at] example [dot] com now") == [("email", "john [at] example [dot] com", False)]
    assert found("mail john.doe(at)example.com now") == [("email", "john.doe(at)example.com", False)]
    assert found("john dot doe at mail dot example dot org!") == [("email", "john dot doe at mail dot example dot org", False)]
    assert found("x JOHN AT EXAMPLE DOT COM x") == [("email", "JOHN AT EXAMPLE DOT COM", False)]
    assert found("john&#64;example&#46;com") == [("email", "john&#64;example&#46;com", False)]
    assert found("john @ example dot com") == [("email", "john @ example dot com", False)]
    assert found("ｊｏｈｎ＠ｅｘａｍｐｌｅ．ｃｏｍ") == [("email", "ｊｏｈｎ＠ｅｘａｍｐｌｅ．ｃｏｍ", False)]
    assert found("ip one nine two dot one six eight dot zero dot one.") == [("ip", "one nine two dot one six eight dot zero dot one", False)]
    assert found("call plus four nine one seven one two three four five six seven, ok") == [
        ("phone", "plus four nine one seven one two three four five six seven", False)]
    assert found("card four one one one-one one one one one one one one one one one one") == [
        ("card", "four one one one-one one one one one one one one one one one one", False)]
    assert found("٤١١١١١١١١١١١١١١١") == [("card", "٤١١١١١١١١١١١١١١١", False)]
    assert found("+49 171 1234567") == [("phone", "+49 171 1234567", False)]


def test_base_spans_stay_and_wider_ones_are_added():
    text = "іvan@example.com, a​@b.com"
    assert found(text) == [("email", "іvan@example.com", False), ("email", "van@example.com", True), ("email", "a​@b.com", False)]
    both = "a@b.c and john at example dot com"
    assert found(both) == [("email", "a@b.c", True), ("email", "john at example dot com", False)]


def test_ordinary_text_stays_clean():
    for text in ("He was at home. Then at point five.", "one two three four five", "look at the dot", "(at) [dot]", "Привет, мир", "un deux trois",
                 "meet at example.com", "a dot b dot c", "cinq, six, sept", "1, 2, 3, 4"):
        assert spans(text) == [], text


DISGUISES = {
    "email": [
        lambda rng, t: t.replace("@", rng.choice([" [at] ", "(at)", " { at } ", "&#64;", "&commat;", "[@]", "＠"])),
        lambda rng, t: t.replace("@", rng.choice(["(at)", " [arroba] "])).replace(".", rng.choice([" [dot] ", "(punto)", "[.]"])),
        lambda rng, t: t.replace("@", rng.choice([" at ", " AT ", "\t arobase "])).replace(".", rng.choice([" dot ", " Punkt ", "  point "])),
        lambda rng, t: t.replace("a", "а").replace("o", "ο").replace("e", "е"),
        lambda rng, t: "".join(chr(ord(c) + 0xFEE0) for c in t),
        lambda rng, t: t[0] + "\u200b" + t[1:],
    ],
    "ip": [
        lambda rng, t: t.replace(".", rng.choice(["[.]", " (dot) ", "․"])),
        lambda rng, t: "".join(chr(0x660 + int(c)) if c.isdigit() else c for c in t),
        lambda rng, t: " ".join("dot" if c == "." else SPELLED[int(c)] for c in t),
    ],
    "card": [
        lambda rng, t: rng.choice([" ", "-", ", "]).join(SPELLED[int(c)] for c in t),
        lambda rng, t: "".join(chr(0x1D7CE + int(c)) for c in t),
        lambda rng, t: t[:4] + "\u00a0" + t[4:8] + "‑" + t[8:],
    ],
    "phone": [
        lambda rng, t: "plus " + " ".join(SPELLED[int(c)] for c in t[1:]),
        lambda rng, t: t[:3] + "\u2009" + t[3:6] + "–" + t[6:],
    ],
}
SPELLED = "zero one two three four five six seven eight nine".split()


def test_identifiers_disguised_at_random():
    """Base spans of plain texts, disguised: found where they stand in the source."""
    rng = random.Random(11)

    def card():
        digits = [rng.randrange(10) for _ in range(15)]
        return "".join(map(str, digits)) + next(str(k) for k in range(10) if len(detect("".join(map(str, digits)) + str(k))) == 1)

    made = {"email": lambda: f"{rng.choice(['jane', 'pool.boy', 'aeon'])}@{rng.choice(['example.com', 'mail.example.org'])}",
            "ip": lambda: ".".join(str(rng.randrange(100, 256)) for _ in range(4)), "card": card, "phone": lambda: f"+{rng.randrange(10**10, 10**12)}"}
    fillers = ["Ordinary words; ", "Кто там? ", "x\n", "日本語 text: ", "(see) ", "naïve café, "]
    for _ in range(1500):
        text, expected = "", []
        for _ in range(rng.randrange(1, 6)):
            text += "".join(rng.choices(fillers, k=2))
            kind = rng.choice(KINDS)
            plain = made[kind]()
            assert detect(plain) == [(kind, 0, len(plain))]
            hidden = rng.choice(DISGUISES[kind])(rng, plain)
            expected.append((kind, len(text), len(text) + len(hidden)))
            text += hidden + rng.choice(["; ", "\n", " | "])
        got = [s[:3] for s in spans(text)]
        assert set(expected) <= set(got), (text, set(expected) - set(got))


def test_plain_among_disguised_addresses_is_linear():
    n = 40_000
    found = spans("a@b.c, x at y dot org; " * n)
    assert len(found) == 2 * n and sum(base for *_, base in found) == n


def test_long_runs_are_linear():
    n = 200_000
    for text in ("a" * n, "1" * n, "1." * n, "a@" * n, "1 " * n, "a dot " * n, "one " * n, "+1" * n, "(at)" * n, "@" * n, "a at b dot " * n):
        spans(text)


def test_column(spark):
    rows = [(1, "x@y.z", 1), (1, "x@y.z", 1), (None, None, 2), (2, "", 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, spans int")
    got = df.select("doc_id", personal_spans("text").alias("s")).collect()
    assert sorted((str(r.doc_id), [tuple(s) for s in r.s]) for r in got) == sorted(
        (str(i), [("email", 0, 5, True)] if t else []) for i, t, _ in rows)
    assert df.limit(0).select(personal_spans("text")).count() == 0
    assert KINDS == ("email", "ip", "card", "phone")


def test_query_against_plain_patterns(spark):
    import hashlib

    import __spark_entry__ as contract

    sf = "/root/testdata/sf0.001"
    got = {r.doc_id: r for r in contract.queries()["op9_pii"](spark, sf).collect()}
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert got.keys() == texts.keys()
    for i, text in texts.items():
        base = sorted(brute(text), key=lambda s: (s[1], KINDS.index(s[0])))
        told = ",".join(f"{k}:{s}:{e}" for k, s, e in base)
        assert got[i].base_sha256 == hashlib.sha256(told.encode()).hexdigest()
        assert set(told.split(",")) <= set(got[i].spans.split(","))
        assert [got[i][f"n_{k}"] for k in KINDS] == [got[i].spans.count(f"{k}:") for k in KINDS]
