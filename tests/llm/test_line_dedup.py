from pyspark.sql import functions as F

from riverload.llm.line_dedup import drop_shared_lines, line_hashes, shared_lines

LINE = "Cookies are used on this site."
SCHEMA = "doc_id long, text string, source string, removed_lines string, _x int"


def clean(spark, rows, **options):
    df = spark.createDataFrame([(i, t, s, "clash", 1) for i, t, s in rows], SCHEMA)
    return sorted(((r.doc_id, r.text, r.shared_lines, r.removed_lines, r.removed_chars) for r in drop_shared_lines(df, **options).collect()), key=str)


def body(i):
    return f"Document number {i} has a line of its own,\n\nand another line {i} that no other has."


def test_lines_of_many_sites_go(spark):
    rows = [(i, f"{LINE}\n{body(i)}\n  {LINE} ", f"s{i % 3}") for i in range(9)]
    assert clean(spark, rows, min_sites=3) == sorted(((i, body(i), 2, 2, 2 * len(LINE)) for i in range(9)), key=str)
    assert all(r[3] == 0 and r[2] == 0 for r in clean(spark, rows, min_sites=4))


def test_copies_and_short_lines_stay_if_asked(spark):
    rows = [(i, body(0), f"s{i}") for i in range(5)] + [(9 + i, f"Yes.\n{body(9 + i)}", f"s{i}") for i in range(5)]
    asked = clean(spark, rows, min_sites=3, min_chars=20, copy_share=0.5)
    assert {(r[1], r[3]) for r in asked} == {(t, 0) for _, t, _ in rows}
    assert {r[2] for r in asked if r[0] < 5} == {2}
    assert {(r[1], r[3]) for r in clean(spark, rows, min_sites=3)} == {("", 2)} | {(t.split("\n", 1)[1], 1) for _, t, _ in rows[5:]}


def test_odd_rows(spark):
    rows = [(None, f"{LINE}\n{body(1)}", "a"), (2, f"{LINE}\n{body(2)}", None), (2, f"{LINE}\n{body(2)}", None), (3, f"{LINE}\n{body(3)}", "b"),
            (4, None, "c"), (5, "", "c"), (6, "\n\n", "c"), (7, "long line of words " * 100_000 + f"\n{LINE}", "d"), (8, f"{LINE}\n" * 20_000 + "own words\n" * 100_000, "e")]
    got = clean(spark, rows, min_sites=3)
    assert len(got) == len(rows)
    by = {r[0]: r for r in got}
    assert by[None][1] == body(1) and by[2][1] == body(2) and sum(r[0] == 2 for r in got) == 2
    assert by[4][1] is None and by[5][1] == "" and by[6][1] == "\n\n"
    assert by[7][1] == "long line of words " * 100_000 and by[8][1] == "own words\n" * 100_000 and by[8][3] == 20_000
    assert clean(spark, []) == []


def test_exact_at_the_threshold(spark):
    """Around a threshold of thousands the sketch errs; the exact count does not."""
    n = 5000
    rows = spark.range(3).join(spark.range(n + 5).withColumnRenamed("id", "site"), F.col("site") < n - 1 + F.col("id"))
    lines = rows.select(F.concat(F.lit("line "), F.col("id")).alias("text"), F.col("site").cast("string"))
    lines = lines.select("site", F.explode(line_hashes(F.col("text"))).alias("l")).select("site", "l.h1", "l.h2")
    assert shared_lines(lines, n).count() == 2
    assert shared_lines(lines, n + 1, lg_k=8).count() == 1
