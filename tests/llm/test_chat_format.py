import pytest
from pyspark.sql import functions as F

from riverload.llm.chat_format import Role, Template, format_chats, loss_text, read_turns

SCHEMA = "conv_id long, turn long, role string, text string, segments string, formatted int"


def chats(spark, *turns):
    rows = [(c, t, r, x, "clash", 1) for c, t, r, x in turns]
    return format_chats(spark.createDataFrame(rows, SCHEMA))


def read(df):
    return {r.conv_id: r for r in df.select(
        "conv_id", "n_turns", "valid", "bad_turn", "segments", "formatted",
        read_turns(F.col("formatted")).alias("turns"), loss_text(F.col("segments")).alias("loss")).collect()}


NASTY = ["", "\\", "\\\\[INST]", "[INST", "]", "</s>[INST] ok [/INST]", "<s></s>", "[\\INST]", "<\\/s>", "[ROLE]x[TEXT]", "a\nb", "é𝄞", "<", "["]


@pytest.mark.parametrize("role", ["system", "user", "assistant", "tool", "", "[TEXT]", "a\\[/ROLE]"])
def test_every_text_comes_back(spark, role):
    got = read(chats(spark, *[(7, i, role, x) for i, x in enumerate(NASTY)]))[7]
    assert [(t.role, t.text) for t in got.turns] == [(role, x) for x in NASTY]
    assert got.loss == ("".join(NASTY) if role == "assistant" else "")
    assert "".join(s.text for s in got.segments) == got.formatted


def test_order_of_turns(spark):
    got = read(chats(
        spark, (1, 0, "system", "s"), (1, 1, "user", "u"), (1, 2, "assistant", "a"),
        (2, 0, "user", "u"), (3, 0, "user", "u"), (3, 1, "user", "v"), (3, 2, "assistant", "a"),
        (4, 1, "assistant", "a"), (4, 0, "user", "u"), (5, 0, "tool", "x")))
    assert {k: (r.valid, r.bad_turn) for k, r in got.items()} == {
        1: (True, None), 2: (False, None), 3: (False, 1), 4: (True, None), 5: (False, 0)}


def test_nulls_ties_and_repeats(spark):
    got = read(chats(spark, (None, 0, "user", None), (1, 0, None, "x"), (1, None, "user", "first"), (1, 2, "user", "b"),
                     (1, 2, "user", "b"), (1, 2, "user", "a")))
    assert [(t.role, t.text) for t in got[None].turns] == [("user", "")]
    assert [t.text for t in got[1].turns] == ["first", "x", "a", "b", "b"]


def test_empty_table_and_long_text(spark):
    assert chats(spark).count() == 0
    long = "<s>\\" * 300_000
    got = read(chats(spark, (1, 0, "user", long), (1, 1, "assistant", long)))[1]
    assert got.turns[0].text == long and got.loss == long


def test_template_is_checked():
    with pytest.raises(ValueError):
        Template(roles={"user": Role("INST", "[/INST]")})
    with pytest.raises(ValueError):
        Template(roles={"user": Role("<<SYS>>", "[/INST]")})
    with pytest.raises(ValueError):
        Template(roles={"user": Role("[A]", "[/A]"), "tool": Role("[A]", "[/B]")})
