"""Conversations as training text, by a declarative template.

A finite-state machine over the roles validates the order of turns. Each turn
becomes segments of text with a loss flag. Control strings inside texts are
escaped by a backslash after their first character, and backslashes doubled, so
the formatted string can be read back without loss. Built-in functions only.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Role:
    """Marks around a turn's text, and whether the text is learned."""

    opens: str
    closes: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    """Marks of the conversation and its turns, and the legal order of roles.

    ``other`` marks turns of roles the template does not name: the name stands
    between ``other.opens`` and ``named``. ``moves`` gives the next state by
    (state, role); the conversation is valid if it ends in ``accepts``.

    Each mark starts with a bracket and holds no second one, so that text next to
    a mark can never form another mark with it.
    """

    begin: str = "<s>"
    roles: dict[str, Role] = field(default_factory=lambda: {
        "system": Role("[SYS]", "[/SYS]"),
        "user": Role("[INST]", "[/INST]"),
        "assistant": Role("[OUT]", "</s>", loss=True),
    })
    other: Role = Role("[ROLE]", "[/ROLE]")
    named: str = "[TEXT]"
    start: str = "start"
    accepts: tuple[str, ...] = ("answered",)
    moves: dict[tuple[str, str], str] = field(default_factory=lambda: {
        ("start", "system"): "instructed",
        ("start", "user"): "asked",
        ("instructed", "user"): "asked",
        ("asked", "assistant"): "answered",
        ("answered", "user"): "asked",
    })

    def __post_init__(self):
        for mark in self.marks:
            if len(mark) < 2 or mark[0] not in "<[" or any(c in "<[\\" for c in mark[1:]):
                raise ValueError(f"mark {mark!r} must start with < or [ and hold no other, nor a backslash")
        opens = [r.opens for r in (*self.roles.values(), self.other)]
        if len(set(opens)) < len(opens):
            raise ValueError("two roles open alike")

    @property
    def marks(self) -> list[str]:
        both = [m for r in (*self.roles.values(), self.other) for m in (r.opens, r.closes)]
        return list(dict.fromkeys([self.begin, *both, self.named]))


def escape(text: Column, template: Template) -> Column:
    """Text in which no mark of the template occurs."""
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for mark in template.marks:
        text = F.replace(text, F.lit(mark), F.lit(f"{mark[0]}\\{mark[1:]}"))
    return text


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(\\?)", "$1")


def format_chats(turns: DataFrame, template: Template = Template()) -> DataFrame:
    """One row per conversation: ``conv_id, n_turns, valid, bad_turn, segments, formatted``.

    ``turns``: ``conv_id, turn, role, text``. Turns are ordered by number, then
    role and text, missing numbers first; repeated rows are turns of their own. A
    missing role or text is empty. ``segments`` is an array of (``text``, ``loss``)
    whose texts joined are ``formatted``. ``bad_turn`` is the place, from 0, of
    the first turn the machine does not accept, null if there is none; a
    conversation that only ends too early is not ``valid`` but has no such turn.
    Turns without ``conv_id`` form one conversation. No turns, no rows.

    A conversation is one row and so is put together by one task.
    """
    clean = turns.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    chats = clean.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))

    moves = F.create_map(*[F.lit(x) for (state, role), to in template.moves.items() for x in (f"{state}\n{role}", to)])

    def move(at: Column, turn: Column) -> Column:
        to = F.when(at["bad"].isNull(), F.try_element_at(moves, F.concat(at["state"], F.lit("\n"), turn["role"])))
        return F.struct(
            F.coalesce(to, at["state"]).alias("state"), (at["place"] + 1).alias("place"),
            F.coalesce(at["bad"], F.when(to.isNull(), at["place"])).alias("bad"))

    walked = F.aggregate(
        "turns", F.struct(F.lit(template.start).alias("state"), F.lit(0).alias("place"), F.lit(None).cast("int").alias("bad")), move)

    def by_role(turn: Column, of, other: Column) -> Column:
        value = other
        for name, role in template.roles.items():
            value = F.when(turn["role"] == name, of(role)).otherwise(value)
        return value

    def segment(text: Column, loss: Column) -> Column:
        return F.struct(text.alias("text"), loss.alias("loss"))

    def emit(turn: Column) -> Column:
        no = F.lit(False)
        other = F.concat(F.lit(template.other.opens), escape(turn["role"], template), F.lit(template.named))
        return F.array(
            segment(by_role(turn, lambda r: F.lit(r.opens), other), no),
            segment(escape(turn["text"], template), by_role(turn, lambda r: F.lit(r.loss), F.lit(template.other.loss))),
            segment(by_role(turn, lambda r: F.lit(r.closes), F.lit(template.other.closes)), no))

    segments = F.concat(F.array(segment(F.lit(template.begin), F.lit(False))), F.flatten(F.transform("turns", emit)))
    made = chats.select("conv_id", F.size("turns").cast("long").alias("n_turns"), walked.alias("walked"), segments.alias("segments"))
    return made.select(
        "conv_id", "n_turns",
        (F.col("walked.bad").isNull() & F.col("walked.state").isin(*template.accepts)).alias("valid"),
        F.col("walked.bad").alias("bad_turn"), "segments",
        F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"))


def read_turns(formatted: Column, template: Template = Template()) -> Column:
    """The turns, array of (``role``, ``text``), that a formatted string holds."""
    opens = {name: r.opens for name, r in template.roles.items()}
    quoted = [_quoted(m) for m in (*opens.values(), template.other.opens)]
    parts = F.filter(F.split(formatted, f"(?={'|'.join(quoted)})"), lambda p: p != template.begin)

    def read(part: Column) -> Column:
        body = F.substring_index(F.substring(part, F.lit(len(template.other.opens) + 1), F.length(part)), template.other.closes, 1)
        turn = F.struct(
            unescape(F.substring_index(body, template.named, 1)).alias("role"),
            unescape(F.substring(body, F.instr(body, template.named) + len(template.named), F.length(body))).alias("text"))
        for name, role in template.roles.items():
            inner = F.substring_index(F.substring(part, F.lit(len(role.opens) + 1), F.length(part)), role.closes, 1)
            turn = F.when(part.startswith(role.opens), F.struct(F.lit(name).alias("role"), unescape(inner).alias("text"))).otherwise(turn)
        return turn

    return F.transform(parts, read)


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")


def _quoted(mark: str) -> str:
    return "".join(c if c.isalnum() else f"\\{c}" for c in mark)
