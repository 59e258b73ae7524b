"""Personal data in plain and disguised form, as spans of the source text.

The base detectors run over the text as it is. Transducers then rewrite it:
look-alike characters, spelled digits and at/dot disguises become plain
characters, and every character of the result keeps the source positions it came
from. The same detectors run over the rewritten text, and what they find is mapped
back. A found span that lies in a base span of its kind adds nothing.

All scans are linear in the text: runs that cannot match are not tried again from
their middle.
"""

from __future__ import annotations

import bisect
import functools
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# Kinds in the order of results.
KINDS = ("email", "ip", "card", "phone")

_LOCAL = "A-Za-z0-9._%+-"
_LOCAL_END = re.compile(f"[{_LOCAL}]*")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DIGIT = re.compile("[0-9]")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

# Letters of other scripts that look like Latin ones.
LOOKALIKES = {
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "Х": "X", "У": "Y",
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "х": "x", "у": "y", "к": "k", "т": "t", "м": "m", "н": "h", "в": "b",
    "І": "I", "і": "i", "Ј": "J", "ј": "j", "Ѕ": "S", "ѕ": "s", "һ": "h", "ԁ": "d", "ԛ": "q", "ԝ": "w", "ь": "b", "г": "r", "п": "n",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X",
    "α": "a", "γ": "y", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x",
    "ı": "i", "ɑ": "a", "ɡ": "g", "ɩ": "i", "օ": "o", "ո": "n", "ս": "u", "հ": "h", "ց": "g",
    "‐": "-", "‑": "-", "‒": "-", "–": "-", "—": "-", "―": "-", "−": "-", "․": ".", "。": ".", "·": ".", "•": ".", "∙": ".",
}
#: Characters without width, dropped.
INVISIBLE = "\u00ad\u034f\u061c\u180e\u200b\u200c\u200d\u200e\u200f\u2060\ufeff"

# Words for digits.
DIGIT_WORDS = {
    "zero": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9",
    "zéro": "0", "un": "1", "deux": "2", "trois": "3", "quatre": "4", "cinq": "5", "sept": "7", "huit": "8", "neuf": "9",
    "null": "0", "eins": "1", "zwei": "2", "zwo": "2", "drei": "3", "vier": "4", "fünf": "5", "sechs": "6", "sieben": "7", "acht": "8", "neun": "9",
    "cero": "0", "uno": "1", "dos": "2", "tres": "3", "cuatro": "4", "cinco": "5", "seis": "6", "siete": "7", "ocho": "8", "nueve": "9",
    "oh": "0",
}
_DOT_WORD = "dot|punkt|punto|point"
_AT_WORD = "at|arroba|arobase"

_OPEN, _CLOSE = r"[\[({<]", r"[\])}>]"
_BRACKETED = re.compile(
    rf"[ \t]*{_OPEN}[ \t]*(?:(?P<at>{_AT_WORD}|@)|(?P<dot>{_DOT_WORD}|\.))[ \t]*{_CLOSE}[ \t]*"
    r"|&(?:#0*64|#x0*40|commat);(?P<at2>)|&(?:#0*46|#x0*2e|period);(?P<dot2>)", re.I)
_L, _D, _S = f"[{_LOCAL}]", "[A-Za-z0-9-]", "[ \t]+"
# 31 and 126 dots are the most that a local part of 64 and a domain of 253 characters can have.
_BARE = re.compile(
    rf"(?<!{_L}){_L}++(?:{_S}(?:{_DOT_WORD}){_S}{_L}++){{0,31}}+{_S}(?:{_AT_WORD}){_S}{_D}++(?:{_S}(?:{_DOT_WORD}){_S}{_D}++){{1,126}}"
    rf"|(?<!{_L}){_L}++(?:{_S}(?:{_DOT_WORD}){_S}{_L}++){{1,31}}+[ \t]*@[ \t]*{_D}++(?:(?:{_S}(?:{_DOT_WORD}){_S}|\.){_D}++){{1,126}}"
    rf"|(?<!{_L}){_L}++[ \t]*@[ \t]*{_D}++(?:{_S}(?:{_DOT_WORD}){_S}{_D}++){{1,126}}", re.I)
_BARE_MARK = re.compile(rf"{_S}(?:(?P<at>{_AT_WORD})|(?P<dot>{_DOT_WORD})){_S}|[ \t]*(?P<at2>@)[ \t]*", re.I)

_DOT_MARK = re.compile(rf"[ \t](?:{_DOT_WORD})[ \t]", re.I)
_AT_MARK = re.compile(rf"@|[ \t](?:{_AT_WORD})[ \t]", re.I)
_BRACKET_HINT = re.compile(rf"{_OPEN}[ \t]*(?:{_AT_WORD}|{_DOT_WORD}|[@.])[ \t]*{_CLOSE}|&(?:#|commat;|period;)")
_NO_WIDTH = re.compile(f"[{INVISIBLE}]")

_WORDS = "|".join(sorted(DIGIT_WORDS, key=len, reverse=True))
_SPELLED = re.compile(
    rf"(?<!\w)(?:(?:plus|\+)[ \t-]*)?+(?:(?:{_WORDS})|[0-9]+)(?!\w)"
    rf"(?:(?:[ \t,-]*|[ \t]*(?:\.|(?<!\w)(?:{_DOT_WORD})(?!\w))[ \t]*)(?<!\w)(?:(?:{_WORDS})|[0-9]+)(?!\w)){{3,}}+", re.I)
_SPELLED_PART = re.compile(rf"(?P<word>(?<!\w)(?:{_WORDS})(?!\w))|(?P<plus>plus[ \t-]*)|(?P<dot>[ \t]*(?:{_DOT_WORD}|\.)[ \t]*)|(?P<gap>[ \t,-]+)|[0-9]+|\+", re.I)
_SPELLED_HINT = re.compile(rf"(?<!\w)(?:{_WORDS})[ \t,.-]+(?:(?:{_DOT_WORD})[ \t]+)?(?:(?:{_WORDS})|[0-9]+)(?!\w)")


@functools.cache
def _folds() -> dict[str, str]:
    """What becomes of single characters.

    Besides the listed look-alikes: digits of any script, spaces of any width, and
    characters whose compatibility form is one printable ASCII character.
    """
    table = dict(LOOKALIKES) | dict.fromkeys(INVISIBLE, "")
    for code in range(0x80, 0x20000):
        char = chr(code)
        if char in table:
            continue
        kind = unicodedata.category(char)
        if kind == "Nd":
            table[char] = str(unicodedata.digit(char))
        elif kind == "Zs":
            table[char] = " "
        elif len(plain := unicodedata.normalize("NFKC", char)) == 1 and "!" <= plain <= "~":
            table[char] = plain
    return table


@functools.cache
def _same_size() -> dict[int, str]:
    """The folds that keep positions, for ``str.translate``."""
    return {ord(old): new for old, new in _folds().items() if new}


class Tape:
    """A text, and for each of its characters where it starts and ends in the source."""

    def __init__(self, text: str, starts: list[int] | None = None, ends: list[int] | None = None):
        self.text = text
        self.starts = starts if starts is not None else list(range(len(text)))
        self.ends = ends if ends is not None else list(range(1, len(text) + 1))

    def rewrite(self, changes: list[tuple[int, int, str]]) -> Tape:
        """Replace parts, given in order; each new character covers its whole part."""
        text, starts, ends, at = [], [], [], 0
        for start, end, new in changes:
            text += (self.text[at:start], new)
            starts += self.starts[at:start]
            ends += self.ends[at:start]
            starts += [self.starts[start]] * len(new)
            ends += [self.ends[end - 1]] * len(new)
            at = end
        text.append(self.text[at:])
        return Tape("".join(text), starts + self.starts[at:], ends + self.ends[at:])


def detect(text: str) -> list[tuple[str, int, int]]:
    """Base spans (kind, start, end), leftmost and not overlapping within a kind."""
    found = []
    if "@" in text:
        backwards, taken, size = text[::-1], 0, len(text)
        at = text.find("@")
        while at >= 0:
            run = _LOCAL_END.match(backwards, size - at, size - taken).end()
            domain = _DOMAIN.match(text, at + 1) if run > size - at else None
            if domain:
                found.append(("email", size - run, taken := domain.end()))
            at = text.find("@", max(at + 1, taken))
    if _DIGIT.search(text):
        for m in _DOTTED.finditer(text):
            if m[0].count(".") >= 3:
                start, parts = m.start(), m[0].split(".")
                for i in range(0, len(parts) - 3, 4):
                    four = parts[i:i + 4]
                    size = sum(map(len, four)) + 3
                    if all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in four):
                        found.append(("ip", start, start + size))
                    start += size + 1
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 14:
                digits = [int(c) for c in m[0] if c not in " -"] if m.end() - m.start() <= 37 else []
                if 14 <= len(digits) <= 19 and _luhn(digits):
                    found.append(("card", *m.span()))
        for m in _PHONE.finditer(text):
            if 10 <= sum(c in "0123456789" for c in m[0]) <= 15:
                found.append(("phone", *m.span()))
    return found


def _luhn(digits: list[int]) -> bool:
    total = sum(digits[-1::-2])
    for d in digits[-2::-2]:
        total += 2 * d - 9 * (d > 4)
    return total % 10 == 0


def _folded(text: str) -> Tape | None:
    """The text with its look-alikes replaced and characters without width dropped, None if it has none."""
    if text.isascii() or _folds().keys().isdisjoint(text):
        return None
    tape = Tape(text.translate(_same_size()))
    if not _NO_WIDTH.search(text):
        return tape
    return tape.rewrite([(m.start(), m.end(), "") for m in _NO_WIDTH.finditer(text)])


def _bare(text: str) -> Iterator[re.Match]:
    """Addresses written out in words; each lies within a line and has a word for a dot."""
    done = 0
    for mark in _DOT_MARK.finditer(text):
        if mark.start() >= done:
            first, end = max(done, text.rfind("\n", 0, mark.start()) + 1), text.find("\n", mark.end())
            done = end if end >= 0 else len(text)
            if _AT_MARK.search(text, first, done):
                yield from _BARE.finditer(text, first, done)


def plain(text: str) -> Tape | None:
    """The text without its disguises, None if it has none."""
    tape = _folded(text)
    now = tape.text if tape else text
    low = now.lower()
    if _BRACKET_HINT.search(low):
        changes = [(m.start(), m.end(), "@" if m["at"] or m["at2"] is not None else ".") for m in _BRACKETED.finditer(now)]
        if changes:
            tape = (tape or Tape(text)).rewrite(changes)
            now = tape.text
            low = now.lower()
    if any(w in low for w in _DOT_WORD.split("|")):
        changes = [(m.start() + p.start(), m.start() + p.end(), "." if p["dot"] else "@")
                   for m in _bare(now) for p in _BARE_MARK.finditer(m[0])]
        if changes:
            tape = (tape or Tape(text)).rewrite(changes)
            now = tape.text
            low = now.lower()
    if _SPELLED_HINT.search(low):
        changes = [change for m in _SPELLED.finditer(now) for change in _digits(m)]
        if changes:
            tape = (tape or Tape(text)).rewrite(changes)
    return tape


def _digits(run: re.Match) -> Iterator[tuple[int, int, str]]:
    """Changes that turn one run of spelled digits into digits; none if it has no word."""
    parts = list(_SPELLED_PART.finditer(run[0]))
    if any(p["word"] for p in parts):
        for i, p in enumerate(parts):
            at = run.start() + p.start(), run.start() + p.end()
            if p["word"]:
                yield *at, DIGIT_WORDS[p[0].lower()]
            elif p["plus"]:
                yield *at, "+"
            elif p["dot"]:
                yield *at, "."
            elif p["gap"] and (parts[i - 1]["word"] or i + 1 < len(parts) and parts[i + 1]["word"]):
                yield *at, ""


def spans(text: str | None) -> list[tuple[str, int, int, bool]]:
    """All spans (kind, start, end, base) by start, then kind, then end."""
    if not text:
        return []
    base = detect(text)
    found = [(*s, True) for s in base]
    tape = plain(text)
    if tape:
        # Spans of a kind follow one another, so only the last that starts before can hold another one.
        starts, ends = ({k: [s[i] for s in base if s[0] == k] for k in KINDS} for i in (1, 2))
        for kind, start, end in dict.fromkeys(
                (k, tape.starts[s], tape.ends[e - 1]) for k, s, e in detect(tape.text)):
            before = bisect.bisect_right(starts[kind], start)
            if not before or ends[kind][before - 1] < end:
                found.append((kind, start, end, False))
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))


def personal_spans(text: str | Column) -> Column:
    """Column of spans, array of (``kind``, ``start``, ``end``, ``base``), in code points of the whole text.

    Empty for a missing or empty text. Being a column, it leaves all rows and
    other columns as they are. Texts of any length are searched whole, in time that
    grows with their length. An address written out in words has at most 31 dots before
    its "at" and 126 after it, as many as a local part of 64 and a domain of 253
    characters can have; plain addresses have no such limit.
    """
    def find(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        names = ("kind", "start", "end", "base")
        for batch in batches:
            yield pa.array([[dict(zip(names, s)) for s in spans(t.as_py())] for t in batch], _TYPE)

    return F.arrow_udf(find, "array<struct<kind string, start long, end long, base boolean>>")(text)
