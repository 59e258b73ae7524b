"""Number of tokens a unigram tokenizer makes of a text, without making them.

An Aho-Corasick automaton enumerates all vocabulary pieces that occur in a word;
dynamic programming over the end positions carries the best score and its number
of pieces. The rules are those of ``tokenizers.models.Unigram`` behind a
``Metaspace`` pre-tokenizer that prepends and splits: scores are added from left
to right in doubles, of equal scores the longest last piece wins, a character
without a piece of its own may be unknown at 10 below the lowest score, unknown
characters in a row are one token, or their UTF-8 bytes are with byte fallback.

Words are independent, so each task remembers the counts of words it has met; the
memory is bounded and only saves work.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

MARK = "▁"
PENALTY = 10.0
#: Words remembered by a task, and the longest of them.
REMEMBERED, LONGEST = 200_000, 64


@dataclass(frozen=True)
class Vocabulary:
    """Pieces with scores; ``unknown`` is the place of the unknown piece."""

    pieces: tuple[tuple[str, float], ...]
    unknown: int = 0
    byte_fallback: bool = False

    def __post_init__(self):
        have = sum(f"<0x{b:02X}>" in {p for p, _ in self.pieces} for b in range(256)) if self.byte_fallback else 256
        if have < 256:
            raise ValueError(f"byte fallback needs all 256 byte pieces, there are {have}")


def ranked_vocabulary(path: str) -> Vocabulary:
    """The pieces of a SentencePiece model file, scored by their rank as Zipf's law has it.

    Public model files of this kind hold merge ranks and no probabilities, so the
    score of the piece with id ``i`` is ``-log(i + 1)``.
    """
    import math

    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return Vocabulary(tuple((model.id_to_piece(i), -math.log(i + 1)) for i in range(model.get_piece_size())),
                      model.unk_id(), True)


class Counter:
    """Counts of whole texts under one vocabulary."""

    def __init__(self, vocabulary: Vocabulary):
        import ahocorasick

        scores = dict(vocabulary.pieces)
        self.automaton = ahocorasick.Automaton()
        for piece, score in scores.items():
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.single = {p for p in scores if len(p) == 1}
        self.unknown = min(scores.values()) - PENALTY
        self.bytes = vocabulary.byte_fallback
        self.known: dict[str, int] = {}

    def text(self, text: str | None) -> int:
        if not text:
            return 0
        words = text.replace(" ", MARK).split(MARK) if MARK in text else text.split(" ")
        if not words[0]:
            words = words[1:]
        return sum(map(self.word, words))

    def word(self, word: str) -> int:
        count = self.known.get(word)
        if count is None:
            count = self.pieces(MARK + word)
            if len(word) <= LONGEST:
                if len(self.known) >= REMEMBERED:
                    self.known.clear()
                self.known[word] = count
        return count

    def pieces(self, word: str) -> int:
        """Pieces of the best segmentation of ``word``, unknown ones included."""
        size = len(word)
        best: list[float | None] = [0.0] + [None] * size
        count = [0] * (size + 1)
        ends_unknown = [False] * (size + 1)
        settled = 0

        def settle(upto: int) -> None:
            """An unknown character comes last among the candidates of its end."""
            for i in range(settled, upto):
                if word[i] not in self.single:
                    score = best[i] + self.unknown
                    if best[i + 1] is None or score > best[i + 1]:
                        best[i + 1] = score
                        more = len(word[i].encode("utf-8", "replace")) if self.bytes else int(not ends_unknown[i])
                        count[i + 1], ends_unknown[i + 1] = count[i] + more, True

        for last, (length, piece_score) in self.automaton.iter(word):
            end = last + 1
            if settled < last:
                settle(last)
                settled = last
            start = end - length
            score = best[start] + piece_score
            if best[end] is None or score > best[end]:
                best[end], count[end], ends_unknown[end] = score, count[start] + 1, False
        settle(size)
        return count[size]


@functools.lru_cache(maxsize=4)
def _counter(load: Callable[..., Vocabulary], *args) -> Counter:
    return Counter(load(*args))


def token_count(text: str | Column, load: Callable[..., Vocabulary], *args) -> Column:
    """Column with the number of tokens of the whole text; 0 for a missing or empty one.

    ``load(*args)`` gives the vocabulary and is called once in each Python worker.
    Being a column, it leaves all rows and other columns as they are: repeated
    rows get equal counts, an empty table stays empty.
    """
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        counter = _counter(load, *args)
        for batch in batches:
            yield pa.array([counter.text(t.as_py()) for t in batch], pa.int64())

    return F.arrow_udf(count, "long")(text)
