"""Test items that leaked into documents, found by block-max WAND over BM25.

The test items are the indexed collection. Every document is cut into passages that
overlap by half and are long enough for any item to lie wholly in one; each passage
is a query. Scores are BM25 divided by the item's score of itself, so one threshold
means the same for all items. A block of items whose summed block maxima stay below
the threshold is skipped; in the others WAND moves a pivot over the posting lists.
All items above the threshold are then verified: enough of the shingles of both the
question and the answer have to stand in the passage.

Items are indexed in shards of bounded size, each sent to the tasks once; documents are
only scanned. A document is searched within its row.
"""

from __future__ import annotations

import functools
import itertools
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

K1, B = 1.2, 0.75
#: Share of an item's own score that a passage must reach, words of a shingle, share of shingles to be found.
SCORE, SHINGLE, OVERLAP = 0.6, 5, 0.8
#: Characters of items in a shard, most blocks of a shard, least items of a block.
SHARD, BLOCKS, LEAST = 4_000_000, 64, 4
#: Words that a task looks at together.
TOGETHER = 200_000

_WORD = re.compile(r"\w+")
_TYPE = pa.list_(pa.struct([("item_id", pa.int64()), ("passage", pa.int64()), ("score", pa.float64()),
                            ("question_overlap", pa.float64()), ("answer_overlap", pa.float64())]))
HITS = "array<struct<item_id long, passage long, score double, question_overlap double, answer_overlap double>>"


def words(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def question_and_answer(text: str) -> tuple[str, str]:
    """The answer is the last line, or of a single line the last sentence; the question is what is before."""
    lines = [x for x in text.split("\n") if _WORD.search(x)]
    if len(lines) > 1:
        return "\n".join(lines[:-1]), lines[-1]
    sentences = [x for x in re.split(r"(?<=[.!?])\s+", text) if _WORD.search(x)]
    return (" ".join(sentences[:-1]), sentences[-1]) if len(sentences) > 1 else (text, "")


def _shingles(found: list[str]) -> set[tuple[str, ...]]:
    n = min(SHINGLE, len(found))
    return {tuple(found[i:i + n]) for i in range(len(found) - n + 1)} if n else set()


@dataclass
class Posting:
    items: list[int]
    shares: list[float]


class Index:
    """BM25 index of (id, text) items with block maxima."""

    def __init__(self, items: list[tuple[int | None, str]], score: float = SCORE):
        self.least = score - 1e-9
        listed = [(i, t, words(t)) for i, t in items]
        self.items = [(i, t, w) for i, t, w in listed if w]
        counts = [Counter(w) for _, _, w in self.items]
        n, mean = len(counts), sum(map(len, (w for _, _, w in self.items))) / max(1, len(self.items))
        holders = Counter(t for c in counts for t in c)
        self.vocabulary = {t: k for k, t in enumerate(sorted(holders))}
        self.stride = max((len(w) for _, _, w in self.items), default=1)
        self.block = max(LEAST, math.ceil(n / BLOCKS))
        self.maxima = np.zeros((len(holders), math.ceil(n / self.block)), np.float32)
        self.postings: dict[tuple[int, int], Posting] = {}
        for i, c in enumerate(counts):
            size = K1 * (1 - B + B * len(self.items[i][2]) / mean)
            parts = {t: math.log(1 + (n - holders[t] + 0.5) / (holders[t] + 0.5)) * f * (K1 + 1) / (f + size) for t, f in c.items()}
            whole = sum(parts.values())
            for t, part in parts.items():
                term, block = self.vocabulary[t], i // self.block
                posting = self.postings.setdefault((term, block), Posting([], []))
                posting.items.append(i)
                posting.shares.append(part / whole)
                self.maxima[term, block] = max(self.maxima[term, block], np.float32(part / whole))
        self.shingles = [tuple(_shingles(words(part)) for part in question_and_answer(t)) for _, t, _ in self.items]

    def search(self, documents: list[list[str]]) -> list[dict[int, list[tuple[int, float]]]]:
        """For each document the items above the threshold, each with first word and score of all its passages."""
        hits: list[dict[int, list[tuple[int, float]]]] = [{} for _ in documents]
        if not self.items:
            return hits
        get, n = self.vocabulary.get, len(self.vocabulary)
        parts = [-(-len(d) // self.stride) for d in documents]
        first = np.cumsum([0, *parts])
        terms = np.fromiter((get(w, -1) for d in documents for w in d), np.int64)
        chunk = np.concatenate([first[k] + np.arange(len(d)) // self.stride for k, d in enumerate(documents)] or [np.empty(0, int)])
        known = np.unique((chunk * n + terms)[terms >= 0])
        if not len(known):
            return hits
        chunk, terms = known // n, known % n
        starts = np.flatnonzero(np.diff(chunk, prepend=-1))
        bounds = np.zeros((int(first[-1]) + 1, self.maxima.shape[1]), np.float32)
        bounds[chunk[starts]] = np.add.reduceat(self.maxima[terms], starts, axis=0)
        passages = bounds[:-1].copy()
        together = np.ones(len(passages), bool)
        together[first[1:][np.array(parts) > 0] - 1] = False  # the last chunk of a document has no next one
        passages[together] += bounds[1:][together]
        ends = np.append(starts, len(terms))
        place = dict(zip(chunk[starts].tolist(), range(len(starts))))
        for p, block in zip(*(x.tolist() for x in np.nonzero(passages >= self.least - 1e-4))):
            k = int(np.searchsorted(first, p, side="right")) - 1
            held = [terms[ends[place[c]]:ends[place[c] + 1]] for c in ((p, p + 1) if together[p] else (p,)) if c in place]
            for item, score in self._wand(np.unique(np.concatenate(held)).tolist(), block):
                hits[k].setdefault(item, []).append(((p - int(first[k])) * self.stride, score))
        return hits

    def _wand(self, terms: list[int], block: int) -> Iterator[tuple[int, float]]:
        """Items of the block whose score reaches the threshold."""
        lists = [[0, self.postings[t, block], float(self.maxima[t, block]) + 1e-7] for t in terms if (t, block) in self.postings]
        while lists:
            lists.sort(key=lambda x: x[1].items[x[0]])
            bound, pivot = 0.0, None
            for at, posting, most in lists:
                bound += most
                if bound >= self.least:
                    pivot = posting.items[at]
                    break
            if pivot is None:
                return
            if lists[0][1].items[lists[0][0]] == pivot:
                score = sum(x[1].shares[x[0]] for x in lists if x[1].items[x[0]] == pivot)
                if score >= self.least:
                    yield pivot, score
                moved = [x for x in lists if x[1].items[x[0]] == pivot]
            else:
                moved = [x for x in lists if x[1].items[x[0]] < pivot]
            for x in moved:
                x[0] += 1
                while x[0] < len(x[1].items) and x[1].items[x[0]] < pivot:
                    x[0] += 1
            lists = [x for x in lists if x[0] < len(x[1].items)]

    def leaks(self, documents: list[list[str]]) -> list[list[dict]]:
        """Verified hits of each document, by item."""
        return [self._verified(d, h) for d, h in zip(documents, self.search(documents))]

    def _verified(self, document: list[str], hits: dict[int, list[tuple[int, float]]]) -> list[dict]:
        """The items of which enough stands in a passage, with the best passage in which it does."""
        @functools.lru_cache(maxsize=64)
        def shingles(at: int, n: int) -> set[tuple[str, ...]]:
            passage = document[at:at + 2 * self.stride]
            return {tuple(passage[i:i + n]) for i in range(len(passage) - n + 1)}

        found = []
        for item, passages in sorted(hits.items()):
            for at, score in sorted(passages, key=lambda x: (-x[1], x[0])):
                shares = [len(part & shingles(at, len(next(iter(part))))) / len(part) if part else 1.0 for part in self.shingles[item]]
                if min(shares) >= OVERLAP:
                    found.append({"item_id": self.items[item][0], "passage": at, "score": score,
                                  "question_overlap": shares[0], "answer_overlap": shares[1]})
                    break
        return found


def leaks(text: str | Column, items: DataFrame, item_id: str = "item_id", item_text: str = "text", shard: int = SHARD) -> Column:
    """Column with the leaked items of the whole text: (``item_id, passage, score, question_overlap, answer_overlap``).

    Every passage that reaches the threshold for an item is verified; the best one that
    holds the item is reported, ``passage`` being the place of its first word. Words are
    lower-cased runs of letters and digits; items without a word cannot leak, equal
    items are reported each, a missing id stays missing. Empty for a missing or empty
    text and without items. Texts of any length are searched whole; passages are twice as
    long as the longest item of the shard, so very long items belong into a run of their
    own. Being a column, it leaves all rows and other columns as they are.

    Items pass the driver one shard at a time; its index is made there once and sent to
    the tasks as a broadcast of bounded size. A text is split once for all shards.
    """
    spark = items.sparkSession
    usable = items.where(F.col(item_text).isNotNull()).select(F.col(item_id).cast("long").alias("id"), F.col(item_text).alias("text"))
    chars = usable.agg(F.sum(F.length("text"))).first()[0] or 0
    shards = max(1, math.ceil(chars / shard))
    number = F.pmod(F.xxhash64("id", "text"), F.lit(shards))
    indexes = [spark.sparkContext.broadcast(Index(sorted(
        ((r.id, r.text) for r in usable.where(number == k).collect()), key=lambda x: (x[0] is None, x)))) for k in range(shards)]

    def find(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([hits for block in _blocks(batch.to_pylist()) for hits in map(
                list, map(itertools.chain.from_iterable, zip(*(index.value.leaks(block) for index in indexes))))], _TYPE)

    return F.arrow_udf(find, HITS)(text)


def _blocks(texts: list[str | None]) -> Iterator[list[list[str]]]:
    """The texts' words, some texts together."""
    block: list[list[str]] = []
    size = 0
    for text in texts:
        block.append(words(text))
        size += len(block[-1])
        if size >= TOGETHER:
            yield block
            block, size = [], 0
    if block:
        yield block
