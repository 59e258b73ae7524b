"""Packing of documents into sequences of fixed length.

Tokens are made once; what follows knows only lengths. The histogram of piece
lengths has at most ``size`` rows, whatever the input, and a linear program over
configurations (multisets of lengths that fit a sequence) is solved on it:
multiplicative weights keep a price for each length, a knapsack by dynamic
programming finds the configuration of the highest price, and the prices of
lengths that are covered fall. Shares are rounded down, what is left over goes
through the same again, and the last few pieces are placed best-fit, in bulk.

The plan says how many sequences have which configuration. Pieces find their
places by their rank within their length: ranks are made within (length, salt)
and offset by the counts of the salts before, so that a length which a third of
all pieces have is ranked by many tasks.
"""

from __future__ import annotations

import functools
import re
import unicodedata
import zlib
from collections import Counter, defaultdict
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riverload.stages import Stages

SIZE = 2048
#: Rounds of prices, and how strongly covered lengths lose theirs.
ROUNDS, STEP = 160, 0.25
#: Prices start at lengths to this power: above 1, so that long pieces, which fewer others fit, are placed first.
TILT = 1.1
#: The program is solved again for what rounding left, so many times at most; the rest is placed best-fit.
REPEATS = 3
#: Words whose tokens a task remembers; saves work only.
REMEMBERED, LONGEST = 300_000, 48

PIECES = "array<struct<piece int, start long, length int, ids_crc32 long>>"
_PIECES = pa.list_(pa.struct([("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int32()), ("ids_crc32", pa.int64())]))


_SPACE = r" \t\n\r\x0b\x0c"
#: Characters whose class every version of the tables agrees on, by class.
_KNOWN = 0x24F


def _of_kind(kind: str) -> str:
    return "".join(re.escape(chr(c)) for c in range(_KNOWN + 1) if unicodedata.category(chr(c))[0] == kind)


class Encoder(dict):
    """Token ids of whole texts as little-endian unsigned 32-bit integers, by ``tokenizers``.

    A byte-level BPE cuts a text into words first, by a fixed pattern, and joins nothing
    across their bounds. Texts are cut here, and the ids of the words, by the tokenizer's
    model, remembered. A text with other characters than Latin ones is cut at its blanks
    alone, and such parts go through the whole tokenizer; so do texts with white space
    beyond ASCII or with a special token, and all texts if the tokenizer cuts otherwise.
    """

    # Fixed value: the words of this kind of tokenizer.
    words = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_of_kind('L')}]+| ?[{_of_kind('N')}]+| ?[^{_SPACE}{_of_kind('L')}{_of_kind('N')}]+"
                       rf"|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")
    parts = re.compile(rf" ?[^{_SPACE}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")
    other_space = re.compile(rf"[^\S{_SPACE}]")
    other = re.compile(f"[^\0-{chr(_KNOWN)}]")
    odd = re.compile(f"[\x1c-\x1f\x85\xa0{chr(_KNOWN + 1)}-\U0010ffff]")  # all that either of the two finds

    def __init__(self, tokenizer_path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        self.model = self.tokenizer.model
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        first = self.tokenizer.pre_tokenizer
        self.usual = (self.tokenizer.normalizer is None and isinstance(first, pre_tokenizers.ByteLevel)
                      and first.use_regex and not first.add_prefix_space)
        # A byte's character in the vocabulary, as the tokenizer itself writes it.
        shown = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        single = {b: shown.pre_tokenize_str(chr(b))[0][0] for b in range(128)}
        pairs = {c: shown.pre_tokenize_str(chr(c))[0][0] for c in range(128, 2048)}
        for c, text in pairs.items():
            single |= dict(zip(chr(c).encode(), text))
        self.bytes_shown = single

    def ids(self, text: str) -> bytes:
        odd = self.odd.search(text)
        if not self.usual or odd and self.other_space.search(text) or any(t in text for t in self.special):
            return self.encode(text)
        if len(self) >= REMEMBERED:
            self.clear()
        cut = self.parts if odd and self.other.search(text) else self.words
        return b"".join(map(self.__getitem__, cut.findall(text)))

    def __missing__(self, part: str) -> bytes:
        if self.other.search(part):
            ids = self.encode(part)
        elif len(cut := self.words.findall(part)) > 1:
            ids = b"".join(map(self.__getitem__, cut))
        else:
            shown = part.encode().decode("latin-1").translate(self.bytes_shown)
            ids = np.asarray([t.id for t in self.model.tokenize(shown)], "<u4").tobytes()
        if len(part) <= LONGEST:
            self[part] = ids
        return ids

    def encode(self, text: str) -> bytes:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


@functools.lru_cache(maxsize=2)
def _encoder(load: Callable[..., Encoder], *args) -> Encoder:
    return load(*args)


def cut(ids: bytes, size: int = SIZE, end: int = 0) -> list[dict]:
    """Pieces of a document, ``end`` appended; of too long ones the first is the short piece."""
    ids += end.to_bytes(4, "little")
    n = len(ids) // 4
    starts = range(n % size - size if n % size else 0, n, size)
    return [{"piece": k, "start": max(0, s), "length": min(s + size, n) - max(0, s),
             "ids_crc32": zlib.crc32(ids[4 * max(0, s):4 * min(s + size, n)])} for k, s in enumerate(starts)]


def pieces(text: str | Column, load: Callable[..., Encoder], *args, size: int = SIZE) -> Column:
    """Column with the pieces of the whole text; a missing text is an empty one, its end token alone."""
    def made(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = _encoder(load, *args)
        for batch in batches:
            yield pa.array([cut(encoder.ids(t.as_py() or ""), size) for t in batch], _PIECES)

    return F.arrow_udf(made, PIECES)(text)


Config = tuple[tuple[int, int], ...]  # (length, how many), longest first


def plan(histogram: dict[int, int], size: int = SIZE) -> dict[Config, int]:
    """How many sequences of which configuration hold the whole histogram."""
    left = {s: n for s, n in histogram.items() if n > 0}
    made: Counter[Config] = Counter()
    if size in left:
        made[(size, 1),] += left.pop(size)
    for _ in range(REPEATS):
        if len(left) < 2:
            break
        before = sum(left.values())
        # Tight configurations first: what rounding leaves then is the easier to place.
        for config, share in sorted(_program(left, size).items(), key=lambda x: (-_fill(x[0]), x[0])):
            n = min(int(share), *(left.get(s, 0) // k for s, k in config))
            if n:
                made[config] += n
                for s, k in config:
                    left[s] -= n * k
        left = {s: n for s, n in left.items() if n}
        if sum(left.values()) > 0.9 * before:
            break
    for config, n in _best_fit(left, size).items():
        made[config] += n
    return dict(made)


def _fill(config: Config) -> int:
    return sum(s * k for s, k in config)


def _program(wanted: dict[int, int], size: int) -> dict[Config, float]:
    """Shares of configurations that cover ``wanted``, by multiplicative weights.

    Prices start at a power of the lengths. Each round the configuration of the highest price
    is used until one of its lengths is covered by a further ``STEP`` of its number;
    prices fall exponentially with coverage.
    """
    lengths = np.array(sorted(wanted, reverse=True))
    numbers = np.array([wanted[s] for s in lengths], float)
    covered = np.zeros(len(lengths))
    shares: dict[Config, float] = defaultdict(float)
    for _ in range(ROUNDS):
        remaining = 1 - covered
        if remaining.max() <= 1e-3:
            break
        prices = np.where(remaining > 1e-9, lengths**TILT * np.exp(-covered), 0)
        counts = _knapsack(lengths, prices, np.maximum(1, np.ceil(numbers * np.minimum(remaining, 1))).astype(int), size)
        used = counts > 0
        if not used.any():
            break
        amount = min((STEP * numbers[used] / counts[used]).min(), (remaining[used] * numbers[used] / counts[used]).min())
        amount = max(amount, min(1.0, (remaining[used] * numbers[used] / counts[used]).min()))
        covered[used] += amount * counts[used] / numbers[used]
        shares[tuple((int(s), int(k)) for s, k in zip(lengths[used], counts[used]))] += amount
    return shares


def _knapsack(lengths: np.ndarray, prices: np.ndarray, limits: np.ndarray, size: int) -> np.ndarray:
    """Numbers of each length, within ``limits``, of the highest total price in ``size``."""
    best = np.zeros(size + 1)
    taken: list[tuple[int, int, np.ndarray]] = []
    for i, (length, price, limit) in enumerate(zip(lengths.tolist(), prices.tolist(), limits.tolist())):
        if price <= 0:
            continue
        most, part = min(limit, size // length), 1
        while most > 0:
            part = min(part, most)
            weight = part * length
            offer = best[:size + 1 - weight] + part * price
            better = offer > best[weight:]
            best[weight:][better] = offer[better]
            taken.append((i, part, better))
            most, part = most - part, part * 2
    counts, room = np.zeros(len(lengths), int), int(best.argmax())
    for i, part, better in reversed(taken):
        weight = part * int(lengths[i])
        if room >= weight and better[room - weight]:
            counts[i] += part
            room -= weight
    return counts


def _best_fit(left: dict[int, int], size: int) -> dict[Config, int]:
    """Longest first, each into the fullest sequence that has room; equal sequences are kept as one with their number."""
    bins: dict[int, Counter[Config]] = defaultdict(Counter)
    for s in sorted(left, reverse=True):
        n = left[s]
        for room in sorted(r for r in bins if r >= s):
            for config in sorted(bins[room]):
                most = bins[room][config]
                each = room // s
                for k, m in ((each, min(most, n // each)), (n % each, 1)):
                    if n and m and k and bins[room][config] >= m and m * k <= n:
                        bins[room][config] -= m
                        bins[room - k * s][(*config, (s, k))] += m
                        n -= m * k
                bins[room] += Counter()
                if not n:
                    break
            if not n:
                break
        each = size // s
        if n // each:
            bins[size - each * s][(s, each),] += n // each
        if n % each:
            bins[size - n % each * s][(s, n % each),] += 1
    return dict(sum(bins.values(), Counter()))


def slots(made: dict[Config, int]) -> Iterator[tuple[int, int, int, int, int, int]]:
    """For each configuration and length: ``length, first, last`` rank, ``each`` in a sequence, ``sequence`` and ``offset`` of the first."""
    ranks: Counter[int] = Counter()
    sequence = 0
    for config, n in sorted(made.items(), key=lambda x: (-x[1], x[0])):
        offset = 0
        for s, k in config:
            yield s, ranks[s], ranks[s] + n * k - 1, k, sequence, offset
            ranks[s] += n * k
            offset += s * k
        sequence += n


def pack(found: DataFrame, size: int = SIZE, salts: int | None = None) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` with ``sequence_id`` and ``offset``; one row per row of ``found``.

    Sequences are numbered from 0, filled from offset 0 without gaps. Ids may be
    missing or repeat; equal rows get places of their own. No pieces, no rows.
    Only the histogram, at most ``size`` rows, and the plan made of it, which is
    bounded by the rounds and lengths and not by the pieces, pass the driver.
    """
    spark = found.sparkSession
    stages = Stages(spark, "packing")
    salts = salts or max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = stages.write(found.select("doc_id", "piece", "start", "length", "ids_crc32").withColumn(
        "salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)).cast("int")), "pieces")
    counts = rows.groupBy("length", "salt").count()
    offsets = counts.withColumn("before", F.sum("count").over(
        Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1))).select(
        "length", "salt", F.coalesce("before", F.lit(0)).alias("before"))
    histogram = {r["length"]: r["n"] for r in rows.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    table = spark.createDataFrame(
        pa.Table.from_pylist([dict(zip(_SLOT, x)) for x in slots(plan(histogram, size))], pa.schema([(c, pa.int64()) for c in _SLOT])))
    within = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = (rows.withColumn("within", F.row_number().over(within) - 1).join(offsets, ["length", "salt"])
              .withColumn("rank", F.col("before") + F.col("within")))
    place = (ranked["length"] == table["of"]) & ranked["rank"].between(table["first"], table["last"])
    nth = F.col("rank") - F.col("first")
    return ranked.join(table, place).select(
        "doc_id", "piece", "start", F.col("length").cast("long").alias("length"), "ids_crc32",
        (F.col("sequence") + F.floor(nth / F.col("each"))).cast("long").alias("sequence_id"),
        (F.col("at") + nth % F.col("each") * F.col("length")).cast("long").alias("offset"))


_SLOT = ("of", "first", "last", "each", "sequence", "at")


def pack_documents(docs: DataFrame, load: Callable[..., Encoder], *args, size: int = SIZE) -> DataFrame:
    """All documents (``doc_id, text``) cut into pieces and packed, see ``pack``."""
    found = docs.select("doc_id", F.explode(pieces("text", load, *args, size=size)).alias("cut")).select("doc_id", "cut.*")
    return pack(found, size)


def lower_bound(lengths: Iterable[int], size: int = SIZE) -> int:
    """No packing has fewer sequences than this."""
    return -(-sum(lengths) // size)
