"""Document quality from a linear-chain conditional random field over lines.

Every line has counts of character classes and words, and those of the lines
before and after it, as features. The field labels all lines of a document at
once; forward-backward gives each line's marginal of being good, and the mean of
the marginals weighted by line length is the document's score.

Labels exist for documents only, so in training all lines of a document carry its
label. The fit runs on the driver over a bounded sample: ``DOCUMENTS`` labelled
documents in the order of a hash of their id, their lines cut into sequences of
``SEQUENCE`` lines, of which ``SEQUENCES`` in the order of a hash are used.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bounds of the training sample.
DOCUMENTS, SEQUENCE, SEQUENCES = 3000, 64, 4000
#: Characters that a task looks at together.
BLOCK = 1_000_000
STEPS, RATE, RIDGE = 150, 0.15, 1e-3
#: Standard deviations at which features are clipped.
FAR = 3.0

_CLASSES = ("lower", "upper", "digit", "space", "high", "stop", "bang", "pipe", "symbol")
_CLASS_OF = np.full(256, _CLASSES.index("symbol"), np.uint8)
for _name, _chars in (("lower", range(97, 123)), ("upper", range(65, 91)), ("digit", range(48, 58)), ("space", b" \t\r\x0b\x0c"),
                      ("high", range(128, 256)), ("stop", b".,;:'\"?()-"), ("bang", b"!"), ("pipe", b"|")):
    _CLASS_OF[list(_chars)] = _CLASSES.index(_name)
FEATURES = 11
WIDTH = 3 * FEATURES


@dataclass(frozen=True)
class Field:
    """Weights of the features, for label good against bad, and of label pairs."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    pairs: np.ndarray


def _lines(text: str | None) -> list[str]:
    """Lines that are not blank; one empty line if there are none."""
    return [x for x in (text or "").split("\n") if x.strip()] or [""]


def _features(documents: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
    """Features of all lines with those of their neighbours in the document, and line lengths."""
    lines = [x for d in documents for x in d]
    raw = "\n".join(lines).encode("utf-8", "replace")
    kinds = _CLASS_OF[np.frombuffer(raw, np.uint8)]
    sizes = np.fromiter((len(x.encode("utf-8", "replace")) for x in lines), np.int64, len(lines))
    line_of = np.repeat(np.arange(len(lines)), sizes + 1)[:len(raw)]
    keep = np.ones(len(raw), bool)
    keep[np.cumsum(sizes + 1)[:-1] - 1] = False  # the line breaks
    n = len(_CLASSES)
    counts = np.bincount(line_of[keep] * n + kinds[keep], minlength=n * len(lines)).reshape(-1, n).astype(np.float64)
    words = [x.split() for x in lines]
    n_words = np.fromiter(map(len, words), np.float64, len(lines))
    distinct = np.fromiter((len(set(w)) for w in words), np.float64, len(lines))
    of = dict(zip(_CLASSES, counts.T))
    total = np.maximum(sizes, 1)
    own = np.stack([
        np.ones(len(lines)), of["upper"] / (of["lower"] + of["upper"] + of["high"] + 1),
        of["digit"] / total, of["space"] / total, of["stop"] / total, of["bang"] / total, of["pipe"] / total, of["symbol"] / total,
        distinct / np.maximum(n_words, 1), np.log1p(n_words), np.log1p((total - of["space"]) / (n_words + 1))], axis=1)
    before, after = np.zeros_like(own), np.zeros_like(own)
    before[1:], after[:-1] = own[:-1], own[1:]
    first = np.cumsum([0, *map(len, documents)])[:-1]
    before[first], after[first[1:] - 1] = 0, 0
    return np.concatenate([own, before, after], axis=1), np.fromiter((max(len(x), 1) for x in lines), np.float64, len(lines))


def _standard(features: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Centred and scaled; clipped, so that no single odd value outweighs all others."""
    return np.clip((features - mean) / scale, -FAR, FAR)


def _blocks(texts: list[str | None]) -> Iterator[list[list[str]]]:
    """Documents as lists of lines, about ``BLOCK`` characters together."""
    block, size = [], 0
    for text in texts:
        block.append(_lines(text))
        size += len(text or "")
        if size >= BLOCK:
            yield block
            block, size = [], 0
    if block:
        yield block


def _marginals(emissions: list[float], pairs: list[list[float]]) -> list[float]:
    """P(good) of each line; ``pairs`` holds exponentials."""
    (bb, bg), (gb, gg) = pairs
    good, bad, forward = 1.0, 1.0, []
    for i, e in enumerate(emissions):
        g, b = (e, 1.0) if i == 0 else ((bad * bg + good * gg) * e, bad * bb + good * gb)
        good, bad = g / (g + b), b / (g + b)
        forward.append(good)
    good, bad, out = 1.0, 1.0, []
    for i in range(len(emissions) - 1, -1, -1):
        g, b = forward[i] * good, (1 - forward[i]) * bad
        out.append(g / (g + b) if g + b > 0 else 0.5)
        eg = emissions[i] * good
        good, bad = gb * bad + gg * eg, bb * bad + bg * eg
        good, bad = good / (good + bad), bad / (good + bad)
    return out[::-1]


def score_texts(texts: list[str | None], field: Field | None) -> list[float]:
    """Scores between 0 and 1; 0.5 for all without a fitted field."""
    if field is None:
        return [0.5] * len(texts)
    pairs, scores = np.exp(field.pairs).tolist(), []
    for block in _blocks(texts):
        features, sizes = _features(block)
        emissions = np.exp(np.clip(_standard(features, field.mean, field.scale) @ field.weights, -30, 30)).tolist()
        at = 0
        for lines in block:
            end = at + len(lines)
            good = np.array(_marginals(emissions[at:end], pairs))
            scores.append(float(min(1.0, max(0.0, good @ sizes[at:end] / sizes[at:end].sum()))))
            at = end
    return scores


def quality_score(text: str | Column, field: Field | None) -> Column:
    """Column with the score of the whole text; a missing text counts as an empty one, one empty line."""
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array(score_texts(batch.to_pylist(), field), pa.float64())

    return F.arrow_udf(score, "double")(text)


def fit_field(docs: DataFrame, labels: DataFrame, documents: int = DOCUMENTS, sequences: int = SEQUENCES) -> Field | None:
    """Fit on ``labels`` (``doc_id, quality``: 1 good, 0 bad) of ``docs`` (``doc_id, text``).

    Labels without id or quality, ids with contradicting labels, and labels of no
    document are left out; repeated labels count once, repeated documents each.
    Without both kinds of label there is no field, and None is returned. The chosen
    labels are at most ``documents`` rows, so joining them moves no document.
    """
    chosen = (labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1))
              .groupBy("doc_id").agg(F.min("quality").alias("good"), F.max("quality").alias("also"))
              .where("good = also").orderBy(F.xxhash64("doc_id"), "doc_id").limit(documents).select("doc_id", "good"))
    schema = "place long, good int, n int, features binary"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            goods, places = batch.column("good").to_pylist(), batch.column("place").to_pylist()
            for text, good, place in zip(batch.column("text").to_pylist(), goods, places):
                features = _features([_lines(text)])[0].astype(np.float32)
                for k in range(0, len(features), SEQUENCE):
                    part = features[k:k + SEQUENCE]
                    rows.append((place ^ (k * 0x9E3779B9), good, len(part), part.tobytes()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int32(), pa.int32(), pa.binary()))],
                names=["place", "good", "n", "features"]) if rows else pa.RecordBatch.from_arrays(
                [pa.array([], t) for t in (pa.int64(), pa.int32(), pa.int32(), pa.binary())], names=["place", "good", "n", "features"])

    rows = (docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
            .select(F.xxhash64("doc_id").alias("place"), "text", F.col("good").cast("int").alias("good"))
            .mapInArrow(cut, schema).orderBy("place", "n", "features").limit(sequences).collect())
    if len({r.good for r in rows}) < 2:
        return None
    return _fit([np.frombuffer(r.features, np.float32).reshape(-1, WIDTH) for r in rows], np.array([r.good for r in rows]))


def _fit(parts: list[np.ndarray], labels: np.ndarray) -> Field:
    """Maximum likelihood with a ridge, by Adam; all sequences step by step together."""
    n, longest = len(parts), max(map(len, parts))
    stacked = np.concatenate(parts).astype(np.float64)
    mean, scale = stacked.mean(axis=0), stacked.std(axis=0)
    mean[0], scale[scale < 1e-6] = 0, 1
    x = np.zeros((longest, n, WIDTH), np.float32)
    live = np.zeros((longest, n), bool)
    for i, p in enumerate(parts):
        x[:len(p), i], live[:len(p), i] = _standard(p, mean, scale), True
    total, y = live.sum(), labels.astype(np.float64)
    seen = np.zeros((2, 2))
    for c in (0, 1):
        seen[c, c] = live[1:, labels == c].sum()
    at = np.zeros(WIDTH + 4)
    first, second = np.zeros_like(at), np.zeros_like(at)
    for step in range(1, STEPS + 1):
        weights, pairs = at[:WIDTH], np.exp(at[WIDTH:].reshape(2, 2))
        e = np.exp(np.clip(x @ weights.astype(np.float32), -30, 30)).astype(np.float64)
        psi = np.stack([np.ones_like(e), e], axis=2)
        forward = np.empty((longest, n, 2))
        backward = np.ones((longest, n, 2))
        forward[0] = psi[0] / psi[0].sum(axis=1, keepdims=True)
        for t in range(1, longest):
            f = (forward[t - 1] @ pairs) * psi[t]
            forward[t] = f / f.sum(axis=1, keepdims=True)
        expected = np.zeros((2, 2))
        for t in range(longest - 2, -1, -1):
            b = psi[t + 1] * backward[t + 1]
            joint = forward[t][:, :, None] * pairs[None] * b[:, None, :]
            on = live[t + 1]
            expected += (joint[on] / joint[on].sum(axis=(1, 2), keepdims=True)).sum(axis=0)
            b = b @ pairs.T
            backward[t] = np.where(on[:, None], b / b.sum(axis=1, keepdims=True), 1.0)
        both = forward * backward
        good = both[:, :, 1] / both.sum(axis=2)
        error = np.where(live, y[None] - good, 0)
        slope = np.concatenate([np.tensordot(error, x, 2), (seen - expected).ravel()]) / total - RIDGE * at
        first, second = 0.9 * first + 0.1 * slope, 0.999 * second + 0.001 * slope**2
        at = at + RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return Field(mean, scale, at[:WIDTH], at[WIDTH:].reshape(2, 2))


def train_rows(labels: DataFrame) -> DataFrame:
    """Labels outside the held-out fifth."""
    return labels.where(~held_out(F.col("doc_id")))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))
