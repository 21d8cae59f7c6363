"""Quality scores by Bradley-Terry pairwise ranking.

A document is described by a few measures of its surface. Preference pairs put a
document labelled good before one labelled bad, and the weights minimise
the logistic loss on the difference of their measures, so the model
learns to rank. The threshold is the quantile of the training scores that parts
good from bad best, and scores are mapped to (0, 1) so that it lies at ``CUT``.
"""

from __future__ import annotations

from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mapweave.llm import labelled

CUT = 0.3
PAIRS = 60_000
STEPS = 400
RATE = 0.05
DECAY = 1e-4
# Words of which the worst stretch of a text is made.
STRETCH = 48
SEED = 8

_KIND = np.zeros(256, dtype=np.uint8)
_KIND[[9, 10, 11, 12, 13, 32]] = 1
_KIND[48:58] = 2
_KIND[65:91] = 3
_KIND[97:123] = 4
_KIND[[i for i in range(33, 127) if _KIND[i] == 0]] = 5
_KIND[128:] = 6

MEASURES = 20


def measures(text: str | None) -> np.ndarray:
    """Surface measures of a text; all zero without words."""
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.split()
    out = np.zeros(MEASURES)
    if not words:
        return out
    raw = np.frombuffer(data, np.uint8)
    kind = _KIND[raw]
    share = np.bincount(kind, minlength=7) / len(raw)
    marks = kind == 5
    twice = marks[1:] & (raw[1:] == raw[:-1])
    n = len(words)
    lengths = np.fromiter(map(len, words), np.int64, n)
    distinct = len(set(words))
    again = np.fromiter(map(eq, words[1:], words[:-1]), bool, n - 1)
    lines = [x for x in data.split(b"\n") if x]
    # Stretches of words, to see junk inside a long text.
    starts = np.cumsum(lengths) - lengths
    cut = np.arange(0, n, STRETCH)
    place = np.minimum(starts[cut] + cut, len(raw) - 1)
    size = np.diff(np.append(place, len(raw)))

    def worst(flags: np.ndarray) -> float:
        return float((np.add.reduceat(flags.astype(np.int64), place) / np.maximum(size, 16)).max())

    repeats = np.add.reduceat(np.append(again, False).astype(np.int64), cut)
    out[:] = (
        np.log1p(n),
        lengths.mean() / 10,
        lengths.std() / 10,
        share[2],
        share[3],
        share[4],
        share[5],
        share[6],
        twice.sum() / len(raw),
        again.sum() / n,
        distinct / n,
        np.log1p(n / distinct),
        len(set(lines)) / max(1, len(lines)),
        np.log1p(n / max(1, len(lines))),
        worst(kind == 3),
        worst(marks),
        worst(np.append(twice, False)),
        float((repeats / np.maximum(np.diff(np.append(cut, n)), 8)).max()),
        worst(kind == 2),
        1.0,
    )
    return out


@dataclass
class Ranking:
    """Weights of the standardised measures, and the map from raw scores to (0, 1)."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    slope: float
    shift: float

    def score(self, rows: np.ndarray) -> np.ndarray:
        raw = ((rows - self.mean) / self.scale) @ self.weights
        return 1 / (1 + np.exp(-np.clip(raw * self.slope + self.shift, -40, 40)))


def fit(rows: np.ndarray, labels: np.ndarray, pairs: int = PAIRS, seed: int = SEED) -> Ranking:
    """Learn from ``pairs`` random pairs of a good and a bad row.

    Without both kinds nothing can be ranked, and all rows score the share of good ones.
    """
    mean, scale = (rows.mean(axis=0), rows.std(axis=0)) if len(rows) else (np.zeros(MEASURES), np.ones(MEASURES))
    scale = np.where(scale > 1e-9, scale, 1.0)
    weights = np.zeros(rows.shape[1])
    good, bad = np.flatnonzero(labels == 1), np.flatnonzero(labels == 0)
    if not len(good) or not len(bad):
        rate = np.clip(labels.mean() if len(labels) else 0.5, 0.01, 0.99)
        return Ranking(mean, scale, weights, 1.0, float(np.log(rate / (1 - rate))))
    x = (rows - mean) / scale
    draw = np.random.default_rng(seed)
    ahead = x[draw.choice(good, pairs)] - x[draw.choice(bad, pairs)]
    moment, spread = np.zeros_like(weights), np.zeros_like(weights)
    for step in range(1, STEPS + 1):
        lost = 1 / (1 + np.exp(np.clip(ahead @ weights, -40, 40)))
        slope = DECAY * weights - lost @ ahead / pairs
        moment = 0.9 * moment + 0.1 * slope
        spread = 0.999 * spread + 0.001 * slope**2
        weights -= RATE * (moment / (1 - 0.9**step)) / (np.sqrt(spread / (1 - 0.999**step)) + 1e-8)
    raw = x @ weights
    threshold = best_quantile(raw, labels)
    # The scale is that of the gap between the kinds, so that scores are spread out.
    gap = max(np.median(raw[good]) - np.median(raw[bad]), 1e-6)
    steep = 8.0 / gap
    return Ranking(mean, scale, weights, steep, float(np.log(CUT / (1 - CUT)) - steep * threshold))


def best_quantile(raw: np.ndarray, labels: np.ndarray) -> float:
    """The score quantile that parts the labels with the least balanced error; the middle of the best gap."""
    order = np.argsort(raw, kind="stable")
    good = labels[order] == 1
    # Errors when everything before a place is rejected.
    missed = np.concatenate(([0], np.cumsum(good))) / good.sum()
    passed = 1 - np.concatenate(([0], np.cumsum(~good))) / (~good).sum()
    error = missed + passed
    places = np.flatnonzero(error <= error.min() + 1e-12)
    place = int(places[len(places) // 2])
    ranked = raw[order]
    below, above = ranked[max(place - 1, 0)], ranked[min(place, len(ranked) - 1)]
    return float((below + above) / 2)


def learned(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = labelled.SAMPLE, **columns) -> Ranking:
    """Fit on at most ``sample`` labelled rows; only their measures reach the driver."""
    rows = labelled.training_rows(docs, labels, label, sample=sample, **columns)

    def run(batches):
        for batch in batches:
            found = [measures(t.as_py()).tolist() for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.float64())), batch.column(1)], names=["x", "label"])

    got = rows.mapInArrow(run, "x array<double>, label int").toPandas()
    x = np.array(got["x"].tolist()).reshape(-1, MEASURES)
    order = np.lexsort((*x.T, got["label"].to_numpy()))
    return fit(x[order], got["label"].to_numpy()[order])


def scored(docs: DataFrame, model: Ranking, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """(row, score): the columns of each document and its score; null and empty texts have one too."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            rows = [measures(t.as_py()) for t in batch.column(1)]
            score = shared.value.score(np.array(rows).reshape(-1, MEASURES))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score)], names=["row", "score"])

    row = F.struct(*[F.col(f"`{c}`") for c in keep or docs.columns]).alias("row")
    narrow = docs.select(row, F.col(f"`{text}`").cast("string").alias("text"))
    schema = T.StructType([T.StructField("row", narrow.schema["row"].dataType), T.StructField("score", T.DoubleType())])
    return narrow.mapInArrow(run, schema)


def good_documents(docs: DataFrame, labels: DataFrame, cut: float = CUT) -> DataFrame:
    """The documents that score at least ``cut``, with their own columns."""
    return scored(docs, learned(docs, labels)).where(F.col("score") >= cut).select("row.*")
