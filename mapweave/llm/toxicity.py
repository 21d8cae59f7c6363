"""Toxicity by multiple-instance learning over sentences.

Only documents have labels. A sentence's probability is logistic in the words
it holds, and a document is toxic if any sentence is: the probabilities are
combined by noisy-or. Training the document probability against the labels moves
the weight to the sentences, and so to the words, that explain them. The
same sentence probabilities then locate what is offensive.

A word counts once in a sentence, by itself and by its first few bytes, so that
endings need not all be seen. Features are chosen by how unevenly the two kinds of documents hold them.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mapweave.llm import common, labelled

CUT = 0.5
FEATURES = 2048
LEAST_DOCS = 4
PREFIXES = (4, 5)
STEPS = 200
RATE = 0.1
# Pull of every weight to zero; words that explain little end there.
LASSO = 3e-5
BATCH_BYTES = 1 << 21
REMEMBERED = 500_000
STOP, END = b"\x01", b"\x02"
# Lower-cases A-Z; sentence ends become STOP, other ASCII that is no letter or digit a blank.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90
    else 1 if b in b".!?\n"
    else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122
    else 32
    for b in range(256)
)


def _bytes(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass").translate(WORD_BYTES)


def features_of(word: bytes) -> list[int]:
    """Hashes of a word and of its beginnings."""
    import xxhash

    parts = [b"=" + word] + [b"^" + word[:n] for n in PREFIXES if len(word) >= n]
    return [xxhash.xxh64_intdigest(p) - (1 << 63) for p in parts]


def sentences_of(text: str | None) -> list[list[bytes]]:
    """The words of each sentence that has any."""
    return [words for part in _bytes(text).split(STOP) if (words := part.split())]


class SentenceModel:
    """Weights of word features and a bias; remembers the weights of words it has met."""

    def __init__(self, weights: dict[int, float], bias: float):
        self.weights, self.bias = weights, bias
        self._forget()

    def __getstate__(self):
        return self.weights, self.bias

    def __setstate__(self, state):
        self.__init__(*state)

    def _forget(self) -> None:
        self.place: dict[bytes, int] = {STOP: 0, END: 1}
        self.values = [0.0, 0.0]

    def _learn(self, words: set[bytes]) -> np.ndarray:
        """Make sure that all words have a place; the weights by place."""
        if len(self.place) > REMEMBERED:
            self._forget()
        get = self.weights.get
        for w in [w for w in words if w not in self.place]:
            self.place[w] = len(self.values)
            self.values.append(sum(get(f, 0.0) for f in features_of(w)))
        return np.array(self.values)

    def sentence_scores(self, sentences: list[list[bytes]]) -> np.ndarray:
        values = self._learn({w for s in sentences for w in s})
        return np.array([self.bias + sum(values[self.place[w]] for w in set(s)) for s in sentences])

    def documents(self, texts: list[str | None]) -> np.ndarray:
        """The noisy-or of each text's sentences; 0 without words."""
        parts = [_bytes(t).replace(STOP, b" " + STOP + b" ") for t in texts]
        words = ((b" " + END + b" ").join(parts) + b" " + END).split()
        values = self._learn(set(words))
        places = np.fromiter(map(self.place.__getitem__, words), np.int64, len(words))
        stops = np.flatnonzero(places <= 1)
        sizes = np.diff(np.concatenate(([-1], stops))) - 1
        sentence = np.repeat(np.arange(len(stops)), sizes + 1)
        telling = np.flatnonzero(values[places] != 0)
        # Each word once in a sentence.
        once = np.unique(sentence[telling] * len(values) + places[telling])
        sums = np.bincount(once // len(values), weights=values[once % len(values)], minlength=len(stops))
        clean = np.where(sizes > 0, -np.logaddexp(0, self.bias + sums), 0.0)
        docs = np.concatenate(([0], np.cumsum(places[stops] == 1)[:-1]))
        return -np.expm1(np.bincount(docs, weights=clean, minlength=len(texts)))


def _batches(texts: list[str | None]):
    part, size = [], 0
    for text in texts:
        part.append(text)
        size += len(text or "")
        if size >= BATCH_BYTES:
            yield part
            part, size = [], 0
    if part:
        yield part


def chosen_features(rows: DataFrame, features: int = FEATURES) -> list[int]:
    """The features that the two kinds of documents hold most unevenly."""

    def run(batches):
        counts: dict[int, Counter] = {0: Counter(), 1: Counter()}
        held: dict[bytes, list[int]] = {}
        for batch in batches:
            for text, label in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                words = set(_bytes(text.as_py()).replace(STOP, b" ").split())
                for w in [w for w in words if w not in held]:
                    held[w] = features_of(w)
                counts[1 if label else 0].update({f for w in words for f in held[w]})
            if len(held) > REMEMBERED:
                held.clear()
            # The counts of a batch go on; memory does not grow with the rows.
            names = list(counts[0].keys() | counts[1].keys())
            columns = [names, [counts[1][f] for f in names], [counts[0][f] for f in names]]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["feature", "bad", "good"])
            counts = {0: Counter(), 1: Counter()}

    sizes = rows.groupBy("label").count().collect()
    n = {int(r[0]): r[1] for r in sizes}
    bad, good = F.col("bad") + 0.5, F.col("good") + 0.5
    lift = F.log(bad / (n.get(1, 0) + 1.0)) - F.log(good / (n.get(0, 0) + 1.0))
    sums = rows.mapInArrow(run, "feature long, bad long, good long").groupBy("feature").agg(
        F.sum("bad").alias("bad"), F.sum("good").alias("good")
    )
    uneven = F.abs(lift) / F.sqrt(1.0 / bad + 1.0 / good)
    top = sums.where(F.col("bad") + F.col("good") >= LEAST_DOCS).orderBy(F.desc(uneven), "feature").limit(features)
    return [r[0] for r in top.select("feature").collect()]


def bags(rows: DataFrame, features: list[int]) -> tuple[np.ndarray, ...]:
    """The sentences of training rows, by the positions of their chosen features.

    Returns labels, sentences without any feature per document, the document of each other
    sentence, and for each feature seen its sentence and position.
    """
    shared = rows.sparkSession.sparkContext.broadcast({f: i for i, f in enumerate(features)})

    def run(batches):
        place = shared.value
        for batch in batches:
            plain, held = [], []
            for text in batch.column(0):
                sentences = sentences_of(text.as_py())
                seen = [[place[f] for w in set(s) for f in features_of(w) if f in place] for s in sentences]
                held.append([s for s in seen if s])
                plain.append(len(seen) - len(held[-1]))
            kinds = [pa.int32(), pa.list_(pa.list_(pa.int32()))]
            arrays = [batch.column(1), *(pa.array(c, k) for c, k in zip((plain, held), kinds, strict=True))]
            yield pa.RecordBatch.from_arrays(arrays, names=["label", "plain", "held"])

    got = rows.mapInArrow(run, "label int, plain int, held array<array<int>>").toArrow()
    held = got.column("held").combine_chunks()
    inner = held.flatten()
    per_doc = np.asarray(held.value_lengths()).astype(np.int64)
    per_sentence = np.asarray(inner.value_lengths()).astype(np.int64)
    return (
        np.asarray(got.column("label")),
        np.asarray(got.column("plain")),
        np.repeat(np.arange(len(per_doc)), per_doc),
        np.repeat(np.arange(len(per_sentence)), per_sentence),
        np.asarray(inner.flatten()),
    )


def fit(labels, plain, doc_of, sentence_of, feature_of, features: int) -> tuple[np.ndarray, float]:
    """Weights and bias by gradient descent on the document likelihood."""
    weights, bias = np.zeros(features), -6.0
    docs, sentences = len(labels), len(doc_of)
    bad = labels == 1
    rate = np.where(bad, 0.5 / max(1, bad.sum()), 0.5 / max(1, (~bad).sum()))
    moment, spread = np.zeros(features + 1), np.zeros(features + 1)
    for step in range(1, STEPS + 1):
        logit = bias + np.bincount(sentence_of, weights=weights[feature_of], minlength=sentences)
        p, p0 = 1 / (1 + np.exp(-np.clip(logit, -40, 40))), 1 / (1 + np.exp(-bias))
        clean = plain * np.log1p(-p0) - np.bincount(doc_of, weights=np.logaddexp(0, logit), minlength=docs)
        toxic = np.maximum(-np.expm1(clean), 1e-12)
        # Of -log(toxic) or -log(1 - toxic) by each sentence's logit: a factor times its probability.
        factor = rate * np.where(bad, -np.exp(clean) / toxic, 1.0)
        by_logit = factor[doc_of] * p
        slope = np.empty(features + 1)
        pull = np.bincount(feature_of, weights=by_logit[sentence_of], minlength=features)
        held = np.sign(pull) * np.maximum(np.abs(pull) - LASSO, 0)
        slope[:-1] = np.where(weights != 0, pull + LASSO * np.sign(weights), held)
        slope[-1] = by_logit.sum() + (factor * plain).sum() * p0
        moment = 0.9 * moment + 0.1 * slope
        spread = 0.999 * spread + 0.001 * slope**2
        move = RATE * (moment / (1 - 0.9**step)) / (np.sqrt(spread / (1 - 0.999**step)) + 1e-8)
        moved = weights - move[:-1]
        # A weight stops at zero before it changes sides.
        weights = np.where(moved * weights < 0, 0.0, moved)
        bias -= move[-1]
    return weights, float(bias)


def centred_bias(labels, plain, doc_of, sentence_of, feature_of, weights, bias) -> float:
    """The bias, moved to the middle of the range where most training documents fall on their side of ``CUT``."""
    logit = np.bincount(sentence_of, weights=weights[feature_of], minlength=len(doc_of))
    choices = bias + np.arange(-8, 8.01, 0.25)
    errors = []
    for b in choices:
        clean = -plain * np.logaddexp(0, b) - np.bincount(doc_of, weights=np.logaddexp(0, b + logit), minlength=len(labels))
        errors.append(int(((-np.expm1(clean) >= CUT) != (labels == 1)).sum()))
    best = np.flatnonzero(np.array(errors) == min(errors))
    return float(choices[best[len(best) // 2]])


def learned(docs: DataFrame, labels: DataFrame, label: str = "toxic", sample: int = labelled.SAMPLE, **columns) -> SentenceModel:
    """Fit on at most ``sample`` labelled rows; the driver gets their chosen features only.

    Without any toxic or any clean row every sentence scores close to zero.
    """
    rows = common.staging(docs).cut(labelled.training_rows(docs, labels, label, sample=sample, **columns))
    features = chosen_features(rows)
    bag = bags(rows, features)
    if not features or len(np.unique(bag[0])) < 2:
        return SentenceModel({}, -20.0)
    weights, bias = fit(*bag, len(features))
    bias = centred_bias(*bag, weights, bias)
    return SentenceModel({f: float(w) for f, w in zip(features, weights, strict=True) if w}, bias)


def scored(docs: DataFrame, model: SentenceModel, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """(row, score): the columns of each document and its score; 0 for null and empty texts."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            score = [p for part in _batches(batch.column(1).to_pylist()) for p in shared.value.documents(part).tolist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score, pa.float64())], names=["row", "score"])

    row = F.struct(*[F.col(f"`{c}`") for c in keep or docs.columns]).alias("row")
    narrow = docs.select(row, F.col(f"`{text}`").cast("string").alias("text"))
    schema = T.StructType([T.StructField("row", narrow.schema["row"].dataType), T.StructField("score", T.DoubleType())])
    return narrow.mapInArrow(run, schema)


def offending_sentences(docs: DataFrame, model: SentenceModel, text: str = "text", cut: float = CUT) -> DataFrame:
    """(row, sentence, start, score): the sentences that alone reach ``cut``, with their place in the text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    narrow = docs.select(row, F.col(f"`{text}`").cast("string").alias("text"))
    schema = T.StructType(
        [
            T.StructField("row", narrow.schema["row"].dataType),
            T.StructField("sentence", T.StringType()),
            T.StructField("start", T.LongType()),
            T.StructField("score", T.DoubleType()),
        ]
    )

    def run(batches):
        for batch in batches:
            at, found = [], []
            for i, value in enumerate(batch.column(1).to_pylist()):
                parts = list(re.finditer(r"[^.!?\n]+[.!?]*", value or ""))
                words = [_bytes(p[0]).replace(STOP, b" ").split() for p in parts]
                if not parts:
                    continue
                score = 1 / (1 + np.exp(-np.clip(shared.value.sentence_scores(words), -40, 40)))
                for p, w, s in zip(parts, words, score.tolist(), strict=True):
                    if w and s >= cut:
                        at.append(i)
                        found.append((p[0].strip(), p.start(), s))
            columns = [pa.array([f[i] for f in found], k) for i, k in enumerate((pa.string(), pa.int64(), pa.float64()))]
            rows = batch.column(0).take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays([rows, *columns], names=schema.fieldNames())

    return narrow.mapInArrow(run, schema)
