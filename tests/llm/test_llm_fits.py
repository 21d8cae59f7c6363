"""What the classifiers minimise, worked out by plain loops."""

import numpy as np
import pytest

from mapweave.llm import quality, toxicity


@pytest.mark.parametrize("seed", range(5))
def test_the_quantile_has_the_least_balanced_error(seed):
    draw = np.random.default_rng(seed)
    raw = np.round(draw.normal(0, 1, 40), 1 if seed % 2 else 6)
    labels = (raw + draw.normal(0, 1, 40) > 0.3).astype(int)

    def error(rejected):
        good, bad = labels == 1, labels == 0
        return (good & rejected).sum() / good.sum() + (bad & ~rejected).sum() / bad.sum()

    # Every cut of the sorted scores, ties broken as they stand.
    order = np.argsort(raw, kind="stable")
    least = min(error(np.isin(np.arange(40), order[:k])) for k in range(41))
    cut = quality.best_quantile(raw, labels)
    places = [k for k in range(41) if error(np.isin(np.arange(40), order[:k])) == pytest.approx(least)]
    k = places[len(places) // 2]
    assert cut == pytest.approx((raw[order[max(k - 1, 0)]] + raw[order[min(k, 39)]]) / 2)


def test_the_ranking_minimises_the_pair_loss():
    draw = np.random.default_rng(3)
    labels = draw.integers(0, 2, 300)
    rows = draw.normal(0, 1, (300, 3)) * [1, 5, 0.2] + labels[:, None] * [1.0, 2.0, 0.0]
    model = quality.fit(rows, labels, pairs=3000)
    x = (rows - rows.mean(axis=0)) / rows.std(axis=0)
    again = np.random.default_rng(quality.SEED)
    good, bad = again.choice(np.flatnonzero(labels == 1), 3000), again.choice(np.flatnonzero(labels == 0), 3000)

    def loss(weights):
        total = sum(np.log1p(np.exp(-(x[g] - x[b]) @ weights)) for g, b in zip(good.tolist(), bad.tolist()))
        return total / 3000 + quality.DECAY * (weights @ weights) / 2

    found = loss(model.weights)
    assert found < loss(np.zeros(3)) - 0.1
    for step in np.vstack([np.eye(3), -np.eye(3)]) * 0.05:
        assert found <= loss(model.weights + step) + 1e-4
    assert model.score(rows[labels == 1]).mean() > model.score(rows[labels == 0]).mean()


def bag_loss(bags, labels, weights, bias):
    """The penalised loss of documents, each a list of sentences, each a list of features."""
    total = toxicity.LASSO * np.abs(weights).sum()
    bad = sum(labels)
    for sentences, label in zip(bags, labels):
        clean = 1.0
        for features in sentences:
            clean *= 1 - 1 / (1 + np.exp(-(bias + sum(weights[f] for f in features))))
        likely = max(1 - clean, 1e-12) if label else clean
        total -= 0.5 / (bad if label else len(labels) - bad) * np.log(likely)
    return total


def test_the_noisy_or_is_fitted_to_the_documents():
    draw = np.random.default_rng(4)
    labels = np.array([1] * 25 + [0] * 35)
    bags = []
    for label in labels:
        sentences = [list(draw.choice(np.arange(1, 6), draw.integers(0, 4), replace=False)) for _ in range(draw.integers(1, 6))]
        if label:
            # Toxic documents have feature 0 in one of their sentences.
            sentences[draw.integers(len(sentences))].append(0)
        bags.append(sentences)
    plain = np.array([sum(not s for s in b) for b in bags])
    held = [(d, s) for d, b in enumerate(bags) for s in b if s]
    doc_of = np.array([d for d, _ in held])
    sentence_of = np.repeat(np.arange(len(held)), [len(s) for _, s in held])
    feature_of = np.array([f for _, s in held for f in s])
    weights, bias = toxicity.fit(labels, plain, doc_of, sentence_of, feature_of, 6)
    found = bag_loss(bags, labels, weights, bias)
    assert found < bag_loss(bags, labels, np.zeros(6), -6.0) / 4
    assert weights[0] == weights.max() > 2
    # The loss falls no further than the steps still left could take it.
    for step in np.vstack([np.eye(7), -np.eye(7)]) * 0.5:
        assert found <= bag_loss(bags, labels, weights + step[:6], bias + step[6]) + 0.01
    model = toxicity.SentenceModel({}, bias)
    assert model.documents([None, ""]).tolist() == [0, 0]
