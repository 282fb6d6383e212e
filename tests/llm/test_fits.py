"""The fitted parts of op8 and op1 against plain optimisers."""

from __future__ import annotations

import math

import numpy as np
import pytest

from encore.llm import quality_ordinal, toxicity


def likelihood(w, cuts, x, y):
    """Mean log likelihood of a cumulative-link model, straight from its definition."""
    tail = 1 / (1 + np.exp(-(x @ w)[:, None] + cuts))
    full = np.hstack([np.ones((len(x), 1)), tail, np.zeros((len(x), 1))])
    p = full[np.arange(len(y)), y] - full[np.arange(len(y)), y + 1]
    return float(np.log(np.maximum(p, 1e-12)).mean())


def plain_optimum(x, y, top):
    """Best likelihood by coordinate search over weights, first threshold and log gaps."""
    theta = np.zeros(x.shape[1] + top)
    score = lambda t: likelihood(t[:x.shape[1]], np.cumsum(np.concatenate(
        [t[x.shape[1]:x.shape[1] + 1], np.exp(t[x.shape[1] + 1:])])), x, y)
    step, best = 1.0, score(theta)
    while step > 1e-4:
        moved = False
        for k in range(len(theta)):
            for d in (step, -step):
                other = theta.copy()
                other[k] += d
                if (s := score(other)) > best + 1e-9:
                    theta, best, moved = other, s, True
        step = step if moved else step / 2
    return best


def test_ordinal_fit_reaches_the_likelihood_of_a_plain_optimiser():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(1500, 4))
    z = x @ np.array([1.5, -2.0, 0.5, 0.0]) + rng.logistic(size=len(x))
    y = (z > -1).astype(int) + (z > 1.2)
    rows = [(int(g), np.arange(4, dtype=np.int32), v) for g, v in zip(y, x, strict=True)]
    model = quality_ordinal.fit_vectors(rows, 3, epochs=60, decay=0.0)
    got = likelihood(model.weights[:4], model.thresholds, x, y)
    assert got > plain_optimum(x, y, 2) - 0.01
    assert (np.diff(model.thresholds) > 0).all() and not model.weights[4:].any()
    assert np.allclose(model.weights[:4], [1.5, -2.0, 0.5, 0.0], atol=0.4)


def test_significance_rate_solves_its_equation():
    shares = {2.0: 0.01, 3.5: 0.002, 1.0: 0.05}
    rate = toxicity._significance_rate({}, shares, 0.5)
    assert (1 - sum(shares.values())) * math.exp(-rate * 0.5) + sum(
        p * math.exp(rate * s) for s, p in shares.items()) == pytest.approx(1.0, abs=1e-6)


def test_significance_constant_is_the_most_likely():
    rng = np.random.default_rng(9)
    rate, constant, best = 0.8, 0.03, []
    for n in rng.integers(5, 2000, 4000):
        s = (math.log(constant * n) - math.log(-math.log(rng.random()))) / rate
        best.append((int(n), max(0.0, s)))
    got = toxicity._significance_constant(best, rate)

    def fit(k):
        return sum(math.log(k * n) - rate * s - k * n * math.exp(-rate * s) if s > 0 else -k * n for n, s in best)
    assert got == pytest.approx(constant, rel=0.1)
    assert all(fit(got) >= fit(got * f) for f in (0.8, 0.95, 1.05, 1.2))
    assert toxicity._significance_constant([], rate) == 0.2
    assert 0 < toxicity._significance_constant([(100, 0.0)], rate) < 0.01


def test_quality_vectors_reach_the_driver_as_bytes(spark):
    import numpy as np
    from encore.llm import quality_ordinal as qo
    docs = spark.createDataFrame([(1, "A few words, a FEW words\n#"), (2, None)], "doc_id long, text string")
    grades = spark.createDataFrame([(1, 2), (2, 0)], "doc_id long, grade int")
    found = {r["id"]: r for r in qo.sample_vectors(docs, grades).collect()}
    for doc, text in ((1, "A few words, a FEW words\n#"), (2, None)):
        places, values = qo.features(text, 18)
        assert bytes(found[str(doc)]["places"]) == places.astype(np.int32).tobytes()
        assert bytes(found[str(doc)]["vals"]) == values.astype(np.float32).tobytes()
