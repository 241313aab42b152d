"""The mix within its box: bounded rates, targets within reach, and the descent against a dense one."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablewright.llm import mixing

TARGETS = {"clean": 0.9, "poor": 0.05, "toxic": 0.05}


def posteriors(spark, p, n):
    rows = [(int(k), *map(float, q)) for k, q in zip(n, p, strict=True)]
    return spark.createDataFrame(rows, "n_tokens long, p_clean double, p_poor double, p_toxic double")


def some_posteriors(shares, size=3000, seed=1, sharp=8):
    draw = np.random.RandomState(seed)
    logits = np.log(np.array(shares)) + sharp * np.eye(3)[draw.choice(3, size, p=shares)] + draw.normal(size=(size, 3))
    p = np.exp(logits - logits.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True), draw.randint(1, 400, size)


def descent(p, n, target):
    """The same projected gradient descent with a rate per document, kept."""
    inverse = np.linalg.pinv(p.T @ (p * n[:, None]), rcond=1e-9, hermitian=True)
    rate = np.ones(len(p))
    for _ in range(mixing.ITERATIONS):
        gap = p.T @ (rate * n) - target
        if np.abs(gap).max() <= mixing.TOLERANCE * n.sum():
            break
        rate = np.clip(rate - p @ np.round(inverse @ gap, mixing.DIGITS), 0, mixing.MAX_RATE)
    return rate


@pytest.mark.parametrize("shares", [(0.7, 0.2, 0.1), (0.98, 0.001, 0.019), (0.94, 0.05, 0.01), (1 / 3, 1 / 3, 1 / 3)])
def test_fit_is_the_dense_descent(spark, shares):
    p, n = some_posteriors(shares)
    known = posteriors(spark, p, n)
    found = mixing.fit(known, TARGETS)
    columns = [F.col(f"p_{d}") for d in mixing.DOMAINS]
    rates = np.array([r[0] for r in known.select(mixing.rate_after(columns, found.steps)).collect()])
    assert np.allclose(rates, descent(p, n, found.aimed), atol=1e-6)
    assert rates.min() >= 0 and rates.max() <= mixing.MAX_RATE
    assert np.allclose(found.reached, p.T @ (rates * n))
    assert np.abs(found.reached - found.aimed).max() <= mixing.TOLERANCE * n.sum()
    assert np.isclose(found.aimed.sum(), n.sum()) and np.allclose(found.asked / n.sum(), list(TARGETS.values()))


@pytest.mark.parametrize("poor", [0, 3, 12, 40])
def test_an_empty_domain_does_not_cost_the_others(spark, poor):
    p, n = some_posteriors((0.94, 0.01, 0.05), size=2000, sharp=12)
    own = p.argmax(axis=1) == 1
    p, n = np.concatenate([p[~own], np.tile([0.02, 0.97, 0.01], (poor, 1))]), np.concatenate([n[~own], np.full(poor, 100)])
    known = posteriors(spark, p, n)
    found = mixing.fit(known, TARGETS)
    columns = [F.col(f"p_{d}") for d in mixing.DOMAINS]
    rates = np.array([r[0] for r in known.select(mixing.rate_after(columns, found.steps)).collect()])
    clean = p[:, 0] > 0.9
    assert rates[clean].min() > 0.85 and rates[clean].max() < 1.3 and rates.max() <= mixing.MAX_RATE
    assert (found.aimed[1] < found.asked[1] or poor == 40) and found.reached[1] <= mixing.MAX_RATE * (p[:, 1] * n).sum() + 1e-6


def test_targets_within_reach():
    def within(t, high, low=(0, 0, 0)):
        return mixing.within_reach(*[np.array(x, float) for x in (t, low, high)]).tolist()

    assert within([90, 5, 5], [400, 400, 400]) == [90, 5, 5]
    assert within([90, 5, 5], [400, 0, 400]) == pytest.approx([100 * 90 / 95, 0, 100 * 5 / 95])
    # What one gives up may be more than another can take.
    assert within([50, 45, 5], [52, 0, 400]) == pytest.approx([52, 0, 48])
    assert within([50, 50, 0], [10, 20, 400]) == [10, 20, 0]
    assert within([90, 5, 5], [400, 400, 400], [0, 0, 15]) == pytest.approx([85 * 90 / 95, 85 * 5 / 95, 15])


def test_a_domain_that_is_hardly_told_apart_is_not_emptied(spark):
    draw = np.random.RandomState(2)
    toxic = draw.uniform(0.03, 0.05, 2000)
    p = np.column_stack([1 - toxic - 0.01, np.full(2000, 0.01), toxic])
    known = posteriors(spark, p, draw.randint(1, 400, 2000))
    found = mixing.fit(known, {"clean": 0.97, "poor": 0.01, "toxic": 0.02})
    columns = [F.col(f"p_{d}") for d in mixing.DOMAINS]
    rates = np.array([r[0] for r in known.select(mixing.rate_after(columns, found.steps)).collect()])
    assert rates.min() > 0.9 and found.aimed[2] > found.asked[2]


def test_shares_are_reported(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "labels"))
    found = {r["domain"]: r for r in mixing.shares(docs, labels, {"clean": 0.5, "poor": 0.3, "toxic": 0.2}).collect()}
    assert abs(sum(r["now"] for r in found.values()) - 1) < 1e-6
    for r in found.values():
        assert r["aimed"] == pytest.approx(r["asked"]) and r["reached"] == pytest.approx(r["aimed"], abs=2e-4)
    named = docs.withColumns({"rate": F.lit("x"), "copies": F.lit("y"), "_domain": F.lit("z")})
    kept = mixing.mixed(named, labels, TARGETS)
    assert kept.columns == [*docs.columns, "_domain", "rate", "copies"] and kept.schema["rate"].dataType.typeName() == "double"
    assert kept.where(f"rate > {mixing.MAX_RATE} or rate < 0").count() == 0
