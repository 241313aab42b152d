"""A linear softmax over features, trained by stochastic gradient descent, and its calibration."""

from __future__ import annotations

import numpy as np


def softmax(logits: np.ndarray) -> np.ndarray:
    z = np.exp(logits - logits.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True)


def temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The divisor of the logits under which held-out labels are most likely."""
    if not len(y):
        return 1.0
    choices = np.geomspace(0.05, 20, 60)
    loss = [-np.log(softmax(logits / t)[np.arange(len(y)), y] + 1e-12).mean() for t in choices]
    return float(choices[int(np.argmin(loss))])


def rejection(scores: np.ndarray, right: np.ndarray, accuracy: float) -> float:
    """The lowest score from which on held-out predictions are right often enough."""
    order = np.argsort(-scores, kind="stable")
    share = np.cumsum(right[order]) / np.arange(1, len(order) + 1)
    good = np.flatnonzero(share >= accuracy)
    return float(scores[order][good[-1]]) if len(good) else 1.0
