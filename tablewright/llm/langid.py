"""Language identification from averaged subword embeddings.

Byte n-grams of the lower-cased text are hashed into buckets; every bucket has a small embedding. A text is
the average of the embeddings of all its n-grams, and a linear softmax over that average predicts the
language. Embeddings and weights are trained together by stochastic gradient descent in numpy, on a bounded
sample of labelled texts (``PER_LANGUAGE`` texts of each language at most, dealt by a hash of the id) and
short fragments of them. A part of the sample is held back to calibrate the scores (temperature) and the
score below which a prediction is rejected.

Averaging and the linear layer commute, so prediction sums one row of ``embedding @ weights`` per n-gram:
whole texts of any length in one pass.

Null texts and texts without a letter are ``und`` with score 0 and not accepted. Without labelled texts every
text is. Languages are the non-null labels. Repeated rows are predicted alike; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.frames import deal, per_text, small_batches
from tablewright.llm.softmax import rejection, softmax, temperature
from tablewright.llm.text import Chunk, chunks

BITS = 13
BUCKETS = 1 << BITS
ORDERS = (2, 3, 4)
DIMENSIONS = 16
#: The bound of the training sample, per language.
PER_LANGUAGE = 300
FRAGMENT_WORDS = (3, 8)
ACCURACY = 0.98
UNKNOWN = "und"

_FOLD = np.arange(256, dtype=np.uint32)
_FOLD[[9, 10, 11, 12, 13]] = 0x20
_FOLD[0x30:0x3A] = 0x30


def subwords(c: Chunk) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For every order: the bucket of the n-gram at each byte, and whether it lies within its text."""
    data, n = _FOLD[c.data], len(c.data)
    ends = np.repeat(c.starts[1:], np.diff(c.starts))
    value = data
    for order in range(2, max(ORDERS) + 1):
        value = value[: n - order + 1] * np.uint32(0x01000193) ^ data[order - 1 :]
        if order in ORDERS:
            scattered = (value + np.uint32(order)) * np.uint32(0x9E3779B1)
            yield scattered >> np.uint32(32 - BITS), np.arange(len(value)) + order <= ends[: len(value)]


def averages(c: Chunk, rows: np.ndarray) -> np.ndarray:
    """Per text the average of ``rows`` (one per bucket) over all n-grams."""
    sums, total = np.zeros((c.n, rows.shape[1])), np.zeros(c.n)
    for buckets, inside in subwords(c):
        reach = np.minimum(c.starts[:-1], len(buckets) - 1) if len(buckets) else None
        if reach is None:
            continue
        empty = c.starts[:-1] >= len(buckets)
        for k in range(rows.shape[1]):
            part = np.add.reduceat(np.where(inside, rows[buckets, k], 0), reach)
            sums[:, k] += np.where(empty, 0, part)
        total += np.where(empty, 0, np.add.reduceat(inside.astype(np.int64), reach))
    return sums / np.maximum(total, 1)[:, None]


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    rows: np.ndarray
    bias: np.ndarray
    threshold: float

    def scores(self, texts: list[str | None]) -> np.ndarray:
        lowered = [t.lower() if t else "" for t in texts]
        found = [softmax(averages(c, self.rows) + self.bias) for c in chunks(lowered)]
        return np.concatenate(found) if found else np.zeros((0, len(self.languages)))


def _bags(texts: list[str]) -> np.ndarray:
    """Relative frequencies of the buckets in each text."""
    bags = np.zeros((len(texts), BUCKETS), np.float32)
    for c in chunks([t.lower() for t in texts]):
        which = np.repeat(np.arange(c.n), np.diff(c.starts))
        for buckets, inside in subwords(c):
            cells = which[: len(buckets)][inside] * BUCKETS + buckets[inside]
            bags[c.first : c.first + c.n] += np.bincount(cells, minlength=c.n * BUCKETS).reshape(c.n, BUCKETS)
    return bags / np.maximum(bags.sum(axis=1, keepdims=True), 1)


def _fragments(text: str, random: np.random.RandomState) -> list[str]:
    words = text.split()
    found = []
    for size in FRAGMENT_WORDS:
        at = random.randint(0, max(1, len(words) - size + 1))
        found.append(" ".join(words[at : at + size]))
    return found


def train(texts: list[str], labels: list[str], epochs: int = 12, rate: float = 20.0) -> Model | None:
    """Fit embeddings and softmax; a fifth of the texts is held back for calibration."""
    languages = tuple(sorted(set(labels)))
    if not languages:
        return None
    random = np.random.RandomState(7)
    held = random.rand(len(texts)) < 0.2
    samples: dict[bool, tuple[list, list]] = {False: ([], []), True: ([], [])}
    for text, label, h in zip(texts, labels, held, strict=True):
        for piece in [text, *_fragments(text, random)]:
            samples[bool(h)][0].append(piece)
            samples[bool(h)][1].append(languages.index(label))
    x, y = _bags(samples[False][0]), np.array(samples[False][1], int)
    rows = (random.rand(BUCKETS, DIMENSIONS).astype(np.float32) - 0.5) / DIMENSIONS
    weights = (random.rand(DIMENSIONS, len(languages)).astype(np.float32) - 0.5) / DIMENSIONS
    bias = np.zeros(len(languages), np.float32)
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        order = random.permutation(len(y))
        for i in range(0, len(order), 32):
            take = order[i : i + 32]
            hidden = x[take] @ rows
            error = softmax(hidden @ weights + bias).astype(np.float32)
            error[np.arange(len(take)), y[take]] -= 1
            error /= len(take)
            back = error @ weights.T
            weights -= step / 20 * (hidden.T @ error)
            rows -= step * (x[take].T @ back)
            bias -= step / 200 * error.sum(axis=0)
    table = rows @ weights
    logits, truth = _bags(samples[True][0]) @ table + bias, np.array(samples[True][1], int)
    t = temperature(logits, truth)
    threshold = 1.0
    if len(truth):
        p = softmax(logits / t)
        threshold = rejection(p.max(axis=1), p.argmax(axis=1) == truth, ACCURACY)
    return Model(languages, (table / t).astype(np.float32), bias / t, threshold)


def labelled_sample(
    docs: DataFrame, usable: Column, id_column: str, text: str, label: str, bound: int = PER_LANGUAGE
) -> tuple[list[str], list[str]]:
    """At most ``bound`` labelled texts of each language, dealt by a hash of the id."""
    rows = docs.where(usable & F.col(label).isNotNull() & F.col(text).rlike(r"\p{L}"))
    rows = rows.select(F.col(label).alias("label"), F.col(text).alias("text"), F.col(id_column).alias("id"))
    picked = sorted(deal(rows, "label", "id", bound)[0].collect(), key=lambda r: (r["label"], str(r["id"]), r["text"]))
    return [r["text"] for r in picked], [r["label"] for r in picked]


def predictor(model: Model | None) -> Callable[[Column], Column]:
    """A function of the text: ``lang_pred``, ``score`` and ``accepted``."""

    def predict(texts: pd.Series) -> pd.DataFrame:
        if model is None:
            return pd.DataFrame({"lang_pred": UNKNOWN, "score": 0.0, "accepted": False}, index=texts.index)
        scores = model.scores(texts.tolist())
        best = scores.argmax(axis=1)
        top = scores.max(axis=1) if len(scores) else np.zeros(0)
        names = np.array(model.languages, object)[best]
        return pd.DataFrame({"lang_pred": names, "score": top, "accepted": top >= model.threshold})

    return per_text(predict, "lang_pred string, score double, accepted boolean")


def identify(
    docs: DataFrame,
    usable: Column | None = None,
    id_column: str = "doc_id",
    text: str = "text",
    label: str = "lang",
) -> DataFrame:
    """Per row: id, ``lang_pred``, ``score`` and ``accepted``, learned from the rows that are ``usable``."""
    small_batches(docs.sparkSession)
    usable = F.lit(True) if usable is None else usable
    model = train(*labelled_sample(docs, usable, id_column, text, label))
    plain = docs.select(F.col(id_column), F.col(text).alias("text"))
    found = plain.select(
        id_column,
        F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("_letters"),
        predictor(model)(F.col("text")).alias("_p"),
    )
    return found.select(
        id_column,
        F.when(F.col("_letters"), F.col("_p.lang_pred")).otherwise(UNKNOWN).alias("lang_pred"),
        F.when(F.col("_letters"), F.col("_p.score")).otherwise(0.0).alias("score"),
        (F.col("_letters") & F.col("_p.accepted")).alias("accepted"),
    )
