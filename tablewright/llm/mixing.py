"""Rates that mix documents to target token shares of domains.

Domains come from the labels table (``clean``: good and not toxic, ``poor``: not good, ``toxic``). A classifier
learned from at most ``PER_DOMAIN`` labelled documents of each gives every document a posterior over the domains:
a linear softmax over words that tell domains apart and over the rates of :mod:`quality`, corrected to the shares
of all labelled documents and calibrated on a part held back.

A document with ``n`` words and posterior ``p`` repeated at rate ``r`` is expected to add ``r n p`` tokens.
Rates start at 1 and follow projected gradient descent on the squared distance between the expected totals ``T``
and their targets ``t``, measured by the inverse of ``M = sum(n p p')``, within the box of rates from 0 to ``MAX_RATE``:

    r <- min(MAX_RATE, max(0, r - p' M^-1 (T - t)))

That metric bounds the curvature by 1, so the step needs no tuning, and without active bounds one step is
enough. Each iteration is one aggregation of a staged table of lengths and posteriors; a rate is a function of the
posterior and of the few vectors ``M^-1 (T - t)`` so far, so rates are never stored or sent.

A domain of which little is left cannot fill any target: the distance would be least when whatever looks a little like
it is raised and the rest given up; nor can a domain that the classifier hardly sees be emptied, but by giving up all that might belong to it.
So targets end where a domain's own documents end: between the totals when every document has a rate in proportion to
``1 - p``, and rate ``1 + p (MAX_RATE - 1)``; closer, when posteriors hardly differ (:func:`reach`). What that takes or gives is shared by the other domains, in proportion to their targets, and
:func:`shares` reports what was asked, what is aimed at and what is reached.

Null and empty texts have no words and rate 1 less their posterior's correction, like others. Without labels every
posterior is uniform. An empty corpus gives no rows. Of several labels of a document the worst counts. Repeated rows are
mixed alike. ``mixed`` replaces columns of the input that are called ``rate`` or ``copies``.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.frames import deal, fresh_name, per_text, small_batches
from tablewright.llm.quality import SIGNALS, measures
from tablewright.llm.softmax import softmax, temperature
from tablewright.llm.text import WORDS_ONLY, chunks
from tablewright.session import stage

DOMAINS = ("clean", "poor", "toxic")
TARGETS = {"clean": 0.90, "poor": 0.05, "toxic": 0.05}
#: The bound of the training sample, per domain.
PER_DOMAIN = 600
BUCKETS = 1 << 14
TELLING = 600
#: At most so many steps; enough when every total is within this share of all tokens.
ITERATIONS = 40
TOLERANCE = 1e-4
#: No document is repeated more often. Published trials find a few passes nearly as good as new text, and little gain
#: from more than some ten.
MAX_RATE = 8.0
#: Share of a posterior's variance from which on a domain counts as told apart; below, its target may move less.
SURE = 0.1
#: Decimals of a step: sums in another order, as after a lost executor, give the same rates.
DIGITS = 9


def word_buckets(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Text number and bucket of every distinct word bucket of the texts."""
    which, buckets = [], []
    for c in chunks([t.lower() if t else None for t in texts], WORDS_ONLY):
        cells = np.unique(c.text_of_word * BUCKETS + (c.words >> np.uint64(50)).astype(np.int64))
        which.append(cells // BUCKETS + c.first)
        buckets.append(cells % BUCKETS)
    return np.concatenate(which), np.concatenate(buckets)


def rates_of(counts: pd.DataFrame) -> np.ndarray:
    """The signals of the quality rules and the length, as columns."""
    columns = [counts[a] / np.maximum(counts[b], 1) for a, b in SIGNALS.values()]
    return np.column_stack([*columns, np.log1p(counts["n_words"]) / 10, np.ones(len(counts))])


@dataclass(frozen=True)
class Classifier:
    """Weights per bucket and per rate; a column per domain."""

    words: np.ndarray
    rates: np.ndarray

    def posteriors(self, texts: list[str | None], counts: pd.DataFrame) -> np.ndarray:
        logits = rates_of(counts) @ self.rates
        which, buckets = word_buckets(texts)
        for k in range(logits.shape[1]):
            logits[:, k] += np.bincount(which, self.words[buckets, k], len(texts))
        return softmax(logits)


def train(texts: list[str | None], y: np.ndarray, shares: np.ndarray, epochs: int = 60) -> Classifier:
    """A softmax over telling words and rates, from texts and their domain numbers."""
    random = np.random.RandomState(3)
    held = random.rand(len(y)) < 0.2
    n, domains = len(texts), len(DOMAINS)
    which, buckets = word_buckets(texts)
    own = ~held[which]
    seen = np.bincount(buckets[own], minlength=BUCKETS)
    score = np.zeros(BUCKETS)
    for k in range(domains):
        part = (y == k) & ~held
        expected = seen * part.sum() / max(1, (~held).sum())
        got = np.bincount(buckets[own & part[which]], minlength=BUCKETS)
        score += (got - expected) ** 2 / np.maximum(expected, 1)
    telling = np.sort(np.argsort(-score, kind="stable")[:TELLING])
    place = np.full(BUCKETS, -1)
    place[telling] = np.arange(len(telling))
    x = np.zeros((n, len(telling)))
    use = place[buckets] >= 0
    x[which[use], place[buckets[use]]] = 1
    x = np.column_stack([x, rates_of(measures(pd.Series(texts)))])
    weights = np.zeros((x.shape[1], domains))
    rows = np.flatnonzero(~held)
    for epoch in range(epochs):
        step = 0.3 / (1 + epoch / 10)
        order = random.permutation(rows)
        for i in range(0, len(order), 32):
            take = order[i : i + 32]
            error = softmax(x[take] @ weights)
            error[np.arange(len(take)), y[take]] -= 1
            weights -= step * (x[take].T @ error / len(take) + 0.002 * weights)
    sampled = np.bincount(y, minlength=domains) / max(1, n)
    correct = np.log(np.maximum(shares, 1e-9)) - np.log(np.maximum(sampled, 1e-9))
    weights /= temperature(x[held] @ weights, y[held])
    weights[-1] += np.where(sampled > 0, correct, -20.0)
    words = np.zeros((BUCKETS, domains))
    words[telling] = weights[: len(telling)]
    return Classifier(words, weights[len(telling) :])


def learn(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text") -> Classifier | None:
    """A classifier from a bounded sample of the labelled documents; None without any."""
    domain = F.when(F.col("toxic") > 0, 2).when(F.col("quality") > 0, 0).when(F.col("quality") <= 0, 1)
    known = labels.where(F.col(id_column).isNotNull()).groupBy(id_column)
    known = known.agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
    known = known.select(id_column, domain.alias("domain")).where("domain is not null")
    # Only documents that are here: earlier stages may have taken most of a domain. Of the rows of an id each counts,
    # as each is mixed.
    ids = docs.select(F.col(id_column)).where(F.col(id_column).isNotNull()).groupBy(id_column).agg(F.count("*").alias("n_rows"))
    present = stage(known.join(ids, id_column), "labelled")
    counts = {r["domain"]: r["n"] for r in present.groupBy("domain").agg(F.sum("n_rows").alias("n")).collect()}
    picked, _ = deal(present.select(id_column, "domain"), "domain", id_column, PER_DOMAIN)
    texts = docs.select(F.col(id_column), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    # At most PER_DOMAIN ids of each domain: small enough to send, whatever the size of the tables. An id may come in
    # several rows, so equal ones go before they are sent.
    rows = texts.join(F.broadcast(picked), id_column).select("domain", id_column, "text").distinct().collect()
    rows = sorted((r["domain"], r[id_column], r["text"]) for r in rows)
    if not rows:
        return None
    shares = np.array([counts.get(k, 0) for k in range(len(DOMAINS))], float)
    return train([r[2] for r in rows], np.array([r[0] for r in rows]), shares / shares.sum())


def posterior(model: Classifier | None) -> Callable[[Column], Column]:
    """A function of the text: its number of words and a probability per domain."""

    def predict(texts: pd.Series) -> pd.DataFrame:
        counts = measures(texts)
        if model is None:
            p = np.full((len(texts), len(DOMAINS)), 1 / len(DOMAINS))
        else:
            p = model.posteriors(texts.tolist(), counts)
        return pd.DataFrame({"n_tokens": counts["n_words"], **{f"p_{d}": p[:, k] for k, d in enumerate(DOMAINS)}})

    return per_text(predict, "n_tokens long, " + ", ".join(f"p_{d} double" for d in DOMAINS))


def rate_after(p: list[Column], steps: Sequence[np.ndarray]) -> Column:
    """The rate of a document with posterior ``p`` after the steps so far."""
    rate = F.lit(1.0)
    for step in steps:
        move = sum((column * F.lit(float(g)) for column, g in zip(p, step, strict=True)), F.lit(0.0))
        rate = F.least(F.lit(MAX_RATE), F.greatest(F.lit(0.0), rate - move))
    return rate


def reach(m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The lowest and highest total that each domain's own documents give, from the sums ``M``."""
    # Posteriors add up to 1, so the rows of M add up to the tokens of the domains.
    now, own, total = m.sum(axis=1), np.diag(m), max(m.sum(), 1e-300)
    share, sharpness = now / total, own / np.maximum(now, 1e-300)
    told_apart = np.clip((sharpness - share) / np.maximum(1 - share, 1e-9) / SURE, 0, 1)
    low = np.minimum(now, (now - own) / np.maximum(1 - share, 1e-9))  # rates scaled to keep the number of tokens
    return now - told_apart * (now - low), now + told_apart * (MAX_RATE - 1) * own


def within_reach(target: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Targets between ``low`` and ``high``; what that takes or gives is shared by the others in proportion."""
    found, held = target.copy(), np.zeros(len(target), bool)
    while (out := ((found > high) | (found < low)) & ~held).any():
        found[out] = np.clip(found, low, high)[out]
        held |= out
        rest = target * ~held
        if rest.sum() > 0:
            found[~held] = (rest / rest.sum() * max(0.0, target.sum() - found[held].sum()))[~held]
    return found


@dataclass(frozen=True)
class Fit:
    """Steps of the descent, and tokens per domain: asked for, aimed at, reached."""

    steps: tuple[np.ndarray, ...]
    asked: np.ndarray
    aimed: np.ndarray
    reached: np.ndarray


def fit(known: DataFrame, targets: Mapping[str, float]) -> Fit:
    """Projected gradient descent for ``known`` (``n_tokens`` and a column ``p_*`` per domain)."""
    p, n = [F.col(f"p_{d}") for d in DOMAINS], F.col("n_tokens")
    pairs = [F.sum(n * a * b) for a in p for b in p]
    m = np.array([v or 0.0 for v in known.agg(*pairs).first()]).reshape(len(p), len(p))
    weights = np.array([targets.get(d, 0.0) for d in DOMAINS])
    asked = weights / max(weights.sum(), 1e-300) * m.sum()
    aimed = within_reach(asked, *reach(m))
    inverse, steps = np.linalg.pinv(m, rcond=1e-9, hermitian=True), []
    for _ in range(ITERATIONS + 1):
        rate = rate_after(p, steps)
        reached = np.array([v or 0.0 for v in known.agg(*[F.sum(rate * n * column) for column in p]).first()])
        gap = reached - aimed
        if np.abs(gap).max() <= TOLERANCE * max(m.sum(), 1) or len(steps) == ITERATIONS:
            break
        steps.append(np.round(inverse @ gap, DIGITS))
    return Fit(tuple(steps), asked, aimed, reached)


def _known(docs: DataFrame, labels: DataFrame, id_column: str, text: str) -> tuple[DataFrame, Callable[[Column], Column]]:
    """Lengths and posteriors of all documents, staged, and the function that gives them."""
    small_batches(docs.sparkSession)
    predict = posterior(learn(docs, labels, id_column, text))
    known = docs.select(F.col(id_column), predict(F.col(f"`{text}`")).alias("d")).select(id_column, "d.*")
    return stage(known, "posteriors"), predict


def shares(
    docs: DataFrame,
    labels: DataFrame,
    targets: Mapping[str, float] = TARGETS,
    id_column: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Per domain its share of all tokens: now, ``asked`` for, ``aimed`` at within reach, and ``reached``."""
    known, _ = _known(docs, labels, id_column, text)
    found = fit(known, targets)
    now = known.agg(*[F.sum(F.col("n_tokens") * F.col(f"p_{d}")) for d in DOMAINS]).first()
    total = sum(v or 0.0 for v in now) or 1.0
    table = zip(DOMAINS, (v or 0.0 for v in now), found.asked, found.aimed, found.reached, strict=True)
    rows = [(d, *[float(v) / total for v in values]) for d, *values in table]
    return docs.sparkSession.createDataFrame(rows, "domain string, now double, asked double, aimed double, reached double")


def _columns(part: Column, steps: Sequence[np.ndarray], deal_by: Column) -> list[Column]:
    rate = rate_after([part[f"p_{d}"] for d in DOMAINS], steps)
    chance = F.pmod(F.xxhash64(deal_by, F.lit(29)), F.lit(1 << 20)) / (1 << 20)
    copies = F.floor(rate) + (chance < rate - F.floor(rate)).cast("long")
    return [rate.alias("rate"), copies.cast("long").alias("copies")]


def mix(
    docs: DataFrame,
    labels: DataFrame,
    targets: Mapping[str, float] = TARGETS,
    id_column: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Per row of ``docs``: id, words, posteriors, rate, and how often the document is in the mix.

    The number of copies is the rate rounded down, plus one for a share of documents dealt by a hash of the id.
    """
    known, _ = _known(docs, labels, id_column, text)
    steps = fit(known, targets).steps
    part = F.struct("*")
    return known.select(*known.columns, *_columns(part, steps, F.col(id_column)))


def mixed(
    docs: DataFrame,
    labels: DataFrame,
    targets: Mapping[str, float] = TARGETS,
    id_column: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """The rows of ``docs`` that are in the mix, with their ``rate`` and number of ``copies``."""
    known, predict = _known(docs, labels, id_column, text)
    steps = fit(known, targets).steps
    name = fresh_name(docs, "_domain")
    rows = docs.withColumn(name, predict(F.col(f"`{text}`")))
    kept = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("rate", "copies")]
    return rows.select(*kept, *_columns(F.col(name), steps, F.col(id_column))).where("copies > 0")
