"""Decontamination against Smith-Waterman over all pairs of documents and items."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablewright.llm import decontaminate
from tests.helpers import rows


def full_score(item, words):
    """The best local alignment of an item with a whole document, as a share of a full match."""
    best, before = 0, [0] * (len(words) + 1)
    for w in item:
        row = [0]
        for j, v in enumerate(words):
            row.append(max(0, before[j] + (2 if v == w else -1), before[j + 1] - 1, row[j] - 1))
        best, before = max(best, *row), row
    return best / (2 * len(item))


@pytest.fixture(scope="module")
def corpus():
    draw = random.Random(21)
    vocabulary = [f"v{i}" for i in range(900)]
    items = [(i, draw.choices(vocabulary, k=draw.choice([3, 5, 12, 40]))) for i in range(40)]
    texts = []
    for n in range(120):
        words = draw.choices(vocabulary, k=draw.randint(0, 150))
        if n % 3 == 0:
            _, item = draw.choice(items)
            copy = [w for w in item if draw.random() > 0.1]
            copy = [draw.choice(vocabulary) if draw.random() < 0.15 else w for w in copy]
            at = draw.randint(0, len(words))
            words = words[:at] + copy + words[at:]
        texts.append((n, words))
    return items, texts


@pytest.mark.parametrize("bits", [1 << 26, 1 << 15])
@pytest.mark.parametrize("small", [True, False])
def test_all_pairs(spark, monkeypatch, corpus, bits, small):
    """Also with a map of seeds that lets many through, and with joins by shuffle."""
    monkeypatch.setattr(decontaminate, "BITS", bits)
    if not small:
        monkeypatch.setattr("tablewright.operators.sizing.fits_broadcast", lambda df, limit=0: False)
    items, texts = corpus
    docs = spark.createDataFrame([(n, " ".join(w), "a", "b") for n, w in texts], "doc_id long, text string, d1 string, found string")
    bench = spark.createDataFrame([(i, " ".join(w).upper() + "!", 5) for i, w in items], "item_id long, text string, id int")
    found = {(r["doc_id"], r["item_id"]): r["score"] for r in decontaminate.leaks(docs.repartition(3), bench).collect()}
    scores = {(n, i): full_score(item, words) for n, words in texts for i, item in items if words}
    expected = {pair: s for pair, s in scores.items() if s >= decontaminate.MIN_SCORE}
    # All that is found is right, and of what may be found all is that has five words in a row of the item.
    assert all(abs(expected[pair] - s) < 1e-9 for pair, s in found.items())
    runs = lambda words, n: {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}
    reach = decontaminate.SEED + decontaminate.REACH - 1
    of_item, of_text = dict(items), dict(texts)
    sure = {(n, i) for n, i in expected if runs(of_item[i], min(reach, len(of_item[i]))) & runs(of_text[n], min(reach, len(of_item[i])))}
    assert sure <= set(found) and len(sure) > 20
    clean = decontaminate.keep_clean(docs, bench)
    assert clean.columns == docs.columns
    assert {r["doc_id"] for r in clean.collect()} == {n for n, _ in texts} - {n for n, _ in found}


def test_copies_are_marked_alike(spark, corpus):
    items, _ = corpus
    text = " ".join(next(w for _, w in items if len(w) == 40))
    docs = spark.range(50).select((F.col("id") % 20).alias("doc_id"), F.lit(text).alias("text"))
    bench = spark.createDataFrame([(1, text), (2, text)], "item_id long, text string")
    found = decontaminate.leaks(docs.unionByName(docs), bench)
    assert found.count() == 200 and found.where("score < 1").count() == 0
    marked = decontaminate.mark(docs, bench, "hits")
    assert marked.columns == ["doc_id", "text", "hits"] and marked.where("size(hits) = 2").count() == 50
    assert decontaminate.leaks(docs.limit(0), bench).count() == decontaminate.leaks(docs, bench.limit(0)).count() == 0


def test_long_texts(spark, corpus):
    items, _ = corpus
    item = next(w for _, w in items if len(w) == 40)
    words = [f"z{i}" for i in range(150_000)]
    text = " ".join(words[:100_000] + item + words[100_000:])
    docs = spark.createDataFrame([(1, text), (2, " ".join(words))], "doc_id long, text string")
    bench = spark.createDataFrame([(9, " ".join(item))], "item_id long, text string")
    (r,) = decontaminate.leaks(docs, bench).collect()
    assert (r["doc_id"], r["item_id"], r["score"]) == (1, 9, 1.0) and r["passage_start"] <= 100_000 <= r["passage_end"] - 40


def test_rarest_of_every_three(spark):
    """Against a plain loop over runs."""
    draw = random.Random(2)
    given, expected = [], set()
    for uid, size in enumerate([1, 2, 3, 4, 30]):
        n = [draw.choice([0, 1, 5]) for _ in range(size)]
        given += [(uid, size + 2, at, uid * 1000 + at, c) for at, c in enumerate(n)]
        for at in range(max(1, size - 2)):
            run = n[at : at + 3]
            expected.add((uid, at + int(np.argmin(run))))
    df = spark.createDataFrame(given, "uid long, size long, at long, seed long, n long")
    found = decontaminate.rarest(df.drop("n"), df.where("n > 0").select("seed", "n"))
    assert set(rows(found, "uid", "at")) == expected
