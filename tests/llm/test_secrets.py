"""The secret scan: whole candidates, overlaps, words of any alphabet and length, and held-out findings."""

import random
import re

import pytest
from pyspark.sql import functions as F

from tablewright.llm import secrets
from tablewright.llm.text import Chunk

LETTERS = "abcdefghijklmnopqrstuvwxyz"


def key_block(draw, lines=12):
    letters = LETTERS + LETTERS.upper() + "0123456789+/"
    body = "\n".join("".join(draw.choices(letters, k=64)) for _ in range(lines))
    return f"-----BEGIN RSA PRIVATE KEY-----\n{body}\n-----END RSA PRIVATE KEY-----"


def token(draw, n=36):
    return "".join(draw.choices(LETTERS + LETTERS.upper() + "0123456789", k=n))


@pytest.fixture(scope="module")
def corpus(spark):
    """Prose with words of several alphabets, in which findings are put."""
    draw = random.Random(12)
    syllables = ["wet", "ter", "feld", "größ", "berg", "hau", "sen", "lich", "été", "mai", "son", "вод", "гор", "and", "ing"]
    vocabulary = ["".join(draw.choices(syllables, k=draw.randint(1, 6))) for _ in range(1500)]
    texts = [" ".join(draw.choices(vocabulary, k=draw.randint(20, 200))) for _ in range(300)]
    return texts, vocabulary, draw


def found_in(spark, texts, filler):
    docs = spark.createDataFrame(list(enumerate([*texts, *filler])), "doc_id long, text string").repartition(3)
    spans = {}
    for r in secrets.findings(docs).collect():
        text = texts[r["doc_id"]] if r["doc_id"] < len(texts) else filler[r["doc_id"] - len(texts)]
        spans.setdefault(r["doc_id"], []).append(text[r["start"] : r["start"] + r["length"]])
    return spans


def test_overlapping_candidates_are_all_judged(spark, corpus):
    filler, _, draw = corpus
    block, hidden = key_block(draw), "ghp_" + token(draw)
    texts = [
        f"note id_rsa_backup_2024{block} end",
        f"see password_url=https://host/x?k={hidden} today",
        f"{block}\n\n{key_block(draw, 3)}",
        "-----BEGIN PRIVATE KEY-----\n" * 3 + "nothing ends here",
    ]
    found = found_in(spark, texts, filler)
    assert block in "".join(found[0]) and any(hidden in s for s in found[1])
    assert len(found[2]) == 2 and 3 not in found


def test_candidates_are_judged_whole(spark, corpus):
    """What begins like a harmless path and goes on as a secret is not judged by its beginning, nor the other way round."""
    filler, vocabulary, draw = corpus
    plain = [w for w in vocabulary if re.fullmatch("[a-z]{4,}", w)]
    path = "/".join(draw.choices(plain, k=1500))
    assert len(path) > 8000
    raw = f"see {path}/2231 end".encode()
    (span,) = [s[1:3] for s in secrets._candidates(Chunk(0, [raw])) if s[3] == "run"]
    assert span == (4, len(raw) - 4)
    pairs = secrets.np.zeros((256, 256))
    whole = secrets.features(raw, *span, pairs, 0, {})
    longer = secrets.features(f"see {path}{token(draw, 6000)}/2231 end".encode(), 4, span[1] + 6000, pairs, 0, {})
    assert whole[0] == len(path) + 5 and longer[5] > 1.5 * whole[5]


def test_merged_spans():
    spans = [(0, 10, "run", 0.6), (5, 30, "assigned", 0.9), (30, 40, "run", 0.7), (12, 14, "run", 0.95)]
    assert secrets.merged(spans) == [(0, 30, "assigned", 0.95), (30, 40, "run", 0.7)]
    assert secrets.merged([]) == []


def test_many_begins_are_read_once():
    import time

    raw = b"-----BEGIN PRIVATE KEY-----\n" * 40_000
    began = time.perf_counter()
    assert list(secrets._blocks(raw)) == []
    assert len(list(secrets._blocks((raw + b"-----END PRIVATE KEY-----") * 2))) == 2
    assert time.perf_counter() - began < 5


def test_words_of_any_alphabet_and_length(spark):
    long = "donaudampfschifffahrtsgesellschaft"
    texts = [f"die {long} größtenteils водопад", f"secret={long}größtenteils_водопад7", None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    known = secrets.statistics(docs)
    words = {r[0] for r in known.where("word is not null").select("word").distinct().collect()}
    assert {long, "größtenteils", "водопад"} <= words
    spans = [tuple(s) for r in secrets.coverage(known).collect() for s in r["spans"]]
    assert max(n for _, _, n in spans) == len(long) + len("größtenteils") + len("водопад")
    assert secrets.covered("abcdefgh", ["abcd", "abcde", "fgh"]) == 5 and secrets.covered("abc", []) == 0


def test_words_beside_are_learned():
    pieces = [("the passphrase is ", 1)] * 6 + [("order number ", 0)] * 6 + [("rare ", 1)] * 2
    findings = [(head + "x" * 20, len(head), len(head) + 20, label) for head, label in pieces]
    found = secrets.learned_words(findings)
    assert found["passphrase"] > 0 > found["number"] and "rare" not in found


def test_held_out_findings(spark, corpus):
    """Precision and recall of 0.9 on findings that the forest has not seen, key blocks among them."""
    filler, _, _ = corpus
    known = secrets.statistics(spark.createDataFrame([(t,) for t in filler], "text string"))
    scanner = secrets.train(known, filler[:200])
    held = secrets.labelled_findings(filler[200:], seed=77)
    covered = secrets.letters_in_words(known, held)
    scores = scanner.scores([(t.encode(), b, e, n) for (t, b, e, _), n in zip(held, covered)])
    said = scores >= secrets.THRESHOLD
    label = secrets.np.array([f[3] for f in held], bool)
    assert (said & label).sum() / said.sum() >= 0.9 and (said & label).sum() / label.sum() >= 0.9
    blocks = secrets.np.array(["PRIVATE KEY" in t[b:e] for t, b, e, _ in held])
    assert 0 < (blocks & label).sum() < blocks.sum() and (said == label)[blocks].mean() >= 0.9


def test_long_texts_and_clashing_names(spark, corpus):
    filler, _, draw = corpus
    secret = token(draw, 40)
    long = " ".join(filler * 8) + f' api_key = "{secret}" ' + " ".join(filler * 8)
    assert len(long) > 1_200_000  # several chunks
    given = [(0, long, "a", "b", 1), (1, long, "a", "b", 1), (2, None, None, None, None)]
    given += [(3 + i, t, "a", "b", 1) for i, t in enumerate(filler)]
    docs = spark.createDataFrame(given, "doc_id long, text string, _spans string, _key string, n_chars int")
    clean = secrets.redacted(docs)
    assert clean.columns == docs.columns and clean.count() == docs.count()
    left = {r["doc_id"]: r["text"] for r in clean.where("doc_id < 3").collect()}
    assert left[0] == left[1] == long.replace(secret, "[REDACTED]") and left[2] is None
    assert clean.where(F.length("text") != F.col("n_chars")).count() == 0
