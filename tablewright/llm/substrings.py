"""Removal of repeated word passages, found by recompression.

Words of a text are renamed in rounds: first runs of two equal words, then pairs of neighbours. A symbol's name is a
hash of its parts, the same wherever they occur, and whether two neighbours are joined depends on their two names
only (the first on one side of a random division of names, the second on the other). So two equal passages
get equal symbols but for a few words at their ends: one run and two rounds of pairs change at most 2, 2 and 4
words at either end. Of a window of 35 words the inner 19 are named alike wherever the window occurs, and hold at least
one symbol, as a symbol has 8 words at most. The window's anchor is the inner symbol with the smallest
hash of the nine words from it; :mod:`repeats` counts, compares and verifies from there.

Words are ``[^\\x20\\x09-\\x0D]+``, unchanged. Null, empty and short texts keep their words. A row that repeats another
is a copy of it, whatever its id.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.repeats import Scheme, Units, without_repeats
from tablewright.llm.text import Chunk, RollingHash, mix

WINDOW = 35
PAIR_ROUNDS = 2
EDGE = 8
CONTEXT = 9


def symbol_starts(words: np.ndarray, text_of_word: np.ndarray) -> np.ndarray:
    """The first words of the symbols after a round of runs and the rounds of pairs."""
    names, starts, text = words, np.arange(len(words)), text_of_word

    def join(first: np.ndarray) -> None:
        nonlocal names, starts, text
        merged = names.copy()
        at = np.flatnonzero(first)
        merged[at] = mix(names[at] * np.uint64(3) + mix(names[at + 1]))
        keep = np.ones(len(names), bool)
        keep[at + 1] = False
        names, starts, text = merged[keep], starts[keep], text[keep]

    if len(names) > 1:
        same = np.concatenate(([False], (names[1:] == names[:-1]) & (text[1:] == text[:-1]), [False]))
        # A run of exactly two: equal to the next word, and neither before nor after it goes on.
        join(same[1:] & ~same[:-1] & ~np.append(same[2:], False))
    for number in range(PAIR_ROUNDS):
        if len(names) < 2:
            break
        side = mix(names + np.uint64(number + 1)) >> np.uint64(63)
        pair = (side[:-1] == 0) & (side[1:] == 1) & (text[1:] == text[:-1])
        join(np.append(pair, False))
    return starts


def word_units(c: Chunk) -> Units:
    hashes = RollingHash(c.words)
    order = np.full(len(c.words), np.iinfo(np.uint64).max, np.uint64)
    starts = symbol_starts(c.words, c.text_of_word)
    starts = starts[starts + CONTEXT <= len(c.words)]
    order[starts] = hashes.of(starts, starts + CONTEXT) >> np.uint64(1)
    return Units(hashes, c.first_words[:-1], c.first_words[1:], order)


def describe(raw: bytes, kept: np.ndarray | None) -> tuple[str | None, str]:
    """The kept words joined by spaces (null if all are kept), and their digest."""
    words = raw.split()
    if kept is not None:
        words = [w for w, k in zip(words, kept, strict=True) if k]
    left = b" ".join(words)
    return None if kept is None else left.decode("utf-8", "replace"), hashlib.sha256(left).hexdigest()


WORDS = Scheme(
    size=WINDOW,
    lead=EDGE,
    reach=WINDOW - 2 * EDGE,
    context=CONTEXT,
    block=8,
    units=word_units,
    describe=describe,
    result="words",
)


def without_repeated_words(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: id, ``n_words``, ``n_removed``, ``kept_text`` and ``kept_sha256``."""
    found = without_repeats(docs, WORDS, id_column, text)
    return found.select(id_column, F.col("n").alias("n_words"), "n_removed", "kept_text", "kept_sha256")
