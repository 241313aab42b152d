"""Removal of repeated byte strings, found by a prefix-free parse.

Triggers are the places where the rolling hash of 16 bytes is lowest among 92 neighbouring ones; they cut a text
into phrases. As a trigger depends on the bytes around it only, equal strings are cut alike, and every string of
200 bytes holds a trigger of its own with the 108 bytes from it. The dictionary names every distinct phrase beginning
of 108 bytes and counts it; the parse is the sequence of names of every text. Only suffixes that start near a
phrase which the dictionary counts twice can share 200 bytes with another, so only these are compared (:mod:`repeats`):
in blocks of neighbouring suffixes first, one by one where blocks differ.

Suffixes are put into classes of equal 200-byte prefixes by name and not sorted: order within a class changes
nothing, and a full suffix array of the corpus would take many times its size on disk.

Null texts are empty. Short texts keep their bytes. A row that repeats another is a copy of it, whatever its id.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.repeats import Scheme, Units, without_repeats
from tablewright.llm.text import Chunk

WINDOW = 200
TRIGGER = 16
REACH = 92


def byte_units(c: Chunk) -> Units:
    order = np.full(len(c.data), np.iinfo(np.uint64).max, np.uint64)
    triggers = c.byte_hash.sliding(TRIGGER)
    order[: len(triggers)] = triggers
    return Units(c.byte_hash, c.starts[:-1], c.starts[1:] - 1, order)


def describe(raw: bytes, kept: np.ndarray | None) -> tuple[str | None, str]:
    """The remaining bytes as text (null if all remain), and their digest."""
    if kept is not None:
        raw = np.frombuffer(raw, np.uint8)[kept].tobytes()
    return None if kept is None else raw.decode("utf-8", "replace"), hashlib.sha256(raw).hexdigest()


BYTES = Scheme(
    size=WINDOW,
    lead=0,
    reach=REACH,
    context=WINDOW - REACH,
    block=23,
    units=byte_units,
    describe=describe,
    result="bytes",
)


def without_repeated_bytes(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: id, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_text`` and ``kept_sha256``."""
    return without_repeats(docs, BYTES, id_column, text).withColumnRenamed("n", "n_bytes")
