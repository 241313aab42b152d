"""Lines that many documents share, dropped from all documents but one.

Texts are cut at line feeds. A line's key is the line without the spaces and control characters ``[\\x20\\x09-\\x0D]`` at
both ends, its A-Z in lower case. Keys of ``min_chars`` code points or more are exploded and hashed to 128 bits; the
documents of a hash are counted, and a hash that ``min_documents`` or more hold keeps its lines only in the document
with the largest id. The rest of a text is put together again by the places of its lines.

Only hashes are shuffled to count: rows are made distinct by hash and document before documents are counted, so a line
that a third of all documents hold reaches the count as one row per task. A text is shuffled once, to meet the places
that it loses; those are keyed by id and text, so that rows that repeat an id each keep to their own text.

A null or empty text is one empty line. Rows with one id are one document, whose lines stay or go in all of them; rows
without an id are one document too, before all others. Copies of a line within the document that keeps it all stay. An
empty corpus gives no rows. Columns of ``docs`` other than id and text are not read, whatever their names. A text is
one value of a worker: its limit is that of an Arrow string, 2 GB.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.frames import per_text, small_batches
from tablewright.operators.sizing import broadcast_if_small, null_safe_on
from tablewright.session import stage

MIN_CHARS = 20
MIN_DOCUMENTS = 3

_SPACE = " \t\n\x0b\x0c\r"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_OUTCOME = "kept_text string, kept_sha256 string"


def _hashes(column: Column, name: str) -> list[Column]:
    """128 bits in two columns; the seeds differ, as the constant comes first."""
    return [F.xxhash64(F.lit(seed), column).alias(f"{name}{seed}") for seed in (1, 2)]


def line_key(line: Column) -> Column:
    """The line without space at its ends, A-Z in lower case."""
    key = F.btrim(line, F.lit(_SPACE))
    # In plain ASCII the quicker function does the same.
    ascii_only = F.octet_length(key) == F.char_length(key)
    return F.when(ascii_only, F.lower(key)).otherwise(F.translate(key, _UPPER, _UPPER.lower()))


def hashed_lines(docs: DataFrame, id_column: str, text: str, min_chars: int = MIN_CHARS) -> DataFrame:
    """Id, hash of the text (``t1``, ``t2``), place and hash (``h1``, ``h2``) of every line that is long enough."""
    text_column = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = docs.select(F.col(f"`{id_column}`").alias("id"), text_column.alias("text"))
    rows = rows.select("id", *_hashes(F.col("text"), "t"), F.posexplode(F.split("text", "\n", -1)).alias("place", "line"))
    rows = rows.select("id", "t1", "t2", "place", line_key(F.col("line")).alias("key"))
    return rows.where(F.char_length("key") >= min_chars).select("id", "t1", "t2", "place", *_hashes(F.col("key"), "h"))


def common_lines(lines: DataFrame, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """Hashes that enough documents hold, and the largest id of those."""
    held = lines.select("h1", "h2", "id").distinct().groupBy("h1", "h2")
    held = held.agg(F.count("*").alias("documents"), F.max("id").alias("last"))
    return held.where(F.col("documents") >= min_documents).select("h1", "h2", "last")


def _without(texts: pd.Series, places: pd.Series) -> pd.DataFrame:
    """The texts without the lines at the given places, and their digests; null where the text is null."""
    kept: list = [None] * len(texts)
    digests: list = [None] * len(texts)
    for i, (text, gone) in enumerate(zip(texts, places, strict=True)):
        if text is not None:
            lines = text.split("\n")
            stays = np.ones(len(lines), bool)
            stays[np.asarray(gone)] = False
            kept[i] = "\n".join(line for line, s in zip(lines, stays.tolist(), strict=True) if s)
            digests[i] = hashlib.sha256(kept[i].encode("utf-8", "surrogatepass")).hexdigest()
    return pd.DataFrame({"kept_text": pd.Series(kept, dtype=object), "kept_sha256": pd.Series(digests, dtype=object)})


def without_common_lines(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    min_chars: int = MIN_CHARS,
    min_documents: int = MIN_DOCUMENTS,
) -> DataFrame:
    """Per row of ``docs``: id, ``n_lines``, ``n_dropped``, ``kept_text`` and ``kept_sha256``."""
    small_batches(docs.sparkSession)
    lines = hashed_lines(docs, id_column, text, min_chars)
    common = broadcast_if_small(stage(common_lines(lines, min_documents), "common-lines"))
    gone = lines.join(common, ["h1", "h2"]).where(~F.col("id").eqNullSafe(F.col("last")))
    # Rows that repeat id and text come to the same places once.
    gone = gone.groupBy("id", "t1", "t2").agg(F.collect_set("place").alias("places"))

    rows = docs.select(F.col(f"`{id_column}`").alias("id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    rows = rows.select("*", *_hashes(F.col("text"), "t")).alias("rows")
    met = rows.join(gone.alias("gone"), null_safe_on("rows", "gone", ["id", "t1", "t2"]), "left")
    changed = F.when(F.col("places").isNotNull(), F.col("text"))  # only these go to a Python worker
    outcome = per_text(_without, _OUTCOME)(changed, F.col("places"))
    done = met.select(F.col("rows.id").alias("id"), "text", "places", outcome.alias("outcome"))
    return done.select(
        F.col("id").alias(id_column),
        (F.char_length("text") - F.char_length(F.translate("text", "\n", "")) + 1).cast("long").alias("n_lines"),
        F.coalesce(F.size("places"), F.lit(0)).cast("long").alias("n_dropped"),
        F.coalesce("outcome.kept_text", "text").alias("kept_text"),
        F.coalesce("outcome.kept_sha256", F.sha2("text", 256)).alias("kept_sha256"),
    )
