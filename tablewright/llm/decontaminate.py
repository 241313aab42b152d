"""Documents that hold items of a test set, edited copies included.

Words are compared in lower case without ASCII punctuation. Seeds are runs of ``SEED`` words of the items.
Their frequencies in the whole corpus are counted, and of every ``REACH`` seeds in a row the rarest is kept
(so each stretch of ``SEED + REACH - 1`` words of an item has a seed, however frequent the item itself is).
Seeds of documents are joined with those; where one occurs in both, the passage around it, reaching half the item's length further
on both sides, is aligned with the item (Smith-Waterman: match 2, mismatch -1, gap -1). The score is the alignment's
share of a full match; from ``MIN_SCORE`` on the document counts as contaminated by the item.

Items stay a table. What tasks hold of them is a bitmap of ``BITS`` bits, whatever their number: it says which seeds of a document
no item has, and those are not shuffled. Documents go by 128-bit hashes of their texts, so copies are searched
alike and aligned once. Seeds are counted in a task before they are shuffled. Tables that have been measured to be small are broadcast; beyond, adaptive
execution splits the join partitions of a hot seed or item.

Null and empty texts match nothing, on either side; nor do items of fewer than ``SEED`` words. Items repeated
under several ids are all reported, rows repeated under one id once. With either table empty nothing is found. Columns of the documents
may have any names; a text is one value of a worker.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewright.llm.frames import fresh_name, small_batches
from tablewright.llm.text import WORDS_ONLY, Chunk, RollingHash, chunks
from tablewright.operators.sizing import broadcast_if_small
from tablewright.session import stage

SEED = 3
REACH = 3
MIN_SCORE = 0.5
MATCH, MISMATCH, GAP = 2, 1, 1
#: Bits of the map of seeds that is sent to the tasks: 8 MB. A fuller map lets more seeds through, and the join drops them.
BITS = 1 << 26
#: Bits that Spark puts into one bitmap.
_BUCKET = 32768
#: Cells of an alignment row handled together.
CELLS = 1_000_000

FOUND = "array<struct<item_id:long,score:double,passage_start:long,passage_end:long>>"


def folded(texts: list[str | None]) -> Iterator[Chunk]:
    """Chunks of lower-cased texts with ASCII punctuation as spaces."""
    return chunks([t.lower() if t else None for t in texts], WORDS_ONLY)


def _signed(hashes: np.ndarray) -> np.ndarray:
    return hashes.astype(np.uint64).view(np.int64)


def _text_hashes(text: str, names: tuple[str, str] = ("d1", "d2")) -> list[Column]:
    column = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    return [F.xxhash64(F.lit(seed), column).alias(name) for seed, name in enumerate(names)]


# --- items and their seeds ------------------------------------------------------------


def read_items(items: DataFrame, item_id: str, text: str) -> DataFrame:
    """``uid``, ``id`` and hashes of the ``words`` of every item with a seed, staged."""

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for c in folded(batch["text"].to_pylist()):
                found += np.split(_signed(c.words), c.first_words[1:-1])
            columns = [batch["id"], pa.array(found, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["id", "words"])

    rows = items.select(F.col(item_id).cast("long").alias("id"), F.col(text).alias("text"))
    rows = rows.where("id is not null and text is not null").distinct()
    found = rows.mapInArrow(words, "id long, words array<long>").where(F.size("words") >= SEED)
    return stage(found.withColumn("uid", F.monotonically_increasing_id()), "items")


def item_seeds(items: DataFrame) -> DataFrame:
    """``uid``, ``size`` of the item, place ``at`` and hash of every ``seed``."""

    def seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uid, words in zip(batch["uid"].to_pylist(), batch["words"], strict=True):
                hashes = np.asarray(words.values.to_numpy(zero_copy_only=False)).view(np.uint64)
                at = np.arange(len(hashes) - SEED + 1)
                columns = [np.full(len(at), uid), np.full(len(at), len(hashes)), at]
                columns.append(_signed(RollingHash(hashes).of(at, at + SEED)))
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["uid", "size", "at", "seed"])

    return items.select("uid", "words").mapInArrow(seeds, "uid long, size long, at long, seed long")


def seed_map(seeds: DataFrame) -> np.ndarray:
    """A bit per remainder of a seed by ``BITS``: at most ``BITS`` bits come to the driver."""
    slot = F.pmod("seed", F.lit(BITS)) + 1
    rows = seeds.groupBy(F.bitmap_bucket_number(slot).alias("bucket"))
    found = np.zeros(BITS // 8, np.uint8)
    for r in rows.agg(F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bits")).collect():
        begin = (r["bucket"] - 1) * _BUCKET // 8
        bits = np.frombuffer(r["bits"], np.uint8)[: len(found) - begin]
        found[begin : begin + len(bits)] |= bits
    return found


def _passing(c: Chunk, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words of a chunk where a seed begins that the map may have, and these seeds."""
    where, hashes = c.windows(SEED)
    seeds = _signed(hashes)
    slot = seeds & (len(known) * 8 - 1)  # a power of two, so the remainder
    may = (known[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 > 0
    return where[may], seeds[may]


def seed_counts(docs: DataFrame, text: str, known: np.ndarray) -> DataFrame:
    """How often the seeds of the map, and some others, occur in all documents: ``seed``, ``n``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_passing(c, known)[1] for c in folded(batch.column(0).to_pylist())]
            seeds, n = np.unique(np.concatenate([*found, np.zeros(0, np.int64)]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(seeds, pa.int64()), pa.array(n, pa.int64())], ["seed", "n"])

    found = docs.select(F.col(f"`{text}`").alias("text")).mapInArrow(count, "seed long, n long")
    return found.groupBy("seed").agg(F.sum("n").alias("n"))


def rarest(seeds: DataFrame, counts: DataFrame) -> DataFrame:
    """``seeds`` without those that are not the rarest of ``REACH`` in a row; of equals the first stays."""
    known = seeds.join(counts, "seed", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    order = Window.partitionBy("uid").orderBy("at")
    ahead = [F.struct(F.lead("n", i).over(order).alias("n"), F.lit(i).alias("i")) for i in range(REACH)]
    runs = known.select("uid", "at", F.array(*ahead).alias("run"))
    whole = (F.col("at") == 0) | F.col("run")[REACH - 1]["n"].isNotNull()
    first = F.array_min(F.filter("run", lambda s: s["n"].isNotNull()))["i"]
    kept = runs.where(whole).select("uid", (F.col("at") + first).alias("at")).distinct()
    return known.join(kept, ["uid", "at"], "left_semi").select("uid", "size", "at", "seed")


# --- passages and their alignment -----------------------------------------------------


def align(item: np.ndarray, passages: np.ndarray) -> np.ndarray:
    """Best local alignment scores of padded word rows ``item`` with ``passages``; 0 pads passages, 1 items."""
    steps = np.arange(passages.shape[1], dtype=np.int32) * GAP
    before = np.zeros(passages.shape, np.int32)
    best = np.zeros(len(passages), np.int32)
    for i in range(item.shape[1]):
        same = np.where(passages == item[:, i : i + 1], MATCH, -MISMATCH).astype(np.int32)
        diagonal = same.copy()
        diagonal[:, 1:] += before[:, :-1]
        row = np.maximum(np.maximum(diagonal, before - GAP), 0)
        before = np.maximum.accumulate(row + steps, axis=1) - steps
        best = np.maximum(best, before.max(axis=1))
    return best


def passages(docs: DataFrame, text: str, chosen: DataFrame) -> DataFrame:
    """Per text (``d1``, ``d2``) and item where passages may begin: seeds less than half an item apart make one."""
    known = seed_map(chosen)

    def hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d1, d2 = (batch[name].to_numpy() for name in ("d1", "d2"))
            for c in folded(batch["text"].to_pylist()):
                word, seeds = _passing(c, known)
                row = c.text_of_word[word]
                columns = [d1[row + c.first], d2[row + c.first], word - c.first_words[row], seeds]
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], ["d1", "d2", "word", "seed"])

    rows = docs.select(*_text_hashes(text), F.col(f"`{text}`").alias("text"))
    found = rows.mapInArrow(hits, "d1 long, d2 long, word long, seed long").join(broadcast_if_small(chosen), "seed")
    begin = F.col("word") - F.col("at")
    found = found.select("d1", "d2", "uid", "size", begin.alias("begin"))
    slot = F.floor(F.col("begin") / (F.floor(F.col("size") / 2) + 1))
    return found.groupBy("d1", "d2", "uid", "size", slot.alias("slot")).agg(F.min("begin").alias("begin"))


def _cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The words of the passages of texts, with room on both sides."""
    for batch in batches:
        for c in folded(batch["text"].tolist()):
            words, rows = _signed(c.words), []
            for i in range(c.n):
                row = batch.iloc[c.first + i]
                first, last = c.first_words[i], c.first_words[i + 1]
                for p in row["wanted"]:
                    left = max(first + p["begin"] - p["size"] // 2, first)
                    right = min(first + p["begin"] + 2 * p["size"], last)
                    rows.append((row["d1"], row["d2"], p["uid"], left - first, right - first, words[left:right]))
            for at in range(0, len(rows), 1000):
                yield pd.DataFrame(rows[at : at + 1000], columns=["d1", "d2", "uid", "begin", "end", "passage"])


def _scored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Alignment scores of items (``words``) with passages, those of like size together."""
    for batch in batches:
        batch = batch.assign(size=batch["words"].map(len)).sort_values("size", kind="stable", ignore_index=True)
        sizes, scores, lo = batch["size"].to_numpy(), np.zeros(len(batch)), 0
        while lo < len(batch):
            hi = int(np.searchsorted(sizes, sizes[lo] * 1.25 + 4, side="right"))
            hi = min(hi, lo + max(1, CELLS // (3 * int(sizes[hi - 1]) + 3)))
            items, found = batch["words"][lo:hi].tolist(), batch["passage"][lo:hi].tolist()
            a = np.ones((hi - lo, int(sizes[hi - 1])), np.int64)
            b = np.zeros((hi - lo, max(map(len, found))), np.int64)
            for i, (item, passage) in enumerate(zip(items, found, strict=True)):
                a[i, : len(item)], b[i, : len(passage)] = item, passage
            scores[lo:hi] = align(a, b) / (MATCH * sizes[lo:hi])
            lo = hi
        yield pd.DataFrame({c: batch[c] for c in ("d1", "d2", "id", "begin", "end")} | {"score": scores})


def matches(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    min_score: float = MIN_SCORE,
) -> DataFrame:
    """Per text (``d1``, ``d2``) the items ``found`` in it, staged; texts without any have no row."""
    small_batches(docs.sparkSession)
    known = read_items(items, item_id, item_text)
    seeds = stage(item_seeds(known), "seeds")
    chosen = stage(rarest(seeds, seed_counts(docs, text, seed_map(seeds))), "rare-seeds")
    wanted = passages(docs, text, chosen).groupBy("d1", "d2")
    wanted = stage(wanted.agg(F.collect_list(F.struct("uid", "begin", "size")).alias("wanted")), "passages")
    texts = docs.select(*_text_hashes(text), F.col(f"`{text}`").alias("text")).where("text is not null")
    texts = texts.join(broadcast_if_small(wanted.select("d1", "d2")), ["d1", "d2"], "left_semi")
    texts = texts.groupBy("d1", "d2").agg(F.first("text").alias("text")).join(wanted, ["d1", "d2"])
    cut = texts.mapInPandas(_cut, "d1 long, d2 long, uid long, begin long, end long, passage array<long>")
    rows = cut.join(broadcast_if_small(known), "uid")
    scored = rows.mapInPandas(_scored, "d1 long, d2 long, id long, begin long, end long, score double")
    best = F.min(F.struct((-F.col("score")).alias("score"), "begin", "end")).alias("best")
    scored = scored.where(F.col("score") >= min_score).groupBy("d1", "d2", "id").agg(best)
    found = F.struct(
        F.col("id").alias("item_id"),
        (-F.col("best.score")).alias("score"),
        F.col("best.begin").alias("passage_start"),
        F.col("best.end").alias("passage_end"),
    )
    return stage(scored.groupBy("d1", "d2").agg(F.sort_array(F.collect_list(found)).alias("found")), "leaks")


def mark(docs: DataFrame, items: DataFrame, name: str, text: str = "text", how: str = "left", **options) -> DataFrame:
    """``docs`` with the items found in each in the new column ``name``; null if there are none."""
    keys = fresh_name(docs, "_d1"), fresh_name(docs, "_d2")
    found = matches(docs, items, text, **options).select(
        F.col("d1").alias(f"{keys[0]}_"), F.col("d2").alias(f"{keys[1]}_"), F.col("found").cast(FOUND).alias(name)
    )
    same = (F.col(keys[0]) == F.col(f"{keys[0]}_")) & (F.col(keys[1]) == F.col(f"{keys[1]}_"))
    rows = docs.select("*", *_text_hashes(text, keys)).join(broadcast_if_small(found), same, how)
    kept = [F.col(f"`{c}`") for c in docs.columns]
    return rows.select(*kept) if how == "left_anti" else rows.select(*kept, name)


def leaks(docs: DataFrame, items: DataFrame, id_column: str = "doc_id", **options) -> DataFrame:
    """One row per document and item found in it."""
    name = fresh_name(docs, "_found")
    marked = mark(docs, items, name, how="inner", **options)
    return marked.select(id_column, F.explode(name).alias("f")).select(id_column, "f.*")


def keep_clean(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` in which no item is found, unchanged."""
    return mark(docs, items, fresh_name(docs, "_found"), how="left_anti", **options)
