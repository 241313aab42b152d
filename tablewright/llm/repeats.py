"""Long repeats across and within texts, found through anchors that equal windows share.

A window is a run of ``size`` units (words or bytes) of one text; it is repeated if its content also starts anywhere else.
A :class:`Scheme` gives every window an anchor: a place in it chosen by its content alone, so that equal windows
have their anchor at the same place. What follows is the same for all schemes:

1. Texts that are equal as a whole are one text with a number of copies; in two or more, all windows are repeated.
2. Every anchor has a name, the hash of the ``context`` units from it, which lie in all of its windows.
   Names are counted over all texts; a window can only be repeated if its anchor's name occurs twice.
3. The windows of an anchor lie in blocks of ``block`` neighbouring starts, counted from the anchor. A block has a core
   (the units in all of its windows) and a span (the units in any). If the span occurs twice, all its
   windows are repeated; if the core does not, none is.
4. Windows of the blocks that this leaves open are compared one by one, with those of one block for every different
   span around the same core.

Counts are aggregated before the shuffle and joined back, so a passage that a third of all texts share is neither
collected nor paired, and adaptive execution can split it. Only texts with shared names are read again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.frames import per_text, small_batches
from tablewright.llm.text import Chunk, RollingHash, chunks, sliding_min
from tablewright.session import stage


@dataclass(frozen=True)
class Units:
    """The units of a chunk: their hash, where each text begins and ends, and an order of possible anchors.

    ``order`` is the largest value where there can be no anchor.
    """

    hashes: RollingHash
    first: np.ndarray
    last: np.ndarray
    order: np.ndarray


@dataclass(frozen=True)
class Scheme:
    """How windows get their anchors.

    The anchor of a window from ``w`` is the first place with the lowest order in the ``reach`` places from
    ``w + lead``; ``lead + reach - 1 + context`` units must fit in a window.
    """

    size: int
    lead: int
    reach: int
    context: int
    block: int
    units: Callable[[Chunk], Units]
    describe: Callable[[bytes, np.ndarray | None], tuple]
    result: str


def anchors(u: Units, s: Scheme) -> tuple[np.ndarray, np.ndarray]:
    """The starts of all windows of a chunk, and the anchor of each."""
    n = len(u.order)
    ends = np.repeat(u.last, np.diff(np.append(u.first, n)))
    starts = np.flatnonzero(np.arange(n) + s.size <= ends)
    if not len(starts):
        return starts, starts
    high = u.order & np.uint64(0xFFFFFFFF00000000)
    low = sliding_min(high | np.arange(n, dtype=np.uint64), s.reach)
    return starts, (low[starts + s.lead] & np.uint64(0xFFFFFFFF)).astype(np.int64)


def _text_of(u: Units, places: np.ndarray) -> np.ndarray:
    return np.searchsorted(u.first, places, side="right") - 1


def _signed(hashes: np.ndarray) -> np.ndarray:
    return hashes.view(np.int64)


def parsed(s: Scheme) -> Callable[[Column], Column]:
    """A function of the text: its number of units, its result if nothing is removed, and its anchors' names.

    A name that occurs several times in the text is listed twice.
    """

    def parse(texts: pd.Series) -> pd.DataFrame:
        n, whole, names = [], [], []
        for c in chunks(texts.tolist()):
            u = s.units(c)
            places = np.unique(anchors(u, s)[1])
            found = u.hashes.of(places, places + s.context)
            cut = np.searchsorted(places, np.append(u.first, len(u.order)))
            n.extend((u.last - u.first).tolist())
            for i, raw in enumerate(c.texts):
                own, count = np.unique(found[cut[i] : cut[i + 1]], return_counts=True)
                names.append(_signed(np.concatenate((own, own[count > 1]))))
                whole.append(s.describe(raw, None)[-1])
        return pd.DataFrame({"n": n, "whole": whole, "names": names})

    return per_text(parse, "n long, whole string, names array<long>")


def _batches(batches: Iterator[pa.RecordBatch], given: str) -> Iterator[tuple[np.ndarray, Chunk, list]]:
    """Ids, chunk and given values of the rows of Arrow batches with ``uid``, ``text`` and a list column."""
    for batch in batches:
        ids = batch.column("uid").to_numpy(zero_copy_only=False)
        lists = batch.column(given)
        for c in chunks(batch.column("text").to_pylist()):
            rows = range(c.first, c.first + c.n)
            yield ids[c.first : c.first + c.n], c, [np.asarray(lists[i].values) for i in rows]


def _table(**columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v) for v in columns.values()], list(columns))


def _blocks(texts: DataFrame, s: Scheme) -> DataFrame:
    """Blocks of the windows whose anchors' names are shared: ``core``, ``span``, ``uid`` and first start ``at``."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, c, names in _batches(batches, "names"):
            u = s.units(c)
            starts, places = anchors(u, s)
            distinct, of = np.unique(places, return_inverse=True)
            keep = np.zeros(len(distinct), bool)
            owner = _text_of(u, distinct)
            found = _signed(u.hashes.of(distinct, distinct + s.context))
            edge = np.searchsorted(owner, np.arange(c.n + 1))
            for i, listed in enumerate(names):
                part = slice(edge[i], edge[i + 1])
                keep[part] = np.isin(found[part], listed)
            starts, places = starts[keep[of]], places[keep[of]]
            origin = places - s.lead - s.reach + 1
            number = (starts - origin) // s.block
            keys = np.unique(places * (s.reach // s.block + 1) + number)
            places, number = keys // (s.reach // s.block + 1), keys % (s.reach // s.block + 1)
            first = places - s.lead - s.reach + 1 + number * s.block
            last = np.minimum(first + s.block, places - s.lead + 1) - 1
            text = _text_of(u, places)
            whole = (first >= u.first[text]) & (last + s.size <= u.last[text])
            core = u.hashes.of(last, first + s.size)
            at = first - u.first[text]
            # A span that reaches beyond its text is like no other.
            alone = RollingHash(core).of(np.arange(len(core)), np.arange(len(core)) + 1) ^ ids[text].astype(np.uint64)
            alone = alone + (at + 1_000_003).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
            inside = np.flatnonzero(whole)
            span = alone
            span[inside] = u.hashes.of(first[inside], last[inside] + s.size)
            yield _table(core=_signed(core), span=_signed(span), uid=ids[text], at=at, n=last - first + 1)

    return texts.select("uid", "text", "names").mapInArrow(cut, "core long, span long, uid long, at long, n long")


def _windows(texts: DataFrame, s: Scheme) -> DataFrame:
    """The windows of given blocks (``open``: core, first start, number): ``core``, ``hash``, ``uid`` and ``at``."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("uid").to_numpy(zero_copy_only=False)
            opened = batch.column("open").to_pylist()
            for c in chunks(batch.column("text").to_pylist()):
                u = s.units(c)
                rows = [(i, o["core"], o["at"], o["n"], o["weight"]) for i in range(c.n) for o in opened[c.first + i]]
                text, core, at, n, weight = (np.array(v, np.int64) for v in zip(*rows, strict=True))
                inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                start = np.repeat(u.first[text] + at, n) + inner
                text, core, weight = np.repeat(text, n), np.repeat(core, n), np.repeat(weight, n)
                ok = (start >= u.first[text]) & (start + s.size <= u.last[text])
                start, text, core, weight = start[ok], text[ok], core[ok], weight[ok]
                # Blocks of two anchors may overlap and have equal cores; a window counts once.
                order = np.lexsort((start, core))
                again = (start[order][1:] == start[order][:-1]) & (core[order][1:] == core[order][:-1])
                once = order[np.concatenate(([True], ~again))] if len(order) else order
                start, text, core, weight = start[once], text[once], core[once], weight[once]
                hashes = _signed(u.hashes.of(start, start + s.size))
                at = start - u.first[text]
                yield _table(core=core, hash=hashes, uid=ids[c.first + text], at=at, weight=weight)

    return texts.select("uid", "text", "open").mapInArrow(cut, "core long, hash long, uid long, at long, weight long")


def _outcome(s: Scheme) -> Callable[[Column, Column], Column]:
    """A function of text and repeated windows (first start, number): what is left of the text."""

    def tell(texts: pd.Series, found: pd.Series) -> pd.DataFrame:
        rows = []
        for c in chunks(texts.tolist()):
            u = s.units(c)
            for i, raw in enumerate(c.texts):
                n = int(u.last[i] - u.first[i])
                runs = np.array([(r["at"], r["n"]) for r in found.iloc[c.first + i]], np.int64)
                begin = np.maximum(runs[:, 0], 0)
                end = np.minimum(runs[:, 0] + runs[:, 1] - 1 + s.size, n)
                change = np.zeros(n + 1, np.int64)
                np.add.at(change, begin, 1)
                np.add.at(change, end, -1)
                gone = np.cumsum(change[:-1]) > 0
                spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                rows.append((int(gone.sum()), spans, *s.describe(raw, ~gone)))
        return pd.DataFrame(rows, columns=["n_removed", "n_spans", "kept_text", "kept_sha256"])

    return per_text(tell, "n_removed long, n_spans long, kept_text string, kept_sha256 string")


def _repeated_runs(blocks: DataFrame, texts: DataFrame, s: Scheme) -> DataFrame:
    """Per ``uid`` the repeated windows, as a list ``found`` of first starts and numbers."""
    weighed = blocks.withColumn("row", F.struct("uid", "at", "n"))
    spans = weighed.groupBy("core", "span").agg(F.sum("weight").alias("times"), F.min("row").alias("row"))
    spans = stage(spans, "spans")
    cores = spans.groupBy("core").agg(F.sum("times").alias("all"), F.min("times").alias("least"))
    left = cores.where("all > 1 and least = 1").select("core")
    full = blocks.join(spans.where("times > 1").select("core", "span"), ["core", "span"]).where("weight = 1")
    runs = full.select("uid", "at", "n")

    single = spans.join(left, "core").select(
        F.col("row.uid").alias("uid"),
        F.struct("core", "row.at", "row.n", F.least("times", F.lit(2)).alias("weight")).alias("block"),
    )
    opened = single.groupBy("uid").agg(F.collect_list("block").alias("open"))
    windows = stage(_windows(texts.select("uid", "text").join(opened, "uid"), s), "windows")
    twice = windows.groupBy("core", "hash").agg(F.sum("weight").alias("times")).where("times > 1").select("core", "hash")
    more = windows.where("weight = 1").join(twice, ["core", "hash"]).select("uid", "at", F.lit(1).cast("long").alias("n"))
    return runs.union(more).groupBy("uid").agg(F.collect_list(F.struct("at", "n")).alias("found"))


def without_repeats(docs: DataFrame, s: Scheme, id_column: str, text: str) -> DataFrame:
    """Per row of ``docs``: id, ``n`` units, ``n_removed``, ``n_spans``, ``kept_text`` and ``kept_sha256``.

    ``kept_text`` is null for texts that are kept or removed as a whole.
    """
    small_batches(docs.sparkSession)
    plain = docs.select(
        F.col(f"`{id_column}`").alias("id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text")
    ).withColumn("digest", F.unhex(F.sha2("text", 256)))
    rows = stage(plain.select("id", "digest", parsed(s)(F.col("text")).alias("p")).select("id", "digest", "p.*"), "parsed")
    texts = rows.groupBy("digest").agg(
        F.min("id").alias("id"),
        F.count("*").alias("copies"),
        F.first("n").alias("n"),
        F.first("names").alias("names"),
    )
    texts = stage(texts.withColumn("uid", F.monotonically_increasing_id()), "texts")

    named = texts.select("uid", F.explode("names").alias("name"))
    shared = named.groupBy("name").agg(F.count("*").alias("times")).where("times > 1").select("name")
    names = named.join(shared, "name").groupBy("uid").agg(F.collect_set("name").alias("names"))
    wanted = names.join(texts.select("uid", "digest", F.col("id").alias("rep"), "copies"), "uid")
    # The id spreads the copies of a text, of which only one is read; rows repeated with their id weigh 2 as well.
    again = plain.join(wanted.withColumnRenamed("digest", "of"), (F.col("digest") == F.col("of")) & F.col("id").eqNullSafe(F.col("rep")))
    again = stage(again.select("uid", "text", "names", F.least("copies", F.lit(2)).alias("weight")), "again")

    weights = texts.select("uid", F.least("copies", F.lit(2)).alias("weight"))
    blocks = stage(_blocks(again, s).dropDuplicates(["uid", "at", "core"]).join(weights, "uid"), "blocks")
    found = _repeated_runs(blocks, again, s)
    changed = again.where("weight = 1").join(found, "uid")
    changed = changed.select("uid", _outcome(s)(F.col("text"), F.col("found")).alias("o")).select("uid", "o.*")

    done = texts.select("uid", "digest", "copies").join(changed, "uid", "left").withColumnRenamed("digest", "of")
    joined = rows.select("id", "digest", "n", "whole").join(done, F.col("digest") == F.col("of"))
    gone = (F.col("copies") > 1) & (F.col("n") >= s.size)
    none = F.lit(0).cast("long")
    return joined.select(
        F.col("id").alias(id_column),
        "n",
        F.when(gone, F.col("n")).otherwise(F.coalesce("n_removed", none)).alias("n_removed"),
        F.when(gone, F.lit(1).cast("long")).otherwise(F.coalesce("n_spans", none)).alias("n_spans"),
        "kept_text",
        F.when(gone, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_sha256", "whole")).alias("kept_sha256"),
    )
