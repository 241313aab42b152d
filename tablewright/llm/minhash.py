"""Near copies by HyperMinHash: banded compressed registers, estimates, and a check on full sets.

A document's set is its distinct runs of ``SHINGLE`` words (A-Z in lower case), hashed to 64 bits. The hash range is cut
into ``REGISTERS`` buckets; a register keeps, of the smallest hash in its bucket, the number of leading zeros and
the ``MANTISSA`` bits that follow: 16 bits in all. An empty bucket borrows from the first filled one in an
order of its own, so registers of short documents agree with the same probability as others.

1. Documents with equal sets are one class. Its smallest id stands for it from here on.
2. Registers are banded, ``ROWS`` each. Documents that share a band are candidates: with ``BANDS`` bands a pair of
   similarity 0.8 fails to meet once in 300,000 times.
3. In every group of a band all members are compared with one leader: as many pairs as members. A pair whose
   estimated similarity, corrected for registers that agree by chance, is far below the threshold is dropped; the rest
   are compared on their full sets.
4. Links give components. Groups whose members are now all in one component are finished. In the others, members of
   different components are still to be compared. The members are dealt into blocks of ``BLOCK`` shingles, and every
   two blocks of a group meet in a task of their own, unless both lie in its largest component; an index of shingles
   there finds the similar members of different components, and one link for each two components is given out.
   If that would send more than ``COPIES`` rows per document, some members more, those of the smallest components
   first, are compared with all others of their group and leave it, until it does not. No pair is left out.

Null, empty and wordless texts have an empty set and are linked with nothing. With fewer words than a shingle, the
whole sequence is the set. Rows without id are linked with nothing, their component is null, and they are kept.
Rows that repeat an id are one document.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewright.llm.components import components
from tablewright.llm.frames import per_text, small_batches
from tablewright.llm.text import LOWER, Chunk, RollingHash, chunks, mix
from tablewright.session import stage

ROWS, BANDS = 4, 24
REGISTERS = ROWS * BANDS
MANTISSA = 10
#: Pairs whose estimate is lower are not compared: more than six standard errors below 0.8.
ESTIMATE = 0.5
#: Shingles in a block, rows sent to blocks per document, and pairs of a round before, per document.
BLOCK, COPIES, PAIRS = 500_000, 20, 1

_EDGES = np.array([k * (1 << 64) // REGISTERS for k in range(REGISTERS)], np.uint64)
_ORDER = np.array(
    [
        np.argsort(mix(np.arange(REGISTERS, dtype=np.uint64) + np.uint64(1000 * (k + 1))), kind="stable")
        for k in range(REGISTERS)
    ]
)


def shingle_sets(c: Chunk, size: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of every text."""
    rolling, sets = RollingHash(c.words), []
    for first, last in zip(c.first_words[:-1].tolist(), c.first_words[1:].tolist(), strict=True):
        if last == first:
            sets.append(np.zeros(0, np.uint64))
            continue
        starts = np.arange(first, max(first + 1, last - size + 1))
        sets.append(np.unique(rolling.of(starts, np.minimum(starts + size, last))))
    return sets


def registers(shingles: np.ndarray) -> np.ndarray:
    """The compressed registers of a set that is not empty."""
    at = np.searchsorted(shingles, _EDGES)
    filled = np.append(at[1:], len(shingles)) > at
    value = (shingles[np.minimum(at, len(shingles) - 1)] - _EDGES) * np.uint64(REGISTERS)
    value = np.maximum(value, np.uint64(1))
    zeros = 64 - np.frexp(value.astype(np.float64))[1].astype(np.int64)
    zeros = np.clip(zeros, 0, 63).astype(np.uint64)
    rest = (value << zeros << np.uint64(1)) >> np.uint64(64 - MANTISSA)
    packed = ((zeros << np.uint64(MANTISSA)) | rest).astype(np.uint16)
    empty = np.flatnonzero(~filled)
    if len(empty):
        order = _ORDER[empty]
        packed[empty] = packed[order[np.arange(len(empty)), filled[order].argmax(axis=1)]]
    return packed


def signature(size: int):
    """A function of the text: size and digest of its set, and its registers."""

    def sign(texts: pd.Series) -> pd.DataFrame:
        n, digests, packed = [], [], []
        for c in chunks(texts.tolist(), LOWER):
            for s in shingle_sets(c, size):
                n.append(len(s))
                digests.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                packed.append(registers(s).tobytes() if len(s) else None)
        return pd.DataFrame({"n": n, "digest": digests, "registers": packed})

    return per_text(sign, "n long, digest binary, registers binary")


def full_sets(size: int):
    """A function of the text: its whole set, sorted."""

    def gather(texts: pd.Series) -> pd.Series:
        return pd.Series([s.tobytes() for c in chunks(texts.tolist(), LOWER) for s in shingle_sets(c, size)])

    return per_text(gather, "binary")


def estimate(a: pd.Series, b: pd.Series) -> pd.Series:
    """The similarity that two documents' registers suggest, without those that agree by chance."""
    if not len(a):
        return pd.Series([], dtype=float)
    left = np.frombuffer(b"".join(a), np.uint16).reshape(-1, REGISTERS)
    right = np.frombuffer(b"".join(b), np.uint16).reshape(-1, REGISTERS)
    # Two unrelated hashes have z leading zeros each with probability 4^-(z+1), and then equal mantissas.
    chance = (1 / 3) / (1 << MANTISSA)
    return pd.Series(((left == right).mean(axis=1) - chance) / (1 - chance))


def common(a: pd.Series, b: pd.Series) -> pd.Series:
    """The number of shingles that two sets share."""
    sizes = [
        len(np.intersect1d(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), assume_unique=True))
        for x, y in zip(a, b, strict=True)
    ]
    return pd.Series(sizes, dtype="int64")


def similar(shared: Column, n_a: Column, n_b: Column, percent: int) -> Column:
    return 100 * shared >= percent * (n_a + n_b - shared)


def _sets(wanted: DataFrame, texts: DataFrame, shingle: int) -> DataFrame:
    """The full sets of the classes ``rep`` in ``wanted``. Shuffled at every size, so that plans do not differ."""
    rows = texts.join(wanted.hint("merge"), texts["id"] == wanted["rep"]).dropDuplicates(["rep"])
    return stage(rows.select("rep", full_sets(shingle)(F.col("text")).alias("hashes")), "sets")


def _verified(
    pairs: DataFrame, classes: DataFrame, texts: DataFrame, shingle: int, percent: int
) -> DataFrame:
    """The pairs (``a``, ``b``) that are similar on their full sets."""
    side = lambda x: classes.select(F.col("rep").alias(x), F.col("n").alias(f"n_{x}"), F.col("registers").alias(f"r_{x}"))
    near = pairs.join(side("a"), "a").join(side("b"), "b")
    near = near.where(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))
    near = near.where(F.pandas_udf(estimate, "double")("r_a", "r_b") >= ESTIMATE).select("a", "b", "n_a", "n_b")
    near = stage(near, "near")
    if near.isEmpty():
        return near.select("a", "b")
    sets = _sets(near.select(F.col("a").alias("rep")).union(near.select("b")).distinct(), texts, shingle)
    sets_of = lambda x: sets.select(F.col("rep").alias(x), F.col("hashes").alias(f"h_{x}"))
    checked = near.join(sets_of("a"), "a").join(sets_of("b"), "b")
    checked = checked.withColumn("shared", F.pandas_udf(common, "long")("h_a", "h_b"))
    return checked.where(similar(F.col("shared"), F.col("n_a"), F.col("n_b"), percent)).select("a", "b")


def _open_groups(candidates: DataFrame, low: DataFrame) -> DataFrame:
    """The members of groups that are not yet in one component, with their component."""
    named = candidates.join(low.select(F.col("node").alias("rep"), "low"), "rep", "left")
    named = named.withColumn("low", F.coalesce("low", "rep"))
    mixed = named.groupBy("key").agg(F.min("low").alias("x"), F.max("low").alias("y")).where("x <> y")
    return named.join(mixed.select("key"), "key")


def band_keys(registers: Column) -> Column:
    bands = [F.substring(registers, 2 * ROWS * i + 1, 2 * ROWS) for i in range(BANDS)]
    return F.array(*[F.xxhash64(F.lit(i), band) for i, band in enumerate(bands)])


def linked(members: pd.DataFrame, percent: int) -> pd.DataFrame:
    """Links between members of different components, one for each two that are connected."""
    sets = [np.frombuffer(h, np.uint64) for h in members["hashes"]]
    n, low, rep = members["n"].to_numpy(), members["low"].to_numpy().copy(), members["rep"].to_numpy()
    owner, hashes = np.repeat(np.arange(len(n)), n), np.concatenate(sets)
    order = np.argsort(hashes, kind="stable")
    hashes, owner = hashes[order], owner[order]
    names, sizes = np.unique(low, return_counts=True)
    found = []
    for i in np.flatnonzero(low != names[np.argmax(sizes)]):
        first, last = np.searchsorted(hashes, sets[i]), np.searchsorted(hashes, sets[i], side="right")
        count = last - first
        at = np.repeat(first - np.cumsum(count) + count, count) + np.arange(count.sum())
        shared = np.bincount(owner[at], minlength=len(n))
        similar_to = (low != low[i]) & (100 * shared >= percent * (n + n[i] - shared))
        for j in np.flatnonzero(similar_to):
            if low[j] != low[i]:
                found.append((min(rep[i], rep[j]), max(rep[i], rep[j])))
                low[low == low[j]] = low[i]
    return pd.DataFrame(found, columns=["a", "b"], dtype="int64")


def _blocks(rest: DataFrame, classes: DataFrame) -> DataFrame:
    """The open groups' members with their blocks: ``mine``, and the range of blocks ``low_block``..``blocks`` to meet.

    Blocks of members outside of the group's largest component come first, ``rest_blocks`` of them.
    """
    rows = rest.join(classes.select("rep", "n"), "rep")
    sizes = rows.groupBy("key", "low").agg(F.sum("n").alias("shingles"))
    largest = F.struct("shingles", "low")
    sizes = sizes.groupBy("key").agg(F.sum("shingles").alias("all"), F.max(largest).alias("main"))
    whole = F.col("all") <= BLOCK
    apart = F.ceil((F.col("all") - F.col("main.shingles")) / BLOCK)
    sizes = sizes.select(
        "key",
        F.when(~whole, F.col("main.low")).alias("main"),
        F.when(whole, 1).otherwise(apart).cast("long").alias("rest_blocks"),
        F.when(whole, 0).otherwise(F.ceil(F.col("main.shingles") / BLOCK)).cast("long").alias("main_blocks"),
    )
    joined = rows.join(sizes, "key")
    in_main = F.coalesce(F.col("low") == F.col("main"), F.lit(False))
    dealt = F.xxhash64("rep")
    mine = F.when(in_main, F.col("rest_blocks") + F.pmod(dealt, "main_blocks")).otherwise(F.pmod(dealt, "rest_blocks"))
    last = F.when(in_main, F.col("rest_blocks")).otherwise(F.col("rest_blocks") + F.col("main_blocks"))
    return joined.select("key", "rep", "low", "n", mine.alias("mine"), last.alias("partners"))


def _last_links(blocks: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Links between members of different components, from every two blocks of a group."""
    sets = _sets(blocks.select("rep").distinct(), texts, shingle)
    rows = blocks.join(sets, "rep").withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("partners") - 1)))
    rows = rows.withColumn("x", F.least("mine", "other")).withColumn("y", F.greatest("mine", "other"))
    met = rows.select("key", "x", "y", "rep", "low", "n", "hashes").groupBy("key", "x", "y")
    return met.applyInPandas(lambda members: linked(members, percent), "a long, b long").distinct()


def _leaders(rest: DataFrame, counts: DataFrame, per_group: int, turn: int) -> DataFrame:
    """Some members of every group, those of its smallest components first."""
    order = Window.partitionBy("key").orderBy("size", F.xxhash64("rep", F.lit(turn)), "rep")
    sized = rest.join(counts, ["key", "low"]).withColumn("nth", F.row_number().over(order))
    return sized.where(F.col("nth") <= per_group).select("key", "rep")


def _links(classes: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Links between classes that connect all that are connected by similar pairs."""
    banded = classes.select("rep", F.explode(band_keys(F.col("registers"))).alias("key"))
    groups = banded.groupBy("key").agg(F.min("rep").alias("leader"), F.count("*").alias("n")).where("n > 1")
    candidates = stage(banded.join(groups, "key").select("key", "rep", "leader"), "bands")
    documents = classes.count()
    pairs = candidates.where("rep <> leader").select(F.col("leader").alias("a"), F.col("rep").alias("b")).distinct()
    links = stage(_verified(pairs, classes, texts, shingle, percent), "links")
    candidates = candidates.where("rep <> leader").select("key", "rep")
    turn = 0
    while True:
        turn += 1
        rest = stage(_open_groups(candidates, components(links)), "open")
        blocks = stage(_blocks(rest, classes), "blocks")
        rows, copies = blocks.agg(F.count("*"), F.sum("partners")).first()
        if not rows:
            return links
        last = copies <= COPIES * documents
        if last:
            more = _last_links(blocks, texts, shingle, percent)
        else:
            counts = rest.groupBy("key", "low").agg(F.count("*").alias("size"))
            leaders = stage(_leaders(rest, counts, max(1, PAIRS * documents // rows), turn), "leaders")
            x, y = rest.join(leaders, ["key", "rep"], "left_semi").alias("x"), rest.alias("y")
            met = x.join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x.low") != F.col("y.low")))
            pairs = met.select(F.least("x.rep", "y.rep").alias("a"), F.greatest("x.rep", "y.rep").alias("b")).distinct()
            more = _verified(pairs, classes, texts, shingle, percent)
        links = stage(links.union(more), "links")
        if last:
            return links
        candidates = stage(rest.select("key", "rep").join(leaders, ["key", "rep"], "left_anti"), "bands")


def near_copies(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", shingle: int = 5, percent: int = 80
) -> DataFrame:
    """Per row of ``docs``: id, ``n_shingles``, ``component_id`` and ``kept``.

    Links join documents whose sets share at least ``percent`` of their union.
    """
    small_batches(docs.sparkSession)
    texts = docs.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text}`").alias("text"))
    signed = texts.select("id", signature(shingle)(F.col("text")).alias("s"))
    signed = stage(signed.select("id", "s.*"), "signatures")
    linkable = signed.where("id is not null and digest is not null")
    classes = linkable.groupBy("digest", "n", "registers").agg(F.min("id").alias("rep"))
    classes = stage(classes, "classes")
    links = _links(classes.select("rep", "n", "registers"), texts.where("id is not null"), shingle, percent)
    low = components(links)
    found = classes.join(low, classes["rep"] == low["node"], "left")
    found = found.select(F.col("digest").alias("of"), F.coalesce("low", "rep").alias("component_id"))
    rows = signed.join(found, signed["digest"] == found["of"], "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id"))
    return rows.select(
        F.col("id").alias(id_column),
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )


def keep_first(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", shingle: int = 5, percent: int = 80
) -> DataFrame:
    """The rows of ``docs`` that are the first of their component, unchanged."""
    found = near_copies(docs, id_column, text, shingle, percent).where("not kept")
    return docs.join(found.select(id_column).distinct(), id_column, "left_anti").select(*docs.columns)
