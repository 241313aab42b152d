"""Spelling variants: words one edit apart, each led to the far more frequent word that it may be a slip of.

Words are the maximal runs of letters ``[A-Za-z\\u00C0-\\u00FF]`` of texts, A-Z in lower case, of ``MIN_CHARS`` code points or more
and ``MIN_COUNT`` occurrences or more in the corpus. Two words are near if exactly one inserted, deleted or replaced code
point takes one to the other. A word's form is its near word with most occurrences (of equals the least in code-point
order) if it has at least ``LEAD`` times the word's; its root is where forms end.

**Dense tiles.** Let ``m`` be the length of the shorter of two words and cut ``m`` places into a head, a middle and a tail.
One edit touches one of the three, so near words agree in the other two: every word is dealt to the groups of its other
two parts, as the shorter word and, with ``m`` one less, as the longer one. Words of a group lie in padded matrices of code points,
one aligned left and one right, and blocks of rows are compared with blocks of rows: common prefix plus common suffix
of two words reaches the longer length less one exactly if one edit parts them. The place of the edit, which is
the length of the common prefix, names the one group of the three in which the pair counts.

Groups of more than ``TILE_ROWS`` words or ``TILE_CHARS`` code points are dealt to blocks, and every pair of blocks is a tile of its own, in
any task. A tile hands over a row per word, its near words counted and the first of them, never the pairs. Groups are
hashes; two that share one only meet more words. Counts are summed in a task before they are shuffled. Forms have ``LEAD`` times more occurrences
at every step, so chains have at most 27 links of 64-bit counts, and five rounds of pointer doubling end all.

Null and empty texts have no words. Rows with equal texts count each. An empty corpus gives no rows. Columns but id and text are
not read, whatever their names. Long texts are counted in pieces of ``PIECE`` characters, cut between words.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.text import LOWER
from tablewright.operators.sizing import broadcast_if_small
from tablewright.session import stage

MIN_CHARS = 6
MIN_COUNT = 5
LEAD = 5
TILE_ROWS = 4096
TILE_CHARS = 1 << 20
PIECE = 1 << 20
#: Words that a task holds while it counts, and code points of a matrix.
HELD = 200_000
CELLS = 1 << 22
ROUNDS = 5

_LETTERS = "A-Za-zÀ-ÿ"
_OTHER = re.compile(f"[^{_LETTERS}]")

#: From the id of a document, as text, to a function of its words; it may shorten words.
Edit = Callable[[str], Callable[[str], str]]


def pieces(text: str) -> Iterator[str]:
    """The text in lower case (A-Z), cut between words."""
    begin = 0
    while begin < len(text):
        cut = _OTHER.search(text, begin + PIECE) if begin + PIECE < len(text) else None
        end = cut.start() if cut else len(text)
        part = text[begin:end].encode("utf-8", "surrogatepass").translate(LOWER)
        yield part.decode("utf-8", "surrogatepass")
        begin = end


def count_words(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    min_chars: int = MIN_CHARS,
    min_count: int = MIN_COUNT,
    edit: Edit | None = None,
) -> DataFrame:
    """``word`` and its number ``n`` of occurrences, for words that are long and frequent enough."""
    run = re.compile(f"[{_LETTERS}]{{{min_chars},}}")

    def out(found: Counter) -> pa.RecordBatch:
        columns = [pa.array(found.keys(), pa.string()), pa.array(found.values(), pa.int64())]
        return pa.RecordBatch.from_arrays(columns, ["word", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in batches:
            for doc, whole in zip(batch.column(0), batch.column(1), strict=True):
                changed = edit(doc.as_py() or "") if edit else None
                for part in pieces(whole.as_py() or ""):
                    found = run.findall(part)
                    if changed is None:
                        held.update(found)
                        continue
                    for word, n in Counter(found).items():
                        new = changed(word)
                        if len(new) >= min_chars:
                            held[new] += n
                if len(held) > HELD:
                    yield out(held)
                    held = Counter()
        yield out(held)

    rows = docs.select(F.col(f"`{id_column}`").cast("string").alias("id"), F.col(f"`{text}`").alias("text"))
    counts = rows.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.where(F.col("n") >= min_count)


# --- groups and tiles -----------------------------------------------------------------


def _parts(m: Column) -> tuple[Column, Column]:
    """Lengths of head and tail, and of the middle."""
    third = F.floor(m / 3).cast("int")
    return third, (m - 2 * third).cast("int")


def grouped(words: DataFrame, shortest: int) -> DataFrame:
    """Every word in its groups: ``m``, the ``part`` that may differ, a hash ``g`` of the other two, ``longer``."""
    m = F.col("m")
    sizes = F.char_length("word")
    rows = words.select("word", "n", sizes.alias("size"), F.explode(F.array(F.lit(0), F.lit(1))).alias("longer"))
    rows = rows.withColumn("m", F.col("size") - F.col("longer")).where(m >= shortest)
    side, middle = _parts(m)
    head = lambda n: F.substring("word", F.lit(1), n)
    tail = lambda n: F.right("word", n)
    keys = [tail(middle + side), F.concat(head(side), tail(side)), head(side + middle)]
    keyed = [F.struct(F.lit(i).alias("part"), F.xxhash64(m, F.lit(i), key).alias("g")) for i, key in enumerate(keys)]
    return rows.select("word", "n", "size", "longer", "m", F.inline(F.array(*keyed)))


def tiles(rows: DataFrame) -> DataFrame:
    """Groups as tiles (``g``, ``low``, ``high``): the pairs of blocks of large groups, one of small ones."""
    totals = rows.groupBy("g").agg(F.count("*").alias("rows"), F.sum("size").alias("chars"))
    blocks = F.ceil(F.greatest(F.col("rows") / TILE_ROWS, F.col("chars") / TILE_CHARS)).cast("int")
    large = stage(totals.select("g", blocks.alias("blocks")).where("blocks > 1"), "large-groups")
    met = rows.join(broadcast_if_small(large), "g", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    met = met.withColumn("block", F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int"))
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return met.withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")})


class _Matrix:
    """Words as rows of code points, aligned left and right."""

    def __init__(self, words: list[str]) -> None:
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        width = int(sizes.max()) + 1
        points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        points = points.astype(np.uint8) if len(points) and points.max() < 256 else points
        row = np.repeat(np.arange(len(words)), sizes)
        place = np.arange(len(points)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        self.sizes = sizes
        self.left = np.zeros((len(words), width), points.dtype)
        self.right = np.zeros((len(words), width), points.dtype)
        self.left[row, place] = points
        self.right[row, np.repeat(sizes, sizes) - 1 - place] = points

    @staticmethod
    def _common(side: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        differ = side[i] != side[j]
        differ[:, -1] = True
        return differ.argmax(axis=1)

    def near(self, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether one edit parts the words in rows ``i`` and ``j`` (not shorter), and the place of the edit."""
        prefix = np.minimum(self._common(self.left, i, j), self.sizes[i])
        suffix = np.minimum(self._common(self.right, i, j), self.sizes[i])
        return prefix + suffix >= self.sizes[j] - 1, prefix


def _near_pairs(c: dict[str, np.ndarray], ends: np.ndarray, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of near words in tiles, which lie together up to ``ends``, shorter words first; each pair in its one group."""
    matrix, block, part = _Matrix(words), c["block"], c["part"]
    step = max(1, CELLS // (4 * matrix.left.shape[1]))
    side, middle = c["m"] // 3, c["m"] - 2 * (c["m"] // 3)
    across = c["low"] != c["high"]
    found: list[tuple[np.ndarray, np.ndarray]] = []
    active, d = np.flatnonzero(c["longer"] == 0), 1
    while len(active := active[active + d < ends[active]]):
        for at in range(0, len(active), step):
            i = active[at : at + step]
            i = i[~across[i] | (block[i] != block[i + d])]
            near, place = matrix.near(i, i + d)
            own = np.where(place < side[i], 0, np.where(place < side[i] + middle[i], 1, 2))
            hit = i[near & (own == part[i])]
            found.append((hit, hit + d))
        d += 1
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([a for a, _ in found]), np.concatenate([b for _, b in found])


_NEAR = "word string, n_near long, best string, best_n long"


def _summary(words: np.ndarray, n: np.ndarray, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    """Per word the number of its near words and the most frequent of them, least in code-point order."""
    unique, rank = np.unique(words, return_inverse=True)
    own, near, count = np.concatenate([rank[a], rank[b]]), np.concatenate([rank[b], rank[a]]), np.concatenate([n[b], n[a]])
    order = np.lexsort((near, -count, own))
    own, near, count = own[order], near[order], count[order]
    first = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1]))) if len(own) else np.zeros(0, np.int64)
    columns = (
        pa.array(unique[own[first]], pa.string()),
        pa.array(np.diff(np.append(first, len(own))), pa.int64()),
        pa.array(unique[near[first]], pa.string()),
        pa.array(count[first], pa.int64()),
    )
    return pa.RecordBatch.from_arrays(list(columns), ["word", "n_near", "best", "best_n"])


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of tiles in order; whole tiles are compared together, as many as fit a matrix."""

    def work(table: pa.Table) -> pa.RecordBatch:
        c = {name: table[name].to_numpy() for name in ("g", "low", "high", "m", "part", "longer", "block", "n")}
        edge = _edges(c)
        ends = np.repeat(np.append(edge[1:], len(c["g"])), np.diff(np.append(edge, len(c["g"]))))
        words = table["word"].to_pylist()
        a, b = _near_pairs(c, ends, words)
        return _summary(np.array(words, dtype=object), c["n"], a, b)

    held: list[pa.RecordBatch] = []
    cells = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        cells += batch.num_rows * (int(batch["m"].to_numpy().max()) + 2)
        if cells > CELLS:
            table = pa.Table.from_batches(held)
            last = int(_edges({k: table[k].to_numpy() for k in ("g", "low", "high", "m", "part")})[-1])
            if last:  # the last tile may go on
                yield work(table.slice(0, last))
                held = table.slice(last).combine_chunks().to_batches()
                cells = sum(b.num_rows * (int(b["m"].to_numpy().max()) + 2) for b in held)
    if held:
        yield work(pa.Table.from_batches(held))


def _edges(c: dict[str, np.ndarray]) -> np.ndarray:
    """Where tiles begin."""
    changed = np.ones(len(c["g"]), bool)
    changed[1:] = np.logical_or.reduce([c[k][1:] != c[k][:-1] for k in ("m", "part", "g", "low", "high")])
    return np.flatnonzero(changed)


def near_words(words: DataFrame, shortest: int = MIN_CHARS) -> DataFrame:
    """Per word that has near words: how many (``n_near``), and the first by occurrences (``best``, ``best_n``)."""
    tile = ["m", "part", "g", "low", "high"]
    rows = tiles(grouped(words, shortest)).select(*tile, "longer", "block", "word", "n")
    rows = rows.repartition("g", "low", "high").sortWithinPartitions(*tile, "longer", "block")
    found = rows.mapInArrow(_compare, _NEAR).groupBy("word")
    first = F.min(F.struct((-F.col("best_n")).alias("n"), "best"))
    found = found.agg(F.sum("n_near").alias("n_near"), first.alias("first"))
    return found.select("word", "n_near", F.col("first.best").alias("best"), (-F.col("first.n")).alias("best_n"))


def roots(forms: DataFrame) -> DataFrame:
    """``word`` and where its forms end, for words that have a ``form``."""
    found = stage(forms.select("word", F.col("form").alias("root")), "roots")
    for _ in range(ROUNDS):
        ahead = found.select(F.col("word").alias("root"), F.col("root").alias("next"))
        found = found.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), "next")
        found = stage(found, "roots")
        done = found.where("next is not null").isEmpty()
        found = found.drop("next")
        if done:
            break
    return found


def variants(words: DataFrame, lead: int = LEAD, shortest: int = MIN_CHARS) -> DataFrame:
    """``words`` (``word``, ``n``; each once) with ``form``, ``root``, ``n_near`` and ``form_n``."""
    words = stage(words.select("word", "n"), "words")
    met = words.join(near_words(words, shortest), "word", "left")
    leads = F.col("best_n") >= F.col("n").cast("decimal(19,0)") * lead  # beyond 64 bits
    met = met.select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(leads, F.col("best")).alias("form"),
        F.when(leads, F.col("best_n")).alias("form_n"),
    )
    met = stage(met, "forms")
    ends = roots(met.where("form is not null"))
    done = met.join(ends, "word", "left")
    return done.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
