"""Quality rules whose cutoffs are certified on labelled documents.

Fixed base rules reject documents that are too short or mostly repetition. On top of
them, each signal (a rate such as symbols per word) has a cutoff per stratum, chosen
from labelled documents so that the share of good documents it rejects is bounded with
a stated confidence:

* For every stratum and signal the cutoffs are tested from the most lenient to the
  strictest, and testing ends at the first one that fails (fixed-sequence testing, so
  the length of the grid costs no confidence).
* A cutoff passes if the exact (Clopper-Pearson) upper bound of its false rejection
  rate is within ``false_rejection / number of signals``.
* The bounds hold together with probability ``1 - error`` by Bonferroni's correction over
  strata and signals. A document is rejected if any signal exceeds its certified cutoff.

A signal is used in a stratum only where it finds a larger share of the bad documents than of
the good ones. Strata without enough labels get no cutoff, so only the base rules act there.

The bounds take labelled texts as independent trials, so copies count once per stratum, by a digest of the text: a good
text in 500 copies certifies no more than one.

Null and empty texts have no words and fail the base rules. A null stratum is a stratum. Of several
labels of a document, or of copies of a text, the lowest counts; null labels are ignored. No labels: no cutoffs.
Repeated rows are judged alike. Columns of ``docs`` other than id, text and stratum are not read, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.frames import fresh_name, per_text, small_batches
from tablewright.llm.text import RollingHash, chunks, covered, mix, repeated
from tablewright.session import stage

MEASURES = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long,"
    " n_lines long, n_upper long, n_letters long, n_shouts long"
)
SYMBOLS = b"#*$%&|<>"
REPEAT_WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20

#: What each signal divides by what.
SIGNALS = {
    "symbols": ("n_symbols", "n_words"),
    "dup_lines": ("n_dup_lines", "n_lines"),
    "repeats": ("n_repeat_words", "n_words"),
    "upper": ("n_upper", "n_letters"),
    "shouts": ("n_shouts", "n_words"),
}
#: Standard deviations below the failures counted, within which terms of the exact bound are summed.
TAIL = 12
#: Cutoffs from the most lenient to the strictest; a rate above its cutoff is rejected.
GRID = (0.9, 0.75, 0.6, 0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1, 0.07, 0.05)


def _flags(values: bytes) -> np.ndarray:
    found = np.zeros(256, bool)
    found[list(values)] = True
    return found


_SYMBOL, _UPPER, _LOWER = _flags(SYMBOLS), _flags(bytes(range(65, 91))), _flags(bytes(range(97, 123)))
_LATER_BYTE = _flags(bytes(range(0x80, 0xC0)))


def measures(texts: pd.Series) -> pd.DataFrame:
    """The counts of :data:`MEASURES` for whole texts."""
    parts = []
    for c in chunks(texts.tolist()):
        data, starts = c.data, c.starts

        def per_text_of(flag, starts=starts, data=data):
            return np.add.reduceat(flag[data].astype(np.int64), starts[:-1])

        chars = np.concatenate(([0], np.cumsum(~_LATER_BYTE[data])))
        chars = chars[c.word_ends] - chars[c.word_starts]
        ends = np.flatnonzero(data == 10)
        begins = np.concatenate(([0], ends[:-1] + 1))
        in_line = np.diff(np.searchsorted(c.word_starts, np.concatenate((begins, [len(data)])))) > 0
        begins, ends = begins[in_line], ends[in_line]
        text_of_line = np.searchsorted(starts, begins, side="right") - 1
        keys = c.byte_hash.of(begins, ends) ^ mix(text_of_line.astype(np.uint64))
        first = np.zeros(len(keys), bool)
        first[np.unique(keys, return_index=True)[1]] = True

        at, windows = c.windows(REPEAT_WINDOW)
        again = at[repeated(windows ^ mix(c.text_of_word[at].astype(np.uint64)))]
        again = covered(again, REPEAT_WINDOW, len(c.words))
        count = lambda which, flags=None: np.bincount(which, flags, c.n).astype(np.int64)
        parts.append(
            pd.DataFrame(
                {
                    "n_words": c.n_words,
                    "word_chars": count(c.text_of_word, chars),
                    "n_symbols": per_text_of(_SYMBOL),
                    "n_dup_lines": count(text_of_line, ~first),
                    "n_repeat_words": count(c.text_of_word, again),
                    "n_lines": count(text_of_line),
                    "n_upper": per_text_of(_UPPER),
                    "n_letters": per_text_of(_UPPER) + per_text_of(_LOWER),
                    "n_shouts": per_text_of(_flags(b"!")),
                }
            )
        )
    return pd.concat(parts, ignore_index=True)


def measured(docs: DataFrame, text: str = "text", name: str = "_measures") -> DataFrame:
    """``docs`` with a struct of counts in the new column ``name``."""
    small_batches(docs.sparkSession)
    return docs.withColumn(name, per_text(measures, MEASURES)(F.col(f"`{text}`")))


def base_failed(m: Column) -> Column:
    return (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > MAX_REPEAT_PERCENT * m["n_words"])


def signal(m: Column, name: str) -> Column:
    above, below = SIGNALS[name]
    return m[above] / F.greatest(m[below], F.lit(1))


def upper_bound(failures: int, trials: int, error: float) -> float:
    """The exact upper confidence bound of a rate, one-sided (Clopper and Pearson), for an ``error`` below one half.

    The bound lies above the observed rate, where the probability of fewer failures falls off like a normal tail, so
    the terms beyond ``TAIL`` standard deviations are below the precision of a double, however many trials there are.
    """
    if failures >= trials:
        return 1.0
    k = np.arange(max(0, failures - int(TAIL * math.sqrt(failures + 1))), failures + 1)
    ways = math.lgamma(trials + 1) - np.array([math.lgamma(i + 1) + math.lgamma(trials - i + 1) for i in k])
    low, high = failures / trials, 1.0
    for _ in range(60):
        p = (low + high) / 2
        logs = ways + k * math.log(p) + (trials - k) * math.log1p(-p)
        top = logs.max()
        if top + math.log(np.exp(logs - top).sum()) > math.log(error):
            low = p
        else:
            high = p
    return high


@dataclass(frozen=True)
class Rules:
    """Certified cutoffs by stratum and signal; a signal that is not listed rejects nothing."""

    cutoffs: dict[str | None, dict[str, float]]

    def rejected(self, m: Column, stratum: Column) -> Column:
        """Whether a signal exceeds the cutoff of the document's stratum."""
        result = F.lit(False)
        for value, cutoffs in self.cutoffs.items():
            if cutoffs:
                over = [signal(m, s) > c for s, c in sorted(cutoffs.items())]
                result = result | (stratum.eqNullSafe(F.lit(value)) & F.greatest(F.lit(False), *over))
        return result


def certify(
    known: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    false_rejection: float = 0.05,
    error: float = 0.05,
    grid: Sequence[float] = GRID,
) -> Rules:
    """Cutoffs from ``known`` (id, ``stratum``, ``digest`` of the text, ``m``: the counts) and ``labels`` (id, quality).

    All labelled texts are counted, per stratum, in one aggregation; the driver gets two rows per stratum.
    """
    good = labels.groupBy(id_column).agg(F.min("quality").alias("_good")).where("_good is not null")
    rows = known.where(~base_failed(F.col("m"))).join(good, id_column)
    rows = rows.groupBy("stratum", "digest").agg(F.min("_good").alias("_good"), F.first("m").alias("m"))
    counts = [F.count("*").alias("n")] + [
        F.sum((signal(F.col("m"), s) > c).cast("long")).alias(f"{s}_{i}")
        for s in SIGNALS
        for i, c in enumerate(grid)
    ]
    found: dict = {}
    for row in rows.groupBy("stratum", (F.col("_good") > 0).alias("ok")).agg(*counts).collect():
        found.setdefault(row["stratum"], {})[row["ok"]] = row
    share = error / max(1, len(found) * len(SIGNALS))
    rules: dict = {}
    for value, by in found.items():
        rules[value] = {}
        if True not in by or False not in by:
            continue
        good_n, bad_n = by[True]["n"], by[False]["n"]
        for s in SIGNALS:
            for i, c in enumerate(grid):
                wrong, right = by[True][f"{s}_{i}"], by[False][f"{s}_{i}"]
                if upper_bound(wrong, good_n, share) > false_rejection / len(SIGNALS):
                    break
                if right * good_n > wrong * bad_n:
                    rules[value][s] = c
    return Rules(rules)


def known_measures(docs: DataFrame, id_column: str, stratum: str) -> DataFrame:
    """The counts of every document as a table in the shared folder."""
    name = fresh_name(docs, "_measures")
    return stage(
        measured(docs, name=name).select(
            id_column,
            F.col(f"`{stratum}`").cast("string").alias("stratum"),
            F.unhex(F.md5(F.coalesce(F.col("text"), F.lit("")))).alias("digest"),
            F.col(name).alias("m"),
        ),
        "quality",
    )


def judge(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", stratum: str = "lang") -> DataFrame:
    """Per row of ``docs``: id, counts, ``base_failed`` and ``kept``."""
    known = known_measures(docs, id_column, stratum)
    rules = certify(known, labels, id_column)
    m = F.col("m")
    failed = base_failed(m)
    return known.select(
        id_column,
        *[m[c].alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        failed.alias("base_failed"),
        (~failed & ~rules.rejected(m, F.col("stratum"))).alias("kept"),
    )


def keep_good(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", stratum: str = "lang") -> DataFrame:
    """The rows of ``docs`` that no rule rejects, unchanged."""
    rules = certify(known_measures(docs, id_column, stratum), labels, id_column)
    name = fresh_name(docs, "_measures")
    again = measured(docs, name=name)
    m = F.col(name)
    return again.where(~base_failed(m) & ~rules.rejected(m, F.col(f"`{stratum}`").cast("string"))).drop(name)
