"""Words, lines and rolling hashes of many texts at once, in numpy.

Tasks see texts in Arrow batches. A batch is cut into chunks of a few megabytes;
all texts of a chunk are handled together, whole, as one byte array.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property

import numpy as np

#: Bytes handled together. A longer text is a chunk of its own.
CHUNK_BYTES = 500_000

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers = np.ones(1, np.uint64), np.ones(1, np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Scatter 64-bit values (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers 0..n of the base and of its inverse modulo 2^64."""
    global _powers
    if len(_powers[0]) <= n:
        size = max(n + 1, 2 * len(_powers[0]))
        up = np.full(size, _BASE, np.uint64)
        down = np.full(size, _INVERSE, np.uint64)
        up[0] = down[0] = 1
        _powers = np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)
    return _powers


class RollingHash:
    """64-bit hashes of any ranges of a sequence, from prefix sums."""

    def __init__(self, values: np.ndarray):
        up, self._down = powers(len(values))
        self._sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * up[: len(values)], dtype=np.uint64, out=self._sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        value = (self._sums[ends] - self._sums[starts]) * self._down[starts]
        return mix(value + (ends - starts).astype(np.uint64) * np.uint64(0xA24BAED4963EE407))

    def sliding(self, size: int) -> np.ndarray:
        """Hashes of the ranges of ``size`` from every start."""
        n = max(0, len(self._sums) - size)
        value = (self._sums[size : size + n] - self._sums[:n]) * self._down[:n]
        return mix(value + np.uint64(size * 0xA24BAED4963EE407 % (1 << 64)))


def sliding_min(values: np.ndarray, size: int) -> np.ndarray:
    """The minimum of ``size`` values from every start."""
    n = len(values)
    if n < size:
        return values[:0]
    full = -(-n // size) * size
    blocks = np.full(full, np.iinfo(np.uint64).max, np.uint64)
    blocks[:n] = values
    blocks = blocks.reshape(-1, size)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - size + 1], ahead[size - 1 : n])


@dataclass
class Chunk:
    """Texts number ``first`` to ``first + n - 1`` of a batch, joined by line breaks."""

    first: int
    texts: list[bytes]

    @property
    def n(self) -> int:
        return len(self.texts)

    @cached_property
    def data(self) -> np.ndarray:
        return np.frombuffer(b"\n".join(self.texts) + b"\n", np.uint8)

    @cached_property
    def starts(self) -> np.ndarray:
        """Where each text begins, and one past the end."""
        sizes = np.fromiter((len(t) + 1 for t in self.texts), np.int64, self.n)
        return np.concatenate(([0], np.cumsum(sizes)))

    @cached_property
    def byte_hash(self) -> RollingHash:
        return RollingHash(_BYTE_VALUES[self.data])

    @cached_property
    def _word_edges(self) -> tuple[np.ndarray, np.ndarray]:
        solid = np.concatenate(([False], ~_IS_SPACE[self.data]))
        change = np.flatnonzero(solid[1:] != solid[:-1])
        return change[0::2], change[1::2]

    @property
    def word_starts(self) -> np.ndarray:
        return self._word_edges[0]

    @property
    def word_ends(self) -> np.ndarray:
        return self._word_edges[1]

    @cached_property
    def words(self) -> np.ndarray:
        """The hash of every word."""
        return self.byte_hash.of(self.word_starts, self.word_ends)

    @cached_property
    def first_words(self) -> np.ndarray:
        """The number of the first word of each text, and the number of words."""
        return np.searchsorted(self.word_starts, self.starts)

    @cached_property
    def n_words(self) -> np.ndarray:
        return np.diff(self.first_words)

    @cached_property
    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(self.n), self.n_words)

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Starts and hashes of all windows of ``size`` words within a text."""
        at = np.arange(max(0, len(self.words) - size + 1))
        if len(at):
            at = at[self.text_of_word[at] == self.text_of_word[at + size - 1]]
        return at, RollingHash(self.words).of(at, at + size)

    def count_per_text(self, at: np.ndarray) -> np.ndarray:
        """How many of the sorted byte positions ``at`` lie in each text."""
        return np.diff(np.searchsorted(at, self.starts))


#: Byte tables for :func:`chunks`: A-Z in lower case; the same, and ASCII punctuation as spaces.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
WORDS_ONLY = bytes(
    LOWER[b] if b >= 128 or chr(b).isalnum() or _IS_SPACE[b] else 0x20 for b in range(256)
)


def chunks(texts: Sequence[str | None], table: bytes | None = None) -> Iterator[Chunk]:
    """All texts, whole and in order, their bytes mapped by ``table``; null is an empty text."""
    first, held, size = 0, [], 0
    for i, text in enumerate(texts):
        raw = text.encode("utf-8", "surrogatepass") if text else b""
        if table:
            raw = raw.translate(table)
        if held and size + len(raw) > CHUNK_BYTES:
            yield Chunk(first, held)
            first, held, size = i, [], 0
        held.append(raw)
        size += len(raw) + 1
    if held:
        yield Chunk(first, held)


def repeated(keys: np.ndarray) -> np.ndarray:
    """Which of ``keys`` occur at least twice."""
    if not len(keys):
        return np.zeros(0, bool)
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    found = np.zeros(len(keys), bool)
    found[order[1:][same]] = True
    found[order[:-1][same]] = True
    return found


def covered(starts: np.ndarray, size: int, n: int) -> np.ndarray:
    """Which of ``n`` places are in a window of ``size`` places from one of ``starts``."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, np.minimum(starts + size, n), -1)
    return np.cumsum(change[:-1]) > 0
