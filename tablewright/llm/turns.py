"""Repair of conversations: the cheapest edits after which roles alternate, and what was wrong.

Rows are the turns of conversations, ordered by turn (nulls first), then role and a hash of the text. A row's first fault
counts: ``blank`` (no character but ``[\\x20\\x09-\\x0D]``), ``duplicate`` (role and text seen earlier in the conversation),
``truncated`` (the last such character is not ``.``, ``!`` or ``?``). Edits are Keep (0), Rerole to user or assistant
(``REROLE``), Delete (``DELETE``, the only choice for blank and duplicate rows) and Insert of an empty turn of user or
assistant (``INSERT``); a truncated row that is not deleted adds ``TRUNCATED``. The initials of the roles that are left have
to read ``(s?(ua)+)?``. Of the cheapest lists of edits the one whose initials are least in ASCII is taken.

**Square-root checkpoints.** Costs are worked out backwards: a vector holds the cost of the rest for each of the four
states of that pattern. One pass over the rows, latest first, keeps a vector every ``k`` rows, where ``k`` grows with the
square root of the rows so far. A second pass walks forward: it holds one block of ``k`` rows, works out the block's
vectors from the checkpoint at its end, and emits the least tight edit at every step. Both passes stream through rows that
Spark has shuffled by conversation and sorted; of a conversation with ``n`` rows a task holds the square root of ``n``
vectors and texts, so one with a third of all rows fits, and its report is still one value (its audit has a letter per row).

The first pass and the search for duplicates work on hashes of 128 bits; texts are shuffled once, for the second pass. Equal
rows are counted before they are shuffled, and first turns are taken per text and task, so that a text in very many rows of a conversation
meets no single task.

Null roles and texts are one space. Null is a conversation like any other, and a turn before all others. A conversation
of which no row is left has zeros, an empty audit and the digest of nothing. Columns but the four named are not read, whatever their
names. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.operators.sizing import null_safe_on
from tablewright.session import stage

REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5

_SPACE = " \t\n\x0b\x0c\r"
_INITIALS = "sua"
_LEGAL = {"su", "ua", "au"}
#: What is wrong with a row; the numbers are the order in which faults count.
BLANK, DUPLICATE, CUT, FINE = 1, 2, 3, 4

# States of the pattern: nothing yet, after the system turn, after a user turn, after an assistant turn.
_NEXT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
#: From every state one turn of user or assistant leads on: the state after it, whose role is that of the turn.
_ON, _ROLE_OF = (2, 2, 3, 2), {2: "user", 3: "assistant"}
_COST = {"D": DELETE, "I": INSERT, "K": 0, "R": REROLE}
_FAR = 1 << 40

Vector = tuple[int, int, int, int]


def _with_inserts(costs: list[int]) -> Vector:
    for _ in range(2):  # a third insert comes back to the state before the first
        costs = [min(c, INSERT + costs[_ON[q]]) for q, c in enumerate(costs)]
    return tuple(costs)


#: Cost of the rest after the last row: the empty conversation and one that ends with the assistant are complete.
END = _with_inserts([0, _FAR, _FAR, 0])


def edits(initial: str, fault: int, state: int) -> Iterator[tuple[str, int, int]]:
    """The edits of a row in a state: letter, cost and the state after it, letters in ASCII order without Insert."""
    yield "D", DELETE, state
    if fault in (CUT, FINE):
        extra = TRUNCATED if fault == CUT else 0
        if initial in _NEXT[state]:
            yield "K", extra, _NEXT[state][initial]
        yield "R", REROLE + extra, _ON[state]


@cache
def _relative(initial: str, fault: int, after: Vector) -> tuple[int, Vector]:
    costs = [min(cost + after[q] for _, cost, q in edits(initial, fault, state)) for state in range(4)]
    found = _with_inserts(costs)
    return min(found), tuple(c - min(found) for c in found)


def before(initial: str, fault: int, after: Vector) -> Vector:
    """The vector before a row, from the one after it. Few differences of costs occur, so they are worked out once."""
    low = min(after)
    base, rest = _relative(initial if initial in _INITIALS else "", fault, tuple(c - low for c in after))
    return tuple(c + base + low for c in rest)


def walk(block: list[tuple], last: Vector, state: int) -> Iterator[tuple[str, int, tuple | None]]:
    """The least tight edits of a block of rows (initial, fault, ...) from ``state`` on: letter, state after it, row."""
    vectors = [last]
    for row in reversed(block):
        vectors.append(before(row[0], row[1], vectors[-1]))
    vectors.reverse()
    for i, row in enumerate(block):
        moved = False
        while not moved:
            left = vectors[i][state]
            choices = [(x, q, row) for x, cost, q in edits(row[0], row[1], state) if cost + vectors[i + 1][q] == left]
            if INSERT + vectors[i][_ON[state]] == left:
                choices.append(("I", _ON[state], None))
            letter, state, used = min(choices, key=lambda c: c[0])
            moved = used is not None
            yield letter, state, used


def finish(state: int) -> Iterator[tuple[str, int, None]]:
    """The inserts after the last row."""
    while state not in (0, 3):
        state = _ON[state]
        yield "I", state, None


# --- what Spark prepares ------------------------------------------------------------


def _hashes(*columns: Column) -> list[Column]:
    return [F.xxhash64(F.lit(seed), *columns).alias(f"h{seed}") for seed in (1, 2)]


def _plain(rows: DataFrame, conversation: str, turn: str, role: str, text: str) -> DataFrame:
    found = rows.select(
        F.col(f"`{conversation}`").alias("conv"),
        F.col(f"`{turn}`").cast("long").alias("turn"),
        F.coalesce(F.col(f"`{role}`"), F.lit(" ")).alias("role"),
        F.coalesce(F.col(f"`{text}`"), F.lit(" ")).alias("text"),
    )
    return found.select("*", *_hashes(F.col("role"), F.col("text")))


def _own_fault(text: Column) -> Column:
    end = F.rtrim(text, F.lit(_SPACE))
    whole = F.substring(end, -1, 1).isin(".", "!", "?")
    return F.when(end == "", BLANK).when(whole, FINE).otherwise(CUT)


def coded(plain: DataFrame) -> DataFrame:
    """Every different row by hash, how often it is there, its fault and whether its text has an earlier turn."""
    rows = plain.groupBy("conv", "turn", "role", "h1", "h2", _own_fault(F.col("text")).alias("fault"))
    rows = rows.agg(F.count("*").alias("copies"))
    first = F.min(F.struct(F.col("turn").isNotNull().alias("known"), "turn"))
    firsts = rows.groupBy("conv", "h1", "h2").agg(first.alias("first"))
    joined = rows.alias("rows").join(firsts.alias("firsts"), null_safe_on("rows", "firsts", ["conv", "h1", "h2"]))
    later = ~F.col("rows.turn").eqNullSafe(F.col("first.turn"))
    fault = F.when(later & (F.col("fault") != BLANK), DUPLICATE).otherwise(F.col("fault")).cast("int")
    return joined.select("rows.conv", "rows.turn", "rows.role", "rows.h1", "rows.h2", fault.alias("fault"), "copies")


_ROW_KEY = ("turn", "role", "h1", "h2")


def _values(batch: pa.RecordBatch) -> Iterator[tuple]:
    return zip(*[column.to_pylist() for column in batch.columns], strict=True)


def _repeat_of(fault: int) -> int:
    """The fault of a row that repeats the one before it."""
    return BLANK if fault == BLANK else DUPLICATE


class _Checkpoints:
    """Vectors every ``every`` rows from the end, at most twice as many as ``every``."""

    def __init__(self, conv: Any) -> None:
        self.conv, self.rows, self.every, self.at, self.kept = conv, 0, 1, END, []

    def add(self, initial: str, fault: int) -> None:
        self.at = before(initial, fault, self.at)
        self.rows += 1
        if self.rows % self.every == 0:
            self.kept.append(self.at)
            if len(self.kept) > 2 * self.every:
                self.kept, self.every = self.kept[1::2], 2 * self.every


def checkpoints(codes: DataFrame) -> DataFrame:
    """Per conversation its number of rows, the rows between checkpoints, and the vectors, latest first."""
    conv_type = codes.schema["conv"].dataType.simpleString()

    def backwards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[_Checkpoints] = []

        def out(kind: pa.DataType, found: list[_Checkpoints]) -> pa.RecordBatch:
            vectors = [[x for v in c.kept for x in v] for c in found]
            columns = (
                pa.array([c.conv for c in found], kind),
                pa.array([c.rows for c in found], pa.int64()),
                pa.array([c.every for c in found], pa.int64()),
                pa.array(vectors, pa.list_(pa.int64())),
            )
            return pa.RecordBatch.from_arrays(list(columns), ["conv", "n", "every", "vectors"])

        kind = None
        for batch in batches:
            kind = batch.schema.field("conv").type
            for conv, initial, fault, copies in _values(batch):
                if not done or conv != done[-1].conv:
                    done.append(_Checkpoints(conv))
                # Latest first: the repeats of a row come before it.
                for _ in range(copies - 1):
                    done[-1].add(initial, _repeat_of(fault))
                done[-1].add(initial, fault)
            if len(done) > 1000:
                yield out(kind, done[:-1])
                done = done[-1:]
        if done:
            yield out(kind, done)

    latest_first = [F.col("turn").desc_nulls_last(), *[F.desc(c) for c in _ROW_KEY[1:]]]
    ordered = codes.repartition("conv").sortWithinPartitions("conv", *latest_first)
    rows = ordered.select("conv", F.substring("role", 1, 1).alias("initial"), "fault", "copies")
    return rows.mapInArrow(backwards, f"conv {conv_type}, n long, every long, vectors array<long>")


class _Conversation:
    """What a task holds of a conversation while it walks forward: one block of rows, and counts."""

    def __init__(self, conv: Any) -> None:
        self.conv, self.state, self.block, self.size = conv, 0, [], 0
        self.every, self.ends = 1, [END]
        self.first = self.last = None
        self.turns = self.illegal = self.cost = 0
        self.faults = {BLANK: 0, DUPLICATE: 0, CUT: 0, FINE: 0}
        self.initial = ""
        self.audit, self.digest = bytearray(), hashlib.sha256()
        self.empty = True

    def plan(self, n: int, every: int, flat: list[int]) -> None:
        self.ends += [tuple(flat[i : i + 4]) for i in range(0, len(flat), 4)]
        self.every, self.size = every, n % every
        if not self.size:
            self.ends.pop()  # the checkpoint before the first row
            self.size = every

    def add(self, turn: int | None, role: str, text: str, fault: int) -> Iterator[tuple]:
        """Take the next row; yields edits when a block is full."""
        if turn is not None and turn != self.last:
            self.first = turn if self.first is None else self.first
            self.last, self.turns = turn, self.turns + 1
        self.illegal += bool(self.faults_seen) and self.initial + role[:1] not in _LEGAL
        self.initial = role[:1]
        self.faults[fault] += 1
        self.block.append((self.initial, fault, role, text))
        if len(self.block) == self.size:
            yield from self._emit(walk(self.block, self.ends.pop(), self.state))
            self.block, self.size = [], self.every

    @property
    def faults_seen(self) -> int:
        return sum(self.faults.values())

    def close(self) -> Iterator[tuple]:
        yield from self._emit(finish(self.state))

    def _emit(self, found: Iterator[tuple]) -> Iterator[tuple]:
        for letter, self.state, row in found:
            _, fault, role, text = row or ("", FINE, "", "")
            if letter in "RI":
                role = _ROLE_OF[self.state]
            self.cost += _COST[letter] + (TRUNCATED if fault == CUT and letter != "D" else 0)
            if letter != "D":
                line = f"{role}:{text}" if self.empty else f"\n{role}:{text}"
                self.digest.update(line.encode("utf-8", "surrogatepass"))
                self.empty = False
            self.audit.append(ord(letter))
            yield self.conv, len(self.audit) - 1, letter, role, text

    def report(self) -> tuple:
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.turns
        f = self.faults
        found = (self.conv, gaps, f[BLANK], f[DUPLICATE], f[CUT], self.illegal, self.cost)
        return *found, self.audit.decode(), self.digest.hexdigest()


def _stream(rows: DataFrame, conversation: str, turn: str, role: str, text: str) -> DataFrame:
    """All that the walk reads, by conversation: that it exists, its checkpoints, and its rows, codes before texts."""
    plain = _plain(rows.where(F.col(f"`{_PRESENT}`")), conversation, turn, role, text)
    codes = stage(coded(plain), "turn-codes")
    heads = rows.select(F.col(f"`{conversation}`").alias("conv"), F.lit(0).alias("part")).distinct()
    plans = checkpoints(codes).withColumn("part", F.lit(1))
    codes = codes.withColumns({"part": F.lit(2), "kind": F.lit(0)})
    texts = plain.withColumns({"part": F.lit(2), "kind": F.lit(1)})
    parts = heads
    for more in (plans, codes, texts):
        parts = parts.unionByName(more, allowMissingColumns=True)
    order = ["conv", "part", F.col("turn").asc_nulls_first(), *_ROW_KEY[1:], "kind"]
    columns = ["conv", "part", "kind", "turn", "role", "text", "fault", "copies", "n", "every", "vectors"]
    return parts.repartition("conv").sortWithinPartitions(*order).select(*columns)


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, tuple]]:
    """Edits (``edit``) of conversations as they stream by, each followed by its ``report``."""
    now, pending = None, None
    for batch in batches:
        for conv, part, kind, turn, role, text, fault, copies, n, every, vectors in _values(batch):
            if part == 0:
                if now is not None:
                    yield from (("edit", e) for e in now.close())
                    yield "report", now.report()
                now = _Conversation(conv)
            elif part == 1:
                now.plan(n, every, vectors)
            elif kind == 0:
                pending = fault, copies
            elif pending:  # the first text of equal rows
                (fault, copies), pending = pending, None
                yield from (("edit", e) for e in now.add(turn, role, text, fault))
                for _ in range(copies - 1):
                    yield from (("edit", e) for e in now.add(turn, role, text, _repeat_of(fault)))
    if now is not None:
        yield from (("edit", e) for e in now.close())
        yield "report", now.report()


_REPORT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_EDIT = "position long, edit string, role string, text string"
#: What a task hands over at once.
_HELD_ROWS, _HELD_CHARS = 1000, 4_000_000


def _walked(stream: DataFrame, wanted: str, columns: str) -> DataFrame:
    schema = f"conv {stream.schema['conv'].dataType.simpleString()}, {columns}"
    names = ["conv", *[c.split()[0] for c in columns.split(", ")]]
    strings = [i for i, c in enumerate(columns.split(", "), 1) if c.endswith("string")]

    def forwards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds: list[pa.DataType] = []

        def seen(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in given:
                kinds[:] = [batch.schema.field("conv").type]
                yield batch

        def out(held: list[tuple]) -> pa.RecordBatch:
            types = [*kinds, *[pa.string() if i in strings else pa.int64() for i in range(1, len(names))]]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), types, strict=True)], names)

        held, chars = [], 0
        for what, row in _conversations(seen(batches)):
            if what == wanted:
                held.append(row)
                chars += sum(len(row[i]) for i in strings)
                if len(held) >= _HELD_ROWS or chars >= _HELD_CHARS:
                    yield out(held)
                    held, chars = [], 0
        if held:
            yield out(held)

    return stream.mapInArrow(forwards, schema)


_PRESENT = "_present"


def _marked(rows: DataFrame, conversations: DataFrame | None, names: tuple[str, ...]) -> DataFrame:
    """The rows, and an empty one for every conversation that may have none."""
    found = rows.select(*[F.col(f"`{c}`") for c in names], F.lit(True).alias(_PRESENT))
    if conversations is None:
        return found
    ids = conversations.select(F.col(f"`{names[0]}`")).distinct().withColumn(_PRESENT, F.lit(False))
    return found.unionByName(ids, allowMissingColumns=True)


def report(
    rows: DataFrame,
    conversations: DataFrame | None = None,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """A row per conversation: what was wrong, the cost and audit of its edits, and the digest of what is left.

    ``gaps`` counts the turn numbers missing between the first and the last, ``illegal`` the neighbours whose roles do not
    follow each other. With ``conversations`` its conversations have a row too, whether they have turns or not.
    """
    stream = _stream(_marked(rows, conversations, (conversation, turn, role, text)), conversation, turn, role, text)
    return _walked(stream, "report", _REPORT).withColumnRenamed("conv", conversation)


def edited(
    rows: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """The edits of all conversations in order: ``position``, ``edit`` (D, I, K, R), ``role`` and ``text`` after it.

    The repaired conversations are the rows but those deleted.
    """
    stream = _stream(_marked(rows, None, (conversation, turn, role, text)), conversation, turn, role, text)
    return _walked(stream, "edit", _EDIT).withColumnRenamed("conv", conversation)
