r"""Chat records of different layouts, as one kind of text with a loss mask.

A record is a struct or JSON. Its nested field paths, without its values, are its schema; a hash of them is its
fingerprint, and the fingerprint selects a declarative mapping (:data:`LAYOUTS`) to turns of role and text. A struct
is taken by its declared schema and stays in native columns, whatever its size. JSON is parsed; a text that is long
enough for the limits of Spark's parser (strings of 20,000,000 characters, records of 128 MiB) and cannot be parsed
fails the job. Turns are written with a template::

    <s>[INST] role [/INST] text</s>

Control strings inside roles and texts are escaped: ``\`` becomes ``\\``, and the first character of ``<s>``,
``</s>``, ``[INST]`` and ``[/INST]`` becomes ``\l`` or ``\b``. No control string is left in an escaped text, so the
output can be read back exactly. The loss mask is a list of spans (start and end in characters of the output), one
for each turn of the assistant, over its escaped text.

Null texts and roles are empty. A record of unknown layout, or that is not JSON, or null, has null turns and output
and is found by its null ``layout``. A record without turns is formatted as the empty string. Rows that tie in
their order come in the order of role and text. Repeated rows are turns of their own.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.llm.frames import fresh_name

TURNS = "array<struct<role:string,text:string>>"
LEARNED = "assistant"
#: Turns whose places are summed up together.
BLOCK = 256
#: Shorter JSON texts (in bytes) meet no limit of size in Spark's parser: what it does not take is not JSON.
PARSED_BYTES = 20_000_000
BOS, EOS, OPEN, CLOSE = "<s>", "</s>", "[INST]", "[/INST]"

#: Names that layouts use for the canonical roles.
ROLES = {"human": "user", "prompter": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


@dataclass(frozen=True)
class Layout:
    """A mapping of one layout: its field paths, and where its turns are.

    ``fields`` names the paths of the layout (``messages[].role``). Turns are either the elements of a list
    (``each``: its path, and the names of role and text) or single fields (``single``: pairs of role and field).
    With ``rename``, roles go by :data:`ROLES`.
    """

    name: str
    fields: tuple[str, ...]
    each: tuple[str, str, str] | None = None
    single: tuple[tuple[str, str], ...] = ()
    rename: bool = False


LAYOUTS = (
    Layout("messages", ("messages[].content", "messages[].role"), each=("messages", "role", "content")),
    Layout("conversations", ("conversations[].from", "conversations[].value"), each=("conversations", "from", "value"), rename=True),
    Layout("no_messages", ("messages[]",), each=("messages", "role", "content")),
    Layout("prompt_response", ("prompt", "response"), single=(("user", "prompt"), ("assistant", "response"))),
    Layout("prompt_completion", ("completion", "prompt"), single=(("user", "prompt"), ("assistant", "completion"))),
    Layout(
        "system_prompt_response",
        ("prompt", "response", "system"),
        single=(("system", "system"), ("user", "prompt"), ("assistant", "response")),
    ),
    Layout(
        "instruction",
        ("input", "instruction", "output"),
        single=(("system", "instruction"), ("user", "input"), ("assistant", "output")),
    ),
    Layout("instruction_output", ("instruction", "output"), single=(("user", "instruction"), ("assistant", "output"))),
)


def _shape(fields: Sequence[str]) -> str:
    """The schema text of field paths: names in order, no types of values."""
    tree: dict = {}
    for path in fields:
        at = tree
        for part in path.split("."):
            at = at.setdefault(part, {})

    def write(node: dict) -> str:
        parts = []
        for name, below in sorted((n.removesuffix("[]"), (n.endswith("[]"), b)) for n, b in node.items()):
            inner = write(below[1]) if below[1] else "_"
            parts.append(f"{name}: ARRAY<{inner}>" if below[0] else f"{name}: {inner}")
        return f"OBJECT<{', '.join(parts)}>"

    return write(tree)


def shape(record: Column) -> Column:
    """The nested field names of a parsed record; kinds of values are left out."""
    kinds = r"(?<=[:<] ?)\b(STRING|VOID|BOOLEAN|BIGINT|DOUBLE|FLOAT|DATE|BINARY|VARIANT|TIMESTAMP(_NTZ)?|DECIMAL\(\d+,\d+\))"
    return F.regexp_replace(F.schema_of_variant(record), kinds, "_")


def _declared(kind: T.DataType) -> str:
    """The schema text of a type, as :func:`shape` gives it for a parsed record."""
    if isinstance(kind, T.StructType):
        return f"OBJECT<{', '.join(f'{f.name}: {_declared(f.dataType)}' for f in sorted(kind, key=lambda f: f.name))}>"
    if isinstance(kind, T.ArrayType):
        return f"ARRAY<{_declared(kind.elementType)}>"
    return "MAP" if isinstance(kind, T.MapType) else "_"


def fingerprint(text: Column) -> Column:
    return F.substring(F.sha2(text, 256), 1, 16)


def _turns(layout: Layout, record: Column, native: bool) -> Column:
    """The canonical turns of a record of the given layout, from its fields or from a parsed record."""
    if layout.each and native:
        path, role, text = layout.each
        rows = F.coalesce(F.filter(record[path], lambda t: t.isNotNull()), F.array())
        return F.transform(rows, lambda t: _turn(t[role].cast("string"), t[text].cast("string"), layout.rename))
    if native:
        return F.array(*[_turn(F.lit(role), record[field].cast("string")) for role, field in layout.single])
    if layout.each:
        path, role, text = layout.each
        kind = f"array<struct<`{role}`:string,`{text}`:string>>"
        rows = F.coalesce(F.try_variant_get(record, f"$.{path}", kind), F.array().cast(kind))
        return F.transform(rows, lambda t: _turn(t[role], t[text], layout.rename))
    fields = [(F.lit(role), F.try_variant_get(record, f"$.{field}", "string")) for role, field in layout.single]
    return F.array(*[_turn(role, text) for role, text in fields])


def _turn(role: Column, text: Column, rename: bool = False) -> Column:
    named = F.coalesce(role, F.lit(""))
    for other, canonical in ROLES.items() if rename else ():
        named = F.when(named == other, canonical).otherwise(named)
    return F.struct(named.alias("role"), F.coalesce(text, F.lit("")).alias("text"))


def escape(text: Column) -> Column:
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for control in (BOS, EOS, OPEN, CLOSE):
        sign = "\\l" if control[0] == "<" else "\\b"
        text = F.replace(text, F.lit(control), F.lit(sign + control[1:]))
    return text


def unescape(text: Column) -> Column:
    # Pairs of backslashes are read from the left, so what is left of an odd run belongs to a control string.
    parts = F.split(text, r"\\\\", -1)
    parts = F.transform(parts, lambda p: F.replace(p, F.lit("\\l"), F.lit("<")))
    parts = F.transform(parts, lambda p: F.replace(p, F.lit("\\b"), F.lit("[")))
    return F.array_join(parts, "\\")


def canonical(records: DataFrame, record: str, layouts: Sequence[Layout] = LAYOUTS) -> DataFrame:
    """``records`` with ``layout`` and ``turns``, by the fingerprint of column ``record``: a struct, or JSON.

    Columns of the records that have these names already are replaced.
    """
    column, kind = F.col(f"`{record}`"), records.schema[record].dataType
    native = isinstance(kind, T.StructType)
    whole, mark = fresh_name(records, "_parsed"), fresh_name(records, "_print")
    if native:
        # One schema holds for all rows, so only the layouts that fit it can be read from them.
        fitting = [layout for layout in layouts if _shape(layout.fields) == _declared(kind)]
        declared = F.when(column.isNotNull(), fingerprint(F.lit(_declared(kind))))
        rows = records.withColumn(whole, column).withColumn(mark, declared)
    else:
        # What is long enough for the parser's limits and gives null is parsed again by the function that fails.
        parsed = F.coalesce(F.try_parse_json(column), F.when(F.octet_length(column) >= PARSED_BYTES, F.parse_json(column)))
        fitting = layouts
        rows = records.withColumn(whole, parsed).withColumn(mark, fingerprint(shape(F.col(whole))))
    name, turns = F.lit(None).cast("string"), F.lit(None).cast(TURNS)
    for layout in reversed(fitting):
        own = F.col(mark) == fingerprint(F.lit(_shape(layout.fields)))
        name = F.when(own, layout.name).otherwise(name)
        turns = F.when(own, _turns(layout, F.col(whole), native)).otherwise(turns)
    return rows.select(*_without(records, "layout", "turns"), name.alias("layout"), turns.alias("turns"))


def _without(df: DataFrame, *names: str) -> list[Column]:
    return [F.col(f"`{c}`") for c in df.columns if c.lower() not in names]


def _running(first: Column, sizes: Column) -> Column:
    """``first``, and the sums of it and the sizes up to each. Quadratic, as arrays are copied: for short arrays."""
    return F.aggregate(sizes, F.array(first), lambda done, n: F.concat(done, F.array(F.element_at(done, -1) + n)))


def _starts(sizes: Column) -> Column:
    """Where each piece begins: sums within blocks of ``BLOCK`` pieces, from the sums of the blocks before."""
    count = F.greatest(F.ceil(F.size(sizes) / BLOCK) - 1, F.lit(0)).cast("int")
    blocks = F.transform(F.sequence(F.lit(0), count), lambda k: F.slice(sizes, k * BLOCK + 1, BLOCK))
    zero = F.lit(0).cast("long")
    totals = F.transform(blocks, lambda b: F.aggregate(b, zero, lambda a, n: a + n))
    # One start more than blocks, and in every block one more than pieces.
    firsts = F.slice(_running(zero, totals), 1, F.size(totals))
    return F.flatten(F.zip_with(blocks, firsts, lambda b, at: F.slice(_running(at, b), 1, F.size(b))))


def formatted(rows: DataFrame, turns: str = "turns") -> DataFrame:
    """``rows`` with the text ``formatted`` and its ``loss_mask`` (spans in characters), in place of columns so called."""
    head, tail = f"{BOS}{OPEN} ", EOS
    middle = f" {CLOSE} "
    piece = F.transform(
        F.col(turns),
        lambda t: F.struct(
            F.concat(F.lit(head), escape(t["role"]), F.lit(middle)).alias("head"),
            escape(t["text"]).alias("body"),
            (t["role"] == LEARNED).alias("learned"),
        ),
    )
    given, pieces, places = _without(rows, "formatted", "loss_mask"), fresh_name(rows, "_pieces"), fresh_name(rows, "_starts")
    rows = rows.withColumn(pieces, piece)
    whole = F.array_join(F.transform(pieces, lambda p: F.concat(p["head"], p["body"], F.lit(tail))), "")
    sizes = F.transform(pieces, lambda p: (F.length(p["head"]) + F.length(p["body"]) + len(tail)).cast("long"))
    rows = rows.withColumn(places, _starts(sizes))
    spans = F.zip_with(
        pieces,
        places,
        lambda p, at: F.struct(
            (at + F.length(p["head"])).alias("start"),
            (at + F.length(p["head"]) + F.length(p["body"])).alias("end"),
            p["learned"].alias("learned"),
        ),
    )
    learned = F.transform(F.filter(spans, lambda s: s["learned"]), lambda s: F.struct(s["start"], s["end"]))
    return rows.select(*given, whole.alias("formatted"), learned.alias("loss_mask"))


def read_back(formatted_text: Column) -> Column:
    """The turns that a formatted text holds."""
    pieces = F.split(formatted_text, EOS, -1)
    pieces = F.slice(pieces, 1, F.size(pieces) - 1)
    middle = f" {CLOSE} "

    def turn(piece: Column) -> Column:
        inner = F.substring(piece, len(BOS) + len(OPEN) + 2, F.length(piece))
        at = F.locate(middle, inner)
        role = F.substring(inner, F.lit(1), at - 1)
        return F.struct(
            unescape(role).alias("role"),
            unescape(F.substring(inner, at + len(middle), F.length(inner))).alias("text"),
        )

    return F.transform(pieces, turn)


def under_mask(formatted_text: Column, mask: Column) -> Column:
    """The learned texts, unescaped, in order."""
    return F.transform(
        mask,
        lambda s: unescape(
            F.substring(formatted_text, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))
        ),
    )


def records_from_rows(
    rows: DataFrame, id_column: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """One record (a struct) of the layout ``messages`` per conversation, from a table with a row per turn."""
    message = F.struct(
        F.col(f"`{turn}`").alias("turn"),
        F.coalesce(F.col(f"`{role}`"), F.lit("")).alias("role"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("content"),
    )
    ordered = F.array_sort(F.collect_list(message))
    messages = F.transform(ordered, lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content")))
    grouped = rows.groupBy(F.col(f"`{id_column}`")).agg(messages.alias("messages"))
    return grouped.select(id_column, F.struct("messages").alias("record"))
