"""Chat records of many layouts as one template, with a loss mask.

The layout of a record is known by its fingerprint: a hash over its nested field paths. A registry maps fingerprints to
declarative mappings, either the path of a list of messages or (role, path) pairs, and the mapping of a record's
fingerprint turns it into canonical turns. Records are structs, whose type is hashed once, or JSON texts, which are
hashed row by row. Everything is a DataFrame expression.

The template writes a turn as ``<|turn|>role<|says|>text<|end|>``. A text's own control strings are escaped: a backslash
becomes ``\\b`` and ``<|`` becomes ``\\l``. After that a backslash is always followed by one of the two letters, so both
are undone by plain replacement, and no text holds ``<|``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

from trendspark.llm.arrow import columns

TURN, SAYS, END = "<|turn|>", "<|says|>", "<|end|>"
_CONTROLS = "<\\|(?:turn|says|end)\\|>"
TURNS = "array<struct<role:string,text:string>>"


@dataclass(frozen=True)
class Messages:
    """A list of messages at a top-level field, each with a role and a text; ``roles`` renames roles."""

    field: str
    role: str
    text: str
    roles: tuple[tuple[str, str], ...] = ()

    @property
    def paths(self) -> list[str]:
        return [f"{self.field}[].{self.role}", f"{self.field}[].{self.text}"]

    def turns(self, get) -> Column:
        listed = get(self.field, f"array<struct<`{self.role}`:string,`{self.text}`:string>>")
        renamed = {k: v for pair in self.roles for k, v in [pair]}

        def turn(m: Column) -> Column:
            role = m[self.role]
            for old, new in renamed.items():
                role = F.when(m[self.role] == old, F.lit(new)).otherwise(role)
            return _turn(role, m[self.text])

        return F.transform(listed, turn)


@dataclass(frozen=True)
class Fields:
    """Turns at fixed top-level fields, as (role, field) pairs in order; empty ``optional`` ones are skipped."""

    pairs: tuple[tuple[str, str], ...]
    optional: tuple[str, ...] = ()

    @property
    def paths(self) -> list[str]:
        return [field for _, field in self.pairs]

    def turns(self, get) -> Column:
        out = []
        for role, field in self.pairs:
            text = get(field, "string")
            turn = _turn(F.lit(role), text)
            out.append(F.when(F.coalesce(text, F.lit("")) != "", turn) if field in self.optional else turn)
        return F.filter(F.array(*out), lambda t: t.isNotNull())


LAYOUTS: tuple[Messages | Fields, ...] = (
    Messages("messages", "role", "content"),
    Messages("messages", "role", "text"),
    Messages("conversations", "from", "value", (("human", "user"), ("gpt", "assistant"))),
    Messages("turns", "speaker", "utterance", (("bot", "assistant"),)),
    Fields((("user", "prompt"), ("assistant", "response"))),
    Fields((("user", "prompt"), ("assistant", "completion"))),
    Fields((("user", "question"), ("assistant", "answer"))),
    Fields((("user", "instruction"), ("assistant", "output"))),
    Fields((("system", "instruction"), ("user", "input"), ("assistant", "output")), optional=("input",)),
    Fields((("system", "system"), ("user", "prompt"), ("assistant", "response")), optional=("system",)),
)


def _turn(role: Column, text: Column) -> Column:
    empty = F.lit("")
    return F.struct(F.coalesce(role.cast("string"), empty).alias("role"), F.coalesce(text, empty).alias("text"))


def shape(paths: Sequence[str]) -> str:
    """Field paths (a dot before a field, ``[]`` after a list) as a nested text with sorted fields."""
    tree: dict = {}
    for path in paths:
        at = tree
        for name in path.split("."):
            at = at.setdefault(name, {})
    return _shape(tree)


def _shape(tree: dict) -> str:
    def one(name: str, below: dict) -> str:
        bare = name.removesuffix("[]")
        inner = _shape(below) if below else ""
        if name != bare:
            inner = f"ARRAY<{inner}>" if inner else "ARRAY"
        return f"{bare}: {inner}" if inner else bare

    return "OBJECT<" + ", ".join(one(n, tree[n]) for n in sorted(tree)) + ">"


def schema_paths(kind: DataType, at: str = "") -> list[str]:
    """Paths of the leaves of a type."""
    if isinstance(kind, StructType):
        return [p for f in kind.fields for p in schema_paths(f.dataType, f"{at}.{f.name}" if at else f.name)]
    if isinstance(kind, ArrayType):
        return schema_paths(kind.elementType, f"{at}[]")
    return [at]


def fingerprint(paths: Sequence[str]) -> str:
    """Hash of nested field paths, in any order."""
    return hashlib.sha256(shape(paths).encode()).hexdigest()


def json_fingerprint(record: Column) -> Column:
    """The fingerprint of a JSON text, null if it is no JSON; types of leaves do not count."""
    told = F.schema_of_variant(F.try_parse_json(record))
    bare = F.regexp_replace(told, ": (?!OBJECT<|ARRAY<)[A-Z]+(\\([0-9, ]+\\))?", "")
    return F.sha2(F.regexp_replace(bare, "ARRAY<(?!OBJECT<|ARRAY<)[A-Z]+(\\([0-9, ]+\\))?>", "ARRAY"), 256)


def canonical_turns(df: DataFrame, record: str, layouts: Sequence[Messages | Fields] = LAYOUTS, out: str = "turns") -> DataFrame:
    """``df`` with ``out``, the record's turns (role, text); null where no mapping has its fingerprint.

    ``record`` is a struct or a JSON text. Null roles and texts of a mapped record become empty; a null or malformed
    record has no turns.
    """
    known = {fingerprint(layout.paths): layout for layout in layouts}
    kind = df.schema[record].dataType
    if isinstance(kind, StructType):
        layout = known.get(fingerprint(schema_paths(kind)))
        if layout is None:
            return df.withColumn(out, F.lit(None).cast(TURNS))
        turns = layout.turns(lambda field, _: F.col(f"`{record}`")[field])
        return df.withColumn(out, F.when(F.col(f"`{record}`").isNotNull(), turns).cast(TURNS))
    parsed = F.try_parse_json(F.col(f"`{record}`"))
    print_ = json_fingerprint(F.col(f"`{record}`"))
    chosen = F.lit(None).cast(TURNS)
    for value, layout in known.items():
        turns = layout.turns(lambda field, kind: F.try_variant_get(parsed, f"$.{field}", kind))
        chosen = F.when(print_ == value, turns.cast(TURNS)).otherwise(chosen)
    return df.withColumn(out, chosen)


def records_from_rows(
    df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """(conv_id, record): the rows of a conversation as one record of messages, in order of turn, role and text.

    A conversation is one value of the output, so its rows meet in one row by definition. Nulls sort first, rows with a
    null conversation id form one conversation, repeated rows are repeated turns.
    """
    rows = columns(df, conv_id=conv, turn=turn, role=role, text=text)
    told = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    listed = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(told)).alias("rows"))
    messages = F.transform("rows", lambda r: F.struct(r["role"].alias("role"), r["text"].alias("text")))
    return listed.select("conv_id", F.struct(messages.alias("messages")).alias("record"))


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\b")), F.lit("<|"), F.lit("\\l"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\l"), F.lit("<|")), F.lit("\\b"), F.lit("\\"))


def format_turns(df: DataFrame, turns: str = "turns", loss_role: str = "assistant") -> DataFrame:
    """``df`` with ``formatted`` and ``loss``, the (start, length) spans in code points that training learns from.

    The spans cover the escaped texts of turns of ``loss_role``, without control strings. No turns give an empty text.
    """

    def piece(t: Column) -> Column:
        return F.concat(F.lit(TURN), escape(t["role"]), F.lit(SAYS), escape(t["text"]), F.lit(END))

    def span(done: Column, t: Column) -> Column:
        head = F.length(escape(t["role"])) + len(TURN) + len(SAYS)
        size = F.length(escape(t["text"]))
        start = done["at"] + head
        here = F.array(F.struct(start.cast("bigint").alias("start"), size.cast("bigint").alias("length")))
        none = F.array().cast("array<struct<start:bigint,length:bigint>>")
        spans = F.concat(done["spans"], F.when(t["role"] == loss_role, here).otherwise(none))
        return F.struct((start + size + len(END)).cast("bigint").alias("at"), spans.alias("spans"))

    begin = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<struct<start:bigint,length:bigint>>").alias("spans"))
    return df.withColumns(
        {
            "formatted": F.array_join(F.transform(turns, piece), ""),
            "loss": F.aggregate(turns, begin, span, lambda done: done["spans"]),
        }
    )


def parse_turns(formatted: Column) -> Column:
    """The turns of a formatted text."""
    parts = F.split(formatted, _CONTROLS, -1)
    n = F.floor((F.size(parts) - 1) / 3).cast("int")
    numbers = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(
        numbers,
        lambda i: F.struct(
            unescape(F.element_at(parts, i * 3 + 2)).alias("role"), unescape(F.element_at(parts, i * 3 + 3)).alias("text")
        ),
    )


def loss_text(formatted: Column, loss: Column) -> Column:
    """All text under the mask, unescaped, in order."""
    return F.array_join(
        F.transform(loss, lambda s: unescape(F.substring(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))), ""
    )
