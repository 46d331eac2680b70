"""Chat formatting by schema fingerprints.

A record is a variant in any of the declared layouts. The hash of its nested field
paths selects the mapping that reads its turns; the template then marks every turn
and escapes control strings inside texts so that they can be read back exactly.
Everything is a DataFrame expression.

Defined cases: a null role or text is empty; a record whose fingerprint is not
declared has no layout and null turns; turns of one number are ordered by role and
text, repeated rows one after the other; a null turn number comes first; an empty table
gives no rows; input columns of any name may stand beside the four that are read. A
conversation of any length is formatted in chunks, cut by turn numbers and by bytes, so
that no step but the final hash of its whole text needs it in one row. A single turn may
have as much text as Spark's variants hold, 128 MiB.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TURNS = "array<struct<role string, text string>>"
# Turns of one chunk, by number.
CHUNK = 64
# A chunk of more bytes is cut further; one turn is never cut.
CHUNK_BYTES = 1 << 23

# Fixed values of the template.
OPEN, MIDDLE, CLOSE = "<|im_start|>", "<|im_sep|>", "<|im_end|>\n"
# Strings that steer a model, none of which a text may hold as such.
CONTROL = ("<|", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")


@dataclass(frozen=True)
class Layout:
    """A declared layout: its field paths and how its turns are read.

    ``fields`` is the shape with every scalar written ``_`` and the fields of an
    object in alphabetical order. ``turns`` lists (role, path) pairs, or is one
    (path, role field, text field) of an array of messages.
    """

    name: str
    fields: str
    turns: tuple
    roles: tuple[tuple[str, str], ...] = ()


LAYOUTS = (
    Layout("messages", "OBJECT<messages: ARRAY<OBJECT<content: _, role: _>>>",
           ("$.messages", "role", "content")),
    Layout("conversations", "OBJECT<conversations: ARRAY<OBJECT<from: _, value: _>>>",
           ("$.conversations", "from", "value"),
           (("human", "user"), ("gpt", "assistant"))),
    Layout("prompt", "OBJECT<completion: _, prompt: _>",
           (("user", "$.prompt"), ("assistant", "$.completion"))),
    Layout("prompt-response", "OBJECT<prompt: _, response: _>",
           (("user", "$.prompt"), ("assistant", "$.response"))),
    Layout("instruction", "OBJECT<instruction: _, output: _>",
           (("user", "$.instruction"), ("assistant", "$.output"))),
    Layout("instruction-input", "OBJECT<input: _, instruction: _, output: _>",
           (("system", "$.instruction"), ("user", "$.input"), ("assistant", "$.output"))),
)


def field_paths(record: Column) -> Column:
    """The shape of a variant without its scalar types."""
    return F.regexp_replace(
        F.schema_of_variant(record),
        r"(: |ARRAY<)(?!OBJECT<|ARRAY<)[A-Z]+(?:\(\d+,\d+\))?", "$1_")


def fingerprint(record: Column) -> Column:
    return F.xxhash64(field_paths(record))


def _turns(record: Column, layout: Layout) -> Column:
    if isinstance(layout.turns[0], str):
        path, role, text = layout.turns
        listed = F.try_variant_get(record, path, f"array<struct<`{role}` string, `{text}` string>>")

        def turn(m):
            named = m[role]
            for old, new in layout.roles:
                named = F.when(m[role] == old, F.lit(new)).otherwise(named)
            return F.struct(F.coalesce(named, F.lit("")).alias("role"),
                            F.coalesce(m[text], F.lit("")).alias("text"))
        return F.transform(listed, turn)
    return F.array(*[
        F.struct(F.lit(role).alias("role"),
                 F.coalesce(F.try_variant_get(record, path, "string"), F.lit("")).alias("text"))
        for role, path in layout.turns])


def canonical(df: DataFrame, record: str = "record", layouts=LAYOUTS) -> DataFrame:
    """Add ``layout`` and ``turns`` (role and text) to rows with a variant record."""
    print_ = fingerprint(F.col(record))
    name, turns = F.lit(None).cast("string"), F.lit(None).cast(TURNS)
    for layout in layouts:
        same = print_ == F.xxhash64(F.lit(layout.fields))
        name = F.when(same, F.lit(layout.name)).otherwise(name)
        turns = F.when(same, _turns(F.col(record), layout)).otherwise(turns)
    return df.withColumns({"layout": name, "turns": turns})


def escape(text: Column) -> Column:
    """Break control strings with a backslash behind their opening bracket(s)."""
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for c in CONTROL:
        cut = 2 if c.startswith("<<") else 1
        text = F.replace(text, F.lit(c), F.lit(c[:cut] + "\\" + c[cut:]))
    return text


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(\\?)", "$1")


def template(turns: Column) -> Column:
    """Turns as one text."""
    return F.array_join(F.transform(turns, lambda t: F.concat(
        F.lit(OPEN), escape(t["role"]), F.lit(MIDDLE), escape(t["text"]), F.lit(CLOSE))), "")


def loss_mask(formatted: Column, role: str = "assistant") -> Column:
    """Spans (start from 0, length) of the texts of one role, in code points."""
    pieces = F.split(formatted, r"<\|im_end\|>\n")
    begin = F.struct(F.lit(0).cast("bigint").alias("at"),
                     F.array().cast("array<struct<start bigint, length bigint>>").alias("spans"))

    def step(state, piece):
        size = F.length(piece).cast("bigint")
        head = F.instr(piece, MIDDLE) + (len(MIDDLE) - 1)
        is_role = F.substring_index(piece, MIDDLE, 1) == OPEN + role
        span = F.struct((state["at"] + head).alias("start"), (size - head).alias("length"))
        return F.struct(
            (state["at"] + size + len(CLOSE)).alias("at"),
            F.when(is_role, F.concat(state["spans"], F.array(span)))
            .otherwise(state["spans"]).alias("spans"))
    return F.aggregate(pieces, begin, step)["spans"]


def read_back(formatted: Column) -> Column:
    """The turns of a formatted text, unescaped."""
    pieces = F.filter(F.split(formatted, r"<\|im_end\|>\n"), lambda p: p != "")
    return F.transform(pieces, lambda p: F.struct(
        unescape(F.substr(F.substring_index(p, MIDDLE, 1), F.lit(len(OPEN) + 1))).alias("role"),
        unescape(F.substr(p, F.instr(p, MIDDLE) + len(MIDDLE))).alias("text")))


def masked_text(formatted: Column, spans: Column) -> Column:
    """All text under the mask, unescaped, nothing between."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substr(
        formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))), "")


def records_from_rows(df: DataFrame, conv: str, turn: str, role: str, text: str,
                      chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Rows by turn as records in the layout ``messages``, one per ``chunk`` of turns:
    its number and, within it, that of its ``part`` of at most ``chunk_bytes`` before its
    last turn."""
    rows = df.select(
        F.col(conv).alias("conv_id"),
        F.coalesce(F.floor(F.col(turn) / CHUNK).cast("bigint"), F.lit(-(2**62))).alias("number"),
        F.coalesce(F.col(turn), F.lit(-(2**63))).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("content"))
    before = Window.partitionBy("conv_id", "number").orderBy("turn", "role", "content").rowsBetween(
        Window.unboundedPreceding, -1)
    size = F.sum((F.octet_length("role") + F.octet_length("content")).cast("bigint")).over(before)
    part = F.floor(F.coalesce(size, F.lit(0)) / chunk_bytes).cast("bigint")
    listed = F.array_sort(F.collect_list(F.struct("turn", "role", "content")))
    messages = F.transform(listed, lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content")))
    # The window's shuffle serves the grouping too.
    return (rows.withColumn("part", part).groupBy("conv_id", "number", "part")
            .agg(F.to_variant_object(F.struct(messages.alias("messages"))).alias("record"))
            .select("conv_id", F.struct(F.col("number"), F.col("part")).alias("chunk"), "record"))


def format_conversations(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                         text: str = "text", chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """One row per chunk of a conversation: ``conv_id, chunk, formatted, loss_spans``.

    A conversation's text is that of its chunks in order (``chunk`` is a pair of numbers);
    spans count from the start of their chunk.
    """
    read = canonical(records_from_rows(df, conv, turn, role, text, chunk_bytes))
    formatted = read.select("conv_id", "chunk", template(F.col("turns")).alias("formatted"))
    return formatted.withColumn("loss_spans", loss_mask(F.col("formatted")))
