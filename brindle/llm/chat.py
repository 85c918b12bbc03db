"""Chat formatting: records of many layouts to one canonical text with a loss mask.

A record is a struct of fields, or a JSON text that is read as one. Its fingerprint is the
hash of the nested paths of its filled fields, arrays marked and values left out, as far
as any ``Layout`` names them; further fields don't matter. A layout says declaratively
which paths make which turns, and is selected by the hash of its own paths: the first of
the layouts whose hash the record's paths, cut down to that layout's, give. So records of
one table may differ from row to row. A record of no known layout has no turns and is
told apart by a null ``layout``. Everything is built-in functions.

An array is filled if it is not null and is empty or has an element with the named field;
an empty one gives no turns. What is no text at the path of a text is taken as its JSON
text. A JSON text that can't be parsed has no fields. Strings may have any length.

The template writes each turn as ``<|role|>role\n``, the text, ``<|end|>\n``. Inside
roles and texts, ``%``, ``<`` and ``[`` are written ``%25``, ``%3C`` and ``%5B``, so no
control string of this or another common template can appear there, and undoing the
three replacements gives the text back exactly. The mask is a list of spans (start
and length in code points) over the formatted text: the texts of assistant turns.

Columns that a function adds replace columns of the same names; no others are touched.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

BEGIN, AFTER_ROLE, END = "<|role|>", "\n", "<|end|>\n"
_ESCAPES = (("%", "%25"), ("<", "%3C"), ("[", "%5B"))
TURNS = "array<struct<role string, text string>>"


@dataclass(frozen=True)
class Layout:
    """Which fields make the turns.

    ``listed``: an array of turns with its fields of the role and of the text, where
    ``roles`` gives other names of roles. ``fixed``: roles in order, each with the fields
    whose texts, the empty ones left out and a blank line between, are its text.
    """

    name: str
    listed: tuple[str, str, str] | None = None
    roles: tuple[tuple[str, str], ...] = ()
    fixed: tuple[tuple[str, tuple[str, ...]], ...] = ()

    @property
    def paths(self) -> list[str]:
        if self.listed:
            array, role, body = self.listed
            return sorted([f"{array}[].{role}", f"{array}[].{body}"])
        return sorted(field for _, fields in self.fixed for field in fields)


LAYOUTS = (
    Layout("messages", listed=("messages", "role", "content")),
    Layout("conversations", listed=("conversations", "from", "value"), roles=(("human", "user"), ("gpt", "assistant"))),
    Layout("prompt", fixed=(("user", ("prompt",)), ("assistant", ("completion",)))),
    Layout("instruction", fixed=(("user", ("instruction", "input")), ("assistant", ("output",)))),
    Layout("plain instruction", fixed=(("user", ("instruction",)), ("assistant", ("output",)))),
)


def record_type(layouts: Sequence[Layout] = LAYOUTS) -> StructType:
    """A struct with every field that some layout names."""
    fields: dict[str, StructField] = {}
    for layout in layouts:
        if layout.listed:
            array, *inner = layout.listed
            turn = StructType([StructField(name, StringType()) for name in inner])
            fields[array] = StructField(array, ArrayType(turn))
        else:
            fields |= {name: StructField(name, StringType()) for name in layout.paths}
    return StructType(list(fields.values()))


def _field(record: Column, kind: StructType, name: str) -> Column | None:
    """A field, or None where the record's type has none of that name."""
    return record[name] if name in kind.fieldNames() else None


def _filled(record: Column, kind: StructType, path: str) -> Column:
    """Whether the record has a value at a path."""
    top, _, inner = path.partition("[].")
    value = _field(record, kind, top)
    if value is None:
        return F.lit(False)
    if not inner:
        return value.isNotNull()
    element = kind[top].dataType
    if not (isinstance(element, ArrayType) and isinstance(element.elementType, StructType)):
        return F.lit(False)
    if inner not in element.elementType.fieldNames():
        return F.coalesce(F.size(value) == 0, F.lit(False))
    return value.isNotNull() & ((F.size(value) == 0) | F.exists(value, lambda t: t[inner].isNotNull()))


def _hash(paths: Column) -> Column:
    return F.xxhash64(F.array_join(paths, "\n"))


def _turns(record: Column, layout: Layout) -> Column:
    def turn(role: Column, body: Column) -> Column:
        return F.struct(role.alias("role"), body.alias("text"))

    if layout.listed:
        array, role, body = layout.listed

        def canonical(name: Column) -> Column:
            out = F.coalesce(name.cast("string"), F.lit(""))
            for other, own in layout.roles:
                out = F.when(name == other, own).otherwise(out)
            return out

        return F.transform(record[array], lambda t: turn(canonical(t[role]), F.coalesce(t[body].cast("string"), F.lit(""))))

    def joined(fields: Sequence[str]) -> Column:
        if len(fields) == 1:
            return F.coalesce(record[fields[0]].cast("string"), F.lit(""))
        return F.concat_ws("\n\n", *[F.nullif(record[f].cast("string"), F.lit("")) for f in fields])

    return F.array(*[turn(F.lit(role), joined(fields)) for role, fields in layout.fixed])


def canonical_turns(records: DataFrame, record: str = "record", layouts: Sequence[Layout] = LAYOUTS) -> DataFrame:
    """Add ``fingerprint`` (null for a null record), ``layout`` and ``turns`` (role and text)."""
    kind, read, filled = records.schema[record].dataType, _unused(records, "read"), _unused(records, "filled")
    value = F.col(record)
    if not isinstance(kind, StructType):
        kind = record_type(layouts)
        value = F.from_json(value, kind, {"maxStringLen": str(2**31 - 1)})
    known = sorted({path for layout in layouts for path in layout.paths})
    paths = F.array_compact(F.array(*[F.when(_filled(F.col(read), kind, path), path) for path in known]))
    name, turns = F.lit(None).cast("string"), F.lit(None).cast(TURNS)
    for layout in reversed(layouts):
        if {path.partition("[].")[0] for path in layout.paths} <= set(kind.fieldNames()):  # else no record of this table has it
            own = F.array(*[F.lit(path) for path in layout.paths])
            same = _hash(F.filter(filled, lambda path: F.array_contains(own, path))) == _hash(own)
            name = F.when(same, layout.name).otherwise(name)
            turns = F.when(F.col("layout") == layout.name, _turns(F.col(read), layout).cast(TURNS)).otherwise(turns)
    seen = F.when(F.col(record).isNotNull(), _hash(F.col(filled)))
    rows = records.withColumn(read, value).withColumn(filled, paths)
    return rows.withColumns({"fingerprint": seen, "layout": name}).withColumn("turns", turns).drop(read, filled)


def _unused(rows: DataFrame, name: str) -> str:
    """A column name that ``rows`` do not have."""
    while name in rows.columns:
        name += "_"
    return name


def escape(body: Column) -> Column:
    for plain, written in _ESCAPES:
        body = F.replace(body, F.lit(plain), F.lit(written))
    return body


def unescape(body: Column) -> Column:
    for plain, written in reversed(_ESCAPES):
        body = F.replace(body, F.lit(written), F.lit(plain))
    return body


def escape_role(role: Column) -> Column:
    """A role ends at the line's end, so it must not hold one."""
    return F.replace(escape(role), F.lit("\n"), F.lit("%0A"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("%0A"), F.lit("\n")))


def format_turns(rows: DataFrame, turns: str = "turns") -> DataFrame:
    """Add ``formatted`` and ``loss_spans`` for an array of (role, text)."""
    parts = _unused(rows, "parts")
    made = F.transform(
        F.col(turns),
        lambda t: F.struct(
            F.concat(F.lit(BEGIN), escape_role(t["role"]), F.lit(AFTER_ROLE)).alias("head"),
            escape(t["text"]).alias("body"),
            (t["role"] == "assistant").alias("learnt"),
        ),
    )
    whole = F.array_join(F.transform(parts, lambda p: F.concat(p["head"], p["body"], F.lit(END))), "")
    spans = F.aggregate(
        parts,
        F.struct(
            F.lit(0).cast("bigint").alias("at"),
            F.array().cast("array<struct<start bigint, length bigint>>").alias("spans"),
        ),
        lambda state, p: F.struct(
            (state["at"] + F.length(p["head"]) + F.length(p["body"]) + len(END)).cast("bigint").alias("at"),
            F.when(
                p["learnt"],
                F.concat(
                    state["spans"],
                    F.array(
                        F.struct(
                            (state["at"] + F.length(p["head"])).cast("bigint").alias("start"),
                            F.length(p["body"]).cast("bigint").alias("length"),
                        )
                    ),
                ),
            )
            .otherwise(state["spans"])
            .alias("spans"),
        ),
        lambda state: state["spans"],
    )
    return rows.withColumn(parts, made).withColumns({"formatted": whole, "loss_spans": spans}).drop(parts)


def parse_formatted(formatted: Column) -> Column:
    """The turns of a formatted text, unescaped."""
    blocks = F.filter(F.split(formatted, F.lit("<\\|end\\|>\\n")), lambda b: b != "")
    return F.transform(
        blocks,
        lambda b: F.struct(
            unescape_role(F.substring_index(F.substr(b, F.lit(len(BEGIN) + 1)), AFTER_ROLE, 1)).alias("role"),
            unescape(
                F.substr(b, F.locate(AFTER_ROLE, b) + len(AFTER_ROLE))
            ).alias("text"),
        ),
    )


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the mask, unescaped."""
    return F.array_join(
        F.transform(
            spans,
            lambda s: unescape(
                F.substring(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int"))
            ),
        ),
        "",
    )


def records_of_turns(
    rows: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", body: str = "text", mixed: bool = False
) -> DataFrame:
    """``key`` and ``record``, a struct of ``record_type``, from a table of turns.

    In the order of ``turn``, nulls first, then role and text, so ties have one order. A
    conversation is one record and is put together in one place; nothing larger is.
    Records have the layout ``messages``. If ``mixed``, they are as heterogeneous as a
    collection from many places: one question with its answer is a ``prompt`` record, and
    half of the others (by the key's hash) are ``conversations`` records, if no role would
    be lost by that layout's other names of roles.
    """
    one = F.struct(
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(body), F.lit("")).alias("content"),
    )
    packed = rows.groupBy(F.col(key).alias("packed_key")).agg(F.array_sort(F.collect_list(one)).alias("packed_turns"))
    turns, n = F.col("packed_turns"), F.size("packed_turns")
    names = {layout.name: dict(layout.roles) for layout in LAYOUTS}["conversations"]
    pair = (n == 2) & (turns[0]["role"] == "user") & (turns[1]["role"] == "assistant")
    safe = ~F.exists(turns, lambda t: t["role"].isin(*names))
    other = safe & (F.pmod(F.xxhash64("packed_key"), F.lit(2)) == 0)
    layout = F.when(pair, "prompt").when(other, "conversations") if mixed else F.lit(None).cast("string")
    layout = F.coalesce(layout, F.lit("messages"))

    def named(t: Column) -> Column:
        out = t["role"]
        for theirs, own in names.items():
            out = F.when(t["role"] == own, theirs).otherwise(out)
        return F.struct(out.alias("from"), t["content"].alias("value"))

    fields = {
        "messages": F.when(layout == "messages", F.transform(turns, lambda t: F.struct(t["role"].alias("role"), t["content"].alias("content")))),
        "conversations": F.when(layout == "conversations", F.transform(turns, named)),
        "prompt": F.when(layout == "prompt", turns[0]["content"]),
        "completion": F.when(layout == "prompt", turns[1]["content"]),
    }
    kind = record_type()
    whole = F.struct(*[fields.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in kind])
    return packed.select(F.col("packed_key").alias(key), whole.alias("record"))
