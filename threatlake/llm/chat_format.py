"""Chat formatting by schema fingerprints, in DataFrame functions only.

A record's fingerprint is the hash of those of its nested field paths, at any depth, that
mappings know. It selects a declarative mapping that turns the record into canonical turns (role, text),
whether the record is a typed row (one fingerprint for the table) or a JSON string
(a fingerprint for each row, from the schema of its variant). A fingerprint that is no mapping's own
takes the mapping with most paths among those that the record has; a record that
none fits is marked as unmapped. Turns are then written in one template:

    <|role|>text<|end|>

Control strings can't occur in the text between the markers: backslash, "<"
and "[" are written as \\0, \\1 and \\2, in roles "|" too, as \\3, which is undone
exactly by `unescape`. The loss mask is the spans of assistant texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

OPEN, SHUT, END = "<|", "|>", "<|end|>"
#: In the order in which they are escaped; undone in reverse.
ESCAPES = (("\\", "\\0"), ("<", "\\1"), ("[", "\\2"))
ROLE_ESCAPES = (*ESCAPES, ("|", "\\3"))
TURN = "array<struct<role:string,text:string>>"
TRAINED = "assistant"


def escape(text: Column, role: bool = False) -> Column:
    for plain, code in ROLE_ESCAPES if role else ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescape(text: Column) -> Column:
    for plain, code in reversed(ROLE_ESCAPES):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def _role(name: Column) -> Column:
    """Roles by their usual names; others stay as they are."""
    known = F.create_map(*(F.lit(x) for pair in (("human", "user"), ("gpt", "assistant"), ("bot", "assistant"), ("model", "assistant")) for x in pair))
    return F.coalesce(F.try_element_at(known, F.lower(name)), name, F.lit(""))


def _turn(role: Column | str, text: Column) -> Column:
    return F.struct((F.lit(role) if isinstance(role, str) else role).alias("role"), F.coalesce(text, F.lit("")).alias("text"))


def _some(turn: Column, when: Column) -> Column:
    return F.when(when, F.array(turn)).otherwise(F.array().cast(TURN))


def _rows(record: Record) -> Column:
    """Rows by turn: sorted by turn, ties by role and then text."""
    rows = record.items("rows", "role", "text", "turn")
    return F.transform(F.array_sort(rows, _by_turn), lambda x: _turn(x["role"], x["text"]))


def _by_turn(a: Column, b: Column) -> Column:
    def order(x: Column, y: Column, rest: Column) -> Column:
        return F.when(x < y, -1).when(x > y, 1).otherwise(rest)

    null_first = F.when(a["turn"].isNull() & b["turn"].isNotNull(), -1).when(a["turn"].isNotNull() & b["turn"].isNull(), 1)
    return null_first.otherwise(order(a["turn"], b["turn"], order(a["role"], b["role"], order(a["text"], b["text"], F.lit(0)))))


def _list(field: str, role: str, text: str) -> Mapping:
    return lambda r: F.transform(r.items(field, role, text), lambda m: _turn(_role(m["role"]), m["text"]))


def _no_items(field: str) -> Mapping:
    """No turns of an empty list; other lists aren't mapped."""
    return lambda r: F.when(F.size(r.items(field, "role", "content")) == 0, F.array().cast(TURN))


def _pair(asked: str, answer: str) -> Mapping:
    return lambda r: F.array(_turn("user", r.text(asked)), _turn("assistant", r.text(answer)))


def _instruction_to(answer: str) -> Mapping:
    def turns(r: Record) -> Column:
        more = F.coalesce(r.text("input"), F.lit(""))
        asked = F.when(more == "", F.coalesce(r.text("instruction"), F.lit(""))).otherwise(F.concat_ws("\n", r.text("instruction"), more))
        return F.array(_turn("user", asked), _turn("assistant", r.text(answer)))

    return turns


def _with_system(inner: Mapping) -> Mapping:
    return lambda r: F.concat(_some(_turn("system", r.text("system")), F.coalesce(r.text("system"), F.lit("")) != ""), inner(r))


def _preferred(r: Record) -> Column:
    """The prompt's turns, a list or one text, before the preferred ones, unless these begin with them already."""
    own, lead = _list("chosen", "role", "content")(r).cast(TURN), r.lead("prompt").cast(TURN)
    return F.when(F.slice(own, 1, F.size(lead)) == lead, own).otherwise(F.concat(lead, own))


def _parts_joined(parts: Column) -> Column:
    return F.array_join(F.transform(parts, lambda p: F.coalesce(p["text"], F.lit(""))), "")


class TypedRecord:
    """Reads a mapping's fields from typed columns; a field that isn't there is null."""

    def __init__(self, schema: T.StructType, field: Callable[[str], Column]):
        self.schema, self.field = schema, field

    def _said(self, value: Column, kind: T.DataType) -> Column:
        """A text, or content parts whose texts are joined."""
        if isinstance(kind, T.VariantType):
            return _variant_text(value)
        if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType) and "text" in kind.elementType.names:
            return _parts_joined(value)
        return value.cast("string")

    def text(self, name: str) -> Column:
        return self._said(self.field(name), self.schema[name].dataType) if name in self.schema.names else F.lit(None).cast("string")

    def lead(self, name: str) -> Column:
        """Turns of a list of role and content, or one user turn of a text; none if the field is absent, null or empty."""
        if name not in self.schema.names:
            return F.array().cast(TURN)
        if isinstance(self.schema[name].dataType, T.ArrayType):
            return F.coalesce(_list(name, "role", "content")(self).cast(TURN), F.array().cast(TURN))
        return _some(_turn("user", self.text(name)), F.coalesce(self.text(name), F.lit("")) != "").cast(TURN)

    def items(self, name: str, role: str, text: str, turn: str | None = None) -> Column:
        kinds = self.schema[name].dataType.elementType
        if not isinstance(kinds, T.StructType):
            return F.transform(self.field(name), lambda m: _item(F.lit(None).cast("string"), m.cast("string")))

        def item(m: Column) -> Column:
            def of(n: str) -> Column:
                return self._said(m[n], kinds[n].dataType) if n in kinds.names else F.lit(None).cast("string")

            return _item(of(role), of(text), m[turn].cast("long") if turn else None)

        return F.transform(self.field(name), item)


def _item(role: Column, text: Column, turn: Column | None = None) -> Column:
    first = [] if turn is None else [turn.alias("turn")]
    return F.struct(*first, F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text"))


def _variant_text(v: Column) -> Column:
    """A text, or content parts whose texts are joined; other values as JSON."""
    parts = F.try_variant_get(v, "$", "array<struct<text:string>>")
    return F.when(F.contains(F.schema_of_variant(v), F.lit("text: STRING")) & parts.isNotNull(), _parts_joined(parts)).otherwise(F.try_variant_get(v, "$", "string"))


class VariantRecord:
    """Reads a mapping's fields from a variant, by row."""

    def __init__(self, record: Column):
        self.record = record

    def text(self, name: str) -> Column:
        return _variant_text(F.try_variant_get(self.record, f"$.{name}", "variant"))

    def lead(self, name: str) -> Column:
        text = F.coalesce(self.text(name), F.lit(""))
        return F.coalesce(_list(name, "role", "content")(self).cast(TURN), _some(_turn("user", text), text != "").cast(TURN))

    def items(self, name: str, role: str, text: str, turn: str | None = None) -> Column:
        fields = f"`{role}`:string,`{text}`:variant" + (f",`{turn}`:bigint" if turn else "")
        found = F.transform(F.try_variant_get(self.record, f"$.{name}", f"array<struct<{fields}>>"), lambda m: _item(m[role], _variant_text(m[text]), m[turn] if turn else None))
        kinds = F.transform(F.try_variant_get(self.record, f"$.{name}", "array<variant>"), F.schema_of_variant)
        return F.when(F.forall(kinds, lambda k: k.startswith("OBJECT<")), found)


Record = TypedRecord | VariantRecord
Mapping = Callable[[Record], Column]


@dataclass(frozen=True)
class Layout:
    name: str
    paths: tuple[str, ...]
    turns: Mapping
    optional: tuple[str, ...] = ()


#: The declarative mappings. Of those that fit a record the one with most paths counts; lists of any other elements are left to the shorter ones.
LAYOUTS = (
    Layout("rows by turn", ("rows[]", "rows[].turn", "rows[].role", "rows[].text"), _rows),
    Layout("messages", ("messages[]", "messages[].role", "messages[].content"), _list("messages", "role", "content"), ("messages[].content[]", "messages[].content[].text", "messages[].content[].type")),
    Layout("from and value", ("conversations[]", "conversations[].from", "conversations[].value"), _list("conversations", "from", "value")),
    Layout("system, messages", ("system", "messages[]", "messages[].role", "messages[].content"), _with_system(_list("messages", "role", "content")), ("messages[].content[]", "messages[].content[].text", "messages[].content[].type")),
    Layout("system, from and value", ("system", "conversations[]", "conversations[].from", "conversations[].value"), _with_system(_list("conversations", "from", "value"))),
    Layout("no messages", ("messages[]",), _no_items("messages")),
    Layout("no conversations", ("conversations[]",), _no_items("conversations")),
    Layout("instruction", ("instruction", "output"), _instruction_to("output"), ("input",)),
    Layout("prompt and completion", ("prompt", "completion"), _pair("prompt", "completion")),
    Layout("prompt and response", ("prompt", "response"), _pair("prompt", "response")),
    Layout("system, prompt and response", ("system", "prompt", "response"), _with_system(_pair("prompt", "response"))),
    Layout("question and answer", ("question", "answer"), _pair("question", "answer")),
    Layout("prompt messages and preferred messages", ("prompt[]", "prompt[].role", "prompt[].content", "chosen[]", "chosen[].role", "chosen[].content"), _preferred, ("rejected", "rejected[]", "rejected[].role", "rejected[].content")),
    Layout("preferred messages", ("chosen[]", "chosen[].role", "chosen[].content"), _preferred, ("prompt", "rejected", "rejected[]", "rejected[].role", "rejected[].content")),
    Layout("preferred answer", ("prompt", "chosen", "rejected"), _pair("prompt", "chosen")),
    Layout("conversations of roles", ("conversations[]", "conversations[].role", "conversations[].content"), _list("conversations", "role", "content")),
    Layout("system, conversations of roles", ("system", "conversations[]", "conversations[].role", "conversations[].content"), _with_system(_list("conversations", "role", "content"))),
    Layout("conversation of roles", ("conversation[]", "conversation[].role", "conversation[].content"), _list("conversation", "role", "content")),
    Layout("conversation, from and value", ("conversation[]", "conversation[].from", "conversation[].value"), _list("conversation", "from", "value")),
    Layout("instruction and response", ("instruction", "response"), _instruction_to("response"), ("input",)),
    Layout("query and response", ("query", "response"), _pair("query", "response")),
    Layout("input and output", ("input", "output"), _pair("input", "output")),
)
#: Paths that mappings know; a record's others take no part in its fingerprint. A list's own name goes with its elements.
KNOWN = tuple(sorted({p for x in LAYOUTS for p in (*x.paths, *x.optional)} | {p[:-2] for x in LAYOUTS for p in (*x.paths, *x.optional) if p.endswith("[]")}))
BY_PATHS = sorted(LAYOUTS, key=lambda x: -len(x.paths))


def field_paths(schema: T.DataType, prefix: str = "") -> list[str]:
    """Sorted nested paths: a.b for a field of a record, a[] for a list's elements, a[].b for their fields."""
    if isinstance(schema, T.ArrayType):
        return sorted([f"{prefix}[]", *field_paths(schema.elementType, f"{prefix}[]")])
    if not isinstance(schema, T.StructType):
        return []
    names = [(f"{prefix}.{f.name}" if prefix else f.name, f.dataType) for f in schema]
    return sorted(x for name, kind in names for x in (name, *field_paths(kind, name)))


def fingerprint(paths: list[str]) -> str:
    return hashlib.sha256("\n".join(sorted({*paths} & {*KNOWN})).encode()).hexdigest()[:16]


def _own_fingerprints() -> dict[str, str]:
    """Fingerprint to mapping of records with a mapping's paths, with and without all optional ones."""
    out = {}
    for x in reversed(BY_PATHS):
        for paths in (x.paths, (*x.paths, *x.optional)):
            lists = [p[:-2] for p in paths if p.endswith("[]")]
            out[fingerprint([*paths, *lists])] = x.name
    return out


OWN = _own_fingerprints()


def variant_paths(record: Column) -> Column:
    """The sorted nested paths of a variant, as field_paths has them, from its schema's text."""
    tokens = F.regexp_extract_all(F.schema_of_variant(record), F.lit("(?:`(?:[^`]|``)*`|[^<>,:` ]+): |OBJECT<|ARRAY<|>"), F.lit(0))
    start = F.struct(F.array(F.lit("")).alias("open"), F.lit("").alias("at"), F.array().cast("array<string>").alias("out"))

    def step(acc: Column, token: Column) -> Column:
        top = F.element_at(acc["open"], -1)
        name = F.regexp_replace(F.substr(token, F.lit(1), F.length(token) - 2), "^`|`$", "")
        field = F.when(top == "", name).otherwise(F.concat(top, F.lit("."), name))
        inner = F.concat(acc["at"], F.lit("[]"))
        make = lambda o, a, x: F.struct(o.alias("open"), a.alias("at"), x.alias("out"))
        return (
            F.when(token == "OBJECT<", make(F.concat(acc["open"], F.array(acc["at"])), acc["at"], acc["out"]))
            .when(token == "ARRAY<", make(F.concat(acc["open"], F.array(inner)), inner, F.concat(acc["out"], F.array(inner))))
            .when(token == ">", make(F.slice(acc["open"], 1, F.size(acc["open"]) - 1), top, acc["out"]))
            .otherwise(make(acc["open"], field, F.concat(acc["out"], F.array(field))))
        )

    return F.array_sort(F.array_distinct(F.aggregate(tokens, start, step)["out"]))


def path_fingerprint(paths: Column) -> Column:
    """fingerprint() of a column of sorted paths."""
    known = F.array(*map(F.lit, KNOWN))
    return F.substring(F.sha2(F.array_join(F.array_intersect(known, paths), "\n"), 256), 1, 16)


def path_layout(paths: Column) -> Column:
    """The mapping's name that the fingerprint selects; null if none fits."""
    own = F.create_map(*(F.lit(x) for pair in OWN.items() for x in pair))
    fits = F.lit(None).cast("string")
    for x in reversed(BY_PATHS):
        fits = F.when(F.size(F.array_intersect(paths, F.array(*map(F.lit, x.paths)))) == len(x.paths), x.name).otherwise(fits)
    return F.coalesce(F.try_element_at(own, path_fingerprint(paths)), fits)


def turns_of(schema: T.StructType, field: Callable[[str], Column]) -> Column:
    """Canonical turns of a typed record, by the mapping that its fingerprint selects; a ValueError if none fits."""
    paths = field_paths(schema)
    name = OWN.get(fingerprint(paths)) or next((x.name for x in BY_PATHS if {*x.paths} <= {*paths}), "no ")
    if name.startswith("no "):  # a type can't tell that its list is empty
        raise ValueError(f"no mapping for {paths}")
    return next(x for x in LAYOUTS if x.name == name).turns(TypedRecord(schema, field)).cast(TURN)


def variant_turns(record: Column, layout: Column) -> Column:
    """Canonical turns of a variant by its mapping's name; null without one, or where the record's values don't have the mapping's types."""
    out = F.lit(None).cast(TURN)
    for x in LAYOUTS:
        out = F.when(layout == x.name, x.turns(VariantRecord(record)).cast(TURN)).otherwise(out)
    return out


def json_turns(record: Column) -> Column:
    """Canonical turns of JSON records of mixed layouts; null where no mapping fits. format_json tells which."""
    parsed = F.try_parse_json(record)
    return variant_turns(parsed, path_layout(variant_paths(parsed)))


def format_json(records: DataFrame, record: str = "record", conversation: str = "conv_id") -> DataFrame:
    """conv_id, fingerprint, layout, formatted and loss_spans of JSON records, one row for each record.

    layout is "unmapped" where no mapping fits, the record is null or no JSON object, or its lists
    hold other things than records; such a row has null formatted and loss_spans, and unmapped() counts them.
    Fields that no mapping knows are left aside. Null roles and texts are
    empty, null and repeated ids keep their rows; no records, no rows.
    """
    parsed = records.select(F.col(conversation).alias("conv_id"), F.try_parse_json(record).alias("v"))
    paths = parsed.select("conv_id", "v", variant_paths(F.col("v")).alias("paths"))
    named = paths.select("conv_id", "v", path_fingerprint(F.col("paths")).alias("fingerprint"), path_layout(F.col("paths")).alias("layout"))
    turns = named.select("conv_id", "fingerprint", "layout", variant_turns(F.col("v"), F.col("layout")).alias("turns"))
    good = F.col("turns").isNotNull()
    return turns.select(
        "conv_id", "fingerprint", F.when(good, F.col("layout")).otherwise("unmapped").alias("layout"),
        F.when(good, format_turns(F.col("turns"))).alias("formatted"), F.when(good, loss_spans(F.col("turns"))).alias("loss_spans"),
    )


def unmapped(formatted: DataFrame) -> DataFrame:
    """fingerprint and records: how many records of format_json no mapping fitted."""
    return formatted.where("layout = 'unmapped'").groupBy("fingerprint").agg(F.count("*").alias("records"))


def gather_rows(rows: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One record for each conversation from rows by turn: conv_id, rows."""
    one = F.struct(F.col(turn).cast("long").alias("turn"), F.col(role).alias("role"), F.col(text).alias("text"))
    return rows.groupBy(F.col(conversation).alias("conv_id")).agg(F.collect_list(one).alias("rows"))


def format_turns(turns: Column) -> Column:
    """The template's text of canonical turns; null is none."""
    each = F.transform(turns, lambda t: F.concat(F.lit(OPEN), escape(t["role"], True), F.lit(SHUT), escape(t["text"]), F.lit(END)))
    return F.coalesce(F.array_join(each, ""), F.lit(""))


def loss_spans(turns: Column) -> Column:
    """array<struct<start:int,length:int>>: assistant texts in the formatted text, in code points from 0."""
    empty = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans"))

    def step(acc: Column, t: Column) -> Column:
        before = acc["at"] + F.lit(len(OPEN) + len(SHUT)) + F.length(escape(t["role"], True))
        size = F.length(escape(t["text"]))
        span = F.array(F.struct(before.alias("start"), size.alias("length")))
        return F.struct((before + size + F.lit(len(END))).alias("at"), F.when(t["role"] == TRAINED, F.concat(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"))

    return F.coalesce(F.aggregate(turns, empty, step)["spans"], F.array().cast("array<struct<start:int,length:int>>"))


def parse_turns(formatted: Column) -> Column:
    """Canonical turns read back from the formatted text."""
    parts = F.filter(F.split(formatted, "<\\|end\\|>"), lambda p: p != "")

    def turn(p: Column) -> Column:
        role = F.substring_index(F.substr(p, F.lit(len(OPEN) + 1)), SHUT, 1)
        return F.struct(unescape(role).alias("role"), unescape(F.substr(p, F.length(role) + F.lit(len(OPEN) + len(SHUT) + 1))).alias("text"))

    return F.transform(parts, turn)


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return unescape(F.array_join(F.transform(spans, lambda s: F.substr(formatted, s["start"] + 1, s["length"])), ""))


def format_conversations(records: DataFrame, conversation: str = "conv_id") -> DataFrame:
    """conv_id, formatted and loss_spans of typed records, one row for each record.

    The layout comes from the fingerprint of all columns but the id; columns that
    its mapping doesn't name are left aside. Null roles and texts are empty, ties
    of a turn number are ordered by role and text, null turns come first; a null
    conv_id is a conversation of its own; no records, no rows.
    """
    schema = T.StructType([f for f in records.schema if f.name != conversation])
    turns = records.select(F.col(conversation).alias("conv_id"), turns_of(schema, lambda f: F.col(f"`{f}`")).alias("turns"))
    return turns.select("conv_id", format_turns(F.col("turns")).alias("formatted"), loss_spans(F.col("turns")).alias("loss_spans"))
