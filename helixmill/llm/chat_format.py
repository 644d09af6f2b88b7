r"""Chat formatting by schema fingerprints, with DataFrame functions only.

Records come in many layouts: a turn a row, lists of messages, prompt and completion,
instruction with input and output. A record's layout shows in which nested fields it has. The
sorted paths of those fields ("messages[].role") are hashed; a registry maps the fingerprints to
declarative mappings, and the mapping of a record's fingerprint makes its canonical turns
(number, role, text). Optional fields give a mapping several fingerprints, one for each set of
them. Where two mappings would have one, the first of the registry has it. Fields that no
mapping names aren't part of a fingerprint, so other columns are ignored, whatever their names.

The template writes a turn as

    ### Assistant: text
    </turn>

and a backslash before each control string ("###" or longer, "</turn>", with any backslashes
before it) inside a text, which reading takes away again. A text's "</turn>" thus always follows
a backslash and a real one a line feed, so texts are cut apart and read back exactly. Roles
other than the usual three are written behind "=", URL-encoded. The loss mask has an entry a
turn: for assistants' turns where their (escaped) text begins in the turn and in the whole, and
its length, in code points; null for others.

The turns of a conversation meet in one task, as its formatted text is one row, which Spark
bounds at 2 GB; conversations are otherwise spread by their keys, texts are shuffled once.

Defined results: a null text or role is empty; turns are in order of number, role and text, turns
without number last; repeated rows are turns of their own; rows without key are one
conversation; a record of no known layout has no turns (`layout` is null) and its conversation
is kept, with 0 turns if it has no other; a message list that is empty gives no turns; an empty
table gives no rows.
"""

from __future__ import annotations

import hashlib
import itertools
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROLES = ("system", "user", "assistant")
#: Control strings: runs of three and more hashes, and the end of a turn.
CONTROL = r"#{3,}+|</turn>"
END = "\n</turn>\n"
TURN = "struct<turn:bigint,role:string,text:string>"


@dataclass(frozen=True)
class Mapping:
    """How records of one layout become turns.

    `required` and `optional` are the nested paths of its fields; "x[]" is the list itself.
    Either `messages` names a list, and `role`, `text` its elements' fields, or `turns` pairs
    each role with the paths whose texts (joined by blank lines) it says, or `row` is set and
    `number`, `role`, `text` are the fields of a row that is one turn. `roles` renames roles.
    """

    name: str
    required: tuple[str, ...] = ()
    optional: tuple[str, ...] = ()
    messages: str = ""
    turns: tuple[tuple[str, tuple[str, ...]], ...] = ()
    row: bool = False
    number: str = ""
    role: str = ""
    text: str = ""
    roles: dict[str, str] = field(default_factory=dict)


MAPPINGS = (
    Mapping("row", optional=("turn", "role", "text"), row=True, number="turn", role="role", text="text"),
    Mapping("messages", ("messages[]",), ("messages[].role", "messages[].content"), "messages", role="role", text="content"),
    Mapping(
        "from_value", ("conversations[]",), ("conversations[].from", "conversations[].value"), "conversations", role="from", text="value",
        roles={"human": "user", "gpt": "assistant", "bot": "assistant"},
    ),
    Mapping("instruction", ("instruction", "output"), ("input", "system"), turns=(("system", ("system",)), ("user", ("instruction", "input")), ("assistant", ("output",)))),
    Mapping("completion", ("prompt", "completion"), ("system",), turns=(("system", ("system",)), ("user", ("prompt",)), ("assistant", ("completion",)))),
    Mapping("response", ("prompt", "response"), ("system",), turns=(("system", ("system",)), ("user", ("prompt",)), ("assistant", ("response",)))),
)


def paths(schema: T.DataType, at: str = "") -> list[str]:
    """The nested paths of a schema's fields and lists, sorted."""
    if isinstance(schema, T.ArrayType):
        return [f"{at}[]", *paths(schema.elementType, f"{at}[]")]
    if isinstance(schema, T.StructType):
        return sorted(p for f in schema.fields for p in (paths(f.dataType, f"{at}.{f.name}" if at else f.name)))
    return [at] if not at.endswith("[]") else []


def _present(path: str, x: Column | None = None) -> Column:
    """Whether a record has something at the path: in any element, where it leads through lists."""
    head, dot, rest = path.partition("[]")
    for name in [n for n in head.strip(".").split(".") if n]:
        x = F.col(f"`{name}`") if x is None else x[name]
    if not dot:
        return x.isNotNull()
    return F.exists(x, lambda y: _present(rest, y)) if rest else x.isNotNull()


def fingerprint_of(found: list[str]) -> str:
    return hashlib.md5(",".join(sorted(found)).encode()).hexdigest()


def fingerprint(known: list[str]) -> Column:
    """The MD5 of the paths among `known` that a record has, sorted and joined by commas."""
    return F.md5(F.concat_ws(",", *[F.when(_present(p), F.lit(p)) for p in sorted(known)]).cast("binary"))


def registry(mappings: tuple[Mapping, ...], known: list[str]) -> dict[str, int]:
    """Fingerprint -> mapping's number, for the mappings that a table with these paths can have."""
    found: dict[str, int] = {}
    for i, m in enumerate(mappings):
        named = {*m.required, *m.optional}
        if not named & {*known} or not {*m.required} <= {*known}:
            continue
        free = [p for p in m.optional if p in known]
        for n in range(len(free), -1, -1):
            for some in itertools.combinations(free, n):
                found.setdefault(fingerprint_of([*m.required, *some]), i)
    return found


def _field(path: str) -> Column:
    x = None
    for name in path.split("."):
        x = F.col(f"`{name}`") if x is None else x[name]
    return x


def _turns(m: Mapping, known: list[str]) -> Column:
    """A record's turns by the mapping."""
    have = lambda p: _field(p).cast("string") if p in known else F.lit(None).cast("string")

    def named(role: Column) -> Column:
        for a, b in m.roles.items():
            role = F.when(role == a, b).otherwise(role)
        return role

    if m.row:
        number = _field(m.number).cast("long") if m.number in known else F.lit(None).cast("long")
        made = F.array(F.struct(number.alias("turn"), named(have(m.role)).alias("role"), have(m.text).alias("text")))
    elif m.messages:
        inner = lambda x, f: x[f].cast("string") if f"{m.messages}[].{f}" in known else F.lit(None).cast("string")
        made = F.transform(
            _field(m.messages), lambda x, i: F.struct(i.cast("long").alias("turn"), named(inner(x, m.role)).alias("role"), inner(x, m.text).alias("text"))
        )
    else:
        said = [(role, [_field(p).cast("string") for p in where if p in known]) for role, where in m.turns]
        each = [F.struct(F.lit(i).cast("long").alias("turn"), F.lit(r).alias("role"), F.concat_ws("\n\n", *x).alias("text")) for i, (r, x) in enumerate(said) if x]
        there = [F.coalesce(*x).isNotNull() for _, x in said if x]
        made = F.filter(F.array(*[F.when(t, e) for t, e in zip(there, each, strict=True)]), lambda x: x.isNotNull())
    return made.cast(f"array<{TURN}>")


def canonical(records: DataFrame, key: str, mappings: tuple[Mapping, ...] = MAPPINGS) -> DataFrame:
    """(key, fingerprint, layout, turns): each record's canonical turns by its fingerprint's mapping."""
    all_paths = {p for m in mappings for p in (*m.required, *m.optional)}
    fields = [f for f in records.schema.fields if f.name != key]
    known = [p for p in paths(T.StructType(fields)) if p in all_paths]
    chosen = registry(mappings, known)
    number, layout, turns = F.lit(None).cast("int"), F.lit(None).cast("string"), F.lit(None).cast(f"array<{TURN}>")
    if chosen:
        pairs = [F.lit(x) for item in chosen.items() for x in item]
        number = F.element_at(F.create_map(*pairs), F.col("fingerprint"))
        for i in sorted({*chosen.values()}):
            layout = F.when(F.col("__mapping") == i, F.lit(mappings[i].name)).otherwise(layout)
            turns = F.when(F.col("__mapping") == i, _turns(mappings[i], known)).otherwise(turns)
    one = records.withColumn("fingerprint", fingerprint(known)).withColumn("__mapping", number)
    return one.select(F.col(key).alias("key"), "fingerprint", layout.alias("layout"), turns.alias("turns"))


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, rf"(?<!\\)(\\*+)({CONTROL})", r"\\$1$2")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, rf"(?<!\\)\\(\\*+)({CONTROL})", "$1$2")


def _header(role: Column) -> Column:
    usual = F.initcap(F.when(role.isin(*ROLES), role))
    return F.concat(F.lit("### "), F.coalesce(usual, F.concat(F.lit("="), F.url_encode(role))), F.lit(": "))


def formatted(records: DataFrame, key: str, mappings: tuple[Mapping, ...] = MAPPINGS, loss_on: str = "assistant") -> DataFrame:
    """(key, formatted, mask): each conversation's text and its loss mask, an entry a turn.

    An entry is null or (at, start, length): where the turn's text under the loss begins in
    the turn and in the whole text, from 0, and how long it is, in code points.
    """
    turns = canonical(records, key, mappings).select("key", F.explode_outer("turns").alias("t"))
    said = turns.select("key", F.col("t").isNotNull().alias("said"), "t.turn", *[F.coalesce(f"t.{c}", F.lit("")).alias(c) for c in ("role", "text")])
    by = [F.col("turn").isNull(), "turn", "role", "text"]
    written = said.withColumns({"header": _header(F.col("role")), "body": escaped(F.col("text"))})
    size = F.when(F.col("said"), F.length("header") + F.length("body") + len(END)).otherwise(0).cast("long")
    order = Window.partitionBy("key").orderBy(~F.col("said"), *by)
    before = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1))
    placed = written.withColumn("size", size).withColumns({"i": F.row_number().over(order), "start": F.coalesce(before, F.lit(0))})
    at = F.length("header").cast("long")
    span = F.when(F.col("role") == loss_on, F.struct(at.alias("at"), (F.col("start") + at).alias("start"), F.length("body").cast("long").alias("length")))
    row = F.when(F.col("said"), F.struct("i", F.concat("header", "body", F.lit(END)).alias("text"), span.alias("mask")))
    rows = placed.groupBy("key").agg(F.array_sort(F.collect_list(row)).alias("rows"))
    return rows.select("key", F.array_join(F.col("rows.text"), "").alias("formatted"), F.col("rows.mask").alias("mask"))


def read_back(chats: DataFrame) -> DataFrame:
    """(key, turns, loss, formatted_chars): the turns' roles and texts, and the texts under the
    mask (null for turns that have none), read from what `formatted` returns."""
    parts = F.split("formatted", "\n</turn>\n", -1)
    cut = chats.select("key", "mask", F.length("formatted").cast("long").alias("formatted_chars"), F.slice(parts, F.lit(1), F.size(parts) - 1).alias("parts"))

    def turn(x: Column) -> Column:
        name = F.regexp_extract(x, r"^### ([^:]*+): ", 1)
        role = F.when(name.startswith("="), F.url_decode(F.substring(name, 2, 1 << 30))).otherwise(F.lower(name))
        text = F.substring(x, F.length(name) + F.lit(len("### : ") + 1), F.lit(2**31 - 1))
        return F.struct(role.alias("role"), unescaped(text).alias("text"))

    loss = F.zip_with("parts", "mask", lambda x, m: F.when(m.isNotNull(), unescaped(F.substring(x, m["at"].cast("int") + 1, m["length"].cast("int")))))
    return cut.select("key", F.transform("parts", turn).alias("turns"), loss.alias("loss"), "formatted_chars")
