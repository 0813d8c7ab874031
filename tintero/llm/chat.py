r"""Conversations of many layouts as one marked-up text with a loss mask.

A record is a JSON object.  Its schema fingerprint is a hash of its nested
field paths, as far as any layout names them, and selects the declarative mapping that
turns it into canonical turns (role, text).  The template marks each turn as

    <s>role\ntext</s>

and keeps control strings out of texts: after the first character of each one
inside a text, and of each escape, comes a backslash, which reading removes.
Everything is a column expression.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE = "<s>", "</s>"
#: A control string's first character, before the rest of it: <s> </s> [INST] [/INST] <<SYS>> <</SYS>> and <|name|>.
_CONTROL = r"(<(?=/?s>)|\[(?=/?INST\])|<(?=</?SYS>>)|<(?=\|))"
_TURNS = "array<struct<role:string,text:string>>"


@dataclass(frozen=True)
class Layout:
    """Where a layout keeps its turns: fields with a fixed role, or a list with a role and a text in each item."""

    name: str
    fields: tuple[tuple[str, str], ...] = ()
    items: str | None = None
    role: str = "role"
    text: str = "content"
    roles: dict[str, str] = field(default_factory=dict)

    def paths(self) -> tuple[str, ...]:
        if self.items:
            return tuple(sorted((self.items, f"{self.items}[].{self.role}", f"{self.items}[].{self.text}")))
        return tuple(sorted(path for _, path in self.fields))


#: Layouts that public instruction sets use.
LAYOUTS = (
    Layout("messages", items="messages"),
    Layout("conversations", items="conversations", role="from", text="value",
           roles={"human": "user", "gpt": "assistant"}),
    Layout("prompt", (("user", "prompt"), ("assistant", "response"))),
    Layout("completion", (("user", "prompt"), ("assistant", "completion"))),
    Layout("system prompt", (("system", "system"), ("user", "prompt"), ("assistant", "response"))),
    Layout("instruction", (("user", "instruction"), ("assistant", "output"))),
    Layout("instruction with input", (("user", "instruction"), ("user", "input"), ("assistant", "output"))),
)


def field_paths(record: Column, layouts: tuple[Layout, ...] = LAYOUTS) -> Column:
    """Sorted nested field paths of a record that any of the layouts names.

    Items of a list count together: a path is there if any item has it.
    """
    known = sorted({p for layout in layouts for p in layout.paths()})
    none = F.array().cast("array<string>")

    def inside(items: str) -> Column:
        found = F.from_json(F.get_json_object(record, f"$.{items}"), "array<map<string,string>>")
        names = F.array_distinct(F.flatten(F.transform(found, lambda m: F.coalesce(F.map_keys(m), none))))
        return F.transform(names, lambda n: F.concat(F.lit(f"{items}[]."), n))

    lists = sorted({x.items for x in layouts if x.items})
    paths = [F.coalesce(p, none) for p in (F.json_object_keys(record), *map(inside, lists))]
    every = F.array_distinct(F.concat(*paths))
    return F.array_sort(F.array_intersect(every, F.array(*map(F.lit, known))))


def fingerprint(paths: Column) -> Column:
    return F.sha2(F.array_join(paths, "\n").cast("binary"), 256)


def _turns(record: Column, layout: Layout) -> Column:
    def turn(role: Column, text: Column) -> Column:
        return F.struct(F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text"))

    if layout.items:
        kind = f"array<struct<`{layout.role}`:string,`{layout.text}`:string>>"
        inside = F.from_json(F.get_json_object(record, f"$.{layout.items}"), kind)
        names = F.create_map(*[F.lit(x) for pair in layout.roles.items() for x in pair]) if layout.roles else None

        def of_item(item: Column) -> Column:
            role = item[layout.role]
            return turn(F.coalesce(names[role], role) if names is not None else role, item[layout.text])

        return F.transform(inside, of_item)
    values = F.from_json(record, ", ".join(f"`{path}` string" for _, path in layout.fields))
    return F.array(*[turn(F.lit(role), values[path]) for role, path in layout.fields])


def canonical_turns(record: Column, paths: Column, layouts: tuple[Layout, ...] = LAYOUTS) -> Column:
    """Turns of a record, by the fingerprint of its paths; null for a record of no known layout.

    A layout's fingerprint is computed like a record's.  A record of one path
    set can only match one layout.
    """
    found, seen = fingerprint(paths), F.lit(None).cast(_TURNS)
    for layout in reversed(layouts):
        own = fingerprint(F.array(*map(F.lit, layout.paths())))
        seen = F.when(found == own, _turns(record, layout)).otherwise(seen)
    return seen


def escape(text: Column) -> Column:
    plain = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(plain, _CONTROL, "$1\\\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(\\?)", "$1")


def _escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def format_turns(turns: Column) -> Column:
    """The marked-up conversation."""
    return F.array_join(
        F.transform(turns, lambda t: F.concat(F.lit(OPEN), _escape_role(t["role"]), F.lit("\n"), escape(t["text"]), F.lit(CLOSE))),
        "",
    )


def read_turns(formatted: Column) -> Column:
    """The turns of a marked-up conversation, with the first and the last place (0, excluded) of each text in it."""
    pieces = F.split(formatted, CLOSE, -1)
    pieces = F.slice(pieces, 1, F.size(pieces) - 1)
    border = "\n"

    def turn(piece: Column) -> Column:
        at = F.instr(piece, border)
        body = F.substring(piece, at + 1, F.char_length(piece))
        role = F.substring(piece, F.lit(len(OPEN) + 1), at - 1 - len(OPEN))
        role = unescape(F.regexp_replace(role, r"(?<!\\)((?:\\\\)*)\\n", "$1\n"))
        return F.struct(role.alias("role"), unescape(body).alias("text"), F.char_length(body).alias("size"),
                        F.char_length(piece).alias("all"))

    return F.transform(pieces, turn)


def loss_spans(turns: Column) -> Column:
    """(start, end) of the assistant's texts within the marked-up conversation, from the turns as read back."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def step(state: Column, t: Column) -> Column:
        end = state["at"] + t["all"]
        span = F.struct((end - t["size"]).alias("start"), end.alias("end"))
        spans = F.when(t["role"] == "assistant", F.concat(state["spans"], F.array(span))).otherwise(state["spans"])
        return F.struct((end + len(CLOSE)).alias("at"), spans.alias("spans"))

    return F.aggregate(turns, start, step, lambda state: state["spans"])


def format_records(records: DataFrame, record: str = "record", layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """``records`` with schema_fingerprint, formatted, and loss_spans, an array of (start, end) in code points.

    Text under the spans is escaped; ``unescape`` gives it back.  A null record,
    one that isn't an object, and one of no known layout have a null
    ``formatted``; no turns give an empty one.  Null roles and texts count as
    empty; fields that no layout names don't matter.  Columns of the three names are
    replaced, others pass unchanged.  A conversation is one row, so its length
    is bounded by the row.
    """
    kept = records.drop("schema_fingerprint", "formatted", "loss_spans", "_paths")
    out = kept.withColumn("_paths", field_paths(F.col(record), layouts))
    out = out.withColumn("schema_fingerprint", fingerprint(F.col("_paths")))
    out = out.withColumn("formatted", format_turns(canonical_turns(F.col(record), F.col("_paths"), layouts)))
    out = out.withColumn("loss_spans", loss_spans(read_turns(F.col("formatted"))))
    return out.drop("_paths")


def records_of_turns(rows: DataFrame) -> DataFrame:
    """(conv_id, record) of a table (conv_id, turn, role, text): one JSON object per conversation.

    Turns stand in order of turn, then role and text; null turns come first.
    A conversation of one question and its answer becomes a prompt record, one
    with a system turn before them a system prompt record, any other a list of
    messages.
    """
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("content"))
    grouped = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    roles = F.array_join(F.transform("turns", lambda t: t["role"]), "\n")

    def text(i: int) -> Column:
        return F.col("turns")[i]["content"]

    messages = F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["content"].alias("content")))
    record = (
        F.when(roles == "user\nassistant", F.to_json(F.struct(text(0).alias("prompt"), text(1).alias("response"))))
        .when(
            roles == "system\nuser\nassistant",
            F.to_json(F.struct(text(0).alias("system"), text(1).alias("prompt"), F.element_at("turns", 3)["content"].alias("response"))),
        )
        .otherwise(F.to_json(F.struct(messages.alias("messages"))))
    )
    return grouped.select("conv_id", record.alias("record"))
