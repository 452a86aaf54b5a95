"""Chat formatting: records of many layouts become canonical turns, and turns one string of a template with a loss mask.

A record's schema is told by its nested field paths (`messages[].role`, `prompt`, ...). Each layout of `LAYOUTS` declares the paths that it
knows; the paths of a record that it knows, sorted and hashed, are the record's fingerprint for that layout, and the layout takes the record if
the fingerprint is one of those that it accepts. So fields that a layout does not know change nothing, and the first layout
in order takes a record that two would take. The paths come from the schema of a DataFrame, once, or from each row of a
column of JSON, where rows of one file may differ. What a layout maps is declared as data; column expressions are made from it.

The template gives every turn an opening and a closing control string by its role; roles that it does not know are written out. A control string
inside a text gets a backslash after its first character, as does one that has backslashes there already, so no
text holds a control string and taking one backslash away gives it back. The mask is a run-length code: for each turn, how many
code points to skip, to learn and to skip; what is learned is the escaped text of assistant turns.

Everything is expressions of the JVM: no Python runs over the rows. Rows of turns are gathered by conversation, the only shuffle; a
conversation, like a document, is one record, and its digest needs it in one piece. Work is linear in its length.

Defined cases: null texts and null roles are empty; turns are ordered by turn, null first, then role, then text; repeated rows are
turns of their own; rows with a null conv_id make up one conversation without an id; an empty table gives an empty table; a record of no layout,
and JSON that is null or no object, gives null turns and an empty layout name; JSON whose fields have another type than
the layout's gives no turn for them; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

TURN = "struct<role: string, text: string>"

#: Other names of roles.
ROLES = {"human": "user", "prompter": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant", "chatbot": "assistant"}


@dataclass(frozen=True)
class Layout:
    """One turn for each (role, field) of `fields`, of which those in `optional` may be absent, null or empty, and then are no
    turn; then a list of turns (`items`: field of the list, of the role and of the text), whose roles get their usual names unless `verbatim`."""

    name: str
    items: tuple[str, str, str] | None = None
    fields: tuple[tuple[str, str], ...] = ()
    optional: tuple[str, ...] = ()
    verbatim: bool = False

    def paths(self) -> tuple[str, ...]:
        own = (f"{self.items[0]}[].{self.items[1]}", f"{self.items[0]}[].{self.items[2]}") if self.items else ()
        return own + tuple(f for _, f in self.fields)

    def accepted(self) -> set[str]:
        """Fingerprints of all required paths with any of the optional ones."""
        need = [p for p in self.paths() if p not in self.optional]
        return {fingerprint([*need, *more]) for k in range(len(self.optional) + 1) for more in combinations(self.optional, k)}

    def schema(self) -> str:
        """Schema by which its JSON is read."""
        lists = [f"`{self.items[0]}` array<struct<`{self.items[1]}`: string, `{self.items[2]}`: string>>"] if self.items else []
        return ", ".join(lists + [f"`{f}` string" for _, f in self.fields])


LAYOUTS = (
    Layout("rows", items=("rows", "role", "text"), verbatim=True),
    Layout("messages", items=("messages", "role", "content"), fields=(("system", "system"),), optional=("system",)),
    Layout("exchange", items=("conversations", "from", "value"), fields=(("system", "system"),), optional=("system",)),
    Layout("instruction", fields=(("system", "system"), ("user", "instruction"), ("user", "input"), ("assistant", "output")), optional=("system", "input")),
    Layout("prompt", fields=(("system", "system"), ("user", "prompt"), ("assistant", "completion")), optional=("system",)),
    Layout("response", fields=(("system", "system"), ("user", "prompt"), ("assistant", "response")), optional=("system",)),
    Layout("question", fields=(("system", "system"), ("user", "question"), ("assistant", "answer")), optional=("system",)),
)


def fingerprint(paths: list[str]) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()


def schema_paths(kind: DataType, at: str = "") -> list[str]:
    """Nested field paths of a type; `[]` stands for the elements of a list."""
    if isinstance(kind, ArrayType):
        return schema_paths(kind.elementType, f"{at}[]")
    if isinstance(kind, StructType):
        return [p for f in kind for p in schema_paths(f.dataType, f"{at}.{f.name}" if at else f.name)]
    return [at]


def json_paths(record: Column, depth: int = 2) -> Column:
    """Distinct nested field paths of a JSON object, through lists and objects down to `depth` levels; null if it is none."""
    return F.when(F.json_object_keys(record).isNotNull(), F.array_distinct(_object_paths(record, depth)))


def _object_paths(record: Column, depth: int) -> Column:
    def of(e: Column) -> Column:
        kind, plain = F.schema_of_variant(e["value"]), F.array(e["key"])
        if depth <= 1:
            return plain
        inner = F.to_json(e["value"])
        below = lambda text, sign: F.transform(_object_paths(text, depth - 1), lambda p: F.concat(e["key"], F.lit(sign), p))
        item = lambda x: F.when(F.schema_of_variant(x).startswith("OBJECT"), below(F.to_json(x), "[].")).otherwise(F.array(F.concat(e["key"], F.lit("[]"))))
        parts = F.flatten(F.transform(F.from_json(inner, "array<variant>"), item))
        return F.when(kind.startswith("OBJECT"), below(inner, ".")).when(kind.startswith("ARRAY"), parts).otherwise(plain)

    return F.flatten(F.transform(F.map_entries(F.from_json(record, "map<string, variant>")), of))


def _role(role: Column) -> Column:
    lower = F.lower(F.trim(F.coalesce(role, F.lit(""))))
    other = F.when(lower == "", "")
    for name, own in ROLES.items():
        other = other.when(lower == name, own)
    return other.when(lower.isin(*ROLES.values(), "system"), lower).otherwise(role)


def mapped(layout: Layout, field: dict[str, Column]) -> Column:
    """Turns of a record by a layout; `field` has the columns of its fields."""
    known = [(r, f) for r, f in layout.fields if f in field]
    singles = [F.struct(F.lit(r).alias("role"), F.coalesce(field[f].cast("string"), F.lit("")).alias("text")) for r, f in known]
    one = F.array(*singles).cast(f"array<{TURN}>") if singles else F.array().cast(f"array<{TURN}>")
    skip = [k for k, (_, f) in enumerate(known) if f in layout.optional]
    one = F.filter(one, lambda t, k: ~(k.isin(skip) & (t["text"] == ""))) if skip else one
    if not layout.items:
        return one
    name, role, text = layout.items
    turn = lambda t: F.struct((F.coalesce(t[role].cast("string"), F.lit("")) if layout.verbatim else _role(t[role].cast("string"))).alias("role"), F.coalesce(t[text].cast("string"), F.lit("")).alias("text")).cast(TURN)
    return F.concat(one, F.coalesce(F.transform(field[name], turn), F.array().cast(f"array<{TURN}>")))


def gathered(turns: DataFrame) -> DataFrame:
    """Rows of turns (conv_id, turn, role, text) as one record a conversation: conv_id and rows, in order."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text"))
    rows = turns.select("conv_id", F.struct("turn", role, text).alias("row"))
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("row")).alias("rows"))


def canonical(records: DataFrame, layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """`records` with layout and turns; their one schema selects the layout."""
    own = schema_paths(records.schema)
    layout = next((m for m in layouts if fingerprint([p for p in own if p in m.paths()]) in m.accepted()), None)
    if layout is None:
        return records.withColumn("turns", F.lit(None).cast(f"array<{TURN}>")).withColumn("layout", F.lit(""))
    # fields are taken before `turns` may hide one of that name
    field = {p: F.col(f"`{p}`") for p in {q.split("[")[0] for q in layout.paths() if q in own}}
    return records.withColumns({"turns": mapped(layout, field), "layout": F.lit(layout.name)})


def canonical_json(records: DataFrame, record: str, layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """`records` with layout and turns, read from a column of JSON; each row's own paths select its layout."""
    paths = json_paths(F.col(record))
    mark = lambda m: F.sha2(F.array_join(F.array_sort(F.filter("__paths", lambda p: p.isin(*m.paths()))), "\n"), 256)
    layout, turns = F.lit(""), F.lit(None).cast(f"array<{TURN}>")
    for m in reversed(layouts):
        fits = F.coalesce(mark(m).isin(*sorted(m.accepted())), F.lit(False))
        read = F.from_json(F.col(record), m.schema())
        names = [f for _, f in m.fields] + ([m.items[0]] if m.items else [])
        layout = F.when(fits, m.name).otherwise(layout)
        turns = F.when(F.col("layout") == m.name, mapped(m, {f: read[f] for f in names})).otherwise(turns)
    return records.withColumn("__paths", paths).withColumn("layout", layout).withColumn("turns", turns).drop("__paths")


# ---- template

#: Control strings of the template: fixed values. Each begins with < or [, and holds neither after that.
START, STOP = "<s>", "</s>"
INST, END_INST = "[INST]", "[/INST]"
SYS, END_SYS = "<SYS>", "</SYS>"
ROLE, TEXT, END_ROLE = "[ROLE]", "[TEXT]", "[/ROLE]"
CONTROLS = (START, STOP, INST, END_INST, SYS, END_SYS, ROLE, TEXT, END_ROLE)
#: By role: what opens and what closes its turns.
TURNS = {"system": (SYS, END_SYS), "user": (f"{INST} ", f" {END_INST}"), "assistant": (" ", STOP)}
_BODIES = "|".join(re.escape(c[1:]) for c in CONTROLS)
_CLOSE = "|".join(re.escape(c) for c in (END_SYS, END_INST, STOP, END_ROLE))


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])(\\*)({_BODIES})", r"$1\\$2$3")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])\\(\\*)({_BODIES})", "$1$2$3")


def piece(role: Column, text: Column) -> Column:
    """A turn's formatted string and its mask: code points to skip, to learn and to skip."""
    inner = escaped(text)
    opened, closed = F.concat(F.lit(ROLE), escaped(role), F.lit(TEXT)), F.lit(END_ROLE)
    for name, (o, c) in TURNS.items():
        opened, closed = F.when(role == name, o).otherwise(opened), F.when(role == name, c).otherwise(closed)
    whole = F.concat(opened, inner, closed)
    learn = F.when(role == "assistant", F.length(inner)).otherwise(0)
    skip = F.when(role == "assistant", F.length(opened)).otherwise(F.length(whole))
    rest = F.when(role == "assistant", F.length(closed)).otherwise(0)
    return F.struct(whole.alias("piece"), F.struct(skip.alias("skip"), learn.alias("learn"), rest.alias("rest")).alias("run"))


def format_turns(conversations: DataFrame) -> DataFrame:
    """`conversations` with formatted and loss_runs, from their column turns. A formatted conversation is START and its turns; the runs
    begin after START."""
    made = F.transform("turns", lambda t: piece(t["role"], t["text"]))
    out = conversations.withColumn("__made", made)
    formatted = F.concat(F.lit(START), F.array_join(F.transform("__made", lambda m: m["piece"]), ""))
    return out.withColumns({"formatted": formatted, "loss_runs": F.transform("__made", lambda m: m["run"])}).drop("__made")


def pieces_of(formatted: Column) -> Column:
    """The turns' strings of a formatted conversation: no text holds a closing control string."""
    return F.regexp_extract_all(F.substr(formatted, F.lit(len(START) + 1)), F.lit(rf"(?s).*?(?:{_CLOSE})"), F.lit(0))


def read_piece(piece: Column) -> Column:
    """role and text of a turn's string."""
    between = lambda o, c: F.substr(piece, F.lit(len(o) + 1), F.length(piece) - len(o) - len(c))
    role, text = F.regexp_extract(piece, r"(?s)\A\[ROLE\](.*?)\[TEXT\]", 1), F.regexp_extract(piece, r"(?s)\[TEXT\](.*)\[/ROLE\]\z", 1)
    for name, (o, c) in TURNS.items():
        mine = piece.startswith(o) & piece.endswith(c)
        role, text = F.when(mine, name).otherwise(role), F.when(mine, between(o, c)).otherwise(text)
    return F.struct(unescaped(role).alias("role"), unescaped(text).alias("text"))


def read_back(formatted: Column) -> Column:
    """Turns of a formatted conversation."""
    return F.transform(pieces_of(formatted), read_piece)


def learned(formatted: Column, runs: Column) -> Column:
    """The texts under the loss mask, unescaped, one for each turn that has any."""
    under = F.transform(F.arrays_zip(pieces_of(formatted).alias("piece"), runs.alias("run")), lambda z: F.substr(z["piece"], z["run"]["skip"] + 1, z["run"]["learn"]))
    return F.transform(F.filter(under, lambda t: t != ""), unescaped)


def digests(formatted: DataFrame) -> DataFrame:
    """conv_id and the digests of turns and of what is learned, read back from the formatted strings and their masks."""
    said = F.transform(read_back(F.col("formatted")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    loss = F.array_join(learned(F.col("formatted"), F.col("loss_runs")), "")
    read = formatted.select("conv_id", said.alias("said"), loss.alias("loss"), F.length("formatted").cast("long").alias("formatted_chars"))
    digest = F.sha2(F.array_join("said", ""), 256)
    return read.select("conv_id", F.size("said").cast("long").alias("n_turns"), digest.alias("turns_sha256"), F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")


def formatted_conversations(rows: DataFrame) -> DataFrame:
    """Rows of turns, and a conversation -1 that consists of control strings, in canonical turns, formatted and read back."""
    odd = f"{STOP}{INST} ok {END_INST}"
    extra = rows.sparkSession.sql(f"select -1L conv_id, '{odd}' prompt, '{odd}' completion")
    turns = [canonical(d).select(F.col("conv_id").cast("long").alias("conv_id"), "turns") for d in (gathered(rows), extra)]
    return digests(format_turns(turns[0].unionByName(turns[1])))
