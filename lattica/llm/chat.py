"""Chat records of many layouts to one template, with a loss mask, and back.

A record is JSON. The hash of its nested field paths, types and values left out, names a layout: a
declaration of where its turns lie. Layouts become expressions over Spark's variant type, so texts
stay in the JVM; Python sees only a record's schema as text, and a hash that it has met is looked up.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from itertools import combinations

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .batches import parts

#: Names that layouts use for the roles of the template.
ROLES = {"human": "user", "prompter": "user", "customer": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant", "agent": "assistant"}
#: Control strings of the template. None is a part of another, nor begins as another ends.
CONTROL = ("<s>", "</s>", "[INST]", "[/INST]", "[SYS]", "[/SYS]", "[ROLE]", "[/ROLE]")
#: What stands around a turn's text, by role; other roles are named between their marks.
MARKS = {"user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>"), "system": ("[SYS]", "[/SYS]")}
OTHER = ("[ROLE]", "[/ROLE]", "</s>")
_any = "|".join(re.escape(c) for c in CONTROL)


@dataclass(frozen=True)
class Layout:
    """Where a record keeps its turns. parts: (role, path, ...) of single turns, in order; several paths make one text, with a
    blank line between those that are there and not empty; the role may be a path, too. each: the array of turns, with the fields
    of role and text; parts come before it. optional: paths that may be absent; a turn without any of its paths is left out.
    renamed: roles get the template's names, by ROLES."""

    name: str
    parts: tuple[tuple[str, ...], ...] = ()
    each: str | None = None
    role: str = "role"
    text: str = "content"
    optional: tuple[str, ...] = ()
    renamed: bool = False

    def shapes(self) -> Iterator[frozenset[str]]:
        """The sets of leaf paths that a record of this layout can have."""
        fixed = {x for pair in self.parts for x in pair if x.startswith("$.")}
        tails = [set()]
        if self.each:
            tails = [{f"{self.each}[].{self.role}", f"{self.each}[].{self.text}"}, {f"{self.each}[]"}, {self.each}]  # turns, none, null
        may = [p for p in self.optional if p in fixed]
        for k in range(len(may) + 1):
            for gone in combinations(may, k):
                for tail in tails:
                    yield frozenset((fixed - set(gone)) | tail)


LAYOUTS = (
    Layout("prompt_completion", (("user", "$.prompt"), ("assistant", "$.completion")), optional=("$.completion", "$.prompt")),
    Layout("prompt_response", (("system", "$.system"), ("user", "$.prompt"), ("assistant", "$.response")), optional=("$.system",)),
    Layout("question_answer", (("system", "$.context"), ("user", "$.question"), ("assistant", "$.answer")), optional=("$.context",)),
    Layout("instruction", (("user", "$.instruction", "$.input"), ("assistant", "$.output")), optional=("$.input", "$.output")),
    Layout("messages", (("system", "$.system"),), "$.messages", optional=("$.system",)),
    Layout("conversations", (("system", "$.system"),), "$.conversations", "from", "value", ("$.system",), True),
    Layout("nested_turns", (), "$.data.turns", "speaker", "utterance", renamed=True),
    Layout("system_line", (("system", "$.system"),)),
    Layout("one_message", (("$.message.role", "$.message.content"),)),
)


def leaf_paths(schema: str) -> frozenset[str]:
    """Paths of the leaves of a schema as schema_of_variant() writes it: $.a.b, and [] for what lies in an array."""
    tokens = re.findall(r"`(?:[^`]|``)*`|[A-Za-z_0-9]+|[<>,:()]", schema)
    at, found = 0, set()

    def value(path: str) -> None:
        nonlocal at
        kind = tokens[at]
        at += 1
        inside = at < len(tokens) and tokens[at] == "<"
        if kind == "OBJECT" and inside:
            at += 1
            while tokens[at] != ">":
                name = tokens[at]
                at += 2  # the name and its colon
                value(f"{path}.{name[1:-1].replace('``', '`') if name.startswith('`') else name}")
                at += tokens[at] == ","
            at += 1
        elif kind == "ARRAY" and inside:
            at += 1
            value(f"{path}[]")
            at += 1
        else:
            if at < len(tokens) and tokens[at] == "(":  # precision and scale
                at = tokens.index(")", at) + 1
            found.add(path)

    value("$")
    return frozenset(found)


def path_hash(paths: frozenset[str]) -> str:
    return hashlib.blake2b("\n".join(sorted(paths)).encode(), digest_size=8).hexdigest()


@cache
def layouts_by_hash(layouts: tuple[Layout, ...]) -> tuple[dict[str, int], frozenset[str]]:
    """Number of the layout by the hash of each of its shapes, the earlier one winning, and all paths that some layout knows."""
    by_hash: dict[str, int] = {}
    for k, layout in enumerate(layouts):
        for shape in layout.shapes():
            if shape:
                by_hash.setdefault(path_hash(shape), k)
    return by_hash, frozenset(p for layout in layouts for shape in layout.shapes() for p in shape)


def layout_number(schemas: Column, layouts: tuple[Layout, ...]) -> Column:
    """The number of the layout by a record's schema; null where none fits. Paths that no layout knows, such as metadata, are left out of the hash."""

    @F.pandas_udf("int")
    def number(schema: pd.Series) -> pd.Series:
        by_hash, known = layouts_by_hash(layouts)
        seen: dict[str | None, int | None] = {None: None}
        for s in schema.dropna().unique():
            seen[s] = by_hash.get(path_hash(leaf_paths(s) & known))
        return schema.map(lambda s: seen[s if isinstance(s, str) else None]).astype("Int32")

    return number(schemas)


def _role(role: Column, layout: Layout) -> Column:
    if layout.renamed:
        low = F.lower(role)
        names = F.create_map(*[F.lit(x) for pair in ROLES.items() for x in pair])
        role = F.coalesce(names[low], F.when(low.isin(*MARKS), low), role)
    return F.coalesce(role, F.lit(""))


def _turns(record: Column, layout: Layout) -> Column:
    """array<struct<role, text>> of a record of the layout."""
    get = lambda v, path, kind="string": F.try_variant_get(v, path, kind)
    none = F.array().cast("array<struct<role:string,text:string>>")
    keys = F.map_keys(get(record, "$", "map<string,variant>"))
    made = []
    for role, *paths in layout.parts:
        texts = F.array(*[get(record, p) for p in paths])
        text = F.array_join(F.filter(texts, lambda x: x != ""), "\n\n") if len(paths) > 1 else F.coalesce(texts[0], F.lit(""))
        turn = F.array(F.struct((_role(get(record, role), layout) if role.startswith("$.") else F.lit(role)).alias("role"), text.alias("text")))
        made.append(F.when(F.arrays_overlap(keys, F.array(*[F.lit(p[2:]) for p in paths])), turn).otherwise(none) if set(paths) <= set(layout.optional) else turn)
    if layout.each:
        one = lambda e: F.struct(_role(get(e, f"$.{layout.role}"), layout).alias("role"), F.coalesce(get(e, f"$.{layout.text}"), F.lit("")).alias("text"))
        made.append(F.coalesce(F.transform(get(record, layout.each, "array<variant>"), one), none))
    return F.concat(*made)


def canonical_turns(records: DataFrame, record: str = "record", layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """records with layout, its name, and turns, array<struct<role, text>>, in place of the JSON text.

    Roles stay as they are but in layouts that rename them (human: user, gpt: assistant); a null role is
    an empty one, a null text an empty text. Null, malformed and unknown records keep their row, with a null
    layout and null turns. Other columns stay; one row per input row, no shuffle.
    """
    parsed = records.withColumn("_v", F.try_parse_json(F.col(record))).withColumn("_k", layout_number(F.schema_of_variant("_v"), layouts))
    turns, name = F, F
    for k, layout in enumerate(layouts):
        turns = turns.when(F.col("_k") == k, _turns(F.col("_v"), layout))
        name = name.when(F.col("_k") == k, F.lit(layout.name))
    return parsed.withColumns({"layout": name, "turns": turns}).drop("_v", "_k", record)


def escaped(text: Column) -> Column:
    """The text with a backslash before each control string; backslashes just before one, or at the end, are doubled."""
    return F.regexp_replace(F.regexp_replace(text, rf"(\\+)(?={_any}|\z)", "$1$1"), f"({_any})", r"\\$1")


def unescaped(text: str) -> str:
    return re.sub(rf"(\\+)({_any}|\Z)", lambda m: m[1][: len(m[1]) // 2] + m[2], text)


def format_turns(turns: DataFrame, role: str = "role", text: str = "text") -> DataFrame:
    """turns with formatted, loss_start and loss_end in place of role and text: the text in the template and, of an assistant's,
    where the escaped text lies in it, in code points; equal bounds elsewhere. The turns of a conversation follow each other with
    nothing between. Null roles and texts count as empty. Each turn is written by itself, so a conversation of any length is spread over the tasks."""
    said = turns.withColumns({"_role": F.coalesce(F.col(role), F.lit("")), "_body": escaped(F.coalesce(F.col(text), F.lit("")))}).drop(role, text)
    opens, closes = F, F
    for name, (before, after) in MARKS.items():
        opens, closes = opens.when(F.col("_role") == name, F.lit(before)), closes.when(F.col("_role") == name, F.lit(after))
    opens, closes = opens.otherwise(F.concat(F.lit(OTHER[0]), escaped(F.col("_role")), F.lit(OTHER[1]))), closes.otherwise(F.lit(OTHER[2]))
    start = F.when(F.col("_role") == "assistant", len(MARKS["assistant"][0])).otherwise(0)
    length = F.when(F.col("_role") == "assistant", F.length("_body")).otherwise(0)
    return said.withColumns({"formatted": F.concat(opens, F.col("_body"), closes), "loss_start": start, "loss_end": start + length}).drop("_role", "_body")


_mark = re.compile(rf"(?<!\\)((?:\\\\)*)({_any})")


def read_back(shown: str) -> Iterator[tuple[str, str, int, int]]:
    """(role, text, start, end) of the turns of a formatted text, start and end being the bounds of the escaped text. A malformed text is an error."""
    opens = {a: (role, z) for role, (a, z) in MARKS.items()}
    marks = ((m[2], m.start(2), m.end(2)) for m in _mark.finditer(shown))
    at = 0
    for mark, start, end in marks:
        if start != at or mark not in {*opens, OTHER[0]}:
            raise ValueError(f"no turn begins at {at}")
        role, closes = opens.get(mark, ("", OTHER[2]))
        if mark == OTHER[0]:
            named, stop, begin = next(marks)
            if named != OTHER[1]:
                raise ValueError(f"no role ends at {stop}")
            role, end = unescaped(shown[end:stop]), begin
        closing, stop, at = next(marks)
        if closing != closes:
            raise ValueError(f"no turn ends at {stop}")
        yield role, unescaped(shown[end:stop]), end, stop
    if at != len(shown):
        raise ValueError(f"no turn begins at {at}")


def conversation_digest(pieces: DataFrame, conv: str, *order: str) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars) of each conversation of format_turns(),
    read back from the formatted texts and the mask alone.

    Rows are sorted within partitions by conversation and order, and digests run on over the rows, so a task
    holds one turn at a time however long a conversation is. A digest of a text is one chain, so a conversation is read by one task.
    """
    sorted_rows = pieces.select(F.col(conv).alias("conv_id"), *order, "formatted", "loss_start", "loss_end").repartition("conv_id").sortWithinPartitions("conv_id", *order).select("conv_id", "formatted", "loss_start", "loss_end")
    kind = sorted_rows.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, made, schema = None, None, [], None

        def done() -> None:
            made.append((now[0], held[0], held[1].hexdigest(), held[2], held[3].hexdigest(), held[4]))

        def rows() -> pa.RecordBatch:
            columns = list(zip(*made, strict=True))
            made.clear()
            kinds = (schema, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

        for b in parts(batches, 1024):
            schema = b.schema.field(0).type
            for conv_id, shown, start, end in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if now is None or now[0] != conv_id:
                    if now is not None:
                        done()
                    now, held = (conv_id,), [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, text, _, _ in read_back(shown):
                    held[0] += 1
                    held[1].update(f"{role}\n{text}\n".encode())
                if end > start:
                    loss = unescaped(shown[start:end])
                    held[2] += len(loss)
                    held[3].update(loss.encode())
                held[4] += len(shown)
            if len(made) > 4096:
                yield rows()
        if now is not None:
            done()
            yield rows()

    return sorted_rows.mapInArrow(run, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def turn_records(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, turn, record): each turn as a JSON record in the layout that stores of its kind use: what a user says as a
    prompt, an assistant as a completion, the system as a system line, any other role as a message. Null roles and texts become empty."""
    r, t = F.coalesce(F.col(role).cast("string"), F.lit("")), F.coalesce(F.col(text).cast("string"), F.lit(""))
    fields = {"user": "prompt", "assistant": "completion", "system": "system"}
    made = F
    for name, one in fields.items():
        made = made.when(r == name, F.to_json(F.struct(t.alias(one))))
    made = made.otherwise(F.to_json(F.struct(F.struct(r.alias("role"), t.alias("content")).alias("message"))))
    return rows.select(F.col(conv).alias("conv_id"), F.col(turn).alias("turn"), made.alias("record"))


def formatted_conversations(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, at, formatted, loss_start, loss_end) of records (conv_id, turn, record) with one or more turns each; at is the
    turn's place in its record. Records without a layout are an error: nothing is left out in silence."""
    turns = canonical_turns(rows)
    checked = turns.withColumn("turns", F.when(F.col("turns").isNull(), F.raise_error(F.lit("a record fits no layout"))).otherwise(F.col("turns")))
    # the outer form: Spark would otherwise test the arrays for rows below the join with Python, hence make them twice
    each = checked.select("conv_id", "turn", F.posexplode_outer("turns").alias("at", "t")).where("at IS NOT NULL").select("conv_id", "turn", "at", "t.role", "t.text")
    return format_turns(each)
