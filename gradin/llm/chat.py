"""Chats of many layouts as turns, formatted by one template and read back.

A layout is recognised by its fingerprint: a hash of the sorted paths of all nested fields. Each
known fingerprint selects a declared mapping, an expression that gives canonical turns: an array
of role and text. JSON lines have a fingerprint each, so one file may mix layouts.

The template wraps a turn as <|turn|>ROLE<|text|>TEXT<|end|>. A control string inside a role or a
text gets a backslash behind its first character; if it has some there already, it gets one
more. So no text can open or close a turn, and taking one away restores it.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TURNS = "array<struct<role: string, text: string>>"
TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
#: Control strings of this template and of common ones.
CONTROL = (
    TURN, TEXT, END, "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>",
    "<|endoftext|>",
)


def field_paths(kind: T.DataType, at: str = "") -> list[str]:
    if isinstance(kind, T.StructType):
        return [p for f in kind.fields for p in field_paths(f.dataType, f"{at}.{f.name}".lstrip("."))]
    if isinstance(kind, T.ArrayType):
        return field_paths(kind.elementType, at + "[]")
    return [at]


def fingerprint(paths: Sequence[str]) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()[:16]


@dataclass(frozen=True)
class Layout:
    """Paths of the fields that carry a chat, and the turns that they give.

    `turns` takes a function from a path's first part to a column. `rows` is set for layouts
    with a row per turn: the columns of the chat and of the turn's number.
    """

    name: str
    paths: tuple[str, ...]
    turns: Callable[[Callable[[str], Column]], Column] | None = None
    rows: tuple[str, str] | None = None

    @property
    def print(self) -> str:
        return fingerprint(self.paths)


def _fixed(*turns: tuple[str, Column]) -> Column:
    return F.array(*[F.struct(F.lit(r).alias("role"), t.cast("string").alias("text")) for r, t in turns])


def _listed(array: Column, role: str, text: str) -> Column:
    return F.transform(array, lambda m: F.struct(m[role].cast("string").alias("role"), m[text].cast("string").alias("text")))


#: Names of speakers in some layouts, and the roles that they stand for; fixed values.
SPEAKERS = {"human": "user", "gpt": "assistant", "bot": "assistant", "prompter": "user"}


def _with_input(of: Callable[[str], Column]) -> Column:
    both = F.when(F.coalesce(of("input"), F.lit("")) != "", F.concat_ws("\n\n", of("instruction"), of("input")))
    return both.otherwise(of("instruction"))


LAYOUTS = (
    Layout("turn rows", ("conv_id", "turn", "role", "text"), rows=("conv_id", "turn")),
    Layout("messages", ("messages[].role", "messages[].content"), lambda of: _listed(of("messages"), "role", "content")),
    Layout("conversations", ("conversations[].from", "conversations[].value"), lambda of: _listed(of("conversations"), "from", "value")),
    Layout("prompt", ("prompt", "completion"), lambda of: _fixed(("user", of("prompt")), ("assistant", of("completion")))),
    Layout("prompt response", ("prompt", "response"), lambda of: _fixed(("user", of("prompt")), ("assistant", of("response")))),
    Layout(
        "system prompt", ("system", "prompt", "response"),
        lambda of: _fixed(("system", of("system")), ("user", of("prompt")), ("assistant", of("response"))),
    ),
    Layout("question", ("question", "answer"), lambda of: _fixed(("user", of("question")), ("assistant", of("answer")))),
    Layout("instruction", ("instruction", "output"), lambda of: _fixed(("user", of("instruction")), ("assistant", of("output")))),
    Layout(
        "instruction input", ("instruction", "input", "output"),
        lambda of: _fixed(("user", _with_input(of)), ("assistant", of("output"))),
    ),
)


def _canonical(turns: Column) -> Column:
    role = lambda t: F.coalesce(t["role"], F.lit(""))

    def named(t: Column) -> Column:
        out = role(t)
        for name, means in SPEAKERS.items():
            out = F.when(role(t) == name, F.lit(means)).otherwise(out)
        return F.struct(out.alias("role"), F.coalesce(t["text"], F.lit("")).alias("text"))

    return F.coalesce(F.transform(F.filter(turns, lambda t: t.isNotNull()), named), F.array().cast(TURNS))


def layout_of(chats: DataFrame, id_column: str, layouts: Sequence[Layout] = LAYOUTS) -> Layout:
    """The layout that the fingerprint of the table's nested fields selects."""
    paths = field_paths(chats.schema)
    by_rows = next((x for x in layouts if x.rows and set(x.paths) <= set(paths)), None)
    known = {x.print: x for x in layouts}
    own = [p for p in paths if p.split(".")[0].removesuffix("[]") != id_column]
    layout = known.get(fingerprint(own)) or known.get(fingerprint(paths)) or by_rows
    if layout is None:
        raise ValueError(f"no layout has the fields {sorted(own)}")
    return layout


def canonical_turns(chats: DataFrame, id_column: str, layouts: Sequence[Layout] = LAYOUTS) -> DataFrame:
    """(chat_id, turns) of a table in a known layout; `id_column` names the chat's id.

    The layout is found by the fingerprint of the table's nested fields without the id column;
    fields that no layout knows fail with the paths. Where extra columns stand beside a layout
    with a row per turn, the fingerprint of its own four columns decides. Null roles and texts
    are empty; known names of speakers become user or assistant. Turns with rows of their own
    are ordered by number, then role, then text, nulls first; all rows of a chat become one
    value, as its format does.
    """
    layout = layout_of(chats, id_column, layouts)
    if layout.rows:
        _, number = layout.rows
        row = F.struct(F.col(number).alias("n"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
        grouped = chats.groupBy(F.col(id_column).alias("chat_id")).agg(F.sort_array(F.collect_list(row)).alias("turns"))
        return grouped.select("chat_id", _canonical(F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))).alias("turns"))
    turns = layout.turns(lambda name: F.col(f"`{name}`"))
    return chats.select(F.col(id_column).alias("chat_id"), _canonical(turns).alias("turns"))


#: Scalar types in the text of a variant's schema; they do not belong to a layout.
_SCALARS = r": (VOID|STRING|BIGINT|DOUBLE|BOOLEAN|DECIMAL\([0-9,]+\)|DATE|TIMESTAMP|TIMESTAMP_NTZ)"


def canonical_json(lines: DataFrame, json: str = "value", layouts: Sequence[Layout] = LAYOUTS) -> DataFrame:
    """(value, layout, turns) of JSON lines, each in a layout of its own.

    A line's fingerprint is a hash of its schema without scalar types; a line in no known layout,
    a malformed or a null one has null in `layout` and no turns.
    """
    paths = {x.name: x for x in layouts if not x.rows}
    value = F.try_parse_json(F.col(json))
    schema = F.regexp_replace(F.schema_of_variant(value), _SCALARS, "")
    rows = lines.select(F.col(json).alias("value"), value.alias("v"), F.xxhash64(schema).alias("print"))

    def printed(layout: Layout) -> Column:
        """The fingerprint that a line of this layout has."""
        tops: dict[str, list[str]] = {}
        for path in layout.paths:
            top, _, inner = path.partition("[].")
            tops.setdefault(top, []).extend([inner] if inner else [])
        parts = [f"{t}: ARRAY<OBJECT<{', '.join(sorted(i))}>>" if i else t for t, i in sorted(tops.items())]
        return F.xxhash64(F.lit(f"OBJECT<{', '.join(parts)}>"))

    def reader(layout: Layout) -> Callable[[str], Column]:
        def of(name: str) -> Column:
            inner = [p.partition("[].")[2] for p in layout.paths if p.startswith(f"{name}[].")]
            kind = f"array<struct<{', '.join(f'`{i}`: string' for i in inner)}>>" if inner else "string"
            return F.try_variant_get("v", f"$.{name}", kind)

        return of

    layout, turns = F.lit(None).cast("string"), F.lit(None).cast(TURNS)
    for name, x in paths.items():
        layout = F.when(F.col("print") == printed(x), F.lit(name)).otherwise(layout)
        turns = F.when(F.col("print") == printed(x), x.turns(reader(x)).cast(TURNS)).otherwise(turns)
    return rows.select("value", layout.alias("layout"), _canonical(turns).alias("turns"))


_PLACES = re.compile("|".join(rf"({re.escape(c[0])})(\\*)(?={re.escape(c[1:])})" for c in CONTROL))


def escaped(text: str) -> str:
    return _PLACES.sub(lambda m: m[0] + "\\", text) if "<" in text or "[" in text else text


def unescaped(text: str) -> str:
    return _PLACES.sub(lambda m: m[0].removesuffix("\\"), text) if "\\" in text else text


def formatted(turns: list[tuple[str, str]], learned: frozenset[str]) -> tuple[str, list[tuple[int, int]]]:
    """The text of a chat, and the spans of it that a model learns: the texts of those roles."""
    out, spans, at = [], [], 0
    for role, text in turns:
        head = TURN + escaped(role) + TEXT
        body = escaped(text)
        if role in learned:
            spans.append((at + len(head), at + len(head) + len(body)))
        out += [head, body, END]
        at += len(head) + len(body) + len(END)
    return "".join(out), spans


def parsed(text: str) -> list[tuple[str, str]]:
    """The turns of a formatted chat."""
    out = []
    for turn in text.split(TURN)[1:]:
        role, _, body = turn.partition(TEXT)
        out.append((unescaped(role), unescaped(body.removesuffix(END))))
    return out


FORMATTED = "formatted string, loss array<struct<begin: bigint, end: bigint>>"


def format_chats(chats: DataFrame, learned: Sequence[str] = ("assistant",)) -> DataFrame:
    """(chat_id, formatted, loss) of (chat_id, turns): the text, and the spans under the loss mask in
    code points, end exclusive. A chat without turns is an empty text."""
    roles = frozenset(learned)
    rows = chats.select("chat_id", "turns")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            texts, spans = [], []
            for turns in batch.column("turns").to_pylist():
                text, own = formatted([(t["role"], t["text"]) for t in turns or []], roles)
                texts.append(text)
                spans.append([{"begin": a, "end": b} for a, b in own])
            yield pa.RecordBatch.from_arrays(
                [batch.column("chat_id"), pa.array(texts, pa.string()), pa.array(spans, span)], ["chat_id", "formatted", "loss"]
            )

    kind = rows.schema["chat_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"chat_id {kind}, {FORMATTED}")


def read_chats(chats: DataFrame) -> DataFrame:
    """(chat_id, turns, loss_text) read back from (chat_id, formatted, loss): the loss text is what the
    spans cover, unescaped, one behind the other."""
    rows = chats.select("chat_id", "formatted", "loss")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
        for batch in batches:
            turns, losses = [], []
            for text, spans in zip(batch.column("formatted").to_pylist(), batch.column("loss").to_pylist(), strict=True):
                turns.append([{"role": r, "text": t} for r, t in parsed(text or "")])
                losses.append("".join(unescaped(text[s["begin"] : s["end"]]) for s in spans or []))
            yield pa.RecordBatch.from_arrays(
                [batch.column("chat_id"), pa.array(turns, turn), pa.array(losses, pa.string())], ["chat_id", "turns", "loss_text"]
            )

    kind = rows.schema["chat_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"chat_id {kind}, turns {TURNS}, loss_text string")


# ---- chats turn by turn ------------------------------------------------------------------

#: Columns of a turn: its chat, its place by number, role and text as they were, and what they mean.
_TURN_ROW = ("chat_id", "n", "named", "role", "text")


def _turn_rows(chat_id: Column, turns: DataFrame) -> DataFrame:
    rows = turns.select(chat_id.alias("chat_id"), F.posexplode_outer("turns").alias("n", "turn"))
    return rows.select(
        "chat_id", F.col("n").cast("bigint").alias("n"), F.col("turn.role").alias("named"), "turn.role", "turn.text"
    )


def turn_rows(chats: DataFrame, id_column: str, layouts: Sequence[Layout] = LAYOUTS) -> DataFrame:
    """(chat_id, n, named, role, text): a row per turn of a table in any known layout, as
    `canonical_turns` gives them, but a chat is not gathered into one value.

    `n` orders the turns, then `named`, the role as it was, then the text. A chat without turns
    has one row without a role.
    """
    layout = layout_of(chats, id_column, layouts)
    if not layout.rows:
        return _turn_rows(F.col("chat_id"), canonical_turns(chats, id_column, layouts))
    role, text = F.col("role").cast("string"), F.col("text").cast("string")
    turn = _canonical(F.array(F.struct(role.alias("role"), text.alias("text"))))[0]
    rows = chats.select(
        F.col(id_column).alias("chat_id"), F.col(layout.rows[1]).cast("bigint").alias("n"), role.alias("named"), turn.alias("t")
    )
    return rows.select("chat_id", "n", "named", "t.role", "t.text")


def json_turn_rows(lines: DataFrame, id_column: str, json: str, layouts: Sequence[Layout] = LAYOUTS) -> DataFrame:
    """The same of JSON lines, each in a layout of its own, beside an id; a line in no layout has no turns."""
    read = canonical_json(lines.select(F.col(json)).distinct(), json, layouts)
    ids = lines.select(F.col(id_column).alias("chat_id"), F.col(json).alias("_json"))
    return _turn_rows(F.col("chat_id"), ids.join(read, F.col("_json").eqNullSafe(F.col("value")), "left"))


FORMATTED_TURN = "n bigint, at bigint, formatted string, loss_begin bigint, loss_end bigint"


def format_turns(rows: DataFrame, learned: Sequence[str] = ("assistant",)) -> DataFrame:
    """(chat_id, n, at, formatted, loss_begin, loss_end): the template's text of each turn, in order.

    `rows` is what `turn_rows` gives. `n` numbers the turns of a chat from 0 and `at` is where the turn's text
    begins in the chat's, in code points; the text of a learned role is under the loss mask from
    `loss_begin` to `loss_end`, in the same count. The texts of a chat one behind the other are its
    format, as `format_chats` gives it. A chat's turns meet in one task, which sorts them (and
    spills) and holds a batch of them at a time, so a chat may hold any share of all rows.
    """
    roles = frozenset(learned)
    order = [F.col(c).asc_nulls_first() for c in ("chat_id", "n", "named", "text")]
    rows = rows.select(*_TURN_ROW).repartition("chat_id").sortWithinPartitions(*order)
    kind = rows.schema["chat_id"].dataType.simpleString()
    names = ["chat_id", "n", "at", "formatted", "loss_begin", "loss_end"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chat, n, at = _NO_CHAT, 0, 0
        for batch in batches:
            out: list[list] = [[] for _ in names[1:]]
            ids = batch.column("chat_id").to_pylist()
            for own, role, text in zip(ids, batch.column("role").to_pylist(), batch.column("text").to_pylist(), strict=True):
                if own != chat:
                    chat, n, at = own, 0, 0
                if role is None:
                    row = None, at, "", None, None
                else:
                    text, spans = formatted([(role, text)], roles)
                    begin, end = spans[0] if spans else (None, None)
                    row = n, at, text, None if begin is None else at + begin, None if end is None else at + end
                    n, at = n + 1, at + len(text)
                for column, value in zip(out, row, strict=True):
                    column.append(value)
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("chat_id"), *[pa.array(c, k) for c, k in zip(out, kinds, strict=True)]], names
            )

    return rows.mapInArrow(run, f"chat_id {kind}, {FORMATTED_TURN}")


_NO_CHAT = object()

DIGESTS = (
    "n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
)


class _Digest:
    """What is known of a chat while its turns pass."""

    def __init__(self) -> None:
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n = self.loss_chars = self.chars = 0

    def add(self, at: int, text: str, begin: int | None, end: int | None) -> None:
        for role, body in parsed(text):
            self.turns.update(f"{role}\n{body}\n".encode())
            self.n += 1
        if begin is not None:
            learned = unescaped(text[begin - at : end - at])
            self.loss.update(learned.encode())
            self.loss_chars += len(learned)
        self.chars += len(text)

    def row(self) -> tuple:
        return self.n, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


def digest_turns(turns: DataFrame) -> DataFrame:
    """(chat_id, and the columns of DIGESTS): what is read back from each chat's formatted turns.

    `turns` is what `format_turns` gives, as it lies there: a chat's turns in one task and in order.
    They are read back and hashed one by one; nothing of a chat is kept but the state of the hashes.
    """
    kind = turns.schema["chat_id"].dataType.simpleString()
    names = ["chat_id", *[c.split()[0] for c in DIGESTS.split(", ")]]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chat, state, id_type = _NO_CHAT, _Digest(), None

        def batch_of(done: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*done, strict=True))
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, [id_type, *kinds], strict=True)], names)

        for batch in batches:
            id_type, done = batch.column("chat_id").type, []
            for own, at, text, begin, end in zip(
                *[batch.column(c).to_pylist() for c in ("chat_id", "at", "formatted", "loss_begin", "loss_end")], strict=True
            ):
                if own != chat:
                    if chat is not _NO_CHAT:
                        done.append((chat, *state.row()))
                    chat, state = own, _Digest()
                state.add(at, text, begin, end)
            if done:
                yield batch_of(done)
        if chat is not _NO_CHAT:
            yield batch_of([(chat, *state.row())])

    return turns.mapInArrow(run, f"chat_id {kind}, {DIGESTS}")
