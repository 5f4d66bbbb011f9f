"""Chat formatting: records of many layouts to turns, turns to one template with a loss mask, and back.

A record's layout is known by its fingerprint, a hash of the paths of its nested fields. The fingerprint
selects a declarative mapping, which says where turns, roles and texts are. The template marks turns by
control strings; a control string inside a text gets a backslash before it (and before the backslashes it
may have), which reading back takes away again.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from canopy.llm.batches import add_columns, bound_batches, texts


@dataclass(frozen=True)
class Layout:
    """Where a record's turns are.

    ``turns`` lists (role, path) pairs: a text at a path, or for ``each`` a list field, (role path, text
    path) within its items. Paths in ``optional`` may be absent; a missing text is skipped, but is empty if
    it is the only one. ``roles`` renames roles.
    """
    name: str
    paths: tuple[str, ...]
    turns: tuple[tuple[str, str], ...]
    optional: tuple[str, ...] = ()
    each: str | None = None
    roles: tuple[tuple[str, str], ...] = ()

    def fingerprints(self) -> Iterator[str]:
        for n in range(len(self.optional) + 1):
            for some in itertools.combinations(self.optional, n):
                yield fingerprint({*self.paths, *some})


def fingerprint(paths: set[str]) -> str:
    return f"{xxhash.xxh64_intdigest(chr(10).join(sorted(paths))):016x}"


def paths_of(value, at: str = "") -> set[str]:
    """Paths of the leaves; a list adds [] to its path, whatever its length. Null fields have no path."""
    if value is None:
        return set()
    if isinstance(value, dict):
        return set().union(*[paths_of(v, f"{at}.{k}" if at else k) for k, v in value.items()])
    if isinstance(value, list):
        return set().union({f"{at}[]"} if not value else set(), *[paths_of(v, f"{at}[]") for v in value])
    return {at}


# Layouts in common use. ROW is a table with one turn a row.
ROW = Layout("turn row", (), (("role", "text"),), optional=("role", "text"), each="")
LAYOUTS = (
    ROW,
    Layout("messages", ("messages[].role",), (("role", "content"),), optional=("messages[].content",), each="messages"),
    Layout("from value", ("conversations[].from",), (("from", "value"),), optional=("conversations[].value",),
           each="conversations", roles=(("human", "user"), ("gpt", "assistant"))),
    Layout("instruction", ("instruction",), (("user", "instruction"), ("user", "input"), ("assistant", "output")),
           optional=("input", "output")),
    Layout("prompt response", ("prompt",), (("system", "system"), ("user", "prompt"), ("assistant", "response")),
           optional=("system", "response")),
    Layout("prompt completion", ("prompt", "completion"), (("user", "prompt"), ("assistant", "completion"))),
    Layout("question answer", ("question", "answer"), (("user", "question"), ("assistant", "answer"))),
)


def as_text(value) -> str:
    return "" if value is None else value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)


def apply(layout: Layout, record) -> list[tuple[str, str]]:
    renamed = dict(layout.roles)
    if layout.each is not None:
        items = record.get(layout.each) or [] if layout.each else [record]
        (role, text), = layout.turns
        return [(renamed.get(r := as_text(i.get(role)), r), as_text(i.get(text))) for i in items]
    return [(role, as_text(record.get(path))) for role, path in layout.turns if record.get(path) is not None]


def turns(df: DataFrame, record: str, layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """Append ``layout`` (fingerprint), ``layout_name`` and ``turns`` (role, text) of records in JSON.

    A record that no layout knows keeps its row: its name and turns are null, its fingerprint says what to
    add. What is not JSON, or no object, has a null fingerprint too. A null record is handled as such. Null
    roles and texts are empty. Other columns stay; same-named ones are replaced.
    """
    known = {f: layout for layout in layouts for f in layout.fingerprints()}

    def read(value):
        try:
            got = json.loads(value) if value is not None else None
        except ValueError:
            got = None
        if not isinstance(got, dict):
            return None, None, None
        mark = fingerprint(paths_of(got))
        layout = known.get(mark)
        if layout is None:
            return mark, None, None
        return mark, layout.name, [{"role": r, "text": t} for r, t in apply(layout, got)]

    def start():
        return lambda batch: list(zip(*map(read, texts(batch, record)))) or [[], [], []]

    return add_columns(df, "layout string, layout_name string, turns array<struct<role: string, text: string>>", start)


# The template: what stands before and after a turn's text, by role. Any other role is written out.
MARKS = {"user": ("[INST] ", " [/INST]\n"), "assistant": ("<s> ", " </s>\n"), "system": ("[SYS] ", " [/SYS]\n")}
OTHER = ("[ROLE] ", " [/ROLE][MSG] ", " [/MSG]\n")
LEARNED = "assistant"      # the role under the loss mask
CONTROL = r"(?:</?s>|\[/?(?:INST|SYS|ROLE|MSG)\])"

ESCAPED = re.compile(rf"\\(\\*{CONTROL})")
TURN = re.compile(
    rf"(?<!\\)(?:\[INST\] (?P<user>.*?) (?<!\\)\[/INST\]|<s> (?P<assistant>.*?) (?<!\\)</s>|\[SYS\] (?P<system>.*?) (?<!\\)\[/SYS\]"
    rf"|\[ROLE\] (?P<role>.*?) (?<!\\)\[/ROLE\]\[MSG\] (?P<text>.*?) (?<!\\)\[/MSG\])\n", re.DOTALL)


def escape(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(rf"(\\*{CONTROL})"), F.lit(r"\\$1"))


def unescape(text: str) -> str:
    return ESCAPED.sub(r"\1", text)


def formatted(df: DataFrame, role: str = "role", text: str = "text") -> DataFrame:
    """Append a turn's part of the output: ``formatted``, and the code points of it under the loss mask,
    ``loss_start`` (0-based, null: none) and ``loss_length``. A conversation's output is its turns' parts in
    order; no step needs a whole conversation. Null roles and texts are empty."""
    said, kind = escape(F.coalesce(text, F.lit(""))), F.coalesce(role, F.lit(""))
    made = F.concat(F.lit(OTHER[0]), escape(kind), F.lit(OTHER[1]), said, F.lit(OTHER[2]))
    for name, (before, after) in MARKS.items():
        made = F.when(kind == name, F.concat(F.lit(before), said, F.lit(after))).otherwise(made)
    learned = kind == LEARNED
    before, after = MARKS[LEARNED]
    return df.withColumn("formatted", made).withColumns({
        "loss_start": F.when(learned, F.lit(len(before))),
        "loss_length": F.when(learned, F.length("formatted") - len(before) - len(after)).otherwise(F.lit(0))})


def parse(output: str) -> list[tuple[str, str]]:
    """Turns of an output, or of any stretch of whole turns; anything else in it is an error."""
    found, at = [], 0
    while at < len(output):
        m = TURN.match(output, at)
        if m is None:
            raise ValueError("no turn begins here")
        role = m.lastgroup
        found.append((unescape(m["role"]), unescape(m["text"])) if role == "text" else (role, unescape(m[role])))
        at = m.end()
    return found


def digests(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Read the output back: one row per conversation with its turns and learned text as digests.

    Conversations are dealt out by key and sorted within partitions; a task reads turns one by one and holds
    only the state of its digests, so a conversation may be of any length. Rows with a null key are one
    conversation. Turns of equal order follow each other by output.
    """
    bound_batches(df.sparkSession)
    kind = dict(df.dtypes)[key]
    rows = df.select(F.col(key).alias("key"), *[F.col(c).alias(f"o{i}") for i, c in enumerate(order)],
                     "formatted", "loss_start", "loss_length")
    rows = rows.repartition("key").sortWithinPartitions("key", *[f"o{i}" for i in range(len(order))], "formatted")
    names = ["key", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state = None, None
        for batch in batches:
            done = []
            for k, out, a, n in zip(*[batch.column(c).to_pylist() for c in ("key", "formatted", "loss_start", "loss_length")]):
                if state is None or k != current:
                    if state is not None:
                        done.append((current, *state.row()))
                    current, state = k, Conversation()
                state.add(out, a, n)
            if done:
                yield to_batch(done)
        if state is not None:
            yield to_batch([(current, *state.row())])

    def to_batch(done: list[tuple]) -> pa.RecordBatch:
        ids, *columns = zip(*done)
        types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        key_type = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind]
        return pa.RecordBatch.from_arrays([pa.array(ids, key_type), *map(pa.array, columns, types)], names=names)

    return rows.select("key", "formatted", "loss_start", "loss_length").mapInArrow(
        run, f"key {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
    ).withColumnRenamed("key", key)


class Conversation:
    def __init__(self):
        self.turns, self.loss, self.n, self.loss_chars, self.chars = hashlib.sha256(), hashlib.sha256(), 0, 0, 0

    def add(self, output: str, start: int | None, length: int) -> None:
        for role, text in parse(output):
            self.turns.update(f"{role}\n{text}\n".encode())
            self.n += 1
        if start is not None:
            learned = unescape(output[start:start + length])
            self.loss.update(learned.encode())
            self.loss_chars += len(learned)
        self.chars += len(output)

    def row(self) -> tuple:
        return self.n, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars
