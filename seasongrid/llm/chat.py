"""Chat formatting: layouts recognised by a hash of their schema, one template out.

``LAYOUTS`` maps the fingerprint of a schema (a hash of those of its nested field
paths that bear roles or texts in any layout, whatever their order and whatever
other columns stand beside them) to declarative paths; from these, canonical turns ``(conv_id, turn, role, text)`` are made.
Every turn becomes one segment of its conversation's formatted text; control
strings inside texts are escaped, so reading back gives the same turns.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>\n"
#: Strings with a meaning in this or other templates, and what stands for them inside texts.
ESCAPES = (("%", "%25"), ("<|", "%3C|"), ("<s>", "%3Cs>"), ("</s>", "%3C/s>"), ("[INST]", "%5BINST]"), ("[/INST]", "%5B/INST]"))
NAMES = ("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")


@dataclass(frozen=True)
class Layout:
    """Where a layout has its turns.

    Either ``turns``, a path to an array of structs with ``role`` and ``text``
    fields, after a system turn from ``system`` where that path is given and not
    empty; or ``rows``, paths of turn, role and text of a table with a row for
    each turn; or ``fixed``, pairs of a role and the paths whose texts, joined by
    a blank line where not empty, are its turn; a turn of no text at all is left
    out unless its role is user or assistant.
    """

    turns: str | None = None
    role: str = "role"
    text: str = "content"
    rows: tuple[str, str, str] | None = None
    fixed: tuple[tuple[str, tuple[str, ...]], ...] = ()
    system: str | None = None

    def paths(self) -> list[str]:
        if self.turns:
            return [f"{self.turns}[].{self.role}", f"{self.turns}[].{self.text}", *([self.system] if self.system else [])]
        return list(self.rows) if self.rows else [p for _, paths in self.fixed for p in paths]

    def bearing(self) -> list[str]:
        """The paths that tell layouts apart; a row's turn and role say nothing without its text."""
        return [self.rows[2]] if self.rows else self.paths()


def fingerprint(paths: list[str]) -> str:
    return hashlib.sha256("\n".join(sorted(p.lower() for p in paths)).encode()).hexdigest()


KNOWN = (
    Layout(rows=("turn", "role", "text")),
    Layout(turns="messages"),
    Layout(turns="messages", system="system"),
    Layout(turns="conversations", role="from", text="value"),
    Layout(turns="conversations", role="from", text="value", system="system"),
    Layout(fixed=(("user", ("prompt",)), ("assistant", ("completion",)))),
    Layout(fixed=(("system", ("system",)), ("user", ("prompt",)), ("assistant", ("completion",)))),
    Layout(fixed=(("user", ("prompt",)), ("assistant", ("response",)))),
    Layout(fixed=(("system", ("system",)), ("user", ("prompt",)), ("assistant", ("response",)))),
    Layout(fixed=(("user", ("instruction",)), ("assistant", ("output",)))),
    Layout(fixed=(("system", ("system",)), ("user", ("instruction",)), ("assistant", ("output",)))),
    Layout(fixed=(("user", ("instruction", "input")), ("assistant", ("output",)))),
    Layout(fixed=(("system", ("system",)), ("user", ("instruction", "input")), ("assistant", ("output",)))),
)
LAYOUTS = {fingerprint(layout.bearing()): layout for layout in KNOWN}
#: Every path that bears roles or texts in some layout.
BEARING = {p.lower() for layout in KNOWN for p in layout.bearing()}
#: Other names of the three roles.
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


def leaf_paths(schema: T.StructType, before: str = "") -> list[str]:
    """Nested field paths of a schema; ``[]`` stands for the elements of an array."""
    out: list[str] = []
    for field in schema.fields:
        path, kind = before + field.name, field.dataType
        while isinstance(kind, T.ArrayType):
            path, kind = path + "[]", kind.elementType
        out += leaf_paths(kind, path + ".") if isinstance(kind, T.StructType) else [path]
    return out


def layout_of(schema: T.StructType) -> Layout:
    """The layout that has all of the schema's role-bearing paths; with none an error, so that no text is ignored.

    A table of rows, with turn, role and text, is one whatever else it has: its
    fingerprint is that of these three.
    """
    have = {p.lower() for p in leaf_paths(schema)}
    rows = KNOWN[0]
    if have.issuperset(p.lower() for p in rows.paths()):
        return LAYOUTS[fingerprint(rows.bearing())]
    layout = LAYOUTS.get(fingerprint([p for p in have if p in BEARING]))
    if layout is None or not have.issuperset(p.lower() for p in layout.paths()):
        raise ValueError(f"no layout has the paths {sorted(have)}")
    return layout


def canonical(rows: DataFrame, conv_id: str = "conv_id") -> DataFrame:
    """``(conv_id, turn, role, text)`` from any known layout.

    Null roles and texts become empty, role names of other layouts are
    translated there.  Columns beside the layout's are ignored: in a table of
    rows all others; in other layouts those that bear no text in any layout.
    An empty table gives no rows.
    """
    layout, of = layout_of(rows.schema), F.col(conv_id).cast("long").alias("conv_id")
    text = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    if layout.rows:
        turn, role, body = layout.rows
        return rows.select(of, F.col(turn).cast("long").alias("turn"), text(F.col(role)).alias("role"), text(F.col(body)).alias("text"))
    names = F.create_map(*[F.lit(x) for pair in ROLES.items() for x in pair])
    named = lambda c: F.coalesce(names[F.lower(text(c))], text(c))
    if layout.turns:
        turns = F.transform(layout.turns, lambda t: F.struct(named(t[layout.role]).alias("role"), text(t[layout.text]).alias("text")))
        if layout.system:
            first = F.array(F.struct(F.lit("system").alias("role"), text(F.col(layout.system)).alias("text")))
            turns = F.concat(F.filter(first, lambda t: t["text"] != ""), F.coalesce(turns, F.array().cast("array<struct<role: string, text: string>>")))
    else:
        parts = []
        for role, paths in layout.fixed:
            body = F.array_join(F.filter(F.array(*[text(F.col(p)) for p in paths]), lambda x: x != ""), "\n\n")
            parts.append(F.struct(F.lit(role).alias("role"), body.alias("text")))
        turns = F.filter(F.array(*parts), lambda t: (t["text"] != "") | t["role"].isin("user", "assistant"))
    return rows.select(of, F.posexplode(turns).alias("turn", "t")).select("conv_id", F.col("turn").cast("long").alias("turn"), "t.role", "t.text")


def escaped(text: Column) -> Column:
    for plain, code in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescape(text: str) -> str:
    return text.replace("%3C", "<").replace("%5B", "[").replace("%25", "%")


def segments(turns: DataFrame) -> DataFrame:
    """One segment for each turn; ``loss_start`` and ``loss_length`` (code points) mark what is learned.

    A conversation's formatted text is its segments in the order of turn, then
    by themselves.  The loss covers the texts of assistant turns, nothing else.
    """
    body = escaped(F.col("text"))
    head = F.concat(F.lit(TURN), escaped(F.col("role")), F.lit(TEXT))
    learned = F.col("role") == "assistant"
    return turns.select(
        "conv_id", "turn",
        F.concat(head, body, F.lit(END)).alias("formatted"),
        F.when(learned, F.length(head)).otherwise(F.lit(0)).alias("loss_start"),
        F.when(learned, F.length(body)).otherwise(F.lit(0)).alias("loss_length"),
    )


def write(turns: DataFrame, path: str) -> None:
    """Write the segments as Parquet, conversations apart and in order within each file."""
    rows = segments(turns.select("conv_id", "turn", "role", "text"))
    rows.repartitionByRange("conv_id", "turn").sortWithinPartitions("conv_id", "turn", "formatted").write.parquet(path)


def digests(formatted: DataFrame) -> DataFrame:
    """One row for each conversation, read back from its segments.

    ``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars``.
    Segments stream through sorted tasks; of a conversation only running digests
    are held, so it may have any number of turns.  A null id is one conversation.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, state, out = None, None, []

        def close() -> None:
            out.append((of, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]))

        def table() -> pa.RecordBatch:
            columns = zip(*out, strict=True)
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            done = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], list(NAMES))
            out.clear()
            return done

        for batch in batches:
            columns = [batch[c].to_pylist() for c in ("conv_id", "formatted", "loss_start", "loss_length")]
            for conv, text, start, length in zip(*columns, strict=True):
                if state is None or conv != of:
                    if state:
                        close()
                    of, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                role, _, body = text.removeprefix(TURN).partition(TEXT)
                state[0] += 1
                state[1].update(f"{unescape(role)}\n{unescape(body.removesuffix(END))}\n".encode("utf-8", "surrogatepass"))
                learned = unescape(text[start : start + length])
                state[2] += len(learned)
                state[3].update(learned.encode("utf-8", "surrogatepass"))
                state[4] += len(text)
            if len(out) >= 10_000:
                yield table()
        if state:
            close()
        if out:
            yield table()

    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    rows = formatted.select("conv_id", "turn", "formatted", "loss_start", "loss_length").repartition("conv_id")
    return rows.sortWithinPartitions("conv_id", "turn", "formatted").mapInArrow(read, schema)
