"""Chat formatting: conversations rendered by a compiled template, and read back.

Rows of a conversation pass through one task in the order of their turns as a stream: a
chunk of formatted text is given out after a message as soon as it reaches ``CHUNK``
characters, so a conversation of any length needs the memory of one chunk and one message.
A digest over all turns is a chain and cannot be cut; rendering, storing and reading back
hold no conversation whole. Every chunk carries its loss mask: ranges of code points under
``{% generation %}``.

``CHATML`` escapes control strings inside roles and texts reversibly, so a text that
imitates a turn mark is read back as that text.

Null roles and texts are empty, a null conversation id is a conversation of its own, rows
without a turn come first, and rows that share a turn (repeated rows too) are ordered by
role and text. An empty table gives no rows, other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame

from weekloom.llm.common import pick
from weekloom.llm.template import compile_template, unescape, unescape_line
from weekloom.sources.staging import stage

CHATML = (
    "{% for m in messages %}"
    "{{ '<|im_start|>' + (m.role | escape_line) + '\\n' }}"
    "{% if m.role == 'assistant' %}"
    "{% generation %}{{ m.text | escape }}{% endgeneration %}"
    "{% else %}{{ m.text | escape }}{% endif %}"
    "{{ '<|im_end|>' + '\\n' }}"
    "{% endfor %}"
)
_TURN = re.compile(r"<\|im_start\|>(.*?)\n(.*?)<\|im_end\|>\n", re.S)
CHUNK = 1 << 16
ROWS = 256

FORMATTED = "conv_id long, part long, text string, mask array<array<int>>"


def grouped_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(first column, rows of the same value that follow each other)."""
    rows = (
        row for b in batches for row in zip(*(c.to_pylist() for c in b.columns), strict=True)
    )
    return groupby(rows, key=lambda r: r[0])


def record_batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == ROWS:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in held], schema)
            held = []
    yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in held], schema)


class Chunk:
    """Formatted text that waits to be given out, with its mask."""

    def __init__(self) -> None:
        self.parts, self.mask, self.size = [], [], 0

    def emit(self, text: str, on: bool) -> None:
        if not text:
            return
        if on:
            if self.mask and self.mask[-1][1] == self.size:
                self.mask[-1][1] += len(text)
            else:
                self.mask.append([self.size, self.size + len(text)])
        self.parts.append(text)
        self.size += len(text)


def format_conversations(conversations: DataFrame, template: str = CHATML) -> DataFrame:
    """(conv_id, part, text, mask): the formatted conversations in chunks."""
    schema = pa.schema(
        [("conv_id", pa.int64()), ("part", pa.int64()), ("text", pa.string()),
         ("mask", pa.list_(pa.list_(pa.int32())))]
    )
    compile_template(template)  # a bad template fails here, not in a task

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        render = compile_template(template)
        for conv, rows in grouped_rows(batches):
            chunk, part = Chunk(), 0
            messages = ({"role": r[1] or "", "text": r[2] or ""} for r in rows)
            for _ in render(messages, lambda t, on: chunk.emit(t, on)):  # noqa: B023
                if chunk.size >= CHUNK:
                    yield conv, part, "".join(chunk.parts), chunk.mask
                    chunk, part = Chunk(), part + 1
            if chunk.size or not part:
                yield conv, part, "".join(chunk.parts), chunk.mask

    rows = pick(conversations, "conv_id", "turn", "role", "text").selectExpr(
        "cast(conv_id as long) conv_id", "turn", "role", "text"
    )
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.select("conv_id", "role", "text").mapInArrow(
        lambda batches: record_batches(chunks(batches), schema), FORMATTED
    )


def read_turns(parts: Iterator[str]) -> Iterator[tuple[str, str]]:
    """(role, text) of formatted text that arrives in pieces."""
    rest = ""
    for part in parts:
        rest, at = rest + part, 0
        for m in _TURN.finditer(rest):
            if m.start() != at:
                raise ValueError("text between turns")
            yield unescape_line(m[1]), unescape(m[2])
            at = m.end()
        rest = rest[at:]
    if rest:
        raise ValueError("unfinished turn")


def digests(formatted: DataFrame) -> DataFrame:
    """One row per conversation of ``format_conversations``, read back from its text."""
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    schema = pa.schema(list(zip(names, kinds, strict=True)))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for conv, rows in grouped_rows(batches):
            turns, loss = hashlib.sha256(), hashlib.sha256()
            n = masked = chars = 0

            def parts(rows: Iterator[tuple] = rows, loss: object = loss) -> Iterator[str]:
                nonlocal masked, chars
                for _, text, mask in rows:
                    for start, stop in mask:
                        own = unescape(text[start:stop])
                        masked += len(own)
                        loss.update(own.encode())
                    chars += len(text)
                    yield text

            for role, text in read_turns(parts()):
                n += 1
                turns.update(f"{role}\n{text}\n".encode())
            yield conv, n, turns.hexdigest(), masked, loss.hexdigest(), chars

    rows = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "part")
    return rows.select("conv_id", "text", "mask").mapInArrow(
        lambda batches: record_batches(read(batches), schema),
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
        "formatted_chars long",
    )


def formatted_digests(conversations: DataFrame, template: str = CHATML) -> DataFrame:
    """Format, store, read back."""
    return digests(stage(format_conversations(conversations, template), "chat"))
