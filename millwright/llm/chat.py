"""Chat formatting by a finite-state machine over roles.

A template names the roles, what may follow what, the text around a turn, and which turns bear loss.
Turns are read in order; the machine's state is the role of the turn before. Every turn gives three
segments (head, content, tail), each with its own loss flag. A turn that the machine does not
allow is formatted like any other, and the conversation is marked invalid, so nothing is lost.

Control strings of the template inside a text lose their first character to a backslash and the control's
number, and backslashes are doubled, so :func:`read_back` restores every text exactly and no text
can open or close a turn.

Rows: a null text counts as empty. A null or unknown role is written with an extra mark and is not
allowed by the machine. Turns are ordered by turn, then role and text (nulls first); repeated rows are
turns of their own. A null conversation id is a conversation. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START = "<start>"


@dataclass(frozen=True)
class Template:
    """Declaration of a chat format."""

    heads: dict[str, str] = field(default_factory=lambda: {"system": "### System: ", "user": "### User: ", "assistant": "### Assistant: "})
    other: tuple[str, str] = ("### Role ", ":: ")
    tail: str = " </turn>\n"
    controls: tuple[str, ...] = ("###", "</turn>", "::")
    follows: dict[str, tuple[str, ...]] = field(
        default_factory=lambda: {START: ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)}
    )
    final: tuple[str, ...] = ("assistant",)
    loss: tuple[str, ...] = ("assistant",)


def escape(text: str, template: Template) -> str:
    out = text.replace("\\", "\\\\")
    for k, control in enumerate(template.controls):
        # Also where occurrences overlap, so that none is left.
        out = re.sub(f"{re.escape(control[0])}(?={re.escape(control[1:])})", lambda _, k=k: f"\\{k}", out)
    return out


def unescape(text: str, template: Template) -> str:
    if "\\" not in text:
        return text
    return re.sub(r"\\(.)", lambda m: template.controls[int(m[1])][0] if m[1].isdigit() else m[1], text)


def head(role: str | None, template: Template) -> str:
    if role in template.heads:
        return template.heads[role]
    name = "\\-" if role is None else escape(role, template)
    return template.other[0] + name + template.other[1]


def read_back(formatted: str, template: Template) -> list[tuple[str | None, str]]:
    """Roles and texts of a formatted conversation."""
    turns, at = [], 0
    while at < len(formatted):
        role, start = next(((r, at + len(h)) for r, h in template.heads.items() if formatted.startswith(h, at)), (None, -1))
        if start < 0:
            if not formatted.startswith(template.other[0], at):
                raise ValueError(f"no turn starts at {at}")
            begin = at + len(template.other[0])
            end = formatted.index(template.other[1], begin)
            role, start = formatted[begin:end], end + len(template.other[1])
            role = None if role == "\\-" else unescape(role, template)
        end = formatted.index(template.tail, start)
        turns.append((role, unescape(formatted[start:end], template)))
        at = end + len(template.tail)
    return turns


SEGMENTS = "conv_id long, position long, part string, text string, loss boolean, allowed boolean, first boolean"


def chat_segments(conversations: DataFrame, template: Template | None = None) -> DataFrame:
    """Text segments of ``conversations(conv_id, turn, role, text)``, in order.

    Columns: conv_id, position (of the turn), part (head, content or tail), text, loss, allowed (by
    the machine), first (whether the turn opens its conversation). Rows are dealt by conversation and
    sorted by turn, and stream through the machine: a conversation of any length needs no more
    memory than a batch.
    """
    template = template or Template()
    rows = conversations.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role").cast("string"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state, position = object(), START, 0
        for batch in batches:
            out: list[list] = [[] for _ in range(7)]
            for conv, role, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                if conv != current:
                    current, state, position = conv, START, 0
                allowed = role in template.follows.get(state, ())
                pieces = (("head", head(role, template), False), ("content", escape(text, template), role in template.loss), ("tail", template.tail, False))
                for part, piece, loss in pieces:
                    for column, value in zip(out, (conv, position, part, piece, loss, allowed, position == 0), strict=True):
                        column.append(value)
                state, position = role, position + 1
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.bool_(), pa.bool_(), pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names=[x.split()[0] for x in SEGMENTS.split(", ")])

    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").mapInArrow(run, SEGMENTS)


CHATS = "conv_id long, formatted string, loss_spans array<array<long>>, valid boolean"


def chats(conversations: DataFrame, template: Template | None = None) -> DataFrame:
    """``(conv_id, formatted, loss_spans, valid)`` per conversation, joined from the segments.

    ``loss_spans`` are start and end code points of the text under the loss mask; ``valid`` tells whether
    every turn was allowed and the last role may be last.
    """
    template = template or Template()
    finals = [head(r, template) for r in template.final]

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_chat = None
        for batch in batches:
            done = []
            names = ("conv_id", "part", "text", "loss", "allowed", "position")
            for conv, part, text, loss, allowed, position in zip(*[batch.column(c).to_pylist() for c in names], strict=True):
                if part == "head" and position == 0:
                    if open_chat is not None:
                        done.append(open_chat)
                    open_chat = {"conv_id": conv, "pieces": [], "spans": [], "length": 0, "valid": True, "last": None}
                if part == "head":
                    open_chat["last"] = text
                    open_chat["valid"] &= allowed
                if loss:
                    open_chat["spans"].append([open_chat["length"], open_chat["length"] + len(text)])
                open_chat["pieces"].append(text)
                open_chat["length"] += len(text)
            yield closed(done)
        yield closed([open_chat] if open_chat is not None else [])

    def closed(done: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [
                pa.array([c["conv_id"] for c in done], pa.int64()),
                pa.array(["".join(c["pieces"]) for c in done], pa.string()),
                pa.array([c["spans"] for c in done], pa.list_(pa.list_(pa.int64()))),
                pa.array([c["valid"] and c["last"] in finals for c in done], pa.bool_()),
            ],
            names=[x.split()[0] for x in CHATS.split(", ")],
        )

    return chat_segments(conversations, template).mapInArrow(join, CHATS)


DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, valid boolean"


def chat_digests(formatted: DataFrame, template: Template | None = None) -> DataFrame:
    """Figures of formatted conversations, read back from their text."""
    template = template or Template()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in range(7)]
            for conv, text, spans, valid in zip(*[batch.column(k).to_pylist() for k in range(4)], strict=True):
                turns = read_back(text, template)
                told = "".join(f"{'' if r is None else r}\n{t}\n" for r, t in turns)
                lost = "".join(unescape(text[a:b], template) for a, b in spans)
                values = (conv, len(turns), hashlib.sha256(told.encode()).hexdigest(), len(lost), hashlib.sha256(lost.encode()).hexdigest(), len(text), valid)
                for column, value in zip(out, values, strict=True):
                    column.append(value)
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names=[x.split()[0] for x in DIGESTS.split(", ")])

    return formatted.mapInArrow(digest, DIGESTS)
