"""Chat conversations rebuilt from their event log, rendered, and read back.

Events are dealt by conversation and sorted by sequence; a task folds a conversation's messages, streamed deltas, edits
and regenerations as they come and renders its final messages.  A task holds one conversation at a time, as its text is
one row of the result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# fixed values: what marks turns
BEGIN = "<s>"
MARKS = {"system": ("<<SYS>>", "<</SYS>>"), "user": ("[INST] ", " [/INST]"), "assistant": (" ", "</s>")}
#: Any other role, which is written between the first two.
OTHER = ("[ROLE]", "[/ROLE]", "</s>")
CONTROL = re.compile(r"<<SYS>>|<</SYS>>|<s>|</s>|\[/?INST\]|\[/?ROLE\]")
_BACK = re.compile(r"\\(\\?)")


def escape(text: str) -> str:
    """``text`` with backslashes doubled and one set into each control string, behind its first character."""
    return CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:], text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _BACK.sub(r"\1", text)


class Conversation:
    """Messages of one conversation, as (turn, role, text), while its events come in order."""

    def __init__(self) -> None:
        self.turns: list = []
        self.roles: list[str] = []
        self.parts: list[list[str]] = []

    def apply(self, kind: str, turn, role: str, text: str) -> None:
        """message: a new one. delta: more text of the turn. edit: the turn's new text. regenerate: what came from the
        turn on is dropped and the turn begins anew. A delta or edit of an unknown turn is a new message."""
        if kind == "regenerate":
            keep = next((i for i, t in enumerate(self.turns) if t == turn), len(self.turns))
            for held in (self.turns, self.roles, self.parts):
                del held[keep:]
        at = next((i for i in range(len(self.turns) - 1, -1, -1) if self.turns[i] == turn), None)
        if kind in ("message", "regenerate") or at is None:
            self.turns.append(turn)
            self.roles.append(role)
            self.parts.append([text])
        elif kind == "delta":
            self.parts[at].append(text)
        elif kind == "edit":
            self.parts[at] = [text]
        else:
            raise ValueError(f"unknown kind of event: {kind!r}")

    def rendered(self) -> tuple[str, list[tuple[int, int]]]:
        """The formatted text and the spans under the loss mask: what assistants said."""
        out, at, spans = [BEGIN], len(BEGIN), []
        for role, parts in zip(self.roles, self.parts):
            text = escape("".join(parts))
            if role in MARKS:
                before, after = MARKS[role]
            else:
                before, after = OTHER[0] + escape(role) + OTHER[1], OTHER[2]
            if role == "assistant":
                spans.append((at + len(before), at + len(before) + len(text)))
            out += [before, text, after]
            at += len(before) + len(text) + len(after)
        return "".join(out), spans


_FORMATTED = "conv_id long, formatted string, loss array<struct<start:long,end:long>>"
_SPAN = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def format_chats(events: DataFrame) -> DataFrame:
    """conv_id, formatted and loss (spans in code points) of each conversation in ``events``.

    ``events`` needs conv_id, seq, kind, turn, role and text; other columns are ignored.  Null texts and roles count as
    empty, a null kind as a message; events of one seq are taken by turn, role and text.  Rows without conv_id are one
    conversation.  Repeated rows are events of their own.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held, done = None, None, []

        def batch() -> pa.RecordBatch:
            ids, texts, spans = zip(*done)
            spans = [[{"start": a, "end": b} for a, b in s] for s in spans]
            return pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(texts, pa.string()), pa.array(spans, _SPAN)], names=["conv_id", "formatted", "loss"]
            )

        for one in batches:
            for conv, kind, turn, role, text in zip(*(one.column(i).to_pylist() for i in range(5))):
                if held is None or conv != current:
                    if held is not None:
                        done.append((current, *held.rendered()))
                    current, held = conv, Conversation()
                held.apply(kind, turn, role, text)
            if len(done) >= 100:
                yield batch()
                done = []
        if held is not None:
            done.append((current, *held.rendered()))
        if done:
            yield batch()

    clean = events.select(
        F.col("conv_id").cast("long"),
        F.coalesce("kind", F.lit("message")).alias("kind"),
        F.col("turn").cast("long"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
        F.col("seq").cast("long"),
    )
    return (
        clean.repartition("conv_id")
        .sortWithinPartitions("conv_id", "seq", "turn", "role", "text")
        .select("conv_id", "kind", "turn", "role", "text")
        .mapInArrow(run, _FORMATTED)
    )


def parsed(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts of a formatted conversation."""
    opens = {"<<SYS>>": "system", "[INST]": "user", "[ROLE]": None}
    marks = [(m[0], m.start(), m.end()) for m in CONTROL.finditer(formatted)]
    out, at, i = [], len(BEGIN), 1
    while i < len(marks):
        mark, start, end = marks[i]
        if start == at and opens.get(mark) in ("system", "user"):
            role = opens[mark]
            before, after = MARKS[role]
            out.append((role, unescape(formatted[at + len(before) : marks[i + 1][2] - len(after)])))
            at, i = marks[i + 1][2], i + 2
        elif start == at and mark == OTHER[0]:
            role_end, close = marks[i + 1], marks[i + 2]
            out.append((unescape(formatted[end : role_end[1]]), unescape(formatted[role_end[2] : close[1]])))
            at, i = close[2], i + 3
        else:
            out.append(("assistant", unescape(formatted[at + 1 : start])))
            at, i = end, i + 1
    return out


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of what formatted conversations say: turns as parsed, and the text under the loss mask."""
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for conv, text, spans in zip(*(batch.column(i).to_pylist() for i in range(3))):
                turns = parsed(text)
                said = "".join([f"{role}\n{words}\n" for role, words in turns])
                learnt = "".join([unescape(text[s["start"] : s["end"]]) for s in spans])
                digests = [hashlib.sha256(x.encode()).hexdigest() for x in (said, learnt)]
                rows.append((conv, len(turns), digests[0], len(learnt), digests[1], len(text)))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return formatted.select("conv_id", "formatted", "loss").mapInArrow(run, schema)
