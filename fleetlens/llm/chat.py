"""Chat formatting: a finite-state machine over roles and a declarative template.

The template says how a turn opens and closes and which roles are learnt; the
machine says which role may follow which state.  Turns become text segments with a
loss flag each; the concatenated segments of a conversation are the training text.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F


@dataclass(frozen=True)
class Template:
    """How turns are written, and which order of roles is valid.

    ``moves`` maps (state, role) to the next state; a pair that is absent is a
    violation, after which the machine goes on in the state named like the role.
    """

    open: str = "<|im_start|>{role}\n"
    close: str = "<|im_end|>\n"
    learnt: tuple[str, ...] = ("assistant",)
    start: str = "start"
    moves: dict[tuple[str, str], str] = field(default_factory=lambda: {
        ("start", "system"): "system", ("start", "user"): "user", ("system", "user"): "user",
        ("user", "assistant"): "assistant", ("assistant", "user"): "user"})
    final: tuple[str, ...] = ("assistant",)


CHATML = Template()

SEGMENTS = "conv_id long, pos long, role string, segment string, loss boolean, valid boolean"
READ = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
        "formatted_chars long, valid boolean")


def escape(text: str) -> str:
    """No control string is left: every ``<``, backslashes, ``|`` gets one more backslash."""
    return re.sub(r"<(\\*)\|", r"<\\\1|", text)


def unescape(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def next_state(template: Template, state: str, role: str) -> tuple[str, bool]:
    to = template.moves.get((state, role))
    return (role, False) if to is None else (to, True)


def turn_segments(template: Template, role: str, text: str) -> list[tuple[str, bool]]:
    """The text segments of one turn with their loss flags."""
    return [(template.open.format(role=escape_role(role)), False), (escape(text), role in template.learnt),
            (template.close, False)]


def read_turns(template: Template, pieces: Iterator[str]) -> Iterator[tuple[str, str]]:
    """(role, text) of each turn of a formatted conversation; holds one turn at a time."""
    before, after = template.open.split("{role}")
    held = ""
    for piece in pieces:
        held += piece
        if not piece.endswith(template.close):
            continue
        while (stop := held.find(template.close)) >= 0:
            head = held.index(after)
            yield unescape_role(held[len(before):head]), unescape(held[head + len(after):stop])
            held = held[stop + len(template.close):]
    if held:
        raise ValueError("the formatted conversation ends inside a turn")


def _rows(batches):
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)


def _format(template):
    def run(batches):
        import pyarrow as pa

        schema = pa.schema([("conv_id", pa.int64()), ("pos", pa.int64()), ("role", pa.string()),
                            ("segment", pa.string()), ("loss", pa.bool_()), ("valid", pa.bool_())])
        out, size = [], 0
        conv, state, pos = object(), "", 0
        for conv_id, role, text in _rows(batches):
            if conv_id != conv:
                conv, state, pos = conv_id, template.start, 0
            state, valid = next_state(template, state, role)
            for segment, loss in turn_segments(template, role, text):
                out.append((conv_id, pos, role, segment, loss, valid))
                pos, size = pos + 1, size + len(segment) + 64
            if size > 1 << 20:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema)
                out, size = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema)
    return run


def format_segments(convs: DataFrame, template: Template = CHATML, conv_col: str = "conv_id", turn_col: str = "turn",
                    role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Segments (conv_id, pos, role, segment, loss, valid) of all conversations.

    A conversation's rows are ordered by turn, then role and text (ties, repeated rows;
    a null turn comes first).  Null texts and roles are empty; rows with a null
    conversation id form one conversation.  ``valid`` is false for the segments of a
    turn whose role may not follow.  Other columns are not read.

    One shuffle on the conversation; each task streams its sorted rows, so memory is
    bounded by a turn, not by a conversation or a group of them.
    """
    rows = convs.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"),
                        F.coalesce(F.col(role_col), F.lit("")).alias("role"),
                        F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return (rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
            .select("conv_id", "role", "text").mapInArrow(_format(template), SEGMENTS))


class _Reading:
    """What is read back from one formatted conversation, fed segment by segment."""

    def __init__(self, template, conv_id):
        self.template, self.conv_id = template, conv_id
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n = self.loss_chars = self.chars = 0
        self.valid, self.role, self.held = True, "", []

    def feed(self, segment, loss, valid):
        self.chars += len(segment)
        self.valid &= valid
        if loss:
            text = unescape(segment)
            self.loss.update(text.encode())
            self.loss_chars += len(text)
        self.held.append(segment)
        if segment == self.template.close:
            for role, text in read_turns(self.template, iter(["".join(self.held)])):
                self.turns.update(f"{role}\n{text}\n".encode())
                self.n, self.role = self.n + 1, role
            self.held = []

    def row(self):
        if self.held:
            raise ValueError("the formatted conversation ends inside a turn")
        return (self.conv_id, self.n, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars,
                self.valid and self.role in self.template.final)


def _read(template):
    def run(batches):
        import pyarrow as pa

        types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_()]
        names = [c.split()[0] for c in READ.split(", ")]
        out, now = [], None
        for conv_id, segment, loss, valid in _rows(batches):
            if now is None or conv_id != now.conv_id:
                if now is not None:
                    out.append(now.row())
                now = _Reading(template, conv_id)
            now.feed(segment, loss, valid)
            if len(out) >= 4096:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)
                out = []
        if now is not None:
            out.append(now.row())
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)
    return run


def read_back(segments: DataFrame, template: Template = CHATML) -> DataFrame:
    """Per conversation: what the formatted text and its loss mask say.

    ``segments`` must come straight from ``format_segments`` (its partitioning and order
    are used as they are, so there is no second shuffle).
    """
    return segments.select("conv_id", "segment", "loss", "valid").mapInArrow(_read(template), READ)
