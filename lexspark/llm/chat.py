"""Chat formatting: a finite-state machine over roles, and text segments with loss flags from a template.

Each turn gives three segments: its opening, its escaped text, and its closing; only texts of the template's
loss roles carry the loss flag. A control string inside a text gets a backslash before it and every backslash
is doubled, so the formatted text can be read back.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexspark.llm.common import input_partitions

#: Which role may follow which state; the state after a turn is its role. END: where a conversation may end.
TURN_ORDER = {"START": {"system", "user"}, "system": {"user"}, "user": {"assistant"}, "assistant": {"user"}}
END_STATES = {"assistant"}


@dataclass(frozen=True)
class ChatTemplate:
    """Declares how turns look. names: the roles' names in openings; other roles are written after '='."""

    opening: str = "### {name}: "
    closing: str = "</turn>\n"
    names: dict[str, str] = field(default_factory=lambda: {"system": "System", "user": "User", "assistant": "Assistant"})
    loss_roles: frozenset[str] = frozenset({"assistant"})
    controls: tuple[str, ...] = ("###", "</turn>")


class Formatter:
    def __init__(self, template: ChatTemplate) -> None:
        self.t = template
        self._escaped = re.compile("|".join([r"\\", *map(re.escape, template.controls)]))
        self._stop = re.compile(r"\\.|" + re.escape(template.closing), re.S)
        self._unescaped = re.compile(r"\\(.)", re.S)
        self._head, _, self._tail = template.opening.partition("{name}")
        self._name_stop = re.compile(r"\\.|" + re.escape(self._tail), re.S)
        self._name_escaped = re.compile("|".join([r"\\", re.escape(self._tail.strip() or self._tail), *map(re.escape, template.controls)]))
        self._roles = {v: k for k, v in template.names.items()}

    def escape(self, text: str) -> str:
        return self._escaped.sub(lambda m: "\\" + m[0], text)

    def unescape(self, text: str) -> str:
        return self._unescaped.sub(r"\1", text)

    def opening(self, role: str | None) -> str:
        name = "~" if role is None else self.t.names.get(role) or "=" + self._name_escaped.sub(lambda m: "\\" + m[0], role)
        return self._head + name + self._tail

    def turn(self, role: str | None, text: str | None) -> tuple[tuple[str, bool], ...]:
        return (self.opening(role), False), (self.escape(text or ""), role in self.t.loss_roles), (self.t.closing, False)

    def parse(self, formatted: str, at: int = 0) -> tuple[str | None, str, int] | None:
        """Role, text and end of the turn at `at`; None if its closing is not there yet."""
        if not formatted.startswith(self._head, at):
            if len(formatted) - at < len(self._head):
                return None
            raise ValueError("no opening of a turn")
        name_end = next((m for m in self._name_stop.finditer(formatted, at + len(self._head)) if m[0][0] != "\\"), None)
        if not name_end:
            return None
        stop = next((m for m in self._stop.finditer(formatted, name_end.end()) if m[0][0] != "\\"), None)
        if not stop:
            return None
        name = formatted[at + len(self._head) : name_end.start()]
        role = None if name == "~" else self.unescape(name[1:]) if name[:1] == "=" else self._roles[name]
        return role, self.unescape(formatted[name_end.end() : stop.start()]), stop.end()


SEGMENTS = "conv_id long, seq long, text string, loss boolean, turn_ok boolean"


def format_chat(turns: DataFrame, template: ChatTemplate | None = None) -> DataFrame:
    """Segments (conv_id, seq, text, loss, turn_ok) of all conversations, by conversation and in order within partitions.

    turns: conv_id, turn, role, text; other columns are left out. Turns go by turn (null first), then role and
    text, so ties and repeated rows have one order. Null text is empty; a null or unknown role is written as
    such and never follows the order of roles. turn_ok is false from the first turn on that breaks the order;
    nothing is left out for it. Rows of one conversation are streamed, never held together.
    """
    template = template or ChatTemplate()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = Formatter(template)
        conv, state, seq = object(), "START", 0
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for c, role, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if c != conv:
                    conv, state, seq = c, "START", 0
                state = role if role in TURN_ORDER.get(state, ()) else "BROKEN"
                for piece, loss in make.turn(role, text):
                    for column, value in zip(out, (c, seq, piece, loss, state != "BROKEN")):
                        column.append(value)
                    seq += 1
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, (pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.bool_()))], names=["conv_id", "seq", "text", "loss", "turn_ok"])

    rows = turns.select(F.col("conv_id").cast("long"), F.col("role").cast("string"), F.col("text").cast("string"), F.col("turn").cast("long"))
    dealt = rows.repartition(input_partitions(turns), "conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return dealt.select("conv_id", "role", "text").mapInArrow(run, SEGMENTS)


def read_chat(segments: DataFrame, template: ChatTemplate | None = None, in_order: bool = True) -> DataFrame:
    """One row for each conversation, read back from its formatted text: turns, loss text, sizes, and order_ok.

    in_order: segments come as format_chat gives them; else they are dealt out and sorted first.
    order_ok: all turns follow the order of roles and the last may end a conversation.
    """
    template = template or ChatTemplate()
    if not in_order:
        segments = segments.repartition(input_partitions(segments), "conv_id").sortWithinPartitions("conv_id", "seq")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = Formatter(template)
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "order_ok"]
        types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_()]
        conv, begun = None, False

        def fresh() -> dict:
            return {"n": 0, "turns": hashlib.sha256(), "loss_n": 0, "loss": hashlib.sha256(), "chars": 0, "ok": True, "rest": "", "role": None}

        def row(c, s: dict) -> tuple:
            if s["rest"]:
                raise ValueError(f"conversation {c} ends within a turn")
            return c, s["n"], s["turns"].hexdigest(), s["loss_n"], s["loss"].hexdigest(), s["chars"], s["ok"] and s["role"] in END_STATES

        s = fresh()
        for batch in batches:
            done = []
            for c, text, loss, ok in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if begun and c != conv:
                    done.append(row(conv, s))
                    s = fresh()
                conv, begun = c, True
                s["chars"] += len(text)
                s["ok"] = s["ok"] and ok
                if loss:
                    plain = make.unescape(text)
                    s["loss_n"] += len(plain)
                    s["loss"].update(plain.encode())
                s["rest"] += text
                if text == template.closing and (turn := make.parse(s["rest"])):
                    s["role"], said, end = turn
                    s["rest"] = s["rest"][end:]
                    s["n"] += 1
                    s["turns"].update(f"{s['role'] or ''}\n{said}\n".encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*done), types)], names=names)
        if begun:
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row(conv, s), types)], names=names)

    return segments.select("conv_id", "text", "loss", "turn_ok").mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, order_ok boolean")
