"""Conversations as formatted text with a loss mask.

A template declares what surrounds a turn of each role and whether its text is trained on. A
finite-state machine over the roles judges the order of turns. Turns are sorted by conversation and
formatted as a stream: a conversation is never held as a whole, however long it is.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glosswell.llm.common import slices

ESCAPE = "\\"


@dataclass(frozen=True)
class Template:
    """Marks around turns. ``named`` serves roles without own marks; its first mark is followed by
    the escaped role and ``name_end``. The marks are the control strings that texts must not contain.
    """

    marks: dict[str, tuple[str, str]] = field(
        default_factory=lambda: {
            "system": ("<<SYS>>", "<</SYS>>"),
            "user": ("<s>[INST]", "[/INST]"),
            "assistant": ("[OUT]", "</s>"),
        }
    )
    named: tuple[str, str] = ("[ROLE]", "[/TURN]")
    name_end: str = "[/ROLE]"
    loss_roles: frozenset[str] = frozenset({"assistant"})
    # State before -> role -> state after; a missing entry is an error, which is never left.
    states: dict[str, dict[str, str]] = field(
        default_factory=lambda: {
            "start": {"system": "system", "user": "user"},
            "system": {"user": "user"},
            "user": {"assistant": "assistant"},
            "assistant": {"user": "user"},
        }
    )
    final: frozenset[str] = frozenset({"assistant"})

    def controls(self) -> list[str]:
        """The bracketed control strings that the marks are made of."""
        marks = [*(m for pair in [*self.marks.values(), self.named] for m in pair), self.name_end]
        return sorted({c for m in marks for c in re.findall(r"<+[^<>]*>+|\[[^\[\]]*\]", m)})

    def escaped(self, text: str) -> str:
        """Break every control string after its first character, and double the escape itself."""
        return self.breaks.sub(r"\1\\", text.replace(ESCAPE, ESCAPE * 2))

    @cached_property
    def breaks(self) -> re.Pattern:
        return re.compile(f"(?={'|'.join(map(re.escape, self.controls()))})(.)", re.S)

    @staticmethod
    def unescaped(text: str) -> str:
        return re.sub(r"\\(\\?)", r"\1", text)

    def segments(self, role: str, text: str) -> list[tuple[str, bool]]:
        """The turn as (string, in the loss) in order; joined they are its formatted form."""
        loss = role in self.loss_roles
        if role in self.marks:
            before, after = self.marks[role]
        else:
            before, after = f"{self.named[0]}{self.escaped(role)}{self.name_end}", self.named[1]
        return [(before, False), (self.escaped(text), loss), (after, False)]

    def turn(self, formatted: str) -> tuple[str, str]:
        """Role and text back from a formatted turn."""
        for role, (before, after) in self.marks.items():
            if formatted.startswith(before):
                return role, self.unescaped(formatted[len(before) : len(formatted) - len(after)])
        name, _, rest = formatted[len(self.named[0]) :].partition(self.name_end)
        return self.unescaped(name), self.unescaped(rest[: len(rest) - len(self.named[1])])


def ordered(conversations: DataFrame) -> DataFrame:
    """Turns of a conversation together and in order: by turn, then role and text."""
    return (
        conversations.select(
            F.col("conv_id").cast("long"),
            F.col("turn").cast("long"),
            F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
            F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        )
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
    )


def format_turns(conversations: DataFrame, template: Template) -> DataFrame:
    """conv_id, turn, seq, texts, losses, in_order, ends: one row per turn, conversations together.

    ``texts`` are the turn's segments and ``losses`` says which are trained on; the segments of all
    turns by ``seq``, joined, are the formatted conversation. ``in_order`` is whether the machine
    accepts the turns so far, ``ends`` whether a conversation may end here.

    A null text or role is an empty one; an empty or unknown role is formatted by name and is out of
    order. Turns with the same number follow each other by role and text; repeated rows are turns of
    their own. Rows whose conv_id is null are one conversation. Further columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, seq, state = object(), 0, None
        for part in slices(batches, "text"):
            out: dict[str, list] = {c: [] for c in ("seq", "texts", "losses", "in_order", "ends")}
            ids, roles, texts = (part.column(c).to_pylist() for c in ("conv_id", "role", "text"))
            for own, role, text in zip(ids, roles, texts):
                if own != conv:
                    conv, seq, state = own, 0, "start"
                state = template.states.get(state, {}).get(role)
                parts = template.segments(role, text)
                out["seq"].append(seq)
                out["texts"].append([p for p, _ in parts])
                out["losses"].append([x for _, x in parts])
                out["in_order"].append(state is not None)
                out["ends"].append(state in template.final)
                seq += 1
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("conv_id"),
                    part.column("turn"),
                    pa.array(out["seq"], pa.int64()),
                    pa.array(out["texts"], pa.list_(pa.string())),
                    pa.array(out["losses"], pa.list_(pa.bool_())),
                    pa.array(out["in_order"], pa.bool_()),
                    pa.array(out["ends"], pa.bool_()),
                ],
                ["conv_id", "turn", "seq", "texts", "losses", "in_order", "ends"],
            )

    return ordered(conversations).mapInArrow(
        run, "conv_id long, turn long, seq long, texts array<string>, losses array<boolean>, in_order boolean, ends boolean"
    )


def digests(formatted: DataFrame, template: Template) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, valid: what reading
    the formatted turns back gives, per conversation.

    Takes the rows of format_turns as they come: conversations together, turns in order. Digests run
    along, so a conversation of any length takes no more memory than one batch.
    """
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "valid"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_()]
        conv: object = None
        done: list[tuple] = []
        held: list = []

        def close() -> None:
            if held:
                n, turns, loss_chars, loss, chars, in_order, ends = held
                done.append((conv, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars, in_order and ends))
                held.clear()

        def table() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds)], names)
            done.clear()
            return made

        for part in slices(batches):
            columns = (part.column(c).to_pylist() for c in ("conv_id", "seq", "texts", "losses", "in_order", "ends"))
            for own, seq, texts, losses, in_order, ends in zip(*columns):
                if seq == 0:
                    close()
                    conv = own
                    held[:] = [0, hashlib.sha256(), 0, hashlib.sha256(), 0, True, False]
                whole = "".join(texts)
                role, text = template.turn(whole)
                held[0] += 1
                held[1].update(f"{role}\n{text}\n".encode())
                for piece, loss in zip(texts, losses):
                    if loss:
                        said = template.unescaped(piece)
                        held[2] += len(said)
                        held[3].update(said.encode())
                held[4] += len(whole)
                held[5:] = [in_order, ends]
            if done:
                yield table()
        close()
        if done:
            yield table()

    return formatted.mapInArrow(
        run,
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, valid boolean",
    )
