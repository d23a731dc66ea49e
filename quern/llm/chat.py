r"""Chat formatting by a finite-state machine over roles, from a declarative template.

The template names each role's opening and closing control string, whether its text is trained on, and
which roles may follow it.  A turn becomes segments of text, each with a loss flag.  Inside texts a
backslash goes before every backslash and every character that starts a control string, so no control
string survives in a text and reading back is exact.

A conversation's rows are brought together and sorted by Spark and then stream through the machine, turn
by turn: no conversation is held in memory, however long it is.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Role:
    opening: str
    closing: str
    loss: bool
    followed_by: tuple[str, ...]


@dataclass(frozen=True)
class Template:
    """begin: before the first turn.  first: roles that may come first.  last: roles that may come last.
    other: control strings around the name of a role that the template doesn't have."""

    begin: str = "<s>"
    first: tuple[str, ...] = ("system", "user")
    last: tuple[str, ...] = ("assistant",)
    other: tuple[str, str, str] = ("[ROLE]", "[/ROLE]", "[END]")
    roles: dict[str, Role] = field(
        default_factory=lambda: {
            "system": Role("<<SYS>>\n", "\n<</SYS>>\n", False, ("user",)),
            "user": Role("[INST] ", " [/INST]", False, ("assistant",)),
            "assistant": Role("", "</s>", True, ("user",)),
        }
    )

    def controls(self) -> list[str]:
        both = [s for r in self.roles.values() for s in (r.opening, r.closing)]
        return sorted({s.strip() for s in [self.begin, *self.other, *both]} - {""})


class Machine:
    """Formats turns one after another and tells where their order breaks the template's rules."""

    def __init__(self, template: Template) -> None:
        self.template = template
        starts = "".join(re.escape(c) for c in sorted({s[0] for s in template.controls()} | {"\\"}))
        self.special = re.compile(f"[{starts}]")
        self.state: str | None = None

    def escape(self, text: str) -> str:
        return self.special.sub(r"\\\g<0>", text)

    def turn(self, role: str, text: str, is_first: bool) -> tuple[list[tuple[str, bool]], str | None]:
        """The segments (text, loss) of a turn, and what is wrong with its place."""
        t = self.template
        allowed = t.first if is_first else t.roles[self.state].followed_by if self.state in t.roles else ()
        wrong = None if role in allowed else f"{role or 'no role'} after {'start' if is_first else self.state or 'no role'}"
        self.state = role
        segments = [(t.begin, False)] if is_first else []
        if (r := t.roles.get(role)) is None:
            opening, closing, loss = t.other[0] + self.escape(role) + t.other[1], t.other[2], False
        else:
            opening, closing, loss = r.opening, r.closing, r.loss
        return [*segments, (opening, False), (self.escape(text), loss), (closing, False)], wrong


class Reader:
    """Takes formatted turns apart again: (role, text) from their control strings alone."""

    def __init__(self, template: Template) -> None:
        self.template = template
        self.plain = {r.opening: n for n, r in template.roles.items() if r.opening}
        self.bare = next((n for n, r in template.roles.items() if not r.opening), None)

    def _until(self, s: str, at: int, closing: str) -> tuple[str, int]:
        """The text from ``at`` to the next ``closing`` that no backslash guards, unescaped; where that ends."""
        out: list[str] = []
        mark = closing.strip() or closing
        lead = len(closing) - len(closing.lstrip()) if closing.strip() else 0
        pattern = re.compile(r"\\(.)|(" + re.escape(mark) + ")", re.DOTALL)
        begin = at
        while (m := pattern.search(s, at)) and m[1] is not None:
            out += [s[begin : m.start()], m[1]]
            begin = at = m.end()
        if m is None:
            raise ValueError(f"no {mark!r} after {begin}")
        out.append(s[begin : m.start()])
        text = "".join(out)
        return text[: len(text) - lead] if lead else text, m.start() - lead + len(closing)

    def turn(self, s: str, is_first: bool) -> tuple[str, str]:
        at = 0
        if is_first:
            if not s.startswith(self.template.begin):
                raise ValueError("a conversation doesn't begin with its mark")
            at = len(self.template.begin)
        t = self.template
        if s.startswith(t.other[0], at):
            role, at = self._until(s, at + len(t.other[0]), t.other[1])
            closing = t.other[2]
        else:
            opening = next((o for o in self.plain if s.startswith(o, at)), "")
            role = self.plain.get(opening, self.bare)
            at, closing = at + len(opening), t.roles[role].closing
        text, at = self._until(s, at, closing)
        if at != len(s):
            raise ValueError("text after the end of a turn")
        return role, text


FORMATTED = "conv_id {kind}, seq long, n_segments int, segments array<struct<text:string,loss:boolean>>, violation string"


def format_chat(rows: DataFrame, template: Template | None = None) -> DataFrame:
    """A row per turn: conv_id, seq (from 0), the turn's segments, and violation (null where its place is right).

    Turns come in the order of turn, then role and text where turns tie (nulls first).  Null text is empty; a
    null role is the empty name, and a role that the template lacks keeps its name and is never trained on.
    Rows with a null conv_id are one conversation.  Nothing is dropped for a violation.  Repeated rows are
    turns of their own.  Other columns are not read; an empty table gives no rows.
    """
    template = template or Template()
    kind = rows.schema["conv_id"].dataType
    ordered = (
        rows.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
        .select("conv_id", "role", "text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine, current, seq = Machine(template), object(), 0
        for batch in batches:
            out = []
            for conv, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                seq = seq + 1 if conv == current else 0
                current = conv
                segments, wrong = machine.turn(role, text, seq == 0)
                out.append((conv, seq, segments, wrong))
            if out:
                convs, seqs, segs, wrongs = zip(*out, strict=True)
                segs = [[{"text": t, "loss": loss} for t, loss in s] for s in segs]
                kinds = pa.list_(pa.struct([("text", pa.string()), ("loss", pa.bool_())]))
                columns = [pa.array(convs, batch.schema.types[0]), pa.array(seqs, pa.int64()), pa.array([len(s) for s in segs], pa.int32())]
                columns += [pa.array(segs, kinds), pa.array(wrongs, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, ["conv_id", "seq", "n_segments", "segments", "violation"])

    return ordered.mapInArrow(run, FORMATTED.format(kind=kind.simpleString()))


def read_chat(formatted: DataFrame, template: Template | None = None) -> DataFrame:
    """A row per conversation, from format_chat()'s segments alone: digests of its turns and of its loss text.

    A conversation streams through in the order of seq; only running digests are kept.
    """
    template = template or Template()
    kind = formatted.schema["conv_id"].dataType
    ordered = formatted.select("conv_id", "seq", "segments", "violation").repartition("conv_id").sortWithinPartitions("conv_id", "seq")
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_violations", "ends_well"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, current, conv, conv_kind = Reader(template), None, None, None
        unescape = re.compile(r"\\(.)", re.DOTALL)

        def close(c: dict) -> tuple:
            return (conv, c["n"], c["turns"].hexdigest(), c["loss_chars"], c["loss"].hexdigest(), c["chars"], c["wrong"], c["role"] in template.last)

        for batch in batches:
            out, conv_kind = [], batch.schema.types[0]
            for conv_id, seq, segments, violation in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                if seq == 0:
                    if current is not None:
                        out.append(close(current))
                    conv = conv_id
                    current = {"n": 0, "turns": hashlib.sha256(), "loss_chars": 0, "loss": hashlib.sha256(), "chars": 0, "wrong": 0, "role": None}
                whole = "".join(s["text"] for s in segments)
                role, text = reader.turn(whole, seq == 0)
                trained = unescape.sub(r"\1", "".join(s["text"] for s in segments if s["loss"]))
                current["n"] += 1
                current["turns"].update(f"{role}\n{text}\n".encode())
                current["loss_chars"] += len(trained)
                current["loss"].update(trained.encode())
                current["chars"] += len(whole)
                current["wrong"] += violation is not None
                current["role"] = role
            if out:
                yield _batch(out, names, conv_kind)
        if current is not None:
            yield _batch([close(current)], names, conv_kind)

    return ordered.mapInArrow(
        run,
        f"conv_id {kind.simpleString()}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_violations long, ends_well boolean",
    )


def _batch(rows: list[tuple], names: list[str], kind: pa.DataType) -> pa.RecordBatch:
    columns = [pa.array(c, kind if i == 0 else None) for i, c in enumerate(zip(*rows, strict=True))]
    return pa.RecordBatch.from_arrays(columns, names)
