"""Chat formatting with a grammar round trip.

A turn is written as ``### role: text</turn>`` and a line feed. The parser is deterministic. A text is first
written as it is; the line is parsed, and only if the parser does not give back the same turn is the
text escaped, and parsed again. So every text survives, and few are changed.

Grammar of a text, where a control string is ``###`` or ``</turn>``: a control string after an odd number of
backslashes is text, and of 2n + 1 backslashes n belong to the text; ``</turn>`` after an even number 2n ends the turn,
n backslashes belonging to the text; ``###`` after an even number is an error. Other backslashes are text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import sha256

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from brookmill.llm.common import Rows, map_batches

OPEN, CLOSE = "###", "</turn>"
_CONTROL = re.compile(r"(\\*)(###|</turn>)")
_ROLE = re.compile(r"### ((?:\\.|[^\\:])*): ", re.DOTALL)


class GrammarError(ValueError):
    """The text is not a sequence of turns."""


def escaped(text: str) -> str:
    """``text`` so that the parser reads no control string in it, nor one formed with what follows."""
    inner = _CONTROL.sub(lambda m: m[1] * 2 + "\\" + m[2], text)
    tail = len(inner) - len(inner.rstrip("\\"))
    return inner + "\\" * tail


def escaped_role(role: str) -> str:
    return re.sub(r"([\\:])", r"\\\1", role)


def parse(formatted: str) -> list[tuple[str, str, int, int]]:
    """Turns of a formatted text: role, text, and the code points between which the text is written."""
    turns, place = [], 0
    while place < len(formatted):
        head = _ROLE.match(formatted, place)
        if not head:
            raise GrammarError(f"no turn begins at {place}")
        role = re.sub(r"\\(.)", r"\1", head[1], flags=re.DOTALL)
        place = start = head.end()
        parts: list[str] = []
        for control in _CONTROL.finditer(formatted, place):
            slashes = len(control[1])
            parts.append(formatted[place : control.start()] + "\\" * (slashes // 2))
            place = control.end()
            if slashes % 2:
                parts.append(control[2])
            elif control[2] == CLOSE:
                break
            else:
                raise GrammarError(f"{OPEN} inside the turn at {start}")
        else:
            raise GrammarError(f"the turn at {start} does not end")
        if not formatted.startswith("\n", place):
            raise GrammarError(f"no line feed at {place}")
        turns.append((role, "".join(parts), start, place - len(CLOSE)))
        place += 1
    return turns


def render(role: str, text: str) -> tuple[str, int, int]:
    """One formatted turn that parses back to ``role`` and ``text``, and the place of the text in it."""
    head = f"{OPEN} {escaped_role(role)}: "
    for body in (text, escaped(text)):
        line = f"{head}{body}{CLOSE}\n"
        place = len(head), len(head) + len(body)
        try:
            if parse(line) == [(role, text, *place)]:
                return line, *place
        except GrammarError:
            pass
    raise GrammarError("escaping must round-trip")


def format_turns(rows: DataFrame, learn: str = "assistant", conversation: str = "conv_id") -> DataFrame:
    """``conv_id, turn, line, mask_start, mask_stop`` for each row, without a shuffle.

    A conversation's formatted text is its lines in the order of turn, then line (ties, repeated turns).
    The loss mask covers the code points from ``mask_start`` to ``mask_stop`` of a line: the text of a turn whose role is
    ``learn``; both are 0 elsewhere. A null role or text counts as empty; null ids form one conversation,
    null turns come first.
    """
    schema = (
        StructType()
        .add(conversation, rows.schema[conversation].dataType)
        .add("turn", rows.schema["turn"].dataType)
        .add("line", "string")
        .add("mask_start", "long")
        .add("mask_stop", "long")
    )

    def work(batches: Rows) -> Rows:
        for batch in batches:
            made = [render(r or "", t or "") for r, t in zip(batch["role"], batch["text"])]
            masks = [m[1:] if r == learn else (0, 0) for r, m in zip(batch["role"], made)]
            yield {
                conversation: batch[conversation],
                "turn": batch["turn"],
                "line": [m[0] for m in made],
                "mask_start": [m[0] for m in masks],
                "mask_stop": [m[1] for m in masks],
            }

    return map_batches(rows.select(conversation, "turn", "role", "text"), work, schema)


class Digest:
    """Running digests of one conversation; holds no text."""

    def __init__(self) -> None:
        self.turns = self.loss_chars = self.chars = 0
        self.all, self.loss = sha256(), sha256()

    def add(self, line: str, start: int, stop: int) -> None:
        for role, text, _, _ in parse(line):
            self.turns += 1
            self.all.update(f"{role}\n{text}\n".encode())
        if stop > start:
            # What the mask covers is unescaped by the parser, as the text of a turn.
            masked = parse(f"{OPEN} : {line[start:stop]}{CLOSE}\n")[0][1]
            self.loss_chars += len(masked)
            self.loss.update(masked.encode())
        self.chars += len(line)


def read_back(lines: DataFrame, conversation: str = "conv_id") -> DataFrame:
    """Per conversation: turns, digest of roles and texts, masked code points and their digest, formatted length.

    All of it is parsed from the lines of ``format_turns``. Conversations are sorted within shuffle partitions
    and streamed, so that not even a conversation with a third of all rows has to fit in memory.
    """
    kind = lines.schema[conversation].dataType
    schema = (
        StructType()
        .add(conversation, kind)
        .add("n_turns", "long")
        .add("turns_sha256", "string")
        .add("loss_chars", "long")
        .add("loss_sha256", "string")
        .add("formatted_chars", "long")
    )

    def finished(done: list[tuple[object, Digest]]) -> dict[str, list]:
        return {
            conversation: [c for c, _ in done],
            "n_turns": [d.turns for _, d in done],
            "turns_sha256": [d.all.hexdigest() for _, d in done],
            "loss_chars": [d.loss_chars for _, d in done],
            "loss_sha256": [d.loss.hexdigest() for _, d in done],
            "formatted_chars": [d.chars for _, d in done],
        }

    def work(batches: Rows) -> Iterator[dict[str, list]]:
        done: list[tuple[object, Digest]] = []
        for batch in batches:
            for id, *line in zip(batch[conversation], batch["line"], batch["mask_start"], batch["mask_stop"]):
                if not done or done[-1][0] != id:
                    done.append((id, Digest()))
                done[-1][1].add(*line)
            yield finished(done[:-1])
            done = done[-1:]
        yield finished(done)

    ordered = lines.repartition(F.col(conversation)).sortWithinPartitions(conversation, "turn", "line")
    return map_batches(ordered.select(conversation, "line", "mask_start", "mask_stop"), work, schema)
