"""Chat formatting by a grammar round trip.

Template of one turn::

    ### role: text
    </turn>

Control strings are ``###`` and ``</turn>``; one that a backslash precedes is text. A rendered turn
is parsed again by the deterministic parser, and while the recovered turn is not identical to the
source, the control strings in its text are escaped by one backslash more. The parser takes one
backslash off each escaped control string, so escaping is reversible whatever a text holds.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START, END = "### ", "\n</turn>\n"
_CONTROL = re.compile(r"(\\*)(###|</turn>)")
_ESCAPED = re.compile(r"\\(\\*(?:###|</turn>))")
_PLAIN_ROLE = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")
_ROLE = re.compile(r'### (?:([A-Za-z_][A-Za-z0-9_]*)|("(?:[^"\\]|\\.)*")): ', re.DOTALL)

SCHEMA = (
    "conv_id long, formatted string, "
    "turns array<struct<role: string, text: string>>, loss_spans array<struct<start: int, end: int>>"
)


class NotChat(ValueError):
    """The text does not follow the grammar."""


def escape(text: str) -> str:
    return _CONTROL.sub(r"\\\1\2", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def render_turn(role: str, text: str) -> str:
    name = role if _PLAIN_ROLE.fullmatch(role) else json.dumps(role)
    return f"{START}{name}: {text}{END}"


def parse(formatted: str) -> list[tuple[str, str, int, int]]:
    """(role, text, start, end) of each turn: the text unescaped, and where it stands."""
    turns, at = [], 0
    while at < len(formatted):
        head = _ROLE.match(formatted, at)
        if head is None:
            raise NotChat(f"no turn starts at {at}")
        role = head.group(1) if head.group(1) is not None else json.loads(head.group(2))
        start = head.end()
        for mark in _CONTROL.finditer(formatted, start):
            if not mark.group(1):
                break
        else:
            raise NotChat(f"the turn from {at} does not end")
        end = mark.start() - 1
        if end < start or not formatted.startswith(END, end):
            raise NotChat(f"stray control string at {mark.start()}")
        turns.append((role, unescape(formatted[start:end]), start, end))
        at = end + len(END)
    return turns


def format_turn(role: str, text: str) -> str:
    """The rendered turn that parses back to exactly this turn."""
    body = text
    while True:
        rendered = render_turn(role, body)
        try:
            if [t[:2] for t in parse(rendered)] == [(role, text)]:
                return rendered
        except NotChat:
            pass
        escaped = escape(body)
        if escaped == body:
            raise ValueError("a turn without control strings must parse back")
        body = escaped


def formatted_conversation(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[str, str]], list[tuple[int, int]]]:
    """Formatted text, turns read back from it, and the spans under the loss mask: assistant texts."""
    whole = "".join([format_turn(role, text) for role, text in turns])
    read = parse(whole)
    if [t[:2] for t in read] != turns:
        raise ValueError("a conversation must parse back to its turns")
    return whole, [t[:2] for t in read], [(t[2], t[3]) for t in read if t[0] == "assistant"]


def conversations(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation: conv_id, the formatted text, the turns read back from it and the
    spans of its text under the loss mask.

    Turns are in order of ``turn``; ties by role and text, and a null turn first. A null text or
    role is empty. Repeated rows are turns of their own. Rows without a conversation id form one
    conversation with a null id. Other columns are ignored; an empty table gives no rows.

    A conversation is one result row, so its turns are gathered; nothing else is.
    """
    turns = rows.select(
        F.col(f"`{conv}`").cast("long").alias("conv_id"),
        F.struct(
            F.col(f"`{turn}`").alias("turn"),
            F.coalesce(F.col(f"`{role}`"), F.lit("")).alias("role"),
            F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
        ).alias("t"),
    )
    gathered = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    gathered = gathered.select("conv_id", F.col("turns.role").alias("roles"), F.col("turns.text").alias("texts"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [
                formatted_conversation(list(zip(roles, texts)))
                for roles, texts in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([m[0] for m in made], pa.string()),
                    pa.array(
                        [[{"role": r, "text": t} for r, t in m[1]] for m in made],
                        pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())])),
                    ),
                    pa.array(
                        [[{"start": a, "end": b} for a, b in m[2]] for m in made],
                        pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])),
                    ),
                ],
                names=["conv_id", "formatted", "turns", "loss_spans"],
            )

    return gathered.mapInArrow(run, SCHEMA)


def digests(made: DataFrame) -> DataFrame:
    """Counts and digests of ``conversations``, all read back from the formatted text and its mask."""
    spelt = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    under = F.transform("loss_spans", lambda s: F.substring(F.col("formatted"), s["start"] + 1, s["end"] - s["start"]))
    # the parser's rule: one backslash less before an escaped control string
    loss = F.array_join(F.transform(under, lambda t: F.regexp_replace(t, r"\\(\\*(?:###|</turn>))", "$1")), "")
    return made.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(spelt, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
