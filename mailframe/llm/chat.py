"""Chat formatting with a grammar round trip.

A turn is rendered as ``<|im_start|>ROLE\\nTEXT<|im_end|>\\n``.  A deterministic parser
reads the rendered turn back; when role and text do not come back as they were, the
conflicting content is escaped further and tried again until they do.  Escaping puts one
more backslash behind ``<|`` of anything that looks like a control string, so that it can
always be taken out again; in roles a backslash, line end or ``<`` is written by its code.

Turns stream in order through one pass per partition: a conversation of any length needs
the memory of one turn and of two running digests.

Defined results: null text and null role are empty; a null ``conv_id`` is a conversation
of its own; of equal turn numbers the smaller role, then text comes first; repeated rows
are repeated turns; an empty table gives no rows; other columns, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
_CONTROL = re.compile(r"<\|(\\*)(im_start|im_end)\|>")
_ESCAPED = re.compile(r"<\|\\(\\*)(im_start|im_end)\|>")
_TURN = re.compile(r"<\|im_start\|>((?:(?!<\|im_(?:start|end)\|>)[^\n])*)\n((?:(?!<\|im_(?:start|end)\|>).)*)<\|im_end\|>\n", re.S)
_ROLE_CODE = re.compile(r"\\u([0-9a-f]{4})")


def escape_text(text: str) -> str:
    return _CONTROL.sub(r"<|\\\1\2|>", text)


def unescape_text(text: str) -> str:
    return _ESCAPED.sub(r"<|\1\2|>", text)


def escape_role(role: str) -> str:
    return re.sub(r"[\\\n<]", lambda m: f"\\u{ord(m[0]):04x}", role)


def unescape_role(role: str) -> str:
    return _ROLE_CODE.sub(lambda m: chr(int(m[1], 16)), role)


def parse_turns(rendered: str) -> list[tuple[str, str]] | None:
    """Turns of a rendered text, unescaped; None if it is not a sequence of turns."""
    turns, at = [], 0
    while at < len(rendered):
        m = _TURN.match(rendered, at)
        if m is None:
            return None
        turns.append((unescape_role(m[1]), unescape_text(m[2])))
        at = m.end()
    return turns


def render_turn(role: str, text: str) -> str:
    """Rendered turn; escapes only as far as the parser needs to give the source back."""
    shown_role, shown_text = role, text
    for _ in range(3):
        rendered = f"{START}{shown_role}\n{shown_text}{END}\n"
        back = parse_turns(rendered)
        if back == [(role, text)]:
            return rendered
        if back is None or len(back) != 1 or back[0][1] != text:
            shown_text = escape_text(text)
        if back is None or len(back) != 1 or back[0][0] != role:
            shown_role = escape_role(role)
    raise ValueError("a turn cannot be written reversibly")


def format_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, rendered) in conversation order within partitions."""
    rows = conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce(F.col("role"), F.lit("")).alias("role"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )

    def render(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield pd.DataFrame({"conv_id": f["conv_id"].astype("Int64"), "rendered": [render_turn(r, t) for r, t in zip(f["role"], f["text"], strict=True)]})

    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.mapInPandas(render, "conv_id bigint, rendered string")


class _Conversation:
    """What is read back from the rendered turns of one conversation."""

    def __init__(self):
        self.turns = self.loss_chars = self.chars = 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, rendered: str) -> None:
        self.chars += len(rendered)
        for role, text in parse_turns(rendered):
            self.turns += 1
            self.all.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
            if role == "assistant":
                self.loss_chars += len(text)
                self.loss.update(text.encode("utf-8", "surrogatepass"))

    def row(self, conv) -> tuple:
        return conv, self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


_READ = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"


def read_back(formatted: DataFrame) -> DataFrame:
    """One row per conversation, parsed from ``format_turns`` output (which keeps a conversation together and in order)."""

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in _READ.split(", ")]
        kinds = {n: "Int64" for n in names if not n.endswith("sha256")}
        current, state = (), None
        for f in frames:
            done = []
            for conv, rendered in zip(f["conv_id"], f["rendered"], strict=True):
                conv = None if pd.isna(conv) else int(conv)
                if current != (conv,):
                    if state is not None:
                        done.append(state.row(current[0]))
                    current, state = (conv,), _Conversation()
                state.add(rendered)
            yield pd.DataFrame(done, columns=names).astype(kinds)
        if state is not None:
            yield pd.DataFrame([state.row(current[0])], columns=names).astype(kinds)

    return formatted.mapInPandas(read, _READ)
