"""Conversations written through a turn template, with typed content parts and a loss mask.

A message's content is an array of parts ``(kind, text, ref, amount)``. A visitor turns each part
into a piece of the message: text is escaped; an image, audio clip or document becomes an ordered
placeholder ``<image:0>`` and leaves an attachment with its reference and the number of tokens it
expands to. Escaping puts a backslash before each control string and each backslash, so that a
reader can always tell template from text.

Output is one row per turn: the pieces of a conversation, joined by ``position``, are its formatted
text, and ``loss_start``/``loss_end`` are code point offsets into that text. A conversation is
streamed through a sorted partition turn by turn, so that even one that holds a third of all rows
is never held in memory.

Defined results: null text or content is empty, a null role is the empty role, null turns come
first, rows with equal turns are ordered by role and then text, rows with a null id form one
conversation of their own, an empty table gives no rows, further columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the template.
OPEN, CLOSE = "<turn>", "</turn>\n"
CONTROLS = ("<turn>", "</turn>", "<image:", "<audio:", "<document:", "### ")
LOSS_ROLE = "assistant"
PART = "array<struct<kind:string,text:string,ref:string,amount:double>>"
# Tokens that one unit of an attachment expands to: an image patch of 14 x 14 pixels counted in
# megapixels, a second of audio, a page of a document.
TOKENS_PER_UNIT = {"image": 1e6 / 196, "audio": 25.0, "document": 700.0}

_TO_ESCAPE = re.compile(r"\\|" + "|".join(f"{re.escape(c[0])}(?={re.escape(c[1:])})" for c in CONTROLS))
_ESCAPED = re.compile(r"\\(.)", re.S)
_TURN = re.compile(r"<turn>((?:[^\\\n]|\\.)*)\n(.*)</turn>\n", re.S)


def escape(text: str) -> str:
    return _TO_ESCAPE.sub(r"\\\g<0>", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def escape_role(role: str) -> str:
    """A role ends at the first newline, so its own newlines are escaped as well."""
    return escape(role).replace("\n", "\\\n")


@dataclass
class Flattener:
    """Visits the parts of a conversation in order."""

    attachments: list[tuple[int, str, str | None, int]] = field(default_factory=list)

    def visit(self, part) -> str:
        if part is None:
            return ""
        return getattr(self, f"visit_{part['kind'] or 'text'}", self.visit_unknown)(part)

    def visit_text(self, part) -> str:
        return escape(part["text"] or "")

    def _placeholder(self, part) -> str:
        kind = part["kind"]
        number, amount = len(self.attachments), part["amount"]
        tokens = max(1, -int(-TOKENS_PER_UNIT[kind] * (amount or 0) // 1))
        self.attachments.append((number, kind, part["ref"], tokens))
        return f"<{kind}:{number}>"

    visit_image = visit_audio = visit_document = _placeholder

    def visit_unknown(self, part) -> str:
        """A kind that the template doesn't know is kept as its escaped text."""
        return self.visit_text(part)


PIECES = (
    "conv_id long, position long, turn long, role string, formatted string, loss_start long, "
    "loss_end long, attachments array<struct<number:int,kind:string,ref:string,tokens:int>>"
)


def _format(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    current, position, offset, flat = object(), 0, 0, Flattener()
    for batch in batches:
        out = []
        for conv, turn, role, text, content in zip(
            batch["_conv"], batch["_turn"], batch["_role"], batch["_text"], batch["_content"]
        ):
            if conv != current:
                current, position, offset, flat = conv, 0, 0, Flattener()
            seen = len(flat.attachments)
            parts = content if content is not None else [{"kind": "text", "text": text}]
            body = "".join(flat.visit(p) for p in parts)
            head = f"{OPEN}{escape_role(role)}\n"
            piece = f"{head}{body}{CLOSE}"
            loss = role == LOSS_ROLE
            start = offset + len(head) if loss else None
            out.append(
                (
                    int(conv) if conv else None,
                    position,
                    int(turn) if turn else None,
                    role,
                    piece,
                    start,
                    start + len(body) if loss else None,
                    flat.attachments[seen:],
                )
            )
            position, offset = position + 1, offset + len(piece)
        names = [c.split()[0] for c in PIECES.split(", ")]
        frame = pd.DataFrame(out, columns=names)
        for name in ("conv_id", "turn", "loss_start", "loss_end"):
            frame[name] = frame[name].astype("Int64")
        yield frame


def format_turns(
    messages: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str | None = "text",
    content: str | None = None,
) -> DataFrame:
    """One row per message with its formatted piece, loss span and attachments.

    ``content`` names a column of typed parts; a message without it is its ``text`` alone.
    """
    body = F.col(text) if text else F.lit(None).cast("string")
    rows = messages.select(
        F.coalesce(F.col(conv).cast("string"), F.lit("")).alias("_conv"),
        F.coalesce(F.col(turn).cast("string"), F.lit("")).alias("_turn"),
        F.col(turn).cast("long").alias("_order"),
        F.coalesce(F.col(role), F.lit("")).alias("_role"),
        F.coalesce(body, F.lit("")).alias("_text"),
        (F.col(content) if content else F.lit(None)).cast(PART).alias("_content"),
    )
    ordered = rows.repartition("_conv").sortWithinPartitions(
        "_conv", "_order", "_role", "_text", F.to_json(F.struct("_content"))
    )
    return ordered.mapInPandas(_format, PIECES)


def _read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    current, row = object(), None
    out: list[tuple] = []

    def close():
        turns, n, loss, chars, size, tokens = row
        out.append((None if current == "" else int(current), n, turns.hexdigest(), chars, loss.hexdigest(), size, tokens))

    for batch in batches:
        for conv, piece, start, end, refs in zip(
            batch["_conv"], batch["formatted"], batch["loss_start"], batch["loss_end"], batch["_tokens"]
        ):
            if conv != current:
                if row:
                    close()
                current, row = conv, [hashlib.sha256(), 0, hashlib.sha256(), 0, 0, 0]
            role, body = _TURN.fullmatch(piece).groups()
            row[0].update(f"{unescape(role)}\n{unescape(body)}\n".encode())
            row[1] += 1
            if not pd.isna(start):
                masked = unescape(piece[int(start) - row[4] : int(end) - row[4]])
                row[2].update(masked.encode())
                row[3] += len(masked)
            row[4] += len(piece)
            row[5] += int(refs)
        if len(out) >= 5000:
            yield pd.DataFrame(out)
            out.clear()
    if row:
        close()
    yield pd.DataFrame(out, columns=range(7))


DIGESTS = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
    "formatted_chars long, attachment_tokens long"
)


def read_back(pieces: DataFrame, ordered: bool = False) -> DataFrame:
    """Per conversation what a reader of the formatted pieces and the mask finds.

    ``ordered``: the pieces come straight from ``format_turns``, whose partitions hold whole
    conversations in order, so they need no shuffle of their own.
    """
    rows = pieces.select(
        F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("_conv"),
        "position",
        "formatted",
        "loss_start",
        "loss_end",
        F.aggregate("attachments", F.lit(0).cast("long"), lambda a, x: a + x["tokens"]).alias("_tokens"),
    )
    if not ordered:
        rows = rows.repartition("_conv").sortWithinPartitions("_conv", "position")
    return rows.mapInPandas(_read, DIGESTS)


def parts_json(parts: list[dict]) -> str:
    """Parts as JSON, for callers that hold content as text (``from_json`` with ``PART``)."""
    return json.dumps([{k: p.get(k) for k in ("kind", "text", "ref", "amount")} for p in parts])
