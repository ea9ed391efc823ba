"""Chat formatting of conversations with typed content parts.

A turn is a role and an ordered list of parts: text, image, audio or document. A visitor
flattens them into one text in which every attachment is a placeholder, and records
what each placeholder refers to and how many tokens it will expand to. Turns are
marked by control strings; inside texts these are escaped so that the formatted
conversation can be read back exactly.

A conversation is formatted turn by turn as its sorted rows stream through a task, so a
conversation of any length needs the memory of one turn.
"""

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import groupby
from math import ceil
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from usagelens.llm.common import ship, text_of

TURN, SAID, END = "<|turn|>", "<|said|>", "<|end|>"

# What must not appear inside a text: this template's strings all begin with "<|"; the
# others are those of wide-spread templates.
_CONTROL = re.compile(r"<(?=\||/?s>|</?SYS>>)|\[(?=/?INST\])")
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_TURN = re.compile(re.escape(TURN) + "(.*?)" + re.escape(SAID) + "(.*?)" + re.escape(END), re.DOTALL)
_PLACEHOLDER = re.compile(r"<\|(?:image|audio|document|other):\d+\|>")

PART = "struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
FORMATTED = (
    "conv_id long, position long, role string, start long, formatted string, "
    "loss array<struct<start:long,length:long>>, "
    "attachments array<struct<number:long,type:string,ref:string,start:long,tokens:long>>"
)


def escape(text: str) -> str:
    """Doubles backslashes and breaks every control string by one; ``unescape`` undoes it."""
    return _CONTROL.sub(lambda m: m.group() + "\\", text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def escape_parts(texts: list[str]) -> list[str]:
    """The texts escaped such that, one after another, they are the escaped whole.

    A control string can begin in one text and end in a later one, so what is escaped is the
    whole, which is then cut where the texts end.
    """
    whole = "".join(texts)
    # Characters that get one more behind or before them.
    added = sorted({m.start() for m in _CONTROL.finditer(whole)} | {m.start() for m in re.finditer(r"\\", whole)})
    escaped, made, at, done = escape(whole), [], 0, 0
    for text in texts:
        at += len(text)
        end = at + bisect_left(added, at)
        made.append(escaped[done:end])
        done = end
    return made


@dataclass(frozen=True)
class Expansion:
    """Tokens an attachment expands to: per image patch, second of audio and document page."""

    patch: int = 28
    per_second: float = 12.5
    per_page: int = 1024

    def tokens(self, part: dict) -> int:
        kind = part["type"]
        if kind == "image":
            return ceil((part["width"] or 0) / self.patch) * ceil((part["height"] or 0) / self.patch)
        if kind == "audio":
            return ceil((part["seconds"] or 0) * self.per_second)
        if kind == "document":
            return (part["pages"] or 0) * self.per_page
        return 0


class Attachment(NamedTuple):
    number: int
    type: str
    ref: str | None
    start: int
    tokens: int


@dataclass
class Flattener:
    """Visits the parts of one conversation's turns; offsets and numbers run through it."""

    expansion: Expansion = field(default_factory=Expansion)
    trained: tuple[str, ...] = ("assistant",)
    at: int = 0
    count: int = 0

    def turn(self, role: str, parts: list[dict]) -> dict:
        """The formatted turn, its text spans under the loss mask, and its attachments."""
        start, pieces, loss, attachments = self.at, [], [], []
        self._emit(pieces, TURN + escape(role) + SAID)
        mask = loss if role in self.trained else []
        # Neighbouring texts are escaped together.
        for is_text, run in groupby(parts, key=lambda part: part["type"] == "text"):
            run = list(run)
            escaped = escape_parts([part["text"] or "" for part in run]) if is_text else run
            for part in escaped:
                visit = self.visit_text if is_text else getattr(self, f"visit_{part['type']}", self.visit_other)
                visit(part, pieces, mask, attachments)
        self._emit(pieces, END)
        return {
            "role": role,
            "start": start,
            "formatted": "".join(pieces),
            "loss": loss,
            "attachments": attachments,
        }

    def _emit(self, pieces: list[str], text: str) -> None:
        pieces.append(text)
        self.at += len(text)

    def visit_text(self, escaped, pieces, loss, attachments):
        if escaped:
            loss.append({"start": self.at, "length": len(escaped)})
        self._emit(pieces, escaped)

    def visit_image(self, part, pieces, loss, attachments):
        kind = part["type"] if part["type"] in ("image", "audio", "document") else "other"
        found = Attachment(self.count, kind, part["ref"], self.at, self.expansion.tokens(part))
        attachments.append(found._asdict())
        self._emit(pieces, f"<|{kind}:{self.count}|>")
        self.count += 1

    visit_audio = visit_document = visit_other = visit_image


def read_back(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of every turn of a formatted text, without placeholders."""
    return [
        (unescape(role), unescape(_PLACEHOLDER.sub("", said))) for role, said in _TURN.findall(formatted)
    ]


def _in_order(conversations: DataFrame, parts_col: str | None) -> DataFrame:
    """Rows by conversation and turn; each conversation within one partition."""
    role = F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role")
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        role,
        text_of("text").alias("text"),
        (F.col(parts_col).cast(f"array<{PART}>") if parts_col else F.lit(None).cast(f"array<{PART}>")).alias(
            "parts"
        ),
    )
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")


def _turns(batches: Iterator[pa.RecordBatch], expansion: Expansion, trained) -> Iterator[tuple]:
    """(conv_id, position, formatted turn), with one conversation open at a time."""
    last, flat, position = None, None, 0
    for batch in batches:
        for row in batch.to_pylist():
            if flat is None or row["conv_id"] != last:
                last, flat, position = row["conv_id"], Flattener(expansion, trained), 0
            parts = row["parts"]
            if parts is None:
                parts = [{"type": "text", "text": row["text"]}]
            parts = [p for p in parts if p is not None]
            yield last, position, flat.turn(row["role"], parts)
            position += 1


def format_conversations(
    conversations: DataFrame,
    parts_col: str | None = None,
    expansion: Expansion = Expansion(),
    trained: tuple[str, ...] = ("assistant",),
) -> DataFrame:
    """One row per turn with its part of the formatted conversation.

    A conversation's text is its ``formatted`` values one after another by ``position``;
    ``start``, ``loss`` (the texts of ``trained`` roles) and the places of
    ``attachments`` count code points in it. ``parts_col`` names an array of ``PART``; a row
    without (NULL) has its ``text`` as its only part. NULL text and role count as empty,
    NULL turns come first, and rows repeated or with equal turns follow by role and text.
    Rows with a NULL ``conv_id`` form one conversation. Parts of unknown type become
    attachments of type other. An empty table gives no rows, and other columns are not read.
    """
    ship(conversations.sparkSession)
    schema = to_arrow_schema(StructType.fromDDL(FORMATTED))

    def run(batches):
        rows = []
        for conv_id, position, turn in _turns(batches, expansion, trained):
            rows.append({"conv_id": conv_id, "position": position, **turn})
            if len(rows) == 1000:
                yield pa.RecordBatch.from_pylist(rows, schema=schema)
                rows = []
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return _in_order(conversations, parts_col).mapInArrow(run, FORMATTED)


class _Digest:
    """What is read back from the turns of one conversation, as they come."""

    def __init__(self, conv_id):
        self.conv_id, self.turns, self.loss_chars, self.chars = conv_id, 0, 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, turn: dict) -> None:
        formatted = turn["formatted"]
        for role, text in read_back(formatted):
            self.turns += 1
            self.all.update(f"{role}\n{text}\n".encode())
        for span in turn["loss"]:
            begin = span["start"] - self.chars
            text = unescape(formatted[begin : begin + span["length"]])
            self.loss_chars += len(text)
            self.loss.update(text.encode())
        self.chars += len(formatted)

    def row(self) -> tuple:
        return (
            self.conv_id,
            self.turns,
            self.all.hexdigest(),
            self.loss_chars,
            self.loss.hexdigest(),
            self.chars,
        )


def conversation_digests(
    conversations: DataFrame, parts_col: str | None = None, trained: tuple[str, ...] = ("assistant",)
) -> DataFrame:
    """Per conversation, digests of what is read back from its formatted text.

    (conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars). Turns are
    read back from the formatted text, and the loss text from its spans, while the
    turns stream by. Defined for the same cases as ``format_conversations``.
    """
    ship(conversations.sparkSession)
    ddl = (
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
        "loss_sha256 string, formatted_chars long"
    )
    schema = to_arrow_schema(StructType.fromDDL(ddl))

    def table(rows):
        columns = zip(*rows)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    def run(batches):
        rows, digest = [], None
        for conv_id, position, turn in _turns(batches, Expansion(), trained):
            if position == 0:
                if digest:
                    rows.append(digest.row())
                digest = _Digest(conv_id)
                if len(rows) >= 1000:
                    yield table(rows)
                    rows = []
            digest.add(turn)
        if digest:
            yield table([*rows, digest.row()])

    return _in_order(conversations, parts_col).mapInArrow(run, ddl)
