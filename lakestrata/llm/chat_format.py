"""Chat formatting with typed content parts.

A conversation is a list of turns; a turn is a role and a list of parts of
type ``text``, ``image``, ``audio`` or ``document``.  A visitor flattens the
parts in order into one string: texts are escaped and kept, any other part
becomes a placeholder.  For each attachment it records kind, reference, the
placeholder's position and the number of tokens the placeholder expands to.

A turn is formatted as

    <|turn|>ROLE<|text|>CONTENT<|end|>

and a conversation is its turns, in order, with nothing between them.  No
control string can appear inside ROLE or a text part: one backslash is put
after the first character of each control string, also of those that already
carry backslashes there, so that removing one gives the text back.

Rows: ``format_turns`` works row by row without a shuffle; ``read_back`` deals
rows by conversation, sorts them and joins them to one stream of characters, off
which the turns are read by their marks alone.  Only a turn that has not ended
is held, so that memory does not grow with the length of a conversation (a
digest is sequential by nature).

Defined cases: null role, text or parts are empty; a null part type is
``text``, an unknown one is a ``document``; a null conversation id is one
conversation; null turns come first; rows with equal turn are ordered by role,
then by content, and none is dropped; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections import deque
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The template's own marks, and control strings of other
#: templates that must not reach a model from inside a text.
TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
PLACEHOLDERS = {"image": "<|image|>", "audio": "<|audio|>", "document": "<|document|>"}
FOREIGN = ("<s>", "</s>", "[INST]", "[/INST]", "<|im_start|>", "<|im_end|>", "<|endoftext|>", "<|startoftext|>")
CONTROLS = (TURN, TEXT, END, *PLACEHOLDERS.values(), *FOREIGN)

#: Tokens that one attachment of each kind takes when its part says nothing.
EXPANSION = {"image": 576, "audio": 750, "document": 1024}

_TAILS = "|".join(sorted((re.escape(c[1:]) for c in CONTROLS), key=len, reverse=True))
_PLAIN = re.compile(rf"([<\[])(\\*)(?={_TAILS})")
_ESCAPED = re.compile(rf"([<\[])\\(\\*)(?={_TAILS})")
_MARKS = re.compile("|".join(map(re.escape, PLACEHOLDERS.values())))

PART = "struct<type:string,text:string,ref:string,tokens:int>"
SPAN = pa.struct([("start", pa.int32()), ("length", pa.int32())])
ATTACHMENT = pa.struct([("kind", pa.string()), ("ref", pa.string()), ("position", pa.int32()), ("tokens", pa.int32())])
FORMATTED = pa.schema([
    ("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("formatted", pa.string()),
    ("loss", pa.list_(SPAN)), ("attachments", pa.list_(ATTACHMENT)),
])
FORMATTED_DDL = (
    "conv_id long, turn long, role string, formatted string, loss array<struct<start:int,length:int>>, "
    "attachments array<struct<kind:string,ref:string,position:int,tokens:int>>"
)
DIGESTS = pa.schema([
    ("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
    ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()), ("n_attachments", pa.int64()), ("attachment_tokens", pa.int64()),
])
DIGESTS_DDL = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
    "formatted_chars long, n_attachments long, attachment_tokens long"
)


def escape(text: str) -> str:
    return _PLAIN.sub(r"\1\\\2", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2", text)


class Flattener:
    """Visits the parts of one turn, in order."""

    def __init__(self, offset: int, learn: bool):
        self.pieces: list[str] = []
        self.at, self.learn = offset, learn
        self.loss: list[dict] = []
        self.attachments: list[dict] = []

    def visit(self, part: dict) -> None:
        kind = (part.get("type") or "text").lower()
        getattr(self, f"visit_{kind}", self.visit_document)(part)

    def visit_text(self, part: dict) -> None:
        text = escape(part.get("text") or "")
        if text and self.learn:
            self.loss.append({"start": self.at, "length": len(text)})
        self._put(text)

    def visit_image(self, part: dict) -> None:
        self._attach("image", part)

    def visit_audio(self, part: dict) -> None:
        self._attach("audio", part)

    def visit_document(self, part: dict) -> None:
        self._attach("document", part)

    def _attach(self, kind: str, part: dict) -> None:
        tokens = part.get("tokens")
        tokens = EXPANSION[kind] if tokens is None else int(tokens)
        self.attachments.append({"kind": kind, "ref": part.get("ref"), "position": self.at, "tokens": tokens})
        self._put(PLACEHOLDERS[kind])

    def _put(self, piece: str) -> None:
        self.pieces.append(piece)
        self.at += len(piece)


def joined_texts(parts: Iterable[dict | None]) -> Iterator[dict]:
    """The parts, neighbouring texts as one: two texts that are harmless alone
    can form a control string together."""
    text: str | None = None
    for part in parts:
        part = part or {}
        if (part.get("type") or "text").lower() == "text":
            text = (text or "") + (part.get("text") or "")
            continue
        if text is not None:
            yield {"type": "text", "text": text}
            text = None
        yield part
    if text is not None:
        yield {"type": "text", "text": text}


def format_turn(role: str | None, parts: list[dict] | None, learned_role: str = "assistant") -> dict:
    head = f"{TURN}{escape(role or '')}{TEXT}"
    flat = Flattener(len(head), role == learned_role)
    for part in joined_texts(parts or ()):
        flat.visit(part)
    return {"formatted": f"{head}{''.join(flat.pieces)}{END}", "loss": flat.loss, "attachments": flat.attachments}


def parse_turn(formatted: str) -> tuple[str, str]:
    """Role and text of a formatted turn; placeholders are left out."""
    head, _, rest = formatted.removeprefix(TURN).partition(TEXT)
    body = rest[: len(rest) - len(END)]
    return unescape(head), "".join(unescape(x) for x in _MARKS.split(body))


class TurnReader:
    """Reads the turns off one conversation, given in chunks that may be cut
    anywhere; only a turn that has not ended yet is held."""

    def __init__(self):
        self.held: list[str] = []
        self.at = 0  # where the held text starts in the conversation

    def feed(self, chunk: str) -> Iterator[tuple[int, str]]:
        """(start in the conversation, formatted turn) of each turn that ends in
        ``chunk``.  An end mark inside a text is escaped, so the first is the turn's."""
        tail = ""
        for piece in reversed(self.held):  # the last code points held: a mark may be cut
            tail = (piece + tail)[1 - len(END) :]
            if len(tail) == len(END) - 1:
                break
        self.held.append(chunk)
        if END not in tail + chunk:
            return
        *turns, rest = "".join(self.held).split(END)
        self.held = [rest] if rest else []
        for turn in turns:
            if not turn.startswith(TURN) or TEXT not in turn:
                raise ValueError(f"no turn at {self.at}")
            yield self.at, turn + END
            self.at += len(turn) + len(END)

    def close(self) -> None:
        if self.held:
            raise ValueError(f"a turn at {self.at} has no end")


class Digests:
    """What one conversation says, read back from its text and loss spans."""

    def __init__(self, conv_id: int | None):
        self.row = dict.fromkeys(DIGESTS.names, 0) | {"conv_id": conv_id}
        self.turns, self.learned = hashlib.sha256(), hashlib.sha256()
        self.reader, self.spans = TurnReader(), deque()

    def add(self, chunk: str, loss: list[dict], attachments: list[dict]) -> None:
        row = self.row
        self.spans.extend((row["formatted_chars"] + x["start"], x["length"]) for x in loss)
        row["formatted_chars"] += len(chunk)
        row["n_attachments"] += len(attachments)
        row["attachment_tokens"] += sum(x["tokens"] for x in attachments)
        for at, turn in self.reader.feed(chunk):
            role, text = parse_turn(turn)
            row["n_turns"] += 1
            self.turns.update(f"{role}\n{text}\n".encode())
            while self.spans and self.spans[0][0] < at + len(turn):
                start, length = self.spans.popleft()
                learned = unescape(turn[start - at : start - at + length])
                row["loss_chars"] += len(learned)
                self.learned.update(learned.encode())

    def finish(self) -> dict:
        self.reader.close()
        return self.row | {"turns_sha256": self.turns.hexdigest(), "loss_sha256": self.learned.hexdigest()}


def as_parts(turns: DataFrame) -> DataFrame:
    """Plain rows (conv_id, turn, role, text) as turns of one text part."""
    part = F.struct(
        F.lit("text").alias("type"), F.coalesce("text", F.lit("")).alias("text"),
        F.lit(None).cast("string").alias("ref"), F.lit(None).cast("int").alias("tokens"),
    )
    return turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", F.array(part).alias("parts"))


def format_turns(turns: DataFrame, learned_role: str = "assistant") -> DataFrame:
    """One formatted row for each row of (conv_id, turn, role, parts), with
    loss spans and attachments in code points of ``formatted``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            yield pa.RecordBatch.from_pylist(
                [x | {"role": x["role"] or ""} | format_turn(x["role"], x.pop("parts"), learned_role) for x in rows], schema=FORMATTED
            )

    slim = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role",
        F.col("parts").cast(f"array<{PART}>").alias("parts"),
    )
    return slim.mapInArrow(run, FORMATTED_DDL)


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of each conversation, parsed from its turns joined in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Digests | None = None
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if held is None or held.row["conv_id"] != row["conv_id"]:
                    if held is not None:
                        out.append(held.finish())
                    held = Digests(row["conv_id"])
                held.add(row["formatted"], row["loss"], row["attachments"])
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=DIGESTS)
        if held is not None:
            yield pa.RecordBatch.from_pylist([held.finish()], schema=DIGESTS)

    dealt = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "formatted")
    return dealt.select("conv_id", "formatted", "loss", "attachments").mapInArrow(run, DIGESTS_DDL)
