"""Chat formatting of turns with typed content parts.

A visitor walks the parts of each turn: text is escaped and kept, an image,
audio clip or document becomes a placeholder in its place, and its reference
and the number of tokens it expands to are recorded in order.  Turns are
marked as

    <|im_start|>role\\n ... <|im_end|>\\n

Control strings start with ``<|``.  In texts and roles, ``<``, any number of
backslashes and ``|`` get one more backslash after the ``<``, so no text holds
``<|`` and unescaping gives the text back exactly.  Line feeds and backslashes
in roles are written as ``\\n`` and ``\\\\``.

The loss mask covers the texts of assistant turns, as code point ranges of the
turn's formatted string.

Null texts and roles are taken as empty; a turn without parts is empty; a part
of an unknown kind counts as text.  Turns of a conversation go by turn (nulls
first), then role and text.  Rows are formatted one by one, so a conversation
of any length needs no more memory than one turn.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shuffle_width, written

START, END = "<|im_start|>", "<|im_end|>"  # fixed values
PARTS = "array<struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>>"
_PLAIN, _ESCAPED = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")


def escape(text: str) -> str:
    return _PLAIN.sub(r"<\\\1|", text) if "|" in text else text


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text) if "|" in text else text


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role), flags=re.S)


class PartVisitor:
    """Flattens the parts of a turn; subclass it to change placeholders or token counts."""

    patch, tokens_per_second, tokens_per_page = 14, 25, 512

    def __init__(self):
        self.pieces: list[tuple[str, bool]] = []  # (string, whether it is text)
        self.attachments: list[dict] = []

    def visit(self, part: dict) -> None:
        getattr(self, f"visit_{part.get('kind')}", self.visit_text)(part)

    def visit_text(self, part: dict) -> None:
        self.pieces.append((escape(part.get("text") or ""), True))

    def visit_image(self, part: dict) -> None:
        across, down = (math.ceil(max(1, part.get(k) or 1) / self.patch) for k in ("width", "height"))
        self.attach("image", part, across * down)

    def visit_audio(self, part: dict) -> None:
        self.attach("audio", part, max(1, math.ceil((part.get("seconds") or 0) * self.tokens_per_second)))

    def visit_document(self, part: dict) -> None:
        self.attach("document", part, max(1, part.get("pages") or 1) * self.tokens_per_page)

    def attach(self, kind: str, part: dict, n_tokens: int) -> None:
        self.pieces.append((f"<|{kind}|>", False))
        self.attachments.append({"kind": kind, "ref": part.get("ref"), "n_tokens": n_tokens})


def format_turn(role: str | None, parts: list[dict] | None, visitor: type[PartVisitor] = PartVisitor,
                learned: str = "assistant") -> dict:
    """formatted, attachments and loss (code point ranges) of one turn."""
    role, walk = role or "", visitor()
    for part in parts or []:
        walk.visit(part or {})
    out, loss = f"{START}{escape_role(role)}\n", []
    pieces = [out]
    at = len(out)
    for piece, is_text in walk.pieces:
        if is_text and piece and role == learned:
            loss.append({"start": at, "end": at + len(piece)})
        pieces.append(piece)
        at += len(piece)
    pieces.append(f"{END}\n")
    return {"formatted": "".join(pieces), "attachments": walk.attachments, "loss": loss}


def parse_turn(formatted: str) -> tuple[str, str]:
    """(role, text) of a formatted turn, unescaped; placeholders stay where they are."""
    head, _, body = formatted[len(START):].partition("\n")
    if not formatted.startswith(START) or not body.endswith(f"{END}\n"):
        raise ValueError("not a formatted turn")
    return unescape_role(head), unescape(body[:-len(END) - 1])


_ATTACHMENTS = pa.list_(pa.struct([("kind", pa.string()), ("ref", pa.string()), ("n_tokens", pa.int64())]))
_LOSS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def format_turns(turns: DataFrame, visitor: type[PartVisitor] = PartVisitor) -> DataFrame:
    """conv_id, turn, formatted, attachments, n_tokens (of attachments) and loss of every turn.

    ``turns`` has conv_id, turn, role and either ``parts`` or a plain ``text``.
    Each row is formatted where it is read; rows are then put in order by range
    of (conv_id, turn), which also spreads one very long conversation.
    """
    spark = turns.sparkSession
    kinds = {c.lower(): t for c, t in turns.dtypes}
    if "parts" in kinds:
        parts = F.col("parts").cast(PARTS)
    else:
        parts = F.array(F.struct(*(F.lit(v).cast(t).alias(n) if n != "text" else F.col("text").cast("string").alias("text")
                                   for n, v, t in (("kind", "text", "string"), ("text", None, "string"), ("ref", None, "string"),
                                                   ("width", None, "int"), ("height", None, "int"),
                                                   ("seconds", None, "double"), ("pages", None, "int")))))
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                        F.col("role").cast("string").alias("role"), parts.alias("parts"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 512):
                part = batch.slice(i, 512)
                done = [format_turn(r, p, visitor) for r, p in zip(part.column(2).to_pylist(), part.column(3).to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array([d["formatted"] for d in done], pa.string()),
                     pa.array([d["attachments"] for d in done], _ATTACHMENTS),
                     pa.array([sum(a["n_tokens"] for a in d["attachments"]) for d in done], pa.int64()),
                     pa.array([d["loss"] for d in done], _LOSS)],
                    ["conv_id", "turn", "formatted", "attachments", "n_tokens", "loss"])

    done = rows.mapInArrow(run, "conv_id long, turn long, formatted string, attachments "
                                "array<struct<kind:string,ref:string,n_tokens:long>>, n_tokens long, "
                                "loss array<struct<start:long,end:long>>")
    order = ["conv_id", "turn", "formatted"]
    return done.repartitionByRange(shuffle_width(spark), *order).sortWithinPartitions(*order)


def conversation_digests(formatted: DataFrame) -> DataFrame:
    """Per conversation, from formatted turns: n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars.

    Counts are aggregates, combined before the shuffle.  A SHA-256 over a whole
    conversation can only be taken turn after turn, so its turns stream through
    one task in order (sorted on disk if need be, one batch in memory).
    """
    spark = formatted.sparkSession
    masked = F.coalesce(F.aggregate("loss", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"]), F.lit(0).cast("long"))
    counts = formatted.groupBy("conv_id").agg(
        F.count("*").alias("n_turns"), F.sum(F.length("formatted").cast("long")).alias("formatted_chars"),
        F.sum(masked).alias("masked_chars"))
    rows = (formatted.select("conv_id", "turn", "formatted", "loss").repartition(shuffle_width(spark), "conv_id")
            .sortWithinPartitions("conv_id", "turn", "formatted"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = pa.schema([("id", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string())])
        now, begun, turns, loss, chars, out = None, False, None, None, 0, []
        for batch in batches:
            for conv, text, spans in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                if not begun or conv != now:
                    if begun:
                        out.append({"id": now, "turns_sha256": turns.hexdigest(), "loss_chars": chars, "loss_sha256": loss.hexdigest()})
                    now, begun, turns, loss, chars = conv, True, hashlib.sha256(), hashlib.sha256(), 0
                role, body = parse_turn(text)
                turns.update(f"{role}\n{body}\n".encode())
                for s in spans:
                    learned = unescape(text[s["start"]:s["end"]])
                    chars += len(learned)
                    loss.update(learned.encode())
            if len(out) >= 4096:
                yield pa.RecordBatch.from_pylist(out, schema=arrow)
                out = []
        if begun:
            out.append({"id": now, "turns_sha256": turns.hexdigest(), "loss_chars": chars, "loss_sha256": loss.hexdigest()})
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=arrow)

    digests = rows.mapInArrow(run, "id long, turns_sha256 string, loss_chars long, loss_sha256 string")
    return counts.join(digests, F.col("conv_id").eqNullSafe(F.col("id"))).select(
        "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")


def format_conversations(turns: DataFrame) -> DataFrame:
    """Format ``turns`` into a table in the shared scratch folder and digest what is read back."""
    return conversation_digests(written(turns.sparkSession, format_turns(turns), "chat"))
