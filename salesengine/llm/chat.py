"""Chat formatting with typed content parts.

A turn is ``<s>[INST]role[/INST]content</s>``. Content is a text or a list of typed parts,
visited in order: texts are escaped; images, audio and documents become placeholders, with
the attachment's reference, place and expanded token count recorded. Control strings inside
roles and texts are broken by a backslash after their first character and backslashes are
doubled, so no control string of the template occurs in a text and unescaping restores it.

One output row a turn, independent of all others, with the span of its text that bears
loss; a conversation is its pieces in order, so none is ever held whole.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tables import shuffle_partitions

#: The template's control strings and the placeholders of the part types.
TURN, HEAD, BODY, END = "<s>", "[INST]", "[/INST]", "</s>"
PLACEHOLDERS = {"image": "<|image|>", "audio": "<|audio|>", "document": "<|document|>"}
CONTROL = re.compile("|".join(["\\\\", *map(re.escape, [TURN, HEAD, BODY, END, *PLACEHOLDERS.values()])]))
PIECE = re.compile(f"{re.escape(TURN + HEAD)}(.*?){re.escape(BODY)}(.*?){re.escape(END)}", re.S)
#: Tokens that a placeholder stands for: image patches of 14 x 14 pixels, 25 a second of audio, 256 a page.
PATCH, PER_SECOND, PER_PAGE = 14, 25, 256
PART = "struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"


def escape(text: str) -> str:
    return CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    return re.sub(r"\\(\\?)", r"\1", text) if "\\" in text else text


class Flatten:
    """Visitor of content parts; collects the content and the attachments."""

    def __init__(self) -> None:
        self.out: list[str] = []
        self.length = 0
        self.attachments: list[dict] = []

    def visit(self, part: dict) -> None:
        kind = part.get("kind") or "text"
        handler: Callable[[dict], None] | None = getattr(self, f"visit_{kind}", None)
        if handler is None:
            raise ValueError(f"unknown part type: {kind}")
        handler(part)

    def add(self, text: str) -> None:
        self.out.append(text)
        self.length += len(text)

    def attach(self, part: dict, tokens: int) -> None:
        self.attachments.append({"kind": part["kind"], "ref": part.get("ref"), "at": self.length, "tokens": tokens})
        self.add(PLACEHOLDERS[part["kind"]])

    def visit_text(self, part: dict) -> None:
        self.add(escape(part.get("text") or ""))

    def visit_image(self, part: dict) -> None:
        self.attach(part, math.ceil((part.get("width") or 0) / PATCH) * math.ceil((part.get("height") or 0) / PATCH))

    def visit_audio(self, part: dict) -> None:
        self.attach(part, math.ceil((part.get("seconds") or 0) * PER_SECOND))

    def visit_document(self, part: dict) -> None:
        self.attach(part, (part.get("pages") or 0) * PER_PAGE)


def format_turn(role: str | None, content: str | list[dict] | None) -> tuple[str, int, int, list[dict], int]:
    """(piece, start of the content, its length, attachments, expanded placeholder tokens)."""
    visitor = Flatten()
    for part in [{"kind": "text", "text": content}] if isinstance(content, str) or content is None else content:
        if part is not None:
            visitor.visit(part)
    head = TURN + HEAD + escape(role or "") + BODY
    attachments = [a | {"at": a["at"] + len(head)} for a in visitor.attachments]
    return head + "".join(visitor.out) + END, len(head), visitor.length, attachments, sum(a["tokens"] for a in attachments)


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """(role, content) of each turn of formatted text; the inverse of ``format_turn`` for texts."""
    return [(unescape(role), unescape(content)) for role, content in PIECE.findall(formatted)]


def format_chat(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", content_col: str = "text",
                loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """(conv_id, turn, piece, loss_start, loss_chars, attachments, placeholder_tokens), a row a turn.

    ``content_col`` is a string or an array of parts (``PART``). Null contents and roles are
    empty, null parts are skipped; a part of unknown type is an error. ``loss_chars`` is 0 for
    other roles than ``loss_roles``. Repeated rows are turns of their own.
    """
    kinds = [turns.schema[c].dataType for c in (conv_col, turn_col)]
    schema = T.StructType([
        T.StructField("conv_id", kinds[0]), T.StructField("turn", kinds[1]), T.StructField("piece", T.StringType()),
        T.StructField("loss_start", T.IntegerType()), T.StructField("loss_chars", T.IntegerType()),
        T.StructField("attachments", T.ArrayType(T.StructType([
            T.StructField("kind", T.StringType()), T.StructField("ref", T.StringType()),
            T.StructField("at", T.IntegerType()), T.StructField("tokens", T.IntegerType())]))),
        T.StructField("placeholder_tokens", T.LongType())])
    attached = pa.list_(pa.struct([("kind", pa.string()), ("ref", pa.string()), ("at", pa.int32()), ("tokens", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            roles, contents = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            done = [format_turn(r, c) for r, c in zip(roles, contents)]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array([d[0] for d in done], pa.string()), pa.array([d[1] for d in done], pa.int32()),
                pa.array([d[2] if r in loss_roles else 0 for d, r in zip(done, roles)], pa.int32()),
                pa.array([d[3] for d in done], attached), pa.array([d[4] for d in done], pa.int64())], names=schema.names)

    return turns.select(conv_col, turn_col, role_col, content_col).mapInArrow(run, schema)


def digest(formatted: DataFrame) -> DataFrame:
    """Per conversation, read back from its pieces: turns, digest of roles and texts, loss text.

    Pieces go in order of turn, ties in order of the piece, null turns first; a null conv_id
    is a conversation of its own. The pieces stream through running digests.
    """
    kind = formatted.schema["conv_id"].dataType.simpleString()
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    types = [None, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = now = None
        for batch in batches:
            done = []
            for conv, piece, start, length in zip(*(c.to_pylist() for c in batch.columns)):
                if now is None or conv != key:
                    if now is not None:
                        done.append(now)
                    key, now = conv, [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, content in read_turns(piece):
                    now[1] += 1
                    now[2].update(f"{role}\n{content}\n".encode())
                loss = unescape(piece[start : start + length])
                now[3] += len(loss)
                now[4].update(loss.encode())
                now[5] += len(piece)
            if done:
                yield record(done, batch.schema.types[0])
            kept_type = batch.schema.types[0]
        if now is not None:
            yield record([now], kept_type)

    def record(done, conv_type):
        columns = list(zip(*([x.hexdigest() if hasattr(x, "hexdigest") else x for x in row] for row in done)))
        return pa.RecordBatch.from_arrays([pa.array(c, t or conv_type) for c, t in zip(columns, types)], names=names)

    dealt = formatted.repartition(shuffle_partitions(formatted.sparkSession), "conv_id").sortWithinPartitions("conv_id", "turn", "piece")
    return dealt.select("conv_id", "piece", "loss_start", "loss_chars").mapInArrow(
        run, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
