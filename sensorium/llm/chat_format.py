"""Chat formatting with typed content parts.

A message is a list of parts. A visitor flattens them in order: text is escaped, every image, audio or document part becomes
a numbered placeholder whose reference and expanded token count are recorded. The template is

    <|turn|>ROLE<|body|>CONTENT<|end|>        CONTENT: escaped text and placeholders <|image:0|>, <|audio:1|>, ...

Texts and roles can't forge a mark: a control string (``<|`` or one of ``<s> </s> [INST] [/INST]``) gets a
backslash after its first character, and one that has backslashes there gets one more, so removing one reads
the text back exactly. The loss mask covers the texts of assistant turns, as spans of code points.

Each turn is formatted by itself (an Arrow pass without a shuffle). One shuffle by conversation and an external sort by turn
bring turns in order; a second pass joins them into segments of at least ``SEGMENT`` code points (a usual conversation is one), so
memory is bounded by a segment and the longest turn, however long a conversation is. ``read_back`` parses segments only.

Defined results: a null text or role is empty, rows of a conversation go by turn (null last), then role, text. Rows that repeat are
turns of their own; rows with a null conversation id form one conversation. Very long texts are one turn, kept whole. A part of another type
is an attachment of type ``other`` without tokens; null parts and a null list of parts count as none. An empty table gives no rows;
further columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare, quoted

SEGMENT = 1 << 20
LEARNT_ROLE = "assistant"

# fixed values: the template's marks
TURN, BODY, END = "<|turn|>", "<|body|>", "<|end|>"

_ESCAPE = re.compile(r"<(?=\\*(?:\||/?s>))|\[(?=\\*/?INST\])")
_UNESCAPE = re.compile(r"(<)\\(?=\\*(?:\||/?s>))|(\[)\\(?=\\*/?INST\])")
_PLACEHOLDER = re.compile(r"<\|(image|audio|document|other):(\d+)\|>")

ATTACHMENTS = "array<struct<turn:long,ordinal:int,type:string,reference:string,at:long,tokens:long>>"
SPANS = "array<struct<start:long,end:long>>"


def escape(text: str) -> str:
    return _ESCAPE.sub(lambda m: m.group() + "\\", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(lambda m: m.group(1) or m.group(2), text)


# ---------------------------------------------------------------- parts

class Budget:
    """How many tokens a part expands to; text has one a UTF-8 byte unless ``count_text`` says otherwise."""

    def __init__(self, patch: int = 14, audio_rate: float = 25.0, page_tokens: int = 1024, count_text: Callable[[str], int] | None = None):
        self.patch, self.audio_rate, self.page_tokens, self.count_text = patch, audio_rate, page_tokens, count_text

    def text(self, text: str) -> int:
        return self.count_text(text) if self.count_text else len(text.encode())

    def image(self, part: dict) -> int:
        return math.ceil((part.get("width") or 0) / self.patch) * math.ceil((part.get("height") or 0) / self.patch)

    def audio(self, part: dict) -> int:
        return math.ceil((part.get("seconds") or 0) * self.audio_rate)

    def document(self, part: dict) -> int:
        return (part.get("pages") or 0) * self.page_tokens


class Flattener:
    """Visits the parts of one message in order."""

    def __init__(self, budget: Budget):
        self.budget = budget
        self.pieces: list[str] = []
        self.length = 0  # code points so far
        self.texts: list[tuple[int, int]] = []  # spans of the texts
        self.attachments: list[dict] = []
        self.tokens = 0

    def visit(self, part: dict | None) -> None:
        if part is not None:
            getattr(self, f"visit_{part.get('type') or 'other'}", self.visit_other)(part)

    def _add(self, piece: str) -> None:
        self.pieces.append(piece)
        self.length += len(piece)

    def visit_text(self, part: dict) -> None:
        text = part.get("text") or ""
        start = self.length
        self._add(escape(text))
        if text:
            self.texts.append((start, self.length))
        self.tokens += self.budget.text(text)

    def _attach(self, kind: str, part: dict, tokens: int) -> None:
        n = len(self.attachments)
        self.attachments.append({"ordinal": n, "type": kind, "reference": part.get("reference"), "at": self.length, "tokens": tokens})
        self._add(f"<|{kind}:{n}|>")
        self.tokens += tokens

    def visit_image(self, part: dict) -> None:
        self._attach("image", part, self.budget.image(part))

    def visit_audio(self, part: dict) -> None:
        self._attach("audio", part, self.budget.audio(part))

    def visit_document(self, part: dict) -> None:
        self._attach("document", part, self.budget.document(part))

    def visit_other(self, part: dict) -> None:
        self._attach("other", part, 0)


def format_turn(role: str | None, parts: list[dict | None], budget: Budget) -> tuple[str, list[tuple[int, int]], list[dict], int]:
    """The formatted turn, the spans that are learnt, its attachments and its expanded tokens."""
    seen = Flattener(budget)
    for part in parts:
        seen.visit(part)
    head = TURN + escape(role or "") + BODY
    spans = [(len(head) + a, len(head) + b) for a, b in seen.texts] if role == LEARNT_ROLE else []
    for a in seen.attachments:
        a["at"] += len(head)
    return head + "".join(seen.pieces) + END, spans, seen.attachments, seen.tokens


# ---------------------------------------------------------------- conversations

_KINDS = {"formatted": pa.string(),
          "spans": pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])),
          "attachments": pa.list_(pa.struct([("turn", pa.int64()), ("ordinal", pa.int32()), ("type", pa.string()), ("reference", pa.string()),
                                             ("at", pa.int64()), ("tokens", pa.int64())])),
          "tokens": pa.int64()}


def _format(batches: Iterator[pa.RecordBatch], budget: Budget) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out: dict[str, list] = {c: [] for c in _KINDS}
        texts = b.column("text").to_pylist()
        typed = b.column("parts").to_pylist() if "parts" in b.schema.names else [None] * len(b)
        for turn, role, text, parts in zip(b.column("turn").to_pylist(), b.column("role").to_pylist(), texts, typed, strict=True):
            piece, spans, attached, tokens = format_turn(role, parts if parts is not None else [{"type": "text", "text": text}], budget)
            out["formatted"].append(piece)
            out["spans"].append([{"start": s, "end": e} for s, e in spans])
            out["attachments"].append([{"turn": turn, **a} for a in attached])
            out["tokens"].append(tokens)
        yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("conv", "turn", "role", "text")), *(pa.array(v, _KINDS[c]) for c, v in out.items())],
                                         names=["conv", "turn", "role", "text", *out])


def _join(batches: Iterator[pa.RecordBatch], segment: int) -> Iterator[pa.RecordBatch]:
    """Turns in order -> segments; a segment ends with a turn."""
    conv, number, pieces, length = None, -1, [], 0
    spans: list[dict] = []
    attached: list[dict] = []
    tokens = turns = 0

    def flush() -> pa.RecordBatch:
        row = {"conv": conv, "segment": number, "formatted": "".join(pieces), "spans": spans, "attachments": attached, "tokens": tokens, "turns": turns}
        return pa.RecordBatch.from_arrays([pa.array([row[c]], kind) for c, kind in kinds.items()], names=list(kinds))

    kinds = None
    for b in batches:
        kinds = kinds or {"conv": b.schema.field("conv").type, "segment": pa.int64(), **_KINDS, "turns": pa.int64()}
        for row in b.select(["conv", *_KINDS]).to_pylist():
            if number < 0 or row["conv"] != conv or length >= segment:
                if number >= 0:
                    yield flush()
                number = number + 1 if number >= 0 and row["conv"] == conv else 0
                conv, pieces, length, spans, attached, tokens, turns = row["conv"], [], 0, [], [], 0, 0
            spans += [{"start": s["start"] + length, "end": s["end"] + length} for s in row["spans"]]
            attached += [a | {"at": a["at"] + length} for a in row["attachments"]]
            pieces.append(row["formatted"])
            length += len(row["formatted"])
            tokens += row["tokens"]
            turns += 1
    if number >= 0:
        yield flush()


def format_conversations(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
                         parts_col: str | None = None, budget: Budget | None = None, segment: int = SEGMENT) -> DataFrame:
    """One row per conversation and segment, those of a conversation in order within one partition: its id, segment (from 0),
    formatted, spans (of the loss mask), attachments (``at``: where the placeholder stands), tokens (expanded), turns.

    ``parts_col`` names an array of structs (type, text, reference, width, height, seconds, pages; all but type may be missing); where it is
    null, or no such column is named, the text is the only part.
    """
    prepare(rows)
    budget = budget or Budget()
    cols = [quoted(conv_col).alias("conv"), quoted(turn_col).cast("long").alias("turn"), quoted(role_col).cast("string").alias("role"),
            quoted(text_col).cast("string").alias("text")] + ([quoted(parts_col).alias("parts")] if parts_col else [])
    plain = rows.select(*cols)
    kind = plain.schema["conv"].dataType.simpleString()
    body = f"formatted string, spans {SPANS}, attachments {ATTACHMENTS}, tokens long"
    turns = plain.mapInArrow(lambda it: _format(it, budget), f"conv {kind}, turn long, role string, text string, {body}")
    ordered = turns.repartition("conv").sortWithinPartitions("conv", F.asc_nulls_last("turn"), "role", "text")
    return ordered.select("conv", "formatted", "spans", "attachments", "tokens") \
        .mapInArrow(lambda it: _join(it, segment), f"conv {kind}, segment long, {body}, turns long").withColumnRenamed("conv", conv_col)


# ---------------------------------------------------------------- reading back

def parse(formatted: str) -> Iterator[tuple[str, str]]:
    """(role, text) of every turn of a formatted segment; placeholders stay in the text."""
    at = 0
    while at < len(formatted):
        body = formatted.index(BODY, at)
        end = formatted.index(END, body)
        yield unescape(formatted[at + len(TURN):body]), unescape(formatted[body + len(BODY):end])
        at = end + len(END)


def learnt(formatted: str, spans: list[dict]) -> Iterator[str]:
    """The texts under the loss mask."""
    for s in spans:
        yield unescape(formatted[s["start"]:s["end"]])


def placeholders(formatted: str) -> list[tuple[int, str, int]]:
    """(place, type, ordinal) of every placeholder."""
    return [(m.start(), m.group(1), int(m.group(2))) for m in _PLACEHOLDER.finditer(formatted)]


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds, state = None, None

    def flush() -> pa.RecordBatch:
        conv, n, turns, chars, loss, size, tokens, attached = state
        row = [conv, n, turns.hexdigest(), chars, loss.hexdigest(), size, tokens, attached]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds.values(), strict=True)], names=list(kinds))

    for b in batches:
        kinds = kinds or {"conv": b.schema.field(0).type, "n_turns": pa.int64(), "turns_sha256": pa.string(), "loss_chars": pa.int64(),
                          "loss_sha256": pa.string(), "formatted_chars": pa.int64(), "expanded_tokens": pa.int64(), "n_attachments": pa.int64()}
        for conv, number, formatted, spans, attached, tokens, _ in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if number == 0:
                if state:
                    yield flush()
                state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0, 0]
            for role, text in parse(formatted):
                state[1] += 1
                state[2].update(f"{role}\n{text}\n".encode())
            for text in learnt(formatted, spans):
                state[3] += len(text)
                state[4].update(text.encode())
            state[5] += len(formatted)
            state[6] += tokens
            state[7] += len(attached)
    if state:
        yield flush()


def read_back(segments: DataFrame) -> DataFrame:
    """Digests of what the output of ``format_conversations`` says, in the order it has: conversation id, n_turns, turns_sha256, loss_chars,
    loss_sha256, formatted_chars, expanded_tokens, n_attachments.

    A digest of a conversation is one serial SHA-256, so one task reads each conversation; it holds a segment at a time.
    """
    name, kind = segments.columns[0], segments.schema[0].dataType.simpleString()
    return segments.mapInArrow(_read, f"conv {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, "
                               "expanded_tokens long, n_attachments long").withColumnRenamed("conv", name)
