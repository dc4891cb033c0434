"""Chat formatting at token level, and reading formatted conversations back.

A turn is ``<|im_start|>role<|im_sep|>text<|im_end|>``; the three marks are
reserved ids behind the vocabulary, spliced around the ids of role and text,
which are encoded separately. Inside a role or text every ``<|`` becomes ``<\\\\|`` and every
``<\\\\..\\\\|`` gets one more backslash, so no text can spell a mark and unescaping
takes exactly one backslash off again. The loss mask covers the text of
assistant turns.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stallkeep.llm.common import batch_of, weighed
from stallkeep.llm.tokens import ByteBpe

MARKS = ("<|im_start|>", "<|im_sep|>", "<|im_end|>")
TRAINED_ROLE = "assistant"
TURNS_A_PART = 256

_ESCAPE = re.compile(r"<(\\*)\|")
_UNESCAPE = re.compile(r"<\\(\\*)\|")


def escape(text: str) -> str:
    return _ESCAPE.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"<\1|", text)


@dataclass(frozen=True)
class Template:
    """Reserved ids and the tokenizer that encodes everything else."""

    tokenizer: str
    start_id: int = 50_257
    role_end_id: int = 50_258
    end_id: int = 50_259


PARTS = "conv_id long, part long, first_turn long, n_turns long, ids binary, loss_starts array<long>, loss_ends array<long>"


def turn_tokens(conversations: DataFrame, template: Template) -> DataFrame:
    """Per turn: its ids (little-endian unsigned 32-bit) and the bounds of its loss span.

    conv_id, turn, role, text in; a null role or text counts as empty, other
    columns are left out. ``mask_from`` and ``mask_to`` are equal where nothing
    is trained on.
    """
    fields = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("ids", pa.binary()), ("mask_from", pa.int64()), ("mask_to", pa.int64())])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = ByteBpe.shared(template.tokenizer)
        marks = (template.start_id, template.role_end_id, template.end_id)
        start, role_end, end = (np.array([i], dtype="<u4").tobytes() for i in marks)
        for batch in weighed(batches, 3, 2_000_000):
            conv, turn, role, text = (c.to_pylist() for c in batch.columns)
            heads = encoder.encode([escape(r or "") for r in role])
            bodies = encoder.encode([escape(t or "") for t in text])
            ids = [start + h + role_end + b + end for h, b in zip(heads, bodies, strict=True)]
            first = [2 + len(h) // 4 for h in heads]
            last = [f + len(b) // 4 if r == TRAINED_ROLE else f for f, b, r in zip(first, bodies, role, strict=True)]
            yield batch_of(fields, (conv, turn, ids, first, last))

    columns = [F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role").cast("string"), F.col("text").cast("string")]
    return conversations.select(*columns).mapInArrow(encode, "conv_id long, turn long, ids binary, mask_from long, mask_to long")


def assemble(conversations: DataFrame, template: Template, turns_a_part: int = TURNS_A_PART) -> DataFrame:
    """Formatted conversations, in parts of at most ``turns_a_part`` turns.

    Per part: conv_id, part number, its turns' ids one after another and the
    loss mask as spans of token positions in the whole conversation, so a
    conversation of any length never meets in one row. Turns go by ``turn``,
    repeated turn numbers by their ids; a null conv_id is a conversation like
    any other. Turns pass one partition sorted and are joined as they stream,
    so memory holds one part however long the conversation is.
    """
    fields = pa.schema([("conv_id", pa.int64()), *((n, pa.int64()) for n in ("part", "first_turn", "n_turns")), ("ids", pa.binary()), ("loss_starts", pa.list_(pa.int64())), ("loss_ends", pa.list_(pa.int64()))])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, part, turns_before, tokens_before = object(), 0, 0, 0
        held: list[tuple[bytes, int, int]] = []

        def flushed() -> tuple:
            sizes = np.array([len(ids) // 4 for ids, _, _ in held])
            starts = tokens_before + np.cumsum(sizes) - sizes
            spans = np.array([(s + a, s + b) for s, (_, a, b) in zip(starts, held, strict=True) if b > a], dtype=np.int64).reshape(-1, 2)
            return current, part, turns_before, len(held), b"".join(h[0] for h in held), spans[:, 0].tolist(), spans[:, 1].tolist()

        for batch in batches:
            rows = []
            for conv, _, ids, mask_from, mask_to in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and (conv != current or len(held) == turns_a_part):
                    rows.append(flushed())
                    turns_before, tokens_before = turns_before + len(held), tokens_before + sum(len(h[0]) for h in held) // 4
                    part, held = part + 1, []
                if conv != current:
                    current, part, turns_before, tokens_before = conv, 0, 0, 0
                held.append((ids, mask_from, mask_to))
            if rows:
                yield batch_of(fields, zip(*rows, strict=True))
        if held:
            yield batch_of(fields, zip(flushed(), strict=True))

    turns = turn_tokens(conversations, template).repartition("conv_id")
    return turns.sortWithinPartitions("conv_id", "turn", "ids").mapInArrow(join, PARTS)


def read_back(parts: DataFrame, template: Template) -> DataFrame:
    """One row per turn, from the ids alone: conv_id, part, turn_no, role, text, loss.

    ``loss`` is the text under the mask, unescaped, null where the mask covers
    nothing of the turn; ``formatted_chars`` counts the code points of the turn
    as formatted, marks spelt out.
    """
    names = ("conv_id", "part", "turn_no", "role", "text", "loss", "formatted_chars")
    fields = pa.schema([(n, pa.string() if n in ("role", "text", "loss") else pa.int64()) for n in names])

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = ByteBpe.shared(template.tokenizer)
        for batch in batches:
            for conv, part, first, _, ids, starts, ends, before in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                tokens = np.frombuffer(ids, "<u4")
                opened, role_ended, closed = (np.flatnonzero(tokens == i) for i in (template.start_id, template.role_end_id, template.end_id))
                spans = {s - before: e - before for s, e in zip(starts, ends, strict=True)}
                rows = []
                for k, (a, m, b) in enumerate(zip(opened, role_ended, closed, strict=True)):
                    role, text = decoder.decode(tokens[a + 1 : m]), decoder.decode(tokens[m + 1 : b])
                    loss = [decoder.decode(tokens[s:e]) for s, e in spans.items() if a < s <= b]
                    size = sum(map(len, MARKS)) + len(role) + len(text)
                    rows.append((conv, part, first + k, unescape(role), unescape(text), unescape(loss[0]) if loss else None, size))
                yield batch_of(fields, zip(*rows, strict=True))

    size = (F.length("ids") / 4).cast("long")
    # Tokens of a conversation before this part: a running sum over parts, not over turns.
    before = F.expr("sum(size) over (partition by conv_id order by part rows between unbounded preceding and 1 preceding)")
    placed = parts.withColumn("size", size).withColumn("tokens_before", F.coalesce(before, F.lit(0)).cast("long")).drop("size")
    return placed.mapInArrow(split, "conv_id long, part long, turn_no long, role string, text string, loss string, formatted_chars long")


DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def digests(turns: DataFrame) -> DataFrame:
    """One row per conversation over the turns ``read_back`` gives.

    A hash goes over a conversation in order, so its turns stream through one
    task; what is held is the state of two hashes and one turn.
    """
    fields = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state = object(), None
        for batch in batches:
            rows = []
            for conv, role, text, loss, size in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text", "loss", "formatted_chars")), strict=True):
                if conv != current:
                    if state:
                        rows.append((current, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]))
                    current, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode())
                state[2] += len(loss or "")
                state[3].update((loss or "").encode())
                state[4] += size
            if rows:
                yield batch_of(fields, zip(*rows, strict=True))
        if state:
            yield batch_of(fields, zip((current, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]), strict=True))

    return turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn_no").mapInArrow(fold, DIGESTS)
