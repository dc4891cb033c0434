"""Packing of token pieces by their length histogram, shortest pack first."""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stallkeep.llm.common import batch_of, weighed, written
from stallkeep.llm.tokens import ByteBpe
from stallkeep.operators.keys import place_in_order

CAPACITY = 1024

Pattern = tuple[int, ...]


def pack_histogram(histogram: Mapping[int, int], capacity: int = CAPACITY) -> list[tuple[Pattern, int]]:
    """Packing patterns and how often each is used, from counts by length.

    Lengths go longest first. Each goes to the packs with the most room left
    (the shortest packs) while they can take it; a group of equal packs is
    changed, or split, as one. Where no pack has room, new ones open, each
    filled with as many pieces of this length as it holds. The work depends on
    the number of different lengths only. Lengths outside 1..capacity raise.
    """
    room: list[tuple[int, int]] = []  # (-room left, group)
    groups: list[tuple[Pattern, int]] = []

    def put(pattern: Pattern, count: int) -> None:
        if count:
            groups.append((pattern, count))
            heapq.heappush(room, (sum(pattern) - capacity, len(groups) - 1))

    done: set[int] = set()
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        if not 1 <= length <= capacity:
            raise ValueError(f"length {length} does not fit a pack of {capacity}")
        while left and room and -room[0][0] >= length:
            _, at = heapq.heappop(room)
            pattern, count = groups[at]
            done.add(at)
            used = min(count, left)
            left -= used
            put(pattern + (length,), used)
            put(pattern, count - used)
        each = capacity // length
        put((length,) * each, left // each)
        put((length,) * (left % each), 1 if left % each else 0)
    return [g for i, g in enumerate(groups) if i not in done]


def slot_table(patterns: list[tuple[Pattern, int]]) -> np.ndarray:
    """One row per place in a pattern: first position of its pieces among all
    pieces in order of length, first sequence, offset in the sequence."""
    firsts: dict[int, int] = {}
    total: dict[int, int] = {}
    for pattern, count in patterns:
        for length in pattern:
            total[length] = total.get(length, 0) + count
    at = 0
    for length in sorted(total):
        firsts[length], at = at, at + total[length]
    slots, sequence = [], 0
    for pattern, count in patterns:
        offset = 0
        for length in pattern:
            slots.append((firsts[length], sequence, offset))
            firsts[length] += count
            offset += length
        sequence += count
    return np.array(sorted(slots), dtype=np.int64).reshape(-1, 3)


def pack(pieces: DataFrame, by: tuple[str, ...] = ("doc_id", "start"), length: str = "length", capacity: int = CAPACITY) -> DataFrame:
    """Each row of pieces with ``sequence_id`` and ``offset``.

    Only the counts by length (at most ``capacity`` rows) reach the driver. The
    pieces are placed in the order (length, by) across partitions, so that one
    very common length is many partitions, and a piece's position decides its
    slot in a pattern. Rows that are alike in all of these are packed once each,
    in any order. Other columns pass through. No rows give no rows.
    """
    histogram = {r[0]: r[1] for r in pieces.groupBy(length).count().collect()}
    slots = slot_table(pack_histogram(histogram, capacity))
    placed = place_in_order(pieces, (length, *by))
    sizes = placed.groupBy("_part").agg(F.count("*").alias("n")).orderBy("_part").collect()
    before = dict(zip((r[0] for r in sizes), np.cumsum([0] + [r[1] for r in sizes]).tolist(), strict=False))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part, position = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("_part", "_position"))
            at = position + np.array([before[int(p)] for p in part], dtype=np.int64)
            slot = slots[np.searchsorted(slots[:, 0], at, "right") - 1]
            kept = [batch.column(c) for c in range(batch.num_columns - 2)]
            new = [pa.array(slot[:, 1] + at - slot[:, 0]), pa.array(slot[:, 2])]
            yield pa.RecordBatch.from_arrays([*kept, *new], names=[*names, "sequence_id", "offset"])

    names = [c for c in placed.columns if c not in ("_part", "_position")]
    schema = placed.select(*names).schema.add("sequence_id", "long").add("offset", "long")
    return placed.select(*names, "_part", "_position").mapInArrow(assign, schema)


PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, ids binary"


def document_pieces(documents: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 0, keep_ids: bool = True) -> DataFrame:
    """Every document's ids and an end id, cut into pieces of at most ``capacity``.

    A null or empty text is its end id alone. ``ids`` are little-endian unsigned
    32-bit numbers (null without ``keep_ids``); ``ids_crc32`` is over them. A
    null doc_id stays null, a repeated one gives the pieces of each of its rows.
    """
    fields = pa.schema([("doc_id", pa.int64()), *((n, pa.int64()) for n in ("start", "length", "ids_crc32", "doc_tokens")), ("ids", pa.binary())])
    end = np.array([end_id], dtype="<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = ByteBpe.shared(tokenizer)
        for batch in weighed(batches, 1, 2_000_000):
            rows = []
            for doc, ids in zip(batch.column(0).to_pylist(), encoder.encode(batch.column(1).to_pylist()), strict=True):
                ids += end
                for at in range(0, len(ids), 4 * capacity):
                    piece = ids[at : at + 4 * capacity]
                    rows.append((doc, at // 4, len(piece) // 4, zlib.crc32(piece), len(ids) // 4, piece if keep_ids else None))
            yield batch_of(fields, zip(*rows, strict=True))

    return documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(cut, PIECES)


def pack_documents(documents: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 0, keep_ids: bool = True) -> DataFrame:
    """Pieces of all documents with their ids, sequence and offset."""
    pieces = written(document_pieces(documents, tokenizer, capacity, end_id, keep_ids), "pieces")
    return pack(pieces, capacity=capacity)


def padding(packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """One row: sequences, tokens, and padding where a sequence that is no power of two is filled up."""
    used = packed.groupBy("sequence_id").agg(F.sum("length").alias("used"))
    exact = F.expr("bit_count(used)") == 1
    return used.agg(
        F.count("*").alias("sequences"),
        F.sum("used").alias("tokens"),
        F.sum(F.when(exact, 0).otherwise(F.lit(capacity) - F.col("used"))).alias("padding"),
    )
