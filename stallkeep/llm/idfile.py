"""Token ids of documents as files of coded segments, and reading them back.

A file is a table of segments in the folder's own order: ``part`` and ``no``
(ascending by document), the ids before the segment in its part, its documents
(ids and lengths) and the coded ids (``idcoder``). Parquet only carries the
bytes, so that Spark's commit makes a written folder whole and any store that
Spark reads will do.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stallkeep.llm import idcoder
from stallkeep.llm.common import batch_of, weighed
from stallkeep.llm.tokens import ByteBpe

SEGMENT_IDS = 2048 * idcoder.BLOCK

SEGMENTS = "part long, no long, ids_before long, n_ids long, documents binary, lengths binary, null_documents binary, ids binary"


def write(documents: DataFrame, tokenizer: str, path: str, end_id: int = 2, segment_ids: int = SEGMENT_IDS) -> None:
    """All documents' ids, each closed by ``end_id``, in ascending doc_id order, under ``path``.

    A null or empty text is its end id alone; a null doc_id comes first; rows of
    a repeated doc_id follow each other. Documents go to partitions by ranges of
    doc_id; a segment closes at the first document that fills it, so a task
    holds one segment and one document.
    """
    fields = pa.schema([*((n, pa.int64()) for n in ("part", "no", "ids_before", "n_ids")), *((n, pa.binary()) for n in ("documents", "lengths", "null_documents", "ids"))])
    end = np.array([end_id], dtype="<u4").tobytes()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, no, before = ByteBpe.shared(tokenizer), TaskContext.get().partitionId(), 0, 0
        held: list[tuple[int | None, bytes]] = []
        size = 0

        def segment() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(h[1] for h in held), "<u4")
            docs = np.array([h[0] or 0 for h in held], dtype="<i8")
            lengths = np.array([len(h[1]) // 4 for h in held], dtype="<i8")
            nulls = np.packbits([h[0] is None for h in held])
            packed = [zlib.compress(a.tobytes()) for a in (np.diff(docs, prepend=0), lengths, nulls)]
            return batch_of(fields, zip((part, no, before, len(ids), *packed, idcoder.encode(ids)), strict=True))

        for batch in weighed(batches, 1, 2_000_000):
            for doc, ids in zip(batch.column(0).to_pylist(), encoder.encode(batch.column(1).to_pylist()), strict=True):
                held.append((doc, ids + end))
                size += len(ids) // 4 + 1
                if size >= segment_ids:
                    yield segment()
                    held, no, before, size = [], no + 1, before + size, 0
        if held:
            yield segment()

    ordered = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    ordered = ordered.repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    ordered.mapInArrow(encode, SEGMENTS).write.parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start and ids (little-endian unsigned 32-bit) of every document in the files.

    Raises where a checksum does not hold. Only one row per part (its number of
    ids) passes through the running sum that places the parts.
    """
    segments = spark.read.schema(SEGMENTS).parquet(path)
    totals = segments.groupBy("part").agg(F.sum("n_ids").alias("n"))
    offsets = totals.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("part_start"))
    fields = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("ids", pa.binary())])

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, docs, lengths, nulls, coded in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                docs, lengths = (np.frombuffer(zlib.decompress(b), "<i8") for b in (docs, lengths))
                null = np.unpackbits(np.frombuffer(zlib.decompress(nulls), np.uint8), count=len(docs)).astype(bool)
                ids = idcoder.decode(coded)
                ends = np.cumsum(lengths)
                for at in range(0, len(docs), 1000):
                    some = slice(at, at + 1000)
                    texts = [ids[e - n : e].astype("<u4").tobytes() for e, n in zip(ends[some], lengths[some], strict=True)]
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.cumsum(docs)[some], mask=null[some]), pa.array(start + ends[some] - lengths[some]), pa.array(texts, pa.binary()),
                    ], schema=fields)

    placed = segments.join(F.broadcast(offsets), "part")
    return placed.select((F.col("part_start") + F.col("ids_before")).alias("start"), "documents", "lengths", "null_documents", "ids").mapInArrow(
        decode, "doc_id long, start long, ids binary"
    )


def digests(documents: DataFrame) -> DataFrame:
    """doc_id, start, number of ids and their crc32, of the rows ``read`` gives."""
    return documents.select("doc_id", "start", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))
