"""Helpers that the operators of this package share."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stallkeep.session import scratch_path, scratch_root


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of texts: its batches to Python hold few rows, since one may be megabytes long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a table in the shared folder: what stands above it is computed once.

    The files outlive lost executors. A local session without a configured
    folder gets a temporary one, see ``scratch_root``.
    """
    path = scratch_path(df.sparkSession, name)
    scratch_root(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, after as many underscores as it takes to be none of df's columns."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def crc32_of(column: Column) -> Column:
    """crc32 of a number written as text."""
    return F.crc32(column.cast("string").cast("binary"))


def batch_of(schema: pa.Schema, columns: Iterable) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types, strict=True)], schema=schema)


def slices(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``rows``."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def weighed(batches: Iterator[pa.RecordBatch], text: int, chars: int) -> Iterator[pa.RecordBatch]:
    """The same rows cut where the texts of a batch pass ``chars``; one long text is a batch of its own."""
    for batch in batches:
        start = size = 0
        for i, value in enumerate(batch.column(text)):
            size += len(value.as_buffer() or b"") if value.is_valid else 0
            if size >= chars:
                yield batch.slice(start, i + 1 - start)
                start, size = i + 1, 0
        if start < batch.num_rows:
            yield batch.slice(start)
