"""Surrogate keys and Unknown members."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stallkeep.session import scratch_root

# monotonically_increasing_id keeps the partition number above this many bits.
_POSITION_BITS = 33


def place_in_order(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Sort df across partitions and add ``_part`` and ``_position`` within it.

    The result is checkpointed: the range boundaries come from a sample, so
    positions may be used only once they are fixed.
    """
    scratch_root(df.sparkSession)
    slot = F.monotonically_increasing_id()
    placed = (
        df.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_slot", slot).checkpoint()
    )
    part = F.shiftright("_slot", _POSITION_BITS)
    return placed.select(
        *df.columns,
        part.alias("_part"),
        (F.col("_slot") - F.shiftleft(part, _POSITION_BITS)).alias("_position"),
    )


def number_rows(df: DataFrame, by: Sequence[str], name: str) -> DataFrame:
    """Number the rows 1..n in the order of ``by`` without a single-partition sort.

    Only one row per partition (its size) passes through the running sum.
    """
    placed = place_in_order(df, by)
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_size"))
    offsets = sizes.select(
        "_part", (F.sum("_size").over(Window.orderBy("_part")) - F.col("_size")).alias("_before")
    )
    numbered = placed.join(F.broadcast(offsets), "_part")
    return numbered.select(
        (F.col("_before") + F.col("_position") + 1).cast("long").alias(name), *df.columns
    )


def with_unknown_member(df: DataFrame, values: Mapping[str, Any]) -> DataFrame:
    """Add one row: the given values, NULL in every other column, in df's own types."""
    missing = set(values) - set(df.columns)
    if missing:
        raise ValueError(f"unknown member names columns the dimension lacks: {sorted(missing)}")
    row = df.sparkSession.range(1).select(
        *[F.lit(values.get(f.name)).cast(f.dataType).alias(f.name) for f in df.schema.fields]
    )
    return df.unionByName(row)
