"""Joins to a reference table that stay balanced when one key is hot."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 16 * 1024 * 1024
HOT_ROWS = 20_000_000
# Keys that the search for hot keys counts, and that its sketch tracks.
HOT_CANDIDATES = 1_000
SKETCHED_KEYS = 10_000
# Rows without a key match nothing, so they may go to any of this many pieces.
NULL_KEY_PIECES = 4096


def plan_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate in bytes (an upper estimate for joins)."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    return plan_bytes(df) <= limit


def hot_keys(df: DataFrame, on: Sequence[str], hot_rows: int) -> DataFrame:
    """Keys with more than ``hot_rows`` rows and the number of pieces to cut each into.

    A frequent-items sketch over the keys names candidates, in memory that does
    not grow with the data; only their rows are then counted. There are at most
    (rows of df) / hot_rows hot keys. The sketch is sure to name them all up to
    about SKETCHED_KEYS / 7 times ``hot_rows`` rows; a key it missed would stay
    whole, which changes the balance of a join and never its result.
    """
    key = F.xxhash64(*on)
    sketch = df.select(key.alias("_h")).agg(F.expr(f"approx_top_k(_h, {HOT_CANDIDATES}, {SKETCHED_KEYS})").alias("_top"))
    candidates = sketch.select(F.explode("_top").alias("_x")).select(F.col("_x.item").alias("_h"))
    rows = df.select(*on, key.alias("_h")).join(F.broadcast(candidates), "_h", "left_semi")
    return (
        rows.groupBy(*on)
        .agg(F.count("*").alias("_rows"))
        .filter(F.col("_rows") > hot_rows)
        .select(*on, F.ceil(F.col("_rows") / F.lit(hot_rows)).cast("int").alias("_pieces"))
    )


def spread_join(
    big: DataFrame,
    reference: DataFrame,
    on: Sequence[str],
    how: str = "left",
    hot_rows: int = HOT_ROWS,
    broadcast_bytes: int = BROADCAST_BYTES,
    hot_from: DataFrame | None = None,
    size_from: DataFrame | None = None,
) -> DataFrame:
    """``big.join(reference, on, how)`` for how in left, inner, left_semi, left_anti.

    A reference of checked small size is broadcast. A larger one is shuffled;
    each hot key of the big side is then cut into pieces, and only the
    reference rows of hot keys are copied, once per piece. The piece of a row
    depends on its values and its input partition alone, so a retried task
    sends each row to the same place.

    ``hot_from`` is a cheaper frame with the same key column to look for hot
    keys in, such as the table ``big`` was derived from row by row. Likewise
    ``size_from`` is the table a derived reference takes its rows from: the
    optimizer multiplies the sizes of joined inputs, so its estimate for a
    reference that went through lookups is far too large.
    """
    on = list(on)
    if fits_broadcast(reference if size_from is None else size_from, broadcast_bytes):
        return big.join(F.broadcast(reference), on, how)
    hot = F.broadcast(hot_keys(big if hot_from is None else hot_from, on, hot_rows))
    row_hash = F.xxhash64(*[F.col(c) for c in big.columns]) + F.spark_partition_id()
    without_key = reduce(or_, [F.col(c).isNull() for c in on])
    pieces = F.when(without_key, NULL_KEY_PIECES).otherwise(F.coalesce(F.col("_pieces"), F.lit(1)))
    cut = big.join(hot, on, "left").withColumn("_piece", F.pmod(row_hash, pieces).cast("int"))
    copied = reference.join(hot, on, "left").withColumn(
        "_piece", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_pieces"), F.lit(1)) - 1))
    )
    joined = cut.drop("_pieces").join(copied.drop("_pieces"), [*on, "_piece"], how)
    return joined.drop("_piece")


def required(value: Column, message: str) -> Column:
    """``value``, or a failed task where it is NULL."""
    return F.when(value.isNull(), F.raise_error(F.lit(message))).otherwise(value)


def lookup(
    rows: DataFrame,
    dimension: DataFrame,
    business_key: str,
    surrogate_key: str,
    source_key: str,
    output: str | None = None,
    **spread,
) -> DataFrame:
    """Add the surrogate key of ``source_key``, NULL without a match.

    The Unknown member (key 0) never matches. ``dimension`` must hold each
    business key once, which the dimension loads guarantee and their
    validators check.
    """
    members = dimension.filter(F.col(surrogate_key) != 0).select(
        F.col(business_key).alias(source_key), F.col(surrogate_key).alias(output or surrogate_key)
    )
    return spread_join(rows, members, [source_key], "left", **spread)


def found(surrogate_key: str, source_key: str, output: str | None = None) -> Column:
    """A looked-up key that must be there: a row without it fails the job."""
    output = output or surrogate_key
    return required(F.col(output), f"no {surrogate_key} for a value of {source_key}").alias(output)


def strict_lookup(
    rows: DataFrame,
    dimension: DataFrame,
    business_key: str,
    surrogate_key: str,
    source_key: str,
    output: str | None = None,
    **spread,
) -> DataFrame:
    """``lookup`` where a row without a match fails the job."""
    joined = lookup(rows, dimension, business_key, surrogate_key, source_key, output, **spread)
    output = output or surrogate_key
    return joined.withColumn(output, found(surrogate_key, source_key, output))
