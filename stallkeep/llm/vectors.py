"""What the vector searches share: sound vectors, packed rows, best of k."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def sound(vector: Column, with_zero: bool = True) -> Column:
    """Whether a vector is neither null nor holds a null or non-finite component (nor is all zeros)."""
    doubles = vector.cast("array<double>")
    finite = F.forall(doubles, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    kept = vector.isNotNull() & F.coalesce(finite, F.lit(False))
    return kept if with_zero else kept & F.exists(doubles, lambda x: x != 0)


def matrix(rows: pa.ListArray | Sequence[Sequence[float]], width: int, kind: type = np.float64) -> np.ndarray:
    """Rows of any length, without nulls, as one matrix; missing components are zero."""
    if isinstance(rows, pa.ListArray):
        flat = rows.flatten()
        if len(flat) == width * len(rows) and np.all(np.diff(rows.offsets) == width):
            return flat.to_numpy(zero_copy_only=False).astype(kind).reshape(len(rows), width)
        rows = rows.to_pylist()
    out = np.zeros((len(rows), width), dtype=kind)
    for i, row in enumerate(rows):
        out[i, : len(row)] = row
    return out


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores, ties by smaller id, best first."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        some = np.flatnonzero(scores >= least)
    else:
        some = np.arange(len(scores))
    return some[np.lexsort((ids[some], -scores[some]))][:k]


def best_per_query(found: DataFrame, k: int) -> DataFrame:
    """query_id, rank, vec_id, score of each query's k best (query, vec, score) rows."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
