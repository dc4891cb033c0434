"""Exact top-k by inner product: blocks of documents, pruned by their term maxima.

Vectors of whole numbers are documents, components are terms. Documents are
placed by likeness (their best of a few pivot vectors) and cut into ranges of
``BLOCK``; a block keeps the largest and smallest value of each term and a
forward index (its rows). The sum of a query's products with the values that
suit it best bounds every score in the block. For each query blocks are scored
in order of their bounds until these fall below the k-th score found.

Blocks lie in groups that fit a task; a query visits the group of its own
likeness first, and takes the k-th score found there along to all the others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stallkeep.llm.common import batch_of, slices, written
from stallkeep.llm.vectors import best, best_per_query, matrix, sound

PIVOTS = 128
BLOCK = 64
GROUP_ROWS = 65_536
LEAST_GROUP_ROWS = 2_048
QUERIES_A_ROW = 128
BLOCKS_AT_ONCE = 8

_FIELDS = pa.schema([("group", pa.int64()), ("kind", pa.int64()), ("ids", pa.binary()), ("terms", pa.binary()), ("floors", pa.binary())])
_ROW = "group long, kind long, ids binary, terms binary, floors binary"
_HITS = "query_id long, vec_id long, score long"


class _Group:
    """The blocks of one group and their bounds."""

    def __init__(self, ids: np.ndarray, terms: np.ndarray):
        pad = -len(ids) % BLOCK
        self.ids, self.terms = ids, terms
        rows = np.concatenate((terms, np.repeat(terms[-1:], pad, axis=0))).reshape(-1, BLOCK, terms.shape[1])
        self.largest, self.smallest = rows.max(1), rows.min(1)
        self.least_id = np.concatenate((ids, np.repeat(ids[-1:], pad))).reshape(-1, BLOCK).min(1)

    def search(self, query_id: int, query: np.ndarray, bounds: np.ndarray, k: int, floor: int | None) -> tuple[np.ndarray, np.ndarray]:
        """The k best here that reach the floor: ids and scores."""
        ids, scores = np.zeros(0, np.int64), np.zeros(0, self.terms.dtype)
        order = np.argsort(-bounds, kind="stable")
        for at in range(0, len(order), BLOCKS_AT_ONCE):
            some = order[at : at + BLOCKS_AT_ONCE]
            least = scores[-1] if len(scores) == k else floor
            if least is not None:
                if bounds[some[0]] < least:
                    break
                some = some[bounds[some] >= least]
                if len(ids) == k:  # at the bound, only smaller ids could still enter
                    some = some[(bounds[some] > least) | (self.least_id[some] < ids[-1])]
            rows = (some[:, None] * BLOCK + np.arange(BLOCK)).ravel()
            rows = rows[rows < len(self.ids)]
            rows = rows[self.ids[rows] != query_id]
            found = self.terms[rows] @ query
            if least is not None:
                rows, found = rows[found >= least], found[found >= least]
            ids, scores = np.concatenate((ids, self.ids[rows])), np.concatenate((scores, found))
            kept = best(scores, ids, k)
            ids, scores = ids[kept], scores[kept]
        return ids, scores


def _exact_kind(*largest: int) -> type:
    """Doubles while every inner product is exact in them, else Python's integers."""
    return np.float64 if np.prod([float(x) for x in largest]) < 2**53 else object


def exact_topk(vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """Each query's k highest inner products with the vectors: query_id, rank, vec_id, score.

    Both frames hold ``id`` long and ``terms`` array<long> without nulls; lengths
    may differ, missing terms are zero. A query never meets rows of its own id.
    Ties go to the smaller vec_id; a query with fewer candidates gets them all.
    Rows of a repeated id are candidates each. No vectors or queries give no
    rows. A score beyond 64 bits raises.
    """
    size = vectors.select(F.size("terms").alias("n"), F.array_max(F.transform("terms", F.abs)).alias("most"), F.lit(1).alias("v"))
    size = size.unionByName(queries.select(F.size("terms").alias("n"), F.array_max(F.transform("terms", F.abs)).alias("most"), F.lit(0).alias("v")))
    size = size.agg(F.max("n").alias("n"), F.max("most").alias("most"), F.sum("v").alias("vectors")).first()
    width, count = size["n"] or 0, size["vectors"] or 0
    kind = _exact_kind(width or 1, size["most"] or 1, size["most"] or 1)
    sample = vectors.orderBy(F.xxhash64("id"), "id").limit(PIVOTS).select("terms").collect()
    pivots = matrix([r[0] for r in sample], width)
    spark = vectors.sparkSession
    if not len(pivots):
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    # Groups as large as a task likes, but enough of them for all cores.
    wanted = max(LEAST_GROUP_ROWS, min(GROUP_ROWS, count // (2 * spark.sparkContext.defaultParallelism)))

    def liken(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 4096):
            scores = matrix(batch.column(1), width) @ pivots.T
            first = np.argmax(scores, axis=1)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(first, pa.int32()), pa.array(-scores[np.arange(len(first)), first])], names=["id", "terms", "pivot", "far"])

    def likened(df: DataFrame) -> DataFrame:
        return df.select(F.col("id").cast("long"), F.col("terms").cast("array<long>")).mapInArrow(liken, "id long, terms array<long>, pivot int, far double")

    def cut(rows: int, of: int):
        """Packed rows in the order they come; the group is a partition's, numbered by its first row's place."""

        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches, rows):
                packed = matrix(batch.column(1), width, np.int64)
                ids = batch.column(0).to_numpy().astype(np.int64)
                group = batch.column(2)[0].as_py()
                yield batch_of(_FIELDS, zip((group, of, ids.tobytes(), packed.tobytes(), None), strict=True))

        return pack

    # Vectors get a group by place in the order of likeness.
    groups = max(1, -(-count // wanted))
    placed = likened(vectors).repartitionByRange(groups, "pivot", "far", "id").sortWithinPartitions("pivot", "far", "id")
    placed = placed.withColumn("group", F.spark_partition_id().cast("long"))
    placed = written(placed, "likeness")
    shards = placed.select("id", "terms", "group").mapInArrow(_by_group(cut(LEAST_GROUP_ROWS, 0)), _ROW)
    # A pivot's home is the group with most of its vectors: as many rows as there are pivots and groups meet.
    homes = placed.groupBy("pivot", "group").count().groupBy("pivot").agg(F.max_by("group", "count").alias("group"), F.max("count")).collect()
    home = {r["pivot"]: r["group"] for r in homes}
    live = sorted(r["group"] for r in placed.select("group").distinct().collect())
    default = live[0]
    homing = F.create_map(*[F.lit(x) for pair in home.items() for x in pair])
    asked = likened(queries).withColumn("group", F.coalesce(F.try_element_at(homing, F.col("pivot")), F.lit(default)).cast("long"))
    asked = asked.repartition("group").sortWithinPartitions("group", "id")
    asked = written(asked.select("id", "terms", "group").mapInArrow(_by_group(cut(QUERIES_A_ROW, 1)), _ROW), "queries")

    def scan(carry: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            current, parts, group = None, [], None
            for batch in batches:
                for at, what, ids, terms, floors in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    if at != current:
                        current, parts, group = at, [], None
                    ids = np.frombuffer(ids, np.int64)
                    rows = np.frombuffer(terms, np.int64).reshape(len(ids), width).astype(kind)
                    if what == 0:
                        parts.append((ids, rows))
                        continue
                    if group is None:
                        if not parts:
                            continue
                        group = _Group(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))
                        parts = []
                    floor = np.frombuffer(floors, np.int64) if floors is not None else None
                    plus, minus = np.where(rows > 0, rows, 0), np.where(rows < 0, rows, 0)
                    bounds = plus @ group.largest.T + minus @ group.smallest.T
                    hits = [group.search(int(q), rows[i], bounds[i], k, None if floor is None or floor[i] == _NONE else int(floor[i])) for i, q in enumerate(ids)]
                    if carry:
                        floors = np.array([int(s[-1]) if len(s) == k else _NONE for _, s in hits], dtype=np.int64)
                        yield batch_of(_SEEDED, zip((at, ids.tobytes(), rows.astype(np.int64).tobytes(), floors.tobytes(), *_flat(ids, hits)), strict=True))
                    else:
                        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in _flat(ids, hits)], names=["query_id", "vec_id", "score"])

        return run

    def meet(asking: DataFrame) -> DataFrame:
        both = shards.unionByName(asking)
        return both.repartition(groups, "group").sortWithinPartitions("group", "kind")

    seeded = written(meet(asked).mapInArrow(scan(True), "home long, ids binary, terms binary, floors binary, query_id array<long>, vec_id array<long>, score array<long>"), "seeded")
    others = seeded.select("home", "ids", "terms", "floors", F.explode(F.lit(live).cast("array<long>")).alias("group")).filter("group != home")
    others = others.select("group", F.lit(1).cast("long").alias("kind"), "ids", "terms", "floors")
    rest = meet(others).mapInArrow(scan(False), _HITS)
    own = seeded.select(F.explode(F.arrays_zip("query_id", "vec_id", "score")).alias("x")).select("x.*")
    return best_per_query(own.unionByName(rest), k)


_NONE = np.iinfo(np.int64).min
_SEEDED = pa.schema([("home", pa.int64()), *((n, pa.binary()) for n in ("ids", "terms", "floors")), *((n, pa.list_(pa.int64())) for n in ("query_id", "vec_id", "score"))])


def _flat(ids: np.ndarray, hits: list[tuple[np.ndarray, np.ndarray]]) -> tuple[list[int], list[int], list[int]]:
    queries = [int(q) for q, (found, _) in zip(ids, hits, strict=True) for _ in found]
    return queries, [int(v) for f, _ in hits for v in f], [int(s) for _, scores in hits for s in scores]


def _by_group(pack):
    """Apply pack to the runs of equal group in a sorted partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            group = batch.column(2).to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(group)]
            yield from pack(batch.slice(a, b - a) for a, b in zip(edges[:-1], edges[1:], strict=True) if b > a)

    return run


def quantised(vectors: DataFrame, scale: float = 256.0) -> DataFrame:
    """id and terms floor(scale * x), from id and vector columns; vectors that are not sound are left out."""
    terms = F.transform(F.col("vector").cast("array<double>"), lambda x: F.floor(x * F.lit(scale)).cast("long"))
    return vectors.filter(sound(F.col("vector"))).select(F.col("id").cast("long"), terms.alias("terms"))
