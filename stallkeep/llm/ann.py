"""Approximate nearest neighbours by inner product over balanced posting lists.

Inner products become distances: every vector gets one more component that
brings it to the largest norm, queries are scaled to that norm, so the nearest
by distance has the largest inner product. Centroids come from halving a
bounded sample again and again at the median between two means, so all lists
weigh alike. A vector enters its nearest list and, near a border, the next ones
too. Queries walk a neighbour graph of the centroids in memory and read every
list that is not farther than a ratio of their nearest one. Lists lie in groups
of bounded size in their order; a long one reaches over several, all of which
are read, so one common vector never fills a task. A batch of queries goes once
to every group that holds one of its lists. Candidates are scored on the original vectors in double precision.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stallkeep.llm.common import batch_of, slices, written
from stallkeep.llm.vectors import best, best_per_query, matrix, sound
from stallkeep.operators.keys import number_rows


@dataclass(frozen=True)
class Settings:
    """sample_rows bounds the fit, so also the centroids (sample_rows / list_rows) that every task holds."""

    sample_rows: int = 16_384
    list_rows: int = 16  # sampled vectors a list
    copies: int = 4  # lists that a vector may enter
    border: float = 1.1  # of its nearest distance, for the further ones
    reach: float = 1.35  # of a query's nearest distance, for the lists it reads
    neighbours: int = 16  # edges of a centroid in the graph
    group_rows: int = 16_384  # rows of lists that a task searches together
    queries_a_row: int = 256


class Centroids:
    """Centroids and the graph that queries walk."""

    def __init__(self, sample: np.ndarray, settings: Settings):
        means: list[np.ndarray] = []
        open_ = [np.arange(len(sample))]
        while open_:
            rows = open_.pop()
            if len(rows) <= settings.list_rows:
                means.append(sample[rows].mean(0))
            else:
                open_ += _halves(sample, rows)
        self.points = np.array(means)
        self.squares = (self.points**2).sum(1)
        degree = min(settings.neighbours, len(means) - 1)
        apart = self.squares[:, None] + self.squares - 2 * self.points @ self.points.T
        np.fill_diagonal(apart, np.inf)
        near = np.argsort(apart, axis=1, kind="stable")[:, :degree]
        # Edges both ways, and a ring so that every centroid can be reached.
        edges: list[set[int]] = [{(i + 1) % len(means), (i - 1) % len(means)} - {i} for i in range(len(means))]
        for i, row in enumerate(near.tolist()):
            edges[i].update(row)
            for j in row:
                edges[j].add(i)
        self.edges = [np.array(sorted(e), dtype=np.int64) for e in edges]
        self.entries = np.linspace(0, len(means) - 1, min(16, len(means))).astype(np.int64)

    def distances(self, rows: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(0, (rows**2).sum(1)[:, None] + self.squares - 2 * rows @ self.points.T))

    def lists(self, query: np.ndarray, reach: float) -> np.ndarray:
        """Lists within the ratio of the nearest: a best-first walk that goes on from every such list."""
        norm = float(query @ query)

        def apart(some: np.ndarray) -> np.ndarray:
            return np.sqrt(np.maximum(0, norm + self.squares[some] - 2 * self.points[some] @ query))

        seen = np.zeros(len(self.points), bool)
        seen[self.entries] = True
        found = list(zip(apart(self.entries).tolist(), self.entries.tolist(), strict=True))
        queue = sorted(found)
        nearest = queue[0][0]
        while queue:
            distance, at = heapq.heappop(queue)
            nearest = min(nearest, distance)
            if distance > reach * nearest:
                break
            fresh = self.edges[at][~seen[self.edges[at]]]
            seen[fresh] = True
            new = list(zip(apart(fresh).tolist(), fresh.tolist(), strict=True))
            found += new
            for x in new:
                heapq.heappush(queue, x)
        return np.array(sorted(i for d, i in found if d <= reach * nearest), dtype=np.int64)


def _halves(sample: np.ndarray, rows: np.ndarray) -> list[np.ndarray]:
    """Two halves of equal size, cut at the median between two means."""
    points = sample[rows]
    a = points[np.argmax(((points - points.mean(0)) ** 2).sum(1))]
    b = points[np.argmax(((points - a) ** 2).sum(1))]
    for _ in range(6):
        side = points @ (a - b)
        order = np.argsort(side, kind="stable")
        half = len(order) // 2
        a, b = points[order[half:]].mean(0), points[order[:half]].mean(0)
    order = np.argsort(points @ (a - b), kind="stable")
    return [rows[order[:half]], rows[order[half:]]]


@dataclass(frozen=True)
class Index:
    centroids: Centroids
    norm: float
    width: int
    postings: DataFrame
    spans: dict[int, tuple[int, int]]  # first and last group of each list
    groups: int
    settings: Settings


_ROW = "group long, kind long, lists binary, ids binary, numbers binary, vectors binary, probes array<binary>"
_FIELDS = pa.schema([("group", pa.int64()), ("kind", pa.int64()), *((n, pa.binary()) for n in ("lists", "ids", "numbers", "vectors")), ("probes", pa.list_(pa.binary()))])


def build(vectors: DataFrame, settings: Settings = Settings()) -> Index | None:
    """The index over ``id`` and ``vector`` columns; None if no vector takes part.

    Fitted on at most ``sample_rows`` vectors (those of least hash), every
    vector is posted. Null and zero vectors and those with null or non-finite
    components take no part; lengths may differ, missing components are zero. Rows
    repeated in full are candidates each, told apart by a number.
    """
    doubles = F.col("vector").cast("array<double>")
    clean = vectors.filter(sound(F.col("vector"), with_zero=False)).select(F.col("id").cast("long"), doubles.alias("vector"))
    square = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x)
    size = clean.agg(F.max(F.size("vector")).alias("n"), F.max(square).alias("most"), F.count("*").alias("rows")).first()
    if size["n"] is None:
        return None
    width, norm = size["n"], float(np.sqrt(size["most"]))
    sample = clean.orderBy(F.xxhash64("id"), "id").limit(settings.sample_rows).select("vector").collect()
    centroids = Centroids(_raised(matrix([r[0] for r in sample], width), norm), settings)
    shared = vectors.sparkSession.sparkContext.broadcast(centroids)
    fields = pa.schema([("list", pa.int32()), ("id", pa.int64()), ("vector", pa.list_(pa.float64())), ("number", pa.int64())])

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = shared.value
        for batch in slices(batches, 1024):
            apart = lists.distances(_raised(matrix(batch.column(1), width), norm))
            copies = min(settings.copies, apart.shape[1])
            order = np.argpartition(apart, copies - 1, axis=1)[:, :copies] if copies < apart.shape[1] else np.tile(np.arange(copies), (len(apart), 1))
            near = np.take_along_axis(apart, order, 1)
            row, column = np.nonzero(near <= settings.border * near.min(1, keepdims=True))
            yield pa.RecordBatch.from_arrays([pa.array(order[row, column], pa.int32()), *[batch.column(c).take(pa.array(row)) for c in range(3)]], schema=fields)

    groups = -(-size["rows"] * settings.copies // settings.group_rows)
    posted = clean.withColumn("number", F.monotonically_increasing_id()).mapInArrow(post, "list int, id long, vector array<double>, number long")
    # The group is the place in the order of lists, whatever the number of partitions.
    placed = number_rows(posted, ["list", "id"], "place")
    posted = placed.select("list", "id", "vector", "number", F.floor((F.col("place") - 1) / settings.group_rows).alias("group"))
    spans = posted.groupBy("list").agg(F.min("group"), F.max("group")).collect()  # a row per centroid at most
    return Index(centroids, norm, width, posted, {r[0]: (r[1], r[2]) for r in spans}, groups, settings)


def _raised(rows: np.ndarray, norm: float) -> np.ndarray:
    """Rows with the component that brings them to the norm."""
    rest = np.sqrt(np.maximum(0, norm * norm - (rows**2).sum(1)))
    return np.column_stack((rows, rest))


def search(index: Index, queries: DataFrame, k: int) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k nearest found, ties to the smaller vec_id.

    Queries hold ``id`` and ``vector`` and are left out under the same rule as
    vectors. A query never meets rows of its own id. One that finds fewer than
    k in its lists reads all lists, so fewer than k come back only if there are
    no more candidates.
    """
    settings, width, norm = index.settings, index.width, index.norm
    shared = queries.sparkSession.sparkContext.broadcast((index.centroids, index.spans))
    clean = queries.filter(sound(F.col("vector"), with_zero=False)).select(F.col("id").cast("long"), F.col("vector").cast("array<double>").alias("vector"))

    def ask(everywhere: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            lists, spans = shared.value
            for batch in slices(batches, settings.queries_a_row):
                ids, rows = batch.column(0).to_numpy(), matrix(batch.column(1), width)
                at: dict[int, dict[int, list[int]]] = {}
                for i, row in enumerate(rows):
                    raised = np.append(row * (norm / np.sqrt(row @ row)), 0.0)
                    for near in range(len(lists.points)) if everywhere else lists.lists(raised, settings.reach).tolist():
                        first, last = spans.get(near, (0, -1))
                        for group in range(first, last + 1):
                            at.setdefault(group, {}).setdefault(i, []).append(near)
                for group, asking in at.items():
                    some = np.array(list(asking))
                    probes = [np.array(asking[i], dtype=np.int32).tobytes() for i in some.tolist()]
                    yield batch_of(_FIELDS, zip((group, 1, None, ids[some].tobytes(), None, rows[some].tobytes(), probes), strict=True))

        return run

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2048):
            group = batch.column(4).to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(group)]
            rows = matrix(batch.column(2), width)
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                lists, ids, numbers = (batch.column(c).to_numpy()[a:b].tobytes() for c in (0, 1, 3))
                yield batch_of(_FIELDS, zip((int(group[a]), 0, lists, ids, numbers, rows[a:b].tobytes(), None), strict=True))

    hits = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("number", pa.int64()), ("score", pa.float64())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, parts, held = None, [], None
        for batch in batches:
            for i in range(batch.num_rows):
                group, kind, lists, ids, numbers, vectors, probes = (batch.column(c)[i].as_py() for c in range(7))
                if group != current:
                    current, parts, held = group, [], None
                ids, vectors = np.frombuffer(ids, np.int64), np.frombuffer(vectors).reshape(-1, width)
                if kind == 0:
                    parts.append((np.frombuffer(lists, np.int32), ids, np.frombuffer(numbers, np.int64), vectors))
                    continue
                if held is None:
                    held = [np.concatenate(x) for x in zip(*parts, strict=True)]
                    order = np.argsort(held[0], kind="stable")
                    held, parts = [x[order] for x in held], []
                found = _nearest(held, ids, vectors, [np.frombuffer(p, np.int32) for p in probes], k, norm, settings.copies)
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*found, strict=True)], schema=hits)

    def found(some: DataFrame, everywhere: bool) -> DataFrame:
        both = index.postings.select("list", "id", "vector", "number", "group").mapInArrow(gather, _ROW).unionByName(some.mapInArrow(ask(everywhere), _ROW))
        met = both.repartition(index.groups, "group").sortWithinPartitions("group", "kind")
        # A vector may sit in lists of several groups.
        return met.mapInArrow(scan, "query_id long, vec_id long, number long, score double").distinct()

    near = written(best_per_query(found(clean, False), k), "nearest")
    full = near.groupBy("query_id").count().filter(F.col("count") >= k).select("query_id")
    rest = written(clean.join(full, clean["id"] == full["query_id"], "left_anti"), "short")
    if rest.isEmpty():
        return near
    return near.join(full, "query_id", "left_semi").unionByName(best_per_query(found(rest, True), k)).select(*near.columns)


def _nearest(held: list[np.ndarray], query_ids: np.ndarray, queries: np.ndarray, probes: list[np.ndarray], k: int, norm: float, copies: int) -> list[tuple[np.ndarray, ...]]:
    """Query, vector, its number and exact score of each query's k nearest in the lists it asks for here."""
    lists, ids, row_numbers, vectors = held
    numbers, starts = np.unique(lists, return_index=True)
    ends = np.append(starts[1:], len(lists))
    asked = np.array([np.isin(numbers, p) for p in probes])
    rough = np.full((len(queries), len(ids)), -np.inf)
    for n, (a, b) in enumerate(zip(starts.tolist(), ends.tolist(), strict=True)):
        some = np.flatnonzero(asked[:, n])
        rough[some, a:b] = queries[some] @ vectors[a:b].T
    rough[ids[None, :] == query_ids[:, None]] = -np.inf
    slack = 1e-9 * (1 + norm * np.sqrt((queries**2).sum(1)))
    most = k * copies  # a vector may sit in so many lists
    out = []
    for i, query in enumerate(query_ids):
        least = np.partition(rough[i], len(ids) - most)[len(ids) - most] - slack[i] if len(ids) > most else -np.inf
        some = np.flatnonzero((rough[i] >= least) & (rough[i] > -np.inf))
        exact = _products(vectors[some], queries[i])
        # One row posted to several lists counts once; repeated rows have numbers of their own.
        _, fresh = np.unique(row_numbers[some], return_index=True)
        some, exact = some[fresh], exact[fresh]
        kept = best(exact, ids[some], k)
        if len(kept):
            out.append((np.full(len(kept), query), ids[some][kept], row_numbers[some][kept], exact[kept]))
    return out


def _products(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products summed component by component, so that equal vectors score alike."""
    total = np.zeros(len(rows))
    for j in range(len(query)):
        total += rows[:, j] * query[j]
    return total
