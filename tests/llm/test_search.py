"""Exact and approximate vector search against brute force."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from stallkeep.llm import ann, topk

SCHEMA = "id long, vector array<float>, rank int, score string"


def exact(vectors, queries, k, score):
    out = []
    for q, v in queries:
        best = sorted(((-score(v, w), i) for i, w in vectors if i != q))[:k]
        out += [(q, n, i, -s) for n, (s, i) in enumerate(best, 1)]
    return sorted(out)


def dot(a, b):
    total = 0
    for x, y in zip(a, b):
        total += x * y
    return total


def rows(df):
    return sorted(tuple(r) for r in df.select("query_id", "rank", "vec_id", "score").collect())


@pytest.fixture(scope="module")
def points():
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(12, 6))
    some = [(i, (centres[i % 12] + 0.1 * rng.normal(size=6)).astype(np.float32)) for i in range(600)]
    return [(i, [float(x) for x in v]) for i, v in some] + [(1000 + i, [1.0, 0.0, 0.0, 0.0, 0.0, 0.0]) for i in range(300)]


def frame(spark, points):
    return spark.createDataFrame([(i, v, 1, "x") for i, v in points], SCHEMA)


ODD = [(5000, None), (5001, [0.1, None]), (5002, [float("nan"), 1.0]), (5003, [float("inf")]), (5004, [0.5, 0.25]), (5004, [0.5, 0.5]), (5005, [0.0, 0.0])]


def test_topk_is_exact_with_hot_and_odd_vectors(spark, points):
    vectors = topk.quantised(frame(spark, points + ODD))
    kept = [(i, [int(np.floor(256.0 * x)) for x in v]) for i, v in points + ODD[4:]]
    got = rows(topk.exact_topk(vectors, vectors.filter("id % 50 = 0"), 5))
    assert got == exact(kept, [(i, v) for i, v in kept if i % 50 == 0], 5, dot)


def test_topk_beyond_doubles(spark):
    kept = [(i, [(1 << 40) + i, i]) for i in range(20)]
    vectors = spark.createDataFrame(kept, "id long, terms array<long>")
    with pytest.raises(Exception, match="[Oo]verflow|too large|C long|int64"):
        topk.exact_topk(vectors, vectors, 2).collect()
    kept = [(i, [(1 << 30) + i, 1 << 29]) for i in range(20)]
    vectors = spark.createDataFrame(kept, "id long, terms array<long>")
    assert rows(topk.exact_topk(vectors, vectors, 3)) == exact(kept, kept, 3, dot)


def test_topk_of_few_and_none(spark):
    vectors = spark.createDataFrame([(1, [1]), (2, [2])], "id long, terms array<long>")
    assert rows(topk.exact_topk(vectors, vectors, 5)) == [(1, 1, 2, 2), (2, 1, 1, 2)]
    assert topk.exact_topk(vectors.limit(0), vectors.limit(0), 5).count() == 0
    assert topk.exact_topk(vectors, vectors.limit(0), 5).count() == 0


def test_blocks_are_pruned(points):
    ids = np.array([i for i, _ in points])
    order = np.argsort([np.argmax(v) for _, v in points], kind="stable")
    terms = np.array([[np.floor(256 * x) for x in v] for _, v in points])[order]
    group = topk._Group(ids[order], terms)
    query = terms[0]
    bounds = np.where(query > 0, query, 0) @ group.largest.T + np.where(query < 0, query, 0) @ group.smallest.T
    blocks = np.arange(len(order)) // topk.BLOCK
    scores = terms @ query
    assert all(bounds[b] >= s for b, s in zip(blocks, scores))
    assert (bounds < np.sort(scores)[-5]).any()


def test_ann_recall_and_scores(spark, points):
    vectors = frame(spark, points + ODD)
    index = ann.build(vectors, ann.Settings(sample_rows=400))
    found = rows(ann.search(index, vectors.filter("id % 20 = 0"), 20))
    kept = [(i, v) for i, v in points + ODD[4:6]]
    truth = exact(kept, [(i, v) for i, v in kept if i % 20 == 0], 20, dot)
    assert {(q, n) for q, n, _, _ in found} == {(q, n) for q, n, _, _ in truth}
    values = {i: [v for j, v in kept if j == i] for i, _ in kept}
    assert all(any(dot(values[q][0], v) == s for v in values[i]) for q, _, i, s in found)
    for q in {f[0] for f in found}:
        ranked = [(-s, i) for a, _, i, s in found if a == q]
        assert ranked == sorted(ranked) and q not in [i for _, i in ranked]
    common = {(q, i) for q, _, i, _ in found} & {(q, i) for q, _, i, _ in truth}
    assert len(common) >= 0.9 * len(truth)
    assert index.postings.count() >= len(points) + 2


def test_ann_repeated_rows_are_candidates_each(spark):
    """A row repeated more often than k, alone and among others: every other candidate keeps its place."""
    rng = np.random.default_rng(9)
    points = [(i, rng.normal(size=6).tolist()) for i in range(40)] + [(77, rng.normal(size=6).tolist())] * 100
    vectors = frame(spark, points)
    for queries, k in (([0, 20], 20), ([0, 20], 120), ([77], 20)):
        found = rows(ann.search(ann.build(vectors), vectors.filter(F.col("id").isin(queries)).dropDuplicates(["id"]), k))
        wanted = []
        for q in queries:
            own = dict(points)[q]
            ranked = sorted(((dot(own, v), i) for i, v in points if i != q), key=lambda x: (-x[0], x[1]))[:k]
            wanted += [(q, n, i) for n, (_, i) in enumerate(ranked, 1)]
        assert len(found) == len(wanted)
        for q in queries:
            got, best = (Counter(f[2] for f in some if f[0] == q) for some in (found, wanted))
            assert q not in got and (got & best).total() >= 0.85 * best.total()
            # Either no copy is near enough, or as many as there are places.
            assert got[77] == best[77]


def test_ann_of_few_and_none(spark):
    vectors = spark.createDataFrame([(1, [1.0], 0, ""), (2, [2.0], 0, "")], SCHEMA)
    assert rows(ann.search(ann.build(vectors), vectors, 20)) == [(1, 1, 2, 2.0), (2, 1, 1, 2.0)]
    assert ann.build(vectors.limit(0)) is None
    assert ann.search(ann.build(vectors), vectors.limit(0), 3).count() == 0


def test_graph_walk_finds_the_lists_in_reach():
    rng = np.random.default_rng(6)
    sample = rng.normal(size=(2000, 8))
    lists = ann.Centroids(sample, ann.Settings())
    sizes = np.bincount(np.argmin(lists.distances(sample), axis=1), minlength=len(lists.points))
    assert len(lists.points) == 128 and sizes.max() < 100
    met = wanted = 0
    for query in rng.normal(size=(50, 8)):
        apart = lists.distances(query[None])[0]
        near = set(np.flatnonzero(apart <= 1.35 * apart.min()).tolist())
        met, wanted = met + len(near & set(lists.lists(query, 1.35).tolist())), wanted + len(near)
    assert met >= 0.98 * wanted
