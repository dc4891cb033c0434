"""The Merkle manifest against a plain tree."""

import hashlib

import pytest
from pyspark.sql import functions as F

from stallkeep.llm import merkle

SCHEMA = "lang string, doc_id long, leaf string, claimed string, root string, _tree int"


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def climb(nodes):
    """Root, and the siblings (left, right) of each node level by level."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for path, i in zip(paths, at, strict=True):
            run = i // 8 * 8
            path.append(("".join(nodes[run:i]), "".join(nodes[i + 1 : run + 8])))
        nodes = [digest("".join(nodes[k : k + 8])) for k in range(0, len(nodes), 8)]
        at = [i // 8 for i in at]
    return nodes[0], paths


def brute(rows):
    """{(lang, doc_id, leaf): [(subroot, root, proof, folded, verified)]}."""
    trees = {}
    for lang, doc_id, leaf, claimed in rows:
        trees.setdefault(lang, []).append((doc_id is not None, doc_id or 0, leaf, claimed))
    names = sorted(trees, key=lambda n: (n is not None, (n or "").encode()))
    roots, found = {}, []
    for name in names:
        trees[name].sort()
        roots[name] = climb([leaf for _, _, leaf, _ in trees[name]])
    root, tops = climb([roots[n][0] for n in names])
    for name, top in zip(names, tops, strict=True):
        for (there, doc_id, leaf, claimed), path in zip(trees[name], roots[name][1], strict=True):
            whole = [*path, *top]
            node = claimed
            for a, b in whole:
                node = digest(a + node + b)
            found.append((name, doc_id if there else None, leaf, roots[name][0], root, digest("".join(a + b for a, b in whole)), node, node == root))
    return sorted(found, key=repr)


def rows_of(sizes):
    out = []
    for lang, n in sizes.items():
        for i in range(n):
            leaf = digest(f"{lang}{i}")
            out.append((lang, None if i == 5 else i - i % 2, leaf, digest("no") if i % 3 == 0 else leaf))
    return out


@pytest.mark.parametrize(
    ("sizes", "levels"),
    [({"a": 1}, 3), ({None: 1, "": 9, "é": 64, "z": 65, "y": 200}, 1), ({"hot": 700, None: 70, "c": 512}, 3), ({str(i): i for i in range(1, 20)}, 1)],
)
def test_manifest_equals_a_plain_tree(spark, sizes, levels):
    rows = rows_of(sizes)
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(7)
    found = merkle.manifest(frame, "lang", ["doc_id"], carried=["lang", "doc_id"], claimed="claimed", block_levels=levels)
    assert sorted(map(tuple, found.collect()), key=repr) == brute(rows)


def test_proofs_lead_to_the_root(spark):
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows_of({"a": 30, "b": 2})], SCHEMA)
    for row in merkle.manifest(frame, "lang", ["doc_id"], with_proof=True).collect():
        node = row.leaf
        for step in row.proof:
            node = digest(step.left + node + step.right)
        assert node == row.root == row.folded_root and row.verified


def test_odd_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert merkle.manifest(empty, "lang", ["doc_id"], carried=["doc_id"]).collect() == []
    # A row repeated in full is a leaf of its own.
    twice = [("a", 1, digest("x"), digest("x"))] * 2
    frame = spark.createDataFrame([(*r, None, None) for r in twice], SCHEMA)
    assert sorted(map(tuple, merkle.manifest(frame, "lang", ["doc_id"], carried=["lang", "doc_id"]).collect()), key=repr) == brute(twice)


def test_record_digest(spark):
    long = "é" * 100_000
    frame = spark.createDataFrame([(1, None, "", long)], "a long, b string, c string, d string")
    found = frame.select(merkle.record_digest(*[F.col(c) for c in "abcd"])).first()[0]
    assert found == digest(f"1:1-0:200000:{long}")
