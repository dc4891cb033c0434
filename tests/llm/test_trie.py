"""The conversation trie against a plain dictionary of prefixes."""

import hashlib
import random

import pytest

from stallkeep.llm import trie
from stallkeep.llm.art import Direct, Indexed, RadixTree, Sorted, climb

CONVERSATIONS = "conv_id long, turn long, role string, text string, id string, place long, words string"


def test_radix_tree_holds_every_key_in_every_layout():
    rng = random.Random(1)
    keys = {bytes(rng.choices(range(8), k=rng.randint(0, 6))) for _ in range(2000)}
    keys |= {b"wide" + bytes([b]) + b"tail" for b in range(256)} | {b"mid" + bytes([b]) for b in range(40)} | {b"x" * 300}
    tree = RadixTree()
    for key in rng.sample(sorted(keys), len(keys)):
        tree.insert(key, key.hex() + "!")
    assert all(tree.get(key) == key.hex() + "!" for key in keys)
    assert tree.get(b"wide") is None and tree.get(b"nothing") is None and tree.get(b"x" * 299) is None
    visited = [(node, key) for node, key, _ in climb(tree)]
    assert {key for node, key in visited if node.value} == keys
    assert {type(node) for node, _ in visited} == {Sorted, Indexed, Direct} and {n.size for n, _ in visited if isinstance(n, Sorted)} == {4, 16}
    # Inner nodes without a key of their own have at least two children.
    assert all(node.value or len(list(node.ordered())) > 1 for node, _ in visited)
    tree.insert(b"mid", "new")
    assert tree.get(b"mid") == "new"


def brute(conversations):
    """Rows of the trie of {conv_id: [(role, text)]}."""
    nodes = {}
    for conv, turns in conversations.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(conv)
    out = []
    for prefix, members in nodes.items():
        d = len(prefix)
        below = [(p, m) for p, m in nodes.items() if p[:d] == prefix]
        childless = [p for p, _ in below if not any(len(q) == len(p) + 1 and q[: len(p)] == p for q, _ in below)]
        saved = sum((len(m) - 1) * len(p[-1][1].split()) for p, m in below if p)
        ends = ",".join(str(c) for c in sorted(members) if len(conversations[c]) == d)
        parent = min(nodes[prefix[:-1]]) if d else None
        children = sum(len(p) == d + 1 for p, _ in below)
        out.append((min(members), d, parent, len(members), children, len(childless), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def found(spark, conversations, extra=()):
    rows = [(c, i, role, text, "x", 7, None) for c, turns in conversations.items() for i, (role, text) in enumerate(turns)]
    random.Random(3).shuffle(rows)
    frame = spark.createDataFrame([*rows, *extra], CONVERSATIONS).repartition(5)
    ids = spark.createDataFrame([(c,) for c in conversations], "conv_id long")
    return sorted(map(tuple, trie.prefix_trie(trie.turns(frame), ids).collect()), key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_trie_of_random_conversations(spark, seed, monkeypatch):
    monkeypatch.setattr(trie, "CHUNK", 3)  # several levels; the tasks of a local session share the value
    monkeypatch.setattr(trie, "IDS_A_PIECE", 4)
    rng = random.Random(seed)
    turn = lambda: (rng.choice(["user", "assistant", ""]), rng.choice(["", "one", "two words", "a\tb\nc"]))
    conversations = {}
    for c in rng.sample(range(-50, 200), 90):
        old = rng.choice([[], *conversations.values()])
        conversations[c] = [*old[: rng.randint(0, len(old))], *(turn() for _ in range(rng.randint(0, 3)))]
    for c in range(300, 340):  # copies, and what goes on behind them
        conversations[c] = [("user", "hot")] * 9 + [("user", str(c))] * (c % 3)
    conversations[500] = [("user", "long")] * 60
    conversations[501] = [("user", "long")] * 31
    assert found(spark, conversations) == brute(conversations)


def test_trie_of_odd_rows(spark):
    assert found(spark, {}) == []
    assert found(spark, {7: []}) == brute({7: []})
    long = "w " * 300_000
    # A null turn comes first, null role and text are empty, rows without a conversation are left out.
    extra = [(1, None, None, None, None, None, None), (None, 0, "user", "gone", None, None, None)]
    wanted = brute({1: [("", ""), ("user", long)], 2: [("", "")]})
    assert found(spark, {1: [("user", long)], 2: [("", "")]}, extra) == wanted
    # Repeated turn numbers go by id: the order of the rows does not matter.
    rows = [(1, 0, "a", "x"), (1, 0, "b", "y"), (1, 0, "a", "x"), (2, 0, "b", "y"), (2, 0, "a", "x"), (2, 0, "a", "x")]
    frame = spark.createDataFrame([(*r, None, None, None) for r in rows], CONVERSATIONS)
    ids = frame.select("conv_id").distinct()
    assert [(r.conv_id, r.depth, r.n_convs) for r in trie.prefix_trie(trie.turns(frame), ids).orderBy("depth").collect()] == [(1, d, 2) for d in range(4)]
