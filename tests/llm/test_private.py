"""Personal data: rules against plain patterns, the field against full enumeration, further mentions."""

import hashlib
import itertools
import random
import re

import numpy as np
import pytest

from stallkeep.llm import private, queries
from stallkeep.llm.private import CARD, EMAIL, IP, PHONE

PLAIN = {
    EMAIL: re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    IP: re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    CARD: re.compile(r"[0-9]([\x20-]?[0-9])+"),
    PHONE: re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def plain_spans(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in pattern.finditer(text):
            digits = [int(c) for c in m[0] if c.isdigit()]
            if kind == IP and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == CARD:
                doubled = [d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(reversed(digits))]
                if not 13 <= len(digits) <= 19 or sum(doubled) % 10:
                    continue
            if kind == PHONE and not 9 <= len(digits) <= 15:
                continue
            out.append((kind, m.start(), m.end()))
    return out


def test_rules_equal_the_plain_patterns():
    rng = random.Random(1)
    texts = ["".join(rng.choices("aZ019.@-+ _%()é\n", k=rng.randint(0, 40))) for _ in range(20_000)]
    texts += ["".join(rng.choices(["1", "25", "300", ".", ".", "+", " ", "-", "4111111111111111", "a@b.c"], k=rng.randint(1, 14))) for _ in range(20_000)]
    texts += ["", "x@y.z_w@q.r", "1.2.3.4.5.6.7.8", "0001.2.3.0255", "٣.٣.٣.٣", "4111-1111 1111-1111", "a@b@c.d", "+1 (805) 555-2417."]
    assert all(private.base_spans(t) == plain_spans(t) for t in texts)
    assert sum(len(plain_spans(t)) for t in texts) > 5000


@pytest.mark.parametrize("text", ["a" * 1_000_000 + "@", "1" * 1_000_000, "1." * 500_000, "+1" * 300_000, "+1" + "(" * 500_000, "@" * 300_000, "a@b." * 200_000 + " ", "7 " * 300_000])
def test_very_long_texts(text):
    base = private.base_spans(text)
    assert len(private.further_spans(private.blank(), [text], [base])[0]) == 0


def random_model(rng):
    skip = rng.normal(size=(3, 5, 5))
    return private.Model(rng.normal(size=private.blank().unary.shape) / 4, rng.normal(size=(private.LABELS, private.LABELS)), skip + skip.transpose(0, 2, 1))


def test_marginals_on_trees_equal_enumeration(monkeypatch):
    monkeypatch.setattr(private, "ROUNDS", 60)
    rng = np.random.default_rng(2)
    model = random_model(rng)
    features = [[0, 14, 19], [3, 15, 20], [5, 19], [7, 16, 22]]
    edges = [(0, 0, 1), (1, 1, 2), (2, 1, 3)]
    graph = private.Graph([0] * 4, [1] * 4, features, [-1, -1, 3, -1], edges)
    batch = private._joined([graph])
    nodes, pairs = (np.exp(x) for x in private.marginals(model, batch, batch.observed))
    wanted, wanted_pairs = np.zeros_like(nodes), np.zeros_like(pairs)
    kind_of = private._KIND_OF
    for labels in itertools.product(range(private.LABELS), repeat=4):
        if labels[2] != 3:
            continue
        score = sum(model.unary[f, y].sum() for f, y, seen in zip(features, labels, graph.observed, strict=True) if seen < 0)
        for kind, a, b in edges:
            y, z = labels[a], labels[b]
            score += model.chain[y, z] if kind == 0 else model.skip[kind - 1, kind_of[y], kind_of[z]]
        for i, y in enumerate(labels):
            wanted[i, y] += np.exp(score)
        for e, (_, a, b) in enumerate(edges):
            wanted_pairs[e, labels[a], labels[b]] += np.exp(score)
    np.testing.assert_allclose(nodes, wanted / wanted.sum(1, keepdims=True), atol=1e-6)
    np.testing.assert_allclose(pairs, wanted_pairs / wanted_pairs.sum((1, 2), keepdims=True), atol=1e-6)


def test_loops_settle_on_one_label():
    rng = np.random.default_rng(3)
    skip = np.zeros((3, 5, 5))
    skip[:, range(5), range(5)] = 2.0
    model = private.Model(rng.normal(size=private.blank().unary.shape) / 10, np.zeros((private.LABELS, private.LABELS)), skip)
    graph = private.Graph([0] * 4, [1] * 4, [[0]] * 4, [7, -1, -1, -1], [(1, 0, 1), (1, 1, 2), (1, 2, 3), (2, 0, 3)])
    batch = private._joined([graph])
    chance = np.exp(private.marginals(model, batch, batch.observed)[0])
    assert ((chance[:, 7] + chance[:, 8]) > 0.5).all()


def mentions(rng, i):
    phone = f"+1 ({rng.randrange(200, 999)}) {rng.randrange(200, 999)}-{rng.randrange(1000, 9999)}"
    card = "4" + "".join(str(rng.randrange(10)) for _ in range(14))
    card += next(str(d) for d in range(10) if private.luhn(card + str(d)))
    ip = ".".join(str(rng.randrange(10, 255)) for _ in range(4))
    return phone, card, ip, f"name.{rng.randrange(10, 99)}@mail{i % 9}.example.com"


@pytest.fixture(scope="module")
def found(spark):
    """Spans of documents with and without personal data, by the model that these documents give."""
    rng = random.Random(5)
    texts = {}
    for i in range(300):
        texts[i] = "some words %s and then %s or more. %s now, %s end" % mentions(rng, i)
    for i in range(300, 400):
        texts[i] = f"Version 2.0 of {rng.randint(1, 28)}.12.2024, order {rng.randrange(10**5)}, {rng.randrange(10**15, 10**16)}, at 12:30, 555-{rng.randrange(1000, 9999)} costs 1,299.00"
    texts[1000] = "Call +1 (805) 555-2417 today; later 555-2417 or 805.555.2417. But not 555-9999."
    texts[1001] = "Pay with 4111 1111 1111 1111, that is 4111.1111.1111.1111"
    texts[1002] = "Call 555-2417 or 805.555.2417"
    texts[1003], texts[1004], texts[1005] = None, "", "no marks " * 100_000 + "a.b@c.de"
    schema = "doc_id long, text string, spans string, _text int, KEY string"
    rows = [(i, t, "x", 1, "y") for i, t in texts.items()] + [(1000, texts[1000], None, None, None), (None, texts[1001], "x", 1, "y")]
    documents = spark.createDataFrame(rows, schema).repartition(6)
    model = private.fit(documents)
    return texts, private.personal_data(documents, model).collect()


def test_base_spans_stay(found):
    texts, rows = found
    assert len(rows) == len(texts) + 2
    for row in rows:
        text = texts[1001 if row.doc_id is None else row.doc_id] or ""
        assert [(s.kind, s.start, s.end) for s in row.spans if s.base] == plain_spans(text)
        assert list(row.spans) == sorted(row.spans)
        more = [s for s in row.spans if not s.base]
        assert not any(m.start < b.end and b.start < m.end for m in more for b in row.spans if b.base)


def test_repeated_mentions_are_found_and_clean_documents_left_alone(found):
    texts, rows = found
    added = {r.doc_id: [(s.kind, texts[r.doc_id][s.start : s.end]) for s in r.spans if not s.base] for r in rows if r.doc_id is not None}
    assert added[1000] == [(PHONE, "555-2417"), (PHONE, "805.555.2417")]
    assert added[1001] == [(CARD, "4111.1111.1111.1111")]
    assert not any(added[i] for i in [*range(400), 1002, 1003, 1004, 1005])


def test_empty_tables_and_models(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    model = private.fit(empty)
    assert private.personal_data(empty, model).collect() == []
    plain = spark.createDataFrame([(1, "call +49 170 1234567 or 0170 1234567")], "doc_id long, text string")
    assert [(s.kind, s.start, s.end) for s in private.personal_data(plain, model).first().spans] == [(PHONE, 5, 20)]


def test_query_counts_every_kind_apart(spark, tmp_path):
    texts = {
        1: "a@b.c and d@e.fg",
        2: "1.2.3.4 x 5.6.7.8 y 9.9.9.9 z 256.1.1.1",
        3: "4111 1111 1111 1111",
        4: "+1 805 555 2417, +49 30 1234567; a@b.c",
        5: None,
        6: "0" * 5000 + "1.2.3.4 and 1.2.3." + "0" * 5000 + "256",
        7: "+49 30 1234567 a@b.c 4111-1111-1111-1111 1.2.3.4 a@b.c",
    }
    spark.createDataFrame(list(texts.items()), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    rows = {r.doc_id: r for r in queries.op13_personal_data(spark, str(tmp_path)).collect()}
    for doc_id, text in texts.items():
        # Zeros in front, which plain patterns cannot turn into a number, keep their places.
        spans = plain_spans(text or "") if doc_id != 6 else [(IP, 0, 5007)]
        kinds = [k for k, _, _ in spans]
        row = rows[doc_id]
        assert (row.n_email, row.n_ip, row.n_card, row.n_phone) == tuple(kinds.count(k) for k in (EMAIL, IP, CARD, PHONE))
        joined = ",".join(f"{private.KINDS[k]}:{a}:{b}" for k, a, b in spans)
        assert row.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
