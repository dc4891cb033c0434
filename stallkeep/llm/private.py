"""Personal data by rules and a skip-chain conditional random field.

Rules find the plain forms (``base_spans``). The field looks for further
mentions: its nodes are the tokens that hold a digit or an ``@``, or repeat a
part of an e-mail address found in the document; every other token is outside by
definition. Labels are the usual begin and inside of each kind, or outside.
Neighbours in the text share a chain potential. Tokens anywhere in the document
that repeat each other, or agree in all digits (of phone numbers the last
seven), share a skip potential; each occurrence is joined to the one before it and to the last one
observed, so there are at most two such edges for a token and key. Tokens of rule matches are observed. Loopy belief
propagation in ``ROUNDS`` rounds gives each token its marginals, for all
documents of a batch at once; a document's result depends on no other document.

The weights are learnt by gradient ascent on the likelihood that the same
propagation estimates. Examples are documents of a bounded sample, to which
mentions of their own matches in another form, and look-alikes that mean
nothing, are added.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from random import Random

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stallkeep.llm.common import batch_of, weighed

KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)
LABELS = 1 + 2 * len(KINDS)  # outside, then begin and inside of each kind
ROUNDS = 8
CUT = 0.6
SAMPLE_DOCUMENTS = 500
SAMPLE_TOKENS = 200  # documents with more nodes are not in the sample
STEPS = 100

# The characters and the forms of the plain mentions.
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"([0-9]++)(?:\.([0-9]++)\.([0-9]++)\.([0-9]++))?")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_MARK = re.compile(r"[0-9@]")
_TOKEN = re.compile(r"[A-Za-z0-9@._%+()-]+")
_OUTER = "._%-("
_KIND_OF = np.array([0, *(k for k in range(1, 5) for _ in range(2))])
_CHAIN, _REPEATED, _DIGITS, _TAIL = range(4)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the plain forms, by kind, then start; linear in the text.

    Per kind the leftmost matches that do not overlap; a match that fails its
    condition is dropped and not tried again.
    """
    out = []
    if "@" in text:
        done = 0  # where the last match ended, or behind the last @
        at = text.find("@")
        while at >= 0:
            start = done + len(text[done:at].rstrip(_LOCAL))
            domain = _DOMAIN.match(text, at + 1) if start < at else None
            done = at + 1
            if domain:
                out.append((EMAIL, start, domain.end()))
                done = domain.end()
            at = text.find("@", done)
    if not _MARK.search(text):
        return out
    for m in _IP.finditer(text):
        # Zeros in front count nothing, and int refuses thousands of digits.
        if m[2] is not None and all(len(p) < 4 and int(p or "0") <= 255 for p in (g.lstrip("0") for g in m.groups())):
            out.append((IP, m.start(), m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = _digits(m[0])
            if 13 <= len(digits) <= 19 and luhn(digits):
                out.append((CARD, m.start(), m.end()))
    if "+" in text:
        out += [(PHONE, m.start(), m.end()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return out


# Upper bounds of the classes of digit counts.
_COUNTS = np.array([0, 1, 2, 3, 4, 6, 7, 8, 10, 12, 15, 16, 19])
_FEATURES = len(_COUNTS) + 1 + 20


def _features(token: str, before: str, after: str) -> list[int]:
    digits = _digits(token)
    dots = token.count(".")
    parts = token.strip(_OUTER).split(".")
    n = len(_COUNTS) + 1
    found = [int(np.searchsorted(_COUNTS, len(digits))), n + min(dots, 4)]
    tests = (
        True,
        "@" in token,
        "@" in token and "." in token[token.index("@") :],
        any(c.isalpha() for c in token),
        token[0] == "+",
        "(" in token or ")" in token,
        "-" in token.strip(_OUTER),
        "_" in token or "%" in token,
        13 <= len(digits) <= 19 and luhn(digits),
        len(parts) == 4 and all(p.isdigit() and len(p) < 4 for p in parts),
        before not in " \n\t",
        after not in " \n\t",
        len(token) > 24,
        token.strip(_OUTER).isdigit(),
        not digits,
    )
    return found + [n + 5 + i for i, hit in enumerate(tests) if hit]


@dataclass
class Graph:
    """Nodes and edges of a text."""

    starts: list[int]
    ends: list[int]
    features: list[list[int]]
    observed: list[int]  # label, or -1
    edges: list[tuple[int, int, int]]  # kind of edge, first node, second node


def graph_of(text: str, base: list[tuple[int, int, int]]) -> Graph:
    """The field over a text; long runs between nodes are passed in one step."""
    parts: set[str] = set()
    for kind, start, end in base:
        if kind == EMAIL:
            local, _, domain = text[start:end].lower().partition("@")
            parts |= {p for p in (local, domain) if len(p) > 4}
    spans = []
    if parts:
        spans = [m.span() for m in _TOKEN.finditer(text) if _MARK.search(m[0]) or m[0].strip(_OUTER).lower() in parts]
    else:
        done = 0
        for mark in _MARK.finditer(text):
            if mark.start() >= done:
                start = done + len(text[done : mark.start()].rstrip(_LOCAL + "@()"))
                done = _TOKEN.match(text, start).end()
                spans.append((start, done))
    graph = Graph([], [], [], [], [])
    covered = sorted((s, e, k) for k, s, e in base)
    reach, at = 0, 0
    last: dict[tuple[int, str], int] = {}
    sure: dict[tuple[int, str], int] = {}  # observed ones
    joined: dict[tuple[int, int], int] = {}
    open_spans: list[tuple[int, int, int]] = []
    for node, (start, end) in enumerate(spans):
        token = text[start:end]
        while at < len(covered) and covered[at][0] < end:
            open_spans.append(covered[at])
            at += 1
        open_spans = [s for s in open_spans if s[1] > start]
        label = -1
        if open_spans:
            s, _, kind = open_spans[0]
            label = 1 + 2 * kind + (s < start)
        graph.starts.append(start)
        graph.ends.append(end)
        graph.observed.append(label)
        graph.features.append(_features(token, text[start - 1] if start else " ", text[end] if end < len(text) else " "))
        if node and start - reach <= 3 and not any(c.isalnum() for c in text[reach:start]):
            joined[node - 1, node] = _CHAIN
        reach = end
        keys = [(_REPEATED, token.strip(_OUTER + "+)").lower())]
        digits = _digits(token)
        of = open_spans[0][2] if open_spans else None
        if len(digits) >= 7:
            keys.append((_DIGITS, digits))
            # Phone numbers are written with and without what leads to the last seven digits.
            if of in (None, PHONE):
                keys.append((_TAIL, digits[-7:]))
        # A match over several tokens is known by its first one.
        if open_spans and open_spans[0][0] >= start:
            whole = text[open_spans[0][0] : open_spans[0][1]]
            keys.append((_DIGITS, _digits(whole)))
            if of == PHONE:
                keys.append((_TAIL, _digits(whole)[-7:]))
            elif of == EMAIL:
                keys += [(_REPEATED, p) for p in whole.lower().split("@")]
        for key in dict.fromkeys(k for k in keys if len(k[1]) > 4):
            for before in (last, sure):
                if key in before:
                    joined.setdefault((before[key], node), key[0])
            last[key] = node
            if of is not None:
                sure[key] = node
    # An edge between two observed tokens decides nothing.
    graph.edges = [(kind, a, b) for (a, b), kind in joined.items() if graph.observed[a] < 0 or graph.observed[b] < 0]
    return graph


@dataclass(frozen=True)
class Model:
    unary: np.ndarray  # features x labels
    chain: np.ndarray  # labels x labels
    skip: np.ndarray  # repeated, alike in digits, in the last digits; kinds x kinds


def blank() -> Model:
    return Model(np.zeros((_FEATURES, LABELS)), np.zeros((LABELS, LABELS)), np.zeros((3, len(KINDS) + 1, len(KINDS) + 1)))


@dataclass
class _Batch:
    """Several graphs as arrays."""

    incidence: tuple[np.ndarray, np.ndarray]  # node, feature
    observed: np.ndarray
    edges: np.ndarray


def _joined(graphs: list[Graph]) -> _Batch:
    rows, columns, observed, edges, base = [], [], [], [], 0
    for g in graphs:
        for i, f in enumerate(g.features):
            rows += [base + i] * len(f)
            columns += f
        observed += g.observed
        edges += [(kind, base + a, base + b) for kind, a, b in g.edges]
        base += len(g.observed)
    return _Batch((np.array(rows, np.int64), np.array(columns, np.int64)), np.array(observed, np.int64), np.array(edges, np.int64).reshape(-1, 3))


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    most = x.max(axis, keepdims=True)
    return np.log(np.exp(x - most).sum(axis, keepdims=True)) + most


def marginals(model: Model, batch: _Batch, observe: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log marginals of nodes and, in ``edges`` order, of edges; nodes with ``observe`` >= 0 are fixed."""
    n = len(batch.observed)
    rows, columns = batch.incidence
    unary = np.zeros((n, LABELS))
    np.add.at(unary, rows, model.unary[columns])
    fixed = np.flatnonzero(observe >= 0)
    unary[fixed] = -30.0
    unary[fixed, observe[fixed]] = 0.0
    tables = np.concatenate([model.chain[None], model.skip[:, _KIND_OF][:, :, _KIND_OF]])
    kind, a, b = batch.edges.T
    table = tables[kind]
    forward, backward = np.zeros((len(kind), LABELS)), np.zeros((len(kind), LABELS))
    for _ in range(ROUNDS):
        belief = unary.copy()
        np.add.at(belief, b, forward)
        np.add.at(belief, a, backward)
        to_b = _log_sum(table + (belief[a] - backward)[:, :, None], 1)[:, 0]
        to_a = _log_sum(table + (belief[b] - forward)[:, None, :], 2)[:, :, 0]
        # Half of each message is kept: loops settle.
        forward = 0.5 * (forward + to_b - to_b.max(1, keepdims=True))
        backward = 0.5 * (backward + to_a - to_a.max(1, keepdims=True))
    belief = unary.copy()
    np.add.at(belief, b, forward)
    np.add.at(belief, a, backward)
    pairs = table + (belief[a] - backward)[:, :, None] + (belief[b] - forward)[:, None, :]
    flat = pairs.reshape(len(kind), LABELS**2)
    return belief - _log_sum(belief, 1), (flat - _log_sum(flat, 1)).reshape(pairs.shape)


def train(graphs: list[Graph], labels: list[list[int]], steps: int = STEPS, weight_decay: float = 1e-3) -> Model:
    """Weights under which the labels of the nodes that are not observed are likely."""
    model = blank()
    if not graphs:
        return model
    batch = _joined(graphs)
    truth = np.concatenate([np.array(x, np.int64) for x in labels])
    free = batch.observed < 0
    if not free.any():
        return model
    rows, columns = batch.incidence
    used = free[rows]
    kind, a, b = batch.edges.T
    wanted = np.eye(LABELS)
    scale = 1.0 / max(1, int(free.sum()))
    moments = [np.zeros_like(p) for p in (model.unary, model.chain, model.skip)]
    for step in range(steps):
        node, edge = (np.exp(x) for x in marginals(model, batch, batch.observed))
        gap = wanted[truth] - node
        unary = np.zeros_like(model.unary)
        np.add.at(unary, columns[used], gap[rows[used]])
        pair = wanted[truth[a]][:, :, None] * wanted[truth[b]][:, None, :] - edge
        chain = pair[kind == _CHAIN].sum(0)
        skip = np.zeros_like(model.skip)
        for k in (_REPEATED, _DIGITS, _TAIL):
            of_kind = pair[kind == k].sum(0)
            np.add.at(skip[k - 1], (_KIND_OF[:, None], _KIND_OF[None, :]), of_kind)
            skip[k - 1] = (skip[k - 1] + skip[k - 1].T) / 2
        # Steps of alike size for all weights (RMSProp), smaller towards the end.
        rate = 0.3 * (1 - step / steps)
        new = []
        for i, (weights, slope) in enumerate(zip((model.unary, model.chain, model.skip), (unary, chain, skip), strict=True)):
            slope = slope * scale - weight_decay * weights
            moments[i] = 0.9 * moments[i] + 0.1 * slope**2
            new.append(weights + rate * slope / (np.sqrt(moments[i]) + 1e-3))
        model = Model(*new)
    return model


def _example(text: str, seed: int) -> tuple[Graph, list[int]] | None:
    """A text of the sample with further mentions behind it, and the labels of its nodes."""
    rng = Random(seed)
    base = base_spans(text)
    text += "\n"
    added: list[tuple[int, int, int]] = []  # label 0 or kind + 1, start, end

    def put(label: int, what: str) -> None:
        nonlocal text
        text += rng.choice(["and ", "see ", "again: ", "", "("]) if label else rng.choice(["no ", "in ", "", "# "])
        added.append((label, len(text), len(text) + len(what)))
        text += what + rng.choice([" ok", ", then", " x", ".\n"])

    for kind, start, end in base[:20]:
        found = text[start:end]
        digits = _digits(found)
        if kind == PHONE:
            local = digits[-10:]
            forms = [f"({local[:-7]}) {local[-7:-4]}-{local[-4:]}", f"{local[:-7]}.{local[-7:-4]}.{local[-4:]}", f"{local[-7:-4]}-{local[-4:]}", digits, f"{local[:-7]}-{local[-7:-4]}-{local[-4:]}"]
        elif kind == CARD:
            forms = [".".join(digits[i : i + 4] for i in range(0, len(digits), 4)), "_".join(digits[i : i + 4] for i in range(0, len(digits), 4))]
        elif kind == IP:
            forms = [found.replace(".", "-"), found.replace(".", "_")]
        else:
            local, _, domain = found.partition("@")
            forms = [f"{local}@{domain.split('.')[0]}", f"{local} @ {domain}"]
        if rng.random() < 0.6:
            put(kind + 1, rng.choice(forms))
        if rng.random() < 0.6:  # alike in form, but no mention of anything in the text
            other = "".join(str(rng.randrange(10)) if c.isdigit() else c for c in rng.choice(forms))
            if kind != EMAIL and not base_spans(other):
                put(0, other)
    for _ in range(rng.randint(0, 3)):
        n = rng.randint(1, 19)
        what = rng.choice(["".join(str(rng.randrange(10)) for _ in range(n)), f"{rng.randint(1, 28)}.{rng.randint(1, 12)}.20{rng.randint(10, 29)}", f"{rng.randint(0, 23)}:{rng.randint(10, 59)}", f"v{rng.randint(0, 9)}.{rng.randint(0, 30)}", f"{rng.randrange(9999)}.{rng.randrange(10, 99)}", f"{rng.getrandbits(64):x}", "@home", "20" + str(rng.randint(10, 29))])
        if not base_spans(what):
            put(0, what)
    base = [s for s in base_spans(text) if not any(s[1] < e and b < s[2] for _, b, e in added)]
    graph = graph_of(text, base)
    if not graph.starts or len(graph.starts) > SAMPLE_TOKENS:
        return None
    labels = []
    for start, end, seen in zip(graph.starts, graph.ends, graph.observed, strict=True):
        hit = next(((k, s) for k, s, e in added if k and s < end and start < e), None)
        labels.append(seen if seen >= 0 else 0 if hit is None else 2 * hit[0] - 1 + (hit[1] < start))
    return graph, labels


_EXAMPLES = "chosen long, observed array<int>, labels array<int>, features array<array<int>>, edges array<array<int>>"


def fit(documents: DataFrame, sample: int = SAMPLE_DOCUMENTS) -> Model:
    """A model of a bounded sample: at most ``sample`` documents with at most SAMPLE_TOKENS nodes each.

    Columns doc_id and text are read. Documents are chosen by a hash of their
    doc_id; a doc_id that many rows share is in the sample as often as the bound
    allows. Without any document the model finds nothing beyond the rules.
    """
    rows = documents.count()
    share = min(1.0, 20 * sample / max(1, rows))
    chosen = F.xxhash64("doc_id")
    picked = documents.select(chosen.alias("chosen"), F.col("text").cast("string").alias("text"))
    picked = picked.filter((F.pmod("chosen", F.lit(1_000_003)) < int(share * 1_000_003) + 1) & F.col("text").rlike("[0-9@]"))
    whole = pa.list_(pa.int32())
    fields = pa.schema([("chosen", pa.int64()), ("observed", whole), ("labels", whole), ("features", pa.list_(whole)), ("edges", pa.list_(whole))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in weighed(batches, 1, 2_000_000):
            out = []
            for key, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if found := _example(text, zlib.crc32(text.encode(errors="replace"))):
                    graph, labels = found
                    out.append((key, graph.observed, labels, graph.features, graph.edges))
            if out:
                yield batch_of(fields, zip(*out, strict=True))

    found = picked.mapInArrow(run, _EXAMPLES).orderBy("chosen", F.xxhash64("features", "edges")).limit(sample).collect()
    graphs = [Graph([], [], r.features, r.observed, [tuple(e) for e in r.edges]) for r in found]
    return train(graphs, [r.labels for r in found])


def further_spans(model: Model, texts: list[str], bases: list[list[tuple[int, int, int]]]) -> list[list[tuple[int, int, int]]]:
    """Per text the (kind, start, end) that the field adds to the matches of the rules."""
    graphs = [graph_of(t, b) if _MARK.search(t) else Graph([], [], [], [], []) for t, b in zip(texts, bases, strict=True)]
    batch = _joined(graphs)
    if not len(batch.observed):
        return [[] for _ in texts]
    chance = np.exp(marginals(model, batch, batch.observed)[0])
    of_kind = chance[:, 1::2] + chance[:, 2::2]
    best = of_kind.argmax(1)
    sure = (batch.observed < 0) & (of_kind[np.arange(len(best)), best] >= CUT)
    begins = chance[np.arange(len(best)), 1 + 2 * best] >= chance[np.arange(len(best)), 2 + 2 * best]
    out, base = [], 0
    for text, graph in zip(texts, graphs, strict=True):
        spans: list[tuple[int, int, int]] = []
        chained = {b for kind, a, b in graph.edges if kind == _CHAIN}
        for i, (start, end) in enumerate(zip(graph.starts, graph.ends, strict=True)):
            node = base + i
            if not sure[node]:
                continue
            token = text[start:end]
            left = start + len(token) - len(token.lstrip(_OUTER[:-1]))
            right = end - len(token) + len(token.rstrip(_OUTER))
            if left >= right:
                continue
            kind = int(best[node])
            if spans and i and sure[node - 1] and i in chained and not begins[node] and spans[-1][0] == kind:
                spans[-1] = (kind, spans[-1][1], right)
            else:
                spans.append((kind, left, right))
        out.append(spans)
        base += len(graph.starts)
    return out


SPANS = "array<struct<kind:int,start:long,end:long,base:boolean>>"


def personal_data(documents: DataFrame, model: Model, key: str = "doc_id") -> DataFrame:
    """``key`` and ``spans`` of every document, by kind (its place in KINDS), then start.

    Offsets are code points, the end exclusive; ``base`` tells the matches of the
    rules from those that the field adds, which overlap none of them. Columns
    ``key`` and text are read; a null text counts as empty; rows repeated in full
    are answered each. No rows give no rows.
    """
    kind = documents.schema[key].dataType
    span = pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in weighed(batches, 1, 2_000_000):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            bases = [base_spans(t) for t in texts]
            more = further_spans(model, texts, bases)
            spans = [sorted([(*s, True) for s in b] + [(*s, False) for s in m]) for b, m in zip(bases, more, strict=True)]
            found = pa.array([[dict(zip(("kind", "start", "end", "base"), s, strict=True)) for s in some] for some in spans], pa.list_(span))
            yield pa.RecordBatch.from_arrays([batch.column(0), found], names=[key, "spans"])

    rows = documents.select(F.col(f"`{key}`"), F.col("text").cast("string").alias("_text"))
    return rows.mapInArrow(run, f"`{key}` {kind.simpleString()}, spans {SPANS}")
