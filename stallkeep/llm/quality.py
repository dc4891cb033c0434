"""Quality of documents: a generalised additive model with pairwise interactions.

Every feature has bins and a table of what each bin adds to the log odds; some
pairs of features have two-way tables. Tables are sums of many shallow trees,
boosted in turns over the features with small steps, so that none takes what
belongs to another. Scoring looks up bins and adds.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stallkeep.llm.common import free_name, weighed

FEATURES = (
    "log_bytes", "letters", "capitals", "digits", "marks", "spaces", "word_length", "distinct_words",
    "repeated_next", "stops", "shouts", "bars", "odd_ends", "line_length", "distinct_lines", "distinct_runs", "packed",
)

SAMPLE_ROWS = 20_000


def _classes() -> np.ndarray:
    kind = np.zeros(256, np.int64)  # 0 other
    for b in range(256):
        c = chr(b)
        if b >= 0xC0:
            kind[b] = 1  # first byte of a character beyond ASCII
        elif b < 128:
            kind[b] = 1 if c.islower() else 2 if c.isupper() else 3 if c.isdigit() else 4 if c.isspace() else 5 if c in ".,;:?'\"-()" else 6 if c == "!" else 7 if c == "|" else 8
    return kind


_KIND = _classes()


def features(text: str | None) -> list[float]:
    """Values of FEATURES over the whole text; a null text counts as empty, which gives zeros."""
    text = text or ""
    raw = text.encode()
    words = text.split()
    if not words:
        return [0.0] * len(FEATURES)
    counts = np.bincount(_KIND, weights=np.bincount(np.frombuffer(raw, np.uint8), minlength=256), minlength=9)
    size, n = len(raw), len(words)
    letters = counts[1] + counts[2]
    hashed = np.fromiter(map(hash, words), np.int64, n)
    distinct = len(np.unique(hashed))
    runs = hashed[: max(1, n - 2)] * 31 + hashed[min(1, n - 1) :][: max(1, n - 2)] * 17 + hashed[min(2, n - 1) :][: max(1, n - 2)]
    lines = [x for x in text.split("\n") if x.strip()]
    odd = sum(not (w[-1].isalnum() or w[-1] in ".,;:?'\")-") for w in words)
    return [
        float(np.log1p(size)),
        letters / size,
        counts[2] / max(1.0, letters),
        counts[3] / size,
        (counts[5] + counts[6] + counts[7] + counts[8]) / size,
        counts[4] / size,
        size / n,
        distinct / n,
        float((hashed[1:] == hashed[:-1]).sum()) / n,
        text.count(".") / n,
        counts[6] / size,
        counts[7] / size,
        odd / n,
        float(np.log1p(size / len(lines))),
        len(set(lines)) / len(lines),
        len(np.unique(runs)) / len(runs),
        len(zlib.compress(raw, 1)) / size,
    ]


@dataclass(frozen=True)
class Settings:
    bins: int = 32
    pair_bins: int = 12
    pairs: int = 6
    rounds: int = 150
    pair_rounds: int = 60
    step: float = 0.1
    leaf_weight: float = 2.0  # smallest sum of curvatures in a leaf
    ridge: float = 1.0


@dataclass(frozen=True)
class Model:
    base: float
    cuts: list[np.ndarray]
    tables: list[np.ndarray]
    pairs: list[tuple[int, int]]
    pair_cuts: list[np.ndarray]
    pair_tables: list[np.ndarray]

    def score(self, values: np.ndarray) -> np.ndarray:
        """Probability of label 1 for rows of feature values."""
        total = np.full(len(values), self.base)
        for j, (cuts, table) in enumerate(zip(self.cuts, self.tables, strict=True)):
            total += table[np.searchsorted(cuts, values[:, j], "right")]
        for (i, j), table in zip(self.pairs, self.pair_tables, strict=True):
            total += table[np.searchsorted(self.pair_cuts[i], values[:, i], "right"), np.searchsorted(self.pair_cuts[j], values[:, j], "right")]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _cuts(column: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1]))


def _split(gradient: np.ndarray, weight: np.ndarray, s: Settings, depth: int) -> np.ndarray:
    """Values per bin of a shallow tree over ordered bins."""
    def leaf(a: int, b: int) -> float:
        return gradient[a:b].sum() / (weight[a:b].sum() + s.ridge)

    def grow(a: int, b: int, left: int) -> None:
        out[a:b] = leaf(a, b)
        if not left or b - a < 2:
            return
        g, w = np.cumsum(gradient[a:b]), np.cumsum(weight[a:b])
        gl, wl, gr, wr = g[:-1], w[:-1], g[-1] - g[:-1], w[-1] - w[:-1]
        gain = gl**2 / (wl + s.ridge) + gr**2 / (wr + s.ridge)
        gain[(wl < s.leaf_weight) | (wr < s.leaf_weight)] = -1
        at = int(np.argmax(gain))
        if gain[at] > g[-1] ** 2 / (w[-1] + s.ridge) + 1e-12:
            grow(a, a + at + 1, left - 1)
            grow(a + at + 1, b, left - 1)

    out = np.zeros(len(gradient))
    grow(0, len(gradient), depth)
    return out


def _quarters(gradient: np.ndarray, weight: np.ndarray, s: Settings) -> tuple[np.ndarray, float]:
    """A tree of two levels over a table: one cut each way; its values and gain."""
    def part(x: np.ndarray) -> tuple[np.ndarray, ...]:
        c = x.cumsum(0).cumsum(1)
        low = c[:-1, :-1]
        return low, c[:-1, -1:] - low, c[-1:, :-1] - low, c[-1, -1] - c[:-1, -1:] - c[-1:, :-1] + low

    if min(gradient.shape) < 2:
        return np.zeros_like(gradient), 0.0
    gs, ws = part(gradient), part(weight)
    gain = sum(g**2 / (w + s.ridge) for g, w in zip(gs, ws, strict=True))
    i, j = np.unravel_index(int(np.argmax(gain)), gain.shape)
    out = np.zeros_like(gradient)
    for g, w, rows, columns in zip(gs, ws, (slice(0, i + 1), slice(0, i + 1), slice(i + 1, None), slice(i + 1, None)), (slice(0, j + 1), slice(j + 1, None), slice(0, j + 1), slice(j + 1, None)), strict=True):
        out[rows, columns] = g[i, j] / (w[i, j] + s.ridge)
    return out, float(gain[i, j])


def boost(values: np.ndarray, labels: np.ndarray, s: Settings = Settings()) -> Model:
    """The model of these rows. Without rows, or with one label only, every score is the labels' share (0.5 without)."""
    share = float(np.clip(labels.mean(), 1e-3, 1 - 1e-3)) if len(labels) else 0.5
    base = float(np.log(share / (1 - share)))
    width = len(FEATURES)
    if len(np.unique(labels)) < 2:
        none = [np.zeros(0)] * width
        return Model(base, none, [np.zeros(1)] * width, [], none, [])
    cuts = [_cuts(values[:, j], s.bins) for j in range(width)]
    bins = [np.searchsorted(c, values[:, j], "right") for j, c in enumerate(cuts)]
    tables = [np.zeros(len(c) + 1) for c in cuts]
    total = np.full(len(labels), base)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return labels - p, p * (1 - p)

    for _ in range(s.rounds):
        for j in range(width):
            residual, curve = slopes()
            size = len(tables[j])
            tree = _split(np.bincount(bins[j], residual, size), np.bincount(bins[j], curve, size), s, 2)
            tables[j] += s.step * tree
            total += s.step * tree[bins[j]]
    pair_cuts = [_cuts(values[:, j], s.pair_bins) for j in range(width)]
    coarse = [np.searchsorted(c, values[:, j], "right") for j, c in enumerate(pair_cuts)]

    def met(i: int, j: int, x: np.ndarray) -> np.ndarray:
        shape = (len(pair_cuts[i]) + 1, len(pair_cuts[j]) + 1)
        return np.bincount(coarse[i] * shape[1] + coarse[j], x, shape[0] * shape[1]).reshape(shape)

    residual, curve = slopes()
    gains = {(i, j): _quarters(met(i, j, residual), met(i, j, curve), s)[1] for i in range(width) for j in range(i)}
    pairs = sorted(gains, key=lambda p: (-gains[p], p))[: s.pairs]
    pair_tables = [np.zeros((len(pair_cuts[i]) + 1, len(pair_cuts[j]) + 1)) for i, j in pairs]
    for _ in range(s.pair_rounds):
        for n, (i, j) in enumerate(pairs):
            residual, curve = slopes()
            tree, _ = _quarters(met(i, j, residual), met(i, j, curve), s)
            pair_tables[n] += s.step * tree
            total += s.step * tree[coarse[i], coarse[j]]
    return Model(base, cuts, tables, pairs, pair_cuts, pair_tables)


def _table(texts: Sequence[str | None]) -> np.ndarray:
    return np.array([features(t) for t in texts], dtype=np.float64).reshape(len(texts), len(FEATURES))


def fit(documents: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, settings: Settings = Settings()) -> Model:
    """A model of at most about ``sample_rows`` labelled documents.

    documents: doc_id, text. labels: doc_id, label (0 or 1; other values and
    nulls are left out). The sample are the labels of least hash, so it does not
    depend on their order; only it and its features reach the driver. A repeated
    doc_id counts once per row, within the bound.
    """
    sound = labels.filter("doc_id is not null and label in (0, 1)").select(F.col("doc_id").cast("long"), F.col("label").cast("int"))
    sample = sound.orderBy(F.xxhash64("doc_id", "label"), "doc_id", "label").limit(sample_rows)
    fields = pa.schema([("doc_id", pa.int64()), ("label", pa.int32()), ("x", pa.list_(pa.float64()))])

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in weighed(batches, 2, 2_000_000):
            values = _table(batch.column(2).to_pylist()).tolist()
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(values, pa.list_(pa.float64()))], schema=fields)

    texts = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    held = texts.join(F.broadcast(sample), "doc_id").select("doc_id", "label", "text")
    rows = held.mapInArrow(take, "doc_id long, label int, x array<double>")
    rows = rows.orderBy(F.xxhash64("doc_id", "label"), "doc_id", "label", "x").limit(sample_rows).toArrow()
    values = np.array(rows.column("x").to_pylist(), dtype=np.float64).reshape(-1, len(FEATURES))
    return boost(values, rows.column("label").to_numpy().astype(np.float64), settings)


def scored(documents: DataFrame, model: Model, name: str = "quality_score") -> DataFrame:
    """All columns of documents and ``name``, the probability of label 1; the text is scored whole.

    A name that documents has already is refused.
    """
    names = documents.columns
    if free_name(documents, name) != name:
        raise ValueError(f"documents has a column {name}")
    at = [n.lower() for n in names].index("text")
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in weighed(batches, at, 2_000_000):
            score = shared.value.score(_table(batch.column(at).to_pylist()))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score)], names=[*names, name])

    schema = T.StructType([*documents.schema.fields, T.StructField(name, T.DoubleType())])
    return documents.mapInArrow(run, schema)
