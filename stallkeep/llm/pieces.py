"""N-best segmentation into the pieces of a SentencePiece vocabulary, and decoding.

The score of a segmentation is the sum of its pieces' scores. A forward pass
(Viterbi) gives the best score of every prefix; a search from the end then
takes partial segmentations in order of their own score plus the best score of
what is left, which is exact, so complete ones come out best first (A*).

No piece reaches across the start of a word (white space after something else),
so the lattice of a text is a chain of the lattices of its words, and its n best
segmentations differ from the best one in at most the n - 1 words whose second
best costs least. Words' best ids, scores and second-best costs come from a
bounded table; only those few words are searched for more.
"""

from __future__ import annotations

import heapq
from array import array
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stallkeep.llm.common import batch_of, weighed
from stallkeep.llm.wordtable import WINDOW, WordTable

_SPACE = "▁"
_UNKNOWN_COST = 10.0  # below the lowest score of a piece, as SentencePiece has it


class Lattice:
    """Pieces, scores and the search over one string (spaces already marked)."""

    def __init__(self, model: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=model)
        m = self.model
        size = m.vocab_size()
        plain = [i for i in range(size) if not (m.is_control(i) or m.is_unknown(i) or m.is_byte(i) or m.is_unused(i))]
        self.pieces = {m.id_to_piece(i): (i, float(m.get_score(i))) for i in plain}
        self.bytes = {int(m.id_to_piece(i)[3:5], 16): i for i in range(size) if m.is_byte(i)}
        self.unknown = m.unk_id()
        self.prefixes = {p[:k] for p in self.pieces for k in range(1, len(p) + 1)}
        self.lowest = min((s for _, s in self.pieces.values()), default=0.0) - _UNKNOWN_COST
        if any(a != _SPACE and b == _SPACE for p in self.pieces for a, b in zip(p, p[1:], strict=False)):
            raise ValueError("pieces of this model reach across words")

    def edges(self, text: str) -> list[list[tuple[int, float, int]]]:
        """Per end position: (start, score, id); id -1 is a character without a piece."""
        ending: list[list[tuple[int, float, int]]] = [[] for _ in range(len(text) + 1)]
        for start in range(len(text)):
            single = False
            for end in range(start + 1, len(text) + 1):
                part = text[start:end]
                if part not in self.prefixes:
                    break
                found = self.pieces.get(part)
                if found:
                    ending[end].append((start, found[1], found[0]))
                    single |= end == start + 1
            if not single:
                ending[start + 1].append((start, self.lowest, -1))
        return ending

    def best(self, text: str) -> tuple[list[int], float, float]:
        """Ids and score of the best segmentation, and what the second best costs.

        Every other segmentation has an edge that is not the best one's, so the
        second best is the best that goes through such an edge: its forward
        score, its own and the best score of what follows.
        """
        ending = self.edges(text)
        size = len(text)
        forward, back, chosen = [0.0] * (size + 1), [-np.inf] * size + [0.0], [None] * (size + 1)
        for end in range(1, size + 1):
            top = -np.inf
            for edge in ending[end]:
                score = forward[edge[0]] + edge[1]
                if score > top:
                    top, chosen[end] = score, edge
            forward[end] = top
        second, whole = -np.inf, forward[size]
        path: tuple | None = None
        on = size
        for end in range(size, 0, -1):
            after = back[end]
            for edge in ending[end]:
                start = edge[0]
                score = edge[1] + after
                if score > back[start]:
                    back[start] = score
                if end != on or edge is not chosen[end]:
                    score += forward[start]
                    if score > second:
                        second = score
            if end == on:
                start, _, piece = chosen[end]
                path, on = (start, end, piece, path), start
        return self._ids(text, path), whole, whole - second

    def nbest(self, text: str, n: int) -> list[tuple[float, list[int]]]:
        """The n best segmentations (all, if fewer): score and ids, best first."""
        ending = self.edges(text)
        forward = [0.0] + [-np.inf] * len(text)
        for end in range(1, len(text) + 1):
            forward[end] = max((forward[s] + w for s, w, _ in ending[end]), default=-np.inf)
        # Among equals the one that is closer to the start goes first.
        queue: list[tuple[float, int, int, float, tuple | None]] = [(-forward[-1], len(text), 0, 0.0, None)]
        out: list[tuple[float, list[int]]] = []
        made = 0
        while queue and len(out) < n:
            _, at, _, score, path = heapq.heappop(queue)
            if at == 0:
                out.append((score, self._ids(text, path)))
                continue
            for start, weight, piece in ending[at]:
                made += 1
                own = score + weight
                heapq.heappush(queue, (-(own + forward[start]), start, made, own, (start, at, piece, path)))
        return out

    def _ids(self, text: str, path: tuple | None) -> list[int]:
        ids: list[int] = []
        while path is not None:
            start, end, piece, path = path
            if piece >= 0:
                ids.append(piece)
            else:
                ids += [self.bytes.get(b, self.unknown) for b in text[start:end].encode()]
        return ids


class Segmenter(WordTable):
    """The n best segmentations of whole texts. A null text counts as empty, which has one: no pieces."""

    values = 2  # the best score, and what the second best costs

    def __init__(self, model: str, known_words: int = 1_000_000):
        self.lattice = Lattice(model)
        self._few = lru_cache(maxsize=10_000)(self.lattice.nbest)
        super().__init__(known_words)

    @staticmethod
    @lru_cache(maxsize=2)
    def shared(model: str) -> Segmenter:
        """One segmenter for all tasks that a Python worker runs."""
        return Segmenter(model)

    def _ids_of(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        ids, values = [], np.zeros((len(words), 2))
        for k, word in enumerate(words):
            found, *values[k] = self.lattice.best(word.replace(" ", _SPACE))
            ids.append(array("I", found).tobytes())
        return np.frombuffer(b"".join(ids), "<u4"), np.array([len(i) // 4 for i in ids]), values

    def nbest(self, texts: Sequence[str | None], n: int) -> list[list[tuple[float, bytes]]]:
        """Per text its n best: score and ids as little-endian unsigned 32-bit bytes, best first."""
        # SentencePiece puts a space before a text and reads its own mark as a space.
        raw = [(" " + t.replace(_SPACE, " ")).encode() if t else b"" for t in texts]
        out: list[list[tuple[float, bytes]]] = []
        start = 0
        while start < len(raw):
            end, size = start, 0
            while end < len(raw) and (end == start or size + len(raw[end]) < WINDOW):
                size += len(raw[end])
                end += 1
            out += self._window(raw[start:end], n)
            start = end
        return out

    def _window(self, raw: list[bytes], n: int) -> list[list[tuple[float, bytes]]]:
        data = np.frombuffer(b"".join(raw), np.uint8)
        if not len(data):
            return [[(0.0, b"")] for _ in raw]
        edges = np.cumsum([0, *map(len, raw)])
        space = data == 32
        begins = space.copy()
        begins[1:] &= ~space[:-1]
        begins[edges[:-1][np.diff(edges) > 0]] = True
        starts = np.flatnonzero(begins)
        ends = np.append(starts[1:], len(data))
        slots = self._find(data, starts, ends)
        ids, total = self._gather(slots)
        until = np.concatenate(([0], total))
        values = self._value[slots]
        bounds = np.searchsorted(starts, edges)
        out = []
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            best = ids[until[a] : until[b]].tobytes()
            combos: list[tuple[float, tuple[tuple[int, bytes], ...]]] = [(0.0, ())]
            cost = values[a:b, 1]
            few = np.flatnonzero(np.isfinite(cost))
            few = few[np.argsort(cost[few], kind="stable")[: n - 1]]
            for k in few.tolist():
                word = data[starts[a + k] : ends[a + k]].tobytes().decode().replace(" ", _SPACE)
                options = self._few(word, n)
                top = options[0][0]
                other = [(top - s, ((k, np.array(i, dtype="<u4").tobytes()),)) for s, i in options[1:]]
                merged = combos + [(c + d, chosen + change) for c, chosen in combos for d, change in other]
                combos = sorted(merged, key=lambda x: x[0])[:n]
            whole = float(values[a:b, 0].sum())
            rows = []
            for lost, chosen in combos:
                parts, at = [], 0
                for k, changed in sorted(chosen):
                    first, last = (4 * (until[a + k + x] - until[a]) for x in (0, 1))
                    parts += [best[at:first], changed]
                    at = last
                rows.append((whole - lost, b"".join([*parts, best[at:]])))
            out.append(rows)
        return out


SEGMENTATIONS = "doc_id long, rank int, score double, ids binary"


def segment(documents: DataFrame, model: str, n: int) -> DataFrame:
    """doc_id, rank (from 1), score and ids of each document's n best segmentations.

    Every row of documents (doc_id, text) is segmented whole; a null or empty
    text has one segmentation of no pieces; a text with fewer than n gets all.
    Segmentations of equal score come in a fixed order. The vocabulary must be
    below 65,536 ids.
    """
    fields = pa.schema([("doc_id", pa.int64()), ("rank", pa.int32()), ("score", pa.float64()), ("ids", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segmenter = Segmenter.shared(model)
        for batch in weighed(batches, 1, 1_000_000):
            found = segmenter.nbest(batch.column(1).to_pylist(), n)
            rows = [(doc, r, *row) for doc, best in zip(batch.column(0).to_pylist(), found, strict=True) for r, row in enumerate(best, 1)]
            yield batch_of(fields, zip(*rows, strict=True))

    return documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, SEGMENTATIONS)


def decoded(segmentations: DataFrame, model: str) -> DataFrame:
    """All columns of segmentations and ``text``, what their ids spell. Spaces come back as spaces, whichever way they were cut."""
    names = segmentations.columns
    at = names.index("ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model_ = Segmenter.shared(model).lattice.model
        for batch in weighed(batches, at, 2_000_000):
            ids = [np.frombuffer(i, "<u4").tolist() for i in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(model_.decode(ids, num_threads=1) if ids else [], pa.string())], names=[*names, "text"])

    return segmentations.mapInArrow(run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in segmentations.schema.fields) + ", text string")
