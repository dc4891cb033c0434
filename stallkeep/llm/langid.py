"""Language of documents by bit-sliced Bloom filters over byte n-grams.

Every language has a Bloom filter of its n-grams; the filters share their hash
functions and lie across each other, so one lookup per hash gives a bitmask of
all languages that hold an n-gram. A text's score for a language is the share
of its n-grams whose mask has that language's bit, less what the filter's rate
of false positives adds; the highest decides.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stallkeep.llm.common import batch_of, free_name, weighed, written
from stallkeep.llm.words import mixed

UNKNOWN = "und"
N = 4  # bytes of an n-gram
SAMPLE_DOCUMENTS = 40_000
HELD = 500_000  # characters, and rows of counts, that a task works on at once

_LETTER = re.compile(r"[^\W\d_]")
_BLANK = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


@dataclass(frozen=True)
class Settings:
    slots_log2: int = 20
    hashes: int = 2  # slots_log2 bits each of one 64-bit hash
    least_documents: int = 3  # that an n-gram of a language occurs in
    share: float = 0.2  # of its highest rate in any language, to count as this one's


def ngrams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """All n-grams of the lower-cased texts, and where each text's begin (one more at the end).

    Bytes of ASCII that are no letters count as spaces; n-grams with a space
    between other bytes are left out.
    """
    raw = [b" " + (t or "").lower().encode().translate(_BLANK) + b"   " for t in texts]
    data = np.frombuffer(b"".join(raw), np.uint8).astype(np.uint32)
    edges = np.cumsum([0] + [len(r) for r in raw])
    grams = data[:-3] | data[1:-2] << 8 | data[2:-1] << 16 | data[3:] << 24
    inner = (data[1:-2] != 32) & (data[2:-1] != 32)
    kept = np.flatnonzero(inner)
    return grams[kept], np.searchsorted(kept, edges)


def _slots(grams: np.ndarray, s: Settings) -> list[np.ndarray]:
    spread, mask = mixed(grams.astype(np.uint64) + np.uint64(1)), np.uint64((1 << s.slots_log2) - 1)
    return [((spread >> np.uint64(k * s.slots_log2)) & mask).astype(np.int64) for k in range(s.hashes)]


@dataclass(frozen=True)
class Model:
    """languages in order of their documents; masks: one bit per language in every slot."""

    languages: list[str]
    masks: np.ndarray
    false_rates: np.ndarray
    settings: Settings

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Language and score (0 to 1) of each text; ``und`` and 0 for null and letterless texts.

        A text with letters but no n-gram known to any language gets the most
        common language with score 0; ties go to the more common language.
        """
        grams, edges = ngrams(texts)
        found = np.full(len(grams), np.uint64(0xFFFFFFFFFFFFFFFF))
        for at in _slots(grams, self.settings):
            found &= self.masks[at]
        total = np.maximum(1, np.diff(edges))
        rates = np.zeros((len(texts), len(self.languages)))
        for k, false in enumerate(self.false_rates):
            hits = np.concatenate(([0], np.cumsum((found >> np.uint64(k)) & np.uint64(1))))
            share = (hits[edges[1:]] - hits[edges[:-1]]) / total
            rates[:, k] = np.clip((share - false) / (1 - false), 0, 1)
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        first = rates.argmax(1)
        lettered = [bool(t and _LETTER.search(t)) for t in texts]
        names = [self.languages[i] if ok else UNKNOWN for i, ok in zip(first, lettered, strict=True)]
        return names, np.where(lettered, rates[np.arange(len(texts)), first], 0.0)


def counted_ngrams(batches: Iterator[pa.RecordBatch], number: dict[str, int]) -> Iterator[pa.RecordBatch]:
    """gram, lang, documents and times, summed over as many rows (text, lang) as ``HELD`` allows."""
    fields = pa.schema([("gram", pa.int64()), ("lang", pa.int32()), ("documents", pa.int64()), ("times", pa.int64())])
    held: list[np.ndarray] = []

    def summed() -> np.ndarray:
        """Rows of (gram and language, documents, times), equal keys added."""
        rows = np.concatenate(held)
        keys, at = np.unique(rows[:, 0], return_inverse=True)
        return np.column_stack((keys, np.bincount(at, rows[:, 1]).astype(np.int64), np.bincount(at, rows[:, 2]).astype(np.int64)))

    def given(rows: np.ndarray) -> pa.RecordBatch:
        return batch_of(fields, (rows[:, 0] & 0xFFFFFFFF, (rows[:, 0] >> 32).astype(np.int32), rows[:, 1], rows[:, 2]))

    for batch in weighed(batches, 0, HELD):
        grams, edges = ngrams(batch.column(0).to_pylist())
        lang = np.array([number[x] for x in batch.column(1).to_pylist()], dtype=np.int64)
        owner = np.repeat(np.arange(len(lang)), np.diff(edges))
        one, times = np.unique(grams.astype(np.int64) | owner << 32, return_counts=True)
        keys = (one & 0xFFFFFFFF) | lang[one >> 32] << 32
        held.append(np.column_stack((keys, np.ones(len(keys), np.int64), times)))
        if sum(map(len, held)) > HELD:
            held = [summed()]
            if len(held[0]) > HELD // 2:
                yield given(held[0])
                held = []
    if held:
        yield given(summed())


def fit(documents: DataFrame, settings: Settings = Settings(), sample_documents: int = SAMPLE_DOCUMENTS) -> Model:
    """Filters from documents (text, lang); rows with a null text or lang are left out.

    About ``sample_documents`` rows of each language, chosen by a hash of the
    text, are counted (all where a language has fewer). Counts are summed in
    each task before they are shuffled. An n-gram enters a language's filter if
    it occurs in enough of its documents, and not much less often than in the
    language where it is most frequent. The driver holds the filters only,
    2**slots_log2 masks. At most 63 languages; more raise.
    """
    usable = documents.select(F.col("text").cast("string"), F.col("lang").cast("string")).filter("text is not null and lang is not null")
    sizes = usable.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(64).collect()
    if len(sizes) > 63:
        raise ValueError("more than 63 languages")
    languages = [r["lang"] for r in sizes]
    width = 1 << settings.slots_log2
    if not languages:
        return Model([], np.zeros(width, np.uint64), np.zeros(0), settings)
    bounds = {r["lang"]: sample_documents / r["count"] for r in sizes}
    keep = F.create_map(*[F.lit(x) for pair in bounds.items() for x in pair])
    chance = F.pmod(F.xxhash64("text"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = usable.filter(chance < F.element_at(keep, F.col("lang")))
    number = {lang: k for k, lang in enumerate(languages)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return counted_ngrams(batches, number)

    counted = sample.mapInArrow(count, "gram long, lang int, documents long, times long")
    counted = written(counted.groupBy("gram", "lang").agg(F.sum("documents").alias("documents"), F.sum("times").alias("times")), "ngrams")
    totals = {r["lang"]: r["n"] for r in counted.groupBy("lang").agg(F.sum("times").alias("n")).collect()}
    per = F.create_map(*[F.lit(x) for k, n in totals.items() for x in (k, float(n))]) if totals else F.create_map(F.lit(0), F.lit(1.0))
    rated = counted.withColumn("rate", F.col("times") / F.element_at(per, F.col("lang")))
    top = F.max("rate").over(Window.partitionBy("gram"))
    own = rated.withColumn("top", top).filter((F.col("documents") >= settings.least_documents) & (F.col("rate") >= settings.share * F.col("top")))
    masked = own.groupBy("gram").agg(F.bit_or(F.expr("shiftleft(1L, lang)")).alias("mask"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            mask = batch.column(1).to_numpy()
            at = _slots(batch.column(0).to_numpy(), settings)
            yield batch_of(pa.schema([("slot", pa.int64()), ("mask", pa.int64())]), (np.concatenate(at), np.tile(mask, len(at))))

    slots = masked.mapInArrow(place, "slot long, mask long").groupBy("slot").agg(F.bit_or("mask").alias("mask")).toArrow()
    masks = np.zeros(width, np.uint64)
    masks[slots.column("slot").to_numpy()] = slots.column("mask").to_numpy().astype(np.uint64)
    fill = [((masks >> np.uint64(k)) & np.uint64(1)).mean() for k in range(len(languages))]
    return Model(languages, masks, np.minimum(np.array(fill) ** settings.hashes, 0.99), settings)


def identified(documents: DataFrame, model: Model, added: tuple[str, str] = ("lang_pred", "lang_score")) -> DataFrame:
    """All columns of documents and the two ``added``, language and score; texts are read whole.

    Names that documents has already are refused.
    """
    names = documents.columns
    if any(free_name(documents, name) != name for name in added):
        raise ValueError(f"documents has a column among {', '.join(added)}")
    at = [n.lower() for n in names].index("text")
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in weighed(batches, at, 1_000_000):
            lang, score = shared.value.predict(batch.column(at).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lang, pa.string()), pa.array(score)], names=[*names, *added])

    schema = T.StructType([*documents.schema.fields, T.StructField(added[0], T.StringType()), T.StructField(added[1], T.DoubleType())])
    return documents.mapInArrow(run, schema)
