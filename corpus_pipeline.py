"""The corpus pipeline: each stage's result is written and read again as the next one's documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stallkeep.llm import langid, neardup, packing, quality
from stallkeep.llm.common import free_name, table, written
from stallkeep.llm.queries import BYTE_BPE, QUALITY_CUT, language_model, quality_model

# A text of at least this many characters is refused if less than this share of
# its n-grams belongs to its best language; shorter texts say too little.
LANGUAGE_CHARS = 40
LANGUAGE_CUT = 0.2


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches the cut."""
    score = free_name(docs, "quality_score")
    scored = quality.scored(docs, quality_model(spark, sf_dir), score)
    return scored.filter(F.col(score) >= QUALITY_CUT).select(*_columns(docs))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language: with letters, and not foreign to every language learnt."""
    lang, score = free_name(docs, "lang_pred"), free_name(docs, "lang_score")
    found = langid.identified(docs, language_model(spark, sf_dir), (lang, score))
    foreign = (F.length("text") >= LANGUAGE_CHARS) & (F.col(score) < LANGUAGE_CUT)
    return found.filter((F.col(lang) != langid.UNKNOWN) & ~foreign).select(*_columns(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of every group of near-duplicates."""
    return neardup.first_of_each(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every kept document cut into pieces and placed in sequences."""
    return packing.pack_documents(docs, BYTE_BPE, keep_ids=False).drop("ids")


def _columns(docs: DataFrame) -> list[str]:
    return [f"`{c}`" for c in docs.columns]


STAGES = [
    ("quality classifier", quality_classifier),
    ("language ID", language_id),
    ("MinHash near-dedup", near_dedup),
    ("packing", pack),
]

ORACLE_SQL = None  # models, alignment and tokens are beyond SQL; tests hold the stages against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
