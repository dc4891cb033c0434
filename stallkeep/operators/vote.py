"""Choose one value per key by votes, with explicit ties."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stallkeep.functions import flag


def rank_candidates(candidates: DataFrame, key: Sequence[str], votes: str, support: str) -> DataFrame:
    """Both dense ranks of each candidate: by (votes, support) and by votes alone.

    For audits. Candidates are already aggregated, so a key has one row per
    distinct value; ``resolve_by_vote`` does not need the ranks.
    """
    per_key = Window.partitionBy(*key)
    return candidates.withColumns(
        {
            "ResolutionRank": F.dense_rank().over(per_key.orderBy(F.desc(votes), F.desc(support))),
            "VoteOnlyRank": F.dense_rank().over(per_key.orderBy(F.desc(votes))),
        }
    )


def resolve_by_vote(
    candidates: DataFrame, key: Sequence[str], value: str, votes: str, support: str
) -> DataFrame:
    """One row per key: the single best candidate, or NULL and a tie flag.

    ``candidates`` holds one row per (key, value). The best candidate has the
    most votes, then the most support. Three aggregations narrow the
    candidates down, each combining before its shuffle, so no key's candidates
    ever meet in one window.

    Output: key, Winner, CandidateCount, ConflictFlag (several candidates),
    AmbiguousFlag (still tied), ResolvedBySupportFlag (votes tied, support decided).
    """
    same_score = candidates.groupBy(*key, votes, support).agg(
        F.count("*").alias("_tied"), F.max(value).alias("_value")
    )
    same_votes = same_score.groupBy(*key, votes).agg(
        F.sum("_tied").alias("_tied_on_votes"),
        F.max(F.struct(F.col(support).alias("support"), F.col("_tied").alias("tied"), F.col("_value").alias("value"))).alias("_best"),
    )
    per_key = same_votes.groupBy(*key).agg(
        F.sum("_tied_on_votes").alias("CandidateCount"),
        F.max(F.struct(F.col(votes).alias("votes"), F.col("_tied_on_votes").alias("tied_on_votes"), F.col("_best").alias("best"))).alias("_top"),
    )
    best = F.col("_top.best")
    unique = best.tied == 1
    return per_key.select(
        *key,
        F.when(unique, best.value).alias("Winner"),
        "CandidateCount",
        flag(F.col("CandidateCount") > 1).alias("ConflictFlag"),
        flag(~unique).alias("AmbiguousFlag"),
        flag((F.col("_top.tied_on_votes") > 1) & unique & (best.support > 0)).alias("ResolvedBySupportFlag"),
    )


def most_frequent_label(
    labels: DataFrame, key: Sequence[str], label: str, weight: str
) -> DataFrame:
    """The label with the largest weight per key; equal weights go to the first label in order."""
    heaviest = labels.groupBy(*key, weight).agg(F.min(label).alias(label))
    return heaviest.groupBy(*key).agg(F.max_by(label, weight).alias(label))
