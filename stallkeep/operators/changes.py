"""What changed between two states of a keyed table, from one digest per row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallkeep.operators.joins import spread_join
from stallkeep.session import write_scratch

DIGEST = "_digest"
INSERT, UPDATE, DELETE, UNCHANGED = "insert", "update", "delete", "unchanged"


def row_digest(columns: Sequence[str]) -> Column:
    """SHA-256 of the values in order; a value counts with its length, so NULL, '' and neighbours stay apart."""
    texts = [F.col(f"`{c}`").cast("string") for c in columns]
    parts = [F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.unhex(F.sha2(F.concat(*parts).cast("binary"), 256))


def digests(df: DataFrame, key: Sequence[str], columns: Sequence[str] | None = None, beside: Sequence[str] = ()) -> DataFrame:
    """The key and a digest of the other columns of every row: what a load keeps beside its table.

    ``beside`` names columns to keep as they are, in the digest or not.
    """
    columns = [c for c in (columns or df.columns) if c not in key]
    digest = row_digest(columns) if columns else F.lit(b"")
    return df.select(*[F.col(f"`{c}`") for c in [*key, *beside]], digest.alias(DIGEST))


def changes(old: DataFrame, new: DataFrame, key: Sequence[str]) -> DataFrame:
    """The key of every row of either side and its ``Change``.

    ``old`` and ``new`` come from ``digests``. One grouping of both sides, in which
    NULLs in a key are alike. A key that a side has twice fails the job: the rows
    could not be told apart.
    """
    sides = [
        df.select(*key, *[F.when(F.lit(is_new == mine), F.col(DIGEST)).alias(name) for name, mine in (("_old", False), ("_new", True))])
        for df, is_new in ((old, False), (new, True))
    ]
    grouped = sides[0].unionByName(sides[1]).groupBy(*key).agg(
        F.max("_old").alias("_old"), F.max("_new").alias("_new"), F.count("_old").alias("_olds"), F.count("_new").alias("_news")
    )
    kind = (
        F.when((F.col("_olds") > 1) | (F.col("_news") > 1), F.raise_error(F.concat(F.lit("repeated key: "), F.concat_ws(",", *key))).cast("string"))
        .when(F.col("_olds") == 0, INSERT)
        .when(F.col("_news") == 0, DELETE)
        .when(F.col("_old") == F.col("_new"), UNCHANGED)
        .otherwise(UPDATE)
    )
    return grouped.select(*key, kind.alias("Change"))


def _key_hash(key: Sequence[str]) -> Column:
    return F.xxhash64(*[part for c in key for part in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())])


def _of_hashes(df: DataFrame, hashes: DataFrame, key: Sequence[str]) -> DataFrame:
    return spread_join(df.withColumn("_h", _key_hash(key)), hashes, ["_h"], "left_semi").drop("_h")


def changed_rows(old: DataFrame, new: DataFrame, key: Sequence[str]) -> DataFrame:
    """``changes`` without the unchanged rows, for states that are mostly alike.

    A first grouping moves three hashes of a row instead of its key and digest: a
    key that both sides have once, with the same two hashes of its digest, is
    unchanged (one that changed goes unseen with a chance of 2**-128). The rows of
    all other key hashes, which are written, are then told apart by ``changes``.
    """
    # The rows of both sides are counted in the halves of one number.
    sides = [
        df.select(_key_hash(key).alias("_h"), F.lit(row).alias("_rows"), F.xxhash64(DIGEST).alias("_one"), F.xxhash64(F.lit("other"), DIGEST).alias("_two"))
        for df, row in ((old, 1), (new, 1 << 32))
    ]
    grouped = sides[0].unionByName(sides[1]).groupBy("_h").agg(F.sum("_rows").alias("_rows"), F.bit_xor("_one").alias("_one"), F.bit_xor("_two").alias("_two"))
    alike = (F.col("_rows") == 1 + (1 << 32)) & (F.col("_one") == 0) & (F.col("_two") == 0)
    hashes, _ = write_scratch(grouped.filter(~alike).select("_h"), "changed-hashes")
    return changes(_of_hashes(old, hashes, key), _of_hashes(new, hashes, key), key).filter(F.col("Change") != UNCHANGED)


def require_unique(state: DataFrame, key: Sequence[str]) -> None:
    """Fail as ``changes`` does if a state has a key twice; only keys whose hash repeats are moved whole."""
    repeated = state.select(_key_hash(key).alias("_h")).groupBy("_h").agg(F.count("*").alias("_rows")).filter("_rows > 1")
    hashes, _ = write_scratch(repeated.select("_h"), "repeated-hashes")
    changes(state.limit(0), _of_hashes(state, hashes, key), key).filter(F.col("Change") != INSERT).isEmpty()


def change_counts(changed: DataFrame) -> DataFrame:
    """One row: how many rows were inserted, updated, deleted and left alone."""
    kinds = {"Inserted": INSERT, "Updated": UPDATE, "Deleted": DELETE, "Unchanged": UNCHANGED}
    return changed.agg(*[F.count(F.when(F.col("Change") == kind, 1)).alias(name) for name, kind in kinds.items()])
