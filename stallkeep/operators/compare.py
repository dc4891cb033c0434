"""Compare the rows a load should have written with the rows it wrote."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallkeep.session import scratch_path

EXPECTED, ACTUAL = "_expected_rows", "_actual_rows"
BUCKETS = 4096
_BUCKET = "_bucket"


def compare_rows(
    expected: DataFrame, actual: DataFrame, columns: Sequence[str] | None = None, keep: Sequence[str] | None = None
) -> DataFrame:
    """Distinct rows of both sides with how often each side has them.

    One tagged union and one grouping over all columns replace two anti
    joins. Grouping treats NULLs as equal, as EXCEPT does. With ``keep``, only
    the columns it names are moved and returned; the others tell rows apart by two
    64-bit hashes of all columns, which differ but for a chance of 2**-128.
    """
    columns = list(columns or expected.columns)
    if keep is not None:
        sides = [_hashed(df, columns) for df in _alike(expected, actual, columns)]
        columns = [*dict.fromkeys(keep), "_one", "_two"]
        expected, actual = sides
    left = expected.select(*columns, F.lit(1).alias(EXPECTED), F.lit(0).alias(ACTUAL))
    right = actual.select(*columns, F.lit(0).alias(EXPECTED), F.lit(1).alias(ACTUAL))
    return left.union(right).groupBy(*columns).agg(
        F.sum(EXPECTED).alias(EXPECTED), F.sum(ACTUAL).alias(ACTUAL)
    )


def _tally(side: str, value: Column) -> Column:
    return F.coalesce(F.sum(F.col(side) * value), F.lit(0))


def difference_measures() -> dict[str, Column]:
    """Rows and set differences in both directions, over the result of ``compare_rows``."""
    one_sided = {
        "SourceToTargetDifferences": F.count(F.when(F.col(ACTUAL) == 0, 1)),
        "TargetToSourceDifferences": F.count(F.when(F.col(EXPECTED) == 0, 1)),
    }
    return {"ExpectedRows": _tally(EXPECTED, F.lit(1)), "ActualRows": _tally(ACTUAL, F.lit(1)), **one_sided}


def profile_measures(measures: Mapping[str, Column]) -> dict[str, Column]:
    """``Expected…`` and ``Actual…`` totals of each row-level number."""
    both: dict[str, Column] = {}
    for name, value in measures.items():
        both[f"Expected{name}"] = _tally(EXPECTED, value)
        both[f"Actual{name}"] = _tally(ACTUAL, value)
    return both


def summarize(compared: DataFrame, measures: Mapping[str, Column], key: str, label: str) -> DataFrame:
    """One row: the measures, plus the distinct keys of each side.

    The measures (all sums or counts) are totalled per key first, so distinct
    keys come out of the same aggregation instead of multiplying the rows.
    """
    sides = {f"ExpectedDistinct{label}": EXPECTED, f"ActualDistinct{label}": ACTUAL}
    per_key = compared.groupBy(key).agg(
        *[m.alias(n) for n, m in measures.items()],
        *[F.max(F.when((F.col(side) > 0) & F.col(key).isNotNull(), 1)).alias(n) for n, side in sides.items()],
    )
    return per_key.agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in (*measures, *sides)])


def differences(expected: DataFrame, actual: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row: both row counts and both set differences."""
    measures = difference_measures()
    return compare_rows(expected, actual, columns, keep=()).agg(*[m.alias(n) for n, m in measures.items()])


def differing_rows(expected: DataFrame, actual: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """The rows only one side has, and which side."""
    compared = compare_rows(expected, actual, columns)
    side = F.when(F.col(ACTUAL) == 0, "source only").when(F.col(EXPECTED) == 0, "target only")
    return compared.withColumn("Side", side).filter(F.col("Side").isNotNull()).drop(EXPECTED, ACTUAL)


def _hashed(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The columns, a bucket that like rows share, and two 64-bit hashes; NULL counts as a value of its own."""
    cells = [part for c in columns for part in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())]
    one, two = F.xxhash64(*cells), F.xxhash64(F.lit("other"), *cells)
    return df.select(*[F.col(f"`{c}`") for c in columns], F.pmod(two, F.lit(BUCKETS)).alias(_BUCKET), one.alias("_one"), two.alias("_two"))


def _alike(expected: DataFrame, actual: DataFrame, columns: Sequence[str]) -> list[DataFrame]:
    """The columns of both sides in the types a union gives them, so that equal values hash alike."""
    names = [F.col(f"`{c}`") for c in columns]
    common = expected.select(*names).union(actual.select(*names)).schema
    return [df.select(*[n.cast(f.dataType).alias(f.name) for n, f in zip(names, common.fields, strict=True)]) for df in (expected, actual)]


def _digests(hashed: DataFrame, rows: str, sign: int) -> DataFrame:
    """How many rows a bucket has, and the sums of its hashes by halves, which no order changes."""
    halves = [half for h in ("_one", "_two") for half in (F.shiftrightunsigned(h, 32), F.col(h).bitwiseAND(0xFFFFFFFF))]
    sums = [F.sum(half * sign).alias(f"_s{i}") for i, half in enumerate(halves)]
    return hashed.groupBy(_BUCKET).agg(F.count("*").alias(rows), *sums)


def bucket_digests(expected: DataFrame, actual: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per bucket of rows: the row counts of both sides and whether they may differ.

    Each side is reduced to at most BUCKETS rows before anything is moved. Sides
    whose rows are the same, as often, have the same digests; others differ in
    one of 128 bits but for a chance of 2**-64 and less.
    """
    sides = [_digests(_hashed(df, columns), rows, sign) for df, rows, sign in ((expected, EXPECTED, 1), (actual, ACTUAL, -1))]
    both = sides[0].unionByName(sides[1], allowMissingColumns=True).groupBy(_BUCKET).agg(
        *[F.coalesce(F.sum(side), F.lit(0)).alias(side) for side in (EXPECTED, ACTUAL)], *[F.sum(f"_s{i}").alias(f"_s{i}") for i in range(4)]
    )
    unequal = reduce(or_, [F.col(f"_s{i}") != 0 for i in range(4)], F.col(EXPECTED) != F.col(ACTUAL))
    return both.select(_BUCKET, EXPECTED, ACTUAL, unequal.alias("_unequal"))


def differences_of_stored(expected: DataFrame, actual: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``differences`` of two stored tables, which may be large and are mostly alike.

    Each side is scanned once for its digests, which are written. With no unequal
    bucket that is all; otherwise a second scan moves only the rows of unequal
    buckets. Sides that are derived by joins are better compared by
    ``differences``, which derives them once.
    """
    columns = list(columns or expected.columns)
    expected, actual = _alike(expected, actual, columns)
    path = scratch_path(expected.sparkSession, "bucket-digests")
    bucket_digests(expected, actual, columns).write.parquet(path)
    digests = expected.sparkSession.read.parquet(path)
    measures = difference_measures()
    counts = digests.agg(*[F.coalesce(F.sum(side), F.lit(0)).alias(name) for name, side in (("ExpectedRows", EXPECTED), ("ActualRows", ACTUAL))])
    unequal = digests.filter("_unequal").select(_BUCKET)
    if unequal.isEmpty():
        return counts.withColumns({n: F.lit(0).cast("long") for n in measures if n not in counts.columns})
    both = [_hashed(df, columns).join(F.broadcast(unequal), _BUCKET, "left_semi").select(*[F.col(f"`{c}`") for c in columns]) for df in (expected, actual)]
    sets = compare_rows(*both, columns).agg(*[measures[n].alias(n) for n in measures if n not in counts.columns])
    return counts.unionByName(sets, allowMissingColumns=True).agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in measures])
