"""Exact medians per group, for groups of any size, by narrowing down to the middle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stallkeep.operators.joins import spread_join
from stallkeep.session import release, write_scratch

# Ranks that a sketch names are off by at most rows / ACCURACY; the bracket is twice as wide.
ACCURACY = 10_000
_REACH = 2 / ACCURACY


def grouped_median(df: DataFrame, group: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Interpolated median of each value column per group; NULLs are left out.

    Every group has a row, also the NULL group and groups without any value
    (NULL medians). A first pass keeps one mergeable quantile sketch per group and
    column, all columns at once, and so brackets the middle ranks. A second pass
    counts what lies below a bracket and how often each value inside occurs, both
    combined before they are moved; the middle is then picked among the values
    inside, at most 6 * rows / ACCURACY of a group. Should a sketch have been off
    by more than it promises, its groups are sorted out by ``_by_sorting``, so the
    result is exact in any case.
    """
    group, values = list(group), list(values)
    rows, rows_path = write_scratch(df.select(F.struct(*[F.col(g) for g in group]).alias("_group"), *[F.col(v).cast("double").alias(f"_v{i}") for i, v in enumerate(values)]), "values")
    sketches = []
    for i in range(len(values)):
        sketches += [
            F.count(f"_v{i}").alias(f"_n{i}"),
            F.percentile_approx(f"_v{i}", [0.5 - _REACH, 0.5 + _REACH], ACCURACY).alias(f"_b{i}"),
        ]
    brackets, brackets_path = write_scratch(rows.groupBy("_group").agg(*sketches), "brackets")
    inside = spread_join(rows, brackets, ["_group"], "inner")
    columns = [
        F.struct(F.lit(i).alias("c"), F.col(f"_n{i}").alias("n"), (F.col(f"_v{i}") < F.col(f"_b{i}")[0]).alias("below"), F.when(F.col(f"_v{i}") >= F.col(f"_b{i}")[0], F.col(f"_v{i}")).alias("v"))
        for i in range(len(values))
    ]
    kept = [F.when(F.col(f"_v{i}") <= F.col(f"_b{i}")[1], c) for i, c in enumerate(columns)]
    weighed = inside.select("_group", F.explode(F.array(*kept)).alias("x")).filter("x is not null").groupBy("_group", "x.c", "x.n", "x.below", "x.v").agg(F.count("*").alias("_weight"))
    picked = _picked(weighed, F.col("n"))
    medians = picked.groupBy("_group").agg(*[F.max(F.when(F.col("c") == i, F.col("median"))).alias(f"_m{i}") for i in range(len(values))])
    found, _ = write_scratch(brackets.join(medians, "_group", "left"), "medians")
    missed = found.filter(F.exists(F.array(*[(F.col(f"_n{i}") > 0) & F.col(f"_m{i}").isNull() for i in range(len(values))]), lambda x: x))
    if missed.isEmpty():
        release(df.sparkSession, rows_path, brackets_path)
    else:
        for i in range(len(values)):
            again = _by_sorting(rows.join(missed.select("_group"), "_group", "left_semi"), f"_v{i}")
            found = found.join(again, "_group", "left").withColumn(f"_m{i}", F.coalesce(f"_m{i}", "_again")).drop("_again")
    return found.select(*[F.col(f"_group.{g}").alias(g) for g in group], *[F.col(f"_m{i}").alias(v) for i, v in enumerate(values)])


def _picked(weighed: DataFrame, total: Column) -> DataFrame:
    """Median of each (group, column) of ``total`` values, NULL where a middle one is not among the rows.

    Rows are (value, how often it occurs); what lies below all of them is one row.
    """
    until = F.sum("_weight").over(Window.partitionBy("_group", "c").orderBy(F.desc("below"), "v"))
    placed = weighed.withColumn("_until", until).withColumn("_from", F.col("_until") - F.col("_weight"))
    ends = {"_lower": F.floor((total - 1) / 2), "_upper": F.floor(total / 2)}
    holds = [F.max(F.when(position.between(F.col("_from"), F.col("_until") - 1), F.col("v"))).alias(name) for name, position in ends.items()]
    return placed.groupBy("_group", "c").agg(*holds).select("_group", "c", ((F.col("_lower") + F.col("_upper")) / 2).alias("median"))


def _by_sorting(rows: DataFrame, value: str) -> DataFrame:
    """Medians of one column by a sort of all values of a group; ``_again`` per group."""
    weighed = rows.filter(F.col(value).isNotNull()).groupBy("_group", F.col(value).alias("v")).agg(F.count("*").alias("_weight"))
    weighed = weighed.withColumns({"c": F.lit(0), "below": F.lit(False), "_total": F.sum("_weight").over(Window.partitionBy("_group"))})
    return _picked(weighed, F.col("_total")).select("_group", F.col("median").alias("_again"))
