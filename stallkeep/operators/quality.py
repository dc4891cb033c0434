"""Data-quality checks. Each takes frames and column names and returns a frame.

Checks of one table are written so that they can share a pass: the one-row
audits are plain aggregate lists that ``audit`` evaluates together. Checks
across tables shrink the child side to one row per key before any join, so a
key that owns a large share of the rows is a single row by then.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallkeep.functions import is_blank, matches, text_length
from stallkeep.operators.joins import spread_join
from stallkeep.session import release, write_scratch

MONEY = "decimal(18,2)"


def audit(df: DataFrame, measures: Mapping[str, Column]) -> DataFrame:
    """One row with every measure, in one pass."""
    return df.agg(*[column.alias(name) for name, column in measures.items()])


# --- one-row audits over columns -------------------------------------------


def row_count(df: DataFrame, name: str = "RowCount") -> DataFrame:
    return audit(df, {name: F.count("*")})


def count_where(df: DataFrame, condition: Column, name: str) -> DataFrame:
    return audit(df, {name: matches(condition)})


def null_audit(df: DataFrame, columns: Sequence[str], suffix: str = "_nulls") -> DataFrame:
    return audit(df, {c + suffix: matches(F.col(c).isNull()) for c in columns})


def blank_audit(df: DataFrame, columns: Sequence[str], suffix: str = "_blanks") -> DataFrame:
    return audit(df, {c + suffix: matches(is_blank(c)) for c in columns})


def negative_audit(df: DataFrame, columns: Sequence[str], suffix: str = "_negative") -> DataFrame:
    return audit(df, {c + suffix: matches(F.col(c) < 0) for c in columns})


def zero_audit(df: DataFrame, columns: Sequence[str], suffix: str = "_zero") -> DataFrame:
    return audit(df, {c + suffix: matches(F.col(c) == 0) for c in columns})


def value_range(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    measures = {}
    for c in columns:
        measures[f"min_{c}"] = F.min(c)
        measures[f"max_{c}"] = F.max(c)
    return audit(df, measures)


def out_of_bounds(df: DataFrame, bounds: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Rows outside [low, high] per column; NULL is not outside."""
    return audit(df, {f"{c}_invalid": matches(~F.col(c).between(*b)) for c, b in bounds.items()})


def outside_domain(df: DataFrame, column: str, allowed: Sequence, name: str = "InvalidRows") -> DataFrame:
    """Rows whose value is none of ``allowed``; NULL does not count as outside."""
    return count_where(df, ~F.col(column).isin(list(allowed)), name)


def longest_text(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return audit(df, {f"max_{c}_length": F.max(text_length(c)) for c in columns})


def length_violations(df: DataFrame, column: str, length: int, name: str = "InvalidLengthRows") -> DataFrame:
    return count_where(df, text_length(column) != length, name)


def non_numeric(df: DataFrame, column: str, name: str = "NonNumericRows") -> DataFrame:
    return count_where(df, F.col(column).rlike("[^0-9]"), name)


def distinct_values(df: DataFrame, columns: Sequence[str], prefix: str = "distinct_") -> DataFrame:
    return audit(df, {prefix + c: F.count_distinct(c) for c in columns})


def text_coverage(df: DataFrame, title: str, message: str) -> DataFrame:
    def filled(c: str) -> Column:
        return F.col(c).isNotNull() & ~is_blank(c)

    return audit(
        df,
        {
            "ReviewsWithTitle": matches(filled(title)),
            "ReviewsWithMessage": matches(filled(message)),
            "ReviewsWithoutTitleOrMessage": matches(F.col(title).isNull() & F.col(message).isNull()),
        },
    )


def decimal_average(column: Column | str, scale: int = 2) -> Column:
    """Average of exact decimals, divided last and rounded half up."""
    column = F.col(column) if isinstance(column, str) else column
    return (F.sum(column.cast(MONEY)) / F.count(column)).cast(f"decimal(18,{scale})")


def score_summary(df: DataFrame, score: str) -> DataFrame:
    return audit(
        df,
        {
            "ReviewRows": F.count("*"),
            "AverageReviewScore": decimal_average(score),
            "MinReviewScore": F.min(score),
            "MaxReviewScore": F.max(score),
        },
    )


# --- groups -----------------------------------------------------------------


def group_sizes(df: DataFrame, key: Sequence[str], name: str = "Rows") -> DataFrame:
    return df.groupBy(*key).agg(F.count("*").alias(name))


def duplicate_groups(df: DataFrame, key: Sequence[str], name: str = "DuplicateCount") -> DataFrame:
    """Keys that occur more than once."""
    return group_sizes(df, key, name).filter(F.col(name) > 1)


def surplus_rows(df: DataFrame, key: Sequence[str], name: str = "SurplusRows") -> DataFrame:
    """Rows beyond the first of each key, summed."""
    return group_sizes(df, key).agg(F.coalesce(F.sum(F.col("Rows") - 1), F.lit(0)).alias(name))


def exact_duplicates(df: DataFrame) -> DataFrame:
    """Surplus and distinct rows over all columns, from one grouping."""
    return group_sizes(df, df.columns).agg(
        F.coalesce(F.sum(F.col("Rows") - 1), F.lit(0)).alias("ExactDuplicateRows"),
        F.count("*").alias("DistinctSourceRows"),
    )


def distribution(
    df: DataFrame, columns: Sequence[str], name: str = "Rows", null_label: str = "[NULL]", **extra: Column
) -> DataFrame:
    """Rows per combination of values, NULL shown as a label, most frequent first."""
    labelled = [F.coalesce(F.col(c).cast("string"), F.lit(null_label)).alias(c) for c in columns]
    counted = df.groupBy(*columns).agg(
        F.count("*").alias(name), *[measure.alias(alias) for alias, measure in extra.items()]
    )
    return counted.select(*labelled, name, *extra).orderBy(F.desc(name), *columns)


def length_distribution(df: DataFrame, column: str, name: str = "Rows") -> DataFrame:
    return df.groupBy(text_length(column).alias("TextLength")).agg(F.count("*").alias(name)).orderBy("TextLength")


def multiplicity(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """How many keys repeat and the largest group."""
    return group_sizes(df, key).agg(
        matches(F.col("Rows") > 1).alias("RepeatedGroups"),
        F.coalesce(F.max("Rows"), F.lit(0)).alias("MaxRowsPerGroup"),
    )


def size_histogram(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Number of keys per group size."""
    return group_sizes(df, key, "RowsPerGroup").groupBy("RowsPerGroup").agg(F.count("*").alias("Groups")).orderBy("RowsPerGroup")


def values_per_key(df: DataFrame, key: Sequence[str], column: str) -> DataFrame:
    """Keys mapped to several values of ``column``, worst first."""
    per_value = df.groupBy(*key, column).agg(F.count("*").alias("_rows"))
    return (
        per_value.groupBy(*key)
        .agg(
            F.sum("_rows").alias("SourceRows"),
            F.count(column).alias("DistinctValues"),
            F.min(column).alias("MinValue"),
            F.max(column).alias("MaxValue"),
        )
        .filter(F.col("DistinctValues") > 1)
        .orderBy(F.desc("DistinctValues"), F.desc("SourceRows"), *key)
    )


def top_groups(
    df: DataFrame, key: Sequence[str], measures: Mapping[str, Column], by: str, limit: int, minimum: Column | None = None
) -> DataFrame:
    """The first ``limit`` groups by a measure; ties in key order."""
    grouped = df.groupBy(*key).agg(*[column.alias(name) for name, column in measures.items()])
    if minimum is not None:
        grouped = grouped.filter(minimum)
    return grouped.orderBy(F.desc(by), *key).limit(limit)


def group_size_summary(parent: DataFrame, child: DataFrame, parent_key: str, child_key: str) -> DataFrame:
    """Smallest, largest and mean number of child rows per parent, zero included."""
    sizes = children_per_parent(parent.select(parent_key), child, parent_key, child_key)
    return sizes.agg(
        F.min("ChildRows").alias("MinRows"),
        F.max("ChildRows").alias("MaxRows"),
        decimal_average("ChildRows").alias("AvgRows"),
    )


def children_per_parent(parent: DataFrame, child: DataFrame, parent_key: str, child_key: str) -> DataFrame:
    """Every parent row with its number of child rows."""
    counts = child.groupBy(F.col(child_key).alias(parent_key)).agg(F.count("*").alias("ChildRows"))
    return parent.join(counts, parent_key, "left").withColumn(
        "ChildRows", F.coalesce(F.col("ChildRows"), F.lit(0))
    )


# --- references between tables ----------------------------------------------


def orphan_values(
    child: DataFrame, parent: DataFrame, child_key: str, parent_key: str, ignore_nulls: bool = False
) -> DataFrame:
    """Child values without a parent and the rows that carry them.

    A NULL child value counts as an orphan unless ``ignore_nulls``.
    """
    counted = group_sizes(child, [child_key])
    if ignore_nulls:
        counted = counted.filter(F.col(child_key).isNotNull())
    known = parent.select(F.col(parent_key).alias(child_key)).distinct()
    return counted.join(known, child_key, "left_anti")


def orphan_count(
    child: DataFrame,
    parent: DataFrame,
    child_key: str,
    parent_key: str,
    ignore_nulls: bool = False,
    name: str = "OrphanRows",
) -> DataFrame:
    orphans = orphan_values(child, parent, child_key, parent_key, ignore_nulls)
    return orphans.agg(F.coalesce(F.sum("Rows"), F.lit(0)).alias(name))


def unreferenced(parent: DataFrame, child: DataFrame, parent_key: str, child_key: str) -> DataFrame:
    """Parent rows no child points to."""
    used = child.select(F.col(child_key).alias(parent_key)).distinct()
    return parent.join(used, parent_key, "left_anti")


def coverage_percent(source: DataFrame, mapping: DataFrame, key: str, name: str = "CoveragePercent") -> DataFrame:
    """Share of distinct source values the mapping knows, in percent; NULL without source values."""
    values = source.select(key).filter(F.col(key).isNotNull()).distinct()
    known = mapping.select(key).distinct().withColumn("_known", F.lit(1))
    return values.join(known, key, "left").agg(
        (F.count("_known") * F.lit(100) / F.nullif(F.count("*"), F.lit(0))).cast("decimal(6,2)").alias(name)
    )


def unmatched_impact(source: DataFrame, mapping: DataFrame, key: str) -> DataFrame:
    """Source values the mapping lacks and the rows they affect."""
    return orphan_values(source, mapping, key, key, ignore_nulls=True).orderBy(key)


def unused_mappings(source: DataFrame, mapping: DataFrame, key: str) -> DataFrame:
    """Mapping rows no source row needs."""
    return unreferenced(mapping, source, key, key).orderBy(key)


def violations_across(
    child: DataFrame, parent: DataFrame, on: Sequence[str], conditions: Mapping[str, Column]
) -> DataFrame:
    """Child rows that violate each named order against their parent, from one inner join."""
    joined = spread_join(child, parent, on, "inner")
    return joined.agg(*[matches(condition).alias(name) for name, condition in conditions.items()])


def counts_by_parent_attribute(
    child: DataFrame, parent: DataFrame, key: str, attribute: str, name: str = "ChildRows"
) -> DataFrame:
    """Child rows per attribute of their parent."""
    counted = group_sizes(child, [key], "_rows")
    return (
        counted.join(parent.select(key, attribute), key)
        .groupBy(attribute)
        .agg(F.sum("_rows").alias(name))
        .orderBy(F.desc(name), attribute)
    )


def childless_parents(
    parent: DataFrame, child: DataFrame, other_child: DataFrame, key: str, name: str = "OtherRows"
) -> DataFrame:
    """Parents without a row in ``child``, with their number of rows in another child table."""
    lonely = unreferenced(parent, child, key, key)
    return children_per_parent(lonely, other_child, key, key).withColumnRenamed("ChildRows", name)


# --- sequences --------------------------------------------------------------


def sequence_profile(df: DataFrame, key: Sequence[str], sequence: str) -> DataFrame:
    """Rows, smallest and largest number per key and whether the run is broken."""
    return (
        df.groupBy(*key)
        .agg(
            F.count("*").alias("SequenceRows"),
            F.min(sequence).alias("MinSequence"),
            F.max(sequence).alias("MaxSequence"),
        )
        .withColumn(
            "SequenceAnomaly",
            F.when((F.col("MinSequence") != 1) | (F.col("MaxSequence") != F.col("SequenceRows")), 1).otherwise(0),
        )
    )


def sequence_anomalies(df: DataFrame, key: Sequence[str], sequence: str) -> DataFrame:
    """Histogram of the broken runs."""
    shape = ["SequenceRows", "MinSequence", "MaxSequence"]
    broken = sequence_profile(df, key, sequence).filter("SequenceAnomaly = 1")
    return broken.groupBy(*shape).agg(F.count("*").alias("Groups")).orderBy(*shape)


# --- reconciliation of two child tables -------------------------------------


def payment_totals(payments: DataFrame) -> DataFrame:
    return payments.groupBy("order_id").agg(
        F.count("*").alias("PaymentRows"),
        F.max("payment_type").alias("PaymentType"),
        F.max("payment_installments").alias("Installments"),
        F.sum("payment_value").alias("PaymentTotal"),
    )


def item_totals(items: DataFrame) -> DataFrame:
    return items.groupBy("order_id").agg(
        F.count("*").alias("ItemRows"),
        F.sum("price").alias("ItemPriceTotal"),
        F.sum("freight_value").alias("FreightTotal"),
        F.sum(F.col("price") + F.col("freight_value")).alias("ItemAndFreightTotal"),
    )


def payment_mismatches(payments: DataFrame, items: DataFrame, tolerance: str = "0.01") -> DataFrame:
    """Orders whose payments differ from item plus freight by more than the tolerance.

    Both sides are one row per order before they meet, so neither multiplies the other.
    """
    difference = F.col("PaymentTotal") - F.col("ItemAndFreightTotal")
    return (
        payment_totals(payments)
        .join(item_totals(items), "order_id")
        .withColumn("Difference", difference)
        .withColumn("AbsDifference", F.abs("Difference"))
        .filter(F.col("AbsDifference") > F.lit(tolerance).cast(MONEY))
    )


def mismatch_summary(mismatches: DataFrame, bands: Sequence[int] = (1, 10, 100)) -> DataFrame:
    gap = F.col("AbsDifference")
    measures = {
        "MismatchOrders": F.count("*"),
        "MinDifference": F.min(gap).cast(MONEY),
        "MaxDifference": F.max(gap).cast(MONEY),
        "AvgDifference": decimal_average("AbsDifference"),
        f"DifferenceLessOrEqual{bands[0]}": matches(gap <= bands[0]),
    }
    for band in bands:
        measures[f"DifferenceGreaterThan{band}"] = matches(gap > band)
    return audit(mismatches, measures)


def _signs() -> list[Column]:
    return [
        matches(F.col("Difference") > 0).alias("PaymentHigherCount"),
        matches(F.col("Difference") < 0).alias("PaymentLowerCount"),
    ]


def mismatch_by_status(mismatches: DataFrame, orders: DataFrame) -> DataFrame:
    return (
        mismatches.join(orders.select("order_id", "order_status"), "order_id")
        .groupBy("order_status")
        .agg(F.count("*").alias("OrderCount"), *_signs())
        .orderBy(F.desc("OrderCount"), "order_status")
    )


def mismatch_by_installments(mismatches: DataFrame, payment_type: str = "credit_card") -> DataFrame:
    """Orders paid with a single row of one payment type, by number of installments."""
    single = mismatches.filter((F.col("PaymentRows") == 1) & (F.col("PaymentType") == payment_type))
    return (
        single.groupBy("Installments")
        .agg(
            F.count("*").alias("OrderCount"),
            *_signs(),
            decimal_average("Difference").alias("AvgDifference"),
            F.max("Difference").cast(MONEY).alias("MaxDifference"),
            F.min("Difference").cast(MONEY).alias("MinDifference"),
        )
        .orderBy("Installments")
    )


def mismatch_detail(mismatches: DataFrame, orders: DataFrame, limit: int = 100) -> DataFrame:
    """The widest gaps, ties in key order."""
    detailed = mismatches.join(orders.select("order_id", "order_status"), "order_id")
    return detailed.orderBy(F.desc("AbsDifference"), "order_id").limit(limit).select(
        "order_id",
        "order_status",
        "PaymentRows",
        "ItemRows",
        *[
            F.col(source).cast(MONEY).alias(name)
            for source, name in (
                ("ItemPriceTotal", "ItemPriceTotal"),
                ("FreightTotal", "FreightTotal"),
                ("ItemAndFreightTotal", "ExpectedItemAndFreight"),
                ("PaymentTotal", "PaymentTotal"),
                ("Difference", "Difference"),
            )
        ],
    )


# --- completeness and reports -----------------------------------------------


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def one_by_one(frames: Iterable[DataFrame]) -> DataFrame:
    """``union_all`` of a few small results, each computed and written before the next is begun.

    In one query the shuffles of all of them would be on disk together.
    """
    done = []
    for frame in frames:
        done.append(write_scratch(frame, "result")[0])
        release(frame.sparkSession)
    return union_all(done)


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    return union_all(
        [df.agg(F.count("*").alias("ActualRows")).select(F.lit(n).alias("DatasetName"), "ActualRows") for n, df in tables.items()]
    )


def completeness(tables: Mapping[str, DataFrame], expected: DataFrame) -> DataFrame:
    """Actual against expected row counts, PASS or FAIL per data set.

    ``expected`` has DatasetName and ExpectedRows; a data set missing on either side fails.
    """
    return (
        table_counts(tables)
        .join(expected.select("DatasetName", "ExpectedRows"), "DatasetName", "full_outer")
        .withColumn(
            "ValidationStatus",
            F.when(F.col("ActualRows") == F.col("ExpectedRows"), "PASS").otherwise("FAIL"),
        )
        .orderBy("DatasetName")
    )


def overall_status(statuses: DataFrame, subject: str = "STAGING") -> DataFrame:
    failed = matches(F.col("ValidationStatus") != "PASS")
    return statuses.agg(
        F.when(failed == 0, f"{subject} VALIDATION PASSED").otherwise(f"{subject} VALIDATION FAILED").alias("Status")
    )


def known_issues(parent: DataFrame, child: DataFrame, key: str, condition: Column, parts: Sequence[tuple[str, str]]) -> DataFrame:
    """One line of text per offending parent: labelled values and its number of child rows."""
    offending = children_per_parent(parent.filter(condition), child, key, key)
    pieces: list[Column] = [F.lit("[KNOWN ISSUE] "), F.lit(f"{key}="), F.col(key).cast("string")]
    for label, column in parts:
        pieces += [F.lit(f" | {label}="), F.coalesce(F.col(column).cast("string"), F.lit("[NULL]"))]
    pieces += [F.lit(" | ChildRows="), F.col("ChildRows").cast("string")]
    return offending.orderBy(key).select(F.concat(*pieces).alias("DQ_Result"))
