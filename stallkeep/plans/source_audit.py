"""The audit of the raw sources as one long frame of metrics."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stallkeep.functions import matches
from stallkeep.operators import quality as Q

MONEY = "decimal(18,2)"

# Audited keys, references and important columns.
AUDITED_KEYS = (
    ("orders", ("order_id",)),
    ("customers", ("customer_id",)),
    ("sellers", ("seller_id",)),
    ("products", ("product_id",)),
    ("order_items", ("order_id", "order_item_id")),
)
AUDITED_REFERENCES = (
    ("order_items", "order_id", "orders"),
    ("order_items", "product_id", "products"),
    ("order_items", "seller_id", "sellers"),
    ("payments", "order_id", "orders"),
    ("reviews", "order_id", "orders"),
)
IMPORTANT_COLUMNS = (
    ("orders", ("order_purchase_timestamp", "customer_id")),
    ("order_items", ("order_id", "product_id", "seller_id")),
    ("products", ("product_id",)),
)


def _metric(one_row: DataFrame, section: str, names: Mapping[str, str] | None = None) -> DataFrame:
    names = names or {c: c for c in one_row.columns}
    rows = [F.struct(F.lit(label).alias("metric"), F.col(c).cast("string").alias("value")) for c, label in names.items()]
    return one_row.select(F.lit(section).alias("section"), F.inline(F.array(*rows)))


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    return Q.table_counts(tables)


def status_distribution(orders: DataFrame) -> DataFrame:
    return Q.distribution(orders, ["order_status"], "Orders")


def delivered_volume(orders: DataFrame, items: DataFrame, status: str = "delivered") -> DataFrame:
    """Delivered orders and the items that belong to them.

    Items are counted per order before the semi join.
    """
    delivered = orders.filter(F.col("order_status") == status).select("order_id")
    belonging = Q.group_sizes(items, ["order_id"]).join(delivered, "order_id", "left_semi")
    return Q.union_all(
        [
            delivered.agg(F.count("*").alias("Value")).select(F.lit("delivered_orders").alias("Metric"), "Value"),
            belonging.agg(F.coalesce(F.sum("Rows"), F.lit(0)).alias("Value")).select(
                F.lit("delivered_items").alias("Metric"), "Value"
            ),
        ]
    )


def purchase_range(orders: DataFrame) -> DataFrame:
    """First and last purchase; unreadable times count as missing."""
    moment = F.col("order_purchase_timestamp").try_cast("timestamp_ntz")
    return orders.agg(F.min(moment).alias("first_purchase"), F.max(moment).alias("last_purchase"))


def surplus_keys(tables: Mapping[str, DataFrame]) -> DataFrame:
    return Q.union_all(
        [
            Q.surplus_rows(tables[t], list(key)).select(F.lit(f"{t}({','.join(key)})").alias("KeySet"), "SurplusRows")
            for t, key in AUDITED_KEYS
        ]
    )


def orphan_references(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Orphans per reference; a missing child value is not an orphan here."""
    return Q.union_all(
        [
            Q.orphan_count(tables[child], tables[parent], column, column, ignore_nulls=True).select(
                F.lit(f"{child}.{column} -> {parent}").alias("Reference"), "OrphanRows"
            )
            for child, column, parent in AUDITED_REFERENCES
        ]
    )


def missing_category(products: DataFrame) -> DataFrame:
    return Q.count_where(products, F.col("product_category_name").isNull(), "ProductsWithoutCategory")


def untranslated_labels(products: DataFrame, translation: DataFrame) -> DataFrame:
    """Labels in use that the translation lacks, sorted."""
    label = "product_category_name"
    used = products.select(label).filter(F.col(label).isNotNull())
    return used.subtract(translation.select(label)).orderBy(label)


def order_multiplicity(payments: DataFrame, reviews: DataFrame) -> DataFrame:
    return Q.union_all(
        [
            Q.multiplicity(df, ["order_id"]).select(F.lit(name).alias("Dataset"), "RepeatedGroups", "MaxRowsPerGroup")
            for name, df in (("payments", payments), ("reviews", reviews))
        ]
    )


def important_nulls(tables: Mapping[str, DataFrame]) -> DataFrame:
    return Q.union_all(
        [
            _metric(
                tables[t].agg(*[matches(F.col(c).isNull()).alias(c) for c in columns]),
                "important_nulls",
                {c: f"{t}.{c}" for c in columns},
            ).select(F.col("metric").alias("ColumnName"), F.col("value").cast("long").alias("NullRows"))
            for t, columns in IMPORTANT_COLUMNS
        ]
    )


def payment_item_diagnostic(items: DataFrame, payments: DataFrame) -> DataFrame:
    """Orders whose item prices and payments differ, an absent side counting as zero."""
    priced = items.groupBy("order_id").agg(F.sum("price").alias("item_total"))
    paid = payments.groupBy("order_id").agg(F.sum("payment_value").alias("payment_total"))
    both = priced.join(paid, "order_id", "full_outer")

    def rounded(c: str):
        return F.coalesce(F.col(c), F.lit(0)).cast("decimal(28,2)")

    return both.agg(
        F.count("*").alias("ComparedOrders"),
        matches(rounded("item_total") != rounded("payment_total")).alias("MismatchOrders"),
    )


def audit_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Every audit number as (section, metric, value)."""
    def section(df: DataFrame, name: str, metric: str, value: str) -> DataFrame:
        return df.select(F.lit(name).alias("section"), F.col(metric).alias("metric"), F.col(value).cast("string").alias("value"))

    orders, items = tables["orders"], tables["order_items"]
    products, translation = tables["products"], tables["category_translation"]
    coverage = Q.coverage_percent(products, translation, "product_category_name")
    return Q.union_all(
        [
            section(row_counts(tables), "rows", "DatasetName", "ActualRows"),
            section(status_distribution(orders), "order_status", "order_status", "Orders"),
            section(delivered_volume(orders, items), "delivered", "Metric", "Value"),
            _metric(purchase_range(orders), "purchase_range"),
            section(surplus_keys(tables), "surplus_keys", "KeySet", "SurplusRows"),
            section(orphan_references(tables), "orphans", "Reference", "OrphanRows"),
            _metric(missing_category(products), "categories"),
            _metric(coverage, "categories"),
            section(
                untranslated_labels(products, translation).withColumn("one", F.lit(1)), "untranslated", "product_category_name", "one"
            ),
            section(order_multiplicity(tables["payments"], tables["reviews"]), "repeated_orders", "Dataset", "RepeatedGroups"),
            section(order_multiplicity(tables["payments"], tables["reviews"]), "most_rows_per_order", "Dataset", "MaxRowsPerGroup"),
            section(important_nulls(tables), "important_nulls", "ColumnName", "NullRows"),
            _metric(payment_item_diagnostic(items, tables["payments"]), "payment_against_items"),
        ]
    )
