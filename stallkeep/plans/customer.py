"""One row per customer identity, represented by its latest purchase."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stallkeep.functions import flag, matches
from stallkeep.operators.joins import spread_join
from stallkeep.operators.quality import audit
from stallkeep.session import scratch_root

IDENTITY = "customer_unique_id"
ADDRESS = ("customer_zip_code_prefix", "customer_city", "customer_state")


def customer_orders(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Each order with the identity and address of its customer."""
    bought = orders.select("customer_id", "order_id", "order_purchase_timestamp")
    return spread_join(bought, customers, ["customer_id"], "inner")


def customer_activity(purchases: DataFrame) -> DataFrame:
    """One row per customer: address, first and last purchase, orders, orders at the last time.

    Purchases are counted per (customer, time) first. Order ids are unique, so
    counting rows counts orders. Everything below starts from these rows, far
    fewer than the orders, and a customer with very many orders is one of them.
    """
    moment = "order_purchase_timestamp"
    owner = [IDENTITY, "customer_id", *ADDRESS]
    per_time = purchases.groupBy(*owner, moment).agg(F.count("*").alias("rows"), F.max("order_id").alias("order_id"))
    return per_time.groupBy(*owner).agg(
        F.min(moment).alias("FirstPurchase"),
        F.max(F.struct(F.col(moment).alias("moment"), "order_id", "rows")).alias("last"),
        F.sum("rows").alias("Orders"),
    )


def identity_summary(activity: DataFrame) -> DataFrame:
    """First and latest purchase and five distinct counts per identity."""
    return activity.groupBy(IDENTITY).agg(
        F.min("FirstPurchase").alias("FirstPurchaseTimestamp"),
        F.max("last.moment").alias("LatestPurchaseTimestamp"),
        F.sum("Orders").alias("OrderCount"),
        F.count_distinct("customer_id").alias("CustomerIDCount"),
        F.count_distinct("customer_zip_code_prefix").alias("DistinctZIPCount"),
        F.count_distinct("customer_city").alias("DistinctCityCount"),
        F.count_distinct("customer_state").alias("DistinctStateCount"),
    )


def latest_purchases(activity: DataFrame) -> DataFrame:
    """The latest purchase per identity and how many share its time.

    Among purchases at the same time the largest (order, customer) represents
    the identity.
    """
    candidate = F.struct(F.col("last.order_id").alias("order_id"), "customer_id", *ADDRESS)
    per_time = activity.groupBy(IDENTITY, F.col("last.moment").alias("moment")).agg(
        F.sum("last.rows").alias("rows"), F.max(candidate).alias("candidate")
    )
    latest = per_time.groupBy(IDENTITY).agg(F.max(F.struct("moment", "rows", "candidate")).alias("_latest"))
    row = F.col("_latest.candidate")
    return latest.select(
        IDENTITY,
        row.customer_id.alias("RepresentativeCustomerID"),
        row.order_id.alias("RepresentativeOrderID"),
        row.customer_zip_code_prefix.alias("ZipCodePrefix"),
        row.customer_city.alias("CityName"),
        row.customer_state.alias("StateCode"),
        F.col("_latest.moment").alias("LatestTimestamp"),
        F.col("_latest.rows").alias("LatestTimestampRows"),
    )


def conformed_customer(customers: DataFrame, orders: DataFrame) -> DataFrame:
    scratch_root(orders.sparkSession)
    activity = customer_activity(customer_orders(customers, orders)).checkpoint()
    joined = identity_summary(activity).join(latest_purchases(activity), IDENTITY)
    return joined.select(
        F.col(IDENTITY).alias("CustomerUniqueID"),
        "RepresentativeCustomerID",
        "ZipCodePrefix",
        "CityName",
        "StateCode",
        "FirstPurchaseTimestamp",
        "LatestPurchaseTimestamp",
        "OrderCount",
        "CustomerIDCount",
        "DistinctZIPCount",
        "DistinctCityCount",
        "DistinctStateCount",
        flag(F.col("LatestTimestampRows") > 1).alias("LatestTimestampTieFlag"),
    )


def customer_profile(customer: DataFrame) -> DataFrame:
    return audit(
        customer,
        {
            "RowCount": F.count("*"),
            "DistinctCustomers": F.count_distinct("CustomerUniqueID"),
            "ReturningCustomers": matches(F.col("CustomerIDCount") > 1),
            "CustomersWithMultipleZIPs": matches(F.col("DistinctZIPCount") > 1),
            "CustomersWithMultipleStates": matches(F.col("DistinctStateCount") > 1),
            "CustomersWithMultipleCities": matches(F.col("DistinctCityCount") > 1),
            "LatestTimestampTies": matches(F.col("LatestTimestampTieFlag") == 1),
            "InvalidPurchaseDateRanges": matches(
                F.col("FirstPurchaseTimestamp") > F.col("LatestPurchaseTimestamp")
            ),
            "InvalidCustomerCounts": matches(
                F.least("OrderCount", "CustomerIDCount", "DistinctZIPCount", "DistinctCityCount", "DistinctStateCount") <= 0
            ),
            **{
                f"Null{c}": matches(F.col(c).isNull())
                for c in (
                    "CustomerUniqueID",
                    "RepresentativeCustomerID",
                    "ZipCodePrefix",
                    "CityName",
                    "StateCode",
                    "FirstPurchaseTimestamp",
                    "LatestPurchaseTimestamp",
                )
            },
        },
    )


def customer_geography_coverage(customer: DataFrame, geography: DataFrame) -> DataFrame:
    """Identities whose representative ZIP the geography lacks."""
    counted = customer.groupBy("ZipCodePrefix").agg(F.count("*").alias("_rows"))
    missing = counted.join(geography.select("ZipCodePrefix"), "ZipCodePrefix", "left_anti")
    return missing.agg(F.coalesce(F.sum("_rows"), F.lit(0)).alias("CustomerZIPsMissing"))


def representative_checks(customer: DataFrame, customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Does each representative belong to its identity, carry its address and bought last?"""
    sources = customers.select(
        F.col("customer_id").alias("RepresentativeCustomerID"),
        F.lit(1).alias("_found"),
        IDENTITY,
        "customer_zip_code_prefix",
        "customer_city",
        "customer_state",
    )
    joined = spread_join(customer, sources, ["RepresentativeCustomerID"], "left")
    found = F.col("_found").isNotNull()
    own = audit(
        joined,
        {
            "InvalidRepresentativeCustomerIDs": matches(~found | (F.col(IDENTITY) != F.col("CustomerUniqueID"))),
            "RepresentativeGeographyMismatches": matches(
                (F.col("ZipCodePrefix") != F.col("customer_zip_code_prefix"))
                | (F.col("CityName") != F.col("customer_city"))
                | (F.col("StateCode") != F.col("customer_state"))
            ),
        },
    )
    represented = customer.select(
        F.col("RepresentativeCustomerID").alias("customer_id"), "LatestPurchaseTimestamp"
    )
    bought = spread_join(orders.select("customer_id", "order_purchase_timestamp"), represented, ["customer_id"], "inner")
    late = bought.agg(
        matches(F.col("order_purchase_timestamp") != F.col("LatestPurchaseTimestamp")).alias("NotLatestOrders")
    )
    return own.select(
        F.inline(F.array(*[F.struct(F.lit(c).alias("Check"), F.col(c).alias("Rows")) for c in own.columns]))
    ).unionByName(late.select(F.lit("RepresentativeCustomersNotLatest").alias("Check"), F.col("NotLatestOrders").alias("Rows")))


def tie_geography_conflicts(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Identities whose latest purchases tie in time but disagree on the address."""
    activity = customer_activity(customer_orders(customers, orders))
    addresses = [F.count_distinct(c).alias(c) for c in ADDRESS]
    per_time = activity.groupBy(IDENTITY, F.col("last.moment").alias("moment")).agg(F.sum("last.rows").alias("rows"), *addresses)
    latest = per_time.groupBy(IDENTITY).agg(F.max(F.struct("moment", "rows", *ADDRESS)).alias("last"))
    disagrees = F.greatest(*[F.col(f"last.{c}") for c in ADDRESS]) > 1
    return latest.agg(matches((F.col("last.rows") > 1) & disagrees).alias("LatestTieGeographyConflicts"))
