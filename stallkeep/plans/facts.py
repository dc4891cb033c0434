"""Fact loads: keys, counters, measures and the temporal and quality flags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallkeep.functions import date_key, flag, flag_unless_null
from stallkeep.operators.joins import HOT_ROWS, found, lookup, spread_join
from stallkeep.operators.quality import sequence_profile
from stallkeep.session import scratch_path


def carrier_before_purchase(purchase: Column, carrier: Column) -> Column:
    return flag(carrier < purchase)


def carrier_before_approval(approved: Column, carrier: Column) -> Column:
    return flag(carrier < approved)


def delivered_before_carrier(carrier: Column, delivered: Column) -> Column:
    return flag(delivered < carrier)


def delivered_late(delivered: Column, estimated: Column) -> Column:
    """By calendar day: NULL if not delivered, 0 without an estimate."""
    return flag_unless_null(delivered, delivered.cast("date") > estimated)


def keyed_customers(customers: DataFrame, dim_customer: DataFrame, dim_geography: DataFrame) -> DataFrame:
    """Customers with their surrogate keys; NULL where a lookup finds nothing.

    Resolving keys per customer leaves a single join for the orders, the
    larger table. A customer who never ordered has no dimension row, so a
    missing key is an error only once an order needs it.
    """
    owners = customers.select("customer_id", "customer_unique_id", "customer_zip_code_prefix")
    known = lookup(owners, dim_customer, "CustomerUniqueID", "CustomerKey", "customer_unique_id", hot_from=customers)
    return lookup(
        known, dim_geography, "ZipCodePrefix", "GeographyKey", "customer_zip_code_prefix", "CustomerGeographyKey", hot_from=customers
    ).select("customer_id", "CustomerKey", "CustomerGeographyKey")


def order_source(orders: DataFrame, owners: DataFrame, customers: DataFrame) -> DataFrame:
    """One row per order of a known customer: keys, dates, times and flags.

    ``owners`` has one row per row of ``customers``.
    """
    purchase, approved = F.col("order_purchase_timestamp"), F.col("order_approved_at")
    carrier, delivered = F.col("order_delivered_carrier_date"), F.col("order_delivered_customer_date")
    estimated = F.col("order_estimated_delivery_date")
    return spread_join(orders, owners, ["customer_id"], "inner", size_from=customers).select(
        F.col("order_id").alias("OrderID"),
        found("CustomerKey", "customer_unique_id"),
        found("GeographyKey", "customer_zip_code_prefix", "CustomerGeographyKey"),
        date_key(purchase).alias("PurchaseDateKey"),
        date_key(approved, null_as_unknown=True).alias("ApprovedDateKey"),
        date_key(carrier, null_as_unknown=True).alias("CarrierDateKey"),
        date_key(delivered, null_as_unknown=True).alias("DeliveredDateKey"),
        date_key(estimated, null_as_unknown=True).alias("EstimatedDeliveryDateKey"),
        F.col("order_status").alias("OrderStatus"),
        purchase.alias("PurchaseTimestamp"),
        approved.alias("ApprovedTimestamp"),
        carrier.alias("DeliveredCarrierTimestamp"),
        delivered.alias("DeliveredCustomerTimestamp"),
        estimated.alias("EstimatedDeliveryDate"),
        F.lit(1).alias("OrderCount"),
        carrier_before_purchase(purchase, carrier).alias("CarrierBeforePurchaseFlag"),
        carrier_before_approval(approved, carrier).alias("CarrierBeforeApprovalFlag"),
        delivered_before_carrier(carrier, delivered).alias("DeliveredBeforeCarrierFlag"),
        delivered_late(delivered, estimated).alias("DeliveredLateFlag"),
    )


ORDER_COLUMNS = (
    "OrderID", "CustomerKey", "CustomerGeographyKey", "PurchaseDateKey", "ApprovedDateKey", "CarrierDateKey",
    "DeliveredDateKey", "EstimatedDeliveryDateKey", "OrderStatus", "PurchaseTimestamp", "ApprovedTimestamp",
    "DeliveredCarrierTimestamp", "DeliveredCustomerTimestamp", "EstimatedDeliveryDate", "OrderCount",
    "CarrierBeforePurchaseFlag", "CarrierBeforeApprovalFlag", "DeliveredBeforeCarrierFlag", "DeliveredLateFlag",
)
ITEM_COLUMNS = (
    "OrderID", "OrderItemID", "ProductKey", "SellerKey", "CustomerKey", "CustomerGeographyKey", "PurchaseDateKey",
    "ShippingLimitDateKey", "OrderStatus", "ShippingLimitTimestamp", "PriceAmount", "FreightAmount", "OrderItemCount",
)
PAYMENT_COLUMNS = (
    "OrderID", "PaymentSequential", "CustomerKey", "CustomerGeographyKey", "PurchaseDateKey", "OrderStatus",
    "PaymentType", "PaymentInstallments", "PaymentAmount", "PaymentCount", "PaymentSequenceAnomalyFlag",
    "UndefinedPaymentTypeFlag", "ZeroInstallmentFlag", "ZeroPaymentValueFlag",
)
REVIEW_COLUMNS = (
    "ReviewID", "OrderID", "CustomerKey", "CustomerGeographyKey", "PurchaseDateKey", "ReviewCreationDateKey",
    "ReviewAnswerDateKey", "OrderStatus", "ReviewScore", "ReviewCommentTitle", "ReviewCommentMessage",
    "ReviewCreationTimestamp", "ReviewAnswerTimestamp", "ReviewCount", "DuplicateReviewIDFlag",
    "ReviewCreatedBeforePurchaseFlag", "ReviewCreatedBeforeDeliveryFlag", "ReviewAnsweredBeforePurchaseFlag",
    "ReviewAnsweredBeforeDeliveryFlag", "ReviewAnsweredBeforeCreationFlag",
)


def fact_order(orders: DataFrame, customers: DataFrame, dim_customer: DataFrame, dim_geography: DataFrame) -> DataFrame:
    owners = keyed_customers(customers, dim_customer, dim_geography)
    return order_source(orders, owners, customers).select(*ORDER_COLUMNS)


def _of_order(orders: DataFrame, *extra: str) -> DataFrame:
    """What a child row takes over from its loaded order.

    Customer and geography of a child row are those of its order, so the keys
    the order has already looked up are reused: one join instead of four.
    """
    return orders.select(
        F.col("OrderID").alias("order_id"),
        "CustomerKey",
        "CustomerGeographyKey",
        "PurchaseDateKey",
        "OrderStatus",
        *extra,
    )


def fact_order_item(items: DataFrame, orders: DataFrame, dim_product: DataFrame, dim_seller: DataFrame) -> DataFrame:
    """``orders`` is the loaded FactOrder."""
    keyed = lookup(items, dim_product, "ProductID", "ProductKey", "product_id")
    keyed = lookup(keyed, dim_seller, "SellerID", "SellerKey", "seller_id", hot_from=items)
    return spread_join(keyed, _of_order(orders), ["order_id"], "inner", hot_from=items).select(
        F.col("order_id").alias("OrderID"),
        F.col("order_item_id").alias("OrderItemID"),
        found("ProductKey", "product_id"),
        found("SellerKey", "seller_id"),
        "CustomerKey",
        "CustomerGeographyKey",
        "PurchaseDateKey",
        date_key("shipping_limit_date").alias("ShippingLimitDateKey"),
        "OrderStatus",
        F.col("shipping_limit_date").alias("ShippingLimitTimestamp"),
        F.col("price").alias("PriceAmount"),
        F.col("freight_value").alias("FreightAmount"),
        F.lit(1).alias("OrderItemCount"),
    )


def broken_sequences(payments: DataFrame) -> DataFrame:
    """Orders whose payment numbers are not 1..n, one row each."""
    profile = sequence_profile(payments, ["order_id"], "payment_sequential")
    return profile.filter("SequenceAnomaly = 1").select("order_id", F.lit(1).alias("_broken"))


def with_sequence_anomaly(payments: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Mark every row of an order whose payment numbers are not 1..n.

    A window would gather an order's rows in one task; here each order is
    reduced to one row and only the broken orders are joined back.
    """
    marked = spread_join(payments, broken_sequences(payments), ["order_id"], "left", hot_rows=hot_rows)
    return marked.withColumn("PaymentSequenceAnomalyFlag", flag(F.col("_broken") == 1)).drop("_broken")


def payment_flags(payments: DataFrame) -> DataFrame:
    return payments.withColumns(
        {
            "UndefinedPaymentTypeFlag": flag(F.col("payment_type") == "not_defined"),
            "ZeroInstallmentFlag": flag(F.col("payment_installments") == 0),
            "ZeroPaymentValueFlag": flag(F.col("payment_value") == 0),
        }
    )


def fact_payment(payments: DataFrame, orders: DataFrame) -> DataFrame:
    """The sequence flag is put on the order, one row each, so payments move once."""
    marked = _of_order(orders).join(broken_sequences(payments), "order_id", "left")
    marked = marked.withColumn("PaymentSequenceAnomalyFlag", flag(F.col("_broken") == 1)).drop("_broken")
    flagged = payment_flags(payments)
    return spread_join(flagged, marked, ["order_id"], "inner", hot_from=payments, size_from=orders).select(
        F.col("order_id").alias("OrderID"),
        F.col("payment_sequential").alias("PaymentSequential"),
        "CustomerKey",
        "CustomerGeographyKey",
        "PurchaseDateKey",
        "OrderStatus",
        F.col("payment_type").alias("PaymentType"),
        F.col("payment_installments").alias("PaymentInstallments"),
        F.col("payment_value").alias("PaymentAmount"),
        F.lit(1).alias("PaymentCount"),
        "PaymentSequenceAnomalyFlag",
        "UndefinedPaymentTypeFlag",
        "ZeroInstallmentFlag",
        "ZeroPaymentValueFlag",
    )


def with_duplicate_review_flag(reviews: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Mark every row whose review id occurs more than once (same plan as the sequence flag).

    A NULL review id is never marked here; the source contract forbids it. The
    repeated ids, usually few, are written first: where their real size allows
    it they are broadcast, and the reviews with their texts do not move.
    """
    repeated = (
        reviews.groupBy("review_id").agg(F.count("*").alias("_rows")).filter("_rows > 1").select("review_id", F.lit(1).alias("_repeated"))
    )
    path = scratch_path(reviews.sparkSession, "repeated-reviews")
    repeated.write.parquet(path)
    repeated = reviews.sparkSession.read.schema(repeated.schema).parquet(path)
    marked = spread_join(reviews, repeated, ["review_id"], "left", hot_rows=hot_rows)
    return marked.withColumn("DuplicateReviewIDFlag", flag(F.col("_repeated") == 1)).drop("_repeated")


def review_flags(reviews: DataFrame, purchase: str, delivered: str) -> DataFrame:
    """Six temporal flags: creation is compared by day, the answer by time.

    The flags relative to delivery stay NULL while there is no delivery.
    """
    created, answered = F.col("review_creation_date"), F.col("review_answer_timestamp")
    bought, arrived = F.col(purchase), F.col(delivered)
    created_day = created.cast("date")
    return reviews.withColumns(
        {
            "ReviewCreatedBeforePurchaseFlag": flag(created_day < bought.cast("date")),
            "ReviewCreatedBeforeDeliveryFlag": flag_unless_null(arrived, created_day < arrived.cast("date")),
            "ReviewAnsweredBeforePurchaseFlag": flag(answered < bought),
            "ReviewAnsweredBeforeDeliveryFlag": flag_unless_null(arrived, answered < arrived),
            "ReviewAnsweredBeforeCreationFlag": flag(answered < created),
        }
    )


def fact_review(reviews: DataFrame, orders: DataFrame) -> DataFrame:
    of_order = _of_order(orders, "PurchaseTimestamp", "DeliveredCustomerTimestamp")
    joined = spread_join(with_duplicate_review_flag(reviews), of_order, ["order_id"], "inner", hot_from=reviews)
    return review_flags(joined, "PurchaseTimestamp", "DeliveredCustomerTimestamp").select(
        F.col("review_id").alias("ReviewID"),
        F.col("order_id").alias("OrderID"),
        "CustomerKey",
        "CustomerGeographyKey",
        "PurchaseDateKey",
        date_key("review_creation_date").alias("ReviewCreationDateKey"),
        date_key("review_answer_timestamp").alias("ReviewAnswerDateKey"),
        "OrderStatus",
        F.col("review_score").alias("ReviewScore"),
        F.col("review_comment_title").alias("ReviewCommentTitle"),
        F.col("review_comment_message").alias("ReviewCommentMessage"),
        F.col("review_creation_date").alias("ReviewCreationTimestamp"),
        F.col("review_answer_timestamp").alias("ReviewAnswerTimestamp"),
        F.lit(1).alias("ReviewCount"),
        "DuplicateReviewIDFlag",
        "ReviewCreatedBeforePurchaseFlag",
        "ReviewCreatedBeforeDeliveryFlag",
        "ReviewAnsweredBeforePurchaseFlag",
        "ReviewAnsweredBeforeDeliveryFlag",
        "ReviewAnsweredBeforeCreationFlag",
    )
