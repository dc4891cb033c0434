"""Business measures over the loaded star schema.

Items, payments and reviews are never joined row to row; each is reduced to
its own grain first. There is no profit or margin: the sources carry no cost.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallkeep.functions import flag, matches
from stallkeep.operators.joins import spread_join

def purchase_month() -> Column:
    return F.floor(F.col("PurchaseDateKey") / 100).cast("int").alias("PurchaseMonth")


def item_sales(items: DataFrame, products: DataFrame, categories: DataFrame) -> DataFrame:
    """Price and freight by month and category.

    Rows are summed per (month, product) before products and categories are joined.
    """
    per_product = items.groupBy(purchase_month(), "ProductKey").agg(
        F.sum("PriceAmount").alias("_price"), F.sum("FreightAmount").alias("_freight"), F.sum("OrderItemCount").alias("_items")
    )
    return (
        per_product.join(products.select("ProductKey", "ProductCategoryKey"), "ProductKey")
        .join(categories.select("ProductCategoryKey", "EnglishCategoryName"), "ProductCategoryKey")
        .groupBy("PurchaseMonth", "EnglishCategoryName")
        .agg(
            F.sum("_price").alias("ItemSales"),
            F.sum("_freight").alias("Freight"),
            F.sum("_items").alias("Items"),
        )
    )


def item_sales_by(items: DataFrame, dimension: DataFrame, key: str, label: str) -> DataFrame:
    """Price and freight by the label of one dimension (product, seller, …)."""
    per_key = items.groupBy(key).agg(
        F.sum("PriceAmount").alias("ItemSales"), F.sum("FreightAmount").alias("Freight"), F.sum("OrderItemCount").alias("Items")
    )
    return per_key.join(dimension.select(key, label), key).select(label, "ItemSales", "Freight", "Items")


def orders_by_status(orders: DataFrame) -> DataFrame:
    return orders.groupBy(purchase_month(), "OrderStatus").agg(
        F.sum("OrderCount").alias("Orders"),
        matches(F.col("OrderStatus") == "delivered").alias("Delivered"),
        matches(F.col("OrderStatus") == "canceled").alias("Canceled"),
    )


def delivery_performance(orders: DataFrame) -> DataFrame:
    """Days to delivery and on-time rate by month; orders without a delivery count in neither.

    Sums and counts are kept next to the averages so that months can be rolled up.
    """
    days = F.datediff(F.col("DeliveredCustomerTimestamp").cast("date"), F.col("PurchaseTimestamp").cast("date"))
    judged = F.count("DeliveredLateFlag")
    late = F.coalesce(F.sum("DeliveredLateFlag"), F.lit(0))
    return orders.groupBy(purchase_month()).agg(
        F.sum("OrderCount").alias("Orders"),
        judged.alias("DeliveredOrders"),
        late.alias("LateOrders"),
        F.coalesce(F.sum(days), F.lit(0)).alias("DeliveryDays"),
        (F.sum(days) / F.nullif(F.count(days), F.lit(0))).alias("AvgDeliveryDays"),
        ((judged - late) / F.nullif(judged, F.lit(0))).alias("OnTimeRate"),
    )


def average_order_value(payments: DataFrame) -> DataFrame:
    """Mean of the payment total per order, by purchase month."""
    per_order = payments.groupBy("OrderID", purchase_month()).agg(F.sum("PaymentAmount").alias("_total"))
    return per_order.groupBy("PurchaseMonth").agg(
        F.count("*").alias("PaidOrders"),
        F.sum("_total").alias("PaymentAmount"),
        (F.sum("_total") / F.count("*")).cast("decimal(18,2)").alias("AverageOrderValue"),
    )


def payments_by_type(payments: DataFrame) -> DataFrame:
    return payments.groupBy("PaymentType").agg(
        F.sum("PaymentCount").alias("Payments"), F.sum("PaymentAmount").alias("PaymentAmount")
    )


def early_answers(reviews: DataFrame, orders: DataFrame, days: int = 31) -> DataFrame:
    """Reviews answered at least ``days`` days before delivery, by late flag."""
    delivery = orders.filter(F.col("DeliveredCustomerTimestamp").isNotNull()).select(
        "OrderID", "DeliveredCustomerTimestamp", "DeliveredLateFlag"
    )
    joined = spread_join(reviews.select("OrderID", "ReviewAnswerTimestamp"), delivery, ["OrderID"], "inner")
    lead = F.datediff("DeliveredCustomerTimestamp", "ReviewAnswerTimestamp")
    return joined.filter(lead >= days).groupBy("DeliveredLateFlag").agg(F.count("*").alias("EarlyAnswers"))


def shipping_limit_lag(items: DataFrame, orders: DataFrame, band_days: int = 30) -> DataFrame:
    """Histogram of days from purchase to shipping limit."""
    bought = orders.select("OrderID", "PurchaseTimestamp")
    joined = spread_join(items.select("OrderID", "ShippingLimitTimestamp"), bought, ["OrderID"], "inner")
    lag = F.datediff("ShippingLimitTimestamp", "PurchaseTimestamp")
    return (
        joined.select(lag.alias("_lag"))
        .groupBy((F.floor(F.col("_lag") / band_days) * band_days).cast("int").alias("LagBandStart"))
        .agg(F.count("*").alias("Items"), F.min("_lag").alias("MinLag"), F.max("_lag").alias("MaxLag"))
    )


def shipping_limit_outliers(items: DataFrame, orders: DataFrame, days: int = 1000) -> DataFrame:
    """Item rows whose shipping limit lies more than ``days`` days after the purchase."""
    bought = orders.select("OrderID", "PurchaseTimestamp")
    joined = spread_join(items.select("OrderID", "OrderItemID", "ShippingLimitTimestamp"), bought, ["OrderID"], "inner")
    lag = F.datediff("ShippingLimitTimestamp", "PurchaseTimestamp")
    return joined.withColumn("LagDays", lag).filter(F.col("LagDays") > days).select("OrderID", "OrderItemID", "LagDays")


def late_by_day_and_time(orders: DataFrame) -> DataFrame:
    """Late orders by calendar day against late orders by timestamp.

    By timestamp an order delivered during its estimated day is late already.
    """
    by_time = F.col("DeliveredCustomerTimestamp") > F.col("EstimatedDeliveryDate").cast("timestamp_ntz")
    by_day = F.col("DeliveredLateFlag") == 1
    return orders.agg(
        matches(by_day).alias("LateByDate"),
        matches(by_time).alias("LateByTimestamp"),
        matches(by_time & ~by_day).alias("BoundaryDayOrders"),
    )


def unknown_date_keys(orders: DataFrame) -> DataFrame:
    roles = ("PurchaseDateKey", "ApprovedDateKey", "CarrierDateKey", "DeliveredDateKey", "EstimatedDeliveryDateKey")
    return orders.agg(*[F.coalesce(F.sum(flag(F.col(r) == 0)), F.lit(0)).alias(r) for r in roles])
