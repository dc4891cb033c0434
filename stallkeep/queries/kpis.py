"""Business measures."""

from __future__ import annotations

from stallkeep.plans import measures as M
from stallkeep.queries.built import warehouse
from stallkeep.queries.oracle import round_half_up


def _w(plan, *names, **kw):
    return lambda s, d: plan(*[warehouse(s, d)[n] for n in names], **kw)


QUERIES = {
    "kpi_01_item_sales": _w(M.item_sales, "FactOrderItem", "DimProduct", "DimProductCategory"),
    "kpi_01_item_sales_by_product": _w(M.item_sales_by, "FactOrderItem", "DimProduct", key="ProductKey", label="ProductID"),
    "kpi_01_item_sales_by_seller": _w(M.item_sales_by, "FactOrderItem", "DimSeller", key="SellerKey", label="SellerID"),
    "kpi_02_orders_by_status": _w(M.orders_by_status, "FactOrder"),
    "kpi_03_delivery_performance": _w(M.delivery_performance, "FactOrder"),
    "kpi_04_average_order_value": _w(M.average_order_value, "FactPayment"),
    "kpi_05_payments_by_type": _w(M.payments_by_type, "FactPayment"),
    "kpi_06_early_answers": _w(M.early_answers, "FactReview", "FactOrder"),
    "kpi_07_shipping_limit_lag": _w(M.shipping_limit_lag, "FactOrderItem", "FactOrder"),
    "kpi_07_shipping_limit_outliers": _w(M.shipping_limit_outliers, "FactOrderItem", "FactOrder"),
    "kpi_08_late_by_day_and_time": _w(M.late_by_day_and_time, "FactOrder"),
    "kpi_09_unknown_date_keys": _w(M.unknown_date_keys, "FactOrder"),
}

_SALES = "CAST(sum(PriceAmount) AS DOUBLE) AS ItemSales, CAST(sum(FreightAmount) AS DOUBLE) AS Freight, count(*) AS Items"
_DAYS = "CAST(DeliveredCustomerTimestamp AS DATE) - CAST(PurchaseTimestamp AS DATE)"
_LAG = "(CAST(i.ShippingLimitTimestamp AS DATE) - CAST(o.PurchaseTimestamp AS DATE))"

ORACLE = {
    "kpi_01_item_sales": f"""SELECT i.PurchaseDateKey // 100 AS PurchaseMonth, CASE WHEN p.ProductCategoryKey = 0 THEN 'Unknown' ELSE c.EnglishCategoryName END AS EnglishCategoryName, {_SALES}
        FROM fact_item i JOIN dim_product p ON p.ProductKey = i.ProductKey LEFT JOIN dim_category c ON c.ProductCategoryKey = p.ProductCategoryKey GROUP BY 1, 2""",
    "kpi_01_item_sales_by_product": f"SELECT p.ProductID, {_SALES} FROM fact_item i JOIN dim_product p ON p.ProductKey = i.ProductKey GROUP BY 1",
    "kpi_01_item_sales_by_seller": f"SELECT s.SellerID, {_SALES} FROM fact_item i JOIN dim_seller s ON s.SellerKey = i.SellerKey GROUP BY 1",
    "kpi_02_orders_by_status": """SELECT PurchaseDateKey // 100 AS PurchaseMonth, OrderStatus, count(*) AS Orders, count(CASE WHEN OrderStatus = 'delivered' THEN 1 END) AS Delivered,
        count(CASE WHEN OrderStatus = 'canceled' THEN 1 END) AS Canceled FROM fact_order GROUP BY 1, 2""",
    "kpi_03_delivery_performance": f"""SELECT PurchaseDateKey // 100 AS PurchaseMonth, count(*) AS Orders, count(DeliveredLateFlag) AS DeliveredOrders,
        CAST(coalesce(sum(DeliveredLateFlag), 0) AS BIGINT) AS LateOrders, CAST(coalesce(sum({_DAYS}), 0) AS BIGINT) AS DeliveryDays,
        CAST(sum({_DAYS}) AS DOUBLE) / nullif(count({_DAYS}), 0) AS AvgDeliveryDays,
        CAST(count(DeliveredLateFlag) - sum(DeliveredLateFlag) AS DOUBLE) / nullif(count(DeliveredLateFlag), 0) AS OnTimeRate FROM fact_order GROUP BY 1""",
    "kpi_04_average_order_value": f"""SELECT PurchaseMonth, count(*) AS PaidOrders, CAST(sum(total) AS DOUBLE) AS PaymentAmount, {round_half_up('sum(total)', 'count(*)')} AS AverageOrderValue
        FROM (SELECT OrderID, PurchaseDateKey // 100 AS PurchaseMonth, sum(PaymentAmount) AS total FROM fact_payment GROUP BY 1, 2) GROUP BY 1""",
    "kpi_05_payments_by_type": "SELECT PaymentType, count(*) AS Payments, CAST(sum(PaymentAmount) AS DOUBLE) AS PaymentAmount FROM fact_payment GROUP BY 1",
    "kpi_06_early_answers": """SELECT CAST(o.DeliveredLateFlag AS BIGINT) AS DeliveredLateFlag, count(*) AS EarlyAnswers FROM fact_review r JOIN fact_order o ON o.OrderID = r.OrderID
        WHERE CAST(o.DeliveredCustomerTimestamp AS DATE) - CAST(r.ReviewAnswerTimestamp AS DATE) >= 31 GROUP BY 1""",
    "kpi_07_shipping_limit_lag": f"""SELECT CAST(floor({_LAG} / 30.0) * 30 AS BIGINT) AS LagBandStart, count(*) AS Items, CAST(min({_LAG}) AS BIGINT) AS MinLag, CAST(max({_LAG}) AS BIGINT) AS MaxLag
        FROM fact_item i JOIN fact_order o ON o.OrderID = i.OrderID GROUP BY 1""",
    "kpi_07_shipping_limit_outliers": f"SELECT i.OrderID, CAST(i.OrderItemID AS BIGINT) AS OrderItemID, CAST({_LAG} AS BIGINT) AS LagDays FROM fact_item i JOIN fact_order o ON o.OrderID = i.OrderID WHERE {_LAG} > 1000",
    "kpi_08_late_by_day_and_time": """SELECT count(CASE WHEN DeliveredLateFlag = 1 THEN 1 END) AS LateByDate,
        count(CASE WHEN DeliveredCustomerTimestamp > CAST(EstimatedDeliveryDate AS TIMESTAMP) THEN 1 END) AS LateByTimestamp,
        count(CASE WHEN DeliveredCustomerTimestamp > CAST(EstimatedDeliveryDate AS TIMESTAMP) AND DeliveredLateFlag = 0 THEN 1 END) AS BoundaryDayOrders FROM fact_order""",
    "kpi_09_unknown_date_keys": "SELECT " + ", ".join(
        f"count(CASE WHEN {r} = 0 THEN 1 END) AS {r}" for r in ("PurchaseDateKey", "ApprovedDateKey", "CarrierDateKey", "DeliveredDateKey", "EstimatedDeliveryDateKey")
    ) + " FROM fact_order",
}
