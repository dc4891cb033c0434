"""Dimension and fact loads."""

from __future__ import annotations

from pyspark.sql import functions as F

from stallkeep.functions import date_key
from stallkeep.functions.calendar import UNKNOWN_FA
from stallkeep.operators.joins import strict_lookup
from stallkeep.operators.keys import number_rows, with_unknown_member
from stallkeep.operators.rules import ValidationError
from stallkeep.plans import dimensions as D
from stallkeep.plans import facts as X
from stallkeep.queries.built import staging, warehouse
from stallkeep.queries.oracle import day, day_key, moment
from stallkeep.queries.roles import driver_table
from stallkeep.queries.shape import micro


def _dim_geography(s, d):
    return D.dim_geography(warehouse(s, d)["Geography"]).withColumns(
        {"lat_micro": micro("RepresentativeLatitude"), "lng_micro": micro("RepresentativeLongitude")}
    ).drop("RepresentativeLatitude", "RepresentativeLongitude")


def _unknown_members(s, d):
    """Rows and Unknown rows of every loaded dimension."""
    w = warehouse(s, d)
    parts = [
        w[name].agg(F.count("*").alias("TotalRows"), F.sum((F.col(key) == 0).cast("int")).alias("UnknownRows")).select(
            F.lit(name).alias("Dimension"), "TotalRows", "UnknownRows"
        )
        for name, (key, _) in D.RELOAD_CODES.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _supplier_member(s, d):
    members = number_rows(driver_table(s, d, "supplier"), ["s_suppkey"], "SupplierKey")
    return with_unknown_member(members, {"SupplierKey": 0, "s_name": "Unknown"})


def _part_keys(s, d):
    return number_rows(driver_table(s, d, "part").select("p_name", "p_partkey"), ["p_name", "p_partkey"], "PartKey")


def _lineitem_lookup(s, d):
    """lineitem with the surrogate keys of its part and supplier, summed per supplier key."""
    w = warehouse(s, d)
    keyed = strict_lookup(w["order_items"], w["DimSeller"], "SellerID", "SellerKey", "seller_id")
    keyed = strict_lookup(keyed, w["DimProduct"], "ProductID", "ProductKey", "product_id")
    return keyed.groupBy("SellerKey").agg(F.count("*").alias("Items"), F.sum("ProductKey").alias("ProductKeys"))


def _reload_check(s, d):
    """Business rows a load would have to refuse to write over."""
    w = warehouse(s, d)
    parts = [
        w[name].filter(F.col(key) != 0).agg(F.count("*").alias("BusinessRows")).select(
            F.lit(name).alias("Dimension"), F.lit(code).alias("RefusalCode"), "BusinessRows"
        )
        for name, (key, code) in D.RELOAD_CODES.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _refused_loads(s, d):
    """The error each dimension load raises on top of the rows already there."""
    raised = []
    for name in D.RELOAD_CODES:
        try:
            D.refuse_reload(warehouse(s, d)[name], name)
        except ValidationError as error:
            raised.append((name, error.scope, error.code))
    return s.createDataFrame(raised, "Dimension string, Scope string, Code int")


def _product_routes(s, d):
    w = warehouse(s, d)
    routed = D.product_members(w["products"], w["DimProductCategory"])
    route = F.when(F.col("ProductCategoryKey") == 0, "unknown").otherwise("lookup")
    return routed.groupBy(route.alias("Route")).agg(F.count("*").alias("Products"), F.sum("ProductCategoryKey").alias("KeySum"))


def _order_flags(s, d):
    t = staging(s, d)
    o = t["orders"]
    carrier, delivered = F.col("order_delivered_carrier_date"), F.col("order_delivered_customer_date")
    return o.select(
        "order_id",
        X.carrier_before_purchase(F.col("order_purchase_timestamp"), carrier).alias("CarrierBeforePurchaseFlag"),
        X.carrier_before_approval(F.col("order_approved_at"), carrier).alias("CarrierBeforeApprovalFlag"),
        X.delivered_before_carrier(carrier, delivered).alias("DeliveredBeforeCarrierFlag"),
    )


def _late(s, d):
    o = staging(s, d)["orders"]
    return o.select(
        "order_id",
        X.delivered_late(F.col("order_delivered_customer_date"), F.col("order_estimated_delivery_date")).alias("DeliveredLateFlag"),
    )


def _date_keys(s, d):
    o = staging(s, d)["orders"]
    return o.select(
        "order_id",
        date_key("order_purchase_timestamp").alias("PurchaseDateKey"),
        date_key("order_approved_at", True).alias("ApprovedDateKey"),
        date_key("order_delivered_customer_date", True).alias("DeliveredDateKey"),
        date_key("order_estimated_delivery_date", True).alias("EstimatedDeliveryDateKey"),
    )


def _fact_order(s, d):
    w = warehouse(s, d)
    return X.fact_order(w["orders"], w["customers"], w["DimCustomer"], w["DimGeography"])


def _fact_item(s, d):
    w = warehouse(s, d)
    return X.fact_order_item(w["order_items"], w["FactOrder"], w["DimProduct"], w["DimSeller"])


def _review_flags(s, d):
    w = warehouse(s, d)
    orders = w["FactOrder"].select(F.col("OrderID").alias("order_id"), "PurchaseTimestamp", "DeliveredCustomerTimestamp")
    joined = w["reviews"].select("review_id", "order_id", "review_creation_date", "review_answer_timestamp").join(orders, "order_id")
    return X.review_flags(joined, "PurchaseTimestamp", "DeliveredCustomerTimestamp").drop(
        "review_creation_date", "review_answer_timestamp", "PurchaseTimestamp", "DeliveredCustomerTimestamp"
    )


QUERIES = {
    "dim_01_unknown_members": _unknown_members,
    "dim_01_supplier_with_unknown": _supplier_member,
    "dim_02_surrogate_keys": _part_keys,
    "dim_03_strict_lookup": _lineitem_lookup,
    "dim_04_reload_refusal": _reload_check,
    "dim_04_refused_loads": _refused_loads,
    "dim_05_dim_geography": _dim_geography,
    "dim_06_dim_customer": lambda s, d: D.dim_customer(warehouse(s, d)["Customer"], warehouse(s, d)["DimGeography"]),
    "dim_07_dim_seller": lambda s, d: D.dim_seller(staging(s, d)["sellers"], warehouse(s, d)["DimGeography"]),
    "dim_08_dim_product_category": lambda s, d: D.dim_category(warehouse(s, d)["ProductCategory"], staging(s, d)["localization"]),
    "dim_09_dim_product": lambda s, d: D.dim_product(staging(s, d)["products"], warehouse(s, d)["DimProductCategory"]),
    "dim_10_product_routes": _product_routes,
    "fct_01_date_keys": _date_keys,
    "fct_02_fact_order": _fact_order,
    "fct_03_order_flags": _order_flags,
    "fct_04_delivered_late": _late,
    "fct_05_fact_order_item": _fact_item,
    "fct_06_payment_sequence_flag": lambda s, d: X.with_sequence_anomaly(staging(s, d)["payments"]).select(
        "order_id", "payment_sequential", "PaymentSequenceAnomalyFlag"
    ),
    "fct_07_payment_flags": lambda s, d: X.payment_flags(staging(s, d)["payments"]).select(
        "order_id", "payment_sequential", "UndefinedPaymentTypeFlag", "ZeroInstallmentFlag", "ZeroPaymentValueFlag"
    ),
    "fct_08_fact_payment": lambda s, d: X.fact_payment(staging(s, d)["payments"], warehouse(s, d)["FactOrder"]),
    "fct_09_duplicate_review_flag": lambda s, d: X.with_duplicate_review_flag(staging(s, d)["reviews"]).select(
        "review_id", "order_id", "DuplicateReviewIDFlag"
    ),
    "fct_10_review_flags": _review_flags,
    "fct_11_fact_review": lambda s, d: X.fact_review(staging(s, d)["reviews"], warehouse(s, d)["FactOrder"]),
}


def _counts(sql: str) -> str:
    names = (("DimGeography", "dim_geography", 51041), ("DimCustomer", "dim_customer", 51042), ("DimSeller", "dim_seller", 51043),
             ("DimProductCategory", "dim_category", 51044), ("DimProduct", "dim_product", 51045))
    return " UNION ALL ".join(sql.format(name=n, block=b, code=c) for n, b, c in names)


def _b(*names: str) -> str:
    return ", ".join(f"CAST({n} AS BIGINT) AS {n}" for n in names)


_UNKNOWN_FLAGS = "0, 0, 0, 0, 0, 0, 0, 0"
ORACLE = {
    "dim_01_unknown_members": _counts("SELECT '{name}' AS Dimension, count(*) + 1 AS TotalRows, CAST(1 AS BIGINT) AS UnknownRows FROM {block}"),
    "dim_01_supplier_with_unknown": """SELECT row_number() OVER (ORDER BY s_suppkey) AS SupplierKey, s_suppkey, s_name, CAST(s_nationkey AS BIGINT) AS s_nationkey, s_acctbal FROM supplier
        UNION ALL SELECT 0, NULL, 'Unknown', NULL, NULL""",
    "dim_02_surrogate_keys": "SELECT row_number() OVER (ORDER BY p_name, p_partkey) AS PartKey, p_name, p_partkey FROM part",
    "dim_03_strict_lookup": "SELECT s.SellerKey, count(*) AS Items, CAST(sum(p.ProductKey) AS BIGINT) AS ProductKeys FROM stg_items i JOIN dim_seller s ON s.SellerID = i.seller_id JOIN dim_product p ON p.ProductID = i.product_id GROUP BY 1",
    "dim_04_refused_loads": " UNION ALL ".join(
        f"SELECT '{n}' AS Dimension, '{n}' AS Scope, CAST({code} AS BIGINT) AS Code WHERE EXISTS (SELECT 1 FROM {block})"
        for (n, (_, code)), block in zip(D.RELOAD_CODES.items(), ("dim_geography", "dim_customer", "dim_seller", "dim_category", "dim_product"))
    ),
    "dim_04_reload_refusal": _counts("SELECT '{name}' AS Dimension, CAST({code} AS BIGINT) AS RefusalCode, count(*) AS BusinessRows FROM {block}"),
    "dim_05_dim_geography": f"""SELECT GeographyKey, ZipCodePrefix, CityName, StateCode, HasCoordinates, MissingFromGeolocationFlag, StateConflictFlag, StateAmbiguousFlag,
        StateResolvedByReferenceFlag, CityAmbiguousFlag, CityResolvedByReferenceFlag, ReferenceFallbackFlag,
        CAST(round(lat * 1000000) AS BIGINT) AS lat_micro, CAST(round(lng * 1000000) AS BIGINT) AS lng_micro FROM dim_geography
        UNION ALL SELECT 0, NULL, 'Unknown', NULL, {_UNKNOWN_FLAGS}, NULL, NULL""",
    "dim_06_dim_customer": f"""SELECT CustomerKey, CustomerUniqueID, RepresentativeCustomerID, RepresentativeGeographyKey, {moment('first_ts')} AS FirstPurchaseTimestamp,
        {moment('last_ts')} AS LatestPurchaseTimestamp, OrderCount, CustomerIDCount, ReturningCustomerFlag, MultipleZIPFlag, MultipleCityFlag, MultipleStateFlag,
        LatestTimestampTieFlag FROM dim_customer UNION ALL SELECT 0, NULL, NULL, 0, NULL, NULL, 0, 0, 0, 0, 0, 0, 0""",
    "dim_07_dim_seller": f"SELECT SellerKey, SellerID, GeographyKey, SourceZipCodePrefix, SourceCityName, SourceStateCode, {_b('CityMismatchFlag', 'StateMismatchFlag')} FROM dim_seller UNION ALL SELECT 0, NULL, 0, NULL, 'Unknown', NULL, 0, 0",
    "dim_08_dim_product_category": f"SELECT * FROM dim_category UNION ALL SELECT 0, NULL, 'Unknown', '{UNKNOWN_FA}', 0, 0",
    "dim_09_dim_product": f"""SELECT ProductKey, ProductID, ProductCategoryKey, {_b('ProductNameLength', 'ProductDescriptionLength', 'ProductPhotosQty', 'ProductWeightG', 'ProductLengthCm', 'ProductHeightCm', 'ProductWidthCm', 'MissingSourceCategoryFlag', 'MissingDescriptiveAttributesFlag', 'MissingPhysicalAttributesFlag', 'ZeroWeightFlag')} FROM dim_product
        UNION ALL SELECT 0, NULL, 0, NULL, NULL, NULL, NULL, NULL, NULL, NULL, 0, 0, 0, 0""",
    "dim_10_product_routes": "SELECT CASE WHEN product_category_name IS NULL THEN 'unknown' ELSE 'lookup' END AS Route, count(*) AS Products, CAST(sum(ProductCategoryKey) AS BIGINT) AS KeySum FROM stg_products JOIN dim_product ON ProductID = product_id GROUP BY 1",
    "fct_01_date_keys": f"""SELECT order_id, {day_key('order_purchase_timestamp')} AS PurchaseDateKey, coalesce({day_key('order_approved_at')}, 0) AS ApprovedDateKey,
        coalesce({day_key('order_delivered_customer_date')}, 0) AS DeliveredDateKey, coalesce({day_key('order_estimated_delivery_date')}, 0) AS EstimatedDeliveryDateKey FROM stg_orders""",
    "fct_02_fact_order": f"""SELECT OrderID, CustomerKey, CustomerGeographyKey, PurchaseDateKey, ApprovedDateKey, CarrierDateKey, DeliveredDateKey, EstimatedDeliveryDateKey, OrderStatus,
        {moment('PurchaseTimestamp')} AS PurchaseTimestamp, {moment('ApprovedTimestamp')} AS ApprovedTimestamp, {moment('DeliveredCarrierTimestamp')} AS DeliveredCarrierTimestamp,
        {moment('DeliveredCustomerTimestamp')} AS DeliveredCustomerTimestamp, {day('EstimatedDeliveryDate')} AS EstimatedDeliveryDate,
        {_b('OrderCount', 'CarrierBeforePurchaseFlag', 'CarrierBeforeApprovalFlag', 'DeliveredBeforeCarrierFlag', 'DeliveredLateFlag')} FROM fact_order""",
    "fct_03_order_flags": """SELECT order_id, CAST(CASE WHEN order_delivered_carrier_date < order_purchase_timestamp THEN 1 ELSE 0 END AS BIGINT) AS CarrierBeforePurchaseFlag,
        CAST(CASE WHEN order_delivered_carrier_date < order_approved_at THEN 1 ELSE 0 END AS BIGINT) AS CarrierBeforeApprovalFlag,
        CAST(CASE WHEN order_delivered_customer_date < order_delivered_carrier_date THEN 1 ELSE 0 END AS BIGINT) AS DeliveredBeforeCarrierFlag FROM stg_orders""",
    "fct_04_delivered_late": """SELECT order_id, CAST(CASE WHEN order_delivered_customer_date IS NULL THEN NULL
        WHEN CAST(order_delivered_customer_date AS DATE) > order_estimated_delivery_date THEN 1 ELSE 0 END AS BIGINT) AS DeliveredLateFlag FROM stg_orders""",
    "fct_05_fact_order_item": f"""SELECT OrderID, CAST(OrderItemID AS BIGINT) AS OrderItemID, ProductKey, SellerKey, CustomerKey, CustomerGeographyKey, PurchaseDateKey, ShippingLimitDateKey, OrderStatus,
        {moment('ShippingLimitTimestamp')} AS ShippingLimitTimestamp, CAST(PriceAmount AS DOUBLE) AS PriceAmount, CAST(FreightAmount AS DOUBLE) AS FreightAmount, {_b('OrderItemCount')} FROM fact_item""",
    "fct_06_payment_sequence_flag": "SELECT OrderID AS order_id, CAST(PaymentSequential AS BIGINT) AS payment_sequential, CAST(PaymentSequenceAnomalyFlag AS BIGINT) AS PaymentSequenceAnomalyFlag FROM fact_payment",
    "fct_07_payment_flags": f"SELECT OrderID AS order_id, CAST(PaymentSequential AS BIGINT) AS payment_sequential, {_b('UndefinedPaymentTypeFlag', 'ZeroInstallmentFlag', 'ZeroPaymentValueFlag')} FROM fact_payment",
    "fct_08_fact_payment": f"""SELECT OrderID, CAST(PaymentSequential AS BIGINT) AS PaymentSequential, CustomerKey, CustomerGeographyKey, PurchaseDateKey, OrderStatus, PaymentType,
        CAST(PaymentInstallments AS BIGINT) AS PaymentInstallments, CAST(PaymentAmount AS DOUBLE) AS PaymentAmount,
        {_b('PaymentCount', 'PaymentSequenceAnomalyFlag', 'UndefinedPaymentTypeFlag', 'ZeroInstallmentFlag', 'ZeroPaymentValueFlag')} FROM fact_payment""",
    "fct_09_duplicate_review_flag": "SELECT ReviewID AS review_id, OrderID AS order_id, CAST(DuplicateReviewIDFlag AS BIGINT) AS DuplicateReviewIDFlag FROM fact_review",
    "fct_10_review_flags": f"SELECT ReviewID AS review_id, OrderID AS order_id, {_b('ReviewCreatedBeforePurchaseFlag', 'ReviewCreatedBeforeDeliveryFlag', 'ReviewAnsweredBeforePurchaseFlag', 'ReviewAnsweredBeforeDeliveryFlag', 'ReviewAnsweredBeforeCreationFlag')} FROM fact_review",
    "fct_11_fact_review": f"""SELECT ReviewID, OrderID, CustomerKey, CustomerGeographyKey, PurchaseDateKey, ReviewCreationDateKey, ReviewAnswerDateKey, OrderStatus, CAST(ReviewScore AS BIGINT) AS ReviewScore,
        ReviewCommentTitle, ReviewCommentMessage, {moment('ReviewCreationTimestamp')} AS ReviewCreationTimestamp, {moment('ReviewAnswerTimestamp')} AS ReviewAnswerTimestamp,
        {_b('ReviewCount', 'DuplicateReviewIDFlag', 'ReviewCreatedBeforePurchaseFlag', 'ReviewCreatedBeforeDeliveryFlag', 'ReviewAnsweredBeforePurchaseFlag', 'ReviewAnsweredBeforeDeliveryFlag', 'ReviewAnsweredBeforeCreationFlag')} FROM fact_review""",
}
