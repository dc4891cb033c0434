"""The rows every load should have written, derived a second time.

The loads are DataFrame code; the expectations are Spark SQL text over the
sources and the loaded dimensions, so that one mistake is not made twice.
Lookups are LEFT joins here: a key that does not resolve shows as NULL.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from stallkeep.functions.text import ACCENTED, COMBINING, IGNORED_IN_CITY, PLAIN

Tables = Mapping[str, DataFrame]


def _sql(tables: Tables, text: str, *names: str) -> DataFrame:
    frames = {n: tables[n] for n in names}
    spark = next(iter(frames.values())).sparkSession
    return spark.sql(text, **frames)


def _city(column: str) -> str:
    ignored = (ACCENTED + IGNORED_IN_CITY + COMBINING).replace("'", "\\'")
    return f"translate(lower(trim({column})), '{ignored}', '{PLAIN}')"


def _folded(column: str) -> str:
    return f"translate(lower(rtrim({column})), '{ACCENTED + COMBINING}', '{PLAIN}')"


def _day_key(column: str) -> str:
    return f"int(date_format({column}, 'yyyyMMdd'))"


def dim_geography(tables: Tables) -> DataFrame:
    return _sql(
        tables,
        """
        SELECT ZipCodePrefix, CityName, StateCode, RepresentativeLatitude, RepresentativeLongitude,
               int(RepresentativeLatitude IS NOT NULL AND RepresentativeLongitude IS NOT NULL) AS HasCoordinates,
               MissingFromGeolocationFlag, StateConflictFlag, StateAmbiguousFlag, StateResolvedByReferenceFlag,
               CityAmbiguousFlag, CityResolvedByReferenceFlag, ReferenceFallbackFlag
        FROM {Geography}
        """,
        "Geography",
    )


def dim_customer(tables: Tables) -> DataFrame:
    return _sql(
        tables,
        """
        SELECT c.CustomerUniqueID, c.RepresentativeCustomerID, g.GeographyKey AS RepresentativeGeographyKey,
               c.FirstPurchaseTimestamp, c.LatestPurchaseTimestamp, c.OrderCount, c.CustomerIDCount,
               int(c.CustomerIDCount > 1) AS ReturningCustomerFlag, int(c.DistinctZIPCount > 1) AS MultipleZIPFlag,
               int(c.DistinctCityCount > 1) AS MultipleCityFlag, int(c.DistinctStateCount > 1) AS MultipleStateFlag,
               c.LatestTimestampTieFlag
        FROM {Customer} c
        LEFT JOIN (SELECT ZipCodePrefix, GeographyKey FROM {DimGeography} WHERE GeographyKey > 0) g USING (ZipCodePrefix)
        """,
        "Customer",
        "DimGeography",
    )


def dim_seller(tables: Tables) -> DataFrame:
    return _sql(
        tables,
        f"""
        SELECT s.seller_id AS SellerID, d.GeographyKey, s.seller_zip_code_prefix AS SourceZipCodePrefix,
               s.seller_city AS SourceCityName, s.seller_state AS SourceStateCode,
               int(NOT coalesce({_city('s.seller_city')} = {_city('g.CityName')},
                                s.seller_city IS NULL AND g.CityName IS NOT NULL)) AS CityMismatchFlag,
               int(g.ZipCodePrefix IS NULL
                   OR coalesce({_folded('s.seller_state')} <> {_folded('g.StateCode')}, false)) AS StateMismatchFlag
        FROM {{sellers}} s
        LEFT JOIN {{Geography}} g ON g.ZipCodePrefix = s.seller_zip_code_prefix
        LEFT JOIN {{DimGeography}} d ON d.ZipCodePrefix = s.seller_zip_code_prefix
        """,
        "sellers",
        "Geography",
        "DimGeography",
    )


def dim_category(tables: Tables) -> DataFrame:
    return _sql(
        tables,
        """
        SELECT c.SourceCategoryName, c.EnglishCategoryName, l.PersianCategoryName, c.MissingEnglishTranslationFlag,
               int(nullif(trim(l.PersianCategoryName), '') IS NULL) AS MissingPersianLocalizationFlag
        FROM {ProductCategory} c LEFT JOIN {localization} l USING (SourceCategoryName)
        """,
        "ProductCategory",
        "localization",
    )


def conformed_category(tables: Tables) -> DataFrame:
    return _sql(
        tables,
        """
        SELECT p.product_category_name AS SourceCategoryName, any_value(t.product_category_name_english) AS EnglishCategoryName,
               int(count(t.product_category_name_english) = 0) AS MissingEnglishTranslationFlag
        FROM {products} p LEFT JOIN {category_translation} t USING (product_category_name)
        WHERE p.product_category_name IS NOT NULL
        GROUP BY p.product_category_name
        """,
        "products",
        "category_translation",
    )


def dim_product(tables: Tables) -> DataFrame:
    return _sql(
        tables,
        """
        SELECT p.product_id AS ProductID,
               if(p.product_category_name IS NULL, 0, c.ProductCategoryKey) AS ProductCategoryKey,
               p.product_name_lenght AS ProductNameLength, p.product_description_lenght AS ProductDescriptionLength,
               p.product_photos_qty AS ProductPhotosQty, p.product_weight_g AS ProductWeightG,
               p.product_length_cm AS ProductLengthCm, p.product_height_cm AS ProductHeightCm, p.product_width_cm AS ProductWidthCm,
               int(p.product_category_name IS NULL) AS MissingSourceCategoryFlag,
               int(p.product_name_lenght + p.product_description_lenght + p.product_photos_qty IS NULL) AS MissingDescriptiveAttributesFlag,
               int(p.product_weight_g + p.product_length_cm + p.product_height_cm + p.product_width_cm IS NULL) AS MissingPhysicalAttributesFlag,
               int(p.product_weight_g <=> 0) AS ZeroWeightFlag
        FROM {products} p
        LEFT JOIN {DimProductCategory} c ON c.SourceCategoryName = p.product_category_name AND c.ProductCategoryKey > 0
        """,
        "products",
        "DimProductCategory",
    )


def fact_order(tables: Tables) -> DataFrame:
    return _sql(
        tables,
        f"""
        SELECT o.order_id AS OrderID, dc.CustomerKey, dg.GeographyKey AS CustomerGeographyKey,
               {_day_key('o.order_purchase_timestamp')} AS PurchaseDateKey,
               ifnull({_day_key('o.order_approved_at')}, 0) AS ApprovedDateKey,
               ifnull({_day_key('o.order_delivered_carrier_date')}, 0) AS CarrierDateKey,
               ifnull({_day_key('o.order_delivered_customer_date')}, 0) AS DeliveredDateKey,
               ifnull({_day_key('o.order_estimated_delivery_date')}, 0) AS EstimatedDeliveryDateKey,
               o.order_status AS OrderStatus, o.order_purchase_timestamp AS PurchaseTimestamp,
               o.order_approved_at AS ApprovedTimestamp, o.order_delivered_carrier_date AS DeliveredCarrierTimestamp,
               o.order_delivered_customer_date AS DeliveredCustomerTimestamp,
               o.order_estimated_delivery_date AS EstimatedDeliveryDate, 1 AS OrderCount,
               ifnull(int(o.order_purchase_timestamp > o.order_delivered_carrier_date), 0) AS CarrierBeforePurchaseFlag,
               ifnull(int(o.order_approved_at > o.order_delivered_carrier_date), 0) AS CarrierBeforeApprovalFlag,
               ifnull(int(o.order_delivered_carrier_date > o.order_delivered_customer_date), 0) AS DeliveredBeforeCarrierFlag,
               nvl2(o.order_delivered_customer_date,
                    ifnull(int(datediff(o.order_delivered_customer_date, o.order_estimated_delivery_date) > 0), 0), NULL) AS DeliveredLateFlag
        FROM {{orders}} o JOIN {{customers}} c USING (customer_id)
        LEFT JOIN {{DimCustomer}} dc ON dc.CustomerUniqueID = c.customer_unique_id
        LEFT JOIN {{DimGeography}} dg ON dg.ZipCodePrefix = c.customer_zip_code_prefix
        """,
        "orders",
        "customers",
        "DimCustomer",
        "DimGeography",
    )


# The child facts resolve customer and geography again, from the order's own customer.
_ORDER_KEYS = """
    SELECT o.order_id, o.order_status, o.order_purchase_timestamp, o.order_delivered_customer_date,
           dc.CustomerKey, dg.GeographyKey
    FROM {orders} o JOIN {customers} c USING (customer_id)
    LEFT JOIN {DimCustomer} dc ON dc.CustomerUniqueID = c.customer_unique_id
    LEFT JOIN {DimGeography} dg ON dg.ZipCodePrefix = c.customer_zip_code_prefix
"""
_ORDER_TABLES = ("orders", "customers", "DimCustomer", "DimGeography")
PLACED = "PlacedOrders"


def placed_orders(tables: Tables) -> DataFrame:
    """What the child facts take from their orders; a caller that derives several may keep it under ``PLACED``."""
    return _sql(tables, _ORDER_KEYS, *_ORDER_TABLES)


def _placed(tables: Tables) -> tuple[str, tuple[str, ...]]:
    return (f"SELECT * FROM {{{PLACED}}}", (PLACED,)) if PLACED in tables else (_ORDER_KEYS, _ORDER_TABLES)


def fact_order_item(tables: Tables) -> DataFrame:
    order_keys, order_tables = _placed(tables)
    return _sql(
        tables,
        f"""
        WITH placed AS ({order_keys})
        SELECT i.order_id AS OrderID, i.order_item_id AS OrderItemID, p.ProductKey, s.SellerKey, placed.CustomerKey,
               placed.GeographyKey AS CustomerGeographyKey,
               {_day_key('placed.order_purchase_timestamp')} AS PurchaseDateKey,
               {_day_key('i.shipping_limit_date')} AS ShippingLimitDateKey, placed.order_status AS OrderStatus,
               i.shipping_limit_date AS ShippingLimitTimestamp, i.price AS PriceAmount, i.freight_value AS FreightAmount,
               1 AS OrderItemCount
        FROM {{order_items}} i JOIN placed USING (order_id)
        LEFT JOIN {{DimProduct}} p ON p.ProductID = i.product_id
        LEFT JOIN {{DimSeller}} s ON s.SellerID = i.seller_id
        """,
        "order_items",
        "DimProduct",
        "DimSeller",
        *order_tables,
    )


def fact_payment(tables: Tables) -> DataFrame:
    order_keys, order_tables = _placed(tables)
    return _sql(
        tables,
        f"""
        WITH placed AS ({order_keys}),
        runs AS (
            SELECT order_id, NOT (min(payment_sequential) = 1 AND max(payment_sequential) = count(1)) AS broken
            FROM {{payments}} GROUP BY order_id
        )
        SELECT p.order_id AS OrderID, p.payment_sequential AS PaymentSequential, placed.CustomerKey,
               placed.GeographyKey AS CustomerGeographyKey,
               {_day_key('placed.order_purchase_timestamp')} AS PurchaseDateKey, placed.order_status AS OrderStatus,
               p.payment_type AS PaymentType, p.payment_installments AS PaymentInstallments,
               p.payment_value AS PaymentAmount, 1 AS PaymentCount, int(runs.broken) AS PaymentSequenceAnomalyFlag,
               int(p.payment_type <=> 'not_defined') AS UndefinedPaymentTypeFlag,
               int(p.payment_installments <=> 0) AS ZeroInstallmentFlag, int(p.payment_value <=> 0) AS ZeroPaymentValueFlag
        FROM {{payments}} p JOIN placed USING (order_id) JOIN runs USING (order_id)
        """,
        "payments",
        *order_tables,
    )


def fact_review(tables: Tables) -> DataFrame:
    order_keys, order_tables = _placed(tables)
    return _sql(
        tables,
        f"""
        WITH placed AS ({order_keys}),
        ids AS (SELECT review_id, count(1) > 1 AS repeated FROM {{reviews}} GROUP BY review_id)
        SELECT r.review_id AS ReviewID, r.order_id AS OrderID, placed.CustomerKey, placed.GeographyKey AS CustomerGeographyKey,
               {_day_key('placed.order_purchase_timestamp')} AS PurchaseDateKey,
               {_day_key('r.review_creation_date')} AS ReviewCreationDateKey,
               {_day_key('r.review_answer_timestamp')} AS ReviewAnswerDateKey, placed.order_status AS OrderStatus,
               r.review_score AS ReviewScore, r.review_comment_title AS ReviewCommentTitle,
               r.review_comment_message AS ReviewCommentMessage, r.review_creation_date AS ReviewCreationTimestamp,
               r.review_answer_timestamp AS ReviewAnswerTimestamp, 1 AS ReviewCount,
               int(ids.repeated) AS DuplicateReviewIDFlag,
               int(datediff(placed.order_purchase_timestamp, r.review_creation_date) > 0) AS ReviewCreatedBeforePurchaseFlag,
               int(datediff(placed.order_delivered_customer_date, r.review_creation_date) > 0) AS ReviewCreatedBeforeDeliveryFlag,
               int(placed.order_purchase_timestamp > r.review_answer_timestamp) AS ReviewAnsweredBeforePurchaseFlag,
               int(placed.order_delivered_customer_date > r.review_answer_timestamp) AS ReviewAnsweredBeforeDeliveryFlag,
               int(r.review_creation_date > r.review_answer_timestamp) AS ReviewAnsweredBeforeCreationFlag
        FROM {{reviews}} r JOIN placed USING (order_id) JOIN ids USING (review_id)
        """,
        "reviews",
        *order_tables,
    )
