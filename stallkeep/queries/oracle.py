"""SQL counterparts: named building blocks and a helper that strings them together."""

from __future__ import annotations

import re

from stallkeep.functions.text import ACCENTED, COMBINING, IGNORED_IN_CITY, PLAIN
from stallkeep.queries import roles

BLOCKS: dict[str, str] = {
    "stg_lines": roles.SQL_LINES,
    "stg_orders": roles.SQL_ORDERS,
    "stg_items": roles.SQL_ITEMS,
    "stg_payments": roles.SQL_PAYMENTS,
    "stg_reviews": roles.SQL_REVIEWS,
    "stg_customers": roles.SQL_CUSTOMERS,
    "stg_sellers": roles.SQL_SELLERS,
    "stg_geolocation": roles.SQL_GEOLOCATION,
    "stg_products": roles.SQL_PRODUCTS,
    "stg_translation": roles.SQL_TRANSLATION,
    "stg_localization": roles.SQL_LOCALIZATION,
}


def city_key_sql(column: str) -> str:
    ignored = (ACCENTED + IGNORED_IN_CITY + COMBINING).replace("'", "''")
    return f"translate(lower(trim({column})), '{ignored}', '{PLAIN}')"


def with_blocks(body: str) -> str:
    """Prefix ``body`` with the blocks it names, directly or through other blocks, in order of definition."""
    needed: set[str] = set()
    pending = [body]
    while pending:
        text = pending.pop()
        for name in BLOCKS:
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                pending.append(BLOCKS[name])
    if not needed:
        return body
    ordered = [n for n in BLOCKS if n in needed]
    return "WITH " + ",\n".join(f"{n} AS ({BLOCKS[n].strip()})" for n in ordered) + "\n" + body.strip()


def round_half_up(total: str, count: str, scale: int = 2) -> str:
    """total / count for an exact decimal total with two digits, rounded half away from zero, as a double."""
    cents = f"CAST(abs({total}) * 100 AS HUGEINT)"
    return f"CASE WHEN {count} > 0 THEN sign({total}) * CAST((2 * {cents} + {count}) // (2 * {count}) AS DOUBLE) / {10 ** scale} END"


def day(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d')"


def moment(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S')"


def day_key(column: str) -> str:
    return f"CAST(strftime({column}, '%Y%m%d') AS BIGINT)"


def jalali_sql(date: str) -> dict[str, str]:
    """Year, month and day of the Jalali calendar as SQL over a date."""
    n = f"(CAST({date} AS DATE) - DATE '1600-03-20')"
    c, g = f"({n} % 12053)", f"({n} % 12053 % 1461)"
    doy = f"(CASE WHEN {g} >= 366 THEN ({g} - 1) % 365 ELSE {g} END)"
    return {
        "year": f"(979 + 33 * ({n} // 12053) + 4 * ({c} // 1461) + CASE WHEN {g} >= 366 THEN ({g} - 1) // 365 ELSE 0 END)",
        "month": f"(CASE WHEN {doy} < 186 THEN {doy} // 31 + 1 ELSE ({doy} - 186) // 30 + 7 END)",
        "day": f"(CASE WHEN {doy} < 186 THEN {doy} % 31 + 1 ELSE ({doy} - 186) % 30 + 1 END)",
    }


def _pad(n: str, width: int) -> str:
    return f"lpad(CAST({n} AS VARCHAR), {width}, '0')"


def jalali_text(date: str) -> str:
    p = jalali_sql(date)
    return f"{_pad(p['year'], 4)} || '/' || {_pad(p['month'], 2)} || '/' || {_pad(p['day'], 2)}"


_RESOLVE = """
SELECT zip, CASE WHEN sum(CASE WHEN rr = 1 THEN 1 ELSE 0 END) = 1 THEN max(CASE WHEN rr = 1 THEN val END) END AS winner,
       count(*) AS candidates,
       CAST(count(*) > 1 AS BIGINT) AS conflict,
       CAST(sum(CASE WHEN rr = 1 THEN 1 ELSE 0 END) > 1 AS BIGINT) AS ambiguous,
       CAST(sum(CASE WHEN vr = 1 THEN 1 ELSE 0 END) > 1 AND sum(CASE WHEN rr = 1 THEN 1 ELSE 0 END) = 1
            AND max(CASE WHEN rr = 1 THEN support ELSE 0 END) > 0 AS BIGINT) AS resolved
FROM {ranked} GROUP BY zip
"""

BLOCKS.update(
    {
        "geo_obs": f"""
SELECT geolocation_zip_code_prefix AS zip, geolocation_state AS state, geolocation_city AS city,
       {city_key_sql('geolocation_city')} AS city_key, geolocation_lat AS lat, geolocation_lng AS lng FROM stg_geolocation""",
        "geo_ref": f"""
SELECT zip, state, city, {city_key_sql('city')} AS city_key FROM (
  SELECT customer_zip_code_prefix AS zip, customer_state AS state, customer_city AS city FROM stg_customers
  UNION ALL SELECT seller_zip_code_prefix, seller_state, seller_city FROM stg_sellers)""",
        "geo_state_support": "SELECT zip, state, count(*) AS support FROM geo_ref GROUP BY 1, 2",
        "geo_city_support": "SELECT zip, state, city_key, count(*) AS support FROM geo_ref GROUP BY 1, 2, 3",
        "geo_universe": "SELECT zip FROM geo_obs UNION SELECT zip FROM geo_ref",
        "geo_stats": "SELECT zip, count(*) AS n, count(DISTINCT state) AS states, count(DISTINCT city) AS cities FROM geo_obs GROUP BY 1",
        "geo_state_cand": """
SELECT o.zip, o.state AS val, count(*) AS votes, coalesce(max(s.support), 0) AS support
FROM geo_obs o LEFT JOIN geo_state_support s ON s.zip = o.zip AND s.state = o.state GROUP BY 1, 2""",
        "geo_state_ranked": """
SELECT *, dense_rank() OVER (PARTITION BY zip ORDER BY votes DESC, support DESC) AS rr,
       dense_rank() OVER (PARTITION BY zip ORDER BY votes DESC) AS vr FROM geo_state_cand""",
        "geo_state": _RESOLVE.format(ranked="geo_state_ranked"),
        "geo_city_cand": """
SELECT o.zip, o.state, o.city_key AS val, count(*) AS votes FROM geo_obs o
JOIN geo_state s ON s.zip = o.zip AND s.winner = o.state GROUP BY 1, 2, 3""",
        "geo_city_sup": """
SELECT c.zip, c.val, c.votes, coalesce(s.support, 0) AS support FROM geo_city_cand c
LEFT JOIN geo_city_support s ON s.zip = c.zip AND s.state = c.state AND s.city_key = c.val""",
        "geo_city_ranked": """
SELECT *, dense_rank() OVER (PARTITION BY zip ORDER BY votes DESC, support DESC) AS rr,
       dense_rank() OVER (PARTITION BY zip ORDER BY votes DESC) AS vr FROM geo_city_sup""",
        "geo_city": _RESOLVE.format(ranked="geo_city_ranked"),
        "geo_label": """
SELECT zip, city_key, city FROM (
  SELECT o.zip, o.city_key, o.city, row_number() OVER (PARTITION BY o.zip, o.city_key ORDER BY count(*) DESC, o.city) AS rn
  FROM geo_obs o JOIN geo_state s ON s.zip = o.zip AND s.winner = o.state GROUP BY 1, 2, 3) WHERE rn = 1""",
        "geo_fallback": """
SELECT zip, min(state) AS state, min(city) AS city, count(DISTINCT state) AS states, count(DISTINCT city) AS cities FROM geo_ref GROUP BY 1""",
        "geo_coord": """
SELECT zip, quantile_cont(lat, 0.5) AS lat, quantile_cont(lng, 0.5) AS lng FROM (
  SELECT DISTINCT o.zip, o.lat, o.lng FROM geo_obs o JOIN geo_state s ON s.zip = o.zip AND s.winner = o.state) GROUP BY 1""",
        "conf_geography": """
SELECT u.zip AS ZipCodePrefix, CASE WHEN g.zip IS NULL THEN f.city ELSE l.city END AS CityName,
       CASE WHEN g.zip IS NULL THEN f.state ELSE s.winner END AS StateCode, m.lat AS lat, m.lng AS lng,
       coalesce(g.n, 0) AS GeolocationSourceRowCount, coalesce(g.states, 0) AS GeolocationDistinctStateCount,
       coalesce(g.cities, 0) AS GeolocationDistinctCityLabelCount, CAST(g.zip IS NULL AS BIGINT) AS MissingFromGeolocationFlag,
       coalesce(s.conflict, 0) AS StateConflictFlag, coalesce(s.ambiguous, 0) AS StateAmbiguousFlag,
       coalesce(s.resolved, 0) AS StateResolvedByReferenceFlag, coalesce(c.ambiguous, 0) AS CityAmbiguousFlag,
       coalesce(c.resolved, 0) AS CityResolvedByReferenceFlag, CAST(g.zip IS NULL AND f.zip IS NOT NULL AS BIGINT) AS ReferenceFallbackFlag
FROM geo_universe u LEFT JOIN geo_stats g ON g.zip = u.zip LEFT JOIN geo_state s ON s.zip = u.zip
LEFT JOIN geo_city c ON c.zip = u.zip LEFT JOIN geo_label l ON l.zip = u.zip AND l.city_key = c.winner
LEFT JOIN geo_fallback f ON f.zip = u.zip LEFT JOIN geo_coord m ON m.zip = u.zip""",
        "cust_orders": """
SELECT c.customer_unique_id AS uid, c.customer_id, c.customer_zip_code_prefix AS zip, c.customer_city AS city, c.customer_state AS state,
       o.order_id, o.order_purchase_timestamp AS ts FROM stg_customers c JOIN stg_orders o ON o.customer_id = c.customer_id""",
        "conf_customer": """
SELECT s.uid AS CustomerUniqueID, r.customer_id AS RepresentativeCustomerID, r.zip AS ZipCodePrefix, r.city AS CityName, r.state AS StateCode,
       s.first_ts, s.last_ts, s.OrderCount, s.CustomerIDCount, s.DistinctZIPCount, s.DistinctCityCount, s.DistinctStateCount,
       CAST(t.n > 1 AS BIGINT) AS LatestTimestampTieFlag
FROM (SELECT uid, min(ts) AS first_ts, max(ts) AS last_ts, count(DISTINCT order_id) AS OrderCount, count(DISTINCT customer_id) AS CustomerIDCount,
             count(DISTINCT zip) AS DistinctZIPCount, count(DISTINCT city) AS DistinctCityCount, count(DISTINCT state) AS DistinctStateCount
      FROM cust_orders GROUP BY 1) s
JOIN (SELECT *, row_number() OVER (PARTITION BY uid ORDER BY ts DESC, order_id DESC, customer_id DESC) AS rn FROM cust_orders) r ON r.uid = s.uid AND r.rn = 1
JOIN (SELECT uid, ts, count(*) AS n FROM cust_orders GROUP BY 1, 2) t ON t.uid = s.uid AND t.ts = s.last_ts""",
        "conf_category": """
SELECT p.label AS SourceCategoryName, t.product_category_name_english AS EnglishCategoryName,
       CAST(t.product_category_name_english IS NULL AS BIGINT) AS MissingEnglishTranslationFlag
FROM (SELECT DISTINCT product_category_name AS label FROM stg_products WHERE product_category_name IS NOT NULL) p
LEFT JOIN stg_translation t ON t.product_category_name = p.label""",
        "source_days": """
SELECT DISTINCT CAST(d AS DATE) AS d FROM (
  SELECT order_purchase_timestamp AS d FROM stg_orders UNION ALL SELECT order_approved_at FROM stg_orders
  UNION ALL SELECT order_delivered_carrier_date FROM stg_orders UNION ALL SELECT order_delivered_customer_date FROM stg_orders
  UNION ALL SELECT CAST(order_estimated_delivery_date AS TIMESTAMP) FROM stg_orders UNION ALL SELECT shipping_limit_date FROM stg_items
  UNION ALL SELECT review_creation_date FROM stg_reviews UNION ALL SELECT review_answer_timestamp FROM stg_reviews) WHERE d IS NOT NULL""",
        "calendar": """
SELECT CAST(unnest(generate_series(make_date(year(min(d)), 1, 1), make_date(year(max(d)), 12, 31), INTERVAL 1 DAY)) AS DATE) AS d FROM source_days""",
        "dim_geography": """
SELECT row_number() OVER (ORDER BY ZipCodePrefix) AS GeographyKey, ZipCodePrefix, CityName, StateCode, lat, lng,
       CAST(lat IS NOT NULL AND lng IS NOT NULL AS BIGINT) AS HasCoordinates, MissingFromGeolocationFlag, StateConflictFlag, StateAmbiguousFlag,
       StateResolvedByReferenceFlag, CityAmbiguousFlag, CityResolvedByReferenceFlag, ReferenceFallbackFlag FROM conf_geography""",
        "dim_customer": """
SELECT row_number() OVER (ORDER BY c.CustomerUniqueID) AS CustomerKey, c.CustomerUniqueID, c.RepresentativeCustomerID,
       g.GeographyKey AS RepresentativeGeographyKey, c.first_ts, c.last_ts, c.OrderCount, c.CustomerIDCount,
       CAST(c.CustomerIDCount > 1 AS BIGINT) AS ReturningCustomerFlag, CAST(c.DistinctZIPCount > 1 AS BIGINT) AS MultipleZIPFlag,
       CAST(c.DistinctCityCount > 1 AS BIGINT) AS MultipleCityFlag, CAST(c.DistinctStateCount > 1 AS BIGINT) AS MultipleStateFlag,
       c.LatestTimestampTieFlag FROM conf_customer c JOIN dim_geography g ON g.ZipCodePrefix = c.ZipCodePrefix""",
        "dim_seller": f"""
SELECT row_number() OVER (ORDER BY s.seller_id) AS SellerKey, s.seller_id AS SellerID, g.GeographyKey, s.seller_zip_code_prefix AS SourceZipCodePrefix,
       s.seller_city AS SourceCityName, s.seller_state AS SourceStateCode,
       CASE WHEN g.ZipCodePrefix IS NULL OR g.CityName IS NULL THEN 1
            WHEN {city_key_sql('s.seller_city')} <> {city_key_sql('g.CityName')} THEN 1 ELSE 0 END AS CityMismatchFlag,
       CASE WHEN g.ZipCodePrefix IS NULL THEN 1 WHEN lower(s.seller_state) <> lower(g.StateCode) THEN 1 ELSE 0 END AS StateMismatchFlag
FROM stg_sellers s LEFT JOIN dim_geography g ON g.ZipCodePrefix = s.seller_zip_code_prefix""",
        "dim_category": """
SELECT row_number() OVER (ORDER BY c.SourceCategoryName) AS ProductCategoryKey, c.SourceCategoryName, c.EnglishCategoryName, l.PersianCategoryName,
       c.MissingEnglishTranslationFlag, CAST(l.PersianCategoryName IS NULL OR trim(l.PersianCategoryName) = '' AS BIGINT) AS MissingPersianLocalizationFlag
FROM conf_category c LEFT JOIN stg_localization l ON l.SourceCategoryName = c.SourceCategoryName""",
        "dim_product": """
SELECT row_number() OVER (ORDER BY p.product_id) AS ProductKey, p.product_id AS ProductID, coalesce(c.ProductCategoryKey, 0) AS ProductCategoryKey,
       p.product_name_lenght AS ProductNameLength, p.product_description_lenght AS ProductDescriptionLength, p.product_photos_qty AS ProductPhotosQty,
       p.product_weight_g AS ProductWeightG, p.product_length_cm AS ProductLengthCm, p.product_height_cm AS ProductHeightCm, p.product_width_cm AS ProductWidthCm,
       CAST(p.product_category_name IS NULL AS BIGINT) AS MissingSourceCategoryFlag,
       CAST(p.product_name_lenght IS NULL OR p.product_description_lenght IS NULL OR p.product_photos_qty IS NULL AS BIGINT) AS MissingDescriptiveAttributesFlag,
       CAST(p.product_weight_g IS NULL OR p.product_length_cm IS NULL OR p.product_height_cm IS NULL OR p.product_width_cm IS NULL AS BIGINT) AS MissingPhysicalAttributesFlag,
       CASE WHEN p.product_weight_g = 0 THEN 1 ELSE 0 END AS ZeroWeightFlag
FROM stg_products p LEFT JOIN dim_category c ON c.SourceCategoryName = p.product_category_name""",
        "placed": f"""
SELECT o.*, dc.CustomerKey, dg.GeographyKey AS CustomerGeographyKey, {day_key('o.order_purchase_timestamp')} AS PurchaseDateKey
FROM stg_orders o JOIN stg_customers c ON c.customer_id = o.customer_id
JOIN dim_customer dc ON dc.CustomerUniqueID = c.customer_unique_id JOIN dim_geography dg ON dg.ZipCodePrefix = c.customer_zip_code_prefix""",
        "fact_order": f"""
SELECT order_id AS OrderID, CustomerKey, CustomerGeographyKey, PurchaseDateKey,
       coalesce({day_key('order_approved_at')}, 0) AS ApprovedDateKey, coalesce({day_key('order_delivered_carrier_date')}, 0) AS CarrierDateKey,
       coalesce({day_key('order_delivered_customer_date')}, 0) AS DeliveredDateKey, coalesce({day_key('order_estimated_delivery_date')}, 0) AS EstimatedDeliveryDateKey,
       order_status AS OrderStatus, order_purchase_timestamp AS PurchaseTimestamp, order_approved_at AS ApprovedTimestamp,
       order_delivered_carrier_date AS DeliveredCarrierTimestamp, order_delivered_customer_date AS DeliveredCustomerTimestamp,
       order_estimated_delivery_date AS EstimatedDeliveryDate, 1 AS OrderCount,
       CASE WHEN order_delivered_carrier_date < order_purchase_timestamp THEN 1 ELSE 0 END AS CarrierBeforePurchaseFlag,
       CASE WHEN order_delivered_carrier_date < order_approved_at THEN 1 ELSE 0 END AS CarrierBeforeApprovalFlag,
       CASE WHEN order_delivered_customer_date < order_delivered_carrier_date THEN 1 ELSE 0 END AS DeliveredBeforeCarrierFlag,
       CASE WHEN order_delivered_customer_date IS NULL THEN NULL
            WHEN CAST(order_delivered_customer_date AS DATE) > order_estimated_delivery_date THEN 1 ELSE 0 END AS DeliveredLateFlag FROM placed""",
        "fact_item": f"""
SELECT i.order_id AS OrderID, i.order_item_id AS OrderItemID, p.ProductKey, s.SellerKey, o.CustomerKey, o.CustomerGeographyKey, o.PurchaseDateKey,
       {day_key('i.shipping_limit_date')} AS ShippingLimitDateKey, o.order_status AS OrderStatus, i.shipping_limit_date AS ShippingLimitTimestamp,
       i.price AS PriceAmount, i.freight_value AS FreightAmount, 1 AS OrderItemCount
FROM stg_items i JOIN placed o ON o.order_id = i.order_id JOIN dim_product p ON p.ProductID = i.product_id JOIN dim_seller s ON s.SellerID = i.seller_id""",
        "fact_payment": """
SELECT p.order_id AS OrderID, p.payment_sequential AS PaymentSequential, o.CustomerKey, o.CustomerGeographyKey, o.PurchaseDateKey,
       o.order_status AS OrderStatus, p.payment_type AS PaymentType, p.payment_installments AS PaymentInstallments, p.payment_value AS PaymentAmount,
       1 AS PaymentCount, CASE WHEN p.lo <> 1 OR p.hi <> p.n THEN 1 ELSE 0 END AS PaymentSequenceAnomalyFlag,
       CASE WHEN p.payment_type = 'not_defined' THEN 1 ELSE 0 END AS UndefinedPaymentTypeFlag,
       CASE WHEN p.payment_installments = 0 THEN 1 ELSE 0 END AS ZeroInstallmentFlag, CASE WHEN p.payment_value = 0 THEN 1 ELSE 0 END AS ZeroPaymentValueFlag
FROM (SELECT *, min(payment_sequential) OVER w AS lo, max(payment_sequential) OVER w AS hi, count(*) OVER w AS n
      FROM stg_payments WINDOW w AS (PARTITION BY order_id)) p JOIN placed o ON o.order_id = p.order_id""",
        "fact_review": f"""
SELECT r.review_id AS ReviewID, r.order_id AS OrderID, o.CustomerKey, o.CustomerGeographyKey, o.PurchaseDateKey,
       {day_key('r.review_creation_date')} AS ReviewCreationDateKey, {day_key('r.review_answer_timestamp')} AS ReviewAnswerDateKey,
       o.order_status AS OrderStatus, r.review_score AS ReviewScore, r.review_comment_title AS ReviewCommentTitle, r.review_comment_message AS ReviewCommentMessage,
       r.review_creation_date AS ReviewCreationTimestamp, r.review_answer_timestamp AS ReviewAnswerTimestamp, 1 AS ReviewCount,
       CASE WHEN r.n > 1 THEN 1 ELSE 0 END AS DuplicateReviewIDFlag,
       CASE WHEN CAST(r.review_creation_date AS DATE) < CAST(o.order_purchase_timestamp AS DATE) THEN 1 ELSE 0 END AS ReviewCreatedBeforePurchaseFlag,
       CASE WHEN o.order_delivered_customer_date IS NULL THEN NULL
            WHEN CAST(r.review_creation_date AS DATE) < CAST(o.order_delivered_customer_date AS DATE) THEN 1 ELSE 0 END AS ReviewCreatedBeforeDeliveryFlag,
       CASE WHEN r.review_answer_timestamp < o.order_purchase_timestamp THEN 1 ELSE 0 END AS ReviewAnsweredBeforePurchaseFlag,
       CASE WHEN o.order_delivered_customer_date IS NULL THEN NULL
            WHEN r.review_answer_timestamp < o.order_delivered_customer_date THEN 1 ELSE 0 END AS ReviewAnsweredBeforeDeliveryFlag,
       CASE WHEN r.review_answer_timestamp < r.review_creation_date THEN 1 ELSE 0 END AS ReviewAnsweredBeforeCreationFlag
FROM (SELECT *, count(*) OVER (PARTITION BY review_id) AS n FROM stg_reviews) r JOIN placed o ON o.order_id = r.order_id""",
    }
)
