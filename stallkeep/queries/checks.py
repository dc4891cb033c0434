"""Data-quality operators and the checks of every staging table."""

from __future__ import annotations

from pyspark.sql import functions as F

from stallkeep.operators import quality as Q
from stallkeep.plans import checks as C
from stallkeep.queries.built import staging, warehouse
from stallkeep.queries.oracle import moment, round_half_up
from stallkeep.queries.roles import driver_table as raw
from stallkeep.sources import CONTRACTS


def _completeness(s, d):
    """The driver's tables against the rows their roles hold."""
    t = staging(s, d)
    pairs = (("orders", "orders"), ("customer", "customers"), ("supplier", "sellers"), ("part", "products"), ("lineitem", "order_items"))
    expected = Q.union_all(
        [t[role].agg(F.count("*").alias("ExpectedRows")).select(F.lit(name).alias("DatasetName"), "ExpectedRows") for name, role in pairs]
    )
    return Q.completeness({name: raw(s, d, name) for name, _ in pairs}, expected)


def _mismatches(s, d):
    t = staging(s, d)
    return Q.payment_mismatches(t["payments"], t["order_items"])


def _unmatched(s, d):
    t = staging(s, d)
    label = "product_category_name"
    missing = Q.unmatched_impact(t["products"], t["category_translation"], label)
    unused = Q.unused_mappings(t["products"], t["category_translation"], label)
    return missing.select(F.lit("missing").alias("Kind"), label, "Rows").unionByName(
        unused.select(F.lit("unused").alias("Kind"), label, F.lit(0).cast("long").alias("Rows"))
    )


def _multiplicity(s, d):
    lines = raw(s, d, "lineitem")
    return Q.multiplicity(lines, ["l_orderkey"])


def _over(function):
    return lambda s, d: function(staging(s, d))


QUERIES = {
    "dq_01_row_count": lambda s, d: Q.row_count(raw(s, d, "lineitem")),
    "dq_02_duplicate_groups": lambda s, d: Q.duplicate_groups(raw(s, d, "lineitem"), ["l_orderkey", "l_linenumber"]),
    "dq_03_null_audit": lambda s, d: Q.null_audit(staging(s, d)["orders"], CONTRACTS["orders"].column_names),
    "dq_04_blank_audit": lambda s, d: Q.blank_audit(staging(s, d)["reviews"], ["review_comment_title", "review_comment_message"]),
    "dq_05_orphans": lambda s, d: Q.orphan_count(raw(s, d, "documents"), raw(s, d, "labels"), "doc_id", "doc_id"),
    "dq_06_unreferenced": lambda s, d: Q.unreferenced(raw(s, d, "orders"), raw(s, d, "lineitem"), "o_orderkey", "l_orderkey").select("o_orderkey", "o_orderstatus"),
    "dq_07_negative_values": lambda s, d: Q.negative_audit(raw(s, d, "customer"), ["c_acctbal", "c_nationkey"]),
    "dq_08_zero_values": lambda s, d: Q.zero_audit(raw(s, d, "lineitem"), ["l_discount", "l_tax", "l_quantity"]),
    "dq_09_value_range": lambda s, d: Q.value_range(raw(s, d, "lineitem"), ["l_quantity", "l_extendedprice", "l_shipdate"]),
    "dq_10_out_of_bounds": lambda s, d: Q.out_of_bounds(staging(s, d)["geolocation"], {"geolocation_lat": (-29, 90), "geolocation_lng": (-180, -50)}),
    "dq_11_outside_domain": lambda s, d: Q.outside_domain(raw(s, d, "events"), "event_type", ["view", "click", "signup"]),
    "dq_12_longest_text": lambda s, d: Q.longest_text(raw(s, d, "documents"), ["text", "lang", "source"]),
    "dq_12_length_distribution": lambda s, d: Q.length_distribution(raw(s, d, "conversations"), "text"),
    "dq_12_length_violations": lambda s, d: Q.length_violations(raw(s, d, "documents"), "lang", 2),
    "dq_13_non_numeric": lambda s, d: Q.non_numeric(raw(s, d, "pages"), "url"),
    "dq_14_distribution": lambda s, d: Q.distribution(staging(s, d)["products"], ["product_category_name", "product_photos_qty"]),
    "dq_15_distinct_values": lambda s, d: Q.distinct_values(raw(s, d, "lineitem"), ["l_orderkey", "l_partkey", "l_suppkey"]),
    "dq_16_multiplicity": _multiplicity,
    "dq_16_size_histogram": lambda s, d: Q.size_histogram(raw(s, d, "lineitem"), ["l_orderkey"]),
    "dq_17_exact_duplicates": lambda s, d: Q.exact_duplicates(staging(s, d)["geolocation"]),
    "dq_18_values_per_key": lambda s, d: Q.values_per_key(staging(s, d)["geolocation"], ["geolocation_zip_code_prefix"], "geolocation_state").limit(100),
    "dq_19_coverage_percent": lambda s, d: Q.coverage_percent(raw(s, d, "documents"), raw(s, d, "labels"), "doc_id"),
    "dq_20_unmatched_labels": _unmatched,
    "dq_21_sequence_anomalies": lambda s, d: Q.sequence_anomalies(staging(s, d)["payments"], ["order_id"], "payment_sequential"),
    "dq_21_item_sequence_anomalies": lambda s, d: Q.sequence_anomalies(staging(s, d)["order_items"], ["order_id"], "order_item_id"),
    "dq_22_temporal_violations": lambda s, d: Q.violations_across(
        staging(s, d)["reviews"], staging(s, d)["orders"], ["order_id"], {"ReviewBeforePurchaseRows": F.col("review_creation_date") < F.col("order_purchase_timestamp")}
    ),
    "dq_23_mismatch_count": lambda s, d: _mismatches(s, d).agg(F.count("*").alias("MismatchOrders")),
    "dq_24_mismatch_summary": lambda s, d: Q.mismatch_summary(_mismatches(s, d)),
    "dq_25_mismatch_by_status": lambda s, d: Q.mismatch_by_status(_mismatches(s, d), staging(s, d)["orders"]),
    "dq_26_mismatch_by_installments": lambda s, d: Q.mismatch_by_installments(_mismatches(s, d)),
    "dq_27_mismatch_detail": lambda s, d: Q.mismatch_detail(_mismatches(s, d), staging(s, d)["orders"]),
    "dq_28_top_groups": lambda s, d: Q.top_groups(
        raw(s, d, "lineitem"), ["l_orderkey"], {"Lines": F.count("*"), "Quantity": F.sum("l_quantity")}, "Quantity", 20
    ),
    "dq_29_group_size_summary": lambda s, d: Q.group_size_summary(raw(s, d, "orders"), raw(s, d, "lineitem"), "o_orderkey", "l_orderkey"),
    "dq_30_childless_parents": _over(C.orders_without_payments),
    "dq_31_text_coverage": lambda s, d: Q.text_coverage(staging(s, d)["reviews"], "review_comment_title", "review_comment_message"),
    "dq_32_completeness": _completeness,
    "dq_32_overall_status": lambda s, d: Q.overall_status(_completeness(s, d)),
    "dq_33_known_issues": _over(C.zero_weight_products),
    "dq_34_counts_by_parent_attribute": lambda s, d: Q.counts_by_parent_attribute(staging(s, d)["reviews"], staging(s, d)["orders"], "order_id", "order_status"),
    "dq_35_score_summary": lambda s, d: Q.score_summary(staging(s, d)["reviews"], "review_score"),
    **{f"chk_{name}_metrics": _over(plan) for name, plan in C.METRICS.items() if name != "Geography"},
    "chk_conformed_geography_metrics": lambda s, d: C.geography_metrics(warehouse(s, d)),
    "chk_conformed_geography_invalid_states": lambda s, d: C.invalid_geography_states(warehouse(s, d)),
    "chk_products_by_category": lambda s, d: Q.distribution(staging(s, d)["products"], ["product_category_name"], "Products"),
    "chk_orders_status": lambda s, d: Q.distribution(staging(s, d)["orders"], ["order_status"], "Orders"),
    "chk_translation_mapping": lambda s, d: staging(s, d)["category_translation"].orderBy("product_category_name"),
    "chk_translation_duplicate_english": lambda s, d: Q.duplicate_groups(staging(s, d)["category_translation"], ["product_category_name_english"]),
    "chk_customers_repeated_identities": _over(C.repeated_identities),
    "chk_customers_zip_lengths": lambda s, d: Q.length_distribution(staging(s, d)["customers"], "customer_zip_code_prefix"),
    "chk_customers_by_state": lambda s, d: Q.distribution(staging(s, d)["customers"], ["customer_state"], "Customers"),
    "chk_customers_by_city": lambda s, d: Q.distribution(staging(s, d)["customers"], ["customer_city", "customer_state"], "Customers"),
    "chk_sellers_by_state": lambda s, d: Q.distribution(staging(s, d)["sellers"], ["seller_state"], "Sellers"),
    "chk_sellers_by_city": lambda s, d: Q.distribution(staging(s, d)["sellers"], ["seller_city", "seller_state"], "Sellers"),
    "chk_sellers_activity": _over(C.seller_activity),
    "chk_payments_types": lambda s, d: Q.distribution(staging(s, d)["payments"], ["payment_type"], "PaymentCount", TotalPaymentValue=F.sum("payment_value")),
    "chk_payments_histogram": lambda s, d: Q.size_histogram(staging(s, d)["payments"], ["order_id"]),
    "chk_payments_sequence_starts": _over(C.sequence_starts),
    "chk_payments_top_totals": _over(C.top_payment_totals),
    "chk_reviews_histogram": lambda s, d: Q.size_histogram(staging(s, d)["reviews"], ["order_id"]),
    "chk_reviews_repeated_ids": _over(C.repeated_review_ids),
    "chk_reviews_scores": lambda s, d: Q.distribution(staging(s, d)["reviews"], ["review_score"], "Reviews"),
    "chk_geolocation_states": _over(C.states_with_zips),
    "chk_geolocation_busiest_zips": _over(C.busiest_zips),
}


def _n(name: str, condition: str) -> str:
    return f"count(CASE WHEN {condition} THEN 1 END) AS {name}"


_MISMATCH = """(SELECT p.order_id, p.n AS PaymentRows, p.t AS PaymentType, p.i AS Installments, p.total AS PaymentTotal, i.n AS ItemRows, i.price AS ItemPriceTotal,
    i.freight AS FreightTotal, i.both AS ItemAndFreightTotal, p.total - i.both AS Difference, abs(p.total - i.both) AS AbsDifference
    FROM (SELECT order_id, count(*) AS n, max(payment_type) AS t, max(payment_installments) AS i, sum(payment_value) AS total FROM stg_payments GROUP BY 1) p
    JOIN (SELECT order_id, count(*) AS n, sum(price) AS price, sum(freight_value) AS freight, sum(price + freight_value) AS both FROM stg_items GROUP BY 1) i ON i.order_id = p.order_id
    WHERE abs(p.total - i.both) > 0.01)"""
_SIGNS = f"{_n('PaymentHigherCount', 'Difference > 0')}, {_n('PaymentLowerCount', 'Difference < 0')}"
_PERCENT = "CAST(floor(CAST({known} * 10000 AS DOUBLE) / nullif({total}, 0) + 0.5) / 100 AS DOUBLE)"


def _distribution(block: str, columns: list[str], name: str, extra: str = "") -> str:
    labels = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '[NULL]') AS {c}" for c in columns)
    return f"SELECT {labels}, count(*) AS \"{name}\"{extra} FROM {block} GROUP BY ALL"


def _histogram(block: str, key: str) -> str:
    return f"SELECT n AS RowsPerGroup, count(*) AS Groups FROM (SELECT {key}, count(*) AS n FROM {block} GROUP BY 1) GROUP BY 1"


def _anomalies(block: str, sequence: str) -> str:
    return f"""SELECT SequenceRows, CAST(MinSequence AS BIGINT) AS MinSequence, CAST(MaxSequence AS BIGINT) AS MaxSequence, count(*) AS Groups FROM
        (SELECT order_id, count(*) AS SequenceRows, min({sequence}) AS MinSequence, max({sequence}) AS MaxSequence FROM {block} GROUP BY 1)
        WHERE MinSequence <> 1 OR MaxSequence <> SequenceRows GROUP BY ALL"""


_PAIRS = (("orders", "stg_orders"), ("customer", "stg_customers"), ("supplier", "stg_sellers"), ("part", "stg_products"), ("lineitem", "stg_items"))
_COMPLETE = " UNION ALL ".join(
    f"SELECT '{n}' AS DatasetName, (SELECT count(*) FROM {n}) AS ActualRows, (SELECT count(*) FROM {b}) AS ExpectedRows" for n, b in _PAIRS
)

ORACLE = {
    "dq_01_row_count": 'SELECT count(*) AS "RowCount" FROM lineitem',
    "dq_02_duplicate_groups": "SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, count(*) AS DuplicateCount FROM lineitem GROUP BY ALL HAVING count(*) > 1",
    "dq_03_null_audit": "SELECT " + ", ".join(_n(f"{c}_nulls", f"{c} IS NULL") for c in CONTRACTS["orders"].column_names) + " FROM stg_orders",
    "dq_04_blank_audit": "SELECT " + ", ".join(_n(f"{c}_blanks", f"trim({c}) = ''") for c in ("review_comment_title", "review_comment_message")) + " FROM stg_reviews",
    "dq_05_orphans": "SELECT count(*) AS OrphanRows FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l ON l.doc_id = d.doc_id WHERE l.doc_id IS NULL",
    "dq_06_unreferenced": "SELECT o_orderkey, o_orderstatus FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)",
    "dq_07_negative_values": f"SELECT {_n('c_acctbal_negative', 'c_acctbal < 0')}, {_n('c_nationkey_negative', 'c_nationkey < 0')} FROM customer",
    "dq_08_zero_values": f"SELECT {_n('l_discount_zero', 'l_discount = 0')}, {_n('l_tax_zero', 'l_tax = 0')}, {_n('l_quantity_zero', 'l_quantity = 0')} FROM lineitem",
    "dq_09_value_range": f"SELECT min(l_quantity) AS min_l_quantity, max(l_quantity) AS max_l_quantity, min(l_extendedprice) AS min_l_extendedprice, max(l_extendedprice) AS max_l_extendedprice, {moment('min(l_shipdate)')} AS min_l_shipdate, {moment('max(l_shipdate)')} AS max_l_shipdate FROM lineitem",
    "dq_10_out_of_bounds": f"SELECT {_n('geolocation_lat_invalid', 'NOT geolocation_lat BETWEEN -29 AND 90')}, {_n('geolocation_lng_invalid', 'NOT geolocation_lng BETWEEN -180 AND -50')} FROM stg_geolocation",
    "dq_11_outside_domain": "SELECT count(*) AS InvalidRows FROM events WHERE event_type NOT IN ('view', 'click', 'signup')",
    "dq_12_longest_text": "SELECT max(length(rtrim(text, ' '))) AS max_text_length, max(length(rtrim(lang, ' '))) AS max_lang_length, max(length(rtrim(source, ' '))) AS max_source_length FROM documents",
    "dq_12_length_distribution": "SELECT length(rtrim(text, ' ')) AS TextLength, count(*) AS \"Rows\" FROM conversations GROUP BY 1",
    "dq_12_length_violations": "SELECT count(*) AS InvalidLengthRows FROM documents WHERE length(rtrim(lang, ' ')) <> 2",
    "dq_13_non_numeric": "SELECT count(*) AS NonNumericRows FROM pages WHERE regexp_matches(url, '[^0-9]')",
    "dq_14_distribution": _distribution("stg_products", ["product_category_name", "product_photos_qty"], "Rows"),
    "dq_15_distinct_values": "SELECT count(DISTINCT l_orderkey) AS distinct_l_orderkey, count(DISTINCT l_partkey) AS distinct_l_partkey, count(DISTINCT l_suppkey) AS distinct_l_suppkey FROM lineitem",
    "dq_16_multiplicity": "SELECT count(CASE WHEN n > 1 THEN 1 END) AS RepeatedGroups, max(n) AS MaxRowsPerGroup FROM (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1)",
    "dq_16_size_histogram": _histogram("lineitem", "l_orderkey"),
    "dq_17_exact_duplicates": "SELECT CAST(sum(n - 1) AS BIGINT) AS ExactDuplicateRows, count(*) AS DistinctSourceRows FROM (SELECT count(*) AS n FROM stg_geolocation GROUP BY geolocation_zip_code_prefix, geolocation_lat, geolocation_lng, geolocation_city, geolocation_state)",
    "dq_18_values_per_key": """SELECT geolocation_zip_code_prefix, count(*) AS SourceRows, count(DISTINCT geolocation_state) AS DistinctValues, min(geolocation_state) AS MinValue, max(geolocation_state) AS MaxValue
        FROM stg_geolocation GROUP BY 1 HAVING count(DISTINCT geolocation_state) > 1 ORDER BY 3 DESC, 2 DESC, 1 LIMIT 100""",
    "dq_19_coverage_percent": f"SELECT {_PERCENT.format(known='count(l.doc_id)', total='count(*)')} AS CoveragePercent FROM (SELECT DISTINCT doc_id FROM documents) d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l ON l.doc_id = d.doc_id",
    "dq_20_unmatched_labels": """SELECT 'missing' AS Kind, p.product_category_name, count(*) AS "Rows" FROM stg_products p LEFT JOIN stg_translation t ON t.product_category_name = p.product_category_name
        WHERE p.product_category_name IS NOT NULL AND t.product_category_name IS NULL GROUP BY 2
        UNION ALL SELECT 'unused', product_category_name, 0 FROM stg_translation WHERE product_category_name NOT IN (SELECT product_category_name FROM stg_products WHERE product_category_name IS NOT NULL)""",
    "dq_21_sequence_anomalies": _anomalies("stg_payments", "payment_sequential"),
    "dq_21_item_sequence_anomalies": _anomalies("stg_items", "order_item_id"),
    "dq_22_temporal_violations": "SELECT count(*) AS ReviewBeforePurchaseRows FROM stg_reviews r JOIN stg_orders o ON o.order_id = r.order_id WHERE r.review_creation_date < o.order_purchase_timestamp",
    "dq_23_mismatch_count": f"SELECT count(*) AS MismatchOrders FROM {_MISMATCH}",
    "dq_24_mismatch_summary": f"""SELECT count(*) AS MismatchOrders, CAST(min(AbsDifference) AS DOUBLE) AS MinDifference, CAST(max(AbsDifference) AS DOUBLE) AS MaxDifference,
        {round_half_up('sum(AbsDifference)', 'count(*)')} AS AvgDifference, {_n('DifferenceLessOrEqual1', 'AbsDifference <= 1')}, {_n('DifferenceGreaterThan1', 'AbsDifference > 1')},
        {_n('DifferenceGreaterThan10', 'AbsDifference > 10')}, {_n('DifferenceGreaterThan100', 'AbsDifference > 100')} FROM {_MISMATCH}""",
    "dq_25_mismatch_by_status": f"SELECT order_status, count(*) AS OrderCount, {_SIGNS} FROM {_MISMATCH} m JOIN stg_orders o ON o.order_id = m.order_id GROUP BY 1",
    "dq_26_mismatch_by_installments": f"""SELECT CAST(Installments AS BIGINT) AS Installments, count(*) AS OrderCount, {_SIGNS}, {round_half_up('sum(Difference)', 'count(*)')} AS AvgDifference,
        CAST(max(Difference) AS DOUBLE) AS MaxDifference, CAST(min(Difference) AS DOUBLE) AS MinDifference FROM {_MISMATCH} WHERE PaymentRows = 1 AND PaymentType = 'credit_card' GROUP BY 1""",
    "dq_27_mismatch_detail": f"""SELECT m.order_id, order_status, PaymentRows, ItemRows, CAST(ItemPriceTotal AS DOUBLE) AS ItemPriceTotal, CAST(FreightTotal AS DOUBLE) AS FreightTotal,
        CAST(ItemAndFreightTotal AS DOUBLE) AS ExpectedItemAndFreight, CAST(PaymentTotal AS DOUBLE) AS PaymentTotal, CAST(Difference AS DOUBLE) AS Difference
        FROM {_MISMATCH} m JOIN stg_orders o ON o.order_id = m.order_id ORDER BY AbsDifference DESC, m.order_id LIMIT 100""",
    "dq_28_top_groups": "SELECT l_orderkey, count(*) AS \"Lines\", sum(l_quantity) AS Quantity FROM lineitem GROUP BY 1 ORDER BY 3 DESC, 1 LIMIT 20",
    "dq_29_group_size_summary": f"SELECT min(n) AS MinRows, max(n) AS MaxRows, {round_half_up('sum(n)', 'count(*)')} AS AvgRows FROM (SELECT o_orderkey, count(l_orderkey) AS n FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1)",
    "dq_30_childless_parents": f"""SELECT o.order_id, o.order_status, {moment('o.order_purchase_timestamp')} AS order_purchase_timestamp, {moment('o.order_approved_at')} AS order_approved_at,
        {moment('o.order_delivered_customer_date')} AS order_delivered_customer_date, (SELECT count(*) FROM stg_items i WHERE i.order_id = o.order_id) AS OrderItemCount
        FROM stg_orders o WHERE NOT EXISTS (SELECT 1 FROM stg_payments p WHERE p.order_id = o.order_id)""",
    "dq_31_text_coverage": f"""SELECT {_n('ReviewsWithTitle', "trim(review_comment_title) <> ''")}, {_n('ReviewsWithMessage', "trim(review_comment_message) <> ''")},
        {_n('ReviewsWithoutTitleOrMessage', 'review_comment_title IS NULL AND review_comment_message IS NULL')} FROM stg_reviews""",
    "dq_32_completeness": f"SELECT *, CASE WHEN ActualRows = ExpectedRows THEN 'PASS' ELSE 'FAIL' END AS ValidationStatus FROM ({_COMPLETE})",
    "dq_32_overall_status": f"SELECT CASE WHEN count(CASE WHEN ActualRows <> ExpectedRows THEN 1 END) = 0 THEN 'STAGING VALIDATION PASSED' ELSE 'STAGING VALIDATION FAILED' END AS Status FROM ({_COMPLETE})",
    "dq_33_known_issues": """SELECT '[KNOWN ISSUE] product_id=' || product_id || ' | Category=' || coalesce(product_category_name, '[NULL]') || ' | Weight=' || product_weight_g
        || ' | Length=' || coalesce(CAST(product_length_cm AS VARCHAR), '[NULL]') || ' | Height=' || product_height_cm || ' | Width=' || product_width_cm
        || ' | ChildRows=' || (SELECT count(*) FROM stg_items i WHERE i.product_id = p.product_id) AS DQ_Result FROM stg_products p WHERE product_weight_g = 0""",
    "dq_34_counts_by_parent_attribute": "SELECT order_status, count(*) AS ChildRows FROM stg_reviews r JOIN stg_orders o ON o.order_id = r.order_id GROUP BY 1",
    "dq_35_score_summary": f"SELECT count(*) AS ReviewRows, {round_half_up('sum(CAST(review_score AS DECIMAL(18,2)))', 'count(*)')} AS AverageReviewScore, CAST(min(review_score) AS BIGINT) AS MinReviewScore, CAST(max(review_score) AS BIGINT) AS MaxReviewScore FROM stg_reviews",
    "chk_conformed_geography_invalid_states": "SELECT ZipCodePrefix, StateCode FROM conf_geography WHERE StateCode IS NULL",
    "chk_products_by_category": _distribution("stg_products", ["product_category_name"], "Products"),
    "chk_orders_status": _distribution("stg_orders", ["order_status"], "Orders"),
    "chk_translation_mapping": "SELECT * FROM stg_translation",
    "chk_translation_duplicate_english": "SELECT product_category_name_english, count(*) AS DuplicateCount FROM stg_translation GROUP BY 1 HAVING count(*) > 1",
    "chk_customers_repeated_identities": "SELECT customer_unique_id, count(*) AS CustomerIDCount FROM stg_customers GROUP BY 1 HAVING count(*) > 1",
    "chk_customers_zip_lengths": "SELECT length(rtrim(customer_zip_code_prefix, ' ')) AS TextLength, count(*) AS \"Rows\" FROM stg_customers GROUP BY 1",
    "chk_customers_by_state": _distribution("stg_customers", ["customer_state"], "Customers"),
    "chk_customers_by_city": _distribution("stg_customers", ["customer_city", "customer_state"], "Customers"),
    "chk_sellers_by_state": _distribution("stg_sellers", ["seller_state"], "Sellers"),
    "chk_sellers_by_city": _distribution("stg_sellers", ["seller_city", "seller_state"], "Sellers"),
    "chk_sellers_activity": "SELECT s.seller_id, count(i.seller_id) AS ChildRows FROM stg_sellers s LEFT JOIN stg_items i ON i.seller_id = s.seller_id GROUP BY 1",
    "chk_payments_types": _distribution("stg_payments", ["payment_type"], "PaymentCount", ", CAST(sum(payment_value) AS DOUBLE) AS TotalPaymentValue"),
    "chk_payments_histogram": _histogram("stg_payments", "order_id"),
    "chk_payments_sequence_starts": "SELECT order_id, count(*) AS SequenceRows, CAST(min(payment_sequential) AS BIGINT) AS MinSequence, CAST(max(payment_sequential) AS BIGINT) AS MaxSequence FROM stg_payments GROUP BY 1 HAVING min(payment_sequential) <> 1",
    "chk_payments_top_totals": "SELECT order_id, count(*) AS PaymentRows, CAST(sum(payment_value) AS DOUBLE) AS TotalPaymentValue FROM stg_payments GROUP BY 1 ORDER BY sum(payment_value) DESC, 1 LIMIT 20",
    "chk_reviews_histogram": _histogram("stg_reviews", "order_id"),
    "chk_reviews_repeated_ids": "SELECT review_id, count(*) AS ReviewRowCount, count(DISTINCT order_id) AS DistinctOrderCount FROM stg_reviews GROUP BY 1 HAVING count(*) > 1 ORDER BY 2 DESC, 1 LIMIT 100",
    "chk_reviews_scores": _distribution("stg_reviews", ["review_score"], "Reviews"),
    "chk_geolocation_states": "SELECT geolocation_state, count(*) AS GeolocationRows, count(DISTINCT geolocation_zip_code_prefix) AS DistinctZipPrefixes FROM stg_geolocation GROUP BY 1",
    "chk_geolocation_busiest_zips": """SELECT geolocation_zip_code_prefix, count(*) AS SourceRows, count(DISTINCT geolocation_city) AS DistinctCities, count(DISTINCT geolocation_state) AS DistinctStates,
        min(geolocation_lat) AS MinLatitude, max(geolocation_lat) AS MaxLatitude, min(geolocation_lng) AS MinLongitude, max(geolocation_lng) AS MaxLongitude
        FROM stg_geolocation GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20""",
}


# --- SQL of the merged metrics ------------------------------------------------


def _rows(block: str, cells: dict[str, str], where: str = "") -> str:
    """One aggregate row of a block as (metric, value) rows."""
    pairs = ", ".join(f"{{'metric': '{n}', 'value': CAST({e} AS VARCHAR)}}" for n, e in cells.items())
    return f"SELECT c.metric, c.value FROM (SELECT unnest([{pairs}]) AS c FROM {block} {where})"


def _when(condition: str) -> str:
    return f"count(CASE WHEN {condition} THEN 1 END)"


def _sql_nulls(columns) -> dict[str, str]:
    return {f"{c}_nulls": _when(f"{c} IS NULL") for c in columns}


def _sql_each(columns, suffix: str, condition: str) -> dict[str, str]:
    return {f"{c}{suffix}": _when(condition.format(c=c)) for c in columns}


def _sql_range(*columns: str) -> dict[str, str]:
    def shown(e: str, c: str) -> str:
        return moment(e) if c.endswith(("timestamp", "date")) else e

    return {f"{f}_{c}": shown(f"{f}({c})", c) for c in columns for f in ("min", "max")}


def _sql_address(zip_code: str, state: str, city: str) -> dict[str, str]:
    states = ", ".join(f"'{x}'" for x in C.STATE_CODES)
    return {
        "NonNumericZip": _when(f"regexp_matches({zip_code}, '[^0-9]')"),
        "InvalidZipLength": _when(f"length(rtrim({zip_code}, ' ')) <> 5"),
        "InvalidStateLength": _when(f"length(rtrim({state}, ' ')) <> 2"),
        "InvalidState": _when(f"{state} NOT IN ({states})"),
        "MaxCityLength": f"max(length(rtrim({city}, ' ')))",
    }


def _sql_key(block: str, key: list[str], label: str, where: str = "") -> str:
    grouped = f"(SELECT {', '.join(key)}, count(*) AS n FROM {block} {where} GROUP BY ALL)"
    return _rows(
        grouped,
        {
            f"Distinct_{label}": _when(f"{key[0]} IS NOT NULL"),
            f"Repeated_{label}": _when("n > 1"),
            f"MaxRows_{label}": "max(n)",
            f"Surplus_{label}": "CAST(sum(n - 1) AS BIGINT)",
        },
    )


def _sql_orphans(child: str, parent: str, key: str, name: str) -> str:
    return _rows(f"{child} c LEFT JOIN (SELECT DISTINCT {key} FROM {parent}) p ON p.{key} = c.{key}", {name: "count(*)"}, f"WHERE p.{key} IS NULL")


def _metrics(name: str, block: str, cells: dict[str, str], *others: str) -> str:
    own = {"RowCount": "count(*)", **_sql_nulls(CONTRACTS[name].column_names), **cells}
    return "\nUNION ALL ".join([_rows(block, own), *others])


_SIZES = C.PRODUCT_NUMBERS[3:]
_PAY = ("payment_sequential", "payment_installments", "payment_value")
_TEXTS = ("review_comment_title", "review_comment_message")
_LABEL = "product_category_name"
_AVG = "printf('%.2f', {})"

ORACLE.update(
    {
        "chk_orders_metrics": _metrics("orders", "stg_orders", _sql_range("order_purchase_timestamp"), _sql_key("stg_orders", ["order_id"], "order_id")),
        "chk_order_items_metrics": _metrics(
            "order_items",
            "stg_items",
            {
                **_sql_range("price", "freight_value"),
                "freight_value_zero": _when("freight_value = 0"),
                **_sql_each(("price", "freight_value"), "_negative", "{c} < 0"),
            },
            _sql_key("stg_items", ["order_id", "order_item_id"], "item_key"),
            _sql_orphans("stg_items", "stg_orders", "order_id", "OrphanOrders"),
            _sql_orphans("stg_items", "stg_products", "product_id", "OrphanProducts"),
            _sql_orphans("stg_items", "stg_sellers", "seller_id", "OrphanSellers"),
        ),
        "chk_products_metrics": _metrics(
            "products",
            "stg_products",
            {
                **_sql_each((_LABEL,), "_blanks", "trim({c}) = ''"),
                **_sql_each(C.PRODUCT_NUMBERS, "_negative", "{c} < 0"),
                **_sql_each(_SIZES, "_zero", "{c} = 0"),
                **_sql_range(*_SIZES, "product_photos_qty"),
            },
            _sql_key("stg_products", ["product_id"], "product_id"),
            _sql_key("stg_products", [_LABEL], "category"),
            _sql_orphans("stg_products", "stg_items", "product_id", "ProductsWithoutOrderItems"),
        ),
        "chk_category_translation_metrics": _metrics(
            "category_translation",
            "stg_translation",
            _sql_each((_LABEL, "product_category_name_english"), "_blanks", "trim({c}) = ''"),
            _sql_key("stg_translation", [_LABEL], "source_label"),
            _sql_key("stg_translation", ["product_category_name_english"], "english_label"),
            _rows(
                f"stg_products p LEFT JOIN stg_translation t ON t.{_LABEL} = p.{_LABEL}",
                {"MissingTranslationCategoryCount": f"count(DISTINCT p.{_LABEL})", "ProductsAffectedByMissingTranslation": "count(*)"},
                f"WHERE p.{_LABEL} IS NOT NULL AND t.{_LABEL} IS NULL",
            ),
            _sql_orphans("stg_translation", "stg_products", _LABEL, "UnusedTranslationCount"),
            _rows(
                f"(SELECT DISTINCT {_LABEL} AS l FROM stg_products WHERE {_LABEL} IS NOT NULL) p LEFT JOIN stg_translation t ON t.{_LABEL} = p.l",
                {"TranslationCoveragePercent": _AVG.format(_PERCENT.format(known=f"count(t.{_LABEL})", total="count(*)"))},
            ),
        ),
        "chk_customers_metrics": _metrics(
            "customers",
            "stg_customers",
            {
                **_sql_each(("customer_unique_id", "customer_zip_code_prefix", "customer_city", "customer_state"), "_blanks", "trim({c}) = ''"),
                **_sql_address("customer_zip_code_prefix", "customer_state", "customer_city"),
            },
            _sql_key("stg_customers", ["customer_id"], "customer_id"),
            _sql_key("stg_customers", ["customer_unique_id"], "identity"),
            _sql_orphans("stg_orders", "stg_customers", "customer_id", "OrdersWithoutCustomer"),
            _sql_orphans("stg_customers", "stg_orders", "customer_id", "CustomersWithoutOrders"),
            _sql_key("stg_orders", ["customer_id"], "orders_per_customer"),
        ),
        "chk_sellers_metrics": _metrics(
            "sellers",
            "stg_sellers",
            {
                **_sql_each(("seller_zip_code_prefix", "seller_city", "seller_state"), "_blanks", "trim({c}) = ''"),
                **_sql_address("seller_zip_code_prefix", "seller_state", "seller_city"),
            },
            _sql_key("stg_sellers", ["seller_id"], "seller_id"),
            _sql_orphans("stg_items", "stg_sellers", "seller_id", "ItemsWithoutSeller"),
            _sql_orphans("stg_sellers", "stg_items", "seller_id", "SellersWithoutItems"),
            _rows(
                "(SELECT s.seller_id, count(i.seller_id) AS n FROM stg_sellers s LEFT JOIN stg_items i ON i.seller_id = s.seller_id GROUP BY 1)",
                {"MinRows": "min(n)", "MaxRows": "max(n)", "AvgRows": _AVG.format(round_half_up("sum(n)", "count(*)"))},
            ),
        ),
        "chk_payments_metrics": _metrics(
            "payments",
            "stg_payments",
            {
                "payment_type_blanks": _when("trim(payment_type) = ''"),
                **_sql_each(_PAY, "_negative", "{c} < 0"),
                **_sql_each(_PAY[1:], "_zero", "{c} = 0"),
                **_sql_range(*_PAY),
            },
            _sql_key("stg_payments", ["order_id", "payment_sequential"], "payment_key"),
            _sql_key("stg_payments", ["order_id"], "order_id"),
            _sql_orphans("stg_payments", "stg_orders", "order_id", "OrphanPayments"),
            _sql_orphans("stg_orders", "stg_payments", "order_id", "OrdersWithoutPayments"),
            _rows(_MISMATCH, {"ReconciliationMismatchOrders": "count(*)"}),
        ),
        "chk_reviews_metrics": _metrics(
            "reviews",
            "stg_reviews",
            {
                **_sql_each(_TEXTS, "_blanks", "trim({c}) = ''"),
                "InvalidReviewScores": _when("review_score NOT BETWEEN 1 AND 5"),
                **{f"max_{c}_length": f"max(length(rtrim({c}, ' ')))" for c in _TEXTS},
                **_sql_range("review_creation_date", "review_answer_timestamp", "review_score"),
                "AnswerBeforeCreation": _when("review_answer_timestamp < review_creation_date"),
                "AverageReviewScore": _AVG.format(round_half_up("sum(CAST(review_score AS DECIMAL(18,2)))", "count(*)")),
                "WithTitle": _when(f"trim({_TEXTS[0]}) <> ''"),
                "WithMessage": _when(f"trim({_TEXTS[1]}) <> ''"),
                "WithoutText": _when(f"{_TEXTS[0]} IS NULL AND {_TEXTS[1]} IS NULL"),
            },
            _sql_key("stg_reviews", ["review_id", "order_id"], "review_key"),
            _sql_key("stg_reviews", ["order_id"], "order_id"),
            _sql_key("stg_reviews", ["review_id"], "review_id"),
            _sql_orphans("stg_reviews", "stg_orders", "order_id", "OrphanReviews"),
            _sql_orphans("stg_orders", "stg_reviews", "order_id", "OrdersWithoutReviews"),
            _rows(
                "stg_reviews r JOIN stg_orders o ON o.order_id = r.order_id",
                {
                    "CreatedBeforePurchase": _when("review_creation_date < order_purchase_timestamp"),
                    "CreatedBeforeDelivery": _when("review_creation_date < order_delivered_customer_date"),
                },
            ),
        ),
        "chk_geolocation_metrics": _metrics(
            "geolocation",
            "stg_geolocation",
            {
                **_sql_each(("geolocation_zip_code_prefix", "geolocation_city", "geolocation_state"), "_blanks", "trim({c}) = ''"),
                **_sql_address("geolocation_zip_code_prefix", "geolocation_state", "geolocation_city"),
                "InvalidLatitude": _when("geolocation_lat NOT BETWEEN -90 AND 90"),
                "InvalidLongitude": _when("geolocation_lng NOT BETWEEN -180 AND 180"),
            },
            _sql_key("stg_geolocation", ["geolocation_zip_code_prefix"], "zip"),
            _sql_key("stg_geolocation", ["geolocation_state"], "state"),
            _rows("(SELECT count(*) AS n FROM stg_geolocation GROUP BY " + ", ".join(CONTRACTS["geolocation"].column_names) + ")", {"ExactDuplicateRows": "CAST(sum(n - 1) AS BIGINT)", "DistinctSourceRows": "count(*)"}),
            _rows("geo_stats", {"ZipsWithMultipleStates": _when("states > 1"), "ZipsWithMultipleCities": _when("cities > 1")}),
            _rows("geo_stats", {"MinRowsPerZip": "min(n)", "MaxRowsPerZip": "max(n)", "AvgRowsPerZip": _AVG.format(round_half_up("sum(n)", "count(*)"))}),
        ),
        "chk_conformed_geography_metrics": "\nUNION ALL ".join(
            [
                _rows(
                    "conf_geography",
                    {
                        "RowCount": "count(*)",
                        "MissingFromGeolocation": _when("MissingFromGeolocationFlag = 1"),
                        "StateConflicts": _when("StateConflictFlag = 1"),
                        "StateAmbiguous": _when("StateAmbiguousFlag = 1"),
                        "StatesResolvedByReference": _when("StateResolvedByReferenceFlag = 1"),
                        "CityAmbiguous": _when("CityAmbiguousFlag = 1"),
                        "CitiesResolvedByReference": _when("CityResolvedByReferenceFlag = 1"),
                        "ReferenceFallbackZIPs": _when("ReferenceFallbackFlag = 1"),
                        "NullStates": _when("StateCode IS NULL"),
                        "NullCities": _when("CityName IS NULL"),
                        "ZIPsWithoutCoordinates": _when("lat IS NULL OR lng IS NULL"),
                        "InvalidStateRows": _when("StateCode IS NULL"),
                        "InvalidCoordinateRows": _when("lat NOT BETWEEN -90 AND 90 OR lng NOT BETWEEN -180 AND 180"),
                        "InvalidFallbackRows": _when("MissingFromGeolocationFlag = 1 AND (ReferenceFallbackFlag <> 1 OR StateCode IS NULL OR CityName IS NULL OR lat IS NOT NULL OR lng IS NOT NULL)"),
                        "InvalidAmbiguousCityRows": _when("CityAmbiguousFlag = 1 AND CityName IS NOT NULL"),
                    },
                ),
                _sql_key("conf_geography", ["ZipCodePrefix"], "zip"),
                _rows("(SELECT DISTINCT zip FROM geo_ref) r LEFT JOIN conf_geography g ON g.ZipCodePrefix = r.zip", {"RequiredZIPsMissing": "count(*)"}, "WHERE g.ZipCodePrefix IS NULL"),
            ]
        ),
    }
)
