"""The source audit."""

from __future__ import annotations

from stallkeep.plans import source_audit as A
from stallkeep.queries.built import staging
from stallkeep.queries.ingestion import _BLOCK
from stallkeep.queries.oracle import moment
from stallkeep.operators.quality import coverage_percent
from stallkeep.sources import CONTRACTS


def _t(s, d):
    return {n: df for n, df in staging(s, d).items() if n in CONTRACTS}


QUERIES = {
    "aud_01_row_counts": lambda s, d: A.row_counts(_t(s, d)),
    "aud_02_status_distribution": lambda s, d: A.status_distribution(_t(s, d)["orders"]),
    "aud_03_delivered_volume": lambda s, d: A.delivered_volume(_t(s, d)["orders"], _t(s, d)["order_items"]),
    "aud_04_purchase_range": lambda s, d: A.purchase_range(_t(s, d)["orders"]),
    "aud_05_surplus_keys": lambda s, d: A.surplus_keys(_t(s, d)),
    "aud_06_orphan_references": lambda s, d: A.orphan_references(_t(s, d)),
    "aud_07_missing_category": lambda s, d: A.missing_category(_t(s, d)["products"]),
    "aud_08_untranslated_labels": lambda s, d: A.untranslated_labels(_t(s, d)["products"], _t(s, d)["category_translation"]),
    "aud_08_coverage": lambda s, d: coverage_percent(_t(s, d)["products"], _t(s, d)["category_translation"], "product_category_name"),
    "aud_09_order_multiplicity": lambda s, d: A.order_multiplicity(_t(s, d)["payments"], _t(s, d)["reviews"]),
    "aud_10_important_nulls": lambda s, d: A.important_nulls(_t(s, d)),
    "aud_11_payment_item_diagnostic": lambda s, d: A.payment_item_diagnostic(_t(s, d)["order_items"], _t(s, d)["payments"]),
    "aud_report": lambda s, d: A.audit_report(_t(s, d)),
}

_PARENT = {"orders": "order_id", "products": "product_id", "sellers": "seller_id"}
_COVERAGE = """CAST(floor(CAST(count(t.label) * 100 * 100 AS DOUBLE) / nullif(count(*), 0) + 0.5) / 100 AS DOUBLE)"""
_USED = """(SELECT DISTINCT product_category_name AS label FROM stg_products WHERE product_category_name IS NOT NULL) p
    LEFT JOIN (SELECT DISTINCT product_category_name AS label FROM stg_translation) t ON t.label = p.label"""

ORACLE = {
    "aud_01_row_counts": " UNION ALL ".join(f"SELECT '{n}' AS DatasetName, count(*) AS ActualRows FROM {b}" for n, b in _BLOCK.items()),
    "aud_02_status_distribution": "SELECT coalesce(order_status, '[NULL]') AS order_status, count(*) AS Orders FROM stg_orders GROUP BY 1",
    "aud_03_delivered_volume": """SELECT 'delivered_orders' AS Metric, count(*) AS "Value" FROM stg_orders WHERE order_status = 'delivered'
        UNION ALL SELECT 'delivered_items', count(*) FROM stg_items WHERE order_id IN (SELECT order_id FROM stg_orders WHERE order_status = 'delivered')""",
    "aud_04_purchase_range": f"SELECT {moment('min(order_purchase_timestamp)')} AS first_purchase, {moment('max(order_purchase_timestamp)')} AS last_purchase FROM stg_orders",
    "aud_05_surplus_keys": " UNION ALL ".join(
        f"SELECT '{t}({','.join(k)})' AS KeySet, CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS SurplusRows FROM (SELECT {', '.join(k)}, count(*) AS n FROM {_BLOCK[t]} GROUP BY ALL)"
        for t, k in A.AUDITED_KEYS
    ),
    "aud_06_orphan_references": " UNION ALL ".join(
        f"SELECT '{c}.{k} -> {p}' AS Reference, count(*) AS OrphanRows FROM {_BLOCK[c]} WHERE {k} IS NOT NULL AND {k} NOT IN (SELECT {k} FROM {_BLOCK[p]})"
        for c, k, p in A.AUDITED_REFERENCES
    ),
    "aud_07_missing_category": "SELECT count(*) AS ProductsWithoutCategory FROM stg_products WHERE product_category_name IS NULL",
    "aud_08_untranslated_labels": "SELECT product_category_name FROM stg_products WHERE product_category_name IS NOT NULL EXCEPT SELECT product_category_name FROM stg_translation",
    "aud_08_coverage": f"SELECT {_COVERAGE} AS CoveragePercent FROM {_USED}",
    "aud_09_order_multiplicity": " UNION ALL ".join(
        f"SELECT '{n}' AS Dataset, count(CASE WHEN n > 1 THEN 1 END) AS RepeatedGroups, max(n) AS MaxRowsPerGroup FROM (SELECT order_id, count(*) AS n FROM stg_{n} GROUP BY 1)"
        for n in ("payments", "reviews")
    ),
    "aud_10_important_nulls": " UNION ALL ".join(
        f"SELECT '{t}.{c}' AS ColumnName, count(CASE WHEN {c} IS NULL THEN 1 END) AS NullRows FROM {_BLOCK[t]}" for t, cs in A.IMPORTANT_COLUMNS for c in cs
    ),
    "aud_11_payment_item_diagnostic": """SELECT count(*) AS ComparedOrders, count(CASE WHEN round(coalesce(a, 0), 2) <> round(coalesce(b, 0), 2) THEN 1 END) AS MismatchOrders
        FROM (SELECT order_id, sum(price) AS a FROM stg_items GROUP BY 1) i FULL JOIN (SELECT order_id, sum(payment_value) AS b FROM stg_payments GROUP BY 1) p USING (order_id)""",
}


def _section(name: str, key: str, metric: str, value: str) -> str:
    return f"SELECT '{name}' AS section, {metric} AS metric, CAST({value} AS VARCHAR) AS value FROM ({ORACLE[key]})"


ORACLE["aud_report"] = " UNION ALL ".join(
    [
        _section("rows", "aud_01_row_counts", "DatasetName", "ActualRows"),
        _section("order_status", "aud_02_status_distribution", "order_status", "Orders"),
        _section("delivered", "aud_03_delivered_volume", "Metric", '"Value"'),
        _section("purchase_range", "aud_04_purchase_range", "'first_purchase'", "first_purchase"),
        _section("purchase_range", "aud_04_purchase_range", "'last_purchase'", "last_purchase"),
        _section("surplus_keys", "aud_05_surplus_keys", "KeySet", "SurplusRows"),
        _section("orphans", "aud_06_orphan_references", "Reference", "OrphanRows"),
        _section("categories", "aud_07_missing_category", "'ProductsWithoutCategory'", "ProductsWithoutCategory"),
        _section("categories", "aud_08_coverage", "'CoveragePercent'", "CAST(CoveragePercent AS DECIMAL(6,2))"),
        _section("untranslated", "aud_08_untranslated_labels", "product_category_name", "1"),
        _section("repeated_orders", "aud_09_order_multiplicity", "Dataset", "RepeatedGroups"),
        _section("most_rows_per_order", "aud_09_order_multiplicity", "Dataset", "MaxRowsPerGroup"),
        _section("important_nulls", "aud_10_important_nulls", "ColumnName", "NullRows"),
        _section("payment_against_items", "aud_11_payment_item_diagnostic", "'ComparedOrders'", "ComparedOrders"),
        _section("payment_against_items", "aud_11_payment_item_diagnostic", "'MismatchOrders'", "MismatchOrders"),
    ]
)
