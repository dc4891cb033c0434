"""Incremental loads: what a second and third load of the same sources change.

Earlier states of the sources are the role views with rows left out, moved and
altered by arithmetic on their keys, on both sides alike.
"""

from __future__ import annotations

import threading
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stallkeep.operators.changes import UNCHANGED, change_counts, changes, digests
from stallkeep.operators.compare import difference_measures, differences_of_stored
from stallkeep.operators.history import advance_history, open_history, valid_at
from stallkeep.operators.upsert import upsert_members
from stallkeep.plans import dimensions
from stallkeep.plans.incremental import load_touched_facts
from stallkeep.plans.refresh import CONFORMED, DIMENSIONS, FACTS, STAGING
from stallkeep.queries.built import staging, warehouse
from stallkeep.queries.oracle import moment
from stallkeep.session import scratch_path
from stallkeep.sources import CONTRACTS, Store
from stallkeep.sources.increment import LOOKBACK, Increment, load_increment

_lock = threading.RLock()
_cache: dict[tuple, object] = {}

# The first load ends here; some orders of the weeks before come late, change or move.
CUT, WEEKS_BEFORE, MOVED_FROM, MOVED_DAYS = "2000-01-01", "1999-12-15", "1999-12-20", 25


def _once(spark, sf_dir: str, name: str, build):
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), name)
    with _lock:
        if key not in _cache:
            _cache[key] = build()
        return _cache[key]


def _number(column: str):
    return F.col(column).cast("long")


def _at(text: str):
    return F.lit(text).cast("timestamp_ntz")


def _first_orders(orders: DataFrame) -> DataFrame:
    """The orders as the first load found them."""
    k, placed = _number("order_id"), F.col("order_purchase_timestamp")
    recent = (placed >= _at(WEEKS_BEFORE)) & (placed < _at(CUT))
    moved = (k % 31 == 0) & (placed >= _at(MOVED_FROM))
    return orders.filter((placed < _at(CUT)) & ~((k % 23 == 0) & recent)).withColumns(
        {
            "order_status": F.when((k % 29 == 0) & recent, "created").otherwise(F.col("order_status")),
            "order_purchase_timestamp": F.when(moved, F.col("order_purchase_timestamp") - F.make_dt_interval(F.lit(MOVED_DAYS))).otherwise(placed),
        }
    )


def _loads(s, d) -> tuple[Store, list[Increment]]:
    """Three loads of the orders: what there was at first, all of it, and all of it again."""

    def build():
        store = Store(s, scratch_path(s, "incremental"))
        orders, contract = staging(s, d)["orders"], CONTRACTS["orders"]
        return store, [load_increment(store, source, contract) for source in (_first_orders(orders), orders, orders)]

    return _once(s, d, "loads", build)


def _loaded(s, d) -> DataFrame:
    return _loads(s, d)[0].table("orders").select("order_id", "customer_id", "order_status", "order_purchase_timestamp", "order_delivered_customer_date")


def _load_report(s, d) -> DataFrame:
    """What each load did; the rows stored after it come from the table itself."""
    store, loads = _loads(s, d)
    rows = []
    for i, n in enumerate(loads, 1):
        numbers = {"Load": i, "RowsRead": n.rows_read, "Inserted": n.inserted, "Updated": n.updated, "Unchanged": n.unchanged, "Late": n.late}
        numbers |= {"ReplacedMonths": len(n.replaced), "KeptMonths": len(n.kept)}
        rows.append(F.struct(*[F.lit(v).alias(c) for c, v in numbers.items()]))
    return store.table("orders").agg(F.count("*").alias("RowsStored")).select("RowsStored", F.inline(F.array(*rows)))


def _earlier(s, d, name: str) -> DataFrame:
    """A data set as it was: some rows not there yet, some with another value or none, some gone since."""
    table, key = staging(s, d)[name].select(*CONTRACTS[name].column_names), CONTRACTS[name].key[0]
    k = _number("product_id" if name == "products" else "order_id")
    value = {"products": "product_weight_g", "order_items": "price", "reviews": "review_comment_message"}[name]
    kind = table.schema[value].dataType
    other = F.when(k % 19 == 0, F.lit(None)).when(k % 19 == 1, F.lit("77").cast(kind)).otherwise(F.col(value))
    gone = table.filter(k % 13 == 0).withColumn(key, F.concat(F.lit("x"), key))
    return table.filter(k % 17 != 0).withColumn(value, other.cast(kind)).unionByName(gone)


def _changed(s, d, name: str) -> DataFrame:
    key = CONTRACTS[name].key
    now = staging(s, d)[name].select(*CONTRACTS[name].column_names)
    return changes(digests(_earlier(s, d, name), key), digests(now, key), key)


def _change_counts(s, d) -> DataFrame:
    parts = [change_counts(_changed(s, d, n)).select(F.lit(n).alias("Dataset"), "*") for n in ("products", "order_items", "reviews")]
    return reduce(DataFrame.unionByName, parts)


def _upserted(s, d) -> DataFrame:
    """Keys and one attribute of the product dimension after a second load."""
    w = warehouse(s, d)
    k = F.col("product_id").cast("long")
    first = w["products"].filter(k % 5 != 0).withColumn("product_photos_qty", F.lit(0))
    second = w["products"].filter((k % 7 != 0) | (k % 5 == 0))
    members = dimensions.product_members(second, w["DimProductCategory"])
    loaded = upsert_members(dimensions.dim_product(first, w["DimProductCategory"]), members, "ProductID", "ProductKey")
    return loaded.select("ProductKey", "ProductID", "ProductPhotosQty")


# Loads of the product history, and when they took place.
HISTORY = ("1996-03-01", "1998-06-01", "2000-01-01")


def _history(s, d) -> DataFrame:
    def build():
        products, history = staging(s, d)["products"], None
        for i, at in enumerate(HISTORY, 1):
            k = _number("product_id")
            photos = F.when(k % 4 != 0, (k * i) % 3)
            members = products.filter((k + i) % 9 != 0).select(F.col("product_id").alias("ProductID"), photos.alias("Photos"))
            history = open_history(members, _at(at)) if history is None else advance_history(history, members, ["ProductID"], _at(at))
            path = scratch_path(s, "history")
            history.write.parquet(path)
            history = s.read.parquet(path)
        return history

    return _once(s, d, "history", build)


def _lookup(s, d) -> DataFrame:
    """The version of its product that each item was bought at."""
    t = staging(s, d)
    placed = t["orders"].select("order_id", F.col("order_purchase_timestamp").alias("Bought"))
    items = t["order_items"].select("order_id", "order_item_id", F.col("product_id").alias("ProductID")).join(placed, "order_id")
    return valid_at(items, _history(s, d), ["ProductID"], "Bought", ["Photos", "Version"]).drop("Bought")


# Orders and items of these months differ between the two fact loads.
STATUS_MONTHS, PRICE_MONTHS = ("199611", "199612"), ("199805",)


def _fact_loads(s, d) -> tuple[Store, list[dict]]:
    def build():
        w = {n: df for n, df in warehouse(s, d).items() if n in (*STAGING, *CONFORMED, *DIMENSIONS)}
        k, month = _number("order_id"), F.date_format("order_purchase_timestamp", "yyyyMM")
        orders = w["orders"].withColumn("_was", (k % 29 == 0) & month.isin(*STATUS_MONTHS))
        before = orders.withColumn("order_status", F.when(F.col("_was"), "created").otherwise(F.col("order_status"))).drop("_was")
        priced = w["orders"].filter((k % 31 == 0) & month.isin(*PRICE_MONTHS)).select("order_id", F.lit(True).alias("_was"))
        items = w["order_items"].join(priced, "order_id", "left")
        items = items.withColumn("price", F.when(F.col("_was"), F.col("price") + 1).otherwise(F.col("price")).cast(w["order_items"].schema["price"].dataType)).drop("_was")
        store = Store(s, scratch_path(s, "months"))
        return store, [load_touched_facts(store, t) for t in (w | {"orders": before, "order_items": items}, w, w)]

    return _once(s, d, "facts", build)


def _months(s, d) -> DataFrame:
    """Rows and amounts of every fact by month, and whether the second load wrote the month anew."""
    store, loads = _fact_loads(s, d)
    amount = {"FactOrder": F.sum(F.when(F.col("OrderStatus") == "created", 1).otherwise(0)), "FactOrderItem": F.sum("PriceAmount"), "FactPayment": F.sum("PaymentAmount"), "FactReview": F.sum("DuplicateReviewIDFlag")}
    parts = []
    for name in FACTS:
        month = F.floor(F.col("PurchaseDateKey") / 100).cast("long")
        by_month = store.table(name).groupBy(month.alias("PurchaseMonth")).agg(F.count("*").alias("RowCount"), amount[name].cast("double").alias("Amount"))
        parts.append(by_month.select(F.lit(name).alias("Fact"), "*", F.col("PurchaseMonth").cast("string").isin(*loads[1]["replaced"]).cast("int").alias("Replaced")))
    return reduce(DataFrame.unionByName, parts)


def _fact_rows(s, d) -> DataFrame:
    return _fact_loads(s, d)[0].table("FactOrderItem")


def _stored_differences(s, d):
    """Facts of the full load against those loaded by months, which are alike, and against altered payments."""
    w, store = warehouse(s, d), _fact_loads(s, d)[0]
    path, number = scratch_path(s, "altered"), F.col("PaymentSequential")
    payments = store.table("FactPayment").filter(number != 4)
    payments.withColumn("PaymentCount", F.when(number == 3, 2).otherwise(F.col("PaymentCount"))).write.parquet(path)
    pairs = {n: (n, store.table(n)) for n in FACTS} | {"Altered": ("FactPayment", s.read.parquet(path))}
    parts = [differences_of_stored(w[of], table, table.columns).select(F.lit(name).alias("Target"), *difference_measures()) for name, (of, table) in pairs.items()]
    return reduce(DataFrame.unionByName, parts)


QUERIES = {
    "inc_01_watermark_load": _loaded,
    "inc_01_load_report": _load_report,
    "inc_02_change_counts": _change_counts,
    "inc_02_changed_products": lambda s, d: _changed(s, d, "products").filter(F.col("Change") != UNCHANGED),
    "inc_02_changed_reviews": lambda s, d: _changed(s, d, "reviews").filter(F.col("Change") != UNCHANGED),
    "inc_03_dimension_upsert": _upserted,
    "inc_04_member_history": _history,
    "inc_04_member_at_purchase": _lookup,
    "inc_05_replaced_months": _months,
    "inc_05_fact_order_item": _fact_rows,
    "rec_02_stored_differences": _stored_differences,
}

_RECENT = f"o.order_purchase_timestamp >= TIMESTAMP '{WEEKS_BEFORE}' AND o.order_purchase_timestamp < TIMESTAMP '{CUT}'"
_K = "CAST(o.order_id AS BIGINT)"
# first: orders of the first load; both: all orders with what the first load had of them.
_LOADS = f"""
    first AS (
        SELECT order_id, CASE WHEN {_K} % 29 = 0 AND {_RECENT} THEN 'created' ELSE order_status END AS status,
               CASE WHEN {_K} % 31 = 0 AND order_purchase_timestamp >= TIMESTAMP '{MOVED_FROM}'
                    THEN order_purchase_timestamp - INTERVAL {MOVED_DAYS} DAY ELSE order_purchase_timestamp END AS mark
        FROM stg_orders o WHERE order_purchase_timestamp < TIMESTAMP '{CUT}' AND NOT ({_K} % 23 = 0 AND {_RECENT})),
    marks AS (
        SELECT (SELECT max(mark) FROM first) AS first_mark, (SELECT max(order_purchase_timestamp) FROM stg_orders) AS last_mark),
    again AS (
        SELECT o.order_purchase_timestamp AS mark, f.mark AS was, first_mark,
               CASE WHEN f.order_id IS NULL THEN 'insert' WHEN f.status <> o.order_status OR f.mark <> o.order_purchase_timestamp THEN 'update' ELSE 'same' END AS kind
        FROM stg_orders o LEFT JOIN first f ON f.order_id = o.order_id CROSS JOIN marks
        WHERE o.order_purchase_timestamp >= first_mark - INTERVAL {LOOKBACK.days} DAY),
    replaced AS (
        SELECT DISTINCT strftime(m, '%Y%m') AS m FROM (SELECT unnest([mark, coalesce(was, mark)]) AS m FROM again WHERE kind <> 'same'))"""


def _blocks(body: str, select: str) -> str:
    """``body`` names further blocks; the caller of the registry puts those of the oracle before them."""
    return f"SELECT * FROM (WITH {body.strip()} {select})"


def _earlier_sql(name: str, block: str, value: str, other: str) -> str:
    key = CONTRACTS[name].key[0]
    columns = ", ".join(CONTRACTS[name].column_names)
    k = f"CAST({'product_id' if name == 'products' else 'order_id'} AS BIGINT)"
    return f"""
    was AS (
        SELECT {columns} FROM (SELECT * REPLACE (CASE WHEN {k} % 19 = 0 THEN NULL WHEN {k} % 19 = 1 THEN {other} ELSE {value} END AS {value}) FROM {block} WHERE {k} % 17 <> 0)
        UNION ALL SELECT {columns} FROM (SELECT * REPLACE ('x' || {key} AS {key}) FROM {block} WHERE {k} % 13 = 0))"""


_EARLIER = {
    "products": _earlier_sql("products", "stg_products", "product_weight_g", "77"),
    "order_items": _earlier_sql("order_items", "stg_items", "price", "77"),
    "reviews": _earlier_sql("reviews", "stg_reviews", "review_comment_message", "'77'"),
}
_NOW = {"products": "stg_products", "order_items": "stg_items", "reviews": "stg_reviews"}


def _change_sql(name: str) -> str:
    """Key and change of every row, by a full join over all columns."""
    key = CONTRACTS[name].key
    on = " AND ".join(f"w.{c} = n.{c}" for c in key)
    differs = " OR ".join(f"w.{c} IS DISTINCT FROM n.{c}" for c in CONTRACTS[name].column_names if c not in key)
    keys = ", ".join(f"coalesce(n.{c}, w.{c}) AS {c}" for c in key)
    return f"""SELECT {keys}, CASE WHEN w.{key[0]} IS NULL THEN 'insert' WHEN n.{key[0]} IS NULL THEN 'delete' WHEN {differs} THEN 'update' ELSE 'unchanged' END AS Change
        FROM was w FULL JOIN {_NOW[name]} n ON {on}"""


def _count_sql(name: str) -> str:
    counts = ", ".join(f"count(*) FILTER (Change = '{kind}') AS {column}" for column, kind in (("Inserted", "insert"), ("Updated", "update"), ("Deleted", "delete"), ("Unchanged", "unchanged")))
    return f"SELECT '{name}' AS Dataset, {counts} FROM (WITH {_EARLIER[name].strip()} {_change_sql(name)})"


_SNAPSHOTS = " UNION ALL ".join(
    f"""SELECT product_id, {i} AS i, TIMESTAMP '{at}' AS since, (CAST(product_id AS BIGINT) + {i}) % 9 <> 0 AS there,
        CASE WHEN CAST(product_id AS BIGINT) % 4 <> 0 THEN CAST(product_id AS BIGINT) * {i} % 3 END AS photos FROM stg_products"""
    for i, at in enumerate(HISTORY, 1)
)
# A version begins where a member appears or changes, and ends at the next load that does not have it as it was.
_VERSIONS = f"""
    snapshots AS ({_SNAPSHOTS}),
    steps AS (
        SELECT *, coalesce(lag(there) OVER w, false) AS was_there, lag(photos) OVER w AS was FROM snapshots WINDOW w AS (PARTITION BY product_id ORDER BY i)),
    breaks AS (SELECT *, there <> was_there OR (there AND photos IS DISTINCT FROM was) AS is_break FROM steps),
    starts AS (SELECT *, lead(since) OVER (PARTITION BY product_id ORDER BY i) AS ends FROM breaks WHERE is_break),
    versions AS (
        SELECT product_id, photos, since, ends, row_number() OVER (PARTITION BY product_id ORDER BY i) AS version FROM starts WHERE there)"""

_AMOUNTS = {
    "FactOrder": ("fact_order", "sum(CASE WHEN OrderStatus = 'created' THEN 1 ELSE 0 END)"),
    "FactOrderItem": ("fact_item", "sum(PriceAmount)"),
    "FactPayment": ("fact_payment", "sum(PaymentAmount)"),
    "FactReview": ("fact_review", "sum(DuplicateReviewIDFlag)"),
}


def _months_sql() -> str:
    month = "strftime(order_purchase_timestamp, '%Y%m')"
    status, price = (", ".join(f"'{m}'" for m in months) for months in (STATUS_MONTHS, PRICE_MONTHS))
    touched = f"""touched AS (
        SELECT DISTINCT {month} AS m FROM stg_orders o WHERE {_K} % 29 = 0 AND {month} IN ({status})
        UNION SELECT DISTINCT {month} FROM stg_orders o JOIN stg_items USING (order_id) WHERE {_K} % 31 = 0 AND {month} IN ({price}))"""
    parts = " UNION ALL ".join(
        f"""SELECT '{name}' AS Fact, PurchaseDateKey // 100 AS PurchaseMonth, count(*) AS RowCount, CAST({amount} AS DOUBLE) AS Amount,
            CAST(CAST(PurchaseDateKey // 100 AS VARCHAR) IN (SELECT m FROM touched) AS BIGINT) AS Replaced FROM {block} GROUP BY 2"""
        for name, (block, amount) in _AMOUNTS.items()
    )
    return _blocks(touched, parts)


ORACLE = {
    "inc_01_watermark_load": f"""SELECT order_id, customer_id, order_status, {moment('order_purchase_timestamp')} AS order_purchase_timestamp,
        {moment('order_delivered_customer_date')} AS order_delivered_customer_date FROM stg_orders""",
    "inc_01_load_report": _blocks(
        _LOADS,
        f"""SELECT 1 AS Load, count(*) AS RowsRead, count(*) AS Inserted, 0 AS Updated, 0 AS Unchanged, 0 AS Late,
                   count(DISTINCT strftime(mark, '%Y%m')) AS ReplacedMonths, 0 AS KeptMonths, (SELECT count(*) FROM stg_orders) AS RowsStored FROM first
        UNION ALL SELECT 2, count(*), count(*) FILTER (kind = 'insert'), count(*) FILTER (kind = 'update'), count(*) FILTER (kind = 'same'),
                   count(*) FILTER (kind = 'insert' AND mark < first_mark), (SELECT count(*) FROM replaced),
                   (SELECT count(DISTINCT strftime(mark, '%Y%m')) FROM first WHERE strftime(mark, '%Y%m') NOT IN (SELECT m FROM replaced)),
                   (SELECT count(*) FROM stg_orders) FROM again
        UNION ALL SELECT 3, count(*), 0, 0, count(*), 0, 0, (SELECT count(DISTINCT strftime(order_purchase_timestamp, '%Y%m')) FROM stg_orders),
                   (SELECT count(*) FROM stg_orders)
        FROM stg_orders CROSS JOIN marks WHERE order_purchase_timestamp >= last_mark - INTERVAL {LOOKBACK.days} DAY""",
    ),
    "inc_02_change_counts": " UNION ALL ".join(_count_sql(n) for n in _NOW),
    "inc_02_changed_products": _blocks(_EARLIER["products"], f"SELECT * FROM ({_change_sql('products')}) WHERE Change <> 'unchanged'"),
    "inc_02_changed_reviews": _blocks(_EARLIER["reviews"], f"SELECT * FROM ({_change_sql('reviews')}) WHERE Change <> 'unchanged'"),
    "inc_03_dimension_upsert": """
        SELECT 0 AS ProductKey, NULL AS ProductID, NULL AS ProductPhotosQty
        UNION ALL SELECT row_number() OVER (ORDER BY product_id), product_id,
               CASE WHEN CAST(product_id AS BIGINT) % 7 = 0 THEN 0 ELSE product_photos_qty END FROM stg_products WHERE CAST(product_id AS BIGINT) % 5 <> 0
        UNION ALL SELECT (SELECT count(*) FROM stg_products WHERE CAST(product_id AS BIGINT) % 5 <> 0) + row_number() OVER (ORDER BY product_id), product_id, product_photos_qty
        FROM stg_products WHERE CAST(product_id AS BIGINT) % 5 = 0""",
    "inc_04_member_history": _blocks(
        _VERSIONS, f"SELECT product_id AS ProductID, photos AS Photos, {moment('since')} AS ValidFrom, {moment('ends')} AS ValidTo, version AS Version FROM versions"
    ),
    "inc_04_member_at_purchase": _blocks(
        _VERSIONS,
        """SELECT i.order_id, CAST(i.order_item_id AS BIGINT) AS order_item_id, i.product_id AS ProductID, v.photos AS Photos, v.version AS Version
        FROM stg_items i JOIN stg_orders o ON o.order_id = i.order_id
        LEFT JOIN versions v ON v.product_id = i.product_id AND v.since <= o.order_purchase_timestamp AND (v.ends IS NULL OR o.order_purchase_timestamp < v.ends)""",
    ),
    "inc_05_replaced_months": _months_sql(),
    "inc_05_fact_order_item": f"""SELECT OrderID, CAST(OrderItemID AS BIGINT) AS OrderItemID, ProductKey, SellerKey, CustomerKey, CustomerGeographyKey, PurchaseDateKey, ShippingLimitDateKey,
        OrderStatus, {moment('ShippingLimitTimestamp')} AS ShippingLimitTimestamp, CAST(PriceAmount AS DOUBLE) AS PriceAmount, CAST(FreightAmount AS DOUBLE) AS FreightAmount,
        CAST(OrderItemCount AS BIGINT) AS OrderItemCount FROM fact_item""",
    "rec_02_stored_differences": " UNION ALL ".join(
        f"SELECT '{n}' AS Target, count(*) AS ExpectedRows, count(*) AS ActualRows, 0 AS SourceToTargetDifferences, 0 AS TargetToSourceDifferences FROM {block}"
        for n, (block, _) in _AMOUNTS.items()
    )
    + """ UNION ALL SELECT 'Altered', count(*), count(*) FILTER (PaymentSequential <> 4), count(*) FILTER (PaymentSequential IN (3, 4)),
        count(*) FILTER (PaymentSequential = 3) FROM fact_payment""",
}
