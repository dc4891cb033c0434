"""Text files in, checked tables out.

The text files are written once per session from the role views, in the
format of the sources, and then go through the library's own ingestion.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stallkeep.operators.quality import completeness, union_all
from stallkeep.queries.built import staged_store, staging, warehouse
from stallkeep.queries.oracle import day, moment
from stallkeep.queries.roles import driver_table
from stallkeep.session import scratch_path
from stallkeep.sources import CONTRACTS, Store, ingest, key_gate, load_table, scan_csv, typed
from stallkeep.sources.ingest import cast_failures, malformed_lines

_files: dict[tuple[str, str, str], str] = {}


def text_file(spark, sf_dir: str, name: str) -> str:
    """A role view as a text file in the source format."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _files:
        table = staging(spark, sf_dir)[name].select(*CONTRACTS[name].column_names)
        path = scratch_path(spark, f"text-{name}")
        (
            table.write.option("header", True)
            .option("quote", '"')
            .option("escape", '"')
            .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss")
            .option("ignoreLeadingWhiteSpace", False)
            .option("ignoreTrailingWhiteSpace", False)
            .csv(path)
        )
        _files[key] = path
    return _files[key]


def _scan(s, d, name: str) -> DataFrame:
    return scan_csv(s, text_file(s, d, name), CONTRACTS[name])


def _typed(s, d, name: str) -> DataFrame:
    return typed(_scan(s, d, name), CONTRACTS[name])


def _registry(s, d) -> DataFrame:
    t = staging(s, d)
    return union_all(
        [
            t[c.name].agg(F.count("*").alias("TableRows")).select(
                F.lit(c.name).alias("Dataset"),
                F.lit(len(c.columns)).alias("ColumnCount"),
                F.lit(",".join(c.key)).alias("KeyColumns"),
                "TableRows",
            )
            for c in CONTRACTS.values()
        ]
    )


def _header_contract(s, d) -> DataFrame:
    """Rows of each text file behind a header that keeps its contract (a broken one raises)."""
    return union_all(
        [_scan(s, d, n).agg(F.count("*").alias("TextRows")).select(F.lit(n).alias("Dataset"), "TextRows") for n in CONTRACTS]
    )


def _staging_completeness(s, d):
    """Rows stored of each of the nine data sets against the records of its text file, and a data set nobody loaded."""
    expected = [_scan(s, d, n).agg(F.count("*").alias("ExpectedRows")).select(F.lit(n).alias("DatasetName"), "ExpectedRows") for n in CONTRACTS]
    unloaded = _scan(s, d, "sellers").agg(F.count("*").alias("ExpectedRows")).select(F.lit("returns").alias("DatasetName"), "ExpectedRows")
    return completeness({n: staging(s, d)[n] for n in CONTRACTS}, union_all([*expected, unloaded]))


# Every so many orders, the items of one are broken in the text: a field short, two too many, or an open quote.
_BROKEN_EVERY = 29


def _malformed_lines(s, d) -> DataFrame:
    """Lines of an items file that the scan refuses, some of them broken by key arithmetic."""
    contract = CONTRACTS["order_items"]
    items = staging(s, d)["order_items"].select(*contract.column_names)
    line = F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in contract.column_names])
    key = F.col("order_id").cast("long") % _BROKEN_EVERY
    broken = F.when(key == 0, F.substring_index(line, ",", 6)).when(key == 1, F.concat(line, F.lit(",x,y"))).when(key == 2, F.concat(F.lit('"'), line)).otherwise(line)
    path = scratch_path(s, "text-broken")
    header = ",".join(contract.column_names)
    # Lines go out as they are: no character of theirs is the separator or the quote of this writer.
    items.select(broken.alias(header)).write.option("header", True).option("sep", "\u0001").option("quote", "").csv(path)
    return malformed_lines(s, path, contract)


def _cast_failures(s, d) -> DataFrame:
    """Unreadable values per typed column of the items file."""
    failed = cast_failures(_scan(s, d, "order_items"), CONTRACTS["order_items"])
    rows = F.array(*[F.struct(F.lit(c).alias("ColumnName"), F.col(c).alias("Failures")) for c in failed.columns])
    return failed.select(F.inline(rows))


def _key_gates(s, d) -> DataFrame:
    t = staging(s, d)
    parts = [
        key_gate(t[c.name], c.key).select(F.lit(c.name).alias("Dataset"), "NullKeyRows", "DuplicateKeyRows")
        for c in CONTRACTS.values()
        if c.key
    ]
    raw = key_gate(driver_table(s, d, "lineitem"), ["l_orderkey", "l_linenumber"])
    parts.append(raw.select(F.lit("lineitem").alias("Dataset"), "NullKeyRows", "DuplicateKeyRows"))
    return reduce(DataFrame.unionByName, parts)


def _loaded(s, d) -> DataFrame:
    return ingest(s, text_file(s, d, "orders"), CONTRACTS["orders"], scratch_path(s, "load-orders"))


def _row_counts(s, d) -> DataFrame:
    """Rows of each driver table against the rows stored by a load of it."""
    parts = []
    for name in ("orders", "customer", "lineitem", "events"):
        source = driver_table(s, d, name)
        stored = load_table(source, scratch_path(s, f"load-{name}"), name)
        counts = [df.agg(F.count("*").alias("n")).withColumn("side", F.lit(side)) for df, side in ((source, "s"), (stored, "l"))]
        both = counts[0].unionByName(counts[1]).agg(
            F.max(F.when(F.col("side") == "s", F.col("n"))).alias("SourceRows"),
            F.max(F.when(F.col("side") == "l", F.col("n"))).alias("LoadedRows"),
        )
        parts.append(both.select(F.lit(name).alias("Dataset"), "SourceRows", "LoadedRows"))
    return union_all(parts)


def _sink(s, d) -> DataFrame:
    """A fact written by month, published, and read back through the store."""
    store: Store = staged_store(s, d)
    run = store.new_run()
    month = F.floor(F.col("PurchaseDateKey") / 100).cast("int")
    payments = warehouse(s, d)["FactPayment"].withColumn("PurchaseMonth", month)
    store.write(run, "PaymentSink", payments.hint("rebalance", "PurchaseMonth"), ["PurchaseMonth"])
    store.publish(run, ["PaymentSink"])
    return store.table("PaymentSink").groupBy("PurchaseMonth").agg(
        F.count("*").alias("Payments"), F.sum("PaymentAmount").alias("PaymentAmount")
    )


QUERIES = {
    "ing_01_registry": _registry,
    "ing_02_csv_scan": lambda s, d: _scan(s, d, "reviews"),
    "ing_02_malformed_lines": _malformed_lines,
    "ing_03_header_contract": _header_contract,
    "ing_04_timestamp_cast": lambda s, d: _typed(s, d, "orders").drop("order_estimated_delivery_date"),
    "ing_05_date_cast": lambda s, d: _typed(s, d, "orders").select("order_id", "order_estimated_delivery_date"),
    "ing_06_integer_cast": lambda s, d: _typed(s, d, "products"),
    "ing_07_decimal_cast": lambda s, d: _typed(s, d, "order_items").select("order_id", "order_item_id", "price", "freight_value"),
    "ing_07_cast_failures": _cast_failures,
    "ing_08_key_not_null": lambda s, d: _key_gates(s, d).drop("DuplicateKeyRows"),
    "ing_09_key_unique": lambda s, d: _key_gates(s, d).drop("NullKeyRows"),
    "ing_10_load": _loaded,
    "ing_11_loaded_row_counts": _row_counts,
    "ing_12_partitioned_sink": _sink,
    "dq_32_staging_completeness": _staging_completeness,
}

_BLOCK = {
    "orders": "stg_orders", "order_items": "stg_items", "products": "stg_products", "category_translation": "stg_translation",
    "customers": "stg_customers", "sellers": "stg_sellers", "payments": "stg_payments", "reviews": "stg_reviews", "geolocation": "stg_geolocation",
}
_STAMPS = ("order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date", "order_delivered_customer_date")
_ORDER_TEXT = "order_id, customer_id, order_status, " + ", ".join(f"{moment(c)} AS {c}" for c in _STAMPS)


def _gate(column: str, surplus: bool) -> str:
    parts = []
    for c in [*CONTRACTS.values(), None]:
        name, key, block = (c.name, c.key, _BLOCK[c.name]) if c else ("lineitem", ("l_orderkey", "l_linenumber"), "lineitem")
        if not key:
            continue
        keys = ", ".join(key)
        missing = " OR ".join(f"{k} IS NULL" for k in key)
        value = "coalesce(sum(n - 1), 0)" if surplus else f"coalesce(sum(CASE WHEN {missing} THEN n END), 0)"
        parts.append(f"SELECT '{name}' AS Dataset, CAST({value} AS BIGINT) AS {column} FROM (SELECT {keys}, count(*) AS n FROM {block} GROUP BY ALL)")
    return " UNION ALL ".join(parts)


ORACLE = {
    "ing_01_registry": " UNION ALL ".join(
        f"SELECT '{c.name}' AS Dataset, CAST({len(c.columns)} AS BIGINT) AS ColumnCount, '{','.join(c.key)}' AS KeyColumns, count(*) AS TableRows FROM {_BLOCK[c.name]}"
        for c in CONTRACTS.values()
    ),
    "ing_02_csv_scan": f"""SELECT review_id, order_id, CAST(review_score AS VARCHAR) AS review_score, review_comment_title, review_comment_message,
        {moment('review_creation_date')} AS review_creation_date, {moment('review_answer_timestamp')} AS review_answer_timestamp FROM stg_reviews""",
    "ing_02_malformed_lines": f"SELECT count(CASE WHEN CAST(order_id AS BIGINT) % {_BROKEN_EVERY} < 3 THEN 1 END) AS MalformedLines, count(*) AS Lines FROM stg_items",
    "ing_03_header_contract": " UNION ALL ".join(f"SELECT '{n}' AS Dataset, count(*) AS TextRows FROM {b}" for n, b in _BLOCK.items()),
    "ing_04_timestamp_cast": f"SELECT {_ORDER_TEXT} FROM stg_orders",
    "ing_05_date_cast": f"SELECT order_id, {day('order_estimated_delivery_date')} AS order_estimated_delivery_date FROM stg_orders",
    "ing_06_integer_cast": "SELECT product_id, product_category_name, " + ", ".join(
        f"CAST({c} AS BIGINT) AS {c}" for c in CONTRACTS["products"].column_names[2:]
    ) + " FROM stg_products",
    "ing_07_decimal_cast": "SELECT order_id, CAST(order_item_id AS BIGINT) AS order_item_id, CAST(price AS DOUBLE) AS price, CAST(freight_value AS DOUBLE) AS freight_value FROM stg_items",
    "ing_07_cast_failures": " UNION ALL ".join(
        f"SELECT '{c}' AS ColumnName, count(*) FILTER (WHERE {c} IS NOT NULL AND TRY_CAST(CAST({c} AS VARCHAR) AS {t}) IS NULL) AS Failures FROM stg_items"
        for c, t in (("order_item_id", "INTEGER"), ("shipping_limit_date", "TIMESTAMP"), ("price", "DECIMAL(18,2)"), ("freight_value", "DECIMAL(18,2)"))
    ),
    "ing_08_key_not_null": _gate("NullKeyRows", False),
    "ing_09_key_unique": _gate("DuplicateKeyRows", True),
    "ing_10_load": f"SELECT {_ORDER_TEXT}, {day('order_estimated_delivery_date')} AS order_estimated_delivery_date FROM stg_orders",
    "ing_11_loaded_row_counts": " UNION ALL ".join(
        f"SELECT '{n}' AS Dataset, count(*) AS SourceRows, count(*) AS LoadedRows FROM {n}" for n in ("orders", "customer", "lineitem", "events")
    ),
    "dq_32_staging_completeness": " UNION ALL ".join(
        f"SELECT '{n}' AS DatasetName, count(*) AS ActualRows, count(*) AS ExpectedRows, 'PASS' AS ValidationStatus FROM {b}" for n, b in _BLOCK.items()
    )
    + " UNION ALL SELECT 'returns', NULL, count(*), 'FAIL' FROM stg_sellers",
    "ing_12_partitioned_sink": "SELECT PurchaseDateKey // 100 AS PurchaseMonth, count(*) AS Payments, CAST(sum(PaymentAmount) AS DOUBLE) AS PaymentAmount FROM fact_payment GROUP BY 1",
}
