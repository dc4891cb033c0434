"""The driver's tables in the roles of the retail sources.

Every view exists twice, as a DataFrame and as SQL text for the checking
engine, with the same integer and text arithmetic, so both sides see the same
rows. Anomalies (ties, gaps, missing values, early reviews) come out of the
arithmetic on the keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stallkeep.plans.checks import STATE_CODES

# City spellings.
CITIES = (
    "são paulo", "sao-paulo", "SAO PAULO",
    "rio de janeiro", "Rio-de-Janeiro", "RIO DE JANEIRO",
    "belo horizonte", "Belo-Horizonte", "BELO HORIZONTE",
    "santa bárbara d'oeste", "santa barbara doeste", "Santa Bárbara d'Oeste",
    "brasília", "brasilia", "BRASILIA",
    "mogi-guaçu", "mogi guacu", "MOGI GUACU",
)
PAYMENT_TYPES = ("credit_card", "boleto", "voucher", "debit_card", "not_defined")
STATUSES = {"F": "delivered", "O": "shipped", "P": "canceled"}

DRIVER_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)
ROLES = (
    "orders", "order_items", "products", "category_translation", "customers",
    "sellers", "payments", "reviews", "geolocation", "localization",
)


def driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _sql_list(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def _pick(values, index: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (index + 1).cast("int"))


def _id(column: str) -> Column:
    return F.lpad(F.col(column).cast("string"), 10, "0")


def _zip(number: Column) -> Column:
    return F.lpad(number.cast("string"), 5, "0")


def _seconds(n: Column) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), n.cast("decimal(18,6)"))


def _days(n: Column) -> Column:
    return F.make_dt_interval(n.cast("int"))


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem brought to one row per (order, line): the natural key of the items role."""
    lines = driver_table(spark, sf_dir, "lineitem")
    return lines.groupBy("l_orderkey", "l_linenumber").agg(
        F.min("l_partkey").alias("pk"),
        F.max("l_suppkey").alias("sk"),
        F.min("l_shipdate").alias("ship"),
        F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("decimal(18,2)").alias("price"),
        F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("decimal(18,2)").alias("qty"),
    )


SQL_LINES = """
SELECT l_orderkey, l_linenumber, min(l_partkey) AS pk, max(l_suppkey) AS sk, min(l_shipdate) AS ship,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS price,
       CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS qty
FROM lineitem GROUP BY l_orderkey, l_linenumber
"""


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    shipped = driver_table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.min("l_shipdate").alias("lo"), F.max("l_shipdate").alias("hi")
    )
    placed = F.col("o_orderdate") + _seconds(key * 7919 % 86400)
    delivered = F.col("hi") + _seconds(key * 31 % 86400)
    status = F.when(F.col("o_orderstatus") == "F", "delivered").when(F.col("o_orderstatus") == "O", "shipped").otherwise("canceled")
    estimate = (
        F.when(key % 13 == 0, delivered.cast("date"))
        .when(key % 17 == 0, F.lit(None).cast("date"))
        .otherwise(F.date_add(F.col("o_orderdate").cast("date"), 400))
    )
    return driver_table(spark, sf_dir, "orders").join(shipped, "o_orderkey", "left").select(
        _id("o_orderkey").alias("order_id"),
        _id("o_custkey").alias("customer_id"),
        status.alias("order_status"),
        placed.alias("order_purchase_timestamp"),
        F.when(key % 11 != 0, placed + _days(key % 3)).alias("order_approved_at"),
        F.col("lo").alias("order_delivered_carrier_date"),
        delivered.alias("order_delivered_customer_date"),
        estimate.alias("order_estimated_delivery_date"),
    )


SQL_ORDERS = """
SELECT lpad(CAST(o_orderkey AS VARCHAR), 10, '0') AS order_id, lpad(CAST(o_custkey AS VARCHAR), 10, '0') AS customer_id,
       CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped' ELSE 'canceled' END AS order_status,
       o_orderdate + to_seconds(o_orderkey * 7919 % 86400) AS order_purchase_timestamp,
       CASE WHEN o_orderkey % 11 <> 0 THEN o_orderdate + to_seconds(o_orderkey * 7919 % 86400) + to_days(CAST(o_orderkey % 3 AS INTEGER)) END AS order_approved_at,
       lo AS order_delivered_carrier_date,
       hi + to_seconds(o_orderkey * 31 % 86400) AS order_delivered_customer_date,
       CASE WHEN o_orderkey % 13 = 0 THEN CAST(hi + to_seconds(o_orderkey * 31 % 86400) AS DATE)
            WHEN o_orderkey % 17 = 0 THEN NULL
            ELSE CAST(o_orderdate AS DATE) + 400 END AS order_estimated_delivery_date
FROM orders LEFT JOIN (SELECT l_orderkey, min(l_shipdate) AS lo, max(l_shipdate) AS hi FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey
"""


def order_items(spark: SparkSession, sf_dir: str, lines: DataFrame) -> DataFrame:
    return lines.select(
        _id("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        _id("pk").alias("product_id"),
        _id("sk").alias("seller_id"),
        F.col("ship").alias("shipping_limit_date"),
        "price",
        F.when(F.col("pk") % 97 == 0, F.lit(0)).otherwise(F.col("qty")).cast("decimal(18,2)").alias("freight_value"),
    )


SQL_ITEMS = """
SELECT lpad(CAST(l_orderkey AS VARCHAR), 10, '0') AS order_id, l_linenumber AS order_item_id,
       lpad(CAST(pk AS VARCHAR), 10, '0') AS product_id, lpad(CAST(sk AS VARCHAR), 10, '0') AS seller_id,
       ship AS shipping_limit_date, price, CAST(CASE WHEN pk % 97 = 0 THEN 0 ELSE qty END AS DECIMAL(18,2)) AS freight_value
FROM stg_lines
"""


def payments(spark: SparkSession, sf_dir: str, lines: DataFrame) -> DataFrame:
    pk = F.col("pk")
    freight = F.when(pk % 97 == 0, F.lit(0)).otherwise(F.col("qty")).cast("decimal(18,2)")
    extra = F.when(pk % 10 < 3, pk % 300).otherwise(0).cast("decimal(10,2)") * F.lit("0.01").cast("decimal(3,2)")
    value = F.when(pk % 89 == 0, F.lit(0)).otherwise(F.col("price") + freight + extra)
    return lines.select(
        _id("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("payment_sequential"),
        _pick(PAYMENT_TYPES, pk % 5).alias("payment_type"),
        (pk % 4).cast("int").alias("payment_installments"),
        value.cast("decimal(18,2)").alias("payment_value"),
    )


SQL_PAYMENTS = f"""
SELECT lpad(CAST(l_orderkey AS VARCHAR), 10, '0') AS order_id, l_linenumber AS payment_sequential,
       list_extract({_sql_list(PAYMENT_TYPES)}, CAST(pk % 5 + 1 AS INTEGER)) AS payment_type,
       CAST(pk % 4 AS INTEGER) AS payment_installments,
       CAST(CASE WHEN pk % 89 = 0 THEN 0
            ELSE price + CAST(CASE WHEN pk % 97 = 0 THEN 0 ELSE qty END AS DECIMAL(18,2))
                 + CAST(CASE WHEN pk % 10 < 3 THEN pk % 300 ELSE 0 END AS DECIMAL(10,2)) * CAST(0.01 AS DECIMAL(3,2)) END AS DECIMAL(18,2)) AS payment_value
FROM stg_lines
"""


def reviews(spark: SparkSession, sf_dir: str, lines: DataFrame) -> DataFrame:
    key, line = F.col("l_orderkey"), F.col("l_linenumber")
    purchases = driver_table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    reviewed = lines.join(purchases, "l_orderkey")
    shared = (F.when(key % 9 == 1, key - 1).otherwise(key) * 10 + line).cast("string")
    created = F.col("o_orderdate") + _days(key % 60 - 3)
    return reviewed.select(
        F.concat(F.lit("r"), F.lpad(shared, 12, "0")).alias("review_id"),
        _id("l_orderkey").alias("order_id"),
        ((key + line) % 5 + 1).cast("int").alias("review_score"),
        F.when(key % 4 == 0, F.lit(None)).when(key % 4 == 1, F.lit(" ")).otherwise(F.concat(F.lit("title "), key % 7)).alias("review_comment_title"),
        F.when(key % 3 == 0, F.lit(None)).otherwise(F.concat(F.lit("message "), key, F.lit('\n"so so", ok  '))).alias("review_comment_message"),
        created.alias("review_creation_date"),
        (created + _seconds(key % 7 * 46800)).alias("review_answer_timestamp"),
    )


SQL_REVIEWS = """
SELECT 'r' || lpad(CAST((CASE WHEN l_orderkey % 9 = 1 THEN l_orderkey - 1 ELSE l_orderkey END) * 10 + l_linenumber AS VARCHAR), 12, '0') AS review_id,
       lpad(CAST(l_orderkey AS VARCHAR), 10, '0') AS order_id,
       CAST((l_orderkey + l_linenumber) % 5 + 1 AS INTEGER) AS review_score,
       CASE WHEN l_orderkey % 4 = 0 THEN NULL WHEN l_orderkey % 4 = 1 THEN ' ' ELSE 'title ' || CAST(l_orderkey % 7 AS VARCHAR) END AS review_comment_title,
       CASE WHEN l_orderkey % 3 = 0 THEN NULL ELSE 'message ' || CAST(l_orderkey AS VARCHAR) || chr(10) || '"so so", ok  ' END AS review_comment_message,
       o_orderdate + to_days(CAST(l_orderkey % 60 - 3 AS INTEGER)) AS review_creation_date,
       o_orderdate + to_days(CAST(l_orderkey % 60 - 3 AS INTEGER)) + to_seconds(l_orderkey % 7 * 46800) AS review_answer_timestamp
FROM stg_lines JOIN orders ON l_orderkey = o_orderkey
"""


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    zip_number = key * 13 % 3100
    return driver_table(spark, sf_dir, "customer").select(
        _id("c_custkey").alias("customer_id"),
        F.concat(F.lit("u"), F.lpad(F.when(key % 4 == 3, key - 1).otherwise(key).cast("string"), 10, "0")).alias("customer_unique_id"),
        _zip(zip_number).alias("customer_zip_code_prefix"),
        _pick(CITIES, zip_number % 6 * 3 + key % 3).alias("customer_city"),
        _pick(STATE_CODES, (zip_number + key % 2) % 27).alias("customer_state"),
    )


SQL_CUSTOMERS = f"""
SELECT lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS customer_id,
       'u' || lpad(CAST(CASE WHEN c_custkey % 4 = 3 THEN c_custkey - 1 ELSE c_custkey END AS VARCHAR), 10, '0') AS customer_unique_id,
       lpad(CAST(c_custkey * 13 % 3100 AS VARCHAR), 5, '0') AS customer_zip_code_prefix,
       list_extract({_sql_list(CITIES)}, CAST(c_custkey * 13 % 3100 % 6 * 3 + c_custkey % 3 + 1 AS INTEGER)) AS customer_city,
       list_extract({_sql_list(STATE_CODES)}, CAST((c_custkey * 13 % 3100 + c_custkey % 2) % 27 + 1 AS INTEGER)) AS customer_state
FROM customer
"""


def sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("s_suppkey")
    zip_number = key * 29 % 3100
    return driver_table(spark, sf_dir, "supplier").select(
        _id("s_suppkey").alias("seller_id"),
        _zip(zip_number).alias("seller_zip_code_prefix"),
        _pick(CITIES, (zip_number + F.when(key % 7 == 0, 1).otherwise(0)) % 6 * 3 + key % 3).alias("seller_city"),
        _pick(STATE_CODES, (zip_number + F.when(key % 10 == 0, 5).otherwise(0)) % 27).alias("seller_state"),
    )


SQL_SELLERS = f"""
SELECT lpad(CAST(s_suppkey AS VARCHAR), 10, '0') AS seller_id,
       lpad(CAST(s_suppkey * 29 % 3100 AS VARCHAR), 5, '0') AS seller_zip_code_prefix,
       list_extract({_sql_list(CITIES)}, CAST((s_suppkey * 29 % 3100 + CASE WHEN s_suppkey % 7 = 0 THEN 1 ELSE 0 END) % 6 * 3 + s_suppkey % 3 + 1 AS INTEGER)) AS seller_city,
       list_extract({_sql_list(STATE_CODES)}, CAST((s_suppkey * 29 % 3100 + CASE WHEN s_suppkey % 10 = 0 THEN 5 ELSE 0 END) % 27 + 1 AS INTEGER)) AS seller_state
FROM supplier
"""


def geolocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    order, line = F.col("l_orderkey"), F.col("l_linenumber")
    zip_number = F.col("l_partkey") % 3000
    state = (zip_number + F.when(zip_number % 4 == 0, order % 3).otherwise(0)) % 27
    city = (zip_number + F.when(zip_number % 5 == 0, line % 2).otherwise(0)) % 6 * 3 + order % 3
    lat = zip_number % 100 * 200 + (order * 7 + line) % 97 - 30000
    lng = zip_number % 150 * 100 + order % 89 - 60000
    return driver_table(spark, sf_dir, "lineitem").select(
        _zip(zip_number).alias("geolocation_zip_code_prefix"),
        (lat / 1000).cast("decimal(28,20)").alias("geolocation_lat"),
        (lng / 1000).cast("decimal(28,20)").alias("geolocation_lng"),
        _pick(CITIES, city).alias("geolocation_city"),
        _pick(STATE_CODES, state).alias("geolocation_state"),
    )


SQL_GEOLOCATION = f"""
SELECT lpad(CAST(l_partkey % 3000 AS VARCHAR), 5, '0') AS geolocation_zip_code_prefix,
       (l_partkey % 3000 % 100 * 200 + (l_orderkey * 7 + l_linenumber) % 97 - 30000) / 1000 AS geolocation_lat,
       (l_partkey % 3000 % 150 * 100 + l_orderkey % 89 - 60000) / 1000 AS geolocation_lng,
       list_extract({_sql_list(CITIES)}, CAST((l_partkey % 3000 + CASE WHEN l_partkey % 3000 % 5 = 0 THEN l_linenumber % 2 ELSE 0 END) % 6 * 3 + l_orderkey % 3 + 1 AS INTEGER)) AS geolocation_city,
       list_extract({_sql_list(STATE_CODES)}, CAST((l_partkey % 3000 + CASE WHEN l_partkey % 3000 % 4 = 0 THEN l_orderkey % 3 ELSE 0 END) % 27 + 1 AS INTEGER)) AS geolocation_state
FROM lineitem
"""


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, size = F.col("p_partkey"), F.col("p_size")
    category = F.when(
        key % 50 != 0, F.lower(F.concat(F.col("p_type"), F.lit("_"), F.replace(F.col("p_brand"), F.lit("#"), F.lit(""))))
    )
    return driver_table(spark, sf_dir, "part").select(
        _id("p_partkey").alias("product_id"),
        category.alias("product_category_name"),
        F.when(key % 50 != 0, F.length("p_name")).alias("product_name_lenght"),
        F.when(key % 50 != 0, key % 700).cast("int").alias("product_description_lenght"),
        (key % 6).cast("int").alias("product_photos_qty"),
        F.when(key % 301 == 0, 0).when(key % 401 != 0, size * 100).alias("product_weight_g"),
        F.when(key % 401 != 0, size + 10).alias("product_length_cm"),
        (size + 2).alias("product_height_cm"),
        (size + 5).alias("product_width_cm"),
    )


SQL_PRODUCTS = """
SELECT lpad(CAST(p_partkey AS VARCHAR), 10, '0') AS product_id,
       CASE WHEN p_partkey % 50 <> 0 THEN lower(p_type || '_' || replace(p_brand, '#', '')) END AS product_category_name,
       CAST(CASE WHEN p_partkey % 50 <> 0 THEN length(p_name) END AS INTEGER) AS product_name_lenght,
       CAST(CASE WHEN p_partkey % 50 <> 0 THEN p_partkey % 700 END AS INTEGER) AS product_description_lenght,
       CAST(p_partkey % 6 AS INTEGER) AS product_photos_qty,
       CASE WHEN p_partkey % 301 = 0 THEN 0 WHEN p_partkey % 401 <> 0 THEN p_size * 100 END AS product_weight_g,
       CASE WHEN p_partkey % 401 <> 0 THEN p_size + 10 END AS product_length_cm,
       p_size + 2 AS product_height_cm, p_size + 5 AS product_width_cm
FROM part
"""


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return products(spark, sf_dir).select("product_category_name").filter("product_category_name IS NOT NULL").distinct()


def category_translation(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.col("product_category_name")
    known = _labels(spark, sf_dir).filter(~label.endswith("brand7")).select(label, F.concat(F.lit("en "), label).alias("product_category_name_english"))
    regions = driver_table(spark, sf_dir, "region").select(
        F.concat(F.lit("unused_"), F.lower("r_name")).alias("product_category_name"), F.lit("en unused").alias("product_category_name_english")
    )
    return known.unionByName(regions)


SQL_TRANSLATION = """
SELECT DISTINCT product_category_name, 'en ' || product_category_name AS product_category_name_english
FROM stg_products WHERE product_category_name NOT LIKE '%brand7'
UNION ALL SELECT 'unused_' || lower(r_name), 'en unused' FROM region
"""


def localization(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.col("product_category_name")
    return _labels(spark, sf_dir).select(
        label.alias("SourceCategoryName"),
        F.when(label.endswith("brand3"), F.lit("  ")).otherwise(F.concat(F.lit("fa "), label)).alias("PersianCategoryName"),
    )


SQL_LOCALIZATION = """
SELECT DISTINCT product_category_name AS SourceCategoryName,
       CASE WHEN product_category_name LIKE '%brand3' THEN '  ' ELSE 'fa ' || product_category_name END AS PersianCategoryName
FROM stg_products WHERE product_category_name IS NOT NULL
"""

BUILDERS = {
    "orders": orders,
    "order_items": order_items,
    "products": products,
    "category_translation": category_translation,
    "customers": customers,
    "sellers": sellers,
    "payments": payments,
    "reviews": reviews,
    "geolocation": geolocation,
    "localization": localization,
}


# Roles whose rows are order lines.
OF_LINES = ("order_items", "payments", "reviews")


def role(spark: SparkSession, sf_dir: str, name: str, lines: DataFrame | None = None) -> DataFrame:
    """The role view itself, lazily over the driver's tables and, if they are at hand, the ``order_lines``."""
    if name in OF_LINES:
        return BUILDERS[name](spark, sf_dir, order_lines(spark, sf_dir) if lines is None else lines)
    return BUILDERS[name](spark, sf_dir)
