"""What each source file must look like: columns in order, their roles, the key."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

TEXT, STAMP, DAY, WHOLE = "text", "timestamp", "date", "integer"
MONEY, DEGREES = "decimal(18,2)", "decimal(28,20)"


@dataclass(frozen=True)
class Contract:
    name: str
    columns: tuple[tuple[str, str], ...]
    key: tuple[str, ...] = ()
    # Set where quoted values may contain line breaks; such files cannot be split.
    multiline: bool = False

    @property
    def column_names(self) -> list[str]:
        return [name for name, _ in self.columns]

    @property
    def text_schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, T.StringType()) for c in self.column_names])


# Column names, roles and keys of the nine data sets.
CONTRACTS: dict[str, Contract] = {
    c.name: c
    for c in (
        Contract(
            "orders",
            (
                ("order_id", TEXT),
                ("customer_id", TEXT),
                ("order_status", TEXT),
                ("order_purchase_timestamp", STAMP),
                ("order_approved_at", STAMP),
                ("order_delivered_carrier_date", STAMP),
                ("order_delivered_customer_date", STAMP),
                ("order_estimated_delivery_date", DAY),
            ),
            key=("order_id",),
        ),
        Contract(
            "order_items",
            (
                ("order_id", TEXT),
                ("order_item_id", WHOLE),
                ("product_id", TEXT),
                ("seller_id", TEXT),
                ("shipping_limit_date", STAMP),
                ("price", MONEY),
                ("freight_value", MONEY),
            ),
            key=("order_id", "order_item_id"),
        ),
        Contract(
            "products",
            (
                ("product_id", TEXT),
                ("product_category_name", TEXT),
                ("product_name_lenght", WHOLE),
                ("product_description_lenght", WHOLE),
                ("product_photos_qty", WHOLE),
                ("product_weight_g", WHOLE),
                ("product_length_cm", WHOLE),
                ("product_height_cm", WHOLE),
                ("product_width_cm", WHOLE),
            ),
            key=("product_id",),
        ),
        Contract(
            "category_translation",
            (
                ("product_category_name", TEXT),
                ("product_category_name_english", TEXT),
            ),
            key=("product_category_name",),
        ),
        Contract(
            "customers",
            (
                ("customer_id", TEXT),
                ("customer_unique_id", TEXT),
                ("customer_zip_code_prefix", TEXT),
                ("customer_city", TEXT),
                ("customer_state", TEXT),
            ),
            key=("customer_id",),
        ),
        Contract(
            "sellers",
            (
                ("seller_id", TEXT),
                ("seller_zip_code_prefix", TEXT),
                ("seller_city", TEXT),
                ("seller_state", TEXT),
            ),
            key=("seller_id",),
        ),
        Contract(
            "payments",
            (
                ("order_id", TEXT),
                ("payment_sequential", WHOLE),
                ("payment_type", TEXT),
                ("payment_installments", WHOLE),
                ("payment_value", MONEY),
            ),
            key=("order_id", "payment_sequential"),
        ),
        Contract(
            "reviews",
            (
                ("review_id", TEXT),
                ("order_id", TEXT),
                ("review_score", WHOLE),
                ("review_comment_title", TEXT),
                ("review_comment_message", TEXT),
                ("review_creation_date", STAMP),
                ("review_answer_timestamp", STAMP),
            ),
            key=("review_id", "order_id"),
            multiline=True,
        ),
        Contract(
            "geolocation",
            (
                ("geolocation_zip_code_prefix", TEXT),
                ("geolocation_lat", DEGREES),
                ("geolocation_lng", DEGREES),
                ("geolocation_city", TEXT),
                ("geolocation_state", TEXT),
            ),
        ),
    )
}


def contract_for(name: str) -> Contract:
    if name not in CONTRACTS:
        raise ValueError(f"unknown data set {name!r}; known: {', '.join(CONTRACTS)}")
    return CONTRACTS[name]
