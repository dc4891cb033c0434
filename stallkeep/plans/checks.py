"""The staging and conformed checks, table by table.

All one-row audits of a table are merged into one pass over it and come out
as (metric, value) rows; checks that list groups are frames of their own.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallkeep.functions import is_blank, matches, text_length
from stallkeep.operators import quality as Q
from stallkeep.plans.geography import geography_profile, required_zip_coverage

Tables = Mapping[str, DataFrame]

# The 27 state codes.
STATE_CODES = (
    "AC", "AL", "AP", "AM", "BA", "CE", "DF", "ES", "GO", "MA", "MT", "MS", "MG", "PA",
    "PB", "PR", "PE", "PI", "RJ", "RN", "RS", "RO", "RR", "SC", "SP", "SE", "TO",
)
PRODUCT_NUMBERS = (
    "product_name_lenght", "product_description_lenght", "product_photos_qty", "product_weight_g",
    "product_length_cm", "product_height_cm", "product_width_cm",
)


def as_text(column: str, kind) -> Column:
    value = F.col(column).cast("string")
    return F.substring(value, 1, 19) if kind.typeName() in ("timestamp", "timestamp_ntz") else value


def long(one_row: DataFrame) -> DataFrame:
    """A one-row frame as (metric, value) rows, values as text."""
    cells = [
        F.struct(F.lit(f.name).alias("metric"), as_text(f.name, f.dataType).alias("value")) for f in one_row.schema.fields
    ]
    return one_row.select(F.inline(F.array(*cells)))


def nulls(df: DataFrame) -> dict[str, Column]:
    return {f"{c}_nulls": matches(F.col(c).isNull()) for c in df.columns}


def blanks(*columns: str) -> dict[str, Column]:
    return {f"{c}_blanks": matches(is_blank(c)) for c in columns}


def ranges(*columns: str) -> dict[str, Column]:
    return {f"{side}_{c}": f(c) for c in columns for side, f in (("min", F.min), ("max", F.max))}


def negatives(*columns: str) -> dict[str, Column]:
    return {f"{c}_negative": matches(F.col(c) < 0) for c in columns}


def zeros(*columns: str) -> dict[str, Column]:
    return {f"{c}_zero": matches(F.col(c) == 0) for c in columns}


def address(zip_code: str, state: str, city: str) -> dict[str, Column]:
    """Format checks every address carries."""
    return {
        "NonNumericZip": matches(F.col(zip_code).rlike("[^0-9]")),
        "InvalidZipLength": matches(text_length(zip_code) != 5),
        "InvalidStateLength": matches(text_length(state) != 2),
        "InvalidState": matches(~F.col(state).isin(*STATE_CODES)),
        "MaxCityLength": F.max(text_length(city)),
    }


def key_profile(df: DataFrame, key: Sequence[str], label: str) -> DataFrame:
    """Distinct keys, repeated keys, largest group and surplus rows from one grouping."""
    return Q.group_sizes(df, key).agg(
        matches(F.col(key[0]).isNotNull()).alias(f"Distinct_{label}"),
        matches(F.col("Rows") > 1).alias(f"Repeated_{label}"),
        F.max("Rows").alias(f"MaxRows_{label}"),
        F.sum(F.col("Rows") - 1).alias(f"Surplus_{label}"),
    )


def _count(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count("*").alias(name))


def _metrics(df: DataFrame, measures: Mapping[str, Column], *others: DataFrame) -> DataFrame:
    own = Q.audit(df, {"RowCount": F.count("*"), **nulls(df), **measures})
    return Q.union_all([long(one) for one in (own, *others)])


def orders_metrics(t: Tables) -> DataFrame:
    return _metrics(t["orders"], ranges("order_purchase_timestamp"), key_profile(t["orders"], ["order_id"], "order_id"))


def items_metrics(t: Tables) -> DataFrame:
    df = t["order_items"]
    return _metrics(
        df,
        {**ranges("price", "freight_value"), **zeros("freight_value"), **negatives("price", "freight_value")},
        key_profile(df, ["order_id", "order_item_id"], "item_key"),
        Q.orphan_count(df, t["orders"], "order_id", "order_id", name="OrphanOrders"),
        Q.orphan_count(df, t["products"], "product_id", "product_id", name="OrphanProducts"),
        Q.orphan_count(df, t["sellers"], "seller_id", "seller_id", name="OrphanSellers"),
    )


def products_metrics(t: Tables) -> DataFrame:
    df, sizes = t["products"], PRODUCT_NUMBERS[3:]
    return _metrics(
        df,
        {**blanks("product_category_name"), **negatives(*PRODUCT_NUMBERS), **zeros(*sizes), **ranges(*sizes, "product_photos_qty")},
        key_profile(df, ["product_id"], "product_id"),
        key_profile(df, ["product_category_name"], "category"),
        _count(Q.unreferenced(df, t["order_items"], "product_id", "product_id"), "ProductsWithoutOrderItems"),
    )


def translation_metrics(t: Tables) -> DataFrame:
    df, label = t["category_translation"], "product_category_name"
    missing = Q.unmatched_impact(t["products"], df, label)
    return _metrics(
        df,
        blanks(label, "product_category_name_english"),
        key_profile(df, [label], "source_label"),
        key_profile(df.filter(F.col("product_category_name_english").isNotNull()), ["product_category_name_english"], "english_label"),
        missing.agg(
            F.count("*").alias("MissingTranslationCategoryCount"),
            F.coalesce(F.sum("Rows"), F.lit(0)).alias("ProductsAffectedByMissingTranslation"),
        ),
        _count(Q.unused_mappings(t["products"], df, label), "UnusedTranslationCount"),
        Q.coverage_percent(t["products"], df, label, "TranslationCoveragePercent"),
    )


def customers_metrics(t: Tables) -> DataFrame:
    df = t["customers"]
    zip_code, city, state = "customer_zip_code_prefix", "customer_city", "customer_state"
    return _metrics(
        df,
        {**blanks("customer_unique_id", zip_code, city, state), **address(zip_code, state, city)},
        key_profile(df, ["customer_id"], "customer_id"),
        key_profile(df, ["customer_unique_id"], "identity"),
        Q.orphan_count(t["orders"], df, "customer_id", "customer_id", name="OrdersWithoutCustomer"),
        _count(Q.unreferenced(df, t["orders"], "customer_id", "customer_id"), "CustomersWithoutOrders"),
        key_profile(t["orders"], ["customer_id"], "orders_per_customer"),
    )


def sellers_metrics(t: Tables) -> DataFrame:
    df = t["sellers"]
    zip_code, city, state = "seller_zip_code_prefix", "seller_city", "seller_state"
    return _metrics(
        df,
        {**blanks(zip_code, city, state), **address(zip_code, state, city)},
        key_profile(df, ["seller_id"], "seller_id"),
        Q.orphan_count(t["order_items"], df, "seller_id", "seller_id", name="ItemsWithoutSeller"),
        _count(Q.unreferenced(df, t["order_items"], "seller_id", "seller_id"), "SellersWithoutItems"),
        Q.group_size_summary(df, t["order_items"], "seller_id", "seller_id"),
    )


def payments_metrics(t: Tables) -> DataFrame:
    df = t["payments"]
    numbers = ("payment_sequential", "payment_installments", "payment_value")
    return _metrics(
        df,
        {**blanks("payment_type"), **negatives(*numbers), **zeros(*numbers[1:]), **ranges(*numbers)},
        key_profile(df, ["order_id", "payment_sequential"], "payment_key"),
        key_profile(df, ["order_id"], "order_id"),
        Q.orphan_count(df, t["orders"], "order_id", "order_id", name="OrphanPayments"),
        _count(Q.unreferenced(t["orders"], df, "order_id", "order_id"), "OrdersWithoutPayments"),
        _count(Q.payment_mismatches(df, t["order_items"]), "ReconciliationMismatchOrders"),
    )


def reviews_metrics(t: Tables) -> DataFrame:
    df, orders = t["reviews"], t["orders"]
    created, delivered = F.col("review_creation_date"), F.col("order_delivered_customer_date")
    against = orders.select("order_id", "order_purchase_timestamp", "order_delivered_customer_date")
    texts = ("review_comment_title", "review_comment_message")
    return _metrics(
        df,
        {
            **blanks(*texts),
            "InvalidReviewScores": matches(~F.col("review_score").between(1, 5)),
            **{f"max_{c}_length": F.max(text_length(c)) for c in texts},
            **ranges("review_creation_date", "review_answer_timestamp", "review_score"),
            "AnswerBeforeCreation": matches(F.col("review_answer_timestamp") < created),
            "AverageReviewScore": Q.decimal_average("review_score"),
            "WithTitle": matches(F.col(texts[0]).isNotNull() & ~is_blank(texts[0])),
            "WithMessage": matches(F.col(texts[1]).isNotNull() & ~is_blank(texts[1])),
            "WithoutText": matches(F.col(texts[0]).isNull() & F.col(texts[1]).isNull()),
        },
        key_profile(df, ["review_id", "order_id"], "review_key"),
        key_profile(df, ["order_id"], "order_id"),
        key_profile(df, ["review_id"], "review_id"),
        Q.orphan_count(df, orders, "order_id", "order_id", name="OrphanReviews"),
        _count(Q.unreferenced(orders, df, "order_id", "order_id"), "OrdersWithoutReviews"),
        Q.violations_across(
            df,
            against,
            ["order_id"],
            {
                "CreatedBeforePurchase": created < F.col("order_purchase_timestamp"),
                "CreatedBeforeDelivery": created < delivered,
            },
        ),
    )


def geolocation_metrics(t: Tables) -> DataFrame:
    df = t["geolocation"]
    zip_code, city, state = "geolocation_zip_code_prefix", "geolocation_city", "geolocation_state"
    lat, lng = F.col("geolocation_lat").cast("double"), F.col("geolocation_lng").cast("double")
    return _metrics(
        df,
        {
            **blanks(zip_code, city, state),
            **address(zip_code, state, city),
            "InvalidLatitude": matches(~lat.between(-90, 90)),
            "InvalidLongitude": matches(~lng.between(-180, 180)),
        },
        key_profile(df, [zip_code], "zip"),
        key_profile(df, [state], "state"),
        Q.exact_duplicates(df),
        _count(Q.values_per_key(df, [zip_code], state), "ZipsWithMultipleStates"),
        _count(Q.values_per_key(df, [zip_code], city), "ZipsWithMultipleCities"),
        Q.group_sizes(df, [zip_code]).agg(
            F.min("Rows").alias("MinRowsPerZip"), F.max("Rows").alias("MaxRowsPerZip"), Q.decimal_average("Rows").alias("AvgRowsPerZip")
        ),
    )


def geography_metrics(t: Tables) -> DataFrame:
    """Conformed geography: flags, invariants of fallback and ambiguity, coverage."""
    df = t["Geography"]
    lat, lng = F.col("RepresentativeLatitude"), F.col("RepresentativeLongitude")
    fallback_broken = (
        (F.col("ReferenceFallbackFlag") != 1)
        | F.col("StateCode").isNull()
        | F.col("CityName").isNull()
        | lat.isNotNull()
        | lng.isNotNull()
    )
    invariants = Q.audit(
        df,
        {
            "InvalidStateRows": matches(F.col("StateCode").isNull() | ~F.col("StateCode").isin(*STATE_CODES)),
            "InvalidCoordinateRows": matches(~lat.between(-90, 90) | ~lng.between(-180, 180)),
            "InvalidFallbackRows": matches((F.col("MissingFromGeolocationFlag") == 1) & fallback_broken),
            "InvalidAmbiguousCityRows": matches((F.col("CityAmbiguousFlag") == 1) & F.col("CityName").isNotNull()),
        },
    )
    return Q.union_all(
        [
            long(geography_profile(df)),
            long(invariants),
            long(key_profile(df, ["ZipCodePrefix"], "zip")),
            long(required_zip_coverage(df, t["customers"], t["sellers"])),
        ]
    )


def invalid_geography_states(t: Tables) -> DataFrame:
    state = F.col("StateCode")
    return t["Geography"].filter(state.isNull() | ~state.isin(*STATE_CODES)).select("ZipCodePrefix", "StateCode").orderBy("ZipCodePrefix")


def profile_status(profile: DataFrame, expected: Mapping[str, int | str], subject: str) -> DataFrame:
    """One line: do all named metrics of a one-row profile equal the given expectations, numbers or columns of the row?"""
    held = F.lit(True)
    for metric, value in expected.items():
        held = held & (F.col(metric) == (F.col(value) if isinstance(value, str) else F.lit(value)))
    verdict = F.when(held, f"{subject} VALIDATION PASSED").otherwise(f"{subject} VALIDATION FAILED")
    return profile.select(verdict.alias("ValidationStatus"))


def repeated_identities(t: Tables) -> DataFrame:
    return Q.duplicate_groups(t["customers"], ["customer_unique_id"], "CustomerIDCount").orderBy(F.desc("CustomerIDCount"), "customer_unique_id")


def seller_activity(t: Tables) -> DataFrame:
    return Q.children_per_parent(t["sellers"].select("seller_id"), t["order_items"], "seller_id", "seller_id")


def top_payment_totals(t: Tables, limit: int = 20) -> DataFrame:
    measures = {"PaymentRows": F.count("*"), "TotalPaymentValue": F.sum("payment_value")}
    return Q.top_groups(t["payments"], ["order_id"], measures, "TotalPaymentValue", limit)


def repeated_review_ids(t: Tables, limit: int = 100) -> DataFrame:
    """The most repeated review ids; (id, order) pairs are counted before the distinct orders."""
    pairs = t["reviews"].groupBy("review_id", "order_id").agg(F.count("*").alias("_rows"))
    measures = {"ReviewRowCount": F.sum("_rows"), "DistinctOrderCount": F.count("order_id")}
    return Q.top_groups(pairs, ["review_id"], measures, "ReviewRowCount", limit, F.col("ReviewRowCount") > 1)


def busiest_zips(t: Tables, limit: int = 20) -> DataFrame:
    """The ZIP codes with most rows; observations are counted per (ZIP, city, state) first."""
    place = ["geolocation_zip_code_prefix", "geolocation_city", "geolocation_state"]
    counted = t["geolocation"].groupBy(*place).agg(
        F.count("*").alias("_rows"),
        *[f(f"geolocation_{c}").alias(f"_{n}_{c}") for c in ("lat", "lng") for n, f in (("min", F.min), ("max", F.max))],
    )
    measures = {
        "SourceRows": F.sum("_rows"),
        "DistinctCities": F.count_distinct("geolocation_city"),
        "DistinctStates": F.count_distinct("geolocation_state"),
        "MinLatitude": F.min("_min_lat"),
        "MaxLatitude": F.max("_max_lat"),
        "MinLongitude": F.min("_min_lng"),
        "MaxLongitude": F.max("_max_lng"),
    }
    return Q.top_groups(counted, place[:1], measures, "SourceRows", limit)


def states_with_zips(t: Tables) -> DataFrame:
    """Rows and distinct ZIP codes per state, counted from (state, ZIP) pairs."""
    pairs = Q.group_sizes(t["geolocation"], ["geolocation_state", "geolocation_zip_code_prefix"], "_rows")
    return pairs.groupBy("geolocation_state").agg(
        F.sum("_rows").alias("GeolocationRows"), F.count("geolocation_zip_code_prefix").alias("DistinctZipPrefixes")
    ).orderBy("geolocation_state")


def sequence_starts(t: Tables) -> DataFrame:
    profile = Q.sequence_profile(t["payments"], ["order_id"], "payment_sequential")
    return profile.filter("MinSequence <> 1").drop("SequenceAnomaly").orderBy(F.desc("SequenceRows"), "order_id")


def orders_without_payments(t: Tables) -> DataFrame:
    detail = t["orders"].select(
        "order_id", "order_status", "order_purchase_timestamp", "order_approved_at", "order_delivered_customer_date"
    )
    return Q.childless_parents(detail, t["payments"], t["order_items"], "order_id", "OrderItemCount")


def zero_weight_products(t: Tables) -> DataFrame:
    return Q.known_issues(
        t["products"],
        t["order_items"],
        "product_id",
        F.col("product_weight_g") == 0,
        [
            ("Category", "product_category_name"),
            ("Weight", "product_weight_g"),
            ("Length", "product_length_cm"),
            ("Height", "product_height_cm"),
            ("Width", "product_width_cm"),
        ],
    )


METRICS = {
    "orders": orders_metrics,
    "order_items": items_metrics,
    "products": products_metrics,
    "category_translation": translation_metrics,
    "customers": customers_metrics,
    "sellers": sellers_metrics,
    "payments": payments_metrics,
    "reviews": reviews_metrics,
    "geolocation": geolocation_metrics,
    "Geography": geography_metrics,
}
