"""Dimension loads: surrogate keys, Unknown members, strict lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stallkeep.functions import city_key, flag, folded
from stallkeep.functions.calendar import UNKNOWN_FA
from stallkeep.operators.joins import required, spread_join, strict_lookup
from stallkeep.operators.keys import number_rows, with_unknown_member
from stallkeep.operators.rules import ValidationError
from stallkeep.plans.category import localized_categories

GEOGRAPHY_FLAGS = (
    "MissingFromGeolocationFlag",
    "StateConflictFlag",
    "StateAmbiguousFlag",
    "StateResolvedByReferenceFlag",
    "CityAmbiguousFlag",
    "CityResolvedByReferenceFlag",
    "ReferenceFallbackFlag",
)

# The Unknown member of each dimension (columns not named are NULL).
UNKNOWN_MEMBERS = {
    "DimGeography": {
        "GeographyKey": 0,
        "CityName": "Unknown",
        "HasCoordinates": 0,
        **dict.fromkeys(GEOGRAPHY_FLAGS, 0),
    },
    "DimCustomer": {
        "CustomerKey": 0,
        "RepresentativeGeographyKey": 0,
        "OrderCount": 0,
        "CustomerIDCount": 0,
        "ReturningCustomerFlag": 0,
        "MultipleZIPFlag": 0,
        "MultipleCityFlag": 0,
        "MultipleStateFlag": 0,
        "LatestTimestampTieFlag": 0,
    },
    "DimSeller": {
        "SellerKey": 0,
        "GeographyKey": 0,
        "SourceCityName": "Unknown",
        "CityMismatchFlag": 0,
        "StateMismatchFlag": 0,
    },
    "DimProductCategory": {
        "ProductCategoryKey": 0,
        "EnglishCategoryName": "Unknown",
        "PersianCategoryName": UNKNOWN_FA,
        "MissingEnglishTranslationFlag": 0,
        "MissingPersianLocalizationFlag": 0,
    },
    "DimProduct": {
        "ProductKey": 0,
        "ProductCategoryKey": 0,
        "MissingSourceCategoryFlag": 0,
        "MissingDescriptiveAttributesFlag": 0,
        "MissingPhysicalAttributesFlag": 0,
        "ZeroWeightFlag": 0,
    },
}

# Error codes of a load on top of existing business rows.
RELOAD_CODES = {
    "DimGeography": ("GeographyKey", 51041),
    "DimCustomer": ("CustomerKey", 51042),
    "DimSeller": ("SellerKey", 51043),
    "DimProductCategory": ("ProductCategoryKey", 51044),
    "DimProduct": ("ProductKey", 51045),
}


def refuse_reload(existing: DataFrame, dimension: str) -> None:
    """Fail if the target already holds business rows; an Unknown member alone is fine."""
    key, code = RELOAD_CODES[dimension]
    if not existing.filter(F.col(key) != 0).isEmpty():
        raise ValidationError(dimension, code, "load aborted: business rows already exist. Reset it first.")


def _finish(numbered: DataFrame, dimension: str) -> DataFrame:
    return with_unknown_member(numbered, UNKNOWN_MEMBERS[dimension])


def geography_members(geography: DataFrame) -> DataFrame:
    located = F.col("RepresentativeLatitude").isNotNull() & F.col("RepresentativeLongitude").isNotNull()
    return geography.select(
        "ZipCodePrefix",
        "CityName",
        "StateCode",
        "RepresentativeLatitude",
        "RepresentativeLongitude",
        flag(located).alias("HasCoordinates"),
        *GEOGRAPHY_FLAGS,
    )


def dim_geography(geography: DataFrame) -> DataFrame:
    return _finish(number_rows(geography_members(geography), ["ZipCodePrefix"], "GeographyKey"), "DimGeography")


def customer_members(customer: DataFrame, geography: DataFrame) -> DataFrame:
    """``geography`` is the loaded DimGeography."""
    located = strict_lookup(customer, geography, "ZipCodePrefix", "GeographyKey", "ZipCodePrefix")
    return located.select(
        "CustomerUniqueID",
        "RepresentativeCustomerID",
        F.col("GeographyKey").alias("RepresentativeGeographyKey"),
        "FirstPurchaseTimestamp",
        "LatestPurchaseTimestamp",
        "OrderCount",
        "CustomerIDCount",
        flag(F.col("CustomerIDCount") > 1).alias("ReturningCustomerFlag"),
        flag(F.col("DistinctZIPCount") > 1).alias("MultipleZIPFlag"),
        flag(F.col("DistinctCityCount") > 1).alias("MultipleCityFlag"),
        flag(F.col("DistinctStateCount") > 1).alias("MultipleStateFlag"),
        "LatestTimestampTieFlag",
    )


def dim_customer(customer: DataFrame, geography: DataFrame) -> DataFrame:
    members = customer_members(customer, geography)
    return _finish(number_rows(members, ["CustomerUniqueID"], "CustomerKey"), "DimCustomer")


def seller_mismatches(sellers: DataFrame, geography: DataFrame) -> DataFrame:
    """Sellers with the geography of their ZIP and two mismatch flags.

    A ZIP the geography lacks counts as a mismatch of both; a geography
    without a city as a city mismatch; one without a state as none.
    """
    places = geography.filter(F.col("ZipCodePrefix").isNotNull()).select(
        F.col("ZipCodePrefix").alias("seller_zip_code_prefix"),
        F.lit(1).alias("_known"),
        F.col("CityName").alias("_city"),
        F.col("StateCode").alias("_state"),
        *(["GeographyKey"] if "GeographyKey" in geography.columns else []),
    )
    joined = spread_join(sellers, places, ["seller_zip_code_prefix"], "left")
    unknown = F.col("_known").isNull()
    other_city = city_key("seller_city") != city_key("_city")
    other_state = folded("seller_state") != folded("_state")
    return joined.withColumns(
        {
            "CityMismatchFlag": flag(unknown | F.col("_city").isNull() | other_city),
            "StateMismatchFlag": flag(unknown | other_state),
        }
    ).drop("_known", "_city", "_state")


def seller_members(sellers: DataFrame, geography: DataFrame) -> DataFrame:
    """``geography`` is the loaded DimGeography: one join gives key, city and state."""
    compared = seller_mismatches(sellers, geography.filter("GeographyKey <> 0"))
    return compared.select(
        F.col("seller_id").alias("SellerID"),
        required(F.col("GeographyKey"), "no GeographyKey for a seller ZIP").alias("GeographyKey"),
        F.col("seller_zip_code_prefix").alias("SourceZipCodePrefix"),
        F.col("seller_city").alias("SourceCityName"),
        F.col("seller_state").alias("SourceStateCode"),
        "CityMismatchFlag",
        "StateMismatchFlag",
    )


def dim_seller(sellers: DataFrame, geography: DataFrame) -> DataFrame:
    return _finish(number_rows(seller_members(sellers, geography), ["SellerID"], "SellerKey"), "DimSeller")


def category_members(category: DataFrame, localization: DataFrame) -> DataFrame:
    return localized_categories(category, localization).select(
        "SourceCategoryName",
        "EnglishCategoryName",
        "PersianCategoryName",
        "MissingEnglishTranslationFlag",
        "MissingPersianLocalizationFlag",
    )


def dim_category(category: DataFrame, localization: DataFrame) -> DataFrame:
    members = category_members(category, localization)
    return _finish(number_rows(members, ["SourceCategoryName"], "ProductCategoryKey"), "DimProductCategory")


def product_attributes(products: DataFrame) -> DataFrame:
    """Products under their dimension names with the completeness flags."""

    def any_missing(*columns: str):
        return flag(F.array_contains(F.array(*[F.col(c).isNull() for c in columns]), True))

    return products.select(
        F.col("product_id").alias("ProductID"),
        F.col("product_category_name").alias("SourceCategoryName"),
        F.col("product_name_lenght").alias("ProductNameLength"),
        F.col("product_description_lenght").alias("ProductDescriptionLength"),
        F.col("product_photos_qty").alias("ProductPhotosQty"),
        F.col("product_weight_g").alias("ProductWeightG"),
        F.col("product_length_cm").alias("ProductLengthCm"),
        F.col("product_height_cm").alias("ProductHeightCm"),
        F.col("product_width_cm").alias("ProductWidthCm"),
        flag(F.col("product_category_name").isNull()).alias("MissingSourceCategoryFlag"),
        any_missing("product_name_lenght", "product_description_lenght", "product_photos_qty").alias(
            "MissingDescriptiveAttributesFlag"
        ),
        any_missing("product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm").alias(
            "MissingPhysicalAttributesFlag"
        ),
        flag(F.col("product_weight_g") == 0).alias("ZeroWeightFlag"),
    )


def product_members(products: DataFrame, category: DataFrame) -> DataFrame:
    """Key 0 for products without a category; a label the category dimension lacks fails the job."""
    known = category.filter("ProductCategoryKey <> 0").select("SourceCategoryName", "ProductCategoryKey")
    joined = spread_join(product_attributes(products), known, ["SourceCategoryName"], "left")
    key = F.when(F.col("SourceCategoryName").isNull(), F.lit(0).cast("long")).otherwise(
        required(F.col("ProductCategoryKey"), "no ProductCategoryKey for a product category")
    )
    return joined.withColumn("ProductCategoryKey", key).select(
        "ProductID",
        "ProductCategoryKey",
        "ProductNameLength",
        "ProductDescriptionLength",
        "ProductPhotosQty",
        "ProductWeightG",
        "ProductLengthCm",
        "ProductHeightCm",
        "ProductWidthCm",
        "MissingSourceCategoryFlag",
        "MissingDescriptiveAttributesFlag",
        "MissingPhysicalAttributesFlag",
        "ZeroWeightFlag",
    )


def dim_product(products: DataFrame, category: DataFrame) -> DataFrame:
    return _finish(number_rows(product_members(products, category), ["ProductID"], "ProductKey"), "DimProduct")
