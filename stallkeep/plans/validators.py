"""Metrics of each load, in long form, for the rule catalogue.

Every validator re-derives the expected rows, compares them with the loaded
ones in one grouping, and adds key, date and coverage checks. All metrics are
a handful of rows; the rules are evaluated over them in Spark.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallkeep.functions import flag, matches
from stallkeep.operators.compare import (
    ACTUAL,
    EXPECTED,
    compare_rows,
    difference_measures,
    differences,
    profile_measures,
    summarize,
)
from stallkeep.operators.joins import spread_join
from stallkeep.operators.quality import one_by_one, union_all
from stallkeep.operators.rules import ValidationError, enforce, evaluate_rules, long_metrics
from stallkeep.plans import expected as E
from stallkeep.plans import facts
from stallkeep.plans.category import localization_profile, missing_persian
from stallkeep.plans.dimensions import UNKNOWN_MEMBERS
from stallkeep.plans.geography import geography_profile
from stallkeep.plans.customer import customer_profile
from stallkeep.plans.rule_catalog import rules_of
from stallkeep.session import write_scratch

Tables = Mapping[str, DataFrame]


def _measured(df: DataFrame, scope: str, measures: Mapping[str, Column]) -> DataFrame:
    return long_metrics(df.agg(*[m.alias(n) for n, m in measures.items()]), scope)


def _renamed(one_row: DataFrame, scope: str, names: Mapping[str, str]) -> DataFrame:
    return long_metrics(one_row.select(*[F.col(c).alias(n) for n, c in names.items()]), scope)


def dimension_measures(df: DataFrame, dimension: str, key: str) -> dict[str, Column]:
    values = UNKNOWN_MEMBERS[dimension]
    exact = reduce(and_, [F.col(c).eqNullSafe(F.lit(values.get(c))) for c in df.columns])
    return {
        "ActualTotalRows": F.count("*"),
        "ActualBusinessRows": matches(F.col(key) != 0),
        "UnknownRows": matches(F.col(key) == 0),
        "ValidUnknownRows": matches((F.col(key) == 0) & exact),
    }


def grain(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Distinct keys, keys that repeat, and rows with a NULL in the key."""
    missing = reduce(or_, [F.col(c).isNull() for c in key])
    grouped = df.groupBy(*key).agg(F.count("*").alias("_rows"))
    return grouped.agg(
        matches(~missing).alias("DistinctKeys"),
        matches(F.col("_rows") > 1).alias("DuplicateKeys"),
        F.coalesce(F.sum(F.when(missing, F.col("_rows"))), F.lit(0)).alias("NullKeys"),
    )


def invalid_keys(
    df: DataFrame, column: str, members: DataFrame, member_key: str, allow_unknown: bool = False
) -> DataFrame:
    """Rows whose surrogate key is missing from the dimension, or 0 where Unknown is not allowed.

    Rows are counted per key before the anti join.
    """
    counted = df.groupBy(F.col(column).alias("_key")).agg(F.count("*").alias("_rows"))
    known = members.select(F.col(member_key).alias("_key"))
    if not allow_unknown:
        known = known.filter("_key <> 0")
    return counted.join(known, "_key", "left_anti").agg(F.coalesce(F.sum("_rows"), F.lit(0)).alias("InvalidRows"))


def invalid_dates(df: DataFrame, roles: Sequence[str], dates: DataFrame, allow_unknown: bool) -> DataFrame:
    """Rows with at least one invalid date key, over all roles.

    The distinct days of the roles are few; rows are reduced to their
    combination of days before each role is checked.
    """
    counted = df.groupBy(*roles).agg(F.count("*").alias("_rows"))
    known = dates.select("DateKey") if allow_unknown else dates.select("DateKey").filter("DateKey <> 0")
    bad = F.lit(False)
    for role in roles:
        members = known.select(F.col("DateKey").alias(role), F.lit(1).alias(f"_{role}"))
        counted = spread_join(counted, members, [role], "left")
        bad = bad | F.col(f"_{role}").isNull()
    return counted.agg(F.coalesce(F.sum(F.when(bad, F.col("_rows"))), F.lit(0)).alias("InvalidRows"))


def missing_matches(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Child rows whose key the parent lacks."""
    counted = child.groupBy(key).agg(F.count("*").alias("_rows"))
    return counted.join(parent.select(key), key, "left_anti").agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("MissingRows")
    )


def childless_comparison(
    source_parent: DataFrame, source_child: DataFrame, parent: DataFrame, child: DataFrame
) -> DataFrame:
    """Parents without children: the same set in the source and in the warehouse?"""
    in_source = source_parent.select(F.col("order_id").alias("OrderID")).join(
        source_child.select(F.col("order_id").alias("OrderID")).distinct(), "OrderID", "left_anti"
    )
    in_warehouse = parent.select("OrderID").join(child.select("OrderID").distinct(), "OrderID", "left_anti")
    return differences(in_source, in_warehouse)


def delivery_null_violations(reviews: DataFrame, orders: DataFrame) -> DataFrame:
    """Reviews whose delivery-relative flags are NULL although delivered, or set although not."""
    delivered = orders.select("OrderID", F.col("DeliveredCustomerTimestamp").isNotNull().alias("_delivered"))
    flags = ("ReviewCreatedBeforeDeliveryFlag", "ReviewAnsweredBeforeDeliveryFlag")
    joined = spread_join(reviews.select("OrderID", *flags), delivered, ["OrderID"], "inner")
    wrong = reduce(or_, [F.col(f).isNotNull() != F.col("_delivered") for f in flags])
    return joined.agg(matches(wrong).alias("InvalidRows"))


def _one(one_row: DataFrame, scope: str, name: str) -> DataFrame:
    """The single number of a one-column frame under a metric name."""
    return _renamed(one_row, scope, {name: one_row.columns[0]})


def _compared(expected: DataFrame, actual: DataFrame, scope: str, measures: Mapping[str, Column]) -> DataFrame:
    return _measured(compare_rows(expected, actual), scope, {**difference_measures(), **measures})


def _with_date_check(compared: DataFrame, roles: Sequence[str], dates: DataFrame, allow_unknown: bool = False) -> DataFrame:
    """Add ``_bad_date``: 1 where any date role has no member."""
    known = dates.select("DateKey") if allow_unknown else dates.select("DateKey").filter("DateKey <> 0")
    bad = F.lit(False)
    for role in roles:
        members = known.select(F.col("DateKey").alias(role), F.lit(1).alias(f"_{role}"))
        compared = spread_join(compared, members, [role], "left")
        bad = bad | F.col(f"_{role}").isNull()
    return compared.withColumn("_bad_date", flag(bad))


def _date_measures(*sides: str) -> dict[str, Column]:
    tallies = profile_measures({"DateKeys": F.col("_bad_date")})
    names = {"Actual": "InvalidDateKeys", "Expected": "MissingExpectedDateKeys"}
    return {names[side]: tallies[f"{side}DateKeys"] for side in sides}


def _business(df: DataFrame, key: str) -> DataFrame:
    return df.filter(F.col(key) != 0)


def validate_geography(t: Tables) -> DataFrame:
    scope, dim = "DimGeography", t["DimGeography"]
    business = _business(dim, "GeographyKey")
    expected = E.dim_geography(t)
    profile = geography_profile(business)
    return union_all(
        [
            _measured(dim, scope, dimension_measures(dim, scope, "GeographyKey")),
            _compared(
                expected,
                business,
                scope,
                {"ExpectedBusinessRows": difference_measures()["ExpectedRows"]},
            ),
            _renamed(
                grain(business, ["ZipCodePrefix"]),
                scope,
                {"DistinctBusinessZIPs": "DistinctKeys", "DuplicateBusinessZIPGroups": "DuplicateKeys"},
            ),
            _one(missing_matches(t["Geography"], business, "ZipCodePrefix"), scope, "MissingConformedZIPs"),
            long_metrics(profile, scope),
        ]
    )


def validate_customer(t: Tables) -> DataFrame:
    scope, dim = "DimCustomer", t["DimCustomer"]
    business = _business(dim, "CustomerKey")
    expected = E.dim_customer(t)
    resolved = F.when(F.col("RepresentativeGeographyKey").isNotNull(), 1).otherwise(0)
    return union_all(
        [
            _measured(dim, scope, dimension_measures(dim, scope, "CustomerKey")),
            _compared(
                expected,
                business,
                scope,
                {"ExpectedResolvedRows": profile_measures({"X": resolved})["ExpectedX"]},
            ),
            _measured(t["Customer"], scope, {"ConformedBusinessRows": F.count("*")}),
            _renamed(
                grain(business, ["CustomerUniqueID"]),
                scope,
                {"DistinctBusinessCustomers": "DistinctKeys", "DuplicateBusinessKeyGroups": "DuplicateKeys"},
            ),
            _one(
                invalid_keys(business, "RepresentativeGeographyKey", t["DimGeography"], "GeographyKey"),
                scope,
                "InvalidBusinessGeographyKeys",
            ),
            long_metrics(
                customer_profile(t["Customer"]).select(
                    "ReturningCustomers",
                    "CustomersWithMultipleZIPs",
                    "CustomersWithMultipleStates",
                    "CustomersWithMultipleCities",
                    "LatestTimestampTies",
                ),
                scope,
            ),
        ]
    )


def validate_seller(t: Tables) -> DataFrame:
    scope, dim = "DimSeller", t["DimSeller"]
    business = _business(dim, "SellerKey")
    unresolved = F.when(F.col("GeographyKey").isNull(), 1).otherwise(0)
    return union_all(
        [
            _measured(
                dim,
                scope,
                {
                    "TargetTotalRows": F.count("*"),
                    "TargetBusinessCount": matches(F.col("SellerKey") != 0),
                    "ValidUnknownRows": dimension_measures(dim, scope, "SellerKey")["ValidUnknownRows"],
                },
            ),
            _measured(t["sellers"], scope, {"SourceSellerCount": F.count("*")}),
            _compared(
                E.dim_seller(t),
                business,
                scope,
                {
                    **profile_measures(
                        {"CityMismatches": F.col("CityMismatchFlag"), "StateMismatches": F.col("StateMismatchFlag")}
                    ),
                    "MissingGeographyKeys": profile_measures({"X": unresolved})["ExpectedX"],
                },
            ),
            _renamed(
                grain(business, ["SellerID"]),
                scope,
                {
                    "DistinctBusinessSellerIDs": "DistinctKeys",
                    "DuplicateSellerIDs": "DuplicateKeys",
                    "NullBusinessSellerIDs": "NullKeys",
                },
            ),
            _one(invalid_keys(business, "GeographyKey", t["DimGeography"], "GeographyKey"), scope, "InvalidGeographyKeys"),
        ]
    )


def validate_category(t: Tables) -> DataFrame:
    scope, dim = "DimProductCategory", t["DimProductCategory"]
    business = _business(dim, "ProductCategoryKey")
    english = F.col("EnglishCategoryName").isNull()
    return union_all(
        [
            _measured(dim, scope, dimension_measures(dim, scope, "ProductCategoryKey")),
            _compared(
                E.dim_category(t),
                business,
                scope,
                {
                    "ExpectedBusinessRows": difference_measures()["ExpectedRows"],
                    **profile_measures(
                        {
                            "MissingEnglishTranslations": F.col("MissingEnglishTranslationFlag"),
                            "MissingPersianLocalizations": F.col("MissingPersianLocalizationFlag"),
                        }
                    ),
                },
            ),
            _renamed(
                grain(business, ["SourceCategoryName"]),
                scope,
                {"DuplicateSourceCategories": "DuplicateKeys", "NullBusinessCategories": "NullKeys"},
            ),
            _measured(
                business,
                scope,
                {
                    "InvalidEnglishFlags": matches(F.col("MissingEnglishTranslationFlag") != flag(english)),
                    "InvalidPersianFlags": matches(F.col("MissingPersianLocalizationFlag") != flag(missing_persian())),
                    "MissingPersianNames": matches(missing_persian()),
                },
            ),
        ]
    )


def validate_product(t: Tables) -> DataFrame:
    scope, dim = "DimProduct", t["DimProduct"]
    business = _business(dim, "ProductKey")
    flags = {
        "UnknownCategoryRows": flag(F.col("ProductCategoryKey") == 0),
        "MissingSourceCategory": F.col("MissingSourceCategoryFlag"),
        "MissingDescriptiveAttributes": F.col("MissingDescriptiveAttributesFlag"),
        "MissingPhysicalAttributes": F.col("MissingPhysicalAttributesFlag"),
        "ZeroWeight": F.col("ZeroWeightFlag"),
    }
    unresolved = profile_measures({"X": flag(F.col("ProductCategoryKey").isNull())})["ExpectedX"]
    return union_all(
        [
            _measured(dim, scope, dimension_measures(dim, scope, "ProductKey")),
            _compared(
                E.dim_product(t),
                business,
                scope,
                {
                    "ExpectedBusinessRows": difference_measures()["ExpectedRows"],
                    **profile_measures(flags),
                    "UnresolvedCategories": unresolved,
                },
            ),
            _renamed(
                grain(business, ["ProductID"]),
                scope,
                {
                    "DistinctBusinessProductIDs": "DistinctKeys",
                    "DuplicateProductIDs": "DuplicateKeys",
                    "NullBusinessProductIDs": "NullKeys",
                },
            ),
            _one(
                invalid_keys(business, "ProductCategoryKey", t["DimProductCategory"], "ProductCategoryKey", allow_unknown=True),
                scope,
                "InvalidCategoryKeys",
            ),
        ]
    )


ORDER_DATE_ROLES = ("ApprovedDateKey", "CarrierDateKey", "DeliveredDateKey", "EstimatedDeliveryDateKey", "PurchaseDateKey")


def _missing_expected(columns: Mapping[str, str]) -> dict[str, Column]:
    tallies = profile_measures({n: flag(F.col(c).isNull()) for n, c in columns.items()})
    return {f"MissingExpected{n}": tallies[f"Expected{n}"] for n in columns}


def _bad_counter(column: str) -> Column:
    return F.coalesce(F.sum(F.when(~F.col(column).eqNullSafe(F.lit(1)), F.col(ACTUAL))), F.lit(0))


# The columns that the measures of a compared fact read.
_KEYS_MEASURED = ("CustomerKey", "CustomerGeographyKey")
_ORDER_MEASURED = (
    *_KEYS_MEASURED, *ORDER_DATE_ROLES, "CarrierBeforePurchaseFlag", "CarrierBeforeApprovalFlag", "DeliveredBeforeCarrierFlag", "DeliveredLateFlag", "OrderCount",
)
_ITEM_MEASURED = (*_KEYS_MEASURED, "ProductKey", "SellerKey", "PurchaseDateKey", "ShippingLimitDateKey", "PriceAmount", "FreightAmount", "OrderItemCount")
_PAYMENT_MEASURED = (
    *_KEYS_MEASURED, "OrderID", "PurchaseDateKey", "PaymentAmount", "PaymentCount", "PaymentSequenceAnomalyFlag", "UndefinedPaymentTypeFlag", "ZeroInstallmentFlag",
    "ZeroPaymentValueFlag",
)
_REVIEW_MEASURED = (
    *_KEYS_MEASURED, "OrderID", "PurchaseDateKey", "ReviewCreationDateKey", "ReviewAnswerDateKey", "ReviewScore", "ReviewCount", "DuplicateReviewIDFlag",
    "ReviewCreatedBeforePurchaseFlag", "ReviewCreatedBeforeDeliveryFlag", "ReviewAnsweredBeforePurchaseFlag", "ReviewAnsweredBeforeDeliveryFlag",
    "ReviewAnsweredBeforeCreationFlag",
)


def validate_fact_order(t: Tables) -> DataFrame:
    scope, fact = "FactOrder", t["FactOrder"].select(*facts.ORDER_COLUMNS)
    flags = {
        "CarrierBeforePurchase": F.col("CarrierBeforePurchaseFlag"),
        "CarrierBeforeApproval": F.col("CarrierBeforeApprovalFlag"),
        "DeliveredBeforeCarrier": F.col("DeliveredBeforeCarrierFlag"),
        "DeliveredLate": flag(F.col("DeliveredLateFlag") == 1),
        "UndeliveredLateStatus": flag(F.col("DeliveredLateFlag").isNull()),
    }
    return one_by_one(
        [
            _measured(t["orders"], scope, {"SourceOrderRows": F.count("*")}),
            _measured(
                _with_date_check(compare_rows(E.fact_order(t), fact, keep=_ORDER_MEASURED), ORDER_DATE_ROLES, t["DimDate"], allow_unknown=True),
                scope,
                {
                    **difference_measures(),
                    **profile_measures(flags),
                    **_missing_expected({"CustomerKeys": "CustomerKey", "GeographyKeys": "CustomerGeographyKey"}),
                    **_date_measures("Actual"),
                    "InvalidOrderCounts": _bad_counter("OrderCount"),
                },
            ),
            _renamed(
                grain(fact, ["OrderID"]),
                scope,
                {"DistinctOrderIDs": "DistinctKeys", "DuplicateOrderIDs": "DuplicateKeys", "NullOrderIDs": "NullKeys"},
            ),
            _one(invalid_keys(fact, "CustomerKey", t["DimCustomer"], "CustomerKey"), scope, "InvalidCustomerKeys"),
            _one(invalid_keys(fact, "CustomerGeographyKey", t["DimGeography"], "GeographyKey"), scope, "InvalidGeographyKeys"),
        ]
    )


def validate_fact_order_item(t: Tables) -> DataFrame:
    scope, fact = "FactOrderItem", t["FactOrderItem"].select(*facts.ITEM_COLUMNS)
    profile = {
        "PriceAmount": F.col("PriceAmount"),
        "FreightAmount": F.col("FreightAmount"),
        "ZeroFreightRows": flag(F.col("FreightAmount") == 0),
        "ZeroPriceRows": flag(F.col("PriceAmount") == 0),
    }
    keys = {"ProductKeys": "ProductKey", "SellerKeys": "SellerKey", "CustomerKeys": "CustomerKey", "GeographyKeys": "CustomerGeographyKey"}
    dims = {"ProductKeys": "DimProduct", "SellerKeys": "DimSeller", "CustomerKeys": "DimCustomer", "GeographyKeys": "DimGeography"}
    return one_by_one(
        [
            _measured(t["order_items"], scope, {"SourceRows": F.count("*")}),
            _measured(
                _with_date_check(compare_rows(E.fact_order_item(t), fact, keep=_ITEM_MEASURED), ["PurchaseDateKey", "ShippingLimitDateKey"], t["DimDate"]),
                scope,
                {
                    **difference_measures(),
                    **profile_measures(profile),
                    **_missing_expected(keys),
                    **_date_measures("Actual"),
                    "InvalidOrderItemCounts": _bad_counter("OrderItemCount"),
                },
            ),
            _renamed(grain(fact, ["OrderID", "OrderItemID"]), scope, {"DuplicateNaturalGrain": "DuplicateKeys"}),
            _measured(
                fact,
                scope,
                {
                    "NullOrderIDs": matches(F.col("OrderID").isNull()),
                    "InvalidOrderItemIDs": matches(F.col("OrderItemID").isNull() | (F.col("OrderItemID") < 1)),
                },
            ),
            *[
                _one(
                    invalid_keys(fact, column, t[dims[name]], "GeographyKey" if name == "GeographyKeys" else column),
                    scope,
                    f"Invalid{name}",
                )
                for name, column in keys.items()
            ],
            _one(missing_matches(fact, t["FactOrder"], "OrderID"), scope, "MissingFactOrderMatches"),
        ]
    )


def _broken_orders() -> dict[str, Column]:
    """Orders with a broken payment sequence, where the measures are totalled per order."""
    broken = F.col("PaymentSequenceAnomalyFlag") == 1
    return {
        "ExpectedSequenceAnomalyOrders": F.max(F.when(broken & (F.col(EXPECTED) > 0), 1).otherwise(0)),
        "ActualSequenceAnomalyOrders": F.max(F.when(broken & (F.col(ACTUAL) > 0), 1).otherwise(0)),
    }


def validate_fact_payment(t: Tables) -> DataFrame:
    scope, fact = "FactPayment", t["FactPayment"].select(*facts.PAYMENT_COLUMNS)
    profile = {
        "PaymentAmount": F.col("PaymentAmount"),
        "SequenceAnomalyRows": F.col("PaymentSequenceAnomalyFlag"),
        "UndefinedPaymentTypes": F.col("UndefinedPaymentTypeFlag"),
        "ZeroInstallments": F.col("ZeroInstallmentFlag"),
        "ZeroPaymentValues": F.col("ZeroPaymentValueFlag"),
    }
    compared = _with_date_check(compare_rows(E.fact_payment(t), fact, keep=_PAYMENT_MEASURED), ["PurchaseDateKey"], t["DimDate"])
    return one_by_one(
        [
            _measured(t["payments"], scope, {"SourceRows": F.count("*")}),
            long_metrics(
                summarize(
                    compared,
                    {
                        **difference_measures(),
                        **profile_measures(profile),
                        **_broken_orders(),
                        **_missing_expected({"CustomerKeys": "CustomerKey", "GeographyKeys": "CustomerGeographyKey"}),
                        **_date_measures("Actual"),
                        "InvalidPaymentCounts": _bad_counter("PaymentCount"),
                    },
                    "OrderID",
                    "Orders",
                ),
                scope,
            ),
            _renamed(grain(fact, ["OrderID", "PaymentSequential"]), scope, {"DuplicateNaturalGrain": "DuplicateKeys"}),
            _measured(
                fact,
                scope,
                {
                    "NullOrderIDs": matches(F.col("OrderID").isNull()),
                    "InvalidPaymentSequential": matches(F.col("PaymentSequential").isNull() | (F.col("PaymentSequential") < 1)),
                },
            ),
            _one(invalid_keys(fact, "CustomerKey", t["DimCustomer"], "CustomerKey"), scope, "InvalidCustomerKeys"),
            _one(invalid_keys(fact, "CustomerGeographyKey", t["DimGeography"], "GeographyKey"), scope, "InvalidGeographyKeys"),
            _one(missing_matches(fact, t["FactOrder"], "OrderID"), scope, "MissingFactOrderMatches"),
            _renamed(
                childless_comparison(t["orders"], t["payments"], t["FactOrder"], fact),
                scope,
                {
                    "SourceOrdersWithoutPayments": "ExpectedRows",
                    "FactOrdersWithoutPayments": "ActualRows",
                    "SourceNoPaymentToWarehouseDiff": "SourceToTargetDifferences",
                    "WarehouseNoPaymentToSourceDiff": "TargetToSourceDifferences",
                },
            ),
        ]
    )


def duplicate_id_groups(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("_rows")).agg(matches(F.col("_rows") > 1).alias("Groups"))


REVIEW_DATE_ROLES = ("PurchaseDateKey", "ReviewCreationDateKey", "ReviewAnswerDateKey")


def validate_fact_review(t: Tables) -> DataFrame:
    scope, fact = "FactReview", t["FactReview"].select(*facts.REVIEW_COLUMNS)
    created, answered = F.col("ReviewCreatedBeforeDeliveryFlag"), F.col("ReviewAnsweredBeforeDeliveryFlag")
    profile = {
        "ReviewScore": F.col("ReviewScore"),
        "DuplicateReviewIDRows": F.col("DuplicateReviewIDFlag"),
        "CreatedBeforePurchase": F.col("ReviewCreatedBeforePurchaseFlag"),
        "CreatedBeforeDelivery": flag(created == 1),
        "CreatedBeforeDeliveryNull": flag(created.isNull()),
        "AnsweredBeforePurchase": F.col("ReviewAnsweredBeforePurchaseFlag"),
        "AnsweredBeforeDelivery": flag(answered == 1),
        "AnsweredBeforeDeliveryNull": flag(answered.isNull()),
        "AnsweredBeforeCreation": F.col("ReviewAnsweredBeforeCreationFlag"),
    }
    compared = _with_date_check(compare_rows(E.fact_review(t), fact, keep=_REVIEW_MEASURED), REVIEW_DATE_ROLES, t["DimDate"])
    return one_by_one(
        [
            _measured(t["reviews"], scope, {"SourceRows": F.count("*")}),
            long_metrics(
                summarize(
                    compared,
                    {
                        **difference_measures(),
                        **profile_measures(profile),
                        **_missing_expected({"CustomerKeys": "CustomerKey", "GeographyKeys": "CustomerGeographyKey"}),
                        **_date_measures("Expected", "Actual"),
                        "InvalidReviewCounts": _bad_counter("ReviewCount"),
                    },
                    "OrderID",
                    "Orders",
                ),
                scope,
            ),
            _one(duplicate_id_groups(t["reviews"], "review_id"), scope, "ExpectedDuplicateReviewIDGroups"),
            _one(duplicate_id_groups(fact, "ReviewID"), scope, "ActualDuplicateReviewIDGroups"),
            _renamed(grain(fact, ["ReviewID", "OrderID"]), scope, {"DuplicateNaturalGrain": "DuplicateKeys"}),
            _measured(
                fact,
                scope,
                {
                    "NullReviewIDs": matches(F.col("ReviewID").isNull()),
                    "NullOrderIDs": matches(F.col("OrderID").isNull()),
                    "InvalidReviewScores": matches(F.col("ReviewScore").isNull() | ~F.col("ReviewScore").between(1, 5)),
                },
            ),
            _one(invalid_keys(fact, "CustomerKey", t["DimCustomer"], "CustomerKey"), scope, "InvalidCustomerKeys"),
            _one(invalid_keys(fact, "CustomerGeographyKey", t["DimGeography"], "GeographyKey"), scope, "InvalidGeographyKeys"),
            _one(missing_matches(fact, t["FactOrder"], "OrderID"), scope, "MissingFactOrderMatches"),
            _one(delivery_null_violations(fact, t["FactOrder"]), scope, "InvalidDeliveryFlagNullSemantics"),
            _renamed(
                childless_comparison(t["orders"], t["reviews"], t["FactOrder"], fact),
                scope,
                {
                    "SourceOrdersWithoutReviews": "ExpectedRows",
                    "FactOrdersWithoutReviews": "ActualRows",
                    "SourceNoReviewToWarehouseDiff": "SourceToTargetDifferences",
                    "WarehouseNoReviewToSourceDiff": "TargetToSourceDifferences",
                },
            ),
        ]
    )


def validate_conformed_category(t: Tables) -> DataFrame:
    scope, category = "ConformedProductCategory", t["ProductCategory"]
    missing = flag(F.col("EnglishCategoryName").isNull())
    return union_all(
        [
            _compared(E.conformed_category(t), category, scope, {}),
            _renamed(
                grain(category, ["SourceCategoryName"]),
                scope,
                {"DuplicateSourceCategories": "DuplicateKeys", "NullSourceCategories": "NullKeys"},
            ),
            _measured(
                category, scope, {"InvalidMissingFlags": matches(F.col("MissingEnglishTranslationFlag") != missing)}
            ),
        ]
    )


def validate_localization(t: Tables) -> DataFrame:
    profile = localization_profile(t["ProductCategory"], t["localization"])
    return profile.select(
        F.lit("ProductCategoryLocalization").alias("scope"),
        F.col("Metric").alias("metric"),
        F.col("Value").cast("decimal(38,2)").alias("value"),
    )


# In dependency order; validation stops at the first scope that fails.
WAREHOUSE_VALIDATORS: dict[str, Callable[[Tables], DataFrame]] = {
    "DimGeography": validate_geography,
    "DimCustomer": validate_customer,
    "DimSeller": validate_seller,
    "DimProductCategory": validate_category,
    "DimProduct": validate_product,
    "FactOrder": validate_fact_order,
    "FactOrderItem": validate_fact_order_item,
    "FactPayment": validate_fact_payment,
    "FactReview": validate_fact_review,
}
CONFORMED_VALIDATORS: dict[str, Callable[[Tables], DataFrame]] = {
    "ConformedProductCategory": validate_conformed_category,
    "ProductCategoryLocalization": validate_localization,
}
VALIDATORS = {**WAREHOUSE_VALIDATORS, **CONFORMED_VALIDATORS}


_CHILDREN = ("FactOrderItem", "FactPayment", "FactReview")


def with_order_keys(tables: Tables, scopes: Sequence[str]) -> Tables:
    """The tables, with the keys of all orders derived once if several child facts are compared."""
    if E.PLACED in tables or sum(s in _CHILDREN for s in scopes) < 2:
        return tables
    return {**tables, E.PLACED: write_scratch(E.placed_orders(tables), "placed-orders")[0]}


def rule_outcomes(tables: Tables, scopes: Sequence[str] | None = None, baseline: Mapping | None = None) -> DataFrame:
    """Every rule of the scopes with its outcome, as one frame."""
    scopes = list(scopes or VALIDATORS)
    tables = with_order_keys(tables, scopes)
    return union_all([evaluate_rules(VALIDATORS[s](tables), rules_of(s), baseline) for s in scopes])


def validate_warehouse(
    tables: Tables, scopes: Sequence[str] = tuple(WAREHOUSE_VALIDATORS), baseline: Mapping | None = None
) -> list[str]:
    """Run the validators in order; the first violated rule raises. Returns the scopes that passed."""
    passed = []
    for scope in scopes:
        if scope in _CHILDREN:
            tables = with_order_keys(tables, scopes)
        try:
            enforce(evaluate_rules(VALIDATORS[scope](tables), rules_of(scope), baseline), rules_of(scope))
        except ValidationError as error:
            error.add_note(f"passed before: {', '.join(passed) or 'none'}")
            raise
        passed.append(scope)
    return passed
