"""The hard rules of the warehouse: code, condition, message.

Conditions are SQL over the metrics of ``validators``. Counts of a particular
data set are never part of a rule: names starting with ``baseline_`` stand for
the caller's expectations.
"""

from __future__ import annotations

from stallkeep.operators.rules import Rule


def zero(*metrics: str) -> str:
    """Violated unless all are 0."""
    return " OR ".join(f"{m} <> 0" for m in metrics)


def as_expected(*metrics: str) -> str:
    """Violated unless each equals its baseline."""
    return " OR ".join(f"{m} <> baseline_{m}" for m in metrics)


def pinned(*metrics: str) -> str:
    """Violated unless the expected rows and the loaded rows both show the baseline."""
    return " OR ".join(f"{side}{m} <> baseline_{m}" for m in metrics for side in ("Expected", "Actual"))


# Rule codes, what they check and their messages, by scope, in the order they are enforced.
RULES_BY_SCOPE = {
    "DimGeography": (
        (51120, "ExpectedBusinessRows <> baseline_BusinessRows", "conformed Geography baseline row count changed."),
        (51121, "ActualBusinessRows <> ExpectedBusinessRows OR ActualTotalRows <> ExpectedBusinessRows + 1", "row count mismatch."),
        (51122, "UnknownRows <> 1 OR ValidUnknownRows <> 1", "invalid Unknown member."),
        (51123, "DistinctBusinessZIPs <> ExpectedBusinessRows OR DuplicateBusinessZIPGroups <> 0", "duplicate or invalid business ZIP grain."),
        (51124, zero("MissingConformedZIPs"), "one or more conformed ZIPs are missing."),
        (51125, zero("SourceToTargetDifferences"), "source-to-target differences detected."),
        (51126, zero("TargetToSourceDifferences"), "target-to-source differences detected."),
        (51127, as_expected("NullCities"), "unexpected NULL city count."),
        (51128, as_expected("ZIPsWithoutCoordinates", "MissingFromGeolocation"), "unexpected missing-coordinate profile."),
        (51129, as_expected("StateConflicts", "StateAmbiguous"), "unexpected state-resolution profile."),
        (51130, as_expected("CityAmbiguous", "CitiesResolvedByReference"), "unexpected city-resolution profile."),
        (51131, as_expected("ReferenceFallbackZIPs"), "unexpected reference-fallback count."),
    ),
    "DimCustomer": (
        (51140, "ConformedBusinessRows <> baseline_BusinessRows", "conformed Customer baseline row count changed."),
        (51141, "ExpectedResolvedRows <> ConformedBusinessRows", "one or more conformed customers could not resolve to DimGeography."),
        (51142, "ActualBusinessRows <> ConformedBusinessRows OR ActualTotalRows <> ConformedBusinessRows + 1", "row count mismatch."),
        (51143, "UnknownRows <> 1", "expected exactly one Unknown member."),
        (51144, "DistinctBusinessCustomers <> ConformedBusinessRows OR DuplicateBusinessKeyGroups <> 0", "duplicate or invalid customer business-key grain."),
        (51145, zero("InvalidBusinessGeographyKeys"), "invalid RepresentativeGeographyKey detected."),
        (51146, zero("SourceToTargetDifferences"), "source-to-target differences detected."),
        (51147, zero("TargetToSourceDifferences"), "target-to-source differences detected."),
        (51148, as_expected("ReturningCustomers"), "unexpected returning-customer count."),
        (51149, as_expected("CustomersWithMultipleZIPs"), "unexpected multiple-ZIP customer count."),
        (51150, as_expected("CustomersWithMultipleStates"), "unexpected multiple-state customer count."),
        (51151, as_expected("CustomersWithMultipleCities"), "unexpected multiple-city customer count."),
        (51152, as_expected("LatestTimestampTies"), "unexpected latest-timestamp tie count."),
    ),
    "DimSeller": (
        (51160, "SourceSellerCount <> baseline_SellerCount", "staging Seller baseline row count changed."),
        (51161, "TargetBusinessCount <> SourceSellerCount OR TargetTotalRows <> SourceSellerCount + 1", "row count mismatch."),
        (51162, "ValidUnknownRows <> 1", "invalid Unknown member."),
        (51163, "DistinctBusinessSellerIDs <> SourceSellerCount OR DuplicateSellerIDs <> 0 OR NullBusinessSellerIDs <> 0", "invalid SellerID business-key grain."),
        (51164, zero("MissingGeographyKeys"), "seller ZIP missing from DimGeography."),
        (51165, zero("InvalidGeographyKeys"), "invalid business GeographyKey detected."),
        (51166, zero("SourceToTargetDifferences"), "source-to-target differences detected."),
        (51167, zero("TargetToSourceDifferences"), "target-to-source differences detected."),
        (51168, pinned("CityMismatches"), "unexpected city-mismatch profile."),
        (51169, pinned("StateMismatches"), "unexpected state-mismatch profile."),
    ),
    "DimProductCategory": (
        (51180, "ExpectedBusinessRows <> baseline_BusinessRows", "conformed category baseline row count changed."),
        (51181, "ActualBusinessRows <> ExpectedBusinessRows OR ActualTotalRows <> ExpectedBusinessRows + 1", "row count mismatch."),
        (51182, "ValidUnknownRows <> 1", "invalid Unknown member."),
        (51183, zero("DuplicateSourceCategories", "NullBusinessCategories"), "invalid source-category business-key grain."),
        (51184, zero("InvalidEnglishFlags"), "invalid English translation flags."),
        (51185, zero("InvalidPersianFlags"), "invalid Persian localization flags."),
        (51186, zero("MissingPersianNames"), "missing Persian category name."),
        (51187, zero("SourceToTargetDifferences"), "source-to-target differences detected."),
        (51188, zero("TargetToSourceDifferences"), "target-to-source differences detected."),
        (51189, pinned("MissingEnglishTranslations"), "unexpected missing-English-translation profile."),
        (51190, pinned("MissingPersianLocalizations"), "unexpected Persian-localization profile."),
    ),
    "DimProduct": (
        (51200, "ExpectedBusinessRows <> baseline_BusinessRows", "staging Product baseline row count changed."),
        (51201, "ActualBusinessRows <> ExpectedBusinessRows OR ActualTotalRows <> ExpectedBusinessRows + 1", "row count mismatch."),
        (51202, "ValidUnknownRows <> 1", "invalid Unknown member."),
        (51203, "DistinctBusinessProductIDs <> ExpectedBusinessRows OR DuplicateProductIDs <> 0 OR NullBusinessProductIDs <> 0", "invalid ProductID business-key grain."),
        (51204, zero("InvalidCategoryKeys"), "invalid ProductCategoryKey detected."),
        (51205, zero("UnresolvedCategories"), "non-null source category did not resolve."),
        (51206, zero("SourceToTargetDifferences"), "source-to-target differences detected."),
        (51207, zero("TargetToSourceDifferences"), "target-to-source differences detected."),
        (51208, pinned("UnknownCategoryRows"), "unexpected Unknown-category profile."),
        (51209, pinned("MissingSourceCategory"), "unexpected missing-source-category profile."),
        (51210, pinned("MissingDescriptiveAttributes"), "unexpected missing-descriptive-attributes profile."),
        (51211, pinned("MissingPhysicalAttributes"), "unexpected missing-physical-attributes profile."),
        (51212, pinned("ZeroWeight"), "unexpected zero-weight profile."),
    ),
    "FactOrder": (
        (51220, "SourceOrderRows <> baseline_OrderRows", "staging Order baseline row count changed."),
        (51221, "ExpectedRows <> SourceOrderRows", "expected-row construction lost or duplicated source orders."),
        (51222, "ActualRows <> ExpectedRows", "row count mismatch."),
        (51223, "DistinctOrderIDs <> ExpectedRows OR DuplicateOrderIDs <> 0 OR NullOrderIDs <> 0", "invalid OrderID grain."),
        (51224, zero("MissingExpectedCustomerKeys"), "expected customer did not resolve."),
        (51225, zero("MissingExpectedGeographyKeys"), "expected customer geography did not resolve."),
        (51226, zero("InvalidCustomerKeys"), "invalid CustomerKey detected."),
        (51227, zero("InvalidGeographyKeys"), "invalid CustomerGeographyKey detected."),
        (51228, zero("InvalidDateKeys"), "invalid DateKey detected."),
        (51229, zero("InvalidOrderCounts"), "invalid OrderCount."),
        (51230, zero("SourceToTargetDifferences"), "source-to-target differences detected."),
        (51231, zero("TargetToSourceDifferences"), "target-to-source differences detected."),
        (51232, pinned("CarrierBeforePurchase"), "unexpected carrier-before-purchase profile."),
        (51233, pinned("CarrierBeforeApproval"), "unexpected carrier-before-approval profile."),
        (51234, pinned("DeliveredBeforeCarrier"), "unexpected delivered-before-carrier profile."),
        (51235, pinned("DeliveredLate"), "unexpected delivered-late profile."),
        (51236, pinned("UndeliveredLateStatus"), "unexpected undelivered late-status profile."),
    ),
    "FactOrderItem": (
        (51240, "SourceRows <> baseline_Rows", "staging order-item baseline row count changed."),
        (51241, "ExpectedRows <> SourceRows", "expected-row construction lost or duplicated source rows."),
        (51242, "ActualRows <> ExpectedRows", "row count mismatch."),
        (51243, zero("DuplicateNaturalGrain", "NullOrderIDs", "InvalidOrderItemIDs"), "invalid natural grain."),
        (51244, zero("MissingExpectedProductKeys", "MissingExpectedSellerKeys", "MissingExpectedCustomerKeys", "MissingExpectedGeographyKeys"), "expected dimension resolution failure."),
        (51245, zero("InvalidProductKeys", "InvalidSellerKeys", "InvalidCustomerKeys", "InvalidGeographyKeys"), "invalid dimension key detected."),
        (51246, zero("InvalidDateKeys"), "invalid DateKey detected."),
        (51247, zero("InvalidOrderItemCounts"), "invalid OrderItemCount."),
        (51248, zero("MissingFactOrderMatches"), "OrderID missing from FactOrder."),
        (51249, zero("SourceToTargetDifferences"), "source-to-target differences detected."),
        (51250, zero("TargetToSourceDifferences"), "target-to-source differences detected."),
        (51251, pinned("PriceAmount"), "unexpected total price profile."),
        (51252, pinned("FreightAmount"), "unexpected total freight profile."),
        (51253, pinned("ZeroFreightRows"), "unexpected zero-freight profile."),
        (51254, "ExpectedZeroPriceRows <> ActualZeroPriceRows", "zero-price profile differs between source and target."),
    ),
    "FactPayment": (
        (51260, "SourceRows <> baseline_Rows", "staging payment baseline row count changed."),
        (51261, "ExpectedRows <> SourceRows", "expected-row construction lost or duplicated source rows."),
        (51262, "ActualRows <> ExpectedRows", "row count mismatch."),
        (51263, pinned("DistinctOrders"), "unexpected distinct-order count."),
        (51264, zero("DuplicateNaturalGrain", "NullOrderIDs", "InvalidPaymentSequential"), "invalid payment natural grain."),
        (51265, zero("MissingExpectedCustomerKeys", "MissingExpectedGeographyKeys"), "expected dimension resolution failure."),
        (51266, zero("InvalidCustomerKeys", "InvalidGeographyKeys", "InvalidDateKeys"), "invalid dimension surrogate key detected."),
        (51267, zero("InvalidPaymentCounts"), "invalid PaymentCount."),
        (51268, zero("MissingFactOrderMatches"), "OrderID missing from FactOrder."),
        (51269, (
                "SourceOrdersWithoutPayments <> baseline_OrdersWithoutPayments"
                " OR FactOrdersWithoutPayments <> baseline_OrdersWithoutPayments"
                " OR SourceNoPaymentToWarehouseDiff <> 0"
                " OR WarehouseNoPaymentToSourceDiff <> 0"
            ), "no-payment order set differs from source."),
        (51270, zero("SourceToTargetDifferences"), "source-to-target differences detected."),
        (51271, zero("TargetToSourceDifferences"), "target-to-source differences detected."),
        (51272, pinned("PaymentAmount"), "unexpected total payment amount."),
        (51273, pinned("SequenceAnomalyOrders"), "unexpected payment-sequence anomaly order count."),
        (51274, pinned("SequenceAnomalyRows"), "unexpected payment-sequence anomaly row count."),
        (51275, pinned("UndefinedPaymentTypes"), "unexpected undefined-payment-type profile."),
        (51276, pinned("ZeroInstallments"), "unexpected zero-installment profile."),
        (51277, pinned("ZeroPaymentValues"), "unexpected zero-payment-value profile."),
    ),
    "FactReview": (
        (51300, "SourceRows <> baseline_Rows", "staging review baseline row count changed."),
        (51301, "ExpectedRows <> SourceRows", "expected-row construction lost or duplicated source rows."),
        (51302, "ActualRows <> ExpectedRows", "row count mismatch."),
        (51303, pinned("DistinctOrders"), "unexpected distinct-order count."),
        (51304, zero("DuplicateNaturalGrain", "NullReviewIDs", "NullOrderIDs"), "invalid ReviewID + OrderID grain."),
        (51305, zero("InvalidReviewScores"), "invalid review score."),
        (51306, zero("InvalidReviewCounts"), "invalid ReviewCount."),
        (51307, zero("MissingExpectedCustomerKeys", "MissingExpectedGeographyKeys"), "expected dimension resolution failure."),
        (51308, zero("MissingExpectedDateKeys"), "source review date missing from DimDate."),
        (51309, zero("InvalidCustomerKeys", "InvalidGeographyKeys", "InvalidDateKeys"), "invalid dimension surrogate key detected."),
        (51310, zero("MissingFactOrderMatches"), "OrderID missing from FactOrder."),
        (51311, zero("InvalidDeliveryFlagNullSemantics"), "invalid delivery-relative NULL semantics."),
        (51312, (
                "SourceOrdersWithoutReviews <> baseline_OrdersWithoutReviews"
                " OR FactOrdersWithoutReviews <> baseline_OrdersWithoutReviews"
                " OR SourceNoReviewToWarehouseDiff <> 0"
                " OR WarehouseNoReviewToSourceDiff <> 0"
            ), "no-review order set differs from source."),
        (51313, zero("SourceToTargetDifferences"), "source-to-target differences detected."),
        (51314, zero("TargetToSourceDifferences"), "target-to-source differences detected."),
        (51315, pinned("ReviewScore"), "unexpected total review-score profile."),
        (51316, pinned("DuplicateReviewIDGroups", "DuplicateReviewIDRows"), "unexpected duplicate ReviewID profile."),
        (51317, pinned("CreatedBeforePurchase", "CreatedBeforeDelivery", "CreatedBeforeDeliveryNull"), "unexpected review-creation temporal profile."),
        (51318, pinned("AnsweredBeforePurchase", "AnsweredBeforeDelivery", "AnsweredBeforeDeliveryNull", "AnsweredBeforeCreation"), "unexpected review-answer temporal profile."),
    ),
    "ConformedProductCategory": (
        (51000, "ExpectedRows <> ActualRows", "row count mismatch."),
        (51001, zero("DuplicateSourceCategories"), "duplicate source category."),
        (51002, zero("NullSourceCategories"), "NULL source category."),
        (51003, zero("InvalidMissingFlags"), "invalid missing-translation flag."),
        (51004, zero("SourceToTargetDifferences"), "expected rows missing or different."),
        (51005, zero("TargetToSourceDifferences"), "unexpected target rows."),
    ),
    "ProductCategoryLocalization": (
        (51000, "LocalizationRows <> CategoryRows", "row count mismatch."),
        (51001, zero("MissingPersianNames"), "missing Persian category name."),
        (51002, zero("MissingLocalizationRows"), "missing localization row."),
        (51003, zero("OrphanLocalizationRows"), "orphan localization row."),
    ),
}

RULES = [
    Rule(scope, code, violated_when, message)
    for scope, rules in RULES_BY_SCOPE.items()
    for code, violated_when, message in rules
]


def rules_of(scope: str) -> list[Rule]:
    return [r for r in RULES if r.scope == scope]
