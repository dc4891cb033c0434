import tempfile
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import fixtures
from conftest import rows
from stallkeep.operators.compare import differences
from stallkeep.operators.rules import ValidationError
from stallkeep.plans import category, checks, customer, dates, dimensions, expected, facts, gates, geography, measures, source_audit, validators
from stallkeep.plans.refresh import FACTS, STAGING, Refresh, full_refresh
from stallkeep.sources import Store


@pytest.fixture(scope="module")
def t(spark):
    return {n: df.cache() for n, df in fixtures.tables(spark).items()}


@pytest.fixture(scope="module")
def store(spark, t):
    store = Store(spark, tempfile.mkdtemp(prefix="stallkeep-shop-"))
    run = store.new_run()
    for name in STAGING:
        store.write(run, name, t[name])
    store.publish(run, STAGING)
    return store


@pytest.fixture(scope="module")
def w(store):
    return dict(Refresh(store).build())


@pytest.fixture(scope="module")
def geo(w):
    return {r.ZipCodePrefix: r for r in w["Geography"].collect()}


def test_geography_states(geo):
    assert (geo["00002"].StateCode, geo["00002"].StateConflictFlag, geo["00002"].StateAmbiguousFlag) == ("SP", 1, 0)
    assert (geo["00003"].StateCode, geo["00003"].StateResolvedByReferenceFlag) == ("RJ", 1)
    assert (geo["00004"].StateCode, geo["00004"].StateAmbiguousFlag, geo["00004"].CityName) == (None, 1, None)
    assert (geo["00001"].StateCode, geo["00001"].StateConflictFlag) == ("SP", 0)


def test_geography_cities(geo):
    # 2:2 spellings of one key: the alphabetically first
    assert geo["00001"].CityName == "sao paulo"
    assert geo["00002"].CityName == "rio claro"
    assert (geo["00005"].CityName, geo["00005"].CityAmbiguousFlag) == (None, 1)


def test_geography_fallback(geo):
    row = geo["00009"]
    assert (row.CityName, row.StateCode, row.RepresentativeLatitude) == ("natal", "RN", None)
    assert (row.MissingFromGeolocationFlag, row.ReferenceFallbackFlag, row.GeolocationSourceRowCount) == (1, 1, 0)
    assert (geo["00001"].MissingFromGeolocationFlag, geo["00001"].ReferenceFallbackFlag) == (0, 0)


def test_geography_medians_ignore_exact_duplicates(geo):
    # distinct pairs of 00001: -23.1, -23.3, -23.7, -23.9
    assert geo["00001"].RepresentativeLatitude == Decimal("-23.5")
    assert geo["00002"].RepresentativeLatitude == Decimal("-22.2")
    assert geo["00004"].RepresentativeLatitude is None


def test_geography_does_not_depend_on_the_hot_path_or_partitions(spark, t, w):
    again = geography.conformed_geography(
        t["geolocation"].repartition(7), t["customers"].repartition(3), t["sellers"]
    )
    d = differences(w["Geography"], again).first()
    assert (d.ExpectedRows, d.SourceToTargetDifferences, d.TargetToSourceDifferences) == (6, 0, 0)


def test_geography_profile_and_coverage(w, t):
    p = geography.geography_profile(w["Geography"]).first()
    assert (p.RowCount, p.StateConflicts, p.StateAmbiguous, p.StatesResolvedByReference) == (6, 3, 1, 1)
    assert geography.required_zip_coverage(w["Geography"], t["customers"], t["sellers"]).first()[0] == 0
    assert [r.ZipCodePrefix for r in geography.unresolved_geography(w["Geography"]).collect()] == ["00004", "00005"]


def test_latest_customer_and_ties(w):
    got = {r.CustomerUniqueID: r for r in w["Customer"].collect()}
    assert (got["u1"].RepresentativeCustomerID, got["u1"].ZipCodePrefix, got["u1"].CustomerIDCount, got["u1"].OrderCount) == ("c2", "00002", 2, 2)
    assert (got["u2"].LatestTimestampTieFlag, got["u2"].OrderCount, got["u1"].LatestTimestampTieFlag) == (1, 2, 0)
    assert (got["u1"].DistinctCityCount, got["u1"].DistinctZIPCount, got["u1"].DistinctStateCount) == (2, 2, 1)


def test_tie_goes_to_the_higher_order(spark):
    customers = spark.createDataFrame(
        [("a", "u", "1", "x", "SP"), ("b", "u", "2", "y", "RJ")],
        "customer_id string, customer_unique_id string, customer_zip_code_prefix string, customer_city string, customer_state string",
    )
    orders = spark.createDataFrame([("o1", "b", "2018-01-01"), ("o2", "a", "2018-01-01")], "order_id string, customer_id string, d string").select(
        "order_id", "customer_id", F.col("d").cast("timestamp_ntz").alias("order_purchase_timestamp")
    )
    row = customer.conformed_customer(customers, orders).first()
    assert (row.RepresentativeCustomerID, row.LatestTimestampTieFlag) == ("a", 1)
    assert customer.tie_geography_conflicts(customers, orders).first()[0] == 1


def test_categories(w):
    got = {r.SourceCategoryName: (r.EnglishCategoryName, r.MissingEnglishTranslationFlag) for r in w["ProductCategory"].collect()}
    assert got == {"toys": ("Toys", 0), "garden": (None, 1)}


def test_blank_persian_names_count_as_missing(spark, w):
    seed = spark.createDataFrame([("toys", "  "), ("music", "x")], "SourceCategoryName string, PersianCategoryName string")
    profile = {r.Metric: r.Value for r in category.localization_profile(w["ProductCategory"], seed).collect()}
    assert profile["MissingPersianNames"] == 1 and profile["MissingLocalizationRows"] == 1 and profile["OrphanLocalizationRows"] == 1
    flags = {r.SourceCategoryName: r.MissingPersianLocalizationFlag for r in category.localized_categories(w["ProductCategory"], seed).collect()}
    assert flags == {"toys": 1, "garden": 1}


def test_dates(w, t):
    d = w["DimDate"]
    assert d.count() == 365 * 2 + 1 and d.filter("DateKey = 0").count() == 1
    assert dates.missing_source_dates(dates.source_dates(t["orders"], t["order_items"], t["reviews"]), d).isEmpty()
    empty = [df.limit(0) for df in (t["orders"], t["order_items"], t["reviews"])]
    with pytest.raises(dates.EmptySourceError):
        dates.require_dates(dates.source_date_range(*empty))


def test_sellers(w):
    got = {r.SellerID: (r.CityMismatchFlag, r.StateMismatchFlag) for r in w["DimSeller"].filter("SellerKey > 0").collect()}
    # s3: geography has no city
    assert got == {"s1": (0, 0), "s2": (1, 0), "s3": (1, 0)}


def test_seller_zip_unknown_to_geography(spark, w):
    sellers = spark.createDataFrame([("s9", "99999", "x", "SP")], "seller_id string, seller_zip_code_prefix string, seller_city string, seller_state string")
    row = dimensions.seller_mismatches(sellers, w["Geography"]).first()
    assert (row.CityMismatchFlag, row.StateMismatchFlag) == (1, 1)
    with pytest.raises(Exception, match="no GeographyKey"):
        dimensions.seller_members(sellers, w["DimGeography"]).collect()


def test_products(w, t):
    got = {r.ProductID: r for r in w["DimProduct"].collect()}
    assert (got["p2"].ProductCategoryKey, got["p2"].MissingSourceCategoryFlag, got["p2"].MissingDescriptiveAttributesFlag) == (0, 1, 1)
    assert (got["p3"].ZeroWeightFlag, got["p4"].ZeroWeightFlag, got["p4"].MissingPhysicalAttributesFlag) == (1, 0, 1)
    with pytest.raises(Exception, match="no ProductCategoryKey"):
        dimensions.product_members(t["products"], w["DimProductCategory"].filter("SourceCategoryName = 'toys'")).collect()


def test_reload_is_refused(w):
    with pytest.raises(ValidationError) as failure:
        dimensions.refuse_reload(w["DimSeller"], "DimSeller")
    assert failure.value.code == 51043
    dimensions.refuse_reload(w["DimSeller"].filter("SellerKey = 0"), "DimSeller")


def test_order_flags(w):
    got = {r.OrderID: r for r in w["FactOrder"].collect()}
    assert [got[o].DeliveredLateFlag for o in ("o1", "o2", "o3", "o4", "o5")] == [0, 1, None, 0, None]
    assert [got[o].CarrierBeforePurchaseFlag for o in ("o1", "o3", "o4")] == [0, 1, 0]
    assert [got[o].CarrierBeforeApprovalFlag for o in ("o1", "o2", "o3")] == [0, 1, 0]
    assert (got["o4"].EstimatedDeliveryDateKey, got["o3"].ApprovedDateKey, got["o4"].CarrierDateKey) == (0, 0, 0)
    assert got["o1"].PurchaseDateKey == 20170320


def test_order_geography_is_that_of_the_order(w):
    """u1 lives in 00002 but ordered o1 from 00001."""
    keys = {r.ZipCodePrefix: r.GeographyKey for r in w["DimGeography"].collect()}
    got = {r.OrderID: r.CustomerGeographyKey for r in w["FactOrder"].collect()}
    assert got["o1"] == keys["00001"] and got["o2"] == keys["00002"]


def test_payment_flags(w):
    got = {(r.OrderID, r.PaymentSequential): r for r in w["FactPayment"].collect()}
    assert {k: r.PaymentSequenceAnomalyFlag for k, r in got.items()} == {
        ("o1", 1): 0, ("o2", 2): 1, ("o3", 2): 1, ("o3", 3): 1, ("o5", 1): 1, ("o5", 3): 1,
    }
    row = got[("o3", 2)]
    assert (row.UndefinedPaymentTypeFlag, row.ZeroInstallmentFlag, row.ZeroPaymentValueFlag) == (1, 1, 0)
    assert got[("o3", 3)].ZeroPaymentValueFlag == 1


def test_review_flags(w):
    got = {(r.ReviewID, r.OrderID): r for r in w["FactReview"].collect()}
    a, b, c = got[("r1", "o1")], got[("r1", "o2")], got[("r2", "o3")]
    # created on the purchase day at an earlier clock time: not before by date
    assert (a.ReviewCreatedBeforePurchaseFlag, b.ReviewCreatedBeforePurchaseFlag) == (0, 1)
    # answered one second before delivery
    assert (a.ReviewAnsweredBeforeDeliveryFlag, b.ReviewAnsweredBeforeDeliveryFlag) == (1, 0)
    assert (c.ReviewCreatedBeforeDeliveryFlag, c.ReviewAnsweredBeforeDeliveryFlag) == (None, None)
    assert (a.DuplicateReviewIDFlag, c.DuplicateReviewIDFlag) == (1, 0)


def test_hot_orders_take_the_same_flags(t):
    plain = facts.with_sequence_anomaly(t["payments"])
    assert rows(facts.with_sequence_anomaly(t["payments"].repartition(5), hot_rows=1)) == rows(plain)
    assert rows(facts.with_duplicate_review_flag(t["reviews"], hot_rows=1)) == rows(facts.with_duplicate_review_flag(t["reviews"]))


def test_loads_equal_their_second_derivation(w):
    for name, build, key in (
        ("DimGeography", expected.dim_geography, "GeographyKey"), ("DimCustomer", expected.dim_customer, "CustomerKey"),
        ("DimSeller", expected.dim_seller, "SellerKey"), ("DimProductCategory", expected.dim_category, "ProductCategoryKey"),
        ("DimProduct", expected.dim_product, "ProductKey"), ("FactOrder", expected.fact_order, None),
        ("FactOrderItem", expected.fact_order_item, None), ("FactPayment", expected.fact_payment, None), ("FactReview", expected.fact_review, None),
    ):
        actual = w[name].filter(F.col(key) != 0) if key else w[name]
        d = differences(build(w), actual).first()
        assert (d.SourceToTargetDifferences, d.TargetToSourceDifferences) == (0, 0), name
        assert d.ExpectedRows == d.ActualRows > 0


def test_one_changed_row_shows_once_in_each_direction(w):
    broken = w["FactPayment"].withColumn(
        "PaymentAmount", F.when(F.col("OrderID") == "o1", F.lit("1.00").cast("decimal(18,2)")).otherwise(F.col("PaymentAmount"))
    )
    d = differences(expected.fact_payment(w), broken).first()
    assert (d.SourceToTargetDifferences, d.TargetToSourceDifferences) == (1, 1)
    with pytest.raises(ValidationError) as failure:
        validators.validate_warehouse({**w, "FactPayment": broken})
    assert (failure.value.scope, failure.value.code) == ("FactPayment", 51270)


@pytest.mark.parametrize(
    "table, change, code",
    [
        # Without the Unknown member the total is already wrong; a changed one fails by its values.
        ("DimGeography", lambda df: df.filter("GeographyKey <> 0"), 51121),
        ("DimGeography", lambda df: df.replace("Unknown", "unknown", "CityName"), 51122),
        ("DimGeography", lambda df: df.filter("ZipCodePrefix IS NULL OR ZipCodePrefix <> '00004'"), 51121),
        ("DimCustomer", lambda df: df.withColumn("RepresentativeGeographyKey", F.lit(0).cast("long")), 51145),
        ("DimProductCategory", lambda df: df.withColumn("MissingEnglishTranslationFlag", F.lit(1)), 51182),
        ("FactOrder", lambda df: df.withColumn("OrderCount", F.lit(2)), 51229),
        ("FactOrder", lambda df: df.withColumn("PurchaseDateKey", F.lit(19000101)), 51228),
        ("FactOrderItem", lambda df: df.withColumn("ProductKey", F.lit(0).cast("long")), 51245),
        ("FactReview", lambda df: df.withColumn("ReviewScore", F.lit(9)), 51305),
        ("FactReview", lambda df: df.union(df), 51302),
        ("FactPayment", lambda df: df.filter("OrderID <> 'o2'"), 51262),
    ],
)
def test_broken_tables_fail_with_their_code(w, table, change, code):
    with pytest.raises(ValidationError) as failure:
        validators.validate_warehouse({**w, table: change(w[table])})
    assert failure.value.code == code and failure.value.scope == table


def test_tri_state_violations_are_found(w):
    wrong = w["FactReview"].withColumn("ReviewCreatedBeforeDeliveryFlag", F.coalesce("ReviewCreatedBeforeDeliveryFlag", F.lit(0)))
    assert validators.delivery_null_violations(wrong, w["FactOrder"]).first()[0] == 1
    assert validators.delivery_null_violations(w["FactReview"], w["FactOrder"]).first()[0] == 0


def test_baselines_are_compared(w):
    good = {"FactOrder": {"OrderRows": 5, "DeliveredLate": 1, "UndeliveredLateStatus": 2}}
    validators.validate_warehouse(w, ["FactOrder"], good)
    with pytest.raises(ValidationError) as failure:
        validators.validate_warehouse(w, ["FactOrder"], {"FactOrder": {"DeliveredLate": 2}})
    assert failure.value.code == 51235


def test_gates(w, t):
    for gate in gates.GATES:
        assert {r.violated for r in gates.gate_outcomes(w, gate).collect()} == {0}
    with pytest.raises(ValidationError) as failure:
        gates.pass_gate({**w, "payments": t["payments"].limit(0)}, "Preflight")
    assert failure.value.code == 51058
    with pytest.raises(ValidationError) as failure:
        gates.pass_gate({**w, "DimDate": w["DimDate"].filter("DateKey <> 20170320")}, "Preflight")
    assert failure.value.code == 51057
    with pytest.raises(ValidationError) as failure:
        gates.pass_gate({**w, "DimSeller": w["DimSeller"].filter("SellerKey <> 0")}, "DimensionGate")
    assert failure.value.code == 51062
    with pytest.raises(ValidationError) as failure:
        gates.pass_gate({**w, "FactOrder": w["FactOrder"].filter("OrderID <> 'o1'")}, "FactGate")
    assert failure.value.code == 51080
    with pytest.raises(ValidationError) as failure:
        gates.require_tables(["DimDate", "Geography"])
    assert failure.value.code == 51054


def test_full_refresh_publishes_only_what_passes(spark, store):
    published = set(store.published())
    assert "FactOrder" not in published
    with pytest.raises(ValidationError) as failure:
        full_refresh(store, {"DimProduct": {"ZeroWeight": 99}})
    assert failure.value.code == 51212
    assert set(store.published()) == published
    with pytest.raises(ValidationError) as failure:
        full_refresh(store, target="/somewhere/else")
    assert failure.value.code == 51040
    assert full_refresh(store) == list(validators.WAREHOUSE_VALIDATORS)
    first = {n: store.table(n) for n in ("DimCustomer", *FACTS)}
    assert rows(first["DimCustomer"], "CustomerKey") == [(0,), (1,), (2,), (3,)]
    full_refresh(store)
    for name, before in first.items():
        d = differences(before, store.table(name)).first()
        assert (d.SourceToTargetDifferences, d.TargetToSourceDifferences) == (0, 0)


def test_measures(w):
    sales = {(r.PurchaseMonth, r.EnglishCategoryName): (r.ItemSales, r.Freight, r.Items) for r in measures.item_sales(w["FactOrderItem"], w["DimProduct"], w["DimProductCategory"]).collect()}
    assert sales[(201703, "Toys")] == (Decimal("20.00"), Decimal("5.00"), 2)
    assert sales[(201703, "Unknown")] == (Decimal("20.00"), Decimal("0.00"), 1)
    month = {r.PurchaseMonth: r for r in measures.delivery_performance(w["FactOrder"]).collect()}
    assert (month[201703].OnTimeRate, month[201703].AvgDeliveryDays, month[201805].OnTimeRate) == (0.5, 5.0, None)
    late = measures.late_by_day_and_time(w["FactOrder"]).first()
    assert (late.LateByDate, late.LateByTimestamp, late.BoundaryDayOrders) == (1, 2, 1)
    value = {r.PurchaseMonth: r.AverageOrderValue for r in measures.average_order_value(w["FactPayment"]).collect()}
    assert value == {201703: Decimal("22.50"), 201801: Decimal("6.00"), 201805: Decimal("10.99")}
    unknown = measures.unknown_date_keys(w["FactOrder"]).first()
    assert tuple(unknown) == (0, 2, 2, 2, 1)
    assert measures.early_answers(w["FactReview"], w["FactOrder"], days=0).count() >= 1


def test_payment_diagnostic_counts_one_sided_orders(t):
    got = source_audit.payment_item_diagnostic(t["order_items"], t["payments"]).first()
    # o1 30.00/32.50, o2 10.00/12.50, o3 5.55/6.00, o4 7.00/nothing, o5 nothing/10.99
    assert tuple(got) == (5, 5)
    m = checks.payments_metrics(t)
    values = {r.metric: r.value for r in m.collect()}
    # inner join, item + freight: only o3 (6.55 against 6.00) differs
    assert values["ReconciliationMismatchOrders"] == "1" and values["OrdersWithoutPayments"] == "1"


def test_every_check_runs(t, w):
    for name, plan in checks.METRICS.items():
        source = w if name == "Geography" else t
        assert plan(source).count() > 5
    assert rows(checks.orders_without_payments(t), "order_id", "OrderItemCount") == [("o4", 1)]
    assert "p3" in checks.zero_weight_products(t).first()[0]
