"""Reconciliation, rules, gates and the refresh."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from stallkeep.operators.compare import compare_rows, difference_measures, differences, differing_rows, profile_measures
from stallkeep.operators.quality import one_by_one, union_all
from stallkeep.operators.rules import ValidationError
from stallkeep.plans import checks, expected, gates, validators
from stallkeep.plans import facts as X
from stallkeep.plans.category import missing_persian
from stallkeep.plans.customer import customer_profile
from stallkeep.plans.dimensions import RELOAD_CODES
from stallkeep.plans.geography import geography_profile, geolocation_observations, reference_observations
from stallkeep.plans.refresh import BUILT, DIMENSIONS, FACTS, STAGING, Refresh, full_refresh
from stallkeep.plans.rule_catalog import RULES_BY_SCOPE, rules_of
from stallkeep.functions import flag, matches
from stallkeep.queries.built import staged_store, staging, warehouse
from stallkeep.queries.oracle import day_key
from stallkeep.queries.shape import micro
from stallkeep.queries.star import ORACLE as STAR
from stallkeep.session import scratch_path
from stallkeep.sources import Store

EXPECTED = {
    "DimGeography": (expected.dim_geography, "GeographyKey"),
    "DimCustomer": (expected.dim_customer, "CustomerKey"),
    "DimSeller": (expected.dim_seller, "SellerKey"),
    "DimProductCategory": (expected.dim_category, "ProductCategoryKey"),
    "DimProduct": (expected.dim_product, "ProductKey"),
    "FactOrder": (expected.fact_order, None),
    "FactOrderItem": (expected.fact_order_item, None),
    "FactPayment": (expected.fact_payment, None),
    "FactReview": (expected.fact_review, None),
}


def _expected(name):
    def query(s, d):
        df = EXPECTED[name][0](warehouse(s, d))
        if name == "DimGeography":
            df = df.withColumns({"lat_micro": micro("RepresentativeLatitude"), "lng_micro": micro("RepresentativeLongitude")})
            df = df.drop("RepresentativeLatitude", "RepresentativeLongitude")
        return df

    return query


def _all_differences(s, d):
    w = validators.with_order_keys(warehouse(s, d), FACTS)

    def parts():
        for name, (build, key) in EXPECTED.items():
            actual = w[name].filter(F.col(key) != 0) if key else w[name]
            yield differences(build(w), actual).select(F.lit(name).alias("Target"), *difference_measures())

    return one_by_one(parts())


def _zip_states(s, d):
    """(ZIP, state) pairs that only the geolocation or only the references know: EXCEPT in both directions."""
    t = staging(s, d)
    pair = ["ZipCodePrefix", "StateCode"]
    return differing_rows(
        geolocation_observations(t["geolocation"]).select(*pair), reference_observations(t["customers"], t["sellers"]).select(*pair)
    )


def _unknown(s, d):
    w = warehouse(s, d)
    parts = []
    for name, (key, _) in RELOAD_CODES.items():
        measures = validators.dimension_measures(w[name], name, key)
        parts.append(w[name].agg(*[m.alias(n) for n, m in measures.items()]).select(F.lit(name).alias("Dimension"), *measures))
    return union_all(parts)


_GRAINS = (
    ("FactOrder", ["OrderID"]), ("FactOrderItem", ["OrderID", "OrderItemID"]),
    ("FactPayment", ["OrderID", "PaymentSequential"]), ("FactReview", ["ReviewID", "OrderID"]),
)


def _grains(s, d):
    w = warehouse(s, d)
    return union_all([validators.grain(w[f], k).select(F.lit(f).alias("Fact"), "DistinctKeys", "DuplicateKeys", "NullKeys") for f, k in _GRAINS])


_KEY_ROLES = (
    ("FactOrder", "CustomerKey", "DimCustomer", "CustomerKey"), ("FactOrder", "CustomerGeographyKey", "DimGeography", "GeographyKey"),
    ("FactOrderItem", "CustomerKey", "DimCustomer", "CustomerKey"), ("FactOrderItem", "CustomerGeographyKey", "DimGeography", "GeographyKey"),
    ("FactOrderItem", "ProductKey", "DimProduct", "ProductKey"), ("FactOrderItem", "SellerKey", "DimSeller", "SellerKey"),
    ("FactPayment", "CustomerKey", "DimCustomer", "CustomerKey"), ("FactPayment", "CustomerGeographyKey", "DimGeography", "GeographyKey"),
    ("FactReview", "CustomerKey", "DimCustomer", "CustomerKey"), ("FactReview", "CustomerGeographyKey", "DimGeography", "GeographyKey"),
    ("DimCustomer", "RepresentativeGeographyKey", "DimGeography", "GeographyKey"), ("DimSeller", "GeographyKey", "DimGeography", "GeographyKey"),
    ("DimProduct", "ProductCategoryKey", "DimProductCategory", "ProductCategoryKey"),
)


def _key_integrity(s, d):
    """Rows whose key is missing or Unknown, per role (products without a category show up here)."""
    w = warehouse(s, d)
    return union_all(
        [
            validators.invalid_keys(w[f].filter(F.col(RELOAD_CODES[f][0]) != 0) if f in RELOAD_CODES else w[f], c, w[dim], k).select(
                F.lit(f"{f}.{c}").alias("Role"), "InvalidRows"
            )
            for f, c, dim, k in _KEY_ROLES
        ]
    )


_DATE_ROLES = (
    ("FactOrder", validators.ORDER_DATE_ROLES, True), ("FactOrder", ("ApprovedDateKey", "DeliveredDateKey"), False),
    ("FactOrderItem", ("PurchaseDateKey", "ShippingLimitDateKey"), False), ("FactPayment", ("PurchaseDateKey",), False),
    ("FactReview", validators.REVIEW_DATE_ROLES, False),
)


def _date_integrity(s, d):
    w = warehouse(s, d)
    return union_all(
        [
            validators.invalid_dates(w[f], roles, w["DimDate"], unknown).select(
                F.lit(f"{f}:{len(roles)}:{int(unknown)}").alias("Roles"), "InvalidRows"
            )
            for f, roles, unknown in _DATE_ROLES
        ]
    )


def _counters(s, d):
    w = warehouse(s, d)
    return union_all(
        [
            w[f].agg(F.sum(c).alias("CounterTotal"), matches(F.col(c) != 1).alias("InvalidCounters")).select(
                F.lit(f).alias("Fact"), "CounterTotal", "InvalidCounters"
            )
            for f, c in gates.FACT_COUNTERS.items()
        ]
    )


def _coverage(s, d):
    w = warehouse(s, d)
    return union_all(
        [validators.missing_matches(w[f], w["FactOrder"], "OrderID").select(F.lit(f).alias("Fact"), "MissingRows") for f in FACTS[1:]]
    )


def _childless(s, d):
    w = warehouse(s, d)
    return union_all(
        [
            validators.childless_comparison(w["orders"], w[child], w["FactOrder"], w[fact]).select(
                F.lit(fact).alias("Fact"), *difference_measures()
            )
            for child, fact in (("payments", "FactPayment"), ("reviews", "FactReview"))
        ]
    )


def _tri_state(s, d):
    w = warehouse(s, d)
    flags = w["FactReview"].groupBy("ReviewCreatedBeforeDeliveryFlag", "ReviewAnsweredBeforeDeliveryFlag").agg(F.count("*").alias("Rows"))
    bad = validators.delivery_null_violations(w["FactReview"], w["FactOrder"])
    return flags.select(
        F.coalesce(F.col("ReviewCreatedBeforeDeliveryFlag").cast("string"), F.lit("NULL")).alias("Created"),
        F.coalesce(F.col("ReviewAnsweredBeforeDeliveryFlag").cast("string"), F.lit("NULL")).alias("Answered"),
        "Rows",
    ).unionByName(bad.select(F.lit("violations").alias("Created"), F.lit("violations").alias("Answered"), F.col("InvalidRows").alias("Rows")))


def _order_profile(s, d):
    w = warehouse(s, d)
    compared = compare_rows(expected.fact_order(w), w["FactOrder"].select(*X.ORDER_COLUMNS))
    measures = profile_measures(
        {
            "CarrierBeforePurchase": F.col("CarrierBeforePurchaseFlag"),
            "CarrierBeforeApproval": F.col("CarrierBeforeApprovalFlag"),
            "DeliveredBeforeCarrier": F.col("DeliveredBeforeCarrierFlag"),
            "DeliveredLate": flag(F.col("DeliveredLateFlag") == 1),
            "UndeliveredLateStatus": flag(F.col("DeliveredLateFlag").isNull()),
        }
    )
    return compared.agg(*[m.alias(n) for n, m in measures.items()])


# Profile measures of the other facts, and the same numbers in SQL over their blocks.
PROFILES = {
    "FactOrderItem": ("fact_item", {
        "PriceAmount": "sum(PriceAmount)", "FreightAmount": "sum(FreightAmount)",
        "ZeroFreightRows": "count(*) FILTER (FreightAmount = 0)", "ZeroPriceRows": "count(*) FILTER (PriceAmount = 0)",
    }),
    "FactPayment": ("fact_payment", {
        "PaymentAmount": "sum(PaymentAmount)", "SequenceAnomalyRows": "sum(PaymentSequenceAnomalyFlag)", "UndefinedPaymentTypes": "sum(UndefinedPaymentTypeFlag)",
        "ZeroInstallments": "sum(ZeroInstallmentFlag)", "ZeroPaymentValues": "sum(ZeroPaymentValueFlag)",
    }),
    "FactReview": ("fact_review", {
        "ReviewScore": "sum(ReviewScore)", "DuplicateReviewIDRows": "sum(DuplicateReviewIDFlag)", "CreatedBeforePurchase": "sum(ReviewCreatedBeforePurchaseFlag)",
        "CreatedBeforeDelivery": "count(*) FILTER (ReviewCreatedBeforeDeliveryFlag = 1)", "CreatedBeforeDeliveryNull": "count(*) FILTER (ReviewCreatedBeforeDeliveryFlag IS NULL)",
        "AnsweredBeforePurchase": "sum(ReviewAnsweredBeforePurchaseFlag)", "AnsweredBeforeDelivery": "count(*) FILTER (ReviewAnsweredBeforeDeliveryFlag = 1)",
        "AnsweredBeforeDeliveryNull": "count(*) FILTER (ReviewAnsweredBeforeDeliveryFlag IS NULL)", "AnsweredBeforeCreation": "sum(ReviewAnsweredBeforeCreationFlag)",
    }),
}


def _fact_profiles(s, d):
    """Expected and actual profile of items, payments and reviews, as their validators measure them."""
    w = validators.with_order_keys(warehouse(s, d), FACTS)
    parts = []
    for scope, (_, numbers) in PROFILES.items():
        names = [f"{side}{n}" for n in numbers for side in ("Expected", "Actual")]
        parts.append(validators.VALIDATORS[scope](w).filter(F.col("metric").isin(names)).select("scope", "metric", "value"))
    return union_all(parts)


def _money(s, d):
    w = warehouse(s, d)
    wide = "decimal(38,2)"
    parts = []
    for name, fact, column in (("Price", "FactOrderItem", "PriceAmount"), ("Freight", "FactOrderItem", "FreightAmount"), ("Payment", "FactPayment", "PaymentAmount")):
        parts.append(w[fact].agg(F.sum(column).cast(wide).alias("Total")).select(F.lit(name).alias("Measure"), "Total"))
    return union_all(parts)


def _flag_consistency(s, d):
    c = warehouse(s, d)["DimProductCategory"].filter("ProductCategoryKey <> 0")
    english = flag(F.col("EnglishCategoryName").isNull())
    return c.agg(
        matches(F.col("MissingEnglishTranslationFlag") != english).alias("InvalidEnglishFlags"),
        matches(F.col("MissingPersianLocalizationFlag") != flag(missing_persian())).alias("InvalidPersianFlags"),
        matches(missing_persian()).alias("MissingPersianNames"),
    )


def _profile_statuses(s, d):
    """The pass lines of both conformed checks, against expectations the sources themselves give."""
    w = warehouse(s, d)
    zips = geolocation_observations(w["geolocation"]).select("ZipCodePrefix").union(
        reference_observations(w["customers"], w["sellers"]).select("ZipCodePrefix")
    )
    people = w["customers"].join(w["orders"].select("customer_id").distinct(), "customer_id", "left_semi")

    def beside(profile, expected):
        """A one-row profile and how many different rows are expected, in one row."""
        row = expected.agg(F.count_distinct(*expected.columns).alias("Expected"))
        both = profile.unionByName(row, allowMissingColumns=True)
        return both.agg(*[F.max(c).alias(c) for c in both.columns])

    geography = checks.profile_status(
        beside(geography_profile(w["Geography"]), zips), {"RowCount": "Expected", "NullStates": 0}, "CONFORMED GEOGRAPHY"
    )
    customer = checks.profile_status(
        beside(customer_profile(w["Customer"]), people.select("customer_unique_id")),
        {"RowCount": "Expected", "DistinctCustomers": "Expected", "InvalidPurchaseDateRanges": 0},
        "CONFORMED CUSTOMER",
    )
    return geography.unionByName(customer)


def _outcomes(scope):
    return lambda s, d: validators.rule_outcomes(warehouse(s, d), [scope])


def _refreshed(s, d):
    """A second refresh over the same staging tables, published, and every table it made visible."""
    store = staged_store(s, d)
    refresh = Refresh(store)
    refresh.build()
    refresh.publish()
    tables = store.tables()
    names = ["DimDate", *DIMENSIONS, *FACTS]
    return union_all([tables[n].agg(F.count("*").alias("Rows")).select(F.lit(n).alias("TableName"), "Rows") for n in names])


def _missing_tables(s, d):
    """The error the preflight raises for each prerequisite that is not published."""
    published = [*staged_store(s, d).published(), *BUILT]
    raised = []
    for table in gates.REQUIRED_TABLES:
        try:
            gates.require_tables([t for t in published if t != table])
        except ValidationError as error:
            raised.append((table, error.scope, error.code))
    return s.createDataFrame(raised, "TableName string, Scope string, Code int")


def _stopped(s, d):
    """The rule that stops the validated refresh over the role tables, whose labels are incomplete."""
    try:
        validators.validate_warehouse(warehouse(s, d))
        raised = []
    except ValidationError as error:
        raised = [(error.scope, error.code)]
    return s.createDataFrame(raised, "Scope string, Code int")


def _validated(s, d):
    """The whole refresh over complete labels, validated before it is published."""
    store = Store(s, scratch_path(s, "validated"))
    run = store.new_run()
    tables = staging(s, d)
    label = F.col("PersianCategoryName")
    filled = tables["localization"].withColumn("PersianCategoryName", F.when(F.trim(label) == "", F.lit("fa")).otherwise(label))
    store.write(run, "localization", filled)
    paths = staged_store(s, d).paths()
    store.publish(run, {name: paths[name] for name in STAGING if name != "localization"} | {"localization": store.path(run, "localization")})
    passed = full_refresh(store)
    visible = union_all([store.table(n).agg(F.count("*").alias("Rows")).select(F.lit(n).alias("Name"), "Rows") for n in (*DIMENSIONS, *FACTS)])
    return visible.join(s.createDataFrame([(n, 1) for n in passed], "Name string, Validated int"), "Name", "left")


def _tampered_payments(s, d):
    """FactPayment with a wrong amount in second payments and a wrong counter in third ones."""
    number = F.col("PaymentSequential")
    return warehouse(s, d)["FactPayment"].withColumns(
        {
            "PaymentAmount": F.when(number == 2, F.col("PaymentAmount") + 1).otherwise(F.col("PaymentAmount")).cast("decimal(18,2)"),
            "PaymentCount": F.when(number == 3, 2).otherwise(F.col("PaymentCount")),
        }
    )


def _tampered_differences(s, d):
    """Wrong rows differ both ways, missing ones (fourth payments) one way."""
    actual = _tampered_payments(s, d).filter("PaymentSequential <> 4")
    return differences(expected.fact_payment(warehouse(s, d)), actual.select(*X.PAYMENT_COLUMNS)).select(*difference_measures())


def _tampered_rules(s, d):
    return validators.rule_outcomes({**warehouse(s, d), "FactPayment": _tampered_payments(s, d)}, ["FactPayment"])


def _tampered_gate(s, d):
    w = warehouse(s, d)
    tampered = {"FactPayment": _tampered_payments(s, d), "FactReview": w["FactReview"].filter("ReviewScore <> 5")}
    return gates.gate_outcomes({**w, **tampered}, "FactGate")


def _keys_restart(s, d):
    """Surrogate keys of a fresh run start at 0 and 1 again and are dense."""
    w = warehouse(s, d)
    return union_all(
        [
            w[n].agg(F.min(k).alias("MinKey"), F.max(k).alias("MaxKey"), F.count_distinct(k).alias("Keys")).select(
                F.lit(n).alias("Dimension"), "MinKey", "MaxKey", "Keys"
            )
            for n, (k, _) in RELOAD_CODES.items()
        ]
    )


QUERIES = {
    **{f"rec_01_expected_{re.sub('(?<!^)(?=[A-Z])', '_', n).lower()}": _expected(n) for n in EXPECTED},
    "rec_02_differences": _all_differences,
    "rec_02_differing_zip_states": _zip_states,
    "rec_03_unknown_members": _unknown,
    "rec_04_grain": _grains,
    "rec_05_key_integrity": _key_integrity,
    "rec_06_date_integrity": _date_integrity,
    "rec_07_counters": _counters,
    "rec_08_child_coverage": _coverage,
    "rec_09_childless_orders": _childless,
    "rec_10_tri_state_flags": _tri_state,
    "rec_11_order_profile": _order_profile,
    "rec_11_fact_profiles": _fact_profiles,
    "rec_12_money_totals": _money,
    "rec_13_flag_consistency": _flag_consistency,
    "rec_14_profile_statuses": _profile_statuses,
    **{f"rule_{re.sub('(?<!^)(?=[A-Z])', '_', n).lower()}": _outcomes(n) for n in RULES_BY_SCOPE},
    "gate_01_preflight": lambda s, d: gates.gate_outcomes(warehouse(s, d), "Preflight"),
    "gate_02_dimensions": lambda s, d: gates.gate_outcomes(warehouse(s, d), "DimensionGate"),
    "gate_03_facts": lambda s, d: gates.gate_outcomes(warehouse(s, d), "FactGate"),
    "gate_04_warehouse": lambda s, d: validators.rule_outcomes(warehouse(s, d), list(validators.WAREHOUSE_VALIDATORS))
    .groupBy("scope")
    .agg(F.count("*").alias("Rules"), matches(F.col("violated") == 1).alias("Violated"), matches(F.col("violated").isNull()).alias("WithoutBaseline")),
    "rec_02_tampered": _tampered_differences,
    "rule_fact_payment_tampered": _tampered_rules,
    "gate_03_tampered": _tampered_gate,
    "gate_01_missing_tables": _missing_tables,
    "run_01_full_refresh": _refreshed,
    "run_01_stopped_refresh": _stopped,
    "run_01_validated_refresh": _validated,
    "run_02_keys_restart": _keys_restart,
}

# --- SQL ------------------------------------------------------------------------

_DIM = {"DimGeography": "dim_geography", "DimCustomer": "dim_customer", "DimSeller": "dim_seller", "DimProductCategory": "dim_category", "DimProduct": "dim_product"}
_FACT = {"FactOrder": "fact_order", "FactOrderItem": "fact_item", "FactPayment": "fact_payment", "FactReview": "fact_review"}
_BLOCK = {**_DIM, **_FACT}


def _members(sql: str, key: str) -> str:
    """The business rows of a dimension query, without its surrogate key."""
    return f"SELECT * EXCLUDE ({key}) FROM ({sql}) WHERE {key} <> 0"


ORACLE = {
    "rec_01_expected_dim_geography": _members(STAR["dim_05_dim_geography"], "GeographyKey"),
    "rec_01_expected_dim_customer": _members(STAR["dim_06_dim_customer"], "CustomerKey"),
    "rec_01_expected_dim_seller": _members(STAR["dim_07_dim_seller"], "SellerKey"),
    "rec_01_expected_dim_product_category": _members(STAR["dim_08_dim_product_category"], "ProductCategoryKey"),
    "rec_01_expected_dim_product": _members(STAR["dim_09_dim_product"], "ProductKey"),
    "rec_01_expected_fact_order": STAR["fct_02_fact_order"],
    "rec_01_expected_fact_order_item": STAR["fct_05_fact_order_item"],
    "rec_01_expected_fact_payment": STAR["fct_08_fact_payment"],
    "rec_01_expected_fact_review": STAR["fct_11_fact_review"],
    "rec_02_differences": " UNION ALL ".join(
        f"SELECT '{n}' AS Target, count(*) AS ExpectedRows, count(*) AS ActualRows, CAST(0 AS BIGINT) AS SourceToTargetDifferences, CAST(0 AS BIGINT) AS TargetToSourceDifferences FROM {b}"
        for n, b in _BLOCK.items()
    ),
    "rec_02_differing_zip_states": """SELECT zip AS ZipCodePrefix, state AS StateCode, 'source only' AS Side FROM (SELECT zip, state FROM geo_obs EXCEPT SELECT zip, state FROM geo_ref)
        UNION ALL SELECT zip, state, 'target only' FROM (SELECT zip, state FROM geo_ref EXCEPT SELECT zip, state FROM geo_obs)""",
    "rec_03_unknown_members": " UNION ALL ".join(
        f"SELECT '{n}' AS Dimension, count(*) + 1 AS ActualTotalRows, count(*) AS ActualBusinessRows, CAST(1 AS BIGINT) AS UnknownRows, CAST(1 AS BIGINT) AS ValidUnknownRows FROM {b}"
        for n, b in _DIM.items()
    ),
    "rec_04_grain": " UNION ALL ".join(
        f"SELECT '{f}' AS Fact, count(*) AS DistinctKeys, count(CASE WHEN n > 1 THEN 1 END) AS DuplicateKeys, CAST(0 AS BIGINT) AS NullKeys FROM (SELECT {', '.join(k)}, count(*) AS n FROM {_FACT[f]} GROUP BY ALL)"
        for f, k in _GRAINS
    ),
    "rec_05_key_integrity": " UNION ALL ".join(
        f"SELECT '{f}.{c}' AS Role, count(*) AS InvalidRows FROM {_BLOCK[f]} f LEFT JOIN {_DIM[dim]} d ON d.{k} = f.{c} WHERE d.{k} IS NULL" for f, c, dim, k in _KEY_ROLES
    ),
    "rec_06_date_integrity": " UNION ALL ".join(
        f"SELECT '{f}:{len(roles)}:{int(u)}' AS Roles, count(*) AS InvalidRows FROM {_FACT[f]} WHERE "
        + " OR ".join(f"{r} NOT IN (SELECT {day_key('d')} FROM calendar{' UNION ALL SELECT 0' if u else ''})" for r in roles)
        for f, roles, u in _DATE_ROLES
    ),
    "rec_07_counters": " UNION ALL ".join(
        f"SELECT '{f}' AS Fact, CAST(sum({c}) AS BIGINT) AS CounterTotal, count(CASE WHEN {c} <> 1 THEN 1 END) AS InvalidCounters FROM {_FACT[f]}" for f, c in gates.FACT_COUNTERS.items()
    ),
    "rec_08_child_coverage": " UNION ALL ".join(
        f"SELECT '{f}' AS Fact, count(*) AS MissingRows FROM {_FACT[f]} WHERE OrderID NOT IN (SELECT OrderID FROM fact_order)" for f in FACTS[1:]
    ),
    "rec_09_childless_orders": " UNION ALL ".join(
        f"""SELECT '{f}' AS Fact, (SELECT count(*) FROM stg_orders WHERE order_id NOT IN (SELECT order_id FROM {c})) AS ExpectedRows,
        (SELECT count(*) FROM fact_order WHERE OrderID NOT IN (SELECT OrderID FROM {_FACT[f]})) AS ActualRows, CAST(0 AS BIGINT) AS SourceToTargetDifferences, CAST(0 AS BIGINT) AS TargetToSourceDifferences"""
        for c, f in (("stg_payments", "FactPayment"), ("stg_reviews", "FactReview"))
    ),
    "rec_10_tri_state_flags": """SELECT coalesce(CAST(ReviewCreatedBeforeDeliveryFlag AS VARCHAR), 'NULL') AS Created, coalesce(CAST(ReviewAnsweredBeforeDeliveryFlag AS VARCHAR), 'NULL') AS Answered, count(*) AS "Rows"
        FROM fact_review GROUP BY 1, 2
        UNION ALL SELECT 'violations', 'violations', count(*) FROM fact_review r JOIN fact_order o ON o.OrderID = r.OrderID
        WHERE (o.DeliveredCustomerTimestamp IS NULL) <> (r.ReviewCreatedBeforeDeliveryFlag IS NULL) OR (o.DeliveredCustomerTimestamp IS NULL) <> (r.ReviewAnsweredBeforeDeliveryFlag IS NULL)""",
    "rec_12_money_totals": """SELECT 'Price' AS Measure, CAST(sum(PriceAmount) AS DOUBLE) AS Total FROM fact_item UNION ALL SELECT 'Freight', CAST(sum(FreightAmount) AS DOUBLE) FROM fact_item
        UNION ALL SELECT 'Payment', CAST(sum(PaymentAmount) AS DOUBLE) FROM fact_payment""",
    "rec_13_flag_consistency": """SELECT count(CASE WHEN (EnglishCategoryName IS NULL) <> (MissingEnglishTranslationFlag = 1) THEN 1 END) AS InvalidEnglishFlags,
        count(CASE WHEN (PersianCategoryName IS NULL OR trim(PersianCategoryName) = '') <> (MissingPersianLocalizationFlag = 1) THEN 1 END) AS InvalidPersianFlags,
        count(CASE WHEN PersianCategoryName IS NULL OR trim(PersianCategoryName) = '' THEN 1 END) AS MissingPersianNames FROM dim_category""",
    "rec_14_profile_statuses": """SELECT CASE WHEN (SELECT count(*) FROM conf_geography) = (SELECT count(*) FROM geo_universe) AND (SELECT count(*) FROM conf_geography WHERE StateCode IS NULL) = 0
          THEN 'CONFORMED GEOGRAPHY VALIDATION PASSED' ELSE 'CONFORMED GEOGRAPHY VALIDATION FAILED' END AS ValidationStatus
        UNION ALL SELECT CASE WHEN (SELECT count(DISTINCT CustomerUniqueID) FROM conf_customer) = (SELECT count(DISTINCT uid) FROM cust_orders) AND (SELECT count(*) FROM conf_customer WHERE first_ts > last_ts) = 0
          THEN 'CONFORMED CUSTOMER VALIDATION PASSED' ELSE 'CONFORMED CUSTOMER VALIDATION FAILED' END""",
    "run_01_full_refresh": "SELECT 'DimDate' AS TableName, count(*) + 1 AS \"Rows\" FROM calendar UNION ALL "
    + " UNION ALL ".join(f"SELECT '{n}', count(*) + {1 if n in _DIM else 0} FROM {b}" for n, b in _BLOCK.items()),
    "run_02_keys_restart": " UNION ALL ".join(
        f"SELECT '{n}' AS Dimension, CAST(0 AS BIGINT) AS MinKey, max({RELOAD_CODES[n][0]}) AS MaxKey, count(*) + 1 AS Keys FROM {b}" for n, b in _DIM.items()
    ),
}


def _both(**expressions: str) -> dict[str, str]:
    return {f"{side}{n}": e for n, e in expressions.items() for side in ("Expected", "Actual")}


def _q(expression: str, block: str, where: str = "") -> str:
    return f"(SELECT {expression} FROM {block}{' WHERE ' + where if where else ''})"


def _n(block: str, where: str = "") -> str:
    return _q("count(*)", block, where)


def _dup(block: str, *key: str) -> str:
    return f"(SELECT count(*) FROM (SELECT 1 FROM {block} GROUP BY {', '.join(key)} HAVING count(*) > 1))"


def _bad(block: str, column: str, dim: str, key: str) -> str:
    return f"(SELECT count(*) FROM {block} f LEFT JOIN {dim} d ON d.{key} = f.{column} WHERE d.{key} IS NULL)"


def _bad_dates(block: str, roles, unknown: bool) -> str:
    days = f"SELECT {day_key('d')} FROM calendar{' UNION ALL SELECT 0' if unknown else ''}"
    return _n(block, " OR ".join(f"{r} NOT IN ({days})" for r in roles))


_SAME = {"SourceToTargetDifferences": "0", "TargetToSourceDifferences": "0"}


def _dimension(block: str) -> dict[str, str]:
    return {"ActualTotalRows": f"({_n(block)} + 1)", "ActualBusinessRows": _n(block), "UnknownRows": "1", "ValidUnknownRows": "1", "ExpectedBusinessRows": _n(block), **_SAME}


def _keys(block: str) -> dict[str, str]:
    return {
        "InvalidCustomerKeys": _bad(block, "CustomerKey", "dim_customer", "CustomerKey"),
        "InvalidGeographyKeys": _bad(block, "CustomerGeographyKey", "dim_geography", "GeographyKey"),
        "MissingExpectedCustomerKeys": "0",
        "MissingExpectedGeographyKeys": "0",
    }


def _fact(block: str, source: str, counter: str, counter_metric: str, key: tuple[str, ...]) -> dict[str, str]:
    return {
        "SourceRows": _n(source), "ExpectedRows": _n(block), "ActualRows": _n(block), **_SAME, **_keys(block),
        counter_metric: _n(block, f"{counter} <> 1"), "DuplicateNaturalGrain": _dup(block, *key), "NullOrderIDs": _n(block, "OrderID IS NULL"),
        "MissingFactOrderMatches": _n(block, "OrderID NOT IN (SELECT OrderID FROM fact_order)"),
    }


# The rule conditions are the same SQL text on both sides; the metrics are derived here a second time.
METRICS = {
    "DimGeography": {
        **_dimension("dim_geography"),
        "DistinctBusinessZIPs": _q("count(DISTINCT ZipCodePrefix)", "dim_geography"),
        "DuplicateBusinessZIPGroups": _dup("dim_geography", "ZipCodePrefix"),
        "MissingConformedZIPs": _n("conf_geography", "ZipCodePrefix NOT IN (SELECT ZipCodePrefix FROM dim_geography)"),
    },
    "DimCustomer": {
        **_dimension("dim_customer"),
        "ConformedBusinessRows": _n("conf_customer"),
        "ExpectedResolvedRows": _n("dim_customer", "RepresentativeGeographyKey IS NOT NULL"),
        "DistinctBusinessCustomers": _q("count(DISTINCT CustomerUniqueID)", "dim_customer"),
        "DuplicateBusinessKeyGroups": _dup("dim_customer", "CustomerUniqueID"),
        "InvalidBusinessGeographyKeys": _bad("dim_customer", "RepresentativeGeographyKey", "dim_geography", "GeographyKey"),
    },
    "DimSeller": {
        "SourceSellerCount": _n("stg_sellers"), "TargetBusinessCount": _n("dim_seller"), "TargetTotalRows": f"({_n('dim_seller')} + 1)", "ValidUnknownRows": "1",
        "DistinctBusinessSellerIDs": _q("count(DISTINCT SellerID)", "dim_seller"), "DuplicateSellerIDs": _dup("dim_seller", "SellerID"),
        "NullBusinessSellerIDs": _n("dim_seller", "SellerID IS NULL"), "MissingGeographyKeys": _n("dim_seller", "GeographyKey IS NULL"),
        "InvalidGeographyKeys": _bad("dim_seller", "GeographyKey", "dim_geography", "GeographyKey"), **_SAME,
    },
    "DimProductCategory": {
        **_dimension("dim_category"),
        "DuplicateSourceCategories": _dup("dim_category", "SourceCategoryName"),
        "NullBusinessCategories": _n("dim_category", "SourceCategoryName IS NULL"),
        "InvalidEnglishFlags": _n("dim_category", "(EnglishCategoryName IS NULL) <> (MissingEnglishTranslationFlag = 1)"),
        "InvalidPersianFlags": _n("dim_category", "(trim(coalesce(PersianCategoryName, '')) = '') <> (MissingPersianLocalizationFlag = 1)"),
        "MissingPersianNames": _n("dim_category", "trim(coalesce(PersianCategoryName, '')) = ''"),
    },
    "DimProduct": {
        **_dimension("dim_product"),
        "DistinctBusinessProductIDs": _q("count(DISTINCT ProductID)", "dim_product"), "DuplicateProductIDs": _dup("dim_product", "ProductID"),
        "NullBusinessProductIDs": _n("dim_product", "ProductID IS NULL"), "UnresolvedCategories": _n("dim_product", "ProductCategoryKey IS NULL"),
        "InvalidCategoryKeys": _n("dim_product", "ProductCategoryKey <> 0 AND ProductCategoryKey NOT IN (SELECT ProductCategoryKey FROM dim_category)"),
    },
    "FactOrder": {
        "SourceOrderRows": _n("stg_orders"), "ExpectedRows": _n("fact_order"), "ActualRows": _n("fact_order"), **_SAME, **_keys("fact_order"),
        "DistinctOrderIDs": _q("count(DISTINCT OrderID)", "fact_order"), "DuplicateOrderIDs": _dup("fact_order", "OrderID"), "NullOrderIDs": _n("fact_order", "OrderID IS NULL"),
        "InvalidDateKeys": _bad_dates("fact_order", validators.ORDER_DATE_ROLES, True), "InvalidOrderCounts": _n("fact_order", "OrderCount <> 1"),
    },
    "FactOrderItem": {
        **_fact("fact_item", "stg_items", "OrderItemCount", "InvalidOrderItemCounts", ("OrderID", "OrderItemID")),
        "InvalidOrderItemIDs": _n("fact_item", "OrderItemID IS NULL OR OrderItemID < 1"), "MissingExpectedProductKeys": "0", "MissingExpectedSellerKeys": "0",
        "InvalidProductKeys": _bad("fact_item", "ProductKey", "dim_product", "ProductKey"), "InvalidSellerKeys": _bad("fact_item", "SellerKey", "dim_seller", "SellerKey"),
        "InvalidDateKeys": _bad_dates("fact_item", ("PurchaseDateKey", "ShippingLimitDateKey"), False),
        **_both(ZeroPriceRows=_n("fact_item", "PriceAmount = 0")),
    },
    "FactPayment": {
        **_fact("fact_payment", "stg_payments", "PaymentCount", "InvalidPaymentCounts", ("OrderID", "PaymentSequential")),
        "InvalidPaymentSequential": _n("fact_payment", "PaymentSequential IS NULL OR PaymentSequential < 1"),
        "InvalidDateKeys": _bad_dates("fact_payment", ("PurchaseDateKey",), False),
    },
    "FactReview": {
        **_fact("fact_review", "stg_reviews", "ReviewCount", "InvalidReviewCounts", ("ReviewID", "OrderID")),
        "NullReviewIDs": _n("fact_review", "ReviewID IS NULL"), "InvalidReviewScores": _n("fact_review", "ReviewScore IS NULL OR ReviewScore NOT BETWEEN 1 AND 5"),
        "MissingExpectedDateKeys": _bad_dates("fact_review", validators.REVIEW_DATE_ROLES, False), "InvalidDateKeys": _bad_dates("fact_review", validators.REVIEW_DATE_ROLES, False),
        "InvalidDeliveryFlagNullSemantics": "(SELECT count(*) FROM fact_review r JOIN fact_order o ON o.OrderID = r.OrderID WHERE (o.DeliveredCustomerTimestamp IS NULL) <> (r.ReviewCreatedBeforeDeliveryFlag IS NULL))",
    },
    "ConformedProductCategory": {
        "ExpectedRows": _q("count(DISTINCT product_category_name)", "stg_products"), "ActualRows": _n("conf_category"), **_SAME,
        "DuplicateSourceCategories": _dup("conf_category", "SourceCategoryName"), "NullSourceCategories": _n("conf_category", "SourceCategoryName IS NULL"),
        "InvalidMissingFlags": _n("conf_category", "(EnglishCategoryName IS NULL) <> (MissingEnglishTranslationFlag = 1)"),
    },
    "ProductCategoryLocalization": {
        "LocalizationRows": _n("stg_localization"), "CategoryRows": _n("conf_category"), "MissingPersianNames": _n("stg_localization", "trim(coalesce(PersianCategoryName, '')) = ''"),
        "MissingLocalizationRows": _n("conf_category", "SourceCategoryName NOT IN (SELECT SourceCategoryName FROM stg_localization)"),
        "OrphanLocalizationRows": _n("stg_localization", "SourceCategoryName NOT IN (SELECT SourceCategoryName FROM conf_category)"),
    },
    "Preflight": {
        "UnknownDates": "1", "MissingSourceDates": _n("source_days", "d NOT IN (SELECT d FROM calendar)"),
        "EmptyInputs": "(" + " + ".join(
            f"CAST(NOT EXISTS (SELECT 1 FROM {b}) AS INTEGER)"
            for b in ("conf_geography", "conf_customer", "conf_category", "stg_localization", "stg_orders", "stg_items", "stg_products", "stg_customers", "stg_sellers", "stg_payments", "stg_reviews")
        ) + ")",
    },
    "DimensionGate": {
        **{f"{n}Unknown": "1" for n in _DIM}, **{f"{n}Rows": _n(b) for n, b in _DIM.items()},
        **dict(zip([f"{n}SourceRows" for n in _DIM], map(_n, ("conf_geography", "conf_customer", "stg_sellers", "conf_category", "stg_products")))),
        "CustomerGeography": _bad("dim_customer", "RepresentativeGeographyKey", "dim_geography", "GeographyKey"),
        "SellerGeography": _bad("dim_seller", "GeographyKey", "dim_geography", "GeographyKey"),
        "ProductCategories": _n("dim_product", "ProductCategoryKey <> 0 AND ProductCategoryKey NOT IN (SELECT ProductCategoryKey FROM dim_category)"),
    },
    "FactGate": {
        **{f"{n}Rows": _n(b) for n, b in _FACT.items()},
        **dict(zip([f"{n}SourceRows" for n in _FACT], map(_n, ("stg_orders", "stg_items", "stg_payments", "stg_reviews")))),
        **{f"{n}Uncovered": _n(b, "OrderID NOT IN (SELECT OrderID FROM fact_order)") for n, b in _FACT.items() if n != "FactOrder"},
        **{f"{n}Counters": _n(_FACT[n], f"{c} <> 1") for n, c in gates.FACT_COUNTERS.items()},
    },
}


def _rules_sql(scope: str, rules, changed=None) -> str:
    metrics = {**METRICS[scope], **(changed or {})}
    wide = "SELECT " + ", ".join(f"{e} AS {n}" for n, e in metrics.items())
    lines = []
    for r in rules:
        outcome = "NULL" if "baseline_" in r.violated_when else f"({r.violated_when})"
        message = r.message.replace("'", "''")
        lines.append(f"{{'code': {r.code}, 'message': '{message}', 'violated': CAST({outcome} AS BIGINT)}}")
    return f"SELECT '{scope}' AS scope, CAST(x.code AS BIGINT) AS code, x.message AS message, x.violated AS violated FROM (SELECT unnest([{', '.join(lines)}]) AS x FROM ({wide}))"


ORACLE.update({f"rule_{re.sub('(?<!^)(?=[A-Z])', '_', n).lower()}": _rules_sql(n, rules_of(n)) for n in RULES_BY_SCOPE})
ORACLE.update(
    {
        "rec_02_tampered": """SELECT count(*) AS ExpectedRows, count(CASE WHEN PaymentSequential <> 4 THEN 1 END) AS ActualRows,
            count(CASE WHEN PaymentSequential IN (2, 3, 4) THEN 1 END) AS SourceToTargetDifferences,
            count(CASE WHEN PaymentSequential IN (2, 3) THEN 1 END) AS TargetToSourceDifferences FROM fact_payment""",
        "rule_fact_payment_tampered": _rules_sql(
            "FactPayment",
            rules_of("FactPayment"),
            {
                "SourceToTargetDifferences": _n("fact_payment", "PaymentSequential IN (2, 3)"),
                "TargetToSourceDifferences": _n("fact_payment", "PaymentSequential IN (2, 3)"),
                "InvalidPaymentCounts": _n("fact_payment", "PaymentSequential = 3"),
            },
        ),
        "gate_03_tampered": _rules_sql(
            "FactGate", gates.FACT_RULES, {"FactReviewRows": _n("fact_review", "ReviewScore <> 5"), "FactPaymentCounters": _n("fact_payment", "PaymentSequential = 3")}
        ),
        "gate_01_missing_tables": " UNION ALL ".join(
            f"SELECT '{t}' AS TableName, 'Preflight' AS Scope, CAST({c} AS BIGINT) AS Code WHERE EXISTS (SELECT 1 FROM stg_orders)" for t, c in gates.REQUIRED_TABLES.items()
        ),
        "run_01_stopped_refresh": "SELECT 'DimProductCategory' AS Scope, CAST(51186 AS BIGINT) AS Code WHERE EXISTS (SELECT 1 FROM stg_localization WHERE trim(PersianCategoryName) = '')",
        "run_01_validated_refresh": " UNION ALL ".join(
            f"SELECT '{n}' AS Name, count(*) + {1 if n in _DIM else 0} AS \"Rows\", CAST(1 AS BIGINT) AS Validated FROM {b}" for n, b in _BLOCK.items()
        ),
        "gate_01_preflight": _rules_sql("Preflight", gates.PREFLIGHT_RULES),
        "gate_02_dimensions": _rules_sql("DimensionGate", gates.DIMENSION_RULES),
        "gate_03_facts": _rules_sql("FactGate", gates.FACT_RULES),
        "gate_04_warehouse": "SELECT scope, count(*) AS Rules, count(CASE WHEN violated = 1 THEN 1 END) AS Violated, count(CASE WHEN violated IS NULL THEN 1 END) AS WithoutBaseline FROM ("
        + " UNION ALL ".join(_rules_sql(n, rules_of(n)) for n in validators.WAREHOUSE_VALIDATORS)
        + ") GROUP BY scope",
        "rec_11_order_profile": "SELECT " + ", ".join(
            f"{e} AS {n}"
            for n, e in _both(
                CarrierBeforePurchase="CAST(sum(CarrierBeforePurchaseFlag) AS BIGINT)",
                CarrierBeforeApproval="CAST(sum(CarrierBeforeApprovalFlag) AS BIGINT)",
                DeliveredBeforeCarrier="CAST(sum(DeliveredBeforeCarrierFlag) AS BIGINT)",
                DeliveredLate="count(CASE WHEN DeliveredLateFlag = 1 THEN 1 END)",
                UndeliveredLateStatus="count(CASE WHEN DeliveredLateFlag IS NULL THEN 1 END)",
            ).items()
        ) + " FROM fact_order",
        "rec_11_fact_profiles": " UNION ALL ".join(
            f"SELECT '{scope}' AS scope, '{side}{n}' AS metric, CAST(coalesce({sql}, 0) AS DOUBLE) AS value FROM {block}"
            for scope, (block, numbers) in PROFILES.items()
            for n, sql in numbers.items()
            for side in ("Expected", "Actual")
        ),
    }
)
