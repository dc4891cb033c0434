"""Geography, customer and category conformance."""

from __future__ import annotations

from stallkeep.functions import city_key
from stallkeep.operators.quality import distribution
from stallkeep.plans import category, customer, geography
from stallkeep.queries.built import staging, warehouse
from stallkeep.queries.oracle import moment
from stallkeep.queries.shape import micro


def _observed(s, d):
    t = staging(s, d)
    return geography.geolocation_observations(t["geolocation"]), geography.reference_observations(t["customers"], t["sellers"])


def _counted(s, d):
    observations, references = _observed(s, d)
    return geography.label_counts(observations), geography.label_counts(references)


def _states(s, d):
    return geography.state_resolution(geography.state_candidates(*_counted(s, d)))


def _spellings(s, d):
    return geography.city_spellings(_counted(s, d)[0], _states(s, d))


def _supported(s, d):
    return geography.supported_cities(geography.city_candidates(_spellings(s, d)), _counted(s, d)[1])


def _coordinates(s, d):
    return geography.representative_coordinates(_observed(s, d)[0], _states(s, d))


def _conformed(s, d):
    t = staging(s, d)
    return geography.conformed_geography(t["geolocation"], t["customers"], t["sellers"])


def _with_micro(df):
    return df.withColumns({"lat_micro": micro("RepresentativeLatitude"), "lng_micro": micro("RepresentativeLongitude")}).drop(
        "RepresentativeLatitude", "RepresentativeLongitude"
    )


def _city_resolution(spark, sf):
    resolved = geography.city_resolution(_supported(spark, sf))
    return resolved.join(geography.city_labels(_spellings(spark, sf)), ["ZipCodePrefix", "CityMatchKey"], "left")


def _customer(spark, sf):
    t = staging(spark, sf)
    return customer.conformed_customer(t["customers"], t["orders"])


def _purchases(spark, sf):
    t = staging(spark, sf)
    return customer.customer_orders(t["customers"], t["orders"])


def _activity(s, d):
    return customer.customer_activity(_purchases(s, d))


def _latest_rows(s, d):
    latest = customer.latest_purchases(_activity(s, d))
    return latest.select("customer_unique_id", "LatestTimestamp", "LatestTimestampRows")


def _category(spark, sf):
    t = staging(spark, sf)
    return category.conformed_category(t["products"], t["category_translation"])


QUERIES = {
    "geo_01_city_key": lambda s, d: distribution(
        staging(s, d)["geolocation"].withColumn("CityMatchKey", city_key("geolocation_city")), ["geolocation_city", "CityMatchKey"]
    ),
    "geo_02_reference_observations": lambda s, d: _observed(s, d)[1],
    "geo_03_state_support": lambda s, d: geography.state_support(_counted(s, d)[1]),
    "geo_04_city_support": lambda s, d: geography.city_support(_counted(s, d)[1]),
    "geo_05_zip_universe": lambda s, d: geography.zip_universe(*_counted(s, d)),
    "geo_06_source_statistics": lambda s, d: geography.source_statistics(_counted(s, d)[0]),
    "geo_07_state_candidates": lambda s, d: geography.state_candidates(*_counted(s, d)),
    "geo_08_ranked_states": lambda s, d: geography.ranked_states(geography.state_candidates(*_counted(s, d))),
    "geo_09_state_resolution": _states,
    "geo_10_city_candidates": lambda s, d: geography.city_candidates(_spellings(s, d)),
    "geo_11_supported_cities": _supported,
    "geo_12_city_key_resolution": lambda s, d: geography.city_resolution(_supported(s, d)),
    "geo_13_city_label": _city_resolution,
    "geo_14_reference_fallback": lambda s, d: geography.reference_fallback(_counted(s, d)[1]),
    "geo_15_median_coordinates": lambda s, d: _with_micro(_coordinates(s, d)),
    "geo_16_conformed_geography": lambda s, d: _with_micro(_conformed(s, d)),
    "geo_17_profile": lambda s, d: geography.geography_profile(_conformed(s, d)),
    "geo_18_required_zip_coverage": lambda s, d: geography.required_zip_coverage(
        warehouse(s, d)["Geography"], staging(s, d)["customers"], staging(s, d)["sellers"]
    ),
    "geo_19_unresolved": lambda s, d: geography.unresolved_geography(warehouse(s, d)["Geography"]),
    "cst_01_customer_orders": _purchases,
    "cst_02_identity_summary": lambda s, d: customer.identity_summary(_activity(s, d)),
    "cst_03_latest_timestamp_rows": _latest_rows,
    "cst_04_latest_record": lambda s, d: customer.latest_purchases(_activity(s, d)).select(
        "customer_unique_id", "RepresentativeCustomerID", "RepresentativeOrderID", "ZipCodePrefix", "CityName", "StateCode"
    ),
    "cst_05_conformed_customer": _customer,
    "cst_06_profile": lambda s, d: customer.customer_profile(_customer(s, d)),
    "cst_06_geography_coverage": lambda s, d: customer.customer_geography_coverage(_customer(s, d), warehouse(s, d)["Geography"]),
    "cst_06_representative_checks": lambda s, d: customer.representative_checks(
        warehouse(s, d)["Customer"], staging(s, d)["customers"], staging(s, d)["orders"]
    ),
    "cst_06_tie_geography_conflicts": lambda s, d: customer.tie_geography_conflicts(staging(s, d)["customers"], staging(s, d)["orders"]),
    "cat_01_conformed_category": _category,
    "cat_02_profile": lambda s, d: category.category_profile(_category(s, d)),
    "cat_02_missing_translations": lambda s, d: category.missing_translations(_category(s, d)),
    "cat_03_localized_categories": lambda s, d: category.localized_categories(_category(s, d), staging(s, d)["localization"]),
    "cat_03_localization_profile": lambda s, d: category.localization_profile(_category(s, d), staging(s, d)["localization"]),
}

_FLAGS = (
    "GeolocationSourceRowCount, GeolocationDistinctStateCount, GeolocationDistinctCityLabelCount, MissingFromGeolocationFlag, "
    "StateConflictFlag, StateAmbiguousFlag, StateResolvedByReferenceFlag, CityAmbiguousFlag, CityResolvedByReferenceFlag, ReferenceFallbackFlag"
)
_MICRO = "CAST(round(lat * 1000000) AS BIGINT) AS lat_micro, CAST(round(lng * 1000000) AS BIGINT) AS lng_micro"


def _sum(name: str, condition: str) -> str:
    return f"CAST(count(CASE WHEN {condition} THEN 1 END) AS BIGINT) AS {name}"


_CUSTOMER = (
    f"CustomerUniqueID, RepresentativeCustomerID, ZipCodePrefix, CityName, StateCode, {moment('first_ts')} AS FirstPurchaseTimestamp, "
    f"{moment('last_ts')} AS LatestPurchaseTimestamp, OrderCount, CustomerIDCount, DistinctZIPCount, DistinctCityCount, DistinctStateCount, LatestTimestampTieFlag"
)

ORACLE = {
    "geo_01_city_key": "SELECT city AS geolocation_city, city_key AS CityMatchKey, count(*) AS \"Rows\" FROM geo_obs GROUP BY 1, 2",
    "geo_02_reference_observations": "SELECT zip AS ZipCodePrefix, state AS StateCode, city AS CityName, city_key AS CityMatchKey FROM geo_ref",
    "geo_03_state_support": "SELECT zip AS ZipCodePrefix, state AS StateCode, support AS SupportRows FROM geo_state_support",
    "geo_04_city_support": "SELECT zip AS ZipCodePrefix, state AS StateCode, city_key AS CityMatchKey, support AS SupportRows FROM geo_city_support",
    "geo_05_zip_universe": "SELECT zip AS ZipCodePrefix FROM geo_universe",
    "geo_06_source_statistics": "SELECT zip AS ZipCodePrefix, n AS SourceRowCount, states AS DistinctStateCount, cities AS DistinctCityLabelCount FROM geo_stats",
    "geo_07_state_candidates": "SELECT zip AS ZipCodePrefix, val AS StateCode, votes AS GeoRows, support AS ReferenceSupportRows FROM geo_state_cand",
    "geo_08_ranked_states": "SELECT zip AS ZipCodePrefix, val AS StateCode, votes AS GeoRows, support AS ReferenceSupportRows, rr AS ResolutionRank, vr AS VoteOnlyRank FROM geo_state_ranked",
    "geo_09_state_resolution": "SELECT zip AS ZipCodePrefix, winner AS RepresentativeState, candidates AS StateCandidateCount, conflict AS StateConflictFlag, ambiguous AS StateAmbiguousFlag, resolved AS StateResolvedByReferenceFlag FROM geo_state",
    "geo_10_city_candidates": "SELECT zip AS ZipCodePrefix, state AS StateCode, val AS CityMatchKey, votes AS GeoRows FROM geo_city_cand",
    "geo_11_supported_cities": "SELECT c.zip AS ZipCodePrefix, c.state AS StateCode, c.val AS CityMatchKey, c.votes AS GeoRows, s.support AS ReferenceSupportRows FROM geo_city_cand c JOIN geo_city_sup s ON s.zip = c.zip AND s.val = c.val",
    "geo_12_city_key_resolution": "SELECT zip AS ZipCodePrefix, winner AS CityMatchKey, ambiguous AS CityAmbiguousFlag, resolved AS CityResolvedByReferenceFlag FROM geo_city",
    "geo_13_city_label": "SELECT c.zip AS ZipCodePrefix, c.winner AS CityMatchKey, c.ambiguous AS CityAmbiguousFlag, c.resolved AS CityResolvedByReferenceFlag, l.city AS CityName FROM geo_city c LEFT JOIN geo_label l ON l.zip = c.zip AND l.city_key = c.winner",
    "geo_14_reference_fallback": "SELECT zip AS ZipCodePrefix, state AS FallbackState, city AS FallbackCity, states AS ReferenceStateCount, cities AS ReferenceCityCount FROM geo_fallback",
    "geo_15_median_coordinates": f"SELECT zip AS ZipCodePrefix, {_MICRO} FROM geo_coord",
    "geo_16_conformed_geography": f"SELECT ZipCodePrefix, CityName, StateCode, {_FLAGS}, {_MICRO} FROM conf_geography",
    "geo_17_profile": f"""SELECT count(*) AS "RowCount", {_sum('MissingFromGeolocation', 'MissingFromGeolocationFlag = 1')},
        {_sum('StateConflicts', 'StateConflictFlag = 1')}, {_sum('StateAmbiguous', 'StateAmbiguousFlag = 1')},
        {_sum('StatesResolvedByReference', 'StateResolvedByReferenceFlag = 1')}, {_sum('CityAmbiguous', 'CityAmbiguousFlag = 1')},
        {_sum('CitiesResolvedByReference', 'CityResolvedByReferenceFlag = 1')}, {_sum('ReferenceFallbackZIPs', 'ReferenceFallbackFlag = 1')},
        {_sum('NullStates', 'StateCode IS NULL')}, {_sum('NullCities', 'CityName IS NULL')}, {_sum('ZIPsWithoutCoordinates', 'lat IS NULL OR lng IS NULL')}
        FROM conf_geography""",
    "geo_18_required_zip_coverage": "SELECT count(*) AS RequiredZIPsMissing FROM (SELECT DISTINCT zip FROM geo_ref) r LEFT JOIN conf_geography g ON g.ZipCodePrefix = r.zip WHERE g.ZipCodePrefix IS NULL",
    "geo_19_unresolved": "SELECT ZipCodePrefix, CityName, StateCode, StateConflictFlag, StateAmbiguousFlag, CityAmbiguousFlag, CityResolvedByReferenceFlag, MissingFromGeolocationFlag, ReferenceFallbackFlag FROM conf_geography WHERE StateAmbiguousFlag = 1 OR CityAmbiguousFlag = 1",
    "cst_01_customer_orders": f"SELECT customer_id, order_id, {moment('ts')} AS order_purchase_timestamp, uid AS customer_unique_id, zip AS customer_zip_code_prefix, city AS customer_city, state AS customer_state FROM cust_orders",
    "cst_02_identity_summary": f"SELECT CustomerUniqueID AS customer_unique_id, {moment('first_ts')} AS FirstPurchaseTimestamp, {moment('last_ts')} AS LatestPurchaseTimestamp, OrderCount, CustomerIDCount, DistinctZIPCount, DistinctCityCount, DistinctStateCount FROM conf_customer",
    "cst_03_latest_timestamp_rows": f"SELECT uid AS customer_unique_id, {moment('max(ts)')} AS LatestTimestamp, count(*) AS LatestTimestampRows FROM (SELECT *, max(ts) OVER (PARTITION BY uid) AS last FROM cust_orders) WHERE ts = last GROUP BY uid",
    "cst_04_latest_record": "SELECT uid AS customer_unique_id, customer_id AS RepresentativeCustomerID, order_id AS RepresentativeOrderID, zip AS ZipCodePrefix, city AS CityName, state AS StateCode FROM (SELECT *, row_number() OVER (PARTITION BY uid ORDER BY ts DESC, order_id DESC, customer_id DESC) AS rn FROM cust_orders) WHERE rn = 1",
    "cst_05_conformed_customer": f"SELECT {_CUSTOMER} FROM conf_customer",
    "cst_06_profile": f"""SELECT count(*) AS "RowCount", count(DISTINCT CustomerUniqueID) AS DistinctCustomers, {_sum('ReturningCustomers', 'CustomerIDCount > 1')},
        {_sum('CustomersWithMultipleZIPs', 'DistinctZIPCount > 1')}, {_sum('CustomersWithMultipleStates', 'DistinctStateCount > 1')},
        {_sum('CustomersWithMultipleCities', 'DistinctCityCount > 1')}, {_sum('LatestTimestampTies', 'LatestTimestampTieFlag = 1')},
        {_sum('InvalidPurchaseDateRanges', 'first_ts > last_ts')},
        {_sum('InvalidCustomerCounts', 'OrderCount <= 0 OR CustomerIDCount <= 0 OR DistinctZIPCount <= 0 OR DistinctCityCount <= 0 OR DistinctStateCount <= 0')},
        {_sum('NullCustomerUniqueID', 'CustomerUniqueID IS NULL')}, {_sum('NullRepresentativeCustomerID', 'RepresentativeCustomerID IS NULL')},
        {_sum('NullZipCodePrefix', 'ZipCodePrefix IS NULL')}, {_sum('NullCityName', 'CityName IS NULL')}, {_sum('NullStateCode', 'StateCode IS NULL')},
        {_sum('NullFirstPurchaseTimestamp', 'first_ts IS NULL')}, {_sum('NullLatestPurchaseTimestamp', 'last_ts IS NULL')} FROM conf_customer""",
    "cst_06_geography_coverage": "SELECT count(*) AS CustomerZIPsMissing FROM conf_customer c LEFT JOIN conf_geography g ON g.ZipCodePrefix = c.ZipCodePrefix WHERE g.ZipCodePrefix IS NULL",
    "cst_06_representative_checks": """SELECT 'InvalidRepresentativeCustomerIDs' AS "Check", count(*) AS "Rows" FROM conf_customer c LEFT JOIN stg_customers s ON s.customer_id = c.RepresentativeCustomerID WHERE s.customer_id IS NULL OR s.customer_unique_id <> c.CustomerUniqueID
        UNION ALL SELECT 'RepresentativeGeographyMismatches', count(*) FROM conf_customer c JOIN stg_customers s ON s.customer_id = c.RepresentativeCustomerID WHERE c.ZipCodePrefix <> s.customer_zip_code_prefix OR c.CityName <> s.customer_city OR c.StateCode <> s.customer_state
        UNION ALL SELECT 'RepresentativeCustomersNotLatest', count(*) FROM conf_customer c JOIN stg_orders o ON o.customer_id = c.RepresentativeCustomerID WHERE o.order_purchase_timestamp <> c.last_ts""",
    "cst_06_tie_geography_conflicts": "SELECT count(*) AS LatestTieGeographyConflicts FROM (SELECT uid FROM (SELECT *, max(ts) OVER (PARTITION BY uid) AS last FROM cust_orders) WHERE ts = last GROUP BY uid HAVING count(*) > 1 AND (count(DISTINCT zip) > 1 OR count(DISTINCT city) > 1 OR count(DISTINCT state) > 1))",
    "cat_01_conformed_category": "SELECT * FROM conf_category",
    "cat_02_profile": f'SELECT count(*) AS "RowCount", {_sum("MissingEnglishTranslations", "MissingEnglishTranslationFlag = 1")} FROM conf_category',
    "cat_02_missing_translations": "SELECT * FROM conf_category WHERE MissingEnglishTranslationFlag = 1",
    "cat_03_localized_categories": "SELECT SourceCategoryName, EnglishCategoryName, MissingEnglishTranslationFlag, PersianCategoryName, MissingPersianLocalizationFlag FROM dim_category",
    "cat_03_localization_profile": """SELECT 'CategoryRows' AS Metric, count(*) AS "Value" FROM conf_category
        UNION ALL SELECT 'LocalizationRows', count(*) FROM stg_localization
        UNION ALL SELECT 'MissingPersianNames', count(*) FROM stg_localization WHERE PersianCategoryName IS NULL OR trim(PersianCategoryName) = ''
        UNION ALL SELECT 'MissingLocalizationRows', count(*) FROM conf_category c LEFT JOIN stg_localization l ON l.SourceCategoryName = c.SourceCategoryName WHERE l.SourceCategoryName IS NULL
        UNION ALL SELECT 'OrphanLocalizationRows', count(*) FROM stg_localization l LEFT JOIN conf_category c ON l.SourceCategoryName = c.SourceCategoryName WHERE c.SourceCategoryName IS NULL
        UNION ALL SELECT 'DuplicateLocalizationGroups', count(*) FROM (SELECT SourceCategoryName FROM stg_localization GROUP BY 1 HAVING count(*) > 1)""",
}
