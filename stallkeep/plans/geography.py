"""One geography row per ZIP code, resolved by vote, with provenance flags."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stallkeep.functions import city_key, flag, matches
from stallkeep.operators.joins import spread_join
from stallkeep.operators.median import grouped_median
from stallkeep.operators.quality import audit
from stallkeep.operators.vote import most_frequent_label, rank_candidates, resolve_by_vote
from stallkeep.session import scratch_root

ZIP, STATE = "ZipCodePrefix", "StateCode"
COORDINATE = "decimal(28,20)"


def geolocation_observations(geolocation: DataFrame) -> DataFrame:
    """The geolocation rows under working names, with the city comparison key."""
    return geolocation.select(
        F.col("geolocation_zip_code_prefix").alias(ZIP),
        F.col("geolocation_state").alias(STATE),
        F.col("geolocation_city").alias("CityName"),
        city_key("geolocation_city").alias("CityMatchKey"),
        F.col("geolocation_lat").alias("Latitude"),
        F.col("geolocation_lng").alias("Longitude"),
    )


def reference_observations(customers: DataFrame, sellers: DataFrame) -> DataFrame:
    """What customers and sellers say about their ZIP codes."""

    def side(df: DataFrame, prefix: str) -> DataFrame:
        return df.select(
            F.col(f"{prefix}_zip_code_prefix").alias(ZIP),
            F.col(f"{prefix}_state").alias(STATE),
            F.col(f"{prefix}_city").alias("CityName"),
        )

    both = side(customers, "customer").unionByName(side(sellers, "seller"))
    return both.withColumn("CityMatchKey", city_key("CityName"))


def label_counts(observations: DataFrame) -> DataFrame:
    """Rows per (ZIP, state, city spelling): the one pass over the observations that all votes share."""
    return observations.groupBy(ZIP, STATE, "CityMatchKey", "CityName").agg(F.count("*").alias("SourceRows"))


def state_support(references: DataFrame) -> DataFrame:
    """``references`` counted by ``label_counts``; so in all functions below."""
    return references.groupBy(ZIP, STATE).agg(F.sum("SourceRows").alias("SupportRows"))


def city_support(references: DataFrame) -> DataFrame:
    return references.groupBy(ZIP, STATE, "CityMatchKey").agg(F.sum("SourceRows").alias("SupportRows"))


def zip_universe(counts: DataFrame, references: DataFrame) -> DataFrame:
    return counts.select(ZIP).union(references.select(ZIP)).distinct()


def source_statistics(counts: DataFrame) -> DataFrame:
    """Rows, states and city spellings per ZIP."""
    return counts.groupBy(ZIP).agg(
        F.sum("SourceRows").alias("SourceRowCount"),
        F.count_distinct(STATE).alias("DistinctStateCount"),
        F.count_distinct("CityName").alias("DistinctCityLabelCount"),
    )


def _with_support(candidates: DataFrame, support: DataFrame, on: list[str]) -> DataFrame:
    return candidates.join(support, on, "left").select(
        *candidates.columns, F.coalesce("SupportRows", F.lit(0)).alias("ReferenceSupportRows")
    )


def state_candidates(counts: DataFrame, references: DataFrame) -> DataFrame:
    per_state = counts.groupBy(ZIP, STATE).agg(F.sum("SourceRows").alias("GeoRows"))
    return _with_support(per_state, state_support(references), [ZIP, STATE])


def ranked_states(candidates: DataFrame) -> DataFrame:
    return rank_candidates(candidates, [ZIP], "GeoRows", "ReferenceSupportRows")


def state_resolution(candidates: DataFrame) -> DataFrame:
    voted = resolve_by_vote(candidates, [ZIP], STATE, "GeoRows", "ReferenceSupportRows")
    return voted.select(
        ZIP,
        F.col("Winner").alias("RepresentativeState"),
        F.col("CandidateCount").alias("StateCandidateCount"),
        F.col("ConflictFlag").alias("StateConflictFlag"),
        F.col("AmbiguousFlag").alias("StateAmbiguousFlag"),
        F.col("ResolvedBySupportFlag").alias("StateResolvedByReferenceFlag"),
    )


def city_spellings(counts: DataFrame, states: DataFrame) -> DataFrame:
    """Spellings within the resolved state and how often each occurs."""
    resolved = states.select(ZIP, F.col("RepresentativeState").alias(STATE))
    return counts.join(resolved, [ZIP, STATE])


def city_candidates(spellings: DataFrame) -> DataFrame:
    return spellings.groupBy(ZIP, STATE, "CityMatchKey").agg(F.sum("SourceRows").alias("GeoRows"))


def supported_cities(candidates: DataFrame, references: DataFrame) -> DataFrame:
    return _with_support(candidates, city_support(references), [ZIP, STATE, "CityMatchKey"])


def city_resolution(candidates: DataFrame) -> DataFrame:
    voted = resolve_by_vote(candidates, [ZIP], "CityMatchKey", "GeoRows", "ReferenceSupportRows")
    return voted.select(
        ZIP,
        F.col("Winner").alias("CityMatchKey"),
        F.col("AmbiguousFlag").alias("CityAmbiguousFlag"),
        F.col("ResolvedBySupportFlag").alias("CityResolvedByReferenceFlag"),
    )


def city_labels(spellings: DataFrame) -> DataFrame:
    return most_frequent_label(spellings, [ZIP, "CityMatchKey"], "CityName", "SourceRows")


def reference_fallback(references: DataFrame) -> DataFrame:
    """First state and city per ZIP by the references alone, with how many there were."""
    return references.groupBy(ZIP).agg(
        F.min(STATE).alias("FallbackState"),
        F.min("CityName").alias("FallbackCity"),
        F.count_distinct(STATE).alias("ReferenceStateCount"),
        F.count_distinct("CityName").alias("ReferenceCityCount"),
    )


def representative_coordinates(observations: DataFrame, states: DataFrame) -> DataFrame:
    """Median of the distinct coordinate pairs within the resolved state."""
    pairs = observations.select(ZIP, STATE, "Latitude", "Longitude").distinct()
    resolved = states.select(ZIP, F.col("RepresentativeState").alias(STATE)).filter(F.col(STATE).isNotNull())
    inside = spread_join(pairs, resolved, [ZIP, STATE], "inner").select(ZIP, "Latitude", "Longitude")
    medians = grouped_median(inside, [ZIP], ["Latitude", "Longitude"])
    return medians.select(
        ZIP,
        F.col("Latitude").cast(COORDINATE).alias("RepresentativeLatitude"),
        F.col("Longitude").cast(COORDINATE).alias("RepresentativeLongitude"),
    )


def conformed_geography(geolocation: DataFrame, customers: DataFrame, sellers: DataFrame) -> DataFrame:
    """One row per ZIP found in any source.

    The observations are read twice, once to count spellings and once for the
    coordinates. The counts are checkpointed: every vote starts from them.
    """
    scratch_root(geolocation.sparkSession)
    observations = geolocation_observations(geolocation)
    counts = label_counts(observations).checkpoint()
    references = label_counts(reference_observations(customers, sellers)).checkpoint()
    states = state_resolution(state_candidates(counts, references)).checkpoint()
    spellings = city_spellings(counts, states)
    cities = city_resolution(supported_cities(city_candidates(spellings), references))
    named = cities.join(city_labels(spellings), [ZIP, "CityMatchKey"], "left").drop("CityMatchKey")
    coordinates = representative_coordinates(observations, states)

    located = F.col("SourceRowCount").isNotNull()
    assembled = (
        zip_universe(counts, references)
        .join(source_statistics(counts), ZIP, "left")
        .join(states, ZIP, "left")
        .join(named, ZIP, "left")
        .join(reference_fallback(references).withColumn("_referenced", F.lit(1)), ZIP, "left")
        .join(coordinates, ZIP, "left")
    )

    def or_zero(name: str):
        return F.coalesce(name, F.lit(0))

    return assembled.select(
        ZIP,
        F.when(located, F.col("CityName")).otherwise(F.col("FallbackCity")).alias("CityName"),
        F.when(located, F.col("RepresentativeState")).otherwise(F.col("FallbackState")).alias(STATE),
        "RepresentativeLatitude",
        "RepresentativeLongitude",
        or_zero("SourceRowCount").alias("GeolocationSourceRowCount"),
        or_zero("DistinctStateCount").alias("GeolocationDistinctStateCount"),
        or_zero("DistinctCityLabelCount").alias("GeolocationDistinctCityLabelCount"),
        flag(~located).alias("MissingFromGeolocationFlag"),
        *[
            or_zero(name).alias(name)
            for name in (
                "StateConflictFlag",
                "StateAmbiguousFlag",
                "StateResolvedByReferenceFlag",
                "CityAmbiguousFlag",
                "CityResolvedByReferenceFlag",
            )
        ],
        flag(~located & F.col("_referenced").isNotNull()).alias("ReferenceFallbackFlag"),
    )


def geography_profile(geography: DataFrame) -> DataFrame:
    return audit(
        geography,
        {
            "RowCount": F.count("*"),
            "MissingFromGeolocation": matches(F.col("MissingFromGeolocationFlag") == 1),
            "StateConflicts": matches(F.col("StateConflictFlag") == 1),
            "StateAmbiguous": matches(F.col("StateAmbiguousFlag") == 1),
            "StatesResolvedByReference": matches(F.col("StateResolvedByReferenceFlag") == 1),
            "CityAmbiguous": matches(F.col("CityAmbiguousFlag") == 1),
            "CitiesResolvedByReference": matches(F.col("CityResolvedByReferenceFlag") == 1),
            "ReferenceFallbackZIPs": matches(F.col("ReferenceFallbackFlag") == 1),
            "NullStates": matches(F.col(STATE).isNull()),
            "NullCities": matches(F.col("CityName").isNull()),
            "ZIPsWithoutCoordinates": matches(
                F.col("RepresentativeLatitude").isNull() | F.col("RepresentativeLongitude").isNull()
            ),
        },
    )


def required_zip_coverage(geography: DataFrame, customers: DataFrame, sellers: DataFrame) -> DataFrame:
    """ZIP codes of customers and sellers that the geography lacks."""
    needed = reference_observations(customers, sellers).select(ZIP).distinct()
    missing = needed.join(geography.select(ZIP), ZIP, "left_anti")
    return missing.agg(F.count("*").alias("RequiredZIPsMissing"))


def unresolved_geography(geography: DataFrame) -> DataFrame:
    return (
        geography.filter((F.col("StateAmbiguousFlag") == 1) | (F.col("CityAmbiguousFlag") == 1))
        .select(
            ZIP,
            "CityName",
            STATE,
            "StateConflictFlag",
            "StateAmbiguousFlag",
            "CityAmbiguousFlag",
            "CityResolvedByReferenceFlag",
            "MissingFromGeolocationFlag",
            "ReferenceFallbackFlag",
        )
        .orderBy(ZIP)
    )
