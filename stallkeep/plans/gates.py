"""Gates around the refresh: before anything is written, after the dimensions, after the facts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stallkeep.functions import matches
from stallkeep.operators.quality import union_all
from stallkeep.operators.rules import Rule, ValidationError, enforce, evaluate_rules, long_metrics
from stallkeep.plans.dates import missing_source_dates, source_dates
from stallkeep.plans.rule_catalog import zero
from stallkeep.plans.validators import invalid_keys, missing_matches

Tables = Mapping[str, DataFrame]

DIMENSION_KEYS = {
    "DimGeography": "GeographyKey",
    "DimCustomer": "CustomerKey",
    "DimSeller": "SellerKey",
    "DimProductCategory": "ProductCategoryKey",
    "DimProduct": "ProductKey",
}
DIMENSION_SOURCES = {
    "DimGeography": "Geography",
    "DimCustomer": "Customer",
    "DimSeller": "sellers",
    "DimProductCategory": "ProductCategory",
    "DimProduct": "products",
}
FACT_SOURCES = {"FactOrder": "orders", "FactOrderItem": "order_items", "FactPayment": "payments", "FactReview": "reviews"}
FACT_COUNTERS = {"FactOrder": "OrderCount", "FactOrderItem": "OrderItemCount", "FactPayment": "PaymentCount", "FactReview": "ReviewCount"}
REQUIRED_INPUTS = (
    "Geography", "Customer", "ProductCategory", "localization",
    "orders", "order_items", "products", "customers", "sellers", "payments", "reviews",
)
# Codes of missing prerequisites.
REQUIRED_TABLES = {"DimDate": 51051, "Geography": 51053, "Customer": 51054, "ProductCategory": 51055, "localization": 51056}

# Gate codes and messages.
PREFLIGHT_RULES = [
    Rule("Preflight", 51052, "UnknownDates <> 1", "DimDate must contain exactly one Unknown member with DateKey = 0."),
    Rule("Preflight", 51058, zero("EmptyInputs"), "one or more required load inputs are empty."),
    Rule("Preflight", 51057, zero("MissingSourceDates"), "one or more required source dates are missing from DimDate."),
]
DIMENSION_RULES = [
    Rule("DimensionGate", 51060, "DimGeographyUnknown <> 1", "invalid DimGeography Unknown member."),
    Rule("DimensionGate", 51061, "DimCustomerUnknown <> 1", "invalid DimCustomer Unknown member."),
    Rule("DimensionGate", 51062, "DimSellerUnknown <> 1", "invalid DimSeller Unknown member."),
    Rule("DimensionGate", 51063, "DimProductCategoryUnknown <> 1", "invalid DimProductCategory Unknown member."),
    Rule("DimensionGate", 51064, "DimProductUnknown <> 1", "invalid DimProduct Unknown member."),
    Rule("DimensionGate", 51065, "DimGeographyRows <> DimGeographySourceRows", "DimGeography row count mismatch."),
    Rule("DimensionGate", 51066, "DimCustomerRows <> DimCustomerSourceRows", "DimCustomer row count mismatch."),
    Rule("DimensionGate", 51067, "DimSellerRows <> DimSellerSourceRows", "DimSeller row count mismatch."),
    Rule("DimensionGate", 51068, "DimProductCategoryRows <> DimProductCategorySourceRows", "DimProductCategory row count mismatch."),
    Rule("DimensionGate", 51069, "DimProductRows <> DimProductSourceRows", "DimProduct row count mismatch."),
    Rule("DimensionGate", 51070, zero("CustomerGeography"), "invalid DimCustomer geography key."),
    Rule("DimensionGate", 51071, zero("SellerGeography"), "invalid DimSeller geography key."),
    Rule("DimensionGate", 51072, zero("ProductCategories"), "invalid DimProduct category key."),
]
FACT_RULES = [
    Rule("FactGate", 51080, "FactOrderRows <> FactOrderSourceRows", "FactOrder row count does not match stg.orders."),
    Rule("FactGate", 51081, "FactOrderItemRows <> FactOrderItemSourceRows", "FactOrderItem row count does not match stg.order_items."),
    Rule("FactGate", 51082, "FactPaymentRows <> FactPaymentSourceRows", "FactPayment row count does not match stg.payments."),
    Rule("FactGate", 51083, "FactReviewRows <> FactReviewSourceRows", "FactReview row count does not match stg.reviews."),
    Rule("FactGate", 51084, zero("FactOrderItemUncovered"), "FactOrderItem contains OrderID values missing from FactOrder."),
    Rule("FactGate", 51085, zero("FactPaymentUncovered"), "FactPayment contains OrderID values missing from FactOrder."),
    Rule("FactGate", 51086, zero("FactReviewUncovered"), "FactReview contains OrderID values missing from FactOrder."),
    Rule("FactGate", 51087, zero("FactOrderCounters"), "invalid FactOrder OrderCount."),
    Rule("FactGate", 51088, zero("FactOrderItemCounters"), "invalid FactOrderItem OrderItemCount."),
    Rule("FactGate", 51089, zero("FactPaymentCounters"), "invalid FactPayment PaymentCount."),
    Rule("FactGate", 51090, zero("FactReviewCounters"), "invalid FactReview ReviewCount."),
]


def require_tables(available: Sequence[str]) -> None:
    for table, code in REQUIRED_TABLES.items():
        if table not in available:
            raise ValidationError("Preflight", code, f"{table} does not exist.")


def empty_inputs(tables: Tables, names: Sequence[str] = REQUIRED_INPUTS) -> DataFrame:
    """How many inputs have no row; each is read only up to its first row."""
    probes = [tables[n].select(F.lit(n).alias("table")).limit(1) for n in names]
    return union_all(probes).agg((F.lit(len(names)) - F.count_distinct("table")).alias("EmptyInputs"))


def preflight_metrics(tables: Tables) -> DataFrame:
    dates = tables["DimDate"]
    days = source_dates(tables["orders"], tables["order_items"], tables["reviews"])
    return union_all(
        [
            long_metrics(dates.agg(matches(F.col("DateKey") == 0).alias("UnknownDates")), "Preflight"),
            long_metrics(empty_inputs(tables), "Preflight"),
            long_metrics(
                missing_source_dates(days, dates).agg(F.count("*").alias("MissingSourceDates")), "Preflight"
            ),
        ]
    )


def _named(one_row: DataFrame, scope: str, name: str) -> DataFrame:
    return long_metrics(one_row.toDF(name), scope)


def dimension_metrics(tables: Tables) -> DataFrame:
    scope, parts = "DimensionGate", []
    for dim, key in DIMENSION_KEYS.items():
        parts.append(
            long_metrics(
                tables[dim].agg(
                    matches(F.col(key) == 0).alias(f"{dim}Unknown"), matches(F.col(key) != 0).alias(f"{dim}Rows")
                ),
                scope,
            )
        )
        parts.append(_named(tables[DIMENSION_SOURCES[dim]].agg(F.count("*")), scope, f"{dim}SourceRows"))
    for dim, column, parent, name in (
        ("DimCustomer", "RepresentativeGeographyKey", "DimGeography", "CustomerGeography"),
        ("DimSeller", "GeographyKey", "DimGeography", "SellerGeography"),
        ("DimProduct", "ProductCategoryKey", "DimProductCategory", "ProductCategories"),
    ):
        invalid = invalid_keys(tables[dim], column, tables[parent], DIMENSION_KEYS[parent], allow_unknown=True)
        parts.append(_named(invalid, scope, name))
    return union_all(parts)


def fact_metrics(tables: Tables) -> DataFrame:
    scope, parts = "FactGate", []
    for fact, source in FACT_SOURCES.items():
        parts.append(
            long_metrics(
                tables[fact].agg(
                    F.count("*").alias(f"{fact}Rows"), matches(F.col(FACT_COUNTERS[fact]) != 1).alias(f"{fact}Counters")
                ),
                scope,
            )
        )
        parts.append(_named(tables[source].agg(F.count("*")), scope, f"{fact}SourceRows"))
        if fact != "FactOrder":
            parts.append(_named(missing_matches(tables[fact], tables["FactOrder"], "OrderID"), scope, f"{fact}Uncovered"))
    return union_all(parts)


GATES = {
    "Preflight": (preflight_metrics, PREFLIGHT_RULES),
    "DimensionGate": (dimension_metrics, DIMENSION_RULES),
    "FactGate": (fact_metrics, FACT_RULES),
}


def gate_outcomes(tables: Tables, gate: str) -> DataFrame:
    metrics, rules = GATES[gate]
    return evaluate_rules(metrics(tables), rules)


def pass_gate(tables: Tables, gate: str) -> None:
    """Raise for the first rule of the gate that does not hold."""
    metrics, rules = GATES[gate]
    enforce(evaluate_rules(metrics(tables), rules), rules)
