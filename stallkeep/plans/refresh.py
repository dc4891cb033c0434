"""The full refresh, in dependency order."""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stallkeep.sources.store import Store
from stallkeep.operators.rules import ValidationError
from stallkeep.session import release
from stallkeep.plans import category, customer, dates, dimensions, facts, gates, geography, validators

STAGING = (
    "orders", "order_items", "products", "category_translation", "customers",
    "sellers", "payments", "reviews", "geolocation", "localization",
)
CONFORMED = ("Geography", "Customer", "ProductCategory")
DIMENSIONS = ("DimGeography", "DimCustomer", "DimSeller", "DimProductCategory", "DimProduct")
FACTS = ("FactOrder", "FactOrderItem", "FactPayment", "FactReview")
BUILT = ("DimDate", *CONFORMED)
# Facts are laid out by purchase month, so that a month is read without the others.
MONTH = "PurchaseMonth"


class Refresh:
    """One run: reads published staging tables, writes everything else afresh, publishes last.

    Tables of a run live under the run's own folder, so surrogate keys start
    again at 1 and a failed run changes nothing a reader can see.
    """

    def __init__(self, store: Store, target: str | None = None):
        if target is not None and target != store.root:
            raise ValidationError("Reset", 51040, f"full-refresh reset aborted: {store.root} is not {target}.")
        self.store = store
        published = store.tables()
        # Inputs are checked before any work: what the run itself builds counts as there.
        gates.require_tables([*published, *BUILT])
        self.run = store.new_run()
        self.tables: dict[str, DataFrame] = {n: df for n, df in published.items() if n in STAGING}
        self.written: list[str] = []

    def _write(self, name: str, df: DataFrame, by_month: bool = False) -> None:
        if by_month:
            month = F.floor(F.col("PurchaseDateKey") / 100).cast("int")
            # REBALANCE evens out files: large months are split, small ones share a task.
            df = df.withColumn(MONTH, month).hint("rebalance", MONTH)
        self.tables[name] = self.store.write(self.run, name, df, [MONTH] if by_month else [])
        self.written.append(name)

    def _both(self, *steps) -> None:
        """Independent branches share the cluster; the first failure is raised."""
        with ThreadPoolExecutor(max_workers=len(steps)) as pool:
            for done in [pool.submit(step) for step in steps]:
                done.result()

    def build_dates(self) -> None:
        t = self.tables
        found = dates.require_dates(dates.source_date_range(t["orders"], t["order_items"], t["reviews"]))
        self._write("DimDate", dates.dim_date(found))

    def conform(self) -> None:
        t = self.tables
        self._both(
            lambda: self._write("Geography", geography.conformed_geography(t["geolocation"], t["customers"], t["sellers"])),
            lambda: self._write("Customer", customer.conformed_customer(t["customers"], t["orders"])),
            lambda: self._write("ProductCategory", category.conformed_category(t["products"], t["category_translation"])),
        )

    def preflight(self) -> None:
        gates.require_tables(list(self.tables))
        gates.pass_gate(self.tables, "Preflight")

    def load_dimensions(self) -> None:
        t = self.tables
        for name in DIMENSIONS:
            if name in t:  # this run has loaded it already
                dimensions.refuse_reload(t[name], name)

        def places() -> None:
            self._write("DimGeography", dimensions.dim_geography(t["Geography"]))
            self._both(
                lambda: self._write("DimCustomer", dimensions.dim_customer(t["Customer"], t["DimGeography"])),
                lambda: self._write("DimSeller", dimensions.dim_seller(t["sellers"], t["DimGeography"])),
            )

        def goods() -> None:
            self._write("DimProductCategory", dimensions.dim_category(t["ProductCategory"], t["localization"]))
            self._write("DimProduct", dimensions.dim_product(t["products"], t["DimProductCategory"]))

        self._both(places, goods)

    def load_facts(self) -> None:
        t = self.tables
        # One after another, each fills the cluster: only one fact's shuffles are on disk at a time.
        loads = {
            "FactOrder": lambda: facts.fact_order(t["orders"], t["customers"], t["DimCustomer"], t["DimGeography"]),
            "FactOrderItem": lambda: facts.fact_order_item(t["order_items"], t["FactOrder"], t["DimProduct"], t["DimSeller"]),
            "FactPayment": lambda: facts.fact_payment(t["payments"], t["FactOrder"]),
            "FactReview": lambda: facts.fact_review(t["reviews"], t["FactOrder"]),
        }
        for name in FACTS:
            self._write(name, loads[name](), by_month=True)
            release(self.store.spark)

    def build(self) -> Mapping[str, DataFrame]:
        """Everything up to the fact gate, unpublished; the disk of a step is free before the next."""
        steps = [
            self.build_dates,
            self.conform,
            self.preflight,
            self.load_dimensions,
            lambda: gates.pass_gate(self.tables, "DimensionGate"),
            self.load_facts,
            lambda: gates.pass_gate(self.tables, "FactGate"),
        ]
        for step in steps:
            step()
            release(self.store.spark)
        return self.tables

    def publish(self) -> None:
        self.store.publish(self.run, self.written)


def full_refresh(store: Store, baseline: Mapping | None = None, target: str | None = None) -> list[str]:
    """Build, gate, validate, publish. Returns the validators that passed."""
    refresh = Refresh(store, target)
    tables = refresh.build()
    passed = validators.validate_warehouse(tables, baseline=baseline)
    refresh.publish()
    return passed
