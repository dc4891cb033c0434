"""A fact load that replaces only the months it must."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stallkeep.operators.changes import changed_rows, digests, require_unique
from stallkeep.operators.compare import differences_of_stored
from stallkeep.operators.joins import spread_join
from stallkeep.operators.rules import ValidationError
from stallkeep.plans import expected, facts
from stallkeep.plans.refresh import FACTS, MONTH
from stallkeep.session import release, write_scratch
from stallkeep.sources.contracts import CONTRACTS
from stallkeep.sources.increment import month_of
from stallkeep.sources.store import Store

# The data sets that facts are made of.
SOURCES = ("orders", "order_items", "payments", "reviews", "customers")
# Not one of the fixed rule codes, which end below 52000.
RECONCILE_CODE = 52002
_EXPECTED = {"FactOrder": expected.fact_order, "FactOrderItem": expected.fact_order_item, "FactPayment": expected.fact_payment, "FactReview": expected.fact_review}

Tables = Mapping[str, DataFrame]


def input_table(dataset: str) -> str:
    return f"FactInput.{dataset}"


def touched_orders(before: Tables, now: Tables, tables: Tables) -> DataFrame:
    """Orders whose facts may differ from those loaded, from the digests of both states of the sources.

    A row that was added, changed or removed touches its order; a review also
    touches the orders that share its review id, whose duplicate flags depend on
    it; a customer touches the orders it has now.
    """
    found = None
    for name in SOURCES:
        key = list(CONTRACTS[name].key)
        changed = changed_rows(before[name], now[name], key)
        if name == "reviews":
            both = before[name].select(*key).unionByName(now[name].select(*key))
            shared = both.join(changed.select("review_id").distinct(), "review_id", "left_semi").select("order_id")
            changed = changed.select("order_id").unionByName(shared)
        elif name == "customers":
            changed = tables["orders"].select("order_id", "customer_id").join(changed, "customer_id", "left_semi")
        found = changed.select("order_id") if found is None else found.unionByName(changed.select("order_id"))
    return found.distinct()


def load_touched_facts(store: Store, tables: Tables) -> dict[str, tuple[str, ...]]:
    """Bring the four facts up to ``tables`` (staging and loaded dimensions); the months replaced and kept.

    The digests of the sources as they were at the last load, published with it,
    name the orders that changed. The months these orders were and are in are
    loaded anew, from the orders of those months alone, and compared with their
    second derivation; all other months keep their files. The dimensions must have
    kept their keys since the last load (``upsert_members``). Facts and digests
    become visible in one commit; a load that fails, or whose rows the second
    derivation does not confirm, changes nothing a reader can see. The first load
    replaces every month.
    """
    spark, run = store.spark, store.new_run()
    now = {n: store.write(run, input_table(n), digests(tables[n].select(*CONTRACTS[n].column_names), CONTRACTS[n].key)) for n in SOURCES}
    published, scratch = store.published(), []
    parts = {name: store.parts(name) for name in FACTS}

    def held(df: DataFrame, name: str) -> DataFrame:
        df, path = write_scratch(df, name)
        scratch.append(path)
        return df

    stamps = tables["orders"].select("order_id", month_of(F.col("order_purchase_timestamp")).alias(MONTH))
    whole = not parts["FactOrder"] and not any(input_table(n) in published for n in SOURCES)
    if whole:
        # The first load: every row is new, so every order is touched.
        for n in SOURCES:
            require_unique(now[n], list(CONTRACTS[n].key))
        months = stamps.filter(F.col("order_id").isNotNull()).select(MONTH)
        whole = stamps.filter(F.col("order_id").isNull() | F.col(MONTH).isNull()).isEmpty()
    else:
        before = {n: store.table(input_table(n)) if input_table(n) in published else now[n].limit(0) for n in SOURCES}
        touched = held(touched_orders(before, now, tables), "touched-orders")
        months = spread_join(stamps, touched, ["order_id"], "left_semi").select(MONTH)
        if parts["FactOrder"]:
            was = store.table("FactOrder").select(F.col("OrderID").alias("order_id"), month_of(F.col("PurchaseTimestamp")).alias(MONTH))
            months = months.unionByName(spread_join(was, touched, ["order_id"], "left_semi").select(MONTH))
    # As many as the calendar has.
    replaced = sorted(r[0] for r in months.distinct().collect())
    if not replaced:
        release(spark, *scratch, *[store.path(run, input_table(n)) for n in SOURCES])
        return {"replaced": (), "kept": tuple(sorted(parts["FactOrder"]))}

    some = dict(tables)
    if not whole:
        some["orders"] = held(tables["orders"].filter(month_of(F.col("order_purchase_timestamp")).isin(replaced)), "orders")
        of_orders = some["orders"].select("order_id")
        for name in ("order_items", "payments"):
            some[name] = spread_join(tables[name], of_orders, ["order_id"], "left_semi")
        # The duplicate flag needs every row of a review id, whatever month its order is in.
        ids = spread_join(tables["reviews"].select("review_id", "order_id"), of_orders, ["order_id"], "left_semi").select("review_id").distinct()
        some["reviews"] = spread_join(tables["reviews"], held(ids, "review-ids"), ["review_id"], "left_semi")

    new: dict[str, dict[str, str | None]] = {}

    def load(name: str, rows: DataFrame) -> None:
        month = F.floor(F.col("PurchaseDateKey") / 100).cast("int").cast("string")
        paths = store.write_parts(run, name, rows, month)
        release(spark)
        new[name] = {m: paths.get(m) for m in replaced}
        some[name] = store.read_parts(list(paths.values())) if paths else rows.limit(0)

    load("FactOrder", facts.fact_order(some["orders"], some["customers"], some["DimCustomer"], some["DimGeography"]))
    load("FactOrderItem", facts.fact_order_item(some["order_items"], some["FactOrder"], some["DimProduct"], some["DimSeller"]))
    load("FactPayment", facts.fact_payment(some["payments"], some["FactOrder"]))
    load("FactReview", facts.fact_review(some["reviews"], some["FactOrder"]))
    # All children take the keys of their orders from one derivation.
    some[expected.PLACED] = held(expected.placed_orders(some), "placed-orders")
    for name in FACTS:
        reconcile(name, some)
        release(spark)
    store.publish(run, [input_table(n) for n in SOURCES], new)
    release(spark, *scratch)
    return {"replaced": tuple(replaced), "kept": tuple(sorted(set(parts["FactOrder"]) - set(replaced)))}


def reconcile(name: str, tables: Tables) -> None:
    """Fail unless a fact holds just the rows that the second derivation gives."""
    wanted = _EXPECTED[name](tables)
    d = differences_of_stored(wanted, tables[name], wanted.columns).first()
    if d.ExpectedRows != d.ActualRows or d.SourceToTargetDifferences or d.TargetToSourceDifferences:
        raise ValidationError(
            name, RECONCILE_CODE, f"incremental load aborted: {d.SourceToTargetDifferences} rows missing, {d.TargetToSourceDifferences} rows unexpected, {d.ActualRows} of {d.ExpectedRows} rows."
        )
