"""Loads that read and write only what changed."""

import random
import tempfile
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import fixtures
from conftest import rows
from stallkeep.operators.changes import UNCHANGED, change_counts, changed_rows, changes, digests, require_unique
from stallkeep.operators.compare import differences
from stallkeep.operators.history import advance_history, open_history, valid_at
from stallkeep.operators.rules import ValidationError
from stallkeep.operators.upsert import upsert_members
from stallkeep.plans import incremental
from stallkeep.plans.incremental import load_touched_facts
from stallkeep.plans.refresh import FACTS, STAGING, Refresh
from stallkeep.session import scratch_path
from stallkeep.sources import CONTRACTS, ContractError, Store
from stallkeep.sources.increment import LEDGER, digest_table, load_increment, marks

ORDERS = "order_id string, customer_id string, order_status string, order_purchase_timestamp timestamp_ntz, order_approved_at timestamp_ntz, order_delivered_carrier_date timestamp_ntz, order_delivered_customer_date timestamp_ntz, order_estimated_delivery_date date"


@pytest.fixture
def store(spark):
    return Store(spark, tempfile.mkdtemp(prefix="stallkeep-increments-"))


def at(day, month=1):
    return datetime(2018, month, day)


def orders(spark, *found):
    return spark.createDataFrame([(k, "c", status, mark, None, None, None, None) for k, status, mark in found], ORDERS)


FIRST = [("a", "new", at(1)), ("b", "new", at(5, 2)), ("c", "new", at(7, 3)), ("d", "new", None)]


def stored(store):
    return rows(store.table("orders"), "order_id", "order_status", "order_purchase_timestamp")


def test_parts_are_replaced_one_by_one(spark, store):
    first = store.new_run()
    paths = store.write_parts(first, "t", spark.createDataFrame([(1, "x"), (2, "y"), (3, None)], "n int, p string"), F.col("p"))
    assert set(paths) == {"x", "y", "none"} and store.parts("t") == {}
    with pytest.raises(LookupError):
        store.table("t")
    store.publish(first, parts={"t": paths})
    assert rows(store.table("t"), "n") == [(1,), (2,), (3,)]
    second = store.new_run()
    new = store.write_parts(second, "t", spark.createDataFrame([(9, "y")], "n int, p string"), F.col("p"))
    store.publish(second, parts={"t": new | {"none": None}})
    assert rows(store.table("t"), "n", "p") == [(1, "x"), (9, "y")]
    assert store.parts("t") == {"x": paths["x"], "y": new["y"]} and store.published() == []
    # Runs in which a part lies are kept.
    assert store.retire(keep=0) == [] and store.table("t").count() == 2


def test_a_second_load_reads_what_it_must_and_equals_a_full_one(spark, store):
    contract = CONTRACTS["orders"]
    one = load_increment(store, orders(spark, *FIRST), contract)
    assert (one.rows_read, one.inserted, one.replaced, one.kept) == (4, 4, ("201801", "201802", "201803", "none"), ())
    assert marks(store)["orders"] == (at(7, 3), 4)
    before = store.parts("orders")
    # Old rows altered beyond the lookback are not seen; late, changed, moved and new ones are.
    now = [("a", "unseen", at(1)), ("b", "new", at(20, 2)), ("c", "paid", at(7, 3)), ("d", "new", None), ("late", "new", at(25, 2)), ("e", "new", at(2, 4))]
    two = load_increment(store, orders(spark, *now), contract)
    assert (two.rows_read, two.inserted, two.updated, two.unchanged, two.late) == (5, 2, 2, 1, 1)
    assert two.replaced == ("201802", "201803", "201804") and two.kept == ("201801", "none")
    after = store.parts("orders")
    assert after["201801"] == before["201801"] and after["none"] == before["none"]
    assert stored(store) == sorted([FIRST[0], *now[1:]], key=repr)
    # The same batch again changes nothing.
    manifest = store._entries()
    three = load_increment(store, orders(spark, *now), contract)
    assert (three.inserted, three.updated, three.replaced) == (0, 0, ()) and store.parts("orders") == after
    assert store._entries() == manifest
    assert rows(store.table(digest_table("orders")), "order_id") == rows(store.table("orders"), "order_id")


def test_a_month_that_loses_its_last_row_is_gone(spark, store):
    contract = CONTRACTS["orders"]
    load_increment(store, orders(spark, ("a", "x", at(30)), ("b", "x", at(2, 2))), contract)
    moved = load_increment(store, orders(spark, ("a", "x", at(1, 2)), ("b", "x", at(2, 2))), contract)
    assert (moved.updated, moved.replaced) == (1, ("201801", "201802")) and set(store.parts("orders")) == {"201802"}
    assert stored(store) == [("a", "x", at(1, 2)), ("b", "x", at(2, 2))]


def test_a_load_that_fails_changes_nothing(spark, store, monkeypatch):
    contract = CONTRACTS["orders"]
    load_increment(store, orders(spark, *FIRST), contract)
    manifest = store._entries()
    for bad in ([("e", "x", at(8, 3)), ("e", "y", at(9, 3))], [(None, "x", at(8, 3))]):
        with pytest.raises(ContractError):
            load_increment(store, orders(spark, *bad), contract)
    monkeypatch.setattr(store, "publish", lambda *a, **k: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError, match="lost"):
        load_increment(store, orders(spark, ("e", "x", at(9, 3))), contract)
    assert store._entries() == manifest and stored(store) == sorted(FIRST, key=repr)


def test_empty_sources_and_a_pushed_condition(spark, store):
    contract = CONTRACTS["orders"]
    nothing = load_increment(store, orders(spark), contract)
    assert (nothing.rows_read, nothing.replaced) == (0, ()) and LEDGER not in store.published()
    load_increment(store, orders(spark, *FIRST), contract)
    path = tempfile.mkdtemp() + "/orders"
    orders(spark, *FIRST).write.parquet(path)
    asked = []
    source = spark.read.parquet(path)
    plain = type(source).filter

    def noted(self, condition):
        found = plain(self, condition)
        asked.append(found._jdf.queryExecution().executedPlan().toString())
        return found

    type(source).filter = noted
    try:
        load_increment(store, source, contract, lookback=timedelta(days=1))
    finally:
        type(source).filter = plain
    assert "GreaterThanOrEqual(order_purchase_timestamp" in asked[0]


def test_changes_tell_nulls_and_neighbours_apart(spark):
    schema = "k string, n int, a string, b string"
    old = spark.createDataFrame([("x", 1, None, "1"), ("x", 2, "1", None), ("x", None, "", "q"), (None, None, "s", "s"), ("gone", 1, "a", "b"), ("y", 1, "ab", "c")], schema)
    new = spark.createDataFrame([("x", 1, None, "1"), ("x", 2, None, "1"), ("x", None, None, "q"), (None, None, "s", "s"), ("new", 1, "a", "b"), ("y", 1, "a", "bc")], schema)
    found = changes(digests(old, ["k", "n"]), digests(new, ["k", "n"]), ["k", "n"])
    assert rows(found) == sorted([("x", 1, "unchanged"), ("x", 2, "update"), ("x", None, "update"), (None, None, "unchanged"), ("gone", 1, "delete"), ("new", 1, "insert"), ("y", 1, "update")], key=repr)
    assert tuple(change_counts(found).first()) == (1, 3, 1, 2)
    assert change_counts(changes(digests(old.limit(0), ["k", "n"]), digests(new.limit(0), ["k", "n"]), ["k", "n"])).first().Inserted == 0


def test_repeated_keys_are_refused(spark):
    once, twice = spark.createDataFrame([("x", 1)], "k string, v int"), spark.createDataFrame([("x", 1), ("x", 1)], "k string, v int")
    for old, new in ((once, twice), (twice, once)):
        with pytest.raises(Exception, match="repeated key: x"):
            changes(digests(old, ["k"]), digests(new, ["k"]), ["k"]).collect()


def test_an_upsert_keeps_keys(spark):
    loaded = spark.createDataFrame([(0, None, None), (1, "b", 1), (2, "d", 2), (3, "f", 3)], "K long, name string, v int")
    members = spark.createDataFrame([("a", 10), ("b", 11), ("f", None), ("z", 13), ("c", 14)], "name string, v int")
    found = upsert_members(loaded, members, "name", "K")
    assert rows(found) == sorted([(0, None, None), (1, "b", 11), (2, "d", 2), (3, "f", None), (4, "a", 10), (5, "c", 14), (6, "z", 13)], key=repr)
    assert rows(upsert_members(found, members, "name", "K")) == rows(found)
    assert rows(upsert_members(loaded.limit(0), members.limit(2), "name", "K")) == [(1, "a", 10), (2, "b", 11)]
    for bad in ([("q", 1), ("q", 2)], [(None, 1)]):
        with pytest.raises(ValidationError, match="upsert aborted"):
            upsert_members(loaded, spark.createDataFrame(bad, "name string, v int"), "name", "K")


def history_of(spark, loads):
    history = None
    for when, members in loads:
        frame, moment = spark.createDataFrame(members, "k string, v int"), F.lit(when).cast("timestamp_ntz")
        history = open_history(frame, moment) if history is None else advance_history(history, frame, ["k"], moment)
    return history


def test_history_versions(spark):
    history = history_of(spark, [(at(1), [("a", 1), ("b", None), ("c", 3)]), (at(10), [("a", 1), ("b", 2), ("d", 4)]), (at(20), [("a", 5), ("b", None), ("c", 3)])])
    assert rows(history, "k", "v", "ValidFrom", "ValidTo", "Version") == sorted(
        [
            ("a", 1, at(1), at(20), 1), ("a", 5, at(20), None, 2), ("b", None, at(1), at(10), 1), ("b", 2, at(10), at(20), 2), ("b", None, at(20), None, 3),
            ("c", 3, at(1), at(10), 1), ("c", 3, at(20), None, 2), ("d", 4, at(10), at(20), 1),
        ],
        key=repr,
    )
    with pytest.raises(Exception, match="repeated key: a"):
        advance_history(history, spark.createDataFrame([("a", 1), ("a", 1)], "k string, v int"), ["k"], F.lit(at(25)).cast("timestamp_ntz")).collect()


def test_the_version_valid_at_a_moment(spark):
    """A hot key with many versions and many rows at one moment, against a plain search."""
    rng = random.Random(4)
    versions = [("hot", i, at(1) + timedelta(hours=5 * i), at(1) + timedelta(hours=5 * i + rng.choice([5, 3])), i) for i in range(200)]
    versions += [("b", 1, at(3), None, 1), (None, 7, at(1), None, 1)]
    history = spark.createDataFrame(versions, "k string, v int, ValidFrom timestamp_ntz, ValidTo timestamp_ntz, Version int")
    asked = [(i, "hot", at(1) + timedelta(minutes=rng.randrange(-600, 65_000))) for i in range(3000)] + [(i, "hot", at(5)) for i in range(3000, 5000)]
    asked += [(5000, "b", at(3)), (5001, "b", at(2)), (5002, "none", at(9)), (5003, None, at(9)), (5004, "hot", None), (5004, "hot", None)]
    frame = spark.createDataFrame(asked, "id int, k string, t timestamp_ntz").repartition(6)
    found = valid_at(frame, history, ["k"], "t", ["v"])
    wanted = []
    for i, k, t in asked:
        hit = [v for key, v, start, end, _ in versions if key is not None and key == k and t is not None and start <= t and (end is None or t < end)]
        wanted.append((i, k, t, hit[0] if hit else None))
    assert rows(found) == sorted(wanted, key=repr)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


@pytest.fixture(scope="module")
def shop(spark):
    t = fixtures.tables(spark)
    store = Store(spark, tempfile.mkdtemp(prefix="stallkeep-months-"))
    run = store.new_run()
    for name in STAGING:
        store.write(run, name, t[name])
    store.publish(run, STAGING)
    return dict(Refresh(store).build())


def equal(a, b):
    d = differences(a, b, [c for c in a.columns if c != "PurchaseMonth"]).first()
    return d.ExpectedRows == d.ActualRows and not d.SourceToTargetDifferences and not d.TargetToSourceDifferences


def test_only_touched_months_are_loaded_anew(spark, store, shop):
    first = load_touched_facts(store, shop)
    assert first == {"replaced": ("201703", "201801", "201805"), "kept": ()}
    assert all(equal(shop[n], store.table(n)) for n in FACTS)
    before = {n: store.parts(n) for n in FACTS}
    assert load_touched_facts(store, shop)["replaced"] == ()
    # A payment of one order, and a review that now shares its id with another month's.
    altered = dict(shop)
    altered["payments"] = shop["payments"].withColumn("payment_value", F.when(F.col("order_id") == "o5", F.lit(1)).otherwise(F.col("payment_value")).cast("decimal(18,2)"))
    assert load_touched_facts(store, altered) == {"replaced": ("201805",), "kept": ("201703", "201801")}
    for n in FACTS:
        assert all(store.parts(n).get(m) == before[n].get(m) for m in ("201703", "201801"))
    altered["reviews"] = shop["reviews"].withColumn("review_id", F.when(F.col("order_id") == "o4", F.lit("r1")).otherwise(F.col("review_id")))
    assert load_touched_facts(store, altered)["replaced"] == ("201703", "201801")
    assert rows(store.table("FactReview"), "OrderID", "DuplicateReviewIDFlag") == [("o1", 1), ("o2", 1), ("o3", 0), ("o4", 1)]
    # An order that moves, and one that goes with all that hangs on it.
    altered["orders"] = shop["orders"].filter("order_id <> 'o5'").withColumn(
        "order_purchase_timestamp", F.when(F.col("order_id") == "o3", F.lit("2017-03-21 00:00:00").cast("timestamp_ntz")).otherwise(F.col("order_purchase_timestamp"))
    )
    for n in ("order_items", "payments", "reviews"):
        altered[n] = altered[n].filter("order_id <> 'o5'")
    assert load_touched_facts(store, altered) == {"replaced": ("201703", "201801", "201805"), "kept": ()}
    assert set(store.parts("FactOrder")) == {"201703", "201801"} and store.table("FactOrder").count() == 4


def test_changed_rows_are_those_of_changes(spark):
    old = spark.createDataFrame([("a", 1, "x"), ("b", 1, None), (None, 1, "x"), ("d", 1, "x"), ("e", 1, "")], "k string, n int, v string")
    new = spark.createDataFrame([("a", 1, "x"), ("b", 1, ""), (None, 1, "y"), ("f", 1, "x"), ("e", 1, "")], "k string, n int, v string")
    key = ["k", "n"]
    before, now = digests(old, key), digests(new, key)
    wanted = rows(changes(before, now, key).filter(F.col("Change") != UNCHANGED))
    assert len(wanted) == 4 and rows(changed_rows(before, now, key)) == wanted
    assert rows(changed_rows(before, before, key)) == [] and len(rows(changed_rows(before.limit(0), now, key))) == 5
    require_unique(now, key)
    for twice in ("a", None):
        again = now.unionByName(now.filter(F.col("k").eqNullSafe(F.lit(twice))))
        for fails in (lambda: changed_rows(before, again, key).count(), lambda: changed_rows(again, now, key).count(), lambda: require_unique(again, key)):
            with pytest.raises(Exception, match="repeated key"):
                fails()


def test_a_load_keeps_one_copy_of_the_digests(spark, store, shop):
    """Digests are written where they are published, and gone if there is nothing to publish."""
    shared = Path(scratch_path(spark, "x")).parent
    there = set(shared.iterdir()) if shared.is_dir() else set()
    load_touched_facts(store, shop)
    load_touched_facts(store, shop)
    left = [p.name for p in shared.iterdir() if p not in there]
    assert not [n for n in left if n.startswith(("digests-", "touched-orders", "orders-", "review-ids"))]
    for name in incremental.SOURCES:
        assert len(list(Path(store.root).glob(f"runs/*/FactInput.{name}"))) == 1


def test_rows_that_are_not_confirmed_stay_invisible(spark, store, shop, monkeypatch):
    load_touched_facts(store, shop)
    manifest = store._entries()
    altered = dict(shop)
    altered["orders"] = shop["orders"].withColumn("order_status", F.lit("lost"))
    real = incremental.facts.fact_payment
    monkeypatch.setattr(incremental.facts, "fact_payment", lambda *a: real(*a).filter("OrderID <> 'o3'"))
    with pytest.raises(ValidationError, match="FactPayment|2 rows missing"):
        load_touched_facts(store, altered)
    assert store._entries() == manifest and equal(shop["FactOrder"], store.table("FactOrder"))
    monkeypatch.undo()
    assert len(load_touched_facts(store, altered)["replaced"]) == 3
    assert rows(store.table("FactOrder"), "OrderStatus") == [("lost",)] * 5
