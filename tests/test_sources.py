import os
import tempfile

import pytest

from conftest import rows
from fixtures import DATA
from stallkeep.sources import CONTRACTS, ContractError, Store, contract_for, ingest, load_table, scan_csv, typed
from stallkeep.sources.contracts import Contract
from stallkeep.sources.ingest import cast_failures, check_key, malformed_lines


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="stallkeep-test-")


def write(folder, text, name="file.csv"):
    path = os.path.join(folder, name)
    with open(path, "w", encoding="utf-8", newline="") as out:
        out.write(text)
    return path


ITEMS = "order_id,order_item_id,product_id,seller_id,shipping_limit_date,price,freight_value\n"


def test_unknown_dataset():
    with pytest.raises(ValueError, match="unknown data set 'nothing'"):
        contract_for("nothing")


def test_contract_shapes():
    assert list(CONTRACTS) == [
        "orders", "order_items", "products", "category_translation", "customers", "sellers", "payments", "reviews", "geolocation",
    ]
    assert CONTRACTS["geolocation"].key == () and CONTRACTS["reviews"].key == ("review_id", "order_id")


def test_missing_file(spark, folder):
    with pytest.raises(FileNotFoundError):
        scan_csv(spark, folder + "/none.csv", CONTRACTS["order_items"])


def test_reordered_header(spark, folder):
    path = write(folder, "order_item_id,order_id,product_id,seller_id,shipping_limit_date,price,freight_value\n1,o,p,s,,1,1\n")
    with pytest.raises(ContractError, match="expected columns"):
        scan_csv(spark, path, CONTRACTS["order_items"])


def test_missing_texts_and_leading_zeros(spark, folder):
    path = write(folder, "seller_id,seller_zip_code_prefix,seller_city,seller_state\ns1,00123,NA,\ns2,01000,null,N/A\ns3,NaN,nanuque,MG\n")
    got = rows(scan_csv(spark, path, CONTRACTS["sellers"]))
    assert got == [("s1", "00123", None, None), ("s2", "01000", None, None), ("s3", None, "nanuque", "MG")]


def test_quoted_text_over_several_lines(spark, folder):
    path = write(
        folder,
        "review_id,order_id,review_score,review_comment_title,review_comment_message,review_creation_date,review_answer_timestamp\n"
        'r1,o1,5,,"first\nsecond, ""quoted""",2018-01-01 00:00:00,2018-01-02 03:04:05\n',
    )
    row = typed(scan_csv(spark, path, CONTRACTS["reviews"]), CONTRACTS["reviews"]).first()
    assert row.review_comment_message == 'first\nsecond, "quoted"' and row.review_score == 5
    assert str(row.review_answer_timestamp) == "2018-01-02 03:04:05"


@pytest.mark.parametrize(
    "line, column",
    [
        ("o,12x,p,s,2018-01-01 00:00:00,1.00,1.00", "order_item_id"),
        ("o,1.5,p,s,2018-01-01 00:00:00,1.00,1.00", "order_item_id"),
        ("o,1,p,s,yesterday,1.00,1.00", "shipping_limit_date"),
        ("o,1,p,s,2018-01-01 00:00:00,1.x,1.00", "price"),
        ("o,1,p,s,2018-01-01 00:00:00,1.239,1.00", "price"),
        ("o,1,p,s,2018-01-01 00:00:00,1.00,0.0049", "freight_value"),
        ("o,1,p,s,2018-01-01 00:00:00,1239e-3,1.00", "price"),
        ("o,1,p,s,2018-01-01T00:00:00+03:00,1.00,1.00", "shipping_limit_date"),
        ("o,1,p,s,2018-01-01 00:00:00Z,1.00,1.00", "shipping_limit_date"),
    ],
)
def test_unreadable_values_fail(spark, folder, line, column):
    raw = scan_csv(spark, write(folder, ITEMS + line + "\n"), CONTRACTS["order_items"])
    assert cast_failures(raw, CONTRACTS["order_items"]).first()[column] == 1
    with pytest.raises(Exception, match=f"order_items.{column}"):
        typed(raw, CONTRACTS["order_items"]).collect()


@pytest.mark.parametrize("line", ["o,1,p,s,,1,1,x,y", "o,1,p,s,,1", '"o,1,p,s,,1,1', "o"])
def test_malformed_lines_fail_also_where_few_columns_are_read(spark, folder, line):
    path = write(folder, ITEMS + "o,2,p,s,,1,1\n" + line + "\n")
    assert tuple(malformed_lines(spark, path, CONTRACTS["order_items"]).first()) == (1, 2)
    raw = scan_csv(spark, path, CONTRACTS["order_items"])
    for read in (raw, raw.select("price"), raw.filter("order_item_id = '2'"), raw.groupBy().count()):
        with pytest.raises(Exception, match="order_items: malformed line"):
            read.collect()


def test_an_estimated_day_must_be_a_day(spark, folder):
    header = ",".join(CONTRACTS["orders"].column_names)
    good = typed(scan_csv(spark, write(folder, f"{header}\no,c,s,,,,,2018-01-01 00:00:00\n", "a.csv"), CONTRACTS["orders"]), CONTRACTS["orders"])
    assert str(good.first().order_estimated_delivery_date) == "2018-01-01"
    bad = scan_csv(spark, write(folder, f"{header}\no,c,s,,,,,2018-01-01 10:00:00\n", "b.csv"), CONTRACTS["orders"])
    with pytest.raises(Exception, match="orders.order_estimated_delivery_date"):
        typed(bad, CONTRACTS["orders"]).collect()


def test_trailing_zeros_and_exponents_are_exact(spark, folder):
    path = write(folder, ITEMS + "o,1,p,s,2018-01-01 00:00:00.5,1.2300,12e-1\n")
    row = typed(scan_csv(spark, path, CONTRACTS["order_items"]), CONTRACTS["order_items"]).first()
    assert (str(row.price), str(row.freight_value)) == ("1.23", "1.20")


def test_blank_decimals_and_whole_numbers(spark, folder):
    path = write(folder, ITEMS + "o,1.0,p,s,2018-01-01 00:00:00, ,0.10\n")
    row = typed(scan_csv(spark, path, CONTRACTS["order_items"]), CONTRACTS["order_items"]).first()
    assert (row.order_item_id, row.price, str(row.freight_value)) == (1, None, "0.10")


def test_key_gates(spark, folder):
    for body, message in (("o,1,p,s,,1,1\no,1,p,s,,2,2\n", "duplicate key rows: 1"), (",1,p,s,,1,1\n", "NULL in key")):
        path = write(tempfile.mkdtemp(), ITEMS + body)
        with pytest.raises(ContractError, match=message):
            ingest(spark, path, CONTRACTS["order_items"], folder + "/" + message[:4])


def test_no_key_no_gate(spark):
    check_key(spark.range(3).selectExpr("1 AS id"), Contract("free", (("id", "integer"),)))


def test_ingest_stores_every_row(spark, folder):
    lines = "".join(",".join(map(str, r)) + "\n" for r in DATA["order_items"])
    stored = ingest(spark, write(folder, ITEMS + lines), CONTRACTS["order_items"], folder + "/stored")
    assert stored.count() == len(DATA["order_items"])
    with pytest.raises(Exception, match="already exists"):
        load_table(stored, folder + "/stored", "order_items")


def test_publish_makes_a_run_visible_at_once(spark, folder):
    store = Store(spark, folder)
    assert store.published() == [] and store.tables() == {}
    first = store.new_run()
    store.write(first, "t", spark.range(3))
    with pytest.raises(LookupError):
        store.table("t")
    store.publish(first, ["t"])
    assert store.table("t").count() == 3
    second = store.new_run()
    store.write(second, "t", spark.range(5))
    assert store.table("t").count() == 3
    store.publish(second, ["t"])
    assert store.table("t").count() == 5
    with pytest.raises(Exception, match="already exists"):
        store.write(second, "t", spark.range(1))


def test_retired_runs_are_those_nobody_reads(spark, folder):
    store = Store(spark, folder)
    assert store.retire() == []
    runs = [store.new_run() for _ in range(5)]
    for run in runs:
        store.write(run, "t", spark.range(1))
    store.write(runs[0], "u", spark.range(2))
    store.publish(runs[0], ["u"])
    store.publish(runs[3], ["t"])
    assert store.retire(keep=1) == [runs[1], runs[2]]
    assert store.table("t").count() == 1 and store.table("u").count() == 2
    assert store.retire(keep=0) == [runs[4]]
