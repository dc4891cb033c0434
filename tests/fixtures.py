"""A small hand-made shop with the awkward cases of every rule."""

from __future__ import annotations

from stallkeep.sources import CONTRACTS

_TYPES = {"text": "string", "timestamp": "timestamp_ntz", "date": "date", "integer": "int"}

DATA = {
    "orders": [
        # id, customer, status, purchase, approved, carrier, delivered, estimated
        ("o1", "c1", "delivered", "2017-03-20 10:00:00", "2017-03-20 11:00:00", "2017-03-21 09:00:00", "2017-03-25 23:59:00", "2017-03-25"),
        ("o2", "c2", "delivered", "2017-03-21 10:00:00", "2017-03-21 11:00:00", "2017-03-21 10:30:00", "2017-03-26 00:00:00", "2017-03-25"),
        ("o3", "c3", "shipped", "2018-01-01 00:00:00", None, "2017-12-31 00:00:00", None, "2018-02-01"),
        ("o4", "c3", "delivered", "2018-01-01 00:00:00", "2018-01-02 00:00:00", None, "2018-01-05 08:00:00", None),
        ("o5", "c4", "canceled", "2018-05-05 12:00:00", None, None, None, "2018-06-01"),
    ],
    "order_items": [
        ("o1", 1, "p1", "s1", "2017-03-22 00:00:00", "10.00", "2.50"),
        ("o1", 2, "p2", "s2", "2017-03-22 00:00:00", "20.00", "0.00"),
        ("o2", 1, "p1", "s1", "2017-03-23 00:00:00", "10.00", "2.50"),
        ("o3", 1, "p3", "s2", "2018-01-03 00:00:00", "5.55", "1.00"),
        ("o4", 1, "p4", "s3", "2018-01-03 00:00:00", "7.00", "1.00"),
    ],
    "products": [
        ("p1", "toys", 10, 100, 1, 500, 10, 10, 10),
        ("p2", None, None, None, None, 300, 10, 10, 10),
        ("p3", "garden", 8, 50, 2, 0, 5, 5, 5),
        ("p4", "garden", 8, 50, 2, None, 5, 5, 5),
    ],
    "category_translation": [("toys", "Toys"), ("music", "Music")],
    "customers": [
        ("c1", "u1", "00001", "São Paulo", "SP"),
        ("c2", "u1", "00002", "sao-paulo ", "SP"),
        ("c3", "u2", "00003", "D'Oeste", "RJ"),
        ("c4", "u3", "00009", "natal", "RN"),
    ],
    "sellers": [
        ("s1", "00001", "SAO PAULO", "SP"),
        ("s2", "00002", "rio de janeiro", "SP"),
        ("s3", "00005", "doeste", "MG"),
    ],
    "payments": [
        ("o1", 1, "credit_card", 3, "32.50"),
        ("o2", 2, "voucher", 1, "12.50"),
        ("o3", 2, "not_defined", 0, "6.00"),
        ("o3", 3, "voucher", 1, "0.00"),
        ("o5", 1, "boleto", 1, "9.99"),
        ("o5", 3, "boleto", 1, "1.00"),
    ],
    "reviews": [
        ("r1", "o1", 5, "good", 'line one\nline "two", end', "2017-03-20 00:00:00", "2017-03-25 23:58:59"),
        ("r1", "o2", 4, None, None, "2017-03-19 00:00:00", "2017-03-26 00:00:00"),
        ("r2", "o3", 1, " ", "never came", "2018-02-10 00:00:00", "2018-02-11 10:00:00"),
        ("r3", "o4", 3, None, None, "2018-01-06 00:00:00", "2018-01-06 12:00:00"),
    ],
    "geolocation": [
        # 00001: one state; three spellings of one city, 1 of another; one exact duplicate
        ("00001", "-23.10", "-46.10", "são paulo", "SP"),
        ("00001", "-23.10", "-46.10", "são paulo", "SP"),
        ("00001", "-23.30", "-46.30", "sao paulo", "SP"),
        ("00001", "-23.70", "-46.50", "sao paulo", "SP"),
        ("00001", "-23.90", "-46.90", "osasco", "SP"),
        # 00002: 3 x SP, 1 x RJ
        ("00002", "-22.10", "-43.10", "rio claro", "SP"),
        ("00002", "-22.20", "-43.20", "rio claro", "SP"),
        ("00002", "-22.30", "-43.30", "rio-claro", "SP"),
        ("00002", "-20.00", "-40.00", "rio", "RJ"),
        # 00003: 2 x SP, 2 x RJ, a customer in RJ decides
        ("00003", "-10.00", "-50.00", "doeste", "SP"),
        ("00003", "-10.00", "-50.00", "doeste", "SP"),
        ("00003", "-11.00", "-51.00", "d'oeste", "RJ"),
        ("00003", "-12.00", "-52.00", "d'oeste", "RJ"),
        # 00004: 2 x SP, 2 x RJ, nobody decides
        ("00004", "-10.00", "-50.00", "x", "SP"),
        ("00004", "-10.00", "-50.00", "x", "SP"),
        ("00004", "-11.00", "-51.00", "y", "RJ"),
        ("00004", "-11.00", "-51.00", "y", "RJ"),
        # 00005: one state, two cities tied, no reference with that city
        ("00005", "-1.00", "-1.00", "alpha", "MG"),
        ("00005", "-2.00", "-2.00", "beta", "MG"),
        ("00005", "-3.00", "-3.00", "alpha", "MG"),
        ("00005", "-4.00", "-4.00", "beta", "MG"),
    ],
}
LOCALIZATION = [("toys", "fa toys"), ("garden", "fa garden")]


def tables(spark):
    """Typed frames of the fixture, by data set."""
    out = {}
    for name, data in DATA.items():
        contract = CONTRACTS[name]
        text = spark.createDataFrame(
            [tuple(None if v is None else str(v) for v in row) for row in data], contract.text_schema
        )
        out[name] = text.select(
            *[text[c].cast(_TYPES.get(role, role)).alias(c) for c, role in contract.columns]
        )
    out["localization"] = spark.createDataFrame(LOCALIZATION, "SourceCategoryName string, PersianCategoryName string")
    return out
