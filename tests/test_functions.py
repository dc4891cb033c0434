import datetime as dt

import pytest
from pyspark.sql import functions as F

from stallkeep.functions import city_key, date_key, flag, flag_unless_null, folded, is_blank, jalali_date, jalali_parts, text_length
from stallkeep.functions.calendar import with_gregorian_attributes, with_jalali_attributes
from stallkeep.plans.dates import known_conversions


def test_city_keys_ignore_case_accents_and_separators(spark):
    cities = ["São Paulo", "sao-paulo ", "SAO PAULO", "D'Oeste", "doeste", None, "Conceição"]
    df = spark.createDataFrame([(c,) for c in cities], "c string")
    keys = [r[0] for r in df.select(city_key("c")).collect()]
    assert keys == ["saopaulo"] * 3 + ["doeste"] * 2 + [None, "conceicao"]


def test_folded_keeps_separators(spark):
    df = spark.createDataFrame([("São-A ",)], "c string")
    assert df.select(folded("c")).first()[0] == "sao-a"


def test_text_helpers(spark):
    df = spark.createDataFrame([("ab  ",), ("  ",), (None,)], "c string")
    assert [tuple(r) for r in df.select(text_length("c"), is_blank("c")).collect()] == [(2, False), (0, True), (None, None)]


def test_flags_treat_unknown_as_zero_or_null(spark):
    df = spark.createDataFrame([(1, 2), (None, 2), (3, None)], "a int, b int")
    got = df.select(flag(F.col("a") < F.col("b")), flag_unless_null(F.col("a"), F.col("a") < F.col("b"))).collect()
    assert [tuple(r) for r in got] == [(1, 1), (0, None), (0, 0)]


@pytest.mark.parametrize(
    "day, expected",
    [
        ("2016-01-01", "1394/10/11"),
        ("2016-03-20", "1395/01/01"),
        ("2017-03-20", "1395/12/30"),
        ("2017-03-21", "1396/01/01"),
        ("2018-03-21", "1397/01/01"),
        ("2019-03-21", "1398/01/01"),
        ("2020-03-20", "1399/01/01"),
        ("2020-12-31", "1399/10/11"),
        ("1979-02-11", "1357/11/22"),
    ],
)
def test_known_jalali_dates(spark, day, expected):
    df = spark.createDataFrame([(day,)], "d string").select(F.col("d").cast("date").alias("d"))
    assert df.select(jalali_date("d")).first()[0] == expected


def test_nowruz_table_passes(spark):
    assert {r.ValidationStatus for r in known_conversions(spark).collect()} == {"PASS"}


def test_jalali_calendar_runs_without_gaps(spark):
    """Every day follows the one before: next day, next month's first, or next year's first."""
    days = spark.sql("SELECT explode(sequence(DATE'1900-01-01', DATE'2100-12-31')) AS d")
    parts = jalali_parts("d")
    got = days.select("d", parts.year, parts.month, parts.day).orderBy("d").collect()
    months = [31] * 6 + [30] * 5
    for before, after in zip(got, got[1:]):
        _, y, m, d = before
        year_end = m == 12 and d in (29, 30)
        month_end = m < 12 and d == months[m - 1]
        allowed = {(y, m, d + 1)}
        if month_end:
            allowed = {(y, m + 1, 1)}
        elif year_end:
            allowed.add((y + 1, 1, 1))
        assert tuple(after)[1:] in allowed
    assert all(r[2] != 12 or r[3] <= 30 for r in got)


def test_null_dates(spark):
    df = spark.createDataFrame([(None,)], "d date")
    got = df.select(jalali_date("d"), date_key("d"), date_key("d", null_as_unknown=True)).first()
    assert tuple(got) == (None, None, 0)


def test_calendar_attributes_against_python(spark):
    days = spark.sql("SELECT explode(sequence(DATE'2015-12-20', DATE'2021-01-10')) AS DateValue")
    for r in with_jalali_attributes(with_gregorian_attributes(days)).collect():
        d: dt.date = r.DateValue
        iso = d.isocalendar()
        assert (r.DateKey, r.ISOWeekNumber, r.DayOfWeekNumber) == (int(d.strftime("%Y%m%d")), iso[1], iso[2])
        assert (r.MonthNameEN, r.MonthShortNameEN, r.DayNameEN) == (d.strftime("%B"), d.strftime("%b"), d.strftime("%A"))
        assert (r.DayOfYear, r.YearMonthLabel, r.IsWeekend) == (d.timetuple().tm_yday, d.strftime("%Y-%m"), int(iso[2] >= 6))
        assert r.PersianDateKey == int(r.PersianDate.replace("/", ""))
        assert r.PersianQuarter == (r.PersianMonthNumber - 1) // 3 + 1
