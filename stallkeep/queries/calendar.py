"""The date dimension."""

from __future__ import annotations

from pyspark.sql import functions as F

from stallkeep.functions import jalali_date, jalali_parts
from stallkeep.functions.calendar import (
    DAYS_EN, DAYS_FA, MONTHS_EN, MONTHS_FA, MONTHS_SHORT_EN, SEASON_FA, UNKNOWN_FA,
    with_gregorian_attributes, with_jalali_attributes,
)
from stallkeep.plans import dates
from stallkeep.queries.built import staging, warehouse
from stallkeep.queries.oracle import day, jalali_sql, jalali_text
from stallkeep.queries.roles import driver_table


def _sources(s, d):
    t = staging(s, d)
    return t["orders"], t["order_items"], t["reviews"]


def _days(s, d):
    return dates.calendar_days(dates.source_date_range(*_sources(s, d)))


def _converted(s, d):
    """Every order date and event day of the driver's own tables in both calendars."""
    bought = driver_table(s, d, "orders").select(F.col("o_orderdate").cast("date").alias("Day"))
    seen = driver_table(s, d, "events").select(F.col("ts").cast("date").alias("Day"))
    parts = jalali_parts("Day")
    return bought.unionByName(seen).groupBy("Day").agg(F.count("*").alias("Rows")).select(
        "Day", "Rows", jalali_date("Day").alias("PersianDate"), parts.year.alias("PersianYear"),
        parts.month.alias("PersianMonth"), parts.day.alias("PersianDay"),
    )


def _guarded(s, d):
    return dates.require_dates(dates.source_date_range(*_sources(s, d)))


def _new_years(s, d):
    """First day of each Jalali year in the calendar."""
    return warehouse(s, d)["DimDate"].filter("PersianMonthNumber = 1 AND PersianDayOfMonth = 1").select("DateValue", "PersianDate", "DayNameFA")


def _missing(s, d):
    missing = dates.missing_source_dates(dates.source_dates(*_sources(s, d)), warehouse(s, d)["DimDate"])
    return missing.agg(F.count("*").alias("MissingSourceDates"))


QUERIES = {
    "dat_01_jalali_conversion": _converted,
    "dat_02_source_date_range": lambda s, d: dates.source_date_range(*_sources(s, d)),
    "dat_03_guarded_range": _guarded,
    "dat_04_calendar_days": _days,
    "dat_05_gregorian_attributes": lambda s, d: with_gregorian_attributes(_days(s, d)),
    "dat_06_jalali_attributes": lambda s, d: with_jalali_attributes(_days(s, d)),
    "dat_07_dim_date": lambda s, d: dates.dim_date(dates.source_date_range(*_sources(s, d))),
    "dat_08_new_year_days": _new_years,
    "dat_09_missing_source_dates": _missing,
    "dat_10_profile": lambda s, d: dates.date_profile(warehouse(s, d)["DimDate"]),
    "dat_10_sample": lambda s, d: dates.date_sample(warehouse(s, d)["DimDate"]),
}


def _list(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


_J = jalali_sql("d")


def _b(expression: str, name: str) -> str:
    return f"CAST({expression} AS BIGINT) AS {name}"


_GREGORIAN = f"""
    {_b('year(d) * 10000 + month(d) * 100 + day(d)', 'DateKey')}, {day('d')} AS DateValue, {day('d')} AS DateLabelEN, {_b('year(d)', 'CalendarYear')},
    {_b('quarter(d)', 'CalendarQuarter')}, 'Q' || quarter(d) AS QuarterLabelEN, {_b('month(d)', 'MonthNumber')},
    list_extract({_list(MONTHS_EN)}, CAST(month(d) AS INTEGER)) AS MonthNameEN, list_extract({_list(MONTHS_SHORT_EN)}, CAST(month(d) AS INTEGER)) AS MonthShortNameEN,
    {_b('year(d) * 100 + month(d)', 'YearMonthKey')}, strftime(d, '%Y-%m') AS YearMonthLabel, {_b('day(d)', 'DayOfMonth')}, {_b('dayofyear(d)', 'DayOfYear')},
    {_b('isodow(d)', 'DayOfWeekNumber')}, list_extract({_list(DAYS_EN)}, CAST(isodow(d) AS INTEGER)) AS DayNameEN,
    list_extract({_list(DAYS_FA)}, CAST(isodow(d) AS INTEGER)) AS DayNameFA, {_b('week(d)', 'ISOWeekNumber')}, {_b('isodow(d) >= 6', 'IsWeekend')}"""
_JALALI = f"""
    {_b(f"{_J['year']} * 10000 + {_J['month']} * 100 + {_J['day']}", 'PersianDateKey')}, {jalali_text('d')} AS PersianDate, {_b(_J['year'], 'PersianYear')},
    {_b(f"({_J['month']} - 1) // 3 + 1", 'PersianQuarter')}, '{SEASON_FA}' || (({_J['month']} - 1) // 3 + 1) AS PersianQuarterLabelFA,
    {_b(_J['month'], 'PersianMonthNumber')}, list_extract({_list(MONTHS_FA)}, CAST({_J['month']} AS INTEGER)) AS PersianMonthNameFA,
    {_b(f"{_J['year']} * 100 + {_J['month']}", 'PersianYearMonthKey')}, {_J['year']} || '/' || lpad(CAST({_J['month']} AS VARCHAR), 2, '0') AS PersianYearMonthLabel,
    {_b(_J['day'], 'PersianDayOfMonth')}"""
_RANGE = f"SELECT {day('min(d)')} AS MinSourceDate, {day('max(d)')} AS MaxSourceDate FROM source_days"

ORACLE = {
    "dat_01_jalali_conversion": f"""SELECT {day('d')} AS "Day", count(*) AS "Rows", {jalali_text('d')} AS PersianDate, {_b(_J['year'], 'PersianYear')},
        {_b(_J['month'], 'PersianMonth')}, {_b(_J['day'], 'PersianDay')}
        FROM (SELECT CAST(o_orderdate AS DATE) AS d FROM orders UNION ALL SELECT CAST(ts AS DATE) FROM events) GROUP BY d""",
    "dat_02_source_date_range": _RANGE,
    "dat_03_guarded_range": _RANGE,
    "dat_04_calendar_days": f"SELECT {day('d')} AS DateValue FROM calendar",
    "dat_05_gregorian_attributes": f"SELECT {_GREGORIAN} FROM calendar",
    "dat_06_jalali_attributes": f"SELECT {day('d')} AS DateValue, {_JALALI} FROM calendar",
    "dat_07_dim_date": f"""SELECT {_GREGORIAN}, {_JALALI} FROM calendar
        UNION ALL SELECT 0, NULL, NULL, NULL, NULL, 'Unknown', NULL, 'Unknown', 'UNK', NULL, NULL, NULL, NULL, NULL, 'Unknown', '{UNKNOWN_FA}', NULL, 0,
        NULL, NULL, NULL, NULL, '{UNKNOWN_FA}', NULL, '{UNKNOWN_FA}', NULL, NULL, NULL""",
    "dat_08_new_year_days": f"""SELECT {day('d')} AS DateValue, {jalali_text('d')} AS PersianDate, list_extract({_list(DAYS_FA)}, CAST(isodow(d) AS INTEGER)) AS DayNameFA
        FROM calendar WHERE {_J['month']} = 1 AND {_J['day']} = 1""",
    "dat_09_missing_source_dates": "SELECT count(*) AS MissingSourceDates FROM source_days s LEFT JOIN calendar c ON c.d = s.d WHERE c.d IS NULL",
    "dat_10_profile": f"""SELECT count(*) + 1 AS "RowCount", {day('min(d)')} AS MinGregorianDate, {day('max(d)')} AS MaxGregorianDate,
        CAST(strftime(min(d), '%Y%m%d') AS BIGINT) AS MinDateKey, CAST(strftime(max(d), '%Y%m%d') AS BIGINT) AS MaxDateKey,
        min({jalali_text('d')}) AS MinPersianDate, max({jalali_text('d')}) AS MaxPersianDate, CAST(1 AS BIGINT) AS UnknownRows FROM calendar""",
    "dat_10_sample": f"""SELECT DateKey, DateValue, CalendarYear, MonthNameEN, DayNameEN, PersianDateKey, PersianDate, PersianYear, PersianMonthNameFA, DayNameFA, IsWeekend
        FROM (SELECT {_GREGORIAN}, {_JALALI} FROM calendar) ORDER BY DateValue LIMIT 20""",
}
