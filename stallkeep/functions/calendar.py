"""Date keys, Gregorian attributes and the Jalali calendar as Column expressions."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Calendar names.
MONTHS_EN = (
    "January", "February", "March", "April", "May", "June",
    "July", "August", "September", "October", "November", "December",
)
MONTHS_SHORT_EN = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")
DAYS_EN = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")
DAYS_FA = ("دوشنبه", "سه‌شنبه", "چهارشنبه", "پنجشنبه", "جمعه", "شنبه", "یکشنبه")
MONTHS_FA = (
    "فروردین", "اردیبهشت", "خرداد", "تیر", "مرداد", "شهریور",
    "مهر", "آبان", "آذر", "دی", "بهمن", "اسفند",
)
SEASON_FA = "فصل "
UNKNOWN_FA = "نامشخص"

# 1 Farvardin 979 and the lengths of the leap cycles in days.
JALALI_ORIGIN = "1600-03-20"
JALALI_ORIGIN_YEAR = 979
DAYS_IN_33_YEARS = 12053
DAYS_IN_4_YEARS = 1461
DAYS_IN_FIRST_HALF = 186


def _column(name: Column | str) -> Column:
    return F.col(name) if isinstance(name, str) else name


def _whole(number: Column, divisor: int) -> Column:
    return F.floor(number / F.lit(divisor)).cast("int")


def _name(names: tuple[str, ...], position: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, names)), position)


def date_key(moment: Column | str, null_as_unknown: bool = False) -> Column:
    """yyyymmdd as an integer; with ``null_as_unknown`` a missing date becomes key 0."""
    day = _column(moment).cast("date")
    key = F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)
    return F.coalesce(key, F.lit(0)) if null_as_unknown else key


def iso_weekday(day: Column | str) -> Column:
    """Monday = 1 … Sunday = 7."""
    return F.weekday(_column(day)) + 1


class JalaliParts(NamedTuple):
    year: Column
    month: Column
    day: Column


def jalali_parts(day: Column | str) -> JalaliParts:
    """Year, month and day of the Jalali calendar for dates after 1600-03-20.

    The calendar repeats every 33 years. Within a cycle every fourth year is
    long and comes first in its group of four; the first six months have 31
    days each.
    """
    elapsed = F.datediff(_column(day).cast("date"), F.lit(JALALI_ORIGIN).cast("date"))
    in_cycle = elapsed % DAYS_IN_33_YEARS
    in_group = in_cycle % DAYS_IN_4_YEARS
    group_year = F.when(in_group > 365, _whole(in_group - 1, 365)).otherwise(0)
    day_of_year = F.when(in_group > 365, (in_group - 1) % 365).otherwise(in_group)
    late = day_of_year - DAYS_IN_FIRST_HALF
    first_half = late < 0
    year = (
        _whole(elapsed, DAYS_IN_33_YEARS) * 33
        + _whole(in_cycle, DAYS_IN_4_YEARS) * 4
        + group_year
        + JALALI_ORIGIN_YEAR
    )
    month = F.when(first_half, _whole(day_of_year, 31) + 1).otherwise(_whole(late, 30) + 7)
    day_of_month = F.when(first_half, day_of_year % 31 + 1).otherwise(late % 30 + 1)
    present = elapsed.isNotNull()
    return JalaliParts(
        F.when(present, year).cast("int"),
        F.when(present, month).cast("int"),
        F.when(present, day_of_month).cast("int"),
    )


def _padded(number: Column, width: int) -> Column:
    return F.lpad(number.cast("string"), width, "0")


def jalali_date(day: Column | str) -> Column:
    """``yyyy/mm/dd`` in the Jalali calendar; NULL stays NULL."""
    parts = jalali_parts(day)
    return F.concat(
        _padded(parts.year, 4), F.lit("/"), _padded(parts.month, 2), F.lit("/"), _padded(parts.day, 2)
    )


def with_gregorian_attributes(days: DataFrame, day: str = "DateValue") -> DataFrame:
    """Add the Gregorian columns of the date dimension."""
    date = F.col(day)
    weekday = iso_weekday(date)
    return days.select(
        date_key(date).alias("DateKey"),
        date.alias("DateValue"),
        F.date_format(date, "yyyy-MM-dd").alias("DateLabelEN"),
        F.year(date).alias("CalendarYear"),
        F.quarter(date).alias("CalendarQuarter"),
        F.concat(F.lit("Q"), F.quarter(date)).alias("QuarterLabelEN"),
        F.month(date).alias("MonthNumber"),
        _name(MONTHS_EN, F.month(date)).alias("MonthNameEN"),
        _name(MONTHS_SHORT_EN, F.month(date)).alias("MonthShortNameEN"),
        (F.year(date) * 100 + F.month(date)).alias("YearMonthKey"),
        F.date_format(date, "yyyy-MM").alias("YearMonthLabel"),
        F.dayofmonth(date).alias("DayOfMonth"),
        F.dayofyear(date).alias("DayOfYear"),
        weekday.alias("DayOfWeekNumber"),
        _name(DAYS_EN, weekday).alias("DayNameEN"),
        _name(DAYS_FA, weekday).alias("DayNameFA"),
        F.weekofyear(date).alias("ISOWeekNumber"),
        F.when(weekday >= 6, 1).otherwise(0).alias("IsWeekend"),
    )


def with_jalali_attributes(days: DataFrame, day: str = "DateValue") -> DataFrame:
    """Add the Jalali columns of the date dimension."""
    parts = jalali_parts(day)
    split = days.withColumns({"_jy": parts.year, "_jm": parts.month, "_jd": parts.day})
    year, month, date = F.col("_jy"), F.col("_jm"), F.col("_jd")
    quarter = (_whole(month - 1, 3) + 1).cast("int")
    return split.withColumns(
        {
            "PersianDateKey": year * 10000 + month * 100 + date,
            "PersianDate": F.concat_ws("/", _padded(year, 4), _padded(month, 2), _padded(date, 2)),
            "PersianYear": year,
            "PersianQuarter": quarter,
            "PersianQuarterLabelFA": F.concat(F.lit(SEASON_FA), quarter),
            "PersianMonthNumber": month,
            "PersianMonthNameFA": _name(MONTHS_FA, month),
            "PersianYearMonthKey": year * 100 + month,
            "PersianYearMonthLabel": F.concat_ws("/", year.cast("string"), _padded(month, 2)),
            "PersianDayOfMonth": date,
        }
    ).drop("_jy", "_jm", "_jd")
