"""The bilingual date dimension."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stallkeep.functions import date_key, jalali_date, matches, with_gregorian_attributes, with_jalali_attributes
from stallkeep.functions.calendar import UNKNOWN_FA
from stallkeep.operators.keys import with_unknown_member

# The source columns that dates of the facts come from.
ORDER_DATES = (
    "order_purchase_timestamp",
    "order_approved_at",
    "order_delivered_carrier_date",
    "order_delivered_customer_date",
    "order_estimated_delivery_date",
)
ITEM_DATES = ("shipping_limit_date",)
REVIEW_DATES = ("review_creation_date", "review_answer_timestamp")

# Known conversions of the first day of five Jalali years.
NOWRUZ_DATES = (
    ("2016-03-20", "1395/01/01"),
    ("2017-03-21", "1396/01/01"),
    ("2018-03-21", "1397/01/01"),
    ("2019-03-21", "1398/01/01"),
    ("2020-03-20", "1399/01/01"),
)

UNKNOWN_DATE = {
    "DateKey": 0,
    "QuarterLabelEN": "Unknown",
    "MonthNameEN": "Unknown",
    "MonthShortNameEN": "UNK",
    "DayNameEN": "Unknown",
    "DayNameFA": UNKNOWN_FA,
    "IsWeekend": 0,
    "PersianQuarterLabelFA": UNKNOWN_FA,
    "PersianMonthNameFA": UNKNOWN_FA,
}


class EmptySourceError(ValueError):
    code = 50001


def _sources(orders: DataFrame, items: DataFrame, reviews: DataFrame):
    return ((orders, ORDER_DATES), (items, ITEM_DATES), (reviews, REVIEW_DATES))


def source_dates(orders: DataFrame, items: DataFrame, reviews: DataFrame) -> DataFrame:
    """The distinct days of every source date column (at most one row per day)."""
    days = [
        table.select(F.explode(F.array(*[F.col(c).cast("date") for c in columns])).alias("DateValue")).distinct()
        for table, columns in _sources(orders, items, reviews)
    ]
    return reduce(DataFrame.union, days).filter(F.col("DateValue").isNotNull()).distinct()


def source_date_range(orders: DataFrame, items: DataFrame, reviews: DataFrame) -> DataFrame:
    """Earliest and latest source day: one pass per table, one row per table to combine."""
    ranges = []
    for table, columns in _sources(orders, items, reviews):
        bounds = table.agg(
            *[F.min(F.col(c).cast("date")).alias(f"lo_{c}") for c in columns],
            *[F.max(F.col(c).cast("date")).alias(f"hi_{c}") for c in columns],
        )
        lows = [F.col(f"lo_{c}") for c in columns]
        highs = [F.col(f"hi_{c}") for c in columns]
        ranges.append(
            bounds.select(
                (F.least(*lows) if len(lows) > 1 else lows[0]).alias("lo"),
                (F.greatest(*highs) if len(highs) > 1 else highs[0]).alias("hi"),
            )
        )
    return reduce(DataFrame.union, ranges).agg(F.min("lo").alias("MinSourceDate"), F.max("hi").alias("MaxSourceDate"))


def require_dates(date_range: DataFrame) -> DataFrame:
    """The one-row range itself; raises if the sources hold no date at all."""
    if date_range.filter(F.col("MinSourceDate").isNotNull() & F.col("MaxSourceDate").isNotNull()).isEmpty():
        raise EmptySourceError("cannot build the date dimension: no source dates were found")
    return date_range


def calendar_days(date_range: DataFrame) -> DataFrame:
    """One row per day of the whole calendar years the range touches."""
    first = F.make_date(F.year("MinSourceDate"), F.lit(1), F.lit(1))
    last = F.make_date(F.year("MaxSourceDate"), F.lit(12), F.lit(31))
    return date_range.select(F.explode(F.sequence(first, last)).alias("DateValue"))


def dim_date(date_range: DataFrame) -> DataFrame:
    """Calendar plus the Unknown member, key 0."""
    days = with_jalali_attributes(with_gregorian_attributes(calendar_days(date_range)))
    return with_unknown_member(days, UNKNOWN_DATE)


def known_conversions(spark: SparkSession) -> DataFrame:
    """The five Nowruz dates against the conversion, PASS or FAIL each."""
    tests = spark.createDataFrame(NOWRUZ_DATES, "GregorianDate string, ExpectedPersianDate string")
    actual = jalali_date(F.col("GregorianDate").cast("date"))
    return (
        tests.withColumn("ActualPersianDate", actual)
        .withColumn(
            "ValidationStatus",
            F.when(F.col("ActualPersianDate") == F.col("ExpectedPersianDate"), "PASS").otherwise("FAIL"),
        )
        .orderBy("GregorianDate")
    )


def missing_source_dates(days: DataFrame, dates: DataFrame) -> DataFrame:
    """Source days the date dimension lacks."""
    return days.withColumn("DateKey", date_key("DateValue")).join(dates.select("DateKey"), "DateKey", "left_anti")


def date_profile(dates: DataFrame) -> DataFrame:
    return dates.agg(
        F.count("*").alias("RowCount"),
        F.min("DateValue").alias("MinGregorianDate"),
        F.max("DateValue").alias("MaxGregorianDate"),
        F.min(F.when(F.col("DateKey") != 0, F.col("DateKey"))).alias("MinDateKey"),
        F.max("DateKey").alias("MaxDateKey"),
        F.min("PersianDate").alias("MinPersianDate"),
        F.max("PersianDate").alias("MaxPersianDate"),
        matches(F.col("DateKey") == 0).alias("UnknownRows"),
    )


def date_sample(dates: DataFrame, rows: int = 20) -> DataFrame:
    """The first days of the calendar."""
    columns = (
        "DateKey", "DateValue", "CalendarYear", "MonthNameEN", "DayNameEN", "PersianDateKey",
        "PersianDate", "PersianYear", "PersianMonthNameFA", "DayNameFA", "IsWeekend",
    )
    return dates.filter("DateKey <> 0").orderBy("DateValue").limit(rows).select(*columns)
