"""Month calendars."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wardflow.functions.dates import month_of, period_of


def months_between(first, last) -> Column:
    """Array of first-of-month dates from the month of ``first`` to the month of ``last``."""
    return F.sequence(month_of(first), month_of(last), F.expr("interval 1 month"))


def with_calendar(df: DataFrame, month: str = "month_start") -> DataFrame:
    """Add end, label, period and length of a month given by its first day."""
    return df.withColumns(
        {
            "month_end": F.last_day(month),
            "month_label": F.date_format(month, "MM/yyyy"),
            "period": period_of(month),
            "days_in_month": F.dayofmonth(F.last_day(month)),
        }
    )


def month_calendar(spark: SparkSession, start: date, end: date) -> DataFrame:
    """One row per month that starts between the month of ``start`` and ``end``."""
    months = spark.range(1).select(F.explode(months_between(F.lit(start), F.lit(end))).alias("month_start"))
    return with_calendar(months)


def span_calendar(df: DataFrame, day: str) -> DataFrame:
    """Calendar over every month from the earliest to the latest date found in a table."""
    span = df.agg(F.min(day).alias("first"), F.max(day).alias("last"))
    return with_calendar(span.select(F.explode(months_between("first", "last")).alias("month_start")))


def expected_periods(spark: SparkSession, first: tuple[int, int], last: tuple[int, int]) -> DataFrame:
    """The ``yyyyMM`` months from (year, month) to (year, month), both included."""
    for _, month in (first, last):
        if not 1 <= month <= 12:
            raise ValueError(f"month {month} is not between 1 and 12")
    if first > last:
        raise ValueError(f"first period {first} comes after last period {last}")
    return month_calendar(spark, date(*first, 1), date(*last, 1)).select("period", "month_start")


def period_years(df: DataFrame, period: str = "period") -> DataFrame:
    """Distinct years of the periods, in order."""
    return df.select(F.substring(period, 1, 4).cast("int").alias("year")).distinct().orderBy("year")
