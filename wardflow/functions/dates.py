"""Month arithmetic on dates."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def month_of(d) -> Column:
    return F.trunc(_col(d), "MM")


def month_of_period(p) -> Column:
    """First day of a ``yyyyMM`` month."""
    return F.try_to_date(F.concat(_col(p), F.lit("01")), "yyyyMMdd")


def period_of(d) -> Column:
    """``yyyyMM``; by numbers where the year has up to four digits, as a formatter costs several times as much per row."""
    year, month = F.year(_col(d)), F.month(_col(d))
    plain = F.lpad((year * 100 + month).cast("string"), 6, "0")
    return F.when(year.between(1, 9999), plain).otherwise(F.date_format(_col(d), "yyyyMM"))


def stay_days(admit, discharge, billed, reported) -> Column:
    """Days a stay occupies a bed: by dates, else billed, else reported, and at least one."""
    return F.greatest(
        F.coalesce(F.datediff(_col(discharge), _col(admit)), _col(billed), _col(reported), F.lit(1)),
        F.lit(1),
    ).cast("int")
