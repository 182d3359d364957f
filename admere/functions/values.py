"""Dates, money and ratios."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from admere.functions.clean import RATIO, col

DEFAULT_ZONE = "Africa/Johannesburg"


def local_date(at: Column | str, zone: str = DEFAULT_ZONE) -> Column:
    """Reporting date of a UTC instant in ``zone``."""
    return F.to_date(F.from_utc_timestamp(col(at), zone))


def micros_to_timestamp(c: Column | str) -> Column:
    return F.timestamp_micros(col(c))


def compact_date(c: Column | str) -> Column:
    """``yyyyMMdd`` text to a date; NULL when unreadable."""
    text = col(c).cast("string")
    return F.try_to_timestamp(text, F.lit("yyyyMMdd")).cast("date")


def micros_to_money(c: Column | str) -> Column:
    """Money in millionths to units, six decimals kept."""
    return (col(c).cast("decimal(20,0)") / F.lit(1_000_000).cast("decimal(7,0)")).cast("decimal(26,6)")


def convert(amount: Column | str, rate: Column | str) -> Column:
    return (col(amount).cast("decimal(18,6)") * col(rate).cast("decimal(18,6)")).cast("decimal(29,9)")


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Division to nine decimals; NULL on a zero or missing side."""
    return F.try_divide(col(numerator).cast(RATIO), col(denominator).cast(RATIO))


def date_key(d: Column | str) -> Column:
    return F.date_format(col(d), "yyyyMMdd").cast("int")


def week_start(d: Column | str) -> Column:
    """Monday of the week."""
    return F.trunc(col(d), "WEEK")


def greatest_or_null(*cols: Column | str) -> Column:
    """Largest value, NULL if any is NULL (Spark's own ``greatest`` skips NULLs)."""
    some_null = col(cols[0]).isNull()
    for c in cols[1:]:
        some_null = some_null | col(c).isNull()
    return F.when(~some_null, F.greatest(*[col(c) for c in cols]))


def when_amount(condition: Column, amount: Column | str) -> Column:
    """``amount`` where the condition holds, else zero."""
    return F.when(condition, col(amount)).otherwise(F.lit(0))


def within(d: Column | str, start: Column | str, first_day: int, last_day: int) -> Column:
    """Date ``d`` lies ``first_day`` to ``last_day`` days after ``start``, both ends in."""
    return col(d).between(F.date_add(col(start), first_day), F.date_add(col(start), last_day))


def calendar_columns(d: Column | str) -> dict[str, Column]:
    """Attributes of a calendar day, in the order of the date dimension."""
    d = col(d)
    return {
        "date_key": date_key(d),
        "calendar_year": F.year(d),
        "calendar_quarter": F.quarter(d),
        "calendar_month": F.month(d),
        "month_name": F.date_format(d, "MMMM"),
        "iso_week": F.weekofyear(d),
        "week_start_date": week_start(d),
        "month_start_date": F.trunc(d, "MONTH"),
        "day_of_month": F.day(d),
        "day_name": F.date_format(d, "EEEE"),
        "is_weekend": F.dayofweek(d).isin(1, 7),
    }
