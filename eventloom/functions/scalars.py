"""Small scalar and aggregate expressions shared by the marts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

DAY_FORMAT = "yyyyMMdd"


def safe_ratio(part: Column, whole: Column, digits: int | None = None) -> Column:
    """``part / whole``, NULL when ``whole`` is 0, rounded half away from zero."""
    ratio = part / F.nullif(whole, F.lit(0))
    return ratio if digits is None else F.round(ratio, digits)


def smoothed_ratio(part: Column, whole: Column) -> Column:
    """``part / (whole + 1)``: defined for an empty denominator."""
    return part / (whole + F.lit(1))


def parse_day(day: Column) -> Column:
    """Date of ``yyyyMMdd`` text; malformed text is an error."""
    return F.to_date(day, DAY_FORMAT)


def try_parse_day(day: Column) -> Column:
    """Date of ``yyyyMMdd`` text; malformed text is NULL."""
    return F.try_to_date(day, DAY_FORMAT)


def month_of_day(day: Column) -> Column:
    """``yyyy-MM`` of ``yyyyMMdd`` text."""
    return F.date_format(parse_day(day), "yyyy-MM")


def weekday_of_day(day: Column) -> Column:
    """English weekday name of ``yyyyMMdd`` text."""
    return F.date_format(parse_day(day), "EEEE")


def dashed_day(day: Column) -> Column:
    """``yyyy-MM-dd`` of ``yyyyMMdd`` text."""
    return F.date_format(parse_day(day), "yyyy-MM-dd")


def count_event(name: str) -> Column:
    """Rows of one event name; 0 when there are none."""
    return F.count_if(F.col("event_name") == name)


def count_distinct_with_null(column: Column) -> Column:
    """Distinct values, NULL counted as one more value."""
    return F.count_distinct(column) + F.coalesce(
        F.max(column.isNull().cast("int")), F.lit(0)
    )


def key_text(key: Column, kind: T.DataType) -> Column:
    """Text of a key of any type; NULL stays NULL.

    A key read as a number keeps its digits: whole numbers have no fraction and no exponent,
    whatever their size, and decimals no trailing zeros. NaN is no key.
    """
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        number = key.cast("double")
        # Doubles of 2^53 and more are whole and fit a decimal exactly up to 38 digits.
        whole = F.when(F.abs(number) < 1e38, number.cast("decimal(38,0)"))
        digits = F.when(number == F.floor(number), whole.cast("string"))
        return F.when(~F.isnan(number), F.coalesce(digits, number.cast("string")))
    if isinstance(kind, T.DecimalType):
        plain = key.cast("string")
        short = F.regexp_replace(plain, r"0+$", "")
        return F.when(plain.contains("."), F.regexp_replace(short, r"\.$", "")).otherwise(plain)
    return key.cast("string")
