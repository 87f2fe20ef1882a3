"""Column expressions used by several products."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_start(date: Column | str) -> Column:
    return F.trunc(date, "month")


def hours_of_month(date: Column | str) -> Column:
    return (F.dayofmonth(F.last_day(date)) * 24).cast("bigint")


def month_number(year: Column | str, month: Column | str) -> Column:
    """2024, 3 -> 202403."""
    year = F.col(year) if isinstance(year, str) else year
    month = F.col(month) if isinstance(month, str) else month
    return (year * 100 + month).cast("bigint")


def squeezed(text: Column | str) -> Column:
    """Upper case without any blanks."""
    return F.upper(F.replace(F.col(text) if isinstance(text, str) else text, F.lit(" "), F.lit("")))


def tidy(text: Column | str) -> Column:
    """Upper case without outer blanks."""
    return F.upper(F.trim(text))


def non_blank(text: Column | str) -> Column:
    """Null instead of an empty or blank text."""
    text = F.col(text) if isinstance(text, str) else text
    return F.when(F.trim(text) != "", text)


def truncated(value: Column, digits: int) -> Column:
    """Cut off, not rounded, after ``digits`` decimals."""
    scale = 10**digits
    return (value * scale).cast("bigint") / scale


def batch_number(date: Column | str, last: int) -> Column:
    """Day of the month as replay batch; days after ``last`` join the final batch."""
    day = F.dayofmonth(date).cast("bigint")
    return F.when(day > last, F.lit(last).cast("bigint")).otherwise(day)


def packed_rate(tag: Column | str, high: int = 5, low: int = 4) -> Column:
    """Difference of two numbers packed into a comma-separated tag."""
    part = lambda n: F.split_part(tag, F.lit(","), F.lit(n)).try_cast("double")
    return part(high) - part(low)
