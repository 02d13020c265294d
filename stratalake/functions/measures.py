"""Exact arithmetic, time differences and calendar parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,4)"


def ratio(part: Column, whole: Column, scale: int, times: int = 1) -> Column:
    """``part / whole * times`` rounded half up in decimal arithmetic; NULL for a zero ``whole``."""
    top = part.cast("decimal(24,4)") * F.lit(times)
    return F.round(top / F.nullif(whole.cast("decimal(20,4)"), F.lit(0).cast("decimal(20,4)")), scale)


def mean(col: Column) -> Column:
    """Average of a decimal or integer column: exact sum, one division at the end."""
    return F.try_divide(F.sum(col).cast("double"), F.count(col).cast("double"))


def per(part: Column, whole: Column) -> Column:
    """Plain quotient in double precision, NULL when ``whole`` is zero."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def date_key(col: Column) -> Column:
    """``yyyymmdd`` as an integer."""
    return (F.year(col) * 10000 + F.month(col) * 100 + F.dayofmonth(col)).cast("int")


def _micros(col: Column) -> Column:
    return F.unix_micros(col.cast("timestamp"))


def whole_days(start: Column, end: Column) -> Column:
    """Completed 24-hour days from ``start`` to ``end`` (end not before start)."""
    return F.floor((_micros(end) - _micros(start)) / F.lit(86_400_000_000)).cast("bigint")


def minutes(start: Column, end: Column) -> Column:
    """Elapsed minutes with a fraction."""
    return (_micros(end) - _micros(start)).cast("double") / F.lit(6e7)


def is_weekend(col: Column) -> Column:
    return F.dayofweek(col).isin(1, 7)


def fiscal_year(col: Column, first_month: int = 4) -> Column:
    """Year in which the fiscal year containing ``col`` begins."""
    return F.year(F.add_months(col, 1 - first_month))


def fiscal_month(col: Column, first_month: int = 4) -> Column:
    return F.month(F.add_months(col, 1 - first_month))


def fiscal_quarter(col: Column, first_month: int = 4) -> Column:
    return F.quarter(F.add_months(col, 1 - first_month))
