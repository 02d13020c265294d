"""Rental fact at one row per rental, or at one row per payment."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.functions.keys import surrogate_key
from stratalake.functions.measures import MONEY, date_key, is_weekend
from stratalake.operators.joins import denormalize, left_join_detail
from stratalake.plans.dims import UNKNOWN_DATE_KEY

# Defaults of an unpaid rental.
DEFAULT_AMOUNT = Decimal("2.99")
DEFAULT_REPLACEMENT = Decimal("19.99")
PLANNED_DAYS = 3


def paid_rentals(rentals: DataFrame, payments: DataFrame, default: Decimal = DEFAULT_AMOUNT) -> DataFrame:
    """One row per rental with the sum of its payments, or the default amount without any.

    Payments are reduced per rental before the join, so their rows never fan out.
    """
    paid = payments.groupBy("rental_id").agg(
        F.sum("amount").alias("_amount"),
        F.min("payment_date").alias("_paid"),
        F.count(F.lit(1)).alias("_payments"),
    )
    joined = rentals.join(paid, "rental_id", "left")
    return joined.withColumns(
        {
            "amount": F.coalesce(F.col("_amount"), F.lit(default)).cast(MONEY),
            "payment_date": F.coalesce("_paid", "rental_date"),
            "payment_count": F.coalesce("_payments", F.lit(0)),
        }
    ).drop("_amount", "_paid", "_payments")


def rental_payments(rentals: DataFrame, payments: DataFrame, default: Decimal = DEFAULT_AMOUNT) -> DataFrame:
    """One row per payment, and one with the default amount per rental without any."""
    detail = payments.select("rental_id", "amount", "payment_date")
    return left_join_detail(
        rentals,
        detail,
        "rental_id",
        {
            "amount": F.coalesce(F.col("_d_amount"), F.lit(default)).cast(MONEY),
            "payment_date": F.coalesce("_d_payment_date", "rental_date"),
        },
    )


def _key_or_unknown(day: Column) -> Column:
    return F.coalesce(date_key(day), F.lit(UNKNOWN_DATE_KEY))


def rental_measures(rows: DataFrame, planned_days: int = PLANNED_DAYS, replacement: Decimal = DEFAULT_REPLACEMENT) -> DataFrame:
    """Durations, overdue and return flags, time parts, date keys and, with an amount, revenue."""
    amount = {"rental_rate": F.col("amount"), "revenue_amount": F.col("amount")} if "amount" in rows.columns else {}
    out, back = F.to_date("rental_date"), F.to_date("return_date")
    spent = F.date_diff(back, out)
    late = F.greatest(F.coalesce(spent, F.lit(0)) - planned_days, F.lit(0))
    return rows.withColumns(
        {
            "rental_date_only": out,
            "return_date_only": back,
            "rental_date_key": _key_or_unknown(out),
            "return_date_key": _key_or_unknown(back),
            "rental_hour": F.hour("rental_date"),
            "rental_month": F.month(out),
            "rental_quarter": F.quarter(out),
            "rental_year": F.year(out),
            "rental_duration_actual": spent,
            "rental_duration_planned": F.lit(planned_days),
            "is_returned": back.isNotNull(),
            "is_overdue": late > 0,
            "days_overdue": late,
            **amount,
            "replacement_cost": F.lit(replacement).cast(MONEY),
            "is_weekend_rental": is_weekend(out),
            "is_holiday_rental": F.lit(False),
        }
    )


def rental_fact(rentals: DataFrame, payments: DataFrame, per_payment: bool = False) -> DataFrame:
    """The rental fact; ``per_payment`` keeps one row per payment instead of one per rental."""
    rows = rental_payments(rentals, payments) if per_payment else paid_rentals(rentals, payments)
    return with_measures(rows)


def with_measures(rows: DataFrame) -> DataFrame:
    """What the fact adds to paid rentals: measures and its key."""
    return rental_measures(rows).withColumn("gl_fact_rental_key", surrogate_key("gl_fact_rental", "rental_id"))


def role_playing_dates(fact: DataFrame, dates: DataFrame, take: dict[str, str]) -> DataFrame:
    """Attach date attributes once for the rental day and once for the return day.

    ``take`` maps an attribute of the calendar to its name; the role is put in front.
    """
    return denormalize(
        fact,
        [
            (dates, {f"{role}_date_key": "date_key"}, {f"{role}_{name}": src for src, name in take.items()})
            for role in ("rental", "return")
        ],
    )
