"""Customer metrics from the rental fact.

Everything here is an aggregate per customer that combines before the shuffle; ranks and
tiles run over the aggregated customers in range chunks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratalake.functions.cleanse import at_least
from stratalake.functions.keys import surrogate_key
from stratalake.functions.measures import mean, per
from stratalake.operators.ordered import number_rows, rank_rows, tile
from stratalake.plans.dims import TIERS, tier
from stratalake.session import pin


def customer_metrics(fact: DataFrame, bounds: Sequence = TIERS, high_value: object = TIERS[1]) -> DataFrame:
    """Rentals, revenue, average, first and last rental, score, tier."""
    grouped = fact.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("total_rentals"),
        F.sum("revenue_amount").alias("total_revenue"),
        mean(F.col("revenue_amount")).alias("avg_rental_value"),
        F.min("rental_date").alias("first_rental_date"),
        F.max("rental_date").alias("last_rental_date"),
    )
    rentals, revenue = F.col("total_rentals"), F.col("total_revenue")
    return grouped.withColumns(
        {
            "gl_customer_metrics_key": surrogate_key("gl_customer_metrics", "customer_id"),
            "customer_lifetime_value": revenue,
            "avg_rentals_per_month": per(rentals, F.lit(12)),
            # Weights 0.3 and 0.7, as tenths of exact numbers.
            "customer_score": per(rentals * 3 + revenue * 7, F.lit(10)),
            "customer_tier": tier(revenue, bounds),
            "is_high_value": at_least(revenue, high_value),
        }
    )


def period_to_date(fact: DataFrame, as_of: Column) -> DataFrame:
    """Rentals and payments in total and in the month, quarter and year of ``as_of``."""
    day = F.to_date("rental_date")
    past = fact.where(day <= as_of)
    columns = [F.count(F.lit(1)).alias("rentals_to_date"), F.sum("revenue_amount").alias("total_payments")]
    zero = F.lit(0).cast("decimal(18,4)")
    for unit in ("month", "quarter", "year"):
        now = F.trunc(day, unit) == F.trunc(as_of, unit)
        columns.append(F.count_if(now).alias(f"rentals_current_{unit}"))
        columns.append(
            F.coalesce(F.sum(F.when(now, F.col("revenue_amount"))), zero).alias(f"payments_current_{unit}")
        )
    return past.groupBy("customer_id").agg(*columns)


def lifecycle(fact: DataFrame, as_of: Column, active_days: int = 90) -> DataFrame:
    """Age since the first rental, days since the last, and whether the customer is active."""
    seen = fact.groupBy("customer_id").agg(
        F.to_date(F.min("rental_date")).alias("_first"), F.to_date(F.max("rental_date")).alias("_last")
    )
    since = F.date_diff(as_of, F.col("_last"))
    return seen.select(
        "customer_id",
        F.date_diff(as_of, F.col("_first")).alias("customer_age_days"),
        since.alias("days_since_last_rental"),
        (since <= active_days).alias("is_active_customer"),
    )


def _gap() -> Column:
    """Mean days between consecutive rentals: the sum of all gaps is last minus first."""
    return per(F.date_diff(F.max(F.to_date("rental_date")), F.min(F.to_date("rental_date"))), F.count(F.lit(1)) - 1)


def return_behaviour(fact: DataFrame, as_of: Column, fee_per_day: int = 1) -> DataFrame:
    """Late returns, their rate, mean delay, open and currently overdue rentals, mean days between rentals."""
    due = F.date_add(F.to_date("rental_date"), F.col("rental_duration_planned"))
    late = F.col("is_overdue")
    delay = F.when(F.col("is_returned"), F.col("days_overdue"))
    return fact.groupBy("customer_id").agg(
        F.count_if(late).alias("total_late_returns"),
        per(F.count_if(late), F.count_if(F.col("is_returned"))).alias("late_return_rate"),
        per(F.sum(delay), F.count(delay)).alias("avg_return_delay_days"),
        F.count_if(~F.col("is_returned")).alias("open_rentals"),
        F.count_if(~F.col("is_returned") & (due < as_of)).alias("overdue_rentals_current"),
        (F.sum("days_overdue") * fee_per_day).alias("total_overdue_fees"),
        _gap().alias("avg_days_between_rentals"),
    )


def churn_rule(fact: DataFrame, as_of: Column) -> DataFrame:
    """Recency in units of the customer's own mean gap, capped at 1 after four gaps; NULL without a gap.

    The next rental is expected one mean gap after the last, in whole days from ``as_of`` and not before it.
    """
    seen = fact.groupBy("customer_id").agg(
        F.date_diff(as_of, F.to_date(F.max("rental_date"))).alias("days_since_last_rental"),
        _gap().alias("avg_days_between_rentals"),
    )
    gaps = per(F.col("days_since_last_rental"), F.col("avg_days_between_rentals"))
    left = F.ceil(F.col("avg_days_between_rentals") - F.col("days_since_last_rental"))
    return seen.withColumns(
        {
            "churn_risk_score": F.when(gaps.isNotNull(), F.least(gaps / 4, F.lit(1.0))),
            "next_rental_prediction_days": F.when(left.isNotNull(), F.greatest(left, F.lit(0))).cast("int"),
        }
    )


def value_rank(metrics: DataFrame, value: str = "total_revenue") -> DataFrame:
    """Rank, relative rank (0 best) and percentile (100 best) among all customers."""
    rows = metrics.select("customer_id", value, (-F.col(value)).alias("_sort"))
    ranked = rank_rows(pin(rows), "_sort", "customer_id", "customer_value_rank", total="_total")
    rank, total = F.col("customer_value_rank"), F.col("_total")
    return ranked.select(
        "customer_id",
        value,
        "customer_value_rank",
        F.coalesce(per(rank - 1, total - 1), F.lit(0.0)).alias("percent_rank"),
        F.ceil((total - rank + 1) * 100 / total).cast("int").alias("customer_value_percentile"),
    )


def rfm_segments(fact: DataFrame, as_of: Column, tiles: int = 5) -> DataFrame:
    """Recency, frequency and monetary scores (``tiles`` is best) and a segment name."""
    rows = pin(
        fact.groupBy("customer_id").agg(
            F.date_diff(as_of, F.to_date(F.max("rental_date"))).alias("recency_days"),
            F.count(F.lit(1)).alias("frequency"),
            F.sum("revenue_amount").alias("monetary"),
        )
    )
    rows = rows.withColumn("_fresh", -F.col("recency_days"))
    for source, score in (("_fresh", "r_score"), ("frequency", "f_score"), ("monetary", "m_score")):
        rows = number_rows(rows, [source, "customer_id"], "_position", total="_total")
        rows = rows.withColumn(score, tile(F.col("_position"), F.col("_total"), tiles)).drop("_position", "_total")
    r, f, m = F.col("r_score"), F.col("f_score"), F.col("m_score")
    segment = (
        F.when((r >= 4) & (f >= 4) & (m >= 4), "Champions")
        .when((f >= 4) & (r >= 3), "Loyal")
        .when((r >= 4) & (f <= 2), "New")
        .when((r <= 2) & (f >= 3), "At Risk")
        .when(r <= 2, "Hibernating")
        .otherwise("Regular")
    )
    return rows.drop("_fresh").withColumn("segment", segment)


def cohort_retention(fact: DataFrame) -> DataFrame:
    """Customers of each first-rental month who rented again after n months, and their share.

    A customer's months are gathered as a set (at most one per calendar month), which
    replaces the join back to the first month.
    """
    months = fact.groupBy("customer_id").agg(F.collect_set(F.trunc("rental_date", "month")).alias("_months"))
    visits = months.select(F.array_min("_months").alias("cohort_month"), F.explode("_months").alias("_month"))
    offset = F.round(F.months_between("_month", "cohort_month")).cast("int")
    counts = visits.groupBy("cohort_month", offset.alias("month_offset")).agg(F.count(F.lit(1)).alias("customers"))
    # A cohort has one row per month; its size is the row of month 0.
    cohort = Window.partitionBy("cohort_month")
    sized = counts.withColumn("cohort_size", F.max(F.when(F.col("month_offset") == 0, F.col("customers"))).over(cohort))
    return sized.withColumn("retention_rate", per(F.col("customers"), F.col("cohort_size")))


def behaviour_profile(visits: DataFrame) -> DataFrame:
    """Preferred day and hour, top genre, genre diversity and store loyalty per customer.

    ``visits`` holds ``customer_id``, ``rental_date``, ``store_id`` and ``genre``. Diversity is
    the entropy of the genre shares over its maximum, loyalty the largest store share. The
    four traits are counted together in one pass over the visits; ties go to the smallest value.
    """
    traits = {
        "day": F.date_format("rental_date", "EEEE"),
        "hour": F.date_format("rental_date", "HH"),
        "store": F.col("store_id").cast("string"),
        "genre": F.col("genre"),
    }
    pairs = F.array(*[F.struct(F.lit(kind).alias("kind"), value.alias("value")) for kind, value in traits.items()])
    counts = (
        visits.select("customer_id", F.inline(pairs))
        .where(F.col("value").isNotNull())
        .groupBy("customer_id", "kind", "value")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    place = F.struct((-F.col("_n")).alias("_n"), "value")

    def of(kind: str, value: Column) -> Column:
        return F.when(F.col("kind") == kind, value)

    def favourite(kind: str) -> Column:
        return F.min_by("value", of(kind, place))

    n = F.col("_n")
    total = F.sum(of("genre", n))
    entropy = F.log(total) - F.sum(of("genre", n * F.log(n))) / total
    diversity = F.coalesce(F.try_divide(entropy, F.log(F.count(of("genre", n)))), F.lit(0.0))
    return counts.groupBy("customer_id").agg(
        favourite("day").alias("preferred_rental_day"),
        favourite("hour").cast("int").alias("preferred_rental_hour"),
        per(F.max(of("store", n)), F.sum(of("store", n))).alias("store_loyalty_score"),
        favourite("genre").alias("most_rented_genre"),
        F.when(total.isNotNull(), F.round(diversity, 6)).alias("genre_diversity_score"),
    )


def tier_counts(metrics: DataFrame) -> DataFrame:
    """Customers and revenue per tier."""
    return metrics.groupBy("customer_tier").agg(
        F.count(F.lit(1)).alias("customers"), F.sum("total_revenue").alias("revenue")
    )


def top_customers(metrics: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` customers with the highest revenue."""
    return metrics.orderBy(F.desc("total_revenue"), "customer_id").limit(k)
