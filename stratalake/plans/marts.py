"""Business marts over facts and dimensions.

Payments are combined per rental before they meet rentals. The published definitions join
first and therefore count a rental once per payment; where a measure has that grain, it is
weighted by the number of payments, which gives the same figures without the wide join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratalake.functions.measures import mean, per, ratio, whole_days
from stratalake.operators.distinct import distinct_counts
from stratalake.operators.joins import denormalize


def _payments_per_rental(payments: DataFrame) -> DataFrame:
    return payments.groupBy("rental_id").agg(F.count(F.lit(1)).alias("_n"), F.sum("amount").alias("_amount"))


def monthly_revenue(payments: DataFrame, stores: DataFrame) -> DataFrame:
    """Revenue, transactions, average and distinct customers per store and month.

    The store attributes join after the aggregation, at one row per store and month.
    """
    per_customer = payments.groupBy("store_id", F.trunc("payment_date", "month").alias("revenue_month"), "customer_id").agg(
        F.sum("amount").alias("_amount"), F.count(F.lit(1)).alias("_n")
    )
    grouped = per_customer.groupBy("store_id", "revenue_month").agg(
        F.sum("_amount").alias("total_revenue"),
        F.sum("_n").alias("total_transactions"),
        per(F.sum("_amount"), F.sum("_n")).alias("avg_transaction_amount"),
        F.count("customer_id").alias("unique_customers"),
    )
    place = stores.select("store_id", F.concat_ws(", ", "address", "city").alias("store_location"))
    return grouped.join(place, "store_id")


def month_over_month(revenue: DataFrame) -> DataFrame:
    """Previous month and growth in percent per store; a store has one row per month."""
    line = Window.partitionBy("store_id").orderBy("revenue_month")
    rows = revenue.select("store_id", "revenue_month", "total_revenue", F.lag("total_revenue").over(line).alias("prev_month"))
    moved = F.col("total_revenue") - F.col("prev_month")
    return rows.withColumn("growth_pct", per(moved, F.col("prev_month")) * 100)


def revenue_year_to_date(revenue: DataFrame, as_of: Column) -> DataFrame:
    """Revenue per store since the start of the year of ``as_of``."""
    month = F.col("revenue_month")
    recent = revenue.where((month >= F.trunc(as_of, "year")) & (month <= as_of))
    return recent.groupBy("store_id", "store_location").agg(F.sum("total_revenue").alias("ytd_revenue"))


def top_titles(rentals: DataFrame, films: DataFrame, payments: DataFrame) -> DataFrame:
    """Film performance per month: rentals, revenue, days out, open rentals, use per copy."""
    paid = rentals.join(_payments_per_rental(payments), "rental_id")
    days = whole_days(F.col("rental_date"), F.col("return_date"))
    per_copy = paid.groupBy("film_id", F.trunc("rental_date", "month").alias("rental_month"), "inventory_id").agg(
        F.sum("_n").alias("_rentals"),
        F.sum("_amount").alias("_amount"),
        F.sum(days * F.col("_n")).alias("_days"),
        F.sum(F.when(days.isNotNull(), F.col("_n"))).alias("_closed"),
        F.sum(F.when(F.col("return_date").isNull(), F.col("_n")).otherwise(0)).alias("_open"),
    )
    grouped = per_copy.groupBy("film_id", "rental_month").agg(
        F.sum("_rentals").alias("total_rentals"),
        F.sum("_amount").alias("total_revenue"),
        per(F.sum("_amount"), F.sum("_rentals")).alias("avg_rental_revenue"),
        per(F.sum("_days"), F.sum("_closed")).alias("avg_days_out"),
        F.sum("_open").alias("currently_rented"),
        ratio(F.sum("_rentals"), F.count("inventory_id"), 2).alias("utilization_rate"),
    )
    return grouped.join(films.select("film_id", "title", "rating", "rental_rate"), "film_id")


def top_titles_of_quarter(titles: DataFrame, as_of: Column, k: int = 10) -> DataFrame:
    """The ``k`` most rented films since the start of the quarter of ``as_of``."""
    start = F.trunc(as_of, "quarter")
    recent = titles.where((F.col("rental_month") >= start) & (F.col("rental_month") <= as_of))
    totals = recent.groupBy("film_id", "title").agg(F.sum("total_rentals").alias("quarterly_rentals"))
    return totals.orderBy(F.desc("quarterly_rentals"), "film_id").limit(k)


def titles_by_rating(titles: DataFrame) -> DataFrame:
    """Averages of the monthly film figures per rating."""
    return titles.groupBy("rating").agg(
        F.round(F.avg("avg_rental_revenue"), 4).alias("avg_revenue_per_rental"),
        F.round(F.avg("avg_days_out"), 6).alias("avg_rental_duration"),
        F.sum("total_rentals").alias("total_rentals"),
    )


def store_scorecard(rentals: DataFrame, stores: DataFrame, films: DataFrame, payments: DataFrame) -> DataFrame:
    """Daily store figures: revenue, rentals, customers, late returns, titles and mean rate."""
    wide = denormalize(
        rentals, [(films, {"film_id": "film_id"}, {"_rate": "rental_rate", "_allowed": "rental_duration"})]
    ).where(F.col("_allowed").isNotNull())
    wide = wide.join(_payments_per_rental(payments), "rental_id", "left").withColumn("_w", F.coalesce("_n", F.lit(1)))
    out, back = F.to_date("rental_date"), F.to_date("return_date")
    weight = F.col("_w")
    late = back > F.date_add(out, F.col("_allowed"))
    keys = ["store_id", "business_date"]
    # First one row per store, day, customer and copy; the sums and both distinct counts go over these.
    small = wide.withColumn("business_date", out).groupBy(*keys, "customer_id", "inventory_id").agg(
        F.sum("_amount").alias("_amount"),
        F.count(F.lit(1)).alias("_rentals"),
        F.sum(F.when(late, weight).otherwise(0)).alias("_late"),
        F.sum(F.when(back.isNotNull(), weight).otherwise(0)).alias("_back"),
        F.sum(F.col("_rate") * weight).alias("_rates"),
        F.sum(weight).alias("_weights"),
    )
    daily = small.groupBy(*keys).agg(
        F.coalesce(F.sum("_amount"), F.lit(0)).cast("decimal(18,4)").alias("daily_revenue"),
        F.sum("_rentals").alias("total_rentals"),
        F.sum("_late").alias("late_returns"),
        F.sum("_back").alias("completed_rentals"),
        ratio(F.sum("_rates"), F.sum("_weights"), 2).alias("avg_rental_rate"),
    )
    counted = distinct_counts(small, keys, {"active_customers": "customer_id", "unique_titles_rented": "inventory_id"})
    daily = daily.join(counted, keys)
    place = stores.select("store_id", F.concat_ws(", ", "address", "city").alias("store_location"))
    return grouped.join(place, "store_id")


def month_over_month(revenue: DataFrame) -> DataFrame:
    """Previous month and growth in percent per store; a store has one row per month."""
    line = Window.partitionBy("store_id").orderBy("revenue_month")
    rows = revenue.select("store_id", "revenue_month", "total_revenue", F.lag("total_revenue").over(line).alias("prev_month"))
    moved = F.col("total_revenue") - F.col("prev_month")
    return rows.withColumn("growth_pct", per(moved, F.col("prev_month")) * 100)


def revenue_year_to_date(revenue: DataFrame, as_of: Column) -> DataFrame:
    """Revenue per store since the start of the year of ``as_of``."""
    month = F.col("revenue_month")
    recent = revenue.where((month >= F.trunc(as_of, "year")) & (month <= as_of))
    return recent.groupBy("store_id", "store_location").agg(F.sum("total_revenue").alias("ytd_revenue"))


def top_titles(rentals: DataFrame, films: DataFrame, payments: DataFrame) -> DataFrame:
    """Film performance per month: rentals, revenue, days out, open rentals, use per copy."""
    paid = rentals.join(_payments_per_rental(payments), "rental_id")
    days = whole_days(F.col("rental_date"), F.col("return_date"))
    per_copy = paid.groupBy("film_id", F.trunc("rental_date", "month").alias("rental_month"), "inventory_id").agg(
        F.sum("_n").alias("_rentals"),
        F.sum("_amount").alias("_amount"),
        F.sum(days * F.col("_n")).alias("_days"),
        F.sum(F.when(days.isNotNull(), F.col("_n"))).alias("_closed"),
        F.sum(F.when(F.col("return_date").isNull(), F.col("_n")).otherwise(0)).alias("_open"),
    )
    grouped = per_copy.groupBy("film_id", "rental_month").agg(
        F.sum("_rentals").alias("total_rentals"),
        F.sum("_amount").alias("total_revenue"),
        per(F.sum("_amount"), F.sum("_rentals")).alias("avg_rental_revenue"),
        per(F.sum("_days"), F.sum("_closed")).alias("avg_days_out"),
        F.sum("_open").alias("currently_rented"),
        ratio(F.sum("_rentals"), F.count("inventory_id"), 2).alias("utilization_rate"),
    )
    return grouped.join(films.select("film_id", "title", "rating", "rental_rate"), "film_id")


def top_titles_of_quarter(titles: DataFrame, as_of: Column, k: int = 10) -> DataFrame:
    """The ``k`` most rented films since the start of the quarter of ``as_of``."""
    start = F.trunc(as_of, "quarter")
    recent = titles.where((F.col("rental_month") >= start) & (F.col("rental_month") <= as_of))
    totals = recent.groupBy("film_id", "title").agg(F.sum("total_rentals").alias("quarterly_rentals"))
    return totals.orderBy(F.desc("quarterly_rentals"), "film_id").limit(k)


def titles_by_rating(titles: DataFrame) -> DataFrame:
    """Averages of the monthly film figures per rating."""
    return titles.groupBy("rating").agg(
        F.round(F.avg("avg_rental_revenue"), 4).alias("avg_revenue_per_rental"),
        F.round(F.avg("avg_days_out"), 6).alias("avg_rental_duration"),
        F.sum("total_rentals").alias("total_rentals"),
    )


def store_scorecard(rentals: DataFrame, stores: DataFrame, films: DataFrame, payments: DataFrame) -> DataFrame:
    """Daily store figures: revenue, rentals, customers, late returns, titles and mean rate."""
    wide = denormalize(
        rentals, [(films, {"film_id": "film_id"}, {"_rate": "rental_rate", "_allowed": "rental_duration"})]
    ).where(F.col("_allowed").isNotNull())
    wide = wide.join(_payments_per_rental(payments), "rental_id", "left").withColumn("_w", F.coalesce("_n", F.lit(1)))
    out, back = F.to_date("rental_date"), F.to_date("return_date")
    weight = F.col("_w")
    late = back > F.date_add(out, F.col("_allowed"))
    keys = ["store_id", out.alias("business_date")]
    daily = wide.groupBy(*keys).agg(
        F.coalesce(F.sum("_amount"), F.lit(0)).cast("decimal(18,4)").alias("daily_revenue"),
        F.count(F.lit(1)).alias("total_rentals"),
        F.count_distinct("customer_id").alias("active_customers"),
        F.sum(F.when(late, weight).otherwise(0)).alias("late_returns"),
        F.sum(F.when(back.isNotNull(), weight).otherwise(0)).alias("completed_rentals"),
        F.count_distinct("inventory_id").alias("unique_titles_rented"),
        ratio(F.sum(F.col("_rate") * weight), F.sum(weight), 2).alias("avg_rental_rate"),
    )
    place = stores.select("store_id", F.concat_ws(", ", "address", "city").alias("store_location"), "manager_name")
    return daily.withColumn(
        "late_return_pct", ratio(F.col("late_returns"), F.col("completed_rentals"), 2, times=100)
    ).join(place, "store_id")


def scorecard_by_store(scorecard: DataFrame, as_of: Column, days: int = 30) -> DataFrame:
    """Mean daily figures per store over the last ``days``."""
    recent = _last_days(scorecard, as_of, days)
    return recent.groupBy("store_id", "store_location").agg(
        mean(F.col("daily_revenue")).alias("avg_daily_revenue"),
        mean(F.col("active_customers")).alias("avg_daily_customers"),
        mean(F.col("late_return_pct")).alias("avg_late_return_pct"),
    )


def scorecard_by_day(scorecard: DataFrame, as_of: Column, days: int = 90) -> DataFrame:
    """Chain totals per day over the last ``days``."""
    recent = _last_days(scorecard, as_of, days)
    return recent.groupBy("business_date").agg(
        F.sum("daily_revenue").alias("chain_revenue"),
        F.sum("active_customers").alias("chain_customers"),
        mean(F.col("late_return_pct")).alias("chain_late_return_pct"),
    )


def _last_days(scorecard: DataFrame, as_of: Column, days: int) -> DataFrame:
    day = F.col("business_date")
    return scorecard.where((day >= F.date_sub(as_of, days)) & (day <= as_of))
