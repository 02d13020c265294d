"""Gold dimensions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.functions.cleanse import at_least, bucket, list_items, recode
from stratalake.functions.keys import surrogate_key
from stratalake.functions.measures import (
    date_key,
    fiscal_month,
    fiscal_quarter,
    fiscal_year,
    is_weekend,
    mean,
    per,
)
from stratalake.operators.joins import denormalize, join_aggregate
from stratalake.operators.ordered import number_rows, tile

# Key of the unknown date and default bounds of the calendar.
UNKNOWN_DATE_KEY = 19000101
CALENDAR = ("2000-01-01", "2030-12-31")

# Spend tiers, revenue tiers, rating groups and feature length.
TIERS = (100, 50, 20)
TIER_NAMES = ("Platinum", "Gold", "Silver", "Bronze")
REVENUE_TIERS = [(">=", 25, "Premium"), (">=", 15, "Standard")]
RATING_GROUPS = {"G": "Family", "PG": "Family", "PG-13": "Teen", "R": "Adult"}
FEATURE_LENGTH = 90


def tier(amount: Column, bounds: Sequence = TIERS) -> Column:
    """Customer tier by spend."""
    return bucket(amount, [(">=", b, n) for b, n in zip(bounds, TIER_NAMES)], TIER_NAMES[-1])


def _days(bounds: DataFrame) -> DataFrame:
    return bounds.select(F.explode(F.sequence("first", "last", F.expr("INTERVAL 1 DAY"))).alias("calendar_date"))


def calendar(spark: SparkSession, first: str = CALENDAR[0], last: str = CALENDAR[1]) -> DataFrame:
    """Date dimension between two fixed days."""
    bounds = spark.range(1).select(F.to_date(F.lit(first)).alias("first"), F.to_date(F.lit(last)).alias("last"))
    return date_attributes(_days(bounds))


def calendar_for(df: DataFrame, *columns: str) -> DataFrame:
    """Date dimension covering the whole years that occur in any of ``columns``."""
    days = F.array(*[F.to_date(c) for c in columns])
    bounds = df.agg(
        F.trunc(F.min(F.array_min(days)), "year").alias("first"),
        F.date_sub(F.add_months(F.trunc(F.max(F.array_max(days)), "year"), 12), 1).alias("last"),
    )
    return date_attributes(_days(bounds))


def date_attributes(days: DataFrame, fiscal_start: int = 4) -> DataFrame:
    """Calendar, fiscal and name attributes; days of the week count from Sunday = 1."""
    day = F.col("calendar_date")
    return days.select(
        date_key(day).alias("date_key"),
        "calendar_date",
        F.date_format(day, "yyyy-MM-dd").alias("date_name"),
        F.year(day).alias("calendar_year"),
        F.quarter(day).alias("calendar_quarter"),
        F.month(day).alias("calendar_month"),
        F.dayofmonth(day).alias("calendar_day"),
        F.weekofyear(day).alias("calendar_week"),
        F.dayofweek(day).alias("day_of_week"),
        F.dayofyear(day).alias("day_of_year"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.date_format(day, "MMMM yyyy").alias("month_year"),
        fiscal_year(day, fiscal_start).alias("fiscal_year"),
        fiscal_quarter(day, fiscal_start).alias("fiscal_quarter"),
        is_weekend(day).alias("is_weekend"),
        F.lit(False).alias("is_holiday"),
    )


def extend_calendar(dates: DataFrame, as_of: Column, fiscal_start: int = 4) -> DataFrame:
    """Short names, week of month, period ends, season and flags relative to ``as_of``."""
    day = F.col("calendar_date")
    month_end = day == F.last_day(day)
    leap = F.dayofyear(F.make_date(F.year(day), F.lit(12), F.lit(31))) == 366

    def same(unit: str) -> Column:
        return F.trunc(day, unit) == F.trunc(as_of, unit)

    weekend = is_weekend(day)
    return dates.withColumns(
        {
            "day_name_short": F.date_format(day, "EEE"),
            "month_name_short": F.date_format(day, "MMM"),
            "day_of_week_iso": F.weekday(day) + 1,
            "week_of_month": F.ceil((F.dayofmonth(day) + F.weekday(F.trunc(day, "month"))) / 7).cast("int"),
            "weekday_indicator": F.when(weekend, "Weekend").otherwise("Weekday"),
            "quarter_name": F.concat(F.lit("Q"), F.quarter(day).cast("string")),
            "quarter_year": F.concat(F.date_format(day, "yyyy"), F.lit("-Q"), F.quarter(day).cast("string")),
            "year_month": F.date_format(day, "yyyy-MM"),
            "fiscal_month": fiscal_month(day, fiscal_start),
            "is_weekday": ~weekend,
            "is_business_day": ~weekend & ~F.col("is_holiday"),
            "is_month_end": month_end,
            "is_quarter_end": month_end & (F.month(day) % 3 == 0),
            "is_year_end": month_end & (F.month(day) == 12),
            "is_leap_year": leap,
            "season": F.element_at(
                F.array(*[F.lit(s) for s in ("Winter", "Spring", "Summer", "Fall")]),
                (F.floor((F.month(day) % 12) / 3) + 1).cast("int"),
            ),
            "is_current_day": day == as_of,
            "is_current_week": same("week"),
            "is_current_month": same("month"),
            "is_current_quarter": same("quarter"),
            "is_current_year": same("year"),
            "days_from_today": F.date_diff(day, as_of),
        }
    )


def with_unknown_date(dates: DataFrame) -> DataFrame:
    """Add the row that open dates point to, so that an inner join to the calendar keeps them."""
    spark = dates.sparkSession
    unknown = spark.range(1).select(
        F.lit(UNKNOWN_DATE_KEY).alias("date_key"), F.lit("Unknown").alias("date_name")
    )
    return dates.unionByName(unknown, allowMissingColumns=True)


def activity(rentals: DataFrame, as_of: Column) -> DataFrame:
    """Per customer: rentals, first and last day, days since the last."""
    day = F.to_date("rental_date")
    return (
        rentals.groupBy("customer_id")
        .agg(
            F.count(F.lit(1)).alias("total_rentals"),
            F.min(day).alias("first_rental_date"),
            F.max(day).alias("last_rental_date"),
        )
        .withColumn("days_since_last_rental", F.date_diff(as_of, F.col("last_rental_date")))
    )


def spending(payments: DataFrame) -> DataFrame:
    """Per customer: amount paid and average payment."""
    return payments.groupBy("customer_id").agg(
        F.sum("amount").alias("total_payments"), mean(F.col("amount")).alias("avg_payment_amount")
    )


def customer_dimension(
    customers: DataFrame,
    addresses: DataFrame,
    stores: DataFrame,
    rentals: DataFrame,
    payments: DataFrame,
    as_of: Column,
    bounds: Sequence = TIERS,
    high_value: object = TIERS[1],
) -> DataFrame:
    """Customers with address, store, activity, spending and tier (overwritten in place, type 1)."""
    wide = denormalize(
        customers,
        [
            (
                addresses,
                {"address_id": "address_id"},
                {c: c for c in ("address", "address2", "district", "postal_code", "phone")},
            ),
            (stores, {"store_id": "store_id"}, {"store_address": "address", "store_city": "city"}),
        ],
    )
    wide = join_aggregate(wide, activity(rentals, as_of), "customer_id", ["total_rentals"])
    wide = join_aggregate(wide, spending(payments), "customer_id", ["total_payments", "avg_payment_amount"])
    paid = F.col("total_payments")
    fills = {"address": "Unknown", "district": "Unknown", "postal_code": "00000", "phone": "000-000-0000"}
    return wide.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in fills.items()}).withColumns(
        {
            "gl_dim_customer_key": surrogate_key("gl_dim_customer", "customer_id"),
            "full_name": F.concat_ws(" ", "first_name", "last_name"),
            "customer_lifetime_value": paid,
            "customer_tier": tier(paid, bounds),
            "is_high_value": at_least(paid, high_value),
            "avg_rental_frequency": per(F.col("total_rentals"), F.lit(12)),
        }
    )


def film_dimension(
    films: DataFrame,
    languages: DataFrame,
    ratings: Mapping[str, str] = RATING_GROUPS,
    feature_length: int = FEATURE_LENGTH,
    revenue_tiers: Sequence = tuple(REVENUE_TIERS),
) -> DataFrame:
    """Films with language name, rating group, feature-length flag and revenue tier."""
    wide = denormalize(films, [(languages, {"language_id": "language_id"}, {"language_name": "name"})])
    return wide.withColumns(
        {
            "gl_dim_film_key": surrogate_key("gl_dim_film", "film_id"),
            "language_name": F.coalesce("language_name", F.lit("Unknown")),
            "film_category": recode(F.col("rating"), ratings, "General"),
            "is_feature_length": at_least(F.col("length"), feature_length),
            "revenue_tier": bucket(F.col("replacement_cost"), revenue_tiers, "Budget"),
        }
    )


def feature_flags(films: DataFrame, column: str = "special_features") -> DataFrame:
    """Flags and count from the comma-separated feature list."""
    # Flag -> list entry.
    entries = {
        "has_trailers": "Trailers",
        "has_commentaries": "Commentaries",
        "has_deleted_scenes": "Deleted Scenes",
        "has_behind_scenes": "Behind the Scenes",
    }
    items = list_items(F.col(column))
    flags = {flag: F.array_contains(items, entry) for flag, entry in entries.items()}
    return films.withColumns({**flags, "special_features_count": F.size(items)})


def names_list(links: DataFrame, key: str, name: str, result: str, separator: str = ", ") -> DataFrame:
    """Distinct names per key in one text, sorted.

    Copies vanish before the shuffle; what is gathered per key is bounded by the number
    of different names, which come from a lookup table.
    """
    return links.groupBy(key).agg(
        F.array_join(F.array_sort(F.collect_set(name)), separator).alias(result)
    )


def top_value(rows: DataFrame, key: str, value: str, result: str, weight: Column | None = None) -> DataFrame:
    """Most frequent ``value`` per key; ties go to the smallest value.

    Two aggregates instead of a ranking window: the second sees one row per key and value.
    """
    counts = rows.groupBy(key, value).agg((F.sum(weight) if weight is not None else F.count(F.lit(1))).alias("_n"))
    place = F.struct((-F.col("_n")).alias("_n"), F.col(value))
    return counts.groupBy(key).agg(F.min_by(value, place).alias(result))


def film_analytics(films: DataFrame, rentals: DataFrame, payments: DataFrame, as_of: Column) -> DataFrame:
    """Copies, rentals, revenue, duration, frequency, popularity, classic flag and availability."""
    days_out = F.date_diff(F.to_date("return_date"), F.to_date("rental_date"))
    per_copy = rentals.groupBy("film_id", "inventory_id").agg(
        F.count(F.lit(1)).alias("_rentals"),
        F.count_if(F.col("return_date").isNull()).alias("_open"),
        F.sum(days_out).alias("_days"),
        F.count(days_out).alias("_returned"),
        F.min("rental_date").alias("_first"),
        F.max("rental_date").alias("_last"),
    )
    used = per_copy.groupBy("film_id").agg(
        F.count(F.lit(1)).alias("total_inventory_copies"),
        F.sum("_rentals").alias("total_rentals"),
        F.count_if(F.col("_open") > 0).alias("_copies_out"),
        per(F.sum("_days"), F.sum("_returned")).alias("avg_rental_duration"),
        F.min("_first").alias("_first"),
        F.max("_last").alias("last_rental_date"),
    )
    revenue = payments.groupBy("film_id").agg(F.sum("amount").alias("total_revenue"))
    wide = join_aggregate(films, used, "film_id", ["total_inventory_copies", "total_rentals", "_copies_out"])
    wide = join_aggregate(wide, revenue, "film_id", ["total_revenue"])
    active_days = F.date_diff(as_of, F.to_date("_first")) + 1
    age = F.year(as_of) - F.col("release_year")
    popularity = per(F.col("total_rentals"), F.greatest(F.col("total_inventory_copies"), F.lit(1)))
    return wide.withColumns(
        {
            "rental_frequency": per(F.col("total_rentals"), active_days),
            "popularity_score": popularity,
            "is_classic": F.coalesce((age >= 20) & (F.col("total_rentals") >= 2), F.lit(False)),
            "is_currently_available": F.col("total_inventory_copies") > F.col("_copies_out"),
            "days_since_last_rental": F.date_diff(as_of, F.to_date("last_rental_date")),
        }
    ).drop("_first", "_copies_out")


def store_dimension(stores: DataFrame, addresses: DataFrame) -> DataFrame:
    """Stores with their address; unknown attributes get a text, not NULL."""
    take = {"store_address": "address", "store_district": "district", "store_postal_code": "postal_code", "store_phone": "phone"}
    wide = denormalize(stores, [(addresses, {"address_id": "address_id"}, take)])
    # Texts for a missing address.
    fills = {
        "store_address": "Unknown Address",
        "store_district": "Unknown",
        "store_postal_code": "00000",
        "store_phone": "000-000-0000",
    }
    return wide.withColumns(
        {
            "gl_dim_store_key": surrogate_key("gl_dim_store", "store_id"),
            **{c: F.coalesce(F.col(c), F.lit(v)) for c, v in fills.items()},
        }
    )


def staff_dimension(rentals: DataFrame, mail_domain: str = "example.com") -> DataFrame:
    """Staff known only from the ids on rentals, with placeholder names."""
    ids = rentals.select("staff_id").where(F.col("staff_id").isNotNull()).distinct()
    number = F.col("staff_id").cast("string")
    return ids.withColumns(
        {
            "gl_dim_staff_key": surrogate_key("gl_dim_staff", "staff_id"),
            "first_name": F.lit("Staff"),
            "last_name": F.concat(F.lit("Member "), number),
            "email": F.concat(F.lit("staff"), number, F.lit("@" + mail_domain)),
            "is_active": F.lit(True),
        }
    )


def store_performance(
    stores: DataFrame, rentals: DataFrame, payments: DataFrame, as_of: Column, active_days: int = 90
) -> DataFrame:
    """Customers, rentals, revenue, inventory, turnover, retention and tier per store.

    Rentals shrink to one row per store and customer first; the distinct counts are then
    plain counts and a busy store is spread over its customers.
    """
    visits = rentals.groupBy("store_id", "customer_id").agg(
        F.count(F.lit(1)).alias("_n"), F.max("rental_date").alias("_last"), F.min("rental_date").alias("_first")
    )
    recent = F.to_date("_last") >= F.date_sub(as_of, active_days)
    people = visits.groupBy("store_id").agg(
        F.count(F.lit(1)).alias("total_customers"),
        F.sum("_n").alias("total_rentals"),
        F.count_if(recent).alias("active_customers"),
        F.count_if(F.col("_n") > 1).alias("_returning"),
        (F.date_diff(F.max(F.to_date("_last")), F.min(F.to_date("_first"))) + 1).alias("_days"),
    )
    copies = (
        rentals.select("store_id", "inventory_id")
        .where(F.col("inventory_id").isNotNull())
        .distinct()
        .groupBy("store_id")
        .agg(F.count(F.lit(1)).alias("total_inventory_items"))
    )
    revenue = payments.groupBy("store_id").agg(F.sum("amount").alias("total_revenue"))
    wide = join_aggregate(stores, people, "store_id", ["total_customers", "total_rentals", "active_customers"])
    wide = join_aggregate(wide, copies, "store_id", ["total_inventory_items"])
    wide = join_aggregate(wide, revenue, "store_id", ["total_revenue"])
    wide = wide.withColumns(
        {
            "revenue_per_customer": per(F.col("total_revenue"), F.col("total_customers")),
            "inventory_turnover_rate": per(F.col("total_rentals"), F.col("total_inventory_items")),
            "customer_retention_rate": per(F.col("_returning"), F.col("total_customers")),
            "avg_rentals_per_day": per(F.col("total_rentals"), F.col("_days")),
            "_sort": -F.col("total_revenue"),
        }
    ).drop("_returning", "_days")
    ranked = number_rows(wide, ["_sort", "store_id"], "_position", total="_total")
    level = tile(F.col("_position"), F.col("_total"), 3)
    names = F.array(F.lit("High"), F.lit("Medium"), F.lit("Low"))
    return ranked.withColumn("store_tier", F.element_at(names, level)).drop("_sort", "_position", "_total")


def staff_performance(
    staff: DataFrame, rentals: DataFrame, payments: DataFrame, stores: DataFrame
) -> DataFrame:
    """Processed rentals and payments per staff member, daily rates, tier and manager totals."""
    handled = rentals.groupBy("staff_id", F.to_date("rental_date").alias("_day")).agg(F.count(F.lit(1)).alias("_n"))
    handled = handled.groupBy("staff_id").agg(
        F.sum("_n").alias("total_rentals_processed"), F.count(F.lit(1)).alias("_rental_days")
    )
    taken = payments.groupBy("staff_id", F.to_date("payment_date").alias("_day")).agg(
        F.count(F.lit(1)).alias("_n"), F.sum("amount").alias("_amount")
    )
    taken = taken.groupBy("staff_id").agg(
        F.sum("_n").alias("total_payments_processed"),
        F.sum("_amount").alias("total_payment_amount"),
        F.count(F.lit(1)).alias("_payment_days"),
    )
    wide = join_aggregate(staff, handled, "staff_id", ["total_rentals_processed"])
    wide = join_aggregate(wide, taken, "staff_id", ["total_payments_processed", "total_payment_amount"])
    team = staff.groupBy("store_id").agg(F.count(F.lit(1)).alias("_team"))
    store_revenue = payments.groupBy("store_id").agg(F.sum("amount").alias("_store_revenue"))
    managed = (
        stores.select("store_id", F.col("manager_staff_id").alias("staff_id"))
        .join(team, "store_id", "left")
        .join(store_revenue, "store_id", "left")
        .groupBy("staff_id")
        .agg(
            F.sum(F.coalesce("_team", F.lit(0))).alias("managed_staff_count"),
            F.sum("_store_revenue").alias("store_revenue_under_management"),
        )
    )
    wide = wide.join(managed, "staff_id", "left").withColumns(
        {
            "avg_payment_amount": per(F.col("total_payment_amount"), F.col("total_payments_processed")),
            "avg_rentals_per_day": per(F.col("total_rentals_processed"), F.col("_rental_days")),
            "avg_payments_per_day": per(F.col("total_payments_processed"), F.col("_payment_days")),
            "_sort": -F.col("total_payment_amount"),
        }
    )
    ranked = number_rows(wide, ["_sort", "staff_id"], "_position", total="_total")
    level = tile(F.col("_position"), F.col("_total"), 4)
    names = F.array(*[F.lit(n) for n in ("Top", "High", "Average", "Low")])
    return ranked.withColumns(
        {"performance_tier": F.element_at(names, level), "is_top_performer": level == 1}
    ).drop("_sort", "_position", "_total", "_rental_days", "_payment_days")
