"""Joins, aggregates, dimensions, fact, metrics, marts and quality reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import binding as b
from catalog.landing import (
    LOAD,
    PRICE_TIERS,
    RATINGS,
    SQL_CLEAN_CUSTOMER,
    SQL_PRICE_TIER,
    SQL_RATING,
    SQL_SCORE,
    TIER_BOUNDS,
    _load_time,
    key_sql,
)
from catalog.registry import query
from stratalake.functions.keys import surrogate_key
from stratalake.operators import distinct, joins, ordered, quality
from stratalake.operators.audit import add_bronze_audit, add_gold_audit
from stratalake.plans import dims, facts, marts, silver
from stratalake.plans import metrics as m
from stratalake.session import pin
from stratalake.sources import tables

DAY = f"DATE '{b.AS_OF_DATE}'"


def fact(spark, sf):
    return facts.rental_fact(b.film_rental(spark, sf), b.payment(spark, sf))


def timed_rentals(spark, sf):
    """Rentals with durations and flags, for measures that need no payment."""
    return facts.rental_measures(b.film_rental(spark, sf))


def metrics(spark, sf):
    return m.customer_metrics(fact(spark, sf), TIER_BOUNDS, TIER_BOUNDS[1])


# --- joins ---------------------------------------------------------------------------


@query(
    "denorm_customer",
    """SELECT c.customer_id, a.address, a.district, s.address AS store_name, s.city AS store_city
       FROM b_customer c LEFT JOIN address_book a ON c.address_id = a.address_id LEFT JOIN store s ON c.store_id = s.store_id""",
)
def denorm_customer(spark, sf):
    wide = joins.denormalize(
        b.customer(spark, sf),
        [
            (b.address(spark, sf), {"address_id": "address_id"}, {"address": "address", "district": "district"}),
            (b.store(spark, sf), {"store_id": "store_id"}, {"store_name": "address", "store_city": "city"}),
        ],
    )
    return wide.select("customer_id", "address", "district", "store_name", "store_city")


@query(
    "denorm_part",
    "SELECT film_id, title, coalesce(l.name, 'Unknown') AS language_name FROM film f LEFT JOIN language l ON f.language_id = l.language_id",
)
def denorm_part(spark, sf):
    wide = dims.film_dimension(b.film(spark, sf), b.language(spark, sf))
    return wide.select("film_id", "title", "language_name")


SQL_ACTIVITY = f"""SELECT customer_id, count(*) AS total_rentals, min(rental_date)::DATE AS first_rental_date, max(rental_date)::DATE AS last_rental_date,
    date_diff('day', max(rental_date)::DATE, {DAY})::INT AS days_since_last_rental FROM rental GROUP BY customer_id"""
SQL_SPENDING = """SELECT customer_id, sum(amount) AS total_payments, sum(amount)::DOUBLE / count(*) AS avg_payment_amount
    FROM customer_payment GROUP BY customer_id"""


@query("customer_activity", SQL_ACTIVITY)
def customer_activity(spark, sf):
    return dims.activity(b.rental(spark, sf), b.as_of_date())


@query(
    "customer_payments",
    f"SELECT customer_id, total_payments::DOUBLE AS total_payments, avg_payment_amount FROM ({SQL_SPENDING})",
)
def customer_payments(spark, sf):
    return dims.spending(b.customer_payment(spark, sf))


@query(
    "customer_with_aggs",
    f"""SELECT c.customer_id, coalesce(a.total_rentals, 0) AS total_rentals, coalesce(p.total_payments, 0)::DOUBLE AS total_payments
        FROM b_customer c LEFT JOIN ({SQL_ACTIVITY}) a ON c.customer_id = a.customer_id
        LEFT JOIN ({SQL_SPENDING}) p ON c.customer_id = p.customer_id""",
)
def customer_with_aggs(spark, sf):
    wide = joins.join_aggregate(
        b.customer(spark, sf).select("customer_id"), dims.activity(b.rental(spark, sf), b.as_of_date()), "customer_id", ["total_rentals"]
    )
    wide = joins.join_aggregate(wide, dims.spending(b.customer_payment(spark, sf)), "customer_id", ["total_payments"])
    return wide.select("customer_id", "total_rentals", "total_payments")


@query(
    "fact_left_fanout",
    """SELECT r.rental_id, r.customer_id, coalesce(p.amount, 2.99)::DOUBLE AS amount, coalesce(p.payment_date, r.rental_date) AS payment_date
       FROM rental r LEFT JOIN payment p ON r.rental_id = p.rental_id""",
)
def fact_left_fanout(spark, sf):
    rows = facts.rental_payments(b.rental(spark, sf), b.payment(spark, sf))
    return rows.select("rental_id", "customer_id", "amount", "payment_date")


@query("fact_left_preagg", "SELECT rental_id, customer_id, amount::DOUBLE AS amount, payment_date, payment_count FROM fact")
def fact_left_preagg(spark, sf):
    rows = facts.paid_rentals(b.film_rental(spark, sf), b.payment(spark, sf))
    return rows.select("rental_id", "customer_id", "amount", "payment_date", "payment_count")


SQL_DATE_KEY = "coalesce((year({0}) * 10000 + month({0}) * 100 + day({0}))::INT, 19000101)"


@query(
    "role_playing_dates",
    f"""SELECT rental_id, {SQL_DATE_KEY.format("rental_date")} AS rental_date_key, {SQL_DATE_KEY.format("return_date")} AS return_date_key,
        dayname(rental_date) AS rental_day, (dayofweek(rental_date) IN (0, 6)) AS rental_weekend,
        dayname(return_date) AS return_day, (dayofweek(return_date) IN (0, 6)) AS return_weekend FROM rental""",
)
def role_playing_dates(spark, sf):
    rentals = b.rental(spark, sf)
    keyed = facts.rental_measures(rentals)
    # The calendar spans the years of both roles and is bounded by them.
    days = rentals.select(F.explode(F.array("rental_date", "return_date")).alias("at"))
    dates = joins.broadcast_checked(dims.with_unknown_date(dims.calendar_for(days, "at")))
    wide = facts.role_playing_dates(keyed, dates, {"day_name": "day", "is_weekend": "weekend"})
    return wide.select(
        "rental_id", "rental_date_key", "return_date_key", "rental_day", "rental_weekend", "return_day", "return_weekend"
    )


def _keyed_dims(spark, sf):
    return {
        "customer": b.customer(spark, sf).select("customer_id", surrogate_key("gl_dim_customer", "customer_id").alias("customer_key")),
        # Very short films are not in the dimension, so unknown members occur.
        "film": b.film(spark, sf).where("length > 10").select("film_id", surrogate_key("gl_dim_film", "film_id").alias("film_key")),
        "store": b.store(spark, sf).where("is_active").select("store_id", surrogate_key("gl_dim_store", "store_id").alias("store_key")),
        "staff": dims.staff_dimension(b.payment(spark, sf)).select("staff_id", F.col("gl_dim_staff_key").alias("staff_key")),
    }


SQL_KEYS = f"""SELECT f.rental_id,
    coalesce({key_sql("gl_dim_customer", "c.customer_id")}, '-1') AS customer_key_raw, c.customer_id IS NOT NULL AS has_customer,
    i.film_id IS NOT NULL AS has_film, s.store_id IS NOT NULL AS has_store, f.staff_id IS NOT NULL AS has_staff,
    f.customer_id, f.film_id, f.store_id, f.staff_id
    FROM fact f LEFT JOIN b_customer c ON f.customer_id = c.customer_id
    LEFT JOIN (SELECT * FROM film WHERE length > 10) i ON f.film_id = i.film_id
    LEFT JOIN (SELECT * FROM store WHERE is_active) s ON f.store_id = s.store_id"""


@query(
    "fact_key_lookup",
    f"""SELECT rental_id, CASE WHEN has_customer THEN {key_sql("gl_dim_customer", "customer_id")} ELSE '-1' END AS customer_key,
        CASE WHEN has_film THEN {key_sql("gl_dim_film", "film_id")} ELSE '-1' END AS film_key,
        CASE WHEN has_store THEN {key_sql("gl_dim_store", "store_id")} ELSE '-1' END AS store_key,
        CASE WHEN has_staff THEN {key_sql("gl_dim_staff", "staff_id")} ELSE '-1' END AS staff_key FROM ({SQL_KEYS})""",
)
def fact_key_lookup(spark, sf):
    d = _keyed_dims(spark, sf)
    rows = b.film_rental(spark, sf)
    keyed = joins.lookup_keys(rows, [(d[n], f"{n}_id", f"{n}_id", f"{n}_key") for n in ("customer", "film", "store", "staff")])
    return keyed.select("rental_id", "customer_key", "film_key", "store_key", "staff_key")


@query(
    "ref_missing_rows",
    """SELECT 'old only' AS side, p_partkey AS id FROM part WHERE p_partkey NOT IN (SELECT l_partkey + 10 FROM lineitem)
       UNION ALL SELECT DISTINCT 'new only', l_partkey + 10 FROM lineitem WHERE l_partkey + 10 NOT IN (SELECT p_partkey FROM part)""",
)
def ref_missing_rows(spark, sf):
    existing = tables.read_table(spark, sf, "part").select(F.col("p_partkey").alias("id"))
    new = tables.read_table(spark, sf, "lineitem").select((F.col("l_partkey") + 10).alias("id")).distinct()
    gone = joins.missing_rows(existing, new, "id").select(F.lit("old only").alias("side"), "id")
    return gone.unionByName(joins.missing_rows(new, existing, "id").select(F.lit("new only").alias("side"), "id"))


@query(
    "fk_orphans",
    """SELECT 'film_id' AS foreign_key, count(*) AS checked_rows, count(*) FILTER (f.film_id IS NULL) AS orphan_rows,
         count(DISTINCT p.film_id) FILTER (f.film_id IS NULL) AS orphan_values
       FROM payment p LEFT JOIN (SELECT film_id FROM film WHERE length > 10) f ON p.film_id = f.film_id
       UNION ALL SELECT 'store_id', count(*), count(*) FILTER (s.store_id IS NULL), count(DISTINCT p.store_id) FILTER (s.store_id IS NULL)
       FROM payment p LEFT JOIN (SELECT store_id FROM store WHERE is_active) s ON p.store_id = s.store_id
       UNION ALL SELECT 'rental_id', count(*), count(*) FILTER (r.rental_id IS NULL), count(DISTINCT p.rental_id) FILTER (r.rental_id IS NULL)
       FROM payment p LEFT JOIN rental r ON p.rental_id = r.rental_id""",
)
def fk_orphans(spark, sf):
    parents = [
        ("film_id", b.film(spark, sf).where("length > 10"), "film_id"),
        ("store_id", b.store(spark, sf).where("is_active"), "store_id"),
        ("rental_id", b.rental(spark, sf), "rental_id"),
    ]
    return joins.orphan_report(b.payment(spark, sf), parents)


@query(
    "fk_valid_semi",
    "SELECT rental_id, line_number, film_id FROM payment WHERE film_id IN (SELECT film_id FROM film WHERE length > 10)",
)
def fk_valid_semi(spark, sf):
    known = b.film(spark, sf).where("length > 10")
    return joins.present_rows(b.payment(spark, sf).select("rental_id", "line_number", "film_id"), known, "film_id", "film_id").select(
        "rental_id", "line_number", "film_id"
    )


# --- marts ---------------------------------------------------------------------------


def monthly(spark, sf):
    return marts.monthly_revenue(b.customer_payment(spark, sf), b.store(spark, sf))


@query("monthly_revenue", "SELECT * REPLACE (total_revenue::DOUBLE AS total_revenue) FROM monthly")
def monthly_revenue(spark, sf):
    return monthly(spark, sf)


@query(
    "mom_growth",
    """SELECT store_id, revenue_month, total_revenue::DOUBLE AS total_revenue, prev::DOUBLE AS prev_month,
       (total_revenue - prev)::DOUBLE / prev::DOUBLE * 100 AS growth_pct
       FROM (SELECT *, lag(total_revenue) OVER (PARTITION BY store_id ORDER BY revenue_month) AS prev FROM monthly)""",
)
def mom_growth(spark, sf):
    return marts.month_over_month(monthly(spark, sf))


@query(
    "ytd_revenue",
    f"""SELECT store_id, store_location, sum(total_revenue)::DOUBLE AS ytd_revenue FROM monthly
        WHERE revenue_month >= date_trunc('year', {DAY}) AND revenue_month <= {DAY} GROUP BY ALL""",
)
def ytd_revenue(spark, sf):
    return marts.revenue_year_to_date(monthly(spark, sf), b.as_of_date())


def titles(spark, sf):
    return marts.top_titles(b.film_rental(spark, sf), b.film(spark, sf), b.payment(spark, sf))


@query("top_titles", "SELECT * REPLACE (total_revenue::DOUBLE AS total_revenue, rental_rate::DOUBLE AS rental_rate) FROM titles")
def top_titles(spark, sf):
    return titles(spark, sf)


@query(
    "top_titles_quarter",
    f"""SELECT film_id, title, sum(total_rentals)::BIGINT AS quarterly_rentals FROM titles
        WHERE rental_month >= date_trunc('quarter', {DAY}) AND rental_month <= {DAY}
        GROUP BY ALL ORDER BY quarterly_rentals DESC, film_id LIMIT 10""",
)
def top_titles_quarter(spark, sf):
    return marts.top_titles_of_quarter(titles(spark, sf), b.as_of_date())


@query(
    "mart_by_category",
    """SELECT rating, round(avg(avg_rental_revenue), 4) AS avg_revenue_per_rental, round(avg(avg_days_out), 6) AS avg_rental_duration,
       sum(total_rentals)::BIGINT AS total_rentals FROM titles GROUP BY rating""",
)
def mart_by_category(spark, sf):
    return marts.titles_by_rating(titles(spark, sf))


def scorecard(spark, sf):
    return marts.store_scorecard(b.film_rental(spark, sf), b.store(spark, sf), b.film(spark, sf), b.payment(spark, sf))


@query("store_scorecard", "SELECT * REPLACE (daily_revenue::DOUBLE AS daily_revenue, late_returns::BIGINT AS late_returns) FROM scorecard")
def store_scorecard(spark, sf):
    return scorecard(spark, sf)


@query(
    "scorecard_by_store",
    f"""SELECT store_id, store_location, sum(daily_revenue)::DOUBLE / count(*) AS avg_daily_revenue, sum(active_customers)::DOUBLE / count(*) AS avg_daily_customers,
        sum(late_return_pct::DECIMAL(18,2))::DOUBLE / count(late_return_pct) AS avg_late_return_pct FROM scorecard
        WHERE business_date >= {DAY} - 30 AND business_date <= {DAY} GROUP BY ALL""",
)
def scorecard_by_store(spark, sf):
    return marts.scorecard_by_store(scorecard(spark, sf), b.as_of_date())


@query(
    "scorecard_by_day",
    f"""SELECT business_date, sum(daily_revenue)::DOUBLE AS chain_revenue, sum(active_customers)::BIGINT AS chain_customers,
        sum(late_return_pct::DECIMAL(18,2))::DOUBLE / count(late_return_pct) AS chain_late_return_pct FROM scorecard
        WHERE business_date >= {DAY} - 90 AND business_date <= {DAY} GROUP BY ALL""",
)
def scorecard_by_day(spark, sf):
    return marts.scorecard_by_day(scorecard(spark, sf), b.as_of_date())


# --- dimensions ----------------------------------------------------------------------

SQL_CALENDAR = """SELECT d::DATE AS calendar_date FROM (SELECT unnest(generate_series(
    date_trunc('year', (SELECT min(o_orderdate) FROM orders)), date_trunc('year', (SELECT max(o_orderdate) FROM orders)) + INTERVAL 1 YEAR - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS d)"""
SQL_DATES = f"""SELECT {SQL_DATE_KEY.format("d")} AS date_key, d AS calendar_date, strftime(d, '%Y-%m-%d') AS date_name, year(d)::INT AS calendar_year,
    quarter(d)::INT AS calendar_quarter, month(d)::INT AS calendar_month, day(d)::INT AS calendar_day, week(d)::INT AS calendar_week,
    (dayofweek(d) + 1)::INT AS day_of_week, dayofyear(d)::INT AS day_of_year, monthname(d) AS month_name, dayname(d) AS day_name,
    strftime(d, '%B %Y') AS month_year, (year(d) - (month(d) < 4)::INT)::INT AS fiscal_year,
    CASE WHEN month(d) >= 4 THEN (quarter(d) - 1)::INT ELSE 4 END::INT AS fiscal_quarter, dayofweek(d) IN (0, 6) AS is_weekend, FALSE AS is_holiday
    FROM (SELECT calendar_date AS d FROM ({SQL_CALENDAR}))"""


@query("dim_date", f"{SQL_DATES} UNION ALL BY NAME SELECT 19000101::INT AS date_key, 'Unknown' AS date_name")
def dim_date(spark, sf):
    return dims.with_unknown_date(dims.calendar_for(tables.read_table(spark, sf, "orders"), "o_orderdate"))


@query(
    "dim_date_ext",
    f"""SELECT date_key, strftime(d, '%a') AS day_name_short, strftime(d, '%b') AS month_name_short, isodow(d)::INT AS day_of_week_iso,
        ceil((day(d) + isodow(date_trunc('month', d)) - 1) / 7.0)::INT AS week_of_month, CASE WHEN is_weekend THEN 'Weekend' ELSE 'Weekday' END AS weekday_indicator,
        'Q' || quarter(d) AS quarter_name, year(d) || '-Q' || quarter(d) AS quarter_year, strftime(d, '%Y-%m') AS year_month,
        ((month(d) + 8) % 12 + 1)::INT AS fiscal_month, NOT is_weekend AS is_weekday, NOT is_weekend AS is_business_day, d = last_day(d) AS is_month_end,
        d = last_day(d) AND month(d) IN (3, 6, 9, 12) AS is_quarter_end, month(d) = 12 AND day(d) = 31 AS is_year_end,
        (year(d) % 4 = 0 AND (year(d) % 100 <> 0 OR year(d) % 400 = 0)) AS is_leap_year,
        CASE WHEN month(d) IN (12, 1, 2) THEN 'Winter' WHEN month(d) <= 5 THEN 'Spring' WHEN month(d) <= 8 THEN 'Summer' ELSE 'Fall' END AS season,
        d = {DAY} AS is_current_day, date_trunc('week', d) = date_trunc('week', {DAY}) AS is_current_week,
        date_trunc('month', d) = date_trunc('month', {DAY}) AS is_current_month, date_trunc('quarter', d) = date_trunc('quarter', {DAY}) AS is_current_quarter,
        year(d) = year({DAY}) AS is_current_year, date_diff('day', {DAY}, d)::INT AS days_from_today
        FROM (SELECT *, calendar_date AS d FROM ({SQL_DATES}))""",
)
def dim_date_ext(spark, sf):
    dates = dims.calendar_for(tables.read_table(spark, sf, "orders"), "o_orderdate")
    wide = dims.extend_calendar(dates, b.as_of_date())
    return wide.select("date_key", *wide.columns[len(dates.columns):])


@query(
    "dim_customer",
    f"""SELECT c.customer_id, {key_sql("gl_dim_customer", "c.customer_id")} AS gl_dim_customer_key, c.first_name || ' ' || c.last_name AS full_name,
        coalesce(a.address, 'Unknown') AS address, a.address2, coalesce(a.district, 'Unknown') AS district, coalesce(a.postal_code, '00000') AS postal_code,
        coalesce(a.phone, '000-000-0000') AS phone, s.address AS store_address, s.city AS store_city, coalesce(r.total_rentals, 0) AS total_rentals,
        r.first_rental_date, r.last_rental_date, r.days_since_last_rental, coalesce(p.total_payments, 0)::DOUBLE AS total_payments,
        coalesce(p.avg_payment_amount, 0) AS avg_payment_amount, coalesce(p.total_payments, 0)::DOUBLE AS customer_lifetime_value,
        CASE WHEN p.total_payments >= 2500000 THEN 'Platinum' WHEN p.total_payments >= 2000000 THEN 'Gold' WHEN p.total_payments >= 1500000 THEN 'Silver' ELSE 'Bronze' END AS customer_tier,
        coalesce(p.total_payments >= 2000000, FALSE) AS is_high_value, coalesce(r.total_rentals, 0)::DOUBLE / 12 AS avg_rental_frequency, TRUE AS gl_is_current
        FROM b_customer c LEFT JOIN address_book a ON c.address_id = a.address_id LEFT JOIN store s ON c.store_id = s.store_id
        LEFT JOIN ({SQL_ACTIVITY}) r ON c.customer_id = r.customer_id LEFT JOIN ({SQL_SPENDING}) p ON c.customer_id = p.customer_id""",
)
def dim_customer(spark, sf):
    wide = dims.customer_dimension(
        b.customer(spark, sf), b.address(spark, sf), b.store(spark, sf), b.rental(spark, sf), b.customer_payment(spark, sf),
        b.as_of_date(), TIER_BOUNDS, TIER_BOUNDS[1],
    )
    return add_gold_audit(wide, "customer", "g1", _load_time()).drop(
        "first_name", "last_name", "address_id", "store_id", "gl_created_time", "gl_updated_time", "gl_source_silver_key", "gl_batch_id"
    )


@query(
    "dim_part",
    f"""SELECT film_id, {key_sql("gl_dim_film", "film_id")} AS gl_dim_film_key, title, coalesce(l.name, 'Unknown') AS language_name, {SQL_RATING} AS film_category,
        length >= 25 AS is_feature_length, {SQL_PRICE_TIER} AS revenue_tier FROM film f LEFT JOIN language l ON f.language_id = l.language_id""",
)
def dim_part(spark, sf):
    wide = dims.film_dimension(b.film(spark, sf), b.language(spark, sf), RATINGS, 25, PRICE_TIERS)
    return wide.select("film_id", "gl_dim_film_key", "title", "language_name", "film_category", "is_feature_length", "revenue_tier")


@query(
    "part_analytics",
    f"""SELECT f.film_id, coalesce(u.copies, 0) AS total_inventory_copies, coalesce(u.rentals, 0) AS total_rentals, coalesce(p.revenue, 0)::DOUBLE AS total_revenue,
        u.avg_rental_duration, u.last_rental_date, coalesce(u.rentals, 0)::DOUBLE / nullif(date_diff('day', u.first_rental::DATE, {DAY}) + 1, 0) AS rental_frequency,
        coalesce(u.rentals, 0)::DOUBLE / greatest(coalesce(u.copies, 0), 1) AS popularity_score, year({DAY}) - f.release_year >= 20 AND coalesce(u.rentals, 0) >= 2 AS is_classic,
        coalesce(u.copies, 0) > coalesce(u.copies_out, 0) AS is_currently_available, date_diff('day', u.last_rental_date::DATE, {DAY})::INT AS days_since_last_rental
        FROM film f LEFT JOIN (SELECT film_id, count(DISTINCT inventory_id) AS copies, count(DISTINCT inventory_id) FILTER (return_date IS NULL) AS copies_out, count(*) AS rentals,
          sum(date_diff('day', rental_date::DATE, return_date::DATE))::DOUBLE / nullif(count(return_date), 0) AS avg_rental_duration, min(rental_date) AS first_rental,
          max(rental_date) AS last_rental_date FROM film_rental GROUP BY film_id) u ON f.film_id = u.film_id
        LEFT JOIN (SELECT film_id, sum(amount) AS revenue FROM payment GROUP BY film_id) p ON f.film_id = p.film_id""",
)
def part_analytics(spark, sf):
    wide = dims.film_analytics(b.film(spark, sf).select("film_id", "release_year"), b.film_rental(spark, sf), b.payment(spark, sf), b.as_of_date())
    return wide.drop("release_year")


@query(
    "dim_store",
    f"""SELECT store_id, {key_sql("gl_dim_store", "store_id")} AS gl_dim_store_key, coalesce(a.address, 'Unknown Address') AS store_address,
        coalesce(a.district, 'Unknown') AS store_district, coalesce(a.postal_code, '00000') AS store_postal_code, coalesce(a.phone, '000-000-0000') AS store_phone
        FROM store s LEFT JOIN address_book a ON s.address_id = a.address_id""",
)
def dim_store(spark, sf):
    wide = dims.store_dimension(b.store(spark, sf), b.address(spark, sf))
    return wide.select("store_id", "gl_dim_store_key", "store_address", "store_district", "store_postal_code", "store_phone")


@query(
    "store_performance",
    f"""SELECT *, CASE ntile(3) OVER (ORDER BY total_revenue DESC, store_id) WHEN 1 THEN 'High' WHEN 2 THEN 'Medium' ELSE 'Low' END AS store_tier FROM (
        SELECT s.store_id, coalesce(v.total_customers, 0) AS total_customers, coalesce(v.total_rentals, 0)::BIGINT AS total_rentals, coalesce(v.active_customers, 0) AS active_customers,
          coalesce(c.items, 0) AS total_inventory_items, coalesce(p.revenue, 0)::DOUBLE AS total_revenue, coalesce(p.revenue, 0)::DOUBLE / v.total_customers AS revenue_per_customer,
          v.total_rentals::DOUBLE / c.items AS inventory_turnover_rate, v.returning_customers::DOUBLE / v.total_customers AS customer_retention_rate,
          v.total_rentals::DOUBLE / v.days AS avg_rentals_per_day
        FROM store s LEFT JOIN (SELECT store_id, count(*) AS total_customers, sum(n) AS total_rentals, count(*) FILTER (last_rental::DATE >= {DAY} - 90) AS active_customers,
            count(*) FILTER (n > 1) AS returning_customers, date_diff('day', min(first_rental)::DATE, max(last_rental)::DATE) + 1 AS days
            FROM (SELECT store_id, customer_id, count(*) AS n, max(rental_date) AS last_rental, min(rental_date) AS first_rental FROM film_rental GROUP BY ALL) GROUP BY store_id) v ON s.store_id = v.store_id
        LEFT JOIN (SELECT store_id, count(DISTINCT inventory_id) AS items FROM film_rental GROUP BY ALL) c ON s.store_id = c.store_id
        LEFT JOIN (SELECT store_id, sum(amount) AS revenue FROM payment GROUP BY ALL) p ON s.store_id = p.store_id)""",
)
def store_performance(spark, sf):
    return dims.store_performance(b.store(spark, sf).select("store_id"), b.film_rental(spark, sf), b.payment(spark, sf), b.as_of_date())


@query(
    "dim_inferred",
    f"""SELECT DISTINCT staff_id, {key_sql("gl_dim_staff", "staff_id")} AS gl_dim_staff_key, 'Staff' AS first_name, 'Member ' || staff_id AS last_name,
        'staff' || staff_id || '@example.com' AS email, TRUE AS is_active FROM payment""",
)
def dim_inferred(spark, sf):
    return dims.staff_dimension(b.payment(spark, sf))


@query("distinct_dim", "SELECT DISTINCT store_id, staff_id FROM payment")
def distinct_dim(spark, sf):
    return b.payment(spark, sf).dropDuplicates(["store_id", "staff_id"]).select("store_id", "staff_id")


@query(
    "staff_performance",
    """SELECT *, CASE tile WHEN 1 THEN 'Top' WHEN 2 THEN 'High' WHEN 3 THEN 'Average' ELSE 'Low' END AS performance_tier, tile = 1 AS is_top_performer
       FROM (SELECT *, ntile(4) OVER (ORDER BY total_payment_amount DESC, staff_id) AS tile FROM (
         SELECT s.staff_id, s.store_id, coalesce(r.n, 0)::BIGINT AS total_rentals_processed, coalesce(p.n, 0)::BIGINT AS total_payments_processed, coalesce(p.amount, 0)::DOUBLE AS total_payment_amount,
           p.amount::DOUBLE / p.n AS avg_payment_amount, r.n::DOUBLE / r.days AS avg_rentals_per_day, p.n::DOUBLE / p.days AS avg_payments_per_day,
           m.managed_staff_count, m.store_revenue_under_management
         FROM (SELECT s_suppkey AS staff_id, (s_suppkey % 25)::INT AS store_id FROM supplier) s
         LEFT JOIN (SELECT staff_id, count(*) AS n, count(DISTINCT rental_date::DATE) AS days FROM film_rental GROUP BY ALL) r ON s.staff_id = r.staff_id
         LEFT JOIN (SELECT staff_id, count(*) AS n, sum(amount) AS amount, count(DISTINCT payment_date::DATE) AS days FROM payment GROUP BY ALL) p ON s.staff_id = p.staff_id
         LEFT JOIN (SELECT manager_staff_id AS staff_id, coalesce(t.n, 0)::BIGINT AS managed_staff_count, v.revenue::DOUBLE AS store_revenue_under_management FROM store st
            LEFT JOIN (SELECT s_suppkey % 25 AS store_id, count(*) AS n FROM supplier GROUP BY ALL) t ON st.store_id = t.store_id
            LEFT JOIN (SELECT store_id, sum(amount) AS revenue FROM payment GROUP BY ALL) v ON st.store_id = v.store_id) m ON s.staff_id = m.staff_id))""".replace(
        "SELECT *, CASE tile", "SELECT * EXCLUDE (tile), CASE tile"
    ),
)
def staff_performance(spark, sf):
    staff = tables.read_table(spark, sf, "supplier").selectExpr("s_suppkey AS staff_id", "cast(s_suppkey % 25 AS int) AS store_id")
    return dims.staff_performance(staff, b.film_rental(spark, sf), b.payment(spark, sf), b.store(spark, sf))


# --- fact and metrics ----------------------------------------------------------------


@query(
    "fact_rental",
    f"""SELECT rental_id, {key_sql("gl_fact_rental", "rental_id")} AS gl_fact_rental_key, customer_id, rental_date, return_date, rental_date_only, return_date_only,
        {SQL_DATE_KEY.format("rental_date")} AS rental_date_key, {SQL_DATE_KEY.format("return_date")} AS return_date_key, hour(rental_date)::INT AS rental_hour,
        month(rental_date)::INT AS rental_month, quarter(rental_date)::INT AS rental_quarter, year(rental_date)::INT AS rental_year, spent::INT AS rental_duration_actual,
        3::INT AS rental_duration_planned, return_date IS NOT NULL AS is_returned, is_overdue, days_overdue::INT AS days_overdue, amount::DOUBLE AS rental_rate,
        amount::DOUBLE AS revenue_amount, 19.99::DOUBLE AS replacement_cost, dayofweek(rental_date) IN (0, 6) AS is_weekend_rental, FALSE AS is_holiday_rental FROM fact""",
)
def fact_rental(spark, sf):
    return fact(spark, sf).drop("store_id", "film_id", "staff_id", "inventory_id", "amount", "payment_date", "payment_count")


@query(
    "customer_metrics",
    f"""SELECT customer_id, {key_sql("gl_customer_metrics", "customer_id")} AS gl_customer_metrics_key, total_rentals, total_revenue::DOUBLE AS total_revenue, avg_rental_value,
        first_rental_date, last_rental_date, total_revenue::DOUBLE AS customer_lifetime_value, total_rentals::DOUBLE / 12 AS avg_rentals_per_month, customer_score, customer_tier,
        total_revenue >= 2000000 AS is_high_value FROM metrics""",
)
def customer_metrics(spark, sf):
    return metrics(spark, sf)


@query("tier_counts", "SELECT customer_tier, count(*) AS customers, sum(total_revenue)::DOUBLE AS revenue FROM metrics GROUP BY ALL")
def tier_counts(spark, sf):
    return m.tier_counts(metrics(spark, sf))


@query("top_customers", "SELECT customer_id, total_revenue::DOUBLE AS total_revenue, customer_tier FROM metrics ORDER BY metrics.total_revenue DESC, customer_id LIMIT 10")
def top_customers(spark, sf):
    return m.top_customers(metrics(spark, sf)).select("customer_id", "total_revenue", "customer_tier")


def _period_sql(unit):
    now = f"date_trunc('{unit}', rental_date) = date_trunc('{unit}', {DAY})"
    return f"count(*) FILTER ({now}) AS rentals_current_{unit}, coalesce(sum(amount) FILTER ({now}), 0)::DOUBLE AS payments_current_{unit}"


@query(
    "period_to_date",
    f"""SELECT customer_id, count(*) AS rentals_to_date, sum(amount)::DOUBLE AS total_payments, {", ".join(_period_sql(u) for u in ("month", "quarter", "year"))}
        FROM fact WHERE rental_date::DATE <= {DAY} GROUP BY customer_id""",
)
def period_to_date(spark, sf):
    return m.period_to_date(fact(spark, sf), b.as_of_date())


@query(
    "customer_lifecycle",
    f"""SELECT customer_id, date_diff('day', min(rental_date)::DATE, {DAY})::INT AS customer_age_days, date_diff('day', max(rental_date)::DATE, {DAY})::INT AS days_since_last_rental,
        date_diff('day', max(rental_date)::DATE, {DAY}) <= 90 AS is_active_customer FROM fact GROUP BY customer_id""",
)
def customer_lifecycle(spark, sf):
    return m.lifecycle(b.rental(spark, sf), b.as_of_date())


SQL_GAPS = """SELECT customer_id, avg(gap) AS avg_days_between_rentals FROM (SELECT customer_id, date_diff('day',
    lag(rental_date::DATE) OVER (PARTITION BY customer_id ORDER BY rental_date, rental_id), rental_date::DATE) AS gap FROM rental) GROUP BY customer_id"""


@query(
    "return_behaviour",
    f"""SELECT f.customer_id, count(*) FILTER (is_overdue) AS total_late_returns, count(*) FILTER (is_overdue)::DOUBLE / nullif(count(return_date), 0) AS late_return_rate,
        sum(CASE WHEN return_date IS NOT NULL THEN days_overdue END)::DOUBLE / nullif(count(return_date), 0) AS avg_return_delay_days, count(*) FILTER (return_date IS NULL) AS open_rentals,
        count(*) FILTER (return_date IS NULL AND rental_date::DATE + 3 < {DAY}) AS overdue_rentals_current, sum(days_overdue)::BIGINT AS total_overdue_fees, any_value(g.avg_days_between_rentals) AS avg_days_between_rentals
        FROM fact f JOIN ({SQL_GAPS}) g ON f.customer_id = g.customer_id GROUP BY f.customer_id""",
)
def return_behaviour(spark, sf):
    return m.return_behaviour(timed_rentals(spark, sf), b.as_of_date())


@query(
    "churn_rule",
    f"""SELECT g.customer_id, since AS days_since_last_rental, g.avg_days_between_rentals, CASE WHEN g.avg_days_between_rentals <> 0 THEN least(since / g.avg_days_between_rentals / 4, 1.0) END AS churn_risk_score,
        CASE WHEN g.avg_days_between_rentals IS NOT NULL THEN greatest(ceil(g.avg_days_between_rentals - since), 0)::INT END AS next_rental_prediction_days
        FROM ({SQL_GAPS}) g JOIN (SELECT customer_id, date_diff('day', max(rental_date)::DATE, {DAY})::INT AS since FROM rental GROUP BY ALL) s ON g.customer_id = s.customer_id""",
)
def churn_rule(spark, sf):
    return m.churn_rule(b.rental(spark, sf), b.as_of_date())


@query(
    "value_rank",
    """SELECT customer_id, total_revenue::DOUBLE AS total_revenue, rank() OVER (ORDER BY metrics.total_revenue DESC) AS customer_value_rank,
       percent_rank() OVER (ORDER BY metrics.total_revenue DESC) AS percent_rank,
       ceil((count(*) OVER () - rank() OVER (ORDER BY metrics.total_revenue DESC) + 1) * 100 / count(*) OVER ())::INT AS customer_value_percentile FROM metrics""",
)
def value_rank(spark, sf):
    return m.value_rank(metrics(spark, sf))


@query(
    "rental_count_rank",
    """SELECT customer_id, total_rentals, rank() OVER (ORDER BY total_rentals DESC) AS customer_value_rank, percent_rank() OVER (ORDER BY total_rentals DESC) AS percent_rank,
       ceil((count(*) OVER () - rank() OVER (ORDER BY total_rentals DESC) + 1) * 100 / count(*) OVER ())::INT AS customer_value_percentile FROM metrics""",
)
def rental_count_rank(spark, sf):
    """The same ranking over a measure with very many ties."""
    return m.value_rank(metrics(spark, sf), "total_rentals")


SQL_RFM = f"""SELECT customer_id, date_diff('day', max(rental_date)::DATE, {DAY})::INT AS recency_days, count(*) AS frequency, sum(amount) AS monetary FROM fact GROUP BY customer_id"""


@query(
    "rfm_segments",
    f"""SELECT *, CASE WHEN r_score >= 4 AND f_score >= 4 AND m_score >= 4 THEN 'Champions' WHEN f_score >= 4 AND r_score >= 3 THEN 'Loyal' WHEN r_score >= 4 AND f_score <= 2 THEN 'New'
        WHEN r_score <= 2 AND f_score >= 3 THEN 'At Risk' WHEN r_score <= 2 THEN 'Hibernating' ELSE 'Regular' END AS segment FROM (
        SELECT customer_id, recency_days, frequency, q.monetary::DOUBLE AS monetary, ntile(5) OVER (ORDER BY -recency_days, customer_id)::INT AS r_score,
          ntile(5) OVER (ORDER BY frequency, customer_id)::INT AS f_score, ntile(5) OVER (ORDER BY q.monetary, customer_id)::INT AS m_score FROM ({SQL_RFM}) q)""",
)
def rfm_segments(spark, sf):
    return m.rfm_segments(fact(spark, sf), b.as_of_date())


@query(
    "cohort_retention",
    """SELECT cohort_month, month_offset, customers, first_value(customers) OVER (PARTITION BY cohort_month ORDER BY month_offset) AS cohort_size,
       customers::DOUBLE / first_value(customers) OVER (PARTITION BY cohort_month ORDER BY month_offset) AS retention_rate FROM (
       SELECT f.first_month::DATE AS cohort_month, date_diff('month', f.first_month, date_trunc('month', r.rental_date))::INT AS month_offset, count(DISTINCT r.customer_id) AS customers
       FROM rental r JOIN (SELECT customer_id, date_trunc('month', min(rental_date)) AS first_month FROM rental GROUP BY ALL) f ON r.customer_id = f.customer_id GROUP BY ALL)""",
)
def cohort_retention(spark, sf):
    return m.cohort_retention(b.rental(spark, sf))


SQL_GENRES = "SELECT r.customer_id, f.rating AS genre, count(*) AS n FROM film_rental r JOIN film f ON r.film_id = f.film_id GROUP BY ALL"


def visits(spark, sf):
    return joins.denormalize(b.film_rental(spark, sf), [(b.film(spark, sf), {"film_id": "film_id"}, {"genre": "rating"})])


@query(
    "behaviour_profile",
    f"""SELECT d.customer_id, d.preferred_rental_day, h.preferred_rental_hour, l.store_loyalty_score, g.most_rented_genre, g.genre_diversity_score FROM
        (SELECT customer_id, first(dn ORDER BY n DESC, dn) AS preferred_rental_day FROM (SELECT customer_id, dayname(rental_date) AS dn, count(*) AS n FROM rental GROUP BY ALL) GROUP BY ALL) d
        JOIN (SELECT customer_id, first(h ORDER BY n DESC, h)::INT AS preferred_rental_hour FROM (SELECT customer_id, hour(rental_date) AS h, count(*) AS n FROM rental GROUP BY ALL) GROUP BY ALL) h ON d.customer_id = h.customer_id
        JOIN (SELECT customer_id, max(n)::DOUBLE / sum(n)::DOUBLE AS store_loyalty_score FROM (SELECT customer_id, store_id, count(*) AS n FROM rental GROUP BY ALL) GROUP BY ALL) l ON d.customer_id = l.customer_id
        LEFT JOIN (SELECT customer_id, first(genre ORDER BY n DESC, genre) AS most_rented_genre,
          round(CASE WHEN count(*) = 1 THEN 0 ELSE (ln(sum(n)) - sum(n * ln(n)) / sum(n)) / ln(count(*)) END, 6) AS genre_diversity_score FROM ({SQL_GENRES}) GROUP BY ALL) g ON d.customer_id = g.customer_id""",
)
def behaviour_profile(spark, sf):
    return m.behaviour_profile(visits(spark, sf))


@query(
    "preferred_day",
    "SELECT customer_id, first(dn ORDER BY n DESC, dn) AS preferred_rental_day FROM (SELECT customer_id, dayname(rental_date) AS dn, count(*) AS n FROM rental GROUP BY ALL) GROUP BY ALL",
)
def preferred_day(spark, sf):
    days = b.rental(spark, sf).withColumn("_day", F.date_format("rental_date", "EEEE"))
    return dims.top_value(days, "customer_id", "_day", "preferred_rental_day")


@query("top_category", f"SELECT customer_id, first(genre ORDER BY n DESC, genre) AS most_rented_genre FROM ({SQL_GENRES}) GROUP BY ALL")
def top_category(spark, sf):
    return dims.top_value(visits(spark, sf), "customer_id", "genre", "most_rented_genre")


@query(
    "distinct_exact",
    "SELECT store_id, count(DISTINCT customer_id) AS customers, count(DISTINCT film_id) AS films FROM customer_payment GROUP BY ALL",
)
def distinct_exact(spark, sf):
    return distinct.distinct_counts(b.customer_payment(spark, sf), ["store_id"], {"customers": "customer_id", "films": "film_id"})


@query(
    "distinct_approx",
    """SELECT store_id, count(DISTINCT customer_id) AS customers_exact, count(DISTINCT film_id) AS films_exact, TRUE AS customers_inside, TRUE AS films_inside FROM customer_payment GROUP BY ALL""",
)
def distinct_approx(spark, sf):
    """Estimates from sketches that were stored per store and month and united; are they inside their stated error."""
    rows = b.customer_payment(spark, sf).withColumn("month", F.trunc("payment_date", "month"))
    stored = pin(distinct.sketches(rows, ["store_id", "month"], {"customers": "customer_id", "films": "film_id"}), "sketches")
    told = distinct.united(stored, ["store_id"], ["customers", "films"])
    return distinct_exact(spark, sf).join(told, "store_id").select("store_id", *_inside("customers", "films"))


def _inside(*names):
    """Exact counts, and whether the estimate is within the error that is stated for it."""
    exact = [F.col(n).alias(f"{n}_exact") for n in names]
    return exact + [(F.abs(F.col(f"{n}_estimate") - F.col(n)) <= F.ceil(F.col(n) * distinct.error())).alias(f"{n}_inside") for n in names]


@query(
    "distinct_rolling",
    """SELECT s.store_id, s.month, count(DISTINCT p.customer_id) AS customers_exact, TRUE AS customers_inside
       FROM (SELECT DISTINCT store_id, date_trunc('month', payment_date)::DATE AS month FROM customer_payment) s
       JOIN customer_payment p ON p.store_id = s.store_id AND p.payment_date >= s.month - INTERVAL 2 MONTH AND p.payment_date < s.month + INTERVAL 1 MONTH GROUP BY ALL""",
)
def distinct_rolling(spark, sf):
    """Customers of the last three months at every month, from one stored sketch per store and month."""
    rows = b.customer_payment(spark, sf).withColumn("month", F.trunc("payment_date", "month"))
    stored = pin(distinct.sketches(rows, ["store_id", "month"], {"customers": "customer_id"}), "sketches")
    told = distinct.rolling(stored, ["store_id"], "month", 3, ["customers"])
    # The exact counts say how good the estimates are; they go over one row per store and customer.
    exact = distinct.rolling_counts(rows, ["store_id"], "month", 3, "customer_id", "customers")
    return told.join(exact, ["store_id", "month"]).select("store_id", "month", *_inside("customers"))


# --- silver --------------------------------------------------------------------------


@query(
    "silver_customer",
    f"""SELECT {key_sql("sl_customer", "customer_id")} AS sl_customer_key, customer_id, store_id, first_name, last_name, email, address_id, activebool, create_date, active,
        {SQL_SCORE}::DOUBLE AS sl_data_quality_score, TIMESTAMP '{LOAD}' AS sl_created_time, TIMESTAMP '{LOAD}' AS sl_updated_time,
        {key_sql("br_customer", "row_id")} AS sl_source_bronze_key, TRUE AS sl_is_active, 's1' AS sl_batch_id FROM ({SQL_CLEAN_CUSTOMER})""",
)
def silver_customer(spark, sf):
    landed = tables.to_strings(b.bronze_customer(spark, sf))
    bronze = add_bronze_audit(landed, "customer", "source.customer", "b1", _load_time(), ["row_id"])
    return silver.silver_entity(bronze, silver.CUSTOMER, "s1", _load_time())


@query(
    "silver_part",
    f"""SELECT {key_sql("sl_film", "film_id")} AS sl_film_key, film_id::INT AS film_id, title, release_year::INT AS release_year, language_id, rental_duration::INT AS rental_duration,
        rental_rate::DOUBLE AS rental_rate, length, replacement_cost::DOUBLE AS replacement_cost, rating, nullif(trim(special_features), '') AS special_features,
        (rental_rate * 10)::DOUBLE AS sl_revenue_potential, release_year >= 2005 AS sl_is_new_release, CASE WHEN length <= 15 THEN 'Short' WHEN length <= 35 THEN 'Medium' ELSE 'Long' END AS sl_length_category,
        1.0::DOUBLE AS sl_data_quality_score, NULL::VARCHAR AS sl_source_bronze_key FROM film""",
)
def silver_part(spark, sf):
    rows = silver.silver_entity(tables.to_strings(b.film(spark, sf)), silver.film(15, 35), "s1", _load_time())
    return rows.drop("sl_created_time", "sl_updated_time", "sl_is_active", "sl_batch_id")


@query(
    "silver_language",
    f"SELECT {key_sql('sl_language', 'language_id')} AS sl_language_key, language_id, name, 1.0::DOUBLE AS sl_data_quality_score FROM language",
)
def silver_language(spark, sf):
    rows = silver.silver_entity(tables.to_strings(b.language(spark, sf)), silver.LANGUAGE, "s1", _load_time())
    return rows.select("sl_language_key", "language_id", "name", "sl_data_quality_score")


@query(
    "silver_rental",
    f"""SELECT {key_sql("sl_rental", "rental_id")} AS sl_rental_key, rental_id, rental_date, customer_id::INT AS customer_id, return_date, 1.0::DOUBLE AS sl_data_quality_score FROM rental""",
)
def silver_rental(spark, sf):
    rows = silver.silver_entity(tables.to_strings(b.rental(spark, sf)), silver.RENTAL, "s1", _load_time())
    return rows.select("sl_rental_key", "rental_id", "rental_date", "customer_id", "return_date", "sl_data_quality_score")


@query(
    "silver_payment",
    f"""SELECT {key_sql("sl_payment", "rental_id * 10 + line_number")} AS sl_payment_key, rental_id * 10 + line_number AS payment_id, rental_id, staff_id::INT AS staff_id,
        amount::DOUBLE AS amount, payment_date, 1.0::DOUBLE AS sl_data_quality_score FROM payment""",
)
def silver_payment(spark, sf):
    landed = tables.to_strings(b.payment(spark, sf).withColumn("payment_id", F.expr("rental_id * 10 + line_number")))
    rows = silver.silver_entity(landed, silver.PAYMENT, "s1", _load_time())
    return rows.select("sl_payment_key", "payment_id", "rental_id", "staff_id", "amount", "payment_date", "sl_data_quality_score")


@query(
    "dim_address",
    f"""SELECT DISTINCT try_cast(address_id AS INT) AS address_id, {key_sql("sl_address", "try_cast(address_id AS INT)")} AS sl_address_key, '123 Main St' AS address, NULL::VARCHAR AS address2,
        'Central' AS district, 1::INT AS city_id, '12345' AS postal_code, '555-0123' AS phone FROM bronze_customer WHERE try_cast(address_id AS INT) IS NOT NULL""",
)
def dim_address(spark, sf):
    rows = silver.inferred_entity(b.bronze_customer(spark, sf), "address", "address_id", silver.placeholder_address(_load_time()), "s1", _load_time())
    return rows.select("address_id", "sl_address_key", "address", "address2", "district", "city_id", "postal_code", "phone")


@query(
    "silver_store",
    f"SELECT DISTINCT c_nationkey AS store_id, {key_sql('sl_store', 'c_nationkey')} AS sl_store_key, 1::INT AS manager_staff_id, c_nationkey AS address_id FROM customer",
)
def silver_store(spark, sf):
    defaults = {"manager_staff_id": F.lit(1), "address_id": F.col("store_id")}
    rows = silver.inferred_entity(b.bronze_customer(spark, sf), "store", "store_id", defaults, "s1", _load_time())
    return rows.select("store_id", "sl_store_key", "manager_staff_id", "address_id")


@query(
    "silver_enriched",
    f"""SELECT c.customer_id, coalesce(a.total_rentals, 0) AS sl_rental_count, a.last_rental_date AS sl_last_rental_date, coalesce(p.total_payments, 0)::DOUBLE AS sl_lifetime_value
        FROM b_customer c LEFT JOIN ({SQL_ACTIVITY}) a ON c.customer_id = a.customer_id LEFT JOIN ({SQL_SPENDING}) p ON c.customer_id = p.customer_id""",
)
def silver_enriched(spark, sf):
    base = b.customer(spark, sf).select("customer_id")
    return silver.enrich_customer(base, b.rental(spark, sf), b.customer_payment(spark, sf))


# --- quality -------------------------------------------------------------------------


def _bronze(spark, sf):
    rows = tables.to_strings(b.bronze_customer(spark, sf))
    late = F.when(F.col("row_id") % 50 == 0, "other").otherwise("b1")
    landed = add_bronze_audit(rows, "customer", "source.customer", "b1", _load_time(), ["row_id"])
    return landed.withColumn("br_batch_id", late)


@query(
    "bronze_validate",
    """SELECT count(*) AS total_rows, count(*) AS rows_with_load_time, count(*) FILTER (c_custkey % 50 <> 0) AS rows_in_batch,
       count(*) = count(*) FILTER (c_custkey % 50 <> 0) AS passed FROM customer""",
)
def bronze_validate(spark, sf):
    return quality.bronze_check(_bronze(spark, sf), "b1")


@query(
    "null_checks",
    """SELECT 'br_customer' AS table_name, count(*) AS total_rows, count(*) FILTER (email IS NULL) AS null_source_ids, 0::BIGINT AS missing_hashes, count(*) AS current_rows FROM bronze_customer""",
)
def null_checks(spark, sf):
    return quality.null_check(_bronze(spark, sf), "br_customer", "email")


@query(
    "batch_counts",
    "SELECT CASE WHEN c_custkey % 50 = 0 THEN 'other' ELSE 'b1' END AS br_batch_id, count(*) AS records FROM customer GROUP BY ALL",
)
def batch_counts(spark, sf):
    return _bronze(spark, sf).groupBy("br_batch_id").agg(F.count(F.lit(1)).alias("records"))


@query(
    "latest_batches",
    """SELECT 'batch-' || strftime(o_orderdate, '%Y%m') AS br_batch_id, date_trunc('month', o_orderdate)::TIMESTAMP AS br_load_time, count(*) AS records
       FROM orders GROUP BY ALL ORDER BY br_load_time DESC LIMIT 5""",
)
def latest_batches(spark, sf):
    month = F.date_trunc("month", "o_orderdate")
    batch = F.concat(F.lit("batch-"), F.date_format("o_orderdate", "yyyyMM"))
    orders = tables.read_table(spark, sf, "orders")
    batches = orders.groupBy(batch.alias("br_batch_id"), month.alias("br_load_time")).agg(F.count(F.lit(1)).alias("records"))
    return batches.orderBy(F.desc("br_load_time")).limit(5)


@query(
    "layer_counts",
    """SELECT 'sl_customer' AS table_name, count(*) AS row_count, count(*) > 0 AS has_rows FROM customer
       UNION ALL SELECT 'sl_film', count(*), count(*) > 0 FROM part UNION ALL SELECT 'gl_fact_payment', count(*), count(*) > 0 FROM lineitem
       UNION ALL SELECT 'sl_nothing', 0, FALSE""",
)
def layer_counts(spark, sf):
    return quality.table_counts(
        {
            "sl_customer": b.customer(spark, sf),
            "sl_film": b.film(spark, sf),
            "gl_fact_payment": b.payment(spark, sf),
            "sl_nothing": b.film(spark, sf).where("film_id < 0"),
        }
    )


@query(
    "upstream_ready",
    """SELECT 'customer' AS table_name, CASE WHEN count(*) > 0 THEN 'ready' ELSE 'empty' END AS status FROM customer
       UNION ALL SELECT 'rental', CASE WHEN count(*) > 0 THEN 'ready' ELSE 'empty' END FROM orders
       UNION ALL SELECT 'nothing', CASE WHEN count(*) > 0 THEN 'ready' ELSE 'empty' END FROM part WHERE p_partkey < 0
       UNION ALL SELECT 'payment', 'missing'""",
)
def upstream_ready(spark, sf):
    found = {"customer": b.customer(spark, sf), "rental": b.rental(spark, sf), "nothing": b.film(spark, sf).where("film_id < 0")}
    return quality.readiness(found, ["customer", "rental", "nothing", "payment"])


@query(
    "fact_report",
    """SELECT count(*) AS total_facts, count(DISTINCT customer_id) AS unique_customers, count(DISTINCT film_id) AS unique_films, count(*) FILTER (amount > 0) AS revenue_facts,
       sum(amount)::DOUBLE / count(*) AS avg_rate FROM fact""",
)
def fact_report(spark, sf):
    return quality.fact_check(fact(spark, sf), {"unique_customers": "customer_id", "unique_films": "film_id"}, "revenue_amount", "rental_rate")


@query(
    "dq_report",
    f"""SELECT count(*) AS total_rows, sum(s)::DOUBLE / count(*) AS avg_quality_score, count(*) FILTER (s >= 0.8) AS high_quality_rows
        FROM (SELECT {SQL_SCORE} AS s FROM ({SQL_CLEAN_CUSTOMER}))""",
)
def dq_report(spark, sf):
    rows = silver.silver_entity(b.bronze_customer(spark, sf), silver.CUSTOMER, "s1", _load_time())
    return quality.score_check(rows, "sl_data_quality_score")


@query(
    "customer_report",
    f"""SELECT count(*) AS total_customers, sum(coalesce(a.total_rentals, 0))::DOUBLE / count(*) AS avg_rentals, sum(coalesce(p.total_payments, 0))::DOUBLE / count(*) AS avg_payments,
        count(*) FILTER (p.total_payments >= 2500000) AS top_tier_customers FROM b_customer c LEFT JOIN ({SQL_ACTIVITY}) a ON c.customer_id = a.customer_id
        LEFT JOIN ({SQL_SPENDING}) p ON c.customer_id = p.customer_id""",
)
def customer_report(spark, sf):
    dim = dims.customer_dimension(
        b.customer(spark, sf), b.address(spark, sf), b.store(spark, sf), b.rental(spark, sf), b.customer_payment(spark, sf), b.as_of_date(), TIER_BOUNDS
    )
    return quality.customer_check(dim)


@query(
    "accepted_values",
    """SELECT 'event_type' AS column_name, count(*) FILTER (event_type NOT IN ('rental_start', 'rental_return', 'payment_processed', 'customer_signup')) AS violations FROM biz_events
       UNION ALL SELECT 'severity', count(*) FILTER (severity NOT IN ('info', 'warning')) FROM biz_events""",
)
def accepted_values(spark, sf):
    allowed = {
        "event_type": ["rental_start", "rental_return", "payment_processed", "inventory_low", "customer_signup", "customer_update"],
        "severity": ["info", "warning"],
    }
    return quality.accepted_values(b.events(spark, sf), allowed)


@query("duplicate_keys", "SELECT l_orderkey, l_linenumber, count(*) AS occurrences FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def duplicate_keys(spark, sf):
    return quality.duplicates(tables.read_table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "reconcile_except",
    """WITH src AS (SELECT rental_id, line_number, amount FROM payment), tgt AS (SELECT rental_id, line_number, amount::DECIMAL(18,2)::DECIMAL(18,4) AS amount FROM payment WHERE amount >= 1000)
       SELECT (SELECT count(*) FROM src) AS source_rows, (SELECT count(*) FROM tgt) AS target_rows, (SELECT count(*) FROM (FROM src EXCEPT ALL FROM tgt)) AS only_in_source,
       (SELECT count(*) FROM (FROM tgt EXCEPT ALL FROM src)) AS only_in_target""",
)
def reconcile_except(spark, sf):
    source = b.payment(spark, sf).select("rental_id", "line_number", "amount")
    # The target lost small payments and fractions of a cent.
    target = source.where("amount >= 1000").withColumn("amount", F.col("amount").cast("decimal(18,2)").cast("decimal(18,4)"))
    return quality.reconcile(source, target)


@query(
    "assign_lsn",
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, row_number() OVER (ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_tax) + 500 AS lsn FROM lineitem",
)
def assign_lsn(spark, sf):
    order = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_tax"]
    lines = tables.read_table(spark, sf, "lineitem").select(order)
    return ordered.number_rows(lines, order, "lsn", start=500).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "lsn")
