"""The rental domain on the given tables, once as DataFrames and once as SQL.

rental = orders, payment = lineitem, film = part, store = nation, staff = supplier,
change log and business events = events. The tables hold no dirt, so blanks, bad numbers
and open rentals are made by expressions over whole tables.
"""

from __future__ import annotations

import re
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.operators.kpi import business_events
from stratalake.sources.tables import read_table

# The instants that stand for "now".
AS_OF_DATE = "2001-06-30"
AS_OF_TIME = "2024-01-20 12:00:00"
# Event type of the tables -> business event.
EVENT_TYPES = {
    "view": "rental_start",
    "click": "rental_return",
    "purchase": "payment_processed",
    "signup": "customer_signup",
}


def as_of_date():
    return F.to_date(F.lit(AS_OF_DATE))


def as_of_time():
    return F.lit(AS_OF_TIME).cast("timestamp")


def bronze_customer(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "customer").selectExpr(
        "CASE WHEN c_custkey % 101 = 0 THEN 'n/a' ELSE cast(c_custkey AS string) END AS customer_id",
        "cast(c_nationkey AS string) AS store_id",
        "CASE WHEN c_custkey % 11 = 0 THEN ' ' ELSE concat(' ', c_mktsegment, ' ') END AS first_name",
        "substr(c_name, 10) AS last_name",
        """CASE WHEN c_custkey % 7 = 0 THEN '  ' WHEN c_custkey % 13 = 0 THEN NULL
                ELSE concat(' ', c_name, '@Example.COM ') END AS email""",
        "CASE WHEN c_custkey % 17 = 0 THEN 'bad' ELSE cast(c_custkey % 997 AS string) END AS address_id",
        """CASE c_custkey % 5 WHEN 0 THEN 'true' WHEN 1 THEN 'FALSE' WHEN 2 THEN ' True '
                WHEN 3 THEN NULL ELSE 'x' END AS activebool""",
        "CASE WHEN c_custkey % 19 = 0 THEN '2020-13-45' ELSE '2020-02-03' END AS create_date",
        "cast(c_custkey % 2 AS string) AS active",
        "cast(cast(c_acctbal AS decimal(18,2)) AS string) AS balance",
        "c_custkey AS row_id",
    )


def customer(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "customer").selectExpr(
        "c_custkey AS customer_id",
        "c_nationkey AS store_id",
        "c_mktsegment AS first_name",
        "substr(c_name, 10) AS last_name",
        "cast(c_custkey % 997 AS int) AS address_id",
    )


def film(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "part").selectExpr(
        "p_partkey AS film_id",
        "p_name AS title",
        "2000 + p_size % 10 AS release_year",
        "CASE WHEN p_size > 45 THEN 99 ELSE cast(substr(p_brand, 7) AS int) END AS language_id",
        "3 + p_size % 5 AS rental_duration",
        "cast(p_size AS decimal(18,4)) / 10 AS rental_rate",
        "p_size AS length",
        "cast(p_retailprice AS decimal(18,2)) AS replacement_cost",
        "p_type AS rating",
        """CASE p_size % 4 WHEN 0 THEN 'Trailers,Commentaries' WHEN 1 THEN ' Deleted Scenes ' WHEN 2 THEN ' '
                ELSE 'Trailers, Deleted Scenes,Behind the Scenes' END AS special_features""",
    ).withColumn("rental_rate", F.col("rental_rate").cast("decimal(18,4)"))


def language(spark: SparkSession, folder: str) -> DataFrame:
    """Languages are the brands; language 99 stays unknown to the lookup."""
    brands = read_table(spark, folder, "part").select(F.col("p_brand").alias("name")).distinct()
    return brands.selectExpr("cast(substr(name, 7) AS int) AS language_id", "name")


def store(spark: SparkSession, folder: str) -> DataFrame:
    nation, region = read_table(spark, folder, "nation"), read_table(spark, folder, "region")
    joined = nation.join(region, nation["n_regionkey"] == region["r_regionkey"])
    return joined.selectExpr(
        "n_nationkey AS store_id",
        "n_name AS address",
        "r_name AS city",
        "concat('Manager ', n_name) AS manager_name",
        "n_nationkey % 6 <> 5 AS is_active",
        "n_nationkey * 2 AS address_id",
        "cast(n_nationkey * 3 AS bigint) AS manager_staff_id",
    )


def address(spark: SparkSession, folder: str) -> DataFrame:
    """Addresses come from suppliers; ids beyond them stay unknown."""
    return read_table(spark, folder, "supplier").selectExpr(
        "cast(s_suppkey AS int) AS address_id",
        "s_name AS address",
        "cast(NULL AS string) AS address2",
        "concat('District ', s_nationkey) AS district",
        "CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE cast(10000 + s_suppkey AS string) END AS postal_code",
        "concat('555-', s_suppkey) AS phone",
    )


def rental(spark: SparkSession, folder: str) -> DataFrame:
    return (
        read_table(spark, folder, "orders")
        .selectExpr(
            "o_orderkey AS rental_id",
            "o_custkey AS customer_id",
            "cast(o_custkey % 25 AS int) AS store_id",
            "o_orderstatus",
            "timestampadd(HOUR, cast(o_orderkey % 24 AS int), o_orderdate) AS rental_date",
        )
        .selectExpr(
            "rental_id",
            "customer_id",
            "store_id",
            "rental_date",
            """CASE WHEN o_orderstatus <> 'O' THEN timestampadd(HOUR,
                 cast(rental_id % 8 * 24 + rental_id % 5 AS int), rental_date) END AS return_date""",
        )
    )


def payment(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "lineitem").selectExpr(
        "l_orderkey AS rental_id",
        "l_linenumber AS line_number",
        "l_partkey AS film_id",
        "l_suppkey AS staff_id",
        "cast(l_suppkey % 25 AS int) AS store_id",
        # Whole cents times whole percent is exact and far cheaper than decimals made from doubles.
        """cast(cast(cast(round(l_extendedprice * 100) AS bigint) * (100 - cast(round(l_discount * 100) AS bigint))
                AS decimal(18,0)) * 0.0001BD AS decimal(18,4)) AS amount""",
        "l_shipdate AS payment_date",
    )


def customer_payment(spark: SparkSession, folder: str) -> DataFrame:
    payer = rental(spark, folder).select("rental_id", "customer_id")
    return payment(spark, folder).join(payer, "rental_id")


def film_rental(spark: SparkSession, folder: str) -> DataFrame:
    """Rentals with film, copy and staff: eight rentals in a row share a film, 150 a staff member."""
    return rental(spark, folder).withColumns(
        {
            "film_id": F.expr("rental_id div 8"),
            "staff_id": F.expr("rental_id div 150"),
            "inventory_id": F.expr("rental_id div 8 * 4 + rental_id % 4"),
        }
    )


def change_log(spark: SparkSession, folder: str) -> DataFrame:
    amount = "cast(value AS decimal(18,2))"
    return read_table(spark, folder, "events").selectExpr(
        "event_id AS lsn",
        "CASE event_type WHEN 'signup' THEN 'I' WHEN 'error' THEN 'D' ELSE 'U' END AS op",
        f"to_json(named_struct('user_id', cast(user_id AS string), 'amount', cast({amount} AS string), "
        "'k', get_json_object(props, '$.k'), 'at', cast(cast(ts AS date) AS string))) AS full_row",
        "ts AS load_ts",
        "user_id",
        f"{amount} AS amount",
        "event_type",
    )


def raw_events(df: DataFrame) -> DataFrame:
    """Store, customer, severity and utilisation of the raw event columns."""
    return df.selectExpr(
        "event_id",
        "ts",
        "cast(user_id % 10 + 1 AS int) AS store_id",
        "user_id AS customer_id",
        "event_type",
        "cast(value AS decimal(18,2)) AS amount",
        "CASE WHEN value >= 20 THEN 'critical' WHEN value >= 5 THEN 'warning' ELSE 'info' END AS severity",
        "cast(get_json_object(props, '$.k') AS int) AS utilization",
    )


def events(spark: SparkSession, folder: str, since: str | None = None, before: str | None = None) -> DataFrame:
    raw = read_table(spark, folder, "events", "ts", since, before)
    return business_events(raw_events(raw), EVENT_TYPES, "events")


def alert_events(spark: SparkSession, folder: str, since: str | None = None, before: str | None = None) -> DataFrame:
    """Alerts are the error events; acknowledgement and resolution follow from the id."""
    return (
        events(spark, folder, since, before)
        .where("event_type = 'error'")
        .selectExpr(
            "event_id AS alert_id",
            "ts AS alert_timestamp",
            "concat('rule-', event_id % 4) AS rule_id",
            "severity",
            "store_id",
            "amount AS source_value",
            "CASE WHEN event_id % 3 = 0 THEN timestampadd(MINUTE, cast(event_id % 50 AS int), ts) END AS acknowledged_at",
            "CASE WHEN event_id % 5 = 0 THEN timestampadd(MINUTE, cast(event_id % 300 AS int), ts) END AS resolved_at",
            "event_id % 7 <> 0 AS is_active",
        )
    )


# The alert rules of the bindings.
RULES = [
    (1, "value.payment_processed", "greater_than", 40.0, "critical", None, None, None, 120, True, False),
    (2, "count.rental_start", "less_than", 2.0, "info", None, "business_hours", None, 180, True, False),
    (3, "count.error", "equals", 2.0, "warning", 3, None, None, 60, True, False),
    (4, "count.rental_return", "not_equals", 1.0, "info", None, None, "weekends", 240, True, False),
    (5, "value.error", "percentage_change", 50.0, "warning", None, "after_hours", "weekdays", 60, True, False),
    (6, "value.rental_start", "anomaly_detected", None, "critical", None, None, None, 600, True, False),
    (7, "count.customer_signup", "missing_data", None, "warning", None, None, None, 60, True, False),
    (8, "value.payment_processed", "greater_than", 10.0, "info", None, None, None, 60, False, False),
    (9, "value.payment_processed", "greater_than", 10.0, "info", None, None, None, 60, True, True),
]
RULE_SCHEMA = (
    "rule_id int, target_metric string, condition_type string, threshold_value decimal(18,4), "
    "default_severity string, store_filter int, time_of_day_filter string, day_of_week_filter string, "
    "suppress_duplicate_minutes int, is_active boolean, is_test_mode boolean"
)


def rules(spark: SparkSession) -> DataFrame:
    rows = [(*r[:3], None if r[3] is None else Decimal(str(r[3])), *r[4:]) for r in RULES]
    return spark.createDataFrame(rows, RULE_SCHEMA)


def _literal(value) -> str:
    if value is None:
        return "NULL"
    return f"'{value}'" if isinstance(value, str) else str(value).upper()


_RULE_ROWS = ", ".join("(" + ", ".join(_literal(v) for v in r) + ")" for r in RULES)

# The same bindings in SQL; a name used in a query pulls in its text and what that needs.
SQL = {
    "bronze_customer": """
        SELECT CASE WHEN c_custkey % 101 = 0 THEN 'n/a' ELSE c_custkey::VARCHAR END AS customer_id,
          c_nationkey::VARCHAR AS store_id,
          CASE WHEN c_custkey % 11 = 0 THEN ' ' ELSE ' ' || c_mktsegment || ' ' END AS first_name,
          substr(c_name, 10) AS last_name,
          CASE WHEN c_custkey % 7 = 0 THEN '  ' WHEN c_custkey % 13 = 0 THEN NULL
            ELSE ' ' || c_name || '@Example.COM ' END AS email,
          CASE WHEN c_custkey % 17 = 0 THEN 'bad' ELSE (c_custkey % 997)::VARCHAR END AS address_id,
          CASE c_custkey % 5 WHEN 0 THEN 'true' WHEN 1 THEN 'FALSE' WHEN 2 THEN ' True '
            WHEN 3 THEN NULL ELSE 'x' END AS activebool,
          CASE WHEN c_custkey % 19 = 0 THEN '2020-13-45' ELSE '2020-02-03' END AS create_date,
          (c_custkey % 2)::VARCHAR AS active,
          c_acctbal::DECIMAL(18,2)::VARCHAR AS balance, c_custkey AS row_id
        FROM customer""",
    "b_customer": """
        SELECT c_custkey AS customer_id, c_nationkey AS store_id, c_mktsegment AS first_name,
          substr(c_name, 10) AS last_name, (c_custkey % 997)::INT AS address_id FROM customer""",
    "film": """
        SELECT p_partkey AS film_id, p_name AS title, 2000 + p_size % 10 AS release_year,
          CASE WHEN p_size > 45 THEN 99 ELSE substr(p_brand, 7)::INT END AS language_id, 3 + p_size % 5 AS rental_duration,
          (p_size * 0.1::DECIMAL(4,1))::DECIMAL(18,4) AS rental_rate, p_size AS length,
          p_retailprice::DECIMAL(18,2) AS replacement_cost, p_type AS rating,
          CASE p_size % 4 WHEN 0 THEN 'Trailers,Commentaries' WHEN 1 THEN ' Deleted Scenes ' WHEN 2 THEN ' '
            ELSE 'Trailers, Deleted Scenes,Behind the Scenes' END AS special_features
        FROM part""",
    "language": """
        SELECT DISTINCT substr(p_brand, 7)::INT AS language_id, p_brand AS name FROM part""",
    "store": """
        SELECT n_nationkey AS store_id, n_name AS address, r_name AS city, 'Manager ' || n_name AS manager_name,
          n_nationkey % 6 <> 5 AS is_active, n_nationkey * 2 AS address_id,
          (n_nationkey * 3)::BIGINT AS manager_staff_id
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "address_book": """
        SELECT s_suppkey::INT AS address_id, s_name AS address, NULL::VARCHAR AS address2,
          'District ' || s_nationkey AS district,
          CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE (10000 + s_suppkey)::VARCHAR END AS postal_code,
          '555-' || s_suppkey AS phone FROM supplier""",
    "rental": """
        SELECT rental_id, customer_id, store_id, rental_date,
          CASE WHEN st <> 'O' THEN rental_date + to_hours(rental_id % 8 * 24 + rental_id % 5) END AS return_date
        FROM (SELECT o_orderkey AS rental_id, o_custkey AS customer_id, (o_custkey % 25)::INT AS store_id,
                o_orderstatus AS st, o_orderdate + to_hours(o_orderkey % 24) AS rental_date FROM orders)""",
    "payment": """
        SELECT l_orderkey AS rental_id, l_linenumber AS line_number, l_partkey AS film_id, l_suppkey AS staff_id,
          (l_suppkey % 25)::INT AS store_id,
          (l_extendedprice::DECIMAL(18,2) * (1 - l_discount::DECIMAL(4,2)))::DECIMAL(18,4) AS amount,
          l_shipdate AS payment_date FROM lineitem""",
    "customer_payment": """
        SELECT p.*, r.customer_id FROM payment p JOIN rental r ON p.rental_id = r.rental_id""",
    "film_rental": """
        SELECT *, rental_id // 8 AS film_id, rental_id // 150 AS staff_id, rental_id // 8 * 4 + rental_id % 4 AS inventory_id
        FROM rental""",
    "fact": """
        SELECT *, rental_date::DATE AS rental_date_only, return_date::DATE AS return_date_only,
          date_diff('day', rental_date::DATE, return_date::DATE) AS spent,
          greatest(coalesce(date_diff('day', rental_date::DATE, return_date::DATE), 0) - 3, 0) AS days_overdue,
          coalesce(date_diff('day', rental_date::DATE, return_date::DATE) > 3, FALSE) AS is_overdue
        FROM (SELECT r.*, coalesce(p.amount, 2.99)::DECIMAL(18,4) AS amount, coalesce(p.paid, r.rental_date) AS payment_date,
                coalesce(p.n, 0) AS payment_count
              FROM film_rental r LEFT JOIN (SELECT rental_id, sum(amount) AS amount, min(payment_date) AS paid, count(*) AS n
                FROM payment GROUP BY rental_id) p ON r.rental_id = p.rental_id)""",
    "change_log": """
        SELECT event_id AS lsn, CASE event_type WHEN 'signup' THEN 'I' WHEN 'error' THEN 'D' ELSE 'U' END AS op,
          to_json({'user_id': user_id::VARCHAR, 'amount': value::DECIMAL(18,2)::VARCHAR,
            'k': json_extract_string(props, '$.k'), 'at': ts::DATE::VARCHAR})::VARCHAR AS full_row,
          ts AS load_ts, user_id, value::DECIMAL(18,2) AS amount, event_type FROM events""",
    "hist": """
        SELECT user_id, amount, load_ts AS sys_start, nxt AS sys_end FROM (
          SELECT *, coalesce(lead(load_ts) OVER (PARTITION BY user_id ORDER BY lsn),
                             TIMESTAMP '9999-12-31 00:00:00') AS nxt FROM change_log)
        WHERE op <> 'D' AND load_ts < nxt""",
    "biz_events": """
        SELECT event_id, ts, (user_id % 10 + 1)::INT AS store_id, user_id AS customer_id,
          CASE event_type WHEN 'view' THEN 'rental_start' WHEN 'click' THEN 'rental_return'
            WHEN 'purchase' THEN 'payment_processed' WHEN 'signup' THEN 'customer_signup' ELSE event_type END AS event_type,
          value::DECIMAL(18,2) AS amount,
          CASE WHEN value >= 20 THEN 'critical' WHEN value >= 5 THEN 'warning' ELSE 'info' END AS severity,
          json_extract_string(props, '$.k')::INT AS utilization FROM events""",
    "alert_events": """
        SELECT event_id AS alert_id, ts AS alert_timestamp, 'rule-' || (event_id % 4) AS rule_id, severity, store_id,
          amount AS source_value,
          CASE WHEN event_id % 3 = 0 THEN ts + to_minutes(event_id % 50) END AS acknowledged_at,
          CASE WHEN event_id % 5 = 0 THEN ts + to_minutes(event_id % 300) END AS resolved_at,
          event_id % 7 <> 0 AS is_active
        FROM biz_events WHERE event_type = 'error'""",
    "rules": f"""
        SELECT rule_id::INT AS rule_id, target_metric, condition_type, threshold_value::DECIMAL(18,4) AS threshold_value,
          default_severity, store_filter::INT AS store_filter, time_of_day_filter, day_of_week_filter,
          suppress_duplicate_minutes, is_active, is_test_mode
        FROM (VALUES {_RULE_ROWS}) t(rule_id, target_metric, condition_type, threshold_value, default_severity,
          store_filter, time_of_day_filter, day_of_week_filter, suppress_duplicate_minutes, is_active, is_test_mode)""",
    "kpi_hour": """
        SELECT date_trunc('hour', ts) AS kpi_timestamp, store_id,
          count(*) FILTER (event_type = 'rental_start') AS rentals_per_minute,
          count(*) FILTER (event_type = 'rental_return') AS returns_per_minute,
          count(*) FILTER (event_type = 'payment_processed') AS payments_per_minute,
          count(*) FILTER (event_type = 'customer_signup') AS new_customers_per_minute,
          coalesce(sum(amount) FILTER (event_type = 'payment_processed'), 0)::DECIMAL(18,2) AS revenue_per_minute,
          coalesce(sum(amount) FILTER (event_type = 'payment_processed')::DOUBLE
            / nullif(count(*) FILTER (event_type = 'payment_processed'), 0), 0) AS avg_transaction_value,
          sum(utilization)::DOUBLE / count(*) AS inventory_utilization_percent,
          count(DISTINCT customer_id) AS active_customers_count,
          count(*) FILTER (event_type = 'error')::DOUBLE / count(*) * 100 AS error_rate_percent,
          count(*) FILTER (event_type = 'error') > 0 AS has_active_alerts,
          count(*) FILTER (event_type = 'error' AND severity = 'critical') AS critical_alert_count,
          count(*) FILTER (event_type = 'error' AND severity = 'warning') AS warning_alert_count,
          count(*) AS event_count, max(ts) AS last_updated
        FROM biz_events GROUP BY ALL""",
    "series": """
        SELECT captured_at, store_id, metric_name, metric_value::DECIMAL(18,4) AS metric_value FROM (
          SELECT date_trunc('hour', ts) AS captured_at, store_id, 'count.' || event_type AS metric_name,
            count(*)::DECIMAL(18,4) AS metric_value FROM biz_events GROUP BY ALL
          UNION ALL
          SELECT date_trunc('hour', ts), store_id, 'value.' || event_type, sum(amount)::DECIMAL(18,4)
          FROM biz_events GROUP BY ALL)""",
    "series_flagged": """
        SELECT *, (metric_value::DOUBLE - baseline_value) / nullif(baseline_value, 0) * 100 AS deviation_percent,
          (metric_value::DOUBLE - previous_value::DOUBLE) / nullif(previous_value::DOUBLE, 0) * 100 AS change_percent,
          coalesce(abs((metric_value::DOUBLE - baseline_value) / nullif(baseline_value, 0) * 100) > 100, FALSE) AS is_anomaly
        FROM (SELECT *, sum(metric_value) OVER w::DOUBLE / nullif(count(*) OVER w, 0)::DOUBLE AS baseline_value,
                lag(metric_value) OVER (PARTITION BY metric_name, store_id ORDER BY captured_at) AS previous_value
              FROM series
              WINDOW w AS (PARTITION BY metric_name, store_id ORDER BY captured_at ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING))""",
    "fired": """
        SELECT r.rule_id, s.store_id, s.captured_at AS alert_timestamp, s.metric_name, s.metric_value AS source_value,
          r.threshold_value, r.default_severity AS severity
        FROM series_flagged s JOIN rules r ON s.metric_name = r.target_metric
        WHERE r.is_active AND NOT r.is_test_mode
          AND (r.store_filter IS NULL OR r.store_filter = s.store_id)
          AND (r.time_of_day_filter IS NULL
               OR (r.time_of_day_filter = 'business_hours') = (hour(s.captured_at) BETWEEN 9 AND 17))
          AND (r.day_of_week_filter IS NULL
               OR (r.day_of_week_filter = 'weekends') = (dayofweek(s.captured_at) IN (0, 6)))
          AND coalesce(CASE r.condition_type
            WHEN 'greater_than' THEN s.metric_value > r.threshold_value
            WHEN 'less_than' THEN s.metric_value < r.threshold_value
            WHEN 'equals' THEN s.metric_value = r.threshold_value
            WHEN 'not_equals' THEN s.metric_value <> r.threshold_value
            WHEN 'percentage_change' THEN abs(s.change_percent) > r.threshold_value::DOUBLE
            WHEN 'anomaly_detected' THEN s.is_anomaly END, FALSE)""",
    "monthly": """
        SELECT p.store_id, s.address || ', ' || s.city AS store_location,
          date_trunc('month', p.payment_date)::DATE AS revenue_month, sum(p.amount) AS total_revenue,
          count(*) AS total_transactions, sum(p.amount)::DOUBLE / count(*) AS avg_transaction_amount,
          count(DISTINCT p.customer_id) AS unique_customers
        FROM customer_payment p JOIN store s ON p.store_id = s.store_id GROUP BY ALL""",
    "titles": """
        SELECT f.film_id, f.title, f.rating, f.rental_rate, date_trunc('month', r.rental_date)::DATE AS rental_month,
          count(r.rental_id) AS total_rentals, sum(p.amount) AS total_revenue,
          sum(p.amount)::DOUBLE / count(p.amount) AS avg_rental_revenue,
          sum(floor(date_diff('microsecond', r.rental_date, r.return_date) / 86400000000))::DOUBLE
            / nullif(count(r.return_date), 0) AS avg_days_out,
          count(*) FILTER (r.return_date IS NULL) AS currently_rented,
          ((2 * 100 * count(r.rental_id) + count(DISTINCT r.inventory_id)) // (2 * count(DISTINCT r.inventory_id)))::DOUBLE / 100
            AS utilization_rate
        FROM film_rental r JOIN film f ON r.film_id = f.film_id JOIN payment p ON r.rental_id = p.rental_id
        GROUP BY f.film_id, f.title, f.rating, f.rental_rate, date_trunc('month', r.rental_date)""",
    "scorecard": """
        SELECT store_id, store_location, manager_name, business_date, daily_revenue, total_rentals, active_customers,
          late_returns, completed_rentals, unique_titles_rented,
          CASE WHEN completed_rentals > 0 THEN
            ((2 * 10000 * late_returns + completed_rentals) // (2 * completed_rentals))::DOUBLE / 100 END AS late_return_pct,
          ((2 * 100 * rate_sum + 10000 * n) // (2 * 10000 * n))::DOUBLE / 100 AS avg_rental_rate
        FROM (SELECT s.store_id, s.address || ', ' || s.city AS store_location, s.manager_name,
            r.rental_date::DATE AS business_date, coalesce(sum(p.amount), 0)::DECIMAL(18,4) AS daily_revenue,
            count(DISTINCT r.rental_id) AS total_rentals, count(DISTINCT r.customer_id) AS active_customers,
            count(*) FILTER (r.return_date IS NOT NULL
              AND r.return_date::DATE > r.rental_date::DATE + f.rental_duration::INT) AS late_returns,
            count(*) FILTER (r.return_date IS NOT NULL) AS completed_rentals,
            count(DISTINCT r.inventory_id) AS unique_titles_rented,
            sum((f.rental_rate * 10000)::HUGEINT) AS rate_sum, count(*) AS n
          FROM film_rental r JOIN store s ON r.store_id = s.store_id JOIN film f ON r.film_id = f.film_id
          LEFT JOIN payment p ON r.rental_id = p.rental_id
          GROUP BY ALL)""",
    "metrics": """
        SELECT customer_id, count(*) AS total_rentals, sum(amount) AS total_revenue,
          sum(amount)::DOUBLE / count(*) AS avg_rental_value, min(rental_date) AS first_rental_date,
          max(rental_date) AS last_rental_date,
          (count(*) * 3 + sum(amount) * 7)::DOUBLE / 10 AS customer_score,
          CASE WHEN sum(amount) >= 2500000 THEN 'Platinum' WHEN sum(amount) >= 2000000 THEN 'Gold'
            WHEN sum(amount) >= 1500000 THEN 'Silver' ELSE 'Bronze' END AS customer_tier
        FROM fact GROUP BY customer_id""",
}


def with_bindings(sql: str) -> str:
    """``sql`` preceded by the bindings it names, directly or through others."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in SQL:
            if name not in needed and re.search(rf"\b(?:FROM|JOIN)\s+{name}\b", text):
                visit(SQL[name])
                if name not in needed:
                    needed.append(name)

    visit(sql)
    if not needed:
        return sql
    parts = ",\n".join(f"{name} AS ({SQL[name]})" for name in needed)
    head = "WITH RECURSIVE" if "RECURSIVE" in sql else "WITH"
    body = sql.strip().removeprefix("WITH RECURSIVE").strip()
    joiner = ",\n" if "RECURSIVE" in sql or re.match(r"WITH\b", body) else "\n"
    body = re.sub(r"^WITH\b", "", body)
    return f"{head} {parts}{joiner}{body}"
