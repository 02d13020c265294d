"""Operational KPIs, metric series and alerts as batch queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import binding as b
from catalog.binding import SQL
from catalog.registry import query
from stratalake.operators import alerts, kpi
from stratalake.operators.joins import broadcast_checked

NOW = f"TIMESTAMP '{b.AS_OF_TIME}'"
MONEY = "(revenue_per_minute::DOUBLE AS revenue_per_minute)"


def _period(spark, sf):
    """The first and the last hour with an event."""
    hour = F.date_trunc("hour", "ts")
    row = b.events(spark, sf).agg(F.min(hour).cast("string"), F.max(hour).cast("string")).first()
    return tuple(F.lit(at).cast("timestamp") for at in row)


def hourly(spark, sf, since=None, before=None):
    return kpi.minute_kpis(b.events(spark, sf, since, before), "1 hour")


@query("kpi_minute", f"SELECT * REPLACE {MONEY} FROM (" + SQL["kpi_hour"].replace("'hour'", "'minute'") + ")")
def kpi_minute(spark, sf):
    return kpi.minute_kpis(b.events(spark, sf))


@query(
    "kpi_rollup",
    f"SELECT * REPLACE {MONEY} FROM kpi_hour UNION ALL BY NAME SELECT * REPLACE (revenue_per_minute::DOUBLE AS revenue_per_minute) FROM ("
    + SQL["kpi_hour"].replace(", store_id,", ", 0::INT AS store_id,").replace("GROUP BY ALL", "GROUP BY date_trunc('hour', ts)")
    + ")",
)
def kpi_rollup(spark, sf):
    return kpi.kpis_with_total(b.events(spark, sf), "1 hour")


@query(
    "kpi_sliding",
    """SELECT w AS window_start, w + INTERVAL 5 MINUTE AS window_end, store_id, count(*) AS events, coalesce(sum(amount) FILTER (event_type = 'payment_processed'), 0)::DOUBLE AS revenue
       FROM (SELECT *, unnest([date_trunc('minute', ts) - to_minutes(k) FOR k IN range(5)]) AS w FROM biz_events) GROUP BY ALL""",
)
def kpi_sliding(spark, sf):
    return kpi.sliding_activity(b.events(spark, sf))


SQL_SESSIONS = """SELECT customer_id, min(ts) AS session_start, max(ts) AS session_end, date_diff('microsecond', min(ts), max(ts)) / 6e7 AS duration_minutes, count(*) AS events,
         coalesce(sum(amount) FILTER (event_type = 'payment_processed'), 0)::DOUBLE AS revenue, count(*) FILTER (event_type = 'rental_start') AS rentals, min(store_id) AS first_store_id
       FROM (SELECT *, count(*) FILTER (fresh) OVER (PARTITION BY customer_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS island
             FROM (SELECT *, coalesce(ts > lag(ts) OVER (PARTITION BY customer_id ORDER BY ts) + INTERVAL 30 MINUTE, TRUE) AS fresh FROM biz_events))
       GROUP BY customer_id, island"""


@query("session_activity", SQL_SESSIONS)
def session_activity(spark, sf):
    return kpi.session_activity(b.events(spark, sf))


@query(
    "running_revenue",
    """SELECT kpi_timestamp, store_id, revenue_per_minute::DOUBLE AS revenue_per_minute, (sum(kpi_hour.revenue_per_minute) OVER (PARTITION BY store_id, kpi_timestamp::DATE ORDER BY kpi_timestamp ROWS UNBOUNDED PRECEDING))::DOUBLE AS revenue_today FROM kpi_hour""",
)
def running_revenue(spark, sf):
    return kpi.running_revenue(hourly(spark, sf)).select("kpi_timestamp", "store_id", "revenue_per_minute", "revenue_today")


SQL_COMPARED = """(SELECT *, (revenue_per_minute::DOUBLE - base_r) / nullif(base_r, 0) * 100 AS revenue_vs, (event_count::DOUBLE - base_n) / nullif(base_n, 0) * 100 AS activity_vs,
        seen::DOUBLE / least(24, floor(date_diff('microsecond', first_slot, kpi_timestamp) / 3600000000) + 1) * 100 AS complete
      FROM (SELECT *, sum(revenue_per_minute) OVER day::DOUBLE / nullif(count(*) OVER day, 0) AS base_r, sum(event_count) OVER day::DOUBLE / nullif(count(*) OVER day, 0) AS base_n,
          min(kpi_timestamp) OVER (PARTITION BY store_id ORDER BY kpi_timestamp) AS first_slot,
          count(*) OVER (PARTITION BY store_id ORDER BY kpi_timestamp RANGE BETWEEN INTERVAL 86399999999 MICROSECOND PRECEDING AND CURRENT ROW) AS seen
        FROM kpi_hour WHERE kpi_timestamp >= TIMESTAMP '2024-01-18 00:00:00' AND kpi_timestamp <= TIMESTAMP '{at}'
        WINDOW day AS (PARTITION BY store_id ORDER BY kpi_timestamp RANGE BETWEEN INTERVAL 24 HOUR PRECEDING AND INTERVAL 1 MICROSECOND PRECEDING)))""".replace("{at}", b.AS_OF_TIME)


@query(
    "kpi_vs_baseline",
    f"SELECT kpi_timestamp, store_id, revenue_vs AS revenue_vs_baseline_percent, activity_vs AS activity_vs_baseline_percent, complete AS data_completeness_percent FROM {SQL_COMPARED}",
)
def kpi_vs_baseline(spark, sf):
    slots = hourly(spark, sf, "2024-01-18 00:00:00", "2024-01-20 13:00:00").where(F.col("kpi_timestamp") <= b.as_of_time())
    names = ["revenue_vs_baseline_percent", "activity_vs_baseline_percent", "data_completeness_percent"]
    return kpi.with_comparisons(slots, 60).select("kpi_timestamp", "store_id", *names)


@query(
    "store_dashboard",
    f"""SELECT s.store_id, s.address AS store_address, s.manager_name, k.kpi_timestamp, coalesce(k.rentals_per_minute, 0) AS current_rentals_per_minute,
        coalesce(k.revenue_per_minute, 0)::DOUBLE AS current_revenue_per_minute, coalesce(k.active_customers_count, 0) AS active_customers,
        coalesce((SELECT sum(d.revenue_per_minute) FROM kpi_hour d WHERE d.store_id = s.store_id AND d.kpi_timestamp::DATE = k.kpi_timestamp::DATE AND d.kpi_timestamp <= k.kpi_timestamp), 0)::DOUBLE AS revenue_today,
        coalesce(k.has_active_alerts, FALSE) AS has_alerts, coalesce(k.critical_alert_count, 0) AS critical_alerts, coalesce(k.warning_alert_count, 0) AS warning_alerts,
        coalesce(k.inventory_utilization_percent, 0) AS inventory_utilization, coalesce(k.error_rate_percent, 0) AS error_rate, coalesce(k.last_updated, {NOW}) AS last_updated,
        0.0::DOUBLE AS system_response_time, coalesce(k.revenue_vs, 0) AS revenue_vs_baseline, coalesce(k.activity_vs, 0) AS activity_vs_baseline, coalesce(k.complete, 100) AS data_quality
        FROM store s LEFT JOIN {SQL_COMPARED} k ON s.store_id = k.store_id AND k.kpi_timestamp >= {NOW} - INTERVAL 18 HOUR AND k.kpi_timestamp <= {NOW} WHERE s.is_active""",
)
def store_dashboard(spark, sf):
    stores = b.store(spark, sf).withColumnRenamed("address", "store_address")
    slots = hourly(spark, sf, "2024-01-18 00:00:00", "2024-01-20 13:00:00")
    return kpi.store_dashboard(stores, slots, b.as_of_time(), "18 HOURS", width_minutes=60)


@query(
    "executive_summary",
    f"""WITH recent AS (SELECT sum(revenue_per_minute)::DOUBLE AS total_revenue_per_minute, sum(rentals_per_minute)::BIGINT AS total_rentals_per_minute, avg(inventory_utilization_percent) AS avg_inventory_utilization,
          count(*) FILTER (has_active_alerts) AS stores_with_alerts, count(*) AS total_active_stores, max(last_updated) AS last_data_update FROM kpi_hour WHERE kpi_timestamp >= {NOW} - INTERVAL 3 HOUR AND kpi_timestamp <= {NOW}),
        today AS (SELECT sum(revenue_per_minute)::DOUBLE AS revenue_today, sum(rentals_per_minute)::BIGINT AS rentals_today, count(DISTINCT store_id) AS stores_reporting FROM kpi_hour
          WHERE kpi_timestamp::DATE = {NOW}::DATE AND kpi_timestamp <= {NOW})
        SELECT {NOW} AS dashboard_timestamp, recent.* REPLACE (round(avg_inventory_utilization, 6) AS avg_inventory_utilization), today.*, CASE WHEN stores_with_alerts = 0 THEN 'Healthy'
          WHEN stores_with_alerts <= total_active_stores * 0.3 THEN 'Good' WHEN stores_with_alerts <= total_active_stores * 0.6 THEN 'Attention' ELSE 'Critical' END AS overall_health_status,
          floor(date_diff('microsecond', last_data_update, {NOW}) / 6e7)::BIGINT AS data_freshness_minutes FROM recent CROSS JOIN today""",
)
def executive_summary(spark, sf):
    rows = kpi.executive_summary(hourly(spark, sf, "2024-01-20 00:00:00", "2024-01-20 13:00:00"), b.as_of_time(), "3 HOURS")
    return rows.withColumn("avg_inventory_utilization", F.round("avg_inventory_utilization", 6))


def series(spark, sf):
    return kpi.metric_series(b.events(spark, sf))


@query("metric_baseline", "SELECT captured_at, store_id, metric_name, metric_value::DOUBLE AS metric_value, baseline_value, deviation_percent FROM series_flagged")
def metric_baseline(spark, sf):
    rows = kpi.with_baseline(series(spark, sf))
    return rows.select("captured_at", "store_id", "metric_name", "metric_value", "baseline_value", "deviation_percent")


@query(
    "metric_anomaly",
    """SELECT captured_at, store_id, metric_name, is_anomaly, metric_value > 100 AS alert_threshold_breached, CASE WHEN is_anomaly AND metric_value > 100 THEN 'critical'
       WHEN is_anomaly OR metric_value > 100 THEN 'warning' ELSE 'info' END AS severity_level FROM series_flagged""",
)
def metric_anomaly(spark, sf):
    rows = kpi.with_baseline(series(spark, sf), breach=100.0)
    return rows.select("captured_at", "store_id", "metric_name", "is_anomaly", "alert_threshold_breached", "severity_level")


def fired(spark, sf):
    return alerts.evaluate(kpi.with_baseline(series(spark, sf)), b.rules(spark))


@query("alert_eval", "SELECT * REPLACE (source_value::DOUBLE AS source_value, threshold_value::DOUBLE AS threshold_value) FROM fired")
def alert_eval(spark, sf):
    return fired(spark, sf)


@query(
    "alert_filtered",
    """SELECT r.rule_id, s.store_id, s.captured_at FROM series s JOIN rules r ON s.metric_name = r.target_metric
       WHERE r.is_active AND NOT r.is_test_mode AND (r.store_filter IS NULL OR r.store_filter = s.store_id)
         AND (r.time_of_day_filter IS NULL OR (r.time_of_day_filter = 'business_hours') = (hour(s.captured_at) BETWEEN 9 AND 17))
         AND (r.day_of_week_filter IS NULL OR (r.day_of_week_filter = 'weekends') = (dayofweek(s.captured_at) IN (0, 6)))""",
)
def alert_filtered(spark, sf):
    rows, live = series(spark, sf), b.rules(spark).where("is_active and not is_test_mode")
    joined = rows.join(broadcast_checked(live), rows["metric_name"] == live["target_metric"])
    return joined.where(alerts.applicable()).select("rule_id", "store_id", "captured_at")


@query(
    "alert_test_mode",
    """SELECT r.rule_id, s.store_id, s.captured_at AS alert_timestamp, s.metric_value::DOUBLE AS source_value FROM series s JOIN rules r ON s.metric_name = r.target_metric
       WHERE r.is_active AND r.is_test_mode AND s.metric_value > r.threshold_value""",
)
def alert_test_mode(spark, sf):
    rows = alerts.evaluate(kpi.with_baseline(series(spark, sf)), b.rules(spark), test_mode=True)
    return rows.select("rule_id", "store_id", "alert_timestamp", "source_value")


@query(
    "alert_missing_data",
    """SELECT r.rule_id, s.store_id, t.slot AS alert_timestamp, s.metric_name FROM (SELECT DISTINCT store_id, metric_name FROM series) s JOIN rules r ON s.metric_name = r.target_metric
       JOIN (SELECT unnest(generate_series(min(captured_at), max(captured_at), INTERVAL 1 HOUR)) AS slot FROM series) t ON TRUE
       WHERE r.condition_type = 'missing_data' AND NOT EXISTS (SELECT 1 FROM series x WHERE x.store_id = s.store_id AND x.metric_name = s.metric_name AND x.captured_at = t.slot)""",
)
def alert_missing_data(spark, sf):
    first, last = _period(spark, sf)
    return alerts.missing_data(series(spark, sf), b.rules(spark), first, last, "1 HOUR")


@query(
    "alert_suppressed",
    """WITH RECURSIVE chain AS (SELECT rule_id, store_id, min(alert_timestamp) AS alert_timestamp FROM fired GROUP BY ALL
         UNION ALL SELECT c.rule_id, c.store_id, min(f.alert_timestamp) FROM chain c JOIN rules r ON c.rule_id = r.rule_id
           JOIN fired f ON f.rule_id = c.rule_id AND f.store_id = c.store_id AND f.alert_timestamp >= c.alert_timestamp + to_minutes(r.suppress_duplicate_minutes::BIGINT)
           GROUP BY c.rule_id, c.store_id, c.alert_timestamp)
       SELECT rule_id, store_id, alert_timestamp FROM chain""",
)
def alert_suppressed(spark, sf):
    return alerts.suppress(fired(spark, sf), b.rules(spark))


# Maintenance of the binding, of one store and of all.
MAINTENANCE = [(3, "2024-01-05 00:00:00", "2024-01-07 06:00:00"), (None, "2024-01-10 22:00:00", "2024-01-11 02:00:00"), (5, "2024-01-12 00:00:00", "2024-01-12 00:00:00")]


@query(
    "alert_maintenance",
    """SELECT rule_id, store_id, alert_timestamp FROM fired f WHERE NOT (rule_id <> 4 AND EXISTS (SELECT 1 FROM (VALUES """
    + ", ".join(f"({'NULL' if s is None else s}, TIMESTAMP '{a}', TIMESTAMP '{z}')" for s, a, z in MAINTENANCE)
    + """) w(s, a, z) WHERE (w.s IS NULL OR w.s = f.store_id) AND f.alert_timestamp >= w.a AND f.alert_timestamp < w.z))""",
)
def alert_maintenance(spark, sf):
    """Alerts outside maintenance; rule 4 notifies all the same."""
    windows = spark.createDataFrame(MAINTENANCE, "store_id int, begins_at string, ends_at string")
    windows = windows.select("store_id", *[F.col(c).cast("timestamp").alias(c) for c in ("begins_at", "ends_at")])
    rules = b.rules(spark).withColumn("suppress_during_maintenance", F.col("rule_id") != 4)
    return alerts.outside_maintenance(fired(spark, sf), rules, windows).select("rule_id", "store_id", "alert_timestamp")


SQL_LEVEL = f"""greatest(least(floor(date_diff('microsecond', alert_timestamp, coalesce(acknowledged_at, {NOW})) / 6e7 / 15), 2), 0)::INT"""


def _escalated(spark, sf, since=None):
    rows = b.alert_events(spark, sf, since).where(F.col("alert_timestamp") <= b.as_of_time())
    level = alerts.escalation_level(F.col("alert_timestamp"), F.col("acknowledged_at"), b.as_of_time(), F.lit(15), F.lit(2))
    return rows.withColumn("escalation_level", level)


@query("alert_escalation", f"SELECT alert_id, {SQL_LEVEL} AS escalation_level FROM alert_events WHERE alert_timestamp <= {NOW}")
def alert_escalation(spark, sf):
    return _escalated(spark, sf).select("alert_id", "escalation_level")


SQL_BOARD = f"""SELECT *, CASE WHEN resolved_at IS NOT NULL THEN 'resolved' WHEN acknowledged_at IS NOT NULL THEN 'acknowledged' WHEN NOT is_active THEN 'suppressed' ELSE 'active' END AS current_status,
    date_diff('microsecond', alert_timestamp, coalesce(resolved_at, {NOW})) / 6e7 AS duration_minutes, date_diff('microsecond', alert_timestamp, coalesce(acknowledged_at, {NOW})) / 6e7 AS time_to_acknowledge_minutes,
    CASE WHEN severity = 'critical' AND escalation_level >= 2 THEN 100 WHEN severity = 'critical' AND escalation_level = 1 THEN 90 WHEN severity = 'critical' THEN 80
      WHEN severity = 'warning' AND escalation_level >= 1 THEN 70 WHEN severity = 'warning' THEN 60 ELSE 50 END::INT AS priority_score
    FROM (SELECT *, {SQL_LEVEL} AS escalation_level FROM alert_events) WHERE alert_timestamp >= {NOW} - INTERVAL 24 HOUR AND alert_timestamp <= {NOW}"""


@query("alert_management", f"SELECT * REPLACE (source_value::DOUBLE AS source_value) FROM ({SQL_BOARD})")
def alert_management(spark, sf):
    rows = alerts.board(_escalated(spark, sf, "2024-01-19 12:00:00"), b.as_of_time())
    return rows.orderBy(F.desc("priority_score"), F.desc("alert_timestamp"))


@query(
    "alert_sla",
    f"""SELECT alert_id, breach AS sla_breach, CASE WHEN severity = 'critical' AND breach THEN 'high' WHEN severity = 'critical' OR breach THEN 'medium' ELSE 'low' END AS business_impact,
        CASE WHEN current_status = 'resolved' THEN floor(duration_minutes)::BIGINT END AS actual_resolution_time
        FROM (SELECT *, duration_minutes > CASE severity WHEN 'critical' THEN 30 WHEN 'warning' THEN 120 ELSE 480 END AS breach FROM ({SQL_BOARD}))""",
)
def alert_sla(spark, sf):
    rows = alerts.sla(alerts.board(_escalated(spark, sf, "2024-01-19 12:00:00"), b.as_of_time()), {"critical": 30, "warning": 120}, 480)
    return rows.select("alert_id", "sla_breach", "business_impact", "actual_resolution_time")


@query(
    "rule_stats",
    f"""SELECT rule_id, count(*) FILTER (alert_timestamp >= {NOW} - INTERVAL 24 HOUR) AS alert_count_last_24h, max(alert_timestamp) AS last_triggered_at,
        sum(date_diff('microsecond', alert_timestamp, resolved_at))::DOUBLE / count(resolved_at) / 6e7 AS avg_resolution_minutes FROM alert_events WHERE alert_timestamp <= {NOW} GROUP BY ALL""",
)
def rule_stats(spark, sf):
    return alerts.rule_statistics(b.alert_events(spark, sf), "rule_id", b.as_of_time())


@query(
    "kpi_trend",
    """SELECT a.kpi_timestamp, a.store_id, a.revenue_per_minute::DOUBLE AS revenue_per_minute, p.revenue_per_minute::DOUBLE AS earlier_value,
       (a.revenue_per_minute::DOUBLE - p.revenue_per_minute::DOUBLE) / nullif(p.revenue_per_minute::DOUBLE, 0) * 100 AS trend_percent
       FROM kpi_hour a LEFT JOIN kpi_hour p ON a.store_id = p.store_id AND a.kpi_timestamp = p.kpi_timestamp + INTERVAL 1 DAY""",
)
def kpi_trend(spark, sf):
    return kpi.trend(hourly(spark, sf))


@query(
    "kpi_completeness",
    """WITH period AS (SELECT min(kpi_timestamp) AS first_slot, max(kpi_timestamp) + INTERVAL 1 HOUR AS period_end FROM kpi_hour)
       SELECT store_id, kpi_date, observed_slots, last_updated, expected_slots, observed_slots::DOUBLE / expected_slots * 100 AS data_completeness_percent, floor(date_diff('microsecond', last_updated, period_end) / 6e7)::BIGINT AS data_freshness_minutes FROM (
       SELECT *, date_diff('hour', greatest(kpi_date::TIMESTAMP, first_slot), least(kpi_date::TIMESTAMP + INTERVAL 1 DAY, period_end)) AS expected_slots
       FROM (SELECT store_id, kpi_timestamp::DATE AS kpi_date, count(*) AS observed_slots, max(last_updated) AS last_updated FROM kpi_hour GROUP BY store_id, kpi_timestamp::DATE), period)""",
)
def kpi_completeness(spark, sf):
    first, last = _period(spark, sf)
    return kpi.completeness(hourly(spark, sf), 60, first, last + F.expr("INTERVAL 1 HOUR"))
