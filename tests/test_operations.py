"""KPIs, metric series and alerts on hand-made events."""

import datetime as dt
import random

from pyspark.sql import functions as F

from stratalake.operators import alerts, distinct, kpi

START = dt.datetime(2024, 1, 1, 9)


def at(minute):
    return START + dt.timedelta(minutes=minute)


def ts(minute):
    return F.lit(str(at(minute))).cast("timestamp")


def events(spark, rows):
    made = [(at(m), s, c, kind, float(a), sev, 50) for m, s, c, kind, a, sev in rows]
    df = spark.createDataFrame(made, "ts timestamp, store_id int, customer_id int, event_type string, a double, severity string, utilization int")
    return df.withColumn("amount", F.col("a").cast("decimal(18,2)"))


def sample(spark):
    return events(
        spark,
        [
            (0, 1, 7, "payment_processed", 10, "info"), (0.5, 1, 7, "payment_processed", 5, "info"), (0.9, 1, 8, "rental_start", 3, "info"),
            (0.2, 2, 7, "error", 3, "critical"), (0.999, 2, 9, "error", 1, "warning"), (1, 1, 7, "customer_signup", 2, "info"),
        ],
    )


def test_minute_kpis(spark):
    got = {(r.kpi_timestamp, r.store_id): r for r in kpi.minute_kpis(sample(spark)).collect()}
    first = got[(at(0), 1)]
    assert (first.payments_per_minute, float(first.revenue_per_minute), first.avg_transaction_value) == (2, 15.0, 7.5)
    assert (first.active_customers_count, first.rentals_per_minute, first.has_active_alerts) == (2, 1, False)
    bad = got[(at(0), 2)]
    assert (bad.error_rate_percent, bad.critical_alert_count, bad.warning_alert_count, bad.avg_transaction_value) == (100.0, 1, 1, 0.0)
    assert (at(1), 1) in got and len(got) == 3


def test_total_row_counts_customers_once(spark):
    rows = {r.store_id: r for r in kpi.kpis_with_total(sample(spark)).where(F.col("kpi_timestamp") == ts(0)).collect()}
    assert rows[0].active_customers_count == 3 and rows[0].event_count == 5 and set(rows) == {0, 1, 2}


def test_sliding_counts_every_window(spark):
    got = kpi.sliding_activity(sample(spark), "3 minutes", "1 minute").where("store_id = 1")
    assert {r.window_start: r.events for r in got.collect()} == {at(-2): 3, at(-1): 4, at(0): 4, at(1): 1}


def test_health_bounds(spark):
    df = spark.createDataFrame([(0, 10), (3, 10), (4, 10), (6, 10), (7, 10)], "a int, n int")
    got = [r[0] for r in df.select(kpi.health(F.col("a"), F.col("n"))).collect()]
    assert got == ["Healthy", "Good", "Attention", "Attention", "Critical"]


def test_dashboard_and_summary(spark):
    stores = spark.createDataFrame([(1, "A", "M", True), (2, "B", "N", True), (3, "C", "O", True), (4, "D", "P", False)], "store_id int, store_address string, manager_name string, is_active boolean")
    kpis = kpi.minute_kpis(sample(spark))
    board = kpi.store_dashboard(stores, kpis, ts(1)).collect()
    assert sorted((r.store_id, float(r.revenue_today)) for r in board) == [(1, 15.0), (1, 15.0), (2, 0.0), (3, 0.0)]
    later = kpi.store_dashboard(stores, kpis, ts(1), "30 SECONDS").where("store_id = 1")
    assert [float(r.revenue_today) for r in later.collect()] == [15.0]
    silent = [r for r in board if r.store_id == 3][0]
    assert silent.kpi_timestamp is None and silent.last_updated == at(1)
    top = kpi.executive_summary(kpis, ts(1), "30 SECONDS").first()
    assert (top.total_active_stores, top.stores_with_alerts, top.overall_health_status) == (1, 0, "Healthy")
    assert (float(top.revenue_today), top.stores_reporting) == (15.0, 2)


def series(spark, values):
    rows = [(at(60 * i), 1, "m", float(v)) for i, v in enumerate(values) if v is not None]
    return spark.createDataFrame(rows, "captured_at timestamp, store_id int, metric_name string, v double").withColumn(
        "metric_value", F.col("v").cast("decimal(18,4)")
    ).drop("v")


def test_baseline(spark):
    got = kpi.with_baseline(series(spark, [10, 20, 0, 90]), history=2, anomaly_percent=100, breach=50).orderBy("captured_at").collect()
    assert [r.baseline_value for r in got] == [None, 10.0, 15.0, 10.0]
    assert [r.deviation_percent for r in got] == [None, 100.0, -100.0, 800.0]
    assert [r.is_anomaly for r in got] == [False, False, False, True]
    assert [r.severity_level for r in got] == ["info", "info", "info", "critical"]
    assert [r.change_percent for r in got] == [None, 100.0, -100.0, None]


RULES = "rule_id int, target_metric string, condition_type string, limit_ double, default_severity string, store_filter int, time_of_day_filter string, day_of_week_filter string, suppress_duplicate_minutes int, is_active boolean, is_test_mode boolean"


def rules(spark, *rows):
    df = spark.createDataFrame([(n, "m", kind, limit, "info", store, hours, days, 10, True, test) for n, kind, limit, store, hours, days, test in rows], RULES)
    return df.withColumn("threshold_value", F.col("limit_").cast("decimal(18,4)"))


def test_every_condition(spark):
    flagged = kpi.with_baseline(series(spark, [10, 20, 0, 90]), history=2)
    made = rules(
        spark,
        (1, "greater_than", 10.0, None, None, None, False), (2, "less_than", 10.0, None, None, None, False), (3, "equals", 20.0, None, None, None, False),
        (4, "not_equals", 20.0, None, None, None, False), (5, "percentage_change", 99.0, None, None, None, False), (6, "anomaly_detected", None, None, None, None, False),
        (7, "greater_than", 0.0, 2, None, None, False), (8, "greater_than", 0.0, None, "after_hours", None, False), (9, "greater_than", 0.0, None, None, "weekends", False),
        (10, "greater_than", 0.0, None, None, None, True), (11, "greater_than", 0.0, None, "business_hours", "weekdays", False),
    )
    got = {}
    for r in alerts.evaluate(flagged, made).collect():
        got.setdefault(r.rule_id, set()).add((r.alert_timestamp - START).seconds // 3600)
    # 2024-01-01 is a Monday; slots run from 9 to 12 o'clock.
    assert got == {1: {1, 3}, 2: {2}, 3: {1}, 4: {0, 2, 3}, 5: {1, 2}, 6: {3}, 11: {0, 1, 3}}
    assert {r.rule_id for r in alerts.evaluate(flagged, made, test_mode=True).collect()} == {10}


def test_missing_data(spark):
    made = rules(spark, (1, "missing_data", None, None, None, None, False), (2, "missing_data", None, 5, None, None, False))
    got = alerts.missing_data(series(spark, [1, None, 1, None]), made, ts(0), ts(180), "1 HOUR")
    assert sorted((r.rule_id, r.alert_timestamp) for r in got.collect()) == [(1, at(60)), (1, at(180))]


def brute_suppress(minutes, wait):
    kept, last = [], None
    for m in sorted(set(minutes)):
        if last is None or m - last >= wait:
            kept.append(m)
            last = m
    return kept


def test_suppression_follows_the_last_kept_alert(spark):
    rng = random.Random(1)
    made = {(1, s): [rng.randint(0, 400) for _ in range(150)] for s in (1, 2)}
    made[(2, 1)] = list(range(0, 300))  # one uninterrupted chain
    rows = [(r, s, at(m)) for (r, s), minutes in made.items() for m in minutes]
    df = spark.createDataFrame(rows, "rule_id int, store_id int, alert_timestamp timestamp")
    config = spark.createDataFrame([(1, 10), (2, 7)], "rule_id int, suppress_duplicate_minutes int")
    got = {}
    for r in alerts.suppress(df, config).collect():
        got.setdefault((r.rule_id, r.store_id), []).append(int((r.alert_timestamp - START).total_seconds() // 60))
    assert {k: sorted(v) for k, v in got.items()} == {k: brute_suppress(v, {1: 10, 2: 7}[k[0]]) for k, v in made.items()}


def board_rows(spark):
    rows = [
        (1, "critical", 2, None, None, True), (2, "critical", 1, at(5), None, True), (3, "critical", 0, None, at(10), True), (4, "warning", 1, None, None, False),
        (5, "warning", 0, None, None, True), (6, "info", 3, None, None, True),
    ]
    df = spark.createDataFrame(rows, "alert_id int, severity string, escalation_level int, acknowledged_at timestamp, resolved_at timestamp, is_active boolean")
    return df.withColumn("alert_timestamp", ts(0))


def test_board(spark):
    got = alerts.board(board_rows(spark), ts(60)).orderBy("alert_id").collect()
    assert [r.priority_score for r in got] == [100, 90, 80, 70, 60, 50]
    assert [r.current_status for r in got] == ["active", "acknowledged", "resolved", "suppressed", "active", "active"]
    assert [r.duration_minutes for r in got] == [60.0, 60.0, 10.0, 60.0, 60.0, 60.0] and got[1].time_to_acknowledge_minutes == 5.0
    assert alerts.board(board_rows(spark), ts(60 * 24 + 1)).count() == 0
    sla = alerts.sla(alerts.board(board_rows(spark), ts(60)), {"critical": 30}, 90).orderBy("alert_id").collect()
    assert [r.business_impact for r in sla] == ["high", "high", "medium", "low", "low", "low"]
    assert [r.actual_resolution_time for r in sla] == [None, None, 10, None, None, None]


def test_escalation_is_capped(spark):
    df = spark.createDataFrame([(at(0), None), (at(31), None), (at(46), None), (at(0), at(14)), (at(59), None)], "raised timestamp, ack timestamp")
    level = alerts.escalation_level(F.col("raised"), F.col("ack"), ts(60), F.lit(15), F.lit(2))
    assert [r[0] for r in df.select(level).collect()] == [2, 1, 0, 0, 0]


def test_rule_statistics(spark):
    got = alerts.rule_statistics(board_rows(spark), "severity", ts(60)).where("severity = 'critical'").first()
    assert (got.alert_count_last_24h, got.avg_resolution_minutes) == (3, 10.0)


def test_trend_and_completeness(spark):
    kpis = kpi.minute_kpis(events(spark, [(0, 1, 1, "payment_processed", 10, "info"), (24 * 60, 1, 1, "payment_processed", 15, "info"), (24 * 60 + 1, 1, 1, "error", 1, "info")]))
    got = {r.kpi_timestamp: r.trend_percent for r in kpi.trend(kpis).collect()}
    assert got == {at(0): None, at(24 * 60): 50.0, at(24 * 60 + 1): None}
    full = {str(r.kpi_date): r for r in kpi.completeness(kpis, 1, ts(0), ts(24 * 60 + 4)).collect()}
    assert (full["2024-01-01"].expected_slots, full["2024-01-02"].expected_slots) == (15 * 60, 9 * 60 + 4)
    assert full["2024-01-02"].data_freshness_minutes == 3


def test_suppression_by_true_instants(spark):
    second = lambda n: START + dt.timedelta(seconds=n)
    rows = [(1, 1, second(20 * n)) for n in range(6)] + [(2, 1, second(n)) for n in (59, 60, 118, 119, 400)]
    df = spark.createDataFrame(rows, "rule_id int, store_id int, alert_timestamp timestamp")
    config = spark.createDataFrame([(1, 0), (2, 1)], "rule_id int, suppress_duplicate_minutes int")
    got = sorted((r.rule_id, round((r.alert_timestamp - START).total_seconds())) for r in alerts.suppress(df, config).collect())
    assert got == [(1, 20 * n) for n in range(6)] + [(2, 59), (2, 119), (2, 400)]


def test_maintenance_silences_its_stores_and_rules(spark):
    at = lambda text: F.lit(text).cast("timestamp")
    times = ["2024-01-01 23:59:59", "2024-01-02 00:00:00", "2024-01-03 12:00:00", "2024-01-04 00:00:00"]
    raised = None
    for n, text in enumerate(times):
        line = spark.range(2).selectExpr("cast(id + 1 AS int) AS rule_id", f"{n % 2} AS store_id").withColumn("alert_timestamp", at(text))
        raised = line if raised is None else raised.unionByName(line)
    rules = spark.createDataFrame([(1, True), (2, False)], "rule_id int, suppress_during_maintenance boolean")
    windows = spark.createDataFrame([(1, "2024-01-02 00:00:00", "2024-01-04 00:00:00"), (None, "2024-01-03 11:00:00", "2024-01-03 13:00:00")], "store_id int, b string, e string")
    windows = windows.selectExpr("store_id", "cast(b AS timestamp) AS begins_at", "cast(e AS timestamp) AS ends_at")
    kept = {(r.rule_id, str(r.alert_timestamp)) for r in alerts.outside_maintenance(raised, rules, windows).collect()}
    assert {t for rule, t in kept if rule == 2} == set(times)
    assert {t for rule, t in kept if rule == 1} == {times[0], times[3]}
    plain = alerts.outside_maintenance(raised, rules.select("rule_id"), windows)
    assert plain.count() == 4 and "NestedLoop" not in plain._jdf.queryExecution().executedPlan().toString()


def test_rolling_counts_make_no_copies_to_be_made_distinct(spark):
    rows = [(1, "2024-01-01", 7), (1, "2024-01-01", 7), (1, "2024-02-01", 7), (1, "2024-05-01", 7), (1, "2024-02-01", 8)]
    rows += [(2, "2023-12-01", None), (2, "2024-01-01", 9), (None, "2024-01-01", 9), (2, None, 5), (1, None, 7)]
    df = spark.createDataFrame(rows, "store int, m string, who int").withColumn("m", F.to_date("m"))
    got = distinct.rolling_counts(df, ["store"], "m", 3, "who", "n")
    copies = df.withColumn("m", F.explode(F.array(*[F.add_months("m", k) for k in range(3)]))).where("m IS NOT NULL")
    plain = distinct.distinct_counts(copies, ["store", "m"], {"n": "who"})
    assert sorted(map(str, got.collect())) == sorted(map(str, plain.collect()))
    plan = got._jdf.queryExecution().sparkPlan().toString()
    assert plan.index("Generate") < plan.index("collect_set")  # copies are made after rows met by value
