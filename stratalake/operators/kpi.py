"""Operational KPIs over an event stream; the batch twins of ``streaming.kpis``.

Events carry ``ts``, ``store_id``, ``customer_id``, ``event_type``, ``amount`` and a
``utilization`` reading. Every window function below runs over aggregated slots, whose
number per store is bounded by time and not by traffic.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratalake.functions.measures import minutes, per

# KPI column -> event type it counts.
COUNTED = {
    "rentals_per_minute": "rental_start",
    "returns_per_minute": "rental_return",
    "payments_per_minute": "payment_processed",
    "new_customers_per_minute": "customer_signup",
}


def business_events(raw: DataFrame, types: Mapping[str, str], source_table: str) -> DataFrame:
    """Bring raw events to the ingest layout: type names, day, status and retry fields."""
    pairs = [F.lit(x) for item in types.items() for x in item]
    return raw.withColumns(
        {
            "event_type": F.coalesce(F.element_at(F.create_map(*pairs), F.col("event_type")), F.col("event_type")),
            "source_table": F.lit(source_table),
            "processing_status": F.lit("pending"),
            "retry_count": F.lit(0),
            "event_date": F.to_date("ts"),
        }
    )


def _per_customer(events: DataFrame, width: str) -> DataFrame:
    """Counts per slot, store and customer: the small input of every distinct count."""
    is_payment = F.col("event_type") == "payment_processed"
    is_error = F.col("event_type") == "error"
    return events.groupBy(
        F.window("ts", width).start.alias("kpi_timestamp"), "store_id", "customer_id"
    ).agg(
        *[F.count_if(F.col("event_type") == kind).alias(name) for name, kind in COUNTED.items()],
        F.sum(F.when(is_payment, F.col("amount"))).alias("_revenue"),
        F.count_if(is_error).alias("_errors"),
        F.count_if(is_error & (F.col("severity") == "critical")).alias("_critical"),
        F.count_if(is_error & (F.col("severity") == "warning")).alias("_warning"),
        F.sum("utilization").alias("_use"),
        F.count(F.lit(1)).alias("_events"),
        F.max("ts").alias("_last"),
    )


def _measures() -> list[Column]:
    errors, total = F.sum("_errors"), F.sum("_events")
    payments = F.sum("payments_per_minute")
    revenue = F.coalesce(F.sum("_revenue"), F.lit(0))
    return [
        *[F.sum(name).alias(name) for name in COUNTED],
        revenue.cast("decimal(18,2)").alias("revenue_per_minute"),
        F.coalesce(per(revenue, payments), F.lit(0.0)).alias("avg_transaction_value"),
        per(F.sum("_use"), total).alias("inventory_utilization_percent"),
        F.count_distinct("customer_id").alias("active_customers_count"),
        (per(errors, total) * 100).alias("error_rate_percent"),
        (errors > 0).alias("has_active_alerts"),
        F.sum("_critical").alias("critical_alert_count"),
        F.sum("_warning").alias("warning_alert_count"),
        total.alias("event_count"),
        F.max("_last").alias("last_updated"),
    ]


def minute_kpis(events: DataFrame, width: str = "1 minute") -> DataFrame:
    """KPIs per slot and store."""
    return _per_customer(events, width).groupBy("kpi_timestamp", "store_id").agg(*_measures())


def kpis_with_total(events: DataFrame, width: str = "1 minute") -> DataFrame:
    """KPIs per slot and store plus an all-stores row with store 0."""
    small = _per_customer(events, width)
    slot, store = F.col("kpi_timestamp"), F.col("store_id")
    grouped = small.groupingSets([[slot, store], [slot]], slot, store)
    rows = grouped.agg(*_measures(), F.grouping("store_id").alias("_all"))
    return rows.withColumn("store_id", F.when(F.col("_all") == 1, 0).otherwise(store)).drop("_all")


def sliding_activity(events: DataFrame, width: str = "5 minutes", step: str = "1 minute") -> DataFrame:
    """Events and revenue per sliding window and store.

    Events are first combined per step, then each step row is replicated to the windows
    that contain it; replicating raw events would multiply the shuffle.
    """
    is_payment = F.col("event_type") == "payment_processed"
    steps = events.groupBy(F.window("ts", step).start.alias("_step"), "store_id").agg(
        F.count(F.lit(1)).alias("_n"), F.sum(F.when(is_payment, F.col("amount"))).alias("_revenue")
    )
    slide = F.window("_step", width, step)
    return steps.groupBy(slide.alias("_w"), "store_id").agg(
        F.sum("_n").alias("events"), F.coalesce(F.sum("_revenue"), F.lit(0)).cast("decimal(18,2)").alias("revenue")
    ).select(F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), "store_id", "events", "revenue")


def sessions(events: DataFrame, gap: str) -> DataFrame:
    """Aggregates per customer and session window; sessions that touch are merged from partial ones."""
    is_payment = F.col("event_type") == "payment_processed"
    grouped = events.groupBy(F.session_window("ts", gap).alias("_w"), "customer_id")
    rows = grouped.agg(
        F.max("ts").alias("session_end"),
        F.count(F.lit(1)).alias("events"),
        F.coalesce(F.sum(F.when(is_payment, F.col("amount"))), F.lit(0)).cast("decimal(18,2)").alias("revenue"),
        F.count_if(F.col("event_type") == "rental_start").alias("rentals"),
        F.min("store_id").alias("first_store_id"),
    )
    started = F.col("_w.start").alias("session_start")
    spent = minutes(F.col("_w.start"), F.col("session_end")).alias("duration_minutes")
    return rows.select("customer_id", started, "session_end", spent, "events", "revenue", "rentals", "first_store_id")


def session_activity(events: DataFrame, gap: str = "30 minutes") -> DataFrame:
    """Sessions per customer: events that follow each other within ``gap``.

    A customer's events are combined to partial sessions before the shuffle, so that a busy
    customer sends few rows. Events without a customer are one visitor's.
    """
    return sessions(events, gap)


def running_revenue(kpis: DataFrame) -> DataFrame:
    """Revenue of the day so far, per store and slot."""
    day = Window.partitionBy("store_id", F.to_date("kpi_timestamp")).orderBy("kpi_timestamp")
    return kpis.withColumn(
        "revenue_today",
        F.sum("revenue_per_minute").over(day.rowsBetween(Window.unboundedPreceding, 0)),
    )


def with_comparisons(kpis: DataFrame, width_minutes: int, hours: int = 24) -> DataFrame:
    """Each slot against the same store's slots of the ``hours`` before it.

    Revenue and activity in percent above the mean of those slots (NULL without any), and how many
    of the slots expected up to now, since the store's first one, hold data. Windows hold as many
    rows as the clock allows. ``avg_response_time_ms`` stays NULL where events carry no such time.
    """
    at = F.unix_micros("kpi_timestamp")
    span, step = hours * 3_600_000_000, width_minutes * 60_000_000
    line = Window.partitionBy("store_id").orderBy(at)
    before = line.rangeBetween(-span, -1)

    def against(name: str) -> Column:
        base = per(F.sum(name).over(before), F.count(name).over(before))
        return per(F.col(name).cast("double") - base, base) * 100

    first = F.min(at).over(line.rowsBetween(Window.unboundedPreceding, 0))
    expected = F.least(F.lit(span // step), F.floor((at - first) / step) + 1)
    observed = F.count(F.lit(1)).over(line.rangeBetween(-span + 1, 0))
    extra = {} if "avg_response_time_ms" in kpis.columns else {"avg_response_time_ms": F.lit(None).cast("double")}
    return kpis.withColumns(
        {
            "revenue_vs_baseline_percent": against("revenue_per_minute"),
            "activity_vs_baseline_percent": against("event_count"),
            "data_completeness_percent": per(observed, expected) * 100,
            **extra,
        }
    )


def store_dashboard(
    stores: DataFrame, kpis: DataFrame, as_of: Column, window: str = "5 minutes", published: bool = False, width_minutes: int = 1
) -> DataFrame:
    """Active stores with their recent KPI slots; a silent store shows zeros.

    ``revenue_today`` counts from the start of the day; with ``published`` it counts from the
    start of the window only, as the published view does. Comparisons look a day back from each
    slot. The time limit of the join is applied before it, where it prunes the KPI scan.
    """
    slot, began = F.col("kpi_timestamp"), as_of - F.expr(f"INTERVAL {window}")
    kpis = with_comparisons(kpis.where(slot <= as_of), width_minutes)
    known = kpis.where((slot >= (began if published else F.date_trunc("day", began))) & (slot <= as_of))
    joined = stores.where("is_active").join(running_revenue(known).where(slot >= began), "store_id", "left")
    zero = F.lit(0)
    return joined.select(
        "store_id",
        "store_address",
        "manager_name",
        "kpi_timestamp",
        F.coalesce("rentals_per_minute", zero).alias("current_rentals_per_minute"),
        F.coalesce("revenue_per_minute", zero).cast("decimal(18,2)").alias("current_revenue_per_minute"),
        F.coalesce("active_customers_count", zero).alias("active_customers"),
        F.coalesce("revenue_today", zero).cast("decimal(18,2)").alias("revenue_today"),
        F.coalesce("has_active_alerts", F.lit(False)).alias("has_alerts"),
        F.coalesce("critical_alert_count", zero).alias("critical_alerts"),
        F.coalesce("warning_alert_count", zero).alias("warning_alerts"),
        F.coalesce("inventory_utilization_percent", F.lit(0.0)).alias("inventory_utilization"),
        F.coalesce("error_rate_percent", F.lit(0.0)).alias("error_rate"),
        F.coalesce("avg_response_time_ms", F.lit(0.0)).alias("system_response_time"),
        F.coalesce("revenue_vs_baseline_percent", F.lit(0.0)).alias("revenue_vs_baseline"),
        F.coalesce("activity_vs_baseline_percent", F.lit(0.0)).alias("activity_vs_baseline"),
        F.coalesce("data_completeness_percent", F.lit(100.0)).alias("data_quality"),
        F.coalesce("last_updated", as_of).alias("last_updated"),
    )


def health(with_alerts: Column, stores: Column) -> Column:
    """Healthy without alerts, Good up to 30 % of the stores, Attention up to 60 %, else Critical."""
    return (
        F.when(with_alerts == 0, "Healthy")
        .when(with_alerts * 10 <= stores * 3, "Good")
        .when(with_alerts * 10 <= stores * 6, "Attention")
        .otherwise("Critical")
    )


def executive_summary(kpis: DataFrame, as_of: Column, window: str = "5 minutes") -> DataFrame:
    """Current velocity, today's totals, health and freshness, in one pass over today's slots.

    As in the published view, totals of today add up the per-slot rates.
    """
    slot = F.col("kpi_timestamp")
    recent = slot >= as_of - F.expr(f"INTERVAL {window}")
    today = F.to_date(slot) == F.to_date(as_of)
    rows = kpis.where((slot <= as_of) & (recent | today))

    def when(test: Column, name: str) -> Column:
        return F.when(test, F.col(name))

    alerts = F.count_if(recent & F.col("has_active_alerts"))
    stores = F.count_if(recent)
    return rows.agg(
        F.sum(when(recent, "revenue_per_minute")).alias("total_revenue_per_minute"),
        F.sum(when(recent, "rentals_per_minute")).alias("total_rentals_per_minute"),
        F.avg(when(recent, "inventory_utilization_percent")).alias("avg_inventory_utilization"),
        alerts.alias("stores_with_alerts"),
        stores.alias("total_active_stores"),
        F.sum(when(today, "revenue_per_minute")).alias("revenue_today"),
        F.sum(when(today, "rentals_per_minute")).alias("rentals_today"),
        F.count_distinct(when(today, "store_id")).alias("stores_reporting"),
        health(alerts, stores).alias("overall_health_status"),
        F.max(when(recent, "last_updated")).alias("last_data_update"),
        F.floor(minutes(F.max(when(recent, "last_updated")), as_of)).alias("data_freshness_minutes"),
    ).withColumn("dashboard_timestamp", as_of)


def metric_series(events: DataFrame, width: str = "1 hour") -> DataFrame:
    """Metrics per slot, store and event type: the number of events and their total value."""
    grouped = events.groupBy(F.window("ts", width).start.alias("captured_at"), "store_id", "event_type").agg(
        F.count(F.lit(1)).alias("_n"), F.sum("amount").alias("_v")
    )
    return grouped.select(
        "captured_at",
        "store_id",
        F.explode(
            F.array(
                F.struct(
                    F.concat(F.lit("count."), "event_type").alias("metric_name"),
                    F.col("_n").cast("decimal(18,4)").alias("metric_value"),
                ),
                F.struct(
                    F.concat(F.lit("value."), "event_type").alias("metric_name"),
                    F.col("_v").cast("decimal(18,4)").alias("metric_value"),
                ),
            )
        ).alias("_m"),
    ).select("captured_at", "store_id", "_m.metric_name", "_m.metric_value")


def with_baseline(
    series: DataFrame, history: int = 24, anomaly_percent: float = 100.0, breach: float | None = None
) -> DataFrame:
    """Trailing mean of the previous ``history`` readings, deviation and change in percent, flags.

    ``series`` holds one reading per slot, store and metric, so a series is as long as the
    clock allows, however much traffic it sums up.
    """
    line = Window.partitionBy("metric_name", "store_id").orderBy("captured_at")
    before = line.rowsBetween(-history, -1)
    value = F.col("metric_value")
    baseline = per(F.sum(value).over(before), F.count(value).over(before))
    rows = series.withColumns({"baseline_value": baseline, "previous_value": F.lag(value).over(line)})
    deviation = per(value.cast("double") - F.col("baseline_value"), F.col("baseline_value")) * 100
    change = per(value.cast("double") - F.col("previous_value").cast("double"), F.col("previous_value")) * 100
    rows = rows.withColumns({"deviation_percent": deviation, "change_percent": change})
    flagged = F.coalesce(F.abs("deviation_percent") > anomaly_percent, F.lit(False))
    rows = rows.withColumn("is_anomaly", flagged)
    if breach is not None:
        rows = rows.withColumn("alert_threshold_breached", value > F.lit(breach).cast("decimal(18,4)"))
        rows = rows.withColumn(
            "severity_level",
            F.when(F.col("is_anomaly") & F.col("alert_threshold_breached"), "critical")
            .when(F.col("is_anomaly") | F.col("alert_threshold_breached"), "warning")
            .otherwise("info"),
        )
    return rows


def trend(kpis: DataFrame, value: str = "revenue_per_minute", shift: str = "1 day") -> DataFrame:
    """Each slot next to the slot one ``shift`` earlier, with the change in percent.

    The earlier value comes from the same aggregated rows moved forward in time; one
    grouping pairs both, without a self-join.
    """
    slot, nothing = F.col("kpi_timestamp"), F.lit(None).cast(kpis.schema[value].dataType)

    def reading(at: Column, now: Column, then: Column) -> Column:
        return F.struct(at.alias("kpi_timestamp"), now.alias("_now"), then.alias("_then"))

    later = slot + F.expr(f"INTERVAL {shift}")
    both = F.array(reading(slot, F.col(value), nothing), reading(later, nothing, F.col(value)))
    pairs = kpis.select("store_id", F.inline(both)).groupBy("kpi_timestamp", "store_id").agg(
        F.max("_now").alias(value), F.max("_then").alias("earlier_value")
    )
    moved = F.col(value).cast("double") - F.col("earlier_value").cast("double")
    return pairs.where(F.col(value).isNotNull()).withColumn("trend_percent", per(moved, F.col("earlier_value")) * 100)


def completeness(kpis: DataFrame, width_minutes: int, first: Column, last: Column) -> DataFrame:
    """Share of the expected slots of each store and day that hold data, and the error rate.

    ``first`` and ``last`` bound the period; a day counts only the slots inside it.
    """
    day = F.to_date("kpi_timestamp")
    opens = F.greatest(F.date_trunc("day", F.col("kpi_date").cast("timestamp")), first)
    closes = F.least(F.col("kpi_date").cast("timestamp") + F.expr("INTERVAL 1 DAY"), last)
    rows = kpis.groupBy("store_id", day.alias("kpi_date")).agg(
        F.count(F.lit(1)).alias("observed_slots"), F.max("last_updated").alias("last_updated")
    )
    expected = F.ceil(minutes(opens, closes) / width_minutes)
    return rows.withColumn("expected_slots", expected).withColumn(
        "data_completeness_percent", per(F.col("observed_slots"), F.col("expected_slots")) * 100
    ).withColumn("data_freshness_minutes", F.floor(minutes(F.col("last_updated"), last)))
