"""Streaming KPIs. In append mode windows appear once the watermark has passed them; later events are dropped."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.functions.measures import per
from stratalake.operators import kpi
from stratalake.operators.kpi import COUNTED
from stratalake.streaming.events import HEARTBEAT, behind_watermark


def _timed(events: DataFrame, delay: str) -> DataFrame:
    return behind_watermark(events.withWatermark("ts", delay), "ts", F.col("event_type") != HEARTBEAT)


def minute_kpis(events: DataFrame, width: str = "1 minute", delay: str = "10 minutes", exact_customers: bool = False) -> DataFrame:
    """All measures of ``kpi.minute_kpis`` per slot and store.

    In append mode a slot comes out once the watermark has passed it, in update mode whenever it
    changes (see ``changes.upsert_rows``). State holds one row per open slot and store. Active
    customers are approximate, unless ``exact_customers`` keeps the ids of every open slot.
    """
    is_payment = F.col("event_type") == "payment_processed"
    is_error = F.col("event_type") == "error"
    grouped = _timed(events, delay).groupBy(F.window("ts", width).alias("_w"), "store_id")
    customers = F.size(F.collect_set("customer_id")).cast("bigint") if exact_customers else F.approx_count_distinct("customer_id")
    payments = F.count_if(is_payment)
    rows = grouped.agg(
        *[F.count_if(F.col("event_type") == kind).alias(name) for name, kind in COUNTED.items()],
        F.coalesce(F.sum(F.when(is_payment, F.col("amount"))), F.lit(0)).cast("decimal(18,2)").alias("revenue_per_minute"),
        F.coalesce(per(F.sum(F.when(is_payment, F.col("amount"))), payments), F.lit(0.0)).alias("avg_transaction_value"),
        per(F.sum("utilization"), F.count(F.lit(1))).alias("inventory_utilization_percent"),
        customers.alias("active_customers_count"),
        F.count_if(is_error).alias("_errors"),
        F.count_if(is_error & (F.col("severity") == "critical")).alias("critical_alert_count"),
        F.count_if(is_error & (F.col("severity") == "warning")).alias("warning_alert_count"),
        F.count(F.lit(1)).alias("event_count"),
        F.max("ts").alias("last_updated"),
    )
    return rows.select(
        F.col("_w.start").alias("kpi_timestamp"),
        "store_id",
        *COUNTED,
        "revenue_per_minute",
        "avg_transaction_value",
        "inventory_utilization_percent",
        "active_customers_count",
        (per(F.col("_errors"), F.col("event_count")) * 100).alias("error_rate_percent"),
        (F.col("_errors") > 0).alias("has_active_alerts"),
        "critical_alert_count",
        "warning_alert_count",
        "event_count",
        "last_updated",
    )


def with_open_slots(closed: DataFrame, events: DataFrame, width: str = "1 minute") -> DataFrame:
    """The slots a stream has written and those the last watermark has not passed.

    ``closed`` is what ``minute_kpis`` wrote of a finished run, ``events`` the same events as a
    table. Closed slots come from the stream; all events from the first open slot on are counted
    in batch, where active customers are exact.
    """
    last = closed.agg(F.max(F.unix_micros("kpi_timestamp"))).first()[0]
    if last is not None:
        first_open = F.timestamp_micros(F.lit(last)) + F.expr(f"INTERVAL {width}")
        events = events.where(F.col("ts").cast("timestamp") >= first_open)
    return closed.unionByName(kpi.minute_kpis(events, width).select(closed.columns))


def metric_series(events: DataFrame, width: str = "1 hour", delay: str = "10 minutes") -> DataFrame:
    """Stream twin of ``kpi.metric_series``: metrics of a slot once the watermark has passed it."""
    grouped = _timed(events, delay).groupBy(F.window("ts", width).alias("_w"), "store_id", "event_type")
    rows = grouped.agg(F.count(F.lit(1)).alias("_n"), F.sum("amount").alias("_v"))
    metrics = [
        F.struct(F.concat(F.lit(f"{kind}."), "event_type").alias("metric_name"), F.col(c).cast("decimal(18,4)").alias("metric_value"))
        for kind, c in (("count", "_n"), ("value", "_v"))
    ]
    rows = rows.select(F.col("_w.start").alias("captured_at"), "store_id", F.explode(F.array(*metrics)).alias("_m"))
    return rows.select("captured_at", "store_id", "_m.metric_name", "_m.metric_value")


def sliding_activity(events: DataFrame, width: str = "5 minutes", step: str = "1 minute", delay: str = "10 minutes") -> DataFrame:
    """Events and revenue per sliding window and store, by two aggregations in a chain.

    The first keeps one row of state per step and store; its closed rows, not the events, are
    then copied to the windows that contain them.
    """
    is_payment = F.col("event_type") == "payment_processed"
    steps = _timed(events, delay).groupBy(F.window("ts", step).alias("_step"), "store_id").agg(
        F.count(F.lit(1)).alias("_n"), F.sum(F.when(is_payment, F.col("amount"))).alias("_revenue")
    )
    slide = F.window(F.window_time("_step"), width, step)
    return steps.groupBy(slide.alias("_w"), "store_id").agg(
        F.sum("_n").alias("events"), F.coalesce(F.sum("_revenue"), F.lit(0)).cast("decimal(18,2)").alias("revenue")
    ).select(F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), "store_id", "events", "revenue")


def session_activity(events: DataFrame, gap: str = "30 minutes", delay: str = "10 minutes") -> DataFrame:
    """Stream twin of ``kpi.session_activity``; a session comes out once the watermark has passed its gap."""
    return kpi.sessions(_timed(events, delay), gap)
