"""Alert rules over metric series, and the life of an alert.

Rules are a small configuration table: ``rule_id, target_metric, condition_type,
threshold_value, default_severity, store_filter, time_of_day_filter,
day_of_week_filter, suppress_duplicate_minutes, escalation_minutes,
max_escalation_level, is_active, is_test_mode``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratalake.functions.measures import minutes
from stratalake.operators.joins import broadcast_checked

# Opening hours used by the time-of-day filter, first and last hour included.
BUSINESS_HOURS = (9, 17)


def applicable(slot: str = "captured_at") -> Column:
    """Whether a rule that is joined to a reading applies to its store, hour and weekday."""
    hour, weekend = F.hour(slot), F.dayofweek(slot).isin(1, 7)
    office = hour.between(*BUSINESS_HOURS)
    time_ok = (
        F.when(F.col("time_of_day_filter") == "business_hours", office)
        .when(F.col("time_of_day_filter") == "after_hours", ~office)
        .otherwise(F.lit(True))
    )
    day_ok = (
        F.when(F.col("day_of_week_filter") == "weekdays", ~weekend)
        .when(F.col("day_of_week_filter") == "weekends", weekend)
        .otherwise(F.lit(True))
    )
    store_ok = F.col("store_filter").isNull() | (F.col("store_filter") == F.col("store_id"))
    return store_ok & time_ok & day_ok


def _fires() -> Column:
    kind, value, limit = F.col("condition_type"), F.col("metric_value"), F.col("threshold_value")
    fires = (
        F.when(kind == "greater_than", value > limit)
        .when(kind == "less_than", value < limit)
        .when(kind == "equals", value == limit)
        .when(kind == "not_equals", value != limit)
        .when(kind == "percentage_change", F.abs("change_percent") > limit.cast("double"))
        .when(kind == "anomaly_detected", F.col("is_anomaly"))
    )
    return F.coalesce(fires, F.lit(False))


def evaluate(series: DataFrame, rules: DataFrame, test_mode: bool = False) -> DataFrame:
    """Readings that violate an active rule.

    Rules meet readings by metric name, so every reading sees only its own rules. Test
    rules are evaluated apart: they never mix with alerts that notify.
    """
    live = rules.where("is_active").where(F.col("is_test_mode") == test_mode)
    joined = series.join(broadcast_checked(live), series["metric_name"] == live["target_metric"])
    return joined.where(applicable() & _fires()).select(
        "rule_id",
        "store_id",
        F.col("captured_at").alias("alert_timestamp"),
        "metric_name",
        F.col("metric_value").alias("source_value"),
        "threshold_value",
        F.col("default_severity").alias("severity"),
    )


def missing_data(series: DataFrame, rules: DataFrame, first: Column, last: Column, step: str) -> DataFrame:
    """Slots in which a metric under a ``missing_data`` rule reported nothing, per known store.

    The expected slots grow with time, stores and rules, not with traffic.
    """
    wanted = broadcast_checked(rules.where("is_active").where(F.col("condition_type") == "missing_data"))
    stores = series.select("store_id", "metric_name").distinct()
    expected = (
        stores.join(wanted, stores["metric_name"] == wanted["target_metric"])
        .where(F.col("store_filter").isNull() | (F.col("store_filter") == F.col("store_id")))
        .select(
            "rule_id",
            "metric_name",
            "store_id",
            F.explode(F.sequence(first, last, F.expr(f"INTERVAL {step}"))).alias("captured_at"),
        )
    )
    return expected.join(series, ["metric_name", "store_id", "captured_at"], "left_anti").select(
        "rule_id", "store_id", F.col("captured_at").alias("alert_timestamp"), "metric_name"
    )


def outside_maintenance(alerts: DataFrame, rules: DataFrame, windows: DataFrame) -> DataFrame:
    """Drop what rules with ``suppress_during_maintenance`` raised while their store was under maintenance.

    ``windows`` has ``store_id`` (NULL: all stores), ``begins_at`` and ``ends_at``, which is the
    first instant outside. Rules without the column are suppressed, as is the default. Windows meet
    alerts day by day, so that no alert is compared with all of them.
    """
    flag = F.col("suppress_during_maintenance") if "suppress_during_maintenance" in rules.columns else F.lit(True)
    quiet = rules.select("rule_id", F.coalesce(flag, F.lit(True)).alias("_quiet"))
    days = F.sequence(F.to_date("begins_at"), F.to_date(F.timestamp_micros(F.unix_micros(F.col("ends_at").cast("timestamp")) - 1)))
    closed = windows.where("begins_at < ends_at").select(
        F.col("store_id").alias("_store"), F.col("begins_at").alias("_from"), F.col("ends_at").alias("_to"), F.explode(days).alias("_day")
    )
    raised = alerts.join(quiet, "rule_id", "left").withColumn("_at_day", F.to_date("alert_timestamp"))
    at, store = F.col("alert_timestamp"), F.col("_store")
    inside = (F.col("_at_day") == F.col("_day")) & F.coalesce("_quiet", F.lit(True)) & (at >= F.col("_from")) & (at < F.col("_to"))
    return raised.join(closed, inside & (store.isNull() | (store == F.col("store_id"))), "left_anti").select(alerts.columns)


def suppress(alerts: DataFrame, rules: DataFrame) -> DataFrame:
    """Drop repeats of a rule and store within its ``suppress_duplicate_minutes``.

    An alert is kept when the last *kept* one is at least that old, by their true instants, so
    alerts are followed in order. The count starts anew after every quiet gap of that length;
    the chains between such gaps are independent and spread over the tasks. A task jumps from
    kept alert to kept alert and remembers only the last one. Rules with a wait of 0 keep all.
    """
    wait = F.col("suppress_duplicate_minutes").cast("bigint") * F.lit(60_000_000)
    quiet = rules.select("rule_id", F.coalesce(wait, F.lit(0)).alias("_quiet"))
    names = ["rule_id", "store_id", "alert_timestamp"]
    raised = alerts.select(*names, F.unix_micros(F.col("alert_timestamp").cast("timestamp")).alias("_at"))
    raised = raised.join(broadcast_checked(quiet), "rule_id")
    line = Window.partitionBy("rule_id", "store_id").orderBy("_at")
    begins = F.coalesce(F.col("_at") - F.lag("_at").over(line) >= F.col("_quiet"), F.lit(True))
    chain = ["rule_id", "store_id", "_chain"]
    chains = raised.where("_quiet > 0").withColumn("_begins", begins)
    chains = chains.withColumn("_chain", F.sum(F.col("_begins").cast("int")).over(line))
    ordered = chains.repartition(*chain).sortWithinPartitions(*chain, "_at", F.desc("_begins"))

    def keep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last = 0
        for batch in batches:
            at, quiet = batch["_at"].to_numpy(), batch["_quiet"].to_numpy()
            begins = batch["_begins"].to_numpy(dtype=bool)
            borders = sorted({0, len(at), *np.flatnonzero(begins).tolist()})
            kept = []
            for start, stop in zip(borders, borders[1:]):
                own, wait = at[start:stop], quiet[start]
                # The first rows of a batch may go on with the chain of the batch before.
                here = 0 if begins[start] else np.searchsorted(own, last + wait)
                while here < len(own):
                    kept.append(start + here)
                    last = own[here]
                    here = np.searchsorted(own, last + wait)
            yield batch.iloc[kept][names]

    kinds = dict(raised.dtypes)
    schema = ", ".join(f"{c} {kinds[c]}" for c in names)
    return ordered.mapInPandas(keep, schema).unionByName(raised.where("_quiet <= 0").select(*names))


def escalation_level(raised: Column, acknowledged: Column, as_of: Column, every: Column, limit: Column) -> Column:
    """Completed waiting periods without acknowledgement, at most ``limit``."""
    waited = minutes(raised, F.coalesce(acknowledged, as_of))
    return F.greatest(F.least(F.floor(waited / every), limit), F.lit(0)).cast("int")


def priority(severity: Column, level: Column) -> Column:
    """100 to 50: critical before warning before the rest, escalated first."""
    return (
        F.when(severity == "critical", F.lit(80) + F.least(level, F.lit(2)) * 10)
        .when(severity == "warning", F.when(level >= 1, 70).otherwise(60))
        .otherwise(50)
        .cast("int")
    )


def status(resolved: Column, acknowledged: Column, active: Column) -> Column:
    return (
        F.when(resolved.isNotNull(), "resolved")
        .when(acknowledged.isNotNull(), "acknowledged")
        .when(~active, "suppressed")
        .otherwise("active")
    )


def board(alerts: DataFrame, as_of: Column, window: str = "24 hours") -> DataFrame:
    """Alerts raised inside the window with status, durations and priority."""
    raised = F.col("alert_timestamp")
    recent = alerts.where((raised >= as_of - F.expr(f"INTERVAL {window}")) & (raised <= as_of))
    return recent.withColumns(
        {
            "current_status": status(F.col("resolved_at"), F.col("acknowledged_at"), F.col("is_active")),
            "duration_minutes": minutes(raised, F.coalesce("resolved_at", as_of)),
            "time_to_acknowledge_minutes": minutes(raised, F.coalesce("acknowledged_at", as_of)),
            "priority_score": priority(F.col("severity"), F.col("escalation_level")),
        }
    )


def sla(rows: DataFrame, limits: dict[str, int], default: int) -> DataFrame:
    """Breach of the time allowed per severity, impact label and resolution time, on a board."""
    allowed = F.lit(default)
    for severity, limit in limits.items():
        allowed = F.when(F.col("severity") == severity, F.lit(limit)).otherwise(allowed)
    breach = F.col("duration_minutes") > allowed
    impact = (
        F.when((F.col("severity") == "critical") & breach, "high")
        .when((F.col("severity") == "critical") | breach, "medium")
        .otherwise("low")
    )
    resolution = F.when(F.col("current_status") == "resolved", F.floor("duration_minutes")).cast("bigint")
    return rows.withColumns(
        {"sla_breach": breach, "business_impact": impact, "actual_resolution_time": resolution}
    )


def rule_statistics(alerts: DataFrame, rule: str, as_of: Column) -> DataFrame:
    """Per rule: alerts in the last 24 hours, last trigger and average minutes to resolve."""
    raised = F.col("alert_timestamp")
    spent = F.unix_micros("resolved_at") - F.unix_micros(raised)
    past = alerts.where(raised <= as_of)
    return past.groupBy(rule).agg(
        F.count_if(raised >= as_of - F.expr("INTERVAL 24 HOURS")).alias("alert_count_last_24h"),
        F.max(raised).alias("last_triggered_at"),
        (F.try_divide(F.sum(spent).cast("double"), F.count(spent).cast("double")) / F.lit(6e7)).alias(
            "avg_resolution_minutes"
        ),
    )
