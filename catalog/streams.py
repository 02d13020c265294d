"""Streaming queries, run to the end of the events at hand."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import binding as b
from catalog.operations import SQL_SESSIONS
from catalog.registry import query
from stratalake.operators.kpi import business_events
from stratalake.session import fresh_path
from stratalake.plans import versions
from stratalake.sources.keyed import KeyedTable
from stratalake.streaming import changes, kpis, late, stateful
from stratalake.streaming import events as ev


def _raw(spark, sf):
    schema = spark.read.parquet(f"{sf}/events.parquet").schema
    return ev.read_files(spark, sf, schema, "events*.parquet")


def _events(spark, sf):
    return business_events(b.raw_events(_raw(spark, sf)), b.EVENT_TYPES, "events")


# Slices that tables are landed in for the streams.
_PARTS = 3


def _arriving(spark, folder, schema):
    """The files of a folder, half of them in each batch, so that state goes over from one to the next."""
    files = len(spark.read.parquet(folder).inputFiles())
    return ev.read_files(spark, folder, schema, "*.parquet", per_batch=-(-files // 2))


def _replayed(spark, sf):
    """The raw events in ``_PARTS`` slices of time and a heartbeat, a file set after the other."""
    folder = fresh_path(spark, "replay")
    raw = spark.read.parquet(f"{sf}/events.parquet")
    ev.replay(raw, "ts", "event_type", _PARTS, folder)
    return _arriving(spark, folder, raw.schema)


def _replayed_events(spark, sf):
    return business_events(b.raw_events(_replayed(spark, sf)), b.EVENT_TYPES, "events")


def _finish(spark, stream, partition_by=None):
    path = fresh_path(spark, "stream")
    ev.write_events(stream, path, fresh_path(spark, "offsets"), partition_by).awaitTermination()
    return spark.read.parquet(path)


@query(
    "stream_business_events",
    """SELECT event_id, ts, store_id, customer_id, event_type, amount::DOUBLE AS amount, severity, 'events' AS source_table, 'pending' AS processing_status, 0::INT AS retry_count, ts::DATE AS event_date FROM biz_events""",
)
def stream_business_events(spark, sf):
    return _finish(spark, _events(spark, sf), "event_date").drop("utilization")


@query("stream_dedupe", "SELECT event_id, ts, event_type FROM biz_events")
def stream_dedupe(spark, sf):
    twice = _events(spark, sf).withColumn("_copy", F.explode(F.array(F.lit(1), F.lit(2)))).select("event_id", "ts", "event_type")
    return _finish(spark, ev.drop_repeats(twice, ["event_id"], "ts"))


@query(
    "stream_enrich",
    "SELECT e.event_id, e.store_id, e.event_type, s.address, s.city FROM biz_events e LEFT JOIN store s ON e.store_id = s.store_id",
)
def stream_enrich(spark, sf):
    places = b.store(spark, sf).select("store_id", "address", "city")
    events = _events(spark, sf).select("event_id", "store_id", "event_type")
    return _finish(spark, ev.enrich(events, places, "store_id"))


@query("stream_kpi", "SELECT * REPLACE (revenue_per_minute::DOUBLE AS revenue_per_minute) FROM kpi_hour")
def stream_kpi(spark, sf):
    """Every slot, open ones too: changed slots replace their row after each batch."""
    table = KeyedTable(spark, fresh_path(spark, "kpis"), ["kpi_timestamp", "store_id"], buckets=8)
    slots = kpis.minute_kpis(_replayed_events(spark, sf), "1 hour", exact_customers=True)
    changes.upsert_rows(slots, table, fresh_path(spark, "offsets")).awaitTermination()
    return table.current()


@query(
    "stream_sliding",
    """SELECT w AS window_start, w + INTERVAL 5 MINUTE AS window_end, store_id, count(*) AS events, coalesce(sum(amount) FILTER (event_type = 'payment_processed'), 0)::DOUBLE AS revenue
       FROM (SELECT *, unnest([date_trunc('minute', ts) - to_minutes(k) FOR k IN range(5)]) AS w FROM biz_events) GROUP BY ALL""",
)
def stream_sliding(spark, sf):
    return _finish(spark, kpis.sliding_activity(_replayed_events(spark, sf)))


@query("stream_sessions", SQL_SESSIONS)
def stream_sessions(spark, sf):
    return _finish(spark, kpis.session_activity(_replayed_events(spark, sf)))


@query(
    "stream_baseline",
    "SELECT captured_at, store_id, metric_name, metric_value::DOUBLE AS metric_value, baseline_value, deviation_percent, change_percent, is_anomaly FROM series_flagged",
)
def stream_baseline(spark, sf):
    return _finish(spark, stateful.running_baseline(kpis.metric_series(_replayed_events(spark, sf))))


@query(
    "stream_missing_data",
    """SELECT r.rule_id, s.store_id, t.slot AS alert_timestamp, s.metric_name FROM (SELECT DISTINCT store_id, metric_name FROM series) s JOIN rules r ON s.metric_name = r.target_metric
       JOIN (SELECT unnest(generate_series(min(captured_at), max(captured_at), INTERVAL 1 HOUR)) AS slot FROM series) t ON TRUE
       WHERE r.condition_type = 'missing_data' AND NOT EXISTS (SELECT 1 FROM series x WHERE x.store_id = s.store_id AND x.metric_name = s.metric_name AND x.captured_at = t.slot)""",
)
def stream_missing_data(spark, sf):
    """The heartbeat goes on for two days; slots behind the last event are silent for all and left out."""
    hour = F.date_trunc("hour", "ts").cast("timestamp")
    first, last = b.events(spark, sf).agg(F.min(hour), F.max(hour)).first()
    silent = stateful.missing_data(kpis.metric_series(_replayed_events(spark, sf)), b.rules(spark), F.lit(first), 60)
    return _finish(spark, silent).where(F.col("alert_timestamp") <= F.lit(last))


@query("stream_late_repair", "SELECT * REPLACE (revenue_per_minute::DOUBLE AS revenue_per_minute) FROM kpi_hour")
def stream_late_repair(spark, sf):
    """Every 40th event lands days late: the stream drops it, the repair counts its slot anew."""
    raw = spark.read.parquet(f"{sf}/events.parquet")
    folder, is_late = fresh_path(spark, "landed"), F.col("event_id") % 40 == 0
    ev.replay(raw.where(~is_late), "ts", "event_type", _PARTS, folder)
    raw.where(is_late).write.mode("append").parquet(folder)

    def landed():
        return business_events(b.raw_events(_arriving(spark, folder, raw.schema)), b.EVENT_TYPES, "events")

    slots = kpis.minute_kpis(landed(), "1 hour", exact_customers=True)
    closed = _finish(spark, slots)
    table = KeyedTable(spark, fresh_path(spark, "kpis"), ["kpi_timestamp", "store_id"], buckets=8)
    table.upsert(closed)
    aside = fresh_path(spark, "aside")
    late.put_aside(landed(), aside, fresh_path(spark, "offsets"), "1 hour").awaitTermination()
    whole = business_events(b.raw_events(spark.read.parquet(folder)), b.EVENT_TYPES, "events")
    late.repair(spark, aside, whole.where(F.col("event_type") != ev.HEARTBEAT), table, "1 hour")
    return table.current()


@query(
    "stream_run_report",
    """WITH landed AS (SELECT ts, event_id % 40 = 0 AS tardy FROM events), newest AS (SELECT max(ts) FILTER (NOT tardy) AS at_time FROM landed)
       SELECT (SELECT count(*) FROM landed) AS events_read, count(*) AS put_aside FROM landed, newest
       WHERE date_trunc('hour', ts) + INTERVAL 1 HOUR <= newest.at_time + INTERVAL 2 DAY - INTERVAL 10 MINUTE""",
)
def stream_run_report(spark, sf):
    """Rows that the batches of a stream read, as observed while they ran, and events put aside as late."""
    raw = spark.read.parquet(f"{sf}/events.parquet")
    folder, is_late = fresh_path(spark, "landed"), F.col("event_id") % 40 == 0
    ev.replay(raw.where(~is_late), "ts", "event_type", _PARTS, folder)
    raw.where(is_late).write.mode("append").parquet(folder)
    # The heartbeat is in one batch with the late events or before them: both are read by then.
    stream = business_events(b.raw_events(ev.read_files(spark, folder, raw.schema, "*.parquet")), b.EVENT_TYPES, "events")
    aside = fresh_path(spark, "aside")
    query = late.put_aside(late.observed(stream), aside, fresh_path(spark, "offsets"), "1 hour")
    query.awaitTermination()
    lines = spark.createDataFrame(late.run_report(query), late.REPORT)
    put = spark.read.parquet(f"{aside}/late").agg(F.count("*").alias("put_aside")).withColumn("_one", F.lit(1))
    read = lines.agg(F.sum("events").alias("events_read")).withColumn("_one", F.lit(1))
    return read.join(put, "_one").drop("_one")


def _entries(spark, sf):
    return _entries_of(_raw(spark, sf))


def _entries_of(raw):
    return raw.selectExpr(
        "event_id AS lsn",
        "CASE event_type WHEN 'signup' THEN 'I' WHEN 'error' THEN 'D' ELSE 'U' END AS op",
        "ts AS load_ts",
        "user_id",
        "cast(value AS decimal(18,2)) AS amount",
    )


@query("stream_scd2", "SELECT user_id, amount::DOUBLE AS amount, sys_start, sys_end FROM hist")
def stream_scd2(spark, sf):
    """The log in several batches of log order; each rewrites the buckets of its keys only."""
    raw = spark.read.parquet(f"{sf}/events.parquet")
    folder = fresh_path(spark, "log")
    ev.replay_by(raw, "event_id", _PARTS, folder)
    log = _entries_of(ev.read_files(spark, folder, raw.schema, "*.parquet", per_batch=1))
    table = KeyedTable(spark, fresh_path(spark, "versions"), ["user_id"], buckets=8)
    changes.maintain_history(log, table, "user_id", "lsn", "load_ts", ["amount"], fresh_path(spark, "offsets")).awaitTermination()
    return versions.history(table)


@query("stream_cdc_append", "SELECT lsn, op, load_ts, user_id, amount::DOUBLE AS amount FROM change_log")
def stream_cdc_append(spark, sf):
    path = fresh_path(spark, "log")
    changes.append_changes(_entries(spark, sf), path, fresh_path(spark, "offsets")).awaitTermination()
    return spark.read.parquet(path).drop("batch_id")


@query(
    "stream_alert_suppressed",
    """WITH RECURSIVE raised AS (SELECT DISTINCT r.rule_id, e.store_id, e.ts AS alert_timestamp, r.suppress_duplicate_minutes AS wait
           FROM biz_events e JOIN rules r ON r.rule_id = e.event_id % 10 WHERE e.event_type = 'error'),
         chain AS (SELECT rule_id, store_id, wait, min(alert_timestamp) AS alert_timestamp FROM raised GROUP BY ALL
         UNION ALL SELECT c.rule_id, c.store_id, c.wait, min(s.alert_timestamp) FROM chain c
           JOIN raised s ON s.rule_id = c.rule_id AND s.store_id = c.store_id AND s.alert_timestamp >= c.alert_timestamp + to_minutes(c.wait::BIGINT)
           GROUP BY c.rule_id, c.store_id, c.wait, c.alert_timestamp)
       SELECT rule_id, store_id, alert_timestamp FROM chain""",
)
def stream_alert_suppressed(spark, sf):
    """By true instants and with the wait of each rule; alerts of no rule go."""
    timed = _replayed_events(spark, sf).withWatermark("ts", "10 minutes")
    errors = ev.behind_watermark(timed, "ts", F.col("event_type") == "error")
    raised = errors.select((F.col("event_id") % 10).cast("int").alias("rule_id"), "store_id", F.col("ts").alias("alert_timestamp"))
    return _finish(spark, stateful.suppress_repeats(raised, b.rules(spark)))
