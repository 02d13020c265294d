"""Change log, versioned tables and reference merges."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import binding as b
from catalog.registry import query
from stratalake.operators import cdc, reference, temporal
from stratalake.plans import versions
from stratalake.plans.changes import ingest_changes, read_log
from stratalake.session import fresh_path, pin
from stratalake.sources import sinks, tables
from stratalake.sources.keyed import KeyedTable

NOW = f"TIMESTAMP '{b.AS_OF_TIME}'"
OPEN = f"TIMESTAMP '{temporal.OPEN_END}'"


def log(spark, sf):
    return b.change_log(spark, sf)


def hist(spark, sf):
    return temporal.scd2_from_log(log(spark, sf), "user_id", "lsn", "load_ts", ["amount"])


# --- change log ----------------------------------------------------------------------


@query(
    "cdc_payload",
    """SELECT row_number() OVER (ORDER BY rental_id) + 1000 AS lsn, CASE WHEN return_date IS NULL THEN 'I' ELSE 'U' END AS op,
       CASE WHEN return_date IS NULL THEN to_json({'rental_id': rental_id::VARCHAR, 'customer_id': customer_id::VARCHAR, 'rental_date': rental_date::VARCHAR})
         ELSE to_json({'rental_id': rental_id::VARCHAR, 'customer_id': customer_id::VARCHAR, 'rental_date': rental_date::VARCHAR, 'return_date': return_date::VARCHAR}) END::VARCHAR AS full_row,
       rental_date AS load_ts FROM rental""",
)
def cdc_payload(spark, sf):
    op = F.when(F.col("return_date").isNull(), "I").otherwise("U")
    columns = ["rental_id", "customer_id", "rental_date", "return_date"]
    return cdc.to_change_log(b.rental(spark, sf), ["rental_id"], op, F.col("rental_date"), 1000, columns)


@query(
    "cdc_ingest",
    """SELECT lsn, op, json_extract_string(full_row, '$.rental_id') AS rental_id FROM (
         SELECT row_number() OVER (ORDER BY rental_date >= TIMESTAMP '1998-01-01', rental_date, rental_id) AS lsn, CASE WHEN return_date IS NULL THEN 'I' ELSE 'U' END AS op,
           to_json({'rental_id': rental_id::VARCHAR}) AS full_row FROM rental)""",
)
def cdc_ingest(spark, sf):
    """Two batches and a retry of the second."""
    path = fresh_path(spark, "ingest")
    op = F.when(F.col("return_date").isNull(), "I").otherwise("U")
    cut = F.lit("1998-01-01").cast("timestamp")
    rentals = b.rental(spark, sf)
    parts = {"batch_1": rentals.where(F.col("rental_date") < cut), "batch_2": rentals.where(F.col("rental_date") >= cut)}
    for batch in ("batch_1", "batch_2", "batch_2"):
        ingest_changes(parts[batch], path, batch, ["rental_date", "rental_id"], op, F.col("rental_date"), ["rental_id", "return_date"])
    return read_log(spark, path).select("lsn", "op", cdc.value("rental_id").alias("rental_id"))


@query("high_watermark", "SELECT max(lsn) AS high_watermark FROM change_log WHERE load_ts < TIMESTAMP '2024-01-20 12:00:00'")
def high_watermark(spark, sf):
    return cdc.high_watermark(log(spark, sf).where(F.col("load_ts") < b.as_of_time()))


@query(
    "cdc_incremental",
    "SELECT lsn, op, load_ts, user_id FROM change_log WHERE lsn > (SELECT max(lsn) FROM change_log WHERE load_ts < TIMESTAMP '2024-01-20 12:00:00')",
)
def cdc_incremental(spark, sf):
    entries = log(spark, sf).select("lsn", "op", "load_ts", "user_id")
    # One number leaves the cluster; the next run filters its scan with it.
    last = cdc.high_watermark(entries.where(F.col("load_ts") < b.as_of_time())).first()[0]
    return cdc.changes_after(entries, last)


@query("cdc_append", "SELECT op, count(*) AS entries, max(lsn) AS last_lsn FROM change_log GROUP BY ALL")
def cdc_append(spark, sf):
    path = fresh_path(spark, "cdc")
    entries = log(spark, sf).select("lsn", "op", "full_row", "load_ts")
    half = cdc.high_watermark(entries.where(F.col("load_ts") < b.as_of_time())).first()[0]
    sinks.write_append(entries.where(F.col("lsn") <= half), path, "1")
    for _ in range(2):  # the second write is a retry of the same batch
        sinks.write_append(cdc.changes_after(entries, half), path, "2")
    return spark.read.parquet(path).groupBy("op").agg(F.count(F.lit(1)).alias("entries"), F.max("lsn").alias("last_lsn"))


@query(
    "cdc_dedupe",
    "SELECT lsn, op, CASE WHEN op = 'D' THEN load_ts + INTERVAL 1 MINUTE ELSE load_ts END AS load_ts, user_id FROM change_log",
)
def cdc_dedupe(spark, sf):
    entries = log(spark, sf).select("lsn", "op", "load_ts", "user_id")
    # Deletions come again a minute later, inserts come twice as they are.
    later = entries.where("op = 'D'").withColumn("load_ts", F.col("load_ts") + F.expr("INTERVAL 1 MINUTE"))
    return cdc.dedupe(later.unionByName(entries).unionByName(entries.where("op = 'I'")))


@query(
    "cdc_current_state",
    "SELECT user_id, lsn, amount::DOUBLE AS amount FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY lsn DESC) AS rn FROM change_log) WHERE rn = 1 AND op <> 'D'",
)
def cdc_current_state(spark, sf):
    return cdc.state_from_log(log(spark, sf), "user_id", ["amount"])


@query("op_distribution", "SELECT op, count(*) AS entries FROM change_log GROUP BY ALL")
def op_distribution(spark, sf):
    return cdc.op_distribution(log(spark, sf))


@query(
    "json_revenue",
    "SELECT date_trunc('month', (full_row::JSON->>'at')::TIMESTAMP)::DATE AS month, sum((full_row::JSON->>'amount')::DECIMAL(18,4))::DOUBLE AS revenue, count(*) AS inserts FROM change_log WHERE op = 'I' GROUP BY ALL",
)
def json_revenue(spark, sf):
    """Payloads are parsed when the log lands and read by path from then on."""
    entries, _ = cdc.parsed(log(spark, sf))
    return cdc.inserted_revenue(pin(entries, "landed"), "amount", "at")


SQL_BROKEN = """SELECT lsn, op, load_ts, CASE lsn % 10 WHEN 0 THEN '[' || full_row || ']' WHEN 1 THEN substr(full_row, 2) WHEN 2 THEN NULL ELSE full_row END AS full_row FROM change_log"""


def _broken(spark, sf):
    payload = "CASE lsn % 10 WHEN 0 THEN concat('[', full_row, ']') WHEN 1 THEN substr(full_row, 2) WHEN 2 THEN NULL ELSE full_row END"
    return log(spark, sf).selectExpr("lsn", "op", "load_ts", f"{payload} AS full_row")


@query(
    "payload_quarantine",
    f"""SELECT lsn, op, CASE WHEN full_row IS NULL THEN 'no payload' ELSE 'no object' END AS fault
        FROM ({SQL_BROKEN}) WHERE full_row IS NULL OR NOT json_valid(full_row) OR json_type(full_row) <> 'OBJECT'""",
)
def payload_quarantine(spark, sf):
    _, faulty = cdc.parsed(_broken(spark, sf))
    return faulty.select("lsn", "op", "fault")


@query("json_valid", f"SELECT lsn, coalesce(CASE WHEN json_valid(full_row) THEN json_type(full_row) = 'OBJECT' ELSE FALSE END, FALSE) AS is_object FROM ({SQL_BROKEN})")
def json_valid(spark, sf):
    return _broken(spark, sf).select("lsn", cdc.is_object(F.col("full_row")).alias("is_object"))


@query(
    "cdc_validate",
    f"""SELECT 'clean' AS table_name, count(*) AS total_records, count(DISTINCT lsn) AS unique_lsns, min(lsn) AS min_lsn, max(lsn) AS max_lsn, count(*) AS valid_payloads,
        count(*) FILTER (op IN ('I', 'U', 'D')) AS known_ops, TRUE AS passed FROM change_log
        UNION ALL SELECT 'broken', count(*), count(DISTINCT lsn), min(lsn), max(lsn), count(*) FILTER (json_valid(full_row) AND lsn % 10 <> 0), count(*), FALSE FROM ({SQL_BROKEN})""",
)
def cdc_validate(spark, sf):
    return cdc.validate(log(spark, sf), "clean").unionByName(cdc.validate(_broken(spark, sf), "broken"))


@query(
    "cdc_lag",
    """SELECT 'change_log' AS table_name, date_diff('microsecond', max(load_ts), TIMESTAMP '2024-01-31 00:00:00') / 6e7 AS lag_minutes, count(*) AS total_records, max(lsn) AS latest_lsn,
       date_diff('microsecond', max(load_ts), TIMESTAMP '2024-01-31 00:00:00') / 6e7 > 10 AS alert_required FROM change_log""",
)
def cdc_lag(spark, sf):
    return cdc.lag_report(log(spark, sf), "change_log", F.lit("2024-01-31 00:00:00").cast("timestamp"))


# --- versions ------------------------------------------------------------------------


@query("scd2_from_log", "SELECT user_id, amount::DOUBLE AS amount, sys_start, sys_end FROM hist")
def scd2_from_log(spark, sf):
    return hist(spark, sf)


@query(
    "scd2_excluded_cols",
    f"""SELECT user_id, event_type, amount::DOUBLE AS amount, sys_start, sys_end FROM (
        SELECT user_id, op, event_type, amount, load_ts AS sys_start, coalesce(lead(load_ts) OVER (PARTITION BY user_id ORDER BY lsn), {OPEN}) AS sys_end FROM (
          SELECT *, lag(op) OVER w AS was_op, lag(event_type) OVER w AS was FROM change_log WINDOW w AS (PARTITION BY user_id ORDER BY lsn))
        WHERE NOT (op <> 'D' AND was_op IS NOT NULL AND was_op <> 'D' AND event_type = was)) WHERE op <> 'D'""",
)
def scd2_excluded_cols(spark, sf):
    return temporal.scd2_from_log(log(spark, sf), "user_id", "lsn", "load_ts", ["event_type", "amount"], exclude=["amount"])


SQL_SPLIT = """hist_cut AS (SELECT user_id, kind, amount, sys_start, sys_end FROM (
      SELECT user_id, op, event_type AS kind, amount, load_ts AS sys_start, coalesce(lead(load_ts) OVER (PARTITION BY user_id ORDER BY lsn), TIMESTAMP '9999-12-31 00:00:00') AS sys_end
      FROM change_log WHERE load_ts < TIMESTAMP '2024-01-20 12:00:00') WHERE op <> 'D'),
    src AS (SELECT user_id, kind, amount FROM (SELECT user_id, op, event_type AS kind, amount, row_number() OVER (PARTITION BY user_id ORDER BY lsn DESC) AS rn FROM change_log) WHERE rn = 1 AND op <> 'D')"""


def _split(spark, sf):
    entries = log(spark, sf).withColumnRenamed("event_type", "kind")
    early = entries.where(F.col("load_ts") < b.as_of_time())
    old = temporal.scd2_from_log(early, "user_id", "lsn", "load_ts", ["kind", "amount"])
    return old, cdc.state_from_log(entries, "user_id", ["kind", "amount"]).drop("lsn")


@query(
    "scd2_merge",
    f"""WITH {SQL_SPLIT}
        SELECT user_id, kind, amount::DOUBLE AS amount, sys_start, sys_end FROM hist_cut WHERE sys_end <> {OPEN}
        UNION ALL SELECT h.user_id, h.kind, h.amount::DOUBLE, h.sys_start, CASE WHEN s.user_id IS NULL OR s.kind IS DISTINCT FROM h.kind OR s.amount IS DISTINCT FROM h.amount THEN {NOW} ELSE h.sys_end END
          FROM hist_cut h LEFT JOIN src s ON h.user_id = s.user_id WHERE h.sys_end = {OPEN}
        UNION ALL SELECT s.user_id, s.kind, s.amount::DOUBLE, {NOW}, {OPEN} FROM src s LEFT JOIN (SELECT * FROM hist_cut WHERE sys_end = {OPEN}) h ON h.user_id = s.user_id
          WHERE h.user_id IS NULL OR s.kind IS DISTINCT FROM h.kind OR s.amount IS DISTINCT FROM h.amount""",
)
def scd2_merge(spark, sf):
    old, source = _split(spark, sf)
    return temporal.scd2_merge(old, source, "user_id", ["kind", "amount"], b.as_of_time(), close_missing=True)


@query(
    "scd2_merge_stored",
    f"""WITH {SQL_SPLIT}
        SELECT user_id, kind, amount::DOUBLE AS amount, sys_start, sys_end FROM hist_cut WHERE sys_end <> {OPEN}
        UNION ALL SELECT h.user_id, h.kind, h.amount::DOUBLE, h.sys_start, CASE WHEN s.user_id IS NULL OR s.kind IS DISTINCT FROM h.kind OR s.amount IS DISTINCT FROM h.amount THEN {NOW} ELSE h.sys_end END
          FROM hist_cut h LEFT JOIN src s ON h.user_id = s.user_id WHERE h.sys_end = {OPEN}
        UNION ALL SELECT s.user_id, s.kind, s.amount::DOUBLE, {NOW}, {OPEN} FROM src s LEFT JOIN (SELECT * FROM hist_cut WHERE sys_end = {OPEN}) h ON h.user_id = s.user_id
          WHERE h.user_id IS NULL OR s.kind IS DISTINCT FROM h.kind OR s.amount IS DISTINCT FROM h.amount""",
)
def scd2_merge_stored(spark, sf):
    """The same merge on a keyed table: two batches of the log, then a snapshot; each writes what changed."""
    entries = log(spark, sf).withColumnRenamed("event_type", "kind").where(F.col("load_ts") < b.as_of_time())
    half = F.lit("2024-01-10 00:00:00").cast("timestamp")
    table = KeyedTable(spark, fresh_path(spark, "history"), ["user_id"], buckets=16)
    for part in (F.col("load_ts") < half, F.col("load_ts") >= half):
        versions.extend_history(table, entries.where(part), "user_id", "lsn", "load_ts", ["kind", "amount"])
    _, source = _split(spark, sf)
    versions.merge_snapshot(table, source, "user_id", ["kind", "amount"], b.as_of_time(), close_missing=True)
    return versions.history(table)


@query(
    "bitemporal_history",
    f"""SELECT user_id, lsn, amount::DOUBLE AS amount, effective_from, effective_to, system_from, system_to, operation_type, effective_from < effective_to AND system_from < system_to AS is_valid_range FROM (
        SELECT *, coalesce(lead(ef) OVER w, {OPEN}) AS effective_to, ef AS effective_from, sf AS system_from, coalesce(lead(sf) OVER w, {OPEN}) AS system_to,
          CASE WHEN lead(op) OVER w = 'D' THEN NULL WHEN op = 'I' THEN 1 ELSE 0 END::INT AS operation_type
        FROM (SELECT *, CASE WHEN op = 'D' THEN load_ts ELSE eff END AS ef,
            CASE op WHEN 'I' THEN eff WHEN 'U' THEN CASE WHEN abs(date_diff('microsecond', eff, load_ts)) < 10000 THEN eff ELSE load_ts END ELSE load_ts END AS sf
          FROM (SELECT *, load_ts - to_hours(lsn % 4) - to_milliseconds(lsn % 20) AS eff FROM change_log))
        WINDOW w AS (PARTITION BY user_id ORDER BY lsn)) WHERE op <> 'D'""",
)
def bitemporal_history(spark, sf):
    back = F.expr("load_ts - make_dt_interval(0, cast(lsn % 4 AS int), 0, cast((lsn % 20) / 1000 AS decimal(18,6)))")
    entries = log(spark, sf).withColumn("eff", back)
    return temporal.bitemporal_history(entries, "user_id", "lsn", "eff", "load_ts", ["amount"])


@query("current_state", f"SELECT user_id, amount::DOUBLE AS amount, sys_start FROM hist WHERE sys_end = {OPEN}")
def current_state(spark, sf):
    return temporal.current_state(hist(spark, sf)).select("user_id", "amount", "sys_start")


@query("as_of_snapshot", f"SELECT user_id, amount::DOUBLE AS amount, sys_start FROM hist WHERE sys_start <= {NOW} AND {NOW} < sys_end")
def as_of_snapshot(spark, sf):
    return temporal.as_of(hist(spark, sf), b.as_of_time()).select("user_id", "amount", "sys_start")


@query(
    "as_of_join",
    """SELECT e.event_id, e.user_id, e.ts, h.amount::DOUBLE AS amount FROM (SELECT event_id, user_id + 7 AS user_id, ts FROM events WHERE event_type = 'purchase') e
       LEFT JOIN hist h ON e.user_id = h.user_id AND h.sys_start <= e.ts AND e.ts < h.sys_end""",
)
def as_of_join(spark, sf):
    purchases = tables.read_table(spark, sf, "events").where("event_type = 'purchase'")
    # Shifted, so that facts fall between the versions of another user and the last users have none.
    facts = purchases.selectExpr("event_id", "user_id + 7 AS user_id", "ts")
    return temporal.as_of_join(facts, hist(spark, sf), "user_id", "ts", "event_id", ["amount"])


@query("version_history", "SELECT user_id, amount::DOUBLE AS amount, sys_start, sys_end FROM hist ORDER BY user_id, sys_start")
def version_history(spark, sf):
    return temporal.version_history(hist(spark, sf), "user_id")


@query("changed_since", f"SELECT user_id, amount::DOUBLE AS amount, sys_start FROM hist WHERE sys_start >= {NOW} - INTERVAL 1 HOUR")
def changed_since(spark, sf):
    since = b.as_of_time() - F.expr("INTERVAL 1 HOUR")
    return temporal.changed_since(hist(spark, sf), since).select("user_id", "amount", "sys_start")


@query(
    "systime_start",
    """SELECT lsn, CASE WHEN abs(date_diff('microsecond', load_ts - to_milliseconds(lsn % 20), load_ts)) < 10000 THEN load_ts - to_milliseconds(lsn % 20) ELSE load_ts END AS sys_start FROM change_log""",
)
def systime_start(spark, sf):
    eff = F.expr("load_ts - make_dt_interval(0, 0, 0, cast((lsn % 20) / 1000 AS decimal(18,6)))")
    return log(spark, sf).select("lsn", temporal.systime_start(eff, F.col("load_ts")).alias("sys_start"))


SQL_DAMAGED = """SELECT user_id, CASE WHEN amount > 300 THEN sys_start - INTERVAL 2 HOUR ELSE sys_start END AS sys_start, CASE WHEN amount < 1 THEN sys_start ELSE sys_end END AS sys_end FROM hist"""


@query(
    "interval_violations",
    f"""SELECT user_id, count(*) FILTER (pe > sys_start) AS "overlaps", count(*) FILTER (pe < sys_start) AS gaps, count(*) FILTER (sys_start >= sys_end) AS empty_ranges,
        count(*) FILTER (sys_end = {OPEN}) AS open_versions FROM (SELECT *, max(sys_end) OVER (PARTITION BY user_id ORDER BY sys_start, sys_end ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pe FROM ({SQL_DAMAGED})) GROUP BY user_id
        HAVING "overlaps" > 0 OR gaps > 0 OR empty_ranges > 0 OR open_versions <> 1""",
)
def interval_violations(spark, sf):
    damaged = hist(spark, sf).selectExpr(
        "user_id",
        "CASE WHEN amount > 300 THEN sys_start - INTERVAL 2 HOURS ELSE sys_start END AS sys_start",
        "CASE WHEN amount < 1 THEN sys_start ELSE sys_end END AS sys_end",
    )
    return temporal.interval_violations(damaged, "user_id")


# --- reference tables ----------------------------------------------------------------

SQL_REFERENCE = """cur AS (SELECT p_partkey AS id, p_name AS name, p_brand AS brand, CASE WHEN p_size % 10 = 0 THEN TIMESTAMP '2020-01-01' END AS inactivated_date,
      TIMESTAMP '2019-01-01' AS systime FROM part),
    fresh AS (SELECT p_partkey AS id, CASE WHEN p_type = 'PROMO' THEN upper(p_name) ELSE p_name END AS name, CASE WHEN p_type = 'SMALL' THEN NULL ELSE p_brand END AS brand FROM part WHERE p_type <> 'ECONOMY'
      UNION ALL SELECT s_suppkey + 1000000000, s_name, 'Supplier' FROM supplier)"""
_AT = "2024-03-01 00:00:00"


def _reference(spark, sf):
    current = tables.read_table(spark, sf, "part").selectExpr(
        "p_partkey AS id", "p_name AS name", "p_brand AS brand",
        "CASE WHEN p_size % 10 = 0 THEN timestamp'2020-01-01' END AS inactivated_date", "timestamp'2019-01-01' AS systime",
    )
    # The new list drops a type of part, renames another, loses the brand of a third and adds suppliers.
    changed = tables.read_table(spark, sf, "part").where("p_type <> 'ECONOMY'").selectExpr(
        "p_partkey AS id", "CASE WHEN p_type = 'PROMO' THEN upper(p_name) ELSE p_name END AS name", "CASE WHEN p_type = 'SMALL' THEN NULL ELSE p_brand END AS brand"
    )
    added = tables.read_table(spark, sf, "supplier").selectExpr("s_suppkey + 1000000000 AS id", "s_name AS name", "'Supplier' AS brand")
    return current, changed.unionByName(added), F.lit(_AT).cast("timestamp")


@query(
    "merge_reference",
    f"""WITH {SQL_REFERENCE} SELECT coalesce(c.id, f.id) AS id, CASE WHEN f.id IS NULL THEN c.name ELSE f.name END AS name, CASE WHEN f.id IS NULL THEN c.brand ELSE f.brand END AS brand,
        CASE WHEN f.id IS NULL THEN coalesce(c.inactivated_date, TIMESTAMP '{_AT}') ELSE c.inactivated_date END AS inactivated_date,
        CASE WHEN c.id IS NULL OR (f.id IS NOT NULL AND (c.name IS DISTINCT FROM f.name OR c.brand IS DISTINCT FROM f.brand)) THEN TIMESTAMP '{_AT}' ELSE c.systime END AS systime
        FROM cur c FULL JOIN fresh f ON c.id = f.id""",
)
def merge_reference(spark, sf):
    current, fresh, at = _reference(spark, sf)
    return reference.merge_reference(current, fresh, "id", ["name", "brand"], at)


SQL_INCOMING = f"""{SQL_REFERENCE}, incoming AS (SELECT id, name, brand, CASE WHEN name LIKE 'red%' THEN TIMESTAMP '2023-01-01' END AS inactivated_date FROM fresh),
    live AS (SELECT * FROM incoming WHERE inactivated_date IS NULL)"""


def _sync(spark, sf, strict):
    current, fresh, at = _reference(spark, sf)
    incoming = fresh.withColumn("inactivated_date", F.when(F.col("name").startswith("red"), F.lit("2023-01-01").cast("timestamp")))
    return reference.sync_reference(current, incoming, "id", at, strict=strict)


@query("sync_strict", f"WITH {SQL_INCOMING} SELECT *, TIMESTAMP '{_AT}' AS systime FROM live")
def sync_strict(spark, sf):
    return _sync(spark, sf, True)


@query(
    "sync_upsert",
    f"WITH {SQL_INCOMING} SELECT *, TIMESTAMP '{_AT}' AS systime FROM live UNION ALL BY NAME SELECT * FROM cur WHERE id NOT IN (SELECT id FROM live)",
)
def sync_upsert(spark, sf):
    return _sync(spark, sf, False)


@query(
    "soft_delete_active",
    f"""WITH {SQL_REFERENCE} SELECT id, name, CASE WHEN name LIKE 'red%' THEN NULL WHEN brand = 'Brand#7' OR name LIKE 'red%' THEN coalesce(inactivated_date, TIMESTAMP '{_AT}') ELSE inactivated_date END AS inactivated_date,
        name LIKE 'red%' OR (brand <> 'Brand#7' AND inactivated_date IS NULL) AS is_active FROM cur""",
)
def soft_delete_active(spark, sf):
    current, _, at = _reference(spark, sf)
    removed = reference.deactivate(current, F.col("brand") == "Brand#7", at)
    restored = reference.reactivate(removed, F.col("name").startswith("red"))
    live = reference.active_only(restored).select("id").withColumn("is_active", F.lit(True))
    return restored.join(live, "id", "left").select("id", "name", "inactivated_date", F.coalesce("is_active", F.lit(False)).alias("is_active"))


@query("current_rows", f"WITH {SQL_REFERENCE} SELECT id, name, brand FROM cur WHERE inactivated_date IS NULL")
def current_rows(spark, sf):
    return reference.active_only(_reference(spark, sf)[0]).select("id", "name", "brand")
