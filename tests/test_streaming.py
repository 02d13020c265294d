"""Streams over files that arrive one by one, against their batch twins."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from stratalake.operators import alerts, kpi, temporal
from stratalake.session import fresh_path
from stratalake.plans import versions
from stratalake.sources.keyed import KeyedTable
from stratalake.streaming import changes, events, kpis, late, stateful

START = dt.datetime(2024, 1, 1)


def at(minute):
    return START + dt.timedelta(minutes=minute)


def arriving(spark, rows, schema, files):
    """Write ``rows`` as ``files`` consecutive files and read them one per trigger."""
    folder = fresh_path(spark, "arrive")
    size = -(-len(rows) // files)
    for n in range(files):
        part = rows[n * size : (n + 1) * size]
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(folder)
    return events.read_files(spark, folder, spark.createDataFrame([], schema).schema, "*.parquet", per_batch=1)


def finish(spark, stream, mode="append"):
    name = "out_" + fresh_path(spark, "x")[-12:]
    query = stream.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True)
    query.option("checkpointLocation", fresh_path(spark, "c")).start().awaitTermination()
    return spark.table(name)


def closed(spark, rows, schema, time_column, files):
    """``rows`` in consecutive files, then a heartbeat (of store -1); a stream with a watermark."""
    frame = spark.createDataFrame(rows, schema)
    size = -(-len(rows) // files)
    folder = fresh_path(spark, "replay")
    for n in range(files):
        spark.createDataFrame(rows[n * size : (n + 1) * size], schema).coalesce(1).write.mode("append").parquet(folder)
    beat = {"store_id": F.lit(-1), time_column: F.lit(at(10**5))}
    frame.limit(1).withColumns(beat).coalesce(1).write.mode("append").parquet(folder)
    stream = events.read_files(spark, folder, frame.schema, "*.parquet", per_batch=1).withWatermark(time_column, "1 hour")
    return events.behind_watermark(stream, time_column, F.col("store_id") >= 0)


EVENT = "event_id bigint, ts timestamp, store_id int, customer_id int, event_type string, amount decimal(18,2), severity string, utilization int"


def made_events(n, step=1.0):
    rng = random.Random(n)
    kinds = ["rental_start", "payment_processed", "error", "customer_signup"]
    return [(i, at(i * step), rng.randint(1, 2), rng.randint(1, 5), rng.choice(kinds), Decimal(rng.randint(1, 99)), "info", 5) for i in range(n)]


def test_kpis_match_the_batch_twin_on_closed_windows(spark):
    rows = made_events(60, step=0.5)
    stream = arriving(spark, rows + [(999, at(500), 9, 9, "error", rows[0][5], "info", 1)], EVENT, 4)
    got = finish(spark, kpis.minute_kpis(stream, "5 minutes", "2 minutes"))
    want = kpi.minute_kpis(spark.createDataFrame(rows, EVENT), "5 minutes")
    columns = ["kpi_timestamp", "store_id", "rentals_per_minute", "payments_per_minute", "revenue_per_minute", "error_rate_percent", "event_count", "active_customers_count"]
    assert sorted(got.select(columns).collect()) == sorted(want.select(columns).collect())


@pytest.mark.parametrize("n", [60, 4])
def test_kpis_with_open_slots_are_whole(spark, n):
    rows = made_events(n, step=0.5)
    got = kpis.with_open_slots(
        finish(spark, kpis.minute_kpis(arriving(spark, rows, EVENT, 2), "5 minutes", "2 minutes")), spark.createDataFrame(rows, EVENT), "5 minutes"
    )
    want = kpi.minute_kpis(spark.createDataFrame(rows, EVENT), "5 minutes")
    columns = ["kpi_timestamp", "store_id", "rentals_per_minute", "payments_per_minute", "revenue_per_minute", "error_rate_percent", "event_count", "active_customers_count"]
    assert sorted(got.select(columns).collect()) == sorted(want.select(columns).collect())


def test_sliding_matches_the_batch_twin(spark):
    rows = made_events(20)
    stream = arriving(spark, rows + [(999, at(500), 9, 9, "error", rows[0][5], "info", 1)], EVENT, 2)
    got = finish(spark, kpis.sliding_activity(stream))
    want = kpi.sliding_activity(spark.createDataFrame(rows, EVENT))
    assert sorted(got.collect()) == sorted(want.select(got.columns).collect())


def test_late_events_are_dropped_and_repeats_removed(spark):
    rows = made_events(30)
    late = [(1000, at(1), 1, 1, "error", rows[0][5], "info", 1)]
    stream = arriving(spark, rows[:20] + rows[10:20] + rows[20:] + late, EVENT, 4)
    got = finish(spark, events.drop_repeats(stream, ["event_id"], "ts", "5 minutes"))
    assert sorted(r.event_id for r in got.collect()) == list(range(30))


def test_enrichment_keeps_unknown_stores(spark):
    stream = arriving(spark, made_events(10), EVENT, 2)
    names = spark.createDataFrame([(1, "one")], "store_id int, name string")
    got = finish(spark, events.enrich(stream, names, "store_id"))
    assert got.count() == 10 and {r.name for r in got.collect()} == {"one", None}


@pytest.mark.parametrize("files", [1, 5])
def test_suppression_matches_the_batch_twin(spark, files):
    rng = random.Random(8)
    rows = sorted({(rng.randint(1, 2), 1, at(rng.randint(0, 200))) for _ in range(120)}, key=lambda r: r[2])
    schema = "rule_id int, store_id int, alert_timestamp timestamp"
    rng.shuffle(rows[:60])
    got = finish(spark, stateful.suppress_repeats(closed(spark, rows, schema, "alert_timestamp", files), 10))
    config = spark.createDataFrame([(1, 10), (2, 10)], "rule_id int, suppress_duplicate_minutes int")
    want = alerts.suppress(spark.createDataFrame(rows, schema), config)
    assert sorted(got.collect()) == sorted(want.collect())


@pytest.mark.parametrize("files", [1, 3])
def test_suppression_by_true_instants_and_waits_of_rules(spark, files):
    schema = "rule_id int, store_id int, alert_timestamp timestamp"
    rows = [(rule, 1, at(0) + dt.timedelta(seconds=s)) for s in (0, 0, 20, 59, 60, 619, 620, 21610) for rule in (1, 2, 3, 9)]
    rows += [(4, 1, at(600) + dt.timedelta(seconds=59)), (4, 1, at(960) + dt.timedelta(seconds=10)), (4, 1, at(960) + dt.timedelta(seconds=59))]
    config = spark.createDataFrame([(1, 0), (2, 10), (3, None), (4, 360)], "rule_id int, suppress_duplicate_minutes int")
    got = finish(spark, stateful.suppress_repeats(closed(spark, rows, schema, "alert_timestamp", files), config))
    want = alerts.suppress(spark.createDataFrame(rows, schema), config)
    assert sorted(got.collect()) == sorted(want.collect())
    assert [r.alert_timestamp.second for r in got.where("rule_id = 4").orderBy("alert_timestamp").collect()] == [59, 59]
    assert got.where("rule_id = 1").count() == 8


@pytest.mark.parametrize("files", [1, 4])
def test_baseline_matches_the_batch_twin(spark, files):
    rng = random.Random(9)
    rows = [("m", rng.randint(1, 2), at(i), float(rng.randint(0, 50))) for i in range(40)]
    schema = "metric_name string, store_id int, captured_at timestamp, metric_value double"
    got = finish(spark, stateful.running_baseline(closed(spark, rows, schema, "captured_at", files), history=3))
    want = kpi.with_baseline(spark.createDataFrame(rows, schema).withColumn("metric_value", F.col("metric_value").cast("decimal(18,4)")), history=3)

    def plain(df):
        def number(v):
            return None if v is None or v != v else round(v, 9)

        return sorted((r.store_id, r.captured_at, str(number(r.baseline_value)), str(number(r.deviation_percent)), r.is_anomaly) for r in df.collect())

    assert plain(got) == plain(want)


def test_alerts_on_a_stream_match_the_batch_twin(spark):
    rng = random.Random(11)
    rows = [("m", rng.randint(1, 2), at(60 * i), float(rng.randint(0, 50))) for i in range(60)]
    schema = "metric_name string, store_id int, captured_at timestamp, metric_value double"
    fields = "rule_id int, target_metric string, condition_type string, threshold_value decimal(18,4), default_severity string, store_filter int, time_of_day_filter string, day_of_week_filter string, is_active boolean, is_test_mode boolean"
    kinds = [("greater_than", 30, None), ("percentage_change", 80, "business_hours"), ("anomaly_detected", None, None), ("less_than", 5, "after_hours")]
    rules = spark.createDataFrame(
        [(n, "m", kind, None if limit is None else Decimal(limit), "info", None, hours, None, True, False) for n, (kind, limit, hours) in enumerate(kinds)], fields
    )
    stream = stateful.running_baseline(closed(spark, rows, schema, "captured_at", 3), history=4)
    got = finish(spark, alerts.evaluate(stream, rules)).select("rule_id", "store_id", "alert_timestamp")
    series = spark.createDataFrame(rows, schema).withColumn("metric_value", F.col("metric_value").cast("decimal(18,4)"))
    want = alerts.evaluate(kpi.with_baseline(series, history=4), rules).select(got.columns)
    assert sorted(got.collect()) == sorted(want.collect()) and {r.rule_id for r in got.collect()} == {0, 1, 2, 3}


def test_out_of_order_readings_are_judged_in_order(spark):
    schema = "metric_name string, store_id int, captured_at timestamp, metric_value decimal(18,4)"
    rows = [("m", 1, at(5 * i), Decimal((i * 7) % 23)) for i in range(30)]
    mixed = [rows[i ^ 3] for i in range(28)] + rows[28:]
    got = finish(spark, stateful.running_baseline(closed(spark, mixed, schema, "captured_at", 6), history=5))
    want = kpi.with_baseline(spark.createDataFrame(rows, schema), history=5)
    assert sorted(got.collect()) == sorted(want.select(got.columns).collect())


@pytest.mark.parametrize("files", [1, 4])
def test_missing_data_matches_the_batch_twin(spark, files):
    rng = random.Random(12)
    schema = "metric_name string, store_id int, captured_at timestamp, metric_value double"
    rows = sorted({(m, s, at(60 * rng.randint(0, 40)), 1.0) for m in ("a", "b", "c") for s in (1, 2, 3) for _ in range(12)}, key=lambda r: r[2])
    fields = "rule_id int, target_metric string, condition_type string, store_filter int, is_active boolean"
    rules = spark.createDataFrame([(1, "a", "missing_data", None, True), (2, "b", "missing_data", 2, True), (3, "c", "missing_data", None, False), (4, "c", "equals", None, True)], fields)
    first, last = rows[0][2], rows[-1][2]
    got = finish(spark, stateful.missing_data(closed(spark, rows, schema, "captured_at", files), rules, F.lit(first), 60))
    got = got.where(F.col("alert_timestamp") <= F.lit(last))
    want = alerts.missing_data(spark.createDataFrame(rows, schema), rules, F.lit(first), F.lit(last), "1 HOUR")
    assert sorted(got.collect()) == sorted(want.select(got.columns).collect()) and got.count() > 20


LOG = "lsn bigint, user_id int, op string, load_ts timestamp, v int"


def made_log(n):
    rng = random.Random(n)
    return [(i, rng.choice([1, 1, 1, 2, 3]), rng.choice("IUUD"), at(i // 2), rng.randint(0, 9)) for i in range(n)]


@pytest.mark.parametrize("files", [1, 3])
def test_history_matches_the_batch_twin(spark, files):
    rows = made_log(45)
    table = KeyedTable(spark, fresh_path(spark, "v"), ["user_id"], buckets=4)
    stream = arriving(spark, rows, LOG, files)
    changes.maintain_history(stream, table, "user_id", "lsn", "load_ts", ["v"], fresh_path(spark, "c")).awaitTermination()
    want = temporal.scd2_from_log(spark.createDataFrame(rows, LOG), "user_id", "lsn", "load_ts", ["v"])
    assert table.latest() == files
    got = versions.history(table).select(want.columns)
    assert sorted(got.collect()) == sorted(want.collect())


def test_late_log_entries_stop_the_stream(spark):
    rows = [(10, 1, "I", at(1), 1), (20, 2, "I", at(2), 1), (30, 1, "D", at(3), 1), (15, 1, "U", at(1), 5)]
    table = KeyedTable(spark, fresh_path(spark, "v"), ["user_id"], buckets=4)
    query = changes.maintain_history(arriving(spark, rows, LOG, 4), table, "user_id", "lsn", "load_ts", ["v"], fresh_path(spark, "c"))
    with pytest.raises(Exception, match="not newer than the history"):
        query.awaitTermination()
    assert table.latest() == 3 and versions.history(table).count() == 2  # user 1 is closed, user 2 open


def test_open_slots_are_kept_up_to_date(spark):
    rows = made_events(80, step=0.5)
    table = KeyedTable(spark, fresh_path(spark, "k"), ["kpi_timestamp", "store_id"], buckets=4)
    slots = kpis.minute_kpis(arriving(spark, rows, EVENT, 4), "5 minutes", "2 minutes", exact_customers=True)
    changes.upsert_rows(slots, table, fresh_path(spark, "c")).awaitTermination()
    want = kpi.minute_kpis(spark.createDataFrame(rows, EVENT), "5 minutes")
    assert sorted(table.current().select(want.columns).collect()) == sorted(want.collect())


def test_sessions_match_the_batch_twin_over_midnight(spark):
    rng = random.Random(5)
    rows = [(i, at(m), 1, c, "payment_processed", Decimal(3), "info", 1) for i, (c, m) in enumerate((rng.randint(1, 3), rng.randint(0, 2000)) for _ in range(90))]
    rows += [(1000 + i, at(1400 + 20 * i), 1, 9, "rental_start", Decimal(1), "info", 1) for i in range(5)]  # from 23:20 to 00:40
    rows += [(2000, at(100), 1, 8, "error", None, "info", 1), (2001, at(130), 1, 8, "error", None, "info", 1)]  # exactly the gap
    rows.sort(key=lambda r: r[1])
    want = kpi.session_activity(spark.createDataFrame(rows, EVENT))
    beat = (9999, at(10**4), 1, 1, "heartbeat", None, "info", 1)
    got = finish(spark, kpis.session_activity(arriving(spark, [*rows, beat], EVENT, 4)))
    assert sorted(got.collect()) == sorted(want.select(got.columns).collect())
    (night,) = want.where("customer_id = 9").collect()
    assert (night.events, night.rentals, night.duration_minutes) == (5, 5, 80.0) and night.session_start.day != night.session_end.day
    # Islands by hand.
    for customer in (1, 2, 3, 8):
        times = sorted(r[1] for r in rows if r[3] == customer)
        islands = 1 + sum(b - a > dt.timedelta(minutes=30) for a, b in zip(times, times[1:]))
        assert want.where(F.col("customer_id") == customer).count() == islands


def test_late_events_are_put_aside_and_their_slots_mended(spark):
    rows = made_events(120)
    late_rows, on_time = [r for r in rows if r[0] % 9 == 0], [r for r in rows if r[0] % 9]
    beat = (9999, at(1000), 1, 1, "heartbeat", None, "info", 1)
    landed = [*on_time, beat, *late_rows]
    folder = fresh_path(spark, "landed")
    for part in (on_time[:50], on_time[50:], [beat], late_rows[:7], late_rows[7:]):
        spark.createDataFrame(part, EVENT).coalesce(1).write.mode("append").parquet(folder)

    def stream():
        return events.read_files(spark, folder, spark.createDataFrame([], EVENT).schema, "*.parquet", per_batch=1)

    name = "late_" + fresh_path(spark, "x")[-12:]
    slots = kpis.minute_kpis(late.observed(stream()), "5 minutes", "2 minutes", exact_customers=True)
    query = slots.writeStream.format("memory").queryName(name).option("checkpointLocation", fresh_path(spark, "c")).trigger(availableNow=True).start()
    query.awaitTermination()
    report = late.run_report(query)
    assert sum(r[1] for r in report) == len(landed) and sum(r[2] for r in report) == len(rows)
    assert sum(r[3] for r in report) > 0 and spark.createDataFrame(report, late.REPORT).count() == len(report) >= 5
    closed_slots = spark.table(name)
    whole = spark.createDataFrame(rows, EVENT)
    want = kpi.minute_kpis(whole, "5 minutes")
    assert closed_slots.agg(F.sum("event_count")).first()[0] == len(on_time)
    table = KeyedTable(spark, fresh_path(spark, "k"), ["kpi_timestamp", "store_id"], buckets=4)
    table.upsert(closed_slots)
    aside = fresh_path(spark, "aside")
    late.put_aside(stream(), aside, fresh_path(spark, "c"), "5 minutes", "2 minutes").awaitTermination()
    assert spark.read.parquet(f"{aside}/late").select("event_id").distinct().count() >= len(late_rows)
    late.repair(spark, aside, whole, table, "5 minutes")
    assert sorted(table.current().select(want.columns).collect()) == sorted(want.collect())


def test_appended_batches_survive_a_second_run(spark):
    path, checkpoint = fresh_path(spark, "log"), fresh_path(spark, "c")
    stream = arriving(spark, made_log(20), LOG, 2)
    for _ in range(2):
        changes.append_changes(stream, path, checkpoint).awaitTermination()
    got = spark.read.parquet(path)
    assert got.count() == 20 and got.select("batch_id").distinct().count() == 2


class _State:
    """Value and map state and timers of one key, with a count of what was asked and told."""

    def __init__(self):
        self.kept, self.timers, self.calls = {}, set(), 0

    def getValueState(self, name, schema):
        return _Slot(self, lambda *key: name)

    def getMapState(self, name, key, value):
        return _Slot(self, lambda *key: (name, *key))

    def registerTimer(self, due):
        self.calls += 1
        self.timers.add(due)


class _Slot:
    def __init__(self, state, name):
        self.state, self.name = state, name

    def _told(self, key):
        self.state.calls += 1
        return self.name(*key)

    def exists(self):
        return self._told(()) in self.state.kept

    def get(self):
        return self.state.kept[self._told(())]

    def update(self, value):
        self.state.kept[self._told(())] = value

    def clear(self):
        del self.state.kept[self._told(())]

    def containsKey(self, key):
        return self._told(key) in self.state.kept

    def getValue(self, key):
        return self.state.kept[self._told(key)]

    def updateValue(self, key, value):
        self.state.kept[self._told(key)] = value

    def removeKey(self, key):
        del self.state.kept[self._told(key)]


class _Now:
    def __init__(self, due=None, watermark=None):
        self.getExpiryTimeInMs = lambda: due
        self.getCurrentWatermarkInMs = lambda: watermark


def _passed(batches, quiet):
    """What passes of batches of instants, each with the watermark behind it, and the state at the end."""
    state = _State()
    judge = stateful._Quiet()
    judge.init(state)
    passed = []
    for instants, watermark in batches:
        rows = [{"_at": at, "_quiet": quiet} for at in instants]
        passed += [r[2] for r in judge.handleInputRows((1, 1), iter(rows), _Now())]
        for due in sorted(t for t in state.timers if t <= watermark):
            state.timers.remove(due)
            passed += [r[2] for r in judge.handleExpiredTimer((1, 1), _Now(watermark=watermark), _Now(due))]
    return passed, state


def test_waiting_alerts_do_not_ask_state_for_every_row():
    rows = [n * 1000 for n in range(3000)] * 5  # three seconds, five times over
    passed, state = _passed([(rows, 10_000), ([], 10**9)], 2_000_000)
    assert passed == [0, 2_000_000] and state.calls < 100 and not state.kept


def test_alerts_pass_as_in_a_walk_whatever_the_batches():
    draw = random.Random(3)
    for quiet in (1, 999, 60_000_000, 400_000_000):
        instants = sorted(draw.randrange(5_000_000_000) for _ in range(400))
        walk = []
        for at in instants:
            if not walk or at - walk[-1] >= quiet:
                walk.append(at)
        batches, mark, rest = [], 0, instants
        while rest:
            # Any rows that are not late, in any order; the watermark stops short of what has not come.
            now = [a for a in rest if a < mark * 1000 + 900_000_000 and draw.random() < 0.7]
            rest = [a for a in rest if a not in now]
            mark = max(mark, (min(rest) - 1) // 1000 if rest else 10**10)
            draw.shuffle(now)
            batches.append((now + now[:5], mark))
        passed, state = _passed([*batches, ([], 10**10)], quiet)
        assert passed == walk and not [k for k in state.kept if k != "last"]
