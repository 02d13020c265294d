"""Per-key state on streams, in event-time order: baselines, silent slots, repeated alerts.

Rows come in any order inside and across micro-batches. Each processor puts them into map state
under their time and sets a timer; the timers of a key fire in order once the watermark has
passed them, and only then is a row judged. So nothing is sorted in memory, results are those of
the batch twins whatever the batches were, and rows behind the watermark count for nothing.

State lives in RocksDB (see ``session.configure``). Timers count milliseconds; instants are kept
in microseconds, those of one millisecond together.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle


_READING = Row(
    "metric_name", "store_id", "_at", "metric_value", "baseline_value", "deviation_percent", "change_percent", "is_anomaly"
)
_SILENT = Row("rule_id", "store_id", "metric_name", "_at")
_PASSED = Row("rule_id", "store_id", "_at")


def _micros(at: dt.datetime | str | Column) -> Column:
    return F.unix_micros((at if isinstance(at, Column) else F.lit(at)).cast("timestamp"))


def _due(micros: int) -> int:
    """The millisecond whose timer judges an instant."""
    return -(-micros // 1000)


class _Baseline(StatefulProcessor):
    """``held`` are the last readings, ``waiting`` those the watermark has not passed."""

    def __init__(self, history: int, anomaly_percent: float, value_type: str):
        self.history, self.limit, self.value_type = history, anomaly_percent, value_type

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getListState("held", f"v {self.value_type}")
        self.waiting = handle.getMapState("waiting", "due bigint", f"r array<struct<at: bigint, v: {self.value_type}>>")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        for row in rows:
            due = _due(row["_at"])
            before = list(self.waiting.getValue((due,))[0]) if self.waiting.containsKey((due,)) else []
            self.waiting.updateValue((due,), ([*before, (row["_at"], row["metric_value"])],))
            self.handle.registerTimer(due)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        due = expiredTimerInfo.getExpiryTimeInMs()
        if not self.waiting.containsKey((due,)):
            return
        readings = sorted(self.waiting.getValue((due,))[0], key=lambda r: r[0])
        self.waiting.removeKey((due,))
        held = [r[0] for r in self.held.get()]
        for at, value in readings:
            known = [float(v) for v in (value, held[-1] if held else None) if v is not None]
            counted = [v for v in held if v is not None]
            base = float(sum(counted)) / len(counted) if counted else None
            previous = known[1] if len(known) == 2 else None
            now = None if value is None else float(value)
            moved = [None if not x or now is None else (now - x) / x * 100 for x in (base, previous)]
            flag = moved[0] is not None and abs(moved[0]) > self.limit
            yield _READING(*key, at, value, base, *moved, flag)
            held = [*held, value][-self.history :]
        self.held.put([(v,) for v in held])

    def close(self) -> None:
        pass


def running_baseline(series: DataFrame, history: int = 24, anomaly_percent: float = 100.0) -> DataFrame:
    """Trailing mean of the last ``history`` readings, deviation, change and anomaly flag per series.

    Readings carry ``metric_name``, ``store_id``, ``captured_at`` and ``metric_value``, one per
    slot, on a stream with a watermark. The result fits ``alerts.evaluate``, which then raises
    alerts on the stream.
    """
    kinds = dict(series.dtypes)
    schema = (
        f"metric_name {kinds['metric_name']}, store_id {kinds['store_id']}, _at bigint, metric_value {kinds['metric_value']}, "
        "baseline_value double, deviation_percent double, change_percent double, is_anomaly boolean"
    )
    rows = series.select("metric_name", "store_id", "metric_value", "captured_at", _micros(F.col("captured_at")).alias("_at"))
    flagged = rows.groupBy("metric_name", "store_id").transformWithState(
        _Baseline(history, anomaly_percent, kinds["metric_value"]), schema, "Append", "EventTime"
    )
    at = F.timestamp_micros("_at").cast(kinds["captured_at"]).alias("captured_at")
    return flagged.select("metric_name", "store_id", at, *flagged.columns[3:])


class _Silence(StatefulProcessor):
    """``open`` is the next slot to judge, ``seen`` the slots from there on that reported."""

    def __init__(self, step: int):
        self.step = step  # microseconds

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", "at bigint")
        self.seen = handle.getMapState("seen", "at bigint", "yes boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        for row in rows:
            if not self.open.exists():
                # A series is expected from the first slot of the period, before it was ever heard of.
                self.open.update((row["_first"],))
                self.handle.registerTimer(_due(row["_first"] + self.step))
            if row["_at"] >= self.open.get()[0]:
                self.seen.updateValue((row["_at"],), (True,))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        # One timer per series: every slot that has ended is judged, then the next one is waited for.
        ended = timerValues.getCurrentWatermarkInMs() * 1000
        (slot,) = self.open.get()
        while slot + self.step <= ended:
            if self.seen.containsKey((slot,)):
                self.seen.removeKey((slot,))
            else:
                yield _SILENT(*key, slot)
            slot += self.step
        self.open.update((slot,))
        self.handle.registerTimer(_due(slot + self.step))

    def close(self) -> None:
        pass


def missing_data(series: DataFrame, rules: DataFrame, first: Column, step_minutes: int) -> DataFrame:
    """Slots in which a metric under a ``missing_data`` rule reported nothing, as soon as they have ended.

    ``series`` is a stream of readings with a watermark and at most one reading per slot of
    ``step_minutes``; slots count from ``first`` on. A series is known from its first reading on
    and is then judged back to ``first``. State is one instant per series and its open slots.
    """
    wanted = rules.where("is_active").where("condition_type = 'missing_data'")
    wanted = wanted.select("rule_id", F.col("target_metric").alias("metric_name"), "store_filter")
    kinds = dict(series.dtypes)
    rows = series.join(wanted, "metric_name").where("store_filter IS NULL OR store_filter = store_id")
    rows = rows.select("rule_id", "store_id", "metric_name", "captured_at", _micros(F.col("captured_at")).alias("_at"), _micros(first).alias("_first"))
    schema = f"rule_id {dict(rules.dtypes)['rule_id']}, store_id {kinds['store_id']}, metric_name string, _at bigint"
    silent = rows.groupBy("rule_id", "store_id", "metric_name").transformWithState(
        _Silence(step_minutes * 60_000_000), schema, "Append", "EventTime"
    )
    at = F.timestamp_micros("_at").cast(kinds["captured_at"]).alias("alert_timestamp")
    return silent.select("rule_id", "store_id", at, "metric_name")


# Alerts that wait are kept together by spans of this many milliseconds, and rows of one batch go
# there this many at a time: state is not asked and told for every row.
_SPAN, _HELD = 600_000, 50_000


class _Quiet(StatefulProcessor):
    """``last`` is the last alert passed, ``waiting`` the alerts the watermark has not passed."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "at bigint, quiet bigint")
        self.waiting = handle.getMapState("waiting", "span bigint", "r array<struct<at: bigint, quiet: bigint>>")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        raised: dict[int, dict[int, int]] = {}
        held = 0
        for row in rows:
            at, quiet = row["_at"], row["_quiet"]
            if quiet <= 0:
                yield _PASSED(*key, at)  # nothing can suppress it
            elif at is not None:
                raised.setdefault(_due(at) // _SPAN, {}).setdefault(at, quiet)
                held += 1
                if held == _HELD:
                    self._keep(raised)
                    raised, held = {}, 0
        self._keep(raised)

    def _keep(self, raised: dict[int, dict[int, int]]) -> None:
        for span, found in raised.items():
            first = _due(min(found))
            before = self._waiting(span)
            # The first alert of a span has a timer; it also judges the later ones.
            if not before or first < _due(min(before)):
                self.handle.registerTimer(first)
            if not found.keys() <= before.keys():
                self.waiting.updateValue((span,), (list((found | before).items()),))

    def _waiting(self, span: int) -> dict[int, int]:
        if not self.waiting.containsKey((span,)):
            return {}
        return {r[0]: r[1] for r in self.waiting.getValue((span,))[0]}

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        due = expiredTimerInfo.getExpiryTimeInMs()
        ended = max(due, timerValues.getCurrentWatermarkInMs())
        span = due // _SPAN
        raised = self._waiting(span)
        before = last = tuple(self.last.get()) if self.last.exists() else None
        later = {}
        for at, quiet in sorted(raised.items()):
            if _due(at) > ended:
                later[at] = quiet
            elif last is None or at - last[0] >= quiet:
                last = (at, quiet)
                yield _PASSED(*key, at)
        if later:
            if len(later) < len(raised):
                self.waiting.updateValue((span,), (list(later.items()),))
            self.handle.registerTimer(_due(min(later)))
        elif raised:
            self.waiting.removeKey((span,))
        if last != before:
            self.last.update(last)
            # Nothing needs the last alert any longer once its wait is over.
            self.handle.registerTimer(_due(last[0] + last[1]) + 1)
        elif last is not None and _due(last[0] + last[1]) < due:
            self.last.clear()

    def close(self) -> None:
        pass


def suppress_repeats(alerts: DataFrame, quiet: int | DataFrame) -> DataFrame:
    """Pass an alert of a rule and store only when the last one passed is old enough.

    Alerts carry ``rule_id``, ``store_id`` and ``alert_timestamp``, on a stream with a watermark.
    ``quiet`` is the wait of all rules in minutes, or a static table of ``rule_id,
    suppress_duplicate_minutes``; as in batch, alerts of other rules go. Waits are kept by true
    instants. A wait of 0 or NULL passes every alert at once, others when the watermark has passed
    them. State is the last alert passed, until its wait is over, and the alerts not yet judged.
    """
    raised = alerts.select("rule_id", "store_id", "alert_timestamp", _micros(F.col("alert_timestamp")).alias("_at"))
    if isinstance(quiet, DataFrame):
        wait = F.coalesce(F.col("suppress_duplicate_minutes").cast("bigint") * F.lit(60_000_000), F.lit(0))
        raised = raised.join(quiet.select("rule_id", wait.alias("_quiet")), "rule_id")
    else:
        raised = raised.withColumn("_quiet", F.lit(quiet * 60_000_000).cast("bigint"))
    kinds = dict(alerts.dtypes)
    schema = f"rule_id {kinds['rule_id']}, store_id {kinds['store_id']}, _at bigint"
    passed = raised.groupBy("rule_id", "store_id").transformWithState(_Quiet(), schema, "Append", "EventTime")
    return passed.select("rule_id", "store_id", F.timestamp_micros("_at").cast(kinds["alert_timestamp"]).alias("alert_timestamp"))
