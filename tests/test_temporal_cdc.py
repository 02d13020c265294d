"""Versions, bitemporal rows, change logs and reference merges."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from stratalake.functions.keys import surrogate_key
from stratalake.plans.changes import ingest_changes, read_log
from stratalake.operators import cdc, reference, temporal
from stratalake.operators.ordered import running_max
from stratalake.sources.sinks import Snapshots, insert_absent, read_months, write_append, write_by_month
from stratalake.session import fresh_path

DAY = dt.datetime(2024, 1, 1)
OPEN = dt.datetime(9999, 12, 31)


def at(day):
    return DAY + dt.timedelta(days=day)


def ts(day):
    return F.lit(str(at(day))).cast("timestamp")


def log(spark, rows):
    return spark.createDataFrame([(k, n, op, at(d), v) for n, (k, op, d, v) in enumerate(rows, 1)], "k string, lsn bigint, op string, at timestamp, v int")


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_history_from_log(spark):
    entries = log(spark, [("a", "I", 0, 1), ("a", "U", 1, 2), ("b", "I", 1, 9), ("a", "U", 3, 3), ("a", "D", 4, 3), ("a", "I", 6, 5)])
    hist = temporal.scd2_from_log(entries, "k", "lsn", "at", ["v"])
    assert rows(hist) == [
        ("a", 1, at(0), at(1)), ("a", 2, at(1), at(3)), ("a", 3, at(3), at(4)), ("a", 5, at(6), OPEN), ("b", 9, at(1), OPEN)
    ]
    assert rows(temporal.as_of(hist, ts(1)).select("k", "v")) == [("a", 2), ("b", 9)]
    assert rows(temporal.as_of(hist, ts(4)).select("k", "v")) == [("b", 9)]
    assert rows(temporal.current_state(hist).select("k", "v")) == [("a", 5), ("b", 9)]
    # A gap after a deletion is the only thing to report.
    assert rows(temporal.interval_violations(hist, "k")) == [("a", 0, 1, 0, 1)]


def test_excluded_columns_open_no_version(spark):
    entries = log(spark, [("a", "I", 0, 1), ("a", "U", 1, 1), ("a", "U", 2, 4), ("a", "D", 3, 4), ("a", "I", 5, 4)])
    entries = entries.withColumn("seen", F.col("lsn"))
    hist = temporal.scd2_from_log(entries, "k", "lsn", "at", ["v", "seen"], exclude=["seen"])
    assert rows(hist) == [("a", 1, 1, at(0), at(2)), ("a", 4, 3, at(2), at(3)), ("a", 4, 5, at(5), OPEN)]


def test_merge_closes_opens_and_is_idempotent(spark):
    hist = spark.createDataFrame(
        [("a", 1, "x", at(0), at(1)), ("a", 2, "x", at(1), OPEN), ("b", 3, None, at(0), OPEN), ("c", 4, "z", at(0), OPEN)],
        "k string, v int, note string, sys_start timestamp, sys_end timestamp",
    )
    source = spark.createDataFrame([("a", 5, "x"), ("b", 3, "new"), ("d", 7, None)], "k string, v int, note string")
    merged = temporal.scd2_merge(hist, source, "k", ["v", "note"], ts(9))
    assert rows(merged.fillna({"note": "-"})) == [
        ("a", 1, "x", at(0), at(1)), ("a", 2, "x", at(1), at(9)), ("a", 5, "x", at(9), OPEN),
        ("b", 3, "-", at(0), at(9)), ("b", 3, "new", at(9), OPEN), ("c", 4, "z", at(0), OPEN), ("d", 7, "-", at(9), OPEN),
    ]
    again = temporal.scd2_merge(merged, source, "k", ["v", "note"], ts(11))
    assert rows(again.fillna({"note": "-"})) == rows(merged.fillna({"note": "-"}))
    closed = temporal.scd2_merge(hist, source, "k", ["v", "note"], ts(9), close_missing=True, exclude=["note"])
    assert rows(closed.where("k in ('b', 'c')").fillna({"note": "-"})) == [("b", 3, "new", at(0), OPEN), ("c", 4, "z", at(0), at(9))]


def test_log_batches_build_the_same_history(spark):
    rng = random.Random(3)
    made = [(rng.choice("aaab"), rng.choice("IUUUD"), day // 2, rng.randint(0, 3)) for day in range(40)]
    entries = log(spark, made)
    whole = temporal.scd2_from_log(entries, "k", "lsn", "at", ["v"])
    hist = whole.limit(0)
    for low, high in ((0, 13), (13, 14), (14, 40)):
        batch = entries.where((F.col("lsn") > low) & (F.col("lsn") <= high))
        hist = temporal.apply_log(hist, batch, "k", "lsn", "at", ["v"])
    assert rows(hist) == rows(whole)


def test_bitemporal(spark):
    entries = spark.createDataFrame(
        [("a", 1, "I", at(0), at(0), 1), ("a", 2, "U", at(5), at(6), 2), ("a", 3, "U", at(4), at(7), 3), ("a", 4, "D", at(8), at(9), 3)],
        "k string, lsn int, op string, eff timestamp, now timestamp, v int",
    )
    got = rows(temporal.bitemporal_history(entries, "k", "lsn", "eff", "now", ["v"]))
    assert got == [
        ("a", 1, 1, at(0), at(5), at(0), at(6), 1, True),
        ("a", 2, 2, at(5), at(4), at(6), at(7), 0, False),  # out of order: kept and flagged
        ("a", 3, 3, at(4), at(9), at(7), at(9), None, True),
    ]


def test_system_start(spark):
    df = spark.sql("SELECT timestamp'2024-01-01 00:00:00' eff, timestamp'2024-01-01 00:00:00.009' near, timestamp'2024-01-01 00:00:00.010' far")
    near, far = df.select(temporal.systime_start(F.col("eff"), F.col("near")), temporal.systime_start(F.col("eff"), F.col("far"))).first()
    assert near == at(0) and far == at(0) + dt.timedelta(milliseconds=10)


def test_as_of_join_with_a_hot_key(spark):
    rng = random.Random(5)
    entries = log(spark, [(rng.choice("aaaab"), rng.choice("IUUD"), day, day) for day in range(60)])
    hist = temporal.scd2_from_log(entries, "k", "lsn", "at", ["v"])
    facts = spark.createDataFrame([(i, rng.choice(["a", "a", "b", "c"]), at(rng.randint(-3, 70))) for i in range(300)], "id int, k string, t timestamp")
    got = temporal.as_of_join(facts, hist, "k", "t", "id", ["v"])
    test = (facts.k == hist.k) & (hist.sys_start <= facts.t) & (facts.t < hist.sys_end)
    want = facts.join(hist, test, "left").select(facts.k, "id", "t", "v")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.select(got.columns).collect()))


def test_interval_findings(spark):
    hist = spark.createDataFrame(
        [("ok", at(0), at(1)), ("ok", at(1), OPEN), ("lap", at(0), at(3)), ("lap", at(2), OPEN), ("gap", at(0), at(1)), ("gap", at(2), OPEN),
         ("void", at(0), at(0)), ("void", at(0), OPEN), ("two", at(0), OPEN), ("two", at(1), OPEN)],
        "k string, sys_start timestamp, sys_end timestamp",
    )
    got = {r.k: tuple(r)[1:] for r in temporal.interval_violations(hist, "k").collect()}
    assert got == {"lap": (1, 0, 0, 1), "gap": (0, 1, 0, 1), "void": (0, 0, 1, 1), "two": (1, 0, 0, 2)}


def test_intervals_inside_a_longer_one(spark):
    spans = [(0, 330), (31, 60), (120, 150), (330, None)]
    rows = [("k", at(a), OPEN if z is None else at(z)) for a, z in spans] + [("l", at(340), OPEN)]
    hist = spark.createDataFrame(rows, "k string, sys_start timestamp, sys_end timestamp")
    assert [tuple(r) for r in temporal.interval_violations(hist, "k").collect()] == [("k", 2, 0, 0, 1)]


def test_running_max_over_chunks(spark):
    rng = random.Random(3)
    data = [(rng.choice(["a", "a", "a", "b", None]), i, rng.choice([None, *range(50)])) for i in range(200)]
    df = spark.createDataFrame(data, "k string, n int, v int")
    got = {r.n: r.top for r in running_max(df, ["k"], ["n"], "v", "top", chunks=7).collect()}
    want = {n: max((w for j, m, w in data if j == k and m < n and w is not None), default=None) for k, n, _ in data}
    assert got == want


def test_merge_at_the_start_of_a_version(spark):
    hist = spark.createDataFrame([("a", 1, at(5), OPEN), ("b", 1, at(5), OPEN), ("c", 1, at(5), OPEN)], "k string, v int, sys_start timestamp, sys_end timestamp")
    source = spark.createDataFrame([("a", 2), ("b", 1)], "k string, v int")
    merged = temporal.scd2_merge(hist, source, "k", ["v"], ts(5), close_missing=True)
    assert sorted(map(tuple, merged.collect())) == [("a", 2, at(5), OPEN), ("b", 1, at(5), OPEN)]
    with pytest.raises(Exception, match="began after the time of the merge"):
        temporal.scd2_merge(hist, source, "k", ["v"], ts(4)).collect()


def test_change_log(spark):
    df = spark.createDataFrame([(3, "c", None), (1, "a", 1.5), (2, "b", 2.5)], "id int, name string, v double")
    made = cdc.to_change_log(df, ["id"], F.lit("I"), ts(0), start_lsn=10)
    assert [(r.lsn, r.full_row) for r in made.orderBy("lsn").collect()] == [
        (11, '{"id":"1","name":"a","v":"1.5"}'), (12, '{"id":"2","name":"b","v":"2.5"}'), (13, '{"id":"3","name":"c"}')
    ]
    assert cdc.high_watermark(made).first()[0] == 13 and cdc.high_watermark(made.limit(0)).first()[0] == 0
    assert cdc.changes_after(made, 12).count() == 1
    assert cdc.validate(made, "t").first().passed and not cdc.validate(made.limit(0), "t").first().passed
    twice = made.unionByName(made.where("lsn = 11").withColumn("load_ts", ts(1)))
    assert not cdc.validate(twice, "t").first().passed
    assert cdc.dedupe(twice).where("lsn = 11").first().load_ts == at(1) and cdc.dedupe(twice).count() == 3


@pytest.mark.parametrize("text, good", [('{"a":1}', True), ("{}", True), ("[1]", False), ('"x"', False), ("{", False), (None, False), ("", False)])
def test_payload_must_be_an_object(spark, text, good):
    df = spark.createDataFrame([(text,)], "full_row string")
    assert df.select(cdc.is_object(F.col("full_row"))).first()[0] is good


def test_state_and_lag(spark):
    entries = log(spark, [("a", "I", 0, 1), ("b", "I", 1, 2), ("a", "U", 2, 3), ("b", "D", 3, 2)]).withColumnRenamed("at", "load_ts")
    assert rows(cdc.state_from_log(entries, "k", ["v"])) == [("a", 3, 3)]
    assert tuple(cdc.lag_report(entries, "t", ts(3) + F.expr("INTERVAL 10 MINUTES")).first()) == ("t", 10.0, 4, 4, False)
    assert tuple(cdc.lag_report(entries.limit(0), "t", ts(3)).first()) == ("t", 0.0, 0, 0, False)


def reference_frames(spark):
    current = spark.createDataFrame(
        [(1, "same", None, at(0)), (2, "old", None, at(0)), (3, "gone", None, at(0)), (4, "gone before", at(1), at(0)), (5, None, None, at(0))],
        "id int, name string, inactivated_date timestamp, systime timestamp",
    )
    new = spark.createDataFrame([(1, "same"), (2, "new"), (5, "value"), (6, "added")], "id int, name string")
    return current, new


def test_reference_merge(spark):
    current, new = reference_frames(spark)
    got = {r.id: tuple(r)[1:] for r in reference.merge_reference(current, new, "id", ["name"], ts(9)).collect()}
    assert got == {
        1: ("same", None, at(0)), 2: ("new", None, at(9)), 3: ("gone", at(9), at(0)), 4: ("gone before", at(1), at(0)),
        5: ("value", None, at(9)), 6: ("added", None, at(9)),
    }
    assert reference.merge_reference(current, new, "id", ["name"], ts(9), on_missing="delete").count() == 4
    kept = reference.merge_reference(current, new, "id", ["name"], ts(9), on_missing="keep")
    assert kept.where("id = 3").first().inactivated_date is None
    with pytest.raises(ValueError):
        reference.merge_reference(current, new, "id", ["name"], ts(9), on_missing="drop")


def test_reference_sync(spark):
    current, new = reference_frames(spark)
    incoming = new.withColumn("inactivated_date", F.when(F.col("id") == 2, ts(1)))
    strict = reference.sync_reference(current, incoming, "id", ts(9))
    assert sorted(r.id for r in strict.collect()) == [1, 5, 6]
    loose = {r.id: r for r in reference.sync_reference(current, incoming, "id", ts(9), strict=False).collect()}
    assert sorted(loose) == [1, 2, 3, 4, 5, 6] and loose[2].name == "old" and loose[1].systime == at(9)


def test_soft_delete(spark):
    current, _ = reference_frames(spark)
    gone = reference.deactivate(current, F.col("id") >= 3, ts(9))
    assert sorted(r.id for r in reference.active_only(gone).collect()) == [1, 2]
    assert gone.where("id = 4").first().inactivated_date == at(1)
    back = reference.reactivate(gone, F.col("id") == 3)
    assert sorted(r.id for r in reference.active_only(back).collect()) == [1, 2, 3]
    seeds = spark.createDataFrame([(1, "seed", None, at(5)), (8, "seed", None, at(5))], current.schema)
    assert insert_absent(current, seeds, "id").where("name = 'seed'").count() == 1


def test_sinks(spark):
    path = fresh_path(spark, "t")
    df = spark.range(10)
    for batch, part in (("1", df), ("2", df.where("id < 3")), ("2", df.where("id < 4"))):
        write_append(part, path, batch)
    assert spark.read.parquet(path).count() == 14
    months = fresh_path(spark, "t")
    dated = df.select("id", (ts(0) + F.make_dt_interval(F.col("id").cast("int") * 20)).alias("t"))
    write_by_month(dated, months, "t")
    part = read_months(spark, months, "2024-02", "2024-03")
    assert sorted(r.id for r in part.collect()) == [2, 3, 4]
    assert "PartitionFilters: [isnotnull(month" in part._jdf.queryExecution().toString()


def test_snapshots(spark):
    shots = Snapshots(spark, fresh_path(spark, "t"))
    assert shots.latest() == 0
    assert shots.write(spark.range(3)) == 1
    assert shots.write(shots.read().where("id > 0")) == 2
    assert shots.read().count() == 2 and shots.read(1).count() == 3
    # A version without its marker was cut off and does not count.
    spark.range(1).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{shots.path}/v=3")
    assert shots.latest() == 2


def test_ingest_numbers_go_on_and_repeat(spark):
    from stratalake.plans.changes import ingest_changes, last_number

    path = fresh_path(spark, "log")
    assert last_number(spark, path, "b9") == 0
    for batch, rows_ in (("b1", 3), ("b2", 4), ("b1", 3), ("b2", 4)):
        df = spark.range(rows_).select("id")
        assert ingest_changes(df, path, batch, ["id"], F.lit("I"), ts(0)) == rows_
    got = spark.read.parquet(path)
    assert sorted(r.lsn for r in got.collect()) == list(range(1, 8))
    assert sorted(r.lsn for r in got.where("batch_id = 'b1'").collect()) == [1, 2, 3]
    assert ingest_changes(spark.range(0).select("id"), path, "b3", ["id"], F.lit("I"), ts(0)) == 0
    assert last_number(spark, path, "b9") == 7


def test_reference_insert_takes_the_whole_record(spark):
    current = spark.createDataFrame([(1, "x", "d1", None, at(0))], "id int, name string, note string, inactivated_date timestamp, systime timestamp")
    new = spark.createDataFrame([(1, "x", "d9"), (2, "y", "d2")], "id int, name string, note string")
    got = {r.id: (r.name, r.note) for r in reference.merge_reference(current, new, "id", ["name"], ts(9)).collect()}
    assert got == {1: ("x", "d1"), 2: ("y", "d2")}


def test_numbers_go_on_after_numeric_batch_ids(spark, tmp_path):
    path = str(tmp_path / "log")
    changed = spark.createDataFrame([(1, at(0)), (2, at(1))], "k int, t timestamp")
    for n in (1, 2, 2, 3):
        ingest_changes(changed, path, f"{n:012d}", ["t", "k"], F.lit("I"), F.col("t"))
    assert sorted(r.lsn for r in read_log(spark, path).collect()) == [1, 2, 3, 4, 5, 6]


def test_surrogate_keys_are_apart(spark):
    values = [("a|b", "c"), ("a", "b|c"), (None, "c"), ("-", "c"), ("1:a", "c")]
    df = spark.createDataFrame(values, "x string, y string").select(surrogate_key("e", "x", "y").alias("k"))
    assert df.distinct().count() == len(values)


def test_payloads_are_parsed_once_and_faulty_ones_told(spark):
    rows = [(1, "I", '{"a": 1, "b": {"c": "x"}}'), (2, "U", "[1]"), (3, "U", "{broken"), (4, "D", None), (5, "I", '{"a": "no number"}'), (6, "I", "{}")]
    good, bad = cdc.parsed(spark.createDataFrame(rows, "lsn long, op string, full_row string"))
    assert dict(good.dtypes)["row"] == "variant"
    got = good.select("lsn", cdc.value("a", "int").alias("a"), cdc.value("b.c").alias("c")).collect()
    assert {tuple(r) for r in got} == {(1, 1, "x"), (5, None, None), (6, None, None)}
    assert {(r.lsn, r.fault) for r in bad.collect()} == {(2, "no object"), (3, "no object"), (4, "no payload")}
    assert cdc.payload_schema(good.where("lsn = 1")).first()[0] == "OBJECT<a: BIGINT, b: OBJECT<c: STRING>>"
