"""The keyed table: what is rewritten, what stays, versions, repeated writes; histories kept in it."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from stratalake.operators import temporal
from stratalake.plans import versions
from stratalake.session import fresh_path
from stratalake.sources.keyed import SETTLED, KeyedTable

START = dt.datetime(2024, 1, 1)
LOG = "lsn bigint, k int, op string, at timestamp, v int"


def when(n):
    return START + dt.timedelta(hours=n)


def ts(n):
    return F.lit(when(n)).cast("timestamp")


def files(table, version=None):
    """Every file of a version with the time of its last change."""
    found = {}
    for folder in table.folders(version):
        place = folder.removeprefix("file:")
        for name in os.listdir(place):
            if name.endswith(".parquet"):
                found[f"{place}/{name}"] = os.stat(f"{place}/{name}").st_mtime_ns
    return found


def keyed(spark, **options):
    return KeyedTable(spark, fresh_path(spark, "keyed"), ["k"], buckets=8, **options)


def test_upserts_replace_rows_and_leave_other_buckets_alone(spark):
    table = keyed(spark)
    assert table.latest() == 0 and table.current() is None and table.settled() is None
    table.upsert(spark.createDataFrame([(i, 0) for i in range(50)], "k int, v int"))
    before = files(table)
    changed = spark.createDataFrame([(7, 1), (99, 1)], "k int, v int")
    touched = table.touched(changed)
    assert table.upsert(changed) == 2 and 1 <= len(touched) <= 2
    assert sorted(map(tuple, table.current().collect())) == sorted([(i, int(i == 7)) for i in range(50)] + [(99, 1)])
    assert sorted(map(tuple, table.current(1).collect())) == [(i, 0) for i in range(50)]
    after = files(table)
    kept = {f: part for f, part in table.folders().items() if part not in touched}
    assert kept and all(table.folders(1).get(f) == part for f, part in kept.items())
    assert all(after[f] == t for f, t in before.items() if f in after)  # listed again, not written again


def test_a_repeated_write_gives_the_same_version(spark):
    table = keyed(spark)
    table.upsert(spark.createDataFrame([(1, 0), (2, 0)], "k int, v int"), 1)
    for _ in range(2):
        assert table.upsert(spark.createDataFrame([(2, 5), (3, 5)], "k int, v int"), 2) == 2
    assert sorted(map(tuple, table.current().collect())) == [(1, 0), (2, 5), (3, 5)]


def test_old_versions_go_and_with_them_what_only_they_list(spark):
    table = keyed(spark, keep=1)
    for n in range(6):
        table.upsert(spark.createDataFrame([(1, n), (100 + n, n)], "k int, v int"))
    assert table.current(5).where("k = 1").first().v == 4 and table.current(6).count() == 7
    with pytest.raises(Exception):
        table.current(3).count()
    listed = set(table.folders(5)) | set(table.folders(6))
    root = table.path.removeprefix("file:") + "/rows"
    there = {f"{d}" for d, _, names in os.walk(root) if any(n.endswith(".parquet") for n in names)}
    assert {f.removeprefix("file:") for f in listed} == there


def made_log(n, keys, first=0):
    rng = random.Random(n + first)
    return [(first + i, rng.randint(1, keys), rng.choice("IUUD"), when(first + i), rng.randint(0, 9)) for i in range(n)]


def test_log_batches_add_closed_files_and_rewrite_touched_buckets(spark):
    table, rows = keyed(spark), []
    for batch in (made_log(40, 30), made_log(3, 30, 100), [], made_log(2, 30, 200)):
        before = files(table)
        log = spark.createDataFrame(batch, LOG)
        versions.extend_history(table, log, "k", "lsn", "at", ["v"])
        rows += batch
        after = files(table)
        touched = table.touched(log)
        assert all(after[f] == t for f, t in before.items() if f in after)
        gone = {f.split("_bucket=")[1].split("/")[0] for f in set(before) - set(after)}
        assert {int(g) for g in gone} <= set(touched)
        assert not any("settled" in f for f in set(before) - set(after))
        want = temporal.scd2_from_log(spark.createDataFrame(rows, LOG), "k", "lsn", "at", ["v"])
        assert sorted(versions.history(table).select(want.columns).collect()) == sorted(want.collect())
    assert SETTLED in table.folders().values()


def test_late_entries_are_told_and_write_nothing(spark):
    table = keyed(spark)
    versions.extend_history(table, spark.createDataFrame([(5, 1, "I", when(5), 1), (6, 2, "D", when(6), 1)], LOG), "k", "lsn", "at", ["v"])
    for late in ([(5, 1, "U", when(5), 2)], [(4, 2, "I", when(4), 2)], [(9, 1, "U", when(9), 2), (1, 2, "I", when(9), 2)]):
        with pytest.raises(versions.LateEntries):
            versions.extend_history(table, spark.createDataFrame(late, LOG), "k", "lsn", "at", ["v"])
    assert table.latest() == 1


@pytest.mark.parametrize("close_missing", [False, True])
def test_snapshots_merge_as_the_plain_merge_does(spark, close_missing):
    rng = random.Random(3)
    table = keyed(spark)
    plain = None
    source = {k: (k % 3, "n") for k in range(40)}
    for step in range(4):
        frame = spark.createDataFrame([(k, *v) for k, v in source.items()], "k int, v int, note string")
        before = files(table)
        versions.merge_snapshot(table, frame, "k", ["v", "note"], ts(step), close_missing, ["note"])
        empty = frame.limit(0).withColumn("sys_start", ts(0)).withColumn("sys_end", ts(0))
        plain = temporal.scd2_merge(empty if plain is None else plain, frame, "k", ["v", "note"], ts(step), close_missing, ["note"])
        plain = spark.createDataFrame(plain.collect(), plain.schema)
        assert sorted(versions.history(table).select(plain.columns).collect()) == sorted(plain.collect())
        after = files(table)
        assert not any("settled" in f for f in set(before) - set(after))
        if step:
            assert set(before) & set(after)  # some buckets had no change
        source = dict(source)
        for k in rng.sample(sorted(source), 2):
            source[k] = (source[k][0] + 1, "m")
        del source[rng.choice(sorted(source))]
        source[100 + step] = (1, "n")
    versions.merge_snapshot(table, frame, "k", ["v", "note"], ts(9), close_missing, ["note"])
    assert set(files(table)) == set(after)  # nothing changed, nothing is written
