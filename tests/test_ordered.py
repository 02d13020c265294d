"""Chunked ordered operators against brute force, with a key that owns most rows."""

import random

import pytest

from stratalake.operators import ordered


def frame(spark, seed, rows=400):
    rng = random.Random(seed)
    data = []
    for n in range(rows):
        key = "hot" if rng.random() < 0.5 else rng.choice(["a", "b", "c", None, "z"])
        data.append((key, n, rng.choice([None, None, None, rng.randint(0, 9)]), rng.randint(0, 3)))
    rng.shuffle(data)
    return data, spark.createDataFrame(data, "k string, t int, v int, few int")


@pytest.mark.parametrize("chunks", [1, 2, 7, 40])
def test_neighbours(spark, chunks):
    data, df = frame(spark, chunks)
    got = ordered.neighbours(df, ["k"], ["t"], {"pt": "t", "pv": "v"}, {"nt": "t", "nv": "v"}, chunks)
    by_key = {}
    for row in sorted(data, key=lambda r: r[1]):
        by_key.setdefault(row[0], []).append(row)
    want = set()
    for line in by_key.values():
        for i, (k, t, v, few) in enumerate(line):
            before = line[i - 1] if i else (None,) * 4
            after = line[i + 1] if i + 1 < len(line) else (None,) * 4
            want.add((k, t, v, few, before[1], before[2], after[1], after[2]))
    assert {tuple(r) for r in got.collect()} == want


@pytest.mark.parametrize("chunks", [1, 3, 60])
def test_carry_forward(spark, chunks):
    data, df = frame(spark, 10 + chunks)
    got = ordered.carry_forward(df, ["k"], ["t"], "v", chunks).select("k", "t", "v")
    held, want = {}, set()
    for k, t, v, _ in sorted(data, key=lambda r: r[1]):
        if v is not None:
            held[k] = v
        want.add((k, t, held.get(k)))
    assert {tuple(r) for r in got.collect()} == want


@pytest.mark.parametrize("chunks", [1, 5, 33])
def test_numbers_and_tiles(spark, chunks):
    data, df = frame(spark, 20 + chunks, rows=203)
    got = ordered.number_rows(df, ["few", "t"], "n", start=100, total="all", chunks=chunks)
    tiled = got.withColumn("tile", ordered.tile(got["n"] - 100, got["all"], 4)).collect()
    order = sorted((r[3], r[1]) for r in data)
    assert {(r.few, r.t): r.n for r in tiled} == {pair: 101 + i for i, pair in enumerate(order)}
    # 203 rows in four tiles: three of 51 and one of 50.
    sizes = [sum(r.tile == k for r in tiled) for k in (1, 2, 3, 4)]
    assert sizes == [51, 51, 51, 50]


@pytest.mark.parametrize("chunks", [1, 4, 50])
def test_rank_with_heavy_ties(spark, chunks):
    data, df = frame(spark, 30 + chunks)
    got = ordered.rank_rows(df.select("few", "t"), "few", "t", "r", total="all", chunks=chunks)
    values = [r[3] for r in data]
    for row in got.collect():
        assert row.r == 1 + sum(v < row.few for v in values)
        assert row.all == len(values)


def test_more_tiles_than_rows(spark):
    df = spark.createDataFrame([(i,) for i in range(3)], "t int")
    got = ordered.number_rows(df, ["t"], "n", total="all")
    assert sorted(r[0] for r in got.select(ordered.tile(got["n"], got["all"], 5)).collect()) == [1, 2, 3]


def test_empty_input(spark):
    df = spark.createDataFrame([], "k string, t int, v int")
    assert ordered.neighbours(df, ["k"], ["t"], {"p": "t"}).count() == 0
    assert ordered.number_rows(df, ["t"], "n").count() == 0


def test_a_hot_key_fills_many_chunks(spark):
    df = spark.range(6000).selectExpr("if(id % 3 = 0, -1, id) AS k", "id AS t")
    sizes = [r[1] for r in ordered.range_chunks(df, ["k", "t"], 12).groupBy(ordered.CHUNK).count().collect()]
    assert len(sizes) == 12 and max(sizes) < 2 * 6000 / 12
