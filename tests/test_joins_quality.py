"""Joins, fact grains and quality reports."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from stratalake.operators import joins, quality
from stratalake.plans import facts

MONEY = "decimal(18,4)"


def rentals(spark):
    rows = [
        (1, 10, "2024-03-02 10:00:00", "2024-03-05 23:00:00"),  # Saturday, day 3
        (2, 10, "2024-03-03 10:00:00", "2024-03-07 01:00:00"),  # Sunday, day 4
        (3, 11, "2024-03-04 10:00:00", None),  # Monday, open
    ]
    df = spark.createDataFrame(rows, "rental_id int, customer_id int, o string, r string")
    return df.select("rental_id", "customer_id", F.col("o").cast("timestamp").alias("rental_date"), F.col("r").cast("timestamp").alias("return_date"))


def payments(spark):
    rows = [(1, "1.50", "2024-03-09"), (1, "2.50", "2024-03-08"), (2, "9.99", "2024-03-09")]
    df = spark.createDataFrame(rows, "rental_id int, a string, d string")
    return df.select("rental_id", F.col("a").cast(MONEY).alias("amount"), F.col("d").cast("timestamp").alias("payment_date"))


def test_fact_per_rental(spark):
    fact = facts.rental_fact(rentals(spark), payments(spark)).orderBy("rental_id").collect()
    assert [r.revenue_amount for r in fact] == [Decimal("4.0000"), Decimal("9.9900"), Decimal("2.9900")]
    assert [r.payment_count for r in fact] == [2, 1, 0]
    assert fact[0].payment_date == dt.datetime(2024, 3, 8) and fact[2].payment_date == dt.datetime(2024, 3, 4, 10)
    assert [(r.rental_duration_actual, r.is_overdue, r.days_overdue) for r in fact] == [(3, False, 0), (4, True, 1), (None, False, 0)]
    assert [r.is_weekend_rental for r in fact] == [True, True, False]
    assert [r.return_date_key for r in fact] == [20240305, 20240307, 19000101]


def test_fact_per_payment(spark):
    fact = facts.rental_fact(rentals(spark), payments(spark), per_payment=True).collect()
    assert sorted((r.rental_id, r.revenue_amount) for r in fact) == [
        (1, Decimal("1.5000")), (1, Decimal("2.5000")), (2, Decimal("9.9900")), (3, Decimal("2.9900"))
    ]


def test_left_join_detail_equals_left_join_with_a_hot_key(spark):
    base = spark.range(50).select(F.col("id").alias("k"), (F.col("id") * 2).alias("b"))
    detail = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 80).alias("k"), F.col("id").alias("d"))
    got = joins.left_join_detail(base, detail, "k", {"d": F.coalesce("_d_d", F.lit(-1))})
    want = base.join(detail, "k", "left").select("k", "b", F.coalesce("d", F.lit(-1)).alias("d"))
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_lookup_keys_and_denormalize(spark):
    fact = spark.createDataFrame([(1, 5), (2, 6), (3, None)], "id int, film int")
    dim = spark.createDataFrame([(5, "k5", "A")], "film_id int, film_key string, title string")
    got = joins.lookup_keys(fact, [(dim, "film", "film_id", "film_key")]).orderBy("id")
    assert [r.film_key for r in got.collect()] == ["k5", "-1", "-1"]
    wide = joins.denormalize(fact, [(dim, {"film": "film_id"}, {"title": "title"})])
    assert wide.count() == 3 and wide.columns == ["id", "film", "title"]


def test_broadcast_only_what_was_counted(spark):
    small, big = spark.range(5), spark.range(50)
    hinted = joins.broadcast_checked(small, 10)._jdf.queryExecution().logical().toString()
    plain = joins.broadcast_checked(big, 10)._jdf.queryExecution().logical().toString()
    assert "broadcast" in hinted.lower() and "broadcast" not in plain.lower()


def test_aggregate_join_fills_zero(spark):
    base = spark.createDataFrame([(1,), (2,)], "k int")
    agg = spark.createDataFrame([(1, 4, 2)], "k int, n int, last int")
    got = joins.join_aggregate(base, agg, "k", ["n"]).orderBy("k").collect()
    assert [(r.n, r.last) for r in got] == [(4, 2), (0, None)]


def test_orphans(spark):
    child = spark.createDataFrame([(1,), (1,), (2,), (9,), (9,), (None,)], "f int")
    parent = spark.createDataFrame([(1,), (2,), (2,)], "id int")
    assert tuple(joins.orphan_report(child, [("f", parent, "id")]).first()) == ("f", 5, 2, 1)
    assert joins.present_rows(child, parent, "f", "id").count() == 3
    assert tuple(joins.orphan_report(child.where("f > 99"), [("f", parent, "id")]).first()) == ("f", 0, 0, 0)


def test_quarantine(spark):
    raw = spark.createDataFrame([("1", "2.5"), ("x", "2.5"), (" ", None), ("2", "y")], "id string, amount string")
    good, bad = quality.quarantine(raw, {"id": "int", "amount": "decimal(10,2)", "absent": "int"})
    assert good.count() == 2
    assert sorted(r.rejected_columns for r in bad.collect()) == ["amount", "id"]


def test_reports(spark):
    landed = spark.createDataFrame([("1", "b1", "t", "h", True), (None, "b2", "t", None, True)], "id string, br_batch_id string, br_load_time string, br_record_hash string, br_is_current boolean")
    assert tuple(quality.bronze_check(landed, "b1").first()) == (2, 2, 1, False)
    assert tuple(quality.bronze_check(landed.where("id = '1'"), "b1").first()) == (1, 1, 1, True)
    assert not quality.bronze_check(landed.where("id = 'none'"), "b1").first().passed
    assert tuple(quality.null_check(landed, "t", "id").first()) == ("t", 2, 1, 1, 2)
    status = dict(quality.readiness({"a": landed, "b": landed.limit(0)}, ["a", "b", "c"]).collect())
    assert status == {"a": "ready", "b": "empty", "c": "missing"}
    allowed = quality.accepted_values(landed, {"id": ["2"], "br_batch_id": ["b1", "b2"]})
    assert dict(allowed.collect()) == {"id": 1, "br_batch_id": 0}
    assert quality.duplicates(landed.unionByName(landed), ["br_batch_id"]).count() == 2


def test_reconcile_counts_copies(spark):
    a = spark.createDataFrame([(1,), (1,), (2,), (None,)], "v int")
    b = spark.createDataFrame([(1,), (3,), (None,)], "v int")
    assert tuple(quality.reconcile(a, b).first()) == (4, 3, 2, 1)
    assert tuple(quality.reconcile(a.limit(0), b.limit(0)).first()) == (0, 0, 0, 0)


def test_invariants_on_tables(spark, small):
    from catalog import binding, gold

    fact = gold.fact(spark, small)
    assert fact.count() == binding.rental(spark, small).count()
    total = fact.agg(F.sum("revenue_amount")).first()[0]
    assert gold.metrics(spark, small).agg(F.sum("total_revenue")).first()[0] == total


def test_distinct_counts_and_mergeable_sketches(spark):
    from stratalake.operators import distinct

    rows = spark.range(60_000).selectExpr("id % 3 AS k", "id % 7919 AS a", "if(id % 5 = 0, NULL, id % 11) AS b", "add_months(DATE '2024-01-01', cast(id % 4 AS int)) AS m")
    rows = rows.unionByName(rows.limit(1).selectExpr("cast(NULL AS bigint) AS k", "1L AS a", "cast(NULL AS bigint) AS b", "m"))
    got = distinct.distinct_counts(rows, ["k"], {"as": "a", "bs": "b"})
    want = rows.groupBy("k").agg(F.count_distinct("a").alias("as"), F.count_distinct("b").alias("bs"))
    assert sorted(got.collect(), key=str) == sorted(want.collect(), key=str)
    assert distinct.distinct_counts(rows, [], {"n": "a"}).first() == (7919,)
    assert "Expand" not in got._jdf.queryExecution().optimizedPlan().toString()
    stored = distinct.sketches(rows, ["k", "m"], {"as": "a"})
    for r in distinct.united(stored, ["k"], ["as"]).join(want.where("k IS NOT NULL"), "k").collect():
        assert abs(r.as_estimate - r["as"]) <= distinct.error() * r["as"]
    whole = distinct.rolling(stored, ["k"], "m", 4, ["as"])
    last = rows.where("k = 0").agg(F.max("m")).first()[0]
    (three,) = whole.where("k = 0").where(F.col("m") == F.lit(last)).collect()
    assert abs(three.as_estimate - 7919) <= distinct.error() * 7919


def test_derived_keys_are_those_of_a_lookup(spark):
    from stratalake.functions.keys import surrogate_key

    fact = spark.createDataFrame([(1, 10), (2, 11), (3, 12), (4, 13), (5, None), (6, 10), (6, 13)], "id int, film int")
    films = spark.createDataFrame([(10, None), (12, None), (12, "second"), (13, "other"), (14, None), (None, None)], "film_id int, own string")
    dim = films.withColumn("film_key", F.coalesce("own", surrogate_key("film", "film_id")))
    dim = dim.unionByName(spark.createDataFrame([(11, "x", None)], "film_id int, own string, film_key string"))
    expected = surrogate_key("film", "film")
    old = joins.lookup_keys(fact, [(dim, "film", "film_id", "film_key")])
    narrow = joins.irregular_keys(fact, [(dim, "film", "film_id", "film_key", expected)])
    assert [r.film_key for r in narrow.where("film = 10").collect()] == [None, None]
    new = joins.derived_keys(narrow, {"film_key": expected})
    assert new.columns == old.columns and sorted(map(str, new.collect())) == sorted(map(str, old.collect()))


def test_folded_keys_come_back(spark):
    from stratalake.functions.keys import fold_keys, surrogate_key, unfold_keys

    ids = spark.createDataFrame([(1, None), (2, "-"), (3, ""), (4, "=a"), (5, "own"), (None, "own")], "id int, other string")
    keys = ids.withColumn("key", F.when(F.col("id") == 1, surrogate_key("a", "id")).otherwise(F.col("other")))
    keys = keys.unionByName(ids.where("id > 1").selectExpr("id", "other", "NULL AS key"))
    expected = {"key": surrogate_key("a", "id")}
    folded = fold_keys(keys, expected)
    assert [r.id for r in folded.where("key IS NULL").collect()] == [1]
    assert sorted(map(str, unfold_keys(folded, expected).collect())) == sorted(map(str, keys.collect()))
