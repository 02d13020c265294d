"""Column rules, keys, silver entities and dimensions on hand-made rows."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from stratalake.functions.cleanse import at_least, bucket, list_items, parse_flag, recode, typed, typed_null
from stratalake.functions.keys import record_hash, surrogate_key
from stratalake.functions.measures import mean, minutes, ratio, whole_days
from stratalake.operators.audit import add_bronze_audit, add_gold_audit, add_silver_audit, batch_label
from stratalake.plans import dims, silver

def now():
    return F.lit("2024-02-01 00:00:00").cast("timestamp")


def one(df, column):
    return [r[0] for r in df.select(column).collect()]


def test_dirty_customer(spark):
    rows = [
        ("1", " Ann ", "B", "", "true", "7", "2024-02-29", "1", "5"),
        (" 2 ", "", "C", " A@B.C ", "FALSE", "7", "2023-02-29", "x", "5"),
        ("x", None, "D", None, "t", None, "bad", None, None),
        (None, "E", " ", "q@r.s", None, "9", None, "0", "1"),
    ]
    names = ["customer_id", "first_name", "last_name", "email", "activebool", "address_id", "create_date", "active", "store_id"]
    bronze = spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names))
    got = silver.silver_entity(bronze, silver.CUSTOMER, "s1", now()).orderBy("last_name").collect()
    by_last = {r.last_name: r for r in got}
    assert [by_last[k].customer_id for k in ("B", "C", "D", "")] == [1, 2, None, None]
    assert [by_last[k].email for k in ("B", "C", "D", "")] == [None, "a@b.c", None, "q@r.s"]
    assert [by_last[k].activebool for k in ("B", "C", "D", "")] == [True, False, True, True]
    assert by_last["B"].create_date == dt.date(2024, 2, 29) and by_last["C"].create_date is None
    scores = [by_last[k].sl_data_quality_score for k in ("B", "C", "D", "")]
    assert scores == [Decimal("1.00"), Decimal("0.80"), Decimal("0.20"), Decimal("0.60")]
    assert dict(silver.silver_entity(bronze, silver.CUSTOMER, "s1", now()).dtypes)["sl_source_bronze_key"] == "string"


def test_shared_address_appears_once(spark):
    bronze = spark.createDataFrame([("7",), ("7",), (None,), ("8",)], "address_id string")
    got = silver.inferred_entity(bronze, "address", "address_id", silver.placeholder_address(now()), "s1", now())
    assert sorted(one(got, "address_id")) == [7, 8]


def test_film_edges(spark):
    rows = [(1, 90, "14.99", "G", 2004), (2, 91, "15", "PG-13", 2005), (3, 120, "25", "R", None), (4, 121, None, "NC-17", 2006), (5, None, "24.99", None, 2005)]
    films = spark.createDataFrame(rows, "film_id int, length int, replacement_cost string, rating string, release_year int")
    films = films.withColumn("replacement_cost", F.col("replacement_cost").cast("decimal(18,4)")).withColumn("language_id", F.lit(1))
    languages = spark.createDataFrame([(2, "Sign")], "language_id int, name string")
    wide = dims.film_dimension(films, languages).orderBy("film_id")
    assert one(wide, "is_feature_length") == [True, True, True, True, False]
    assert one(wide, "revenue_tier") == ["Budget", "Standard", "Premium", "Budget", "Standard"]
    assert one(wide, "film_category") == ["Family", "Teen", "Adult", "General", "General"]
    assert set(one(wide, "language_name")) == {"Unknown"}
    band = bucket(F.col("length"), [("<=", 90, "Short"), ("<=", 120, "Medium")], "Long")
    assert one(wide.withColumn("b", band), "b") == ["Short", "Medium", "Medium", "Long", "Long"]
    assert one(wide.withColumn("n", at_least(F.col("release_year"), 2005)), "n") == [False, True, False, True, True]


def test_tiers(spark):
    df = spark.createDataFrame([("19.99",), ("20",), ("50",), ("99.99",), ("100",), (None,)], "v string")
    paid = F.col("v").cast("decimal(18,4)")
    assert one(df.select(dims.tier(paid)), "*") == ["Bronze", "Silver", "Gold", "Gold", "Platinum", "Bronze"]


def test_hash_tells_nulls_and_separators_apart(spark):
    rows = [("a", None, "b"), ("a", "b", None), ("a|b", None, None), ("a", "b", "")]
    df = spark.createDataFrame(rows, "x string, y string, z string")
    assert len(set(one(df.select(record_hash(["x", "y", "z"])), "*"))) == 4
    assert len(set(one(df.select(record_hash(["x", "y", "z"], compat=True)), "*"))) == 2


def test_keys_repeat_and_look_like_uuids(spark):
    df = spark.createDataFrame([(1,), (2,)], "id int")
    first, again = (sorted(one(df.select(surrogate_key("x", "id")), "*")) for _ in range(2))
    other = one(df.select(surrogate_key("y", "id")), "*")
    assert first == again and not set(first) & set(other)
    assert [len(p) for p in first[0].split("-")] == [8, 4, 4, 4, 12]


def test_audit_columns(spark):
    df = spark.createDataFrame([("1", "a")], "id string, v string")
    bronze = add_bronze_audit(df, "t", "src.t", "b1", now(), ["id"])
    assert [c for c in bronze.columns if c.startswith("br_")] == [
        "br_load_time", "br_source_file", "br_batch_id", "br_is_current", "br_record_hash", "br_t_key"
    ]
    row = add_silver_audit(bronze, "t", "s1", now()).first()
    assert row.sl_source_bronze_key == row.br_t_key
    assert add_gold_audit(df, "t", "g1", now()).first().gl_source_silver_key is None
    assert batch_label("bronze_basic", "2024-02-01T06:00:00") == "bronze_basic_20240201T060000"


def test_small_rules(spark):
    df = spark.createDataFrame([("Trailers, X ,,",), (" ",), (None,)], "v string")
    assert one(df.select(list_items(F.col("v"))), "*") == [["Trailers", "X"], [], []]
    assert one(df.select(parse_flag(F.col("v"), default=False)), "*") == [False] * 3
    assert one(df.select(recode(F.col("v"), {" ": "blank"}, "other")), "*") == ["other", "blank", "other"]
    assert dict(df.select(typed_null("date").alias("a"), typed(1, "bigint").alias("b")).dtypes) == {"a": "date", "b": "bigint"}


def test_measures(spark):
    df = spark.createDataFrame([(1, 8), (2, 3), (1, 0)], "a int, b int")
    assert one(df.select(ratio(F.col("a"), F.col("b"), 2, times=100).cast("string")), "*") == ["12.50", "66.67", None]
    assert df.agg(mean(F.col("b"))).first()[0] == 11 / 3
    span = spark.sql("SELECT timestamp'2024-01-01 10:00:00' s, timestamp'2024-01-03 09:59:30' e")
    assert span.select(whole_days(F.col("s"), F.col("e")), minutes(F.col("s"), F.col("e"))).first() == (1, 2879.5)


def test_calendar(spark):
    dates = dims.calendar(spark)
    assert dates.count() == 11_323
    wide = dims.extend_calendar(dates, F.to_date(F.lit("2024-12-30")))
    pick = {str(r.calendar_date): r for r in wide.where("calendar_date in ('2024-02-29','2024-12-30','2024-03-31','2024-04-01','2000-01-01','2030-12-31')").collect()}
    assert pick["2024-02-29"].is_leap_year and pick["2024-02-29"].is_month_end and pick["2024-02-29"].season == "Winter"
    assert pick["2024-12-30"].calendar_week == 1 and pick["2024-12-30"].is_current_day
    assert (pick["2024-03-31"].fiscal_year, pick["2024-03-31"].fiscal_quarter, pick["2024-03-31"].fiscal_month) == (2023, 4, 12)
    assert (pick["2024-04-01"].fiscal_year, pick["2024-04-01"].fiscal_quarter, pick["2024-04-01"].fiscal_month) == (2024, 1, 1)
    assert pick["2000-01-01"].date_key == 20000101 and pick["2000-01-01"].is_weekend and pick["2000-01-01"].day_of_week == 7
    assert pick["2030-12-31"].is_year_end and pick["2030-12-31"].quarter_year == "2030-Q4"
    assert dims.with_unknown_date(dates).where("date_key = 19000101").first().date_name == "Unknown"


def test_top_value_breaks_ties_by_value(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, "b"), (1, "a"), (2, "z")], "k int, v string")
    assert dict(dims.top_value(df, "k", "v", "t").collect()) == {1: "a", 2: "z"}
