"""Scans, sinks, audit columns and column rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import binding as b
from catalog.registry import query
from stratalake.functions.cleanse import blank_to_null, bucket, parse_flag, recode
from stratalake.functions.keys import record_hash, surrogate_key
from stratalake.functions.measures import date_key, minutes, whole_days
from stratalake.operators import audit, quality
from stratalake.plans import dims, silver
from stratalake.plans.layers import Settings, bronze_steps, full_refresh, unusable_id
from stratalake.plans.pipeline import land_corrected, run
from stratalake.session import fresh_path
from stratalake.sources import sinks, tables

LOAD = "2024-02-01 06:00:00"
BATCH = "bronze_basic_20240201T060000"


def _load_time():
    return F.lit(LOAD).cast("timestamp")


def _typed_orders(spark, sf):
    orders = tables.read_table(spark, sf, "orders")
    return orders.selectExpr(
        "o_orderkey", "o_custkey", "o_orderstatus", "cast(o_totalprice AS decimal(18,2)) AS o_totalprice",
        "cast(o_orderdate AS date) AS o_orderdate", "nullif(o_orderpriority, '5-LOW') AS o_orderpriority",
    )


SQL_ORDERS = """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice::DECIMAL(18,2) AS o_totalprice,
    o_orderdate::DATE AS o_orderdate, nullif(o_orderpriority, '5-LOW') AS o_orderpriority FROM orders"""


@query(
    "scan_orders",
    "SELECT o_orderkey, o_custkey, o_orderdate FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01' AND o_orderstatus = 'F'",
)
def scan_orders(spark, sf):
    raw = spark.read.parquet(f"{sf}/orders.parquet")
    late = F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz")
    return raw.where(late & (F.col("o_orderstatus") == "F")).select("o_orderkey", "o_custkey", "o_orderdate")


@query(
    "bronze_strings",
    f"""SELECT o_orderkey::VARCHAR AS o_orderkey, o_custkey::VARCHAR AS o_custkey, o_orderstatus,
        o_totalprice::VARCHAR AS o_totalprice, o_orderdate::VARCHAR AS o_orderdate, o_orderpriority
        FROM ({SQL_ORDERS})""",
)
def bronze_strings(spark, sf):
    return tables.to_strings(_typed_orders(spark, sf))


@query("full_refresh_roundtrip", f"{SQL_ORDERS} WHERE o_orderstatus <> 'P'".replace("o_totalprice::DECIMAL(18,2)", "o_totalprice"))
def full_refresh_roundtrip(spark, sf):
    path = fresh_path(spark, "refresh")
    orders = _typed_orders(spark, sf)
    sinks.write_full(orders, path)
    sinks.write_full(orders.where("o_orderstatus <> 'P'"), path)
    return spark.read.parquet(path)


@query("append_idempotent", "SELECT 'batch-' || o_orderstatus AS batch_id, count(*) AS n FROM orders GROUP BY ALL")
def append_idempotent(spark, sf):
    path = fresh_path(spark, "append")
    orders = _typed_orders(spark, sf)
    for state in ("F", "O", "P", "O"):
        sinks.write_append(orders.where(F.col("o_orderstatus") == state), path, f"batch-{state}")
    return spark.read.parquet(path).groupBy("batch_id").agg(F.count(F.lit(1)).alias("n"))


@query(
    "fact_month_pruned",
    """SELECT strftime(payment_date, '%Y-%m') AS month, count(*) AS n, sum(amount)::DOUBLE AS amount FROM payment
       WHERE payment_date >= TIMESTAMP '1996-02-01' AND payment_date < TIMESTAMP '1996-05-01' GROUP BY ALL""",
)
def fact_month_pruned(spark, sf):
    path = fresh_path(spark, "months")
    sinks.write_by_month(b.payment(spark, sf), path, "payment_date")
    months = sinks.read_months(spark, path, "1996-02", "1996-04")
    return months.groupBy(F.col("month").cast("string").alias("month")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("amount").alias("amount")
    )


@query(
    "fact_snapshot",
    "SELECT rental_id, line_number, amount::DOUBLE AS amount, DATE '2001-06-30' AS snapshot_date FROM payment",
)
def fact_snapshot(spark, sf):
    facts = b.payment(spark, sf).select("rental_id", "line_number", "amount")
    return sinks.snapshot_column(facts, b.as_of_date())


@query(
    "seed_insert_if_absent",
    """WITH kept AS (SELECT p_type AS name, count(*) AS uses FROM part GROUP BY ALL),
         seeds AS (SELECT DISTINCT c_mktsegment AS name FROM customer UNION SELECT DISTINCT o_orderpriority FROM orders UNION SELECT DISTINCT upper(p_type) FROM part)
       SELECT * FROM kept UNION ALL SELECT name, 0 FROM seeds WHERE name NOT IN (SELECT name FROM kept)""",
)
def seed_insert_if_absent(spark, sf):
    kinds = tables.read_table(spark, sf, "part").select(F.col("p_type").alias("name"))
    existing = kinds.groupBy("name").agg(F.count(F.lit(1)).alias("uses"))
    names = kinds
    for table, column in (("customer", "c_mktsegment"), ("orders", "o_orderpriority")):
        names = names.union(tables.read_table(spark, sf, table).select(column))
    seeds = names.distinct().withColumn("uses", F.lit(0).cast("bigint"))
    return sinks.insert_absent(existing, seeds, "name")


@query(
    "evolve_add_column",
    """SELECT 'A' AS side, n_nationkey AS id, n_name AS name, TRUE AS is_active, NULL::VARCHAR AS note FROM nation
       UNION ALL SELECT 'B', s_suppkey::INT, s_name, s_acctbal > 0, 'new' FROM supplier""",
)
def evolve_add_column(spark, sf):
    old = tables.read_table(spark, sf, "nation").selectExpr("'A' AS side", "n_nationkey AS id", "n_name AS name")
    new = tables.read_table(spark, sf, "supplier").selectExpr(
        "'B' AS side", "cast(s_suppkey AS int) AS id", "s_name AS name", "s_acctbal > 0 AS is_active", "'new' AS note"
    )
    return tables.union_evolved(tables.add_missing_columns(old, {"is_active": (True, "boolean")}), new)


def _settings():
    return Settings("2024-02-01T06:00:00", _load_time, b.as_of_date, TIER_BOUNDS, TIER_BOUNDS[1], RATINGS, PRICE_TIERS, 25, 15, 35)


def _refresh(spark, sf):
    """The whole bronze, silver and gold refresh into a fresh folder."""
    settings = _settings()
    keys = {"customer": ["row_id"], "film": ["film_id"], "language": ["language_id"], "payment": ["payment_id"], "rental": ["rental_id"]}
    payments = b.customer_payment(spark, sf).withColumn("payment_id", F.expr("rental_id * 10 + line_number"))
    sources = {
        "source.customer": b.bronze_customer(spark, sf),
        "source.film": b.film(spark, sf),
        "source.language": b.language(spark, sf),
        "source.payment": payments,
        "source.rental": b.film_rental(spark, sf),
    }
    return run(spark, full_refresh(settings, keys), sources, fresh_path(spark, "run"), BATCH)


@query(
    "run_report",
    """SELECT *, 'ok' AS status FROM (
         SELECT 'bronze.customer' AS table_name, count(*) AS row_count FROM customer UNION ALL SELECT 'silver.customer', count(*) FROM customer
         UNION ALL SELECT 'bronze.film', count(*) FROM part UNION ALL SELECT 'silver.film', count(*) FROM part UNION ALL SELECT 'gold.dim_film', count(*) FROM part
         UNION ALL SELECT 'bronze.language', count(*) FROM language UNION ALL SELECT 'silver.language', count(*) FROM language
         UNION ALL SELECT 'bronze.payment', count(*) FROM customer_payment UNION ALL SELECT 'silver.payment', count(*) FROM customer_payment
         UNION ALL SELECT 'bronze.rental', count(*) FROM orders UNION ALL SELECT 'silver.rental', count(*) FROM orders UNION ALL SELECT 'gold.fact_rental', count(*) FROM orders
         UNION ALL SELECT 'silver.address', count(DISTINCT try_cast(address_id AS INT)) FROM bronze_customer
         UNION ALL SELECT 'silver.store', count(DISTINCT store_id) FROM bronze_customer UNION ALL SELECT 'gold.dim_store', count(DISTINCT store_id) FROM bronze_customer
         UNION ALL SELECT 'gold.dim_customer', count(try_cast(customer_id AS INT)) FROM bronze_customer
         UNION ALL SELECT 'bronze.customer_rejected', count(*) FILTER (try_cast(customer_id AS INT) IS NULL) FROM bronze_customer
         UNION ALL SELECT 'bronze.film_rejected', count(*) FILTER (p_partkey IS NULL) FROM part UNION ALL SELECT 'bronze.language_rejected', count(*) FILTER (language_id IS NULL) FROM language
         UNION ALL SELECT 'bronze.payment_rejected', count(*) FILTER (rental_id IS NULL) FROM customer_payment UNION ALL SELECT 'bronze.rental_rejected', count(*) FILTER (o_orderkey IS NULL) FROM orders
         UNION ALL SELECT 'gold.dim_staff', count(DISTINCT staff_id) FROM film_rental
         UNION ALL SELECT 'gold.customer_metrics', count(DISTINCT customer_id) FROM rental
         UNION ALL SELECT 'gold.dim_date', date_diff('day', date_trunc('year', least(min(rental_date), min(return_date))), date_trunc('year', greatest(max(rental_date), max(return_date))) + INTERVAL 1 YEAR) + 1 FROM rental)""",
)
def run_report(spark, sf):
    return _refresh(spark, sf).report(spark).drop("error")


@query(
    "refreshed_metrics",
    """SELECT customer_id::INT AS customer_id, total_rentals, total_revenue::DOUBLE AS total_revenue, customer_score, customer_tier FROM metrics""",
)
def refreshed_metrics(spark, sf):
    """Customer metrics as the refresh wrote them, through bronze text and silver types."""
    return _refresh(spark, sf).tables["gold.customer_metrics"].select(
        "customer_id", "total_rentals", "total_revenue", "customer_score", "customer_tier"
    )


def _hash_sql(columns):
    return "md5(concat_ws('|', " + ", ".join(f"coalesce(length({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')" for c in columns) + "))"


def key_sql(entity, *columns):
    digest = f"md5(concat_ws('|', '{entity}', " + ", ".join(f"coalesce(length(({c})::VARCHAR) || ':' || ({c})::VARCHAR, '-')" for c in columns) + "))"
    return f"regexp_replace({digest}, '(.{{8}})(.{{4}})(.{{4}})(.{{4}})(.{{12}})', '\\1-\\2-\\3-\\4-\\5')"


ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


@query(
    "bronze_audit",
    f"""SELECT o_orderkey::VARCHAR AS o_orderkey, TIMESTAMP '{LOAD}' AS br_load_time, 'source.orders' AS br_source_file,
        '{BATCH}' AS br_batch_id, TRUE AS br_is_current, {_hash_sql(ORDER_COLUMNS)} AS br_record_hash,
        {key_sql("br_orders", "o_orderkey")} AS br_orders_key FROM ({SQL_ORDERS})""",
)
def bronze_audit(spark, sf):
    landed = tables.to_strings(_typed_orders(spark, sf))
    audited = audit.add_bronze_audit(landed, "orders", "source.orders", BATCH, _load_time(), ["o_orderkey"])
    return audited.select("o_orderkey", *[c for c in audited.columns if c.startswith("br_")])


@query(
    "record_hash",
    f"""SELECT o_orderkey, {_hash_sql(ORDER_COLUMNS)} AS safe_hash,
        md5(concat_ws('|', o_orderkey::VARCHAR, o_custkey::VARCHAR, o_orderstatus, o_totalprice::VARCHAR,
            o_orderdate::VARCHAR, o_orderpriority)) AS compat_hash FROM ({SQL_ORDERS})""",
)
def record_hash_query(spark, sf):
    orders = _typed_orders(spark, sf)
    return orders.select(
        "o_orderkey",
        record_hash(ORDER_COLUMNS).alias("safe_hash"),
        record_hash(ORDER_COLUMNS, compat=True).alias("compat_hash"),
    )


@query(
    "surrogate_key",
    f"SELECT l_orderkey, l_linenumber, l_partkey, {key_sql('line', 'l_orderkey', 'l_linenumber', 'l_partkey')} AS line_key FROM lineitem",
)
def surrogate_key_query(spark, sf):
    lines = tables.read_table(spark, sf, "lineitem")
    return lines.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        surrogate_key("line", "l_orderkey", "l_linenumber", "l_partkey").alias("line_key"),
    )


@query(
    "silver_audit",
    f"""SELECT n_nationkey, {key_sql("br_nation", "n_nationkey")} AS sl_source_bronze_key, TIMESTAMP '{LOAD}' AS sl_created_time,
        TIMESTAMP '{LOAD}' AS sl_updated_time, TRUE AS sl_is_active, 's1' AS sl_batch_id, NULL::VARCHAR AS no_key FROM nation""",
)
def silver_audit(spark, sf):
    nation = tables.read_table(spark, sf, "nation").select("n_nationkey")
    landed = nation.withColumn("br_nation_key", surrogate_key("br_nation", "n_nationkey"))
    rows = audit.add_silver_audit(landed, "nation", "s1", _load_time())
    # An entity without a bronze key gets a typed NULL.
    lost = audit.add_silver_audit(nation, "nation", "s1", _load_time()).select(
        "n_nationkey", F.col("sl_source_bronze_key").alias("no_key")
    )
    return rows.drop("br_nation_key").join(lost, "n_nationkey")


@query(
    "gold_audit",
    f"""SELECT s_suppkey, {key_sql("sl_supplier", "s_suppkey")} AS gl_source_silver_key, TIMESTAMP '{LOAD}' AS gl_created_time,
        TIMESTAMP '{LOAD}' AS gl_updated_time, TRUE AS gl_is_current, 'g1' AS gl_batch_id FROM supplier""",
)
def gold_audit(spark, sf):
    rows = tables.read_table(spark, sf, "supplier").select("s_suppkey")
    keyed = rows.withColumn("sl_supplier_key", surrogate_key("sl_supplier", "s_suppkey"))
    return audit.add_gold_audit(keyed, "supplier", "g1", _load_time()).drop("sl_supplier_key")


SQL_CLEAN_CUSTOMER = """SELECT row_id, try_cast(customer_id AS INT) AS customer_id, try_cast(store_id AS INT) AS store_id,
    trim(first_name) AS first_name, trim(last_name) AS last_name, lower(nullif(trim(email), '')) AS email,
    try_cast(address_id AS INT) AS address_id, coalesce(lower(trim(activebool)) <> 'false', TRUE) AS activebool,
    try_cast(create_date AS DATE) AS create_date, try_cast(active AS INT) AS active, balance FROM bronze_customer"""
SQL_SCORE = """greatest(1 - 0.2 * ((customer_id IS NULL)::INT + (first_name IS NULL OR first_name = '')::INT
    + (last_name IS NULL OR last_name = '')::INT + (store_id IS NULL)::INT + (address_id IS NULL)::INT), 0)::DECIMAL(3,2)"""


@query("cleanse_customer", SQL_CLEAN_CUSTOMER)
def cleanse_customer(spark, sf):
    return silver.cleanse(b.bronze_customer(spark, sf), silver.CUSTOMER.rules)


@query(
    "cleanse_part",
    """SELECT p_partkey::INT AS film_id, p_name AS title, upper(p_type) AS rating, p_size AS length,
       p_retailprice::DECIMAL(18,4)::DOUBLE AS replacement_cost FROM part""",
)
def cleanse_part(spark, sf):
    raw = tables.read_table(spark, sf, "part").selectExpr(
        "concat(' ', p_partkey) AS film_id", "concat(p_name, ' ') AS title", "lower(p_type) AS rating",
        "cast(p_size AS string) AS length", "cast(cast(p_retailprice AS decimal(18,4)) AS string) AS replacement_cost",
    )
    return silver.cleanse(raw, silver.FILM_RULES)


@query("blank_to_null", "SELECT row_id, lower(nullif(trim(email), '')) AS email FROM bronze_customer")
def blank_to_null_query(spark, sf):
    return b.bronze_customer(spark, sf).select("row_id", F.lower(blank_to_null(F.col("email"))).alias("email"))


@query("parse_bool", "SELECT row_id, coalesce(lower(trim(activebool)) <> 'false', TRUE) AS activebool FROM bronze_customer")
def parse_bool(spark, sf):
    return b.bronze_customer(spark, sf).select("row_id", parse_flag(F.col("activebool")).alias("activebool"))


@query(
    "bucket_length",
    """SELECT film_id, CASE WHEN length <= 15 THEN 'Short' WHEN length <= 35 THEN 'Medium' ELSE 'Long' END AS band,
       CASE WHEN length > 10 AND length <= 35 THEN 'Not long' ELSE 'Long' END AS band_with_null FROM film""",
)
def bucket_length(spark, sf):
    films = b.film(spark, sf)
    known = F.when(F.col("length") > 10, F.col("length"))
    return films.select(
        "film_id",
        bucket(F.col("length"), [("<=", 15, "Short"), ("<=", 35, "Medium")], "Long").alias("band"),
        bucket(known, [("<=", 35, "Not long")], "Long").alias("band_with_null"),
    )


# Scaled to order totals; the thresholds of the domain are the defaults of ``dims.tier``.
TIER_BOUNDS = (2_500_000, 2_000_000, 1_500_000)


@query(
    "customer_tier",
    """SELECT customer_id, customer_tier, total_revenue >= 2000000 AS is_high_value, total_revenue::DOUBLE AS total_revenue FROM metrics""",
)
def customer_tier(spark, sf):
    from catalog.gold import metrics

    return metrics(spark, sf).select("customer_id", "customer_tier", "is_high_value", "total_revenue")


RATINGS = {"ECONOMY": "Family", "STANDARD": "Family", "PROMO": "Teen", "MEDIUM": "Adult"}
SQL_RATING = """CASE rating WHEN 'ECONOMY' THEN 'Family' WHEN 'STANDARD' THEN 'Family' WHEN 'PROMO' THEN 'Teen'
    WHEN 'MEDIUM' THEN 'Adult' ELSE 'General' END"""


@query("rating_category", f"SELECT film_id, rating, {SQL_RATING} AS film_category FROM film")
def rating_category(spark, sf):
    return b.film(spark, sf).select("film_id", "rating", recode(F.col("rating"), RATINGS, "General").alias("film_category"))


PRICE_TIERS = ((">=", 970, "Premium"), (">=", 930, "Standard"))
SQL_PRICE_TIER = """CASE WHEN replacement_cost >= 970 THEN 'Premium' WHEN replacement_cost >= 930 THEN 'Standard' ELSE 'Budget' END"""


@query("revenue_tier", f"SELECT film_id, {SQL_PRICE_TIER} AS revenue_tier, length >= 25 AS is_feature_length FROM film")
def revenue_tier(spark, sf):
    films = b.film(spark, sf)
    wide = dims.film_dimension(films, b.language(spark, sf), RATINGS, 25, PRICE_TIERS)
    return wide.select("film_id", "revenue_tier", "is_feature_length")


@query(
    "film_enrich",
    """SELECT film_id::INT AS film_id, (rental_rate * 10)::DOUBLE AS sl_revenue_potential, release_year >= 2005 AS sl_is_new_release FROM film""",
)
def film_enrich(spark, sf):
    rows = silver.silver_entity(tables.to_strings(b.film(spark, sf)), silver.film(15, 35), "s1", _load_time())
    return rows.select("film_id", "sl_revenue_potential", "sl_is_new_release")


@query(
    "default_fill",
    """SELECT customer_id, coalesce(a.address, 'Unknown') AS address, coalesce(a.postal_code, '00000') AS postal_code
       FROM b_customer c LEFT JOIN address_book a ON c.address_id = a.address_id""",
)
def default_fill(spark, sf):
    from stratalake.operators.joins import denormalize

    wide = denormalize(
        b.customer(spark, sf).select("customer_id", "address_id"),
        [(b.address(spark, sf), {"address_id": "address_id"}, {"address": "address", "postal_code": "postal_code"})],
    )
    return wide.select(
        "customer_id",
        F.coalesce("address", F.lit("Unknown")).alias("address"),
        F.coalesce("postal_code", F.lit("00000")).alias("postal_code"),
    )


@query(
    "recent_window",
    """SELECT event_id, ts, ts >= TIMESTAMP '2024-01-20 11:55:00' AS last_5_minutes, ts::DATE = DATE '2024-01-20' AS today FROM biz_events
       WHERE ts >= TIMESTAMP '2024-01-19 12:00:00' AND ts <= TIMESTAMP '2024-01-20 12:00:00'""",
)
def recent_window(spark, sf):
    now = b.as_of_time()
    events = b.events(spark, sf, since="2024-01-19 12:00:00").where((F.col("ts") >= now - F.expr("INTERVAL 24 HOURS")) & (F.col("ts") <= now))
    return events.select(
        "event_id",
        "ts",
        (F.col("ts") >= now - F.expr("INTERVAL 5 MINUTES")).alias("last_5_minutes"),
        (F.to_date("ts") == F.to_date(now)).alias("today"),
    )


@query(
    "string_ops",
    """SELECT row_id, trim(first_name) || ' ' || last_name AS full_name, concat_ws(', ', upper(last_name), nullif(trim(first_name), '')) AS sort_name,
       lower(trim(first_name)) AS lower_name FROM bronze_customer""",
)
def string_ops(spark, sf):
    raw = b.bronze_customer(spark, sf)
    first = F.trim("first_name")
    return raw.select(
        "row_id",
        F.concat(first, F.lit(" "), "last_name").alias("full_name"),
        F.concat_ws(", ", F.upper("last_name"), blank_to_null(F.col("first_name"))).alias("sort_name"),
        F.lower(first).alias("lower_name"),
    )


@query(
    "feature_flags",
    """SELECT film_id, special_features LIKE '%Trailers%' AS has_trailers, special_features LIKE '%Commentaries%' AS has_commentaries,
       special_features LIKE '%Deleted Scenes%' AS has_deleted_scenes, special_features LIKE '%Behind the Scenes%' AS has_behind_scenes,
       CASE WHEN trim(special_features) = '' THEN 0 ELSE len(string_split(special_features, ',')) END::INT AS special_features_count FROM film""",
)
def feature_flags(spark, sf):
    flagged = dims.feature_flags(b.film(spark, sf))
    return flagged.select("film_id", *[c for c in flagged.columns if c.startswith("has_")], "special_features_count")


@query(
    "names_list",
    """SELECT film_id, array_to_string(list_sort(list(DISTINCT n.n_name)), ', ') AS nations
       FROM payment p JOIN supplier s ON p.staff_id = s.s_suppkey JOIN nation n ON s.s_nationkey = n.n_nationkey GROUP BY film_id""",
)
def names_list(spark, sf):
    lines = b.payment(spark, sf).select("film_id", "staff_id").distinct()
    supplier = tables.read_table(spark, sf, "supplier").selectExpr("s_suppkey AS staff_id", "s_nationkey AS n_nationkey")
    nation = tables.read_table(spark, sf, "nation").select("n_nationkey", "n_name")
    links = lines.join(supplier, "staff_id").join(nation, "n_nationkey")
    return dims.names_list(links, "film_id", "n_name", "nations")


@query(
    "time_parts",
    """SELECT rental_id, year(rental_date)::INT AS y, month(rental_date)::INT AS m, day(rental_date)::INT AS d, quarter(rental_date)::INT AS q,
       week(rental_date)::INT AS w, (dayofweek(rental_date) + 1)::INT AS dow, dayofyear(rental_date)::INT AS doy, hour(rental_date)::INT AS h,
       dayname(rental_date) AS day_name, monthname(rental_date) AS month_name,
       (year(rental_date) * 10000 + month(rental_date) * 100 + day(rental_date))::INT AS date_key FROM rental""",
)
def time_parts(spark, sf):
    at = F.col("rental_date")
    return b.rental(spark, sf).select(
        "rental_id", F.year(at).alias("y"), F.month(at).alias("m"), F.dayofmonth(at).alias("d"), F.quarter(at).alias("q"),
        F.weekofyear(at).alias("w"), F.dayofweek(at).alias("dow"), F.dayofyear(at).alias("doy"), F.hour(at).alias("h"),
        F.date_format(at, "EEEE").alias("day_name"), F.date_format(at, "MMMM").alias("month_name"), date_key(at).alias("date_key"),
    )


@query(
    "date_buckets",
    """SELECT event_id, date_trunc('minute', ts) AS at_minute, date_trunc('hour', ts) AS at_hour, date_trunc('day', ts)::TIMESTAMP AS at_day,
       date_trunc('month', ts)::TIMESTAMP AS at_month, date_trunc('quarter', ts)::TIMESTAMP AS at_quarter, date_trunc('year', ts)::TIMESTAMP AS at_year FROM events""",
)
def date_buckets(spark, sf):
    events = tables.read_table(spark, sf, "events")
    units = ("minute", "hour", "day", "month", "quarter", "year")
    return events.select("event_id", *[F.date_trunc(u, "ts").alias(f"at_{u}") for u in units])


@query(
    "duration_minutes",
    """SELECT rental_id, date_diff('microsecond', rental_date, return_date) / 6e7 AS duration_minutes,
       floor(date_diff('microsecond', rental_date, return_date) / 86400000000)::BIGINT AS whole_days,
       date_diff('day', rental_date::DATE, return_date::DATE)::INT AS calendar_days FROM rental""",
)
def duration_minutes(spark, sf):
    out, back = F.col("rental_date"), F.col("return_date")
    return b.rental(spark, sf).select(
        "rental_id",
        minutes(out, back).alias("duration_minutes"),
        whole_days(out, back).alias("whole_days"),
        F.date_diff(F.to_date(back), F.to_date(out)).alias("calendar_days"),
    )


@query("dq_score", f"SELECT row_id, {SQL_SCORE}::DOUBLE AS score FROM ({SQL_CLEAN_CUSTOMER})")
def dq_score(spark, sf):
    typed = silver.cleanse(b.bronze_customer(spark, sf), silver.CUSTOMER.rules)
    return typed.select("row_id", quality.completeness(typed, [*silver.CUSTOMER.required, "no_such_column"]).alias("score"))


@query(
    "quarantine",
    """SELECT row_id, concat_ws(',', CASE WHEN try_cast(customer_id AS INT) IS NULL THEN 'customer_id' END,
         CASE WHEN try_cast(address_id AS INT) IS NULL THEN 'address_id' END,
         CASE WHEN try_cast(create_date AS DATE) IS NULL THEN 'create_date' END) AS rejected_columns FROM bronze_customer
       WHERE try_cast(customer_id AS INT) IS NULL OR try_cast(address_id AS INT) IS NULL OR try_cast(create_date AS DATE) IS NULL""",
)
def quarantine(spark, sf):
    _, bad = quality.quarantine(b.bronze_customer(spark, sf), silver.CUSTOMER.rules)
    return bad.select("row_id", "rejected_columns")


def _checks(made):
    # Rejected rows are no table that has to have rows.
    later = {name: df for name, df in made.items() if not name.startswith("bronze.")}
    facts = quality.fact_check(made["gold.fact_rental"], {"customers": "customer_id"}, "revenue_amount", "rental_rate")
    scores = quality.score_check(made["silver.customer"], "sl_data_quality_score")
    rejected = made["bronze.customer_rejected"].agg((F.count("*") == 0).alias("passed"))
    return quality.verdict(
        {
            "landing": quality.bronze_check(made["bronze.customer"], BATCH),
            "silver and gold rows": quality.table_counts(later).select(F.col("has_rows").alias("passed")),
            "fact revenue": facts.select((F.col("revenue_facts") == F.col("total_facts")).alias("passed")),
            "customer quality": scores.select((F.col("avg_quality_score") >= 0.8).alias("passed")),
            "no rejected customers": rejected,
        }
    )


@query(
    "model_verdict",
    f"""WITH checks AS (
         SELECT 'landing' AS check_name, count(*) > 0 AS passed FROM customer
         UNION ALL SELECT 'silver and gold rows', (SELECT count(*) FROM customer) > 0 AND (SELECT count(*) FROM part) > 0 AND (SELECT count(*) FROM orders) > 0 AND (SELECT count(*) FROM lineitem) > 0
         UNION ALL SELECT 'fact revenue', count(*) > 0 AND bool_and(amount > 0) FROM fact
         UNION ALL SELECT 'customer quality', avg(s) >= 0.8 FROM (SELECT {SQL_SCORE} AS s FROM ({SQL_CLEAN_CUSTOMER}))
         UNION ALL SELECT 'no rejected customers', count(*) FILTER (try_cast(customer_id AS INT) IS NULL) = 0 FROM bronze_customer)
       SELECT * FROM checks UNION ALL SELECT 'bi_ready', bool_and(passed) FROM checks""",
)
def model_verdict(spark, sf):
    """The rejected customers fail one check, and with it the whole."""
    return _checks(_refresh(spark, sf).tables)


@query(
    "refreshed_fact",
    f"""SELECT r.rental_id, strftime(r.rental_date, '%Y-%m') AS month, r.amount::DOUBLE AS amount,
         CASE WHEN c.customer_id IS NULL THEN '-1' ELSE {key_sql("gl_dim_customer", "r.customer_id")} END AS gl_dim_customer_key,
         CASE WHEN p.p_partkey IS NULL THEN '-1' ELSE {key_sql("gl_dim_film", "r.film_id")} END AS gl_dim_film_key,
         CASE WHEN s.store_id IS NULL THEN '-1' ELSE {key_sql("gl_dim_store", "r.store_id")} END AS gl_dim_store_key,
         {key_sql("gl_dim_staff", "r.staff_id")} AS gl_dim_staff_key
       FROM fact r LEFT JOIN (SELECT try_cast(customer_id AS INT) AS customer_id FROM bronze_customer) c ON c.customer_id = r.customer_id
       LEFT JOIN part p ON p.p_partkey = r.film_id LEFT JOIN (SELECT DISTINCT store_id::INT AS store_id FROM bronze_customer) s ON s.store_id = r.store_id""",
)
def refreshed_fact(spark, sf):
    """The fact as the refresh wrote it, by months, with all four dimension keys."""
    keys = ["gl_dim_customer_key", "gl_dim_film_key", "gl_dim_store_key", "gl_dim_staff_key"]
    return _refresh(spark, sf).tables["gold.fact_rental"].select("rental_id", "month", F.col("revenue_amount").alias("amount"), *keys)


@query(
    "quarantine_replay",
    """SELECT outcome, count(*) AS row_count, count(DISTINCT row_id) AS row_ids FROM (
         SELECT row_id, CASE WHEN try_cast(customer_id AS INT) IS NOT NULL THEN 'accepted' WHEN row_id % 2 = 0 THEN 'corrected' ELSE 'rejected' END AS outcome FROM bronze_customer)
       GROUP BY ALL""",
)
def quarantine_replay(spark, sf):
    """Landed customers by outcome after every other rejected row was corrected and replayed."""
    land, path = bronze_steps(_settings(), {"customer": ["row_id"]}), fresh_path(spark, "run")
    made = run(spark, land, {"source.customer": b.bronze_customer(spark, sf)}, path, BATCH).tables
    corrected = made["bronze.customer_rejected"].where("row_id % 2 = 0").drop("rejected_columns")
    corrected = corrected.withColumn("customer_id", F.col("row_id").cast("string"))
    table = f"{path}/bronze/customer"
    land_corrected(spark, table, corrected, "row_id", unusable_id("customer"))
    return spark.read.parquet(table).groupBy(F.col("br_outcome").alias("outcome")).agg(
        F.count("*").alias("row_count"), F.count_distinct("row_id").alias("row_ids")
    )
