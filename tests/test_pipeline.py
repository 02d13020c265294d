"""Running layers: lineage, error policy, run metrics, sources and plans."""

import pytest
from pyspark.sql import functions as F

from stratalake.plans.pipeline import LineageError, Step, check_lineage, run
from stratalake.session import configure, fresh_path, shared_dir
from stratalake.sources import tables


def plus(name):
    return lambda df: df.withColumn(name, F.lit(1))


def steps():
    return [
        Step("bronze.a", ["source.a"], plus("b")),
        Step("silver.a", ["bronze.a"], plus("s")),
        Step("gold.a", ["silver.a"], lambda df: df.groupBy("s").count()),
        Step("gold.b", ["gold.a"], plus("g")),
    ]


def test_run_reports_every_table(spark):
    result = run(spark, steps(), {"source.a": spark.range(5)}, fresh_path(spark, "run"), "b1")
    assert result.rows == {"bronze.a": 5, "silver.a": 5, "gold.a": 1, "gold.b": 1}
    assert result.total_rows == 12 and result.bi_ready
    assert result.report(spark).where("status = 'ok'").count() == 4


def test_refresh_lists_rows_without_a_usable_id(spark, small):
    from catalog import all_queries, landing

    all_queries()
    result = landing._refresh(spark, small)
    rejected = result.tables["bronze.customer_rejected"]
    assert result.rows["bronze.customer_rejected"] == rejected.count() > 0
    assert rejected.count() + result.rows["gold.dim_customer"] == result.rows["bronze.customer"]
    assert {(r.customer_id, r.rejected_columns) for r in rejected.collect()} == {("n/a", "customer_id")}
    assert {result.rows[f"bronze.{t}_rejected"] for t in ("film", "language", "payment", "rental")} == {0}
    # A star query on a month opens that month only.
    fact, dates = result.tables["gold.fact_rental"], result.tables["gold.dim_date"]
    month = fact.where("month = '1996-02'")
    assert 0 < month.count() < fact.count() and "PartitionFilters: [isnotnull(month" in plan_of(month)
    months = dates.where("date_key BETWEEN 19960201 AND 19960229").selectExpr("substring(cast(date_key AS string), 1, 6) AS m")
    star = fact.join(months.selectExpr("concat(substring(m, 1, 4), '-', substring(m, 5, 2)) AS month").distinct(), "month")
    assert "dynamicpruning" in plan_of(star) and star.count() == month.count()


def test_rejected_rows_are_replayed_once(spark):
    from stratalake.plans.pipeline import land_corrected

    def reason(df):
        return F.when(F.col("id").try_cast("int").isNull(), F.lit("id"))

    path = fresh_path(spark, "run")
    rows = spark.createDataFrame([(1, "1"), (2, "x"), (3, "y"), (4, None)], "row int, id string")
    result = run(spark, [Step("bronze.a", ["source.a"], lambda df: df, rejects=reason)], {"source.a": rows}, path, "b1")
    assert result.rows == {"bronze.a": 4, "bronze.a_rejected": 3}
    assert result.tables["bronze.a"].columns == ["row", "id"] and result.tables["bronze.a"].count() == 4
    table = f"{path}/bronze/a"
    better = spark.createDataFrame([(2, "20"), (3, "still bad")], "row int, id string")
    for _ in range(2):  # a repeated replay changes nothing
        assert land_corrected(spark, table, better, "row", reason) == (1, 2)
        got = {(r.row, r.id, r.br_outcome) for r in spark.read.parquet(table).collect()}
        assert got == {(1, "1", "accepted"), (2, "20", "corrected"), (3, "still bad", "rejected"), (4, None, "rejected")}
    rest = spark.createDataFrame([(3, "30"), (4, "40")], "row int, id string")
    assert land_corrected(spark, table, rest, "row", reason) == (3, 0)
    assert spark.read.parquet(table).where("br_outcome = 'rejected'").count() == 0


def test_steps_start_when_their_own_inputs_are_written(spark):
    import threading

    second = threading.Event()

    def slow(df):
        assert second.wait(60)  # the step below the fast one runs before this one ends
        return df

    def after_fast(df):
        second.set()
        return df

    steps = [Step("bronze.slow", ["source.a"], slow), Step("bronze.fast", ["source.a"], lambda df: df), Step("silver.fast", ["bronze.fast"], after_fast)]
    result = run(spark, steps, {"source.a": spark.range(3)}, fresh_path(spark, "run"), "b1", parallel=2)
    assert result.rows == {"bronze.slow": 3, "bronze.fast": 3, "silver.fast": 3}


def test_empty_input_is_not_an_error(spark):
    result = run(spark, steps()[:2], {"source.a": spark.range(0)}, fresh_path(spark, "run"), "b1")
    assert result.rows == {"bronze.a": 0, "silver.a": 0} and result.bi_ready
    assert tables.is_empty(spark.range(0))


def test_error_policies(spark):
    broken = [steps()[0], Step("silver.a", ["bronze.a"], lambda df: df.select("no_such_column")), *steps()[2:], Step("bronze.c", ["source.a"], plus("c"))]
    with pytest.raises(Exception, match="no_such_column"):
        run(spark, broken, {"source.a": spark.range(5)}, fresh_path(spark, "run"), "b1")
    result = run(spark, broken, {"source.a": spark.range(5)}, fresh_path(spark, "run"), "b1", on_error="collect")
    assert set(result.rows) == {"bronze.a", "bronze.c"} and set(result.errors) == {"silver.a", "gold.a", "gold.b"}
    assert not result.bi_ready and "silver.a" in result.errors["gold.a"]
    with pytest.raises(ValueError):
        run(spark, [], {}, "x", "b1", on_error="ignore")


def test_lineage_guard():
    gold = Step("gold.a", ["bronze.a"], plus("x"))
    with pytest.raises(LineageError, match="must not read"):
        check_lineage([steps()[0], gold], ["source.a"])
    with pytest.raises(LineageError, match="no earlier step"):
        check_lineage([steps()[1]], ["source.a"])


def test_jdbc_scan_is_split():
    options = tables.jdbc_options("jdbc:x", "t", "id", (1, 100), 8)
    assert options["numPartitions"] == "8" and options["partitionColumn"] == "id"
    assert "numPartitions" not in tables.jdbc_options("jdbc:x", "t")
    with pytest.raises(ValueError):
        tables.jdbc_options("jdbc:x", "t", partitions=4)


def test_schema_evolution(spark):
    df = spark.range(1).select("id")
    assert dict(tables.add_missing_columns(df, {"is_active": (True, "boolean"), "id": (1, "int")}).dtypes) == {"id": "bigint", "is_active": "boolean"}
    both = tables.union_evolved(df, df.withColumn("x", F.lit("a")))
    assert sorted(str(r.x) for r in both.collect()) == ["None", "a"]


def test_shared_folder_follows_the_session(spark):
    configure(spark)
    before = spark.conf.get("spark.checkpoint.dir", None)
    folder = shared_dir(spark)
    assert before in (None, folder) and fresh_path(spark, "a") != fresh_path(spark, "a")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(spark, small):
    from catalog.registry import QUERIES
    from catalog import all_queries

    all_queries()
    plan = plan_of(QUERIES["scan_orders"](spark, small))
    assert "PushedFilters: [IsNotNull(o_orderdate), IsNotNull(o_orderstatus), GreaterThanOrEqual(o_orderdate" in plan
    assert "o_totalprice" not in plan
    metrics = plan_of(QUERIES["customer_activity"](spark, small))
    assert "o_totalprice" not in metrics


def test_no_plan_has_a_cartesian_product(spark, small):
    from catalog import all_queries

    builders, _ = all_queries()
    for name in ("executive_summary", "fact_rental", "fact_key_lookup", "store_scorecard", "alert_eval", "as_of_join", "rfm_segments"):
        plan = plan_of(builders[name](spark, small))
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_paid_rentals_reduce_payments_before_the_join(spark, small):
    from catalog import gold

    plan = gold.fact(spark, small)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join LeftOuter") < plan.index("Aggregate [rental_id")


def test_as_of_periods_reach_the_scan(spark, small):
    from catalog import all_queries

    builders, _ = all_queries()
    for name in ("recent_window", "executive_summary", "store_dashboard", "alert_management"):
        assert "GreaterThanOrEqual(ts," in plan_of(builders[name](spark, small)), name


def test_bucketed_tables_join_without_a_shuffle(spark):
    from stratalake.sources.sinks import write_bucketed

    names = []
    for part in ("l", "r"):
        path = fresh_path(spark, "bucketed")
        names.append(f"{part}_{path[-12:]}")
        write_bucketed(spark.range(100).selectExpr("id % 7 AS k", f"id AS {part}"), path, names[-1], "k", 4)
    left, right = (spark.table(n) for n in names)
    joined = left.join(right.hint("shuffle_merge"), "k").groupBy("k").count()
    assert "Exchange" not in plan_of(joined) and joined.count() == 7


def test_scratch_deletes_what_it_pinned(spark):
    import os

    from stratalake.session import pin, scratch, shared_dir

    before = set(os.listdir(shared_dir(spark).removeprefix("file://")))
    with scratch(spark):
        assert pin(spark.range(5), "gone").count() == 5
    assert set(os.listdir(shared_dir(spark).removeprefix("file://"))) == before


def test_a_fact_is_widened_behind_its_shuffle_and_packed(spark):
    import glob

    from catalog.landing import _settings
    from stratalake.plans.layers import gold_steps

    rows = spark.createDataFrame([(1, "2024-01-05 10:00:00"), (2, "2024-02-05 10:00:00"), (3, None)], "id int, at string")
    seen = []

    def widen(df):
        seen.append(plan_of(df))
        return df.withColumn("double", F.col("id") * 2)

    path = fresh_path(spark, "run")
    made = run(spark, [Step("bronze.a", ["source.a"], lambda df: df, month="at", widen=widen)], {"source.a": rows}, path, "b1").tables["bronze.a"]
    assert made.columns == ["id", "at", "double", "month"]
    assert sorted((r.id, r.double, r.month) for r in made.where("id < 3").collect()) == [(1, 2, "2024-01"), (2, 4, "2024-02")]
    assert made.where("month IS NULL").count() == 1 and any("REBALANCE" in p.upper() for p in seen)
    files = glob.glob(f"{path.removeprefix('file://')}/**/*.parquet", recursive=True)
    assert files and all(f.endswith(".zstd.parquet") for f in files)
    fact = next(s for s in gold_steps(_settings()) if s.target == "gold.fact_rental")
    assert fact.widen is not None
