"""Data-quality scores, checks and reports; each report is one pass of conditional aggregates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.functions.cleanse import apply_rule
from stratalake.functions.measures import mean
from stratalake.operators.distinct import distinct_counts


def completeness(df: DataFrame, required: Sequence[str], penalty: str = "0.2") -> Column:
    """1 minus ``penalty`` per NULL or blank required field, never below 0; unknown fields are ignored."""
    known = [c for c in required if c in df.columns]
    gaps = F.lit(0)
    for name in known:
        gaps = gaps + F.when(F.trim(F.col(name).cast("string")) != "", 0).otherwise(1)
    step = F.lit(Decimal(penalty)).cast("decimal(3,2)")
    return F.greatest(F.lit(1) - gaps * step, F.lit(0)).cast("decimal(3,2)")


def quarantine(df: DataFrame, rules: Mapping[str, str]) -> tuple[DataFrame, DataFrame]:
    """Rows whose text fits the rules, and the rest with the names of the failing columns.

    A value is rejected when the raw text is present but its typed form is NULL.
    """
    checks = []
    for name, rule in rules.items():
        if name in df.columns:
            given = F.coalesce(F.trim(F.col(name)) != "", F.lit(False))
            checks.append(F.when(given & apply_rule(F.col(name), rule).isNull(), F.lit(name)))
    failed = F.filter(F.array(*checks), lambda c: c.isNotNull())
    marked = df.withColumn("_failed", failed)
    good = marked.where(F.size("_failed") == 0).drop("_failed")
    bad = marked.where(F.size("_failed") > 0).withColumn("rejected_columns", F.array_join("_failed", ",")).drop("_failed")
    return good, bad


def bronze_check(df: DataFrame, batch_id: str) -> DataFrame:
    """Row count, rows with load time and rows of this batch; passes when all agree and are positive."""
    counted = df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count("br_load_time").alias("rows_with_load_time"),
        F.count_if(F.col("br_batch_id") == batch_id).alias("rows_in_batch"),
    )
    total = F.col("total_rows")
    return counted.withColumn(
        "passed", (total > 0) & (total == F.col("rows_with_load_time")) & (total == F.col("rows_in_batch"))
    )


def null_check(df: DataFrame, table: str, id_column: str, hash_column: str = "br_record_hash") -> DataFrame:
    """NULL ids, missing hashes and current rows of one landed table."""
    return df.agg(
        F.lit(table).alias("table_name"),
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col(id_column).isNull()).alias("null_source_ids"),
        F.count_if(F.col(hash_column).isNull()).alias("missing_hashes"),
        F.count_if(F.col("br_is_current")).alias("current_rows"),
    )


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table with its count and whether it holds anything."""
    report = None
    for name, df in tables.items():
        line = df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count"))
        report = line if report is None else report.unionByName(line)
    return report.withColumn("has_rows", F.col("row_count") > 0)


def fact_check(fact: DataFrame, keys: Mapping[str, str], revenue: str, rate: str, exact: bool = True) -> DataFrame:
    """Facts, distinct keys, facts with revenue and the average rate.

    ``exact=False`` estimates the distinct keys, which spares the shuffle of every key.
    """
    figures = [
        F.count(F.lit(1)).alias("total_facts"),
        F.count_if(F.col(revenue) > 0).alias("revenue_facts"),
        mean(F.col(rate)).alias("avg_rate"),
    ]
    if not exact:
        estimates = [F.approx_count_distinct(src).alias(new) for new, src in keys.items()]
        return fact.agg(*figures, *estimates).select("total_facts", *keys, "revenue_facts", "avg_rate")
    # Two one-row frames; without facts the second has no row.
    counted = distinct_counts(fact, [], keys).withColumn("_one", F.lit(1))
    whole = fact.agg(*figures).withColumn("_one", F.lit(1)).join(counted, "_one", "left")
    return whole.select("total_facts", *[F.coalesce(k, F.lit(0)).alias(k) for k in keys], "revenue_facts", "avg_rate")


def score_check(df: DataFrame, score: str, threshold: str = "0.8") -> DataFrame:
    """Rows, average score and rows at or above the threshold."""
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        mean(F.col(score)).alias("avg_quality_score"),
        F.count_if(F.col(score) >= F.lit(Decimal(threshold))).alias("high_quality_rows"),
    )


def customer_check(dim: DataFrame, top_tier: str = "Platinum") -> DataFrame:
    """Customers, average activity and spend, and members of the top tier."""
    return dim.agg(
        F.count(F.lit(1)).alias("total_customers"),
        mean(F.col("total_rentals")).alias("avg_rentals"),
        mean(F.col("total_payments")).alias("avg_payments"),
        F.count_if(F.col("customer_tier") == top_tier).alias("top_tier_customers"),
    )


def accepted_values(df: DataFrame, allowed: Mapping[str, Sequence[str]]) -> DataFrame:
    """Per column: rows whose value is outside the allowed list (NULL is accepted), in one pass."""
    outside = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.count_if(F.col(c).isNotNull() & ~F.col(c).isin(*values)).alias("violations"),
        )
        for c, values in allowed.items()
    ]
    return df.agg(F.array(*outside).alias("_r")).select(F.inline("_r"))


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("occurrences")).where("occurrences > 1")


def reconcile(source: DataFrame, target: DataFrame) -> DataFrame:
    """Compare two tables row by row, duplicates included, in one shuffle.

    Identical rows are counted per side before the shuffle, so copies cost nothing.
    """
    columns = source.columns
    tagged = source.select(*columns, F.lit(1).alias("_s"), F.lit(0).alias("_t")).unionByName(
        target.select(*columns, F.lit(0).alias("_s"), F.lit(1).alias("_t"))
    )
    per_row = tagged.groupBy(*columns).agg(F.sum("_s").alias("_s"), F.sum("_t").alias("_t"))
    zero = F.lit(0).cast("bigint")
    return per_row.agg(
        F.coalesce(F.sum("_s"), zero).alias("source_rows"),
        F.coalesce(F.sum("_t"), zero).alias("target_rows"),
        F.coalesce(F.sum(F.greatest(F.col("_s") - F.col("_t"), zero)), zero).alias("only_in_source"),
        F.coalesce(F.sum(F.greatest(F.col("_t") - F.col("_s"), zero)), zero).alias("only_in_target"),
    )


def verdict(checks: Mapping[str, DataFrame]) -> DataFrame:
    """One row per check, passed when it has rows and every row says so in ``passed``, and the overall row."""
    report = None
    for name, check in checks.items():
        line = check.agg(F.lit(name).alias("check_name"), F.coalesce(F.bool_and("passed"), F.lit(False)).alias("passed"))
        report = line if report is None else report.unionByName(line)
    return report.unionByName(report.agg(F.lit("bi_ready").alias("check_name"), F.bool_and("passed").alias("passed")))


def readiness(tables: Mapping[str, DataFrame], required: Sequence[str]) -> DataFrame:
    """Per required table: ``ready``, ``empty`` or ``missing``; looks at one row of each."""
    spark = next(iter(tables.values())).sparkSession
    report = None
    for name in required:
        if name not in tables:
            line = spark.range(1).select(F.lit(name).alias("table_name"), F.lit("missing").alias("status"))
        else:
            one = tables[name].select(F.lit(1).alias("_x")).limit(1)
            line = one.agg(
                F.lit(name).alias("table_name"),
                F.when(F.count("_x") > 0, "ready").otherwise("empty").alias("status"),
            )
        report = line if report is None else report.unionByName(line)
    return report
