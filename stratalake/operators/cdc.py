"""Change log: building, incremental reads, current state and checks.

A log has the columns ``lsn``, ``op`` (I, U, D), ``full_row`` (JSON text) and ``load_ts``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.functions.measures import minutes
from stratalake.operators.ordered import number_rows


def payload(columns: Sequence[str]) -> Column:
    """Row as a JSON object of text values; NULL fields are left out."""
    return F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in columns]))


def to_change_log(
    df: DataFrame, order: Sequence[str], op: Column, load_ts: Column, start_lsn: int = 0, columns: Sequence[str] | None = None
) -> DataFrame:
    """Turn rows into log entries with dense, increasing numbers after ``start_lsn``."""
    data = list(columns or df.columns)
    kept = df.select(*order, op.alias("op"), payload(data).alias("full_row"), load_ts.alias("load_ts"))
    return number_rows(kept, order, "lsn", start_lsn).select("lsn", "op", "full_row", "load_ts")


def high_watermark(log: DataFrame) -> DataFrame:
    """Highest number in the log, 0 when it is empty."""
    return log.agg(F.coalesce(F.max("lsn"), F.lit(0).cast("bigint")).alias("high_watermark"))


def changes_after(log: DataFrame, last_lsn: int) -> DataFrame:
    """Entries beyond the last one processed; the filter reaches the scan."""
    return log.where(F.col("lsn") > last_lsn)


def dedupe(log: DataFrame) -> DataFrame:
    """One entry per number; of several, the one loaded last (then by content)."""
    rest = [c for c in log.columns if c != "lsn"]
    order = ["load_ts", *[c for c in rest if c != "load_ts"]]
    best = log.groupBy("lsn").agg(F.max(F.struct(*order)).alias("_row"))
    return best.select(*[F.col("lsn") if c == "lsn" else F.col(f"_row.{c}").alias(c) for c in log.columns])


def state_from_log(log: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Latest state per key; deleted keys are gone. One aggregate, combined before the shuffle."""
    latest = log.groupBy(key).agg(F.max_by(F.struct("op", "lsn", *columns), F.col("lsn")).alias("_row"))
    return latest.where(F.col("_row.op") != "D").select(key, "_row.lsn", *[F.col(f"_row.{c}").alias(c) for c in columns])


def lag_report(log: DataFrame, table: str, as_of: Column, limit_minutes: int = 10) -> DataFrame:
    """Minutes since the last load, entries, last number and whether the lag calls for an alert."""
    seen = log.agg(
        F.lit(table).alias("table_name"),
        F.coalesce(minutes(F.max("load_ts"), as_of), F.lit(0.0)).alias("lag_minutes"),
        F.count(F.lit(1)).alias("total_records"),
        F.coalesce(F.max("lsn"), F.lit(0).cast("bigint")).alias("latest_lsn"),
    )
    return seen.withColumn("alert_required", F.col("lag_minutes") > limit_minutes)


# The parsed payload of a landed entry.
PARSED = "row"


def parsed(log: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Entries with their payload parsed once, as VARIANT column ``row``, and the faulty ones with the reason.

    Only objects are payloads. What is stored is read by path later, whatever fields it has.
    """
    row = F.try_parse_json("full_row")
    fault = (
        F.when(F.col("full_row").isNull(), "no payload")
        .when(~F.coalesce(F.schema_of_variant(PARSED).startswith("OBJECT"), F.lit(False)), "no object")
    )
    told = log.withColumn(PARSED, row).withColumn("fault", fault)
    return told.where("fault IS NULL").drop("fault"), told.where("fault IS NOT NULL").drop(PARSED)


def value(name: str, kind: str = "string") -> Column:
    """One field of a parsed payload, tolerantly cast; NULL where it is absent."""
    return F.try_variant_get(PARSED, f"$.{name}", "string").try_cast(kind)


def payload_schema(entries: DataFrame) -> DataFrame:
    """The schema that all parsed payloads fit together, inferred in one aggregate."""
    return entries.agg(F.schema_of_variant_agg(PARSED).alias("payload_schema"))


def is_object(full_row: Column) -> Column:
    """Whether the text is a JSON object."""
    return F.coalesce(F.schema_of_variant(F.try_parse_json(full_row)).startswith("OBJECT"), F.lit(False))


def op_distribution(log: DataFrame) -> DataFrame:
    return log.groupBy("op").agg(F.count(F.lit(1)).alias("entries"))


def validate(log: DataFrame, table: str) -> DataFrame:
    """Entries, distinct numbers, their range, valid payloads, known operations and the verdict."""
    # Entries are first combined per number, so the distinct count needs no second expansion.
    per_lsn = log.groupBy("lsn").agg(
        F.count(F.lit(1)).alias("_n"),
        F.count_if(is_object(F.col("full_row"))).alias("_valid"),
        F.count_if(F.col("op").isin("I", "U", "D")).alias("_known"),
    )
    zero = F.lit(0).cast("bigint")
    seen = per_lsn.agg(
        F.lit(table).alias("table_name"),
        F.coalesce(F.sum("_n"), zero).alias("total_records"),
        F.count("lsn").alias("unique_lsns"),
        F.coalesce(F.min("lsn"), zero).alias("min_lsn"),
        F.coalesce(F.max("lsn"), zero).alias("max_lsn"),
        F.coalesce(F.sum("_valid"), zero).alias("valid_payloads"),
        F.coalesce(F.sum("_known"), zero).alias("known_ops"),
    )
    total = F.col("total_records")
    return seen.withColumn(
        "passed",
        (total > 0)
        & (total == F.col("unique_lsns"))
        & (total == F.col("valid_payloads"))
        & (total == F.col("known_ops")),
    )


def inserted_revenue(entries: DataFrame, amount: str, at: str) -> DataFrame:
    """Monthly revenue straight from the parsed payloads of inserts."""
    inserts = entries.where(F.col("op") == "I")
    return inserts.groupBy(F.trunc(value(at, "timestamp"), "month").alias("month")).agg(
        F.sum(value(amount, "decimal(18,4)")).alias("revenue"), F.count(F.lit(1)).alias("inserts")
    )
