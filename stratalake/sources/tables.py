"""Readers: columnar files, partitioned JDBC scans and lenient landing."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(
    spark: SparkSession,
    folder: str,
    name: str,
    time_column: str | None = None,
    since: str | None = None,
    before: str | None = None,
) -> DataFrame:
    """Parquet table ``name`` below ``folder``, on request only ``since <= time_column < before``.

    Timestamps without a zone become instants in the session zone, which epoch
    arithmetic and streaming watermarks need. A filter on the cast column would stay
    above the scan, so the period is compared in the stored type, where it prunes files.
    """
    raw = spark.read.parquet(f"{folder}/{name}.parquet")
    if time_column:
        stored = dict(raw.dtypes)[time_column]
        if since:
            raw = raw.where(F.col(time_column) >= F.lit(since).cast(stored))
        if before:
            raw = raw.where(F.col(time_column) < F.lit(before).cast(stored))
    zoned = {c: F.col(c).cast("timestamp") for c, kind in raw.dtypes if kind == "timestamp_ntz"}
    return raw.withColumns(zoned) if zoned else raw


def jdbc_options(
    url: str,
    table: str,
    partition_column: str | None = None,
    bounds: tuple[object, object] | None = None,
    partitions: int = 1,
    fetch_size: int = 10_000,
    extra: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Options of a JDBC scan split into ``partitions`` range queries."""
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size), **(extra or {})}
    if partitions > 1:
        if partition_column is None or bounds is None:
            raise ValueError("a split JDBC scan needs a partition column and its bounds")
        options |= {
            "partitionColumn": partition_column,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(partitions),
        }
    return options


def read_jdbc(spark: SparkSession, *args, **kwargs) -> DataFrame:
    """Database table through JDBC; arguments as for :func:`jdbc_options`."""
    return spark.read.format("jdbc").options(**jdbc_options(*args, **kwargs)).load()


def to_strings(df: DataFrame) -> DataFrame:
    """Every column as text, in one projection."""
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


def add_missing_columns(df: DataFrame, defaults: Mapping[str, tuple[object, str]]) -> DataFrame:
    """Add each column of ``defaults`` (name -> value, type) that ``df`` lacks."""
    new = {c: F.lit(v).cast(t) for c, (v, t) in defaults.items() if c not in df.columns}
    return df.withColumns(new) if new else df


def union_evolved(*frames: DataFrame) -> DataFrame:
    """Union by name; columns a frame does not know yet are NULL there."""
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame, allowMissingColumns=True)
    return result


def is_empty(df: DataFrame) -> bool:
    """Stop at the first row instead of counting the table."""
    return df.isEmpty()
