"""Sinks: full refresh, idempotent append, month-partitioned facts and snapshots."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


# Keys and hashes are hexadecimal text, which only a codec with entropy coding halves; its lowest level does.
PACKED = {"compression": "zstd", "parquet.compression.codec.zstd.level": "1"}


def write_full(df: DataFrame, path: str) -> None:
    """Replace the table at ``path``."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").options(**PACKED).parquet(path)


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "overwrite", extra: Mapping[str, str] | None = None):
    """Write to a database table; a refresh truncates, so keys and indexes of the table stay."""
    options = {"url": url, "dbtable": table, "batchsize": "10000", **(extra or {})}
    if mode == "overwrite":
        options["truncate"] = "true"
    df.write.format("jdbc").options(**options).mode(mode).save()


def write_append(df: DataFrame, path: str, batch_id: str, column: str = "batch_id") -> None:
    """Append one batch as its own partition; writing the batch again replaces only that partition."""
    (
        df.withColumn(column, F.lit(batch_id))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(column)
        .parquet(path)
    )


def write_by_month(
    df: DataFrame, path: str, event_time: str, widen: Callable[[DataFrame], DataFrame] | None = None
) -> None:
    """Fact table partitioned by month.

    Rows are gathered by month, and adaptive execution splits a heavy month into files of
    the advisory size and merges light ones: no month is one task's job, and none becomes
    thousands of small files. ``widen`` adds the columns that follow from a row alone; it
    runs behind the shuffle, so they do not travel.
    """
    dated = df.withColumn("month", F.date_format(event_time, "yyyy-MM")).hint("rebalance", F.col("month"))
    rows = widen(dated) if widen else dated
    rows.write.mode("overwrite").options(**PACKED).partitionBy("month").parquet(path)


def write_bucketed(df: DataFrame, path: str, table: str, key: str, buckets: int) -> None:
    """Catalog table hashed and sorted by ``key``.

    Tables bucketed alike join and aggregate on the key without another shuffle, which
    pays off for rentals and payments that every refresh brings together. Rows go to
    their bucket's writer first, so there is one file per bucket.
    """
    (
        df.repartition(buckets, key)
        .write.mode("overwrite")
        .option("path", path)
        .bucketBy(buckets, key)
        .sortBy(key)
        .saveAsTable(table)
    )


def read_months(spark: SparkSession, path: str, first: str, last: str) -> DataFrame:
    """Months ``first`` to ``last`` (``yyyy-MM``); other partitions are never opened."""
    facts = spark.read.option("inferSchema", "false").parquet(path)
    month = F.col("month").cast("string")
    return facts.where((month >= first) & (month <= last))


def insert_absent(existing: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """``existing`` plus those ``rows`` whose key it does not hold yet."""
    new = rows.join(existing.select(key), key, "left_anti")
    return existing.unionByName(new)


class Snapshots:
    """Complete table versions side by side; readers see the newest finished one.

    A version counts once its ``_SUCCESS`` marker exists, which the job commit
    writes last, so a version that was cut off is never read and a path being read
    is never overwritten.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def latest(self) -> int:
        """Number of the newest finished version, 0 when there is none."""
        jvm = self.spark._jvm
        marker = jvm.org.apache.hadoop.fs.Path(f"{self.path}/v=*/_SUCCESS")
        found = marker.getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(marker)
        numbers = [int(f.getPath().getParent().getName().split("=")[1]) for f in found or []]
        return max(numbers, default=0)

    def read(self, version: int | None = None) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/v={version or self.latest()}")

    def write(self, df: DataFrame, version: int | None = None) -> int:
        """Write ``df`` as the next version (or as ``version``, for a repeatable retry)."""
        number = version or self.latest() + 1
        df.write.mode("overwrite").parquet(f"{self.path}/v={number}")
        return number


def snapshot_column(df: DataFrame, as_of: Column, name: str = "snapshot_date") -> DataFrame:
    """Stamp a fact with the date it was taken."""
    return df.withColumn(name, as_of.cast("date"))
