"""Change-log ingestion: number new changes after the log and append them as one batch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from stratalake.operators import cdc
from stratalake.plans.pipeline import observe_counts
from stratalake.sources.sinks import write_append


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """The log with its batch ids as they were written; ``000000000002`` stays a word."""
    found = spark.read.parquet(path).schema
    kinds = [StructField(f.name, StringType()) if f.name == "batch_id" else f for f in found]
    return spark.read.schema(StructType(kinds)).parquet(path)


def last_number(spark: SparkSession, path: str, batch_id: str) -> int:
    """Highest number that batches before ``batch_id`` left in the log; 0 for a new log."""
    try:
        log = read_log(spark, path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return 0
        raise
    earlier = log.where(F.col("batch_id") < batch_id)
    return cdc.high_watermark(earlier).first()[0]


def ingest_changes(
    changed: DataFrame,
    path: str,
    batch_id: str,
    order: Sequence[str],
    op: Column,
    load_ts: Column,
    columns: Sequence[str] | None = None,
) -> int:
    """Append the changed rows to the log at ``path`` and return how many there were.

    The payload is stored as text and, parsed once, as VARIANT. Batch ids must be words that sort by time. A repeated batch counts from the batches
    before it, gets the same numbers and replaces itself.
    """
    start = last_number(changed.sparkSession, path, batch_id)
    built, _ = cdc.parsed(cdc.to_change_log(changed, order, op, load_ts, start, columns))  # what we build is an object
    entries, seen = observe_counts(built, f"changes {batch_id}")
    write_append(entries, path, batch_id)
    return seen.get["rows"]
