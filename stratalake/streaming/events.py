"""Event ingest: file or broker source, duplicates, static lookups and a day-partitioned sink."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def read_files(spark: SparkSession, folder: str, schema: StructType, pattern: str, per_batch: int | None = None) -> DataFrame:
    """Parquet files that match ``pattern`` below ``folder``, as they arrive."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if per_batch:
        reader = reader.option("maxFilesPerTrigger", per_batch)
    raw = reader.parquet(folder)
    zoned = {c: F.col(c).cast("timestamp") for c, kind in raw.dtypes if kind == "timestamp_ntz"}
    return raw.withColumns(zoned) if zoned else raw


def read_broker(spark: SparkSession, servers: str, topic: str, schema: StructType, extra: Mapping[str, str] | None = None) -> DataFrame:
    """JSON events of a Kafka topic; needs the connector package on the cluster."""
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, **(extra or {})}
    raw = spark.readStream.format("kafka").options(**options).load()
    return raw.select(F.from_json(F.col("value").cast("string"), schema).alias("_e")).select("_e.*")


# Kind of the rows that carry nothing but a time, which moves the watermark of a quiet stream.
HEARTBEAT = "heartbeat"


def _slices(events: DataFrame, order: Column, parts: int, folder: str) -> int | None:
    """Write slices of equal span of ``order`` one after the other; the last value."""
    first, last = events.agg(F.min(order), F.max(order)).first()
    if first is None:
        events.write.mode("append").parquet(folder)
        return None
    span = -(-(last - first + 1) // parts)
    for n in range(parts):
        events.where((order >= first + n * span) & (order < first + (n + 1) * span)).write.mode("append").parquet(folder)
    return last


def replay_by(rows: DataFrame, order: str, parts: int, folder: str) -> None:
    """Land a finished log in ``parts`` writes in the order of a whole number, one file each."""
    _slices(rows.coalesce(1), F.col(order), parts, folder)


def replay(events: DataFrame, event_time: str, kind: str, parts: int, folder: str, idle: str = "2 days") -> None:
    """Land a finished table in ``parts`` writes in time order, for a stream that reads it bit by bit.

    The slices have equal spans of time. The last write is a heartbeat ``idle`` behind the last
    event, with which the watermark passes all events.
    """
    at = F.unix_micros(F.col(event_time).cast("timestamp"))
    last = _slices(events, at, parts, folder)
    if last is None:
        return
    beat = F.timestamp_micros(F.lit(last)) + F.expr(f"INTERVAL {idle}")
    # All other columns are those of some event, so that no join or test on them loses the beat early.
    changed = {event_time: beat.cast(events.schema[event_time].dataType), kind: F.lit(HEARTBEAT)}
    events.where(at == last).limit(1).withColumns(changed).coalesce(1).write.mode("append").parquet(folder)


def behind_watermark(stream: DataFrame, event_time: str, test: Column) -> DataFrame:
    """Rows that pass ``test``, while all rows, heartbeats too, move the watermark.

    A plain filter would be pushed before the watermark; one that names the event time is not.
    """
    return stream.where(test | F.col(event_time).isNull())


def drop_repeats(stream: DataFrame, ids: list[str], event_time: str, delay: str = "10 minutes") -> DataFrame:
    """Keep the first event per id; a repeat later than ``delay`` is no longer recognised."""
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(ids)


def enrich(stream: DataFrame, static: DataFrame, key: str) -> DataFrame:
    """Left-join a static lookup; it is read anew in every micro-batch."""
    return stream.join(static, key, "left")


def write_events(
    stream: DataFrame, path: str, checkpoint: str, partition_by: str | None = "event_date", once: bool = True
) -> StreamingQuery:
    """Append to Parquet exactly once; ``once`` stops after the events at hand."""
    writer = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    if once:
        writer = writer.trigger(availableNow=True)
    return writer.start(path)
