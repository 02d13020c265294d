"""Events that come too late for their slot: put aside as they arrive, mended afterwards.

A windowed stream drops events behind its watermark. A second stream over the same files puts
every event aside whose slot may have been closed by then; the slots it names, and no others, are
then counted anew from the landed events and replaced in the table of KPIs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stratalake.operators import kpi
from stratalake.sources.keyed import KeyedTable
from stratalake.sources.sinks import write_append
from stratalake.streaming.events import HEARTBEAT


def _slot_end(width: str):
    return F.window("ts", width).end


def put_aside(stream: DataFrame, path: str, checkpoint: str, width: str = "1 minute", delay: str = "10 minutes") -> StreamingQuery:
    """Append events whose slot had ended ``delay`` before the latest event seen so far.

    Heartbeats count as seen, but are no events. The latest time of each batch is kept beside the events, so that a repeated batch sees what
    it saw before. Batches need not be those of the stream of KPIs: as files come in the same
    order, an event that is late there is late here, or shares a batch with what made it late.
    """
    spark = stream.sparkSession

    def handle(batch: DataFrame, number: int) -> None:
        rows = batch.persist()
        here = rows.agg(F.max("ts").alias("latest"))
        write_append(here, f"{path}/seen", f"{number:012d}")
        seen = spark.read.parquet(f"{path}/seen").where(F.col("batch_id").cast("bigint") <= number)
        # One row per batch.
        latest = seen.agg(F.max("latest").alias("_latest"))
        events = rows.where(F.col("event_type") != HEARTBEAT)
        late = events.join(F.broadcast(latest)).where(_slot_end(width) <= F.col("_latest") - F.expr(f"INTERVAL {delay}"))
        write_append(late.drop("_latest"), f"{path}/late", f"{number:012d}")
        rows.unpersist()

    return stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def repair(spark: SparkSession, path: str, events: DataFrame, table: KeyedTable, width: str = "1 minute") -> int:
    """Count the slots of the events put aside anew from all ``events`` and replace them; how many slots."""
    aside = spark.read.parquet(f"{path}/late")
    slots = aside.select(F.window("ts", width).start.alias("kpi_timestamp"), "store_id").distinct().persist()
    bounds = slots.agg(F.min("kpi_timestamp"), F.max("kpi_timestamp") + F.expr(f"INTERVAL {width}"), F.count("*")).first()
    if bounds[2]:
        # The bounds prune files and days before the slots pick rows.
        inside = events.where((F.col("ts") >= F.lit(bounds[0])) & (F.col("ts") < F.lit(bounds[1])))
        slot = F.window("ts", width).start
        touched = inside.withColumn("kpi_timestamp", slot).join(slots, ["kpi_timestamp", "store_id"], "left_semi").drop("kpi_timestamp")
        names = table.current().columns
        table.upsert(kpi.minute_kpis(touched, width).select(names))
    slots.unpersist()
    return bounds[2]


REPORT = "batch bigint, rows bigint, events bigint, dropped bigint, latest string, watermark string"
_RUN = "run"


def observed(stream: DataFrame) -> DataFrame:
    """Count rows and events, and note the latest time, of every batch while it runs, without another pass."""
    is_event = F.col("event_type") != HEARTBEAT
    return stream.observe(
        _RUN, F.count(F.lit(1)).alias("rows"), F.count_if(is_event).alias("events"), F.max(F.when(is_event, F.col("ts"))).alias("latest")
    )


def run_report(query: StreamingQuery) -> list[tuple]:
    """A line of ``REPORT`` per batch of an observed stream.

    ``dropped`` are the rows that stateful operators left out as behind the watermark, after they
    were combined; the event time that a lag is measured from is the watermark of the batch.
    """
    found = []
    for progress in query.recentProgress:
        seen = progress["observedMetrics"].get(_RUN)  # times come as text
        if seen is not None:
            dropped = sum(op["numRowsDroppedByWatermark"] for op in progress["stateOperators"])
            found.append((progress["batchId"], seen["rows"], seen["events"], dropped, seen["latest"] and str(seen["latest"]), progress["eventTime"].get("watermark")))
    return found
