"""Change log on a stream: idempotent append and type-2 history per micro-batch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from stratalake.plans.versions import extend_history
from stratalake.sources.keyed import KeyedTable
from stratalake.sources.sinks import write_append


def _start(stream: DataFrame, handler, checkpoint: str, once: bool) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(handler).option("checkpointLocation", checkpoint)
    if once:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def append_changes(stream: DataFrame, path: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Append each micro-batch as its own partition; a repeated batch replaces itself."""

    def handle(batch: DataFrame, number: int) -> None:
        write_append(batch, path, f"{number:012d}")

    return _start(stream, handle, checkpoint, once)


def upsert_rows(stream: DataFrame, table: KeyedTable, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Keep the latest row per key of an aggregation in update mode; batch n gives version n + 1."""

    def handle(batch: DataFrame, number: int) -> None:
        rows = batch.persist()
        table.upsert(rows, number + 1)
        rows.unpersist()

    writer = stream.writeStream.outputMode("update").foreachBatch(handle).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def maintain_history(
    stream: DataFrame,
    table: KeyedTable,
    key: str,
    order: str,
    at: str,
    columns: Sequence[str],
    checkpoint: str,
    once: bool = True,
) -> StreamingQuery:
    """Keep a type-2 history up to date; batch n turns version n of ``table`` into version n + 1.

    The table holds one current row per key, with the last log number applied, and the closed
    versions beside them. A batch reads and rewrites the buckets of its keys only. An entry that
    is not newer than what its key has seen stops the stream before anything is written.
    """

    def handle(batch: DataFrame, number: int) -> None:
        log = batch.select(key, order, "op", at, *columns)
        # Several passes over the batch should not read the source again.
        log = log.persist()
        extend_history(table, log, key, order, at, columns, number + 1)
        log.unpersist()

    return _start(stream, handle, checkpoint, once)
