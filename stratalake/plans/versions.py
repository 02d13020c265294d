"""Type-2 history in a keyed table: open versions in buckets, closed ones in files that stay.

A current row is the open version of its key. Keys whose last entry was a delete keep a row
without a version, so that entries which come too late are noticed. Reading the history is the
closed versions and the open ones; writing costs what changed, not what there is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.operators.temporal import apply_log, open_end, scd2_merge
from stratalake.sources.keyed import KeyedTable

# The last log number applied to a key, and whether the key has an open version.
SEEN, ALIVE = "_seen", "_alive"


class LateEntries(ValueError):
    """Log entries that are not newer than what was already applied to their key."""


def history(table: KeyedTable, version: int | None = None) -> DataFrame | None:
    """All versions, closed and open; None if nothing was written yet."""
    now, before = table.current(version), table.settled(version)
    if now is None:
        return before
    opened = now.where(ALIVE).drop(SEEN, ALIVE, "_bucket").withColumn("sys_end", open_end())
    return opened if before is None else before.unionByName(opened)


def _split(rows: DataFrame, key: str, columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Open versions without their end, and closed ones."""
    is_open = F.col("sys_end") == open_end()
    return rows.where(is_open).select(key, *columns, "sys_start"), rows.where(~is_open).select(key, *columns, "sys_start", "sys_end")


def extend_history(
    table: KeyedTable, log: DataFrame, key: str, order: str, at: str, columns: Sequence[str], version: int | None = None
) -> int:
    """Apply a batch of later log entries; raises ``LateEntries`` for entries that come too late."""
    number = version or table.latest() + 1
    touched = table.touched(log.select(key))
    old = table.current(number - 1, touched)
    if old is None:
        kinds = log.schema
        old = log.limit(0).select(
            key, *columns, F.col(at).alias("sys_start"), F.lit(None).cast(kinds[order].dataType).alias(SEEN), F.lit(True).alias(ALIVE)
        )
    last = log.groupBy(key).agg(F.min(order).alias("_first"), F.max(order).alias("_last"))
    late = last.join(old.select(key, SEEN), key).where(F.col("_first") <= F.col(SEEN))
    found = late.agg(F.count("*"), F.min(key).cast("string")).first()
    if found[0]:
        raise LateEntries(f"entries of {found[0]} keys, {found[1]} for one, are not newer than the history")
    hist = old.where(ALIVE).select(key, *columns, "sys_start", open_end().cast(log.schema[at].dataType).alias("sys_end"))
    opened, closed = _split(apply_log(hist, log, key, order, at, columns), key, columns)
    seen = old.select(key, SEEN).unionByName(last.select(key, F.col("_last").alias(SEEN))).groupBy(key).agg(F.max(SEEN).alias(SEEN))
    current = seen.join(opened.withColumn(ALIVE, F.lit(True)), key, "left").withColumn(ALIVE, F.coalesce(ALIVE, F.lit(False)))
    return table.write(current, touched, closed, number)


def merge_snapshot(
    table: KeyedTable,
    source: DataFrame,
    key: str,
    columns: Sequence[str],
    at,
    close_missing: bool = False,
    exclude: Sequence[str] = (),
    version: int | None = None,
) -> int:
    """Apply a source snapshot as ``temporal.scd2_merge`` does.

    Open versions are compared with the snapshot; only the buckets in which a key changed are
    written, and the versions that were closed.
    """
    number = version or table.latest() + 1
    old = table.current(number - 1)
    if old is None:
        old = source.limit(0).select(
            key, *columns, at.alias("sys_start"), F.lit(None).cast("bigint").alias(SEEN), F.lit(True).alias(ALIVE)
        )
    opened = old.where(ALIVE)
    there, here = F.struct(*[F.col(c) for c in columns]).alias("_old"), F.struct(*[F.col(c) for c in columns]).alias("_new")
    pairs = opened.select(key, there, F.lit(True).alias("_had")).join(source.select(key, here, F.lit(True).alias("_has")), key, "full")
    gone = F.lit(close_missing) & F.col("_has").isNull()
    differs = F.col("_had").isNull() | (F.col("_has").isNotNull() & ~F.col("_old").eqNullSafe(F.col("_new"))) | gone
    touched = table.touched(pairs.where(differs).select(key))
    inside = table.bucket().isin(touched) if touched else F.lit(False)
    hist = opened.where(inside).select(key, *columns, "sys_start").withColumn("sys_end", open_end())
    merged = scd2_merge(hist, source.where(inside), key, columns, at, close_missing, exclude)
    still, closed = _split(merged, key, columns)
    seen = old.where(inside).select(key, SEEN).unionByName(still.select(key, F.lit(None).cast(old.schema[SEEN].dataType).alias(SEEN)))
    seen = seen.groupBy(key).agg(F.max(SEEN).alias(SEEN))
    current = seen.join(still.withColumn(ALIVE, F.lit(True)), key, "left").withColumn(ALIVE, F.coalesce(ALIVE, F.lit(False)))
    return table.write(current, touched, closed, number)
